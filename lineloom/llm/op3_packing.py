"""Token ids packed into fixed rows by best-fit decreasing.

Rule: each text becomes the ids of a public byte-level vocabulary with one end id behind them. A document longer than a row is split, without
loss, into full rows and a rest. What is shorter than a row is packed best-fit-decreasing: longest first, each piece
into the fullest row that still has room, found in a segment tree over the free capacities. Packing runs over windows
of `window` tokens within a task, so memory is bounded whatever the input, and no document moves: there is no shuffle.
The rows of a window that are fuller than `carry` go out; the others, at most a few, wait for the next window.

An output row has pack_id, the doc_ids of its segments, where each starts in its document, the cumulative segment
lengths (first 0), the positions within segments (they start again at 0 with each segment), the ids, and n_tokens.
ids and position_ids are little-endian uint16 or int32 rows of exactly `length` entries, padded by `pad`.

Null and empty texts give just the end id. Repeated rows are packed each. Ties in length keep the order of the input;
of equally full rows the oldest takes the piece. An empty table gives no row. A null doc_id is carried as null.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import pieces, table, texts, tune
from .op1_token_counts import model_bytes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SCHEMA = "pack_id long, doc_ids array<long>, doc_starts array<long>, cu_seqlens array<int>, n_tokens int, ids binary, position_ids binary"


@lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str):
    """The tiktoken encoding of a file of ranks, and the number of its ids."""
    import tiktoken

    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=known, special_tokens={}), max(known.values()) + 1


class Room:
    """Open rows by free capacity; a segment tree finds the least capacity that is enough."""

    def __init__(self, length: int):
        self.n = 1 << length.bit_length()
        self.some = bytearray(2 * self.n)
        self.rows: dict[int, list[int]] = {}

    def put(self, free: int, row: int) -> None:
        if free in self.rows:
            self.rows[free].append(row)
            return
        self.rows[free] = [row]
        k = free + self.n
        while k and not self.some[k]:
            self.some[k] = 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The free capacity and the oldest row of the least one that is at least `need`."""
        k, some = need + self.n, self.some
        while not some[k]:
            while k & 1:  # a right child: go up
                k >>= 1
            if not k:
                return None
            k += 1
            if k & (k - 1) == 0:  # wrapped to the next level: nothing to the right
                return None
        while k < self.n:
            k = 2 * k if some[2 * k] else 2 * k + 1
        free = k - self.n
        waiting = self.rows[free]
        row = waiting.pop(0)
        if not waiting:
            del self.rows[free]
            some[k] = 0
            k >>= 1
            while k and not (some[2 * k] or some[2 * k + 1]):
                some[k] = 0
                k >>= 1
        return free, row


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of indices into lengths, each at most `length`."""
    rows: list[list[int]] = []
    room = Room(length)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        free, row = room.take(need) or (length, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(i)
        room.put(free - need, row)
    return rows


def pack(df: DataFrame, ranks: bytes, length: int = 2048, end: int | None = None, pad: int = 0, window: int = 2_000_000, carry: float = 0.97, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """end: the id behind each document; if none is given, the first that the vocabulary doesn't use."""
    import public_tokenizers

    tune(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(ranks)
    pattern = public_tokenizers.PATTERN
    df = df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))

    def run(batches):
        from pyspark import TaskContext

        encoding, free = encoder(sent.value, pattern)
        last = free if end is None else end
        kind = np.uint16 if max(free, last, pad, length) < 1 << 16 else np.int32
        made = [(TaskContext.get().partitionId() if TaskContext.get() else 0) << 40]
        counting = np.arange(length, dtype=kind)

        def emit(rows: list[list[tuple]]):
            out = [[] for _ in range(7)]
            for row in rows:
                lens = [len(x[2]) for x in row]
                n = sum(lens)
                ids = np.full(length, pad, kind)
                ids[:n] = np.concatenate([x[2] for x in row])
                pos = np.zeros(length, kind)
                pos[:n] = np.concatenate([counting[:k] for k in lens])
                made[0] += 1
                for o, v in zip(out, (made[0] - 1, [x[0] for x in row], [x[1] for x in row], [0, *np.cumsum(lens).tolist()], n, ids.tobytes(), pos.tobytes()), strict=True):
                    o.append(v)
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary())
            names = ("pack_id", "doc_ids", "doc_starts", "cu_seqlens", "n_tokens", "ids", "position_ids")
            return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names=names)

        held: list[tuple] = []
        size = 0
        full: list[list[tuple]] = []
        for b in pieces(batches):
            for d, raw in zip(b.column(0).to_pylist(), texts(b), strict=True):
                ids = np.array([*encoding.encode_ordinary(raw.decode()), last], kind)
                whole = len(ids) // length * length
                full += [[(d, k, ids[k : k + length])] for k in range(0, whole, length)]
                if whole < len(ids):
                    held.append((d, whole, ids[whole:]))
                    size += len(ids) - whole
            while len(full) >= 256:
                yield emit(full[:256])
                full = full[256:]
            if size >= window:
                rows = [[held[i] for i in row] for row in best_fit([len(x[2]) for x in held], length)]
                left = [row for row in rows if sum(len(x[2]) for x in row) < carry * length]
                done = [row for row in rows if sum(len(x[2]) for x in row) >= carry * length] or rows
                left = left if done is not rows else []
                for k in range(0, len(done), 256):
                    yield emit(done[k : k + 256])
                held = [x for row in left for x in row]
                size = sum(len(x[2]) for x in held)
                if size >= window // 2:  # short pieces that don't fill rows well: never wait twice
                    yield from (emit(left[k : k + 256]) for k in range(0, len(left), 256))
                    held, size = [], 0
        rows = full + [[held[i] for i in row] for row in best_fit([len(x[2]) for x in held], length)]
        for k in range(0, len(rows), 256):
            yield emit(rows[k : k + 256])

    return df.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Parquet files whose binary columns are rows of the id matrix; written by the executors to any file system."""
    packed.write.mode("overwrite").parquet(path)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), model_bytes(VOCABULARY))
