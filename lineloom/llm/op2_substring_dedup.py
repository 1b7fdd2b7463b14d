"""Substring dedup by difference-cover anchors.

Rule: a window is 13 consecutive words of one document. Each word is removed that is covered by a window whose words
also start somewhere in a document with a smaller doc_id; windows are judged on the input.

Method: in period 7 the positions {0, 1, 3} are a difference cover: for any two alignments there is a shift under 7
that brings both to cover positions. So two equal 13-word windows share an anchor, a window of 7 words at cover
positions of both texts. Anchors are hashed and dealt out; those in two documents or more go back to their documents
and extend: the windows of 13 words around them get 128-bit hashes, of which the least doc_id is found, and windows
with a smaller owner cover what goes.

Numbers travel packed: a task holds `FLUSH` anchors, groups them, settles what it can by itself, and sends per hash
one document's entries, so a passage in a third of all rows costs one entry a flush, not one a row. A reducer's group is a bucket
of a size that plan_bytes sets, and so is the number of tasks. Texts are moved once (the exchange by doc_id is reused).

Null texts have no words. A document with a null doc_id is kept whole and judges none. Rows that share a doc_id are
not smaller than one another; each is judged by its own text. Texts under 13 words are kept. An empty table gives an
empty one. Other columns aren't read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buckets, mix, pieces, runs, table, tasks, texts, tune
from .words import deltas, hash64, hash128, packed, unpacked, windows

LENGTH, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = LENGTH - PERIOD + 1
FLUSH = 1_000_000
#: meets: whether the entries still meet others of their hash, or wait for the rest of their document
OUT = "bucket int, meets boolean, body binary"
PLACES = "doc_id long, body binary"


def _batch(bucket: np.ndarray, meets: bool, doc: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A packed row per bucket, its entries in order of doc_id."""
    order = np.lexsort((doc, bucket))
    bucket, doc, columns = bucket[order], doc[order], [c[order] for c in columns]
    at, size = runs(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else (np.array([], int), np.array([], int))
    body = [packed(deltas(doc[a : a + s]), *(c[a : a + s] for c in columns)) for a, s in zip(at.tolist(), size.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[at], pa.int32()), pa.array([meets] * len(at), pa.bool_()), pa.array(body, pa.binary())], names=["bucket", "meets", "body"])


def _home(doc: np.ndarray, n: int) -> np.ndarray:
    """The bucket where a document's entries come together."""
    return (mix(doc.view(np.uint64)) % np.uint64(n)).astype(np.int64)


def _gather(*kinds: str):
    """A row per document with its entries: each column's bytes, one after the other."""

    def run(t: pa.Table) -> pa.Table:
        doc, *columns = (np.concatenate(x) for x in zip(*(_unpack(b, *kinds) for b in t.column("body").to_pylist()), strict=True))
        order = np.lexsort((columns[-1], doc))
        doc, columns = doc[order], [c[order] for c in columns]
        at, size = runs(np.append(True, doc[1:] != doc[:-1])) if len(doc) else (np.array([], int), np.array([], int))
        body = [b"".join(c[a : a + s].tobytes() for c in columns) for a, s in zip(at.tolist(), size.tolist(), strict=True)]
        return pa.table({"doc_id": pa.array(doc[at], pa.int64()), "body": pa.array(body, pa.binary())})

    return run


def _shared(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that groups equal keys, by doc_id within; per entry of it its group's least and greatest doc_id."""
    order = np.lexsort((doc, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    at, size = runs(new)
    d = doc[order]
    return order, np.repeat(d[at], size), np.repeat(d[at + size - 1], size)


def _by_hash(h: np.ndarray, n: int) -> np.ndarray:
    """A bucket by the upper half of a hash, so that the six lower bytes still tell hashes apart."""
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _anchors(n: int):
    def flush(held):
        doc, pos, h = (np.concatenate(x) for x in zip(*held, strict=True))
        order, least, most = _shared([h], doc)
        doc, pos, h = doc[order], pos[order], h[order]
        known = least != most
        yield _batch(_home(doc[known], n), False, doc[known], [pos[known]])
        on = doc == least  # one document speaks for the group
        doc, pos, h = doc[on], pos[on], h[on]
        low = h.view(np.uint8).reshape(-1, 8)[:, :6]
        yield _batch(_by_hash(h, n), True, doc, [low, pos])

    def run(batches):
        held, size = [], 0
        for b in pieces(batches, 256):
            for d, raw in zip(b.column(0).to_pylist(), texts(b), strict=True):
                words = raw.split()
                if d is None or len(words) < LENGTH:
                    continue
                at = np.arange(len(words) - ANCHOR + 1)
                at = at[np.isin(at % PERIOD, COVER)]
                held.append((np.full(len(at), d, np.int64), at.astype(np.int32), windows(hash64(words), at, ANCHOR, 7)))
                size += len(at)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _meet(t: pa.Table, settle) -> pa.Table:
    """Rows that wait for their document pass; of the others settle gives what is shared."""
    meets = t.column("meets")
    blobs = t.filter(meets).column("body").to_pylist()
    return pa.concat_tables([t.filter(pa.compute.invert(meets)), *([pa.Table.from_batches([settle(blobs)])] if blobs else [])])


def _meet_anchors(n: int):
    def settle(blobs: list[bytes]) -> pa.RecordBatch:
        doc, low, pos = (np.concatenate(x) for x in zip(*(_unpack(x, (6,), "<i4") for x in blobs), strict=True))
        order, least, most = _shared([low], doc)
        many = order[least != most]
        return _batch(_home(doc[many], n), False, doc[many], [pos[many]])

    return lambda t: _meet(t, settle)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    """doc_ids and then the columns; the kind (6,) is a number of six bytes."""
    got = unpacked(blob, "<i8", *("V6" if k == (6,) else k for k in kinds))
    out = [np.cumsum(got[0])]
    for g, k in zip(got[1:], kinds, strict=True):
        if k == (6,):
            wide = np.zeros((len(g), 8), np.uint8)
            wide[:, :6] = g.view(np.uint8).reshape(-1, 6)
            g = wide.view("<u8").ravel()
        out.append(g)
    return out


def _tag(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) & 0x7FFFFFFF


def _extend(n: int):
    """Hashes of the windows around shared anchors."""

    def flush(held):
        doc, tag, pos, h1, h2 = (np.concatenate(x) for x in zip(*held, strict=True))
        order, least, _ = _shared([h2, h1], doc)
        doc, tag, pos, h1, h2 = (x[order] for x in (doc, tag, pos, h1, h2))
        later = doc != least
        yield _batch(_home(doc[later], n), False, doc[later], [tag[later], pos[later]])
        doc, tag, pos, h1, h2 = (x[~later] for x in (doc, tag, pos, h1, h2))
        yield _batch(_by_hash(h1, n), True, doc, [tag, pos, h1, h2])

    def run(batches):
        held, size = [], 0
        for b in pieces(batches, 256):
            for d, raw, body in zip(b.column(0).to_pylist(), texts(b), b.column(2).to_pylist(), strict=True):
                if not body or not (words := raw.split()):
                    continue
                anchor = np.frombuffer(body, "<i4")
                last = len(words) - LENGTH
                steps = np.zeros(len(words) + 2, np.int32)
                lo, hi = np.maximum(anchor - (PERIOD - 1), 0), np.minimum(anchor, last) + 1
                ok = lo < hi  # else an anchor of another row with this doc_id
                np.add.at(steps, lo[ok], 1)
                np.add.at(steps, hi[ok], -1)
                at = np.flatnonzero(np.cumsum(steps) > 0)
                h1, h2 = hash128(words)
                held.append((np.full(len(at), d, np.int64), np.full(len(at), _tag(raw), np.int32), at.astype(np.int32), windows(h1, at, LENGTH, 11), windows(h2, at, LENGTH, 13)))
                size += len(at)
                if size >= FLUSH // 2:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _meet_windows(n: int):
    def settle(blobs: list[bytes]) -> pa.RecordBatch:
        doc, tag, pos, h1, h2 = (np.concatenate(x) for x in zip(*(_unpack(x, "<i4", "<i4", "<u8", "<u8") for x in blobs), strict=True))
        order, least, _ = _shared([h2, h1], doc)
        later = order[doc[order] != least]
        return _batch(_home(doc[later], n), False, doc[later], [tag[later], pos[later]])

    return lambda t: _meet(t, settle)


def _keep(batches, with_text: bool):
    for b in pieces(batches, 256):
        ids, n, gone, sha, kept = [], [], [], [], []
        for d, raw, body in zip(b.column(0).to_pylist(), texts(b), b.column(2).to_pylist(), strict=True):
            words = raw.split()
            left, removed = words, 0
            if body:
                tag = _tag(raw)
                steps = np.zeros(len(words) + LENGTH + 1, np.int32)
                tags, pos = np.frombuffer(body, "<i4").reshape(2, -1)
                pos = pos[tags == tag]
                np.add.at(steps, pos, 1)
                np.add.at(steps, pos + LENGTH, -1)
                stay = np.cumsum(steps[: len(words)]) == 0
                left = [words[i] for i in np.flatnonzero(stay).tolist()]
                removed = len(words) - len(left)
            text = b" ".join(left)
            ids.append(d)
            n.append(len(words))
            gone.append(removed)
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode() if with_text else None)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text of each row."""
    tune(df.sparkSession)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n, parts = buckets(docs, 10 << 20), tasks(docs)

    def by_bucket(rows: DataFrame):
        return rows.repartition(parts, "bucket").groupBy("bucket")  # one exchange, into tasks whose number grows with the input

    anchors = by_bucket(docs.mapInArrow(_anchors(n), OUT)).applyInArrow(_meet_anchors(n), OUT)
    places = by_bucket(anchors).applyInArrow(_gather("<i4"), PLACES)
    # the places of a task's documents, at most about as large as their texts, are its hash table
    dealt = docs.repartition(parts, "doc_id")
    near = dealt.join(places.repartition(parts, "doc_id").hint("shuffle_hash"), "doc_id", "left").select("doc_id", F.when(F.col("body").isNotNull(), F.col("text")).alias("text"), "body")
    found = by_bucket(near.mapInArrow(_extend(n), OUT)).applyInArrow(_meet_windows(n), OUT)
    gone = by_bucket(found).applyInArrow(_gather("<i4", "<i4"), PLACES)
    return dealt.join(gone.repartition(parts, "doc_id").hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "body").mapInArrow(lambda batches: _keep(batches, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")
