"""Lines of large files by Spark's text splits: any encoding, quoted newlines too, in many tasks.

Spark's text reader gives what lies between end marks, a split the pieces that start in it. A mark isn't always a line's end: it may be
quoted, lie across two characters of UTF-16, or come behind so many bytes that the line was cut before. So a first pass finds, for every
state that a split may begin in, in which it ends and how many lines start in it; put together file by file, a row per split, this gives
the true states, and a second pass cuts. Where a line over several splits would be cut within one of them, the place depends on more
than the state: the splits of such a file are gone through in order, by a task that holds a line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import HEAD, detect
from ..ship import ship
from .cutting import BOM, FRESH, Chain, Rule, Trials, after, key

SCHEMA = "source string, line_no long, byte_offset long, byte_length int, text string"
_STATE = "odd int, passed int, before long"
_BEGINS = f"source string, range long, {_STATE}, line_no long, byte_offset long, marked boolean, sure boolean"
_NAMES = [x.split(" ")[0] for x in _BEGINS.split(", ")]
_KINDS = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
#: Stands for a file's first split with a byte order mark.
MARKED = (-1, 0, 0)


def escaped(path: str) -> str:
    """A path that isn't taken as a pattern."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def plain(path: str) -> str:
    """A path as one form: its scheme is followed by one slash or by several."""
    return re.sub(r"^(\w+):/+", r"\1:/", path if re.match(r"\w+:/", path) else f"file:{path}")


def plainly(path: Column) -> Column:
    """Native form of plain, for paths that have a scheme."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^(\w+):/+", "$1:/")


def _pieces(spark: SparkSession, paths: list[str], end: str) -> DataFrame:
    place = F.col("_metadata")
    raw = spark.read.option("lineSep", end).text([escaped(p) for p in paths])
    return raw.select(plainly(place["file_path"]).alias("source"), place["file_size"].alias("size"), place["file_block_start"].alias("range"), F.col("value").cast("binary").alias("raw"))


def heads(spark: SparkSession, paths: list[str], most: int = HEAD) -> DataFrame:
    """(source, head) of files: their first bytes, read by tasks. What Spark reads of a split behind a batch of rows isn't asked for."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, bytearray] = {}
        for b in batches:
            for source, start, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if start == 0 and len(head := held.setdefault(source, bytearray())) < most:
                    head += raw + b"\n"
            if held and all(len(h) >= most for h in held.values()):
                break
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([bytes(h[:most]) for h in held.values()], pa.binary())], names=["source", "head"])

    return _pieces(spark, paths, "\n").where("range = 0").mapInArrow(run, "source string, head binary")


def _blocks(batches: Iterator[pa.RecordBatch], end: bytes) -> Iterator[tuple[tuple, list, bytes]]:
    """((source, range), further columns of its first row, bytes) of the pieces that come one after the other."""
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        name, rest, parts = None, [], []
        for source, size, start, raw, *more in zip(*cols, strict=True):
            if (source, start) != name:
                if parts:
                    yield name, rest, b"".join(parts)
                name, rest, parts = (source, start), [size, *more], []
            parts.append(raw + end)
        if parts:
            yield name, rest, b"".join(parts)


def _summaries(pieces: DataFrame, rule: Rule) -> DataFrame:
    """(source, size, range, n, trials) of each split."""

    def run(batches):
        now, size, trial, marked = None, 0, None, None
        for name, (n,), block in _blocks(batches, rule.end):
            if name != now:
                if now:
                    yield _row(now, size, trial, marked)
                now, size, trial, marked = name, n, Trials(rule), None
                # a file may begin with a byte order mark, which Spark's reader takes away: what all its splits hold tells in the end
                if name[1] == 0 and not rule.wide:
                    marked = Trials(rule, FRESH)
                    marked.feed(BOM)
            trial.feed(block)
            if marked:
                marked.feed(block)
        if now:
            yield _row(now, size, trial, marked)

    def _row(name, size, trial, marked):
        done = [*trial.done().items(), *((MARKED, t) for t in (marked.done().values() if marked else ()))]
        found = [{"odd": s[0], "passed": s[1], "before": s[2], "first": t.first, "starts": t.starts, "moved": t.moved, "odd2": t.state[0], "passed2": t.state[1], "before2": t.state[2], "exact": t.exact} for s, t in done]
        kind = pa.list_(pa.struct([("odd", pa.int32()), ("passed", pa.int32()), ("before", pa.int64()), ("first", pa.int64()), ("starts", pa.int64()), ("moved", pa.bool_()), ("odd2", pa.int32()), ("passed2", pa.int32()), ("before2", pa.int64()), ("exact", pa.bool_())]))
        return pa.RecordBatch.from_arrays([pa.array([name[0]]), pa.array([size], pa.int64()), pa.array([name[1]], pa.int64()), pa.array([trial.whole], pa.int64()), pa.array([found], kind)], names=["source", "size", "range", "n", "trials"])

    kind = f"source string, size long, range long, n long, trials array<struct<{_STATE.replace(' ', ':').replace(',:', ',')},first:long,starts:long,moved:boolean,odd2:int,passed2:int,before2:long,exact:boolean>>"
    return pieces.mapInArrow(run, kind)


def _composed(summaries: DataFrame, rule: Rule) -> DataFrame:
    """(source, range, state, line_no, byte_offset, sure) of each split: a file's rows one after the other. `sure` is false where a file's chain breaks, behind that there are no rows."""

    def run(t: pa.Table) -> pa.Table:
        from .cutting import Trial

        rows = sorted(t.to_pylist(), key=lambda r: r["range"])
        tables: dict[int, dict] = {}
        for r in rows:
            own = tables.setdefault(r["range"], {"n": r["n"]})
            for x in r["trials"]:
                own[(x["odd"], x["passed"], x["before"], x["exact"])] = Trial(x["first"], x["starts"], x["moved"], (x["odd2"], x["passed2"], x["before2"]), x["exact"])
        # all pieces with their end marks are as long as the file or, without a last mark, a byte longer
        marked = not rule.wide and sum(own["n"] for own in tables.values()) <= rows[0]["size"] - 2
        out, state, no, at = [], FRESH, 0, 0
        for start, own in tables.items():
            bom = marked and start == 0
            trial = own.get((*MARKED, True)) if bom else own.get((*key(rule, state), False))
            then = after(rule, state, trial, own["n"])
            out.append((rows[0]["source"], start, *state, no, at, bom, then is not None))
            if then is None:
                break
            state, no, at = then, no + trial.starts, at + own["n"] + (len(BOM) if bom else 0)
        cols = list(zip(*out, strict=True))
        return pa.table({n: pa.array(c, k) for n, c, k in zip(_NAMES, cols, _KINDS, strict=True)})

    return summaries.groupBy("source").applyInArrow(run, _BEGINS)


def _in_order(pieces: DataFrame, rule: Rule) -> DataFrame:
    """What _composed gives, of files whose pieces come in order: a task reads a file and holds a line of it. pieces has i and marked."""

    def run(batches):
        now, chain, fed, no = (None, None), None, 0, 0
        for name, (_, _, bom), block in _blocks(batches, rule.end):
            out = []
            if name[0] != now[0]:
                chain, fed, no = Chain(rule), 0, 1
            if name != now:
                state = chain.state(fed)
                out.append((*name, *state, no - (state[2] == 0), fed, bom and name[1] == 0, True))
                block = BOM + block if bom and name[1] == 0 else block
                now = name
            no += sum(1 for _ in chain.feed(block))
            fed += len(block)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(out[0], _KINDS, strict=True)], names=_NAMES)

    sorted_ = pieces.repartition("source").sortWithinPartitions("source", "range", "i")
    return sorted_.select("source", "size", "range", "raw", "i", "marked").mapInArrow(run, _BEGINS)


def starts(pieces: DataFrame, rule: Rule, written) -> DataFrame:
    """(source, range, state, line_no, byte_offset, marked): how each split begins. written(df) stores a small table and reads it again."""
    found = written(_composed(written(_summaries(pieces, rule)), rule))
    broken = found.where("NOT sure").select("source").distinct()
    if broken.isEmpty():
        return found.drop("sure")
    again = pieces.withColumn("i", F.monotonically_increasing_id()).join(F.broadcast(found.where("range = 0").select("source", "marked").join(broken, "source")), "source")
    sure = written(_in_order(again, rule))
    return found.join(broken, "source", "left_anti").unionByName(sure).drop("sure")


def by_splits(spark: SparkSession, paths: list[str], rule: Rule, written) -> DataFrame:
    """Lines of large files of one encoding.

    What a split begins with is joined to its pieces from a broadcast: a row of some 60 bytes for each split of 128 MiB.
    """
    ship(spark)
    pieces = _pieces(spark, paths, rule.end.decode("ascii"))
    begins = starts(pieces, rule, written)
    joined = pieces.join(F.broadcast(begins), ["source", "range"], "left").select("source", "size", "range", "raw", "odd", "passed", "before", "line_no", "byte_offset", "marked")

    def run(batches):
        now, chain, no, at, size = None, None, 0, 0, 0
        out: list[tuple] = []

        def given(a: int, b: int, open_: bool):
            nonlocal no
            raw = chain.bytes(max(a, 0), b)
            if a >= 0:
                no += 1
            if a < 0 or open_:  # a part of a line that other splits have more of
                return (now[0], size, no, at + a, at + max(a, 0), None, None, raw)
            start, n = at + a, b - a
            if start + n > size:  # the file's last line has no end
                raw, n = raw[: size - start], size - start
            return (now[0], size, no, start, start, n, rule.text(raw, start), None)

        def rest():
            if chain is not None and fed > max(chain.start, 0):
                out.append(given(chain.start, fed, True))

        fed = 0
        for name, (n_bytes, *begin), block in _blocks(batches, rule.end):
            if name != now:
                rest()
                if begin[0] is None:
                    raise ValueError("files were split differently in two passes")
                now, chain, size, fed = name, Chain(rule, tuple(begin[:3])), n_bytes, 0
                no, at = begin[3], begin[4]
                block = BOM + block if begin[5] else block
            for a, b in chain.feed(block):
                out.append(given(a, b, False))
                if len(out) >= 20_000:
                    yield _batch(out)
                    out.clear()
            fed += len(block)
        rest()
        yield _batch(out)

    got = joined.mapInArrow(run, "source string, size long, line_no long, byte_offset long, at long, byte_length int, text string, raw binary")
    whole = got.where("raw IS NULL AND byte_offset < size").select("source", "line_no", "byte_offset", "byte_length", "text")
    parts = got.where("raw IS NOT NULL").groupBy("source", "size", "line_no", "byte_offset").agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("parts"))
    parts = parts.select("source", "line_no", "byte_offset", F.expr("substring(aggregate(parts, CAST('' AS BINARY), (a, x) -> concat(a, x.raw)), 1, cast(size - byte_offset AS int))").alias("raw")).where(F.length("raw") > 0)

    def joined_text(batches):
        for b in batches:
            texts = [rule.text(r, a) for r, a in zip(b.column(3).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([len(r) for r in b.column(3).to_pylist()], pa.int32()), pa.array(texts, pa.string())], names=["source", "line_no", "byte_offset", "byte_length", "text"])

    return whole.unionByName(parts.mapInArrow(joined_text, SCHEMA))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary())
    cols = list(zip(*rows, strict=True)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["source", "size", "line_no", "byte_offset", "at", "byte_length", "text", "raw"])
