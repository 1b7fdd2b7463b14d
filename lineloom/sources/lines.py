"""Lines of files with their number, byte offset and byte length.

`read_lines` works on any path that Spark reads: files are read as binary up to a size, larger ones by Spark's own text splits (see
`splits`). Only those whose names would have Spark undo a compression go through the `lines` data source.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.encoding import HEAD, decode, detect
from ..ship import ship
from .cutting import BOM, Rule, cut
from .splits import by_splits, escaped, heads, plain  # noqa: F401

SCHEMA = "source string, line_no long, byte_offset long, byte_length int, text string"
MAX_LINE_BYTES = 1 << 20
CHUNK = 32 << 20
WHOLE = 128 << 20
#: What a batch of lines holds at most.
MOST_HELD, MOST_BYTES = 20_000, 16 << 20


def split_lines(raw: bytes, start: int = 0, quoted_newlines: int = 0, last: bool = True, most: int | None = None) -> Iterator[tuple[bytes, int, int]]:
    """(line, offset, length with its end) of bytes that start at an offset.

    A line ends at \\n; within double quotes it doesn't until `quoted_newlines` line ends have been passed. It is cut at
    `most` bytes, MAX_LINE_BYTES unless said otherwise. A final line without an end counts only if `last`.
    """
    at, n, most = 0, len(raw), most or MAX_LINE_BYTES
    while at < n:
        end = raw.find(b"\n", at)
        if quoted_newlines and end >= 0:
            passed = 0
            while end >= 0 and passed < quoted_newlines and raw.count(b'"', at, end) % 2:
                passed += 1
                end = raw.find(b"\n", end + 1)
        if end < 0:
            if not last and n - at <= most:
                return
            end = n - 1
        stop = min(end + 1, at + most)
        line = raw[at:stop]
        size = len(line)
        if line.endswith(b"\n"):
            line = line[:-2] if line.endswith(b"\r\n") else line[:-1]
        if at == 0 and start == 0 and line.startswith(BOM):
            line = line[3:]
        yield line, start + at, size
        at = stop


def split_tail(text: str, label: str = "Email:") -> list[str]:
    """A last line that holds several records is cut before each label."""
    if text.count(label) < 2:
        return [text]
    return [x for x in re.split(rf"\s+(?={label}\s)", text) if x.strip()]


def lines_of(raw: bytes, encoding: str | None = None, quoted_newlines: int = 0) -> list[tuple[int, int, int, str]]:
    """(line_no, offset, length, text) of a whole file."""
    name = encoding or detect(raw)
    if name.startswith("utf-16"):
        return [(no, at, size, t) for no, (t, at, size) in enumerate(cut([raw], Rule(name, quoted_newlines, MAX_LINE_BYTES)), 1)]
    return [(no, at, size, decode(line, name)) for no, (line, at, size) in enumerate(split_lines(raw, 0, quoted_newlines), 1)]


def from_binary(files: DataFrame, encoding: str | None = None, quoted_newlines: int = 0) -> DataFrame:
    """Lines of files that are read whole (path, content)."""
    ship(files.sparkSession)

    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())

    def batch(held: list[tuple]) -> pa.RecordBatch:
        cols = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["source", "line_no", "byte_offset", "byte_length", "text"])

    def run(batches):
        """Small files share a batch of lines; one holds at most MOST_HELD lines or about MOST_BYTES."""
        held: list[tuple] = []
        size = 0
        for b in batches:
            for path, raw in zip(b.column(0), b.column(1), strict=True):  # one at a time, as files may be large
                path, raw = path.as_py(), raw.as_py()
                for row in lines_of(raw or b"", encoding, quoted_newlines):
                    held.append((path, *row))
                    size += row[2]
                    if len(held) >= MOST_HELD or size >= MOST_BYTES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def read_lines(spark: SparkSession, path: str, encoding: str | None = None, quoted_newlines: int = 0) -> DataFrame:
    """Lines of all files of a path or pattern. Files over WHOLE bytes are read by splits."""
    files = spark.read.format("binaryFile").load(path)
    small = from_binary(files.where(F.col("length") <= WHOLE), encoding, quoted_newlines)
    large = large_files(files)
    if not large:
        return small
    return small.unionByName(read_large(spark, large, encoding, quoted_newlines))


#: Names by which Spark's text reader would undo a compression that lines_of leaves alone.
CODEC = (".gz", ".bz2", ".lz4", ".snappy", ".zst", ".deflate")


def head_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source, head, encoding) of large files, read in tasks; sources are plain paths. Written once."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([detect(h or b"") for h in b.column(1).to_pylist()], pa.string())], names=["source", "head", "encoding"])

    return written(heads(spark, paths).mapInArrow(run, "source string, head binary, encoding string"))


def read_large(spark: SparkSession, paths: list[str], encoding: str | None = None, quoted_newlines: int = 0, found: DataFrame | None = None) -> DataFrame:
    """Lines of large files, by Spark's text splits. Those whose names would have it undo a compression are read in order, by one task
    a file, which opens it as a file. found: what head_table gives of the paths, if known."""
    packed = [p for p in paths if p.lower().endswith(CODEC)]
    split = {plain(p): p for p in paths if p not in set(packed)}
    out = []
    if split:
        names = {None: list(split)} if encoding else {}
        if not encoding:
            for source, name in (head_table(spark, list(split.values())) if found is None else found).select("source", "encoding").collect():
                if source in split:
                    names.setdefault(name, []).append(source)
        own = spark.createDataFrame(list(split.items()), "source string, path string")
        for name, some in names.items():
            got = by_splits(spark, [split[p] for p in some], Rule(encoding or name, quoted_newlines, MAX_LINE_BYTES), written)
            out.append(got.join(F.broadcast(own), "source").select(F.col("path").alias("source"), "line_no", "byte_offset", "byte_length", "text"))
    if packed:
        register(spark)
        reader = spark.read.format("lines").option("paths", json.dumps(packed)).option("quoted_newlines", str(quoted_newlines))
        out.append(numbered((reader.option("encoding", encoding) if encoding else reader).load()))
    return reduce(DataFrame.unionByName, out)


def written(df: DataFrame) -> DataFrame:
    """df, stored once in the folder that the driver and the executors share (spark.checkpoint.dir) and read again; df itself without one."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df
    path = f"{folder}/lines-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def large_files(files: DataFrame) -> list[str]:
    """The paths of all files over WHOLE bytes. Spark's own index of files holds them, too."""
    return [r[0] for r in files.where(F.col("length") > WHOLE).select("path").collect()]


def numbered(lines: DataFrame) -> DataFrame:
    """Line numbers from 1 for lines whose ranges are known: counts per range are summed, no task holds a file."""
    counts = lines.groupBy("source", "range").agg(F.count("*").alias("_n"))
    from pyspark.sql import Window

    before = counts.select("source", "range", (F.sum("_n").over(Window.partitionBy("source").orderBy("range")) - F.col("_n")).alias("_before"))
    return lines.join(before, ["source", "range"]).withColumn("line_no", F.col("_before") + F.col("line_no")).select("source", "line_no", "byte_offset", "byte_length", "text")


def register(spark: SparkSession) -> None:
    """Makes the format "lines" known."""
    ship(spark)
    spark.dataSource.register(LinesSource)


class _Range(InputPartition):
    def __init__(self, index: int, start: int, end: int, path: str, encoding: str):
        super().__init__(index)
        self.index, self.start, self.end, self.path, self.encoding = index, start, end, path, encoding

    @property
    def local(self) -> str:
        return _local(self.path)


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.encoding = options.get("encoding")
        self.quoted_newlines = int(options.get("quoted_newlines", 0))
        self.chunk = int(options.get("chunk", CHUNK))

    def _detected(self, path: str) -> str:
        with open(_local(path), "rb") as f:
            return detect(f.read(HEAD))

    def _in_order(self, encoding: str) -> bool:
        """Whether line starts are known only from the start of the file."""
        return self.quoted_newlines > 0 or encoding.startswith("utf-16")

    def partitions(self):
        import os

        out = []
        for p in self.paths:
            size, encoding = os.path.getsize(_local(p)), self.encoding or self._detected(p)
            chunk = max(1, size) if self._in_order(encoding) else self.chunk
            out += [_Range(i, a, min(size, a + chunk), p, encoding) for i, a in enumerate(range(0, size, chunk))] or [_Range(0, 0, 0, p, encoding)]
        return out

    def read(self, part: _Range):
        """The lines that start within the range; the last of them may end behind it, all its pieces are given here."""
        if self._in_order(part.encoding):
            yield from self._all(part)
            return
        with open(part.local, "rb") as f:
            at = part.start
            if at:
                f.seek(at - 1)
                at -= 1
                while at < part.end:
                    skipped = f.readline(MAX_LINE_BYTES)
                    at += len(skipped)
                    if not skipped or skipped.endswith(b"\n"):
                        break
                else:
                    return
            no, inside = 0, False
            while at < part.end or inside:
                f.seek(at)
                line = f.readline(MAX_LINE_BYTES)
                if not line:
                    break
                no += 1
                text = line[:-2] if line.endswith(b"\r\n") else line.removesuffix(b"\n")
                if at == 0 and text.startswith(BOM):
                    text = text[3:]
                yield part.path, part.index, no, at, len(line), decode(text, part.encoding)
                at += len(line)
                inside = not line.endswith(b"\n")


    def _all(self, part: _Range):
        with open(part.local, "rb") as f:
            blocks = iter(lambda: f.read(4 * MAX_LINE_BYTES), b"")
            for no, (text, at, size) in enumerate(cut(blocks, Rule(part.encoding, self.quoted_newlines, MAX_LINE_BYTES)), 1):
                yield part.path, part.index, no, at, size, text


class LinesSource(DataSource):
    """spark.read.format("lines").option("path", file): lines by byte ranges of a large file that all hosts can open.

    The option paths, a JSON array, takes the place of path for several files. Without the option encoding, it is detected. UTF-16 and quoted newlines are read in order, by one task a file.
    """

    @classmethod
    def name(cls) -> str:
        return "lines"

    def schema(self) -> str:
        return "source string, range int, line_no long, byte_offset long, byte_length int, text string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def explode_text(df: DataFrame, source: str, text: str) -> DataFrame:
    """Native: the lines of a text column, each row a source of its own. Offsets are in UTF-8."""
    parts = df.select(F.col(source).cast("string").alias("source"), F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("_i", "_t"))
    return parts.select("source", (F.col("_i") + 1).cast("long").alias("line_no"), F.regexp_replace("_t", "\r$", "").alias("text"))
