"""A queue of messages in a shared folder, as a source for streams and batches.

A batch of messages is a folder with a file per bucket of keys, so messages of a key lie in one file, in order. Tasks write the
files, and a marker written last makes the batch known: a publication that fails leaves nothing that is read. Readers take buckets by
ranges, one task each. A stream's checkpoint holds the last batch of each trigger: what isn't committed is given again, what is
committed never; `commit` notes it in the folder, and `prune` removes what all readers have committed.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..ship import ship

BUCKETS = 64
SCHEMA = "key string, batch long, place long, body string"


class _Folder:
    """The files of a queue, on any file system that pyarrow opens."""

    def __init__(self, path: str):
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path.removeprefix("file:"))

    def batches(self) -> list[int]:
        """The batches that are known, in order."""
        found = self.fs.get_file_info(pyarrow.fs.FileSelector(f"{self.root}/ready", allow_not_found=True))
        return sorted(int(f.base_name) for f in found if f.base_name.isdigit())

    def files(self, batch: int) -> dict[int, str]:
        """The file of each bucket."""
        with self.fs.open_input_stream(f"{self.root}/ready/{batch}") as f:
            name = json.loads(f.read())["name"]
        found = self.fs.get_file_info(pyarrow.fs.FileSelector(f"{self.root}/parts/{name}", allow_not_found=True))
        return {int(f.base_name): f.path for f in found if f.base_name.isdigit()}

    def put(self, path: str, raw: bytes) -> None:
        """Writes a file that is there whole or not at all."""
        whole = f"{self.root}/{path}"
        self.fs.create_dir(whole.rpartition("/")[0], recursive=True)
        name = f"{whole}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(name) as f:
            f.write(raw)
        self.fs.move(name, whole)

    def get(self, path: str) -> bytes | None:
        try:
            with self.fs.open_input_stream(f"{self.root}/{path}") as f:
                return f.read()
        except FileNotFoundError:
            return None


def bucket_of(key: str) -> int:
    return zlib.crc32(key.encode()) % BUCKETS


def publish(messages: DataFrame, path: str, order: list[str]) -> int:
    """Adds messages (key, body) as one batch, those of a key in the given order; gives its number. Nulls in key are the key ''."""
    ship(messages.sparkSession)
    folder, name = _Folder(path), uuid.uuid4().hex
    own = messages.withColumn("key", F.coalesce("key", F.lit("")))
    dealt = own.withColumn("_bucket", (F.crc32(F.encode("key", "UTF-8")) % BUCKETS).cast("int")).repartition(BUCKETS, "_bucket").sortWithinPartitions("_bucket", *order).select("_bucket", "key", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, now, rows, n = _Folder(path), None, [], 0
        for b in batches:
            for bucket, key, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != now:
                    if rows:
                        to.put(f"parts/{name}/{now}", b"".join(rows))
                    now, rows = bucket, []
                rows.append(json.dumps([key, body], ensure_ascii=False).encode() + b"\n")
                n += 1
        if rows:
            to.put(f"parts/{name}/{now}", b"".join(rows))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    n = dealt.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
    batch = (folder.batches() or [0])[-1] + 1
    folder.put(f"ready/{batch}", json.dumps({"name": name, "n": n}).encode())
    return batch


class _Range(InputPartition):
    def __init__(self, index: int, buckets: range, batches: list[int]):
        super().__init__(index)
        self.buckets, self.batches = buckets, batches


def _ranges(options: dict, batches: list[int]) -> list[_Range]:
    n = max(1, min(BUCKETS, int(options.get("ranges", 8))))
    return [_Range(i, range(BUCKETS * i // n, BUCKETS * (i + 1) // n), batches) for i in range(n)]


def _read(path: str, part: _Range) -> Iterator[tuple]:
    folder = _Folder(path)
    for batch in part.batches:
        files = folder.files(batch)
        for bucket in part.buckets:
            if bucket in files:
                with folder.fs.open_input_stream(files[bucket]) as f:
                    for place, line in enumerate(f.read().splitlines()):
                        key, body = json.loads(line)
                        yield key, batch, place, body


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return _ranges(self.options, _Folder(self.options["path"]).batches())

    def read(self, partition: _Range):
        yield from _read(self.options["path"], partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options, self.path = options, options["path"]

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        return {"batch": (_Folder(self.path).batches() or [0])[-1]}

    def partitions(self, start: dict, end: dict):
        return _ranges(self.options, [b for b in _Folder(self.path).batches() if start["batch"] < b <= end["batch"]])

    def read(self, partition: _Range):
        yield from _read(self.path, partition)

    def commit(self, end: dict) -> None:
        _Folder(self.path).put(f"committed/{self.options.get('reader', 'default')}", json.dumps(end).encode())


class QueueSource(DataSource):
    """spark.readStream.format("jobqueue").option("path", folder): messages by batch and bucket. Options: ranges (tasks a trigger), reader (the name under which commits are noted)."""

    @classmethod
    def name(cls) -> str:
        return "jobqueue"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(QueueSource)


def prune(path: str, readers: list[str]) -> list[int]:
    """Removes batches that all of the readers have committed; gives their numbers."""
    folder = _Folder(path)
    done = [json.loads(raw)["batch"] if (raw := folder.get(f"committed/{r}")) else 0 for r in readers]
    gone = [b for b in folder.batches()[:-1] if done and b <= min(done)]  # the last one stays, so that numbers go on
    for b in gone:
        name = json.loads(folder.get(f"ready/{b}"))["name"]
        folder.fs.delete_file(f"{folder.root}/ready/{b}")
        folder.fs.delete_dir(f"{folder.root}/parts/{name}")
    return gone
