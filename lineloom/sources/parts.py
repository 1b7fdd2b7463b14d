"""Parquet parts with a manifest: what is written counts once the manifest says so.

Tasks write files and send their names, rows and bytes as commit messages; the driver then writes the manifest of a new generation and,
last, the name of that generation. A job that fails leaves the generation before as it was, and removes its own files. Sizes come from the
messages, so nothing is scanned again for them. Compaction writes a generation of fewer files and swaps to it; `vacuum` removes what no
generation that is kept names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..ship import ship

# A part ends at so many rows or bytes; merged parts have about so many bytes.
ROWS, BYTES, MERGED = 50_000, 64 << 20, 64 << 20
LAST = "_MANIFEST.json"


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path.removeprefix("file:"))


def _put(path: str, name: str, value: object) -> None:
    fs, root = opened(path)
    fs.create_dir(root, recursive=True)
    own = f"{root}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as f:
        f.write(json.dumps(value).encode())
    fs.move(own, f"{root}/{name}")


def _get(path: str, name: str):
    fs, root = opened(path)
    try:
        with fs.open_input_stream(f"{root}/{name}") as f:
            return json.loads(f.read())
    except FileNotFoundError:
        return None


def manifest(path: str, generation: int | None = None) -> dict:
    """{generation, parts: [{name, rows, bytes}]} of the last generation, or of a given one."""
    if generation is None:
        last = _get(path, LAST)
        generation = last["generation"] if last else 0
    return _get(path, f"_MANIFEST-{generation}.json") or {"generation": generation, "parts": []}


@dataclass
class _Written(WriterCommitMessage):
    parts: list[dict] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.replaces = options["path"], overwrite or options.get("replaces", "") == "true"
        self.rows, self.bytes = int(options.get("rows", ROWS)), int(options.get("bytes", BYTES))
        self.expected = int(options["expected"]) if "expected" in options else None
        self.least = int(options.get("keeps", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = opened(self.path)
        fs.create_dir(root, recursive=True)
        done, file, name, rows, size = [], None, "", 0, 0

        def close():
            file.close()
            done.append({"name": name, "rows": rows, "bytes": fs.get_file_info(f"{root}/{name}").size})

        try:
            for batch in iterator:
                at = 0
                while at < batch.num_rows:
                    if file is None:
                        name, rows, size = f"part-{uuid.uuid4().hex}.parquet", 0, 0
                        file = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=fs)
                    piece = batch.slice(at, self.rows - rows)
                    file.write_batch(piece)
                    at, rows, size = at + piece.num_rows, rows + piece.num_rows, size + piece.get_total_buffer_size()
                    if rows >= self.rows or size >= self.bytes:
                        close()
                        file = None
            if file is not None:
                close()
        except BaseException:
            if file is not None:
                file.close()
                done.append({"name": name})
            self.abort([_Written(done)])
            raise
        return _Written(done)

    def commit(self, messages: list) -> None:
        was = manifest(self.path)
        if self.expected is not None and was["generation"] != self.expected:
            self.abort(messages)
            raise RuntimeError(f"generation {self.expected} was replaced meanwhile by {was['generation']}")
        new = [p for m in messages if m for p in m.parts]
        old = [p for p in was["parts"] if not self.replaces or self.least and p["bytes"] >= self.least]
        generation = was["generation"] + 1
        _put(self.path, f"_MANIFEST-{generation}.json", {"generation": generation, "parts": old + new})
        _put(self.path, LAST, {"generation": generation})

    def abort(self, messages: list) -> None:
        fs, root = opened(self.path)
        for m in messages:
            for p in m.parts if m else ():
                if fs.get_file_info(f"{root}/{p['name']}").type == pyarrow.fs.FileType.File:
                    fs.delete_file(f"{root}/{p['name']}")


class PartsSource(DataSource):
    """df.write.format("parts").option("path", folder).mode("append" or "overwrite").save(). Options: rows and bytes of a part at most."""

    @classmethod
    def name(cls) -> str:
        return "parts"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(PartsSource)


def write_parts(df: DataFrame, path: str, replace: bool = False, **options: int) -> None:
    """Adds df to the parts under a path as a new generation, or puts it in their place."""
    register(df.sparkSession)
    df.write.format("parts").options(path=path, replaces=str(replace).lower(), **options).mode("append").save()


def read_parts(spark: SparkSession, path: str, schema: str | None = None, generation: int | None = None) -> DataFrame:
    """The rows of the last generation, or of a given one that is still kept; without parts, none of the given schema."""
    _, root = opened(path)
    base = path.rstrip("/") if "://" in path else root
    names = [f"{base}/{p['name']}" for p in manifest(path, generation)["parts"]]
    if not names:
        return spark.createDataFrame([], schema or "value string")
    return (spark.read.schema(schema) if schema else spark.read).parquet(*names)


def compact(spark: SparkSession, path: str, size: int = MERGED) -> int:
    """Puts files of about `size` bytes in place of the last generation's smaller ones; gives how many tasks wrote them.

    Files of at least half that size stay as they are, so a large table isn't rewritten. It fails, and changes nothing, if others wrote
    meanwhile.
    """
    was = manifest(path)
    small = [p for p in was["parts"] if p["bytes"] < size // 2]
    if len(small) < 2:
        return 0
    register(spark)
    _, root = opened(path)
    base = path.rstrip("/") if "://" in path else root
    n = max(1, -(-sum(p["bytes"] for p in small) // size))
    rows = spark.read.parquet(*[f"{base}/{p['name']}" for p in small]).coalesce(n)
    rows.write.format("parts").options(path=path, replaces="true", expected=was["generation"], keeps=size // 2, rows=1 << 40, bytes=size * 4).mode("append").save()
    return n


def vacuum(path: str, keep: int = 1) -> list[str]:
    """Removes files that none of the last `keep` generations name; gives their names. Not while something is written."""
    fs, root = opened(path)
    last = manifest(path)["generation"]
    named = {p["name"] for g in range(max(1, last - keep + 1), last + 1) for p in manifest(path, g)["parts"]}
    gone = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True)) if f.base_name.startswith("part-") and f.base_name not in named]
    for p in gone:
        fs.delete_file(p)
    return [p.rpartition("/")[2] for p in gone]
