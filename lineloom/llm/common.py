"""What the operators of this subpackage share: tables, scratch space, sizing and packed shuffles."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship

#: Spark's setting that removes an action's shuffle files at its end; a later read of them would run their stages again.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: So many slim rows (some 32 MB) are sent to all tasks, so that texts needn't be shuffled to meet them.
SENT = 1 << 20
#: Where the paths of tables go that cut writes, within passing.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)
WHITE = " \t\n\x0b\x0c\r"  # the word separators of every operator here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Bounds what one Arrow batch may hold: whole texts differ in size by five orders of magnitude."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    # unions of joins whose sides adaptive execution splits differently fail where a union keeps its children's partitioning
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def scratch(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is spark.checkpoint.dir. Only where that isn't set and all runs on one machine, as in tests, a temporary folder serves.
    """
    if not (path := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lineloom-")
        atexit.register(__import__("shutil").rmtree, path, True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when these end; else they fill the disk until the driver happens to collect its garbage.

    Only for actions that give all they give before they return.
    """
    old = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if old is None else spark.conf.set(RELEASE, old)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """df, written to the shared folder and read again: a lost executor costs no recomputation of what came before."""
    path = f"{scratch(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    with released(df.sparkSession):
        df.write.parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that cut writes inside are deleted at its end, so nothing that is read later may come from them.

    What it gives is a cut whose tables stay.
    """
    outer, made = _MADE.get(), []
    token = _MADE.set(made)

    def stays(df: DataFrame, tag: str) -> DataFrame:
        inner = _MADE.set(outer)
        try:
            return cut(df, tag)
        finally:
            _MADE.reset(inner)

    try:
        yield stays
    finally:
        _MADE.reset(token)
        for x in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(x)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(rows: DataFrame, gone: DataFrame, on: dict[str, str], most: int | None = None) -> DataFrame:
    """rows but for those that agree with a row of gone, nulls with nulls; on: columns of rows by those of gone, which are slim.

    While gone has at most `most` rows, or SENT, it is sent to all tasks and rows stay where they are.
    """
    with released(rows.sparkSession):
        few = gone.count() <= (SENT if most is None else most)
    gone = F.broadcast(gone) if few else gone.hint("shuffle_hash")
    same = [rows[there].eqNullSafe(gone[here]) for here, there in on.items()]
    return rows.join(gone, reduce(Column.__and__, same), "left_anti")


def hidden(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[..., DataFrame]]:
    """df under names that no operator uses; those names by the old ones; and a function that gives the old ones back.

    back(out, new) has the old columns, but for those of the same name as new ones, and then the new ones.
    """
    names = df.columns
    at = {n: f"in{i}_" for i, n in enumerate(names)}

    def back(out: DataFrame, new: tuple[str, ...] = ()) -> DataFrame:
        return out.select(*[out[at[n]].alias(n) for n in dict.fromkeys(names) if n not in new], *new)

    return df.toDF(*[f"in{i}_" for i in range(len(names))]), at, back


def at_groups(rows: DataFrame, groups: DataFrame, key: str, n: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """rows joined to groups, which have a row per key and the number n of rows that have it. total: the number of rows, if known.

    Keys of over a thousandth of all rows, and over 100 rows, are at most 1000; their groups are sent to all tasks, so
    no task gets all rows of a hot key. The others are joined by key.
    """
    tune(rows.sparkSession)
    with released(rows.sparkSession):
        bound = max(100, (rows.count() if total is None else total) // 1000)
    hot = groups.where(F.col(n) > bound)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.where(F.col(n) <= bound), key, how)
    return cold.unionByName(rows.join(F.broadcast(hot), key))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, n: str) -> DataFrame:
    """rows left-joined to groups, as in at_groups."""
    return at_groups(rows, groups, key, n, how="left")


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of df, from the sizes of its files. Starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets(df: DataFrame, each: int) -> int:
    """How many hash buckets to deal df into, so that one holds about `each` bytes of it."""
    return int(min(1 << 22, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), plan_bytes(df) // each + 1)))


def tasks(df: DataFrame, each: int = 32 << 20) -> int:
    """Into how many tasks to deal df, so that one reads about `each` bytes of its files; at least the session's number of them.

    Of what isn't read from files, and of products of joins, Catalyst knows no size but states a huge one: that gives the session's number.
    """
    least, size = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), plan_bytes(df)
    return least if size >= 1 << 50 else int(min(1 << 17, max(least, size // each + 1)))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary() if pa.types.is_large_string(batch.schema.field(name).type) else pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], most: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what Python makes of them stays small."""
    for b in batches:
        for k in range(0, b.num_rows, most):
            yield b.slice(k, most)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_keys(n: int, seed: int) -> np.ndarray:
    """n odd uint64 factors."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def runs(starts_new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a sorted array's 'differs from the one before' flags: where each run starts, and its length."""
    at = np.flatnonzero(starts_new)
    return at, np.diff(np.append(at, len(starts_new)))


Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
