"""Sinks: Parquet, CSV, rubbish, manifests, loads that may be repeated, compaction and backfill."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import csv_line
from ..ship import ship
from ..spec import META

ROWS_PER_FILE = 50_000
MERGE_MOST = 64 << 20
#: Loads of up to so many jobs name them, so that other jobs' parts aren't read.
MOST_JOBS = 1000
RUBBISH_COLUMNS = ("line_no", "byte_offset", "byte_length", "raw_bytes", "source", "failure_class", "error", "matched_template_id", "dlq_id")


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    records.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("_job_id").parquet(path)


def csv_lines(parsed: DataFrame, fields: list[str], row: str = "fields") -> DataFrame:
    """One CSV text per row: the fields once each without meta, then meta."""
    names = [*dict.fromkeys(f for f in fields if f != META), META]
    return parsed.select(csv_line(*[F.col(row)[n] for n in names]).alias("value"))


def write_csv(parsed: DataFrame, fields: list[str], path: str, row: str = "fields") -> None:
    _with_heads(csv_lines(parsed, fields, row), [*dict.fromkeys(f for f in fields if f != META), META], path)


def write_rejected(rows: DataFrame, path: str) -> None:
    """What `rejected` gives as CSV, in files of the same form."""
    _with_heads(rows.select(csv_line(*[F.col(c).cast("string") for c in RUBBISH_COLUMNS]).alias("value")), list(RUBBISH_COLUMNS), path)


def _with_heads(values: DataFrame, names: list[str], path: str) -> None:
    """Files that each start with a byte order mark and a header, with CRLF ends."""
    ship(values.sparkSession)
    head = "\ufeff" + ",".join(f'"{n.replace(chr(34), chr(34) * 2)}"' if any(c in n for c in '",\r\n') else n for n in names)

    def with_head(batches):
        yield pa.RecordBatch.from_arrays([pa.array([head], pa.string())], names=["value"])
        yield from (pa.RecordBatch.from_arrays(b.columns, names=["value"]) for b in batches)  # as nullable as the head

    values.mapInArrow(with_head, "value string").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def rejected(rubbish: DataFrame, dead: DataFrame) -> DataFrame:
    """Rubbish and dead letters in one shape."""
    both = rubbish.withColumn("source", F.lit("rubbish")).unionByName(dead.withColumn("source", F.lit("dlq")), allowMissingColumns=True)
    missing = {c: F.lit(None).cast("string") for c in RUBBISH_COLUMNS if c not in both.columns}
    return both.withColumns(missing).select(*RUBBISH_COLUMNS)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files under a path, with their sizes and rows."""
    df = spark.read.parquet(path)
    return df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("byte_size")).groupBy("file_path", "byte_size").agg(F.count("*").alias("n_rows"))


def part_bytes(spark: SparkSession, path: str) -> int:
    return manifest(spark, path).agg(F.coalesce(F.sum("byte_size"), F.lit(0))).first()[0]


def compact(spark: SparkSession, path: str, target: str, size: int | None = None) -> int:
    """Rewrites many small files as few of about MERGE_MOST bytes each; gives their number. The input stays as it is."""
    n = max(1, -(-(part_bytes(spark, path) if size is None else size) // MERGE_MOST))
    spark.read.parquet(path).coalesce(int(n)).write.mode("overwrite").parquet(target)
    return int(n)


def group_files(sizes: DataFrame, total: int, group: str = "_template_id") -> DataFrame:
    """(group, n_files) from rows per group (group, n): its share of all bytes in files of at most about MERGE_MOST."""
    every = sizes.agg(F.sum("n").alias("_all"))
    return sizes.join(F.broadcast(every)).select(group, F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(total)) / F.col("_all") / MERGE_MOST)).cast("int").alias("n_files"))


def compact_groups(spark: SparkSession, path: str, target: str, group: str = "_template_id", key: tuple[str, ...] = ("_job_id", "_byte_offset", "_record_index")) -> int:
    """Rewrites small files by group: one file for all if all of them are small, else a folder per group, whose rows are dealt by key to
    as many files as its bytes need. Gives the number of files that was asked for. The input stays as it is."""
    total = part_bytes(spark, path)
    rows = spark.read.parquet(path)
    if total <= MERGE_MOST:
        rows.coalesce(1).write.mode("overwrite").parquet(target)
        return 1
    plan = group_files(rows.groupBy(group).agg(F.count("*").alias("n")), total, group)
    n = int(plan.agg(F.sum("n_files")).first()[0])
    plan = plan.select(F.col(group).alias("_group"), "n_files")
    dealt = rows.join(plan, F.col(group).eqNullSafe(F.col("_group"))).withColumn("_salt", F.pmod(F.xxhash64(*key), F.col("n_files")))
    dealt.repartition(n, F.col(group), F.col("_salt")).drop("_group", "n_files", "_salt").write.mode("overwrite").partitionBy(group).parquet(target)
    return n


def recovered(dead: DataFrame, fields: Column, now) -> DataFrame:
    """Dead letters that were put right by hand, as records: fields (a map) is what each has become. Their part is named recovered."""
    text = F.to_json(F.map_filter(fields, lambda k, v: ~F.startswith(k, F.lit("_"))), {"ignoreNullFields": "false"})
    zero = lambda c, kind: F.coalesce(F.col(c).cast(kind), F.lit(0).cast(kind))
    return dead.select(F.col("job_id").alias("_job_id"), zero("byte_offset", "long").alias("_byte_offset"), zero("byte_length", "int").alias("_byte_length"), F.lit(0).cast("long").alias("_record_index"), zero("line_no", "long").alias("_line_no"), F.lit("unknown").alias("_template_id"), F.lit(1).alias("_template_version"), F.lit("").alias("_checksum"), F.lit(now).cast("timestamp").alias("_parsed_at"), F.lit("recovered").alias("_part_id"), text.alias("fields"))


def write_reports(reports: DataFrame, path: str, by: str = "job_id") -> None:
    """A folder per job with its report as a line of JSON."""
    reports.select(by, "report").write.mode("overwrite").partitionBy(by).text(path)


def new_rows(incoming: DataFrame, existing: DataFrame | None, key: tuple[str, ...] = ("_job_id", "_byte_offset", "_record_index")) -> DataFrame:
    """Rows whose key isn't loaded yet, one for each key: a load may be repeated. Nulls in a key are equal."""
    one = incoming.dropDuplicates(list(key))
    if existing is None:
        return one
    there = existing.select(*[F.col(k).alias(f"_have_{k}") for k in key])
    on = F.lit(True)
    for k in key:
        on &= one[k].eqNullSafe(there[f"_have_{k}"])
    return one.join(there, on, "left_anti")


def load(records: DataFrame, table: str, fields: str = "fields") -> None:
    """Appends to a table what isn't there yet; columns that the table lacks are left out. The table is parted by job, and only the parts
    of the jobs that are loaded are looked at. The JSON text of the fields is stored as a variant, unless the table has it as text."""
    spark = records.sparkSession
    typed = as_variant(records, fields) if dict(records.dtypes).get(fields) == "string" else records
    if not spark.catalog.tableExists(table):
        as_is = new_rows(records, None)
        (as_variant(as_is, fields) if typed is not records else as_is).write.partitionBy("_job_id").saveAsTable(table)
        return
    there = spark.table(table)
    own = [r[0] for r in records.select("_job_id").distinct().limit(MOST_JOBS + 1).collect()]
    if len(own) <= MOST_JOBS:
        there = there.where(F.col("_job_id").isin([j for j in own if j is not None]) | F.col("_job_id").isNull())
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    new = new_rows(records, there)
    if typed is not records and dict(there.dtypes).get(fields) == "variant":
        new = as_variant(new, fields)
    rows = new.select(*[c for c in there.columns if c in records.columns]).write.mode("append")
    (rows.partitionBy(*parts) if parts else rows).saveAsTable(table)


def as_variant(records: DataFrame, fields: str = "fields") -> DataFrame:
    """The JSON text of the fields as a variant, unreadable text as null."""
    return records.withColumn(fields, F.try_parse_json(fields))


def backfill_lines(parts: DataFrame, records: DataFrame, dead: DataFrame, rubbish: DataFrame, job: str = "_job_id", offset: str = "_byte_offset", line: str = "_line_no") -> DataFrame:
    """Line numbers of rows by their offset: rubbish knows best, then dead letters, then records; unknown ones stay."""
    known = None
    for rank, df in enumerate((records, dead, rubbish)):
        own = df.select(F.col(job), F.col(offset), F.col(line).alias("_known"), F.lit(rank).alias("_rank")).where("_known > 0")
        known = own if known is None else known.unionByName(own)
    best = known.groupBy(job, offset).agg(F.max_by("_known", "_rank").alias("_known"))
    return parts.join(best, [job, offset], "left").withColumn(line, F.coalesce("_known", line)).drop("_known")


def reprocess(dead: DataFrame, classes: list[str], most_attempts: int = 3) -> DataFrame:
    """Dead letters to try again: of the given classes, still pending, with attempts left."""
    return dead.where(F.col("failure_class").isin(*classes) & (F.col("status") == "pending") & (F.col("attempts") < most_attempts)).withColumn("attempts", F.col("attempts") + 1)


def update_where(df: DataFrame, when: str, **values) -> DataFrame:
    """A new snapshot in which rows that meet a condition have other values."""
    return df.withColumns({c: F.when(F.expr(when), v if not isinstance(v, (str, int, float, bool, type(None))) else F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def compare_and_set(df: DataFrame, changes: DataFrame, key: str = "job_id") -> DataFrame:
    """changes (key, expected, status) applied where the status is the expected one."""
    c = changes.select(F.col(key), F.col("expected").alias("_expected"), F.col("status").alias("_status"))
    return df.join(c, key, "left").withColumn("status", F.when(F.col("_expected") == F.col("status"), F.col("_status")).otherwise(F.col("status"))).drop("_expected", "_status")


def page(df: DataFrame, order: list, offset: int = 0, limit: int = 100) -> DataFrame:
    return df.orderBy(*order).offset(max(0, offset)).limit(min(500, max(1, limit)))


def lookup(df: DataFrame, order: list | None = None, limit: int | None = None, **equal) -> DataFrame:
    """Rows whose columns equal values, in order, at most so many."""
    for c, v in equal.items():
        df = df.where(F.col(c).isin(*v) if isinstance(v, (list, tuple)) else F.col(c).eqNullSafe(F.lit(v)))
    df = df.orderBy(*order) if order else df
    return df if limit is None else df.limit(limit)


def last_of(df: DataFrame, by: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
