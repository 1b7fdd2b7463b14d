"""Counts, summaries, gates, reports and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import WIDTH, over_last

TERMINAL = ("Completed", "Partial", "On Hold", "Failed")
#: In order of progress.
STATUSES = ("Created", "Ingesting", "Needs Password", "Detecting", "Parsing", "Merging Output", "Saving to Database", "Reporting", "Completed", "Partial", "On Hold", "Failed")
RATIO_MOST, HOLD_MOST = 0.7, 0.05
SHOWN = 500


def _counts(df: DataFrame, by: list[str], key: str, n: Column) -> DataFrame:
    """A map of counts per key; counts are made per key first, so a group is as small as its number of keys."""
    return df.groupBy(*by, key).agg(n.alias("_n")).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(key, "_n"))).alias("map"))


def job_counts(classified: DataFrame, by: list[str]) -> DataFrame:
    """parsed, dropped_rubbish, failed_by_class and total_failed per job."""
    v = F.col("verdict")
    per = classified.groupBy(*by, "failure_class").agg(F.count_if(v == "parsed").alias("p"), F.count_if(v == "rubbish").alias("r"), F.count_if(v == "uncertain").alias("u"))
    entries = F.filter(F.collect_list(F.struct("failure_class", "u")), lambda x: x["failure_class"].isNotNull() & (x["u"] > 0))
    return per.groupBy(*by).agg(F.sum("p").alias("parsed"), F.sum("r").alias("dropped_rubbish"), F.map_from_entries(entries).alias("failed_by_class"), F.sum("u").alias("total_failed"))


def verdict_distribution(classified: DataFrame, every: int = 10_000) -> DataFrame:
    """Counts by template, or verdict, per stretch of lines."""
    return classified.groupBy(F.floor((F.col("line_no") - 1) / every).alias("stretch"), F.coalesce("template_id", "verdict").alias("key")).agg(F.count("*").alias("n"))


def template_usage(records: DataFrame, by: list[str], template: str = "_template_id") -> DataFrame:
    return records.groupBy(*by, template).agg(F.count("*").alias("n"))


def rejected_summary(rows: DataFrame, by: list[str], key: str, line: str = "line_no", most: int = SHOWN) -> DataFrame:
    """Count, the first line numbers, whether some are left out, and counts per key, of rubbish or dead letters.

    Line numbers are ranked within stretches first, so a job of any size sends few of them to one place.
    """
    from pyspark.sql import Window

    total = rows.groupBy(*by).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by, F.floor(F.col(line) / 10_000)).orderBy(line)
    some = rows.select(*by, line).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
    w = Window.partitionBy(*by).orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    stretch = rows.groupBy(*by, (F.floor(F.col(line) / 10_000)).alias("_low")).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).where(F.col("_before") < most)
    some = some.withColumn("_low", F.floor(F.col(line) / 10_000)).join(stretch, [*by, "_low"])
    lines = some.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(line)), 1, most).alias("line_numbers"))
    return total.join(lines, by).join(_counts(rows, by, key, F.count("*")), by).select(*by, "n", "line_numbers", (F.col("n") > most).alias("truncated"), F.col("map").alias(f"by_{key}"))


def quality_metrics(counts: DataFrame) -> DataFrame:
    """Adds total_lines (rubbish left out), failed_ratio, and both gates.

    passes: a parsed line is enough, else at most 70 % may have failed. on_hold: over 5 % of all lines failed.
    """
    total = F.col("parsed") + F.col("total_failed")
    every = total + F.col("dropped_rubbish")
    ratio = F.when(total > 0, F.col("total_failed") / total).otherwise(F.lit(0.0))
    return counts.withColumns({"total_lines": total, "failed_ratio": ratio, "passes": (F.col("parsed") >= 1) | (ratio <= RATIO_MOST), "on_hold": F.when(every > 0, F.col("total_failed") / every > HOLD_MOST).otherwise(F.lit(False))})


def report(jobs: DataFrame, counts: DataFrame, parts: DataFrame, by: str = "job_id") -> DataFrame:
    """(job_id, report): counts, quality, parts and status of each job, as JSON."""
    files = parts.groupBy(by).agg(F.count("*").alias("n_parts"), F.sum("byte_size").alias("bytes"))
    all_ = jobs.join(quality_metrics(counts), by, "left").join(files, by, "left")
    body = F.struct(by, "status", F.struct("parsed", "dropped_rubbish", "failed_by_class").alias("counts"), F.struct("total_lines", "failed_ratio", "passes", "on_hold").alias("quality"), F.struct("n_parts", "bytes").alias("output"))
    return all_.select(by, F.to_json(body).alias("report"))


def batch_rollup(jobs: DataFrame, batch: str = "batch_id", only_finished: bool = True) -> DataFrame:
    """Totals of batches whose jobs have all come to an end."""
    done = F.col("status").isin(*TERMINAL)
    per = jobs.groupBy(batch, "status").agg(F.count("*").alias("n"), F.sum("parsed").alias("p"), F.sum("dropped_rubbish").alias("d"), F.bool_and(done).alias("done"))
    out = per.groupBy(batch).agg(F.sum("n").alias("n_jobs"), F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias("by_status"), F.sum("p").alias("parsed"), F.sum("d").alias("dropped_rubbish"), F.bool_and("done").alias("finished"))
    return out.where("finished") if only_finished else out


def batch_stats(jobs: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Jobs per status, by the names that are in use."""
    s = F.col("status")
    return jobs.groupBy(batch).agg(F.count("*").alias("total"), F.count_if(s == "Completed").alias("completed"), F.count_if(s == "Failed").alias("failed"), F.count_if(s == "Partial").alias("partial"), F.count_if(~s.isin(*TERMINAL)).alias("active"))


def parent_merge(children: DataFrame, parent: str = "parent_job_id") -> DataFrame:
    """What an archive's job has from its entries: summed counts, united headers, first start and last end, and a status.

    While entries are active the earliest of their states counts; else Completed, Failed if all failed, or Partial.
    """
    order = F.create_map(*[x for i, s in enumerate(STATUSES) for x in (F.lit(s), F.lit(i))])
    s = F.col("status")
    active = ~s.isin(*TERMINAL)
    out = children.groupBy(parent).agg(
        F.count("*").alias("n_children"), F.sum("parsed").alias("parsed"), F.sum("dropped_rubbish").alias("dropped_rubbish"), F.sum("total_failed").alias("total_failed"), F.min("started_at").alias("started_at"), F.max("completed_at").alias("completed_at"),
        F.count_if(active).alias("_active"), F.min_by(F.when(active, s), F.when(active, order[s])).alias("_earliest"), F.count_if(s == "Completed").alias("_done"), F.count_if(s == "Failed").alias("_failed"),
    )
    status = F.when(F.col("_active") > 0, F.col("_earliest")).when(F.col("_done") == F.col("n_children"), "Completed").when(F.col("_failed") == F.col("n_children"), "Failed").otherwise("Partial")
    return out.withColumn("status", status).drop("_active", "_earliest", "_done", "_failed")


def united(children: DataFrame, by: str, values: str, out: str) -> DataFrame:
    """The distinct elements of arrays per key, sorted."""
    return children.select(by, F.explode(values).alias("_v")).distinct().groupBy(by).agg(F.array_sort(F.collect_list("_v")).alias(out))


def entry_counts(entries: DataFrame, by: str = "job_id") -> DataFrame:
    """Archive entries per job; those being processed are open too."""
    s = F.col("status")
    return entries.groupBy(by).agg(F.count("*").alias("total"), F.count_if(s.isin("pending", "processing")).alias("open"), F.count_if(s == "completed").alias("completed"), F.count_if(s == "failed").alias("failed"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"))


def match_rate(df: DataFrame, by: list[str], order: str, hit: Column, n: int = 1000, width: int = WIDTH) -> DataFrame:
    """The share of hits among the last n rows, in order of a number that starts near 1."""
    return over_last(df.withColumn("_hit", hit.cast("double")), by, order, {"match_rate": (F.avg("_hit"), -(n - 1), 0)}, width).drop("_hit")
