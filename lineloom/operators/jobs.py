"""Jobs: states, transitions from events, and what has come to a stand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What may follow what.
FOLLOWS = {
    "Created": ("Ingesting", "Detecting", "Failed"),
    "Ingesting": ("Needs Password", "Detecting", "Completed", "Failed"),
    "Needs Password": ("Detecting", "Failed"),
    "Detecting": ("Detecting", "Parsing", "Failed"),
    "Parsing": ("Merging Output", "Failed"),
    "Merging Output": ("Saving to Database", "On Hold", "Failed"),
    "Saving to Database": ("Reporting", "Failed"),
    "Reporting": ("Completed", "Partial", "Failed"),
    "On Hold": ("Saving to Database", "Failed"),
    "Failed": ("Ingesting", "Detecting", "Parsing", "Saving to Database", "Reporting"),
    "Completed": (),
    "Partial": (),
}


def allowed(current: str, new: str) -> bool:
    return new in FOLLOWS.get(current, ())


def allowed_column(current: Column, new: Column) -> Column:
    """Native form of allowed."""
    pairs = [f"{a}>{b}" for a, bs in FOLLOWS.items() for b in bs]
    return F.concat_ws(">", current, new).isin(*pairs)


def fold(events: DataFrame, job: str = "job_id", order: tuple[str, ...] = ("timestamp", "event_id"), new: str = "status") -> DataFrame:
    """(job, status, applied, ignored): each job's events in order, those that don't follow ignored. A job has few events."""
    e = events.dropDuplicates(["event_id"]).groupBy(job).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(new).alias("s")))).alias("e"))
    start = F.struct(F.lit("Created").alias("status"), F.lit(0).alias("applied"), F.lit(0).alias("ignored"))

    def step(acc: Column, x: Column) -> Column:
        ok = allowed_column(acc["status"], x["s"])
        return F.struct(F.when(ok, x["s"]).otherwise(acc["status"]).alias("status"), (acc["applied"] + ok.cast("int")).alias("applied"), (acc["ignored"] + (~ok).cast("int")).alias("ignored"))

    return e.select(job, F.aggregate("e", start, step).alias("r")).select(job, "r.*")


def stuck(jobs: DataFrame, now: Column, hours: int = 2, statuses: tuple[str, ...] = ("Ingesting",), at: str = "updated_at") -> DataFrame:
    """Jobs that haven't moved for some hours."""
    return jobs.where(F.col("status").isin(*statuses) & (F.col(at) < now - F.expr(f"INTERVAL {int(hours)} HOURS")))


def children(entries: DataFrame, parent: str = "job_id", entry: str = "entry") -> DataFrame:
    """A child job per archive entry; its id is a hash, so a repeated discovery makes none anew."""
    return entries.dropDuplicates([parent, entry]).select(F.sha2(F.concat_ws("\x1f", parent, entry), 256).alias("job_id"), F.col(parent).alias("parent_job_id"), F.col(entry).alias("source_ref"), F.lit("archive_entry").alias("source_type"), F.lit("Created").alias("status"))


def parents_done(entries: DataFrame, parent: str = "job_id") -> DataFrame:
    """Parents without an open entry: failed if an entry failed, else completed."""
    s = F.col("status")
    per = entries.groupBy(parent).agg(F.count_if(s.isin("pending", "processing")).alias("open"), F.count_if(s == "failed").alias("failed"))
    return per.where("open = 0").select(parent, F.when(F.col("failed") > 0, "failed").otherwise("completed").alias("status"))


def load_queue(size: Column) -> Column:
    """small up to 25 MB, large over 100 MB, else default."""
    return F.when(size <= 25 << 20, "small").when(size > 100 << 20, "large").otherwise("default")
