"""Measures of what passes by: counters and gauges seen while a job runs, and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def key(name: str, tags: dict[str, str] | None = None) -> str:
    """The name of a measure with its tags in order."""
    return ",".join([name, *(f"{k}={v}" for k, v in sorted((tags or {}).items()))])


def observed(df: DataFrame, tags: dict[str, str] | None = None, **measures: Column) -> tuple[DataFrame, Observation]:
    """df, and what its measures come to once it has been computed: no pass of its own over the rows."""
    seen = Observation()
    return df.observe(seen, *[c.alias(key(n, tags)) for n, c in measures.items()]), seen


def verdict_measures() -> dict[str, Column]:
    """Counters of judged lines."""
    v = F.col("verdict")
    return {"lines": F.count("*"), **{k: F.count_if(v == k) for k in ("parsed", "rubbish", "uncertain")}}


def histograms(df: DataFrame, name: str, value: str, tags: list[str]) -> DataFrame:
    """(key, count, min, max, avg) of a value for each combination of tags. Null values don't count; a null tag is named null."""
    named = F.concat_ws(",", F.lit(name), *[F.concat(F.lit(f"{t}="), F.coalesce(F.col(t).cast("string"), F.lit("null"))) for t in sorted(tags)])
    return df.where(F.col(value).isNotNull()).groupBy(named.alias("key")).agg(F.count(value).alias("count"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("avg"))
