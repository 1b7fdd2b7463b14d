"""Whole JSON files: a record per element of an array, per value of an object, or one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHOLE_MOST = 200 << 20


def is_whole(c: Column) -> Column:
    """Whether a text is one JSON array or object. Several in a row, as in NDJSON, aren't: parsing alone would see the first only."""
    t = F.trim(F.regexp_replace(c, r"^[\s\ufeff]+|\s+$", ""))
    first = F.substring_index(t, "\n", 1)
    closed = (F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}"))) | (F.startswith(t, F.lit("[")) & F.endswith(t, F.lit("]")))
    return F.coalesce(closed & F.try_parse_json(t).isNotNull() & ((F.length(first) == F.length(t)) | F.try_parse_json(first).isNull()), F.lit(False))


def explode_document(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep..., record_index, record): arrays by element; objects by value, whose arrays are opened too. Order is kept."""
    t = F.trim(F.col(text))
    whole = F.try_parse_json(t)
    is_array = F.schema_of_variant(whole).startswith("ARRAY")
    is_object = F.schema_of_variant(whole).startswith("OBJECT")
    elements: Column = F.from_json(t, "array<string>")
    values = F.map_values(F.from_json(t, "map<string,string>"))
    opened = F.flatten(F.transform(values, lambda v: F.when(F.startswith(F.trim(v), F.lit("[")), F.from_json(v, "array<string>")).otherwise(F.array(v))))
    records = F.when(is_array, elements).when(is_object, opened).when(whole.isNotNull(), F.array(t))
    return df.where(F.octet_length(text) <= WHOLE_MOST).select(*keep, F.posexplode(records).alias("record_index", "record"))


def too_large(df: DataFrame, text: str, keep: list[str], most: int | None = None) -> DataFrame:
    """(keep..., error) of the documents that explode_document leaves out for their size."""
    most = WHOLE_MOST if most is None else most
    return df.where(F.octet_length(text) > most).select(*keep, F.format_string(f"too_large: a JSON document of %d bytes, at most {most} are read whole", F.octet_length(text).cast("long")).alias("error"))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(source, record_index, record) of whole files."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")
    return explode_document(files, "value", ["source"])
