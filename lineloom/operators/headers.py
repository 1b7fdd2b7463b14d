"""The labels of a source by what kind of file it is, and what probes of it show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validate import trim
from .detect import fingerprint, header_labels, header_union, probe_offsets

# What tells an SQL dump by its head, and where its columns are.
COPY_LIST = r"(?i)COPY\s+\S+\s*\(([^)]+)\)\s*FROM\s+stdin"
SQL_HEAD = r"(?i)MYSQL DUMP|^CREATE TABLE|INSERT INTO|POSTGRESQL|PG_DUMP"
CREATE_BLOCK = r"(?is)CREATE TABLE\s[^\n]*\n(.*?)(?:\n\s*\)|$)"
CREATE_COLUMN = r"(?m)^\s*`([^`]+)`\s+\w+"


def copy_columns(head: Column) -> Column:
    """Native: the column list of the first COPY statement, else null."""
    found = F.regexp_extract(head, COPY_LIST, 1)
    names = F.filter(F.transform(F.split(found, ","), lambda c: F.regexp_replace(F.trim(c), r'^["`]+|["`]+$', "")), lambda c: c != "")
    return F.when(found != "", names)


def create_columns(head: Column) -> Column:
    """Native: the quoted names in the first CREATE TABLE, else null."""
    names = F.regexp_extract_all(F.regexp_extract(head, CREATE_BLOCK, 1), F.lit(CREATE_COLUMN), F.lit(1))
    return F.when(F.size(names) > 0, names)


def _whole(text: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith(kind), F.lit(False))


def source_headers(files: DataFrame, lines: DataFrame) -> DataFrame:
    """(source, headers, origin) of files (source, head) with their lines (source, line_no, text).

    The first that applies: the list of a COPY statement; the keys of all objects, one a line, in order of appearance; the keys of the
    objects of an array; the columns of a CREATE TABLE; the cells of a first line that are all labels. Else both are null, so that a
    first row of data is never taken for labels. Keys come from all lines, not from some.
    """
    first = lines.where(trim(F.col("text")) != "").groupBy("source").agg(F.min_by("text", "line_no").alias("_first"))
    base = files.select("source", "head").join(first, "source", "left")
    one = F.trim("_first")
    array = F.when(_whole(one, "ARRAY"), one).when(_whole(F.trim("head"), "ARRAY"), F.trim("head"))
    base = base.select("source", "head", one.alias("_first"), copy_columns(F.col("head")).alias("_copy"), array.alias("_array"))

    t = F.trim("text")
    objects = lines.where(F.startswith(t, F.lit("{"))).where(_whole(t, "OBJECT")).select("source", "line_no", t.alias("text"))
    union = header_union(objects, ["line_no"], ["source"]).withColumnRenamed("headers", "_union")
    items = base.where("_array IS NOT NULL").select("source", F.posexplode(F.from_json("_array", "array<string>")).alias("line_no", "text"))
    listed = header_union(items.where(_whole(F.trim("text"), "OBJECT")), ["line_no"], ["source"]).withColumnRenamed("headers", "_listed")

    found = base.join(union, "source", "left").join(listed, "source", "left")
    sql = F.coalesce(F.col("head").rlike(SQL_HEAD), F.lit(False))
    json_first = F.coalesce(F.col("_first").rlike(r"^[{\[]"), F.lit(False))
    ways = {
        "copy": F.col("_copy"),
        "json-lines": F.when(F.startswith("_first", F.lit("{")), F.col("_union")),
        "json-array": F.col("_listed"),
        "create-table": F.when(sql, create_columns(F.col("head"))),
        "header": F.when(~sql & ~json_first, header_labels(F.col("_first"))),
    }
    origin = F.coalesce(*[F.when(c.isNotNull(), F.lit(k)) for k, c in ways.items()])
    return found.select("source", F.coalesce(*ways.values()).alias("headers"), origin.alias("origin"))


def probe_lines(files: DataFrame, window: Column) -> DataFrame:
    """(source, probe, byte_offset, text): the whole lines within the windows of files (source, content).

    Windows lie where probe_offsets says. The line that a window but the first begins in isn't given, nor the one that it ends in.
    """
    size = F.length("content").cast("long")
    cut = files.select("source", size.alias("_size"), window.cast("int").alias("_window"), probe_offsets(size, window.cast("long")).alias("_at"), "content")
    pieces = cut.select("source", "_size", "_window", F.posexplode(F.transform("_at", lambda o: F.struct(o.alias("at"), F.substring(F.col("content"), o.cast("int") + 1, F.col("_window")).alias("bytes")))).alias("probe", "_p"))
    at, raw = F.col("_p")["at"], F.decode(F.col("_p")["bytes"], "ISO-8859-1")
    parts = F.split(raw, "\n", -1)
    ends = at + F.col("_window") >= F.col("_size")
    skip = (at > 0).cast("int")
    keep = F.size(parts) - F.when(ends & (F.element_at(parts, -1) != ""), 0).otherwise(1) - skip
    whole = F.when(keep > 0, F.slice(parts, skip + 1, F.greatest(keep, F.lit(1))))
    text = F.make_valid_utf8(F.encode(F.regexp_replace(F.col("_line"), "\r$", ""), "ISO-8859-1").cast("string"))
    return pieces.select("source", "probe", at.alias("byte_offset"), F.explode(whole).alias("_line")).select("source", "probe", "byte_offset", text.alias("text"))


def probed_structures(files: DataFrame, window: Column, known: DataFrame | None = None) -> DataFrame:
    """(source, fingerprint, n, probes, sample, template_id): the structures in the windows of each file, once each, with the template
    that is known for them."""
    seen = probe_lines(files, window).where(trim(F.col("text")) != "").withColumn("fingerprint", fingerprint(F.col("text")))
    found = seen.groupBy("source", "fingerprint").agg(F.count("*").alias("n"), F.countDistinct("probe").alias("probes"), F.min("text").alias("sample"))
    if known is None:
        return found.withColumn("template_id", F.lit(None).cast("string"))
    return found.join(known.groupBy("fingerprint").agg(F.min("template_id").alias("template_id")), "fingerprint", "left").select("source", "fingerprint", "n", "probes", "sample", "template_id")
