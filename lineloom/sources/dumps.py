"""Rows of SQL dumps: MySQL's INSERT statements and PostgreSQL's COPY blocks, each as an object in JSON."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.mapping import dump, load
from ..operators.windows import in_block, running
from ..ship import ship

MYSQL_HEAD = r"(?i)MYSQL DUMP|^\s*(CREATE TABLE|INSERT INTO)"
POSTGRES_HEAD = r"(?i)POSTGRESQL|PG_DUMP|^COPY\s+\S+\s*\("
COPY = r"(?i)^COPY\s+(\S+)\s*\((.*)\)\s+FROM\s+stdin"
_NOT_COLUMNS = re.compile(r"^\s*(PRIMARY|UNIQUE|KEY|INDEX|CONSTRAINT|FOREIGN|CHECK|FULLTEXT|SPATIAL)\b", re.I)
_NUMBER = re.compile(r"^-?\d+(\.\d+)?$")


def kind(head: Column) -> Column:
    """json, mysql, postgres or null, by the head of a file. JSON comes first, then MySQL."""
    t = F.ltrim(head)
    return F.when(F.startswith(t, F.lit("{")) | F.startswith(t, F.lit("[")), "json").when(head.rlike(MYSQL_HEAD), "mysql").when(head.rlike(POSTGRES_HEAD), "postgres")


def split_top(text: str, separator: str = ",") -> list[str]:
    """Cuts at separators outside of quotes and parentheses."""
    out, start, depth, quote, i = [], 0, 0, "", 0
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\" and quote != "`":
                i += 1
            elif c == quote:
                if text[i + 1 : i + 2] == quote:
                    i += 1
                else:
                    quote = ""
        elif c in "'\"`":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == separator and depth == 0:
            out.append(text[start:i])
            start = i + 1
        i += 1
    return [*out, text[start:]]


def table_columns(statement: str) -> list[str]:
    """The columns of a CREATE TABLE statement."""
    start, end = statement.find("("), statement.rfind(")")
    if start < 0 or end < start:
        return []
    parts = [p.strip() for p in split_top(statement[start + 1 : end])]
    return [re.split(r"\s", p, maxsplit=1)[0].strip("`\"[]") if p[0] not in "`\"" else p[1 : p.find(p[0], 1)] for p in parts if p and not _NOT_COLUMNS.match(p)]


def insert_columns(statement: str) -> list[str]:
    m = re.match(r"(?is)\s*INSERT\s+(?:IGNORE\s+)?INTO\s+[^\s(]+\s*\(([^)]*)\)\s*VALUES", statement)
    return [c.strip().strip("`\"'") for c in m[1].split(",")] if m else []


def value(text: str):
    """NULL is null, quoted text is unescaped, plain numbers are numbers, the rest stays."""
    t = text.strip()
    if t.upper() == "NULL":
        return None
    if len(t) > 1 and t[0] == t[-1] == "'":
        return re.sub(r"\\(['\"\\])|''", lambda m: m[1] or "'", t[1:-1])
    return load(t) if _NUMBER.match(t) and not re.match(r"^-?0\d", t) else t


def insert_rows(statement: str, columns: list[str]) -> list[tuple[dict, int]]:
    """(object, place in the statement) of each tuple; values without a column go to meta."""
    m = re.search(r"(?i)\bVALUES\b", statement)
    if not m:
        return []
    names = insert_columns(statement) or columns
    out, at = [], m.end()
    for part in split_top(statement[at:].rstrip().rstrip(";")):
        place = at + len(part) - len(part.lstrip())
        at += len(part) + 1
        p = part.strip()
        if p.startswith("(") and p.endswith(")"):
            vals = [value(v) for v in split_top(p[1:-1])]
            row = dict(zip(names, vals))  # noqa: B905
            if len(vals) > len(names):
                row["meta"] = vals[len(names) :]
            out.append((row, place))
    return out


def mysql_rows(lines: DataFrame) -> DataFrame:
    """(source, byte_offset, line_no, table, text): a row per tuple of the statements that can be read."""
    return mysql_all(lines).where("error IS NULL").drop("error")


def mysql_all(lines: DataFrame) -> DataFrame:
    """(source, byte_offset, line_no, table, text, error): a row per tuple; an INSERT that can't be read gives itself and an error.

    A statement ends with a line that ends with ; outside of quotes. Blank lines and comments count only between quotes. Quotes and
    statements are counted along each file by stretches, so no task holds a dump; a task holds a statement.
    """
    ship(lines.sparkSession)
    blank = F.col("text").rlike(r"^\s*(--|/\*|#)") | (F.trim("text") == "")
    bare = F.regexp_replace("text", r"\\.", "")
    quotes = F.when(blank, 0).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit("'"), F.lit(""))))
    own = running(lines.withColumn("_blank", blank), ["source"], "line_no", sums={"_quotes": quotes.cast("long")})
    own = own.where(~F.col("_blank") | (F.col("_quotes") % 2 == 1))
    ends = (F.rtrim("text").endswith(";") & (F.col("_quotes") % 2 == 0)).cast("long")
    # a statement's number is that of the ends before it
    own = running(own.withColumn("_end", ends), ["source"], "line_no", sums={"statement": F.col("_end")})
    own = own.withColumn("statement", F.col("statement") - F.col("_end"))
    whole = own.groupBy("source", "statement").agg(F.min("byte_offset").alias("byte_offset"), F.min("line_no").alias("line_no"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), " ").alias("sql"))
    name = F.regexp_extract("sql", r"(?i)^\s*(?:CREATE TABLE(?:\s+IF NOT EXISTS)?|INSERT\s+(?:IGNORE\s+)?INTO)\s+[`\"]?([^`\"\s(]+)", 1)
    whole = whole.withColumn("table", name)
    creates = whole.where(F.col("sql").rlike(r"(?i)^\s*CREATE TABLE")).groupBy("source", "table").agg(F.max_by("sql", "statement").alias("create"))
    inserts = whole.where(F.col("sql").rlike(r"(?i)^\s*INSERT\s")).join(creates, ["source", "table"], "left")

    def run(batches):
        for b in batches:
            out = []
            for source, table, offset, no, sql, create in zip(*(b.column(c).to_pylist() for c in ("source", "table", "byte_offset", "line_no", "sql", "create")), strict=True):
                try:
                    rows, error = insert_rows(sql, table_columns(create) if create else []), "no tuples"
                except (ValueError, IndexError) as e:
                    rows, error = [], type(e).__name__
                if rows:
                    out += [(source, (offset or 0) + at, no, table, dump(row), None) for row, at in rows]
                else:
                    out.append((source, offset, no, table, sql, f"unreadable_statement: {error}"))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=["source", "byte_offset", "line_no", "table", "text", "error"])

    return inserts.mapInArrow(run, "source string, byte_offset long, line_no long, table string, text string, error string")


def copy_value(c: Column) -> Column:
    """A cell of a COPY block: \\N is null; escapes are undone in the order \\\\, \\n, \\t, \\r."""
    s = c
    for a, b in (("\\\\", "\\"), ("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.when(c == "\\N", F.lit(None)).otherwise(s)


def copy_rows(lines: DataFrame) -> DataFrame:
    """Native: (source, line_no, table, columns, cells, fields) of the rows within COPY blocks."""
    start, stop = F.col("text").rlike(COPY), F.col("text") == "\\."
    flagged = running(lines, ["source"], "line_no", lasts={"_in": in_block(start, stop), "_head": F.when(start, F.col("text"))})
    rows = flagged.where(F.col("_in") & ~start & ~stop)
    cols = F.transform(F.split(F.regexp_extract("_head", COPY, 2), ","), lambda c: F.replace(F.trim(c), F.lit('"'), F.lit("")))
    rows = rows.withColumns({"table": F.regexp_extract("_head", COPY, 1), "columns": cols, "cells": F.transform(F.split("text", "\t", -1), copy_value)})
    n = F.size("columns")
    padded = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("cells"), i))
    surplus = F.when(F.size("cells") > n, F.slice("cells", n + 1, F.greatest(F.size("cells") - n, F.lit(0))))
    return rows.select("source", "line_no", "table", "columns", "cells", F.map_from_arrays("columns", padded).alias("fields"), surplus.alias("meta"))


#: Cells that stand for nothing.
EMPTY = ("", "\\N", "NULL", "null", "N/A", "NA", "[CHARACTER_NOT_ALLOWED]")


def cleaned(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.isin(*EMPTY) | t.rlike(r"^[-_*?\s]+$"), F.lit(None)).otherwise(t)


def copy_cell(c: Column) -> Column:
    """A cell of a COPY row as a value: what stands for nothing is null."""
    return cleaned(c)


def dump_stage(lines: DataFrame) -> DataFrame:
    """Within PostgreSQL dumps: the stage of each line, pg-dump-start, pg-copy-start, pg-copy, pg-copy-end or pg-sql-junk; else null.

    copy_head is the last COPY statement at or before the line.
    """
    t = F.col("text")
    begin = t.rlike("^\\s*-- PostgreSQL database dump")
    start, stop = t.rlike(COPY), t.rlike(r"^\s*\\\.\s*$")
    flagged = running(lines, ["source"], "line_no", lasts={"_dump": F.when(begin, True), "_in": in_block(start, stop), "copy_head": F.when(start, t)})
    stage = F.when(F.col("_dump").isNull(), F.lit(None)).when(begin, "pg-dump-start").when(start, "pg-copy-start").when(stop, "pg-copy-end").when(F.col("_in"), "pg-copy").otherwise("pg-sql-junk")
    return flagged.withColumn("stage", stage).drop("_dump", "_in")


def project_known(rows: DataFrame, fields: list[str], text: str = "text") -> DataFrame:
    """Native fast path: fields by the columns' own names; what isn't asked for is meta, the whole object if nothing is met."""
    wanted = [f for f in fields if f != "meta"]
    out = {f: F.get_json_object(text, f"$.{f}") for f in wanted}
    rest = F.map_filter(F.from_json(text, "map<string,string>"), lambda k, v: ~k.isin(*wanted)) if wanted else F.from_json(text, "map<string,string>")
    met = reduce(Column.__or__, [c.isNotNull() for c in out.values()], F.lit(False))
    return rows.withColumns({**out, "meta": F.when(~met, F.col(text)).when(F.size(rest) > 0, F.to_json(rest, {"ignoreNullFields": "false"}))})


def copy_objects(lines: DataFrame) -> DataFrame:
    """Native: (source, line_no, table, text): each row of a COPY block as an object in JSON. Cells that are plain numbers are numbers."""

    def quoted(c: Column) -> Column:
        listed = F.to_json(F.array(c))
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    def said(c: Column) -> Column:
        return F.when(c.isNull(), "null").when(c.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?$"), c).otherwise(quoted(c))

    rows = copy_rows(lines)
    pairs = F.transform(F.map_entries("fields"), lambda x: F.concat(quoted(x["key"]), F.lit(":"), said(x["value"])))
    more = F.when(F.size("meta") > 0, F.array(F.concat(F.lit('"meta":['), F.array_join(F.transform("meta", said), ","), F.lit("]")))).otherwise(F.array().cast("array<string>"))
    return rows.select("source", "line_no", "table", F.concat(F.lit("{"), F.array_join(F.concat(pairs, more), ","), F.lit("}")).alias("text"))
