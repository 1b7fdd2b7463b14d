"""Which column holds which field, where a source has no header: profiles of columns, and an assignment of least cost."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validate import is_email, is_phone
from ..ship import ship
from ..spec import FieldSpec, category, denied, guessed_map
from .cells import best_delimiter, bound

#: What a column can look like. A value counts for the first of these that it is.
KINDS = ("blank", "email", "url", "date", "number", "phone", "name", "word", "text")
#: How well a kind of value goes with a field; what isn't here doesn't.
FITS = {
    "email": {"email": 1.0}, "phone": {"phone": 1.0}, "url": {"url": 1.0}, "name": {"name": 1.0, "word": 0.4}, "date": {"date": 1.0}, "number": {"number": 1.0, "phone": 0.2},
    "text": {"text": 0.6, "word": 0.6, "name": 0.3},
}
#: A field stays without a column rather than take one that fits less than this.
LEAST = 0.5
Guess = Callable[[list[dict], list[str]], dict[str, int]]


def kind_of_value(c: Column) -> Column:
    """Native: the first of KINDS that a cell is."""

    def kind(t: Column) -> Column:
        return F.coalesce(*[F.when(test, F.lit(k)) for k, test in tests(t).items()], F.lit("text"))

    tests = lambda t: {
        "blank": t == "", "email": is_email(t), "url": t.rlike(r"^(https?://|www\.)\S+$"), "date": t.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$|^\d{1,2}[./]\d{1,2}[./]\d{2,4}$"),
        "number": t.rlike(r"^-?\d{1,9}([.,]\d+)?$"), "phone": is_phone(t), "name": t.rlike(r"^\p{Lu}[\p{L}'.-]+( \p{Lu}[\p{L}'.-]*){1,3}$"), "word": t.rlike(r"^[\p{L}\p{N}_#-]+$"),
    }
    return bound(F.trim(c), kind)


def profiles(lines: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """(by, delimiter, columns): per source under the delimiter that most of its lines have, an array by place of n, share (by kind), average
    length and about how many values there are.

    Lines are counted under their own delimiter first, so a source with many lines is summed in many tasks. Lines with quotes, whose cells
    take more than a split, don't count.
    """
    cut = lines.where(~F.contains(F.col(text), F.lit('"'))).select(*by, F.explode(F.array(best_delimiter(F.col(text)))).alias("_b")).where("_b IS NOT NULL")  # a generator, so no filter repeats the work
    each = cut.select(*by, F.col("_b.delimiter").alias("delimiter"), F.posexplode("_b.cells").alias("place", "cell")).withColumn("kind", kind_of_value(F.col("cell")))
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in KINDS]
    one = each.groupBy(*by, "delimiter", "place").agg(F.count("*").alias("n"), *counts, F.avg(F.length("cell")).alias("length"), F.approx_count_distinct("cell").alias("values"))
    filled = F.greatest(F.col("n") - F.col("blank"), F.lit(1))
    shares = F.struct(*[(F.col(k) / (F.col("n") if k == "blank" else filled)).alias(k) for k in KINDS])
    listed = one.select(*by, "delimiter", F.struct("place", "n", shares.alias("share"), "length", "values").alias("c"))
    per = listed.groupBy(*by, "delimiter").agg(F.sort_array(F.collect_list("c")).alias("columns"))
    lines_of = F.get("columns", F.lit(0))["n"]
    return per.groupBy(*by).agg(F.max_by(F.struct("delimiter", "columns"), F.struct(lines_of, "delimiter")).alias("_p")).select(*by, "_p.*")


def assign(cost: list[list[float]]) -> list[int]:
    """The column of each row so that the sum of costs is least, each column used once at most; at least as many columns as rows."""
    n, m = len(cost), len(cost[0]) if cost else 0
    row_of, u, v = [-1] * m, [0.0] * n, [0.0] * m
    for start in range(n):
        # a shortest path from the row, over reduced costs, to a free column
        far, came, done = [float("inf")] * m, [-1] * m, [False] * m
        row, at, length = start, -1, 0.0
        while True:
            for j in range(m):
                if not done[j] and (d := length + cost[row][j] - u[row] - v[j]) < far[j] - 1e-12:
                    far[j], came[j] = d, at
            at = min((j for j in range(m) if not done[j]), key=lambda j: far[j])
            done[at], length = True, far[at]
            if row_of[at] < 0:
                break
            row = row_of[at]
        u[start] += length
        for j in range(m):
            if done[j] and j != at:
                u[row_of[j]] += length - far[j]
                v[j] -= length - far[j]
        while at >= 0:
            row_of[at] = start if came[at] < 0 else row_of[came[at]]
            at = came[at]
    out = [-1] * n
    for j, i in enumerate(row_of):
        if i >= 0:
            out[i] = j
    return out


def wanted_kind(key: str) -> str:
    """The kind of value that a field's name asks for."""
    known = category(key) or key
    for kind, words in (("email", ("email", "mail")), ("phone", ("phone", "mobile", "msisdn", "tel")), ("url", ("url", "website", "link")), ("date", ("date", "created", "updated")), ("number", ("id", "count", "number", "amount", "age"))):
        if any(known == w or known.startswith(w) or known.endswith(w) for w in words):
            return kind
    return "name" if "name" in known else "text"


def offline_guess(columns: list[dict], fields: list[str]) -> dict[str, int]:
    """The assignment of columns to fields whose values fit best in sum; fields that no column fits well are left out."""
    if not fields:
        return {}
    fit = [[sum(FITS[wanted_kind(f)].get(k, 0.0) * s for k, s in c["share"].items()) for c in columns] for f in fields]
    # a column of many values goes before one of few, an earlier one before a later one, where both fit alike
    cost = [[1 - x - 1e-4 * min(1.0, c["values"] / max(1, c["n"])) + 1e-6 * j for j, (x, c) in enumerate(zip(row, columns, strict=True))] + [1 - LEAST + 1e-3] * len(fields) for row in fit]
    found = assign(cost)
    return {f: columns[j]["place"] for f, j in zip(fields, found, strict=True) if j < len(columns)}


def guessed_columns(lines: DataFrame, spec: FieldSpec, by: list[str], guess: Guess = offline_guess) -> DataFrame:
    """(by, delimiter, column_map): for each source the columns of the fields by what their values look like. Denied fields get none.

    guess is the teacher: it gets the profiles of a source's columns and the fields, and gives places; what it says is cleaned.
    """
    ship(lines.sparkSession)
    fields = [f for f in spec.wanted if not denied(f)]
    keyed = {f: spec.key[f] for f in fields}
    found = profiles(lines, by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = []
            for columns in b.column("columns").to_pylist():
                said = guess(columns, list(keyed.values()))
                maps.append(list(guessed_map({f: [said[k]] for f, k in keyed.items() if k in said}, [], fields).items()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in by], b.column("delimiter"), pa.array(maps, pa.map_(pa.string(), pa.list_(pa.int32())))], names=[*by, "delimiter", "column_map"])

    kinds = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in by)
    return found.mapInArrow(run, f"{kinds}, delimiter string, column_map map<string,array<int>>")
