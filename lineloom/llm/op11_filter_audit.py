"""What each filter of a chain removes in every order, by inclusion-exclusion over joint failures.

Rule: a document fails some of a few filters. Applied in an order, a filter removes what fails it and is still there.
For each part, order and step the report counts what is kept after the step, what it removes, what fails its filter
but went earlier (redundant), what fails its filter only (unique_fails), what it removes of the documents that labels
call good or toxic, and the filter's Shapley value times the number of orders.

Method: one pass counts, per part, the rows that fail all filters of each subset, as sums of products of flags: 32
sums for five filters, and as many for good and for toxic rows. A Möbius inversion over subsets gives the survivors
of each set of filters, its counterpart over supersets what fails a set and nothing else. Survivors before and after
a step give all counts of the step. The removed documents as a game of filters have the Harsanyi dividends
(-1)^(|T|+1) * joint(T), and a filter's Shapley value is the sum over T of dividend / |T|. Rows are met once, whatever
the number of orders.

Flags of FILTERS: A, under 50 words `[^\\x20\\x09-\\x0D]+`; B, distinct words under 65 %; C, over 5 % of the code
points are A-Z; D, any of `#$%&*|`; E, the text is that of a smaller doc_id, anywhere in the table.

Nulls: a null text is empty (fails A only, and E if another empty text has a smaller id), a null source is the part ''.
A row with a null doc_id is smaller and larger than none: it never fails E, nor makes others fail, and has no labels.
Rows that repeat count each; those that share the smallest doc_id of a text all stay. A doc_id with several labels is
good or toxic if one of them says so; null labels say nothing. Other columns aren't read. An empty table gives an
empty report. Texts are met by one task each and leave it as a SHA-256; groups of copies are one partial minimum a
task, and those with a great share of rows are joined by broadcast, of at most 1000 rows (`at_groups`).
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_groups, table

FILTERS = "ABCDE"
WEIGHTS = ("every", "good", "toxic")


def flags(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, part and the filters' flags, a row per row of docs."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"), t.alias("t"))
    own = own.withColumn("words", F.filter(F.split("t", "[ \\t-\\r]+"), lambda x: x != ""))
    rows = own.select(
        "doc_id", "part", F.unhex(F.sha2("t", 256)).alias("h"),
        (F.size("words") < 50).alias("A"),
        (100 * F.size(F.array_distinct("words")).cast("long") < 65 * F.size("words").cast("long")).alias("B"),
        (100 * F.regexp_count("t", F.lit("[A-Z]")).cast("long") > 5 * F.char_length("t").cast("long")).alias("C"),
        F.col("t").rlike("[#$%&*|]").alias("D"),
    )
    rows = cut(rows, "flags")
    several = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = join_groups(rows, several, "h", "n")
    return joined.select("doc_id", "part", "A", "B", "C", "D", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good and toxic."""
    said = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
    said = said.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    some, none = rows.where("doc_id IS NOT NULL").join(said, "doc_id", "left"), rows.where("doc_id IS NULL")
    both = some.unionByName(none.withColumns({"good": F.lit(False), "toxic": F.lit(False)}))
    return both.withColumns({w: F.coalesce(w, F.lit(False)) for w in ("good", "toxic")})


def joint(rows: DataFrame, filters: str, weights: tuple[str, ...]) -> DataFrame:
    """Per part and weight an array: at each subset of filters, as a bit set, the weight of the rows that fail them all."""
    ones = rows.withColumns({c: F.col(c).cast("long") for c in (*filters, *weights)})

    def sums(weight: str) -> Column:
        subsets = [[f for i, f in enumerate(filters) if s >> i & 1] for s in range(1 << len(filters))]
        return F.array(*[F.sum(reduce(Column.__mul__, map(F.col, s), F.col(weight))) for s in subsets])

    return ones.groupBy("part").agg(*[sums(w).alias(w) for w in weights])


def _inverted(joint: str, n: int, met, sign) -> Column:
    """By set s of filters: the sum over the subsets t with met(s, t) of sign(s, t) * joint(t)."""

    def of_set(s: Column) -> Column:
        return _sum(F.transform(joint, lambda v, t: F.when(met(s, t), v * _even(sign(s, t))).otherwise(F.lit(0))))

    return F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), of_set)


def _even(s: Column) -> Column:
    return F.lit(1) - 2 * F.pmod(F.bit_count(s), F.lit(2))


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v)


def survivors(joint: str, n: int) -> Column:
    """By set of filters: what fails none of them."""
    return _inverted(joint, n, lambda s, t: s.bitwiseAND(t) == t, lambda s, t: t)


def exactly(joint: str, n: int) -> Column:
    """By set of filters: what fails them and no other."""
    return _inverted(joint, n, lambda s, t: s.bitwiseAND(t) == s, lambda s, t: s.bitwiseXOR(t))


def shapley(joint: str, n: int) -> Column:
    """By filter: the sum over the sets that hold it of their dividend * n! / their size."""
    shares = F.array(*[F.lit((-1) ** (k + 1) * factorial(n) // k if k else 0).cast("long") for k in range(n + 1)])

    def of_filter(i: int) -> Column:
        return _sum(F.transform(joint, lambda v, t: F.when(t.bitwiseAND(F.lit(1 << i)) != 0, v * F.get(shares, F.bit_count(t))).otherwise(F.lit(0))))

    return F.array(*map(of_filter, range(n)))


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The report. rows has part, a flag per filter (named by a letter each), good and toxic."""
    n = len(filters)
    sums = joint(rows.withColumn("every", F.lit(1)), filters, WEIGHTS)
    sums = sums.withColumns({**{f"left_{w}": survivors(w, n) for w in WEIGHTS}, "only": exactly("every", n), "value": shapley("every", n)})
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = sums.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    at = F.instr(F.lit(filters), F.col("filter_order").substr(F.col("step"), F.lit(1))) - 1
    before = sum((F.when(F.instr("filter_order", f) < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    steps = steps.withColumns({"_at": at, "_before": before}).withColumn("_bit", F.call_function("shiftleft", F.lit(1), F.col("_at")))

    def gone(w: str) -> Column:
        return F.get(f"left_{w}", F.col("_before")) - F.get(f"left_{w}", F.col("_before") + F.col("_bit"))

    return steps.select(
        "part", "filter_order", "step", F.get("left_every", F.col("_before") + F.col("_bit")).alias("kept"), gone("every").alias("removed"),
        (F.get("every", F.col("_bit")) - gone("every")).alias("redundant"), F.get("only", F.col("_bit")).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.get("value", F.col("_at")).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(labelled(flags(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")))
