"""Quality rules with adaptive thresholds. DataFrame functions only.

Measures, over whole texts with words [^\\x20\\x09-\\x0D]+: n_words, word_chars, n_symbols, n_dup_lines and
n_repeat_words (words within windows of eight words that occur twice or more in the text).

Base rule: fewer than 20 words, or more than 30 % of words repeated, fails.

Verdict: KLL quantile sketches of symbols per word, mean word length and the share of duplicate lines are made per
language and source over the rows that pass the base rule, and merged to sketches per language and of all. A group
with fewer than `least` rows uses its language's, a language with fewer uses all. A row fails if a measure lies
outside (q10 - spread * s, q75 + spread * s), s being q75 - q10 but not less than a stated slack, so that groups
without variation don't reject ordinary texts. Upper fences only for symbols and duplicate lines.

Null texts have no words and fail. Null languages and sources are groups of their own. Repeated rows are judged alike.
An empty table gives an empty one. Other columns stay, but for those with the names of new ones, which are replaced.
The thresholds have a row per language and source; sketches are partial per task, so a hot source is no hot task, and
the join is a broadcast only while that table has at most `most_groups` rows, else rows are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, cut, hidden, passing, table, without

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: measure: (slack of the spread, whether there is a lower fence too)
RULES = {"symbol_rate": (0.02, False), "mean_word": (0.75, True), "dup_rate": (0.15, False)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _pairs(x: Column, step: int) -> Column:
    """Of an array of hashes h: the hash of h[i] and h[i + step], for each i that has both."""
    n = F.size(x) - step
    return F.when(n <= 0, F.array().cast("array<bigint>")).otherwise(F.zip_with(F.slice(x, 1, F.greatest(n, F.lit(0))), F.slice(x, step + 1, F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b)))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the five measures."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.drop(*MEASURES).withColumn("_t", t)
    squeezed = _without(F.col("_t"), WHITE)
    df = df.withColumns({
        "_w": F.filter(F.split(F.col("_t"), "[ \\t-\\r]+"), lambda x: x != ""),
        "word_chars": F.char_length(squeezed).cast("long"),
        "n_symbols": (F.char_length(F.col("_t")) - F.char_length(_without(F.col("_t"), SYMBOLS))).cast("long"),
        "_lines": F.filter(F.split(F.col("_t"), "\n", -1), lambda x: F.char_length(F.translate(x, WHITE, "")) > 0),
    })
    df = df.withColumns({"n_words": F.size("_w").cast("long"), "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "_h": F.transform("_w", lambda x: F.xxhash64(x))})
    for step in (1, 2, 4):
        df = df.withColumn("_h", _pairs(F.col("_h"), step))
    df = df.withColumn("_repeats", F.size("_h") > F.size(F.array_distinct("_h")))
    at = F.transform(F.col("_h"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(F.col("_repeats"), F.array_sort(at)))
    s = F.col("_sorted")
    n = F.size("_h")
    same = F.zip_with(F.slice(s, 1, n - 1), F.slice(s, 2, n - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("_starts", F.when(F.col("_repeats"), F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))))
    p = F.col("_starts")
    k = F.size(p)
    steps = F.zip_with(F.slice(p, 1, k - 1), F.slice(p, 2, k - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.when(F.col("_repeats"), covered).otherwise(F.lit(0)).cast("long"))
    return df.drop("_t", "_w", "_lines", "_h", "_repeats", "_sorted", "_starts")


def thresholds(measured: DataFrame, lang: str, source: str, least: int, k: int, spread: float) -> DataFrame:
    """Fences per language and source."""
    ok = measured.where(~F.col("base_failed"))
    made = ok.groupBy(lang, source).agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, k).alias(m) for m in RULES])
    levels = F.array(F.lit(0.10).cast("double"), F.lit(0.75).cast("double"))
    per_lang = made.groupBy(F.col(lang).alias("_l")).agg(F.sum("n").alias("ln"), *[F.kll_merge_agg_double(m).alias(f"l_{m}") for m in RULES])
    total = made.agg(F.sum("n").alias("an"), *[F.kll_merge_agg_double(m).alias(f"a_{m}") for m in RULES])
    every = measured.select(lang, source).distinct()
    joined = every.alias("e").join(made.alias("m"), F.expr(f"e.`{lang}` <=> m.`{lang}` AND e.`{source}` <=> m.`{source}`"), "left").select(F.col(f"e.{lang}").alias("_lang"), F.col(f"e.{source}").alias("_source"), "n", *RULES)
    joined = joined.join(per_lang, F.col("_lang").eqNullSafe(F.col("_l")), "left").join(F.broadcast(total), F.lit(True), "left")
    out = []
    for m, (slack, lower) in RULES.items():
        own = F.when(F.col("n") >= least, F.col(m)).when(F.col("ln") >= least, F.col(f"l_{m}")).otherwise(F.col(f"a_{m}"))
        q = F.kll_sketch_get_quantile_double(own, levels)
        s = F.greatest(q[1] - q[0], F.lit(slack))
        out.append((q[1] + spread * s).alias(f"{m}_hi"))
        if lower:
            out.append((q[0] - spread * s).alias(f"{m}_lo"))
    return joined.select("_lang", "_source", *out)


def quality(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the measures, base_failed and the rates that the fences are about; one pass, nothing is moved."""
    df, at, back = hidden(df)
    text = at[text]
    m = measures(df, text)
    m = m.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    n = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)), F.lit(1))
    m = m.withColumns({"symbol_rate": F.col("n_symbols") / n, "mean_word": F.col("word_chars") / n, "dup_rate": F.col("n_dup_lines") / lines})
    return back(m, (*MEASURES, "base_failed", *RULES))


def judged(measured: DataFrame, lang: str = "lang", source: str = "source", least: int = 100, k: int = 400, spread: float = 4.0, most_groups: int = 20_000, salts: int = 64) -> DataFrame:
    """Adds kept to what quality() gives. measured is read twice: it should be a written table."""
    fences = cut(thresholds(measured, lang, source, least, k, spread), "fences")
    few = fences.limit(most_groups + 1).count() <= most_groups
    if few:
        right, left = F.broadcast(fences.withColumn("_salt", F.lit(0))), measured.withColumn("_salt", F.lit(0))
    else:
        right = fences.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        left = measured.withColumn("_salt", F.pmod(F.xxhash64(*MEASURES, F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    on = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")) & (left["_salt"] == right["_salt"])
    good = ~F.col("base_failed")
    for m, (_, lower) in RULES.items():
        good &= F.col(m) <= F.col(f"{m}_hi")
        if lower:
            good &= F.col(m) >= F.col(f"{m}_lo")
    out = left.join(right, on, "left").withColumn("kept", F.coalesce(good, F.lit(False)))
    return out.drop("_salt", "_lang", "_source", *[f"{m}_{x}" for m in RULES for x in ("hi", "lo")])


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = cut(quality(docs).drop("text"), "quality")
    return judged(measured).select("doc_id", *MEASURES, "base_failed", "kept")


def kept(df: DataFrame) -> DataFrame:
    """The rows of df that the rules keep, with its columns. No text is written or, while few rows go, moved."""
    own, at, back = hidden(df)
    verdict = [x for c in ("text", "lang", "source") for x in (F.coalesce(F.col(at[c]).cast("string"), F.lit("")), F.col(at[c]).isNull())]
    own = own.withColumn("_raw", F.xxhash64(*verdict))  # with doc_id, what tells a row from those that may be judged otherwise
    with passing(df.sparkSession) as stays:
        measured = cut(quality(own, at["text"]).select(F.col(at["doc_id"]).alias("_id"), F.col("_raw"), at["lang"], at["source"], *MEASURES, "base_failed", *RULES), "quality")
        gone = stays(judged(measured, at["lang"], at["source"]).where("NOT kept").select("_id", "_raw").distinct(), "gone")
    return back(without(own, gone, {"_id": at["doc_id"], "_raw": "_raw"}))
