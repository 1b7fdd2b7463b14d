"""Personal data and secrets: patterns propose spans, checks confirm them, words nearby adjust a score. DataFrame functions only.

Base kinds, each found leftmost and without overlap within its kind: email, ip (parts at most 255), card (12 to 19
digits that pass Luhn) and phone (9 to 15 digits). The method adds iban (mod 97 must be 1), ssn (three, two and four
digits) and secret (a run of 20 or more letters, digits and _ - + / with both letters and digits and with ten different
characters or more, as keys and tokens are). Each kind has a score to start from, `SCORES`. A word of its `CONTEXT`
within `BEFORE` characters before the span or `AFTER` behind it adds `BONUS`. Spans that the method adds need `ENOUGH`:
an iban has it by its check, ssn and secret need a word, but for secrets that begin as known keys do. Base spans always
stay, whatever their score.

Positions are code points, end exclusive. A pattern gives the matches, splitting by it gives what lies between; the
sums of their lengths are the positions. All is linear in the text and in its matches: a match may start only where the
one before it ended or where no character of the same run stands before, inner repeats are possessive, positions are
summed in blocks, and contexts come from what lies between matches (before a span as far back as to the match before
the last), not from positions in the text. The patterns of card and ip leave out only what the checks would drop.

Null is the empty text: no spans. Repeated rows are searched each. An empty table gives an empty one. Columns of the
input stay, but for those with the names of new ones. One pass, no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hidden, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+={0,2}",
}
#: A text without this has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|kontakt|correo|courriel)",
    "ip": r"(?i)\b(ip|ipv4|address|host|server|client)\b",
    "card": r"(?i)\b(card|credit|debit|visa|master|amex|payment|karte|kreditkarte|tarjeta|carte)",
    "phone": r"(?i)\b(tel|phone|call|mobile|cell|fax|handy|rufnummer)",
    "iban": r"(?i)\b(iban|account|bank|konto|cuenta|compte)",
    "ssn": r"(?i)\b(ssn|social|security|sozialversicherung)",
    "secret": r"(?i)(token|secret|passw|pwd\b|api.?key|access.?key|private.?key|credential|bearer)",
}
#: What a proposal of a kind scores by itself.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.6, "phone": 0.5, "iban": 0.7, "ssn": 0.4, "secret": 0.3}
BEFORE, AFTER, BONUS, ENOUGH = 40, 20, 0.3, 0.6
#: Starts of keys that need no context: of cloud accounts, of code hosts, of chat and payment services, signed tokens.
KEYS = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abp]-|sk_live_|rk_live_|AIza|eyJ)"
BLOCK = 64


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

    def add(total: Column, k: Column) -> Column:
        d = digits.substr(n - k, F.lit(1)).cast("int") * (F.lit(1) + k % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return (n > 0) & (F.aggregate(at, F.lit(0), add) % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether a bank account number's rest by 97 is 1."""
    s = F.replace(iban, F.lit(" "), F.lit(""))
    s = F.concat(s.substr(F.lit(5), F.length(s)), s.substr(1, 4))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.lit(0), add) == 1


def _valid_as(kind: str):
    return lambda m: _valid(kind, m)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return mod97(m)
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(F.substring(m, 1, 200), ""))) >= 10)
    return F.lit(True)


def _score(kind: str, m: Column, before: Column, after: Column) -> Column:
    own = F.lit(SCORES[kind])
    if kind == "secret":
        own = F.when(m.rlike(KEYS), F.lit(0.7)).otherwise(own)
    return F.round(own + F.when(before.rlike(CONTEXT[kind]) | after.rlike(CONTEXT[kind]), F.lit(BONUS)).otherwise(F.lit(0.0)), 2)


def _proposals(t: Column, kind: str) -> Column:
    needs = F.contains(t, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
    return F.when(needs, F.regexp_extract_all(t, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _running(x: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Of a column of int arrays: for each entry, what add makes of 0 and all entries before it.

    Aggregation copies what it has gathered with each entry, so it runs over blocks of BLOCK entries only, these over blocks of blocks.
    x must be a column's name, not an expression: expressions in lambdas are evaluated again and again.
    """
    none = F.array().cast("array<int>")

    def small(a: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(a, start, lambda acc, v: F.struct(add(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def blocks(a: Column, size: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(size)), lambda i: F.slice(a, i + 1, size))

    def by_blocks(a: Column, size: int, inner: Callable[[Column], Column]) -> Column:
        def joined(parts: Column) -> Column:
            before = small(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), add)))
            return F.flatten(F.zip_with(parts, before, lambda p, o: F.transform(inner(p), lambda v: add(v, o))))

        return F.transform(F.array(blocks(a, size)), joined)[0]  # a lambda evaluates the blocks once

    return F.when(F.size(x) <= BLOCK, small(x)).otherwise(by_blocks(x, BLOCK * BLOCK, lambda p: by_blocks(p, BLOCK, small)))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _shifted(x: Column) -> Column:
    """An array of strings moved on by one, with an empty one in front."""
    return F.concat(F.array(F.lit("")), F.slice(x, 1, F.size(x) - 1))


def _placed(df: DataFrame) -> DataFrame:
    """Adds _p_<kind>, an array of (s, e, m, before, after), from the matches _m_<kind> and from _b_<kind>, what lies between them."""
    def step(m: Column, b: Column) -> Column:
        return F.length(m) + F.length(b)

    m, b = ({k: F.col(f"{x}{k}") for k in KINDS} for x in ("_m_", "_b_"))
    on = {k: b[k].isNotNull() for k in KINDS}
    df = df.withColumns({f"_n_{k}": F.when(on[k], F.zip_with(m[k], F.slice(b[k], 1, F.size(m[k])), step)) for k in KINDS})
    df = df.withColumns({f"_s_{k}": F.when(on[k], _running(F.col(f"_n_{k}"), _sum)) for k in KINDS})

    def entry(x: Column) -> Column:
        s = x["at"] + F.length(x["b"])
        before = F.right(F.concat(x["b0"], x["m0"], x["b"]), F.lit(BEFORE))
        return F.struct(s.alias("s"), (s + F.length(x["m"])).alias("e"), x["m"].alias("m"), before.alias("before"), F.left(x["a"], F.lit(AFTER)).alias("after"))

    def placed(k: str) -> Column:
        n = F.size(m[k])
        own, behind = F.slice(b[k], 1, n), F.slice(b[k], 2, n)
        zipped = F.arrays_zip(m[k].alias("m"), own.alias("b"), behind.alias("a"), _shifted(m[k]).alias("m0"), _shifted(own).alias("b0"), F.col(f"_s_{k}").alias("at"))
        return F.transform(zipped, entry)

    return df.withColumns({f"_p_{k}": F.when(on[k], placed(k)) for k in KINDS})


def _confirmed(kind: str) -> Column:
    """The placed proposals of a kind that pass their check and score enough."""
    good = F.filter(F.col(f"_p_{kind}"), lambda x: _valid(kind, x["m"]))
    good = F.transform(good, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), _score(kind, x["m"], x["before"], x["after"]).alias("score")))
    return good if kind in BASE else F.filter(good, lambda x: x["score"] >= ENOUGH)


def spans(df: DataFrame, text: str = "text") -> DataFrame:
    """df with, per kind, an array of (s, e, m, score) in the column pii_<kind>."""
    none = F.array().cast("array<struct<s:int,e:int,m:string,score:double>>")
    df, at, back = hidden(df)
    df = df.withColumn("_t", F.coalesce(F.col(at[text]).cast("string"), F.lit("")))
    df = df.withColumns({f"_m_{k}": _proposals(F.col("_t"), k) for k in KINDS})
    # matches that fail their check still take their place, so positions come before checks
    df = df.withColumns({f"_b_{k}": F.when(F.exists(F.col(f"_m_{k}"), _valid_as(k)), F.split(F.col("_t"), PATTERNS[k], -1)) for k in KINDS})
    df = _placed(df)
    out = {f"pii_{k}": F.coalesce(_confirmed(k), none) for k in KINDS}
    return back(df.withColumns(out), tuple(out))


def _joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by start and then by kind as listed."""

    def ranked(kind: str) -> Column:
        return F.transform(F.col(f"pii_{kind}"), lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e")))

    every = F.flatten(F.array(*map(ranked, kinds)))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(every), lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _between(blocks: Column, a: Column, b: Column, size: int) -> Column:
    """Characters a to b of a text that is cut into blocks of that size."""
    i, k = (a / size).cast("int"), (b / size).cast("int")
    head = blocks[i].substr(a % size + 1, F.lit(size))
    inner = F.when(k > i + 1, F.array_join(F.slice(blocks, i + 2, k - i - 1), "")).otherwise("")
    tail = F.when(b % size > 0, blocks[k].substr(F.lit(1), b % size)).otherwise("")
    return F.when(a >= b, F.lit("")).when(i == k, blocks[i].substr(a % size + 1, b - a)).otherwise(F.concat(head, inner, tail))


def masked(df: DataFrame, text: str = "text", by: str = "[{}]", size: int = 4096) -> DataFrame:
    """df with the spans of the text replaced by their kind; spans that overlap go as one, by the first one's kind."""
    df, at, back = hidden(df)
    df, text = spans(df, at[text]), at[text]

    def named(kind: str) -> Column:
        return F.transform(F.col(f"pii_{kind}"), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), F.lit(by.format(kind)).alias("by")))

    every, blocks, found = F.col("_every"), F.col("_blocks"), F.size("_every") > 0
    df = df.withColumn("_every", F.array_sort(F.flatten(F.array(*map(named, KINDS)))))
    df = df.withColumn("_ends", F.transform(every, lambda x: -x["e"]))
    df = df.withColumn("_before", F.when(found, _running(F.col("_ends"), lambda a, b: F.greatest(a, b))))
    df = df.withColumn("_blocks", F.when(found, F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))))
    first = F.filter(F.arrays_zip(every.alias("x"), F.col("_before").alias("at")), lambda x: x["x"]["s"] >= x["at"])
    shown = F.transform(first, lambda x: F.concat(_between(blocks, x["at"], x["x"]["s"], size), x["x"]["by"]))
    rest = _between(blocks, F.array_max("_ends"), F.length(text), size)
    return df.withColumn(text, F.when(found, F.concat(F.array_join(shown, ""), rest)).otherwise(F.col(text))).transform(back)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    counts = {f"n_{k}": F.size(f"pii_{k}").cast("long") for k in KINDS}
    every = F.flatten(F.array(*[F.col(f"pii_{k}") for k in KINDS]))
    more = {"n_spans": F.size(every).cast("long"), "score": F.coalesce(F.array_max(F.transform(every, lambda x: x["score"])), F.lit(0.0))}
    out = found.withColumns(counts | more | {"base_sha256": F.sha2(_joined(BASE).cast("binary"), 256), "spans": _joined(KINDS)})
    return out.select("doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "n_iban", "n_ssn", "n_secret", "n_spans", "score")
