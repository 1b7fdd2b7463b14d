"""Strings: CSV cells, keys, literals of patterns, paths, JSON-safe text."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_key(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def csv_cell(c: Column) -> Column:
    """A cell as CSV text: quoted if it has a quote, comma or line end; null is empty."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(s.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def csv_line(*cells: Column) -> Column:
    return F.concat_ws(",", *map(csv_cell, cells))


def regex_literal(c: Column) -> Column:
    """A pattern that matches just this text as a whole line."""
    return F.concat(F.lit("^"), F.regexp_replace(c, r"([\\.*+?^${}()|\[\]])", r"\\$1"), F.lit("$"))


def sanitize(c: Column) -> Column:
    """Without NUL; a \\u that isn't followed by four hex digits gets a second backslash."""
    return F.regexp_replace(F.replace(c, F.lit("\x00"), F.lit("")), r"(?<!\\)\\u(?![0-9a-fA-F]{4})", r"\\\\u")


def join_scalars(c: Column) -> Column:
    """An array of strings as one, blanks left out."""
    return F.array_join(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")), "; ")


def bucket_and_key(url: Column) -> Column:
    """struct(bucket, key) of an object store's URL."""
    return F.struct(F.regexp_extract(url, r"^(?:gs|s3a?)://([^/]+)/?", 1).alias("bucket"), F.regexp_extract(url, r"^(?:gs|s3a?)://[^/]+/(.*)$", 1).alias("key"))


def clean_basename(path: Column) -> Column:
    """The last part of a path, with runs of blanks and # as one underscore."""
    return F.regexp_replace(F.element_at(F.split(path, "[/\\\\]"), -1), r"[#\s]+", "_")


def lenient_timestamp(c: Column) -> Column:
    """A timestamp of ISO text or of epoch seconds or milliseconds; null if it is neither."""
    number = c.try_cast("double")
    seconds = F.when(F.abs(number) > 1e11, number / 1000).otherwise(number)
    return F.coalesce(F.when(c.rlike(r"^-?\d+(\.\d+)?$"), F.timestamp_millis((seconds * 1000).cast("bigint"))), F.try_to_timestamp(c))


#: Longest pattern that a learned template may have.
MAX_PATTERN = 1024
LITERAL_RUN = 6


def safe_pattern(pattern: str) -> bool:
    """Whether a learned pattern compiles, is short and repeats no group, so that matching is fast."""
    if len(pattern) > MAX_PATTERN or re.search(r"\)\s*(?:[*+]|\{\d)", pattern):
        return False
    try:
        re.compile(pattern)
        return True
    except re.error:
        return False


def literal_run(pattern: str) -> int:
    """The longest run of plain characters in a pattern."""
    best = run = i = 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            plain = not pattern[i + 1].isalnum()
            i += 2
        elif c == "[":
            end = pattern.find("]", i + 2)
            i = len(pattern) if end < 0 else end + 1
            plain = False
        else:
            plain = c not in ".^$*+?{}()|]"
            i += 1
        run = run + 1 if plain else 0
        if not plain or pattern[i : i + 1] in ("*", "?", "{"):
            run = 0 if pattern[i : i + 1] in ("*", "?", "{") else run
        best = max(best, run)
    return best


# -- answers of models ------------------------------------------------------------------------------------------------

_ESCAPE = r'(?:u[0-9a-fA-F]{4}|["\\/bfnrt])'
#: A backslash that begins no escape, behind escapes that are well-formed.
_LONE = rf"(?<!\\)((?:\\{_ESCAPE})*+)\\(?!{_ESCAPE})"


#: What matters to brackets, as wholes: a quoted string (to the end, if it is left open), a bracket of the kind, or a run of all else.
_TOKEN = r"""(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\z)|[%s]|[^"%s]++"""


def bound(c: Column, then: Callable[[Column], Column]) -> Column:
    """then(c), with c worked out once however often it is used."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def _balanced(text: Column, opens: str, closes: str) -> Column:
    """The first stretch from a bracket to the one that closes it, quoted ones apart; null if none is closed."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def step(s: Column, token: Column) -> Column:
        free = s["last"] == 0
        up, down = free & (token == opens), free & (token == closes) & (s["depth"] > 0)
        return F.struct(
            (s["at"] + F.length(token)).alias("at"), (s["depth"] + F.when(up, 1).when(down, -1).otherwise(0)).alias("depth"),
            F.when(up & (s["depth"] == 0), s["at"] + 1).otherwise(s["first"]).alias("first"), F.when(down & (s["depth"] == 1), s["at"] + 1).otherwise(s["last"]).alias("last"),
        )

    both = re.escape(opens) + re.escape(closes)
    found = F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN % (both, both)), F.lit(0)), start, step)
    return bound(found, lambda s: F.when(s["last"] > 0, F.substring(text, s["first"], s["last"] - s["first"] + 1)))


def answer_json(text: Column) -> Column:
    """Native: the JSON in what a model says. Fences go; text that is JSON stays; else the first object, else the first array, else the
    text. A backslash that begins no escape is doubled where the result can't be read otherwise."""
    part = lambda t: F.when(F.try_parse_json(t).isNotNull(), t).otherwise(F.coalesce(_balanced(t, "{", "}"), _balanced(t, "[", "]"), t))
    mended = lambda p: F.when(F.try_parse_json(p).isNotNull(), p).otherwise(F.regexp_replace(p, _LONE, r"$1\\\\"))
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(?:json)?\s*", ""), r"\s*```\s*$", ""))
    return bound(bare, lambda t: bound(part(t), mended))


def object_in(text: str) -> dict | None:
    """The first object in what a model says, for a single answer."""
    mended = re.sub(rf"(\\{_ESCAPE})|\\", lambda m: m[1] or "\\\\", text)
    for t in (text, mended):
        at = t.find("{")
        while at >= 0:
            try:
                got = json.JSONDecoder().raw_decode(t, at)[0]
            except ValueError:
                got = None
            if isinstance(got, dict):
                return got
            at = t.find("{", at + 1)
    return None
