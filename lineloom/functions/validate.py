"""Checks of values and lines. Each has a native column form and, where the mapper needs it, a plain one."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and limits that decide results.
EMAIL = r"^[A-Za-z0-9._%+=\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"
HEADER_LABEL = r"^[\p{L}_][\p{L}\p{N} _.,\-]*$"
ID_LIKE = r"(?i)^\d{7,}$|^OD\d+$"
SALUTATION = r"(?i)^(Mr|Mrs|Ms|Master|Miss)\.?$"
DELIMITER_ONLY = r"^[,;]+$"
ZIP = r"^\d{4,6}$"
CONTROLS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
BINARY = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\p{Cn}]"
MAX_LINE = 65_536
CONTROL_SHARE, BINARY_SHARE = 0.15, 0.05

_EMAIL, _ID, _SALUTATION, _DELIMITERS, _ZIP = (re.compile(p) for p in (EMAIL, ID_LIKE, SALUTATION, DELIMITER_ONLY, ZIP))
_CONTROL = re.compile(CONTROLS)
#: Trimmed like a script engine's trim(): tabs, line ends and Unicode spaces too.
BLANKS = r"[\s   -     　﻿]+"
NOT_BLANK = "[^" + BLANKS[1:-2] + "]"
#: A blank that isn't a plain space.
ODD_BLANK = "[" + NOT_BLANK[2:-1].replace("\\s", "\\t\\n\\x0B\\f\\r") + "]"


def trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANKS}|{BLANKS}$", "")


def is_email(c: Column) -> Column:
    return F.contains(c, F.lit("@")) & trim(c).rlike(EMAIL)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]+", "")


def is_phone(c: Column) -> Column:
    return ~F.contains(c, F.lit("@")) & F.length(digits(c)).between(10, 15)


def valid_field(name: str, c: Column) -> Column:
    """The check that goes with a field's name; others are always valid."""
    n = name.lower()
    if "email" in n:
        return is_email(c)
    if "phone" in n:
        return is_phone(c)
    return F.lit(True)


def share(c: Column, pattern: str) -> Column:
    """The share of characters that match a class of characters."""
    n = F.length(c)
    return F.when(n == 0, F.lit(0.0)).otherwise((n - F.length(F.regexp_replace(c, pattern, ""))) / n)


def gate(line: Column) -> Column:
    """length-gate, binary-gate, too-long, or null for lines that may be records."""
    t = trim(line)
    # most lines have no such character at all, which one look settles
    return F.when(~line.rlike(NOT_BLANK), "length-gate").when(F.length(line) > MAX_LINE, "too-long").when(line.rlike(BINARY) & ((share(t, CONTROLS) > CONTROL_SHARE) | (share(t, BINARY) > BINARY_SHARE)), "binary-gate")


# plain forms


def email_ok(v) -> bool:
    return bool(_EMAIL.match(str(v).strip()))


def phone_ok(v) -> bool:
    s = str(v)
    return "@" not in s and 10 <= sum(c.isdigit() and c.isascii() for c in s) <= 15


def field_ok(key: str, v) -> bool:
    """Whether a value suits a field of that normalised name; only e-mail and phone fields are checked."""
    if v is None or isinstance(v, (dict, bool)):
        return False
    if "email" in key:
        return email_ok(v)
    return phone_ok(v) if "phone" in key else str(v).strip() != ""


def weak_text(v: str) -> bool:
    """Whether a cell may be free text: not blank, an opaque number, a salutation or just delimiters."""
    return bool(v) and not (_DELIMITERS.match(v) or _ID.match(v) or _SALUTATION.match(v))


def is_zip(v: str) -> bool:
    return bool(_ZIP.match(v))


def mostly_binary(s: str) -> bool:
    if s.isascii() and s.isprintable():
        return False
    return bool(s) and sum(bool(_CONTROL.match(c)) or unicodedata.category(c) == "Cn" for c in s if ord(c) < 32 or ord(c) > 126) / len(s) > BINARY_SHARE
