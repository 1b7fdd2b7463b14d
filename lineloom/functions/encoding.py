"""Encodings: detection on head bytes, decoding that never fails, repair of doubly encoded text."""

from __future__ import annotations

import codecs
import unicodedata
from functools import cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD = 8192
# Other names of encodings.
NAMES = {
    "utf8": "utf-8", "utf-8": "utf-8", "ascii": "utf-8", "us-ascii": "utf-8",
    "latin1": "iso-8859-1", "latin-1": "iso-8859-1", "iso8859-1": "iso-8859-1", "iso-8859-1": "iso-8859-1",
    "cp1252": "windows-1252", "windows1252": "windows-1252", "windows-1252": "windows-1252",
    "utf16le": "utf-16le", "utf-16le": "utf-16le", "utf16be": "utf-16be", "utf-16be": "utf-16be",
}


def utf16_lane(head: bytes) -> str | None:
    """utf-16le or utf-16be, by which of the two lanes of bytes is mostly zero."""
    head = head[:HEAD]
    if len(head) < 16:
        return None
    even, odd = head[::2], head[1::2]
    a, b = even.count(0) / len(even), odd.count(0) / len(odd)
    if a > 0.6 and b < 0.1:
        return "utf-16be"
    return "utf-16le" if b > 0.6 and a < 0.1 else None


def likely_utf8(head: bytes) -> bool:
    """Whether bytes are UTF-8, but for a character cut at their end."""
    try:
        codecs.getincrementaldecoder("utf-8")("strict").decode(head, False)
        return True
    except UnicodeDecodeError:
        return False


#: What a head may be in beside UTF-8 and UTF-16. Of encodings that read a head alike the first counts.
SINGLE = ("windows-1252", "windows-1251", "koi8-r", "windows-1250")
DOUBLE = ("shift_jis", "gbk", "big5", "euc_kr")
SURE = 0.9


def _kind(c: str) -> str:
    """The class of a character: lower or upper case, a letter of another kind, digit, blank, mark; odd is what texts hardly have."""
    if c.isascii():
        return "a" if c.islower() else "A" if c.isupper() else "d" if c.isdigit() else " " if c.isspace() else "." if c.isprintable() else "?"
    if c.isalpha():
        return "l" if c.islower() else "L" if c.isupper() else "?" if c in "ªº" else "o"
    return "." if unicodedata.category(c) in ("Pi", "Pf", "Pd", "Po", "Sc") or c in "\u00a0\u00a7\u2116\u00b0" else "?"


#: How pairs of classes count, of which one at least isn't ASCII; other pairs count nothing. Lower case follows either case, upper case
#: begins words; a mark or an odd character within a word, and upper case behind lower case, speak against a reading.
_PAIRS = {
    **dict.fromkeys(("ll", "al", "la", "Ll", "Al", "La"), 1.0), **dict.fromkeys((" l", "l ", " L", ".l", "l.", ".L", " .", ". "), 0.6),
    **dict.fromkeys(("LL", "AL", "LA", "L ", "L."), 0.2), **dict.fromkeys(("lL", "lA", "aL"), -2.0),
    **dict.fromkeys(("l?", "?l", "a?", "?a", "L?", "?L", "A?", "?A", "??"), -1.5), **dict.fromkeys(("ld", "dl", " ?", "? "), -0.4),
}


# Letters with marks that are frequent in languages written in an encoding.
_USUAL = {"windows-1252": frozenset("éèêàâçîôûëüäöåæøñóíáúõãßÉÀÄÖÜÇÑ"), "windows-1250": frozenset("ěščřžýůťďňąęłśźżćńőűáíéúóäöüßĚŠČŘŽĄĘŁŚŹŻÚ")}


@cache
def _tables(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an encoding with a byte a character: a code by byte; by code whether it is without a meaning, a letter beyond ASCII, a letter,
    and a usual one; by pair of codes whether one isn't ASCII, how the pair counts, and whether it mixes alphabets."""
    chars = [bytes([b]).decode(name, "replace") for b in range(256)]
    told = [(_kind(c), c.isalpha(), c.isascii(), c in _USUAL.get(name, ()), c == "\ufffd") for c in chars]
    codes = sorted(set(told))
    one = np.array([(odd, letter and not low, letter, usual) for _, letter, low, usual, odd in codes], float)
    two = np.array([(not (x[2] and y[2]), 0.0 if x[2] and y[2] else _PAIRS.get(x[0] + y[0], 0.0), x[1] and y[1] and x[2] != y[2]) for x in codes for y in codes], float)
    return np.array([codes.index(x) for x in told]), one, two


def _single(head: bytes, name: str) -> float:
    """How well a reading fits, from -1 to 1. Codes and pairs of them are counted, and the counts weighed."""
    code, one, two = _tables(name)
    x = code[np.frombuffer(head, np.uint8)]
    odd, foreign, letters, usual = np.bincount(x, minlength=len(one)) @ one
    if odd:
        return -1.0
    pairs, score, mixed = np.bincount(x[:-1] * len(one) + x[1:], minlength=len(two)) @ two
    if not pairs:
        return -1.0
    score = score / pairs
    # an alphabet other than Latin is written without Latin letters within its words
    if name in ("windows-1251", "koi8-r"):
        return round(float(score - 2.0 * mixed / max(1, foreign)), 12)
    if foreign > 0.6 * letters:
        score -= 1.0  # Latin letters without marks are the rule in the others
    return round(float(score + 0.4 * usual / max(1, foreign)), 12)  # so the order of sums doesn't decide


def _double(head: bytes, name: str) -> float:
    """How well a reading by pairs of bytes fits: kana or the frequent half of the characters speak for it."""
    try:
        text = codecs.getincrementaldecoder(name)("strict").decode(head, False)
    except UnicodeDecodeError:
        return -1.0
    wide = [c for c in text if not c.isascii()]
    if not wide or any(c == "\ufffd" or unicodedata.category(c) in ("Co", "Cn") for c in wide):
        return -1.0
    if name == "shift_jis":
        half = sum("\uff61" <= c <= "\uff9f" for c in wide)
        kana = sum("\u3040" <= c <= "\u30ff" for c in wide)
        return (kana + 0.3 * (len(wide) - kana - half) - 2 * half) / len(wide) + (0.5 if kana > 0.2 * len(wide) else -0.3)
    if name == "euc_kr":
        return 1.2 * sum("\uac00" <= c <= "\ud7a3" for c in wide) / len(wide) - 0.4
    leads = [c.encode(name, "ignore")[:1] for c in wide if "\u4e00" <= c <= "\u9fff"]
    if not leads:
        return -0.5
    low, high = (0xB0, 0xD7) if name == "gbk" else (0xA4, 0xC6)
    frequent = sum(bool(x) and low <= x[0] <= high for x in leads) / len(leads)
    odd = sum(not ("\u4e00" <= c <= "\u9fff" or "\u3000" <= c <= "\u303f" or "\uff00" <= c <= "\uffef" or c in "“”‘’…—·") for c in wide) / len(wide)
    return 2 * frequent - 0.9 - 2 * odd


def guess(head: bytes) -> tuple[str, float]:
    """(encoding, how sure that is, 0 to 1) of a head that is neither UTF-8 nor UTF-16."""
    head = head[:HEAD]
    scores = {name: _double(head, name) for name in DOUBLE}
    scores |= {name: _single(head, name) for name in SINGLE}
    ranked = sorted(scores, key=lambda n: -scores[n])
    best, next_ = scores[ranked[0]], scores[ranked[1]]
    if best <= 0:
        return "iso-8859-1", 0.0
    enough = min(1.0, len({b for b in head if b > 127}) / 6)  # a letter or two may be any
    return ranked[0], enough * min(1.0, 0.7 + 2 * (best - max(0.0, next_))) if ranked[0] != SINGLE[0] else min(1.0, best + 0.5)


def detect(head: bytes, sure: float = SURE) -> str:
    """UTF-16 by lanes, else UTF-8 if valid, else what is guessed if that is sure enough; else windows-1252, or latin-1 where that has no such characters."""
    if lane := utf16_lane(head):
        return lane
    if likely_utf8(head[:HEAD]):
        return "utf-8"
    name, how = guess(head)
    if how >= sure and name != "iso-8859-1":
        return name
    try:
        head[:HEAD].decode("cp1252")
        return "windows-1252"
    except UnicodeDecodeError:
        return "iso-8859-1"


def known_name(name: str | None) -> str:
    """A codec's name; what is unknown is read as latin-1."""
    n = (name or "utf-8").strip().lower().replace("_", "-")
    n = NAMES.get(n, n)
    try:
        codecs.lookup(n)
        return n
    except LookupError:
        return "iso-8859-1"


def decode(raw: bytes, name: str | None = None) -> str:
    """Text of bytes; never fails. Bytes without a meaning become U+FFFD."""
    return raw.decode(known_name(name), "replace")


def recover_mojibake(c: Column) -> Column:
    """Text that was UTF-8 read as latin-1 becomes what it was; other text stays."""
    twice = c.rlike("[\\u0080-\\u00FF]") & ~c.rlike("[^\\u0000-\\u00FF]")
    return F.when(twice, F.coalesce(F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string")), c)).otherwise(c)
