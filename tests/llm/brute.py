"""Plain one-process versions of what the operators do, for comparison."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(words[i : i + 8]) for i in range(n - 7)]
    many, cover = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            cover.update(range(i, i + 8))
    failed = n < 20 or 100 * len(cover) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    text = text or ""
    out = []
    for k, (kind, pattern) in enumerate([("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def substring(rows):
    """{doc_id: (n_words, n_removed, kept_sha256)} for rows of (doc_id, text) with distinct ids."""
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            first.setdefault(tuple(words[d][i : i + 13]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def weighted_shingles(text, n=5):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def classes(rows, least=0.8, weighted=False):
    """{doc_id: class}: connected components of pairs whose shingles have that similarity; the least id names one.

    weighted: the sum of the lesser counts over the sum of the greater ones.
    """
    if weighted:
        return _classes([(d, weighted_shingles(t)) for d, t in rows], least, lambda x, y: sum((x & y).values()) >= least * sum((x | y).values()), lambda x: sum(x.values()))
    return _classes([(d, shingles(t)) for d, t in rows], least, lambda x, y: len(x & y) >= least * len(x | y), len)


def _classes(sets, least, similar, size):
    top = {d: d for d, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and min(size(x), size(y)) >= least * max(size(x), size(y)) and similar(x, y):
                p, q = sorted((find(a), find(b)))
                top[q] = p
    return {d: find(d) for d, _ in sets}
