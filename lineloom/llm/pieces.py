"""Piece vocabularies: exact merge-type encoding by backtracking, count-only Viterbi, and decoding.

A `Pieces` is built on each executor from the bytes of a SentencePiece model of type BPE with byte fallback and
identity normalisation. Texts are cut into segments where no piece of the vocabulary can cross: before a run of
word marks, around line breaks and, if the vocabulary allows, before a trailing full stop or comma. What one segment
encodes to is remembered in tables of bounded size.
"""

from __future__ import annotations

import itertools
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .automaton import Automaton

MARK = "▁"
#: Segments to remember in each of two generations.
REMEMBERED = 150_000
#: Longer segments aren't remembered.
SHORT = 48


class Memory:
    """Results by text, in two generations: when the young one is full it becomes the old one, so what is used stays."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def __call__(self, key: str):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is None:
                got = self.make(key)
            if len(key) <= SHORT:
                if len(self.young) >= REMEMBERED:
                    self.young, self.old = {}, self.young
                self.young[key] = got
        return got


class Pieces:
    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {}
        self.normal = {}
        self.score = {}
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(self.text[i][3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.normal[self.text[i]] = i
                self.score[i] = sp.get_score(i)
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        if sp.encode("    x", out_type=str)[0][:1] != MARK:
            raise ValueError("the model normalises texts")
        self.surface = [b""] * n  # what an id decodes to
        for i in self.normal.values():
            self.surface[i] = self.text[i].replace(MARK, " ").encode()
        for b, i in self.byte_id.items():
            self.surface[i] = bytes([b])
        self.surface[sp.unk_id()] = b" \xe2\x81\x87 "
        inner = [p for p in self.normal if re.search(f"[^{MARK}]{MARK}", p)]
        newline = [p for p in self.normal if "\n" in p]
        stop = [p for p in self.normal if re.search(r"[^\W\d_][.,]", p)]
        if inner:
            self.segment = re.compile(r"(?s).+")
        else:
            part = f"[^{MARK}\n]" if not newline else f"[^{MARK}]"
            end = r"[.,]+(?![^%s\n])" % MARK
            latin = "[a-zA-Zà-öø-ÿ]"
            if any(re.search(latin + "[.,]", p) for p in stop):
                self.segment = re.compile(f"{MARK}+{part}*|{part}+|\n+")
            else:
                self.segment = re.compile(f"{MARK}*{latin}+(?={end})|{MARK}+{part}*|{part}+|\n+")
        self._merge_rank = {p: (-self.score[i], i) for p, i in self.normal.items()}
        self._remembered = Memory(self._result)
        self._compatible: dict[int, bool] = {}
        self._build()

    def _build(self) -> None:
        """The automaton over pieces that merging can reach, each with its longest proper prefix that is such a piece."""
        reach = {p: i for p, i in self.normal.items() if self._merged(p) == [p]}
        self.by_id = {i: p for p, i in reach.items()}
        # over reversed pieces, so that a state knows the longest piece that starts at a position
        self.automaton = Automaton({p[::-1]: i for p, i in reach.items()})
        self.longest = [x[0] if x else -1 for x in self.automaton.found]
        self.size_of = [len(self.by_id.get(i, "")) for i in range(len(self.text))]
        self.shorter = [-1] * len(self.text)
        for p, i in reach.items():
            self.shorter[i] = next((reach[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in reach), -1)

    def _merged(self, text: str) -> list[str]:
        """The pieces that merging the best adjacent pair, the leftmost of equals, makes of a short text."""
        parts = list(text)
        rank = self._merge_rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                if (r := rank.get(parts[k] + parts[k + 1])) is not None and (best is None or r[0] < best):
                    best, at = r[0], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, a: int, b: int) -> bool:
        """Whether merging the text of a and b gives just a and b again."""
        if len(self._compatible) > 1_000_000:
            self._compatible.clear()
        x, y = self.by_id[a], self.by_id[b]
        known = self._compatible[a << 20 | b] = self._merged(x + y) == [x, y]
        return known

    def _known(self, text: str) -> list[int]:
        """Encodes a text of which every character is a piece, by backtracking.

        From the left the longest match is tried first; a token stays if it fits the one before it, else the next
        shorter one is tried, else the last token is taken back. `failed` is a field of bits, one for each position
        from which no way leads to the end.
        """
        n = len(text)
        longest = list(map(self.longest.__getitem__, self.automaton.states(text[::-1])))
        longest.reverse()
        ids, at, token, last = [], 0, longest[0], -1
        failed: dict[int, int] = {}  # words of the bit field that aren't zero
        size_of, shorter, compatible = self.size_of, self.shorter, self._compatible
        while True:
            if token < 0:  # nothing fits here
                if not ids:
                    raise ValueError("no valid encoding")
                failed[at >> 6] = failed.get(at >> 6, 0) | 1 << (at & 63)
                token = ids.pop()
                at -= size_of[token]
                token = shorter[token]
                last = ids[-1] if ids else -1
                continue
            end = at + size_of[token]
            if not failed or not failed.get(end >> 6, 0) >> (end & 63) & 1:
                fit = True if last < 0 else compatible.get(last << 20 | token)
                if fit is None:
                    fit = self._fits(last, token)
                if fit:
                    ids.append(token)
                    if end == n:
                        return ids
                    last, at, token = token, end, longest[end]
                    continue
            token = shorter[token]

    def _segment_ids(self, segment: str) -> list[int]:
        normal, out, start = self.normal, [], 0
        for k, c in enumerate(segment):
            if c not in normal:
                if k > start:
                    out += self._known(segment[start:k])
                out += [self.byte_id[b] for b in c.encode()]
                start = k + 1
        if start < len(segment):
            out += self._known(segment[start:] if start else segment)
        return out

    def normalised(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def segments(self, text: str) -> list[str]:
        return self.segment.findall(self.normalised(text))

    def _result(self, segment: str) -> tuple[str, bytes]:
        ids = self._segment_ids(segment)
        return ",".join(map(str, ids)), b"".join(map(self.surface.__getitem__, ids))

    def encode_batch(self, texts: list[str]) -> tuple[list[str], list[bytes]]:
        """Per text the ids, in decimal and joined by commas, and what they decode to.

        Each distinct segment of the batch is looked up once; Arrow spreads the results over the occurrences.
        """
        parts = [self.segments(t) for t in texts]
        distinct, places, ends = _indexed(parts)
        got = [self._remembered(x) for x in distinct]
        ids = pc.binary_join(pa.LargeListArray.from_arrays(ends, pa.array([a for a, _ in got], pa.large_string()).take(places)), pa.scalar(",", pa.large_string())).to_pylist()
        out = pc.binary_join(pa.LargeListArray.from_arrays(ends, pa.array([b for _, b in got], pa.large_binary()).take(places)), pa.scalar(b"", pa.large_binary())).to_pylist()
        return ids, [self.stripped(x) for x in out]

    def encode_text(self, text: str) -> tuple[str, bytes]:
        (ids,), (out,) = self.encode_batch([text])
        return ids, out

    def encode(self, text: str) -> list[int]:
        got = self.encode_text(text)[0]
        return list(map(int, got.split(","))) if got else []

    @staticmethod
    def stripped(out: bytes) -> bytes:
        """Without the space put before the text; bytes that aren't UTF-8 become U+FFFD, one each."""
        out = out[1:] if out[:1] == b" " else out
        try:
            out.decode()
            return out
        except UnicodeDecodeError:
            return _replaced(out).encode()

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.surface.__getitem__, ids))
        marked = ids and self.text[ids[0]].startswith(MARK)
        return self.stripped(out).decode() if marked else _replaced(out)


def _indexed(parts: list[list[str]]) -> tuple[list[str], pa.Array, pa.Array]:
    """The distinct strings of all lists, the place of each occurrence among them, and where lists start and end."""
    flat = pa.array(itertools.chain.from_iterable(parts), pa.large_string())
    coded = flat.dictionary_encode()
    ends = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) for x in parts], out=ends[1:])
    return coded.dictionary.to_pylist(), coded.indices, pa.array(ends)


def _replaced(raw: bytes) -> str:
    parts = []
    while raw:
        try:
            parts.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            parts += [raw[: e.start].decode(), "�"]
            raw = raw[e.start + 1 :]
    return "".join(parts)


class Unigram:
    """Count-only Viterbi over a unigram vocabulary.

    The pieces are those of the model. scores: "zipf" gives the piece of id i the log-probability -ln(i + 1), "file"
    the number in the file. The automaton lists all matches; the best score up to a position and the number of pieces
    on that path are kept, nothing else. The unit is a word with its mark; a mark is put before a text that doesn't start
    with one. Of equally good paths the one whose last piece starts first stays, as
    candidates come in order of their start and only a better score replaces one. A character without a piece of its
    own costs 10 more than the worst piece; a run of them counts its UTF-8 bytes.
    """

    def __init__(self, model: bytes, scores: str = "zipf"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        keep = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        #: (piece, score) of each id that takes part, in order of id.
        self.vocabulary = [(sp.id_to_piece(i), -math.log(i + 1) if scores == "zipf" else sp.get_score(i)) for i in keep]
        self.automaton = Automaton({p: (len(p), x) for p, x in self.vocabulary})
        self.unknown = min(s for _, s in self.vocabulary) - 10.0
        self.word = re.compile(f"{MARK}[^{MARK}]*|[^{MARK}]+")
        self._remembered = Memory(self._count)

    def _count(self, word: str) -> int:
        best, count = [0.0], [0]
        found = self.automaton.found
        for end, state in enumerate(self.automaton.states(word)):
            top, pieces, single = None, 0, False
            for size, score in found[state]:  # longest first, so starts ascend
                x = score + best[end + 1 - size]
                if top is None or x > top:
                    top, pieces = x, count[end + 1 - size] + 1
                single = size == 1
            if not single:
                x = self.unknown + best[end]
                if top is None or x > top:
                    top, pieces = x, count[end] + len(word[end].encode())
            best.append(top)
            count.append(pieces)
        return count[-1]

    def _words(self, text: str) -> list[str]:
        marked = text.replace(" ", MARK)
        return self.word.findall(marked if marked[:1] == MARK or not text else MARK + marked)

    def count_batch(self, texts: list[str]) -> list[int]:
        distinct, places, ends = _indexed([self._words(t) for t in texts])
        each = np.fromiter((self._remembered(x) for x in distinct), np.int64, len(distinct))
        total = np.concatenate([[0], np.cumsum(each[places.to_numpy()] if len(distinct) else [])])
        at = ends.to_numpy()
        return (total[at[1:]] - total[at[:-1]]).astype(int).tolist()

    def count(self, text: str) -> int:
        return self.count_batch([text])[0]


@lru_cache(maxsize=2)
def pieces_of(model: bytes) -> Pieces:
    return Pieces(model)


@lru_cache(maxsize=2)
def unigram_of(model: bytes, scores: str) -> Unigram:
    return Unigram(model, scores)
