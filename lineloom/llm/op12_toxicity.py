"""Toxic spans by a linear-chain conditional random field, and scores of documents from its marginals.

Tokens are runs without white space, lower-cased, without outer punctuation. A token's features are its word, its first
four, five and six characters and its last four, if it has more; so words of one root share features. Each token is in
the state toxic or not; weights of the features of a token, of the one before and the one behind it add up to its
evidence, and three weights rate the changes of state. Before the first token the state is "not".

Labels are of documents, so tokens get theirs from these: a feature counts as a toxic one if documents that hold it are
toxic beyond chance (the G statistic is above 2 ln of the number of features, so that hardly one passes by chance) and
by at least half. In a toxic document tokens with such a feature are labelled toxic; all other tokens are not. The field
is then fitted to the labelled tokens by maximum likelihood, forward-backward giving the gradient.

A document's score comes from its marginals: the greatest one, and the number over a half, through a logistic curve
that is fitted to the labels. Its offending spans are the runs of tokens with a marginal over a half, as code point
offsets. Tokens without evidence beside them all have one transfer matrix, so stretches of these are a power of it,
and forward-backward goes over the others only; it is exact.

Only labels of rows whose crc32(doc_id as text) modulo 5 isn't 0 are learned from, and of these at most `sample`
documents, those whose doc_id hashes least, one for each least hash of three words in a row, so that copies count
once; the driver holds at most `most` stretches of 32 tokens of them, 8192 features, and a pair of numbers for each
document. Scores read the text only and cover all rows.

Nulls: a null text is empty; an empty text has no evidence and gets the score of texts without any. A null doc_id is
held out. Null labels say nothing; a doc_id with several labels is toxic if one says so, and of several texts the least
one is learned from. Repeated rows are scored alike. Without labels of both kinds no feature is toxic and every score is
the share of toxic labels, smoothed. An empty table gives an empty one. Other columns stay, but for those named like
new ones, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, hidden, pieces, table, tune

SAMPLE, MOST, FEATURES, LENGTH, WIDE = 6000, 20_000, 8192, 32, 5
PUNCTUATION = ".,;:!?\"'()[]{}«»„“”¡¿"
TOKEN = re.compile(r"\S+")


def features(word: str) -> list[int]:
    """Hashes of what is seen of a token."""
    w = word.strip(PUNCTUATION)
    if not w:
        return []
    seen = ["w" + w] + [f"p{w[:n]}" for n in (4, 5, 6) if len(w) > n] + ([f"s{w[-4:]}"] if len(w) > 4 else [])
    return [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in seen]


class _Seen(dict):
    """Of each raw token the indices of its known features, a row of `rows`; 0 if it has none."""

    def __init__(self, index: dict[int, int]):
        super().__init__()
        self.index, self.rows, self.number = index, [()], {(): 0}

    def __missing__(self, token: str) -> int:
        if len(self) > 300_000:
            self.clear()
        own = tuple(i for f in features(token) if (i := self.index.get(f)) is not None)
        if own not in self.number:
            self.number[own] = len(self.rows)
            self.rows.append(own)
        self[token] = self.number[own]
        return self.number[own]


def forward_backward(e: np.ndarray, gap: np.ndarray, size: np.ndarray, change: np.ndarray, base: float, tail: np.ndarray) -> np.ndarray:
    """P(toxic) of each token that has evidence.

    e: evidence of these, document by document; gap: how many others lie before each; size: how many each document
    has; change: the log weights 0 to 1, 1 to 0 and 1 to 1; base: the evidence of all others; tail: how many of these
    end each document.
    """
    x, y, z = np.exp(change)
    b = np.exp(base)
    plain = np.array([[1.0, x * b], [y, z * b]])
    value, vector = np.linalg.eig(plain)
    inverse = np.linalg.inv(vector)

    def power(k: np.ndarray) -> np.ndarray:
        scaled = (value / value.max())[None, :] ** k[:, None]
        return np.real(np.einsum("ij,nj,jk->nik", vector, scaled, inverse))

    order = np.argsort(-size, kind="stable")
    start = (np.cumsum(size) - size)[order]
    count = size[order]
    weight = np.exp(np.clip(e, -30, 30))
    between = power(gap)
    ahead = np.empty((len(e), 2))
    back = np.empty((len(e), 2))
    steps = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(steps), side="left")  # documents with more than k tokens of evidence
    now = np.tile([1.0, 0.0], (len(count), 1))
    for k in range(steps):
        m = active[k]
        at = start[:m] + k
        u = np.einsum("ni,nij->nj", now[:m], between[at])
        v = np.stack([u[:, 0] + u[:, 1] * y, (u[:, 0] * x + u[:, 1] * z) * weight[at]], 1)
        v /= v.sum(1, keepdims=True)
        now[:m] = ahead[at] = v
    now = np.einsum("nij,j->ni", power(tail[order]), np.ones(2))
    for k in range(steps - 1, -1, -1):
        m = active[k]
        at = start[:m] + k
        if k + 1 < steps:
            m2 = active[k + 1]
            nxt = start[:m2] + k + 1
            ww = now[:m2] * np.stack([np.ones(m2), weight[nxt]], 1)
            u = np.stack([ww[:, 0] + x * ww[:, 1], y * ww[:, 0] + z * ww[:, 1]], 1)
            v = np.einsum("nij,nj->ni", between[nxt], u)
            now[:m2] = v / v.sum(1, keepdims=True)
        back[at] = now[:m]
    both = ahead * back
    return both[:, 1] / both.sum(1)


@dataclass
class Field:
    """Weights of features on the token itself, the one before and the one behind; of changes; and of the score."""

    known: list[int]
    own: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    change: np.ndarray
    base: float
    curve: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0, 0.0]))

    def tagger(self):
        """texts -> (document, token, marginal) of the tokens with evidence, and for each document its greatest marginal and its number over a half."""
        seen = _Seen({f: i for i, f in enumerate(self.known)})

        def tag(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            words = [t.lower().split() for t in texts]
            size = np.array([len(w) for w in words], np.int64)
            first = np.cumsum(size) - size
            row = np.fromiter((r for w in words for r in map(seen.__getitem__, w)), np.int64, int(size.sum()))
            doc = np.repeat(np.arange(len(texts)), size)
            hit = np.flatnonzero(row)
            e = np.full(len(row), self.base)
            for weights, shift in ((self.own, 0), (self.before, 1), (self.behind, -1)):
                at = hit + shift
                ok = (at >= 0) & (at < len(row))
                ok[ok] &= doc[at[ok]] == doc[hit[ok]]
                of_row = np.array([weights[list(r)].sum() for r in seen.rows])
                e[at[ok]] += of_row[row[hit[ok]]]
            near = np.unique(np.concatenate([hit - 1, hit, hit + 1])) if len(hit) else hit
            near = near[(near >= 0) & (near < len(row))]
            of, number = doc[near], np.bincount(doc[near], minlength=len(texts)) if len(near) else np.zeros(len(texts), np.int64)
            place = near - first[of]
            gap = np.diff(place, prepend=-1) - 1
            heads = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.empty(0, int)
            gap[heads] = place[heads]
            some = np.flatnonzero(number)
            ends = np.cumsum(number)[some] - 1
            tail = size[some] - 1 - place[ends] if len(some) else np.empty(0, np.int64)
            p = forward_backward(e[near], gap, number[some], self.change, self.base, tail)
            most, n = np.zeros(len(texts)), np.bincount(of[p > 0.5], minlength=len(texts))
            np.maximum.at(most, of, p)
            if len(seen.rows) > 100_000:
                seen.__init__(seen.index)
            return of, place, p, most, n

        return tag

    def score(self, most: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_seen_as(most, n) @ self.curve, -30, 30)))


def _seen_as(most: np.ndarray, n: np.ndarray) -> np.ndarray:
    p = np.clip(most, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(p)), np.log(p / (1 - p)) / 10, np.log1p(n)], 1)


def fit(known: list[int], ids: np.ndarray, label: np.ndarray, steps: int = 120, rate: float = 0.4, decay: float = 0.02) -> Field:
    """Maximum likelihood by Adagrad. ids: stretch x LENGTH x WIDE indices of known features, -1 for none, -2 in the first place behind a stretch's end."""
    n, w = len(ids), len(known)
    inside = (ids[:, :, 0] != -2).astype(float)
    own = np.where(ids < 0, w, ids)
    none = np.full((n, 1, WIDE), w)
    groups = (own, np.concatenate([none, own[:, :-1]], 1), np.concatenate([own[:, 1:], none], 1))
    theta = np.zeros(3 * (w + 1) + 4)
    theta[-4:] = [-4.0, -1.0, 0.0, -3.0]  # changes, then base
    total = np.full(len(theta), 1e-6)
    tokens = max(1.0, inside.sum())
    for _ in range(steps):
        weights = theta[: 3 * (w + 1)].reshape(3, w + 1)
        e = sum(weights[g][groups[g]].sum(2) for g in range(3)) + theta[-1]
        x, y, z = np.exp(theta[-4:-1])
        ew = np.exp(np.clip(e, -30, 30))
        # what lies behind a stretch's end has no evidence and no weight: identity steps
        a = np.empty((LENGTH + 1, n, 2))
        a[0] = [1.0, 0.0]
        for t in range(LENGTH):
            v = np.stack([a[t, :, 0] + a[t, :, 1] * y, (a[t, :, 0] * x + a[t, :, 1] * z) * ew[:, t]], 1)
            v /= v.sum(1, keepdims=True)
            a[t + 1] = np.where(inside[:, t, None] > 0, v, a[t])
        b = np.ones((n, 2))
        p1 = np.zeros((n, LENGTH))
        pair = np.zeros((n, LENGTH, 3))
        for t in range(LENGTH - 1, -1, -1):
            q0, q1 = b[:, 0], b[:, 1] * ew[:, t]
            joint = np.stack([a[t, :, 0] * q0, a[t, :, 0] * x * q1, a[t, :, 1] * y * q0, a[t, :, 1] * z * q1], 1)
            joint /= joint.sum(1, keepdims=True)
            p1[:, t] = joint[:, 1] + joint[:, 3]
            pair[:, t] = joint[:, 1:]
            v = np.stack([q0 + x * q1, y * q0 + z * q1], 1)
            v /= v.sum(1, keepdims=True)
            b = np.where(inside[:, t, None] > 0, v, b)
        before = np.concatenate([np.zeros((n, 1)), label[:, :-1]], 1)
        given = np.stack([(1 - before) * label, before * (1 - label), before * label], 2)
        d = (p1 - label) * inside
        grad = np.concatenate([*[np.bincount(g.ravel(), np.repeat(d.ravel(), WIDE), w + 1) for g in groups], ((pair - given) * inside[:, :, None]).sum((0, 1)), [d.sum()]])
        grad[: 3 * (w + 1)] += decay * theta[: 3 * (w + 1)]
        grad[[w, 2 * w + 1, 3 * w + 2]] = 0  # the place of "none"
        grad /= tokens
        total += grad**2
        theta -= rate * grad / np.sqrt(total)
    own_w, before_w, behind_w = theta[: 3 * (w + 1)].reshape(3, w + 1)[:, :w]
    return Field(known, own_w, before_w, behind_w, theta[-4:-1].copy(), float(theta[-1]))


def curve(most: np.ndarray, n: np.ndarray, toxic: np.ndarray, steps: int = 50, decay: float = 0.05) -> np.ndarray:
    """The logistic curve from marginals to labels, by Newton's method; more evidence never lowers a score."""
    x = _seen_as(most, n)
    w = np.zeros(3)
    w[0] = np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 1.5))
    use = np.array([True, True, True])
    if toxic.sum() in (0, len(toxic)):
        return w
    for _ in range(2):
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (p - toxic) + decay * w * [0, 1, 1]
            h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, decay, decay])
            w[use] -= np.linalg.solve(h[np.ix_(use, use)], g[use])
        if (w[1:] >= 0).all():
            break
        use[1:] = w[1:] > 0
        w[~use] = 0
    return w


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = MOST) -> Field:
    """The field. docs has doc_id and text."""
    spark = docs.sparkSession
    tune(spark)
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("toxic"))
    told = told.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    own = docs.join(F.broadcast(told), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def keyed(batches):
        for b in pieces(batches, 100):
            keys = []
            for t in b.column(2).to_pylist():
                w = t.lower().split()
                keys.append(min((xxhash.xxh3_64_intdigest(" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))), default=0) - (1 << 63))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1), b.column(2), pa.array(keys, pa.int64())], names=["id", "toxic", "text", "key"])

    marked = own.select("doc_id", "toxic", "text").mapInArrow(keyed, "id string, toxic int, text string, key long")
    some = cut(marked.groupBy("key").agg(F.min_by(F.struct("toxic", "text"), "id").alias("d")).select("key", "d.toxic", "d.text"), "labelled")

    def counted(batches):
        seen: dict[int, list[int]] = {}
        for b in batches:
            for toxic, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for f in {f for w in set(t.lower().split()) for f in features(w)}:
                    c = seen.setdefault(f, [0, 0])
                    c[0] += 1
                    c[1] += toxic
                if len(seen) > 200_000:
                    yield _counts(seen)
                    seen = {}
        yield _counts(seen)

    def _counts(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array([c[0] for c in seen.values()], pa.int64()), pa.array([c[1] for c in seen.values()], pa.int64())], names=["f", "n", "t"])

    totals = some.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = totals["n"], totals["t"]
    known: list[int] = []
    if 0 < t < n:
        counts = cut(some.mapInArrow(counted, "f long, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "counts")
        bound = 2 * np.log(max(2, counts.count()))
        share, rest = F.col("t") / F.col("n"), F.col("n") - F.col("t")
        g = 2 * (F.col("t") * F.log(share / F.lit(t / n)) + F.when(rest > 0, rest * F.log((1 - share) / F.lit(1 - t / n))).otherwise(0.0))
        best = counts.where((F.col("t") > 0) & (share >= 0.5) & (share > t / n)).withColumn("g", g).where(F.col("g") > float(bound)).orderBy(F.desc("g"), "f").limit(FEATURES)
        known = sorted(r["f"] for r in best.select("f").collect())
    if not known:
        return Field([], np.empty(0), np.empty(0), np.empty(0), np.zeros(3), 0.0, np.array([np.log((t + 0.5) / (n - t + 1.5)), 0.0, 0.0]))
    index = {f: i for i, f in enumerate(known)}

    def stretches(batches):
        seen = _Seen(index)
        for b in pieces(batches, 50):
            out = []
            for key, toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                row = [seen[w] for w in text.lower().split()]
                # those with a known feature, and one other as background
                starts = range(0, len(row), LENGTH)
                full = [s for s in starts if any(row[s : s + LENGTH])]
                bare = [s for s in starts if not any(row[s : s + LENGTH])]
                for s in full + bare[:1]:
                    ids = np.full((LENGTH, WIDE), -1, np.int16)
                    part = row[s : s + LENGTH]
                    ids[len(part) :, 0] = -2
                    for i, r in enumerate(part):
                        ids[i, : len(seen.rows[r])] = seen.rows[r]
                    y = np.array([bool(toxic and r) for r in part] + [False] * (LENGTH - len(part)), np.uint8)
                    out.append((key ^ s, ids.tobytes(), y.tobytes()))
            cols = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], names=["key", "ids", "y"])

    got = some.mapInArrow(stretches, "key long, ids binary, y binary").orderBy(F.xxhash64("key"), "ids", "y").limit(most).collect()
    ids = np.stack([np.frombuffer(r["ids"], np.int16).reshape(LENGTH, WIDE) for r in got]).astype(np.int64)
    model = fit(known, ids, np.stack([np.frombuffer(r["y"], np.uint8) for r in got]).astype(float))

    def tried(batches):
        tag = model.tagger()
        for b in pieces(batches, 100):
            *_, p, n = tag(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(p, pa.float64()), pa.array(n, pa.int64())], names=["toxic", "p", "n"])

    rows = sorted(some.mapInArrow(tried, "toxic int, p double, n long").collect())
    model.curve = curve(np.array([r["p"] for r in rows]), np.array([r["n"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return model


def held_out(doc_id: str):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def scored(df: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """df with score, predicted, and spans: array of (start, end, p), p being the greatest marginal of the span."""
    tune(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    new = ("score", "predicted", "spans")

    @F.arrow_udf("struct<score:double,spans:array<struct<start:int,end:int,p:double>>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        tag = m.tagger()
        for column in batches:
            scores, spans = [], []
            for k in range(0, len(column), 200):
                texts = [t or "" for t in column[k : k + 200].to_pylist()]
                of, place, p, most, n = tag(texts)
                scores.extend(m.score(most, n).tolist())
                found = [[] for _ in texts]
                bad = p > 0.5
                for d in np.unique(of[bad]).tolist():
                    mine = bad & (of == d)
                    at = dict(zip(place[mine].tolist(), p[mine].tolist(), strict=True))
                    last = -2
                    for i, token in enumerate(TOKEN.finditer(texts[d])):
                        if i in at:
                            if last == i - 1:
                                s, _, q = found[d].pop()
                                found[d].append((s, token.end(), max(q, at[i])))
                            else:
                                found[d].append((token.start(), token.end(), at[i]))
                            last = i
                spans.extend(found)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array([[dict(zip(("start", "end", "p"), s, strict=True)) for s in x] for x in spans], kind)], names=["score", "spans"])

    own, at, back = hidden(df)
    own = own.withColumn("_j", judge(F.col(at[text]).cast("string")))
    own = own.select(*at.values(), F.col("_j.score").alias("score"), F.when(F.col("_j.score") >= 0.5, 1).otherwise(0).alias("predicted"), F.col("_j.spans").alias("spans"))
    return back(own, new)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = scored(docs, learned(docs, table(spark, sf_dir, "labels")))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"), listed.alias("spans"))
