"""Mixing sources to target weights by soft membership.

Domains come from the labelled table: toxic, low (quality 0, not toxic) and good. A softmax classifier over hashed
words predicts for every document its posterior over the domains. Labels are taken to be wrong for a share `noise` of
rows, evenly: without this, a domain's wrong labels give every document some of it, and no rates can reach a small
target. A domain without labelled rows has the posterior 0.

Rates r >= 0, the expected number of times that a document is used, are fitted so that the expected domain token
totals, sum of r * tokens * posterior, match targets: least squares by projected gradient, distributed. With e the
totals less the targets, the gradient is p . e for a document with posterior p, each token counting alike; a step is
r <- max(0, r - p . g), g = (G + rho)^-1 e. G is the Gram matrix of posteriors over the documents whose rate isn't 0,
so with rho = 0 a step solves the least squares on these. rho grows until the sum of squares falls; at the trace of G,
which bounds its Lipschitz constant, it can't rise. So documents with like posteriors have like rates whatever their
length, and a step moves as many sums as there are pairs of domains. It ends when each total is close to its target.
Where no rates meet the targets, or only such as leave few documents in use, it ends when eight steps together hardly
lower the sum; rates are then still near those that meet the larger targets. fitted() gives back how far off they are.

Targets are shares per domain of a total at which the domain of the largest share, of those that have any, keeps all
its expected tokens. A domain that has less than its share is asked for all it has, so scarce domains are neither
repeated nor bound the others; one that has more goes down.

The classifier is fitted on at most `sample` labelled documents, those whose doc_id hashes least, each with its least
text: a bound on what the driver holds. Everything else covers all rows. Labels of one doc_id that disagree count
each; labels with a null are left out. Without any labelled document nothing is known: posteriors are even, rates 1.

Tokens are words. Null and empty texts have none; their rate is what their posterior gives. Repeated rows are rated
alike. An empty table gives an empty one. `mixed` takes floor(rate + u) copies of a row, u in [0, 1) from a hash of
doc_id and text, so it is the same whatever the partitions; it keeps the columns of its input, whatever their names,
and moves no row: the rows with their posteriors are written once, and read again with the rates.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, hidden, passing, pieces, table, texts, tune
from .words import hash64

DOMAINS = ("toxic", "low", "good")
WEIGHTS = {"toxic": 0.01, "low": 0.04, "good": 0.95}
BITS = 16
SAMPLE = 4000
NOISE = 0.05
LOG = logging.getLogger(__name__)
_PUNCTUATION = b".,;:!?\"'()[]{}"


def features(raw: bytes) -> tuple[np.ndarray, int]:
    """The distinct hashed words of a text, without case and outer punctuation, and of its marks; the number of words."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.int64), 0
    h = np.unique((hash64([w.strip(_PUNCTUATION) for w in words]) >> np.uint64(64 - BITS)).astype(np.int64))
    marks = sum(raw.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|"))
    # eight bins of marks per word and of distinct words per word
    rate = min(7, int(8 * marks / len(words)))
    rich = min(7, int(8 * len(set(words)) / len(words)))
    return np.concatenate([h, np.array([(1 << BITS) + rate, (1 << BITS) + 8 + rich])]), len(words)


WIDTH = (1 << BITS) + 16


class Classifier:
    """Multinomial logistic regression, in numpy, over the features that go with a domain.

    A feature is used if it is in `least` rows or more and its chi-square against the domains is at least `chi`; rarer
    ones go with a domain by chance too often. Of the labels a share `noise` is taken to be wrong, evenly.
    """

    def __init__(self, rows: list[np.ndarray], domain: np.ndarray, steps: int = 400, rate: float = 0.5, decay: float = 0.02, chi: float = 16.0, least: int = 3, noise: float = NOISE):
        n, c = len(rows), len(DOMAINS)
        counts = np.bincount(domain, minlength=c)
        known = counts > 0
        self.blank = not known.any()
        with np.errstate(divide="ignore"):
            self.bias = np.zeros(c) if self.blank else np.log(counts / max(1, n))
        self.weight = np.zeros((WIDTH, c), np.float64)
        if known.sum() < 2:
            return
        row = np.repeat(np.arange(n), [len(r) for r in rows])
        col = np.concatenate(rows)
        seen = np.stack([np.bincount(col[domain[row] == k], minlength=WIDTH) for k in range(c)], 1).astype(float)
        total = seen.sum(1, keepdims=True)
        chance = total * counts / n
        absent, no_chance = counts - seen, counts - chance
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.nansum((seen - chance) ** 2 / chance + (absent - no_chance) ** 2 / no_chance, 1)
        good = (score >= chi) & (total[:, 0] >= least)
        keep = good[col]
        row, col = row[keep], col[keep]
        used, at = np.unique(col, return_inverse=True)
        w, b = np.zeros((len(used), c)), self.bias.copy()
        # of each row: the chance of its label, given each domain
        chances = np.where(np.eye(c) > 0, 1 - noise, noise / (known.sum() - 1))[:, domain].T
        sums_w, sums_b = np.full((len(used), c), 1e-8), np.full(c, 1e-8)
        for _ in range(steps):  # Adagrad
            z = np.stack([np.bincount(row, w[at, k], n) for k in range(c)], 1) + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = p * (1 - chances / (p * chances).sum(1, keepdims=True)) / n
            g = np.stack([np.bincount(at, d[row, k], len(used)) for k in range(c)], 1) + decay * w / n
            sums_w += g**2
            sums_b += d.sum(0) ** 2
            w -= rate * g / np.sqrt(sums_w)
            b -= rate * d.sum(0) / np.sqrt(sums_b)  # stays without bound below for an unknown domain
        self.weight[used] = w
        self.bias = b

    def posterior(self, row: np.ndarray) -> np.ndarray:
        z = self.bias + self.weight[row].sum(0)
        p = np.exp(z - z.max())
        return p / p.sum()


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and domains of at most `sample` labelled documents, the same ones each time."""
    some = labels.where("quality IS NOT NULL AND toxic IS NOT NULL AND doc_id IS NOT NULL").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    some = some.select("doc_id", F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("domain"))
    some = some.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(sample)

    def run(batches):
        for b in pieces(batches, 200):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features(x)[0].astype(np.int32).tobytes() for x in texts(b)], pa.binary())], names=["domain", "f"])

    one = docs.join(F.broadcast(some), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))  # a row each, however often an id repeats
    got = one.select("domain", "text").mapInArrow(run, "domain int, f binary").collect()
    got = sorted(got)
    return [np.frombuffer(r["f"], np.int32).astype(np.int64) for r in got], np.array([r["domain"] for r in got], dtype=np.int64)


def soft(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with key (of the row's id and text), n_tokens and p, the posterior by DOMAINS. docs has none of these names."""
    tune(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n_tokens:long,p:array<double>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        for column in batches:
            n, p = [], []
            for raw in texts(pa.RecordBatch.from_arrays([column], names=["text"])):
                f, size = features(raw)
                n.append(size)
                p.append(m.posterior(f).tolist())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))], names=["n_tokens", "p"])

    raw = F.col(text).cast("string")
    return docs.withColumns({"key": F.xxhash64(F.col(doc_id), raw), "_s": judge(raw)}).select(*docs.columns, "key", "_s.n_tokens", "_s.p")


def _sums(soft: DataFrame, columns: list) -> np.ndarray:
    row = soft.agg(*[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return np.array([x or 0.0 for x in row])


def _stepped(r, g: list[float]):
    return F.greatest(F.lit(0.0), r - sum((F.col("p")[k] * F.lit(float(x)) for k, x in enumerate(g)), F.lit(0.0)))


def rate_of(steps: list[list[float]]):
    """The rate after the given steps, as a column: r starts at 1 and never goes under 0."""
    r = F.lit(1.0)
    for g in steps:
        r = _stepped(r, g)
    return r


def targets(supply: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The tokens asked of each domain."""
    lead = int(np.argmax(np.where(supply > 0, share, -1.0)))
    return np.minimum(share * supply[lead] / share[lead], supply) if share[lead] > 0 else supply * 0.0


@dataclass
class Fit:
    """The steps of the rates, and per domain its share by weight, the tokens asked for and the tokens reached."""

    steps: list[list[float]]
    share: np.ndarray
    target: np.ndarray
    reached: np.ndarray
    met: bool
    passes: int


def fitted(rows: DataFrame, weights: dict[str, float] = WEIGHTS, most: int = 100, close: float = 1e-3, enough: float = 0.9) -> Fit:
    """Steps of the projected gradient until the total of each domain is within `close` of its own target.

    rows has n_tokens and p. A pass over rows tries a step; it is taken if the sum of squares falls to `enough` of what it
    was, or, with the step of the Lipschitz bound, at all. The log has the shares of each domain by weight, as target and as
    reached; as a warning where scarcity lowers a target or where targets are missed.
    """
    c = len(DOMAINS)
    n = F.col("n_tokens").cast("double")
    p = [F.col("p")[k] for k in range(c)]
    pairs = [(i, j) for i in range(c) for j in range(i, c)]

    def look(r) -> tuple[np.ndarray, np.ndarray]:
        """The totals of the domains and the Gram matrix of the rows in use."""
        on = F.when(F.col("_r") > 0, n).otherwise(0.0)
        s = _sums(state.withColumn("_r", r), [n * x * F.col("_r") for x in p] + [on * p[i] * p[j] for i, j in pairs])
        gram = np.zeros((c, c))
        for (i, j), x in zip(pairs, s[c:], strict=True):
            gram[i, j] = gram[j, i] = x
        return s[:c], gram

    share = np.array([weights[d] for d in DOMAINS], float)
    share = share / share.sum()
    state, passes = rows.select("n_tokens", "p", F.lit(1.0).alias("r")), 1
    reached, gram = look(F.col("r"))
    target = targets(reached, share)
    if reached.sum() <= 0:
        return Fit([], share, target, reached, True, passes)
    allowed = close * np.where(target > 0, target, target[target > 0].min(initial=reached.sum()))  # a target of 0 goes by the least other one
    bound = float(np.trace(gram))
    rho = 1e-3 * bound
    sums = [float(((reached - target) ** 2).sum())]
    steps: list[list[float]] = []
    while passes < most and (np.abs(reached - target) > allowed).any() and not (len(sums) > 8 and sums[-1] > 0.95 * sums[-9]):
        # nine digits: whatever the order in which rows were summed, steps are the same
        g = [float(f"{x:.9g}") for x in np.linalg.solve(gram + rho * np.eye(c), reached - target)]
        got, new = look(_stepped(F.col("r"), g))
        passes += 1
        now = float(((got - target) ** 2).sum())
        good = now <= enough * sums[-1] or bool((np.abs(got - target) <= allowed).all())
        if good or rho >= bound and now < sums[-1]:
            steps.append(g)
            state = state.select("n_tokens", "p", _stepped(F.col("r"), g).alias("r"))
            if len(steps) % 8 == 0:  # a longer expression is no longer compiled
                state = cut(state, "state")
            reached, gram = got, new
            sums.append(now)
            rho = max(1e-9 * bound, rho / 4) if good else rho
        elif rho >= bound:
            break
        else:
            rho = min(bound, 10 * rho)
    met = bool((np.abs(reached - target) <= allowed).all())
    scarce = bool((target < share * target.sum() * (1 - close)).any())
    if not met:
        LOG.warning("rates end after %d passes with tokens of %s off their targets by %s", passes, DOMAINS, (reached / np.maximum(target, 1e-300) - 1).tolist())
    for d, *x in zip(DOMAINS, share, target / max(target.sum(), 1e-300), reached / max(reached.sum(), 1e-300), strict=True):
        LOG.log(logging.WARNING if scarce or not met else logging.INFO, "%s: share of tokens by weight %.4g, target %.4g, reached %.4g", d, *x)
    return Fit(steps, share, target, reached, met, passes)


def fit(rows: DataFrame, weights: dict[str, float] = WEIGHTS) -> list[list[float]]:
    """The steps only."""
    return fitted(rows, weights).steps


def _rated(rows: DataFrame, model: Classifier, weights: dict[str, float]) -> DataFrame:
    """rows with rate and copies. rows is read often and should be a written table."""
    u = F.shiftrightunsigned(F.xxhash64("key", F.lit("copies")), 11).cast("double") / F.lit(float(1 << 53))
    with passing(rows.sparkSession):
        rate = F.lit(1.0) if model.blank else rate_of(fit(rows, weights))
    return rows.withColumn("rate", rate).withColumn("copies", F.floor(F.col("rate") + u).cast("long"))


def rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, key, n_tokens, p, rate and copies of each row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = Classifier(*labelled(docs, labels, sample))
    return _rated(cut(soft(docs, model).drop("text"), "posteriors"), model, weights)


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs, each as often as its copies say, with the columns of docs."""
    model = Classifier(*labelled(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels, sample))
    own, at, back = hidden(docs)
    out = _rated(cut(soft(own, model, at["doc_id"], at["text"]), "posteriors"), model, weights)
    return back(out.where("copies > 0").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    p = {f"p_{d}": F.col("p")[k] for k, d in enumerate(DOMAINS)}
    return rates(docs, labels).withColumns(p).select("doc_id", "n_tokens", *p, "rate", "copies")
