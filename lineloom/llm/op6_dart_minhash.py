"""Near-duplicate classes by DartMinHash.

Rule: a document is its shingles of five words (all its words, if fewer), each weighted by how often it occurs. The
similarity of two documents is the sum of the lesser weights over the sum of the greater ones; `weighted=False` takes
every weight as 1. Two documents are linked when it is 0.8 or more; a class is a connected component, named by its
least doc_id.

Signatures: over the plane of weight and rank of an element, cells of area one hold a Poisson(1) number of darts, drawn
from a hash of shingle and cell. A dart counts if it lies under the element's weight; each dart has one of K
coordinates, and a coordinate keeps its dart of least rank. Rows of cells are thrown until about K (ln K + 5) darts are
expected, and more where a coordinate is still empty, so a signature costs the shingles plus that. Two documents agree
at a coordinate with the probability of their weighted similarity.

Search: documents with equal weighted shingles are one representative (the least doc_id). Signatures are cut into
BANDS bands of ROWS; a pair of similarity 0.8 misses every band with a probability under 4e-7. Within a band's bucket
every member is compared to its leader, the least doc_id, not to each other; verified links are made components, and
buckets whose members are in one component are done. What is left, buckets of texts that are not all alike, is compared
exactly across components, those of like size only: a bucket in one task, or in blocks. Every link is verified: as
weights are whole numbers, the n-th occurrence of a shingle is an element of its own, and the similarity is that of the
sets of elements (six bytes of each one's hash).

Hot buckets and documents in many pairs are dealt to many tasks: groups of hot keys are sent to all tasks, and a
document's set is repeated once for each 64 of its rows. Slim rows are sent to all tasks while there are at most SENT. A task holds one leader's set, or the sets of one group.

Null and empty texts have no shingles and are each alone. Equal texts of fewer than five words are one class. Rows
that share a doc_id are judged as one document with the shingles of the one whose text hashes least. A null doc_id is
alone with class null. An empty table gives an empty one; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SENT, at_groups, cut, hidden, join_groups, mix, passing, pieces, released, runs, table, texts, tune, without
from .words import hash64, windows

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 28, 4
K = BANDS * ROWS
#: Buckets up to SMALL members are compared whole, larger ones in blocks of BLOCK members; HELD bounds the elements of either.
SMALL, BLOCK, HELD = 2048, 2048, 1 << 20
#: So many members are compared to a leader in one place.
LED = 256
#: Poisson(1): the chance of at most so many darts in a cell.
_TERMS = np.cumsum([1.0, *np.cumprod(1.0 / np.arange(1, 16))]) * np.exp(-1.0)
U53 = 1.0 / (1 << 53)


def shingles(raw: bytes, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of the shingles of a text, and how often each occurs."""
    words = raw.split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = hash64(words)
    n_own = min(n, len(words))
    return np.unique(windows(h, np.arange(len(words) - n_own + 1), n_own, 100 + n_own), return_counts=True)


def elements(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash for each occurrence of each shingle, so that weights become sizes of sets."""
    if not len(count) or count.max() == 1:
        return shingle
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    each = np.repeat(shingle, count)
    return np.where(nth == 0, each, mix(each + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * U53


def _throw(item: np.ndarray, weight: np.ndarray, owner: np.ndarray, first: np.ndarray, last: np.ndarray, k: int):
    """Darts of items in rank rows first to last - 1: (owner, coordinate, rank, dart)."""
    # weight cells: [0, 1), [1, 2), [2, 4), ...; a row of a cell of width w is 1 / w high, so that areas are one
    out = []
    level = 0
    while True:
        low, width = (0.0, 1.0) if level == 0 else (float(1 << (level - 1)), float(1 << (level - 1)))
        at = np.flatnonzero(weight > low)
        if not len(at):
            break
        rows_lo, rows_hi = first[at] * int(width), last[at] * int(width)
        count = rows_hi - rows_lo
        cell_of = np.repeat(at, count)
        row = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(rows_lo, count)
        seed = mix(item[cell_of] ^ mix(row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level + 1)))
        darts = np.searchsorted(_TERMS, _unit(mix(seed + np.uint64(1))), side="right")
        src = np.repeat(np.arange(len(seed)), darts)
        nth = (np.arange(len(src)) - np.repeat(np.cumsum(darts) - darts, darts)).astype(np.uint64)
        dart = mix(seed[src] + (nth + np.uint64(2)) * np.uint64(0xD1B54A32D192ED03))
        high = low + width * _unit(mix(dart + np.uint64(1)))
        ok = high <= weight[cell_of[src]]
        src, dart = src[ok], dart[ok]
        rank = (row[src] + _unit(mix(dart + np.uint64(2)))) / width
        out.append((owner[cell_of[src]], (mix(dart + np.uint64(3)) % np.uint64(k)).astype(np.int64), rank, dart))
        level += 1
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.uint64)]


def signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = K) -> np.ndarray:
    """A row of k dart hashes for each set; rows of empty sets are 0."""
    out = np.zeros((len(sets), k), np.uint64)
    best = np.full((len(sets), k), np.inf)
    total = np.array([len(s) if weights is None else float(np.sum(w)) for s, w in zip(sets, weights or sets, strict=True)])
    open_ = np.flatnonzero(total > 0)
    first = np.zeros(len(sets), np.int64)
    last = np.zeros(len(sets), np.int64)
    last[open_] = np.ceil(k * (log(k) + 5) / total[open_])
    while len(open_):
        size = np.array([len(sets[i]) for i in open_])
        item = np.concatenate([sets[i] for i in open_])
        weight = np.ones(len(item)) if weights is None else np.concatenate([weights[i] for i in open_]).astype(float)
        owner = np.repeat(open_, size)
        who, where, rank, dart = _throw(item, weight, owner, first[owner], last[owner], k)
        key = who * k + where
        order = np.lexsort((rank, key))
        at, _ = runs(np.append(True, key[order][1:] != key[order][:-1])) if len(order) else (np.empty(0, int), 0)
        least = order[at]
        flat, flat_out = best.reshape(-1), out.reshape(-1)
        better = least[rank[least] < flat[key[least]]]
        flat[key[better]] = rank[better]
        flat_out[key[better]] = dart[better]
        # a coordinate that has a dart has its least one, as all lower rows were thrown
        open_ = open_[np.isinf(best[open_]).any(axis=1)]
        first[open_] = last[open_]
        last[open_] *= 2
    return out


def _sketch(weighted: bool):
    """doc_id, the hash of the elements (16 bytes), their number and the band keys; rows without shingles have none."""

    def run(batches):
        for b in pieces(batches, 128):
            found = [shingles(x) for x in texts(b)]
            if not weighted:
                found = [(s, np.ones_like(n)) for s, n in found]
            sig = signatures([s for s, _ in found], [n for _, n in found] if weighted else None)
            keys = np.zeros((len(found), BANDS), np.uint64)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS] + np.arange(1, BANDS + 1, dtype=np.uint64))
            same = [xxhash.xxh3_128_digest(elements(s, n).tobytes()) if len(s) else None for s, n in found]
            bands = [k.view(np.int64).tolist() if len(s) else [] for k, (s, _) in zip(keys, found, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(same, pa.binary()), pa.array([int(n.sum()) for _, n in found], pa.int32()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "same", "size", "bands"])

    return run


def _sets(weighted: bool):
    def run(batches):
        for b in pieces(batches, 256):
            got = []
            for x in texts(b):
                s, n = shingles(x)
                got.append((elements(s, n) if weighted else s).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], names=["doc_id", "six"])

    return run


def _wide(six: bytes) -> np.ndarray:
    x = np.zeros((len(six) // 6, 8), np.uint8)
    x[:, :6] = np.frombuffer(six, np.uint8).reshape(-1, 6)
    return x.view("<u8").ravel()


class _Forest:
    """Links of a task as trees: only that much is sent on as tells what is linked."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def sent(self, most: int = 0) -> Iterator[pa.RecordBatch]:
        """(u, v) of each u whose tree's least member is another, v, once there are more than `most`; then it starts anew."""
        if len(self.up) > most:
            u = list(self.up)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array([self.root(x) for x in u], pa.int64())], names=["u", "v"])
            self.up = {}


#: Nodes of a forest that a task holds.
TREES = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    f = _Forest()
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            f.join(u, v)
        yield from f.sent(TREES)
    yield from f.sent()


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of links sorted by (u, v), v less than u: (u, its least v, false), and (v, that least, true) for each other v."""
    last, lead = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        u, v = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        new = np.append(last is None or u[0] != last, u[1:] != u[:-1])
        at = np.where(new, np.arange(len(u)), -1)
        at = np.maximum.accumulate(at)
        least = np.where(at < 0, lead, v[at])
        other = ~new & (v != least)
        last, lead = u[-1], least[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(u[new], v[other])), pa.array(np.append(v[new], least[other])), pa.array(np.repeat([False, True], [new.sum(), other.sum()]))], names=["u", "v", "other"])


def components(links: DataFrame) -> DataFrame:
    """(u, comp) of each id in a link (u, v) that isn't the least id it is connected to.

    Tasks contract their links to trees. Then each id keeps its least neighbour, which may have another one in turn, or
    the id may have more of them: these are links of a smaller graph, treated alike, until none is left. A long list
    of links of one id is sorted and streamed; a hot component's partition is split by adaptive execution.
    """
    spark, kind = links.sparkSession, "u long, v long"
    tune(spark)
    levels, edges = [], links.mapInArrow(_forest, kind)
    while True:
        step = cut(edges.repartition("u").sortWithinPartitions("u", "v").mapInArrow(_least, f"{kind}, other boolean"), "step")
        own = step.where("NOT other").select("u", "v")
        levels.append(own)
        chained = own.join(own.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        edges = cut(chained.unionByName(step.where("other").select("u", "v")).mapInArrow(_forest, kind), "edges")
        if edges.isEmpty():
            break
    comp = levels.pop().withColumnRenamed("v", "comp")
    for own in reversed(levels):
        over = comp.select(F.col("u").alias("v"), "comp")
        comp = own.join(over, "v", "left").select("u", F.coalesce("comp", "v").alias("comp")).unionByName(comp).groupBy("u").agg(F.min("comp").alias("comp"))
    return cut(comp, "comp")


def _led(least: float):
    """Links of leaders and members. Rows come by group: the leader with its set, then the members with theirs."""

    def run(batches):
        f, x = _Forest(), np.empty(0, np.uint64)
        for b in pieces(batches, 256):
            for lead, doc, six in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if doc == lead:
                    x = _wide(six)
                elif similar(x, _wide(six), least):
                    f.join(doc, lead)
            yield from f.sent(TREES)
        yield from f.sent()

    return run


def similar(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    if min(len(x), len(y)) < least * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both) - 1e-9


def _grouped(least: float):
    """Links between components within groups. Rows (group, role, comp, set) come sorted by group.

    Roles: 0 is compared to all queries, 1 is a query, 2 is both.
    """

    def run(batches):
        f, name, rows = _Forest(), None, []
        for b in pieces(batches, 256):
            for group, role, comp, six in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if group != name:
                    _compare(rows, f, least)
                    name, rows = group, []
                rows.append((role, comp, _wide(six)))
            yield from f.sent(TREES)
        _compare(rows, f, least)
        yield from f.sent()

    return run


def _compare(rows: list[tuple], f: _Forest, least: float) -> None:
    members, queries = [r for r in rows if r[0] != 1], [r for r in rows if r[0] != 0]
    if len(rows) <= 6:
        for i, (_, c, x) in enumerate(members):
            for _, d, y in queries if len(queries) < len(rows) else queries[i + 1 :]:
                if f.root(c) != f.root(d) and similar(x, y, least):
                    f.join(c, d)
        return
    if not members or not queries:
        return
    size = np.array([len(x) for _, _, x in members])
    flat = np.concatenate([x for _, _, x in members])
    owner = np.repeat(np.arange(len(members)), size)
    order = np.argsort(flat)
    flat, owner = flat[order], owner[order]
    comps = [c for _, c, _ in members]
    for _, comp, x in queries:
        lo, hi = np.searchsorted(flat, x), np.searchsorted(flat, x, side="right")
        hit = np.repeat(lo, hi - lo) + np.arange((hi - lo).sum()) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
        both = np.bincount(owner[hit], minlength=len(members))
        for c in {comps[k] for k in np.flatnonzero(both >= least * (len(x) + size - both) - 1e-9).tolist()}:
            f.join(c, comp)


def _dealt(open_: DataFrame, least: float) -> DataFrame:
    """Groups of large buckets: (name, role, id, comp).

    A member outside the bucket's main component is a query to all others. A group is a block of members and a chunk of queries.
    Similar documents' sizes differ by a factor of 1 / least at most, so members are dealt by classes of size, and each
    meets the others of its class and of the two beside it only. open_ has key, id, comp, size and outside.
    """
    ratio = -log(least) + 1e-6  # a little more than the greatest ratio, so that rounding can't part two classes
    open_ = cut(open_.withColumn("class", F.floor(F.log(F.col("size").cast("double")) / F.lit(ratio)).cast("int")), "open")
    parts = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / HELD)).cast("int")
    counts = open_.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum("size").alias("s"), F.count_if("outside").alias("out"), F.coalesce(F.sum(F.when(F.col("outside"), F.col("size"))), F.lit(0)).alias("so"))
    counts = cut(counts.select("key", "class", "n", parts(F.col("n"), F.col("s")).alias("blocks"), parts(F.col("out"), F.col("so")).alias("chunks")), "counts")
    other = counts.select("key", F.col("class").alias("to"), F.struct("class", "blocks", "chunks").alias("other"))
    beside = counts.withColumn("to", F.explode(F.array(*[F.col("class") + k for k in (-1, 0, 1)]))).join(other, ["key", "to"])
    # a row per bucket and class, with the at most three classes that it meets
    near = beside.groupBy("key", "class", "n", "blocks", "chunks").agg(F.collect_list("other").alias("others")).withColumn("kc", F.xxhash64("key", "class"))
    met = at_groups(open_.withColumn("kc", F.xxhash64("key", "class")).drop("key", "class"), cut(near, "near"), "kc", "n")

    def all_of(part: str) -> Column:
        """(class, number) of each part of the classes beside."""
        some = F.filter("others", lambda x: x[part] > 0)
        return F.explode(F.flatten(F.transform(some, lambda x: F.transform(F.sequence(F.lit(0), x[part] - 1), lambda k: F.struct(x["class"].alias("class"), k.alias("k"))))))

    spot = F.xxhash64("id")
    block, chunk = F.pmod(spot, F.col("blocks")).cast("int"), F.pmod(spot, F.greatest("chunks", F.lit(1))).cast("int")
    members = met.select("key", "id", "comp", F.lit(0).alias("role"), F.col("class").alias("mc"), block.alias("block"), all_of("chunks").alias("x"))
    members = members.select(F.struct("key", "mc", "block", F.col("x.class").alias("qc"), F.col("x.k").alias("chunk")).alias("g"), "role", "id", "comp")
    queries = met.where("outside").select("key", "id", "comp", F.lit(1).alias("role"), F.col("class").alias("qc"), chunk.alias("chunk"), all_of("blocks").alias("x"))
    queries = queries.select(F.struct("key", F.col("x.class").alias("mc"), F.col("x.k").alias("block"), "qc", "chunk").alias("g"), "role", "id", "comp")
    return members.unionByName(queries).select(_name("g"), "role", "id", "comp")


def _name(*of: str) -> Column:
    """128 bits that name a group."""
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *of)), 16, "0") for seed in (1, 2)]).alias("name")


def sent_if_few(df: DataFrame) -> DataFrame:
    """df, to be sent to all tasks if it has at most SENT rows; its rows are slim."""
    with released(df.sparkSession):
        few = df.count() <= SENT
    return F.broadcast(df) if few else df


def with_sets(rows: DataFrame, sets: DataFrame, of: str) -> DataFrame:
    """rows with the set `six` of the document `of`. One with many rows is dealt to many tasks, and its set is repeated for each 64 of them."""
    few = sent_if_few(rows)
    if few is not rows:
        return few.join(sets, few[of] == sets["doc_id"]).drop("doc_id")
    spread = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)).cast("int"))
    many = cut(rows.groupBy(of).agg(F.count("*").alias("n")).where("n > 64").select(F.col(of).alias("doc_id"), F.ceil(F.col("n") / 64).cast("int").alias("parts")), "many")
    if many.isEmpty():
        return rows.join(sets, rows[of] == sets["doc_id"]).drop("doc_id")
    parts = many.withColumnRenamed("doc_id", "_of")
    dealt = spread.join(parts, spread[of] == parts["_of"], "left").withColumn("_part", F.pmod("_part", F.coalesce("parts", F.lit(1)))).drop("_of", "parts")
    wide = sets.join(many, "doc_id", "left").select("doc_id", "six", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("_at"))
    return dealt.join(wide, (dealt[of] == wide["doc_id"]) & (dealt["_part"] == wide["_at"])).drop("doc_id", "_part", "_at")


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST, rounds: int = 1, weighted: bool = True) -> DataFrame:
    """doc_id, class_id of each row."""
    spark = df.sparkSession
    tune(spark)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    drawn = cut(docs.mapInArrow(_sketch(weighted), "doc_id long, same binary, size int, bands array<long>"), "darts")
    one = drawn.where("doc_id IS NOT NULL AND size > 0")
    reps = one.groupBy("same").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    # rows of one doc_id with different texts stand for the one document
    lead = one.select("doc_id", "same", "size", "bands").join(reps, [one["same"] == reps["same"], one["doc_id"] == reps["rep"]], "left_semi").dropDuplicates(["doc_id"])
    banded = cut(lead.select(F.col("doc_id").alias("id"), "size", "bands"), "leads").select("id", "size", F.explode("bands").alias("key"))
    # of buckets with the same members, by number, sum and parity of 64-bit hashes, one is enough
    counted = banded.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("x")).where("n > 1")
    counted = cut(counted.groupBy("n", "s", "x").agg(F.min("key").alias("key")).select("key"), "keys")
    member = cut(banded.join(sent_if_few(counted), "key", "left_semi").select("key", "id", "size"), "members")
    with released(spark):
        members = member.count()
    nodes = cut(member.select("id").distinct(), "nodes")
    few = sent_if_few(nodes)
    sets = cut(docs.join(few, docs["doc_id"] == few["id"], "left_semi").mapInArrow(_sets(weighted), "doc_id long, six binary").dropDuplicates(["doc_id"]), "sets")

    near = F.least("size", "size2") >= F.lit(least) * F.greatest("size", "size2") - 1e-9
    links, comp, rest = None, None, member
    for turn in range(rounds):
        # every member is compared to its bucket's leader
        rank = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
        chosen = rest.groupBy("key").agg(F.min_by(F.struct("id", "size"), rank).alias("l"), F.count("*").alias("n")).where("n > 1")
        rest = cut(at_groups(rest, chosen, "key", "n", total=members).where("id != l.id"), f"star-{turn}")
        star = rest.select("id", F.col("l.id").alias("lead"), "size", F.col("l.size").alias("size2"), "n").where(near)
        star = cut(star.groupBy("id", "lead").agg(F.max("n").alias("n")).withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / LED)).cast("int")), "pairs")
        rest = rest.select("key", "id", "size")
        sent = cut(star.select("lead", "chunk", "id").unionByName(star.select("lead", "chunk", F.col("lead").alias("id")).distinct()), "sent")
        full = with_sets(sent, sets, "id").repartition("lead", "chunk").sortWithinPartitions("lead", "chunk", F.col("id") != F.col("lead"))
        found = cut(full.select("lead", "id", "six").mapInArrow(_led(least), "u long, v long"), "links")
        links = found if links is None else links.unionByName(found)
    if links is not None:
        comp = components(links)
    # what is left: links across components within buckets, of any members but the leaders
    marked = rest.withColumn("comp", F.col("id")) if comp is None else rest.join(comp, rest["id"] == comp["u"], "left").select("key", "id", "size", F.coalesce("comp", "id").alias("comp"))
    marked = cut(marked, "marked")
    per = marked.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("s"), F.min("size").alias("lo"), F.max("size").alias("hi"))
    mixed = per.groupBy("key").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("main"))
    mixed = cut(mixed.where(F.col("comps") > 1).where((F.col("n") > 2) | (F.col("lo") >= F.lit(least) * F.col("hi") - 1e-9)).select("key", "n", "s", "main"), "mixed")
    if not mixed.isEmpty():
        fits = (F.col("n") <= SMALL) & (F.col("s") <= HELD)
        whole = marked.join(mixed.where(fits).select("key"), "key").select(_name("key"), F.lit(2).alias("role"), "id", "comp")
        large = mixed.where(~fits)
        if not large.isEmpty():
            open_ = at_groups(marked, large, "key", "n", total=members).select("key", "id", "comp", "size", (F.col("comp") != F.col("main")).alias("outside"))
            whole = whole.unionByName(_dealt(open_, least))
        dealt = cut(whole, "dealt")
        full = with_sets(dealt, sets, "id").repartition("name").sortWithinPartitions("name")
        across = cut(full.select("name", "role", "comp", "six").mapInArrow(_grouped(least), "u long, v long"), "across")
        over = components(across).select(F.col("u").alias("comp"), F.col("comp").alias("least"))
        # of each document's component the least one that it is connected to
        if comp is None:
            comp = over.select(F.col("comp").alias("u"), F.col("least").alias("comp"))
        else:
            comp = comp.join(over, "comp", "left").select("u", F.coalesce("least", "comp").alias("comp")).unionByName(over.select(F.col("comp").alias("u"), F.col("least").alias("comp")))
            comp = comp.groupBy("u").agg(F.min("comp").alias("comp"))
    of_set = reps if comp is None else reps.join(comp, reps["rep"] == comp["u"], "left")
    of_set = of_set.select("same", "copies", (F.col("rep") if comp is None else F.coalesce("comp", "rep")).alias("class"))
    return join_groups(drawn.select("doc_id", "same"), cut(of_set, "classes"), "same", "copies").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("class_id"))


def kept(df: DataFrame) -> DataFrame:
    """The rows of df whose doc_id names their class, with its columns; rows that share it stay."""
    own, at, back = hidden(df)
    with passing(df.sparkSession) as stays:
        named = classes(df).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("class_id")).alias("named"))
        gone = stays(named.where("NOT named").select(F.col("doc_id").alias("_id")), "gone")
    return back(without(own, gone, {"_id": at["doc_id"]}))


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
