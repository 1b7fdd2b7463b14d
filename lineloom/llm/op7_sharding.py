"""Sharding by a hierarchical weighted hash tree. Law: `key`.

Rule: a document descends region, rack and shard. At each node every child draws -ln(u) / weight, u in (0, 1) from
a hash of doc_id and the child's name, and the least draw wins (of equal ones the first child). A draw depends on
nothing but doc_id, the child's name and its weight, so a change moves documents only where weights change: a child
that gains weight only takes, one that loses only gives.

Growth: a shard that joins later enters as a growth node at the root, with a weight of its own and a path of one
region, rack and shard, wherever it stands physically. The weights of the older nodes don't change, so one more shard
takes rows only into itself, and no other row moves.

Null doc_ids all hash alike and share a shard. Equal ids share a shard, also with different texts. Null texts have
size 8 and the CRC of the empty text. An empty table gives an empty one. slot numbers the rows of a shard without a gap
from 0, in no stated order. No task holds a shard: rows are numbered within hashed parts of shards, whose sizes are
summed before. The tree is bounded by the number of shards; only it is sent around, as literals in the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import buckets, cut, table


@dataclass(frozen=True)
class Node:
    """A subtree; a leaf has a shard."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int = -1


def tree(regions: int = 3, racks: int = 2, shards: int = 4, weights: dict[int, float] | None = None) -> Node:
    """regions x racks x shards leaves, numbered from 0; weights: of shards, 1 where not given."""
    weights = weights or {}
    top = []
    for r in range(regions):
        mid = []
        for q in range(racks):
            first = (r * racks + q) * shards
            leaves = tuple(Node(f"r{r}/q{q}/s{s}", float(weights.get(s, 1.0)), (), s) for s in range(first, first + shards))
            mid.append(Node(f"r{r}/q{q}", sum(x.weight for x in leaves), leaves))
        top.append(Node(f"r{r}", sum(x.weight for x in mid), tuple(mid)))
    return Node("", sum(x.weight for x in top), tuple(top))


def size(node: Node) -> int:
    return sum(map(size, node.children)) if node.children else 1


def grown(root: Node, weight: float = 1.0) -> Node:
    """root with one more shard, on a path of its own."""
    n = size(root)
    shard = Node(f"g{n}/q0/s{n}", weight, (), n)
    return Node(root.name, root.weight + weight, (*root.children, Node(f"g{n}", weight, (Node(f"g{n}/q0", weight, (shard,)),))))


def _draw(key: Column, child: Node) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / F.lit(child.weight)


def choose(key: Column, node: Node) -> Column:
    """The shard that key comes to below node."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return choose(key, node.children[0])
    draws = [F.struct(_draw(key, c).alias("draw"), F.lit(k).alias("child")) for k, c in enumerate(node.children)]
    won = F.least(*draws)["child"]
    out = None
    for k, c in enumerate(node.children[:-1]):
        out = (F.when if out is None else out.when)(won == k, choose(key, c))
    return out.otherwise(choose(key, node.children[-1]))


def shards(df: DataFrame, root: Node, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with size, text_crc32, law, shard, slot and grown_shard; columns of these names are replaced."""
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    df = df.drop(*new)
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.col(doc_id)
    placed = df.withColumns({"size": F.octet_length(raw).cast("long") + 8, "text_crc32": F.crc32(raw.cast("binary")), "law": F.lit("key"), "shard": choose(key, root)})
    more = grown(root)
    growth = F.least(*[F.struct(_draw(key, c).alias("draw"), F.lit(k).alias("child")) for k, c in enumerate(more.children)])["child"]
    return placed.withColumn("grown_shard", F.when(growth == len(more.children) - 1, F.lit(size(more) - 1)).otherwise(F.col("shard")))


def slots(placed: DataFrame, doc_id: str = "doc_id", each: int = 8 << 20) -> DataFrame:
    """Numbers the rows of each shard. placed is a written table with _row, a number of each row: ids that repeat are dealt out by it."""
    n = buckets(placed, each)
    part = placed.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit("slot")), F.lit(n)))
    counts = part.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = counts.select("shard", "_part", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(doc_id, "text_crc32", "_row"))
    return part.withColumn("_own", own).join(before, ["shard", "_part"]).withColumn("slot", (F.col("_before") + F.col("_own") - 1).cast("long")).drop("_part", "_own", "_before", "_row")


def assign(df: DataFrame, root: Node | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, without its text: what sharding decides. Join it by doc_id, or use shards() to keep texts."""
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    placed = cut(shards(df.select(*columns), root or tree()).drop("text").withColumn("_row", F.monotonically_increasing_id()), "shards")
    return slots(placed).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, path: str, root: Node | None = None) -> None:
    """The rows with their texts, in one folder per shard; large shards get many files."""
    shards(df, root or tree()).write.mode("overwrite").partitionBy("shard").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
