"""Exact dedup by recipes of content-defined chunks.

Rule: texts are equal when their UTF-8 bytes are after lower-casing A-Z only; null counts as empty. Of equal texts the
row with the largest doc_id stays (null is the smallest id; of rows that repeat with that id, one).

A text is cut where a hash of the last eight bytes says so, so equal texts have equal chunks. Chunk contents are
moved once: a task sends each content it meets once, and per digest the least and the greatest content are compared.
Only if they agree for every digest are digests identifiers; else the next digest of `DIGESTS` is verified instead.
From then on a document is its recipe, the ordered list of its identifiers, and lists are compared, not texts.

Empty texts equal each other and have an empty recipe. An empty table gives an empty one. Columns beside doc_id and
text don't matter. A hot group of copies is one partial sum per task; its sum is sent to all tasks, and the rows of other groups
are joined by recipe.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, hidden, join_groups, passing, pieces, released, table, texts, tune, without

DIGESTS = {"xxh3_128": xxhash.xxh3_128_digest, "sha256": lambda b: hashlib.sha256(b).digest()}
LEAST, MEAN_BITS, MOST = 256, 11, 1 << 14


def chunks(text: bytes) -> list[bytes]:
    """Cuts text by content; a chunk but the last has LEAST to MOST bytes."""
    n = len(text)
    if n <= LEAST:
        return [text] if text else []
    seen = np.ndarray((n - 7,), "<u8", text, 0, (1,))
    marks = np.flatnonzero((seen * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEAN_BITS) == 0) + 8
    out, start = [], 0
    for m in [*marks.tolist(), n]:
        while m - start > MOST:
            out.append(text[start : start + MOST])
            start += MOST
        if m - start >= LEAST or m == n and m > start:
            out.append(text[start:m])
            start = m
    return out


def row_key(text: str = "text") -> Column:
    """With doc_id, what tells a row from others: a hash of its text as it is."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def recipes(df: DataFrame, digest: str) -> DataFrame:
    """doc_id, raw (as in row_key), the SHA-256 of the normalised text and its recipe."""
    tune(df.sparkSession)
    digests = DIGESTS

    def run(batches):
        of = digests[digest]
        for b in pieces(batches):
            low = [x.lower() for x in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([hashlib.sha256(x).hexdigest() for x in low], pa.string()), pa.array([b"".join(map(of, chunks(x))) for x in low], pa.binary())], names=["doc_id", "raw", "text_sha256", "recipe"])

    return df.select("doc_id", "text", row_key().alias("raw")).mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, raw long, text_sha256 string, recipe binary")


def contents(df: DataFrame, digest: str, held: int = 16 << 20) -> DataFrame:
    """Each chunk's digest and content; a task leaves out what it sent shortly before."""
    tune(df.sparkSession)
    digests = DIGESTS

    def run(batches):
        of = digests[digest]
        sent: dict[bytes, bytes] = {}
        size = 0
        for b in pieces(batches, 200):
            h, c = [], []
            for x in texts(b):
                for part in chunks(x.lower()):
                    key = of(part)
                    if sent.get(key) == part:
                        continue
                    h.append(key)
                    c.append(part)
                    if size > held:
                        sent.clear()
                        size = 0
                    sent[key] = part
                    size += len(part)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.binary()), pa.array(c, pa.binary())], names=["h", "content"])

    return df.select("text").mapInArrow(run, "h binary, content binary")


def verified_digest(df: DataFrame, digests: tuple[str, ...] = tuple(DIGESTS)) -> str:
    """The first digest that no two different chunks of df share."""
    for digest in digests:
        ends = contents(df, digest).groupBy("h").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
        with released(df.sparkSession):
            clash = ends.where("lo != hi").limit(1).count()
        if not clash:
            return digest
    raise ValueError("every digest gives different chunks one identifier")


def groups(df: DataFrame, digests: tuple[str, ...] = tuple(DIGESTS)) -> DataFrame:
    """Per row: doc_id, raw, keep_id, group_size, kept, text_sha256."""
    df = df.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = cut(recipes(df, verified_digest(df, digests)).withColumn("rid", F.monotonically_increasing_id()), "recipes")
    several = rows.groupBy("recipe").agg(F.max(F.struct("doc_id", "rid")).alias("best"), F.count("*").alias("n")).where("n > 1")
    out = join_groups(rows, several, "recipe", "n")
    alone = F.col("n").isNull()
    return out.select("doc_id", "raw", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("best.rid") == F.col("rid"))).alias("kept"), "text_sha256")


def kept(df: DataFrame, digests: tuple[str, ...] = tuple(DIGESTS)) -> DataFrame:
    """The rows of df that stay, with its columns."""
    own, at, back = hidden(df)
    with passing(df.sparkSession) as stays:
        marked = cut(groups(df, digests), "groups")
        good, gone = (marked.where(x).select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw")) for x in ("kept", "NOT kept"))
        with released(df.sparkSession):
            again = gone.intersect(good).limit(1).count()
        gone = stays(gone.subtract(good) if again else gone.distinct(), "gone")
    out = without(own.withColumn("_key", row_key(at["text"])), gone, {"_id": at["doc_id"], "_raw": "_key"})
    return back(out.dropDuplicates([at["doc_id"], "_key"]) if again else out)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
