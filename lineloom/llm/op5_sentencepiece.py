"""SentencePiece encoding and decoding, merge-type, by backtracking.

Rule: the ids are those that the sentencepiece library gives for the model without begin and end ids and without
sampling; decoding those ids gives what the library's decode gives. See `pieces.Pieces` for the method: an
Aho-Corasick automaton gives the longest match at each position, adjacent tokens must survive re-merging, and a bit
field keeps the positions from which no way leads on.

Null is the empty text: no ids, empty decoding. Repeated rows are encoded each; an empty table gives an empty one;
other columns stay, but for those with the names of new ones, which are replaced. One pass, no shuffle.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import pieces, table, texts, tune
from .op1_token_counts import model_bytes
from .pieces import pieces_of


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds the ids (array of int) and, if asked, the text that they decode to."""
    tune(df.sparkSession)
    df = df.drop(ids, *([decoded] if decoded else []))
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        p = pieces_of(sent.value)
        for b in pieces(batches, 200):
            got, out = p.encode_batch([x.decode() for x in texts(b, text)])
            new = [pa.array([list(map(int, i.split(","))) if i else [] for i in got], pa.list_(pa.int32()))]
            if decoded:
                new.append(pa.array([d.decode() for d in out], pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that an array of ids decodes to; null ids decode to the empty text."""
    tune(df.sparkSession)
    df = df.drop(text)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        p = pieces_of(sent.value)
        for b in pieces(batches, 200):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([p.decode(x or []) for x in b.column(ids).to_pylist()], pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, the number of ids, and the SHA-256 of the ids and of the decoded text."""
    tune(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        p = pieces_of(sent.value)
        for b in pieces(batches):
            ids, out = p.encode_batch([x.decode() for x in texts(b, text)])
            n = [i.count(",") + 1 if i else 0 for i in ids]
            sha = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in ((i.encode() for i in ids), out)]
            yield pa.RecordBatch.from_arrays([b.column(doc_id), pa.array(n, pa.int64()), pa.array(sha[0], pa.string()), pa.array(sha[1], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    df = df.select(doc_id, text)
    return df.mapInArrow(run, T.StructType([T.StructField("doc_id", df.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), model_bytes())
