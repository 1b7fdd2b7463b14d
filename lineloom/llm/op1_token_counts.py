"""Token counts by count-only Viterbi.

Rule: a text is cut into words, and each word into pieces of a unigram vocabulary so that the sum of their scores is
largest; see `pieces.Unigram` for ties and unknown characters. No piece is built, only counted.

Every row keeps its columns and gets the count. Null and empty texts count 0; rows that repeat are counted each; an
empty table gives an empty one. A column that has the name of the new one is replaced. Work is one pass without a
shuffle; a worker's memory is one small batch and a table of at most `pieces.REMEMBERED` short words.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, table, texts, tune
from .pieces import unigram_of

MODEL = "piece_bpe_32k.model"


def model_bytes(name_or_path: str = MODEL) -> bytes:
    """A public vocabulary by name, or any by its path. Half a megabyte, read on the driver and sent with the tasks."""
    import public_tokenizers

    path = name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)
    with open(path, "rb") as f:
        return f.read()


def token_counts(df: DataFrame, model: bytes, text: str = "text", out: str = "n_tokens", scores: str = "zipf") -> DataFrame:
    tune(df.sparkSession)
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        vocabulary = unigram_of(sent.value, scores)
        for b in pieces(batches):
            n = vocabulary.count_batch([x.decode() for x in texts(b, text)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*b.schema.names, out])

    return df.mapInArrow(count, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text"))
    return token_counts(docs, model_bytes()).select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), "n_tokens")
