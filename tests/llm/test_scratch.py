"""What the stages of the pipeline leave in the shared folder, and rows that are left out without moving texts."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lineloom.llm import common

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
pipeline = pytest.importorskip("corpus_pipeline")


def _held(spark) -> dict[str, int]:
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in folder.iterdir()} if folder.exists() else {}


def test_tables_go_but_those_that_stay(spark):
    with common.passing(spark) as stays:
        inner = common.cut(spark.range(5), "inner")
        with common.passing(spark) as deeper:
            passed = deeper(common.cut(inner, "deepest"), "deeper")
            assert passed.count() == 5
        assert passed.count() == 5
        left = stays(passed, "left")
    names = _held(spark)
    assert left.count() == 5 and any(x.startswith("left-") for x in names)
    assert not any(x.startswith(("inner-", "deeper-", "deepest-")) for x in names)
    with pytest.raises(ValueError), common.passing(spark):
        common.cut(spark.range(5), "inner")
        raise ValueError
    assert not any(x.startswith("inner-") for x in _held(spark))
    assert common.cut(spark.range(5), "outer").count() == 5


@pytest.mark.parametrize("most", [None, 0])
def test_rows_left_out(spark, most):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 2, "d"), (3, None, "e")], "k int, x int, t string")
    gone = spark.createDataFrame([(1, 2), (None, 1), (4, 4)], "_k int, _x int")
    got = common.without(rows, gone, {"_k": "k", "_x": "x"}, most)
    assert sorted(r.t for r in got.collect()) == ["a", "d", "e"]
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == (most is None)


@pytest.mark.parametrize("name", ["quality_rules", "exact_dedup", "near_dedup"])
def test_stages_hold_no_texts(spark, name, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = _held(spark)
    out = dict(pipeline.STAGES)[name](spark, docs, sf)
    assert 0 < out.count() < docs.count()
    new = {k: n for k, n in _held(spark).items() if k not in before}
    assert len(new) == 1 and sum(new.values()) < 0.05 * Path(f"{sf}/documents.parquet").stat().st_size
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not any("hashpartitioning" in x for x in plan.splitlines())


def test_rows_that_differ_in_language_only(spark):
    """A verdict is of a row, not of its id and text."""
    text = " ".join(f"word{k}" for k in range(40)) + " #" * 3
    some = [(k, " ".join(f"w{k}x{j}" for j in range(60)), lang, "s") for k in range(400) for lang in ("a", "b")]
    some = [(d, t + (" # # # # #" if lang == "b" else ""), lang, s) for d, t, lang, s in some]
    twin = [(1000, text, x, "s") for x in ("a", "b")] + [(None, None, None, None)]
    docs = spark.createDataFrame([*some, *twin], "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    from lineloom.llm import op9_quality as op9

    whole = op9.judged(common.cut(op9.quality(docs), "whole")).where("kept").select(docs.columns)
    key = lambda df: sorted(((r.doc_id or -1, r.text or "", r.lang or "") for r in df.collect()))
    assert key(pipeline.quality_rules(spark, docs, "")) == key(whole)
