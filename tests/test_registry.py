"""Kept templates, teachers' answers, headers through the API, compaction by template, and measures."""

import random
import datetime as dt
import re

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lineloom import api
from lineloom.operators import metrics, registry, sinks, templates
from lineloom.operators.templates import Template
from lineloom.spec import FieldSpec

NOW = dt.datetime(2024, 1, 1)


def test_by_position():
    t = registry.by_position("Ann|a@example.com", FieldSpec(["name", "email"]))
    assert (t.field_map, t.delimiter, t.length_hint) == ({"name": "index:0", "email": "index:1"}, "|", 17)
    assert registry.by_position("Ann| ", FieldSpec(["name", "email"])) is None
    assert registry.by_position("a,b,c", FieldSpec(["name", "email"])) is None


def test_answers():
    line = '{"UserName":"Ann","contact_email":"a@example.com","n":1}'
    places = {"name": {"key": "username"}, "email": {"index": 9}, "n": {"index": 2}, "phone": "key:tel", "city": {"locator": "index:3", "type": "string"}, "note": {"regex": "x(.)"}, "bad": 7}
    t = registry.from_answer({"kind": "record-template", "template": {"field_map": places, "structure": "csv"}}, line)
    assert t.structure == "json" and t.length_hint == len(line)
    assert t.field_map == {"name": "key:UserName", "email": "key:contact_email", "n": "key:n", "phone": "key:tel", "city": "index:3", "note": "regex:x(.)", "bad": ""}
    t = registry.from_answer({"kind": "record-template", "template": {"field_map": {"a": {"index": 1}}, "delimiter": ";", "length_hint": 0}}, "x;y")
    assert (t.field_map, t.delimiter, t.length_hint, t.structure) == ({"a": "index:1"}, ";", 0, "csv")
    assert registry.from_answer({"kind": "record-template"}, "x") is None
    assert registry.from_answer({"kind": "record-template", "template": {}}, "x") is None


def test_signatures():
    line = "DEBUG [worker-1] started (ok)"
    assert registry.tightened(r"^DEBUG \[worker", line) == r"^DEBUG \[worker"
    for broad in (".*", "", r"^\w+:\w+$", "^ERROR something", "(a+)+"):
        assert re.fullmatch(registry.tightened(broad, line), line)
    t = registry.from_answer({"kind": "rubbish-signature", "template": {"signature": ".*", "confidence": 0.95}}, line)
    assert t.kind == "rubbish" and t.confidence == 0.95 and templates.rubbish_template([t], line) is t and templates.rubbish_template([t], "user:pass") is None


@given(st.lists(st.floats(0, 30), max_size=60), st.integers(1, 20), st.integers(1, 20))
def test_limiter(pauses, a_minute, burst):
    now, went = [0.0], []

    def sleep(s):
        now[0] += s

    limiter = registry.Limiter(a_minute, burst, lambda: now[0], sleep)
    for p in pauses:
        now[0] += p
        limiter.acquire()
        went.append(now[0])
    most = min(a_minute, burst)
    assert all(b - a >= 60 - 1e-6 for a, b in zip(went, went[most:]))  # noqa: B905


def test_asked():
    calls = []
    teach = registry.asked(lambda line, spec: calls.append(line), registry.Limiter())
    assert teach("a,b", FieldSpec(["x", "y"])).kind == "record" and not calls
    assert teach("no cells", FieldSpec(["x", "y"])) is None and calls == ["no cells"]


def test_registry_in_parse(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "log.txt").write_text("q1~Ann~x\nq2~Bob~x\nq3\n\njunk words here\n")
    spec = FieldSpec(["name"])
    again = api.parse(spark, str(d), spec, "j", NOW)
    assert again.lines.where("verdict = 'parsed'").count() == 0
    kept = spark.createDataFrame([Template("t", "text|8", "record", 3, {"name": "index:1"}, delimiter="~").row()], templates.SCHEMA)
    got = api.parse(spark, str(d), spec, "j", NOW, registry=kept)
    assert {(r.line_no, r.fields["name"], r.template_id, r.template_version) for r in got.lines.where("verdict = 'parsed'").collect()} == {(1, "Ann", "t", 3), (2, "Bob", "t", 3)}
    assert got.lines.count() == again.lines.count()


def test_registry_odd_rows(spark):
    ls = spark.createDataFrame([("s", 1, None), ("s", 2, ""), ("s", 2, "a,b,c"), ("s", 2, "a,b,c"), ("s", 3, "a,b," + "c" * 300_000)], "source string, line_no long, text string")
    rows = [Template("b", "csv|,|3", "record", 1, {"x": "index:1"}).row(), Template("a", "csv|,|3", "record", 1, {"x": "index:0"}).row()]
    known = spark.createDataFrame(rows, templates.SCHEMA)
    got = registry.by_fingerprint(ls, known, FieldSpec(["x"])).collect()
    assert sorted((r.verdict, r.template_id) for r in got if r.template_id) == [("parsed", "a")] * 3 and len(got) == 5
    assert registry.by_fingerprint(ls, known.limit(0), FieldSpec(["x"])).where("verdict = 'uncertain'").count() == 5
    assert registry.by_fingerprint(ls.limit(0), known, FieldSpec(["x"])).count() == 0


def test_detect_headers(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    row = '{"a":"%s"}\n' % ("x" * 90)
    (d / "big.ndjson").write_text(row * 13_000 + '{"late":1}\n' + row * 20)
    (d / "plain.csv").write_text("name,mail\nAnn,a@example.com\n")
    (d / "none.txt").write_text("https://a.b|12345678|Ann\n")
    (d / "empty").write_text("")
    got = {r.source.rpartition("/")[2]: (r.headers, r.headers_from) for r in api.detect(spark, str(d)).collect()}
    assert got == {"big.ndjson": (["a", "late"], "json-lines"), "plain.csv": (["name", "mail"], "header"), "none.txt": (None, None)}  # Spark lists no empty files
    seen = api.structures(spark, str(d)).collect()
    assert {(r.source.rpartition("/")[2], r.probes) for r in seen} == {("big.ndjson", 5), ("big.ndjson", 1), ("plain.csv", 1), ("none.txt", 1)}


def test_compaction_by_template(spark, tmp_path, monkeypatch):
    rows = spark.range(5000).select(F.lit("j").alias("_job_id"), F.col("id").alias("_byte_offset"), F.lit(0).alias("_record_index"), F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 10 < 9, "often").alias("_template_id"), F.sha2(F.col("id").cast("string"), 256).alias("fields"))
    rows.repartition(20).write.parquet(str(tmp_path / "in"))
    assert sinks.compact_groups(spark, str(tmp_path / "in"), str(tmp_path / "one")) == 1
    monkeypatch.setattr(sinks, "MERGE_MOST", 100_000)
    n = sinks.compact_groups(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    same = lambda df: sorted(map(tuple, df.select(rows.columns).collect()), key=repr)
    assert n > 4 and same(out) == same(rows) == same(spark.read.parquet(str(tmp_path / "one")))
    files = sinks.manifest(spark, str(tmp_path / "out")).collect()
    assert len(files) <= n and len({f.file_path.rpartition("/")[0] for f in files}) == 3


def test_rejected_and_reports_written(spark, tmp_path):
    bad = spark.createDataFrame([(1, 0, 3, 'a"b')], "line_no long, byte_offset long, byte_length int, raw_bytes string")
    dead = bad.withColumns({"failure_class": F.lit("uncertain"), "dlq_id": F.lit("d")})
    sinks.write_rejected(sinks.rejected(bad, dead).coalesce(1), str(tmp_path / "r"))
    text = b"".join(sorted(p.read_bytes() for p in (tmp_path / "r").glob("part-*"))).decode()
    head = "﻿" + ",".join(sinks.RUBBISH_COLUMNS)
    assert text.split("\r\n") == [head, '1,0,3,"a""b",rubbish,,,,', '1,0,3,"a""b",dlq,uncertain,,,d', ""]
    reports = spark.createDataFrame([("j1", '{"a":1}'), ("j2", "{}")], "job_id string, report string")
    sinks.write_reports(reports, str(tmp_path / "reports"))
    assert sorted(map(tuple, spark.read.text(str(tmp_path / "reports")).collect())) == [('{"a":1}', "j1"), ("{}", "j2")]


def test_observed(spark):
    df = spark.createDataFrame([("parsed",), ("parsed",), ("rubbish",), (None,)], "verdict string")
    out, seen = metrics.observed(df, {"job": "j", "at": "x"}, **metrics.verdict_measures())
    assert out.count() == 4
    assert seen.get == {"lines,at=x,job=j": 4, "parsed,at=x,job=j": 2, "rubbish,at=x,job=j": 1, "uncertain,at=x,job=j": 0}


def _random_patterns(r, n):
    words = ["error", "warning:", "level=", "debugging", "timeout", "user id", "xyzzy", "été chaud"]
    out = []
    for i in range(n):
        w = [re.escape(r.choice(words)) for _ in range(r.randint(1, 3))]
        form = r.choice(["{0}", "^{0}", "{0}\\d+", "{0}.*{1}", "({0}|{1})", "({0})?{1}", "{0}+{1}", "{0}?{1}", "[^a]{0}", "{0}$", "x|{0}"])
        out.append(templates.Template(f"t{i:05d}", f"f{i}", "rubbish", signature=form.format(w[0], w[-1]), confidence=r.choice([0.5, 0.95, 1.0])))
    return out


def test_signatures_by_gram(spark):
    r = random.Random(8)
    known = _random_patterns(r, 60) + [templates.Template(f"u{i:05d}", "f", "rubbish", signature=f"code {i:05d} at", confidence=1.0) for i in range(5000)]
    bits = ["error", "warning:", "level=", "debugging", "timeout", "user id", "xyzzy", "été chaud", "77", " ", "a", "code 00042 at", "code 04999 at", "erro", "x"]
    lines = ["".join(r.choices(bits, k=r.randint(0, 6))) for _ in range(300)] + ["", "warning:" * 9000]
    index = templates.RubbishIndex(known)
    want = [w.template_id if (w := templates.rubbish_template(known, x)) else None for x in lines]
    assert [g.template_id if (g := index.first(x)) else None for x in lines] == want and len(set(want)) > 8
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate(lines)] + [("s", 999, None)], "source string, line_no long, text string")
    got = {x.line_no: x.rubbish_id for x in templates.match_rubbish(df, spark.createDataFrame([t.row() for t in known], templates.SCHEMA)).collect()}
    assert [got[i] for i in range(len(lines))] == want and got[999] is None
    plain = [t for t in known if templates.grams(t.signature)]
    plan = templates.match_rubbish(df, spark.createDataFrame([t.row() for t in plain], templates.SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_record_templates_by_bound():
    r = random.Random(9)
    spec = FieldSpec(["email", "name", "phone", "city"])
    known = []
    for i in range(5000):
        structure = r.choice(["csv", "csv", "csv", "kv", "json", "fixed"])
        how = (lambda: f"index:{r.randint(0, 12)}") if structure in ("csv", "fixed") else (lambda: f"key:{r.choice('abcd')}")
        places = {f: r.choice([how, how, lambda: "regex:(x+)"])() for f in r.sample(["email", "name", "phone", "city"], r.randint(1, 4))}
        known.append(templates.Template(f"t{i}", "f", "record", field_map=places, structure=structure, delimiter=r.choice([",", ";", "~"]), length_hint=r.choice([0, 0, 5, 30])))
    index = templates.RecordIndex(known, spec)
    lines = [r.choice([",", ";", "~"]).join(r.choice(["a@example.com", "no", "+1 555 010 0101", "", "xx", "Rae"]) for _ in range(r.randint(1, 9))) for _ in range(60)]
    lines += ['{"a":"x","b":2}', "a: 1 - b: x", "", "{broken", "nothing"]
    for x in lines:
        assert index.best(x) == templates.best_template(known, x, spec)
    assert index.tried < 0.5 * len(lines) * len(known)


def test_signatures_that_share_short_grams(spark):
    """Numbers of seven digits share their six-byte grams; the longer ones that are used tell them apart. Texts of over a megabyte in a batch are cut."""
    known = [templates.Template(f"n{i:07d}", "f", "rubbish", signature=f"from Brand[#]{i % 5} part {i}:", confidence=1.0) for i in range(1_000_000, 1_003_000)]
    owners = {}
    for t in known:
        for g in templates.long_grams(t.signature):
            owners.setdefault(g, set()).add(t.template_id)
    assert all(min(len(owners[g]) for g in templates.long_grams(t.signature)) == 1 for t in known)
    lines = ["y" * (60_000 * (i % 3 == 0)) + f"note from Brand#{i % 5} part {i}: é" for i in range(1_000_000, 1_000_120)] + ["part 1000001:", "from Brand#1 part 100000", ""]
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate(lines)], "source string, line_no long, text string").coalesce(1)
    got = {x.line_no: x.rubbish_id for x in templates.match_rubbish(df, spark.createDataFrame([t.row() for t in known], templates.SCHEMA)).collect()}
    assert got == {i: f"n{1_000_000 + i:07d}" if i < 120 else None for i in range(len(lines))}
