"""From files to tables: verdicts are total, loads may be repeated, states agree between batch and stream."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lineloom.operators import classify as cl
from lineloom.operators import jobs, sinks, stats
from lineloom.sources.jsons import explode_document
from lineloom.sources.lines import read_lines
from lineloom.spec import FieldSpec
from lineloom.streaming import events as ev

NOW = dt.datetime(2024, 1, 1)


def _files(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_text("email,name,phone\nu1@example.com,Ann,15550100101\n\nu2@example.com,Bob,15550100102\nemail,name,phone\n\x01\x02\x03\x04\nshort\n")
    (d / "b.ndjson").write_text('{"email":"u3@example.com","name":"Cy"}\n[1,2]\n')
    (d / "c.txt").write_text("just some words\n")
    return str(d)


def test_files_to_tables(spark, tmp_path):
    spec = FieldSpec(["email", "name", "phone"])
    ls = read_lines(spark, _files(tmp_path))
    for native in (True, False):
        c = cl.classify(ls, spec, native=native).cache()
        assert c.count() == ls.count()
        assert {r.verdict: r["count"] for r in c.groupBy("verdict").count().collect()} == {"parsed": 5, "rubbish": 4, "uncertain": 1}
        rows = {r.email: r for r in cl.wide(c.where("verdict='parsed'"), spec).collect()}
        assert rows["u1@example.com"].phone == "15550100101" and rows["u3@example.com"].name == "Cy"
        c.unpersist()
    c = cl.classify(ls, spec).cache()
    rec, rub, dead = cl.records(c, "j1", NOW), cl.rubbish(c, "j1", NOW), cl.dead_letters(c, "j1", NOW)
    assert rec.count() + rub.count() + dead.count() == c.count()
    assert sorted(r._record_index for r in rec.collect()) == [0, 0, 1, 1, 2]
    assert {json.loads(r.fields)["email"] for r in rec.collect()} == {"u1@example.com", "u2@example.com", "u3@example.com", None, ""}
    out = str(tmp_path / "records")
    sinks.write_records(rec, out)
    assert sinks.new_rows(rec.unionAll(rec), spark.read.parquet(out), ("_job_id", "_byte_offset", "_checksum")).count() == 0
    assert sinks.manifest(spark, out).agg(F.sum("n_rows")).first()[0] == 5
    assert sinks.compact(spark, out, str(tmp_path / "small")) == 1 and spark.read.parquet(str(tmp_path / "small")).count() == 5
    sinks.load(rec, "loaded_records")
    sinks.load(rec, "loaded_records")
    assert spark.table("loaded_records").count() == 5
    assert sinks.rejected(rub, dead).count() == 5
    q = stats.quality_metrics(stats.job_counts(c.withColumn("job", F.lit("j")), ["job"])).first()
    assert (q.parsed, q.dropped_rubbish, q.total_failed, q.passes, q.on_hold) == (5, 4, 1, True, True)
    c.unpersist()


def test_native_and_python_agree(spark):
    spec = FieldSpec(["name", "city", "email"])
    text = ["id,name,city,email", "1,Ann,Rome,a@example.com", "2,,,", "3, Bob ,x,not mail", "4,a,b,c,d", ",,,", "id,name,city,email", '5,"q, r",s,t@example.com', "6,\x01\x02,x,y"]
    ls = spark.createDataFrame([("f", i + 1, x) for i, x in enumerate(text)], "source string, line_no long, text string")
    a, b = ({r.line_no: (r.verdict, r.template_id, r.failure_class, r.fields) for r in cl.classify(ls, spec, native=n).collect()} for n in (True, False))
    assert a == b


def test_empty_and_null(spark):
    spec = FieldSpec(["name"])
    none = spark.createDataFrame([], "source string, line_no long, text string")
    assert cl.classify(none, spec).count() == 0
    one = spark.createDataFrame([("f", 1, None), (None, 2, "x"), ("f", 3, "y" * 70_000)], "source string, line_no long, text string")
    assert {r.verdict for r in cl.classify(one, spec).collect()} == {"uncertain"}


def test_stated_headers_and_column_map(spark):
    ls = spark.createDataFrame([("f", 1, "Ann;a@example.com;x"), ("f", 2, "Bob;b@example.com;y")], "source string, line_no long, text string")
    got = cl.wide(cl.classify(ls, FieldSpec(["name", "email"]), headers=["name", "email", "other"]), FieldSpec(["name", "email"])).collect()
    assert [r.name for r in sorted(got, key=lambda r: r.line_no)] == ["Ann", "Bob"]


def test_whole_json(spark):
    df = spark.createDataFrame([("a", '[{"x":1},{"x":2}]'), ("o", '{"p":{"x":3},"q":[{"x":4},{"x":5}]}'), ("s", "7"), ("bad", "{nope"), ("n", None)], "k string, t string")
    got = {}
    for r in explode_document(df, "t", ["k"]).collect():
        got.setdefault(r.k, []).append(r.record)
    assert {k: len(v) for k, v in got.items()} == {"a": 2, "o": 3, "s": 1}


def test_states(spark, tmp_path):
    rows = [("e1", "DETECTION_COMPLETED", "j", 2, None), ("e0", "X", "j", 1, "Detecting"), ("e2", "PARSING_COMPLETED", "j", 3, None), ("e2", "PARSING_COMPLETED", "j", 3, None), ("e3", "DETECTION_COMPLETED", "j", 4, None), ("e4", "JOB_FAILED", "k", 1, None)]
    recs = [{"event_id": e, "event_type": t, "job_id": j, "source_service": "s", "timestamp": f"2024-01-01T00:00:0{s}Z", "data": json.dumps({"status": d} if d else {})} for e, t, j, s, d in rows]
    src = tmp_path / "ev"
    src.mkdir()
    (src / "1.json").write_text("\n".join(map(json.dumps, recs)))
    batch = {r.job_id: (r.status, r.applied, r.ignored) for r in jobs.fold(ev.asked(spark.read.schema(ev.SCHEMA).json(str(src)))).collect()}
    assert batch == {"j": ("Merging Output", 3, 1), "k": ("Failed", 1, 0)}
    q = ev.write_snapshots(ev.job_states(ev.read_events(spark, str(src))), str(tmp_path / "out"), str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.job_id: (r.status, r.applied, r.ignored) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == batch
    assert jobs.allowed("Created", "Detecting") and not jobs.allowed("Completed", "Failed")


def test_api(spark, tmp_path):
    import zipfile

    from lineloom import api
    from lineloom.operators.templates import offline_teacher

    path = _files(tmp_path)
    with zipfile.ZipFile(f"{path}/z.zip", "w") as z:
        z.writestr("d.csv", "email;name\nz@example.com;Zoe\n")
    jobs_ = api.submit(spark, path, ["email", "name"], now=NOW)
    job = jobs_.first().job_id
    assert job == api.submit(spark, path, ["email", "name"], now=NOW).first().job_id
    assert api.submit_all(spark, path, ["email"], NOW).count() == 4
    seen = {r.source.rpartition("/")[2]: r for r in api.detect(spark, path).collect()}
    assert seen["z.zip!d.csv"].headers == ["email", "name"] and seen["a.csv"].encoding == "utf-8" and seen["a.csv"].probes == [0]
    got = api.parse(spark, path, FieldSpec(["email", "name"]), job, NOW, teacher=offline_teacher)
    assert "z@example.com" in {json.loads(r.fields)["email"] for r in got.records.collect()}
    held = api.transition(api.transition(api.transition(jobs_, job, "Detecting", NOW), job, "Parsing", NOW), job, "Merging Output", NOW)
    held = api.transition(held, job, "On Hold", NOW)
    assert held.first().status == "On Hold" and api.transition(held, job, "Created", NOW).first().status == "On Hold"
    out = str(tmp_path / "stored")
    sinks.write_records(got.records, out)
    assert api.release_hold(spark, held, job, out, "released", NOW).first().status == "Saving to Database"
    assert spark.table("released").count() == got.records.count()
    dead = got.dead_letters
    assert api.retry(dead, FieldSpec(["email"]), ["uncertain"]).count() == dead.count()
    (tmp_path / "d.sql").write_text("CREATE TABLE `t` (`id` int, `name` text);\nINSERT INTO `t` VALUES (1,'a'),(2,'b');\n")
    assert [r.name for r in api.parse_dump(spark, str(tmp_path / "d.sql"), FieldSpec(["name", "meta"])).collect()] == ["a", "b"]
    (tmp_path / "w.json").write_text('[{"email":"a@example.com"},\n{"email":"b@example.com"}]')
    assert api.parse_json(spark, str(tmp_path / "w.json"), FieldSpec(["email"])).where("verdict='parsed'").count() == 2


def test_csv_files(spark, tmp_path):
    rows = spark.createDataFrame([({"a": 'x"y', "b,c": "1\n2", "meta": None},), ({"a": "é", "b,c": "", "meta": "{}"},)], "fields map<string,string>").coalesce(1)
    sinks.write_csv(rows, ["a", "meta", "b,c", "a"], str(tmp_path / "csv"))
    files = list((tmp_path / "csv").glob("part-*"))
    assert [f.read_bytes().decode() for f in files] == ['\ufeffa,"b,c",meta\r\n"x""y","1\n2",\r\né,,{}\r\n']
