"""What kind of file a line is in decides how it is read; dump mode, bad statements and denied labels."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lineloom import api
from lineloom.operators import classify as cl
from lineloom.sources import dumps, jsons
from lineloom.spec import FieldSpec, copy_targets, denied, guessed_map

NOW = dt.datetime(2024, 1, 1)
PG = """--
-- PostgreSQL database dump
--
SET client_encoding = 'UTF8';
COPY public.users (id, full_name, user_email, msisdn, note) FROM stdin;
1\tAnn Lee\tann@example.com\t+1 555 010 0101\tx
2\tBob\t15550100102\t\\N\t---
3\tCy\t15550100103\tcy@example.com\t
4\tDi
\\.
SELECT 1;
"""
MYSQL = """-- MySQL dump 10
CREATE TABLE `u` (
  `name` varchar(9),
  `email` text,
  PRIMARY KEY (`name`)
);
INSERT INTO `u` VALUES ('Ann','a@example.com'),('it
-- is
# not a comment
;','b@example.com');
INSERT INTO `u` VALUES broken;
INSERT INTO `u` (email, name) VALUES ('c@example.com', 'O\\'Cy');
"""


def _files(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "dump.sql").write_text(PG)
    (d / "my.sql").write_text(MYSQL)
    (d / "whole.json").write_text(json.dumps([{"email": "j1@example.com", "name": "J"}, {"email": "j2@example.com", "user_name": "K"}], indent=2))
    (d / "lines.ndjson").write_text('{"email":"n1@example.com"}\n{"email":"n2@example.com"}\n')
    (d / "rows.csv").write_text("email,name\nr1@example.com,Rae\n")
    (d / "bad.zip").write_bytes(b"PK\x03\x04 not a zip")
    return str(d)


def test_files_by_kind(spark, tmp_path):
    spec = FieldSpec(["email", "name"])
    got = api.parse(spark, _files(tmp_path), spec, "j", NOW)
    rows = [(r.source.rpartition("/")[2], r.verdict, r.template_id, (r.fields or {}).get("email"), r.failure_class) for r in got.lines.collect()]
    mails = {m for _, v, _, m, _ in rows if v == "parsed" and m}
    assert mails == {"j1@example.com", "j2@example.com", "n1@example.com", "n2@example.com", "r1@example.com", "a@example.com", "b@example.com", "c@example.com", "ann@example.com"}
    failed = {(s, f.split(":")[0]) for s, v, _, _, f in rows if v == "uncertain"}
    assert failed == {("my.sql", "unreadable_statement"), ("bad.zip", "unreadable_archive")}
    assert [t for s, _, t, _, _ in rows if s == "dump.sql"].count("pg-copy") == 4
    records = got.records.collect()
    assert len(records) == sum(v == "parsed" for _, v, _, _, _ in rows) and all(r._byte_offset is not None for r in records)
    assert got.dead_letters.count() == 2 and got.counts.first().parsed == len(records)
    assert "Scan binaryFile" not in got.records._jdf.queryExecution().executedPlan().toString()  # all tables come from the written verdicts


def test_retry_knows_the_layout_and_parse_counts(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "rows.csv").write_text("email,name\n" + "".join(f"r{i}@example.com,Rae\n" for i in range(5)) + ",\n")
    spec = FieldSpec(["email", "name"])
    got = api.parse(spark, str(d), spec, "j", NOW)
    assert {k: got.measures.get[k] for k in ("lines", "parsed")} == {"lines": 7, "parsed": 5}
    dead = got.dead_letters.withColumn("raw_bytes", F.lit("late@example.com,Lou"))
    assert dead.count() == 1 and dead.first().source.endswith("rows.csv")
    again = api.retry(dead, spec, ["uncertain"], layout=got.layout).first()
    assert (again.verdict, again.template_id, again.fields["name"]) == ("parsed", "csv-mapped", "Lou")


def test_known_columns(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x","c":null}',), ('{"b":2}',), ('{"z":2}',), ('{"a":3}',)], "text string")
    assert [(r.a, r.meta) for r in dumps.project_known(df, ["a", "meta"]).collect()] == [("1", '{"b":"x","c":null}'), (None, '{"b":2}'), (None, '{"z":2}'), ("3", None)]


def test_large_files_by_kind(spark, tmp_path, monkeypatch):
    """Whatever is read whole and what by splits: the same verdicts."""
    from lineloom.sources import lines

    path = _files(tmp_path)
    (tmp_path / "in" / "entries.bin").write_bytes(_zipped({"in.csv": "email,name\nz@example.com,Zed\n" * 9}))
    (tmp_path / "in" / "more.ndjson").write_text("".join(f'{{"email":"m{i}@example.com"}}\n' for i in range(12)))
    spec, got = FieldSpec(["email", "name"]), []
    for whole in (128 << 20, 200, 60):
        monkeypatch.setattr(lines, "WHOLE", whole)
        done = api.parse(spark, path, spec, "j", NOW).lines
        got.append(sorted(((r.source.rpartition("/")[2], r.line_no, r.byte_offset, r.byte_length, r.verdict, r.template_id, r.failure_class and r.failure_class.split(":")[0], json.dumps(r.fields, sort_keys=True)) for r in done.collect()), key=repr))
        assert api.detect(spark, path).where("dump = 'mysql' AND encoding = 'utf-8'").count() == 1
    assert got[0] == got[1] == got[2] and len(got[0]) > 40
    monkeypatch.setattr(jsons, "WHOLE_MOST", 100)
    dead = [r.failure_class for r in api.parse(spark, path, spec, "j", NOW).lines.where("source LIKE '%whole.json'").collect()]
    assert len(dead) == 1 and dead[0].startswith("too_large")


def _zipped(files):
    import io
    import zipfile

    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return b.getvalue()


def test_dump_mode(spark):
    spec = FieldSpec(["user_name", "full_name", "user_email", "msisdn"])
    ls = spark.createDataFrame([("d", i + 1, x) for i, x in enumerate(PG.splitlines())], "source string, line_no long, text string")
    got = {r.line_no: r for r in cl.classify_dump(ls, spec).collect()}
    assert [got[i].template_id if i in got else None for i in range(1, 12)] == [None, "pg-dump-start", "pg-sql-junk", "pg-sql-junk", "pg-copy-start", "pg-copy", "pg-copy", "pg-copy", "pg-copy", "pg-copy-end", "pg-sql-junk"]
    f = {i: got[i].fields for i in (6, 7, 8, 9)}
    assert (f[6]["user_name"], f[6]["user_email"], f[6]["msisdn"], json.loads(f[6]["meta"])) == ("Ann Lee", "ann@example.com", "+1 555 010 0101", {"id": "1", "note": "x"})
    assert (f[7]["user_email"], f[7]["msisdn"], json.loads(f[7]["meta"])) == (None, "15550100102", {"id": "2", "note": None})
    assert (f[8]["user_email"], f[8]["msisdn"]) == ("cy@example.com", "15550100103") and f[9]["full_name"] == "Di" and f[9]["user_email"] is None


def test_copy_targets():
    spec = FieldSpec(["email", "phone", "name"])
    assert copy_targets(["mail", "Email", "mobile", "x"], spec) == [None, "email", "phone", None]
    assert copy_targets(["mail", "mobile", "emails"], spec) == ["email", "phone", None]


def test_statements(spark):
    ls = spark.createDataFrame([("m", i + 1, i * 100, x) for i, x in enumerate(MYSQL.splitlines())], "source string, line_no long, byte_offset long, text string")
    got = dumps.mysql_all(ls).orderBy("byte_offset").collect()
    assert [bool(r.error) for r in got] == [False, False, True, False]
    assert json.loads(got[1].text)["name"].split() == ["it", "--", "is", "#", "not", "a", "comment", ";"] and json.loads(got[3].text) == {"email": "c@example.com", "name": "O'Cy"}


def test_documents_that_are_too_large(spark):
    df = spark.createDataFrame([("a", "[1]"), ("b", "[" + "1," * 50 + "1]"), ("c", None)], "k string, t string")
    assert [(r.k, r.error.split(":")[0]) for r in jsons.too_large(df, "t", ["k"], most=50).collect()] == [("b", "too_large")]


def test_whole_documents(spark):
    texts = ['{"a":1}', '{"a":1}\n', '{"a":1}\n{"a":2}', "[1,\n2]", "[1]\n[2]\n", "{\n}", '{\n"a":1}\nrest', "7", "", None, '\ufeff{"a":1}', '{"a":1,\n"b":"}"}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(jsons.is_whole(df.t)).collect()] == [True, True, False, True, False, True, False, False, False, False, True, True]


def test_denied_labels():
    assert all(map(denied, ["SNILS", "Passport No", "national-id", "ssn", "DOB", "Date of birth", "employer_name", "ИНН"]))
    assert not any(map(denied, ["email", "tinted", "Dobson", "inner", "name"]))
    assert guessed_map({"name": [0, 1], "email": 2, "x": 3, "phone": [1]}, ["name", "passport", "mail"], ["name", "email", "phone"]) == {"name": [0], "email": [2]}


def test_running_values_cross_stretches(spark):
    import random

    from pyspark.sql import functions as F

    from lineloom.operators import windows

    g = random.Random(4)
    rows = [(s, o, g.choice([None, 1, 2, 5]), g.choice([None, None, "a", "b"])) for s in ("x", "y", None) for o in sorted(g.sample(range(1, 400), 120))]
    df = spark.createDataFrame(rows, "s string, o long, n long, v string")
    got = {(r.s, r.o): (r.total, r.last, r.i) for r in windows.dense_index(windows.running(df, ["s"], "o", {"total": F.col("n")}, {"last": F.col("v")}, width=16), ["s"], "o", "i", width=7).collect()}
    for s in ("x", "y", None):
        total, last = 0, None
        for i, (_, o, n, v) in enumerate(r for r in rows if r[0] == s):
            total, last = total + (n or 0), v or last
            assert got[s, o] == (total, last, i)
    a, b = (sorted(map(tuple, dumps.mysql_all(spark.createDataFrame([("m", i * 60_000 + 1, i * 100, x) for i, x in enumerate(MYSQL.splitlines())][:n], "source string, line_no long, byte_offset long, text string")).drop("line_no").collect()), key=repr) for n in (100, 99))
    assert a == b and len(a) == 4


def test_windows_over_stretches(spark):
    """Sliding windows over the borders of stretches, and over stretches shorter than the window, equal plain ones."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lineloom.operators import stats, windows

    g = random.Random(6)
    rows = [(s, o, g.choice([None, 1, 2, 5])) for s in ("x", "y", None) for o in g.sample(range(1, 400), 90)]
    df = spark.createDataFrame(rows, "s string, o long, n long")
    for n, width in ((3, 16), (7, 3), (20, 5), (4, 4), (2, 1000)):
        own = Window.partitionBy("s").orderBy("o")
        want = df.withColumn("recent", F.collect_list("n").over(own.rowsBetween(-n, -1))).withColumn("rate", F.avg((F.col("n") > 1).cast("double")).over(own.rowsBetween(-(n - 1), 0)))
        got = stats.match_rate(windows.recent(df, ["s"], "o", "n", n, width=width), ["s"], "o", F.col("n") > 1, n, width)
        assert sorted(map(repr, got.select("s", "o", "recent", F.round("match_rate", 9).alias("rate")).collect())) == sorted(map(repr, want.select("s", "o", "recent", F.round("rate", 9).alias("rate")).collect()))


def test_first_load_and_nulls(spark):
    from lineloom.operators import sinks

    rows = spark.createDataFrame([("j", 1, 0, "a"), ("j", 1, 0, "a"), ("j", None, 0, "b"), ("k", 2, 0, "c")], "_job_id string, _byte_offset long, _record_index long, fields string")
    for _ in range(2):
        sinks.load(rows, "first_load")
        assert spark.table("first_load").count() == 3
    assert [r[0] for r in spark.sql("SHOW PARTITIONS first_load").collect()] == ["_job_id=j", "_job_id=k"]


def test_state_of_done_jobs_goes():
    import pandas as pd

    from lineloom.streaming import events

    class State:
        def __init__(self):
            self.exists, self.hasTimedOut, self.get, self.at = False, False, None, None

        def update(self, v):
            self.exists, self.get = True, v

        def remove(self):
            self.exists = False

        def setTimeoutTimestamp(self, ms):
            self.at = ms

        def getCurrentWatermarkMs(self):
            return 5

    def day(n, *statuses):
        return pd.DataFrame({"timestamp": pd.Timestamp("2024-01-01") + pd.Timedelta(days=n), "event_id": [f"{n}-{i}" for i in range(len(statuses))], "status": statuses})

    s = State()
    assert list(events._advance(("j",), iter([day(0, "Detecting", "Parsing")]), s))[0].status[0] == "Parsing" and s.at is None
    assert list(events._advance(("j",), iter([day(1, "Merging Output", "Saving to Database", "Reporting", "Completed")]), s))[0].status[0] == "Completed"
    assert s.at == pd.Timestamp("2024-01-03").value // 10**6
    s.hasTimedOut = True
    assert list(events._advance(("j",), iter([]), s)) == [] and not s.exists
