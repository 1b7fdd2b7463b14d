"""Queries over the shared tables, one per operator or group of them, each with DuckDB SQL for the same result.

Where an operator works on lines, a query first renders a table as lines, so that the SQL can state the result directly.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.encoding import recover_mojibake
from ..functions.validate import CONTROLS, gate, is_email, is_phone, share
from ..operators import classify as cl
from ..operators import detect, jobs, metrics, profiles, registry, sinks, stats, templates, windows
from ..operators import headers as hd
from ..operators.cells import best_delimiter, merged_scheme
from ..ship import shared
from ..sources import archives, dumps, jsons, lines, parts
from ..spec import FieldSpec
from ..streaming import queue

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """rows in two tasks a core at least: where each row costs much, the bytes of a small file don't tell how many tasks it takes."""
    return rows.repartition(max(2 * rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def with_header(rows: DataFrame, source, header: str, line, key) -> DataFrame:
    """Rows as lines of delimited files with a header each. Line numbers needn't be dense: key + 2 keeps rows apart."""
    body = rows.select(source.cast("string").alias("source"), (key + 2).cast("long").alias("line_no"), line.alias("text"))
    head = rows.select(source.cast("string").alias("source")).distinct().select("source", F.lit(1).cast("long").alias("line_no"), F.lit(header).alias("text"))
    return head.unionByName(body)


def as_lines(rows: DataFrame, source, line, key) -> DataFrame:
    return rows.select(source.cast("string").alias("source"), (key + 1).cast("long").alias("line_no"), line.alias("text"))


# -- classification ---------------------------------------------------------------------------------------------------


@query("""
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents
FROM events GROUP BY event_type""")
def csv_roundtrip_agg(spark, sf_dir):
    """Events as comma-separated files with headers, classified, mapped by header, and counted."""
    e = t(spark, sf_dir, "events")
    ls = with_header(e, e.event_id % 8, "event_id,user_id,event_type,value", F.concat_ws(",", "event_id", "user_id", "event_type", "value"), e.event_id)
    rows = cl.wide(cl.classify(ls, FieldSpec(["event_id", "user_id", "event_type", "value"])).where("verdict = 'parsed'"), FieldSpec(["event_id", "user_id", "event_type", "value"]))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct(F.col("user_id").cast("long")).alias("users"), F.sum(F.round(F.col("value").cast("double") * 100).cast("long")).alias("cents"))


@query("""
SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, event_type FROM events""")
def json_extract_props(spark, sf_dir):
    """JSON lines, mapped by key."""
    e = t(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.col("event_id"), F.get_json_object("props", "$.k").cast("long").alias("k"), "event_type"))
    spec = FieldSpec(["event_id", "k", "event_type"])
    rows = cl.wide(cl.classify(as_lines(e, e.event_id % 8, line, e.event_id), spec).where("template_id = 'json'"), spec)
    return rows.select(F.col("event_id").cast("long").alias("event_id"), F.col("k").cast("long").alias("k"), "event_type")


@query("""
SELECT event_id, user_id, event_type, props->>'k' AS k FROM events""")
def json_nested_mapping(spark, sf_dir):
    """Nested objects, JSON within strings and arrays of objects, mapped by leaf."""
    e = t(spark, sf_dir, "events")
    inner = F.struct(F.struct(F.col("user_id"), F.col("event_type")).alias("actor"), F.col("props").alias("detail"), F.col("event_id").alias("event_id"))
    line = F.when(e.event_id % 2 == 0, F.to_json(inner)).otherwise(F.to_json(F.array(inner)))
    spec = FieldSpec(["event_id", "user_id", "event_type", "k"])
    rows = cl.wide(cl.classify(as_lines(e, e.event_id % 8, line, e.event_id), spec).where("verdict = 'parsed'"), spec)
    return rows.select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), "event_type", "k")


@query("""
SELECT c_custkey AS k, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def kv_extract(spark, sf_dir):
    """Lines of labels and values; what isn't asked for goes to meta and is read back from there."""
    c = t(spark, sf_dir, "customer")
    line = F.concat(F.lit("Name : "), "c_name", F.lit(" - Segment : "), "c_mktsegment", F.lit(" - Nation : "), F.col("c_nationkey").cast("string"))
    rows = cl.classify(as_lines(c, F.lit("kv"), line, c.c_custkey), FieldSpec(["name", "segment"])).where("template_id = 'kv'")
    return rows.select((F.col("line_no") - 1).alias("k"), F.col("fields")["name"].alias("name"), F.get_json_object(F.col("fields")["meta"], "$.Nation").alias("nation"))


@query("""
SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN chr(9) ELSE '|' END AS delimiter, 4 AS n, p_brand AS second
FROM part""")
def delimiter_guess(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    d = F.element_at(F.array(F.lit(","), F.lit(";"), F.lit("\t"), F.lit("|")), (F.col("p_partkey") % 4 + 1).cast("int"))
    cells = [F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")]
    line = F.concat(cells[0], d, cells[1], d, cells[2], d, cells[3])
    best = best_delimiter(line)
    return p.select(F.col("p_partkey").alias("k"), best["delimiter"].alias("delimiter"), best["n"].alias("n"), F.get(best["cells"], 1).alias("second"))


@query("""
SELECT s_suppkey AS k, 2 AS n, 'http://h' || s_suppkey || '/p' AS first FROM supplier""")
def scheme_colon(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    cells = F.split(F.concat(F.lit("http://h"), F.col("s_suppkey").cast("string"), F.lit("/p:"), "s_name"), ":")
    got = merged_scheme(cells, F.lit(":"))
    return s.select(F.col("s_suppkey").alias("k"), F.size(got).alias("n"), F.get(got, 0).alias("first"))


@query("""
SELECT c_custkey AS k, c_mktsegment || ', ' || c_name AS name, 'u' || c_custkey || '@example.com' AS email FROM customer""")
def column_map_join(spark, sf_dir):
    """Positions given by the caller, two of them for one field."""
    c = t(spark, sf_dir, "customer")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment", "c_name", F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@example.com")))
    spec = FieldSpec(["name", "email"], column_map={"name": [1, 2], "email": 3})
    rows = cl.classify(as_lines(c, F.lit("m"), line, c.c_custkey), spec).where("template_id = 'csv-column-map'")
    return cl.wide(rows, spec).select((F.col("line_no") - 1).alias("k"), "name", "email")


@query("""
SELECT s_suppkey AS k, 'u' || s_suppkey || '@example.com' AS email, '5550100' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS phone, s_name AS name FROM supplier""")
def content_typing(spark, sf_dir):
    """Lines without a header: e-mail and phone by their look, the rest as text."""
    s = t(spark, sf_dir, "supplier")
    n = F.col("s_suppkey").cast("string")
    line = F.concat_ws(";", "s_name", F.concat(F.lit("5550100"), F.lpad(n, 4, "0")), F.concat(F.lit("u"), n, F.lit("@example.com")), F.lit("7" * 9))
    spec = FieldSpec(["email", "phone", "name"])
    rows = cl.classify(as_lines(s, F.lit("x"), line, s.s_suppkey), spec).where("template_id = 'csv-auto'")
    return cl.wide(rows, spec).select((F.col("line_no") - 1).alias("k"), "email", "phone", "name")


@query("""
SELECT verdict, count(*) AS n FROM (
  SELECT CASE WHEN trim(line, ' ' || chr(9) || chr(13)) = '' THEN 'length-gate' ELSE 'open' END AS verdict
  FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents))
GROUP BY verdict""")
def gate_verdicts(spark, sf_dir):
    ls = lines.explode_text(t(spark, sf_dir, "documents"), "doc_id", "text")
    return ls.groupBy(F.coalesce(gate(F.col("text")), F.lit("open")).alias("verdict")).agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, (length(x) - length(regexp_replace(x, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'))) * 1000 // greatest(length(x), 1) AS per_mille
FROM (SELECT doc_id, coalesce(text, '') || repeat(chr(1), CAST(doc_id % 50 AS INT)) AS x FROM documents)""")
def control_ratio(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    x = F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit("\x01"), (F.col("doc_id") % 50).cast("int")))
    return d.select("doc_id", F.floor(F.coalesce(share(x, CONTROLS), F.lit(0.0)) * 1000 + 1e-9).cast("long").alias("per_mille"))


@query("""
SELECT fingerprint, count(*) AS n FROM (
  SELECT substr(sha256('csv|,|' || len(string_split(line, ',')) || '|utf-8'), 1, 24) AS fingerprint
  FROM (SELECT o_orderkey || ',' || o_custkey || ',' || o_orderstatus AS line FROM orders
        UNION ALL SELECT event_id || ',' || event_type FROM events))
GROUP BY fingerprint
UNION ALL
SELECT substr(sha256('json|k'), 1, 24), count(*) FROM events
UNION ALL
SELECT substr(sha256('empty'), 1, 24), count(*) FROM events
UNION ALL
SELECT substr(sha256('text|' || length(r_name) || '|utf-8'), 1, 24), count(*) FROM region GROUP BY length(r_name)""")
def fingerprint_groups(spark, sf_dir):
    o, e, r = (t(spark, sf_dir, n) for n in ("orders", "events", "region"))
    ls = o.select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus").alias("text")).unionByName(e.select(F.concat_ws(",", "event_id", "event_type").alias("text"))).unionByName(e.select(F.col("props").alias("text"))).unionByName(r.select(F.col("r_name").alias("text")))
    ls = ls.unionByName(e.select(F.expr("repeat(' ', cast(event_id % 5 AS int))").alias("text")))
    return detect.distinct_structures(ls).select("fingerprint", "n")


@query("""
SELECT fingerprint, count(*) AS n FROM (
  SELECT 'csv|,|3' AS fingerprint FROM orders UNION ALL SELECT 'json|k' FROM events UNION ALL SELECT 'text|' || length(r_name) FROM region)
GROUP BY fingerprint""")
def quick_fingerprints(spark, sf_dir):
    o, e, r = (t(spark, sf_dir, n) for n in ("orders", "events", "region"))
    ls = o.select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus").alias("text")).unionByName(e.select(F.col("props").alias("text"))).unionByName(r.select(F.col("r_name").alias("text")))
    return ls.groupBy(detect.quick_fingerprint(F.col("text")).alias("fingerprint")).agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders""")
def header_repeat_drop(spark, sf_dir):
    """Headers that come again within the file are rubbish."""
    o = t(spark, sf_dir, "orders")
    ls = with_header(o, F.lit("o"), "o_orderkey,o_custkey,o_orderstatus", F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"), o.o_orderkey)
    again = o.where("o_orderkey % 500 = 0").select(F.lit("o").alias("source"), (F.col("o_orderkey") + 10_000_000).cast("long").alias("line_no"), F.lit("O_ORDERKEY, O_CUSTKEY, O_ORDERSTATUS").alias("text"))
    spec = FieldSpec(["o_orderkey", "o_custkey", "o_orderstatus"])
    rows = cl.wide(cl.classify(ls.unionByName(again), spec).where("verdict = 'parsed'"), spec)
    return rows.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus")


@query("""
SELECT p_partkey AS k, p_name AS name, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part""")
def meta_pack(spark, sf_dir):
    """Columns that aren't asked for are packed into meta by their labels."""
    p = t(spark, sf_dir, "part")
    ls = with_header(p, p.p_partkey % 3, "p_partkey;name;brand;size", F.concat_ws(";", "p_partkey", "p_name", "p_brand", "p_size"), p.p_partkey)
    rows = cl.classify(ls, FieldSpec(["p_partkey", "name"])).where("verdict = 'parsed'").select("fields")
    f = F.col("fields")
    return rows.select(f["p_partkey"].cast("long").alias("k"), f["name"].alias("name"), F.get_json_object(f["meta"], "$.brand").alias("brand"), F.get_json_object(f["meta"], "$.size").alias("size"))


@query("""
SELECT c_custkey AS k, 'c' || c_custkey || '@example.com' AS email, c_name AS name FROM customer""")
def quoted_cells(spark, sf_dir):
    """Quoted cells with delimiters and quotes inside."""
    c = t(spark, sf_dir, "customer")
    line = F.concat(F.lit('"a ""b"", c",'), "c_name", F.lit(",c"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    ls = with_header(c, c.c_custkey % 2, "note,name,email", line, c.c_custkey)
    rows = cl.wide(cl.classify(ls, FieldSpec(["email", "name", "note"])).where("template_id = 'csv-mapped'"), FieldSpec(["email", "name", "note"]))
    return rows.where("note = 'a \"b\", c'").select((F.col("line_no") - 2).alias("k"), "email", "name")


@query("""
SELECT k, template_id FROM (
  SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'three' ELSE 'two' END AS template_id FROM nation)""")
def template_best_match(spark, sf_dir):
    """The record template that finds most fields; ties go to the first."""
    n = t(spark, sf_dir, "nation")
    line = F.when(n.n_nationkey % 2 == 0, F.concat_ws("~", F.lit("a"), F.col("n_name"), F.col("n_regionkey"))).otherwise(F.concat_ws("~", F.lit("a"), F.col("n_name")))
    ts = [templates.Template("two", "f2", "record", field_map={"label": "index:1"}, delimiter="~"), templates.Template("three", "f3", "record", field_map={"label": "index:1", "part": "index:2"}, delimiter="~")]
    return cl.classify(as_lines(n, F.lit("n"), line, n.n_nationkey), FieldSpec(["label", "part"]), ts).where("verdict = 'parsed'").select((F.col("line_no") - 1).cast("int").alias("k"), "template_id")


@query("SELECT l_orderkey AS k, l_partkey AS best FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey) = 1")
def template_rank(spark, sf_dir):
    """Native: the best of scored candidates, the first of equals."""
    scored = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("score"), F.struct("l_linenumber", "l_partkey").alias("order"), F.col("l_partkey").alias("best"))
    return templates.rank_templates(scored, ["k"], "score", "order").select("k", "best")


@query("""
SELECT event_id AS k, CASE WHEN event_type = 'error' THEN 'errors' END AS rubbish_id FROM events""")
def rubbish_signature(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    ls = e.select(F.lit("e").alias("source"), F.col("event_id").alias("line_no"), F.concat(F.lit("level="), F.upper("event_type"), F.lit(" user=x")).alias("text"))
    known = spark.createDataFrame([templates.Template("errors", "f", "rubbish", signature="^level=ERROR user", confidence=0.95).row(), templates.Template("weak", "g", "rubbish", signature="^level=CLICK user", confidence=0.5).row()], templates.SCHEMA)
    return templates.match_rubbish(ls, known).select(F.col("line_no").alias("k"), "rubbish_id")


@query("""
WITH sig AS (SELECT p_partkey, 'from ' || p_brand || ' part ' || p_partkey || ':' AS s, CASE WHEN p_size % 5 = 0 THEN 0.5 ELSE 0.95 END AS c FROM part),
line AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, 'note from ' || p_brand || ' part ' || l_partkey || ': ' || l_linenumber AS x FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN c >= 0.9 THEN 'sig' || lpad(p_partkey::VARCHAR, 8, '0') END AS rubbish_id
FROM line LEFT JOIN sig ON strpos(x, s) > 0""")
def rubbish_signatures_many(spark, sf_dir):
    """As many signatures as there are parts, each with two words that many of them share; a line meets few of them."""
    p, li = t(spark, sf_dir, "part"), t(spark, sf_dir, "lineitem")
    known = p.select(F.concat(F.lit("sig"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("template_id"), F.lit("rubbish").alias("kind"), F.when(F.col("p_size") % 5 == 0, 0.5).otherwise(0.95).alias("confidence"), F.concat(F.lit("from "), F.replace("p_brand", F.lit("#"), F.lit("[#]")), F.lit(" part "), F.col("p_partkey").cast("string"), F.lit(":")).alias("signature"))
    ls = li.join(p, li["l_partkey"] == p["p_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("note from "), "p_brand", F.lit(" part "), F.col("l_partkey").cast("string"), F.lit(": "), F.col("l_linenumber").cast("string")).alias("text"))
    return templates.match_rubbish(ls.distinct(), known, key=["l_orderkey", "l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "rubbish_id")


@query("""
SELECT event_type, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'rubbish' ELSE 'parsed' END AS event_type FROM events) GROUP BY event_type""")
def learned_templates(spark, sf_dir):
    """Unknown lines teach templates; what the offline teacher gives is applied to all lines."""
    e = dealt(t(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))
    text = F.when(e.event_type == "error", F.concat(F.lit("ERROR something at "), F.col("event_id").cast("string"))).otherwise(F.concat_ws(",", F.lit("x"), F.col("user_id").cast("string"), "event_type"))
    spec = FieldSpec(["tag", "number", "kind"])
    judged = lines.written(cl.classify(as_lines(e, F.lit("e"), text, e.event_id), spec))
    return cl.by_templates(judged, spec, templates.learn(judged.where("verdict = 'uncertain'"), spec)).groupBy(F.col("verdict").alias("event_type")).agg(F.count("*").alias("n"))


@query("""
SELECT fingerprint, max(version)::INT AS version, min(template_id) AS template_id FROM (
  SELECT 'f' || n_regionkey AS fingerprint, 2 AS version, 'old' || n_regionkey AS template_id FROM nation WHERE n_regionkey < 3
  UNION ALL SELECT 'f' || n_regionkey, 1, 'new' || n_regionkey FROM nation WHERE n_regionkey >= 3)
GROUP BY fingerprint""")
def template_upsert(spark, sf_dir):
    r = t(spark, sf_dir, "region").select("r_regionkey")
    k = F.col("r_regionkey").cast("string")
    shape = lambda prefix, version: [F.concat(F.lit(prefix), k).alias("template_id"), F.concat(F.lit("f"), k).alias("fingerprint"), F.lit(version).alias("version")]
    return templates.upsert(r.where("r_regionkey < 3").select(*shape("old", 1)), r.select(*shape("new", 1))).select("fingerprint", "version", "template_id")


@query("""
SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'record' WHEN 1 THEN 'rubbish' END AS kind, CASE c_custkey % 4 WHEN 0 THEN 'r' || c_custkey WHEN 1 THEN 'x' || c_custkey END AS template_id FROM customer""")
def template_cache_join(spark, sf_dir):
    """Lines and what is kept for just them: a record template before rubbish, rubbish only if it may be trusted."""
    c = t(spark, sf_dir, "customer")
    k, turn = F.col("c_custkey").cast("string"), c.c_custkey % 4
    ls = c.select(F.lit("c").alias("source"), (c.c_custkey + 1).alias("line_no"), F.concat(F.lit(" "), "c_name", F.lit("\t")).alias("text"))
    row = lambda kind, prefix, sure, when: c.where(when).select(detect.line_hash(F.upper("c_name")).alias("fingerprint"), F.concat(F.lit(prefix), k).alias("template_id"), F.lit(kind).alias("kind"), F.lit(1).alias("version"), F.lit(sure).alias("confidence"))
    kept = row("record", "r", 1.0, turn == 0).unionByName(row("rubbish", "x", 0.95, turn < 2)).unionByName(row("rubbish", "y", 0.9, turn == 2))
    return registry.by_line(ls, kept).select((F.col("line_no") - 1).alias("k"), "kind", "template_id")


@query("SELECT event_id AS k, CASE WHEN event_type <> 'error' THEN event_type END AS kind, CASE WHEN event_type <> 'error' THEN 2 END::INT AS version FROM events")
def template_registry(spark, sf_dir):
    """Lines meet the newest kept template of their structure; lines of other structures stay uncertain."""
    e = t(spark, sf_dir, "events")
    text = F.when(e.event_type == "error", F.concat_ws("~", "event_id", "event_type")).otherwise(F.concat_ws(",", F.lit("x"), F.col("user_id").cast("string"), "event_type"))
    kept = [templates.Template("old", "csv|,|3", "record", 1, {"kind": "index:0"}), templates.Template("new", "csv|,|3", "record", 2, {"kind": "index:2"}), templates.Template("junk", "csv|,|3", "rubbish", 9, signature="event_type", confidence=1.0)]
    spec = FieldSpec(["kind"])
    got = registry.by_fingerprint(as_lines(e, F.lit("e"), text, e.event_id), spark.createDataFrame([x.row() for x in kept], templates.SCHEMA), spec)
    return got.select((F.col("line_no") - 1).alias("k"), F.col("fields")["kind"].alias("kind"), F.col("template_version").alias("version"))


@query("""
SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'id,full_name' WHEN 1 THEN 'a,n' || c_nationkey || ',z' WHEN 2 THEN 'b,s' || c_nationkey WHEN 3 THEN 'email,t' || c_nationkey WHEN 4 THEN 'first name,mail' END AS headers,
       CASE c_custkey % 6 WHEN 0 THEN 'copy' WHEN 1 THEN 'json-lines' WHEN 2 THEN 'json-array' WHEN 3 THEN 'create-table' WHEN 4 THEN 'header' END AS origin
FROM customer""")
def source_labels(spark, sf_dir):
    """The labels of files of six kinds; one without any has none."""
    c = t(spark, sf_dir, "customer")
    n = F.col("c_nationkey").cast("string")
    copy = F.concat(F.lit('--\n-- PostgreSQL database dump\nCOPY public.u ("id", full_name) FROM stdin;\n1\t'), "c_name", F.lit("\n\\.\n"))
    objects = F.concat(F.lit('{"a":1,"n'), n, F.lit('":2}\nnot one\n{"z":[1],"a":2}\n'))
    array = F.concat(F.lit('[{"b":1},3,\n {"s'), n, F.lit('":2,"b":0}]'))
    create = F.concat(F.lit("-- MySQL dump 10\nCREATE TABLE `u` (\n  `email` varchar(9),\n  `t"), n, F.lit("` int,\n  PRIMARY KEY (`email`)\n) ENGINE=x;\nINSERT INTO `u` VALUES ('a',1);\n"))
    header, data = F.concat(F.lit("first name;mail\n"), "c_name", F.lit(";x\n")), F.concat(F.lit("\nhttps://a.b|12345678|"), "c_name", F.lit("\n"))
    head = F.element_at(F.array(copy, objects, array, create, header, data), (c.c_custkey % 6 + 1).cast("int"))
    files = c.select(F.col("c_custkey").cast("string").alias("source"), head.alias("head"))
    got = hd.source_headers(files, lines.explode_text(files, "source", "head"))
    return got.select(F.col("source").cast("long").alias("k"), F.array_join("headers", ",").alias("headers"), "origin")


@query("""
WITH f AS (SELECT doc_id, 16 * n_chars AS size FROM documents),
p AS (SELECT DISTINCT doc_id, size, CASE WHEN size <= 1024 THEN 0 ELSE (size - 1024) * i // 4 END AS o FROM f, range(5) r(i))
SELECT doc_id, CAST(o AS BIGINT) AS byte_offset, CAST((least(o + 1024, size) // 16 * 16 - CASE WHEN o = 0 THEN 0 ELSE (o // 16 + 1) * 16 END) // 16 AS BIGINT) AS n, TRUE AS whole
FROM p WHERE size > 0""")
def probe_windows(spark, sf_dir):
    """Whole lines within the windows of files of n_chars lines of 16 bytes."""
    d = t(spark, sf_dir, "documents")
    line = F.concat(F.lpad(d.doc_id.cast("string"), 15, "0"), F.lit("\n"))
    files = d.select(F.col("doc_id").cast("string").alias("source"), F.encode(F.repeat(line, F.col("n_chars").cast("int")), "UTF-8").alias("content"))
    got = hd.probe_lines(files, F.lit(1024))
    return got.groupBy(F.col("source").cast("long").alias("doc_id"), "byte_offset").agg(F.count("*").alias("n"), F.bool_and(F.col("text") == F.lpad("source", 15, "0")).alias("whole"))


@query("""
SELECT source AS kind, fingerprint_count AS n, template_id FROM (
  SELECT event_type AS source, count(*) AS fingerprint_count, CASE WHEN event_type = 'click' THEN 'kept' END AS template_id FROM events GROUP BY event_type)""")
def probe_templates(spark, sf_dir):
    """The structure of files that are one window each, and the template that is known for it."""
    e = t(spark, sf_dir, "events")
    line = F.when(e.event_type == "click", F.lit("a,b,c")).otherwise(F.concat_ws(";", F.lit("a"), "event_type"))
    files = e.groupBy("event_type").agg(F.count("*").alias("n"), F.min(line).alias("line")).select(F.col("event_type").alias("source"), F.encode(F.repeat(F.concat("line", F.lit("\n")), F.col("n").cast("int")), "UTF-8").alias("content"))
    known = spark.range(1).select(detect.fingerprint(F.lit("x,y,z")).alias("fingerprint"), F.lit("kept").alias("template_id"))
    return hd.probed_structures(files, F.lit(1 << 30), known).select(F.col("source").alias("kind"), "n", "template_id")


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def written_parts(spark, sf_dir):
    """Events written as two generations of many parts, which one of few parts takes the place of."""
    e, folder = t(spark, sf_dir, "events").select("event_id", "event_type"), shared(spark, "parts")
    for part in (0, 1):
        parts.write_parts(e.where(F.col("event_id") % 2 == part), folder, rows=2000)
    parts.compact(spark, folder)
    return parts.read_parts(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT event_id, event_type AS kind, 'a } \" [' || user_id AS note, 'C:\\dir' AS path, event_id % 3 = 2 AS listed FROM events")
def model_answers(spark, sf_dir):
    """Objects within what a model says: fenced, in prose, in a list, with brackets and quotes in strings and with escapes that aren't any."""
    e = t(spark, sf_dir, "events")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    obj = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "kind": '), quoted(F.col("event_type")), F.lit(', "note": '), quoted(F.concat(F.lit('a } \\" ['), F.col("user_id").cast("string"))), F.lit(', "in": {"path": "C:\\dir"}}'))
    obj = F.replace(obj, F.lit("C:\\dir"), F.lit("C:\\qdir"))
    said = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), obj, F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Sure, here it is: "), obj, F.lit(" - anything {else}?"))).otherwise(F.concat(F.lit("[\n"), obj, F.lit("\n]")))
    got = dealt(e.select("event_id", "event_type", "user_id")).select("event_id", F.explode(F.array(tx.answer_json(said))).alias("got"))  # once for all that is read from it
    at = lambda p: F.coalesce(F.get_json_object("got", f"$.{p}"), F.get_json_object("got", f"$[0].{p}"))
    return got.select("event_id", at("kind").alias("kind"), at("note").alias("note"), F.replace(at("in.path"), F.lit("qdir"), F.lit("dir")).alias("path"), (F.col("event_id") % 3 == 2).alias("listed"))


@query("""
SELECT o_custkey AS k, count(*) AS n, sum(length(line))::BIGINT AS chars, min(line) AS least FROM (
  SELECT o_custkey, translate(o_orderpriority || ' ' || o_comment_, 'abcdefghijklmnoprstuvwxyzABCDEFGHIJKLMNOPRSTUVWXYZ', 'абцдефгхийклмнопрстувшжызАБЦДЕФГХИЙКЛМНОПРСТУВШЖЫЗ') AS line
  FROM (SELECT *, 'ordered and delivered with the usual care and signed by hand ' || o_orderkey AS o_comment_ FROM orders)) GROUP BY o_custkey""")
def legacy_encodings(spark, sf_dir):
    """Orders of a customer as a file in windows-1251 or KOI8-R, read back by a guess."""
    o = t(spark, sf_dir, "orders")
    cyrillic = "абцдефгхийклмнопрстувшжызАБЦДЕФГХИЙКЛМНОПРСТУВШЖЫЗ"
    plain = F.concat(F.col("o_orderpriority"), F.lit(" ordered and delivered with the usual care and signed by hand "), F.col("o_orderkey").cast("string"))
    files = o.groupBy("o_custkey").agg(F.concat(F.array_join(F.collect_list(plain), "\n"), F.lit("\n")).alias("text"))

    def raw(name: str):
        """Letters become the bytes that the encoding has for Cyrillic ones."""
        return F.encode(F.translate("text", "abcdefghijklmnoprstuvwxyzABCDEFGHIJKLMNOPRSTUVWXYZ", "".join(x.encode(name).decode("iso-8859-1") for x in cyrillic)), "ISO-8859-1")

    content = F.when(F.col("o_custkey") % 2 == 0, raw("windows-1251")).otherwise(raw("koi8-r"))
    got = lines.from_binary(files.select(F.col("o_custkey").cast("string").alias("path"), content.alias("content")))
    return got.groupBy(F.col("source").cast("long").alias("k")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.min("text").alias("least"))


@query("SELECT event_type AS _template_id, CAST(greatest(1, ceil(count(*) * 1e9 / (SELECT count(*) FROM events) / 67108864)) AS INT) AS n_files FROM events GROUP BY event_type")
def group_files(spark, sf_dir):
    """Files for each template's rows, if all rows come to a billion bytes."""
    return sinks.group_files(t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("_template_id")).agg(F.count("*").alias("n")), 10**9)


@query("""SELECT 'j' || c_nationkey AS _job_id, CAST(c_custkey AS BIGINT) AS _byte_offset, CAST(0 AS BIGINT) AS _record_index, CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE 0 END AS BIGINT) AS _line_no, 'recovered' AS _part_id,
'{"name":"' || c_name || '","city":null}' AS fields FROM customer""")
def recovered_rows(spark, sf_dir):
    """Dead letters that were put right, as records."""
    c = t(spark, sf_dir, "customer")
    dead = c.select(F.concat(F.lit("j"), c.c_nationkey.cast("string")).alias("job_id"), F.col("c_custkey").alias("byte_offset"), F.lit(3).alias("byte_length"), F.when(c.c_custkey % 2 == 0, c.c_custkey).alias("line_no"), "c_name")
    fields = F.create_map(F.lit("name"), F.col("c_name"), F.lit("city"), F.lit(None).cast("string"), F.lit("_inner"), F.lit("x"))
    return sinks.recovered(dead, fields, "2024-01-01 00:00:00").select("_job_id", "_byte_offset", "_record_index", "_line_no", "_part_id", "fields")


@query("SELECT 'cents,event_type=' || event_type || ',parity=' || (user_id % 2) AS key, count(*) AS count, min(CAST(round(value * 100) AS BIGINT)) AS min, max(CAST(round(value * 100) AS BIGINT)) AS max, avg(CAST(round(value * 100) AS BIGINT)) AS avg FROM events GROUP BY ALL")
def value_histograms(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 2).alias("parity"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    return metrics.histograms(e, "cents", "cents", ["parity", "event_type"])


# -- counts, gates, reports -------------------------------------------------------------------------------------------


def _verdicts(spark, sf_dir) -> DataFrame:
    """Events as judged lines: a job per user, errors uncertain, views rubbish."""
    e = t(spark, sf_dir, "events")
    v = F.when(F.col("event_type") == "error", "uncertain").when(F.col("event_type") == "view", "rubbish").otherwise("parsed")
    return e.select((F.col("user_id") % 40).alias("job_id"), (F.col("event_id") + 1).alias("line_no"), v.alias("verdict"), F.when(v == "parsed", F.lit("csv-mapped")).when(v == "rubbish", "length-gate").alias("template_id"), F.when(v == "uncertain", F.when(F.col("event_id") % 3 == 0, "transform_error").otherwise("uncertain")).alias("failure_class"))


_VERDICTS = """WITH v AS (SELECT user_id % 40 AS job_id, event_id + 1 AS line_no, event_id,
  CASE event_type WHEN 'error' THEN 'uncertain' WHEN 'view' THEN 'rubbish' ELSE 'parsed' END AS verdict FROM events),
c AS (SELECT job_id, count(*) FILTER (verdict = 'parsed') AS parsed, count(*) FILTER (verdict = 'rubbish') AS dropped_rubbish,
  count(*) FILTER (verdict = 'uncertain') AS total_failed,
  count(*) FILTER (verdict = 'uncertain' AND event_id % 3 = 0) AS transform_error FROM v GROUP BY job_id)
"""


@query(_VERDICTS + "SELECT job_id, parsed, dropped_rubbish, total_failed, transform_error FROM c")
def verdict_counts(spark, sf_dir):
    c = stats.job_counts(_verdicts(spark, sf_dir), ["job_id"])
    return c.select("job_id", "parsed", "dropped_rubbish", "total_failed", F.coalesce(F.try_element_at("failed_by_class", F.lit("transform_error")), F.lit(0)).alias("transform_error"))


@query(_VERDICTS + """SELECT (line_no - 1) // 1000 AS stretch, CASE verdict WHEN 'parsed' THEN 'csv-mapped' WHEN 'rubbish' THEN 'length-gate' ELSE verdict END AS key, count(*) AS n FROM v GROUP BY ALL""")
def verdict_distribution(spark, sf_dir):
    return stats.verdict_distribution(_verdicts(spark, sf_dir), 1000)


@query(_VERDICTS + """SELECT job_id, CAST(parsed + total_failed AS BIGINT) AS total_lines, parsed >= 1 OR total_failed <= 0.7 * (parsed + total_failed) AS passes,
  total_failed > 0.05 * (parsed + total_failed + dropped_rubbish) AS on_hold FROM c""")
def quality_gates(spark, sf_dir):
    return stats.quality_metrics(stats.job_counts(_verdicts(spark, sf_dir), ["job_id"])).select("job_id", "total_lines", "passes", "on_hold")


@query(_VERDICTS + """SELECT job_id, n, truncated, unnest(lines) AS line_no FROM (
  SELECT job_id, count(*) AS n, count(*) > 5 AS truncated, list_slice(list(line_no ORDER BY line_no), 1, 5) AS lines FROM v WHERE verdict = 'uncertain' GROUP BY job_id)""")
def dlq_summary_topn(spark, sf_dir):
    s = stats.rejected_summary(_verdicts(spark, sf_dir).where("verdict = 'uncertain'"), ["job_id"], "failure_class", most=5)
    return s.select("job_id", "n", "truncated", F.explode("line_numbers").alias("line_no"))


@query(_VERDICTS + "SELECT job_id, count(*) AS n, 1 AS kinds FROM v WHERE verdict = 'rubbish' GROUP BY job_id")
def rubbish_summary(spark, sf_dir):
    s = stats.rejected_summary(_verdicts(spark, sf_dir).where("verdict = 'rubbish'"), ["job_id"], "template_id")
    return s.select("job_id", "n", F.size("by_template_id").alias("kinds"))


@query("SELECT user_id % 40 AS job_id, event_type AS _template_id, count(*) AS n FROM events GROUP BY ALL")
def template_usage(spark, sf_dir):
    return stats.template_usage(t(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("job_id"), F.col("event_type").alias("_template_id")), ["job_id"])


@query(_VERDICTS + "SELECT job_id, CASE WHEN job_id % 2 = 0 THEN 'Completed' ELSE 'Parsing' END AS status, parsed, CAST(3 AS BIGINT) AS n_parts FROM c")
def job_report(spark, sf_dir):
    counts = stats.job_counts(_verdicts(spark, sf_dir), ["job_id"])
    js = counts.select("job_id", F.when(F.col("job_id") % 2 == 0, "Completed").otherwise("Parsing").alias("status"))
    parts = counts.select("job_id", F.explode(F.array(*[F.lit(i).cast("long") for i in (1, 2, 3)])).alias("byte_size"))
    r = stats.report(js, counts, parts)
    j = lambda p: F.get_json_object("report", p)
    return r.select("job_id", j("$.status").alias("status"), j("$.counts.parsed").cast("long").alias("parsed"), j("$.output.n_parts").cast("long").alias("n_parts"))


_JOBS = """WITH j AS (SELECT c_custkey AS job_id, c_nationkey AS batch_id, CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 7 = 0 THEN 'Parsing'
  WHEN c_custkey % 5 = 0 THEN 'Failed' WHEN c_custkey % 5 = 1 THEN 'Partial' ELSE 'Completed' END AS status,
  CAST(c_custkey % 11 AS BIGINT) AS parsed, CAST(c_custkey % 3 AS BIGINT) AS dropped_rubbish FROM customer)
"""


def _jobs(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    status = F.when((F.col("c_nationkey") % 2 == 0) & (k % 7 == 0), "Parsing").when(k % 5 == 0, "Failed").when(k % 5 == 1, "Partial").otherwise("Completed")
    return t(spark, sf_dir, "customer").select(k.alias("job_id"), F.col("c_nationkey").alias("batch_id"), status.alias("status"), (k % 11).cast("long").alias("parsed"), (k % 3).cast("long").alias("dropped_rubbish"))


@query(_JOBS + "SELECT batch_id, count(*) AS n_jobs, sum(parsed)::BIGINT AS parsed, sum(dropped_rubbish)::BIGINT AS dropped_rubbish FROM j GROUP BY batch_id HAVING bool_and(status <> 'Parsing')")
def batch_rollup(spark, sf_dir):
    return stats.batch_rollup(_jobs(spark, sf_dir)).select("batch_id", "n_jobs", "parsed", "dropped_rubbish")


@query(_JOBS + """SELECT batch_id, count(*) AS total, count(*) FILTER (status = 'Completed') AS completed, count(*) FILTER (status = 'Failed') AS failed,
  count(*) FILTER (status = 'Partial') AS partial, count(*) FILTER (status = 'Parsing') AS active FROM j GROUP BY batch_id""")
def batch_stats(spark, sf_dir):
    return stats.batch_stats(_jobs(spark, sf_dir))


@query(_JOBS + """SELECT batch_id AS parent_job_id, count(*) AS n_children, sum(parsed)::BIGINT AS parsed, sum(dropped_rubbish)::BIGINT AS dropped_rubbish, CAST(0 AS BIGINT) AS total_failed,
  min(job_id) AS started_at, max(job_id) AS completed_at,
  CASE WHEN bool_or(status = 'Parsing') THEN 'Parsing' WHEN bool_and(status = 'Completed') THEN 'Completed' WHEN bool_and(status = 'Failed') THEN 'Failed' ELSE 'Partial' END AS status
FROM j GROUP BY batch_id""")
def archive_parent_merge(spark, sf_dir):
    j = _jobs(spark, sf_dir).withColumns({"parent_job_id": F.col("batch_id"), "total_failed": F.lit(0).cast("long"), "started_at": F.col("job_id"), "completed_at": F.col("job_id")})
    return stats.parent_merge(j)


@query("SELECT o_orderstatus AS job_id, count(*) AS total, count(*) FILTER (o_orderkey % 4 < 2) AS open, count(*) FILTER (o_orderkey % 4 = 2) AS completed, count(*) FILTER (o_orderkey % 4 = 3) AS failed, sum(o_custkey)::BIGINT AS total_bytes FROM orders GROUP BY o_orderstatus")
def entry_counts(spark, sf_dir):
    status = F.element_at(F.array(*map(F.lit, ("pending", "processing", "completed", "failed"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return stats.entry_counts(t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("job_id"), status.alias("status"), F.col("o_custkey").alias("size")))


@query("SELECT c_nationkey AS parent_job_id, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS headers FROM customer GROUP BY c_nationkey")
def header_set_union(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("parent_job_id"), F.array("c_mktsegment", "c_mktsegment").alias("h"))
    return stats.united(c, "parent_job_id", "h", "headers").select("parent_job_id", F.array_join("headers", ",").alias("headers"))


@query("SELECT event_id, CAST(round(1000 * avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS 9 PRECEDING)) AS BIGINT) AS rate FROM events")
def match_rate_history(spark, sf_dir):
    r = stats.match_rate(t(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") == "click", 10, width=64)
    return r.select("event_id", F.round(F.col("match_rate") * 1000).cast("long").alias("rate"))


# -- ordered operators ------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS idx FROM orders")
def dense_record_index(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return windows.dense_index(o, ["o_orderstatus"], "o_orderkey", "idx", 1000).select("o_orderkey", F.col("idx").cast("long").alias("idx"))


@query("SELECT event_id, list_aggregate(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 'string_agg', '|') AS recent FROM events")
def rolling_context(spark, sf_dir):
    r = windows.recent(t(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", width=64)
    return r.select("event_id", F.when(F.size("recent") > 0, F.array_join("recent", "|")).alias("recent"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) ELSE 7 END AS _line_no FROM orders")
def line_number_fill(spark, sf_dir):
    o = t(spark, sf_dir, "orders").withColumn("_line_no", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(7))
    return windows.fill_line_numbers(o, ["o_custkey"], "o_orderkey").select("o_orderkey", "_line_no")


@query("SELECT doc_id, 1 + coalesce(sum(length(text) - length(replace(text, chr(10), ''))) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_no FROM documents")
def newline_prefix(spark, sf_dir):
    """The line at which each text starts, if those of a language stand one after the other in a file."""
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("ends"))
    return windows.newline_lines(d, ["lang"], "doc_id", "ends").select("doc_id", "line_no")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_row_wins(spark, sf_dir):
    return windows.latest(t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id").select("user_id", "event_type")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS layout_id FROM events")
def layout_epochs(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    heads = e.where("event_type = 'error'").select("user_id", "event_id", F.col("event_id").alias("layout_id"))
    return windows.layout_epoch(e, heads, ["user_id"], "event_id").select("event_id", "layout_id")


# -- detection --------------------------------------------------------------------------------------------------------


@query("""
SELECT doc_id, count(*) AS n, max(o)::BIGINT AS last FROM (
  SELECT doc_id, unnest(CASE WHEN size <= 1048576 THEN [0] ELSE list_distinct([(size - 1048576) * i // (n - 1) for i in range(0, n)]) END) AS o
  FROM (SELECT doc_id, n_chars * 1000000 AS size, least(24, greatest(5, (n_chars * 1000000) // 536870912)) AS n FROM documents))
GROUP BY doc_id""")
def probe_offsets(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") * 1_000_000).alias("size"))
    o = detect.probe_offsets(F.col("size"), F.lit(1 << 20))
    return d.select("doc_id", F.explode(o).alias("o")).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("o").alias("last"))


@query("""
SELECT doc_id, CAST(round(avg_bytes) AS BIGINT) AS avg_bytes, max_bytes, CAST(floor(least(1048576, greatest(65536, 150 * avg_bytes, 4 * max_bytes))) AS BIGINT) AS win FROM (
  SELECT doc_id, coalesce(avg(strlen(line)) FILTER (trim(line) <> ''), 256) AS avg_bytes, coalesce(max(strlen(line)) FILTER (trim(line) <> ''), 512) AS max_bytes
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY doc_id)""")
def row_width_window(spark, sf_dir):
    ls = lines.explode_text(t(spark, sf_dir, "documents"), "doc_id", "text")
    w = detect.row_width(ls, ["source"])
    return w.select(F.col("source").cast("long").alias("doc_id"), F.round("avg_bytes").cast("long").alias("avg_bytes"), "max_bytes", detect.window_size(F.col("avg_bytes"), F.col("max_bytes")).alias("win"))


@query("""
SELECT user_id, 'k,' || string_agg(label, ',' ORDER BY first_id, place) AS headers FROM (
  SELECT user_id, label, min(event_id) AS first_id, min(place) AS place FROM (SELECT user_id, event_id, 0 AS place, event_type AS label FROM events UNION ALL SELECT user_id, event_id, 1, 'p' || (event_id % 3) FROM events) GROUP BY user_id, label) GROUP BY user_id""")
def json_header_union(spark, sf_dir):
    """Keys of JSON lines that differ from line to line, in order of appearance."""
    e = t(spark, sf_dir, "events")
    part = F.concat(F.lit("p"), (e.event_id % 3).cast("string"))
    line = F.format_string('{"k":1,"%s":null,"%s":{"in":2}}', "event_type", part)
    h = detect.header_union(e.select("user_id", "event_id", line.alias("text")), ["event_id"], ["user_id"])
    return h.select("user_id", F.array_join("headers", ",").alias("headers"))


@query("SELECT c_custkey AS k, c_custkey % 2 = 0 AS header FROM customer")
def header_labels(spark, sf_dir):
    c = dealt(t(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    line = F.when(c.c_custkey % 2 == 0, F.lit("first name, e-mail_address,Город")).otherwise(F.concat_ws(",", "c_name", F.lit("a@example.com")))
    return c.select(F.col("c_custkey").alias("k"), detect.header_labels(line).isNotNull().alias("header"))


@query("SELECT doc_id, text AS back, text AS same FROM documents")
def mojibake(spark, sf_dir):
    """Texts read in the wrong encoding come back, whatever their letters; texts that weren't stay as they are."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t(spark, sf_dir, "documents").select("doc_id", recover_mojibake(broken).alias("back"), recover_mojibake(F.col("text")).alias("same"))


@query("""
SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 4 IN (0, 3) THEN 'u' || c_custkey || '@example.com' END AS email,
       CASE WHEN c_custkey % 4 < 3 THEN '1555' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS phone, c_mktsegment AS segment
FROM customer""")
def dump_mode_rows(spark, sf_dir):
    """A PostgreSQL dump through the classifier: columns to fields, names that fall back, contacts in the wrong column."""
    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("long")
    mail, phone = F.concat(F.lit("u"), k.cast("string"), F.lit("@example.com")), F.concat(F.lit("1555"), F.lpad(k.cast("string"), 7, "0"))
    # by turns: both in place, only a phone where the mail belongs, a phone and a copy of it, a mail where the phone belongs
    first = F.when(k % 4 == 0, mail).when(k % 4 == 3, F.lit("\\N")).otherwise(phone)
    second = F.when(k % 4 == 0, phone).when(k % 4 == 1, F.lit("---")).when(k % 4 == 2, phone).otherwise(mail)
    body = c.select((k % 3).cast("string").alias("source"), (k + 10).alias("line_no"), F.concat_ws("\t", k.cast("string"), "c_name", first, second, "c_mktsegment").alias("text"))
    frame = [(1, "-- PostgreSQL database dump"), (2, "SET x = 1;"), (3, "COPY public.users (id, full_name, user_email, msisdn, segment) FROM stdin;"), (1 << 40, "\\."), ((1 << 40) + 1, "done")]
    heads = spark.createDataFrame([(str(s), n, x) for s in range(3) for n, x in frame], "source string, line_no long, text string")
    spec = FieldSpec(["user_name", "full_name", "user_email", "msisdn"])
    f = F.col("fields")
    got = cl.classify_dump(heads.unionByName(body), spec).where("template_id = 'pg-copy'")
    return got.select(F.get_json_object(f["meta"], "$.id").cast("long").alias("k"), f["user_name"].alias("name"), f["user_email"].alias("email"), f["msisdn"].alias("phone"), F.get_json_object(f["meta"], "$.segment").alias("segment"))


@query("SELECT c_custkey AS k, c_custkey % 5 = 0 AS failed FROM customer")
def statement_errors(spark, sf_dir):
    """INSERT statements, some without tuples: these come back with an error; comments between quotes stay."""
    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("long")
    parts = [F.concat(F.lit("INSERT INTO `c` (k, note) VALUES "), F.when(k % 5 == 0, F.concat(F.lit("broken "), k.cast("string"), F.lit(";"))).otherwise(F.concat(F.lit("("), k.cast("string"), F.lit(",'it''s"))))]
    parts += [F.when(k % 5 == 0, F.lit("-- a comment; don't read it")).otherwise(F.lit("-- no comment;")), F.when(k % 5 == 0, F.lit("")).otherwise(F.lit("');"))]
    each = F.posexplode(F.array(*parts))
    body = c.select((k % 4).cast("string").alias("source"), k.alias("k"), each.alias("i", "text")).select("source", (F.col("k") * 3 + F.col("i") + 1).alias("line_no"), (F.col("k") * 1000 + F.col("i")).alias("byte_offset"), "text")
    got = dumps.mysql_all(body)
    ok = F.get_json_object("text", "$.note") == "it's -- no comment; "
    return got.select(F.when(F.col("error").isNull(), F.get_json_object("text", "$.k").cast("long")).otherwise(F.floor(F.col("byte_offset") / 1000)).cast("long").alias("k"), (F.col("error").isNotNull() | ~F.coalesce(ok, F.lit(False))).alias("failed"))


@query("""
SELECT c_custkey AS k, c_custkey % 7 < 4 AS denied FROM customer""")
def denied_labels(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    label = F.element_at(F.array(*map(F.lit, ("Passport No", "ssn", "date-of-birth", "employer_name", "tinted", "Dobson", "inner join"))), (c.c_custkey % 7 + 1).cast("int"))
    return c.select(F.col("c_custkey").alias("k"), detect.denied(F.concat(label, F.lit(" "), F.col("c_custkey").cast("string"))).alias("denied"))


@query("SELECT event_id AS k, '{broken ' || event_id || ' ' || event_type AS meta FROM events")
def raw_objects(spark, sf_dir):
    """What looks like an object but can't be read is kept whole in meta."""
    e = t(spark, sf_dir, "events")
    line = F.concat(F.lit("{broken "), e.event_id.cast("string"), F.lit(" "), "event_type")
    spec = FieldSpec(["email", "meta"])
    got = cl.classify(as_lines(e, e.event_id % 8, line, e.event_id), spec).where("template_id = 'json-raw-meta'")
    return cl.wide(got, spec).select((F.col("line_no") - 1).alias("k"), "meta")


@query("""
SELECT sha256('j:f:' || (s_suppkey * 10) || ':' || (s_suppkey + 1)) AS dlq_id, s_suppkey + 1 AS line_no, 'just words ' || s_name AS raw_bytes, 'uncertain' AS failure_class, 0 AS attempts, 'pending' AS status
FROM supplier""")
def dead_letter_rows(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    ls = as_lines(s, F.lit("f"), F.concat(F.lit("just words "), "s_name"), s.s_suppkey).withColumns({"byte_offset": ((F.col("line_no") - 1) * 10).cast("long"), "byte_length": F.length("text")})
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    got = cl.dead_letters(cl.classify(ls, FieldSpec(["email"]), layout=cl.no_layout(spark)), "j", now)
    return got.select("dlq_id", "line_no", "raw_bytes", "failure_class", "attempts", "status")


@query("SELECT doc_id, entry, strlen(coalesce(text, '')) AS n FROM documents, (VALUES ('a.txt'), ('d/b.gz/b'), ('t.tar/c.txt')) e(entry)")
def archive_entries(spark, sf_dir):
    """Texts in zip files, plain, in a gzip file and in a tar file within, come out whole."""
    import gzip
    import io
    import tarfile
    import zipfile

    def zipped(text: str | None) -> bytes:
        raw, whole, tar = (text or "").encode(), io.BytesIO(), io.BytesIO()
        with tarfile.open(fileobj=tar, mode="w") as f:
            info = tarfile.TarInfo("c.txt")
            info.size = len(raw)
            f.addfile(info, io.BytesIO(raw))
        with zipfile.ZipFile(whole, "w") as z:
            for name, content in (("a.txt", raw), ("d/b.gz", gzip.compress(raw, 0)), ("t.tar", tar.getvalue())):
                z.writestr(name, content)
        return whole.getvalue()

    def packed(batches):
        """Archives are thrice a text and more, so few of them are held at once."""
        for b in batches:
            for k in range(0, b.num_rows, 50):
                some = b.slice(k, 50)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(map(zipped, some.column(1).to_pylist()), pa.binary())], names=["path", "content"])

    d = t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")
    got = archives.extract(d.mapInArrow(packed, "path string, content binary")).where("error IS NULL")
    return got.select(F.col("archive").cast("long").alias("doc_id"), "entry", F.length("content").cast("long").alias("n"))


@query("SELECT c_custkey AS k, i AS line_no, c_name || ' é ' || i AS text FROM customer, range(1, 4) r(i)")
def encoded_lines(spark, sf_dir):
    """Files in four encodings, one of them with a byte order mark, give the same lines."""
    c = dealt(t(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    text = F.concat_ws("\r\n", *[F.concat("c_name", F.lit(f" é {i}")) for i in (1, 2, 3)])
    raw = F.when(c.c_custkey % 4 == 0, F.encode(text, "UTF-8")).when(c.c_custkey % 4 == 1, F.encode(text, "UTF-16")).when(c.c_custkey % 4 == 2, F.encode(text, "UTF-16LE")).otherwise(F.encode(text, "ISO-8859-1"))
    got = lines.from_binary(c.select(F.col("c_custkey").cast("string").alias("path"), raw.alias("content")))
    return got.select(F.col("source").cast("long").alias("k"), "line_no", "text")


@query("SELECT c_custkey AS k, 'u' || c_custkey || '@example.com' AS email, c_name AS city FROM customer")
def nested_objects(spark, sf_dir):
    """Fields that lie deep within objects."""
    c = t(spark, sf_dir, "customer")
    line = F.format_string('{"id":%d,"user":{"contact":{"email":"u%d@example.com"},"place":{"city":"%s"}}}', "c_custkey", "c_custkey", "c_name")
    spec = FieldSpec(["email", "city"])
    got = cl.classify(as_lines(c, c.c_custkey % 8, line, c.c_custkey), spec, layout=cl.no_layout(spark)).where("template_id = 'json'")
    return cl.wide(got, spec).select((F.col("line_no") - 1).alias("k"), "email", "city")


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'rubbish' ELSE 'parsed' END AS verdict, CASE WHEN c_custkey % 3 = 0 THEN 'binary-field' ELSE 'csv-mapped' END AS template_id FROM customer")
def binary_cells(spark, sf_dir):
    """A line with a cell of control characters, few enough for the gate, is rubbish."""
    c = t(spark, sf_dir, "customer")
    cell = F.when(c.c_custkey % 3 == 0, F.lit("\x01\x02")).when(c.c_custkey % 3 == 1, F.lit("plain")).otherwise(F.lit(""))
    ls = with_header(c, c.c_custkey % 4, "id,name,note", F.concat_ws(",", c.c_custkey.cast("string"), F.repeat("c_name", 4), cell), c.c_custkey)
    got = cl.classify(ls, FieldSpec(["id", "name", "note"])).where("template_id != 'header'")
    return got.select((F.col("line_no") - 2).alias("k"), "verdict", "template_id")


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'u' || c_custkey || '@example.com' END AS email, CASE WHEN c_custkey % 3 = 1 THEN '+1 555 ' || lpad(c_custkey::VARCHAR, 7, '0') END AS phone, c_name AS name FROM customer""")
def strong_fields(spark, sf_dir):
    """E-mail addresses and phone numbers that aren't any become null; the row stays."""
    c = t(spark, sf_dir, "customer")
    k = c.c_custkey.cast("string")
    mail = F.when(c.c_custkey % 3 == 0, F.concat(F.lit("u"), k, F.lit("@example.com"))).otherwise(F.concat(F.lit("at home "), k))
    phone = F.when(c.c_custkey % 3 == 1, F.concat(F.lit("+1 555 "), F.lpad(k, 7, "0"))).otherwise(F.lit("none"))
    spec = FieldSpec(["email", "phone", "name"])
    got = cl.wide(cl.classify(with_header(c, c.c_custkey % 4, "email;phone;name", F.concat_ws(";", mail, phone, "c_name"), c.c_custkey), spec).where("verdict = 'parsed'"), spec)
    return got.select((F.col("line_no") - 2).alias("k"), "email", "phone", "name")


@query("SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'u' || c_custkey || '@example.com' END AS email FROM customer")
def json_cells(spark, sf_dir):
    """A field without a place is taken from an object in a cell."""
    c = t(spark, sf_dir, "customer")
    cell = F.when(c.c_custkey % 2 == 0, F.format_string('{"email":"u%d@example.com"}', "c_custkey")).otherwise(F.lit("words"))
    spec = FieldSpec(["name", "email"])
    got = cl.wide(cl.classify(with_header(c, c.c_custkey % 4, "name;extra", F.concat_ws(";", "c_name", cell), c.c_custkey), spec).where("template_id = 'csv-mapped'"), spec)
    return got.select((F.col("line_no") - 2).alias("k"), "name", "email")


@query("SELECT c_custkey AS k, split_part(c_name, '#', 1) || ' ' || c_mktsegment AS name FROM customer")
def composite_names(spark, sf_dir):
    """A field that the source has in parts."""
    c = t(spark, sf_dir, "customer")
    line = F.to_json(F.struct(F.col("c_custkey").alias("k"), F.split("c_name", "#")[0].alias("first_name"), F.col("c_mktsegment").alias("last_name")))
    spec = FieldSpec(["k", "name"])
    got = cl.wide(cl.classify(as_lines(c, c.c_custkey % 8, line, c.c_custkey), spec, layout=cl.no_layout(spark)).where("verdict = 'parsed'"), spec)
    return got.select(F.col("k").cast("long").alias("k"), "name")


@query("""
SELECT kind, count(*) AS n FROM (SELECT CASE doc_id % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'mysql' WHEN 2 THEN 'postgres' END AS kind FROM documents) GROUP BY kind""")
def sniffed_kinds(spark, sf_dir):
    """The kind of a file by its head, before a document's text."""
    d = t(spark, sf_dir, "documents")
    head = F.element_at(F.array(*map(F.lit, (' [{"a": 1}', "-- MySQL dump 10\n", "--\n-- PostgreSQL database dump\n", "email,name\n"))), (d.doc_id % 4 + 1).cast("int"))
    return d.groupBy(dumps.kind(F.concat(head, F.coalesce("text", F.lit("")))).alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey AS k, c_custkey % 3 = 0 AS whole FROM customer")
def whole_documents(spark, sf_dir):
    """One JSON document, or several in lines."""
    c = t(spark, sf_dir, "customer")
    one = F.to_json(F.struct("c_custkey", "c_name"))
    text = F.when(c.c_custkey % 3 == 0, F.concat(F.lit("[\n"), one, F.lit(",\n"), one, F.lit("\n]\n"))).when(c.c_custkey % 3 == 1, F.concat(one, F.lit("\n"), one)).otherwise(F.concat(F.lit("["), one))
    return c.select(F.col("c_custkey").alias("k"), jsons.is_whole(text).alias("whole"))


# -- sources ----------------------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def pg_copy_rows(spark, sf_dir):
    """A PostgreSQL dump of a table."""
    n = t(spark, sf_dir, "nation")
    body = n.select(F.lit("d").alias("source"), (F.col("n_nationkey") + 10).cast("long").alias("line_no"), F.concat_ws("\t", "n_nationkey", "n_name", "n_regionkey").alias("text"))
    frame = spark.createDataFrame([("d", 1, "-- PostgreSQL database dump"), ("d", 2, "SET x = 1;"), ("d", 3, "COPY nation (n_nationkey, n_name, n_regionkey) FROM stdin;"), ("d", 1 << 40, "\\."), ("d", (1 << 40) + 1, "done")], "source string, line_no long, text string")
    f = F.col("fields")
    return dumps.copy_rows(frame.unionByName(body)).select(f["n_nationkey"].cast("int").alias("n_nationkey"), f["n_name"].alias("n_name"), f["n_regionkey"].cast("int").alias("n_regionkey"))


@query("""
SELECT DISTINCT c_nationkey AS source, f.field, CASE WHEN c_nationkey % 2 = 0 THEN f.even ELSE f.odd END AS place
FROM customer, (VALUES ('email', 0, 3), ('phone', 1, 2), ('name', 3, 1), ('id', 4, 0)) AS f(field, even, odd)""")
def guessed_columns(spark, sf_dir):
    """Places of fields in files without a header, by what the columns' values look like."""
    c = dealt(t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"))
    key = F.col("c_custkey").cast("string")
    email, phone, name = F.concat(F.lit("c"), key, F.lit("@example.com")), F.concat(F.lit("+1 555 0"), F.lpad(key, 6, "0")), F.concat(F.lit("Ann "), "c_mktsegment")
    even, odd = F.concat_ws(";", email, phone, F.lit("left as it is, always"), name, key), F.concat_ws("|", key, name, phone, email)
    ls = as_lines(c, F.col("c_nationkey"), F.when(F.col("c_nationkey") % 2 == 0, even).otherwise(odd), F.col("c_custkey"))
    got = profiles.guessed_columns(ls, FieldSpec(["email", "phone", "name", "id", "passport"]), ["source"])
    return got.select(F.col("source").cast("int").alias("source"), F.explode("column_map").alias("field", "at")).select("source", "field", F.get("at", F.lit(0)).alias("place"))


@query("""
SELECT o_orderkey AS k, '{"k":' || o_orderkey || ',"p":"' || o_orderpriority || '","n":null' || CASE WHEN o_orderkey % 2 = 0 THEN ',"meta":[' || o_custkey || ',"0' || o_custkey || '"]' ELSE '' END || '}' AS text FROM orders""")
def pg_copy_objects(spark, sf_dir):
    """Rows of a COPY block as objects: numbers, text, nulls and cells without a column."""
    o = t(spark, sf_dir, "orders")
    more = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("\t"), F.col("o_custkey").cast("string"), F.lit("\t0"), F.col("o_custkey").cast("string"))).otherwise("")
    body = o.select(F.lit("d").alias("source"), (F.col("o_orderkey") + 10).cast("long").alias("line_no"), F.concat(F.concat_ws("\t", "o_orderkey", "o_orderpriority", F.lit("\\N")), more).alias("text"))
    frame = spark.createDataFrame([("d", 1, "COPY orders (k, p, n) FROM stdin;"), ("d", 1 << 40, "\\.")], "source string, line_no long, text string")
    got = dumps.copy_objects(frame.unionByName(body))
    return got.select((F.col("line_no") - 10).alias("k"), "text")


@query("SELECT 'pg-copy' AS stage, count(*) AS n FROM nation UNION ALL SELECT 'pg-dump-start', 1 UNION ALL SELECT 'pg-copy-start', 1 UNION ALL SELECT 'pg-copy-end', 1 UNION ALL SELECT 'pg-sql-junk', 2")
def pg_dump_stages(spark, sf_dir):
    n = t(spark, sf_dir, "nation")
    body = n.select(F.lit("d").alias("source"), (F.col("n_nationkey") + 10).cast("long").alias("line_no"), F.concat_ws("\t", "n_nationkey", "n_name").alias("text"))
    frame = spark.createDataFrame([("d", 1, "-- PostgreSQL database dump"), ("d", 2, "SET x = 1;"), ("d", 3, "COPY nation (a, b) FROM stdin;"), ("d", 1 << 40, "\\."), ("d", (1 << 40) + 1, "done")], "source string, line_no long, text string")
    return dumps.dump_stage(frame.unionByName(body)).groupBy("stage").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment || '''s' AS segment FROM customer")
def mysql_rows(spark, sf_dir):
    """A MySQL dump: statements of one line or several, quotes, and numbers."""
    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("long")
    row = F.concat(F.lit("("), k.cast("string"), F.lit(", '"), "c_name", F.lit("',"), F.col("c_acctbal").cast("string"), F.lit(",'"), "c_mktsegment", F.lit("\\'s')"))
    two = [F.struct((k * 2 + 10).alias("no"), F.lit("INSERT INTO `cust` VALUES").alias("tx")), F.struct((k * 2 + 11).alias("no"), F.concat(row, F.lit(";")).alias("tx"))]
    body = c.select((k % 4).cast("string").alias("source"), F.explode(F.array(*two)).alias("x")).select("source", F.col("x.no").alias("line_no"), F.col("x.no").alias("byte_offset"), F.col("x.tx").alias("text"))
    create = spark.range(4).select(F.col("id").cast("string").alias("source"), F.lit(1).cast("long").alias("line_no"), F.lit(0).cast("long").alias("byte_offset"), F.lit("CREATE TABLE `cust` (`c_custkey` int, `c_name` varchar(20), c_acctbal decimal(10,2), segment text, PRIMARY KEY (`c_custkey`));").alias("text"))
    j = lambda p: F.get_json_object("text", p)
    return dumps.mysql_rows(create.unionByName(body)).select(j("$.c_custkey").cast("long").alias("c_custkey"), j("$.c_name").alias("c_name"), j("$.c_acctbal").cast("double").alias("c_acctbal"), j("$.segment").alias("segment"))


@query("SELECT o_custkey AS k, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY o_custkey")
def json_explode(spark, sf_dir):
    """Whole JSON documents, a record per element."""
    d = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(F.struct("o_orderkey"))).alias("text"))
    r = jsons.explode_document(d, "text", ["o_custkey"])
    return r.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("record", "$.o_orderkey").cast("long")).alias("keys"))


@query("SELECT doc_id, count(*) AS n, sum(length(rtrim(line, chr(13))))::BIGINT AS chars FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY doc_id")
def text_lines(spark, sf_dir):
    ls = lines.explode_text(t(spark, sf_dir, "documents"), "doc_id", "text")
    return ls.groupBy(F.col("source").cast("long").alias("doc_id")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("""
WITH d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, chr(10), chr(13) || chr(10)) WHEN 1 THEN text || chr(10) ELSE text END AS x FROM documents),
line AS (SELECT doc_id, x, string_split(x, chr(10)) AS ls FROM d WHERE x <> '')
SELECT doc_id, len(ls) - CASE WHEN ends_with(x, chr(10)) THEN 1 ELSE 0 END AS n, strlen(x) AS bytes,
       sha256(array_to_string(list_transform(CASE WHEN ends_with(x, chr(10)) THEN ls[1:len(ls) - 1] ELSE ls END, lambda l, i:
         CASE WHEN ends_with(l, chr(13)) AND (i < len(ls) OR ends_with(x, chr(10))) THEN l[1:length(l) - 1] ELSE l END), '|')) AS sha
FROM line""")
def byte_lines(spark, sf_dir):
    """Lines of binary files with offsets, with CRLF ends and with a last line end too: their lengths add up to the file, their texts are its lines."""
    x = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit("\n"), F.lit("\r\n"))).when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    files = t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode(x, "UTF-8").alias("content"))
    ls = lines.from_binary(files, "utf-8").groupBy(F.col("source").cast("long").alias("doc_id"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda r: r["text"])
    return ls.agg(F.count("*").alias("n"), F.sum("byte_length").alias("bytes"), F.sha2(F.array_join(parts, "|"), 256).alias("sha"))


@query("SELECT kind, count(*) AS n FROM (SELECT CASE doc_id % 4 WHEN 0 THEN 'zip' WHEN 1 THEN 'gz' WHEN 2 THEN 'rar' END AS kind FROM documents) GROUP BY kind")
def archive_kinds(spark, sf_dir):
    magic = F.element_at(F.array(*[F.lit(bytearray(m)) for m in (archives.ZIP, archives.GZIP, archives.RAR, b"none")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return t(spark, sf_dir, "documents").select(archives.kind(F.concat(magic, F.encode(F.lit("rest"), "UTF-8"))).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS k, 'b' || o_custkey AS bucket, 'dir/f ' || o_orderkey || '.csv' AS key, 'f_' || o_orderkey || '.csv' AS base FROM orders")
def object_paths(spark, sf_dir):
    url = F.concat(F.lit("s3://b"), F.col("o_custkey").cast("string"), F.lit("/dir/f "), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    got = tx.bucket_and_key(url)
    return t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), got["bucket"].alias("bucket"), got["key"].alias("key"), tx.clean_basename(got["key"]).alias("base"))


# -- sinks and jobs ---------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '[",\\r\\n]') THEN '"' || replace(text, '"', '""') || '"' ELSE coalesce(text, '') END AS cell FROM documents""")
def csv_escape(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", tx.csv_cell(F.col("text")).alias("cell"))


@query("SELECT c_custkey AS k, c_name || ',' || c_mktsegment || ',\"{\"\"a\"\":1}\"' AS value FROM customer")
def csv_sink_lines(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    row = c.select(F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"), F.lit("meta"), F.lit('{"a":1}')).alias("fields"))
    ls = sinks.csv_lines(row, ["name", "segment", "meta", "name"])
    return ls.select(F.regexp_extract("value", "Customer#0*([0-9]+),", 1).cast("long").alias("k"), "value")


@query("SELECT source, failure_class, count(*) AS n FROM (SELECT 'rubbish' AS source, NULL AS failure_class FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'dlq', 'uncertain' FROM orders WHERE o_orderstatus = 'O') GROUP BY ALL")
def rejected_union(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    r = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("line_no"), F.lit("x").alias("matched_template_id"))
    d = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("line_no"), F.lit("uncertain").alias("failure_class"), F.lit("id").alias("dlq_id"))
    return sinks.rejected(r, d).groupBy("source", "failure_class").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT l_orderkey AS _job_id, l_linenumber AS _byte_offset FROM lineitem WHERE l_orderkey % 3 <> 0")
def idempotent_load(spark, sf_dir):
    """Loads that overlap give each row once."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("_job_id"), F.col("l_linenumber").alias("_byte_offset"))
    return sinks.new_rows(rows.unionAll(rows), rows.where("_job_id % 3 = 0"), ("_job_id", "_byte_offset"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 3 WHEN o_orderkey % 2 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 3 WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS _line_no FROM orders""")
def line_backfill(spark, sf_dir):
    """Line numbers by offset; rubbish over dead letters over records."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_byte_offset"), F.lit("j").alias("_job_id"), F.lit(0).alias("_line_no"))
    known = lambda m, n: o.where(f"_byte_offset % {m} = 0").withColumn("_line_no", F.lit(n))
    return sinks.backfill_lines(o, known(5, 1), known(2, 2), known(3, 3)).select(F.col("_byte_offset").alias("o_orderkey"), "_line_no")


@query("SELECT event_id AS k, CAST(1 AS INT) AS attempts FROM events WHERE event_type IN ('error', 'view') AND event_id % 4 = 0")
def dlq_reprocess(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("event_id").alias("k"), F.col("event_type").alias("failure_class"), F.when(F.col("event_id") % 4 == 0, "pending").otherwise("done").alias("status"), F.lit(0).alias("attempts"))
    return sinks.reprocess(e, ["error", "view"]).select("k", "attempts")


@query("SELECT c_custkey AS job_id, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'Detecting' WHEN c_custkey % 3 = 0 THEN 'Ingesting' ELSE 'Created' END AS status FROM customer")
def compare_and_set(spark, sf_dir):
    """A status changes only where it is the one that was expected."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_id"), F.when(F.col("c_custkey") % 3 == 0, "Ingesting").otherwise("Created").alias("status"))
    changes = c.where("job_id % 2 = 0").select("job_id", F.lit("Ingesting").alias("expected"), F.lit("Detecting").alias("status"))
    return sinks.compare_and_set(c, changes)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') ORDER BY o_orderkey DESC LIMIT 100 OFFSET 50")
def paged_lookup(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sinks.page(sinks.lookup(o, o_orderstatus=["F", "O"]), [F.desc("o_orderkey")], 50, 100)


@query("SELECT user_id, max(ts) AS updated_at FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 2 HOUR")
def stuck_jobs(spark, sf_dir):
    last = t(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("updated_at")).withColumn("status", F.lit("Ingesting"))
    return jobs.stuck(last, F.lit("2024-01-30 12:00:00").cast("timestamp")).select("user_id", "updated_at")


_FOLLOWS = ", ".join(f"('{a}', '{b}')" for a, bs in jobs.FOLLOWS.items() for b in bs)
_CYCLE = ("Detecting", "Parsing", "Merging Output", "Saving to Database", "Reporting", "Completed", "Failed")
_STATUS_SQL = "['" + "', '".join(_CYCLE) + "'][1 + event_id % 7]"


@query(f"""
WITH RECURSIVE follows(a, b) AS (VALUES {_FOLLOWS}),
e AS (SELECT user_id AS job_id, {_STATUS_SQL} AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
walk AS (SELECT DISTINCT job_id, CAST(0 AS BIGINT) AS i, 'Created' AS status, 0 AS applied, 0 AS ignored FROM e
  UNION ALL SELECT w.job_id, e.i, CASE WHEN f.a IS NULL THEN w.status ELSE e.s END, w.applied + CASE WHEN f.a IS NULL THEN 0 ELSE 1 END, w.ignored + CASE WHEN f.a IS NULL THEN 1 ELSE 0 END
  FROM walk w JOIN e ON e.job_id = w.job_id AND e.i = w.i + 1 LEFT JOIN follows f ON f.a = w.status AND f.b = e.s)
SELECT job_id, arg_max(status, i) AS status, max(applied)::INT AS applied, max(ignored)::INT AS ignored FROM walk GROUP BY job_id""")
def state_fold(spark, sf_dir):
    """Each job's state after its events in order; events that don't follow are ignored."""
    status = F.element_at(F.array(*map(F.lit, _CYCLE)), (F.col("event_id") % 7 + 1).cast("int"))
    e = t(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("job_id"), F.col("ts").alias("timestamp"), status.alias("status"))
    return jobs.fold(e)


@query(ORACLE["state_fold"])
def queued_fold(spark, sf_dir):
    """The same states from events that went through a queue, in two batches with the later events first in each."""
    status = F.element_at(F.array(*map(F.lit, _CYCLE)), (F.col("event_id") % 7 + 1).cast("int"))
    e = t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), "event_id", F.to_json(F.struct("event_id", "ts", status.alias("status"))).alias("body"))
    folder = shared(spark, "queue")
    for part in (1, 0):
        queue.publish(e.where(F.col("event_id") % 2 == part), folder, [F.desc("event_id")])
    queue.register(spark)
    got = spark.read.format("jobqueue").option("path", folder).load()
    body = F.from_json("body", "event_id bigint, ts timestamp, status string")
    return jobs.fold(got.select(F.col("key").cast("long").alias("job_id"), body.alias("b")).select("job_id", "b.event_id", F.col("b.ts").alias("timestamp"), "b.status"))


@query("SELECT DISTINCT sha256(o_custkey || chr(31) || o_orderpriority) AS job_id, CAST(o_custkey AS VARCHAR) AS parent FROM orders")
def child_jobs(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("job_id"), F.col("o_orderpriority").alias("entry"))
    return jobs.children(o).select("job_id", F.col("parent_job_id").alias("parent"))


@query("SELECT o_custkey AS job_id, CASE WHEN bool_or(o_orderstatus = 'F') THEN 'failed' ELSE 'completed' END AS status FROM orders GROUP BY o_custkey HAVING bool_and(o_orderstatus <> 'P')")
def parents_done(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "P", "processing").when(F.col("o_orderstatus") == "F", "failed").otherwise("completed")
    return jobs.parents_done(t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("job_id"), s.alias("status")))


@query("SELECT q, count(*) AS n FROM (SELECT CASE WHEN n_chars * 10000 <= 26214400 THEN 'small' WHEN n_chars * 10000 > 104857600 THEN 'large' ELSE 'default' END AS q FROM documents) GROUP BY q")
def load_queues(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy(jobs.load_queue(F.col("n_chars") * 10_000).alias("q")).agg(F.count("*").alias("n"))


# -- scalar functions -------------------------------------------------------------------------------------------------


@query("""
SELECT doc_id, count(*) FILTER (regexp_full_match(w, '[A-Za-z0-9._%+=\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}')) AS emails,
  count(*) FILTER (NOT contains(w, '@') AND length(regexp_replace(w, '[^0-9]', '', 'g')) BETWEEN 10 AND 15) AS phones
FROM (SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '[ \\n\\r\\t\\f]+')) AS w FROM documents) GROUP BY doc_id""")
def validators(spark, sf_dir):
    w = t(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "[ \\n\\r\\t\\f]+")).alias("w"))
    return w.groupBy("doc_id").agg(F.count_if(is_email(F.col("w"))).alias("emails"), F.count_if(is_phone(F.col("w"))).alias("phones"))


@query("SELECT c_custkey AS k, lower('customer' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS key, c_name || '; ' || c_mktsegment AS joined FROM customer")
def key_and_join(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("k"), tx.normalize_key(F.col("c_name")).alias("key"), tx.join_scalars(F.array(F.concat(F.lit(" "), "c_name"), F.lit(" "), F.lit(None).cast("string"), F.col("c_mktsegment"))).alias("joined"))


@query("SELECT n_nationkey AS k, true AS same, 'a' || chr(92) || 'u0041 b' || chr(92) || chr(92) || 'u00zz' AS clean FROM nation")
def sanitized(spark, sf_dir):
    """A text as a pattern matches itself; NUL goes, a bad escape is doubled."""
    odd = F.concat("n_name", F.lit(".*+?(x)"))
    return t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.regexp_like(odd, tx.regex_literal(odd)).alias("same"), tx.sanitize(F.lit("a\\u0041 b\x00\\u00zz")).alias("clean"))


@query("SELECT event_id, date_trunc('second', ts) AS at FROM events WHERE event_id % 3 < 2 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 3 = 2")
def lenient_dates(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    s = F.date_trunc("second", "ts")
    form = F.when(F.col("event_id") % 3 == 0, F.date_format(s, "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.unix_seconds(s).cast("string")).otherwise("no date")
    return e.select("event_id", tx.lenient_timestamp(form).alias("at"))


