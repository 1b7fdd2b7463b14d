"""The queries of this subpackage, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .op1_token_counts import op1_token_counts
from .op2_substring_dedup import op2_substring_dedup
from .op3_packing import op3_packing
from .op4_mixing import op4_mixing
from .op5_sentencepiece import op5_sentencepiece
from .op6_dart_minhash import op6_dart_minhash
from .op7_sharding import op7_sharding
from .op8_pii import op8_pii
from .op9_quality import op9_quality
from .op10_exact_dedup import op10_exact_dedup
from .op11_filter_audit import op11_filter_audit
from .op12_toxicity import op12_toxicity
from .op13_conversation_repair import op13_conversation_repair

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_substring_dedup, op3_packing, op4_mixing, op5_sentencepiece, op6_dart_minhash, op7_sharding, op8_pii, op9_quality, op10_exact_dedup, op11_filter_audit, op12_toxicity, op13_conversation_repair)}



def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op8_pii gives of the base kinds."""
    return op8_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def quality_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9_quality gives beside the method's verdict."""
    return op9_quality(spark, sf_dir).drop("kept")


def shard_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7_sharding by shard: rows and bytes add up, slots have no gap, growth moves rows only into the new shard."""
    got = op7_sharding(spark, sf_dir)
    per = got.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"), F.bool_and(F.expr("grown_shard = shard OR grown_shard = 24")).alias("stays"))
    return per.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.bool_and(F.expr("slots = n AND last = n - 1")).alias("gapless"), F.bool_and("stays").alias("stays"), F.bool_and(F.expr("shard BETWEEN 0 AND 23")).alias("known"))


#: Beside the ten: parts of what they give, as far as SQL can express them.
QUERIES |= {f.__name__: f for f in (pii_base_spans, quality_measures, shard_laws)}

ORACLE = {
    "pii_base_spans": r"""
WITH kinds(kind, k, pattern) AS (VALUES
  ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), ('ip', 2, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  ('card', 3, '[0-9]([\x20-]?[0-9])+'), ('phone', 4, '\+[0-9][\x20().0-9-]+[0-9]')),
found AS (
  SELECT doc_id, kind, k, regexp_extract_all(coalesce(text, ''), pattern) AS ms, string_split_regex(coalesce(text, ''), pattern) AS bs FROM documents, kinds),
each AS (
  SELECT doc_id, kind, k, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS d,
         len(array_to_string(bs[1:i], '')) + len(array_to_string(ms[1:i - 1], '')) AS s
  FROM found, unnest(range(1, len(ms) + 1)) AS t(i)),
good AS (
  SELECT *, s + len(m) AS e FROM each WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS HUGEINT))) <= 255
    WHEN 'card' THEN len(d) BETWEEN 12 AND 19 AND
      list_sum(list_transform(list_reverse(string_split(d, '')), lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INT) ELSE 2 * CAST(x AS INT) - CASE WHEN x > '4' THEN 9 ELSE 0 END END)) % 10 = 0
    ELSE len(d) BETWEEN 9 AND 15 END)
SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
       count(*) FILTER (kind = 'phone') AS n_phone, sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k), '')) AS base_sha256
FROM documents LEFT JOIN good USING (doc_id) GROUP BY doc_id
""",
    "quality_measures": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM (SELECT doc_id, x, count(*) AS n FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS w FROM d, unnest(range(1, len(ws) - 6)) AS t(i)),
many AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM many) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
       coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ws) < 20 OR 100 * coalesce(n, 0) > 30 * len(ws) AS base_failed
FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id)
""",
    "shard_laws": """
SELECT count(*) AS n, sum(strlen(coalesce(text, '')) + 8)::BIGINT AS bytes, true AS gapless, true AS stays, true AS known FROM documents
""",
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h FROM d, unnest(range(1, len(ws) - 11)) AS t(i)),
least AS (SELECT h, min(doc_id) AS owner FROM win GROUP BY h),
gone AS (SELECT DISTINCT win.doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (h) WHERE owner < win.doc_id),
word AS (SELECT doc_id, p, ws[p] AS w FROM d, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op10_exact_dedup": """
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM low
""",
    "op11_filter_audit": r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
flag AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {'A': len(ws) < 50, 'B': 100 * len(list_distinct(ws)) < 65 * len(ws),
         'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t), 'D': regexp_matches(t, '[#$%&*|]'),
         'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
  FROM w LEFT JOIN said USING (doc_id)),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
step AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
each AS (
  SELECT part, o, step, good, toxic, f[o[step]] AS fails, list_bool_or(list_transform(o[1:step - 1], lambda x: f[x])) AS gone,
         list_sum(list_transform(o, lambda x: f[x]::INT)) AS n_fails
  FROM flag, step),
counted AS (
  SELECT part, o, step, count(*) FILTER (NOT fails AND NOT coalesce(gone, false)) AS kept, count(*) FILTER (fails AND NOT coalesce(gone, false)) AS removed,
         count(*) FILTER (fails AND coalesce(gone, false)) AS redundant, count(*) FILTER (fails AND n_fails = 1) AS unique_fails,
         count(*) FILTER (fails AND NOT coalesce(gone, false) AND good) AS good_lost, count(*) FILTER (fails AND NOT coalesce(gone, false) AND toxic) AS toxic_lost
  FROM each GROUP BY ALL)
SELECT part, array_to_string(o, '') AS filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley
FROM counted
""",
    "op13_conversation_repair": r"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 20 AS h
  FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, (VALUES (0), (1)) AS c(c) WHERE h <> 0 AND (c = 0 OR h = 3)),
placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS r, lag(left(role, 1)) OVER w AS before, count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'ok' END AS fault FROM placed),
-- state: '' at the start, else the initial before
pass(ins, from_q, q, more, c) AS (VALUES ('', '', '', '', 0), ('', 's', 's', '', 0), ('', 'u', 'u', '', 0), ('', 'a', 'a', '', 0),
  ('I', '', 'u', 'user:' || chr(10), 5), ('I', 's', 'u', 'user:' || chr(10), 5), ('I', 'a', 'u', 'user:' || chr(10), 5), ('I', 'u', 'a', 'assistant:' || chr(10), 5),
  ('II', '', 'a', 'user:' || chr(10) || 'assistant:' || chr(10), 10), ('II', 's', 'a', 'user:' || chr(10) || 'assistant:' || chr(10), 10),
  ('II', 'a', 'a', 'user:' || chr(10) || 'assistant:' || chr(10), 10), ('II', 'u', 'u', 'assistant:' || chr(10) || 'user:' || chr(10), 10)),
path(conv_id, i, q, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '', {'c': 0, 'audit': '', 't': ''} FROM conversations
  UNION ALL
  SELECT conv_id, i, q2, min(b) FROM (
    SELECT p.conv_id, j.i, e.q2, {'c': p.best.c + s.c + e.c, 'audit': p.best.audit || s.ins || e.e, 't': p.best.t || s.more || e.more} AS b
    FROM path p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1 JOIN pass s ON s.from_q = p.q,
    LATERAL (SELECT unnest([
      {'e': 'D', 'c': 2, 'q2': s.q, 'more': '', 'ok': true},
      {'e': 'K', 'c': CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'q2': r, 'more': role || ':' || text || chr(10),
       'ok': fault NOT IN ('blank', 'duplicate') AND s.q || r IN ('s', 'u', 'su', 'ua', 'au')},
      {'e': 'R', 'c': CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'q2': CASE s.q WHEN 'u' THEN 'a' ELSE 'u' END,
       'more': CASE s.q WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text || chr(10), 'ok': fault NOT IN ('blank', 'duplicate')}], recursive := true)) AS e
    WHERE e.ok) GROUP BY conv_id, i, q2),
done AS (
  SELECT p.conv_id, min({'c': p.best.c + s.c, 'audit': p.best.audit || s.ins, 't': p.best.t || s.more}) AS b
  FROM path p JOIN pass s ON s.from_q = p.q LEFT JOIN (SELECT DISTINCT conv_id, n, true AS some FROM judged) k ON k.conv_id IS NOT DISTINCT FROM p.conv_id
  WHERE p.i = coalesce(k.n, 0) AND s.q IN ('', 'a') GROUP BY p.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, d.b.c::BIGINT AS cost, d.b.audit AS audit, sha256(d.b.t[:-2]) AS repaired_sha256
FROM done d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
""",
}
