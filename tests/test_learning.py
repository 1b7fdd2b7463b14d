"""Lines that teach templates, and what is judged by these."""

from lineloom.operators import classify as cl
from lineloom.operators.templates import offline_teacher
from lineloom.spec import FieldSpec


def test_templates_are_tried_behind_what_was_judged(spark):
    """The last stages alone give what all stages give with the templates."""
    spec = FieldSpec(["tag", "number", "kind"])
    texts = ["x,1,click", "x,2,,", "ERROR at 1", "ERROR,a,b", "", "{broken", '"{broken', '{"tag":"a","number":1,"kind":"b"}', "tag: a - number: 3 - kind: c", "y" * 70_000, "plain text", None, "a@example.com,b,c,d,e", "INFO {x"]
    with_header = [("h", k + 1, x) for k, x in enumerate(["tag,number,kind", "a,1,b", "tag,number,kind", "ERROR,2,c", "only text"])]
    lines = spark.createDataFrame([("s", k + 2, x) for k, x in enumerate(texts)] + with_header, "source string, line_no long, text string")
    known = [offline_teacher(x, spec) for x in ("x,1,click", "ERROR at 1")]
    rows = lambda df: sorted(((r.source, r.line_no, r.text or "", r.verdict, r.template_id or "", r.template_version or 0, r.failure_class or "", str(r.fields)) for r in df.collect()))
    got = rows(cl.by_templates(cl.classify(lines, spec), spec, known))
    assert got == rows(cl.classify(lines, spec, known)) and {r[4] for r in got} >= {known[0].template_id, known[1].template_id}


def test_lines_that_teach_are_judged_once_and_dealt_out(spark, sf, monkeypatch):
    from lineloom.plans import queries

    seen, whole = [], cl.classify
    monkeypatch.setattr(queries.cl, "classify", lambda ls, *a, **k: seen.append(ls.rdd.getNumPartitions()) or whole(ls, *a, **k))
    assert {r.event_type for r in queries.learned_templates(spark, sf).collect()} == {"parsed", "rubbish"}
    assert len(seen) == 1 and seen[0] >= 2 * spark.sparkContext.defaultParallelism
