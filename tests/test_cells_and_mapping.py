"""Recognisers on small inputs, without Spark."""

import pytest

from lineloom.functions.text import literal_run, safe_pattern
from lineloom.functions.validate import email_ok, phone_ok
from lineloom.operators.cells import best_cells, merge_scheme, split_cells
from lineloom.operators.classify import Judge
from lineloom.operators.detect import given_layout, is_label, layout_of, repeats_header
from lineloom.operators.mapping import Mapper, flatten, load, loose_pairs, read_object
from lineloom.operators.templates import Template, extract, offline_teacher, rubbish_template
from lineloom.spec import FieldSpec, category, clean_column_map, parse_fields, select_headers


@pytest.mark.parametrize(
    ("line", "delimiter", "cells"),
    [
        ("a,b , c", ",", ["a", "b", "c"]),
        ('1,"a"', ",", ["1", "a", ""]),
        ('"x, y",2', ",", ["x, y", "2"]),
        ('"say ""hi""",2', ",", ['say "hi"', "2"]),
        ('a"b,c', ",", ['a"b', "c"]),
        ('"open,b', ",", ["open,b", ""]),
        ('a\t"b"', "\t", ["a", '"b"']),
        ("", ",", [""]),
        (",", ",", ["", ""]),
    ],
)
def test_split_cells(line, delimiter, cells):
    assert split_cells(line, delimiter) == cells


def test_best_cells():
    assert best_cells("a;b;c,d") == (["a", "b", "c,d"], ";")
    assert best_cells("a,b;c") == (["a", "b;c"], ",")  # ties go to the earlier delimiter
    assert best_cells("abc") is None
    assert merge_scheme(["http", "//h/p", "x"], ":") == ["http://h/p", "x"]


def test_spec():
    s = FieldSpec(["full_name", "email", "phone_number", "meta"], aliases={"email": ["kontakt"]})
    assert s.wanted == ["full_name", "email", "phone_number"]
    assert s.matches("Surname", "full_name") and s.matches("kontakt", "email") and s.matches("mobile2", "phone_number")
    assert not s.matches("city", "email")
    assert category("contact_phone") == "phone" and category("xyz") is None
    assert clean_column_map({"a": 1, "b": [0, 2], "c": -1, "d": "x", "e": [1, "y"], "f": True}) == {"a": [1], "b": [0, 2]}
    assert parse_fields('["a","b"]') == ["a", "b"] and parse_fields("nonsense") == [] and parse_fields(None) == []
    assert select_headers(["a", "b", "c"], ["c", "a"]) == (["c", "a", "meta"], {"c": [2], "a": [0]})


def test_validators():
    assert email_ok(" a.b+c@example.com ") and not email_ok("a@b") and not email_ok("a b@example.com")
    assert phone_ok("+1 (555) 010-0199") and not phone_ok("555-0100") and not phone_ok("1234567890@x")


def test_layout():
    s = FieldSpec(["email", "name", "phone"])
    lay = layout_of("id,E-Mail,First Name,Last Name,Mobile", s)
    assert lay.places == {"email": [1], "name": [2, 3], "phone": [4]} and lay.delimiter == ","
    assert layout_of("a@example.com,Ann,5550100199", s) is None
    assert layout_of('{"email":"x"}', s) is None and layout_of("Name: x - Email: y", s) is None
    assert repeats_header(["ID", "e-mail"], ["id", "E-Mail"]) and not repeats_header(["1", "x"], ["id", "E-Mail"])
    assert is_label("Город") and not is_label("2020") and not is_label("a@b")
    assert given_layout(["mail / contact", "n"], FieldSpec(["email"])).places == {"email": [0]}


def judge(line, fields, layout=None, first=False, **kw):
    return Judge(FieldSpec(fields, **kw)).judge(line, layout, first)


def test_json_stages():
    f = ["email", "name"]
    assert judge('{"contact":{"email":"a@example.com"},"name":"Ann"}', f)[4] == {"email": "a@example.com", "name": "Ann", "meta": None}
    assert judge('[{"email":"a@example.com"}]', f)[1] == "json"
    v = judge('{"email":"a@example.com","name":"Ann","extra":{"city":"X"}}', f)
    assert v[4]["meta"] == '{"extra.city":"X"}'
    assert judge('{"contact":"{\\"email\\":\\"a@example.com\\"}","name":"Ann"}', f)[4]["email"] == "a@example.com"
    assert judge("[1,2,3]", f)[1] == "json-raw-meta" and judge("[1,2,3]", f)[4]["meta"] == "[1,2,3]"
    assert judge('{"email":"a@example.com","name":"An', f)[4]["email"] == "a@example.com"
    assert judge('{"name":"Ann","n":12345678901234567890123}', ["name", "n"])[4]["n"] == "12345678901234567890123"


def test_kv_and_cells():
    v = judge("Email: a@example.com - Name: Ann Lee - Followers: 3", ["email", "name"])
    assert v[:2] == ("parsed", "kv") and v[4] == {"email": "a@example.com", "name": "Ann Lee", "meta": '{"Followers":"3"}'}
    assert judge("Name: Full Name", ["name"])[1] == "kv"
    assert judge("Name : Ann - Contact : {\"email\":\"a@example.com\"}", ["email", "name"])[4]["email"] == "a@example.com"
    assert judge("Cell,Berlin", ["phone", "address"])[0] == "uncertain"
    assert judge("12345-6789,Town", ["phone"])[0] == "uncertain"
    v = judge("Mr,Ann,Lee,12 Main St,90210,a@example.com", ["email", "name", "address"])
    assert v[1] == "csv-auto" and v[4]["name"] == "Ann, Lee, 12 Main St" and v[4]["address"] == "90210"


def test_header_stage():
    s = FieldSpec(["email", "name", "phone", "address"])
    lay = layout_of("id,email,full_name,phone,address", s)
    j = Judge(s)
    assert j.judge("id,email,full_name,phone,address", lay, True)[1] == "header"
    v = j.judge('7,a@example.com,Ann,15550100199,"1 Main, X"', lay)
    assert v[:2] == ("parsed", "csv-mapped") and v[4]["address"] == "1 Main, X" and '"id":"7"' in v[4]["meta"]
    assert j.judge("ID,Email,Full_Name,Phone,Address", lay)[1] == "header"
    assert j.judge("7,not-an-email,Ann,1,x", lay)[4]["email"] is None


def test_binary_and_errors():
    assert judge('{"name":"\\u0001\\u0002\\u0003abc"}', ["name"])[:2] == ("rubbish", "binary-field")
    assert judge("", ["name"])[0] == "uncertain"
    deep = "[" * 100_000
    assert judge(deep, ["name"])[1] == "json-raw-meta"


def test_objects():
    assert flatten({"a": {"b": 1}, "c": [{"d": 2}], "e": [1, 2], "f": {}}, set()) == {"a.b": 1, "c[0].d": 2, "e": [1, 2], "f": {}}
    assert flatten({"a": {"b": 1}}, {"a"}) == {"a": {"b": 1}}
    assert loose_pairs('{"a":"x","b":1,"a":"y"') == {"a": "x", "b": 1}
    assert read_object('"{\\"a\\":1}"') == {"a": 1}
    m = Mapper(FieldSpec(["name", "skills"]))
    row, ambiguous = m.from_object({"firstname": "Ann", "lastname": "Lee", "expertise": ["x", " ", "y"]}, loose=True)
    assert row["name"] == "Ann Lee" and row["skills"] == "x; y" and not ambiguous
    assert Mapper(FieldSpec(["city"])).from_object({"x": 1, "y": 2}) is None
    assert load('{"a":1}') == {"a": 1}
    assert m.enriched({"name": None, "skills": "a", "meta": '{"first name":"Ann","lastname":"Lee","Skills":"b"}'}) == {"name": "Ann Lee", "skills": "a, b", "meta": None}


def test_templates():
    s = FieldSpec(["a", "email"])
    t = Template("t", "f", "record", field_map={"a": "index:0", "email": "regex:([^ ]+@[^ ]+)"}, delimiter="|")
    assert extract(t, "x|y z@example.com", s)[0]["a"] == "x"
    assert extract(Template("k", "f", "record", field_map={"a": "key:A"}, structure="kv", delimiter="-"), "A: 1 - B: 2", s)[0]["a"] == "1"
    assert extract(t, "nothing", s) is None
    junk = Template("r", "g", "rubbish", signature="^WARNING: ", confidence=0.95)
    assert rubbish_template([junk], "WARNING: x") is junk and rubbish_template([junk], "x") is None
    assert rubbish_template([Template("r", "g", "rubbish", signature="^a.*b", confidence=1.0)], "ab") is None  # too generic
    assert offline_teacher("ERROR x", s).kind == "rubbish" and offline_teacher("a,b,c", s).kind == "record" and offline_teacher("a", s) is None
    assert not safe_pattern("(a+)+b") and not safe_pattern("x" * 2000) and not safe_pattern("(") and safe_pattern("a+b")
    assert literal_run(r"^\[INFO\] x") >= 6 and literal_run("^a.b$") == 1


def test_delimiters_are_counted_before_cells_are_cut(spark):
    from pyspark.sql import functions as F

    from lineloom.operators.cells import best_delimiter
    from lineloom.operators.detect import header_labels

    lines = ["a, b ,　c\t", "a;b,c", "x\ty\tz|", ":", "one", "", "a|b|c,d", "\\;\\", "é.,x", " lead ; trail ", None, "Name,Город,e-mail_address", "a@x.com,b", "12,b"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
    got = {r.i: (r.b.cells, r.b.delimiter, r.b.n) if r.b else None for r in df.select("i", best_delimiter(F.col("x")).alias("b")).collect()}
    assert got == {i: (*b, len(b[0])) if x is not None and (b := best_cells(x)) else None for i, x in enumerate(lines)}
    labels = {r.i for r in df.where(header_labels(F.col("x")).isNotNull()).select("i").collect()}
    assert labels == {i for i, x in enumerate(lines) if x and (b := best_cells(x)) and all(not c or is_label(c) for c in b[0])}
    # a split for lines with odd blanks, one for others: each delimiter had its own before, and each use of the result all of them again
    plan = df.select(header_labels(F.col("x")).alias("h"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2
