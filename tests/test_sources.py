"""Sources, encodings, archives and URLs."""

import gzip
import io
import random
import tarfile
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lineloom.functions import encoding as enc
from lineloom.sources import archives, dumps, lines, urls
from lineloom.sources.cutting import Rule, Trials, after, cut, key
from lineloom.sources.lines import MAX_LINE_BYTES, from_binary, lines_of, numbered, read_lines, register, split_lines, split_tail


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet='ab",é\r', max_size=12), max_size=12), st.booleans())
def test_lines_add_up(parts, end):
    raw = ("\n".join(parts) + ("\n" if end else "")).encode()
    got = lines_of(raw, "utf-8")
    assert sum(n for _, _, n, _ in got) == len(raw)
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:]))  # noqa: B905
    want = raw.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    assert [t for *_, t in got] == [w.removesuffix(b"\r").decode() if i < len(want) - 1 or raw.endswith(b"\n") else w.decode() for i, w in enumerate(want)]


def test_line_rules():
    assert [x for x, *_ in split_lines(b"\xef\xbb\xbfa\r\nb\n\nc")] == [b"a", b"b", b"", b"c"]
    assert [x for x, *_ in split_lines(b'a,"x\ny"\nb', quoted_newlines=2)] == [b'a,"x\ny"', b"b"]
    assert [n for *_, n in split_lines(b"z" * (MAX_LINE_BYTES + 5))] == [MAX_LINE_BYTES, 5]
    assert split_tail("Email: a Name: x Email: b") == ["Email: a Name: x", "Email: b"]
    assert [t for *_, t in lines_of("ä\nb".encode("utf-16-le") * 4)][0] == "ä"


@pytest.mark.parametrize("chunk", [7, 13, 64, 100, 4096])
def test_ranges_give_the_same_lines(spark, tmp_path, chunk):
    raw = ("id,name\r\n" + "".join(f'{i},"näme {i}"\n' for i in range(300)) + "tail").encode()
    p = tmp_path / "f.csv"
    p.write_bytes(raw)
    register(spark)
    got = numbered(spark.read.format("lines").option("path", str(p)).option("chunk", str(chunk)).load()).orderBy("line_no").collect()
    assert [(r.line_no, r.byte_offset, r.byte_length, r.text) for r in got] == lines_of(raw, "utf-8")


@pytest.mark.parametrize("end", [b"\r\n", b""])
def test_ranges_give_long_lines_whole(spark, tmp_path, end):
    m = MAX_LINE_BYTES
    raw = b"a\n" + b"x" * (3 * m + 5) + b"\nb\n" + b"y" * (2 * m) + b"\n" + b"z" * (m - 1) + b"\nc\n" + b"w" * (4 * m + 1) + end
    p = tmp_path / "long.sql"
    p.write_bytes(raw)
    register(spark)
    for chunk in (m // 2, m, m + 7, 3 * m):
        got = numbered(spark.read.format("lines").option("path", str(p)).option("chunk", str(chunk)).load()).orderBy("line_no").collect()
        assert [(r.byte_offset, r.byte_length, r.text.encode()) for r in got] == [(at, size, line) for line, at, size in split_lines(raw)]


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    (tmp_path / "b.txt").write_bytes("é\n".encode("cp1252") * 30)
    got = {(r.source.rpartition("/")[2], r.line_no, r.text) for r in read_lines(spark, str(tmp_path)).collect()}
    assert ("a.txt", 2, "y") in got and ("b.txt", 30, "é") in got and len(got) == 32
    assert from_binary(spark.createDataFrame([("p", None)], "path string, content binary")).count() == 0


def test_large_files_are_read_like_small_ones(spark, tmp_path, monkeypatch):
    text = "".join(f'{i},"né {i}\r\nzwei"\r\n' for i in range(200)) + "é" * 9000 + "\nlast"
    for name, encoding in (("w", "cp1252"), ("u", "utf-8"), ("le", "utf-16-le"), ("be", "utf-16-be"), ("bom", "utf-16")):
        (tmp_path / name).write_bytes(text.encode(encoding))
    for quoted in (0, 2):
        rows = []
        for whole in (1 << 20, 10):
            monkeypatch.setattr(lines, "WHOLE", whole)
            rows.append(sorted((r.source.rpartition("/")[2], r.line_no, r.byte_offset, r.byte_length, r.text) for r in read_lines(spark, str(tmp_path), quoted_newlines=quoted).collect()))
        assert rows[0] == rows[1] and "\ufffd" not in "".join(r[4] for r in rows[1])


@pytest.mark.parametrize("split", [5, 17, 64, 4096])
def test_text_splits_give_the_same_lines(spark, tmp_path, monkeypatch, split):
    rng = random.Random(split)
    made = {"we[i]rd {x} 50%.txt": b"".join(rng.choice([b"a", b"\n", b"\r\n", "é".encode(), b"bcd", b'"']) for _ in range(300)), "a%20b.txt": b"\xef\xbb\xbf\xef\xbb\xbffirst\nlast", "latin.txt": b"caf\xe9,\n" * 9, "ends.txt": b"\n\n\r\n\n", "one.txt": b"no end " * 20}
    for n in (19, 20, 21, 40):
        made[f"long{n}.txt"] = b"x" * n
        made[f"longer{n}.txt"] = b"\xef\xbb\xbf" + b"x" * n + b"\n" + b"y" * n + b"\r\n"
    monkeypatch.setattr(lines, "MAX_LINE_BYTES", 20)
    for name, raw in made.items():
        (tmp_path / name).write_bytes(raw)
    conf = spark._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.store{split}.link./in", f"file://{tmp_path}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        monkeypatch.setattr(lines, "WHOLE", 0)
        # tables of a few rows would be cut into splits of these sizes, too
        monkeypatch.setattr(lines, "written", lambda df: spark.createDataFrame(df.collect(), df.schema))
        for root in (str(tmp_path), f"viewfs://store{split}/in"):
            got = sorted((r.source.rpartition("/")[2], r.line_no, r.byte_offset, r.byte_length, r.text) for r in read_lines(spark, root).collect())
            assert got == sorted((name, *x) for name, raw in made.items() for x in lines_of(raw))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("most", [20, 1000])
def test_splits_of_wide_and_quoted_text(spark, tmp_path, monkeypatch, most):
    """UTF-16 and quoted newlines by splits on a file system that only Spark's readers open; with most = 20 lines are cut over split borders."""
    rng = random.Random(most)
    marks = ["a", "\n", "\r\n", '"', '"', "bcdefgh", "é", "\u0a05", "\u0100", "\u0a0a", "\u010a"]
    made = {name: ("abcdefghij" * 5 + "".join(rng.choice(marks) for _ in range(200))).encode(name) for name in ("utf-16-le", "utf-16-be")}
    made["quotes.csv"] = b"".join(rng.choice([b"a", b"\n", b'"', b'"', b"\r\n", b"cell,"]) for _ in range(300))
    made["marked.csv"] = b'\xef\xbb\xbf"first\nline", x' + b"y" * 90 + b'\n"a\n\nb"\nlast'
    monkeypatch.setattr(lines, "MAX_LINE_BYTES", most)
    monkeypatch.setattr(lines, "WHOLE", 0)
    monkeypatch.setattr(lines, "written", lambda df: spark.createDataFrame(df.collect(), df.schema))
    for name, raw in made.items():
        (tmp_path / name).write_bytes(raw)
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.wide{most}.link./in", f"file://{tmp_path}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "70")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for quoted in (0, 2):
            got = sorted((r.source.rpartition("/")[2], r.line_no, r.byte_offset, r.byte_length, r.text) for r in read_lines(spark, f"viewfs://wide{most}/in", quoted_newlines=quoted).collect())
            assert got == sorted((name, *x) for name, raw in made.items() for x in lines_of(raw, None, quoted))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_all_large_files_are_known(spark):
    files = spark.range(10_050).selectExpr("concat('file:/f', id) AS path", "if(id = 7, 5, shiftleft(1L, 40)) AS length")
    assert len(lines.large_files(files)) == 10_049


def test_lines_of_blocks():
    raw = b'\xef\xbb\xbfa,"x\r\ny"\r\n\r\nb,"\n\n\n"\n' + b"k" * (MAX_LINE_BYTES + 9) + b'\n"'
    for k in (1, 2, 3, 5, 1 << 20):
        part = raw if k > 9 else raw[:40]
        for q in (0, 1, 2):
            assert list(cut([part[i : i + k] for i in range(0, len(part), k)], Rule("utf-8", q, MAX_LINE_BYTES))) == [(x.decode(), a, n) for x, a, n in split_lines(part, 0, q)]


MARKS = ["a", "\n", "\n", "\r\n", "\r", '"', "bcd", "é", "\f", "\v", "\x1c", "\x85", "\u2028", "\u0a05", "\u0100", "\u010a", "\u0a0a"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(MARKS), max_size=40), st.integers(0, 2), st.integers(1, 9), st.sampled_from(["utf-16le", "utf-16be"]))
def test_one_rule_for_all_encodings(parts, quoted, k, name):
    """Form feeds, U+2028 and lone carriage returns end no line, whatever the encoding."""
    text = "".join(parts)
    raw = text.encode(name)
    got = list(cut([raw[i : i + k] for i in range(0, len(raw), k)], Rule(name, quoted, MAX_LINE_BYTES)))
    assert [t for t, *_ in got] == [x.decode() for x, *_ in split_lines(text.encode(), 0, quoted)]
    assert [a for _, a, _ in got] == [sum(n for *_, n in got[:i]) for i in range(len(got))] and sum(n for *_, n in got) == len(raw)
    assert got == [(t, a, n) for _, a, n, t in lines_of(raw, name, quoted)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(MARKS), min_size=1, max_size=60), st.integers(0, 3), st.sampled_from([8, 20, 1000]), st.sampled_from(["utf-8", "utf-16le", "utf-16be"]), st.randoms(use_true_random=False))
def test_states_compose(parts, quoted, most, name, r):
    """A stretch tried from every state it may begin in ends, from the true one, as the whole text does."""
    raw, rule = "".join(parts).encode(name), Rule(name, quoted, most)
    begins = [a for _, a, _ in cut([raw], rule)]
    stretches, at = [], 0
    while at < len(raw):
        end = at
        for _ in range(r.randint(1, 4)):
            e = raw.find(rule.end, end)
            end = len(raw) if e < 0 else e + len(rule.end)
        stretches.append(raw[at:end])
        at = end
    state, at = (0, 0, 0), 0
    for s in stretches:
        t, exact = Trials(rule), Trials(rule, state)
        for i in range(0, len(s), 5):
            t.feed(s[i : i + 5])
        exact.feed(s)
        sure = exact.done()[state]
        then = after(rule, state, sure, len(s))
        tried = t.done().get(key(rule, state))
        assert after(rule, state, tried, len(s)) in (None, then) and sure.starts == sum(at <= b < at + len(s) for b in begins)
        assert after(rule, state, tried, len(s)) is None or tried.starts == sure.starts
        state, at = then, at + len(s)


def test_what_the_queries_leave_out(spark):
    """The texts that byte_lines and mojibake filter away."""
    texts = ["plain", "né", "λόγος", "слово", "漢字", "😀", "€ “x”", "a\r\nb\r\n", "a\nb\n", "\n", "\r", "a\r\n\r\n", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    assert [r.t for r in df.orderBy("i").select(enc.recover_mojibake(broken).alias("t")).collect()] == texts
    files = df.select(F.col("i").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    got = {int(r.source): (r.n, r.bytes) for r in from_binary(files, "utf-8").groupBy("source").agg(F.count("*").alias("n"), F.sum("byte_length").alias("bytes")).collect()}
    assert got == {i: (x.count("\n") + (not x.endswith("\n")), len(x.encode())) for i, x in enumerate(texts) if x}


def test_encodings():
    assert enc.detect("abc".encode("utf-16-le") * 10) == "utf-16le" and enc.detect("abc".encode("utf-16-be") * 10) == "utf-16be"
    assert enc.detect("é".encode()[:1] + b"") != "utf-16le" and enc.likely_utf8("aé".encode()[:-1])
    assert enc.detect(b"\x93q\x94") == "windows-1252" and enc.decode(b"\x93q\x94", "cp1252") == "“q”"
    assert enc.decode(b"\xe9", "no such thing") == "é" and enc.decode(b"\xb1", "iso-8859-2") == "ą"


def _zip(files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
        for n, c in files.items():
            z.writestr(n, c)
    return b.getvalue()


def test_archives(spark):
    inner = gzip.compress(b"hello")
    b = io.BytesIO()
    with tarfile.open(fileobj=b, mode="w") as tar:
        info = tarfile.TarInfo("t.txt")
        info.size = 3
        tar.addfile(info, io.BytesIO(b"tar"))
    z = _zip({"a.txt": b"A", "x.gz": inner, "d/t.tar": b.getvalue()})
    assert dict(archives.entries(z)) == {"a.txt": b"A", "x.gz/x": b"hello", "d/t.tar/t.txt": b"tar"}
    bomb = _zip({"big": b"0" * (30 << 20)})
    with pytest.raises(archives.Bomb):
        list(archives.entries(bomb))
    files = spark.createDataFrame([("z", z), ("bomb", bomb), ("rar", b"Rar!x"), ("plain", b"text"), ("none", None), ("cut", z[:40])], "path string, content binary")
    got = archives.extract(files).collect()
    errors = {r.archive: r.error for r in got if r.error}
    assert errors["bomb"].startswith("bomb") and "not supported" in errors["rar"] and errors["cut"].startswith("archive")
    assert {r.entry for r in got if r.archive == "z"} == {"a.txt", "x.gz/x", "d/t.tar/t.txt"}


def test_entries_that_cannot_be_read(spark):
    z = bytearray(_zip({"a.txt": b"A" * 50, "b.txt": b"B" * 50, "c.gz": b"\x1f\x8bnot", "d.txt": b"D"}))
    at = z.index(b"b.txt") + 5
    z[at : at + 4] = bytes(x ^ 255 for x in z[at : at + 4])
    got = {r.entry: (bytes(r.content) if r.content is not None else None, (r.error or "").split(":")[0]) for r in archives.extract(spark.createDataFrame([("z", bytes(z))], "path string, content binary")).collect()}
    assert got == {"a.txt": (b"A" * 50, ""), "b.txt": (None, "archive"), "c.gz": (None, "archive"), "d.txt": (b"D", "")}
    assert list(archives.entries(gzip.compress(b"one ") + gzip.compress(b"two") + b"\0" * 9, "x.gz")) == [("x", b"one two")]
    with pytest.raises(EOFError):
        list(archives.entries(gzip.compress(b"one")[:-9], "x.gz"))


def test_urls():
    assert urls.check_url("http://93.184.216.34/x") is None
    for u, why in (("ftp://x", "scheme"), ("http://u:p@example.com", "credentials"), ("http://127.0.0.1", "private"), ("http://[::1]/", "private"), ("http://localhost", "host"), ("http://10.0.0.1", "private"), ("http://[::ffff:10.0.0.1]/", "private")):
        assert urls.check_url(u) == why
    assert urls.check_url("http://example.com", lambda h: ["10.1.2.3"]) == "private"
    assert urls.check_url("http://example.com", lambda h: ["93.184.216.34"]) is None


def test_dump_parts():
    create = "CREATE TABLE `t` (`id` int, `a b` decimal(10,2) DEFAULT '1,2', c text, PRIMARY KEY (`id`), KEY k (c));"
    assert dumps.table_columns(create) == ["id", "a b", "c"]
    rows = dumps.insert_rows("INSERT INTO `t` VALUES (1,'it''s \\'x\\' (y), z',NULL),(-2.5,'a','b',9);", ["id", "n", "c"])
    assert [r for r, _ in rows] == [{"id": 1, "n": "it's 'x' (y), z", "c": None}, {"id": -2.5, "n": "a", "c": "b", "meta": [9]}]
    assert dumps.insert_columns("INSERT INTO t (`x`, y) VALUES (1,2)") == ["x", "y"]
    assert dumps.insert_rows("INSERT INTO t SELECT 1", ["x"]) == []


def test_lines_of_small_files_share_batches():
    """A thousand small files gave a thousand batches before; large ones are still cut."""
    import pyarrow as pa

    class Files:
        sparkSession = None

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    from lineloom.sources import lines as module

    was, module.ship = module.ship, lambda spark: None
    try:
        run = module.from_binary(Files())
    finally:
        module.ship = was
    batch = lambda *raw: pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(len(raw))]), pa.array(raw, pa.binary())], names=["path", "content"])
    got = list(run(iter([batch(*[b"a\nb"] * 1000), batch(None, b"c\n")])))
    assert [b.num_rows for b in got] == [2001] and got[0].column("text").to_pylist()[-3:] == ["a", "b", "c"]
    assert [b.num_rows for b in run(iter([batch(b"x\n" * 50_000)]))] == [20_000, 20_000, 10_000]


def test_guess_counts_pairs_of_bytes():
    """Characters were looked at one by one, four times a head."""
    import time

    from lineloom.functions import encoding

    head = ("обычный текст с заметками, записан рукой 123\n" * 18).encode("koi8-r")
    assert encoding.guess(head) == ("koi8-r", 1.0) and encoding.guess(head.decode("koi8-r").encode("windows-1251"))[0] == "windows-1251"
    t = time.process_time()
    for _ in range(100):
        encoding._single(head, "koi8-r")
    assert (time.process_time() - t) / 100 < 0.0004  # about 40 microseconds; a millisecond before


def test_entries_share_batches_of_bounded_size():
    """Each entry was a batch before; now small ones share one, and no batch holds more than HELD bytes of several entries."""
    import gzip

    import pyarrow as pa

    from lineloom.sources import archives

    class Files:
        sparkSession = None

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    was, archives._ready = archives._ready, lambda spark: None
    try:
        run = archives.extract(Files())
    finally:
        archives._ready = was
    batch = lambda raws: pa.RecordBatch.from_arrays([pa.array([f"{i}.gz" for i in range(len(raws))]), pa.array(raws, pa.binary())], names=["path", "content"])
    small = list(run(iter([batch([gzip.compress(b"abc", 0)] * 500 + [b"\x1f\x8bxx", None])])))
    assert [b.num_rows for b in small] == [502] and small[0].column("content").to_pylist()[:2] == [b"abc", b"abc"] and small[0].column("error")[500].as_py()
    large = list(run(iter([batch([gzip.compress(bytes(1_000_000), 0)] * 10 + [gzip.compress(bytes(9_000_000), 0)])])))
    assert [b.num_rows for b in large] == [4, 4, 2, 1]
