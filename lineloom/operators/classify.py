"""Each line gets one of three verdicts: parsed, rubbish or uncertain.

Layout first: the head line of each source is read once and gives labels, delimiter and places; then every line is
judged by itself, so lines can be dealt out freely. The stages, of which the first that knows counts: gate, header,
repeated header, column map, object, key-value, cells by header, cells by content, loose object, learned templates,
rubbish signatures. Lines that plainly fit their source's header take a native path; the others go to Python in
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import sanitize
from ..functions.validate import BINARY, BINARY_SHARE, gate, share, valid_field
from ..functions.validate import field_ok as _field_ok
from ..ship import ship
from ..sources.dumps import COPY, copy_cell, dump_stage
from ..spec import META, FieldSpec, copy_targets
from .cells import best_cells, merge_scheme, split_cells, trimmed
from .detect import Layout, given_layout, header_places, layout_of, repeats_header
from .mapping import Mapper, dump, read_object, unquoted
from .templates import RecordIndex, RubbishIndex, Template

#: Sources whose layouts may be sent to all tasks; more are joined.
MOST_LAYOUTS = 10_000
#: The template of a line that looks like an object and that no stage knows.
RAW = "json-raw-meta"
RESULT = T.StructType([T.StructField("verdict", T.StringType()), T.StructField("template_id", T.StringType()), T.StructField("template_version", T.IntegerType()), T.StructField("failure_class", T.StringType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType()))])


class Judge:
    """The stages for one line, behind the gate."""

    def __init__(self, spec: FieldSpec, templates: list[Template] = ()):
        self.spec, self.mapper = spec, Mapper(spec)
        self.kept, self.junk = RecordIndex(list(templates), spec), RubbishIndex(list(templates))

    def _row(self, row: dict, template: str, version: int = 1) -> tuple:
        out = self.mapper.coerced(row)
        if out is None:
            return ("rubbish", "binary-field", None, None, None)
        return ("parsed", template, version, None, self.mapper.cleaned(self.mapper.enriched(out)))

    def judge(self, line: str, layout: Layout | None, first: bool = False) -> tuple:
        """(verdict, template_id, template_version, failure_class, fields)."""
        try:
            return self._judge(line, layout, first)
        except Exception as e:  # one bad line must not lose the others: it becomes a dead letter
            return ("uncertain", None, None, f"transform_error: {type(e).__name__}", None)

    def _cells(self, line: str, layout: Layout | None) -> tuple[list[str], str] | None:
        own = (split_cells(line, layout.delimiter), layout.delimiter) if layout and layout.delimiter else None
        if own is None or layout and len(own[0]) < len(layout.labels):
            other = best_cells(line)
            if own is None or other and len(other[0]) > len(own[0]):
                own = other
        return (merge_scheme(*own), own[1]) if own else None

    def _judge(self, line: str, layout: Layout | None, first: bool) -> tuple:
        spec, m, t = self.spec, self.mapper, line.strip()
        structured = t[:1] in ("{", "[")
        if layout and not structured:
            cells = self._cells(line, layout)
            if first and layout.in_file or cells and repeats_header(cells[0], layout.labels):
                return ("rubbish", "header", None, None, None)
        if spec.column_map and not (layout and layout.places) and (got := best_cells(line)) and (row := m.from_column_map(got[0])):
            return self._row(row, "csv-column-map")
        obj = read_object(t)
        if obj is not None and (got := m.from_object(obj)) and not got[1]:
            return self._row(got[0], "json")
        if (row := m.from_kv(line)) is not None:
            return self._row(row, "kv")
        if spec.fields and not structured and (got := self._cells(line, layout)):
            cells, delimiter = got
            row = m.from_header(cells, layout.labels, layout.places, delimiter) if layout and layout.places else False
            if row:
                return self._row(row, "csv-mapped")
            if row is False and not (layout and layout.places and header_places(cells, spec)) and (row := m.from_content(cells)):
                return self._row(row, "csv-auto")
        if obj is not None and (got := m.from_object(obj, loose=True)) and not got[1]:
            return self._row(got[0], "json")
        return self._by_templates(line)

    def _by_templates(self, line: str) -> tuple:
        """The last stages, for a line that no other one knows."""
        t = line.strip()
        if found := self.kept.best(line):
            return self._row(found[1], found[0].template_id, found[0].version)
        if found := self.junk.first(line):
            return ("rubbish", found.template_id, found.version, None, None)
        if t[:1] in ("{", "[") or t[:1] == '"' and unquoted(t)[:1] in ("{", "["):  # never lose what looks like an object
            return ("parsed", RAW, 1, None, dict.fromkeys(self.spec.wanted, "") | {META: t})
        return ("uncertain", None, None, "uncertain", None)

    def by_templates(self, line: str) -> tuple:
        try:
            return self._by_templates(line)
        except Exception as e:  # as in judge
            return ("uncertain", None, None, f"transform_error: {type(e).__name__}", None)


def layouts(lines: DataFrame, spec: FieldSpec, source: str = "source") -> DataFrame:
    """(source, labels, delimiter, places): a row per source whose first line is a header. Reads first lines only."""
    ship(lines.sparkSession)
    schema = f"{source} string, labels array<string>, delimiter string, places map<string,array<int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(s, lay) for s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if t and (lay := layout_of(t, spec))]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.string()), pa.array([x.labels for _, x in out], pa.list_(pa.string())), pa.array([x.delimiter for _, x in out], pa.string()), pa.array([list(x.places.items()) for _, x in out], pa.map_(pa.string(), pa.list_(pa.int32())))], names=[source, "labels", "delimiter", "places"])

    return lines.where("line_no = 1").select(F.col(source).cast("string"), "text").mapInArrow(run, schema)


def with_known(lines: DataFrame, found: DataFrame, source: str) -> DataFrame:
    """Each line with its source's layout; few layouts are sent around, else both sides are dealt by source and part."""
    some = found.limit(MOST_LAYOUTS + 1).collect()
    if len(some) <= MOST_LAYOUTS:
        few = found.sparkSession.createDataFrame(some, found.schema)
        return lines.join(F.broadcast(few), source, "left")
    parts = 64
    wide = found.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return lines.withColumn("_part", F.pmod(F.xxhash64("line_no"), F.lit(parts)).cast("int")).join(wide, [source, "_part"], "left").drop("_part")


def _split(c: Column) -> Column:
    """A line's cells by its layout's delimiter, which is a comma if none is known."""
    out = F.split(c, ",", -1)
    for d, pattern in (("\t", "\t"), ("|", "[|]"), (";", ";")):
        out = F.when(F.col("delimiter") == d, F.split(c, pattern, -1)).otherwise(out)
    return out


def _plain() -> Column:
    """Native: whether a line is sure to be a row by its header: no quote, brace or label with a colon; as many cells as labels."""
    t = F.col("text")
    cells = F.col("_cells")
    return F.col("places").isNotNull() & F.col("delimiter").isin(",", ";", "\t", "|") & ~t.rlike(r'["{}\[\]]') & ~t.rlike(r"^\s*[A-Za-z][A-Za-z0-9 _]*?\s*:|\s-\s+[A-Za-z][A-Za-z0-9 _]*?\s*:") & (F.size(cells) == F.size("labels"))


def classify(lines: DataFrame, spec: FieldSpec, templates: list[Template] = (), headers: list[str] | None = None, source: str = "source", layout: DataFrame | None = None, native: bool = True) -> DataFrame:
    """lines (source, line_no, text, ...) with verdict, template_id, template_version, failure_class and fields."""
    ship(lines.sparkSession)
    keep = lines.columns
    if headers is not None:
        stated = given_layout(headers, spec)
        found = lines.select(F.col(source)).distinct().withColumns({"labels": F.array(*map(F.lit, stated.labels)), "delimiter": F.lit(None).cast("string"), "places": F.map_from_entries(F.array(*[F.struct(F.lit(f), F.array(*map(F.lit, at))) for f, at in stated.places.items()]))})
    else:
        found = layouts(lines, spec, source) if layout is None else layout
    found = found.withColumn("label_keys", F.transform("labels", lambda h: F.regexp_replace(F.lower(h), r"[^\p{L}\p{N}]", "")))
    gated = with_known(lines, found, source).withColumn("_gate", gate(F.col("text")))
    cells = trimmed(F.col("text"), _split(F.col("text")))
    gated = gated.withColumn("_cells", F.when(F.col("delimiter").isNotNull(), cells))
    gated = gated.withColumn("_route", F.when(F.col("_gate").isNotNull(), "gate").when(_plain() & F.lit(native and headers is None), "plain").otherwise("judge"))

    none = F.lit(None).cast("map<string,string>")
    stopped = gated.where("_route = 'gate'").select(*keep, F.when(F.col("_gate") == "too-long", "uncertain").otherwise("rubbish").alias("verdict"), F.when(F.col("_gate") != "too-long", F.col("_gate")).alias("template_id"), F.lit(None).cast("int").alias("template_version"), F.when(F.col("_gate") == "too-long", "transform_error").alias("failure_class"), none.alias("fields"))
    out = [stopped]
    if native and headers is None:
        out.append(_by_header(gated.where("_route = 'plain'"), spec, keep))

    in_file = headers is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(spec, templates)
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in ("text", "line_no", "labels", "delimiter", "places")}
            seen: dict = {}
            got = []
            for text, no, labels, delimiter, places in zip(*cols.values(), strict=True):
                lay = None
                if labels is not None:
                    key = (tuple(labels), delimiter)
                    if (lay := seen.get(key)) is None:
                        lay = seen[key] = Layout(labels, delimiter, dict(places or []), in_file)
                got.append(judge.judge(text or "", lay, no == 1))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], *verdict_arrays(got)], names=[*keep, *RESULT.fieldNames()])

    rest = gated.where("_route = 'judge'").select(*keep, "labels", "delimiter", "places")
    out.append(rest.mapInArrow(run, T.StructType([*lines.schema.fields, *RESULT.fields])))
    total = out[0]
    for x in out[1:]:
        total = total.unionByName(x)
    return total


def by_templates(judged: DataFrame, spec: FieldSpec, templates: list[Template]) -> DataFrame:
    """What classify gave without templates, with those stages done that templates have a part in; lines that an earlier stage knows stay.

    Gives what classify gives with the templates, but the stages before aren't gone through again. judged is read twice: it should be a
    written table.
    """
    ship(judged.sparkSession)
    keep = [c for c in judged.columns if c not in RESULT.fieldNames()]
    open_ = F.coalesce((F.col("verdict") == "uncertain") & (F.col("failure_class") == "uncertain") | (F.col("template_id") == RAW), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(spec, templates)
        for b in batches:
            got = [judge.by_templates(text or "") for text in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], *verdict_arrays(got)], names=[*keep, *RESULT.fieldNames()])

    again = judged.where(open_).select(*keep)
    return judged.where(~open_).select(*keep, *RESULT.fieldNames()).unionByName(again.mapInArrow(run, T.StructType([*again.schema.fields, *RESULT.fields])))


def email_ok(v: str) -> bool:
    return _field_ok("email", v)


def phone_ok(v: str) -> bool:
    return "@" not in v and 10 <= sum(c.isdigit() for c in v) <= 15


def no_layout(spark) -> DataFrame:
    """For lines that have no header: whole records, or dead letters that come again."""
    return spark.createDataFrame([], "source string, labels array<string>, delimiter string, places map<string,array<int>>")


def placed_contacts(row: dict) -> dict:
    """user_name falls back to full_name; what stands in user_email and msisdn goes where it belongs, or goes if it is neither."""
    row = dict(row)

    def get(k):
        v = row.get(k)
        return v.strip() or None if v is not None else None

    if "user_name" in row and get("full_name") and not get("user_name"):
        row["user_name"] = get("full_name")
    seen = [v for v in (get("user_email"), get("msisdn")) if v]
    if not seen:
        return row
    mail = next((v for v in seen if email_ok(v)), None)
    phone = next((v for v in reversed(seen) if phone_ok(v) and not email_ok(v)), None)
    for k, v in (("user_email", mail), ("msisdn", phone)):
        if k in row:
            row[k] = v
    return row


def classify_dump(lines: DataFrame, spec: FieldSpec) -> DataFrame:
    """Lines of PostgreSQL dumps: rows of COPY blocks are parsed, all other lines are rubbish by their stage. Lines before the dump's
    first line, if any, aren't given."""
    ship(lines.sparkSession)
    keep = lines.columns
    staged = dump_stage(lines).where("stage IS NOT NULL")
    none = [F.lit("rubbish").alias("verdict"), F.col("stage").alias("template_id"), F.lit(None).cast("int").alias("template_version"), F.lit(None).cast("string").alias("failure_class"), F.lit(None).cast("map<string,string>").alias("fields")]
    cells = F.transform(F.split("text", "\t", -1), copy_cell)
    rows = staged.where("stage = 'pg-copy'").select(*keep, cells.alias("_cells"), F.regexp_extract("copy_head", COPY, 2).alias("_columns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, known = Judge(spec), {}
        for b in batches:
            got = []
            for values, head in zip(b.column("_cells").to_pylist(), b.column("_columns").to_pylist(), strict=True):
                if head not in known:
                    columns = [c.strip().strip('"') for c in head.split(",")]
                    known[head] = (columns, copy_targets(columns, spec))
                columns, targets = known[head]
                values = values + [None] * (len(columns) - len(values))
                row = dict.fromkeys(spec.fields) | {f: v for f, v in zip(targets, values, strict=False) if f}
                rest = {c: v for c, f, v in zip(columns, targets, values, strict=False) if not f}
                try:
                    got.append(judge._row(placed_contacts(row) | {META: dump(rest) if rest else None}, "pg-copy"))
                except Exception as e:  # one bad row must not lose the others
                    got.append(("uncertain", None, None, f"transform_error: {type(e).__name__}", None))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], *verdict_arrays(got)], names=[*keep, *RESULT.fieldNames()])

    parsed = rows.mapInArrow(run, T.StructType([*lines.schema.fields, *RESULT.fields]))
    return staged.where("stage != 'pg-copy'").select(*keep, *none).unionByName(parsed)


def verdict_arrays(got: list[tuple]) -> list[pa.Array]:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()))
    v = list(zip(*got, strict=True)) if got else [()] * 5
    return [pa.array(x if k != kinds[4] else [None if y is None else list(y.items()) for y in x], k) for x, k in zip(v, kinds, strict=True)]


def _by_header(plain: DataFrame, spec: FieldSpec, keep: list[str]) -> DataFrame:
    """Native form of the header stages."""
    cells, labels, places = F.col("_cells"), F.col("labels"), F.col("places")

    # the keys of all cells by one pattern over the line, delimiters kept
    keys = _split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N},;|\t]", ""))
    same = F.aggregate(F.zip_with(keys, F.col("label_keys"), lambda c, h: ((h != "") & (c == h)).cast("int")), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    known = F.size(F.filter(labels, lambda h: h != ""))
    header = (F.col("line_no") == 1) | ((known >= 2) & (same >= F.greatest(F.lit(2), F.ceil(known / 2).cast("int"))))
    fields = {}
    for f in spec.wanted:
        at = F.try_element_at(places, F.lit(f))
        v = F.array_join(F.filter(F.transform(at, lambda i: F.get(cells, i)), lambda c: F.coalesce(c != "", F.lit(False))), ", ")
        v = F.when(v != "", v)
        fields[f] = F.when(valid_field(spec.key[f], v), v) if spec.key[f] in ("email", "phone") else v
    any_field = F.lit(False)
    for f in spec.wanted:
        at = F.try_element_at(places, F.lit(f))
        any_field |= F.coalesce(F.exists(at, lambda i: F.get(cells, i) != ""), F.lit(False))
    used = F.flatten(F.map_values(places))
    rest = F.filter(F.transform(F.arrays_zip(labels.alias("h"), cells.alias("c")), lambda x, i: F.struct(x["h"].alias("h"), x["c"].alias("c"), i.alias("i"))), lambda x: ~F.array_contains(used, x["i"]) & (x["c"] != ""))
    pairs = F.transform(rest, lambda x: F.concat(F.to_json(F.array(x["h"])).substr(F.lit(2), F.length(F.to_json(F.array(x["h"]))) - 2), F.lit(":"), F.to_json(F.array(x["c"])).substr(F.lit(2), F.length(F.to_json(F.array(x["c"]))) - 2)))
    meta = F.when(F.size(rest) > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))
    bad = F.when(F.col("text").rlike(BINARY), F.exists(cells, lambda c: share(c, BINARY) > BINARY_SHARE)).otherwise(F.lit(False))
    enough = any_field | meta.isNotNull()
    done = plain.withColumns({"_header": header, "_bad": bad, "_enough": enough, "_meta": meta})
    row = F.create_map(*[x for f in spec.wanted for x in (F.lit(f), fields[f])], F.lit(META), F.col("_meta"))
    parsed = ~F.col("_header") & ~F.col("_bad") & F.col("_enough")
    return done.select(*keep, F.when(F.col("_header") | F.col("_bad"), "rubbish").when(F.col("_enough"), "parsed").otherwise("uncertain").alias("verdict"), F.when(F.col("_header"), "header").when(F.col("_bad"), "binary-field").when(F.col("_enough"), "csv-mapped").alias("template_id"), F.when(parsed, 1).alias("template_version"), F.when(~F.col("_header") & ~F.col("_bad") & ~F.col("_enough"), "uncertain").alias("failure_class"), F.when(parsed, row).alias("fields"))


def records(classified: DataFrame, job_id: str, now, part: str = "auto", source: str = "source") -> DataFrame:
    """The parsed lines with their lineage. _record_index is dense over the parsed rows of a source, in order of lines."""
    from .windows import dense_index

    parsed = dense_index(classified.where("verdict = 'parsed'"), [source], "line_no", "_record_index")
    text = sanitize(F.to_json("fields", {"ignoreNullFields": "false"}))
    return parsed.select(F.lit(job_id).alias("_job_id"), F.col("byte_offset").cast("long").alias("_byte_offset"), F.col("byte_length").cast("int").alias("_byte_length"), "_record_index", F.col("line_no").cast("long").alias("_line_no"), F.col("template_id").alias("_template_id"), F.coalesce("template_version", F.lit(1)).alias("_template_version"), F.sha2("text", 256).alias("_checksum"), F.lit(now).cast("timestamp").alias("_parsed_at"), F.lit(part).alias("_part_id"), text.alias("fields"))


def rubbish(classified: DataFrame, job_id: str, now) -> DataFrame:
    return classified.where("verdict = 'rubbish'").select(F.lit(job_id).alias("job_id"), F.col("byte_offset").cast("long").alias("byte_offset"), F.col("line_no").cast("long").alias("line_no"), F.col("text").alias("raw_bytes"), F.col("template_id").alias("matched_template_id"), F.lit(now).cast("timestamp").alias("logged_at"))


def dead_letters(classified: DataFrame, job_id: str, now) -> DataFrame:
    """The uncertain lines; ids are hashes of job and offset, so a repeated run gives the same."""
    at = F.lit(now).cast("timestamp")
    return classified.where("verdict = 'uncertain'").select(F.sha2(F.concat_ws(":", F.lit(job_id), "source", F.col("byte_offset").cast("string"), F.col("line_no").cast("string")), 256).alias("dlq_id"), F.lit(job_id).alias("job_id"), F.col("byte_offset").cast("long").alias("byte_offset"), F.col("byte_length").cast("int").alias("byte_length"), F.col("line_no").cast("long").alias("line_no"), F.col("text").alias("raw_bytes"), F.split("failure_class", ":")[0].alias("failure_class"), F.col("failure_class").alias("error"), F.lit(0).alias("attempts"), F.lit("pending").alias("status"), at.alias("created_at"), at.alias("updated_at"), F.col("source").cast("string").alias("source"))


def wide(parsed: DataFrame, spec: FieldSpec, fields: str = "fields") -> DataFrame:
    """A column per field from the map of a classified line."""
    own = [c for c in parsed.columns if c not in spec.fields]
    return parsed.select(*own, *[F.col(fields)[f].alias(f) for f in spec.fields])

