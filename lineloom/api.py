"""The steps of a job as functions: submit, detect, parse, finalize, load, report, and what operators of jobs do."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.encoding import detect as detect_encoding
from .operators import classify as cl
from .operators import detect as dt_ops
from .operators import headers as hd
from .operators import jobs, metrics, profiles, sinks, stats
from .operators import registry as rg
from .operators.templates import Teacher, Template, learn
from .ship import ship
from .sources import archives, dumps, jsons, lines, parts
from .spec import FieldSpec, guessed_map

JOB = "job_id string, batch_id string, parent_job_id string, source_type string, source_ref string, field_spec array<string>, status string, parsed long, dropped_rubbish long, total_failed long, created_at timestamp, updated_at timestamp"
LOG = "job_id string, at timestamp, level string, message string"


def submit(spark: SparkSession, path: str, fields: list[str], batch_id: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """A job's row. Its id is a hash of path, fields and batch, so submitting twice gives one job."""
    now = now or dt.datetime.now(dt.UTC)
    job = hashlib.sha256("\x1f".join([path, *fields, batch_id or ""]).encode()).hexdigest()[:32]
    return spark.createDataFrame([(job, batch_id, None, "path", path, fields, "Created", 0, 0, 0, now, now)], JOB)


def submit_all(spark: SparkSession, prefix: str, fields: list[str], now: dt.datetime | None = None) -> DataFrame:
    """A job per file under a prefix, in one batch."""
    now = now or dt.datetime.now(dt.UTC)
    files = spark.read.format("binaryFile").load(prefix).select("path")
    key = F.sha2(F.concat_ws("\x1f", "path", *map(F.lit, fields), F.lit(prefix)), 256)
    return files.select(F.substring(key, 1, 32).alias("job_id"), F.lit(prefix).alias("batch_id"), F.lit(None).cast("string").alias("parent_job_id"), F.lit("path").alias("source_type"), F.col("path").alias("source_ref"), F.array(*map(F.lit, fields)).alias("field_spec"), F.lit("Created").alias("status"), *[F.lit(0).cast("long").alias(c) for c in ("parsed", "dropped_rubbish", "total_failed")], F.lit(now).cast("timestamp").alias("created_at"), F.lit(now).cast("timestamp").alias("updated_at"))


#: Files up to this size fit into a cell.
CELL = (2 << 30) - 1024


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df, written once to the folder that the driver and the executors share (spark.checkpoint.dir) and read again; df itself without one."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df
    path = f"{folder}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Large:
    """Files over lines.WHOLE bytes, told apart by their heads: paths to read whole (archives, JSON documents), to read as lines, with
    the kind of those that are dumps, and what can't be read, with why."""

    whole: list[str]
    lines: list[str]
    kinds: dict[str, str]
    failed: dict[str, str]
    heads: DataFrame | None


def told(spark: SparkSession, path: str) -> Large:
    """Heads are read in tasks. What comes back is a few bytes for each large file, whose paths Spark's index of files holds as well."""
    found = spark.read.format("binaryFile").load(path)
    sizes = {r[0]: r[1] for r in found.where(F.col("length") > lines.WHOLE).select("path", "length").collect()}
    out = Large([], [], {}, {}, None)
    by_name = {p for p in sizes if p.lower().endswith(lines.CODEC)}
    own = {lines.plain(p): p for p in sizes if p not in by_name}
    rows: list = [(p, "gz" if p.lower().endswith(".gz") else None, None, None, False) for p in by_name]
    if own:
        out.heads = lines.head_table(spark, list(own.values()))
        text = F.decode("head", "ISO-8859-1")
        first = F.substring_index(F.regexp_replace(F.make_valid_utf8(F.col("head").cast("string")), r"^[\s\ufeff]+", ""), "\n", 1)
        several = F.try_parse_json(first).isNotNull() & (F.instr(F.ltrim(text), "\n") > 0)  # as in NDJSON
        rows += [(own[r[0]], *r[1:]) for r in out.heads.select("source", archives.kind(F.col("head")), dumps.kind(text), F.substring(F.ltrim(text), 1, 1), several).collect()]
    for p, packed, kind, begin, several in rows:
        if packed or kind == "json" and not several and (sizes[p] <= jsons.WHOLE_MOST or begin == "["):
            if packed and sizes[p] > CELL:
                out.failed[p] = f"unreadable_archive: {sizes[p]} bytes, at most {CELL} are read"
            elif not packed and sizes[p] > jsons.WHOLE_MOST:
                out.failed[p] = f"too_large: a JSON document of {sizes[p]} bytes, at most {jsons.WHOLE_MOST} are read whole"
            else:
                out.whole.append(p)
        else:
            out.lines.append(p)
            if kind in ("mysql", "postgres"):
                out.kinds[p] = kind
    return out


def sources(spark: SparkSession, path: str, also: list[str] | None = None) -> DataFrame:
    """(source, content, error) of the files under a path, those within archives too, and the errors of those that can't be opened.
    Without `also` of all files, else of those up to lines.WHOLE bytes and the paths in `also`."""
    files = spark.read.format("binaryFile").load(path)
    if also is not None:
        files = files.where(F.col("length") <= lines.WHOLE)
        if also:
            files = files.unionByName(spark.read.format("binaryFile").load([lines.escaped(p) for p in also]))
    files = files.select("path", "content")
    packed = archives.extract(files.where(archives.kind(F.col("content")).isNotNull()))
    plain = files.where(archives.kind(F.col("content")).isNull()).select(F.col("path").alias("source"), "content", F.lit(None).cast("string").alias("error"))
    return plain.unionByName(packed.select(F.concat_ws("!", "archive", "entry").alias("source"), "content", "error"))


def detect(spark: SparkSession, path: str) -> DataFrame:
    """Per file: encoding, width of rows, fingerprint, kind of dump and labels, from its head; keys of objects come from probes too, but
    of files over lines.WHOLE bytes, of which only the head is read."""
    large = told(spark, path)
    found = sources(spark, path, large.whole).where("error IS NULL")
    files = found.select("source", F.substring("content", 1, 1 << 20).alias("head"), F.length("content").cast("long").alias("size"))
    plain_ones = [p for p in large.lines if not p.lower().endswith(lines.CODEC)]
    if plain_ones:
        sizes = spark.read.format("binaryFile").load(path).select(F.col("path"), F.col("length").alias("size"))
        own = spark.createDataFrame([(lines.plain(p), p) for p in plain_ones], "plain string, path string").join(sizes, "path")
        heads = lines.heads(spark, plain_ones, 1 << 20)
        files = files.unionByName(heads.join(own, heads["source"] == own["plain"]).select(own["path"].alias("source"), "head", "size"))

    ship(spark)

    @F.arrow_udf("string")
    def encoding(head: pa.Array) -> pa.Array:
        return pa.array([detect_encoding(bytes(h or b"")) for h in head.to_pylist()], pa.string())

    ls = lines.from_binary(files.select(F.col("source").alias("path"), F.col("head").alias("content")))
    first = ls.where("line_no = 1").select("source", F.col("text").alias("first"), dt_ops.fingerprint(F.col("text")).alias("fingerprint"))
    width = dt_ops.row_width(ls, ["source"]).withColumn("window", dt_ops.window_size(F.col("avg_bytes"), F.col("max_bytes")))
    text = F.make_valid_utf8(F.substring("head", 1, 1 << 16).cast("string"))
    beyond = hd.probe_lines(found, F.lit(dt_ops.MIN_WINDOW)).where("byte_offset > 0").select("source", ((1 << 40) + F.col("byte_offset")).alias("line_no"), "text")
    labels = hd.source_headers(files.select("source", text.alias("head")), ls.select("source", "line_no", "text").unionByName(beyond)).withColumnRenamed("origin", "headers_from")
    out = files.select("source", "size", encoding("head").alias("encoding"), dumps.kind(F.decode("head", "ISO-8859-1")).alias("dump")).join(first, "source", "left").join(labels, "source", "left").join(width, "source", "left")
    return out.withColumn("probes", dt_ops.probe_offsets(F.col("size"), F.coalesce("window", F.lit(dt_ops.MIN_WINDOW)).cast("long")))


def structures(spark: SparkSession, path: str, registry: DataFrame | None = None, window: int = dt_ops.MIN_WINDOW) -> DataFrame:
    """The structures that probes of each file show, and the template that is known for each."""
    return hd.probed_structures(sources(spark, path).where("error IS NULL"), F.lit(window), registry)


@dataclass
class Parsed:
    """The verdicts of a job's lines, and its tables."""

    lines: DataFrame
    records: DataFrame
    rubbish: DataFrame
    dead_letters: DataFrame
    counts: DataFrame
    templates: list[Template]
    #: labels, delimiter and places of each source with a header
    layout: DataFrame
    #: lines and verdicts as they were counted while the first verdicts were written: `measures.get`
    measures: Observation


def whole_records(files: DataFrame) -> DataFrame:
    """Lines (source, line_no, byte_offset, byte_length, text) and error: a record each of JSON files that are one document."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    docs = files.select("source", text.alias("text"))
    got = jsons.explode_document(docs, "text", ["source"])
    place = [(F.col("record_index") + 1).cast("long").alias("line_no"), F.lit(0).cast("long").alias("byte_offset"), F.octet_length("record").alias("byte_length"), F.col("record").alias("text")]
    good = got.select("source", *place, F.lit(None).cast("string").alias("error"))
    bad = jsons.too_large(docs, "text", ["source"])
    return good.unionByName(bad.select("source", F.lit(1).cast("long").alias("line_no"), F.lit(0).cast("long").alias("byte_offset"), F.lit(0).alias("byte_length"), F.lit(None).cast("string").alias("text"), "error"))


def judged(spark: SparkSession, path: str, spec: FieldSpec, templates: list[Template] = (), headers: list[str] | None = None, encoding: str | None = None) -> tuple[DataFrame, DataFrame, Observation]:
    """The lines of all files, judged by what kind of file they are in, the layouts of those with headers, and the count of verdicts.

    A file that is one JSON document gives its records, a MySQL dump the tuples of its INSERTs, a PostgreSQL dump its lines by stage,
    any other its lines. What can't be read (a document too large, a statement, a file in a broken archive) becomes a dead letter.
    """
    large = told(spark, path)
    files = stored(sources(spark, path, large.whole), "files")
    head = F.decode(F.substring("content", 1, 1 << 16), "ISO-8859-1")
    one = jsons.is_whole(F.make_valid_utf8(F.col("content").cast("string"))) | ((F.length("content") > jsons.WHOLE_MOST) & F.startswith(F.ltrim(head), F.lit("[")))
    kinds = files.where("error IS NULL").withColumn("kind", dumps.kind(head))
    kinds = kinds.withColumn("kind", F.when(F.col("kind") != "json", F.col("kind")).when(one, "json"))
    ls = lines.from_binary(kinds.where("kind IS DISTINCT FROM 'json'").select(F.col("source").alias("path"), "content"), encoding)
    dump_kinds = kinds.where("kind IN ('mysql', 'postgres')").select("source", "kind")
    if large.lines:
        ls = ls.unionByName(lines.read_large(spark, large.lines, encoding, found=large.heads))
        dump_kinds = dump_kinds.unionByName(spark.createDataFrame(list(large.kinds.items()), "source string, kind string"))
    ls = stored(ls.join(dump_kinds, "source", "left"), "lines")

    plain = ls.where("kind IS NULL").drop("kind")
    layout = stored(cl.layouts(plain, spec), "layouts") if headers is None else None
    none = cl.no_layout(spark)
    out = cl.classify(plain, spec, list(templates), headers, layout=layout)
    out = out.unionByName(cl.classify_dump(ls.where("kind = 'postgres'").drop("kind"), spec))
    tuples = dumps.mysql_all(ls.where("kind = 'mysql'").drop("kind")).select("source", "line_no", "byte_offset", F.octet_length("text").alias("byte_length"), "text", "error")
    packed = files.where("error IS NOT NULL").select("source", F.lit(1).cast("long").alias("line_no"), F.lit(0).cast("long").alias("byte_offset"), F.lit(0).alias("byte_length"), F.lit(None).cast("string").alias("text"), F.concat(F.lit("unreadable_archive: "), "error").alias("error"))
    unread = spark.createDataFrame([(p, 1, 0, 0, None, why) for p, why in large.failed.items()], packed.schema)
    whole = whole_records(kinds.where("kind = 'json'")).unionByName(tuples).unionByName(packed).unionByName(unread)
    out = out.unionByName(cl.classify(whole.where("error IS NULL").drop("error"), spec, list(templates), layout=none))
    failed = whole.where("error IS NOT NULL").select(*plain.columns, F.lit("uncertain").alias("verdict"), F.lit(None).cast("string").alias("template_id"), F.lit(None).cast("int").alias("template_version"), F.col("error").alias("failure_class"), F.lit(None).cast("map<string,string>").alias("fields"))
    out, seen = metrics.observed(out.unionByName(failed), **metrics.verdict_measures())
    return stored(out, "verdicts"), none if layout is None else layout, seen


def guessed(spark: SparkSession, path: str, spec: FieldSpec, guess: profiles.Guess = profiles.offline_guess) -> DataFrame:
    """(source, delimiter, column_map) of the sources without a header: the columns of the fields by what their values look like."""
    ls = lines.read_lines(spark, path)
    return profiles.guessed_columns(ls.join(cl.layouts(ls, spec).select("source"), "source", "left_anti"), spec, ["source"], guess)


def parse(spark: SparkSession, path: str, spec: FieldSpec, job_id: str, now: dt.datetime, templates: list[Template] = (), teacher: Teacher | None = None, budget: int = 10, headers: list[str] | None = None, encoding: str | None = None, registry: DataFrame | None = None, guess: profiles.Guess | None = None) -> Parsed:
    """All lines of a path, judged. What stays uncertain is judged by the registry's templates for lines of its structure; with a
    teacher, what is left is asked about, within a budget, and judged again.

    With a guess, sources without a header are read by a column map that it gives, if it gives the same one for all of them.
    Verdicts are written once, and all tables come from what is written.
    """
    if guess and not spec.column_map and not headers:
        maps = guessed(spark, path, spec, guess).select(F.array_sort(F.map_entries("column_map")).alias("m")).distinct().limit(2).collect()
        if len(maps) == 1:
            spec = replace(spec, column_map={e["key"]: e["value"] for e in maps[0]["m"]})
    if headers and spec.column_map:
        spec = replace(spec, column_map=guessed_map(spec.column_map, headers, spec.fields))
    done, layout, seen = judged(spark, path, spec, templates, headers, encoding)
    known = list(templates)
    open_ = (F.col("verdict") == "uncertain") & (F.col("failure_class") == "uncertain")
    if registry is not None:
        again = done.where(open_).select("source", "line_no", "byte_offset", "byte_length", "text")
        done = stored(done.where(~F.coalesce(open_, F.lit(False))).unionByName(rg.by_fingerprint(again, registry, spec)), "verdicts")
    if teacher:
        if new := learn(done.where(open_), spec, teacher, budget):
            known += new
            again = done.where(open_).select("source", "line_no", "byte_offset", "byte_length", "text")
            done = stored(done.where(~F.coalesce(open_, F.lit(False))).unionByName(cl.classify(again, spec, known, headers, layout=layout)), "verdicts")
    return Parsed(done, cl.records(done, job_id, now), cl.rubbish(done, job_id, now), cl.dead_letters(done, job_id, now), stats.job_counts(done.withColumn("job_id", F.lit(job_id)), ["job_id"]), known, layout, seen)


def parse_dump(spark: SparkSession, path: str, spec: FieldSpec) -> DataFrame:
    """Rows of MySQL dumps, projected by the columns' names."""
    return dumps.project_known(dumps.mysql_rows(lines.read_lines(spark, path)), spec.fields)


def parse_json(spark: SparkSession, path: str, spec: FieldSpec) -> DataFrame:
    """Records of whole JSON files, mapped like lines."""
    r = jsons.read_json(spark, path).select("source", (F.col("record_index") + 1).cast("long").alias("line_no"), F.col("record").alias("text"))
    return cl.classify(r, spec, layout=cl.no_layout(spark))


def store(records: DataFrame, path: str) -> int:
    """Adds records to the parts under a path; they count once the manifest names them. Gives the new generation."""
    parts.write_parts(records, path)
    return parts.manifest(path)["generation"]


def finalize(spark: SparkSession, path: str, target: str | None = None, by_template: bool = False) -> int:
    """Few files instead of many: of parts with a manifest in their place, else of Parquet files in a folder of their own."""
    if target is None:
        return parts.compact(spark, path)
    return sinks.compact_groups(spark, path, target) if by_template else sinks.compact(spark, path, target)


def load(records: DataFrame, table: str) -> None:
    sinks.load(records, table)


def report(jobs_: DataFrame, counts: DataFrame, part_rows: DataFrame) -> DataFrame:
    return stats.report(jobs_, counts, part_rows)


def rollup(jobs_: DataFrame) -> DataFrame:
    return stats.batch_rollup(jobs_)


def retry(dead: DataFrame, spec: FieldSpec, classes: list[str], templates: list[Template] = (), layout: DataFrame | None = None) -> DataFrame:
    """Dead letters of some classes, judged again, each by the layout of its source (what `parse` gives as layout), if there is one."""
    source = F.coalesce("source", "job_id") if "source" in dead.columns else F.col("job_id")
    again = sinks.reprocess(dead, classes).select(source.alias("source"), "line_no", "byte_offset", "byte_length", F.col("raw_bytes").alias("text"))
    return cl.classify(again, spec, list(templates), layout=cl.no_layout(dead.sparkSession) if layout is None else layout)


def transition(jobs_: DataFrame, job_id: str, status: str, now: dt.datetime) -> DataFrame:
    """A new snapshot of the jobs; a move that isn't allowed changes nothing."""
    move = (F.col("job_id") == job_id) & jobs.allowed_column(F.col("status"), F.lit(status))
    return jobs_.withColumns({"updated_at": F.when(move, F.lit(now).cast("timestamp")).otherwise(F.col("updated_at")), "status": F.when(move, F.lit(status)).otherwise(F.col("status"))})


def release_hold(spark: SparkSession, jobs_: DataFrame, job_id: str, stored: str, table: str, now: dt.datetime) -> DataFrame:
    """Loads the stored records of a job on hold, and moves it on."""
    if jobs_.where((F.col("job_id") == job_id) & (F.col("status") == "On Hold")).isEmpty():
        return jobs_
    load(spark.read.parquet(stored).where(F.col("_job_id") == job_id), table)
    return transition(jobs_, job_id, "Saving to Database", now)


def logs(log: DataFrame, job_id: str, offset: int = 0, limit: int = 100) -> DataFrame:
    return sinks.page(log.where(F.col("job_id") == job_id), [F.asc("at")], offset, limit)
