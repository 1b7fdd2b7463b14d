"""Templates kept between jobs: made from a teacher's answer, and found again by the structure of a line."""

from __future__ import annotations

import json
import re
import time
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LITERAL_RUN, literal_run, object_in, safe_pattern
from ..ship import ship
from ..spec import FieldSpec
from .classify import RESULT, Judge, verdict_arrays, with_known
from .detect import line_hash, quick_fingerprint
from .templates import CONFIDENT, Teacher, Template, extract, line_id

# Delimiters of a template by position, and the teacher's limits.
DELIMITERS = (",", ";", "\t", "|")
A_MINUTE, BURST, WITHIN = 60, 10, 60.0


# -- what a teacher's answer becomes ----------------------------------------------------------------------------------


def by_position(line: str, spec: FieldSpec) -> Template | None:
    """A template by position, if a delimiter gives a cell for each field and none is blank. No teacher is needed for it."""
    for d in DELIMITERS:
        cells = line.split(d)
        if len(cells) == len(spec.fields) and all(c.strip() for c in cells):
            return Template(f"record-{line_id(line)}", line_id(line), "record", field_map={f: f"index:{i}" for i, f in enumerate(spec.fields)}, delimiter=d, length_hint=len(line))
    return None


def nearest(name: str, keys: list[str]) -> str | None:
    """The key that a name stands for: the same without case, else one that holds it or that it holds."""
    low = name.lower()
    equal = [k for k in keys if k.lower() == low]
    return next(iter(equal + [k for k in keys if low in k.lower() or k.lower() in low]), None)


def _place(how, field: str, keys: list[str]) -> str:
    """A locator as text; names and numbers are mended by the keys of the line's object, if it is one."""
    if isinstance(how, str):
        return how
    if not isinstance(how, dict):
        return ""
    if isinstance(how.get("locator"), str):
        return how["locator"]
    if isinstance(how.get("key"), str):
        return f"key:{nearest(how['key'], keys) or how['key']}"
    if isinstance(how.get("index"), int):
        at = how["index"]
        key = nearest(field, keys) or (keys[at] if 0 <= at < len(keys) else None)
        return f"key:{key}" if key else f"index:{at}"
    return f"regex:{how['regex']}" if isinstance(how.get("regex"), str) else ""


def tightened(signature: str, line: str) -> str:
    """A signature that is specific and matches its own line stays; else the line itself, literally, takes its place."""
    good = signature and literal_run(signature) >= LITERAL_RUN and safe_pattern(signature) and re.search(signature, line)
    return signature if good else re.escape(line)


def from_answer(answer: dict | str, line: str) -> Template | None:
    """The template of a teacher's answer {kind: record-template or rubbish-signature, template: {...}}, or of text that holds one; None if it has none."""
    if isinstance(answer, str) and (answer := object_in(answer)) is None:
        return None
    body = answer.get("template")
    if not isinstance(body, dict):
        return None
    if answer.get("kind") != "record-template":
        sure = body.get("confidence")
        return Template(f"rubbish-{line_id(line)}", line_id(line), "rubbish", signature=tightened(str(body.get("signature") or ""), line), confidence=1.0 if sure is None else float(sure))
    if not isinstance(body.get("field_map"), dict):
        return None
    try:
        got = json.loads(line)
    except ValueError:
        got = None
    keys = list(got) if isinstance(got, dict) else []
    structure = "json" if isinstance(got, dict) else str(body.get("structure") or "csv")
    hint = body.get("length_hint")
    places = {f: _place(how, f, keys) for f, how in body["field_map"].items()}
    return Template(f"record-{line_id(line)}", line_id(line), "record", field_map=places, structure=structure, delimiter=body.get("delimiter") or ",", length_hint=len(line) if hint is None else int(hint))


class Limiter:
    """Lets a caller go on at most min(a minute's limit, burst) times in any minute, and waits otherwise."""

    def __init__(self, a_minute: int = A_MINUTE, burst: int = BURST, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.most, self.clock, self.sleep, self.at = max(1, min(a_minute, burst)), clock, sleep, deque()

    def acquire(self) -> None:
        if len(self.at) >= self.most:
            wait = self.at.popleft() + WITHIN - self.clock()
            if wait > 0:
                self.sleep(wait)
        self.at.append(self.clock())


def asked(ask: Callable[[str, FieldSpec], dict | str | None], limiter: Limiter | None = None) -> Teacher:
    """A teacher from a function that gives answers: what goes by position isn't asked for, all else within the limiter's pace."""
    limiter = limiter or Limiter()

    def teach(line: str, spec: FieldSpec) -> Template | None:
        if known := by_position(line, spec):
            return known
        limiter.acquire()
        answer = ask(line, spec)
        return from_answer(answer, line) if answer else None

    return teach


# -- the registry -----------------------------------------------------------------------------------------------------


def latest(registry: DataFrame, kind: str = "record") -> DataFrame:
    """One template per fingerprint: of the greatest version, and of equals the one with the least id."""
    own = registry.where(F.col("kind") == kind)
    order = F.struct(-F.coalesce("version", F.lit(1)), "template_id")
    return own.groupBy("fingerprint").agg(F.min_by(F.struct(*own.columns), order).alias("t")).select("t.*")


def by_fingerprint(lines: DataFrame, registry: DataFrame, spec: FieldSpec) -> DataFrame:
    """lines (source, line_no, text, ...) with the verdicts that kept record templates give; the others are uncertain.

    A line meets the template of its own structure by an equal join: few templates are sent around, more are joined with lines that
    are dealt out by number, so a structure that many lines share isn't one task. Null texts have no structure.
    """
    ship(lines.sparkSession)
    keep = lines.columns
    known = latest(registry).select("fingerprint", F.to_json(F.struct("*")).alias("_template"))
    met = with_known(lines.withColumn("fingerprint", F.when(F.col("text").isNotNull(), quick_fingerprint(F.col("text")))), known, "fingerprint")
    open_ = ("uncertain", None, None, "uncertain", None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, seen = Judge(spec), {}
        for b in batches:
            got = []
            for line, row in zip(b.column("text").to_pylist(), b.column("_template").to_pylist(), strict=True):
                if row not in seen:
                    seen[row] = Template.of(dict.fromkeys(Template.__dataclass_fields__) | json.loads(row))
                t = seen[row]
                try:
                    found = extract(t, line, spec)
                    got.append(judge._row(found[0], t.template_id, t.version) if found else open_)
                except Exception as e:  # one bad line must not lose the others: it becomes a dead letter
                    got.append(("uncertain", None, None, f"transform_error: {type(e).__name__}", None))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], *verdict_arrays(got)], names=[*keep, *RESULT.fieldNames()])

    taken = met.where("_template IS NOT NULL").select(*keep, "_template").mapInArrow(run, T.StructType([*lines.schema.fields, *RESULT.fields]))
    none = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(open_, RESULT.fields, strict=True)]
    return taken.unionByName(met.where("_template IS NULL").select(*keep, *none))


def by_line(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Native: lines with template_id and kind of what is kept for just this line, regardless of case and outer blanks; else null.

    The registry's fingerprint is the hash of the line. Rubbish counts above CONFIDENT only; a record template goes before it.
    """
    sure = registry.where((F.col("kind") == "record") | (F.col("confidence") > CONFIDENT))
    order = F.struct("kind", -F.coalesce("version", F.lit(1)), "template_id")
    known = sure.groupBy("fingerprint").agg(F.min_by(F.struct("template_id", "kind"), order).alias("_kept")).select("fingerprint", "_kept.*")
    return with_known(lines.withColumn("fingerprint", line_hash(F.col("text"))), known, "fingerprint").drop("fingerprint")
