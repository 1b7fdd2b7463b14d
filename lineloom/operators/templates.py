"""Learned templates: rules that take fields from a line, and signatures of rubbish. Declarative, never code."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LITERAL_RUN, literal_run, safe_pattern
from ..functions.validate import field_ok
from ..ship import ship
from ..sources.lines import written
from ..spec import META, FieldSpec
from .cells import split_cells
from .mapping import KV_SEGMENT, dump, flatten, load

SCHEMA = "template_id string, fingerprint string, version int, kind string, field_map map<string,string>, structure string, delimiter string, length_hint int, signature string, confidence double, source string"
CONFIDENT = 0.9


@dataclass
class Template:
    """kind: record or rubbish. field_map: field -> index:N, key:name or regex:pattern."""

    template_id: str
    fingerprint: str
    kind: str
    version: int = 1
    field_map: dict[str, str] = field(default_factory=dict)
    structure: str = "csv"
    delimiter: str = ","
    length_hint: int = 0
    signature: str = ""
    confidence: float = 1.0
    source: str = "learned"

    def row(self) -> tuple:
        return (self.template_id, self.fingerprint, self.version, self.kind, self.field_map, self.structure, self.delimiter, self.length_hint, self.signature, self.confidence, self.source)

    @staticmethod
    def of(r) -> Template:
        return Template(r["template_id"], r["fingerprint"], r["kind"], r["version"] or 1, dict(r["field_map"] or {}), r["structure"] or "csv", r["delimiter"] or ",", r["length_hint"] or 0, r["signature"] or "", r["confidence"] or 0.0, r["source"] or "")


def _kv(line: str, delimiter: str) -> dict:
    parts = re.split(r"\s+-\s+", line) if delimiter in ("", "-") else line.split(delimiter)
    return {m[1].strip(): m[2].strip() for s in parts if (m := KV_SEGMENT.match(s))}


def extract(t: Template, line: str, spec: FieldSpec) -> tuple[dict, float] | None:
    """(row, score) by a record template; None if no field is there or all e-mails and phones are wrong.

    The score is the number of fields found, and a tenth for each that has a locator with a place in the line.
    """
    if t.length_hint and len(line) < t.length_hint:
        return None
    cells = split_cells(line, t.delimiter) if t.structure in ("csv", "fixed") else []
    if len(cells) == 1 and len(t.field_map) > 1:  # without a delimiter a line isn't of this structure
        return None
    obj: dict = {}
    if t.structure == "json":
        try:
            got = load(line)
            obj = flatten(got, set()) if isinstance(got, dict) else {}
        except ValueError:
            return None
    elif t.structure == "kv":
        obj = _kv(line, t.delimiter)
    row: dict = {}
    present, checked, wrong = 0, 0, 0
    for f in spec.wanted:
        how, _, arg = t.field_map.get(f, "").partition(":")
        v = None
        if how == "index" and arg.isdigit() and int(arg) < len(cells):
            v, present = cells[int(arg)].strip(), present + 1
        elif how == "key" and arg in obj:
            v, present = obj[arg], present + 1
        elif how == "regex" and safe_pattern(arg) and len(line) <= 65_536 and (m := re.search(arg, line)):
            v, present = (m[1] if m.re.groups else m[0]), present + 1
        row[f] = None if v is None or v == "" else v
        if row[f] is not None and spec.key[f] in ("email", "phone"):
            checked += 1
            wrong += not field_ok(spec.key[f], row[f])
    found = sum(v is not None for v in row.values())
    if not found or checked and checked == wrong:
        return None
    used = {int(v[6:]) for v in t.field_map.values() if v.startswith("index:") and v[6:].isdigit()}
    rest = {f"col_{i}": c.strip() for i, c in enumerate(cells) if i not in used and c.strip()} or {k: v for k, v in obj.items() if f"key:{k}" not in t.field_map.values()}
    row[META] = dump(rest) if rest else None
    return row, found + 0.1 * present


def best_template(templates: list[Template], line: str, spec: FieldSpec) -> tuple[Template, dict] | None:
    """The record template with the greatest score, the first of equals, by trying all."""
    best = None
    for t in templates:
        if t.kind == "record" and (got := extract(t, line, spec)) and (best is None or got[1] > best[1]):
            best = (t, got[1], got[0])
    return (best[0], best[2]) if best else None


class RecordIndex:
    """Finds what best_template finds without trying every template.

    Templates lie by structure and delimiter. What a line can give one at most follows from its number of cells: each field with a
    place in it counts once, and a tenth. The best bounds are tried first, and the search stops where no bound exceeds the best
    score, or equals it with an earlier place in the list.
    """

    def __init__(self, templates: list[Template], spec: FieldSpec):
        self.spec, self.tried = spec, 0
        self.groups: dict[tuple[str, str], list[tuple[int, Template]]] = {}
        for i, t in enumerate(templates):
            if t.kind == "record":
                celled = t.structure in ("csv", "fixed")
                self.groups.setdefault((t.delimiter, "cells") if celled else ("", t.structure), []).append((i, t))
        self.ranked: dict[tuple, list[tuple[float, int, Template]]] = {}

    def _bound(self, t: Template, cells: int) -> float:
        n = 0
        for f in self.spec.wanted:
            how, _, arg = t.field_map.get(f, "").partition(":")
            n += how in ("key", "regex") or how == "index" and arg.isdigit() and int(arg) < cells
        return n + 0.1 * n

    def _by_bound(self, group: tuple[str, str], cells: int) -> list[tuple[float, int, Template]]:
        if (group, cells) not in self.ranked:
            own = [(self._bound(t, cells), i, t) for i, t in self.groups[group] if cells != 1 or len(t.field_map) < 2]
            self.ranked[group, cells] = sorted((x for x in own if x[0]), key=lambda x: (-x[0], x[1]))
        return self.ranked[group, cells]

    def best(self, line: str) -> tuple[Template, dict] | None:
        found: tuple[float, int, Template, dict] | None = None
        begins = line.lstrip()[:1]
        for group in self.groups:
            if group[1] == "json" and begins != "{":
                continue
            cells = len(split_cells(line, group[0])) if group[1] == "cells" else 0
            for bound, i, t in self._by_bound(group, cells):
                if found and bound < found[0] - 1e-9:
                    break
                if found and bound <= found[0] + 1e-9 and i > found[1]:
                    continue
                self.tried += 1
                got = extract(t, line, self.spec)
                if got and (found is None or got[1] > found[0] or got[1] == found[0] and i < found[1]):
                    found = (got[1], i, t, got[0])
        return (found[2], found[3]) if found else None


def trusted(t: Template) -> bool:
    """Whether a signature may call lines rubbish."""
    return t.kind == "rubbish" and t.confidence >= CONFIDENT and literal_run(t.signature) >= LITERAL_RUN and safe_pattern(t.signature)


def rubbish_template(templates: list[Template], line: str) -> Template | None:
    """The first signature that matches and may be trusted, by trying all."""
    for t in templates:
        if trusted(t) and len(line) <= MOST_TEXT and re.search(t.signature, line):
            return t
    return None


MOST_TEXT = 65_536


def required_runs(pattern: str) -> list[str]:
    """Runs of plain characters that every match of a pattern holds; none where that isn't plain to see."""
    if re.search(r"\(\?[a-zA-Z]*[a-zA-Z)]|\\[xuUN0-9]", pattern):
        return []
    runs, run, depth, i = [], "", 0, 0
    while i < len(pattern):
        c, plain = pattern[i], None
        if c == "\\":
            nxt = pattern[i + 1 : i + 2]
            plain = nxt if nxt and not nxt.isalnum() else None
            i += 2
        elif c == "[":
            end = pattern.find("]", i + (3 if pattern[i + 1 : i + 2] == "^" else 2))
            i = len(pattern) if end < 0 else end + 1
        elif c == "|" and depth == 0:
            return []
        else:
            depth += (c == "(") - (c == ")")
            plain = c if c not in ".^$*+?{}()|]" else None
            i += 1
            if c == "{":
                i = max(i, pattern.find("}", i) + 1)
        after = pattern[i : i + 1]
        if plain is not None and depth == 0 and after not in ("*", "?", "{"):
            run += plain
            if after != "+":
                continue
        runs.append(run)
        run = ""
    return [r for r in [*runs, run] if len(r) >= LITERAL_RUN]


def grams(pattern: str) -> list[str]:
    return sorted({r[k : k + LITERAL_RUN] for r in required_runs(pattern) for k in range(len(r) - LITERAL_RUN + 1)})


class RubbishIndex:
    """Finds what rubbish_template finds: a signature is tried on lines that hold its rarest gram of six characters."""

    def __init__(self, templates: list[Template]):
        own = [(i, t, grams(t.signature)) for i, t in enumerate(templates) if trusted(t)]
        shared = Counter(g for *_, gs in own for g in gs)
        self.by_gram: dict[str, list[tuple[int, Template]]] = {}
        self.rest = [(i, t) for i, t, gs in own if not gs]
        for i, t, gs in own:
            if gs:
                self.by_gram.setdefault(min(gs, key=lambda g: (shared[g], g)), []).append((i, t))

    def first(self, line: str) -> Template | None:
        if len(line) > MOST_TEXT:
            return None
        near = list(self.rest)
        if self.by_gram:
            for g in {line[k : k + LITERAL_RUN] for k in range(len(line) - LITERAL_RUN + 1)} & self.by_gram.keys():
                near += self.by_gram[g]
        return next((t for _, t in sorted(near, key=lambda x: x[0]) if re.search(t.signature, line)), None)


#: Lengths in bytes of what signatures and lines meet by; the longest that a run of plain bytes holds is taken.
_SIZES = (LITERAL_RUN, 8, 12, 16, 24, 32)
#: Bits of an index into the counters of grams, and the least and the most into the bit map.
_COUNTERS, _LEAST_BITS, _MOST_BITS = 20, 20, 27
#: Bytes of text whose grams are looked up at once.
_AT_ONCE = 1 << 20


def long_grams(pattern: str) -> list[bytes]:
    """Stretches of plain bytes that every match holds. Any six bytes of a run in a row lie in one of them, so the rarest stretch is no
    more frequent than the rarest six bytes."""
    out = set()
    for r in required_runs(pattern):
        raw = r.encode()
        size = max(s for s in _SIZES if s <= len(raw))
        out |= {raw[k : k + size] for k in (*range(0, len(raw) - size, size // 2), len(raw) - size)}
    return sorted(out)


def _gram_hashes(raw: bytes, sizes: list[int]) -> Iterator[np.ndarray]:
    """For each of the sizes, which rise, a 64-bit hash of every so many bytes in a row."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    h = np.zeros(len(x) + 1, np.uint64)
    for k in range(max(sizes, default=0)):
        h = h[: max(0, len(x) - k)]
        h = (h + x[k:] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if k + 1 in sizes:
            yield h


def _bits_of(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a bit map of 2 ** bits."""
    return h >> np.uint64(64 - bits), (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)


def _bit_map(grams: DataFrame, bits: int) -> np.ndarray:
    """A bit map of grams; tasks give its words, the driver gets it put together."""

    def run(batches):
        for b in batches:
            at = np.concatenate(_bits_of(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["w", "b"])

    words = grams.mapInArrow(run, "w int, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return out


def match_rubbish(lines: DataFrame, templates: DataFrame, order: str = "template_id", key: list[str] | None = None, text: str = "text") -> DataFrame:
    """Lines with the first rubbish template, by `order`, that may be trusted and whose signature they match, or null.

    Lines and signatures meet by an equal join on grams of up to 32 bytes: a signature's rarest one must be in a line that it matches. How
    rare grams are is told by a fixed number of counters. Of a line's grams only those go on that a bit map of all signatures' grams lets
    through; it has 16 bits a signature, but at most 16 MB. Patterns that may match without a plain run of six are joined to all lines;
    where there are none, nothing is.
    """
    key = key or ["source", "line_no"]
    spark = lines.sparkSession
    ship(spark)
    known = templates.where((F.col("kind") == "rubbish") & (F.col("confidence") >= CONFIDENT)).select(F.col(order).cast("string").alias("_order"), F.col("template_id").alias("rubbish_id"), F.col("signature").alias("_signature"))
    known = known.repartition(spark.sparkContext.defaultParallelism)  # patterns cost more than their bytes tell
    grams_of = pa.list_(pa.struct([("size", pa.int32()), ("gram", pa.int64())]))

    def indexed(batches):
        for b in batches:
            rows = []
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[2] and literal_run(r[2]) >= LITERAL_RUN and safe_pattern(r[2]):
                    rows.append((*r, [{"size": len(g), "gram": int(next(_gram_hashes(g, [len(g)]))[0].view(np.int64))} for g in long_grams(r[2])]))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols[:3]], pa.array(cols[3], grams_of)], names=["_order", "rubbish_id", "_signature", "_grams"])

    known = written(known.mapInArrow(indexed, "_order string, rubbish_id string, _signature string, _grams array<struct<size:int,gram:long>>"))
    counted = known.select(F.explode("_grams.gram").alias("g")).groupBy(F.shiftrightunsigned("g", 64 - _COUNTERS).cast("int").alias("g")).agg(F.count("*").alias("n")).toArrow()
    counters = np.zeros(1 << _COUNTERS, np.int64)
    counters[counted["g"].to_numpy()] = counted["n"].to_numpy()

    def rarest_of(batches):
        for b in batches:
            best = [min(gs, key=lambda x: (counters[(x["gram"] & 0xFFFFFFFFFFFFFFFF) >> 64 - _COUNTERS], -x["size"], x["gram"])) for gs in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([x["size"] for x in best], pa.int32()), pa.array([x["gram"] for x in best], pa.int64())], names=["_order", "rubbish_id", "_signature", "_size", "_gram"])

    rarest = written(known.where(F.size("_grams") > 0).mapInArrow(rarest_of, "_order string, rubbish_id string, _signature string, _size int, _gram long"))
    found_sizes = rarest.groupBy("_size").agg(F.count("*").alias("n")).collect()
    sizes = sorted(r["_size"] for r in found_sizes)
    bits = min(_MOST_BITS, max(_LEAST_BITS, (16 * sum(r["n"] for r in found_sizes)).bit_length()))
    bit_map = _bit_map(rarest.select("_gram"), bits)
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema.fields}

    def lit(h: np.ndarray) -> np.ndarray:
        """Where the first bit is set, and then the second one too."""
        at = np.arange(len(h))
        for k in range(2):
            place = _bits_of(h[at], bits)[k]
            at = at[(bit_map[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return at

    def hits(batches):
        for whole in batches:
            ends = np.cumsum([len((x or "").encode()) for x in whole.column(len(key)).to_pylist()], dtype=np.int64)
            last = int(ends[-1]) if len(ends) else 0
            cuts = np.unique([0, *(np.searchsorted(ends, np.arange(_AT_ONCE, last, _AT_ONCE)) + 1), whole.num_rows])
            for a, z in zip(cuts, cuts[1:], strict=False):
                b = whole.slice(a, z - a)
                raws = [(x or "").encode() for x in b.column(len(key)).to_pylist()]
                own = np.cumsum([len(r) for r in raws])
                pairs = [np.empty((0, 2), np.int64)]
                for size, h in zip(sizes, _gram_hashes(b"".join(raws), sizes), strict=True):
                    at = lit(h)
                    row = np.searchsorted(own, at, side="right")
                    inside = at + size <= own[row]
                    pairs.append(np.stack([row[inside].astype(np.int64), h[at[inside]].view(np.int64)], 1))
                pairs = np.unique(np.concatenate(pairs), axis=0)
                took = b.take(pa.array(pairs[:, 0]))
                yield pa.RecordBatch.from_arrays([*took.columns, pa.array(pairs[:, 1])], names=[*b.schema.names, "_gram"])

    near = lines.select(*key, text).where(F.length(text) <= MOST_TEXT)
    found = near.mapInArrow(hits, ", ".join(f"`{c}` {kinds[c]}" for c in [*key, text]) + ", _gram long").join(rarest, "_gram").where(F.expr(f"`{text}` rlike _signature")).select(*key, "rubbish_id", "_order")
    rest = known.where(F.size("_grams") == 0)
    if not rest.isEmpty():
        found = found.unionByName(near.join(rest, F.expr(f"`{text}` rlike _signature")).select(*key, "rubbish_id", "_order"))
    first = found.groupBy(*key).agg(F.min_by("rubbish_id", "_order").alias("rubbish_id"))
    return lines.join(first, key, "left")


def rank_templates(scored: DataFrame, key: list[str], score: str, order: str) -> DataFrame:
    """The best of each line's templates; ties go to the first."""
    w = Window.partitionBy(*key).orderBy(F.desc(score), F.asc(order))
    return scored.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Templates by fingerprint: a new one keeps the known id and raises the version."""
    was = old.select("fingerprint", F.col("template_id").alias("_id"), F.col("version").alias("_version"))
    raised = new.join(was, "fingerprint", "left").withColumns({"template_id": F.coalesce("_id", "template_id"), "version": (F.coalesce("_version", F.lit(0)) + 1).cast("int")})
    both = old.unionByName(raised.select(old.columns))
    return both.groupBy("fingerprint").agg(F.max_by(F.struct(*old.columns), "version").alias("t")).select("t.*")


# -- teacher ----------------------------------------------------------------------------------------------------------

#: A teacher gets a line and the fields and gives a template, or None if it doesn't know.
Teacher = Callable[[str, FieldSpec], Template | None]
_LOG_LEVEL = re.compile(r"^(ERROR|WARNING|DEBUG|INFO|TRACE)")


def line_id(line: str) -> str:
    return hashlib.sha256(line.strip().lower().encode()).hexdigest()[:24]


def offline_teacher(line: str, spec: FieldSpec) -> Template | None:
    """The teacher that needs no model: lines of log levels are rubbish, three cells or more are fields by position."""
    if _LOG_LEVEL.match(line):
        return Template(f"rubbish-{line_id(line)}", line_id(line), "rubbish", signature=r"^(ERROR|WARNING|DEBUG|INFO|TRACE)", confidence=0.95, source="offline")
    cells = [c for c in split_cells(line, ",")]
    if len(cells) >= 3:
        places = {f: f"index:{i}" for i, f in enumerate(spec.wanted) if i < len(cells)}
        return Template(f"record-{line_id(line)}", line_id(line), "record", field_map=places, source="offline")
    return None


def learn(unknown: DataFrame, spec: FieldSpec, teacher: Teacher = offline_teacher, budget: int = 10, text: str = "text") -> list[Template]:
    """Templates for the most frequent unknown structures; the teacher is asked at most `budget` times."""
    from .detect import quick_fingerprint

    ask = unknown.groupBy(quick_fingerprint(F.col(text)).alias("fingerprint")).agg(F.count("*").alias("n"), F.min(text).alias("sample")).orderBy(F.desc("n"), "fingerprint").limit(budget).collect()
    out = []
    for r in ask:
        t = teacher(r["sample"], spec)
        if t and (t.kind == "record" or safe_pattern(t.signature)):
            t.fingerprint = r["fingerprint"]
            out.append(t)
    return out
