"""What a source looks like: probes, fingerprints, header and layout."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_key as native_key
from ..functions.validate import BLANKS, HEADER_LABEL, trim
from ..spec import DENIED, META, FieldSpec, normalize_key
from .cells import best_cells, best_delimiter, bound
from .mapping import Mapper

# Probing.
MIN_WINDOW, MAX_WINDOW, ROWS_PER_WINDOW, WIDEST = 64 << 10, 1 << 20, 150, 4
BYTES_PER_PROBE, FEWEST, MOST = 512 << 20, 5, 24
DEFAULT_AVERAGE, DEFAULT_MAX = 256, 512


# -- probes and widths ------------------------------------------------------------------------------------------------


def row_width(lines: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """Average and greatest number of bytes of lines that aren't blank."""
    n = F.when(trim(F.col(text)) != "", F.octet_length(text))
    return lines.groupBy(*by).agg(F.coalesce(F.avg(n), F.lit(float(DEFAULT_AVERAGE))).alias("avg_bytes"), F.coalesce(F.max(n), F.lit(DEFAULT_MAX)).cast("long").alias("max_bytes"))


def window_size(average: Column, most: Column) -> Column:
    """Bytes to read at each probe."""
    return F.least(F.lit(MAX_WINDOW).cast("double"), F.greatest(F.lit(MIN_WINDOW).cast("double"), average * ROWS_PER_WINDOW, most.cast("double") * WIDEST)).cast("long")


def probe_offsets(size: Column, window: Column) -> Column:
    """Where to probe: evenly, with head and tail; a source no longer than a window is probed once."""
    n = F.least(F.lit(MOST), F.greatest(F.lit(FEWEST), F.floor(size / BYTES_PER_PROBE).cast("int")))
    last = size - window
    spread = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.floor(last * i / (n - 1)).cast("long"))
    return F.when(size <= window, F.array(F.lit(0).cast("long"))).otherwise(F.array_sort(F.array_distinct(spread)))


# -- fingerprints -----------------------------------------------------------------------------------------------------


def json_keys(text: Column) -> Column:
    """The sorted keys of an object, joined; null for what isn't one."""
    keys = F.json_object_keys(text)
    return F.when(F.startswith(text, F.lit("{")) & F.try_parse_json(text).isNotNull(), F.array_join(F.array_sort(keys), ","))


def fingerprint(text: Column, encoding: Column | None = None) -> Column:
    """The structure of a line, hashed: csv by its first delimiter and number of cells, json by its keys, text by its length, or empty."""
    enc = F.lit("utf-8") if encoding is None else encoding
    forms = [F.when(F.contains(text, F.lit(d)), F.concat_ws("|", F.lit("csv"), F.lit(d), F.size(F.split(text, f"[{d}]" if d != "\t" else d, -1)).cast("string"), enc)) for d in (",", ";", "\t", "|")]
    keys = json_keys(trim(text))
    form = F.coalesce(*forms, F.when(keys.isNotNull(), F.concat_ws("|", F.lit("json"), keys)), F.concat_ws("|", F.lit("text"), F.length(text).cast("string"), enc))
    return F.substring(F.sha2(F.when(trim(text) == "", "empty").otherwise(form), 256), 1, 24)


def quick_fingerprint(text: Column) -> Column:
    """The structure of a line, as text: json first, then the first delimiter that gives three cells."""
    t = trim(text)
    forms = [F.when(F.size(F.split(t, f"[{d}]" if d != "\t" else d, -1)) >= 3, F.concat_ws("|", F.lit("csv"), F.lit(d), F.size(F.split(t, f"[{d}]" if d != "\t" else d, -1)).cast("string"))) for d in (",", ";", "\t", "|", ":")]
    return F.when(t == "", F.lit("empty")).otherwise(F.coalesce(F.when(json_keys(t).isNotNull(), F.concat_ws("|", F.lit("json"), json_keys(t))), *forms, F.concat_ws("|", F.lit("text"), F.length(t).cast("string"))))


def line_hash(text: Column) -> Column:
    """A line regardless of case and outer blanks."""
    return F.sha2(F.lower(trim(text)), 256)


def distinct_structures(lines: DataFrame, known: DataFrame | None = None, text: str = "text") -> DataFrame:
    """One sample line per fingerprint, with the template that is known for it, the most frequent first."""
    own = lines.withColumn("fingerprint", fingerprint(F.col(text)))
    found = own.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min(text).alias("sample"))
    return found.join(known.select("fingerprint", "template_id"), "fingerprint", "left") if known is not None else found.withColumn("template_id", F.lit(None).cast("string"))


# -- headers ----------------------------------------------------------------------------------------------------------

_LABEL = re.compile(r"^[^\W\d][\w .,\-]*$")


def is_label(cell: str) -> bool:
    """Letters, digits, blanks and a few marks, starting with a letter or underscore; few digits, no @."""
    if "@" in cell or sum(c.isdigit() for c in cell) >= 7 or not cell:
        return False
    return bool(_LABEL.match(cell)) and all(c in " _.,-" or unicodedata.category(c)[0] in "LN" for c in cell)


def _braced(cell: str) -> bool:
    return len(cell) > 1 and cell[0] == "{" and cell[-1] == "}"


@dataclass
class Layout:
    """What a source's head line tells: labels, delimiter, and the places of the wanted fields."""

    labels: list[str]
    delimiter: str | None
    places: dict[str, list[int]] = field(default_factory=dict)
    in_file: bool = True


def header_places(cells: list[str], spec: FieldSpec) -> dict[str, list[int]] | None:
    """The places of the fields if the cells are labels and stand for at least half of the fields."""
    if any(c and not _braced(c) and not is_label(c) for c in (x.strip() for x in cells)):
        return None
    places: dict[str, list[int]] = {}
    for f in spec.wanted:
        at = [i for i, c in enumerate(cells) if spec.matches(c.strip(), f)]
        parts = spec.parts.get(spec.key[f], ())
        if len(parts) > 1 and len(at) < len(parts):
            own = {n: i for i, c in reversed(list(enumerate(cells))) if (n := normalize_key(c)) in parts}
            at = [own[p] for p in sorted(own, key=own.get)] if len(own) > 1 else at
        if at:
            places[f] = at
    if len(places) < max(1, len(spec.wanted) // 2):
        return None
    if META in spec.fields and (m := next((i for i, c in enumerate(cells) if _braced(c.strip())), None)) is not None:
        places[META] = [m]
    return places


_SPLIT_LABEL = re.compile(r"(?:\s*_\s*or\s*_\s*|\s+or\s+|[/,;])+", re.I)


def widened(layout: Layout, spec: FieldSpec) -> Layout:
    """Labels of several words that are still free may stand for fields without a place."""
    used = {i for at in layout.places.values() for i in at}
    for i, label in enumerate(layout.labels):
        raw = label.strip().lower()
        if i in used or not raw or raw == META or raw.startswith("col_"):
            continue
        tokens = [t.strip() for t in _SPLIT_LABEL.split(raw) if len(t.strip()) > 1]
        f = next((f for f in spec.wanted if f not in layout.places and any(normalize_key(t) in spec.synonyms[spec.key[f]] for t in tokens)), None)
        if f:
            layout.places[f] = [i]
    return layout


def layout_of(line: str, spec: FieldSpec) -> Layout | None:
    """The layout that a first line gives, if it is a header."""
    t = line.strip()
    if t[:1] in ("{", "[") or not spec.wanted or Mapper(spec).from_kv(line) is not None:
        return None
    got = best_cells(line)
    if not got or (places := header_places(got[0], spec)) is None:
        return None
    return widened(Layout([c.strip() for c in got[0]], got[1], places), spec)


def given_layout(headers: list[str], spec: FieldSpec) -> Layout:
    """The layout of headers that the caller states."""
    places = header_places(headers, spec) or {}
    return widened(Layout([h.strip() for h in headers], None, places, in_file=False), spec)


def repeats_header(cells: list[str], labels: list[str]) -> bool:
    pairs = [(c, h) for c, h in zip(cells, labels) if h.strip()]  # noqa: B905
    same = sum(normalize_key(c.strip()) == normalize_key(h) for c, h in pairs)
    return len(pairs) >= 2 and same >= max(2, -(-len(pairs) // 2))


def denied(label: Column) -> Column:
    """Native: whether a guessed mapping never uses a column of this label."""
    return label.rlike("(?iu)" + "|".join(DENIED))


def header_labels(line: Column) -> Column:
    """Native: the cells of a line if all of them look like labels, else null."""
    label = lambda c: (c == "") | (c.rlike(HEADER_LABEL) & ~F.contains(c, F.lit("@")) & (F.length(F.regexp_replace(c, "[^0-9]", "")) < 7))
    return bound(best_delimiter(line)["cells"], lambda cells: F.when(F.forall(cells, label), cells))


def header_union(objects: DataFrame, order: list[str], by: list[str], text: str = "text") -> DataFrame:
    """Keys of JSON lines per source, in order of first appearance."""
    keys = objects.select(*by, F.struct(*order).alias("_at"), F.posexplode(F.json_object_keys(text)).alias("_pos", "label"))
    first = keys.groupBy(*by, "label").agg(F.min(F.struct("_at", "_pos")).alias("first"))
    return first.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "label"))), lambda x: x["label"]).alias("headers"))


def same_label(a: Column, b: Column) -> Column:
    return native_key(a) == native_key(b)


__all__ = ["BLANKS", "Layout", "distinct_structures", "fingerprint", "given_layout", "header_labels", "header_places", "header_union", "layout_of", "line_hash", "probe_offsets", "quick_fingerprint", "repeats_header", "row_width", "same_label", "widened", "window_size"]
