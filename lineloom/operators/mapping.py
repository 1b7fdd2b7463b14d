"""From objects and cells to the wanted fields. Plain Python for one line; `classify` runs it over Arrow batches."""

from __future__ import annotations

import json
import re

from ..functions.validate import field_ok, is_zip, mostly_binary, weak_text
from ..spec import META, FieldSpec, normalize_key

KV_SEGMENT = re.compile(r"^\s*([A-Za-z][A-Za-z0-9 _]*?)\s*:\s*(.*)$")
STRONG_LABELS = ("email", "mail", "name", "phone", "mobile", "tel")
#: Labels that stand for abilities; an array under one may fill a field under another.
ABILITIES = {"expertise", "skills", "skill", "competences", "competencies", "competency", "proficiencies", "proficiency", "abilities", "ability", "capability", "capabilities"}
_LOOSE = re.compile(r'"([^"\\]+)"\s*:\s*(?:"((?:[^"\\]|\\.)*)"|(true|false)|(-?\d+(?:\.\d+)?))')


class _Number(str):
    """A number's own text: no digit of it is lost."""


def _plain(x: str):
    return int(x) if len(x) < 16 else _Number(x)


def load(text: str):
    """JSON with long integers kept as text."""
    return json.loads(text, parse_int=_plain)


def dump(value) -> str:
    def number(x):
        if isinstance(x, float) and x.is_integer() and abs(x) < 1e15:
            return int(x)
        if isinstance(x, dict):
            return {k: number(v) for k, v in x.items()}
        return [number(v) for v in x] if isinstance(x, list) else x

    return json.dumps(number(value), ensure_ascii=False, separators=(",", ":"))


def loose_pairs(text: str) -> dict:
    """The pairs of a broken object that can be read; the first of equal keys counts."""
    out = {}
    for key, s, flag, number in _LOOSE.findall(text):
        if key not in out:
            out[key] = flag == "true" if flag else load(number) if number else s
    return out


def unquoted(text: str) -> str:
    """What is within a JSON string, or within one in it; other text as it is."""
    t = text.strip()
    for _ in range(3):
        if len(t) < 2 or t[0] != '"' or t[-1] != '"':
            break
        try:
            t = json.loads(t).strip()
        except ValueError:
            break
    return t


def read_object(text: str) -> dict | None:
    """An object, the first object of an array, or what can be read of a broken object; also within a JSON string."""
    t = unquoted(text)
    if t[:1] not in ("{", "["):
        return None
    try:
        got = load(t)
    except (ValueError, RecursionError):
        return (loose_pairs(t) or None) if t[0] == "{" else None
    if isinstance(got, list):
        return next((x for x in got if isinstance(x, dict)), None)
    return got if isinstance(got, dict) else None


def _objects(v) -> bool:
    return isinstance(v, list) and bool(v) and all(isinstance(x, dict) for x in v)


def flatten(obj: dict, keep: set[str], prefix: str = "", depth: int = 0) -> dict:
    """Dotted and [i] paths. What is under a wanted key stays whole; JSON within strings is opened."""
    out: dict = {}
    for k, v in obj.items():
        key = f"{prefix}.{k}" if prefix else k
        if isinstance(v, str) and not isinstance(v, _Number):
            t = v.strip()
            if len(t) > 1 and t[0] == t[-1] == '"':
                try:
                    inner = json.loads(t)
                    v = inner if isinstance(inner, str) else v
                    t = v.strip()
                except ValueError:
                    pass
            if t[:1] in ("{", "[") and key != META and depth < 32:
                try:
                    opened = load(t)
                    v = opened if isinstance(opened, (dict, list)) else v
                except (ValueError, RecursionError):
                    pass
            if isinstance(v, dict):  # opened objects are never kept whole
                out |= flatten(v, keep, key, depth + 1) or {key: {}}
                continue
        whole = normalize_key(key) in keep
        if isinstance(v, dict) and not whole and depth < 32:
            out |= flatten(v, keep, key, depth + 1) or {key: {}}
        elif _objects(v) and not whole and depth < 32:
            for i, x in enumerate(v):
                out |= flatten(x, keep, f"{key}[{i}]", depth + 1)
        else:
            out[key] = v
    return out


def _blank(v) -> bool:
    return v is None or (len(v) == 0 if isinstance(v, (dict, list)) else str(v).strip() == "")


def join_scalars(values: list) -> str:
    return "; ".join(s for x in values if x is not None and (s := _text(x).strip()))


def _text(v) -> str:
    if isinstance(v, str):
        return v
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v) if isinstance(v, int) else dump(v)


class _Source:
    """A flat object by normalised key; a dotted key is also known by its last part."""

    def __init__(self, flat: dict):
        self.flat = flat
        self.by_key: dict[str, object] = {}
        self.full: dict[str, str] = {}
        self.used: set[str] = set()
        for k, v in flat.items():
            n = normalize_key(k)
            self.by_key.setdefault(n, v)
            if "." in k and (leaf := normalize_key(k.rpartition(".")[2])) not in self.by_key:
                self.by_key[leaf] = v
                self.full[leaf] = n

    def free(self, key: str) -> bool:
        return key in self.by_key and key not in self.used and self.full.get(key) not in self.used

    def use(self, key: str) -> None:
        self.used.add(key)
        if key in self.full:
            self.used.add(self.full[key])

    def search(self, words: list[str], key: str):
        """A value whose path has a wanted word; strings and valid ones first, nothing if two are as good."""
        part = key not in ("name", "address", "location")
        best, ties = (-1, None, None), 0
        for k, v in self.flat.items():
            n = normalize_key(k)
            if v is None or v == "" or n in self.used:
                continue
            segments = {normalize_key(s) for s in re.split(r"[.\[\]]+", k) if s}
            near = any(w in segments or len(w) > 1 and n.startswith(w) or part and len(w) > 2 and w in n for w in words)
            if not near or not _text(v).strip():
                continue
            score = 10 * isinstance(v, str) + field_ok(key, v)
            if score > best[0]:
                best, ties = (score, n, v), 1
            elif score == best[0]:
                ties += 1
        return (best[1], best[2]) if ties == 1 else None


def _array_target(key: str, spec: FieldSpec, row: dict) -> str | None:
    """The empty field that suits a left-over array's label best."""
    n = normalize_key(key)
    best, score = None, 29
    for f in spec.wanted if n else []:
        if not _blank(row.get(f)):
            continue
        if spec.matches(key, f):
            return f
        k = spec.key[f]
        if n == k:
            s = 100
        elif n in ABILITIES and k in ABILITIES:
            s = 90
        elif k and (k in n or n in k):
            s = 60
        else:
            same = next((i for i, (a, b) in enumerate(zip(n, k)) if a != b), min(len(n), len(k)))  # noqa: B905
            s = 50 * same // max(len(n), len(k)) if same >= 4 else 0
        if s > score:
            best, score = f, s
    return best


class Mapper:
    """Fills the fields of a spec."""

    def __init__(self, spec: FieldSpec):
        self.spec = spec
        self.keep = set(spec.key.values())

    def strong(self, f: str, v) -> bool:
        k = self.spec.key[f]
        return ("email" in k or "phone" in k) and field_ok(k, v)

    def from_object(self, obj: dict, loose: bool = False) -> tuple[dict, bool] | None:
        """(row, whether it is ambiguous), or None if too few fields are met."""
        spec = self.spec
        src = _Source(flatten(obj, self.keep))
        row: dict = {}
        matched = strong = 0
        for f in spec.wanted:
            k = spec.key[f]
            words = [k, *(w for w in spec.synonyms[k] if w != k)]
            at = next((w for w in words if src.free(w)), None)
            v = src.by_key[at] if at is not None else None
            if at is None and (found := src.search(words, k)):
                at, v = found
            if k in spec.parts:
                have = [(p, x.strip()) for p in spec.parts[k] if isinstance(x := src.by_key.get(p), str) and x.strip()]
                now = normalize_key(v) if isinstance(v, str) else ""
                if len(have) > 1 and not (now and all(normalize_key(x) in now for _, x in have)):
                    v, at = " ".join(x for _, x in have), "+".join(p for p, _ in have)
                    src.used.update(p for p, _ in have)
            if at is not None:
                src.use(at)
            if _blank(v):
                row[f] = None
                continue
            row[f] = (join_scalars(v) or None) if isinstance(v, list) and not _objects(v) else v
            matched += 1
            strong += self.strong(f, row[f])
        meta = src.flat.get(META)
        if isinstance(meta, str) and meta.startswith("{"):
            try:
                inner = {normalize_key(k): v for k, v in load(meta).items()}
            except (ValueError, AttributeError):
                inner = {}
            for f in spec.wanted:
                k = spec.key[f]
                if _blank(row[f]) and k in inner:
                    src.used.add(k)
                    if not _blank(inner[k]):
                        row[f] = inner[k]
                        matched += 1
                        strong += self.strong(f, inner[k])
        for k, v in src.flat.items():
            n = normalize_key(k)
            if n not in src.used and isinstance(v, list) and (s := join_scalars(v)) and (f := _array_target(k, spec, row)):
                row[f] = s
                src.used.add(n)
        rest = {k: v.strip() if isinstance(v, str) else v for k, v in src.flat.items() if normalize_key(k) not in src.used}
        row[META] = dump(rest) if rest else None
        free = [(k, normalize_key(k)) for k in rest]
        ambiguous = any(row[f] is None and sum(spec.key[f] in n and not k.startswith((f"{f}[", f"{f}.")) for k, n in free) > 1 for f in spec.wanted)
        need = max(1, -(-3 * min(len(spec.wanted), len(src.by_key)) // 4))
        return (row, ambiguous) if loose or strong or matched >= need else None

    def from_kv(self, line: str) -> dict | None:
        """`Label: value - Label: value`; the last of equal labels counts."""
        if ":" not in line:
            return None
        obj = {m[1].strip(): m[2].strip() for s in re.split(r"\s+-\s+", line) if (m := KV_SEGMENT.match(s))}
        if not obj:
            return None
        got = self.from_object(obj)
        if got is None and len(obj) > 1 and any(w in normalize_key(k) for k in obj for w in STRONG_LABELS):
            got = self.from_object(obj, loose=True)
        return got[0] if got else None

    def from_column_map(self, cells: list[str]) -> dict | None:
        """Positions given by the caller; a mapped e-mail or phone must be there and one must be valid."""
        spec = self.spec
        row, used, present, valid = {}, set(), False, False
        for f in spec.wanted:
            at = spec.column_map.get(f, [])
            used.update(at)
            row[f] = ", ".join(c for i in at if i < len(cells) and (c := cells[i].strip())) or None
            if spec.key[f] in ("email", "phone") and row[f] is not None:
                present = True
                valid |= field_ok(spec.key[f], row[f])
        if not (present and valid):
            return None
        rest = {f"col_{i}": c.strip() for i, c in enumerate(cells) if i not in used and c.strip()}
        row[META] = dump(rest) if rest else None
        return row

    def from_header(self, cells: list[str], labels: list[str], places: dict[str, list[int]], delimiter: str) -> dict | None | bool:
        """A row by its header; None if nothing is in it, False if the header doesn't fit the line."""
        if len(labels) > 1 and len(cells) > len(labels) and labels[-1].lower() == META:
            cells = [*cells[: len(labels) - 1], delimiter.join(cells[len(labels) - 1 :])]
        if abs(len(labels) - len(cells)) > 2:
            fits = any((at := places.get(f, [len(cells)])[0]) < len(cells) and cells[at] and field_ok(self.spec.key.get(f, f), cells[at]) for f in ("email", "phone", "zip", "date", "url"))
            if not fits:
                return False
        row, used = {}, set()
        for f in self.spec.wanted:
            at = places.get(f, [])
            used.update(at)
            got = [cells[i].strip() for i in at if i < len(cells)]
            row[f] = (", ".join(c for c in got if c) if len(at) > 1 else got[0] if got else "") or None
        if META in places:
            row[META] = ", ".join(c for i in places[META] if i < len(cells) and (c := cells[i].strip())) or None
        else:
            rest = {labels[j]: c for j in range(min(len(labels), len(cells))) if j not in used and (c := cells[j].strip())}
            row[META] = dump(rest) if rest else None
        if all(v is None for v in row.values()):
            return None
        inner = row[META]
        if META not in places and isinstance(inner, str):
            inner = load(inner).get(META)
        if isinstance(inner, str) and inner.startswith("{"):
            try:
                found = load(inner)
            except ValueError:
                found = {}
            row |= {f: found[f] for f in self.spec.wanted if row[f] is None and f in found}
        return self.lifted(row, cells)

    def from_content(self, cells: list[str]) -> dict | None:
        """E-mails and phones by their look, then runs of text for the other fields in order; the rest is meta."""
        spec = self.spec
        row: dict = {}
        claimed: set[int] = set()
        for f in spec.wanted:
            k = spec.key[f]
            at = next((j for j, c in enumerate(cells) if j not in claimed and field_ok(k, c)), None) if k in ("email", "phone") else None
            row[f] = None if at is None else cells[at]
            claimed |= set() if at is None else {at}
        strong = len(claimed)
        if not strong and len(cells) <= 4:  # too little to tell by
            return None
        weak = [f for f in spec.wanted if row[f] is None and spec.key[f] not in ("email", "phone", "zip", "date", "url")]
        runs: list[list[int]] = []
        for j, c in enumerate(cells):
            if j not in claimed and weak_text(c.strip()):
                if runs and runs[-1][-1] == j - 1:
                    runs[-1].append(j)
                else:
                    runs.append([j])
        if len(runs) == 1 and len(weak) > 1 and (z := next((i for i, j in enumerate(runs[0]) if is_zip(cells[j].strip())), 0)):
            runs = [runs[0][:z], runs[0][z:]]
        for i, f in enumerate(weak):
            mine = [j for r in (runs[i:] if f is weak[-1] else runs[i : i + 1]) for j in r]
            if mine:
                row[f] = ", ".join(cells[j].strip() for j in mine)
                claimed.update(mine)
        rest = {f"col_{j}": c.strip() for j, c in enumerate(cells) if j not in claimed and c.strip()}
        row[META] = dump(rest) if rest else None
        if strong or any(v is not None for v in row.values()):
            return self.lifted(row, cells)
        return None

    def lifted(self, row: dict, cells: list[str]) -> dict:
        """Empty fields from cells that are JSON objects."""
        for c in cells:
            t = c.strip()
            if t[:1] != "{" or len(t) < 2:
                continue
            try:
                found = load(t)
            except (ValueError, RecursionError):
                found = loose_pairs(t)
            for f in self.spec.wanted if isinstance(found, dict) else []:
                if _blank(row.get(f)):
                    key = f if f in found else next((k for k in found if self.spec.matches(k, f)), None)
                    row[f] = found[key] if key is not None else row.get(f)
        return row

    def coerced(self, row: dict) -> dict[str, str | None] | None:
        """All values as text; None if one of them is mostly binary."""
        out: dict[str, str | None] = {}
        for f, v in row.items():
            k = normalize_key(f)
            if isinstance(v, list) and k in ("email", "phone", "url"):
                v = next((x for x in v if x is not None and field_ok(k, x)), v)
            if v is None or v == "":
                out[f] = None
                continue
            s = _text(v).strip()
            if isinstance(v, str) and mostly_binary(s):
                return None
            out[f] = s
        return out

    def enriched(self, row: dict[str, str | None]) -> dict[str, str | None]:
        """Fields from meta: same names fill or, where another value stands, are added; first and last name make a name."""
        try:
            meta = load(row[META]) if row.get(META) else None
        except ValueError:
            meta = None
        if not isinstance(meta, dict):
            return row
        row, keys = dict(row), {normalize_key(k): k for k in meta}
        for f in self.spec.wanted:
            k = self.spec.key[f]
            name = keys.get(k)
            if name is not None and not _blank(meta[name]) and not isinstance(meta[name], (dict, list)):
                v = _text(meta.pop(name)).strip()
                row[f] = v if not row.get(f) else row[f] if v in row[f] else f"{row[f]}, {v}"
            elif not row.get(f) and k == "name":
                have = [keys[p] for p in ("firstname", "lastname") if p in keys and not _blank(meta.get(keys[p]))]
                have = have if len(have) == 2 else [keys["fullname"]] if "fullname" in keys and not _blank(meta.get(keys["fullname"])) else []
                if have:
                    row[f] = " ".join(_text(meta.pop(x)).strip() for x in have)
        row[META] = dump(meta) if meta else None
        return row

    def cleaned(self, row: dict[str, str | None]) -> dict[str, str | None]:
        """Fields named just email or phone that aren't valid become null."""
        return {f: None if v is not None and normalize_key(f) in ("email", "phone") and not field_ok(normalize_key(f), v) else v for f, v in row.items()}
