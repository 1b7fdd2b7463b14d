"""What the caller asks for: fields, their aliases and composites, and positional layouts."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import lru_cache

# The built-in synonyms of each category of fields.
ALIASES = {
    "account": ["account", "accountid", "account_id", "accountidentifier", "account_identifier", "identifier", "login", "user", "username", "email", "mail", "e_mail", "useremail", "phone", "mobile", "userid", "user_id", "id"],
    "email": ["email", "mail", "emailaddress", "e_mail", "emails", "useremail", "e"],
    "name": ["name", "fullname", "full_name", "username", "surname", "фио", "n", "firstname", "lastname", "first_name", "last_name"],
    "phone": ["phone", "mobile", "telephone", "phonenumber", "msisdn", "phones", "mobile_phone_no", "mobile_number", "телефон", "t"],
    "address": ["address", "addr", "streetaddress", "addresses", "street", "адрес", "a"],
    "location": ["location", "city", "country", "countryname", "county", "postcode", "postalcode", "postal", "zip", "zipcode", "state", "province", "region", "town", "geo", "locality", "location_id", "a", "город", "страна"],
}

# Words that place a field in a category when its name isn't a known synonym; the first that matches counts.
KEYWORDS = [
    ("account", r"account|identifier|login|user\s*id|username"),
    ("email", r"mail"),
    ("phone", r"phone|mobile|tel|msisdn"),
    ("name", r"name|surname"),
    ("address", r"address|street"),
    ("location", r"city|country|county|postcode|postal|zip|state|province|region|town|geo|locality"),
]

#: A field that is put together from others, in this order.
COMPONENTS = {"name": ("firstname", "lastname")}

# Labels of columns that a guessed mapping never uses.
DENIED = ["snils", "снилс", "passport", "паспорт", r"\btin\b", r"\binn\b", "инн", r"\bssn\b", "national.?id", "insurance.?number", "insurer", "employer", "работодат", "patronymic", "date.?of.?birth", r"\bdob\b", "birth.?date", "дата.?рожд"]
_DENIED = re.compile("|".join(DENIED), re.I)

META = "meta"


@lru_cache(maxsize=4096)
def normalize_key(key: str) -> str:
    """Lower case, letters and digits only."""
    return "".join(c for c in key.lower() if c.isalnum())


def category(name: str) -> str | None:
    """The category of a field's name: by name, by synonym, by keyword."""
    n = normalize_key(name)
    for key in (name, n):
        if key in ALIASES:
            return key
    found = None
    for c, words in ALIASES.items():  # a synonym of several categories belongs to the last one
        if n in words:
            found = c
    return found or next((c for c, r in KEYWORDS if re.search(r, n)), None)


def parse_fields(value) -> list[str]:
    """A list of names, or JSON text of one; anything else is empty."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return []
    return [str(x) for x in value] if isinstance(value, (list, tuple)) else []


def clean_column_map(value) -> dict[str, list[int]]:
    """Positions per field: non-negative integers and lists of them; the rest is left out."""
    out = {}
    for name, at in (value or {}).items():
        if isinstance(at, bool):
            continue
        if isinstance(at, int) and at >= 0:
            out[name] = [at]
        elif isinstance(at, (list, tuple)) and at and all(isinstance(x, int) and not isinstance(x, bool) and x >= 0 for x in at):
            out[name] = list(at)
    return out


def denied(label: str) -> bool:
    return _DENIED.search(label) is not None


def guessed_map(value, headers: list[str], fields: list[str]) -> dict[str, list[int]]:
    """A guessed mapping, cleaned: wanted fields only, and no position whose label is denied."""
    kept = {f: [i for i in at if i >= len(headers) or not denied(headers[i])] for f, at in clean_column_map(value).items() if f in fields}
    return {f: at for f, at in kept.items() if at}


def copy_targets(columns: list[str], spec: FieldSpec) -> list[str | None]:
    """The field of each column of a COPY statement: by equal names first, then by synonyms; each field is used once."""
    found: list[str | None] = [None] * len(columns)
    free = list(spec.wanted)
    for fits in (lambda c, f: spec.key[f] == normalize_key(c), spec.matches):
        for i, c in enumerate(columns):
            if found[i] is None and (f := next((f for f in free if fits(c, f)), None)) is not None:
                found[i] = f
                free.remove(f)
    return found


def select_headers(headers: list[str], chosen: list[str]) -> tuple[list[str], dict[str, list[int]]]:
    """Fields and column map for headers that a user chose; meta joins if some are left out."""
    at = {h: [i] for i, h in reversed(list(enumerate(headers))) if h in chosen}
    fields = [h for h in chosen if h in at]
    if set(headers) - set(chosen) and META not in fields:
        fields.append(META)
    return fields, {f: at[f] for f in fields if f in at}


@dataclass
class FieldSpec:
    """Fields wanted, in order; extra synonyms are added to the built-in ones."""

    fields: list[str]
    aliases: dict[str, list[str]] = field(default_factory=dict)
    components: dict[str, list[str]] = field(default_factory=dict)
    column_map: dict[str, list[int]] = field(default_factory=dict)

    def __post_init__(self):
        self.fields = list(dict.fromkeys(self.fields))
        self.wanted = [f for f in self.fields if f != META]
        self.key = {f: normalize_key(f) for f in self.wanted}
        self.column_map = clean_column_map(self.column_map)
        own = {normalize_key(k): v for k, v in self.aliases.items()}
        self.synonyms: dict[str, list[str]] = {}
        for f, n in self.key.items():
            words = [n, *(ALIASES[c] if (c := category(f)) else []), *own.get(n, [])]
            self.synonyms[n] = list(dict.fromkeys(normalize_key(w) for w in words))
        parts = COMPONENTS | {normalize_key(k): tuple(normalize_key(x) for x in v) for k, v in self.components.items()}
        # a field that is itself a part of a composite isn't put together
        inside = {x for v in parts.values() for x in v}
        self.parts = {n: parts[n] for n in self.key.values() if n in parts and n not in inside}

    def matches(self, key: str, name: str) -> bool:
        """Whether a source's label stands for a field: by synonym, by synonym and digits, or as enough parts."""
        tokens = [t for t in map(normalize_key, re.split(r"[,;]+", key)) if t]
        n = normalize_key(name)
        words = self.synonyms.get(n, [n])
        if any(t in words for t in tokens):
            return True
        if len(parts := self.parts.get(n, ())) > 1:
            return len({t for t in tokens if t in parts}) >= min(2, len(parts))
        return any(t.startswith(w) and t[len(w) :].isdigit() for t in tokens for w in words if len(t) > len(w))
