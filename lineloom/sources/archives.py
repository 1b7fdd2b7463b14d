"""Archives: their kind by first bytes, and their entries, with limits that hold while inflating."""

from __future__ import annotations

import io
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ship import ship

# First bytes of kinds of archives, and limits.
ZIP, GZIP, SEVEN, RAR, TAR = b"PK\x03\x04", b"\x1f\x8b", b"7z\xbc\xaf\x27\x1c", b"Rar!", b"ustar"
MOST_RATIO, MOST_BYTES, MOST_ENTRIES, MOST_DEPTH = 100, 10 << 30, 10_000, 3
STEP = 1 << 20
#: Bytes and rows of entries that a batch holds at most.
HELD, MOST_HELD = 4 << 20, 2000


class Bomb(ValueError):
    """An archive that inflates beyond its limits."""


def kind_of(head: bytes) -> str | None:
    for name, magic, at in (("zip", ZIP, 0), ("gz", GZIP, 0), ("7z", SEVEN, 0), ("rar", RAR, 0), ("tar", TAR, 257)):
        if head[at : at + len(magic)] == magic:
            return name
    return None


def kind(content: Column) -> Column:
    """Native form of kind_of."""
    starts = lambda m: F.startswith(content, F.lit(bytearray(m)))
    return F.when(starts(ZIP), "zip").when(starts(GZIP), "gz").when(starts(SEVEN), "7z").when(starts(RAR), "rar").when(F.substring(content, 258, 5) == F.lit(bytearray(TAR)), "tar")


def check_ratio(inflated: int, packed: int) -> None:
    if inflated > MOST_BYTES or packed and inflated / packed > MOST_RATIO and inflated > STEP:
        raise Bomb(f"{inflated} bytes of {packed}")


def _read(stream, packed: int, before: int = 0) -> bytes:
    out, total = [], before
    while part := stream.read(STEP):
        total += len(part)
        check_ratio(total, packed)
        out.append(part)
    return b"".join(out)


def entries(raw: bytes, name: str = "", depth: int = 0) -> Iterator[tuple[str, bytes | Exception]]:
    """(path within the archive, content) of all files, those of nested archives too, one by one; for what can't be read, why."""
    k = kind_of(raw[:512])
    if k is None:
        yield name, raw
        return
    if depth >= MOST_DEPTH:
        raise Bomb(f"archives within archives, {depth} deep")
    if k in ("7z", "rar"):
        raise NotImplementedError(f"{k} archives are not supported")
    for n, content in _opened(raw, name, k):
        if isinstance(content, Exception):
            yield n, content
            continue
        try:
            for inner, c in entries(content, n, depth + 1):
                yield (inner if inner == n else f"{n}/{inner}"), c
        except Bomb:
            raise
        except Exception as why:  # an archive within that can't be read costs itself only
            yield n, why


def _opened(raw: bytes, name: str, k: str) -> Iterator[tuple[str, bytes | Exception]]:
    """The entries one by one; an entry that can't be read gives why, and the others go on."""
    total = 0
    if k == "zip":
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            if len(z.infolist()) > MOST_ENTRIES:
                raise Bomb("too many entries")
            for e in z.infolist():
                if e.is_dir():
                    continue
                if e.flag_bits & 1:
                    yield e.filename, PermissionError("encrypted")
                    continue
                try:
                    with z.open(e) as f:
                        content = _read(f, len(raw), total)
                except (zipfile.BadZipFile, NotImplementedError, EOFError, zlib.error) as why:
                    yield e.filename, why
                    continue
                total += len(content)
                yield e.filename, content
    elif k == "gz":
        out, data = [], raw
        while data[:2] == GZIP:  # members one after the other; what follows the last one is padding
            d = zlib.decompressobj(31)
            while data and not d.eof:
                out.append(d.decompress(data, STEP))
                total += len(out[-1])
                check_ratio(total, len(raw))
                data = d.unconsumed_tail
            if not d.eof:
                raise EOFError("a gzip member ends early")
            data = d.unused_data
        yield name.rpartition("/")[2].removesuffix(".gz"), b"".join(out)
    else:
        with tarfile.open(fileobj=io.BytesIO(raw)) as t:
            for i, e in enumerate(t):
                if i >= MOST_ENTRIES:
                    raise Bomb("too many entries")
                if e.isfile():
                    content = _read(t.extractfile(e), len(raw), total)
                    total += len(content)
                    yield e.name, content


def _error(e: Exception) -> str:
    return f"password: {e}" if isinstance(e, PermissionError) else f"bomb: {e}" if isinstance(e, Bomb) else f"archive: {type(e).__name__}: {e}"


def _rows(path: str, raw: bytes) -> Iterator[tuple]:
    try:
        for name, content in entries(raw, path.rpartition("/")[2]):
            yield (path, name, None, _error(content)) if isinstance(content, Exception) else (path, name, content, None)
    except Exception as e:  # a broken archive is a row, not a failed job; what was read before stays
        yield path, None, None, _error(e)


def _ready(spark) -> None:
    """Sends the package, and bounds what a batch of archives may hold."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def extract(files: DataFrame) -> DataFrame:
    """(archive, entry, content, error) of files (path, content). What can't be opened gives a row with its error."""
    _ready(files.sparkSession)

    kinds = (pa.string(), pa.string(), pa.binary(), pa.string())

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["archive", "entry", "content", "error"])

    def run(batches):
        """One archive at a time; entries share a batch up to HELD bytes, a larger one is a batch of its own."""
        held: list[tuple] = []
        size = 0
        for b in batches:
            for path, raw in zip(b.column(0), b.column(1), strict=True):
                for r in _rows(path.as_py(), raw.as_py() or b""):
                    own = len(r[2] or b"")
                    if held and (size + own > HELD or len(held) >= MOST_HELD):
                        yield batch(held)
                        held, size = [], 0
                    held.append(r)
                    size += own
        if held:
            yield batch(held)

    return files.select("path", "content").mapInArrow(run, "archive string, entry string, content binary, error string")
