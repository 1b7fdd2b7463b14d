"""Cells of delimited lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import bound
from ..functions.validate import ODD_BLANK, trim

#: Tried in this order; the one that gives most cells wins, the earlier of equals.
DELIMITERS = (",", ";", "\t", "|", ":")


def split_cells(line: str, delimiter: str) -> list[str]:
    """Cells of a line. A quote opens only at the start of a cell and "" within quotes is a quote; tabs have no quoting.

    Unquoted cells are trimmed. Text behind a closing quote joins the cell. A quoted cell that ends the line leaves an
    empty cell behind it, which the tolerance for wider rows relies on.
    """
    if delimiter == "\t" or '"' not in line:
        return [c.strip() for c in line.split(delimiter)]
    cells, at, n = [], 0, len(line)
    while True:
        start = at
        while at < n and line[at].isspace() and line[at] != delimiter:
            at += 1
        if at < n and line[at] == '"':
            text, at = [], at + 1
            while at < n:
                end = line.find('"', at)
                if end < 0:
                    text.append(line[at:])
                    at = n
                    break
                text.append(line[at:end])
                at = end + 1
                if at < n and line[at] == '"':
                    text.append('"')
                    at += 1
                    continue
                break
            end = line.find(delimiter, at)
            behind = line[at : n if end < 0 else end]
            cells.append("".join(text) + behind.strip())
            if end < 0:
                if not behind:
                    cells.append("")
                return cells
            at = end + 1
        else:
            end = line.find(delimiter, start)
            if end < 0:
                cells.append(line[start:].strip())
                return cells
            cells.append(line[start:end].strip())
            at = end + 1


def merge_scheme(cells: list[str], delimiter: str) -> list[str]:
    """https and //host, cut at a colon, are one cell again."""
    if delimiter == ":" and len(cells) > 1 and cells[1].startswith("//"):
        return [f"{cells[0]}:{cells[1]}", *cells[2:]]
    return cells


def best_cells(line: str) -> tuple[list[str], str] | None:
    """The cells under the delimiter that gives most of them, at least two."""
    best = None
    for d in DELIMITERS:
        if d in line:
            cells = split_cells(line, d)
            if len(cells) >= 2 and (best is None or len(cells) > len(best[0])):
                best = cells, d
    return best


def best_delimiter(line: Column) -> Column:
    """Native: struct(n, delimiter, cells) for lines without quotes; null under two cells.

    Delimiters are counted before any cell is cut. A line is bound to a variable, and its best delimiter too, so neither is worked out
    again for each use.
    """

    def cut(x: Column) -> Column:
        pattern = F.concat(F.lit("\\"), x["delimiter"])
        return F.struct(x["n"].alias("n"), x["order"].alias("order"), x["delimiter"].alias("delimiter"), trimmed(x["line"], F.split(x["line"], pattern, -1)).alias("cells"))

    tried = [F.struct((F.length(line) - F.length(F.replace(line, F.lit(d), F.lit(""))) + 1).alias("n"), F.lit(-order).alias("order"), F.lit(d).alias("delimiter"), line.alias("line")) for order, d in enumerate(DELIMITERS)]
    return bound(F.greatest(*tried), lambda x: F.when(x["n"] >= 2, cut(x)))


def trimmed(line: Column, cells: Column) -> Column:
    """The cells of a line, trimmed; one look at the line spares most cells the general trim."""
    return F.when(line.rlike(ODD_BLANK), F.transform(cells, trim)).otherwise(F.transform(cells, lambda c: F.trim(c)))


def merged_scheme(cells: Column, delimiter: Column) -> Column:
    """Native form of merge_scheme."""
    first = F.concat(F.get(cells, 0), F.lit(":"), F.get(cells, 1))
    return F.when((delimiter == ":") & F.startswith(F.get(cells, 1), F.lit("//")), F.concat(F.array(first), F.slice(cells, 3, F.greatest(F.size(cells) - 2, F.lit(0))))).otherwise(cells)
