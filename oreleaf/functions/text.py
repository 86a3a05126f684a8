"""String column expressions.

Everything here is a plain Catalyst expression: no Python worker is involved,
and nothing needs more than the row it is evaluated on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def strip(col: Column) -> Column:
    """Remove all Unicode white space from both ends (``trim`` removes only spaces)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def strip_chars(col: Column, chars: str) -> Column:
    """Remove any of ``chars`` from both ends."""
    return F.btrim(col, F.lit(chars))


def null_if_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def join_list(col: Column, separator: str = "; ") -> Column:
    """Join the list items that are neither null nor blank; items are not trimmed."""
    kept = F.filter(col, lambda v: v.isNotNull() & (strip(v) != ""))
    return F.coalesce(F.array_join(kept, separator), F.lit(""))


def collapse_spaces(col: Column) -> Column:
    return strip(F.regexp_replace(col, r"(?U)\s+", " "))


def normalised_phrase(col: Column) -> Column:
    """Comparison form of a phrase: lower case, no punctuation, single spaces."""
    return collapse_spaces(F.regexp_replace(F.lower(col), r"[\p{Punct}]+", " "))


def fill_template(template: str, **values: Column) -> Column:
    """Literal substitution of ``{name}`` slots.

    The template is cut at its slots on the driver and the pieces are
    concatenated, so a value that happens to contain ``{name}``, ``$`` or a
    backslash is never interpreted.
    """
    pieces: list[Column] = []
    rest = template
    while rest:
        found = [(rest.find("{%s}" % name), name) for name in values]
        found = sorted(f for f in found if f[0] >= 0)
        if not found:
            pieces.append(F.lit(rest))
            break
        at, name = found[0]
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(values[name])
        rest = rest[at + len(name) + 2:]
    return F.concat(*pieces)
