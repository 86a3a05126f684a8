"""Composition of Spark SQL expressions as text.

The larger expressions of this package (dozens of fields, nested lambdas) are
written as SQL and parsed once by Spark; building them from Column objects
would cost one gateway call per node on the driver. Arguments and results are
SQL text; pass the result to ``F.expr``.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

_numbers = count()

# What ``(?U)\s`` matches.
_WHITE_SPACE = "".join(f"\\u{c:04x}" for c in (*range(0x9, 0xe), 0x20, 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000))


def literal(text: str) -> str:
    """A string literal that is read back unchanged."""
    if "'" not in text:
        return f"r'{text}'"
    if '"' not in text:
        return f'r"{text}"'
    raise ValueError("a literal cannot hold both kinds of quotes")


def _variable() -> str:
    return f"x{next(_numbers)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return f"get({each(f'array({value})', body)}, 0)"


def bind(value: str, body: Callable[[str], str]) -> str:
    """As :func:`let`, for lambdas nested deeply.

    The value is the start of an aggregate over nothing. An item of a transformed array would be copied, and for each row ``get``
    works its type out anew from everything within the lambda.
    """
    acc, last = _variable(), _variable()
    return f"aggregate(array(), {value}, ({acc}, {_variable()}) -> {acc}, {last} -> {body(last)})"


def each(array: str, body: Callable[[str], str]) -> str:
    v = _variable()
    return f"transform({array}, {v} -> {body(v)})"


def each_indexed(array: str, body: Callable[[str, str], str]) -> str:
    v, i = _variable(), _variable()
    return f"transform({array}, ({v}, {i}) -> {body(v, i)})"


def keep(array: str, test: Callable[[str], str]) -> str:
    v = _variable()
    return f"filter({array}, {v} -> {test(v)})"


def keep_indexed(array: str, test: Callable[[str, str], str]) -> str:
    v, i = _variable(), _variable()
    return f"filter({array}, ({v}, {i}) -> {test(v, i)})"


def fold(array: str, start: str, step: Callable[[str, str], str]) -> str:
    acc, v = _variable(), _variable()
    return f"aggregate({array}, {start}, ({acc}, {v}) -> {step(acc, v)})"


def case(*branches: tuple[str, str], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in branches) + f" ELSE {default} END"


def named_struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in fields.items()) + ")"


def matches(value: str, pattern: str) -> str:
    return f"({value} RLIKE {literal(pattern)})"


def replace_all(value: str, pattern: str, by: str) -> str:
    return f"regexp_replace({value}, {literal(pattern)}, {literal(by)})"


def extract(value: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({value}, {literal(pattern)}, {group})"


def strip(value: str) -> str:
    """Remove all Unicode white space from both ends (``trim`` alone removes only spaces).

    A pattern would look for its end behind every blank within the value.
    """
    return f"btrim({value}, '{_WHITE_SPACE}')"


def null_if_empty(value: str) -> str:
    return f"nullif({value}, '')"


def empty(array_type: str) -> str:
    return f"cast(array() AS {array_type})"


def or_empty(array: str, array_type: str) -> str:
    return f"coalesce({array}, {empty(array_type)})"
