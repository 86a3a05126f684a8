"""Lax-but-strict conversion of VARIANT values to the declared field types.

A value is converted where its meaning is unambiguous (``"9.5"`` for a number,
``"yes"`` for a boolean) and rejected otherwise. JSON null equals missing.
Every function returns null for missing *and* for rejected input; the caller
tells them apart with :func:`given`. SQL text in, SQL text out.
"""

from __future__ import annotations

from pyspark.sql import types as T

from oreleaf.functions import sqltext as Q

# What counts as a number, a whole number or a boolean in text.
_FLOAT = r"^[+-]?(?:[0-9]+(?:_[0-9]+)*(?:\.(?:[0-9]+(?:_[0-9]+)*)?)?|\.[0-9]+(?:_[0-9]+)*)(?:[eE][+-]?[0-9]+)?$"
_FLOAT_WORD = r"(?i)^[+-]?(?:nan|inf|infinity)$"
_INT = r"^[+-]?[0-9]+(?:_[0-9]+)*(?:\.0*)?$"
_TRUE = ["1", "t", "true", "y", "yes", "on"]
_FALSE = ["0", "f", "false", "n", "no", "off"]


def given(value: str) -> str:
    """Present and not JSON null."""
    return f"({value} IS NOT NULL AND NOT is_variant_null({value}))"


def at(value: str, path: str) -> str:
    return f"try_variant_get({value}, '$.{path}', 'variant')"


def get_as(value: str, kind: str) -> str:
    return f"try_variant_get({value}, '$', '{kind}')"


def kind_of(value: str) -> str:
    return f"schema_of_variant({value})"


def _is_number(kind: str) -> str:
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def to_string(value: str) -> str:
    return f"if({kind_of(value)} = 'STRING', {get_as(value, 'string')}, NULL)"


def to_double(value: str) -> str:
    from_text = Q.let(Q.strip(get_as(value, "string")), lambda t: Q.case(
        (Q.matches(t, _FLOAT), f"try_cast(replace({t}, '_', '') AS DOUBLE)"),
        (Q.matches(t, _FLOAT_WORD), f"try_cast(ltrim('+', {t}) AS DOUBLE)")))
    return Q.let(kind_of(value), lambda k: Q.case(
        (f"{k} = 'STRING'", from_text),
        (f"{_is_number(k)} OR {k} = 'BOOLEAN'", get_as(value, "double"))))


def to_int(value: str) -> str:
    from_text = Q.let(Q.strip(get_as(value, "string")), lambda t: Q.case(
        (Q.matches(t, _INT), f"try_cast(replace(substring_index({t}, '.', 1), '_', '') AS INT)")))
    whole = f"{get_as(value, 'double')} = floor({get_as(value, 'double')})"
    return Q.let(kind_of(value), lambda k: Q.case(
        (f"{k} = 'STRING'", from_text),
        (f"{k} = 'BOOLEAN' OR ({_is_number(k)} AND {whole})", get_as(value, "int"))))


def to_boolean(value: str) -> str:
    words = lambda ws: ", ".join(f"'{w}'" for w in ws)
    from_text = Q.let(f"lower({get_as(value, 'string')})", lambda t: Q.case(
        (f"{t} IN ({words(_TRUE)})", "true"), (f"{t} IN ({words(_FALSE)})", "false")))
    from_number = Q.let(get_as(value, "double"), lambda n: Q.case((f"{n} = 1", "true"), (f"{n} = 0", "false")))
    return Q.let(kind_of(value), lambda k: Q.case(
        (f"{k} = 'BOOLEAN'", get_as(value, "boolean")),
        (f"{k} = 'STRING'", from_text),
        (_is_number(k), from_number)))


def to_string_list(value: str, scalar_ok: bool = False) -> str:
    """List of strings; missing and null are the empty list."""
    none = Q.empty("array<string>")
    strings = Q.let(get_as(value, "array<string>"), lambda a: f"if(forall({a}, s -> s IS NOT NULL), {a}, NULL)")
    branches = [
        (f"NOT {given(value)}", none),
        (f"{kind_of(value)} = 'ARRAY<STRING>'", strings),
        (f"{kind_of(value)} = 'ARRAY<VOID>' AND try_variant_get({value}, '$[0]', 'variant') IS NULL", none),
    ]
    if scalar_ok:
        branches.append((f"{kind_of(value)} = 'STRING'", f"array({get_as(value, 'string')})"))
    return Q.case(*branches)


def coerce(value: str, target: T.DataType, scalar_ok: bool = False) -> str:
    if isinstance(target, T.ArrayType):
        return to_string_list(value, scalar_ok)
    convert = {
        T.IntegerType: to_int, T.DoubleType: to_double, T.BooleanType: to_boolean, T.StringType: to_string,
    }[type(target)]
    return convert(value)
