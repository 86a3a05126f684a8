"""Model responses: parsing, coercion and strict validation of nested JSON.

A response is one row and holds all records of its paper and schema. Validation
therefore runs over the array inside the row: whether a response is good as a
whole is known without grouping, and only the records of good responses are
exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.functions import coerce as C
from oreleaf.functions import sqltext as Q
from oreleaf.functions.frames import fan_out
from oreleaf.schemas import ExtractionSchema

_FENCE = r"```(?:json)?\s*([\s\S]*?)\s*```"


def parsed_body(body: str) -> str:
    """VARIANT of a response: of the text as it stands, or else of its first fenced block that is JSON."""
    blocks = f"transform(regexp_extract_all({body}, {Q.literal(_FENCE)}, 1), x -> {parse_json('x')})"
    fenced = f"if(contains({body}, '```'), get(filter({blocks}, v -> v IS NOT NULL), 0), NULL)"
    return f"coalesce({parse_json(body)}, {fenced})"


def parse_json(body: str) -> str:
    """VARIANT of a text that holds exactly one JSON value, else null."""
    # The parser stops behind the first value; inside brackets it cannot.
    return Q.let(f"try_parse_json(concat('[', {body}, ']'))", lambda w:
                 f"if(try_variant_get({w}, '$[1]', 'variant') IS NULL, try_variant_get({w}, '$[0]', 'variant'), NULL)")


def _is_object(value: str) -> str:
    return f"startswith({C.kind_of(value)}, 'OBJECT')"


# Whole responses are asked for one level only; their type would be spelled out down to the last field.
def _holds_object(value: str) -> str:
    return f"({C.get_as(value, 'map<string, variant>')} IS NOT NULL)"


def _holds_list(value: str) -> str:
    return f"({C.get_as(value, 'array<variant>')} IS NOT NULL)"


def _flat_name(path: str) -> str:
    return path.replace(".", "__")


def nest(leaf, schema: ExtractionSchema) -> str:
    """The nested record; ``leaf(path, type)`` gives each field. Sub-records are never null."""
    out = {}
    for f in schema.record.fields:
        if isinstance(f.dataType, T.StructType):
            out[f.name] = Q.named_struct({c.name: leaf(f"{f.name}.{c.name}", c.dataType) for c in f.dataType.fields})
        else:
            out[f.name] = leaf(f.name, f.dataType)
    return Q.named_struct(out)


def checked_record(record: str, schema: ExtractionSchema) -> str:
    """STRUCT<record, errors ARRAY<STRING>> of one record's VARIANT.

    ``errors`` names the fields that are present but cannot be converted.
    Unknown keys are ignored.
    """
    parents = [f.name for f in schema.record.fields if isinstance(f.dataType, T.StructType)]
    leaves = schema.leaves()

    def raw(r: str) -> str:
        return Q.named_struct({
            **{_flat_name(p): C.at(r, p) for p, _ in leaves},
            **{f"{p}__": C.at(r, p) for p in parents},
            "is_object__": f"coalesce({_is_object(r)}, false)"})

    def converted(value: str, path: str, kind: T.DataType) -> str:
        # Most fields of a record are missing, and testing for that is cheaper than any conversion.
        missing = Q.empty("array<string>") if isinstance(kind, T.ArrayType) else f"cast(NULL AS {kind.simpleString()})"
        return f"if({value} IS NULL, {missing}, {C.coerce(value, kind, path in schema.scalar_or_list)})"

    def typed(v: str) -> str:
        return Q.named_struct({"raw": v, "flat": Q.named_struct({
            _flat_name(p): converted(f"{v}.{_flat_name(p)}", p, t) for p, t in leaves})})

    def result(x: str) -> str:
        field = lambda p: f"{x}.raw.{p}"
        errors = [f"if({x}.raw.is_object__, NULL, 'record')"]
        errors += [f"if({C.given(field(p + '__'))} AND NOT {_is_object(field(p + '__'))}, '{p}', NULL)" for p in parents]
        errors += [f"if({x}.flat.{_flat_name(p)} IS NULL AND {C.given(field(_flat_name(p)))}, '{p}', NULL)"
                   for p, _ in leaves]
        return Q.named_struct({
            "record": nest(lambda p, _: f"{x}.flat.{_flat_name(p)}", schema),
            "errors": f"array_compact(array({', '.join(errors)}))"})

    return Q.let(Q.let(Q.let(record, raw), typed), result)


# What the declared types look like in the type of a VARIANT when nothing needs converting.
_PLAIN = {
    T.IntegerType: "BIGINT|VOID", T.DoubleType: r"BIGINT|DOUBLE|DECIMAL\(|VOID", T.BooleanType: "BOOLEAN|VOID",
    # [] and [null] both show as ARRAY<VOID>; the nulls inside lists are looked for afterwards
    T.StringType: "STRING|VOID", T.ArrayType: "ARRAY<STRING>|ARRAY<VOID>|VOID",
}


def plain_records(records: str, schema: ExtractionSchema) -> str:
    """ARRAY<RECORD> of a VARIANT array whose fields all have their declared types, else null.

    The type of the array, read once, tells that no field needs conversion or
    rejection; then one cast replaces the conversion field by field. Where the
    type is mixed or unusual the caller goes through the fields.
    """
    by_kind: dict[str, set[str]] = {}
    for path, kind in schema.leaves():
        by_kind.setdefault(_PLAIN[type(kind)], set()).add(path.rsplit(".", 1)[-1])
    by_kind["OBJECT<|VOID"] = {f.name for f in schema.record.fields if isinstance(f.dataType, T.StructType)}
    unusual = "|".join(
        rf"(?:{'|'.join(sorted(names))}): (?!{allowed})" for allowed, names in by_kind.items())
    plain = (f"({Q.matches('{k}', '^ARRAY<OBJECT<')} AND NOT {Q.matches('{k}', f'[<, `](?:{unusual})')})")

    wide = lambda kind: "BIGINT" if isinstance(kind, T.IntegerType) else kind.simpleString()
    fields = ", ".join(
        f"{f.name}: STRUCT<{', '.join(f'{c.name}: {wide(c.dataType)}' for c in f.dataType.fields)}>"
        if isinstance(f.dataType, T.StructType) else f"{f.name}: {wide(f.dataType)}" for f in schema.record.fields)

    def leaf(r: str):
        return lambda path, kind: (
            Q.or_empty(f"{r}.{path}", "array<string>") if isinstance(kind, T.ArrayType)
            else f"cast({r}.{path} AS int)" if isinstance(kind, T.IntegerType) else f"{r}.{path}")

    lists = [p for p, t in schema.leaves() if isinstance(t, T.ArrayType)]
    numbers = [p for p, t in schema.leaves() if isinstance(t, T.IntegerType)]

    def sound(r: str) -> str:
        items = ", ".join(Q.or_empty(f"{r}.{p}", "array<string>") for p in lists)
        whole = " AND ".join(f"coalesce({r}.{p} BETWEEN -2147483648 AND 2147483647, true)" for p in numbers)
        return f"{r} IS NOT NULL AND {whole} AND NOT exists(concat({items}), s -> s IS NULL)"

    cast = f"try_variant_get({records}, '$', 'ARRAY<STRUCT<{fields}>>')"
    checked = Q.let(cast, lambda a: f"if(forall({a}, r -> {sound('r')}), {Q.each(a, lambda r: nest(leaf(r), schema))}, NULL)")
    return Q.let(C.kind_of(records), lambda k: f"if({plain.replace('{k}', k)}, {checked}, NULL)")


def _parsed_rows(responses: DataFrame) -> DataFrame:
    """Adds ``_rows VARIANT`` (the list of records, null when there is none) and ``response_error``."""
    rows = C.at("_parsed", "rows")
    error = Q.case(
        ("_parsed IS NULL", "'malformed JSON'"),
        (f"NOT {_holds_object('_parsed')}", "'response is not an object'"),
        (f"{C.given(rows)} AND NOT {_holds_list(rows)}", "'rows is not a list'"))
    return (
        responses
        .withColumn("_parsed", F.expr(parsed_body("body")))
        .withColumns({"response_error": F.expr(error), "_rows": F.expr(rows)})
        .drop("_parsed")
    )


_RAW_ROWS = f"if(response_error IS NULL, {Q.or_empty(C.get_as('_rows', 'array<variant>'), 'array<variant>')}, NULL)"


def parse_rows(responses: DataFrame) -> DataFrame:
    """Adds ``raw_rows ARRAY<VARIANT>`` and ``response_error``; null or missing rows give no rows."""
    return _parsed_rows(responses).withColumn("raw_rows", F.expr(_RAW_ROWS)).drop("_rows")


def validate(responses: DataFrame, schema: ExtractionSchema) -> DataFrame:
    """Parse and validate ``{"rows": [...]}`` bodies of one schema.

    Adds ``rows ARRAY<RECORD>`` (null when the response is rejected),
    ``response_error`` and ``field_errors ARRAY<STRUCT<row_idx, field>>``. One bad
    field rejects the whole response.
    """
    errors = Q.each_indexed("_checked", lambda c, i: Q.each(
        f"{c}.errors", lambda e: Q.named_struct({"row_idx": i, "field": e})))
    checked = Q.each(_RAW_ROWS, lambda r: checked_record(r, schema))
    return (
        _parsed_rows(responses)
        .withColumn("_plain", F.expr(f"if(response_error IS NULL, {plain_records('_rows', schema)}, NULL)"))
        .withColumn("_checked", F.expr(f"if(_plain IS NULL, {checked}, NULL)"))
        .withColumn("field_errors", F.expr(f"if(_plain IS NULL, flatten({errors}), array())"))
        .withColumn("response_error", F.expr(
            "coalesce(response_error, if(size(field_errors) > 0, 'invalid fields', NULL))"))
        .withColumn("rows", F.expr(
            f"if(response_error IS NULL, coalesce(_plain, {Q.each('_checked', lambda c: c + '.record')}), NULL)"))
        .drop("_checked", "_plain", "_rows")
    )


def validate_single(responses: DataFrame, schema: ExtractionSchema) -> DataFrame:
    """As :func:`validate` for bodies that are one bare record; adds ``record`` and ``response_error``."""
    # One value between brackets, as the conversions below expect it.
    one = f"""coalesce(try_parse_json(concat('[', body, ']')), if(contains(body, '```'), get(filter(
        transform(regexp_extract_all(body, {Q.literal(_FENCE)}, 1), x -> try_parse_json(concat('[', x, ']'))), v -> v IS NOT NULL), 0), NULL))"""
    record = "try_variant_get(_one, '$[0]', 'variant')"
    alone = "try_variant_get(_one, '$[1]', 'variant') IS NULL"
    return (
        responses
        .withColumn("_one", F.expr(one))
        .withColumn("_plain", F.expr(f"if({alone}, get({plain_records('_one', schema)}, 0), NULL)"))
        .withColumn("_checked", F.expr(
            f"if(_plain IS NULL, {checked_record(f'if({alone}, {record}, NULL)', schema)}, NULL)"))
        .withColumn("response_error", F.expr(
            "if(_plain IS NULL AND size(_checked.errors) > 0, array_join(_checked.errors, ','), NULL)"))
        .withColumn("record", F.expr("if(response_error IS NULL, coalesce(_plain, _checked.record), NULL)"))
        .drop("_checked", "_plain", "_one")
    )


def record_rows(validated: DataFrame) -> DataFrame:
    """One row per record of the good responses, numbered in response order."""
    keep = [c for c in validated.columns if c not in ("rows", "body", "field_errors", "response_error")]
    return fan_out(validated, keep, "rows", "row_idx", "record")


def error_rows(validated: DataFrame) -> DataFrame:
    """One row per rejected field, or one without a field for a response rejected as a whole."""
    keep = [c for c in validated.columns if c not in ("rows", "body", "field_errors", "response_error")]
    whole = "array(named_struct('row_idx', cast(NULL AS int), 'field', cast(NULL AS string)))"
    found = F.expr(f"if(response_error IS NULL, NULL, if(size(field_errors) > 0, field_errors, {whole}))")
    return (fan_out(validated, [*keep, "response_error"], found, "i", "e")
            .select(*keep, "response_error", "e.row_idx", "e.field"))


def record_json(record: Column, pretty: bool = False) -> Column:
    """JSON of a record with its nulls; reading it back gives the same record."""
    options = {"ignoreNullFields": "false"}
    if pretty:
        options["pretty"] = "true"
    return F.to_json(record, options)


def record_from_json(column: str, schema: ExtractionSchema) -> Column:
    """The record of a JSON text as :func:`record_json` writes it; null for anything but one JSON object."""
    def read(one: str) -> str:
        slow = lambda: checked_record(f"if(size({Q.or_empty(C.get_as(one, 'array<variant>'), 'array<variant>')}) = 1, "
                                      f"try_variant_get({one}, '$[0]', 'variant'), NULL)", schema) + ".record"
        return Q.let(f"get({plain_records(one, schema)}, 0)", lambda p: f"if({p} IS NULL, {slow()}, {p})")

    return F.expr(Q.let(f"try_parse_json(concat('[', {column}, ']'))", read))
