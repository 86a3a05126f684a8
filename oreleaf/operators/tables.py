"""Records from tables: headings read as field, unit and conditions, tables turned and split into result sets.

A heading such as ``CO2 uptake at 25 °C (mmol/g)`` names a field, the unit of its
cells and the conditions under which they hold. Reading is done by expressions over literal
phrase lists inside the row of the table: no join, no broadcast, no shuffle.

How a table is read
* Orientation: the first column holds the headings if it names a result, the first row does not, and it has more known headings.
* A second row without any number belongs to the headings if it has a field, a unit or a
  condition; empty cells above it repeat the cell to their left.
* Fields: a heading scores for a field by the share of its words that one of the field's phrases covers, a little more if
  it ends with the phrase or if its unit is of the field's dimension; a unit of another dimension rules the
  field out. Pairs are taken by falling score (then column); a column gets one field, and a field that describes the
  material one column.
* A table counts for a schema only if it has one of the schema's results.
* Result sets: columns of results with the same conditions in their headings are one set, columns without
  conditions are numbered. A column without conditions also serves sets that have none of their own. A row gives a record for
  each set with a value, and one record if it has no value at all.
* Conditions come from the set's headings, else from a column of their own, else from the caption.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.functions import sqltext as Q
from oreleaf.functions.frames import fan_out
from oreleaf.functions.text import null_if_empty
from oreleaf.operators.rules import NUMBER, SPREAD, UNITS, cell_number, scale_of_unit, to_declared_unit
from oreleaf.schemas import ADSORPTION, CATALYST, ExtractionSchema


@dataclass(frozen=True)
class TableRules:
    """What the headings of one schema's tables mean."""

    schema: ExtractionSchema
    # phrase (lower case, no punctuation) -> field
    phrases: dict[str, str]
    # fields that hold a result; a table without one is not of the schema
    results: frozenset[str]
    # condition -> field; conditions can have several columns
    conditions: dict[str, str]
    # field -> dimension of its unit
    dimensions: dict[str, str]
    # field -> field for the unit as stated; such values are not converted
    stated_units: dict[str, str] = field(default_factory=dict)


# How tables name the fields.
_MATERIAL = {"sample": "material_id", "material": "material_id", "catalyst": "material_id"}
ADSORPTION_TABLES = TableRules(
    schema=ADSORPTION,
    phrases=_MATERIAL | {
        "adsorbent": "material_id", "sorbent": "material_id",
        "temperature": "measurement.adsorption_temperature_c", "t": "measurement.adsorption_temperature_c",
        "adsorption temperature": "measurement.adsorption_temperature_c",
        "pressure": "measurement.pressure_bar", "p": "measurement.pressure_bar",
        "gas": "measurement.gas_composition", "gas composition": "measurement.gas_composition",
        "co2 uptake": "measurement.co2_adsorption_capacity_mmol_g", "uptake": "measurement.co2_adsorption_capacity_mmol_g",
        "co2 capacity": "measurement.co2_adsorption_capacity_mmol_g", "capacity": "measurement.co2_adsorption_capacity_mmol_g",
        "adsorption capacity": "measurement.co2_adsorption_capacity_mmol_g", "co2 adsorbed": "measurement.co2_adsorption_capacity_mmol_g",
        "ph": "synthesis_method.ph", "calcination temperature": "synthesis_method.calcination_temp_c",
    },
    results=frozenset({"measurement.co2_adsorption_capacity_mmol_g"}),
    conditions={"temperature": "measurement.adsorption_temperature_c", "pressure": "measurement.pressure_bar"},
    dimensions={
        "measurement.adsorption_temperature_c": "temperature", "measurement.pressure_bar": "pressure",
        "measurement.co2_adsorption_capacity_mmol_g": "capacity", "synthesis_method.calcination_temp_c": "temperature",
    },
)
CATALYST_TABLES = TableRules(
    schema=CATALYST,
    phrases=_MATERIAL | {
        "reaction": "performance.reaction_type", "reaction type": "performance.reaction_type",
        "temperature": "performance.temperature", "t": "performance.temperature", "reaction temperature": "performance.temperature",
        "pressure": "performance.pressure", "p": "performance.pressure", "reaction pressure": "performance.pressure",
        "feed": "performance.feed_composition", "feed composition": "performance.feed_composition", "feed gas": "performance.feed_composition",
        "conversion": "performance.co2_conversion", "co2 conversion": "performance.co2_conversion", "x co2": "performance.co2_conversion",
        "co selectivity": "performance.co_selectivity", "s co": "performance.co_selectivity", "selectivity to co": "performance.co_selectivity",
        "ch4 selectivity": "performance.ch4_selectivity", "s ch4": "performance.ch4_selectivity", "methane selectivity": "performance.ch4_selectivity",
        "selectivity to ch4": "performance.ch4_selectivity", "selectivity to methane": "performance.ch4_selectivity",
        "methanol selectivity": "performance.methanol_selectivity", "ch3oh selectivity": "performance.methanol_selectivity",
        "s ch3oh": "performance.methanol_selectivity", "selectivity to methanol": "performance.methanol_selectivity",
        "ph": "synthesis_conditions.ph", "calcination temperature": "synthesis_conditions.calcination_temp",
        "reduction": "synthesis_conditions.reduction_pretreatment",
    },
    results=frozenset({
        "performance.co2_conversion", "performance.co_selectivity", "performance.ch4_selectivity", "performance.methanol_selectivity"}),
    conditions={"temperature": "performance.temperature", "pressure": "performance.pressure"},
    dimensions={
        "performance.temperature": "temperature", "performance.pressure": "pressure", "synthesis_conditions.calcination_temp": "temperature",
        "performance.co2_conversion": "share", "performance.co_selectivity": "share", "performance.ch4_selectivity": "share",
        "performance.methanol_selectivity": "share",
    },
    stated_units={
        "performance.temperature": "performance.temperature_units", "performance.pressure": "performance.pressure_units",
        "synthesis_conditions.calcination_temp": "synthesis_conditions.calcination_temp_units",
    },
)

RULES = {r.schema.name: r for r in (ADSORPTION_TABLES, CATALYST_TABLES)}

_UNIT_DIMENSION = {unit: dimension for dimension, units in UNITS.items() for unit in units} | {"%": "share", "mol%": "share"}
_KNOWN_UNITS = "|".join(sorted(map("\\Q{}\\E".format, _UNIT_DIMENSION), key=len, reverse=True))
_STATED = {"temperature": r"°\s*c|k", "pressure": "mbar|bar|atm|kpa|mpa|pa"}
_LEAST_FIT = 0.5
# Units as they are written, by their lower-case form.
_WRITTEN = {"°c": "°C", "c": "°C", "k": "K", "kpa": "kPa", "mpa": "MPa", "pa": "Pa"}


def _condition(dimension: str, group: str = "(") -> str:
    """Pattern of a number with a unit of the dimension: groups for the number and the unit."""
    return rf"(?<![\w.,-]){group}{NUMBER}){SPREAD}\s*{group}{_STATED[dimension]})(?![\w/])"


def _stated(text: str, dimension: str) -> str:
    """The first condition of a dimension in a lower-case text: value and unit as stated, or null."""
    pattern = _condition(dimension)
    number = Q.replace_all(f"replace({Q.extract(text, pattern, 1)}, '−', '-')", ",", "")
    unit = Q.replace_all(Q.extract(text, pattern, 2), r"\s+", "")
    return f"if({Q.matches(text, pattern)}, named_struct('value', try_cast({number} AS double), 'unit', {unit}), NULL)"


def _plain(cell: str) -> str:
    return Q.strip(Q.replace_all(Q.replace_all(f"lower(coalesce({cell}, ''))", "[ºo˚](?=\\s*c\\b)|℃", "°"), r"(?U)\s+", " "))


# Headings are read together, as the lines of one text: each pattern runs once for all headings of a table, not once for each.
_SPACE = r"[\s&&[^\n]]"


def _lower_lines(cells: str) -> str:
    return rf"lower(array_join({Q.each(cells, lambda c: rf"replace(coalesce({c}, ''), '\n', ' ')")}, '\n'))"


def _may_name_result(rules: TableRules) -> str:
    """Pattern that every heading that names a result has in its lower-case text: the words of a phrase in their order, or, for a unit alone, what is before its slash."""
    phrases: list[list[str]] = []
    for words in sorted((p.split() for p, f in rules.phrases.items() if f in rules.results), key=len):
        if not any(" ".join(p) in " ".join(words) for p in phrases):
            phrases.append(words)
    units = [u.split("/")[0] for u, d in _UNIT_DIMENSION.items() if d in _alone(rules)]
    return "(?U)" + "|".join([*("[^\\n]*".join(p) for p in phrases), *(r"\s*".join(u) for u in units)])


def _alone(rules: TableRules) -> dict[str, str]:
    """Dimension -> result that a unit names without words: the only result of that dimension."""
    results = [(f, rules.dimensions.get(f)) for f in sorted(rules.results)]
    return {d: f for f, d in results if d and [x for _, x in results].count(d) == 1}


def _plain_lines(cells: str) -> str:
    """SQL: the cells as lines, each as `_plain` has it but for blanks at its ends."""
    return Q.replace_all(Q.replace_all(_lower_lines(cells), rf"[ºo˚](?={_SPACE}*c\b)|℃", "°"), rf"(?U)[\s&&[^ \n]]{_SPACE}*| {_SPACE}+", " ")


def _of_lines(pattern: str) -> str:
    """A pattern for lines of plain text, whose only white space within a line is the blank."""
    return "(?md)" + pattern.replace(r"\s", " ")


def _first_of_lines(text: str, pattern: str, groups: str) -> str:
    """SQL: for each line groups of the first match of a pattern; a group is empty if there is none."""
    return Q.replace_all(text, _of_lines(f"^(?:.*?{pattern}.*|.*)$"), groups)


def _line(lines: str, i: str) -> str:
    return f"coalesce(get({lines}, {i}), '')"


def _unit_forms(units: str) -> str:
    """`mmol g-1` and the like as `mmol/g`, without spaces, in each line."""
    per_gram = lambda u: Q.replace_all(u, _of_lines(r"\s*[·.]?\s*(k?g)\s*(?:\^?[-−]1|⁻¹)$"), "/$1")
    return Q.bind(units, lambda u: f"replace(if(contains({u}, '1') OR contains({u}, '¹'), {per_gram(u)}, {u}), ' ', '')")


def _read_all(cells: str, rules: TableRules) -> str:
    """SQL: for each cell the candidates (score, field), unit, temperature and pressure that it states as a heading."""
    words = sorted({w for phrase in rules.phrases for w in phrase.split()}, key=len, reverse=True)
    names = rf"(?:{'|'.join(words)})(?:\s+(?:{'|'.join(words)}))*"
    any_condition = "|".join(_condition(d, "(?:") for d in _STATED)
    # The first bracket that holds neither names of fields alone nor a condition.
    bracket = rf"([(\[])(?!{names}[)\]])(?!(?=[^()\[\]\n]*[0-9])[^()\[\]\n]*?(?:{any_condition}))([^()\[\]\n]*)[)\]]"
    slash = rf"/\s*({_KNOWN_UNITS}|mmol\s*g-1)\s*$"
    has_slash = lambda text: f"contains({text}, '/')"

    def with_text(text: str) -> str:
        brackets = f"if(contains({text}, '(') OR contains({text}, '['), {_first_of_lines(text, bracket, '$1$2')}, '')"
        parts = {"text": text, "bracket": brackets, "slash": f"if({has_slash(text)}, {_first_of_lines(text, slash, '$1')}, '')",
                 "body": f"if({has_slash(text)}, {Q.replace_all(text, _of_lines(slash), ' ')}, {text})"}
        return Q.bind(Q.named_struct({n: rf"split({t}, '\n')" for n, t in parts.items()}), with_parts)

    def with_parts(p: str) -> str:
        lines = Q.each_indexed(f"{p}.text", lambda x, i: Q.bind(_line(f"{p}.bracket", i), lambda b: Q.named_struct({
            "body": f"if({b} <> '', replace({x}, substring({b}, 2), ' '), get({p}.body, {i}))",
            "unit": f"if({b} <> '', substring({b}, 2), {_line(f'{p}.slash', i)})"})))
        return Q.bind(lines, lambda lines: Q.bind(Q.named_struct({
            "body": rf"array_join({lines}.body, '\n')", "unit": _unit_forms(rf"array_join({lines}.unit, '\n')")}), with_bodies))

    def with_bodies(found: str) -> str:
        # Before the unit of a condition there is a digit; where there is none, the pattern itself is not tried.
        stated = {d: f"if({Q.matches(f'{found}.body', _of_lines(rf'[0-9]\s*(?:{_STATED[d]})(?![\w/])'))}, {_first_of_lines(f'{found}.body', _condition(d), '$1' + chr(9) + '$2')}, '')" for d in _STATED}
        return Q.bind(Q.named_struct({"body": f"{found}.body", "unit": f"{found}.unit", **stated}), with_conditions)

    def with_conditions(found: str) -> str:
        numbers = " OR ".join(Q.matches(f"{found}.{d}", "[0-9]") for d in _STATED)
        bare = f"if({numbers}, {Q.replace_all(f'{found}.body', _of_lines(any_condition), ' ')}, {found}.body)"
        key = Q.replace_all(Q.replace_all(Q.replace_all(bare, r"[\p{Punct}]+", " "), r"\b(?:at|and|under|in|of|the|rt)\b", " "), " {2,}", " ")
        return Q.bind(key, lambda key: Q.bind(Q.named_struct({
            "keys": rf"split({key}, '\n')", "named": _phrases_in(rf"concat(' ', replace({key}, '\n', ' \n '), ' ')", rules),
            **{d: rf"if({found}.{d} = '', NULL, {Q.each(rf"split({found}.{d}, '\n')", _condition_of)})" for d in _STATED}, "units": rf"split({found}.unit, '\n')"}), with_keys))

    of = "map({})".format(", ".join(f"'{u}', '{d}'" for u, d in _UNIT_DIMENSION.items()))

    def with_keys(t: str) -> str:
        return Q.each_indexed(f"{t}.keys", lambda k, i: Q.bind(Q.named_struct({"key": f"trim({k})", "unit": _line(f"{t}.units", i)}), lambda h: Q.bind(
            Q.named_struct({"key": f"{h}.key", "padded": f"concat(' ', {h}.key, ' ')", "dimension": f"if({h}.unit = '', NULL, {of}[{h}.unit])"}), lambda g: Q.named_struct({
                "candidates": _candidates(g, f"{t}.named", rules), "unit": f"{h}.unit", **{d: f"get({t}.{d}, {i})" for d in _STATED}}))))

    column = "array<struct<candidates:array<struct<score:double,field:string>>,unit:string,temperature:struct<value:double,unit:string>,pressure:struct<value:double,unit:string>>>"
    return Q.bind(f"coalesce({cells}, array())", lambda c: f"if(size({c}) = 0, {Q.empty(column)}, {Q.bind(_plain_lines(c), with_text)})")


def _condition_of(stated: str) -> str:
    """SQL: value and unit of a condition given as number, tab and unit; null for none."""
    number = rf"replace(replace(substring_index({stated}, '\t', 1), '−', '-'), ',', '')"
    unit = rf"replace(substring_index({stated}, '\t', -1), ' ', '')"
    return rf"if({stated} IN ('', '\t'), NULL, named_struct('value', try_cast({number} AS double), 'unit', {unit}))"


def _phrases_in(keys: str, rules: TableRules) -> str:
    """SQL: the schema's phrases that occur in a text of padded words."""
    quoted = lambda text: "NULL" if text is None else f"'{text}'"
    phrases = "array({})".format(", ".join(
        f"named_struct('within', ' {p} ', 'phrase', '{p}', 'n', {len(p.split())}, 'field', '{f}', 'dimension', cast({quoted(rules.dimensions.get(f))} AS string))"
        for p, f in rules.phrases.items()))
    # Every blank of the text could begin a padded phrase, so the phrase alone is looked for first.
    return Q.bind(keys, lambda k: Q.keep(phrases, lambda c: f"contains({k}, {c}.phrase) AND contains({k}, {c}.within)"))


def _candidates(h: str, phrases: str, rules: TableRules) -> str:
    """SQL: the fields a heading may name, with their scores."""
    alone = _alone(rules)
    fits = lambda c: (
        f"(contains({h}.padded, {c}.within) AND coalesce({h}.dimension = {c}.dimension, {h}.dimension IS NULL OR {c}.dimension IS NOT NULL))")
    score = lambda c: (
        f"{c}.n / size(split({h}.key, ' ')) + if(endswith({h}.key, {c}.phrase), 0.1, 0) + if({h}.dimension = {c}.dimension, 0.25, 0)")
    named = Q.each(Q.keep(phrases, fits), lambda c: Q.named_struct({"score": f"cast({score(c)} AS double)", "field": f"{c}.field"}))
    none = "cast(array() AS array<struct<score:double,field:string>>)"
    unnamed = Q.case(*[
        (f"{h}.dimension = '{d}'", f"array(named_struct('score', cast({_LEAST_FIT} AS double), 'field', '{f}'))") for d, f in alone.items()],
        default=none) if alone else none
    return Q.bind(f"if({h}.key = '', {unnamed}, {named})", lambda found: Q.keep(found, lambda c: f"{c}.score >= {_LEAST_FIT}"))


def _n_known(headings: str) -> str:
    return f"size({Q.keep(headings, lambda h: f'size({h}.candidates) > 0')})"


def _carried(cells: str) -> str:
    """Empty cells repeat the one to their left."""
    return f"aggregate({cells}, cast(array() AS array<string>), (a, c) -> array_append(a, if({Q.matches("coalesce(c, '')", r'(?U)\S')}, c, coalesce(try_element_at(a, -1), ''))))"


def _is_number(cell: str) -> str:
    return Q.matches(f"trim(coalesce({cell}, ''))", rf"^{NUMBER}{SPREAD}\s*%?$")


def _assigned(headings: str, rules: TableRules) -> str:
    """SQL: the field of each column, '' for none: pairs by falling score, fields of the material once."""
    once = sorted(set(rules.phrases.values()) - rules.results - set(rules.conditions.values()))
    single = "array({})".format(", ".join(f"'{f}'" for f in once))
    pairs = f"flatten({Q.each_indexed(headings, lambda h, i: Q.each(f'{h}.candidates', lambda c: Q.named_struct({'score': f'-{c}.score', 'col': i, 'field': f'{c}.field'})))})"
    free = f"NOT exists(a, t -> t.col = p.col OR (t.field = p.field AND array_contains({single}, p.field)))"
    taken = f"aggregate(sort_array({pairs}), cast(array() AS array<struct<score:double,col:int,field:string>>), (a, p) -> if({free}, array_append(a, p), a))"
    return Q.bind(taken, lambda t: Q.each_indexed(headings, lambda h, i: f"coalesce(get(filter({t}, x -> x.col = {i}), 0).field, '')"))


def _layout(table: str, caption: str, rules: TableRules) -> str:
    """SQL: body rows, the columns' fields, units and conditions, the caption's conditions; null if no heading can name a result."""
    rows = f"coalesce({table}.rows, array())"
    down = Q.each(rows, lambda r: f"get({r}, 0)")
    first, second = f"coalesce(get({rows}, 0), array())", f"coalesce(get({rows}, 1), array())"
    both = f"zip_with({_carried(first)}, {second}, (a, b) -> concat(coalesce(a, ''), ' ', coalesce(b, '')))"
    below = f"(size({rows}) > 2 AND NOT exists({second}, c -> {_is_number('c')}))"
    width = f"coalesce(array_max({Q.each(rows, lambda r: f'size({r})')}), 0)"
    turned = f"if({width} > 0, transform(sequence(0, {width} - 1), j -> {Q.each(rows, lambda r: f'get({r}, j)')}), cast(array() AS array<array<string>>))"

    rest = lambda array, n: f"slice({array}, {n}, greatest(size({array}) - {n - 1}, 0))"
    is_result = f"array({', '.join(repr(r) for r in sorted(rules.results))})"
    has_result = lambda h: f"exists({h}, x -> exists(x.candidates, c -> array_contains({is_result}, c.field)))"

    def given(t: str) -> str:
        read = _read_all(f"concat({t}.first, {t}.second, {t}.both)", rules)
        parts = {"across": ("1", f"{t}.first"), "below": (f"size({t}.first) + 1", f"{t}.second"), "both": (f"size({t}.first) + size({t}.second) + 1", f"{t}.both")}
        whole = Q.bind(read, lambda h: Q.bind(Q.named_struct({n: f"slice({h}, {at}, size({of}))" for n, (at, of) in parts.items()}), chosen))
        return f"if({Q.matches(_lower_lines(f'concat({t}.first, {t}.both, {down})'), _may_name_result(rules))}, {whole}, NULL)"

    def chosen(h: str) -> str:
        tells = f"exists({h}.below, h -> size(h.candidates) > 0 OR h.unit <> '' OR h.temperature IS NOT NULL OR h.pressure IS NOT NULL)"
        as_read = Q.named_struct({"head": f"{h}.across", "body": rest(rows, 2)})
        joined = Q.named_struct({"head": f"{h}.both", "body": rest(rows, 3)})
        sideways = Q.bind(_read_all(down, rules), lambda d: f"if({has_result(d)} AND {_n_known(d)} > {_n_known(f'{h}.across')}, {Q.named_struct({'head': d, 'body': rest(turned, 2)})}, {as_read})")
        layout = Q.case((tells, joined), (f"NOT {has_result(f'{h}.across')}", sideways), default=as_read)
        return Q.bind(layout, lambda c: Q.bind(_assigned(f"{c}.head", rules), lambda fields: Q.named_struct({
            "body": f"{c}.body", "fields": fields, "units": Q.each(f"{c}.head", lambda h: f"{h}.unit"),
            "labels": _labels(f"{c}.head", fields, rules), "caption": Q.bind(_plain(caption), of_caption)})))

    of_caption = lambda text: Q.named_struct({d: _stated(text, d) for d in _STATED})
    none = Q.empty("array<string>")
    return Q.bind(below, lambda b: Q.bind(Q.named_struct({"first": first, "second": f"if({b}, {second}, {none})", "both": f"if({b}, {both}, {none})"}), given))


def _labels(head: str, fields: str, rules: TableRules) -> str:
    """SQL: for each column its set (results only): conditions as stated, or a number among the field's columns without any."""
    is_result = lambda f: f"array_contains(array({', '.join(repr(r) for r in sorted(rules.results))}), {f})"
    said = lambda h: f"({h}.temperature IS NOT NULL OR {h}.pressure IS NOT NULL)"
    earlier = lambda i: f"size(filter(sequence(0, {i}), k -> get({fields}, k) = get({fields}, {i}) AND NOT {said(f'get({head}, k)')})) - 1"
    return Q.each_indexed(head, lambda h, i: Q.named_struct({
        "name": f"CASE WHEN NOT {is_result(f'get({fields}, {i})')} THEN NULL WHEN {said(h)} THEN cast(struct({h}.temperature, {h}.pressure) AS string) ELSE concat('#', {earlier(i)}) END",
        "temperature": f"{h}.temperature", "pressure": f"{h}.pressure"}))


def _sets() -> str:
    """SQL: the sets of a table, in the order of their columns; '#0' serves the sets with conditions and is none beside them."""
    named = "filter(labels, x -> x.name IS NOT NULL)"
    distinct = Q.bind(named, lambda n: Q.keep_indexed(n, lambda x, i: f"NOT exists(slice({n}, 1, {i}), y -> y.name = {x}.name)"))
    return Q.bind(distinct, lambda d: f"if(exists({d}, x -> x.name NOT LIKE '#%'), filter({d}, x -> x.name <> '#0'), {d})")


def table_records(papers: DataFrame, rules: TableRules = ADSORPTION_TABLES) -> DataFrame:
    """papers(paper_id, title, doi, year, tables) -> paper_id, record_idx, table_idx, row_idx, set_idx, record.

    ``row_idx`` counts the body rows of a table, ``set_idx`` its result sets; ``record_idx`` tells all records of a paper
    apart, in that order, while a table has less than 10^6 rows and 10^3 sets. A cell is a number only as a whole (unit and spread aside), so
    ranges are null. A record repeats the paper's year, DOI and title; fields without a column are null.
    """
    paper = ["paper_id", "title", "doi", "year"]
    parts = papers.schema["tables"].dataType.elementType.fieldNames()
    caption = (lambda t: f"{t}.caption") if "caption" in parts else (lambda t: "''")
    tables = fan_out(papers, paper, F.expr(Q.each("tables", lambda t: _layout(t, caption(t), rules))), "table_idx", "h")
    # No field of a struct is used inside a generator: the optimizer extracts it below and then loses other columns.
    tables = tables.where("h IS NOT NULL").select(*paper, "table_idx", "h.*")
    tables = tables.withColumn("sets", F.expr(_sets())).withColumn("places", F.expr(_places(rules)))
    sets = fan_out(tables, [*paper, "table_idx", "body", "units", "caption", "sets", "places"], "places", "set_idx", "at")
    sets = sets.withColumn("own", F.get("sets", F.col("set_idx")))
    n = len(rules.results)
    others = f"if(set_idx = 0, flatten(transform(slice(places, 2, size(places)), p -> slice(p, 1, {n}))), NULL)"
    of_set = _of_set(rules)
    sets = sets.select(*paper, "table_idx", "set_idx", "body", "at", F.expr(others).alias("others"), *[c.alias(name) for name, c in of_set.items()])
    rows = fan_out(sets, [*paper, "table_idx", "set_idx", "at", "others", *of_set], "body", "row_idx", "cells")
    filled = lambda i: Q.matches(f"coalesce(get(cells, {i}), '')", rf"^(?U)\s*{NUMBER}{SPREAD}[^0-9]*$")
    own = " OR ".join(filled(f"get(at, {k})") for k in range(n))
    return _records(rows.where(f"(set_idx = 0 AND NOT exists(others, i -> {filled('i')})) OR {own}"), rules)


def _paths(rules: TableRules) -> list[str]:
    """The fields that columns can hold, results first."""
    return [*sorted(rules.results), *sorted(set(rules.phrases.values()) - rules.results)]


def _places(rules: TableRules) -> str:
    """SQL: for each set the column of each field.

    Of a result its own column, else the one without conditions; of another field the column with the set's number, else the last one.
    """
    paths = _paths(rules)
    array = lambda fields: "array({})".format(", ".join(f"'{f}'" for f in fields))
    columns = lambda test: f"filter(transform(labels, (x, i) -> if({test}, i, NULL)), i -> i IS NOT NULL)"
    named = lambda name: f"get({columns(f'x.name = {name} AND get(fields, i) = f')}, 0)"
    held = lambda column: f"if(array_contains(fields, f), {column}, NULL)"
    results = f"transform({array(paths[:len(rules.results)])}, f -> {held(f"coalesce({named('s.name')}, {named(repr('#0'))})")})"
    numbered = held(Q.bind(columns("get(fields, i) = f"), lambda c: f"get({c}, least(k, size({c}) - 1))"))
    return f"transform(sets, (s, k) -> concat({results}, transform({array(paths[len(rules.results):])}, f -> {numbered})))"


def _scaled(path: str, rules: TableRules) -> bool:
    """Are numbers of the field converted to its declared unit?"""
    return path not in rules.stated_units and rules.dimensions.get(path) in UNITS


def _of_set(rules: TableRules) -> dict[str, Column]:
    """What holds for all rows of a set: scales or units of its columns, conditions of its headings and of the caption."""
    paths = _paths(rules)
    written = lambda unit: F.coalesce(
        F.create_map(*[F.lit(x) for pair in _WRITTEN.items() for x in pair])[unit], null_if_empty(unit))
    of_set = {}
    for k, path in enumerate(paths):
        unit = F.expr(f"get(units, get(at, {k}))")
        if _scaled(path, rules):
            of_set[f"factor_{k}"], of_set[f"offset_{k}"] = scale_of_unit(unit, rules.dimensions[path])
        if path in rules.stated_units:
            of_set[f"unit_{k}"] = written(unit)
    for name, path in rules.conditions.items():
        for place in ("own", "caption"):
            said = F.col(f"{place}.{name}")
            if path in rules.stated_units:
                of_set[f"{place}_{name}"], of_set[f"{place}_{name}_unit"] = said["value"], written(said["unit"])
            else:
                of_set[f"{place}_{name}"] = to_declared_unit(said["value"], said["unit"], rules.dimensions[path])
    return of_set


def _records(rows: DataFrame, rules: TableRules) -> DataFrame:
    schema = rules.schema
    paths = _paths(rules)
    kinds = dict(schema.leaves())
    metadata = {"study_metadata.year": "year", "study_metadata.doi": "doi", "study_metadata.title": "title"}
    units_field = {unit: value for value, unit in rules.stated_units.items()}
    condition_of = {path: name for name, path in rules.conditions.items()}

    # A cell is read and a number parsed once, in columns of their own, however many fields of the record use them.
    rows = rows.select("*", *[F.expr(Q.null_if_empty(Q.strip(f"get(cells, get(at, {k}))"))).alias(f"cell_{k}") for k in range(len(paths))])
    numbers = {}
    for k, path in enumerate(paths):
        if not isinstance(kinds[path], (T.StringType, T.ArrayType)):
            value = cell_number(F.col(f"cell_{k}"))
            numbers[f"number_{k}"] = value * F.col(f"factor_{k}") + F.col(f"offset_{k}") if _scaled(path, rules) else value
    rows = rows.select("*", *[value.alias(name) for name, value in numbers.items()])
    of = lambda prefix, path: F.col(f"{prefix}_{paths.index(path)}")

    def value(path: str, kind: T.DataType) -> Column:
        if path in metadata:
            return F.col(metadata[path]).cast(kind)
        if path in units_field:
            number, unit = of("number", units_field[path]), of("unit", units_field[path])
            from_cells = F.when(number.isNotNull(), unit)
            if units_field[path] not in condition_of:
                return from_cells
            name = condition_of[units_field[path]]
            return F.coalesce(F.col(f"own_{name}_unit"), F.when(number.isNull(), F.col(f"caption_{name}_unit")), from_cells)
        if path in condition_of:
            name = condition_of[path]
            return F.coalesce(F.col(f"own_{name}"), of("number", path), F.col(f"caption_{name}")).cast(kind)
        if path not in paths:
            return F.array().cast("array<string>") if isinstance(kind, T.ArrayType) else F.lit(None).cast(kind)
        if isinstance(kind, T.ArrayType):
            return F.when(of("cell", path).isNull(), F.array().cast("array<string>")).otherwise(F.array(of("cell", path)))
        return of("cell", path) if isinstance(kind, T.StringType) else of("number", path).cast(kind)

    out = []
    for f in schema.record.fields:
        if isinstance(f.dataType, T.StructType):
            out.append(F.struct(*[value(f"{f.name}.{c.name}", c.dataType).alias(c.name) for c in f.dataType.fields]).alias(f.name))
        else:
            out.append(value(f.name, f.dataType).alias(f.name))
    record_idx = F.col("table_idx").cast("long") * 1_000_000_000 + F.col("row_idx") * 1000 + F.col("set_idx")
    return rows.select(
        "paper_id", record_idx.alias("record_idx"), "table_idx", "row_idx", "set_idx", F.struct(*out).alias("record"))
