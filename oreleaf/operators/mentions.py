"""What a text says about which material: measurements bound to the mention before them, and evidence with its place.

All work is done within the row of a text. A text is cut at the matches of one pattern; the
matches and the pieces between them give every match its place, in characters and in
words (white space before it), by one running sum. Materials are the paper's own: their names
become the pattern, longest first, and count as whole names only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreleaf.functions import sqltext as Q
from oreleaf.functions.frames import fan_out
from oreleaf.operators.rules import BEFORE, NUMBER, SPREAD, TEXT_UNITS, UNITS, number_value
from oreleaf.operators.tables import ADSORPTION_TABLES, TableRules

REACH = 50  # words between a mention and what is said of it
_UNITS = "|".join(units for _, units in TEXT_UNITS.values())
MEASUREMENT = rf"{BEFORE}{NUMBER}{SPREAD}\s*(?:{_UNITS})(?![\w/])"
# A number that is not a reference in brackets and not part of a word, a range or another number.
PLAIN_NUMBER = rf"{BEFORE}(?<![\[(])(?<!\[[0-9, –-]{{1,40}}){NUMBER}{SPREAD}(?![\w\]])(?!\.[0-9])(?!\s?[-–][0-9])"
_DIMENSION = {unit: dimension for dimension, units in TEXT_UNITS.values() for unit in units.split("|")}


_BLOCK = 256  # matches whose running sum is taken in one fold; a fold copies what it has made, so long ones are cut
_PLACES = "array<struct<match:string,first:int,word:int>>"


def placed(text: str, pattern: str) -> str:
    """SQL: the matches of a pattern (SQL text) as structs match, first, word; first counts characters from 0."""
    cut = Q.named_struct({"found": f"regexp_extract_all({text}, {pattern}, 0)", "between": f"split({text}, {pattern}, -1)"})
    white = lambda s: f"regexp_count({s}, r'\\s+')"
    # Each match with the piece before it: their lengths and white space.
    sized = lambda c: (
        f"zip_with({c}.found, slice({c}.between, 1, size({c}.found)), (f, b) -> named_struct('match', f, 'at', length(b), 'words', {white('b')}, "
        f"'long', length(b) + length(f), 'wide', {white('b')} + {white('f')}))")

    def summed(all_: str) -> str:
        blocks = f"transform(sequence(0, (size({all_}) - 1) div {_BLOCK}), k -> slice({all_}, k * {_BLOCK} + 1, {_BLOCK}))"
        start = "named_struct('first', 0, 'word', 0)"
        total = f"aggregate(blk, {start}, (a, p) -> named_struct('first', a.first + p.long, 'word', a.word + p.wide))"
        offsets = lambda blks: (
            f"aggregate(transform({blks}, blk -> {total}), array({start}), (a, t) -> array_append(a, named_struct('first', element_at(a, -1).first + t.first, 'word', element_at(a, -1).word + t.word)))")
        step = ("named_struct('first', a.first + p.long, 'word', a.word + p.wide, "
                "'out', array_append(a.out, named_struct('match', p.match, 'first', a.first + p.at, 'word', a.word + p.words)))")
        within = f"aggregate(blk, named_struct('first', off.first, 'word', off.word, 'out', cast(array() AS {_PLACES})), (a, p) -> {step}, a -> a.out)"
        return Q.let(blocks, lambda blks: f"flatten(zip_with({blks}, slice({offsets(blks)}, 1, size({blks})), (blk, off) -> {within}))")

    return Q.let(cut, lambda c: Q.let(sized(c), lambda all_: f"if(size({all_}) > 0, {summed(all_)}, cast(array() AS {_PLACES}))"))


def name_pattern(names: str) -> str:
    """SQL: the pattern of whole names, longest first; one that matches nothing if there are none."""
    known = f"array_sort(filter(array_distinct({names}), n -> n IS NOT NULL AND trim(n) <> ''), (a, b) -> CASE WHEN length(a) <> length(b) THEN length(b) - length(a) WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END)"
    quoted = Q.let(known, lambda k: f"if(size({k}) > 0, concat(r'(?<![\\w-])(?:', array_join(transform({k}, n -> concat(r'\\Q', replace(n, r'\\E', ''), r'\\E')), '|'), r')(?![\\w-])'), r'(?!)')")
    return quoted


def _with_names(texts: DataFrame, materials: DataFrame, keep: list[str]) -> DataFrame:
    """The texts with the pattern of their paper's materials; names are one row per paper before they meet the texts."""
    names = materials.groupBy(F.col("paper_id").alias("_paper")).agg(F.collect_set("material_id").alias("names"))
    joined = texts.join(names, F.col("paper_id") == F.col("_paper"), "left")
    return joined.select(*keep, F.expr(name_pattern("coalesce(names, array())")).alias("pattern"))


def _value(match: str) -> str:
    return number_value(Q.extract(match, NUMBER))


def _unit(match: str) -> str:
    return Q.extract(match, rf"^{NUMBER}{SPREAD}\s*(.*)$", 1)


def bound_measurements(sections: DataFrame, materials: DataFrame, reach: int = REACH) -> DataFrame:
    """sections(paper_id, section_idx, text) + materials(paper_id, material_id) -> each measurement with its material.

    Returns paper_id, section_idx, match_idx (in the order of the text), dimension, value, unit, first, material_id, distance.
    The material is the one mentioned last before the measurement in the same section, at most ``reach`` words
    before it; null without one. Of names that begin at one place the longest counts.
    """
    given = _with_names(sections.select("paper_id", "section_idx", "text"), materials, ["paper_id", "section_idx", "text"])
    dimension_of = "map({})".format(", ".join(f"'{u}', '{d}'" for u, d in _DIMENSION.items()))
    found = Q.named_struct({"measured": placed("coalesce(text, '')", Q.literal(MEASUREMENT)), "named": placed("coalesce(text, '')", "pattern")})

    def bound(f: str) -> str:
        def row(m: str) -> str:
            last = f"try_element_at(filter({f}.named, n -> n.first < {m}.first AND {m}.word - n.word <= {reach}), -1)"
            return Q.let(Q.named_struct({"near": last, "unit": _unit(f"{m}.match")}), lambda b: Q.named_struct({
                "dimension": f"{dimension_of}[{b}.unit]", "value": _value(f"{m}.match"), "unit": f"{b}.unit", "first": f"{m}.first",
                "material_id": f"{b}.near.match", "distance": f"{m}.word - {b}.near.word"}))
        return Q.each(f"{f}.measured", row)

    return fan_out(given, ["paper_id", "section_idx"], F.expr(Q.let(found, bound)), "match_idx", "m").select(
        "paper_id", "section_idx", "match_idx", "m.dimension", "m.value", "m.unit", "m.first", "m.material_id", "m.distance")


def evidence_spans(validated: DataFrame, docs: DataFrame, rules: TableRules = ADSORPTION_TABLES, reach: int = REACH) -> DataFrame:
    """Where a paper's text states each number of each record.

    validated(paper_id, rows) + docs(paper_id, llm_text) -> paper_id, row_idx, field, value, supported, first, end, distance.
    A value of a field with a declared unit must stand with a unit of that dimension and be equal to it once converted; other numbers must
    stand alone, so neither in a reference in brackets nor within a range or a word. Both must stand within ``reach``
    words of a mention of the record's material, before or after it; a record without a material needs no mention.
    The span (characters from 0) is that of the nearest occurrence, the first of equally near ones; null without one. Without
    a document ``supported`` is null.
    """
    numbers = [(path, rules.dimensions.get(path)) for path, kind in rules.schema.leaves()
               if kind.typeName() in ("double", "integer") and not path.startswith("study_metadata.")]
    numbers = [(path, d if d in UNITS else None) for path, d in numbers if path not in rules.stated_units]
    joined = validated.select("paper_id", "rows").join(docs.select(F.col("paper_id").alias("_doc"), "llm_text"), F.col("paper_id") == F.col("_doc"), "left")
    given = joined.select("paper_id", "rows", "llm_text", F.expr(name_pattern("transform(rows, r -> r.material_id)")).alias("pattern"))
    factor = lambda d, k: "map({})".format(", ".join(f"'{u}', double({v[k]!r})" for u, v in UNITS[d].items()))
    key = lambda m: f"lower(regexp_replace({_unit(f'{m}.match')}, r'\\s+', ''))"
    dimension_of = "map({})".format(", ".join(f"'{u.lower()}', '{d}'" for u, d in _DIMENSION.items()))

    def measured(m: str) -> str:
        def converted(b: str) -> str:
            value = Q.case(*[(f"{b}.dimension = '{d}'", f"{b}.value * {factor(d, 0)}[{b}.unit] + {factor(d, 1)}[{b}.unit]") for d in UNITS])
            return Q.named_struct({"dimension": f"{b}.dimension", "value": value, "first": f"{m}.first", "end": f"{m}.first + length({m}.match)", "word": f"{m}.word"})
        return Q.let(key(m), lambda u: Q.let(Q.named_struct({"unit": u, "dimension": f"{dimension_of}[{u}]", "value": _value(f"{m}.match")}), converted))

    alone = lambda m: Q.named_struct({
        "dimension": "cast(NULL AS string)", "value": _value(f"{m}.match"), "first": f"{m}.first", "end": f"{m}.first + length({m}.match)", "word": f"{m}.word"})
    text = "coalesce(llm_text, '')"
    places = f"concat({Q.each(placed(text, Q.literal(MEASUREMENT)), measured)}, {Q.each(placed(text, Q.literal(PLAIN_NUMBER)), alone)})"
    indexed = given.select("paper_id", "rows", F.col("llm_text").isNotNull().alias("known"), F.expr(places).alias("places"), F.expr(placed(text, "pattern")).alias("named"))
    each = fan_out(indexed, ["paper_id", "known", "places", "named"], "rows", "row_idx", "record")
    asked = "array({})".format(", ".join(Q.named_struct({
        "field": f"'{path}'", "dimension": f"cast({'NULL' if d is None else repr(d)} AS string)", "value": f"cast(record.{path} AS double)"}) for path, d in numbers))

    def answered(q: str) -> str:
        same = f"p.dimension <=> {q}.dimension AND abs(p.value - {q}.value) <= 1e-6 * greatest(1D, abs({q}.value))"
        near = "array_min(transform(filter(named, n -> n.match = record.material_id), n -> abs(p.word - n.word)))"
        held = f"transform(filter(places, p -> {same}), p -> named_struct('distance', if(trim(coalesce(record.material_id, '')) = '', 0, {near}), 'first', p.first, 'end', p.end))"
        best = f"array_min(filter({held}, p -> p.distance <= {reach}))"
        return Q.let(best, lambda b: Q.named_struct({
            "field": f"{q}.field", "value": f"{q}.value", "supported": f"if(known, {b} IS NOT NULL, NULL)", "first": f"{b}.first", "end": f"{b}.end", "distance": f"{b}.distance"}))

    filled = Q.each(Q.keep(asked, lambda q: f"{q}.value IS NOT NULL"), answered)
    return fan_out(each, ["paper_id", "row_idx"], F.expr(filled), "_i", "e").select("paper_id", "row_idx", "e.*")
