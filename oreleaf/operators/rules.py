"""Rule-based extraction: numbers and units, measurements from text, use cases from mentions.

The rule sets are small dictionaries in the job's code. They become literals of
the expressions, so applying them needs neither a join nor a broadcast, and
tables and sections are read within their own row.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreleaf.functions import sqltext as Q
from oreleaf.functions.frames import fan_out
from oreleaf.functions.text import null_if_empty

# Unit -> (factor, offset) to the declared unit of each dimension
# (degrees Celsius, bar, mmol/g; CO2 has 44.01 g/mol).
UNITS: dict[str, dict[str, tuple[float, float]]] = {
    "temperature": {"c": (1.0, 0.0), "°c": (1.0, 0.0), "k": (1.0, -273.15)},
    "pressure": {"bar": (1.0, 0.0), "mbar": (0.001, 0.0), "atm": (1.01325, 0.0), "kpa": (0.01, 0.0),
                 "mpa": (10.0, 0.0), "pa": (0.00001, 0.0)},
    "capacity": {"mmol/g": (1.0, 0.0), "mol/kg": (1.0, 0.0), "mg/g": (1.0 / 44.01, 0.0)},
}

# A whole number token: thousands groups, decimals, an exponent as e-3 or × 10^-3.
NUMBER = (r"[-+−]?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?"
           r"(?:[eE][-+−]?[0-9]+|\s*[×x]\s*10\s*\^?\s*[-+−]?[0-9]+)?")
SPREAD = r"(?:\s*±\s*[0-9]+(?:\.[0-9]+)?)?"
# What may stand before a number in text: no digit, word, comma or point, and no dash, sign or exponent that makes it
# the second part of a range or of another number.
BEFORE = r"(?<![\w.,^])(?<![-–−+±×]\s?)(?<![0-9]\s?(?=[-+−]))"


def _literal_map(mapping: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def to_declared_unit(value: Column, unit: Column, dimension: str) -> Column:
    """``value`` in the dimension's declared unit; null for an unknown unit.

    An absent or empty unit means that the value already is in the declared one.
    """
    return _convert(value, _unit_key(unit), dimension)


def scale_of_unit(unit: Column, dimension: str) -> tuple[Column, Column]:
    """Factor and offset to the dimension's declared unit, as :func:`to_declared_unit` applies them."""
    return _scale(_unit_key(unit), dimension)


def number_value(token: str) -> str:
    """SQL: the value of a number token, null for a null or empty one."""
    plain = Q.replace_all(f"replace(replace({token}, ',', ''), '−', '-')", r"\s*[×x]\s*10\s*\^?\s*", "e")
    return f"try_cast({plain} AS double)"


def cell_number(cell: Column) -> Column:
    """The number a cell is as a whole, unit and spread aside."""
    token = F.regexp_extract(cell, rf"^({NUMBER}){SPREAD}[^0-9]*$", 1)
    plain = F.translate(token, "−,", "-")
    power = F.regexp_replace(plain, r"\s*[×x]\s*10\s*\^?\s*", "e")
    return null_if_empty(F.when(F.contains(plain, F.lit("10")), power).otherwise(plain)).try_cast("double")


def _unit_key(unit: Column) -> Column:
    return F.lower(F.regexp_replace(unit, r"(?U)\s+", ""))


def _scale(key: Column, dimension: str) -> tuple[Column, Column]:
    units = UNITS[dimension]
    factor = F.coalesce(_literal_map({u: f for u, (f, _) in units.items()})[key], F.when(F.coalesce(key, F.lit("")) == "", 1.0))
    offset = F.coalesce(_literal_map({u: o for u, (_, o) in units.items()})[key], F.lit(0.0))
    return factor, offset


def _convert(value: Column, key: Column, dimension: str) -> Column:
    factor, offset = _scale(key, dimension)
    return value * factor + offset


def normalize_units(measurements: DataFrame) -> DataFrame:
    """measurements(..., dimension, value, unit) -> adds ``normal_value``."""
    by_dimension = None
    for name in UNITS:
        converted = _convert(F.col("value"), F.col("_unit"), name)
        test = F.col("dimension") == name
        by_dimension = F.when(test, converted) if by_dimension is None else by_dimension.when(test, converted)
    keyed = measurements.withColumn("_unit", _unit_key(F.col("unit")))
    return keyed.withColumn("normal_value", by_dimension).drop("_unit")


# Field -> (dimension, unit alternatives) of measurements in running text.
TEXT_UNITS: dict[str, tuple[str, str]] = {
    "temperature": ("temperature", "°C|K"),
    "pressure": ("pressure", "mbar|bar|atm|kPa|MPa|Pa"),
    "capacity": ("capacity", "mmol/g|mol/kg|mg/g"),
}


def text_measurements(sections: DataFrame, text_units: Mapping[str, tuple[str, str]] = TEXT_UNITS) -> DataFrame:
    """sections(paper_id, section_idx, text) -> each number followed by a known unit.

    Returns paper_id, section_idx, field, match_idx, dimension, value, unit in the
    order of the matches within a field.
    """
    per_field = []
    for name, (dimension, units) in text_units.items():
        pattern = Q.literal(rf"{BEFORE}{NUMBER}{SPREAD}\s*(?:{units})(?![\w/])")
        per_field.append(Q.each_indexed(f"regexp_extract_all(text, {pattern}, 0)", lambda m, i: Q.named_struct({
            "field": f"'{name}'", "match_idx": i, "dimension": f"'{dimension}'",
            "value": number_value(Q.extract(m, NUMBER)),
            "unit": Q.extract(m, rf"^{NUMBER}{SPREAD}\s*(.*)$", 1)})))
    matches = F.expr(f"concat({', '.join(per_field)})")
    return (
        fan_out(sections, ["paper_id", "section_idx"], matches, "i", "m")
        .select("paper_id", "section_idx", "m.*")
    )


def use_cases(mentions: DataFrame, lexicon: Mapping[str, str]) -> DataFrame:
    """mentions(paper_id, material_id, text) -> paper_id, material_id, use_cases.

    ``lexicon`` maps a pattern to the "<role> <target>" phrase it stands for. The
    aggregate keeps one flag per phrase, so its buffers are as wide as the lexicon
    and no wider, however often a material is mentioned. Materials without a match
    keep an empty list.
    """
    phrases = sorted(set(lexicon.values()))
    flags = []
    for i, phrase in enumerate(phrases):
        patterns = "|".join(f"(?:{p})" for p, v in lexicon.items() if v == phrase)
        flags.append(F.max(F.coalesce(F.col("text").rlike(patterns), F.lit(False))).alias(f"f{i}"))
    found = F.filter(
        F.array(*[F.when(F.col(f"f{i}"), F.lit(p)) for i, p in enumerate(phrases)]), lambda p: p.isNotNull())
    return (mentions.groupBy("paper_id", "material_id").agg(*flags)
            .select("paper_id", "material_id", found.alias("use_cases")))
