"""Measurements bound to materials and evidence with its place."""
import pytest

from oreleaf.operators import mentions as N, responses as R
from oreleaf.schemas import ADSORPTION

TEXT = "LDH-1 took up 2.5 mmol/g at 25 °C and 1 bar [3], whereas LDH-1b (dried) took up 44.01 mg/g. " + "Filler words. " * 30 + "At 300 K nothing is known of xLDH-1."


def bound(spark, text, names, **options):
    sections = spark.createDataFrame([("p", 0, text)], "paper_id string, section_idx int, text string")
    materials = spark.createDataFrame([("p", n) for n in names], "paper_id string, material_id string")
    return [(r["dimension"], r["value"], r["unit"], r["material_id"]) for r in N.bound_measurements(sections, materials, **options).orderBy("match_idx").collect()]


def test_the_last_mention_before_counts(spark):
    assert bound(spark, TEXT, ["LDH-1", "LDH-1b", None, " ", "LDH-1"]) == [
        ("capacity", 2.5, "mmol/g", "LDH-1"), ("temperature", 25.0, "°C", "LDH-1"), ("pressure", 1.0, "bar", "LDH-1"),
        ("capacity", 44.01, "mg/g", "LDH-1b"), ("temperature", 300.0, "K", None)]
    assert bound(spark, TEXT, ["LDH-1", "LDH-1b"], reach=100)[-1] == ("temperature", 300.0, "K", "LDH-1b")


@pytest.mark.parametrize("text,names,want", [
    ("2 mmol/g for A", ["A"], [("capacity", 2.0, "mmol/g", None)]), ("", ["A"], []), (None, ["A"], []), ("A+B (x) 1 bar", ["A+B (x)", "A"], [("pressure", 1.0, "bar", "A+B (x)")]),
    ("A 1 bar", [], [("pressure", 1.0, "bar", None)]), ("A, B: 1 bar and 2 bar; A 3 bar", ["A", "B"], [("pressure", 1.0, "bar", "B"), ("pressure", 2.0, "bar", "B"), ("pressure", 3.0, "bar", "A")]),
])
def test_binding(spark, text, names, want):
    assert bound(spark, text, names) == want


def test_places_are_those_of_the_text(spark):
    sections = spark.createDataFrame([("p", 0, TEXT)], "paper_id string, section_idx int, text string")
    got = N.bound_measurements(sections, spark.createDataFrame([("p", "LDH-1")], "paper_id string, material_id string")).collect()
    assert all(TEXT[r["first"]:].startswith(("2.5 mmol/g", "25 °C", "1 bar", "44.01 mg/g", "300 K")) for r in got) and len(got) == 5
    assert got[0]["distance"] == 3


def evidence(spark, text, **fields):
    record = R.nest(lambda path, kind: f"cast({fields[path.rsplit('.', 1)[-1]]!r} AS {kind.simpleString()})" if path.rsplit(".", 1)[-1] in fields else
                    f"cast({'array()' if kind.typeName() == 'array' else 'NULL'} AS {kind.simpleString()})", ADSORPTION)
    validated = spark.range(1).selectExpr("'p' AS paper_id", f"array({record}) AS rows")
    docs = spark.createDataFrame([("p", text)], "paper_id string, llm_text string")
    return {r["field"].rsplit(".", 1)[-1]: (r["supported"], text and r["first"] is not None and text[r["first"]:r["end"]] or None) for r in N.evidence_spans(validated, docs).collect()}


def test_evidence_needs_its_unit_and_its_material(spark):
    assert evidence(spark, TEXT, material_id="LDH-1", co2_adsorption_capacity_mmol_g=2.5, pressure_bar=1, adsorption_temperature_c=25) == {
        "co2_adsorption_capacity_mmol_g": (True, "2.5 mmol/g"), "pressure_bar": (True, "1 bar"), "adsorption_temperature_c": (True, "25 °C")}
    # Converted units; a number that stands in brackets as a reference, or too far from the material, is no evidence.
    assert evidence(spark, TEXT, material_id="LDH-1b", co2_adsorption_capacity_mmol_g=1.0, ph=3, adsorption_temperature_c=26.85) == {
        "co2_adsorption_capacity_mmol_g": (True, "44.01 mg/g"), "ph": (False, None), "adsorption_temperature_c": (False, None)}
    assert evidence(spark, TEXT, material_id="other", pressure_bar=1) == {"pressure_bar": (False, None)}
    assert evidence(spark, TEXT, pressure_bar=1) == {"pressure_bar": (True, "1 bar")}


@pytest.mark.parametrize("text,value,found", [
    ("M at pH 9.5 was", 9.5, "9.5"), ("M see [1] and [2, 3]", 3, None), ("M 10-20", 20, None), ("M v1.5", 1.5, None), ("M gave 1,000 of", 1000, "1,000"), ("", 1, None), ("M (pH 7)", 7, "7"),
])
def test_numbers_without_a_unit(spark, text, value, found):
    assert evidence(spark, text, material_id="M", ph=value) == {"ph": (found is not None, found)}


def test_without_a_document(spark):
    assert evidence(spark, None, material_id="M", ph=7) == {"ph": (None, None)}


def test_many_matches(spark):
    text = " ".join(f"M{i % 7} {'x ' * (i % 3)}{i} bar" for i in range(1500))
    sections = spark.createDataFrame([("p", 0, text)], "paper_id string, section_idx int, text string")
    materials = spark.createDataFrame([("p", f"M{i}") for i in range(7)], "paper_id string, material_id string")
    got = N.bound_measurements(sections, materials).orderBy("match_idx").collect()
    assert [(r["value"], r["material_id"], r["distance"]) for r in got] == [(float(i), f"M{i % 7}", 1 + i % 3) for i in range(1500)]
    assert all(text[r["first"]:].startswith(f"{i} bar") for i, r in enumerate(got))
