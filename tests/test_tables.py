"""Tables to records: headings, conditions, orientation, result sets."""
import pytest

from oreleaf.operators import consolidation as C, tables as X
from oreleaf.schemas import ADSORPTION, CATALYST

PAPER = "paper_id string, title string, doi string, year int, tables array<struct<label:string,caption:string,rows:array<array<string>>>>"


def read(spark, tables, rules=X.ADSORPTION_TABLES):
    """Records as (table, row, set, record) of tables given as rows or (caption, rows)."""
    made = [("1", *t) if isinstance(t, tuple) else ("1", "", t) for t in tables]
    df = X.table_records(spark.createDataFrame([("p", "T", "D", 2020, made)], PAPER), rules)
    return sorted(((r["table_idx"], r["row_idx"], r["set_idx"], r["record"].asDict(True)) for r in df.collect()), key=lambda r: r[:3])


def short(records):
    """(material, capacity, temperature, pressure) of adsorption records."""
    keys = ("co2_adsorption_capacity_mmol_g", "adsorption_temperature_c", "pressure_bar")
    return [(r["material_id"], *(v if (v := r["measurement"][k]) is None else round(v, 6) for k in keys)) for *_, r in records]


def shown(records):
    """(material, conversion, CO, CH4, methanol, temperature, unit, pressure, unit) of catalyst records."""
    keys = ("co2_conversion", "co_selectivity", "ch4_selectivity", "methanol_selectivity", "temperature", "temperature_units", "pressure", "pressure_units")
    return [(r["material_id"], *(r["performance"][k] for k in keys)) for *_, r in records]


def test_table_records(spark):
    rows = [["Sample", "CO2 uptake (mg/g)", "Pressure [kPa]", "T (K)", "note", "Uptake (mmol/g)"],
            ["A", "44.01", "100", "298.15 ± 1", "x", "7"], ["B", "", "n/a", "300"]]
    got = read(spark, [("cap", rows), ("none", [["x", "y"], ["1", "2"]]), ("head only", [["Sample"]])])
    assert [(r[0], r[1], r[3]["material_id"]) for r in got] == [(0, 0, "A"), (0, 0, "A"), (0, 1, "B")]
    assert short(got) == [("A", 1.0, 25.0, 1.0), ("A", 7.0, 25.0, 1.0), ("B", None, 26.85, None)]
    a = got[0][3]
    assert a["study_metadata"] == {"year": 2020, "doi": "D", "title": "T"} and a["material_properties"]["anions"] == []
    assert list(a) == [f.name for f in ADSORPTION.record.fields]


def test_table_numbers_and_repeated_columns(spark):
    rows = [["Sample", "Pressure (kPa)", "CO2 uptake (mmol/g)", "CO2 uptake (mg/g)", "pH"],
            ["A", "1,000", "1.2e-3", "44.01 ± 2", "7 (measured)"], ["B", "10-20", "", "x", "8"]]
    got = read(spark, [rows])
    assert [r[:3] for r in got] == [(0, 0, 0), (0, 0, 1), (0, 1, 0)]
    assert short(got) == [("A", 0.0012, None, 10.0), ("A", 1.0, None, 10.0), ("B", None, None, None)]
    assert [r[3]["synthesis_method"]["ph"] for r in got] == [7.0, 7.0, 8.0]


@pytest.mark.parametrize("heading,want", [
    ("Uptake 25 °C (mmol/g)", (2.0, 25.0, None)), ("CO2 uptake at 1 bar (mmol/g)", (2.0, None, 1.0)), ("CO2 uptake (mg/g) at 298.15 K and 100 kPa", (2 / 44.01, 25.0, 1.0)),
    ("CO2 uptake / mmol g-1", (2.0, None, None)), ("Uptake [mmol·g−1] (50 ºC, 0.15 bar)", (2.0, 50.0, 0.15)), ("CO2 adsorbed, mmol/g", (2.0, None, None)),
    ("Capacity (cm3/g)", (None, None, None)), ("(mmol/g)", (2.0, None, None)), ("Uptake of CO2 at RT", (2.0, None, None)), ("CO2 CAPACITY (mol kg-1)", (2.0, None, None)),
])
def test_headings(spark, heading, want):
    got = short(read(spark, [[["Sample", heading], ["A", "2"]]]))
    assert [(m, *v) for m, *v in got] == [("A", *(None if w is None else round(w, 6) for w in want))]


@pytest.mark.parametrize("heading", ["Uptake rate constant of the sorbent", "Temperature (mmol/g)", "note", "", "Pressure (bar)", "BET area (m2/g)"])
def test_other_headings_are_no_results(spark, heading):
    assert read(spark, [[["Sample", heading], ["A", "2"]]]) == []


def test_sets_by_condition(spark):
    rows = [["Material", "Uptake 25 °C (mmol/g)", "Uptake 50 °C (mmol/g)", "P (bar)"], ["A", "2", "1.5", "1"], ["B", "", "0.5", "2"], ["C", "-", "", "3"]]
    assert short(read(spark, [rows])) == [("A", 2.0, 25.0, 1.0), ("A", 1.5, 50.0, 1.0), ("B", 0.5, 50.0, 2.0), ("C", None, 25.0, 3.0)]


def test_heading_column_and_caption_in_that_order(spark):
    caption = "Table 1. CO2 uptake at 30 °C and 2 bar"
    assert short(read(spark, [(caption, [["Sample", "Uptake (mmol/g)"], ["A", "1"]])])) == [("A", 1.0, 30.0, 2.0)]
    assert short(read(spark, [(caption, [["Sample", "Uptake 60 °C (mmol/g)", "T (°C)"], ["A", "1", "45"]])])) == [("A", 1.0, 60.0, 2.0)]
    assert short(read(spark, [(caption, [["Sample", "Uptake (mmol/g)", "T (°C)"], ["A", "1", "45"], ["B", "1", ""]])])) == [("A", 1.0, 45.0, 2.0), ("B", 1.0, 30.0, 2.0)]


def test_transposed_table(spark):
    rows = [["Sample", "LDH-1", "LDH-2"], ["CO2 uptake (mmol/g)", "1.5", "2.5"], ["Temperature (°C)", "25", "35"], ["pH", "9", "10"]]
    got = read(spark, [rows])
    assert short(got) == [("LDH-1", 1.5, 25.0, None), ("LDH-2", 2.5, 35.0, None)]
    assert [r[3]["synthesis_method"]["ph"] for r in got] == [9.0, 10.0]


def test_two_heading_rows(spark):
    rows = [["Sample", "CO2 uptake (mmol/g)", "", "pH"], ["", "25 °C", "50 °C", ""], ["A", "2", "1", "9"]]
    assert short(read(spark, [rows])) == [("A", 2.0, 25.0, None), ("A", 1.0, 50.0, None)]
    rows = [["Sample", "CO2 uptake", "Pressure"], ["", "(mmol/g)", "(kPa)"], ["A", "2", "50"]]
    assert short(read(spark, [rows])) == [("A", 2.0, None, 0.5)]
    # A row of text alone is a body row.
    rows = [["Sample", "CO2 uptake (mmol/g)"], ["A", "n/a"], ["B", "1"]]
    assert short(read(spark, [rows])) == [("A", None, None, None), ("B", 1.0, None, None)]


def test_one_column_for_the_material(spark):
    rows = [["Adsorbent", "Material", "Capacity (mmol/g)"], ["A", "x", "1"]]
    assert short(read(spark, [rows])) == [("A", 1.0, None, None)]


def test_catalyst_tables(spark):
    rows = [["Catalyst", "CO2 Conversion (%)", "CO selectivity (%)", "Selectivity to CH4 / %", "S(CH3OH) (%)", "Temperature (°C)", "P (MPa)"],
            ["Ni", "40", "10", "85 ± 2", "5", "350", "1"], ["Cu", "12.5", "", "n.d.", "60", "523", "3"]]
    assert shown(read(spark, [rows], X.CATALYST_TABLES)) == [
        ("Ni", 40.0, 10.0, 85.0, 5.0, 350.0, "°C", 1.0, "MPa"), ("Cu", 12.5, None, None, 60.0, 523.0, "°C", 3.0, "MPa")]
    assert read(spark, [rows]) == []  # no adsorption record, and no adsorption temperature, from a catalyst table
    assert read(spark, [[["Sample", "CO2 uptake (mmol/g)"], ["A", "1"]]], X.CATALYST_TABLES) == []


def test_catalyst_sets_by_condition(spark):
    rows = [["Sample", "Conversion 300 °C (%)", "CH4 selectivity at 300 °C (%)", "Conversion 623 K (%)", "CH4 selectivity at 623 K (%)", "Feed"], ["A", "20", "90", "45", "80", "H2/CO2 = 4"]]
    got = read(spark, [("Results at 2 bar", rows)], X.CATALYST_TABLES)
    assert shown(got) == [("A", 20.0, None, 90.0, None, 300.0, "°C", 2.0, "bar"), ("A", 45.0, None, 80.0, None, 623.0, "K", 2.0, "bar")]
    assert [r[3]["performance"]["feed_composition"] for r in got] == ["H2/CO2 = 4"] * 2
    assert list(got[0][3]) == [f.name for f in CATALYST.record.fields]


def test_result_without_condition_serves_all_sets(spark):
    rows = [["Sample", "Conversion 300 °C (%)", "Conversion 350 °C (%)", "CO selectivity (%)"], ["A", "20", "45", "7"]]
    assert [x[:3] for x in shown(read(spark, [rows], X.CATALYST_TABLES))] == [("A", 20.0, 7.0), ("A", 45.0, 7.0)]


def test_records_of_different_tables_stay_apart(spark):
    made = [("1", "", [["pH", "Uptake (mmol/g)"], ["7", ""], ["7", ""]]), ("2", "", [["pH", "Uptake (mmol/g)"], ["9", ""]])]
    records = X.table_records(spark.createDataFrame([("p", "T", "D", 2020, made)], PAPER))
    assert records.select("record_idx").distinct().count() == 3
    merged = C.consolidate(records.selectExpr("paper_id", "record_idx AS row_idx", "record"), ADSORPTION).collect()
    assert sorted((r["n_variants"], r["record"]["synthesis_method"]["ph"]) for r in merged) == [(1, 7.0), (1, 7.0), (1, 9.0)]


def test_tables_without_content(spark):
    assert read(spark, [[], [[]], [["Sample", "Uptake (mmol/g)"]], [[None, None], [None]]]) == []
    assert short(read(spark, [[[None, "Uptake (mmol/g)", None], [None, "1"], []]])) == [(None, 1.0, None, None), (None, None, None, None)]


def layouts(spark, tables, rules):
    """Is each table, given as rows, laid out?"""
    df = spark.createDataFrame([(rows,) for rows in tables], "rows array<array<string>>").selectExpr("named_struct('rows', rows) AS t")
    return [r["laid"] for r in df.selectExpr(f"{X._layout('t', repr(''), rules)} IS NOT NULL AS laid").collect()]


def test_tables_that_name_no_result_are_not_laid_out(spark):
    other = [["Sample", "BET area (m2/g)", None], ["A", "200", "x"], ["B", "300"]]
    catalysts = [["Catalyst", "CO2 conversion (%)"], ["Ni", "40"]]
    sorbents = [["Adsorbent", "Uptake at 25 °C (mmol/g)"], ["A", "2"]]
    turned = [["Sample", "A", "B"], ["Capacity", "1", "2"], ["pH", "9", "10"]]
    two_rows = [["S", "Sample"], ["CO", ""], ["20", "A"]]
    assert layouts(spark, [other, catalysts, sorbents, turned, [["", "(m mol / g)"], ["A", "1"]], two_rows], X.ADSORPTION_TABLES) == [False, False, True, True, True, False]
    assert layouts(spark, [other, catalysts, sorbents, two_rows], X.CATALYST_TABLES) == [False, True, False, True]


def test_headings_are_read_as_lines_of_one_text(spark):
    cells = ["Sample", None, "CO2\nuptake (mg/g)", "(", "Uptake at\t25 o C [1 bar] (mmol g-1)", "", "Conversion / %\n", "Pressure (kPa) (x)", "−5 ºC or 1,000 K"]
    df = spark.createDataFrame([(cells,), ([],), (None,)], "c array<string>")
    got = [r["r"] for r in df.selectExpr(f"{X._read_all('c', X.ADSORPTION_TABLES)} AS r").collect()]
    assert got[1:] == [[], []]
    plain = [(max((c["score"] for c in h["candidates"]), default=None), h["unit"], h["temperature"] and tuple(h["temperature"]), h["pressure"] and tuple(h["pressure"])) for h in got[0]]
    assert plain == [
        (1.0 + 0.1, "", None, None), (None, "", None, None), (1.35, "mg/g", None, None), (None, "", None, None), (1.35, "mmol/g", (25.0, "°c"), (1.0, "bar")),
        (None, "", None, None), (None, "%", None, None), (0.75, "kpa", None, None), (None, "", (-5.0, "°c"), None)]


def test_a_set_is_read_once_for_all_its_rows(spark):
    rows = [["Sample", "Uptake 25 °C (mmol/g)", "Uptake at 323 K (mg/g)", "P (kPa)"], ["A", "2", "1.5", "1"]]
    papers = spark.createDataFrame([("p", "T", "D", 2020, [("1", "", rows)])], PAPER)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        for rules in (X.ADSORPTION_TABLES, X.CATALYST_TABLES):
            plan = X.table_records(papers, rules)._jdf.queryExecution().optimizedPlan().toString()
            of_rows = plan.split("Generate ")[0]
            # Neither units are written alike nor columns looked for at each row; blanks are trimmed without a pattern.
            assert plan.count("Generate ") == 3 and "regexp_extract" in of_rows
            assert not any(x in of_rows for x in ("(?U)\\s+", "(?U)^\\s+|", "fields#", "units#"))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_odd_rows_of_several_sets(spark):
    rows = [["Sample", "Uptake 25 °C (mmol/g)", "Uptake 50 °C (mg/g)", "T (K)", "T (K)"], [" A\n", "", "44.01", " 300.15 ", None],
            [None, None, None, None, None], [" ", "-", "", "", "310.15"], ["B", "2", "88.02 mg", "x", ""], [], None]
    want = [("A", 1.0, 50.0, None), (None, None, 25.0, None), (None, None, 25.0, None), ("B", 2.0, 25.0, None), ("B", 2.0, 50.0, None), (None, None, 25.0, None), (None, None, 25.0, None)]
    got = read(spark, [rows, None, rows])
    assert short(got) == want * 2 and [r[:3] for r in got] == [(t, *x) for t in (0, 2) for x in [(0, 1), (1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (5, 0)]]
    # A result without condition serves each set without one of its own; papers of one id stay apart.
    made = [("1", "", [["Sample", "Conversion 300 °C (%)", "CO selectivity (%)"], ["A", "", "7"], ["B", "", ""]])]
    twice = X.table_records(spark.createDataFrame([(None, None, None, None, made)] * 2, PAPER), X.CATALYST_TABLES).collect()
    assert sorted((r["record"]["material_id"], r["record"]["performance"]["co_selectivity"], r["record_idx"]) for r in twice if r["paper_id"] is None) == [("A", 7.0, 0)] * 2 + [("B", None, 1000)] * 2


def test_headings_are_read_without_needless_steps():
    layout = X._layout("t", "t.caption", X.CATALYST_TABLES)
    # Pairs have an order of their own, a set's name is no JSON, and conditions are worked out only where a table has one.
    assert "array_sort(" not in layout and "to_json(" not in layout
    assert all(f".{d} = '', NULL, transform(split(" in layout for d in ("temperature", "pressure"))
    assert "if(array_contains(fields, f), " in X._places(X.CATALYST_TABLES)


def test_odd_units_conditions_and_numbers(spark):
    rows = [["Sample", "Uptake (mmol g⁻¹)", "Uptake (10 %, 1 bar) [mg·g^-1]", "Uptake [mg/g] at 1 bar", "Uptake 1,000 mbar (mol kg-1)", "pH"],
            ["A", "1.2 × 10^-1", "88.02", "44.01", "10", "7 x"], ["B", "10 x", "", "2x10^0", "x", "1 × 10"], [None, "10", None, "1 x 10 3", "", "1 x 10"]]
    got = read(spark, [rows])
    values = [(m, c, p) for m, c, _, p in short(got)]
    assert values == [("A", 2.0, 1.0), ("A", 10.0, 1.0), ("B", None, 1.0), (None, None, 1.0)] and [r[1:3] for r in got] == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert [r[3]["synthesis_method"]["ph"] for r in got] == [7.0, 7.0, None, None]
    two = [["Catalyst", "CO2 conversion (%)", "", "S CO / %"], [None, "300 °C", "300.0 ºC, 2 bar", ""], ["Ni", "1e1", "x", "5"], ["Cu", None, "2 ± 1", None]]
    assert [(x[0], x[1], x[2], *x[5:]) for x in shown(read(spark, [two, [[None]], [["pH"], ["7"]]], X.CATALYST_TABLES))] == [
        ("Ni", 10.0, 5.0, 300.0, "°C", None, None), ("Ni", None, 5.0, 300.0, "°C", 2.0, "bar"), ("Cu", 2.0, None, 300.0, "°C", 2.0, "bar")]
