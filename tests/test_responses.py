import json
import math

import pytest
from pyspark.sql import functions as F

from oreleaf.operators import flattening, responses as R
from oreleaf.schemas import ADSORPTION, CATALYST, SCHEMAS, USECASE


def _validate(spark, bodies, schema):
    df = spark.createDataFrame(list(bodies.items()), "paper_id string, body string")
    return {r["paper_id"]: r for r in R.validate(df, schema).collect()}


def _synth(**fields):
    return json.dumps({"rows": [{"synthesis_method": fields}]})


RAW = {
    "no_rows": "{}", "empty": '{"rows":[]}', "null_rows": '{"rows":null}', "blank_record": '{"rows":[{}]}',
    "null_sub": '{"rows":[{"measurement":null,"material_properties":{"anions":null}}]}',
    "fenced": 'Here:\n```json\n{"rows":[{"material_id":"m"}]}\n```\nDone.',
    "unknown_key": '{"rows":[{"zz":1,"material_id":"m","study_metadata":{"q":[1]}}],"other":2}',
    "method_scalar": _synth(method_name="co-precipitation"),
    "method_list": _synth(method_name=["a", "b"]),
    "precursor_scalar": _synth(metal_precursors="MgCl2"),
    "list_null_item": _synth(metal_precursors=[None]),
    "list_mixed_null": _synth(metal_precursors=["x", None]),
    "list_number": _synth(metal_precursors=["x", 3]),
    "sub_not_object": '{"rows":[{"measurement":[1]}]}',
    "record_not_object": '{"rows":[{"material_id":"a"},"b"]}',
    "rows_not_list": '{"rows":{"a":1}}',
    "not_object": "[1]",
    "malformed": '{"rows":[',
    "trailing": '{"rows":[]} x',
    "two_values": '{"rows":[]},{"rows":[]}',
    "id_number": '{"rows":[{"material_id":5}]}',
    "blank_text": "",
    "null_text": None,
    "second_bad": '{"rows":[{"material_id":"a"},{"measurement":{"pressure_bar":"~9","wet_dry_air":"maybe"}}]}',
}


@pytest.fixture(scope="module")
def out(spark):
    return _validate(spark, RAW, ADSORPTION)


def test_missing_rows_are_no_rows(out):
    for k in ("no_rows", "empty", "null_rows"):
        assert out[k]["rows"] == [] and out[k]["response_error"] is None


def test_defaults(out):
    for k in ("blank_record", "null_sub"):
        r = out[k]["rows"][0]
        assert r["material_id"] is None
        assert r["synthesis_method"]["method_name"] == [] and r["synthesis_method"]["ph"] is None
        assert r["material_properties"]["anions"] == [] and r["measurement"]["pressure_bar"] is None
        assert r["study_metadata"]["year"] is None


def test_lists(out):
    assert out["method_scalar"]["rows"][0]["synthesis_method"]["method_name"] == ["co-precipitation"]
    assert out["method_list"]["rows"][0]["synthesis_method"]["method_name"] == ["a", "b"]
    for k in ("precursor_scalar", "list_null_item", "list_mixed_null", "list_number"):
        assert out[k]["rows"] is None
        assert [e["field"] for e in out[k]["field_errors"]] == ["synthesis_method.metal_precursors"], k


def test_fences_and_unknown_keys(out):
    assert out["fenced"]["rows"][0]["material_id"] == "m"
    assert out["unknown_key"]["rows"][0]["material_id"] == "m"


def test_rejections(out):
    bad = {k for k, r in out.items() if r["response_error"]}
    assert bad == {"precursor_scalar", "list_null_item", "list_mixed_null", "list_number", "sub_not_object",
                   "record_not_object", "rows_not_list", "not_object", "malformed", "trailing", "two_values",
                   "id_number", "second_bad", "blank_text", "null_text"}
    assert all(out[k]["rows"] is None for k in bad)
    assert [(e["row_idx"], e["field"]) for e in out["second_bad"]["field_errors"]] == [
        (1, "measurement.pressure_bar"), (1, "measurement.wet_dry_air")]


# value in JSON -> converted value, or "reject"
INTS = [("2024", 2024), ("2024.0", 2024), ('"2024"', 2024), ('"2024.0"', 2024), ('" 7 "', 7), ('"1_000"', 1000),
        ("true", 1), ("2024.5", "reject"), ('"2024.5"', "reject"), ('""', "reject"), ('"x"', "reject"),
        ("null", None), ("[1]", "reject"), ('{"a":1}', "reject")]
FLOATS = [("5", 5.0), ('"9.5"', 9.5), ('" 9.5 "', 9.5), ('"1e3"', 1000.0), ('"NaN"', math.nan),
          ('"Infinity"', math.inf), ('"-inf"', -math.inf), ("true", 1.0), ("1e3", 1000.0), ("2.50", 2.5),
          ('".5"', 0.5), ('"5."', 5.0), ('"9.5d"', "reject"), ('"9,5"', "reject"), ('"~9"', "reject"),
          ('""', "reject"), ("null", None), ("12345678901234567890", 12345678901234567890.0), ("[]", "reject")]
BOOLS = [('"yes"', True), ('"Y"', True), ('"on"', True), ('"t"', True), ('"TRUE"', True), ('"1"', True), ("1", True),
         ("0", False), ("1.0", True), ('"off"', False), ('"N"', False), ("false", False), ("2", "reject"),
         ('"none"', "reject"), ('""', "reject"), ("null", None), ("0.5", "reject")]
STRINGS = [('"a"', "a"), ('""', ""), ("5", "reject"), ("true", "reject"), ("null", None), ('["a"]', "reject")]
CASES = [("year", "study_metadata", INTS), ("ph", "synthesis_method", FLOATS),
         ("exfoliation", "synthesis_method", BOOLS), ("temperature_units", "synthesis_method", STRINGS)]


@pytest.mark.parametrize("field,parent,cases", CASES, ids=[c[0] for c in CASES])
def test_scalar_coercion(spark, field, parent, cases):
    bodies = {v: '{"rows":[{"%s":{"%s":%s}}]}' % (parent, field, v) for v, _ in cases}
    got = _validate(spark, bodies, ADSORPTION)
    for v, expected in cases:
        if expected == "reject":
            assert got[v]["rows"] is None, v
            continue
        value = got[v]["rows"][0][parent][field]
        same = value is not None and expected is not None and math.isnan(expected) and math.isnan(value) \
            if isinstance(expected, float) else value == expected
        assert same or value == expected, (v, value)


def test_scalar_use_case(spark):
    got = _validate(spark, {"a": '{"rows":[{"use_cases":"adsorbent CO2"}]}', "b": '{"rows":[{"use_cases":null}]}'}, USECASE)
    assert got["a"]["rows"][0]["use_cases"] == ["adsorbent CO2"] and got["b"]["rows"][0]["use_cases"] == []


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_round_trip(spark, name):
    schema = SCHEMAS[name]
    lists = {p for p, t in schema.leaves() if t.typeName() == "array"}
    record = {}
    for path, t in schema.leaves():
        value = ["a b", "c"] if path in lists else {"integer": 2020, "double": 1.5, "boolean": True, "string": "s"}[t.typeName()]
        node = record
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = value
    first = _validate(spark, {"a": json.dumps({"rows": [record, {}]})}, schema)["a"]["rows"]
    assert first[0].asDict(True) == record
    df = spark.createDataFrame([(r,) for r in first], T_struct(schema))
    again = df.select(R.record_json(F.col("record")).alias("j")).select(R.record_from_json("j", schema).alias("r")).collect()
    assert [r["r"].asDict(True) for r in again] == [r.asDict(True) for r in first]


def T_struct(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField("record", schema.record)])


def test_flat_rows(spark):
    bodies = {"a": '{"rows":[{"measurement":{"co2_adsorption_capacity_mmol_g":2.4},'
                   '"material_properties":{"anions":["CO3"," ","","NO3 "]}}]}'}
    df = spark.createDataFrame(list(bodies.items()), "paper_id string, body string")
    flat = flattening.flatten(R.record_rows(R.validate(df, ADSORPTION)), ADSORPTION).first().asDict()
    assert list(flat) == ADSORPTION.fieldnames and len(flat) == 24
    assert flat.pop("co2_adsorption_capacity_mmol_g") == 2.4
    assert flat.pop("anions") == "CO3; NO3 "
    joined = {"synthesis_method", "metal_precursors", "m2_metals_doping", "m2_metals_ratios", "m3_metals_ratios"}
    assert {k for k, v in flat.items() if v == ""} == joined
    assert all(v is None for k, v in flat.items() if k not in joined)
    df = spark.createDataFrame([("a", '{"rows":[{"performance":{"co2_conversion":42.0,"temperature":250},'
                                      '"synthesis_conditions":{"temperature":80}}]}')], "paper_id string, body string")
    flat = flattening.flatten(R.record_rows(R.validate(df, CATALYST)), CATALYST).first()
    assert (flat["co2_conversion"], flat["temperature"], flat["synthesis_temperature"]) == (42.0, 250.0, 80.0)
    assert len(CATALYST.fieldnames) == 29 and len(USECASE.fieldnames) == 20


def test_single_record(spark):
    df = spark.createDataFrame([("ok", '{"material_id":"m"}'), ("bad", '{"material_id":1}'), ("list", "[]"),
                                ("rows", '{"rows":[{"material_id":"m"}]}'), ("cut", "{")], "paper_id string, body string")
    out = {r["paper_id"]: r for r in R.validate_single(df, ADSORPTION).collect()}
    assert out["ok"]["record"]["material_id"] == "m"
    assert {k for k, r in out.items() if r["record"] is None} == {"bad", "list", "cut"}
    assert out["rows"]["record"]["material_id"] is None


def test_the_single_cast_rejects_what_the_fields_reject(spark):
    """Bodies whose type looks plain but whose values are not must still be checked field by field."""
    bodies = {
        "overflow": '{"rows":[{"study_metadata":{"year":99999999999}}]}',
        "null_record": '{"rows":[{"material_id":"a"},null]}',
        "null_item": '{"rows":[{"use":1,"synthesis_method":{"method_name":["a",null]}}]}',
        "only_null_items": '{"rows":[{"material_properties":{"anions":[null]}}]}',
        "mixed_kinds": '{"rows":[{"measurement":{"pressure_bar":1}},{"measurement":{"pressure_bar":"2"}}]}',
        "plain": '{"rows":[{"study_metadata":{"year":2001},"synthesis_method":{"ph":7,"method_name":[]},"measurement":null}]}',
    }
    got = _validate(spark, bodies, ADSORPTION)
    assert {k for k, r in got.items() if r["rows"] is None} == {"overflow", "null_record", "null_item", "only_null_items"}
    assert [r["measurement"]["pressure_bar"] for r in got["mixed_kinds"]["rows"]] == [1.0, 2.0]
    plain = got["plain"]["rows"][0]
    assert plain["study_metadata"]["year"] == 2001 and plain["synthesis_method"]["ph"] == 7.0
    assert plain["measurement"]["pressure_bar"] is None and plain["synthesis_method"]["method_name"] == []
