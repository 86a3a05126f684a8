"""Prompts, attempts, verification, consolidation, manifest and rules on literal inputs."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreleaf.functions.text import fill_template
from oreleaf.operators import attempts as A, consolidation as C, documents as D, manifest as M, prompts as P
from oreleaf.operators import responses as R, rules, verification as V
from oreleaf.plans import encodings
from oreleaf.schemas import ADSORPTION, CATALYST, SCHEMAS, USECASE, select_schemas


def records(spark, rows, schema):
    """rows: (paper_id, row_idx, JSON of the record)"""
    df = spark.createDataFrame(rows, "paper_id string, row_idx int, j string")
    return df.select("paper_id", "row_idx", R.record_from_json("j", schema).alias("record"))


# ---- prompts --------------------------------------------------------------

def test_templates_are_filled_literally(spark):
    df = spark.createDataFrame([("{b} $1 \\", "two {a}")], "a string, b string")
    assert df.select(fill_template("x {a}-{b} {c}", a=F.col("a"), b=F.col("b"))).first()[0] == "x {b} $1 \\-two {a} {c}"


def test_extraction_prompts(spark):
    docs = spark.createDataFrame([("p", "TEXT"), ("bad", None)], "paper_id string, llm_text string")
    got = P.extraction_prompts(docs, select_schemas()).collect()
    assert [(r["paper_id"], r["schema"]) for r in got] == [("p", n) for n in SCHEMAS]
    assert all(r["prompt"] == SCHEMAS[r["schema"]].extract_prompt.replace("{document_text}", "TEXT") for r in got)
    assert len({r["request_id"] for r in got}) == 3


def test_verification_and_batch_prompts(spark):
    rec = records(spark, [("p", 1, '{"material_id":"b"}'), ("p", 0, '{"material_id":"a"}'), ("p", 2, '{"material_id":"c"}')], ADSORPTION)
    docs = spark.createDataFrame([("p", "TEXT")], "paper_id string, llm_text string")
    rows = rec.groupBy("paper_id").agg(F.expr("transform(array_sort(collect_list(struct(row_idx, record))), x -> x.record)").alias("rows"))
    got = P.verification_prompts(rows, docs, ADSORPTION).orderBy("row_idx").collect()
    assert [r["row_idx"] for r in got] == [0, 1, 2] and all("TEXT" in r["prompt"] for r in got)
    assert '"material_id" : "b"' in got[1]["prompt"] and '"ph" : null' in got[1]["prompt"]
    whole = P.batch_prompts(rec, ADSORPTION).collect()
    assert len(whole) == 1 and whole[0]["n_rows"] == 3
    ids = [whole[0]["prompt"].index(f'"material_id":"{m}"') for m in "abc"]
    assert ids == sorted(ids)


def test_papers_that_share_a_text_get_it_once_from_its_document(spark):
    body = '{"rows": [{"material_id": "a"}, {"material_id": "b"}]}'
    rows = R.validate(spark.createDataFrame([(p, body) for p in ("p1", "p2", "p3")], "paper_id string, body string"), ADSORPTION)
    docs = spark.createDataFrame([("d1", "text one"), ("d2", "text two")], "paper_id string, llm_text string")
    text_of = spark.createDataFrame([("p1", "d1"), ("p2", "d1"), ("p3", None)], "paper_id string, document string")
    got = {(r.paper_id, r.row_idx): r.prompt for r in P.verification_prompts(rows, docs, ADSORPTION, text_of).collect()}
    joined = text_of.join(docs.withColumnRenamed("paper_id", "document"), "document").select("paper_id", "llm_text")
    want = {(r.paper_id, r.row_idx): r.prompt for r in P.verification_prompts(rows, joined, ADSORPTION).collect()}
    assert got == want and len(got) == 6 and "text one" in got["p2", 1] and "<paper>\n\n</paper>" in got["p3", 0]


def test_parts_of_a_table_are_not_joined_for_few_bytes(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/orders.parquet")
    parts = encodings.read_spread(spark, str(tmp_path), "orders", "id").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 4 * spark.sparkContext.defaultParallelism - 2


def test_batch_prompt_holds_all_records_of_a_paper(spark):
    rec = records(spark, [("p", 3 * i, f'{{"material_id":"m{i}"}}') for i in range(450)], ADSORPTION)
    got = P.batch_prompts(rec, ADSORPTION).collect()
    assert len(got) == 1 and got[0]["n_rows"] == 450
    order = [got[0]["prompt"].index(f'"material_id":"m{i}"') for i in range(450)]
    assert order == sorted(order)


# ---- attempts -------------------------------------------------------------

def test_attempts(spark):
    log = [("a", 1, "transient", None, "t1"), ("a", 2, "transient", None, "t2"), ("a", 3, "ok", "body", None),
           ("a", 4, "ok", "later", None), ("b", 1, "transient", None, "t1"), ("b", 2, "transient", None, "t2"),
           ("b", 3, "transient", None, "t3"), ("b", 4, "transient", None, "t4"), ("c", 1, "ok", "now", None)]
    df = spark.createDataFrame(log, "request_id string, attempt int, status string, body string, error string")
    got = {r["request_id"]: tuple(r)[1:] for r in A.first_valid_attempt(df).collect()}
    assert got == {"a": (True, 3, "body", None, 4, 45.0), "b": (False, 4, None, "t4", 4, 105.0),
                   "c": (True, 1, "now", None, 1, 0.0)}


def test_escalation(spark):
    df = spark.createDataFrame(
        [("a", "incomplete", 8192, False), ("b", "incomplete", 20000, False), ("c", "incomplete", 32768, False),
         ("d", "incomplete", 8192, True), ("e", "ok", 8192, False)],
        "request_id string, status string, max_tokens int, escalated boolean")
    got = {r["request_id"]: (r["next_max_tokens"], r["retry"]) for r in A.escalation_plan(df).collect()}
    assert got == {"a": (16384, True), "b": (32768, True), "c": (32768, False), "d": (16384, False), "e": (16384, False)}


# ---- verification ---------------------------------------------------------

def test_merge_verified(spark):
    first = records(spark, [("p", 0, '{"material_id":"a","use_cases":["x"]}'), ("p", 1, '{"material_id":"b"}'),
                            ("p", 2, '{"material_id":"c"}')], USECASE)
    second = records(spark, [("p", 0, '{"material_id":"a","use_cases":["y"]}'), ("p", 2, '{"material_id":"other"}')], USECASE)
    failed = first.where("row_idx = 1").withColumn("record", F.lit(None).cast(USECASE.record))
    verified = second.unionByName(failed)
    merged = lambda **o: [(r["row_idx"], r["record"]["material_id"], r["record"]["use_cases"])
                          for r in V.merge_verified(first, verified, USECASE, **o).orderBy("row_idx").collect()]
    assert merged() == [(0, "a", ["y"]), (1, "b", []), (2, "other", [])]
    assert merged(unite=True)[0] == (0, "a", ["x", "y"])
    assert merged(reject_other_identity=True)[2] == (2, "c", [])
    same = {r["row_idx"]: r["same_identity"] for r in V.identity_check(first, verified, USECASE).collect()}
    assert same == {0: True, 2: False}


def test_identity_check_joins_only_what_it_compares(spark):
    made = lambda rows: records(spark, [("p", 0, json) for json in rows], ADSORPTION).select("record")
    a, b = (made([f'{{"material_id":"{m}","measurement":{{"pressure_bar":1,"wet_dry_air":true}}}}']).first()["record"] for m in "ab")
    rows = lambda *r: spark.createDataFrame(r, "paper_id string, row_idx int, record " + ADSORPTION.record.simpleString())
    first = rows(("p", 0, a), ("p", 0, b), ("p", 1, a), ("p", 2, None), ("p", 3, None), ("p", 4, a), (None, 0, a), ("q", None, a))
    verified = rows(("p", 0, a), ("p", 1, None), ("p", 2, b), ("p", 4, a), ("p", 4, b), (None, 0, a), ("q", None, a), ("r", 0, a))
    checked = V.identity_check(first, verified, ADSORPTION)
    assert sorted(tuple(r) for r in checked.collect()) == [("p", 0, False), ("p", 0, True), ("p", 2, False), ("p", 4, False), ("p", 4, True)]
    nothing = rows(("p", 2, made(["{}"]).first()["record"]))
    assert [tuple(r) for r in V.identity_check(first, nothing, ADSORPTION).collect()] == [("p", 2, True)]
    # Answers without a record are dropped below the join, nothing else than the key and the fields compared gets there, and no side is broadcast.
    plan = checked._jdf.queryExecution().optimizedPlan()
    joins = [plan] if plan.nodeName() == "Join" else [plan.children().apply(0)]
    sides = [joins[0].children().apply(i) for i in (0, 1)]
    assert joins[0].nodeName() == "Join" and all(side.output().size() == 2 + len(ADSORPTION.identity) for side in sides)
    assert "Generate" in sides[1].toString() and "SortMergeJoin" in checked._jdf.queryExecution().executedPlan().toString()


def test_evidence(spark):
    rows = records(spark, [("p", 0, '{"material_id":"Mg3 Al","measurement":{"pressure_bar":1,"adsorption_temperature_c":-20.5,'
                                    '"co2_adsorption_capacity_mmol_g":9},"material_properties":{"anions":["CO3","Cl"]}}')], ADSORPTION)
    rows = rows.groupBy("paper_id").agg(F.collect_list("record").alias("rows"))
    docs = spark.createDataFrame([("p", "mg3  AL with CO3 at 1.0 bar and -20.50 C, run 19")], "paper_id string, llm_text string")
    got = {(r["field"], r["value"]): r["supported"] for r in V.evidence_check(rows, docs, ADSORPTION).collect()}
    assert got == {("material_id", "Mg3 Al"): True, ("measurement.pressure_bar", "1.0"): True,
                   ("measurement.adsorption_temperature_c", "-20.5"): True,
                   ("measurement.co2_adsorption_capacity_mmol_g", "9.0"): False,
                   ("material_properties.anions", "CO3"): True, ("material_properties.anions", "Cl"): False}


# ---- consolidation --------------------------------------------------------

VARIANTS = [
    ("p", 0, '{"material_id":"Mg-Al","measurement":{"pressure_bar":1},"synthesis_method":{"ph":9}}'),
    ("p", 1, '{"material_id":" mg-AL","measurement":{"pressure_bar":1},"synthesis_method":{"temperature":60,"aging_time_hr":2,"method_name":["x"]}}'),
    ("p", 2, '{"material_id":"Mg-Al","measurement":{"pressure_bar":2}}'),
    ("p", 3, '{"material_id":"Mg-Al"}'),
    ("q", 0, '{"material_id":"Mg-Al","measurement":{"pressure_bar":1}}'),
]


def test_consolidation_picks_the_most_complete_value_per_field(spark):
    got = {(r["paper_id"], r["row_idx"]): r for r in C.consolidate(records(spark, VARIANTS, ADSORPTION), ADSORPTION).collect()}
    assert {k: r["n_variants"] for k, r in got.items()} == {("p", 0): 2, ("p", 2): 1, ("p", 3): 1, ("q", 0): 1}
    merged = got["p", 0]["record"]
    assert merged["material_id"] == " mg-AL" and merged["synthesis_method"]["temperature"] == 60.0
    assert merged["synthesis_method"]["ph"] == 9.0 and merged["synthesis_method"]["method_name"] == ["x"]
    assert merged["material_properties"]["anions"] == []


def test_consolidation_is_idempotent(spark):
    once = C.consolidate(records(spark, VARIANTS, ADSORPTION), ADSORPTION)
    twice = C.consolidate(once.drop("n_variants"), ADSORPTION)
    strip = lambda df: sorted(map(str, df.drop("n_variants").collect()))
    assert strip(once) == strip(twice)


def test_use_cases_are_united(spark):
    rows = [("p", 0, '{"material_id":"M","use_cases":["Drug delivery","adsorbent CO2"]}'),
            ("p", 1, '{"material_id":"m","use_cases":["drug  delivery.","catalyst"],"synthesis_method":{"ph":9}}'),
            ("p", 2, '{"material_id":"M"}'), ("p", 3, '{"material_id":"N"}')]
    got = {r["row_idx"]: r for r in C.consolidate(records(spark, rows, USECASE), USECASE).collect()}
    assert got[0]["record"]["use_cases"] == ["Drug delivery", "adsorbent CO2", "catalyst"]
    assert got[0]["record"]["synthesis_method"]["ph"] == 9.0 and got[0]["n_variants"] == 3
    assert got[3]["record"]["use_cases"] == [] and got[3]["n_variants"] == 1


def test_lists_are_compared_without_order(spark):
    rows = [("p", 0, '{"material_id":"M","metal_composition":{"anions":["CO3","Cl"]}}'),
            ("p", 1, '{"material_id":"M","metal_composition":{"anions":["cl","co3"]}}'),
            ("p", 2, '{"material_id":"M","metal_composition":{"anions":["Cl"]}}')]
    assert sorted(r["n_variants"] for r in C.consolidate(records(spark, rows, CATALYST), CATALYST).collect()) == [1, 2]


def test_empty_batch(spark):
    assert C.consolidate(records(spark, [], ADSORPTION), ADSORPTION).collect() == []


def test_failed_assessment_keeps_the_paper(spark):
    rec = records(spark, [("p", 0, '{"material_id":"a"}'), ("p", 1, '{"material_id":"b"}'), ("q", 0, '{"material_id":"c"}'),
                          ("r", 0, '{"material_id":"d"}')], ADSORPTION)
    assessed = records(spark, [("p", 0, '{"material_id":"merged"}'), ("q", 0, '{"material_id":"ignored"}')], ADSORPTION)
    outcome = spark.createDataFrame([("p", True), ("q", False)], "paper_id string, ok boolean")
    got = {(r["paper_id"], r["record"]["material_id"]) for r in C.assess_or_keep(rec, assessed, outcome).collect()}
    assert got == {("p", "merged"), ("q", "c"), ("r", "d")}


def test_counts(spark):
    papers = spark.createDataFrame([("a",), ("b",)], "paper_id string")
    rec = spark.createDataFrame([("a", "catalyst"), ("a", "catalyst"), ("a", "usecase")], "paper_id string, schema string")
    got = {r["paper_id"]: r["counts"] for r in C.paper_counts(papers, rec, select_schemas(["catalyst", "adsorption"])).collect()}
    assert got == {"a": {"n_catalyst_materials": 2, "n_adsorption_materials": 0},
                   "b": {"n_catalyst_materials": 0, "n_adsorption_materials": 0}}


# ---- manifest -------------------------------------------------------------

MANIFEST = [
    ("rows", "ok", None, None, {"n_catalyst_materials": 2, "n_adsorption_materials": 0}, 1),
    ("zero", "ok", None, None, {"n_catalyst_materials": 0, "n_adsorption_materials": 0}, 2),
    ("error", "error", "extract", "boom", {}, 3),
    ("other", "ok", None, None, {"n_usecase_materials": 4}, 1),
    ("nostatus", None, None, None, {"n_catalyst_materials": 1, "n_adsorption_materials": 1}, 1),
]


@pytest.fixture(scope="module")
def manifest(spark):
    return spark.createDataFrame(MANIFEST, M.SCHEMA)


def test_pending(spark, manifest):
    papers = spark.createDataFrame([(r[0],) for r in MANIFEST] + [("new",)], "paper_id string")
    schemas = select_schemas(["catalyst", "adsorption"])
    ids = lambda **o: {r["paper_id"] for r in M.pending(papers, manifest, schemas, **o).collect()}
    assert ids() == {"zero", "error", "other", "nostatus", "new"}
    assert ids(retry_empty=False) == {"error", "other", "nostatus", "new"}
    assert ids(per_schema=True) == {"rows", "zero", "error", "other", "nostatus", "new"}
    forced = M.pending(papers, manifest, schemas, force=True).collect()
    assert len(forced) == 6 and all(r["previous_attempts"] == 0 and r["previous_counts"] == {} for r in forced)


def test_update(spark, manifest):
    papers = spark.createDataFrame([("error",), ("other",), ("new",)], "paper_id string")
    schemas = select_schemas(["catalyst"])
    todo = M.pending(papers, manifest, schemas)
    outcomes = spark.createDataFrame(
        [("error", 0, "parse", True, None), ("error", 1, "extract", True, None), ("other", 0, "parse", True, None),
         ("other", 1, "extract", True, None), ("other", 1, "extract", False, "bad"), ("new", 0, "parse", False, "malformed"),
         ("new", 1, "extract", False, "missing")], "paper_id string, step int, stage string, ok boolean, error string")
    counts = spark.createDataFrame([("error", {"n_catalyst_materials": 7})], "paper_id string, counts map<string,bigint>")
    changed = M.updates(todo, M.paper_status(outcomes), counts, schemas)
    after = {r["paper_id"]: tuple(r)[1:] for r in M.upsert(manifest, changed).collect()}
    assert after["error"] == ("ok", None, None, {"n_catalyst_materials": 7}, 4)
    assert after["other"] == ("error", "extract", "bad", {}, 2)
    assert after["new"] == ("error", "parse", "malformed", {}, 1)
    assert after["rows"] == MANIFEST[0][1:] and len(after) == 6
    again = M.pending(papers, M.upsert(manifest, changed), schemas).collect()
    assert {r["paper_id"] for r in again} == {"other", "new"}


def test_counts_of_other_schemas_are_carried(spark, manifest):
    papers = spark.createDataFrame([("other",)], "paper_id string")
    schemas = select_schemas(["catalyst"])
    status = spark.createDataFrame([("other", "ok", None, None)], "paper_id string, status string, stage string, error string")
    counts = spark.createDataFrame([("other", {"n_catalyst_materials": 1})], "paper_id string, counts map<string,bigint>")
    got = M.updates(M.pending(papers, manifest, schemas), status, counts, schemas).first()
    assert got["counts"] == {"n_usecase_materials": 4, "n_catalyst_materials": 1} and got["attempts"] == 2


def test_schema_selection():
    assert [s.name for s in select_schemas(["usecase", "catalyst", "usecase"])] == ["usecase", "catalyst"]
    assert [s.name for s in select_schemas()] == ["catalyst", "adsorption", "usecase"]
    with pytest.raises(ValueError):
        select_schemas(["nope"])


def test_summary(spark, manifest):
    papers = spark.createDataFrame([(r[0],) for r in MANIFEST] + [("new",)], "paper_id string")
    r = M.run_summary(papers, manifest, select_schemas(["catalyst", "adsorption"])).first()
    assert (r["found"], r["complete"], r["pending"], r["failed"]) == (6, 1, 5, 1)
    assert (r["n_catalyst_materials"], r["n_adsorption_materials"]) == (3, 1)


# ---- rules ----------------------------------------------------------------

def test_text_measurements(spark):
    df = spark.createDataFrame([("p", 0, "Uptake of 2.5 mmol/g at 25 °C, 1 bar; later 3 mmol/g. 300 K-like, 5 barns, v1.5 bar")],
                               "paper_id string, section_idx int, text string")
    got = rules.normalize_units(rules.text_measurements(df)).collect()
    assert [(r["field"], r["match_idx"], r["value"], r["unit"]) for r in got] == [
        ("temperature", 0, 25.0, "°C"), ("temperature", 1, 300.0, "K"), ("pressure", 0, 1.0, "bar"),
        ("capacity", 0, 2.5, "mmol/g"), ("capacity", 1, 3.0, "mmol/g")]
    assert got[1]["normal_value"] == pytest.approx(26.85)


def test_unknown_units_are_null(spark):
    df = spark.createDataFrame([("pressure", 1.0, "torr"), ("pressure", 2.0, ""), ("pressure", 3.0, None), ("length", 1.0, "m"),
                                ("pressure", 50.0, " kPa ")], "dimension string, value double, unit string")
    assert [r["normal_value"] for r in rules.normalize_units(df).collect()] == [None, 2.0, 3.0, None, 0.5]


def test_use_cases(spark):
    df = spark.createDataFrame([("p", "m", "captures CO2"), ("p", "m", "CO2 again; paint"), ("p", "n", "nothing"), ("p", "o", None)],
                               "paper_id string, material_id string, text string")
    got = {r["material_id"]: r["use_cases"] for r in rules.use_cases(df, {"CO2": "adsorbent CO2", "paint": "paint stabilizer", "pigment": "paint stabilizer"}).collect()}
    assert got == {"m": ["adsorbent CO2", "paint stabilizer"], "n": [], "o": []}


# ---- numbers, identities, order of failures --------------------------------

@pytest.mark.parametrize("text,values", [
    ("1.2e-3 bar", [1.2e-3]), ("1,000 kPa", [1000.0]), ("10-20 bar", []), ("10 – 20 bar", []), ("5 × 10-3 mmol/g", [5e-3]),
    ("5 x 10^4 Pa", [5e4]), ("-20 °C", [-20.0]), ("2.0 ± 0.1 mmol/g", [2.0]), ("12,5 bar", []), ("a1 bar, 2 bar and 3 barns", [2.0]), ("1.5.2 bar", []),
])
def test_numbers_in_text(spark, text, values):
    sections = spark.createDataFrame([("p", 0, text)], "paper_id string, section_idx int, text string")
    assert [r["value"] for r in rules.text_measurements(sections).collect()] == pytest.approx(values)


def test_records_without_identity_stay_apart(spark):
    rec = records(spark, [("p", 0, '{"use_cases":["drug delivery"]}'), ("p", 1, '{"use_cases":["adsorbent CO2"]}'),
                          ("p", 2, '{"material_id":"a"}'), ("p", 3, '{"material_id":" A"}')], USECASE)
    got = C.consolidate(rec, USECASE).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["n_variants"]) for r in got] == [(0, 1), (1, 1), (2, 2)]


def test_first_failed_schema_is_recorded(spark):
    rows = [("p", 1, "extract", False, "z first"), ("p", 2, "extract", False, "a second"), ("p", 0, "parse", True, None), ("q", 1, "extract", True, None)]
    got = {r["paper_id"]: r["error"] for r in M.paper_status(spark.createDataFrame(rows, "paper_id string, step int, stage string, ok boolean, error string")).collect()}
    assert got == {"p": "z first", "q": None}


@pytest.mark.parametrize("body,n", [
    ('{"rows":[{"material_id":"a ```x``` b"}]}', 1), ("```\nno\n```\n```json\n{\"rows\":[]}\n```", 0), ("```json\n{}\n```", 0), ("```\nno\n```", None), ("text", None),
])
def test_fences(spark, body, n):
    got = R.parse_rows(spark.createDataFrame([("p", body)], "paper_id string, body string")).selectExpr("response_error", "size(raw_rows) n").first()
    assert got["n"] == (n if n is not None else got["n"]) and (got["response_error"] is None) == (n is not None)
