"""The registered queries: every operator over the given tables, with scalar results.

Each query takes (spark, sf_dir), reads whole tables and returns a DataFrame
whose arrays and maps are spelled out as strings or columns, so that it can be
compared value by value with :mod:`oreleaf.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreleaf.functions import sqltext as Q
from oreleaf.functions.frames import fan_out
from oreleaf.functions.text import join_list as _join
from oreleaf.operators import attempts as A, consolidation as C, documents as D, flattening, inference as I
from oreleaf.operators import manifest as M, mentions, prompts as P, responses as R, rules, tables, verification as V
from oreleaf.plans import encodings as E
from oreleaf.schemas import ADSORPTION, CATALYST, SCHEMA_NAMES, USECASE, select_schemas

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_CHARS = 500


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _papers(spark: SparkSession, sf: str, **options) -> DataFrame:
    return D.parse_tei(E.tei_documents(spark, sf, **options))


# ---- documents ------------------------------------------------------------

@query
def tei_source(spark, sf):
    return E.tei_documents(spark, sf).selectExpr(
        "paper_id", "cast(regexp_count(tei_xml, '<p>') AS bigint) AS n_paragraphs",
        "contains(tei_xml, '<figure type=\"table\">') AS has_table", "endswith(tei_xml, '</TEI>') AS complete")


@query
def doc_metadata(spark, sf):
    return _papers(spark, sf).selectExpr("paper_id", "title", "doi", "cast(year AS bigint) AS year", "abstract")


@query
def doc_authors(spark, sf):
    return D.author_rows(_papers(spark, sf)).selectExpr("paper_id", "cast(author_idx AS bigint) AS author_idx", "author")


@query
def doc_sections(spark, sf):
    return D.section_rows(_papers(spark, sf)).selectExpr(
        "paper_id", "cast(section_idx AS bigint) AS section_idx", "heading", "text")


@query
def doc_tables(spark, sf):
    return D.table_rows(_papers(spark, sf)).selectExpr(
        "paper_id", "cast(table_idx AS bigint) AS table_idx", "label", "caption", "cast(size(rows) AS bigint) AS n_rows")


@query
def doc_table_cells(spark, sf):
    return D.table_cells(_papers(spark, sf)).selectExpr(
        "paper_id", "cast(table_idx AS bigint) AS table_idx", "cast(row_idx AS bigint) AS row_idx",
        "cast(col_idx AS bigint) AS col_idx", "cell")


@query
def doc_table_text(spark, sf):
    return D.table_rows(_papers(spark, sf)).select(
        "paper_id", D.table_text(F.col("label"), F.col("caption"), F.col("rows")).alias("table_text"))


@query
def doc_llm_text(spark, sf):
    return D.with_document_text(_papers(spark, sf)).selectExpr(
        "paper_id", "cast(length(llm_text) AS bigint) AS n_chars", "md5(llm_text) AS text_md5")


@query
def doc_llm_text_truncated(spark, sf):
    return D.with_document_text(_papers(spark, sf), MAX_CHARS).selectExpr("paper_id", "llm_text")


@query
def doc_quarantine(spark, sf):
    return D.quarantine(_papers(spark, sf, cut_every=25))


# ---- prompts --------------------------------------------------------------

def _docs(spark, sf):
    return D.with_document_text(_papers(spark, sf)).select("paper_id", "llm_text")


@query
def prompt_extract(spark, sf):
    return P.extraction_prompts(_docs(spark, sf), select_schemas()).selectExpr(
        "paper_id", "schema", "cast(length(prompt) AS bigint) AS n_chars", "md5(prompt) AS prompt_md5")


@query
def prompt_verify(spark, sf):
    n = E.read(spark, sf, "documents").count()
    docs = _docs(spark, sf)
    known = docs.select(F.col("paper_id").alias("document"))
    text_of = E.order_papers(spark, sf).selectExpr("paper_id", f"cast(o_orderkey % {n} AS string) AS document").join(known, "document", "left_semi")
    prompts = P.verification_prompts(R.validate(E.responses(spark, sf), ADSORPTION), docs, ADSORPTION, text_of)
    row = r"substring_index(substring_index(prompt, '\n</row>', 1), '<row>\n', -1)"
    return prompts.selectExpr(
        "paper_id", "cast(row_idx AS bigint) AS row_idx", f"get_json_object({row}, '$.material_id') AS material_id",
        f"cast(get_json_object({row}, '$.synthesis_method.ph') AS double) AS ph",
        r"md5(substring_index(substring_index(prompt, '<paper>\n', -1), '\n</paper>', 1)) AS text_md5")


@query
def prompt_batch(spark, sf):
    records = _records(spark, sf)
    batch = Q.extract("prompt", r"(?s)<rows>\n(.*)\n</rows>$", 1)
    ids = f"from_json({batch}, 'rows ARRAY<STRUCT<material_id: STRING>>').rows.material_id"
    return P.batch_prompts(records, ADSORPTION).selectExpr(
        "paper_id", "cast(n_rows AS bigint) AS n_rows",
        f"array_join({ids}, '|') AS material_ids")


@query
def json_round_trip(spark, sf):
    records = _records(spark, sf)
    again = (records.select("paper_id", "row_idx", R.record_json(F.col("record")).alias("json"))
             .select("paper_id", "row_idx", R.record_from_json("json", ADSORPTION).alias("record")))
    return again.select("paper_id", F.col("row_idx").cast("bigint").alias("row_idx"), *_shown_fields())


def _shown_fields():
    return [F.expr(e) for e in (
        "record.material_id", "cast(record.study_metadata.year AS bigint) AS year", "record.study_metadata.title",
        "array_join(record.synthesis_method.method_name, '|') AS methods", "record.synthesis_method.ph",
        "record.synthesis_method.exfoliation", "record.measurement.pressure_bar", "record.measurement.wet_dry_air",
        "record.measurement.co2_adsorption_capacity_mmol_g AS capacity")]


# ---- responses ------------------------------------------------------------

def _records(spark, sf):
    return R.record_rows(R.validate(E.responses(spark, sf), ADSORPTION))


@query
def resp_parse_rows(spark, sf):
    return (
        fan_out(R.parse_rows(E.responses(spark, sf)), ["paper_id"], "raw_rows", "row_idx", "record")
        .selectExpr("paper_id", "cast(row_idx AS bigint) AS row_idx",
                    "try_variant_get(record, '$.material_id', 'string') AS material_id"))


@query
def resp_defaults(spark, sf):
    return _records(spark, sf).selectExpr(
        "paper_id", "cast(row_idx AS bigint) AS row_idx", "record.measurement IS NOT NULL AS has_measurement",
        "record.measurement.pressure_bar AS pressure_bar", "record.synthesis_method.temperature_units AS units",
        "cast(size(record.material_properties.anions) AS bigint) AS n_anions")


@query
def resp_list_coerce(spark, sf):
    return _records(spark, sf).selectExpr(
        "paper_id", "cast(row_idx AS bigint) AS row_idx",
        "array_join(record.synthesis_method.method_name, '|') AS methods",
        "array_join(record.synthesis_method.metal_precursors, '|') AS precursors",
        "cast(size(record.synthesis_method.metal_precursors) AS bigint) AS n_precursors")


@query
def resp_scalar_coerce(spark, sf):
    return _records(spark, sf).select("paper_id", F.col("row_idx").cast("bigint").alias("row_idx"), *_shown_fields())


@query
def resp_fenced_json(spark, sf):
    hard = E.responses(spark, sf).selectExpr("paper_id", r"""CASE
        WHEN NOT startswith(body, '{') THEN body
        WHEN int(paper_id) % 6 = 0 THEN concat('```\nno json\n```\n```json\n', body, '\n```')
        WHEN int(paper_id) % 6 = 1 THEN concat('{"note":"a ```x``` b",', substr(body, 2)) ELSE body END AS body""")
    return R.parse_rows(hard).selectExpr(
        "paper_id", "response_error", "cast(size(raw_rows) AS bigint) AS n_rows",
        "try_variant_get(get(raw_rows, 0), '$.material_id', 'string') AS first_material")


@query
def resp_validation_errors(spark, sf):
    return R.error_rows(R.validate(E.responses(spark, sf), ADSORPTION)).selectExpr(
        "paper_id", "response_error", "cast(row_idx AS bigint) AS row_idx", "field")


@query
def resp_first_valid_attempt(spark, sf):
    return A.first_valid_attempt(E.attempt_log(spark, sf)).selectExpr(
        "request_id", "ok", "cast(attempt AS bigint) AS attempt", "body", "error", "n_attempts", "waited_s")


@query
def resp_escalation_plan(spark, sf):
    return A.escalation_plan(E.attempt_log(spark, sf)).selectExpr(
        "request_id", "cast(attempt AS bigint) AS attempt", "cast(next_max_tokens AS bigint) AS next_max_tokens", "retry")


@query
def infer_from_table(spark, sf):
    prompts = P.extraction_prompts(_docs(spark, sf), [ADSORPTION]).withColumn("request_id", F.col("paper_id"))
    n = E.read(spark, sf, "documents").count()
    status = "CASE WHEN o_orderkey % 7 = 0 THEN 'error' WHEN o_orderkey % 5 < 2 THEN 'rejected' ELSE 'ok' END"
    answers = E.order_papers(spark, sf).selectExpr(
        f"cast(o_orderkey % {n} AS string) AS request_id", f"cast(o_orderkey div {n} AS int) AS attempt", f"{status} AS status",
        f"if({status} = 'ok', NULL, concat('no answer ', o_orderkey)) AS error",
        "if(o_orderkey % 7 = 0, NULL, concat('answer ', o_orderkey)) AS body")
    return I.infer_from_table(prompts, answers).select("paper_id", "status", "error", "body")


# ---- verification ---------------------------------------------------------

def _verified(spark, sf):
    return R.validate_single(E.verification_responses(spark, sf), ADSORPTION)


@query
def verify_merge(spark, sf):
    return V.merge_verified(_records(spark, sf), _verified(spark, sf), ADSORPTION).select(
        "paper_id", F.col("row_idx").cast("bigint").alias("row_idx"), "was_verified", *_shown_fields())


@query
def verify_merge_usecase(spark, sf):
    first = E.event_records(spark, sf).select(F.col("row_idx").cast("string").alias("paper_id"), F.lit(0).alias("row_idx"), "record")
    changed = F.col("record").withField("use_cases", F.array(F.lit("second"), F.col("record.material_id")))
    verified = first.select("paper_id", "row_idx", F.when(
        F.col("paper_id").cast("bigint") % 3 == 0, changed).alias("record"))
    return V.merge_verified(first, verified, USECASE, unite=True).selectExpr(
        "paper_id", "was_verified", "array_join(record.use_cases, '|') AS use_cases")


@query
def verify_identity_check(spark, sf):
    return V.identity_check(_records(spark, sf), _verified(spark, sf), ADSORPTION).selectExpr(
        "paper_id", "cast(row_idx AS bigint) AS row_idx", "same_identity")


@query
def evidence_check(spark, sf):
    base = E.read_spread(spark, sf, "documents", "doc_id")
    record = R.nest(lambda p, t: {
        "material_id": "split(text, ' ')[0]", "measurement.gas_composition": "concat('absent ', doc_id)",
        "measurement.pressure_bar": "double(n_chars)",
        "measurement.co2_adsorption_capacity_mmol_g": "try_cast(nullif(regexp_extract(text, '[0-9]+', 0), '') AS double)",
        "material_properties.anions": "array_compact(array(source, get(split(text, ' '), 1)))",
    }.get(p, f"cast({'array()' if t.typeName() == 'array' else 'NULL'} AS {t.simpleString()})"), ADSORPTION)
    validated = base.selectExpr("cast(doc_id AS string) AS paper_id", f"array({record}) AS rows")
    docs = base.selectExpr("cast(doc_id AS string) AS paper_id", "text AS llm_text")
    return V.evidence_check(validated, docs, ADSORPTION).select("paper_id", "field", "supported")


# ---- consolidation --------------------------------------------------------

@query
def consolidate_adsorption(spark, sf):
    return C.consolidate(E.line_records(spark, sf, ADSORPTION), ADSORPTION).selectExpr(
        "paper_id", "row_idx", "n_variants", "record.material_id", "record.measurement.adsorption_temperature_c AS condition",
        "record.synthesis_method.temperature AS temperature", "round(record.synthesis_method.ph, 6) AS ph",
        "round(record.synthesis_method.aging_time_hr, 6) AS aging",
        "array_join(record.synthesis_method.method_name, '|') AS methods")


@query
def consolidate_catalyst(spark, sf):
    return C.consolidate(E.line_records(spark, sf, CATALYST), CATALYST).selectExpr(
        "paper_id", "row_idx", "n_variants", "record.material_id", "record.performance.temperature AS condition",
        "record.synthesis_conditions.temperature AS temperature", "round(record.synthesis_conditions.ph, 6) AS ph",
        "round(record.synthesis_conditions.aging_time_hr, 6) AS aging",
        "array_join(record.synthesis_conditions.method_name, '|') AS methods")


@query
def consolidate_usecase(spark, sf):
    return C.consolidate(E.event_records(spark, sf), USECASE).selectExpr(
        "paper_id", "row_idx", "n_variants", "record.material_id", "record.synthesis_method.ph AS ph",
        "array_join(record.use_cases, '|') AS use_cases")


@query
def consolidate_similar_phrases(spark, sf):
    return C.consolidate(E.event_records(spark, sf, E.CHAIN), USECASE).selectExpr(
        "paper_id", "row_idx", "n_variants", "record.material_id", "array_join(record.use_cases, '|') AS use_cases")


@query
def assess_fallback(spark, sf):
    records = E.line_records(spark, sf, ADSORPTION)
    orders = E.order_papers(spark, sf)
    record = R.nest(lambda p, t: "concat('assessed ', paper_id)" if p == "material_id" else
                    f"cast({'array()' if t.typeName() == 'array' else 'NULL'} AS {t.simpleString()})", ADSORPTION)
    assessed = orders.selectExpr("paper_id", "0L AS row_idx", f"{record} AS record")
    outcome = orders.where("o_orderkey % 3 < 2").selectExpr("paper_id", "o_orderkey % 3 = 0 AS ok")
    return C.assess_or_keep(records, assessed, outcome).selectExpr("paper_id", "row_idx", "record.material_id")


@query
def paper_counts(spark, sf):
    schemas = select_schemas()
    records = E.read(spark, sf, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS paper_id",
        f"element_at(array({', '.join(repr(n) for n in SCHEMA_NAMES)}), l_linenumber % 3 + 1) AS schema")
    return C.paper_counts(E.order_papers(spark, sf), records, schemas).selectExpr(
        "paper_id", *[f"counts['{s.count_key}'] AS {s.count_key}" for s in schemas])


# ---- flattening -----------------------------------------------------------

def _flat(spark, sf, schema, records):
    flat = flattening.flatten(records, schema, keep=("paper_id", "row_idx"))
    return flat.withColumn("year", F.col("year").cast("bigint"))


@query
def flatten_adsorption(spark, sf):
    return _flat(spark, sf, ADSORPTION, E.line_records(spark, sf, ADSORPTION))


@query
def flatten_catalyst(spark, sf):
    return _flat(spark, sf, CATALYST, E.line_records(spark, sf, CATALYST))


@query
def flatten_usecase(spark, sf):
    return _flat(spark, sf, USECASE, E.event_records(spark, sf))


@query
def join_list(spark, sf):
    lists = E.read(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "array(l_returnflag, if(l_linenumber % 2 = 0, NULL, ' b '), if(l_linenumber % 3 = 0, '  ', ''), l_linestatus) AS v",
        "if(l_linenumber % 2 = 0, array(' ', NULL), array()) AS w")
    return lists.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
                        _join(F.col("v")).alias("joined"), _join(F.col("w")).alias("nothing"))


# ---- manifest -------------------------------------------------------------

def _pending(spark, sf, **options):
    todo = M.pending(E.order_papers(spark, sf), E.recorded_manifest(spark, sf), select_schemas(), **options)
    return todo.selectExpr("paper_id", "cast(previous_attempts AS bigint) AS previous_attempts",
                           "cast(size(previous_counts) AS bigint) AS n_counts")


@query
def manifest_pending(spark, sf):
    return _pending(spark, sf)


@query
def manifest_pending_skip_empty(spark, sf):
    return _pending(spark, sf, retry_empty=False)


@query
def manifest_force(spark, sf):
    return _pending(spark, sf, force=True)


def _outcomes(spark, sf):
    """Every paper is parsed; those that parse are extracted once per schema."""
    base = E.order_papers(spark, sf)
    steps = ["struct(0 AS step, 'parse' AS stage, o_orderkey % 25 <> 0 AS ok, 'malformed XML' AS message)"]
    steps += [f"struct({i} AS step, 'extract' AS stage, o_custkey * {i} % 4 <> 0 AS ok, 'bad {n}' AS message)"
              for i, n in enumerate(SCHEMA_NAMES, 1)]
    return (base.selectExpr("paper_id", f"explode(array({', '.join(steps)})) AS s")
            .selectExpr("paper_id", "s.step", "s.stage", "s.ok", "if(s.ok, NULL, s.message) AS error"))


@query
def paper_status(spark, sf):
    return M.paper_status(_outcomes(spark, sf))


@query
def manifest_update(spark, sf):
    schemas = select_schemas(["catalyst", "adsorption"])
    previous = E.recorded_manifest(spark, sf)
    papers = E.order_papers(spark, sf)
    todo = M.pending(papers, previous, schemas)
    counts = papers.selectExpr(
        "paper_id", "map('n_catalyst_materials', o_custkey % 4, 'n_adsorption_materials', o_orderkey % 6) AS counts")
    changed = M.updates(todo, M.paper_status(_outcomes(spark, sf)), counts, schemas)
    return M.upsert(previous, changed).selectExpr(
        "paper_id", "status", "stage", "error", "cast(attempts AS bigint) AS attempts",
        *[f"counts['{s.count_key}'] AS {s.count_key}" for s in select_schemas()])


@query
def run_summary(spark, sf):
    return M.run_summary(E.order_papers(spark, sf), E.recorded_manifest(spark, sf), select_schemas())


@query
def schema_selection(spark, sf):
    chosen = select_schemas(["usecase", "catalyst", "usecase"])
    records = E.read(spark, sf, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS paper_id",
        f"element_at(array({', '.join(repr(n) for n in SCHEMA_NAMES)}), l_linenumber % 3 + 1) AS schema")
    return records.where(F.col("schema").isin([s.name for s in chosen])).groupBy("schema").agg(
        F.count(F.lit(1)).alias("n_records"))


# ---- rules ----------------------------------------------------------------

@query
def extract_table_records(spark, sf):
    records = tables.table_records(_papers(spark, sf))
    return records.selectExpr(
        "paper_id", "cast(row_idx AS bigint) AS row_idx", "record.material_id",
        "cast(record.study_metadata.year AS bigint) AS year", "record.study_metadata.doi", "record.study_metadata.title",
        "round(record.measurement.pressure_bar, 6) AS pressure_bar",
        "round(record.measurement.co2_adsorption_capacity_mmol_g, 6) AS capacity",
        "record.measurement.adsorption_temperature_c AS temperature")


@query
def extract_result_sets(spark, sf):
    return tables.table_records(E.table_papers(spark, sf)).selectExpr(
        "paper_id", "record_idx", "record.material_id", "cast(record.study_metadata.year AS bigint) AS year",
        "round(record.measurement.co2_adsorption_capacity_mmol_g, 6) AS capacity",
        "round(record.measurement.adsorption_temperature_c, 6) AS temperature", "round(record.measurement.pressure_bar, 6) AS pressure_bar")


@query
def extract_catalyst_records(spark, sf):
    return tables.table_records(E.table_papers(spark, sf), tables.CATALYST_TABLES).selectExpr(
        "paper_id", "record_idx", "record.material_id", "record.performance.co2_conversion", "record.performance.co_selectivity",
        "record.performance.ch4_selectivity", "record.performance.temperature", "record.performance.temperature_units",
        "record.performance.pressure", "record.performance.pressure_units")


@query
def unit_normalize(spark, sf):
    lines = E.read_spread(spark, sf, "lineitem", "l_orderkey").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "element_at(array('temperature', 'pressure', 'capacity'), l_linenumber % 3 + 1) AS dimension",
        "l_quantity AS value",
        "element_at(array('K', ' kPa', 'mg/g', '', 'MPa', '°C', NULL), cast(l_partkey % 7 + 1 AS int)) AS unit")
    return rules.normalize_units(lines).selectExpr(
        "l_orderkey", "cast(l_linenumber AS bigint) AS l_linenumber", "l_partkey", "l_suppkey",
        "round(normal_value, 6) AS normal_value")


@query
def extract_text_measurements(spark, sf):
    # The whole text of each document, with a sentence of measurements behind it.
    sections = E.read_spread(spark, sf, "documents", "doc_id").selectExpr(
        "cast(doc_id AS string) AS paper_id", "0 AS section_idx",
        "concat(coalesce(text, ''), '\nSample ', doc_id, ' took up ', doc_id % 997, '.25 mg/g at 1,', 100 + doc_id % 900, ' kPa and ', "
        "doc_id % 400, 'e-1 K, in 10-20 bar. It cost 5 barns and 3 mgs.') AS text")
    return rules.normalize_units(rules.text_measurements(sections)).selectExpr(
        "paper_id", "field", "cast(match_idx AS bigint) AS match_idx", "value", "unit",
        "round(normal_value, 6) AS normal_value")


@query
def bind_measurements(spark, sf):
    # The whole text of each document, with sentences about two materials and one far from both behind it.
    base = E.read_spread(spark, sf, "documents", "doc_id")
    sections = base.selectExpr(
        "cast(doc_id AS string) AS paper_id", "0 AS section_idx",
        "concat(coalesce(text, ''), '\nLDH-', doc_id, ' took up ', doc_id % 997, '.25 mg/g at 25 °C, whereas Zn', doc_id, ' took up ', doc_id % 7, ' mmol/g; ', "
        "repeat('and so on ', 30), 'the pressure was 2 bar.') AS text")
    materials = base.selectExpr("cast(doc_id AS string) AS paper_id", "explode(array(concat('LDH-', doc_id), concat('Zn', doc_id))) AS material_id")
    return mentions.bound_measurements(sections, materials).selectExpr(
        "paper_id", "cast(match_idx AS bigint) AS match_idx", "dimension", "value", "unit", "material_id", "cast(distance AS bigint) AS distance")


@query
def evidence_spans(spark, sf):
    # A sentence behind the whole text states a record's numbers; the pressure stands in a range, the pH of every second one in brackets.
    base = E.read_spread(spark, sf, "documents", "doc_id")
    record = R.nest(lambda p, t: {
        "material_id": "concat('LDH-', doc_id)", "synthesis_method.ph": "double(7000000 + doc_id)", "measurement.pressure_bar": "3D",
        "measurement.co2_adsorption_capacity_mmol_g": "doc_id % 90 + 0.5D", "measurement.adsorption_temperature_c": "300 + doc_id % 50 - 273.15D",
    }.get(p, f"cast({'array()' if t.typeName() == 'array' else 'NULL'} AS {t.simpleString()})"), ADSORPTION)
    said = ("concat(coalesce(text, ''), '\nLDH-', doc_id, ' held ', doc_id % 90, '.5 mmol/g at ', 300 + doc_id % 50, ' K, pH ', "
            "if(doc_id % 2 = 0, '', '['), 7000000 + doc_id, if(doc_id % 2 = 0, '', ']'), ', in 1-3 bar.')")
    validated = base.selectExpr("cast(doc_id AS string) AS paper_id", f"array({record}) AS rows")
    docs = base.selectExpr("cast(doc_id AS string) AS paper_id", f"{said} AS llm_text")
    return mentions.evidence_spans(validated, docs).selectExpr(
        "paper_id", "field", "supported", "cast(first AS bigint) AS first", "cast(end AS bigint) AS last", "cast(distance AS bigint) AS distance")


# Pattern -> use case, over the words of event_type.
USE_CASES = {"purchase|signup": "catalyst conversion", "view": "adsorbent traffic", "click": "adsorbent traffic",
             "nothing like it": "paint stabilizer"}


@query
def extract_use_cases(spark, sf):
    mentions = E.read(spark, sf, "events").selectExpr(
        "cast(user_id % 50 AS string) AS paper_id", "concat('U', user_id) AS material_id",
        "concat('the ', event_type, ' of ', event_id) AS text")
    return rules.use_cases(mentions, USE_CASES).selectExpr(
        "paper_id", "material_id", "array_join(use_cases, '; ') AS use_cases")


# ---- flagship -------------------------------------------------------------

@query
def structured_records(spark, sf):
    """TEI documents -> tables -> records with the paper's metadata -> variants merged -> flat rows."""
    records = tables.table_records(_papers(spark, sf))
    merged = C.consolidate(records.selectExpr("paper_id", "record_idx AS row_idx", "record"), ADSORPTION)
    flat = flattening.flatten(merged, ADSORPTION, keep=("paper_id", "n_variants"))
    return flat.select(
        "paper_id", "n_variants", "material_id", F.col("year").cast("bigint").alias("year"), "doi", "title",
        F.round("pressure_bar", 6).alias("pressure_bar"), "anions",
        F.round("co2_adsorption_capacity_mmol_g", 6).alias("capacity"))
