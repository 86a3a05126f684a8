"""DuckDB SQL with the expected result of each registered query, straight from the given tables."""

from __future__ import annotations

from oreleaf.plans.catalog import MAX_CHARS
from oreleaf.schemas import ADSORPTION, CATALYST, SCHEMA_NAMES, SCHEMAS, USECASE

ORACLE: dict[str, str] = {}

_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def _strip(x: str) -> str:
    return _STRIP.format(x)


# ---- documents (X1) -------------------------------------------------------

_X1 = f"""
WITH base AS (
  SELECT d.doc_id, cast(d.doc_id AS VARCHAR) AS paper_id, d.source, string_split(d.text, chr(10)) AS lines,
         l.doc_id IS NOT NULL AS labelled, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
meta AS (
  SELECT *, nullif({_strip('lines[1]')}, '') AS title, '10.5555/' || paper_id AS doi,
         2000 + doc_id % 25 AS year, {_strip('lines[len(lines)]')} AS abstract
  FROM base),
numbered AS (SELECT paper_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS n FROM base),
blocks AS (
  SELECT paper_id, n // 5 AS b,
         coalesce(string_agg(nullif({_strip('line')}, ''), chr(10) ORDER BY n), '') AS text
  FROM numbered GROUP BY paper_id, n // 5),
sections AS (
  SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY b) - 1 AS section_idx, 'S' || b AS heading, text
  FROM blocks WHERE text <> ''),
tables AS (
  SELECT *, 'D' || paper_id AS sample, cast(quality AS VARCHAR) AS uptake, cast(toxic * 100 + 50 AS VARCHAR) AS pressure
  FROM meta WHERE labelled),
rendered AS (
  SELECT m.paper_id,
    'Title: ' || coalesce(m.title, 'UNKNOWN') || chr(10) || 'DOI: ' || m.doi || chr(10) || 'Year: ' || m.year
    || CASE WHEN m.abstract <> '' THEN chr(10) || chr(10) || 'Abstract:' || chr(10) || m.abstract ELSE '' END
    || coalesce((SELECT string_agg(chr(10) || chr(10) || '## ' || s.heading || chr(10) || s.text, '' ORDER BY s.section_idx)
                 FROM sections s WHERE s.paper_id = m.paper_id), '')
    || CASE WHEN labelled THEN chr(10) || chr(10) || '## Tables' || chr(10) || chr(10) || 'Table 1: Labels' || chr(10)
         || 'Sample | CO2 uptake (mmol/g) | Pressure (kPa)' || chr(10)
         || 'D' || m.paper_id || ' | ' || quality || ' | ' || (toxic * 100 + 50) ELSE '' END AS llm_text
  FROM meta m)
"""

ORACLE["tei_source"] = _X1 + "SELECT paper_id, cast(len(lines) + 1 AS BIGINT) AS n_paragraphs, labelled AS has_table, true AS complete FROM base"
ORACLE["doc_metadata"] = _X1 + "SELECT paper_id, title, doi, cast(year AS BIGINT) AS year, abstract FROM meta"
ORACLE["doc_authors"] = _X1 + """
SELECT paper_id, cast(0 AS BIGINT) AS author_idx, 'F' || (doc_id % 7) || ' S' || doc_id AS author FROM base
UNION ALL SELECT paper_id, 1, source FROM base WHERE source <> ''"""
ORACLE["doc_sections"] = _X1 + "SELECT paper_id, cast(section_idx AS BIGINT) AS section_idx, heading, text FROM sections"
ORACLE["doc_tables"] = _X1 + """
SELECT paper_id, cast(0 AS BIGINT) AS table_idx, '1' AS label, 'Labels' AS caption, cast(2 AS BIGINT) AS n_rows FROM tables"""
ORACLE["doc_table_cells"] = _X1 + """
SELECT paper_id, cast(0 AS BIGINT) AS table_idx, cast(r AS BIGINT) AS row_idx, cast(c AS BIGINT) AS col_idx,
       CASE WHEN r = 0 THEN ['Sample', 'CO2 uptake (mmol/g)', 'Pressure (kPa)'][c + 1]
            ELSE [sample, uptake, pressure][c + 1] END AS cell
FROM tables, range(2) a(r), range(3) b(c)"""
ORACLE["doc_table_text"] = _X1 + """
SELECT paper_id, 'Table 1: Labels' || chr(10) || 'Sample | CO2 uptake (mmol/g) | Pressure (kPa)' || chr(10)
       || sample || ' | ' || uptake || ' | ' || pressure AS table_text FROM tables"""
ORACLE["doc_llm_text"] = _X1 + "SELECT paper_id, cast(length(llm_text) AS BIGINT) AS n_chars, md5(llm_text) AS text_md5 FROM rendered"
ORACLE["doc_llm_text_truncated"] = _X1 + f"SELECT paper_id, left(llm_text, {MAX_CHARS}) AS llm_text FROM rendered"
ORACLE["doc_quarantine"] = """
SELECT cast(doc_id AS VARCHAR) AS paper_id, 'malformed XML' AS parse_error FROM documents WHERE doc_id % 25 = 0"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, slot: str, value: str) -> str:
    before, after = template.split("{%s}" % slot)
    return f"{_sql(before)} || {value} || {_sql(after)}"


ORACLE["prompt_extract"] = _X1 + ", prompts AS (" + " UNION ALL ".join(
    f"SELECT paper_id, '{s.name}' AS schema, {_filled(s.extract_prompt, 'document_text', 'llm_text')} AS prompt FROM rendered"
    for s in SCHEMAS.values()) + ") SELECT paper_id, schema, cast(length(prompt) AS BIGINT) AS n_chars, md5(prompt) AS prompt_md5 FROM prompts"

# ---- responses (X2) -------------------------------------------------------

_X2 = """
good AS (
  SELECT cast(o_orderkey AS VARCHAR) AS paper_id, cast(i AS BIGINT) AS row_idx, o_orderkey, o_custkey, i,
         'P' || o_custkey || '-' || i AS material_id, cast(year(o_orderdate) AS BIGINT) AS year,
         'Order "' || o_orderkey || '"' AS title,
         CASE WHEN i % 2 = 0 THEN 'step ' || o_orderpriority ELSE 'a|' || o_orderstatus END AS methods,
         (o_custkey % 140) / 10.0::DOUBLE AS ph, o_orderstatus = 'F' AS exfoliation, o_orderstatus,
         o_orderkey % 50 = 6 AS no_measurement,
         CASE WHEN o_orderkey % 50 <> 6 THEN cast(o_custkey % 50 AS DOUBLE) END AS pressure_bar,
         CASE WHEN o_orderkey % 50 <> 6 THEN o_orderstatus = 'O' END AS wet_dry_air,
         CASE WHEN o_orderkey % 50 <> 6 THEN o_totalprice END AS capacity
  FROM orders, unnest(range(o_orderkey % 4)) t(i)
  WHERE o_orderkey % 50 NOT IN (0, 1, 2, 5)),
verified AS (
  SELECT cast(o_orderkey AS VARCHAR) AS paper_id, cast(i AS BIGINT) AS row_idx,
         'P' || (o_custkey + CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END) || '-' || i AS v_material,
         CASE WHEN o_orderkey % 50 <> 6 THEN o_totalprice * 2 END AS v_capacity, o_custkey % 5 <> 0 AS same_material
  FROM orders, unnest(range(o_orderkey % 4)) t(i)
  WHERE o_orderkey % 50 <> 5
    AND CASE o_orderkey % 3 WHEN 0 THEN NOT (o_orderkey % 50 = 1 AND i = 0) WHEN 1 THEN o_orderkey % 50 = 6 ELSE false END)
"""
_SHOWN = "material_id, year, title, methods, ph, exfoliation, pressure_bar, wet_dry_air, capacity"

ORACLE["prompt_verify"] = _X1 + "," + _X2 + """
SELECT g.paper_id, g.row_idx, g.material_id, g.ph, md5(r.llm_text) AS text_md5
FROM good g JOIN rendered r ON cast(r.paper_id AS BIGINT) = cast(g.paper_id AS BIGINT) % (SELECT count(*) FROM documents)"""
ORACLE["prompt_batch"] = "WITH " + _X2 + """
SELECT paper_id, count(*) AS n_rows, string_agg(material_id, '|' ORDER BY row_idx) AS material_ids
FROM good GROUP BY paper_id"""
ORACLE["json_round_trip"] = "WITH " + _X2 + f"SELECT paper_id, row_idx, {_SHOWN} FROM good"
ORACLE["resp_scalar_coerce"] = ORACLE["json_round_trip"]
ORACLE["resp_parse_rows"] = """
SELECT cast(o_orderkey AS VARCHAR) AS paper_id, cast(i AS BIGINT) AS row_idx, 'P' || o_custkey || '-' || i AS material_id
FROM orders, unnest(range(o_orderkey % 4)) t(i) WHERE o_orderkey % 50 NOT IN (0, 2)"""
ORACLE["resp_defaults"] = "WITH " + _X2 + """
SELECT paper_id, row_idx, true AS has_measurement, pressure_bar, cast(NULL AS VARCHAR) AS units, cast(0 AS BIGINT) AS n_anions
FROM good"""
ORACLE["resp_list_coerce"] = "WITH " + _X2 + """
SELECT paper_id, row_idx, methods, o_orderstatus || '|M' || i || '|' AS precursors, cast(3 AS BIGINT) AS n_precursors FROM good"""
ORACLE["resp_fenced_json"] = """
SELECT cast(o_orderkey AS VARCHAR) AS paper_id, CASE WHEN o_orderkey % 50 = 0 THEN 'malformed JSON' END AS response_error,
       CASE WHEN o_orderkey % 50 = 2 THEN 0 WHEN o_orderkey % 50 <> 0 THEN o_orderkey % 4 END::BIGINT AS n_rows,
       CASE WHEN o_orderkey % 50 NOT IN (0, 2) AND o_orderkey % 4 > 0 THEN 'P' || o_custkey || '-0' END AS first_material
FROM orders"""
ORACLE["resp_validation_errors"] = """
SELECT cast(o_orderkey AS VARCHAR) AS paper_id, 'malformed JSON' AS response_error, cast(NULL AS BIGINT) AS row_idx,
       cast(NULL AS VARCHAR) AS field FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT cast(o_orderkey AS VARCHAR), 'invalid fields', cast(0 AS BIGINT), 'measurement.pressure_bar'
FROM orders WHERE o_orderkey % 50 = 1 AND o_orderkey % 4 > 0
UNION ALL SELECT cast(o_orderkey AS VARCHAR), 'invalid fields', cast(i AS BIGINT), 'synthesis_method.metal_precursors'
FROM orders, unnest(range(o_orderkey % 4)) t(i) WHERE o_orderkey % 50 = 5"""

_X3 = """
WITH attempts AS (
  SELECT 'r' || (event_id // 4) AS request_id, event_id % 4 + 1 AS attempt, event_id,
         CASE event_type WHEN 'signup' THEN 'incomplete' WHEN 'error' THEN 'transient' WHEN 'view' THEN 'transient' ELSE 'ok' END AS status,
         user_id % 40 * 1000 AS max_tokens, user_id % 7 = 0 AS escalated, props AS body, event_type || ' ' || event_id AS error
  FROM events)
"""
ORACLE["resp_first_valid_attempt"] = _X3 + """
SELECT request_id, count(*) FILTER (status = 'ok') > 0 AS ok,
       cast(coalesce(min(attempt) FILTER (status = 'ok'), max(attempt)) AS BIGINT) AS attempt,
       arg_min(body, attempt) FILTER (status = 'ok') AS body,
       CASE WHEN count(*) FILTER (status = 'ok') = 0 THEN arg_max(error, attempt) END AS error,
       count(*) AS n_attempts,
       sum(CASE WHEN status = 'transient' AND attempt <= 3 THEN 15.0::DOUBLE * pow(2, attempt - 1) ELSE 0 END) AS waited_s
FROM attempts GROUP BY request_id"""
ORACLE["resp_escalation_plan"] = _X3 + """
, planned AS (SELECT *, least(greatest(2 * max_tokens, 16384), 32768) AS next_max_tokens FROM attempts)
SELECT request_id, cast(attempt AS BIGINT) AS attempt, cast(next_max_tokens AS BIGINT) AS next_max_tokens,
       status = 'incomplete' AND next_max_tokens > max_tokens AND NOT escalated AS retry FROM planned"""
ORACLE["infer_from_table"] = """
WITH n AS (SELECT count(*) AS n FROM documents),
a AS (SELECT o_orderkey % n AS doc_id, o_orderkey, o_orderkey // n AS attempt,
        CASE WHEN o_orderkey % 7 = 0 THEN 'error' WHEN o_orderkey % 5 < 2 THEN 'rejected' ELSE 'ok' END AS status FROM orders, n),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY status = 'ok' DESC, attempt DESC) AS place FROM a)
SELECT cast(d.doc_id AS VARCHAR) AS paper_id, coalesce(status, 'missing') AS status,
       CASE WHEN status <> 'ok' THEN 'no answer ' || o_orderkey END AS error,
       CASE WHEN o_orderkey % 7 <> 0 THEN 'answer ' || o_orderkey END AS body
FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id AND place = 1"""

# ---- verification ---------------------------------------------------------

ORACLE["verify_merge"] = "WITH " + _X2 + """
SELECT g.paper_id, g.row_idx, v.paper_id IS NOT NULL AS was_verified, coalesce(v_material, material_id) AS material_id, year,
       title, methods, CASE WHEN v.paper_id IS NULL THEN ph END AS ph, exfoliation, pressure_bar, wet_dry_air,
       CASE WHEN v.paper_id IS NULL THEN capacity ELSE v_capacity END AS capacity
FROM good g LEFT JOIN verified v ON v.paper_id = g.paper_id AND v.row_idx = g.row_idx"""
ORACLE["verify_identity_check"] = "WITH " + _X2 + """
SELECT g.paper_id, g.row_idx, v_material = material_id AS same_identity
FROM good g JOIN verified v ON v.paper_id = g.paper_id AND v.row_idx = g.row_idx"""

_PHRASE = """CASE event_id % 3 WHEN 0 THEN 'Use ' || event_type WHEN 1 THEN 'use  ' || event_type || '.'
  ELSE ' USE ' || event_type END"""
ORACLE["verify_merge_usecase"] = f"""
SELECT cast(event_id AS VARCHAR) AS paper_id, event_id % 3 = 0 AS was_verified,
       concat_ws('|', CASE WHEN event_id % 5 <> 4 THEN {_PHRASE} END,
                 CASE WHEN event_id % 3 = 0 THEN 'second' END, CASE WHEN event_id % 3 = 0 THEN 'U' || user_id END) AS use_cases
FROM events"""

_NUMBERS = "list_transform(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?'), lambda n: cast(n AS DOUBLE))"
_PLAIN = lambda x: f"trim(regexp_replace(lower({x}), '\\s+', ' ', 'g'))"
ORACLE["evidence_check"] = f"""
WITH d AS (SELECT *, cast(doc_id AS VARCHAR) AS paper_id, {_NUMBERS} AS numbers, {_PLAIN('text')} AS plain,
                  string_split(text, ' ') AS words, nullif(regexp_extract(text, '[0-9]+'), '') AS first_number FROM documents)
SELECT paper_id, 'material_id' AS field, contains(plain, {_PLAIN('words[1]')}) AS supported FROM d WHERE words[1] <> ''
UNION ALL SELECT paper_id, 'measurement.gas_composition', contains(plain, 'absent ' || doc_id) FROM d
UNION ALL SELECT paper_id, 'measurement.pressure_bar', list_contains(numbers, cast(n_chars AS DOUBLE)) FROM d WHERE n_chars IS NOT NULL
UNION ALL SELECT paper_id, 'measurement.co2_adsorption_capacity_mmol_g', list_contains(numbers, cast(first_number AS DOUBLE))
  FROM d WHERE first_number IS NOT NULL
UNION ALL SELECT paper_id, 'material_properties.anions', contains(plain, {_PLAIN('source')}) FROM d WHERE source <> ''
UNION ALL SELECT paper_id, 'material_properties.anions', contains(plain, {_PLAIN('words[2]')}) FROM d WHERE words[2] <> ''"""

# ---- consolidation (X4, X5) -----------------------------------------------

_X4 = """
WITH v AS (
  SELECT cast(l_orderkey AS VARCHAR) AS paper_id, l_linenumber, l_partkey * 100000 + l_suppkey AS row_idx,
         CASE WHEN l_partkey % 2 = 0 THEN 'mat  ' ELSE 'MAT ' END || l_orderkey AS material_id,
         CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS temperature,
         CASE WHEN l_partkey % 3 <> 1 THEN l_discount * 100 END AS ph,
         CASE WHEN l_partkey % 3 <> 2 THEN l_tax * 100 END AS aging,
         CASE WHEN l_suppkey % 2 = 0 THEN l_returnflag || '|' || l_linestatus END AS methods
  FROM lineitem),
ranked AS (
  SELECT *, (temperature IS NOT NULL)::INT + (ph IS NOT NULL)::INT + (aging IS NOT NULL)::INT
            + (methods IS NOT NULL)::INT AS filled FROM v)
SELECT paper_id, min(row_idx) AS row_idx, count(*) AS n_variants, {material_id} AS material_id,
       cast(l_linenumber AS DOUBLE) AS condition, {temperature} AS temperature, round({ph}, 6) AS ph,
       round({aging}, 6) AS aging, coalesce({methods}, '') AS methods
FROM ranked GROUP BY paper_id, l_linenumber"""
_BEST = "(max({{'f': filled, 'o': -row_idx, 'v': {0}}}) FILTER ({0} IS NOT NULL)).v"
_X4 = _X4.format(**{n: _BEST.format(n) for n in ("material_id", "temperature", "ph", "aging", "methods")})
ORACLE["consolidate_adsorption"] = _X4
ORACLE["consolidate_catalyst"] = _X4
ORACLE["consolidate_usecase"] = f"""
WITH e AS (SELECT *, cast(user_id % 50 AS VARCHAR) AS paper_id, 'U' || user_id AS material_id,
                  CASE WHEN event_id % 5 <> 4 THEN {_PHRASE} END AS phrase,
                  CASE WHEN event_id % 2 = 0 THEN value END AS ph FROM events),
phrases AS (SELECT paper_id, material_id, min(event_id) AS first_at, arg_min(phrase, event_id) AS phrase
            FROM e WHERE phrase IS NOT NULL GROUP BY paper_id, material_id, event_type),
united AS (SELECT paper_id, material_id, string_agg(phrase, '|' ORDER BY first_at) AS use_cases FROM phrases GROUP BY paper_id, material_id)
SELECT e.paper_id, min(event_id) AS row_idx, count(*) AS n_variants, e.material_id,
       arg_max(ph, (phrase IS NOT NULL)::INT * 1000000000000 - event_id) FILTER (ph IS NOT NULL) AS ph,
       coalesce(any_value(u.use_cases), '') AS use_cases
FROM e LEFT JOIN united u ON u.paper_id = e.paper_id AND u.material_id = e.material_id
GROUP BY e.paper_id, e.material_id"""
# The middle phrase of a chain joins its ends; without it they stay apart.
ORACLE["consolidate_similar_phrases"] = """
WITH e AS (SELECT *, cast(user_id % 50 AS VARCHAR) AS paper_id, 'U' || user_id AS material_id, event_id % 4 AS kind,
                  CASE event_id % 4 WHEN 0 THEN 'removal of dilute CO2 from ' || event_type || ' gas streams' WHEN 1 THEN 'Removal of dilute CO2 from the wet ' || event_type || ' gas streams'
                    WHEN 2 THEN 'removal of dilute CO2 from hot, wet ' || event_type || ' gas streams' ELSE 'storage of CO2, ' || event_type END AS phrase FROM events),
said AS (SELECT *, count_if(kind = 1) OVER (PARTITION BY paper_id, material_id, event_type) > 0 AS joined FROM e WHERE event_id % 5 <> 4),
items AS (SELECT paper_id, material_id, min(event_id) AS first_at, arg_min(phrase, event_id) AS phrase
          FROM said GROUP BY paper_id, material_id, event_type, CASE WHEN kind < 3 AND joined THEN 0 ELSE kind END),
united AS (SELECT paper_id, material_id, string_agg(phrase, '|' ORDER BY first_at) AS use_cases FROM items GROUP BY paper_id, material_id)
SELECT e.paper_id, min(event_id) AS row_idx, count(*) AS n_variants, e.material_id, coalesce(any_value(u.use_cases), '') AS use_cases
FROM e LEFT JOIN united u ON u.paper_id = e.paper_id AND u.material_id = e.material_id
GROUP BY e.paper_id, e.material_id"""
ORACLE["assess_fallback"] = """
SELECT cast(l_orderkey AS VARCHAR) AS paper_id, l_partkey * 100000 + l_suppkey AS row_idx,
       CASE WHEN l_partkey % 2 = 0 THEN 'mat  ' ELSE 'MAT ' END || l_orderkey AS material_id
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
UNION ALL SELECT cast(o_orderkey AS VARCHAR), 0, 'assessed ' || o_orderkey FROM orders WHERE o_orderkey % 3 = 0"""
ORACLE["paper_counts"] = "SELECT cast(o_orderkey AS VARCHAR) AS paper_id, " + ", ".join(
    f"count(l_orderkey) FILTER (l_linenumber % 3 = {i}) AS n_{n}_materials" for i, n in enumerate(SCHEMA_NAMES)
) + " FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"

# ---- flattening -----------------------------------------------------------

_FLAT_LINES = {
    "material_id": "CASE WHEN l_partkey % 2 = 0 THEN 'mat  ' ELSE 'MAT ' END || l_orderkey",
    "year": "cast(year(l_shipdate) AS BIGINT)", "doi": "'10.5555/' || l_orderkey",
    "synthesis_method": "CASE WHEN l_suppkey % 2 = 0 THEN l_returnflag || '; ' || l_linestatus ELSE '' END",
    "synthesis_temperature": "CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END",
    "ph": "CASE WHEN l_partkey % 3 <> 1 THEN l_discount * 100 END",
    "aging_time_hr": "CASE WHEN l_partkey % 3 <> 2 THEN l_tax * 100 END",
    "anions": "CASE WHEN l_suppkey % 2 = 0 THEN 'CO3; Cl' ELSE 'cl; co3' END",
    "adsorption_temperature_c": "cast(l_linenumber AS DOUBLE)", "gas_composition": "'CO2'",
    "wet_dry_air": "l_linenumber % 2 = 0", "co2_adsorption_capacity_mmol_g": "l_linenumber / 2",
    "temperature": "cast(l_linenumber AS DOUBLE)", "feed_composition": "'H2/CO2'",
    "co2_conversion": "l_linenumber * 10::DOUBLE",
}
_FLAT_EVENTS = {
    "material_id": "'U' || user_id", "ph": "CASE WHEN event_id % 2 = 0 THEN value END",
    "use_cases": f"CASE WHEN event_id % 5 <> 4 THEN {_PHRASE} ELSE '' END",
}
_DUCK = {"string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "BIGINT"}


def _flat(schema, values: dict[str, str], ids: str, table: str) -> str:
    types = dict(schema.leaves())
    columns = []
    for name, path in schema.flat:
        kind = types[path].simpleString()
        default = "''" if kind == "array<string>" else f"cast(NULL AS {_DUCK[kind]})"
        columns.append(f"{values.get(name, default)} AS {name}")
    return f"SELECT {ids}, {', '.join(columns)} FROM {table}"


_LINE_IDS = "cast(l_orderkey AS VARCHAR) AS paper_id, l_partkey * 100000 + l_suppkey AS row_idx"
ORACLE["flatten_adsorption"] = _flat(ADSORPTION, _FLAT_LINES, _LINE_IDS, "lineitem")
ORACLE["flatten_catalyst"] = _flat(CATALYST, _FLAT_LINES, _LINE_IDS, "lineitem")
ORACLE["flatten_usecase"] = _flat(
    USECASE, _FLAT_EVENTS, "cast(user_id % 50 AS VARCHAR) AS paper_id, event_id AS row_idx", "events")
ORACLE["join_list"] = """
SELECT l_orderkey, cast(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       array_to_string(list_filter([l_returnflag, CASE WHEN l_linenumber % 2 <> 0 THEN ' b ' END,
         CASE WHEN l_linenumber % 3 = 0 THEN '  ' ELSE '' END, l_linestatus], lambda v: v IS NOT NULL AND trim(v) <> ''), '; ') AS joined,
       '' AS nothing FROM lineitem"""

# ---- manifest (X6) --------------------------------------------------------

_X6 = """
WITH m AS (
  SELECT o_orderkey, o_custkey, cast(o_orderkey AS VARCHAR) AS paper_id, o_orderkey % 4 <> 0 AS known,
         o_orderstatus <> 'P' AS was_ok, 1 + o_orderkey % 3 AS attempts,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 3 END AS cat,
         CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 2 END AS ads,
         CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 10 <> 0 THEN o_custkey % 3 END AS usec FROM orders),
todo AS (
  SELECT *, NOT known OR NOT was_ok OR usec IS NULL AS again_skip,
         NOT known OR NOT was_ok OR usec IS NULL OR cat + ads + usec = 0 AS again,
         (cat IS NOT NULL)::INT + (ads IS NOT NULL)::INT + (usec IS NOT NULL)::INT AS n FROM m)
"""
_CARRIED = """cast(CASE WHEN known THEN attempts ELSE 0 END AS BIGINT) AS previous_attempts,
  cast(CASE WHEN known THEN n ELSE 0 END AS BIGINT) AS n_counts"""
ORACLE["manifest_pending"] = _X6 + f"SELECT paper_id, {_CARRIED} FROM todo WHERE again"
ORACLE["manifest_pending_skip_empty"] = _X6 + f"SELECT paper_id, {_CARRIED} FROM todo WHERE again_skip"
ORACLE["manifest_force"] = "SELECT cast(o_orderkey AS VARCHAR) AS paper_id, cast(0 AS BIGINT) AS previous_attempts, cast(0 AS BIGINT) AS n_counts FROM orders"

_FAILED_AT = "CASE " + " ".join(
    f"WHEN o_custkey * {i} % 4 = 0 THEN {{}}" for i in range(1, 4)) + " END"
_STATUS = f"""
SELECT *, cast(o_orderkey AS VARCHAR) AS paper_id,
  CASE WHEN o_orderkey % 25 = 0 THEN 'parse' WHEN o_custkey % 2 = 0 THEN 'extract' END AS stage,
  CASE WHEN o_orderkey % 25 = 0 THEN 'malformed XML'
       ELSE {_FAILED_AT.format(*[f"'bad {n}'" for n in SCHEMA_NAMES])} END AS error FROM orders"""
ORACLE["paper_status"] = f"""
SELECT paper_id, CASE WHEN stage IS NULL THEN 'ok' ELSE 'error' END AS status, stage, error FROM ({_STATUS})"""
ORACLE["manifest_update"] = _X6 + f""",
st AS ({_STATUS}),
j AS (SELECT todo.*, st.stage, st.error, NOT known OR NOT was_ok OR cat + ads = 0 AS go
      FROM todo JOIN st ON st.o_orderkey = todo.o_orderkey)
SELECT paper_id,
  CASE WHEN go THEN CASE WHEN stage IS NULL THEN 'ok' ELSE 'error' END WHEN was_ok THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN go THEN stage END AS stage, CASE WHEN go THEN error END AS error,
  cast(CASE WHEN NOT go THEN attempts WHEN known THEN attempts + 1 ELSE 1 END AS BIGINT) AS attempts,
  cast(CASE WHEN NOT go THEN cat WHEN stage IS NULL THEN o_custkey % 4 END AS BIGINT) AS n_catalyst_materials,
  cast(CASE WHEN NOT go THEN ads WHEN stage IS NULL THEN o_orderkey % 6 END AS BIGINT) AS n_adsorption_materials,
  cast(CASE WHEN NOT go THEN usec WHEN stage IS NULL AND known THEN usec END AS BIGINT) AS n_usecase_materials
FROM j"""
ORACLE["run_summary"] = _X6 + """
SELECT count(*) AS found, count(*) FILTER (NOT again) AS complete, count(*) FILTER (again) AS pending,
       count(*) FILTER (known AND NOT was_ok) AS failed,
       cast(coalesce(sum(cat) FILTER (known), 0) AS BIGINT) AS n_catalyst_materials,
       cast(coalesce(sum(ads) FILTER (known), 0) AS BIGINT) AS n_adsorption_materials,
       cast(coalesce(sum(usec) FILTER (known), 0) AS BIGINT) AS n_usecase_materials FROM todo"""
ORACLE["schema_selection"] = f"""
SELECT [{', '.join(_sql(n) for n in SCHEMA_NAMES)}][l_linenumber % 3 + 1] AS schema, count(*) AS n_records
FROM lineitem WHERE l_linenumber % 3 IN (0, 2) GROUP BY 1"""

# ---- rules ----------------------------------------------------------------

ORACLE["extract_table_records"] = _X1 + """
SELECT paper_id, cast(0 AS BIGINT) AS row_idx, sample AS material_id, cast(year AS BIGINT) AS year, doi, title,
       round((toxic * 100 + 50) * 0.01::DOUBLE, 6) AS pressure_bar, round(cast(quality AS DOUBLE), 6) AS capacity,
       cast(NULL AS DOUBLE) AS temperature FROM tables"""
# X7: sorbents of the first table by condition, its nameless row, then the transposed table of every third paper.
ORACLE["extract_result_sets"] = """
WITH o AS (SELECT o_orderkey AS k, cast(o_orderkey AS VARCHAR) AS paper_id, cast(year(o_orderdate) AS BIGINT) AS year,
             cast(o_custkey % 1000 AS DOUBLE) AS v, cast(o_custkey % 50 AS DOUBLE) AS c, o_custkey % 2 = 0 AS even FROM orders)
SELECT paper_id, 0::BIGINT AS record_idx, 'S' || paper_id AS material_id, year, v AS capacity, 25::DOUBLE AS temperature, 1::DOUBLE AS pressure_bar FROM o
UNION ALL SELECT paper_id, 1, 'S' || paper_id, year, round(c / 44.01::DOUBLE, 6), 50, 1 FROM o WHERE even
UNION ALL SELECT paper_id, 1000, NULL, year, NULL, 25, 0.5 FROM o
UNION ALL SELECT paper_id, 1000000000, 'A' || paper_id, year, v, 25, NULL FROM o WHERE k % 3 = 0
UNION ALL SELECT paper_id, 1000001000, 'B' || paper_id, year, c, 50, NULL FROM o WHERE k % 3 = 0"""
ORACLE["extract_catalyst_records"] = """
WITH o AS (SELECT cast(o_orderkey AS VARCHAR) AS paper_id, cast(o_custkey % 100 AS DOUBLE) AS v, cast(o_custkey % 50 AS DOUBLE) AS c FROM orders WHERE o_orderkey % 3 <> 0),
s AS (SELECT paper_id, unnest([0, 1]) AS i, unnest([c, v]) AS conversion, unnest([300, 623]) AS t, unnest(['°C', 'K']) AS u FROM o)
SELECT paper_id, 1000000000::BIGINT + i AS record_idx, 'C' || paper_id AS material_id, conversion AS co2_conversion, NULL::DOUBLE AS co_selectivity, 90::DOUBLE AS ch4_selectivity,
  t::DOUBLE AS temperature, u AS temperature_units, 2::DOUBLE AS pressure, 'bar' AS pressure_units FROM s"""
ORACLE["structured_records"] = _X1 + """
SELECT paper_id, cast(1 AS BIGINT) AS n_variants, sample AS material_id, cast(year AS BIGINT) AS year, doi, title,
       round((toxic * 100 + 50) * 0.01::DOUBLE, 6) AS pressure_bar, '' AS anions,
       round(cast(quality AS DOUBLE), 6) AS capacity FROM tables"""

# Unit by l_partkey % 7, converted in each dimension; NULL where the unit is foreign to it.
ORACLE["unit_normalize"] = """
WITH u AS (SELECT *, l_linenumber % 3 AS dim, l_partkey % 7 AS un, l_quantity AS v FROM lineitem)
SELECT l_orderkey, cast(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  round(CASE WHEN un IN (3, 6) THEN v
       WHEN dim = 0 AND un = 0 THEN v - 273.15 WHEN dim = 0 AND un = 5 THEN v
       WHEN dim = 1 AND un = 1 THEN v * 0.01::DOUBLE WHEN dim = 1 AND un = 4 THEN v * 10
       WHEN dim = 2 AND un = 2 THEN v / 44.01::DOUBLE END, 6) AS normal_value FROM u"""
ORACLE["extract_text_measurements"] = """
WITH d AS (SELECT cast(doc_id AS VARCHAR) AS paper_id, doc_id % 997 + 0.25::DOUBLE AS c, cast(1100 + doc_id % 900 AS DOUBLE) AS k,
             cast(doc_id % 400 || 'e-1' AS DOUBLE) AS t FROM documents)
SELECT paper_id, 'capacity' AS field, cast(0 AS BIGINT) AS match_idx, c AS value, 'mg/g' AS unit, round(c / 44.01::DOUBLE, 6) AS normal_value FROM d
UNION ALL SELECT paper_id, 'pressure', 0, k, 'kPa', round(k * 0.01::DOUBLE, 6) FROM d
UNION ALL SELECT paper_id, 'temperature', 0, t, 'K', round(t - 273.15::DOUBLE, 6) FROM d"""
ORACLE["bind_measurements"] = """
WITH d AS (SELECT doc_id AS i, cast(doc_id AS VARCHAR) AS paper_id FROM documents)
SELECT paper_id, 0::BIGINT AS match_idx, 'capacity' AS dimension, i % 997 + 0.25::DOUBLE AS value, 'mg/g' AS unit, 'LDH-' || paper_id AS material_id, 3::BIGINT AS distance FROM d
UNION ALL SELECT paper_id, 1, 'temperature', 25, '°C', 'LDH-' || paper_id, 6 FROM d
UNION ALL SELECT paper_id, 2, 'capacity', i % 7, 'mmol/g', 'Zn' || paper_id, 3 FROM d
UNION ALL SELECT paper_id, 3, 'pressure', 2, 'bar', NULL, NULL FROM d"""
ORACLE["evidence_spans"] = """
WITH d AS (SELECT cast(doc_id AS VARCHAR) AS paper_id, doc_id % 2 = 0 AS plain, length(coalesce(text, '')) + 1 + length('LDH- held ' || doc_id) AS cap,
             length(doc_id % 90 || '.5 mmol/g') AS n_cap, length(cast(7000000 + doc_id AS VARCHAR)) AS n_ph FROM documents),
p AS (SELECT *, cap + n_cap + 4 AS temp, cap + n_cap + 4 + 5 + 5 AS ph FROM d)
SELECT paper_id, 'measurement.co2_adsorption_capacity_mmol_g' AS field, true AS supported, cap::BIGINT AS first, (cap + n_cap)::BIGINT AS last, 2::BIGINT AS distance FROM p
UNION ALL SELECT paper_id, 'measurement.adsorption_temperature_c', true, temp, temp + 5, 5 FROM p
UNION ALL SELECT paper_id, 'synthesis_method.ph', plain, CASE WHEN plain THEN ph END, CASE WHEN plain THEN ph + n_ph END, CASE WHEN plain THEN 8 END FROM p
UNION ALL SELECT paper_id, 'measurement.pressure_bar', false, NULL, NULL, NULL FROM p"""
ORACLE["extract_use_cases"] = """
SELECT cast(user_id % 50 AS VARCHAR) AS paper_id, 'U' || user_id AS material_id,
  concat_ws('; ', CASE WHEN bool_or(event_type IN ('view', 'click')) THEN 'adsorbent traffic' END,
                  CASE WHEN bool_or(event_type IN ('purchase', 'signup')) THEN 'catalyst conversion' END) AS use_cases
FROM events GROUP BY user_id"""
