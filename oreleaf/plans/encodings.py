"""Inputs of the registered queries, derived row by row from the given tables.

The tables hold no TEI documents and no model responses, so each encoding turns
the rows of one table into that shape with column expressions. All of them are
narrow: no window, no aggregation and no collected group, so a query's cost is
the cost of its operator. Some rows get a fault (cut-off XML, a wrong JSON type)
by a modulus of their key; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreleaf.operators.responses import nest
from oreleaf.schemas import USECASE, ExtractionSchema


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


PART_BYTES = 4 << 20  # of a table's files, per part


def read_spread(spark: SparkSession, sf_dir: str, table: str, key: str) -> DataFrame:
    """For queries that spend much on each row: the table dealt out by a key, whatever its row groups are.

    The number of parts is stated, as Spark otherwise joins parts of few bytes, however much is to be done for each
    row; it grows with the table, so that the wider rows a query makes of a part can be sorted in memory.
    """
    given = read(spark, sf_dir, table)
    size = int(given._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    return given.repartition(parts, F.col(key))


def _escape(col: Column) -> Column:
    for literal, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        col = F.replace(col, F.lit(literal), F.lit(entity))
    return col


BLOCK = 5  # lines of a document per section


def tei_documents(spark: SparkSession, sf_dir: str, cut_every: int | None = None) -> DataFrame:
    """X1: ``documents`` (+ ``labels``) as TEI, one line per paragraph, five per section.

    ``labels`` has at most one row per document; it becomes a table of
    measurements. ``cut_every`` truncates the XML of every n-th document.
    """
    docs = read_spread(spark, sf_dir, "documents", "doc_id")
    labels = read(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    lines = F.col("_lines")  # a column of its own, so that a document is split once and not once per section
    doc_id = F.col("doc_id").cast("string")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / BLOCK).cast("int")),
        lambda b: F.concat(
            F.lit("<div><head>S"), b.cast("string"), F.lit("</head>"),
            F.array_join(F.transform(F.slice(lines, b * BLOCK + 1, F.lit(BLOCK)),
                                     lambda s: F.concat(F.lit("<p>"), _escape(s), F.lit("</p>"))), ""),
            F.lit("</div>")))
    cell = lambda c: F.concat(F.lit("<cell>"), c, F.lit("</cell>"))
    table = F.when(F.col("labelled"), F.concat(
        F.lit('<figure type="table"><label>1</label><head>Labels</head><table>'
              "<row><cell>Sample</cell><cell>CO2 uptake (mmol/g)</cell><cell>Pressure (kPa)</cell></row><row>"),
        cell(F.concat(F.lit("D"), doc_id)), cell(F.col("quality").cast("string")),
        cell((F.col("toxic") * 100 + 50).cast("string")),
        F.lit("</row></table></figure>"))).otherwise("")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc>'
              '<titleStmt><title level="a">'),
        _escape(F.get(lines, F.lit(0))),
        F.lit("</title></titleStmt><sourceDesc><biblStruct><analytic><author><persName><forename>F"),
        (F.col("doc_id") % 7).cast("string"), F.lit("</forename><surname>S"), doc_id,
        F.lit("</surname></persName></author><author><persName><surname>"), _escape(F.col("source")),
        F.lit('</surname></persName></author></analytic><idno type="DOI">10.5555/'), doc_id,
        F.lit('</idno></biblStruct></sourceDesc><publicationStmt><date when="'),
        (F.col("doc_id") % 25 + 2000).cast("string"),
        F.lit('-01-01"/></publicationStmt></fileDesc><profileDesc><abstract><p>'),
        _escape(F.get(lines, F.size(lines) - 1)),
        F.lit("</p></abstract></profileDesc></teiHeader><text><body>"),
        F.array_join(blocks, ""), table, F.lit("</body></text></TEI>"))
    if cut_every:
        xml = F.when(F.col("doc_id") % cut_every == 0,
                     F.left(xml, F.length(xml) - F.length("text") % 20 - 5)).otherwise(xml)
    return (docs.join(labels, "doc_id", "left").withColumn("_lines", F.split("text", "\n"))
            .select(doc_id.alias("paper_id"), "doc_id", xml.alias("tei_xml")))


# X2: ``orders`` as model responses. An order answers with o_orderkey % 4 records,
# so some papers have none. Faults go by o_orderkey % 50.
_FAULTS = {
    "cut": 0, "wrong_type": 1, "null_rows": 2, "numbers_as_text": 3, "fenced": 4, "bare_string_list": 5,
    "null_measurement": 6,
}
# Fields as they come from a model that follows the schema, except in these papers.
_LOOSE = f"o_orderkey % 50 IN ({_FAULTS['numbers_as_text']}, 7, 8, 9)"


def _is(fault: str) -> str:
    return f"o_orderkey % 50 = {_FAULTS[fault]}"


def _x2_record(i: str, material: str = "o_custkey", factor: int = 1, with_ph: bool = True, broken: str = "false") -> str:
    """JSON text of the i-th record of an order."""
    number = lambda sql: f"if({_is('numbers_as_text')}, concat('\" ', {sql}, ' \"'), cast({sql} AS string))"
    ph = f"""'"ph":', {number('o_custkey % 140 / 10')}, ','""" if with_ph else "''"
    measurement = f"""if({_is('null_measurement')}, 'null', concat('{{"pressure_bar":',
        CASE WHEN ({_is('wrong_type')} AND {i} = 0) OR {broken} THEN '"~9"' ELSE {number('o_custkey % 50')} END,
        ',"gas_composition":"', o_orderpriority, '","wet_dry_air":',
        CASE WHEN o_orderstatus <> 'O' THEN 'false' WHEN {_LOOSE} THEN '"yes"' ELSE 'true' END,
        ',"co2_adsorption_capacity_mmol_g":', o_totalprice * {factor}, '}}'))"""
    return f"""concat('{{"material_id":"P', {material}, '-', {i}, '","extra":[1,', {i}, '],"study_metadata":{{"year":',
        if({_LOOSE}, concat('"', year(o_orderdate), '"'), string(year(o_orderdate))), ',"doi":"10.5555/', o_orderkey, '","title":"Order \\\\\\"', o_orderkey, '\\\\\\""}},"synthesis_method":{{"method_name":',
        CASE WHEN {i} % 2 = 1 THEN concat('["a","', o_orderstatus, '"]')
        WHEN {_LOOSE} THEN concat('"step ', o_orderpriority, '"') ELSE concat('["step ', o_orderpriority, '"]') END,
        ',"metal_precursors":', if({_is('bare_string_list')}, '"MgCl2"', concat('["', o_orderstatus, '","M', {i}, '",""]')),
        ',', {ph}, '"exfoliation":',
        if({_LOOSE}, string(int(o_orderstatus = 'F')), string(o_orderstatus = 'F')), '}},"measurement":', {measurement}, '}}')"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2: one adsorption response per order."""
    rows = f"array_join(transform(slice(array(0, 1, 2), 1, int(o_orderkey % 4)), i -> {_x2_record('i')}), ',')"
    whole = f"""if({_is('null_rows')}, '{{"rows":null}}', concat('{{"rows":[', {rows}, ']}}'))"""
    body = f"""CASE WHEN {_is('cut')} THEN '{{"rows":[{{"material_id":' WHEN {_is('fenced')}
        THEN concat('Result:\n```json\n', {whole}, '\n```\n') ELSE {whole} END"""
    return read_spread(spark, sf_dir, "orders", "o_orderkey").selectExpr(
        "cast(o_orderkey AS string) AS paper_id", f"{body} AS body")


def verification_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2: the answer of the verification of each record.

    o_orderkey % 3: 0 a changed record (twice the capacity, no pH; every fifth
    customer another material), 1 an invalid one, 2 none at all.
    """
    record = _x2_record("i", "(o_custkey + if(o_custkey % 5 = 0, 1, 0))", 2, False, "o_orderkey % 3 = 1")
    return (
        read_spread(spark, sf_dir, "orders", "o_orderkey")
        .selectExpr("*", "explode(slice(array(0, 1, 2), 1, int(o_orderkey % 4))) AS i")
        .selectExpr("cast(o_orderkey AS string) AS paper_id", "i AS row_idx",
                    f"if(o_orderkey % 3 = 2, NULL, {record}) AS body")
    )


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3: ``events`` as attempts, four consecutive events to a request."""
    return read(spark, sf_dir, "events").selectExpr(
        "concat('r', cast(floor(event_id / 4) AS bigint)) AS request_id", "cast(event_id % 4 + 1 AS int) AS attempt",
        "CASE event_type WHEN 'signup' THEN 'incomplete' WHEN 'error' THEN 'transient' WHEN 'view' THEN 'transient' "
        "ELSE 'ok' END AS status",
        "cast(user_id % 40 * 1000 AS int) AS max_tokens", "user_id % 7 = 0 AS escalated",
        "props AS body", "concat(event_type, ' ', event_id) AS error")


def line_records(spark: SparkSession, sf_dir: str, schema: ExtractionSchema) -> DataFrame:
    """X4: ``lineitem`` as records; equal (l_orderkey, l_linenumber) are variants.

    The key fields depend on that pair only (case and spacing of the material
    vary); the others are missing in two of three variants. row_idx orders the
    variants of an order by part and supplier.
    """
    present = lambda n, sql: f"if(l_partkey % 3 = {n}, NULL, {sql})"
    values = {
        "material_id": "concat(if(l_partkey % 2 = 0, 'mat  ', 'MAT '), l_orderkey)",
        "study_metadata.year": "year(l_shipdate)",
        "study_metadata.doi": "concat('10.5555/', l_orderkey)",
        "synthesis.temperature": present(0, "l_quantity"),
        "synthesis.ph": present(1, "l_discount * 100"),
        "synthesis.aging_time_hr": present(2, "l_tax * 100"),
        "synthesis.method_name": "if(l_suppkey % 2 = 0, array(l_returnflag, l_linestatus), array())",
        "measurement.adsorption_temperature_c": "double(l_linenumber)",
        "measurement.gas_composition": "'CO2'",
        "measurement.wet_dry_air": "l_linenumber % 2 = 0",
        "measurement.co2_adsorption_capacity_mmol_g": "l_linenumber / 2",
        "performance.temperature": "double(l_linenumber)",
        "performance.feed_composition": "'H2/CO2'",
        "performance.co2_conversion": "l_linenumber * 10D",
        "composition.anions": "if(l_suppkey % 2 = 0, array('CO3', 'Cl'), array('cl', 'co3'))",
    }
    alias = {"synthesis_method": "synthesis", "synthesis_conditions": "synthesis",
             "material_properties": "composition", "metal_composition": "composition"}

    def leaf(path: str, kind) -> str:
        parent, _, name = path.rpartition(".")
        sql = values.get(f"{alias.get(parent, parent)}.{name}" if parent else name)
        return f"cast({sql or ('array()' if kind.typeName() == 'array' else 'NULL')} AS {kind.simpleString()})"

    return read_spread(spark, sf_dir, "lineitem", "l_orderkey").selectExpr(
        "cast(l_orderkey AS string) AS paper_id", "l_partkey * 100000 + l_suppkey AS row_idx",
        f"{nest(leaf, schema)} AS record")


SAME_WORDS = ("CASE event_id % 3 WHEN 0 THEN concat('Use ', event_type) WHEN 1 THEN concat('use  ', event_type, '.') "
              "ELSE concat(' USE ', event_type) END")
# Six, seven and eight content words, each set in the next; the first two and the last two are similar, and other words or fillers about them.
CHAIN = ("CASE event_id % 4 WHEN 0 THEN concat('removal of dilute CO2 from ', event_type, ' gas streams') "
         "WHEN 1 THEN concat('Removal of dilute CO2 from the wet ', event_type, ' gas streams') "
         "WHEN 2 THEN concat('removal of dilute CO2 from hot, wet ', event_type, ' gas streams') ELSE concat('storage of CO2, ', event_type) END")


def event_records(spark: SparkSession, sf_dir: str, phrase: str = SAME_WORDS) -> DataFrame:
    """X5: ``events`` as use-case records; a user is a material, its events are use cases."""

    def leaf(path: str, kind) -> str:
        sql = {"material_id": "concat('U', user_id)", "use_cases": f"if(event_id % 5 = 4, array(), array({phrase}))",
               "synthesis_method.ph": "if(event_id % 2 = 0, value, NULL)"}.get(path)
        return f"cast({sql or ('array()' if kind.typeName() == 'array' else 'NULL')} AS {kind.simpleString()})"

    return read(spark, sf_dir, "events").selectExpr(
        "cast(user_id % 50 AS string) AS paper_id", "event_id AS row_idx", f"{nest(leaf, USECASE)} AS record")


def recorded_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6: a manifest over ``orders``; counts come from the order's key and customer."""
    counts = ("map_concat(map('n_catalyst_materials', o_orderkey % 3, 'n_adsorption_materials', o_custkey % 2), "
              "if(o_orderkey % 10 = 0, map(), map('n_usecase_materials', o_custkey % 3)))")
    return (
        read(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0")
        .selectExpr(
            "cast(o_orderkey AS string) AS paper_id", "if(o_orderstatus = 'P', 'error', 'ok') AS status",
            "if(o_orderstatus = 'P', 'extract', NULL) AS stage", "if(o_orderstatus = 'P', 'boom', NULL) AS error",
            f"if(o_orderstatus = 'P', cast(map() AS map<string,bigint>), cast({counts} AS map<string,bigint>)) AS counts",
            "cast(1 + o_orderkey % 3 AS int) AS attempts"))


def order_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr("cast(o_orderkey AS string) AS paper_id", "o_orderkey", "o_custkey")


def table_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7: ``orders`` as papers with two tables: one of sorbents with conditions in its headings and a nameless row, and one that is,
    by o_orderkey % 3, a transposed one of sorbents, one of catalysts with two heading rows, or one of catalysts."""
    row = lambda *cells: f"array({', '.join(cells)})"
    table = lambda caption, *rows: f"named_struct('label', '1', 'caption', {caption}, 'rows', array({', '.join(rows)}))"
    key, v, c = "string(o_orderkey)", "string(o_custkey % 1000)", "string(o_custkey % 50)"
    sorbents = table(
        "'CO2 uptake'", row("'Sample'", "'CO2 uptake 25 °C (mmol/g)'", "'Uptake at 323.15 K (mg/g)'", "'p (kPa)'"),
        row(f"concat('S', {key})", v, f"if(o_custkey % 2 = 0, {c}, '')", "'100'"), row("''", "''", "'n/a'", "'50'"))
    turned = table(
        "''", row("'Material'", f"concat('A', {key})", f"concat('B', {key})"), row("'Capacity (mmol/g)'", v, c), row("'Temperature (K)'", "'298.15'", "'323.15'"))
    results = row(f"concat('C', {key})", c, "string(o_custkey % 100)", "'90 ± 2'")
    two = table("'Results at 2 bar'", row("'Catalyst'", "'CO2 conversion (%)'", "''", "'CH4 selectivity (%)'"), row("''", "'300 °C'", "'623 K'", "''"), results)
    one = table("'Results at 2 bar'", row("'Catalyst'", "'CO2 conversion at 300 °C (%)'", "'Conversion 623 K / %'", "'Selectivity to methane (%)'"), results)
    second = f"CASE o_orderkey % 3 WHEN 0 THEN {turned} WHEN 1 THEN {two} ELSE {one} END"
    return read_spread(spark, sf_dir, "orders", "o_orderkey").selectExpr(
        "cast(o_orderkey AS string) AS paper_id", f"concat('Order ', {key}) AS title", f"concat('10.5555/', {key}) AS doi", "year(o_orderdate) AS year",
        f"array({sorbents}, {second}) AS tables")
