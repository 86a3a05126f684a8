"""Structuring of TEI documents: one XML string per paper in, nested columns out.

Every function is narrow (row-local): metadata, sections and tables of a paper
come from that paper's own row, so nothing is shuffled before a caller joins or
aggregates the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreleaf.functions import sqltext as Q
from oreleaf.functions import xml as X
from oreleaf.functions.frames import fan_out
from oreleaf.functions.text import null_if_empty, strip, strip_chars

UNTITLED = "Untitled section"
UNKNOWN = "UNKNOWN"
MALFORMED = "malformed XML"

_CELLS = "ARRAY<STRUCT<cell: ARRAY<STRING>>>"
_FIGURE_FIELDS = f"label ARRAY<STRING>, head ARRAY<STRING>, table ARRAY<STRUCT<row: {_CELLS}>>"
_PEOPLE = "ARRAY<STRUCT<forename: ARRAY<STRING>, surname: ARRAY<STRING>>>"


def _malformed(xml: str, normal: str) -> str:
    """True for what a strict XML parser rejects; ``normal`` is the normalised string."""
    broken = (f"from_xml({xml}, '_corrupt STRING', map('columnNameOfCorruptRecord', '_corrupt', "
              "'mode', 'PERMISSIVE'))._corrupt IS NOT NULL")
    # from_xml stops behind the root element; content after it is found here: the closing tag stands at the end and
    # nowhere else. Only the last tag is cut out as a string, what is before it is searched as bytes.
    root = Q.extract(f"substring_index({normal}, '>', 1)", r"^<([^\s/>]+)", 1)

    def closes(last: str, tag: str) -> str:
        before = f"substring(cast({normal} AS binary), 1, octet_length({normal}) - octet_length({last}) - 1)"
        return (f"concat('<', {Q.replace_all(last, r'\s*>\s*$', '>')}) = {tag} "
                f"AND NOT contains({before}, cast({tag} AS binary))")

    at_end = Q.bind(f"substring_index({normal}, '<', -1)", lambda last: Q.bind(
        f"concat('</', {root}, '>')", lambda tag: closes(last, tag)))
    bare_root = f"(endswith(substring_index({normal}, '>', 1), '/') AND {Q.matches(normal, r'^<[^<>]*/>\s*$')})"
    return f"coalesce({broken} OR NOT ({at_end} OR {bare_root}), true)"


def _title(header: str) -> str:
    return Q.null_if_empty(X.element_text(X.first_child(header, "titleStmt", "title")))


def _doi(header: str) -> str:
    is_doi = lambda e: Q.matches(Q.extract(e, "^<idno[^>]*>"), r"\stype\s*=\s*[\x22\x27]DOI[\x22\x27]")
    first = f"get({Q.keep(X.elements(header, 'idno'), is_doi)}, 0)"
    return Q.strip(Q.null_if_empty(X.leading_text(X.content(first, "idno"))))


def _year(header: str) -> str:
    when = f"{X.first_child(header, 'publicationStmt', 'date', 'STRUCT<_when: STRING>')}._when"
    return Q.let(f"left({when}, 4)", lambda y: f"if({Q.matches(y, '^[0-9]+$')}, cast({y} AS int), NULL)")


def _abstract(header: str) -> str:
    return X.element_text(X.content(f"get({X.elements(header, 'abstract')}, 0)", "abstract"))


def _authors(header: str) -> str:
    source = f"array_join({X.elements(header, 'sourceDesc')}, '')"
    people = Q.each(X.child_fields(source, "author", f"persName {_PEOPLE}"),
                    lambda a: Q.or_empty(f"{a}.persName", _PEOPLE))
    part = lambda p, name: Q.bind(X.leading_text(f"get({p}.{name}, 0)"), Q.null_if_empty)
    names = Q.each(f"flatten({people})", lambda p: f"concat_ws(' ', {part(p, 'forename')}, {part(p, 'surname')})")
    return Q.or_empty(Q.each(Q.keep(names, lambda n: f"{n} <> ''"), Q.strip), "ARRAY<STRING>")


def _sections(body: str) -> str:
    divs = Q.each(X.own_content(body, "div"), lambda d: X.from_xml(d, "head ARRAY<STRING>, p ARRAY<STRING>"))

    def section(d: str) -> str:
        heading = Q.bind(X.element_text(f"get({d}.head, 0)"), lambda h: f"if({h} = '', '{UNTITLED}', {h})")
        paragraphs = Q.keep(Q.each(f"{d}.p", X.element_text), lambda p: f"{p} <> ''")
        return Q.named_struct({
            "heading": heading,
            "text": rf"coalesce(array_join({paragraphs}, '\n'), '')"})

    return Q.or_empty(Q.keep(Q.each(divs, section), lambda s: f"{s}.text <> ''"),
                      "ARRAY<STRUCT<heading: STRING, text: STRING>>")


def _tables(text: str) -> str:
    is_table = lambda f: Q.matches(Q.extract(f, "^<figure[^>]*>"), r"\stype\s*=\s*[\x22\x27]table[\x22\x27]")
    figures = Q.each(Q.keep(X.elements(text, "figure"), is_table), lambda f: Q.named_struct(
        {"xml": f, "field": X.from_xml(f, _FIGURE_FIELDS)}))

    def cells_of_rows(figure: str) -> str:
        tables = Q.or_empty(f"{figure}.field.table", f"ARRAY<STRUCT<row: {_CELLS}>>")
        direct = f"flatten({Q.each(tables, lambda t: Q.or_empty(f'{t}.row', _CELLS))})"
        # Rows that are not table/row children of the figure (nested or wrapped
        # tables) are cut out one by one, which keeps document order.
        nested = X.child_fields(f"{figure}.xml", "row", "cell ARRAY<STRING>")
        all_rows = f"regexp_count({figure}.xml, {Q.literal(r'<row[\s/>]')})"
        chosen = Q.let(direct, lambda d: f"if({all_rows} = size({d}), {d}, {nested})")
        return Q.each(chosen, lambda r: Q.or_empty(f"{r}.cell", "ARRAY<STRING>"))

    def table(figure: str) -> str:
        rows = Q.each(Q.keep(cells_of_rows(figure), lambda c: f"size({c}) > 0"), lambda c: Q.each(c, X.element_text))
        return Q.named_struct({
            "label": X.element_text(f"get({figure}.field.label, 0)"),
            "caption": X.element_text(f"get({figure}.field.head, 0)"),
            "rows": rows})

    return Q.or_empty(Q.keep(Q.each(figures, table), lambda t: f"size({t}.rows) > 0 OR {t}.caption <> ''"),
                      "ARRAY<STRUCT<label: STRING, caption: STRING, rows: ARRAY<ARRAY<STRING>>>>")


def parse_tei(tei: DataFrame) -> DataFrame:
    """tei(paper_id, tei_xml, ...) -> papers with structured columns.

    Adds title, doi, authors, year, abstract, sections, tables and parse_error.
    A document that is not well formed keeps its row, with parse_error set and
    everything else null or empty. Elements outside the TEI namespace are not
    seen, as in a namespace-aware search.
    """
    headers = f"regexp_extract_all(_doc, {Q.literal(r'(?s)<teiHeader[\s>].*?</teiHeader>')}, 0)"
    prepared = (
        tei.withColumn("_normal", F.expr(X.normalise_tei("tei_xml")))
        .withColumn("parse_error", F.expr(f"if({_malformed('tei_xml', '_normal')}, '{MALFORMED}', NULL)"))
        .withColumn("_doc", F.expr(
            f"if(parse_error IS NULL AND contains(tei_xml, '{X.TEI_NAMESPACE}'), _normal, NULL)"))
        .withColumns({
            "_header": F.expr(f"if(_doc IS NULL, NULL, concat('<h>', array_join({headers}, ''), '</h>'))"),
            "_text": F.expr(Q.null_if_empty(Q.extract("_doc", r"(?s).(<text[\s>].*)", 1)))})
        .withColumn("_body", F.expr(f"get({X.elements('_text', 'body')}, 0)"))
    )
    return prepared.withColumns({
        "title": F.expr(_title("_header")),
        "doi": F.expr(_doi("_header")),
        "authors": F.expr(_authors("_header")),
        "year": F.expr(_year("_header")),
        "abstract": F.expr(_abstract("_header")),
        "sections": F.expr(_sections("_body")),
        "tables": F.expr(_tables("_text")),
    }).drop("_normal", "_doc", "_header", "_text", "_body")


def quarantine(papers: DataFrame) -> DataFrame:
    """Documents that could not be parsed, with the reason."""
    reason = F.when(F.col("parse_error").isNotNull(), F.array("parse_error"))
    return fan_out(papers, ["paper_id"], reason, "i", "parse_error").drop("i")


def section_rows(papers: DataFrame) -> DataFrame:
    return (fan_out(papers, ["paper_id"], "sections", "section_idx", "s")
            .select("paper_id", "section_idx", "s.heading", "s.text"))


def author_rows(papers: DataFrame) -> DataFrame:
    return fan_out(papers, ["paper_id"], "authors", "author_idx", "author")


def table_rows(papers: DataFrame) -> DataFrame:
    return (fan_out(papers, ["paper_id"], "tables", "table_idx", "t")
            .select("paper_id", "table_idx", "t.label", "t.caption", "t.rows"))


def table_cells(papers: DataFrame) -> DataFrame:
    return (table_rows(papers)
            .select("paper_id", "table_idx", F.posexplode("rows").alias("row_idx", "cells"))
            .select("paper_id", "table_idx", "row_idx", F.posexplode("cells").alias("col_idx", "cell")))


def table_text(label: Column, caption: Column, rows: Column) -> Column:
    """Caption line, then one ``a | b | c`` line per row."""
    head = strip_chars(F.concat(F.lit("Table "), label, F.lit(": "), caption), ": ")
    lines = F.transform(rows, lambda r: F.array_join(F.transform(r, strip), " | "))
    return F.array_join(F.concat(F.array(head), lines), "\n")


def document_text(max_chars: int | None = None) -> Column:
    """The paper as one text: header, abstract, sections, then all tables."""
    known = lambda c: F.coalesce(null_if_empty(c), F.lit(UNKNOWN))
    year = F.nullif(F.col("year"), F.lit(0)).cast("string")
    header = F.concat(
        F.lit("Title: "), known(F.col("title")), F.lit("\nDOI: "), known(F.col("doi")),
        F.lit("\nYear: "), known(year))
    abstract = F.when(F.col("abstract") != "", F.concat(F.lit("Abstract:\n"), F.col("abstract")))
    sections = F.transform("sections", lambda s: F.concat(F.lit("## "), s["heading"], F.lit("\n"), s["text"]))
    tables = F.transform("tables", lambda t: table_text(t["label"], t["caption"], t["rows"]))
    heading = F.when(F.size("tables") > 0, F.lit("## Tables"))
    text = F.concat_ws("\n\n", header, abstract, sections, heading, tables)
    return text if max_chars is None else F.left(text, F.lit(max_chars))


def with_document_text(papers: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Adds ``llm_text``; null for documents that could not be parsed."""
    return papers.withColumn("llm_text", F.when(F.col("parse_error").isNull(), document_text(max_chars)))
