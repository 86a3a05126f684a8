import pytest

from oreleaf.functions import sqltext as Q
from oreleaf.functions import xml as X
from oreleaf.operators import documents as D
from oreleaf.plans import encodings as E

NS = 'xmlns="http://www.tei-c.org/ns/1.0"'

BASIC = f"""<?xml version="1.0" encoding="UTF-8"?>
<TEI {NS}>
  <teiHeader>
    <fileDesc>
      <titleStmt><title level="a">Zinc sorbents &amp; <i>films</i></title></titleStmt>
      <sourceDesc><biblStruct>
        <analytic>
          <author><persName><forename type="first">Ada</forename><forename>Q</forename><surname>Roe</surname></persName></author>
          <author><persName><surname>Mono</surname></persName></author>
          <author><persName/></author>
        </analytic>
        <idno type="DOI"> 10.5555/abc<!-- x -->tail </idno>
        <idno type="DOI">10.5555/second</idno>
      </biblStruct></sourceDesc>
      <publicationStmt><date when="2021-03-04">2021</date></publicationStmt>
    </fileDesc>
    <profileDesc><abstract><p>First.</p><p>Second.</p></abstract></profileDesc>
  </teiHeader>
  <text>
    <body>
      <div>
        <head>Methods</head>
        <p>one <ref>[1]</ref> two</p>
        <p>  </p>
        <p>a &lt;c&gt; &#60;d&#62;<b>x</b> <i>y</i></p>
        <figure><head>plain</head><figDesc>never shown</figDesc></figure>
        <div><p>inner</p>
          <div><head>Deep</head><p>deep <![CDATA[<raw> & ]]>text</p>
            <div><div><p>fifth</p></div></div>
          </div>
        </div>
        <p>after inner</p>
      </div>
      <div><head>No text</head></div>
      <div n="3"/>
      <figure type="table">
        <label>1</label><head>Areas</head><figDesc>not the caption</figDesc>
        <table>
          <row role="label"><cell>Sample</cell><cell>BET</cell></row>
          <row/>
          <row><cell cols="2">M-1</cell><cell/></row>
        </table>
      </figure>
      <figure type="table"><label>2</label></figure>
    </body>
    <back>
      <figure coords="1" type='table'><head>Only a caption</head></figure>
      <figure type="table"><head>Nested</head>
        <table><row><cell>o1</cell><cell><table><row><cell>i1</cell></row></table></cell></row><row><cell>o2</cell></row></table>
      </figure>
      <div type="references"><listBibl><biblStruct><p>bibliography</p></biblStruct></listBibl></div>
    </back>
  </text>
</TEI>
"""


@pytest.fixture(scope="module")
def parsed(spark):
    rows = {
        "basic": BASIC,
        "prefixed": BASIC.replace("<?xml version=\"1.0\" encoding=\"UTF-8\"?>\n", "").replace("<!-- x -->", "")
            .replace("<![CDATA[<raw> & ]]>", "&lt;raw&gt; &amp; ").replace("</", "</tei:").replace("<", "<tei:")
            .replace("<tei:/tei:", "</tei:").replace("xmlns=", "xmlns:tei="),
        "no_body": f"<TEI {NS}><teiHeader/><text/></TEI>",
        "no_ns": "<TEI><teiHeader><titleStmt><title>t</title></titleStmt></teiHeader></TEI>",
        "short_year": f'<TEI {NS}><teiHeader><publicationStmt><date when="20"/></publicationStmt>'
                      '<idno type="DOI"> </idno></teiHeader></TEI>',
        "bad_year": f'<TEI {NS}><teiHeader><publicationStmt><date when="c. 1999"/></publicationStmt></teiHeader></TEI>',
        "no_when": f"<TEI {NS}><teiHeader><publicationStmt><date>2001</date></publicationStmt></teiHeader></TEI>",
        "foreign": f'<TEI {NS} xmlns:m="urn:m"><text><body><div><m:p>skip</m:p><p>keep <m:x>in</m:x></p>'
                   "</div></body></text></TEI>\n<!-- trailing -->\n",
        "cut": BASIC[:900],
        "mismatch": f"<TEI {NS}><text></TEI></text>",
        "bare_amp": f"<TEI {NS}><text>&</text></TEI>",
        "junk_after": f"<TEI {NS}></TEI>junk",
        "two_roots": f"<TEI {NS}></TEI><TEI></TEI>",
        "entity": f"<TEI {NS}><text>&nbsp;</text></TEI>",
        "empty": "",
        "plain": "not xml",
        "null": None,
    }
    tei = spark.createDataFrame(list(rows.items()), "paper_id string, tei_xml string")
    return {r["paper_id"]: r for r in D.with_document_text(D.parse_tei(tei)).collect()}


def test_metadata(parsed):
    r = parsed["basic"]
    assert r["title"] == "Zinc sorbents &  films"
    assert r["doi"] == "10.5555/abc"
    assert r["year"] == 2021
    assert r["authors"] == ["Ada Roe", "Mono"]
    assert r["abstract"] == "First. Second."
    assert r["parse_error"] is None


def test_sections_at_any_depth_in_document_order(parsed):
    sections = [(s["heading"], s["text"]) for s in parsed["basic"]["sections"]]
    assert sections == [
        ("Methods", "one  [1]  two\na <c> <d> x   y\nafter inner"),
        ("Untitled section", "inner"),
        ("Deep", "deep <raw> & text"),
        ("Untitled section", "fifth"),
    ]


def test_tables(parsed):
    tables = [(t["label"], t["caption"], t["rows"]) for t in parsed["basic"]["tables"]]
    assert tables == [
        ("1", "Areas", [["Sample", "BET"], ["M-1", ""]]),
        ("", "Only a caption", []),
        ("", "Nested", [["o1", "i1"], ["i1"], ["o2"]]),
    ]


def test_rendered_text(parsed):
    text = parsed["basic"]["llm_text"]
    assert text.startswith("Title: Zinc sorbents &  films\nDOI: 10.5555/abc\nYear: 2021\n\nAbstract:\nFirst. Second.\n\n## Methods\n")
    assert text.endswith("## Tables\n\nTable 1: Areas\nSample | BET\nM-1 | \n\nTable : Only a caption\n\nTable : Nested\no1 | i1\ni1\no2")
    assert "bibliography" not in text and "never shown" not in text and "Ada" not in text


def test_prefixed_namespace_gives_the_same_document(parsed):
    for c in ("title", "authors", "year", "abstract", "sections", "tables"):
        assert parsed["prefixed"][c] == parsed["basic"][c], c


def test_partial_documents(parsed):
    empty = "Title: UNKNOWN\nDOI: UNKNOWN\nYear: UNKNOWN"
    for k in ("no_body", "no_ns", "bad_year", "no_when"):
        assert parsed[k]["parse_error"] is None and parsed[k]["llm_text"] == empty, k
        assert parsed[k]["sections"] == [] and parsed[k]["tables"] == [] and parsed[k]["authors"] == []
    assert parsed["short_year"]["year"] == 20 and parsed["short_year"]["doi"] == ""
    assert [s["text"] for s in parsed["foreign"]["sections"]] == ["keep  in"]


def test_malformed_documents_are_kept_with_a_reason(parsed):
    bad = {k for k, r in parsed.items() if r["parse_error"]}
    assert bad == {"cut", "mismatch", "bare_amp", "junk_after", "two_roots", "entity", "empty", "plain", "null"}
    assert all(parsed[k]["llm_text"] is None for k in bad)


def test_truncation(spark, parsed):
    tei = spark.createDataFrame([("p", BASIC)], "paper_id string, tei_xml string")
    text = D.with_document_text(D.parse_tei(tei), max_chars=30).first()["llm_text"]
    assert text == parsed["basic"]["llm_text"][:30]


def test_text_behind_or_within_the_root(spark):
    a = "<a>{}</a>"
    good = [a.format(""), "<a></a\n>\r\n", "<a/>\n", "<a></a ><!-- c --> <?p?>", a.format("&lt;/a&gt;")]
    bad = ["", "/>", "abc</>", a.format("") + "x", a.format("") * 2, a.format("") + ">", "<a/>x", "<a></a>\u0085", a.format("\u0001"), None]
    rows = [(str(i), xml) for i, xml in enumerate(good + bad)]
    errors = D.parse_tei(spark.createDataFrame(rows, "paper_id string, tei_xml string")).select("paper_id", "parse_error").collect()
    assert {int(r.paper_id): r.parse_error is not None for r in errors} == {i: i >= len(good) for i in range(len(rows))}


def test_strip_knows_all_white_space(spark):
    points = spark.range(1, 0x10000).where(f"id NOT BETWEEN {0xD800} AND {0xDFFF}")
    values = points.selectExpr("decode(unhex(lpad(hex(id), 8, '0')), 'utf-32') AS c").selectExpr("concat(c, c, 'a', c, 'b', c) AS v")
    assert values.where(f"NOT ({Q.strip('v')} <=> regexp_replace(v, r'(?U)^\\s+|\\s+$', ''))").count() == 0
    assert values.where(f"{Q.strip('v')} <> v").count() == 25


def test_an_expression_is_cut_into_elements_once():
    # The argument may itself be costly, and a lookahead would be tried at every character of a document.
    cut = X.elements("array_join(given, '')", "author")
    assert cut.count("array_join(given, '')") == 1 and "(?=" not in cut


def test_a_document_is_split_into_lines_once(spark, tmp_path):
    text = "\n".join(f"line {i} & <b>" for i in range(12))
    spark.createDataFrame([(1, text, "s"), (2, None, "s")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    tei = E.tei_documents(spark, str(tmp_path))
    assert tei._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    papers = {r.paper_id: r for r in D.parse_tei(tei).collect()}
    assert [s.text.split("\n") for s in papers["1"].sections] == [text.split("\n")[i:i + 5] for i in (0, 5, 10)]
    assert papers["2"].parse_error is not None
