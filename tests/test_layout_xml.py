"""Layout documents as XML, and the style and widget rules, with expected rows written by hand."""

import pytest

from sitecorpus.operators import layout
from sitecorpus.plans import layout_queries, registry
from sitecorpus.sources import design_xml

DOC = """<?xml version="1.0"?><!-- a <Frame> that is none --><Layout page="7">
 <Frame name="Cards grid" stackGap='8px' padding="1px 2px 3px" wide>
  before a child <Text name="Heading 1" font-size="32px" font-family="'Brand Sans', serif" line-height="120%" color="#FFF">Hello &amp;
   <!-- no --> welcome</Text>
  <Text name="body" text="given" letter-spacing="-0.02em" font-weight="700" line-height="1.5"/>
  <circle name="dot" borderRadius="1px 2px 3px 4px" r="2 > 1"/>
  <Circle name="dot2"/><![CDATA[ a <b> c ]]>
 </Frame>
 <Frame name="hero" position="absolute" opacity="" width="auto" height="50vh" maxWidth="10" backgroundColor="rgb(1, 2, 3)"><Deep><Deeper><Deepest name="x" name="y"/></Deeper></Deep></Frame>
 <Frame name="pic" backgroundImage="url(a.png)"/><Frame name="box" grid-template-rows="auto" a=b/><Frame position="absolute" left="auto" componentName="C"/>
</Layout>"""


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(7, DOC)], "page_id bigint, xml string")


def test_elements(docs):
    rows = design_xml.xml_elements(docs).orderBy("pos").collect()
    assert [(r.tag, r.depth, r.ord, r.text) for r in rows] == [
        ("Frame", 0, 1, "a <b> c"), ("Text", 1, 1, "Hello & welcome"), ("Text", 1, 2, ""), ("circle", 1, 3, ""), ("Circle", 1, 4, ""),
        ("Frame", 0, 2, ""), ("Deep", 1, 1, ""), ("Deeper", 2, 1, ""), ("Deepest", 3, 1, ""), ("Frame", 0, 3, ""), ("Frame", 0, 4, ""), ("Frame", 0, 5, ""),
    ]
    at = {r.pos: r.tag for r in rows}
    assert [at.get(r.parent_pos) for r in rows] == [None, "Frame", "Frame", "Frame", "Frame", None, "Frame", "Deep", "Deeper", None, None, None]
    maps = [dict(r.attributes) for r in rows]
    assert maps[0] == {"name": "Cards grid", "stackGap": "8px", "padding": "1px 2px 3px", "wide": "true"}
    assert maps[3] == {"name": "dot", "borderRadius": "1px 2px 3px 4px", "r": "2 > 1"} and maps[8] == {"name": "y"} and maps[10] == {"name": "box", "grid-template-rows": "auto", "b": "true"}


def test_widgets(docs):
    got = layout.widget_classify(design_xml.xml_layout_nodes(docs)).orderBy("pos").collect()
    assert [r.widget for r in got] == [
        "e-flexbox", "e-heading", "e-paragraph", "e-svg", "e-flexbox", "e-flexbox", "e-flexbox", "e-flexbox", "e-flexbox", "e-image", "e-div-block", "e-component",
    ]
    assert [r.html_tag for r in got][:3] == ["h2", "h1", "p"]


def test_style_properties(docs):
    classified = layout.widget_classify(design_xml.xml_layout_nodes(docs))
    got = {}
    for r in layout.style_prop_rows(classified).collect():
        got.setdefault(r.pos, {})[r.prop] = (r.vtype, r.num if r.num is not None else r.text, r.unit)
    by_name = {r.name: got.get(r.pos, {}) for r in classified.collect()}
    px = lambda n: ("size", float(n), "px")
    word = lambda s: ("string", s, None)
    assert by_name["Cards grid"] == {
        "display": word("flex"), "gap": px(8), "padding.block-start": px(1), "padding.block-end": px(3), "padding.inline-start": px(2), "padding.inline-end": px(2),
    }
    assert by_name["Heading 1"] == {"font-size": px(32), "font-family": word("Brand Sans"), "line-height": ("size", 1.2, "custom"), "color": ("color", "#ffffff", None)}
    assert by_name["body"] == {"letter-spacing": ("size", -0.02, "em"), "font-weight": word("700"), "line-height": ("size", 1.5, "custom")}
    assert by_name["dot"] == {f"border-radius.{k}": px(n) for k, n in (("start-start", 1), ("start-end", 2), ("end-end", 3), ("end-start", 4))}
    assert by_name["hero"] == {
        "display": word("flex"), "height": ("size", 50.0, "vh"), "max-width": px(10), "background": ("color", "#010203", None), "opacity": ("size", 0.0, "custom"),
    }  # absolute without offsets gives no position, a width that is no dimension nothing
    assert by_name["box"] == {"display": word("block")} and by_name[None]["position"] == word("absolute") and by_name[None]["left"] == word("auto")


@pytest.mark.parametrize("tag", layout.DRAWING_TAGS)
def test_drawing_tags(spark, tag):
    xml = f'<Layout page="1"><{tag} name="shape"/><{tag.upper()} name="shape"/></Layout>'
    got = layout.widget_classify(design_xml.xml_layout_nodes(spark.createDataFrame([(1, xml)], "page_id bigint, xml string"))).orderBy("pos").collect()
    assert [r.widget for r in got] == ["e-svg", "e-flexbox"]


def test_grids(spark):
    kids = lambda n: "<k/>" * n
    xml = '<Layout page="1">' + "".join(f'<a name="{i}" {attr}>{kids(n)}</a>' for i, (attr, n) in enumerate([
        ('display="grid"', 2), ('display="grid"', 3), ('display="grid"', 4), ('display="grid"', 5), ('display="grid"', 1), ('grid-template-columns="9px"', 0), ('grid-template-rows="9px"', 4)])) + "</Layout>"
    c = layout.widget_classify(design_xml.xml_layout_nodes(spark.createDataFrame([(1, xml)], "page_id bigint, xml string")))
    names = {r.pos: r.name for r in c.filter("name is not null").collect()}
    got = {names[r.pos]: r.text for r in layout.style_prop_rows(c).filter("prop = 'grid-template-columns'").collect()}
    assert got == {"0": "1fr 1fr", "1": "1fr 1fr 1fr", "2": "1fr 1fr 1fr 1fr", "3": "repeat(auto-fit, minmax(250px, 1fr))", "5": "9px"}


def test_many_documents_in_a_file(spark, tmp_path):
    good = "".join(f'<Layout page="{i}"><a name="n{i}">\n<b/></a></Layout>\n' for i in range(1000))
    (tmp_path / "one.xml").write_text(good + "<Layout page='2000'><a><b></Layout> junk <x></Layout> \n")
    (tmp_path / "two.xml").write_text('<?xml version="1.0"?>\n' + DOC.replace('page="7"', 'page="7000"'))
    docs = design_xml.read_layout_xml(spark, str(tmp_path))
    bad = docs.filter("not sound").collect()
    assert sorted(str(r.page_id) for r in bad) == ["2000", "None"]
    assert docs.filter("sound").count() == 1001 and docs.filter("sound").select("page_id").distinct().count() == 1001
    assert design_xml.xml_elements(docs.filter("sound")).count() == 2000 + 12


def test_written_and_read_again(spark, tmp_path):
    rows = [(1, 3, None, 0, "a", 'x "y" <z> &amp; \'', "n"), (1, 4, 3, 1, "b", None, "m&m"), (1, 9, 4, 2, "c", "", None), (1, 10, 3, 1, "d", "t", "k"), (1, 12, None, 0, "e", "", "l"), (2, 0, None, 0, "f", "", "o")]
    nodes = spark.createDataFrame(rows, "page_id bigint, pos int, parent_pos int, depth int, tag string, text string, name string")
    for c in design_xml.NODE_ATTRIBUTES:
        if c != "name":
            nodes = nodes.selectExpr("*", f"cast(null as string) as {c}")
    design_xml.layout_xml(nodes).select("xml").write.text(f"{tmp_path}/x")
    got = design_xml.xml_layout_nodes(design_xml.read_layout_xml(spark, f"{tmp_path}/x").filter("sound")).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.depth, r.tag, r.name) for r in got] == [(r[0], r[3], r[4], r[6]) for r in rows]
    assert [r.text for r in got] == ["", "", "", "t", "", ""]  # a text before a child is none


def test_named_colors(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<S><ColorStyle name="a" value="#1"/><ColorStyle id="b" color="#2"></ColorStyle><ColorStyle name="a" hex="#3"/><Color name="b" value="#4"/>'
                                    '<Color name="c" value="#5"/><Color name="c" value="#6"/><Color id="d" value="#7"/><ColorStyle name="e"/><Color name="e" hex="#8"/></S>')
    assert {(r.name, r.value, r.tag) for r in design_xml.named_colors(spark, str(tmp_path)).collect()} == {
        ("a", "#3", "ColorStyle"), ("b", "#2", "ColorStyle"), ("c", "#5", "Color"), ("e", "#8", "Color")}


def test_fonts_and_colors_become_variables(spark):
    props = spark.createDataFrame([
        ("s", 1, 1, "color", "color", "#112233"), ("s", 1, 2, "font-family", "string", "Brand Sans"), ("s", 1, 3, "font-family", "string", "Other"),
        ("s", 1, 4, "font-weight", "string", "inter"), ("t", 2, 1, "color", "color", "#112233")], "site string, page_id int, pos int, prop string, vtype string, text string")
    kit = spark.createDataFrame([("s", "e-gv-1", "color", "#112233", "#112233", "a"), ("s", "e-gv-2", "font", '"brand sans"', None, "b"), ("s", "e-gv-3", "font", "inter", None, "c")],
                                "site string, gv_id string, type string, value string, hex string, ord string")
    got = {(r.site, r.pos): (r.vtype, r.text, r.ref_id) for r in layout.gv_substitute(props, kit).collect()}
    assert got == {("s", 1): ("global-color-variable", None, "e-gv-1"), ("s", 2): ("global-font-variable", None, "e-gv-2"), ("s", 3): ("string", "Other", None),
                   ("s", 4): ("string", "inter", None), ("t", 1): ("color", "#112233", None)}


def test_style_values_are_parsed_once(docs):
    rows = layout.style_prop_rows(layout.widget_classify(design_xml.xml_layout_nodes(docs)))
    generator = next(x for x in rows._jdf.queryExecution().optimizedPlan().toString().split("\n") if "inline(" in x)
    assert "split(" not in generator and "regexp_extract(" not in generator


def test_layout_xml_is_written_in_parts_of_few_pages(spark, tmp_path):
    html = "<html><body><div><p>a</p><img src='x.png'></div></body></html>"
    rows = spark.range(3 * layout_queries.PAGES_A_PART).selectExpr("id AS page_id", "concat('https://s.example/', id) AS url", f"""\"{html}\" AS html""")
    rows.write.parquet(f"{tmp_path}/pages.parquet")
    t = registry.Tables(spark, str(tmp_path))
    docs = layout_queries.xml_docs(t)
    sizes = [r["count"] for r in docs.groupBy("source").count().collect()]
    assert sum(sizes) == 3 * layout_queries.PAGES_A_PART and max(sizes) < 2 * layout_queries.PAGES_A_PART


def test_component_nodes_are_written_without_texts(spark):
    nodes = layout_queries.component_nodes(registry.Tables(spark, "/root/testdata/sf0.001"))
    assert spark.read.parquet(*nodes.inputFiles()).columns == ["page_id", "node", "parent", "component"]
