"""Markup nesting against a plain stack simulation, headings, links and texts."""

from hypothesis import HealthCheck, given, settings, strategies as st

from sitecorpus.functions.dims import VOID_TAGS
from sitecorpus.operators import html, links

TOKENS = st.lists(st.sampled_from(["<div>", "</div>", "<p>", "</p>", "<br>", "<b>", "</b>", "<i/>", "</x>"]), max_size=25)


def simulate(tokens):
    """(pos, parent_pos, depth) of every element: any close tag pops one level, the root is never popped."""
    stack, out = [], []
    for pos, tok in enumerate(tokens):
        name = tok.strip("</>")
        if tok.startswith("</"):
            if stack:
                stack.pop()
            continue
        out.append((pos, stack[-1] if stack else None, len(stack)))
        if not tok.endswith("/>") and name not in VOID_TAGS:
            stack.append(pos)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(TOKENS, min_size=5, max_size=20))
def test_nesting_equals_stack(spark, docs):
    df = spark.createDataFrame([(i, "http://a.b/", "".join(d)) for i, d in enumerate(docs)], "page_id bigint, url string, html string")
    got = {i: [] for i in range(len(docs))}
    for r in html.element_rows(df).collect():
        got[r.page_id].append((r.pos, r.parent_pos, r.depth))
    for i, d in enumerate(docs):
        assert sorted(got[i]) == sorted(simulate(d))
    sub = {(r.page_id, r.pos): r.descendants for r in html.subtree_counts(df).collect()}
    for i, d in enumerate(docs):
        nodes = simulate(d)
        parent = {p: q for p, q, _ in nodes}
        below = dict.fromkeys(parent, 0)
        for p in parent:
            q = parent[p]
            while q is not None:
                below[q] += 1
                q = parent[q]
        assert {p: sub[(i, p)] for p in parent} == below


def test_comments_and_scripts_hold_no_tags(pages):
    df = pages('<div><!-- <p> --><script>var t="</p><b>";</script><style>a{b:c}</style><p>Hi you</p></div>')
    assert [r.tag for r in html.element_rows(df).orderBy("pos").collect()] == ["div", "script", "style", "p"]


def test_heading_skip(pages):
    rows = html.heading_skips(pages("<h1>a</h1><h3>b</h3><h2>c</h2><h5>d</h5>", "<h1>a</h1><h2>b</h2>")).collect()
    assert [(r.page_id, r.prev_level, r.level, r.is_first) for r in rows] == [(0, 1, 3, True), (0, 2, 5, False)]


def test_internal_links(pages):
    df = pages('<a href="/x#f">1</a><a href="/x">2</a><a href="https://site.example/y?q=1">3</a><a href="https://other.example/z">4</a>'
               '<a href="mailto:a@b">5</a><a href="#t">6</a><a href="/">7</a>')
    assert [(r.target_path, r.rank) for r in links.internal_links(df).orderBy("rank").collect()] == [("/x", 1), ("/y", 2)]


def test_platform_prefers_url(pages):
    df = pages('<div data-wf-site="1">', '<div data-wf-site="1">', "<p>plain</p>", url=["https://a.wixsite.com/x", "https://b.example/x", "https://c.example/"])
    got = {r.page_id: (r.platform, r.evidence) for r in links.platform_detect(df).collect()}
    assert got == {0: ("wix", "url"), 1: ("webflow", "html"), 2: (None, None)}


def tokens_of(df):
    from sitecorpus.operators.html import html_tokens

    return [(r.kind, r.tag, r.attrs, r.text) for r in html_tokens(df).orderBy("page_id", "pos").collect()]


def test_text_runs_to_the_next_tag(pages):
    assert tokens_of(pages("<p>a < b and more text here</p>")) == [("open", "p", "", "a < b and more text here"), ("close", "p", "", "")]
    assert tokens_of(pages("<p>1 <2 << 3 </ 4<b>x")) == [("open", "p", "", "1 <2 << 3 </ 4"), ("open", "b", "", "x")]


def test_quoted_values_may_hold_brackets(pages):
    assert tokens_of(pages("""<a title="x > y" href='/q>'>z</a>""")) == [("open", "a", """ title="x > y" href='/q>'""", "z"), ("close", "a", "", "")]
    assert tokens_of(pages('<p title="open>text</p>'))[0] == ("open", "p", ' title="open', "text")


def test_character_data_is_text(pages):
    assert tokens_of(pages("<p><![CDATA[some text]]></p>"))[0][3] == "some text"


def test_long_text_and_attributes(pages):
    got = tokens_of(pages(f'<p a={"x" * 50_000} b="{"y" * 50_000}">{"word " * 20_000}</p>'))
    assert len(got) == 2 and len(got[0][3]) == 99_999


def test_sites_of_odd_urls(pages):
    from sitecorpus.operators.html import with_site

    urls = ["https://WWW.my_shop.example/a|b", "http://user@h.example:80/x", "no url", None]
    assert [r.site for r in with_site(pages("<p>", "<p>", "<p>", "<p>", url=urls)).orderBy("page_id").collect()] == ["my_shop.example", "h.example", "", ""]


def test_all_links_count(pages):
    from sitecorpus.operators.links import internal_links, site_link_graph

    hub = "".join(f'<a href="/p{i}">x</a>' for i in range(60))
    df = pages(hub, *["<p>"] * 60, url=["https://h.example/"] + [f"https://h.example/p{i}" for i in range(60)])
    assert internal_links(df).count() == 60
    assert [r.path for r in site_link_graph(df).filter("orphan").collect()] == ["/"]


def test_absolute_srcset_entries_go(spark, pages):
    from sitecorpus.operators.html import srcset_strip

    cases = {
        '<img srcset="https://c/a.png 1x, img/b.png 2x" alt="x">': '<img srcset="img/b.png 2x" alt="x">', '<img srcset="https://c/a.png 1x,http://c/b.png 2x">': "<img >",
        '<img srcset="a.png 1x , b.png 2x"><p>y</p>': '<img srcset="a.png 1x, b.png 2x"><p>y</p>', '<i srcset="open': '<i srcset="open', "none": "none", '<a srcset="">': "<a >",
    }
    got = {r.page_id: (r.html, r.removed) for r in srcset_strip(pages(*cases)).collect()}
    assert [got[i] for i in range(len(cases))] == [(want, len(case) - len(want)) for case, want in cases.items()]
