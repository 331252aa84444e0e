"""Element trees, assets and forms on literal documents."""

import json

from sitecorpus.operators import assets, checks, trees as ops
from sitecorpus.sources import files, trees


def size(n, unit="px"):
    return {"$$type": "size", "value": {"size": n, "unit": unit}}


def widget(i, kind="e-heading", **settings):
    return {"id": i, "elType": "widget", "widgetType": kind, "settings": settings, "styles": {}, "elements": []}


def docs(spark, *roots):
    return spark.createDataFrame([(str(i), json.dumps(r)) for i, r in enumerate(roots)], "page_id string, doc string")


def html_v3(text):
    return {"$$type": "html-v3", "value": {"content": {"$$type": "string", "value": text}, "children": []}}


def test_three_document_shapes(spark):
    node = {"id": "r", "elType": "e-div-block", "elements": [widget("a", title=html_v3("x"))]}
    e = trees.tree_rows(docs(spark, {"element": node}, [node], node)).collect()
    assert sorted((r.page_id, r.node_id, r.parent_ix, r.depth) for r in e if r.node_id == "a") == [(str(i), "a", 0, 1) for i in range(3)]


def test_null_and_missing_breakpoint_differ(spark):
    def card(meta):
        return {"id": "c", "elType": "e-flexbox", "styles": {"s": {"id": "s", "type": "class", "label": "local", "variants": [{"meta": meta, "props": {}, "custom_css": None}]}}}

    e = trees.tree_rows(docs(spark, card({"breakpoint": None, "state": None}), card({"state": None}), card({"breakpoint": "desktop", "state": None})))
    assert sorted(r.page_id for r in checks.g09_base_variant(trees.variant_rows(e)).collect()) == ["1", "2"]


def test_plain_title_breaks_one_invariant(spark):
    e = trees.tree_rows(docs(spark, widget("a", title="plain"), widget("b", title=html_v3("ok"))))
    rows = {r.invariant: r.violations for r in checks.inv_profile(e, trees.style_rows(e), trees.element_classes(e)).collect()}
    assert rows["html-wrapper"] == 1 and sum(rows.values()) == 1


def test_scaling(spark):
    root = {"id": "c", "elType": "e-flexbox", "styles": {"s": {"variants": [{"meta": {"breakpoint": None, "state": None}, "props": {"font-size": size(60), "gap": size(8)}}]}}}
    rows = ops.responsive_variants(trees.style_props(trees.tree_rows(docs(spark, root)))).collect()
    assert sorted((r.breakpoint, r.prop, r.num) for r in rows) == [("mobile", "font-size", 36.0), ("tablet", "font-size", 45.0)]


def test_image_source_rule(spark):
    def img(src):
        return widget("i", "e-image", image={"$$type": "image", "value": {"src": {"$$type": "image-src", "value": src}}})

    one, url = {"$$type": "n", "value": 1}, {"$$type": "url", "value": "https://x"}
    e = trees.tree_rows(docs(spark, img({"id": one}), img({"id": one, "url": url}), img({"url": url}), img({"id": one, "url": None}), img({})))
    assert {r.page_id: r.detail for r in checks.value_rule_hits(trees.tree_values(e)).collect()} == {"1": "both", "3": "null-url", "4": "neither"}


def test_repeated_cards(spark):
    card = lambda i: {"id": f"c{i}", "elType": "e-flexbox", "elements": [widget("h"), widget("p", "e-paragraph")]}
    e = trees.tree_rows(docs(spark, {"id": "r", "elType": "e-div-block", "elements": [card(1), card(2)]}))
    assert [(r.n_children, r.occurrences) for r in ops.tree_candidates(e).collect()] == [(2, 2)]


def test_forms(pages):
    df = pages('<form><label>Your name</label><input name="n" required><input type="email" name="m"><textarea name="msg"></textarea><button type="submit"> Send </button></form>',
               '<input type="hidden" name="h"><input name="only">', '<input placeholder="A"><input type="email"><button>Subscribe</button>')
    f = {(r.page_id, r.field_ix): (r.type, r.label, r.required) for r in assets.form_fields(df).collect()}
    assert f == {(0, 0): ("text", "Your name", True), (0, 1): ("email", "m", False), (0, 2): ("textarea", "msg", False), (2, 0): ("text", "A", False), (2, 1): ("email", "Field 1", False)}
    assert {r.page_id: r.submit_text for r in assets.form_inventory(df).collect()} == {0: "Send", 2: "Subscribe"}


def test_assets_dedupe_without_case(pages):
    m = assets.asset_manifest(pages('<img src="https://c.example/A.PNG?x=1"><img src="https://c.example/a.png?x=1"><img src="data:image/png;base64,AA"><img src="/rel.png">')).collect()
    assert [(r.url, r.uses, r.type, r.extension, r.filename) for r in m] == [("https://c.example/A.PNG?x=1", 2, "image", "png", "A.PNG")]


def test_inventory_skips_hidden_files(spark, tmp_path):
    for name in ("a.png", ".hidden", "node_modules/x.js", "sub/b.css"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text("x" * 5)
    rows = files.asset_inventory(spark, f"file:{tmp_path}").collect()
    assert sorted((r.path, r.length, r.mime) for r in rows) == [("a.png", 5, "image/png"), ("sub/b.css", 5, "text/css")]


def test_artifacts(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "CHANGED"), (4, "n")], "id int, v string")
    got = {r.id: r.state for r in files.verify_artifacts(files.row_hashes(a, "id"), files.row_hashes(b, "id"), "id").collect()}
    assert got == {1: "valid", 2: "changed", 3: "missing", 4: "unexpected"}


def styled(i, props, **settings):
    style = {"id": "s", "type": "class", "label": "local", "variants": [{"meta": {"breakpoint": None, "state": None}, "props": props, "custom_css": None}]}
    return {"id": i, "elType": "e-flexbox", "settings": settings, "styles": {"s": style}, "elements": []}


def test_rules_see_values_at_any_depth(spark):
    gv = lambda kind, i: {"$$type": f"global-{kind}-variable", "value": i}
    shadow = {"$$type": "box-shadow", "value": [{"$$type": "shadow", "value": {"color": "#abc", "blur": size(3)}}]}
    overlay = {"$$type": "background", "value": {"overlay": {"$$type": "list", "value": [{"$$type": "layer", "value": {"color": gv("color", "e-gv-gone")}}]}}}
    image = {"$$type": "background", "value": {"image": {"$$type": "image", "value": {"src": {"$$type": "image-src", "value": {"id": {"$$type": "n", "value": 1}, "url": {"$$type": "url", "value": "u"}}}}}}}
    e = trees.tree_rows(docs(spark, styled("a", {"box-shadow": shadow}), styled("b", {}, link={"href": ["e-gv-bare"]}), styled("c", {"background": overlay}), styled("d", {"background": image}),
                             styled("f", {"color": gv("color", "e-gv-bad"), "font-family": gv("font", "e-gv-font")})))
    v = trees.tree_values(e)
    assert sorted((r.page_id, r.check_id, r.detail) for r in checks.value_rule_hits(v).collect()) == [("0", "g06", "#abc"), ("1", "g07", "e-gv-bare"), ("3", "g12", "both")]
    kit = spark.createDataFrame([("e-gv-bad", "color", "#12"), ("e-gv-font", "color", "#112233")], "gv_id string, kind string, hex string")
    assert sorted(r.detail for r in checks.g01_token_existence(v, kit).collect()) == ["e-gv-bare", "e-gv-gone"]
    assert sorted((r.page_id, r.detail.split(":")[1]) for r in checks.g02_color_refs(v, kit).collect()) == [("2", "e-gv-gone"), ("4", "e-gv-bad")]
    assert checks.g03_font_refs(v, kit).count() == 0


def test_missing_ids_and_types(spark):
    none = {"elType": "e-flexbox", "settings": {}, "styles": {}}
    e = trees.tree_rows(docs(spark, {"id": "r", "elType": "e-div-block", "elements": [none, none, {"id": "x"}, {"id": "y", "elType": "container"}]}))
    assert checks.g15_unique(e).count() == 0
    assert sorted(r.detail for r in checks.g16_el_types(e).collect()) == ["container", "missing"]


def test_visual_settings_of_containers(spark):
    e = trees.tree_rows(docs(spark, styled("a", {}, **{"font-weight": 1, "height": 1, "border-radius": 1, "box-shadow": 1, "tag": 1})))
    got = {r.detail for r in checks.c1_types(trees.style_props(e), trees.variant_rows(e), e).collect()}
    assert got == {"setting:font-weight", "setting:height", "setting:border-radius", "setting:box-shadow"}


def test_depth_reuse_and_hex(spark):
    deep = widget("leaf")
    for i in range(6):
        deep = {"id": f"n{i}", "elType": "e-div-block", "elements": [deep]}
    card = lambda i: {"id": i, "elType": "e-flexbox", "elements": [widget(f"{i}h"), widget(f"{i}p", "e-paragraph")]}
    e = trees.tree_rows(docs(spark, deep, {"id": "r", "elType": "e-div-block", "elements": [card("a"), card("b")]}, styled("s", {"color": {"$$type": "color", "value": "#a1b2c3"}})))
    assert [(r.page_id, r.severity, r.detail) for r in checks.c7_depth(e).collect()] == [("0", "error", "6")]
    assert [(r.page_id, r.detail) for r in checks.c9_reuse(ops.tree_signatures(e)).collect()] == [("1", "2")]
    assert [(r.page_id, r.detail) for r in checks.hardcoded_colors(trees.style_props(e)).collect()] == [("2", "color:#a1b2c3")]


def test_one_flattening_per_plan(spark):
    from sitecorpus.plans.tree_queries import Trees, guard_rows, validation_rows

    x = Trees(docs(spark, styled("a", {"color": {"$$type": "color", "value": "#a1b2c3"}})))
    for df in (guard_rows(x), validation_rows(x), checks.c4_responsive(x.props, x.variants), checks.g14_ids(x.elements, x.styles, x.classes)):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInPandas") <= 1


def test_responsive_rows_of_every_kind(spark):
    sides = {"$$type": "dimensions", "value": {"block-start": size(10), "inline-end": size(40)}}
    props = {"height": size(500), "margin": sides, "padding-top": size(30), "border-radius": size(8), "grid-template-columns": {"$$type": "string", "value": "1fr 1fr 2fr"}}
    rows = ops.responsive_variants(trees.style_props(trees.tree_rows(docs(spark, styled("a", props))))).collect()
    got = {(r.breakpoint, r.prop): r.text or r.num for r in rows}
    assert got == {
        ("tablet", "height"): 375.0, ("mobile", "height"): 300.0, ("tablet", "padding-top"): 23.0, ("mobile", "padding-top"): 18.0,
        ("tablet", "margin.block-start"): 8.0, ("mobile", "margin.block-start"): 6.0, ("tablet", "margin.inline-end"): 30.0, ("mobile", "margin.inline-end"): 24.0,
        ("tablet", "grid-template-columns"): "1fr", ("mobile", "grid-template-columns"): "1fr",
    }


def test_value_shapes(spark):
    """One planted fault of every type and field, at any depth; sound values of every type give none."""
    t = lambda kind, value: {"$$type": kind, "value": value}
    px = size(1)
    sound = {
        "a": t("string", "x"), "b": t("number", 2.5), "c": t("boolean", True), "d": t("url", "https://x"), "e": px, "f": t("dimensions", {"block-start": px}),
        "g": t("color", "#AbC"), "h": t("global-color-variable", "e-gv-1a"), "i": t("border-radius", {"start-start": px, "end-end": t("global-size-variable", "e-gv-9")}),
        "j": t("background", {"color": t("color", "#112233")}), "k": t("image", {"src": t("image-src", {"id": t("image-attachment-id", 4)}), "size": t("string", "full")}),
        "l": t("image-src", {"url": t("url", "u"), "id": None}), "m": t("classes", ["s_a"]), "n": html_v3("x"), "o": t("link", {"href": t("url", "/")}), "p": t("unheard-of", 1),
        "q": {"$$type": "size", "size": 1, "unit": "vh"}, "r": t("classes", []),
    }
    broken = {
        "a": t("string", 1), "b": t("number", "2"), "c": t("boolean", "true"), "d": t("url", None), "e1": t("size", "1px"), "e2": t("size", {"unit": "px"}), "e3": size("1"), "e4": size(1, "fr"),
        "e5": t("size", {"size": 1, "unit": None}), "f1": t("dimensions", px), "f2": t("dimensions", {"inline-end": 4}), "g1": t("color", "red"), "g2": t("color", 3), "h": t("global-font-variable", "gv-1"),
        "i": t("border-radius", {"end-start": t("string", "1px")}), "j": t("background", {"color": "#112233"}), "k1": t("image", {"size": t("string", "full")}), "k2": t("image", {"src": "u"}),
        "l": t("image-src", {"url": "u"}), "m1": t("classes", "s_a"), "m2": t("classes", ["s_a", 4]), "n1": t("html-v3", "x"), "n2": t("html-v3", {"content": 1, "children": []}), "n3": t("html-v3", {"children": []}),
        "o1": t("link", {"isTargetBlank": "no", "href": "/"}), "o2": t("link", {}), "deep": {"list": [{"x": [t("number", [])]}]}, "id": t("image-attachment-id", "7"), "var": t("global-size-variable", {}),
    }
    card = {"id": "c", "elType": "e-flexbox", "settings": broken, "styles": {"s": {"variants": [{"props": sound}]}}}
    got = [r.detail for r in checks.c1_shapes(trees.typed_values(trees.tree_rows(docs(spark, card, {**card, "settings": {}})))).collect()]
    assert sorted(got) == sorted([
        "a:string:is number", "b:number:is string", "c:boolean:is string", "d:url:is null", "e1:size:is string", "e2:size:size is missing", "e3:size:size is string", "e4:size:unit reads fr",
        "e5:size:unit is null", "f1:dimensions:is size", "f2:dimensions:inline-end is number", "g1:color:reads red", "g2:color:is number", "h:global-font-variable:reads gv-1",
        "i:border-radius:end-start is string", "j:background:color is string", "k1:image:src is missing", "k2:image:src is string", "l:image-src:url is string", "m1:classes:is string",
        "m2:classes:holds number", "n1:html-v3:is string", "n2:html-v3:content is number", "n3:html-v3:content is missing", "o1:link:isTargetBlank is string", "o2:link:href is missing",
        "deep.list.0.x.0:number:is array", "id:image-attachment-id:is string", "var:global-size-variable:is object",
    ])


def test_property_table(spark):
    """A value of a wrong declared type per property gives one row each; every accepted type none."""
    wrong = {p: {"$$type": "transform", "value": 1} for p in checks.PROP_TYPES}
    right = {p: {"$$type": ts[-1], "value": 1} for p, ts in checks.PROP_TYPES.items()}
    card = lambda props: {"id": "c", "elType": "e-flexbox", "styles": {"s": {"variants": [{"props": props}]}}}
    e = trees.tree_rows(docs(spark, card(wrong), card(right)))
    got = checks.c1_types(trees.style_props(e), trees.variant_rows(e), e).collect()
    assert {r.page_id for r in got} == {"0"} and sorted(r.detail for r in got) == sorted(f"type:{p}:transform" for p in checks.PROP_TYPES)


def _node(i, *kids, kind=None, **settings):
    return {"id": i, "elType": "widget" if kind else "e-flexbox", "widgetType": kind, "settings": settings, "styles": {}, "elements": list(kids)}


def test_fields_at_any_depth(spark):
    def card(n, word):
        link = {"$$type": "link", "value": {"destination": {"value": f"/go/{n}"}}}
        img = {"$$type": "image", "value": {"src": {"$$type": "image-src", "value": {"id": {"$$type": "image-attachment-id", "value": 40 + n}}}}}
        deep = _node("box", _node("box2", _node("my-CTA", kind="e-button", text=html_v3("Go"), link=link), _node("hero-icon", kind="e-image", image=img)))
        return _node(f"c{n}", _node("Title", kind="e-heading", title=html_v3(word)), _node("bodytext", kind="e-paragraph", paragraph=html_v3("p")), deep, _node("plain"))

    root = _node("r", card(1, "!?"), card(2, "B b"))
    e = trees.tree_rows(docs(spark, root))
    above = {(r.node_ix, r.above_ix): r.steps for r in ops.ancestor_rows(e).collect()}
    ix = {r.node_id: r.node_ix for r in e.filter("node_id in ('r', 'c1', 'box')").collect()}
    assert above[(ix["c1"], ix["r"])] == 1 and len(above) == 2 * (1 + 4 * 2 + 3 + 2 * 4)
    got = ops.component_fields(e, ops.tree_candidates(e)).collect()
    outer = [r for r in got if r.steps > 1 or r.field_id in ("Title", "bodytext")]
    rows = {(r.field_id, r.type, r.prop, r.default_value, r.href, r.steps) for r in outer}
    assert {("Title", "text", "title", "!?", None, 1), ("bodytext", "text", "paragraph", "p", None, 1), ("my-CTA", "link", "link", "Go", "/go/1", 3), ("hero-icon", "image", "image", "41", None, 3)} <= rows
    # The pair inside the box repeats too, and is a structure of its own, one step down.
    assert {(r.field_id, r.steps) for r in got if r not in outer} == {("my-CTA", 1), ("hero-icon", 1)}
    assert {r.name for r in got} == {None}  # no letter or digit in the first card's title


def test_last_word_and_last_element_count(spark):
    pair = lambda: _node("p", _node("title-link", kind="e-heading", title=html_v3("First One")), _node("title-link", kind="e-button", text=html_v3("Second")), _node("img"))
    e = trees.tree_rows(docs(spark, _node("r", pair(), pair())))
    got = [r for r in ops.component_fields(e, ops.tree_candidates(e)).collect() if r.steps == 1]
    assert {(r.name, r.field_id, r.type, r.default_value, r.href) for r in got if r.field_id == "title-link"} == {("FirstOne", "title-link", "link", "Second", "")}
    assert {(r.field_id, r.default_value) for r in got if r.type == "image"} == {("img", "0")}


def test_component_overrides(spark):
    def use(i, cid, **own):
        s = {"component-id": {"$$type": "string", "value": cid}} if cid else {}
        return {**_node(i, kind="e-component"), "settings": {**s, **{f"property-{k}": v for k, v in own.items()}}}

    one = _node("r", use("a", "x", title={"value": "T1"}, size=3), use("b", "x", title={"value": "T2"}), use("c", "y"), use("d", None, note="n"))
    two = _node("r", use("e", "x", title={"value": "T1"}, extra=True), use("f", "z"), _node("g"))
    definitions = spark.createDataFrame([("x", '{"property-title": "T1", "property-tone": {"value": "dark"}, "other": 1}'), ("z", "{}"), ("unused", '{"property-q": 1}')], "component_id string, settings string")
    got = {(r.component_id, r.property): tuple(r)[1:3] + tuple(r)[4:] for r in ops.component_overrides(trees.tree_rows(docs(spark, one, two)), definitions).collect()}
    assert got == {  # resolved, instances, overriding, changed, values, first value, definition's value
        ("x", "title"): (True, 3, 3, 1, 2, "T1", "T1"), ("x", "size"): (True, 3, 1, 1, 1, "3", None), ("x", "extra"): (True, 3, 1, 1, 1, None, None), ("x", "tone"): (True, 3, 0, 0, 0, None, "dark"),
        ("y", None): (False, 1, 0, 0, 0, None, None), ("unknown", "note"): (False, 1, 1, 1, 1, "n", None), ("z", None): (True, 1, 0, 0, 0, None, None),
    }
