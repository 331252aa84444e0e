"""Files of many rows, assets of trees and XML, samples."""

import json
import random

from pyspark.sql import functions as F

from sitecorpus.operators import assets, trees as ops
from sitecorpus.sources import files, trees


def test_places_do_not_depend_on_the_blocks(spark, tmp_path):
    rnd = random.Random(1)
    for name in ("a.txt", "sub/b.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join("é" * rnd.randint(0, 30) + "\n" for _ in range(1000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = {}
    try:
        for size in ("128m", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got[size] = sorted((r.source, r.place, r.value) for r in files.numbered_lines(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got["128m"] == got["700b"] and len(got["700b"]) == 2000
    for source, place, value in got["700b"][:50]:
        data = open(source.removeprefix("file://").removeprefix("file:"), "rb").read()
        assert data[place:].split(b"\n")[0].decode() == value


def test_tree_lines_keep_malformed_ones_apart(spark, tmp_path):
    docs = [json.dumps({"id": f"r{i}", "elType": "e-flexbox", "elements": []}) for i in range(1000)]
    docs[7], docs[8] = docs[7][:-3], "\t"
    (tmp_path / "one.jsonl").write_text("\n".join(docs) + "\n")
    got = trees.read_tree_lines(spark, str(tmp_path))
    assert got.count() == 1000 and got.filter("not sound").count() == 2 and got.select("doc_id").distinct().count() == 1000
    e = trees.tree_rows(got.filter("sound").withColumnRenamed("doc_id", "page_id"))
    assert e.count() == 998 and e.select("node_id").distinct().count() == 998


def test_css_bundles(spark, tmp_path):
    lines = [json.dumps({"source": f"s{i}", "css": f"a{{color:{i}}}\nb{{}}"}) for i in range(1000)] + [json.dumps({"css": "x{}"}), "no json", json.dumps({"source": "none"})]
    (tmp_path / "one.json").write_text("\n".join(lines) + "\n")
    got = {r.source: r.css for r in files.read_css_bundles(spark, str(tmp_path)).collect()}
    assert len(got) == 1001 and got["s3"] == "a{color:3}\nb{}" and [c for s, c in got.items() if "#" in s] == ["x{}"]
    inventory = files.asset_inventory(spark, str(tmp_path)).collect()
    assert [(r.path, r.extension, r.mime) for r in inventory] == [("one.json", "json", "application/json")] or inventory[0].extension == "json"


def test_an_image_only_in_a_tree_reaches_the_manifest(spark, pages):
    url = "https://cdn.example/only.png"
    node = lambda i, s: {"id": i, "elType": "widget", "widgetType": "e-image", "settings": s, "styles": {}, "elements": []}
    doc = {"id": "r", "elType": "e-flexbox", "elements": [
        node("deep", {"image": {"$$type": "image", "value": {"src": {"$$type": "image-src", "value": {"url": {"$$type": "url", "value": url}}}}}}),
        node("plain", {"image-src": {"value": {"url": "https://cdn.example/b.svg"}}}), node("old", {"image_src": {"url": "https://cdn.example/B.SVG"}}),
        node("no", {"image_src": {"url": "data:x"}, "link": {"value": {"href": "https://cdn.example/page"}}})]}
    e = trees.tree_rows(spark.createDataFrame([("9", json.dumps(doc))], "page_id string, doc string"))
    refs = assets.tree_asset_references(e, trees.tree_values(e))
    assert {(r.context, r.url) for r in refs.collect()} == {("element-tree:deep", url), ("element-tree:plain", "https://cdn.example/b.svg"), ("element-tree:old", "https://cdn.example/B.SVG")}
    xml = spark.createDataFrame([(0, '<a src="https://framerusercontent.com/images/x.png?a=1&amp;b=2"/><b src=\'https://other.example/y.png\'/>')], "page_id bigint, xml string")
    more = [refs.withColumn("site", F.lit("site.example")), assets.xml_asset_references(xml).withColumn("site", F.lit("site.example"))]
    got = {(r.url, r.uses, r.type) for r in assets.asset_manifest(pages("<img src='https://cdn.example/b.svg'>"), more=more).collect()}
    assert got == {(url, 1, "image"), ("https://cdn.example/b.svg", 3, "svg"), ("https://framerusercontent.com/images/x.png?a=1&b=2", 1, "image")}


def test_class_samples_are_the_first(spark):
    rnd = random.Random(3)
    nodes = [("p", i, rnd.choice(["e-heading", "e-image", None]), rnd.choice(["widget", None])) for i in range(300)]
    classes = [("p", i, f"c{rnd.randint(0, 40):02}") for i in range(300) for _ in range(rnd.randint(0, 3))]
    e = spark.createDataFrame(nodes, "page_id string, node_ix int, widget_type string, el_type string")
    c = spark.createDataFrame(classes + [("p", 1, None)], "page_id string, node_ix int, class_id string")
    want = {}
    for p, i, cid in classes:
        kind = nodes[i][2] or nodes[i][3] or "(none)"
        want.setdefault(kind, {}).setdefault(cid, 0)
        want[kind][cid] += 1
    df = ops.class_samples(c, e, 4)
    assert {(r.kind, r.place, r.class_id, r.uses) for r in df.collect()} == {(k, n + 1, cid, u) for k, v in want.items() for n, (cid, u) in enumerate(sorted(v.items())[:4])}
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
