"""Graph jobs: connected components, topological layers, nearest ancestors, component expansion.

Iterations keep only edges and labels, cut their lineage on reliable storage every round, and stop on a
one-row signature. Hubs arrive at each join as the larger side against one row per node, which adaptive
execution splits when a node is hot.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sitecorpus.session import cut, stage


def _signature(df: DataFrame, *cols: str):
    return df.agg(F.count("*"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(graph_id, node, component) by alternating large-star and small-star steps over (graph_id, src, dst)."""
    g = ["graph_id"]
    both = edges.select(*g, F.col("src").alias("u"), F.col("dst").alias("v")).filter("u <> v")
    e = cut(both.select(*g, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _signature(e, "graph_id", "u", "v")
    for _ in range(max_rounds):
        # Large star: larger neighbours move to the smallest one around a node.
        sym = e.unionByName(e.select(*g, F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy(*g, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sym.join(low, [*g, "u"]).filter("v > u").select(*g, F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy(*g, "u").agg(F.min("v").alias("m"))
        pairs = large.join(low, [*g, "u"])
        small = pairs.select(*g, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(pairs.select(*g, "u", F.col("m").alias("v")))
        e = cut(small.filter("u <> v").distinct())
        after = _signature(e, "graph_id", "u", "v")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = both.select(*g, F.col("u").alias("node")).unionByName(both.select(*g, F.col("v").alias("node"))).distinct()
    roots = e.select(*g, F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, [*g, "node"], "left").select(*g, "node", F.coalesce("component", "node").alias("component"))


_OVERLAP = r"^(\w[\w-]*)#(\S+) overlaps (\w[\w-]*)#(\S+)"


def overlap_pairs(issues: DataFrame) -> DataFrame:
    m = F.col("message")
    return issues.filter(m.rlike(_OVERLAP)).select(
        F.col("page_id").alias("graph_id"), F.regexp_extract(m, _OVERLAP, 2).alias("src"), F.regexp_extract(m, _OVERLAP, 4).alias("dst"),
        F.regexp_extract(m, _OVERLAP, 1).alias("src_type"), F.regexp_extract(m, _OVERLAP, 3).alias("dst_type"),
    )


def _page_components(page: pd.DataFrame) -> pd.DataFrame:
    """Components of one page's pairs, named by their smallest node, by union-find."""
    root: dict[str, str] = {}

    def find(x: str) -> str:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(page["src"], page["dst"]):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    nodes = list(root)
    return pd.DataFrame({"graph_id": page["graph_id"].iloc[0], "node": nodes, "component": [find(n) for n in nodes]})


def overlap_groups(issues: DataFrame) -> DataFrame:
    """Overlap reports merged into one group per cluster: elements, possible and observed pairs, types.

    Types are widget kinds (a small vocabulary), so listing them per group is bounded.
    """
    pairs = overlap_pairs(issues)
    # Clusters never leave a page, and a page's reports are one task's work: no rounds, one exchange.
    kind = pairs.schema["graph_id"].dataType.simpleString()
    found = pairs.select("graph_id", "src", "dst").groupBy("graph_id").applyInPandas(_page_components, f"graph_id {kind}, node string, component string")
    comp = stage(found, "overlap-components")
    types = pairs.select("graph_id", F.col("src").alias("node"), F.col("src_type").alias("t")).unionByName(
        pairs.select("graph_id", F.col("dst").alias("node"), F.col("dst_type").alias("t"))
    ).distinct()
    nodes = comp.join(types, ["graph_id", "node"]).groupBy("graph_id", "component").agg(
        F.countDistinct("node").alias("elements"), F.array_join(F.sort_array(F.collect_set("t")), ",").alias("types")
    )
    seen = pairs.select("graph_id", F.col("src").alias("node")).join(comp, ["graph_id", "node"]).groupBy("graph_id", "component").agg(
        F.count("*").alias("observed_pairs")
    )
    n = F.col("elements")
    return nodes.join(seen, ["graph_id", "component"]).select(
        F.col("graph_id").alias("page_id"), F.col("component").alias("group_id"), "elements",
        (n * (n - 1) / 2).cast("bigint").alias("pair_count"), "observed_pairs", "types",
    )


def noise_reduction(issues: DataFrame, groups: DataFrame) -> DataFrame:
    """Issues before and after merging, per page."""
    before = issues.groupBy("page_id").agg(F.count("*").alias("issues"))
    after = groups.groupBy("page_id").agg(F.count("*").alias("grouped"), F.sum("observed_pairs").alias("merged"))
    j = before.join(after, "page_id", "left")
    left = F.col("issues") - F.coalesce("merged", F.lit(0)) + F.coalesce("grouped", F.lit(0))
    return j.select("page_id", "issues", left.alias("after"), F.floor((F.col("issues") - left) * 100 / F.col("issues") + 0.5).alias("reduction_pct"))


def build_order_layers(edges: DataFrame, max_rounds: int = 10000) -> DataFrame:
    """Build layers: 1 for nodes that need nothing, else one above the highest need; NULL for nodes in or above a cycle.

    `edges` (graph_id, src, dst): src needs dst. Each node keeps the number of needs not yet placed. A round counts, for
    each node, the needs placed in the round before, and is one aggregate and one checkpoint.
    """
    g = ["graph_id"]
    e = cut(edges.select(*g, "src", "dst").distinct())
    nodes = e.select(*g, F.col("src").alias("node"), F.lit(1).alias("need")).unionByName(e.select(*g, F.col("dst").alias("node"), F.lit(0).alias("need")))
    needs = nodes.groupBy(*g, "node").agg(F.sum("need").alias("needs"))
    state = cut(needs.withColumn("layer", F.when(F.col("needs") == 0, F.lit(1))))
    layer = 1
    while not state.filter(F.col("layer") == layer).isEmpty():
        if layer >= max_rounds:
            raise RuntimeError(f"layers did not settle in {max_rounds} rounds")
        placed = state.filter(F.col("layer") == layer).select(*g, F.col("node").alias("dst"))
        met = e.join(placed, [*g, "dst"], "left_semi").groupBy(*g, F.col("src").alias("node")).agg(F.count("*").alias("met"))
        left = F.col("needs") - F.coalesce("met", F.lit(0))
        layer += 1
        state = cut(state.join(met, [*g, "node"], "left").select(
            *g, "node", left.alias("needs"), F.coalesce("layer", F.when(left == 0, F.lit(layer))).alias("layer")))
    return state.select(*g, "node", "layer")


def _trimmed(e: DataFrame, max_rounds: int) -> DataFrame:
    """The edges between nodes that have both an edge in and one out, again and again: all cycles lie among them."""
    g, left = ["graph_id"], e.count()
    for _ in range(max_rounds):
        into, out = e.select(*g, F.col("dst").alias("node")), e.select(*g, F.col("src").alias("node"))
        inner = into.intersect(out)
        e = cut(e.join(inner.withColumnRenamed("node", "src"), [*g, "src"], "left_semi").join(inner.withColumnRenamed("node", "dst"), [*g, "dst"], "left_semi"))
        now = e.count()
        if now == left:
            return e
        left = now
    raise RuntimeError(f"trimming did not settle in {max_rounds} rounds")


def strong_components(edges: DataFrame, max_rounds: int = 10000) -> DataFrame:
    """(graph_id, node, component, members, cyclic): nodes that need each other, named after the smallest of them.

    Edges outside cycles are trimmed away first. Then every node takes the largest name that reaches it; the nodes of one
    name that reach its bearer are a component, which leaves; the rest goes round again. A node alone is cyclic if it has
    an edge to itself. State is edges and one name per node.
    """
    g = ["graph_id"]
    every = cut(edges.select(*g, "src", "dst").distinct())
    rest = _trimmed(cut(every.filter("src <> dst")), max_rounds)
    found = None
    for _ in range(max_rounds):
        if rest.isEmpty():
            break
        color = cut(rest.select(*g, F.col("src").alias("node")).unionByName(rest.select(*g, F.col("dst").alias("node"))).distinct().withColumn("color", F.col("node")))
        while True:
            sent = rest.join(color.withColumnRenamed("node", "src"), [*g, "src"]).groupBy(*g, F.col("dst").alias("node")).agg(F.max("color").alias("sent"))
            new = cut(color.join(sent, [*g, "node"], "left").select(*g, "node", F.greatest("color", "sent").alias("color"), (F.col("sent") > F.col("color")).alias("moved")))
            moved = not new.filter("moved").isEmpty()
            color = new.drop("moved")
            if not moved:
                break
        both = rest.join(color.withColumnRenamed("node", "src"), [*g, "src"]).join(color.select(*g, F.col("node").alias("dst"), F.col("color").alias("color2")), [*g, "dst"])
        same = cut(both.filter("color = color2").select(*g, "src", "dst"))
        reached = last = cut(color.filter("node = color"))
        while True:
            step = same.join(last.select(*g, F.col("node").alias("dst"), "color"), [*g, "dst"]).select(*g, F.col("src").alias("node"), "color").distinct()
            last = cut(step.join(reached.select(*g, "node"), [*g, "node"], "left_anti"))
            if last.isEmpty():
                break
            reached = cut(reached.unionByName(last))
        found = reached if found is None else cut(found.unionByName(reached))
        gone = reached.select(*g, "node")
        rest = rest.join(gone.withColumnRenamed("node", "src"), [*g, "src"], "left_anti").join(gone.withColumnRenamed("node", "dst"), [*g, "dst"], "left_anti")
        rest = _trimmed(cut(rest), max_rounds)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = every.select(*g, F.col("src").alias("node")).unionByName(every.select(*g, F.col("dst").alias("node"))).distinct()
    if found is None:
        named = nodes.withColumn("component", F.col("node")).withColumn("members", F.lit(1).cast("bigint"))
    else:
        sizes = found.groupBy(*g, "color").agg(F.min("node").alias("component"), F.count("*").alias("members"))
        own = found.join(sizes, [*g, "color"]).select(*g, "node", "component", "members")
        named = nodes.join(own, [*g, "node"], "left").select(*g, "node", F.coalesce("component", "node").alias("component"), F.coalesce("members", F.lit(1)).alias("members"))
    loops = every.filter("src = dst").select(*g, F.col("src").alias("node"), F.lit(True).alias("loop"))
    return named.join(loops, [*g, "node"], "left").select(*g, "node", "component", "members", ((F.col("members") > 1) | F.coalesce("loop", F.lit(False))).alias("cyclic"))


def build_order(edges: DataFrame, max_rounds: int = 10000) -> DataFrame:
    """Build layers with cycles: (graph_id, node, component, members, cyclic, layer). Nodes that need each other are built
    together and share a layer; what lies above a cycle follows it."""
    g = ["graph_id"]
    named = cut(strong_components(edges, max_rounds))
    side = lambda k: named.select(*g, F.col("node").alias(k), F.col("component").alias(f"{k}_c"))
    between = edges.join(side("src"), [*g, "src"]).join(side("dst"), [*g, "dst"]).filter("src_c <> dst_c").select(*g, F.col("src_c").alias("src"), F.col("dst_c").alias("dst"))
    layers = build_order_layers(between, max_rounds).withColumnRenamed("node", "component")
    return named.join(layers, [*g, "component"], "left").select(*g, "node", "component", "members", "cyclic", F.coalesce("layer", F.lit(1)).alias("layer"))


def nearest_ancestor(nodes: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Nearest kept ancestor of every node: (page_id, node, ancestor).

    `nodes` is (page_id, node, parent, keep). Pointers double: a node whose pointer is a dropped node takes over
    that node's pointer, so the rounds grow with the logarithm of the depth.
    """
    par = nodes.select("page_id", F.col("node").alias("parent"), F.col("keep").alias("pk"))
    p = nodes.join(par, ["page_id", "parent"], "left").select(
        "page_id", "node", F.col("parent").alias("ptr"), (F.col("parent").isNull() | F.col("pk")).alias("done")
    )
    p = cut(p)
    for _ in range(max_rounds):
        if p.filter("not done").isEmpty():
            break
        hop = p.select("page_id", F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("done").alias("done2"))
        todo = p.filter("not done").join(hop, ["page_id", "ptr"]).select("page_id", "node", F.col("ptr2").alias("ptr"), F.col("done2").alias("done"))
        p = cut(p.filter("done").unionByName(todo))
    else:
        raise RuntimeError(f"pointers did not settle in {max_rounds} rounds")
    return p.select("page_id", "node", F.col("ptr").alias("ancestor"))


def pass_through_collapse(nodes: DataFrame) -> DataFrame:
    """Nodes left after replacing single-child containers without layout by their child, with their new parents.

    `nodes` is (page_id, node, parent, pass_through).
    """
    kept = nodes.select("page_id", "node", "parent", (~F.col("pass_through")).alias("keep"))
    anc = nearest_ancestor(kept)
    return kept.filter("keep").select("page_id", "node").join(anc, ["page_id", "node"]).select("page_id", "node", F.col("ancestor").alias("new_parent"))


def dependency_edges(nodes: DataFrame, sites: DataFrame) -> DataFrame:
    """Which component contains which: distinct (graph_id, src, dst) between nearest component ancestors.

    `nodes` is (page_id, node, parent, component), component NULL for plain elements.
    """
    comps = nodes.select("page_id", "node", "parent", F.col("component").isNotNull().alias("keep"), "component")
    anc = nearest_ancestor(comps.drop("component"))
    named = comps.filter("keep").select("page_id", "node", "component")
    up = named.select("page_id", F.col("node").alias("ancestor"), F.col("component").alias("src"))
    j = named.join(anc.filter("ancestor is not null"), ["page_id", "node"]).join(up, ["page_id", "ancestor"])
    per_page = j.select("page_id", "src", F.col("component").alias("dst")).distinct()
    return per_page.join(sites.select("page_id", F.col("site").alias("graph_id")), "page_id").select("graph_id", "src", "dst").distinct()


def component_expand(instances: DataFrame, definitions: DataFrame) -> DataFrame:
    """Instances with their component's rows in place: ids prefixed, instance attributes on top of the root's.

    `instances` (page_id, node, component_id, attrs), `definitions` (component_id, def_pos, depth, tag, attrs).
    Instances without a definition keep a single row.
    """
    d = definitions.select("component_id", "def_pos", F.col("depth").alias("def_depth"), "tag", F.col("attrs").alias("def_attrs"))
    j = instances.join(d, "component_id", "left")
    merged = F.map_zip_with(F.coalesce("def_attrs", F.expr("cast(map() as map<string,string>)")), F.col("attrs"), lambda k, a, b: F.coalesce(b, a))
    root = F.coalesce("def_pos", F.lit(0)) == 0
    return j.select(
        "page_id", "node", "component_id", F.concat_ws("-", F.col("node").cast("string"), F.coalesce("def_pos", F.lit(0)).cast("string")).alias("new_id"),
        "tag", F.coalesce("def_depth", F.lit(0)).alias("depth"), F.when(root, merged).otherwise(F.col("def_attrs")).alias("attrs"),
        F.col("def_pos").isNotNull().alias("expanded"),
    )
