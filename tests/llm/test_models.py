"""Trained operators on rows they have not learnt from, page texts, and odd tables."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sitecorpus.llm import anchors, automaton, boosted, licences, naming, packing, ppm, queries, sketch, toxic, wrapper
from sitecorpus.llm.frames import row_key
from sitecorpus.session import stage

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label=None):
    got = queries.QUERIES[name](spark, SF).filter("held_out")
    return got.join(spark.read.parquet(f"{SF}/{'labels' if label else 'documents'}.parquet"), "doc_id").toPandas()


def test_languages(spark):
    d = held_out(spark, "op6_language_id")
    assert len(d) > 200 and (d.lang == d.lang_pred).mean() > 0.98


def test_quality(spark):
    d = held_out(spark, "op8_quality", "quality")
    assert len(d) > 100 and (d.predicted == d.quality).mean() > 0.95 and d.score.between(0, 1).all()


def test_toxicity(spark):
    d = held_out(spark, "op7_toxicity", "toxic")
    assert (d.predicted == d.toxic).mean() > 0.93 and d[d.predicted == 1].toxic.mean() > 0.8 and d.score.between(0, 1).all()


def test_one_insult_weighs_the_same_in_long_texts():
    sums = toxic._Sums(toxic.Kernel(["stupid"]), np.ones((1, 1), np.float32), toxic.WINDOW)
    at = lambda n, place: sums([" ".join(["thing"] * place + ["stupid"] + ["thing"] * (n - 1 - place))])[0, 0]
    short = at(toxic.WINDOW, 7)
    for n in (toxic.WINDOW + 1, 1300, 20_000):
        for place in (0, 300, n // 2, n - 1):
            assert at(n, place) >= 0.99 * short
    assert sums(["", None]).tolist() == [[0], [0]]


def test_kernel_tolerates_gaps_and_insertions():
    k = toxic.Kernel(["stupid", "worthless"])
    best = lambda w: max(k(toxic.readings(w)).max(1))
    assert best("stupid") > 0.99 and best("s-t-u-p-i-d") > 0.99 and best("stuupid") > 0.2 and best("worthhless") > 0.2
    assert best("thing") < 0.05 and best("st") == 0
    assert toxic.words_of("You s.t.u.p.i.d man")[1] == "s.t.u.p.i.d"


PAGE = """<!DOCTYPE html><html><head><title>t {n}</title><script>var a="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="ad">Buy {n}</div><article><h1>Title {n}</h1><p><b>First &amp; {n}<br>line<p>Second  {n}</p><aside>Side {n}</aside><p>Same</p><div id="comments">Comment {n}</div></article>
<div class="cookie-notice">We use</div><form><p>Mail {n}</p></form><footer>&copy; {n}</footer>"""


def test_articles():
    got = wrapper.main_texts([PAGE.format(n=n) for n in range(4)] + [None, ""])
    assert got[2] == "Title 2\n\nFirst & 2 line\n\nSecond 2\n\nSame" and got[4:] == ["", ""]


def test_wrapper_finds_the_region_without_an_article_element():
    page = "<body><div><p>Menu of the site with many words that are always the same and long</p></div><div><p>Text {0}</p><p>More of {0} {0} {0}</p></div><div><p>End of page</p></div>"
    got = wrapper.main_texts([page.format(f"word{n}") for n in range(6)])
    assert got[3] == "Text word3\n\nMore of word3 word3 word3"


@pytest.mark.parametrize("wrap", ["div class='content has-sidebar'", "div class=sidebar", "form id=search", "aside", "div class='widget'"])
@pytest.mark.parametrize("main", ["article", "main", "section"])
def test_blocks_with_the_main_text_are_never_dropped(wrap, main):
    page = "<body><nav><a href=/>Home</a></nav><{0}><{1}><h2>Title {2}</h2><p>Text number {2} is here</p></{1}></{3}><footer>End</footer>"
    for pages in (range(1), range(7)):
        got = wrapper.main_texts([page.format(wrap, main, n, wrap.split()[0]) for n in pages])
        assert got == [f"Title {n}\n\nText number {n} is here" for n in pages]


def test_most_of_an_article_is_kept_and_comments_are_not():
    page = "<article><h1>T</h1><div class=notice><p>All the text of it</p></div></article><div class=comments><p>A much longer text that is no part of it at all</p></div>"
    assert wrapper.main_texts([page]) == ["T\n\nAll the text of it"]


def test_whole_names_and_parts_of_articles():
    page = """<article><h2 id="search">Search</h2><p class="share-price">Price</p><div class="ad-hoc" data-id="menu">Hoc</div><p id="legal">Law</p><div class="Share">no</div>
    <figure><img src=x><figcaption>Caption</figcaption></figure><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>, and <b>on</b></p><p class="ad">no</p></article>"""
    assert wrapper.main_texts([page]) == ["Search\n\nPrice\n\nHoc\n\nLaw\n\nCaption\n\nSo x = 2, and on"]


@pytest.mark.parametrize("n", [2, 5, 7])
@pytest.mark.parametrize("body", [
    "<article><h1>T</h1>{0}</article><div><p>Buy {1}</p></div>", "<article><h1>T</h1>{0}<p>Seen {1} times</p></article>", "<article><h1>T</h1>{0}</article><img src={1}>",
    "<div><h1>T</h1>{0}</div><div><p>Buy {1}</p></div>", "<h1>T</h1>{0}<p>Buy {1}</p>", "<div><p>Some</p></div><article><h1>T</h1>{0}</article><div><p>Other words at the side</p></div><div><p>Buy {1}</p></div>",
])
def test_versions_of_one_text_are_whole(n, body):
    own = "<p>The first passage of it</p><p>And the second one</p>"
    for text in wrapper.main_texts([body.format(own, i) for i in range(n)]):
        assert "T\n\nThe first passage of it\n\nAnd the second one" in text


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_passages_that_all_texts_share_stay(tag):
    page = "<div><p>Menu</p></div><{0}><h1>Title {1}</h1><h2>Ingredients</h2><p>Take {1} of it, and of these {1}</p><h2>Method</h2></{0}>"
    for n in (4, 6, 200):
        got = wrapper.main_texts([page.format(tag, i) for i in range(n)])
        assert got == [f"Title {i}\n\nIngredients\n\nTake {i} of it, and of these {i}\n\nMethod" for i in range(n)]


def test_template_goes_where_there_is_no_region():
    page = "<h4>Our site</h4><p>Text {0} and more of {0}</p><p>End {0}</p><h4>Address</h4>"
    assert wrapper.main_texts([page.format(n) for n in range(6)])[3] == "Text 3 and more of 3\n\nEnd 3"
    # Other markup does not make other texts.
    same = wrapper.main_texts([page.format(1) + f"<img src={n}>" for n in range(6)])
    assert set(same) == {"Our site\n\nText 1 and more of 1\n\nEnd 1\n\nAddress"}


def test_pages_without_any_text():
    assert wrapper.main_texts(["<div class=menu>x</div><div>y</div>", "<div class=menu><a href=x>x</a></div>", "<div></div>"])[1:] == ["", ""]


def test_tree_matching():
    a, b = (wrapper.parse(p) for p in ("<div><p>x</p><ul></ul><table></table></div>", "<div><ul></ul><p>y</p><table></table><p></p></div>"))
    for t in (a, b):
        wrapper._shapes(t)
    m = wrapper.Matcher()
    assert m.size(a, b) == 4 and len(m.align(a, b)) == 4  # html, div, table and one of p and ul


def _subsequences(word):
    """Weights of a word's three-letter subsequences, letter by letter."""
    out = {}
    for i in range(len(word)):
        for j in range(i + 1, len(word)):
            for k in range(j + 1, len(word)):
                if k - i < toxic.SPAN and (word[i] + word[j] + word[k]).isalnum():
                    out[word[i], word[j], word[k]] = out.get((word[i], word[j], word[k]), 0) + toxic.DECAY ** (k - i + 1)
    return out


def _similarity(a, b):
    x, y = _subsequences(a), _subsequences(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return min(1.0, sum(v * y.get(k, 0) for k, v in x.items()) / norm) if norm else 0.0


def test_kernel_letter_by_letter():
    rnd = random.Random(6)
    marks = list(dict.fromkeys("".join(rnd.choice("aeimnrst") for _ in range(rnd.randint(3, 10))) for _ in range(25))) + ["naïve", "ааа"]
    bent = [w[:k] + rnd.choice("*-.xé") + w[k:] for w in marks for k in (1, len(w) // 2)]
    words = marks + bent + ["".join(rnd.choice("aeimnrst*") for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    got = toxic.Kernel(marks)(words)
    close = 0
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            k = _similarity(w, m) if len(w) >= 3 else 0.0
            if abs(k - toxic.LEAST) > 1e-6:
                want = np.exp(toxic.SHARP * (k - 1)) if k >= toxic.LEAST else 0.0
                close += want > 0
                assert abs(got[i, j] - want) < 1e-5, (w, m, k)
    assert close > 60


def test_scores_kept_or_not_are_the_same(monkeypatch):
    rnd = random.Random(2)
    marks = ["horrible", "idiot", "stupide"]
    kernel, into = toxic.Kernel(marks), np.array([[1.0], [2.0], [0.5]], np.float32)
    pool = marks + ["idi0t", "i d i o t", "x" * 70, "st*pide"] + ["".join(rnd.choice("adehiorst") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 900))) for _ in range(40)] + [None, ""]
    whole = toxic._Sums(kernel, into, toxic.WINDOW)(texts)
    monkeypatch.setattr(toxic, "KEPT", 2 * 50 * toxic.WORD_BYTES)  # fifty words in a generation
    few = toxic._Scores(kernel, into, toxic.WINDOW)
    assert np.allclose(np.concatenate([few(texts[i : i + 3]) for i in range(0, len(texts), 3)]), whole, atol=1e-5)


def _tree(rnd, depth):
    kids = "".join(_tree(rnd, depth - 1) for _ in range(rnd.randint(0, 4))) if depth else ""
    return "<{0}>{1}x</{0}>".format(rnd.choice(["div", "ul", "section", "table"]), kids)


def _naive(a, b):
    """Simple tree matching as it is written, without shapes, ends or tables kept."""
    if a.tag != b.tag:
        return 0
    best = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, x in enumerate(a.kids):
        for j, y in enumerate(b.kids):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + _naive(x, y))
    return 1 + best[-1][-1]


def test_matching_of_random_trees():
    rnd = random.Random(8)
    for _ in range(60):
        a, b = (wrapper.parse(_tree(rnd, 4)) for _ in range(2))
        for t in (a, b):
            wrapper._shapes(t)
        m = wrapper.Matcher()
        found = m.align(a, b)
        assert m.size(a, b) == _naive(a, b) == len(found) == len(set(found.values()))
        assert all(x.tag == y.tag and (x is a or found[x.parent] is y.parent) for x, y in found.items())


@pytest.mark.parametrize("deep", [500, 5000])
def test_pages_of_unequal_depth(deep):
    pages = ["<div>" * n + f"<p>text {n}</p>" + "</div>" * n for n in (deep, deep + 1)]
    assert wrapper.main_texts(pages) == [f"text {n}" for n in (deep, deep + 1)]


def test_many_mixed_siblings():
    rnd = random.Random(1)
    pages = ["".join(f"<p>{i} {k}</p><h{h}>{k}{i}</h{h}>" for i in range(1500) for h in [rnd.randint(2, 5)]) for k in "ab"]
    trees = [wrapper.parse(p) for p in pages]
    began = time.process_time()
    for t in trees:
        wrapper._shapes(t)
    m = wrapper.Matcher()
    assert m.size(*trees) > 2000 and time.process_time() - began < 2


@pytest.mark.parametrize("name", ["site-header", "cookie-banner", "comments-area", "site-footer", "share-buttons", "related-posts", "comments-section", "page_footer"])
def test_compound_names_of_nuisance(name):
    page = "<div class='{0}'>Left out {1}</div><main><p>Text {1} of the page, long enough to be most of it, {1}.</p><div class='{0}'>Also left out {1}</div></main>"
    assert wrapper.main_texts([page.format(name, i) for i in range(3)]) == [f"Text {i} of the page, long enough to be most of it, {i}." for i in range(3)]


@pytest.mark.parametrize("name", ["has-sidebar", "share-price", "ad-hoc", "menu-engineering", "comment-le-faire"])
def test_compound_names_of_content(name):
    page = "<main><div class='{0}'>Text {1} stays</div><p>and more {1}</p></main>"
    assert wrapper.main_texts([page.format(name, i) for i in range(3)]) == [f"Text {i} stays\n\nand more {i}" for i in range(3)]


# Nulls in every column, empty and very long texts, ties, repeated rows, and columns called like those the operators add.
CLASH = "rid string, row_key string, score string, predicted string, spans string, n_words string, items string, digest string, kept string, part string, place string, toxic_score string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}"


@pytest.fixture(scope="module")
def odd(spark):
    clash = ("c",) * 12
    long = "lorem ipsum dolor " * 12_000
    rows = [
        (1, None, None, None, None, *(None,) * 12), (2, "", "en", "s", 0, *clash), (3, "  \n", "en", "s", 3, *clash), (4, long, "en", "s", len(long), *clash),
        (5, "Same text here, of seven words.", "en", "s", 31, *clash), (6, "Same text here, of seven words.", "en", "s", 31, *clash),
        (6, "Same text here, of seven words.", "en", "s", 31, *clash), (None, "no id at all", "fr", None, 12, *clash), (7, "x" * 100_000, None, "s", 100_000, *clash),
        (8, "12345 67890 !!! 😀", "de", "s", 17, *clash), (9, "a@b.example +1 (555) 010-2030", "en", "s", 29, *clash),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(5, 1, 1), (2, 0, 0), (3, None, 0), (None, 1, 1), (4, 1, 0), (4, 0, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "lorem ipsum dolor lorem ipsum dolor lorem ipsum dolor lorem"), (None, None), (2, "")], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, None, None), (None, "http://h/x", "<p>a"), (2, "x", ""), (2, "x", ""), (3, "http://h/y", "<p>" * 3000)], "page_id bigint, url string, html string").write.parquet(f"{d}/pages.parquet")
    vectors = [(1, None, None), (None, [1.0, 2.0], "c"), (2, [2.0, 2.5], "c"), (2, [2.0, 2.5], "c"), (3, [float("nan"), 1.0], "c"), (4, [0.5, None], "c"), (5, [3.0, 0.0], None)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, x string").write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="module")
def nothing(spark, folder, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("none"))
    for t in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_tables(spark, folder, nothing, name):
    got = queries.QUERIES[name](spark, folder).collect()
    pages = name.startswith("op4")
    if name.startswith("op9"):
        assert len({(r.doc_id, r.piece) for r in got if r.doc_id != 6}) == len([r for r in got if r.doc_id != 6]) and {r.doc_id for r in got} == {None, *range(1, 10)}
    else:
        assert len(got) == (5 if pages else 8 if name.startswith("op13") else 11)  # op13: four vectors, two components
    empty = queries.QUERIES[name](spark, nothing)
    assert empty.collect() == [] and empty.columns == list(got[0].__fields__)


def test_odd_results(spark, odd):
    exact = {(r.doc_id, r.kept) for r in naming.exact_groups(odd).collect()}
    assert {(1, False), (2, False), (3, True), (5, True), (6, False), (4, True), (None, True)} <= exact  # of the empty ones, the longest
    near = {r.doc_id: r.component_id for r in sketch.near_groups(odd).collect()}
    assert near[6] == near[5] == 5 and near[1] == 1 and near[2] == 2 and near[None] is None
    assert {r.doc_id: len(r.spans) for r in anchors.find(odd.select("doc_id", "text")).collect()}[9] == 2
    assert all(not r.licences for r in licences.scan(odd.select("doc_id", "text")).collect())
    und = {r.doc_id for r in ppm.predict(odd.select("doc_id", "text"), ppm.train(odd)).collect() if r.lang_pred == "und"}
    assert und == {1, 2, 3, 8}


def test_models_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, label int")
    assert boosted.train(odd, none) is None and toxic.train(odd, none) is None
    docs = odd.select("doc_id", "text")
    for f in (boosted.predict, toxic.scored):
        assert {(r.score, r.predicted) for r in f(docs, None).collect()} == {(0.0, 0)}
    one = spark.createDataFrame([(5, 1)], "doc_id bigint, label int")
    assert toxic.train(odd, one) is None


def test_pipeline_on_odd_tables(spark, folder, nothing, odd):
    for d in (folder, nothing):
        docs = spark.read.parquet(f"{d}/documents.parquet")
        columns = docs.columns
        for name, function in corpus_pipeline.STAGES[:-1]:
            docs = stage(function(spark, docs, d), name)
            assert docs.columns == columns
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
        assert corpus_pipeline.run(spark, d).count() == packed.count()


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    got = ids(stages["exact_dedup"](spark, docs, SF))
    assert got == ids(naming.exact_groups(docs).filter("kept"))
    assert ids(stages["near_dedup"](spark, docs, SF)) == ids(sketch.near_groups(docs).filter("kept"))
    flagged = ids(queries.QUERIES["op7_toxicity"](spark, SF).filter("predicted = 1"))
    assert ids(stages["toxicity"](spark, docs, SF)) == ids(docs) - flagged
    clean = stages["decontamination"](spark, docs, SF)
    left = automaton.scan(clean, spark.read.parquet(f"{SF}/benchmark.parquet")).filter(F.size("spans") > 0).count()
    assert left == 0
    hit = ids(automaton.scan(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).filter(F.size("spans") > 0))
    same = clean.join(docs.select("doc_id", F.col("text").alias("before")), "doc_id").filter("text = before")
    assert ids(same) == ids(docs) - hit


def test_each_stage_alone_bounds_its_batches(spark):
    bounds = {"spark.sql.execution.arrow.maxBytesPerBatch": "64m", "spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.parquet.columnarReaderBatchSize": "4096"}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        for key, value in bounds.items():
            spark.conf.set(key, value)
        function(spark, docs, SF)
        assert [spark.conf.get(k) for k in bounds] == ["8m", "2048", "1024"], name


def test_exact_dedup_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF)
    plan = kept._jdf.queryExecution().toString()
    assert "Parquet" in plan and "Python" not in plan and "InArrow" not in plan
    keys = docs.filter("doc_id % 7 = 0").select(row_key(F.col("doc_id"), F.col("text")).alias("rid"))
    marked = corpus_pipeline._mapped(docs.withColumn("k", row_key(F.col("doc_id"), F.col("text"))), "k", "f", keys)
    others, passed = marked.filter("doc_id % 7 <> 0").agg(F.count("*"), F.count_if("f")).first()
    assert marked.filter("doc_id % 7 = 0 AND NOT f").count() == 0 and marked.count() == docs.count() and passed < others / 8
    assert marked.columns == [*docs.columns, "k", "f"]


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b")] * 3 + [(2, "ab "), (3, "c")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.exact_dedup(spark, docs, "").collect()) == [1, 3]


def test_packing_is_close_to_the_least(spark):
    got = queries.QUERIES["op9_packing"](spark, SF).toPandas()
    assert got.sequence_id.nunique() <= 1.01 * got.length.sum() / packing.LIMIT + 1
