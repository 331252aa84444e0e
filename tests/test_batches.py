"""Batches that leave a task are of bounded size, whatever comes in."""

import json

import pyarrow as pa

from sitecorpus.functions.batches import expanded
from sitecorpus.session import prepare
from sitecorpus.sources import trees

SCHEMA = pa.schema([("page_id", pa.string()), ("n", pa.int32()), ("text", pa.string())])


def test_batches_are_cut_by_bytes_and_lose_no_row():
    docs = pa.RecordBatch.from_pydict({"page_id": [f"p{i}" for i in range(300)], "doc": ["x" * (i * 7) for i in range(300)]})
    run = expanded(lambda page, doc: ((page, n, doc) for n in range(3)), SCHEMA, most=20_000)
    out = list(run(iter([docs.slice(0, 170), docs.slice(170)])))
    assert len(out) > 40 and max(b.nbytes for b in out) < 30_000
    got = pa.Table.from_batches(out).to_pydict()
    assert list(zip(*got.values())) == [(f"p{i}", n, "x" * (i * 7)) for i in range(300) for n in range(3)]
    assert list(run(iter([]))) == []


def test_arrow_batches_that_reach_a_worker_are_bounded(spark):
    prepare(spark)
    wide = spark.range(0, 4000, numPartitions=1).selectExpr("repeat(cast(id % 10 as string), 20000) AS text")
    sizes = [r.n for r in wide.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in it), "n bigint").collect()]
    assert sum(sizes) > 4000 * 20000 and max(sizes) < 9 << 20


def test_ids_that_are_numbers_are_text(spark):
    doc = json.dumps({"id": 5, "elType": "e-flexbox", "elements": [{"id": "a", "widgetType": True}, {"type": "x"}]})
    rows = trees.tree_rows(spark.createDataFrame([("p", doc)], "page_id string, doc string")).collect()
    assert [(r.node_id, r.parent_ix, r.el_type, r.widget_type) for r in rows] == [("5", None, "e-flexbox", None), ("a", 0, None, "true"), (None, 0, "x", None)]
