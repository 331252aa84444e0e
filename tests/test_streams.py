"""Streams over tables as they are stored: single files and folders of files."""

import pytest

from sitecorpus.plans import stream_queries as sq
from sitecorpus.plans.registry import QUERIES, Tables
from sitecorpus.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folders(spark):
    """Documents and events as folders of three files, under names that part writers give."""
    path = scratch_path(spark, "folders")
    for name in ("documents", "events"):
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["stream_lesson_upsert", "stream_latest_phase", "stream_error_windows"])
def test_a_table_may_be_a_folder(spark, folders, name):
    got, want = (sorted(map(tuple, QUERIES[name](spark, path).collect()), key=str) for path in (folders, SF))
    assert got and got == want


def test_a_stream_without_rows_gives_none(spark):
    path = scratch_path(spark, "empty")
    spark.read.parquet(f"{SF}/documents.parquet").filter("false").write.parquet(f"{path}/documents.parquet")
    t = Tables(spark, path)
    assert sq.notes_stream(t).isStreaming and QUERIES["stream_lesson_upsert"](spark, path).count() == 0
