import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sitecorpus.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def pages(spark):
    def make(*htmls, url="https://www.site.example/a"):
        rows = [(i, url if isinstance(url, str) else url[i], h) for i, h in enumerate(htmls)]
        return spark.createDataFrame(rows, "page_id bigint, url string, html string")

    return make
