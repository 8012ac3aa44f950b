import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    from corpuslake.registry import Views

    return Views(spark, DATA)


def article(**fields):
    base = {
        "url": "https://example.com/1", "title": "Article", "content": "Some content", "content_hash": "h1",
        "source_domain": "example.com", "crawl_id": "CC-MAIN-2020-16", "timestamp": "2020-03-15T10:00:00Z",
        "language": "en", "status_code": "200", "publish_date": "2020-03-15",
    }
    return {**base, **fields}


@pytest.fixture
def make_articles(spark):
    from corpuslake.schemas import ARTICLES

    def make(*rows):
        return spark.createDataFrame([tuple(article(**r)[c] for c in ARTICLES.names) for r in rows], ARTICLES)

    return make


def dicts(df):
    return [r.asDict() for r in df.collect()]
