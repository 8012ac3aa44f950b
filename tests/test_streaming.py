from conftest import DATA, dicts

from corpuslake.operators.dedup import with_content_hash
from corpuslake.registry import Views
from corpuslake.sources.tables import scan_articles
from corpuslake.streaming import jobs


def test_stream_equals_batch_and_picks_up_new_files(spark, views, tmp_path):
    """Three files arrive one after the other; a copy of the first arrives last."""
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "articles", "checkpoint"))
    documents = views.table("documents")
    parts = documents.randomSplit([0.4, 0.3, 0.3], 1)
    for part in [*parts, parts[0]]:
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", 1).parquet(source)
        jobs.stream_ingest(Views.as_articles(stream), path, checkpoint).awaitTermination()
    stored = scan_articles(spark, path)
    hashes = [r["content_hash"] for r in dicts(stored.select("content_hash"))]
    want = with_content_hash(views.articles).select("content_hash").distinct()
    assert len(hashes) == len(set(hashes)) == want.count()
    assert set(hashes) == {r["content_hash"] for r in dicts(want)}
    assert stored.select("batch_id").distinct().count() == 3


def test_daily_counts_follow_the_input(spark, views, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "daily", "checkpoint"))
    documents = views.table("documents")
    seen = 0
    for part in documents.randomSplit([0.5, 0.5], 2):
        part.write.mode("append").parquet(source)
        seen += part.count()
        stream = spark.readStream.schema(documents.schema).parquet(source)
        jobs.stream_daily_counts(Views.as_articles(stream), path, checkpoint).awaitTermination()
        versions = spark.read.schema("publish_date string, article_count long, version int").parquet(path)
        assert sum(r["article_count"] for r in dicts(jobs.latest_daily_counts(versions))) == seen
    assert DATA
