import random

from conftest import dicts
from pyspark.sql import functions as F

from corpuslake.operators import metrics as m
from corpuslake.operators.monitor import status_changes
from corpuslake.operators.ranking import rolling_mean, top_n_per_key, with_running_number
from corpuslake.sinks.exports import export_metrics, export_salience_sections
from corpuslake.streaming.jobs import advance_status


def salience_rows(make_articles):
    return make_articles(
        dict(url="1", content="aaaa"),
        dict(url="2", content="bb"),
        dict(url="3", content="c", source_domain="other.com", publish_date="2020-03-16"),
    )


def test_count_frames(make_articles):
    rows = salience_rows(make_articles)
    assert dicts(m.articles_per_day(rows)) == [
        {"publish_date": "2020-03-15", "article_count": 2}, {"publish_date": "2020-03-16", "article_count": 1},
    ]
    assert dicts(m.articles_per_source(rows))[0] == {"source_domain": "example.com", "article_count": 2}
    assert [r["article_count"] for r in dicts(m.articles_per_source_day(rows))] == [2, 1]


def test_salience_frames(make_articles):
    rows = salience_rows(make_articles)
    assert dicts(m.source_salience(rows))[0] == {
        "source_domain": "example.com", "article_count": 2, "avg_content_length": 3.0,
    }
    assert dicts(m.language_salience(rows)) == [{"language": "en", "article_count": 3, "avg_content_length": 7 / 3}]
    assert [r["publish_date"] for r in dicts(m.temporal_salience(rows))] == ["2020-03-16", "2020-03-15"]
    assert dicts(m.temporal_salience(rows))[1]["total_content_length"] == 6


def test_empty_table(make_articles):
    none = make_articles().filter("false")
    for frame in (m.articles_per_day, m.articles_per_source, m.articles_per_source_day, m.source_salience, m.trend_daily):
        assert frame(none).count() == 0
    assert tuple(m.total_statistics(none).first()) == (0, 0, 0)
    assert m.timestamp_present(none).first()["present"] is False


def test_statistics_count_null_as_a_value(make_articles):
    rows = make_articles(dict(language=None), dict(), dict(source_domain="other.com", language=None))
    assert tuple(m.total_statistics(rows).first()) == (3, 2, 2)


def test_coverage_leaves_empty_dates_out(make_articles):
    rows = make_articles(dict(publish_date=""), dict(), dict(publish_date="2020-01-01"), dict(publish_date=None))
    assert tuple(m.coverage_statistics(rows).first()) == ("2020-01-01", "2020-03-15", 2)


def test_count_url_against_count_rows(make_articles):
    rows = make_articles(dict(url=None), dict())
    assert m.articles_per_day(rows).first()["article_count"] == 1
    assert m.trend_daily(rows).first()["count"] == 2


def test_pivot_fills_zero(make_articles):
    rows = salience_rows(make_articles)
    got = {r["publish_date"]: r for r in dicts(m.pivot_day_source(rows, ["example.com", "other.com", "none.com"]))}
    assert got["2020-03-15"]["example.com"] == 2 and got["2020-03-15"]["other.com"] == 0
    assert got["2020-03-16"]["none.com"] == 0


def test_rolling_mean_across_blocks(spark):
    """Small blocks, uneven months, two series: same as a plain loop."""
    random.seed(1)
    rows, want = [], {}
    for key in ("a", "b"):
        days = sorted({f"2020-{random.randint(1, 12):02d}-{random.randint(1, 28):02d}" for _ in range(90)}) + ["2021-01"]
        values = [random.randint(0, 9) for _ in days]
        rows += [(key, d, v) for d, v in zip(days, values)]
        for i, d in enumerate(days):
            want[key, d] = sum(values[i - 6 : i + 1]) / 7 if i >= 6 else None
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, d string, v int")
    got = {(r["k"], r["d"]): r["rolling_mean"] for r in dicts(rolling_mean(df, "d", "v", 7, ["k"], block=8))}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (w is None) and (w is None or abs(got[k] - w) < 1e-9) for k, w in want.items())


def test_running_number(spark):
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(500)], "d string").repartition(7)
    got = with_running_number(df, [], F.left("d", F.lit(2)), ["d"], "n")
    assert all(int(r["d"]) + 1 == r["n"] for r in dicts(got))


def test_top_n_with_and_without_salt(spark):
    df = spark.range(5000).select((F.col("id") % 3 * F.col("id") % 2).alias("k"), "id")
    plain = top_n_per_key(df, ["k"], ["id"], 7)
    salted = top_n_per_key(df, ["k"], ["id"], 7, salt=["id"], buckets=5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    assert top_n_per_key(df, ["k"], ["id"], 0).count() == 0


def brute_status(checks):
    out, last, n = [], {}, {}
    for service, ts, cid, status in sorted(checks, key=lambda c: (c[1], c[2])):
        n[service] = n.get(service, 0) + 1
        before = last.get(service)
        if before != status or n[service] % 6 == 0:
            out.append((service, cid, status, before, n[service], before != status, before == "DOWN" and status == "UP"))
        last[service] = status
    return sorted(out, key=lambda r: (r[0], r[1]))


def status_rows(df):
    cols = ["service", "check_id", "status", "previous", "check_number", "changed", "recovered"]
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def random_checks():
    random.seed(2)
    start = 1_600_000_000
    return [
        (random.choice("aab"), start + i * 600 + random.randint(0, 1), i, random.choice(["UP", "UP", "UP", "DOWN"]))
        for i in range(300)
    ]


def test_status_changes_against_a_loop(spark):
    checks = random_checks()
    df = spark.createDataFrame(checks, "service string, ts long, check_id long, status string")
    df = df.withColumn("ts", F.timestamp_seconds("ts"))
    for unit in ("minute", "hour", "month"):
        assert status_rows(status_changes(df, bucket=F.date_trunc(unit, "ts"))) == brute_status(checks)


def test_status_changes_batch_by_batch(spark):
    checks = random_checks()
    got, state = [], None
    for part in (checks[:90], checks[90:91], checks[91:]):
        df = spark.createDataFrame(part, "service string, ts long, check_id long, status string")
        changes, state = advance_status(df.withColumn("ts", F.timestamp_seconds("ts")), state)
        got += status_rows(changes)
        state = spark.createDataFrame(state.collect(), state.schema)
    assert sorted(got) == brute_status(checks)


def test_exports(spark, tmp_path, make_articles):
    rows = salience_rows(make_articles)
    for fmt in ("csv", "json"):
        assert export_metrics(rows, str(tmp_path / fmt), fmt) == 6
        assert {p.name for p in (tmp_path / fmt).iterdir()} == {
            "articles_per_day", "articles_per_source", "articles_per_source_per_day"}
    assert export_metrics(rows.filter("false"), str(tmp_path / "empty"), "csv") == 0
    export_salience_sections(rows, str(tmp_path / "sections"))
    assert {p.name for p in (tmp_path / "sections").glob("section=*")} == {
        "section=source", "section=language", "section=temporal"}
