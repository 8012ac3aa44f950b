"""The pipeline on the smallest table, stage by stage, against what each stage's rule says of its own input."""

import plain
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from corpuslake.llm import mix
from corpuslake.llm.components import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    extra = spark.createDataFrame([(900001, "12 34 !", "en", "src1", 7), (900002, None, "en", "src1", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(extra)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], DATA), name))
    return [[r.asDict() for r in df.collect()] for df in out], [df.columns for df in out]


def test_columns(stages):
    assert stages[1] == [COLUMNS] * 5 + [[*COLUMNS, "shard", "slot"]]


def test_language_keeps_documents_with_letters(stages):
    before, after = stages[0][0], stages[0][1]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {900001, 900002}


def test_one_of_each_group(stages):
    before, after = stages[0][1], stages[0][2]
    group = plain.groups({r["doc_id"]: plain.fingerprint(r["text"]) for r in before})
    assert sorted(r["doc_id"] for r in after) == sorted(set(group.values()))


def test_leaks_go(spark, stages):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    before, after = stages[0][2], stages[0][3]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if not plain.leaks(r["text"], items))
    assert len(after) < len(before)


def test_mix_takes_each_near_its_target(spark, stages):
    before, after = stages[0][3], stages[0][4]
    size = {r["doc_id"]: len(plain.words(r["text"])) for r in before}
    taken = sum(size[r["doc_id"]] for r in after)
    assert taken == pytest.approx(mix.SHARE * sum(size.values()), rel=0.05)
    assert {r["doc_id"] for r in after} <= set(size)


def test_shards_have_gapless_slots(stages):
    before, after = stages[0][4], stages[0][5]
    key = lambda r: tuple(r[c] for c in COLUMNS)
    assert sorted(map(key, before)) == sorted(map(key, after))
    slots = {}
    for r in after:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == [*COLUMNS, "shard", "slot"] and out.filter(F.col("shard").isNull()).count() == 0


CLASH = ["score", "held_out", "lang_pred", "leaks", "size", "copies", "target", "fingerprint", "component_id", "group_print", "shard", "slot", "rank"]
LONG = "wort " * 60_000


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, "en", "a"), (2, "", "de", "a"), (3, LONG, "de", None), (4, "the same text in two rows here", "en", "b"),
        (4, "the same text in two rows here", "en", "b"), (None, "a text that has no number at all", None, None), (5, "12 34", "fr", "c"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_own_columns_come_out_as_they_went_in(spark, odd, name):
    out = staged(dict(corpus_pipeline.STAGES)[name](spark, odd, DATA), name)
    if name == "sharding":
        renamed = {"shard": "input_shard", "slot": "input_slot"}
        assert out.columns == [renamed.get(c, c) for c in odd.columns] + ["shard", "slot"]
        out = out.drop("shard", "slot").withColumnsRenamed({v: k for k, v in renamed.items()})
    assert out.columns == odd.columns
    rows = [tuple(r) for r in out.collect()]
    assert rows and all(r[4:] == tuple(f"own {c}" for c in CLASH) for r in rows)
    before = {tuple(r) for r in odd.collect()}
    assert set(rows) <= before
    if name == "language_id":
        assert not {1, 2, 5} & {r[0] for r in rows}
    if name == "near_dedup":
        assert sorted(str(r[0]) for r in rows) == sorted(["1", "3", "4", "5", "None"])
    if name == "decontamination":
        assert len(rows) == 7


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, odd, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, odd.limit(0), DATA).collect() == []
