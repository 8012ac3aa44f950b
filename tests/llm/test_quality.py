"""The perplexity verdict: the model against plain Kneser-Ney, junk of several kinds, clean documents."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslake.llm import gram_tables, ngrams, quality

DATA, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.01"


def mapped(text):
    return [10, 10, 10, *[48 if 48 <= b < 58 else 32 if b in (9, 11, 12, 13) else b for b in text]]


class Plain:
    """Modified Kneser-Ney with dictionaries, straight from its definition."""

    def __init__(self, texts):
        self.counts = {4: collections.Counter(tuple(s[i : i + 4]) for t in texts for s in [mapped(t)] for i in range(len(s) - 3))}
        for n in (3, 2, 1):
            self.counts[n] = collections.Counter(g[1:] for g in self.counts[n + 1])
        self.take, self.whole, self.aside = {}, {}, {}
        for n, c in self.counts.items():
            of = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
            self.take[n] = ngrams.discounts(of)
            self.whole[n], self.aside[n] = collections.Counter(), collections.Counter()
            for g, v in c.items():
                self.whole[n][g[:-1]] += v
                self.aside[n][g[:-1]] += self.take[n][min(v, 3)]

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / 256
        whole, lower = self.whole[n][gram[:-1]], self.p(gram[1:])
        if not whole:
            return lower
        v = self.counts[n][gram]
        return (v - self.take[n][min(v, 3)]) / whole + self.aside[n][gram[:-1]] / whole * lower


TEXTS = [b"the cat sat on the mat. The dog, too; 12 of 345", "été à la plage\n\tnaïve".encode(), b"aaaaaa", b"", b"abc abd abe abf #1 ##2"]


def test_model_is_modified_kneser_ney():
    model, plain = ngrams.Model(ngrams.counts_of(TEXTS)), Plain(TEXTS)
    for text in [*TEXTS, b"the cat is new 99 \xff\xfe", b"zzz qqq"]:
        s = mapped(text)
        want = [math.log(plain.p(tuple(s[i : i + 4]))) for i in range(len(text))]
        assert model.log_prob(ngrams.grams(text)).tolist() == pytest.approx(want, abs=1e-5)


def test_probabilities_sum_to_one():
    model = ngrams.Model(ngrams.counts_of(TEXTS))
    for context in (b"the", b"at ", b"\xff\xff\xff", b"aaa", b"zth"):
        packed = np.uint32(int.from_bytes(context, "big") << 8) + np.arange(256, dtype=np.uint32)
        assert np.exp(model.log_prob(packed)).sum() == pytest.approx(1, abs=1e-4)


def test_hash_arrays_find_what_is_there():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 1 << 32, 50_000, dtype=np.uint32))
    array = ngrams.HashArray(keys, np.arange(len(keys)))
    asked = np.concatenate([keys[::7], draw.integers(0, 1 << 32, 1000, dtype=np.uint32)])
    for part in (asked, asked[:10]):
        found, value = array.find(part)
        assert (found == np.isin(part, keys)).all()
        assert (keys[value[found].astype(int)] == part[found]).all()
    assert (np.diff(array.hashes.astype(np.int64)) > 0).all()
    assert not ngrams.HashArray(keys[:0], keys[:0]).find(asked)[0].any()


def test_spread_follows_the_lengths():
    groups = [(0.6745 * math.sqrt(0.0004 + 0.8 * r), r, 100) for r in (0.01, 0.003, 0.001, 0.0003, 0.00001)]
    assert quality.spread(groups) == pytest.approx((0.0004, 0.8), rel=1e-6)
    assert quality.spread([(0.6745 * math.sqrt(0.8 * r), r, 9) for r in (0.01, 0.001)])[0] == pytest.approx(0, abs=1e-12)
    a, b = quality.spread([(0.1, 0.01, 30)])
    assert a + b * 0.01 == pytest.approx((0.1 / 0.6745) ** 2)


def counted(spark, texts):
    rows = spark.createDataFrame([("en", 0, t.decode("utf-8", "replace")) for t in texts], "lang string, half int, text string")
    return {(r.half, r.gram): r.n for r in rows.repartition(3).mapInArrow(quality._counted, "lang string, half int, gram long, n long").groupBy("half", "gram").agg(F.sum("n").alias("n")).collect()}


def test_counts_from_spark_are_those_of_the_texts(spark):
    texts = [f"word{i} and some more words in a line of number {i}, so that it counts\n".encode() * (1 + i % 3) for i in range(50)]
    want = collections.Counter(int(g) for t in texts for g in ngrams.grams(t))
    got = counted(spark, [*texts, b"too short", b"a # b # c # d # e # f # g # h # i # j # k #"])
    assert got == {(0, g): n for g, n in want.items()}


@pytest.fixture(scope="module")
def judged(spark):
    """The given documents with junk planted among them: 60 English ones of each kind, spoiled."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    base = quality.rate(docs, keep=["doc_id", "text", "lang"]).collect()
    sound = [r for r in base if not r.base_failed and r.lang == "en" and r.n_symbols == 0 and len(r.text) >= 600 and r.kept][:360]
    draw = random.Random(5)

    def shuffled(text):
        w = text.split(" ")
        draw.shuffle(w)
        return " ".join(w)

    def letters(text):
        c = list(text)
        draw.shuffle(c)
        return "".join(c)

    kinds = {"words": shuffled, "letters": letters, **{s: lambda t, s=s: " ".join(w + s for w in t.split(" ")) for s in ("###", "&&&", "$$$", "***")}}
    planted = []
    for k, (kind, spoil) in enumerate(kinds.items()):
        planted += [(1_000_000 * (k + 1) + r.doc_id, spoil(r.text), "en", kind) for r in sound[k * 60 : k * 60 + 60]]
    frame = spark.createDataFrame([p[:3] for p in planted], "doc_id long, text string, lang string")
    after = {r.doc_id: r for r in quality.rate(docs.unionByName(frame), keep=["doc_id", "text"]).collect()}
    return base, planted, after


@pytest.mark.parametrize("kind", ["words", "letters", "###", "&&&", "$$$", "***"])
def test_junk_is_rejected(judged, kind):
    _, planted, after = judged
    own = [after[p[0]] for p in planted if p[3] == kind and not after[p[0]].base_failed]
    assert len(own) >= 55 and sum(not r.kept for r in own) >= 0.95 * len(own)


def test_clean_documents_are_kept(judged):
    base, _, after = judged
    clean = [r for r in base if not r.base_failed and r.n_symbols == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(after[r.doc_id].kept for r in clean) >= 0.98 * len(clean)  # junk beside them changes little


def test_symbol_junk_of_the_table_is_rejected(judged):
    junk = [r for r in judged[0] if not r.base_failed and 10 * r.n_symbols > r.n_words]
    assert len(junk) > 500 and sum(not r.kept for r in junk) >= 0.9 * len(junk)


def test_many_languages_share_a_model(spark, monkeypatch):
    monkeypatch.setattr(quality, "LANGUAGES", 2)
    monkeypatch.setattr(quality, "MOST_GRAMS", 400)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 40).cast("string").alias("lang"))
    own, models = quality.fit(docs.select("lang", (F.col("doc_id") % 2).cast("int").alias("half"), "text"))
    assert len(own) == 2 and {k for k, _ in models} == {*own, quality.OTHERS}
    assert sum(len(m.tables[-1].hashes) for m in models.values()) <= 400
    assert quality.rate(docs).count() == docs.count()


def test_grams_beyond_the_bound_count_as_in_the_whole_model(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    want = {r.doc_id: r for r in quality.rate(docs, keep=["doc_id"]).collect()}
    monkeypatch.setattr(quality, "MOST_GRAMS", 20_000)
    got = {r.doc_id: r for r in quality.rate(docs, keep=["doc_id"]).collect()}
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert got[i].log_perplexity == (None if r.log_perplexity is None else pytest.approx(r.log_perplexity, abs=1e-5))
    assert [got[i].kept for i in sorted(got)] == [want[i].kept for i in sorted(want)]


def test_tables_are_modified_kneser_ney(spark):
    top, n = np.unique(np.concatenate([ngrams.grams(t) for t in TEXTS]), return_counts=True)
    rows = [(k, int(g), int(c)) for k in (0, 1) for g, c in zip(top, n * (k + 1), strict=True)]
    found = gram_tables.tables(spark.createDataFrame(rows, "model int, gram long, n long"))
    asked = np.unique(np.concatenate([ngrams.grams(t) for t in [*TEXTS, b"the cat is new 99 \xff\xfe", b"zzz qqq"]]))
    out = gram_tables.log_probs(spark.createDataFrame([(0, int(g)) for g in asked], "model int, gram long"), found)
    plain = Plain(TEXTS)
    assert {r.gram: r.log_p for r in out.collect()} == {
        int(g): pytest.approx(math.log(plain.p(tuple(int(g).to_bytes(4, "big"))))) for g in asked
    }


def test_every_language_has_a_model_to_judge_it(spark, monkeypatch):
    monkeypatch.setattr(quality, "LANGUAGES", 2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 10).cast("string").alias("lang"))
    assert quality.rate(docs).filter("octet_length(text) > 0 AND log_perplexity IS NULL").count() == 0
