"""Registered queries over the smallest tables against plain Python."""

import hashlib
import math
import struct
import zlib

import plain
import pytest
import xxhash
from conftest import DATA

from corpuslake.llm import decontam, lm, mix, secrets, shards
from corpuslake.llm.columns import held_out
from corpuslake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def rows(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, DATA).collect()}


def test_lines(spark, docs):
    got = rows(spark, "op1_line_dedup")
    order = sorted(docs)
    for i, gone in zip(order, plain.removed_lines([(i, docs[i].text) for i in order]), strict=True):
        assert (got[i].n_lines, got[i].n_removed, got[i].removed) == (
            docs[i].text.count("\n") + 1, len(gone), ",".join(map(str, gone))
        )


def test_languages_held_out(spark, docs):
    got = rows(spark, "op3_language_id")
    assert got.keys() == docs.keys()
    out = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in out} == {i for i in docs if plain.fold(i) == 0}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_secrets(spark, docs):
    got = rows(spark, "op4_secret_scan")
    for i, d in docs.items():
        base = plain.base_secrets(d.text)
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[0] == k for x in base) for k in ("assign", "access", "hex")]
        assert set(written.split(",")) <= set(got[i].spans.split(","))


def test_scores(spark, docs):
    got = rows(spark, "op5_lm_scoring")
    want = plain.base_scores({i: d.text for i, d in docs.items()})
    for i, (out, n, known, total, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_groups(spark, docs):
    got = rows(spark, "op6_simhash_near_dedup")
    prints = {i: plain.fingerprint(d.text) for i, d in docs.items()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == plain.groups(prints)


def test_mix_is_near_its_targets(spark, docs):
    got = rows(spark, "op7_mix_sources")
    by_source = {}
    for i, r in got.items():
        assert r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        by_source.setdefault(docs[i].source, []).append(r)
    for part in by_source.values():
        largest = max(r.size for r in part)
        assert abs(sum(r.taken for r in part) - part[0].target) <= 2 * largest
        assert part[0].target <= 2 * part[0].source_size
    assert sum(part[0].target for part in by_source.values()) == pytest.approx(mix.SHARE * sum(r.size for r in got.values()))


def test_quality(spark, docs):
    got = rows(spark, "op8_quality_rules")
    for i, d in docs.items():
        n, chars, symbols, dup, repeat = plain.base_quality(d.text)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (r.kept and r.base_failed)
    sound = [r for r in got.values() if not r.base_failed and 10 * r.n_symbols <= r.n_words]
    assert sum(r.kept for r in sound) >= 0.95 * len(sound)


def test_leaks(spark, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    got = rows(spark, "op9_decontamination")
    want = {i: plain.leaks(d.text, items) for i, d in docs.items()}
    assert {i: r.item_ids for i, r in got.items()} == {i: ",".join(map(str, x)) for i, x in want.items()}
    assert any(want.values())


def test_shards(spark, docs):
    got = rows(spark, "op10_sharding")
    slots = {}
    for i, r in got.items():
        raw = docs[i].text.encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(24))
    moved = sum(r.grown_shard == 24 for r in got.values())
    assert 0 < moved < 0.15 * len(got)


def test_shards_follow_their_weights(spark):
    df = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    n = {r.shard: r["count"] for r in shards.shard(df, [1.0, 3.0]).groupBy("shard").count().collect()}
    assert n[1] / n[0] == pytest.approx(3, rel=0.1)


def test_novel_strings():
    text = "curl with header Bearer q8Kd93kLmQ0zX71bVnC5tY2u and more"
    assert secrets.spans_of(text.encode()) == [(24, 3, 48)]
    assert secrets.spans_of(b"a plain sentence about the authentication of internationalisation") == []


def test_leaks_in_parts_of_the_benchmark(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    found = lambda: {r.doc_id: sorted(x.item_id for x in r.leaks) for r in decontam.find_leaks(docs, items).collect()}
    whole = found()
    monkeypatch.setattr(decontam, "MOST_BYTES", 3000)
    assert found() == whole


def rendezvous(key, weights):
    """The shard of least exponential draw, from XXH64 alone."""
    seed = xxhash.xxh64_intdigest(str(key).encode(), seed=42)
    draws = []
    for i, w in enumerate(weights):
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed) & ((1 << 53) - 1)
        draws.append((-math.log((h + 0.5) / (1 << 53)) / w, i))
    return min(draws)[1]


def test_shards_are_those_of_the_least_draws(spark, docs):
    got = rows(spark, "op10_sharding")
    assert {i: (r.shard, r.grown_shard) for i, r in got.items()} == {i: (rendezvous(i, [1.0] * 24), rendezvous(i, [1.0] * 25)) for i in docs}
    df = spark.range(500).selectExpr("id AS doc_id", "'x' AS text")
    weights = [0.5, 2.0, 1.0]
    assert {r.doc_id: r.shard for r in shards.shard(df, weights).collect()} == {i: rendezvous(i, weights) for i in range(500)}


def test_scores_sum_all_segmentations(spark, docs):
    """``score`` of some texts from plain sums over the pieces that were fitted."""
    frame = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    tagged = frame.select(held_out("doc_id", lm.FOLDS, lm.FOLD).alias("held_out"), "text")
    pieces, logp, end = lm.fit(lm.word_table(tagged), tagged.filter("not held_out").count())
    share, longest, known = {p: math.exp(x) for p, x in zip(pieces, logp, strict=True)}, max(map(len, pieces)), {}

    def word(w):
        if w not in known:
            spelled, sums = b" " + w, [1.0]
            for j in range(1, len(spelled) + 1):
                sums.append(sum(sums[i] * share.get(spelled[i:j], 0.0) for i in range(max(0, j - longest), j)))
            known[w] = math.log(sums[-1])
        return known[w]

    got = rows(spark, "op5_lm_scoring")
    for i in sorted(docs)[::9]:
        want = (sum(word(w) for w in plain.lowered(docs[i].text).encode().split()) + end) / math.log(10)
        assert got[i].score == pytest.approx(want, rel=1e-9)
