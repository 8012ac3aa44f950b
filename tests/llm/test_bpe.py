"""The automaton against the tokenizers library, which merges pair by pair."""

import hashlib
import random

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuslake.llm import bpe
from corpuslake.llm.queries import QUERIES

WRITTEN = open(bpe.VOCABULARY, encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(WRITTEN)
CODER, LABELS = bpe.Coder(WRITTEN), bpe.Labels(WRITTEN)


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = CODER.encode(text.encode())
    assert np.frombuffer(got, "<u4").tolist() == want
    assert LABELS.decode(got) == LIBRARY.decode(want, skip_special_tokens=False)


def test_every_character_of_the_first_planes():
    for i in [*range(0x3000), *range(0xA640, 0xA700), *range(0xFB00, 0xFF00), *range(0x1F300, 0x1F700)]:
        if not 0xD800 <= i < 0xE000:
            same(f"a{chr(i)}B {chr(i)}")


@pytest.mark.parametrize("c", list("aAbo!.é=-ſΣ") + ["the", "ab", "aab"])
def test_runs_merge_from_the_left(c):
    for n in range(1, 60):
        same(c * n)


def test_special_tokens_inside_texts():
    draw = random.Random(2)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "́", "e", "'s", " ", "<", "|>", "\n", "\x1c", " "]
    for _ in range(1500):
        same("".join(draw.choices(parts, k=draw.randrange(1, 12))))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abehinorst'. ", max_size=80))
def test_texts_of_common_letters(text):
    same(text)


def test_long_words_without_a_cut():
    draw = random.Random(3)
    same("".join(draw.choices("etaoinshrdlu", k=20_000)))
    same("".join(draw.choices("строка世界", k=3000)))


def tiny(merges):
    symbols = [*bpe.byte_labels(), *[c + "</w>" for c in bpe.byte_labels()]]
    vocab = {t: i for i, t in enumerate([*symbols, *dict.fromkeys(a + b for a, b in merges)])}
    return vocab, bpe.Automaton(vocab, merges, "</w>")


def merged(word, vocab, merges):
    """Merges in their order, each from the left, one pair at a time."""
    parts = [*word[:-1], word[-1] + "</w>"]
    for a, b in merges:
        out = []
        for p in parts:
            if out and out[-1] == a and p == b:
                out[-1] = a + b
            else:
                out.append(p)
        parts = out
    return [vocab[p] for p in parts]


def test_random_merge_lists():
    """Merge lists whose tokens overlap in every way, dead merges among them."""
    draw = random.Random(4)
    for _ in range(150):
        made, merges = ["a", "b", "c", "a</w>", "b</w>"], []
        for _ in range(draw.randrange(1, 14)):
            a = draw.choice([t for t in made if not t.endswith("</w>")])
            b = draw.choice(made)
            if a + b not in made:
                merges.append((a, b))
                made.append(a + b)
        vocab, automaton = tiny(merges)
        for _ in range(60):
            word = "".join(draw.choices("abc", k=draw.randrange(1, 14)))
            assert list(automaton.path(word.encode())) == merged(word, vocab, merges), (merges, word)


def test_arcs_are_the_pairs_that_stay_apart():
    """Two tokens have an arc exactly if merging their joint spelling gives these two."""
    merges = [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "a"), ("aa", "b"), ("c", "ab")]
    vocab, automaton = tiny(merges)
    whole = [t for t in ["a", "b", "c", *[a + b for a, b in merges]] if _merged_inside(t, merges) == [t]]
    assert len(whole) > 5
    for s in whole:
        for t in whole:
            assert automaton.arc(vocab[s], vocab[t]) == (_merged_inside(s + t, merges) == [s, t]), (s, t)


def _merged_inside(word, merges):
    parts = list(word)
    for a, b in merges:
        out = []
        for p in parts:
            if out and out[-1] == a and p == b:
                out[-1] = a + b
            else:
                out.append(p)
        parts = out
    return parts


def test_remembering_is_bounded_and_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    monkeypatch.setattr(bpe, "ARCS", 11)
    small = bpe.Coder(WRITTEN)
    text = " ".join(f"word{i % 40} Täg{i % 13}, don't" for i in range(300))
    assert small.encode(text.encode()) == CODER.encode(text.encode())
    assert len(small.strings) <= 7 and len(small.strings.before) <= 7 and len(small.automaton.known) <= 11


def test_query_over_the_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op11_bpe_coding"](spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert got.keys() == {d.doc_id for d in docs}
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t  "), (4, "same"), (4, "same"), (None, "x" * 150_000), (5, "one " * 30_000), (6, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("other") for c in ("ids", "decoded", "words")})
    out = bpe.decode(bpe.encode(df, ids="codes"), ids="codes", text="back")
    assert out.columns == [*df.columns, "codes", "back"]
    got = out.withColumn("list", bpe.unpacked(F.col("codes"))).collect()
    assert len(got) == len(rows) and all(r.ids == r.decoded == "other" for r in got)
    for r in got:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.codes), "<u4").tolist() == ids and r.list == ids
        assert r.back == LIBRARY.decode(ids, skip_special_tokens=False)
    assert "ids" in bpe.encode(df).columns and bpe.encode(df.limit(0)).collect() == []
    both = bpe.encode(df, decoded="words", keep=["doc_id", "decoded"])
    assert both.columns == ["doc_id", "decoded", "ids", "words"]
    assert sorted((str(r.doc_id), bytes(r.ids), r.words) for r in both.collect()) == sorted((str(r.doc_id), bytes(r.codes), r.back) for r in got)
    odd = spark.createDataFrame([(bytearray(np.array([49407, 900_000, 320], "<u4").tobytes()),), (None,)], "ids binary")
    assert [r.decoded for r in bpe.decode(odd).collect()] == ["<|endoftext|> a</w>", ""]
