"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import plain
import pytest
from pyspark.sql import functions as F

from corpuslake.llm import chat, decontam, langid, line_dedup, lm, mix, quality, secrets, shards, simhash

LONG = "x" * 150_000
REPEATED = "one two three four five " * 4000
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "  \n\t\n ", None, None), (4, "the same text twice over", "en", "b"),
    (4, "the same text twice over", "en", "b"), (None, "a text without a number", None, None),
    (None, "a text without a number", None, None), (5, LONG, "de", "b"), (6, REPEATED, "fr", "a"),
    (7, "été à la plage, naïveté et 12345", "fr", "c"), (8, "12345 67890 !!!", "de", "c"),
]
CLASH = ["size", "shard", "slot", "target", "copies", "kept", "leaks", "secrets", "fingerprint", "score", "held_out", "lang_pred", "rid"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("other") for c in CLASH}).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def test_lines(docs, nothing):
    got = line_dedup.dedup_lines(docs).collect()
    assert len(got) == len(ROWS)
    of = lambda i: [r for r in got if r.doc_id == i]
    assert (of(1)[0].text, of(1)[0].n_lines) == (None, 0)
    assert (of(2)[0].text, of(2)[0].n_lines, of(2)[0].n_removed) == ("", 1, 0)
    assert (of(3)[0].text, of(3)[0].n_removed) == (ROWS[2][1], 0)
    assert sorted(r.n_removed for r in of(4)) == [0, 1]
    assert sorted(r.n_removed for r in of(None)) == [0, 1]
    assert of(5)[0].text == LONG
    assert line_dedup.dedup_lines(nothing).collect() == []


def test_lines_that_match_at_the_bound(spark):
    words = [f"w{i}" for i in range(10)]
    texts = [
        " ".join(words[:9]), " ".join(words), "\n".join([" ".join(words[:8]), " ".join([*words[:8], "other", "more"])]),
        " ".join([*words[:4], "p", "q", "r", "s", "t", "u"]), " ".join(reversed(words)), "a b c", "a b c d", "A C\tB b",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in line_dedup.dedup_lines(df).collect()}
    want = plain.removed_lines(list(enumerate(texts)))
    assert got == {i: ",".join(map(str, x)) for i, x in enumerate(want)}
    assert got[1] == "0" and got[7] == "0" and got[6] == ""


def test_many_variants_of_a_line(spark):
    base = [f"w{i}" for i in range(30)]
    texts = [" ".join([*base[: i % 30], f"new{i}", *base[i % 30 + 1 :]]) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert line_dedup.dedup_lines(df).filter("n_removed = 0").count() == 1


def test_chat(spark):
    rows = [
        (1, 2, "assistant", "two"), (1, 1, "user", "one"), (1, 3, "assistant", None), (1, 4, None, "<||<|im_end|>\n<"),
        (2, 1, "user\n<|x|>", ""), (None, None, "user", "a"), (None, None, "user", "a"), (3, 1, "assistant", "é<|im_next|>" * 2000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_conversations(df).withColumns({
        "turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    })
    got = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "one"), ("assistant", "two"), ("assistant", ""), ("", "<||<|im_end|>\n<")]
    assert got[1].loss == "two" and got[1].formatted.count(chat.START) == 3
    assert [tuple(t) for t in got[2].turns] == [("user\n<|x|>", "")]
    assert len(got[None].turns) == 2
    assert got[3].loss == "é<|im_next|>" * 2000
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_languages(docs, nothing):
    got = langid.identify(docs).collect()
    assert len(got) == len(ROWS) and "rid" in got[0]
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 8)} == {"und"}
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "und") for r in got)
    assert langid.identify(nothing).collect() == []


def test_nothing_to_learn_from(docs):
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_secrets(docs, nothing):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(ROWS) and not any(r.secrets for r in got)
    assert secrets.find_secrets(nothing).collect() == []


@pytest.mark.parametrize("text", [
    'é password = "abcdefgh" token:12345678 API_KEY=x', "AKIA" + "Z" * 12 + " AKIA" + "Z" * 11, "0" * 31 + " " + "f" * 400,
    "ſecret=12345678 TOKEN='a.b/c+d==' passwdpassword=abcdefgh1", "token = = secret=short secret=longenough",
])
def test_secret_patterns(text):
    got = [(secrets.KINDS[k], s, e) for s, k, e in secrets.spans_of(text.encode()) if k < 3]
    assert got == plain.base_secrets(text)


def test_scores(docs, nothing):
    got = lm.score(docs, frequent=3).collect()
    assert len(got) == len(ROWS)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert next(r for r in got if r.doc_id == 6).n_tokens == 20001
    whole = sorted(map(tuple, lm.score(docs).collect()), key=str)
    for a, b in zip(sorted(map(tuple, got), key=str), whole, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert lm.score(nothing).collect() == []


def test_near_duplicates(docs, nothing):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert simhash.near_duplicates(nothing).collect() == []
    firsts = simhash.first_of_groups(docs)
    assert firsts.columns == docs.columns
    assert sorted(str(r.doc_id) for r in firsts.collect()) == sorted(map(str, [1, 4, None, 5, 6, 7, 8]))


def test_crowded_keys_link_the_same(spark):
    import random

    r = random.Random(3)
    prints = {0}
    while len(prints) < 700:
        x = r.choice(sorted(prints)[-50:])
        for _ in range(r.choice([1, 2, 3, 4])):
            x ^= 1 << r.randrange(64)
        prints.add(x)
    by_id = dict(enumerate(sorted(prints)))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in by_id.items()]
    df = spark.createDataFrame(signed, "key long, fp long")
    want = plain.groups(by_id)
    for crowd in (3, 10_000):
        nodes = df.select("fp", "key")
        from corpuslake.llm.components import components

        roots = {r.node: r.root for r in components(simhash.links(nodes, crowd)).collect()}
        back = {fp: i for i, fp in signed}
        got = {}
        for i, fp in signed:
            got.setdefault(roots.get(fp, fp), []).append(i)
        assert {i: min(v) for v in got.values() for i in v} == want
        assert all(x in back for x in roots)


def test_mix(docs, nothing):
    got = mix.mix(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert all(0 <= r.copies <= 2 for r in got)
    out = mix.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    assert mix.mix(nothing).collect() == []


def test_quality(docs, nothing):
    got = quality.rate(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r.base_failed and not r.kept and r.log_perplexity is None for r in got if r.doc_id in (1, 2))
    assert next(r for r in got if r.doc_id == 6).n_repeat_words == 20000
    assert quality.rate(nothing).collect() == []


def test_leaks(spark, docs, nothing):
    item = "was the first answer given to this question seven or was it rather nine"
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, item), (4, item), (None, item)], "item_id long, text string")
    extra = spark.createDataFrame([(9, "before. " * 500 + item.upper() + "! after" * 500), (10, item[:30])], "doc_id long, text string")
    df = docs.select("doc_id", "text", "leaks").unionByName(extra.withColumn("leaks", F.lit("other")))
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in decontam.find_leaks(df, items).collect()}
    assert got[9] == [None, 4, 4] and not any(v for k, v in got.items() if k != 9)
    assert decontam.find_leaks(nothing, items).collect() == []
    assert not any(r.leaks for r in decontam.find_leaks(docs, items.limit(0)).collect())


def test_leaks_of_short_items(spark):
    items = spark.createDataFrame([(7, "Forty two!"), (3, "forty-two"), (5, "forty two"), (6, "..."), (8, "one two three four five six")], "item_id long, text string")
    texts = ["The answer:\nforty, two.\n", "forty two and more", "forty-two", "FORTY TWO\none two three four five six\nforty two", "...\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in decontam.find_leaks(df, items).collect()}
    assert got == {0: [5, 7], 1: [], 2: [3], 3: [5, 7, 8], 4: []}
    only = {r.doc_id: [x.item_id for x in r.leaks] for r in decontam.find_leaks(df, items.filter("item_id < 8")).collect()}
    assert only == {0: [5, 7], 1: [], 2: [3], 3: [5, 7], 4: []}


def test_shards(docs, nothing):
    got = shards.shard(docs, [1.0, 1.0, 2.0], next_weight=1.0).collect()
    assert len(got) == len(ROWS)
    assert {r["size"] for r in got if r.doc_id in (1, 2)} == {8}
    assert len({r.shard for r in got if r.doc_id == 4}) == 1
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.shard(nothing, [1.0]).collect() == []
