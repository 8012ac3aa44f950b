"""Line dedup: which words lead to a comparison, and lines about the sizes at which the method changes."""

import random

import plain
import xxhash

from corpuslake.llm import line_dedup


def test_rare_words_are_told_from_common_ones(spark):
    # Each line has three words of its own. By the low 13 bits of their hash they cannot be told from the commonest word.
    slot = lambda w, bits: xxhash.xxh64_intdigest(w.encode(), seed=42) % (1 << bits)
    rare = [w for i in range(600_000) if slot(w := f"r{i}", 13) == slot("the", 13) and slot(w, 17) != slot("the", 17)][:60]
    assert len(rare) == 60
    common = [f"c{i}" for i in range(6)]
    texts = [" ".join([*common, *["the"] * 40, *rare[3 * i : 3 * i + 3]]) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    words = [w for r in line_dedup.line_table(df, False).collect() for w in r.prefix]
    assert len(words) == 60 and len(set(words)) == 60


def test_lines_of_all_sizes(spark):
    rng = random.Random(5)
    pool, texts = [f"w{i}" for i in range(4000)], []
    for n in [*range(1, 24), *range(27, 36), *range(48, 84, 3), 100, 126, 129, 150, 160, 200, 257, 320]:
        base = rng.sample(pool, n)
        for apart in (0, n // 10, n // 9, n // 9 + 1, n // 5):
            texts.append(" ".join(rng.sample(base, n - apart) + rng.sample(pool, rng.choice([0, apart]))))
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in line_dedup.dedup_lines(df, with_text=False).collect()}
    want = plain.removed_lines(list(enumerate(texts)))
    assert got == {i: ",".join(map(str, x)) for i, x in enumerate(want)}
    assert 0 < sum(map(len, want)) < len(texts)
