"""Line deduplication: an exact set-similarity join of all lines, in DataFrame operations only.

Two lines match if the Jaccard similarity of their word sets is at least 4/5; a line that matches an earlier line goes.
Words become 64-bit numbers whose order is their rarity, so a line is a sorted array and its prefix its rarest words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import staged

#: Similarity as a fraction. Sets of a and b words match if they share at least 4/9 of a + b.
NUM, DEN = 4, 5
#: Words are counted in this many slots of their hash; the order of the slots by count is the order of rarity.
SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS
#: From so many words a line has a second set of parity bits.
LONG = 64
#: A slot of prefix words is crowded if it has more lines than this, and more than so many times the mean.
CROWD, CROWD_MEANS = 256, 16
#: Crowded prefix words, those of least hash, by which a line is first held against the earliest line that has one of them.
#: Lines that share most of their prefix share some of these.
LEADS = 3
#: Bits, at least and at most, of the filter that keeps lines without a candidate from being moved for verification, and
#: bits for each of its lines.
FILTER_BITS, FILTER_EACH = (1 << 16, 1 << 23), 32


def _spaced(text: Column) -> Column:
    """Lower case, with a blank for every other white space but the line feed."""
    out, any_ = F.lower(text), F.lit(False)
    for c in "\t\v\f\r":
        out, any_ = F.replace(out, F.lit(c), F.lit(" ")), any_ | F.contains(text, F.lit(c))
    # Most texts have none, and to look for one is quicker than to replace it.
    return F.when(any_, out).otherwise(F.lower(text))


def words_of(spaced: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(spaced, " ")), "")


def rarity(docs: DataFrame, text: str) -> Column:
    """Literal array: the place of each slot when slots are ordered by the number of words in all texts, as the top bits of
    a number."""
    slot = F.xxhash64("w").bitwiseAND(F.lit(SLOTS - 1))
    words = F.split(F.replace(_spaced(F.col(text)), F.lit("\n"), F.lit(" ")), " ")
    counts = docs.select(F.explode(words).alias("w")).groupBy(slot.alias("slot")).count()
    every = docs.sparkSession.range(SLOTS).withColumnRenamed("id", "slot").join(counts, "slot", "left")
    ranked = sorted((r["count"] or 0, r["slot"]) for r in every.collect())
    place = [0] * SLOTS
    for i, (_, s) in enumerate(ranked):
        place[s] = (i - SLOTS // 2) << (64 - SLOT_BITS)
    return _numbers(place)


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bits(rows: DataFrame, at: Column, bits: int) -> Callable[[Column], Column]:
    """Test for a place under ``bits``: whether ``at`` of some row is that place. The driver gets bits / 64 numbers at most."""
    low = lambda c: c.bitwiseAND(F.lit(63)).cast("int")
    at64 = lambda c: F.call_function("shiftright", c.cast("bigint"), F.lit(6))
    filled = rows.select(at.alias("at")).groupBy(at64(F.col("at")).alias("at64")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), low(F.col("at")))).alias("bits")
    )
    known = {r.at64: r.bits for r in filled.collect()}
    table = _numbers([known.get(i, 0) for i in range(bits // 64)])
    return lambda c: F.call_function("shiftright", F.get(table, at64(c).cast("int")), low(c)).bitwiseAND(F.lit(1)) == 1


def prefix_size(n: Column) -> Column:
    """n - ceil(4n/5) + 1."""
    return n - F.ceil(n * NUM / DEN) + 1


def index_size(n: Column) -> Column:
    """n - ceil(8n/9) + 1: words of its prefix that the smaller of two matching sets needs."""
    return n - F.ceil(n * (2 * NUM) / (NUM + DEN)) + 1


def shared(a: Column, b: Column) -> Column:
    """Words that matching sets of a and b words have in common at least."""
    return F.ceil((a + b) * NUM / (NUM + DEN))


def _split(rows: DataFrame, with_text: bool = False) -> DataFrame:
    """A row per line of (key, text, ...): ``line_no``, ``spaced`` (the line for its words) and ``vid``, which names the
    line by what its document is and so is the same whenever the documents are read."""
    spaced = F.split(_spaced(F.col("text")), "\n")
    if with_text:
        spaced = F.arrays_zip(spaced.alias("spaced"), F.split("text", "\n").alias("line"))
    more = [c for c in rows.columns if c not in ("key", "text")]
    lines = rows.select("key", *more, F.xxhash64("key", "text").alias("did"), F.posexplode_outer(spaced).alias("line_no", "at"))
    own = [F.col("at.spaced").alias("spaced"), "at.line"] if with_text else [F.col("at").alias("spaced")]
    return lines.select("key", *more, "line_no", F.xxhash64("did", "line_no").alias("vid"), *own)


def line_table(docs: DataFrame, with_text: bool) -> DataFrame:
    """A row per line of (key, text): document, line, word set as signature, size, parity bits and prefix."""
    order = rarity(docs, "text")
    low = lambda t, bits: t.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    left = lambda x, n: F.call_function("shiftleft", x, n)
    lines = _split(docs.withColumn("rid", F.monotonically_increasing_id()), with_text)
    hashes = F.transform(F.split(F.coalesce("spaced", F.lit("")), " "), lambda w: F.xxhash64(w))
    lines = lines.withColumn("hashes", F.array_except(hashes, F.array(F.xxhash64(F.lit("")))))
    # Never NULL, and told so: arrays that may hold NULL are sorted far more slowly.
    number = lambda h: F.coalesce(F.get(order, low(h, SLOT_BITS)).bitwiseOR(
        F.call_function("shiftrightunsigned", h, F.lit(SLOT_BITS))
    ), F.lit(0).cast("long"))
    lines = lines.withColumn("set", F.sort_array(F.transform("hashes", number))).drop("hashes", "spaced")
    # 64 bits of parity of all words; of long lines, those of the words whose bit 6 is 1 besides.
    parity = lambda mark: F.aggregate("set", F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(mark(t)))
    ones = _numbers([0] * 64 + [(1 << i) - (i == 63) * (1 << 64) for i in range(64)])
    n = F.size("set")
    lines = lines.select(
        "key", "rid", "line_no", "vid", n.alias("n"), "set",
        parity(lambda t: left(F.lit(1).cast("long"), low(t, 6))).alias("b1"),
        F.when(n >= LONG, parity(lambda t: F.get(ones, low(t, 7)))).otherwise(0).alias("b2"),
        *(["line"] if with_text else []),
    )
    return lines.select(
        "key", "rid", "line_no", "vid", F.monotonically_increasing_id().alias("lid"), "n",
        F.xxhash64("set").alias("s1"), F.hash("set").alias("s2"), "b1", "b2",
        F.transform(F.slice("set", 1, F.greatest(prefix_size(F.col("n")), F.lit(1)).cast("int")), lambda t: F.hash(t)).alias("prefix"),
        *(["line"] if with_text else []),
    )


def _alike(a: str, b: str) -> Column:
    """Length filter, and no more differing parity bits than matching sets have differing words."""
    n, m = F.abs(F.col(f"{a}_m")), F.abs(F.col(f"{b}_m"))
    apart = n + m - 2 * shared(n, m)
    all_, some = (F.col(f"{a}_b{k}").bitwiseXOR(F.col(f"{b}_b{k}")) for k in (1, 2))
    near = F.least(n, m) * DEN >= F.greatest(n, m) * NUM
    # Of two long lines the words with bit 6 and those without are told apart.
    short, long = (F.least(n, m) < LONG) & (F.bit_count(all_) <= apart), F.least(n, m) >= LONG
    return near & (short | (long & (F.bit_count(some) + F.bit_count(all_.bitwiseXOR(some)) <= apart)))


def _earlier(a: str, b: str) -> Column:
    """Order of lines: by document key, NULL first, then as they stand."""
    k, m = F.col(f"{a}_key"), F.col(f"{b}_key")
    same = k.eqNullSafe(m) & (F.col(f"{a}_lid") < F.col(f"{b}_lid"))
    return F.coalesce(k < m, k.isNull() & m.isNotNull()) | same


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Lines ``b`` (lid) for which a pair (a, b) of lines really matches. The documents are read once more; only lines
    that may be in a pair are moved. A line is held against one other first, and against all others of its pairs only
    if these two don't match."""
    pairs = staged(pairs.distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("lid")).distinct().unionByName(pairs.select(F.col("b").alias("lid")).distinct()).distinct()
    ends = staged(ends.join(classes.select("lid", "vid"), "lid"), "ends")
    lines = ends.count()
    bits = FILTER_BITS[0]
    while bits < FILTER_BITS[1] and bits < FILTER_EACH * lines:
        bits *= 2
    place = F.pmod(F.xxhash64("vid"), F.lit(bits))
    maybe = _bits(ends, place, bits)(place)
    plain = docs.select(F.xxhash64("key", "text").alias("did"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    plain = plain.select("line", F.xxhash64("did", "line_no").alias("vid")).filter(maybe)
    # Lines move as text, which is shorter than their words apart.
    few = staged(plain.select("vid", "line").dropDuplicates(["vid"]).join(ends, "vid").select("lid", "line"), "few")

    def matching(some: DataFrame) -> DataFrame:
        left, right = (few.select(F.col("lid").alias(c), F.col("line").alias(f"{c}_line")) for c in "ab")
        sets = [words_of(_spaced(F.col(f"{c}_line"))).alias(f"{c}_set") for c in "ab"]
        both = F.size(F.array_intersect("s.a_set", "s.b_set"))
        match = both * (NUM + DEN) >= (F.size("s.a_set") + F.size("s.b_set")) * NUM
        # The generator keeps the filter from splitting the lines again.
        held = some.join(left, "a").join(right, "b").select("b", F.explode(F.array(F.struct(*sets))).alias("s"))
        return held.filter(match).select(F.col("b").alias("lid")).distinct()

    one = pairs.groupBy("b").agg(F.min("a").alias("a"))
    found = staged(matching(one), "found")
    rest = pairs.join(found.select(F.col("lid").alias("b")), "b", "left_anti").join(one, ["a", "b"], "left_anti")
    return found.unionByName(matching(rest))


def _named(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{name}_{c}") for c in rows.columns])


def _in_order(pairs: DataFrame) -> DataFrame:
    """Pairs of lines x and y as (a, b) by lid, the earlier one first; b must be open, that is, have a size over 0."""
    later = _earlier("x", "y")
    either = lambda c, yes, no: F.when(later, F.col(f"{yes}_{c}")).otherwise(F.col(f"{no}_{c}"))
    return pairs.filter(either("m", "y", "x") > 0).select(either("lid", "x", "y").alias("a"), either("lid", "y", "x").alias("b"))


def matched(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Names (lid) of the classes (first lines of equal word sets) that match an earlier class."""
    # Lines under four words match nothing but equal sets.
    classes = classes.filter("n >= 4")
    crowded = _crowded(classes)
    if crowded is None:
        done, open_ = None, classes.withColumn("open", F.lit(True))
    else:
        # First lines with crowded words are held against the earliest line under each of a few of these: variants of one
        # line are done with here, one pair each.
        lead = F.slice(F.sort_array(F.filter("prefix", crowded)), 1, LEADS)
        led = classes.select("lid", "key", F.col("n").alias("m"), "b1", "b2", F.explode(lead).alias("word"))
        first = led.groupBy("word").agg(F.min(F.struct("key", "lid", "m", "b1", "b2")).alias("x"), F.count(F.lit(1)).alias("c"))
        first = first.filter("c > 1").select("word", *[F.col(f"x.{c}").alias(f"x_{c}") for c in ("key", "lid", "m", "b1", "b2")])
        near = _named(led, "y").join(first, F.col("y_word") == F.col("word"))
        near = near.filter((F.col("x_lid") != F.col("y_lid")) & _alike("x", "y"))
        done = staged(verified(_in_order(near), classes, docs), "done")
        open_ = classes.join(done.withColumn("found", F.lit(True)), "lid", "left").withColumn("open", F.col("found").isNull())
        open_ = open_.drop("found")
    # Then all lines that share a prefix word, if one of the two is still open; lines that are done have a negative size
    # here. Lines meet by octaves of their size: x, the longer one, in its own, y in its own and, where longer lines may match it
    # there, in the next one with the words that the shorter of two lines needs (place -1 - pos). Both sides are the same
    # rows with the same columns and conditions, so they are dealt out once.
    n = F.col("n")
    octave = lambda c: F.length(F.bin(c))
    size = F.when(F.col("open"), n).otherwise(-n)
    rows = open_.select(
        "lid", "key", size.alias("m"), "b1", "b2", index_size(n).alias("few"), octave(n).alias("octave"),
        octave(F.floor(n * DEN / NUM)).alias("upto"), F.posexplode("prefix").alias("pos", "word"),
    )
    twice = (F.col("upto") > F.col("octave")) & (F.col("pos") < F.col("few"))
    rows = rows.withColumn("next", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = rows.select(
        "lid", "key", "m", "b1", "b2", F.hash("word", F.col("octave") + F.col("next")).alias("word"),
        F.when(F.col("next") == 1, -1 - F.col("pos")).otherwise(F.col("pos")).alias("pos"),
    )
    x, y = _named(rows, "x"), _named(rows, "y")
    n = {c: F.abs(F.col(f"{c}_m")) for c in "xy"}
    y_pos = F.when(F.col("y_pos") < 0, -1 - F.col("y_pos")).otherwise(F.col("y_pos"))
    longer = (n["x"] > n["y"]) | ((n["x"] == n["y"]) & (F.col("x_lid") < F.col("y_lid")))
    found = x.join(
        y,
        (F.col("x_word") == F.col("y_word")) & longer & (n["x"] * NUM <= n["y"] * DEN)
        & (F.least(n["x"] - F.col("x_pos"), n["y"] - y_pos) >= shared(n["x"], n["y"]))
        & (F.least("x_pos", y_pos) >= 0) & (F.greatest("x_m", "y_m") > 0) & _alike("x", "y"),
    )
    found = verified(_in_order(found), classes, docs)
    return found if done is None else done.unionByName(found)


def _crowded(classes: DataFrame) -> Callable[[Column], Column] | None:
    """Test for prefix words whose slot has many more lines than others; None if there are none."""
    slot = lambda word: word.bitwiseAND(F.lit(SLOTS - 1))
    total = classes.agg(F.sum(prefix_size(F.col("n")))).first()[0] or 0
    counts = classes.select(F.explode("prefix").alias("word")).groupBy(slot(F.col("word")).alias("slot")).count()
    counts = staged(counts.filter(F.col("count") > max(CROWD, CROWD_MEANS * total / SLOTS)), "crowded")
    if counts.isEmpty():
        return None
    test = _bits(counts, F.col("slot"), SLOTS)
    return lambda word: test(slot(word))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: ``key``, ``n_lines``, ``n_removed``, ``removed`` (numbers from 0 of the lines that go,
    ascending, comma-joined) and, unless ``with_text`` is False, ``text`` without these lines.

    A line goes if an earlier line, of the same or another document, matches it, whether or not that line stays.
    Earlier means a smaller key (NULL first), then the order of rows and lines. Words are split at ASCII white space
    and compared in lower case, each counted once. Lines without a word stay. A NULL text has no lines and stays NULL.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    lines = staged(line_table(rows, with_text), "lines")
    classes = lines.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("key", "lid", "vid", "b1", "b2", "prefix")).alias("f"))
    classes = staged(classes.select("n", "f.*"), "classes")
    kept = classes.select("lid").join(matched(classes, rows), "lid", "left_anti")
    judged = lines.join(kept.select("lid", F.lit(True).alias("first")), "lid", "left")
    stays = F.col("first").isNotNull() | (F.col("n") == 0)
    of_doc = judged.groupBy("rid", "key").agg(
        F.count("line_no").alias("n_lines"),
        F.count(F.when(~stays, 1)).alias("n_removed"),
        F.sort_array(F.collect_list(F.when(~stays, F.col("line_no")))).alias("gone"),
        *([F.sort_array(F.collect_list(F.when(stays & F.col("line").isNotNull(), F.struct("line_no", "line")))).alias("stay")] if with_text else []),
    )
    return of_doc.select(
        F.col("key").alias(key), "n_lines", "n_removed", F.array_join(F.col("gone").cast("array<string>"), ",").alias("removed"),
        *([F.when(F.col("n_lines") > 0, F.array_join(F.col("stay.line"), "\n")).alias(text)] if with_text else []),
    )
