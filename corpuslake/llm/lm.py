"""Language-model scores: a piece model over all segmentations of every word, and a smoothed word count baseline."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from .columns import held_out
from .components import staged
from .lattice import Lattice, read_vocabulary
from .tasks import utf8, words

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, FOLD = 5, 1
ROUNDS = 2
#: Weight of the vocabulary's own scores against the corpus, in pieces per million pieces seen.
PRIOR = 1000
#: The most frequent words, whose scores every task gets; a bound, not a limit: all other words are joined.
FREQUENT = 100_000
#: Distinct words that a task counts before it passes them on.
ROOM = 400_000


def _flush(count: Counter, learned: Counter):
    both = list(count)
    return pa.RecordBatch.from_arrays(
        [pa.array(both, pa.binary()), pa.array([learned[w] for w in both], pa.int64())], names=["word", "c"]
    )


def _count(batches):
    """(word, c): words of all texts, with the number of times seen in training texts."""
    count: Counter = Counter()
    learned: Counter = Counter()
    for batch in batches:
        for out, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            (count if out else learned).update(words(text))
            if len(count) + len(learned) > ROOM:
                count.update(dict.fromkeys(learned, 0))
                yield _flush(count, learned)
                count, learned = Counter(), Counter()
    count.update(dict.fromkeys(learned, 0))
    if count:
        yield _flush(count, learned)


def word_table(docs: DataFrame) -> DataFrame:
    """(word, c) of the distinct words in ``docs`` (held_out, text); c: times seen in rows not held out."""
    found = docs.select("held_out", "text").mapInArrow(_count, "word binary, c long")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def fit(table: DataFrame, texts: int, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, prior_weight: int = PRIOR):
    """Pieces, their natural log probabilities and that of the end, fitted on the training words of ``table``.

    The first weights are the vocabulary's own scores. Each round sums the expected uses of every piece over all
    segmentations of all training words, in Spark; the driver gets one number per piece.
    """
    spark = table.sparkSession
    pieces, prior = read_vocabulary(vocabulary)
    learned = table.filter("c > 0")
    logp, end = np.log(prior), -1.0
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((pieces, logp))

        def used(batches, model=model):
            pieces, logp = model.value
            lattice, total = Lattice(pieces), np.zeros(len(pieces))
            for batch in batches:
                total += lattice.expected(batch.column(0).to_pylist(), batch.column(1).to_numpy(), logp)
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["piece", "n"])

        got = learned.select("word", "c").mapInArrow(used, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        total = np.zeros(len(pieces))
        for r in got.collect():
            total[r.piece] = r.n
        share = 1 + total.sum() * prior_weight / 1e6
        whole = total.sum() + share + texts + 1
        logp, end = np.log((total + share * prior) / whole), float(np.log((texts + 1) / whole))
    return pieces, logp, end


def level():
    """Counts in steps of a sixteenth of an octave; words never seen in training come last."""
    return F.when(F.col("c") > 0, F.floor(F.log2(F.col("c")) * 16)).otherwise(-1)


def floor_of_frequent(table: DataFrame, frequent: int) -> int:
    """The least level such that no more than ``frequent`` words reach it."""
    least, sum_ = 1 << 20, 0
    for r in sorted(table.groupBy(level().alias("level")).count().collect(), reverse=True):
        sum_ += r["count"]
        if sum_ > frequent or r["level"] < 0:
            break
        least = r["level"]
    return least


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, frequent: int = FREQUENT,
) -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words (A-Z in lower case) and an end. ``base_score`` sums log10 of their add-half estimates.
    ``score`` is log10 of the text's probability: pieces are drawn one after the other, a word has the sum over all its
    segmentations, the end ends the text. Learns from rows whose crc32 of the id, modulo 5, is not 1.
    NULL, empty and blank texts consist of the end alone. Rows with equal or NULL keys are scored by themselves.

    Words are counted and scored once each in a table. Scores of the ``frequent`` commonest words go to the tasks
    that read the documents; what is left of a document is joined to the table by word and summed up.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), held_out(key, FOLDS, FOLD).alias("held_out"), F.col(f"`{text}`").alias("text")
    )
    table = staged(word_table(rows), "words")
    texts = rows.filter("not held_out").count()
    known = table.filter("c > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    distinct, tokens = known[0] + (texts > 0), known[1] + texts
    pieces, logp, end = fit(table, texts, vocabulary)
    model = spark.sparkContext.broadcast((pieces, logp))

    def scored(batches):
        pieces, logp = model.value
        lattice = Lattice(pieces)
        for batch in batches:
            got = lattice.log_marginals(batch.column(0).to_pylist(), logp[:, None])[:, 0] / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got)], names=["word", "c", "lm"])

    table = staged(table.mapInArrow(scored, "word binary, c long, lm double"), "scored")
    top = table.filter(level() >= floor_of_frequent(table, frequent)).toArrow()
    lookup = spark.sparkContext.broadcast((
        top.column("word").to_pylist(), top.column("c").to_numpy(), top.column("lm").to_numpy(),
    ))
    base = float(tokens + 0.5 * (distinct + 1))
    end_base = float(np.log10((texts + 0.5) / base))
    end_lm = end / float(np.log(10))

    kind = docs.schema[key].dataType
    form = StructType([
        StructField("row", LongType()), StructField("key", kind), StructField("held_out", BooleanType()),
        StructField("word", BinaryType()), StructField("n", LongType()), StructField("n_known", LongType()),
        StructField("base", DoubleType()), StructField("lm", DoubleType()),
    ])

    def looked_up(batches):
        """A row per document with the sums over its frequent words, and rows (word, n) of its other words."""
        word, c, lm = lookup.value
        place = {w: i for i, w in enumerate(word)}
        low = np.log10((c + 0.5) / base)

        def packed(row, key, out, word, n, known, sums, lms):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(row, pa.int64()), key, out, pa.array(word, pa.binary()), pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(lms, pa.float64()),
                ],
                names=form.names,
            )

        for batch in batches:
            heads: list[tuple] = []
            owner, rest, n = [], [], []

            def others(owner, rest, n, batch=batch):
                k = len(owner)
                return packed(owner, pa.nulls(k, batch.column(1).type), pa.nulls(k, pa.bool_()), rest, n, [None] * k, [None] * k, [None] * k)

            for row, text in zip(batch.column(0).to_pylist(), utf8(batch.column(3)), strict=True):
                found = words(text)
                at = np.fromiter((place.get(w, -1) for w in found), np.int64, len(found))
                hit = at[at >= 0]
                heads.append((
                    row, len(found) + 1, int((c[hit] > 0).sum()) + (texts > 0),
                    float(low[hit].sum()) + end_base, float(lm[hit].sum()) + end_lm,
                ))
                if len(hit) < len(found):
                    left = Counter(found[i] for i in np.nonzero(at < 0)[0])
                    owner += [row] * len(left)
                    rest += left
                    n += left.values()
                    if len(owner) > ROOM // 2:
                        yield others(owner, rest, n)
                        owner, rest, n = [], [], []
            if owner:
                yield others(owner, rest, n)
            row, size, known, sums, lms = zip(*heads, strict=True) if heads else ([],) * 5
            yield packed(row, batch.column(1), batch.column(2), [None] * len(row), size, known, sums, lms)

    # The number of a row ties its parts together; it is drawn in the one job that writes them.
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "held_out", "text")
    parts = staged(numbered.mapInArrow(looked_up, form), "parts")
    rest = parts.filter("word is not null").select("row", "word", "n").join(table, "word")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(base))).alias("more_base"),
        F.sum(F.col("n") * F.col("lm")).alias("more_lm"),
    )
    of_row = parts.filter("word is null").drop("word").join(rest, "row", "left")
    add = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return of_row.select(
        F.col("key").alias(key), "held_out", F.col("n").alias("n_tokens"), add("n_known", "more_known").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), add("base", "more_base").alias("base_score"), add("lm", "more_lm").alias("score"),
    )
