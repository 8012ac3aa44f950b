"""Classes of texts by sums over their tokens: a naive Bayes labeller, and languages by ranked letter groups.

A model is a small table (token, class, weight) and one of classes; a text's score for a class is a start, so much per token, and the
weights of its tokens. Tokens are summed where they are split: what is shuffled is one row per text and class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import default_empty
from .classify import Scorer
from .ranking import top_n_per_key

#: Terms fall into so many slots by their hash; the model has a number per slot and class, whatever the vocabulary.
SLOTS = 4096
#: Letter groups that a language's profile ranks.
PROFILE = 400
#: Texts that a task sums at once, and words whose sums it remembers.
_SLICE, _KNOWN_WORDS = 256, 1 << 17


def words(text: Column | str) -> Column:
    """The lower-case words of a text: what stands between anything but letters."""
    return F.array_remove(F.split(F.lower(default_empty(text)), r"[^\p{L}]+"), "")


def slot(term: Column) -> Column:
    """The slot of a term: three hexadecimal digits of its MD5."""
    return F.conv(F.substring(F.md5(term), 1, 3), 16, 10).cast("int")


def word_groups(word: Column) -> Column:
    """Groups of two and three letters of one word, with a mark before and after it."""
    marked = F.concat(F.lit("_"), word, F.lit("_"))
    cut = lambda n: F.regexp_extract_all(marked, F.lit(f"(?s)(?=({'.' * n}))."), F.lit(1))
    return F.concat(cut(2), cut(3))


def letter_groups(text: Column | str) -> Column:
    """The letter groups of each word of a text."""
    return F.flatten(F.transform(words(text), word_groups))


def scores(texts: DataFrame, key: str, tokens: Column, classes: DataFrame, weights: DataFrame) -> DataFrame:
    """(key, class, score) of every text and class.

    ``classes`` has (class, start, per_token), ``weights`` (token, class, weight) for tokens that count at all. Rows with equal
    keys are summed as one text. NULL texts have no tokens and get the starts.
    """
    rows = texts.select(F.col(key).alias("key"), tokens.alias("tokens"))
    every = classes.agg(F.collect_list(F.struct("class", "start", "per_token"))).scalar()
    begun = rows.groupBy("key").agg(F.sum(F.size("tokens")).alias("size")).select("key", "size", F.explode(every).alias("c"))
    begun = begun.select("key", F.col("c.class").alias("class"), (F.col("c.start") + F.col("size") * F.col("c.per_token")).alias("begun"))
    hits = rows.select("key", F.explode("tokens").alias("token")).join(weights, "token").groupBy("key", "class").agg(F.sum("weight").alias("more"))
    hits = hits.select(F.col("key").alias("_key"), F.col("class").alias("_class"), "more")
    both = F.col("key").eqNullSafe(F.col("_key")) & (F.col("class") == F.col("_class"))
    return begun.join(hits, both, "left").select(
        F.col("key").alias(key), "class", (F.col("begun") + F.coalesce("more", F.lit(0.0))).alias("score")
    )


def best(scored: DataFrame, key: str) -> DataFrame:
    """(key, class) of the highest score; of equal ones the first class by name."""
    first = F.min(F.struct((-F.col("score")).alias("s"), "class")).alias("b")
    return scored.groupBy(key).agg(first).select(key, F.col("b.class").alias("class"))


def bayes_model(labelled: DataFrame, text: Column, category: str = "category") -> tuple[DataFrame, DataFrame]:
    """(classes, weights) of a multinomial naive Bayes model counted over all labelled texts.

    The probability of a slot in a category is (count + 1) / (terms of the category + SLOTS); the prior is the share of texts. Rows with
    no label, 'error' or 'unknown' teach nothing. The tables have at most a row per category, and per slot and category.
    """
    known = labelled.filter(F.col(category).isNotNull() & ~F.col(category).isin("error", "unknown"))
    rows = known.select(F.col(category).alias("class"), F.transform(words(text), slot).alias("slots"))
    classes = rows.groupBy("class").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("slots")).alias("terms"))
    total = classes.agg(F.sum("texts")).scalar()
    classes = classes.select("class", F.ln(F.col("texts") / total).alias("start"), (-F.ln(F.col("terms") + SLOTS)).alias("per_token"))
    counts = rows.select("class", F.explode("slots").alias("token")).groupBy("token", "class").agg(F.count(F.lit(1)).alias("n"))
    return classes, counts.select("token", "class", F.ln(F.col("n") + 1).alias("weight"))


def title_and_text() -> Column:
    return F.concat_ws(" ", "title", "content")


def bayes_scorer(labelled: DataFrame) -> Scorer:
    """Labeller for ``classify_articles``, learned from articles (title, content) that have a ``category``."""
    classes, weights = bayes_model(labelled, title_and_text())

    def score(rows: DataFrame) -> DataFrame:
        found = scores(rows, "url", F.transform(words(title_and_text()), slot), classes, weights)
        return best(found, "url").withColumnRenamed("class", "category")

    return score


def language_profiles(texts: DataFrame, text: str = "content", language: str = "language", size: int = PROFILE) -> DataFrame:
    """(language, token, rank): the commonest letter groups of each language, counted over all texts that name one.

    Words are counted first, and each word of a language is cut into groups once, however often it occurs.
    """
    # The outer form: Spark splits each text a second time to test that the plain one finds a word.
    rows = texts.filter(F.col(language).isNotNull()).select(F.col(language).alias("language"), F.explode_outer(words(text)).alias("word"))
    found = rows.filter(F.col("word").isNotNull()).groupBy("language", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = found.select("language", "n", F.explode_outer(word_groups(F.col("word"))).alias("token"))
    counts = counts.groupBy("language", "token").agg(F.sum("n").alias("n"))
    order = [F.col("n").desc(), F.col("token")]
    kept = top_n_per_key(counts, ["language"], order, size)
    ranked = kept.groupBy("language").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "token"))).alias("all"))
    return ranked.select("language", F.posexplode("all").alias("rank", "one")).select("language", F.col("one.token").alias("token"), "rank")


def _near(weights_of):
    """Sums of the weights of the letter groups of arrays of words, one number per class."""
    @F.arrow_udf("array<double>")
    def near(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        n_classes, weights = weights_of.value
        nothing, known = np.zeros(n_classes), {}

        def weigh(word: str) -> np.ndarray:
            marked, total = f"_{word}_", nothing
            for n in (2, 3):
                for i in range(len(marked) - n + 1):
                    more = weights.get(marked[i : i + n])
                    total = total if more is None else total + more
            return total

        for batch in texts:
            for at in range(0, max(1, len(batch)), _SLICE):
                part = batch.slice(at, _SLICE)
                spelled = part.flatten().dictionary_encode()
                if len(known) > _KNOWN_WORDS:
                    known.clear()
                table = []
                for word in spelled.dictionary.to_pylist():
                    if (row := known.get(word)) is None:
                        row = known[word] = weigh(word)
                    table.append(row)
                text = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy(zero_copy_only=False))
                place, found = spelled.indices.to_numpy(zero_copy_only=False), np.zeros((len(part), n_classes))
                for k, column in enumerate(np.array(table).reshape(len(table), n_classes).T):
                    found[:, k] = np.bincount(text, column[place], len(part))
                ends = np.arange(len(part) + 1, dtype=np.int32) * n_classes
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.ravel(), pa.float64()))

    return near.asNondeterministic()


def languages_by_profile(texts: DataFrame, profiles: DataFrame, key: str = "url", text: str = "content", size: int = PROFILE) -> DataFrame:
    """(key, language): the language whose profile the text's letter groups are least out of place in.

    A group costs its rank in the profile, or ``size`` if it is not there; the language of the least sum wins. Texts without letters
    are 'unknown'. The profiles, ``size`` rows a language, go to the tasks by way of the driver; a task weighs a word once and sums
    a text where it is split, so that one row per text and language is shuffled.
    """
    ranks = profiles.select("language", "token", "rank").collect()
    classes = sorted({r.language for r in ranks})
    at, weights = {c: i for i, c in enumerate(classes)}, {}
    for r in ranks:
        # Costs less what a missing group costs, so that only groups in a profile need be summed.
        weights.setdefault(r.token, np.zeros(len(classes)))[at[r.language]] += size - r.rank
    shared = texts.sparkSession.sparkContext.broadcast((len(classes), weights))
    found = texts.select(F.col(key).alias("key"), _near(shared)(words(text)).alias("near"))
    summed = found.select("key", F.posexplode_outer("near").alias("class", "score")).groupBy("key", "class").agg(F.sum("score").alias("score"))
    # Classes are numbered by name: of equal scores the first one wins.
    first = summed.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("s"), "class")).alias("b"))
    name = F.get(F.array(*[F.lit(c) for c in classes]).cast("array<string>"), F.col("b.class"))
    return first.select(F.col("key").alias(key), F.when(F.col("b.s") < 0, name).otherwise("unknown").alias("language"))


__all__ = [
    "bayes_model", "bayes_scorer", "best", "language_profiles", "languages_by_profile", "letter_groups", "scores", "slot", "word_groups", "words",
]
