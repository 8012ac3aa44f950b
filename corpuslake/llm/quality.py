"""Quality rules: counts of words, symbols and repetitions, and a perplexity band per language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gram_tables, ngrams
from .columns import without
from .components import staged
from .tasks import utf8

#: Languages with a model of their own, those with most text; all others share one. Names the shared one has.
LANGUAGES, OTHERS = 31, "other languages"
#: Grams that a task holds of all models together, whatever the corpus. Of more, the commonest of each model are held with their
#: probabilities; all others are looked up in tables.
MOST_GRAMS = 1 << 21
#: A band ends so many standard deviations from its language's median.
WIDTH = 3.5
#: Texts that the second model is learned from lie within so many of the first one's.
LEARN_WIDTH = 2.0
#: Texts are learned from if they have this many words and at most one symbol in so many words.
LEARN_WORDS, LEARN_RARE = 10, 10
#: Documents of about one length that it takes to measure their spread.
LEAST_GROUP = 20
BIN = 0.001
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_perplexity", "kept"]

SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BEGINS = (np.arange(256) & 0xC0) != 0x80
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


NO_GRAMS = np.zeros(0, np.uint32), np.zeros(0, np.int64)


def log_sum(model: ngrams.Model | ngrams.Part | None, text: bytes) -> tuple[float | None, tuple[np.ndarray, np.ndarray]]:
    """Log probability of a text, NULL for an empty one or without a model; and the (grams, times each) that it leaves out
    because the model lacks them here."""
    if model is None or not text:
        return None, NO_GRAMS
    packed = ngrams.grams(text)
    sums, rest = zip(*(model.known(packed[at : at + (1 << 20)]) for at in range(0, len(packed), 1 << 20)), strict=True)
    return float(sum(sums)), np.unique(np.concatenate(rest), return_counts=True) if any(map(len, rest)) else NO_GRAMS


ASKED = "model:int,asked:array<struct<gram:long,n:long>>"


def _asked(models: Sequence[ngrams.Model | ngrams.Part | None], asked: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """The fields ASKED."""
    ends = np.cumsum([0, *(len(g) for g, _ in asked)]).astype(np.int32)
    columns = [pa.array(np.concatenate([NO_GRAMS[k], *(x[k] for x in asked)]).astype(np.int64)) for k in (0, 1)]
    each = pa.StructArray.from_arrays(columns, names=["gram", "n"])
    return [pa.array([getattr(m, "number", None) for m in models], pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)]


def _counted(batches, first=None):
    """(lang, half, gram, n) of the texts that are learned from; ``first`` has models and bands that they are held against. Texts
    with grams that these models lack here are left to the tables."""
    models, found = first.value if first is not None else ({}, {})
    sums: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[tuple, list[np.ndarray]] = {}
    size = 0

    def merge():
        for key, parts in waiting.items():
            new, n = np.unique(np.concatenate(parts), return_counts=True)
            if key in sums:
                new, inverse = np.unique(np.concatenate([sums[key][0], new]), return_inverse=True)
                n = np.bincount(inverse, np.concatenate([sums[key][1], n])).astype(np.int64)
            sums[key] = new, n
        waiting.clear()

    def flush():
        for (lang, half), (packed, n) in sums.items():
            k = len(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([half] * k, pa.int32()), pa.array(packed.astype(np.int64)), pa.array(n, pa.int64())],
                names=["lang", "half", "gram", "n"],
            )
        sums.clear()

    for batch in batches:
        for lang, half, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
            words = len(text.split())
            if words < LEARN_WORDS or LEARN_RARE * int(SYMBOL[np.frombuffer(text, np.uint8)].sum()) > words:
                continue
            if lang in found:
                middle, a, b = found[lang]
                total, (rest, _) = log_sum(models.get((lang, 1 - half)), text)
                if len(rest):
                    continue
                if total is not None and abs(-total / len(text) - middle) > LEARN_WIDTH * (a + b / len(text)) ** 0.5:
                    continue
            waiting.setdefault((lang, half), []).append(ngrams.grams(text))
            size += len(text)
            if size > 1 << 22:
                merge()
                size = 0
                if sum(len(x) for x, _ in sums.values()) > 1 << 22:
                    yield from flush()
    merge()
    yield from flush()


def _count(rows: DataFrame, first=None) -> DataFrame:
    return rows.mapInArrow(lambda batches: _counted(batches, first), "lang string, half int, gram long, n long")


def learned(
    counted: DataFrame, own: list[str] | None = None
) -> tuple[list[str], dict[tuple[str, int], ngrams.Model | ngrams.Part], gram_tables.Tables | None]:
    """Languages with a model of their own (``own`` if given), a model per language and half, and their tables if they hold more than
    MOST_GRAMS grams, from (lang, half, gram, n) with repetitions.

    Grams are counted over all texts in Spark. At most LANGUAGES names, a count of counts per model, and MOST_GRAMS grams come to the driver.
    """
    table = staged(counted, "grams")
    order = [F.col("n").desc(), "lang"]
    if own is None:
        own = [r.lang for r in table.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(*order).limit(LANGUAGES).collect()]
    pooled = F.when(F.col("lang").isin(own), F.col("lang")).otherwise(F.lit(OTHERS))
    table = staged(table.groupBy(pooled.alias("lang"), "half", "gram").agg(F.sum("n").alias("n")), "counts")
    level = F.floor(F.log2("n") * 8)
    levels: dict[tuple, list] = {}
    for r in table.groupBy("lang", "half", level.alias("level")).count().collect():
        levels.setdefault((r.lang, r.half), []).append((r.level, r["count"]))
    if not levels:
        return own, {}, None
    # Models go by number, so that what comes to the driver is numbers alone.
    keys, which = sorted(levels), F.lit(-1)
    for k, (lang, half) in enumerate(keys):
        which = F.when((F.col("lang") == lang) & (F.col("half") == half), k).otherwise(which)
    table = table.select(which.alias("model"), "gram", "n")
    whole = None
    if sum(n for found in levels.values() for _, n in found) <= MOST_GRAMS:
        found = table
    else:
        whole, from_level = gram_tables.tables(table), F.lit(1 << 30)
        for k, key in enumerate(keys):
            sums, least = 0, 1 << 30
            for at, n in sorted(levels[key], reverse=True):
                sums += n
                if sums > MOST_GRAMS // len(keys):
                    break
                least = at
            from_level = F.when(F.col("model") == k, least).otherwise(from_level)
        found = whole.grams[-1].filter(level >= from_level).select("model", "gram", "log_p")
    found = found.toArrow()
    number, packed, values = (found.column(i).to_numpy() for i in range(3))
    models: dict[tuple[str, int], ngrams.Model | ngrams.Part] = {}
    for k, key in enumerate(keys):
        own_grams, own_values = packed[number == k].astype(np.uint32), values[number == k]
        order = np.argsort(own_grams)
        own_grams, own_values = own_grams[order], own_values[order]
        models[key] = ngrams.Model(ngrams.all_orders(own_grams, own_values)) if whole is None else ngrams.Part(k, own_grams, own_values)
    return own, models, whole


def fit(rows: DataFrame) -> tuple[list[str], dict[tuple[str, int], ngrams.Model | ngrams.Part]]:
    """What tasks hold of the models learned from all of (lang, half, text)."""
    return learned(_count(rows))[:2]


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words that stand in some window found twice or more."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, upto = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            total += i + window - max(i, upto)
            upto = i + window
    return total


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


MEASURES = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,n_grams:long,log_sum:double," + ASKED + ">"


def _measured(models_of):
    @F.arrow_udf(MEASURES)
    def measure(texts: pa.Array, langs: pa.Array, halves: pa.Array) -> pa.Array:
        models = models_of.value
        out: list[list] = [[] for _ in range(7)]
        own, asked = [models.get((lang, 1 - half)) for lang, half in zip(langs.to_pylist(), halves.to_pylist(), strict=True)], []
        for text, model in zip(utf8(texts), own, strict=True):
            raw = np.frombuffer(text, np.uint8)
            words = text.split()
            # Texts of the other half made the model; copies of this one did not.
            total, rest = log_sum(model, text)
            asked.append(rest)
            row = (
                len(words), int((BEGINS & ~SPACE)[raw].sum()), int(SYMBOL[raw].sum()), dup_lines(text),
                repeated_words(words), len(raw), total,
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "log_sum", "model", "asked"]
        kinds = [pa.int64()] * 6 + [pa.float64()]
        return pa.StructArray.from_arrays([*(pa.array(c, k) for c, k in zip(out, kinds, strict=True)), *_asked(own, asked)], names=names)

    return measure.asNondeterministic()


def _scored(models_of):
    @F.arrow_udf("struct<log_sum:double," + ASKED + ">")
    def score(texts: pa.Array, langs: pa.Array, halves: pa.Array) -> pa.Array:
        models = models_of.value
        own = [models.get((lang, 1 - half)) for lang, half in zip(langs.to_pylist(), halves.to_pylist(), strict=True)]
        out = [log_sum(model, text) for model, text in zip(own, utf8(texts), strict=True)]
        sums = pa.array([total for total, _ in out], pa.float64())
        return pa.StructArray.from_arrays([sums, *_asked(own, [rest for _, rest in out])], names=["log_sum", "model", "asked"])

    return score.asNondeterministic()


def spread(groups: Sequence[tuple[float, float, int]]) -> tuple[float, float]:
    """(a, b) so that the log perplexities of sound texts of n bytes have the variance a + b / n.

    ``groups`` has of documents of about one length: the distance from the median to the nearer quartile, the mean of 1 / n, their
    number. The nearer quartile hardly moves even if a quarter is junk. Least squares of relative errors, neither part below zero.
    """
    y = np.array([(max(q, BIN / 2) / 0.6745) ** 2 for q, _, _ in groups])
    x = np.array([[1.0, r] for _, r, _ in groups])
    w = np.sqrt([n for _, _, n in groups]) / y
    a, b = np.linalg.lstsq(x * w[:, None], y * w, rcond=None)[0] if len(y) > 1 else (-1.0, 0.0)
    if a < 0 or b < 0:
        only = [float((x[:, k] * y * w**2).sum() / (x[:, k] ** 2 * w**2).sum()) for k in (0, 1)]
        error = [float((((x[:, k] * only[k] - y) * w) ** 2).sum()) for k in (0, 1)]
        a, b = (only[0], 0.0) if error[0] < error[1] else (0.0, only[1])
    return float(a), float(b)


def bands(measured: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Median, and the two parts of the spread, of each language's log perplexities (lang, log_perplexity, n_grams, base_failed).

    From histograms of all documents by length, in octaves; a few rows per language come to the driver. Languages of which no
    LEAST_GROUP documents are of about one length have no band.
    """
    sound = measured.filter(~F.col("base_failed") & F.col("log_perplexity").isNotNull())
    octave = F.floor(F.log2("n_grams")).alias("octave")
    bins = sound.groupBy("lang", octave, F.floor(F.col("log_perplexity") / BIN).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(1 / F.col("n_grams")).alias("inverse")
    )
    quantile = lambda p: F.expr(f"percentile(bin, {p}, n)")
    by_length = bins.groupBy("lang", "octave").agg(
        (F.least(quantile(0.75) - quantile(0.5), quantile(0.5) - quantile(0.25)) * BIN).alias("distance"), F.sum("n").alias("n"), F.sum("inverse").alias("inverse")
    )
    groups: dict[str, list] = {}
    for r in by_length.filter(F.col("n") >= LEAST_GROUP).collect():
        groups.setdefault(r.lang, []).append((r.distance, r.inverse / r.n, r.n))
    middle = bins.groupBy("lang").agg(((quantile(0.5) + 0.5) * BIN).alias("middle")).collect()
    return {r.lang: (r.middle, *spread(groups[r.lang])) for r in middle if r.lang in groups}


def inside(found: dict[str, tuple[float, float, float]], lang: Column, log_perplexity: Column, size: Column, width: float) -> Column:
    """Whether a log perplexity lies within the band of its language; NULL without one."""
    out = F.lit(None).cast("boolean")
    for name, (middle, a, b) in found.items():
        reach = F.lit(width) * F.sqrt(F.lit(a) + F.lit(b) / size)
        out = F.when(lang == name, F.abs(log_perplexity - F.lit(middle)) <= reach).otherwise(out)
    return out


def rate(
    docs: DataFrame, text: str = "text", lang: str = "lang", keep: Sequence[str] | None = None, width: float = WIDTH
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with the counts, ``base_failed``, ``log_perplexity`` and ``kept``.

    A modified Kneser-Ney model of four bytes per language and half is counted over all documents with LEARN_WORDS words or more and
    few symbols; halves are made by a hash of the text, and a text is judged by the half it is not in. All documents are
    judged twice: a first model finds those that are much like the others, the second one, which decides, is counted
    over these, so that junk hardly tells the model what to expect. A document is kept unless
    the base rules reject it or its mean log perplexity per byte lies outside its language's band, above or below. A band is
    ``width`` standard deviations to either side of the median, where the deviation for a text's length comes from quartiles;
    so short texts have a wide band. NULL, empty and blank texts fail the base rules (log_perplexity NULL if there is no
    byte). A NULL language is a language ``und``. Where nothing was learned, or too few documents are alike in length, the base
    rules alone decide. Equal texts get equal answers.
    """
    spark = docs.sparkSession
    text_col = F.col(f"`{text}`")
    rows = docs.withColumns({
        "__text": text_col, "__lang": F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")),
        "__half": F.pmod(F.xxhash64(text_col), F.lit(2)).cast("int"),
    })
    plain = lambda: rows.select(F.col("__lang").alias("lang"), F.col("__half").alias("half"), F.col("__text").alias("text"))
    own, models, whole = learned(_count(plain()))
    rows = rows.withColumn("__lang", F.when(F.col("__lang").isin(own), F.col("__lang")).otherwise(F.lit(OTHERS)))
    model = spark.sparkContext.broadcast(models)
    scores = plain().withColumns({"id": F.monotonically_increasing_id(), "s": _scored(model)("text", "lang", "half")})
    waits = F.when(F.size("s.asked") > 0, F.col("text")).alias("text")
    scores = staged(scores.select("id", "lang", "half", F.octet_length("text").cast("long").alias("n_grams"), "s.*", waits), "scores")
    if whole is not None:
        scores = staged(gram_tables.completed(scores, whole), "scores")
    mean = F.when(F.col("n_grams") > 0, -F.col("log_sum") / F.col("n_grams"))
    scores = scores.withColumns({"log_perplexity": mean, "base_failed": F.lit(False)})
    found = bands(scores)
    counted = _count(plain(), spark.sparkContext.broadcast((models, found)))
    if whole is not None:
        # These the tasks could not judge by what they hold.
        near = F.coalesce(inside(found, F.col("lang"), F.col("log_perplexity"), F.col("n_grams"), LEARN_WIDTH), F.lit(True))
        counted = counted.unionByName(_count(scores.filter(F.col("text").isNotNull() & F.col("lang").isin(list(found)) & near).select("lang", "half", "text")))
    _, models, whole = learned(counted, own)
    model = spark.sparkContext.broadcast(models)
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in NAMES]
    measured = rows.withColumns({"__id": F.monotonically_increasing_id(), "__m": _measured(model)(F.col("__text"), F.col("__lang"), F.col("__half"))})
    measured = staged(measured.select(*[F.col(f"`{c}`") for c in kept], "__lang", "__id", "__m"), "measured")
    if whole is not None:
        asking = measured.select(F.col("__id").alias("id"), F.col("__m.log_sum").alias("log_sum"), F.col("__m.model").alias("model"), F.col("__m.asked").alias("asked"))
        told = gram_tables.completed(asking.filter(F.size("asked") > 0), whole).select(F.col("id").alias("__id"), F.col("log_sum").alias("__told"))
        known = measured.filter(F.coalesce(F.size("__m.asked"), F.lit(0)) <= 0).withColumn("__told", F.col("__m.log_sum"))
        measured = staged(known.unionByName(measured.filter(F.size("__m.asked") > 0).join(told, "__id")), "told")
        measured = measured.withColumn("__m", F.col("__m").withField("log_sum", F.col("__told")))
    failed = (F.col("__m.n_words") < LEAST_WORDS) | (100 * F.col("__m.n_repeat_words") > MOST_REPEATED * F.col("__m.n_words"))
    mean = F.when(F.col("__m.n_grams") > 0, -F.col("__m.log_sum") / F.col("__m.n_grams"))
    measured = without(measured, NAMES).withColumns({"log_perplexity": mean, "base_failed": failed})
    found = bands(measured.select(F.col("__lang").alias("lang"), "log_perplexity", F.col("__m.n_grams").alias("n_grams"), "base_failed"))
    sound = F.coalesce(inside(found, F.col("__lang"), F.col("log_perplexity"), F.col("__m.n_grams"), width), F.lit(True))
    return measured.withColumn("kept", ~F.col("base_failed") & sound).select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"__m.{n}") for n in NAMES[:5]], *NAMES[5:]
    )
