"""Language identification: per-language piece probabilities, summed over all segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_n_per_key
from .columns import held_out, without
from .lattice import Lattice, read_vocabulary
from .tasks import utf8, words

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Documents per language that the model is fitted on: those with the least hash of their id.
SAMPLE = 500
ROUNDS = 2
FOLDS, FOLD = 5, 0
UNKNOWN = "und"
#: Words whose scores a task remembers, and words that it scores at a time.
CACHE, CHUNK = 200_000, 400_000
_ASCII = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return _ASCII.search(text) is not None or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _counted(batches):
    """(lang, word, n) of the sampled texts."""
    for batch in batches:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            found.setdefault(lang, Counter()).update(words(text))
        for lang, count in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(count)), pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())],
                names=["lang", "word", "n"],
            )


def fit(
    docs: DataFrame, lang: str = "lang", key: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, sample: int = SAMPLE, rounds: int = ROUNDS,
) -> tuple[list[str], np.ndarray, list[bytes]]:
    """Languages, log probabilities (pieces x languages) and pieces, fitted on ``sample`` texts per language.

    Expectation maximisation: words are counted per language, every round sums the expected uses of each piece over
    all segmentations in Spark tasks, and the driver gets one number per piece and language.
    """
    spark = docs.sparkSession
    pieces, prior = read_vocabulary(vocabulary)
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter("lang is not null")
    ids = top_n_per_key(
        rows.filter("id is not null").select("lang", "id").withColumn("h", F.xxhash64("id")), ["lang"], ["h", "id"], sample, ["id"], 16
    )
    # At most ``sample`` ids per language.
    taken = rows.join(F.broadcast(ids.select("lang", "id")), ["lang", "id"], "left_semi").select("lang", "text")
    counts = taken.mapInArrow(_counted, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    logp = np.tile(np.log(prior)[:, None], (1, len(langs)))
    try:
        for _ in range(rounds if langs else 0):
            model = spark.sparkContext.broadcast((pieces, langs, logp))

            def used(batches, model=model):
                pieces, langs, logp = model.value
                lattice = Lattice(pieces)
                sums: dict[str, np.ndarray] = {}
                for batch in batches:
                    lang = np.array(batch.column(0).to_pylist(), object)
                    word, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                    for one in set(lang):
                        own = np.nonzero(lang == one)[0]
                        got = lattice.expected([word[i] for i in own], n[own], logp[:, langs.index(one)])
                        sums[one] = sums.get(one, 0) + got
                for one, got in sums.items():
                    at = np.nonzero(got)[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([one] * len(at)), pa.array(at, pa.int64()), pa.array(got[at])], names=["lang", "piece", "n"]
                    )

            got = counts.mapInArrow(used, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
            total = np.zeros_like(logp)
            for r in got.collect():
                total[r.piece, langs.index(r.lang)] = r.n
            share = total.sum(0) * 0.01 + 1
            logp = np.log((total + share * prior[:, None]) / (total.sum(0) + share))
    finally:
        counts.unpersist()
    return langs, logp, pieces


def predict(text: Column, langs: list[str], logp: np.ndarray, pieces: list[bytes], spark) -> Column:
    """struct(lang_pred, score): the language that gives the whole text the highest probability, and its share of
    the sum over languages."""
    model = spark.sparkContext.broadcast((pieces, langs, logp))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, langs, logp = model.value
        lattice = Lattice(pieces)
        known: dict[bytes, int] = {}
        table = np.zeros((0, len(langs)))
        for texts in batches:
            names: list[str] = []
            scores: list[float] = []
            all_texts = utf8(texts)
            at = 0
            while at < len(all_texts):
                part, size = [], 0
                while at < len(all_texts) and (not part or size < CHUNK):
                    part.append(words(all_texts[at]) if langs and has_letter(all_texts[at]) else [])
                    size += len(part[-1])
                    at += 1
                new = list({w for doc in part for w in doc if w not in known})
                if len(known) + len(new) > CACHE and known:
                    known, table, new = {}, table[:0], list({w for doc in part for w in doc})
                if new:
                    table = np.concatenate([table, lattice.log_marginals(new, logp)])
                    known.update(zip(new, range(len(known), len(table)), strict=True))
                for doc in part:
                    if not doc:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    sums = table[np.fromiter(map(known.__getitem__, doc), np.int64, len(doc))].sum(0)
                    best = int(sums.argmax())
                    names.append(langs[best])
                    scores.append(float(1 / np.exp(sums - sums[best]).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return guess.asNondeterministic()(text)


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY,
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score`` (0 to 1).

    Learns from rows with a language whose crc32 of the id, modulo 5, is not 0; predicts from nothing but the
    text. Texts that are NULL or have no letter, and all texts if there is nothing to learn from, get ``und`` and 0.
    Equal texts get equal answers. The number of languages decides the size of the model (pieces x languages).
    """
    out = held_out(key, FOLDS, FOLD)
    langs, logp, pieces = fit(docs.filter(~out), lang, key, text, vocabulary, sample)
    rows = docs.withColumns({"__out": out, "__guess": predict(F.col(f"`{text}`"), langs, logp, pieces, docs.sparkSession)})
    return without(rows, ["held_out", "lang_pred", "score"]).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("held_out", "lang_pred", "score")],
        F.col("__out").alias("held_out"), F.col("__guess.lang_pred").alias("lang_pred"), F.col("__guess.score").alias("score"),
    )
