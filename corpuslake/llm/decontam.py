"""Benchmark decontamination: every passage is a BM25 query against an index of the test items, hits are verified."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .columns import without
from .components import staged
from .tasks import utf8

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach to be retrieved.
THRESHOLD = 0.6
#: Share of an item's score that its least telling terms may make up; they take no part in opening blocks.
TRIM = 0.4
#: Words per shingle, share of an item's shingles, and of each of its halves, that a passage must have.
SHINGLE, OVERLAP, HALF = 5, 0.8, 0.5
#: Items per block of the index; a block is opened only if its greatest impacts could reach the threshold.
BLOCK = 16
#: Bytes of items that are searched in one pass; further items take further passes.
MOST_BYTES = 32_000_000
CHUNK = 200_000
_MARKS = b".,;:!?\"'()"


def tokens(text: bytes) -> list[bytes]:
    return text.lower().translate(None, _MARKS).split()


class Index:
    """Impacts of terms on items, as shares of each item's greatest possible score, with maxima per block of items."""

    def __init__(self, items: Sequence[tuple[int, bytes]]) -> None:
        spelled = [(place, i, tokens(t or b"")) for place, (i, t) in enumerate(items)]
        texts = [(i, t) for _, i, t in spelled if len(t) >= SHINGLE]
        # Items too short for a shingle are looked for as whole lines; their numbers follow those of the others.
        short = [(place, i, t) for place, i, t in spelled if 0 < len(t) < SHINGLE]
        self.short: dict[tuple[bytes, ...], list[int]] = {}
        for k, (_, _, t) in enumerate(short, len(texts)):
            self.short.setdefault(tuple(t), []).append(k)
        self.ids = [i for i, _ in texts] + [i for _, i, _ in short]
        self.places = [place for place, _, t in spelled if len(t) >= SHINGLE] + [place for place, _, _ in short]
        self.words = [t for _, t in texts]
        self.longest = max(map(len, self.words), default=1)
        mean = sum(map(len, self.words)) / max(1, len(self.words))
        df = Counter(w for t in self.words for w in set(t))
        self.terms = {w: k for k, w in enumerate(df)}
        idf = {w: np.log(1 + (len(texts) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
        term, item, impact = [], [], []
        for k, t in enumerate(self.words):
            own = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(t) / mean)) for w, n in Counter(t).items()}
            whole = sum(own.values())
            for w, x in own.items():
                term.append(self.terms[w])
                item.append(k)
                impact.append(x / whole)
        order = np.lexsort((item, term))
        term, item, impact = np.array(term, np.int64)[order], np.array(item, np.int64)[order], np.array(impact)[order]
        names = list(self.terms)
        self.blocks = -(-len(texts) // BLOCK)
        self.postings: list[dict[bytes, list[tuple[int, float]]]] = [{} for _ in range(self.blocks)]
        for t, i, x in zip(term.tolist(), item.tolist(), impact.tolist(), strict=True):
            self.postings[i // BLOCK].setdefault(names[t], []).append((i, x))
        # The terms of an item but for its least ones, whose sum stays within TRIM: common words hardly remain. What
        # reaches the threshold reaches it less TRIM by the others.
        by_item = np.lexsort((impact, item))
        sums = np.cumsum(impact[by_item])
        first = np.searchsorted(item[by_item], np.arange(len(texts)))
        before = np.concatenate([[0.0], sums])[first]
        telling = np.zeros(len(term), bool)
        telling[by_item] = sums - before[item[by_item]] > TRIM
        kept = np.unique(term[telling])
        self.telling = {names[t]: k for k, t in enumerate(kept)}
        own, block, impact = np.searchsorted(kept, term[telling]), item[telling] // BLOCK, impact[telling]
        key = own * max(1, self.blocks) + block
        first = np.nonzero(np.diff(key, prepend=-1))[0]
        self.block = block[first]
        self.block_max = np.maximum.reduceat(impact, first) if len(first) else np.zeros(0)
        self.block_start = np.searchsorted(own[first], np.arange(len(kept) + 1))

    def short_items(self, text: bytes) -> Iterator[int]:
        """Items under SHINGLE words that make up a line of the text."""
        if self.short:
            for line in text.split(b"\n"):
                yield from self.short.get(tuple(tokens(line)), ())

    def verified(self, item: int, passage: list[bytes]) -> float:
        """Share of the item's shingles in the passage, 0 if it or one of the item's halves falls short."""
        grams = lambda t: zip(*(t[i:] for i in range(SHINGLE)), strict=False)
        there = set(grams(passage))
        found = np.fromiter((g in there for g in grams(self.words[item])), bool)
        middle = (len(found) + 1) // 2
        question, answer = found[:middle], found[middle:]
        whole = float(found.mean())
        if whole < OVERLAP or question.mean() < HALF or (len(answer) and answer.mean() < HALF):
            return 0.0
        return whole

    def search(self, docs: list[list[bytes]]) -> Iterator[tuple[int, int, float, float]]:
        """(document, item, score, overlap) of all verified items. Passages are as long as two items and overlap by half."""
        if not self.words:
            return
        size = self.longest
        counts = np.fromiter(map(len, docs), np.int64, len(docs))
        per_doc = -(-counts // size)
        base = np.concatenate([[0], np.cumsum(per_doc)])
        windows = int(base[-1])
        term = np.fromiter(map(self.telling.get, chain.from_iterable(docs), repeat(-1)), np.int64, int(counts.sum()))
        doc = np.repeat(np.arange(len(docs)), counts)
        place = np.arange(len(term)) - np.repeat(np.cumsum(counts) - counts, counts)
        known = term >= 0
        term, doc, own = term[known], doc[known], place[known] // size
        window = base[doc] + own
        before = own > 0
        pair = np.unique(np.concatenate([window, window[before] - 1]) * len(self.telling) + np.concatenate([term, term[before]]))
        for row, block in self._opened(pair // len(self.telling), pair % len(self.telling), windows):
            which = int(np.searchsorted(base, row, "right")) - 1
            begin = (row - int(base[which])) * size
            passage = docs[which][begin : begin + 2 * size]
            for item, score in self._scored(passage, block):
                overlap = self.verified(item, passage)
                if overlap:
                    yield which, item, score, overlap

    def _opened(self, window: np.ndarray, term: np.ndarray, windows: int) -> Iterator[tuple[int, int]]:
        """(window, block) whose summed block maxima reach the threshold less what has been trimmed."""
        start = self.block_start
        count = start[term + 1] - start[term]
        at = np.repeat(start[term] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        row = np.repeat(window, count)
        step = max(1, (1 << 23) // self.blocks)
        for low in range(0, windows, step):
            own = slice(*np.searchsorted(row, [low, low + step]))
            sums = np.bincount((row[own] - low) * self.blocks + self.block[at[own]], self.block_max[at[own]])
            for x in np.nonzero(sums >= THRESHOLD - TRIM - 1e-9)[0].tolist():
                yield low + x // self.blocks, x % self.blocks

    def _scored(self, passage: list[bytes], block: int) -> list[tuple[int, float]]:
        """Items of the block that reach the threshold, with their scores."""
        sums: dict[int, float] = {}
        postings = self.postings[block]
        for w in postings.keys() & set(passage):
            for item, impact in postings[w]:
                sums[item] = sums.get(item, 0.0) + impact
        return [(i, s) for i, s in sorted(sums.items()) if s >= THRESHOLD - 1e-9]


HITS = ArrayType(StructType([StructField("item_id", LongType()), StructField("score", DoubleType()), StructField("overlap", DoubleType())]))


def _searcher(items):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("overlap", pa.float64())]))

    @F.arrow_udf(HITS)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(items.value)
        for texts in batches:
            found: list[dict[int, tuple[float, float]]] = []
            part: list[list[bytes]] = []
            size = 0
            whole: list[dict[int, tuple[float, float]]] = []
            for text in [*utf8(texts), None]:
                if text is None or size > CHUNK:
                    first = len(found)
                    found += whole
                    whole = []
                    for doc, item, score, overlap in index.search(part):
                        own = found[first + doc]
                        own[item] = max(own.get(item, (0.0, 0.0)), (overlap, score))
                    part, size = [], 0
                if text is not None:
                    whole.append(dict.fromkeys(index.short_items(text), (1.0, 1.0)))
                    part.append(tokens(text))
                    size += len(part[-1])
            yield pa.array(
                [[{"item_id": index.ids[i], "score": s, "overlap": o} for i, (o, s) in sorted(f.items(), key=lambda x: index.places[x[0]])] for f in found],
                kind,
            )

    return search.asNondeterministic()


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``leaks``: array of (item_id, score, overlap), the test items found in the whole text.

    All passages of all documents are queries; retrieved are all items of which a passage has THRESHOLD of the BM25
    score that the item's own text would have, found block by block of the index where the summed maxima of a block
    allow it. An item is a leak if a passage holds OVERLAP of its five-word shingles and HALF of those of either
    half (question, answer). Case and punctuation are ignored. Items under five words are leaks where they make up a line of
    the document; items without words, or NULL, are not looked for.
    The items are read by the driver, MOST_BYTES at a time; each such part is a pass over the documents.
    """
    rows = items.select(F.col(f"`{item}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("text")).filter("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // MOST_BYTES))
    out = without(docs, ["leaks"]).withColumn("leaks", F.from_json(F.lit("[]"), HITS))
    for n in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == n).orderBy("id", "text").collect()
        shared = docs.sparkSession.sparkContext.broadcast([(r.id, r.text.encode()) for r in own])
        out = out.withColumn("__more", _searcher(shared)(F.col(f"`{text}`"))).withColumn("leaks", F.concat("leaks", "__more")).drop("__more")
        if n + 1 < parts:
            out = staged(out, "leaks")
    return out
