"""Hard negatives: neighbours of another label that are close, but not too close, found through bounds from segment summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import first_per_key, top_n_per_key
from .components import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 50, 95
#: Segments whose mean and deviation are stored; bounds are refined over 1, 2, 4 and so on of them.
SEGMENTS = 16
#: Anchors and rows of a block at most, on the average, and rows of a block at least; what a task holds at a time.
BLOCK, LEAST_BLOCK = 32_768, 1024
TILE_ANCHORS, TILE_ROWS = 128, 8192
#: Entries are at most this large, so that inner products are exact.
LARGEST = float(1 << 24)
#: Share of a tile's pairs up to which they are looked at one by one.
SPARSE = 1 / 16
NONE = np.iinfo(np.int64).min


def edges(size: int) -> np.ndarray:
    """Where the finest segments of a vector begin and end."""
    return np.arange(SEGMENTS + 1) * size // SEGMENTS


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and root of the summed squared deviations, of each finest segment of each row."""
    at = edges(x.shape[1])
    mean, dev = np.zeros((len(x), SEGMENTS)), np.zeros((len(x), SEGMENTS))
    for k in range(SEGMENTS):
        part = x[:, at[k] : at[k + 1]]
        if part.shape[1]:
            mean[:, k] = part.mean(1)
            dev[:, k] = np.sqrt(((part - mean[:, k : k + 1]) ** 2).sum(1))
    return mean, dev


def coarser(mean: np.ndarray, dev: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summaries of segments joined two by two, from their own summaries."""
    both = length.reshape(-1, 2)
    whole = both.sum(1)
    pairs = mean.reshape(len(mean), -1, 2)
    joint = (pairs * both).sum(2) / np.maximum(whole, 1)
    square = (dev.reshape(pairs.shape) ** 2 + both * (pairs - joint[:, :, None]) ** 2).sum(2)
    return joint, np.sqrt(square), whole


class Side:
    """Vectors of one side of a block with their summaries at every level, coarsest first."""

    def __init__(self, x: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> None:
        self.x = x
        levels = [(mean, dev, np.diff(edges(x.shape[1])).astype(float))]
        while levels[-1][0].shape[1] > 1:
            levels.append(coarser(*levels[-1]))
        # The mean's part is a plain product if each side carries the root of the length.
        self.levels = [(m * np.sqrt(n), d) for m, d, n in reversed(levels)]

    def part(self, at: slice) -> Side:
        out = Side.__new__(Side)
        out.x, out.levels = self.x[at], [(m[at], d[at]) for m, d in self.levels]
        return out


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, the least there is where a row has fewer."""
    width = values.shape[1]
    if width < k:
        return np.full(len(values), NONE if values.dtype == np.int64 else -np.inf)
    return np.partition(values, width - k, axis=1)[:, width - k]


def refined(
    anchors: Side, others: Side, alive: np.ndarray, least: np.ndarray, most: np.ndarray, k: int = 0
) -> np.ndarray:
    """Exact scores (anchors x rows) of the pairs in ``alive`` that may lie between the anchor's ``least`` and ``most``; NONE elsewhere.

    Over a segment the product is length times the means' product, give or take the product of the deviations. Each level of
    bounds looks at what the level before has left; last come the exact scores. With ``k``, what ``k`` rows of an anchor are sure
    to reach is asked of all.
    """
    at = None  # pairs one by one, once few are left
    for (ma, da), (mb, db) in zip(anchors.levels, others.levels, strict=True):
        if at is None:
            middle, reach = ma @ mb.T, da @ db.T
        else:
            middle, reach = _pairwise(ma, mb, *at), _pairwise(da, db, *at)
        reach += 1e-9 * (np.abs(middle) + reach) + 0.5  # for rounding; scores are whole numbers
        if at is not None:
            i, j = at
            kept = (middle + reach >= least[i]) & (middle - reach <= most[i])
            at = i[kept], j[kept]
            continue
        if k:
            least = np.maximum(least, kth_largest(np.where(alive, middle - reach, -np.inf), k))
        alive = alive & (middle + reach >= least[:, None]) & (middle - reach <= most[:, None])
        if np.count_nonzero(alive) <= SPARSE * alive.size:
            at = np.nonzero(alive)
    a, b = anchors.x, others.x
    kind = float if a.shape[1] * _largest(a) * _largest(b) < 2.0**53 else np.int64
    a, b = a.astype(kind, copy=False), b.astype(kind, copy=False)
    if at is None:
        return np.where(alive, (a @ b.T).astype(np.int64), NONE)
    out = np.full(alive.shape, NONE)
    out[at] = _pairwise(a, b, *at).astype(np.int64)
    return out


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x).max(initial=0))


def _pairwise(a: np.ndarray, b: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.result_type(a, b))
    for at in range(0, len(rows), 1 << 15):
        own = slice(at, at + (1 << 15))
        out[own] = np.einsum("ij,ij->i", a[rows[own]], b[columns[own]])
    return out


class Best:
    """The first ``k`` of each group by falling score, then by rising id."""

    def __init__(self, groups: int, k: int) -> None:
        self.k, self.groups = k, groups
        self.group, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group, score, ids = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        kept = np.arange(len(group)) - np.searchsorted(group, group) < self.k
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]

    def add_rows(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (groups x ids), NONE where there is none. Only what reaches a row's k-th largest is sorted."""
        i, j = np.nonzero(scores >= np.maximum(kth_largest(scores, self.k), NONE + 1)[:, None])
        self.add(groups[i], scores[i, j], ids[j])

    def floor(self) -> np.ndarray:
        """What a score must reach in each group."""
        out = np.full(self.groups, -np.inf)
        count = np.bincount(self.group, minlength=self.groups)
        last = np.cumsum(count) - 1
        out[count >= self.k] = self.score[last[count >= self.k]]
        return out


def closest(ids_a: np.ndarray, a: Side, ids_b: np.ndarray, b: Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, score, id) of the first ``k`` other rows of each anchor."""
    best = Best(len(ids_a), k)
    for low in range(0, len(ids_a), TILE_ANCHORS):
        own = slice(low, low + TILE_ANCHORS)
        part, n = a.part(own), len(ids_a[own])
        tile = Best(n, k)
        for at in range(0, len(ids_b), TILE_ROWS):
            cols = slice(at, at + TILE_ROWS)
            others = ids_a[own][:, None] != ids_b[cols][None]
            scores = refined(part, b.part(cols), others, tile.floor(), np.full(n, np.inf), k)
            tile.add_rows(np.arange(n), scores, ids_b[cols])
        best.add(tile.group + low, tile.score, tile.id)
    return best.group, best.score, best.id


def between(
    a: Side, labels_a: np.ndarray, low: np.ndarray, high: np.ndarray, ids_b: np.ndarray, labels_b: np.ndarray, b: Side, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, range, score, id) of the first ``k`` rows of another label with a score in each of the anchor's ranges
    (``low`` to ``high``, anchors x ranges; none where low exceeds high)."""
    ranges = low.shape[1]
    best = Best(len(low) * ranges, k)
    for start in range(0, len(low), TILE_ANCHORS):
        own = slice(start, start + TILE_ANCHORS)
        part, lo, hi = a.part(own), low[own], high[own]
        n, some = len(lo), lo <= hi
        tile = Best(n * ranges, k)
        for at in range(0, len(ids_b), TILE_ROWS):
            cols = slice(at, at + TILE_ROWS)
            floor = np.where(some, np.maximum(lo, tile.floor().reshape(n, ranges)), np.inf)
            most = np.where(some, hi, -np.inf).max(1)
            scores = refined(part, b.part(cols), labels_a[own][:, None] != labels_b[cols][None], floor.min(1), most)
            for r in np.nonzero(some.any(0))[0]:
                inside = (scores >= floor[:, r, None]) & (scores <= hi[:, r, None])
                tile.add_rows(np.arange(n) * ranges + r, np.where(inside, scores, NONE), ids_b[cols])
        best.add(tile.group + start * ranges, tile.score, tile.id)
    return best.group // ranges, best.group % ranges, best.score, best.id


def _prepared(size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), float)
            count = np.asarray(pc.list_value_length(vectors).to_numpy(zero_copy_only=False), np.int64)
            x = np.zeros((len(count), size))
            row = np.repeat(np.arange(len(count)), count)
            x[row, np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)] = np.floor(flat * scale)
            mean, dev = summaries(x)
            lists = lambda v, kind: pa.FixedSizeListArray.from_arrays(pa.array(v.reshape(-1), kind), v.shape[1]).cast(pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("anchor"), lists(x.astype(np.int32), pa.int32()),
                 lists(mean, pa.float64()), lists(dev, pa.float64())],
                names=["id", "label", "anchor", "x", "mean", "dev"],
            )

    return run


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _side(table: pa.Table) -> Side:
    return Side(_matrix(table.column("x")).astype(float), _matrix(table.column("mean")), _matrix(table.column("dev")))


def _ids(table: pa.Table, name: str = "id") -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt out to blocks (g, h): each row meets each anchor in one block. ``blocks_a`` and ``blocks_b`` say
    how many blocks either side has."""
    place = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    left = anchors.withColumn("g", place(1, "blocks_a")).withColumn("h", every("blocks_b"))
    right = rows.withColumn("h", place(2, "blocks_b")).withColumn("g", every("blocks_a"))
    # Both come from one table; columns of the right side get an identity of their own.
    names = [c for c in right.columns if c not in ("blocks_a", "blocks_b")]
    return left.drop("blocks_a", "blocks_b"), right.select(*[F.col(c).alias(c) for c in names])


def _sized(rows: Column, anchors: Column) -> list[Column]:
    """Numbers of blocks: of BLOCK on either side, and of fewer rows where there are few, for the sake of more tasks."""
    own = F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(BLOCK), F.floor(rows / 64)))
    return [F.greatest(F.lit(1), F.ceil(anchors / BLOCK)).alias("blocks_a"), F.greatest(F.lit(1), F.ceil(rows / own)).alias("blocks_b")]


def mine(
    rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """Hard negatives: ``anchor_id``, ``positive_id``, ``rank`` (int, from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Entries become floor(scale * entry); a score is the inner product. The positives of a row for which ``anchor`` holds are
    the first ``positives`` other rows of its label by falling score, then by key. For each positive the first
    ``negatives`` rows of other labels are returned whose score is ``low`` to ``high`` hundredths of the positive's.

    Rows with a NULL key, label or vector, with an entry that is NULL or not finite, or with one beyond 2^24 once scaled (inner
    products would not be exact), take no part. Of several rows with one key, the least by label and vector does. Of
    vectors of unequal lengths the shorter ones count as filled up with zeros. Ties go by key. Empty tables, anchors
    without positives and positives without negatives give no rows.

    Rows and anchors are dealt out to blocks of bounded size, so that every anchor meets every row (of its label, then of
    any) in one block; a label of any size is cut into blocks. A block keeps a few rows per anchor, and only those meet.
    """
    valid = rows.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    sound = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < LARGEST))
    valid = valid.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    valid = first_per_key(valid, ["id"], ["label", "vector", "anchor"])
    size = valid.agg(F.max(F.size("vector"))).first()[0] or 1
    kind = valid.schema["label"].dataType.simpleString()
    form = f"id long, label {kind}, anchor boolean, x array<int>, mean array<double>, dev array<double>"
    table = staged(valid.mapInArrow(_prepared(size, scale), form), "vectors")

    of_label = table.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("m"))
    of_label = staged(of_label.filter("m > 0").select(F.col("label").alias("of"), *_sized(F.col("n"), F.col("m"))), "labels")
    same = table.join(of_label, F.col("label") == F.col("of")).drop("of")
    left, right = _blocks(same.drop("anchor"), same.filter("anchor").drop("anchor"))

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        ids_a, ids_b = _ids(a), _ids(b)
        if not len(ids_a) or not len(ids_b):
            return pa.table({n: pa.array([], pa.int64()) for n in ("anchor_id", "score", "id")})
        at, score, found = closest(ids_a, _side(a), ids_b, _side(b), positives)
        return pa.table({"anchor_id": ids_a[at], "score": score, "id": found})

    by = ["label", "g", "h"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(nearest, "anchor_id long, score long, id long")
    near = top_n_per_key(near, ["anchor_id"], [F.col("score").desc(), "id"], positives)
    # At most ``positives`` of an anchor.
    near = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("score", "id")), asc=False).alias("found"))
    near = staged(near.select("anchor_id", F.col("found.score").alias("scores"), F.col("found.id").alias("positives")), "positives")

    whole = table.agg(*_sized(F.count(F.lit(1)), F.count_if("anchor"))).first()
    dealt = lambda t: t.withColumns({n: F.lit(whole[n]).cast("long") for n in ("blocks_a", "blocks_b")})
    asked = table.filter("anchor").join(near, F.col("id") == F.col("anchor_id")).drop("anchor", "anchor_id")
    left, right = _blocks(dealt(table.drop("anchor")), dealt(asked))
    names = ["anchor_id", "positive_id", "positive_score", "negative_score", "negative_id"]

    def hard(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        ids_a, ids_b = _ids(a), _ids(b)
        codes = pa.concat_arrays([t.column("label").combine_chunks() for t in (a, b)]).dictionary_encode().indices.to_numpy()
        width = positives
        score, which = np.zeros((len(ids_a), width), np.int64), np.zeros((len(ids_a), width), np.int64)
        lo, hi = np.ones((len(ids_a), width)), np.zeros((len(ids_a), width))
        for i, (s, p) in enumerate(zip(a.column("scores").to_pylist(), a.column("positives").to_pylist(), strict=True)):
            score[i, : len(s)], which[i, : len(p)] = s, p
            lo[i, : len(s)] = [-(-low * x // 100) for x in s]
            hi[i, : len(s)] = [high * x // 100 for x in s]
        at, r, got, found = between(_side(a), codes[: len(a)], lo, hi, ids_b, codes[len(a) :], _side(b), negatives)
        return pa.table(dict(zip(names, (ids_a[at], which[at, r], score[at, r], got, found), strict=True)))

    found = left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(hard, ", ".join(f"{n} long" for n in names))
    order = [F.col("negative_score").desc(), F.col("negative_id")]
    found = top_n_per_key(found, ["anchor_id", "positive_id"], order, negatives)
    ranked = found.groupBy("anchor_id", "positive_id", "positive_score").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("negative_score")).alias("s"), F.col("negative_id").alias("i")))).alias("found")
    )
    return ranked.select("anchor_id", "positive_id", "positive_score", F.posexplode("found").alias("at", "one")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.i").alias("negative_id"),
        "positive_score", (-F.col("one.s")).alias("negative_score"),
    )
