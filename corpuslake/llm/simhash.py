"""SimHash near-duplicates: fingerprints, links by Golay keys, groups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import first_per_key
from . import golay
from .components import components, staged
from .tasks import utf8, words

SHINGLE = 3
SEED = 42
BITS = 2
#: Segments of a fingerprint, from the low bits: (first bit, width).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Above so many fingerprints under one key, its fingerprints are linked through common neighbours instead of pairs.
CROWD = 256
_PIECE = 1 << 15


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the hashes of the word shingles; 0 without words."""
    w = words(text)
    if not w:
        return 0
    if len(w) < shingle:
        parts = [b" ".join(w)]
    else:
        parts = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PIECE):
        bits = np.unpackbits(hashes[at : at + _PIECE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of the whole text as a signed long."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for t in utf8(texts)], pa.int64())

    return prints.asNondeterministic()(text)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs. Two prints that differ in at most two bits agree in one whole segment, and in the segment
    after it they share a nearby codeword; the key holds both, 33 or 34 bits."""
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for clean in range(3):
        other = (clean + 1) % 3
        index = golay.nearby(parts[other], SEGMENTS[other][1])
        row, column = np.nonzero(index >= 0)
        rows.append(row)
        keys.append((clean << 40) | (parts[clean][row] << 12) | index[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 1 << 14):
            part = prints[at : at + (1 << 14)]
            rows, keys = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fp"])


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that differ in at most two bits.

    Fingerprints meet under their keys and are verified there. The links connect exactly what is connected by
    all such pairs: a key with more than ``crowd`` fingerprints is not paired out; its fingerprints meet under
    each fingerprint one bit away from them, where all, at most 65, are within two bits of one another.
    """
    keyed = staged(prints.select("fp").mapInArrow(_keyed, "key long, fp long"), "keys")
    crowded = keyed.groupBy("key").count().filter(F.col("count") > crowd).select("key")
    rest = keyed.join(crowded, "key", "left_anti")
    left = rest.withColumnRenamed("fp", "a")
    right = rest.select(F.col("key").alias("key_b"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    pairs = left.join(right, (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & near).select("a", "b")
    dense = keyed.join(crowded, "key", "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    balls = dense.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("centre"))
    stars = balls.groupBy("centre").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b")
    return pairs.unionByName(stars).distinct()


def groups(seen: DataFrame) -> DataFrame:
    """(fp, component_id, group_print) of the distinct fingerprints in ``seen`` (key, fp)."""
    nodes = staged(seen.groupBy("fp").agg(F.min("key").alias("least")), "nodes")
    rooted = nodes.join(components(links(nodes)).withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id", F.col("root").alias("group_print"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, keep: Sequence[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them by default) with ``fingerprint`` (long), ``component_id``
    (smallest key of the group) and ``group_print`` (the group's smallest fingerprint).

    Texts whose fingerprints differ in at most two bits are linked, groups are what is connected. Equal
    fingerprints are one node whatever their number. NULL, empty and blank texts have fingerprint 0 and so are
    one group, with whatever else comes near 0. A group whose keys are all NULL has a NULL ``component_id``.
    """
    names = ["fingerprint", "component_id", "group_print"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    rows = docs.withColumn("__fp", fingerprint(F.col(f"`{text}`"), shingle))
    # Texts are read and hashed once, here; everything below works on what this table has.
    rows = staged(rows.select(*[F.col(f"`{c}`") for c in kept], "__fp"), "prints")
    found = groups(rows.select(F.col(f"`{key}`").alias("key"), F.col("__fp").alias("fp")))
    return rows.join(found, F.col("__fp") == F.col("fp")).drop("fp").withColumnRenamed("__fp", "fingerprint")


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group: its smallest key, of rows with that key one that is least by a hash of the text."""
    found = near_duplicates(docs, key, text, shingle)
    found = found.filter(F.col(f"`{key}`").eqNullSafe(F.col("component_id")))
    one = first_per_key(found, ["group_print"], [F.xxhash64(f"`{text}`")])
    return one.select(*[F.col(f"`{c}`") for c in docs.columns])
