"""The model of ``ngrams`` as tables: every probability of it, whatever their number, made and asked by joins."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ngrams
from .components import staged

#: Logs are summed as whole numbers of 2 ** -SCALE, so that their order does not tell.
SCALE = 32


class Tables(NamedTuple):
    """Of all models, from order 1 up: (model, gram, n, log_p), and what contexts set aside, (model, context, log_w)."""

    grams: list[DataFrame]
    weights: list[DataFrame]


def _last(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 8 * order) - 1))


def _context(gram: Column) -> Column:
    return F.call_function("shiftright", gram, F.lit(8))


def tables(counts: DataFrame) -> Tables:
    """Tables of the models with the given counts of grams of ORDER bytes (model, gram, n). Four counts of counts per model and
    order come to the driver."""
    counted = [counts.select("model", "gram", "n")]
    for order in range(ngrams.ORDER - 1, 0, -1):
        lower = counted[0].groupBy("model", _last(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        counted.insert(0, staged(lower, "lower"))
    grams: list[DataFrame] = []
    weights: list[DataFrame] = []
    for order, rows in enumerate(counted, 1):
        of: dict[int, list[int]] = {}
        for r in rows.filter("n <= 4").groupBy("model", "n").agg(F.count(F.lit(1)).alias("c")).collect():
            of.setdefault(r.model, [0] * 4)[r.n - 1] = r.c
        take = F.lit(None).cast("double")
        for model in {r.model for r in rows.select("model").distinct().collect()}:
            off = F.array(*[F.lit(float(d)) for d in ngrams.discounts(of.get(model, [0] * 4))])
            take = F.when(F.col("model") == model, F.get(off, F.least("n", F.lit(3)).cast("int"))).otherwise(take)
        rows = rows.withColumns({"context": _context(F.col("gram")) if order > 1 else F.lit(0).cast("long"), "take": take})
        weight = staged(rows.groupBy("model", "context").agg(F.sum("n").alias("whole"), (F.sum("take") / F.sum("n")).alias("aside")), "weights")
        rows = rows.join(weight, ["model", "context"])
        if order > 1:
            below = grams[-1].select("model", F.col("gram").alias("lower"), F.exp("log_p").alias("below"))
            rows = rows.withColumn("lower", _last(F.col("gram"), order - 1)).join(below, ["model", "lower"])
        else:
            rows = rows.withColumn("below", F.lit(1 / 256))
        p = (F.col("n") - F.col("take")) / F.col("whole") + F.col("aside") * F.col("below")
        grams.append(staged(rows.select("model", "gram", "n", F.log(p).alias("log_p")), "log_p"))
        weights.append(weight.select("model", "context", F.log(F.greatest("aside", F.lit(1e-12))).alias("log_w")))
    return Tables(grams, weights)


def log_probs(asked: DataFrame, found: Tables) -> DataFrame:
    """(model, gram, log_p) for the rows (model, gram): the longest gram that is there, and what the contexts of longer ones set aside."""
    out, value = asked, F.lit(-math.log(256))
    for order, (grams, weights) in enumerate(zip(*found, strict=True), 1):
        own = _last(F.col("gram"), order)
        out = out.withColumns({f"g{order}": own, f"c{order}": _context(own) if order > 1 else F.lit(0).cast("long")})
        out = out.join(grams.select("model", F.col("gram").alias(f"g{order}"), F.col("log_p").alias(f"p{order}")), ["model", f"g{order}"], "left")
        out = out.join(weights.select("model", F.col("context").alias(f"c{order}"), F.col("log_w").alias(f"w{order}")), ["model", f"c{order}"], "left")
        value = F.coalesce(F.col(f"p{order}"), F.coalesce(F.col(f"w{order}"), F.lit(0.0)) + value)
    return out.select("model", "gram", value.alias("log_p"))


def completed(rows: DataFrame, found: Tables) -> DataFrame:
    """``rows`` (id, log_sum, model, asked, ...) with the log probabilities of the grams ``asked`` (gram, n) added to ``log_sum``.

    Only rows that ask are moved. A gram is looked up once, however many rows ask for it; ids are different.
    """
    asks = F.col("asked").isNotNull() & (F.size("asked") > 0)
    each = rows.filter(asks).select("id", "model", F.explode("asked").alias("at")).select("id", "model", "at.gram", "at.n")
    known = staged(log_probs(each.select("model", "gram").distinct(), found), "asked")
    scaled = F.round(F.col("log_p") * float(1 << SCALE)).cast("long") * F.col("n")
    sums = each.join(known, ["model", "gram"]).groupBy("id").agg((F.sum(scaled) / float(1 << SCALE)).alias("rest"))
    told = rows.filter(asks).join(sums, "id").withColumn("log_sum", F.col("log_sum") + F.col("rest"))
    return rows.filter(~asks).unionByName(told.select(*rows.columns))
