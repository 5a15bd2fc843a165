"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source the keys are cut into ranges, the
token counts of the ranges are summed, and each document learns how many tokens lie before
it: the sum of the ranges before its own plus those before it in its range. The source's
budget is cut exactly there; a budget above the source's size first takes whole epochs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import boxed, numbered, unboxed

#: Words are runs of what is not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in a key range, on average. Keys are uniform, so no range is much larger.
RANGE_DOCS = 4096
#: Bits of the key that may tell ranges apart: up to 16 million ranges a source.
KEY_BITS = 24
#: The leading bits of a key as a number.
LEAD = f"cast(conv(substring(key, 1, {KEY_BITS // 4}), 16, 10) as int)"


def word_count(text: Column) -> Column:
    """Number of words; a NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def water_level(sources: DataFrame, total: float) -> float:
    """Level L at which the sum of min(cap, L * weight) is ``total``.

    Sources above their cap stop there and the rest is shared again by weight, until none
    is above. Each round is one aggregate over the sources; rounds are few, as every round
    stops all sources that the level before has flooded.
    """
    level = None
    while True:
        stopped = F.lit(False) if level is None else F.col("cap") <= F.lit(level) * F.col("weight")
        row = sources.agg(F.coalesce(F.sum(F.when(stopped, F.col("cap"))), F.lit(0.0)).alias("stopped"),
                          F.sum(F.when(~stopped, F.col("weight"))).alias("weight")).first()
        if not row.weight:
            return level or 0.0
        higher = (total - row.stopped) / row.weight
        if level is not None and higher <= level:
            return level
        level = higher


def source_targets(sized: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """One row per source: ``source``, ``docs``, ``source_size``, ``target``.

    ``sized`` has ``source`` and ``size``. Weights repeat over the sources in code point
    order, NULL last. Targets share ``share`` times all sizes, at most ``most`` times the
    size of a source.
    """
    sources = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_number") % len(weights) + 1).cast("int"))
    sources = materialize(
        numbered(sources, order).select("source", "docs", "source_size", weight.alias("weight"),
                                        (F.col("source_size") * float(most)).alias("cap")), "mix-sources")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, total)
    return sources.select("source", "docs", "source_size",
                          F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, size: Column, weights: list[float], share: float = 1.5, most: float = 2.0,
        source: str = "source", doc_id: str = "doc_id", seed: str = "mix") -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` is the number of tokens the mix takes from the row, repeats counted: whole
    epochs, then documents in key order up to the exact budget, so that the last one may
    be taken in part. With ``most`` at 2 nothing is taken more than twice over.

    NULL sources are a source of their own; a NULL or empty text has size 0 and nothing
    taken; NULL ids and repeated rows are rows as any other (equal rows are
    interchangeable); an empty table gives no rows. Columns of the input that are called
    like an added one are replaced.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    rows = boxed(docs, source=F.col(source), size=size, key=key, id=F.col(doc_id))
    targets = source_targets(rows, weights, share, most)
    bits = F.least(F.lit(KEY_BITS), F.ceil(F.log2(F.greatest(F.col("docs") / RANGE_DOCS, F.lit(1.0))))).cast("int")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long")
    targets = targets.select(F.col("source").alias("of"), "source_size", "target", bits.alias("bits"),
                             epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"))
    ranged = (rows.join(targets, F.col("source").eqNullSafe(F.col("of")))
              .withColumn("range", F.expr(f"shiftright({LEAD}, {KEY_BITS} - bits)")))
    sums = ranged.groupBy("of", "range").agg(F.sum("size").alias("in_range"))
    earlier = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(sums.select(F.col("of").alias("sum_of"), F.col("range").alias("sum_range"),
                                   F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("before")), "mix-ranges")
    within = (Window.partitionBy("of", "range").orderBy("key", "id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = ranged.withColumn("until", F.sum("size").over(within))
    placed = placed.join(sums, F.col("of").eqNullSafe(F.col("sum_of")) & (F.col("range") == F.col("sum_range")))
    start = F.col("before") + F.col("until") - F.col("size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    return unboxed(placed, docs.columns, {
        "size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
        "taken": (F.col("epochs") * F.col("size") + last).cast("long")})

