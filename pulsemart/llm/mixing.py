"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight and a schedule: the weight's course over training
time, as line segments.  The integral of the schedule is the share of the
source's demand that is due by a time, so the inverse of that integral gives
the time at which a word of the source's stream is used.  Documents follow
each other in the stream in hash order; prefix sums over hash ranges give
their places, whatever the size of a source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.common import word_count


@dataclass(frozen=True)
class Schedule:
    """A source's mean weight, and the course of its weight as (time, relative weight) knots from time 0 to 1."""

    weight: float
    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))


#: Weights by the sources' order, repeating: the heaviest fades out, the lightest grows, the third peaks halfway.
CURRICULUM = (
    Schedule(3, ((0.0, 1.5), (1.0, 0.5))),
    Schedule(1, ((0.0, 0.5), (1.0, 1.5))),
    Schedule(2, ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5))),
)


def _time_of(share: Column, schedule: Schedule) -> Column:
    """Time by which the given share of the schedule's integral is due."""
    knots = schedule.knots
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    due, out = 0.0, F.lit(knots[-1][0])
    pieces = []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
        left = F.greatest(share * sum(areas) - due, F.lit(0.0))  # w0 x + (w1 - w0) x^2 / (2 (t1 - t0)) = left
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + left * (2 * (w1 - w0) / (t1 - t0)), F.lit(0.0)))
        due += area
        pieces.append((due / sum(areas), F.lit(t0) + left * 2 / F.greatest(root + w0, F.lit(1e-300))))
    for end, when in reversed(pieces):
        out = F.when(share <= end, when).otherwise(out)
    return out


def source_targets(
    sizes: DataFrame, schedules: Sequence[Schedule] = CURRICULUM, budget: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Target of each source: ``(missing, name, rank, source_size, target)`` from ``(missing, name, size)``.

    The budget (a share of all sizes) is dealt by weight; a source takes at most ``most`` times its size, and what
    is above is dealt again among the others, until none is above.  That is a common price per unit of weight, found
    by prefix sums over the sources in the order in which they fill up.
    """
    per = sizes.groupBy("missing", "name").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy("missing", "name")) - 1)
    weight = F.element_at(F.array(*(F.lit(float(s.weight)) for s in schedules)), (F.col("rank") % len(schedules) + 1).cast("int"))
    cap = F.col("source_size") * most
    fill = Window.orderBy("ratio", "rank")
    return (
        ranked.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("full", F.sum("cap").over(fill) - F.col("cap"))
        .withColumn("rest", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * budget)
        .withColumn("price", (F.col("total") - F.col("full")) / F.col("rest"))
        # the first source that does not fill up sets the price of all after it
        .withColumn("price", F.min(F.when(F.col("price") <= F.col("ratio"), F.struct("ratio", "rank", "price"))).over(Window.partitionBy())["price"])
        .withColumn("target", F.coalesce(F.least("cap", F.col("price") * F.col("weight")), F.col("cap")))
        .select("missing", "name", "rank", "source_size", "target")
    )


def mix(
    docs: DataFrame, schedules: Sequence[Schedule] = CURRICULUM, budget: float = 1.5, most: float = 2.0,
    cut: bool = True, size: Column | None = None,
) -> DataFrame:
    """The documents with what the mix takes of them.  Columns named ``mix_…`` belong to the operator.

    Adds ``mix_size`` (words; a missing text has none), ``mix_source_size``, ``mix_target`` and ``mix_copies``, an
    array of (copy, words, position): position is the training time of the copy's middle, in 0 to 1.  A source whose
    target is above its size is passed twice.  With ``cut`` the last copy of a source is cut so that its words meet
    the target; without, a copy is taken whole if its middle lies below the target.  Documents without words, and
    those beyond the target, have no copies.  A missing source is a source of its own, after all others.  Rows with
    equal ids follow each other by size; equal rows are told apart by none and taken in any order.  An empty table
    gives an empty result.  Reruns agree: the order is a hash of the id.
    """
    hashed = F.xxhash64("doc_id")
    base = docs.withColumns({
        "mix_size": word_count() if size is None else size, "mix_h": hashed,
        "mix_missing": F.col("source").isNull(), "mix_name": F.coalesce("source", F.lit("")),
    })
    ranges = max(1, math.isqrt(docs.count()))
    base = base.withColumn("mix_range", F.least(F.floor((F.col("mix_h") / 2.0**64 + 0.5) * ranges), F.lit(ranges - 1)))

    sums = base.groupBy("mix_missing", "mix_name", "mix_range").agg(F.sum("mix_size").alias("mix_sum"))
    earlier = Window.partitionBy("mix_missing", "mix_name").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("mix_base", F.coalesce(F.sum("mix_sum").over(earlier), F.lit(0)))
    targets = source_targets(
        sums.select(F.col("mix_missing").alias("missing"), F.col("mix_name").alias("name"), F.col("mix_sum").alias("size")),
        schedules, budget, most,
    ).select(
        F.col("missing").alias("mix_missing"), F.col("name").alias("mix_name"), F.col("rank").alias("mix_rank"),
        F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
    )
    before = Window.partitionBy("mix_missing", "mix_name", "mix_range").orderBy("mix_h", "doc_id", "mix_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        base.join(starts.join(targets, ["mix_missing", "mix_name"]).drop("mix_sum"), ["mix_missing", "mix_name", "mix_range"])
        .withColumn("mix_start", F.col("mix_base") + F.coalesce(F.sum("mix_size").over(before), F.lit(0)))
    )
    limit = F.floor("mix_target").cast("long")

    def copy(k: int) -> Column:
        start = F.col("mix_start") + F.col("mix_source_size") * k
        if cut:
            words = F.greatest(F.lit(0), F.least(F.col("mix_size"), limit - start)).cast("long")
        else:
            words = F.when(start + F.col("mix_size") / 2 < limit, F.col("mix_size")).otherwise(F.lit(0)).cast("long")
        share = F.least((start + words / 2) / F.greatest(limit, F.lit(1)), F.lit(1.0))
        position = F.lit(None).cast("double")
        for k_s, schedule in enumerate(schedules):
            position = F.when(F.col("mix_rank") % len(schedules) == k_s, _time_of(share, schedule)).otherwise(position)
        return F.struct(F.lit(k).alias("copy"), words.alias("words"), position.alias("position"))

    copies = F.filter(F.array(*(copy(k) for k in range(math.ceil(most)))), lambda c: c["words"] > 0)
    return placed.withColumn("mix_copies", copies).drop("mix_missing", "mix_name", "mix_range", "mix_h", "mix_base", "mix_rank", "mix_start")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by training position (ties by id)."""
    return (
        mixed.withColumn("mix_copy", F.explode("mix_copies")).drop("mix_copies")
        .orderBy(F.col("mix_copy.position"), "doc_id", F.col("mix_copy.copy"))
    )
