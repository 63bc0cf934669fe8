"""Exact order statistics that never sort a whole group in one task.

Values are first counted (partial aggregation removes repeats before the shuffle), then
every value falls into a slot of a fixed logarithmic scale. Running totals over the slots,
of which a group has at most some hundred thousand, locate the slots that hold the wanted ranks,
and only those slots are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.operators.joins import join_on

# A slot spans a factor of 2 ** (1 / 8192), less than 0.009 % of a price: few values share
# one even where prices are continuous.
SLOTS_PER_DOUBLING = 8192
_LARGEST = 1100.0


def slot_of(value: Column) -> Column:
    """Position of a value on the scale; a larger value never gets a smaller slot."""
    size = F.least(F.log2(F.abs(value) + 1.0), F.lit(_LARGEST))
    return (F.signum(value) * F.floor(size * SLOTS_PER_DOUBLING)).cast("long")


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values with their number of rows: ``*by, value, n``."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("value"))
    return rows.groupBy(*by, "value").agg(F.count("*").alias("n"))


def _running(part: W, order: list, column: str) -> Column:
    spec = part.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.sum(column).over(spec)


def quantiles_of_counts(
    counts: DataFrame, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles with linear interpolation, one row per group: ``*by, *probs``."""
    by = list(by)
    group = [f"`{b}`" for b in by]
    part = f"PARTITION BY {', '.join(group)}" if by else ""
    place = {name: f"((total - 1) * {float(p)!r}D)" for name, p in probs.items()}
    low = {name: f"floor({at})" for name, at in place.items()}
    high = {name: f"least({rank} + 1, total - 1)" for name, rank in low.items()}

    slotted = counts.withColumn("slot", slot_of(F.col("value")))
    slots = slotted.groupBy(*by, "slot").agg(F.sum("n").alias("in_slot")).selectExpr(
        *group,
        "slot",
        "in_slot",
        f"sum(in_slot) OVER ({part} ORDER BY slot ROWS UNBOUNDED PRECEDING) AS upto_slot",
        f"sum(in_slot) OVER ({part}) AS total",
    )
    ranks = ", ".join([*low.values(), *high.values()])
    wanted = slots.where(
        f"exists(array({ranks}), r -> r >= upto_slot - in_slot AND r < upto_slot)"
    ).selectExpr(*group, "slot", "upto_slot - in_slot AS before", "total")
    if not by:
        # At most two slots per quantile.
        wanted = F.broadcast(wanted)
    in_order = f"PARTITION BY {', '.join([*group, 'slot'])} ORDER BY value ROWS UNBOUNDED PRECEDING"
    placed = join_on(slotted, wanted, [*by, "slot"], never_null=("slot",)).selectExpr(
        *group, "value", "n", "total", f"before + sum(n) OVER ({in_order}) AS upto"
    )

    def holding(rank: str, name: str) -> Column:
        return F.expr(f"max(CASE WHEN {rank} >= upto - n AND {rank} < upto THEN value END)").alias(name)

    found = placed.groupBy(*by).agg(
        F.max("total").alias("total"),
        *[holding(rank, f"{name}_low") for name, rank in low.items()],
        *[holding(rank, f"{name}_high") for name, rank in high.items()],
    )
    # Equal neighbours need no interpolation; this also keeps infinities.
    return found.selectExpr(
        *group,
        *[
            f"CASE WHEN {n}_low = {n}_high THEN {n}_low "
            f"ELSE {n}_low + ({n}_high - {n}_low) * ({place[n]} - {low[n]}) END AS {n}"
            for n in probs
        ],
    )


def quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles of a column, overall or per group."""
    return quantiles_of_counts(value_counts(df, value, by), probs, by)


def count_below(counts: DataFrame, probes: DataFrame, probe: str) -> DataFrame:
    """For every row of ``probes``, the number of counted rows strictly below its value.

    Values and probes are ordered together slot by slot, so no pair of them is formed. The
    result is joined back on the value, so ``probes`` must read the same every time: write
    averages out first, since a sum in another order may differ in its last digit.
    """
    marks = probes.select(F.col(probe).alias("value")).where("value IS NOT NULL").distinct()
    both = (
        counts.select("value", "n", F.lit(False).alias("is_probe"))
        .unionByName(marks.select("value", F.lit(0).cast("long").alias("n"), F.lit(True).alias("is_probe")))
        .withColumn("slot", slot_of(F.col("value")))
    )
    slots = (
        both.groupBy("slot")
        .agg(F.sum("n").alias("in_slot"), F.max("is_probe").alias("probed"))
        .withColumn("before", _running(W.partitionBy(), ["slot"], "in_slot") - F.col("in_slot"))
        .where("probed")
        .select("slot", "before")
    )
    order = [F.col("value"), F.col("is_probe").desc()]
    below = (
        join_on(both, slots, ["slot"], never_null=("slot",))
        .withColumn("below", F.col("before") + _running(W.partitionBy("slot"), order, "n"))
        .where("is_probe")
        .select(F.col("value").alias(probe), "below")
    )
    return probes.join(below, probe, "left")
