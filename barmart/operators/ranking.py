"""Ranking within groups of any size, and top rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.operators.series import refuse_names

# A group of at most this many rows may be ranked by one task.
GROUP_ROWS = 4_000_000

# A group with more distinct values than this is ranked in slots of about equally many values each, up to
# ``SLOTS`` of them. Their limits come from a quantile sketch, so how the values lie doesn't matter.
SLOT_VALUES = 10_000
SLOTS = 1024


def groups_fit(df: DataFrame, group: list[str | Column], limit: int = GROUP_ROWS) -> bool:
    """Measure (one pre-aggregated count): does every group hold at most ``limit`` rows?"""
    sizes = df.groupBy(*group).agg(F.count("*").alias("rows"))
    return (sizes.agg(F.max("rows")).first()[0] or 0) <= limit


def slot_limits(distinct: DataFrame, group: list[str], value: Column) -> DataFrame:
    """(group, _limits): ascending limits between the slots of each group that needs several.

    One mergeable quantile sketch by group, over distinct values and their ``_rows``. Groups that fit one slot have no row, so the table has at
    most a row for every ``SLOT_VALUES`` distinct values.
    """
    # Every distinct value has rows; reading them keeps the exchange of the distinct values one and the same.
    finite = F.when((F.abs(value) < float("inf")) & (F.col("_rows") > 0), value)
    shares = [k / SLOTS for k in range(1, SLOTS)]
    sketch = distinct.groupBy(*group).agg(
        F.least(F.lit(SLOTS), F.ceil(F.count(value) / SLOT_VALUES)).alias("_slots"),
        F.percentile_approx(finite, shares).alias("_limits"),
    )
    taken = F.filter(
        "_limits", lambda _, i: F.floor((i + 1) * F.col("_slots") / SLOTS) > F.floor(i * F.col("_slots") / SLOTS)
    )
    return sketch.filter("_slots > 1 AND _limits IS NOT NULL").select(
        *group, F.array_sort(F.array_distinct(taken)).alias("_limits")
    )


def slot_of(value: Column, limits: Column) -> Column:
    """How many limits lie below ``value``, by halving steps; NaN lies above all numbers, null has no slot."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(SLOTS.bit_length()))])

    def go(at: Column, step: Column) -> Column:
        below = (at + step <= F.size(limits)) & (F.get(limits, at + step - 1) < value)
        return F.when(below, at + step).otherwise(at)

    found = F.when(limits.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), go))
    return F.when(value.isNotNull(), found)


def rank_values(
    df: DataFrame,
    group: list[str],
    value: str,
    names: dict[str, str],
    fits: bool = False,
    values_from: DataFrame | None = None,
) -> DataFrame:
    """Add rank, dense rank and percent rank by ``value`` descending (nulls last) within ``group``.

    ``names`` maps the wanted kinds to column names. ``fits`` says that no group is too
    large for one task, as measured by ``groups_fit``; otherwise groups are split.
    ``values_from`` may name a cheaper table with the same groups and values to count.
    """
    if not fits:
        return _rank_split(df, df if values_from is None else values_from, group, value, names)
    within = Window.partitionBy(*group).orderBy(F.desc_nulls_last(value))
    kinds = {
        "rank": F.rank().over(within).cast("long"),
        "dense_rank": F.dense_rank().over(within).cast("long"),
        "percent_rank": F.percent_rank().over(within),
    }
    return df.withColumns({name: kinds[k] for k, name in names.items()})


def _rank_split(
    df: DataFrame, values_from: DataFrame, group: list[str], value: str, names: dict[str, str]
) -> DataFrame:
    """Rank without bringing the rows of a group together.

    The distinct values are counted (pre-aggregated before the exchange, so equal values
    cost one row per task), ranked inside slots of similar values, and shifted by what the
    slots above hold. Slots hold about equally many distinct values (``slot_limits``). What meets
    in one window are the values of a slot, and the slots of a group. The rows then
    look their rank up by (group, value), where a value shared by many rows can be split
    like any skewed join key.
    """
    refuse_names(df, ["_rows", "_slot", "_slots", "_limits"])
    number = F.col(value).cast("double")
    distinct = values_from.groupBy(*group, value).agg(F.count("*").alias("_rows"))
    limited = _same(distinct, slot_limits(distinct, group, number), group, "left")
    counted = limited.withColumn("_slot", slot_of(number, F.col("_limits"))).drop("_limits")
    inside = Window.partitionBy(*group, "_slot").orderBy(F.desc_nulls_last(value))
    local = counted.withColumns(
        {
            "_larger": F.coalesce(F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_nth": F.row_number().over(inside),
        }
    )
    # Totals of the slots come from rows that are together already.
    slots = local.groupBy(*group, "_slot").agg(
        F.max(F.col("_larger") + F.col("_rows")).alias("_slot_rows"), F.max("_nth").alias("_slot_values")
    )
    per_group = Window.partitionBy(*group)
    above = per_group.orderBy(F.desc_nulls_last("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = slots.select(
        *group,
        "_slot",
        F.coalesce(F.sum("_slot_rows").over(above), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_slot_values").over(above), F.lit(0)).alias("_values_above"),
        F.sum("_slot_rows").over(per_group).alias("_group_rows"),
    )
    placed = _same(local, shifts, [*group, "_slot"], "inner")
    rank = F.col("_rows_above") + F.col("_larger") + 1
    share = F.when(F.col("_group_rows") > 1, (rank - 1) / (F.col("_group_rows") - 1)).otherwise(F.lit(0.0))
    kinds = {
        "rank": rank.cast("long"),
        "dense_rank": (F.col("_values_above") + F.col("_nth")).cast("long"),
        "percent_rank": share,
    }
    ranks = placed.select(*group, value, *[kinds[k].alias(name) for k, name in names.items()])
    return _same(df, ranks, [*group, value], "left")


def _same(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi join in which null matches null; keeps the left columns and the right's others."""
    keys = [f"_r{i}" for i in range(len(on))]
    renamed = right.withColumnsRenamed(dict(zip(on, keys)))
    condition = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(on, keys)]
    return left.join(renamed, condition, how).drop(*keys)


def top_per_key(df: DataFrame, key: str, by: str, rows: int, ties: list[str]) -> DataFrame:
    """The ``rows`` largest rows of each key; rows without a value are left out.

    Spark limits each group before the exchange (WindowGroupLimit), so a hot key sends at
    most ``rows`` rows per task.
    """
    order = Window.partitionBy(key).orderBy(F.desc(by), *ties)
    return (
        df.filter(F.col(by).isNotNull())
        .withColumn("_nth", F.row_number().over(order))
        .filter(F.col("_nth") <= rows)
        .drop("_nth")
    )
