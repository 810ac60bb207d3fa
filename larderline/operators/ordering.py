"""Positions within an order, and first or last row per key, for groups of any size."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
MAX_SPLITS = 4096
_STEP = 64


def ordered_position(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str,
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """1-based position of each row within its group, in ascending ``order``.

    ``order`` names columns that together are unique within a group. A plain
    window sorts a whole group in one task; here a group above
    ``rows_per_task`` is cut at values sampled from it, the pieces are ranked
    apart, and each piece is shifted by the size of those before it. The cut
    values only balance the work: the positions do not depend on them. With no
    ``group`` the whole table is one group.
    """
    group = list(group)
    key = F.struct(*[F.col(c) for c in order])
    tie = F.xxhash64(*order)
    if not group:
        cut_up = _cut_up(df, order, rows_per_task)
        before = _prefix_sums(cut_up.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")))
        local = F.row_number().over(Window.partitionBy("_piece").orderBy(*order))
        return (cut_up.withColumn(out, local).join(before, F.col("_piece") == F.col("_b_piece"), "left")
                .withColumn(out, (F.col(out) + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_before", "_piece", "_b_piece"))
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    big = sizes.select(*[F.col(c).alias(f"_b_{c}") for c in group],
                       _sample_step(F.col("_n"), rows_per_task).alias("_every"))
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in group]
    sampled = (df.select(*group, *[c for c in order if c not in group]).join(big, same)
               .filter(F.pmod(tie, F.col("_every")) == 0))
    cuts = (sampled.groupBy(*[F.col(f"_b_{c}") for c in group])
            .agg(F.array_sort(F.collect_list(key)).alias("_cuts")))
    cut_up = (df.join(cuts, same, "left").withColumn("_piece", _piece(key))
              .drop("_cuts", *[f"_b_{c}" for c in group]))

    # groups that were not cut are left out of the counts: all their rows are in piece 0
    counted = cut_up.join(cuts.select(*[f"_b_{c}" for c in group]), same, "left_semi")
    pieces = counted.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    # a first piece is shifted by nothing, so only groups that were cut appear here
    before = pieces.withColumn("_before", earlier).filter(F.col("_before") > 0).select(
        *[F.col(c).alias(f"_b_{c}") for c in group], F.col("_piece").alias("_b_piece"), "_before")
    local = F.row_number().over(Window.partitionBy(*group, "_piece").orderBy(*order))
    return (cut_up.withColumn(out, local)
            .join(before, [*same, F.col("_piece") == F.col("_b_piece")], "left")
            .withColumn(out, (F.col(out) + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint"))
            .drop("_before", "_piece", "_b_piece", *[f"_b_{c}" for c in group]))


def sum_before(df: DataFrame, order: Sequence[str], value: str, out: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Sum of ``value`` over all rows that come before a row in ascending ``order``; 0 for the first.

    ``order`` names columns that together are unique. The table is cut at sampled values as in ``ordered_position``:
    each piece is summed up apart and shifted by the sums of those before it, so that no task gets all rows. Nulls add nothing.
    """
    cut_up = _cut_up(df, order, rows_per_task)
    before = _prefix_sums(cut_up.groupBy("_piece").agg(F.coalesce(F.sum(value), F.lit(0)).alias("_n")))
    local = F.sum(value).over(Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return (cut_up.withColumn(out, local).join(before, F.col("_piece") == F.col("_b_piece"), "left")
            .withColumn(out, F.coalesce(out, F.lit(0)) + F.coalesce("_before", F.lit(0))).drop("_before", "_piece", "_b_piece"))


def _cut_up(df: DataFrame, order: Sequence[str], rows_per_task: int) -> DataFrame:
    """``df`` with ``_piece``, the number of its part in ``order``; the size and the cuts are single values, so nothing is joined to every row."""
    key = F.struct(*[F.col(c) for c in order])
    n = df.agg(F.count(F.lit(1))).scalar()
    sampled = df.select(*order).filter(F.pmod(F.xxhash64(*order), _sample_step(n, rows_per_task)) == 0)
    cuts = sampled.agg(F.array_sort(F.collect_list(key))).scalar()
    return df.withColumn("_cuts", cuts).withColumn("_piece", _piece(key)).drop("_cuts")


def _prefix_sums(pieces: DataFrame) -> DataFrame:
    """_b_piece and _before, the sum of ``_n`` over all earlier pieces, of which there are at most ``MAX_SPLITS`` or so."""
    listed = pieces.agg(F.array_sort(F.collect_list(F.struct("_piece", "_n"))).alias("l"))
    earlier = lambda i: F.transform(F.slice("l", F.lit(1), F.greatest(i, F.lit(0))), lambda x: x["_n"])
    sums = F.transform("l", lambda x, i: F.struct(x["_piece"].alias("_b_piece"), F.aggregate(earlier(i), x["_n"] - x["_n"], lambda acc, n: acc + n).alias("_before")))
    return listed.select(F.inline(sums))


def _sample_step(n: Column, rows_per_task: int) -> Column:
    """One row in how many is sampled as a cut; null when the group is not cut."""
    pieces = F.least(F.ceil(n / rows_per_task), F.lit(MAX_SPLITS))
    return F.when(n > rows_per_task, F.ceil(n / pieces))


def _piece(key: Column) -> Column:
    """Number of cuts at or below the key, in two steps: every 64th cut, then the 64 that follow."""
    coarse = F.transform(F.sequence(F.lit(_STEP), F.greatest(F.size("_cuts"), F.lit(_STEP)), F.lit(_STEP)),
                         lambda i: F.get(F.col("_cuts"), i - 1))
    skip = F.size(F.filter(coarse, lambda c: c <= key)) * _STEP
    near = F.size(F.filter(F.slice(F.col("_cuts"), skip + 1, F.lit(_STEP)), lambda c: c <= key))
    return F.when(F.coalesce(F.size("_cuts"), F.lit(0)) <= 0, F.lit(0)).otherwise(skip + near)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.

    The rank filter directly above the window lets Spark keep ``n`` rows per
    key on the map side, so a hot key sends ``n`` rows per task and not its
    whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def latest_rows(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Last row wins per key, by the version columns."""
    return first_rows(df, keys, [F.col(c).desc() for c in version])


def each(df: DataFrame, array: Column | str, out: str) -> DataFrame:
    """One row per element, none for an empty or missing array; elements are not null.

    A plain ``explode`` also makes the optimizer filter on the size of the
    array below the projections, which computes a costly array again.
    """
    return df.withColumn(out, F.explode_outer(array)).filter(F.col(out).isNotNull())
