"""Running values over ordered groups of any size.

A plain window puts each group into one task, so one group that holds a third of
all rows is one task with a third of all rows. Here the rows are first cut into
ranges of about ``rows_per_range`` rows by their (keys, order) value. The window
then runs per (range, keys), and what earlier ranges of the same group add up to
is carried in. Ranges follow the sort order, so only the group of a cut point goes
on from one range to the next: what is carried has one row per range (about
``MAX_RANGES``), however large the data is, and no other group is added up for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1_000_000
# Bounds what is carried and sampled (16 keys a range). From 65 billion rows on, ranges grow.
MAX_RANGES = 1 << 16
_SAMPLES_PER_RANGE = 16


def _range_bounds(df: DataFrame, sort_columns: Sequence[str], rows_per_range: int) -> Column:
    """Cut points as a scalar subquery, drawn from a sample picked by key hash.

    The sample depends on the key values alone, so a re-run task or a second scan
    sees the same cut points. It holds about ``MAX_RANGES * 16`` keys at most.
    """
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    at_least = max(1, rows_per_range // _SAMPLES_PER_RANGE)
    one_in = F.greatest(
        F.lit(at_least), (rows / (MAX_RANGES * _SAMPLES_PER_RANGE)).cast("long"))
    return (
        df.select(F.struct(*sort_columns).alias("k"))
        .where(F.pmod(F.xxhash64("k"), one_in) == 0)
        .agg(F.array_sort(F.collect_set("k")).alias("k"))
        .select(F.filter(
            "k", lambda _, i: i % _SAMPLES_PER_RANGE == _SAMPLES_PER_RANGE - 1).alias("bounds"))
        .scalar()
    )


def _bounds_up_to(bounds: str, key: Column) -> Column:
    """How many of the sorted ``bounds``, less than four times ``MAX_RANGES``, are at most ``key``,
    by binary search."""
    most = 2 * MAX_RANGES
    steps = F.array(*[F.lit(most >> i) for i in range(most.bit_length())])

    def search(value: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda low, step: low + F.when(
            F.get(value["bounds"], low + step - 1) <= value["key"], step).otherwise(0))

    # The key goes in as an array item, so that it is put together once per row; the bounds go in
    # beside it and are named nowhere else, else each row would get a copy of all of them.
    return F.transform(F.array(F.struct(F.col(bounds).alias("bounds"), key.alias("key"))), search)[0]


def with_range(df: DataFrame, sort_columns: Sequence[str],
               rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``_range``, rising with ``sort_columns``."""
    return _ranged(df, _range_bounds(df, sort_columns, rows_per_range), sort_columns)


def _ranged(df: DataFrame, bounds: Column, sort_columns: Sequence[str]) -> DataFrame:
    return (
        df.withColumn("_bounds", bounds)
        .withColumn("_range", _bounds_up_to("_bounds", F.struct(*sort_columns)))
        .drop("_bounds")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Adds running values per ``keys`` group, in ``order``.

    ``sums``      total of the expression up to and including the row
    ``lasts``     last value that is not null, up to and including the row
    ``previous``  value of the row before, null on the first row

    ``keys + order`` must tell any two rows apart. A column of the same name is replaced.
    ``df`` is read four times, thrice for its keys and inputs only, so it should be a
    table rather than the end of a long plan.
    """
    sums, lasts, previous = sums or {}, lasts or {}, previous or {}
    sort_columns = [*keys, *order]
    inputs = {**sums, **lasts, **previous}
    df_in = df.withColumns({f"_in_{name}": value for name, value in inputs.items()})
    bounds = _range_bounds(df_in, sort_columns, rows_per_range)
    ranged = _ranged(df_in, bounds, sort_columns)

    # Only the group of the cut point that ends a range can go on in the next one. The last range
    # has no cut point: what it may pass on has no range to go into.
    cut = F.get(bounds, F.col("_range"))
    goes_on = F.struct(*[cut[k].alias(k) for k in keys]).eqNullSafe(F.struct(*keys))
    at = F.struct(*order)
    block = ranged.where(goes_on).groupBy(*keys, "_range").agg(
        *[F.sum(f"_in_{n}").alias(n) for n in sums],
        *[F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), at)).alias(n) for n in lasts],
        *[F.max_by(F.struct(f"_in_{n}"), at).alias(n) for n in previous],
    )
    so_far = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, 0)
    carried = (
        block.select(
            (F.col("_range") + 1).alias("_range"), F.struct(*keys).alias("group"),
            *[F.sum(n).over(so_far).alias(n) for n in sums],
            *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in lasts],
            *[F.col(n)[f"_in_{n}"].alias(n) for n in previous],
        )
        .agg(F.array_sort(F.collect_list(F.struct(
            "_range", F.struct("group", *inputs).alias("carry"))),
            lambda one, two: one["_range"] - two["_range"]).alias("carried"))
        # by range: before each item as many nulls as ranges that nothing goes on into
        .select(F.flatten(F.transform("carried", lambda item, i: F.concat(
            F.array_repeat(
                F.when(F.lit(False), item["carry"]),
                (item["_range"] - F.coalesce(F.get("carried", i - 1)["_range"], F.lit(-1)) - 1).cast("int")),
            F.array(item["carry"])))).alias("carry"))
        .scalar()
    )

    rows = Window.partitionBy("_range", *keys).orderBy(*order)
    up_to = rows.rowsBetween(Window.unboundedPreceding, 0)
    ranged = (
        ranged.withColumn("_carry", F.get(carried, F.col("_range")))
        .withColumn("_carry", F.when(
            F.col("_carry.group").eqNullSafe(F.struct(*keys)), F.col("_carry")))
    )
    first_row = F.row_number().over(rows) == 1
    values = {
        **{n: F.coalesce(F.sum(f"_in_{n}").over(up_to), F.lit(0))
           + F.coalesce(F.col(f"_carry.{n}"), F.lit(0)) for n in sums},
        **{n: F.coalesce(F.last(f"_in_{n}", ignorenulls=True).over(up_to), F.col(f"_carry.{n}"))
           for n in lasts},
        **{n: F.when(first_row, F.col(f"_carry.{n}")).otherwise(F.lag(f"_in_{n}").over(rows))
           for n in previous},
    }
    kept = [c for c in df.columns if c not in values]
    return ranged.select(*kept, *[value.alias(n) for n, value in values.items()])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position",
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds the 1-based place of each row within its group."""
    return running(df, keys, order, sums={name: F.lit(1)}, rows_per_range=rows_per_range)
