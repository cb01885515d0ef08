"""Mixing sources to target weights over training time, by inverted cumulative demand.

Each source has a target (words that the mix takes of it) and a schedule: its weight over
training time 0 to 1, piecewise linear. The integral of the schedule, scaled to the target, is
the source's cumulative demand. A source's documents stand in a fixed shuffled order; the
place of a document in the running sum of their sizes, put through the inverse of the demand,
is its training position. A source whose target is above its size goes round again. Documents
range-sorted by position are the training order (:func:`training_order`).

Targets (:func:`targets`) are shares by weight of ``share`` times all words; none is above
``most`` times its source's words, the excess going to the others by weight, again and again.
That is one level ``L`` with target = min(most * words, L * weight), found from the sources in
the order in which they reach their bound.

Columns and SQL functions only. The running sum is taken in two levels, per (source, leading
digits of the order key) and within: a source with a third of all rows is spread evenly over
buckets whose number grows with the rows. Sources are one row each. A document is taken whole;
the one that the target cuts is taken if its middle is inside, so a source's taken words
differ from its target by half a document at most.

Defined cases: null sources are one source, the last in order. Null and blank texts have size 0,
their turn comes like any other's, and they take 0 words. A source without words has target 0.
Null ids are ordered by their texts. Rows equal in id and text are separate documents that
follow each other. An empty table gives none. Other columns stay; columns of the names added
here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
#: Weight over time per place in WEIGHTS: (time, weight), linear in between, at any scale.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 1.0), (1.0, 4.0)),
    ((0.0, 3.0), (0.5, 1.0), (1.0, 1.0)),
)
SHARE, MOST = 1.5, 2
ROWS_PER_BUCKET = 4096


ADDED = ("size", "mix_key", "source_size", "target", "taken", "positions")


def order_key(doc_id: Column, text: Column) -> Column:
    """The shuffled order, the same at every run: MD5 of id and text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce(text, F.lit("")))))


def segments(schedule) -> list[tuple[float, float, float, float]]:
    """(time, weight, slope, integral so far) of each piece, scaled to an integral of 1."""
    whole = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(schedule, schedule[1:], strict=False))
    if whole <= 0 or any(w < 0 for _, w in schedule) or schedule[0][0] != 0 or schedule[-1][0] != 1:
        raise ValueError("a schedule goes from time 0 to 1, never below 0, and not all of it is 0")
    out, done = [], 0.0
    for (a, v), (b, w) in zip(schedule, schedule[1:], strict=False):
        out.append((a, v / whole, (w - v) / (b - a) / whole, done))
        done += (b - a) * (v + w) / 2 / whole
    return out


def position_sql(part: str, schedule) -> str:
    """The time at which a schedule's integral is ``part``, as SQL that any engine runs."""
    pieces = segments(schedule)
    tests = []
    for at, weight, slope, done in reversed(pieces):
        r = f"({part} - {done!r}D)"
        tests.append((done, f"{at!r}D + 2.0D * {r} / ({weight!r}D + sqrt(greatest({weight * weight!r}D + 2.0D * {slope!r}D * {r}, 0.0D)))"))
    cases = " ".join(f"when {part} > {done!r}D then {value}" for done, value in tests)
    return f"case {cases} else 0.0D end"


def targets(sources: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source with ``words`` and ``weight``."""
    ranked = sources.withColumn("bound", F.col("words") * most)
    order = Window.orderBy(F.col("bound") / F.col("weight"), "weight", "bound")  # one row per source
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("words").over(every) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(before), F.lit(0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", level)
    # the first source that stays below its bound at its level sets the level
    free = F.when(F.col("level") <= F.col("bound") / F.col("weight"), F.col("level"))
    ranked = ranked.withColumn("level", F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return ranked.withColumn("target", F.when(
        F.col("level").isNull() | (F.col("level") * F.col("weight") > F.col("bound")), F.col("bound").cast("double")
    ).otherwise(F.col("level") * F.col("weight"))).drop("bound", "level")


def mix(df: DataFrame, size: Column, key: Column, source: str = "source", *, weights=WEIGHTS, schedules=SCHEDULES,
        share: float = SHARE, most: int = MOST, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``size, mix_key, source_size, target, taken, positions`` to documents: ``size`` (words) and
    ``mix_key`` (:func:`order_key`) as given, ``positions`` a training position for each time that the
    document is taken. Only the columns of ``df`` are shuffled."""
    rows = df.count()
    digits = 1
    while rows > rows_per_bucket * 16**digits:
        digits += 1
    # the rows as they came stand in one column, so that no name of theirs meets one of these
    sized = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), size.alias("size"), key.alias("mix_key"),
                      F.col(f"`{source}`").alias("mix_source")).withColumn("mix_bucket", F.substring("mix_key", 1, digits))
    sums = sized.groupBy("mix_source", "mix_bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    sources = sums.groupBy("mix_source").agg(F.sum("bucket_size").alias("words"))
    place = (F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1) % len(weights)
    placed = sources.withColumn("place", place).withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("place") + 1))
    aims = targets(placed, share, most)
    plan = offsets.alias("o").join(aims.alias("a"), F.col("o.mix_source").eqNullSafe(F.col("a.mix_source"))).select(
        F.col("o.mix_source").alias("plan_source"), F.col("o.mix_bucket").alias("plan_bucket"), "bucket_start",
        F.col("words").alias("source_size"), "target", "place")
    inside = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_key", "size")
    running = sized.withColumn("mix_start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    joined = running.join(plan, F.col("mix_source").eqNullSafe(F.col("plan_source")) & (F.col("mix_bucket") == F.col("plan_bucket")))
    middle = (F.col("mix_start") + F.col("bucket_start") + F.col("size") / 2.0)
    for turn in range(most):
        at = middle + F.col("source_size") * F.lit(turn)
        part = f"part_{turn}"
        joined = joined.withColumn(part, F.when(at < F.col("target"), at / F.col("target")))
        chosen = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            chosen = F.when(F.col("place") == i, F.expr(position_sql(part, schedule))).otherwise(chosen)
        joined = joined.withColumn(f"at_{turn}", F.when(F.col(part).isNotNull(), chosen))
    positions = F.array_compact(F.array(*[F.col(f"at_{turn}") for turn in range(most)]))
    out = joined.withColumn("positions", positions).withColumn("taken", F.col("size") * F.size("positions"))
    own = [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in ADDED]
    return out.select(*own, *ADDED)


def training_order(mixed: DataFrame) -> DataFrame:
    """Each document as often as it is taken, range-sorted by ``position``; rows of equal
    position follow by their order key. Documents that aren't taken are left out."""
    return mixed.withColumn("position", F.explode("positions")).orderBy("position", "mix_key")
