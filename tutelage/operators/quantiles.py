"""Exact percentiles of a continuous column, for any number of groups.

``percentile`` keeps every distinct value of a group in one task. Here groups of up to ``max_inside`` rows are
ranked by one window, whatever their number. A larger group's ranks are found by selection: a bracket table
``(group, prob, low, high, below, open)`` holds what is known of each rank, a mergeable sketch cuts all open brackets into a grid at once, the
rows below and between the cuts are counted, and so on until few rows are left between the ends; only those are ordered. The counts are exact, so the
result is the exact percentile or an error, never an estimate.

All groups go together as rows: neither plan nor driver grows with them. A large group never meets in one task: sketches and
counts are summed where the rows are, and rows meet the brackets of large groups by broadcast or, beyond a bound, with hot keys apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tutelage.operators.joins import join_lookup
from tutelage.session import materialise

MAX_INSIDE = 1_000_000
#: Cuts of a bracket in one round.
GRID = 256


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], by: str | None = None,
                      accuracy: int = 10_000, max_inside: int = MAX_INSIDE) -> DataFrame:
    """``(by, prob, value)`` with linear interpolation between neighbours, as one written table; null values and null groups are left out."""
    group = F.lit("all") if by is None else F.col(by)
    rows = df.select(group.alias("g"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & F.col("g").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = materialise(_percentiles(rows, [float(p) for p in probs], accuracy, max_inside), "percentiles")
    finally:
        rows.unpersist()
    return found.select(F.col("g").alias(by or "grp"), "prob", "value")


def _percentiles(rows: DataFrame, probs: Sequence[float], accuracy: int, max_inside: int) -> DataFrame:
    sizes = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    wide = materialise(sizes.filter(F.col("n") > max_inside), "wide-groups")
    if wide.isEmpty():
        return _ranked(rows, probs)
    apart = join_lookup(rows, wide.select("g", F.lit(True).alias("wide")), "g", "left")
    return _ranked(apart.filter(F.col("wide").isNull()).drop("wide"), probs).union(_selected(rows, wide, probs, accuracy, max_inside))


def _targets(probs: Sequence[float]) -> Column:
    """Per wanted share the ranks of its two neighbours, from 0, and the part of the way between them, from the group's size ``n``."""
    at = [(F.col("n") - 1) * F.lit(p) for p in probs]
    return F.array(*[F.struct(F.lit(p).alias("prob"), F.floor(a).alias("first"), F.ceil(a).alias("second"), (a - F.floor(a)).alias("part")) for p, a in zip(probs, at, strict=True)])


def _read_off(placed: DataFrame, keys: Sequence[str], prob: Column, first: Column, second: Column, part: Column) -> DataFrame:
    """Percentiles from ``v``, the rank ``upto`` behind its last copy and its copies ``m``."""
    hit = lambda r: F.max(F.when((r >= F.col("upto") - F.col("m")) & (r < F.col("upto")), F.col("v")))
    ends = placed.select(*keys, "v", "upto", "m", prob.alias("prob"), first.alias("first"), second.alias("second"), part.alias("part"))
    found = ends.groupBy(*keys, "prob", "part").agg(hit(F.col("first")).alias("v0"), hit(F.col("second")).alias("v1"))
    return found.select("g", "prob", F.when(F.col("v0") == F.col("v1"), F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part")).alias("value"))


def _ranked(rows: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Of groups that one task may order: running counts over the distinct values."""
    counts = rows.groupBy("g", "v").agg(F.count("*").alias("m"))
    whole = W.partitionBy("g")
    placed = counts.withColumn("upto", F.sum("m").over(whole.orderBy("v").rowsBetween(W.unboundedPreceding, 0))).withColumn("n", F.sum("m").over(whole))
    # Only the distinct value on a wanted rank goes on, so that no value is copied once per share.
    t = F.explode(F.filter(_targets(probs), lambda x: (x["second"] >= F.col("upto") - F.col("m")) & (x["first"] < F.col("upto"))))
    each = placed.select("g", "v", "m", "upto", t.alias("t"))
    return _read_off(each, ["g"], *[F.col(f"t.{c}") for c in ("prob", "first", "second", "part")])


def _inside(rows: DataFrame, brackets: DataFrame, low: str, high: str) -> DataFrame:
    """``v`` and its bracket ``b`` for every row between the ends of a bracket; the brackets of a group are one row of the looked-up table."""
    packed = brackets.groupBy("g").agg(F.collect_list(F.struct(*[c for c in brackets.columns if c != "g"])).alias("all"))  # as many as shares
    met = join_lookup(rows, packed, "g", "inner").select("g", "v", F.explode("all").alias("b"))
    return met.filter(F.col("v").between(F.col(f"b.{low}"), F.col(f"b.{high}")))


def _narrowed(rows: DataFrame, brackets: DataFrame, accuracy: int) -> DataFrame:
    """``brackets`` with the ends moved in, from one sketch and one count of the rows inside them."""
    slack = 2.0 / accuracy + 1.0 / GRID / 8
    grid = F.percentile_approx("v", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]), F.lit(accuracy)).alias("cuts")
    sketched = _inside(rows, brackets, "low", "high").groupBy("g", "b").agg(grid)
    span = F.greatest(F.col("b.inside") - 1, F.lit(1))
    place = lambda rank, by: (F.col(f"b.{rank}") - F.col("b.below")) / span + by
    left = F.greatest(F.floor(place("first", -slack) * GRID), F.lit(0)).cast("int")
    right = F.least(F.ceil(place("second", slack) * GRID), F.lit(GRID)).cast("int")
    cut = sketched.select("g", "b.*", F.when(left > 0, F.element_at("cuts", left + 1)).otherwise(F.col("b.low")).alias("low2"),
                          F.when(right < GRID, F.element_at("cuts", right + 1)).otherwise(F.col("b.high")).alias("high2"))
    cut = materialise(cut, "cuts")
    v, low, high = F.col("v"), F.col("b.low2"), F.col("b.high2")
    counted = _inside(rows, cut, "low", "high").groupBy("g", "b").agg(
        F.count_if(v < low).alias("less"), F.count_if((v >= low) & (v <= high)).alias("inside"), F.count_if((v > low) & (v < high)).alias("open"))
    return counted.select("g", *[F.col(f"b.{c}") for c in ("prob", "first", "second", "part")], low.alias("low"), high.alias("high"),
                          (F.col("b.below") + F.col("less")).alias("below"), "inside", "open")


def _selected(rows: DataFrame, wide: DataFrame, probs: Sequence[float], accuracy: int, max_inside: int) -> DataFrame:
    """Of large groups: brackets narrowed until at most ``max_inside`` rows lie between their ends."""
    n = F.col("n")
    todo = wide.select("g", F.explode(_targets(probs)).alias("t"), "low", "high", F.lit(0).cast("bigint").alias("below"), n.alias("inside"), n.alias("open"))
    todo = todo.select("g", "t.*", "low", "high", "below", "inside", "open")
    done = None
    while True:
        todo = materialise(_narrowed(rows, todo, accuracy), "brackets")
        wrong = todo.filter((F.col("first") < F.col("below")) | (F.col("second") >= F.col("below") + F.col("inside")))
        if not wrong.isEmpty():
            raise ArithmeticError("rank fell outside its bracket; raise the accuracy")
        ready = todo.filter(F.col("open") <= max_inside)
        done = ready if done is None else done.union(ready)
        todo = todo.filter(F.col("open") > max_inside)
        if todo.isEmpty():
            break
    counts = _inside(rows, done, "low", "high").groupBy("g", "b", "v").agg(F.count("*").alias("m"))
    placed = counts.withColumn("upto", F.col("b.below") + F.sum("m").over(W.partitionBy("g", "b.prob").orderBy("v").rowsBetween(W.unboundedPreceding, 0)))
    return _read_off(placed, ["g"], *[F.col(f"b.{c}") for c in ("prob", "first", "second", "part")])
