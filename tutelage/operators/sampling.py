"""Exact, seeded sampling without a per-class sort.

Every row gets a draw key ``md5(seed:id)``; "sample n" means "the n lowest keys of the class",
ties by id, so a sample depends on nothing but seed and ids. Ranking a whole class in one window
would put a third of all rows into one task. Instead the key space is cut into ``16**PREFIX``
slices of the md5 prefix:

1. one scan sums up every (class, slice): its rows, its lowest and its highest key, a partial aggregate with at most ``classes * 16**PREFIX`` rows;
2. find the one slice per class in which the n-th row falls; if it is the lowest or the highest of its slice the key is known, as
   it is for all classes of up to about ``16**PREFIX`` rows. Only for what is left are the rows of that slice read again and ranked;
3. the n-th key is now a literal, and the sample a plain filter on the scan. Nothing is shuffled.

Ids must be unique. For a few known classes the cut-offs are literals; for classes found in the data they are a table, joined
on the class (``lowest_n``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tutelage.functions.constants import BALANCE_SEED, FEW_SHOT_ORDER, LABELS, SAMPLE_SEED
from tutelage.functions.text import py_strip
from tutelage.session import materialise

PREFIX = 4


def draw_key(id_col: Column | str, seed: int | str) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def valid_labels(df: DataFrame, labels: Sequence[str] = LABELS, label_col: str = "answer") -> DataFrame:
    """Strip the labels, keep the known ones, drop the rest without complaint."""
    return df.withColumn(label_col, py_strip(label_col)).filter(F.col(label_col).isin(*labels))


def class_distribution(df: DataFrame, label_col: str = "answer", labels: Sequence[str] | None = LABELS) -> DataFrame:
    """Rows per class. With a label list: those labels, zeros kept. Without: all values found."""
    if labels is None:
        return df.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    counts = df.agg(*[F.count_if(F.col(label_col) == lab).alias(f"n{i}") for i, lab in enumerate(labels)])
    cells = [F.struct(F.lit(lab).alias("label"), F.col(f"n{i}").alias("n")) for i, lab in enumerate(labels)]
    return counts.select(F.inline(F.array(*cells)))


def _slices(keyed: DataFrame, prefix: int) -> DataFrame:
    """``(cls, slice, n, low, high)``: rows, lowest and highest ``(draw, id)`` of every slice."""
    key = F.struct("draw", "id")
    return keyed.groupBy("cls", F.substring("draw", 1, prefix).alias("slice")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))


def _edges(slices: DataFrame, quota: Column) -> DataFrame:
    """``(cls, slice, nth, key)``: per class the slice of the ``quota``-th row, its place there, and its key if the slice's ends tell it."""
    upto = F.sum("n").over(W.partitionBy("cls").orderBy("slice"))
    at = slices.withColumn("upto", upto).withColumn("nth", quota - F.col("upto") + F.col("n")).filter((F.col("upto") >= quota) & (F.col("nth") > 0))
    return at.select("cls", "slice", "nth", F.when(F.col("nth") == 1, F.col("low")).when(F.col("nth") == F.col("n"), F.col("high")).alias("key"))


def _cuts(keyed: DataFrame, quota: int, prefix: int) -> DataFrame:
    """``(cls, cut_draw, cut_id)`` of every class: the ``quota``-th lowest draw, null where the class is no larger.

    ``keyed`` has ``cls``, ``draw`` and ``id``. All classes go together, as rows: nothing here grows with their number but tables.
    """
    slices = materialise(_slices(keyed, prefix), "slices")
    edges = materialise(_edges(slices, F.lit(quota)), "edges")
    cuts, far = edges.filter(F.col("key").isNotNull()).select("cls", "key.draw", "key.id"), edges.filter(F.col("key").isNull())
    if not far.isEmpty():
        ranked = keyed.withColumn("slice", F.substring("draw", 1, prefix)).join(far.drop("key"), ["cls", "slice"])
        nth = ranked.withColumn("rn", F.row_number().over(W.partitionBy("cls").orderBy("draw", "id"))).filter(F.col("rn") == F.col("nth"))
        cuts = cuts.union(nth.select("cls", "draw", "id"))
    return slices.select("cls").distinct().join(cuts.select("cls", F.col("draw").alias("cut_draw"), F.col("id").alias("cut_id")), "cls", "left")


def _inside(draw: Column, ident: Column) -> Column:
    return F.col("cut_draw").isNull() | (draw < F.col("cut_draw")) | ((draw == F.col("cut_draw")) & (ident <= F.col("cut_id")))


def _keyed(df: DataFrame, seed: int | str, class_col: str | None, id_col: str) -> DataFrame:
    cls = F.lit("all") if class_col is None else F.col(class_col)
    return df.select(cls.alias("cls"), draw_key(id_col, seed).alias("draw"), F.col(id_col).alias("id")).filter(F.col("cls").isNotNull())


def drawn(df: DataFrame, quotas: Callable[[dict[str, int]], Mapping[str, int]], seed: int | str,
          class_col: str | None = None, id_col: str = "id", prefix: int = PREFIX, classes: Sequence[str] | None = None) -> Column:
    """A row predicate for few, known classes: is this row among the ``quotas(class sizes)[class]`` lowest draws of its class?

    The cut-offs become literals, so that the sample is a filter on the scan; ``lowest_n`` takes any number of classes.
    """
    keyed = _keyed(df, seed, class_col, id_col)
    if classes is not None:
        keyed = keyed.filter(F.col("cls").isin(*classes))
    slices = _slices(keyed, prefix).persist()
    try:
        sizes = {r["cls"]: r["n"] for r in slices.groupBy("cls").agg(F.sum("n").alias("n")).collect()}
        wanted = dict(quotas(sizes))
        partial = {c: n for c, n in wanted.items() if 0 < n < sizes.get(c, 0)}
        edges = []
        if partial:
            quota = F.coalesce(*[F.when(F.col("cls") == c, F.lit(n)) for c, n in partial.items()])
            edges = _edges(slices.filter(F.col("cls").isin(*partial)), quota).collect()
    finally:
        slices.unpersist()

    cuts = {r["cls"]: tuple(r["key"]) for r in edges if r["key"] is not None}
    far = [r for r in edges if r["key"] is None]
    if far:
        slice_of = F.substring("draw", 1, prefix)
        at_edge = F.lit(False)
        nth = F.lit(None).cast("long")
        for r in far:
            at_edge = at_edge | ((F.col("cls") == r["cls"]) & (slice_of == r["slice"]))
            nth = F.when(F.col("cls") == r["cls"], F.lit(r["nth"])).otherwise(nth)
        ranked = keyed.filter(at_edge).withColumn("rn", F.row_number().over(W.partitionBy("cls").orderBy("draw", "id")))
        cuts |= {r["cls"]: (r["draw"], r["id"]) for r in ranked.filter(F.col("rn") == nth).collect()}

    cls = F.lit("all") if class_col is None else F.col(class_col)
    draw = draw_key(id_col, seed)
    keep = F.lit(False)
    for c, n in wanted.items():
        if n <= 0:
            continue
        inside = F.lit(True)
        if c in cuts:
            cut_draw, cut_id = cuts[c]
            inside = (draw < cut_draw) | ((draw == cut_draw) & (F.col(id_col) <= cut_id))
        keep = keep | ((cls == c) & inside)
    return keep


def lowest(df: DataFrame, quotas: Callable[[dict[str, int]], Mapping[str, int]], seed: int | str,
           class_col: str | None = None, id_col: str = "id", prefix: int = PREFIX, classes: Sequence[str] | None = None) -> DataFrame:
    """The drawn rows: a filter on the scan of ``df``."""
    return df.filter(drawn(df, quotas, seed, class_col, id_col, prefix, classes))


def lowest_n(df: DataFrame, n: int, seed: int | str, class_col: str, id_col: str = "id", prefix: int = PREFIX) -> DataFrame:
    """The n lowest draws of every class, however many classes there are; rows without a class are left out.

    The cut-offs are a table joined to ``df`` on the class.
    """
    keyed = _keyed(df, seed, class_col, id_col)
    cuts = _cuts(keyed, n, prefix)
    return (df.join(cuts, F.col(class_col) == F.col("cls")).filter(_inside(draw_key(id_col, seed), F.col(id_col)))
            .select(*[df[c] for c in df.columns]))


def balance(df: DataFrame, per_class: int | None = None, seed: int = BALANCE_SEED,
            labels: Sequence[str] = LABELS, label_col: str = "answer", id_col: str = "id") -> DataFrame:
    """Same number of every label: ``per_class``, or the size of the smallest class."""
    def quotas(sizes: dict[str, int]) -> dict[str, int]:
        empty = [lab for lab in labels if not sizes.get(lab)]
        if empty:
            raise ValueError(f"no example for {', '.join(empty)}")
        n = min(sizes[lab] for lab in labels) if per_class is None else per_class
        short = [lab for lab in labels if sizes[lab] < n]
        if short:
            raise ValueError(f"fewer than {n} examples for {', '.join(short)}")
        return {lab: n for lab in labels}

    return lowest(valid_labels(df, labels, label_col), quotas, seed, label_col, id_col, classes=labels)


def balanced_val(df: DataFrame, frac: float = 0.1, per_class: int | None = None, seed: int = BALANCE_SEED,
                 labels: Sequence[str] = LABELS, label_col: str = "answer", id_col: str = "id",
                 exclude: DataFrame | None = None) -> DataFrame:
    """Balanced validation rows; never fails on a small class, the smallest class caps all.

    ``exclude`` takes out rows (by id) that were trained on.
    """
    def quotas(sizes: dict[str, int]) -> dict[str, int]:
        known = [sizes.get(lab, 0) for lab in labels]
        n = per_class
        if n is None:
            n = max(1, max(1, int(sum(known) * frac)) // len(labels))
        n = min(n, min(known))
        return {lab: n for lab in labels}

    pool = valid_labels(df, labels, label_col)
    if exclude is not None:
        pool = remainder(pool, exclude, id_col)
    return lowest(pool, quotas, seed, label_col, id_col, classes=labels)


def stratified_n(df: DataFrame, n: int, seed: int = SAMPLE_SEED, label_col: str = "answer", id_col: str = "id") -> DataFrame:
    """n rows of every class found, of any number of classes; an error if a class has fewer. Null is no class."""
    short = (df.filter(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count("*").alias("n")).filter(F.col("n") < n)
             .orderBy(label_col).limit(10).collect())
    if short:
        raise ValueError(f"fewer than {n} examples for {', '.join(str(r[0]) for r in short)}")
    return lowest_n(df, n, seed, label_col, id_col)


def remainder(pool: DataFrame, sample: DataFrame, id_col: str = "id") -> DataFrame:
    """The pool without the sampled rows."""
    return pool.join(sample.select(id_col), id_col, "left_anti")


def few_shot_sample(df: DataFrame, k: int = 2, seed: int = SAMPLE_SEED, classes: Sequence[str] = FEW_SHOT_ORDER,
                    label_col: str = "answer", id_col: str = "id") -> DataFrame:
    """k exemplars per class with their ``draw`` key, for ``few_shot_prompt``."""
    def quotas(sizes: dict[str, int]) -> dict[str, int]:
        short = [c for c in classes if sizes.get(c, 0) < k]
        if short:
            raise ValueError(f"fewer than {k} examples for {', '.join(short)}")
        return {c: k for c in classes}

    picked = lowest(df.filter(F.col(label_col).isin(*classes)), quotas, seed, label_col, id_col, classes=classes)
    return picked.withColumn("draw", draw_key(id_col, seed))


def split_column(df: DataFrame, test_frac: float, seed: int = SAMPLE_SEED, id_col: str = "id") -> DataFrame:
    """``df`` with a column ``split``: exactly ``ceil(test_frac * n)`` rows are test, the rest train."""
    test = drawn(df, lambda sizes: {"all": math.ceil(test_frac * sizes.get("all", 0))}, seed, None, id_col)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def train_test_split(df: DataFrame, test_frac: float, seed: int = SAMPLE_SEED, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    marked = split_column(df, test_frac, seed, id_col)
    return tuple(marked.filter(F.col("split") == side).drop("split") for side in ("train", "test"))


def shuffle(df: DataFrame, seed: int, id_col: str = "id") -> DataFrame:
    """All rows in draw order: a range-partitioned sort."""
    return df.withColumn("draw", draw_key(id_col, seed)).orderBy("draw", id_col).drop("draw")


def shuffle_rank(df: DataFrame, seed: int, id_col: str = "id", prefix: int = PREFIX) -> DataFrame:
    """``df`` with its 1-based place in draw order, without a global window.

    Rows are ranked inside slices of the md5 prefix, which are even by construction; the slice
    offsets are a table of at most ``16**prefix`` rows, small enough to broadcast whatever ``df`` is.
    """
    keyed = df.withColumn("draw", draw_key(id_col, seed)).withColumn("slice", F.substring("draw", 1, prefix))
    before = F.coalesce(F.sum("n").over(W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = keyed.groupBy("slice").agg(F.count("*").alias("n")).select("slice", before.alias("before"))
    within = F.row_number().over(W.partitionBy("slice").orderBy("draw", id_col))
    return (keyed.withColumn("within", within).join(F.broadcast(offsets), "slice")
            .withColumn("rank", F.col("before") + F.col("within")).drop("draw", "slice", "within", "before"))


def head_n(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The first n rows by id; 0 keeps all. It looks at no class."""
    return df if n <= 0 else df.orderBy(id_col).limit(n)
