"""Training sets: pairs from conversations, SFT / KD / DPO rows, teacher annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tutelage.functions.constants import BALANCE_SEED, LABEL_IDS, LABELS
from tutelage.functions.templates import credit_train_prompt
from tutelage.operators.sampling import balance, draw_key
from tutelage.session import materialise

BLOCK = 1024


def pairs_from_turns(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, turn, input, output)``: each user turn with the assistant turn right after it.

    The latest system turn before the user turn is put in front. A conversation may be of any
    length: turns are ordered inside blocks of ``block`` turn numbers, and only a summary per block is
    ordered per conversation, so that no conversation lands in one task.
    """
    t = turns.withColumn("block", F.floor(F.col("turn") / block))
    here = W.partitionBy("conv_id", "block").orderBy("turn")
    system_text = F.when(F.col("role") == "system", F.col("text"))
    inner = t.select(
        "conv_id", "block", "turn", "role", "text",
        F.lead(F.struct("role", "text")).over(here).alias("next"),
        F.last(system_text, ignorenulls=True).over(here.rowsBetween(W.unboundedPreceding, 0)).alias("system"))
    ends = t.groupBy("conv_id", "block").agg(
        F.min_by(F.struct("role", "text"), "turn").alias("first"),
        F.max_by("text", F.when(F.col("role") == "system", F.col("turn"))).alias("system"))
    blocks = W.partitionBy("conv_id").orderBy("block")
    around = ends.select(
        "conv_id", "block", F.lead("first").over(blocks).alias("next_first"),
        F.last("system", ignorenulls=True).over(blocks.rowsBetween(W.unboundedPreceding, -1)).alias("system_before"))
    both = inner.join(around, ["conv_id", "block"])
    nxt = F.coalesce("next", "next_first")
    system = F.coalesce("system", "system_before")
    return (both.filter((F.col("role") == "user") & (nxt["role"] == "assistant"))
            .select("conv_id", "turn",
                    F.when(system.isNotNull(), F.concat(system, F.lit("\n\n"), "text")).otherwise(F.col("text")).alias("input"),
                    nxt["text"].alias("output")))


def negative_label(label: Column | str, id_col: Column | str, seed: int = BALANCE_SEED, labels: Sequence[str] = LABELS) -> Column:
    """One of the other labels, evenly by the id's draw key."""
    label = F.col(label) if isinstance(label, str) else label
    others = F.array_remove(F.array(*[F.lit(lab) for lab in labels]), label)
    if len(labels) == 3:
        at = F.when(F.substring(draw_key(id_col, f"neg:{seed}"), 1, 1) < "8", 1).otherwise(2)
    else:
        at = (F.conv(F.substring(draw_key(id_col, f"neg:{seed}"), 1, 8), 16, 10).cast("long") % (len(labels) - 1) + 1).cast("int")
    return F.element_at(others, at)


def sft_rows(df: DataFrame) -> DataFrame:
    return df.select("id", credit_train_prompt("question").alias("input"), F.col("answer").alias("output"))


def kd_rows(df: DataFrame, teacher_col: str | None = None) -> DataFrame:
    """The teacher's output where there is one, else the gold answer."""
    target = F.col("answer") if teacher_col is None else F.coalesce(F.col(teacher_col), F.col("answer"))
    return df.select("id", credit_train_prompt("question").alias("input"), target.alias("teacher_output"))


def dpo_rows(df: DataFrame, seed: int = BALANCE_SEED, labels: Sequence[str] = LABELS) -> DataFrame:
    return df.select("id", credit_train_prompt("question").alias("prompt"), F.col("answer").alias("chosen"),
                     negative_label("answer", "id", seed, labels).alias("rejected"))


def build_sets(df: DataFrame, per_class: int | None = None, seed: int = BALANCE_SEED, labels: Sequence[str] = LABELS,
               written: bool = False) -> dict[str, DataFrame]:
    """The three training sets of one balanced selection.

    The selection is a fixed filter (see ``sampling``), so the sets agree without being cached. ``written``
    puts it in the shared folder first: worth it when ``df`` is dear to read three times (JSON, joins).
    """
    kept = balance(df, per_class, seed, labels).select("id", "question", "answer")
    if written:
        kept = materialise(kept, "selection")
    return {"sft": sft_rows(kept), "kd": kd_rows(kept), "dpo": dpo_rows(kept, seed, labels)}


def valid_annotations(df: DataFrame, json_col: str = "annotation", labels: Sequence[str] = LABELS) -> DataFrame:
    """Adds ``reason`` and ``label`` from the teacher's JSON; keeps rows with a reason and a known label."""
    parsed = df.select("*", F.explode(F.array(F.from_json(F.col(json_col), "reason string, label string"))).alias("__a"))  # parsed once, the filter included
    return (parsed.withColumn("reason", F.col("__a.reason")).withColumn("label", F.col("__a.label"))
            .drop("__a").filter(F.col("reason").isNotNull() & F.col("label").isin(*labels)))


def join_teacher(df: DataFrame, annotations: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds ``teacher_reason`` and ``teacher_label`` by id."""
    ann = annotations.select(id_col, F.col("reason").alias("teacher_reason"), F.col("label").alias("teacher_label"))
    return df.join(ann, id_col)


def encode_label(col: Column | str) -> Column:
    """Label to its fixed id; an unknown label is null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.create_map(*[F.lit(x) for kv in LABEL_IDS.items() for x in kv])[c]


def decode_label(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.create_map(*[F.lit(x) for name, i in LABEL_IDS.items() for x in (i, name)])[c]


def class_ids(df: DataFrame, col: str, out: str = "labels") -> DataFrame:
    """``(value, id)`` of every value found, numbered from 0 in sorted order, without a global window.

    The values are sorted by range; each task numbers its own from the count of those before, one number per range.
    """
    values = df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).withColumn("part", F.spark_partition_id())
    values = materialise(values, "classes")
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = values.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))
    within = F.row_number().over(W.partitionBy("part").orderBy(col))
    return values.withColumn("within", within).join(ranges, "part").select(col, (F.col("before") + F.col("within") - 1).cast("int").alias(out))


def class_encode(df: DataFrame, col: str, out: str = "labels") -> DataFrame:
    """Values to consecutive ids in sorted order, for any number of values; null stays null."""
    return df.join(class_ids(df, col, out), col, "left").select(*df.columns, out)
