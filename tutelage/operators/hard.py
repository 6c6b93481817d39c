"""Near misses of a scorer and preference pairs against its strongest wrong label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutelage.functions import scores as S
from tutelage.functions.constants import LABELS
from tutelage.functions.text import parse_sections

MARGIN = 0.1


def _others(scores: Column, answer: Column, labels: Sequence[str]) -> Column:
    return F.zip_with(scores, F.array(*[F.lit(lab) for lab in labels]), lambda s, lab: F.when(lab != answer, s))


def rival(scores: Column, answer: Column, labels: Sequence[str] = LABELS) -> Column:
    """The best label that is not the answer; a tie goes to the earlier one."""
    return S.argmax_label(_others(scores, answer, labels), labels)


def gap(scores: Column, answer: Column, labels: Sequence[str] = LABELS) -> Column:
    """Score of the answer less that of its rival: below zero where the prediction is wrong, minus infinity where the answer has no score."""
    own = F.try_element_at(scores, F.nullif(F.array_position(F.array(*[F.lit(lab) for lab in labels]), answer), F.lit(0)).cast("int"))
    return F.when(own == S.NEG_INF, own).otherwise(own - F.array_max(_others(scores, answer, labels)))


def hard_examples(df: DataFrame, answer: str = "answer", margin: float = MARGIN, labels: Sequence[str] = LABELS) -> DataFrame:
    """Rows of ``df`` (``scores`` in label order) that are wrong or right by less than ``margin``, with ``rival`` and ``gap``.

    Rows whose answer is null or no label are left out. Row-local: no shuffle.
    """
    truth = F.col(answer)
    marked = df.filter(truth.isin(list(labels))).withColumns({"rival": rival(F.col("scores"), truth, labels), "gap": gap(F.col("scores"), truth, labels)})
    return marked.filter(F.col("gap") < margin)


def hard_pairs(df: DataFrame, prompt: Column, answer: str = "answer", margin: float = MARGIN, labels: Sequence[str] = LABELS) -> DataFrame:
    """``(id, prompt, chosen, rejected)``: preference rows of the hard examples; rejected is the model's best wrong label."""
    return hard_examples(df, answer, margin, labels).select("id", prompt.alias("prompt"), F.col(answer).alias("chosen"), F.col("rival").alias("rejected"))


def code_conformance(df: DataFrame, text: str = "generated") -> DataFrame:
    """One row: the shares of answers with a plan, with code, with the plan before the code, with empty code, and with plan and filled code in order.

    A null answer has none of them. All shares are null for an empty table.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    parts = df.select(parse_sections(t).alias("s"), (F.instr(t, "<PLAN>") < F.instr(t, "<CODE>")).alias("before"))
    plan, code = F.col("s.plan").isNotNull(), F.col("s.code").isNotNull()
    filled = code & (F.col("s.code") != "")
    checks = {"plan_rate": plan, "code_rate": code, "order_rate": plan & code & F.col("before"), "empty_code_rate": code & (F.col("s.code") == ""),
              "conforming_rate": plan & filled & F.col("before")}
    share = [F.avg(F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)).alias(name) for name, c in checks.items()]
    return parts.agg(F.count(F.lit(1)).alias("num_examples"), *share)
