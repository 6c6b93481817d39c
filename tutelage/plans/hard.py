"""Queries on hard examples, preference pairs against the strongest wrong label, and the form of code answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.operators import hard as H
from tutelage.plans import tables as T
from tutelage.plans.evaluate import PREDICTED
from tutelage.plans.rank import scored
from tutelage.plans.registry import query

_HARD = PREDICTED + """,
rival AS (SELECT c.example_id AS id, o.answer, max(c.score) FILTER (c.label = o.answer) AS own, max(c.score) FILTER (c.label <> o.answer) AS best,
    arg_min(c.label, row(-c.score, c.place)) FILTER (c.label <> o.answer) AS rival
  FROM cal c JOIN order_labels o ON o.id = c.example_id GROUP BY ALL),
hard AS (SELECT *, CASE WHEN own < -1e300 THEN own ELSE own - best END AS gap FROM rival WHERE own < -1e300 OR own - best < 0.1)"""


def _answered(spark: SparkSession, d: str) -> DataFrame:
    rows = scored(spark, d).select(F.col("example_id").alias("id"), "scores")
    return rows.join(T.order_labels(spark, d), "id")


@query("c12_hard_examples", f"WITH {_HARD} SELECT id, answer, rival, CASE WHEN abs(gap) < 1e300 THEN round(gap, 6) END AS gap FROM hard")
def c12_hard_examples(spark: SparkSession, d: str) -> DataFrame:
    found = H.hard_examples(_answered(spark, d))
    return found.select("id", "answer", "rival", F.when(F.abs("gap") < 1e300, F.round("gap", 6)).alias("gap"))


@query("c12_hard_pairs", f"WITH {_HARD} SELECT id, 'Order ' || id AS prompt, answer AS chosen, rival AS rejected FROM hard")
def c12_hard_pairs(spark: SparkSession, d: str) -> DataFrame:
    return H.hard_pairs(_answered(spark, d), F.concat(F.lit("Order "), F.col("id")))


@query("f15_code_conformance", f"""WITH {T.SQL_PAIRS}, k AS (SELECT turn % 4 AS k, output FROM turn_pairs)
SELECT count(*) AS num_examples, round(avg(CASE WHEN k < 3 THEN 1.0 ELSE 0.0 END), 6) AS plan_rate, round(avg(CASE WHEN k > 0 THEN 1.0 ELSE 0.0 END), 6) AS code_rate,
  round(avg(CASE WHEN k = 1 THEN 1.0 ELSE 0.0 END), 6) AS order_rate, round(avg(CASE WHEN k > 0 AND output = '' THEN 1.0 ELSE 0.0 END), 6) AS empty_code_rate,
  round(avg(CASE WHEN k = 1 AND output <> '' THEN 1.0 ELSE 0.0 END), 6) AS conforming_rate FROM k""")
def f15_code_conformance(spark: SparkSession, d: str) -> DataFrame:
    """Answers derived from the turns: plan only, plan before code, code before plan, code only."""
    plan, code, k = F.lit("<PLAN>\nsteps\n</PLAN>\n"), F.concat(F.lit("<CODE>\n"), "output", F.lit("\n</CODE>\n")), F.col("turn") % 4
    answers = T.pairs(spark, d).select(F.when(k == 0, plan).when(k == 1, F.concat(plan, code)).when(k == 2, F.concat(code, plan)).otherwise(code).alias("generated"))
    found = H.code_conformance(answers)
    return found.select("num_examples", *[F.round(c, 6).alias(c) for c in found.columns if c != "num_examples"])
