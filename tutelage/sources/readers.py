"""Readers. Schemas are declared, never inferred; any Hadoop path works (``s3a://``, ``hdfs://``, files)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.sources.ranges import json_elements, numbered_lines

LABELED = "question string, answer string"
SFT = "input string, output string"
KD = "input string, teacher_output string, teacher_logits_path string"
DPO = "prompt string, chosen string, rejected string"


def parsed(rows: DataFrame, schema: str) -> DataFrame:
    """``position`` and the columns of ``schema`` from the JSON texts ``value``; a text that is not JSON gives nulls."""
    return rows.select("position", F.explode(F.array(F.from_json("value", schema))).alias("r")).select("position", "r.*")


def read_labeled(spark: SparkSession, path: str | list[str], id_col: str | None = None, lines: bool = False) -> DataFrame:
    """``(id, question, answer)`` from JSON array files, or from one object per line (``lines``).

    A file of either kind is read by as many tasks as it has splits. Without ``id_col`` in the data the id is the
    place of the element, or the number of the line, counted over the files in name order.
    """
    schema = LABELED if id_col is None else f"{id_col} bigint, {LABELED}"
    if lines and id_col is not None:
        return spark.read.schema(schema).json(path).select(F.col(id_col).alias("id"), "question", "answer")
    rows = parsed(numbered_lines(spark, path) if lines else json_elements(spark, path), schema)
    return rows.select(F.col("position" if id_col is None else id_col).alias("id"), "question", "answer")


def read_set(spark: SparkSession, path: str | list[str], schema: str, numbered: bool = False) -> DataFrame:
    """A set of one object per line; ``numbered`` adds the number of the line as ``id``, which evaluation needs for its first n."""
    if not numbered:
        return spark.read.schema(schema).json(path)
    return parsed(numbered_lines(spark, path), schema).withColumnRenamed("position", "id")


def read_sft(spark: SparkSession, path: str | list[str], numbered: bool = False) -> DataFrame:
    return read_set(spark, path, SFT, numbered)


def read_kd(spark: SparkSession, path: str | list[str], numbered: bool = False) -> DataFrame:
    """``teacher_logits_path`` may be missing; nothing uses it yet."""
    return read_set(spark, path, KD, numbered)


def read_dpo(spark: SparkSession, path: str | list[str], numbered: bool = False) -> DataFrame:
    return read_set(spark, path, DPO, numbered)


def read_schema(spark: SparkSession, path: str) -> dict:
    """A JSON Schema file: one small document, wanted on the driver because checks are planned from it."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


READERS = {"sft": read_sft, "kd": read_kd, "dpo": read_dpo}
