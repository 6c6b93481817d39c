"""The jobs end to end: prepare, annotate, evaluate, report. Each is a few operators in a row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.functions import constants as K
from tutelage.functions import templates as P
from tutelage.functions.jsontext import extract_json
from tutelage.functions.text import strip_prompt
from tutelage.operators import datasets, evaluation, metrics, routing, sampling
from tutelage.operators.countlm import CountLM
from tutelage.operators.extraction import validate_json
from tutelage.operators.inference import infer_batch
from tutelage.plans.scorer import Scorer
from tutelage.session import materialise
from tutelage.sources import readers, sinks


def prepare(spark: SparkSession, src: str, outdir: str, per_class: int | None = None, seed: int = K.BALANCE_SEED,
            name: str = "", id_col: str | None = None, lines: bool = False) -> dict[str, str]:
    """Labelled file in, balanced SFT, KD and DPO sets out. Returns their paths."""
    rows = readers.read_labeled(spark, src, id_col, lines)
    return sinks.write_distill_sets(datasets.build_sets(rows, per_class, seed, written=True), outdir, name)


@dataclass
class ClassifierEvaluation:
    """``rows(id, answer, prediction, ...)`` and the frames reported on them."""

    rows: DataFrame
    original: DataFrame
    labels: DataFrame
    report: DataFrame
    confusion: DataFrame


def evaluate_classifier(df: DataFrame, scorer: Scorer, frac: float = 0.1, per_class: int | None = None, seed: int = K.BALANCE_SEED,
                        trained_on: DataFrame | None = None) -> ClassifierEvaluation:
    """Balanced validation rows through a calibrated scorer. The predictions are written once and
    read by every report, so that no model is asked twice."""
    val = sampling.balanced_val(df, frac, per_class, seed, scorer.labels, exclude=trained_on)
    rows = materialise(scorer.predict(val, "question", ("id", "answer")), "predictions")
    return ClassifierEvaluation(rows, sampling.class_distribution(sampling.valid_labels(df, scorer.labels), labels=scorer.labels),
                                metrics.label_counts(rows), metrics.full_report(rows, scorer.labels), metrics.confusion(rows, scorer.labels))


def evaluate_generation(df: DataFrame, training_type: str, model_dir: str, idp_mode: bool = False, limit: int = 0, lm: CountLM | None = None,
                        make_generate_fn: Callable | None = None, run_id: str | None = None, runs: str | None = None,
                        params: dict[str, object] | None = None) -> tuple[DataFrame, DataFrame]:
    """Results and metrics of one training method.

    The model's text comes from ``make_generate_fn`` (prompts in, prompt and continuation out), or is already there
    as ``generated``. Results are written next to the model and read back, so no text is generated twice; metrics
    (and parameters) go to the run table if one is named. ``limit`` is the evaluator's plain first-n.
    """
    examples = sampling.head_n(df, limit)
    if make_generate_fn is not None:
        prompts = examples.withColumn("__p", P.format_prompt(evaluation.INPUT_COL[training_type], training_type, idp_mode))
        examples = materialise(infer_batch(prompts, make_generate_fn, ["__p"], "generated", T.StringType()).drop("__p"), "generated")
    rows = evaluation.eval_rows(examples, training_type, idp_mode, lm)
    path = sinks.write_results(rows, model_dir, training_type)
    stored = df.sparkSession.read.schema(rows.schema).json(path)
    found = evaluation.eval_metrics(stored, training_type)
    if runs is not None:
        sinks.log_run(evaluation.metric_rows(found), run_id or training_type, runs)
        settings = {"model_dir": model_dir, "training_type": training_type, "idp_mode": idp_mode, **(params or {})}
        spark = df.sparkSession
        sinks.log_run(spark.createDataFrame([(k, str(v)) for k, v in settings.items()], "key string, value string"), run_id or training_type, runs, "param")
    return stored, found


def evaluate_file(spark: SparkSession, src: str, training_type: str, model_dir: str, limit: int = 0, generated: bool = False, **kw) -> tuple[DataFrame, DataFrame]:
    """``evaluate_generation`` of a file of examples, one object per line; ``limit`` takes its first lines.

    ``generated``: the file brings the model's text along. The results keep the line number as ``id``.
    """
    schema = {"sft": readers.SFT, "kd": readers.KD, "dpo": readers.DPO}[training_type]
    examples = readers.read_set(spark, src, f"{schema}, generated string" if generated else schema, numbered=True)
    return evaluate_generation(examples, training_type, model_dir, limit=limit, **kw)


def answer_requests(requests: DataFrame, registry: DataFrame, make_generate_fn: Callable, text_col: str = "text") -> DataFrame:
    """Served answers of ``requests(flow, method, run_id, text, ...)``: route, prompt, generate, take the prompt off.

    ``make_generate_fn()`` gives a function of two arrays, model keys and prompts, so that it can hold several models. A request without
    a model gets a null answer.
    """
    routed = routing.route_models(requests, registry).withColumn("__p", P.served_prompt(text_col, F.col("flow")))
    answered = infer_batch(routed.filter(F.col("model_key").isNotNull()), make_generate_fn, ["model_key", "__p"], "__g", T.StringType())
    answered = answered.withColumn("response", strip_prompt("__g", "__p")).drop("__g", "__p")
    unanswered = routed.filter(F.col("model_key").isNull()).drop("__p").withColumn("response", F.lit(None).cast("string"))
    return answered.unionByName(unanswered)


def extract_documents(df: DataFrame, schema: Mapping[str, Any], make_generate_fn: Callable, text_col: str = "text") -> DataFrame:
    """Documents through an extraction model: adds ``generated``, its JSON (``json``) and what that breaks of the schema."""
    prompts = df.withColumn("__p", P.idp_infer_prompt(text_col))
    out = infer_batch(prompts, make_generate_fn, ["__p"], "generated", T.StringType()).drop("__p")
    return validate_json(out.withColumn("json", extract_json("generated")), "generated", schema)


def annotation_requests(df: DataFrame, per_class: int, shots: int = 2, seed: int = K.SAMPLE_SEED,
                        classes: Sequence[str] = K.FEW_SHOT_ORDER) -> DataFrame:
    """``(id, question, answer, system_prompt, user_prompt)`` for a teacher: ``per_class`` rows of each class, and
    exemplars drawn from the rows that are not among them."""
    sample = sampling.stratified_n(df.filter(F.col("answer").isin(*classes)), per_class, seed)
    exemplars = sampling.few_shot_sample(sampling.remainder(df, sample), shots, seed, classes)
    system = P.few_shot_prompt(exemplars, classes=classes)
    return sample.select("id", "question", "answer", system.scalar().alias("system_prompt"), P.teacher_user_prompt("question").alias("user_prompt"))
