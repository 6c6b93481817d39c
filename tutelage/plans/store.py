"""Scorers kept for other jobs: counts, labels, synonyms, prior and a digest, by version.

A version is one commit (``sources.commits``), so it is there whole or not at all. Loading checks the digest over the counts and, if
the caller names labels, their order: scores are arrays in label order, and another order would swap classes without a word.
Priors of models that cannot be written themselves are kept alone, by model key and version.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.operators.countlm import CountLM
from tutelage.plans.scorer import CountScorer
from tutelage.sources import commits

COUNTS = "token string, c array<bigint>"


def digest(counts: DataFrame) -> str:
    """The same for the same rows in any order."""
    row = counts.agg(F.count("*").alias("n"), F.sum(F.xxhash64("token", "c").cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h'] or 0}"


def _run(key: str, version: str) -> str:
    if "/" in key + version or "@" in key + version:
        raise ValueError("keys and versions hold neither / nor @")
    return f"{key}@{version}"


def latest_version(spark: SparkSession, root: str, key: str) -> str:
    """The version of ``key`` that was committed last."""
    own = commits.manifests(spark, root).filter(F.col("run_id").startswith(f"{key}@"))
    last = own.agg(F.max(F.struct("at", "run_id")).alias("m")).first()["m"]
    if last is None:
        raise FileNotFoundError(f"no version of {key} in {root}")
    return last["run_id"].removeprefix(f"{key}@")


def _settings(spark: SparkSession, root: str, key: str, version: str | None) -> tuple[dict, dict[str, str], str]:
    """What was stored of a version, or of the latest one."""
    version = latest_version(spark, root, key) if version is None else version
    found = commits.folders(spark, root, _run(key, version))
    if not found:
        raise FileNotFoundError(f"no version {version} of {key} in {root}")
    return json.loads(spark.read.text(found["settings"], wholetext=True).first()["value"]), found, version


def _write_settings(spark: SparkSession, settings: Mapping[str, object], path: str) -> None:
    spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "value string").coalesce(1).write.text(path)


def save_scorer(scorer: CountScorer, root: str, key: str, version: str) -> None:
    """Store a count scorer; a version that is there already stays as it is."""
    lm, spark = scorer.lm, scorer.lm.counts.sparkSession
    settings = {"labels": list(scorer.labels), "names": list(lm.labels), "synonyms": scorer.synonyms and {k: list(v) for k, v in scorer.synonyms.items()}, "across": scorer.across,
                "prior": scorer.prior, "n": list(lm.n), "v": lm.v, "token_bytes": lm.token_bytes, "digest": digest(lm.counts)}
    commits.write_run(spark, root, _run(key, version), {"counts": lambda p: lm.counts.write.parquet(p), "settings": lambda p: _write_settings(spark, settings, p)})


def check_labels(stored: Sequence[str], wanted: Sequence[str] | None) -> None:
    if wanted is not None and list(stored) != list(wanted):
        raise ValueError(f"stored for the labels {list(stored)}, asked for {list(wanted)}")


def load_scorer(spark: SparkSession, root: str, key: str, version: str | None = None, labels: Sequence[str] | None = None) -> CountScorer:
    """A stored count scorer, of a version or the latest; batch and stream read the same."""
    s, found, version = _settings(spark, root, key, version)
    check_labels(s["labels"], labels)
    counts = spark.read.schema(COUNTS).parquet(found["counts"])
    if digest(counts) != s["digest"]:
        raise ValueError(f"the counts of {key} {version} are not those that were stored")
    lm = CountLM(counts, tuple(s["names"]), tuple(s["n"]), s["v"], s["token_bytes"])
    return CountScorer(lm, tuple(s["labels"]), s["prior"], s["synonyms"], s["across"], version)


def save_prior(spark: SparkSession, root: str, key: str, version: str, prior: Mapping[str, float], labels: Sequence[str]) -> None:
    """Keep the prior of a model that lives elsewhere."""
    settings = {"labels": list(labels), "prior": dict(prior)}
    commits.write_run(spark, root, _run(key, version), {"settings": lambda p: _write_settings(spark, settings, p)})


def load_prior(spark: SparkSession, root: str, key: str, version: str | None = None, labels: Sequence[str] | None = None) -> dict[str, float]:
    s, _, _ = _settings(spark, root, key, version)
    check_labels(s["labels"], labels)
    return s["prior"]
