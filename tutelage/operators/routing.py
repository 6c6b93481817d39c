"""Which model answers a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutelage.functions import constants as K
from tutelage.operators.joins import join_lookup


def model_key(flow: Column | str, method: Column | str, run_id: Column | str) -> Column:
    run = F.col(run_id) if isinstance(run_id, str) else run_id
    return F.concat_ws("_", flow, method, F.substring(run, 1, 8))


def default_base_by_flow(flow: Column) -> Column:
    return _lookup(flow, K.DEFAULT_BASE_BY_FLOW, F.lit(K.DEFAULT_BASE_OTHER_FLOW))


def default_base_by_method(method: Column) -> Column:
    return _lookup(method, K.DEFAULT_BASE_BY_METHOD, F.lit(None).cast("string"))


def route_models(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds ``model_key`` and ``base_model`` to ``requests(flow, method, run_id, ...)``.

    A request that names a run gets that run's key if the registry has it, else none. Without a
    run it gets the first loaded model of its flow. ``registry(model_key, flow, load_order)``.
    """
    first = registry.groupBy("flow").agg(F.min_by("model_key", "load_order").alias("__first"))
    known = registry.select(F.col("model_key").alias("__key"), F.lit(True).alias("__known")).distinct()
    asked = requests.withColumn("__key", F.when(F.col("run_id").isNotNull(), model_key("flow", "method", "run_id")))
    found = join_lookup(join_lookup(asked, known, "__key"), first, "flow")
    chosen = F.when(F.col("run_id").isNull(), F.col("__first")).when(F.col("__known"), F.col("__key"))
    return (found.withColumn("model_key", chosen).withColumn("base_model", default_base_by_flow(F.col("flow")))
            .drop("__key", "__known", "__first"))


def _lookup(col: Column, table: dict[str, str], other: Column) -> Column:
    out = other
    for k, v in table.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out
