"""Scoring a stream of requests with the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tutelage.plans.scorer import Scorer
from tutelage.plans.store import latest_version, load_scorer


def once(requests: DataFrame, id_cols: Sequence[str], ts_col: str = "ts", within: str = "1 hour") -> DataFrame:
    """Requests without those whose id came before, as streaming state that forgets ids ``within`` after the latest time seen.

    A request later than that is let go by the state, as it cannot be told from a repeated one (``kpi.late_rows`` counts them). Ids of requests
    without a time have no moment to be forgotten at: they are kept apart, for good.
    """
    timed, untimed = requests.filter(F.col(ts_col).isNotNull()), requests.filter(F.col(ts_col).isNull())
    return timed.withWatermark(ts_col, within).dropDuplicatesWithinWatermark(list(id_cols)).union(untimed.dropDuplicates(list(id_cols)))


def score_stream(requests: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                 trigger: dict | None = None, id_cols: Sequence[str] = (), ts_col: str = "ts", within: str = "1 hour") -> StreamingQuery:
    """Score every micro-batch with ``score`` (any batch plan) and write it to ``out``.

    A batch goes to its own ``batch_id`` partition in overwrite mode, so a batch that is run again after
    a failure replaces itself: exactly once. Offsets live in ``checkpoint``, a shared folder. With ``id_cols`` a request that
    is sent again is answered once (``once``).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    rows = once(requests, id_cols, ts_col, within) if id_cols else requests
    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def stored_score(root: str, key: str, features_col: str, keys: Sequence[str], labels: Sequence[str] | None = None) -> Callable[[DataFrame], DataFrame]:
    """A ``score`` that looks up the latest version of a stored scorer for each micro-batch, so that a new model or prior takes effect without a restart.

    The answers carry the version that gave them (``Scorer.audit``). A version is loaded once and kept until another one is stored.
    """
    held: dict[str, Scorer] = {}

    def score(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        version = latest_version(spark, root, key)
        if version not in held:
            held.clear()
            held[version] = load_scorer(spark, root, key, version, labels)
        return held[version].audit(batch, features_col, keys)

    return score
