"""Batch inference: a Python model over a table, loaded once per worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_batch(df: DataFrame, make_predict_fn: Callable, inputs: Sequence[Column | str], output_col: str,
                return_type: T.DataType, batch_size: int = 64, **kw) -> DataFrame:
    """Adds ``output_col``: ``make_predict_fn()`` loads the model and returns a function on numpy batches.

    Array inputs need their ``input_tensor_shapes``. Generation settings (new tokens, temperature, nucleus share) belong to the caller's function.
    """
    predict = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size, **kw)
    return df.withColumn(output_col, predict(*inputs))


def score_candidates(df: DataFrame, make_score_fn: Callable, prompt_col: str = "prompt", candidate_col: str = "candidate",
                     batch_size: int = 64) -> DataFrame:
    """Adds ``score`` and ``n_tokens``: the mean log-probability of a candidate after its prompt.

    ``make_score_fn()`` loads a model and returns a function of two numpy string arrays giving
    ``{"sum_logprob": floats, "n_tokens": ints}``. A candidate of no tokens has no score.
    """
    kind = T.StructType([T.StructField("sum_logprob", T.DoubleType()), T.StructField("n_tokens", T.LongType())])
    scored = infer_batch(df, make_score_fn, [prompt_col, candidate_col], "__s", kind, batch_size)
    n = F.col("__s.n_tokens")
    return scored.withColumn("n_tokens", n).withColumn("score", F.when(n > 0, F.col("__s.sum_logprob") / n)).drop("__s")


def budgeted(lengths: Sequence[int], budget: int, most: int) -> Iterator[list[int]]:
    """Places of ``lengths`` in batches, shortest first: a batch's size times its longest is at most ``budget`` (one longer item goes alone), its size at most ``most``.

    Items of a batch are about as long, so little of it is padding.
    """
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        if batch and (lengths[i] * (len(batch) + 1) > budget or len(batch) == most):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def score_grouped(df: DataFrame, make_model: Callable, candidates: Sequence[Mapping[str, object]], prompt_col: str = "prompt",
                  token_budget: int = 16_384, batch_rows: int = 256, window: int = 4096) -> DataFrame:
    """Every row of ``df`` once per candidate with ``score`` and ``n_tokens``, each prompt evaluated once for all its candidates.

    ``make_model()`` loads a model once per worker, with ``tokenize(texts)`` (lists of token ids), ``prefix(batch)`` (a state
    for a padded batch of prompts, given as lists of ids) and ``continue_(state, ids)`` (for every prompt of the state the summed log-probability of one candidate's ids).
    Rows are gathered up to ``window`` (the rows of one Arrow batch), sorted by length and cut into batches of at most ``token_budget`` padded tokens and ``batch_rows``
    prompts. Other columns of ``df`` are kept, but for the prompt; a candidate of no tokens has no score; a null prompt counts as empty.
    """
    cells = [k for k in candidates[0] if k != "candidate"]
    kinds = {k: T.StringType() if isinstance(candidates[0][k], str) else T.IntegerType() for k in cells}
    rest = [c for c in df.columns if c != prompt_col]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(k, kinds[k]) for k in cells] + [T.StructField("score", T.DoubleType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        endings = model.tokenize([str(c["candidate"]) for c in candidates])
        for whole in batches:
            for at in range(0, whole.num_rows, window):
                part = whole.slice(at, window)
                prompts = model.tokenize([p or "" for p in part.column(prompt_col).to_pylist()])
                total: list[list[float | None]] = [[None] * part.num_rows for _ in candidates]
                for places in budgeted([len(p) for p in prompts], token_budget, batch_rows):
                    state = model.prefix([prompts[i] for i in places])
                    for k, ids in enumerate(endings):
                        if ids:
                            for i, s in zip(places, model.continue_(state, ids), strict=True):
                                total[k][i] = float(s) / len(ids)
                for k, c in enumerate(candidates):
                    n = part.num_rows
                    told = [pa.array([c[name]] * n, pa.string() if isinstance(c[name], str) else pa.int32()) for name in cells]
                    yield pa.RecordBatch.from_arrays([*[part.column(x) for x in rest], *told, pa.array(total[k], pa.float64()), pa.array([len(endings[k])] * n, pa.int64())], names=schema.fieldNames())

    return df.select(*rest, prompt_col).mapInArrow(run, schema)
