"""Token arrays: truncation, prompt masks, padding, length and step reports.

All row-local. Token ids are hashed, so no dictionary has to be built or shipped; a sub-word
tokeniser enters as ``fn``, a function from a list of texts to a list of id lists, called on
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutelage.functions.constants import IGNORE_INDEX, MAX_LEN, WARMUP_SHARE
from tutelage.functions.text import supervised_text, token_id, tokens

VOCAB_SIZE = 50_000

Tokenizer = Callable[[Sequence[str]], Sequence[Sequence[int]]]


def token_ids(text: Column | str, max_len: int, fn: Tokenizer | None = None, vocab_size: int = VOCAB_SIZE) -> Column:
    """The first ``max_len`` token ids of a text."""
    if fn is None:
        return F.transform(F.slice(tokens(text), 1, max_len), lambda t: token_id(t, vocab_size))

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series([list(ids)[:max_len] for ids in fn(texts.tolist())], index=texts.index)

    return encode(F.col(text) if isinstance(text, str) else text)


def tokenize(df: DataFrame, col: str = "text", max_len: int = MAX_LEN, fn: Tokenizer | None = None) -> DataFrame:
    """Adds ``input_ids``."""
    return df.withColumn("input_ids", token_ids(col, max_len, fn))


def mask_prompt(df: DataFrame, prompt_col: str = "prompt", target_col: str = "target", max_len: int = MAX_LEN,
                fn: Tokenizer | None = None) -> DataFrame:
    """Adds ``input_ids``, ``attention_mask`` and ``labels`` of prompt + blank line + target.

    Labels of the prompt's positions carry no loss. A prompt that fills ``max_len`` alone
    leaves no supervised position.
    """
    out = (df.withColumn("input_ids", token_ids(supervised_text(prompt_col, target_col), max_len, fn))
           .withColumn("__p", F.size(token_ids(prompt_col, max_len, fn))))
    n_masked = F.least(F.col("__p"), F.size("input_ids"))
    labels = F.concat(F.array_repeat(F.lit(IGNORE_INDEX), n_masked),
                      F.slice("input_ids", F.col("__p") + 1, F.size("input_ids")))
    return (out.withColumn("labels", labels)
            .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))).drop("__p"))


def pad(df: DataFrame, max_len: int, pad_id: int = 0) -> DataFrame:
    """``input_ids`` cut or filled up to ``max_len``, with the mask that says which are real."""
    missing = F.lit(max_len) - F.size("input_ids")
    return (df.withColumn("input_ids", F.slice("input_ids", 1, max_len)).withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.size("input_ids")),
                                                     F.array_repeat(F.lit(0), missing)))
            .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), missing))))


def length_report(df: DataFrame, prompt_col: str = "prompt", target_col: str = "target", max_len: int = MAX_LEN,
                  batch: int = 2, accum: int = 8, epochs: int = 1, max_steps: int = 0,
                  fn: Tokenizer | None = None) -> DataFrame:
    """One row: lengths before truncation, what truncation costs, and the optimiser steps that follow.

    ``percentile`` keeps one counter per distinct length, not per row.
    """
    if fn is None:
        n_prompt, n_full = F.size(tokens(prompt_col)), F.size(tokens(supervised_text(prompt_col, target_col)))
    else:
        longest = 2**31 - 1
        n_prompt = F.size(token_ids(prompt_col, longest, fn))
        n_full = F.size(token_ids(supervised_text(prompt_col, target_col), longest, fn))
    lengths = df.select(n_prompt.alias("p"), n_full.alias("t"))
    report = lengths.agg(
        F.count("*").alias("n"),
        F.min("t").alias("min_len"),
        F.avg("t").alias("avg_len"),
        F.percentile("t", F.lit(0.5)).alias("p50_len"),
        F.percentile("t", F.lit(0.95)).alias("p95_len"),
        F.max("t").alias("max_len"),
        F.count_if(F.col("t") > max_len).alias("n_truncated"),
        F.count_if(F.least("p", F.lit(max_len)) >= F.least("t", F.lit(max_len))).alias("n_unsupervised"),
    )
    return step_counts(report, "n", batch, accum, epochs, max_steps)


def step_counts(df: DataFrame, n_col: str, batch: int, accum: int, epochs: int, max_steps: int = 0) -> DataFrame:
    """Adds batches, steps per epoch, total steps (``max_steps`` wins when set) and warm-up steps."""
    per_epoch = F.ceil(F.col("n_batches") / accum)
    total = F.lit(max_steps).cast("long") if max_steps > 0 else F.col("steps_per_epoch") * epochs
    return (df.withColumn("n_batches", F.ceil(F.col(n_col) / batch))
            .withColumn("steps_per_epoch", per_epoch)
            .withColumn("total_steps", total)
            .withColumn("warmup_steps", F.floor(F.col("total_steps") * WARMUP_SHARE)))
