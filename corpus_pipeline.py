"""From raw documents to packed sequences: toxicity, near copies, benchmark passages, personal data, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and keeps the session's batches small (``frames.lean``). All but the last return the columns of ``documents``.

Defined cases, in every stage: null and empty texts are clean, private to nobody and one token long, and all of them are copies of each other; a null id is kept, behind all
others where the least id decides; rows that repeat are copies; ties in a group of copies go to the least id; extra columns pass whatever they are called; empty tables give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.llm import decontamination, packing, privacy, simhash, toxicity
from tutelage.llm.frames import free, lean, materialise, table

#: No stage but the filters by word windows has a form in SQL, so the whole has none.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 under a model trained on the labelled ones."""
    lean(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic")
    out = free(docs.columns, "toxicity")
    scored = toxicity.score(docs, model, keep=tuple(docs.columns), out=out)
    return scored.filter(F.col(out) < 0.7).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    lean(spark)
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    lean(spark)
    out = free(docs.columns, "contamination")
    marked = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), window=10, out=out)
    return marked.filter(F.col(out)["n_hit"] == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates under the key of ``privacy.secret``; ``n_chars``, if there, follows the text."""
    lean(spark)
    out = free(docs.columns, "entities")
    replaced = privacy.replace(docs, privacy.secret(spark), out=out)
    if "n_chars" in docs.columns:
        longer = F.when(F.size(out) > 0, F.length("text")).otherwise(F.col("n_chars"))
        replaced = replaced.withColumn("n_chars", longer.cast(docs.schema["n_chars"].dataType))
    return replaced.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4,096 tokens in their sequences."""
    lean(spark)
    return packing.pack(packing.tokenise(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False, crc=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_private),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
