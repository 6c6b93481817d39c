"""A student classifier taught by the teacher's labels, on ``pyspark.ml``."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutelage.functions.constants import SAMPLE_SEED, STUDENT_MAX_LEN
from tutelage.functions.text import first_words
from tutelage.operators.datasets import decode_label, encode_label
from tutelage.operators.metrics import summary
from tutelage.operators.sampling import split_column


def student_inputs(df: DataFrame, text_col: str = "question", label_col: str = "teacher_label", test_frac: float = 0.2,
                   seed: int = SAMPLE_SEED, max_len: int = STUDENT_MAX_LEN) -> DataFrame:
    """Rows with a known label, their text cut to the student's ``max_len`` words, their ``split`` and the coded ``label``."""
    coded = df.withColumn(text_col, first_words(text_col, max_len)).withColumn("label", encode_label(label_col).cast("double"))
    return split_column(coded.filter(F.col("label").isNotNull()), test_frac, seed)


def train_student(df: DataFrame, text_col: str = "question", label_col: str = "teacher_label", test_frac: float = 0.2,
                  n_features: int = 1 << 16, max_iter: int = 20, seed: int = SAMPLE_SEED, max_len: int = STUDENT_MAX_LEN) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline and the rows it was not shown (exactly ``ceil(test_frac * n)``).

    Features are hashed, so no vocabulary grows with the corpus; the fit is a distributed gradient
    over the training rows.
    """
    marked = student_inputs(df, text_col, label_col, test_frac, seed, max_len)
    train = marked.filter(F.col("split") == "train").persist()
    stages = [RegexTokenizer(inputCol=text_col, outputCol="words", pattern=r"\s+"),
              HashingTF(inputCol="words", outputCol="tf", numFeatures=n_features),
              IDF(inputCol="tf", outputCol="features"),
              LogisticRegression(family="multinomial", maxIter=max_iter, regParam=0.01)]
    try:
        model = Pipeline(stages=stages).fit(train)
    finally:
        train.unpersist()
    return model, marked.filter(F.col("split") == "test").drop("split")


def student_predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` as a label name."""
    drop = ("words", "tf", "features", "rawPrediction", "probability", "prediction", "label")
    out = model.transform(df).withColumn("student_label", decode_label(F.col("prediction").cast("int")))
    return out.drop(*drop).withColumnRenamed("student_label", "prediction")


def student_report(predicted: DataFrame) -> DataFrame:
    """Accuracy and macro-F1 of the student against the teacher it learnt from and against gold,
    and of the teacher against gold: three different questions, told apart by ``compared``."""
    rows = predicted.select(F.inline(F.array(
        *[F.struct(F.lit(name).alias("compared"), F.col(t).alias("answer"), F.col(p).alias("prediction"))
          for name, t, p in (("student vs teacher", "teacher_label", "prediction"), ("student vs gold", "answer", "prediction"),
                             ("teacher vs gold", "answer", "teacher_label"))])))
    return summary(rows, by=("compared",)).select("compared", "accuracy", "n", "macro_f1")
