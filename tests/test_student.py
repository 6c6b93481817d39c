from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.operators import student
from tutelage.operators.inference import infer_batch


def test_student_learns_the_teacher(spark):
    words = F.when(F.col("id") % 3 == 0, "alpha beta").when(F.col("id") % 3 == 1, "gamma delta").otherwise("epsilon zeta")
    teacher = F.when(F.col("id") % 3 == 0, "Good").when(F.col("id") % 3 == 1, "Standard").otherwise("Bad")
    df = spark.range(150).select("id", words.alias("question"), teacher.alias("teacher_label"), F.when(F.col("id") < 75, teacher).otherwise("Bad").alias("answer"))
    model, held = student.train_student(df, n_features=256)
    rows = student.student_predict(model, held).persist()
    assert rows.count() == 30
    report = {r["compared"]: r for r in student.student_report(rows).collect()}
    assert report["student vs teacher"]["accuracy"] == 1.0
    assert report["teacher vs gold"]["accuracy"] == report["student vs gold"]["accuracy"] < 1.0


def test_infer_batch_loads_once_and_keeps_order(spark):
    def load():
        import numpy as np

        def predict(texts):
            return np.array([f"{t}!" for t in texts], dtype=object)

        return predict

    df = spark.range(100, numPartitions=4).select("id", F.col("id").cast("string").alias("t"))
    rows = infer_batch(df, load, ["t"], "out", T.StringType(), batch_size=7).collect()
    assert all(r["out"] == f"{r['id']}!" for r in rows) and len(rows) == 100


def test_inputs_are_cut_and_split(spark):
    df = spark.createDataFrame([(i, f" a\t\nb{i}  c d ", "Good" if i else "unknown") for i in range(11)], "id long, question string, teacher_label string")
    rows = student.student_inputs(df, max_len=3).collect()
    assert sorted(r["id"] for r in rows) == list(range(1, 11)) and sum(r["split"] == "test" for r in rows) == 2
    assert {r["question"] for r in rows} == {f"a b{i} c" for i in range(1, 11)}
