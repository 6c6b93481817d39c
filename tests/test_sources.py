import json

import pytest
from pyspark.sql import functions as F

from tutelage.operators.datasets import build_sets
from tutelage.session import materialise, shared_dir
from tutelage.sources import readers, sinks


def test_labelled_array_file(spark, tmp_path):
    rows = [{"question": f"q{i} é", "answer": " Good "} for i in range(5)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1, ensure_ascii=False), encoding="utf-8")
    df = readers.read_labeled(spark, str(tmp_path / "a.json"))
    assert [(r["id"], r["question"]) for r in df.orderBy("id").collect()] == [(i, f"q{i} é") for i in range(5)]


def test_labelled_lines_with_ids(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 7, "question": "q", "answer": "Bad"}\n{"id": 9, "question": "r", "answer": "Good"}')
    assert [r["id"] for r in readers.read_labeled(spark, str(tmp_path / "a.jsonl"), "id", True).orderBy("id").collect()] == [7, 9]


def test_kd_logits_path_is_optional(spark, tmp_path):
    (tmp_path / "kd.jsonl").write_text('{"input": "a", "teacher_output": "b"}\n{"input": "c", "teacher_output": "d", "teacher_logits_path": "p"}')
    assert [r["teacher_logits_path"] for r in readers.read_kd(spark, str(tmp_path / "kd.jsonl")).orderBy("input").collect()] == [None, "p"]


def test_sets_round_trip(spark, tmp_path):
    df = spark.range(30).select("id", F.element_at(F.array(*map(F.lit, ("Good", "Standard", "Bad"))), (F.col("id") % 3 + 1).cast("int")).alias("answer"),
                                F.concat(F.lit("Größe\n"), "id").alias("question"))
    sets = build_sets(df)
    paths = sinks.write_distill_sets(sets, str(tmp_path / "out"), "credit")
    for method, path in paths.items():
        assert path.endswith(f"credit_{method}.jsonl")
        back = readers.READERS[method](spark, path)
        columns = [c for c in sets[method].columns if c != "id"]
        assert sorted(map(tuple, back.select(*columns).collect())) == sorted(map(tuple, sets[method].select(*columns).collect()))
    raw = "".join(r["value"] for r in spark.read.text(paths["sft"]).collect())
    assert "Größe" in raw
    with pytest.raises(Exception, match="already exists"):
        sinks.write_distill_sets(sets, str(tmp_path / "out"), "credit")


def test_results_and_runs(spark, tmp_path):
    path = sinks.write_results(spark.createDataFrame([(1, "ü")], "id long, generated string"), str(tmp_path / "model"), "sft")
    assert path.endswith("model/sft_eval_results.jsonl") and spark.read.json(path).first()["generated"] == "ü"
    table = str(tmp_path / "runs")
    rows = spark.createDataFrame([("accuracy", 0.5)], "key string, value double")
    for run in ("0001", "b"):
        sinks.log_run(rows, run, table)
    sinks.log_run(rows, "b", table, "param")
    got = sorted((r["run_id"], r["kind"], r["key"], r["value"]) for r in sinks.read_runs(spark, table).collect())
    assert got == [("0001", "metric", "accuracy", "0.5"), ("b", "metric", "accuracy", "0.5"), ("b", "param", "accuracy", "0.5")]


def test_materialise_goes_to_the_shared_folder(spark):
    df = materialise(spark.range(3), "t")
    assert df.count() == 3 and all(shared_dir(spark) in f for f in df.inputFiles())
