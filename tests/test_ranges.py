"""One array file read by many tasks, lines with their numbers, commits that are there whole or not at all."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tutelage.sources import commits, ranges, readers, sinks


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


NASTY = ["{", "}", '"', "\\", "\\\"", "{}", '}"{', "\\\\", "\n", "é", "]", "[", ",", " ", "\\\\\"}", "x" * 40]


def objects(rng, n):
    def text():
        return "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 12)))

    def value(depth):
        kind = rng.randint(0, 5 if depth < 3 else 2)
        if kind == 3:
            return [value(depth + 1) for _ in range(rng.randint(0, 2))]
        return {text(): value(depth + 1)} if kind == 4 else [text(), rng.randint(-5, 5), None, None, None, {}][kind]

    return [{"question": f"{i} {text()}", "answer": text(), "more": value(0)} for i in range(n)]


@pytest.mark.parametrize("size", [150, 1000, 4096])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_file_by_ranges(spark, tmp_path, small_splits, size, indent):
    """Braces, quotes and escapes in strings, elements larger than a split, and range edges anywhere in them."""
    rows = objects(random.Random(size), 60)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8")
    small_splits(size)
    got = sorted(map(tuple, ranges.json_elements(spark, str(tmp_path / "a.json")).collect()))
    assert [p for p, _ in got] == list(range(60)) and [json.loads(v) for _, v in got] == rows


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    rows = [{"question": "q" * 200 + str(i), "answer": "Good"} for i in range(2000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    small_splits(40_000)
    fragments = ranges._fragments(spark, str(tmp_path / "a.json"))
    assert fragments.rdd.getNumPartitions() >= 8
    df = readers.read_labeled(spark, str(tmp_path / "a.json"))
    assert [r["question"] for r in df.orderBy("id").collect()] == [r["question"] for r in rows]
    small_splits(1 << 20)
    again = readers.read_labeled(spark, str(tmp_path / "a.json"))
    assert df.exceptAll(again).count() == 0 and again.exceptAll(df).count() == 0  # keys do not depend on the splits


def test_several_files_other_elements_and_empty_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text('[1, "x{", {"question": "a", "answer": "Good"}, ["}{"], {"question": "b"} ]\n')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text('[{"question": "c", "answer": 5}]')
    got = sorted(map(tuple, readers.read_labeled(spark, str(tmp_path)).collect()))
    assert got == [(0, "a", "Good"), (1, "b", None), (2, "c", "5")]


@pytest.mark.parametrize("text", ['[{"question": "a"}, {"question": ', '[{"question": "a}]', '[{"a": 1}}]'])
def test_a_cut_file_raises(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(ValueError, match="no whole JSON array"):
        readers.read_labeled(spark, str(tmp_path / "a.json"))


@pytest.mark.parametrize("quoted", [False, True])
def test_effect_against_a_scan(quoted):
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(["\\\\", '\\"', '"', "{", "a", "\\n"]) for _ in range(rng.randint(0, 10)))
        inside, opened, at = quoted, 0, 0
        while at < len(text):
            if text[at] == "\\":
                at += 1
            elif text[at] == '"':
                inside = not inside
            elif text[at] == "{" and not inside:
                opened += 1
            at += 1
        assert ranges.effect(text, quoted) == (inside, opened)


def test_lines_are_numbered_whatever_the_splits(spark, tmp_path, small_splits):
    for name, n in (("b", 40), ("a", 25)):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"input": f"{name}{i}", "output": "é" * i}) + ("\n\n" if i == 7 else "\n") for i in range(n)))
    expected = {i + (i > 7): f"a{i}" for i in range(25)} | {26 + i + (i > 7): f"b{i}" for i in range(40)}
    for size in (200, 1 << 20):
        small_splits(size)
        rows = readers.read_sft(spark, str(tmp_path), numbered=True).collect()
        assert {r["id"]: r["input"] for r in rows} == expected and len(rows) == 65
    assert readers.read_sft(spark, str(tmp_path)).columns == ["input", "output"]


def test_commits_are_whole_and_written_once(spark, tmp_path):
    root, df = str(tmp_path / "runs"), spark.range(5)
    sets = {m: df.select(F.col("id").cast("string").alias(c), F.lit(m).alias(o)) for m, c, o in (("sft", "input", "output"), ("kd", "input", "teacher_output"))}

    def killed(path):
        df.write.parquet(path)
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        commits.write_run(spark, root, "r1", {"sft": lambda p: sets["sft"].write.json(p), "kd": killed})
    assert commits.folders(spark, root) == {} and commits.folders(spark, root, "r1") == {}
    with pytest.raises(FileNotFoundError):
        sinks.read_distill_sets(spark, root)
    first = sinks.commit_distill_sets(sets, root, "r1")
    assert sinks.commit_distill_sets({"sft": sets["sft"].limit(1), "kd": sets["kd"]}, root, "r1") == first  # already there
    back = sinks.read_distill_sets(spark, root)
    assert back["sft"].count() == back["kd"].count() == 5
    sinks.commit_distill_sets({"sft": sets["sft"].limit(2)}, root, "r2")
    assert sinks.read_distill_sets(spark, root)["sft"].count() == 2 and sinks.read_distill_sets(spark, root, "r1")["sft"].count() == 5


def test_runs_logged_again_count_once(spark, tmp_path):
    table = str(tmp_path / "runs")
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "key string, value double")
    for _ in range(2):
        sinks.log_run(rows, "r1", table)
        sinks.log_run(rows.limit(1), "r1", table, part="later")
        sinks.log_run(rows, "r2", table)
    assert sinks.read_runs(spark, table).groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 3), ("r2", 2)]
