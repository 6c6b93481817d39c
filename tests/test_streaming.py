from datetime import datetime

from pyspark.sql import functions as F

from tutelage.plans import extract
from tutelage.plans.scorer import CountScorer
from tutelage.plans.store import save_scorer
from tutelage.streaming.kpi import (compact_partials, current_from, current_kpis, kpi_stream, kpis, late_rows, latest_kpis, open_partials, partials, rank_error, write_kpis,
                                    write_partials)
from tutelage.streaming.scoring import score_stream, stored_score

ROWS = "id long, ts timestamp, features string, latency_ms double"


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{folder}/{name}")


def at(h, m=0):
    return datetime(2024, 1, 1, h, m)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    train = spark.createDataFrame([(1, "Good", "a a b"), (2, "Bad", "c c"), (3, "Standard", "b c d")], "id long, answer string, question string")
    scorer = CountScorer.fit(train)
    src = str(tmp_path / "in")
    put(spark, src, "p1", [(i, at(1), "a b" if i % 2 else "c", float(i)) for i in range(20)])
    stream = spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(src)
    score = lambda b: scorer.respond(b, "features", ("id", "ts", "latency_ms"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    score_stream(stream, score, out, state).awaitTermination()
    put(spark, src, "p2", [(i, at(2), "d", float(i)) for i in range(20, 30)])
    score_stream(stream, score, out, state).awaitTermination()
    score_stream(stream, score, out, state).awaitTermination()
    got = {r["id"]: (r["prediction"], round(r["top2_margin"], 9)) for r in spark.read.parquet(out).collect()}
    batch = {r["id"]: (r["prediction"], round(r["top2_margin"], 9)) for r in score(spark.read.option("recursiveFileLookup", True).parquet(src)).collect()}
    assert got == batch and len(got) == 30 and spark.read.parquet(out).count() == 30


KPI = "ts timestamp, prediction string, top2_margin double, latency_ms double"


def test_kpis_across_batches_and_late_rows(spark, tmp_path):
    src, out, state, late = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), []

    def feed(name, rows):
        spark.createDataFrame(rows, KPI).coalesce(1).write.parquet(f"{src}/{name}")
        stream = spark.readStream.schema(KPI).option("recursiveFileLookup", True).parquet(src)
        query = write_kpis(kpi_stream(stream, watermark="30 minutes", window="1 hour"), out, state)
        query.awaitTermination()
        late.append(late_rows(query))
        write_partials(stream, out + "2", state + "2", window="1 hour").awaitTermination()

    feed("a", [(at(1, 5), "Good", 1.0, 10.0), (at(1, 50), "Good", 2.0, 30.0), (at(1, 7), "Bad", 0.5, 5.0)])
    feed("b", [(at(1, 55), "Good", 3.0, 20.0), (at(4), "Good", 1.0, 1.0)])
    feed("c", [(at(1, 59), "Good", 100.0, 100.0), (at(4, 10), "Good", 3.0, 3.0)])
    values = lambda df: {(r["window_start"].hour, r["prediction"]): (r["n"], r["mean_margin"], r["latency_p50"], r["latency_p95"]) for r in df.collect()}
    # The row of 01:59 came after its window had closed: the watermark lets it go and says so, the partial sums keep it.
    assert values(latest_kpis(spark, out)) == {(1, "Good"): (3, 2.0, 20.0, 30.0), (1, "Bad"): (1, 0.5, 5.0, 5.0), (4, "Good"): (2, 2.0, 1.0, 3.0)}
    assert sum(late) == 1
    assert values(current_kpis(spark, out + "2")) == {(1, "Good"): (4, 26.5, 20.0, 100.0), (1, "Bad"): (1, 0.5, 5.0, 5.0), (4, "Good"): (2, 2.0, 1.0, 3.0)}
    assert values(current_kpis(spark, out + "2")) == values(kpis(spark.read.schema(KPI).option("recursiveFileLookup", True).parquet(src), window="1 hour"))
    batch = kpis(spark.read.schema(KPI).parquet(f"{src}/a"), window="1 hour").count()
    assert batch == 2


def test_compaction_keeps_what_was_counted(spark, tmp_path):
    out = str(tmp_path / "kpis")
    rows = [(at(1 + i % 5, i % 60), "Good" if i % 3 else "Bad", i / 10, float(i * 37 % 101) if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(rows, KPI)
    values = lambda d: {(r["window_start"], r["prediction"]): (r["n"], round(r["mean_margin"], 9), r["latency_p50"], r["latency_p95"]) for r in d.collect()}

    def batch(i):
        partials(df.filter(f"hash(top2_margin) % 6 in ({i}, {-i})")).write.parquet(f"{out}/open/batch_id={i}")

    for i in range(3):
        batch(i)
    before = values(current_kpis(spark, out))
    assert compact_partials(spark, out) == 1 and values(current_kpis(spark, out)) == before  # the last batch may be written again
    assert compact_partials(spark, out) is None
    for i in range(3, 6):
        batch(i)
    expected = values(kpis(df, window="1 hour"))
    assert values(current_kpis(spark, out)) == expected
    assert compact_partials(spark, out, upto=5) == 5 and values(current_kpis(spark, out)) == expected
    assert all("/compacted/" in f for f in open_partials(spark, out).inputFiles())  # a second read opens only compacted files
    late = spark.createDataFrame([(at(1), "Good", 1.0, 1.0)], KPI)
    partials(late).write.parquet(f"{out}/open/batch_id=6")
    assert values(current_kpis(spark, out)) == values(kpis(df.union(late), window="1 hour"))
    assert compact_partials(spark, out, upto=6) == 6 and not (tmp_path / "kpis" / "open" / "batch_id=2").exists()
    assert set(values(current_kpis(spark, out, since=at(4)))) == {k for k in expected if k[0] >= at(4)}


def test_sketches_keep_their_rank_error(spark):
    df = spark.range(40_000).select(F.lit(at(1)).alias("ts"), F.lit("Good").alias("prediction"), F.lit(1.0).alias("top2_margin"), (F.col("id") * 7919 % 40_009).cast("double").alias("latency_ms"))
    parts = [partials(df.filter(F.col("id") % 8 == i), k=200) for i in range(8)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    r, e = current_from(whole).first(), 2 * rank_error(200)
    assert r["n"] == 40_000 and abs(r["latency_p50"] / 40_009 - 0.5) < e and abs(r["latency_p95"] / 40_009 - 0.95) < e


def test_requests_sent_again_are_answered_once_and_models_swap(spark, tmp_path):
    train = spark.createDataFrame([(1, "Good", "a a b"), (2, "Bad", "c c"), (3, "Standard", "b c d")], "id long, answer string, question string")
    root, src, out, state = (str(tmp_path / n) for n in ("store", "in", "out", "state"))
    save_scorer(CountScorer.fit(train), root, "credit", "v1")
    score = stored_score(root, "credit", "features", ("id", "ts"))

    def feed(name, rows):
        put(spark, src, name, rows)
        stream = spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(src)
        score_stream(stream, score, out, state, id_cols=("id",), within="2 hours").awaitTermination()

    rows = [(i, at(1, i), "a b", 1.0) for i in range(10)]
    feed("a", rows)
    feed("b", rows + rows[:3] + [(20, at(1, 30), "c", 1.0)])
    got = spark.read.parquet(out)
    assert got.count() == 11 and {r["version"] for r in got.collect()} == {"v1"}
    flipped = train.withColumn("answer", F.when(F.col("answer") == "Good", "Bad").when(F.col("answer") == "Bad", "Good").otherwise(F.col("answer")))
    save_scorer(CountScorer.fit(flipped), root, "credit", "v2")
    feed("c", [(0, at(1), "a b", 1.0), (21, at(1, 40), "a b", 1.0)])  # the same score function, no restart of the model
    after = {r["id"]: (r["prediction"], r["version"]) for r in spark.read.parquet(out).collect()}
    assert len(after) == 12 and after[0] == ("Good", "v1") and after[21] == ("Bad", "v2")


def test_the_second_sending_comes_in_later_micro_batches(spark, tmp_path, monkeypatch):
    tables = {"customer": ([(1, 10.0, "HOUSEHOLD"), (2, -5.0, "BUILDING")], "c_custkey long, c_acctbal double, c_mktsegment string"),
              "orders": ([(i, 1 + i % 2, "FOP"[i % 3], 100.0 + i, "1-URGENT") for i in range(9)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
              "events": ([(i, None if i % 10 == 3 else at(1, i), 1 + i % 2, "click", float(i)) for i in range(40)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    queries, start = [], extract.score_stream
    monkeypatch.setattr(extract, "score_stream", lambda *a, **kw: queries.append(start(*a, **kw)) or queries[-1])
    answered = [r["event_id"] for r in extract.i1_replayed_stream(spark, str(tmp_path)).collect()]
    again = [sum(int(op["customMetrics"]["numDroppedDuplicateRows"]) for op in p["stateOperators"]) for q in queries for p in q.recentProgress]
    assert again[0] == 0 and sum(again) == 40  # no request comes twice in the first micro-batch
    assert sorted(answered) == list(range(40))  # those without a time too are answered once


def test_kpi_state_is_bounded(spark, tmp_path):
    spark.createDataFrame([(at(1), "Good", 1.0, 1.0)], KPI).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KPI).parquet(str(tmp_path / "in"))
    plan = kpi_stream(stream)._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan
