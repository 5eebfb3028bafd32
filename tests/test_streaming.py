import tempfile

from pyspark.sql import functions as F

from riskframe.streaming.monitor_stream import feedback_join, run_to_table


def test_feedback_join_is_time_bounded(spark):
    preds = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 1), (2, "2024-01-01 00:00:00", 0), (3, "2024-01-01 00:00:00", 1)],
        "rid int, ts string, prediction int").withColumn("ts", F.to_timestamp("ts"))
    outs = spark.createDataFrame(
        [(1, "2024-01-03 00:00:00", 1), (2, "2024-01-20 00:00:00", 1), (3, "2023-12-31 00:00:00", 0)],
        "rid int, ots string, outcome int").withColumn("ots", F.to_timestamp("ots"))
    d = tempfile.mkdtemp(prefix="riskframe-stream-")
    preds.write.parquet(f"{d}/p")
    outs.write.parquet(f"{d}/o")
    ps = spark.readStream.schema(preds.schema).parquet(f"{d}/p")
    os_ = spark.readStream.schema(outs.schema).parquet(f"{d}/o")
    j = feedback_join(ps, os_, "rid", "ts", "ots", "7 days")
    got = run_to_table(j.select("p.rid", "prediction", "outcome"), f"{d}/ck", mode="append").collect()
    assert [(r["rid"], r["prediction"], r["outcome"]) for r in got] == [(1, 1, 1)]


def test_update_mode_over_several_batches_has_no_duplicates(spark):
    from riskframe.streaming.monitor_stream import sliding_confusion
    d = tempfile.mkdtemp(prefix="riskframe-stream2-")
    for i, day in enumerate(["2024-01-01 10:00:00", "2024-01-02 10:00:00", "2024-01-03 10:00:00"]):
        spark.createDataFrame([(day, 1, 1)], "ts string, label int, prediction int") \
            .withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{d}/in/part{i}")
    schema = "ts timestamp, label int, prediction int"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(f"{d}/in")
    out = run_to_table(sliding_confusion(s, "ts", "label", "prediction", "2 days", "1 day"),
                       f"{d}/ck", mode="update", keys=("window_start", "window_end"))
    rows = out.collect()
    starts = [r["window_start"] for r in rows]
    assert len(starts) == len(set(starts)) == 4
    assert sum(r["tp"] for r in rows) == 6          # each event in two 2-day windows


def test_daily_then_rolling_equals_sliding_windows(spark):
    from riskframe.streaming.monitor_stream import (daily_confusion_stream,
                                                    rolling_windows_from_daily, sliding_confusion)
    d = tempfile.mkdtemp(prefix="riskframe-stream3-")
    rows = [(f"2024-01-{1 + i % 9:02d} {i % 24:02d}:00:00", i % 2, (i // 2) % 2) for i in range(60)]
    spark.createDataFrame(rows, "ts string, label int, prediction int") \
        .withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{d}/in")
    schema = "ts timestamp, label int, prediction int"

    def stream():
        return spark.readStream.schema(schema).parquet(f"{d}/in")
    direct = run_to_table(sliding_confusion(stream(), "ts", "label", "prediction", "3 days", "1 day"),
                          f"{d}/ck1", mode="update", keys=("window_start", "window_end"))
    daily = run_to_table(daily_confusion_stream(stream(), "ts", "label", "prediction"),
                         f"{d}/ck2", mode="update", keys=("day",))
    rolled = rolling_windows_from_daily(daily, 3)
    a = sorted((str(r["window_start"])[:10], r["tp"], r["fp"], r["fn"], r["tn"]) for r in direct.collect())
    b = sorted((str(r["window_start"]), r["tp"], r["fp"], r["fn"], r["tn"]) for r in rolled.collect())
    assert a == b


def test_dedupe_is_the_same_for_any_files(spark):
    from riskframe.streaming.monitor_stream import dedupe_stream
    rows = [(f"2024-01-{1 + i // 40:02d} {i * 7 % 24:02d}:00:00", i % 5, "ab"[i % 2]) for i in range(240)]
    table = spark.createDataFrame(rows, "ts string, u int, k string").withColumn("ts", F.to_timestamp("ts"))
    want = {(str(t)[:10], u, k) for t, u, k in rows}
    for files in (1, 6):
        d = tempfile.mkdtemp(prefix="riskframe-stream4-")
        for i in range(files):
            part = table.where((F.dayofmonth("ts") - 1) % files == i) if files > 1 else table
            part.coalesce(1).write.parquet(f"{d}/in/part{i}")
        s = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
             .option("recursiveFileLookup", True).parquet(f"{d}/in"))
        out = run_to_table(dedupe_stream(s, "ts", ["u", "k"], "40 days"), f"{d}/ck").collect()
        got = [(str(r["period"])[:10], r["u"], r["k"]) for r in out]
        assert len(got) == len(set(got)) and set(got) == want


def _psi_by_hand(rows, edges, late=0):
    """(day, value) rows -> PSI of each closed day against the 28 days before it."""
    import math
    from collections import Counter
    days = {}
    for d, v in rows:
        days.setdefault(d, Counter())[sum(v >= e for e in edges[1:-1])] += 1
    out = {}
    for d in sorted(days):
        ref = sum((days[k] for k in days if d - 28 <= k < d), Counter())
        if ref and d < max(days) - late:
            n, m = days[d].total(), ref.total()
            share = [(days[d][b] / n + 1e-6, ref[b] / m + 1e-6) for b in set(days[d]) | set(ref)]
            out[d] = (sum((a - r) * math.log(a / r) for a, r in share), n, m)
    return out


def _day_rows(days, seed=1):
    import random
    rng = random.Random(seed)
    return [(d, rng.gauss(d / 9, 3)) for d in days for _ in range(rng.randrange(3, 12))]


def _psi_stream(spark, folder, rows, files, late=0):
    """Rows by day number, dealt to files in order of time; files may end within a day."""
    from riskframe.streaming.monitor_stream import daily_psi_stream
    size = -(-len(rows) // files)
    for i in range(files):
        part = [(f"{19_700 + d}", v) for d, v in rows[i * size:(i + 1) * size]]
        (spark.createDataFrame(part, "d string, value double")
         .select(F.expr("timestamp_seconds(cast(d as long) * 86400 + 7000)").alias("ts"), "value")
         .coalesce(1).write.mode("append").parquet(f"{folder}/in/{i:03d}"))
    stream = (spark.readStream.schema("ts timestamp, value double").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(f"{folder}/in"))
    return daily_psi_stream(stream, "ts", {"value": [-9.0, -2.0, 0.0, 2.0, 5.0, 9.0]}, late)


def _by_day(table):
    import datetime
    return {(r["day"] - datetime.date(1970, 1, 1)).days - 19_700: (round(r["psi"], 9), r["n_day"], r["n_reference"]) for r in table.collect()}


def _rounded_psi(want):
    return {d: (round(p, 9), n, m) for d, (p, n, m) in want.items()}


def test_daily_psi_is_the_same_from_one_and_six_files(spark):
    rows = _day_rows([*range(0, 12), *range(20, 24), *range(45, 50), 90, 91])  # gaps, one longer than the ring
    edges = [-9.0, -2.0, 0.0, 2.0, 5.0, 9.0]
    want = _rounded_psi(_psi_by_hand(rows, edges))
    for files in (1, 6):
        d = tempfile.mkdtemp(prefix="riskframe-psi-")
        out = run_to_table(_psi_stream(spark, d, rows, files), f"{d}/ck")
        assert out.columns == ["feature", "day", "psi", "n_day", "n_reference"]
        assert _by_day(out) == want


def test_daily_psi_goes_on_after_a_restart(spark):
    """A second run over new files takes up the ring of the first: same days, none twice."""
    from riskframe.streaming.monitor_stream import run_to_table as run
    rows = _day_rows(range(0, 40), 2)
    first, later = [r for r in rows if r[0] < 25], [r for r in rows if r[0] >= 25]
    d = tempfile.mkdtemp(prefix="riskframe-psi2-")
    run(_psi_stream(spark, d, first, 2), f"{d}/ck")
    import os
    os.makedirs(f"{d}/second")
    part = [(f"{19_700 + x}", v) for x, v in later]
    (spark.createDataFrame(part, "d string, value double").select(F.expr("timestamp_seconds(cast(d as long) * 86400 + 7000)").alias("ts"), "value")
     .coalesce(1).write.parquet(f"{d}/in/later"))
    from riskframe.streaming.monitor_stream import daily_psi_stream
    stream = (spark.readStream.schema("ts timestamp, value double").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(f"{d}/in"))
    out = run(daily_psi_stream(stream, "ts", {"value": [-9.0, -2.0, 0.0, 2.0, 5.0, 9.0]}), f"{d}/ck")
    rows_out = out.collect()
    assert len(rows_out) == len({r["day"] for r in rows_out})
    assert _by_day(out) == _rounded_psi(_psi_by_hand(rows, [-9.0, -2.0, 0.0, 2.0, 5.0, 9.0]))


def test_every_stream_table_has_the_columns_of_its_stream(spark):
    from riskframe.streaming.monitor_stream import daily_confusion_stream
    d = tempfile.mkdtemp(prefix="riskframe-columns-")
    (spark.createDataFrame([("2024-01-01 10:00:00", 1, 1)], "ts string, label int, prediction int")
     .withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{d}/in"))
    stream = lambda: spark.readStream.schema("ts timestamp, label int, prediction int").parquet(f"{d}/in")
    plain = stream().select("label", "prediction")
    assert run_to_table(plain, f"{d}/a").columns == plain.columns == ["label", "prediction"]
    daily = daily_confusion_stream(stream(), "ts", "label", "prediction")
    assert run_to_table(daily, f"{d}/b", mode="update", keys=("day",)).columns == daily.columns


def _scoring(spark):
    from riskframe import schema as S
    from riskframe.operators import models
    train = spark.range(300).select(F.col("id").alias("row_id"), (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    pipe, _ = models.build_pipeline(models.learner("dummy"), ["x"], [])
    return pipe.fit(train), S.ValidationRules(ranges=(S.RangeRule("x", 0.0, 6.0),), enums=())


def test_two_sinks_share_a_commit(spark):
    """Each batch is scored once: a batch that broke off after its first output is written again, a
    committed one is left alone, and readers see committed batches only."""
    from riskframe.streaming.monitor_stream import read_committed, run_scoring, scoring_sink
    model, rules = _scoring(spark)
    d = tempfile.mkdtemp(prefix="riskframe-sinks-")
    rows = spark.range(90).select(F.col("id").alias("row_id"), (F.col("id") % 10).cast("double").alias("x"))
    for i in range(3):
        rows.where(f"row_id % 3 = {i}").coalesce(1).write.parquet(f"{d}/in/{i}")
    stream = lambda: (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
                      .option("recursiveFileLookup", True).parquet(f"{d}/in"))
    run_scoring(stream(), model, rules, "7", f"{d}/out")
    good, bad, commits = (read_committed(spark, f"{d}/out", n) for n in ("scored", "quarantine", "commits"))
    assert {r["row_id"] for r in good.collect()} == {i for i in range(90) if i % 10 <= 6}
    assert {r["row_id"]: r["violations"] for r in bad.collect()} == {i: ["x:range"] for i in range(90) if i % 10 > 6}
    assert commits.agg(F.sum("n_scored"), F.sum("n_quarantined"), F.count("batch_id")).first()[:] == (63, 27, 3)
    assert {r["model_version"] for r in good.collect()} == {"7"} and "violations" not in good.columns

    # a batch that wrote its first output only, and was lost before its commit
    half = rows.where("row_id < 5").withColumn("row_id", F.col("row_id") + 1000)
    half.selectExpr("*", "0.5D AS probability_1", "1 AS predicted_class", "'x' AS risk_level", "'7' AS model_version").write.parquet(f"{d}/out/scored/batch_id=3")
    assert read_committed(spark, f"{d}/out", "scored").where("row_id >= 1000").isEmpty()
    sink = scoring_sink(model, rules, "7", f"{d}/out")
    sink(half, 3)
    again = read_committed(spark, f"{d}/out", "scored").where("row_id >= 1000")
    assert again.count() == 5 and again.where("risk_level = 'x'").isEmpty()
    sink(rows, 3)  # tried again after its commit: nothing changes
    assert read_committed(spark, f"{d}/out", "scored").where("batch_id = 3").count() == 5


def test_nothing_committed_is_an_error(spark):
    import pytest
    from riskframe.streaming.monitor_stream import read_committed
    with pytest.raises(ValueError, match="no batch"):
        read_committed(spark, tempfile.mkdtemp(prefix="riskframe-none-"), "scored")
