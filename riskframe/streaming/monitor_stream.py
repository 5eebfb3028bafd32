"""Structured Streaming operators.

The batch operators are reused unchanged on each micro-batch: scoring is
stateless; the histogram and rolling windows are watermarked windowed
aggregates; feedback is a time-bounded stream-stream join.
"""

from __future__ import annotations

import datetime
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.drift import bin_index
from riskframe.operators.quality import validate
from riskframe import schema as S
from riskframe.session import path_exists


def as_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def scoring_sink(model, rules: S.ValidationRules, version: str, base: str):
    """A foreachBatch sink with two outputs. Records are validated first; valid ones are scored
    to ``base/scored``, the others go to ``base/quarantine`` with their reasons and never meet the model.
    When both are written, a row in ``base/commits`` says so. A batch that is tried again starts
    over unless it was committed, and then it is left as it is; readers (:func:`read_committed`) take rows
    of committed batches only, so they see both outputs of a batch or neither."""
    from riskframe.operators.models import score_table

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, done = batch.sparkSession, f"{base}/commits/batch_id={batch_id}"
        if path_exists(spark, f"{done}/_SUCCESS"):
            return
        # both outputs read the batch by themselves: its checks are cheap, a copy of all its rows is not
        checked = validate(batch, rules)
        scored = score_table(model, checked.where("is_valid").drop("violations", "is_valid"), version)
        scored = scored.select(*batch.columns, "probability_1", "predicted_class", "risk_level", "model_version")
        counts = {}
        for name, rows in (("scored", scored), ("quarantine", checked.where("NOT is_valid").select(*batch.columns, "violations"))):
            rows.write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")
            counts[name] = spark.read.schema(rows.schema).parquet(f"{base}/{name}/batch_id={batch_id}").count()
        spark.createDataFrame([(counts["scored"], counts["quarantine"])], "n_scored long, n_quarantined long").coalesce(1).write.mode("overwrite").parquet(done)
    return sink


def run_scoring(stream: DataFrame, model, rules: S.ValidationRules, version: str, base: str, **trigger) -> None:
    """Score what is available (or as ``trigger`` says) into ``base``; the same ``base`` goes on where it stopped."""
    q = (stream.writeStream.option("checkpointLocation", f"{base}/state")
         .foreachBatch(scoring_sink(model, rules, version, base)).trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination()


def read_committed(spark, base: str, name: str) -> DataFrame:
    """Rows of ``scored``, ``quarantine`` or ``commits`` of the committed batches, with their batch_id."""
    if not path_exists(spark, f"{base}/commits"):
        raise ValueError(f"no batch has been committed to {base}")
    commits = spark.read.parquet(f"{base}/commits").withColumn("batch_id", F.col("batch_id").cast("long"))
    if name == "commits":
        return commits
    rows = spark.read.parquet(f"{base}/{name}").withColumn("batch_id", F.col("batch_id").cast("long"))
    return rows.join(commits.select("batch_id"), "batch_id", "left_semi")


def daily_histogram(stream: DataFrame, ts: str, feature_cols: list[str], edges: DataFrame,
                    watermark: str = "1 day", n_bins: int = S.PSI_BINS) -> DataFrame:
    """Tumbling daily counts per (feature, bin) on frozen edges."""
    long = (as_event_time(stream, ts)
            .withWatermark(ts, watermark)
            .select(ts, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                     F.col(c).cast("double").alias("value"))
                                            for c in feature_cols])).alias("x"))
            .select(ts, "x.*").where(F.col("value").isNotNull() & ~F.isnan("value")))
    return (long.join(F.broadcast(edges), "feature")  # one row per feature
            .groupBy(F.window(ts, "1 day").alias("w"), "feature",
                     bin_index(F.col("edges"), F.col("value"), n_bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("day_start"), "feature", "bin", "n"))


PSI_SCHEMA = "feature string, day date, psi double, n_day long, n_reference long"


def _bin_counts(edges: dict[str, list[float]]):
    """Rows of a partition -> counts by feature, bin and day: what a micro-batch sends to the state
    is a few numbers a partition, however many rows a feature has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            days = batch.column("day").cast(pa.int32()).to_numpy(zero_copy_only=False)
            ends = batch.column("ends_ms").to_numpy()
            found = []
            for name, cuts in edges.items():
                x = batch.column(name).to_numpy(zero_copy_only=False)
                here = ~np.isnan(x)
                bins = np.searchsorted(np.asarray(cuts[1:-1], float), x[here], side="right")
                keys, first, n = np.unique(np.column_stack([days[here], bins]), axis=0, return_index=True, return_counts=True)
                found += [(name, int(d), int(b), int(k), int(e)) for (d, b), k, e in zip(keys, n, ends[here][first])]
            if found:
                types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["feature", "day", "bin", "n", "ends_ms"])
    return run


def _closed_days(window_days: int, eps: float):
    """State of a feature: a ring of daily histograms. Gives the PSI of each day that the watermark has
    closed against the ``window_days`` days before it, and forgets days that no later day needs."""
    def run(key, frames, state):
        held = json.loads(state.get[0]) if state.exists else {"days": {}, "closed": None}
        days = {int(d): v for d, v in held["days"].items()}  # day -> [end in ms, {bin: n}]
        closed = held["closed"]
        for f in frames:
            for d, b, n, end in zip(f["day"], f["bin"], f["n"], f["ends_ms"]):
                if closed is None or d > closed:
                    counts = days.setdefault(int(d), [int(end), {}])[1]
                    counts[str(b)] = counts.get(str(b), 0) + int(n)
        now, rows = state.getCurrentWatermarkMs(), []
        for day in sorted(d for d, (end, _) in days.items() if end <= now and (closed is None or d > closed)):
            cur, ref = days[day][1], {}
            for d in range(day - window_days, day):
                for b, n in (days[d][1] if d in days else {}).items():
                    ref[b] = ref.get(b, 0) + n
            n_cur, n_ref = sum(cur.values()), sum(ref.values())
            if n_ref:
                share = [(cur.get(b, 0) / n_cur + eps, ref.get(b, 0) / n_ref + eps) for b in cur.keys() | ref.keys()]
                rows.append((key[0], datetime.date(1970, 1, 1) + datetime.timedelta(day), math.fsum((c - r) * math.log(c / r) for c, r in share), n_cur, n_ref))
            closed = day
        newest = max(days, default=0)
        if closed is not None:
            days = {d: v for d, v in days.items() if d > closed - window_days}
        open_ends = [end for d, (end, _) in days.items() if closed is None or d > closed]
        # wait for the end of the first open day, or until the ring is older than any reference
        wait = min(open_ends) if open_ends else (newest + window_days + 2) * 86_400_000
        if wait <= now or not days:
            state.remove()
        else:
            state.update((json.dumps({"days": days, "closed": closed}),))
            state.setTimeoutTimestamp(wait)
        yield pd.DataFrame(rows, columns=["feature", "day", "psi", "n_day", "n_reference"])
    return run


def daily_psi_stream(stream: DataFrame, ts: str, edges: dict[str, list[float]], late_days: int = 0,
                     window_days: int = S.REFERENCE_WINDOW_DAYS, eps: float = S.PSI_EPSILON) -> DataFrame:
    """PSI of each closed day against the ``window_days`` days before it, for every feature of
    ``edges`` (frozen edges by column name). A day is closed when a row that is ``late_days`` + 1 days
    younger has come; rows of closed days are dropped. Files and micro-batches may cut the
    days anywhere. The state is keyed by feature and holds at most ``window_days`` closed days and the
    open ones; it expires when no day is left that a reference could need."""
    day = F.to_date(ts)
    rows = as_event_time(stream, ts).select(day.alias("day"), F.unix_millis(F.date_add(day, 1).cast("timestamp")).alias("ends_ms"),
                                            *[F.col(c).cast("double").alias(c) for c in edges])
    counted = rows.where(F.col("day").isNotNull()).mapInArrow(_bin_counts(edges), "feature string, day int, bin int, n long, ends_ms long")
    timed = counted.withColumn("ends", F.timestamp_millis("ends_ms")).withWatermark("ends", f"{late_days + 1} days")
    return timed.groupBy("feature").applyInPandasWithState(_closed_days(window_days, eps), PSI_SCHEMA, "held string", "append", "EventTimeTimeout")


def sliding_confusion(stream: DataFrame, ts: str, label: str, prediction: str,
                      length: str = "30 days", slide: str = "1 day",
                      watermark: str = "1 day") -> DataFrame:
    """Z3: sliding-window tp/fp/fn/tn. State holds one row per open window."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return (as_event_time(stream, ts).withWatermark(ts, watermark)
            .groupBy(F.window(ts, length, slide).alias("w"))
            .agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "tp", "fp", "fn", "tn"))


def daily_confusion_stream(stream: DataFrame, ts: str, label: str, prediction: str,
                           watermark: str = "1 day") -> DataFrame:
    """Z3, first half: tumbling daily tp/fp/fn/tn. Each event updates one
    day; the state is one row per open day."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return (as_event_time(stream, ts).withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day").alias("w"))
            .agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
            .select(F.to_date(F.col("w.start")).alias("day"), "tp", "fp", "fn", "tn"))


def rolling_windows_from_daily(daily: DataFrame, days: int = S.ROLLING_DAYS) -> DataFrame:
    """Z3, second half (batch step): the ``days``-long windows sliding by one
    day, as sums of daily rows. Each daily row is credited to the ``days``
    windows that contain it: a fixed fan-out of the daily table, not of the
    events. Equals ``window(ts, '<days> days', '1 day')`` on the events."""
    starts = daily.select(
        "tp", "fp", "fn", "tn",
        F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("k"), "day")
    return (starts.groupBy(F.date_sub("day", F.col("k")).alias("window_start"))
            .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
            .withColumn("window_end", F.date_add("window_start", days))
            .select("window_start", "window_end", "tp", "fp", "fn", "tn"))


def feedback_join(predictions: DataFrame, outcomes: DataFrame, key: str,
                  pred_ts: str, outcome_ts: str, max_delay: str = "7 days",
                  watermark: str = "1 day") -> DataFrame:
    """Outcomes joined to the prediction with the same key that came at
    most ``max_delay`` earlier; both sides watermarked so state is bounded."""
    p = as_event_time(predictions, pred_ts).withWatermark(pred_ts, watermark).alias("p")
    o = as_event_time(outcomes, outcome_ts).withWatermark(outcome_ts, watermark).alias("o")
    cond = ((F.col(f"p.{key}") == F.col(f"o.{key}"))
            & (F.col(f"o.{outcome_ts}") >= F.col(f"p.{pred_ts}"))
            & (F.col(f"o.{outcome_ts}") <= F.col(f"p.{pred_ts}") + F.expr(f"INTERVAL {max_delay}")))
    return p.join(o, cond, "inner")


def dedupe_stream(stream: DataFrame, ts: str, cols: list[str], watermark: str = "1 hour",
                  period: str = "1 day") -> DataFrame:
    """One row per record and period of event time, whatever files or batches the rows come
    in. Rows later than ``watermark`` are dropped; state of closed periods is dropped too. The
    period's start replaces ``ts``, which would depend on the row that came first."""
    timed = as_event_time(stream, ts).withWatermark(ts, watermark)
    return (timed.withColumn("period", F.window(ts, period)).drop(ts).dropDuplicates([*cols, "period"])
            .withColumn("period", F.col("period.start")))


def run_to_table(df: DataFrame, checkpoint: str, mode: str = "append",
                 keys: tuple[str, ...] = ()) -> DataFrame:
    """Run a streaming query over what is available and return the result as a batch DataFrame
    written under the checkpoint folder. Each micro-batch has a folder of its own, so a batch that
    is tried again replaces its rows. With ``update`` the newest row per ``keys`` is returned."""
    spark = df.sparkSession
    out = f"{checkpoint}/out"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of its rows")
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{checkpoint}/state")
         .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()
    if not path_exists(spark, out):  # no micro-batch ran
        return spark.createDataFrame([], df.schema)
    # a schema of its own: StructType.add would change the cached schema of ``df``
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(out)
    if mode == "update":
        others = [c for c in df.columns if c not in keys]
        rows = (rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("x"))
                .select(*keys, "x.*"))
    return rows.select(*df.columns)
