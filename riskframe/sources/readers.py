"""Sources and sinks.

Delimited files are read against an explicit schema built from the
header *names* (Spark maps CSV columns by position, so a reordered header
would otherwise swap values silently).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import schema as S

CLINICAL_TYPES: dict[str, T.DataType] = {
    "id": T.LongType(), "age": T.IntegerType(), "gender": T.IntegerType(),
    "height": T.DoubleType(), "weight": T.DoubleType(), "ap_hi": T.DoubleType(),
    "ap_lo": T.DoubleType(), "cholesterol": T.IntegerType(), "gluc": T.IntegerType(),
    "smoke": T.IntegerType(), "alco": T.IntegerType(), "active": T.IntegerType(),
    "cardio": T.IntegerType(),
}


def read_header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """First line of the file(s), split on ``sep`` (one small read)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"empty input: {path}")
    return [h.strip() for h in first[0][0].split(sep)]


def headers_by_file(spark: SparkSession, path: str, sep: str, required: tuple[str, ...]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header: the first line of a file that names every required column. A file
    without one fails. What is collected is one line a file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value")
    names = F.transform(F.split("value", F.lit(_literal(sep)), -1), lambda x: F.trim(x))
    named = F.size(F.array_intersect(names, F.array(*(F.lit(c) for c in required)))) == len(required)
    # a line without every name is no header and is not split. Distinct pairs, so that a task holds one row
    # a file and header (a least line per file would sort all lines of the task)
    maybe = F.lit(True)
    for c in required:
        maybe = maybe & F.contains("value", F.lit(c))
    pairs = lines.select("file", F.when(maybe, F.when(named, F.col("value"))).alias("header")).distinct()
    found: dict[tuple[str, ...], list[str]] = {}
    bare = []
    for r in pairs.groupBy("file").agg(F.min("header").alias("header")).collect():
        if r["header"] is None:
            bare.append(r["file"])
        else:
            found.setdefault(tuple(h.strip() for h in r["header"].split(sep)), []).append(r["file"])
    if bare:
        missing = sorted(set(required) - set(read_header(spark, bare[0], sep)))
        raise ValueError(f"missing columns: {missing}; expected: {list(required)}; in {sorted(bare)[:3]}")
    return found


def _literal(sep: str) -> str:
    """``sep`` as a pattern that means itself."""
    return "\\Q" + sep + "\\E"


def read_delimited(spark: SparkSession, path: str, types: dict[str, T.DataType],
                   required: tuple[str, ...] | None = None, sep: str = ";",
                   with_source: bool = True) -> DataFrame:
    """Header + separator scan against a contract.

    Every file is read by its own header, one scan for the files of each
    distinct header. Fails with the sorted missing names when a required
    column is absent; extra columns are read as strings and dropped;
    ``source_path`` records the file each row came from.
    """
    required = tuple(required or types)
    groups = headers_by_file(spark, path, sep, required)
    if not groups:
        raise ValueError(f"empty input: {path}")
    kept = [c for c in types if any(c in header for header in groups)]
    out = None
    for header, files in sorted(groups.items()):
        schema = T.StructType([T.StructField(h, types.get(h, T.StringType()), True) for h in header])
        df = (spark.read.schema(schema).option("sep", sep).option("header", True)
              .option("mode", "PERMISSIVE").csv(files))
        cols = [F.col(c) if c in header else F.lit(None).cast(types[c]).alias(c) for c in kept]
        if with_source:
            cols.append(F.col("_metadata.file_path").alias("source_path"))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def read_clinical(spark: SparkSession, path: str) -> DataFrame:
    """The raw clinical table with age in years and BMI derived (S1 + P1/P2)."""
    from riskframe.operators.derive import augment
    return augment(read_delimited(spark, path, CLINICAL_TYPES, S.RAW_COLUMNS, ";"))


def read_scoring_csv(spark: SparkSession, path: str, types: dict[str, T.DataType],
                     sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Batch of records to score. Rows whose field count differs from the
    header, or with a cell that its type can't hold, go to quarantine with the
    raw line and the reason; the rest are typed. An empty cell is null."""
    header = read_header(spark, path, sep)
    missing = sorted(set(types) - set(header))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    fields = F.transform(F.split("value", F.lit(_literal(sep)), -1), lambda x: F.trim(x))
    raw = spark.read.text(path).withColumn("__f", fields)
    raw = raw.where(F.col("__f") != F.array(*(F.lit(h) for h in header)))
    right = F.size("__f") == len(header)
    cells = [(h, types[h], F.get("__f", F.lit(i))) for i, h in enumerate(header) if h in types]
    wrong = F.array_compact(F.array(*(F.when((x != "") & x.try_cast(t).isNull(), F.lit(h)) for h, t, x in cells)))
    reason = F.when(~right, F.lit("field count")).when(F.size(wrong) > 0, F.concat(F.lit("bad value: "), F.array_join(wrong, ", ")))
    judged = raw.withColumn("__reason", reason)
    bad = (judged.where(F.col("__reason").isNotNull())
           .select(F.col("value").alias("raw_line"), F.size("__f").alias("n_fields"), F.col("__reason").alias("reason")))
    typed = judged.where(F.col("__reason").isNull()).select(*(F.when(x != "", x.try_cast(t)).alias(h) for h, t, x in cells))
    return typed, bad


def parse_records(df: DataFrame, json_col: str, record_schema: T.StructType | str,
                  max_records: int = S.REQUEST_MAX_RECORDS,
                  field: str = "patients") -> DataFrame:
    """A JSON request ``{"patients": [...]}`` per row -> one row per
    record; requests outside 1..max_records records are flagged, not dropped."""
    req = T.StructType([T.StructField(field, T.ArrayType(
        T._parse_datatype_string(record_schema) if isinstance(record_schema, str)
        else record_schema), True)])
    parsed = df.withColumn("__req", F.from_json(F.col(json_col), req))
    n = F.size(F.col(f"__req.{field}"))
    return (parsed.withColumn("request_ok", (n >= 1) & (n <= max_records))
            .select("*", F.inline_outer(F.col(f"__req.{field}")))
            .drop("__req"))


def write_drift_report(report: DataFrame, path: str) -> None:
    """The report as JSON ``{per_feature: [...], prediction_drift: {...}}``."""
    feats = report.where(F.col("feature") != "prediction")
    pred = report.where(F.col("feature") == "prediction")
    fields = ["feature", "psi", "ks_statistic", "ks_pvalue", "verdict"]
    out = (feats.agg(F.collect_list(F.struct(*fields)).alias("per_feature"))
           .withColumn("__one", F.lit(1))
           .join(pred.select(F.struct(*fields).alias("prediction_drift"))
                 .withColumn("__one", F.lit(1)), "__one", "left").drop("__one"))
    out.coalesce(1).write.mode("overwrite").json(path)  # one row: features x 5 fields


def save_model(model, path: str, example: DataFrame | None = None) -> None:
    """Model + input schema + two example rows next to it."""
    model.write().overwrite().save(f"{path}/model")
    if example is not None:
        spark = example.sparkSession
        spark.createDataFrame([(example.schema.json(),)], "schema string") \
            .write.mode("overwrite").text(f"{path}/signature")
        example.limit(2).write.mode("overwrite").json(f"{path}/input_example")


def load_model(path: str):
    """Load a saved pipeline model."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(f"{path}/model")

