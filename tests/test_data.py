import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.operators import derive, quality, split
from riskframe.sources.readers import read_clinical, read_delimited, CLINICAL_TYPES


def _write(text):
    d = tempfile.mkdtemp(prefix="riskframe-csv-")
    p = os.path.join(d, "data.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_missing_target_column_fails(spark):
    header = ";".join(S.RAW_COLUMNS[:-1])
    p = _write(header + "\n" + ";".join(["1"] * (len(S.RAW_COLUMNS) - 1)) + "\n")
    with pytest.raises(ValueError, match="cardio"):
        read_delimited(spark, p, CLINICAL_TYPES, S.RAW_COLUMNS)


def test_derived_columns_and_reordered_header(spark):
    cols = list(reversed(S.RAW_COLUMNS))
    row = {c: i for i, c in enumerate(S.RAW_COLUMNS)} | {"age": 14610, "height": 160, "weight": 64, "ap_hi": 131, "ap_lo": 77}
    p = _write(";".join(cols) + ";extra\n" + ";".join(str(row[c]) for c in cols) + ";x\n")
    df = read_clinical(spark, p)
    r = df.first()
    assert r["age_years"] == 40.0           # 14610 / 365.25
    assert r["bmi"] == 25.0                 # 64 / 1.6 ** 2
    assert r["ap_hi"] == 131 and r["ap_lo"] == 77     # mapped by name, not position
    assert "extra" not in df.columns and r["source_path"].endswith("data.csv")


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(2.25,), (2.35,), (-2.25,)], "x double")
    from riskframe.functions.columns import round_half_even
    got = [r[0] for r in df.select(round_half_even("x", 1)).collect()]
    assert got == [2.2, 2.4, -2.2]


def test_inversion_detected(spark):
    df = spark.createDataFrame([(150.0, 80.0, 120.0)], "height double, ap_hi double, ap_lo double")
    rep = quality.quality_report(df, S.CLINICAL_BOUNDS, S.CLINICAL_INVERSION, ()).collect()
    inv = [r for r in rep if r["column"] == "ap_hi/ap_lo"]
    assert inv and inv[0]["affected_rows"] == 1 and inv[0]["severity"] == "alta"


def test_quality_counts_missing_nan_and_duplicates(spark):
    rows = [(1, 100.0, 1), (2, float("nan"), 1), (3, None, 1), (4, 100.0, 1), (5, 300.0, 2)]
    df = spark.createDataFrame(rows, "id long, ap_hi double, gender int")
    rep = {r["column"] + r["description"][:5]: r for r in
           quality.quality_report(df, S.CLINICAL_BOUNDS, None).collect()}
    assert rep["ap_hiPrese"]["affected_rows"] == 2          # null and NaN
    assert rep["<dataset>Linha"]["affected_rows"] == 2      # (100,1) again; NaN equals null
    rng = rep["ap_hiValor"]
    assert rng["affected_rows"] == 1 and rng["severity"] == "alta"   # 1 of 5 > 1 %
    summary = quality.quality_summary(df, label="gender").first()
    assert summary["n_rows"] == 5 and summary["n_missing_total"] == 2
    assert abs(summary["class_balance"]["1"] - 0.8) < 1e-12


def test_duplicates_treat_missing_as_equal(spark):
    rows = [(1, None, 1), (2, None, 1), (3, float("nan"), 1), (4, float("nan"), 1), (5, 1.0, 1)]
    df = spark.createDataFrame(rows, "id long, x double, g int")
    assert quality.duplicate_count(df).first()["n_duplicates"] == 3   # null and NaN are one value


def test_validation_rules(spark):
    df = spark.createDataFrame([(50.0, 170.0, 70.0, 120.0, 80.0, 1, 1, 1, 0, 0, 1),
                                (10.0, 170.0, 70.0, 120.0, 80.0, 3, 1, 1, 0, 0, 1)],
                               "age_years double, height double, weight double, ap_hi double, "
                               "ap_lo double, gender int, cholesterol int, gluc int, smoke int, "
                               "alco int, active int")
    v = quality.validate(df).collect()
    assert v[0]["is_valid"] and v[0]["violations"] == []
    assert not v[1]["is_valid"] and v[1]["violations"] == ["age_years:range", "gender:enum"]


def test_split_ratio(clinical):
    s = split.hash_split(clinical, F.col("id").cast("string"), 42, 0.2)
    share = s.where("split = 'test'").count() / s.count()
    assert abs(share - 0.2) < 0.05


def test_exact_split_quotas(clinical):
    s = split.exact_stratified_split(clinical, F.col("id").cast("string"), "label", 42, 0.2)
    counts = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n = clinical.count()
    n_test = sum(v for (l, sp), v in counts.items() if sp == "test")
    assert n_test == math.ceil(0.2 * n)
    for lab in (0, 1):
        n_c = counts.get((lab, "test"), 0) + counts.get((lab, "train"), 0)
        assert abs(counts.get((lab, "test"), 0) - n_c * 0.2) <= 1


def test_class_quotas_largest_remainder():
    assert split.class_quotas([(0, 5), (1, 5)], 0.3) == {0: 2, 1: 1}
    assert sum(split.class_quotas([(0, 7), (1, 6), (2, 4)], 0.2).values()) == 4


def test_folds_balanced(clinical):
    f = split.stratified_folds(clinical, F.col("id").cast("string"), "label", 5, 42)
    sizes = {}
    for r in f.groupBy("label", "fold").count().collect():
        sizes.setdefault(r["label"], []).append(r["count"])
    for v in sizes.values():
        assert len(v) == 5 and max(v) - min(v) <= 1


def test_derived_bands(spark):
    df = spark.createDataFrame([(17.0, 185.0, 95.0), (24.9, 119.0, 79.0), (31.0, 135.0, 70.0)],
                               "bmi double, ap_hi double, ap_lo double").withColumn("age_years", F.lit(47.0))
    out = derive.add_feature_bands(df).collect()
    assert [r["bmi_class"] for r in out] == ["abaixo", "normal", "obeso"]
    assert [r["bp_category"] for r in out] == ["crise", "normal", "hipertensao_1"]
    assert out[0]["age_decade"] == 40 and out[0]["pulse_pressure"] == 90.0


def test_split_with_folds_equals_two_passes(clinical):
    key = F.col("id").cast("string")
    one, train_counts = split.split_with_folds(clinical, key, "label", 42, 0.2, 5)
    two = split.exact_stratified_split(clinical, key, "label", 42, 0.2)
    folds = split.stratified_folds(two.where("split = 'train'"), key, "label", 5, 42)
    a = sorted((r["id"], r["split"], r["fold"]) for r in one.collect())
    b = sorted([(r["id"], "train", r["fold"]) for r in folds.collect()]
               + [(r["id"], "test", None) for r in two.where("split = 'test'").collect()])
    assert a == b
    assert sum(train_counts.values()) == one.where("split = 'train'").count()


def test_hashed_duplicate_count_equals_exact(spark):
    import random
    rnd = random.Random(3)
    base = [(rnd.choice([None, float("nan"), 0.0, -0.0, 1.5, 2.5]), rnd.randint(0, 3),
             rnd.choice(["a", "b", None])) for _ in range(400)]
    rows = [(i, *r) for i, r in enumerate(base)]
    df = spark.createDataFrame(rows, "id long, x double, k int, s string")
    exact = quality.duplicate_count(df).first()
    hashed = quality.duplicate_count_hashed(df, broadcast_limit=2).first()
    assert (hashed["n_rows"], hashed["n_duplicates"]) == (exact["n_rows"], exact["n_duplicates"])
    assert exact["n_duplicates"] > 0
