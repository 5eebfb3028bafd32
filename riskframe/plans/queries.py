"""Registered queries: one per operator family, each with DuckDB oracle SQL.

Every query reads the driver tables (or frames Spark derives from them)
in full. Floating results that come from sums in engine-dependent order
are rounded to ``DIGITS`` decimals on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions import bands
from riskframe.functions.columns import round_half_even
from riskframe.operators import drift, explore, metrics, monitor, quality, runs, split
from riskframe.plans import standins as D

DIGITS = 10
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r(c: Column | str, digits: int = DIGITS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[r(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# SQL building blocks (DuckDB)
# ---------------------------------------------------------------------------

SQL_KEY = ("concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber, "
           "CAST(round(l_extendedprice * 100) AS BIGINT))")
SQL_QF = f"""qf AS (
  SELECT {SQL_KEY} AS row_id, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS disc_per_tax
  FROM lineitem)"""


def sql_u(key: str, seed: int, salt: str = "") -> str:
    parts = f"{key}, '{seed}'" + (f", '{salt}'" if salt else "")
    return f"(('0x' || substr(md5(concat_ws(':', {parts})), 1, 8))::UBIGINT / 4294967296.0)"


def sql_missing(c: str, floating: bool = True) -> str:
    return f"({c} IS NULL OR isnan({c}))" if floating else f"({c} IS NULL)"


QF_COLS = [("row_id", False), ("l_quantity", True), ("l_extendedprice", True),
           ("l_discount", True), ("l_tax", True), ("l_returnflag", False),
           ("l_linestatus", False), ("disc_per_tax", True)]


# ---------------------------------------------------------------------------
# Quality (A1-A7, F1-F3, P18)
# ---------------------------------------------------------------------------

@register("quality_missing", f"""
WITH {SQL_QF}
{' UNION ALL '.join(
    f"SELECT '{c}' AS column, {i} AS position, "
    f"CAST(count_if({sql_missing(c, fl)}) AS BIGINT) AS n_missing FROM qf"
    for i, (c, fl) in enumerate(QF_COLS))}
""")
def q_quality_missing(spark, sf):
    return quality.missing_counts(D.quality_frame(spark, sf))


@register("quality_duplicates", f"""
WITH {SQL_QF}
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, disc_per_tax FROM qf)) AS n_distinct,
       CAST(count(*) AS BIGINT) - (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, disc_per_tax FROM qf))
           AS n_duplicates
FROM qf
""")
def q_quality_duplicates(spark, sf):
    return quality.duplicate_count(D.quality_frame(spark, sf), exclude=("row_id",))


@register("quality_duplicates_hashed", ORACLE["quality_duplicates"])
def q_quality_duplicates_hashed(spark, sf):
    """A3 by the two-phase hashed method: must equal the exact count."""
    return quality.duplicate_count_hashed(D.quality_frame(spark, sf), exclude=("row_id",))


def _sql_range_rows() -> list[tuple]:
    return [(rr.column, rr.low, rr.high) for rr in D.LINEITEM_RANGES]


@register("quality_ranges", f"""
WITH {SQL_QF}, n AS (SELECT count(*) AS n_rows FROM qf),
rules AS (
{' UNION ALL '.join(
    f"SELECT '{c}' AS column, CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high, "
    f"CAST(count_if(NOT {sql_missing(c)} AND ({c} < {lo} OR {c} > {hi})) AS BIGINT) AS affected_rows "
    f"FROM qf" for c, lo, hi in _sql_range_rows())})
SELECT "column", low, high, affected_rows,
       CASE WHEN affected_rows > n_rows * 0.01 THEN 'alta' ELSE 'baixa' END AS severity
FROM rules, n
""")
def q_quality_ranges(spark, sf):
    return quality.range_issues(D.quality_frame(spark, sf), D.LINEITEM_RANGES)


def _sql_report() -> str:
    items = []
    order = 0
    for c, fl in QF_COLS:
        items.append(f"SELECT {order} AS issue_order, '{c}' AS column, '{S.DESC_MISSING}' AS description, "
                     f"CAST(count_if({sql_missing(c, fl)}) AS BIGINT) AS affected_rows, 'media' AS severity FROM qf")
        order += 1
    items.append(f"SELECT {order}, '{S.DATASET_COLUMN}', '{S.DESC_DUPLICATES}', "
                 "CAST((SELECT count(*) FROM qf) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, "
                 "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, disc_per_tax FROM qf)) "
                 "AS BIGINT), 'media'")
    order += 1
    for c, lo, hi in _sql_range_rows():
        desc = S.DESC_RANGE.format(low=repr(float(lo)), high=repr(float(hi)))
        cnt = f"count_if(NOT {sql_missing(c)} AND ({c} < {lo} OR {c} > {hi}))"
        items.append(f"SELECT {order}, '{c}', '{desc}', CAST({cnt} AS BIGINT), "
                     f"CASE WHEN {cnt} > count(*) * 0.01 THEN 'alta' ELSE 'baixa' END FROM qf")
        order += 1
    inv = D.LINEITEM_INVERSION
    items.append(f"SELECT {order}, '{inv.high_col}/{inv.low_col}', '{D.LINEITEM_INVERSION_DESC}', "
                 f"CAST(count_if({inv.low_col} > {inv.high_col}) AS BIGINT), 'alta' FROM qf")
    return (f"WITH {SQL_QF}, issues AS ({' UNION ALL '.join(items)}) "
            "SELECT * FROM issues WHERE affected_rows > 0")


@register("quality_report", _sql_report())
def q_quality_report(spark, sf):
    return quality.quality_report(D.quality_frame(spark, sf), D.LINEITEM_RANGES,
                                  D.LINEITEM_INVERSION, ("row_id",),
                                  D.LINEITEM_INVERSION_DESC)


@register("quality_date_inversion", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count_if(o.o_orderdate > l.l_shipdate) AS BIGINT) AS n_inverted
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def q_quality_date_inversion(spark, sf):
    li = D.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(quality.inverted(S.InversionRule("l_shipdate", "o_orderdate")))
                 .alias("n_inverted"))


@register("class_balance", """
SELECT l_returnflag AS value, CAST(count(*) AS BIGINT) AS n,
       count(*) / (SELECT count(*) FROM lineitem WHERE l_returnflag IS NOT NULL) AS proportion
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
""")
def q_class_balance(spark, sf):
    return quality.proportions(D.table(spark, sf, "lineitem"), "l_returnflag")


@register("subgroup_balance", """
SELECT c_mktsegment AS value, CAST(count(*) AS BIGINT) AS n,
       count(*) / (SELECT count(*) FROM customer WHERE c_mktsegment IS NOT NULL) AS proportion
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
""")
def q_subgroup_balance(spark, sf):
    return quality.proportions(D.table(spark, sf, "customer"), "c_mktsegment")


# ---------------------------------------------------------------------------
# Validation and cleaning
# ---------------------------------------------------------------------------

def _sql_violations(rules: S.ValidationRules = D.LINEITEM_RULES) -> str:
    parts = []
    for rr in rules.ranges:
        c = rr.column
        parts.append(f"CASE WHEN {sql_missing(c)} THEN '{c}:missing' END")
        parts.append(f"CASE WHEN NOT {sql_missing(c)} AND ({c} < {rr.low} OR {c} > {rr.high}) "
                     f"THEN '{c}:range' END")
    for c, allowed in rules.enums:
        vals = ", ".join(f"'{v}'" for v in allowed)
        parts.append(f"CASE WHEN {c} IS NULL THEN '{c}:missing' END")
        parts.append(f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN ({vals}) THEN '{c}:enum' END")
    return ", ".join(parts)


@register("validate_records", f"""
WITH {SQL_QF}, v AS (SELECT row_id, concat_ws(',', {_sql_violations()}) AS violations FROM qf)
SELECT row_id, violations,
       CAST(CASE WHEN violations = '' THEN 0 ELSE len(string_split(violations, ',')) END AS INTEGER)
           AS n_violations,
       violations = '' AS is_valid
FROM v
""")
def q_validate_records(spark, sf):
    v = quality.validate(D.quality_frame(spark, sf), D.LINEITEM_RULES)
    return v.select("row_id", F.array_join("violations", ",").alias("violations"),
                    F.size("violations").alias("n_violations"), "is_valid")


@register("quarantine_reasons", f"""
WITH {SQL_QF}, v AS (SELECT row_id, concat_ws(',', {_sql_violations()}) AS violations FROM qf)
SELECT reason, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT unnest(string_split(violations, ',')) AS reason FROM v WHERE violations <> '')
GROUP BY reason
""")
def q_quarantine_reasons(spark, sf):
    _, bad = quality.split_valid(D.quality_frame(spark, sf), D.LINEITEM_RULES)
    return (bad.select(F.explode("violations").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


@register("cleaning_filter", f"""
WITH {SQL_QF}
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n_kept FROM qf
WHERE l_quantity > 1 AND l_quantity < 50 AND l_extendedprice > 1000 AND l_extendedprice < 100000
  AND l_tax < l_discount
GROUP BY l_returnflag
""")
def q_cleaning_filter(spark, sf):
    kept = quality.cleaning_filter(D.quality_frame(spark, sf),
                                   {"l_quantity": (1.0, 50.0), "l_extendedprice": (1000.0, 100000.0)},
                                   D.LINEITEM_INVERSION)
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_kept"))


# ---------------------------------------------------------------------------
# Derived columns (P1, P2, P4, P14-P17) and bands
# ---------------------------------------------------------------------------

SQL_CLIN = f"""clin AS (
  SELECT {SQL_KEY} AS row_id,
         datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS age,
         l_quantity + 150.0 AS height, l_extendedprice / 1000.0 AS weight,
         l_quantity * 2.0 + 90.0 AS ap_hi, l_tax * 1000.0 + 50.0 AS ap_lo,
         CASE WHEN l_tax * 1e6 = 0 THEN NULL ELSE l_extendedprice / (l_tax * 1e6) END AS bmi_reported,
         l_quantity + 20.0 AS age_band_years
  FROM lineitem)"""
SQL_BMI = "round_even(weight / pow(height / 100.0, 2) * 100.0, 0) / 100.0"


@register("derived_columns", f"""
WITH {SQL_CLIN}, d AS (
  SELECT row_id, round_even(age / 365.25 * 10.0, 0) / 10.0 AS age_years,
         {SQL_BMI} AS bmi, bmi_reported, ap_hi, ap_lo, age_band_years FROM clin)
SELECT row_id, age_years, bmi,
       round_even(coalesce(bmi_reported, bmi) * 100.0, 0) / 100.0 AS bmi_filled,
       ap_hi - ap_lo AS pulse_pressure,
       CASE WHEN bmi IS NULL OR isnan(bmi) THEN NULL WHEN bmi < 18.5 THEN 'abaixo'
            WHEN bmi < 25.0 THEN 'normal' WHEN bmi < 30.0 THEN 'sobrepeso' ELSE 'obeso' END AS bmi_class,
       CAST(floor(age_band_years / 10) * 10 AS BIGINT) AS age_decade,
       CASE WHEN ap_hi > 180.0 OR ap_lo > 120.0 THEN 'crise'
            WHEN ap_hi >= 140.0 OR ap_lo >= 90.0 THEN 'hipertensao_2'
            WHEN ap_hi >= 130.0 OR ap_lo >= 80.0 THEN 'hipertensao_1'
            WHEN ap_hi >= 120.0 THEN 'elevada' ELSE 'normal' END AS bp_category
FROM d
""")
def q_derived_columns(spark, sf):
    from riskframe.operators import derive
    c = D.clinical_like(spark, sf)
    d = derive.fill_bmi(derive.augment(c, age_days="age", weight="weight", height="height"), "bmi_reported")
    return d.select(
        "row_id", "age_years", "bmi",
        round_half_even(F.col("bmi_reported"), 2).alias("bmi_filled"),
        derive.pulse_pressure("ap_hi", "ap_lo").alias("pulse_pressure"),
        bands.bmi_class("bmi").alias("bmi_class"),
        bands.decade("age_band_years").alias("age_decade"),
        bands.bp_category("ap_hi", "ap_lo").alias("bp_category"))


SQL_DOCS = """sd AS (
  SELECT l.doc_id, l.quality, l.toxic, d.n_chars, d.lang, d.source,
         least(d.n_chars / 20000.0, 1.0) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
sdp AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction,
               CAST(score >= 0.3 AS INTEGER) AS candidate FROM sd)"""


@register("risk_bands", """
SELECT doc_id, least(n_chars / 20000.0, 1.0) AS probability,
       CAST(least(n_chars / 20000.0, 1.0) >= 0.5 AS INTEGER) AS predicted_class,
       CASE WHEN least(n_chars / 20000.0, 1.0) < 0.35 THEN 'baixo'
            WHEN least(n_chars / 20000.0, 1.0) < 0.65 THEN 'moderado' ELSE 'alto' END AS risk_level
FROM documents
""")
def q_risk_bands(spark, sf):
    d = D.table(spark, sf, "documents")
    p = F.least(F.col("n_chars") / 20000.0, F.lit(1.0))
    return d.select("doc_id", p.alias("probability"),
                    (p >= S.CLASS_THRESHOLD).cast("int").alias("predicted_class"),
                    bands.risk_band(p).alias("risk_level"))


# ---------------------------------------------------------------------------
# Splits, folds and samples
# ---------------------------------------------------------------------------

SEED = D.SEED


@register("hash_split", f"""
WITH {SQL_QF}
SELECT row_id, CASE WHEN {sql_u('row_id', SEED)} < 0.2 THEN 'test' ELSE 'train' END AS split FROM qf
""")
def q_hash_split(spark, sf):
    qf = D.quality_frame(spark, sf)
    return split.hash_split(qf, F.col("row_id"), SEED, 0.2).select("row_id", "split")


SQL_RANKS = f"""rk AS (
  SELECT row_id, l_returnflag,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY {sql_u('row_id', SEED)}, row_id) AS rk
  FROM qf)"""


@register("exact_stratified_split", f"""
WITH {SQL_QF},
c AS (SELECT l_returnflag, count(*) AS n_c FROM qf GROUP BY l_returnflag),
t AS (SELECT sum(n_c) AS n, ceil(CAST(0.2 AS DOUBLE) * sum(n_c)) AS n_test FROM c),
ideal AS (SELECT l_returnflag, n_c * n_test / n AS ideal, floor(n_c * n_test / n) AS fl FROM c, t),
lft AS (SELECT (SELECT n_test FROM t) - (SELECT sum(fl) FROM ideal) AS lft),
q AS (SELECT l_returnflag, fl + CASE WHEN row_number() OVER (ORDER BY ideal - fl DESC, l_returnflag)
                                    <= (SELECT lft FROM lft) THEN 1 ELSE 0 END AS quota FROM ideal),
{SQL_RANKS}
SELECT row_id, l_returnflag, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split
FROM rk JOIN q USING (l_returnflag)
""")
def q_exact_stratified_split(spark, sf):
    qf = D.quality_frame(spark, sf).select("row_id", "l_returnflag")
    return split.exact_stratified_split(qf, F.col("row_id"), "l_returnflag", SEED, 0.2)


@register("stratified_folds", f"""
WITH {SQL_QF}, {SQL_RANKS}
SELECT row_id, l_returnflag, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM rk
""")
def q_stratified_folds(spark, sf):
    qf = D.quality_frame(spark, sf).select("row_id", "l_returnflag")
    return split.stratified_folds(qf, F.col("row_id"), "l_returnflag", 5, SEED)


@register("hash_sample", f"""
WITH {SQL_QF}
SELECT row_id, l_returnflag FROM qf WHERE {sql_u('row_id', SEED, 'sample')} < 0.1
""")
def q_hash_sample(spark, sf):
    qf = D.quality_frame(spark, sf).select("row_id", "l_returnflag")
    return split.hash_sample(qf, F.col("row_id"), 0.1, SEED)


@register("canary_route", f"""
SELECT event_id, CASE WHEN {sql_u('CAST(event_id AS VARCHAR)', SEED, 'canary')} < 0.1
                      THEN 'v2' ELSE 'v1' END AS model_version
FROM events
""")
def q_canary_route(spark, sf):
    ev = D.table(spark, sf, "events").select("event_id")
    return split.canary_route(ev, F.col("event_id").cast("string"), SEED, S.CANARY_SHARE,
                              "v2", "v1")


# ---------------------------------------------------------------------------
# Exploration
# ---------------------------------------------------------------------------

NUM = list(D.LINEITEM_NUMERIC)


@register("correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
    f"CAST(count_if({a} IS NOT NULL AND {b} IS NOT NULL) AS BIGINT) AS n, "
    f"round(corr({a}, {b}), {DIGITS}) AS corr FROM lineitem"
    for i, a in enumerate(NUM) for b in NUM[i + 1:]))
def q_correlation(spark, sf):
    c = explore.correlation_pairs(D.table(spark, sf, "lineitem"), NUM)
    return _rounded(c, ["corr"])


def _sql_histogram(bins: int = 40) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM lineitem"
                              for c in NUM)
    return f"""
WITH long AS ({long}),
rng0 AS (SELECT col, min(value) AS vmin, max(value) AS vmax FROM long
         WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY col),
rng AS (SELECT col, CASE WHEN vmin = vmax THEN vmin - 0.5 ELSE vmin END AS lo,
               CASE WHEN vmin = vmax THEN vmax + 0.5 ELSE vmax END AS hi FROM rng0),
cnt AS (SELECT l.col, CAST(least(floor((value - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin,
               count(*) AS c
        FROM long l JOIN rng r ON l.col = r.col
        WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL),
grid AS (SELECT col, lo, hi, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM rng)
SELECT g.col AS "column", g.bin,
       round(lo + g.bin * ((hi - lo) / {bins}), {DIGITS}) AS bin_low,
       round(lo + (g.bin + 1) * ((hi - lo) / {bins}), {DIGITS}) AS bin_high,
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN cnt ON g.col = cnt.col AND g.bin = cnt.bin"""


@register("histogram", _sql_histogram())
def q_histogram(spark, sf):
    h = explore.histogram(D.table(spark, sf, "lineitem"), NUM, 40)
    return _rounded(h, ["bin_low", "bin_high"])


@register("value_counts", """
SELECT p_type AS value, CAST(count(*) AS BIGINT) AS count FROM part GROUP BY p_type
""")
def q_value_counts(spark, sf):
    return explore.value_counts(D.table(spark, sf, "part"), "p_type")


# ---------------------------------------------------------------------------
# Classification metrics
# ---------------------------------------------------------------------------

METRIC_DOUBLES = ["accuracy", "precision", "recall", "f1", "expected_cost_per_case",
                  "capture_rate", "false_alarm_rate", "positives_caught_over_random",
                  "cost_weight_fn", "cost_weight_fp", "roc_auc", "average_precision"]


def sql_rates(src: str, keys: str = "") -> str:
    """Confusion counts and rates per group from a frame with quality/prediction."""
    kc = f"{keys}, " if keys else ""
    gb = f"GROUP BY {keys}" if keys else ""
    return f"""(SELECT {kc}tp, fp, fn, tn, n,
        CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END AS accuracy,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
        CASE WHEN n = 0 THEN 0.0 ELSE (5.0 * fn + 1.0 * fp) / n END AS expected_cost_per_case,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS capture_rate,
        CASE WHEN fp + tn = 0 THEN 0.0 ELSE fp / (fp + tn) END AS false_alarm_rate,
        tp - (CASE WHEN n = 0 THEN 0.0 ELSE (tp + fn) / n END) * (tp + fn) AS positives_caught_over_random,
        CAST(5.0 AS DOUBLE) AS cost_weight_fn, CAST(1.0 AS DOUBLE) AS cost_weight_fp
      FROM (SELECT {kc}CAST(count_if(quality = 1 AND prediction = 1) AS BIGINT) AS tp,
                   CAST(count_if(quality = 0 AND prediction = 1) AS BIGINT) AS fp,
                   CAST(count_if(quality = 1 AND prediction = 0) AS BIGINT) AS fn,
                   CAST(count_if(quality = 0 AND prediction = 0) AS BIGINT) AS tn,
                   CAST(count(*) AS BIGINT) AS n
            FROM {src} WHERE quality IS NOT NULL AND prediction IS NOT NULL {gb}))"""


def sql_auc_ap(src: str, keys: str = "") -> str:
    kc = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    gb = f"GROUP BY {keys}" if keys else ""
    return f"""(SELECT {kc}
        CASE WHEN sum(pos) > 0 AND sum(neg) > 0
             THEN sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc,
        CASE WHEN sum(pos) > 0 THEN sum(pos * cum_pos / cum_all) / sum(pos) END AS average_precision
      FROM (SELECT *, sum(neg) OVER ({part}ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg,
                   sum(pos) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
                   sum(pos + neg) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_all
            FROM (SELECT {kc}score, CAST(count_if(quality = 1) AS BIGINT) AS pos,
                         CAST(count_if(quality = 0) AS BIGINT) AS neg
                  FROM {src} WHERE quality IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)
                  GROUP BY {kc}score))
      {gb})"""


def _round_sql(cols: list[str], keep: list[str]) -> str:
    return ", ".join(keep + [f"round({c}, {DIGITS}) AS {c}" for c in cols])


@register("classification_report", f"""
WITH {SQL_DOCS}
SELECT {_round_sql(METRIC_DOUBLES, ['tp', 'fp', 'fn', 'tn', 'n'])}
FROM {sql_rates('sdp')} m, {sql_auc_ap('sdp')} a
""")
def q_classification_report(spark, sf):
    d = D.scored_documents(spark, sf)
    return _rounded(metrics.evaluate(d, "quality", "prediction", "score"), METRIC_DOUBLES)


@register("metrics_by_lang", f"""
WITH {SQL_DOCS}
SELECT {_round_sql(METRIC_DOUBLES, ['m.lang', 'tp', 'fp', 'fn', 'tn', 'n'])}
FROM {sql_rates('sdp', 'lang')} m JOIN {sql_auc_ap('sdp', 'lang')} a ON m.lang = a.lang
""")
def q_metrics_by_lang(spark, sf):
    d = D.scored_documents(spark, sf)
    return _rounded(metrics.evaluate(d, "quality", "prediction", "score", ("lang",)),
                    METRIC_DOUBLES)


@register("metrics_long", f"""
WITH {SQL_DOCS}, m AS (SELECT * FROM {sql_rates('sdp')} x, {sql_auc_ap('sdp')} y)
SELECT metric, round(value, {DIGITS}) AS value FROM (
{' UNION ALL '.join(f"SELECT '{p}.{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM m" for p, c in
                    [('tech', c) for c in ('accuracy', 'precision', 'recall', 'f1', 'roc_auc',
                                           'average_precision')]
                    + [('biz', c) for c in ('expected_cost_per_case', 'capture_rate',
                                            'false_alarm_rate', 'positives_caught_over_random',
                                            'cost_weight_fn', 'cost_weight_fp')])})
""")
def q_metrics_long(spark, sf):
    d = D.scored_documents(spark, sf)
    return _rounded(metrics.flatten_metrics(metrics.evaluate(d, "quality", "prediction", "score")),
                    ["value"])


@register("subgroup_audit", f"""
WITH {SQL_DOCS},
g AS (SELECT lang, source, grouping(lang) AS g_lang, grouping(source) AS g_source,
             CAST(count_if(quality = 1 AND prediction = 1) AS BIGINT) AS tp,
             CAST(count_if(quality = 0 AND prediction = 1) AS BIGINT) AS fp,
             CAST(count_if(quality = 1 AND prediction = 0) AS BIGINT) AS fn,
             CAST(count_if(quality = 0 AND prediction = 0) AS BIGINT) AS tn
      FROM sdp WHERE quality IS NOT NULL AND prediction IS NOT NULL
      GROUP BY GROUPING SETS ((lang), (source), ())),
m AS (SELECT CASE WHEN g_lang = 0 THEN 'lang' WHEN g_source = 0 THEN 'source' ELSE 'overall' END AS dimension,
             CASE WHEN g_lang = 0 THEN coalesce(lang, '<null>') WHEN g_source = 0 THEN coalesce(source, '<null>')
                  ELSE 'all' END AS level,
             tp + fp + fn + tn AS n, tp, fp, fn, tn,
             CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS accuracy,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
             CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM g),
o AS (SELECT f1 AS overall_f1 FROM m WHERE dimension = 'overall')
SELECT dimension, level, n, tp, fp, fn, tn, round(accuracy, {DIGITS}) AS accuracy,
       round(precision, {DIGITS}) AS precision, round(recall, {DIGITS}) AS recall,
       round(f1, {DIGITS}) AS f1, round(overall_f1, {DIGITS}) AS overall_f1,
       round(f1 - overall_f1, {DIGITS}) AS f1_gap, abs(f1 - overall_f1) > 0.05 AS flag
FROM m, o
""")
def q_subgroup_audit(spark, sf):
    d = D.scored_documents(spark, sf)
    a = metrics.subgroup_audit(d, "quality", "prediction", ["lang", "source"], 0.05)
    return _rounded(a, ["accuracy", "precision", "recall", "f1", "overall_f1", "f1_gap"])


# ---------------------------------------------------------------------------
# Drift (A21-A28, W3, P12, P9)
# ---------------------------------------------------------------------------

FRACS = drift.linspace(S.PSI_BINS)
SQL_FRACS = "[" + ", ".join(repr(q) for q in FRACS) + "]::DOUBLE[]"
TWO_PI = repr(2.0 * 3.141592653589793)


def _sql_z(key: str) -> str:
    return (f"(sqrt(-2.0 * ln(1.0 - {sql_u(key, SEED, 'n1')})) * "
            f"cos({TWO_PI} * {sql_u(key, SEED, 'n2')}))")


SQL_EV = """ev AS (
  SELECT event_id, ts, user_id, value,
         CAST((CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 + 3) % 3 + 1 AS INTEGER) AS level,
         datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) + 1 AS dom, least(value / 500.0, 1.0) AS prediction
  FROM events)"""
SQL_DRIFT_SAMPLES = f"""{SQL_EV},
ref AS (SELECT * FROM ev WHERE dom <= 20),
cur AS (SELECT event_id, ts, value + 3.0 AS value,
               user_id + (7.0 + 2.0 * {_sql_z('CAST(event_id AS VARCHAR)')}) AS user_id,
               CASE WHEN level = 1 AND {sql_u('CAST(event_id AS VARCHAR)', SEED, 'lvl')} < 0.2
                    THEN 2 ELSE level END AS level, prediction
        FROM ev WHERE dom > 20)"""


def _sql_long(src: str, with_prediction: bool = True) -> str:
    parts = [f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {src}"
             for f in D.EVENT_FEATURES]
    if with_prediction:
        parts.append(f"SELECT 'prediction' AS feature, prediction AS value FROM {src}")
    return " UNION ALL ".join(parts)


SQL_LONG = f"""{SQL_DRIFT_SAMPLES},
rl AS (SELECT * FROM ({_sql_long('ref')}) WHERE value IS NOT NULL AND NOT isnan(value)),
cl AS (SELECT * FROM ({_sql_long('cur')}) WHERE value IS NOT NULL AND NOT isnan(value))"""

SQL_PSI = f"""edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {SQL_FRACS}))) AS edges
          FROM rl GROUP BY feature),
rb AS (SELECT rl.feature, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin,
              count(*) AS n_ref FROM rl JOIN edges e ON rl.feature = e.feature WHERE len(edges) >= 3
       GROUP BY ALL),
cb AS (SELECT cl.feature, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin,
              count(*) AS n_cur FROM cl JOIN edges e ON cl.feature = e.feature WHERE len(edges) >= 3
       GROUP BY ALL),
grid AS (SELECT feature, unnest(range(0, len(edges) - 1)) AS bin FROM edges WHERE len(edges) >= 3),
tr AS (SELECT feature, count(*) AS total_ref FROM rl GROUP BY feature),
tc AS (SELECT feature, count(*) AS total_cur FROM cl GROUP BY feature),
pb AS (SELECT g.feature, coalesce(n_ref, 0) / greatest(total_ref, 1) + 1e-6 AS pr,
              coalesce(n_cur, 0) / greatest(total_cur, 1) + 1e-6 AS pc
       FROM grid g LEFT JOIN rb ON g.feature = rb.feature AND g.bin = rb.bin
                   LEFT JOIN cb ON g.feature = cb.feature AND g.bin = cb.bin
                   LEFT JOIN tr ON g.feature = tr.feature LEFT JOIN tc ON g.feature = tc.feature),
ps AS (SELECT feature, sum((pc - pr) * ln(pc / pr)) AS psi_sum FROM pb GROUP BY feature),
psi AS (SELECT tr.feature, CASE WHEN coalesce(total_ref, 0) = 0 OR coalesce(total_cur, 0) = 0 THEN 'NaN'::DOUBLE
                                 WHEN len(edges) < 3 THEN 0.0 ELSE psi_sum END AS psi,
               CAST(coalesce(total_ref, 0) AS BIGINT) AS n_ref, CAST(coalesce(total_cur, 0) AS BIGINT) AS n_cur
        FROM tr LEFT JOIN tc ON tr.feature = tc.feature LEFT JOIN ps ON tr.feature = ps.feature
                LEFT JOIN edges e ON tr.feature = e.feature)"""

SQL_KS = """kt AS (SELECT feature, value, 1 AS r, 0 AS c FROM rl UNION ALL SELECT feature, value, 0, 1 FROM cl),
kc AS (SELECT feature, value, sum(r) AS nr, sum(c) AS nc FROM kt GROUP BY ALL),
kcum AS (SELECT *, sum(nr) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
                sum(nc) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc,
                sum(nr) OVER (PARTITION BY feature) AS tr, sum(nc) OVER (PARTITION BY feature) AS tc
         FROM kc),
kd AS (SELECT feature, max(abs(cr / tr - cc / tc)) AS d, any_value(tr) AS tr, any_value(tc) AS tc
       FROM kcum GROUP BY feature),
ks AS (SELECT feature, CASE WHEN tr > 0 AND tc > 0 THEN d END AS ks_statistic,
              sqrt(tr * tc / (tr + tc)) * d AS lam FROM kd),
ksp AS (SELECT feature, ks_statistic,
               CASE WHEN lam IS NULL THEN NULL WHEN lam < 0.2 THEN 1.0
                    ELSE least(1.0, greatest(0.0, (SELECT sum(2.0 * (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)
                                                              * exp(-2.0 * k * k * lam * lam))
                                                   FROM range(1, 101) t(k)))) END AS ks_pvalue
        FROM ks)"""

SQL_VERDICT = ("CASE WHEN psi IS NULL OR isnan(psi) THEN 'drift' WHEN psi < 0.1 THEN 'estavel' "
               "WHEN psi < 0.25 THEN 'moderado' ELSE 'drift' END")


def _drift_report(spark, sf):
    ref, cur = D.drift_samples(spark, sf)
    return drift.drift_report(ref, cur, list(D.EVENT_FEATURES), prediction="prediction")


@register("drift_quantiles", f"""
WITH {SQL_LONG}
SELECT feature, CAST(unnest(range(0, {len(FRACS)})) AS INTEGER) AS i, unnest({SQL_FRACS}) AS q,
       round(unnest(quantile_cont(value, {SQL_FRACS})), {DIGITS}) AS quantile
FROM rl GROUP BY feature
""")
def q_drift_quantiles(spark, sf):
    ref, cur = D.drift_samples(spark, sf)
    long, _, _ = drift.long_pair(ref, cur, list(D.EVENT_FEATURES), "prediction")
    return _rounded(drift.exact_quantiles(long, FRACS), ["quantile"])


@register("psi_bins", f"""
WITH {SQL_LONG}, {SQL_PSI}
SELECT g.feature, CAST(g.bin AS INTEGER) AS bin, CAST(coalesce(n_ref, 0) AS BIGINT) AS n_ref,
       CAST(coalesce(n_cur, 0) AS BIGINT) AS n_cur
FROM grid g LEFT JOIN rb ON g.feature = rb.feature AND g.bin = rb.bin
            LEFT JOIN cb ON g.feature = cb.feature AND g.bin = cb.bin
""")
def q_psi_bins(spark, sf):
    from riskframe.session import cut_lineage
    ref, cur = D.drift_samples(spark, sf)
    rl, cl, _ = drift.long_pair(ref, cur, list(D.EVENT_FEATURES), "prediction")
    collapsed = cut_lineage(drift.collapse_pair(rl, cl))
    edges = (drift._edges(drift.quantiles_from_counts(collapsed, FRACS, "nr"))
             .where(F.size("edges") >= 3))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    counts = (collapsed.join(F.broadcast(edges), "feature")   # one row per feature
              .groupBy("feature", drift.bin_index(F.col("edges"), F.col("value")).alias("bin"))
              .agg(F.sum("nr").alias("n_ref"), F.sum("nc").alias("n_cur")))
    return (grid.join(counts, ["feature", "bin"], "left")
            .fillna(0, ["n_ref", "n_cur"]))


@register("drift_report", f"""
WITH {SQL_LONG}, {SQL_PSI}, {SQL_KS}
SELECT psi.feature, round(psi, {DIGITS}) AS psi, round(ks_statistic, {DIGITS}) AS ks_statistic,
       round(ks_pvalue, {DIGITS}) AS ks_pvalue, {SQL_VERDICT} AS verdict, n_ref, n_cur
FROM psi LEFT JOIN ksp ON psi.feature = ksp.feature
""")
def q_drift_report(spark, sf):
    return _rounded(_drift_report(spark, sf), ["psi", "ks_statistic", "ks_pvalue"])


@register("any_drift", f"""
WITH {SQL_LONG}, {SQL_PSI}
SELECT coalesce(bool_or({SQL_VERDICT} = 'drift'), false) AS has_drift FROM psi
""")
def q_any_drift(spark, sf):
    ref, cur = D.drift_samples(spark, sf)
    return drift.any_drift(drift.psi_report(ref, cur, list(D.EVENT_FEATURES), prediction="prediction"))


@register("drift_injection", f"""
WITH {SQL_DRIFT_SAMPLES}
SELECT event_id, round(value, {DIGITS}) AS value, round(user_id, 6) AS user_id, level FROM cur
""")
def q_drift_injection(spark, sf):
    """P12. The normal noise goes through log/cos, whose last bits differ
    between the JVM and C math libraries: it is compared at 6 decimals."""
    _, cur = D.drift_samples(spark, sf)
    out = cur.select("event_id", "value", r("user_id", 6).alias("user_id"), "level")
    return _rounded(out, ["value"])


@register("psi_retrain", f"""
WITH {SQL_LONG}, {SQL_PSI}
SELECT CAST(count_if(psi > 0.25 AND feature IN ('value', 'user_id', 'level')) AS BIGINT) AS n_features_over,
       count_if(psi > 0.25 AND feature IN ('value', 'user_id', 'level')) >= 2 AS retrain_psi
FROM psi
""")
def q_psi_retrain(spark, sf):
    ref, cur = D.drift_samples(spark, sf)
    report = drift.psi_report(ref, cur, list(D.EVENT_FEATURES), prediction="prediction")
    return monitor.psi_retrain(report, D.EVENT_FEATURES, S.RETRAIN_PSI,
                               S.RETRAIN_MIN_FEATURES)


# ---------------------------------------------------------------------------
# Runs: selection, ranking, pivots
# ---------------------------------------------------------------------------

SQL_RUNS = f"""{SQL_DOCS},
rm AS {sql_rates('sdp', 'source, lang')},
ra AS {sql_auc_ap('sdp', 'source, lang')},
rw AS (SELECT source, lang, sum(n_chars) / 1e5 AS fit_seconds FROM sdp GROUP BY ALL),
runs0 AS (SELECT rm.*, ra.roc_auc, rw.fit_seconds,
                 CASE WHEN rm.source = 'src0' THEN 'dummy' ELSE rm.source END AS fam,
                 CASE WHEN rm.lang = 'fr' THEN 'pca' WHEN rm.lang = 'de' THEN 'lda' ELSE 'none' END AS tech
          FROM rm LEFT JOIN ra ON rm.source = ra.source AND rm.lang = ra.lang
                  JOIN rw ON rm.source = rw.source AND rm.lang = rw.lang),
runs AS (SELECT md5(concat_ws(':', source, lang)) AS run_id,
                CASE WHEN n >= 5 THEN 'FINISHED' ELSE 'FAILED' END AS status,
                fam AS model_family, tech AS dim_technique,
                concat_ws('__', fam, CASE WHEN tech = 'none' THEN 'raw' ELSE tech END, lang) AS run_name,
                n, f1, roc_auc, precision, recall, expected_cost_per_case AS expected_cost, fit_seconds
         FROM runs0)"""

SQL_SCORED = f"""{SQL_RUNS},
cand AS (SELECT * FROM runs WHERE status = 'FINISHED' AND coalesce(model_family, '') <> 'dummy'
         AND f1 IS NOT NULL AND NOT isnan(f1)),
fill AS (SELECT max(f1) AS mf FROM cand),
c2 AS (SELECT cand.*, CASE WHEN expected_cost IS NULL OR isnan(expected_cost) THEN mf ELSE expected_cost END
                      AS cost_filled,
              CASE WHEN fit_seconds IS NULL OR isnan(fit_seconds) THEN 0.0 ELSE fit_seconds END AS fit_filled
       FROM cand, fill),
st AS (SELECT min(f1) AS a1, max(f1) AS b1, min(cost_filled) AS a2, max(cost_filled) AS b2,
              min(fit_filled) AS a3, max(fit_filled) AS b3 FROM c2),
c3 AS (SELECT c2.*, CASE WHEN b1 = a1 THEN 0.5 ELSE (f1 - a1) / (b1 - a1) END AS f1_norm,
              1.0 - CASE WHEN b2 = a2 THEN 0.5 ELSE (cost_filled - a2) / (b2 - a2) END AS cost_norm,
              1.0 - CASE WHEN b3 = a3 THEN 0.5 ELSE (fit_filled - a3) / (b3 - a3) END AS fit_norm
       FROM c2, st),
scored AS (SELECT *, 0.6 * f1_norm + 0.25 * cost_norm + 0.15 * fit_norm AS score FROM c3)"""

RUN_DOUBLES = ["f1", "roc_auc", "precision", "recall", "expected_cost", "fit_seconds",
               "cost_filled", "fit_filled", "f1_norm", "cost_norm", "fit_norm", "score"]


@register("runs_finished", f"""
WITH {SQL_RUNS}
SELECT run_id, run_name, model_family, dim_technique, n, round(f1, {DIGITS}) AS f1
FROM runs WHERE status = 'FINISHED'
""")
def q_runs_finished(spark, sf):
    return _rounded(runs.finished(D.runs_table(spark, sf))
                    .select("run_id", "run_name", "model_family", "dim_technique", "n", "f1"), ["f1"])


@register("run_ranking", f"""
WITH {SQL_SCORED}
SELECT run_id, status, model_family, dim_technique, run_name, n,
       {', '.join(f'round({c}, {DIGITS}) AS {c}' for c in RUN_DOUBLES)},
       CAST(row_number() OVER (ORDER BY score DESC, roc_auc DESC NULLS LAST, run_id) AS INTEGER) AS rank
FROM scored
""")
def q_run_ranking(spark, sf):
    ranked = runs.rank_runs(runs.composite_score(D.runs_table(spark, sf)))
    return _rounded(ranked, RUN_DOUBLES)


SQL_SCORED_GAPS = SQL_SCORED.replace("FROM runs WHERE", "FROM gaps WHERE").replace("cand AS (", """gaps AS (SELECT * REPLACE (
           CASE WHEN n % 7 = 3 THEN NULL ELSE f1 END AS f1, CASE WHEN n % 3 = 0 THEN NULL ELSE expected_cost END AS expected_cost,
           CASE WHEN n % 4 = 1 THEN NULL ELSE fit_seconds END AS fit_seconds) FROM runs),
cand AS (""", 1)


@register("run_ranking_gaps", f"""
WITH {SQL_SCORED_GAPS}
SELECT run_id, run_name, n, {', '.join(f'round({c}, {DIGITS}) AS {c}' for c in ("cost_filled", "fit_filled", "score"))},
       CAST(row_number() OVER (ORDER BY score DESC, roc_auc DESC NULLS LAST, run_id) AS INTEGER) AS rank
FROM scored
""")
def q_run_ranking_gaps(spark, sf):
    """Runs that lack F1 are left out, a missing cost or fit time is filled."""
    gap = lambda c, m, k: F.when(F.col("n") % m != k, F.col(c)).alias(c)
    gaps = {"f1": gap("f1", 7, 3), "expected_cost": gap("expected_cost", 3, 0), "fit_seconds": gap("fit_seconds", 4, 1)}
    table = D.runs_table(spark, sf)
    table = table.select(*[gaps.get(c, F.col(c)) for c in table.columns])
    ranked = runs.rank_runs(runs.composite_score(table))
    return _rounded(ranked.select("run_id", "run_name", "n", "cost_filled", "fit_filled", "score", "rank"), ["cost_filled", "fit_filled", "score"])


@register("registry_winners", f"""
WITH {SQL_SCORED},
ranked AS (SELECT run_id, row_number() OVER (ORDER BY score DESC, roc_auc DESC NULLS LAST, run_id) AS rank FROM scored)
SELECT 'risk' AS model_name, CAST(4 - rank AS INTEGER) AS version, run_id,
       CASE WHEN rank = 1 THEN 'Production' ELSE 'Archived' END AS stage
FROM ranked WHERE rank <= 3
""")
def q_registry_winners(spark, sf):
    """K6 / K7 as users call them: the three best runs are registered, the best one last."""
    from riskframe.session import scratch_path
    best = runs.rank_runs(runs.composite_score(D.runs_table(spark, sf))).where("rank <= 3").orderBy(F.col("rank").desc())
    registry = runs.Registry(spark, scratch_path(spark, "registry"))
    for r in best.select("run_id").collect():  # three rows
        registry.register("risk", r["run_id"])
    return runs.registry_state(registry.events()).select("model_name", "version", "run_id", "stage")


@register("run_winner", f"""
WITH {SQL_SCORED}
SELECT run_id, run_name, round(score, {DIGITS}) AS score, round(roc_auc, {DIGITS}) AS roc_auc
FROM scored ORDER BY score DESC, roc_auc DESC NULLS LAST, run_id LIMIT 1
""")
def q_run_winner(spark, sf):
    w = runs.winner(runs.composite_score(D.runs_table(spark, sf)))
    return _rounded(w.select("run_id", "run_name", "score", "roc_auc"), ["score", "roc_auc"])


@register("f1_pivot", f"""
WITH {SQL_RUNS}
SELECT model_family,
       round(max(f1) FILTER (WHERE dim_technique = 'none'), {DIGITS}) AS "none",
       round(max(f1) FILTER (WHERE dim_technique = 'pca'), {DIGITS}) AS pca,
       round(max(f1) FILTER (WHERE dim_technique = 'lda'), {DIGITS}) AS lda
FROM runs WHERE status = 'FINISHED' GROUP BY model_family
""")
def q_f1_pivot(spark, sf):
    p = runs.f1_pivot(runs.finished(D.runs_table(spark, sf)))
    return _rounded(p, list(S.DIM_TECHNIQUES))


@register("mean_by_model", f"""
WITH {SQL_RUNS}
SELECT model_family, dim_technique, round(avg(f1), {DIGITS}) AS mean_f1,
       CAST(count(*) AS BIGINT) AS n_runs
FROM runs WHERE status = 'FINISHED' GROUP BY model_family, dim_technique
""")
def q_mean_by_model(spark, sf):
    return _rounded(runs.mean_by(runs.finished(D.runs_table(spark, sf))), ["mean_f1"])


@register("delta_vs_raw", f"""
WITH {SQL_RUNS}, f AS (SELECT * FROM runs WHERE status = 'FINISHED'),
raw AS (SELECT model_family, max(f1) AS f1_raw FROM f WHERE dim_technique = 'none' GROUP BY model_family)
SELECT f.model_family, run_id, dim_technique, round(f1, {DIGITS}) AS f1,
       round(f1_raw, {DIGITS}) AS f1_raw, round(f1 - f1_raw, {DIGITS}) AS delta_f1
FROM f LEFT JOIN raw ON f.model_family = raw.model_family
""")
def q_delta_vs_raw(spark, sf):
    d = runs.delta_vs_raw(runs.finished(D.runs_table(spark, sf)))
    return _rounded(d.select("model_family", "run_id", "dim_technique", "f1", "f1_raw",
                             "delta_f1"), ["f1", "f1_raw", "delta_f1"])


@register("cv_summary", f"""
WITH {SQL_DOCS},
fd AS (SELECT *, CAST(floor({sql_u('CAST(doc_id AS VARCHAR)', SEED, 'fold')} * 5) AS INTEGER) AS fold FROM sdp),
fm AS {sql_rates('fd', 'source, lang, fold')}
SELECT md5(concat_ws(':', source, lang)) AS run_id, round(avg(f1), {DIGITS}) AS cv_mean,
       round(stddev_pop(f1), {DIGITS}) AS cv_std, CAST(count(*) AS BIGINT) AS n_folds
FROM fm GROUP BY source, lang
""")
def q_cv_summary(spark, sf):
    return _rounded(runs.cv_summary(D.fold_scores(spark, sf)), ["cv_mean", "cv_std"])


# ---------------------------------------------------------------------------
# Monitoring
# ---------------------------------------------------------------------------

TECH = [m for m, _ in S.METRIC_ALERT_DROPS]


def _sql_metric_rows(src: str, keyed: bool) -> str:
    k = "lang, " if keyed else ""
    return " UNION ALL ".join(f"SELECT {k}'{m}' AS metric, CAST({m.split('.')[1]} AS DOUBLE) AS value "
                              f"FROM {src}" for m in TECH)


@register("metric_alerts", f"""
WITH {SQL_DOCS},
bm AS (SELECT * FROM {sql_rates('sdp')} x, {sql_auc_ap('sdp')} y),
cm AS (SELECT m.*, a.roc_auc, a.average_precision FROM {sql_rates('sdp', 'lang')} m
       JOIN {sql_auc_ap('sdp', 'lang')} a ON m.lang = a.lang),
bl AS ({_sql_metric_rows('bm', False)}),
cl AS ({_sql_metric_rows('cm', True)}),
th AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric, {d} AS max_drop" for m, d in S.METRIC_ALERT_DROPS)})
SELECT lang, cl.metric, round(bl.value, {DIGITS}) AS baseline, round(cl.value, {DIGITS}) AS current,
       CAST(max_drop AS DOUBLE) AS max_drop, round(bl.value - cl.value, {DIGITS}) AS drop,
       bl.value - cl.value > max_drop AS alert
FROM cl JOIN th ON cl.metric = th.metric JOIN bl ON cl.metric = bl.metric
""")
def q_metric_alerts(spark, sf):
    d = D.scored_documents(spark, sf)
    base = metrics.flatten_metrics(metrics.evaluate(d, "quality", "prediction", "score"))
    cur = metrics.flatten_metrics(metrics.evaluate(d, "quality", "prediction", "score", ("lang",)),
                                  ("lang",))
    a = monitor.metric_alerts(base, cur, S.METRIC_ALERT_DROPS, ("lang",))
    return _rounded(a, ["baseline", "current", "drop"])


SQL_EP = """ep AS (SELECT event_id, ts, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS label,
                   CAST(value > 50 AS INTEGER) AS prediction FROM events)"""
ROLL_DOUBLES = ["rolling_recall", "rolling_cost", "baseline_recall"]


@register("rolling_retrain", f"""
WITH {SQL_EP},
dc AS (SELECT CAST(ts AS DATE) AS day,
              CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
              CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
              CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
              CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn
       FROM ep GROUP BY 1),
w AS (SELECT *, {', '.join(
    f"CAST(sum({c}) OVER (ORDER BY day - DATE '1970-01-01' RANGE BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS r_{c}"
    for c in ('tp', 'fp', 'fn', 'tn'))} FROM dc),
b AS (SELECT CASE WHEN sum(tp) + sum(fn) = 0 THEN 0.0 ELSE sum(tp) / (sum(tp) + sum(fn)) END AS baseline_recall FROM dc),
m AS (SELECT w.*, b.baseline_recall,
             CASE WHEN r_tp + r_fn = 0 THEN 0.0 ELSE r_tp / (r_tp + r_fn) END AS rolling_recall,
             CASE WHEN r_tp + r_fp + r_fn + r_tn = 0 THEN 0.0
                  ELSE (5.0 * r_fn + 1.0 * r_fp) / (r_tp + r_fp + r_fn + r_tn) END AS rolling_cost,
             r_tp + r_fp + r_fn + r_tn AS rolling_n FROM w, b)
SELECT day, tp, fp, fn, tn, r_tp, r_fp, r_fn, r_tn, rolling_n,
       {', '.join(f'round({c}, {DIGITS}) AS {c}' for c in ROLL_DOUBLES)},
       baseline_recall - rolling_recall > 0.05 AS trigger_recall, rolling_cost > 2.0 AS trigger_cost,
       datediff('day', DATE '2023-12-01', day) > 182 AS trigger_age, false AS trigger_manual,
       (baseline_recall - rolling_recall > 0.05) OR (rolling_cost > 2.0)
         OR (datediff('day', DATE '2023-12-01', day) > 182) AS retrain
FROM m
""")
def q_rolling_retrain(spark, sf):
    ep = D.event_predictions(spark, sf)
    daily = monitor.daily_confusion(ep, "ts", "label", "prediction")
    base = daily.agg(F.when(F.sum("tp") + F.sum("fn") == 0, F.lit(0.0))
                     .otherwise(F.sum("tp") / (F.sum("tp") + F.sum("fn"))).alias("baseline_recall"))
    rolled = monitor.rolling_metrics(daily).withColumn("__one", F.lit(1))
    rolled = rolled.join(F.broadcast(base.withColumn("__one", F.lit(1))), "__one").drop("__one")
    t = monitor.retrain_triggers(rolled, F.col("baseline_recall"), cost_ceiling=2.0,
                                 last_train_day="2023-12-01")
    return _rounded(t, ROLL_DOUBLES)


@register("promotion_gate", f"""
WITH {SQL_DOCS},
c AS (SELECT CAST(count_if(candidate = quality AND prediction <> quality) AS BIGINT) AS b,
             CAST(count_if(candidate <> quality AND prediction = quality) AS BIGINT) AS c,
             CAST(count(*) AS BIGINT) AS n FROM sdp),
p AS (SELECT b, c, n, least(b, c) AS m, b + c AS nn FROM c),
pv AS (SELECT b, c, n,
              CASE WHEN nn = 0 THEN 1.0
                   ELSE least(1.0, 2.0 * (SELECT sum(exp(lgamma(nn + 1) - lgamma(k + 1) - lgamma(nn - k + 1)
                                                         - nn * ln(2.0)))
                                          FROM range(0, m + 1) t(k))) END AS p_value
       FROM p)
SELECT b, c, n, round(p_value, {DIGITS}) AS p_value, b > c AND p_value < 0.05 AS promote FROM pv
""")
def q_promotion_gate(spark, sf):
    d = D.scored_documents(spark, sf)
    return _rounded(monitor.promotion_gate(d, "quality", "candidate", "prediction"), ["p_value"])


@register("promotion_gate_lineitem", f"""
WITH r AS (SELECT l_returnflag = 'R' AS y, l_quantity > 25 AS cand, l_discount > 0.05 AS prod FROM lineitem),
c AS (SELECT CAST(count_if(cand = y AND prod <> y) AS BIGINT) AS b, CAST(count_if(cand <> y AND prod = y) AS BIGINT) AS c,
             CAST(count(*) AS BIGINT) AS n FROM r),
p AS (SELECT b, c, n, least(b, c) AS m, b + c AS nn FROM c),
pv AS (SELECT b, c, n,
              CASE WHEN nn = 0 THEN 1.0
                   ELSE least(1.0, 2.0 * (SELECT sum(exp(lgamma(nn + 1) - lgamma(k + 1) - lgamma(nn - k + 1)
                                                         - nn * ln(2.0)))
                                          FROM range(0, m + 1) t(k))) END AS p_value
       FROM p)
SELECT b, c, n, round(p_value, 8) AS p_value, b > c AND p_value < 0.05 AS promote FROM pv
""")
def q_promotion_gate_lineitem(spark, sf):
    """L5 / J7 over all of lineitem: two rules paired on every row, with tens of
    thousands of discordant pairs and more."""
    li = D.table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") > 25).cast("int").alias("cand"),
        (F.col("l_discount") > 0.05).cast("int").alias("prod"))
    return monitor.promotion_gate(li, "y", "cand", "prod").withColumn("p_value", F.round("p_value", 8))


@register("daily_psi", f"""
WITH {SQL_EV},
lv AS (SELECT 'value' AS feature, value, ts FROM ev UNION ALL
       SELECT 'user_id', CAST(user_id AS DOUBLE), ts FROM ev),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {SQL_FRACS}))) AS edges
          FROM lv WHERE datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) < 7 GROUP BY feature),
bd AS (SELECT lv.feature, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin,
              CAST(ts AS DATE) AS day, count(*) AS n
       FROM lv JOIN edges e ON lv.feature = e.feature GROUP BY ALL),
days AS (SELECT DISTINCT day FROM bd),
rf AS (SELECT b.feature, b.bin, d.day, sum(b.n) AS ref_n FROM bd b JOIN days d
         ON d.day - b.day BETWEEN 1 AND 28 GROUP BY ALL),
fj AS (SELECT coalesce(bd.feature, rf.feature) AS feature, coalesce(bd.day, rf.day) AS day,
                coalesce(n, 0) AS n, coalesce(ref_n, 0) AS ref_n
         FROM bd FULL JOIN rf ON bd.feature = rf.feature AND bd.bin = rf.bin AND bd.day = rf.day),
t AS (SELECT *, sum(n) OVER (PARTITION BY feature, day) AS cur_total,
             sum(ref_n) OVER (PARTITION BY feature, day) AS ref_total FROM fj
      WHERE day IN (SELECT day FROM days))
SELECT feature, day,
       round(sum((n / greatest(cur_total, 1) + 1e-6 - (ref_n / greatest(ref_total, 1) + 1e-6))
                 * ln((n / greatest(cur_total, 1) + 1e-6) / (ref_n / greatest(ref_total, 1) + 1e-6))),
             {DIGITS}) AS psi,
       CAST(max(cur_total) AS BIGINT) AS n_day, CAST(max(ref_total) AS BIGINT) AS n_reference
FROM t WHERE ref_total > 0 AND cur_total > 0 GROUP BY feature, day
""")
def q_daily_psi(spark, sf):
    ev = D.events_frame(spark, sf)
    long = (ev.select("ts", "day_no", F.lit("value").alias("feature"),
                      F.col("value").cast("double").alias("value"))
            .unionByName(ev.select("ts", "day_no", F.lit("user_id").alias("feature"),
                                   F.col("user_id").cast("double").alias("value"))))
    # frozen edges from the first week (selection: a few passes over the
    # persisted first-week values; the edges come back as driver rows, so the
    # cache is released right after) ...
    first_week = long.where(F.col("day_no") < D.EDGE_DAYS).select("feature", "value").persist()
    edges = drift.psi_edges(first_week)
    edges = spark.createDataFrame(edges.collect(), edges.schema)   # one row per feature
    first_week.unpersist()
    # ... then every row is binned straight into (feature, bin, day) counts
    return _rounded(monitor.daily_psi_vs_trailing(long, edges, "ts"), ["psi"])


# ---------------------------------------------------------------------------
# Feature steps (M1-M8)
# ---------------------------------------------------------------------------

@register("cost_by_week", f"""
WITH ep AS (SELECT CAST(ts AS DATE) AS day, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS label,
                   CAST(value > 50 AS INTEGER) AS prediction FROM events),
c AS (SELECT CAST(date_trunc('week', day) AS DATE) AS period_start, CAST(count(DISTINCT day) AS BIGINT) AS days,
             CAST(count(*) AS BIGINT) AS n, CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
             CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp FROM ep GROUP BY 1)
SELECT period_start, days, n, fn, fp,
       round(({S.COST_FALSE_NEGATIVE} * fn + {S.COST_FALSE_POSITIVE} * fp) / n, {DIGITS}) AS expected_cost_per_case
FROM c
""")
def q_cost_by_week(spark, sf):
    """Weekly cost from the daily confusion table."""
    from riskframe.operators import rollup
    daily = rollup.daily_confusion(D.event_predictions(spark, sf), "ts", "label", "prediction")
    out = rollup.costs_by(daily, "week").select("period_start", "days", "n", "fn", "fp", "expected_cost_per_case")
    return _rounded(out, ["expected_cost_per_case"])


def _sql_psi_by_week() -> str:
    from riskframe.operators import rollup
    step, rest = rollup._base(rollup.ACCURACY), math.ceil(-math.log(rollup.SMALLEST) / rollup._base(rollup.ACCURACY)) + 1
    return f"""
WITH lv AS (SELECT 'value' AS feature, CAST(value AS DOUBLE) AS x, CAST(date_trunc('week', ts) AS DATE) AS w FROM events UNION ALL
            SELECT 'user_id', CAST(user_id AS DOUBLE), CAST(date_trunc('week', ts) AS DATE) FROM events),
b AS (SELECT feature, w, CASE WHEN abs(x) <= {rollup.SMALLEST!r} THEN 0
                              ELSE CAST(sign(x) * (ceil(ln(abs(x)) / {step!r}) + {rest}) AS INTEGER) END AS bin, count(*) AS n FROM lv GROUP BY ALL),
t AS (SELECT feature, w, sum(n) AS total FROM b GROUP BY ALL),
p AS (SELECT feature, w, total, lag(w) OVER (PARTITION BY feature ORDER BY w) AS r, lag(total) OVER (PARTITION BY feature ORDER BY w) AS rt FROM t),
cum AS (SELECT b.feature, b.w, bin, n, total, sum(n) OVER (PARTITION BY b.feature, b.w ORDER BY bin) AS upto FROM b JOIN t ON b.feature = t.feature AND b.w = t.w),
q AS (SELECT unnest(({SQL_FRACS})[2:10]) AS f),
ends AS (SELECT feature, w, list_sort(list_distinct(list(bin))) AS ends FROM cum, q
         WHERE upto > floor((total - 1) * f) AND upto - n <= floor((total - 1) * f) GROUP BY ALL),
both_ AS (SELECT p.feature, p.w, p.r, b.bin, b.n AS n, 0 AS m FROM p JOIN b ON b.feature = p.feature AND b.w = p.w WHERE p.r IS NOT NULL UNION ALL
          SELECT p.feature, p.w, p.r, b.bin, 0, b.n FROM p JOIN b ON b.feature = p.feature AND b.w = p.r),
k AS (SELECT x.feature, x.w, len(list_filter(ends, lambda e: e < bin)) AS class, sum(n) AS n, sum(m) AS m
      FROM both_ x JOIN ends e ON e.feature = x.feature AND e.w = x.r GROUP BY ALL)
SELECT k.feature, k.w AS period_start, CAST(max(total) AS BIGINT) AS n, CAST(max(rt) AS BIGINT) AS n_reference,
       round(sum((n / total - m / rt) * ln((n / total + 1e-6) / (m / rt + 1e-6))), {DIGITS}) AS psi
FROM k JOIN p ON p.feature = k.feature AND p.w = k.w GROUP BY k.feature, k.w"""


@register("psi_by_week", _sql_psi_by_week())
def q_psi_by_week(spark, sf):
    """PSI of each week against the one before, from the daily value counts."""
    from riskframe.operators import rollup
    ev = D.events_frame(spark, sf)
    out = rollup.psi_by(rollup.daily_values(ev, "ts", ["value", "user_id"]), "week")
    return _rounded(out.select("feature", "period_start", "n", "n_reference", "psi"), ["psi"])


@register("feature_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.5), {DIGITS}) AS median, "
    f"round(avg({c}), {DIGITS}) AS mean, round(stddev_pop({c}), {DIGITS}) AS std_pop "
    f"FROM lineitem WHERE {c} IS NOT NULL AND NOT isnan({c})" for c in NUM))
def q_feature_stats(spark, sf):
    li = D.table(spark, sf, "lineitem")
    long = drift.to_long(li, NUM)
    med = drift.exact_quantiles(long, [0.5]).select("feature", F.col("quantile").alias("median"))
    st = long.groupBy("feature").agg(F.avg("value").alias("mean"),
                                     F.stddev_pop("value").alias("std_pop"))
    return _rounded(med.join(st, "feature"), ["median", "mean", "std_pop"])


MODE_COLS = ["l_returnflag", "l_linestatus", "l_tax", "l_discount"]


@register("mode_values", " UNION ALL ".join(
    f"(SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS mode FROM lineitem WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)" for c in MODE_COLS))
def q_mode_values(spark, sf):
    from riskframe.operators.features import ModeImputer
    li = D.table(spark, sf, "lineitem")
    m = ModeImputer(MODE_COLS).fit(li)
    return spark.createDataFrame(sorted(m.values().items()), "feature string, mode string")


@register("one_hot_slots", """
WITH vocab AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS slot
               FROM (SELECT DISTINCT p_type FROM part WHERE p_type < (SELECT max(p_type) FROM part)))
SELECT p_partkey, coalesce(slot, -1) AS slot, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS width
FROM part LEFT JOIN vocab USING (p_type)
""")
def q_one_hot_slots(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.features import one_hot
    part = D.table(spark, sf, "part").select("p_partkey", "p_type")
    unseen = part.agg(F.max("p_type")).first()[0]  # the encoder never meets the last level while it is fitted
    model = Pipeline(stages=one_hot(["p_type"], ["p_type_ohe"])).fit(part.where(F.col("p_type") < unseen))
    arr = vector_to_array(F.col("p_type_ohe"))
    return model.transform(part).select(
        "p_partkey", (F.array_position(arr, 1.0) - 1).cast("int").alias("slot"),
        F.size(arr).alias("width"))


def _embeddings(spark, sf):
    from pyspark.ml.functions import array_to_vector
    e = D.table(spark, sf, "embeddings")
    return e.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>"))
                    .alias("features"), (F.col("label") < 5).cast("int").alias("label"))


@register("pca_reduction")
def q_pca_reduction(spark, sf):
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.features import VariancePCA
    e = _embeddings(spark, sf)
    model = VariancePCA("features", "reduced", k=0, varianceRatio=0.95).fit(e)
    return model.transform(e).select("vec_id", vector_to_array("reduced").alias("components"))


@register("lda_reduction")
def q_lda_reduction(spark, sf):
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.features import FisherLDA
    e = _embeddings(spark, sf)
    model = FisherLDA("features", "reduced", "label").fit(e)
    return model.transform(e).select("vec_id", "label",
                                     vector_to_array("reduced")[0].alias("discriminant"))


# ---------------------------------------------------------------------------
# Models, tuning and scoring
# ---------------------------------------------------------------------------

def _model_frame(spark, sf):
    return D.labelled_frame(spark, sf).select("row_id", *NUM, "l_linestatus", "label")


def _training_rows(d):
    """The training split as a fit needs it: without the key and the split."""
    return d.where(F.col("split") == "train").drop("row_id", "split")


@register("selected_features", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem
""")
def q_selected_features(spark, sf):
    """The feature columns and the label, everything else dropped (and never read)."""
    from riskframe.operators import derive
    return derive.select_features(D.labelled_frame(spark, sf), S.FeatureSpec(tuple(NUM), ("l_linestatus",), "label"))


@register("cv_tuning")
def q_cv_tuning(spark, sf):
    from riskframe.operators import models
    d, train_counts = split.split_with_folds(_model_frame(spark, sf), F.col("row_id"), "label",
                                             SEED, 0.2, 5, drop=("row_id",))
    train = models.with_balanced_weights(d.where(F.col("split") == "train"), counts=train_counts)
    res = models.tune_with_cv(models.learner("logistic_regression"), train, NUM,
                              ["l_linestatus"])
    rows = [(i, float(m), float(s)) for i, (m, s) in enumerate(res.all_metrics)]
    return spark.createDataFrame(rows, "grid_point int, cv_mean double, cv_std double").coalesce(1)  # a row a point


@register("model_scoring")
def q_model_scoring(spark, sf):
    from riskframe.operators import models
    d = split.hash_split(_model_frame(spark, sf), F.col("row_id"), SEED, 0.2)
    pipe, _ = models.build_pipeline(models.learner("logistic_regression"), NUM,
                                    ["l_linestatus"])
    model = models.fit_persisted(pipe, _training_rows(d))
    scored = models.score_table(model, d.where(F.col("split") == "test"), "1")
    return scored.select("row_id", "predicted_class", r("probability_1", 6).alias("probability"),
                         "risk_level", "model_version")


@register("scoring_calibration", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, round(avg(label), 3) AS mean_probability
FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label FROM lineitem)
""")
def q_scoring_calibration(spark, sf):
    """K2: a logistic regression with a free intercept gives its training rows their prevalence as the
    mean probability."""
    from riskframe.operators import models
    rows = _model_frame(spark, sf).drop("row_id")
    pipe, _ = models.build_pipeline(models.learner("logistic_regression"), NUM, ["l_linestatus"])
    scored = models.score_table(models.fit_persisted(pipe, rows), rows, "1")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("probability_1"), 3).alias("mean_probability"))


#: small settings of the tree learners, for a query over the whole table
SMALL_TREES = {"decision_tree": {"maxDepth": 5}, "random_forest": {"numTrees": 10, "maxDepth": 5}, "xgboost": {"maxIter": 5, "maxDepth": 3}}


@register("learner_scoring", " UNION ALL ".join(f"""
SELECT '{name}' AS learner, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_consistent
FROM (SELECT {SQL_KEY} AS row_id FROM lineitem) WHERE {sql_u('row_id', SEED)} < 0.2""" for name in SMALL_TREES))
def q_learner_scoring(spark, sf):
    """K3-K5: tree, forest and boosted trees, fitted on the training split and applied to the test
    split: every row once, and class and risk level follow from the probability."""
    from functools import reduce
    from pyspark.ml import Pipeline, PipelineModel
    from riskframe.operators import models
    from riskframe.session import write_once
    d = split.hash_split(_model_frame(spark, sf), F.col("row_id"), SEED, 0.2)
    train, test = _training_rows(d).persist(), write_once(d.where(F.col("split") == "test"), "test")
    out, prep = [], None
    for name, settings in SMALL_TREES.items():
        pipe, clf = models.build_pipeline(models.learner(name), NUM, ["l_linestatus"])
        # the preparation does not depend on the learner: fitted once, on the training split
        prep = prep or Pipeline(stages=pipe.getStages()[:-1]).fit(train)
        fitted = clf.fit(prep.transform(train), {clf.getParam(k): v for k, v in settings.items()})
        model = PipelineModel(stages=[*prep.stages, fitted])
        p = F.col("probability_1")
        follows = (F.col("predicted_class") == (p > S.CLASS_THRESHOLD).cast("int")) & (F.col("risk_level") == bands.risk_band(p)) & p.between(0, 1)
        scored = models.score_table(model, test, "1").groupBy("row_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(follows).alias("ok"))
        out.append(scored.agg(F.lit(name).alias("learner"), F.sum("n").alias("n_rows"), F.count_if(F.col("ok") & (F.col("n") == 1)).alias("n_consistent")))
    train.unpersist()
    return reduce(DataFrame.unionByName, out)


@register("pca_total_variance", f"""
SELECT CAST(64 AS INTEGER) AS n_components, round(sum(v), 6) AS total_variance FROM (
  SELECT var_samp(x) AS v FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)
""")
def q_pca_total_variance(spark, sf):
    """M6: all components together have the variance of all columns together."""
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.features import VariancePCA
    e = _embeddings(spark, sf)
    model = VariancePCA("features", "reduced", k=64).fit(e)
    z = model.transform(e).select(F.posexplode(vector_to_array("reduced")).alias("i", "z"))
    return (z.groupBy("i").agg(F.var_samp("z").alias("v"))
            .agg(F.count(F.lit(1)).cast("int").alias("n_components"), F.round(F.sum("v"), 6).alias("total_variance")))


@register("lda_within_variance", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT label < 5) AS BIGINT) AS n_classes, CAST(1.0 AS DOUBLE) AS within_variance FROM embeddings
""")
def q_lda_within_variance(spark, sf):
    """M7: the discriminant has unit variance within the classes."""
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.features import FisherLDA
    e = _embeddings(spark, sf)
    z = FisherLDA("features", "reduced", "label").fit(e).transform(e).select("label", vector_to_array("reduced")[0].alias("z"))
    by = z.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.var_pop("z").alias("v"))
    return by.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_classes"),
                  F.round(F.sum(F.col("n") * F.col("v")) / (F.sum("n") - F.count(F.lit(1))), 6).alias("within_variance"))


@register("baseline_scoring", f"""
WITH {SQL_QF},
x AS (SELECT row_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
             {sql_u('row_id', SEED)} AS s, {sql_u('row_id', SEED, 'prior')} AS u FROM qf),
p AS (SELECT count_if(label = 0) / count(*) AS p0 FROM x WHERE s >= 0.2)
SELECT row_id, CASE WHEN u < p0 THEN 0 ELSE 1 END AS predicted_class,
       CASE WHEN u < p0 THEN '{S.RISK_LOW}' ELSE '{S.RISK_HIGH}' END AS risk_level
FROM x, p WHERE s < 0.2
""")
def q_baseline_scoring(spark, sf):
    """Classes drawn with the training priors by the row's key."""
    from riskframe.operators import models
    d = split.hash_split(_model_frame(spark, sf), F.col("row_id"), SEED, 0.2)
    pipe, _ = models.build_pipeline(models.learner("dummy"), NUM, ["l_linestatus"])
    model = models.fit_persisted(pipe, _training_rows(d))
    scored = models.score_table(model, d.where(F.col("split") == "test"), "baseline")
    return scored.select("row_id", "predicted_class", "risk_level")


# ---------------------------------------------------------------------------
# Sources (S1-S5)
# ---------------------------------------------------------------------------

CSV_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]


@register("csv_contract_scan", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
       round_even(l_extendedprice / l_quantity * 100.0, 0) / 100.0 AS unit_price
FROM lineitem
""")
def q_csv_contract_scan(spark, sf):
    """lineitem written as ';'-separated files with two different headers, then
    read back by header names against a typed contract."""
    from pyspark.sql import types as T
    from riskframe.session import scratch_path
    from riskframe.sources.readers import read_delimited
    path = scratch_path(spark, "csv-contract")
    li = D.table(spark, sf, "lineitem")
    for part, cols in (("L_LINENUMBER % 2 = 0", ["l_returnflag", "l_extendedprice", "l_orderkey", "l_quantity", "l_linenumber", "extra"]),
                       ("L_LINENUMBER % 2 = 1", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"])):
        (li.where(part).withColumn("extra", F.lit("x")).select(*cols)
         .write.option("sep", ";").option("header", True).mode("append").csv(path))
    types = {"l_orderkey": T.LongType(), "l_linenumber": T.IntegerType(),
             "l_quantity": T.DoubleType(), "l_extendedprice": T.DoubleType(),
             "l_returnflag": T.StringType()}
    df = read_delimited(spark, path, types, tuple(types), ";", with_source=False)
    return df.select(*CSV_COLS, round_half_even(F.col("l_extendedprice") / F.col("l_quantity"), 2)
                     .alias("unit_price"))


@register("json_records", """
SELECT event_id, n <= 2 AS request_ok, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM (SELECT event_id, props, 1 + event_id % 3 AS n FROM events), range(0, 3) t(i) WHERE i < n
""")
def q_json_records(spark, sf):
    """Every event is a request of one to three records, of which two are allowed."""
    from riskframe.sources.readers import parse_records
    n = (F.col("event_id") % 3 + 1).cast("int")
    body = F.concat(F.lit('{"patients":['), F.array_join(F.array_repeat(F.col("props"), n), ","), F.lit("]}"))
    requests = D.table(spark, sf, "events").select("event_id", body.alias("body"))
    return parse_records(requests, "body", "k bigint", max_records=2).select("event_id", "request_ok", "k")


SQL_REGISTRY = f"""{SQL_RUNS},
reg AS (SELECT model_family AS model_name, run_id, CAST(row_number() OVER w AS INTEGER) AS version,
               lead(run_id) OVER w IS NOT NULL AS followed
        FROM runs WINDOW w AS (PARTITION BY model_family ORDER BY run_id)),
reg_events AS (
  SELECT model_name, version, 'registered' AS event, 'None' AS stage, run_id, CAST(3 * version - 2 AS BIGINT) AS seq FROM reg
  UNION ALL SELECT model_name, version, 'stage_changed', 'Production', run_id, CAST(3 * version - 1 AS BIGINT) FROM reg
  UNION ALL SELECT model_name, version, 'stage_changed', 'Archived', run_id, CAST(3 * version + 3 AS BIGINT) FROM reg WHERE followed)"""


def _registry(spark, sf):
    history = D.runs_table(spark, sf).select(F.col("model_family").alias("model_name"), F.col("run_id").alias("position"), "run_id")
    return runs.registry_events(history)


@register("registry_events", f"WITH {SQL_REGISTRY} SELECT * FROM reg_events")
def q_registry_events(spark, sf):
    """K7: the runs of each family registered one after another."""
    return _registry(spark, sf)


@register("registry_state", f"""WITH {SQL_REGISTRY}
SELECT model_name, version, CASE WHEN followed THEN 'Archived' ELSE 'Production' END AS stage, run_id FROM reg""")
def q_registry_state(spark, sf):
    """The stage of every version; archived versions keep their run."""
    return runs.registry_state(_registry(spark, sf))


@register("registry_resolve", f"""WITH {SQL_REGISTRY}, f AS (SELECT min(model_name) AS m FROM reg)
SELECT model_name, version, 'Production' AS stage, run_id FROM reg, f WHERE NOT followed AND model_name = m""")
def q_registry_resolve(spark, sf):
    """K6: the version to load of the first family."""
    events = _registry(spark, sf)
    first = events.agg(F.min("model_name")).first()[0]
    return runs.resolve_version(events, first)


SQL_GAPS = f"""gaps AS (SELECT {SQL_KEY} AS row_id,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem)"""


@register("imputed_rows", f"""WITH {SQL_GAPS},
fit AS (SELECT quantile_cont(l_discount, 0.5) AS d, quantile_cont(l_quantity, 0.5) AS q FROM gaps),
mode AS (SELECT l_returnflag AS f FROM gaps WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT row_id, coalesce(l_discount, d) AS l_discount, coalesce(l_quantity, q) AS l_quantity,
       coalesce(l_returnflag, f) AS l_returnflag FROM gaps, fit, mode""")
def q_imputed_rows(spark, sf):
    """M1 + M2: nulls and NaN put into lineitem, then filled with the exact median and the mode."""
    from riskframe.operators.features import ExactMedianImputer, ModeImputer
    order = F.col("l_orderkey")
    gaps = D.table(spark, sf, "lineitem").select(
        D.lineitem_key().alias("row_id"), F.when(order % 7 != 0, F.col("l_discount")).alias("l_discount"),
        F.when(order % 11 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(order % 5 != 0, F.col("l_returnflag")).alias("l_returnflag"))
    filled = ExactMedianImputer(["l_discount", "l_quantity"]).fit(gaps).transform(gaps)
    return ModeImputer(["l_returnflag"]).fit(gaps).transform(filled)


# ---------------------------------------------------------------------------
# Streaming (Z2, Z3, Z5) over the events table as a file stream
# ---------------------------------------------------------------------------

def _event_stream(spark, sf):
    schema = D.table(spark, sf, "events").schema
    base = sf.rstrip("/")
    # the table is one file: stream it through a glob with its folder as base
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("basePath", base).parquet(f"{base}/events.parque[t]"))


@register("stream_daily_histogram", f"""
WITH {SQL_EV},
lv AS (SELECT 'value' AS feature, value, ts FROM ev UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE), ts FROM ev),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {SQL_FRACS}))) AS edges
          FROM lv WHERE datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) < 7 GROUP BY feature)
SELECT CAST(ts AS DATE) AS day, lv.feature,
       CAST(len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS INTEGER) AS bin,
       CAST(count(*) AS BIGINT) AS n
FROM lv JOIN edges e ON lv.feature = e.feature GROUP BY ALL
""")
def q_stream_daily_histogram(spark, sf):
    from riskframe.session import scratch_path
    from riskframe.streaming.monitor_stream import daily_histogram, run_to_table
    ev = D.events_frame(spark, sf)
    long = (ev.select(F.lit("value").alias("feature"), F.col("value").cast("double").alias("value"),
                      "day_no")
            .unionByName(ev.select(F.lit("user_id").alias("feature"),
                                   F.col("user_id").cast("double").alias("value"), "day_no")))
    edges = drift.psi_edges(long.where(F.col("day_no") < D.EDGE_DAYS).select("feature", "value"))
    agg = daily_histogram(_event_stream(spark, sf), "ts", ["value", "user_id"], edges)
    out = run_to_table(agg, scratch_path(spark, "stream-hist"), mode="update",
                       keys=("day_start", "feature", "bin"))
    return out.select(F.to_date("day_start").alias("day"), "feature", "bin", "n")


@register("stream_daily_psi", ORACLE["daily_psi"].replace("WHERE ref_total > 0 AND cur_total > 0", "WHERE ref_total > 0 AND cur_total > 0 AND day < (SELECT max(day) FROM days)"))
def q_stream_daily_psi(spark, sf):
    """PSI of every closed day from keyed state; the last day is still open."""
    from riskframe.session import scratch_path
    from riskframe.streaming.monitor_stream import daily_psi_stream, run_to_table
    first_week = D.events_frame(spark, sf).where(F.col("day_no") < D.EDGE_DAYS)
    edges = drift.psi_edges(drift.to_long(first_week, ["value", "user_id"]))
    frozen = {r["feature"]: r["edges"] for r in edges.collect()}  # one row per feature
    out = run_to_table(daily_psi_stream(_event_stream(spark, sf), "ts", frozen), scratch_path(spark, "stream-psi"))
    return _rounded(out, ["psi"])


@register("stream_sliding_confusion", """
WITH ep AS (SELECT ts, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS label,
                   CAST(value > 50 AS INTEGER) AS prediction FROM events),
x AS (SELECT CAST(ts AS DATE) - CAST(k AS INTEGER) AS window_start, label, prediction
      FROM ep, range(0, 30) t(k))
SELECT window_start, window_start + 30 AS window_end,
       CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
       CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
       CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
       CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn
FROM x GROUP BY window_start
""")
def q_stream_sliding_confusion(spark, sf):
    from riskframe.session import scratch_path
    from riskframe.streaming.monitor_stream import (daily_confusion_stream,
                                                    rolling_windows_from_daily, run_to_table)
    s = _event_stream(spark, sf).select(
        "ts", F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
        (F.col("value") > 50).cast("int").alias("prediction"))
    # the stream keeps one row per day; the 30-day windows are rolled from those rows
    daily = run_to_table(daily_confusion_stream(s, "ts", "label", "prediction"),
                         scratch_path(spark, "stream-daily"), mode="update", keys=("day",))
    out = rolling_windows_from_daily(daily, S.ROLLING_DAYS)
    return out.select("window_start", "window_end",
                      *[F.col(c).cast("long").alias(c) for c in ("tp", "fp", "fn", "tn")])


@register("stream_dedupe", """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events
""")
def q_stream_dedupe(spark, sf):
    """One row per user, type and day; repeats within the day are dropped."""
    from riskframe.session import scratch_path
    from riskframe.streaming.monitor_stream import dedupe_stream, run_to_table
    s = _event_stream(spark, sf).select("ts", "user_id", "event_type")
    out = run_to_table(dedupe_stream(s, "ts", ["user_id", "event_type"]),
                       scratch_path(spark, "stream-dedupe"), mode="append")
    return out.select("user_id", "event_type", F.to_date("period").alias("day"))


# ---------------------------------------------------------------------------
# More reports: summary, scaled features, ordered listings, CSV quarantine
# ---------------------------------------------------------------------------

@register("quality_summary", f"""
WITH {SQL_QF}
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST({' + '.join(f"count_if({sql_missing(c, fl)})" for c, fl in QF_COLS)} AS BIGINT) AS n_missing_total,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_extendedprice, l_discount,
            l_tax, l_returnflag, l_linestatus, disc_per_tax FROM qf)) AS BIGINT) AS n_duplicates
FROM qf
""")
def q_quality_summary(spark, sf):
    s = quality.quality_summary(D.quality_frame(spark, sf), exclude_from_duplicates=("row_id",))
    return s.select("n_rows", "n_missing_total", "n_duplicates")


@register("scaled_features", f"""
WITH st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUM)} FROM lineitem)
SELECT {SQL_KEY} AS row_id,
       {', '.join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END, 8) AS z_{c}"
                  for c in NUM)}
FROM lineitem, st
""")
def q_scaled_features(spark, sf):
    from riskframe.operators.features import PopulationStandardScaler
    li = D.table(spark, sf, "lineitem").select(D.lineitem_key().alias("row_id"), *NUM)
    m = PopulationStandardScaler(NUM, [f"z_{c}" for c in NUM]).fit(li)
    return m.transform(li).select("row_id", *[r(f"z_{c}", 8).alias(f"z_{c}") for c in NUM])


@register("top_runs_by_f1", f"""
WITH {SQL_RUNS}
SELECT run_id, run_name, round(f1, {DIGITS}) AS f1,
       CAST(row_number() OVER (ORDER BY f1 DESC, run_id) AS INTEGER) AS position
FROM runs WHERE status = 'FINISHED'
""")
def q_top_runs_by_f1(spark, sf):
    """All finished runs in order of F1."""
    from pyspark.sql import Window
    f = runs.finished(D.runs_table(spark, sf))
    # one row per run: a total order over them is cheap
    w = Window.orderBy(F.col("f1").desc(), "run_id")
    return _rounded(f.select("run_id", "run_name", "f1",
                               F.row_number().over(w).alias("position")), ["f1"])


@register("sample_rows", f"""
SELECT {SQL_KEY} AS row_id, l_quantity, l_extendedprice FROM lineitem
ORDER BY row_id LIMIT 5
""")
def q_sample_rows(spark, sf):
    """T4: the first rows in key order (the input-example feature)."""
    li = D.table(spark, sf, "lineitem")
    return (li.select(D.lineitem_key().alias("row_id"), "l_quantity", "l_extendedprice")
            .orderBy("row_id").limit(5))


def _scoring_csv(spark, sf) -> str:
    """lineitem written as a comma-separated batch; returned rows (flag R)
    carry one extra field, as a malformed upload would."""
    from riskframe.session import scratch_path
    path = scratch_path(spark, "scoring-csv")
    li = D.table(spark, sf, "lineitem")
    body = li.select(F.concat_ws(",", "l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                 F.when(F.col("l_returnflag") == "R", F.lit("extra")))
                     .alias("l_orderkey,l_linenumber,l_quantity,l_discount"))
    # one column of finished lines, so each file gets the header line as its first
    body.write.option("header", True).option("sep", "\x01").option("quote", "\x02").mode("overwrite").csv(path)
    return path


SCORING_TYPES_SQL = "l_orderkey, l_linenumber, l_quantity, l_discount"


@register("scoring_csv_valid", f"""
SELECT {SCORING_TYPES_SQL} FROM lineitem WHERE l_returnflag <> 'R'
""")
def q_scoring_csv_valid(spark, sf):
    from pyspark.sql import types as T
    from riskframe.sources.readers import read_scoring_csv
    types = {"l_orderkey": T.LongType(), "l_linenumber": T.IntegerType(),
             "l_quantity": T.DoubleType(), "l_discount": T.DoubleType()}
    good, _ = read_scoring_csv(spark, _scoring_csv(spark, sf), types, ",")
    return good


@register("scoring_csv_quarantine", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, 5 AS n_fields FROM lineitem WHERE l_returnflag = 'R'
""")
def q_scoring_csv_quarantine(spark, sf):
    from pyspark.sql import types as T
    from riskframe.sources.readers import read_scoring_csv
    types = {"l_orderkey": T.LongType()}
    _, bad = read_scoring_csv(spark, _scoring_csv(spark, sf), types, ",")
    return bad.groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_rows"))


@register("baseline_training_run")
def q_baseline_training_run(spark, sf):
    """K11 for the prior baseline: split, CV, test metrics as a long table."""
    from riskframe.operators import models
    run = models.train_model("dummy", _model_frame(spark, sf), F.col("row_id"), NUM,
                             ["l_linestatus"], "none")
    rows = [(run["run_name"], k, float(v) if v is not None else None)
            for k, v in sorted(run["metrics"].items()) if k != "train.fit_seconds"]
    return spark.createDataFrame(rows, "run_name string, metric string, value double")


def _line_stream(spark, sf):
    base = sf.rstrip("/")
    return (spark.readStream.schema(D.table(spark, sf, "lineitem").schema).option("basePath", base)
            .parquet(f"{base}/lineitem.parque[t]").select(D.lineitem_key().alias("row_id"), *NUM, "l_linestatus"))


def _scored_stream(spark, sf, learner: str) -> str:
    """A model fitted on the training split of lineitem scores lineitem read as a file stream, into a
    folder with both outputs and their commit records."""
    from riskframe.operators import models
    from riskframe.session import scratch_path
    from riskframe.streaming.monitor_stream import run_scoring
    d = split.hash_split(_model_frame(spark, sf), F.col("row_id"), SEED, 0.2)
    pipe, _ = models.build_pipeline(models.learner(learner), NUM, ["l_linestatus"])
    model = models.fit_persisted(pipe, _training_rows(d))
    base = scratch_path(spark, "stream-score")
    run_scoring(_line_stream(spark, sf), model, D.LINEITEM_RULES_NUMERIC, "1", base)
    return base


@register("stream_scoring")
def q_stream_scoring(spark, sf):
    """Z1 by a logistic regression: scored rows, and quarantined rows without a class."""
    from riskframe.streaming.monitor_stream import read_committed
    base = _scored_stream(spark, sf, "logistic_regression")
    scored = read_committed(spark, base, "scored").select("row_id", F.lit(True).alias("is_valid"), "predicted_class", "risk_level")
    bad = read_committed(spark, base, "quarantine").select("row_id", F.lit(False), F.lit(None).cast("int"), F.lit(None).cast("string"))
    return scored.union(bad)


SQL_STREAM_RULES = f"""v AS (SELECT row_id, concat_ws(',', {_sql_violations(D.LINEITEM_RULES_NUMERIC)}) AS violations FROM qf)"""


@register("stream_scored", f"""
WITH {SQL_QF}, {SQL_STREAM_RULES},
x AS (SELECT row_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
             {sql_u('row_id', SEED)} AS s, {sql_u('row_id', SEED, 'prior')} AS u FROM qf),
p AS (SELECT count_if(label = 0) / count(*) AS p0 FROM x WHERE s >= 0.2)
SELECT row_id, CASE WHEN u < p0 THEN 0 ELSE 1 END AS predicted_class,
       CASE WHEN u < p0 THEN '{S.RISK_LOW}' ELSE '{S.RISK_HIGH}' END AS risk_level, '1' AS model_version
FROM x JOIN v USING (row_id), p WHERE violations = ''
""")
def q_stream_scored(spark, sf):
    """What the scoring stream's first output holds, by the prior baseline (drawn by the row's key)."""
    from riskframe.streaming.monitor_stream import read_committed
    return read_committed(spark, _scored_stream(spark, sf, "dummy"), "scored").select("row_id", "predicted_class", "risk_level", "model_version")


@register("stream_quarantined", f"""
WITH {SQL_QF}, {SQL_STREAM_RULES}
SELECT row_id, violations FROM v WHERE violations <> ''
""")
def q_stream_quarantined(spark, sf):
    """What its second output holds, with the reasons."""
    from riskframe.streaming.monitor_stream import read_committed
    bad = read_committed(spark, _scored_stream(spark, sf, "dummy"), "quarantine")
    return bad.select("row_id", F.array_join("violations", ",").alias("violations"))


@register("drift_report_kll")
def q_drift_report_kll(spark, sf):
    """A26 with reference deciles from KLL sketches (approximate edges, so
    no exact oracle; KS is unchanged)."""
    ref, cur = D.drift_samples(spark, sf)
    rep = drift.drift_report(ref, cur, list(D.EVENT_FEATURES), prediction="prediction",
                             method="kll")
    return _rounded(rep, ["psi", "ks_statistic", "ks_pvalue"])


@register("stream_feedback_join", """
SELECT o.o_orderkey AS order_key, l.l_linenumber AS line,
       CAST(o.o_totalprice > 150000 AS INTEGER) AS prediction,
       CAST(l.l_returnflag = 'R' AS INTEGER) AS outcome
FROM orders o JOIN lineitem l
  ON l.l_orderkey = o.o_orderkey
 AND l.l_shipdate >= o.o_orderdate AND l.l_shipdate <= o.o_orderdate + INTERVAL 120 DAY
""")
def q_stream_feedback_join(spark, sf):
    """Predictions (one per order, at the order date) joined with
    outcomes (line items, at their ship date) that arrive within 120 days;
    both streams watermarked, so join state is bounded by the delay."""
    from riskframe.session import scratch_path
    from riskframe.streaming.monitor_stream import feedback_join, run_to_table
    base = sf.rstrip("/")

    def stream(name):
        return (spark.readStream.schema(D.table(spark, sf, name).schema)
                .option("basePath", base).parquet(f"{base}/{name}.parque[t]"))
    preds = stream("orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("pts"),
                                    (F.col("o_totalprice") > 150000).cast("int").alias("prediction"))
    outs = stream("lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("ots"),
                                     "l_linenumber",
                                     (F.col("l_returnflag") == "R").cast("int").alias("outcome"))
    j = feedback_join(preds, outs, "key", "pts", "ots", "120 days", watermark="130 days")
    out = run_to_table(j.select(F.col("p.key").alias("order_key"), F.col("o.l_linenumber").alias("line"),
                                "prediction", "outcome"),
                       scratch_path(spark, "stream-feedback"), mode="append")
    return out


@register("drift_report_exact_pvalue")
def q_drift_report_exact_pvalue(spark, sf):
    """A25 with exact two-sample KS p-values at every size (no SQL oracle: the
    lattice-path probability is computed per feature)."""
    ref, cur = D.drift_samples(spark, sf)
    rep = drift.drift_report(ref, cur, list(D.EVENT_FEATURES), prediction="prediction",
                             pvalue="exact")
    return _rounded(rep, ["psi", "ks_statistic", "ks_pvalue"])
