"""Derived columns (P1-P4, P14-P17): pure projections, fused into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions import bands
from riskframe.functions.columns import is_missing, round_half_even, safe_div


def age_years(age_days: str) -> Column:
    """Days / 365.25, one decimal, half to even."""
    return round_half_even(F.col(age_days) / S.DAYS_PER_YEAR, 1)


def bmi(weight: str, height_cm: str) -> Column:
    """Kg / m^2, two decimals; a zero height gives null (ANSI-safe)."""
    return round_half_even(safe_div(F.col(weight), F.pow(F.col(height_cm) / 100.0, 2)), 2)


def augment(df: DataFrame, age_days: str = "age", weight: str = "weight",
            height: str = "height") -> DataFrame:
    """Deterministic derivations that never depend on split statistics."""
    return df.withColumn("age_years", age_years(age_days)).withColumn("bmi", bmi(weight, height))


def fill_bmi(df: DataFrame, bmi_col: str = "bmi", weight: str = "weight",
             height: str = "height") -> DataFrame:
    """Keep a given BMI, compute it where missing (null or NaN)."""
    given = F.when(~is_missing(F.col(bmi_col)), F.col(bmi_col))
    return df.withColumn(bmi_col, F.coalesce(given, bmi(weight, height)))


def pulse_pressure(high: str, low: str) -> Column:
    """P14."""
    return F.col(high) - F.col(low)


def add_feature_bands(df: DataFrame, bmi_col: str = "bmi", age_col: str = "age_years",
                      systolic: str = "ap_hi", diastolic: str = "ap_lo") -> DataFrame:
    """P14-P17 together."""
    return (df.withColumn("pulse_pressure", pulse_pressure(systolic, diastolic))
            .withColumn("bmi_class", bands.bmi_class(bmi_col))
            .withColumn("age_decade", bands.decade(age_col))
            .withColumn("bp_category", bands.bp_category(systolic, diastolic)))


def select_features(df: DataFrame, spec: S.FeatureSpec, keep_label: bool = True) -> DataFrame:
    """The feature columns (and label), everything else dropped."""
    cols = spec.features + ([spec.label] if keep_label and spec.label else [])
    return df.select(*cols)
