"""Banding expressions: ordered ``when`` chains over fixed cut points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.columns import _col, is_missing


def risk_band(p) -> Column:
    """null -> moderate, < .35 low, < .65 moderate, else high."""
    p = _col(p)
    return (F.when(is_missing(p), F.lit(S.RISK_MODERATE))
            .when(p < S.RISK_LOW_BELOW, F.lit(S.RISK_LOW))
            .when(p < S.RISK_MODERATE_BELOW, F.lit(S.RISK_MODERATE))
            .otherwise(F.lit(S.RISK_HIGH)))


def psi_verdict(psi) -> Column:
    """NaN / null PSI is not below any threshold and lands on drift."""
    psi = _col(psi)
    ok = ~is_missing(psi)
    return (F.when(ok & (psi < S.PSI_STABLE), F.lit(S.VERDICT_STABLE))
            .when(ok & (psi < S.PSI_MODERATE), F.lit(S.VERDICT_MODERATE))
            .otherwise(F.lit(S.VERDICT_DRIFT)))


def bmi_class(bmi) -> Column:
    bmi = _col(bmi)
    c1, c2, c3 = S.BMI_CLASS_CUTS
    l0, l1, l2, l3 = S.BMI_CLASS_LABELS
    return (F.when(is_missing(bmi), F.lit(None).cast("string"))
            .when(bmi < c1, l0).when(bmi < c2, l1).when(bmi < c3, l2).otherwise(l3))


def bp_category(systolic, diastolic) -> Column:
    """Five blood-pressure bands, highest band first (bands overlap)."""
    s, d = _col(systolic), _col(diastolic)
    (crisis, cs, cd), (h2, h2s, h2d), (h1, h1s, h1d), (el, els, _), (normal, _, _) = S.BP_CATEGORIES
    return (F.when(is_missing(s) | is_missing(d), F.lit(None).cast("string"))
            .when((s > cs) | (d > cd), crisis)
            .when((s >= h2s) | (d >= h2d), h2)
            .when((s >= h1s) | (d >= h1d), h1)
            .when(s >= els, el)
            .otherwise(normal))


def decade(x) -> Column:
    return (F.floor(_col(x) / 10) * 10).cast("long")


def run_name(model, technique) -> Column:
    """``model__raw|pca|lda``."""
    t = _col(technique)
    suffix = F.when(t == "none", F.lit(S.RUN_NAME_SUFFIX["none"])).otherwise(t)
    return F.concat_ws("__", _col(model), suffix)
