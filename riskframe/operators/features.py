"""Leak-free feature steps as ``pyspark.ml`` estimators (M1-M8).

Fitted values live in the fitted ``Model`` (fit on train, apply anywhere).
Spark ML's own ``Imputer`` median is approximate, its ``StandardScaler``
uses the sample std and its ``PCA`` does not centre, so the steps whose
exact semantics matter are custom estimators built on DataFrame
aggregates. Statistics reach the driver only as one value per column
(or a d x d matrix for PCA/LDA).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, HasInputCol, HasOutputCol, \
    HasLabelCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import is_missing
from riskframe.operators.gram import moments
from riskframe.operators.selection import column_quantiles, column_quantiles_without


class _Surrogates(Params):
    surrogates = Param(Params._dummy(), "surrogates", "json map column -> fill value",
                       typeConverter=TypeConverters.toString)
    asDouble = Param(Params._dummy(), "asDouble", "output doubles (statistics need not be "
                     "values of the column's type, e.g. the median of integers)",
                     typeConverter=TypeConverters.toBoolean)


class FillValuesModel(Model, HasInputCols, HasOutputCols, _Surrogates,
                      DefaultParamsReadable, DefaultParamsWritable):
    """Replaces missing values (null / NaN) with fitted per-column values."""

    def __init__(self, inputCols=None, outputCols=None, surrogates="{}", asDouble=False):
        super().__init__()
        self._set(inputCols=inputCols or [], outputCols=outputCols or inputCols or [],
                  surrogates=surrogates, asDouble=asDouble)

    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.surrogates))

    def _transform(self, df: DataFrame) -> DataFrame:
        vals = self.values()
        types = {f.name: f.dataType for f in df.schema.fields}
        as_double = self.getOrDefault(self.asDouble)
        for c, o in zip(self.getInputCols(), self.getOutputCols()):
            out_type = "double" if as_double else types[c]
            fill = F.lit(vals[c]).cast(out_type) if vals.get(c) is not None else F.lit(None)
            df = df.withColumn(o, F.when(is_missing(c, types[c]), fill)
                               .otherwise(F.col(c).cast(out_type)))
        return df


class ExactMedianImputer(Estimator, HasInputCols, HasOutputCols,
                         DefaultParamsReadable, DefaultParamsWritable):
    """M1: exact median (linear interpolation) of the present values."""

    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(inputCols=inputCols or [], outputCols=outputCols or inputCols or [])

    def _fit(self, df: DataFrame) -> FillValuesModel:
        return self._with(column_quantiles(df, self.getInputCols(), [0.5]))

    def _with(self, quantiles: dict[str, list[float]]) -> FillValuesModel:
        med = {c: found[0] for c, found in quantiles.items()}
        return FillValuesModel(self.getInputCols(), self.getOutputCols(), json.dumps(med), asDouble=True)

    def fit_without(self, df: DataFrame, fold_col: str, folds: tuple[int, ...]) -> dict[int | None, FillValuesModel]:
        """Fitted on all rows (None) and, for each fold, on the rows of the others, in shared passes."""
        found = column_quantiles_without(df, self.getInputCols(), [0.5], fold_col, folds)
        return {k: self._with(quantiles) for k, quantiles in found.items()}


class ModeImputer(Estimator, HasInputCols, HasOutputCols,
                  DefaultParamsReadable, DefaultParamsWritable):
    """M2: most frequent present value; ties go to the smallest value."""

    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(inputCols=inputCols or [], outputCols=outputCols or inputCols or [])

    def _fit(self, df: DataFrame) -> FillValuesModel:
        from pyspark.sql import types as T
        cols = self.getInputCols()
        types = {f.name: f.dataType for f in df.schema.fields}

        def level(c):
            num = (F.col(c).cast("double") if isinstance(types[c], T.NumericType)
                   else F.lit(None).cast("double"))
            return F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"),
                            num.alias("num"), is_missing(c, types[c]).alias("missing"))

        # one scan for all columns; counts per level are combined map-side
        counts = (df.select(F.explode(F.array(*[level(c) for c in cols])).alias("x"))
                  .select("x.*").where(~F.col("missing"))
                  .groupBy("feature", "value", "num").count())
        # most frequent first; ties to the smallest value (numeric order for numbers)
        modes = counts.groupBy("feature").agg(
            F.min_by("value", F.struct(-F.col("count"), F.col("num"), F.col("value")))
            .alias("mode"))
        vals = {r["feature"]: r["mode"] for r in modes.collect()}
        return FillValuesModel(cols, self.getOutputCols(), json.dumps(vals))


class PopulationStandardScaler(Estimator, HasInputCols, HasOutputCols,
                               DefaultParamsReadable, DefaultParamsWritable):
    """M3: (x - mean) / population std; a zero std divides by 1."""

    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(inputCols=inputCols or [], outputCols=outputCols or inputCols or [])

    def _fit(self, df: DataFrame) -> "ScalerValuesModel":
        cols = self.getInputCols()
        row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
        stats = {c: [row[f"m_{i}"], row[f"s_{i}"] if row[f"s_{i}"] else 1.0]
                 for i, c in enumerate(cols)}
        return ScalerValuesModel(cols, self.getOutputCols(), json.dumps(stats))


class ScalerValuesModel(Model, HasInputCols, HasOutputCols, _Surrogates,
                        DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, outputCols=None, surrogates="{}"):
        super().__init__()
        self._set(inputCols=inputCols or [], outputCols=outputCols or inputCols or [],
                  surrogates=surrogates)

    def stats(self) -> dict:
        return json.loads(self.getOrDefault(self.surrogates))

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.stats()
        for c, o in zip(self.getInputCols(), self.getOutputCols()):
            mean, std = st[c]
            df = df.withColumn(o, (F.col(c) - F.lit(mean)) / F.lit(std))
        return df


def one_hot(input_cols: list[str], output_cols: list[str]) -> list:
    """M4: sorted vocabulary, unknown levels encode as all zeros.
    The indexer keeps unknowns at index = vocabulary size, and the encoder's
    dropLast removes exactly that slot."""
    idx = [f"{c}__idx" for c in input_cols]
    return [StringIndexer(inputCols=input_cols, outputCols=idx, stringOrderType="alphabetAsc",
                          handleInvalid="keep"),
            OneHotEncoder(inputCols=idx, outputCols=output_cols, dropLast=True,
                          handleInvalid="error")]


def build_preprocessor(numeric: list[str], categorical: list[str],
                       output_col: str = "features") -> Pipeline:
    """M5: median-impute + scale numerics, mode-impute + one-hot categoricals,
    assemble; every other column is ignored."""
    num_imp = [f"{c}__imp" for c in numeric]
    num_std = [f"{c}__std" for c in numeric]
    cat_imp = [f"{c}__imp" for c in categorical]
    cat_ohe = [f"{c}__ohe" for c in categorical]
    stages = []
    if numeric:
        stages += [ExactMedianImputer(numeric, num_imp), PopulationStandardScaler(num_imp, num_std)]
    if categorical:
        stages += [ModeImputer(categorical, cat_imp), *one_hot(cat_imp, cat_ohe)]
    stages.append(VectorAssembler(inputCols=num_std + cat_ohe, outputCol=output_col))
    return Pipeline(stages=stages)


class VariancePCA(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable,
                  DefaultParamsWritable):
    """M6: centred PCA keeping ``k`` components, or the fewest whose explained
    variance reaches ``varianceRatio``; each component's largest loading is
    made positive so the sign is reproducible."""

    k = Param(Params._dummy(), "k", "components (0 = by variance)", TypeConverters.toInt)
    varianceRatio = Param(Params._dummy(), "varianceRatio", "variance to keep",
                          TypeConverters.toFloat)

    def __init__(self, inputCol="features", outputCol="reduced", k=0, varianceRatio=0.95):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, k=k, varianceRatio=varianceRatio)

    def _fit(self, df: DataFrame) -> LinearProjectionModel:
        inp, out = self.getInputCol(), self.getOutputCol()
        x = vector_to_array(F.col(inp))
        d = len(df.select(inp).first()[0])
        m = moments(df, x, d)[0]
        values, vectors = np.linalg.eigh(m.covariance())
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        ev = values / (values.sum() or 1.0)
        k = self.getOrDefault(self.k)
        if not k:
            k = int(np.searchsorted(np.cumsum(ev), self.getOrDefault(self.varianceRatio) - 1e-12) + 1)
        k = max(1, min(k, d))
        pc = vectors[:, :k]
        signs = np.sign(pc[np.abs(pc).argmax(axis=0), range(k)])
        signs[signs == 0] = 1.0
        fit = {"mean": np.diag(m.mean).tolist(), "scalings": (pc * signs).T.tolist()}
        model = LinearProjectionModel(inp, out, json.dumps(fit))
        model.explained_variance = ev[:k].tolist()
        return model


class LinearProjectionModel(Model, HasInputCol, HasOutputCol, _Surrogates,
                     DefaultParamsReadable, DefaultParamsWritable):
    """Projection ``(x - mean) . W``: a small one as JVM-side dot products, a large one as a matrix
    product over Arrow batches."""

    def __init__(self, inputCol="features", outputCol="reduced", surrogates="{}"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, surrogates=surrogates)

    @property
    def output_dim(self) -> int:
        return len(json.loads(self.getOrDefault(self.surrogates))["scalings"])

    #: products up to which a projection is written out; beyond it, whole batches are multiplied
    UNROLL_MAX = 512

    def _transform(self, df: DataFrame) -> DataFrame:
        fit = json.loads(self.getOrDefault(self.surrogates))
        arr = "__lda_x"
        out = df.withColumn(arr, vector_to_array(F.col(self.getInputCol())))
        if len(fit["mean"]) * len(fit["scalings"]) <= self.UNROLL_MAX:
            comps = []
            for w in fit["scalings"]:
                # sum_i (x_i - mean_i) * w_i, written out: stays in generated code
                terms = [(F.col(arr)[i] - F.lit(float(m))) * F.lit(float(wi))
                         for i, (m, wi) in enumerate(zip(fit["mean"], w))]
                total = terms[0]
                for t in terms[1:]:
                    total = total + t
                comps.append(total)
            projected = F.array(*comps)
        else:
            mean, scalings = np.array(fit["mean"]), np.array(fit["scalings"]).T

            def multiply(x: pd.Series) -> pd.Series:
                return pd.Series(list((np.stack(x.to_list()) - mean) @ scalings) if len(x) else [])

            projected = F.pandas_udf(multiply, "array<double>")(F.col(arr))
        return out.withColumn(self.getOutputCol(), array_to_vector(projected)).drop(arr)


class FisherLDA(Estimator, HasInputCol, HasOutputCol, HasLabelCol,
                DefaultParamsReadable, DefaultParamsWritable):
    """M7: Fisher discriminant directions (at most classes-1). The moments of all classes come from
    one pass; only d x d matrices reach the driver."""

    k = Param(Params._dummy(), "k", "components (0 = classes - 1)", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="reduced", labelCol="label", k=0):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, labelCol=labelCol, k=k)

    def _fit(self, df: DataFrame) -> LinearProjectionModel:
        inp, lab = self.getInputCol(), self.getLabelCol()
        if lab not in df.columns:
            raise ValueError("Fisher LDA is supervised and needs the label column to fit")
        counts = {r[lab]: r["count"] for r in df.where(F.col(lab).isNotNull()).groupBy(lab).count().collect()}  # one row a class
        classes = sorted(counts)
        if len(classes) < 2:
            raise ValueError("Fisher LDA needs at least two classes")
        x = vector_to_array(F.col(inp))
        d = len(df.select(inp).first()[0])
        by_class = moments(df, x, d, F.col(lab), classes)  # one pass for all classes
        n_tot = sum(counts.values())
        means = [np.diag(m.mean) for m in by_class]
        mu = sum(counts[c] * m for c, m in zip(classes, means)) / n_tot
        sw = sum(m.cross for m in by_class) / max(n_tot - len(classes), 1)
        sb = sum(counts[c] * np.outer(m - mu, m - mu) for c, m in zip(classes, means))
        vals, vecs = np.linalg.eig(np.linalg.pinv(sw) @ sb)
        order = np.argsort(-vals.real)
        k = self.getOrDefault(self.k) or (len(classes) - 1)
        k = max(1, min(k, len(classes) - 1, d))
        w = vecs[:, order[:k]].real
        for j in range(k):                      # unit within-class variance, fixed sign
            scale = np.sqrt(max(w[:, j] @ sw @ w[:, j], 1e-300))
            w[:, j] /= scale
            if w[np.abs(w[:, j]).argmax(), j] < 0:
                w[:, j] = -w[:, j]
        fit = {"mean": mu.tolist(), "scalings": w.T.tolist()}
        return LinearProjectionModel(inp, self.getOutputCol(), json.dumps(fit))


class IdentityModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable,
                    DefaultParamsWritable):
    def __init__(self, inputCol="features", outputCol="reduced"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    output_dim = None

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), F.col(self.getInputCol()))


class DimReducer(Estimator, HasInputCol, HasOutputCol, HasLabelCol,
                 DefaultParamsReadable, DefaultParamsWritable):
    """M8: one interface for none / pca / lda. ``nComponents`` is a number of components, a share of
    the variance to keep (between 0 and 1, pca only), or 0 for the default."""

    technique = Param(Params._dummy(), "technique", "none | pca | lda", TypeConverters.toString)
    nComponents = Param(Params._dummy(), "nComponents", "k, share of variance, 0 = default", TypeConverters.toFloat)

    def __init__(self, technique="none", nComponents=0.0, inputCol="features",
                 outputCol="reduced", labelCol="label"):
        super().__init__()
        if technique not in ("none", "pca", "lda"):
            raise ValueError(f"unknown technique: {technique!r}")
        if nComponents < 0 or nComponents % 1 and (nComponents > 1 or technique == "lda"):
            raise ValueError(f"{nComponents} is neither a number of components nor a share of the variance")
        self._set(technique=technique, nComponents=float(nComponents), inputCol=inputCol,
                  outputCol=outputCol, labelCol=labelCol)

    def _fit(self, df: DataFrame):
        t = self.getOrDefault(self.technique)
        k = self.getOrDefault(self.nComponents)
        if t == "none":
            return IdentityModel(self.getInputCol(), self.getOutputCol())
        if t == "pca":
            share = {"varianceRatio": k} if 0 < k < 1 else {"k": int(k)}
            return VariancePCA(self.getInputCol(), self.getOutputCol(), **share).fit(df)
        return FisherLDA(self.getInputCol(), self.getOutputCol(), self.getLabelCol(), k=int(k)).fit(df)


@dataclass(frozen=True)
class ArrayPreparation:
    """What a fitted preprocessor and reducer make of rows, for whole columns in a worker: the same fill values,
    means, levels and projection that ``transform`` applies, so that prepared rows need not be stored."""

    numbers: list[tuple[str, float, float, float]]         # column, fill value, mean, std
    levels: list[tuple[str, str | None, dict[str, int]]]   # column, fill value, slot of each level
    projection: tuple[np.ndarray, np.ndarray] | None       # mean, scalings

    @property
    def width(self) -> int:
        if self.projection is not None:
            return len(self.projection[1])
        return len(self.numbers) + sum(len(slots) for _, _, slots in self.levels)

    def __call__(self, numbers: list[np.ndarray], levels: list[tuple[np.ndarray, list]], rows: int | None = None) -> np.ndarray:
        """(width, n) from the columns of n rows: ``numbers`` (NaN is missing) and, for ``levels``, each row's place
        in a list of names (None is missing). With ``rows``, an array of so many rows whose others are zero."""
        n = len(numbers[0] if numbers else levels[0][0])
        unprojected = len(self.numbers) + sum(len(slots) for _, _, slots in self.levels)
        x = np.zeros((max(rows or 0, unprojected) if self.projection is None else unprojected, n))
        for row, v, (_, fill, mean, std) in zip(x, numbers, self.numbers):
            np.subtract(v, mean, out=row)
            row /= std
            gaps = np.isnan(row)
            if gaps.any():
                row[gaps & np.isnan(v)] = (fill - mean) / std
        at = len(self.numbers)
        for (codes, names), (_, fill, slots) in zip(levels, self.levels):
            hot = np.zeros((len(slots), len(names)))
            for j, name in enumerate(names):
                slot = slots.get(fill if name is None else name)
                if slot is not None:  # unknown levels are all zeros
                    hot[slot, j] = 1.0
            for values in hot:
                if values.any():
                    np.take(values, codes, out=x[at], mode="clip")
                at += 1
        if np.isnan(x.sum()) and np.isnan(x).any():  # as the assembler does
            raise ValueError("a prepared value is missing: its column has no value to fill it with, or is not finite")
        if self.projection is not None:
            mean, scalings = self.projection
            out = np.zeros((max(rows or 0, len(scalings)), n))
            np.matmul(scalings, x - mean[:, None], out=out[:len(scalings)])
            return out
        return x


def in_arrays(model: PipelineModel) -> ArrayPreparation | None:
    """The array form of a fitted ``build_preprocessor`` and :class:`DimReducer`; None for other stages."""
    stages = [s for part in model.stages for s in (part.stages if isinstance(part, PipelineModel) else [part])]
    number = lambda v: float("nan") if v is None else float(v)
    fills, scaled, indexed, hot, inputs, projection = {}, {}, {}, {}, [], None
    for s in stages:
        if isinstance(s, FillValuesModel):
            fills |= {o: (c, s.values().get(c)) for c, o in zip(s.getInputCols(), s.getOutputCols())}
        elif isinstance(s, ScalerValuesModel):
            scaled |= {o: (fills[c][0], *map(number, (fills[c][1], *s.stats()[c]))) for c, o in zip(s.getInputCols(), s.getOutputCols())}
        elif isinstance(s, StringIndexerModel):
            indexed |= {o: (*fills[c], {name: i for i, name in enumerate(names)})
                        for c, o, names in zip(s.getInputCols(), s.getOutputCols(), s.labelsArray)}
        elif isinstance(s, OneHotEncoderModel):
            hot |= {o: indexed[c] for c, o in zip(s.getInputCols(), s.getOutputCols())}
        elif isinstance(s, VectorAssembler):
            inputs = s.getInputCols()
        elif isinstance(s, LinearProjectionModel):
            fit = json.loads(s.getOrDefault(s.surrogates))
            projection = np.array(fit["mean"], float), np.array(fit["scalings"], float)
        elif not isinstance(s, IdentityModel):
            return None
    if inputs != [*scaled, *hot]:  # numbers first, as build_preprocessor has them
        return None
    return ArrayPreparation(list(scaled.values()), list(hot.values()), projection)
