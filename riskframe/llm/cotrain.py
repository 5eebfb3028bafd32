"""Operator 7: quality classifier by co-training of two views.

One view is the text's content (shares of neighbouring character classes, word and repetition
figures), the other its page metadata (source, language, lengths, shape of the lines). Each view
has a logistic regression. In every round each classifier labels the unlabelled documents that it
is confident of, and these join the other's training rows. Then each view is calibrated on
labelled documents that took no part in training, a last regression over the two calibrated views
combines them, and its cutoff is put where few labelled good documents fall below it.

Fitting happens on the driver on bounded samples, chosen by a hash of the id: about ``Settings.labelled`` labelled
rows at most, half of them of each class (a class with fewer comes whole), and ``Settings.pseudo`` pseudo-labels per
class, view and round. Pseudo-labels are looked for among all unlabelled documents, and all documents
are scored.

Results: null or empty text is scored by its metadata and zero content; null metadata is empty;
null or doubled labels: a document whose labels disagree or are null counts as unlabelled. Repeated
rows are rows of their own, in training as in the result. A score equal to the cutoff is kept. If the
labels lack a class nothing can be learned: the score is the share of good labels (1 without any)
and everything is kept. An empty table gives no rows. Other columns pass through :func:`keep_good`, whatever
their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import materialize, shielded, text_slices
from riskframe.llm.quality_rules import count_texts


@dataclass(frozen=True)
class Settings:
    labelled: int = 20_000
    pseudo: int = 2_000
    rounds: int = 2
    confident: float = 0.97
    holdout: float = 0.4
    regularization: float = 1e-4
    #: share of labelled good documents that the cutoff may reject
    lost_good: float = 0.005


#: text bytes that features are made of at once
SLICE = 1 << 20
CLASSES = 8
SOURCES, LANGS = 32, 16
TEXT_DIM, META_DIM = CLASSES * CLASSES + 8, SOURCES + LANGS + 5
_CLASS_OF = np.full(256, 7, np.uint8)  # 7: bytes of other scripts and accents
for _i, _set in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".,;:'\"()-?"]):
    _CLASS_OF[list(_set)] = _i
_CLASS_OF[[b for b in range(128) if _CLASS_OF[b] == 7]] = 6  # other ASCII: signs


def _bucket(values: pa.Array, n: int) -> np.ndarray:
    out = np.zeros((len(values), n), np.float32)
    for i, v in enumerate(values.to_pylist()):
        out[i, zlib.crc32(str("" if v is None else v).encode()) % n] = 1
    return out


def features(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both views of a slice of documents: (rows x TEXT_DIM), (rows x META_DIM)."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    n = len(texts)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(pc.binary_join(pa.array([texts.to_pylist()], pa.list_(pa.string())), "")[0].as_py().encode(), np.uint8)
    kind = _CLASS_OF[data].astype(np.int64)
    doc = np.repeat(np.arange(n), size)
    inside = doc[:-1] == doc[1:]
    pairs = np.bincount((doc[:-1] * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:])[inside], minlength=n * CLASSES * CLASSES)
    pairs = pairs.reshape(n, CLASSES * CLASSES) / np.maximum(size, 1)[:, None]
    c = count_texts(texts)
    words, lines, chars = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1), np.maximum(c["n_chars"], 1)
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    codes = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode().indices.to_numpy().astype(np.int64)
    word_doc = np.repeat(np.arange(n), np.diff(offsets))
    same = np.bincount(word_doc[1:][(codes[1:] == codes[:-1]) & (word_doc[1:] == word_doc[:-1])], minlength=n)
    top = int(codes.max(initial=0)) + 1
    kinds = np.bincount(np.unique(word_doc * top + codes) // top, minlength=n)
    content = np.column_stack([
        pairs, np.minimum(c["n_symbols"] / words, 3), np.minimum(c["n_bangs"] / words, 3), c["n_upper"] / chars,
        np.minimum(c["word_chars"] / words, 20) / 10, c["n_repeat_words"] / words, c["n_dup_lines"] / lines, same / words, kinds / words ** 0.8])
    meta = np.column_stack([_bucket(sources, SOURCES), _bucket(langs, LANGS), np.log1p(c["n_chars"]), np.log1p(c["n_lines"]),
                            np.log1p(c["n_chars"] / lines), np.log1p(c["n_words"] / lines), size / chars])
    return content.astype(np.float32), meta.astype(np.float32)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(m, np.float32).ravel()), m.shape[1]).cast(pa.list_(pa.float32()))


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with content array<float> and meta array<float>."""
    docs = docs.drop("content", "meta")
    schema = T.StructType([*docs.schema.fields, T.StructField("content", T.ArrayType(T.FloatType())), T.StructField("meta", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            content, meta = features(*(batch.column(c) for c in ("text", "lang", "source")))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(content), _lists(meta)], schema.names)

    return docs.mapInArrow(run, schema)


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, content array<float>, meta array<float>)."""
    return with_features(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "content", "meta")


@dataclass
class Model:
    """Weights of both views, their calibrations, the combination and the cutoff."""

    content: np.ndarray
    meta: np.ndarray
    content_scale: np.ndarray
    meta_scale: np.ndarray
    combined: np.ndarray
    cutoff: float
    constant: float | None = None

    @staticmethod
    def _line(m: np.ndarray, w: np.ndarray) -> np.ndarray:
        return m.astype(np.float64) @ w[:-1] + w[-1]

    def views(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Calibrated log odds of both views."""
        return np.column_stack([self._line(self._line(content, self.content)[:, None], self.content_scale),
                                self._line(self._line(meta, self.meta)[:, None], self.meta_scale)])

    def score(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(content), self.constant)
        return _sigmoid(self._line(self.views(content, meta), self.combined))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Rows:
    """Training rows on the driver: both views, labels and weights. Bounded by Settings."""

    content: np.ndarray
    meta: np.ndarray
    y: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(df: DataFrame) -> "Rows":
        t = df.select("content", "meta", F.col("y").cast("double").alias("y"), F.col("weight").cast("double").alias("weight")).toArrow()
        view = lambda c, d: pc.list_flatten(t.column(c)).to_numpy().astype(np.float64).reshape(t.num_rows, d)
        return Rows(view("content", TEXT_DIM), view("meta", META_DIM), t.column("y").to_numpy(), t.column("weight").to_numpy())

    def __add__(self, other: "Rows") -> "Rows":
        return Rows(*(np.concatenate(x) for x in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.content, self.meta, self.y, self.weight

    def fit(self, view: str, settings: Settings) -> np.ndarray:
        return fit_small(getattr(self, view), self.y, settings.regularization * self.weight.sum(), weight=self.weight)


def _scored(table: DataFrame, column: str, weights: np.ndarray, out: str) -> DataFrame:
    """``table`` with the probability by one view."""
    w = F.array(*(F.lit(float(x)) for x in weights[:-1]))
    odds = F.aggregate(F.zip_with(F.col(column).cast("array<double>"), w, lambda a, b: a * b), F.lit(float(weights[-1])), lambda s, x: s + x)
    return table.withColumn(out, 1 / (1 + F.exp(-odds)))


def _one_in(n: int, most: int, salt: int) -> Column:
    """True for about ``most`` of ``n`` rows, by a hash of the id, in steps of 2**-63."""
    share = min(2**63 - 1, 2**63 * most // max(n, 1))
    return F.lit(True) if n <= most else F.shiftrightunsigned(F.xxhash64(F.lit(salt), "doc_id"), 1) < F.lit(share)


def train(table: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """``table``: features of all documents; ``labels``: (doc_id, quality 0 or 1)."""
    table = table.select("doc_id", "content", "meta")
    known = (labels.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("y2"))
             .where("y = y2 and y in (0, 1)").select("doc_id", "y"))
    marked = table.join(known, "doc_id", "left")
    share = {r["y"]: r["n"] for r in marked.where("y is not null").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, none = sum(share.values()), np.zeros(1)
    if len(share) < 2:
        return Model(none, none, none, none, none, 0.0, share.get(1, 0) / n if n else 1.0)
    part = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1000)) < int(1000 * settings.holdout)
    # the labelled sample, bounded for each class; both classes weigh the same
    half = settings.labelled // 2
    drawn = {c: min(share[c], half) for c in (0, 1)}
    picked = ((F.col("y") == 1) & _one_in(share[1], half, 3)) | ((F.col("y") == 0) & _one_in(share[0], half, 3))
    weight = {c: sum(drawn.values()) / 2 / drawn[c] for c in (0, 1)}
    base = materialize(marked.where(picked).withColumn("held", part)
                       .withColumn("weight", F.when(F.col("y") == 1, F.lit(weight[1])).otherwise(F.lit(weight[0]))), "labelled")
    open_rows = table.join(known, "doc_id", "left_anti")
    views = ("content", "meta")
    sample = base.select("content", "meta", "y", "weight", "held")
    if min(sample.where("held").agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()) == 0 or \
            min(sample.where("not held").agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()) == 0:
        start = held = Rows.of(sample)  # too few labels to hold any out
    else:
        start, held = Rows.of(sample.where("not held")), Rows.of(sample.where("held"))
    rows = {v: start for v in views}
    weights = {v: rows[v].fit(v, settings) for v in views}
    other = {"content": "meta", "meta": "content"}
    for k in range(settings.rounds):
        pool = _scored(_scored(open_rows, "content", weights["content"], "p_content"), "meta", weights["meta"], "p_meta")
        by = {v: (F.col(f"p_{v}") >= settings.confident, F.col(f"p_{v}") <= 1 - settings.confident) for v in views}
        sure = by["content"][0] | by["content"][1] | by["meta"][0] | by["meta"][1]
        # scored once a round: what comes after reads the confident ids only
        pool = materialize(pool.where(sure & F.col("doc_id").isNotNull()).select("doc_id", "p_content", "p_meta"), "confident")
        found = pool.agg(*(F.count_if(by[v][c]).alias(f"{v}{c}") for v in views for c in (0, 1))).first()
        take = {v: [by[v][c] & _one_in(found[f"{v}{c}"], settings.pseudo, 11 + k) for c in (0, 1)] for v in views}
        said = {v: F.when(take[v][0], F.lit(1)).when(take[v][1], F.lit(0)).alias(f"y_{v}") for v in views}
        chosen = pool.select("doc_id", *said.values()).where("y_content is not null or y_meta is not null").distinct()
        new = materialize(open_rows.join(F.broadcast(chosen), "doc_id"), "pseudo")  # about 8 x settings.pseudo rows at most
        for v in views:
            rows[other[v]] = rows[other[v]] + Rows.of(new.where(F.col(f"y_{v}").isNotNull()).select("content", "meta", F.col(f"y_{v}").alias("y"), F.lit(0.5).alias("weight")))
        weights = {v: rows[v].fit(v, settings) for v in views}
    odds = {v: Model._line(getattr(held, v), weights[v]) for v in views}
    y = held.y
    scale = {v: fit_small(odds[v][:, None], y) for v in views}
    both = np.column_stack([Model._line(odds[v][:, None], scale[v]) for v in views])
    model = Model(weights["content"], weights["meta"], scale["content"], scale["meta"], fit_small(both, y), 0.0)
    p = _sigmoid(Model._line(both, model.combined))
    good = np.sort(p[y == 1])
    model.cutoff = float(min(0.5, good[int(settings.lost_good * len(good))]))
    return model


def fit_small(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60, weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression on standardized columns, by damped Newton steps: weights and intercept."""
    weight = np.ones(len(x)) if weight is None else weight
    middle, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-12] = np.inf  # a constant column gets no weight
    a = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    w, pen = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], ridge), 0)

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float(weight @ (np.logaddexp(0, z) - y * z) + pen @ (w * w) / 2)

    for _ in range(steps):
        p = _sigmoid(a @ w)
        slope = a.T @ (weight * (p - y)) + pen * w
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(pen + 1e-9), slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    out = w[:-1] / spread
    return np.append(out, w[-1] - out @ middle)


def score_table(table: DataFrame, model: Model) -> DataFrame:
    """(doc_id, content_score, meta_score, score, kept)."""
    shared = table.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([table.schema["doc_id"], *(T.StructField(n, T.DoubleType()) for n in ("content_score", "meta_score", "score")), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if b.num_rows:
                content, meta = (pc.list_flatten(b.column(c)).to_numpy().reshape(b.num_rows, -1) for c in ("content", "meta"))
                score = m.score(content, meta)
                views = _sigmoid(m.views(content, meta)) if m.constant is None else np.column_stack([score, score])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(views[:, 0]), pa.array(views[:, 1]), pa.array(score), pa.array(score >= m.cutoff)], schema.names)

    return table.select("doc_id", "content", "meta").mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Scores and verdicts of all documents."""
    table = materialize(feature_table(docs), "features")
    return score_table(table, train(table, labels, settings))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rejected documents. Texts and features are written once; the scores filter
    what was written, so no feature is made twice and no text is shuffled."""
    def work(docs: DataFrame) -> DataFrame:
        table = materialize(with_features(docs), "features")
        shared = docs.sparkSession.sparkContext.broadcast(train(table, labels, settings))
        names, schema = docs.columns, docs.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                content, meta = (pc.list_flatten(batch.column(c)).to_numpy().reshape(batch.num_rows, -1) for c in ("content", "meta"))
                kept = shared.value.score(content, meta) >= shared.value.cutoff
                yield batch.select(names).filter(pa.array(kept))

        return table.mapInArrow(run, schema)

    return shielded(docs, ["doc_id", "text", "lang", "source"], work)
