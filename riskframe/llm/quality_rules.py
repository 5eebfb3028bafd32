"""Operator 2: quality rules whose cutoffs are certified on labelled documents.

Fixed base rules come first. Each of the other rules walks its own strictness steps, whose cutoffs,
from loose to strict, are fixed before any data is seen. In each stratum (language) the labelled good
documents that pass the base rules are split by a hash of the text, after equal texts of a stratum
have been reduced to one, so that the rows are independent draws. One in CHOOSE of them only choose
the order in which the steps of all rules are tried: the next step of whichever rule costs the fewest
good documents, so a rule that is wrong for the language comes last and holds up no other. The rest
are a holdout: if k of n of them would go by any rule after j steps of that order, the exact binomial
tail P(X <= k | n, alpha) is the p-value of "more than alpha of the good documents are rejected".
The order does not depend on the holdout and the walk stops at the first j that fails, so a stratum is
one test of all its rules together, and the strata share the error by Bonferroni. With probability
1 - delta no stratum loses more than alpha of its good documents. A stratum without enough labels to
certify anything keeps everything.

Results: null or empty text has no words and fails the base rules; a null language is a stratum of
its own; a label without a document, or a null label, counts for nothing; repeated rows are judged
each, and count once in the holdout. A value equal to a cutoff passes it. An empty table gives no
rows. Added columns begin with two underscores; :func:`annotate` replaces columns of their names, under
:func:`keep_good` all other columns pass untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import materialize, shielded, text_slices

ALPHA, DELTA = 0.03, 0.05
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_chars"]

#: cutoffs by step, loose to strict; a document goes if its value is above the cutoff
STEPS = {
    "symbols_per_word": (2.0, 1.0, 0.6, 0.45, 0.3, 0.2, 0.12, 0.06),
    "bangs_per_word": (1.8, 1.2, 0.8, 0.6, 0.45, 0.3, 0.2, 0.1),
    "upper_share": (0.6, 0.55, 0.5, 0.45, 0.4, 0.36, 0.3, 0.2),
    "word_length": (16.0, 14.0, 13.0, 12.0, 11.0, 10.0, 9.5, 9.0),
    "short_words": (0.8, 0.7, 0.6, 0.55, 0.5, 0.45, 0.4, 0.36),
    "dup_line_share": (0.9, 0.8, 0.7, 0.65, 0.6, 0.55, 0.5, 0.4),
    "repeated_share": (0.28, 0.25, 0.22, 0.2, 0.18, 0.15, 0.12, 0.1),
}
N_STEPS = 8
RULES = list(STEPS)
#: text bytes counted at once
SLICE = 1 << 20
#: one in so many labelled good documents chooses the order of the steps, the others certify
CHOOSE = 4


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def _codes(values: np.ndarray) -> np.ndarray:
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """Values of a list column, and the row of each."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return pc.list_flatten(lists), np.repeat(np.arange(len(lists)), n)


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of a column of texts, exact, for all rows at once."""
    texts, n = pc.fill_null(texts, ""), len(texts)
    words, doc = _flat(pc.ascii_split_whitespace(texts))
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # white space at the ends leaves empty words
    words, doc = words.filter(pa.array(real)), doc[real]
    code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    # codes of 2, 4 and 8 words from codes of half as many; windows do not cross documents
    span = 1
    while span < WINDOW and len(code) > span:
        code = _codes(code[:-span] * (int(code.max()) + 1) + code[span:])
        span *= 2
    covered = np.zeros(len(doc) + 1, np.int64)
    if span == WINDOW and len(code):
        starts = np.flatnonzero(doc[:len(code)] == doc[WINDOW - 1:])
        key = _codes(doc[starts] * (int(code.max()) + 1) + code[starts])
        twice = starts[np.bincount(key)[key] > 1] if len(key) else starts
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    lines, line_doc = _flat(pc.split_pattern(texts, "\n"))
    filled = pc.match_substring_regex(lines, "[^\\x20\\x09-\\x0D]").to_numpy(zero_copy_only=False)
    line_code = lines.dictionary_encode().indices.to_numpy().astype(np.int64)[filled]
    line_doc = line_doc[filled]
    n_lines = np.bincount(line_doc, minlength=n)
    distinct = np.unique(line_doc * (int(line_code.max(initial=0)) + 1) + line_code)
    kinds = np.bincount(distinct // (int(line_code.max(initial=0)) + 1), minlength=n)
    regex = lambda p: pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False).astype(np.int64)
    return {"n_words": np.bincount(doc, minlength=n).astype(np.int64),
            "word_chars": _per_doc(pc.utf8_length(words).to_numpy(zero_copy_only=False), doc, n),
            "n_symbols": regex("[#*$%&|<>]"), "n_dup_lines": (n_lines - kinds).astype(np.int64),
            "n_repeat_words": _per_doc(repeated, doc, n), "n_lines": n_lines.astype(np.int64),
            "n_upper": regex("\\p{Lu}"), "n_bangs": regex("!"),
            "n_chars": pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)}


def annotate(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its counts as columns named __<count>, and a hash of the text as __text."""
    names = [f"__{c}" for c in COUNTS]
    docs = docs.drop(*names, "__text").withColumn("__text", F.xxhash64(text_col))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col, SLICE):
            found = count_texts(batch.column(text_col).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[c]) for c in COUNTS)], schema.names)

    return docs.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words"))


def rule_steps() -> list[Column]:
    """For each of RULES, the first step at which it rejects the row; N_STEPS if none does."""
    words, share = F.greatest(F.col("__n_words"), F.lit(1)), lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    value = {"symbols_per_word": F.col("__n_symbols") / words, "bangs_per_word": F.col("__n_bangs") / words,
             "upper_share": share("__n_upper", "__n_chars"), "word_length": F.col("__word_chars") / words,
             "short_words": words / F.greatest(F.col("__word_chars"), F.lit(1)),
             "dup_line_share": share("__n_dup_lines", "__n_lines"), "repeated_share": F.col("__n_repeat_words") / words}
    out = dict.fromkeys(RULES, F.lit(N_STEPS))
    for rule, cutoffs in STEPS.items():
        for t in reversed(range(N_STEPS)):
            out[rule] = F.when(value[rule] > F.lit(cutoffs[t]), F.lit(t)).otherwise(out[rule])
    return list(out.values())


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k), X binomial. Below the mean, terms fall at least geometrically from k down, so the
    sum ends when they no longer count; above it, the other tail is summed."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    if k > n * p:
        return 1.0 - binomial_tail(n - k - 1, n, 1.0 - p)
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total, i = term, k
    while i > 0 and term > total * 1e-18:
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        i -= 1
    return min(1.0, total)


def certified_steps(counts: list[int], n: int, alpha: float, level: float) -> int:
    """Number of steps certified in order; ``counts``: good documents first rejected at each step."""
    gone = 0
    for t, count in enumerate(counts):
        gone += count
        if n == 0 or binomial_tail(gone, n, alpha) > level:
            return t
    return len(counts)


def step_order(costs: list[list[int]]) -> list[int]:
    """The place in the order of each step of each rule, flat. ``costs``: by rule, choosing documents
    first rejected at each step. The cheapest next step comes first, of equals the loosest."""
    at, place = [0] * len(costs), [0] * (len(costs) * N_STEPS)
    for j in range(len(place)):
        _, t, i = min((costs[i][t], t, i) for i, t in enumerate(at) if t < N_STEPS)
        place[i * N_STEPS + t] = j
        at[i] += 1
    return place


def certify(annotated: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id",
            alpha: float = ALPHA, delta: float = DELTA, small: int = 10_000) -> DataFrame:
    """(stratum, holdout, steps) of the strata that have labelled good documents; ``steps`` has the
    number certified for each of RULES."""
    good = labels.where(F.col("quality") == 1).select(F.col(id_col).alias("__id")).distinct()
    held = (annotated.where(~base_failed()).select(id_col, F.col(stratum_col).alias("stratum"), F.array(*rule_steps()).alias("step"), "__text")
            .join(good, F.col(id_col) == F.col("__id"))
            .groupBy("stratum", "__text").agg(F.min("step").alias("step"))  # equal texts have equal steps
            .select("stratum", "step", (F.pmod(F.xxhash64(F.col("__text")), F.lit(CHOOSE)) == 0).alias("chooses")))
    held = materialize(held, "holdout")
    rules, places = range(len(RULES)), range(len(RULES) * N_STEPS)
    cost = [F.count_if(F.col("chooses") & (F.col("step")[i] == t)).alias(f"c{i * N_STEPS + t}") for i in rules for t in range(N_STEPS)]
    costs = held.groupBy("stratum").agg(*cost)
    stratum, ints = costs.schema["stratum"], T.ArrayType(T.IntegerType())

    def order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"stratum": f["stratum"], "place": [
                step_order([[int(r[f"c{i * N_STEPS + t}"]) for t in range(N_STEPS)] for i in rules]) for r in f.to_dict("records")]})

    orders = materialize(costs.mapInPandas(order, T.StructType([stratum, T.StructField("place", ints)])), "orders")
    n_strata = orders.count()
    level = delta / max(1, n_strata)
    side = orders.select(F.col("stratum").alias("__stratum"), "place")
    met = held.join(F.broadcast(side) if n_strata <= small else side, F.col("stratum").eqNullSafe(F.col("__stratum")))
    step = lambda i: F.col("step")[i]
    first = F.least(*(F.when(step(i) < N_STEPS, F.col("place")[step(i) + i * N_STEPS]).otherwise(len(places)) for i in rules))
    gone = [F.count_if(~F.col("chooses") & (F.col("first") == j)).alias(f"g{j}") for j in places]
    sums = materialize(met.select("stratum", "place", "chooses", first.alias("first")).groupBy("stratum")
                       .agg(F.count_if(~F.col("chooses")).alias("holdout"), F.first("place").alias("place"), *gone), "strata")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            steps = []
            for r in f.to_dict("records"):
                n = certified_steps([int(r[f"g{j}"]) for j in places], int(r["holdout"]), alpha, level)
                steps.append((np.asarray(r["place"]).reshape(len(RULES), N_STEPS) < n).sum(axis=1).tolist())
            yield pd.DataFrame({"stratum": f["stratum"], "holdout": f["holdout"], "steps": steps})

    return sums.mapInPandas(run, T.StructType([stratum, T.StructField("holdout", T.LongType()), T.StructField("steps", ints)]))


def judge(annotated: DataFrame, strata: DataFrame, stratum_col: str = "lang", small: int = 10_000) -> DataFrame:
    """``annotated`` with __base_failed, __steps (by rule) and __kept. A few strata are broadcast; many are
    joined by shuffle, where adaptive execution splits the large ones."""
    known = strata.where(F.array_max("steps") > 0).select(F.col("stratum").alias("__stratum"), F.col("steps").alias("__steps"))
    if known.count() <= small:
        known = F.broadcast(known)
    out = annotated.join(known, F.col(stratum_col).eqNullSafe(F.col("__stratum")), "left").drop("__stratum")
    out = out.withColumn("__steps", F.coalesce("__steps", F.array(*[F.lit(0)] * len(RULES)))).withColumn("__base_failed", base_failed())
    kept = ~F.col("__base_failed")
    for i, step in enumerate(rule_steps()):
        kept = kept & (step >= F.col("__steps")[i])
    return out.withColumn("__kept", kept)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of operator 2; certified_steps is the largest number certified for a rule."""
    counted = materialize(annotate(docs.select("doc_id", "text", "lang")).drop("text"), "counts")
    out = judge(counted, certify(counted, labels))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *(F.col(f"__{c}").alias(c) for c in base), F.col("__base_failed").alias("base_failed"),
                      F.col("__kept").alias("kept"), F.array_max("__steps").alias("certified_steps"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are rejected. Texts and counts are written once; the
    verdicts filter what was written, so no text is counted twice or shuffled."""
    def work(docs: DataFrame) -> DataFrame:
        counted = materialize(annotate(docs), "counts")
        return judge(counted, certify(counted, labels)).where("__kept").select(*docs.columns)

    return shielded(docs, ["doc_id", "text", "lang"], work)
