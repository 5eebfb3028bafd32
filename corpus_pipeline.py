"""A training-corpus pipeline over ``documents``.

Stages in order: drop what the quality classifier rejects, drop what the certified quality rules
reject, remove lines that recur over documents, keep one document of each group of near copies,
pack what is left into token sequences. Each stage takes the Parquet that the one before wrote.
All but the last return the columns of ``documents``; ``n_chars`` follows the text.

ORACLE_SQL is None: a trained classifier and a tokenizer are beyond SQL, so the tests hold the
stages against plain Python instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import cotrain, jaccard_join, line_dedup, packing, quality_rules
from riskframe.llm.common import drop_table, materialize, noted, prepare, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: near copies share at least 0.8 of their runs of five words (op10's contract has 4 words and 0.85)
NEAR = jaccard_join.Rule(5, 80, 100)


#: intermediate tables of the stage that ran last, by Spark application
_LEFT: dict[str, list[str]] = {}


def stage(work: Callable, last: bool = False) -> Callable:
    """A stage first drops the intermediate tables of the stage before it, whose result has been written
    by then; they stay where ``docs`` still reads them. Nothing follows the last stage, so its
    tables stay."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        app, read = spark.sparkContext.applicationId, {f.rpartition("/")[0].rpartition("/")[2] for f in docs.inputFiles()}
        left = _LEFT.pop(app, [])
        if not any(path.rpartition("/")[2] in read for path in left):
            for path in left:
                drop_table(spark, path)
            left = []
        with noted() as made:
            out = work(spark, docs, sf_dir)
        _LEFT[app] = left + ([] if last else made)
        return out

    return run_stage


@stage
def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotrain.keep_good(docs.select(COLUMNS), read_table(spark, sf_dir, "labels"))


@stage
def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs.select(COLUMNS), read_table(spark, sf_dir, "labels"))


@stage
def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that loses every line stays, with empty text."""
    out = line_dedup.deduplicate(docs.select(COLUMNS))
    changed = F.when(F.col("__n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(COLUMNS)


@stage
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs.select(COLUMNS), NEAR)


@partial(stage, last=True)
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select(COLUMNS), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", classified), ("quality rules", ruled), ("line dedup", lines_once),
          ("n-gram Jaccard join", one_of_near_copies), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
