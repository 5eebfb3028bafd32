"""Shared helpers: reading tables, intermediate tables, ASCII text rules, Arrow slicing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: the characters of [\x20\x09-\x0D]
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: text bytes that a Python worker handles at once
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: paths of the tables written while :func:`noted` is open
_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of all tables that :func:`materialize` writes inside."""
    paths: list[str] = []
    token = _NOTED.set(paths)
    try:
        yield paths
    finally:
        _NOTED.reset(token)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: cuts
    lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _NOTED.get() is not None:
        _NOTED.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Drop a table below the shared checkpoint folder; any other path is left alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    base = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark)).toUri().getPath().rstrip("/")
    if folder.toUri().getPath().startswith(base + "/"):
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(written: DataFrame) -> None:
    """Drop the table of a :func:`materialize` result that is no longer read."""
    for file in written.inputFiles()[:1]:
        drop_table(written.sparkSession, file.rpartition("/")[0])


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, and the repository's path for Python workers that lack it."""
    import os

    checkpoint_dir(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shielded(docs: DataFrame, known: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs``, with names that no helper column of an operator has for all columns but
    ``known``; the result has the columns of ``docs`` (and those that ``work`` adds) under their names."""
    names = {c: f"passed_{i}" for i, c in enumerate(docs.columns) if c not in known}
    out = work(docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns]))
    back = {v: c for c, v in names.items()}
    return out.select(*[F.col(c).alias(back.get(c, c)) for c in out.columns])


def lower_az(col: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(col, UPPER, UPPER.lower())


def strip_ascii(col: Column) -> Column:
    return F.btrim(col, F.lit(ASCII_SPACE))


def lower_az_bytes(data: bytes) -> bytes:
    return data.lower()  # bytes.lower() maps the ASCII letters only


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size.astype(np.int64)) - size) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def spaceless(texts: pa.Array) -> list[str]:
    """A column of texts without spaces as a list, by one long text: much faster than ``to_pylist``."""
    if not len(texts):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, concatenated."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def hash_bitmap(df: DataFrame, key: str, count: int, max_bits: int = 26) -> np.ndarray:
    """A one-hash membership bitmap of a long column, for pruning before a shuffle.

    Its size follows the number of keys up to 2**max_bits bits (8 MB), so it may be broadcast;
    when more keys come it prunes less, and results stay the same because the exact join follows.
    """
    bits = 16
    while bits < max_bits and (1 << bits) < 16 * count:
        bits += 1
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos = np.unique(_place(batch.column(0).to_numpy(), bits))
            word, start = np.unique(pos >> np.uint64(6), return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (pos & np.uint64(63)), start)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["w", "v"])

    words = df.select(key).mapInArrow(run, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (64-bit) may be in a :func:`hash_bitmap`."""
    bits = int(len(bitmap)).bit_length() - 1 + 6
    pos = _place(keys, bits)
    return (bitmap[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1) == 1
