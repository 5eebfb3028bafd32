"""Operator 9: exact de-duplication by recipes of content-defined chunks.

A text (A-Z lower-cased) is cut where a hash of its last eight bytes meets a condition, so equal
content is cut alike wherever it stands. Distinct chunks are gathered once, by fingerprint and
content: a fingerprint with one content is a verified identifier, one with several is told apart
by the rank of its content. Documents are then equal if and only if their ordered lists of
identifiers (recipes) are, and only recipes are grouped and joined; texts move no more.

Results: null counts as empty. Rows with equal id and text are separate rows of one group, and all
rows that carry the largest id are marked kept. A null id is below all others. An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import lower_az_bytes, materialize, text_slices

#: a cut is where the top bits of the hash are zero (one place in 4,096), within these sizes
CUT_BITS, LEAST_BYTES, MOST_BYTES = 12, 1024, 65536
FINGERPRINT_BITS = 64


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``."""
    if len(data) <= LEAST_BYTES:
        return [len(data)] if data else []
    window = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    found = np.flatnonzero((window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CUT_BITS) == 0) + 8
    ends, at = [], 0
    for place in [*found.tolist(), len(data)]:
        while place - at > MOST_BYTES:
            at += MOST_BYTES
            ends.append(at)
        if place - at >= LEAST_BYTES or place == len(data):
            if place > at:
                ends.append(place)
                at = place
    return ends


def chunks(data: bytes, bits: int) -> Iterator[tuple[int, bytes]]:
    at = 0
    for end in cut_points(data):
        piece = data[at:end]
        yield (xxhash.xxh3_64_intdigest(piece) >> (64 - bits)) - (1 << 63 if bits == 64 else 0), piece
        at = end


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [lower_az_bytes(x) for x in pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()]


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def recipes(docs: DataFrame, bits: int = FINGERPRINT_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, prints array<long>): the ordered fingerprints of every text."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("text_sha256", T.StringType()),
                           T.StructField("prints", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = _texts(batch)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                pa.array([[p for p, _ in chunks(t, bits)] for t in texts], pa.list_(pa.int64()))], schema.names)

    return _source(docs, id_col, text_col).mapInArrow(run, schema)


def chunk_store(docs: DataFrame, bits: int = FINGERPRINT_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(print, content) of the distinct chunks: the only place where text is shuffled. Copies are
    dropped in every slice and in every task before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            seen = {c: p for t in _texts(batch) for p, c in chunks(t, bits)}
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen.values()), pa.int64()), pa.array(list(seen), pa.binary())], ["print", "content"])

    return _source(docs, id_col, text_col).mapInArrow(run, "print long, content binary").groupBy("print", "content").agg(F.lit(1).alias("one")).drop("one")


def collisions(store: DataFrame) -> DataFrame:
    """Fingerprints that several contents share: these are no identifiers yet."""
    return store.groupBy("print").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("print")


def verified_recipes(docs: DataFrame, bits: int = FINGERPRINT_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, recipe array<struct<print, rank>>): lists of verified identifiers."""
    listed = materialize(recipes(docs, bits, id_col, text_col), "recipes")
    shared = materialize(collisions(chunk_store(docs, bits, id_col, text_col)), "shared-prints")
    plain = F.transform("prints", lambda p: F.struct(p.alias("print"), F.lit(0).alias("rank")))
    if shared.isEmpty():
        return listed.select("doc_id", "text_sha256", plain.alias("recipe"))
    contents = chunk_store(docs, bits, id_col, text_col).join(shared, "print")
    ranks = contents.withColumn("rank", F.row_number().over(Window.partitionBy("print").orderBy("content")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows = [(hashlib.sha256(t).hexdigest(), i, p, c) for t in _texts(batch) for i, (p, c) in enumerate(chunks(t, bits))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                                                 ["text_sha256", "at", "print", "content"])

    used = _source(docs, id_col, text_col).mapInArrow(run, "text_sha256 string, at int, print long, content binary").join(shared, "print")
    told = (used.join(ranks, ["print", "content"]).groupBy("text_sha256").agg(
        F.map_from_entries(F.collect_set(F.struct("at", "rank"))).alias("ranks")))
    return listed.join(told, "text_sha256", "left").select("doc_id", "text_sha256", F.transform(
        "prints", lambda p, i: F.struct(p.alias("print"), F.coalesce(F.element_at("ranks", i), F.lit(0)).alias("rank"))).alias("recipe"))


def groups(docs: DataFrame, bits: int = FINGERPRINT_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with the id that stays of its equals, their number, and its verdict."""
    rows = verified_recipes(docs, bits, id_col, text_col)
    # written first: a join of two plain shuffles lets adaptive execution split a very large group
    sums = materialize(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return rows.join(sums, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
