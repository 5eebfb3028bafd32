"""Operator 4: packing documents into token sequences, shortest pack first, by length histogram.

1. Every document is encoded, its end id appended and cut into pieces of at most ``size`` ids.
2. The counts by piece length (at most ``size`` rows, whatever the corpus) go to the driver.
   Lengths are placed longest first: each piece goes to the shortest pack that still has room,
   and whole groups of equal packs are extended at once, so only the counts of packing patterns
   change. New packs take as many pieces of the length as they hold.
3. Pieces get a rank within their length, in blocks of bounded size so that a frequent length is
   spread over many tasks, and the rank names pattern, pack and place.

A pack of ``size`` ids or of a power of two needs no padding; others are padded to ``size``.
The table of pieces and the result are small beside the texts. Both are written by few tasks, whatever the
partitions of the input and of the shuffles: each Parquet file takes a writer's buffers, and on a local disk
Hadoop has the executor start several processes to set a file's permissions.
Results: null or empty text is a document of its end id alone; repeated rows are packed each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import materialize, text_slices
from riskframe.llm.units import encode_dropped, library_encoder, load_tokenizer, word_encoder, worker_memo

#: pieces ranked by one task, text bytes encoded at once
BLOCK_ROWS, SLICE = 100_000, 2 << 20


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece."""
    model = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf8"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cache(lambda: load_tokenizer(model.value))  # one object for both, when a worker needs them
        memo = worker_memo("word" + hashlib.md5(model.value.encode()).hexdigest(), lambda: library_encoder(tokenizer()),
                           make_words=lambda: word_encoder(tokenizer(), lower=True, spaced=False))
        for batch in text_slices(batches, limit=SLICE):
            ids, ends = encode_dropped(memo, batch.column("text"))
            rows, out = [], []
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                x = np.append(ids[a:b], end_id).astype("<u4")
                for s in range(0, len(x), size):
                    part = x[s:s + size]
                    rows.append(i)
                    out.append((s, len(part), zlib.crc32(part.tobytes()), len(x)))
            columns = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int32()))] + [pa.array(columns[:, k].copy()) for k in range(4)], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns of a length histogram: (number of packs, [(length, pieces in a pack)])."""
    heap: list[tuple[int, int, int, list]] = []  # (-room, order, packs, pattern)
    closed, order = [], 0

    def put(room: int, packs: int, pattern: list) -> None:
        nonlocal order
        if room:
            heapq.heappush(heap, (-room, order, packs, pattern))
            order += 1
        else:
            closed.append((packs, pattern))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and heap and -heap[0][0] >= length:
            room, _, packs, pattern = heapq.heappop(heap)
            used = min(packs, left)
            put(-room - length, used, [*pattern, length])
            if used < packs:
                put(-room, packs - used, pattern)
            left -= used
        per = size // length
        if left // per:
            put(size - per * length, left // per, [length] * per)
        if left % per:
            put(size - left % per * length, 1, [length] * (left % per))
    closed += [(packs, pattern) for _, _, packs, pattern in heap]
    out = []
    for packs, pattern in closed:
        runs: dict[int, int] = {}
        for x in pattern:
            runs[x] = runs.get(x, 0) + 1
        out.append((packs, list(runs.items())))
    return out


class Places:
    """Where the piece of a length and rank goes, from the packing patterns."""

    def __init__(self, patterns: list[tuple[int, list[tuple[int, int]]]], size: int):
        keys, taken, first_pack = [], {}, 0
        for packs, runs in patterns:
            offset = 0
            for length, times in runs:
                for _ in range(times):
                    rank = taken.get(length, 0)
                    keys.append((length, rank, packs, first_pack, offset))
                    taken[length] = rank + packs
                    offset += length
            first_pack += packs
        table = np.array(sorted(keys), np.int64).reshape(-1, 5)
        self.length, self.rank, _, self.first_pack, self.offset = table.T
        self.base = {int(v): int(i) for i, v in reversed(list(enumerate(self.length)))}
        self.count = {int(v): int(c) for v, c in zip(*np.unique(self.length, return_counts=True))}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pack, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for v in np.unique(length):
            at = np.flatnonzero(length == v)
            base = self.base[int(v)]
            rows = base + np.searchsorted(self.rank[base:base + self.count[int(v)]], rank[at], side="right") - 1
            pack[at] = self.first_pack[rows] + rank[at] - self.rank[rows]
            offset[at] = self.offset[rows]
        return pack, offset


def ranked(pieces: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``pieces`` with rank: 0, 1, ... within each length. A length is ranked in hashed blocks, and
    the counts of the blocks before it are added."""
    blocks = max(1, -(-pieces.count() // block_rows))
    blocked = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (blocked.groupBy("length", "block").count()
            .select("length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")))
    return (blocked.withColumn("rank", F.row_number().over(within) - 1)
            .join(sums, ["length", "block"])
            .withColumn("rank", F.col("rank") + F.col("before")).drop("block", "before"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = 2048,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every piece with its sequence and place in it."""
    spark = docs.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    pieces = materialize(cut_pieces(docs, tokenizer_path, end_id, size).repartition(tasks), "pieces")
    counts = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    places = spark.sparkContext.broadcast(Places(pack_histogram(counts, size), size))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pack_of, offset = places.value.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pack_of), pa.array(offset)], schema.names)

    tasks = max(tasks, -(-sum(counts.values()) // block_rows))
    return ranked(pieces, block_rows).select(*pieces.columns, "rank").coalesce(tasks).mapInArrow(run, schema)


def read_sequences(spark, pieces: DataFrame, size: int) -> DataFrame:
    """(sequence_id, used, padded): the lengths of all sequences; a power of two stays unpadded."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    return used.withColumn("padded", F.when(F.bit_count("used") == 1, F.col("used")).otherwise(F.lit(size)))
