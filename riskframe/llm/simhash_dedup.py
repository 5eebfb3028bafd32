"""Operator 12: SimHash fingerprints of word shingles, linked at a small Hamming distance by
deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Of two fingerprints that differ in at most two
bits, one segment differs in at most one bit, so they share a variant of it with one bit left
out. Every distinct fingerprint is indexed under its 64 variants (32 a segment), equal variants
meet in one shuffle, and all fingerprints that meet are verified by their whole difference.

A variant that very many fingerprints share is found beforehand, by exact counts of the segment
values, and is not used. Fingerprints behind such a variant are cut into 16 segments of four bits
instead, of which at most two differ, and indexed under the 120 variants with two segments left
out. Such a variant leaves eight bits open, so no more than 256 fingerprints can share it. What
meets is thus bounded, whatever the data; within a variant, members are linked to the smallest one
they reach, so a dense group does not give all its pairs.

Results: a text without words (null, empty, white space) has fingerprint zero and links like any
other. Texts are read whole, in windows. Repeated rows and equal texts have equal fingerprints. A
null id is below all others. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialize, text_slices
from riskframe.llm.components import components

SHINGLE, SEED, DIFFER = 3, 42, 2
#: members of a variant beyond which narrower segments are used
HOT = 1024
#: members of a variant from which its links are gathered into stars
STAR = 24
#: bytes of a text that are split into words at once
WINDOW = 1 << 20
U = np.uint64
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_PLACE = (np.arange(8) * 256).astype(np.uint16)
#: masks of the 120 variants of 16 segments without two of them
_PAIRS = np.array([~((0xF << 4 * a) | (0xF << 4 * b)) & (1 << 64) - 1 for a, b in combinations(range(16), 2)], U)


def windows(data: bytes, size: int | None = None) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end at white space."""
    size = size or WINDOW
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = cut.end() if cut else len(data)
        yield data[at:end] if at or cut else data
        at = end


def fingerprint(data: bytes) -> int:
    """Of a text in UTF-8. bytes.lower and bytes.split know ASCII letters and white space only."""
    sums, total, words = np.zeros((8, 256), np.int64), 0, []
    for part in windows(data):
        words += part.lower().split()
        n = len(words) - SHINGLE + 1
        if n > 0:
            shingles = map(b" ".join, zip(*(words[i:i + n] for i in range(SHINGLE))))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
            sums += np.bincount((hashes.view(np.uint8).reshape(n, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
            total += n
            words = words[n:]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    set_bits = (2 * (sums @ _BITS) > total).ravel()
    return int.from_bytes(np.packbits(set_bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            found = np.array([fingerprint(t.as_py()) for t in texts], U)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def hot_bits(distinct: DataFrame, hot: int) -> DataFrame:
    """(fp, high, low): for each segment, the bits without which it is a hot variant.

    The members of a variant are those of two segment values that differ in its bit, so one of
    the two values has more than half of the members that make it hot.
    """
    halves = (F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF))
    out = distinct.select("fp", *(h.alias(f"v{i}") for i, h in enumerate(halves)))
    for i in range(2):
        heavy = out.groupBy(f"v{i}").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot // 2)
        own = heavy.select(f"v{i}", F.lit(0xFFFFFFFF).cast("long").alias("m"))
        bits = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("p")
        beside = heavy.select(f"v{i}", bits).select(F.col(f"v{i}").bitwiseXOR(F.expr("shiftleft(1L, p)")).alias(f"v{i}"), F.expr("shiftleft(1L, p)").alias("m"))
        masks = materialize(own.union(beside).groupBy(f"v{i}").agg(F.bit_or("m").alias(f"m{i}")), "hot")
        out = out.join(masks, f"v{i}", "left")
    return out.select("fp", F.coalesce("m0", F.lit(0)).alias("high"), F.coalesce("m1", F.lit(0)).alias("low"))


def variants(fp: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and the rows that have them. A key holds its segment, the place left out and the rest."""
    places = np.arange(32, dtype=U)
    keys, rows = [], []
    for segment, (value, hot) in enumerate(((fp >> U(32), high), (fp & U(0xFFFFFFFF), low))):
        key = (value[:, None] & ~(U(1) << places)) | places << U(32) | U(segment << 37)
        r, p = np.nonzero((hot[:, None] >> places) & U(1) == 0)
        keys.append(key[r, p])
        rows.append(r)
    r = np.flatnonzero(high | low)
    if len(r):
        # two nibbles are left out: the other 56 bits, the pair's number and the top bit
        pair = np.arange(len(_PAIRS), dtype=U)
        keys.append((U(1 << 63) | pair << U(56) | _squeeze(fp[r])).ravel())
        rows.append(np.repeat(r, len(_PAIRS)))
    return np.concatenate(keys), np.concatenate(rows)


def _squeeze(fp: np.ndarray) -> np.ndarray:
    """For each of the 120 pairs of nibbles, the other 14 nibbles side by side."""
    out = np.empty((len(fp), len(_PAIRS)), U)
    for i, (a, b) in enumerate(combinations(range(16), 2)):
        low, middle, top = ((1 << 4 * a) - 1, (1 << 4 * b) - (1 << 4 * (a + 1)), (1 << 64) - (1 << 4 * (b + 1)))
        out[:, i] = (fp & U(low)) | (fp & U(middle)) >> U(4) | (fp & U(top)) >> U(8)
    return out


def _links(keys: np.ndarray, fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Verified links of whole runs of equal keys."""
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(new, len(keys)))
    found = []
    small = (sizes > 1) & (sizes < STAR)
    at = np.repeat(new + sizes, sizes)  # end of each row's run
    i = np.flatnonzero(np.repeat(small, sizes))
    for step in range(1, int(sizes[small].max(initial=1))):
        i = i[i + step < at[i]]
        near = np.bitwise_count(fps[i] ^ fps[i + step]) <= DIFFER
        found.append((fps[i[near]], fps[i[near] + step]))
    for a, n in zip(new[sizes >= STAR], sizes[sizes >= STAR]):
        members = np.unique(fps[a:a + n])
        near = np.bitwise_count(members[:, None] ^ members) <= DIFFER
        label = np.arange(len(members))
        while True:  # the smallest member that is reached
            least = np.where(near, label, len(members)).min(axis=1)
            if (least == label).all():
                break
            label = least[least]
        found.append((members, members[label]))
    return found


def linked(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are linked, each at most
    DIFFER bits, or between members of one variant that such links connect."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                fp, high, low = (c.to_numpy().view(U) for c in whole.slice(at, 8192).columns)
                key, row = variants(fp, high, low)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp[row].view(np.int64))], ["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, U), np.empty(0, U)]  # the last run, which may go on; bounded as variants are
        for batch in batches:
            keys, fps = (np.concatenate([h, c.to_numpy().view(U)]) for h, c in zip(held, batch.columns))
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if len(keys) and keys[0] != keys[-1] else 0
            held = [keys[cut:], fps[cut:]]
            yield from out(keys[:cut], fps[:cut])
        yield from out(*held)

    def out(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _links(keys, fps) if len(keys) > 1 else []
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            pairs = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)])[a != b], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, k].copy().view(np.int64)) for k in (0, 1)], ["a", "b"])

    indexed = hot_bits(distinct, hot).mapInArrow(index, "key long, fp long")
    return indexed.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a long, b long").distinct()


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min(F.struct("doc_id")).alias("x")).select("fp", F.col("x.doc_id").alias("rep")), "distinct")
    found = materialize(components(linked(distinct.select("fp"), hot), "a", "b"), "components")
    named = distinct.join(found.withColumnRenamed("vertex", "fp"), "fp", "left").select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min(F.struct("rep")).alias("x")).select("label", F.col("x.rep").alias("component_id"))
    ids = materialize(named.join(least, "label").select("fp", "component_id"), "ids")
    return rows.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
