"""Operator 5: token ids in shard files, compressed by a Re-Pair grammar.

A shard holds the ids of whole documents in ascending id order. Frequent pairs of neighbouring
symbols are replaced by new symbols, again and again, until no pair is left with LEAST_USES uses; each
round replaces all pairs that are frequent at its start, where they overlap the more frequent one,
and the next one looks anew only around the symbols that are new. A shard stores its rules with the length of what each expands to, so any
document, or any range of its ids, is decoded without the rest of the shard. No rule crosses the
end of a document.

Shards are rows of a Parquet table (first document, ids before the shard in its part, payload), so
they are written by Spark's committer to shared storage and a lost task leaves nothing behind.

A shard is closed at the end of the document with which it holds ``shard_ids`` ids or more; only a single
document can make it longer than that by more than its own length.

Payload, little-endian: b"RPR1", then five uint32 (documents, rules, symbols, first rule symbol,
width of a symbol in bytes), then arrays: doc ids int64, null flags uint8, symbols before each
document uint32 (one more than documents), ids of each document uint32, rule left and right
uint32, rule expansion lengths uint32, symbols.

Results: null or empty text is a document of its end id alone. Rows are ordered by id, nulls
first, then text; repeated rows are stored each. An empty table gives no shards and no rows.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import expand, materialize, text_slices
from riskframe.llm.units import byte_level_joiner, encode_spaced, library_encoder, worker_memo

MAGIC = b"RPR1"
#: ids after which a shard is closed, least uses of a pair that is replaced
SHARD_IDS, LEAST_USES = 1 << 19, 8
#: units a worker remembers; parts of units repeat so often that more gain nothing
MEMO_UNITS = 650_000
SHARD_SCHEMA = "part int, seq int, first_doc long, n_docs long, n_ids long, ids_before long, payload binary"


def _frequent_pairs(symbols: np.ndarray, places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys (left << 32 | right) of the pairs at ``places`` that occur ``least`` times there, their uses,
    where they are, and which of them is there. Hashed counts rule most places out; the rest is counted exactly."""
    # masks are slow to index with where they are neither nearly full nor nearly empty, so places are listed
    if 2 * len(places) > len(symbols):
        pairs = (symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:])[places]
    else:
        pairs = symbols[places].astype(np.uint64) << np.uint64(32) | symbols[places + 1]
    bits = min(20, max(8, len(places).bit_length() + 1))
    slot = (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).view(np.int64)
    some = np.flatnonzero((np.bincount(slot, minlength=1 << bits) >= least)[slot])
    coded = pa.array(pairs[some]).dictionary_encode()
    keys, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    uses = np.bincount(which, minlength=len(keys))
    chosen = np.flatnonzero(uses >= least)
    number = np.full(len(keys), -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    which = number[which]
    exact = np.flatnonzero(which >= 0)
    return keys[chosen], uses[chosen], places[some[exact]], which[exact]


def _apart(hits: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """Which hits are replaced: of overlapping ones those of the more frequent pair, and of equally
    frequent ones in a row the first, third, ...; then the same among the hits that overlap none of
    these, until every hit is replaced or overlaps one that is."""
    taken = np.zeros(len(hits), bool)
    index, at, often = np.arange(len(hits)), hits, uses
    while len(at):
        linked = at[1:] - at[:-1] == 1  # i and i + 1 overlap
        keep = np.ones(len(at), bool)
        keep[:-1] &= ~(linked & (often[:-1] < often[1:]))
        keep[1:] &= ~(linked & (often[:-1] > often[1:]))
        second = np.flatnonzero(linked & keep[:-1] & keep[1:]) + 1  # as frequent as the one before
        if len(second):
            run = np.ones(len(second), bool)
            run[1:] = second[1:] - second[:-1] > 1
            begin = np.maximum.accumulate(np.where(run, second, 0))
            keep[second[(second - begin) % 2 == 0]] = False
        taken[index[keep]] = True
        still = ~keep
        still[:-1] &= ~(linked & keep[1:])
        still[1:] &= ~(linked & keep[:-1])
        still = np.flatnonzero(still)
        index, at, often = index[still], at[still], often[still]
    return np.flatnonzero(taken)


def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int, least: int = LEAST_USES):
    """Symbols, document ends in symbols, rules (left, right) and the lengths they expand to."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(symbols), bool)  # symbols at which a document ends
    last[ends[1:][np.diff(ends) > 0] - 1] = True
    rules, lengths = np.empty((0, 2), np.uint32), np.empty(0, np.int64)
    fresh = np.flatnonzero(~last[:-1])  # places of pairs that may have become frequent
    while len(fresh):
        keys, uses, hits, which = _frequent_pairs(symbols, fresh, least)
        if not len(keys):
            break
        picked = _apart(hits, uses.astype(np.int32)[which])
        hits, which = hits[picked], which[picked]
        done = np.bincount(which, minlength=len(keys)) > 0  # a pair may lose all its places to others
        new = np.column_stack([keys[done] >> np.uint64(32), keys[done] & np.uint64(0xFFFFFFFF)]).astype(np.uint32)
        number = (np.cumsum(done) - 1)[which]
        old = lambda s: np.where(s < first_rule, 1, lengths[np.maximum(s.astype(np.int64) - first_rule, 0)] if len(lengths) else 1)
        lengths_new = old(new[:, 0]) + old(new[:, 1])
        symbols[hits] = first_rule + len(rules) + number
        last[hits] |= last[hits + 1]
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        kept = np.flatnonzero(keep)
        # every pair that was frequent is gone: its places were replaced, or lost a symbol to an overlap.
        # A pair that is frequent now has a symbol of this round, so it begins at one or just before it
        at = hits - np.arange(len(hits))  # where the new symbols will be
        symbols, last = symbols[kept], last[kept]
        rules, lengths = np.concatenate([rules, new]), np.concatenate([lengths, lengths_new])
        near = np.zeros(len(symbols) + 1, bool)
        near[at], near[at - 1] = True, True  # at - 1 may be -1: the slot behind the last
        fresh = np.flatnonzero(near[:len(symbols) - 1] & ~last[:-1])
    doc_ends = np.zeros(len(ends), np.int64)
    stops = np.flatnonzero(last) + 1
    doc_ends[1:] = np.concatenate([[0], stops])[np.cumsum(np.diff(ends) > 0)]
    return symbols, doc_ends, rules, lengths


def write_payload(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, first_rule: int) -> bytes:
    symbols, doc_ends, rules, lengths = compress(ids, ends, first_rule)
    width = 2 if first_rule + len(rules) <= 1 << 16 else 4
    head = MAGIC + struct.pack("<5I", len(doc_ids), len(rules), len(symbols), first_rule, width)
    arrays = [np.array([x or 0 for x in doc_ids], "<i8"), np.array([x is None for x in doc_ids], "u1"),
              doc_ends.astype("<u4"), np.diff(ends).astype("<u4"), rules[:, 0].astype("<u4"), rules[:, 1].astype("<u4"),
              lengths.astype("<u4"), symbols.astype(f"<u{width}")]
    return head + b"".join(a.tobytes() for a in arrays)


class Shard:
    """A payload, decoded as asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a shard")
        docs, rules, symbols, self.first_rule, width = struct.unpack_from("<5I", payload, 4)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.nulls = take("<i8", docs), take("u1", docs).astype(bool)
        self.doc_ends, self.doc_lengths = take("<u4", docs + 1).astype(np.int64), take("<u4", docs).astype(np.int64)
        self.left, self.right, self.lengths = take("<u4", rules), take("<u4", rules), take("<u4", rules).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols)
        self._flat: np.ndarray | None = None

    def _expansions(self) -> None:
        """What every rule expands to. Rules refer to earlier ones, so they are filled in runs of
        rules that refer to none of their own run."""
        self._starts = np.cumsum(self.lengths) - self.lengths
        self._flat = np.empty(int(self.lengths.sum()), np.int32)
        parts = [x.astype(np.int64) - self.first_rule for x in (self.left, self.right)]
        refers = np.maximum(*parts)
        done = 0
        while done < len(refers):
            inner = np.flatnonzero(refers[done:] >= done)
            upto = done + int(inner[0]) if len(inner) else len(refers)
            to = self._starts[done:upto].copy()
            for part in parts:
                part = part[done:upto]
                rule = part >= 0
                n = np.where(rule, self.lengths[np.maximum(part, 0)], 1)
                self._flat[to[~rule]] = part[~rule] + self.first_rule
                self._flat[expand(to[rule], n[rule])] = self._flat[expand(self._starts[part[rule]], n[rule])]
                to += n
            done = upto

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        if self._flat is None:
            self._expansions()
            # ids expand to themselves: they stand before the rules in the table
            self._flat = np.concatenate([np.arange(self.first_rule, dtype=np.int32), self._flat])
            self._starts = np.concatenate([np.arange(self.first_rule), self._starts + self.first_rule])
            self._spans = np.concatenate([np.ones(self.first_rule, np.int64), self.lengths])
        return self._flat[expand(self._starts[symbols], self._spans[symbols])]

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids [start, stop) of the i-th document: only the symbols that cover them are expanded."""
        stop = int(self.doc_lengths[i]) if stop is None else min(stop, int(self.doc_lengths[i]))
        part = self.symbols[self.doc_ends[i]:self.doc_ends[i + 1]].astype(np.int64)
        n = np.where(part >= self.first_rule, self.lengths[np.maximum(part - self.first_rule, 0)] if len(self.lengths) else 1, 1)
        ends = np.cumsum(n)
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        before = int(ends[a - 1]) if a else 0
        return self._expand(part[a:b])[start - before:stop - before]


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 2, shard_ids: int = SHARD_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of all documents, written below the checkpoint folder and read back as a table."""
    model = Path(tokenizer_path).read_text(encoding="utf8")
    parsed = json.loads(model)
    first_rule = 1 + max([end_id, *parsed["model"]["vocab"].values(), *(t["id"] for t in parsed["added_tokens"])])
    added = [t["content"] for t in parsed["added_tokens"]]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo("bytes" + hashlib.md5(shared.value.encode()).hexdigest(), lambda: library_encoder(shared.value),
                           lambda encode: byte_level_joiner(shared.value, encode=encode), MEMO_UNITS)
        part = TaskContext.get().partitionId()
        seq, before, held, doc_ids, lengths = 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            nonlocal seq, before, held, doc_ids, lengths
            ids, ends = np.concatenate(held), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            row = {"part": part, "seq": seq, "first_doc": doc_ids[0], "n_docs": len(doc_ids), "n_ids": len(ids),
                   "ids_before": before, "payload": write_payload(doc_ids, ids, ends, first_rule)}
            out = pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("seq", pa.int32())] + [
                (n, pa.int64()) for n in ("first_doc", "n_docs", "n_ids", "ids_before")] + [("payload", pa.binary())]))
            seq, before, held, doc_ids, lengths = seq + 1, before + len(ids), [], [], []
            return out

        for batch in text_slices(batches, limit=2 << 20):
            ids, ends = encode_spaced(memo, batch.column("text"), added)
            ids = np.insert(ids, ends[1:], end_id)
            ends, names = ends + np.arange(len(ends)), batch.column("id").to_pylist()
            done, have = 0, sum(map(len, held))
            while done < len(names):
                # documents up to the one with which the shard has its ids
                upto = min(len(names), int(np.searchsorted(ends, ends[done] + shard_ids - have)))
                upto = max(upto, done + 1)
                held.append(ids[ends[done]:ends[upto]])
                lengths.extend(np.diff(ends[done:upto + 1]).tolist())
                doc_ids.extend(names[done:upto])
                have += int(ends[upto] - ends[done])
                done = upto
                if have >= shard_ids:
                    yield close()
                    have = 0
        if doc_ids:
            yield close()

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", "text"))
    return materialize(ordered.mapInArrow(run, SHARD_SCHEMA), "shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["payload"])
                ids = shard.ids().astype("<u4")
                n = shard.doc_lengths
                starts = np.cumsum(n) - n
                crc = [zlib.crc32(ids[a:a + k].tobytes()) for a, k in zip(starts, n)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), row["part"], np.int32)), pa.array(shard.doc_ids, mask=shard.nulls),
                    pa.array(starts + row["ids_before"]), pa.array(n), pa.array(crc, pa.int64())],
                    ["part", "doc_id", "in_part", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "ids_before", "payload").mapInArrow(run, "part int, doc_id long, in_part long, n_tokens long, ids_crc32 long")
    # one row a part: as many as the range partitioning has partitions, 12 bytes each
    parts = shards.groupBy("part").agg(F.min(F.struct("seq", "first_doc")).alias("first"), F.sum("n_ids").alias("n"))
    before = Window.orderBy(F.col("first.first_doc").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if bases.count() <= 1_000_000:
        bases = F.broadcast(bases)
    return docs.join(bases, "part").select("doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")
