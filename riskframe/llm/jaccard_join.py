"""Operator 10: exact Jaccard self-join on word shingles by universe partition and pigeonhole.

Distinct sets are joined, copies of a set follow it. Set sizes fall into bands. In a band, the
tokens of all sets are hashed into the same number of segments: if two sets link, they differ in at
most H tokens, so with more than H segments some segment of theirs is the same. The last segment is
a wide one with a one-deletion neighbourhood: its subset of tokens is indexed whole and with each
token left out, so it tolerates one difference and counts twice. A few segments more than H + 1 are
kept as spare weight. A set is indexed in its own band and looks into the next lower band if sets
it may link with lie there.

1. Every set's (key, set) rows are packed by key range and shuffled once. Each key held by several
   sets gives one candidate per set: with the smallest set of the key. Slices of the input do the
   same before the shuffle, so a key that very many sets share sends one row a slice.
2. Candidates pass a filter on sizes and parity sketches (the sketches' difference can't exceed the
   sets'), the rest is verified on the words of the whole texts, and links are joined to components.
3. Keys whose sets lie in one component are settled. For the others, each set gets a cost by key:
   the sets of other components behind it. It may leave out as many keys as it has weight to spare
   above its own H + 1, and leaves out the costliest (cost-based allocation). The rest is compared
   in blocks of bounded size, again only across components, and verified.

So no pair that links can be missed, and pairs inside a group are not enumerated. Shingles have 64-bit
hashes in keys, sizes and sketches; whether a pair links is decided on the words themselves. Sets are
named by 64-bit hashes that are checked against a second hash (other hashes are taken if two sets
share one).

Words of a shingle and threshold are a :class:`Rule`; op10 takes CONTRACT, the pipeline its own.

Results: words as the contract says; null or wordless text has an empty set, no links, and is its own
component. Repeated rows have equal sets and link. A null id is below all others. An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import hash_bitmap, in_bitmap, materialize, shielded, spaceless, text_slices
from riskframe.llm.components import components

BAND_RATIO, SPARE = 1.5, 2
BLOCK_SETS = 2048
SKETCH_BITS = 4
BUCKETS_PER_PARTITION = 4
SLICE = 1 << 20
#: words of a folded sketch, asking rows and pairs looked at at once
FOLD_WORDS, ASK_ROWS, PAIR_ROWS = 128, 512, 1 << 15
U = np.uint64


def _band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_RATIO)))
    return np.array(starts, np.int64)


#: smallest and largest size of every band
STARTS = _band_starts()
LARGEST = np.append(STARTS[1:] - 1, STARTS[-1] * 2)


@dataclass(frozen=True)
class Rule:
    """Sets of shingles of ``words`` words link at a Jaccard similarity of at least num / den. Sets look
    no further than the next lower band, so num / den is at least 1 / BAND_RATIO."""

    words: int
    num: int
    den: int

    def __post_init__(self) -> None:
        if self.words < 1 or not self.den <= BAND_RATIO * self.num <= BAND_RATIO * self.den:
            raise ValueError("a shingle has at least one word, and the similarity is from 1 / BAND_RATIO to 1")

    @property
    def loss(self) -> int:
        return self.den - self.num

    @cached_property
    def differ(self) -> np.ndarray:
        """Largest difference of a linked pair whose smaller set is in the band."""
        return self.loss * LARGEST // self.num

    @cached_property
    def plain(self) -> np.ndarray:
        """Segments but the wide one, which counts as two."""
        return self.differ + 1 + SPARE + self.differ // 16 - 2


#: the rule of op10's contract
CONTRACT = Rule(4, 85, 100)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def shingle_sets(texts: pa.Array, salt: int, rule: Rule = CONTRACT) -> list[np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    coded = pc.list_flatten(words).dictionary_encode()
    names = spaceless(coded.dictionary)
    codes = coded.indices.to_numpy().astype(np.int64)
    if "" in names:  # white space at the ends
        real = codes != names.index("")
        codes, doc = codes[real], doc[real]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, salt) for w in names), U, len(names))[codes]
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])

    def join(parts: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(parts[0]), U(len(parts)))
        for p in parts:
            out = mix(out + p)
        return out

    n = len(hashes) - rule.words + 1
    full = join([hashes[k:k + n] for k in range(rule.words)]) if n > 0 else hashes[:0]
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= rule.words:
            out.append(np.unique(full[a:b - rule.words + 1]))
        else:
            out.append(join([hashes[i:i + 1] for i in range(a, b)]) if b > a else hashes[:0])
    return out


def set_id(tokens: np.ndarray, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed) - (1 << 63)


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each of 64, 128, ... bits: at least SKETCH_BITS a token."""
    bits = 64
    while bits < SKETCH_BITS * len(tokens):
        bits *= 2
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """At most the number of tokens in which the sets differ."""
    x, y = sorted((np.frombuffer(a, U), np.frombuffer(b, U)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(n: int, m: int, a: bytes, b: bytes, rule: Rule = CONTRACT) -> bool:
    """False only for pairs that can't link. A difference d leaves (n + m - d) / 2 common tokens."""
    if rule.num * max(n, m) > rule.den * min(n, m):
        return False
    return sketch_distance(a, b) * (rule.den + rule.num) <= rule.loss * (n + m)


def keys_of(sets: list[np.ndarray], rule: Rule = CONTRACT) -> dict[str, np.ndarray]:
    """Index and probe keys of many sets: key, row of the set, own (its own band, so indexed),
    item (what may be left out as one: a plain segment, or the deletions; -1: nothing),
    spare (weight that may be left out in this band)."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    tokens = np.concatenate(sets) if sets else np.empty(0, U)
    owner = np.repeat(np.arange(len(sets)), sizes)
    band = np.searchsorted(STARTS, sizes, side="right") - 1
    least = -(-rule.num * sizes // rule.den)
    found: list[tuple[np.ndarray, ...]] = []
    for lower in (0, 1):
        target = band - lower
        use = (sizes > 0) & (target >= 0) & ((least < STARTS[np.maximum(band, 0)]) if lower else True)
        use &= rule.differ[np.maximum(target, 0)] > 0  # else only equal sets link
        rows = np.flatnonzero(use)
        if not len(rows):
            continue
        t, plain = target[rows], rule.plain[target[rows]]
        first = np.concatenate([[0], np.cumsum(plain + 1)])
        place = np.full(len(sets), -1)
        place[rows] = np.arange(len(rows))
        at = place[owner]
        token, at = tokens[at >= 0], at[at >= 0]
        shares = (plain[at] + 2).astype(U)
        part = np.minimum(((mix(token ^ U(0x5851F42D4C957F2D)) >> U(32)) * shares >> U(32)).astype(np.int64), plain[at])
        value = mix(token + U(0x14057B7EF767814F))
        sums = np.zeros(first[-1], U)
        np.add.at(sums, first[at] + part, value)
        segment = np.arange(first[-1]) - np.repeat(first[:-1], plain + 1)
        tag = mix((np.repeat(t, plain + 1) << 32 | np.where(segment == np.repeat(plain, plain + 1), 0xFFFFFFFF, segment)).astype(U))
        wide = part == plain[at]
        gone = (first[at] + part)[wide]
        size = sizes[rows]
        spare = plain + 2 - (rule.loss * (size + np.minimum(size, LARGEST[t])) // (rule.den + rule.num) + 1)
        whole_item = np.where(segment == np.repeat(plain, plain + 1), -1, segment)
        row_of = np.concatenate([np.repeat(rows, plain + 1), rows[at[wide]]])
        found.append((np.concatenate([mix(sums + tag), mix(sums[gone] - value[wide] + tag[gone])]), row_of,
                      np.full(len(row_of), not lower), np.concatenate([whole_item, plain[at[wide]]]),
                      np.concatenate([np.repeat(spare, plain + 1), spare[at[wide]]])))
    if not found:
        return {"key": np.empty(0, U), "row": np.empty(0, np.int64), "own": np.empty(0, bool), "item": np.empty(0, np.int64), "spare": np.empty(0, np.int64)}
    return dict(zip(("key", "row", "own", "item", "spare"), map(np.concatenate, zip(*found))))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def set_table(source: DataFrame, salt: int, rule: Rule) -> DataFrame:
    """(doc_id, n_shingles, sid, proof, sketch) of every row; sid is null for the empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            sets = shingle_sets(batch.column("text"), salt, rule)
            full = [len(s) > 0 for s in sets]
            pick = lambda f: [f(s) if k else None for s, k in zip(sets, full)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(pick(lambda s: set_id(s, 1)), pa.int64()),
                pa.array(pick(lambda s: set_id(s, 2)), pa.int64()), pa.array(pick(sketch), pa.binary())], ["doc_id", "n_shingles", "sid", "proof", "sketch"])

    return source.mapInArrow(run, "doc_id long, n_shingles long, sid long, proof long, sketch binary")


def _distinct(batch: pa.RecordBatch, salt: int, rule: Rule) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct non-empty sets of a slice, and their ids."""
    seen = {set_id(s, 1): s for s in shingle_sets(batch.column("text"), salt, rule) if len(s)}
    return list(seen.values()), np.fromiter(seen, np.int64, len(seen))


def _stars(keys: np.ndarray, sids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of (key, set) rows: key, set and smallest set for all but the smallest set of each key; then
    the keys and their smallest sets."""
    order = np.lexsort((sids, keys))
    keys, sids = keys[order], sids[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    head = sids[new][np.cumsum(new) - 1] if len(keys) else sids
    other = head != sids
    return keys[other], sids[other], head[other], keys[new], sids[new]


def star_table(source: DataFrame, salt: int, rule: Rule) -> DataFrame:
    """(key, sid, pivot): every set that shares a key, with the key's smallest set."""
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * BUCKETS_PER_PARTITION
    shape = "bucket long, keys binary, sids binary, pivots binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in text_slices(batches, limit=SLICE):
            sets, ids = _distinct(batch, salt, rule)
            found = keys_of(sets, rule)
            key, sid, pivot, lone_key, lone_sid = _stars(found["key"], ids[found["row"]])
            turn += 1
            rows = []
            if len(key):  # settled here: spread over the buckets, in no order that matters
                rows.append((-1 - int(key[0] % U(buckets)), key.tobytes(), sid.tobytes(), pivot.tobytes()))
            bucket = ((lone_key >> U(32)) * U(buckets) >> U(32)).astype(np.int64)  # ascending, as the keys are
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(bucket)]) if len(bucket) else ():
                rows.append((int(bucket[a]), lone_key[a:b].tobytes(), lone_sid[a:b].tobytes(), None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 3))], ["bucket", "keys", "sids", "pivots"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, sid, pivot) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(sid), pa.array(pivot)], ["key", "sid", "pivot"])

        now, keys, sids = None, [], []
        for batch in batches:
            for bucket, k, s, p in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket < 0:
                    yield out(np.frombuffer(k, U), np.frombuffer(s, np.int64), np.frombuffer(p, np.int64))
                    continue
                if bucket != now and keys:
                    yield out(*_stars(np.concatenate(keys), np.concatenate(sids))[:3])
                    keys, sids = [], []
                now = bucket
                keys.append(np.frombuffer(k, U))
                sids.append(np.frombuffer(s, np.int64))
        if keys:
            yield out(*_stars(np.concatenate(keys), np.concatenate(sids))[:3])

    packed = source.mapInArrow(pack, shape).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return packed.mapInArrow(meet, "key long, sid long, pivot long")


def filtered(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(
        f"{rule.num} * greatest(n_a, n_b) <= {rule.den} * least(n_a, n_b)").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_link(*x, rule) for x in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return near.mapInArrow(run, "a long, b long")


def exact_common(a: bytes, b: bytes, words: int) -> tuple[int, int, int]:
    """Shingles of two normalised texts, and those that both have, by their words: each word has a
    number of its own in the pair, and a shingle is named by numbering its parts step by step."""
    number: dict[bytes, int] = {}
    texts = [np.fromiter((number.setdefault(w, len(number)) for w in t.split()), np.int64) for t in (a, b)]
    span = [min(words, len(t)) for t in texts]  # a text with fewer words is one shorter sequence
    code = list(texts)
    for k in range(1, max(span)):
        code = [c[:-1] * len(number) + t[k:] if s > k else c for c, t, s in zip(code, texts, span)]
        names = np.unique(np.concatenate(code), return_inverse=True)[1]
        code = [names[:len(code[0])], names[len(code[0]):]]
    x, y = (np.unique(c) for c in code)
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)) if span[0] == span[1] else 0


def verified(pairs: DataFrame, sets: DataFrame, source: DataFrame, salt: int, rule: Rule) -> DataFrame:
    """The pairs whose whole sets link, by their words. Only texts that a pair names are sent."""
    named = materialize(pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
                        .join(sets.select("sid", "rep"), "sid"), "named")
    lowest = -(1 << 63)
    bitmap = source.sparkSession.sparkContext.broadcast(
        hash_bitmap(named.select(F.coalesce("rep", F.lit(lowest)).alias("rep")), "rep", named.count()))  # 8 MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in text_slices(batches, limit=SLICE):
            ids = pc.fill_null(whole.column("doc_id"), lowest).to_numpy()
            batch = whole.filter(pa.array(in_bitmap(bitmap.value, ids)))
            if batch.num_rows:
                sids, texts = [], []
                for text, tokens in zip(batch.column("text").cast(pa.binary()), shingle_sets(batch.column("text"), salt, rule)):
                    if len(tokens):
                        sids.append(set_id(tokens, 1))
                        texts.append(b" ".join(text.as_py().lower().split()))
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(texts, pa.binary())], ["sid", "words"])

    texts = materialize(source.mapInArrow(run, "sid long, words binary").join(named.select("sid"), "sid").dropDuplicates(["sid"]), "words")
    side = lambda x: texts.select(F.col("sid").alias(x), F.col("words").alias(f"t_{x}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                n, m, common = exact_common(x.as_py(), y.as_py(), rule.words)
                keep.append(rule.den * common >= rule.num * (n + m - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "t_a", "t_b").mapInArrow(compare, "a long, b long")


def live_keys(source: DataFrame, open_keys: DataFrame, salt: int, rule: Rule) -> DataFrame:
    """(key, sid, own, item, spare) of all sets, for the given keys only."""
    bitmap = source.sparkSession.sparkContext.broadcast(hash_bitmap(open_keys, "key", open_keys.count()))  # 8 MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            sets, ids = _distinct(batch, salt, rule)
            found = keys_of(sets, rule)
            hit = in_bitmap(bitmap.value, found["key"])
            if hit.any():
                x = {k: v[hit] for k, v in found.items()}
                yield pa.RecordBatch.from_arrays([pa.array(x["key"].view(np.int64)), pa.array(ids[x["row"]]), pa.array(x["own"]),
                                                  pa.array(x["item"].astype(np.int32)), pa.array(x["spare"].astype(np.int32))], ["key", "sid", "own", "item", "spare"])

    rows = source.mapInArrow(run, "key long, sid long, own boolean, item int, spare int")
    return rows.join(open_keys, "key").distinct()


def across(live: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Candidates (a, b) of different components over unsettled keys, after cost-based allocation.
    ``live`` has the component of every set as label."""
    counts = live.where("own").groupBy("key", "label").agg(F.count(F.lit(1)).alias("inside"))
    totals = counts.groupBy("key").agg(F.sum("inside").alias("all"))
    priced = (live.join(totals, "key").join(counts, ["key", "label"], "left")
              .withColumn("cost", F.col("all") - F.coalesce("inside", F.lit(0))).where("cost > 0"))
    items = priced.groupBy("sid", "own", "item", "spare").agg(F.sum("cost").alias("item_cost"))
    order = Window.partitionBy("sid", "own").orderBy((F.col("item") >= 0).desc(), F.col("item_cost").desc(), "item")
    left_out = items.withColumn("rank", F.row_number().over(order)).where("item >= 0 and rank <= spare").select("sid", "own", "item")
    probes = materialize(priced.join(left_out, ["sid", "own", "item"], "left_anti").select("key", "sid", "label", "all"), "probes")
    asked = probes.groupBy("key").agg(F.max("all").alias("all"))
    blocks = F.ceil(F.col("all") / BLOCK_SETS).cast("int")
    cols = ["key", "block", "sid", "label", "asks"]
    members = (live.where("own").select("key", "sid", "label").distinct().join(asked, "key")
               .select("key", F.pmod(F.xxhash64("sid"), blocks).cast("int").alias("block"), "sid", "label", F.lit(False).alias("asks")))
    asking = probes.distinct().select("key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "sid", "label", F.lit(True).alias("asks"))
    rows = members.select(cols).union(asking.select(cols)).join(sets.select("sid", "n", "sketch"), "sid")
    # compared as they stream by, sorted: members of a key and block first, then who asks
    dealt = rows.repartition("key", "block").sortWithinPartitions("key", "block", "asks", "n", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, [], []
        for batch in batches:
            key, block, sid, label, n = (batch.column(c).to_numpy() for c in ("key", "block", "sid", "label", "n"))
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)]):
                if a == b:
                    continue
                if (key[a], block[a]) != at:
                    at, held, members = (key[a], block[a]), [], None
                if not asks[a]:
                    held.append((sid[a:b], label[a:b], n[a:b], _folded(batch.column("sketch").slice(a, b - a))))
                    continue
                if not held:
                    continue
                if members is None:
                    members = _members(held)
                for lo in range(int(a), int(b), ASK_ROWS):
                    hi = min(lo + ASK_ROWS, int(b))
                    out.append(_candidates(members, (sid[lo:hi], label[lo:hi], n[lo:hi], _folded(batch.column("sketch").slice(lo, hi - lo))), rule))
                if sum(map(len, out)) >= 50_000:
                    yield _pair_batch(out)
                    out = []
        if out:
            yield _pair_batch(out)

    return dealt.select("key", "block", "sid", "label", "asks", "n", "sketch").mapInArrow(run, "a long, b long").distinct()


def _pair_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, k].copy()) for k in (0, 1)], ["a", "b"])


def _fold(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[-1] > words:
        half = rows.shape[-1] // 2
        rows = rows[..., :half] ^ rows[..., half:]
    return rows


def _folded(sketches: pa.Array) -> np.ndarray:
    """Sketches as rows of as many words as the shortest has, FOLD_WORDS at most: folding can only
    bring two sketches closer, so no pair that links is ruled out by it."""
    size = pc.binary_length(sketches).to_numpy() // 8
    words = int(min(size.min(), FOLD_WORDS))
    out = np.empty((len(size), words), U)
    for w in np.unique(size):
        rows = np.flatnonzero(size == w)
        data = b"".join(sketches.take(pa.array(rows)).to_pylist())
        out[rows] = _fold(np.frombuffer(data, U).reshape(len(rows), -1), words)
    return out


def _members(held: list[tuple]) -> tuple[np.ndarray, ...]:
    words = min(h[3].shape[1] for h in held)
    return (*(np.concatenate([h[i] for h in held]) for i in range(3)), np.concatenate([_fold(h[3], words) for h in held]))


def _candidates(members: tuple[np.ndarray, ...], asking: tuple[np.ndarray, ...], rule: Rule) -> np.ndarray:
    """Pairs of different components whose sizes and sketches may link, smaller id first."""
    (ids, labels, sizes, bits), (sid, label, n, own) = members, asking
    fits = (labels != label[:, None]) & (rule.num * n[:, None] <= rule.den * sizes)
    fits &= (sizes < n[:, None]) | ((sizes == n[:, None]) & (ids < sid[:, None]))
    i, j = np.nonzero(fits)
    words = min(bits.shape[1], own.shape[1])
    bits, own = _fold(bits, words), _fold(own, words)
    near = [np.empty(0, np.int64)]
    for lo in range(0, len(i), PAIR_ROWS):  # bounded, however many sizes fit
        p, q = i[lo:lo + PAIR_ROWS], j[lo:lo + PAIR_ROWS]
        apart = np.bitwise_count(own[p] ^ bits[q]).sum(axis=1).astype(np.int64)
        near.append(lo + np.flatnonzero(apart * (rule.den + rule.num) <= rule.loss * (n[p] + sizes[q])))
    near = np.concatenate(near)
    a, b = sid[i[near]], ids[j[near]]
    return np.column_stack([np.minimum(a, b), np.maximum(a, b)])


def _labelled(rows: DataFrame, found: DataFrame, sid: str, label: str) -> DataFrame:
    names = found.select(F.col("vertex").alias(sid), F.col("label").alias("__label"))
    return rows.join(names, sid, "left").withColumn(label, F.coalesce("__label", F.col(sid))).drop("__label")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = CONTRACT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    source = _source(docs, id_col, text_col)
    for salt in range(8):
        rows = materialize(set_table(source, salt, rule), "sets")
        if rows.where("sid is not null").groupBy("sid").agg(F.min("proof").alias("p"), F.max("proof").alias("q")).where("p <> q").isEmpty():
            break
    else:
        raise RuntimeError("two sets share their hashes under every salt")
    sets = materialize(rows.where("sid is not null").groupBy("sid").agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("x"))
                       .select("sid", F.col("x.doc_id").alias("rep"), F.col("x.n_shingles").alias("n"), F.col("x.sketch").alias("sketch")), "distinct-sets")
    stars = materialize(star_table(source, salt, rule), "stars")
    pairs = materialize(stars.select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct(), "pairs")
    links = materialize(verified(materialize(filtered(pairs, sets, rule), "near"), sets, source, salt, rule), "first-links")
    found = materialize(components(links, "a", "b"), "components")

    unsettled = _labelled(_labelled(pairs, found, "a", "x"), found, "b", "y").where("x <> y").select("a", "b")
    open_keys = materialize(stars.join(unsettled, (F.col("pivot") == F.col("a")) & (F.col("sid") == F.col("b"))).select("key").distinct(), "open")
    if not open_keys.isEmpty():
        live = materialize(_labelled(live_keys(source, open_keys, salt, rule), found, "sid", "label"), "live")
        more = verified(materialize(across(live, sets, rule), "near"), sets, source, salt, rule)
        found = materialize(components(links.union(more), "a", "b"), "components")

    named = _labelled(sets.select("sid", "rep"), found, "sid", "label")
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    ids = named.join(least, "label").select("sid", "component_id")
    return rows.join(ids, "sid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """``docs`` with the smallest id of each component only; rows that repeat an id all stay, and all
    columns pass, whatever their names."""
    kept = link_components(docs, rule=rule).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    return shielded(docs, ["doc_id"], lambda rows: rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi"))
