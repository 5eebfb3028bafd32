"""Operators 3, 4, 5 and 8 against their libraries, text by text."""
import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import byte_bpe, packing, repair_store, token_counts, units
from riskframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    byte, word = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {"rank": enc.encode_ordinary, "byte": lambda t: byte.encode(t, add_special_tokens=False).ids,
            "word": lambda t: word.encode(t, add_special_tokens=False).ids, "piece": piece.encode}


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def clashing(docs):
    return docs.withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(0.5)).withColumn("id", F.lit(1)).withColumn("length", F.lit(1))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("which", ["table", "odd"])
def test_byte_bpe(spark, make_docs, odd_texts, library, which):
    docs = documents(spark) if which == "table" else clashing(make_docs(odd_texts))
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(spark, docs, RANKS, PATTERN).collect()}
    for r in docs.collect():
        text = r["text"] or ""
        ids = library["rank"](text)
        row = got[r["doc_id"]]
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode()))
    assert len(got) == docs.count()


def test_offsets_and_split_characters(spark, make_docs, odd_texts):
    table = byte_bpe.byte_table(byte_bpe.tokenizer_json(RANKS, PATTERN))
    for r in byte_bpe.encode(make_docs(odd_texts), RANKS, PATTERN, offsets=True).collect():
        text = odd_texts[r["doc_id"]] or ""
        data, pieces = text.encode(), []
        begun = np.cumsum([(x & 0xC0) != 0x80 for x in data])
        for i, b, c in zip(r["ids"], r["byte_starts"], r["char_starts"]):
            piece = table[0][table[1][i]:table[1][i] + table[2][i]].tobytes()
            assert data[b:b + len(piece)] == piece
            assert c == begun[b] - 1  # the character that holds byte b
            pieces.append(piece)
        assert "".join(byte_bpe.decode_text(iter(pieces))) == text


@pytest.mark.parametrize("which", ["table", "odd"])
def test_packing(spark, make_docs, odd_texts, library, which):
    docs = documents(spark) if which == "table" else clashing(make_docs(odd_texts))
    size = 2048
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), block_rows=50).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for d in docs.collect():
        ids, at = library["word"](d["text"] or "") + [1], 0
        for r in sorted(by_doc[d["doc_id"]], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == crc(ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    used = padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        used += at
        padded += at if at & (at - 1) == 0 else size
    assert len({r["sequence_id"] for r in rows}) <= -(-used // size) + 2 or which == "odd"
    if which == "table":
        assert padded < 1.03 * used


def test_packing_writes_few_files(spark, make_docs):
    """One for each core, not one for each partition of the input or of a shuffle, with the same rows."""
    docs = make_docs([f"word{i} " * (i * 37 % 900) for i in range(400)])
    tokenizer, tasks = public_tokenizers.path("word_bpe_49k.json"), spark.sparkContext.defaultParallelism
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    expected = sorted(packing.pack(docs.coalesce(1), tokenizer).collect())
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = packing.pack(docs.repartition(50), tokenizer)
        assert len(out.inputFiles()) <= tasks and out.rdd.getNumPartitions() <= tasks
        assert sorted(out.collect()) == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_tokenizer_serves_both_encoders():
    text = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf8")
    tokenizer, words = units.load_tokenizer(text), ["Word", "Naïve,", "two words", "x1", "Ünit."]
    assert units.library_encoder(tokenizer)(words) == units.library_encoder(text)(words)
    assert [units.word_encoder(t, lower=True, spaced=False)(words, lambda w: None) for t in (tokenizer, text)] == [
        {w: ids for w, ids in zip(["Word", "Naïve", "Naïve,", "Ünit", "Ünit."], units.library_encoder(text)(["Word", "Naïve", "Naïve,", "Ünit", "Ünit."]))}] * 2


def test_packing_patterns_use_every_piece_once():
    counts = {2048: 3, 1500: 7, 700: 11, 548: 2, 300: 1, 20: 1000, 1: 5}
    patterns = packing.pack_histogram(counts, 2048)
    back = {}
    for packs, runs in patterns:
        assert sum(a * b for a, b in runs) <= 2048
        for length, times in runs:
            back[length] = back.get(length, 0) + packs * times
    assert back == counts
    places = packing.Places(patterns, 2048)
    seen = set()
    for length, n in counts.items():
        packs, offsets = places.find(np.full(n, length), np.arange(n))
        for p, o in zip(packs, offsets):
            span = {(p, o + k) for k in range(length)}
            assert not span & seen
            seen |= span
    assert packing.pack_histogram({}, 2048) == []


@pytest.mark.parametrize("which", ["table", "odd"])
def test_repair_store(spark, make_docs, odd_texts, library, which):
    docs = documents(spark) if which == "table" else clashing(make_docs(odd_texts))
    shards = repair_store.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), shard_ids=5000)
    got = {r["doc_id"]: r for r in repair_store.read_documents(shards).collect()}
    start = 0
    for d in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = library["byte"](d["text"] or "") + [2]
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == docs.count() and shards.count() > 1
    longest = max(len(library["byte"](d["text"] or "")) + 1 for d in docs.collect())
    assert all(r["n_ids"] < 5000 + longest for r in shards.collect())


def byte_memo(seen=None):
    """A memo as op5 has it; the units that the library gets are added to ``seen``."""
    model = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf8")
    encode, joined = units.library_encoder(model), units.byte_level_joiner(model)
    keep = (lambda us: seen.extend(us) or us) if seen is not None else (lambda us: us)
    return units.UnitMemo(lambda us: encode(keep(us)), joined=lambda us: joined(keep(us)))


def test_parts_of_units_are_encoded_once(library):
    """Words behind or before marks, digits and line feeds are no new units for the library."""
    words = ["alpha", "beta", "caf\u00e9", "d\u00e9j\u00e0"]
    texts = [f"x {a}{m}\n{b}-{c}42 ({a}) {b}{m}{m} {c}'s\n\n{a}" for a in words for b in words for c in words for m in ".!&"]
    seen = []
    ids, ends = units.encode_spaced(byte_memo(seen), pa.array(texts), ["<|endoftext|>"])
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library["byte"](t) for t in texts]
    assert len(seen) == len(set(seen)) < 40


def test_units_are_cut_only_where_the_pattern_ends(library):
    bits = [" ", " ", "\n", "\n\n", "\n\n\n", "\r\n", "\t", "'", "'s", "'re", "'ll", "don't", "'S", "a", "foo", "Bar", "\u00e9", "\u00c9", "\u00df", "\u00d7",
            "\u00f7", "\u00ff", "\u0301", "\u4e2d", "1", "42", "\u00b2", "\u0663", ".", ",", "!", "-", "\u2014", "\u201c", "(", "_", "<|endoftext|>", "<|", "|>",
            "\x00", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "\u180e", "\U0001f600", "\u00b5", "\x0b", "\x0c", "\x7f"]
    rng = random.Random(8)
    memo = byte_memo()
    for _ in range(40):
        some = rng.sample(bits, rng.randint(2, len(bits))) + [" ", "foo"]
        texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(60)] + [None, "", " ", "\n", "\n\n"]
        ids, ends = units.encode_spaced(memo, pa.array(texts, pa.string()), ["<|endoftext|>"])
        for t, a, b in zip(texts, ends, ends[1:]):
            assert ids[a:b].tolist() == library["byte"](t or ""), t


def test_overlapping_pairs_are_parted_by_use():
    def plain(hits, uses):
        left, taken = list(range(len(hits))), []
        while left:
            near = {i: [j for j in left if abs(hits[j] - hits[i]) == 1] for i in left}
            best = [i for i in left if all(uses[j] <= uses[i] for j in near[i])]
            now = []
            for i in best:
                if not now or hits[i] - hits[now[-1]] != 1:
                    now.append(i)
            taken += now
            left = [i for i in left if i not in now and not set(near[i]) & set(now)]
        return sorted(taken)

    rng = np.random.default_rng(9)
    for n in [0, 1, *rng.integers(2, 60, 200)]:
        hits = np.flatnonzero(rng.random(n) < 0.8)
        uses = rng.integers(1, 4, len(hits))
        assert repair_store._apart(hits, uses).tolist() == plain(hits, uses)


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(5)
    docs = [np.tile(rng.integers(0, 9, 7), 60), np.array([], int), np.full(501, 3), rng.integers(0, 50, 900), np.tile([1, 2], 300)]
    ids, ends = np.concatenate(docs).astype(np.int32), np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    payload = repair_store.write_payload([5, None, 7, 8, 9], ids, ends, 50)
    shard = repair_store.Shard(payload)
    assert shard.ids().tolist() == ids.tolist() and len(shard.symbols) < len(ids) // 2
    assert shard.nulls.tolist() == [False, True, False, False, False]
    for i, d in enumerate(docs):
        for a, b in ((0, None), (3, 20), (10, 11), (0, 1), (len(d), None)):
            assert shard.document(i, a, b).tolist() == d[a:b].tolist()


def grammars():
    rng = np.random.default_rng(6)
    copy = rng.integers(0, 4000, 3000)
    return {"one run": [np.full(1 << 17, 7)], "100 copies": [copy] * 100, "random": [rng.integers(0, 300, 40_000)],
            "words": [np.concatenate([[1, 2, 3], rng.integers(0, 40, 5), [1, 2, 3, 4]]) for _ in range(3000)], "two": [np.array([1, 1])], "none": [np.array([], int)]}


@pytest.mark.parametrize("name", list(grammars()))
def test_grammar_is_followed_to_its_end(name):
    """No pair is left with LEAST_USES uses that do not overlap, and everything decodes."""
    docs = grammars()[name]
    ids, ends = np.concatenate(docs).astype(np.int32), np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    symbols, doc_ends, rules, lengths = repair_store.compress(ids, ends, 5000)
    left = {}
    for a, b in zip(doc_ends[:-1], doc_ends[1:]):
        at = {}
        for i, pair in enumerate(zip(symbols[a:b], symbols[a + 1:b])):
            if at.get(pair, -2) < i - 1:  # not over the last one counted
                left[pair] = left.get(pair, 0) + 1
                at[pair] = i
    assert max(left.values(), default=0) < repair_store.LEAST_USES
    if name == "one run":
        assert len(symbols) <= 8 and lengths.max() >= 1 << 14
    if name == "100 copies":
        assert len(symbols) <= 150
    shard = repair_store.Shard(repair_store.write_payload(list(range(len(docs))), ids, ends, 5000))
    assert shard.ids().tolist() == ids.tolist()
    for i in range(0, len(docs), 37):
        n = len(docs[i])
        for a, b in ((0, None), (n // 3, n // 2), (max(n - 1, 0), n)):
            assert shard.document(i, a, b).tolist() == docs[i][a:b].tolist()


def test_symbols_grow_wider_when_sixteen_bits_run_out():
    rng = np.random.default_rng(7)
    ids = np.tile(rng.integers(0, 60_000, 9000), 9).astype(np.int32)
    payload = repair_store.write_payload([1], ids, np.array([0, len(ids)]), 65_000)
    assert repair_store.Shard(payload).symbols.dtype.itemsize == 4
    assert repair_store.Shard(payload).ids().tolist() == ids.tolist()


@pytest.mark.parametrize("which", ["table", "odd"])
def test_token_counts(spark, make_docs, odd_texts, library, which):
    docs = documents(spark) if which == "table" else clashing(make_docs(odd_texts))
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    for d in docs.collect():
        text = d["text"] or ""
        assert (got[d["doc_id"]]["n_bytes"], got[d["doc_id"]]["n_tokens"]) == (len(text.encode()), len(library["piece"](text)))


def test_empty_tables(spark, make_docs):
    none = make_docs([])
    assert byte_bpe.round_trip(spark, none, RANKS, PATTERN).count() == 0
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert repair_store.read_documents(repair_store.write_shards(none, public_tokenizers.path("byte_bpe_50k.json"))).count() == 0
    assert token_counts.token_counts(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_queries(spark):
    n = documents(spark).count()
    out = QUERIES["op8_token_counts"](spark, SF)
    assert out.count() == n and dict(out.dtypes)["over_limit"] == "boolean"
    assert QUERIES["op5_repair_store"](spark, SF).count() == n
    assert QUERIES["op3_byte_bpe"](spark, SF).count() == n
    assert QUERIES["op4_packing"](spark, SF).select("doc_id").distinct().count() == n
