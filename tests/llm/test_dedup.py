"""Operators 1, 9 and 10 against plain Python."""
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import exact_dedup, jaccard_join, line_dedup
from riskframe.llm.components import components
from riskframe.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def clash(docs):
    return docs.withColumn("hash", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("sid", F.lit(2)).withColumn("words", F.lit(3))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_lines(rows):
    """doc_id -> (n_lines, n_dropped, kept text), for unique ids."""
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.translate(LOWER).strip(" \t\n\x0b\x0c\r")
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            h = holders.get(line.translate(LOWER).strip(" \t\n\x0b\x0c\r"), ())
            if len(h) < 3 or max(h) == i:
                kept.append(line)
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


LONG = "A line that is long enough to count"
LINE_TEXTS = [None, "", f"{LONG}\nown", f"  {LONG.upper()}\t\n{LONG}\nmore", f"{LONG}", f"x\n{LONG}\n\nÉ{LONG}", f"É{LONG}", f"é{LONG}",
              "short\nshort", "short", "short", "n" * 19, "n" * 19, "n" * 19, "n" * 20, "n" * 20, " " + "n" * 20,
              "\n".join(["many repeated lines here, long"] * 300), "many repeated lines here, long", "MANY repeated lines here, long\r\nb"]


@pytest.mark.parametrize("which", ["table", "odd"])
def test_line_dedup(spark, make_docs, odd_texts, which):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if which == "table" else clash(make_docs(LINE_TEXTS + odd_texts))
    want = expected_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = line_dedup.digests(docs).collect()
    assert len(got) == len(want)
    for r in got:
        n, dropped, text = want[r["doc_id"]]
        assert (r["n_lines"], r["n_dropped"], r["kept_sha256"]) == (n, dropped, sha(text))
    assert any(r["n_dropped"] for r in got)


def test_line_dedup_keeps_columns_rows_and_null_ids(make_docs):
    texts = [f"{LONG}\na", f"{LONG}\nb", f"{LONG}\nc", f"{LONG}\nc", f"{LONG}\nd", None]
    docs = clash(make_docs(texts, [1, 2, 3, 3, None, None]))
    for name in ("__keep", "__doc", "__ver", "__version", "passed_1", "odd name.x"):
        docs = docs.withColumn(name, F.lit(name))
    out = line_dedup.deduplicate(docs)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    out = out.collect()
    assert {r["__keep"] for r in out} == {"__keep"}
    # the largest id keeps its line in both of its rows; the null id is below all others
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out) == [(0, ""), (0, "d"), (1, "a"), (2, "b"), (3, texts[2]), (3, texts[2])]
    assert {r["sid"] for r in out} == {2}
    assert line_dedup.digests(make_docs([])).count() == 0


def test_line_dedup_hot_key_is_spread(spark, make_docs):
    found = line_dedup.occurrences(make_docs([LONG] * 400))
    got = line_dedup.repeated_keys(found, blocks=16).collect()
    assert [r["last_doc"] for r in got] == [399]


def test_line_dedup_has_no_python(spark, make_docs):
    plan = line_dedup.digests(make_docs(LINE_TEXTS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|Cartesian", plan)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(make_docs, odd_texts, bits):
    """Three-bit fingerprints make nearly all chunks collide: identifiers are still verified."""
    rng = random.Random(4)
    long_text = " ".join(str(rng.random()) for _ in range(3000))
    texts = odd_texts + [long_text, long_text.upper(), long_text[:-1], long_text + "x", "Same", "sAME", "same", "É", "é", None, "", "q" * 200000]
    docs = clash(make_docs(texts))
    want = {}
    for i, t in enumerate(texts):
        want.setdefault((t or "").translate(LOWER), []).append(i)
    got = {r["doc_id"]: r for r in exact_dedup.groups(docs, bits).collect()}
    assert len(got) == len(texts)
    for t, ids in want.items():
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), i == max(ids), sha(t))


def test_exact_dedup_repeated_rows_and_null_ids(make_docs):
    rows = exact_dedup.groups(make_docs(["a", "a", "a", "b", "b"], [5, 5, 2, None, None])).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in rows) == [
        (0, None, 2, True), (0, None, 2, True), (2, 5, 3, False), (5, 5, 3, True), (5, 5, 3, True)]
    assert exact_dedup.groups(make_docs([])).count() == 0


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 300_000).astype(np.uint8).tobytes()
    for text in (b"", b"x", data, b"inserted" + data, b"a" * 500_000):
        parts = [c for _, c in exact_dedup.chunks(text, 64)]
        assert b"".join(parts) == text and all(len(c) <= exact_dedup.MOST_BYTES for c in parts)
    a, b = ({c for _, c in exact_dedup.chunks(x, 64)} for x in (data, b"inserted" + data))
    assert len(a & b) > 0.9 * len(a)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b, k = sets[j], len(a & sets[j])
            if a and b and 100 * k >= 85 * (len(a) + len(b) - k):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)}


def near_copies(seed):
    """Chains and stars of near copies around the threshold, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage, texts = [word() for _ in range(55)], []
    for size in (4, 7, 12, 25, 60, 160, 400):
        base = [word() for _ in range(size)]
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 3, 5, 8, 13):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy[:len(copy) - edits % 3 or None]))
            base = copy if edits == 1 else base
    for _ in range(25):
        texts.append(" ".join(passage + [word() for _ in range(rng.randrange(3, 60))]))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("which", ["made", "odd"])
def test_jaccard_components(make_docs, odd_texts, which, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    texts = near_copies(3) if which == "made" else odd_texts + ["One two three four", "one  TWO three\tfour", "one two", "ONE TWO", "É b c d", "é b c d"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link_components(clash(make_docs(texts))).collect()}
    assert got == brute_components(rows)


def test_linked_sets_share_a_key_that_allocation_keeps():
    """For random linked pairs, whichever keys the larger set leaves out within its spare weight, a
    key of the smaller one is met."""
    rng = np.random.default_rng(9)
    for _ in range(150):
        n = int(rng.integers(7, 500))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        gone = int(rng.integers(0, max(1, len(a) * 15 // 185 + 1)))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[gone:]], rng.integers(0, 1 << 62, gone).astype(np.uint64)]))
        big, small = (a, b) if len(a) >= len(b) else (b, a)
        common = len(np.intersect1d(big, small))
        if 100 * common < 85 * (len(big) + len(small) - common) or len(a) + len(b) == 2 * common:
            continue
        assert jaccard_join.may_link(len(a), len(b), jaccard_join.sketch(a), jaccard_join.sketch(b))
        k, s = jaccard_join.keys_of([big]), jaccard_join.keys_of([small])
        members = set(s["key"][s["own"]].tolist())
        met = 0
        for own in (True, False):
            mine = k["own"] == own
            items = {int(i) for i, key in zip(k["item"][mine], k["key"][mine]) if int(key) in members}
            if items and (-1 in items or len(items) > int(k["spare"][mine][0])):
                met += 1
        assert met


def test_jaccard_nulls_and_empty_tables(make_docs):
    assert jaccard_join.link_components(make_docs([])).count() == 0
    rows = jaccard_join.link_components(make_docs(["a b c d e", "a b c d e", "a b c d e", None, ""], [None, 4, 4, 7, 8])).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in rows) == [(-1, 2, None)] + [(4, 2, None)] * 2 + [(7, 0, 7), (8, 0, 8)]


def test_keep_one_passes_columns_of_any_name(make_docs):
    docs = make_docs(["a b c d e f", "a b c d e f", "x y z u v w", None], [4, 2, 9, None]).withColumn("__id", F.lit("mine")).withColumn("component_id", F.lit(1))
    out = jaccard_join.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["__id"]) for r in out.collect()) == [(0, "mine"), (2, "mine"), (9, "mine")]


@pytest.mark.parametrize("words", [1, 4, 5])
def test_pairs_are_compared_by_their_words(words):
    rng = random.Random(words)
    for _ in range(300):
        a = rng.choices("abcd", k=rng.randrange(1, 30))
        b = list(a) if rng.random() < 0.5 else rng.choices("abcd", k=rng.randrange(1, 30))
        if rng.random() < 0.5:
            b[rng.randrange(len(b))] = "e"
        sets = [{tuple(t[i:i + words]) for i in range(len(t) - words + 1)} if len(t) >= words else {tuple(t)} for t in (a, b)]
        got = jaccard_join.exact_common(" ".join(a).encode(), " ".join(b).encode(), words)
        assert got == (len(sets[0]), len(sets[1]), len(sets[0] & sets[1]))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["vertex"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


@pytest.mark.parametrize("name", ["op1_line_dedup", "op9_exact_dedup"])
def test_query_has_sql(name):
    assert name in ORACLE and name in QUERIES


def test_jaccard_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_jaccard_join"](spark, SF).collect()}
    assert got == brute_components(rows)
