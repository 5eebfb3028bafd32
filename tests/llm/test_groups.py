"""Operators 11, 12 and 13 against plain Python."""
import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskframe.llm import centroid_clustering, simhash_dedup, spelling_variants
from riskframe.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lloyd(rows, clusters, rounds, dims, seed=2):
    """vec_id, vector -> list of (vec_id, cluster, distance, cluster_inertia, inertia, sha256)."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cent = [v for _, v in order[:clusters]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        got = [min((square(v, c), j) for j, c in enumerate(cent)) for _, v in kept]
        if turn < rounds:
            for j in range(len(cent)):
                mine = [v for (_, v), (_, k) in zip(kept, got) if k == j]
                if mine:
                    cent[j] = [sum(x) // len(mine) for x in zip(*mine)]
    inertia = Counter()
    for d, j in got:
        inertia[j] += d
    return [(i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, cent[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, got)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("clusters,spread", [(12, 1.0), (12, 0.01), (1, 1.0), (500, 1.0)])
def test_clustering(spark, clusters, spread, monkeypatch):
    """Coarse vectors tie often; repeated rows, odd lengths and odd numbers are mixed in."""
    monkeypatch.setattr(centroid_clustering, "SLICE_ROWS", 64)
    rng = random.Random(clusters)
    rows = [(i, [round(rng.gauss(i % 7, 2)) * spread for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[i % 40][1]) for i in range(300, 360)] + [(5, rows[5][1]), (None, rows[3][1]), (400, None), (401, []), (402, [1.0] * 5),
             (403, [1.0] * 5 + [None]), (404, [float("nan")] + [0.0] * 5), (405, [float("inf")] + [0.0] * 5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("a", F.lit("x")).withColumn("cluster", F.lit(1)).repartition(5)
    got = centroid_clustering.cluster(table, dims=6, clusters=clusters, rounds=4).collect()
    assert ordered(got) == ordered(lloyd(rows, clusters, 4, 6))


def test_clustering_query_empty_and_large(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op11_centroid_clustering"](spark, SF)
    assert ordered(got.collect()) == ordered(lloyd(rows, 40, 5, 64))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert ordered(con.sql(ORACLE["op11_centroid_clustering"]).select(*got.columns).fetchall()) == ordered(got.collect())
    assert centroid_clustering.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    with pytest.raises(Exception, match="squared distances"):
        centroid_clustering.cluster(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>"), dims=2).count()


def test_nearest_is_exact_from_any_valid_bounds():
    rng = np.random.default_rng(3)
    v = rng.integers(-9, 9, (4000, 3))
    before, c = rng.integers(-9, 9, (2, 15, 3))
    old, new = centroid_clustering.Search.of(before), centroid_clustering.Search.of(c, before)
    n = len(v)
    state = centroid_clustering.nearest(old, v, np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, np.inf), np.full(n, -np.inf))
    for search in (new, centroid_clustering.Search.of(before, c)):
        state = centroid_clustering.nearest(search, v, *state)
        d = ((v[:, None] - search.centroids) ** 2).sum(axis=2)
        assert (state[0] == d.argmin(axis=1)).all()  # argmin takes the smaller number


def simhash(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, fps):
    near = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)) <= 2
    label = np.arange(len(ids))
    while True:
        least = np.where(near, label, len(ids)).min(axis=1)
        if (least == label).all():
            break
        label = least
    low = {}
    for i, k in zip(ids, label):
        low[k] = min(low.get(k, (2, 0)), (i is not None, i or 0))
    return [low[k][1] if low[k][0] else None for k in label]


@pytest.mark.parametrize("which", ["table", "odd"])
def test_simhash(spark, make_docs, odd_texts, which, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "WINDOW", 200)
    if which == "table":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
    else:
        base = [f"w{i}" for i in range(400)]
        near = [" ".join(base[:k] + ["other"] + base[k + 1:]) for k in range(0, 400, 17)]
        docs = make_docs(odd_texts + near + ["One two", "one TWO", "É b", "é b"]).withColumn("fp", F.lit(1)).withColumn("key", F.lit(2)).withColumn("label", F.lit(3))
    rows = docs.select("doc_id", "text").collect()
    fps = [simhash(r["text"]) for r in rows]
    want = {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_groups([r["doc_id"] for r in rows], fps))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_dedup.link_components(docs).collect()}
    assert got == want


def test_simhash_null_ids_repeats_and_empty_tables(make_docs):
    rows = simhash_dedup.link_components(make_docs(["a b c d", "a b c d", None, "", "  "], [None, 3, 9, 8, 8])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in rows) == [(0, None), (3, None), (8, 8), (8, 8), (9, 8)]
    assert simhash_dedup.link_components(make_docs([])).count() == 0


@pytest.mark.parametrize("hot", [1024, 4])
def test_links_of_dense_fingerprints(spark, hot):
    """Chains and balls of fingerprints, few bits apart; with a low bound most variants are hot."""
    rng = random.Random(hot)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):
        x = rng.getrandbits(64)
        high = x >> 32 << 32
        fps |= {x} | {x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
        fps |= {high | rng.getrandbits(32) for _ in range(60)} | {high ^ (1 << 40) | rng.getrandbits(32) for _ in range(20)}
        for _ in range(20):
            x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(x)
    fps = sorted(fps)
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    from riskframe.llm.components import components
    found = {r["vertex"]: r["label"] for r in components(simhash_dedup.linked(distinct, hot), "a", "b").collect()}
    got = [found.get(x, x) for x in signed]
    assert got == brute_groups(signed, fps)


def test_narrow_variants_share_what_two_segments_leave():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 200, np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    for a, b in zip(simhash_dedup._squeeze(x), simhash_dedup._squeeze(y)):
        assert (a == b).any() and a.max() < 1 << 56


def words_of(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def grouped(n):
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    out, form = {}, {}
    for w in n:
        near = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, ()) if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = len(near)
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], out[w], n.get(form[w])))
    return sorted(rows)


def got_rows(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


WORDS = ["letters", "leters", "lettters", "lettes", "setters", "strel", "stelr", "lerst", "aaaaa", "aaaaaa", "aaaab", "baaaa", "déjàvu", "dejàvu", "déjàvú", "ÀÉÎÕÜ", "àéîõü",
         "x" * 300, "x" * 299 + "y", "x" * 301, "×÷×÷×", "×÷×÷ø", "abcdefghij", "abcdefghji"]
CHAIN = ["banana", "bananb", "banxnb", "bayxnb"]


@pytest.mark.parametrize("cell,sample,letters", [(16384, 100_000, 1 << 25), (8, 100_000, 1 << 25), (8, 40, 1 << 25), (4, 1000, 64)])
def test_spelling_variants(make_docs, odd_texts, cell, sample, letters, monkeypatch):
    monkeypatch.setattr(spelling_variants, "LEAF", 2)
    monkeypatch.setattr(spelling_variants, "WINDOW", 50)
    monkeypatch.setattr(spelling_variants, "HELD", 100)
    rng = random.Random(cell)
    made = ["".join(rng.choices("abcé", k=rng.randrange(5, 8))) for _ in range(300)]
    texts = odd_texts + [" ".join(rng.choices(CHAIN + WORDS + made, weights=[300, 90, 30, 9] + [40] * len(WORDS) + [3] * 300, k=120)) for _ in range(40)]
    rows = list(enumerate(texts)) + [(None, "letters leters deltaecho " * 3), (7, texts[-1])]
    docs = make_docs([t for _, t in rows], [i for i, _ in rows]).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("cell", F.lit(1))
    want = grouped(words_of(rows))
    assert got_rows(spelling_variants.variants(docs, cell=cell, sample=sample, block_letters=letters)) == want
    assert any(r[2] != r[1] and r[1] for r in want) and any(r[4] for r in want)


def test_spelling_empty_tables(make_docs):
    assert spelling_variants.variants(make_docs([])).count() == 0
    assert spelling_variants.variants(make_docs([None, "", "a b c"])).count() == 0


def test_spelling_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got_rows(QUERIES["op13_spelling_variants"](spark, SF)) == grouped(words_of(rows))


def test_a_deleted_letter_is_counted_once_for_a_kind_of_run():
    total = Counter()
    text = " ".join(f"Word{chr(97 + i % 26)}{chr(97 + i // 26)} É{chr(97 + i % 26)}abc" for i in range(600)) * 2
    spelling_variants.add_words(total, 12, text.encode())
    want = Counter()
    for run in re.findall("[A-Za-zÀ-ÿ]+", text):
        run = run.translate(LOWER)
        h = zlib.crc32(f"12:{run}".encode())
        want[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    assert {w.decode(): n for w, n in total.items() if n} == want
