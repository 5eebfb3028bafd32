"""The pipeline, stage by stage, against what plain Python makes of each stage's input."""
import pytest
from test_dedup import brute_components, expected_lines, near_copies

import __spark_entry__
import corpus_pipeline
from riskframe.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF), "stage")
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert list(steps) == ["quality classifier", "quality rules", "line dedup", "n-gram Jaccard join", "packing"]
    for name, (before, after) in steps.items():
        if name != "packing":
            assert after.columns == corpus_pipeline.COLUMNS
            assert dict(after.dtypes) == dict(before.dtypes)


def test_filters_pass_rows_untouched_and_keep_clean_documents(steps, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name in ("quality classifier", "quality rules"):
        before, after = map(rows, steps[name])
        assert all(before[i] == r for i, r in after.items())
        good = [i for i in before if labels.get(i) == 1]
        assert sum(i in after for i in good) >= 0.85 * len(good)


def test_lines(steps):
    before, after = map(rows, steps["line dedup"])
    want = expected_lines([(i, r["text"]) for i, r in before.items()])
    assert {i: r["text"] for i, r in after.items()} == {i: w[2] for i, w in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_one_document_of_each_group(steps):
    before, after = map(rows, steps["n-gram Jaccard join"])
    want = brute_components([(i, r["text"]) for i, r in before.items()])
    assert set(after) == {i for i, (_, c) in want.items() if i == c}
    assert all(before[i] == r for i, r in after.items())


def test_packing_covers_what_is_left(steps):
    before, after = steps["packing"]
    assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == set(rows(before))


def test_registered(spark):
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_near_copies_by_five_words(spark, make_docs):
    """Copies of 46 to 60 distinct words with one inner word replaced, and texts of many sizes, against
    all pairs at five words and 0.8; copies of 49 to 52 words link there only."""
    texts = [" ".join("changed" if k and i == n // 2 else f"t{n}w{i}" for i in range(n)) for n in range(46, 61) for k in (0, 1)]
    docs = make_docs(texts + near_copies(5) + ["one two three four", "one two three four", "a b c d e", "", None])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [brute_shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if k and 100 * k >= 80 * (len(a) + len(sets[j]) - k):
                root = [root[j] if x == root[i] else x for x in root]
    want = {min(j for j in range(len(rows)) if root[j] == root[i]) for i in range(len(rows))}
    got = {r["doc_id"] for r in corpus_pipeline.one_of_near_copies(spark, docs, SF).collect()}
    assert got == want
    contract = {i for i, (_, c) in brute_components(rows).items() if i == c}
    assert {2 * (n - 46) + 1 for n in range(49, 53)} <= contract - got


def brute_shingles(text, words=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}


def test_stages_drop_the_tables_of_the_stage_before(spark, make_docs):
    """Once a stage's result is written, the next stage drops what the first had written on its way; a
    result that is still read from such tables keeps them."""
    import os

    from riskframe.session import checkpoint_dir
    docs = make_docs([f"text number {i} of many with words enough {i % 7}" for i in range(60)])
    folder = checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {f for f in os.listdir(folder) if f.startswith(("lines-", "repeated-", "sets-"))}
    before = tables()
    lazy = corpus_pipeline.lines_once(spark, docs, SF)
    made = tables() - before
    assert made
    kept = materialize(lazy, "kept")
    out = corpus_pipeline.one_of_near_copies(spark, kept, SF)
    assert not made & tables()
    assert kept.count() == 60 and out.count() >= 1
    counted = corpus_pipeline.ruled(spark, docs, SF)  # read lazily by the next stage
    assert corpus_pipeline.lines_once(spark, counted, SF).count() == counted.count()
