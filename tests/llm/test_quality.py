"""Operators 2 and 7: counts against plain Python, the certificate, held-out accuracy, odd inputs."""
import re
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskframe.llm import cotrain, quality_rules
from riskframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    uses, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if uses[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


EXTRA = ["a b c d e f g h " * 3, "a b c d e f g h", "x " * 7, "x " * 8, "x " * 9, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9", "l\nl\n\n\n l\nl",
         "same words in two documents one after another", "same words in two documents one after another", "É é ## $%&|<> !"]


def test_counts(odd_texts):
    texts = odd_texts + EXTRA
    got = quality_rules.count_texts(pa.array(texts))
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counted(t), t
    assert all(len(v) == 0 for v in quality_rules.count_texts(pa.array([], pa.string())).values())
    assert quality_rules.count_texts(pa.array([None, ""], pa.string()))["n_words"].tolist() == [0, 0]


def test_query_over_documents(spark):
    rows = QUERIES["op2_quality_rules"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        c = counted(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == (c[0] < 20 or 100 * c[4] > 30 * c[0])
        assert not (r["base_failed"] and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert np.mean([r["kept"] for r in good]) >= 1 - quality_rules.ALPHA
    assert max(r["certified_steps"] for r in rows) > 0


@pytest.mark.parametrize("n,p", [(20, 0.3), (1000, 0.03), (5, 0.5)])
def test_binomial_tail(n, p):
    from math import comb
    for k in range(-1, n + 1):
        want = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert quality_rules.binomial_tail(299_000, 10_000_000, 0.03) == pytest.approx(0.0319, abs=0.002)


def test_certificate_limits_false_rejection():
    """Strata whose true rate is just too high are certified in at most delta of all draws."""
    rng, wrong = np.random.default_rng(3), 0
    for _ in range(400):
        hits = rng.binomial(500, quality_rules.ALPHA * 1.01)
        wrong += quality_rules.certified_steps([hits] + [0] * 7, 500, quality_rules.ALPHA, 0.05) > 0
    assert wrong <= 400 * 0.05 + 12
    assert quality_rules.certified_steps([0] * 8, 10, quality_rules.ALPHA, 0.05) == 0  # too few labels
    assert quality_rules.certified_steps([0, 0, 90] + [0] * 5, 500, quality_rules.ALPHA, 0.05) == 2


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rules_with_odd_rows(spark, make_docs, odd_texts):
    prose = " ".join(f"word{i % 37} and other{i % 53}" for i in range(40))
    noise = " ".join(f"wo$${i}###" for i in range(60))
    docs = make_docs([f"{prose} number{i}" for i in range(300)] + [noise] * 20 + odd_texts).withColumn("step", F.lit("x")).withColumn("stratum", F.lit("y")).withColumn("quality", F.lit(9))
    docs = docs.withColumn("__n_words", F.lit(3)).withColumn("__kept", F.lit(False)).withColumn("__text", F.lit("t")).withColumn("a.b", F.lit(1))
    labels = labels_of(spark, [(i, 1, 0) for i in range(300)] + [(10**9, 1, 0), (None, None, None), (3, 1, 0)])
    out = {r["doc_id"]: r for r in quality_rules.verdicts(docs, labels).collect()}
    assert len(out) == 320 + len(odd_texts)
    assert all(out[i]["kept"] for i in range(300)) and not any(out[i]["kept"] for i in range(300, 320))
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["kept"]}
    none = quality_rules.verdicts(make_docs([]), labels)
    assert none.count() == 0
    nobody = {r["doc_id"]: r for r in quality_rules.verdicts(docs, labels_of(spark, [])).collect()}
    assert all(r["kept"] != r["base_failed"] for r in nobody.values())
    mixed = make_docs([prose] * 2, lang=None)
    assert quality_rules.verdicts(mixed, labels).where("kept").count() == 2


def spark_hash(*values):
    """Spark's xxhash64 of ints (4 bytes), longs (8 bytes, given as np.int64) and strings."""
    h = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q" if isinstance(v, np.int64) else "<i", int(v))
            h = xxhash.xxh64_intdigest(data, h % 2**64)
    return h - 2**64 if h >= 2**63 else h


def plain_verdicts(rows, good):
    """doc_id -> kept, by the operator's words: rows are (doc_id, lang, text)."""
    c = quality_rules.count_texts(pa.array([t for _, _, t in rows], pa.string()))
    found = []
    for i, (doc, lang, text) in enumerate(rows):
        x = {k: int(v[i]) for k, v in c.items()}
        words, chars = max(x["n_words"], 1), max(x["word_chars"], 1)
        value = {"symbols_per_word": x["n_symbols"] / words, "bangs_per_word": x["n_bangs"] / words, "upper_share": x["n_upper"] / max(x["n_chars"], 1),
                 "word_length": x["word_chars"] / words, "short_words": words / chars, "dup_line_share": x["n_dup_lines"] / max(x["n_lines"], 1),
                 "repeated_share": x["n_repeat_words"] / words}
        steps = [next((t for t, cut in enumerate(cuts) if value[r] > cut), 8) for r, cuts in quality_rules.STEPS.items()]
        found.append((doc, lang, text, steps, x["n_words"] < 20 or 100 * x["n_repeat_words"] > 30 * x["n_words"]))
    strata = {}
    for doc, lang, text, steps, failed in found:
        if doc in good and not failed:
            strata.setdefault(lang, {})[text] = steps  # equal texts once
    allowed = {}
    for lang, texts in strata.items():
        choose, hold = [], []
        for text, steps in texts.items():
            (choose if spark_hash(np.int64(spark_hash(text))) % 4 == 0 else hold).append(steps)
        order = []
        while len(order) < 7 * 8:  # the cheapest next step of any rule
            at = [sum(r == i for r, _ in order) for i in range(7)]
            order.append(min(((sum(s[i] == at[i] for s in choose), at[i], i) for i in range(7) if at[i] < 8))[:0:-1])
        certified, lost = [0] * 7, set()
        for i, t in order:
            lost |= {k for k, s in enumerate(hold) if s[i] <= t}
            if not hold or quality_rules.binomial_tail(len(lost), len(hold), quality_rules.ALPHA) > quality_rules.DELTA / len(strata):
                break
            certified[i] += 1
        allowed[lang] = certified
    return {doc: not failed and all(s >= n for s, n in zip(steps, allowed.get(lang, [0] * 7))) for doc, lang, _, steps, failed in found}


@pytest.mark.parametrize("copies", [1, 5])
def test_verdicts_against_plain_python(spark, copies):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in docs.select("doc_id", "lang", "text").collect()]
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    extra, label_rows = [], [(i, 1, 0) for i in sorted(good)]
    for k in range(1, copies):  # copies of the labelled good documents: no new evidence
        extra += [(10**6 * k + i, lang, text) for i, lang, text in rows if i in good]
        label_rows += [(10**6 * k + i, 1, 0) for i in sorted(good)]
    table = spark.createDataFrame(rows + extra, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.verdicts(table, labels_of(spark, label_rows)).collect()}
    want = plain_verdicts(rows + extra, {i for i, _, _ in label_rows})
    assert got == want
    if copies > 1:
        assert {i: v for i, v in got.items() if i < 10**6} == plain_verdicts(rows, good)


def test_classifier_held_out_accuracy(spark):
    """Labels of every third document are hidden from training and used to measure."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    shown, hidden = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = cotrain.classify(docs, shown).join(hidden, "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.kept.mean() >= 0.98 and (~bad.kept).mean() >= 0.9
    auc = np.mean(good.score.to_numpy()[:, None] > bad.score.to_numpy()[None, :])
    assert auc > 0.98


def plain_cotraining(rows, labels, settings):
    """Scores by doc_id of co-training in plain Python: rows are (doc_id, text, lang, source)."""
    content, meta = (x.astype(float) for x in cotrain.features(*(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2, 3))))
    ids = [np.int64(r[0]) for r in rows]
    share = Counter(labels.values())
    half = settings.labelled // 2
    below = lambda salt, i, n, most: n <= most or (spark_hash(salt, i) % 2**64) >> 1 < 2**63 * most // n
    drawn = {c: min(share[c], half) for c in (0, 1)}
    picked = [k for k, i in enumerate(ids) if i in labels and below(3, i, share[labels[i]], half)]
    held = [k for k in picked if spark_hash(7, ids[k]) % 1000 < int(1000 * settings.holdout)]
    start = [k for k in picked if k not in set(held)]
    y = np.array([labels.get(int(i), -1) for i in ids], float)
    weight = {c: sum(drawn.values()) / 2 / drawn[c] for c in (0, 1)}
    view = {"content": content, "meta": meta}
    train = {v: [(k, y[k], weight[int(y[k])]) for k in start] for v in view}

    def fit(v):
        at, labels_, w = (np.array(x) for x in zip(*train[v]))
        return cotrain.fit_small(view[v][at.astype(int)], labels_, settings.regularization * w.sum(), weight=w)

    models = {v: fit(v) for v in view}
    odds = lambda v: view[v] @ models[v][:-1] + models[v][-1]
    for r in range(settings.rounds):
        p = {v: 1 / (1 + np.exp(-odds(v))) for v in view}
        open_rows = [k for k, i in enumerate(ids) if int(i) not in labels]
        for v, other in (("content", "meta"), ("meta", "content")):
            for c in (0, 1):
                sure = [k for k in open_rows if (p[v][k] >= settings.confident if c == 0 else p[v][k] <= 1 - settings.confident)]
                train[other] += [(k, 1.0 - c, 0.5) for k in sure if below(11 + r, ids[k], len(sure), settings.pseudo)]
        models = {v: fit(v) for v in view}
    scale = {v: cotrain.fit_small(odds(v)[held][:, None], y[held]) for v in view}
    both = np.column_stack([odds(v) * scale[v][0] + scale[v][1] for v in view])
    last = cotrain.fit_small(both[held], y[held])
    score = 1 / (1 + np.exp(-(both @ last[:-1] + last[-1])))
    good = np.sort(score[[k for k in held if y[k] == 1]])
    return dict(zip(map(int, ids), score)), min(0.5, good[int(settings.lost_good * len(good))])


@pytest.mark.parametrize("settings", [cotrain.Settings(), cotrain.Settings(labelled=120, pseudo=40, rounds=3)])
def test_cotraining_against_plain_python(spark, settings):
    """The second settings draw samples of labels and pseudo-labels; the rarer class comes whole."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    want, cutoff = plain_cotraining(rows, known, settings)
    got = {r["doc_id"]: r for r in cotrain.classify(docs, labels, settings).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert r["score"] == pytest.approx(want[i], abs=1e-6)
        assert r["kept"] == (r["score"] >= cutoff) or abs(r["score"] - cutoff) < 1e-6


def test_sampling_of_very_many_rows(spark):
    """One in a hundred thousand million is still a share, not nothing."""
    rows = spark.range(200_000).withColumnRenamed("id", "doc_id")
    assert rows.where(cotrain._one_in(200_000, 2_000, 3)).count() == pytest.approx(2_000, rel=0.1)
    share = cotrain._one_in(10**14, 10**10, 3)  # one in 10,000
    assert 5 <= rows.where(share).count() <= 50


def test_features_and_small_fit(odd_texts):
    content, meta = cotrain.features(pa.array(odd_texts), pa.array([None, "en"] * (len(odd_texts) // 2)), pa.array([None] * len(odd_texts), pa.string()))
    assert content.shape == (len(odd_texts), cotrain.TEXT_DIM) and meta.shape == (len(odd_texts), cotrain.META_DIM)
    assert np.isfinite(content).all() and np.isfinite(meta).all() and not content[:2, :-1].any()
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.5 * x[:, 1] + 0.3)))).astype(float)
    assert cotrain.fit_small(x, y) == pytest.approx([1.5, -0.5, 0.3], abs=0.2)
    separable = cotrain.fit_small(x[:, :1], (x[:, 0] > 0).astype(float))
    assert np.isfinite(separable).all()


def test_classifier_with_odd_rows(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts).withColumn("content", F.lit("x")).withColumn("score", F.lit(1)).withColumn("y", F.lit(2))
    one_class = labels_of(spark, [(0, 1, 0), (1, 1, 0), (2, None, None), (3, 0, 0), (3, 1, 0)])
    out = cotrain.classify(docs, one_class).collect()
    assert len(out) == len(odd_texts) and all(r["kept"] and r["score"] == 1.0 for r in out)
    assert all(r["kept"] for r in cotrain.classify(docs, labels_of(spark, [])).collect())
    few = labels_of(spark, [(i, i % 2, 0) for i in range(8)])
    docs = docs.withColumn("meta", F.lit(1)).withColumn("__one", F.lit(2)).withColumn("passed_0", F.lit(3))
    kept = cotrain.keep_good(docs, few)
    assert kept.columns == docs.columns and kept.count() <= len(odd_texts)
    assert cotrain.classify(make_docs([]), few).count() == 0


def test_a_rule_that_is_wrong_for_a_language_holds_up_no_other(spark, make_docs):
    """Good documents whose words are all long (phrases without spaces): symbol junk still goes."""
    phrases = ["".join(chr(0x4E00 + (i * 31 + j * 7) % 2000) for j in range(30)) for i in range(300)]
    good = [" ".join(phrases[(i * 7 + j) % 300] for j in range(25)) for i in range(400)]
    junk = [" ".join(f"{phrases[i]}$$$###" for i in range(k, k + 30)) for k in range(20)]
    docs = make_docs(good + junk, lang="zh")
    out = {r["doc_id"]: r for r in quality_rules.verdicts(docs, labels_of(spark, [(i, 1, 0) for i in range(400)])).collect()}
    assert all(out[i]["kept"] for i in range(400))
    assert not any(out[i]["base_failed"] or out[i]["kept"] for i in range(400, 420))


def test_order_puts_costly_steps_last_and_keeps_each_rule_in_order():
    costs = [[0] * 8 for _ in quality_rules.RULES]
    costs[3], costs[5] = [90] + [0] * 7, [0, 0, 0, 2, 0, 0, 0, 0]
    place = np.array(quality_rules.step_order(costs)).reshape(len(costs), 8)
    assert sorted(place.ravel()) == list(range(56)) and (np.diff(place, axis=1) > 0).all()
    assert place[3].min() == 48 and place[5][3] == 43
