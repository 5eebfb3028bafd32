
from riskframe.operators import runs

RUNS = [  # run_id, status, family, technique, f1, auc, cost, fit
    ("a", "FINISHED", "xgboost", "none", 0.726, 0.801, 0.863, 93.0),
    ("b", "FINISHED", "decision_tree", "none", 0.720, 0.784, 0.861, 27.0),
    ("c", "FINISHED", "random_forest", "none", 0.722, 0.796, 0.874, 334.0),
    ("d", "FINISHED", "xgboost", "pca", 0.713, 0.786, None, 124.0),
    ("e", "FINISHED", "dummy", "none", 0.496, 0.499, 2.5, 1.0),
    ("f", "FAILED", "logistic_regression", "none", 0.9, 0.9, 0.1, 1.0),
    ("g", "FINISHED", "logistic_regression", "pca", None, 0.775, 0.929, 15.0),
]
SCHEMA = ("run_id string, status string, model_family string, dim_technique string, f1 double, "
          "roc_auc double, expected_cost double, fit_seconds double")


def _minmax(v):
    lo, hi = min(v), max(v)
    return [0.5] * len(v) if hi == lo else [(x - lo) / (hi - lo) for x in v]


def test_composite_score_matches_formula(spark):
    df = spark.createDataFrame(RUNS, SCHEMA)
    got = {r["run_id"]: r["score"] for r in runs.composite_score(df).collect()}
    keep = [r for r in RUNS if r[1] == "FINISHED" and r[2] != "dummy" and r[4] is not None]
    f1 = [r[4] for r in keep]
    cost = [r[6] if r[6] is not None else max(f1) for r in keep]
    fit = [r[7] for r in keep]
    want = [0.6 * a + 0.25 * (1 - b) + 0.15 * (1 - c)
            for a, b, c in zip(_minmax(f1), _minmax(cost), _minmax(fit))]
    assert set(got) == {r[0] for r in keep}
    for r, w in zip(keep, want):
        assert abs(got[r[0]] - w) < 1e-12
    win = runs.winner(runs.composite_score(df)).first()
    assert win["run_id"] == max(zip(want, [r[5] for r in keep], [r[0] for r in keep]))[2]


def test_pivot_delta_and_cv(spark):
    df = spark.createDataFrame(RUNS, SCHEMA)
    piv = {r["model_family"]: r for r in runs.f1_pivot(runs.finished(df)).collect()}
    assert piv["xgboost"]["none"] == 0.726 and piv["xgboost"]["pca"] == 0.713
    d = {r["run_id"]: r["delta_f1"] for r in runs.delta_vs_raw(runs.finished(df)).collect()}
    assert abs(d["d"] - (0.713 - 0.726)) < 1e-12
    folds = spark.createDataFrame([("a", 0.5), ("a", 0.7)], "run_id string, score double")
    cv = runs.cv_summary(folds).first()
    assert abs(cv["cv_mean"] - 0.6) < 1e-12 and abs(cv["cv_std"] - 0.1) < 1e-12


def test_registry_register_and_resolve(spark):
    ev = runs.register_winner(spark, None, "m", "r1")
    ev = ev.unionByName(runs.register_winner(spark, ev, "m", "r2"))
    state = {r["version"]: r["stage"] for r in runs.registry_state(ev).collect()}
    assert state == {1: "Archived", 2: "Production"}
    assert runs.resolve_version(ev, "m").first()["version"] == 2
    assert runs.resolve_version(ev, "m", "Staging").first()["version"] == 2   # fallback: highest


def test_stringify_params():
    assert runs.stringify_params({"a": 1, "b": None, "c": [1, 2]}) == {"a": "1", "b": "None",
                                                                        "c": "[1, 2]"}


def test_archived_version_keeps_its_run(spark):
    events = None
    for run in ("r1", "r2", "r3"):
        new = runs.register_winner(spark, events, "m", run)
        events = new if events is None else events.union(new)
    state = {r["version"]: (r["stage"], r["run_id"]) for r in runs.registry_state(events).collect()}
    assert state == {1: ("Archived", "r1"), 2: ("Archived", "r2"), 3: ("Production", "r3")}
    assert runs.resolve_version(events, "m", "Archived").first()["run_id"] == "r2"


def test_writers_at_once_get_versions_of_their_own(spark):
    """Six registrations at the same time: six versions, the highest in production, the others archived."""
    import tempfile
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier
    path, start = tempfile.mkdtemp(prefix="riskframe-registry-"), Barrier(6)

    def writer(i):
        registry = runs.Registry(spark, path)
        start.wait()
        return registry.register("a model/with a slash", f"run{i}")

    with ThreadPoolExecutor(6) as pool:
        versions = dict(enumerate(pool.map(writer, range(6))))
    assert sorted(versions.values()) == [1, 2, 3, 4, 5, 6]
    registry = runs.Registry(spark, path)
    state = {r["version"]: (r["stage"], r["run_id"]) for r in runs.registry_state(registry.events()).collect()}
    assert state == {v: ("Production" if v == 6 else "Archived", f"run{i}") for i, v in versions.items()}
    assert registry.resolve("a model/with a slash").first()["version"] == 6
    assert registry.resolve("another").first() is None


def test_a_lost_writer_leaves_a_gap(spark):
    import tempfile
    registry = runs.Registry(spark, tempfile.mkdtemp(prefix="riskframe-registry2-"))
    assert registry.register("m", "r1") == 1
    assert registry.claim("m") == 2  # and nothing more
    assert registry.register("m", "r3", promote_to="Staging") == 3
    state = {r["version"]: r["stage"] for r in runs.registry_state(registry.events()).collect()}
    assert state == {1: "Production", 3: "Staging"}
    assert registry.resolve("m").first()["version"] == 1 and registry.resolve("m", "Staging").first()["version"] == 3


def test_exclusive_files(spark):
    import tempfile
    from riskframe.session import create_exclusive, file_names
    folder = tempfile.mkdtemp(prefix="riskframe-claims-")
    assert create_exclusive(spark, f"{folder}/new/1") and not create_exclusive(spark, f"{folder}/new/1")
    assert file_names(spark, f"{folder}/new") == ["1"] and file_names(spark, f"{folder}/none") == []
