"""Windows over events of three months, from the date of the first event, against plain Python."""
import datetime as dt
import json
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

START, DAYS, A_DAY = dt.datetime(2024, 1, 10, 5), 90, 12
FRACS = np.linspace(0, 1, 11)


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    """Both measures move after the first twenty days, and again, slowly, over the months."""
    rng, rows = np.random.default_rng(6), []
    for day in range(DAYS):
        for i in range(A_DAY):
            moved = 100 if day >= 20 else 0
            rows.append((len(rows), START + dt.timedelta(days=day, minutes=int(rng.integers(0, 1000)) if i else 0), int(rng.integers(0, 500)) + moved * 9 + day,
                         "view", float(rng.uniform(0, 100)) + moved * 2 + day / 3, json.dumps({"k": int(rng.integers(0, 3))})))
    path = tmp_path_factory.mktemp("events")
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    pq.write_table(pa.table({n: pa.array(c) for n, c in zip(names, zip(*rows))}), path / "events.parquet")
    return str(path), [(r[1].date(), {"value": r[4], "user_id": float(r[2])}) for r in rows]


def inner_edges(values):
    return np.unique(np.quantile(values, FRACS))[1:-1]


def psi(ref, cur):
    r, c = (x / max(x.sum(), 1) + 1e-6 for x in (ref, cur))
    return float(((c - r) * np.log(c / r)).sum())


def frozen(rows, feature):
    return inner_edges([v[feature] for d, v in rows if d < START.date() + dt.timedelta(days=7)])


def counts(rows, feature, edges, days):
    return np.bincount(np.searchsorted(edges, [v[feature] for d, v in rows if d in days], side="right").astype(int), minlength=len(edges) + 1)


@pytest.mark.parametrize("name", ["drift_report", "drift_report_kll", "drift_report_exact_pvalue"])
def test_reference_is_the_first_twenty_days(spark, events, name):
    path, rows = events
    got = {r["feature"]: r for r in entry.queries()[name](spark, path).collect()}
    assert all((r["n_ref"], r["n_cur"]) == (20 * A_DAY, (DAYS - 20) * A_DAY) for r in got.values())
    cut = START.date() + dt.timedelta(days=20)
    ref, cur = ([v["value"] for d, v in rows if (d < cut) == first] for first in (True, False))
    cur = np.array(cur) + 3.0
    if name != "drift_report_kll":
        edges = inner_edges(ref)
        want = psi(*(np.bincount(np.searchsorted(edges, x, side="right"), minlength=len(edges) + 1) for x in (ref, cur)))
        assert got["value"]["psi"] == pytest.approx(want, abs=1e-8)
    assert got["value"]["ks_statistic"] == 1.0          # every later value is above the first twenty days'


def test_decisions_see_the_move(spark, events):
    path, _ = events
    assert entry.queries()["any_drift"](spark, path).first()["has_drift"]
    assert entry.queries()["psi_retrain"](spark, path).first()["n_features_over"] == 2


def test_daily_psi_on_edges_of_the_first_week(spark, events):
    path, rows = events
    got = {(r["feature"], r["day"]): (r["psi"], r["n_day"], r["n_reference"]) for r in entry.queries()["daily_psi"](spark, path).collect()}
    days = sorted({d for d, _ in rows})
    assert len(got) == 2 * (len(days) - 1)
    for (feature, day), (value, n_day, n_reference) in got.items():
        edges = frozen(rows, feature)
        cur, ref = (counts(rows, feature, edges, x) for x in ({day}, {day - dt.timedelta(days=k) for k in range(1, 29)}))
        seen = cur + ref > 0
        assert (n_day, n_reference) == (cur.sum(), ref.sum())
        assert value == pytest.approx(psi(ref[seen], cur[seen]), abs=1e-8)


def test_stream_histogram_on_edges_of_the_first_week(spark, events):
    path, rows = events
    got = {(r["day"], r["feature"], r["bin"]): r["n"] for r in entry.queries()["stream_daily_histogram"](spark, path).collect()}
    want = Counter()
    for feature in ("value", "user_id"):
        edges = frozen(rows, feature)
        want.update((d, feature, int(np.searchsorted(edges, v[feature], side="right"))) for d, v in rows)
    assert got == dict(want)
