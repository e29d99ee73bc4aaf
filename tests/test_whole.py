"""Queries over tables whose cells reach beyond the plots of the small ones, against brute force."""

from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

USERS, SUPPLIERS, DAYS = 203, 134, 2


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """(folder, events by (day, cell), account balances): 203 users, 134 suppliers."""
    top = tmp_path_factory.mktemp("wide")
    rng = np.random.default_rng(3)
    users = np.tile(np.arange(USERS), DAYS)
    days = np.repeat(np.arange(DAYS), USERS)
    error = rng.random(len(users)) < 0.2
    ts = [datetime(2024, 1, 1) + timedelta(days=int(d), hours=3) for d in days]
    pq.write_table(pa.table({"event_id": np.arange(len(users)), "ts": pa.array(ts, pa.timestamp("us")), "user_id": users, "event_type": np.where(error, "error", "view").tolist(), "value": rng.uniform(0, 90, len(users)), "props": ["{}"] * len(users)}), top / "events.parquet")
    height = np.round(rng.uniform(0, 9999, SUPPLIERS), 2)
    pq.write_table(pa.table({"s_suppkey": np.arange(SUPPLIERS), "s_acctbal": height}), top / "supplier.parquet")
    return str(top), {(int(d), int(u)) for d, u, e in zip(days, users, error, strict=True) if e and u % 3 == 0}, height


def test_nearest_events_of_all_cells(spark, wide):
    folder, burning, _ = wide
    got = entry.queries()["nearest_event"](spark, folder).collect()
    assert len(got) == DAYS * USERS
    for r in got:
        square, near = min(((r.cell % 10 - c % 10) ** 2 + (r.cell // 10 - c // 10) ** 2, c) for d, c in burning if d == r.day.day - 1)
        assert (r.nearest, r.dist_km) == (near, pytest.approx(2 * square**0.5, abs=1e-6))


def test_all_suppliers_stand_on_the_grid(spark, wide):
    folder, _, height = wide
    run = lambda name: {r.cell: r for r in entry.queries()[name](spark, folder).collect()}
    cells = range(SUPPLIERS)
    built = [c for c in cells if height[c] / 10000 > 0.5]
    assert {c: r.dist_to_urban for c, r in run("dist_to_urban").items()} == {c: pytest.approx(min(2 * np.hypot(c % 10 - o % 10, c // 10 - o // 10) for o in built), abs=1e-6) for c in cells}
    assert sorted(run("grid_cells")) == list(cells)
    assert len(run("refine")) == 4 * SUPPLIERS
    found = run("neigh_mean")
    last = (SUPPLIERS - 1) // 10
    for c in cells:
        near = [min(max(c // 10 + a, 0), last) * 10 + min(max(c % 10 + b, 0), 9) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        assert found[c].mean == pytest.approx(np.mean([height[n] for n in near if n < SUPPLIERS and n % 11 != 3]), abs=1e-6)
    assert sorted(run("tpi5")) == sorted(run("laplacian")) == list(cells)
    assert entry.queries()["coarse_centres"](spark, folder).count() == 5 * (last // 2 + 1)
