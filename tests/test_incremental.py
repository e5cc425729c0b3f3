"""The daily state equals the full rebuild; crash-safe day swap."""

from __future__ import annotations

import datetime as dt
import random
import tempfile
from dataclasses import replace

import pytest

from renewlens.params import FeatureParams
from renewlens.plans import features as C
from renewlens.plans.incremental import LeadState
from renewlens.sources.store import DatedStore
from renewlens.sources.testdata import TestdataSources
from tests.conftest import d, ts

P = FeatureParams(as_of=d("2024-03-10"), lead_history_days=6)


def _rows(df, cols=None):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.fixture()
def src(make_src):
    """Leads whose halves arrive on different days, without prices, and that
    leave the window half by half."""
    rng = random.Random(4)
    at = lambda: ts("2024-03-01") + dt.timedelta(days=rng.randint(0, 9), hours=rng.choice([0, 13]))
    supply = [(f"S{rng.randint(1, 4)}", i % 40, at()) for i in range(70)]
    masters = [(i % 40, i % 9, at(), rng.choice(["CRM", "ivr", None]), "self", "R", "O") for i in range(60)]
    flats = [(i, True, None if i % 3 == 0 else str(100 * (i % 4)), i % 3, i % 2, i % 4) for i in range(9)]
    return make_src(
        lead_supply_users=supply, lead_masters=masters, flats=flats,
        feature_types=[(0, "Pune"), (1, "Goa")], property_types=[(0, "Villa"), (1, "Apartment")], apartment_types=[(0, "1 RK"), (1, "2 BHK"), (2, "3 BHK")],
    )


def test_state_equals_rebuild_day_by_day(spark, src):
    state = LeadState(spark, tempfile.mkdtemp(prefix="renewlens-state-"), P)
    for day in (d("2024-03-06"), d("2024-03-07"), d("2024-03-10"), d("2024-03-10")):  # days may be left out or run again
        state.update(src, day)
        full = C.leads_with_listings(src, replace(P, as_of=day))
        plc = state.raw_leads(day)
        assert _rows(plc, full.columns) == _rows(full)
        want = C.city_daily_activity(C.impute_prices(full))
        assert _rows(state.city_daily(day, plc), want.columns) == _rows(want)


def test_a_run_reads_one_day_of_leads(spark):
    """The bounds of the new day reach the scan."""
    sources = TestdataSources(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = sources.lead_masters.where((C.F.col("created_at") > C._ts(d("1998-06-30"))) & (C.F.col("created_at") <= C._ts(d("1998-07-01"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(l_shipdate,1998-06-30" in plan and "LessThanOrEqual(l_shipdate,1998-07-01" in plan


def test_state_of_a_crashed_day_is_left_out(spark, src, monkeypatch):
    state = LeadState(spark, tempfile.mkdtemp(prefix="renewlens-state-"), P)
    first, second = d("2024-03-07"), d("2024-03-08")
    state.update(src, first)
    with monkeypatch.context() as m:
        m.setattr(state, "_recount", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            state.update(src, second)
    assert state.last_day(d("2024-04-01")) == first
    state.update(src, second)
    full = C.leads_with_listings(src, replace(P, as_of=second))
    assert _rows(state.raw_leads(second), full.columns) == _rows(full)


def test_day_swap_survives_a_crash(spark, monkeypatch):
    store = DatedStore(spark, tempfile.mkdtemp(prefix="renewlens-swap-") + "/t")
    assert store.read() is None
    day1, day2 = d("2024-01-01"), d("2024-01-02")
    frame = lambda day, *ids: spark.createDataFrame([(day, i) for i in ids], "day date, i long")
    store.write(frame(day1, 1, 2), day1)
    store.write(frame(day2, 3), day2)
    with monkeypatch.context() as m:  # dies after its rows, before its marker
        m.setattr(store, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.write(frame(day1, 9), day1)
    assert _rows(store.read(), ["i"]) == [(1,), (2,), (3,)]
    reader = store.read()
    store.write(frame(day1, 4), day1)
    assert _rows(reader, ["i"]) == [(1,), (2,), (3,)]  # readers keep what they saw
    store.write(frame(day2), day2)  # an empty run clears its day
    store.vacuum()
    assert _rows(store.read(), ["i"]) == [(4,)] and store.days() == [str(day1), str(day2)]
    assert _rows(store.read(before=day1) or frame(day1), ["i"]) == []


def test_two_writers_of_a_day(spark):
    path = tempfile.mkdtemp(prefix="renewlens-swap-") + "/t"
    a, b = DatedStore(spark, path), DatedStore(spark, path)
    a.write(spark.range(1), "2024-01-01")
    b.write(spark.range(2), "2024-01-01")
    a.write(spark.range(3), "2024-01-01")
    assert a.read().count() == b.read().count() == 3
