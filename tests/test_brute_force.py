"""Operators against plain Python on random rows."""

from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from itertools import groupby
from statistics import mean, pstdev

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.dedup import deduplicate
from tidemark.operators.maintenance import compacted
from tidemark.operators.sinks import rebuild_window
from tidemark.plans import marts, staging
from tidemark.schemas import WAREHOUSE

FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
DAY = datetime(2024, 1, 5)
MOMENTS = st.integers(0, 47).map(lambda h: DAY + timedelta(hours=h))


@FEW
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]), st.none() | MOMENTS,
                          st.none() | st.integers(-3, 3), st.none() | st.sampled_from(["x", "y"])), max_size=60))
def test_latest_row_per_key(spark, rows):
    def rank(row):  # NULL loses against every value
        return tuple((v is not None, v if v is not None else 0) for v in row[1:])

    want = {}
    for row in rows:
        if row[0] is not None and (row[0] not in want or rank(row) > rank(want[row[0]])):
            want[row[0]] = row
    got = deduplicate(spark.createDataFrame(rows, "id string, event_ts timestamp, n int, s string"), "id").collect()
    assert {r.id: tuple(r) for r in got} == want and len(got) == len(want)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["L1", "L2"]), MOMENTS, st.integers(-60, 95), st.integers(860, 1095)),
                min_size=1, max_size=120))
def test_sensor_model(spark, rows):
    data = [(str(i), loc, float(t), float(p), 50.0, ts) for i, (loc, ts, t, p) in enumerate(rows)]
    frame = spark.createDataFrame(data, "reading_id string, location_id string, temperature float, pressure float, "
                                        "humidity float, event_ts timestamp")
    ok = [r for r in rows if -50 <= r[2] <= 85 and 870 <= r[3] <= 1085]
    want = {}
    for (loc, day), group in groupby(sorted(ok, key=lambda r: (r[0], r[1])), key=lambda r: (r[0], r[1].date())):
        group = list(group)
        day_mean, day_std = mean(r[2] for r in group), pstdev([r[2] for r in group])
        for hour, readings in groupby(group, key=lambda r: r[1]):
            values = [r[2] for r in readings]
            want[loc, hour] = (len(values), mean(values), day_mean, day_std)
    got = {(r.location_id, r.hour_ts): r for r in marts.int_sensor_anomalies(staging.stg_sensors(frame)).collect()}
    assert set(got) == set(want)
    for key, (count, hour_mean, day_mean, day_std) in want.items():
        row = got[key]
        assert row.reading_count == count
        assert row.avg_temp == pytest.approx(hour_mean, abs=1e-9)
        assert row.avg_temp_day == pytest.approx(day_mean, abs=1e-9)
        assert row.std_temp_day == pytest.approx(day_std, abs=1e-7)
        if abs(abs(hour_mean - day_mean) - 3 * day_std) > 1e-6:
            assert row.temp_anomaly == (abs(hour_mean - day_mean) > 3 * day_std)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["BTC", "ETH"]), st.integers(0, 2), st.integers(1, 9),
                          st.decimals(0, 1000, places=8)), min_size=1, max_size=40))
def test_collapsed_averages(spark, rows):
    table = WAREHOUSE["agg_trading_volume"]
    frame = spark.createDataFrame(
        [(20240105, date(2024, 1, 5) + timedelta(days=d), a, float(n), n, p, DAY) for a, d, n, p in rows], table.schema)
    got = {(r.asset, r.full_date.day - 5): r for r in compacted(frame, table).collect()}
    assert set(got) == {(a, d) for a, d, _, _ in rows}
    for (asset, day), row in got.items():
        mine = [(n, p) for a, d, n, p in rows if (a, d) == (asset, day)]
        weight = sum(n for n, _ in mine)
        exact = (sum(n * p for n, p in mine) / weight).quantize(Decimal("1e-8"), ROUND_HALF_UP)
        assert (row.trade_count, row.total_volume, row.avg_price) == (weight, float(weight), exact)


@FEW
@given(st.lists(MOMENTS, unique=True, max_size=30), st.lists(MOMENTS, unique=True, max_size=30), MOMENTS)
def test_rebuilt_window(spark, old, new, cutoff):
    def frame(moments, mark):
        return spark.createDataFrame([(m, mark) for m in moments], "hour_ts timestamp, mark string")

    fresh = [m for m in new if m >= cutoff]
    got = rebuild_window(frame(old, "old"), frame(fresh, "new"), "hour_ts", cutoff).collect()
    assert sorted(map(tuple, got)) == sorted([(m, "old") for m in old if m < cutoff] + [(m, "new") for m in fresh])


@FEW
@given(st.lists(st.tuples(st.integers(1, 2000), st.integers(0, 10 ** 7)), min_size=1, max_size=12), st.randoms())
def test_collapsed_averages_are_exact_however_rows_are_split(spark, rows, rng):
    table = WAREHOUSE["agg_daily_revenue"]

    def cents(total, n):
        return (Decimal(total) / 100 / n).quantize(Decimal("0.01"), ROUND_HALF_UP)

    data = [(20240105, DAY.date(), "N", "B", n, Decimal(total) / 100, cents(total, n), DAY) for n, total in rows]
    cut = rng.randint(0, len(data))
    whole = spark.createDataFrame(data, table.schema)
    parts = [compacted(spark.createDataFrame(part, table.schema), table) for part in (data[:cut], data[cut:])]
    n, total = sum(r[0] for r in rows), sum(r[1] for r in rows)
    for result in (compacted(whole, table), compacted(parts[0].unionByName(parts[1]), table)):
        row = result.first()
        assert (row.total_orders, row.total_revenue, row.avg_order_value) == (n, Decimal(total) / 100, cents(total, n))
