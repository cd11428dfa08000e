"""What is carried along a symbol over slices: the last tick at a moment, weighted averages, peaks."""

import math
import random
from datetime import datetime, timedelta

import pytest

from tickwell.operators.asof import asof_join
from tickwell.operators.recurrence import price_drawdown, price_ewma

TICKS = "symbol string, price double, timestamp timestamp_ntz, event_id long"
PROBES = "symbol string, moment timestamp_ntz, id long"
START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def ticks_of(n, seed=5):
    """Three of five ticks are of one symbol; some share an instant, some have no price."""
    rng = random.Random(seed)
    prices = [None, math.nan, *[i / 8 for i in range(1, 100)]]
    return [("HOT" if i % 5 < 3 else rng.choice("AB"), rng.choice(prices), at(rng.randrange(0, 4 * n, 4)), i) for i in range(n)]


def probes_of(n, seed=6):
    rng = random.Random(seed)
    rows = [(rng.choice(["HOT", "HOT", "A", "B", "none", None]), at(rng.randrange(-50, 4 * n + 50)), i) for i in range(n)]
    return rows + [("HOT", at(40), n + i) for i in range(30)] + [("A", None, n + 30), ("A", None, n + 30)]


def shown(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def last_tick(ticks, symbol, moment, within=None):
    own = [t for t in ticks if symbol is not None and moment is not None and t[0] == symbol and t[2] <= moment]
    if not own:
        return None, None
    best = max(own, key=lambda t: (t[2], t[3]))
    return (None, None) if within is not None and (moment - best[2]).total_seconds() > within else (shown(best[1]), best[2])


@pytest.mark.parametrize(("slices", "within"), [(1, None), (9, 25.0), (60, None)])
def test_asof(spark, slices, within):
    ticks, probes = ticks_of(250), probes_of(150)
    found = asof_join(spark.createDataFrame(probes, PROBES), spark.createDataFrame(ticks, TICKS), tie="event_id", within_seconds=within, slices=slices)
    assert found.columns == ["symbol", "moment", "id", "price", "price_at"]
    want = [(s, m, i, *last_tick(ticks, s, m, within)) for s, m, i in probes]
    assert sorted(((*r[:3], shown(r[3]), r[4]) for r in found.collect()), key=str) == sorted(want, key=str)


def test_asof_plan_has_no_range_join(spark):
    found = asof_join(spark.createDataFrame(probes_of(5), PROBES), spark.createDataFrame(ticks_of(5), TICKS), slices=2)
    plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_of_nothing(spark):
    ticks, probes = spark.createDataFrame(ticks_of(5), TICKS), spark.createDataFrame(probes_of(5), PROBES)
    assert asof_join(probes.limit(0), ticks).count() == 0
    assert {r.price for r in asof_join(probes, ticks.limit(0)).collect()} == {None}
    with pytest.raises(ValueError, match="price"):
        asof_join(ticks, ticks, at="timestamp")


def along(rows):
    by_symbol = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or START, r[3])):
        by_symbol.setdefault(r[0], []).append(r)
    return by_symbol.items()


@pytest.mark.parametrize("slices", [1, 7, 200])
@pytest.mark.parametrize("alpha", [0.02, 0.9, 1.0])
def test_ewma_does_not_depend_on_slices(spark, slices, alpha):
    rows = [*ticks_of(300), ("A", 5.0, None, 900), (None, 1.0, at(1), 901), ("C", None, at(1), 902)]
    want = {}
    for symbol, own in along(r for r in rows if r[0] is not None):
        value = None
        for r in own:
            if r[1] is not None and not math.isnan(r[1]):
                value = r[1] if value is None else alpha * r[1] + (1 - alpha) * value
            want[r[3]] = value
    found = price_ewma(spark.createDataFrame(rows, TICKS), alpha, "event_id", slices)
    assert dict(found.dtypes) == {"symbol": "string", "price": "double", "timestamp": "timestamp_ntz", "event_id": "bigint", "ewma": "double"}
    got = {r.event_id: r.ewma for r in found.collect()}
    assert got.keys() == want.keys()
    wrong = {i: (got[i], v) for i, v in want.items() if (got[i] is None) != (v is None) or (v is not None and got[i] != pytest.approx(v, rel=1e-9))}
    assert not wrong


@pytest.mark.parametrize("slices", [1, 7, 200])
def test_drawdown_does_not_depend_on_slices(spark, slices):
    rows = [*ticks_of(300), ("C", -2.0, at(1), 900), ("C", -1.0, at(2), 901), (None, 1.0, at(1), 902)]
    want = {}
    for _, own in along(r for r in rows if r[0] is not None):
        peak = None
        for r in own:
            price = None if r[1] is None or math.isnan(r[1]) else r[1]
            peak = price if peak is None else peak if price is None else max(peak, price)
            want[r[3]] = (peak, price / peak - 1 if price is not None and peak > 0 else None)
    got = {r.event_id: (r.peak, r.drawdown) for r in price_drawdown(spark.createDataFrame(rows, TICKS), "event_id", slices).collect()}
    assert got == want


def test_no_ticks(spark):
    none = spark.createDataFrame([], TICKS)
    assert price_ewma(none, 0.5).count() == price_drawdown(none).count() == 0
    with pytest.raises(ValueError, match="alpha"):
        price_ewma(none, 0)
