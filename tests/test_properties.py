"""Property tests: Spark results equal a brute-force Python computation on
random small inputs (same-ms ties, NULL values, several parts and coins)."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricebars.operators.bars import daily_metrics
from pricebars.operators.upsert import upsert
from pricebars.schemas import PAIR_ARRAY

D0 = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
HOUR = 3600 * 1000

ms_st = st.integers(min_value=0, max_value=3 * 24).map(lambda h: D0 + h * HOUR)
val_st = st.one_of(st.none(), st.integers(1, 500).map(float))
pairs_st = st.lists(st.tuples(ms_st, val_st), max_size=12)
payload_st = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 2), pairs_st, pairs_st, pairs_st)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_force(payloads):
    price, vol, cap = defaultdict(list), defaultdict(list), defaultdict(list)
    for coin, part, prices, volumes, caps in payloads:
        for pos, (ms, v) in enumerate(prices):
            if v is not None:
                price[(coin, ms_day(ms))].append(((ms, part, pos), v))
        for target, pairs in ((vol, volumes), (cap, caps)):
            for ms, v in pairs:
                if v is not None:
                    target[(coin, ms_day(ms))].append(v)
    out = {}
    for key, ticks in price.items():
        values = [v for _, v in ticks]
        ordered = sorted(ticks)
        mean = lambda xs: round(sum(xs) / len(xs), 9) if xs else 0.0
        out[key] = (ordered[0][1], ordered[-1][1], round(sum(values) / len(values), 9), max(values), min(values),
                    len(values), mean(vol.get(key, [])), mean(cap.get(key, [])))
    return out


def ms_day(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).date()


@SETTINGS
@given(st.lists(payload_st, max_size=5, unique_by=lambda p: (p[0], p[1])))
def test_rollup_equals_brute_force(spark, payloads):
    schema = f"coin_id string, part long, prices {PAIR_ARRAY.simpleString()}, " \
             f"total_volumes {PAIR_ARRAY.simpleString()}, market_caps {PAIR_ARRAY.simpleString()}"
    rows = [(c, p, [[float(m), v] for m, v in pr], [[float(m), v] for m, v in vo], [[float(m), v] for m, v in ca])
            for c, p, pr, vo, ca in payloads]
    df = spark.createDataFrame(rows, schema)
    got = {(r["coin_id"], r["event_date"]): (r["open_price_usd"], r["close_price_usd"], round(r["avg_price_usd"], 9),
                                             r["max_price_usd"], r["min_price_usd"], r["samples_per_day"],
                                             round(r["volume_usd"], 9), round(r["market_cap_usd"], 9))
           for r in daily_metrics(df, processed_at=False).collect()}
    assert got == brute_force(payloads)


row_st = st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 4), st.sampled_from(["s1", "s2"]),
                   st.one_of(st.none(), st.integers(0, 9).map(float)))


@SETTINGS
@given(st.lists(row_st, max_size=8, unique_by=lambda r: r[:2]), st.lists(row_st, max_size=8, unique_by=lambda r: r[:2]))
def test_upsert_equals_brute_force(spark, stored, incoming):
    schema = "k1 string, k2 int, sym string, v double"
    merged = upsert(spark.createDataFrame(stored, schema), spark.createDataFrame(incoming, schema), ["k1", "k2"], ["sym"])
    want = {r[:2]: r for r in stored}
    for r in incoming:
        old = want.get(r[:2])
        want[r[:2]] = (r[0], r[1], old[2] if old else r[2], r[3])
    assert sorted(tuple(x) for x in merged.collect()) == sorted(want.values())
