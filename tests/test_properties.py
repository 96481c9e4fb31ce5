"""Property tests: random inputs against plain-Python reference computations."""
from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators import features as fe
from ledgerlake.operators.upsert import upsert_frames

FAST = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.integers(0, 30), st.integers(-5, 5)), max_size=25)


@FAST
@given(target=rows, source=rows, update_all=st.booleans())
def test_upsert_matches_dict_merge(spark, target, source, update_all):
    t = {k: (v, "t") for k, v in target}                  # unique target keys
    s = {k: v for k, v in source}                          # unique source keys
    tdf = spark.createDataFrame([(k, v, tag) for k, (v, tag) in t.items()], "k int, v int, tag string")
    sdf = spark.createDataFrame([(k, v) for k, v in s.items()], "k int, v int")
    got = {r.k: (r.v, r.tag) for r in upsert_frames(tdf, sdf, ["k"], None if update_all else ["v"]).collect()}
    want = dict(t)
    for k, v in s.items():
        want[k] = (v, t[k][1] if k in t else None)
    assert got == want


events = st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]),
                            st.integers(0, 40 * 86400),           # seconds within 40 days
                            st.integers(1, 10_000)), min_size=1, max_size=40)


@FAST
@given(evs=events, bucket=st.sampled_from([3600, 5000, 86400]))
def test_bucketed_windows_match_brute_force(spark, evs, bucket):
    base = datetime(2026, 1, 1)
    data = [(f"t{i}", e, base + timedelta(seconds=s, microseconds=i), Decimal(c) / 100)
            for i, (e, s, c) in enumerate(evs)]
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, event_ts timestamp_ntz,"
                                     " amount_decimal decimal(18,2)")
    got = {r.transaction_id: (r.spend_7d, r.tx_count_7d, r.spend_30d)
           for r in fe.rolling_features(df, "customer_id", windows=[7, 30], method="bucketed",
                                        bucket_seconds=bucket).collect()}
    for tid, ent, ts, _ in data:
        e = int((ts - datetime(1970, 1, 1)).total_seconds() // 1)
        def win(n):
            inside = [a for _, ent2, ts2, a in data if ent2 == ent
                      and e - n * 86400 <= int((ts2 - datetime(1970, 1, 1)).total_seconds() // 1) <= e]
            return sum(inside), len(inside)
        s7, c7 = win(7)
        s30, _ = win(30)
        assert got[tid] == (s7, c7, s30), tid
