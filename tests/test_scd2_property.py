"""scd2_apply against a plain-Python model of the SCD2 contract."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhouse.operators.scd2 import scd2_apply

BASE = dt.date(2024, 1, 1)
RUNS = [dt.date(2024, 1, 1), dt.date(2024, 2, 10), dt.date(2024, 2, 10), dt.date(2024, 5, 1)]

snapshot = st.dictionaries(st.integers(1, 6), st.one_of(st.none(), st.sampled_from(["A", "B", "C"])),
                           max_size=6)


def model(snapshots):
    """versions: list of [sk, key, city, from, to, current]; keys numbered by (phase, key)."""
    versions, next_sk = [], 1
    for run, snap in zip(RUNS, snapshots):
        cur = {v[1]: v for v in versions if v[5]}
        known = {v[1] for v in versions}
        new, nxt = [], []
        for k in sorted(snap):
            city = snap[k]
            if k not in known:
                new.append((k, city))
            elif k not in cur:
                nxt.append((k, city))
            else:
                old = cur[k][2]
                if old is not None and city is not None and old != city:
                    cur[k][4] = run - dt.timedelta(days=1)
                    cur[k][5] = False
                    nxt.append((k, city))
        for k, city in new:
            versions.append([next_sk, k, city, BASE, None, True]); next_sk += 1
        for k, city in nxt:
            versions.append([next_sk, k, city, run, None, True]); next_sk += 1
    return sorted(tuple(v) for v in versions)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(snapshot, min_size=4, max_size=4))
def test_scd2_matches_model(spark, snapshots):
    dim = None
    for run, snap in zip(RUNS, snapshots):
        inc = spark.createDataFrame(sorted(snap.items()), "id int, city string")
        dim = scd2_apply(dim, inc, "sk", "id", ["city"], ["city"], run.isoformat(), BASE.isoformat())
    got = sorted(tuple(r) for r in dim.select("sk", "id", "city", "valid_from", "valid_to",
                                              "is_current").collect())
    assert got == model(snapshots)
