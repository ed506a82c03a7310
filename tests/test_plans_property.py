"""Property tests of the distributed numbering and percentiles against brute force."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salarium.plans.percentile import exact_percentiles
from salarium.plans.sequence import with_sequence

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _pg(values, p):
    xs = sorted(values)
    pos = (len(xs) - 1) * p
    lo, hi = xs[math.floor(pos)], xs[math.ceil(pos)]
    return float(lo) + (pos - math.floor(pos)) * (float(hi) - float(lo))


@SETTINGS
@given(keys=st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=400, unique=True),
       parts=st.integers(1, 9), start=st.integers(0, 5))
def test_sequence_property(spark, keys, parts, start):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(parts)
    got = {r.k: r.id for r in with_sequence(df, ["k"], "id", start).collect()}
    assert got == {k: i + start for i, k in enumerate(sorted(keys))}


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))),
                     min_size=1, max_size=300),
       p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_percentile_property(spark, rows, p):
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: r.q for r in exact_percentiles(df, ["g"], "v", {"q": p}).collect()}
    expect = {}
    for g in {g for g, _ in rows}:
        vals = [v for gg, v in rows if gg == g and v is not None]
        if vals:
            expect[g] = _pg(vals, p)
    assert got == expect
