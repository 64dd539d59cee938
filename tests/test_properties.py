"""Property tests (Hypothesis) against plain-Python models of each operator."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions import zfill
from marketlake.operators.history import append_incremental, retention_split, split_known
from marketlake.operators.reshape import group_sum, pivot_first

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
HIST = "code string, date date, price double, row_key long"

codes = st.sampled_from(["005930", "000660", "035720", "AAPL"])
days = st.integers(0, 20).map(lambda d: dt.date(2024, 1, 1) + dt.timedelta(days=d))
hist_rows = st.lists(st.tuples(codes, days, st.integers(1, 999).map(float)), max_size=25)


def _rows(raw, start=0):
    return [(c, d, p, start + i) for i, (c, d, p) in enumerate(raw)]


@SETTINGS
@given(stored=hist_rows, incoming=hist_rows)
def test_append_is_idempotent_and_matches_model(spark, stored, incoming):
    s_rows, i_rows = _rows(stored), _rows(incoming, 1000)
    s = spark.createDataFrame(s_rows, HIST)
    i = spark.createDataFrame(i_rows, HIST)
    once = append_incremental(s, i)
    twice = append_incremental(once, i)
    got = sorted(map(tuple, once.collect()))
    assert got == sorted(map(tuple, twice.collect()))
    last = {}
    for c, d, _, _ in s_rows:
        last[c] = max(last.get(c, d), d)
    model = s_rows + [r for r in i_rows if r[0] not in last or r[1] > last[r[0]]]
    assert got == sorted(model)


@SETTINGS
@given(stored=hist_rows, cands=st.lists(codes, max_size=6, unique=True))
def test_known_new_and_retention_partition_their_input(spark, stored, cands):
    s = spark.createDataFrame(_rows(stored), HIST)
    c = spark.createDataFrame([(x,) for x in cands], "code string")
    known, new = split_known(c, s)
    k, n = {r.code for r in known.collect()}, {r.code for r in new.collect()}
    assert k | n == set(cands) and not (k & n)
    assert k == set(cands) & {r[0] for r in stored}
    kept, dropped = retention_split(s, c)
    kept_rows, dropped_rows = sorted(map(tuple, kept.collect())), sorted(map(tuple, dropped.collect()))
    assert sorted(kept_rows + dropped_rows) == sorted(_rows(stored))
    assert all(r[0] in cands for r in kept_rows) and not any(r[0] in cands for r in dropped_rows)


long_rows = st.lists(
    st.tuples(st.sampled_from(["20240102", "20240103", None]), st.sampled_from(["a", "b", "c"]),
              st.one_of(st.none(), st.integers(-50, 50).map(float))),
    max_size=30,
)


@SETTINGS
@given(rows=long_rows)
def test_pivot_first_equals_first_non_null_in_order(spark, rows):
    data = [(t, k, v, i) for i, (t, k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "TIME string, ITEM_NAME1 string, DATA_VALUE double, seq long")
    got = {}
    for row in pivot_first(df, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq", ["a", "b", "c"]).collect():
        for k in "abc":
            if row[k] is not None:
                got[(row.TIME, k)] = row[k]
    model = {}
    for t, k, v, _ in data:
        if t is not None and v is not None and (t, k) not in model:
            model[(t, k)] = v
    assert got == model
    # a row exists exactly for the indexes with at least one value
    assert pivot_first(df, "TIME", "ITEM_NAME1", "DATA_VALUE", "seq", ["a", "b", "c"]).count() == \
        len({t for (t, _k) in model})


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y", None]),
                               st.one_of(st.none(), st.decimals("-1000", "1000", places=2).map(float))),
                     max_size=30))
def test_group_sum_exact_with_pandas_semantics(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.s for r in group_sum(df, "k", "v", "s", decimal_scale=4).collect()}
    model = {}
    for k, v in rows:
        if k is None:
            continue
        model[k] = model.get(k, Decimal(0)) + (Decimal(str(v)) if v is not None else 0)
    assert got == {k: float(v) for k, v in model.items()}


@SETTINGS
@given(xs=st.lists(st.integers(0, 10**9), min_size=1, max_size=20))
def test_zfill_matches_python(spark, xs):
    df = spark.createDataFrame([(str(x),) for x in xs], "s string")
    assert [r.z for r in df.select(zfill(F.col("s")).alias("z")).collect()] == [str(x).zfill(6) for x in xs]
