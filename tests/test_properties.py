"""Property tests: Spark operators vs brute-force Python on random inputs."""

import datetime as dt
import hashlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import log_row
from usage_rollup.operators import reports as R
from usage_rollup.operators.maintain import delete_range, upsert_frame
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.sources.scan import mock_log

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

opt = lambda xs: st.one_of(st.none(), st.sampled_from(xs))
rows_st = st.lists(
    st.tuples(
        st.datetimes(min_value=dt.datetime(2024, 1, 1), max_value=dt.datetime(2024, 2, 29, 23, 59)),
        opt(["a", "b"]), opt(["US", "DE"]), opt(["1.0.0", "1.2.0", "1.2.0.dev1"]),
        opt(["3", "3.8.1", "3.9.0", "3.10.2"]), opt(["Linux", "x"]), opt(["r1", "x"]), opt(["x86_64"]),
    ),
    max_size=40,
)


def _mm(p):
    if p is None:
        return None
    parts = p.split(".")
    return parts[0] + "." + (parts[1] if len(parts) > 1 else "")


def _brute_rollup(rows):
    c = Counter()
    for ts, proj, cc, ver, py, sn, sr, cpu in rows:
        c[(ts.date(), sn, sr, ver, proj, cc, cpu, _mm(py))] += 1
    out = set()
    for k, n in c.items():
        key = "|".join([k[0].isoformat()] + [v for v in k[1:] if v is not None])
        out.add((hashlib.md5(key.encode()).hexdigest(),) + k + (n,))
    return out


def _log(spark, rows):
    return mock_log(spark, [log_row(ts, project=p, country=cc, version=v, python=py, sys_name=sn,
                                    sys_release=sr, cpu=cpu) for ts, p, cc, v, py, sn, sr, cpu in rows])


@SETTINGS
@given(rows=rows_st)
def test_rollup_matches_brute_force(spark, rows):
    got = {tuple(r) for r in daily_rollup(_log(spark, rows)).collect()}
    assert got == _brute_rollup(rows)


@SETTINGS
@given(rows=rows_st, a=st.integers(0, 40), span=st.integers(0, 20))
def test_delete_range_matches_brute_force(spark, rows, a, span):
    start = dt.datetime(2024, 1, 1) + dt.timedelta(days=a)
    end = start + dt.timedelta(days=span, hours=7)
    got = sorted(r.timestamp for r in delete_range(_log(spark, rows), "timestamp", str(start), str(end)).collect())
    assert got == sorted(r[0] for r in rows if not (start <= r[0] < end))


@SETTINGS
@given(old=rows_st, new=rows_st)
def test_upsert_matches_brute_force(spark, old, new):
    t = daily_rollup(_log(spark, old))
    b = daily_rollup(_log(spark, new))
    got = sorted(tuple(r) for r in upsert_frame(t, b, "load_id", None).collect())
    bt = _brute_rollup(new)
    keys = {r[0] for r in bt}
    want = sorted([r for r in _brute_rollup(old) if r[0] not in keys] + list(bt))
    assert got == want


@SETTINGS
@given(rows=rows_st, as_of=st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 4, 1)))
def test_weekly_series_matches_brute_force(spark, rows, as_of):
    r = daily_rollup(_log(spark, rows))
    got = [tuple(x) for x in R.weekly_series(r, as_of.isoformat()).collect()]

    def monday(d):
        return d - dt.timedelta(days=d.weekday())

    floor = monday(as_of - dt.timedelta(days=28))
    weeks = Counter()
    for row in rows:
        weeks[monday(row[0].date())] += 1
    recent = [w for w in weeks if w >= floor]
    if not recent:
        assert got == []
        return
    newest = max(recent)
    want = sorted((w.isoformat(), n) for w, n in weeks.items() if w != newest)
    assert got == want


TABLE_SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
ts_st = st.datetimes(min_value=dt.datetime(2024, 1, 1), max_value=dt.datetime(2024, 1, 6, 23, 59))


@TABLE_SETTINGS
@given(old=st.lists(st.tuples(ts_st, st.sampled_from(["a", "b"])), min_size=1, max_size=25),
       new=st.lists(st.tuples(ts_st, st.sampled_from(["a", "b"])), max_size=10),
       a=st.integers(0, 4 * 24), span=st.integers(1, 3 * 24), scoped=st.booleans())
def test_replace_range_table_matches_brute_force(spark, old, new, a, span, scoped):
    from usage_rollup.operators import maintain
    from usage_rollup.session import scratch_dir

    start = dt.datetime(2024, 1, 1) + dt.timedelta(hours=a)
    end = start + dt.timedelta(hours=span)
    staged = [(t, p) for t, p in new if start <= t < end]  # the scan only yields rows of the range
    target = scratch_dir(spark, "prop-rr")

    def frame(rows):
        return mock_log(spark, [log_row(t, project=p) for t, p in rows])

    maintain.replace_range(spark, frame(old), target, "timestamp", "2024-01-01", "2024-01-08")
    maintain.replace_range(spark, frame(staged), target, "timestamp", str(start), str(end),
                           scope="project" if scoped else None)
    got = sorted((r.timestamp, r.project) for r in spark.read.parquet(target).collect())
    if not staged:
        want = sorted(old)  # nothing staged: the target is left untouched
    else:
        scope = {p for _, p in staged}
        keep = [(t, p) for t, p in old if not (start <= t < end and (not scoped or p in scope))]
        want = sorted(keep + staged)
    assert got == want


@TABLE_SETTINGS
@given(old=rows_st, new=rows_st, grain=st.sampled_from(["month", "day"]))
def test_upsert_table_matches_brute_force(spark, old, new, grain):
    from usage_rollup.operators import maintain
    from usage_rollup.session import scratch_dir

    target = scratch_dir(spark, "prop-up")
    maintain.write_rollup(spark, daily_rollup(_log(spark, old)), target, "incremental", grain=grain)
    maintain.write_rollup(spark, daily_rollup(_log(spark, new)), target, "incremental", grain=grain)
    bt = _brute_rollup(new)
    keys = {r[0] for r in bt}
    want = sorted([r for r in _brute_rollup(old) if r[0] not in keys] + list(bt))
    if not old and not new:
        assert not storage_exists(spark, target)
        return
    cols = ["load_id", "download_date", "system_name", "system_release", "version", "project", "country_code",
            "cpu", "python_version", "daily_download_sum"]
    got = sorted(tuple(r) for r in spark.read.parquet(target).select(*cols).collect())
    assert got == want


def storage_exists(spark, path):
    from usage_rollup.sources import storage

    return storage.has_data(spark, path)


@SETTINGS
@given(rows=rows_st, days=st.sampled_from([0, 7, 30]),
       as_of=st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 3, 15)))
def test_monthly_and_top_n_match_brute_force(spark, rows, days, as_of):
    r = daily_rollup(_log(spark, rows))
    months = Counter()
    for row in rows:
        months[row[0].strftime("%Y-%m")] += 1
    ordered = sorted(months.items(), reverse=True)
    assert [tuple(x) for x in R.monthly_recent(r).collect()] == ordered[:6]
    assert [tuple(x) for x in R.last_two_months(r).collect()] == ordered[1:3]

    lower = as_of - dt.timedelta(days=days)
    by_version = Counter()
    for row in rows:
        if days == 0 or row[0].date() >= lower:
            by_version[row[3]] += 1
    want = sorted(by_version.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[:10]
    got = [tuple(x) for x in R.top_versions(r, days, as_of.isoformat()).collect()]
    assert got == want
