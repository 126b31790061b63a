"""Randomised checks of the ranking operators against plain-Python versions
of their rules, on small tables with nulls, empty names and ties."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkops.operators import aggregate as agg
from sparkops.operators import ranking

FAST = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

names = st.one_of(st.none(), st.sampled_from(["", "a", "b", "c", "d"]))
locs = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
nums = st.one_of(st.none(), st.integers(0, 5))


def py_extremes(rows):
    """rows: (company, job, location, n). Reference rule of top_entity_extremes."""
    out = []
    for kind, idx in (("company", 0), ("job", 1)):
        totals = defaultdict(lambda: None)
        for r in rows:
            name = r[idx]
            if name is None or name == "":
                continue
            if r[3] is not None:
                totals[name] = (totals[name] or 0) + r[3]
            else:
                totals.setdefault(name, None)
        if not totals:
            continue
        # largest total (null last), then smallest name
        win = min(totals, key=lambda k: (totals[k] is None, -(totals[k] or 0), k))
        per_loc = {}
        for r in rows:
            if r[idx] == win and r[2] is not None:
                cur = per_loc.get(r[2])
                per_loc[r[2]] = cur if r[3] is None else (cur or 0) + r[3]
        if not per_loc:
            continue
        mx = min(per_loc, key=lambda k: (per_loc[k] is None, -(per_loc[k] or 0), k))
        mn = min(per_loc, key=lambda k: (per_loc[k] is None, per_loc[k] or 0, k))
        out.append((win, kind, mx, per_loc[mx], "max"))
        out.append((win, kind, mn, per_loc[mn], "min"))
    return sorted(out, key=str)


@FAST
@given(st.lists(st.tuples(names, names, locs, nums), min_size=1, max_size=25))
def test_top_entity_extremes_matches_rule(spark, rows):
    df = spark.createDataFrame(rows, "company string, job string, location string, n int")
    got = ranking.top_entity_extremes(df, {"company": "company", "job": "job"}, "location", "n")
    assert sorted((tuple(r) for r in got.collect()), key=str) == py_extremes(rows)


@FAST
@given(st.lists(st.tuples(st.sampled_from(["p", "q", None]), st.one_of(st.none(), st.sampled_from(["k1", "k2", "k3"]))),
                min_size=1, max_size=30))
def test_total_and_mode_with_text_keys(spark, rows):
    df = spark.createDataFrame(rows, "g string, v string")
    got = sorted((tuple(r) for r in agg.total_and_mode(df, "g", "v", "t", "m", "c").collect()), key=str)
    exp = []
    for g in {r[0] for r in rows}:
        vals = [r[1] for r in rows if r[0] == g]
        cnt = Counter(vals)
        # nulls form a value of their own in the pair count; the winner is the
        # largest count, ties to the smallest value, a null value losing ties
        best = min(cnt, key=lambda v: (-cnt[v], v is None, v or ""))
        exp.append((g, len(vals), best, cnt[best]))
    assert got == sorted(exp, key=str)


@FAST
@given(st.lists(st.sampled_from(["s1", "s2"]), min_size=1, max_size=40),
       st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f"]), min_size=40, max_size=40),
       st.integers(0, 4))
def test_zip_by_rank_matches_rule(spark, sides, words, limit):
    rows = list(zip(sides, words[:len(sides)]))
    df = spark.createDataFrame(rows, "side string, w string")
    counts = df.groupBy("side", "w").count()
    got = [tuple(r) for r in ranking.zip_by_rank(counts, "side", ["s1", "s2"], "w", "count", limit).orderBy("id").collect()]

    def ranked(side):
        c = Counter(w for s, w in rows if s == side)
        return sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:limit + 1]
    a, b = ranked("s1"), ranked("s2")
    exp = [(a[i][0], a[i][1], i, b[i][0], b[i][1]) for i in range(min(len(a), len(b)))]
    assert got == exp


big = 2 ** 63


@FAST
@given(st.lists(st.tuples(st.sampled_from(["p", "q"]),
                          st.one_of(st.none(), st.sampled_from([-big, -5, 0, 3, 7, big - 1]))),
                min_size=1, max_size=30))
def test_total_and_mode_integral_keys_packed(spark, rows):
    from sparkops.plans.inspect import physical_plan
    df = spark.createDataFrame(rows, "g string, v bigint")
    out = agg.total_and_mode(df, "g", "v", "t", "m", "c")
    assert "SortAggregate" not in physical_plan(out)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    exp = []
    for g in {r[0] for r in rows}:
        vals = [r[1] for r in rows if r[0] == g]
        cnt = Counter(vals)
        best = min(cnt, key=lambda v: (-cnt[v], v is None, v if v is not None else 0))
        exp.append((g, len(vals), best, cnt[best]))
    assert got == sorted(exp, key=str)


@FAST
@given(st.lists(st.tuples(st.sampled_from(["p", "q", "r"]), st.one_of(st.none(), st.integers(-3, 3))),
                min_size=1, max_size=30))
def test_mode_by_group_ignores_nulls(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int")
    got = sorted((tuple(r) for r in agg.mode(df, "v", "m", "c", by="g").collect()), key=str)
    exp = []
    for g in {r[0] for r in rows}:
        cnt = Counter(r[1] for r in rows if r[0] == g and r[1] is not None)
        if cnt:
            best = min(cnt, key=lambda v: (-cnt[v], v))
            exp.append((g, best, cnt[best]))
    assert got == sorted(exp, key=str)


@FAST
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=30), st.integers(1, 4))
def test_top_groups_nulls_lose_ties(spark, values, k):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [tuple(r) for r in agg.top_groups(df, "v", k).collect()]
    cnt = Counter(values)
    exp = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or 0))[:k]
    assert got == exp


@FAST
@given(st.lists(st.tuples(st.integers(0, 20), st.one_of(st.none(), st.sampled_from([1.5, 2.0, -3.0, 2.0]))),
                min_size=1, max_size=25))
def test_extreme_records_matches_rule(spark, rows):
    df = spark.createDataFrame(rows, "k int, p double")
    got = sorted(tuple(r) for r in agg.extreme_records(df, "p", "k", ["k", "p"]).collect())
    valid = [r for r in rows if r[1] is not None]
    exp = []
    if valid:
        hi = min(valid, key=lambda r: (-r[1], r[0]))
        lo = min(valid, key=lambda r: (r[1], r[0]))
        exp = sorted([("max", hi[0], hi[1]), ("min", lo[0], lo[1])])
    assert got == exp
