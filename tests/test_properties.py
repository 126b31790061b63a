"""Properties: salted joins equal plain joins, the band-join average equals
the brute-force pair average, helpers agree with plain-Python references,
round trips keep data, and accounting adds up."""

import calendar
import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from sparkops.functions import dates, text
from sparkops.operators import aggregate as agg
from sparkops.operators import joins, ranking
from sparkops.plans.queries import QUERIES, table

FAST = settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [1, 4, 32])
def test_salted_join_equals_plain_join(spark, n):
    ev = table(spark, SF001, "events")
    big = ev.select("event_id", "event_type", "user_id")
    small = ev.filter(F.col("event_id") % 3 == 0).select("event_type", "user_id", F.col("value").alias("v"))
    plain = big.join(small, ["event_type", "user_id"])
    salted = joins.salted_join(big, small, ["event_type", "user_id"], "event_id", n)
    assert sorted_rows(salted.select(*plain.columns)) == sorted_rows(plain)


@pytest.mark.parametrize("n,share", [(8, 0.01), (32, 0.001), (32, 0.5)])
def test_hot_key_salting_equals_plain_join_under_skew(spark, n, share):
    ev = table(spark, SF0001, "events")
    # a third of all rows share one key
    big = ev.select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("k"))
    small = ev.filter(F.col("event_id") % 5 == 0).select(
        F.when(F.col("event_id") % 2 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("k"), F.col("value").alias("v"))
    hot = [r.k for r in joins.hot_keys(big, "k", share).collect()]
    assert len(hot) <= 1 / share
    if share < 0.3:
        assert 0 in hot
    plain = big.join(small, "k")
    salted = joins.salted_join(big, small, "k", "event_id", n, hot_share=share)
    assert sorted_rows(salted.select(*plain.columns)) == sorted_rows(plain)


@pytest.mark.parametrize("band,salt_n,share", [(1, 1, None), (1, 4, None), (1, 32, None), (1, 32, 0.001),
                                               (1, 8, 0.2), (0, 8, 0.001), (2, 3, None), (0.5, 4, 0.01)])
def test_band_avg_join_equals_brute_force(spark, band, salt_n, share):
    ev = table(spark, SF0001, "events")
    left = ev.select("event_id", "event_type", "user_id",
                     ((F.col("event_id") % 9) / F.lit(2.0) if band == 0.5 else F.col("event_id") % 5).alias("lvl"))
    right = ev.select("event_type", "user_id",
                      ((F.col("event_id") % 7) / F.lit(2.0) if band == 0.5 else F.col("event_id") % 7).alias("lvl"),
                      F.when(F.col("event_id") % 11 == 0, None).otherwise(F.round(F.col("value") * 100).cast("bigint")).alias("p"))
    got = joins.band_avg_join(left, right, ["event_type", "user_id"], "lvl", "lvl", "event_id", "p",
                              band=band, salt_n=salt_n, hot_share=share)
    a, b = left.alias("a"), right.alias("b")
    brute = (a.join(b, (F.col("a.event_type") == F.col("b.event_type")) & (F.col("a.user_id") == F.col("b.user_id")))
             .filter(F.abs(F.col("a.lvl") - F.col("b.lvl")) <= band)
             .groupBy(F.col("a.event_id").alias("id")).agg(F.avg("b.p").alias("avg")))
    g = {r.id: r.avg for r in got.collect()}
    e = {r.id: r.avg for r in brute.collect()}
    assert g.keys() == e.keys()
    for k, v in e.items():
        assert (g[k] is None and v is None) or g[k] == pytest.approx(v, rel=1e-12)


def test_total_and_mode_matches_pandas(spark):
    o = table(spark, SF0001, "orders").select("o_orderpriority", "o_custkey")
    got = sorted_rows(agg.total_and_mode(o, "o_orderpriority", "o_custkey", "t", "k", "c"))
    pdf = o.toPandas()
    exp = []
    for g, part in pdf.groupby("o_orderpriority"):
        vc = part["o_custkey"].value_counts()
        best = min(vc[vc == vc.max()].index)
        exp.append((g, len(part), int(best), int(vc.max())))
    assert got == sorted(exp)


def test_top_per_group_matches_sort(spark):
    li = table(spark, SF0001, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    got = ranking.top_per_group(li, "l_returnflag", [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 4)
    pdf = li.toPandas().sort_values(["l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber"],
                                    ascending=[True, False, True, True])
    exp = pdf.groupby("l_returnflag").head(4)
    assert sorted((r.l_returnflag, r.l_orderkey, r.l_linenumber) for r in got.collect()) == \
        sorted(zip(exp.l_returnflag, exp.l_orderkey, exp.l_linenumber))


def test_load_accounting_adds_up(spark):
    r = QUERIES["load_accounting"](spark, SF001).first()
    assert r.loaded + r.skipped == r.total


@pytest.mark.parametrize("name", ["parquet_roundtrip", "json_roundtrip", "csv_roundtrip", "csv_scan_typed"])
def test_roundtrips_keep_every_row(spark, name):
    src = {"parquet_roundtrip": "customer", "json_roundtrip": "nation", "csv_roundtrip": "region",
           "csv_scan_typed": "part"}[name]
    assert QUERIES[name](spark, SF001).count() == table(spark, SF001, src).count()


def period_years(start: dt.date, end: dt.date) -> int:
    """Whole years of the calendar period from start to end (reference rule)."""
    months = (end.year * 12 + end.month) - (start.year * 12 + start.month)
    days = end.day - start.day
    if months > 0 and days < 0:
        months -= 1
    elif months < 0 and days > 0:
        months += 1
    return int(months / 12)


def test_period_years_reference_rule():
    assert period_years(dt.date(2020, 2, 29), dt.date(2021, 2, 28)) == 0
    assert period_years(dt.date(2020, 2, 29), dt.date(2021, 3, 1)) == 1
    assert period_years(dt.date(2021, 3, 15), dt.date(2020, 1, 1)) == -1


@FAST
@given(st.lists(st.tuples(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)),
                          st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31))), min_size=1, max_size=40))
def test_whole_years_matches_reference_rule(spark, pairs):
    df = spark.createDataFrame(pairs, "s date, e date")
    got = [r.y for r in df.select(dates.whole_years("s", "e").alias("y")).collect()]
    assert got == [period_years(s, e) for s, e in pairs]


def ref_leading_int(s):
    if s is None:
        return None
    tok = re.sub(r"[^A-Za-z0-9_]+", "", s.split(" ")[0])
    if re.fullmatch(r"[0-9]+", tok) and int(tok) <= 2**63 - 1:
        return int(tok)
    return None


@FAST
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 ,.-_abcXé+", max_size=14)), min_size=1, max_size=40))
def test_leading_int_matches_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.n for r in df.select(text.leading_int("s").alias("n")).collect()]
    assert got == [ref_leading_int(v) for v in values]


@FAST
@given(st.lists(st.one_of(st.none(), st.text(alphabet="biItTBx ", max_size=6)), min_size=1, max_size=30))
def test_prefix_any_matches_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.m for r in df.select(text.prefix_any("s", ["BI", "it"]).alias("m")).collect()]
    assert got == [v is not None and (v.lower().startswith("bi") or v.lower().startswith("it")) for v in values]


@FAST
@given(st.lists(st.dates(dt.date(1970, 1, 1), dt.date(2100, 12, 31)), min_size=1, max_size=30),
       st.sampled_from(list(dates.DEFAULT_DATE_FORMATS) + ["dd/MM/yyyy"]))
def test_parse_date_any_reads_every_default_format(spark, days, fmt):
    as_of = dt.date(2000, 1, 1)
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.p for r in df.select(dates.parse_date_any(F.date_format("d", fmt), as_of=F.lit(as_of)).alias("p")).collect()]
    if fmt == "dd/MM/yyyy":  # not in the default list -> as_of
        assert got == [as_of] * len(days)
    else:
        assert got == days


def test_weekday_names_monday_first(spark):
    monday = dt.date(2024, 1, 1)
    days = [monday + dt.timedelta(days=i) for i in range(7)]
    assert calendar.weekday(2024, 1, 1) == 0
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.n for r in df.select(dates.weekday_name("d").alias("n")).collect()] == list(dates.RU_WEEKDAYS)


def test_month_of_requires_three_parts(spark):
    df = spark.createDataFrame([("2018-02-11",), ("2018-03",), ("",), (None,)], "d string")
    assert [r.m for r in df.select(dates.month_of("d").alias("m")).collect()] == ["02", None, None, None]


def test_replicate_tags_every_copy(spark):
    r = joins.replicate(table(spark, SF001, "region"), 4, "salt")
    assert sorted_rows(r.groupBy("salt").count()) == [(i, 5) for i in range(4)]


def test_mode_per_group_matches_pandas(spark):
    o = table(spark, SF0001, "orders").select("o_orderstatus", "o_custkey")
    got = sorted_rows(agg.mode(o, "o_custkey", "best", "n", by="o_orderstatus"))
    pdf = o.toPandas()
    exp = []
    for g, part in pdf.groupby("o_orderstatus"):
        vc = part["o_custkey"].value_counts()
        exp.append((g, int(min(vc[vc == vc.max()].index)), int(vc.max())))
    assert got == sorted(exp)


def test_lookup_filter_is_a_semi_join(spark):
    from sparkops.plans.inspect import physical_plan
    li = table(spark, SF0001, "lineitem").select("l_orderkey", "l_suppkey")
    supp = table(spark, SF0001, "supplier")
    dup = supp.union(supp)  # duplicated dimension rows must not duplicate facts
    out = joins.lookup_filter(li, dup, F.col("s_nationkey") < 5, F.col("l_suppkey") == F.col("s_suppkey"))
    keep = {r.s_suppkey for r in supp.filter(F.col("s_nationkey") < 5).collect()}
    assert out.count() == li.filter(F.col("l_suppkey").isin(list(keep))).count()
    assert "LeftSemi" in physical_plan(out)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salted_join_outer_variants_equal_plain(spark, how):
    ev = table(spark, SF0001, "events")
    big = ev.select("event_id", (F.col("event_id") % 50).alias("k"))
    small = ev.filter(F.col("event_id") % 3 == 0).select((F.col("event_id") % 40).alias("k"), F.col("value").alias("v"))
    plain = big.join(small, "k", how)
    for share in (None, 0.01):
        salted = joins.salted_join(big, small, "k", "event_id", 8, how=how, hot_share=share)
        assert sorted_rows(salted.select(*plain.columns)) == sorted_rows(plain)


def test_salted_join_follows_the_partitions_by_default(spark):
    ev = table(spark, SF0001, "events")
    key = F.when(F.col("event_id") % 3 == 0, F.lit(0)).when(F.col("event_id") % 7 != 0, F.col("user_id"))
    big = ev.select("event_id", key.cast("bigint").alias("k"))
    small = ev.filter("event_id % 5 = 0").selectExpr("cast(user_id as bigint) AS k", "value AS v")
    small = small.union(ev.limit(3).selectExpr("0L", "value"))
    hot = {r.k: r["_copies"] for r in joins.hot_keys(big, "k").collect()}
    assert hot[0] >= 3 and None not in hot  # a third of the rows, over 8 partitions
    assert sorted_rows(joins.salted_join(big, small, "k", "event_id").select("k", "event_id", "v")) == \
        sorted_rows(big.join(small, "k").select("k", "event_id", "v"))
    with pytest.raises(ValueError):
        joins.hot_keys(big, "k", 0)


def test_salted_join_rejects_right_and_full(spark):
    df = spark.range(3)
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            joins.salted_join(df, df, "id", "id", 4, how=how)


@FAST
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 +-.x\t\n\x01eE_", max_size=12),
                          st.integers(-2**63, 2**63 - 1).map(str)), min_size=1, max_size=40))
def test_conform_guarded_int_cast_equals_try_cast(spark, values):
    from sparkops.operators import shape
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for t in ("int", "bigint", "smallint"):
        got = [r.s for r in shape.conform(df, f"s {t}").collect()]
        exp = [r.s for r in df.select(F.col("s").try_cast(t).alias("s")).collect()]
        assert got == exp


@FAST
@given(st.lists(st.one_of(
    st.none(),
    st.text(alphabet="0123456789- /+", max_size=12),
    st.builds(lambda y, m, d, sep: f"{y}{sep}{m}{sep}{d}",
              st.integers(0, 12000).map(str), st.sampled_from(["05", "5", "May", "may", "MAY", "Sept", "13"]),
              st.sampled_from(["25", "5", "31", "30", "x"]), st.sampled_from(["-", " ", "/"]))),
    min_size=1, max_size=40))
def test_date_parse_guard_changes_nothing(spark, values):
    from sparkops.functions.dates import DEFAULT_DATE_FORMATS, _try_date
    df = spark.createDataFrame([(v,) for v in values], "s string")
    fmts = list(DEFAULT_DATE_FORMATS) + ["dd/MM/yyyy"]
    cols = []
    for i, f in enumerate(fmts):
        cols += [F.try_to_date("s", f).alias(f"raw{i}"), _try_date(F.col("s"), f).alias(f"g{i}")]
    for r in df.select(*cols).collect():
        for i in range(len(fmts)):
            assert r[f"raw{i}"] == r[f"g{i}"]
