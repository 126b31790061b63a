"""The forms of the operators for inputs of any size: splittable multi-line CSV,
distributed ranks, heavy hitters, bitmaps, strict JSON, pruned and bucketed storage,
run-time filters, accounting on the way, mergeable states, partial overwrite."""

import contextlib
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F, types as T

from conftest import SF001
from sparkops.operators import (bitmap_counts, build_bitmaps, group_state, heavy_groups, merge_bitmaps, merge_states, rank_rows,
                                state_stats, top_groups, zip_all_ranks)
from sparkops.operators.heavy import error_share
from sparkops.plans.inspect import exchange_count, metric_total, physical_plan
from sparkops.plans.queries import QUERIES, table
from sparkops.session import scale_conf
from sparkops.sources import (decode_json_strict, load_lines, read_csv, read_csv_records, read_lines, write_bucketed,
                              write_partitions)


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): str(v) for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_splits(spark, size):
    return settings(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=0,
                    spark__sql__files__minPartitionNum=1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- S6, S9: multi-line CSV over many splits

def csv_text(rng, rows, end):
    cells = ["", "plain", "a,b", 'say ""hi""', "two\nlines", "\n\n", "x" * 90, 'mixed\n""q"",\nend', " blanks ", "é日\n本",
             "win\r\nline", '""']
    out = ["id,text,note"]
    for i in range(rows):
        quoted = [f'"{rng.choice(cells)}"' for _ in range(2)]
        if rng.random() < 0.3:
            quoted[rng.randrange(2)] = rng.choice(["bare", "", "4.5", "n/a"])
        out.append(f"{i},{quoted[0]},{quoted[1]}")
        if rng.random() < 0.1:
            out.append("")
    return end.join(out) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("seed,size,end", [(0, 64, "\n"), (1, 37, "\n"), (2, 200, "\r\n"), (3, 64, "\r\n"), (4, 100_000, "\n")])
def test_split_csv_equals_whole_file_reader(spark, tmp_path, seed, size, end):
    rng = random.Random(seed)
    for k in range(2):
        (tmp_path / f"part{k}.csv").write_bytes(csv_text(rng, 40, end).encode())
    schema = "id INT, text STRING, note STRING"
    for nulls in (True, False):
        want = rows_of(read_csv(spark, str(tmp_path), schema=schema, multiline=True, empty_as_null=nulls))
        with small_splits(spark, size):
            assert rows_of(read_csv_records(spark, str(tmp_path), schema, empty_as_null=nulls)) == want
    assert len(want) == 80


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.csv"
    body = "".join(f'{i},"line {i}\n""more"" of it,\n"\n' for i in range(500))
    path.write_text("id,text\n" + body)
    with small_splits(spark, 1000), settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 10
        df = read_csv_records(spark, str(path), "id INT, text STRING")
        got = df.collect()
        assert sorted(tuple(r) for r in got) == [(i, f'line {i}\n"more" of it,\n') for i in range(500)]
        final = physical_plan(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan text") == 1 and "ReusedExchange" in final  # splits and records come of one scan
        assert metric_total(df, "FileSourceScanExec", "numOutputRows") == 1501


def test_cell_over_many_splits_header_only_and_no_header(spark, tmp_path):
    long = "\n".join(f"row {i}" for i in range(300))
    (tmp_path / "a.csv").write_text(f'1,"{long}"\n2,"x\ny"\n')
    (tmp_path / "b.csv").write_text("﻿id,text\n")
    (tmp_path / "c.csv").write_text("")
    with small_splits(spark, 50):
        assert rows_of(read_csv_records(spark, str(tmp_path / "a.csv"), "id INT, text STRING", header=False)) == [(1, long), (2, "x\ny")]
        assert rows_of(read_csv_records(spark, [str(tmp_path / f"{c}.csv") for c in "bc"], "id INT, text STRING")) == []


# --- JN7: ranks

@pytest.mark.parametrize("seed", range(3))
def test_rank_rows(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(40), f"w{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, n int, w string").repartition(7)
    got = {(r.g, r.w): r["rank"] for r in rank_rows(df, "g", [F.desc("n"), F.asc("w")], block=2).collect()}
    for g in ("a", "b", None):
        own = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))
        assert [got[g, w] for _, _, w in own] == list(range(1, len(own) + 1))
    assert len(got) == 400
    whole = rank_rows(df, [], [F.col("w")]).orderBy("w").collect()
    assert [r["rank"] for r in whole] == list(range(1, 401))
    assert rank_rows(df.where("false"), "g", [F.col("n")]).collect() == []


def test_full_zip_has_no_window_over_a_side(spark):
    df = QUERIES["full_rank_zip"](spark, SF001)
    plan = physical_plan(df)
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_block#" in line for line in windows), plan  # only over blocks of parts
    assert "SinglePartition" not in plan and "Exchange SinglePartition" not in plan
    counts = spark.createDataFrame([("x", "a", 3), ("x", "b", 3), ("x", "c", 1), ("y", "d", 9), ("y", None, 2), ("z", "q", 1)],
                                   "s string, w string, n long")
    assert rows_of(zip_all_ranks(counts, "s", ["x", "y"], "w", "n")) == [("a", 3, 0, "d", 9), ("b", 3, 1, None, 2)]


# --- R5: heavy hitters

def test_heavy_groups_are_proven_or_counted(spark):
    rng = random.Random(1)
    keys = [rng.choice([1, 1, 2, 2, 3]) if rng.random() < 0.5 else rng.randrange(10, 100_000) for _ in range(30_000)]
    df = spark.createDataFrame([(k if rng.random() < 0.99 else None,) for k in keys], "k int").repartition(6)
    proven = heavy_groups(df, "k", 3)
    assert "scratch/heavy" in physical_plan(proven)
    assert [tuple(r) for r in proven.collect()] == [tuple(r) for r in top_groups(df, "k", 3).collect()]
    flat = spark.range(60_000).select((F.col("id") % 30_000).alias("k"))  # every key twice: nothing is frequent
    counted = heavy_groups(flat, "k", 4, tracked=1000)
    assert "scratch/heavy" not in physical_plan(counted)
    assert [tuple(r) for r in counted.collect()] == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_heavy_groups_small_inputs(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",), (None,)], "k string")
    few = heavy_groups(df, "k", 5)
    assert "scratch/heavy" in physical_plan(few)  # the candidates hold all rows
    assert [tuple(r) for r in few.collect()] == [("a", 2), ("b", 2), (None, 2)]
    assert heavy_groups(df.where("false"), "k", 2).collect() == []
    pairs = df.select(F.struct("k").alias("k"))
    assert heavy_groups(pairs, "k", 1).count() == 1  # counted in full
    with pytest.raises(ValueError):
        heavy_groups(df, "k", 10, tracked=5, candidates=5)
    assert error_share(10_000) == 3.5 / 16384


def test_heavy_groups_shuffle_follows_the_summaries(spark):
    keys = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, -7).otherwise(F.col("id")).alias("k")).repartition(8)
    df = heavy_groups(keys, "k", 1)
    assert [tuple(r) for r in df.collect()] == [(-7, 50_000)]
    assert exchange_count(df) <= 1 and metric_total(df, "ShuffleExchangeExec", "shuffleRecordsWritten") <= 100
    full = top_groups(keys, "k", 1)
    full.collect()
    assert metric_total(full, "ShuffleExchangeExec", "shuffleRecordsWritten") > 300_000


# --- A10: bitmaps

def test_bitmaps(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), rng.choice([None, 0, 1, -1, 32_768, 32_769, -32_768, 10**12, rng.randrange(-10**6, 10**6)]))
            for _ in range(2000)] + [("only nulls", None)]
    days = [spark.createDataFrame(part, "g string, v long") for part in (rows[:900], rows[900:])]
    tables = [build_bitmaps(d, "g", "v") for d in days]
    merged = merge_bitmaps(*tables, by="g")
    want = defaultdict(set)
    for g, v in rows:
        want[g] |= {v} - {None}
    assert {r.g: r["count"] for r in bitmap_counts(merged, "g").collect()} == {g: len(v) for g, v in want.items()}
    assert bitmap_counts(merged).first()[0] == len(set().union(*want.values()))
    assert bitmap_counts(tables[0].where("false")).first()[0] == 0
    plan = physical_plan(tables[0])
    assert "partial_bitmap_construct_agg" in plan


# --- S10: strict JSON

def test_strict_json(spark, write_text):
    good = ['{"id": 1, "s": "x", "n": 5, "d": 1, "b": true, "dec": 1.25, "list": [1, 2], "o": {"p": "q"}}',
            '{"id": 2}', '{"id": 3, "s": null, "n": null}', '{"n": 6.0, "id": 4, "extra": [1]}', '{"id": 5, "s": "", "d": 2.5e3}', "{}",
            '{"id": 9007199254740993, "S": "other case"}']
    bad = ['{"id": 10, "s": 7}', '{"id": 11, "n": "5"}', '{"id": 12, "n": 5.5}', '{"id": 13, "n": 3000000000}', '{"id": 14, "b": "true"}',
           '{"id": 15, "d": "1"}', '{"id": 16', "[1]", "17", "null", "", '{"id": 18, "s": ["x"]}', '{"id": 19, "list": "no"}',
           '{"id": 99999999999999999999}', '{"id": 20, "o": 5}', '{"id": 21, "s": {"t": 1}}']
    p = write_text("strict.txt", "\n".join(good + bad))
    schema = "id BIGINT, s STRING, n INT, d DOUBLE, b BOOLEAN, dec DECIMAL(6,2), list ARRAY<INT>, o STRUCT<p: STRING>"
    df = decode_json_strict(read_lines(spark, p), schema, defaults={"n": 0})
    got = {r.id: r for r in df.collect()}
    assert set(got) == {1, 2, 3, 4, 5, None, 9007199254740993} and df.count() == len(good)
    assert (got[1].s, got[1].n, got[1].d, got[1].b, str(got[1].dec), got[1].list, got[1].o.p) == ("x", 5, 1.0, True, "1.25", [1, 2], "q")
    assert (got[2].n, got[4].n, got[5].s, got[5].d, got[3].s, got[9007199254740993].s) == (0, 6, "", 2500.0, None, None)
    assert df.schema == T.StructType.fromDDL(schema) or [f.dataType for f in df.schema] == [f.dataType for f in T.StructType.fromDDL(schema)]


def test_strict_json_is_parsed_once_and_keeps_columns(spark):
    lines = spark.createDataFrame([(1, '{"a\'b": "x", "c.d": 2}'), (2, "no"), (3, None)], "n int, value string")
    df = decode_json_strict(lines, T.StructType([T.StructField("a'b", T.StringType()), T.StructField("c.d", T.IntegerType())]), keep=["n"])
    assert [tuple(r) for r in df.collect()] == [(1, "x", 2)]
    assert physical_plan(df).count("parseJson(value") == 1, physical_plan(df)


# --- F10, JN6: pruned partitions, run-time filters, buckets

def test_partitions_are_pruned_at_run_time(spark):
    df = QUERIES["pruned_partition_basket"](spark, SF001)
    assert "dynamicpruning" in physical_plan(df)
    df.collect()
    files = metric_total(df, "FileSourceScanExec", "numFiles")
    folders = table(spark, SF001, "supplier").select("s_nationkey").distinct().count()
    assert folders > 10 and files < folders  # one folder, and the files of nation


FILTERS = {"spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": 0,
           "spark__sql__autoBroadcastJoinThreshold": -1, "spark__sql__adaptive__autoBroadcastJoinThreshold": -1}


def test_fact_is_reduced_before_its_shuffle(spark):
    moved, rows = [], []
    for on in ("false", "true"):
        with settings(spark, **FILTERS, spark__sql__optimizer__runtime__bloomFilter__enabled=on):
            df = QUERIES["runtime_filter_join"](spark, SF001)
            rows.append(rows_of(df))
            assert ("might_contain" in physical_plan(df)) == (on == "true")
            moved.append(metric_total(df, "ShuffleExchangeExec", "shuffleRecordsWritten"))
    assert rows[0] == rows[1] and moved[1] < moved[0] / 3, moved


def test_run_time_filters_are_sized_to_the_input():
    conf = scale_conf(10**14, 8000)
    at = "spark.sql.optimizer.runtime.bloomFilter."
    assert conf[at + "creationSideThreshold"] == str(10**12) and int(conf[at + "maxNumBits"]) <= 16 * 8 * (1 << 20)


def test_buckets_need_no_exchange(spark, tmp_path):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        df = QUERIES["bucketed_joins"](spark, SF001)
        assert exchange_count(df) == 0 and physical_plan(df).count("Bucketed: true") == 3, physical_plan(df)
        rows = [(i % 50 if i % 7 else None, i) for i in range(500)]
        a = write_bucketed(spark.createDataFrame(rows, "k long, v long"), str(tmp_path / "a"), "k", 4)
        b = write_bucketed(spark.createDataFrame([(i, i * i) for i in range(60)], "k long, w long"), str(tmp_path / "b"), "k", 4)
        joined = a.join(b, "k")
        assert exchange_count(joined) == 0
        assert rows_of(joined) == sorted([(k, v, k * k) for k, v in rows if k is not None], key=repr)
        assert len([f for f in os.listdir(tmp_path / "b") if f.endswith(".parquet")]) <= 4


# --- S13: accounting during the load

def test_load_lines_counts_on_the_way(spark, write_text, tmp_path):
    p = write_text("logs.txt", ',host\n1,"a, b"\n"",x\n"2",y\n,z\n3\n')
    loaded, counts = load_lines(read_lines(spark, p), "id BIGINT, host STRING", str(tmp_path / "out"))
    assert counts == {"total": 6, "loaded": 3, "skipped": 3}
    assert rows_of(loaded) == [(1, "a, b"), (2, "y"), (3, None)]
    _, none = load_lines(read_lines(spark, write_text("empty.txt", "")), "id BIGINT", str(tmp_path / "none"))
    assert none == {"total": 0, "loaded": 0, "skipped": 0}


def test_quoted_header_is_dropped(spark, write_text):
    from sparkops.sources import load_accounting, parse_csv_lines
    lines = read_lines(spark, write_text("h.txt", '"id",v\n1,a\n"",b\n'))
    assert rows_of(parse_csv_lines(lines, "id BIGINT, v STRING", header_value="id")) == [(1, "a"), (None, "b")]
    assert tuple(load_accounting(lines).first()) == (3, 2, 1)


# --- A12, A14: states; K1-K3: partial overwrite

@pytest.mark.parametrize("seed", range(3))
def test_states_of_parts_make_the_whole(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-5, 50)])) for _ in range(300)] + [("nothing", None)]
    whole = spark.createDataFrame(rows, "g string, v long")
    parts = [spark.createDataFrame(rows[i::4], "g string, v long") for i in range(4)]
    merged = merge_states("g", *[group_state(p, "g", "v") for p in parts])
    assert rows_of(merged) == rows_of(group_state(whole, "g", "v"))
    stats = {r.g: r for r in state_stats(merged, "g").collect()}
    own = [v for g, v in rows if g == "a" and v is not None]
    assert (stats["a"].total, stats["a"]["count"], stats["a"].average) == (sum(own), len(own), sum(own) / len(own))
    assert stats["nothing"].average is None and stats["nothing"]["count"] == 0
    total = merge_states([], merged).first()
    assert total._count == sum(v is not None for _, v in rows)


def test_overlapping_runs_leave_each_row_once(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = [(f"2024-01-{d:02d}", i) for d in range(1, 8) for i in range(d)]
    df = spark.createDataFrame(rows, "day string, n int")
    read = lambda: Counter((r.day, r.n) for r in spark.read.schema("n int, day string").parquet(path).collect())
    write_partitions(df.where("day <= '2024-01-05'"), path, "day")
    for _ in range(2):  # a repeated run, too
        write_partitions(df.where("day >= '2024-01-04'"), path, "day")
    assert read() == Counter(rows)
    write_partitions(df.where("day = '2024-01-04'").withColumn("n", F.col("n") + 100), path, "day")
    assert read() == Counter([(d, n + 100 * (d == "2024-01-04")) for d, n in rows])
    write_partitions(df.where("day = '2024-01-02'"), path, "day", replace="all")
    assert read() == Counter([("2024-01-02", 0), ("2024-01-02", 1)])
    with pytest.raises(ValueError):
        write_partitions(df, path, "day", replace="some")
