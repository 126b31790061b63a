"""Readers, writers and shaping helpers on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from sparkops.operators import shape
from sparkops.sources import readers, writers


def test_parse_csv_lines_quotes_header_and_bad_cells(spark, write_text):
    p = write_text("lines.txt", "\n".join([
        "id,host,bytes",
        '1,"a, b",10',
        "2,plain,not-a-number",
        '3,"with ""quote""",7',
        "4,short",
    ]))
    out = readers.parse_csv_lines(readers.read_lines(spark, p), "id BIGINT, host STRING, bytes INT",
                                  header_value="id", escape='"')
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "a, b", 10), (2, "plain", None), (3, 'with "quote"', 7), (4, "short", None)]


def test_decode_json_lines_rejects_and_defaults(spark, write_text):
    p = write_text("j.txt", "\n".join([
        '{"a": "x", "n": 1}', '{"a": "y"}', "{broken", '{"a": "z", "n": "text"}', "", '{"n": 5}',
    ]))
    lines = readers.read_lines(spark, p)
    out = readers.decode_json_lines(lines, "a STRING, n INT", defaults={"n": 0})
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([("x", 1), ("y", 0), (None, 5)], key=str)


def test_decode_json_lines_parses_each_line_once(spark, write_text):
    from sparkops.plans.inspect import physical_plan
    p = write_text("j2.txt", '{"a": "x"}\n')
    out = readers.decode_json_lines(readers.read_lines(spark, p), "a STRING, b INT, c INT")
    assert physical_plan(out).count("from_json(") == 1


def test_load_accounting(spark, write_text):
    p = write_text("acc.txt", ",header\n1,a\n,b\n2,c\n")
    assert tuple(readers.load_accounting(readers.read_lines(spark, p)).first()) == (4, 2, 2)


def test_read_tagged_is_one_table(spark, write_text):
    a = write_text("a.csv", "x,1\ny,2\n")
    b = write_text("b.csv", "z,3\n")
    df = readers.read_tagged(spark, {"A": a, "B": b}, tag="src", schema="k STRING, v INT")
    from sparkops.plans.inspect import physical_plan
    assert physical_plan(df).count("FileScan") == 1
    assert sorted(tuple(r) for r in df.collect()) == [("x", 1, "A"), ("y", 2, "A"), ("z", 3, "B")]


def test_multiline_csv_cells(spark, write_text):
    p = write_text("m.csv", 'id,text\n1,"line one\nline two"\n2,"a ""quoted"" word"\n')
    df = readers.read_csv(spark, p, schema="id INT, text STRING", multiline=True)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "line one\nline two"), (2, 'a "quoted" word')]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_write_table_overwrites(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    df = spark.range(5).select(F.col("id").cast("int").alias("id"))
    writers.write_table(df, path, fmt)
    writers.write_table(df, path, fmt)
    reader = {"parquet": lambda: spark.read.parquet(path), "json": lambda: spark.read.schema("id INT").json(path),
              "csv": lambda: spark.read.schema("id INT").csv(path)}[fmt]
    assert sorted(r.id for r in reader().collect()) == [0, 1, 2, 3, 4]


def test_local_rows_names_by_position(spark):
    df = readers.local_rows(spark, [(1, "a"), (2, "b")], ["num", "letter"])
    assert df.columns == ["num", "letter"] and df.count() == 2


def test_conform_casts_orders_and_requires(spark):
    df = spark.createDataFrame([("7", "x", "1.5"), ("bad", "y", "2"), (None, "z", "3")], "B string, a string, c string")
    out = shape.conform(df, "a STRING, b INT, c DOUBLE", required=["b"])
    assert out.columns == ["a", "b", "c"]
    assert [tuple(r) for r in out.collect()] == [("x", 7, 1.5)]


def test_fill_text_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None)], "s string, n int")
    assert tuple(shape.fill_text(df, "n/a", ["s", "n"]).first()) == ("n/a", None)


def test_add_constants_single_projection(spark):
    from sparkops.plans.inspect import physical_plan
    df = shape.add_constants(spark.range(3), 10)
    assert df.columns == ["id"] + [f"col_{i}" for i in range(1, 11)]
    assert physical_plan(df).count("Project") == 1


def test_scale_conf_sizes_partitions():
    from sparkops.session import scale_conf
    conf = scale_conf(10**14, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-10**14 // (256 << 20))
    assert scale_conf(10**6, 16)["spark.sql.shuffle.partitions"] == "32"


def test_exact_averages(spark):
    import decimal
    from sparkops.operators import aggregate as agg
    df = spark.createDataFrame([(1, "t1", "a"), (2, "t1", "b"), (4, "t2", "a")], "v int, tx string, p string")
    assert tuple(agg.numeric_stats(df, "v").first()) == (7, 2, 4, 1)
    assert agg.numeric_stats(df, "v", exact=True).first().average == pytest.approx(7 / 3)
    assert agg.basket_summary(df, "tx", "p").first().avg_transaction == decimal.Decimal("1.0")
    assert agg.basket_summary(df, "tx", "p", exact=True).first().avg_transaction == decimal.Decimal("1.5")
    assert agg.basket_summary(df, "tx", "p", scale=2, exact=True, by="tx").orderBy("tx").collect()[0][2] == \
        decimal.Decimal("2.00")


def test_read_tagged_folders_and_odd_names(spark, tmp_path):
    paths = {}
    for tag in ("a b", "ä%20x"):
        paths[tag] = str(tmp_path / tag)
        spark.createDataFrame([(tag,), ("x",)], "value string").write.text(paths[tag])
    got = sorted(tuple(r) for r in readers.read_tagged(spark, paths).collect())
    assert got == sorted([("a b", "a b"), ("x", "a b"), ("ä%20x", "ä%20x"), ("x", "ä%20x")])


def test_separators_are_literal(spark, write_text):
    from sparkops.functions import text
    p = write_text("pipe.txt", 'id|x\n1|"a|b"\n|c\n')
    lines = readers.read_lines(spark, p)
    out = readers.parse_csv_lines(lines, "id INT, x STRING", sep="|", header_value="id")
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(1, "a|b"), (None, "c")]
    assert tuple(readers.load_accounting(lines, sep="|").first()) == (3, 2, 1)
    df = spark.createDataFrame([("12.5",), ("9,999,999,999 reviews",)], "s string")
    assert [r[0] for r in df.select(text.leading_int("s", ".")).collect()][0] == 12
    assert [r[0] for r in df.select(text.leading_int("s")).collect()][1] == 9_999_999_999


def test_lines_of_any_width(spark, write_text):
    wide = "7," + ",".join(["x"] * 100_000)
    quoted = "8," + ",".join(['"q,q"'] * 100_000)
    long = '9,"' + "long " * 200_000 + '",z'
    lines = readers.read_lines(spark, write_text("wide.txt", "\n".join([wide, quoted, long])))
    for keep_quotes in (False, True):
        out = readers.parse_csv_lines(lines, "id INT, a STRING, b STRING", keep_quotes=keep_quotes)
        got = {r.id: r for r in out.collect()}
        assert (got[7].a, got[7].b) == ("x", "x")
        assert got[8].b == ('"q,q"' if keep_quotes else "q,q")
        assert got[9].b == "z" and len(got[9].a.strip('" ')) == 999_999
    cells = [r[0] for r in lines.select(readers.first_cell("value")).collect()]
    assert cells == ["7", "8", "9"]


def test_first_cell(spark):
    df = spark.createDataFrame([('"a, b",c',), ('"say \\"hi\\"",x',), ("plain, x",), ('"open, x',), ('"a"b,c',), ("",), (None,)],
                               "v string")
    assert [r[0] for r in df.select(readers.first_cell("v")).collect()] == [
        "a, b", 'say "hi"', "plain", '"open', '"a"b', "", None]


def test_unpaired_quotes_split_by_what_follows(spark):
    lines = ['a"b,c,d', '"a,b",c"d,e', 'x,"y,z']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = readers.parse_csv_lines(df, "a STRING, b STRING, c STRING", keep_quotes=True)

    def cells(line):
        found, start = [], 0
        for i, ch in enumerate(line):
            if ch == "," and line[i + 1:].count('"') % 2 == 0:
                found.append(line[start:i])
                start = i + 1
        return tuple((found + [line[start:], None, None])[:3])
    assert [tuple(r) for r in out.collect()] == [cells(x) for x in lines]


def test_csv_keeps_blanks_empty_text_and_null(spark, tmp_path):
    path = str(tmp_path / "blank")
    rows = [(1, " pad "), (2, ""), (3, None), (4, "q,uo te"), (5, "\ttab")]
    writers.write_table(spark.createDataFrame(rows, "k int, v string"), path, "csv")
    back = readers.read_csv(spark, path, schema="k INT, v STRING", header=False, empty_as_null=False)
    assert sorted(tuple(r) for r in back.collect()) == rows
    plain = readers.read_csv(spark, path, schema="k INT, v STRING", header=False)
    assert {r.k: r.v for r in plain.collect()}[2] is None


def test_extreme_records_of_any_type(spark):
    import datetime as dt
    from sparkops.operators import aggregate as agg
    nan = float("nan")
    rows = [(1, "b", dt.date(2020, 1, 1), 1.0), (2, "a", dt.date(2021, 1, 1), nan), (3, "c", None, -2.0),
            (4, None, dt.date(2021, 1, 1), None)]
    df = spark.createDataFrame(rows, "k int, s string, d date, x double")
    for c, high, low in (("s", 3, 2), ("d", 2, 1), ("x", 2, 3)):
        assert {(r.kind, r.k) for r in agg.extreme_records(df, c, "k", ["k"]).collect()} == {("max", high), ("min", low)}


def test_word_ranks_beyond_int(spark):
    from sparkops.operators import ranking
    df = spark.createDataFrame([("a", "w", 3_000_000_000), ("b", "v", 1)], "side string, w string, n bigint")
    got = [tuple(r) for r in ranking.zip_by_rank(df, "side", ["a", "b"], "w", "n").collect()]
    assert got == [("w", 3_000_000_000, 0, "v", 1)]


def test_session_keeps_what_was_configured(spark):
    from sparkops.session import get_session
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        assert get_session(None).conf.get("spark.sql.shuffle.partitions") == "500"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
