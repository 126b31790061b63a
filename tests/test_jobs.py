"""End-to-end jobs on hand-made fixtures (FIXTURES.md): nulls, ties, quoted
commas, line breaks in cells, undecodable JSON, leap days, bad dates."""

import datetime as dt
import decimal

import pytest

from sparkops import jobs


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_videos(spark):
    data = [("a", "2020-08-11T22:21:49Z", "c1", "2020-08-12T00:00:00Z"),
            ("b", "2020-08-11T14:00:21Z", "c2", "2020-08-12T00:00:00Z")]
    df = jobs.videos(spark, data)
    assert df.columns == ["videoId", "publishedAt", "channelId", "trendingDate"]
    assert rows(df, "videoId") == data


def test_restaurants_nested_schema(spark, write_text):
    p = write_text("r.json", "\n".join([
        '{"average_cost_for_two": 30, "name": "A", "user_rating": {"aggregate_rating": "4.1", "votes": 12}}',
        '{"average_cost_for_two": 10, "name": "B"}',
    ]))
    df = jobs.restaurants(spark, p)
    assert [f.name for f in df.schema.fields][-1] == "user_rating"
    got = rows(df.select("name", "average_cost_for_two", "user_rating.votes", "user_rating.aggregate_rating"), "name")
    # a number in a string field is kept as text; a missing struct is null
    assert got == [("A", 30, "12", "4.1"), ("B", 10, None, None)]


def test_movies_declared_schema_and_parquet(spark, write_text, tmp_path):
    header = ("_c0,show_id,type,title,director,cast,country,date_added,release_year,rating,duration,"
              "listed_in,description,year_added,month_added,season_count")
    p = write_text("movies.csv", "\n".join([
        header,
        '0,s1,Movie,"Title, with comma",Dir,Cast,US,2019-09-09,2019,PG,90,Drama,desc,2019,September,1',
        '1,s2,TV,T2,D2,C2,UK,not-a-date,2018,R,abc,Comedy,d2,2018,May,2',
    ]))
    out = str(tmp_path / "movies_out")
    df = jobs.movies(spark, p, out)
    got = rows(spark.read.parquet(out).select("_c0", "title", "date_added", "duration"), "_c0")
    assert got == [(0, "Title, with comma", dt.date(2019, 9, 9), 90), (1, "T2", None, None)]
    assert len(df.columns) == 16


BIKES = "\n".join([
    "Date,Hour,TEMPERATURE,HUMIDITY,WIND_SPEED,HOLIDAY,FUNCTIONING_DAY",
    "01/12/2017,0,-5.2,37,2.2,Holiday,No",
    "01/12/2017,1,-5.5,38,0.8,Holiday,Yes",
    "02/12/2017,0,1.5,40,1.0,No Holiday,No",
    "02/12/2017,1,3.5,41,1.1,,No",
    "02/12/2017,2,2.0,42,1.2,No Holiday,No",
])


def test_bike_jobs(spark, write_text):
    p = write_text("bikes.csv", BIKES)
    proj = jobs.bike_projection(spark, p)
    assert proj.columns == ["Hour", "TEMPERATURE", "HUMIDITY", "WIND_SPEED"] and proj.count() == 3
    wd = rows(jobs.bike_workday(spark, p), "HOLIDAY", "FUNCTIONING_DAY")
    assert wd == [(None, "No", 1), ("Holiday", "No", 0), ("Holiday", "Yes", 1), ("No Holiday", "No", 1)]
    mm = rows(jobs.bike_min_max(spark, p), "Date")
    assert mm == [("01/12/2017", -5.5, -5.2), ("02/12/2017", 1.5, 3.5)]


def test_mall_income_band_and_half_even(spark, write_text, tmp_path):
    p = write_text("mall.csv", "\n".join([
        "CustomerID,Gender,Age,Annual Income (k$)",
        "1,Male,27,10", "2,Male,28,15", "3,Male,28,16", "4,Female,33,20", "5,Female,34,25",
        "6,Female,33,21", "7,Male,26,99",
    ]))
    out = str(tmp_path / "mall_out")
    got = rows(jobs.mall_income(spark, p, out))
    # ages shifted by 2: 27->29 (out), 28->30, 33->35, 34->36 (out); 15.5 -> 15.5, 20.5 -> 20.5
    assert got == [("Female", 35, 20.5, 0), ("Male", 30, 15.5, 1)]
    assert spark.read.parquet(out).count() == 2


def test_season_word_ranks(spark, write_text, tmp_path):
    s1 = write_text("s1.json", "\n".join(["Hello hello world", "the THE the, ignored after comma", "b a"]))
    s2 = write_text("s2.json", "\n".join(["zeta", "zeta alpha"]))
    out = str(tmp_path / "wc")
    df = jobs.season_word_ranks(spark, {"s1": s1, "s2": s2}, limit=20, out_path=out)
    got = rows(df, "id")
    # s1: the 3, hello 2, a 1, b 1, world 1 ; s2: zeta 2, alpha 1 -> zip stops at the shorter side
    assert got == [("the", 3, 0, "zeta", 2), ("hello", 2, 1, "alpha", 1)]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "bigint", "int", "string", "bigint"]
    assert spark.read.json(out).count() == 2


def test_season_word_ranks_limit_is_inclusive(spark, write_text):
    words = " ".join(f"w{i:02d}" * 1 for i in range(30))
    s1 = write_text("a.txt", words)
    s2 = write_text("b.txt", words)
    df = jobs.season_word_ranks(spark, {"a": s1, "b": s2}, limit=20)
    assert df.count() == 21


def test_shoes(spark, write_text):
    p = write_text("shoes.csv", "\n".join([
        "item_category,item_name,item_after_discount,item_price,percentage_solds,item_rating,item_shipping,buyer_gender",
        "run,A,,100,,,,",
        "run,,50,60,1,2,free,Men",
        ",B,50,60,1,2,free,Men",
        "walk,C,40,,5,3,,Women",
    ]))
    got = rows(jobs.shoes(spark, p), "item_name")
    # item_price and percentage_solds are inferred numeric: the text fill
    # leaves their nulls alone (as Spark's na.fill does)
    assert got == [("run", "A", "100", "100", None, 0, "n/a", "unknown"),
                   ("walk", "C", "40", None, 5, 3, "n/a", "Women")]


def test_job_reviews(spark, write_text):
    p = write_text("jobs.csv", "\n".join([
        "JobTitle,Company,Location,CompanyReviews,Link",
        '"Data\nScientist",Acme,Paris,"2,933 reviews",l1',
        "Data Scientist,Acme,Berlin,100 reviews,l2",
        "Engineer,Beta,Paris,3000 reviews,l3",
        "Engineer,Beta,,10 reviews,l4",
        "Engineer,,Rome,5000 reviews,l5",
        "Analyst,Acme,Rome,,l6",
        "Analyst,Acme,Oslo,abc reviews,l7",
    ]))
    got = rows(jobs.job_reviews(spark, p), "type", "count_type")
    # company totals: Acme 3033, Beta 3010, '' 5000 (excluded) -> Acme; its locations: Paris 2933, Berlin 100, Oslo null
    # job totals: DataScientist 3033, Engineer 8010 -> Engineer; locations Paris 3000, Rome 5000 (null location skipped)
    assert got == [("Acme", "company", "Paris", 2933, "max"), ("Acme", "company", "Berlin", 100, "min"),
                   ("Engineer", "job", "Rome", 5000, "max"), ("Engineer", "job", "Paris", 3000, "min")]


def test_cars(spark, write_text):
    p = write_text("cars.csv", "\n".join([
        "id,price,brand,type,mileage,color,date_of_purchase",
        "1,100,A,suv,10.0,red,2019-05-25",
        "2,100,B,suv,,red,2019 05 25",
        "3,100,C,suv,20.0,red,2019-May-25",
        "4,100,D,suv,30.0,red,2019 May 26",
        "5,100,E,suv,40.0,red,25/05/2019",
        "6,100,F,suv,0.0,red,garbage",
        "7,100,G,suv,0.0,red,",
        "8,100,H,suv,0.0,red,2020-02-29",
        "9,100,I,suv,0.0,red,2021-02-30",
    ]))
    df = jobs.cars(spark, p, as_of="2021-05-25")
    assert "types" in df.columns and "avg_mileage" in df.columns
    got = {r.id: (r.avg_mileage, r.years_since_purchase) for r in df.collect()}
    assert all(v[0] == pytest.approx(100.0 / 9) for v in got.values())
    years = {k: v[1] for k, v in got.items()}
    assert years == {1: 2, 2: 2, 3: 2, 4: 1, 5: 0, 6: 0, 7: 0, 8: 1, 9: 0}


def test_positions(spark, write_text):
    p = write_text("hr.csv", "\n".join([
        "PositionID,Position,Other", "3,BI Developer,x", "1,IT Support,y", "2,Italian Chef,z",
        "3,BI Developer,w", "4,,q", "5,Accountant,r",
    ]))
    assert rows(jobs.positions(spark, p)) == [(1, "IT Support"), (2, "Italian Chef"), (3, "BI Developer")]


def test_pizza_ties_and_csv(spark, write_text, tmp_path):
    p = write_text("pizza.csv", "\n".join([
        "order_id,order_type,address_id", "1,delivery,7", "2,delivery,5", "3,delivery,7", "4,delivery,5",
        "5,pickup,9", "6,delivery,8",
    ]))
    out = str(tmp_path / "pizza_out")
    got = rows(jobs.pizza(spark, p, out), "order_type")
    assert got == [("delivery", 5, 5, 2), ("pickup", 1, 9, 1)]
    back = spark.read.csv(out, schema="order_type STRING, orders_total LONG, address_id INT, orders_cnt LONG")
    assert rows(back, "order_type") == got


def test_avocado(spark, write_text):
    head = "id,date,avgPrice,volume,c4,c5,c6,c7,c8,c9,c10,c11,year,region"
    def line(i, d, p, v, region):
        return f"{i},{d},{p},{v},0,0,0,0,0,0,0,0,2018,{region}"
    p = write_text("avocado.csv", "\n".join([
        head, line(1, "2018-02-11", 1.0, 10.0, "Albany"), line(2, "2018-02-18", 2.0, 20.0, "Albany"),
        line(3, "2018-03-04", 0.5, 30.0, "Boston"), line(4, "", 3.0, 40.0, "Boston"),
        line(5, "2018-03", 1.5, 50.0, "Chicago"), line(6, "2017-12-31", 1.2, 1.005, "Chicago"),
    ]))
    r = jobs.avocado(spark, p)
    assert rows(r["totals"]) == [(3, 3.0, 0.5)]
    # ISO text order: "2018-03" > "2018-02-11" too
    assert sorted(x.id for x in r["after_date"].collect()) == [2, 3, 5]
    assert rows(r["top_month"]) == [("02",)]
    assert dict(rows(r["region_avg_volume"])) == {"Albany": 15.0, "Boston": 35.0, "Chicago": 25.5}


def test_access_log(spark, write_text):
    # 2021-01-04 is a Monday; epoch seconds
    mon, tue = 1609718400, 1609804800
    p = write_text("logs.csv", "\n".join([
        ",host,time,method,url,response,bytes",
        f'1,"a,b",{mon},GET,/x,404,100',
        f"2,h2,{mon + 60},GET,\"/y,z\",200,50",
        f"3,h2,{tue},GET,/x,404,1",
        f"4,h3,{tue},POST,/x,404,2",
        f"5,h2,{tue},GET,/x,500,3",
    ]))
    r = jobs.access_log(spark, p)
    # total, loaded, skipped; bytes, their average, largest, smallest; hosts
    assert rows(r["totals"]) == [(6, 5, 1, 156, 31, 100, 1, 3)]
    assert rows(r["responses"]) == [("404", 3), ("200", 1), ("500", 1)]
    assert rows(r["top_hosts"]) == [("h2", 3), ("a,b", 1), ("h3", 1)]
    assert rows(r["top_weekdays"]) == [("Вторник", 2), ("Понедельник", 1)]


def test_products(spark, write_text):
    p = write_text("products.json", "\n".join([
        '{"uniq_id": "u1", "product_name": "P", "number_of_reviews": 3}',
        "not json at all",
        '{"uniq_id": "u2", "number_of_reviews": "many"}',
        '{"product_name": "no id", "price": 5}',
    ]))
    got = rows(jobs.products(spark, p), "product_name")
    assert got == [("u1", "P", "", "", "", 3), ("", "no id", "", "5", "", 0)]


def test_salary_by_department(spark, write_text):
    p = write_text("emp.csv", "id,city,country,salary,department\n0,London,England,123,IT\n1,Paris,France,,IT\n2,Rome,Italy,10,HR")
    assert rows(jobs.salary_by_department(spark, p), "department") == [("HR", 10.0), ("IT", 123.0)]


def test_freelancer_offers_matches_brute_force(spark, write_text):
    fl = write_text("fl.csv", "\n".join([
        "id,category,city,experienceLevel", "1,a,x,1", "2,a,x,3", "3,a_b,c,2", "4,a,b_c,2", "5,a,,1", "6,b,x,5",
    ]))
    of = write_text("of.csv", "\n".join([
        "category,city,experienceLevel,price", "a,x,0,10", "a,x,1,20", "a,x,2,30", "a,x,3,40", "a,x,5,1000",
        "a_b,c,4,7", "a,b_c,2,8", "a,,1,99", "b,x,6,1", "b,x,6,",
    ]))
    got = dict(rows(jobs.freelancer_offers(spark, fl, of)))
    # brute force: pairs with equal (category, city) and |level diff| <= 1
    assert got == {1: 20.0, 2: 35.0, 4: 8.0, 6: 1.0}


def test_hotel_cancellations(spark, write_text):
    codes = write_text("codes.csv", "id,is_cancelled\n0,no\n1,yes\n2,\n")
    hotels = write_text("hotels.csv", "\n".join([
        "is_canceled,reservation_status", "0,Check-Out", "0,Canceled", "1,Canceled", "1,Check-Out",
        "1,", "2,Canceled", "3,Canceled",
    ]))
    assert rows(jobs.hotel_cancellations(spark, codes, hotels)) == [(2,)]


def test_basket(spark, write_text, tmp_path):
    countries = write_text("cc.csv", "Country,CountryCode\nUnited Kingdom,44\nFrance,33\n")
    tx = write_text("tx.csv", "\n".join([
        "TransactionNo,Date,X,ProductName,A,B,C,CountryCode",
        't1,2018-12-01,x,"Mug, red",1,1,1,44', "t1,2018-12-01,x,Tea,1,1,1,44", "t2,2018-12-01,x,Tea,1,1,1,44",
        't2,2018-12-01,x,"Mug, red",1,1,1,44', "t3,2018-12-01,x,Cup,1,1,1,44", "t4,2018-12-02,x,Cup,1,1,1,44",
        "t5,2018-12-01,x,Cup,1,1,1,33",
    ]))
    out = str(tmp_path / "basket")
    got = rows(jobs.basket(spark, tx, countries, out_path=out))
    assert got == [("44", "United Kingdom", dt.date(2018, 12, 1), "Mug, red", decimal.Decimal("1.0"))]
    assert spark.read.parquet(out).count() == 1


def test_basket_unknown_country_is_null_not_error(spark, write_text):
    countries = write_text("cc.csv", "Country,CountryCode\nFrance,33\n")
    tx = write_text("tx.csv", "TransactionNo,Date,X,ProductName,A,B,C,CountryCode\nt1,2018-12-01,x,Tea,1,1,1,44\n")
    got = rows(jobs.basket(spark, tx, countries))
    assert got == [(None, "United Kingdom", dt.date(2018, 12, 1), None, None)]


def test_declared_schema_skips_inference(spark, write_text):
    p = write_text("pizza.csv", "order_id,order_type,address_id\n1,a,7\n2,a,7\n3,b,x\n")
    df = jobs.pizza(spark, p, schema="order_id INT, order_type STRING, address_id INT")
    # the non-numeric address becomes null under the declared schema
    assert rows(df, "order_type") == [("a", 2, 7, 2), ("b", 1, None, 1)]


def test_command_line_runs_a_job(spark, write_text, tmp_path):
    from sparkops.jobs.__main__ import main
    p = write_text("emp.csv", "id,city,country,salary,department\n0,London,England,123,IT\n2,Rome,Italy,10,HR")
    out = str(tmp_path / "cli_out")
    assert main(["salary_by_department", p, out], stop=False) == 0
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("HR", 10.0), ("IT", 123.0)]
    pizza = write_text("pizza.csv", "order_type,address_id\na,1\na,1\nb,2\n")
    pizza_out = str(tmp_path / "pizza_cli")
    assert main(["pizza", pizza, pizza_out], stop=False) == 0  # the job writes CSV itself
    back = spark.read.csv(pizza_out, schema="t STRING, total LONG, a INT, n LONG")
    assert sorted(tuple(r) for r in back.collect()) == [("a", 2, 1, 2), ("b", 1, 2, 1)]


def test_mall_income_half_even_at_x5(spark, write_text):
    p = write_text("mall2.csv", "\n".join([
        "CustomerID,Gender,Age,Annual Income (k$)",
        "1,Male,29,15.0", "2,Male,29,15.5",      # avg 15.25 -> 15.2 (half-even)
        "3,Female,30,15.0", "4,Female,30,15.7",  # avg 15.35 -> 15.4
    ]))
    assert rows(jobs.mall_income(spark, p)) == [("Female", 32, 15.4, 0), ("Male", 31, 15.2, 1)]


def test_bike_columns_resolve_in_any_case(spark, write_text):
    p = write_text("bikes2.csv", "date,hour,Temperature,humidity,wind_speed,holiday,functioning_day\n"
                                 "01/12/2017,0,-5.2,37,2.2,Holiday,No\n")
    assert jobs.bike_projection(spark, p).count() == 1
    assert rows(jobs.bike_min_max(spark, p)) == [("01/12/2017", -5.2, -5.2)]


def test_job_reviews_tied_totals_go_to_smaller_name(spark, write_text):
    p = write_text("jobs2.csv", "\n".join([
        "JobTitle,Company,Location,CompanyReviews,Link",
        "Dev,Zeta,Paris,10 reviews,l1", "Dev,Alpha,Rome,10 reviews,l2",
    ]))
    got = rows(jobs.job_reviews(spark, p).filter("type = 'company'"), "count_type")
    assert got == [("Alpha", "company", "Rome", 10, "max"), ("Alpha", "company", "Rome", 10, "min")]


def test_job_reviews_typed_variant_drops_null_locations(spark, write_text):
    p = write_text("jobs3.csv", "\n".join([
        "JobTitle,Company,Location,CompanyReviews,Link",
        "Dev,Acme,Paris,10 reviews,l1",
        "Dev,Beta,,50 reviews,l2",        # counts for Beta only when null locations are kept
        "Dev,Beta,Rome,5 reviews,l3",
    ]))
    keep = rows(jobs.job_reviews(spark, p).filter("type = 'company'"), "count_type")
    drop = rows(jobs.job_reviews(spark, p, drop_null_location=True).filter("type = 'company'"), "count_type")
    assert keep == [("Beta", "company", "Rome", 5, "max"), ("Beta", "company", "Rome", 5, "min")]
    assert drop == [("Acme", "company", "Paris", 10, "max"), ("Acme", "company", "Paris", 10, "min")]


def test_access_log_can_keep_quotes_like_the_original(spark, write_text):
    mon = 1609718400
    p = write_text("logs2.csv", "\n".join([
        ",host,time,method,url,response,bytes",
        f'1,"a,b",{mon},GET,/x,404,100',
        f'2,"a,b",{mon},GET,"/y,z",200,',
        f"3,h2,{mon},GET,/x,404,x",
    ]))
    r = jobs.access_log(spark, p, keep_quotes=True)
    assert rows(r["top_hosts"]) == [('"a,b"', 2), ("h2", 1)]
    # empty and bad cells are null
    assert rows(r["totals"].select("bytes", "average", "largest", "smallest")) == [(100, 100, 100, 100)]
    plain = jobs.access_log(spark, p)
    assert rows(plain["top_hosts"]) == [("a,b", 2), ("h2", 1)]


def test_keep_quotes_split_matches_reference_rule(spark, write_text):
    from sparkops.sources import readers
    lines = ['a,"b,c",d', '"x,y,z",1,2', 'p,q', '"",,"e"']
    p = write_text("kq.txt", "\n".join(lines))

    def ref_split(line):
        out, cur, inq = [], "", False
        for ch in line:
            if ch == '"':
                inq = not inq
            if ch == "," and not inq:
                out.append(cur)
                cur = ""
            else:
                cur += ch
        out.append(cur)
        return out
    df = readers.parse_csv_lines(readers.read_lines(spark, p), "c0 STRING, c1 STRING, c2 STRING", keep_quotes=True)
    got = sorted(tuple(r) for r in df.collect())
    exp = sorted(tuple((c if c != "" else None) for c in (ref_split(l) + [None, None, None])[:3]) for l in lines)
    assert got == exp


def test_season_word_ranks_reads_lines_with_many_commas(spark, write_text):
    s1 = write_text("wide1.txt", "alpha beta" + "," * 30000 + "ignored\n")
    s2 = write_text("wide2.txt", "gamma\n")
    got = rows(jobs.season_word_ranks(spark, {"a": s1, "b": s2}), "id")
    assert got == [("alpha", 1, 0, "gamma", 1)]


def test_command_line_writes_one_folder_per_result(spark, write_text, tmp_path):
    import os
    from sparkops.jobs.__main__ import main
    p = write_text("logs3.csv", ",host,time,method,url,response,bytes\n1,h,1609718400,GET,/x,404,5\n")
    out = str(tmp_path / "report")
    assert main(["access_log", p, out], stop=False) == 0
    assert sorted(os.listdir(out)) == ["responses", "top_hosts", "top_weekdays", "totals"]
    assert tuple(spark.read.parquet(f"{out}/totals").first())[:3] == (2, 1, 1)


def test_command_line_takes_a_schema_and_runs_the_word_ranks(spark, write_text, tmp_path):
    from sparkops.jobs.__main__ import main
    p = write_text("emp.csv", "id,salary,department\n1,007,IT\n2,x,IT\n3,5,HR")
    out = str(tmp_path / "avg")
    assert main(["salary_by_department", p, out, "--schema", "id INT, salary DOUBLE, department STRING"], stop=False) == 0
    assert dict(tuple(r) for r in spark.read.parquet(out).collect()) == {"IT": 7.0, "HR": 5.0}
    a, b = write_text("s1.txt", "one two two\n"), write_text("s2.txt", '"three, three",x\n')
    out = str(tmp_path / "ranks")
    assert main(["season_word_ranks", a, b, out], stop=False) == 0
    assert rows(spark.read.json(out).select("w_s1", "cnt_s1", "w_s2", "cnt_s2")) == [("two", 2, "three", 2)]
    with pytest.raises(SystemExit):
        main(["salary_by_department", p, "--schema", "a INT", "--schema", "b INT"], stop=False)
    with pytest.raises(SystemExit):
        main(["salary_by_department", p, "--input-bytes", "10"], stop=False)


def test_reports_read_their_input_once_for_single_rows(spark, write_text):
    from sparkops.plans.inspect import physical_plan
    p = write_text("one.csv", "1,h,1609718400,GET,/x,404,5\n")
    assert physical_plan(jobs.access_log(spark, p)["totals"]).count("FileScan") == 1
    assert physical_plan(jobs.avocado(spark, p)["totals"]).count("FileScan") == 1
