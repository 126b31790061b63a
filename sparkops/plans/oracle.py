"""DuckDB oracles: for each registered query, the same result written as
SQL over the parquet tables (registered as views under their table names).
Column names equal the Spark query's so results compare column by column."""

ORACLE_SQL: dict[str, str] = {
    'local_rows': (
        'SELECT status_name, count(*) AS orders FROM orders JOIN (VALUES '
        "('F','finished'),('O','open'),('P','partial')) t(o_orderstatus, status_name) USING "
        '(o_orderstatus) GROUP BY 1'
    ),
    'json_scan_nested': (
        'SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, o_custkey AS cust '
        'FROM orders'
    ),
    'csv_scan_typed': (
        'SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part'
    ),
    'csv_scan_multiline': (
        'SELECT doc_id, text FROM documents'
    ),
    'parquet_roundtrip': (
        'SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer'
    ),
    'csv_quoted_lines': (
        "SELECT p_partkey AS id, p_name || ', ' || p_type AS host, p_size AS bytes FROM part"
    ),
    'load_accounting': (
        'SELECT count(*) AS total, count(*) FILTER (WHERE p_partkey % 10 <> 0) AS loaded, count(*) '
        'FILTER (WHERE p_partkey % 10 = 0) AS skipped FROM part'
    ),
    'json_lines_decode': (
        "SELECT event_id, CAST(json_extract(props,'$.k') AS INT) AS k FROM events WHERE event_id % "
        '7 <> 0'
    ),
    'project_topk': (
        'SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem ORDER BY '
        'l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 3'
    ),
    'case_when_distinct': (
        "SELECT DISTINCT o_orderstatus, o_orderpriority, CASE WHEN o_orderstatus='F' AND "
        "o_orderpriority='5-LOW' THEN 0 ELSE 1 END AS is_workday FROM orders"
    ),
    'group_min_max': (
        'SELECT CAST(ts AS DATE) AS dt, min(value) AS min_value, max(value) AS max_value FROM '
        'events GROUP BY 1'
    ),
    'shift_between_bround': (
        'SELECT p_brand, p_size + 2 AS p_size, round_even(avg(p_partkey),1) AS avg_price, CASE WHEN '
        "p_brand='Brand#1' THEN 1 ELSE 0 END AS brand_code FROM part WHERE p_size + 2 BETWEEN 30 "
        'AND 35 GROUP BY p_brand, p_size'
    ),
    'word_count': (
        'SELECT w AS value, count(*) AS count FROM (SELECT '
        "unnest(regexp_split_to_array(lower(text),'\\W+')) AS w FROM documents) "
        "WHERE w <> '' GROUP BY 1"
    ),
    'topn_zip_by_rank': (
        'WITH c AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, '
        "unnest(regexp_split_to_array(lower(text),'\\W+')) AS w FROM documents WHERE lang IN "
        "('en','fr')) WHERE w <> '' GROUP BY 1,2), r AS (SELECT lang, w, n, row_number() OVER "
        '(PARTITION BY lang ORDER BY n DESC, w) - 1 AS id FROM c) SELECT a.w AS w_s1, a.n '
        'AS cnt_s1, CAST(a.id AS INT) AS id, b.w AS w_s2, b.n AS cnt_s2 FROM r a '
        "JOIN r b ON a.id=b.id AND a.lang='en' AND b.lang='fr' WHERE a.id <= 20"
    ),
    'null_defaults': (
        "SELECT p_partkey, coalesce(nullif(p_type,'ECONOMY'), p_brand) AS type_or_brand, "
        "coalesce(nullif(p_size,11),0) AS size_or_zero, coalesce(nullif(p_brand,'Brand#2'),'n/a') "
        "AS brand FROM part WHERE nullif(p_name,'small ring') IS NOT NULL"
    ),
    'na_drop_subset': (
        'SELECT p_partkey, p_name FROM part WHERE nullif(p_size,11) IS NOT NULL AND '
        "nullif(p_brand,'Brand#2') IS NOT NULL"
    ),
    'leading_int': (
        'SELECT o_orderkey, '
        "TRY_CAST(regexp_replace(string_split(o_orderpriority,'-')[1],'\\W+','','g') AS BIGINT) AS n, "
        "TRY_CAST(regexp_replace(string_split(o_orderstatus,'-')[1],'\\W+','','g') AS BIGINT) AS bad "
        'FROM orders'
    ),
    'strip_newlines': (
        "SELECT doc_id, regexp_replace(coalesce(text,''), '\\n|\\r', '', 'g') AS text FROM documents"
    ),
    'top_entity_location_extremes': (
        'WITH base AS (SELECT l_returnflag AS company, l_linestatus AS job, CAST(l_linenumber AS '
        "VARCHAR) AS location, CAST(l_quantity AS INT) AS n FROM lineitem), e AS (SELECT 'company' "
        "AS type, company AS name, location, n FROM base UNION ALL SELECT 'job', job, location, n "
        "FROM base), tot AS (SELECT type, name, sum(n) AS t FROM e WHERE name <> '' GROUP BY 1,2), "
        'win AS (SELECT type, name FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY t '
        'DESC, name) AS rn FROM tot) WHERE rn=1), loc AS (SELECT type, name, location, CAST(sum(n) '
        'AS BIGINT) AS count FROM e JOIN win USING (type,name) WHERE location IS NOT NULL GROUP BY '
        '1,2,3), rk AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY count DESC, '
        'location) AS mx, row_number() OVER (PARTITION BY type ORDER BY count, location) AS mn FROM '
        "loc) SELECT name, type, location, count, 'max' AS count_type FROM rk WHERE mx=1 UNION ALL "
        "SELECT name, type, location, count, 'min' FROM rk WHERE mn=1"
    ),
    'avg_null_as_zero': (
        'SELECT avg(coalesce(nullif(l_quantity,1.0),0.0)) AS avg_mileage FROM lineitem'
    ),
    'multi_format_years_since': (
        'WITH d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE CAST(o_orderdate '
        "AS DATE) END AS pd FROM orders), x AS (SELECT o_orderkey, coalesce(pd, DATE '2002-01-01') "
        "AS pd, DATE '2002-01-01' AS t FROM d), m AS (SELECT o_orderkey, "
        '(year(t)*12+month(t))-(year(pd)*12+month(pd)) AS tm, day(t)-day(pd) AS dd FROM x) SELECT '
        'o_orderkey, CAST((CASE WHEN tm>0 AND dd<0 THEN tm-1 WHEN tm<0 AND dd>0 THEN tm+1 ELSE tm '
        'END)//12 AS BIGINT) AS years FROM m'
    ),
    'prefix_filter_distinct': (
        'SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE '
        "starts_with(lower(c_mktsegment),'bu') OR starts_with(lower(c_mktsegment),'ma')"
    ),
    'group_total_and_mode': (
        'WITH c AS (SELECT o_orderpriority AS order_type, o_custkey AS address_id, count(*) AS n '
        'FROM orders GROUP BY 1,2), r AS (SELECT *, sum(n) OVER (PARTITION BY order_type) AS t, '
        'row_number() OVER (PARTITION BY order_type ORDER BY n DESC, address_id) AS rn FROM c) '
        'SELECT order_type, CAST(t AS BIGINT) AS orders_total, address_id, n AS orders_cnt FROM r '
        'WHERE rn=1'
    ),
    'distinct_count': (
        'SELECT count(DISTINCT c_nationkey) AS regions FROM customer'
    ),
    'date_string_filter': (
        "SELECT o_orderkey, strftime(o_orderdate,'%Y-%m-%d') AS d FROM orders WHERE "
        "strftime(o_orderdate,'%Y-%m-%d') > '2001-02-11'"
    ),
    'mode_month': (
        "SELECT m AS month FROM (SELECT string_split(strftime(o_orderdate,'%Y-%m-%d'),'-')[2] AS m, "
        'count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, m LIMIT 1'
    ),
    'global_extremes': (
        'SELECT max(p_retailprice) AS max_price, min(p_retailprice) AS min_price FROM part'
    ),
    'group_avg_round': (
        'SELECT l_returnflag, round(avg(l_quantity),2) AS avg_volume FROM lineitem GROUP BY 1'
    ),
    'group_count_sorted': (
        'SELECT event_type AS name, count(*) AS count FROM events GROUP BY 1'
    ),
    'numeric_stats': (
        'SELECT CAST(sum(p_size) AS BIGINT) AS total, CAST(sum(p_size)//count(*) AS BIGINT) AS '
        'average, max(p_size) AS largest, min(p_size) AS smallest FROM part'
    ),
    'top3_by_count': (
        'SELECT user_id AS name, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, name '
        'LIMIT 3'
    ),
    'top3_weekdays_ru': (
        "WITH e AS (SELECT isodow(CAST(ts AS DATE)) AS d FROM events WHERE event_type='error') "
        "SELECT ['Понедельник','Вторник','Среда','Четверг','Пятница','Суббота','Воскресенье'][d] AS "
        'name, count(*) AS count FROM e GROUP BY 1 ORDER BY count DESC, name LIMIT 3'
    ),
    'join_inner_using': (
        "SELECT o_custkey AS id, o_orderkey, c_name, 'n/a' AS col_1, 'n/a' AS col_2 FROM orders "
        'JOIN customer ON o_custkey=c_custkey'
    ),
    'join_scaled_distinct': (
        "SELECT DISTINCT o_custkey AS id, 10*o_totalprice AS price, 'bbc' AS col_1, c_name FROM "
        'orders JOIN customer ON o_custkey=c_custkey'
    ),
    'union_all_rows': (
        'SELECT c_custkey AS id, c_acctbal AS salary FROM customer UNION ALL SELECT s_suppkey, '
        's_acctbal FROM supplier'
    ),
    'join_global_avg': (
        'SELECT avg(c_custkey) AS id2 FROM orders JOIN customer ON o_custkey=c_custkey'
    ),
    'group_sum': (
        'SELECT c_nationkey, CAST(sum(c_custkey) AS BIGINT) AS sum_id FROM customer GROUP BY 1'
    ),
    'join_broadcast_xor_count': (
        "WITH codes(id,is_cancelled) AS (VALUES ('F','yes'),('O','no'),('P','no')) SELECT count(*) "
        'AS errors FROM orders JOIN codes ON o_orderstatus=codes.id WHERE '
        "(o_orderpriority='1-URGENT') <> (is_cancelled='yes')"
    ),
    'cross_join_range': (
        'SELECT r_regionkey, r_name, CAST(s.range AS BIGINT) AS salt FROM region, range(4) s'
    ),
    'salted_join_band_avg': (
        'SELECT a.event_id AS id, avg(CAST(round(b.value*100) AS BIGINT)) AS avg_price_cents FROM '
        'events a JOIN events b ON a.event_type=b.event_type AND a.user_id=b.user_id WHERE '
        'abs(a.event_id%5 - b.event_id%7) <= 1 GROUP BY 1'
    ),
    'lookup_filter_basket': (
        'WITH t AS (SELECT l_orderkey, l_partkey FROM lineitem JOIN supplier ON l_suppkey=s_suppkey '
        "WHERE date_trunc('month', l_shipdate)=DATE '1999-04-01' AND s_nationkey=(SELECT "
        "n_nationkey FROM nation WHERE n_name='NATION_5')), m AS (SELECT l_partkey FROM t GROUP BY "
        '1 ORDER BY count(*) DESC, l_partkey LIMIT 1) SELECT (SELECT n_nationkey FROM nation WHERE '
        "n_name='NATION_5') AS country_code, 'NATION_5' AS country_name, (SELECT l_partkey FROM m) "
        'AS most_popular_product, CAST(count(*)//nullif(count(DISTINCT l_orderkey), 0) AS DECIMAL(38,1)) AS '
        'avg_transaction FROM t'
    ),
    'group_avg': (
        'SELECT p_brand, avg(p_size) AS avg_salary FROM part GROUP BY 1'
    ),
    'csv_scan_inferred': (
        'SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey, c_acctbal FROM customer'
    ),
    'csv_delimited_lines': (
        'SELECT s_suppkey, s_name, s_acctbal FROM supplier'
    ),
    'json_roundtrip': (
        'SELECT n_nationkey, n_name, n_regionkey FROM nation'
    ),
    'csv_roundtrip': (
        "SELECT r_regionkey, CASE r_regionkey WHEN 0 THEN '' WHEN 1 THEN '  ' || r_name || ' ' WHEN 2 THEN NULL "
        "ELSE r_name END AS r_name FROM region"
    ),
    'rename_drop': (
        'SELECT n_nationkey, n_name AS names FROM nation'
    ),
    'conform_schema': (
        'SELECT CAST(p_partkey AS INT) AS id, CAST(p_size AS BIGINT) AS size, p_name AS name FROM '
        'part'
    ),
    'json_lines_defaults': (
        "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(json_extract(props,'$.k') AS "
        'INT) END AS k FROM events'
    ),
    'global_avg_attached': (
        'SELECT l_orderkey, l_linenumber, l_quantity, (SELECT '
        'avg(coalesce(nullif(l_quantity,1.0),0.0)) FROM lineitem) AS avg_mileage FROM lineitem'
    ),
    'join_prepartitioned': (
        'SELECT o_custkey AS id, o_orderkey, c_acctbal FROM orders JOIN customer ON '
        'o_custkey=c_custkey'
    ),
    'season_word_ranks': (
        r"""WITH l AS (SELECT lang, unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line """
        r"""FROM documents WHERE lang IN ('en','fr')), """
        r"""f AS (SELECT lang, CASE WHEN regexp_matches(line, '^"([^"\\]|\\.)*"(,|$)') """
        r"""THEN regexp_extract(line, '^"((?:[^"\\]|\\.)*)"', 1) ELSE split_part(line, ',', 1) END AS cell FROM l), """
        r"""t AS (SELECT lang, unnest(regexp_split_to_array(lower(cell), '\W+')) AS w FROM f), """
        r"""c AS (SELECT lang, w, count(*) AS n FROM t WHERE w <> '' GROUP BY 1,2), """
        r"""r AS (SELECT lang, w, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) - 1 AS id FROM c) """
        r"""SELECT a.w AS w_s1, a.n AS cnt_s1, CAST(a.id AS INT) AS id, b.w AS w_s2, """
        r"""b.n AS cnt_s2 FROM r a JOIN r b ON a.id=b.id AND a.lang='en' AND b.lang='fr' """
        r"""WHERE a.id <= 20"""
    ),
    'basket_per_group': (
        "WITH t AS (SELECT o_orderpriority AS grp, l_orderkey, l_partkey FROM lineitem JOIN orders "
        "ON l_orderkey = o_orderkey), "
        "c AS (SELECT grp, l_partkey, count(*) AS n FROM t GROUP BY 1, 2), "
        "m AS (SELECT grp, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY grp "
        "ORDER BY n DESC, l_partkey) AS rn FROM c) WHERE rn = 1), "
        "a AS (SELECT grp, CAST(count(*) // nullif(count(DISTINCT l_orderkey), 0) AS DECIMAL(38,1)) AS avg_transaction "
        "FROM t GROUP BY 1) "
        "SELECT a.grp AS o_orderpriority, m.l_partkey AS most_popular_product, a.avg_transaction "
        "FROM a LEFT JOIN m ON a.grp IS NOT DISTINCT FROM m.grp"
    ),
    'global_extreme_records': (
        "(SELECT 'max' AS kind, p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice IS NOT NULL "
        "ORDER BY p_retailprice DESC, p_partkey LIMIT 1) UNION ALL "
        "(SELECT 'min' AS kind, p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice IS NOT NULL "
        "ORDER BY p_retailprice, p_partkey LIMIT 1)"
    ),
    'salted_hot_key_join': (
        "WITH a AS (SELECT event_type, count(*) AS type_events FROM events GROUP BY 1) "
        "SELECT e.event_id, e.event_type, a.type_events FROM events e JOIN a ON e.event_type = a.event_type"
    ),
    'csv_pipe_lines': (
        "SELECT s_suppkey AS id, s_name || '|x' AS name, s_nationkey AS nation FROM supplier"
    ),
    'weekday_from_epoch': (
        "SELECT ['Понедельник','Вторник','Среда','Четверг','Пятница','Суббота','Воскресенье'][isodow(CAST(ts AS DATE))] "
        "AS name, count(*) AS count FROM events GROUP BY 1"
    ),
    'join_distinct_sorted': (
        "SELECT DISTINCT c_custkey, c_name, o_orderpriority, 'n/a' AS col_1, 'n/a' AS col_2 FROM orders "
        "JOIN customer ON o_custkey = c_custkey ORDER BY c_custkey DESC, o_orderpriority LIMIT 100"
    ),
    'repartition_round_robin': (
        "SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS last FROM orders GROUP BY 1"
    ),
    'range_source_join': (
        "SELECT range AS id, count(*) AS lines FROM range(0, 60, 3) JOIN lineitem ON l_quantity = range GROUP BY 1"
    ),
    'csv_scan_multiline_split': (
        'SELECT doc_id, text, source FROM documents'
    ),
    'full_rank_zip': (
        "WITH c AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(regexp_split_to_array(lower(text), '\\W+')) AS w "
        "FROM documents WHERE lang IN ('en', 'fr')) WHERE w <> '' GROUP BY 1, 2), "
        'r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) - 1 AS id FROM c) '
        'SELECT a.w AS w_s1, a.n AS cnt_s1, a.id, b.w AS w_s2, b.n AS cnt_s2 FROM r a JOIN r b '
        "ON a.id = b.id AND a.lang = 'en' AND b.lang = 'fr'"
    ),
    'top3_heavy_hitters': (
        'SELECT user_id AS name, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, name NULLS LAST LIMIT 3'
    ),
    'bitmap_distinct_counts': (
        'SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1 '
        "UNION ALL SELECT 'all', count(DISTINCT o_custkey) FROM orders"
    ),
    'json_lines_strict': (
        'SELECT event_id AS id, CASE WHEN event_id % 8 <> 2 THEN event_type END AS name, '
        'CASE WHEN event_id % 8 = 6 THEN 0 ELSE user_id END::INTEGER AS k FROM events WHERE event_id % 8 IN (0, 2, 5, 6)'
    ),
    'runtime_filter_join': (
        "SELECT o_custkey, count(*) AS lines, max(l_shipdate) AS last_ship FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1"
    ),
    'bucketed_joins': (
        'WITH p AS (SELECT o_custkey AS id, c_nationkey, count(*) AS orders, max(o_totalprice) AS m FROM orders '
        'JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) '
        'SELECT id, c_nationkey, orders, o_orderkey FROM p JOIN orders ON id = o_custkey AND o_totalprice = m'
    ),
    'load_accounting_written': (
        'SELECT count(*) AS total, count(*) FILTER (p_partkey % 10 > 1) AS loaded, count(*) FILTER (p_partkey % 10 <= 1) AS skipped, '
        'count(*) FILTER (p_partkey % 10 > 1) AS "rows", (sum(p_size) FILTER (p_partkey % 10 > 1))::BIGINT AS sizes FROM part'
    ),
    'merged_states': (
        'SELECT l_returnflag, sum(l_quantity) AS total, count(l_quantity) AS count, sum(l_quantity) / count(l_quantity) AS average, '
        'min(l_quantity) AS smallest, max(l_quantity) AS largest FROM lineitem GROUP BY 1'
    ),
    'partition_overwrite': (
        'SELECT event_id, user_id, event_type FROM events'
    ),
    'job_parameters': (
        "SELECT 'dept ' || s_nationkey AS department, round(avg(s_acctbal), 4) AS avg_salary FROM supplier GROUP BY 1"
    ),
}
ORACLE_SQL['basket_result_roundtrip'] = ORACLE_SQL['lookup_filter_basket']
# The same basket, whatever the layout it is read from.
ORACLE_SQL['pruned_partition_basket'] = ORACLE_SQL['lookup_filter_basket']
