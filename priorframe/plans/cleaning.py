"""B: projections, filters and scalar cleaning."""

from pyspark.sql import functions as F

from priorframe.functions import dates, keys, numbers, text
from priorframe.operators import cleaning as ops
from priorframe.plans import base
from priorframe.plans.base import ORDERS, cents
from priorframe.plans.registry import query
from priorframe.sources.tables import table


@query("b1_lenient_number", """
WITH t AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
u AS (SELECT event_id, CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN 'n/a' WHEN k % 11 = 0 THEN 'nan'
             ELSE ' ' || k || ' ' END AS raw FROM t)
SELECT event_id, CASE WHEN isfinite(TRY_CAST(trim(raw) AS DOUBLE)) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS strict,
       CASE WHEN raw = '' THEN 0.0
            WHEN isfinite(TRY_CAST(trim(raw) AS DOUBLE)) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS blank_zero
FROM u""")
def lenient_number(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    raw = (
        F.when(k % 5 == 0, "").when(k % 7 == 0, "n/a").when(k % 11 == 0, "nan")
        .otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
    )
    t = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return t.select(
        "event_id",
        numbers.lenient_number(F.col("raw")).alias("strict"),
        numbers.lenient_number(F.col("raw"), 0.0).alias("blank_zero"),
    )


@query("b2_decimal_comma_number", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN l_quantity = 1 THEN '' WHEN l_quantity = 2 THEN 'sem valor'
       ELSE replace(replace(replace(format('{:,.2f}', l_extendedprice), ',', '_'), '.', ','), '_', '.') END AS raw
  FROM lineitem)
SELECT year(l_shipdate) AS year,
  CAST(sum(CAST(round(TRY_CAST(replace(replace(raw, '.', ''), ',', '.') AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) AS value_cents,
  count(*) FILTER (raw = '') AS missing, count(*) FILTER (raw = 'sem valor') AS failed
FROM t GROUP BY ALL""")
def decimal_comma_number(spark, sf):
    c = cents("l_extendedprice")
    whole = F.floor(c / 100)
    padded = lambda x, n: F.lpad(x.cast("string"), n, "0")
    grouped = F.when(
        whole >= 1000, F.concat(F.floor(whole / 1000).cast("string"), F.lit("."), padded(F.pmod(whole, F.lit(1000)), 3))
    ).otherwise(whole.cast("string"))
    swapped = F.concat(grouped, F.lit(","), padded(F.pmod(c, F.lit(100)), 2))
    raw = F.when(F.col("l_quantity") == 1, "").when(F.col("l_quantity") == 2, "sem valor").otherwise(swapped)
    t = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("bigint").alias("year"),
        numbers.decimal_comma_number(raw).alias("v"),
    )
    return t.groupBy("year").agg(
        F.sum(cents("v.value")).alias("value_cents"),
        F.count(F.when(F.col("v.missing"), 1)).alias("missing"),
        F.count(F.when(F.col("v.failed"), 1)).alias("failed"),
    )


@query("b3_multi_format_date", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-01')
    WHEN 3 THEN strftime(o_orderdate, '%Y-01-01') END AS day
FROM orders""")
def multi_format_date(spark, sf):
    d, k = F.col("o_orderdate"), F.pmod("o_orderkey", F.lit(5))
    raw = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(k == 2, F.date_format(d, "yyyy-MM")).when(k == 3, F.date_format(d, "yyyy"))
        .otherwise(F.lit("unknown"))
    )
    formats = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM", "yyyy"]
    return table(spark, sf, "orders").select(
        "o_orderkey", base.text(dates.multi_format_date(raw, formats)).alias("day")
    )


@query("b4_month_token_date", """
SELECT CASE WHEN o_orderkey % 4 > 0 THEN CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) END AS month_index,
       count(*) AS n FROM orders GROUP BY ALL""")
def month_token_date(spark, sf):
    token = F.upper(F.date_format("o_orderdate", "'PREFIX'-MMMM-yyyy"))
    raw = F.when(F.pmod("o_orderkey", F.lit(4)) > 0, token).otherwise("PREFIX-TOTAL")
    t = table(spark, sf, "orders").select(dates.month_token(raw, r"-([A-Z]+)-(\d{4})$").alias("month_index"))
    return t.groupBy("month_index").agg(F.count(F.lit(1)).alias("n"))


@query("b5_month_shift", """
SELECT o_orderkey, CAST(year(o_orderdate - to_months(CAST(o_orderkey % 30 AS INTEGER))) AS BIGINT) AS y,
       CAST(month(o_orderdate - to_months(CAST(o_orderkey % 30 AS INTEGER))) AS BIGINT) AS m,
       CAST(year(o_orderdate + INTERVAL 14 MONTH) AS BIGINT) AS y14 FROM orders""")
def month_shift(spark, sf):
    d = F.col("o_orderdate")
    back = (-(F.pmod("o_orderkey", F.lit(30)))).cast("int")
    first = F.trunc(d, "month")
    moved = dates.clamped_due(first, back)
    ahead = dates.month_shift(F.year(d), F.month(d), 14)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(moved).cast("bigint").alias("y"), F.month(moved).cast("bigint").alias("m"),
        ahead["year"].alias("y14"),
    )


@query("b6_clamped_due_date", """
SELECT o_orderkey, strftime(last_day(o_orderdate) + INTERVAL 6 MONTH, '%Y-%m-%d') AS due FROM orders""")
def clamped_due_date(spark, sf):
    due = dates.clamped_due(F.last_day(F.col("o_orderdate").cast("date")), 6)
    return table(spark, sf, "orders").select("o_orderkey", base.text(due).alias("due"))


@query("b7_effective_timestamp", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d 08:30:00')
    WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d 00:00:00') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d 12:00:00')
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS eff
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def effective_timestamp(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    n = F.col("l_linenumber")
    stamp = F.when(n == 1, F.date_format("l_shipdate", "yyyy-MM-dd 08:30:00")).otherwise("invalid")
    day = F.when(n == 2, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("")
    late = F.when(n == 3, F.date_format("o_orderdate", "yyyy-MM-dd 12:00:00"))
    late_day = F.when(n == 4, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("00/00/0000")
    eff = dates.effective_timestamp(stamp, day, late, late_day)
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format(eff, "yyyy-MM-dd HH:mm:ss").alias("eff"),
    )


@query("b8_text_normalise", r"""
SELECT doc_id, md5(upper(trim(regexp_replace(replace(text, 'ß', 'ss'), '[ \t\r\n]+', ' ', 'g'), ' '))) AS normal_md5,
  regexp_replace(regexp_replace(lower(source || ' / ' || lang), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug
FROM documents""")
def text_normalise(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.normalised(F.col("text"))).alias("normal_md5"),
        text.slug(F.concat_ws(" / ", "source", "lang")).alias("slug"),
    )


@query("b9_entity_key_normalise", r"""
WITH t AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN substr(c_name, 12, 5) || '-' || substr(c_name, 17)
   WHEN 2 THEN '' ELSE c_name || '/42' END AS raw FROM customer)
SELECT c_custkey, regexp_replace(raw, '[^0-9]', '', 'g') AS digits,
  CASE length(regexp_replace(raw, '[^0-9]', '', 'g')) WHEN 0 THEN 'missing' WHEN 9 THEN 'person' WHEN 11 THEN 'company' ELSE 'other' END AS kind
FROM t""")
def entity_key_normalise(spark, sf):
    k = F.pmod("c_custkey", F.lit(4))
    raw = (
        F.when(k == 0, F.col("c_name"))
        .when(k == 1, F.concat(F.substring("c_name", 12, 5), F.lit("-"), F.expr("substring(c_name, 17)")))
        .when(k == 2, "").otherwise(F.concat("c_name", F.lit("/42")))
    )
    return table(spark, sf, "customer").select(
        "c_custkey", text.digits_only(raw).alias("digits"),
        text.digit_class(raw, {9: "person", 11: "company"}).alias("kind"),
    )


@query("b10_pseudonym_key", """
SELECT c_custkey, substr(sha256('pepper|1999|' || c_custkey), 1, 16) AS key_1999,
       substr(sha256('pepper|2000|' || c_custkey), 1, 16) AS key_2000 FROM customer""")
def pseudonym_key(spark, sf):
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        c, keys.pseudonym("pepper", F.lit(1999), c).alias("key_1999"),
        keys.pseudonym("pepper", F.lit(2000), c).alias("key_2000"),
    )


@query("b11_flag_from_prefix", """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS BIGINT) AS flag FROM orders""")
def flag_from_prefix(spark, sf):
    s = F.col("o_orderstatus")
    raw = F.when(s == "F", " yes ").when(s == "O", "No").otherwise("pending")
    return table(spark, sf, "orders").select("o_orderkey", text.yes_no_flag(raw).alias("flag"))


@query("b12_bucket_label", """
SELECT CASE WHEN p_size <= 10 THEN '01-10' WHEN p_size <= 25 THEN '11-25' WHEN p_size <= 40 THEN '26-40' ELSE '41+' END AS band,
       count(*) AS n FROM part GROUP BY ALL""")
def bucket_label(spark, sf):
    band = ops.bucket_label(F.col("p_size"), [(10, "01-10"), (25, "11-25"), (40, "26-40")], "41+")
    return table(spark, sf, "part").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("b13_guarded_unit_decode", """
SELECT c_custkey, CASE WHEN len(f) = 1 THEN f[1] END AS decoded FROM (
  SELECT c_custkey, list_filter([c_acctbal, c_acctbal / 60.0, c_acctbal / 3600.0], lambda v: v BETWEEN 41 AND 84) AS f
  FROM customer)""")
def guarded_unit_decode(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", numbers.guarded_decode(F.col("c_acctbal"), [1, 60, 3600], 41, 84).alias("decoded")
    )


@query("b14_calendar_features", """
SELECT o_orderkey, isodow(o_orderdate) - 1 AS weekday, month(o_orderdate) AS month,
  weekofyear(o_orderdate) AS iso_week, isoyear(o_orderdate) AS iso_year, dayofyear(o_orderdate) AS day_of_year,
  round(sin(dayofyear(o_orderdate) * 2 * pi() / 365.25), 6) AS doy_sin,
  round(cos(dayofyear(o_orderdate) * 2 * pi() / 365.25), 6) AS doy_cos FROM orders""")
def calendar_features(spark, sf):
    f = dates.calendar_features(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        *[(F.round(c, 6) if n.startswith("doy_") else c).alias(n) for n, c in f.items()],
    )


@query("b15_token_count_features", """
WITH x AS (SELECT l_orderkey, upper(p_name) AS code, CAST(l_quantity AS BIGINT) AS q, l_suppkey
           FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT l_orderkey, substr(code, 1, 2) AS segment, count(*) AS n FROM x GROUP BY ALL),
m AS (SELECT l_orderkey, segment FROM s QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, segment) = 1)
SELECT l_orderkey, count(DISTINCT code) AS codes, CAST(sum(q) AS BIGINT) AS quantity, count(DISTINCT l_suppkey) AS parties,
       any_value(segment) AS segment FROM x JOIN m USING (l_orderkey) GROUP BY l_orderkey""")
def token_count_features(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    p = table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("code"))
    items = l.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return ops.token_count_features(
        items, ["l_orderkey"], "code", F.col("l_quantity").cast("bigint"), "l_suppkey"
    )


@query("b16_multi_hot_indicators", """
SELECT p_partkey, CAST(list_contains(t, 'red') AS BIGINT) AS has_red, CAST(list_contains(t, 'blue') AS BIGINT) AS has_blue,
  CAST(list_contains(t, 'hot') AS BIGINT) AS has_hot, CAST(list_contains(t, 'widget') AS BIGINT) AS has_widget,
  CAST(len(list_filter(list_distinct(t), lambda x: x IN ('red', 'blue', 'hot', 'widget'))) AS BIGINT) AS has_count,
  CAST(len(list_filter(list_distinct(t), lambda x: x NOT IN ('red', 'blue', 'hot', 'widget'))) AS BIGINT) AS has_unknown
FROM (SELECT p_partkey, string_split(p_name, ' ') AS t FROM part)""")
def multi_hot_indicators(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("t"))
    return ops.multi_hot(p, F.col("t"), ["red", "blue", "hot", "widget"], "has_").drop("t")


@query("b17_code_extract_set", r"""
SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '([0-9]+)', 1))), ',') AS codes FROM documents""")
def code_extract_set(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(text.code_set(F.col("text"), "([0-9]+)"), ",").alias("codes")
    )


@query("b18_ratio_with_guard", """
SELECT l_orderkey, CASE WHEN sum(d) > 0 THEN CAST(sum(n) AS DOUBLE) / sum(d) END AS ratio,
       coalesce(CASE WHEN sum(d) > 0 THEN CAST(sum(n) AS DOUBLE) / sum(d) END, -1.0) AS ratio_filled
FROM (SELECT l_orderkey, CAST(round(l_tax * 100) AS BIGINT) AS n, CAST(round(l_discount * 100) AS BIGINT) AS d FROM lineitem)
GROUP BY ALL""")
def ratio_with_guard(spark, sf):
    t = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(cents("l_tax")).alias("a"), F.sum(cents("l_discount")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    return t.select(
        "l_orderkey", numbers.guarded_ratio(a, b).alias("ratio"),
        numbers.guarded_ratio(a, b, -1.0).alias("ratio_filled"),
    )


@query("b19_sentinel_fill", f"""
WITH {base.DAILY} SELECT user_id, d, coalesce(lag(c) OVER w, -1) AS last_c, coalesce(d - lag(d) OVER w, -2) AS gap
FROM p WINDOW w AS (PARTITION BY user_id ORDER BY d)""")
def sentinel_fill(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("d")
    t = base.daily(spark, sf).select(
        "user_id", "d", F.lag("c").over(w).alias("last_c"), (F.col("d") - F.lag("d").over(w)).alias("gap")
    )
    return ops.sentinel_fill(t, {"last_c": -1, "gap": -2})


@query("b20_exclusion_ladder", f"""
WITH {ORDERS} SELECT split, CASE WHEN cents < 1000000 THEN 'too_small' WHEN o_orderstatus = 'P' THEN 'pending'
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'no_priority' ELSE 'kept' END AS reason, count(*) AS n FROM o GROUP BY ALL""")
def exclusion_ladder(spark, sf):
    rules = [
        ("too_small", F.col("cents") < 1000000),
        ("pending", F.col("o_orderstatus") == "P"),
        ("no_priority", F.col("o_orderpriority") == "4-NOT SPECIFIED"),
    ]
    return ops.exclusion_ledger(base.orders(spark, sf), rules, ["split"])


@query("b21_presence_gated_columns", """
SELECT 'status_f' AS column, count(*) FILTER (o_orderstatus = 'F') AS populated FROM orders
UNION ALL SELECT 'priority', count(*) FILTER (trim(o_orderpriority) <> '') FROM orders
UNION ALL SELECT 'rare', count(*) FILTER (o_orderkey % 500 = 0) FROM orders""")
def presence_gated_columns(spark, sf):
    t = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "x").alias("status_f"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.pmod("o_orderkey", F.lit(500)) == 0, "x").otherwise("").alias("rare"),
    )
    return ops.populated_counts(t, t.columns)


@query("b21_presence_gate", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'x' END AS status_f, o_orderpriority AS priority FROM orders""")
def presence_gate(spark, sf):
    t = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "x").alias("status_f"), F.col("o_orderpriority").alias("priority"),
        F.lit(" ").alias("blank"), F.when(F.col("o_orderkey") < 0, "x").alias("never"),
    )
    return ops.presence_gate(t, ["status_f", "priority", "blank", "never"], 1)


@query("b24_hash_sampled_rows", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE ('0x' || md5(CAST(c_custkey AS VARCHAR)))::UHUGEINT % 7 = 0""")
def hash_sampled_rows(spark, sf):
    return table(spark, sf, "customer").where(keys.hash_sampled(F.col("c_custkey"), 7)).select("c_custkey", "c_name", "c_mktsegment")


@query("b24_hash_sample", """
SELECT c_custkey, CAST(('0x' || md5(CAST(c_custkey AS VARCHAR)))::UHUGEINT % 7 AS BIGINT) AS bucket FROM customer""")
def hash_sample(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", keys.md5_modulo(F.col("c_custkey"), 7).alias("bucket")
    )


@query("b25_seeded_row_sample", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('17|' || o_orderkey), o_orderkey LIMIT 500""")
def seeded_row_sample(spark, sf):
    return ops.seeded_sample(table(spark, sf, "orders"), "o_orderkey", 17, 500).select("o_orderkey", "o_custkey")


@query("b26_stride_sample", """
SELECT o_orderkey, o_custkey FROM orders QUALIFY (row_number() OVER (ORDER BY o_orderkey) - 1) % 10 = 0""")
def stride_sample(spark, sf):
    return ops.stride_sample(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 10)
