"""A: scans, sources and sinks."""

from pyspark.sql import functions as F

from priorframe.operators.aggregates import class_counts
from priorframe.plans import base
from priorframe.plans.base import ORDERS, cents
from priorframe.plans.registry import query
from priorframe.session import scratch_dir
from priorframe.sources import readers, sinks
from priorframe.sources.tables import table


def n_all():
    return F.count(F.lit(1))


@query("a1_split_scan", f"""
WITH {ORDERS} SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, CAST(cents AS VARCHAR) AS cents, strftime(day, '%Y-%m-%d') AS day, split FROM o""")
def split_scan(spark, sf):
    root = scratch_dir(spark, "split-scan")
    o = base.orders(spark, sf).select(
        "o_orderkey", "o_orderpriority", "cents", base.text("day").alias("day"), "label", "split"
    )
    paths = {}
    for split in ("train", "eval", "holdout"):
        paths[split] = f"{root}/{split}"
        o.where(F.col("split") == split).drop("split").write.option("header", True).csv(paths[split])
    return readers.read_splits(spark, paths, "label")


@query("a2_string_columns_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def string_columns(spark, sf):
    path = scratch_dir(spark, "string-columns")
    segment = F.when(F.pmod("c_custkey", F.lit(5)) != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", segment).write.option("header", True).csv(path)
    return readers.read_string_columns(spark, path)


ALIASES = {
    "order": ["o_orderkey", "Order Key", "order_id"], "priority": ["o_orderpriority", "Priority"],
    "total": ["cents", "Total (cents)"], "clerk": ["Clerk"],
}


@query("a3_aliased_header_scan", """
SELECT o_orderkey AS "order", o_orderpriority AS priority, CASE WHEN o_orderdate >= DATE '1998-01-01' OR o_orderdate < DATE '1996-01-01' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS total,
  CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderstatus END AS clerk FROM orders""")
def aliased(spark, sf):
    o = table(spark, sf, "orders").withColumn("cents", cents("o_totalprice"))
    d = F.col("o_orderdate").cast("date")
    first = o.where(d < "1996-01-01").select("o_orderkey", "o_orderpriority", "cents")
    second = o.where((d >= "1996-01-01") & (d < "1998-01-01")).select(
        F.col("o_orderkey").alias(" order key"), F.col("o_orderpriority").alias("PRIORITY")
    )
    third = o.where(d >= "1998-01-01").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("Priority"),
        F.col("cents").alias("total (cents)"), F.col("o_orderstatus").alias("clerk"),
    )
    return readers.union_aliased([first, second, third], ALIASES)


RECORD = (
    "id bigint, part bigint, releases array<struct<date: string, tag: string, items: array<struct<class: string, quantity: bigint>>>>, "
    "parties array<struct<role: string, id: bigint>>, awards array<struct<status: string, value: bigint>>"
)


@query("a5_nested_json_flatten", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, CAST(l_quantity AS BIGINT) AS q, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, l_linenumber AS k FROM lineitem)
SELECT l_orderkey AS id, l_partkey AS part, k AS n_releases, strftime(l_shipdate + to_days(k), '%Y-%m-%d') AS last_date, CASE WHEN l_returnflag = 'R' THEN 'award' ELSE 'tender' END AS last_tag,
  k AS n_items, CAST(k * q + k * (k + 1) // 2 AS BIGINT) AS quantity, least(k, 3) AS classes, CAST(k + 1 AS BIGINT) AS suppliers, CASE WHEN l_returnflag = 'R' THEN c * k ELSE 0 END AS award_total FROM l""")
def nested_json(spark, sf):
    k = F.col("l_linenumber")
    # Each line becomes one record whose nested arrays have as many entries as its line number.
    steps = F.sequence(F.lit(1), k)
    item = lambda i: F.struct(
        F.pmod(F.col("l_partkey") + i, F.lit(3)).cast("string").alias("class"),
        (F.col("l_quantity").cast("bigint") + i).alias("quantity"),
    )
    releases = F.transform(
        F.reverse(steps),
        lambda i: F.struct(
            F.date_format(F.date_add(F.col("l_shipdate").cast("date"), i), "yyyy-MM-dd").alias("date"),
            F.when((F.col("l_returnflag") == "R") & (i == k), "award").otherwise("tender").alias("tag"),
            F.transform(F.sequence(F.lit(1), i), item).alias("items"),
        ),
    )
    parties = F.transform(
        F.sequence(F.lit(0), k + 1),
        lambda i: F.struct(F.when(i == 0, "buyer").otherwise("supplier").alias("role"), (F.col("l_suppkey") + i).alias("id")),
    )
    status = F.when(F.col("l_returnflag") == "R", "active").otherwise("pending")
    awards = F.transform(steps, lambda i: F.struct(status.alias("status"), cents("l_extendedprice").alias("value")))
    path = scratch_dir(spark, "nested-records")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), releases.alias("releases"),
        parties.alias("parties"), awards.alias("awards"),
    )
    sinks.bounded_files(rows).json(path)
    return readers.flatten_releases(readers.read_json(spark, path, RECORD))


@query("a6_xml_activity_scan", """
SELECT l_orderkey AS id, l_partkey AS part, CAST(3 AS BIGINT) AS n_transactions, CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(round(l_tax * 100) AS BIGINT) + CAST(round(l_discount * 100) AS BIGINT) AS total,
  'price' AS first_kind, strftime(l_shipdate, '%Y-%m-%d') AS last_day FROM lineitem""")
def xml_scan(spark, sf):
    path = scratch_dir(spark, "xml-activities")
    day = F.col("l_shipdate").cast("date")
    one = lambda kind, c, back: F.struct(
        F.lit(kind).alias("kind"), F.date_format(F.date_sub(day, back), "yyyy-MM-dd").alias("day"), cents(c).alias("cents")
    )
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"),
        F.array(one("price", "l_extendedprice", 2), one("tax", "l_tax", 1), one("discount", "l_discount", 0)).alias("transaction"),
    )
    sinks.bounded_files(rows).option("rowTag", "activity").option("rootTag", "activities").xml(path)
    x = readers.read_xml(spark, path, "activity", "id bigint, part bigint, transaction array<struct<kind: string, day: string, cents: bigint>>")
    t = F.col("transaction")
    return x.select(
        "id", "part", F.size(t).cast("bigint").alias("n_transactions"),
        F.aggregate(t, F.lit(0).cast("bigint"), lambda a, i: a + i["cents"]).alias("total"),
        F.get(t, F.lit(0))["kind"].alias("first_kind"), F.array_max(F.transform(t, lambda i: i["day"])).alias("last_day"),
    )


@query("a7_weekly_parquet_scan", """
SELECT strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week, l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL""")
def weekly_parquet(spark, sf):
    path = scratch_dir(spark, "weekly-parquet")
    l = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), base.text(F.date_trunc("week", "l_shipdate")).alias("week"),
        "l_returnflag", F.col("l_quantity").cast("bigint").alias("q"),
    )
    monthly = l.groupBy("month", "week", "l_returnflag").agg(n_all().alias("n"), F.sum("q").alias("q"))
    monthly.repartition("month").write.partitionBy("month").parquet(path)
    return spark.read.parquet(path).groupBy("week", "l_returnflag").agg(F.sum("n").alias("n"), F.sum("q").alias("quantity"))


@query("a8_file_inventory")
def inventory(spark, sf):
    files = readers.file_inventory(spark, sf, "*.parquet")
    total = readers.tree_digest(files)
    return files.unionByName(total.select(F.lit("(tree)").alias("name"), "bytes", F.col("digest").alias("sha256")))


@query("a8_written_inventory", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') || ':' || count(*) || ':' || CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS line FROM orders GROUP BY strftime(o_orderdate, '%Y-%m'))
SELECT CAST(length(line) + 1 AS BIGINT) AS bytes, sha256(line || chr(10)) AS sha256 FROM m""")
def written_inventory(spark, sf):
    path = scratch_dir(spark, "written-inventory")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    o = table(spark, sf, "orders").groupBy(month).agg(n_all().alias("n"), F.sum(base.cents("o_totalprice")).alias("c"))
    # One file a month, half of them read in chunks.
    o.select("month", F.concat_ws(":", "month", "n", "c").alias("line")).write.partitionBy("month").text(path)
    sizes = readers.file_inventory(spark, path, "*.txt").agg(F.floor(F.avg("bytes"))).first()[0]
    return readers.file_inventory(spark, path, "*.txt", whole_bytes=sizes).select("bytes", "sha256")


@query("a9_split_sink", f"""
WITH {ORDERS} SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives, CAST(sum(label) AS DOUBLE) / count(*) AS rate FROM o GROUP BY ALL""")
def split_sink(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "day", "cents", "label", "split")
    paths = sinks.write_splits(o, scratch_dir(spark, "split-sink"))
    back = None
    for split, path in paths.items():
        part = spark.read.parquet(path).withColumn("split", F.lit(split))
        back = part if back is None else back.unionByName(part)
    return class_counts(back, ["split"], "label")


def order_flags(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "split")
    flags = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_set("l_returnflag")).alias("codes")
    )
    return o.join(flags, "o_orderkey")


@query("a10_multi_target_sink", f"""
WITH {ORDERS}, f AS (SELECT o_orderkey, split, list(DISTINCT l_returnflag) AS codes FROM o JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL), c AS (SELECT unnest(['A', 'N', 'R']) AS config)
SELECT config, split, count(*) AS n, count(*) FILTER (list_contains(codes, config)) AS positives, count(*) FILTER (list_contains(codes, 'A') AND list_contains(codes, 'N') AND list_contains(codes, 'R')) AS all_targets FROM f, c GROUP BY ALL""")
def multi_target(spark, sf):
    rows, vocabulary = order_flags(spark, sf), ["A", "N", "R"]
    root = sinks.write_target_configs(rows, "codes", vocabulary, scratch_dir(spark, "multi-target"))
    per_config = spark.read.parquet(root).groupBy("config", "split").agg(n_all().alias("n"), F.sum("label").alias("positives"))
    matrix = sinks.label_matrix(rows, "codes", vocabulary)
    joint = matrix.groupBy("split").agg(
        F.sum(F.col("target_A") * F.col("target_N") * F.col("target_R")).alias("all_targets")
    )
    return per_config.join(joint, "split")
