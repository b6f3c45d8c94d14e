"""S: scans, sources and sinks. Files are written from the given tables first, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.contracts import TableContract
from plumbline.plans.registry import query
from plumbline.session import new_folder
from plumbline.sources import files as f
from plumbline.sources import packages as pk


@query("s01_delimited_scan", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def s01(t):
    path = new_folder(t.spark, "delimited")
    rows = t.customer.select(F.col("c_custkey").cast("string").alias(f.BYTE_ORDER_MARK + "c_custkey"), "c_name", "c_mktsegment")
    rows.write.option("header", True).option("sep", "\t").csv(path)
    return f.scan_delimited(t.spark, path, "\t")


@query(
    "s01_quoted_cells",
    """SELECT CAST(p_partkey AS VARCHAR) AS part, p_name || chr(10) || 'say "' || p_type || '", ' || p_brand AS note FROM part""",
)
def s01_quoted(t):
    """Cells with line breaks, quotes and commas."""
    path = new_folder(t.spark, "quoted")
    note = F.concat("p_name", F.lit('\nsay "'), "p_type", F.lit('", '), "p_brand")
    t.part.select(F.col("p_partkey").cast("string").alias("part"), note.alias("note")).write.option("header", True).option("escape", '"').csv(path)
    return f.scan_delimited(t.spark, path, line_breaks=True)


GEOCODE = "source_row struct<place_id:bigint,city:string>, response struct<geocodes:array<struct<location:string,level:string,city:string>>>, raw_response_hash string"


def geocode_records(t):
    """Responses with zero, one or two geocodes per customer."""
    lat = F.concat(F.floor(F.col("c_acctbal") / 100).cast("string"), F.lit(".0"))
    lon = F.concat((F.col("c_custkey") % 360 - 180).cast("string"), F.lit(".0"))
    level = F.when(F.col("c_mktsegment") == "BUILDING", "street").when(F.col("c_mktsegment") == "MACHINERY", "city").otherwise("point")
    code = F.struct(F.concat(lon, F.lit(","), lat).alias("location"), level.alias("level"), F.concat(F.lit("N"), "c_nationkey").alias("city"))
    other = F.struct(F.lit("0,0").alias("location"), F.lit("city").alias("level"), F.lit("").alias("city"))
    codes = F.when(F.col("c_acctbal") < 0, F.array().cast("array<struct<location:string,level:string,city:string>>")).otherwise(F.array(code, other))
    source = F.struct(F.col("c_custkey").alias("place_id"), F.concat(F.lit("N"), F.col("c_nationkey") - F.when(F.col("c_mktsegment") == "FURNITURE", 1).otherwise(0)).alias("city"))
    return t.customer.select(source.alias("source_row"), F.struct(codes.alias("geocodes")).alias("response"), F.md5(F.col("c_name")).alias("raw_response_hash"))


@query("s02_json_lines", "SELECT c_custkey AS place_id, CASE WHEN c_acctbal < 0 THEN 0 ELSE 2 END AS geocode_count, md5(c_name) AS raw_response_hash FROM customer")
def s02(t):
    path = new_folder(t.spark, "jsonl")
    geocode_records(t).write.json(path)
    rows = f.scan_json_lines(t.spark, path, GEOCODE)
    return rows.select("source_row.place_id", F.size("response.geocodes").alias("geocode_count"), "raw_response_hash")


@query(
    "s03_latest_wins",
    """SELECT user_id, event_id, source_rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_rank DESC, ts DESC, event_id DESC) AS rn FROM
       (SELECT user_id, ts, event_id, CASE WHEN event_type = 'purchase' AND value > 50 THEN 1 ELSE 0 END AS source_rank FROM events)) WHERE rn = 1""",
)
def s03(t):
    rows = t.events.select("user_id", "ts", "event_id", (F.col("event_type") == "purchase").alias("p"), "value")
    retry = (F.col("p")) & (F.col("value") > 50)
    columns = ["user_id", "ts", "event_id"]
    return f.latest_wins(rows.filter(~retry).select(*columns), rows.filter(retry).select(*columns), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "source_rank")


SNAPSHOT = {"doc_id": "bigint", "lang": "string", "quality": "int", "reviewer": "string"}


def snapshot(t):
    return f.core_snapshot(t.documents.join(t.labels, "doc_id", "left"), SNAPSHOT, ["doc_id", "quality"])


@query("s04_core_snapshot", "SELECT doc_id, lang, quality, CAST(NULL AS VARCHAR) AS reviewer FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def s04(t):
    return snapshot(t).filter("is_exportable").drop("is_exportable")


@query("s04_excluded_rows", "SELECT count(quality) AS exported_rows, count(*) - count(quality) AS excluded_rows FROM documents LEFT JOIN labels USING (doc_id)")
def s04_excluded(t):
    return snapshot(t).agg(F.count_if("is_exportable").alias("exported_rows"), F.count_if(~F.col("is_exportable")).alias("excluded_rows"))


ORDERS = TableContract(name="pl_fact_orders", columns=("o_orderkey", "o_custkey", "o_orderpriority", "region"), key=("o_orderkey",), required=("o_custkey",))


def write_orders(t):
    """Orders in one package per year."""
    root = new_folder(t.spark, "packages")
    pk.write_packages(t.orders.withColumn("package_id", F.concat(F.lit("y"), F.year("o_orderdate"))), ORDERS, root, "package_id")
    return root


def registry(t):
    """Package registry: a year counts as faulty when it has too few urgent orders or is the last one."""
    year = F.year("o_orderdate")
    return t.orders.groupBy(F.concat(F.lit("y"), year).alias("package_id")).agg(
        (F.max(year) < 2001).alias("manifest_ok"), F.when(F.max(year) == 1996, 2).otherwise(0).alias("error_count")
    )


@query("s05_package_reader", "SELECT 'y' || year(o_orderdate) AS package_id, count(*) AS row_count, count(DISTINCT o_custkey) AS customers FROM orders WHERE year(o_orderdate) NOT IN (1996, 2001) GROUP BY 1")
def s05(t):
    rows = pk.read_packages(t.spark, write_orders(t), ORDERS.name, registry(t))
    return rows.groupBy("package_id").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_custkey").alias("customers"))


@query("s05_package_errors", "SELECT DISTINCT 'y' || year(o_orderdate) AS package_id, CASE year(o_orderdate) WHEN 1996 THEN 'quality_errors' ELSE 'manifest_invalid' END AS violation FROM orders WHERE year(o_orderdate) IN (1996, 2001)")
def s05_errors(t):
    return pk.package_errors(registry(t))


@query("s06_candidate_glob", "SELECT doc_id, n_chars, coalesce(lang, '__HIVE_DEFAULT_PARTITION__') AS candidate_folder FROM documents")
def s06(t):
    root = new_folder(t.spark, "candidates")
    t.documents.select("doc_id", "n_chars", "lang").write.partitionBy("lang").option("header", True).csv(root)
    rows = f.scan_candidates(t.spark, root + "/lang=*/*.csv", "doc_id bigint, n_chars bigint")
    folder = F.regexp_extract("candidate_file", "lang=([^/]+)/", 1)
    return rows.select("doc_id", "n_chars", folder.alias("candidate_folder"))


@query("s07_package_sink", "SELECT 'y' || year(o_orderdate) AS package_id, 'pl_fact_orders' AS table_name, count(*) AS row_count, 0 AS error_count, true AS has_files, true AS hashes_ok FROM orders GROUP BY 1")
def s07(t):
    root = write_orders(t)
    actual = pk.file_hashes(t.spark, root, ORDERS.name).select("file_path", F.col("file_sha256").alias("actual"))
    entries = pk.read_manifest(t.spark, root, ORDERS.name).join(actual, "file_path", "left")
    same = F.coalesce(F.col("actual") == F.col("file_sha256"), F.lit(False))
    listed = entries.groupBy("package_id", "table_name").agg((F.count(F.lit(1)) > 0).alias("has_files"), F.bool_and(same).alias("hashes_ok"))
    report = pk.read_quality(t.spark, root, ORDERS.name).select("package_id", F.col("error_count").cast("int").alias("error_count"))
    rows = t.spark.read.parquet(f"{root}/{ORDERS.name}").groupBy("package_id").agg(F.count(F.lit(1)).alias("row_count"))
    return listed.join(rows, "package_id").join(report, "package_id")


@query(
    "s08_package_integrity",
    """SELECT DISTINCT 'y' || y AS package_id, CASE y WHEN 1995 THEN 'quality_report_missing' WHEN 1996 THEN 'quality_errors' WHEN 1997 THEN 'hash_mismatch' WHEN 1998 THEN 'path_not_relative' WHEN 1999 THEN 'file_missing' WHEN 2000 THEN 'bad_table_name' ELSE 'field_missing' END AS violation
       FROM (SELECT year(o_orderdate) AS y FROM orders) UNION SELECT DISTINCT 'y' || year(o_orderdate), 'file_not_declared' FROM orders WHERE year(o_orderdate) IN (1998, 1999)""",
)
def s08(t):
    root = write_orders(t)
    actual = pk.file_hashes(t.spark, root, ORDERS.name)
    year = F.substring("package_id", 2, 4).cast("int")
    entries = pk.read_manifest(t.spark, root, ORDERS.name).withColumn("y", year)
    damaged = entries.select(
        "package_id",
        F.when(F.col("y") == 2000, "Orders").otherwise(F.col("table_name")).alias("table_name"),
        F.when(F.col("y") == 2001, "").otherwise(F.col("source_version")).alias("source_version"),
        F.when(F.col("y") == 1998, F.concat(F.lit("/"), "file_path")).when(F.col("y") == 1999, F.concat("file_path", F.lit(".old"))).otherwise(F.col("file_path")).alias("file_path"),
        F.when(F.col("y") == 1997, F.reverse("file_sha256")).otherwise(F.col("file_sha256")).alias("file_sha256"),
    )
    quality = pk.read_quality(t.spark, root, ORDERS.name)
    broken = F.when(F.col("package_id") == "y1996", 3).otherwise(F.col("error_count"))
    return pk.manifest_violations(damaged, actual, quality.filter("package_id <> 'y1995'").withColumn("error_count", broken))


CONFIDENCE = {"street": 0.9, "city": 0.3}
GEOCODED = """geocoded AS (SELECT c_custkey AS place_id, 'N' || (c_nationkey - CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END) AS city, CAST(c_custkey % 360 - 180 AS DOUBLE) AS longitude, floor(c_acctbal / 100) AS latitude,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'street' WHEN 'MACHINERY' THEN 'city' ELSE 'point' END AS geocode_level, CASE c_mktsegment WHEN 'BUILDING' THEN 0.9 WHEN 'MACHINERY' THEN 0.3 ELSE 0.6 END::DOUBLE AS geocode_confidence, 'N' || c_nationkey AS geocode_city FROM customer WHERE c_acctbal >= 0)"""


def geocoded(t):
    return f.flatten_geocodes(geocode_records(t), CONFIDENCE, 0.6)


@query("s09_geocode_flatten", f"WITH {GEOCODED} SELECT * FROM geocoded")
def s09(t):
    return geocoded(t)


def district_tree(t):
    """Regions holding nations holding the market segments of their customers."""
    node = "struct<code:string,name:string,level:string>"
    segments = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    leaf = F.struct(F.concat(F.lit("S"), "c_nationkey", F.lit("-"), "c_mktsegment").alias("code"), F.col("c_mktsegment").alias("name"), F.lit("district").alias("level"))
    leaves = segments.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.array_sort(F.collect_list(leaf.cast(node))).alias("districts"))
    nations = t.nation.join(leaves, "n_nationkey")
    city = F.struct(F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("name"), F.lit("city").alias("level"), F.col("districts"))
    cities = nations.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.array_sort(F.collect_list(city)).alias("districts"))
    regions = t.region.join(cities, "r_regionkey")
    return regions.select(F.struct(F.concat(F.lit("R"), "r_regionkey").alias("code"), F.col("r_name").alias("name"), F.lit("province").alias("level"), F.col("districts")).alias("node"))


DISTRICTS = """districts AS (SELECT 'R' || r_regionkey AS code, r_name AS name, 'province' AS level, NULL AS parent_code, r_name AS province, NULL AS city, 0 AS depth FROM region
  UNION ALL SELECT 'N' || n_nationkey, n_name, 'city', 'R' || n_regionkey, r_name, n_name, 1 FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT DISTINCT 'S' || c_nationkey || '-' || c_mktsegment, c_mktsegment, 'district', 'N' || c_nationkey, r_name, n_name, 2 FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


@query("s10_hierarchy_flatten", f"WITH {DISTRICTS} SELECT * FROM districts")
def s10(t):
    return f.flatten_districts(district_tree(t))


@query(
    "s11_seed_rows",
    """SELECT p_partkey || '-' || k AS code, CASE WHEN k = 1 THEN p_name ELSE 'unnamed' END AS name, p_type AS category, CASE WHEN p_size > 25 THEN 'large' ELSE 'default' END AS label FROM part CROSS JOIN (VALUES (1), (2)) v(k)""",
)
def s11(t):
    path = new_folder(t.spark, "seeds")
    entry = lambda k: F.struct(
        F.concat("p_partkey", F.lit(f"-{k}")).alias("code"), (F.col("p_name") if k == 1 else F.lit(None).cast("string")).alias("name"), F.when(F.col("p_size") > 25, "large").alias("label")
    )
    defaults = F.struct(F.lit("unnamed").alias("name"), F.col("p_type").alias("category"), F.lit("default").alias("label"))
    t.part.select(defaults.alias("defaults"), F.array(entry(1), entry(2)).alias("rows")).write.json(path)
    schema = "defaults struct<name:string,category:string,label:string>, rows array<struct<code:string,name:string,label:string>>"
    return f.seed_rows(f.scan_json_lines(t.spark, path, schema), ["code", "name", "category", "label"])


SHEET_RULES = [("exact", "1-URGENT F", "first", "science"), ("contains", "URGENT", "first", "arts"), ("contains", "HIGH", "second", "science"), ("contains", "LOW", "second", "arts")]


@query(
    "s12_sheet_routing",
    """SELECT batch, subject, count(*) AS row_count FROM (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'first' WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN 'second' END AS batch,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'science' WHEN o_orderpriority = '1-URGENT' THEN 'arts' WHEN o_orderpriority = '2-HIGH' THEN 'science' WHEN o_orderpriority = '5-LOW' THEN 'arts' END AS subject FROM orders) GROUP BY 1, 2""",
)
def s12(t):
    rows = t.orders.select("o_orderkey", F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("sheet"))
    return f.route_sheets(rows, "sheet", SHEET_RULES).groupBy("batch", "subject").agg(F.count(F.lit(1)).alias("row_count"))
