"""Registered queries of the core library with their SQL, over the driver's tables.

Roles: an order is a sale (nation as postcode, market segment as property type), a line
item a rental bond (order priority as bedroom band), a document a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import repair, text
from tessera.functions.metrics import measures, ratio
from tessera.operators import boosted, changes, corpus, evaluate, features, forecast, forecast_table, marts, medians, monitor, pruned, quality, retrieval, versions
from tessera.operators.bucketed import BucketedState
from tessera.sources import landing, scratch
from tessera.sources.versioned import VersionedTable
from tessera.streaming import merging
from tessera.streaming.incremental import IncrementalMart
from tessera.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _sales(spark: SparkSession, d: str) -> DataFrame:
    """postcode, property_type, month, price and keys of each order."""
    o, c = _read(spark, d, "orders"), _read(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", F.col("c_nationkey").cast("string").alias("postcode"), F.col("c_mktsegment").alias("property_type"),
        F.col("o_orderpriority").alias("bedroom_band"), repair.month_of(F.col("o_orderdate")).alias("month"), F.col("o_totalprice").alias("price"),
    )


_SALES = """sales AS (SELECT o_orderkey, CAST(c_nationkey AS VARCHAR) AS postcode, c_mktsegment AS property_type, o_orderpriority AS bedroom_band,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _rents(spark: SparkSession, d: str) -> DataFrame:
    """The same keys with the month and price of each line item."""
    li = _read(spark, d, "lineitem")
    s = _sales(spark, d).select("o_orderkey", "postcode", "property_type", "bedroom_band")
    return li.join(s, li.l_orderkey == s.o_orderkey).select("postcode", "property_type", "bedroom_band", repair.month_of(F.col("l_shipdate")).alias("month"), F.col("l_extendedprice").alias("price"))


_RENTS = f"""{_SALES}, rents AS (SELECT postcode, property_type, bedroom_band, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
    l_extendedprice AS price FROM lineitem JOIN sales ON l_orderkey = o_orderkey)"""


def _mart_sql(source: str, grain: str, noun: str, total: str, n: str) -> str:
    return f"""SELECT {grain}, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS {total}, count(price) AS {n},
        CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_{noun},
        median(CAST(round(price * 100) AS BIGINT)) / 100.0 AS median_{noun}, min(price) AS min_{noun}, max(price) AS max_{noun}
        FROM {source} GROUP BY {grain}"""


_S = ("total_sale_value", "n_sold")
_R = ("total_weekly_rent", "n_rented")


def _sales_mart(spark, d, grain=("postcode", "property_type", "month")):
    return marts.monthly_mart(_sales(spark, d), grain, "price", "sale_price", *_S)


def _rent_mart(spark, d, grain=("postcode", "property_type", "bedroom_band", "month")):
    return marts.monthly_mart(_rents(spark, d), grain, "price", "weekly_rent", *_R)


# Marts and ratios


@_query(f"WITH {_SALES} " + _mart_sql("sales", "property_type, month", "sale_price", *_S))
def monthly_mart_orders(spark: SparkSession, d: str) -> DataFrame:
    return _sales_mart(spark, d, ("property_type", "month"))


@_query(f"WITH {_RENTS} " + _mart_sql("rents", "postcode, property_type, bedroom_band, month", "weekly_rent", *_R))
def monthly_mart_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return _rent_mart(spark, d)


_LEGS = f"""{_RENTS},
    s AS (SELECT postcode, property_type, month, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_sale_value, count(price) AS n_sold FROM sales GROUP BY ALL),
    r AS (SELECT postcode, property_type, month, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_weekly_rent, count(price) AS n_rented FROM rents GROUP BY ALL)"""
_YIELD = f"""{_LEGS}, y AS (SELECT postcode, property_type, month, total_sale_value, n_sold, total_weekly_rent, n_rented,
    5200 * (total_weekly_rent / n_rented) / (total_sale_value / n_sold) AS gross_yield_pct
    FROM s JOIN r USING (postcode, property_type, month) WHERE n_sold >= {{floor}} AND n_rented >= {{floor}})"""


def _yield(spark, d, floor=5):
    keys = ("postcode", "property_type", "month")
    s, r = marts.legs(_sales(spark, d), keys, "price", *_S), marts.legs(_rents(spark, d), keys, "price", *_R)
    return marts.ratio_mart(s, r, keys, _R, _S, "gross_yield_pct", 5200.0, floor, None)


@_query(f"WITH {_YIELD.format(floor=5)} SELECT * FROM y")
def ratio_mart(spark: SparkSession, d: str) -> DataFrame:
    return _yield(spark, d)


@_query(f"""WITH {_YIELD.format(floor=1)} SELECT month, property_type, (CAST(sum(CAST(total_sale_value AS DECIMAL(28,2))) AS DOUBLE) / sum(n_sold)) AS avg_price,
    CAST(sum(n_sold) AS BIGINT) AS sales, CAST(sum(CAST(total_weekly_rent AS DECIMAL(28,2))) AS DOUBLE) / sum(n_rented) AS avg_rent, CAST(sum(n_rented) AS BIGINT) AS bonds,
    round(5200 * (CAST(sum(CAST(total_weekly_rent AS DECIMAL(28,2))) AS DOUBLE) / sum(n_rented)) / (CAST(sum(CAST(total_sale_value AS DECIMAL(28,2))) AS DOUBLE) / sum(n_sold)), 6) AS gross_yield_pct
    FROM y GROUP BY month, property_type""")
def measures_by_month(spark: SparkSession, d: str) -> DataFrame:
    legs = _yield(spark, d, 1).withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("total_sale_value", "total_weekly_rent")})
    m = measures()
    return legs.groupBy("month", "property_type").agg(*[(F.round(c, 6) if n == "gross_yield_pct" else c).alias(n) for n, c in m.items()])


@_query(f"WITH {_LEGS} SELECT month, count(*) AS grain_rows, CAST(sum(n_sold) AS BIGINT) AS n_sold, CAST(sum(CAST(total_sale_value AS DECIMAL(28,2))) AS DOUBLE) AS total_sale_value FROM s GROUP BY month")
def parity_rollup(spark: SparkSession, d: str) -> DataFrame:
    return marts.roll_up(marts.legs(_sales(spark, d), ("postcode", "property_type", "month"), "price", *_S), ("month",), _S[0], _S[1])


@_query(f"""WITH {_SALES}, a AS (SELECT month, count(*) AS n FROM sales GROUP BY month), b AS (SELECT month, count(*) AS n FROM sales WHERE postcode <> '3' OR month < DATE '1999-01-01' GROUP BY month)
    SELECT month, 'n' AS "column", CAST(a.n AS DOUBLE) AS reference, CAST(b.n AS DOUBLE) AS actual,
    CASE WHEN b.n IS NULL THEN 'only_reference' ELSE 'differs' END AS kind FROM a LEFT JOIN b USING (month) WHERE b.n IS NULL OR a.n <> b.n""")
def parity_diff(spark: SparkSession, d: str) -> DataFrame:
    s = _sales(spark, d)
    count = lambda df: df.groupBy("month").agg(F.count("*").alias("n"))
    return quality.parity(count(s), count(s.where("postcode <> '3' OR month < DATE '1999-01-01'")), ["month"], ["n"])


# Published queries


_TOP_SQL = f"""WITH {_LEGS}, top AS (SELECT max(month) AS m FROM s)"""


@_query(f"WITH {_YIELD.format(floor=5)} SELECT postcode, property_type, month, gross_yield_pct, n_sold, n_rented FROM y ORDER BY gross_yield_pct DESC, postcode, property_type, month LIMIT 10")
def leaderboard_topk(spark: SparkSession, d: str) -> DataFrame:
    return _yield(spark, d).select("postcode", "property_type", "month", "gross_yield_pct", "n_sold", "n_rented").orderBy(F.desc("gross_yield_pct"), "postcode", "property_type", "month").limit(10)


@_query(f"""{_TOP_SQL} SELECT postcode, CAST(sum(CAST(total_sale_value AS DECIMAL(28,2))) AS DOUBLE) / sum(n_sold) AS avg_price FROM s, top
    WHERE month > m - INTERVAL 12 MONTH AND property_type = 'BUILDING' GROUP BY postcode HAVING sum(n_sold) >= 10 ORDER BY avg_price DESC, postcode LIMIT 10""")
def trailing_12m_topk(spark: SparkSession, d: str) -> DataFrame:
    mart = marts.legs(_sales(spark, d), ("postcode", "property_type", "month"), "price", *_S).withColumn(_S[0], F.col(_S[0]).cast("decimal(28,2)"))
    recent = marts.trailing(mart, "month", 12).where("property_type = 'BUILDING'")
    return marts.leaderboard(recent, ["postcode"], ratio(*_S), "avg_price", F.sum("n_sold") >= 10, 10)


@_query(f"""WITH {_YIELD.format(floor=1)} SELECT postcode, property_type, month, gross_yield_pct FROM y WHERE month = (SELECT max(month) FROM y) AND n_sold >= 1 AND n_rented >= 1""")
def latest_month_yield(spark: SparkSession, d: str) -> DataFrame:
    return marts.latest(_yield(spark, d, 1), "month").select("postcode", "property_type", "month", "gross_yield_pct")


@_query(f"{_TOP_SQL} SELECT postcode, property_type, s.month, n_sold, total_sale_value FROM s, top WHERE s.month = m")
def latest_month_lookup(spark: SparkSession, d: str) -> DataFrame:
    return marts.latest(marts.legs(_sales(spark, d), ("postcode", "property_type", "month"), "price", *_S), "month").select("postcode", "property_type", "month", "n_sold", "total_sale_value")


@_query(f"""WITH {_SALES}, m AS (SELECT property_type, month, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price FROM sales GROUP BY ALL)
    SELECT property_type, month, avg_price, avg_price - lag(avg_price) OVER (PARTITION BY property_type ORDER BY month) AS change FROM m""")
def mom_change(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.legs(_sales(spark, d), ("property_type", "month"), "price", *_S)
    return spark.sql("""WITH m AS (SELECT property_type, month, total_sale_value / CAST(n_sold AS DOUBLE) AS avg_price FROM {rows})
        SELECT property_type, month, avg_price, avg_price - lag(avg_price) OVER w AS change FROM m WINDOW w AS (PARTITION BY property_type ORDER BY month)""", rows=rows)


@_query(f"""WITH {_RENTS} SELECT bedroom_band, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_rent, count(*) AS n FROM rents
    WHERE year(month) = 1998 AND bedroom_band <> '4-NOT SPECIFIED' GROUP BY bedroom_band""")
def rent_by_band(spark: SparkSession, d: str) -> DataFrame:
    rows = _rents(spark, d).where((F.year("month") == 1998) & (F.col("bedroom_band") != "4-NOT SPECIFIED"))
    out = marts.legs(rows, ("bedroom_band",), "price", "total", "n")
    return out.select("bedroom_band", (F.col("total") / F.col("n").cast("double")).alias("avg_rent"), "n")


@_query("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7 ORDER BY o_orderdate DESC, o_orderkey LIMIT 50""")
def latest_rows(spark: SparkSession, d: str) -> DataFrame:
    o, c = _read(spark, d, "orders"), _read(spark, d, "customer").where("c_nationkey = 7")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50)


# Repair


@_query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS sale_date,
    CASE WHEN o_orderkey % 5 = 3 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS digits FROM orders""")
def repair_encodings(spark: SparkSession, d: str) -> DataFrame:
    day, era = F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderkey") % 5
    mantissa = F.concat(F.substring(day, 1, 1), F.lit("."), F.substring(day, 2, 7), F.lit("E7"))
    dirty = F.when(era == 0, day).when(era == 1, F.concat(day, F.lit(".0"))).when(era == 2, mantissa).when(era == 3, "not-a-date").otherwise(F.concat(F.substring(day, 3, 6), F.lit(".0")))
    number = F.when(era == 3, F.lit("12a")).otherwise(F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(".0 ")))
    return _read(spark, d, "orders").select("o_orderkey", repair.compact_date(dirty).alias("sale_date"), repair.digits_from_floatish(number).alias("digits"))


@_query("""SELECT p_partkey, CASE WHEN p_retailprice < 400 THEN '<400' WHEN p_retailprice < 700 THEN '400-700' WHEN p_retailprice < 1000 THEN '700-1000' WHEN p_retailprice < 5000 THEN '1000-5000' ELSE '5000+' END AS area_band,
    CASE WHEN p_size % 7 = 0 THEN 'unknown' WHEN p_size % 7 >= 5 THEN '5+' ELSE CAST(p_size % 7 AS VARCHAR) END AS bedroom_band,
    CASE WHEN p_size % 3 = 0 THEN 'house' ELSE 'unit' END AS by_strata, CASE WHEN p_size % 4 IN (0, 1) THEN 'house' ELSE 'unit' END AS by_code,
    CASE WHEN p_size % 3 = 0 THEN p_size * 10000.0::DOUBLE WHEN p_size % 3 = 1 THEN CAST(p_size AS DOUBLE) END AS area_sqm FROM part""")
def banding(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    strata = F.when(size % 3 == 0, "").when(size % 3 == 1, " ").otherwise("SP1")
    code = F.when(size % 4 == 0, " h").when(size % 4 == 1, "T ").when(size % 4 == 2, "F")
    unit = F.when(size % 3 == 0, "H").when(size % 3 == 1, " m ").otherwise("")
    return _read(spark, d, "part").select(
        "p_partkey", repair.area_band(F.col("p_retailprice")).alias("area_band"), repair.count_band(F.when(size % 7 != 0, size % 7)).alias("bedroom_band"),
        repair.dwelling_by_strata(strata).alias("by_strata"), repair.dwelling_by_code(code).alias("by_code"), repair.area_sqm(size.cast("string"), unit).alias("area_sqm"),
    )


_TITLE = "array_to_string(list_transform(string_split(lower(trim({0})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@_query(f"""SELECT p_partkey, {_TITLE.format("p_name")} AS by_space, {_TITLE.format("p_type")} AS type_by_space,
    array_to_string(list_transform(regexp_extract_all(lower(trim(p_type || '-' || p_brand)), '[a-z0-9]+|[^a-z0-9]+'), lambda w: upper(w[1]) || w[2:]), '') AS by_run FROM part""")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "part").select(
        "p_partkey", repair.title_by_space(F.col("p_name")).alias("by_space"), repair.title_by_space(F.col("p_type")).alias("type_by_space"), repair.title_by_run(F.concat_ws("-", "p_type", "p_brand")).alias("by_run")
    )


@_query("""SELECT event_id, lpad(CAST(event_id // 60 AS VARCHAR), CAST(greatest(2, length(CAST(event_id // 60 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') AS clock,
    'kind' || CAST(event_id % 3 AS VARCHAR) AS kind, CAST(date_trunc('month', ts) AS DATE) AS month FROM events""")
def clocks_and_kinds(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("runs/kind"), (F.col("event_id") % 3).cast("string"), F.when(F.col("event_id") % 2 == 0, "-2026.json").otherwise(".json"))
    return _read(spark, d, "events").select("event_id", repair.clock(F.concat(F.col("event_id").cast("string"), F.lit(".7"))).alias("clock"), repair.kind_from_name(name).alias("kind"), repair.month_of(F.col("ts")).alias("month"))


@_query("""WITH k AS (SELECT o_orderkey, substr(sha256(CAST(o_custkey AS VARCHAR) || '|' || coalesce(CAST(NULL AS VARCHAR), '') || '|' || o_orderpriority), 1, 16) AS h FROM orders)
    SELECT o_orderkey, h || '-' || CAST(row_number() OVER (PARTITION BY h ORDER BY o_orderkey) AS VARCHAR) AS sale_id FROM k""")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    key = repair.business_hash([F.col("o_custkey"), F.lit(None).cast("string"), F.col("o_orderpriority")])
    return versions.numbered_keys(_read(spark, d, "orders"), key, ["o_orderkey"], "sale_id").select("o_orderkey", "sale_id")


# Quality


def _flagged(spark, d):
    rows = _read(spark, d, "orders").select(
        "o_orderkey", repair.month_of(F.col("o_orderdate")).alias("month"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate").cast("date")).alias("sale_date"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_totalprice")).alias("sale_price"), F.when(F.col("o_orderstatus") == "P", F.lit(None)).when(F.col("o_orderstatus") == "F", "COMMERCIAL").otherwise("RESIDENCE").alias("purpose"),
        F.when(F.col("o_orderkey") % 17 == 0, " ").otherwise("X").alias("locality"), F.when(F.col("o_orderkey") % 19 != 0, "2000").alias("postcode"),
    )
    return quality.flag(rows, quality.sale_rules(1996, 20_000, 400_000))


_FLAGS = """f AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, list_filter([
    CASE WHEN o_orderkey % 11 = 0 THEN 'unparseable_contract_date' END, CASE WHEN o_orderkey % 11 <> 0 AND year(o_orderdate) < 1996 THEN 'pre_2010_sale' END,
    CASE WHEN o_orderkey % 13 = 0 THEN 'unparseable_price' END, CASE WHEN o_orderkey % 13 <> 0 AND o_totalprice < 20000 THEN 'non_arms_length_price' END,
    CASE WHEN o_orderkey % 13 <> 0 AND o_totalprice > 400000 THEN 'price_above_cap' END, CASE WHEN o_orderstatus = 'F' THEN 'not_residence' END,
    CASE WHEN o_orderkey % 17 = 0 THEN 'blank_locality' END, CASE WHEN o_orderkey % 19 = 0 THEN 'bad_postcode' END], lambda x: x IS NOT NULL) AS q FROM orders)"""


@_query(f"WITH {_FLAGS} SELECT o_orderkey, array_to_string(q, ',') AS reasons, len(q) = 0 AS is_valid FROM f")
def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).select("o_orderkey", F.array_join("_quality", ",").alias("reasons"), F.col("_is_valid").alias("is_valid"))


@_query(f"WITH {_FLAGS}, x AS (SELECT month, unnest(CASE WHEN len(q) = 0 THEN ['ok'] ELSE q END) AS reason FROM f) SELECT month, reason, count(*) AS rows FROM x GROUP BY ALL")
def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary(_flagged(spark, d), "month")


@_query(f"""WITH {_FLAGS}, x AS (SELECT unnest(CASE WHEN len(q) = 0 THEN ['ok'] ELSE q END) AS reason FROM f), g AS (SELECT reason, count(*) AS rows FROM x GROUP BY ALL)
    SELECT * FROM (SELECT reason, rows, 100.0::DOUBLE * rows / (SELECT sum(rows) FROM g) AS pct FROM g) WHERE reason <> 'ok'""")
def quality_share(spark: SparkSession, d: str) -> DataFrame:
    return quality.share(quality.summary(_flagged(spark, d), "month"))


@_query(f"WITH {_FLAGS} SELECT len(q) = 0 AS is_valid, count(*) AS rows FROM f GROUP BY ALL")
def quality_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.profile(_flagged(spark, d)).select(F.col("_is_valid").alias("is_valid"), "rows")


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def grain_check(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(_read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("""SELECT 'orders' AS "check", count(*) AS rows, count(*) - count(DISTINCT o_orderkey) AS duplicate_keys FROM orders
    UNION ALL SELECT 'lineitem', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem""")
def grain_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.grain_report("orders", _read(spark, d, "orders"), ["o_orderkey"]).unionByName(quality.grain_report("lineitem", _read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]))


@_query("SELECT count(DISTINCT o_custkey) AS n, CAST(5000 AS BIGINT) AS floor, CAST(greatest(0, 5000 - count(DISTINCT o_custkey)) AS BIGINT) AS shortfall FROM orders")
def coverage_check(spark: SparkSession, d: str) -> DataFrame:
    return quality.coverage(_read(spark, d, "orders"), "o_custkey", 5000)


@_query(f"WITH {_YIELD.format(floor=1)} SELECT postcode, property_type, month, gross_yield_pct FROM y WHERE NOT gross_yield_pct BETWEEN 200 AND 25000")
def plausibility_check(spark: SparkSession, d: str) -> DataFrame:
    return quality.out_of_band(_yield(spark, d, 1), "gross_yield_pct", 200, 25_000).select("postcode", "property_type", "month", "gross_yield_pct")


# Versions and snapshots


def _landed(spark, d):
    o = _read(spark, d, "orders")
    label = F.date_format("o_orderdate", "yyyy")
    sha = F.when(F.col("o_orderkey") % 3 == 0, "0000000a").when(F.col("o_orderkey") % 3 == 1, "0000000b").otherwise("zz")
    at = F.when((F.col("o_orderkey") % 3 == 0) & (F.year("o_orderdate") % 2 == 0), F.to_timestamp(F.lit("2026-02-01"))).otherwise(F.to_timestamp(F.lit("2026-01-01")))
    return o.select("o_orderkey", F.concat(F.lit("/in/year="), label, F.lit("_"), sha, F.lit(".parquet")).alias("_source_file"), at.alias("_ingested_at"))


@_query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = CASE WHEN year(o_orderdate) % 2 = 0 THEN 0 ELSE 1 END""")
def resolve_versions(spark: SparkSession, d: str) -> DataFrame:
    return versions.resolve_versions(_landed(spark, d)).select("o_orderkey")


@_query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE upper(c_name) END AS c_name, c_custkey % 5 <> 0 AS is_current,
    CASE WHEN c_custkey % 5 = 0 THEN DATE '2026-01-01' ELSE DATE '2026-02-01' END AS synced FROM customer""")
def snapshot_reconcile(spark: SparkSession, d: str) -> DataFrame:
    c = _read(spark, d, "customer").select("c_custkey", "c_name")
    state = c.where("c_custkey % 7 <> 1 OR c_custkey % 5 = 0").withColumns({"is_current": F.col("c_custkey") % 2 == 0, "_synced_at": F.to_timestamp(F.lit("2026-01-01"))})
    shot = c.where("c_custkey % 5 <> 0").withColumn("c_name", F.upper("c_name"))
    out = versions.reconcile(state, shot, ["c_custkey"], ["c_name"], F.to_timestamp(F.lit("2026-02-01")))
    return out.select("c_custkey", "c_name", "is_current", F.col("_synced_at").cast("date").alias("synced"))


@_query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = (SELECT max(o_orderkey % 4) FROM orders)""")
def newest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    rows = _read(spark, d, "orders").select("o_orderkey", F.to_timestamp(F.lit("2026-01-01")).alias("_ingested_at"), F.concat(F.lit("f"), k.cast("string")).alias("_source_file"))
    return versions.newest_snapshot(rows).select("o_orderkey")


# Features, split, model data


_FEATURES = f"""{_RENTS},
    r0 AS ({_mart_sql("rents", "postcode, property_type, month", "weekly_rent", *_R)}),
    r1 AS (SELECT *, year(month) * 12 + month(month) AS mi FROM r0),
    r2 AS (SELECT *, avg(avg_weekly_rent) OVER w AS rent_mean_3, avg(n_rented) OVER w AS volume_mean_3 FROM r1 WINDOW w AS (PARTITION BY postcode, property_type ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
    p AS (SELECT property_type, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS price_lag_1 FROM sales GROUP BY property_type, month),
    feats AS (SELECT a.postcode, a.property_type, a.month, b.median_weekly_rent AS rent_lag_1, c.median_weekly_rent AS rent_lag_3, e.median_weekly_rent AS rent_lag_12,
        round(a.rent_mean_3 + 3.7e-7, 5) AS rent_mean_3, round(a.volume_mean_3 + 3.7e-7, 5) AS volume_mean_3, price_lag_1, CAST(month(a.month) AS INTEGER) AS month_of_year, a.median_weekly_rent
        FROM r2 a JOIN r1 b ON a.postcode = b.postcode AND a.property_type = b.property_type AND b.mi = a.mi - 1
        LEFT JOIN r1 c ON a.postcode = c.postcode AND a.property_type = c.property_type AND c.mi = a.mi - 3
        LEFT JOIN r1 e ON a.postcode = e.postcode AND a.property_type = e.property_type AND e.mi = a.mi - 12
        LEFT JOIN p ON a.property_type = p.property_type AND a.month = p.month)"""


def _features(spark, d):
    keys = ("postcode", "property_type")
    out = features.build(_rent_mart(spark, d, (*keys, "month")), _sales_mart(spark, d), keys, ["property_type"])
    # The two engines add a frame's doubles in another order; the offset keeps exact halves from rounding apart.
    return out.withColumns({c: F.round(F.col(c) + 3.7e-7, 5) for c in ("rent_mean_3", "volume_mean_3")})


@_query(f"WITH {_FEATURES} SELECT * FROM feats")
def calendar_lag_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d)


@_query(f"""WITH {_FEATURES}, cut AS (SELECT CAST(max(month) - INTERVAL 6 MONTH AS DATE) AS c FROM feats)
    SELECT 'train' AS part, count(*) AS n FROM feats, cut WHERE month <= c UNION ALL SELECT 'test', count(*) FROM feats, cut WHERE month > c""")
def time_split_counts(spark: SparkSession, d: str) -> DataFrame:
    train, test = features.split_by_month(_features(spark, d), "month", 6)
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
    return count(train, "train").unionByName(count(test, "test"))


@_query(f"WITH {_FEATURES} SELECT count(*) AS n, round(avg(abs(rent_lag_1 - median_weekly_rent)), 4) AS mae FROM feats")
def naive_mae(spark: SparkSession, d: str) -> DataFrame:
    from tessera.operators.model import naive_mae as mae

    return mae(_features(spark, d), "median_weekly_rent", "rent_lag_1").withColumn("mae", F.round("mae", 4))


@_query(f"WITH {_FEATURES} SELECT month, count(*) AS n_scored, round(avg(abs(rent_lag_12 - median_weekly_rent)), 3) AS mae FROM feats WHERE rent_lag_12 IS NOT NULL GROUP BY month")
def accuracy_by_month(spark: SparkSession, d: str) -> DataFrame:
    return monitor.accuracy(_features(spark, d), ["month"], "rent_lag_12", "median_weekly_rent", 3)


_PSI = ("l_quantity", "l_extendedprice", "l_discount")
_PSI_SQL = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, round(sum((c - r) * ln(c / r)), 6) AS psi FROM (
        SELECT greatest(coalesce(rr, 0) / (SELECT count(*)::DOUBLE FROM ref), 1e-4) AS r, greatest(coalesce(cc, 0) / (SELECT count(*)::DOUBLE FROM cur), 1e-4) AS c FROM (
            SELECT b, sum(CASE WHEN side = 0 THEN 1 END) AS rr, sum(CASE WHEN side = 1 THEN 1 END) AS cc FROM (
                SELECT side, len(list_filter(e[2:len(e) - 1], lambda q: q <= {f})) AS b
                FROM (SELECT 0 AS side, {f} FROM ref UNION ALL SELECT 1, {f} FROM cur), (
                    SELECT list_sort(list_distinct(list_transform(quantile_cont({f}, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]), lambda q: round(q, 4)))) AS e FROM ref)) GROUP BY b))"""
    for f in _PSI
)


@_query(f"""WITH ref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'), cur AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
    p AS ({_PSI_SQL}) SELECT feature, psi, CASE WHEN psi > 0.25 THEN 'shifted' WHEN psi > 0.1 THEN 'drifting' ELSE 'stable' END AS status FROM p""")
def psi_by_feature(spark: SparkSession, d: str) -> DataFrame:
    li = _read(spark, d, "lineitem")
    early = F.col("l_shipdate") < F.to_timestamp(F.lit("1999-01-01"))
    return monitor.psi(li.where(early), li.where(~early), _PSI, 4).withColumn("psi", F.round("psi", 6))


# Forecasts


_SERIES = f"""{_SALES}, series AS (SELECT property_type, month, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS y FROM sales WHERE month < (SELECT max(month) FROM sales) GROUP BY ALL)"""


def _series(spark, d):
    s = _sales(spark, d)
    last = F.broadcast(s.agg(F.max("month").alias("_m")))  # one row
    rows = marts.legs(s.join(last, F.col("month") < F.col("_m"), "left_semi"), ("property_type", "month"), "price", *_S)
    return rows.select("property_type", "month", (F.col("total_sale_value") / F.col("n_sold").cast("double")).alias("y"))


def _trend_sql(history: str, horizon: int) -> str:
    return f"""h0 AS (SELECT property_type, month, y, CAST(year(month) * 12 + month(month) AS DOUBLE) AS t, month(month) AS moy FROM {history}),
    cell AS (SELECT property_type, moy, avg(t) AS mt, avg(y) AS my FROM h0 GROUP BY ALL),
    slope AS (SELECT property_type, sum((t - mt) * (y - my)) / sum((t - mt) * (t - mt)) AS b FROM h0 JOIN cell USING (property_type, moy) GROUP BY ALL),
    ends AS (SELECT property_type, max(month) AS last, count(*) AS n FROM {history} GROUP BY ALL HAVING count(*) >= 36),
    fut AS (SELECT property_type, CAST(last + to_months(CAST(k AS INTEGER)) AS DATE) AS month FROM ends, range(1, {horizon + 1}) r(k)),
    trend AS (SELECT property_type, month, my + b * (year(month) * 12 + month(month) - mt) AS yhat FROM fut JOIN slope USING (property_type) JOIN cell ON cell.property_type = fut.property_type AND cell.moy = month(fut.month)),
    naive AS (SELECT fut.property_type, fut.month, p.y AS yhat FROM fut LEFT JOIN {history} p ON p.property_type = fut.property_type AND p.month = CAST(fut.month - INTERVAL 12 MONTH AS DATE))"""


@_query(f"WITH {_SERIES}, {_trend_sql('series', 6)} SELECT property_type, month, round(yhat, 3) AS yhat FROM trend")
def forecast_trend_season(spark: SparkSession, d: str) -> DataFrame:
    return forecast.trend_seasonal(_series(spark, d), ["property_type"], "month", "y", 6).withColumn("yhat", F.round("yhat", 3))


@_query(f"WITH {_SERIES}, {_trend_sql('series', 6)} SELECT property_type, month, yhat FROM naive")
def forecast_naive(spark: SparkSession, d: str) -> DataFrame:
    return forecast.seasonal_naive(_series(spark, d), ["property_type"], "month", "y", 6)


@_query(f"""WITH {_SERIES}, cut AS (SELECT CAST(max(month) - INTERVAL 6 MONTH AS DATE) AS c FROM series), hist AS (SELECT series.* FROM series, cut WHERE month <= c), {_trend_sql('hist', 6)},
    m AS (SELECT 'trend_seasonal' AS method, * FROM trend UNION ALL SELECT 'seasonal_naive', * FROM naive)
    SELECT method, CAST((year(month) - year(c)) * 12 + month(month) - month(c) AS INTEGER) AS horizon, count(*) AS n, round(avg(abs(yhat - y)), 3) AS mae
    FROM m JOIN series USING (property_type, month), cut GROUP BY ALL""")
def forecast_backtest(spark: SparkSession, d: str) -> DataFrame:
    return forecast.backtest(_series(spark, d), ["property_type"], "month", "y", 6).withColumn("mae", F.round("mae", 3))


@_query()
def group_map_forecast(spark: SparkSession, d: str) -> DataFrame:
    return forecast.damped_holt(_series(spark, d), ["property_type"], "month", "y", 6, "property_type string, month date, yhat double")


@_query()
def gbt_score(spark: SparkSession, d: str) -> DataFrame:
    from tessera.operators import model

    numeric = ["rent_lag_1", "rent_lag_3", "rent_lag_12", "rent_mean_3", "volume_mean_3", "price_lag_1", "month_of_year"]
    train, test = features.split_by_month(scratch.written(_features(spark, d), "features"), "month", 6)
    fitted = model.fit(train, ["property_type"], numeric, "median_weekly_rent")
    return model.score(fitted, test, numeric, "predicted_weekly_rent").select("postcode", "property_type", "month", "predicted_weekly_rent", "median_weekly_rent")


# Corpus


@_query("""WITH c AS (SELECT source AS video_id, CAST(doc_id AS INTEGER) AS chunk_index, CASE WHEN doc_id % 2 = 0 THEN lang || chr(10) || text ELSE text END AS body, text FROM documents)
    SELECT video_id || ':' || CAST(chunk_index AS VARCHAR) AS chunk_key, video_id, chunk_index, substr(sha256(body), 1, 16) AS text_sha, length(body) AS n FROM c""")
def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("chunk_key", "video_id", "chunk_index", "text_sha", F.char_length("embedding_text").cast("long").alias("n"))


def _chunks(spark, d):
    rows = _read(spark, d, "documents").select(F.col("source").alias("video_id"), F.col("doc_id").alias("chunk_index"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("context_header"), F.lit(None).cast("string").alias("title"), "text")
    return corpus.chunk_rows(rows)


_DOCS = """v AS (SELECT CAST(conv_id AS VARCHAR) AS video_id, list({'text': text, 'offset_ms': turn * 1000, 'start_seconds': turn * 1.0} ORDER BY turn) AS segs, list(DISTINCT role ORDER BY role) AS roles FROM conversations GROUP BY conv_id)"""


def _records(spark, d):
    c = _read(spark, d, "conversations")
    seg = F.array_sort(F.collect_list(F.struct("turn", "text")))
    segs = F.transform(seg, lambda x: F.struct(x["text"].alias("text"), (x["turn"] * 1000).alias("offset_ms"), x["turn"].cast("double").alias("start_seconds")))
    doc = c.groupBy("conv_id").agg(segs.alias("segments"), F.array_sort(F.collect_set("role")).alias("tags"))
    body = F.to_json(F.struct(F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("body "), F.col("conv_id").cast("string"))).alias("description"), "tags", "segments"))
    return doc.select(F.col("conv_id").cast("string").alias("video_id"), body.alias("document"), F.lit("meta").alias("description"))


@_query(f"""WITH {_DOCS} SELECT video_id, CASE WHEN CAST(video_id AS BIGINT) % 2 = 0 THEN 'body ' || video_id ELSE 'meta' END AS description, array_to_string(roles, ',') AS tags, CAST(len(segs) AS INTEGER) AS n_segments FROM v""")
def blob_unpack(spark: SparkSession, d: str) -> DataFrame:
    return corpus.transcript_rows(_records(spark, d)).select("video_id", "description", F.array_join("tags", ",").alias("tags"), "n_segments")


@_query("""SELECT CAST(conv_id AS VARCHAR) AS video_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS segment_index, text, turn * 1000 AS offset_ms, CAST(turn AS DOUBLE) AS start_seconds FROM conversations""")
def segment_rows(spark: SparkSession, d: str) -> DataFrame:
    return corpus.segment_rows(_records(spark, d))


@_query("""SELECT CASE WHEN count(*) = 0 THEN 'empty000' ELSE substr(sha256(CAST(count(*) AS VARCHAR) || '|' || CAST(sum(CAST('0x' || substr(h, 1, 8) AS HUGEINT)) AS VARCHAR) || '|' || CAST(sum(CAST('0x' || substr(h, 9, 8) AS HUGEINT)) AS VARCHAR) || '|' || CAST(sum(CAST('0x' || substr(h, 17, 8) AS HUGEINT)) AS VARCHAR) || '|' || CAST(sum(CAST('0x' || substr(h, 25, 8) AS HUGEINT)) AS VARCHAR)), 1, 8) END AS sha
    FROM (SELECT sha256('{"doc_id":' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ',"quality":' || coalesce(CAST(quality AS VARCHAR), 'null') || ',"toxic":' || coalesce(CAST(toxic AS VARCHAR), 'null') || '}') AS h FROM labels)""")
def frame_hash(spark: SparkSession, d: str) -> DataFrame:
    return corpus.frame_sha(_read(spark, d, "labels"))


# Joins that find what is missing


@_query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_pending(spark: SparkSession, d: str) -> DataFrame:
    key = lambda name: _read(spark, d, name).select(F.col("doc_id").cast("string").alias("chunk_key"), F.lit("x").alias("text_sha"))
    return retrieval.pending(key("documents"), key("labels")).select(F.col("chunk_key").cast("long").alias("doc_id"))


@_query("SELECT CAST(doc_id AS VARCHAR) AS chunk_key FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 1")
def stale_keys(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_key"), "doc_id")
    state = docs.select(F.lit("idx").alias("index_name"), "chunk_key", F.lit("x").alias("text_sha"))
    return retrieval.stale(state, docs.where("doc_id % 3 = 0").withColumn("is_current", F.col("doc_id") % 2 == 0), "idx")


@_query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 0")
def retire_state(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_key"), "doc_id")
    state = docs.select(F.lit("idx").alias("index_name"), "chunk_key", F.lit("x").alias("text_sha"))
    return retrieval.retire(state, docs.where("doc_id % 3 = 0").withColumn("is_current", F.col("doc_id") % 2 == 0), "idx").select(F.col("chunk_key").cast("long").alias("doc_id"))


@_query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def orphan_check(spark: SparkSession, d: str) -> DataFrame:
    li, p = _read(spark, d, "lineitem"), _read(spark, d, "part").where("p_size > 5")
    return li.join(p, li.l_partkey == p.p_partkey, "left_anti").select("l_orderkey", "l_linenumber")


# Retrieval


_KNN = """q AS (SELECT vec_id AS qid, embedding AS e FROM embeddings WHERE vec_id % 20 = 0),
    hits AS (SELECT qid, vec_id, list_dot_product(e::DOUBLE[], embedding::DOUBLE[]) / (sqrt(list_dot_product(e::DOUBLE[], e::DOUBLE[])) * sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS score FROM q, embeddings WHERE qid <> vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM hits)"""


def _knn(spark, d, k=10):
    e = _read(spark, d, "embeddings")
    return retrieval.top_k(e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "embedding"), e, k, "qid", "vec_id", exclude_self=True)


@_query(f"WITH {_KNN} SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM ranked WHERE rank <= 10")
def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    return _knn(spark, d).select("qid", "vec_id", "rank", F.round("score", 5).alias("score"))


def _relevant(spark, d):
    """(hits with whether they are relevant, cases with their number of relevant items): what has the query's label."""
    label = _read(spark, d, "embeddings").select("vec_id", "label")
    asked = label.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("label").alias("own"))
    totals = asked.join(label.groupBy("label").agg(F.count("*").alias("n")), F.col("own") == F.col("label")).select(F.col("qid").alias("case_id"), "n")
    mark = lambda hits: hits.join(asked, "qid").join(label, "vec_id").select(F.col("qid").alias("case_id"), "rank", (F.col("own") == F.col("label")).alias("relevant"))
    return mark, totals


def _scored(spark, d):
    mark, totals = _relevant(spark, d)
    return retrieval.ir_scores(mark(_knn(spark, d)), totals, 10)


_IR = f"""{_KNN}, rel AS (SELECT a.vec_id AS qid, b.vec_id AS vid FROM embeddings a JOIN embeddings b USING (label) WHERE a.vec_id % 20 = 0),
    nrel AS (SELECT qid, count(*) AS n FROM rel GROUP BY qid),
    j AS (SELECT ranked.qid AS qid, rank FROM ranked JOIN rel ON ranked.qid = rel.qid AND vec_id = vid WHERE rank <= 10),
    m AS (SELECT nrel.qid AS case_id, count(rank) / CAST(n AS DOUBLE) AS recall, coalesce(1.0 / min(rank), 0) AS mrr,
        coalesce(sum(1 / log2(rank + 1)), 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, 1 + least(n, 10)) t(i)) AS ndcg FROM nrel LEFT JOIN j ON j.qid = nrel.qid GROUP BY nrel.qid, n)"""


@_query(f"WITH {_IR} SELECT case_id, round(recall, 6) AS recall, round(mrr::DOUBLE, 6) AS mrr, round(ndcg, 6) AS ndcg FROM m")
def ir_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = _scored(spark, d)
    return out.select("case_id", *[F.round(c, 6).alias(c) for c in ("recall", "mrr", "ndcg")])


@_query(f"WITH {_IR} SELECT count(*) AS n, round(avg(recall), 6) AS recall, round(avg(mrr)::DOUBLE, 6) AS mrr, round(avg(ndcg), 6) AS ndcg FROM m")
def ir_aggregate(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.mean_missing_zero(_scored(spark, d), ("recall", "mrr", "ndcg"))
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("recall", "mrr", "ndcg")])


@_query("""SELECT conv_id, array_to_string(list(text ORDER BY turn)[1:16], '|') AS contexts FROM conversations GROUP BY conv_id""")
def context_collect(spark: SparkSession, d: str) -> DataFrame:
    c = _read(spark, d, "conversations").select("conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("chunk_key"), "text")
    refs = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "chunk_key"))), lambda x: x["chunk_key"]).alias("chunk_keys"))
    return retrieval.collect_context(refs, c, ["conv_id"]).select("conv_id", F.array_join("context_texts", "|").alias("contexts"))


@_query("""SELECT doc_id AS case_id, CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN doc_id % 2 = 0 THEN 'k' || CAST(m AS VARCHAR) END AS chunk_key
    FROM documents JOIN (SELECT text, max(doc_id) AS m FROM documents GROUP BY text) USING (text)""")
def reanchor_chunks(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha"))
    landed = docs.where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("chunk_id"), "text_sha")
    # Of equal texts the largest number, not the largest string, gives the key.
    current = docs.groupBy("text_sha").agg(F.concat(F.lit("k"), F.max("doc_id").cast("string")).alias("chunk_key"))
    return retrieval.reanchor(docs.select(F.col("doc_id").alias("case_id"), F.col("doc_id").cast("string").alias("chunk_id")), landed, current)


# Graders and gates


@_query("""SELECT doc_id, len(n) AS found, list_min(n) AS least, list_max(n) AS largest, n[1] AS first, n[len(n)] AS last
    FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '-?[0-9][0-9,]*(?:\\.[0-9]+)?'), lambda x: CAST(replace(x, ',', '') AS DOUBLE)) AS n FROM documents)""")
def extract_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "documents").select("doc_id", text.extract_numbers(F.col("text")).alias("n"))
    return rows.select("doc_id", F.size("n").cast("long").alias("found"), F.array_min("n").alias("least"), F.array_max("n").alias("largest"), F.get("n", F.lit(0)).alias("first"), F.get("n", F.size("n") - 1).alias("last"))


@_query("SELECT o_orderkey, abs(o_totalprice * 1.04 - o_totalprice) <= o_totalprice * 5.0 / 100 AS near, false AS far FROM orders")
def value_grade(spark: SparkSession, d: str) -> DataFrame:
    o, price = _read(spark, d, "orders"), F.col("o_totalprice")
    said = lambda f: F.concat(F.lit("About $"), F.format_number(price * f, 2), F.lit(" in all"))
    return o.select("o_orderkey", text.value_grade(said(1.04), price).alias("near"), text.value_grade(said(1.06), price).alias("far"))


@_query("""SELECT doc_id, len(list_filter(['the', 'que', 'der', 'de'], lambda k: regexp_matches(regexp_replace(text, '[^\\x00-\\x7F]', 'é', 'g'), '(^|[^A-Za-z0-9_é])' || k || '($|[^A-Za-z0-9_é])'))) >= 2 AS hit FROM documents""")
def topk_grade(spark: SparkSession, d: str) -> DataFrame:
    keys = F.array(*map(F.lit, ("the", "que", "der", "de")))
    return _read(spark, d, "documents").select("doc_id", text.topk_grade(F.col("text"), keys, 2).alias("hit"))


@_query("SELECT c_custkey, c_custkey % 4 = 0 OR c_custkey % 4 = 1 AS refused FROM customer")
def refusal_grade(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    said = F.when(k == 0, "I CANNOT ANSWER that").when(k == 1, "That is out of scope.").when(k == 2, "It is 42.")
    return _read(spark, d, "customer").select("c_custkey", text.refusal_grade(said).alias("refused"))


def _answers(spark, d):
    dd, la = _read(spark, d, "documents"), _read(spark, d, "labels")
    score = lambda m: F.when(F.col("doc_id") % m != 0, (F.col("doc_id") % 11) / 13.0)
    rows = dd.join(la, "doc_id", "left").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "broad").otherwise("narrow").alias("tier"), (F.col("doc_id") % 7).cast("int").alias("hops"), "lang", "toxic", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("passed"), F.when(F.col("toxic") == 1, "boom").otherwise("").alias("error"), *[score(3 + i).alias(n) for i, n in enumerate(evaluate.WEIGHTS)])
    return evaluate.with_composite(rows)


_ANSWERS = """a0 AS (SELECT d.doc_id, lang, CASE WHEN d.doc_id % 2 = 0 THEN 'broad' ELSE 'narrow' END AS tier, CAST(d.doc_id % 7 AS INTEGER) AS hops, coalesce(quality = 1, false) AS passed,
    CASE WHEN toxic = 1 THEN 'boom' ELSE '' END AS error, (d.doc_id % 11) / 13.0::DOUBLE AS s FROM documents d LEFT JOIN labels USING (doc_id)),
    ans AS (SELECT *, round(0.25::DOUBLE * (CASE WHEN doc_id % 3 <> 0 THEN s ELSE 0 END) + 0.15::DOUBLE * (CASE WHEN doc_id % 4 <> 0 THEN s ELSE 0 END) + 0.2::DOUBLE * (CASE WHEN doc_id % 5 <> 0 THEN s ELSE 0 END)
    + 0.1::DOUBLE * (CASE WHEN doc_id % 6 <> 0 THEN s ELSE 0 END) + 0.1::DOUBLE * (CASE WHEN doc_id % 7 <> 0 THEN s ELSE 0 END) + 0.15::DOUBLE * (CASE WHEN doc_id % 8 <> 0 THEN s ELSE 0 END) + 0.05::DOUBLE * (CASE WHEN doc_id % 9 <> 0 THEN s ELSE 0 END), 4) AS composite FROM a0)"""


@_query(f"WITH {_ANSWERS} SELECT doc_id, composite, CASE WHEN doc_id % 3 <> 0 THEN s ELSE 0 END < 0.6 AS floor_breach FROM ans")
def judge_composite(spark: SparkSession, d: str) -> DataFrame:
    return _answers(spark, d).select("doc_id", "composite", "floor_breach")


@_query(f"WITH {_ANSWERS} SELECT tier, count(*) AS n, round(avg(CASE WHEN doc_id % 3 <> 0 THEN s END), 4) AS mean_groundedness, round(avg(hops), 4) AS mean_hops FROM ans GROUP BY tier")
def gate_means(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.strata_means(_answers(spark, d), ["tier"], ["groundedness", "hops"])


@_query(f"""WITH {_ANSWERS} SELECT count(*) FILTER (tier = 'broad' AND error <> '') AS broad_failures, round(avg(CASE WHEN tier = 'broad' THEN hops END), 6) AS broad_hops,
    count(*) FILTER (tier = 'broad' AND error <> '') = 0 AND avg(CASE WHEN tier = 'broad' THEN hops END) > 1.5 AS passed FROM ans""")
def behaviour_gate(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.behaviour_gate(_answers(spark, d)).withColumn("broad_hops", F.round("broad_hops", 6))


@_query(f"""WITH {_ANSWERS} SELECT round(b.h, 6) AS hops, round(b.c, 6) AS broad, round(g.c, 6) AS golden, round(n.c, 6) AS narrow, round(w.c, 6) AS base,
    b.h >= 3 AS hops_ok, b.c >= g.c * 0.95 AS broad_ok, n.c >= w.c - 0.05 AS narrow_ok, b.h >= 3 AND b.c >= g.c * 0.95 AND n.c >= w.c - 0.05 AS passed FROM
    (SELECT avg(hops) AS h, avg(composite) AS c FROM ans WHERE tier = 'broad' AND lang = 'en') b, (SELECT avg(composite) AS c FROM ans WHERE tier = 'narrow' AND lang = 'en') n,
    (SELECT avg(composite) AS c FROM ans WHERE tier = 'broad' AND lang = 'fr') g, (SELECT avg(composite) AS c FROM ans WHERE tier = 'narrow' AND lang = 'de') w""")
def gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    a = _answers(spark, d).withColumn("category", F.col("tier"))
    by = lambda lang: a.where(F.col("lang") == lang)
    out = evaluate.verdict(by("en"), by("fr"), by("de"))
    return out.withColumns({c: F.round(c, 6) for c in ("hops", "broad", "golden", "narrow", "base")})


@_query("""SELECT o_orderpriority AS variant, o_orderkey FROM orders o WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders i WHERE i.o_orderpriority = o.o_orderpriority)""")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    o = _read(spark, d, "orders").select(F.col("o_orderpriority").alias("variant"), "o_orderkey", F.col("o_orderdate").alias("run_at"))
    return evaluate.latest_run(o, ["variant"]).select("variant", "o_orderkey")


@_query(f"WITH {_ANSWERS} SELECT tier, count(*) AS cases, round(avg(CASE WHEN passed THEN 100.0 ELSE 0.0 END), 6) AS pass_pct, CAST(sum(CASE WHEN error <> '' THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM ans GROUP BY tier")
def benchmark_summary(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.benchmark_summary(_answers(spark, d), ["tier"]).withColumn("pass_pct", F.round("pass_pct", 6))


# Further corpus entities, formatting and state


def _extractions(spark, d):
    b = _read(spark, d, "benchmark")
    word = F.split("text", " ")
    body = F.to_json(F.struct(
        F.array(F.struct(word[0].alias("name"), F.lit("t").alias("type"), F.when(F.col("item_id") % 2 == 0, F.array(word[1], F.lit(None).cast("string"), word[2])).alias("aliases"))).alias("entities"),
        F.array(F.struct(word[0].alias("source"), word[1].alias("target"), F.lit("r").alias("type"), (F.col("item_id") / 4.0).cast("double").alias("weight"))).alias("relations"),
        F.array(F.struct(word[2].alias("text"), F.lit("+").alias("polarity"), F.when(F.col("item_id") % 2 == 0, word[0]).alias("subject"), word[1].alias("entity"))).alias("claims"),
    ))
    return b.select(F.col("item_id").cast("string").alias("chunk_sha"), body.alias("extraction"))


_W = "b AS (SELECT CAST(item_id AS VARCHAR) AS chunk_sha, item_id, string_split(text, ' ') AS w FROM benchmark)"


@_query(f"WITH {_W} SELECT chunk_sha, w[1] AS name, 't' AS entity_type, CASE WHEN item_id % 2 = 0 THEN w[2] || '|' || w[3] ELSE '' END AS aliases FROM b")
def graph_entities(spark: SparkSession, d: str) -> DataFrame:
    return corpus.graph_rows(_extractions(spark, d))["graph_entities"].withColumn("aliases", F.array_join("aliases", "|"))


@_query(f"WITH {_W} SELECT chunk_sha, w[1] AS source, w[2] AS target, 'r' AS relation_type, item_id / 4.0::DOUBLE AS weight FROM b")
def graph_relations(spark: SparkSession, d: str) -> DataFrame:
    return corpus.graph_rows(_extractions(spark, d))["graph_relations"]


@_query(f"WITH {_W} SELECT chunk_sha, CAST(0 AS INTEGER) AS claim_index, w[3] AS text, '+' AS polarity, CASE WHEN item_id % 2 = 0 THEN w[1] ELSE w[2] END AS subject FROM b")
def graph_claims(spark: SparkSession, d: str) -> DataFrame:
    return corpus.graph_rows(_extractions(spark, d))["graph_claims"]


@_query("SELECT CAST(item_id AS VARCHAR) AS case_id, text AS question, '' AS reference_answer, 'general' AS domain, 'unanchored' AS anchor_status FROM benchmark")
def golden_rows(spark: SparkSession, d: str) -> DataFrame:
    entry = F.array(F.struct(F.col("item_id").cast("string").alias("id"), F.col("text").alias("question")))
    payload = _read(spark, d, "benchmark").select(F.to_json(F.struct(entry.alias("entries"))).alias("payload"))
    return corpus.golden_rows(payload).select("case_id", "question", "reference_answer", "domain", "anchor_status")


@_query("SELECT CAST(item_id AS VARCHAR) AS theme_id, text AS label FROM benchmark")
def theme_rows(spark: SparkSession, d: str) -> DataFrame:
    bare = F.to_json(F.array(F.struct(F.col("item_id").cast("string").alias("id"), F.col("text").alias("label"))))
    payload = F.when(F.col("item_id") % 2 == 0, bare).otherwise(F.concat(F.lit('{"themes":'), bare, F.lit("}")))
    return corpus.theme_rows(_read(spark, d, "benchmark").select(payload.alias("payload"))).select("theme_id", "label")


@_query("SELECT CAST(item_id AS VARCHAR) AS video_id, '' AS title, text AS summary, substr(sha256(text), 1, 16) AS text_sha FROM benchmark")
def summary_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("video_id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("summary"))
    return corpus.summary_rows(rows)


@_query("SELECT conv_id, CAST(count(*) + 3 AS INTEGER) AS hops FROM conversations GROUP BY conv_id")
def decision_log_hops(spark: SparkSession, d: str) -> DataFrame:
    c = _read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.concat(F.lit("search: "), F.col("turn").cast("string"))).alias("log"))
    return c.select("conv_id", text.hops(F.concat("log", F.array(F.lit("retrieved across 3 calls"), F.lit("decide: answer")))).alias("hops"))


@_query("""SELECT conv_id, array_to_string(list_transform(range(1, least(16, count(*)) + 1), lambda i: '[' || CAST(i AS VARCHAR) || '] ' || list(text ORDER BY turn)[i][1:800]), chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS prompt FROM conversations GROUP BY conv_id""")
def context_prompt(spark: SparkSession, d: str) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return _read(spark, d, "conversations").groupBy("conv_id").agg(listed.alias("c")).select("conv_id", text.format_contexts(F.col("c")).alias("prompt"))


@_query("SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 8 = 0")
def index_to_sync(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_key"), "doc_id")
    state = docs.where("doc_id % 4 = 0").select(F.lit("idx").alias("index_name"), "chunk_key", F.when(F.col("doc_id") % 8 == 0, "old").otherwise("new").alias("text_sha"))
    return retrieval.to_sync(docs.withColumn("text_sha", F.lit("new")), state, "idx").select("doc_id")


@_query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def unjudged_answers(spark: SparkSession, d: str) -> DataFrame:
    key = lambda df: df.select(F.col("doc_id").alias("question_id"))
    return evaluate.unjudged(key(_read(spark, d, "documents")), key(_read(spark, d, "labels").where("quality = 1"))).select(F.col("question_id").alias("doc_id"))


@_query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def row_filter(spark: SparkSession, d: str) -> DataFrame:
    from tessera.sources.sinks import row_filter as keep

    return keep(spark, "tessera_allowed", "c_mktsegment", "string", "x IN ('BUILDING', 'MACHINERY')", _read(spark, d, "customer").select("c_custkey", "c_mktsegment"))


@_query(f"""WITH {_SALES} SELECT month, count(*) AS n FROM sales WHERE month BETWEEN DATE '1996-01-01' AND DATE '1997-12-01' AND postcode IN ('1', '2', '3') AND property_type = 'BUILDING' GROUP BY month""")
def dashboard_filters(spark: SparkSession, d: str) -> DataFrame:
    from tessera.functions.metrics import dashboard_filter

    return dashboard_filter(_sales(spark, d), ("1996-01-01", "1997-12-01"), ("1", "2", "3"), "BUILDING").groupBy("month").agg(F.count("*").alias("n"))


@_query(f"WITH {_SERIES}, cut AS (SELECT CAST(max(month) - INTERVAL 6 MONTH AS DATE) AS c FROM series), hist AS (SELECT series.* FROM series, cut WHERE month <= c), {_trend_sql('hist', 6)}, " + """
    m AS (SELECT 'trend_seasonal' AS method, * FROM trend UNION ALL SELECT 'seasonal_naive', * FROM naive),
    e AS (SELECT method, month, avg(abs(yhat - y)) AS mae FROM m JOIN series USING (property_type, month) GROUP BY ALL), g AS (SELECT method, avg(mae) AS a FROM e GROUP BY method)
    SELECT method, round(a, 3) AS avg_mae FROM g ORDER BY a, method LIMIT 1""")
def forecast_best_method(spark: SparkSession, d: str) -> DataFrame:
    return forecast.best_method(forecast.backtest(_series(spark, d), ["property_type"], "month", "y", 6)).withColumn("avg_mae", F.round("avg_mae", 3))


# Rents, rankings and scoring


_RENT_FLAGS = """f AS (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_linenumber = 5 THEN 'unparseable_lodgement_date' END,
    CASE WHEN l_linenumber <> 5 AND year(l_shipdate) < 1995 THEN 'pre_2010_lodgement' END, CASE WHEN l_partkey % 13 = 0 THEN 'unparseable_rent' END,
    CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 17 = 0 THEN 'non_positive_rent' END, CASE WHEN l_suppkey % 7 = 0 THEN 'bad_postcode' END], lambda x: x IS NOT NULL) AS q FROM lineitem)"""


@_query(f"WITH {_RENT_FLAGS} SELECT l_orderkey, l_linenumber, array_to_string(q, ',') AS reasons, len(q) = 0 AS is_valid, list_contains(q, 'bad_postcode') AS bad_postcode FROM f")
def rent_flags(spark: SparkSession, d: str) -> DataFrame:
    li = _read(spark, d, "lineitem")
    rows = li.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 5, F.col("l_shipdate").cast("date")).alias("rent_date"),
        F.when(F.col("l_partkey") % 13 == 0, None).when(F.col("l_partkey") % 17 == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("weekly_rent"), F.when(F.col("l_suppkey") % 7 != 0, "2000").alias("postcode"),
    )
    out = quality.flag(rows, quality.rent_rules(1995))
    return out.select("l_orderkey", "l_linenumber", F.array_join("_quality", ",").alias("reasons"), F.col("_is_valid").alias("is_valid"), F.array_contains("_quality", "bad_postcode").alias("bad_postcode"))


@_query(f"""WITH {_SALES} SELECT month, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price, count(*) AS n_sold FROM sales WHERE postcode = '7' AND property_type = 'BUILDING' GROUP BY month""")
def price_over_time(spark: SparkSession, d: str) -> DataFrame:
    mart = marts.legs(_sales(spark, d), ("postcode", "property_type", "month"), "price", *_S).withColumn(_S[0], F.col(_S[0]).cast("decimal(28,2)"))
    one = mart.where("postcode = '7' AND property_type = 'BUILDING'")
    return one.groupBy("month").agg(ratio(*_S).alias("avg_price"), F.sum("n_sold").alias("n_sold"))


@_query(f"""WITH {_YIELD.format(floor=1)}, t AS (SELECT max(month) AS m FROM y) SELECT postcode, property_type,
    round(5200 * (CAST(sum(CAST(total_weekly_rent AS DECIMAL(28,2))) AS DOUBLE) / sum(n_rented)) / (CAST(sum(CAST(total_sale_value AS DECIMAL(28,2))) AS DOUBLE) / sum(n_sold)), 6) AS gross_yield_pct
    FROM y, t WHERE month > m - INTERVAL 12 MONTH GROUP BY postcode, property_type HAVING sum(n_sold) >= 5 AND sum(n_rented) >= 10 ORDER BY gross_yield_pct DESC, postcode, property_type LIMIT 10""")
def yield_ranking_12m(spark: SparkSession, d: str) -> DataFrame:
    legs = marts.trailing(_yield(spark, d, 1), "month", 12).withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("total_sale_value", "total_weekly_rent")})
    floors = (F.sum("n_sold") >= 5) & (F.sum("n_rented") >= 10)
    return marts.leaderboard(legs, ["postcode", "property_type"], F.round(measures()["gross_yield_pct"], 6), "gross_yield_pct", floors, 10)


@_query(f"""WITH {_YIELD.format(floor=1)} SELECT postcode, property_type, round(gross_yield_pct, 6) AS gross_yield_pct, n_sold, n_rented FROM y
    WHERE month = (SELECT max(month) FROM y) AND n_sold >= 1 AND n_rented >= 2 ORDER BY round(gross_yield_pct, 6) DESC, postcode, property_type LIMIT 10""")
def latest_yield_top10(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.latest(_yield(spark, d, 1), "month").where("n_sold >= 1 AND n_rented >= 2")
    return rows.select("postcode", "property_type", F.round("gross_yield_pct", 6).alias("gross_yield_pct"), "n_sold", "n_rented").orderBy(F.desc("gross_yield_pct"), "postcode", "property_type").limit(10)


@_query(f"WITH {_LEGS} SELECT postcode, property_type, month, n_sold FROM s ORDER BY month DESC, n_sold DESC, postcode, property_type LIMIT 20")
def latest_largest(spark: SparkSession, d: str) -> DataFrame:
    mart = marts.legs(_sales(spark, d), ("postcode", "property_type", "month"), "price", *_S)
    return mart.select("postcode", "property_type", "month", "n_sold").orderBy(F.desc("month"), F.desc("n_sold"), "postcode", "property_type").limit(20)


@_query(f"""WITH {_SALES}, a AS (SELECT postcode || '|' || property_type AS series, count(*) AS n FROM sales GROUP BY ALL) SELECT series, split_part(series, '|', 1) AS postcode, split_part(series, '|', 2) AS property_type, n FROM a""")
def series_ids(spark: SparkSession, d: str) -> DataFrame:
    by = _sales(spark, d).groupBy(repair.series_id(F.col("postcode"), F.col("property_type")).alias("series")).agg(F.count("*").alias("n"))
    return by.select("series", repair.series_key(F.col("series"), 1).alias("postcode"), repair.series_key(F.col("series"), 2).alias("property_type"), "n")


@_query(f"""WITH {_FEATURES} SELECT 'sales' AS dataset, month, count(*) AS rows FROM sales GROUP BY month UNION ALL SELECT 'features', month, count(*) FROM feats GROUP BY month""")
def tagged_union(spark: SparkSession, d: str) -> DataFrame:
    count = lambda df, name: df.groupBy("month").agg(F.count("*").alias("rows")).withColumn("dataset", F.lit(name))
    return count(_sales(spark, d), "sales").unionByName(count(_features(spark, d), "features"))


@_query(f"""WITH {_FEATURES} SELECT postcode, property_type, month, round(0.5 * rent_lag_1 + 0.3 * rent_mean_3 + 0.2 * coalesce(rent_lag_12, rent_lag_1), 3) AS score, 'v1' AS version FROM feats WHERE month = (SELECT max(month) FROM feats)""")
def realtime_score(spark: SparkSession, d: str) -> DataFrame:
    """The latest month through a SQL function that takes a struct and returns one: what a served model is in SQL."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION tessera_score(x STRUCT<rent_lag_1: DOUBLE, rent_mean_3: DOUBLE, rent_lag_12: DOUBLE>) RETURNS STRUCT<score: DOUBLE, version: STRING>
        RETURN named_struct('score', round(0.5D * x.rent_lag_1 + 0.3D * x.rent_mean_3 + 0.2D * coalesce(x.rent_lag_12, x.rent_lag_1), 3), 'version', 'v1')""")
    rows = marts.latest(_features(spark, d), "month")
    return spark.sql("""SELECT postcode, property_type, month, r.score, r.version FROM (SELECT *, tessera_score(named_struct('rent_lag_1', CAST(rent_lag_1 AS DOUBLE),
        'rent_mean_3', rent_mean_3, 'rent_lag_12', CAST(rent_lag_12 AS DOUBLE))) AS r FROM {rows})""", rows=rows)


@_query(f"""WITH {_FEATURES}, top AS (SELECT max(month) AS m FROM feats) SELECT 'reference' AS part, count(*) AS n, min(month) AS first, max(month) AS last FROM feats, top WHERE month >= CAST(m - INTERVAL 24 MONTH AS DATE) AND month < m
    UNION ALL SELECT 'latest', count(*), min(month), max(month) FROM feats, top WHERE month = m""")
def reference_window(spark: SparkSession, d: str) -> DataFrame:
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.min("month").alias("first"), F.max("month").alias("last"))
    past, last = monitor.reference_window(_features(spark, d), "month")
    return count(past, "reference").unionByName(count(last, "latest"))


@_query("""SELECT max(CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 <> 0 THEN c_acctbal END) AS max_psi FROM customer""")
def max_monitorable(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = _read(spark, d, "customer").select(F.when(k % 5 == 0, "month_of_year").otherwise("f").alias("feature"), F.when(k % 3 == 0, float("nan")).otherwise(F.col("c_acctbal")).alias("psi"))
    return monitor.max_monitorable(rows)


# Corpus checks, answers, runs and replies


@_query("""SELECT 'dimension' AS "check", count(*) AS n FROM embeddings WHERE embedding IS NULL OR len(embedding) <> 64
    UNION ALL SELECT 'text', count(*) FROM documents WHERE trim(coalesce(text, '')) = '' UNION ALL SELECT 'grain', count(*) FROM (SELECT conv_id, turn FROM conversations GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'labels', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'floor', CAST(count(*) < 1000 AS INTEGER) FROM documents""")
def corpus_checks(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = _read(spark, d, "documents"), _read(spark, d, "labels")
    found = {
        "dimension": quality.wrong_shape(_read(spark, d, "embeddings"), "embedding", 64), "text": quality.blank(docs, "text"), "grain": quality.duplicate_keys(_read(spark, d, "conversations"), ["conv_id", "turn"]),
        "labels": labels.join(docs.select("doc_id"), "doc_id", "left_anti"), "floor": quality.too_few(docs, 1000),
    }
    out = [df.agg(F.lit(name).alias("check"), F.count("*").alias("n")) for name, df in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]).unionByName(out[4])


@_query("""SELECT CAST(doc_id AS VARCHAR) AS question_id, coalesce(text, '') AS answer, (doc_id % 11) / 13.0::DOUBLE AS groundedness, CAST(NULL AS DOUBLE) AS insight, '["a' || CAST(doc_id AS VARCHAR) || '"]' AS chunk_keys_json,
    CASE WHEN doc_id % 3 = 0 THEN 0 ELSE CAST(doc_id % 7 AS INTEGER) END AS hops FROM documents""")
def golden_answers(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    rows = _read(spark, d, "documents").select(
        key.alias("question_id"), F.col("text").alias("answer"), F.create_map(F.lit("groundedness"), ((F.col("doc_id") % 11) / 13.0).cast("double")).alias("scores"),
        F.array(F.concat(F.lit("a"), key), F.lit(None).cast("string")).alias("chunk_keys"), F.when(F.col("doc_id") % 3 != 0, (F.col("doc_id") % 7).cast("int")).alias("hops"),
    )
    return corpus.golden_answer_rows(rows).select("question_id", "answer", "groundedness", "insight", "chunk_keys_json", "hops")


@_query("""SELECT 'run' || CAST(item_id AS VARCHAR) AS run_id, CASE WHEN item_id % 2 = 0 THEN 'judge' ELSE 'judge_run' END AS kind, '{"a":"1","b":"' || CAST(item_id AS VARCHAR) || '"}' AS payload_json FROM benchmark""")
def eval_runs(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("item_id").cast("string")
    name = F.when(F.col("item_id") % 2 == 0, "out/judge-2026.json").otherwise("judge_run.json")
    rows = _read(spark, d, "benchmark").select(name.alias("file_name"), F.concat(F.lit("run"), n).alias("run_id"), F.create_map(F.lit("b"), n, F.lit("a"), F.lit("1")).alias("payload"))
    return corpus.eval_run_rows(rows).select("run_id", "kind", "payload_json")


@_query("""WITH h AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL ELSE (turn * 7 % 5) / 4.0::DOUBLE END AS score FROM conversations)
    SELECT conv_id, turn, score FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(score, 0) DESC, turn) AS k FROM h) WHERE k = 1""")
def best_copies(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn")
    rows = _read(spark, d, "conversations").select("conv_id", "turn", F.when(turn % 3 != 0, (turn * 7 % 5) / 4.0).cast("double").alias("score"))
    return retrieval.best_copy(rows, "conv_id")


@_query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN abs(o_totalprice - 100000) <= 5000 WHEN 1 THEN o_orderpriority IN ('1-URGENT', '2-HIGH') ELSE o_orderkey % 4 < 2 END AS passed FROM orders""")
def grade_dispatch(spark: SparkSession, d: str) -> DataFrame:
    k, o = F.col("o_orderkey") % 3, _read(spark, d, "orders")
    kind = F.when(k == 0, "value").when(k == 1, "topk").otherwise("refusal")
    refused = F.when(F.col("o_orderkey") % 4 < 2, "That is not available.").otherwise("It is here.")
    said = F.when(k == 0, F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).when(k == 1, F.concat(F.lit("is "), "o_orderpriority", F.lit("."))).otherwise(refused)
    keys = F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))
    return o.select("o_orderkey", text.grade(kind, said, F.lit(100000.0), keys, 1).alias("passed"))


@_query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 0.25 WHEN 1 THEN 1 WHEN 2 THEN 0 END::DOUBLE AS score FROM customer""")
def verdict_scores(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    reply = F.when(k == 0, 'Well: {"score": "0.25"} so.').when(k == 1, '```{"score": 7}```').when(k == 2, '{"score": -1}').otherwise("no object")
    return _read(spark, d, "customer").select("c_custkey", text.clamp_score(repair.safe_double(text.verdict_json(reply, "score string")["score"])).alias("score"))


@_query("""SELECT conv_id, turn, '[conversation ' || CAST(conv_id AS VARCHAR) || ' @ ' || lpad(CAST(turn // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(turn % 60 AS VARCHAR), 2, '0') || '] (channel: ' || role || ')' || chr(10) || text AS chunk FROM conversations""")
def chunk_format(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat(F.lit("conversation "), F.col("conv_id").cast("string"))
    return _read(spark, d, "conversations").select("conv_id", "turn", text.format_chunk(title, repair.clock(F.col("turn").cast("string")), F.col("role"), F.col("text")).alias("chunk"))


@_query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN text || '.' ELSE '' END AS message FROM conversations""")
def message_texts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("turn") % 3
    part = lambda kind, body: F.struct(F.lit(kind).alias("type"), body.alias("text"))
    parts = F.to_json(F.array(part("text", F.col("text")), part("reasoning", F.lit("hidden")), part("text", F.lit("."))))
    return _read(spark, d, "conversations").select("conv_id", "turn", text.message_text(F.when(k == 0, F.col("text")).when(k == 1, parts)).alias("message"))


@_query("""SELECT item_id, CASE WHEN item_id % 2 = 0 THEN w[1] || '|' || w[2] || '|' || w[3] ELSE text END AS questions FROM (SELECT item_id, text, string_split(replace(text, chr(10), ' '), ' ') AS w FROM benchmark)""")
def split_questions(spark: SparkSession, d: str) -> DataFrame:
    w = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    reply = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("- "), w[0], F.lit("\n\n • "), w[1], F.lit("\n"), w[2], F.lit("\n- more"))).otherwise(" \n-")
    return _read(spark, d, "benchmark").select("item_id", F.array_join(text.sub_questions(reply, F.col("text")), "|").alias("questions"))


_CONTENDERS = {"whole": "embedding", "head": "slice(embedding, 1, 16)", "tail": "slice(embedding, 17, 48)"}


def _contender_sql(name: str, column: str) -> str:
    knn = _IR.replace("e::DOUBLE[]", "e::DOUBLE[]").replace("SELECT vec_id AS qid, embedding AS e FROM embeddings", "SELECT vec_id AS qid, embedding AS e FROM emb").replace("FROM q, embeddings WHERE", "FROM q, emb WHERE")
    return f"SELECT '{name}' AS contender, n, recall, mrr, ndcg FROM (WITH emb AS (SELECT vec_id, label, {column} AS embedding FROM embeddings), {knn} SELECT count(*) AS n, round(avg(recall), 6) AS recall, round(avg(mrr)::DOUBLE, 6) AS mrr, round(avg(ndcg), 6) AS ndcg FROM m)"


@_query(" UNION ALL ".join(_contender_sql(n, c.replace("slice(embedding, 1, 16)", "embedding[1:16]").replace("slice(embedding, 17, 48)", "embedding[17:64]")) for n, c in _CONTENDERS.items()))
def retrieval_contenders(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "embeddings")
    mark, totals = _relevant(spark, d)
    out = None
    for name, column in _CONTENDERS.items():
        v = e.select("vec_id", F.expr(column).alias("v"))
        asked = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "v")
        one = retrieval.contenders(asked, {name: (v, "v")}, mark, totals, 10, "qid", "vec_id")
        out = one if out is None else out.unionByName(one)
    return out.select("contender", "n", *[F.round(c, 6).alias(c) for c in ("recall", "mrr", "ndcg")])


# Records of any shape


@_query("""SELECT CAST(doc_id AS VARCHAR) AS question_id, lang AS category, NULL::VARCHAR AS domain, nullif(text, '') AS question, '' AS source_case_id, coalesce(source, '') AS answer_md, '' AS answer_model, '' AS terminated_reason, 'judge' AS judge_model,
    '' AS rubric_version, '' AS judge_error, '' AS captured_at, '["' || coalesce(source, '-') || '",' || CAST(doc_id AS VARCHAR) || ']' AS contexts_json, '[]' AS references_json, '[]' AS chunk_ids_json, '[{"a":' || CAST(doc_id AS VARCHAR) || ',"b":null}]' AS queries_json,
    doc_id % 5 AS iterations, CAST(0 AS BIGINT) AS llm_calls, doc_id % 11 / 4.0::DOUBLE AS faithfulness, NULL::DOUBLE AS answer_relevancy, NULL::DOUBLE AS context_precision, NULL::DOUBLE AS insight_depth, NULL::DOUBLE AS specificity, CAST(doc_id % 7 AS DOUBLE) AS coverage,
    NULL::DOUBLE AS evidence_breadth, NULL::DOUBLE AS calibration, NULL::DOUBLE AS ragas_v1_composite, doc_id % 3 / 2.0::DOUBLE AS composite, doc_id % 2 = 1 AS cap_applied, false AS grounding_floor_breached, 'bench' AS source FROM documents""")
def golden_answer_fields(spark: SparkSession, d: str) -> DataFrame:
    """Judged answers with all their fields, of records in which some are missing or of another kind."""
    k = F.col("doc_id")
    record = F.struct(
        k.alias("question_id"), F.col("lang").alias("category"), F.col("text").alias("question"), F.col("source").alias("answer"), F.lit("judge").alias("judge_model"), F.lit("").alias("captured_at"),
        F.array().cast("array<string>").alias("references"), (k % 5).cast("string").alias("iterations"), F.struct((k % 11 / 4.0).alias("faithfulness"), (k % 7).alias("coverage"), F.lit("none").alias("calibration")).alias("scores"),
        (k % 3 / 2.0).cast("string").alias("composite"), (k % 2).alias("cap_applied"), F.lit("").alias("grounding_floor_breached"),
    )
    more = F.format_string('{"contexts":["%s",%d],"queries":[{"b":null,"a":%d}],', F.coalesce("source", F.lit("-")), k, k)
    return corpus.golden_answer_table(_read(spark, d, "documents").select(F.concat(more, F.substring(F.to_json(record), F.lit(2), F.lit(2**31 - 1))).alias("record")), "bench")


@_query("""SELECT CASE WHEN item_id % 2 = 0 THEN 'r' || CAST(item_id AS VARCHAR) ELSE 'out/judge-' || CAST(item_id AS VARCHAR) || '.json' END AS run_id, 'out/judge-' || CAST(item_id AS VARCHAR) || '.json' AS source_file, 'judge' AS kind, 'day' AS created_at,
    CASE WHEN item_id % 3 = 0 THEN CAST(9 AS BIGINT) ELSE item_id % 3 END AS entry_count, '{"created_at":"day","entries":9,"entry_count":' || CAST(item_id % 3 AS VARCHAR) || ',"run_id":"' || CASE WHEN item_id % 2 = 0 THEN 'r' || CAST(item_id AS VARCHAR) ELSE '' END || '","z":[{"a":{"c":[],"d":1},"b":2}]}' AS payload_json FROM benchmark""")
def eval_run_payloads(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("item_id").cast("string")
    payload = F.format_string('{"z":[{"b":2,"a":{"d":1,"c":[]}}],"run_id":"%s","entry_count":%d,"entries":9,"created_at":"day"}', F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("r"), n)).otherwise(""), F.col("item_id") % 3)
    return corpus.eval_run_table(_read(spark, d, "benchmark").select(F.concat(F.lit("out/judge-"), n, F.lit(".json")).alias("file_name"), payload.alias("payload")))


# Methods for groups and models of any size


@_query(f"WITH {_KNN} SELECT qid, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM ranked WHERE rank <= 10")
def pruned_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "embeddings")
    asked = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    hits, _ = pruned.top_k(asked, pruned.group(e, "vec_id", "embedding"), 10, "qid", "vec_id", exclude_self=True)
    return hits.select("qid", "vec_id", "rank", F.round("score", 5).alias("score"))


@_query("""SELECT vendor_id, flag, count(amount) AS n, median(CAST(floor(100 * amount + 0.5) AS BIGINT)) / 100 AS median_amount FROM sale_lines GROUP BY ALL""")
def exact_medians(spark: SparkSession, d: str) -> DataFrame:
    cents = _read(spark, d, "sale_lines").select("vendor_id", "flag", F.floor(100 * F.col("amount") + 0.5).alias("cents"))
    return medians.medians(cents, ["vendor_id", "flag"], "cents").select("vendor_id", "flag", "n", (F.col("median") / 100).alias("median_amount"))


@_query()
def forecast_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Six months of each nation's sales with 80 % intervals, by the table function."""
    forecast_table.register(spark)
    s = _sales(spark, d).groupBy("postcode", "property_type", "month").agg(F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("y"))
    return spark.sql("SELECT * FROM forecast_months(TABLE(SELECT postcode, property_type, month, y FROM {s}) PARTITION BY (postcode, property_type) ORDER BY (month), 6, 0.8D)", s=s)


@_query()
def boosted_score(spark: SparkSession, d: str) -> DataFrame:
    """The last six months by trees that take missing lags as they are."""
    numeric = ["rent_lag_1", "rent_lag_3", "rent_lag_12", "rent_mean_3", "volume_mean_3", "price_lag_1", "month_of_year"]
    train, test = features.split_by_month(scratch.written(_features(spark, d), "features"), "month", 6)
    fitted = boosted.fit(train, ["property_type"], numeric, "median_weekly_rent", rounds=8, depth=3)
    return fitted.predict(test, "predicted_weekly_rent").select("postcode", "property_type", "month", "predicted_weekly_rent", "median_weekly_rent")


_FIELDS = [("groundedness", "groundedness"), ("relevance", "relevance_correctness"), ("correctness", "relevance_correctness"), *[(f, "depth") for f in ("insight", "specificity", "coverage", "breadth", "calibration")]]


@_query(f"""SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS question_id, name, CASE WHEN prompt = 'depth' AND length(text) % 11 = 0 THEN NULL ELSE (length(text) % 10) / 10.0 END AS score
    FROM conversations, (VALUES {", ".join(f"('{n}', '{p}')" for n, p in _FIELDS)}) f(name, prompt) WHERE NOT (prompt = 'depth' AND length(text) % 13 = 0) AND conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL""")
def judge_ledger(spark: SparkSession, d: str) -> DataFrame:
    """A judge of turns that fails for some at first and for a few always; the second run takes up what is due."""
    c = _read(spark, d, "conversations").where("conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL")
    answers = c.select(F.concat_ws(":", "conv_id", "turn").alias("question_id"), F.concat("text", F.lit("\x1e")).alias("question"), F.lit("").alias("answer"), F.array().cast("array<string>").alias("context_texts"))

    judged = evaluate.JUDGED

    def ask(prompt: str, said: str, firm: bool = True) -> str:
        n = len(said.partition("\x1e")[0])
        if prompt == "depth" and n % 13 == 0 or not firm and n % 7 == 0:
            raise TimeoutError("no reply")
        if prompt == "depth" and n % 11 == 0:
            return "I would rather not say."
        return str({f: n % 10 / 10 for f in judged[prompt]}).replace("'", '"')

    ledger = evaluate.JudgeLedger(spark, scratch.folder(spark, "ledger"))
    ledger.run(answers, lambda prompt, said: ask(prompt, said, False))
    ledger.run(answers, ask)
    return ledger.scores(answers)


# Changes, versions and incremental tables, each in a folder that goes with the application


_SALE = "sale_id, client_id, status, total, sold_at"
_SHOTS = f"""
    v1 AS (SELECT {_SALE} FROM sales WHERE arrived_at < TIMESTAMP '2024-03-01'),
    v2 AS (SELECT {_SALE} FROM sales WHERE arrived_at < TIMESTAMP '2024-04-01' AND status IS DISTINCT FROM 'held'),
    v3 AS (SELECT sale_id, client_id, CASE WHEN status = 'open' AND sold_at < TIMESTAMP '2024-02-01' THEN 'lapsed' ELSE status END AS status, coalesce(total, 0) AS total, sold_at FROM sales)"""


def _sale_log(spark: SparkSession, d: str) -> changes.ChangeLog:
    """Sales as known in March, in April without those on hold, and at the end with old open ones lapsed."""
    s = _read(spark, d, "sales")
    lapsed = F.when((F.col("status") == "open") & (F.col("sold_at") < "2024-02-01"), "lapsed").otherwise(F.col("status"))
    log = changes.ChangeLog(spark, scratch.folder(spark, "sale-log"), ["client_id", "sold_at"])
    for shot in (s.where("arrived_at < '2024-03-01'"), s.where("arrived_at < '2024-04-01' AND NOT (status <=> 'held')"), s.withColumns({"status": lapsed, "total": F.coalesce("total", F.lit(0.0))})):
        log.commit(shot.select(*_SALE.split(", ")))
    return log


def _feed_sql(old: str, new: str, version: int) -> str:
    return f"""SELECT {_SALE}, CASE WHEN came AND went THEN 'update_' || CASE WHEN sign > 0 THEN 'after' ELSE 'before' END WHEN sign > 0 THEN 'insert' ELSE 'delete' END AS _change, {version} AS _version
        FROM (SELECT *, max(sign) OVER k > 0 AS came, min(sign) OVER k < 0 AS went
              FROM (SELECT *, 1 AS sign FROM (FROM {new} EXCEPT ALL FROM {old}) UNION ALL SELECT *, -1 FROM (FROM {old} EXCEPT ALL FROM {new}))
              WINDOW k AS (PARTITION BY client_id, sold_at))"""


@_query(f"WITH {_SHOTS} {_feed_sql('v1', 'v2', 2)} UNION ALL {_feed_sql('v2', 'v3', 3)}")
def change_feed(spark: SparkSession, d: str) -> DataFrame:
    return _sale_log(spark, d).read(2, 3)


@_query(f"WITH {_SHOTS} SELECT * FROM v3")
def change_replay(spark: SparkSession, d: str) -> DataFrame:
    return _sale_log(spark, d).as_of(3)


@_query("""WITH s AS (SELECT coalesce(strftime(sold_at, '%Y-%m'), 'none') AS label, * FROM sales),
    now AS (SELECT sold_at, status, total FROM s WHERE label <> '2024-02'
            UNION ALL SELECT CASE WHEN priority = 0 THEN sold_at + INTERVAL 1 MONTH ELSE sold_at END, status, total + 10 FROM s WHERE label = '2024-02' AND status IS DISTINCT FROM 'held')
    SELECT coalesce(strftime(sold_at, '%Y-%m'), 'none') AS month, status, CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS total, count(total) AS n FROM now GROUP BY ALL""")
def incremental_mart(spark: SparkSession, d: str) -> DataFrame:
    """A file for each month of sales, then a corrected one for February."""
    s = _read(spark, d, "sales").withColumn("label", F.coalesce(F.date_format("sold_at", "yyyy-MM"), F.lit("none")))
    root = scratch.folder(spark, "incremental")
    mart = IncrementalMart(spark, f"{root}/out", F.date_format("sold_at", "yyyy-MM"), lambda df: marts.legs(df, ("month", "status"), "total", "total", "n"))
    for r in s.select("label").distinct().collect():  # months
        landing.land(s.where(F.col("label") == r.label).drop("label"), f"{root}/in", r.label)
    mart.run(f"{root}/in")
    later = F.when(F.col("priority") == 0, F.col("sold_at") + F.expr("INTERVAL 1 MONTH")).otherwise(F.col("sold_at"))
    again = s.where("label = '2024-02' AND NOT (status <=> 'held')").withColumns({"sold_at": later, "total": F.col("total") + 10}).drop("label")
    landing.land(again, f"{root}/in", "2024-02")
    mart.run(f"{root}/in")
    return mart.mart().select("month", "status", "total", "n")


@_query("""SELECT CAST(click_id AS VARCHAR) AS click_id, kind, CASE WHEN arrived_at < TIMESTAMP '2024-02-01' THEN CAST(CAST(floor(value) AS INTEGER) AS DOUBLE) ELSE value END AS value,
    CASE WHEN arrived_at >= TIMESTAMP '2024-02-01' THEN client_id END AS client_id, CASE WHEN arrived_at >= TIMESTAMP '2024-03-01' THEN props END AS props FROM clicks WHERE arrived_at IS NOT NULL""")
def merged_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Clicks land in three files: numbers narrow, then wider and with clients, then ids as text and with properties."""
    c, root = _read(spark, d, "clicks"), scratch.folder(spark, "merged")
    parts = (
        c.where("arrived_at < '2024-02-01'").select(F.col("click_id").cast("int"), "kind", F.floor("value").cast("int").alias("value")),
        c.where("arrived_at >= '2024-02-01' AND arrived_at < '2024-03-01'").select("click_id", "kind", "value", "client_id"),
        c.where("arrived_at >= '2024-03-01'").select(F.col("click_id").cast("string"), "kind", "value", "client_id", "props"),
    )
    table = merging.MergedTable(spark, f"{root}/out")
    for n, part in enumerate(parts):
        part.write.parquet(f"{root}/in/{n}_0000000{n}.parquet")
        merging.ingest_merged(spark, f"{root}/in", table, f"{root}/checkpoint")
    return table.read().select("click_id", "kind", "value", "client_id", "props")


@_query("""WITH lines AS (SELECT sale_id, line_no, item_id, amount FROM sale_lines),
    n AS (SELECT count(*) AS rows, count(*) FILTER (item_id IS NULL) AS a, count(*) FILTER (NOT coalesce(amount > 0, false)) AS b, count(*) - (SELECT count(*) FROM (SELECT DISTINCT sale_id, line_no FROM lines)) AS k FROM lines),
    kept AS (SELECT count(*) AS visible, count(DISTINCT (sale_id, line_no)) AS grain FROM (SELECT sale_id, line_no FROM lines WHERE item_id IS NOT NULL AND amount > 0 GROUP BY ALL HAVING count(*) = 1))
    SELECT c AS "constraint", v AS violations, visible, grain FROM n, kept, LATERAL (VALUES ('rows', rows), ('not_null:item_id', a), ('check:amount', b), ('key:sale_id,line_no', k)) t(c, v)""")
def publish_audit(spark: SparkSession, d: str) -> DataFrame:
    """A good version of the lines, then one that breaks its constraints: what its audit counts, and the rows that readers still see."""
    lines = _read(spark, d, "sale_lines").select("sale_id", "line_no", "item_id", "amount")
    good = lines.where("item_id IS NOT NULL AND amount > 0").groupBy("sale_id", "line_no").agg(F.count("*").alias("_n"), F.any_value("item_id").alias("item_id"), F.any_value("amount").alias("amount")).where("_n = 1").drop("_n")
    table = VersionedTable(spark, scratch.folder(spark, "published"))
    rules = {"not_null": ["item_id"], "key": ["sale_id", "line_no"], "checks": {"amount": F.col("amount") > 0}}
    table.write(good, **rules)
    try:
        table.write(lines, **rules)
    except quality.CheckFailed:
        pass  # its counts are the result
    found = spark.createDataFrame(list(table.refused()[-1]["audit"].items()), "constraint string, violations long")
    seen = table.read().agg(F.count("*").alias("visible"), F.count_distinct(F.struct("sale_id", "line_no")).alias("grain"))
    return found.join(F.broadcast(seen), how="cross")  # one row


@_query("""SELECT sale_id, line_no, vendor_id, amount, shipped_at FROM sale_lines WHERE vendor_id BETWEEN 3 AND 5 AND shipped_at BETWEEN TIMESTAMP '2024-02-01' AND TIMESTAMP '2024-02-20'""")
def clustered_scan(spark: SparkSession, d: str) -> DataFrame:
    """Lines clustered by vendor and day, read by ranges of both."""
    from datetime import datetime

    table = VersionedTable(spark, scratch.folder(spark, "clustered"))
    table.write(_read(spark, d, "sale_lines").select("sale_id", "line_no", "vendor_id", "amount", F.col("shipped_at").cast("timestamp")))
    table.cluster(["vendor_id", "shipped_at"], 64)
    rows, _, _ = table.scan({"vendor_id": (3, 5), "shipped_at": (datetime(2024, 2, 1), datetime(2024, 2, 20))})
    return rows


@_query("""WITH old AS (SELECT client_id, city, balance FROM clients WHERE updated_at < TIMESTAMP '2024-03-01'), new AS (SELECT client_id, city, balance FROM clients WHERE segment IS DISTINCT FROM 'public')
    SELECT client_id, CASE WHEN n.client_id IS NULL THEN o.city ELSE n.city END AS city, CASE WHEN n.client_id IS NULL THEN o.balance ELSE n.balance END AS balance, n.client_id IS NOT NULL AS is_current
    FROM old o FULL JOIN new n USING (client_id)""")
def bucketed_merge(spark: SparkSession, d: str) -> DataFrame:
    """The clients of February, then those that are not public."""
    c = _read(spark, d, "clients")
    state = BucketedState(spark, scratch.folder(spark, "buckets"), ["client_id"], ["city", "balance"], 32)
    state.merge(c.where("updated_at < '2024-03-01'"), F.to_timestamp(F.lit("2026-01-01")))
    state.merge(c.where("NOT (segment <=> 'public')"), F.to_timestamp(F.lit("2026-02-01")))
    return state.read().select("client_id", "city", "balance", "is_current")


# Streaming


@_query("SELECT event_id, event_type, value FROM events")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    at = scratch.folder(spark, "stream")
    ingest(spark, f"{d}/events.parquet", f"{at}/bronze", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/bronze").select("event_id", "event_type", "value")
