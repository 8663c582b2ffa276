"""The driver's tables presented in the warehouse model, in Spark and in SQL.

Economic star: a region is a customer's nation, an indicator is a part brand, a year's value
is the sum of the extended prices. Trade star: one row per order month, part, customer nation,
supplier nation and line status.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.functions.storage import materialize
from lumbung.operators import model
from lumbung.schemas import MONEY, VALUE, EconomicStar, TradeStar


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _orders_by_nation(spark: SparkSession, sf_dir: str, *when: Column) -> DataFrame:
    """Order key, the wanted date parts and the nation of the customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *when)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop(
        "o_custkey", "c_custkey"
    )


def economic_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_by_nation(spark, sf_dir, F.year("o_orderdate").alias("year"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("year", "c_nationkey", "p_brand")
        .agg(F.sum(F.col("l_extendedprice").cast(VALUE)).cast(VALUE).alias("value"))
        .select(
            (F.col("year") * 10000 + 101).alias("date_key"),
            F.col("c_nationkey").cast("string").alias("region_key"),
            F.col("p_brand").alias("indicator_key"),
            "value",
            "year",
        )
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("region_key"),
        F.col("n_nationkey").cast("string").alias("region_code"),
        F.col("n_name").alias("region_name"),
        F.col("r_name").alias("province_name"),
        F.lit(None).cast("string").alias("regency_name"),
        F.lit(None).cast("string").alias("district_name"),
    )


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int") % 3
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(F.max("p_type").alias("concept"), F.min("p_type").alias("definition"))
        .select(
            F.col("p_brand").alias("indicator_key"),
            F.col("p_brand").alias("indicator_code"),
            F.upper("p_brand").alias("indicator_name"),
            F.lit("Trade").alias("subject_name"),
            F.lit(None).cast("string").alias("category_name"),
            F.lit("USD").alias("unit"),
            F.lit("Annual").alias("frequency"),
            "concept",
            "definition",
            F.lit(None).cast("string").alias("classification"),
            F.lit(None).cast("string").alias("measure"),
            F.lit("orders").alias("data_source"),
            F.when(digit == 0, "SUM").when(digit == 1, "AVG").otherwise("N/A").alias(
                "aggregation_method"
            ),
        )
    )


def stored_star(spark: SparkSession, sf_dir: str) -> EconomicStar:
    star = economic_star(spark, sf_dir)
    return replace(
        star,
        fact=materialize(star.fact, "fact"),
        dim_indicator=materialize(star.dim_indicator, "indicators"),
    )


def economic_star(spark: SparkSession, sf_dir: str) -> EconomicStar:
    return EconomicStar(
        fact=economic_fact(spark, sf_dir),
        dim_date=model.calendar(spark, "YEAR"),
        dim_region=regions(spark, sf_dir),
        dim_indicator=indicators(spark, sf_dir),
    )


def _trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_by_nation(spark, sf_dir, F.col("o_orderdate"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus",
        "l_extendedprice", "l_quantity",
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("flow", F.when(F.col("l_linestatus") == "O", "ekspor").otherwise("impor"))
        .withColumn("period", F.date_format("o_orderdate", "yyyy-MM"))
    )


def trade_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return (
        _trade_lines(spark, sf_dir)
        .groupBy(
            (year * 10000 + month * 100 + 1).alias("date_key"),
            "l_partkey", "c_nationkey", "s_nationkey",
            F.col("flow").alias("trade_type"),
        )
        .agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("value_usd"),
            F.sum(F.col("l_quantity").cast(MONEY)).cast(MONEY).alias("net_weight_kg"),
        )
        .select(
            "date_key",
            F.col("l_partkey").cast("string").alias("product_key"),
            F.col("c_nationkey").cast("string").alias("country_key"),
            F.col("s_nationkey").cast("string").alias("port_key"),
            "trade_type", "value_usd", "net_weight_kg",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_key"),
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_name").alias("product_name"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("country_key"),
        F.col("n_nationkey").cast("string").alias("country_code"),
        F.col("n_name").alias("country_name"),
    )


def trade_star(spark: SparkSession, sf_dir: str) -> TradeStar:
    return TradeStar(
        fact=trade_fact(spark, sf_dir),
        dim_date=model.calendar(spark, "MONTH"),
        dim_product=products(spark, sf_dir),
        dim_country=countries(spark, sf_dir),
        dim_trade_flow=model.build_dim_trade_flow(spark),
    )


# The same model in SQL

ECONOMIC_FACT = """
e_fact AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(year(o_orderdate) * 10000 + 101 AS INTEGER) AS date_key,
           CAST(c_nationkey AS VARCHAR) AS region_key,
           p_brand AS indicator_key,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,6))) AS DECIMAL(20,6)) AS value
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
)"""

ECONOMIC_DIMS = """
e_region AS (
    SELECT CAST(n_nationkey AS VARCHAR) AS region_key, n_name AS region_name,
           r_name AS province_name
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
e_indicator AS (
    SELECT p_brand AS indicator_key, upper(p_brand) AS indicator_name,
           'Trade' AS subject_name, 'USD' AS unit, 'Annual' AS frequency,
           MAX(p_type) AS concept, MIN(p_type) AS definition, 'orders' AS data_source,
           CASE CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 3
                WHEN 0 THEN 'SUM' WHEN 1 THEN 'AVG' ELSE 'N/A' END AS aggregation_method
    FROM part GROUP BY p_brand
)"""

ECONOMIC = ECONOMIC_FACT + "," + ECONOMIC_DIMS

# Fact rows with the names of region and indicator.
OBSERVED = (
    ECONOMIC
    + """,
obs AS (
    SELECT f.year, f.region_key, r.region_name, f.indicator_key, i.indicator_name, f.value
    FROM e_fact f JOIN e_region r USING (region_key) JOIN e_indicator i USING (indicator_key)
)"""
)

TRADE_FACT = """
x_fact AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS INTEGER) AS date_key,
           CAST(l_partkey AS VARCHAR) AS product_key,
           CAST(c_nationkey AS VARCHAR) AS country_key,
           CAST(s_nationkey AS VARCHAR) AS port_key,
           CASE WHEN l_linestatus = 'O' THEN 'ekspor' ELSE 'impor' END AS trade_type,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS value_usd,
           CAST(SUM(CAST(l_quantity AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS net_weight_kg
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY ALL
)"""

FLOW_NAME = "CASE trade_type WHEN 'ekspor' THEN 'Ekspor' WHEN 'impor' THEN 'Impor' END"


def rounded_sql(expression: str) -> str:
    """Two decimals as NUMERIC, which unlike DOUBLE has no negative zero."""
    return f"CAST(CAST(ROUND({expression}, 2) AS DECIMAL(20,2)) AS DOUBLE)"


def growth_sql(current: str, previous: str) -> str:
    return rounded_sql(f"({current} - {previous}) * 100 / NULLIF({previous}, 0)")


# Responses in JSON, spelled from the same tables


def _number(brand: str) -> Column:
    return F.regexp_extract(brand, r"(\d+)$", 1)


def region_codes(spark: SparkSession, sf_dir: str) -> Column:
    """Region codes in list order, as a scalar subquery; one entry per nation."""
    keys = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_list("n_nationkey")).alias("k"))
    return keys.select(F.transform("k", lambda k: k.cast("string")).alias("codes")).scalar()


def wide_responses(
    spark: SparkSession, sf_dir: str, fact: DataFrame | None = None
) -> DataFrame:
    """One response per indicator, one row per year, one value per region.

    A row has one place per nation and a response one row per year, whatever the data size;
    a cell without data is null, so the places of the others stay.
    """
    cells = F.map_from_entries(F.collect_list(F.struct("region_key", F.col("value").cast("string"))))
    yearly = (
        (economic_fact(spark, sf_dir) if fact is None else fact)
        .groupBy("indicator_key", "year")
        .agg(cells.alias("cells"))
        .withColumn("codes", region_codes(spark, sf_dir))
        .withColumn(
            "row",
            F.concat(
                F.array(F.col("year").cast("string")),
                F.transform("codes", lambda code: F.try_element_at("cells", code)),
            ),
        )
    )
    brand = F.col("indicator_key")
    body = F.struct(
        F.lit("200").alias("status"),
        F.array(F.struct(brand.alias("id"), F.upper(brand).alias("label"))).alias("variable"),
        F.struct(
            F.struct(
                F.concat(F.lit("table "), brand).alias("id"), brand.alias("kode"),
                F.concat(F.lit("Values of "), brand).alias("nama"), F.lit("Trade").alias("subjek"),
                F.lit("USD").alias("satuan"), F.lit("Annual").alias("periode"),
            ).alias("tabel")
        ).alias("infotabel"),
        F.col("rows").alias("datacontent"),
    )
    return (
        yearly.groupBy("indicator_key")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select(brand.alias("doc"), F.to_json(body).alias("body"))
    )


def paired_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `wide_responses` with two vertical variables: the value and its negative."""
    return wide_responses(spark, sf_dir).select(
        "doc",
        F.from_json("body", "datacontent array<array<string>>")["datacontent"].alias("rows"),
    ).select(
        "doc",
        F.to_json(
            F.struct(
                F.array(F.struct(F.col("doc").alias("id"))).alias("variable"),
                F.array(
                    *[
                        F.struct(F.lit(i).alias("id"), F.lit(label).alias("label"),
                                 F.lit(f"the {label} value").alias("description"),
                                 F.lit("USD").alias("unit"))
                        for i, label in (("1", "plain"), ("2", "negative"))
                    ]
                ).alias("vervar"),
                F.transform(
                    "rows",
                    lambda r: F.concat(
                        F.slice(r, 1, 1),
                        F.flatten(
                            F.transform(
                                F.slice(r, F.lit(2), F.size(r) - 1),
                                lambda v: F.array(v, F.concat(F.lit("-"), v)),
                            )
                        ),
                    ),
                ).alias("datacontent"),
            )
        ).alias("body"),
    )


def four_digit_code(region: str) -> Column:
    """Region code of the keyed responses: the nation key counted from 1000."""
    return (F.col(region).cast("int") + 1000).cast("string")


FOUR_DIGIT_CODE = "CAST(CAST(region_key AS INTEGER) + 1000 AS VARCHAR)"

# Period type ids and labels of the keyed responses.
PERIOD_TYPES = {"61": "Semester 1", "63": "Annual"}


def keyed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per indicator with 15-digit keys.

    The value stands under period type 63, its half under 61 before it, and a key of another
    length is there to be skipped.
    """
    number = F.lpad(_number("indicator_key"), 3, "0")
    year = F.lpad((F.col("year") - 1900).cast("string"), 3, "0")
    stem = F.concat(four_digit_code("region_key"), number, F.lit("000"), year)
    cells = economic_fact(spark, sf_dir).select("indicator_key", "year", stem.alias("stem"), "value")
    pairs = F.flatten(
        F.transform(
            F.sort_array(F.collect_list(F.struct("stem", "value"))),
            lambda c: F.array(
                *[
                    F.struct(
                        F.concat(c["stem"], F.lit(period)).alias("key"), value.alias("value")
                    )
                    for period, value in (
                        ("61", (c["value"] / 2).cast(VALUE)), ("63", c["value"]), ("6", c["value"]),
                    )
                ]
            ),
        )
    )
    years = F.transform(
        F.sort_array(F.collect_set("year")),
        lambda y: F.struct(
            F.lpad((y - 1900).cast("string"), 3, "0").alias("val"), y.cast("string").alias("label")
        ),
    )
    brand = F.col("indicator_key")
    body = F.struct(
        F.array(
            F.struct(
                number.alias("val"), F.upper(brand).alias("label"), F.lit("USD").alias("unit"),
                F.lit("Trade").alias("subj"), F.lit("parts").alias("def"),
            )
        ).alias("var"),
        F.array(F.struct(F.lit("000").alias("val"), F.lit("all").alias("label"))).alias("turvar"),
        F.col("years").alias("tahun"),
        F.array(
            *[F.struct(F.lit(i).alias("val"), F.lit(l).alias("label")) for i, l in PERIOD_TYPES.items()]
        ).alias("turtahun"),
        F.map_from_entries("pairs").alias("datacontent"),
    )
    return (
        cells.groupBy("indicator_key")
        .agg(pairs.alias("pairs"), years.alias("years"))
        .select(brand.alias("doc"), F.to_json(body).alias("body"))
    )


def trade_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order line, so that no response grows with the data."""
    line = _trade_lines(spark, sf_dir)
    record = F.struct(
        F.col("flow").alias("jenis"),
        F.col("l_partkey").cast("string").alias("kode_barang"),
        F.concat(F.lit("Part "), "l_partkey").alias("nama_barang"),
        F.col("c_nationkey").cast("string").alias("kode_negara"),
        F.concat(F.lit("Nation "), "c_nationkey").alias("nama_negara"),
        F.col("s_nationkey").cast("string").alias("kode_pelabuhan"),
        F.concat(F.lit("Port "), "s_nationkey").alias("nama_pelabuhan"),
        F.col("period").alias("periode"),
        F.col("l_extendedprice").cast(MONEY).cast("string").alias("nilai"),
        F.when(F.col("l_linenumber") == 1, "unknown")
        .otherwise(F.col("l_quantity").cast(MONEY).cast("string"))
        .alias("berat_bersih"),
    )
    return line.select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("doc"),
        F.to_json(F.struct(F.array(record).alias("data"))).alias("body"),
    )


def port_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per port: a record per year, country and flow of all products together.

    A response is as long as the years times the nations.
    """
    record = F.struct(
        F.col("trade_type").alias("jenis"), F.lit("ALL").alias("kode_barang"),
        F.lit("All products").alias("nama_barang"), F.col("country_key").alias("kode_negara"),
        F.concat(F.lit("Nation "), "country_key").alias("nama_negara"),
        F.col("port_key").alias("kode_pelabuhan"), F.col("year").cast("string").alias("periode"),
        F.col("usd").cast("string").alias("nilai"), F.col("kg").cast("string").alias("berat_bersih"),
    )
    return (
        trade_fact(spark, sf_dir)
        .groupBy(
            F.floor(F.col("date_key") / 10000).alias("year"), "country_key", "port_key", "trade_type"
        )
        .agg(F.sum("value_usd").alias("usd"), F.sum("net_weight_kg").alias("kg"))
        .groupBy(F.col("port_key").alias("doc"))
        .agg(F.to_json(F.struct(F.collect_list(record).alias("data"))).alias("body"))
    )


TRADE_LINES = """
lines AS (
    SELECT l_orderkey || '/' || l_linenumber AS doc,
           CASE WHEN l_linestatus = 'O' THEN 'ekspor' ELSE 'impor' END AS trade_type,
           CAST(l_partkey AS VARCHAR) AS commodity_code, 'Part ' || l_partkey AS commodity_name,
           CAST(c_nationkey AS VARCHAR) AS country_code, 'Nation ' || c_nationkey AS country_name,
           CAST(s_nationkey AS VARCHAR) AS port_code, 'Port ' || s_nationkey AS port_name,
           strftime(o_orderdate, '%Y-%m') AS period,
           CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS INTEGER) AS date_key,
           CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(l_extendedprice AS DECIMAL(20,2)) AS usd,
           CASE WHEN l_linenumber <> 1 THEN CAST(l_quantity AS DECIMAL(20,2)) END AS kg
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""


def glossary_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per brand with an entry per part type, in type order.

    A response is as long as the list of part types.
    """
    entry = F.transform(
        F.sort_array(F.collect_set("p_type")),
        lambda t: F.struct(
            F.concat_ws("/", "p_brand", t).alias("id"),
            F.concat(F.lit("  "), F.lower("p_brand"), F.lit("\t")).alias("nama_indikator"),
            t.alias("konsep"), F.concat(F.lit("Parts of type "), t).alias("definisi"),
            F.lit("type").alias("klasifikasi"), F.lit("price").alias("ukuran"),
            F.lit("USD").alias("satuan"), F.lit("orders").alias("sumber_data"),
        ),
    )
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(entry.alias("data"))
        .select(F.col("p_brand").alias("doc"), F.to_json(F.struct("data")).alias("body"))
    )


GLOSSARY_SQL = """
glossary AS (
    SELECT p_brand AS doc,
           ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_type) - 1 AS place,
           p_brand || '/' || p_type AS glossary_id,
           '  ' || lower(p_brand) || chr(9) AS indicator_name,
           p_type AS concept, 'Parts of type ' || p_type AS definition, 'type' AS classification,
           'price' AS measure, 'USD' AS unit, 'orders' AS data_source
    FROM (SELECT DISTINCT p_brand, p_type FROM part)
)"""


def dataset_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per brand: its own entry first, a second one after it."""
    brand = F.col("p_brand")
    entry = F.struct(
        brand.alias("id"), F.concat(F.lit("T-"), brand).alias("kode"),
        F.concat(F.lit("Parts of "), brand).alias("judul"), F.lit("Parts").alias("subjek"),
        F.lit("USD").alias("satuan"), F.lit("Annual").alias("periode"),
    )
    other = F.struct(
        F.concat(brand, F.lit("/2")).alias("id"), F.lit("x").alias("kode"),
        F.lit("x").alias("judul"), F.lit("x").alias("subjek"), F.lit("x").alias("satuan"),
        F.lit("x").alias("periode"),
    )
    return table(spark, sf_dir, "part").select("p_brand").distinct().select(
        brand.alias("doc"),
        F.to_json(F.struct(F.array(entry, other).alias("data"))).alias("body"),
    )


def region_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of regions as provinces and one of nations as regencies, each in its own shape.

    Both are as long as the nation table.
    """
    provinces = F.sort_array(F.collect_list(F.struct("r_regionkey", "r_name")))
    nested = F.concat(
        F.lit('{"data":[{"page":1},'),
        F.to_json(
            F.transform(
                provinces,
                lambda r: F.struct(
                    F.lpad(r["r_regionkey"].cast("string"), 2, "0").alias("domain_id"),
                    r["r_name"].alias("domain_name"),
                ),
            )
        ),
        F.lit("]}"),
    )
    nations = F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey")))
    flat = F.to_json(
        F.struct(
            F.transform(
                nations,
                lambda n: F.struct(
                    F.concat(
                        F.lpad(n["n_regionkey"].cast("string"), 2, "0"),
                        F.lpad(n["n_nationkey"].cast("string"), 2, "0"),
                    ).alias("kode"),
                    n["n_name"].alias("nama"),
                ),
            ).alias("data")
        )
    )
    lists = [("region", "prov", nested), ("nation", "kab", flat)]
    rows = [
        table(spark, sf_dir, name).agg(body.alias("body")).select(
            F.lit(level).alias("doc"), F.lit("domain").alias("source"),
            F.lit(level).alias("dataset"), "body",
        )
        for name, level, body in lists
    ]
    return rows[0].unionByName(rows[1])


def messy_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a staged frame of text columns with every kind of defect."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("variable_id"),
        F.when(F.col("user_id") % 17 != 0, F.col("user_id").cast("string")).alias("region_id"),
        F.when(event % 13 == 0, "unknown")
        .when(event % 29 == 0, "1850")
        .otherwise(F.year("ts").cast("string"))
        .alias("year"),
        F.when(event % 11 == 0, "n/a")
        .when(event % 19 == 0, F.concat(F.lit("-"), F.col("value").cast("decimal(10,2)")))
        .otherwise(F.col("value").cast("decimal(10,2)").cast("string"))
        .alias("value"),
    )


MESSY = """
messy AS (
    SELECT event_type AS variable_id,
           CASE WHEN user_id % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS region_id,
           CASE WHEN event_id % 13 = 0 THEN 'unknown' WHEN event_id % 29 = 0 THEN '1850'
                ELSE CAST(year(ts) AS VARCHAR) END AS year,
           CASE WHEN event_id % 11 = 0 THEN 'n/a'
                WHEN event_id % 19 = 0 THEN '-' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)
                ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS value
    FROM events
)"""
