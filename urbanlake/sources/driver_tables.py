"""Adapters: the shared TPC-H-style test tables → raw landing tables.

The reference ships no data.  These deterministic derivations give every
landing table of the pipeline from the parquet tables in a test-data folder
(``lineitem``, ``orders``, ``customer``, ``part``, ``supplier``, ``nation``,
``region``), so each registered query does work that grows with those
tables.  Each adapter returns a frame in the *raw* landing schema
(geometry as WKT text), exactly what ``sources.landing.read_csv`` returns for
a real file, so the same ``land_*`` → ``stage_*`` → report code runs on both.

Derivations (FIXTURES.md §3, with the permit location added so permits go
through the spatial join like the reference's, and whole part / supplier
tables instead of key ranges):

* trips ← lineitem: id ``l_orderkey*10 + l_linenumber`` (not unique), date
  ``l_shipdate``, areas ``l_partkey % 78`` / ``l_suppkey % 78`` (0 = missing),
  pickup ``((l_partkey%50)/10+.05, (l_orderkey%50)/10+.05)`` unless
  ``l_returnflag='R'``, dropoff ``((l_suppkey%50)/10+.05, (l_orderkey*7%50)/10+.05)``
  only when ``l_linestatus='F'``;
* ZIP polygons ← nation: a notched unit cell (6 corners) at
  ``(n%5, n/5)``, ZIP = ``n_nationkey``;
* community areas ← region: strip ``[r, r+1] × [0, 5]``, area = ``r+1``;
* COVID weekly ← orders ⋈ customer: ZIP = ``c_nationkey`` (``Unknown``,
  without a location, for customers with ``c_custkey % 97 = 0``; ZIP 13 has
  no location in January weeks), Sunday week of ``o_orderdate``, cases =
  finished orders, tests = all orders, weeks without a finished order
  absent;
* vulnerability ← part: area ``p_partkey``, a ``' CA '`` row except every
  tenth part, which is a ``ZIP`` row; category by ``p_partkey % 3``:
  ``HIGH``, ``High``, ``low``;
* public health ← supplier: area ``s_suppkey``, unemployment
  ``s_acctbal/1000``, poverty ``s_nationkey``, income ``s_acctbal*10``;
* permits ← orders: ``1-URGENT`` is new construction, unpaid fee
  ``o_totalprice``, area ``o_custkey % 78`` (0 = missing), location
  ``((o_custkey%50)/10+.05, (o_orderkey*3%50)/10+.05)`` unless status ``P``.

Every row of every table is used.  Trip and permit areas are 0..77, so
vulnerability and health rows for larger area numbers never match — the
"area without trips" and unmatched-join cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .. import schemas
from ..functions import calendar as cal

# Airport pickup ZIPs of the test polygons, which are numbered
# by nation key (stand-ins for schemas.REFERENCE_AIRPORTS).
TEST_AIRPORTS = {"Midway": [3], "O'Hare": [7, 8]}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns in order, typed; absent ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _tenth(c: Column) -> Column:
    """``(c % 50) / 10 + 0.05`` in double arithmetic."""
    return (c % 50).cast("double") / F.lit(10.0) + F.lit(0.05)


def _wkt_point(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))


def _wkt_polygon(corners: list[tuple[Column, Column]]) -> Column:
    parts: list[Column] = [F.lit("MULTIPOLYGON (((")]
    for k, (x, y) in enumerate(corners):
        if k:
            parts.append(F.lit(", "))
        parts += [x.cast("double").cast("string"), F.lit(" "), y.cast("double").cast("string")]
    parts.append(F.lit(")))"))
    return F.concat(*parts)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    px = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(_tenth(pk))
    py = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(_tenth(ok))
    is_f = F.col("l_linestatus") == "F"
    dx = F.when(is_f, _tenth(sk))
    dy = F.when(is_f, _tenth(ok * 7))
    trip_start = F.col("l_shipdate").cast("date")
    df = li.select(
        (ok * 10 + F.col("l_linenumber")).cast("string").alias("trip_id"),
        F.concat(F.lit("T"), sk.cast("string")).alias("taxi_id"),
        trip_start.alias("trip_start"),
        F.date_add(trip_start, F.col("l_linenumber") % 2).alias("trip_end"),
        (F.col("l_quantity") * 60).alias("trip_seconds"),
        F.col("l_quantity").alias("trip_miles"),
        pk.alias("pickup_census_tract"),
        sk.alias("dropoff_census_tract"),
        (pk % 78).alias("pickup_community_area"),
        (sk % 78).alias("dropoff_community_area"),
        F.col("l_extendedprice").alias("fare"),
        F.col("l_returnflag").alias("payment_type"),
        F.concat(
            F.lit('Co "'), F.col("l_linestatus"), F.lit('", Ltd'),
            F.when(F.col("l_linenumber") == 1, F.lit("\nBranch")).otherwise(F.lit("")),
        ).alias("company"),
        py.alias("pickup_lat"),
        px.alias("pickup_lon"),
        _wkt_point(px, py).alias("pickup_location"),
        dy.alias("dropoff_lat"),
        dx.alias("dropoff_lon"),
        _wkt_point(dx, dy).alias("dropoff_location"),
    )
    return conform(df, schemas.TAXI_TRIPS)


def zip_polygons_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    i, j = (n % 5).cast("double"), F.floor(n / 5).cast("double")
    h = F.lit(0.5)
    corners = [(i, j), (i + 1, j), (i + 1, j + h), (i + h, j + h), (i + h, j + 1), (i, j + 1), (i, j)]
    df = _read(spark, sf_dir, "nation").select(
        _wkt_polygon(corners).alias("the_geom"),
        (n + 1).alias("objectid"),
        n.alias("zip"),
        F.lit(0.75).alias("shape_area"),
        F.lit(4.0).alias("shape_len"),
    )
    return conform(df, schemas.BOUNDARIES_ZIP)


def area_polygons_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("r_regionkey").cast("double")
    z, top = F.lit(0.0), F.lit(5.0)
    corners = [(r, z), (r + 1, z), (r + 1, top), (r, top), (r, z)]
    df = _read(spark, sf_dir, "region").select(
        _wkt_polygon(corners).alias("the_geom"),
        F.lit(12.0).alias("perimeter"),
        F.lit(5.0).alias("area"),
        (F.col("r_regionkey") + 1).alias("area_numbe"),
        F.col("r_name").alias("community"),
        (F.col("r_regionkey") + 1).alias("area_num_1"),
    )
    return conform(df, schemas.COMM_AREA)


def covid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", cal.week_start(F.col("o_orderdate").cast("date")).alias("week_start")
    )
    cust = _read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 97 == 0, F.lit("Unknown"))
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("zip_code"),
    )
    g = (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .groupBy("zip_code", "week_start")
        .agg(
            F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("cases_weekly"),
            F.count(F.lit(1)).alias("tests_weekly"),
        )
        .where(F.col("cases_weekly") > 0)
    )
    run = Window.partitionBy("zip_code").orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("zip_code") != "Unknown"
    n = F.when(known, F.col("zip_code")).cast("int")
    located = known & ~((n == 13) & (F.month("week_start") == 1))
    df = g.select(
        "zip_code",
        F.weekofyear(cal.iso_from_week_start("week_start")).alias("week_number"),
        "week_start",
        F.date_add("week_start", 6).alias("week_end"),
        "cases_weekly",
        F.sum("cases_weekly").over(run).alias("cases_cumulative"),
        "tests_weekly",
        F.sum("tests_weekly").over(run).alias("tests_cumulative"),
        F.concat(F.col("zip_code"), F.lit("-"), F.date_format("week_start", "yyyyMMdd")).alias("row_id"),
        F.when(
            located,
            _wkt_point((n % 5).cast("double") + F.lit(0.25), F.floor(n / 5).cast("double") + F.lit(0.25)),
        ).alias("zip_location"),
    )
    return conform(df, schemas.COVID_BY_ZIP)


def ccvi_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    is_ca = p % 10 != 0
    df = (
        _read(spark, sf_dir, "part")
        .select(
            F.when(is_ca, F.lit(" CA ")).otherwise(F.lit("ZIP")).alias("geography_type"),
            F.when(is_ca, p.cast("string")).otherwise((p + 60600).cast("string")).alias("area_or_zip"),
            F.col("p_name").alias("community_area_name"),
            F.col("p_size").cast("double").alias("ccvi_score"),
            F.when(p % 3 == 0, "HIGH").when(p % 3 == 1, "High").otherwise("low").alias("ccvi_category"),
        )
    )
    return conform(df, schemas.CCVI_BY_CA)


def health_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = (
        _read(spark, sf_dir, "supplier")
        .select(
            F.col("s_suppkey").alias("community_area"),
            F.col("s_name").alias("community_area_name"),
            F.col("s_nationkey").cast("double").alias("below_poverty_level"),
            (F.col("s_acctbal") * 10).alias("per_capita_income"),
            (F.col("s_acctbal") / F.lit(1000.0)).alias("unemployment"),
        )
    )
    return conform(df, schemas.PUBLIC_HEALTH)


def permits_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    pending = F.col("o_orderstatus") == "P"
    x = F.when(pending, F.lit(None)).otherwise(_tenth(ck))
    y = F.when(pending, F.lit(None)).otherwise(_tenth(ok * 3))
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("PERMIT - NEW CONSTRUCTION")).otherwise(
        F.col("o_orderpriority")
    )
    df = _read(spark, sf_dir, "orders").select(
        ok.cast("string").alias("id"),
        F.concat(F.lit("P"), ok.cast("string")).alias("permit_no"),
        F.col("o_orderstatus").alias("permit_status"),
        F.concat(F.lit(" "), kind, F.lit(" ")).alias("permit_type"),
        F.col("o_orderdate").cast("date").alias("application_start_date"),
        F.col("o_totalprice").cast(schemas.MONEY).cast("string").alias("subtotal_unpaid"),
        (ck % 78).alias("community_area"),
        y.alias("latitude"),
        x.alias("longitude"),
        _wkt_point(x, y).alias("location"),
    )
    return conform(df, schemas.BUILDING_PERMIT)


RAW = {
    "taxi_trips": trips_raw,
    "boundaries_zip": zip_polygons_raw,
    "comm_area": area_polygons_raw,
    "covid_by_zip": covid_raw,
    "ccvi_by_ca": ccvi_raw,
    "public_health": health_raw,
    "building_permit": permits_raw,
}
