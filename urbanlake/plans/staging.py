"""Staging zone: clean, project and spatially enrich.

Inputs are *landed* frames (``sources.landing.land_*`` applied).  The functions
return lazy plans, with one exception that the caller chooses: given a
``lookup_path``, ``stage_trips`` and ``stage_permits`` write their point lookup
there when they are called (``operators.spatial.spatial_enrich``).
``plans.pipeline`` decides what else is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import calendar as cal
from ..functions.columns import impute_area
from ..operators.points import PointDictionary
from ..operators.spatial import PolygonIndex, spatial_enrich


def _index(polygons: DataFrame | PolygonIndex, key: str, cell: float | None) -> PolygonIndex:
    return polygons if isinstance(polygons, PolygonIndex) else PolygonIndex(polygons, [key], cell_size=cell)


def stage_trips(
    trips: DataFrame,
    zip_polygons: DataFrame | PolygonIndex,
    areas: DataFrame | PolygonIndex,
    zip_cell: float | None = None,
    area_cell: float | None = None,
    lookup_path: str | None = None,
    cover: Callable | None = None,
    dictionary: PointDictionary | None = None,
) -> DataFrame:
    """``STG.TRIPS_DATA`` (P1): trips with a located endpoint, the ZIP of each
    endpoint, community areas imputed from the area polygons, labels.

    The four spatial joins are LEFT and keep duplicates (S12); each polygon
    layer is indexed once (pass ``PolygonIndex`` objects to share them with
    ``stage_permits``).  With ``lookup_path`` the exact test runs once per
    distinct location, with a ``dictionary`` once for all runs (``update`` it
    first, ``point_sources``), else once per row; ``cover=DensityCover`` splits the
    cells where points crowd (``operators.cover``).  Only the columns the output needs are read, and the
    "any endpoint located" filter runs before the joins.
    """
    t = trips.where(F.col("pickup_point").isNotNull() | F.col("dropoff_point").isNotNull()).select(
        "trip_id", "trip_start", "week_start", "week_start_iso",
        "pickup_community_area", "dropoff_community_area",
        "pickup_lat", "pickup_lon", "pickup_point",
        "dropoff_lat", "dropoff_lon", "dropoff_point",
    )
    zips = _index(zip_polygons, "zip", zip_cell)
    ca = _index(areas, "area_numbe", area_cell)
    t = spatial_enrich(
        t,
        [
            ("pickup_point", zips, {"pickup_zip": "zip"}),
            ("dropoff_point", zips, {"dropoff_zip": "zip"}),
            ("pickup_point", ca, {"_pickup_area_match": "area_numbe"}),
            ("dropoff_point", ca, {"_dropoff_area_match": "area_numbe"}),
        ],
        lookup_path,
        cover,
        dictionary,
    )
    return t.select(
        "trip_id",
        "trip_start",
        "week_start",
        impute_area("pickup_community_area", "_pickup_area_match").cast("int").alias("pickup_community_area"),
        impute_area("dropoff_community_area", "_dropoff_area_match").cast("int").alias("dropoff_community_area"),
        "pickup_lat", "pickup_lon", "pickup_point",
        "dropoff_lat", "dropoff_lon", "dropoff_point",
        F.col("pickup_zip").cast("int").alias("pickup_zip"),
        F.col("dropoff_zip").cast("int").alias("dropoff_zip"),
        cal.week_label("week_start_iso").alias("week_number"),
        cal.month_label("trip_start").alias("month_number"),
    )


def point_sources(trips: DataFrame | None = None, permits: DataFrame | None = None) -> list[tuple[DataFrame, list[str]]]:
    """What ``PointDictionary.update`` needs before these are staged."""
    found = [(trips, ["pickup_point", "dropoff_point"]), (permits, ["location_point"])]
    return [(df, columns) for df, columns in found if df is not None]


def stage_covid(covid: DataFrame) -> DataFrame:
    """``STG.COVID_BY_ZIP`` (P2): known ZIPs with a location, labels from the week start."""
    return covid.where(
        F.col("zip_code").isNotNull() & (F.col("zip_code") != "Unknown") & F.col("zip_point").isNotNull()
    ).select(
        "zip_code",
        "week_start",
        F.col("cases_weekly").cast("int").alias("cases_weekly"),
        F.col("cases_cumulative").cast("int").alias("cases_cumulative"),
        F.col("tests_weekly").cast("int").alias("tests_weekly"),
        F.col("tests_cumulative").cast("int").alias("tests_cumulative"),
        cal.week_label("week_start_iso").alias("week_number"),
        cal.month_label("week_start").alias("month_number"),
    )


def stage_ccvi(ccvi: DataFrame) -> DataFrame:
    """``STG.CCVI_BY_CA`` (P3): community-area rows only, then the area cast.

    The filter must precede the cast: ZIP rows could hold text that is not a
    number and ANSI casting would fail on it (S14).
    """
    return ccvi.where(F.trim(F.col("geography_type")) == "CA").select(
        F.col("area_or_zip").cast("decimal(18,2)").cast("int").alias("community_area"),
        "ccvi_category",
    )


def stage_permits(
    permits: DataFrame,
    zip_polygons: DataFrame | PolygonIndex,
    areas: DataFrame | PolygonIndex,
    zip_cell: float | None = None,
    area_cell: float | None = None,
    lookup_path: str | None = None,
    cover: Callable | None = None,
    dictionary: PointDictionary | None = None,
) -> DataFrame:
    """``STG.BUILDING_PERMIT`` (P4): located permits with ZIP and imputed area."""
    p = permits.where(F.col("location_point").isNotNull()).select(
        "id", "permit_no", "permit_type", "subtotal_unpaid", "latitude", "longitude",
        "location_point", "community_area",
    )
    p = spatial_enrich(
        p,
        [
            ("location_point", _index(zip_polygons, "zip", zip_cell), {"zip": "zip"}),
            ("location_point", _index(areas, "area_numbe", area_cell), {"_area_match": "area_numbe"}),
        ],
        lookup_path,
        cover,
        dictionary,
    )
    return p.select(
        "id",
        "permit_no",
        "permit_type",
        F.col("subtotal_unpaid").cast(schemas.MONEY).alias("subtotal_unpaid"),
        "latitude",
        "longitude",
        "location_point",
        impute_area("community_area", "_area_match").cast("int").alias("community_area"),
        F.col("zip").cast("int").alias("zip"),
    )


def stage_health(health: DataFrame) -> DataFrame:
    """``STG.PUBLIC_HEALTH`` (P5): four columns, numerics assigned to double."""
    return health.select(
        F.col("community_area").cast("int").alias("community_area"),
        F.col("below_poverty_level").cast("double").alias("below_poverty_level"),
        F.col("per_capita_income").cast(schemas.MONEY).alias("per_capita_income"),
        F.col("unemployment").cast("double").alias("unemployment"),
    )
