"""Small lookup tables, brought to one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.text import is_blank, standardize_name, strip_padding, unquote


def load_locations(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Raw location -> lat, lon, location_id. Rows without location, lat or lon are left out.

    Of several rows for one location the last by ``order_by`` wins; without an order the largest
    (location_id, lat, lon) wins, so the result never depends on file order.
    """
    names = ["raw_location", "lat", "lon", "location_id"]
    keep = [unquote(F.col(n)).alias(n) for n in names] + ([F.col(order_by).alias("_order")] if order_by else [])
    rows = df.select(*keep).filter(~is_blank(F.col("raw_location")) & ~is_blank(F.col("lat")) & ~is_blank(F.col("lon")))
    rank = F.struct(*([F.col("_order")] if order_by else []), "location_id", "lat", "lon")
    best = rows.groupBy("raw_location").agg(F.max(rank).alias("best"))
    return best.select("raw_location", "best.lat", "best.lon", "best.location_id")


def load_zones(df: DataFrame, name: str = "zone", zone_id: str = "location_id") -> DataFrame:
    """Standardised zone name -> zone id. Ids must be integers; "special event" rows are dropped."""
    text = strip_padding(F.col(zone_id).cast("string"))
    rows = df.select(
        strip_padding(F.col(name)).alias("zone"),
        F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int")).alias("location_id"),
    )
    rows = rows.filter(
        F.col("location_id").isNotNull()
        & ~is_blank(F.col("zone"))
        & ~F.lower("zone").contains("special event")
    )
    return rows.groupBy(standardize_name(F.col("zone")).alias("zone_name")).agg(
        F.max("location_id").alias("location_id")
    )
