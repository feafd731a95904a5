"""Queries on a published site: what readers find after a correction of two days."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brisa.plans import publish
from brisa.session import scratch, shared_folder, write_out
from brisa.sources import sites
from checks import adapter, frames
from checks.cases_boards import MESSAGES
from checks.registry import SQL, case


def dimensions(spark):
    """The dimension tables of a network."""
    matrix = adapter.pairs(spark).groupBy("station").pivot("pollutant", ["NO2", "O3", "PM10", "PM2.5", "SO2"]).agg(F.count(F.lit(1)))
    stations = adapter.stations(spark)
    for family in ("web_type_", "web_ubicacio_", "web_comentaris_"):
        stations = stations.withColumns({family + x: F.lit(family + x) for x in ("CAT", "EN", "FR")})
    return publish.Dimensions(
        mapping=adapter.mapping(spark),
        breaks=adapter.breaks(spark),
        bands=adapter.bands(spark),
        stations=stations,
        pollutants_stations=matrix,
        colors=adapter.bands(spark).select(F.col("web_color").alias("x")),
        inversion_messages=MESSAGES,
        more_info_url="https://example.org/more",
        low_station="AD0940A",
        high_station="AD0941A",
    )


@case("publish_refresh", SQL["calendar_common"])
def publish_refresh(spark, sf):
    """The calendar of a site that is published whole, then refreshed for two days whose first deliveries were wrong."""
    folder = f"{shared_folder(spark).rstrip('/')}/site-{uuid.uuid4().hex}"
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    late = F.dayofmonth("from_time").isin(9, 10)
    with scratch(spark):
        right = write_out(frames.clean(spark, sf).drop("seq"), "right")
        earlier = {"value": F.col("value") * 2 + 5, "touched": F.col("touched") - F.expr("INTERVAL 30 MINUTES")}
        wrong = write_out(right.where(late).withColumns(earlier), "wrong")
        dims = dimensions(spark)
        publish.publish_site(right.where(~late).unionByName(wrong), dims, folder, as_of, whole=True)
        days = wrong.select(F.to_date("from_time").alias("day"))
        publish.publish_site(right.unionByName(wrong), dims, folder, as_of, days, whole=True)
    return sites.read(spark, folder, "web_daily_aq_poll")
