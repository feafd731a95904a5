"""One whole run: the site's tables, the message, the feed, pollen and alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.operators import aggregates
from brisa.operators.filters import on_days
from brisa.operators.indices import index_bands
from brisa.plans import alerts, boards, feed, observations, pollen
from brisa.plans.publish import Dimensions, publish_to
from brisa.session import configure, scratch, write_out
from brisa.sources.readers import clean_sentinels
from brisa.sources.sites import Folder, changing
from brisa.sources.writers import with_day, write_feed


@dataclass(frozen=True)
class Pollen:
    """A delivered pollen week, the history before it (see ``pollen.process_week``) and its dimensions."""

    week: DataFrame
    history: DataFrame
    load_seq: int
    thresholds: DataFrame
    names: DataFrame


def run_site(
    deliveries: DataFrame,
    dims: Dimensions,
    folder: str,
    as_of: Column,
    place: str,
    link: str,
    days: DataFrame | None = None,
    week: Pollen | None = None,
    log: DataFrame | None = None,
    whole: bool = False,
) -> list[str]:
    """Publish the site (see ``publish.publish_site``), then what follows from its tables; returns all names.

    ``place`` and ``link`` go into the message and the feed; ``log`` is the run log that alerts are made from. With ``whole``,
    readers see everything that the run writes at once, or nothing of it.
    """
    spark = configure(deliveries.sparkSession)
    if not whole:
        return _run(Folder(spark, folder), deliveries, dims, as_of, place, link, days, week, log)
    with changing(spark, folder) as site:
        return _run(site, deliveries, dims, as_of, place, link, days, week, log)


def _run(site: Folder, deliveries, dims, as_of, place, link, days, week, log) -> list[str]:
    names = publish_to(site, deliveries, dims, as_of, days)
    with scratch(site.spark):
        clean = clean_sentinels(site.history("web_observations"))
        current = observations.current_indices(clean, dims.mapping, dims.breaks)
        board = write_out(boards.map_board(current, dims.stations, dims.bands), "board")
        # The stored indices are those of all days: pollutants may be older than the newest row of any series.
        like = with_day(observations.pollutant_indices(clean.drop("day"), dims.mapping, dims.breaks), "date")
        shown = site.days("indices", like).where("value IS NOT NULL")
        updated = F.coalesce(shown.select(F.max("date")).scalar(), as_of)
        site.replace("message", feed.aqi_message(board, as_of, place))
        items = feed.feed_items(board, boards.station_rows(dims.stations), updated, link)
        site.write("feed", lambda path: write_feed(items, path))
        names += ["message", "feed"]
        if week is not None:
            levels, history = pollen.process_week(week.week, week.history, week.load_seq, week.thresholds, week.names)
            site.replace("pollen_levels", levels)
            # Written first: the history may have been read from the table that it replaces.
            site.replace("pollen_history", write_out(history, "history"))
            names += ["pollen_levels", "pollen_history"]
        if log is not None:
            found = write_out(alerts.ingest_alerts(log), "alerts")
            hours = on_days(site.days("indices", like), found.where("kind = 'alive'").select(F.to_date("time").alias("day")))
            site.replace("alerts", alerts.with_air_quality(found, country_hours(hours, dims)))
            names.append("alerts")
    return names


def country_hours(index: DataFrame, dims: Dimensions, lang: str = "EN") -> DataFrame:
    """(date, aqi, band): the worst index of the global stations at each hour."""
    hourly = aggregates.station_aqi(index).withColumnRenamed("date", "day")
    country = aggregates.daily_country(hourly, boards.station_rows(dims.stations))
    banded = index_bands(country, dims.bands, "country_aqi", [lang], colors=False)
    return banded.select(F.col("day").alias("date"), F.col("country_aqi").alias("aqi"), F.col(f"country_aqi_band_{lang}").alias("band"))
