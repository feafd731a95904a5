"""The hourly publication: every table of the site from observations and dimension tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import timeutil
from brisa.operators import aggregates
from brisa.operators.filters import newest_part, on_days
from brisa.operators.joins import new_rows, stack
from brisa.operators.reshape import expected_pairs
from brisa.plans import boards, observations
from brisa.schemas import OBSERVATIONS
from brisa.session import configure, scratch, write_out
from brisa.sources.readers import clean_sentinels
from brisa.sources.sites import Folder, changing
from brisa.sources.writers import with_day, with_sentinels


@dataclass(frozen=True)
class Dimensions:
    """Dimension tables and settings of a network."""

    mapping: DataFrame
    breaks: DataFrame
    bands: DataFrame
    stations: DataFrame
    pollutants_stations: DataFrame
    colors: DataFrame
    inversion_messages: Mapping[str, Mapping[str, str]]
    more_info_url: str
    low_station: str
    high_station: str


def refresh_observations(deliveries: DataFrame, days: DataFrame, site: Folder) -> None:
    """Rebuild the published observations of the given days from all kept deliveries."""
    rows = on_days(deliveries if "day" in deliveries.columns else with_day(deliveries), days)
    clean = observations.published_observations(rows.drop("day"))
    stored = with_day(with_sentinels(clean.select(*[f.name for f in OBSERVATIONS.fields])))
    site.save_days("web_observations", stored, "sampling_point_id", "from_time", rebuilt=days)


def _around(days: DataFrame, first: int, last: int) -> DataFrame:
    """The days and their neighbours from ``first`` to ``last`` days away."""
    offsets = F.array(*[F.lit(n) for n in range(first, last + 1)])
    return days.select(F.explode(F.transform(offsets, lambda n: F.date_add("day", n))).alias("day")).distinct()


def refresh_indices(clean: DataFrame, days: DataFrame, dims: Dimensions, site: Folder) -> DataFrame:
    """Rebuild the stored indices that a change on the given days can reach, and return all that are stored.

    Running means look back less than a day: they change on a day and the next, and the hours they
    need start the day before.
    """
    rows = on_days(clean, _around(days, -1, 1))
    index = observations.pollutant_indices(rows.drop("day"), dims.mapping, dims.breaks)
    stored = with_day(index.withColumn("_begin", timeutil.add_hours("date", -1)), "_begin").drop("_begin")
    reached = _around(days, 0, 1)
    site.save_days("indices", on_days(stored, reached), "station", "date", rebuilt=reached)
    return site.days("indices", stored)


def refresh_daily(index: DataFrame, days: DataFrame, site: Folder) -> tuple[DataFrame, DataFrame]:
    """Rebuild the daily worst of the days that :func:`refresh_indices` can have changed; returns all days and those.

    The last hour that begins on a day ends on the next one and belongs to its calendar day.
    """
    rows = on_days(index, _around(days, -1, 2)).drop("day")
    daily, reached = boards.daily_wide(rows), _around(days, 0, 2)
    site.save_days("daily", on_days(daily, reached), "station", rebuilt=reached)
    return site.days("daily", daily), reached


def refresh_calendars(daily: DataFrame, days: DataFrame, dims: Dimensions, site: Folder) -> None:
    """Rebuild the calendars of the given days, and of those behind them whose numbers move.

    Each day has its row counts stored. Numbers are prefix sums of these and a row's place in its day, so days
    move only if an earlier one has gained or lost rows, and no other day is read.
    """
    per_day = len(boards.POLLUTANT_ORDER)
    fresh = on_days(daily, days)
    world = boards.country_days(fresh, dims.stations, dims.bands).select("day").withColumn("country", F.lit(1))
    counts = fresh.groupBy("day").agg((F.count(F.lit(1)) * per_day).alias("rows")).join(world, "day", "left")
    counts = counts.select("day", "rows", F.coalesce("country", F.lit(0)).cast("bigint").alias("country"))
    before = write_out(site.whole("calendar_days", counts), "counts")
    after = write_out(stack(new_rows(before, days, ["day"]), counts), "counts")
    site.replace("calendar_days", after)
    for column, name, rows, common, lang, order, prefix in (
        ("rows", "web_daily_aq_poll", _by_pollutant, boards.calendar_common, boards.calendar_lang, ["station", "pollutant"], "pAQ"),
        ("country", "web_daily_aq_global", _country, boards.country_common, boards.country_lang, ["country_aqi"], "GAQ"),
    ):
        old, new = (boards.day_offsets(c.where(F.col(column) > 0).select("day", F.col(column).alias("rows"))) for c in (before, after))
        rebuilt = write_out(days.select("day").union(boards.moved_days(old, new)).distinct(), "rebuilt")
        board = write_out(boards.numbered_by_day(rows(on_days(daily, rebuilt), dims), new, order, prefix), "calendar")
        site.save_days(name, common(board), "id", rebuilt=rebuilt)
        site.save_days(f"{name}_lang", lang(board, ("id", "day")), "id", rebuilt=rebuilt)


def _by_pollutant(daily: DataFrame, dims: Dimensions) -> DataFrame:
    return boards.daily_rows(daily, dims.bands)


def _country(daily: DataFrame, dims: Dimensions) -> DataFrame:
    return boards.country_days(daily, dims.stations, dims.bands)


def refresh_extents(clean: DataFrame, days: DataFrame, site: Folder) -> DataFrame:
    """Rebuild the stored first and last hours of each series on the given days, and return those of all days."""
    extents = aggregates.series_extent(on_days(clean, days), ("day", "sampling_point_id"))
    site.save_days("extents", extents, "sampling_point_id", rebuilt=days)
    return site.days("extents", extents)


def site_tables(
    clean: DataFrame, index: DataFrame, extents: DataFrame, dims: Dimensions, as_of: Column
) -> dict[str, DataFrame]:
    """Name -> table that is written as a whole, from stored observations, their stored summaries and the present time.

    The latest boards read the last hours of the observations and the graph their last days. The last
    update is the last hour with any concentration after running means, as the boards show them.
    """
    current = write_out(observations.current_indices(clean, dims.mapping, dims.breaks), "current")
    pairs = expected_pairs(dims.pollutants_stations)
    latest = boards.latest_board(current, dims.mapping, pairs, dims.bands)
    on_map = boards.map_board(current, dims.stations, dims.bands)
    freshness = boards.staleness(index.where("value IS NOT NULL"), as_of)
    sites = boards.inversion_readings(observations.temperatures(clean), dims.low_station, dims.high_station)
    inversion = boards.temperature_inversion(
        newest_part(sites, "date"), dims.low_station, dims.high_station
    )
    return {
        "web_mapping": boards.mapping_distinct(dims.mapping),
        "web_graphic_colors": boards.graph_colors(dims.colors),
        "web_mapping_data": boards.series_catalogue(extents, dims.mapping, dims.stations),
        "web_latest_data": boards.latest_common(latest),
        "web_latest_data_lang": boards.latest_lang(latest),
        "web_stations": boards.stations_common(dims.stations),
        "web_stations_lang": boards.stations_lang(dims.stations),
        "web_map": boards.map_common(on_map),
        "web_map_lang": boards.map_lang(on_map),
        "web_observations_graph": observations.graph_rows(clean, as_of, sentinel=True),
        "web_utils": boards.utils_rows(freshness, inversion, dims.inversion_messages, dims.more_info_url),
    }


CALENDARS = ["web_daily_aq_poll", "web_daily_aq_poll_lang", "web_daily_aq_global", "web_daily_aq_global_lang"]


def publish_site(
    deliveries: DataFrame, dims: Dimensions, folder: str, as_of: Column, days: DataFrame | None = None, whole: bool = False
) -> list[str]:
    """Store observations, indices and daily worst below ``folder``, then write every table of the site.

    ``deliveries`` are all kept deliveries (missing values as nulls).  With ``days``, the days of the
    newest ones, only what those can change is rebuilt; without, everything is, and days stored before
    that have no delivery any more are cleared.  Intermediate tables are removed at the end.  With ``whole``,
    readers (:func:`brisa.sources.sites.read`) see all tables change at once, or none if the run fails; without, each
    table is overwritten where it lies.  Returns the names of the published tables.
    """
    spark = configure(deliveries.sparkSession)
    if not whole:
        return publish_to(Folder(spark, folder), deliveries, dims, as_of, days)
    with changing(spark, folder) as site:
        return publish_to(site, deliveries, dims, as_of, days)


def publish_to(site: Folder, deliveries: DataFrame, dims: Dimensions, as_of: Column, days: DataFrame | None = None) -> list[str]:
    """:func:`publish_site` into a plain folder or a change."""
    with scratch(site.spark):
        if days is None:
            days = with_day(deliveries).select("day").union(with_day(site.history("web_observations")).select("day"))
        changed = write_out(days.where("day IS NOT NULL").select("day").distinct(), "changed")
        refresh_observations(deliveries, changed, site)
        clean = clean_sentinels(site.history("web_observations"))
        index = refresh_indices(clean, changed, dims, site)
        daily, reached = refresh_daily(index, changed, site)
        refresh_calendars(daily, write_out(reached, "reached"), dims, site)
        extents = aggregates.merge_extents(refresh_extents(clean, changed, site))
        tables = site_tables(clean, index, extents, dims, as_of)
        for name, table in tables.items():
            site.replace(name, table)
    return ["web_observations", *tables, *CALENDARS]


def as_of_now() -> Column:
    """The present time; pass a literal instead to repeat a run."""
    return F.current_timestamp()
