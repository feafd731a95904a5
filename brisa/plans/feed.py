"""Messages and feed items made from the map board."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import timeutil
from brisa.operators.aggregates import country_now
from brisa.operators.joins import stack

# Wording of the published texts.
MESSAGE = "La qualitat de l'aire a %s a les %d:00 és %s - índex %d/6."
ITEM = "La qualitat de l'aire és %s - índex %d/6"
GLOBAL_TITLE = "Índex global de qualitat de l'aire"


def _plain(band: Column) -> Column:
    return F.replace(band, F.lit("&middot;"), F.lit("·"))


def aqi_message(
    board: DataFrame, as_of: Column, place: str, lang: str = "CAT", ending: str = "", template: str = MESSAGE
) -> DataFrame:
    """One text with the worst band of the country and the local hour.

    ``template`` takes place, hour, band and index; other scales and tagged wordings are templates too.
    """
    body = F.format_string(
        template,
        F.lit(place),
        F.hour(timeutil.local_time(as_of)),
        _plain(F.col(f"aqi_band_{lang}")),
        F.floor("aqi"),
    )
    return country_now(board).select(F.concat(body, F.lit(ending)).alias("message"))


def feed_items(
    board: DataFrame,
    stations: DataFrame,
    updated: Column,
    link: str,
    lang: str = "CAT",
    global_title: str = GLOBAL_TITLE,
) -> DataFrame:
    """Feed items: the country first, then every board station listed in ``stations``.

    ``updated`` is the instant of the latest data and ``link`` the address items lead to.  The board is
    read twice and should be a stored table.
    """
    text = F.format_string(ITEM, F.col(f"aqi_band_{lang}"), F.floor("aqi"))
    published = timeutil.feed_date(updated)
    whole = country_now(board).select(
        F.lit(global_title).alias("title"),
        F.lit(link).alias("link"),
        F.lit(link).alias("guid"),
        text.alias("description"),
        published.alias("pubDate"),
    )
    target = F.concat(F.lit(f"{link}station?station="), F.col("station_id"))
    each = board.join(stations.select("station_id"), "station_id", "left_semi").select(
        F.col("web_name").alias("title"),
        target.alias("link"),
        target.alias("guid"),
        text.alias("description"),
        published.alias("pubDate"),
    )
    return stack(whole, each)
