"""Spark SQL over parsed messages, exposed as a temp view with the messages' own nested columns
(guid, destination, eventTime, payload.*), under a name that the caller chooses (S8, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.functions.ranks import ranked
from vigil.plans import feeds
from vigil.sources.framing import decode_records
from vigil.sources.tables import events

VIEW = "messages"
_TEMPERATURE = "payload.data.temperature"


def register_messages(msgs: DataFrame, name: str = VIEW) -> None:
    """Flatten (…, msg) rows to the message's own columns and register them as a temp view."""
    msgs.select("msg.*").createOrReplaceTempView(name)


def drop_messages(spark: SparkSession, name: str = VIEW) -> None:
    spark.catalog.dropTempView(name)


def _query(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    msgs, _ = decode_records(feeds.json_records(events(spark, sf_dir)), keep=["offset"])
    register_messages(msgs)
    return spark.sql(text.format(view=VIEW, t=_TEMPERATURE))


def sql_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All temperatures, highest first, with their rank (equal ones share it)."""
    return ranked(_query(spark, sf_dir, "SELECT {t} AS temperature FROM {view}"), [], "temperature", "place")


def sql_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "SELECT {t} AS temperature FROM {view} WHERE {t} = 100.0")


def sql_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "SELECT {t} AS temperature FROM {view} WHERE {t} > 85")


def sql_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, """
        SELECT guid, p.reply_to AS reply_url, d.temperature, d.pressure, d.humidity, d.ambient_light
        FROM (SELECT guid, payload AS p, payload.data AS d FROM {view})""")


def sql_distinct_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, """
        SELECT DISTINCT float({t}) AS temperature FROM {view} ORDER BY temperature DESC""")


__all__ = ["register_messages", "drop_messages", "sql_sort", "sql_search", "sql_filter",
           "sql_readings", "sql_distinct_float"]
