"""Registry of named queries: name -> (spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.plans import batchjobs as B
from vigil.plans import sensors
from vigil.plans import sqlview as Q
from vigil.plans import streams
from vigil.plans.oracle import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "breaches": sensors.breaches,
    "running_stats": sensors.running_stats,
    "running_totals": sensors.running_totals_q,
    "sensor_states": sensors.sensor_states,
    "breach_events": sensors.breach_events,
    "alarm_type": sensors.alarm_type_q,
    "alarm_commands": sensors.alarm_commands_q,
    "alarm_with_acks": sensors.alarm_with_acks,
    "json_decode": B.json_decode,
    "json_reassemble": B.json_reassemble,
    "reassemble_rejects": B.reassemble_rejects,
    "decode_mixed": B.decode_mixed,
    "read_documents": B.read_documents,
    "read_text": B.read_text,
    "sensor_array": B.sensor_array,
    "rejects": B.rejects,
    "distinct_float": B.distinct_float,
    "summary": B.summary_q,
    "summary_stats": B.summary_stats,
    "describe": B.describe,
    "alerts": B.alerts,
    "search_eq": B.search_eq,
    "filter_gt": B.filter_gt,
    "top_desc": B.top_desc,
    "line_filter": B.line_filter,
    "line_filter_values": B.line_filter_values,
    "line_filter_temperature": B.line_filter_temperature,
    "line_values": B.line_values,
    "batch_count": B.batch_count,
    "batch_sum": B.batch_sum,
    "batch_sort": B.batch_sort,
    "string_sort": B.string_sort,
    "word_counts": B.word_counts,
    "word_total": B.word_total,
    "strip_whitespace": B.strip_whitespace,
    "residual_breaches": B.residual_breaches,
    "device_breaches": sensors.device_breaches,
    "device_alarm_commands": sensors.device_alarm_commands,
    "stream_events": streams.stream_events,
    "stream_commands": streams.stream_commands,
    "stream_acks": streams.stream_acks,
    "stream_statistics": streams.stream_statistics,
    "stream_reassemble": streams.stream_reassemble,
    "stream_headers": streams.stream_headers,
    "stream_line_sums": streams.stream_line_sums,
    "stream_word_counts": streams.stream_word_counts,
    "sql_sort": Q.sql_sort,
    "sql_search": Q.sql_search,
    "sql_filter": Q.sql_filter,
    "sql_readings": Q.sql_readings,
    "sql_distinct_float": Q.sql_distinct_float,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
