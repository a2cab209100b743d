"""Observations derived from the ``events`` table.

The projection is plain SQL that Spark and DuckDB evaluate alike, so the same text
feeds the Spark queries and their reference SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBSERVATION_COLUMNS = """
event_id
;concat('m', CAST(user_id * 7 + event_id % 5 AS VARCHAR(20))) AS MAC
;CASE event_type WHEN 'click' THEN 'WIFI' WHEN 'view' THEN ' wifi ' WHEN 'purchase' THEN 'BLE'
                 WHEN 'signup' THEN 'GSM' ELSE 'XYZ' END AS Type
;CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN 'n/a'
      ELSE CAST(-30 - (event_id * 31) % 70 AS VARCHAR(20)) END AS RSSI
;CASE event_id % 11 WHEN 0 THEN '1' WHEN 1 THEN '6' WHEN 2 THEN '11' WHEN 3 THEN '36' WHEN 4 THEN '52'
      WHEN 5 THEN '149' WHEN 6 THEN '38' WHEN 7 THEN '-1' WHEN 8 THEN '100' WHEN 9 THEN '6.7' ELSE '' END AS Channel
;CASE WHEN event_id % 23 = 0 THEN NULL
      ELSE (20000 + (event_id * 7919) % 40000) / CAST(1000 AS DOUBLE) END AS CurrentLatitude
;CASE WHEN event_id % 23 = 0 THEN NULL
      ELSE (-130000 + (event_id * 104729) % 170000) / CAST(1000 AS DOUBLE) END AS CurrentLongitude
;CASE event_id % 7 WHEN 0 THEN concat('Free Net ', CAST(event_id % 40 AS VARCHAR(20)))
      WHEN 1 THEN 'Pretty Fly For A Wifi' WHEN 2 THEN 'x7Qp2Lk9' WHEN 3 THEN 'aaaa'
      WHEN 4 THEN '' WHEN 5 THEN 'home-net' ELSE NULL END AS SSID
;CASE WHEN event_id % 3 = 0 THEN '[OPEN]' ELSE '[WPA2-PSK-CCMP][ESS]' END AS AuthMode
;ts AS FirstSeen
;user_id % 4 AS log_no
"""

COLUMNS = [column.strip() for column in OBSERVATION_COLUMNS.split(";")]
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

OBSERVATION_SQL = "SELECT " + ", ".join(COLUMNS) + " FROM events"


def as_observations(events: DataFrame) -> DataFrame:
    """Observation columns of an ``events`` table, batch or stream."""
    return events.selectExpr(*COLUMNS)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of a data folder."""
    return as_observations(spark.read.parquet(f"{sf_dir}/events.parquet"))
