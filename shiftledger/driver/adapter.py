"""Workforce tables built from the driver's events, customer and orders tables.

Events are planned shifts (user = employee, type = activity), customers are
employees and mapping rows, orders are earlier mapping rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shiftledger.plans.performance import ShiftTables
from shiftledger.settings import Settings

AS_OF = date(2024, 1, 17)
SPAN = "CM"
# Orders run from 1995 to 2001.
MAPPING_AS_OF = date(1998, 6, 17)
ORDERS_AS_OF = date(2001, 3, 15)
# Invented ids.
SETTINGS = Settings(
    flip_persons=(20, 21, 22), exempt_persons=(31, 32, 33), line_prefix="EMP00000001"
)

_PLANNED = """
WITH timed AS (
    SELECT *, start_at + make_dt_interval(0, 0, CAST(minutes AS INT), 0) AS end_at
    FROM (
        SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS start_day,
               CAST(substring(CAST(ts AS STRING), 1, 19) AS TIMESTAMP_NTZ) AS start_at,
               CAST(floor(value) AS DECIMAL(10,0)) AS minutes
        FROM {events}
    )
)
SELECT
    user_id AS employee_id,
    CASE WHEN event_id % 41 = 0 THEN 'lunch'
         WHEN event_id % 43 = 0 THEN 'off'
         WHEN event_id % 47 = 0 THEN 'holiday'
         WHEN event_id % 53 = 0 THEN 'training'
         WHEN event_id % 59 = 0 THEN 'none'
         ELSE event_type END AS activity_id,
    start_day AS shift_start_date,
    CAST(end_at AS DATE) AS shift_end_date,
    CASE WHEN event_id % 101 <> 0 THEN start_at END AS start_time,
    CASE WHEN event_id % 101 <> 0 THEN end_at END AS end_time,
    CASE WHEN event_id % 103 <> 0
         THEN hour(start_at) * 3600 + minute(start_at) * 60 + second(start_at)
         END AS shift_start_second,
    hour(end_at) * 3600 + minute(end_at) * 60 + second(end_at) AS shift_end_second,
    CAST(minutes / 60 AS DECIMAL(18,6)) AS scheduled_time,
    CAST(CASE WHEN event_type IN ('click', 'view') THEN minutes / 60 ELSE 0 END AS DECIMAL(18,6))
        AS scheduled_paid_time,
    CAST(CASE WHEN event_type = 'purchase' THEN minutes / 60
              WHEN event_type IN ('error', 'signup') THEN user_id % 3 * 4
              ELSE 0 END AS DECIMAL(18,6)) AS scheduled_absence_time,
    CASE WHEN event_type NOT IN ('click', 'view') THEN 1 END AS is_absence,
    CASE WHEN day(start_at) IN (1, 15) THEN 1 END AS is_bank_holiday,
    CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_id % 2 = 0 THEN 0 END AS is_break_split,
    CASE WHEN event_type = 'view' THEN 1 END AS is_homeworking,
    concat('Project ', CAST(user_id % 5 AS STRING)) AS organization,
    concat(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'VAST '
                ELSE 'Interim ' END, c_mktsegment) AS interim_office,
    CASE WHEN user_id % 2 = 0 THEN 'North' ELSE 'South' END AS employment_place,
    CASE WHEN user_id % 10 = 0 AND event_type = 'click' THEN 'NLN' ELSE 'LN' END AS type_shift,
    'Contract' AS contract_name,
    'C' AS contract_name_short,
    CAST(8 AS DECIMAL(9,2)) AS contract_day_max,
    CAST(38 AS DECIMAL(9,2)) AS contract_week_max,
    CASE WHEN event_id % 7 = 0 THEN 'NightAgent'
         WHEN event_id % 97 <> 0 THEN 'DayAgent' END AS time_type,
    date_format(start_at, 'EEEE') AS weekday_name,
    date_format(start_at, 'yyyyMMdd') AS date_key
FROM timed JOIN {customer} ON user_id = c_custkey
"""

_ACTIVITY = """
SELECT activity_id,
       CASE activity_id WHEN 'click' THEN 'Prestatie' WHEN 'view' THEN 'Prestatie'
            WHEN 'purchase' THEN 'vakantie' WHEN 'error' THEN 'Ziek' WHEN 'signup' THEN 'ADV'
            WHEN 'lunch' THEN 'Lunch' WHEN 'off' THEN 'Off Day' WHEN 'holiday' THEN 'Feestdag'
            ELSE 'Opleiding' END AS name,
       CASE activity_id WHEN 'click' THEN 'Prestatie' WHEN 'view' THEN 'Prestatie'
            WHEN 'purchase' THEN 'vakantie' WHEN 'error' THEN 'Ziek' WHEN 'signup' THEN 'ADV'
            WHEN 'lunch' THEN 'Lunch' WHEN 'off' THEN 'Prestatie' WHEN 'holiday' THEN 'Feestdag'
            ELSE 'Opleiding met BEV' END AS official_name,
       CASE activity_id WHEN 'click' THEN '0100' WHEN 'view' THEN '0100'
            WHEN 'purchase' THEN '0050' WHEN 'error' THEN '4503' WHEN 'signup' THEN '3523'
            WHEN 'lunch' THEN '0000' WHEN 'off' THEN '0001' WHEN 'holiday' THEN '0353'
            ELSE 'OPL' END AS official_name_short
FROM (SELECT DISTINCT activity_id FROM {planned} WHERE activity_id <> 'none')
"""

_EMPLOYEE = """
SELECT c_custkey AS employee_id,
       c_custkey + 100000 AS employee_key,
       CASE WHEN c_custkey % 5 = 4 THEN DATE '2023-06-30' END AS valid_to,
       CASE WHEN c_custkey % 11 = 3 THEN '' WHEN c_custkey % 11 = 5 THEN 'Y'
            WHEN c_custkey % 11 <> 7 THEN CAST(c_custkey AS STRING) END AS personnel_number,
       c_mktsegment AS last_name,
       CASE WHEN c_custkey % 37 <> 36 THEN concat('N', CAST(c_nationkey AS STRING)) END AS first_name,
       concat('Street ', CAST(c_custkey AS STRING)) AS address,
       CAST(1000 + c_nationkey AS STRING) AS zip_code,
       concat('City ', CAST(c_nationkey AS STRING)) AS city,
       CASE WHEN c_custkey % 31 = 30 THEN c_name
            WHEN c_custkey % 29 <> 28 THEN concat(c_name, '@mail.example') END AS email,
       CASE WHEN c_nationkey % 3 = 0 THEN 'Lead' ELSE 'Agent' END AS position,
       DATE '2020-02-01' AS start_date,
       CASE WHEN c_custkey % 43 = 42 THEN DATE '2023-12-31'
            WHEN c_custkey % 43 = 41 THEN DATE '2024-06-30' END AS end_date
FROM {customer}
"""

_DATE_DIM = "SELECT DISTINCT CAST(ts AS DATE) AS full_date FROM {events}"

_OVERRIDES = """
SELECT DISTINCT user_id AS person_id, CAST(ts AS DATE) AS day
FROM {events} WHERE user_id % 25 = 0 AND day(ts) IN (3, 10, 17)
"""

_REFERENCE = """
CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 <> 0
     THEN concat(CAST(c_nationkey AS STRING), '-', CAST(c_custkey % 4 AS STRING)) END
"""

_MAPPING_VIEW = f"""
SELECT {_REFERENCE} AS external_reference,
       CASE WHEN c_custkey % 23 <> 0 THEN CAST(c_custkey AS INT) END AS agreement_number,
       c_name AS login
FROM {{customer}}
"""

_INCOMING = f"""
SELECT CASE WHEN c_custkey % 29 <> 0 THEN c_name END AS name,
       {_REFERENCE} AS external_reference,
       CASE WHEN c_custkey % 23 <> 0 THEN CAST(c_custkey - c_custkey % 3 AS INT) END AS agreement_number
FROM {{customer}}
"""

_EMPLOYEE_VIEW = """
SELECT c_name AS login,
       CASE WHEN c_custkey % 13 = 0 THEN concat('X', CAST(c_custkey AS STRING))
            ELSE CAST(c_custkey AS STRING) END AS personnel_number,
       CASE WHEN c_custkey % 21 = 0 THEN CAST(-1 AS BIGINT) ELSE c_custkey END AS employee_id
FROM {customer}
"""

_EMPLOYEE_VERSIONS = """
SELECT CASE WHEN c_custkey % 21 = 0 THEN CAST(-1 AS BIGINT) ELSE c_custkey END AS employee_id,
       c_custkey + 100000 AS employee_key
FROM {customer}
UNION ALL
SELECT c_custkey, c_custkey + 200000 FROM {customer} WHERE c_custkey % 6 = 0
"""

_CURRENT_MAPPING = """
SELECT o_orderpriority AS name, CAST(o_orderkey AS STRING) AS external_reference,
       CAST(o_custkey AS INT) AS agreement_number, o_custkey + 100000 AS person_id,
       c_name AS login, CAST(o_orderdate AS DATE) AS load_date, 'Older' AS month_flag
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_ORDER_FACTS = f"""
SELECT {_REFERENCE} AS external_reference,
       CAST(o_orderdate AS DATE) AS day,
       CASE o_orderpriority WHEN '1-URGENT' THEN '4503' WHEN '2-HIGH' THEN '0100'
            WHEN '3-MEDIUM' THEN '1020' WHEN '4-NOT SPECIFIED' THEN '0050' ELSE '3523' END
            AS performance_code,
       CASE WHEN c_custkey % 23 <> 0 THEN CAST(c_custkey AS INT) END AS agreement_number,
       c_custkey AS person_id, c_name AS login,
       CAST(c_nationkey AS STRING) AS first_name, c_mktsegment AS last_name,
       sum(CAST(o_orderkey % 800 AS DECIMAL(18,2)) / 100) AS hours
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
GROUP BY ALL
"""


class DriverTables:
    """The workforce tables of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        self._raw = {name: read(name) for name in ("events", "customer", "orders")}

    def _sql(self, text: str, **frames: DataFrame) -> DataFrame:
        known = {**self._raw, **frames}
        return self.spark.sql(text, **{name: df for name, df in known.items() if f"{{{name}}}" in text})

    def planned(self) -> DataFrame:
        return self._sql(_PLANNED)

    def shift_tables(self) -> ShiftTables:
        planned = self.planned()
        return ShiftTables(
            planned=planned,
            activity=self._sql(_ACTIVITY, planned=planned),
            employee=self._sql(_EMPLOYEE),
            date_dim=self._sql(_DATE_DIM),
            overrides=self._sql(_OVERRIDES),
        )

    def mapping_view(self) -> DataFrame:
        return self._sql(_MAPPING_VIEW)

    def incoming_mapping(self) -> DataFrame:
        return self._sql(_INCOMING)

    def employee_view(self) -> DataFrame:
        return self._sql(_EMPLOYEE_VIEW)

    def employee_versions(self) -> DataFrame:
        return self._sql(_EMPLOYEE_VERSIONS)

    def current_mapping(self) -> DataFrame:
        return self._sql(_CURRENT_MAPPING)

    def order_facts(self) -> DataFrame:
        """Facts over 2,399 days in the shape of mapped performance."""
        return self._sql(_ORDER_FACTS)

    def order_days(self) -> DataFrame:
        return self._sql("SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM {orders}")
