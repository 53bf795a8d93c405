"""Reference results as DuckDB SQL over the driver's tables.

Written in the procedural form the rules were stated in (global windows, range
joins, aggregates joined back, three-step duplicate search), so that the Spark
forms are checked against something different.
"""

from __future__ import annotations

from shiftledger.driver.adapter import SETTINGS
from shiftledger.operators.hours import FLEX_COLUMNS, HOUR_COLUMNS
from shiftledger.operators.shifts import PROFILE, SHIFT

_FROM, _TO = "DATE '2024-01-01'", "DATE '2024-01-31'"
_WIDE_FROM, _WIDE_TO = "DATE '2023-12-31'", "DATE '2024-02-01'"
_AS_OF = "DATE '2024-01-17'"
_MAPPING_AS_OF = "DATE '1998-06-17'"
_SICK = "TRY_CAST(performance_code AS INT) IN (4503, 3523)"

# Fixed values, stated here once more so that a wrong one in the library shows.
GAP_CODES = ("0050", "0250", "0353", "0359", "3031", "3523", "4503")
BRIDGE_PRIORITY = ("0050", "0250", "0359", "3031", "3523", "0353", "4503")
ABSENCE_GROUPS = (
    "Feestdag", "Ziek", "ADV", "vakantie", "Ongewettigd afwezig", "Bevallingsverlof",
    "Educatief verlof", "Familiaal verlof", "Klein Verlet", "Langdurig ziek", "Ouderschapsverlof",
)
_GAPS = ", ".join(f"'{code}'" for code in GAP_CODES)

_ORDER = ["full_name", "start_time", "employee_id"]
_ORDER += [name for name in [*SHIFT, *PROFILE, "scheduled_time"] if name not in _ORDER]
_ORDER_BY = ", ".join(f"{name} NULLS FIRST" for name in _ORDER)

_INPUTS = {
    "planned": """
        SELECT user_id AS employee_id,
               CASE WHEN event_id % 41 = 0 THEN 'lunch' WHEN event_id % 43 = 0 THEN 'off'
                    WHEN event_id % 47 = 0 THEN 'holiday' WHEN event_id % 53 = 0 THEN 'training'
                    WHEN event_id % 59 = 0 THEN 'none' ELSE event_type END AS activity_id,
               CAST(start_at AS DATE) AS shift_start_date, CAST(end_at AS DATE) AS shift_end_date,
               CASE WHEN event_id % 101 <> 0 THEN start_at END AS start_time,
               CASE WHEN event_id % 101 <> 0 THEN end_at END AS end_time,
               CASE WHEN event_id % 103 <> 0
                    THEN hour(start_at) * 3600 + minute(start_at) * 60 + second(start_at)
                    END AS shift_start_second,
               hour(end_at) * 3600 + minute(end_at) * 60 + second(end_at) AS shift_end_second,
               CAST(minutes / 60.0 AS DECIMAL(18,6)) AS scheduled_time,
               CAST(CASE WHEN event_type IN ('click', 'view') THEN minutes / 60.0 ELSE 0 END
                    AS DECIMAL(18,6)) AS scheduled_paid_time,
               CAST(CASE WHEN event_type = 'purchase' THEN minutes / 60.0
                         WHEN event_type IN ('error', 'signup') THEN user_id % 3 * 4
                         ELSE 0 END AS DECIMAL(18,6)) AS scheduled_absence_time,
               CASE WHEN event_type NOT IN ('click', 'view') THEN 1 END AS is_absence,
               CASE WHEN day(start_at) IN (1, 15) THEN 1 END AS is_bank_holiday,
               CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_id % 2 = 0 THEN 0 END AS is_break_split,
               CASE WHEN event_type = 'view' THEN 1 END AS is_homeworking,
               'Project ' || (user_id % 5) AS organization,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
                    THEN 'VAST ' ELSE 'Interim ' END || c_mktsegment AS interim_office,
               CASE WHEN user_id % 2 = 0 THEN 'North' ELSE 'South' END AS employment_place,
               CASE WHEN user_id % 10 = 0 AND event_type = 'click' THEN 'NLN' ELSE 'LN' END AS type_shift,
               'Contract' AS contract_name, 'C' AS contract_name_short,
               8 AS contract_day_max, 38 AS contract_week_max,
               CASE WHEN event_id % 7 = 0 THEN 'NightAgent'
                    WHEN event_id % 97 <> 0 THEN 'DayAgent' END AS time_type,
               dayname(start_at) AS weekday_name,
               strftime(start_at, '%Y%m%d') AS date_key
        FROM (SELECT *, start_at + to_minutes(minutes) AS end_at
              FROM (SELECT event_id, user_id, event_type, date_trunc('second', ts) AS start_at,
                           CAST(floor(value) AS BIGINT) AS minutes FROM events))
        JOIN customer ON user_id = c_custkey""",
    "activity": """
        SELECT * FROM (VALUES
            ('click', 'Prestatie', 'Prestatie', '0100'), ('view', 'Prestatie', 'Prestatie', '0100'),
            ('purchase', 'vakantie', 'vakantie', '0050'), ('error', 'Ziek', 'Ziek', '4503'),
            ('signup', 'ADV', 'ADV', '3523'), ('lunch', 'Lunch', 'Lunch', '0000'),
            ('off', 'Off Day', 'Prestatie', '0001'), ('holiday', 'Feestdag', 'Feestdag', '0353'),
            ('training', 'Opleiding', 'Opleiding met BEV', 'OPL')
        ) t(activity_id, name, official_name, official_name_short)
        WHERE activity_id IN (SELECT activity_id FROM planned)""",
    "employee": """
        SELECT c_custkey AS employee_id,
               CASE WHEN c_custkey % 5 = 4 THEN DATE '2023-06-30' END AS valid_to,
               CASE WHEN c_custkey % 11 = 3 THEN '' WHEN c_custkey % 11 = 5 THEN 'Y'
                    WHEN c_custkey % 11 <> 7 THEN CAST(c_custkey AS VARCHAR) END AS personnel_number,
               c_mktsegment AS last_name,
               CASE WHEN c_custkey % 37 <> 36 THEN 'N' || c_nationkey END AS first_name,
               'Street ' || c_custkey AS address, CAST(1000 + c_nationkey AS VARCHAR) AS zip_code,
               'City ' || c_nationkey AS city,
               CASE WHEN c_custkey % 31 = 30 THEN c_name
                    WHEN c_custkey % 29 <> 28 THEN c_name || '@mail.example' END AS email,
               CASE WHEN c_nationkey % 3 = 0 THEN 'Lead' ELSE 'Agent' END AS position,
               DATE '2020-02-01' AS start_date,
               CASE WHEN c_custkey % 43 = 42 THEN DATE '2023-12-31'
                    WHEN c_custkey % 43 = 41 THEN DATE '2024-06-30' END AS end_date
        FROM customer""",
    "date_dim": "SELECT DISTINCT CAST(ts AS DATE) AS full_date FROM events",
    "overrides": """
        SELECT DISTINCT user_id AS person_id, CAST(ts AS DATE) AS day
        FROM events WHERE user_id % 25 = 0 AND day(ts) IN (3, 10, 17)""",
}

_ENRICH = {
    "workdays": f"""
        SELECT employee_id, count(*) AS planned_workdays
        FROM (SELECT DISTINCT employee_id, shift_start_date FROM planned
              WHERE shift_start_date BETWEEN {_FROM} AND {_TO})
        GROUP BY employee_id""",
    "profile": """
        SELECT DISTINCT coalesce(personnel_number, '') AS register_number, last_name, first_name,
               last_name || ', ' || first_name AS full_name, address, zip_code,
               city AS residence, start_date AS hire_date,
               coalesce(end_date, DATE '2099-12-31') AS stop_date,
               CASE WHEN contains(email, '@') THEN split_part(email, '@', 1)
                    WHEN email IS NOT NULL THEN '' END AS employee_login,
               employee_id, employee_id AS person_id, position AS job_function
        FROM employee WHERE valid_to IS NULL""",
    "shifts": f"""
        SELECT DISTINCT
               coalesce(start_time, CAST(shift_start_date AS TIMESTAMP)) AS start_time,
               coalesce(end_time, CAST(shift_end_date AS TIMESTAMP)) AS end_time,
               shift_start_date, coalesce(shift_start_second, 0) AS shift_start_second,
               shift_end_date, coalesce(shift_end_second, 0) AS shift_end_second,
               scheduled_time, scheduled_paid_time,
               CASE WHEN official_name = 'Feestdag' THEN 8 ELSE scheduled_absence_time END
                   AS scheduled_absence_time,
               CASE WHEN is_homeworking = 1 AND official_name = 'Prestatie' THEN 'Homeworking'
                    ELSE name END AS scheduled_activity,
               CASE WHEN is_homeworking = 1 AND official_name = 'Prestatie' THEN 'Homeworking'
                    ELSE official_name END AS activity_group,
               employee_id, coalesce(is_absence, 0) AS is_absence_time,
               coalesce(is_bank_holiday, 0) AS is_holiday,
               CASE WHEN is_homeworking = 1 AND official_name = 'Prestatie' THEN '1020'
                    ELSE official_name_short END AS performance_code,
               CASE WHEN coalesce(is_break_split, 0) = 0 THEN 'No' ELSE 'Yes' END AS break_split_shift,
               organization, interim_office, employment_place, type_shift, contract_name,
               contract_name_short, contract_day_max, contract_week_max, time_type, weekday_name,
               coalesce(is_homeworking, 0) AS is_homeworking
        FROM planned LEFT JOIN activity USING (activity_id)
        WHERE shift_start_date BETWEEN {_WIDE_FROM} AND {_WIDE_TO}
          AND employee_id IN (SELECT employee_id FROM employee WHERE valid_to IS NULL)""",
    "enriched": f"""
        SELECT shifts.*, profile.* EXCLUDE (employee_id), planned_workdays,
               scheduled_paid_time + scheduled_absence_time AS scheduled_total_time
        FROM shifts JOIN profile USING (employee_id) LEFT JOIN workdays USING (employee_id)
        WHERE stop_date > {_WIDE_FROM}""",
}

_SESSIONS = {
    "numbered": f"""
        SELECT * EXCLUDE (scheduled_time),
               row_number() OVER (PARTITION BY full_name ORDER BY {_ORDER_BY}) AS register_row_nr,
               row_number() OVER (ORDER BY {_ORDER_BY}) AS row_nr
        FROM enriched""",
    "kept": """
        SELECT * FROM numbered
        WHERE scheduled_activity IS NULL OR scheduled_activity NOT IN ('Lunch', 'Unavailable/Off')""",
    "gaps": """
        SELECT *, coalesce(date_diff('minute', lag(end_time) OVER (PARTITION BY employee_id
                   ORDER BY row_nr), start_time), 0) AS new_shift_minutes
        FROM kept""",
    "sessions": """
        SELECT *, CASE WHEN new_shift_minutes > 240 THEN 1 ELSE 0 END AS new_shift,
               date_diff('day', shift_start_date, shift_end_date) AS days_diff
        FROM gaps""",
    "grouped": "SELECT *, sum(new_shift) OVER (ORDER BY row_nr) AS gr FROM sessions",
}

_KEEP = """
    ((activity_group NOT IN ('Feestdag') AND coalesce(last_end_hour, '23:59:59') <> '23:30:00'
      AND coalesce(first_start_hour, '23:59:59') <> '00:00:00')
     OR (activity_group IN ('Feestdag') AND coalesce(last_end_hour, '23:59:59') = '00:00:00'
      AND coalesce(first_start_hour, '23:59:59') = '00:00:00'))"""
_HOURS_TEXT = """
    strftime(first_start_time, '%H:%M:%S') AS first_start_hour,
    strftime(last_end_time, '%H:%M:%S') AS last_end_hour,
    strftime(first_start_time, '%H:%M:%S') || ' - ' || strftime(last_end_time, '%H:%M:%S')
        AS day_first_last_hour"""

_ENVELOPES = {
    "night_keys": "SELECT DISTINCT date_key, employee_id, type_shift FROM planned",
    "nln": """
        SELECT employee_id, CAST(strptime(date_key, '%Y%m%d') AS DATE) AS key_day
        FROM night_keys WHERE type_shift = 'NLN'""",
    "day_rows": f"""
        SELECT *, 'LN' AS night_shift FROM (
            SELECT g.*, s.first_start_time, e.last_end_time, {_HOURS_TEXT}
            FROM grouped g
            LEFT JOIN (SELECT min(start_time) AS first_start_time, employee_id, gr,
                              CAST(start_time AS DATE) AS sd
                       FROM grouped GROUP BY ALL) s
              ON g.employee_id = s.employee_id AND g.gr = s.gr AND CAST(g.start_time AS DATE) = s.sd
            LEFT JOIN (SELECT max(end_time) AS last_end_time, employee_id, gr,
                              CAST(end_time AS DATE) AS sd
                       FROM grouped GROUP BY ALL) e
              ON g.employee_id = e.employee_id AND g.gr = e.gr AND CAST(g.end_time AS DATE) = e.sd)
        WHERE {_KEEP}""",
    "night_rows": f"""
        SELECT *, 'NLN' AS night_shift FROM (
            SELECT g.*, s.first_start_time, e.last_end_time, {_HOURS_TEXT}
            FROM grouped g
            LEFT JOIN (SELECT min(start_time) AS first_start_time, employee_id, gr
                       FROM grouped JOIN nln USING (employee_id)
                       WHERE CAST(start_time AS DATE) BETWEEN key_day - 1 AND key_day + 1
                       GROUP BY employee_id, gr) s USING (employee_id, gr)
            LEFT JOIN (SELECT max(end_time) AS last_end_time, employee_id, gr
                       FROM grouped JOIN nln USING (employee_id)
                       WHERE CAST(end_time AS DATE) BETWEEN key_day AND key_day + 1
                       GROUP BY employee_id, gr) e USING (employee_id, gr))
        WHERE {_KEEP} AND employee_id IN (SELECT employee_id FROM nln)""",
    "combined": """
        SELECT * FROM (SELECT * FROM day_rows UNION SELECT * FROM night_rows)
        WHERE NOT (night_shift = 'LN' AND employee_id IN (SELECT employee_id FROM nln))""",
}


def _trim(source: str, wide_from: str, wide_to: str) -> str:
    return f"""
        SELECT * FROM {source}
        WHERE coalesce(CAST(first_start_time AS DATE) <> {wide_from}, true)
          AND NOT coalesce(shift_start_date BETWEEN {wide_to} - 1 AND {wide_to}
                           AND CAST(first_start_time AS DATE) <> {wide_to} - 1
                           AND shift_end_date <> {wide_to} - 1, false)"""


def _clock(column: str) -> str:
    return f"(hour({column}) * 3600 + minute({column}) * 60 + second({column}))"


_S, _E = _clock("start_time"), _clock("end_time")
_WHOLE = "date_diff('second', start_time, end_time)"
_DROPPED = (
    "type_shift, contract_name, contract_name_short, contract_day_max, contract_week_max, "
    "is_homeworking, night_shift"
)

_HOURS = {
    "trimmed": _trim("combined", _WIDE_FROM, _WIDE_TO),
    "flex": f"""
        SELECT *,
          CAST(CASE WHEN shift_start_second < 72000 AND shift_end_second > 0
                AND dayname(shift_start_date) = 'Saturday' AND is_holiday <> 1
               THEN (CASE WHEN {_E} > 72000 THEN 72000 ELSE {_E} END - {_S}) / 3600.0 ELSE 0 END AS DECIMAL(27,11))
            AS flex_saturday_hours,
          CAST(CASE WHEN shift_start_second < 79200 AND shift_end_second > 72000
                AND dayname(shift_start_date) = 'Saturday' AND is_holiday <> 1
               THEN (CASE WHEN shift_end_date > shift_start_date THEN 72000
                          WHEN shift_end_second >= 79200 THEN 79200 ELSE shift_end_second END
                     - CASE WHEN shift_start_second <= 72000 THEN 72000 ELSE shift_start_second END)
                    / 3600.0 ELSE 0 END AS DECIMAL(27,11))
            AS flex_evening_saturday_hours,
          CAST(CASE WHEN shift_start_second < 86399 AND shift_end_second > 79200
                AND dayname(shift_start_date) <> 'Sunday' AND is_holiday <> 1
               THEN (CASE WHEN {_E} < 86399 THEN {_E} ELSE 86399 END
                     - CASE WHEN {_S} < 79200 THEN 79200 ELSE {_S} END) / 3600.0 ELSE 0 END AS DECIMAL(27,11))
            AS flex_evening_work_saturday_hours,
          CAST(CASE WHEN shift_start_second < 79200 AND shift_end_second > 72000
                AND dayname(shift_start_date) NOT IN ('Saturday', 'Sunday') AND is_holiday <> 1
               THEN (CASE WHEN {_E} > 79199 THEN 79200 ELSE {_E} END
                     - CASE WHEN {_S} < 72000 THEN 72000 ELSE {_S} END) / 3600.0 ELSE 0 END AS DECIMAL(27,11))
            AS flex_evening_workday_hours,
          CAST(CASE WHEN dayname(shift_start_date) = 'Sunday' THEN {_WHOLE} / 3600.0 ELSE 0 END AS DECIMAL(27,11))
            AS flex_sunday_hours,
          CAST(CASE WHEN is_holiday = 1
                AND activity_group IN ('Prestatie', 'Homeworking', 'Opleiding met BEV')
               THEN {_WHOLE} / 3600.0 ELSE 0 END AS DECIMAL(27,11))
            AS flex_holiday_hours
        FROM trimmed WHERE time_type <> 'NightAgent'""",
    "night_hours": """
        SELECT *, CAST(date_diff('minute', start_time, end_time) / 60.0 AS DECIMAL(18,6))
            AS night_agent_hours
        FROM trimmed WHERE time_type = 'NightAgent'""",
    "defaulted": f"""
        SELECT *, scheduled_total_time - coalesce({' + '.join(FLEX_COLUMNS)}, 0) AS default_hours
        FROM flex""",
    "hours": f"""
        SELECT * EXCLUDE ({_DROPPED})
               REPLACE (CAST(first_start_time AS DATE) AS shift_start_date, NULL AS is_holiday),
               {', '.join(f'NULL AS {c}' for c in [*FLEX_COLUMNS, 'default_hours'])}
        FROM night_hours
        UNION BY NAME
        SELECT * EXCLUDE ({_DROPPED})
               REPLACE (CAST(first_start_time AS DATE) AS shift_start_date),
               NULL AS night_agent_hours
        FROM defaulted""",
}

_PERSON_COLUMNS = (
    "register_number, last_name, first_name, full_name, interim_office, organization, address, "
    "zip_code, residence, hire_date, planned_workdays, is_absence_time, stop_date, employee_login, "
    "employee_id, person_id, job_function, break_split_shift, employment_place, time_type"
)
_FLIP = ", ".join(map(str, SETTINGS.flip_persons))
_EXEMPT = ", ".join(map(str, SETTINGS.exempt_persons))

_SICKNESS = {
    "calendar": f"""
        SELECT DISTINCT s.person_id, d.full_date, s.start_month, s.end_month
        FROM date_dim d JOIN (
            SELECT person_id, max(shift_start_date) AS end_month,
                   CAST(min(date_trunc('month', shift_start_date)) AS DATE) AS start_month
            FROM hours WHERE {_SICK} GROUP BY person_id) s
          ON d.full_date BETWEEN s.start_month AND s.end_month""",
    "templates": f"""
        SELECT DISTINCT {_PERSON_COLUMNS}, scheduled_activity, activity_group, performance_code
        FROM hours WHERE {_SICK}""",
    "missing": f"""
        SELECT t.* REPLACE (
                 CASE WHEN t.person_id IN ({_FLIP})
                      THEN max(t.scheduled_activity) OVER (PARTITION BY t.person_id)
                      ELSE min(t.scheduled_activity) OVER (PARTITION BY t.person_id) END
                   AS scheduled_activity,
                 CASE WHEN t.person_id IN ({_FLIP})
                      THEN max(t.activity_group) OVER (PARTITION BY t.person_id)
                      ELSE min(t.activity_group) OVER (PARTITION BY t.person_id) END AS activity_group,
                 CASE WHEN t.person_id IN ({_FLIP})
                      THEN min(t.performance_code) OVER (PARTITION BY t.person_id)
                      ELSE max(t.performance_code) OVER (PARTITION BY t.person_id) END
                   AS performance_code),
               CAST(c.full_date || ' 08:00:00' AS TIMESTAMP) AS start_time,
               CAST(c.full_date || ' 16:30:00' AS TIMESTAMP) AS end_time,
               c.full_date AS shift_start_date, 28800 AS shift_start_second,
               c.full_date AS shift_end_date, 59400 AS shift_end_second,
               CAST(0 AS DECIMAL(19,6)) AS scheduled_paid_time,
               CAST(0 AS DECIMAL(19,6)) AS scheduled_absence_time,
               CAST(0 AS DECIMAL(19,6)) AS scheduled_total_time,
               1 AS register_row_nr, 1 AS row_nr, 1 AS gr, 0 AS is_holiday,
               0 AS new_shift_minutes, 0 AS new_shift, 0 AS days_diff,
               '08:00:00 - 16:30:00' AS day_first_last_hour, dayname(c.full_date) AS weekday_name,
               {', '.join(f'0 AS {name}' for name in HOUR_COLUMNS)}
        FROM calendar c
        LEFT JOIN (SELECT * FROM hours WHERE {_SICK}) h
          ON c.person_id = h.person_id AND c.full_date = h.shift_start_date
        JOIN templates t ON c.person_id = t.person_id
        WHERE h.person_id IS NULL""",
    "filled": "SELECT * FROM hours UNION ALL BY NAME SELECT * FROM missing",
    "two_codes": """
        SELECT shift_start_date, person_id
        FROM (SELECT DISTINCT shift_start_date, person_id, performance_code, weekday_name
              FROM filled WHERE weekday_name NOT IN ('Saturday', 'Sunday'))
        GROUP BY shift_start_date, person_id HAVING count(*) >= 2""",
    "sick_values": f"""
        SELECT DISTINCT f.shift_start_date, f.person_id, f.performance_code, f.weekday_name,
               CASE WHEN o.person_id IS NOT NULL THEN 0
                    WHEN f.scheduled_total_time = 0 AND f.scheduled_activity <> 'Off Day' THEN 8
                    ELSE f.scheduled_total_time END AS new_total
        FROM filled f
        LEFT JOIN overrides o ON f.person_id = o.person_id AND f.shift_start_date = o.day
        WHERE f.weekday_name NOT IN ('Saturday', 'Sunday') AND f.person_id NOT IN ({_EXEMPT})
          AND {_SICK.replace('performance_code', 'f.performance_code')}
          AND NOT EXISTS (SELECT 1 FROM two_codes t WHERE t.person_id = f.person_id
                          AND t.shift_start_date = f.shift_start_date)""",
    "sick_set": """
        SELECT f.* REPLACE (CASE WHEN v.person_id IS NOT NULL THEN v.new_total
                                 ELSE f.scheduled_total_time END AS scheduled_total_time)
        FROM filled f LEFT JOIN sick_values v
          ON f.person_id = v.person_id AND f.shift_start_date = v.shift_start_date
         AND f.performance_code = v.performance_code""",
    "worked": """
        SELECT * FROM sick_set WHERE scheduled_activity IS NULL OR scheduled_activity <> 'Off Day'""",
}

_FINAL = {
    "cleaned": f"""
        SELECT * REPLACE ({', '.join(
            f'CASE WHEN {c} < 0.0001 OR {c} IS NULL THEN 0 ELSE {c} END AS {c}'
            for c in HOUR_COLUMNS)})
        FROM worked""",
    "login_days": """
        SELECT employee_login, count(*) AS total_workdays
        FROM (SELECT DISTINCT employee_login, CAST(first_start_time AS DATE) FROM cleaned
              WHERE activity_group = 'Prestatie' AND employee_login <> '')
        GROUP BY employee_login""",
    "final": """
        SELECT c.*, d.total_workdays
        FROM cleaned c LEFT JOIN login_days d ON c.employee_login = d.employee_login""",
}


def _snap(column: str) -> str:
    steps = " ".join(
        f"WHEN {column} BETWEEN {n - 1}.99 AND {n}.00 THEN CAST({n} AS DECIMAL(38,6))" for n in range(1, 14)
    )
    return f"CASE {steps} ELSE CAST({column} AS DECIMAL(38,6)) END"


_FACT = {
    "summed": """
        SELECT CASE WHEN register_number = '' OR coalesce(register_number, 'Y') = 'Y' THEN 'NoNr'
                    ELSE register_number END AS register_number,
               shift_start_date, performance_code, scheduled_activity, person_id, first_name,
               last_name, employee_login, sum(CAST(scheduled_total_time AS DECIMAL(18,6))) AS hours
        FROM final WHERE lower(interim_office) LIKE 'vast%' GROUP BY ALL""",
    "fact": f"""
        SELECT * EXCLUDE (hours), {_snap('hours')} AS scheduled_total_time FROM summed""",
}

_REFERENCE = """CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 <> 0
                     THEN c_nationkey || '-' || (c_custkey % 4) END"""

_MAPPED = {
    "mapping_view": f"""
        SELECT {_REFERENCE} AS external_reference,
               CASE WHEN c_custkey % 23 <> 0 THEN c_custkey END AS agreement_number, c_name AS login
        FROM customer""",
    "mapped": """
        SELECT external_reference, shift_start_date AS day, performance_code, agreement_number,
               person_id, login, first_name, last_name, sum(scheduled_total_time) AS hours
        FROM fact JOIN mapping_view ON employee_login = login
        WHERE shift_start_date >= (SELECT min(shift_start_date) FROM fact)
        GROUP BY ALL""",
}

_ORDER_MAPPED = {
    "mapped": f"""
        SELECT {_REFERENCE} AS external_reference, CAST(o_orderdate AS DATE) AS day,
               CASE o_orderpriority WHEN '1-URGENT' THEN '4503' WHEN '2-HIGH' THEN '0100'
                    WHEN '3-MEDIUM' THEN '1020' WHEN '4-NOT SPECIFIED' THEN '0050' ELSE '3523' END
                   AS performance_code,
               CASE WHEN c_custkey % 23 <> 0 THEN c_custkey END AS agreement_number,
               c_custkey AS person_id, c_name AS login, CAST(c_nationkey AS VARCHAR) AS first_name,
               c_mktsegment AS last_name, sum(CAST((o_orderkey % 800) / 100.0 AS DECIMAL(18,6))) AS hours
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
}

_RECODE = {
    "doubles": """
        SELECT external_reference, day FROM mapped WHERE performance_code IN ('0100', '1020')
        GROUP BY external_reference, day HAVING count(*) >= 2""",
    "recoded": """
        SELECT m.* REPLACE (CASE WHEN TRY_CAST(m.performance_code AS INT) = 100
                                  AND d.external_reference IS NOT NULL THEN '1020'
                                 ELSE m.performance_code END AS performance_code)
        FROM mapped m LEFT JOIN doubles d
          ON m.external_reference = d.external_reference AND m.day = d.day""",
}


def _bridge(source: str, last_day: str) -> dict[str, str]:
    ties = ("performance_code, T1.external_reference, T1.day, agreement_number, person_id, login, "
            "first_name, last_name, hours")
    window = (
        "(PARTITION BY T2.external_reference ORDER BY T2.day NULLS FIRST, "
        + ", ".join(f"{name.strip()} NULLS FIRST" for name in ties.split(","))
        + ")"
    )
    code = " ".join(
        f"WHEN lag_code = '{c}' OR lead_code = '{c}' THEN '{c}'" for c in BRIDGE_PRIORITY
    )
    return {
        "spine": f"""
            SELECT CAST(unnest(generate_series(min(day), {last_day}, INTERVAL 1 DAY)) AS DATE) AS day
            FROM {source}""",
        "calendar_days": f"""
            SELECT external_reference, spine.day
            FROM (SELECT external_reference FROM {source} GROUP BY external_reference) CROSS JOIN spine""",
        "neighbours": f"""
            SELECT coalesce(T1.external_reference, T2.external_reference) AS external_reference,
                   coalesce(T1.day, T2.day) AS day, T1.performance_code, hours, agreement_number,
                   person_id, login, first_name, last_name,
                   coalesce(lag(T1.performance_code, 1) OVER {window},
                            lag(T1.performance_code, 2) OVER {window}) AS lag_code,
                   coalesce(lead(T1.performance_code, 1) OVER {window},
                            lead(T1.performance_code, 2) OVER {window}) AS lead_code
            FROM {source} T1 FULL JOIN calendar_days T2
              ON T1.day = T2.day AND T1.external_reference = T2.external_reference""",
        "bridgeable": f"""
            SELECT * FROM neighbours
            WHERE NOT coalesce(performance_code IS NULL
                AND (lag_code NOT IN ({_GAPS}) OR lead_code NOT IN ({_GAPS})), false)""",
        "bridged": f"""
            SELECT 'EMP00000001' AS prefix, external_reference, day,
                   coalesce(performance_code, CASE {code} END) AS performance_code,
                   agreement_number, person_id, login, first_name, last_name, sum(hours) AS hours,
                   right(CAST(CAST(round(sum(hours), 2) * 100 + 10000 AS BIGINT) AS VARCHAR), 4) AS hours_text
            FROM bridgeable
            GROUP BY external_reference, day, coalesce(performance_code, CASE {code} END),
                     agreement_number, person_id, login, first_name, last_name""",
    }


_STAGING = {
    "identities": """
        SELECT external_reference, agreement_number AS a, person_id AS p, login AS l,
               first_name AS f, last_name AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY external_reference
                ORDER BY agreement_number, person_id NULLS FIRST, login NULLS FIRST,
                         first_name NULLS FIRST, last_name NULLS FIRST) AS rn
              FROM bridged WHERE agreement_number IS NOT NULL)
        WHERE rn = 1""",
    "backfilled": """
        SELECT b.* REPLACE (
            CASE WHEN b.agreement_number IS NULL AND i.a IS NOT NULL THEN i.a ELSE b.agreement_number END
                AS agreement_number,
            CASE WHEN b.agreement_number IS NULL AND i.a IS NOT NULL THEN i.p ELSE b.person_id END AS person_id,
            CASE WHEN b.agreement_number IS NULL AND i.a IS NOT NULL THEN i.l ELSE b.login END AS login,
            CASE WHEN b.agreement_number IS NULL AND i.a IS NOT NULL THEN i.f ELSE b.first_name END AS first_name,
            CASE WHEN b.agreement_number IS NULL AND i.a IS NOT NULL THEN i.n ELSE b.last_name END AS last_name)
        FROM bridged b LEFT JOIN identities i ON b.external_reference = i.external_reference""",
    "staging": """
        SELECT * FROM backfilled
        WHERE day >= date_trunc('month', DATE '2024-01-17') - INTERVAL 1 MONTH""",
}

_IDENTITY = {
    "employee_view": """
        SELECT c_name AS login,
               CASE WHEN c_custkey % 13 = 0 THEN 'X' || c_custkey
                    ELSE CAST(c_custkey AS VARCHAR) END AS personnel_number,
               CASE WHEN c_custkey % 21 = 0 THEN -1 ELSE c_custkey END AS employee_id
        FROM customer""",
    "employee_versions": """
        SELECT CASE WHEN c_custkey % 21 = 0 THEN -1 ELSE c_custkey END AS employee_id,
               c_custkey + 100000 AS employee_key FROM customer
        UNION ALL
        SELECT c_custkey, c_custkey + 200000 FROM customer WHERE c_custkey % 6 = 0""",
    "identity": """
        SELECT DISTINCT v.login, TRY_CAST(v.personnel_number AS INT) AS agreement_number,
               e.employee_key AS person_id
        FROM employee_view v JOIN employee_versions e ON v.employee_id = e.employee_id
        WHERE e.employee_id <> -1""",
}

_FLAG = f"""
    CASE WHEN month(load_date) - month({_MAPPING_AS_OF}) = 0 THEN 'CurrentMonth'
         WHEN month(load_date) - month({_MAPPING_AS_OF}) = -1 THEN 'PrevMonth' ELSE 'Older' END"""

_REFRESH = {
    "current_mapping": """
        SELECT o_orderpriority AS name, CAST(o_orderkey AS VARCHAR) AS external_reference,
               o_custkey AS agreement_number, o_custkey + 100000 AS person_id, c_name AS login,
               CAST(o_orderdate AS DATE) AS load_date
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "flagged": f"SELECT *, {_FLAG} AS month_flag FROM current_mapping",
    "incoming": f"""
        SELECT CASE WHEN c_custkey % 29 <> 0 THEN c_name END AS name,
               {_REFERENCE} AS external_reference,
               CASE WHEN c_custkey % 23 <> 0 THEN c_custkey - c_custkey % 3 END AS agreement_number
        FROM customer""",
    "fresh": f"""
        SELECT name, external_reference, agreement_number, person_id, login,
               {_MAPPING_AS_OF} AS load_date, 'CurrentMonth' AS month_flag
        FROM (SELECT i.*, t.login, t.person_id,
                     row_number() OVER (PARTITION BY i.agreement_number ORDER BY
                        i.external_reference NULLS FIRST, i.name NULLS FIRST, t.login NULLS FIRST,
                        t.person_id NULLS FIRST) AS rn
              FROM incoming i LEFT JOIN identity t ON i.agreement_number = t.agreement_number
              WHERE i.name IS NOT NULL)
        WHERE rn = 1""",
    "refreshed": """
        SELECT * FROM flagged WHERE month_flag <> 'CurrentMonth'
        UNION ALL BY NAME SELECT * FROM fresh""",
}

_DAY_KEYS = """register_number AS "RR", last_name AS "Naam", first_name AS "Voornaam",
    interim_office AS "Temp kantoor", shift_start_date AS "Datum", break_split_shift AS "BreakSplitShift" """
_DAY_HOURS = f"""
    SELECT {_DAY_KEYS},
           sum(CAST(scheduled_total_time AS DECIMAL(18,6))) AS "Gepresteerde Uren",
           sum(flex_saturday_hours) AS "FlexSaturdayHours", sum(flex_sunday_hours) AS "FlexSundayHours",
           sum(flex_evening_workday_hours) AS "FlexEveningWorkDayHours",
           sum(flex_evening_saturday_hours) AS "FlexEveningSaturdayHours",
           sum(flex_evening_work_saturday_hours) AS "FlexEveningWorkSaturdayHours",
           sum(flex_holiday_hours) AS "FlexHolidayHours", sum(night_agent_hours) AS "NightAgentHours",
           sum(default_hours) AS "DefaultHours"
    FROM final
    GROUP BY register_number, last_name, first_name, interim_office, shift_start_date, break_split_shift"""
_GROUP_LIST = ", ".join(f"'{group}'" for group in ABSENCE_GROUPS)
_ABSENCES = {
    "snapped": f"""
        SELECT activity_group, register_number AS "RR", shift_start_date AS "Datum",
               {_snap('CAST(scheduled_total_time AS DECIMAL(18,6))')} AS hours
        FROM final WHERE activity_group <> 'Prestatie' AND register_number <> ''""",
    "absences": f"""
        SELECT "RR", "Datum",
               coalesce(sum(hours) FILTER (activity_group IN ({_GROUP_LIST})
                                           AND activity_group <> 'Educatief verlof'), 0) AS "Afwezige uren",
               {', '.join(f"coalesce(sum(hours) FILTER (activity_group = '{g}'), 0) AS "
                          + chr(34) + g + chr(34) for g in ABSENCE_GROUPS)}
        FROM snapped GROUP BY "RR", "Datum" """,
}
_ABSENCE_COLUMNS = ["Afwezige uren", *ABSENCE_GROUPS]
_PERSON_NAME = "last_name || ',' || first_name"

_TO_FINAL = {**_INPUTS, **_ENRICH, **_SESSIONS, **_ENVELOPES, **_HOURS, **_SICKNESS, **_FINAL}
_TO_FACT = {**_TO_FINAL, **_FACT}
_TO_RECODED = {**_TO_FACT, **_MAPPED, **_RECODE}
_TO_STAGING = {**_TO_RECODED, **_bridge("recoded", "DATE '2024-01-31'"), **_STAGING}
_ORDER_DENSE = {**_ORDER_MAPPED, **_bridge("mapped", "DATE '2001-03-31'")}

_SUNDAY = "(d - CAST(dayofweek(d) AS INT))"
_MONDAY = "(DATE '1900-01-01' + CAST(date_diff('day', DATE '1900-01-01', d) // 7 * 7 + 7 AS INT))"


def _month(shift: int) -> str:
    return f"CAST(date_trunc('month', d) + INTERVAL ({shift}) MONTH AS DATE)"


_SPANS = {
    "PW": (f"{_SUNDAY} - 6", _SUNDAY),
    "CW": (f"{_SUNDAY} + 1", f"{_SUNDAY} + 7"),
    "NW": (_MONDAY, f"{_MONDAY} + 6"),
    "PM": (_month(-1), f"{_month(0)} - 1"),
    "P2M": (_month(-2), f"{_month(1)} - 2"),
    "C2M": (_month(-1), f"{_month(1)} - 1"),
    "CM": (_month(0), f"{_month(1)} - 1"),
    "NM": (_month(1), f"{_month(2)} - 1"),
}
_DATE_SPANS = " UNION ALL ".join(
    f"""SELECT '{code}{suffix}' AS code, d AS as_of, {start} AS from_date, {end} AS to_date,
               {start} - 1 AS wide_from, {end} + 1 AS wide_to
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""
    for code, (start, end) in _SPANS.items()
    for suffix in ("", "c")
)

# An hour each, the first from 16:00:01; bands 15 and 16 end a second late.
_BANDS = """
    SELECT format('{:02d}:00:01', (15 + i) % 24) AS hour_start,
           format('{:02d}:00:{:02d}', (16 + i) % 24, CASE WHEN i IN (15, 16) THEN 1 ELSE 0 END) AS hour_end,
           i AS shift_order
    FROM range(1, 25) AS t(i)"""
_SHIFT_BANDS = {
    **_INPUTS,
    "bands": _BANDS,
    "clocks": "SELECT strftime(coalesce(start_time, CAST(shift_start_date AS TIMESTAMP)), '%H:%M:%S') AS clock FROM planned",
    "placed": """
        SELECT clock, min(shift_order) AS shift_order
        FROM clocks LEFT JOIN bands
          ON CASE WHEN shift_order = 8 THEN clock >= hour_start OR clock = '00:00:00'
                  ELSE clock BETWEEN hour_start AND hour_end END
        GROUP BY clock""",
    "counted": "SELECT shift_order, count(*) AS shifts FROM clocks JOIN placed USING (clock) GROUP BY shift_order",
}



def _lines(mapped_month: int) -> dict[str, str]:
    """Lines exported on 2024-02-10 for logins mapped in the given month."""
    return {
        **_TO_STAGING,
        "lines": f"""
            SELECT prefix || external_reference || '   ' || strftime(day, '%d/%m/%Y') || '  '
                   || right('0' || performance_code, 4) || '  '
                   || CASE WHEN TRY_CAST(hours_text AS INT) = 0 THEN ''
                           ELSE coalesce(hours_text, '   ') END AS line, day
            FROM staging
            WHERE external_reference <> '' AND month(day) = 1
              AND login IN (SELECT c_name FROM orders JOIN customer ON o_custkey = c_custkey
                            WHERE month(o_orderdate) = {mapped_month} AND c_name IS NOT NULL)""",
    }


# key: (common table expressions, final relation or query)
QUERIES: dict[str, tuple[dict[str, str], str]] = {
    "date_spans": ({}, _DATE_SPANS),
    "planned_workdays": ({**_INPUTS, **_ENRICH}, "SELECT * FROM workdays"),
    "shift_enriched": ({**_INPUTS, **_ENRICH}, "SELECT * FROM enriched"),
    "current_employees": ({**_INPUTS, **_ENRICH}, "SELECT * FROM profile"),
    "row_numbers": ({**_INPUTS, **_ENRICH, **_SESSIONS}, "SELECT * FROM numbered"),
    "shift_sessions": ({**_INPUTS, **_ENRICH, **_SESSIONS}, "SELECT * FROM sessions"),
    "shift_groups": ({**_INPUTS, **_ENRICH, **_SESSIONS}, "SELECT * FROM grouped"),
    "day_envelope": ({**_INPUTS, **_ENRICH, **_SESSIONS, **_ENVELOPES}, "SELECT * FROM day_rows"),
    "shift_bands": (
        _SHIFT_BANDS,
        "SELECT bands.*, coalesce(shifts, 0) AS shifts FROM bands LEFT JOIN counted USING (shift_order)",
    ),
    "night_keys": ({**_INPUTS, **_ENVELOPES}, "SELECT * FROM night_keys"),
    "night_envelope": ({**_INPUTS, **_ENRICH, **_SESSIONS, **_ENVELOPES}, "SELECT * FROM night_rows"),
    "combined_envelope": ({**_INPUTS, **_ENRICH, **_SESSIONS, **_ENVELOPES}, "SELECT * FROM combined"),
    # Edges of the week before the as-of date, on all shifts.
    "trimmed_edges": (
        {**_INPUTS, **_ENRICH, **_SESSIONS, **_ENVELOPES},
        _trim("combined", "DATE '2024-01-07'", "DATE '2024-01-15'"),
    ),
    "flex_hours": (_TO_FINAL, "SELECT * FROM flex"),
    "default_hours": (_TO_FINAL, "SELECT * FROM defaulted"),
    "night_agent_hours": (_TO_FINAL, "SELECT * FROM night_hours"),
    "hours_union": (_TO_FINAL, "SELECT * FROM hours"),
    "sick_calendar": (_TO_FINAL, "SELECT * FROM calendar"),
    "sick_fill": (
        _TO_FINAL,
        """SELECT *, NULL::TIMESTAMP AS first_start_time, NULL::TIMESTAMP AS last_end_time,
                  NULL::VARCHAR AS first_start_hour, NULL::VARCHAR AS last_end_hour FROM missing""",
    ),
    "sick_hours": (_TO_FINAL, "SELECT * FROM worked"),
    "clamped_hours": (_TO_FINAL, "SELECT * FROM cleaned"),
    "total_workdays": (_TO_FINAL, "SELECT * FROM final"),
    "performance_fact": (_TO_FACT, "SELECT * FROM fact"),
    "report_basis": (
        _TO_FINAL,
        """SELECT register_number AS "RegisterNumber", full_name AS "FullName",
                  substring(day_first_last_hour, 1, 5) || '-' || substring(day_first_last_hour, 12, 5)
                      AS "Day_FirstLastHour",
                  strftime(make_timestamp(shift_start_second * 1000000), '%H:%M') AS "ShiftStartHour",
                  strftime(make_timestamp(shift_end_second * 1000000), '%H:%M') AS "ShiftEndHour",
                  substring(first_start_hour, 1, 5) AS "FirstStartHour",
                  substring(last_end_hour, 1, 5) AS "LastEndHour",
                  coalesce(is_holiday, 0) AS "IsHoliDay", last_name AS "LastName",
                  first_name AS "FirstName", interim_office AS "InterimOffice",
                  organization AS "Organization", address AS "Address", zip_code AS "ZipCode",
                  residence AS "Residence", hire_date AS "HireDate", start_time AS "StartTime",
                  end_time AS "EndTime", shift_start_date AS "ShiftStartDate",
                  shift_end_date AS "ShiftEndDate", scheduled_paid_time AS "ScheduledPaidTime",
                  scheduled_absence_time AS "ScheduledAbsenceTime",
                  scheduled_total_time AS "ScheduledTotalTime",
                  scheduled_activity AS "ScheduledActivity", activity_group AS "ActivityGroup",
                  is_absence_time AS "IsAbsenceTime", stop_date AS "StopDate",
                  employee_login AS "EmployeeLogin", employee_id AS "EmployeeID",
                  person_id AS "PERSON_ID", register_row_nr AS "RegisterNumber_RowNr",
                  row_nr AS "RowNr", performance_code AS "PerformanceCode",
                  job_function AS "Function", gr AS "Gr", new_shift_minutes AS "NewShiftTime",
                  new_shift AS "NewShift", days_diff AS "DaysDiff",
                  first_start_time AS "FirstStartTime", last_end_time AS "LastEndTime",
                  time_type AS "TimeType", weekday_name AS "WeekDayName",
                  flex_saturday_hours AS "FlexSaturdayHours",
                  flex_evening_saturday_hours AS "FlexEveningSaturdayHours",
                  flex_evening_work_saturday_hours AS "FlexEveningWorkSaturdayHours",
                  flex_evening_workday_hours AS "FlexEveningWorkDayHours",
                  flex_sunday_hours AS "FlexSundayHours", flex_holiday_hours AS "FlexHoliDayHours",
                  default_hours AS "DefaultHours", night_agent_hours AS "NightAgentHours",
                  planned_workdays AS "PlannedWorkDays", total_workdays AS "TotalWorkDays",
                  break_split_shift AS "BreakSplitShift", employment_place AS "EmploymentPlace"
           FROM final""",
    ),
    "report_day_hours": (_TO_FINAL, _DAY_HOURS),
    "absence_pivot": ({**_TO_FINAL, **_ABSENCES}, "SELECT * FROM absences"),
    "report_long": (
        {**_TO_FINAL, **_ABSENCES, "day_hours": _DAY_HOURS},
        "SELECT d.*, "
        + ", ".join(f'coalesce(a."{c}", 0) AS "{c}"' for c in _ABSENCE_COLUMNS)
        + ' FROM day_hours d FULL JOIN absences a ON d."RR" = a."RR" AND d."Datum" = a."Datum"',
    ),
    "report_short": (
        _TO_FINAL,
        f"""SELECT * EXCLUDE (h, employment_place), {_snap('h')} AS "Aantal Werkuren"
            FROM (SELECT register_number AS "Rijksregisternummer", {_PERSON_NAME} AS "Naam, Voornaam",
                         organization AS "Project", job_function AS "Function",
                         interim_office AS "Temp kantoor", shift_start_date AS "Datum",
                         strftime(shift_start_date, '%d/%m/%Y') AS "Datum_",
                         break_split_shift AS "BreakSplitShift", first_start_hour AS "StartUur1",
                         last_end_hour AS "EindUur1", employment_place,
                         sum(CAST(scheduled_total_time AS DECIMAL(18,6))) AS h
                  FROM final GROUP BY ALL)""",
    ),
    "report_cumulative": (
        _TO_FINAL,
        f"""SELECT * EXCLUDE (h), {_snap('h')} AS "Aantal Werkuren",
                   {_WIDE_FROM} AS "FromDate", {_WIDE_TO} AS "ToDate"
            FROM (SELECT register_number AS "Rijksregisternummer", {_PERSON_NAME} AS "Naam, Voornaam",
                         organization AS "Project", job_function AS "Function",
                         employment_place AS "EmploymentPlace", interim_office AS "Temp kantoor",
                         sum(CAST(scheduled_total_time AS DECIMAL(18,6))) AS h
                  FROM final GROUP BY ALL)""",
    ),
    "employee_identity": (_IDENTITY, "SELECT * FROM identity"),
    "month_flags": (_REFRESH | _IDENTITY, "SELECT * FROM flagged"),
    "mapping_refresh": (_IDENTITY | _REFRESH, "SELECT * FROM refreshed"),
    "date_spine": (
        _ORDER_DENSE,
        "SELECT day, strftime(day, '%d/%m/%Y') AS day_text FROM spine",
    ),
    "mapped_performance": (_TO_RECODED, "SELECT * FROM mapped"),
    "recode_doubles": (_TO_RECODED, "SELECT * FROM recoded"),
    "recode_order_doubles": ({**_ORDER_MAPPED, **_RECODE}, "SELECT * FROM recoded"),
    "dense_calendar": (
        _ORDER_DENSE,
        """SELECT external_reference, day, performance_code, hours, agreement_number, person_id, login,
                  first_name, last_name, lag_code, lead_code FROM neighbours""",
    ),
    "bridged_gaps": (_TO_STAGING, "SELECT * FROM bridged"),
    "bridged_order_gaps": (_ORDER_DENSE, "SELECT * FROM bridged"),
    "identity_backfill": (_TO_STAGING, "SELECT * FROM staging"),
    "published_fact": (_TO_FACT, "SELECT * FROM fact"),
    "published_staging": (_TO_STAGING, "SELECT * FROM staging"),
    "payroll_lines": (_lines(2), "SELECT * FROM lines WHERE line IS NOT NULL"),
    "previous_lines": (_lines(1), "SELECT * FROM lines WHERE line IS NOT NULL"),
    "ordered_lines": (
        _lines(2),
        "SELECT line, row_number() OVER (ORDER BY line) AS place FROM lines WHERE line IS NOT NULL",
    ),
}
QUERIES["report_dispatch"] = (
    {
        **_TO_FINAL,
        **_ABSENCES,
        "day_hours": _DAY_HOURS,
        "basis": QUERIES["report_basis"][1],
        "long": QUERIES["report_long"][1],
        "short": QUERIES["report_short"][1],
        "cumulative": QUERIES["report_cumulative"][1],
        "modes": "SELECT unnest(['publish', 'basis', 'long', 'short']) AS mode",
        "codes": """
            SELECT code || suffix AS code
            FROM (SELECT unnest(['PW', 'CW', 'NW', 'PM', 'P2M', 'C2M', 'CM', 'NM']) AS code),
                 (SELECT unnest(['', 'c']) AS suffix)""",
        "sizes": " UNION ALL ".join(
            f"SELECT '{name}' AS report, count(*) AS rows, CAST(sum(\"{hours}\") AS DOUBLE) AS hours FROM {name}"
            for name, hours in (
                ("basis", "ScheduledTotalTime"), ("long", "Gepresteerde Uren"), ("short", "Aantal Werkuren"),
                ("cumulative", "Aantal Werkuren"),
            )
        ),
        "chosen": """
            SELECT mode, code,
                   CASE WHEN mode = 'publish' THEN NULL WHEN mode = 'basis' THEN 'basis'
                        WHEN code IN ('PWc', 'CWc', 'NWc', 'PMc', 'CMc', 'NMc') THEN 'cumulative'
                        ELSE mode END AS report
            FROM modes, codes""",
    },
    "SELECT mode, code, report, rows, hours FROM chosen LEFT JOIN sizes USING (report)",
)
