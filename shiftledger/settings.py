"""Business settings. Person- and employer-specific values have no default."""

from __future__ import annotations

from dataclasses import dataclass

# Activity names, groups and payroll codes used by the rules.
DROPPED_ACTIVITIES = ("Lunch", "Unavailable/Off")
OFF_DAY = "Off Day"
HOLIDAY_GROUP = "Feestdag"
WORK_GROUP = "Prestatie"
HOME_GROUP = "Homeworking"
WORK_CODE = "0100"
HOME_CODE = "1020"
NIGHT_TIME_TYPE = "NightAgent"
HOLIDAY_PAY_GROUPS = ("Prestatie", "Homeworking", "Opleiding met BEV")
SICK_CODES = (4503, 3523)
GAP_CODES = ("0050", "0359", "3031", "4503", "3523", "0353", "0250")
BRIDGE_PRIORITY = ("0050", "0250", "0359", "3031", "3523", "0353", "4503")
ABSENCE_GROUPS = (
    "Feestdag",
    "Ziek",
    "ADV",
    "vakantie",
    "Ongewettigd afwezig",
    "Bevallingsverlof",
    "Educatief verlof",
    "Familiaal verlof",
    "Klein Verlet",
    "Langdurig ziek",
    "Ouderschapsverlof",
)
# Pivoted, but not part of the absence total.
ABSENCE_NOT_TOTALLED = ("Educatief verlof",)


@dataclass(frozen=True)
class Settings:
    gap_minutes: int = 240
    dropped_activities: tuple[str, ...] = DROPPED_ACTIVITIES
    sick_codes: tuple[int, ...] = SICK_CODES
    # Persons whose filled sick days take max activity / min code instead of min / max.
    flip_persons: tuple[int, ...] = ()
    # Persons whose sick hours are left alone.
    exempt_persons: tuple[int, ...] = ()
    fact_office_prefix: str = "vast"
    gap_codes: tuple[str, ...] = GAP_CODES
    bridge_priority: tuple[str, ...] = BRIDGE_PRIORITY
    # Logins that differ in case only are the same login.
    ignore_login_case: bool = False
    # Employer id that opens every payroll line.
    line_prefix: str = ""
