"""Vietnamese public holidays, the lunar ones included, as a small calendar.

Lunar months start on the local day of the astronomical new moon (Meeus' series, truncated; good to
minutes) in Vietnam's time zone. The month that holds the winter solstice is the 11th; where 13 months lie
between two of those, the first without a principal solar term is a leap month.
"""

from __future__ import annotations

import datetime as dt
import math

# Public holidays by solar date, and by lunar (month, day).
SOLAR = {"new_year": (1, 1), "reunification": (4, 30), "labour": (5, 1), "national": (9, 2)}
LUNAR = {"tet_1": (1, 1), "tet_2": (1, 2), "tet_3": (1, 3), "tet_4": (1, 4), "tet_5": (1, 5), "hung_kings": (3, 10)}
TET_EVE = "tet_eve"  # the day before lunar new year
NAMES = (*SOLAR, TET_EVE, *LUNAR)
ZONE = 7 / 24
LUNATION = 29.530588861
EPOCH = dt.date(2000, 1, 1).toordinal() - 2451544.5  # Julian day 2451544.5 is the start of 2000-01-01 UTC


def new_moon(k: int) -> float:
    """Julian day of the k-th new moon after that of January 2000."""
    t = k / 1236.85
    e = 1 - 0.002516 * t
    sun, moon, node = (math.radians(a + b * k) for a, b in ((2.5534, 29.1053567), (201.5643, 385.81693528), (160.7108, 390.67050284)))
    terms = ((-0.40720, moon), (0.17241 * e, sun), (0.01608, 2 * moon), (0.01039, 2 * node), (0.00739 * e, moon - sun),
             (-0.00514 * e, moon + sun), (0.00208 * e * e, 2 * sun), (-0.00111, moon - 2 * node), (-0.00057, moon + 2 * node),
             (0.00056 * e, 2 * moon + sun), (-0.00042, 3 * moon), (0.00042 * e, sun + 2 * node), (0.00038 * e, sun - 2 * node))
    return 2451550.09766 + LUNATION * k + 0.00015437 * t * t + sum(a * math.sin(x) for a, x in terms) - 65 / 86400


def solar_term(julian: float) -> int:
    """Which twelfth of the ecliptic the sun is in."""
    t = (julian - 2451545.0) / 36525
    m = math.radians(357.52911 + 35999.05029 * t)
    centre = (1.914602 - 0.004817 * t) * math.sin(m) + 0.019993 * math.sin(2 * m) + 0.000289 * math.sin(3 * m)
    longitude = 280.46646 + 36000.76983 * t + centre - 0.00569 - 0.00478 * math.sin(math.radians(125.04 - 1934.136 * t))
    return int(longitude % 360 // 30)


def _day(k: int) -> int:
    """Ordinal of the local day on which lunar month k starts."""
    return math.floor(new_moon(k) + ZONE + EPOCH)


def _term_on(ordinal: int) -> int:
    return solar_term(ordinal - EPOCH - ZONE)


def _month_11(year: int) -> int:
    """Index of the lunar month that holds the winter solstice of ``year``."""
    k = math.floor((dt.date(year, 12, 31).toordinal() - EPOCH - 2451550.09766) / LUNATION) + 1
    while _term_on(_day(k)) >= 9 or _day(k) > dt.date(year, 12, 31).toordinal():
        k -= 1
    return k


def lunar_months(year: int) -> dict[int, int]:
    """First day (ordinal) of the regular months 11, 12, 1, 2 ... 10 up to the 11th month of ``year``."""
    first, last = _month_11(year - 1), _month_11(year)
    leap = None
    if last - first == 13:
        leap = next(k for k in range(first + 1, last) if _term_on(_day(k)) == _term_on(_day(k + 1)))
    out, number = {}, 11
    for k in range(first, last):
        if k != leap:
            out[number] = _day(k)
            number = number % 12 + 1
    return out


def vietnamese_holidays(first: dt.date, last: dt.date) -> list[tuple[dt.date, str]]:
    """(day, name) of every holiday in ``[first, last]``, in order: about a dozen rows a year."""
    out = []
    for year in range(first.year, last.year + 1):
        out += [(dt.date(year, m, d), name) for name, (m, d) in SOLAR.items()]
        months = lunar_months(year)
        out.append((dt.date.fromordinal(months[1] - 1), TET_EVE))
        out += [(dt.date.fromordinal(months[m] + d - 1), name) for name, (m, d) in LUNAR.items()]
    return sorted(x for x in out if first <= x[0] <= last)
