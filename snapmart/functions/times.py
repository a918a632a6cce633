"""Epoch seconds, zones and rendered times.

Wall-clock values are TIMESTAMP_NTZ, so nothing here depends on the session
time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Years 1 to 9999.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799

DAY = "yyyy-MM-dd"
MINUTE = "yyyy-MM-dd'T'HH:mm"
SECOND = "yyyy-MM-dd HH:mm:ss"


def _in_range(epoch: Column) -> Column:
    return F.when(epoch.between(_FIRST_SECOND, _LAST_SECOND), epoch)


def instant(epoch: Column) -> Column:
    """Epoch seconds to TIMESTAMP; 0, NULL and impossible values give NULL."""
    return F.timestamp_seconds(_in_range(F.nullif(epoch, F.lit(0))))


def wall_clock(epoch: Column, zone: str = "UTC") -> Column:
    """Epoch seconds to the local TIMESTAMP_NTZ of a zone (0 is a valid time)."""
    seconds = _in_range(epoch).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds
    )
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_seconds(moment: Column) -> Column:
    """TIMESTAMP_NTZ (read as UTC) to whole epoch seconds."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, moment)


def local_text(epoch: Column, zone: str) -> Column:
    """Epoch seconds as 'yyyy-MM-dd HH:mm:ss' in a zone; '' for 0 or NULL."""
    return F.coalesce(
        F.date_format(wall_clock(F.nullif(epoch, F.lit(0)), zone), SECOND), F.lit("")
    )


def day_text(epoch: Column, zone: str = "UTC") -> Column:
    """Epoch seconds as 'yyyy-MM-dd'; 0 is 1970-01-01, NULL is ''."""
    return F.coalesce(F.date_format(wall_clock(epoch, zone), DAY), F.lit(""))


def iso_day(text: Column) -> Column:
    """The date part of an ISO date-time text."""
    return F.split_part(text, F.lit("T"), F.lit(1))


def hours_before(as_of: str | datetime, hours: float) -> str:
    """The text of ``as_of`` minus some hours."""
    moment = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    return (moment - timedelta(hours=hours)).isoformat(sep=" ")


def since(frame: DataFrame, column: str, as_of: str | datetime, hours: float) -> Column:
    """``column >= as_of - hours``, as a comparison the Parquet reader can use.

    The bound gets the column's own type (TIMESTAMP, TIMESTAMP_NTZ, DATE or
    fixed-width text), so the column itself is never cast.
    """
    return F.col(column) >= F.lit(hours_before(as_of, hours)).cast(frame.schema[column].dataType)


def as_utc_instant(moment: Column) -> Column:
    """TIMESTAMP_NTZ (read as UTC) to TIMESTAMP, to the microsecond."""
    zoned = F.convert_timezone(F.lit("UTC"), F.current_timezone(), moment)
    return zoned.cast("timestamp")
