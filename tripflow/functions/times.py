"""Wall-clock text <-> epoch seconds, independent of the session time zone.

Text that does not name a real calendar instant becomes NULL. A wall-clock time
that occurs twice (the autumn hour) takes the earlier instant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wall-clock text in raw segments (with the zone name appended),
# and ISO text with a numeric offset in trip lines.
WALL_CLOCK_ZONE = "yyyy-MM-dd HH:mm:ss VV"
ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ssZ"


def _zone(tz: Column | str) -> Column:
    return F.lit(tz) if isinstance(tz, str) else tz


def wall_clock_to_epoch(text: Column, tz: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in zone ``tz`` -> epoch seconds, else NULL."""
    zoned = F.concat(text, F.lit(" "), _zone(tz))
    return F.unix_seconds(F.try_to_timestamp(zoned, F.lit(WALL_CLOCK_ZONE)))


def iso_to_epoch(text: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss`` with ``+hhmm`` offset -> epoch seconds, else NULL."""
    return F.unix_seconds(F.try_to_timestamp(text, F.lit(ISO_OFFSET)))


def epoch_to_wall_clock(epoch: Column, tz: Column | str) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` in zone ``tz``."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", _shifted(epoch, tz), origin).cast("string")


def epoch_to_iso(epoch: Column, tz: Column | str) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd'T'HH:mm:ss+hhmm`` in zone ``tz``."""
    offset = _shifted(epoch, tz) - epoch
    minutes = F.floor(F.abs(offset) / 60)
    return F.concat(
        F.replace(epoch_to_wall_clock(epoch, tz), F.lit(" "), F.lit("T")),
        F.when(offset < 0, "-").otherwise("+"),
        F.lpad((F.floor(minutes / 60) * 100 + minutes % 60).cast("string"), 4, "0"),
    )


def _shifted(epoch: Column, tz: Column | str) -> Column:
    """Epoch seconds moved by the zone's offset at that instant."""
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(epoch), _zone(tz)))


def ntz_to_epoch(ntz: Column) -> Column:
    """Seconds from the epoch to a zone-less timestamp read as UTC.

    Built from calendar fields, because a cast goes through the session zone.
    """
    days = F.unix_date(ntz.cast("date")).cast("bigint")
    return days * 86_400 + F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz)
