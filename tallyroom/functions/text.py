"""Text expressions: product labels and clock times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shop's slug suffix and the short English names used in clock times.
SLUG_SUFFIX = "-shop-item"
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# A cased letter that follows anything else starts a new capitalised piece ("5k" -> "5K").
_PIECE_START = r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])(?=[\p{Lu}\p{Ll}\p{Lt}])"


# Unicode white space and the four separator controls.
_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def stripped(text: Column) -> Column:
    """Text without white space of any kind at either end (``trim`` only removes spaces)."""
    return F.regexp_replace(text, _BLANKS, "")


def product_label(slug: Column) -> Column:
    """Readable product name of a slug; NULL stays NULL."""
    words = F.replace(F.replace(slug, F.lit(SLUG_SUFFIX), F.lit("")), F.lit("-"), F.lit(" "))
    return F.array_join(F.transform(F.split(words, _PIECE_START), F.initcap), "")


def clock_text(ts: Column, offset_hours: int) -> Column:
    """``Sat Jan 6, 12:07 AM`` at a fixed offset from UTC.

    Built from the timestamp's own fields: ``date_format`` would pass a zone-less timestamp
    through the session zone and bend the hours that a daylight-saving change skips there.
    """
    local = ts + F.make_dt_interval(hours=F.lit(offset_hours))
    hour = F.hour(local)
    return F.concat(
        F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(local)),
        F.lit(" "),
        F.element_at(F.array(*map(F.lit, MONTHS)), F.month(local)),
        F.lit(" "),
        F.dayofmonth(local).cast("string"),
        F.lit(", "),
        ((hour + 11) % 12 + 1).cast("string"),
        F.lit(":"),
        F.lpad(F.minute(local).cast("string"), 2, "0"),
        F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )
