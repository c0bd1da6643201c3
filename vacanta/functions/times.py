"""Time labels and spans."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_label(ts: Column) -> Column:
    """``2024-01-31 07:00`` for any moment in that hour.

    The text of a moment without zone is taken as it stands: formatting it would
    send it through the session's zone, which skips an hour in spring.
    """
    return F.concat(F.substring(ts.cast("string"), 1, 13), F.lit(":00"))


def iso_text(ts: Column) -> Column:
    """ISO text; the fraction is written only where it is not zero."""
    text = ts.cast("string")
    whole = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    fraction = F.substring(text, 21, 6)
    return F.concat(whole, F.when(fraction == "", "").otherwise(F.concat(F.lit("."), F.rpad(fraction, 6, "0"))))


def hours_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros.cast("double") / 1e6 / 3600
