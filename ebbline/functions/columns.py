"""Column functions; all are built-in expressions, so they stay inside whole-stage codegen.

Time functions take epoch milliseconds and work in UTC whatever the session time zone is.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86400000
HOUR_MS = 3600000

# User-agent families by the marks an agent string carries, first match wins.
DEVICE_MARKS = (
    ("Windows Phone", ("Windows Phone",)),
    ("Windows", ("Windows",)),
    ("iOS", ("iPhone",)),
    ("iOS", ("iPad",)),
    ("iOS", ("iPod",)),
    ("Mac OS X", ("Mac OS X",)),
    ("Android", ("Android",)),
    ("Chrome OS", ("CrOS",)),
    ("Ubuntu", ("Ubuntu",)),
    ("Linux", ("Linux",)),
)
BROWSER_MARKS = (
    ("Firefox iOS", ("FxiOS/",)),
    ("Firefox Mobile", ("Android", "Firefox/")),
    ("Firefox", ("Firefox/",)),
    ("Google", ("GSA/",)),
    ("Edge", ("Edge/",)),
    ("Edge", ("Edg/",)),
    ("Opera", ("OPR/",)),
    ("Opera", ("Opera",)),
    ("Chromium", ("Chromium/",)),
    ("Chrome Mobile iOS", ("CriOS/",)),
    ("Chrome Mobile", ("Android", "Chrome/")),
    ("Chrome", ("Chrome/",)),
    ("IE", ("MSIE ",)),
    ("IE", ("Trident/",)),
    ("Mobile Safari", ("Mobile/", "Safari/")),
    ("Safari", ("Version/", "Safari/")),
)


def flag_in(column: Column, values: Iterable) -> Column:
    """1 if the value is in ``values``, else 0; null counts as 0."""
    return F.coalesce(column.isin(list(values)), F.lit(False)).cast("int")


def level_flag(level: Column) -> Column:
    return flag_in(level, ["paid"])


def event_time(ts: Column) -> Column:
    return F.timestamp_millis(ts)


def event_date(ts: Column) -> Column:
    return F.date_from_unix_date(F.floor(ts / DAY_MS).cast("int"))


def event_hour(ts: Column) -> Column:
    return F.pmod(F.floor(ts / HOUR_MS), F.lit(24)).cast("int")


def day_name(ts: Column) -> Column:
    return F.date_format(event_date(ts), "EEEE")


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, rounded down; null if either is null."""
    return F.floor((end - start) / DAY_MS).cast("int")


def state_of(location: Column) -> Column:
    return F.right(location, F.lit(2))


def agent_text(agent: Column) -> Column:
    """User-agent string without backslashes, the input of the family functions."""
    return F.replace(agent, F.lit("\\"), F.lit(""))


def _family(text: Column, marks) -> Column:
    family = F.lit("Other")
    for name, required in reversed(marks):
        found = text.contains(required[0])
        for mark in required[1:]:
            found = found & text.contains(mark)
        family = F.when(found, name).otherwise(family)
    return family


def device_family(text: Column) -> Column:
    """Operating-system family; null, blank and unknown agents are ``Other``."""
    return _family(text, DEVICE_MARKS)


def browser_family(text: Column) -> Column:
    """Browser family; null, blank and unknown agents are ``Other``."""
    return _family(text, BROWSER_MARKS)


def soft_clip(column: Column, threshold: float = 3.0) -> Column:
    """``tanh(x / t) * t``; zero stays zero."""
    return F.tanh(column / threshold) * threshold


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def double_order(value: Column) -> Column:
    """A long that orders as the double does: equal for equal values (-0.0 is 0.0), NaN last.

    It is the number's exponent and fraction in one integer, taken apart by exact operations on powers of two.
    """
    size = F.abs(value.cast("double"))
    guess = F.floor(F.log2(size))
    # The logarithm may round across a power of two.
    exponent = guess - F.when(size < F.pow(F.lit(2.0), guess), 1).otherwise(0)
    exponent = exponent + F.when(size >= F.pow(F.lit(2.0), exponent + 1), 1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * 2**52).cast("long")
    least = 2.0**-1022  # below it numbers have no exponent of their own
    image = (
        F.when(F.isnan(value), F.lit((2047 << 52) + 1))
        .when(size == F.lit(float("inf")), F.lit(2047 << 52))
        .when(size < least, (size * 2.0**537 * 2.0**537).cast("long"))
        .otherwise((exponent + 1023).cast("long") * (1 << 52) + fraction)
    )
    return F.when(value < 0, -image).otherwise(image)
