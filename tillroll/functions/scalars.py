"""Scalar column expressions. All are built-ins, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schemas

# Fixed value: year-month-day, one or two hour digits, minutes and seconds.
# Plain numbers only: a cast alone also takes ``12d``, ``7f`` and ``0x1p3``.
NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}$"


@dataclass(frozen=True)
class Layout:
    """A way to write a moment: the shape of the whole text, and how its groups are put in the
    order of year, month, day, hour, minute and second."""

    shape: str
    order: str | None = None


ISO = Layout(TIMESTAMP_SHAPE)
#: Further layouts that a caller may accept.
ISO_T = Layout(r"^(\d{4}-\d{2}-\d{2})T(\d{1,2}:\d{2}:\d{2})$", "$1 $2")
ISO_MINUTES = Layout(r"^(\d{4}-\d{2}-\d{2}) (\d{1,2}:\d{2})$", "$1 $2:00")
ISO_DATE = Layout(r"^(\d{4}-\d{2}-\d{2})$", "$1 00:00:00")
DAY_FIRST = Layout(r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4}) (\d{1,2}:\d{2})$", "$3-$2-$1 $4:00")
MONTH_FIRST = Layout(r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{2})$", "$3-$1-$2 $4:00")


def to_number(text: Column) -> Column:
    """Text as double; null where it is no number, as are NaN and infinity."""
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))


def to_integer(text: Column) -> Column:
    """Text as bigint without its fraction, because ids and counts arrive as ``13085.0``."""
    whole = text.try_cast("decimal(38,10)").try_cast("bigint")
    return F.when(text.rlike(NUMBER_SHAPE), whole)


def to_wall_clock(text: Column, layouts: Sequence[Layout] = (ISO,)) -> Column:
    """Text as timestamp without zone, so no session setting can shift it.

    The cast alone would also take ``2010`` or ``2010-03-14``; the shape rules these out. Of
    several layouts the first whose shape fits and gives a moment counts, for each text."""
    found = []
    for layout in layouts:
        ordered = text
        if layout.order is not None:
            ordered = F.regexp_replace(text, layout.shape, layout.order)
        found.append(F.when(text.rlike(layout.shape), ordered.try_cast("timestamp_ntz")))
    return F.coalesce(*found) if len(found) > 1 else found[0]


def line_revenue(quantity: Column, price: Column) -> Column:
    """Quantity times price, rounded half up to the penny once.

    The price keeps eight decimals and the product is exact, whatever the quantity. Prices
    above ten integer digits are multiplied as doubles, so that no size gives null.
    """
    exact = quantity.cast("decimal(19,0)") * price.try_cast("decimal(18,8)")
    rough = (quantity * price).try_cast("decimal(38,8)")
    return F.round(F.coalesce(exact, rough), 2).try_cast(schemas.MONEY)


def is_cancelled(invoice: Column) -> Column:
    return invoice.startswith(schemas.CANCELLED_PREFIX)


def region_group(country: Column) -> Column:
    choice = F.lit(schemas.OTHER_REGION)
    for group, countries in schemas.REGION_GROUPS.items():
        choice = F.when(country.isin(*countries), group).otherwise(choice)
    return choice


def exact_sum(number: Column) -> Column:
    """The sum of a bigint as decimal(38,0), where it may go beyond 64 bits.

    The upper and lower 32 bits are added up apart, as bigint; a decimal would be added as an
    object for each row."""
    high = F.sum(F.shiftright(number, 32)).cast("decimal(38,0)")
    low = F.sum(number.bitwiseAND(F.lit((1 << 32) - 1))).cast("decimal(38,0)")
    return (high * F.lit(1 << 32).cast("decimal(38,0)") + low).cast("decimal(38,0)")


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals, null when there is nothing to divide by."""
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 2)


def order_band(value: Column, per_doubling: int = 16) -> Column:
    """An int that never falls as ``value`` rises, with a bounded number of levels.

    Bands are logarithmic: every doubling of the magnitude has ``per_doubling`` of them,
    so doubles of any size fall into fewer than ``5000 * per_doubling`` bands. Never null.
    """
    # Infinity shares the top band; 1100 doublings lift the smallest double above zero.
    magnitude = F.least(F.abs(value.cast("double")), F.lit(1e308))
    level = F.floor(F.log2(magnitude) * per_doubling) + 1100 * per_doubling
    band = F.when(value > 0, level).when(value < 0, -level).cast("int")
    return F.coalesce(band, F.lit(0))
