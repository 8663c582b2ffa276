"""Column expressions shared by the operators; all of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed pattern: text that counts as a number. Keeps out 'NaN', 'Infinity' and '1d',
# all of which a plain cast to DOUBLE would take.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# The characters a text strip removes, Unicode spaces included.
EDGE_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Wide enough for 100 times the difference of two national totals (20 integer digits),
# narrow enough that the quotient keeps ten decimals before it is rounded to two.
_RATIO_NUMERATOR = T.DecimalType(28, 6)


def change_ratio_pct(current: Column, previous: Column) -> Column:
    """Unrounded percentage change; NULL when there is no previous value or it is zero."""
    change = ((current - previous) * F.lit(100)).cast(_RATIO_NUMERATOR)
    return change / F.nullif(previous, F.lit(0))


def growth_pct(current: Column, previous: Column) -> Column:
    """Percentage change rounded half away from zero to two decimals."""
    return F.round(change_ratio_pct(current, previous), 2)


def growth_status(growth: Column) -> Column:
    """Label of a growth rate; a missing rate counts as Stable."""
    return F.when(growth > 0, "Positive").when(growth < 0, "Negative").otherwise("Stable")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(EDGE_SPACES))


def match_name(text: Column) -> Column:
    """Key for name matching: stripped, lower case; empty and NULL names never match."""
    return F.nullif(F.lower(strip(text)), F.lit(""))


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else the last candidate."""
    filled = [F.nullif(candidate, F.lit("")) for candidate in candidates[:-1]]
    return F.coalesce(*filled, candidates[-1])


def numeric(value: Column, kind: T.DataType) -> Column:
    """Lenient number parsing: whatever is not a number, or does not fit, becomes NULL."""
    text = value.cast("string")
    if isinstance(kind, T.DecimalType):
        # Unlike DOUBLE, DECIMAL takes nothing but numbers.
        return text.try_cast(kind)
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast(kind))


def whole_year(value: Column) -> Column:
    """Year as INT; text that is no whole number becomes NULL."""
    number = numeric(value, T.DecimalType(20, 6))
    other_form = F.when(number == F.floor(number), number.try_cast("int"))
    return F.coalesce(value.try_cast("int"), other_form)


def _date_as_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def period_date_key(period: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD to YYYYMMDD; missing parts are 1, no period is 0.

    Periods that are no date of the calendar keep their numbers. What is no period at all, or has
    more than four digits for its year, is NULL.
    """
    parts = F.split(strip(period), "-")

    def part(position: int) -> Column:
        text = F.get(parts, F.lit(position))
        number = text.try_cast("int")
        return F.when(text.isNull(), F.lit(1)).when(number.between(0, 99), number)

    year = F.get(parts, F.lit(0)).try_cast("int")
    numbers = F.when(year.between(0, 9999), year) * 10000 + part(1) * 100 + part(2)
    day = period.try_cast("date")
    dated = F.when(F.year(day).between(0, 9999), _date_as_key(day))
    key = F.coalesce(dated, numbers)
    return F.when(period.isNull() | (period == ""), F.lit(0)).otherwise(key).cast("int")


def year_date_key(year: Column) -> Column:
    """First day of a year as YYYYMMDD; NULL for a year that has no such key."""
    return F.when(year.between(-9999, 99_999), year * 10000 + 101).cast("int")


def listed(column: Column, wanted: str | Sequence[object] | None) -> Column:
    """Membership in a comma-separated (or plain) list; an empty list means no filter."""
    if wanted is None or wanted == "":
        return F.lit(True)
    items = wanted.split(",") if isinstance(wanted, str) else list(wanted)
    return column.isin([item.strip() if isinstance(item, str) else item for item in items])


def constant_rows(
    spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence[str | int | None]]
) -> DataFrame:
    """A few constant rows as expressions, whose size Catalyst knows and broadcasts."""
    structs = [
        F.struct(
            *[
                (F.lit(v).cast("long") if isinstance(v, int) else F.lit(v).cast("string")).alias(n)
                for n, v in zip(names, row)
            ]
        )
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
