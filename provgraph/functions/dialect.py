"""Column expressions reproducing the SQL-dialect semantics the pipeline needs.

All helpers return plain ``Column`` expressions built from
``pyspark.sql.functions``, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Calendar-month boundaries between two dates (``DATE_DIFF(a, b, MONTH)``).

    Not ``months_between`` (fractional) and not Spark's ``datediff(MONTH, ..)``
    (whole elapsed months): Jan 31 -> Feb 1 is 1 here.
    """
    a, b = _col(later), _col(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def month_start(d: Column | str) -> Column:
    """First day of the month of a date, as a date."""
    return F.trunc(_col(d), "MM")


def _packed_parts(packed: Column | str):
    s = _col(packed).cast("string")
    return F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)


def _packed_numbers(packed: Column | str) -> tuple[Column, Column, Column, Column]:
    """Whether a packed date has eight digits, and its year, month and day as numbers where it has."""
    v = _col(packed)
    year = F.call_function("div", v, F.lit(10000)).cast("int")
    month = (F.call_function("div", v, F.lit(100)) % 100).cast("int")
    return v.between(10000101, 99991231), year, month, (v % 100).cast("int")


def _days_in_month(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def packed_date(packed: Column | str) -> Column:
    """``YYYYMMDD`` integer to date; an impossible date becomes NULL (SAFE_CAST).

    Eight digits are taken apart by arithmetic, other lengths by their text.
    """
    y, m, d = _packed_parts(packed)
    whole, year, month, day = _packed_numbers(packed)
    exists = month.between(1, 12) & (day >= 1) & (day <= _days_in_month(year, month))
    return F.when(whole, F.when(exists, F.make_date(year, month, day))).otherwise(F.concat(y, F.lit("-"), m, F.lit("-"), d).try_cast("date"))


def packed_claim_month(claim_year: Column | str, packed: Column | str) -> Column:
    """Claim month from the claim year and the raw month digits of a packed date.

    Only the month substring is used, so a bad day still yields a month while
    a bad month (e.g. ``13``) yields NULL.
    """
    _, m, _ = _packed_parts(packed)
    whole, _, month, _ = _packed_numbers(packed)
    year = _col(claim_year)
    by_text = F.concat(year.cast("string"), F.lit("-"), m, F.lit("-01")).try_cast("date")
    return F.when(whole & year.between(1000, 9999), F.when(month.between(1, 12), F.make_date(year.cast("int"), month, F.lit(1)))).otherwise(by_text)


def claim_year_month(claim_year: Column | str, service_date: Column | str) -> Column:
    """Claim month from the claim year and the month of a parsed service date.

    NULL when the service date is NULL; the year comes from ``claim_year``,
    not from the date.
    """
    d = _col(service_date)
    return F.when(d.isNotNull(), F.make_date(_col(claim_year).cast("int"), F.month(d), F.lit(1)))


def unpadded(c: Column | str) -> Column:
    """A string without trailing blanks, which T-SQL ``=`` and ``<>`` ignore."""
    return F.rtrim(_col(c))


def tsql_int(c: Column | str) -> Column:
    """``TRY_CAST(varchar AS INT)`` with T-SQL rules.

    A blank string converts to 0 (Spark would give NULL); text or a value
    outside the 32-bit range gives NULL.  The result is widened to long.
    """
    x = _col(c)
    return F.when(F.trim(x) == "", F.lit(0)).otherwise(x.try_cast("int")).cast("long")


def canonical_long(c: Column | str) -> Column:
    """Long value of a string only when the string is its canonical decimal form.

    ``CAST(long AS STRING) = s`` matches exactly those strings (trailing blanks
    aside), so joining on this value is the same as the string-cast join of
    the original SQL while keeping a numeric key.
    """
    x = unpadded(c)
    v = x.try_cast("long")
    return F.when(v.cast("string") == x, v)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num * 1.0 / NULLIF(den, 0)`` as a double; NULL when den is 0 or NULL."""
    return F.try_divide(_col(num).cast("double"), F.nullif(_col(den).cast("double"), F.lit(0.0)))


def rounded(c: Column | str, digits: int) -> Column:
    """``F.round`` of a double, mostly by arithmetic on doubles.

    ``F.round`` goes through a decimal object and its text for each value.
    Only values near a tie, very large ones and NaN need that.
    """
    x, unit = _col(c), F.lit(float(10**digits))
    units = F.abs(x * unit)
    near = F.signum(x) * F.floor(units + 0.5) / unit + F.lit(0.0)
    # NaN is above every number.
    by_text = (units >= F.lit(float(2**40))) | (F.abs(units % 1 - 0.5) < 0.001)
    return F.when(by_text, F.round(x, digits)).otherwise(near)
