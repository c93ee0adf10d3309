"""Text cleaning expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as V


def trim_all(df: DataFrame) -> DataFrame:
    """Blank-trim every column in one projection."""
    return df.select([F.trim(F.col(name)).alias(name) for name in df.columns])


def canonical(text: Column, type_name: str) -> Column:
    """One spelling per value: `007` and `7` agree as bigint; unreadable text stays as it is.

    So does a date with a time of day, of which a date would keep less.
    """
    value = text.try_cast(type_name)
    if type_name == "date":
        value = F.when(~text.rlike(r"[\sT]"), value)
    return F.coalesce(value.cast("string"), text)


def clean_email(email: Column) -> Column:
    """Trim, then cut behind the first `.com` (`x@y.community.com` becomes `x@y.com`, by rule)."""
    return F.regexp_replace(F.trim(email), V.EMAIL_TAIL_PATTERN, V.EMAIL_TAIL)


def split_address(address: Column) -> dict[str, Column]:
    """Parts of `address/city/state/postal_code`; a missing part is null."""
    parts = F.split(address, V.ADDRESS_SEPARATOR)
    return {
        name: F.trim(F.get(parts, F.lit(position)))
        for position, name in enumerate(V.ADDRESS_PARTS)
    }


def finite_double(text: Column) -> Column:
    """Text as a double; null for junk, NaN and infinities."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)
