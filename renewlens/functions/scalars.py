"""Column expressions (JVM-side, codegen-friendly) shared by the feature builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from renewlens import params as P


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` that is NULL on a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col_or(num), col_or(den))


def guarded_pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``CASE WHEN den = 0 THEN 0 ELSE round(num*100/den, scale) END``."""
    den = col_or(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(F.round(safe_ratio(col_or(num) * 100, den), scale))


def day_number(c: str | Column) -> Column:
    """Days since 1970-01-01 of a date column (integer)."""
    return F.unix_date(col_or(c))


# -- package dates ---------------------------------------------------------

def package_duration(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def quarter_days(start: Column, end: Column) -> Column:
    """``floor(datediff(end, start) / 4)`` as bigint."""
    return F.floor(F.datediff(end, start) / 4)


def quarter_cutoff(start: Column, end: Column) -> Column:
    """The date at which a quarter of the package has elapsed."""
    return F.date_add(start, quarter_days(start, end).cast("int"))


# -- category buckets -------------------------------------------------------

def bhk_bucket(display_name: Column) -> Column:
    return (
        F.when(display_name.isin(*P.BHK_SINGLE), F.lit(P.BHK_SINGLE_LABEL))
        .when(display_name.isin(*P.BHK_KEPT), display_name)
        .otherwise(F.lit("Others"))
    )


def property_bucket(name: Column) -> Column:
    return (
        F.when(name.isin(*P.PROPERTY_HOUSE), F.lit(P.PROPERTY_HOUSE_LABEL))
        .when(name == "Apartment", F.lit("Apartment"))
        .when(name == "Independent Floor", F.lit("Independent Floor"))
        .otherwise(F.lit("Others"))
    )


def channel_bucket(generator: Column) -> Column:
    """Lead channel; NULL generators fall to ``others`` (CASE semantics)."""
    low = F.lower(generator)
    churn = reduce(lambda a, b: a | b, [low.like(p) for p in P.CHANNEL_CHURN_PATTERNS])
    return (
        F.when(churn, F.lit("churn/shadow"))
        .when(generator.isin(*P.CHANNEL_CR), F.lit("CR/ImageCR/ReCallback"))
        .when(low == "crm", F.lit("crm"))
        .when(low.isin(*P.CHANNEL_FB), F.lit("facebook/FB_Marketplace"))
        .otherwise(F.lit("others"))
    )


def listing_price(is_buy: Column, price: Column, details_json: Column) -> Column:
    """Buy listings use their price, rent listings the JSON ``rent`` field.

    Dirty text yields NULL instead of failing the job under ANSI mode.
    """
    return F.when(is_buy == F.lit(True), price.try_cast("int")).otherwise(
        F.get_json_object(details_json, "$.rent").try_cast("int")
    )


# -- contact keys ------------------------------------------------------------

def phone_key(mobile: Column) -> Column:
    """Last ten characters of the trimmed number, as a string."""
    return F.right(F.trim(mobile), F.lit(10)).cast("string")


def email_key(email: Column) -> Column:
    return F.lower(F.trim(email))


# -- slots -------------------------------------------------------------------

def slot_tokens(slot_ids: Column) -> Column:
    """Array of slot tokens from a bracketed string array (NULL stays NULL)."""
    return F.split(F.regexp_replace(F.array_join(slot_ids, ","), r"[\[\]]", ""), ",")
