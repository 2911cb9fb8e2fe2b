"""Column expressions: parsing, calendar parts, bounds, metric terms.

Everything here is a built-in ``pyspark.sql.functions`` composition, so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date format of the sales export.
DATE_FORMAT = "dd-MM-yyyy"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- parsing -------------------------------------------------------------

def parse_date(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Strict parse; under ANSI mode a value not matching ``fmt`` fails the
    query, as the reference's single-format parse does."""
    return F.to_date(col(c), fmt)


def parse_date_fallback(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """``fmt`` first, then Spark's default formats; NULL if neither parses."""
    return F.coalesce(F.try_to_date(col(c), fmt), F.try_to_date(col(c)))


def parse_percent(c: str | Column) -> Column:
    """``"15%"`` -> 0.15."""
    return F.regexp_replace(col(c), "%", "").cast("double") / 100


# --- calendar ------------------------------------------------------------

def calendar_columns(d: str | Column) -> dict[str, Column]:
    """The nine calendar features: Monday = 0 weekday, ISO week."""
    d = col(d)
    dow = F.weekday(d)
    # The names of the features.
    return {
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": (dow >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (F.last_day(d) == d).cast("int"),
    }


# --- scalar math ---------------------------------------------------------

def round_money(c: str | Column, digits: int = 2) -> Column:
    """Half-up rounding on the exact decimal value (money), so ties such as
    x.xx5 round the same way in every engine; returned as double."""
    return F.round(col(c).cast("decimal(38,6)"), digits).cast("double")


def clip(c: str | Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def safe_denominator(y: str | Column) -> Column:
    """Zero replaced by one, for percentage errors."""
    return F.when(col(y) == 0, F.lit(1.0)).otherwise(col(y))


def item_label(product: str | Column = "product", brand: str | Column = "brand") -> Column:
    """Short display label: first four characters of each part."""
    return F.concat_ws("-", F.substring(col(product), 1, 4), F.substring(col(brand), 1, 4))
