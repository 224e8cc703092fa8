"""Column helpers with the null, NaN and division rules of the domain."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def finite_or_zero(c: Column) -> Column:
    return F.when(is_finite(c), c).otherwise(F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null (tables)."""
    return F.when(b != 0, a / b)


def ratio_or_zero(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 (scalar helpers)."""
    return F.coalesce(ratio(a, b), F.lit(0.0))


def clip(c: Column, low, high) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def sum_if(condition: Column, value: Column) -> Column:
    """Sum over rows that meet the condition; 0 if none does."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def median_if(condition: Column, value: Column) -> Column:
    return F.median(F.when(condition, value))


def share_true(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def any_of(*conditions: Column) -> Column:
    return reduce(or_, conditions)


def weekday_from_monday(c: Column) -> Column:
    return F.weekday(c) + 1


def unique_id(section: str = "section", store: str | None = "store", sku: str | None = "sku") -> Column:
    """section, section||T:store, section||S:sku or section||T:store||S:sku; null parts are left out."""
    parts = [F.col(section)]
    if store:
        parts.append(F.when(F.col(store).isNotNull(), F.concat(F.lit("T:"), F.col(store))))
    if sku:
        parts.append(F.when(F.col(sku).isNotNull(), F.concat(F.lit("S:"), F.col(sku))))
    return F.concat_ws("||", *parts)


def id_part(uid: Column, mark: str) -> Column:
    """Store (T) or SKU (S) of a unique id, or null."""
    return F.nullif(F.regexp_extract(uid, rf"\|\|{mark}:([^|]+)", 1), F.lit(""))


def id_section(uid: Column) -> Column:
    return F.split(uid, r"\|\|")[0]


def id_level(uid: Column) -> Column:
    return F.regexp_count(uid, F.lit(r"\|\|"))


def cohort(days_with_sales: Column, active_days: int = 7) -> Column:
    return F.when(days_with_sales == 0, "zero").when(days_with_sales < active_days, "sparse").otherwise("active")


def display_label(section: Column, store: Column, sku: Column) -> Column:
    return (
        F.when(store.isNull() & sku.isNull(), F.concat(F.lit("Section "), section))
        .when(sku.isNull(), F.concat(F.lit("Store "), store))
        .when(store.isNull(), F.concat(F.lit("SKU "), sku))
        .otherwise(F.concat(F.lit("SKU "), sku, F.lit(" @ "), store))
    )
