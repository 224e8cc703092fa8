"""Calendar drivers, computed on distinct dates only."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Weekday and month dummies (Monday and January are the base).
WEEKDAYS = {2: "Tue", 3: "Wed", 4: "Thu", 5: "Fri", 6: "Sat", 7: "Sun"}
MONTHS = {2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun", 7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec"}



class Holiday(NamedTuple):
    """A rule for the date, the days before and after it that count, and whether it is in the design."""

    rule: tuple
    before: int
    after: int
    active: bool = True


# Fixed values of the domain: dates or rules (month and day; month, weekday from Monday 1, and its number in the month; days from Easter Sunday), windows, active flags.
HOLIDAYS = {
    "xmas": Holiday(("fixed", 12, 24), 3, 1),
    "new_year": Holiday(("fixed", 12, 31), 3, 1),
    "mothers_day": Holiday(("nth", 5, 7, 2), 15, 0),
    "dia_trabajo": Holiday(("fixed", 4, 30), 2, 2),
    "promo_feb": Holiday(("fixed", 2, 17), 2, 2),
    "promo_mar": Holiday(("fixed", 3, 12), 1, 5),
    "promo_abr": Holiday(("fixed", 4, 22), 2, 1),
    "promo_abr_2": Holiday(("fixed", 4, 30), 1, 1),
    "promo_may": Holiday(("nth", 5, 7, 1), 2, 2),
    "promo_may_2": Holiday(("nth", 5, 7, 4), 2, 2),
    "promo_sep": Holiday(("fixed", 9, 3), 1, 15),
    "promo_oct": Holiday(("fixed", 10, 1), 1, 1),
    "promo_nov": Holiday(("fixed", 11, 3), 3, 0),
    "promo_dic": Holiday(("fixed", 12, 7), 1, 1),
    "fathers_day": Holiday(("nth", 7, 7, 2), 13, 0),
    "black_friday": Holiday(("nth", 11, 5, 4), 6, 0),
    "pascuas_y_semana_de_turismo": Holiday(("easter", 0), 7, 0, active=False),
    "carnaval": Holiday(("easter", -48), 1, 1, active=False),
}
#: Holidays whose window is one rising and falling weight, not a column a day.
RAMPS = ("mothers_day", "fathers_day")


def offset_columns(holidays: dict = HOLIDAYS) -> dict[str, tuple[str, int]]:
    """Column -> holiday and day offset, for active holidays without a ramp."""
    return {offset_column(n, o): (n, o) for n, h in holidays.items() if h.active and n not in RAMPS for o in range(-h.before, h.after + 1)}


def easter(year: int) -> dt.date:
    """Easter Sunday of the Gregorian calendar (the anonymous computus)."""
    a, (b, c) = year % 19, divmod(year, 100)
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    m = (32 + 2 * e + 2 * i - h - k) % 7
    n = (a + 11 * h + 22 * m) // 451
    month, day = divmod(h + m - 7 * n + 114, 31)
    return dt.date(year, month, day + 1)


def holiday_date(rule: tuple, year: int) -> dt.date:
    if rule[0] == "fixed":
        return dt.date(year, rule[1], rule[2])
    if rule[0] == "nth":
        first = dt.date(year, rule[1], 1)
        return first + dt.timedelta((rule[2] - first.isoweekday()) % 7 + 7 * (rule[3] - 1))
    if rule[0] == "easter":
        return easter(year) + dt.timedelta(rule[1])
    raise ValueError(f"unknown holiday rule {rule!r}")


def holiday_table(spark: SparkSession, years, holidays: dict = HOLIDAYS) -> DataFrame:
    """holiday, holiday_ds for each year; a few rows a year."""
    return spark.createDataFrame([(n, holiday_date(h.rule, y)) for y in years for n, h in holidays.items()], "holiday string, holiday_ds date")


def calendar_dummies(dates: DataFrame) -> DataFrame:
    """Weekday and month dummies of the distinct dates."""
    d = dates.select("ds").distinct()
    week, month = F.weekday("ds") + 1, F.month("ds")
    return d.select("ds", *((week == k).cast("int").alias(n) for k, n in WEEKDAYS.items()), *((month == k).cast("int").alias(n) for k, n in MONTHS.items()))


def offset_column(holiday: str, offset: int) -> str:
    return f"{holiday}_{'m' if offset < 0 else 'p'}{abs(offset)}"


def holiday_offsets(dates: DataFrame, table: DataFrame, holidays: dict = HOLIDAYS) -> DataFrame:
    """One 0/1 column per active holiday and day of its window, by a pivot with fixed values."""
    columns = offset_columns(holidays)
    windows = F.create_map(*(F.lit(x) for n, h in holidays.items() for x in (n, h.before)))[F.col("holiday")], F.create_map(*(F.lit(x) for n, h in holidays.items() for x in (n, h.after)))[F.col("holiday")]
    around = table.select("holiday", F.explode(F.sequence(-windows[0], windows[1])).alias("o"), "holiday_ds")
    mark = F.concat("holiday", F.when(F.col("o") < 0, "_m").otherwise("_p"), F.abs("o").cast("string"))
    around = around.select(F.expr("date_add(holiday_ds, o)").alias("ds"), mark.alias("mark"))
    wide = around.groupBy("ds").pivot("mark", list(columns)).agg(F.max(F.lit(1)))
    return dates.select("ds").distinct().join(wide, "ds", "left").select("ds", *(F.coalesce(c, F.lit(0)).alias(c) for c in columns))


def holiday_ramp(dates: DataFrame, table: DataFrame, name: str, holidays: dict = HOLIDAYS) -> DataFrame:
    """Weight 1 on the holiday, falling by equal steps to 0 at the longer end of its window; 0 elsewhere."""
    before, after = holidays[name].before, holidays[name].after
    span = max(before, after, 1)
    steps = table.where(F.col("holiday") == name).select("holiday_ds", F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("o"))
    steps = steps.select(F.expr("date_add(holiday_ds, o)").alias("ds"), (1 - F.abs("o") / F.lit(float(span))).alias("w"))
    weights = steps.groupBy("ds").agg(F.max("w").alias(name))
    return dates.select("ds").distinct().join(weights, "ds", "left").select("ds", F.coalesce(name, F.lit(0.0)).alias(name))
