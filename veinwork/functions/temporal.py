"""Calendar features of a date column and of clock text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bands of the day as (from hour, to hour, label); hours outside every band
# take the last label, a missing hour takes the null label.
DAY_BANDS = {
    "quarters": ([(0, 6, "Night"), (6, 12, "Morning"), (12, 18, "Afternoon")], "Evening", "Unknown"),
    "late_evening": (
        [(5, 12, "Morning"), (12, 17, "Afternoon"), (17, 22, "Evening")], "Night", "Unknown"
    ),
    "early_evening": (
        [(5, 12, "Morning"), (12, 17, "Afternoon"), (17, 21, "Evening")], "Night", None
    ),
}

# Months of each season.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}


def hour_of_clock(text: Column) -> Column:
    """Hour of `HH:MM:SS` text; anything else, such as 25:00:00, is null."""
    return F.hour(F.try_to_timestamp(text, F.lit("HH:mm:ss")))


def hour_before_colon(text: Column) -> Column:
    """The number before the first colon, unchecked: 25:00:00 gives 25."""
    return F.when(text.contains(":"), F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int"))


def day_of_week(date: Column) -> Column:
    """0 is Monday, 6 is Sunday."""
    return F.weekday(date)


def weekend_flag(date: Column) -> Column:
    """1 on Saturday and Sunday, else 0; a missing date is 0."""
    return F.coalesce(F.weekday(date) >= 5, F.lit(False)).cast("int")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def season(date: Column) -> Column:
    chain = F
    for name, months in SEASONS.items():
        chain = chain.when(F.month(date).isin(*months), name)
    return chain


def day_band(hour: Column, style: str = "quarters") -> Column:
    bands, last, missing = DAY_BANDS[style]
    chain = F.when(hour.isNull(), F.lit(missing))
    for low, high, label in bands:
        chain = chain.when((hour >= low) & (hour < high), label)
    return chain.otherwise(last)


def join_date_and_clock(date: Column, clock: Column) -> Column:
    """Timestamp out of a date and clock text; null when either is missing or bad."""
    joined = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), clock)
    return F.try_to_timestamp(joined, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def years_since(
    year: Column,
    base: int | Column,
    missing: str = "keep",
    clip: tuple[int, int] | None = None,
    negative_to_null: bool = False,
) -> Column:
    """Age in years against a base year.

    `missing="zero"` gives a missing year the age 0, `"keep"` leaves it null. `clip` bounds
    the age on both sides; `negative_to_null` discards ages below 0.
    """
    base = F.lit(base) if isinstance(base, int) else base
    age = base - year
    if negative_to_null:
        age = F.when(age >= 0, age)
    if clip:
        low, high = clip
        age = F.when(age < low, F.lit(low)).when(age > high, F.lit(high)).otherwise(age)
    if missing == "zero":
        age = F.coalesce(age, F.lit(0))
    return age.cast("long")
