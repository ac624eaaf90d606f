"""Calendar dimension: bounds found in the business tables, one row per day."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

# Column names, and parts of names, of dates that are not business
# dates and must not stretch the calendar.
EXCLUDED_NAMES = {
    "dob", "date_of_birth", "birth_date",
    "effective_start_date", "effective_end_date",
    "valid_from", "valid_to",
    "created_date", "updated_date",
    "created_ts", "updated_ts",
    "load_date", "load_ts",
    "ingest_date", "ingest_ts",
}
EXCLUDED_PARTS = (
    "dob", "birth", "effective", "valid",
    "created", "updated", "modified",
    "load", "ingest", "audit",
)
BUFFER_DAYS = 365
NO_BOUNDS = "the date columns hold no dates: the calendar has no bounds"

# The calendar's columns and text formats.
CALENDAR_SQL = {
    "Date_Key": "cast(date_format(Date, 'yyyyMMdd') as int)",
    "Year": "year(Date)",
    "Month_Number": "month(Date)",
    "Month_Name": "date_format(Date, 'MMMM')",
    "Month_Short": "date_format(Date, 'MMM')",
    "Quarter_Number": "quarter(Date)",
    "quarter": "'Q' || quarter(Date)",
    "Year_Quarter": "year(Date) || '-Q' || quarter(Date)",
    "Month_Year": "date_format(Date, 'MMM yyyy')",
    "Year_Month": "date_format(Date, 'yyyy-MM')",
    "Week_Number": "weekofyear(Date)",
    "Day": "day(Date)",
    "Day_Name": "date_format(Date, 'EEEE')",
    "Day_Short": "date_format(Date, 'E')",
    "Day_Of_Week": "dayofweek(Date)",
    "Day_Of_Year": "dayofyear(Date)",
    "Is_Weekend": "int(weekday(Date) >= 5)",
    "Is_Month_Start": "int(trunc(Date, 'month') = Date)",
    "Is_Month_End": "int(trunc(Date + 1, 'month') = Date + 1)",
    "Is_Quarter_Start": "int(trunc(Date, 'quarter') = Date)",
    "Is_Quarter_End": "int(trunc(Date + 1, 'quarter') = Date + 1)",
    "Is_Year_Start": "int(trunc(Date, 'year') = Date)",
    "Is_Year_End": "int(trunc(Date + 1, 'year') = Date + 1)",
    # the fiscal year starts in April: read year and quarter off three months earlier
    "Financial_Year": "year(add_months(Date, -3)) || '-' || (year(add_months(Date, -3)) + 1)",
    "Financial_Quarter": "'Q' || quarter(add_months(Date, -3))",
}


def date_key(c: Column | str) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def is_business_date(name: str) -> bool:
    name = name.lower()
    return name not in EXCLUDED_NAMES and not any(part in name for part in EXCLUDED_PARTS)


def business_dates(df: DataFrame) -> list[str]:
    kinds = (DateType, TimestampType, TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and is_business_date(f.name)]


def date_bounds(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, min_date, max_date) of each business date column.

    One aggregation per table covers all its date columns; columns without any
    date are left out.
    """
    found = {name: business_dates(df) for name, df in tables.items()}
    if not any(found.values()):
        raise ValueError("none of the tables has a business date column")
    parts = []
    for name, columns in found.items():
        if columns:
            ends = [
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(c).alias("column_name"),
                    F.min(F.to_date(c)).alias("min_date"),
                    F.max(F.to_date(c)).alias("max_date"),
                )
                for c in columns
            ]
            parts.append(tables[name].agg(F.array(*ends).alias("ends")).selectExpr("inline(ends)"))
    return reduce(DataFrame.unionByName, parts).where("min_date is not null")


def calendar(bounds: DataFrame, buffer_days: int = BUFFER_DAYS) -> DataFrame:
    """One row per day from the first bound to the last plus the buffer. The bounds
    never leave Spark: the days are exploded from a one-row aggregate. Without any
    bound it fails when it runs."""
    span = bounds.agg(F.min("min_date").alias("first"), F.max("max_date").alias("last"))
    days = F.when(F.col("first").isNull(), F.raise_error(F.lit(NO_BOUNDS))).otherwise(
        F.sequence("first", F.date_add("last", buffer_days))
    )
    days = span.select(F.explode(days).alias("Date"))
    return days.select("Date", *(F.expr(sql).cast(_kind(c)).alias(c) for c, sql in CALENDAR_SQL.items()))


def observed_dates(*dates: DataFrame) -> DataFrame:
    """Sparse calendar: only the days found in the given one-column frames."""
    days = reduce(DataFrame.union, (d.toDF("Date") for d in dates)).where("Date is not null").distinct()
    wanted = {
        "date_key": "Date_Key", "year": "Year", "month_no": "Month_Number", "month_name": "Month_Short",
        "quarter": "quarter", "day_of_month": "Day", "day_name": "Day_Short", "week_of_year": "Week_Number",
    }
    return days.select("Date", *(F.expr(CALENDAR_SQL[c]).alias(name) for name, c in wanted.items()))


def _kind(column: str) -> str:
    named = ("Name", "Short", "quarter", "Year_Quarter", "Month_Year", "Year_Month", "Financial")
    return "string" if any(part in column for part in named) and column != "Quarter_Number" else "int"
