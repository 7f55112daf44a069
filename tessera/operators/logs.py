"""Web-log traffic operators: parse, filter counts, daily counts, 4-hour band
averages, top requested files.

Scale notes: a log is a plain line table, so the heavy part of every
operator is a map-side expression followed by a partial aggregation; the
shuffles carry at most (bands x days) or (distinct file names) rows per
task, and each line is parsed once. gzip text is not splittable: read it
with ``sources.files.read_lines``, which spreads a single-split read over
the task slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.logs import (
    HOURS_PER_BAND, HTML_SUFFIX, any_line_time, band_range, hour_band, html_file_name, line_time, month_token,
)


def month_lines(lines: DataFrame, month: str, year: int) -> DataFrame:
    """Keep lines of one month (a substring filter, pushed to Parquet scans)."""
    return lines.filter(F.col("value").contains(month_token(month, year)))


def parse_access_log(lines: DataFrame, month: str, year: int,
                     valid_only: bool = False) -> DataFrame:
    """value -> value, ts (NULL if the line has no valid timestamp), day, hour,
    hour_band. Lines outside the month are dropped, with ``valid_only`` also
    those without a timestamp: by a generator, as a filter on the parsed
    value would be pushed below the projection and parse every line twice."""
    ts = line_time("value", month, year)
    if valid_only:
        ts = F.explode(F.array_compact(F.array(ts)))
    return (month_lines(lines, month, year)
            .select("value", ts.alias("ts"))
            .select("value", "ts",
                    F.dayofmonth("ts").alias("day"),
                    F.hour("ts").alias("hour"),
                    hour_band(F.hour("ts")).alias("hour_band")))


def log_filter_counts(lines: DataFrame, month: str, year: int) -> DataFrame:
    """One row, one pass: all lines, lines of the month, of those the lines
    requesting an .html file and the lines without a parseable timestamp."""
    token = month_token(month, year)
    in_month = F.col("value").contains(token)
    ts = line_time("value", month, year)
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(in_month).alias("n_month"),
        F.count_if(in_month & F.col("value").contains(HTML_SUFFIX)).alias("n_html"),
        F.count_if(in_month & ts.isNull()).alias("n_unparsed"),
    )


def band_day_cells(parsed: DataFrame) -> DataFrame:
    """(hour_band, day, n, month_days): requests per 4-hour band and day.

    One map-side partial aggregate over the parsed lines; everything about
    days and bands is derived from these at most 6 x 31 cells. count(ts)
    leaves unparseable lines in a NULL cell with n = 0 that the consumers
    drop after aggregating: a filter on the parsed value before the
    aggregate would be pushed into the scan-side filter and parse every
    line twice."""
    return (parsed.groupBy("hour_band", "day")
            .agg(F.count("ts").alias("n"),
                 F.max(F.dayofmonth(F.last_day("ts"))).alias("month_days")))


def daily_counts(parsed: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Requests per day of month, ascending; unparseable lines excluded."""
    cells = band_day_cells(parsed) if cells is None else cells
    return (cells.groupBy("day").agg(F.sum("n").alias("requests"))
            .filter(F.col("requests") > 0)
            .orderBy("day"))


def hour_band_averages(parsed: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Requests per 4-hour band and their average per day, once over the days
    actually observed and once over all calendar days of the month (days
    without traffic count as zero). Both divisors come from the band-day
    cells, so no literal day count and no join is needed."""
    cells = band_day_cells(parsed) if cells is None else cells
    everything = Window.partitionBy()  # <= 6 bands x 31 days of one month (+ the NULL cell)
    cells = cells.select(
        "hour_band", "n",
        F.size(F.collect_set("day").over(everything)).cast("bigint").alias("observed_days"),
        F.max("month_days").over(everything).cast("bigint").alias("calendar_days"))
    return (cells.groupBy("hour_band")
            .agg(F.sum("n").alias("requests"),
                 F.first("observed_days").alias("observed_days"),
                 F.first("calendar_days").alias("calendar_days"))
            .select("hour_band", band_range("hour_band").alias("band_range"), "requests",
                    "observed_days", "calendar_days",
                    F.try_divide("requests", "observed_days").alias("avg_per_observed_day"),
                    F.try_divide("requests", "calendar_days").alias("avg_per_calendar_day"))
            .filter(F.col("requests") > 0)
            .orderBy("hour_band"))


def calendar_spine(first: Column, last: Column, source: DataFrame) -> DataFrame:
    """(date, hour_band): every 4-hour band of every day from ``first`` to
    ``last``, both included; these are aggregates over ``source`` and the table
    has 6 rows a day of that span, whatever the size of ``source``."""
    bands = F.array(*[F.lit(str(b)) for b in range(1, 24 // HOURS_PER_BAND + 1)])
    span = source.agg(first.alias("first"), last.alias("last")).filter(F.col("first").isNotNull())
    days = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))
    return days.select("date", F.explode(bands).alias("hour_band"))


def traffic_calendar(lines: DataFrame) -> DataFrame:
    """(date, hour_band, requests, month_requests, month_average): requests of
    every band of every day of the months the log touches, 0 where there were
    none, with the band's total and average per calendar day of that month.

    The log is parsed and counted in one partial aggregate; what is joined
    with the calendar, and summed by month, has 6 rows a day."""
    parsed = lines.select(any_line_time("value").alias("ts"))
    # a NULL cell for lines without a time, dropped when joined: a filter here
    # would be pushed below the parse and run it twice
    cells = (parsed.groupBy(F.to_date("ts").alias("date"), hour_band(F.hour("ts")).alias("hour_band"))
             .agg(F.count("ts").alias("n")).checkpoint(eager=True))
    spine = calendar_spine(F.trunc(F.min("date"), "month"), F.last_day(F.max("date")), cells)
    filled = spine.join(cells, ["date", "hour_band"], "left").select(
        "date", "hour_band", F.coalesce("n", F.lit(0)).cast("bigint").alias("requests"))
    month = Window.partitionBy("hour_band", F.trunc("date", "month"))  # <= 31 rows
    return filled.select("date", "hour_band", "requests", F.sum("requests").over(month).alias("month_requests"),
                         (F.sum("requests").over(month) / F.count(F.lit(1)).over(month)).alias("month_average"))


def top_files(lines: DataFrame, n: int = 20) -> DataFrame:
    """The n most requested .html file base names (ties by name).

    ``orderBy().limit()`` plans as a TakeOrderedAndProject: each task keeps
    its own top n and only those reach the final merge.
    """
    return (lines.filter(F.col("value").contains(HTML_SUFFIX))
            .groupBy(html_file_name("value").alias("file_name"))
            .agg(F.count(F.lit(1)).alias("requests"))
            .orderBy(F.desc("requests"), F.asc("file_name"))
            .limit(n))
