"""Column expressions for common-log-format lines. All built-in functions:
they stay inside whole-stage codegen and never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The month abbreviations of the log's 'dd/Mon/yyyy:HH:mm:ss'
# timestamps and the request-file suffix.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
HTML_SUFFIX = ".html"
HOURS_PER_BAND = 4


def month_token(month: str, year: int) -> str:
    """'/Jan/2024' — the substring every line of that month carries."""
    return f"/{month}/{year}"


def timestamp_text(value: str | Column, month: str, year: int) -> Column:
    """Whole match of 'dd/Mon/yyyy:HH:mm:ss' for the given month; NULL when
    the line has none (``regexp_extract`` returns '' for no match)."""
    pattern = r"\d{2}/" + month + "/" + str(year) + r":\d{2}:\d{2}:\d{2}"
    return F.nullif(F.regexp_extract(value, pattern, 0), F.lit(""))


def parse_log_time(text: str | Column) -> Column:
    """Wall-clock timestamp (no zone) from 'dd/Mon/yyyy:HH:mm:ss' text; NULL
    if malformed. Built from the fields directly, so the result never
    depends on the session time zone (no instant, no daylight-saving gap)."""
    t = F.col(text) if isinstance(text, str) else text

    def part(pos: int, length: int) -> Column:
        return F.substring(t, pos, length).try_cast("int")
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(t, 4, 3)).cast("int")
    # [0-5]\d: a leap second or any other second over 59 is malformed
    well_formed = t.rlike(r"^\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:[0-5]\d$")
    return F.when(well_formed, F.try_make_timestamp_ntz(
        part(8, 4), month, part(1, 2), part(13, 2), part(16, 2), part(19, 2)))


def line_time(value: str | Column, month: str, year: int) -> Column:
    """Wall-clock timestamp of a log line of the given month, NULL if it has
    no valid one: a single regular expression rewrites the line to ISO text
    (lines without a timestamp stay as they are and fail the cast)."""
    pattern = r"(?s)^.*?(\d{2})/" + month + "/" + str(year) + r":(\d{2}:\d{2}:\d{2}).*$"
    iso = F.regexp_replace(value, pattern, f"{year:04d}-{MONTHS.index(month) + 1:02d}-$1 $2")
    return iso.try_cast("timestamp_ntz")


def any_line_time(value: str | Column) -> Column:
    """Wall-clock timestamp of a log line of any month, NULL if it has no
    valid one."""
    text = F.nullif(F.regexp_extract(value, r"\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2}", 0), F.lit(""))
    return parse_log_time(text)


def hour_band(hour: str | Column) -> Column:
    """Hour of day -> '1'..'6', one band per four hours."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return (F.floor(h / HOURS_PER_BAND) + 1).cast("int").cast("string")


def band_range(band: str | Column) -> Column:
    """'1' -> '00:00:00-03:59:59', ..., '6' -> '20:00:00-23:59:59'."""
    b = F.col(band) if isinstance(band, str) else band
    start = (b.cast("int") - 1) * HOURS_PER_BAND
    return F.format_string("%02d:00:00-%02d:59:59", start, start + HOURS_PER_BAND - 1)


def html_file_name(value: str | Column) -> Column:
    """Text before the first '.html', after the last '/': '/a/b/xx.html' -> 'xx'."""
    head = F.substring_index(value, HTML_SUFFIX, 1)
    return F.element_at(F.split(head, "/"), -1)
