from pyspark.sql import functions as F

from tessera.operators import logs as L

LINES = [
    'a.host - - [01/Jan/2024:00:10:00 -0400] "GET /x/aa/index.html HTTP/1.0" 200 1',
    'b.host - - [01/Jan/2024:03:59:59 -0400] "GET /y/index.html HTTP/1.0" 200 1',
    'c.host - - [02/Jan/2024:04:00:00 -0400] "GET /y/pic.gif HTTP/1.0" 200 1',
    'd.host - - [02/Jan/2024:23:00:00 -0400] "GET /about.html HTTP/1.0" 200 1',
    'garbage /Jan/2024 line',
    'e.host - - [31/Dec/2023:23:00:00 -0400] "GET /old.html HTTP/1.0" 200 1',
]


def lines(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string")


def test_parse_keeps_month_and_nulls_bad_time(spark):
    rows = L.parse_access_log(lines(spark), "Jan", 2024).orderBy("value").collect()
    assert len(rows) == 5  # December line dropped
    bad = [r for r in rows if r.value.startswith("garbage")][0]
    assert bad.ts is None and bad.day is None
    bands = {r.value[:6]: r.hour_band for r in rows if r.ts is not None}
    assert bands == {"a.host": "1", "b.host": "1", "c.host": "2", "d.host": "6"}


def test_filter_counts(spark):
    r = L.log_filter_counts(lines(spark), "Jan", 2024).first()
    assert (r.n_lines, r.n_month, r.n_html, r.n_unparsed) == (6, 5, 3, 1)


def test_hour_bands_divisors(spark):
    res = {r.hour_band: r for r in L.hour_band_averages(L.parse_access_log(lines(spark), "Jan", 2024)).collect()}
    assert set(res) == {"1", "2", "6"}
    assert res["1"].requests == 2 and res["1"].observed_days == 2 and res["1"].calendar_days == 31
    assert res["1"].avg_per_observed_day == 1.0 and abs(res["1"].avg_per_calendar_day - 2 / 31) < 1e-15
    assert res["6"].band_range == "20:00:00-23:59:59"


def test_top_files_base_name_and_ties(spark):
    top = L.top_files(L.month_lines(lines(spark), "Jan", 2024), n=2).collect()
    assert [(r.file_name, r.requests) for r in top] == [("index", 2), ("about", 1)]


def test_daily_counts_excludes_unparsed(spark):
    d = L.daily_counts(L.parse_access_log(lines(spark), "Jan", 2024)).collect()
    assert [(r.day, r.requests) for r in d] == [(1, 2), (2, 2)]


def test_parse_time_ignores_session_zone_and_rejects_bad_dates(spark):
    from tessera.functions.logs import parse_log_time
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("08/Mar/2020:02:30:00",), ("31/Feb/2024:10:00:00",),
                                    ("01/Foo/2024:10:00:00",), ("1/Jan/2024:10:00:00",)], "t string")
        got = [r.ts for r in df.select(parse_log_time("t").alias("ts")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    import datetime as dt
    assert got == [dt.datetime(2020, 3, 8, 2, 30), None, None, None]
