from pyspark.sql import functions as F

from tessera.functions.logparse import BYTES_COL, STATUS_COL, day_of, hour_of, parse_access_log
from tessera.operators import calendar, rollup

GOOD = 'h.x.de - - [01/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 12'


def _parse(spark, lines, drop=True):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return parse_access_log(df, drop_bad=drop)


def test_good_line(spark):
    row = _parse(spark, [GOOD]).first()
    assert row["host"] == "h.x.de"
    assert row["timestamp"] == "01/Jul/1995:00:00:01 -0400"
    assert row["request"] == "GET / HTTP/1.0"
    assert row[STATUS_COL] == 200 and row[BYTES_COL] == 12


def test_bad_bytes_one_word_and_empty_lines_dropped(spark):
    lines = [GOOD.replace(" 12", " -"), "oneword", ""]
    assert _parse(spark, lines).count() == 0
    kept = _parse(spark, lines, drop=False).collect()
    assert [r[BYTES_COL] for r in kept] == [None, None, None]


def test_user_not_dash_gives_empty_time_and_is_kept(spark):
    row = _parse(spark, [GOOD.replace("- - [", "- bob [")]).first()
    assert row["timestamp"] == ""


def test_inner_quote_takes_last_two_quotes(spark):
    row = _parse(spark, [GOOD.replace('"GET / HTTP/1.0"', '"GET "x" HTTP/1.0"')]).first()
    assert row["request"] == " HTTP/1.0"


def test_day_and_hour_by_position(spark):
    df = spark.createDataFrame([("01/Jul/1995:13:00:01 -0400",), ("",)], "t string")
    rows = df.select(day_of(F.col("t")).alias("d"), hour_of(F.col("t")).alias("h")).collect()
    assert (rows[0]["d"], rows[0]["h"]) == (1, 13)
    assert (rows[1]["d"], rows[1]["h"]) == (None, None)


def _logs(spark):
    rows = []
    for host, n in [("a.de", 5), ("b.de", 5), ("c.de", 2), ("x.ca", 1), ("de", 4), ("y.com", 3)]:
        rows += [(host, f"0{1 + i % 3}/Jul/1995:0{i % 5}:00:00 -0400") for i in range(n)]
    return spark.createDataFrame(rows, "host string, timestamp string")


def test_country_counts_and_suffix_rule(spark):
    got = {r["country_code"]: r["requests"] for r in rollup.country_requests(_logs(spark)).collect()}
    # a bare "de" host does not end in ".de"; sg has no rows and reports 0
    assert got == {"de": 12, "ca": 1, "sg": 0}


def test_top_hosts_ties_by_name_and_rest_row(spark):
    rows = rollup.host_share_rest(_logs(spark), k=2).filter("country_code = 'de'").orderBy("rank").collect()
    assert [(r["rank"], r["host"], r["count"]) for r in rows] == [(1, "a.de", 5), (2, "b.de", 5), (3, "Rest", 2)]
    assert abs(sum(r["percent"] for r in rows) - 100.0) < 1e-6


def test_grid_is_dense_and_sums_to_busiest_host(spark):
    grid = calendar.busiest_host_grid(_logs(spark)).filter("country_code = 'de'")
    assert grid.count() == 31 * 24
    assert grid.select("host").distinct().first()["host"] == "a.de"
    assert grid.agg(F.sum("count")).first()[0] == 5


def test_large_replies_and_suffixes_of_several_parts(spark):
    from pyspark.sql import functions as F

    from tessera.functions.logparse import country_of, parse_access_log
    line = 'a.co.uk - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 3000000000'
    row = parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert row["bytes in the reply"] == 3_000_000_000
    hosts = spark.createDataFrame([("a.co.uk",), ("b.uk",), ("couk",), (None,)], "h string")
    out = [r[0] for r in hosts.select(country_of(F.col("h"), ["uk", "co.uk"])).collect()]
    assert out == ["co.uk", "uk", None, None]
