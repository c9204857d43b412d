from conftest import SF_SMALL

from tessera.functions.logparse import parse_access_log
from tessera.operators import rollup
from tessera.plans import logs
from tessera.session import scratch_path
from tessera.sources.files import read_text_lines, write_text_lines
from tessera.streaming.log_stream import country_requests_stream, start_to_memory


def test_stream_rollup_equals_batch(spark):
    path = logs.log_lines(spark, SF_SMALL).inputFiles()[0].rsplit("/", 1)[0]
    q = start_to_memory(country_requests_stream(spark, path, files_per_trigger=2), "req_stream")
    try:
        q.processAllAvailable()
        got = {r["country_code"]: r["requests"] for r in spark.sql("SELECT * FROM req_stream").collect()}
    finally:
        q.stop()
    batch = {r["country_code"]: r["requests"] for r in logs.country_requests(spark, SF_SMALL).collect()
             if r["requests"] > 0}
    assert got == batch


def test_gzip_text_round_trip(spark):
    lines = ['h.x.de - - [01/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 12', "oneword"]
    path = scratch_path(spark, "t-text")
    write_text_lines(spark.createDataFrame([(x,) for x in lines], "value string"), path)
    back = read_text_lines(spark, path)
    assert sorted(r.value for r in back.collect()) == sorted(lines)
    assert parse_access_log(back).count() == 1
    assert rollup.country_requests(parse_access_log(back)).filter("country_code = 'de'").first()["requests"] == 1


def test_readme_usage_on_files(spark):
    from tessera.functions.logparse import parse_access_log
    from tessera.operators import calendar, models, rollup, split
    from tessera.plans import ratings
    from tessera.sources.files import read_csv, write_csv
    parsed = parse_access_log(read_text_lines(spark, logs_dir(spark)))
    assert rollup.host_share_rest(parsed, k=9).count() > 0
    assert calendar.busiest_host_grid(parsed).count() % (31 * 24) == 0
    path = scratch_path(spark, "t-ratings")
    write_csv(ratings.ratings(spark, SF_SMALL), path)
    rat = read_csv(spark, path, schema="userId int, movieId int, rating double, timestamp long")
    train, test = split.time_split(split.time_ranked(rat, "timestamp"), 0.8)
    model = models.als(rank=5, max_iter=3).fit(train)
    assert model.transform(test).count() <= test.count()


def logs_dir(spark):
    return logs.log_lines(spark, SF_SMALL).inputFiles()[0].rsplit("/", 1)[0]
