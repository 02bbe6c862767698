from frames import lines
from pyspark.sql import functions as F

from tessera.operators import logs as L


def _parse(spark, *rows):
    out = L.parse_log_lines(lines(spark, *rows))
    return [(r["time"].strftime("%Y-%m-%d %H:%M") if r["time"] else None, r["level"])
            for r in out.select("time", "level").collect()]


def test_log_line_pattern_and_smart_dates(spark):
    assert _parse(spark, "2014-12-11 18:33:52 ERROR x") == [("2014-12-11 18:33", "ERROR")]
    assert _parse(spark, "2014-12-11 18:33:52 ERRORx") == [("2014-12-11 18:33", "ERROR")]
    assert _parse(spark, "2014-12-11 18:33:52 ERRORS") == [("2014-12-11 18:33", "ERRORS")]
    assert _parse(spark, "2014-02-30 00:00:00 ERROR") == [("2014-02-28 00:00", "ERROR")]
    assert _parse(spark, "2014-12-11 24:00:00 ERROR") == [("2014-12-12 00:00", "ERROR")]
    assert _parse(spark, "2014-02-32 00:00:00 ERROR") == []
    assert _parse(spark, "xxxx-12-11 18:33:52 ERROR") == []
    assert _parse(spark, "2014-12-11 18:33:52\tERROR") == []


def test_errors_per_minute_counts_only_error(spark):
    df = L.parse_log_lines(lines(spark, "2014-12-11 18:33:52 ERROR a", "2014-12-11 18:33:59 ERROR b",
                                 "2014-12-11 18:34:00 ERRORS c", "2014-12-11 18:35:00 INFO d"))
    got = [(r["log_time"].strftime("%H:%M"), r["log_count"]) for r in L.errors_per_minute(df).collect()]
    assert got == [("18:33", 2)]


def test_tab_logs_counts_and_rejects(spark):
    rows = ["2014-12-11 18:33:52\tERROR\tJava\tm1", "2014-12-11 18:33:53\tERROR\tMySQL\tm2",
            "2014-12-11 18:33:54\tINFO\tMySQL\tm3", "2014-12-11 18:33:55\tERROR\tMySQL\tm4",
            "2014-12-11 18:33:56\tERROR", "bad line", "2014-12-11 18:33:57\tWARN"]
    logs, rejects = L.parse_tab_logs(lines(spark, *rows))
    assert L.error_count(logs).first()["n_errors"] == 3
    assert {r["app"]: r["n"] for r in L.errors_by_app(logs).collect()} == {"Java": 1, "MySQL": 2}
    assert [r["message"] for r in L.errors_of(logs, "MySQL", 10).collect()] == ["m2", "m4"]
    assert sorted(r["value"] for r in rejects.collect()) == ["2014-12-11 18:33:56\tERROR", "bad line"]
    assert logs.where(F.col("level") == "WARN").count() == 1
