"""Small input frames for tests."""


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")
