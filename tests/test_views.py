"""SQL over stored tables and frames."""
import pytest

from tessera.session import scratch_path
from tessera.sources import views as V


@pytest.fixture
def stored(spark):
    path = scratch_path(spark, "it's a table")
    spark.range(100).selectExpr("id", "CAST(id AS DECIMAL(12, 2)) AS price", "concat('x', id % 3) AS kind").write.parquet(path)
    return path


def test_table_view_counts_and_averages(spark, stored):
    df = V.register_table(spark, "odd `name`", stored)
    assert df.count() == 100
    got = spark.sql("SELECT count(*) AS n, avg(price) AS mean FROM `odd ``name``` WHERE kind = 'x1'")
    assert dict(got.dtypes) == {"n": "bigint", "mean": "decimal(16,6)"}
    row = got.first()
    assert row.n == 33 and float(row.mean) == 49.0


def test_filters_and_columns_reach_the_scan(spark, stored):
    V.register_table(spark, "prices", stored)
    plan = spark.sql("SELECT sum(price) FROM prices WHERE kind = 'x2'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,x2)" in plan and "ReadSchema: struct<price:decimal(12,2),kind:string>" in plan


def test_given_schema_options_and_replacement(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;v\n1;2.5\n2;\n")
    df = V.register_table(spark, "t", str(tmp_path / "a.csv"), "csv", "k INT, v DOUBLE", header="true", sep=";")
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(1, 2.5), (2, None)]
    V.register_frame(spark.range(3), "t")
    assert spark.sql("SELECT count(*) FROM t").first()[0] == 3
