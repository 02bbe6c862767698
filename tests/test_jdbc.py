from decimal import Decimal

import pytest

from tessera.sources import jdbc as J
from tessera.sources.int_range import int_range, register

BOATS = [(1, "Tern", "lake", 310.50, 4), (2, "Plover", "lake", 295.00, 6), (3, "Dunlin", "river", 120.25, 2),
         (4, "Avocet", "sea", 880.00, 9), (5, "Knot", "river", 99.75, 3), (6, "Ruff", "lake", 294.50, 5)]
SCHEMA = "id int, name string, water string, rent decimal(8,2), seats int"


@pytest.fixture()
def url(spark):
    url = J.derby_memory_url()
    values = ", ".join(f"({i}, '{n}', '{w}', {r}, {s})" for i, n, w, r, s in BOATS)
    J.run_transaction(spark, url, [
        'CREATE TABLE boat ("id" INT NOT NULL PRIMARY KEY, "name" VARCHAR(20), "water" VARCHAR(20), '
        '"rent" DECIMAL(8, 2), "seats" INT)',
        f"INSERT INTO boat VALUES {values}"])
    return url


def test_view_and_sql(spark, url):
    J.register_view(spark, "boat", url, "BOAT")
    row = spark.sql("SELECT COUNT(*) AS n, AVG(rent) AS a FROM boat WHERE water = 'lake'").first()
    assert row["n"] == 3 and row["a"] == Decimal("300.000000")
    assert str(spark.sql("SELECT AVG(rent) AS a FROM boat").schema["a"].dataType) == "DecimalType(12,6)"


def test_dataframe_as_view(spark, url):
    J.jdbc_scan(spark, url, "BOAT").createOrReplaceTempView("boats")
    assert spark.sql("SELECT SUM(seats) AS s FROM boats WHERE water <> 'sea'").first()["s"] == 20


def test_pushdown_and_pruning_in_plan(spark, url):
    df = J.jdbc_scan(spark, url, "BOAT").where("water = 'lake'").select("rent")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(water,lake)" in plan
    assert "rent" in plan and "name" not in plan
    assert df.count() == 3


def test_range_partitioned_scan_keeps_all_rows(spark, url):
    df = J.jdbc_scan(spark, url, "BOAT", partition_column="id", lower=1, upper=6, num_partitions=2)
    assert df.rdd.getNumPartitions() == 2
    J.run_transaction(spark, url, ["INSERT INTO boat VALUES (70, 'x', 'y', 1, 1)"])
    assert df.count() == 7  # open-ended outer ranges keep ids outside the bounds
    by_pred = J.jdbc_scan(spark, url, "BOAT", predicates=['"id" BETWEEN 1 AND 3', '"id" >= 4'])
    assert by_pred.count() == 7


def test_upsert_is_atomic_and_idempotent(spark, url):
    def rent():
        return {r.id: r.rent for r in J.jdbc_scan(spark, url, "BOAT").collect()}
    rows = spark.createDataFrame([(6, "Ruff", "lake", Decimal(300), 5), (7, "Smew", "sea", Decimal(410), 8)], SCHEMA)
    for _ in range(2):
        J.jdbc_upsert(rows, url, "boat", ["id"])
        assert len(rent()) == 7 and rent()[6] == Decimal(300) and rent()[7] == Decimal(410)
    changed = spark.createDataFrame([(6, "Ruff", "lake", Decimal(1), 5), (8, "Teal", "sea", Decimal(2), 8)], SCHEMA)
    with pytest.raises(Exception):
        J.jdbc_upsert(changed, url, "boat", ["id"], extra_statements=[("DELETE FROM boat WHERE 1 = 0", 1)])
    assert len(rent()) == 7 and rent()[6] == Decimal(300)


def test_upsert_text_by_database():
    sql = J.upsert_sql("jdbc:mysql://h/d", "boat", "stg", ["id"], ["id", "rent", "seats"], additive=["seats"])
    assert sql == ("INSERT INTO boat (`id`, `rent`, `seats`) SELECT `id`, `rent`, `seats` FROM stg "
                   "ON DUPLICATE KEY UPDATE `rent` = VALUES(`rent`), `seats` = boat.`seats` + VALUES(`seats`)")
    assert J.upsert_sql("jdbc:mysql://h/d", "boat", "stg", ["id"], ["id"]).startswith("INSERT IGNORE INTO boat (`id`)")
    assert J.upsert_sql("jdbc:derby:x", "boat", "stg", ["id"], ["id", "rent"]) == J.merge_sql("boat", "stg", ["id"], ["id", "rent"])


def test_int_range_both_ends(spark):
    assert [r["i"] for r in int_range(spark, 1, 5).collect()] == [1, 2, 3, 4, 5]
    register(spark)
    df = spark.read.format("int_range").option("from", 1).option("TO", 100).load()
    assert sorted(r["i"] for r in df.collect()) == list(range(1, 101))


def test_dataframe_upserts(spark):
    from tessera.sinks.upsert import upsert, upsert_add
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    u = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(tuple(r) for r in upsert(t, u, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError, match="repeated key"):
        upsert(t, u.union(u), ["k"])
    ta = spark.createDataFrame([(1, 5), (2, 1)], "k int, n long")
    ua = spark.createDataFrame([(2, 4), (3, 1)], "k int, n long")
    assert sorted(tuple(r) for r in upsert_add(ta, ua, "k", "n").collect()) == [(1, 5), (2, 5), (3, 1)]
