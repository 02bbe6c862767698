"""JDBC exchange: pruned and pushed-down scans, range-partitioned scans, SQL views,
and job-atomic upserts.

Reads use Spark's built-in JDBC source, which prunes columns and pushes
filters into the generated SELECT (``.explain`` shows ``PushedFilters``).
Writes that must be atomic (upsert by key, additive upsert, stream commits)
stage the rows from the executors into a staging table, then run one
``MERGE`` and any bookkeeping in **one transaction on the driver**, so a
failed task or job leaves the target untouched.

Tests use embedded in-memory Derby (ships with Spark, runs inside the JVM,
opens no port).  An in-memory Derby database is visible only to its own JVM,
so on a cluster the URL must name a real database server.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

DERBY_DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"
FETCH_SIZE = 1000


def derby_memory_url(name: str | None = None) -> str:
    """A fresh embedded in-memory Derby database (local runs and tests)."""
    return f"jdbc:derby:memory:{name or 'tessera_' + uuid.uuid4().hex[:12]};create=true"


def driver_for(url: str) -> str | None:
    return DERBY_DRIVER if url.startswith("jdbc:derby:") else None


def _options(url: str, table: str | None = None, query: str | None = None, user: str | None = None,
             password: str | None = None, fetchsize: int = FETCH_SIZE) -> dict[str, str]:
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if table:
        opts["dbtable"] = table
    if query:
        opts["query"] = query
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    drv = driver_for(url)
    if drv:
        opts["driver"] = drv
    return opts


def jdbc_scan(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
              predicates: Sequence[str] | None = None, user: str | None = None, password: str | None = None,
              fetchsize: int = FETCH_SIZE) -> DataFrame:
    """Scan a table; selected columns and filters are pushed into the database query.

    Without partitioning options the scan is one partition.  With
    ``partition_column/lower/upper/num_partitions`` it is split into id ranges
    (first and last open-ended, so no row is lost); ``predicates`` gives one
    partition per explicit WHERE fragment instead.
    """
    opts = _options(url, table, user=user, password=password, fetchsize=fetchsize)
    if predicates:
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    reader = spark.read.format("jdbc").options(**opts)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(lower),
                                upperBound=str(upper), numPartitions=str(num_partitions))
    return reader.load()


def register_view(spark: SparkSession, name: str, url: str, table: str, user: str | None = None,
                  password: str | None = None) -> None:
    """``CREATE TEMPORARY VIEW name USING jdbc OPTIONS (...)``: the source as a SQL view."""
    opts = _options(url, table, user=user, password=password)
    body = ",\n  ".join(f"{k} '{v}'" for k, v in opts.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING jdbc OPTIONS (\n  {body}\n)")


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", user: str | None = None,
               password: str | None = None, create_columns: str | None = None) -> None:
    """Plain parallel write from the executors (one connection per task)."""
    opts = _options(url, table, user=user, password=password)
    w = df.write.format("jdbc").options(**opts).mode(mode)
    if create_columns:
        w = w.option("createTableColumnTypes", create_columns)
    w.save()


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def run_transaction(spark: SparkSession, url: str, statements: Iterable[str | tuple[str, int]],
                    user: str | None = None, password: str | None = None) -> list[int]:
    """Run statements in one transaction on the driver; return their update counts.

    A statement may be given as ``(sql, expected_count)``: any other count
    rolls the whole transaction back and raises.  This is the only place the
    session's JVM gateway is used (plain ``java.sql``).
    """
    jvm = spark.sparkContext._jvm
    drv = driver_for(url)
    if drv:
        jvm.java.lang.Class.forName(drv)
    conn = (jvm.java.sql.DriverManager.getConnection(url, user, password) if user is not None
            else jvm.java.sql.DriverManager.getConnection(url))
    counts: list[int] = []
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        for s in statements:
            sql, expected = (s, None) if isinstance(s, str) else s
            n = stmt.executeUpdate(sql)
            if expected is not None and n != expected:
                raise RuntimeError(f"expected {expected} row(s), got {n}: {sql}")
            counts.append(n)
        conn.commit()
        return counts
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def query_rows(spark: SparkSession, url: str, sql: str, user: str | None = None,
               password: str | None = None) -> list[tuple]:
    """Small driver-side read (ledger rows, a handful of values), not for data."""
    jvm = spark.sparkContext._jvm
    drv = driver_for(url)
    if drv:
        jvm.java.lang.Class.forName(drv)
    conn = (jvm.java.sql.DriverManager.getConnection(url, user, password) if user is not None
            else jvm.java.sql.DriverManager.getConnection(url))
    try:
        rs = conn.createStatement().executeQuery(sql)
        n = rs.getMetaData().getColumnCount()
        out = []
        while rs.next():
            out.append(tuple(rs.getObject(i + 1) for i in range(n)))
        return out
    finally:
        conn.close()


def merge_sql(target: str, staging: str, keys: Sequence[str], columns: Sequence[str],
              additive: Sequence[str] = ()) -> str:
    """``MERGE`` of a staging table into a target by key.

    Table names are used as given (Spark creates them unquoted); column names
    are quoted, as Spark's writer creates them quoted.

    Non-key columns are replaced (last write wins), or added to the existing
    value for columns named in ``additive``.
    """
    on = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in keys)
    sets = ", ".join(
        f"{quote(c)} = t.{quote(c)} + s.{quote(c)}" if c in additive else f"{quote(c)} = s.{quote(c)}"
        for c in columns if c not in keys)
    cols = ", ".join(quote(c) for c in columns)
    vals = ", ".join(f"s.{quote(c)}" for c in columns)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    return (f"MERGE INTO {target} t USING {staging} s ON {on}{matched}"
            f" WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")


def upsert_sql(url: str, target: str, staging: str, keys: Sequence[str], columns: Sequence[str],
               additive: Sequence[str] = ()) -> str:
    """The upsert statement of the URL's database: MySQL and MariaDB have no ``MERGE`` and quote names
    with back-quotes; the target's primary key must then be ``keys``."""
    if not url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return merge_sql(target, staging, keys, columns, additive)

    def name(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"
    cols = ", ".join(map(name, columns))
    sets = ", ".join(f"{name(c)} = {target}.{name(c)} + VALUES({name(c)})" if c in additive else f"{name(c)} = VALUES({name(c)})"
                     for c in columns if c not in keys)
    into = f"{target} ({cols}) SELECT {cols} FROM {staging}"
    return f"INSERT INTO {into} ON DUPLICATE KEY UPDATE {sets}" if sets else f"INSERT IGNORE INTO {into}"


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], additive: Sequence[str] = (),
                extra_statements: Sequence[str | tuple[str, int]] = (), user: str | None = None,
                password: str | None = None) -> list[int]:
    """Upsert ``df`` into ``table`` by ``keys``, atomically for the whole job.

    The executors write a staging table in parallel; the driver then runs the
    MERGE (plus ``extra_statements``, e.g. an offset compare-and-set) in one
    transaction and drops the staging table.  ``df`` must be unique per key.
    """
    spark = df.sparkSession
    staging = f"stg_{table}_{uuid.uuid4().hex[:10]}".lower()
    jdbc_write(df, url, staging, mode="overwrite", user=user, password=password)
    try:
        counts = run_transaction(spark, url, [upsert_sql(url, table, staging, keys, df.columns, additive),
                                              *extra_statements], user, password)
    finally:
        run_transaction(spark, url, [f"DROP TABLE {staging}"], user, password)
    return counts
