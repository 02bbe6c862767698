"""Integer range source, both ends inclusive (S4).

``int_range(spark, start, end)`` is the JVM path (``spark.range``).  The
named format ``int_range`` (options ``from`` and ``to``, names
case-insensitive) is a Python data source split into partitions, each
yielding Arrow batches rather than rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH = 65536


def int_range(spark: SparkSession, start: int, end: int, num_partitions: int | None = None) -> DataFrame:
    """``i int``: every integer from ``start`` to ``end`` inclusive."""
    df = spark.range(start, end + 1, 1, num_partitions) if num_partitions else spark.range(start, end + 1)
    return df.select(F.col("id").cast("int").alias("i"))


class _Slice(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class IntRangeDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "int_range"

    def schema(self) -> str:
        return "i int"

    def reader(self, schema):
        return _IntRangeReader(self.options)


class _IntRangeReader(DataSourceReader):
    def __init__(self, options):
        opts = {k.lower(): v for k, v in options.items()}
        self.lo = int(opts["from"])
        self.hi = int(opts["to"])
        # Default: one partition per ~1M values, at least one.
        default = max(1, min(100_000, (self.hi - self.lo + 1) // 1_000_000 + 1))
        self.n = max(1, int(opts.get("numpartitions", default)))

    def partitions(self):
        total = max(0, self.hi - self.lo + 1)
        step = -(-total // self.n) if total else 0
        out = []
        for p in range(self.n):
            a = self.lo + p * step
            b = min(self.hi, a + step - 1)
            if step and a <= b:
                out.append(_Slice(a, b))
        return out or [_Slice(1, 0)]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa
        lo, hi = partition.lo, partition.hi
        while lo <= hi:
            top = min(hi, lo + BATCH - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, top + 1, dtype=np.int32))], names=["i"])
            lo = top + 1


def register(spark: SparkSession) -> None:
    """Register the ``int_range`` format.

    The classes are pickled by value, so Python workers need not import this
    package (it may not be on their path, e.g. on a cluster without
    ``--py-files``); the module depends only on pyspark, numpy and pyarrow.
    """
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(IntRangeDataSource)
