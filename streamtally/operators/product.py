"""Pairing every row of one table with every row of another, where that is the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SALTS = 64


def each_with_all(rows: DataFrame, dimension: DataFrame, salt_by: str) -> DataFrame:
    """`rows` x `dimension` as an equi-join on a salt: a row has one salt, taken from column
    `salt_by`, and the dimension is repeated once per salt. The planner broadcasts the dimension where its
    measured size allows; SALTS bounds what it grows by. Beyond that it is shuffled, and adaptive execution
    splits the rows of a salt over as many tasks as they need. The product itself is the result. Of two sides,
    pass the one that grows less as `dimension`."""
    salts = min(SALTS, max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, "_salt").drop("_salt")
