"""How input is dealt to tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes per core, and in all, below which an input is dealt anew before costly expressions.
PER_CORE, AT_MOST = 32 << 20, 1 << 30
#: Bytes of a part, by the optimizer's estimate, where a task keeps much of what it reads; and the most parts to make.
PER_PART, MOST_PARTS = 8 << 20, 4096
#: Rows of a part of all inputs that meet by a key.
PART_ROWS = 500_000


def _size(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """A small input in as many parts as there are cores: a file of one row group is one task, however costly its rows.

    By the optimizer's estimate of the size; a large input has tasks enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if _size(df) < min(PER_CORE * cores, AT_MOST) else df


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in parts whose number grows with the input, so that what a task gathers of its part (distinct values, say) doesn't.

    Rows are dealt by their number, which sorts nothing, whatever their values.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, min(MOST_PARTS, -(-_size(df) // PER_PART)))
    return df.withColumn("_place", F.monotonically_increasing_id()).repartition(parts, "_place").drop("_place")


def together(key: str, *dfs: DataFrame) -> list[DataFrame]:
    """Inputs that meet by ``key``, each dealt by it into the same parts, whose number grows with the rows of all: what a task
    gathers of a part (groups, sorted rows) doesn't, and neither groups nor joins by the key shuffle again.

    Rows are counted first: of well compressed files the optimizer's estimate tells little.
    """
    rows = reduce(DataFrame.unionAll, [df.select(F.lit(1).alias("n")) for df in dfs]).count()
    parts = max(dfs[0].sparkSession.sparkContext.defaultParallelism, min(MOST_PARTS, -(-rows // PART_ROWS)))
    return [df.repartition(parts, key) for df in dfs]


def apart(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a branch of a union whose tasks are its own: a union of branches that are dealt alike by a text key would run
    all of them in one task, with the memory of all."""
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))
