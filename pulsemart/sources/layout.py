"""Physical layout of what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of a table partition together before it is written.

    A rebalance, unlike a repartition, splits a partition that holds far more
    rows than the others over several tasks and merges small ones, so neither
    one hot day nor many tiny files become a problem.
    """
    return df.hint("rebalance", *columns)


def in_tasks(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows over as many tasks as the session's shuffles have, however few bytes they hold.

    Adaptive merging goes by bytes: texts that are matched against many terms
    would end up in a task or two per core, and the last ones keep all waiting.
    A join by ``keys`` that follows keeps this layout.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Session setting: partitions to deal a table's rows over when it is read.
SPREAD_SETTING = "spark.pulsemart.spreadPartitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out a table that is stored in very few row groups, if the session asks for it.

    A file with one row group is one task, however costly its rows are.  The
    plan depends on the setting alone; without it nothing is shuffled.
    """
    partitions = df.sparkSession.conf.get(SPREAD_SETTING, None)
    return df.repartition(int(partitions), *keys) if partitions else df
