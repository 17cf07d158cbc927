"""Spread CPU-heavy row-wise work over the cluster's cores.

A source with fewer partitions than the cluster has task slots (one small
parquet file, a handful of large DICOM files) would run the tokeniser in a
few tasks. ``spread`` adds one round-robin exchange in that case only; with a
large input (thousands of splits) it leaves the plan untouched, so no shuffle
is added at scale. Checking the partition count plans the query but runs no
job. Use it before Python-side work (Arrow functions, pandas UDFs); plain
SQL over a few hundred thousand rows is faster without the extra exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    sc = df.sparkSession.sparkContext
    return max(1, sc.defaultParallelism * 2)


def spread(df: DataFrame) -> DataFrame:
    target = target_partitions(df)
    if df.rdd.getNumPartitions() < target // 2:
        return df.repartition(target)
    return df
