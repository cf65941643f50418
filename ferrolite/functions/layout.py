"""Input layout."""

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores, ahead of CPU-heavy work.

    A small or single-row-group file arrives as one task; a large table already has
    more splits than cores and is returned as it is. Use it on plain scans only:
    asking for the number of splits is free there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
