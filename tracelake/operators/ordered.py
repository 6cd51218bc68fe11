"""Running counts inside ordered groups, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.session import written


def running_counts(rows: DataFrame, group: str, order: list[Column], counts: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the running sum of its column up to and with the row, in the group's order.

    The rows are cut into ranges of (group, order), so that a large group lies in many ranges. The sums of each range
    are added up by range, and a row gets those of its group's earlier ranges and the running sum in its own. ``order``
    must be total; the names must be new.
    """
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    named = rows.withColumns({f"_order_{i}": c for i, c in enumerate(order)} | {f"_count_{k}": c.cast("long") for k, c in counts.items()})
    keys = [f"_order_{i}" for i in range(len(order))]
    cut = written(named.repartitionByRange(int(parts), group, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = cut.groupBy(group, "_range").agg(*(F.sum(f"_count_{k}").alias(f"_sum_{k}") for k in counts))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), *(F.sum(f"_sum_{k}").over(earlier).alias(f"_before_{k}") for k in counts)).where(" or ".join(f"_before_{k} is not null" for k in counts))
    within = Window.partitionBy(group, "_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({k: F.sum(f"_count_{k}").over(within) for k in counts})
    joined = local.join(offsets, (F.col(group) == F.col("_group")) & (F.col("_range") == F.col("_of")), "left")
    return joined.withColumns({k: F.col(k) + F.coalesce(f"_before_{k}", F.lit(0)) for k in counts}).select(*rows.columns, *counts)
