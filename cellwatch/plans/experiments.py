"""Tuning experiments (X1-X7) as a user runs them: plans and timings through the noop sink.

Each returns plain Python values (plan text, seconds, counts); they are measurement jobs,
not queries, and are exercised by the tests and the bench.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.columns import exact_sum


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def hotspot_aggregation(fact: DataFrame, n: int = 10) -> DataFrame:
    return (fact.groupBy("grid_id").agg(exact_sum("total_activity").alias("total_activity"))
            .orderBy(F.desc("total_activity"), "grid_id").limit(n))


def formatted_plan(df: DataFrame) -> str:
    """The formatted physical plan text."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def timed_hotspots(fact: DataFrame) -> float:
    """Hotspot aggregation executed through the noop sink."""
    return _timed(lambda: noop(hotspot_aggregation(fact)))


def cache_experiment(df: DataFrame) -> dict:
    """Uncached count, first cached count (fills the cache), second cached count."""
    out = {"uncached": _timed(df.count)}
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out["first_cached"] = _timed(cached.count)
    out["second_cached"] = _timed(cached.count)
    cached.unpersist()
    return out


def repartition_experiment(df: DataFrame, key: str = "date") -> dict:
    """Repartition by a key, then count by that key (the aggregate reuses the partitioning)."""
    r = df.repartition(key)
    before = formatted_plan(r).count("Exchange")
    after = formatted_plan(r.groupBy(key).count()).count("Exchange")
    return {"seconds": _timed(lambda: noop(r.groupBy(key).count())), "extra_exchange": after > before}


def pruning_experiment(wide: DataFrame, cols=("grid_id", "total_activity")) -> dict:
    """Aggregate over all columns vs over two columns; ReadSchema shows the pruning."""
    narrow = wide.select(*cols)
    agg = lambda d: d.groupBy(cols[0]).agg(F.sum(cols[1]))
    return {"wide_seconds": _timed(lambda: noop(agg(wide))),
            "pruned_seconds": _timed(lambda: noop(agg(narrow))),
            "pruned_plan": formatted_plan(agg(narrow))}


def join_experiment(fact: DataFrame, ref: DataFrame, key: str = "grid_id") -> dict:
    """Shuffle join vs broadcast join; both must keep the same row count."""
    shuffle = fact.join(ref.hint("shuffle_merge"), key, "left")
    bcast = fact.join(F.broadcast(ref), key, "left")
    return {"shuffle_seconds": _timed(lambda: noop(shuffle)), "broadcast_seconds": _timed(lambda: noop(bcast)),
            "counts_equal": shuffle.count() == bcast.count(),
            "broadcast_planned": "BroadcastHashJoin" in formatted_plan(bcast)}


def over_partitioning(df: DataFrame) -> dict:
    """Repartition to max(20 x current partitions, 100) and time a count."""
    n = max(20 * df.rdd.getNumPartitions(), 100)
    return {"partitions": n, "seconds": _timed(lambda: df.repartition(n).count())}
