"""Star schema (D7), its analytics (D8) and integrity / reconciliation checks.

Dimensions grow with the data (its hours, the cells of its grid). Their surrogate keys are numbered by
range partitions (``windows.surrogate_key``), and the fact looks them up through joins that AQE
broadcasts when they measure small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.columns import exact_sum, second_floor
from cellwatch.operators.geo import geometry_reference, reference_lookup, vertex_centroid
from cellwatch.operators.windows import surrogate_key

FACT_MEASURES = ["sms_in", "sms_out", "call_in", "call_out", "internet_activity",
                 "total_sms", "total_calls", "total_activity", "internet_share"]


def dim_time(fact: DataFrame) -> DataFrame:
    """time_key 1..n by timestamp; day_of_week here is 1 = Monday ... 7 = Sunday."""
    ts = fact.select(F.expr(second_floor("timestamp")).alias("timestamp")).distinct()
    return (surrogate_key(ts, "timestamp", "time_key")
            .select(F.col("time_key").cast("int").alias("time_key"), "timestamp", F.to_date("timestamp").alias("date"),
                    F.hour("timestamp").alias("hour"), (F.weekday("timestamp") + 1).alias("day_of_week")))


def dim_grid(fact: DataFrame, lookup: DataFrame) -> DataFrame:
    """grid_key 1..n by grid_id over the grids observed in the fact (J6), with vertex-mean
    centroids (P25) and the geometry reference (P23); a grid without geometry keeps NULLs."""
    observed = fact.select("grid_id").distinct()
    ref = reference_lookup(lookup).join(observed, "grid_id", "left_semi")
    c = vertex_centroid(F.col("geometry"))
    ref = ref.select("grid_id", c["lat"].alias("centroid_latitude"), c["lon"].alias("centroid_longitude"),
                     F.lit(True).alias("has_geometry"))
    grids = observed.join(ref, "grid_id", "left")
    return (surrogate_key(grids, "grid_id", "grid_key")
            .select(F.col("grid_key").cast("int").alias("grid_key"), "grid_id", "centroid_latitude", "centroid_longitude",
                    F.when(F.col("has_geometry"), geometry_reference(F.col("grid_id"))).alias("geometry_reference")))


def fact_activity(fact: DataFrame, dim_t: DataFrame, dim_g: DataFrame) -> DataFrame:
    """Many-to-one key lookups (second-precision timestamp key, P21) -> (time_key, grid_key, 9 measures).

    Both dimensions grow with the data, so no size is assumed: AQE broadcasts the one it measures
    as small, else the join shuffles. ``lookup_findings`` checks the keys.
    """
    t = dim_t.select("timestamp", "time_key")
    g = dim_g.select("grid_id", "grid_key")
    keyed = fact.withColumn("timestamp", F.expr(second_floor("timestamp")))
    return (keyed.join(t, "timestamp", "left").join(g, "grid_id", "left")
            .select("time_key", "grid_key", *FACT_MEASURES))


def lookup_findings(fact: DataFrame, dim: DataFrame, on: str, key: str) -> DataFrame:
    """J5 guard: the lookup is many-to-one (no duplicate in ``dim``) and every fact value has a key."""
    from cellwatch.operators.quality import _finding
    twice = dim.groupBy(on).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n"))
    known = dim.where(F.col(key).isNotNull()).select(F.col(on).alias("_known")).distinct()
    missing = (fact.select(on).distinct().join(known, F.col(on) == F.col("_known"), "left_anti")
               .agg(F.count(F.lit(1)).alias("n")))
    return (twice.select(*_finding(f"{key}_many_to_one", F.col("n") == 0, F.col("n"), "0"))
            .unionByName(missing.select(*_finding(f"{key}_found", F.col("n") == 0, F.col("n"), "0"))))


def star(fact: DataFrame, lookup: DataFrame):
    """(dim_time, dim_grid, fact_activity)."""
    dt, dg = dim_time(fact), dim_grid(fact, lookup)
    return dt, dg, fact_activity(fact, dt, dg)


def star_view(dim_t: DataFrame, dim_g: DataFrame, fact_a: DataFrame) -> DataFrame:
    """Fact joined back to both dimensions (inner), the shape the serving queries read."""
    t = dim_t.select("time_key", "timestamp", "date", "hour")
    g = dim_g.select("grid_key", "grid_id")
    return fact_a.join(t, "time_key").join(g, "grid_key")


def orphan_facts(dim_t: DataFrame, dim_g: DataFrame, fact_a: DataFrame) -> DataFrame:
    """Fact rows whose time or grid key has no dimension row (or is NULL)."""
    no_time = fact_a.join(dim_t.select("time_key"), "time_key", "left_anti").withColumn("missing", F.lit("time_key"))
    no_grid = fact_a.join(dim_g.select("grid_key"), "grid_key", "left_anti").withColumn("missing", F.lit("grid_key"))
    return no_time.unionByName(no_grid)


def integrity(dim_t: DataFrame, dim_g: DataFrame, fact_a: DataFrame) -> DataFrame:
    """Orphans, duplicate dimension keys and dimension sizes in one row."""
    orphans = orphan_facts(dim_t, dim_g, fact_a).agg(F.count(F.lit(1))).scalar()
    dup_t = dim_t.groupBy("timestamp").count().where("count > 1").agg(F.count(F.lit(1))).scalar()
    dup_g = dim_g.groupBy("grid_id").count().where("count > 1").agg(F.count(F.lit(1))).scalar()
    rows_t = dim_t.agg(F.count(F.lit(1))).scalar()
    rows_g = dim_g.agg(F.count(F.lit(1))).scalar()
    out = fact_a.agg(F.count(F.lit(1)).alias("fact_rows")).select(
        "fact_rows", rows_t.alias("dim_time_rows"), rows_g.alias("dim_grid_rows"),
        orphans.alias("orphan_rows"), dup_t.alias("duplicate_time_keys"), dup_g.alias("duplicate_grid_ids"))
    return out.withColumn("passed", (F.col("orphan_rows") == 0) & (F.col("duplicate_time_keys") == 0)
                          & (F.col("duplicate_grid_ids") == 0))


def reconciliation(source: DataFrame, star_rows: DataFrame, rel: float = 1e-9, abs_tol: float = 1e-6) -> DataFrame:
    """Rows, total activity (Q22 tolerance) and top grid of the source fact vs the warehouse."""
    def top(df):
        best = (df.groupBy("grid_id").agg(exact_sum("total_activity").alias("v"))
                .agg(F.max(F.struct(F.col("v"), (-F.col("grid_id")).alias("k"))).alias("b")))
        return best.select((-F.col("b.k")).cast("int")).scalar()

    s_rows, s_total = source.agg(F.count(F.lit(1))).scalar(), source.agg(exact_sum("total_activity")).scalar()
    out = star_rows.agg(F.count(F.lit(1)).alias("warehouse_rows"),
                        exact_sum("total_activity").alias("warehouse_total"))
    out = out.select(s_rows.alias("source_rows"), "warehouse_rows", s_total.alias("source_total"),
                     "warehouse_total", top(source).alias("source_top_grid"),
                     top(star_rows).alias("warehouse_top_grid"))
    tol = F.greatest(F.abs(F.col("source_total")) * rel, F.lit(abs_tol))
    return out.withColumn("passed", (F.col("source_rows") == F.col("warehouse_rows"))
                          & (F.abs(F.col("source_total") - F.col("warehouse_total")) <= tol)
                          & (F.col("source_top_grid") == F.col("warehouse_top_grid")))
