"""Wiring of the standard frames from a test-table folder.

What several plans read (fact, dense fact, features, labels, star, model) is built once per session
and source folder as Parquet tables, partitioned by date where there is one, in the shared folder
that ``spark.checkpoint.dir`` names; after that a call only makes a scan, so filters and projections
reach the files. The other functions return lazy frames over the source tables.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.operators import clean as C
from cellwatch.operators import facts as Fa
from cellwatch.session import ensure_checkpoint_dir
from cellwatch.sources import fixtures as X
from cellwatch.sources.sinks import write_parquet
from cellwatch.sources.tables import table_path

# (application, source folder, table) -> (state of the sources, path, schema) of what this process has built.
_BUILT: dict[tuple[str, str, str], tuple] = {}
_LOCK = threading.RLock()


def _sources_state(spark, sf_dir: str) -> tuple:
    """Number of the source files, and a sum of hashes of their names, lengths and times (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_path(sf_dir, "events"))
    return tuple(files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first())


def _built(spark, sf_dir: str, name: str, build):
    """What ``build(path)`` returns for a fresh path, made once for each state of the sources.

    Changed source files give a new state, so an old table never answers for them. The path is known to
    others only when the table is whole; a second thread waits for it.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        state = _sources_state(spark, sf_dir)
        if key not in _BUILT or _BUILT[key][0] != state:
            path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}/{name}"
            _BUILT[key] = (state, path, build(path))
        return _BUILT[key][1:]


def stored(spark, sf_dir: str, name: str, build, partition_by: str | None = None) -> DataFrame:
    """The table ``name`` of a source folder: built on the first call, a Parquet scan ever after.

    A table belongs to the session that built it and to its source files as they were then.
    """
    def write(path: str):
        df = build()
        if partition_by:
            df = df.select(*(c for c in df.columns if c != partition_by), partition_by)
        write_parquet(df, path, partition_by=partition_by)
        return df.schema

    path, schema = _built(spark, sf_dir, name, write)
    return spark.read.schema(schema).parquet(path)


def events(spark, sf_dir) -> DataFrame:
    return X.read_events(spark, sf_dir)


def raw_activity(spark, sf_dir) -> DataFrame:
    """Typed raw activity in the reference's raw column names."""
    return X.activity_raw(events(spark, sf_dir))


def dirty_activity(spark, sf_dir) -> DataFrame:
    return X.activity_dirty(events(spark, sf_dir))


def canonical_raw(spark, sf_dir) -> DataFrame:
    """Raw activity with canonical names and types, before any rule is applied."""
    return C.typed_columns(C.rename_canonical(raw_activity(spark, sf_dir)))


def clean_split(spark, sf_dir):
    """(clean, rejected, counts) of the text path with injected junk."""
    return C.clean(dirty_activity(spark, sf_dir))


def clean_activity(spark, sf_dir) -> DataFrame:
    """Clean activity of the typed path: the input of the fact."""
    return C.clean(raw_activity(spark, sf_dir), with_counts=False)[0]


def fact(spark, sf_dir) -> DataFrame:
    return Fa.hourly_grid_summary(clean_activity(spark, sf_dir))


def fact_table(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "fact", lambda: fact(spark, sf_dir), "date")


def dense_fact(spark, sf_dir) -> DataFrame:
    """The densified fact: alerts, features and anomalies all read it. Only plausible dates are filled."""
    def build():
        source = fact_table(spark, sf_dir)
        return Fa.densify_hours(source, Fa.plausible_span(source))
    return stored(spark, sf_dir, "dense", build, "date")


def grid_lookup(spark, sf_dir) -> DataFrame:
    """Grid reference for the grids of the data, as GeoJSON feature lines parsed by Spark."""
    from cellwatch.sources.geojson import grid_lookup as lookup, parse_features

    def build():
        return lookup(parse_features(X.grid_reference_features(X.grid_id_range(events(spark, sf_dir)))))
    return stored(spark, sf_dir, "grid_lookup", build)


def star(spark, sf_dir):
    """(dim_time, dim_grid, fact_activity) of the fact and the grid reference, each stored once."""
    from cellwatch.operators import warehouse as Wh
    source = fact_table(spark, sf_dir)
    dim_t = stored(spark, sf_dir, "dim_time", lambda: Wh.dim_time(source))
    dim_g = stored(spark, sf_dir, "dim_grid", lambda: Wh.dim_grid(source, grid_lookup(spark, sf_dir)))
    return dim_t, dim_g, stored(spark, sf_dir, "fact_activity", lambda: Wh.fact_activity(source, dim_t, dim_g))


def star_rows(spark, sf_dir) -> DataFrame:
    """The warehouse read back through its keys: what the serving queries read."""
    from cellwatch.operators.warehouse import star_view
    return stored(spark, sf_dir, "star_rows", lambda: star_view(*star(spark, sf_dir)), "date")


def features(spark, sf_dir) -> DataFrame:
    from cellwatch.operators.features import rolling_features
    return stored(spark, sf_dir, "features", lambda: rolling_features(dense_fact(spark, sf_dir)))


def labels(spark, sf_dir) -> DataFrame:
    """Features with the activity that followed."""
    from cellwatch.operators import risk as R
    return stored(spark, sf_dir, "labels", lambda: R.future_labels(features(spark, sf_dir), dense_fact(spark, sf_dir)))


def labelled(spark, sf_dir) -> DataFrame:
    """Labels + split + training thresholds + risk label."""
    from cellwatch.operators import risk as R
    return stored(spark, sf_dir, "labelled", lambda: R.risk_labels(R.chrono_split(labels(spark, sf_dir))))


def alerts(spark, sf_dir) -> DataFrame:
    from cellwatch.operators.alerts import rule_alerts
    return rule_alerts(dense_fact(spark, sf_dir))


def anomalies(spark, sf_dir) -> DataFrame:
    from cellwatch.operators.anomaly import anomaly_scores
    return anomaly_scores(dense_fact(spark, sf_dir))


def model(spark, sf_dir):
    """The trained risk model: fitted once, saved, and loaded by every query that needs it."""
    from cellwatch.operators import logistic as L

    def fit(path: str) -> None:
        L.save(spark, L.train(labelled(spark, sf_dir).where(F.col("split") == "train")), path)

    return L.load(spark, _built(spark, sf_dir, "model", fit)[0])


def delivery(spark, sf_dir) -> str:
    """Root folder of a delivery of the source folder: a good load, a failing one, and the good one again."""
    from cellwatch.operators import publish as Pu

    def deliver(root: str) -> None:
        good = raw_activity(spark, sf_dir)
        good = good.select(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                           *(F.col(c).cast("string").alias(c) for c in good.columns if c != "datetime"))
        for run_id, rows, name in (("RUN-1", good, "activity.csv"), ("RUN-2", dirty_activity(spark, sf_dir).drop("event_id"), "dirty.csv"),
                                   ("RUN-3", good, "activity.csv")):
            Pu.run_load(rows, root, run_id, name)

    return _built(spark, sf_dir, "delivery", deliver)[0]
