"""Broadcast only what is proven small."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

# Largest side we hand to every executor: rows of a few narrow columns (~50 MB at 100 B/row).
MAX_BROADCAST_ROWS = 500_000


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once as a parquet table under the session's shared checkpoint folder and
    read it back: lineage is cut (a lost executor does not recompute the upstream scan) and the
    plan is computed exactly once (``checkpoint()`` would compute it a second time to write).
    Used for the small aggregate tables that later stages read more than once, and for the
    depth table between the two dependent scans of line reassembly."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/vigil-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      name: str = "t") -> tuple[DataFrame, bool]:
    """Materialize ``df`` and count it. The flag says whether it may be broadcast (at most
    ``max_rows`` rows); callers hint only then, larger sides stay a normal shuffled join input
    (AQE splits skewed partitions)."""
    m = materialize(df, name)
    return m, m.count() <= max_rows


def hint(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df
