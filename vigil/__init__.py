"""vigil: sensor-stream analytics on Spark (batch DataFrame/SQL and Structured Streaming).

Layout
------
sources/    message readers (Kafka, files, tables), framing, JSON decode, rejects
functions/  column helpers (text classes, safe casts) and scale helpers (running scans, bounded broadcast)
operators/  running moments, breaches, sensor states, alarm, summaries, line jobs, word counts, baselines
plans/      named end-to-end queries over the driver tables and their DuckDB oracle SQL
streaming/  foreachBatch runner with versioned state tables, sinks
"""

from vigil.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
