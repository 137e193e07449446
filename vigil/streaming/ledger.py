"""What a stream has committed, and its keyed state as runs of changes.

Ledger:    one manifest per batch id under ``<root>/commits``, put in place by a rename when all
           that the batch writes is there. It names the batch's outputs and all pieces of state
           that hold after it, so readers see a batch whole or not at all, and a batch that is
           delivered again after its commit is done already.
           Rows that a batch reads several times are written once, under ``work``, and go with it:
           plans stay as short as their last step, and nothing is looked at twice.
KeyedLog:  state of many keys. A batch writes only the keys that it touched, as one run; runs are
           dealt into buckets by a hash of the scope, and several of like size are merged into
           one, so a key is rewritten a logarithmic number of times, and one that stays idle is not
           rewritten by what others do. The newest run that has a key holds its value.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vigil.functions.sizing import hint

BUCKETS = 16
# So many runs of like size are merged into one.
FAN_IN = 4


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, as the optimizer can see."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*none)


class Ledger:
    def __init__(self, spark: SparkSession, root: str, keep_batches: int = 10):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep_batches

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def path(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    # -- manifests ---------------------------------------------------------------------------
    def _manifest_path(self, batch_id: int) -> str:
        return self.path(f"commits/{batch_id}.json")

    def committed(self, batch_id: int) -> bool:
        fs, p = self._fs(self._manifest_path(batch_id))
        return fs.exists(p)

    def manifest(self, batch_id: int) -> dict:
        """Before the first batch nothing is there; any other manifest must have been written."""
        if batch_id < 0:
            return {"outputs": [], "runs": {}, "tables": {}, "chunks": [], "spent": []}
        fs, p = self._fs(self._manifest_path(batch_id))
        if not fs.exists(p):
            raise RuntimeError(f"state is lost: {self._manifest_path(batch_id)} is not there")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, batch_id: int, manifest: dict) -> None:
        """Publish the batch, then delete what no manifest of the last ``keep_batches`` names."""
        final = self._manifest_path(batch_id)
        fs, p = self._fs(final)
        _, part = self._fs(f"{self.root}/commits/.{batch_id}.part")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps({"batch": batch_id, **manifest}).encode()))
        out.close()
        if not fs.rename(part, p):
            raise RuntimeError(f"cannot commit {final}")
        old = batch_id - self.keep
        if old >= 0 and self.committed(old):
            later = self._pieces(self.manifest(old + 1)) if old < batch_id else set()
            for piece in self._pieces(self.manifest(old)) - later:
                fs, gone = self._fs(self.path(piece))
                fs.delete(gone, True)

    @staticmethod
    def _pieces(manifest: dict) -> set[str]:
        """State that a manifest names (outputs are never deleted)."""
        runs = {r["path"] for runs in manifest["runs"].values() for r in runs}
        return (runs | set(manifest["tables"].values()) | {c["path"] for c in manifest["chunks"]}
                | set(manifest["spent"]))

    # -- tables --------------------------------------------------------------------------------
    def put(self, name: str, batch_id: int, df: DataFrame | None) -> str | None:
        """Write ``<name>/batch_id=N`` (or remove it: there is nothing) and return its path. ``df`` is
        evaluated once; whether there are rows is asked of what was written."""
        relative = f"{name}/batch_id={batch_id}"
        if df is not None:
            df.write.mode("overwrite").parquet(self.path(relative))
            if not self.spark.read.schema(df.schema).parquet(self.path(relative)).isEmpty():
                return relative
        fs, p = self._fs(self.path(relative))
        fs.delete(p, True)
        if fs.exists(p.getParent()) and not fs.listStatus(p.getParent()):
            fs.delete(p.getParent(), False)
        return None

    def once(self, name: str, batch_id: int, df: DataFrame) -> DataFrame:
        """``df`` written for the time of the batch."""
        path = self.path(f"work/batch_id={batch_id}/{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, batch_id: int) -> None:
        """The batch is over: what it kept for itself goes."""
        fs, p = self._fs(self.path(f"work/batch_id={batch_id}"))
        fs.delete(p, True)

    def table(self, relative: str | None, schema: StructType) -> DataFrame:
        if relative is None:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path(relative))


def committed_output(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The rows of an output of all committed batches (with ``batch_id``); ``schema`` names the
    columns to read. What a batch has written without its commit is not seen."""
    root = root.rstrip("/")
    done = spark.read.schema("batch long, outputs array<string>").json(f"{root}/commits/*.json")
    batches = [r.batch for r in done.where(F.array_contains("outputs", name)).select("batch").collect()]
    schema = f"{schema}, batch_id long"
    if not batches:
        return empty(spark, schema)
    return (spark.read.schema(schema).option("basePath", f"{root}/{name}")
            .parquet(*[f"{root}/{name}/batch_id={b}" for b in sorted(batches)]))


class KeyedLog:
    """The state named ``name``, one row per ``key`` (``scope`` is one of its columns)."""

    def __init__(self, ledger: Ledger, name: str, key: list[str], schema: StructType):
        self.ledger, self.name, self.key = ledger, name, key
        self.schema = schema
        self.values = [c for c in schema.fieldNames() if c not in key]

    @staticmethod
    def _bucket(scope: Column) -> Column:
        return F.pmod(F.xxhash64(scope), F.lit(BUCKETS)).cast("int")

    def _read(self, runs: list[dict]) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        one = [self.ledger.spark.read.schema(schema).parquet(self.ledger.path(r["path"]))
               .withColumn("_run", F.lit(i)) for i, r in enumerate(runs)]
        return reduce(DataFrame.unionByName, one)

    def _newest(self, rows: DataFrame) -> DataFrame:
        # (numbers one by one go by hash, in a struct they would be sorted)
        return rows.groupBy(*self.key).agg(*[F.max_by(c, "_run").alias(c) for c in self.values])

    def all(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return empty(self.ledger.spark, self.schema)
        return self._newest(self._read(runs)).select(*self.schema.fieldNames())

    def lookup(self, runs: list[dict], scopes: DataFrame, small: bool) -> DataFrame:
        """The rows of the given scopes (column ``scope``). Only their buckets are read."""
        if not runs:
            return empty(self.ledger.spark, self.schema)
        asked = scopes.select(F.col("scope").alias("_s")).distinct().withColumn("_b", self._bucket(F.col("_s")))
        rows = self._read(runs)
        found = rows.join(hint(asked, small), (F.col("bucket") == F.col("_b"))
                          & F.col("scope").eqNullSafe(F.col("_s")), "left_semi")
        return self._newest(found).select(*self.schema.fieldNames())

    def _write(self, path: str, rows: DataFrame) -> DataFrame:
        dealt = rows.withColumn("bucket", self._bucket(F.col("scope")))
        dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            self.ledger.path(path))
        return self.ledger.spark.read.schema(rows.schema).parquet(self.ledger.path(path))

    def append(self, runs: list[dict], batch_id: int, delta: DataFrame) -> tuple[DataFrame, str]:
        """Write the batch's run (its rows may have further columns); returns it as a table."""
        path = f"{self.name}/run={batch_id}-{batch_id}"
        return self._write(path, delta), path

    def settle(self, runs: list[dict], batch_id: int, path: str, rows: int) -> list[dict]:
        """The runs after the batch's own, of ``rows`` rows: the last ones are merged when
        ``FAN_IN`` of like size have come together."""
        runs = [*runs, {"path": path, "rows": rows, "first": batch_id}]
        total, k = rows, len(runs) - 1
        while k > 0 and runs[k - 1]["rows"] <= 2 * total:
            k -= 1
            total += runs[k]["rows"]
        if len(runs) - k < FAN_IN:
            return runs
        first = runs[k]["first"]
        merged = f"{self.name}/run={first}-{batch_id}-merged"
        n = self._write(merged, self.all(runs[k:])).count()
        return [*runs[:k], {"path": merged, "rows": n, "first": first}]
