"""Streaming anomaly pipeline: records -> messages -> readings -> running statistics ->
breaches -> sensor states -> alarm commands, once per micro-batch (``foreachBatch``).

Outputs under ``root``, one folder per ``batch_id`` that has rows: ``events``, ``commands``,
``rejects``, ``statistics`` (count, mean, std and band of every sensor of the scopes that the batch
touched) and, if asked for, ``values``. State:

    sensors   (scope, sensor, k, n, a, b, state)   moments and warning state, a ``KeyedLog``
    alarm     (scope, alarm, sent, last)           alarm state; ``sent`` and ``last`` are the first
              and last batch that sent the command now pending; a ``KeyedLog``
    frames    (topic, partition, offset, depth, last, m, begun)  where a topic partition ends
              inside a message (line framing); its lines stay in the ``open`` chunks that their
              batches wrote until the message closes

A batch reads the state of the scopes that it touches and writes theirs only. All that it wrote
becomes visible with its manifest (see ``ledger``): read outputs through ``committed_output``. A
batch that is delivered again before its commit overwrites what it had written, one that is
delivered after it is left as it is. A manifest that should exist and does not stops the stream.

Answers to commands (scope, batch_id, ack) are a second stream, united with the records. Answers
take effect at the start of the batch they come in: one to any batch from the first to the last
that sent the command still pending settles it, however late.

Merging uses the same fixed shift as the table form: K is the first reading ever of the key,
a batch contributes n, a = n (mean_b - K), b = m2_b + n (mean_b - K)^2, so merging is addition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from vigil.functions.joins import null_safe_join
from vigil.functions.sizing import MAX_BROADCAST_ROWS, hint
from vigil.operators.breach import breach_code
from vigil.operators.moments import KEY, batch_partials
from vigil.schema import (ALARM_CODE_OFF, ALARM_CODE_ON, ALARM_PRIORITY, SENSOR_FIELDS,
                          SIGMAS)
from vigil.sources.framing import (assemble, carried_line, framed_lines, line_pieces, open_ends,
                                   parse_records, unpivoted, wide_columns)
from vigil.streaming.ledger import KeyedLog, Ledger, committed_output


def _schema(**columns) -> StructType:
    return StructType([StructField(c, t()) for c, t in columns.items()])


SENSORS_SCHEMA = _schema(scope=StringType, sensor=StringType, k=DoubleType, n=LongType,
                         a=DoubleType, b=DoubleType, state=IntegerType)
ALARM_SCHEMA = _schema(scope=StringType, alarm=IntegerType, sent=LongType, last=LongType)
FRAMES_SCHEMA = _schema(topic=StringType, partition=IntegerType, offset=LongType, depth=LongType,
                        last=StringType, m=LongType, begun=LongType)
CHUNK_SCHEMA = _schema(topic=StringType, partition=IntegerType, offset=LongType, part=IntegerType,
                       kind=StringType, value=StringType, _m=LongType)
ANSWER = "struct<scope:string,batch_id:bigint,ack:boolean>"
# Columns of the outputs.
OUTPUTS = {
    "events": "scope string, sensor string, partition int, offset long, idx int, guid string, "
              "x double, lo double, hi double, state int, kind string",
    "commands": "scope string, command string, code string, warning string, alarm int",
    "statistics": "scope string, sensor string, n long, n_b long, mean double, std double, "
                  "lo double, hi double",
    "rejects": "topic string, partition int, offset long, value string, reason string",
    "values": "partition int, offset long, idx int, guid string, reply_url string, "
              + ", ".join(f"{f} double" for f in SENSOR_FIELDS),
}


def with_answers(records: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Records and answers (scope, batch_id, ack) as one frame, a stream or a batch."""
    records = records.select("topic", "partition", "offset", "value")
    if answers is None:
        return records
    none = [F.lit(None).cast(t).alias(c) for c, t in records.dtypes]
    answers = answers.select(*none, F.struct(
        "scope", F.col("batch_id").cast("long").alias("batch_id"), "ack").cast(ANSWER).alias("answer"))
    return records.withColumn("answer", F.lit(None).cast(ANSWER)).unionByName(answers)


PLACE = ("partition", "offset", "idx")


def packed_order(places: DataFrame) -> Column:
    """The order of ``PLACE``, nulls first, as one whole number if those that occur fit (aggregates by
    hash can keep that), else as a struct."""
    ends = places.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in PLACE for f in (F.min, F.max)]).first()
    packed, room = F.lit(0).cast("bigint"), 1
    for c in PLACE:
        low = ends[f"min_{c}"] or 0
        size = (ends[f"max_{c}"] or 0) - low + 2
        room *= size
        if room >= 1 << 63:
            return F.struct(*PLACE)
        packed = packed * F.lit(size).cast("bigint") + F.coalesce(
            F.col(c).cast("bigint") - F.lit(low - 1).cast("bigint"), F.lit(0).cast("bigint"))
    return packed


@dataclass
class AnomalyStream:
    """``foreachBatch`` processor. ``framing``: 'document' (one JSON document per record) or
    'lines' (records are lines of pretty-printed documents, reassembled across batches).

    ``auto_ack=True`` settles a sent command at once (the device answered); otherwise the answers
    given to ``start`` settle them. ``values=True`` also writes the projection of every message."""
    root: str
    scope: str = "ALL"
    framing: str = "document"
    sigmas: float = SIGMAS
    priority: list[str] = field(default_factory=lambda: list(ALARM_PRIORITY))
    auto_ack: bool = True
    keep_batches: int = 10
    values: bool = False
    max_broadcast_rows: int = MAX_BROADCAST_ROWS
    # optional forwarder for the command rows of a batch, e.g. lambda df, i: write_kafka(df, ...);
    # called before the commit, so at least once
    command_sink: Callable[[DataFrame, int], None] | None = None

    # -- the batch function --------------------------------------------------------------
    def __call__(self, df: DataFrame, batch_id: int) -> None:
        led = Ledger(df.sparkSession, self.root, self.keep_batches)
        if led.committed(batch_id):
            return
        before = led.manifest(batch_id - 1)
        records, answers = df, None
        if "answer" in df.columns:
            answers = df.where("answer.ack").select("answer.scope", "answer.batch_id")
            records = df.where("answer IS NULL")
        records = records.select("topic", "partition", "offset", "value")
        keep, lost, kept = ["topic", "partition", "offset"], None, []
        after = {"outputs": [], "runs": dict(before["runs"]), "tables": {}, "chunks": before["chunks"],
                 "spent": []}

        def keep_run(log: KeyedLog, path: str, rows: int) -> None:
            runs = log.settle(before["runs"].get(log.name, []), batch_id, path, rows)
            after["runs"][log.name] = runs
            after["spent"] += [path] if all(r["path"] != path for r in runs) else []

        def put(name: str, rows: DataFrame | None) -> bool:
            written = led.put(name, batch_id, rows) is not None
            after["outputs"] += [name] if written else []
            return written

        def once(rows: DataFrame, name: str = "rows") -> DataFrame:
            kept.append(name)
            return led.once(f"{len(kept)}-{name}", batch_id, rows)

        try:
            if self.framing == "lines":
                records, lost = self._frame_lines(led, records, batch_id, before, after, once)
                keep = [*keep, "part"]
            # parse once; the batch is read from this table by every later step, in its columns
            parsed = once(self._looked_at(parse_records(records, keep), keep), "parsed")
            bad = parsed.where("reason IS NOT NULL").select("topic", "partition", "offset", "value", "reason")
            put("rejects", bad if lost is None else bad.unionByName(lost))
            msgs = parsed.where("reason IS NULL")
            if self.values:
                put("values", msgs.select(*PLACE, "guid", "reply_url",
                                          *[F.col(f"flat_{f}").alias(f) for f in SENSOR_FIELDS]))
            readings = unpivoted(msgs.withColumn("ord", packed_order(msgs)), [*PLACE, "ord"])
            readings = readings.withColumn("scope", F.lit("ALL") if self.scope == "ALL" else F.col("guid"))
            self._process(led, readings, answers, batch_id, before, put, once, keep_run)
            led.commit(batch_id, after)
        finally:
            led.clear(batch_id)

    def _looked_at(self, parsed: DataFrame, keep: list[str]) -> DataFrame:
        """Of every piece what later steps need: its place, the values of a message in columns, the
        reason and text of a reject."""
        msg = F.col("_msg")
        payload = msg.getField("payload")
        asked = [payload.getField("reply_to").alias("reply_url"),
                 *[payload.getField("data").getField(f).alias(f"flat_{f}") for f in SENSOR_FIELDS]] if self.values else []
        # one message a line's piece: its place is that among the line's pieces
        place = F.col("part" if "part" in keep else "idx").cast("int").alias("idx")
        return parsed.select("topic", "partition", "offset", place, *wide_columns(msg), *asked,
                             F.col("_reason").alias("reason"),
                             F.when(F.col("_reason").isNotNull(), F.col("value")).alias("value"))

    def _frame_lines(self, led: Ledger, records: DataFrame, batch_id: int, before: dict, after: dict,
                     once: Callable) -> tuple[DataFrame, DataFrame]:
        """(documents that closed, pieces lost) of the batch's lines. Of lines read before, only
        where they left off is looked at, and the chunks of messages that close or break off."""
        by = ["topic", "partition"]
        carry = led.table(before["tables"].get("frames"), FRAMES_SCHEMA)
        carried = carry.select(*by, "offset", carried_line(F.col("depth"), F.col("last")).alias("value"))
        lines, framed = framed_lines(carried.unionByName(records), once=once)
        framed = once(framed, "framed")
        at = carry.select(*by, F.col("offset").alias("_c"), F.col("m").alias("_cm"), "begun")
        parts = once(null_safe_join(line_pieces(lines, framed), at, by, "left"), "parts")
        own = F.col("_c").isNull() | (F.col("offset") != F.col("_c"))
        message = F.when(F.col("_m") == F.col("_c"), F.col("_cm")).otherwise(F.col("_m"))
        fresh = parts.where(own).withColumn("_m", message).drop("_c", "_cm", "begun")
        # the messages open before this batch whose fate it decides: at most one a partition
        decided = parts.where(~own & (F.col("kind") == "open") & (F.col("_fate") != "unfinished")).select(
            *by, F.col("_cm").alias("_m"), "begun", "_fate")
        oldest = decided.agg(F.min("begun")).first()[0]
        pieces = fresh
        if oldest is not None:
            paths = [led.path(c["path"]) for c in before["chunks"] if c["batch"] >= oldest]
            chunks = led.spark.read.schema(CHUNK_SCHEMA).parquet(*paths)
            pieces = fresh.unionByName(chunks.join(F.broadcast(decided.drop("begun")), [*by, "_m"]))
        docs, _, lost = assemble(pieces)
        open_now = fresh.where(F.col("_fate") == "unfinished").select(*CHUNK_SCHEMA.fieldNames())
        chunk = led.put("open", batch_id, open_now)
        ends = null_safe_join(open_ends(framed), at, by, "left")
        still = F.col("m") == F.col("_c")
        ends = ends.select(*by, "offset", "depth", "last", F.when(still, F.col("_cm")).otherwise(F.col("m")).alias("m"),
                           F.when(still, F.col("begun")).otherwise(F.lit(batch_id)).cast("long").alias("begun"))
        frames = led.put("frames", batch_id, ends.select(*[
            F.col(f.name).cast(f.dataType) for f in FRAMES_SCHEMA.fields]))
        after["chunks"] = before["chunks"] + ([{"batch": batch_id, "path": chunk}] if chunk else [])
        if frames:
            after["tables"]["frames"] = frames
            needed = led.table(frames, FRAMES_SCHEMA).agg(F.min("begun")).first()[0]
        else:
            needed = batch_id + 1
        after["chunks"] = [c for c in after["chunks"] if c["batch"] >= needed]
        return docs, lost

    def _process(self, led: Ledger, readings: DataFrame, answers: DataFrame | None, batch_id: int,
                 before: dict, put: Callable, once: Callable, keep_run: Callable) -> None:
        sensors = KeyedLog(led, "sensors", KEY, SENSORS_SCHEMA)
        runs = before["runs"].get("sensors", [])
        # (written by tasks, counted by the broadcast bound: scope ALL has one key per sensor)
        cur = once(batch_partials(readings.withColumn("batch", F.lit(batch_id))), "partials")
        n = cur.count()
        small = self.scope == "ALL" or n <= self.max_broadcast_rows
        thr = None
        if n:  # T8: no readings, no change of statistics
            touched = cur.select("scope")
            merged = self._merge(sensors.lookup(runs, touched, small), cur)
            # the batch's run holds one row per key, with its band: it doubles as the table of
            # thresholds; readers of the state select its columns
            thr, path = sensors.append(runs, batch_id, merged)
            keep_run(sensors, path, thr.count())
            put("events", self._events(readings, thr, small))
        else:
            put("events", None)
        put("statistics", thr and thr.select(*KEY, "n", "n_b", "mean", "std", "lo", "hi"))
        self._alarm(led, thr, answers, small, batch_id, before, put, once, keep_run)

    def _merge(self, prev: DataFrame, cur: DataFrame) -> DataFrame:
        cur = cur.withColumnsRenamed({"n": "n_b"}).drop("batch")
        j = null_safe_join(prev, cur, KEY, "full_outer")
        k = F.coalesce("k", "x_first")
        d = F.col("mean_b") - k
        j = j.select(
            *KEY, k.alias("k"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("n_b", F.lit(0))).alias("n"),
            (F.coalesce("a", F.lit(0.0)) + F.coalesce(F.col("n_b") * d, F.lit(0.0))).alias("a"),
            (F.coalesce("b", F.lit(0.0)) + F.coalesce(F.col("m2_b") + F.col("n_b") * d * d, F.lit(0.0))).alias("b"),
            F.coalesce("state", F.lit(0)).alias("s0"),
            "n_b", "x_min", "x_max", "x_last")
        n = F.col("n")
        mean = F.when(n == 0, F.lit(0.0)).otherwise(F.col("k") + F.col("a") / n)
        var = F.when(n < 2, F.lit(0.0)).otherwise((F.col("b") - F.col("a") * F.col("a") / n) / (n - 1))
        std = F.sqrt(F.greatest(var, F.lit(0.0)))
        j = j.withColumns({"mean": mean, "std": std, "lo": mean - std * F.lit(self.sigmas),
                           "hi": mean + std * F.lit(self.sigmas)})
        has = F.col("n_b").isNotNull()
        breach_b = has & ((F.col("x_max") > F.col("hi")) | (F.col("x_min") < F.col("lo")))
        last = breach_code(F.col("x_last"), F.col("lo"), F.col("hi"))
        state = (F.when(~has, F.col("s0"))
                 .when(last != 0, last)
                 .when((F.col("s0") != 0) | breach_b, F.lit(2)).otherwise(F.lit(0)))
        return (j.withColumn("first_here", (F.col("s0") == 0) & breach_b)
                 .withColumn("state", state.cast("int")))

    def _events(self, readings: DataFrame, thr: DataFrame, small: bool) -> DataFrame:
        # a key that was in order and is not breached in this batch has no events
        t = thr.where((F.col("s0") != 0) | F.col("first_here")).select(*KEY, "lo", "hi", "s0", "first_here")
        c = null_safe_join(readings, hint(t, small), KEY).withColumn(
            "code", breach_code(F.col("x"), F.col("lo"), F.col("hi")))
        fb = (c.where(F.col("first_here") & (F.col("code") != 0)).groupBy(*KEY)
               .agg(F.min("ord").alias("fb_ord")))
        s = null_safe_join(c, hint(fb, small), KEY, "left")
        back = (F.col("s0") != 0) | (F.col("first_here") & (F.col("ord") > F.col("fb_ord")))
        state = F.when(F.col("code") != 0, F.col("code")).when(back, F.lit(2)).otherwise(F.lit(0))
        kind = (F.when(F.col("code") == 1, F.lit("HIGH")).when(F.col("code") == -1, F.lit("LOW"))
                .otherwise(F.lit("BACK")))
        s = s.withColumn("state", state)
        return (s.where((F.col("code") != 0) | (F.col("state") == 2))
                 .select(*KEY, *PLACE, "guid", "x", "lo", "hi", "state", kind.alias("kind")))

    def _alarm(self, led: Ledger, thr: DataFrame | None, answers: DataFrame | None, small: bool,
               batch_id: int, before: dict, put: Callable, once: Callable, keep_run: Callable) -> None:
        """One step of the alarm of every scope with readings, after the answers that came in. Only
        scopes with readings or answers are read and written."""
        log = KeyedLog(led, "alarm", ["scope"], ALARM_SCHEMA)
        runs = before["runs"].get("alarm", [])
        asked = None if thr is None else thr.select("scope")
        if answers is not None:
            answers = once(answers.where(F.col("batch_id") < batch_id), "answers")
            n = answers.count()
            if n:
                small = small and n <= self.max_broadcast_rows
                asked = answers.select("scope") if asked is None else asked.unionByName(answers.select("scope"))
            else:
                answers = None
        if asked is None:
            put("commands", None)
            return
        old = log.lookup(runs, asked, small).withColumn("acked", F.lit(False))
        if answers is not None:
            given = answers.withColumnsRenamed({"batch_id": "_answered"})
            near = null_safe_join(old.drop("acked"), given, ["scope"], "left")
            ok = (F.col("_answered") >= F.col("sent")) & (F.col("_answered") <= F.col("last"))
            old = near.groupBy(*ALARM_SCHEMA.fieldNames()).agg(
                F.max(F.coalesce(ok, F.lit(False))).alias("acked"))
        settled = old.select(
            "scope", F.when(F.col("acked") & (F.col("alarm") == 3), 1).when(
                F.col("acked") & (F.col("alarm") == 2), 0).otherwise(F.col("alarm")).alias("alarm"),
            *[F.when(~F.col("acked"), F.col(c)).alias(c) for c in ("sent", "last")])
        t = F.lit("")
        for s in reversed(self.priority):
            t = F.when(F.max(F.when((F.col("sensor") == s) & F.col("state").isin(1, -1), 1)) == 1,
                       F.lit(s)).otherwise(t)
        if thr is None:
            types = settled.limit(0).select("scope", F.lit("").alias("alarm_type"), F.lit(True).alias("step"))
        else:
            types = thr.groupBy("scope").agg(t.alias("alarm_type")).withColumn("step", F.lit(True))
        j = null_safe_join(types, settled, ["scope"], "full_outer").select(
            "scope", F.coalesce("alarm_type", F.lit("")).alias("alarm_type"),
            F.coalesce("step", F.lit(False)).alias("step"), F.coalesce("alarm", F.lit(0)).alias("old"),
            "sent", "last")
        on, step, was = F.col("alarm_type") != "", F.col("step"), F.col("old")
        send_on = step & on & was.isin(0, 3)
        send_off = step & ~on & was.isin(1, 2)
        ack = F.lit(self.auto_ack)
        new = (F.when(send_on, F.when(ack, F.lit(1)).otherwise(F.lit(3)))
               .when(send_off, F.when(ack, F.lit(0)).otherwise(F.lit(2)))
               .otherwise(was))
        now = F.lit(batch_id).cast("long")
        first = F.when(new.isin(2, 3), F.coalesce("sent", now))
        last = F.when(new.isin(2, 3), F.when(send_on | send_off, now).otherwise(F.col("last")))
        res = j.select("scope", new.cast("int").alias("alarm"), first.alias("sent"), last.alias("last"), "alarm_type",
                       F.when(send_on, F.lit("ON")).when(send_off, F.lit("OFF")).alias("command"),
                       F.when(send_on, F.lit(ALARM_CODE_ON)).when(send_off, F.lit(ALARM_CODE_OFF)).alias("code"))
        res, path = log.append(runs, batch_id, res)  # state + this batch's step
        keep_run(log, path, res.count())
        cmds = (res.where(F.col("command").isNotNull())
                   .select("scope", "command", "code", F.col("alarm_type").alias("warning"), "alarm"))
        if put("commands", cmds) and self.command_sink is not None:
            self.command_sink(led.spark.read.parquet(led.path(f"commands/batch_id={batch_id}")), batch_id)

    # -- what is committed -----------------------------------------------------------------
    def output(self, spark: SparkSession, name: str) -> DataFrame:
        """An output of all committed batches, with ``batch_id``."""
        return committed_output(spark, self.root, name, OUTPUTS[name])

    def state(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        """``sensors`` or ``alarm`` of all scopes, or ``frames``, after a batch."""
        led = Ledger(spark, self.root, self.keep_batches)
        found = led.manifest(batch_id)
        if name == "frames":
            return led.table(found["tables"].get("frames"), FRAMES_SCHEMA)
        key, schema = (KEY, SENSORS_SCHEMA) if name == "sensors" else (["scope"], ALARM_SCHEMA)
        return KeyedLog(led, name, key, schema).all(found["runs"].get(name, []))

    # -- driver side ---------------------------------------------------------------------
    def start(self, records: DataFrame, checkpoint: str, trigger: dict | None = None,
              answers: DataFrame | None = None):
        """Start the query. ``trigger`` e.g. {"processingTime": "2 seconds"} (reference pace) or
        {"availableNow": True} (replay everything available, then stop). ``answers`` is a stream of
        (scope, batch_id, ack)."""
        w = with_answers(records, answers).writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        w = w.trigger(**(trigger or {"processingTime": "2 seconds"}))
        return w.start()
