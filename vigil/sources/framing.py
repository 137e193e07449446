"""Record framing and JSON decoding.

A message is a balanced ``{...}`` that no other brace encloses; arrays, commas and white space
between messages only separate them.

decode_records:  records that hold whole documents (one object, an array, or several of either).
                 Every message is parsed by itself; what is no message is rejected with its text.
reassemble:      records that are *lines* of documents, in offset order per (topic, partition).
                 Each message is put together when its own brace closes, so the length of the
                 array around it does not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from vigil.functions.sizing import MAX_BROADCAST_ROWS, hint, materialize
from vigil.functions.text import WHITESPACE
from vigil.schema import MESSAGE, SENSOR_FIELDS

# Every repetition is possessive: the matcher neither recurses nor backtracks over long texts.
LITERAL = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'
# Levels below an object's own that a pattern looks through, in one pass of the matcher, which takes
# a few frames of the stack a level; what is nested deeper is balanced by counting, which costs many
# times as much a brace.
SHALLOW = 160


def _object(depth: int = SHALLOW, plain: str = r'[^{}"]') -> str:
    """Pattern of a balanced {...} with up to ``depth`` levels below it."""
    inner = rf"{plain}++|{LITERAL}"
    pattern = rf"\{{(?:{inner})*+\}}"
    for _ in range(depth):
        pattern = rf"\{{(?:{inner}|{pattern})*+\}}"
    return pattern


OBJECT = _object()
# A piece outside messages starts a balanced object, or one that takes the whole rest: it is open,
# or nested deeper than the pattern sees.
PIECE = rf"(?s){OBJECT}|\{{.*+"
# An object that surely never closes: openers, what is balanced behind each, at the end maybe a
# literal cut off. (A backslash outside literals is left to the counting.)
_BARE = r'[^{}"\\]'
OPEN = (rf"(?s)^(?:\{{(?:{_BARE}++|{LITERAL}|{_object(plain=_BARE)})*+)++"
        r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+\\?)?$')
SEPARATORS = WHITESPACE + "[],"
# Put behind a text: a piece that takes the whole rest takes it along, a balanced one ends before it.
_END = "\x03"
# Balanced braces of a few levels, where nothing but braces is left: most of them, at a low price.
_FLAT = r"\{\}"
for _ in range(8):
    _FLAT = rf"\{{(?:{_FLAT})*+\}}"
PARSED = StructType([*MESSAGE.fields]).add("_bad", StringType())
# A text cut behind every brace, quote and escaped character (a mark), and in blocks of marks.
MARK = r'[^{}"\\]*+(?:[{}"]|\\.?)'
_TAIL = r'[^{}"\\]++'
_BLOCK = 256
# A line cut behind every brace outside literals.
LINE_MARK = rf"(?s)(?:[^{{}}\"]++|{LITERAL}|\")*+[{{}}]"
# Put where a top-level object starts or ends; what looks like it in a text is escaped.
_ESCAPE, _CUT, _KEPT = "\x00", "\x00\x02", "\x00\x01"


def _marks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s){MARK}|{_TAIL}"), 0)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _step(depth: Column, quoted: Column, mark: Column) -> tuple[Column, Column, Column, Column]:
    """(depth, whether inside a literal, opens a top-level object, closes one) behind a mark."""
    plain = ~mark.contains("\\")  # an escaped character is none of these
    opens = plain & ~quoted & mark.endswith("{")
    closes = plain & ~quoted & mark.endswith("}") & (depth > 0)
    quote = plain & (depth > 0) & mark.endswith('"')  # between objects a quote is only a quote
    return (F.when(opens, depth + 1).when(closes, depth - 1).otherwise(depth),
            F.when(quote, ~quoted).otherwise(quoted), opens & (depth == 0), closes & (depth == 1))


def _cut_objects(text: Column) -> Column:
    """A text cut where its top-level objects start and end: outside, object, outside, ... The
    depth is a running sum over the braces outside literals, so objects may be nested as deep as
    they like; one that never closes takes the rest.

    A first pass carries the depth from block to block, a second one cuts each block from its own
    start. (An aggregate copies its state at each step, so no state may grow with the text.)"""
    def through(state: Column, block: Column) -> Column:
        def step(s: Column, mark: Column) -> Column:
            depth, quoted, _, _ = _step(s["depth"], s["quoted"], mark)
            return F.struct(depth.alias("depth"), quoted.alias("quoted"))
        return F.aggregate(_marks(block), state, step)

    def cut(state: Column, block: Column) -> Column:
        def step(s: Column, mark: Column) -> Column:
            depth, quoted, first, last = _step(s["depth"], s["quoted"], mark)
            out = F.when(first, F.concat(F.regexp_replace(mark, r"\{$", ""), F.lit(_CUT + "{"))
                         ).when(last, F.concat(mark, F.lit(_CUT))).otherwise(mark)
            return F.struct(depth.alias("depth"), quoted.alias("quoted"),
                            F.concat(s["out"], F.array(out)).alias("out"))
        start = F.struct(state["depth"].alias("depth"), state["quoted"].alias("quoted"),
                         F.array().cast("array<string>").alias("out"))
        return F.aggregate(_marks(block), start, step, lambda s: F.array_join(s["out"], ""))

    def all_blocks(blocks: Column) -> Column:
        top = F.array(F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted")))
        states = F.aggregate(blocks, top, lambda s, b: F.concat(
            s, F.array(through(F.element_at(s, -1), b))))
        return _once(states, lambda st: F.array_join(
            F.transform(blocks, lambda b, i: cut(F.get(st, i), b)), ""))

    blocks = F.regexp_extract_all(F.replace(text, F.lit(_ESCAPE), F.lit(_KEPT)),
                                  F.lit(rf"(?s)(?:{MARK}){{1,{_BLOCK}}}+|{_TAIL}"), 0)
    return F.transform(F.split(_once(blocks, all_blocks), _CUT, -1),
                       lambda p: F.replace(p, F.lit(_KEPT), F.lit(_ESCAPE)))


def _deep_pieces(text: Column) -> Column:
    """(objects, outside) of a text whose objects no pattern can balance."""
    def parts(cut: Column) -> Column:
        return F.struct(F.filter(cut, lambda _, i: i % 2 == 1).alias("objects"),
                        F.array_join(F.filter(cut, lambda _, i: i % 2 == 0), "").alias("outside"))

    return _once(_cut_objects(text), parts)


def pieces(df: DataFrame, value: str, keep: list[str]) -> DataFrame:
    """``keep``, ``_o`` (array of the top-level objects of column ``value``, the last maybe open) and
    ``_x`` (what else is there but separators, or null)."""
    cut = df.select(*keep, F.col(value).alias("_v"), F.when(
        ~F.contains(value, F.lit("{")), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(
            F.concat(value, F.lit(_END)), F.lit(PIECE), 0)).alias("_p"))
    # what the pattern could not balance reaches to the end
    last = F.try_element_at("_p", F.lit(-1))
    ended = F.when(last.endswith(_END), F.substring(last, F.lit(1), F.length(last) - 1))
    cut = cut.select(*keep, "_v", "_p", ended.alias("_ended"))
    whole = F.when(F.col("_ended").isNull(), F.col("_p")).otherwise(
        F.concat(F.slice("_p", F.lit(1), F.size("_p") - 1), F.array("_ended")))
    cut = cut.select(*keep, "_v", whole.alias("_p"), "_ended")
    # a single piece is the first place that holds its text, and the only one: no second pass
    one = F.try_element_at("_p", F.lit(1))
    rest = F.when(F.size("_p") == 0, F.col("_v")).when(
        F.col("_v") == one, "").when((F.size("_p") == 1) & F.contains("_v", one), F.replace(
            "_v", one, F.lit(""))).otherwise(F.regexp_replace("_v", PIECE, ""))
    taken = F.col("_ended").isNotNull() & ~F.col("_ended").rlike(OPEN)
    cut = cut.select(*keep, "_p", rest.alias("_rest"), F.when(taken, _deep_pieces(F.col("_ended"))).alias("_d"))
    deep = F.col("_d").isNotNull()
    objects = F.when(deep, F.concat(F.slice("_p", F.lit(1), F.size("_p") - 1), F.col("_d.objects"))
                     ).otherwise(F.col("_p"))
    rest = F.when(deep, F.concat("_rest", "_d.outside")).otherwise(F.col("_rest"))
    other = F.btrim(rest, F.lit(SEPARATORS))
    return cut.select(*keep, objects.alias("_o"), F.when(other != "", other).alias("_x"))


def _one_row_if(condition: Column, value: Column) -> Column:
    """Generator that keeps a row when ``condition`` holds. A plain filter on a parsed column would
    be pushed below the projection and parse again."""
    return F.explode_outer(F.when(condition, F.array(value)))


def parse_records(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keep cols, idx, value (text of the piece), ``_msg`` (NULL when it is no message) and
    ``_reason``: one row per piece of every record, what lies outside objects included."""
    keep = keep or [c for c in records.columns if c != "value"]
    cut = pieces(records, "value", keep)
    every = F.concat(F.col("_o"), F.when(F.col("_x").isNotNull(), F.array("_x"))
                     .otherwise(F.array().cast("array<string>")))
    part = (cut.select(*keep, F.posexplode_outer(every).alias("idx", "value"))
            .where(F.col("value").isNotNull()))
    r = F.from_json("value", PARSED, {"columnNameOfCorruptRecord": "_bad"})
    part = part.select(*keep, "idx", "value", r.alias("_r"))
    fields = F.struct(*[F.col(f"_r.{f.name}").alias(f.name) for f in MESSAGE.fields])
    reason = (F.when(F.col("_r").isNull() | F.col("_r._bad").isNotNull(), "malformed")
              .when(F.col("_r.guid").isNull() & F.col("_r.payload").isNull(), "not a message"))
    return part.select(*keep, "idx", "value", reason.alias("_reason"),
                       F.when(reason.isNull(), fields).alias("_msg"))


def split_parsed(p: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Parsed pieces -> (messages, rejects)."""
    msgs = (p.select(*keep, "idx", _one_row_if(F.col("_reason").isNull(), F.col("_msg")).alias("msg"))
            .where(F.col("msg").isNotNull()))
    rejects = (p.select(*keep, "value", _one_row_if(F.col("_reason").isNotNull(), F.col("_reason"))
                        .alias("reason")).where(F.col("reason").isNotNull()))
    return msgs, rejects


def decode_records(records: DataFrame, keep: list[str] | None = None,
                   once: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(messages, rejects). messages: keep cols + idx + msg struct; rejects: keep cols + value
    (the piece's text) + reason. Every record's text is in one of them, but for separators.
    Whoever reads both passes ``once`` (``materialize``), or every record is parsed for each."""
    keep = keep or [c for c in records.columns if c != "value"]
    return split_parsed(once(parse_records(records, keep)), keep)


# -- lines ------------------------------------------------------------------------------------
# Records of one (topic, partition) whose offsets share a bucket are framed together in one task.
# (As many rows as a window keeps without going through its sorter.)
BUCKET_OFFSETS = 1 << 12
# Closers of a line that starts afresh: more than any depth, and few enough for the sums of a bucket.
_AFRESH = 1 << 40
# What a task may hold of lines in one sort, and what a line takes beside its text.
TASK_BYTES, ROW_BYTES = 128 << 20, 200
_BKT, _ROW = "_bkt", "_row"


def brace_effect(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``_a``, the closers that reach out of the line, and ``_b``, the openers left
    open, outside string literals. (Step by step: each is computed once.)"""
    braces = F.when(~(F.contains(value, F.lit("{")) | F.contains(value, F.lit("}"))), "").otherwise(
        F.regexp_replace(value, rf'(?:[^{{}}"]++|{LITERAL}|")++', ""))
    x = rows.select("*", braces.alias("_braces"))
    # what is balanced inside the line goes; the rest is counted brace by brace if it must be
    for pattern in (_FLAT, _object()):
        left = F.when(F.contains("_braces", F.lit("{}")), F.regexp_replace("_braces", pattern, "")).otherwise(
            F.col("_braces"))
        x = x.select(*rows.columns, left.alias("_braces"))
    x = x.withColumnRenamed("_braces", "_left")
    start = F.struct(F.lit(0).alias("low"), F.lit(0).alias("now"))

    def step(s: Column, brace: Column) -> Column:
        now = s["now"] + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        return F.struct(F.least(s["low"], now).alias("low"), now.alias("now"))

    left, opened = F.col("_left"), F.ltrim("_left", F.lit("}"))
    closers = F.length(left) - F.length(opened)
    count = F.aggregate(F.split(left, ""), start, step)
    effect = F.when(left == "", F.struct(F.lit(0).alias("low"), F.lit(0).alias("now"))).when(F.rtrim(opened, F.lit("{")) == "", F.struct(
        (-closers).alias("low"), (F.length(left) - 2 * closers).alias("now"))).otherwise(count)
    x = x.select(*rows.columns, effect.alias("_effect"))
    return x.select(*rows.columns, (-F.col("_effect.low")).alias("_a"),
                    (F.col("_effect.now") - F.col("_effect.low")).alias("_b"))


def _line_facts(records: DataFrame, by: list[str], order: str) -> DataFrame:
    def end(at: int, trim: Callable) -> Column:
        outer = F.substring("value", at, 1)  # mostly it counts
        return F.when(F.contains(F.lit(WHITESPACE), outer), F.substring(
            trim("value", F.lit(WHITESPACE)), at, 1)).otherwise(outer)

    r = brace_effect(records.select(*by, order, "value"), "value")
    r = r.select(*by, order, "value", "_a", "_b", end(1, F.ltrim).alias("_f"), end(-1, F.rtrim).alias("_e"))
    first, last = F.col("_f"), F.col("_e")
    return r.select(*by, order, "value", "_a", "_b",
                    F.when(first != "", first).alias("_first"),
                    F.when(last != "", last).alias("_last"),
                    F.floor(F.col(order) / F.lit(BUCKET_OFFSETS)).alias(_BKT),
                    F.monotonically_increasing_id().alias(_ROW))


def parts_needed(rows: DataFrame, value: str | None) -> int | None:
    """In how many parts written ``rows`` have to be dealt for a task's sort to hold about
    ``TASK_BYTES``, however many rows there are; None if the session's will do. Narrow rows are
    without a text ``value``."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.octet_length(value) if value else F.lit(0)).alias("b")).first()
    n = ((size["b"] or 0) + ROW_BYTES * size["n"]) // TASK_BYTES + 1
    return n if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _dealt(rows: DataFrame, value: str | None, keys: list[str]) -> DataFrame:
    n = parts_needed(rows, value)
    return rows.repartition(n, *keys) if n else rows


def _framed(records: DataFrame, by: list[str], order: str, once: Callable) -> tuple[DataFrame, DataFrame]:
    """(lines, frames): the lines with their texts, and without them (``_row`` is the same) every
    line with the brace depth before it (``_d``; 0 at a fresh start), the offset of the
    line where the message open before it began (``_m``), and what becomes of that message and of
    one that the line opens: ``closed``, ``unclosed`` (a fresh start cuts it off) or
    ``unfinished`` (neither happens in these records).

    An opener at the start of a line can only continue a document after a colon, comma or opening
    bracket; after anything else (or at the very start) a new document begins, whatever was left
    open. Depths are running values of D -> max(D - closers, 0) + openers, which compose as
    D -> max(D + s, t): within a bucket by windows over the bucket's lines, from bucket to bucket
    over one row each. The bucket tables are small and narrow.

    Lines are read, and looked at, once: ``once`` keeps them. All that is sorted, and written on the
    way, is rows of a few numbers a line; the texts stay where they are. Windows of one order share
    one sort; a stage sorts the rows no more than twice.
    """
    def small(table: DataFrame) -> DataFrame:
        table = once(table, "buckets")
        return hint(table, table.count() <= MAX_BROADCAST_ROWS)

    written = once(_line_facts(records, by, order), "lines")
    lines = written.drop("value")
    group = [*by, _BKT]
    # whether a document may go on behind the last character that counts of the buckets before
    # (aggregates of booleans and numbers go by hash, of texts and structs by sorting)
    lines = lines.withColumn("_more", F.col("_last").isin(":", ",", "["))
    ends = lines.groupBy(*group).agg(
        F.max_by("_more", F.when(F.col("_more").isNotNull(), F.col(order))).alias("_end"))
    before = Window.partitionBy(*by).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*group, F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    past = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    x = _dealt(lines.join(small(ends), group), None, group)
    goes_on = F.coalesce(F.last("_more", ignorenulls=True).over(past), F.col("_carried"), F.lit(False))
    fresh = F.col("_first").isin("{", "[") & ~F.col("_goes_on")
    x = x.withColumn("_goes_on", goes_on).withColumn("_hard", F.coalesce(fresh, F.lit(False)))
    x = x.drop("_carried", "_goes_on", "_first", "_more")
    # a fresh start is a line with more closers than any depth
    change = F.col("_b").cast("bigint") - F.when(F.col("_hard"), F.lit(_AFRESH)).otherwise(F.col("_a"))
    x = x.withColumn("_n", F.coalesce(change, F.lit(0).cast("bigint")))
    x = x.withColumn("_s", F.coalesce(F.sum("_n").over(past), F.lit(0).cast("bigint")))
    # (s, t) of the lines before, null for a bucket's first
    top = F.col("_b") - (F.col("_s") + F.col("_n"))
    x = x.withColumn("_t", F.col("_s") + F.max(top).over(past))
    x = once(x, "depths")
    # bucket to bucket: the effect of a bucket, absolute if something in it starts afresh
    t = F.coalesce(F.greatest(F.col("_t") + F.col("_n"), F.col("_b").cast("bigint")), F.lit(0).cast("bigint"))
    whole = x.groupBy(*group).agg(F.max_by(F.col("_s") + F.col("_n"), order).alias("_s"),
                                  F.max_by(t, order).alias("_t"), F.max("_hard").alias("_abs"))
    upto_b = Window.partitionBy(*by).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, 0)
    whole = whole.withColumn("_run", F.sum(F.col("_abs").cast("int")).over(upto_b))
    run = Window.partitionBy(*by, "_run").orderBy(_BKT).rowsBetween(Window.unboundedPreceding, 0)
    # in a run only its first bucket is absolute: there D is t, after it D + s
    step = F.when(F.col("_abs"), F.lit(0)).otherwise(F.col("_s"))
    whole = whole.withColumn("_cs", F.sum(step).over(run))
    whole = whole.withColumn("_after", F.col("_cs") + F.max(F.col("_t") - F.col("_cs")).over(run))
    by_bucket = Window.partitionBy(*by).orderBy(_BKT)
    # (before the first absolute bucket the depth starts at 0: max(s, t) with t >= s, so t)
    start = whole.select(*group, F.coalesce(F.lag("_after").over(by_bucket), F.lit(0)).alias("_d0"))
    x = x.join(small(start), group)
    depth = F.when(F.col("_hard"), F.lit(0)).otherwise(F.greatest(F.col("_d0") + F.col("_s"), F.col("_t")))
    x = x.withColumn("_d", depth).drop("_n", "_s", "_t", "_d0")
    x = x.withColumn("_after", F.greatest(F.col("_d") - F.col("_a"), F.lit(0)) + F.col("_b"))
    # the line opens a message that outlasts it if depth 0 was reached and some opener is left
    opens = (F.col("_a") >= F.col("_d")) & (F.col("_b") > 0)
    closes = (F.col("_d") > 0) & (F.col("_a") >= F.col("_d"))
    x = (x.withColumn("_opened", F.when(opens, F.col(order)))
         .withColumn("_closed", F.when(closes, F.col(order)))
         .withColumn("_cut", F.when(F.col("_hard"), F.col(order))))
    ends = x.groupBy(*group).agg(F.max("_opened").alias("_o"), F.min("_closed").alias("_c"),
                                 F.min("_cut").alias("_h"))
    later = Window.partitionBy(*by).orderBy(F.desc(_BKT)).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, F.max("_o").over(before).alias("_m0"),
                          F.min("_c").over(later).alias("_c0"), F.min("_h").over(later).alias("_h0"))
    x = _dealt(x.join(small(carried), group), None, group)
    # (backwards, as a growing frame; one that shrinks would be summed anew for every row)
    ahead = Window.partitionBy(*group).orderBy(F.desc(order)).rowsBetween(
        Window.unboundedPreceding, -1)
    x = x.withColumn("_m", F.coalesce(F.max("_opened").over(past), F.col("_m0")))
    x = x.select("*", F.coalesce(F.min("_closed").over(ahead), F.col("_c0")).alias("_next_close"),
                 F.coalesce(F.min("_cut").over(ahead), F.col("_h0")).alias("_next_cut"))

    def fate(close):
        return (F.when(close.isNull() & F.col("_next_cut").isNull(), "unfinished")
                .when(close.isNull() | (F.col("_next_cut") <= close), "unclosed").otherwise("closed"))

    return written, x.select(_ROW, *by, order, "_a", "_b", "_d", "_m", "_last", "_after", "_opened",
                             fate(F.coalesce("_closed", "_next_close")).alias("_fate"),
                             fate(F.col("_next_close")).alias("_fate_opened"))


def _up_to_closer(value: Column, depth: Column) -> Column:
    """The start of a line up to and with the brace that closes ``depth`` levels."""
    start = F.struct(F.lit(0).alias("i"), depth.cast("int").alias("depth"), F.lit(0).alias("at"))

    def step(s: Column, mark: Column) -> Column:
        now = s["depth"] + F.when(mark.endswith("{"), 1).otherwise(-1)
        here = (s["at"] == 0) & (now == 0)
        return F.struct((s["i"] + 1).alias("i"), now.alias("depth"),
                        F.when(here, s["i"] + 1).otherwise(s["at"]).alias("at"))

    counted = _once(F.regexp_extract_all(value, F.lit(LINE_MARK), 0), lambda m: F.array_join(F.slice(
        m, F.lit(1), F.aggregate(m, start, step, lambda s: s["at"])), ""))
    # mostly the first brace of the line closes the one level
    first = F.regexp_extract(value, f"^{LINE_MARK}", 0)
    return F.when((depth == 1) & first.endswith("}"), first).otherwise(counted)


def _parts(x: DataFrame, by: list[str], order: str) -> DataFrame:
    """Every line cut into (by, order, ``part``, ``kind``, ``value``, ``_m``): ``body`` and
    ``close`` belong to the message that began in line ``_m``, ``open`` begins one, ``whole`` is
    one, ``other`` is neither message nor separator."""
    inside = F.col("_d") > 0
    closes = inside & (F.col("_a") >= F.col("_d"))
    fates = ["_fate", "_fate_opened"]
    x = x.select(*by, order, "value", "_m", "_b", *fates, inside.alias("_inside"), closes.alias("_closes"),
                 F.when(closes, _up_to_closer(F.col("value"), F.col("_d"))).alias("_head"))
    rest = F.when(~F.col("_inside"), F.col("value")).when(
        F.col("_closes"), F.expr("substring(value, length(_head) + 1)")).otherwise(F.lit(""))

    def piece(kind, value):
        return F.struct(kind.alias("kind"), value.alias("value"))

    none = F.array().cast("array<struct<kind:string,value:string>>")
    first = F.when(F.col("_closes"), F.array(piece(F.lit("close"), F.col("_head")))).when(
        F.col("_inside"), F.array(piece(F.lit("body"), F.col("value")))).otherwise(none)
    outlasts = (F.col("_b") > 0) & (~F.col("_inside") | F.col("_closes"))
    x = x.select(*by, order, "_m", *fates, first.alias("_first"), outlasts.alias("_outlasts"),
                 rest.alias("_rest_of_line"))
    x = pieces(x, "_rest_of_line", [*by, order, "_m", *fates, "_first", "_outlasts"])
    n = F.size("_o")
    middle = F.when(n == 0, none).otherwise(F.transform("_o", lambda v, i: piece(
        F.when(F.col("_outlasts") & (i == n - 1), F.lit("open")).otherwise(F.lit("whole")), v)))
    end = F.when(F.col("_x").isNotNull(), F.array(piece(F.lit("other"), F.col("_x")))).otherwise(none)
    every = F.when((n == 0) & F.col("_x").isNull(), F.col("_first")).otherwise(
        F.concat("_first", middle, end))
    kind = F.col("_p.kind")
    return (x.select(*by, order, "_m", *fates, F.posexplode_outer(every).alias("part", "_p")).where(F.col("_p").isNotNull())
            .select(*by, order, "part", kind.alias("kind"), F.col("_p.value").alias("value"),
                    F.when(kind.isin("body", "close"), F.col("_m")).otherwise(F.col(order)).alias("_m"),
                    F.when(kind.isin("body", "close"), F.col("_fate")).when(
                        kind == "open", F.col("_fate_opened")).when(
                        kind == "whole", "closed").otherwise("malformed").alias("_fate")))


BY = ("topic", "partition")


def framed_lines(records: DataFrame, by: tuple[str, ...] = BY, order: str = "offset",
                 once: Callable[[DataFrame, str], DataFrame] = materialize) -> tuple[DataFrame, DataFrame]:
    """(lines, frames): the lines, and a narrow row of each with the depth before it and its messages'
    fates, for the functions below. ``once(rows, name)`` keeps rows that are read several times, or
    parsed, and gives the same rows whenever they are read (tables)."""
    return _framed(records, list(by), order, once)


def line_pieces(lines: DataFrame, frames: DataFrame, by: tuple[str, ...] = BY,
                order: str = "offset") -> DataFrame:
    """The lines cut into pieces of messages, for ``assemble``."""
    texts = _dealt(lines.select(_ROW, "value"), "value", [_ROW])
    return _parts(texts.join(frames, _ROW), list(by), order)


def open_ends(frames: DataFrame, by: tuple[str, ...] = BY, order: str = "offset") -> DataFrame:
    """Per (topic, partition) that ends inside a message: the last line's offset, the brace
    ``depth`` behind it, the last character that counts, and ``m``, the line that began it. With
    ``carried_line`` that is all that the lines to come need to know."""
    ends = frames.groupBy(*by).agg(
        F.max(order).alias(order), F.max_by("_after", order).alias("depth"),
        F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col(order))).alias("last"),
        F.max("_opened").alias("m"))
    return ends.where("depth > 0")


def carried_line(depth: Column, last: Column) -> Column:
    """A line that leaves what is read next at the same depth behind the same character."""
    more = F.when(last == "}", 1).otherwise(0)
    return F.concat(F.repeat(F.lit("{"), (depth + more).cast("int")),
                    F.when(last == "{", "").otherwise(F.coalesce(last, F.lit(""))))


def assemble(parts: DataFrame, by: tuple[str, ...] = BY, order: str = "offset",
             between: str = "\n") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``line_pieces`` -> (documents, unfinished, lost), see ``reassemble``."""
    by = list(by)
    whole = F.col("kind") == "whole"
    line = F.struct(F.col(order), F.col("part"), F.col("value"))
    # one group per message; a whole message on one line is a group of its own
    docs = (parts.where(F.col("_fate") == "closed")
            .groupBy(*by, "_m", F.when(whole, F.col("part")).alias("_w"))
            .agg(F.array_sort(F.collect_list(line)).alias("_l"))
            .select(*by, F.col("_m").alias(order), F.col("_l")[0]["part"].alias("part"),
                    F.array_join(F.transform("_l", lambda v: v["value"]), between).alias("value")))
    unfinished = parts.where(F.col("_fate") == "unfinished").select(*by, order, "value")
    lost = parts.where(F.col("_fate").isin("malformed", "unclosed")).select(
        *by, order, "value", F.col("_fate").alias("reason"))
    return docs, unfinished, lost


def reassemble(records: DataFrame, by: tuple[str, ...] = BY, order: str = "offset",
               between: str = "\n") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Line records -> (documents, unfinished, lost).

    documents: by cols + order (of the line where the message begins) + ``part`` (its place among
    the pieces of that line) + value, one message each. ``unfinished``: the lines, cut to what
    belongs to it, of the message still open at the end of each (topic, partition); a stream
    carries them into the next batch, a table rejects them. ``lost``: by cols + order + value +
    reason, every piece that belongs to no closed message: text outside messages ('malformed') and
    the lines of a message that a fresh start cut off ('unclosed'). Lines of messages that never
    close are never collected into one group. ``between`` stood between the lines. The pieces of
    lines are written once, for all three."""
    pieces_ = materialize(line_pieces(*framed_lines(records, by, order), by, order), "pieces")
    return assemble(pieces_, by, order, between)


def field_reading(msg: Column, field: str) -> Column:
    """A sensor value from the flat field (shapes B/C) or the sensors array (shape A)."""
    from_array = F.get(F.filter(msg.getField("payload").getField("data").getField("sensors"),
                                lambda s: s.getField("senstype") == F.lit(field)), 0).getField("current")
    return F.coalesce(msg.getField("payload").getField("data").getField(field), from_array)


def wide_columns(msg: Column) -> list[Column]:
    """``guid`` and one column a sensor, named like it."""
    return [msg.getField("guid").alias("guid"),
            *[field_reading(msg, f).alias(s) for f, s in SENSOR_FIELDS.items()]]


def unpivoted(wide: DataFrame, ids: list[str]) -> DataFrame:
    """``wide_columns`` of messages -> long readings (ids..., guid, sensor, x) for every present, valid
    value."""
    longf = wide.unpivot([*ids, "guid"], list(SENSOR_FIELDS.values()), "sensor", "x")
    return longf.where(F.col("x").isNotNull() & ~F.isnan(F.col("x")))


def readings_of(msgs: DataFrame, ids: list[str]) -> DataFrame:
    """Messages -> long readings (ids..., guid, sensor, x) for every present, valid value."""
    return unpivoted(msgs.select(*ids, *wide_columns(F.col("msg"))), ids)
