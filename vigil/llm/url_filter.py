"""Operator 2: URL filters as a temporal list join.

Dated add / remove entries of block lists become validity intervals, and every capture is
evaluated against the entries that were active when it was fetched: an equi-join on the pattern
with the fetch date inside the interval. Captures are salted over the join (a host may hold a
third of them) and the intervals repeated for each salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def plain_url(url: Column) -> Column:
    """The URL without query and fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*", 0)


def suffixes(host: Column) -> Column:
    """The host and all its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """Dated entries (list_name, kind, pattern, action, effective) as intervals
    (list_name, kind, pattern, valid_from, valid_to): an added pattern holds from its date up to,
    not including, the date of the next entry of the list for it; null valid_to: still holds.
    Several entries of one date count as one, a remove among them wins. Repeated adds do not
    end an interval, they continue it. Entries with a null in any column are no entries."""
    named = ["list_name", "kind", "pattern"]
    daily = (entries.dropna(subset=[*named, "action", "effective"])
             .groupBy(*named, "effective").agg(F.max(F.col("action") == "remove").alias("off")))
    order = Window.partitionBy(*named).orderBy("effective")
    turns = (daily.withColumn("was_off", F.coalesce(F.lag("off").over(order), F.lit(True)))
             .filter(F.col("off") != F.col("was_off")))
    spans = turns.withColumn("valid_to", F.lead("effective").over(order)).filter(~F.col("off"))
    return spans.select(*named, F.col("effective").alias("valid_from"), "valid_to")


def url_filter(captures: DataFrame, entries: DataFrame, id_col: str = "page_id",
               url_col: str = "url", date_col: str = "fetch_date",
               salts: int = SALTS) -> DataFrame:
    """One row per capture: ``id``, ``host``, ``fetch_date``, ``blocked``, ``n_entries`` active
    entries that match, ``lists`` (their list names, sorted, comma-separated), and ``pattern`` and
    ``since`` of the most specific (longest; ties to the larger text) match.

    Entries are of kind ``domain`` (the host or a parent domain) or ``url`` (the whole URL without
    query and fragment). A null or malformed URL has an empty host and matches nothing by domain;
    a null fetch date matches nothing. Repeated rows give as many rows. Other columns are not
    looked at. Empty entries block nothing.
    """
    rows = captures.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                            F.col(date_col).alias("fetch_date")).agg(
        F.count(F.lit(1)).alias("n"))
    host = host_of(F.col("url"))
    domains = F.transform(F.filter(suffixes(host), lambda s: s != F.lit("")),
                          lambda s: F.concat(F.lit("domain:"), s))
    keys = F.concat(domains, F.array(F.concat(F.lit("url:"), plain_url(F.col("url")))))
    probes = rows.withColumn("key", F.explode(keys)).withColumn(
        "salt", F.pmod(F.xxhash64("id", "url", "fetch_date"), F.lit(salts)).cast("int"))
    spans = validity(entries).select(
        F.concat("kind", F.lit(":"), "pattern").alias("key"), "list_name", "pattern",
        "valid_from", "valid_to",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    on = ((probes["key"] == spans["key"]) & (probes["salt"] == spans["salt"])
          & (probes["fetch_date"] >= spans["valid_from"])
          & (spans["valid_to"].isNull() | (probes["fetch_date"] < spans["valid_to"])))
    hit = F.col("list_name").isNotNull()
    best = F.max(F.when(hit, F.struct(F.length("pattern").alias("l"), F.col("pattern"),
                                      F.col("valid_from"))))
    found = (probes.join(spans, on, "left")
             .groupBy("id", "url", "fetch_date", "n")
             .agg(F.count("list_name").alias("n_entries"), best.alias("best"),
                  F.array_join(F.sort_array(F.collect_set("list_name")), ",").alias("lists")))
    copies = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return copies.select("id", host_of(F.col("url")).alias("host"), "fetch_date",
                         (F.col("n_entries") > 0).alias("blocked"), "n_entries", "lists",
                         F.col("best.pattern").alias("pattern"),
                         F.col("best.valid_from").alias("since"))


def _number(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c), 1, 13), 16, 10).cast("long")


def _day(n: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))


def listed(pages: DataFrame) -> DataFrame:
    """Dated entries drawn from the hosts and URLs of ``pages`` themselves (the tables hold no
    lists): adds, removals and renewed adds by the digits of a digest."""
    host = pages.select(host_of(F.col("url")).alias("h")).filter("h <> ''").distinct()
    parent = (host.filter("h like '%.%.%'")
              .select(F.regexp_replace("h", r"^[^.]*\.", "").alias("h")).distinct())
    url = pages.select(plain_url(F.col("url")).alias("h")).filter("h <> ''").distinct()

    def entries(df, name, kind, keep, first, action):
        k = _number(F.col("h"))
        return df.filter(keep(k)).select(
            F.lit(name).alias("list_name"), F.lit(kind).alias("kind"), F.col("h").alias("pattern"),
            F.lit(action).alias("action"), _day(first(k)).alias("effective"))

    parts = [
        entries(host, "hosts", "domain", lambda k: k % 4 == 0, lambda k: k % 200, "add"),
        entries(host, "hosts", "domain", lambda k: k % 12 == 0, lambda k: k % 200 + 60, "remove"),
        entries(host, "hosts", "domain", lambda k: k % 60 == 0, lambda k: k % 200 + 120, "add"),
        entries(parent, "parents", "domain", lambda k: k % 3 == 0, lambda k: k % 250, "add"),
        entries(url, "urls", "url", lambda k: k % 10 == 0, lambda k: k % 365, "add")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn(
        "fetch_date", _day(_number(F.col("page_id").cast("string")) % 365))
    return url_filter(captures, listed(pages)).withColumnRenamed("id", "page_id")


_K = "('0x' || substr(md5({}), 1, 13))::BIGINT"
_D = "DATE '2024-01-01' + ({})::INTEGER"
SQL = f"""
WITH p AS (
  SELECT page_id, url, {_D.format(_K.format('page_id::VARCHAR') + ' % 365')} AS fetch_date,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_extract(url, '^[^?#]*', 0) AS plain
  FROM pages),
h AS (SELECT DISTINCT host AS h FROM p WHERE host <> ''),
hk AS (SELECT h, {_K.format('h')} AS k FROM h),
pk AS (SELECT h, {_K.format('h')} AS k FROM (
  SELECT DISTINCT regexp_replace(h, '^[^.]*\\.', '') AS h FROM h WHERE h LIKE '%.%.%')),
uk AS (SELECT h, {_K.format('h')} AS k FROM (SELECT DISTINCT plain AS h FROM p WHERE plain <> '')),
spans AS (
  SELECT 'hosts' AS l, 'domain:' || h AS key, h AS pattern, {_D.format('k % 200')} AS a,
         CASE WHEN k % 12 = 0 THEN {_D.format('k % 200 + 60')} END AS b FROM hk WHERE k % 4 = 0
  UNION ALL
  SELECT 'hosts', 'domain:' || h, h, {_D.format('k % 200 + 120')}, NULL FROM hk WHERE k % 60 = 0
  UNION ALL
  SELECT 'parents', 'domain:' || h, h, {_D.format('k % 250')}, NULL FROM pk WHERE k % 3 = 0
  UNION ALL
  SELECT 'urls', 'url:' || h, h, {_D.format('k % 365')}, NULL FROM uk WHERE k % 10 = 0),
keys AS (
  SELECT page_id, fetch_date, unnest(list_append(
    list_transform(range(1, len(string_split(host, '.')) + 1),
                   lambda i: 'domain:' || array_to_string(string_split(host, '.')[i:], '.')),
    'url:' || plain)) AS key
  FROM p),
m AS (
  SELECT page_id, l, pattern, a,
         row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, pattern DESC, a DESC) AS r
  FROM keys JOIN spans USING (key)
  WHERE fetch_date >= a AND (b IS NULL OR fetch_date < b)),
g AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT l, ',' ORDER BY l) AS lists,
         max(CASE WHEN r = 1 THEN pattern END) AS pattern, max(CASE WHEN r = 1 THEN a END) AS since
  FROM m GROUP BY page_id)
SELECT p.page_id, host, fetch_date, coalesce(n, 0) > 0 AS blocked, coalesce(n, 0) AS n_entries,
       coalesce(lists, '') AS lists, pattern, since
FROM p LEFT JOIN g USING (page_id)
"""
