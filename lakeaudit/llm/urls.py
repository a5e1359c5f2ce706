"""URL filtering against dated lists: which entries were active when a capture was fetched.

List entries say that a host or a domain (a host and everything below it) was put on a list or taken
off it on some day. ``validity`` turns them into intervals that do not overlap; ``evaluate`` joins
every capture with the entries active at its time. The most specific listed name decides; if it is on
both lists at once, the allow list wins.

Captures are first reduced to their distinct (host, time) pairs, so a host with a third of the
captures is a few rows; the pairs' names meet the intervals through a salted key, and so do the
verdicts and the captures on the way back.

Defined results
  * A host is in lower case, without user, port, path and closing dot; a text without ``scheme://`` and
    a host has none. Captures without a host or a time are on no list: not blocked, null columns.
  * Entries with a null name, list, action or time are ignored; repeated ones count once. If a name is
    put on and taken off a list at one time, it is off. Times are compared as they are typed.
  * An entry is active from its own time, and no longer at the time it is taken off.
  * Repeated captures are judged each. ``host``, ``listed``, ``listed_since`` and ``blocked`` replace
    columns of these names; other columns are kept. Empty tables give empty or unlisted results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import ready, salted_join, table

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[\]]+)"
ADDED = ("host", "listed", "listed_since", "blocked")


def host_of(url: Column) -> Column:
    host = F.regexp_replace(F.regexp_extract(F.lower(url), _HOST, 1), r"\.+$", "")
    return F.when(host != "", host)


def names_of(host: Column) -> Column:
    """The host and the domains it lies in, the host first."""
    labels = F.split(host, r"\.")
    below = F.sequence(F.lit(1), F.size(labels))
    return F.transform(below, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """(name, list, since, until): entries (name, list, action, at) as intervals; ``until`` may be null.

    A name's rows on a list are at most one per time by then.
    """
    whole = entries.where("name is not null and list is not null and action is not null and at is not null")
    daily = whole.groupBy(F.lower("name").alias("name"), "list", "at").agg(
        F.min(F.col("action") == "add").alias("on"))
    order = Window.partitionBy("name", "list").orderBy("at")
    spans = daily.select("name", "list", "on", F.col("at").alias("since"), F.lead("at").over(order).alias("until"))
    return spans.where("on").drop("on")


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", at_col: str = "fetched_at") -> DataFrame:
    """The captures with the deciding list entry and whether it blocks them."""
    ready(captures.sparkSession)
    kept = [c for c in captures.columns if c not in ADDED]
    hosted = captures.select(*kept, host_of(F.col(url_col)).alias("host"), F.col(at_col).alias("_at"))
    pairs = hosted.where("host is not null and _at is not null").select("host", "_at").distinct()
    named = pairs.select("host", "_at", F.explode(names_of(F.col("host"))).alias("name"))
    active = salted_join(named, validity(entries), ["name"], salts=16).where(
        (F.col("since") <= F.col("_at")) & (F.col("until").isNull() | (F.col("_at") < F.col("until"))))
    best = F.max(F.struct(F.length("name").alias("size"), (F.col("list") == "allow").alias("allow"), "name", "since"))
    verdicts = active.groupBy("host", "_at").agg(best.alias("best")).select(
        "host", "_at", F.col("best.name").alias("listed"), F.col("best.since").alias("listed_since"),
        (~F.col("best.allow")).alias("blocked"))
    spread = F.xxhash64(*[F.col(c) for c in kept if not captures.schema[c].dataType.simpleString().startswith("map")])
    out = salted_join(hosted, verdicts, ["host", "_at"], "left", salts=16, spread=spread)
    return out.select(*kept, "host", "listed", "listed_since", F.coalesce("blocked", F.lit(False)).alias("blocked"))


# ---------------------------------------------------------------- the query

def _number(text: Column, salt: str) -> Column:
    """A number below 65536 from the digest of a text."""
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(salt))), 1, 4), 16, 10).cast("int")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), number)


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries for the hosts of the pages and the domains they lie in, dated by their digests."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct().where("host is not null")
    names = hosts.select(F.explode(names_of(F.col("host"))).alias("name")).where("name like '%.%.%'").distinct()
    rolls = names.select("name", _number(F.col("name"), "/list").alias("roll"), _number(F.col("name"), "/day").alias("day"))
    listed = rolls.where("roll % 3 < 2").withColumn(
        "list", F.when(F.col("roll") % 3 == 0, "block").otherwise("allow"))
    start, gap = F.col("day") % 200, F.col("roll") % 60

    def entry(action: str, day: Column, holds: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), _day(day).alias("at"), holds.alias("holds"))

    actions = F.array(
        entry("add", start, F.lit(True)), entry("remove", start + 30 + gap, F.col("roll") % 2 == 0),
        entry("add", start + 100 + gap, F.col("roll") % 4 == 0))
    return listed.select("name", "list", F.inline(actions)).where("holds").drop("holds")


def op5(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = _day(_number(F.col("page_id").cast("string"), "/fetch") % 366)
    judged = evaluate(pages.withColumn("fetched_at", fetched), dated_entries(pages))
    return judged.select(
        "page_id", "host", F.col("fetched_at").cast("string").alias("fetched_at"), "listed",
        F.col("listed_since").cast("string").alias("listed_since"), "blocked")


OP5_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS row_no, page_id, nullif(regexp_replace(regexp_extract(lower(url),
           '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[\]]+)', 1), '\.+$', ''), '') AS host,
         DATE '2024-01-01' + CAST(('0x' || substr(md5(page_id || '/fetch'), 1, 4)) AS INTEGER) % 366 AS fetched_at
  FROM pages
), parts AS (
  SELECT DISTINCT host, string_split(host, '.') AS labels FROM p WHERE host IS NOT NULL
), names AS (
  SELECT host, array_to_string(labels[i:], '.') AS name
  FROM (SELECT host, labels, unnest(range(1, len(labels) + 1)) AS i FROM parts)
), rolls AS (
  SELECT DISTINCT name, CAST(('0x' || substr(md5(name || '/list'), 1, 4)) AS INTEGER) AS roll,
         CAST(('0x' || substr(md5(name || '/day'), 1, 4)) AS INTEGER) AS day FROM names WHERE name LIKE '%.%.%'
), listed AS (
  SELECT *, CASE WHEN roll % 3 = 0 THEN 'block' ELSE 'allow' END AS list, DATE '2024-01-01' + day % 200 AS start
  FROM rolls WHERE roll % 3 < 2
), entries AS (
  SELECT name, list, true AS is_on, start AS at_day FROM listed
  UNION SELECT name, list, false, start + 30 + roll % 60 FROM listed WHERE roll % 2 = 0
  UNION SELECT name, list, true, start + 100 + roll % 60 FROM listed WHERE roll % 4 = 0
), spans AS (
  SELECT name, list, is_on, at_day AS since, lead(at_day) OVER (PARTITION BY name, list ORDER BY at_day) AS until
  FROM entries
), active AS (
  SELECT row_no, s.name AS listed, s.since AS listed_since, list = 'block' AS blocked,
         row_number() OVER (PARTITION BY row_no ORDER BY length(s.name) DESC, list = 'allow' DESC) AS place
  FROM p JOIN names USING (host) JOIN spans s ON s.name = names.name AND is_on AND since <= fetched_at
       AND (until IS NULL OR fetched_at < until)
)
SELECT page_id, host, CAST(fetched_at AS VARCHAR) AS fetched_at, listed, CAST(listed_since AS VARCHAR) AS listed_since,
       coalesce(blocked, false) AS blocked
FROM p LEFT JOIN active ON p.row_no = active.row_no AND place = 1
"""
