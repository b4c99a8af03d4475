"""Operator 6: URL lists as of the time of capture.

A list is a log of dated changes (scope, value, action, added, on): from ``on`` the entry is
in force if ``added``, else no longer; of changes on one day an addition wins.  Changes are
summed by entry and day before they are shuffled, and each entry's changes become validity
intervals [valid_from, valid_to).

Scopes: ``domain`` (the host or a parent of it, of at least two labels), ``host`` (the exact
host) and ``prefix`` (host and path up to a slash).  A capture (url, fetched_on) has one key
for each that could match, and an as-of join finds the entries in force on its day.  Both
sides also join on the period of ``PERIOD_DAYS`` that the day is in, with intervals cut at
the periods, so that a capture meets the few changes of one period, however long the
entry's history is; a hot host is a skewed join that Spark splits, and equal captures are
evaluated once.

The most specific entry in force decides (prefix before host before domain, then the longer
value, then block before allow).  NULL, empty and unparsable URLs and NULL days match
nothing; changes with a NULL in any column are passed over; extra columns are ignored;
every capture row gets a result row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD_DAYS = 30
SCOPES = ["domain", "host", "prefix"]
_FAR = "9999-12-31"
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def keys_of(url: Column) -> Column:
    """array<struct<scope, value>> of every entry that could match."""
    host, path = host_of(url), path_of(url)
    labels, steps = F.split(host, r"\."), F.split(path, "/")
    pair = lambda scope, value: F.struct(F.lit(scope).alias("scope"), value.alias("value"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: pair(
        "domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: pair(
        "prefix", F.concat(host, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))))
    none = F.array().cast("array<struct<scope:string,value:string>>")
    return F.when(host == "", none).otherwise(F.concat(
        F.when(F.size(labels) > 1, domains).otherwise(none), F.array(pair("host", host)),
        F.when(path != "", prefixes).otherwise(none)))


def intervals(changes: DataFrame) -> DataFrame:
    """Change log (scope, value, action, added, on) -> scope, value, action, valid_from, valid_to."""
    entry = ["scope", "value", "action"]
    days = (changes.select(*entry, "added", "on").dropna()
            .groupBy(*entry, "on").agg(F.max("added").alias("added")))
    order = Window.partitionBy(*entry).orderBy("on")
    turns = (days.withColumn("before", F.coalesce(F.lag("added").over(order), F.lit(False)))
             .where(F.col("added") != F.col("before")))
    return (turns.withColumn("valid_to", F.coalesce(F.lead("on").over(order), F.lit(_FAR).cast("date")))
            .where("added").select(*entry, F.col("on").alias("valid_from"), "valid_to"))


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD_DAYS).cast("int")


def in_force(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (url, fetched_on) -> url, fetched_on, scope, value, action, valid_from of
    every entry in force for each distinct capture."""
    seen = (captures.select("url", "fetched_on").where("url is not null and fetched_on is not null").distinct()
            .select("url", "fetched_on", F.inline(keys_of(F.col("url"))))
            .withColumn("period", _period(F.col("fetched_on"))))
    # no capture is later than the last day that the captures have: open intervals end there
    last = captures.agg(F.max("fetched_on").alias("last")).first()["last"]
    end = F.least(F.date_sub("valid_to", 1), F.lit(last).cast("date"))
    pieces = (intervals(changes).where(F.col("valid_from") <= end)
              .withColumn("period", F.explode(F.sequence(_period(F.col("valid_from")), _period(end)))))
    return (seen.join(pieces, ["scope", "value", "period"])
            .where("valid_from <= fetched_on and fetched_on < valid_to")
            .select("url", "fetched_on", "scope", "value", "action", "valid_from"))


def evaluate(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (page_id, url, fetched_on) -> page_id, n_block, n_allow, verdict, entry, since."""
    rank = F.struct(F.array_position(F.array(*[F.lit(s) for s in SCOPES]), F.col("scope")),
                    F.length("value"), F.col("action") == "block")
    best = F.max_by(F.struct("action", "scope", "value", "valid_from"), rank)
    found = (in_force(captures, changes).groupBy("url", "fetched_on")
             .agg(F.count_if(F.col("action") == "block").alias("n_block"),
                  F.count_if(F.col("action") == "allow").alias("n_allow"), best.alias("best")))
    return (captures.select("page_id", "url", "fetched_on").join(found, ["url", "fetched_on"], "left")
            .select("page_id", F.coalesce("n_block", F.lit(0)).alias("n_block"),
                    F.coalesce("n_allow", F.lit(0)).alias("n_allow"),
                    F.coalesce("best.action", F.lit("none")).alias("verdict"),
                    F.concat_ws(":", "best.scope", "best.value").alias("entry"),
                    F.col("best.valid_from").cast("string").alias("since")))
