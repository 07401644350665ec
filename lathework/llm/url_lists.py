"""URL filters with history: every capture is judged by the entries active when it was fetched.

Dated additions and removals become validity intervals. Hosts are matched once each, not
capture by capture: a host's history is the intervals of its own name and of the domains
above it. Captures then meet their host's history in an as-of join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import narrow
from lathework.session import settle

HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case without a final point; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1), r"\.+$", "")


def domains_of(host: Column) -> Column:
    """The host and all domains above it."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``domain, kind, since, until`` from ``domain, kind, at, action``.

    An addition holds until the next entry of the same domain and kind; without one, for
    ever (``until`` is null). Of entries at the same time the removal counts last, so it wins.
    Rows with a null in any column, and other actions, are no entries.
    """
    known = entries.dropna(subset=["domain", "kind", "at", "action"]).filter(F.col("action").isin("add", "remove")).distinct()
    by_time = W.partitionBy("domain", "kind").orderBy("at", "action")
    return known.withColumn("until", F.lead("at").over(by_time)).filter(
        "action = 'add' AND (until IS NULL OR until > at)"
    ).select("domain", "kind", F.col("at").alias("since"), "until")


def histories(hosts: DataFrame, entries: DataFrame) -> DataFrame:
    """``host, history``: the intervals of all domains of each host, the longest domain first."""
    keys = hosts.select("host", F.explode(domains_of(F.col("host"))).alias("domain"))
    found = keys.join(intervals(entries), "domain")
    one = F.struct((-F.length("domain")).alias("rank"), "kind", "domain", "since", "until")
    return found.groupBy("host").agg(F.sort_array(F.collect_list(one)).alias("history"))


def judge(captures: DataFrame, entries: DataFrame, url="url", at="fetched_at") -> DataFrame:
    """``captures`` with ``url_host, url_blocked, url_rule, url_active``.

    ``entries``: ``domain, kind`` (``block`` or ``allow``)``, at, action`` (``add`` or
    ``remove``), of the same time type as ``at``. An interval holds from its first instant and
    not at its last. Of the active entries the longest domain decides, and an ``allow``
    before a ``block``; ``url_rule`` is that domain and ``url_active`` counts the active ones.
    A capture without host or time is not blocked. Repeated rows are judged one by one. An
    empty table of either kind gives a whole result.
    """
    whole = captures.select(F.struct(*[c(x) for x in captures.columns]).alias("whole"), host_of(c(url)).alias("host"), c(at).alias("_at"))
    history = settle(histories(whole.select("host").filter("host != ''").distinct(), entries), "histories")
    joined = whole.join(history.withColumnRenamed("host", "_h"), F.col("host") == F.col("_h"), "left")
    active = F.filter(
        F.col("history"), lambda x: (x["since"] <= F.col("_at")) & (x["until"].isNull() | (x["until"] > F.col("_at")))
    )
    joined = joined.withColumn("active", active).withColumn("first", F.get("active", F.lit(0)))
    return joined.select(
        "whole.*", F.col("host").alias("url_host"), F.coalesce(F.col("first.kind") == "block", F.lit(False)).alias("url_blocked"),
        F.col("first.domain").alias("url_rule"), F.coalesce(F.size(F.filter("active", lambda x: x["domain"].isNotNull())), F.lit(0)).cast("long").alias("url_active"),
    )


def number(domain: Column) -> Column:
    """A number below 2^24 from a domain's md5."""
    return F.conv(F.substring(F.md5(domain), 1, 6), 16, 10).cast("long")


def example_entries(hosts: DataFrame, start: int) -> DataFrame:
    """A list with history for the given hosts and their domains, by the hash of each domain.

    Three in ten domains are blocked, freed after 60 days and blocked again after 120, one in
    ten is allowed, one in ten is blocked for good.
    """
    domains = hosts.select(F.explode(domains_of(F.col("host"))).alias("domain")).distinct().withColumn("n", number(F.col("domain")))
    day = lambda d: F.lit(start) + d * 86400
    n, turn = F.col("n"), F.col("n") % 10
    entry = lambda kind, at, action: F.struct(F.lit(kind).alias("kind"), day(at).alias("at"), F.lit(action).alias("action"))
    events = F.when(turn < 3, F.array(
        entry("block", n % 200, "add"), entry("block", n % 200 + 60, "remove"), entry("block", n % 200 + 120, "add")
    )).when(turn == 3, F.array(entry("allow", n % 100, "add"))).when(turn == 4, F.array(entry("block", n % 300, "add")))
    return domains.filter(turn < 5).select("domain", F.explode(events).alias("e")).select("domain", "e.*")


def with_fetch_time(pages: DataFrame, start: int) -> DataFrame:
    """Pages with a time of capture spread over a year by their id."""
    return narrow(
        pages, page_id=c("page_id"), url=c("url"), fetched_at=F.lit(start) + F.pmod(c("page_id") * 7919, F.lit(365)) * 86400
    )
