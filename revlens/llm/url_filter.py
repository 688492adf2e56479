"""Captures of URLs judged by the list entries that were active when they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from revlens.llm.text import checked_broadcast
from revlens.session import staged

DAY = 86_400
PERIOD = 30 * DAY
URL = r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)(?::[0-9]*)?(/[^?#]*)?"


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot; null for what isn't scheme://host."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"\.$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, URL, 2)


def keys_of(host: Column, path: Column, depth: int) -> Column:
    """array<struct<key, rank>> of all entries that can cover a URL: the host and its parent
    domains, and the host with the first 1..depth folders of the path; higher ranks are narrower."""
    labels = F.split(host, "\\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.array_join(F.slice(labels, i, n - i + 1), ".").alias("key"), (n - i + 1).cast("int").alias("rank")))
    if depth < 1:
        return domains
    folders = F.split(path, "/")  # "/a/b/c" -> "", a, b, c; the last isn't a folder
    most = F.least(F.size(folders) - 2, F.lit(depth))
    below = F.when(most > 0, F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda k: F.struct(
        F.concat(host, F.lit("/"), F.array_join(F.slice(folders, F.lit(2), k), "/"), F.lit("/")).alias("key"),
        (k + 1000).cast("int").alias("rank"))))
    return F.concat(domains, F.coalesce(below, F.expr("array()").cast("array<struct<key:string,rank:int>>")))


def intervals(changes: DataFrame) -> DataFrame:
    """(list, key, since, until) during which an entry stands, from dated changes (list, key, action, at).

    A state lasts until the entry's next change; of changes at the same second a removal counts.
    `until` is null while nothing ends it. Days that hold a change of an entry come first, so that an entry with very many
    changes is cut into days: the next change is looked up in the day, and for the day's last
    one among the first changes of the entry's days.
    """
    usable = changes.where("list is not null and key is not null and at is not null and action in ('add', 'remove')")
    once = usable.groupBy("list", "key", "at").agg(F.max("action").alias("action")).withColumn("day", F.floor(F.col("at") / DAY))
    days = once.groupBy("list", "key", "day").agg(F.min("at").alias("first"))
    later = days.select("list", "key", "day", F.lead("first").over(W.partitionBy("list", "key").orderBy("day")).alias("later"))
    inside = F.lead("at").over(W.partitionBy("list", "key", "day").orderBy("at"))
    ended = once.withColumn("inside", inside).join(later, ["list", "key", "day"])
    return ended.where("action = 'add'").select("list", "key", F.col("at").alias("since"), F.coalesce("inside", "later").alias("until"))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """(id, url, fetched, host, verdict, entry, since, n_active) for every distinct row of `captures`.

    `captures` has id, url and fetched (seconds), `changes` has list ('block' or 'allow'), key, action
    ('add' or 'remove') and at (seconds). A key is a host, a domain (it covers all hosts below) or a
    host with folders, `host/a/b/`. Every capture meets the entries active at its time: of those
    that cover it the narrowest decides, at the same width `allow` goes before `block`; `verdict` is
    'blocked', 'allowed', 'clean' (no entry) or 'invalid' (no host, no id or no time).

    The as-of join is by key and month: an interval stands in each month it touches, so a host
    with very many captures or changes is cut along time, and a key's rows meet only the
    intervals of their own month. The intervals are broadcast only if a count finds them few.

    Null or malformed URLs are 'invalid'; ties give one row, as do repeated captures. Without
    changes all else is 'clean'; without captures there are no rows.
    """
    seen = captures.select("id", "url", F.col("fetched").cast("bigint").alias("fetched")).distinct()
    parsed = seen.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    valid = parsed.where("host is not null and id is not null and fetched is not null")
    spans = staged(intervals(changes), "intervals")
    depth = spans.agg(F.max(F.size(F.split("key", "/")) - 2)).first()[0] or 0
    last = seen.agg(F.max("fetched")).first()[0] or 0
    end = F.coalesce(F.col("until"), F.lit(last + 1))
    months = F.sequence(F.floor(F.col("since") / PERIOD), F.floor((end - 1) / PERIOD))
    pieces = spans.where((F.col("since") <= last) & (end > F.col("since"))).withColumn(
        "until", F.least(end, F.lit(last + 1))).where("until > since").select(
        "list", F.col("key").alias("k"), "since", "until", F.explode(months).alias("m")).where(F.col("m") <= F.floor(F.lit(last) / PERIOD))
    wanted = valid.select("id", "url", "fetched", F.explode(keys_of(F.col("host"), F.col("path"), depth)).alias("at")).select(
        "id", "url", "fetched", "at.key", "at.rank", F.floor(F.col("fetched") / PERIOD).alias("month"))
    hits = wanted.join(
        checked_broadcast(pieces, 200_000),
        (F.col("key") == F.col("k")) & (F.col("month") == F.col("m")) & (F.col("fetched") >= F.col("since")) & (F.col("fetched") < F.col("until")))
    best = F.max(F.struct("rank", (F.col("list") == "allow").alias("allow"), "key", "since")).alias("best")
    judged = hits.groupBy("id", "url", "fetched").agg(best, F.count("*").alias("n"))
    whole = parsed.alias("p").join(judged.alias("j"), F.col("p.id").eqNullSafe(F.col("j.id")) & F.col("p.url").eqNullSafe(F.col("j.url"))
                                   & F.col("p.fetched").eqNullSafe(F.col("j.fetched")), "left")
    invalid = F.col("p.host").isNull() | F.col("p.id").isNull() | F.col("p.fetched").isNull()
    verdict = F.when(invalid, "invalid").when(F.col("j.best").isNull(), "clean").when(F.col("j.best.allow"), "allowed").otherwise("blocked")
    return whole.select("p.id", "p.url", "p.fetched", "p.host", verdict.alias("verdict"), F.col("j.best.key").alias("entry"),
                        F.col("j.best.since").alias("since"), F.coalesce("j.n", F.lit(0)).cast("bigint").alias("n_active"))
