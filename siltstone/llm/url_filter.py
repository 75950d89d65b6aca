"""URL filters with dated lists: every capture against what was listed when it was taken.

Dated entries of a list become validity intervals of their key, which are disjoint. A
capture is looked up as of its time under its address, its host and its domain, one
equality join with a range each. Only built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = ("url", "host", "domain")


def intervals(entries: DataFrame) -> DataFrame:
    """(level, key, action, valid_from, valid_to) of entries (level, key, at, action).

    An entry holds from its time until the next entry of its key, or for good
    (``valid_to`` null). Action "remove" ends what was listed. Of several entries of a key
    at one time the alphabetically first action counts. Entries with a null in level,
    key or time are void; a null action is "remove".
    """
    action = F.coalesce("action", F.lit("remove")).alias("action")
    known = entries.select("level", "key", "at", action).dropna()
    known = known.groupBy("level", "key", "at").agg(F.min("action").alias("action"))
    later = Window.partitionBy("level", "key").orderBy("at")
    return (
        known.withColumn("valid_to", F.lead("at").over(later))
        .filter("action <> 'remove'")
        .select("level", "key", "action", F.col("at").alias("valid_from"), "valid_to")
    )


def normal_url(url: Column) -> Column:
    """Scheme and fragment off, host lowered, no slash at the end; null stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    return F.regexp_replace(
        F.concat(F.lower(host), F.substring(bare, F.char_length(host) + 1, 1 << 30)), "/$", ""
    )


def host_of(url: Column) -> Column:
    """Host of an address without user and port; null if there is none."""
    host = F.lower(
        F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    )
    return F.when(host != "", host)


def domain_of(host: Column) -> Column:
    """The last two labels of a host; a host of fewer labels is its own domain."""
    return F.regexp_extract(host, r"[^.]*(?:\.[^.]*)?$", 0)


def filter_captures(
    captures: DataFrame, entries: DataFrame, levels: Sequence[str] = LEVELS
) -> DataFrame:
    """``captures`` (key, url, fetched) with the entry that was in force, if any.

    Columns: key, url, fetched, level, listed (the entry's key), action, valid_from,
    allowed. The most specific level that has an entry decides; a capture is allowed
    unless that entry's action is "block". Null addresses or times match nothing and are
    allowed. There is a row for each row of ``captures``, repeated ones included.
    """
    host = host_of(F.col("url"))
    df = captures.select(
        "key",
        "url",
        "fetched",
        normal_url(F.col("url")).alias("k_url"),
        host.alias("k_host"),
        domain_of(host).alias("k_domain"),
    )
    valid = intervals(entries)
    for level in levels:
        own = valid.filter(F.col("level") == level).select(
            F.col("key").alias("v_key"),
            F.struct(
                F.lit(level).alias("level"),
                F.col("key").alias("listed"),
                "action",
                "valid_from",
            ).alias(f"e_{level}"),
            F.col("valid_from").alias("v_from"),
            F.col("valid_to").alias("v_to"),
        )
        # Intervals of a key are disjoint: at most one matches, and no row doubles.
        in_force = (
            (F.col(f"k_{level}") == F.col("v_key"))
            & (F.col("fetched") >= F.col("v_from"))
            & (F.col("v_to").isNull() | (F.col("fetched") < F.col("v_to")))
        )
        df = df.join(own, in_force, "left").drop("v_key", "v_from", "v_to", f"k_{level}")
    chosen = F.coalesce(*[F.col(f"e_{level}") for level in levels])
    return df.select("key", "url", "fetched", chosen.alias("e")).select(
        "key",
        "url",
        "fetched",
        "e.level",
        "e.listed",
        "e.action",
        "e.valid_from",
        F.coalesce(F.col("e.action") != "block", F.lit(True)).alias("allowed"),
    )


# --- a list and fetch times for the pages table -------------------------------


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of a pages table, which has no times: one each hour, by page id."""
    hour = F.pmod(F.col("page_id"), F.lit(8784)) * 3600
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return pages.select(
        F.col("page_id").alias("key"),
        "url",
        F.timestamp_seconds(start + hour).cast("timestamp_ntz").alias("fetched"),
    )


def page_list(captures: DataFrame) -> DataFrame:
    """Dated entries for hosts, domains and addresses that occur in the captures.

    Which are listed, when and how follows from the smallest page id of each: every
    third host is blocked for a while, and again later; every fifth domain has its block
    lifted; every seventh address is allowed explicitly for half a year.
    """
    host = host_of(F.col("url"))
    keys = captures.select(
        F.col("key").alias("id"),
        normal_url(F.col("url")).alias("url"),
        host.alias("host"),
        domain_of(host).alias("domain"),
    )
    plans = {
        "host": (3, [(30, "block"), (150, "remove"), (240, "block")]),
        "domain": (5, [(0, "block"), (60, "remove")]),
        "url": (7, [(90, "allow"), (270, "remove")]),
    }
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    found = None
    for level, (nth, events) in plans.items():
        first = keys.groupBy(F.col(level).alias("key")).agg(F.min("id").alias("id"))
        first = first.filter((F.col("key") != "") & (F.col("id") % nth == 0))
        event = F.explode(
            F.array(
                *[F.struct(F.lit(d).alias("day"), F.lit(a).alias("action")) for d, a in events]
            )
        )
        dated = first.select("key", "id", event.alias("e")).select(
            F.lit(level).alias("level"),
            "key",
            F.timestamp_seconds(
                start + (F.col("e.day") + F.pmod(F.col("id"), F.lit(28))) * 86400
            )
            .cast("timestamp_ntz")
            .alias("at"),
            "e.action",
        )
        found = dated if found is None else found.unionByName(dated)
    return found


ORACLE = r"""
WITH captures AS (
    SELECT page_id, url,
        TIMESTAMP '2024-01-01' + to_hours(((page_id % 8784 + 8784) % 8784)::INTEGER) AS fetched,
        regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS bare,
        nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host
    FROM pages
), keyed AS (
    SELECT page_id, url, fetched, host,
        regexp_replace(lower(regexp_extract(bare, '^[^/?]*')) || substr(bare, length(regexp_extract(bare, '^[^/?]*')) + 1), '/$', '') AS k_url,
        regexp_extract(host, '[^.]*(?:\.[^.]*)?$') AS domain
    FROM captures
), long AS (
    SELECT unnest(['url', 'host', 'domain']) AS level, unnest([k_url, host, domain]) AS key, page_id AS id FROM keyed
), firsts AS (
    SELECT level, key, min(id) AS id FROM long WHERE key IS NOT NULL AND key <> '' GROUP BY level, key
), plan(level, nth, day, action) AS (
    VALUES ('host', 3, 30, 'block'), ('host', 3, 150, 'remove'), ('host', 3, 240, 'block'),
        ('domain', 5, 0, 'block'), ('domain', 5, 60, 'remove'),
        ('url', 7, 90, 'allow'), ('url', 7, 270, 'remove')
), entries AS (
    SELECT f.level, f.key, p.action,
        TIMESTAMP '2024-01-01' + to_days((p.day + f.id % 28)::INTEGER) AS since
    FROM firsts f JOIN plan p ON f.level = p.level AND f.id % p.nth = 0
), valid AS (
    SELECT level, key, action, since AS valid_from,
        lead(since) OVER (PARTITION BY level, key ORDER BY since) AS valid_to
    FROM entries
), hits AS (
    SELECT k.page_id, k.url, k.fetched, v.level, v.key AS listed, v.action, v.valid_from,
        row_number() OVER (
            PARTITION BY k.page_id
            ORDER BY CASE v.level WHEN 'url' THEN 0 WHEN 'host' THEN 1 ELSE 2 END
        ) AS n
    FROM keyed k JOIN valid v
        ON ((v.level = 'url' AND v.key = k.k_url) OR (v.level = 'host' AND v.key = k.host)
            OR (v.level = 'domain' AND v.key = k.domain))
        AND k.fetched >= v.valid_from AND (v.valid_to IS NULL OR k.fetched < v.valid_to)
        AND v.action <> 'remove'
)
SELECT k.page_id, k.fetched, h.level, h.listed, h.action, h.valid_from,
    coalesce(h.action <> 'block', true) AS allowed
FROM keyed k LEFT JOIN hits h ON h.page_id = k.page_id AND h.n = 1
"""
