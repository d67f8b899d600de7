"""URL filters as of the time of the fetch.

A list is a log of dated changes: from a day on a pattern is blocked, allowed, or not listed
any more. Each change is valid until the pattern's next one, so the log becomes validity
intervals, and a capture is judged by the entries that were active when it was fetched, not
by today's list. Patterns are hosts (which cover their subdomains) and hosts with leading
path segments, as many as the list gives; hosts are read in lower case, paths as written.
Lists write the same entry in many ways: scheme, user, port, a leading dot, empty segments
and a slash at the end are left out (`entry_of`). DataFrame functions only.

A decision follows from url and day alone, so it is made once for each pair and joined back:
captures need no number of their own, wherever they come from.

Intervals are cut at months, and captures join them on pattern and month: a capture meets
only the few intervals of its own month, however long a pattern's history is. The intervals
of a pattern do not overlap, so each capture matches a pattern once at most. A host that
holds a third of all captures is split by AQE, for the other side has few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.operators.joins import attach

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"
MONTH = 30
_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)"
# An entry: scheme, user, host, port and path; nothing behind a path.
_ENTRY = r"(?i)^\s*(?:(?:[a-z][a-z0-9+.-]*:)?//)?+(?:[^/?#@\s]*@)?\.*([^/:?#@\s]+?)\.?(?::[0-9]*)?(/[^?#\s]*)?\s*$"


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), _HOST, 1)


def entry_of(pattern: Column) -> Column:
    """A list entry in the form of `keys_of`: the host in lower case, then its path segments.
    Null for what is no host with a path: a query, a fragment, white space within, nothing."""
    host, path = F.regexp_extract(pattern, _ENTRY, 1), F.regexp_extract(pattern, _ENTRY, 2)
    segments = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.when(host != "", F.array_join(F.concat(F.array(F.lower(host)), segments), "/"))


def unreadable(changes: DataFrame) -> DataFrame:
    """The changes of a list whose pattern is no entry; `judge` leaves them out."""
    return changes.where(entry_of(F.col("pattern")).isNull())


def deepest(changes: DataFrame) -> int:
    """The most path segments a pattern of the list has."""
    parts = F.size(F.split(entry_of(F.col("pattern")), "/")) - 1
    return changes.agg(F.max(parts)).first()[0] or 0


def keys_of(url: Column, segments: int) -> Column:
    """Patterns that cover a url: its host and the hosts above it, and the host with its
    first path segments, up to `segments`. Empty for a null url or one without a host."""
    host, path = host_of(url), F.regexp_extract(url, _PATH, 1)
    labels = F.split(host, r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    count = F.least(F.size(parts), F.lit(segments))
    inside = F.when(count > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda k: F.concat_ws("/", host, F.array_join(F.slice(parts, 1, k), "/")),
    )).otherwise(F.array().cast("array<string>"))
    return F.when(F.length(host) > 0, F.array_distinct(F.concat(above, inside))).otherwise(
        F.array().cast("array<string>")
    )


def intervals(changes: DataFrame) -> DataFrame:
    """pattern, action, since, until (exclusive, null: still valid) of a log of changes
    (pattern, day, action). Of several changes of a pattern on one day the strictest counts:
    block before allow before remove. Rows with a null, other actions and patterns that are
    no entry are no changes."""
    rank = F.when(F.col("action") == BLOCK, 0).when(F.col("action") == ALLOW, 1)
    rank = rank.when(F.col("action") == REMOVE, 2)
    log = changes.select(
        entry_of(F.col("pattern")).alias("pattern"), F.col("day").cast("int").alias("day"), rank.alias("rank")
    )
    log = log.where("pattern is not null and day is not null and rank is not null")
    daily = log.groupBy("pattern", "day").agg(F.min("rank").alias("rank"))
    following = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    spans = daily.withColumn("until", following).where("rank < 2")
    action = F.when(F.col("rank") == 0, BLOCK).otherwise(ALLOW)
    return spans.select("pattern", action.alias("action"), F.col("day").alias("since"), "until")


def judge(captures: DataFrame, changes: DataFrame, last_day: int) -> DataFrame:
    """capture_id, fetch_day, decision, pattern, n_active of every row of `captures`
    (capture_id, url, fetch_day).

    n_active counts the active entries that cover the url; the longest pattern decides, of
    one pattern there is one active entry at most. Without an active entry, and for a null
    url or day, the decision is "none" and the pattern null. `last_day` is the last day of
    the captures: open intervals are cut into months up to it. Repeated captures stay.
    """
    spans = intervals(changes).where(F.col("since") <= last_day)
    end = F.least(F.coalesce(F.col("until") - 1, F.lit(last_day)), F.lit(last_day))
    months = F.sequence(F.floor(F.col("since") / MONTH), F.floor(end / MONTH))
    spans = spans.withColumn("month", F.explode(months))
    rows = captures.select("capture_id", "url", "fetch_day")
    pairs = rows.select("url", "fetch_day").where("url is not null and fetch_day is not null").distinct()
    asked = pairs.withColumn("month", F.floor(F.col("fetch_day") / MONTH))
    keys = keys_of(F.col("url"), deepest(changes))
    asked = asked.select("url", "fetch_day", "month", F.explode(keys).alias("pattern"))
    active = asked.join(spans, ["pattern", "month"]).where(
        (F.col("since") <= F.col("fetch_day"))
        & (F.col("until").isNull() | (F.col("fetch_day") < F.col("until")))
    )
    best = active.groupBy("url", "fetch_day").agg(
        F.max(F.struct(F.length("pattern").alias("size"), "pattern", "action")).alias("best"),
        F.count("*").alias("n"),
    )
    out = attach(rows, best, ["url", "fetch_day"])
    return out.select(
        "capture_id",
        "fetch_day",
        F.coalesce("best.action", F.lit("none")).alias("decision"),
        F.col("best.pattern").alias("pattern"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
    )


DAYS = 720


def _number(text: Column, least: int) -> Column:
    """A number of seven hex digits drawn from a text."""
    return F.conv(F.substring(F.md5(text), least, 7), 16, 10).cast("long")


def list_from(pages: DataFrame) -> DataFrame:
    """A list to judge the given pages by: four dated changes of every host of theirs, every
    domain above it and every host with its first and its first two path segments; days and
    actions are drawn from the pattern's digest, and the way the entry is written too."""
    path = F.regexp_extract("url", _PATH, 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    hosts = pages.select(host_of(F.col("url")).alias("host"), parts.alias("parts")).where("host <> ''")
    above = F.regexp_replace("host", r"^[^.]+\.", "")
    inside = [
        F.when(F.size("parts") >= k, F.concat_ws("/", "host", F.array_join(F.slice("parts", 1, k), "/")))
        for k in (1, 2)
    ]
    patterns = hosts.select(F.explode(F.array("host", above, *inside)).alias("pattern"))
    patterns = patterns.where("pattern is not null").distinct()
    drawn = patterns.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    name = F.concat("pattern", F.lit("#"), F.col("k").cast("string"))
    action = F.element_at(F.array(F.lit(BLOCK), F.lit(ALLOW), F.lit(REMOVE)),
                          (_number(name, 9) % 3 + 1).cast("int"))
    host = F.substring_index("pattern", "/", 1)
    rest = F.substring(F.col("pattern"), F.length(host) + 1, F.length("pattern"))
    way = _number(name, 17) % 6
    written = (
        F.when(way == 0, F.concat("pattern", F.lit("/")))
        .when(way == 1, F.concat(F.lit("HTTP://"), "pattern"))
        .when(way == 2, F.concat(F.lit("."), "pattern"))
        .when(way == 3, F.concat(F.upper(host), F.lit(":8080"), rest))
        .when(way == 4, F.concat(F.lit("https://user@"), host, F.regexp_replace(rest, "/", "//")))
        .otherwise(F.col("pattern"))
    )
    return drawn.select(written.alias("pattern"), (_number(name, 1) % DAYS).cast("int").alias("day"), action.alias("action"))


def judged_pages(pages: DataFrame) -> DataFrame:
    """page_id, fetch_day, decision, pattern, n_active of every page; a page's day of fetch
    is drawn from the digest of its id."""
    day = (_number(F.concat(F.lit("fetch:"), F.col("page_id").cast("string")), 1) % DAYS).cast("int")
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", day.alias("fetch_day"))
    return judge(captures, list_from(pages), DAYS - 1).withColumnRenamed("capture_id", "page_id")


ORACLE = r"""
WITH p AS (SELECT page_id, url,
    (('0x' || substr(md5('fetch:' || page_id), 1, 7))::BIGINT % 720)::INT AS fetch_day,
    regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1) AS host,
    list_filter(string_split(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'),
      lambda x: x <> '') AS parts FROM pages),
q AS (SELECT *, host || '/' || array_to_string(parts, '/') || '/' AS place FROM p),
pat AS (SELECT host AS pattern FROM p WHERE host <> ''
  UNION SELECT regexp_replace(host, '^[^.]+\.', '') FROM p WHERE host <> ''
  UNION SELECT host || '/' || parts[1] FROM p WHERE host <> '' AND len(parts) >= 1
  UNION SELECT host || '/' || parts[1] || '/' || parts[2] FROM p WHERE host <> '' AND len(parts) >= 2),
log AS (SELECT pattern, (('0x' || substr(md5(pattern || '#' || k), 1, 7))::BIGINT % 720)::INT AS day,
    (('0x' || substr(md5(pattern || '#' || k), 9, 7))::BIGINT % 3)::INT AS rank
  FROM pat, (VALUES (0), (1), (2), (3)) v(k)),
daily AS (SELECT pattern, day, min(rank) AS rank FROM log GROUP BY 1, 2),
spans AS (SELECT *, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS until FROM daily),
hits AS (SELECT q.page_id, s.pattern, s.rank
  FROM q JOIN spans s ON s.day <= q.fetch_day AND (s.until IS NULL OR q.fetch_day < s.until) AND s.rank < 2
   AND q.host <> ''
   AND (q.host = s.pattern OR ends_with(q.host, '.' || s.pattern)
        OR contains(s.pattern, '/') AND starts_with(q.place, s.pattern || '/')))
SELECT q.page_id, q.fetch_day,
  coalesce(max_by(CASE h.rank WHEN 0 THEN 'block' ELSE 'allow' END, length(h.pattern)), 'none') AS decision,
  max_by(h.pattern, length(h.pattern)) AS pattern, count(h.pattern) AS n_active
FROM q LEFT JOIN hits h USING (page_id) GROUP BY 1, 2
"""
