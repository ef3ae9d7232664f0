"""URL filters by dated lists: list changes become validity intervals, captures join those active at fetch time.

1. Entries. An entry names a host or parent domain, with or without a path: ``Example.com``, ``example.com/a/b``. Its host
   is lower-cased, a dot at the host's end, a scheme and a slash at the path's end are dropped, its path is kept as it is.
2. Intervals. Changes (list, entry, day, action) of one entry and day are reduced to the last action by name order
   (``remove`` after ``add``), map-side, so an entry has one change a day at most. Its changes in day order open and
   close intervals [from, to); an interval without a later change is open-ended.
3. Captures. A URL stands for the keys an entry can name: its host and every parent domain, each alone and with every
   prefix of the path, by segments, as deep as the deepest entry. A top-level domain is a key only if some entry is
   a name without a dot: else it would be a hot key of every capture.
4. As-of join. Closed intervals are cut at months, so a capture meets the intervals of its key in its month only: an
   equi-join on (key, month) and a range test. Open ones, one an entry and list, join on the key, without an end. A hot
   host is many captures and few intervals; the interval side is broadcast if it is small, else AQE splits the hot key.
5. Verdict. The longest active entry decides; between lists at one entry ``allow`` wins. No active entry: not blocked.

Defined cases: a URL without host, an empty or null one, and a null day match nothing; very long URLs are read whole,
their paths as deep as entries go; captures and changes may repeat, the result has a row a capture; changes with null
entry, day or an unknown action and entries without a host are ignored; a removal without an addition is nothing; empty
tables are fine; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import checked_broadcast

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"


def entry_of(entry):
    """An entry as the keys of captures spell it; null if it has no host."""
    bare = F.regexp_replace(F.trim(entry), SCHEME, "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?#]*)", 1)), "[.]+$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?#]*(/[^?#]*)", 1), "/+$", "")
    return F.when(host != "", F.concat(host, path))


def intervals(changes: DataFrame) -> DataFrame:
    """(list, entry, valid_from, valid_to): when an entry is on a list; ``valid_to`` is null while it is."""
    named = changes.select("list", entry_of(F.col("entry")).alias("entry"), F.col("day").cast("date").alias("day"), "action")
    daily = named.filter("entry is not null and day is not null and action in ('add', 'remove')").groupBy(
        "list", "entry", "day").agg(F.max("action").alias("action"))
    w = Window.partitionBy("list", "entry").orderBy("day")
    turns = daily.withColumn("was", F.lag("action", 1, "remove").over(w)).filter("action <> was")
    return turns.withColumn("valid_to", F.lead("day").over(w)).filter("action = 'add'").select("list", "entry", F.col("day").alias("valid_from"), "valid_to")


def host_of(url):
    found = F.regexp_extract(F.coalesce(url, F.lit("")), SCHEME + "(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(found), "[.]+$", "")


def keys_of(url, depth: int, single: bool):
    """What entries can name: host and parent domains (those without a dot if ``single``), each alone and with the path's
    first 1 to ``depth`` segments."""
    parts = F.split(host_of(url), "[.]")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    if not single:
        domains = F.filter(domains, lambda d: d.contains("."))
    path = F.regexp_extract(F.coalesce(url, F.lit("")), SCHEME + "[^/?#]*((?:/[^/?#]*+){0," + str(depth) + "})", 1)
    steps = F.slice(F.split(path, "/"), 2, max(depth, 1))  # what is before the first slash is empty
    paths = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.regexp_replace(
        F.array_join(F.concat(F.array(F.lit("")), F.slice(steps, F.lit(1), i)), "/"), "/+$", "")) if depth else F.array(F.lit(""))
    named = F.flatten(F.transform(domains, lambda d: F.transform(paths, lambda p: F.concat(d, p))))
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(named))


def evaluate(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """(page_id, url, day, n_active, entry, list, blocked) for every row of ``captures`` (page_id, url, day)."""
    spans = materialize(intervals(changes), "intervals")
    slashes = F.length("entry") - F.length(F.replace("entry", F.lit("/"), F.lit("")))
    depth, single = spans.agg(F.max(slashes), F.max((F.instr("entry", ".") == 0))).first()
    rows = materialize(captures.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("day").cast("date").alias("day"), F.monotonically_increasing_id().alias("row_id")), "captures")
    keyed = rows.filter("day is not null").select(
        "row_id", "day", F.explode(keys_of(F.col("url"), int(depth or 0), bool(single))).alias("key"))
    months = materialize(spans.filter("valid_to is not null").withColumn("m", F.explode(F.expr(
        "sequence(trunc(valid_from, 'month'), trunc(date_sub(valid_to, 1), 'month'), interval 1 month)"))), "months")
    closed = keyed.withColumn("month", F.trunc("day", "month")).join(checked_broadcast(months), F.expr(
        "key = entry and month = m and day >= valid_from and day < valid_to")).select("row_id", "list", "entry")
    still = keyed.join(checked_broadcast(spans.filter("valid_to is null")), F.expr(
        "key = entry and day >= valid_from")).select("row_id", "list", "entry")
    active = closed.union(still)
    # longest entry first, then allow before block
    best = F.max(F.struct(F.length("entry").alias("n"), (F.col("list") == "allow").alias("allow"), "entry", "list"))
    verdict = active.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_active"), best.alias("b"))
    return rows.join(verdict, "row_id", "left").select(
        "page_id", "url", "day", F.coalesce("n_active", F.lit(0)).alias("n_active"), F.col("b.entry").alias("entry"),
        F.col("b.list").alias("list"), F.coalesce(F.col("b.list") == "block", F.lit(False)).alias("blocked"))


# The pages table has neither fetch days nor lists; the query derives both from it.

def derived_captures(pages: DataFrame) -> DataFrame:
    """Pages fetched on days of 2024, by page_id."""
    return pages.select("page_id", "url", F.expr("date_add(date '2024-01-01', cast(pmod(page_id * 37, 366) as int))").alias("day"))


def derived_changes(pages: DataFrame) -> DataFrame:
    """Per host, by its MD5: some are blocked on a day of 2024 and maybe released 90 days later, some parent domains are
    blocked with some of their hosts' sections allowed."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)", 1).alias("section")).filter("host <> ''").distinct()
    h = hosts.withColumn("h", F.md5(F.col("host").cast("binary"))).withColumns({
        "pick": F.conv(F.substring("h", 1, 1), 16, 10).cast("int"),
        "day": F.expr("date_add(date '2024-01-01', cast(pmod(cast(conv(substring(h, 2, 4), 16, 10) as long), 300) as int))")})
    one = h.select("host", "pick", "day").distinct()
    block = one.filter("pick < 6").select(F.lit("block").alias("list"), F.col("host").alias("entry"), "day", F.lit("add").alias("action"))
    release = one.filter("pick < 3").select(F.lit("block"), "host", F.date_add("day", 90), F.lit("remove"))
    parent = one.filter("pick in (6, 7) and host like '%.%.%'").select(
        F.lit("block"), F.regexp_extract("host", r"^[^.]*[.](.*)$", 1), "day", F.lit("add"))
    allow = h.filter("pick < 9 and pick % 2 = 0 and section <> ''").select(
        F.lit("allow"), F.concat("host", "section"), F.date_add("day", 30), F.lit("add"))
    return block.union(release).union(parent).union(allow)


ORACLE = r"""
with hosts as (select distinct lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)', 1) as section from pages),
h as (select *, ('0x' || md5(host)[1:1])::int as pick,
    (date '2024-01-01' + (('0x' || md5(host)[2:5])::int % 300)::int)::date as day from hosts where host <> ''),
ch as (select 'block' as list, host as entry, day, 'add' as action from h where pick < 6
  union select 'block', host, (day + 90)::date, 'remove' from h where pick < 3
  union select 'block', regexp_extract(host, '^[^.]*[.](.*)$', 1), day, 'add' from h where pick in (6, 7) and host like '%.%.%'
  union select 'allow', host || section, (day + 30)::date, 'add' from h where pick < 9 and pick % 2 = 0 and section <> ''),
daily as (select list, entry, day, max(action) as action from ch group by all),
tr as (select *, lag(action, 1, 'remove') over (partition by list, entry order by day) as was from daily),
iv as (select * from (select list, entry, day as f, action, coalesce(lead(day) over (partition by list, entry order by day),
    date '9999-12-31') as t from tr where action <> was) where action = 'add'),
cap as (select page_id, url, (date '2024-01-01' + ((page_id * 37) % 366)::int)::date as day from pages),
k as (select page_id, day, unnest(list_distinct(list_concat(dd, [d || sec for d in dd]))) as key
  from (select *, [array_to_string(string_split(hh, '.')[i:], '.') for i in range(1, len(string_split(hh, '.')) + 1)] as dd
  from (select *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) as hh,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)', 1) as sec from cap) where hh <> '')),
a as (select page_id, list, entry, count(*) over (partition by page_id) as n, row_number() over (partition by page_id
    order by length(entry) desc, (list = 'allow') desc, entry desc) as r
  from k join iv on key = entry and day >= f and day < t)
select cap.page_id, cap.url, cap.day, coalesce(a.n, 0) as n_active, a.entry, a.list, coalesce(a.list = 'block', false) as blocked
from cap left join a on a.page_id = cap.page_id and a.r = 1
"""
