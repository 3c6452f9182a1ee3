"""URL filters: dated list entries as validity intervals, joined as of each capture's fetch time.

A list is a history of entries (key, category, action 'add' or 'remove', day). A key is a host, a domain above
it, or a host with leading path directories, ending in '/'. Each entry holds until the next entry of its key,
so the history becomes intervals [since, until) in which a key is listed. A capture (page, url, fetch day) asks
for all keys of its URL; every listed key counts, and the most specific one (the longest, then the first in
order) gives the decision.

Captures of one host on one day ask the same question, so questions are made distinct before the join: a host
that holds a third of all pages costs one question a day and key. The join is an equi-join on the key with the
day range as a further condition, and pages get their answers back by (key, day).

Defined results: a null url or one without a host has no keys and is kept; a null day asks nothing and is kept;
of several entries of a key on one day 'remove' holds over 'add', then the first category; entries with a null
key, action or day are ignored; rows equal in page_id, url and day give one row; an empty list keeps all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def keys_of(url: Column) -> Column:
    """All keys of a URL: the host, the domains above it down to two labels, the host with each directory."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    steps = F.split(F.regexp_extract(url, _PATH, 1), "/")  # '', directories ..., file
    dirs = F.size(steps) - 2
    paths = F.when(dirs >= 1, F.transform(F.sequence(F.lit(1), F.greatest(dirs, F.lit(1))), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 2, i), "/"), F.lit("/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, category, since, until): the days [since, until) on which a key is listed; until null: still is."""
    rows = entries.where("key IS NOT NULL AND action IS NOT NULL AND day IS NOT NULL").groupBy("key", "day")
    # the one entry of a key and day that holds
    rows = rows.agg(F.max("action").alias("action"), F.min("category").alias("category"))
    later = F.lead("day").over(Window.partitionBy("key").orderBy("day"))
    return rows.withColumn("until", later).where("action = 'add'").select("key", "category", F.col("day").alias("since"), "until")


def decide(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Of each row of `captures` (page_id, url, day): the row's columns, host, blocked, n_listed (its keys that
    were listed that day), listed_key, category and since of the most specific one."""
    asks = captures.select("page_id", "url", "day", host_of(F.col("url")).alias("host"), F.explode_outer(keys_of(F.col("url"))).alias("key"))
    questions = asks.where("key IS NOT NULL AND day IS NOT NULL").select("key", "day").distinct()
    valid = intervals(entries)
    answers = questions.join(valid, (questions["key"] == valid["key"]) & (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until"))))
    answers = answers.select(questions["key"].alias("listed"), F.col("day").alias("on"), "category", "since")
    told = asks.join(answers, (asks["key"] == answers["listed"]) & (asks["day"] == answers["on"]), "left")
    best = F.min(F.when(F.col("listed").isNotNull(), F.struct((-F.length("listed")).alias("n"), "listed", "category", "since")))
    out = told.groupBy("page_id", "url", "day", "host").agg(F.count_distinct("listed").alias("n_listed"), best.alias("best"))
    return out.select("page_id", "url", "day", "host", (F.col("n_listed") > 0).alias("blocked"), "n_listed", F.col("best.listed").alias("listed_key"), F.col("best.category").alias("category"), F.col("best.since").alias("since"))


# --- the tables of the registered query, derived from pages -------------------------------------------------

# Fixed values of the derivation: days of one year, kinds of lists.
FIRST_DAY, DAYS = "2024-01-01", 360
CATEGORIES = ("adult", "malware", "phishing", "spam")


def _number(x: Column) -> Column:
    """A uniform 32-bit number from an md5."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")


def derived_captures(pages: DataFrame) -> DataFrame:
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (_number(F.concat(F.lit("fetch"), F.col("page_id").cast("string"))) % DAYS).cast("int"))
    return pages.select("page_id", "url", day.alias("day"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list over all keys that pages have: a third of the keys are added once; of those half are
    removed 60 days later, and every fifth comes back after another 60 days."""
    keys = pages.select(F.explode(keys_of(F.col("url"))).alias("key")).distinct().withColumn("n", _number(F.concat(F.lit("list"), F.col("key")))).where("n % 3 = 0")
    start = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.floor(F.col("n") / 30) % (DAYS - 120)).cast("int"))
    event = lambda action, after, when: F.when(when, F.struct(F.lit(action).alias("action"), F.date_add(start, after).alias("day")))
    events = F.array(event("add", 0, F.lit(True)), event("remove", 60, F.col("n") % 2 == 0), event("add", 120, F.col("n") % 5 == 0))
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.floor(F.col("n") / 7) % len(CATEGORIES) + 1).cast("int"))
    return keys.select("key", category.alias("category"), F.explode(F.filter(events, lambda e: e.isNotNull())).alias("event")).select("key", "category", "event.action", "event.day")


def report(pages: DataFrame) -> DataFrame:
    return decide(derived_captures(pages), derived_entries(pages)).drop("url")
