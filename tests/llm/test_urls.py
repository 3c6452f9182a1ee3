"""URL filters against a day-by-day reading of the list."""

import datetime as dt
import random
import re

from churnwise.llm import urls

DAY = dt.date(2024, 3, 1)


def keys(url):
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)[^/?#]*(/[^?#]*)?", url or "")
    if not m:
        return None, []
    host = m[1].lower()
    labels = host.split(".")
    found = [".".join(labels[k:]) for k in range(max(1, len(labels) - 1))]
    steps = (m[2] or "").split("/")[1:-1]
    return host, found + [host + "/" + "/".join(steps[: k + 1]) + "/" for k in range(len(steps))]


def active(entries, key, day):
    """The entry that holds on a day, read one day at a time."""
    last = None
    for k, category, action, on in entries:
        if k == key and action and on and on <= day:
            rank = (on, action)
            if last is None or rank > last[0]:
                last = (rank, None)
    if last is None or last[0][1] != "add":
        return None
    return min(c for k, c, a, on in entries if k == key and on == last[0][0] and a), last[0][0]


def test_decisions(spark):
    rng = random.Random(11)
    hosts = ["a.b.example.com", "b.example.com", "x.org", "WWW.X.org", "localhost"]
    paths = ["", "/", "/en/", "/en/p.html", "/en/deep/dir/file?q=1/2", "/en#frag/x"]
    captures = []
    for k in range(150):
        host = "b.example.com" if k % 3 == 0 else rng.choice(hosts)  # a hot host
        captures.append((k, rng.choice(["http://", "HTTPS://u:p@"]) + host + rng.choice(["", ":8080"]) + rng.choice(paths), DAY + dt.timedelta(rng.randrange(30))))
    captures += [(200, None, DAY), (201, "not a url", DAY), (202, "http://x.org/en/", None), (203, "http://", DAY), (204, "http://x.org/" + "d/" * 500, DAY)]
    names = sorted({k for _, u, _ in captures for k in keys(u)[1]})
    entries = []
    for name in names[:60]:
        for _ in range(rng.randrange(4)):
            entries.append((name, rng.choice(["spam", "adult"]), rng.choice(["add", "remove"]), DAY + dt.timedelta(rng.randrange(30))))
    entries += entries[:5] + [(None, "spam", "add", DAY), ("x.org", "spam", None, DAY), ("x.org", "spam", "add", None)]
    docs = spark.createDataFrame(captures, "page_id long, url string, day date").selectExpr("*", "1 AS key", "2 AS host", "3 AS since")
    found = urls.decide(docs.select("page_id", "url", "day"), spark.createDataFrame(entries, "key string, category string, action string, day date")).collect()
    assert len(found) == len(captures)
    for r in found:
        host, own = keys(r["url"])
        listed = {k: active(entries, k, r["day"]) for k in own if r["day"] and active(entries, k, r["day"])}
        assert (r["host"], r["blocked"], r["n_listed"]) == (host, bool(listed), len(listed))
        if listed:
            best = min(listed, key=lambda k: (-len(k), k))
            assert (r["listed_key"], (r["category"], r["since"])) == (best, listed[best])


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/x/y", None)], "page_id long, url string, html string")
    captures = urls.derived_captures(pages)
    assert not urls.decide(captures, urls.derived_entries(pages).limit(0)).first()["blocked"]
    assert urls.report(pages.limit(0)).collect() == []
