"""Conversation prefix trie against dictionaries of prefixes."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from churnwise.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{len(text.encode())}:{text}".encode()).hexdigest()


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    convs = {c: [t for _, t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        built[c] = convs.get(donor, [])[:h] + own[h:]
    members, ends = {}, {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    children, out = {}, []
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        kids = children.get(key, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves[key] = sum(leaves[k] for k in kids) if kids else 1
        saved[key] = (len(members[key]) - 1) * words + sum(saved[k] for k in kids)
        listed = ",".join(map(str, sorted(ends.get(key, []))))
        out.append((min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(kids), leaves[key], saved[key], hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_of(rng, n=130):
    """Few distinct turns, so that paths branch everywhere; a hot conversation; long ones; awkward rows."""
    rows = []
    for c in range(-25, n):
        if c % 7 == 3:
            path = ["hot"] * 3
        elif c % 31 == 5:
            path = [rng.choice("ab") if k % 11 == 10 else "same" for k in range(rng.randrange(10, 70))]
        else:
            path = [rng.choice(["a", "b b", "c\tc c"]) for _ in range(rng.randrange(0, 9))]
        rows += [(c, k, rng.choice(["user", "user", "bot"]) if k == 1 else "user", t) for k, t in enumerate(path)]
    rows += [(1, None, None, None), (1, None, "user", ""), (2, 0, "user", "tie"), (2, 0, "user", "another tie"), (2, 0, "user", "tie")]
    rows += [(None, 0, "user", "lost"), (400, 0, "user", "one only"), (10**12, 3, None, "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("span", [4, 256])
def test_against_dictionaries(spark, span):
    rows = rows_of(random.Random(span))
    convs = table(spark, rows)
    for c in ("at", "r", "n", "digest", "words", "depth", "x1", "h1", "lo", "id"):
        convs = convs.withColumn(c, F.lit(1))
    assert got(trie.report(convs, span)) == brute(rows)


def test_only_turnless_and_none(spark):
    # 1 borrows from conversation 0, which is not there, and loses its only turn: crc32("1") % 4 is 3
    rows = [(1, 0, "user", "gone")]
    assert brute(rows)[0][:6] == (1, 0, None, 1, 0, 1)
    assert got(trie.report(table(spark, rows))) == brute(rows)
    assert got(trie.report(table(spark, [(None, 0, "user", "x")]))) == []


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)] + [(0, 256), (255, 256), (3, 200)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for r in df.select("a", "b", trie.fattest(F.col("a"), F.col("b")).alias("f")).collect():
        best = max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x)
        assert r["f"] == best
