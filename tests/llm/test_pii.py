"""Personal data: plain spans against the plain patterns, disguises against their sources."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from llm_data import awkward, documents

from churnwise.llm import pii


def plain(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(*m.span(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(*m.span(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(*m.span(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(*m.span(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


DISGUISED = [
    ("write to john.doe [at] example [dot] com now", "john.doe [at] example [dot] com", "email"),
    ("mail jane at example dot com please", "jane at example dot com", "email"),
    ("jane (at) mail.example.com", "jane (at) mail.example.com", "email"),
    ("user @ example.com", "user @ example.com", "email"),
    ("mail jоhn@exаmple.com", "jоhn@exаmple.com", "email"),
    ("john@​example.com", "john@​example.com", "email"),
    ("call plus one five five five one two three four five six seven now", "plus one five five five one two three four five six seven", "phone"),
    ("card four one one one one one one one one one one one one one one one ok", "four" + " one" * 15, "card"),
    ("４１１１１１１１１１１１１１１１", "４１１１１１１１１１１１１１１１", "card"),
    ("ip one nine two dot one six eight dot one dot one end", "one nine two dot one six eight dot one dot one", "ip"),
    ("192。168。1。1", "192。168。1。1", "ip"),
    ("+1 (446) 555‑8962", "+1 (446) 555‑8962", "phone"),
    # disguises of disguises
    ("to john [аt] example [dot] com", "john [аt] example [dot] com", "email"),
    ("to john [at] example [dоt] com", "john [at] example [dоt] com", "email"),
    ("to jane at exаmple dot com", "jane at exаmple dot com", "email"),
    ("to john@example dot com", "john@example dot com", "email"),
    ("to john at example.com", "john at example.com", "email"),
    ("to john @ example dot com", "john @ example dot com", "email"),
    ("to jo​hn (at) exаmple dot com", "jo​hn (at) exаmple dot com", "email"),
    ("call plus one ５ five five five one two three four five six", "plus one ５ five five five one two three four five six", "phone"),
    ("ip one-nine-two dot one six eight dot one dot one end", "one-nine-two dot one six eight dot one dot one", "ip"),
    ("ip one nine two [dot] one six eight [dot] one [dot] one end", "one nine two [dot] one six eight [dot] one [dot] one", "ip"),
    ("ip 192 [dоt] 168 [.] one [dot] 1 end", "192 [dоt] 168 [.] one [dot] 1", "ip"),
    ("card ４１１１ one one one one one one one one one one one one", "４１１１ one one one one one one one one one one one one", "card"),
    ("card four 1 one １ one one one one one one one one one one one one", "four 1 one １ one one one one one one one one one one one one", "card"),
]


@pytest.mark.parametrize("text,source,kind", DISGUISED)
def test_disguises_map_back(text, source, kind):
    for before in ("", "été 日本 – "):
        base, every = pii.all_spans(before + text)
        assert not base and [((before + text)[a:b], pii.KINDS[k]) for a, b, k in every] == [(source, kind)]


@pytest.mark.parametrize("text", ["a at b. Of the", "look at one, two and three of them", "one two three four five six seven", "at dot", "(at) [dot]", "un deux trois quatre", "Привет, мир", "nine one one", "One. Two. Three. Four. Five", "we arrived at noon.Then he left", "one-two-three", "look at figure.two", "Seite 4 at point.Then"])
def test_prose_is_left_alone(text):
    assert pii.all_spans(text) == ([], [])


def test_plain_spans_equal_the_patterns():
    rng = random.Random(6)
    for _ in range(30_000):
        t = "".join(rng.choice("aZ0123456789.@+- ()é%") for _ in range(rng.randint(0, 60)))
        base, every = pii.all_spans(t)
        assert base == plain(t) == pii.find(t) and set(base) <= set(every)


def test_column_search_skips_nothing():
    rng = random.Random(7)
    texts = [d[0] for d in DISGUISED] + ["".join(rng.choice("aZ0123456789.@+- [](){}dotat\n") for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    assert [x for x in pii.spans_of(pa.array(texts))] == [pii.all_spans(t) for t in texts]


@pytest.mark.parametrize("text", ["one dot two dot three dot four", "plus one 4 four 6 five 5 five 8 nine 6 two", "ONE-9-2 dot One 6 8 dot one dot oh", "é one1 dot zwei dot 3 dot vier", "ſix dot fİve dot fıve dot one"])
def test_column_search_finds_mixed_spelling(text):
    assert list(pii.spans_of(pa.array([text]))) == [pii.all_spans(text)]


def test_column_search_skips_no_spelled_run():
    rng = random.Random(9)
    parts = ["one", "Two", "three", "fünf", "nueve", "un", "oh", "plus ", "4", "16", "255", "-", ",", " ", " ", " ", " dot ", " Punkt ", " dash ", " at ", "x", "\n", "é"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(4, 24))) for _ in range(20_000)]
    texts += [" ".join(rng.choice(["one", "two", "7", "3", "dot", "dot", "nine"]) for _ in range(rng.randint(7, 14))) for _ in range(20_000)]
    want = [pii.all_spans(t) for t in texts]
    assert sum(a != b for a, b in want) > 50 and list(pii.spans_of(pa.array(texts))) == want


def test_every_two_disguises_compose():
    """Each way to hide the at, each way to hide the dot, and each way to hide a letter, in every combination."""
    for at in (" [at] ", " (аt) ", "@", " @ ", " at ", " [@] "):
        for dot in (" [dot] ", " [dоt] ", ".", " dot ", " {.} ", "。"):
            for letter in ("a", "а", "ａ", "\u200ba"):
                source = f"j{letter}ne{at}ex{letter}mple{dot}com"
                base, every = pii.all_spans(f"mail {source} now")
                if not base:
                    assert every == [(5, 5 + len(source), 0)], source
                assert list(pii.spans_of(pa.array([f"mail {source} now"]))) == [(base, every)]
                assert "mple" not in pii.masked(f"mail {source} now", every)


def test_column_search_skips_no_composed_disguise():
    rng = random.Random(11)
    parts = ["john", "a", "а", "ex", "com", " at ", " [at] ", "(аt)", "@", " @ ", " dot ", "[dоt]", ".", "。", "one", "two ", "５", "7", " ", "\u200b", "-", "org", "plus "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(3, 14))) for _ in range(20_000)]
    want = [pii.all_spans(t) for t in texts]
    assert sum(a != b for a, b in want) > 200 and list(pii.spans_of(pa.array(texts))) == want
    for t, (base, every) in zip(texts, want):
        assert set(base) <= set(every) and all(a < b for a, b, _ in every)


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, " " * 300_000 + "(at)", "@" * 300_000, "+1" * 150_000, "one " * 60_000, "a@" * 150_000, "+1" + " " * 300_000):
        pii.all_spans(t)


def test_report_and_mask(spark):
    texts = awkward(random.Random(8)) + [d[0] for d in DISGUISED] + ["x a.b@c.de, 10.0.0.1, +1 (446) 555-8962, 4111 1111 1111 1111"] * 2
    docs = documents(spark, texts, clashing=True)
    for r in pii.report(docs).collect():
        t = texts[r["doc_id"]] or ""
        base, every = pii.all_spans(t)
        assert base == plain(t) and [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == n for s in base) for n in range(4)]
        assert r["base_sha256"] == hashlib.sha256(pii.listed(base).encode()).hexdigest() and r["spans"] == pii.listed(every)
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    rows = {r["doc_id"]: r for r in masked.collect()}
    assert rows[len(texts) - 1]["text"] == "x <email>, <ip>, <phone>, <card>"
    assert rows[0]["text"] is None and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows.values())
    assert pii.report(docs.limit(0)).collect() == [] and pii.mask(docs.limit(0)).collect() == []
