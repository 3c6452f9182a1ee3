"""Quality rules: signals by a literal reading, exact binomial tails, certificates, awkward rows."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from llm_data import awkward, documents, prose
from pyspark.sql import functions as F

from churnwise.llm import quality


def literal(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    places = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places)


def texts(rng, n=60):
    out = awkward(rng) + ["a a a a a", "a b a b a b c", "x\ny\nx\n \n \nx", "|||### é<>", "one two three\x0bone two three", "\n\n", "\U0001f600 \U0001f600"]
    for _ in range(n):
        words = [rng.choice("abcd") for _ in range(rng.randrange(1, 90))]
        out.append("".join(w + rng.choice([" ", "\n", "\t", "  ", "\r\n"]) for w in words))
    return out


def test_signals(spark):
    rng = random.Random(8)
    all_texts = texts(rng)
    docs = documents(spark, all_texts, clashing=True)
    for c in ("stratum", "w", "lines", "places", "windows", "first", "certified", "at", "of"):
        docs = docs.withColumn(c, F.lit(1))
    got = {r["doc_id"]: r for r in quality.report(docs, labels(spark, [])).collect()}
    assert len(got) == len(all_texts)
    for k, t in enumerate(all_texts):
        n, chars, symbols, lines, repeated = want = literal(t)
        assert tuple(got[k])[1:6] == want, repr(t)[:80]
        assert got[k]["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and got[k]["kept"] == (not got[k]["base_failed"])


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0) for i, q in rows], "doc_id long, quality int, toxic int")


def tail(n, k, rate):
    r = Fraction(rate)
    return float(sum(comb(n, i) * r**i * (1 - r) ** (n - i) for i in range(k + 1)))


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, rate) for rate in (0.01, 0.05, 0.3) for n in (1, 7, 15, 16, 40, 300, 1500) for k in (0, 1, 2, 5, 14, 60) if k < n * rate]
    df = spark.createDataFrame([(n, k, rate) for n, k, rate in cases], "n long, k long, rate double")
    for rate in (0.01, 0.05, 0.3):
        for r in df.where(F.col("rate") == rate).select("n", "k", quality.binomial_tail(F.col("n"), F.col("k"), rate).alias("p")).collect():
            assert r["p"] == pytest.approx(tail(r["n"], r["k"], rate), rel=1e-9)


def test_binomial_tail_of_many_trials(spark):
    df = spark.range(1).select(*[quality.binomial_tail(F.lit(10**7), F.lit(k), 0.01).alias(f"k{k}") for k in (99_000, 99_900, 100_000)])
    row = df.first()  # z = -3.18 and -0.318
    assert row["k99000"] == pytest.approx(0.000736, rel=0.05) and row["k99900"] == pytest.approx(0.3765, rel=0.01) and row["k100000"] == 1.0


RULES = (quality.Rule("symbols", "n_symbols / greatest(n_words, 1)", (2.0, 0.5, 0.1)), quality.Rule("long", "word_chars / greatest(n_words, 1)", (30.0, 9.0)))


def corpus(spark, rng, bad_share):
    """Stratum a: many good documents, of which `bad_share` hold symbols; b: few; null: none labelled."""
    rows, marks = [], []
    for i in range(700):
        lang = "a" if i < 500 else "b" if i < 600 else None
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        odd = i % 500 < bad_share * 500 if lang == "a" else i % 3 == 0
        rows.append((i, " ".join(w + "##" if odd else w for w in words), lang))
        if lang:
            marks.append((i, 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels(spark, marks)


@pytest.mark.parametrize("bad,certified", [(0.0, 3), (0.004, 3), (0.2, 1)])
def test_certified_cutoffs(spark, bad, certified):
    docs, marks = corpus(spark, random.Random(4), bad)
    judged, found = quality.judge(docs, marks, rules=RULES, alpha=0.08, delta=0.1)
    by = {(r["stratum"], r["rule"]): r for r in found.collect()}
    assert set(by) == {("a", 0), ("a", 1), ("b", 0), ("b", 1)}
    own = by["a", 0]
    hits = round(bad * 500)
    assert own["n"] == 500 and list(own["rejected"]) == [0, hits, hits]
    assert list(own["p_values"]) == pytest.approx([1.0 if k >= 20 else tail(500, k, 0.04) for k in own["rejected"]], rel=1e-6)
    want = 0
    while want < 3 and own["p_values"][want] <= 0.1 / 4:
        want += 1
    assert own["certified"] == want == certified
    assert by["b", 0]["certified"] == 1  # a third of b's good documents would go at the second cutoff
    rows = judged.collect()
    assert [r["kept"] for r in rows if r["stratum"] is None] == [True] * 100
    assert sum(not r["kept"] for r in rows if r["stratum"] == "a") == (hits if certified > 1 else 0)


def test_copies_are_one_trial_and_conflicting_labels_are_not_good(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(i, text if i < 50 else text + f" {i}", "a") for i in range(60)] + [(59, text + " again", "a")], "doc_id long, text string, lang string")
    marks = labels(spark, [(i, 1) for i in range(60)] + [(58, 0), (57, None), (57, 1), (None, 1), (999, 1)])
    _, found = quality.judge(docs, marks, rules=RULES)
    assert {r["n"] for r in found.collect()} == {11}  # one of the copies, 50..57, 59 and the other row of 59


def test_empty_tables(spark):
    assert quality.report(documents(spark, []), labels(spark, [])).collect() == []


def test_plan_is_native(spark):
    rng = random.Random(1)
    docs = documents(spark, [prose(rng, 80)] * 3)
    plan = quality.report(docs, labels(spark, [(0, 1)]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
