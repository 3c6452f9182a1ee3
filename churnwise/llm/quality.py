"""Quality rules with risk-controlled cutoffs, in DataFrame functions alone.

A rule rejects a document whose value lies above a cutoff. Every rule has a fixed grid of cutoffs, from lenient to
strict, set before any label is seen. Labelled documents of quality 1 are the holdout: for each stratum (the
language, by default) and rule the strictest cutoff is selected that provably rejects few of them.

1. Trials are the distinct texts of a stratum that pass the base and are labelled good (copies of a text say
   nothing new, so they count once). k of n trials rejected at a cutoff is held against the exact binomial law:
   P(Bin(n, alpha) <= k) is the p-value of "the cutoff rejects more than alpha of the good documents".
2. Within a rule the cutoffs are tested in sequence, lenient first, and testing stops at the first that fails;
   as each test happens only if all before it passed, the sequence needs no correction. Over rules and strata
   the level is divided by their number (Bonferroni). So with probability 1 - DELTA at least, in no stratum any
   rule rejects more than its alpha, and the rules together no more than ALPHA, of the good documents.
3. A stratum without enough good documents certifies nothing, and its rule rejects nothing there.

A binomial tail is summed from its largest term down; log factorials are Stirling's series (exact to 1e-13).
Signals are computed once, in the row, without exploding words. Holdout counts are sums with partial aggregation;
the table of cutoffs has a row for each stratum, and Spark broadcasts it if its measured size allows.

Defined results: null text has no words, and the base rejects it; a null stratum is one of its own; a document is
good if all its labels with a quality say 1; labels without doc_id or document count for nothing; every row of a
repeated doc_id is judged by its own text; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwise.llm.common import cut

#: Bound on the share of good documents that all rules together reject in a stratum, and the chance that it fails.
ALPHA, DELTA = 0.05, 0.05
#: The base: fewer words, or a larger percentage of words in repeated windows, fails.
LEAST_WORDS, MOST_REPEATED = 50, 50
_WORD = r"[^\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Rejects a row whose `value` is greater than the cutoff; cutoffs descend, from lenient to strict."""

    name: str
    value: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", (0.9, 0.7, 0.5, 0.4, 0.3)),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", (0.45, 0.4, 0.35, 0.3, 0.25)),
    Rule("long_words", "word_chars / greatest(n_words, 1)", (12.0, 10.0, 9.0, 8.0, 7.0, 6.5)),
    Rule("short_words", "-(word_chars / greatest(n_words, 1))", (-2.5, -3.0, -3.5, -4.0)),
)


# --- signals ---------------------------------------------------------------------------------------------


def with_signals(docs: DataFrame) -> DataFrame:
    """`docs` (with columns doc_id, stratum, text) with the signals in place of the text, and `fingerprint`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = F.size("w")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(
        "doc_id",
        "stratum",
        F.xxhash64(text).alias("fingerprint"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("w"),
    )
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "second": F.slice("w", 2, F.greatest(n - 1, F.lit(0))),
            "third": F.slice("w", 3, F.greatest(n - 2, F.lit(0))),
            "at": F.sequence(F.lit(0), n),
        }
    )
    # the 3-word windows, sorted, with their places: equal ones are neighbours
    windows = F.sort_array(F.slice(F.arrays_zip("w", "second", "third", "at"), 1, F.greatest(n - 2, F.lit(0))))
    out = out.withColumn("windows", windows).drop("lines", "second", "third", "at", "w")
    m = F.greatest(F.size("windows") - 1, F.lit(0))
    twice = F.zip_with(
        F.slice("windows", 1, m),
        F.slice("windows", 2, m),
        lambda a, b: F.when((a["w"] == b["w"]) & (a["second"] == b["second"]) & (a["third"] == b["third"]), F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")),
    )
    out = out.withColumn("places", F.sort_array(F.array_distinct(F.flatten(twice)))).drop("windows")
    k = F.greatest(F.size("places") - 1, F.lit(0))
    steps = F.zip_with(F.slice("places", 1, k), F.slice("places", 2, k), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.when(F.size("places") > 0, F.aggregate(steps, F.lit(3), lambda x, y: x + y)).otherwise(0)
    out = out.withColumn("n_repeat_words", covered.cast("long")).drop("places")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _first_cutoff(rule: Rule) -> Column:
    """The number (from 1) of the first cutoff that rejects the row; one more than there are if none does."""
    value = F.expr(rule.value)
    out = F.lit(len(rule.cutoffs) + 1)
    for k in range(len(rule.cutoffs), 0, -1):
        out = F.when(value > rule.cutoffs[k - 1], k).otherwise(out)
    return F.when(F.col("base_failed"), 0).otherwise(out)


# --- exact binomial bounds -------------------------------------------------------------------------------

_FACTORIALS = [math.lgamma(x + 1.0) for x in range(16)]


def _log_factorial(x: Column) -> Column:
    small = F.element_at(F.array(*[F.lit(v) for v in _FACTORIALS]), (F.least(x, F.lit(15.0)) + 1).cast("int"))
    y = F.greatest(x, F.lit(16.0))
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    return F.when(x < 16, small).otherwise(y * F.log(y) - y + 0.5 * F.log(2 * math.pi * y) + series)


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= k) for k below n * rate, and 1 from there on (where nothing is ever certified).

    The terms fall from k down, by at least a Gaussian's rate; those beyond 12 deviations are under 1e-30."""
    n, k = n.cast("double"), k.cast("double")
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(rate) + (n - k) * math.log1p(-rate)
    count = F.least(k, F.ceil(12 * F.sqrt(n * (rate * (1 - rate)))) + 100).cast("int")

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i) / (n - k + i + 1) * ((1 - rate) / rate)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    first = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))
    terms = F.aggregate(F.sequence(F.lit(0), count), first, step, lambda acc: acc["sum"])
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.exp(top + F.log(terms)))


def certificates(holdout: DataFrame, rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, n, rejected, p_values, certified) from trials (stratum, first): for each trial the first
    rejecting cutoff of each rule. `certified` counts the cutoffs of the rule that may be used; `rejected` and
    `p_values` have an entry for each cutoff."""
    most = max(len(r.cutoffs) for r in rules)
    each = holdout.select("stratum", F.posexplode("first").alias("rule", "first"))
    counts = each.groupBy("stratum", "rule").agg(F.count("*").alias("n"), *[F.count(F.when(F.col("first") <= k, 1)).alias(f"k{k}") for k in range(1, most + 1)])
    counts = cut(counts, "quality-counts")  # a row for each stratum and rule
    tests = counts.count()
    sizes = F.element_at(F.array(*[F.lit(len(r.cutoffs)) for r in rules]), F.col("rule") + 1)
    level = delta / max(tests, 1)
    found = counts.select("stratum", "rule", "n", F.slice(F.array(*[F.col(f"k{k}") for k in range(1, most + 1)]), F.lit(1), sizes).alias("rejected"))
    found = found.withColumn("p_values", F.transform("rejected", lambda k: binomial_tail(F.col("n"), k, alpha / len(rules))))
    # in sequence: all before the first that fails
    passed = F.aggregate("p_values", F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, p: F.struct((a["n"] + F.when(a["on"] & (p <= level), 1).otherwise(0)).alias("n"), (a["on"] & (p <= level)).alias("on")), lambda a: a["n"])
    return found.withColumn("certified", passed)


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents whose labels all say quality 1."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("least")).where(F.col("doc_id").isNotNull() & (F.col("least") == 1)).select("doc_id")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> tuple[DataFrame, DataFrame]:
    """Per row of `docs` its signals, `base_failed`, `first` (first rejecting cutoff of each rule) and `kept`; and
    the certificates."""
    rows = with_signals(docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text"))
    rows = cut(rows.withColumn("first", F.array(*[_first_cutoff(r) for r in rules])), "quality-signals")
    trials = rows.where(~F.col("base_failed")).select("doc_id", "stratum", "fingerprint", "first").distinct()
    trials = trials.join(good_ids(labels), "doc_id").select("stratum", "fingerprint", "first").distinct()
    found = certificates(trials, rules, alpha, delta)
    # one row a stratum, its certified cutoffs by rule; written, so that its size is known when it is joined
    limits = found.groupBy(F.col("stratum").alias("of")).agg(*[F.max(F.when(F.col("rule") == k, F.col("certified"))).alias(f"c{k}") for k in range(len(rules))])
    limits = cut(limits.select("of", F.array(*[F.coalesce(f"c{k}", F.lit(0)) for k in range(len(rules))]).alias("certified")), "quality-cutoffs")
    judged = rows.join(limits, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")
    rejected = F.exists(F.zip_with("first", F.coalesce("certified", F.array_repeat(F.lit(0), len(rules))), lambda a, b: a <= b), lambda x: x)
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected), found


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    judged, _ = judge(docs, labels)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
