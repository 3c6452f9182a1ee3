"""Mixing sources to target weights under an exact word budget.

Every document gets a hash-random key. Within its source the documents are ordered by that key, split into
ranges of the key (so a source that holds a third of all rows becomes many ranges), and prefix sums of their
sizes are built in two levels: a sum per range, running sums over ranges, running sums inside a range. The
cut falls at the source's exact budget: with budget B and source size S, each document is taken B div S times,
and the documents that begin before B mod S are taken once more, the one at the cut up to the cut. The order
is total (key, doc_id, size), so reruns and retried tasks agree.

Documents with one doc_id (or none) and one size are equal in that order: they are counted before the shuffle
and placed as one entry, so an id that a third of all rows share is no more than a row for each of its sizes. An
entry lies wholly before the cut or wholly after it, but for the one entry of a source that the cut falls in.
Only there do its documents differ; they are then ordered by a digest of the whole row, with a second pair of
prefix sums, and equal rows are again counted and dealt out.

Budgets: the mix holds `share` of all words. Sources share it by weight; none may exceed `most` times its own
size, and what it cannot take is shared again by weight among the others (water filling, solved in closed form
on the per-source table: sorted by size over weight, the capped sources come first).

Defined results: null text and text without words have size 0 and are taken 0 times; a null source is a source
of its own, last in order; a null doc_id is an id like any other; repeated rows are each a document; an empty
table gives an empty result. The per-source table (one row a source) and one row a key range of a source are
the only things ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwise.llm.common import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Rows aimed at in one key range of one source; the number of ranges grows with the table.
RANGE_ROWS = 1_000
#: Equal documents dealt out by one row; more become a row for each so many, spread over the tasks.
DEALT = 1_000
#: Hexadecimal digits of the digest that split the entry at a cut.
_SPLIT = 3
_WORD = r"[^\x20\x09-\x0D]+"


def _key(doc_id: Column) -> Column:
    """A uniform 60-bit number: the first 15 hex digits of an md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key): the number of words and the hash-random key of each document."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(_WORD)).cast("long"), F.lit(0).cast("long")).alias("size"), _key(F.col("doc_id")).alias("key"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) by water filling; one row a source. `sized` holds n documents a row."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("at", F.row_number().over(order)).withColumn("weight", weight)
    everything = Window.partitionBy()
    fill = Window.orderBy((F.col("source_size") / F.col("weight")), "at")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # the level if this source and all after it are not capped; the first source that fits under it sets the level
    per = per.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.lit(float(most)) * F.col("source_size"))
    per = per.withColumn("final", F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    cap = F.lit(float(most)) * F.col("source_size")
    return per.select("source", "source_size", F.coalesce(F.least(cap, F.col("final") * F.col("weight")), cap).cast("double").alias("target"))


def entries(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, source, size, key, n, source_size, target, start, base, full, part): an entry stands for n documents
    of one id, source and size. Each is taken `base` words; the first `full` of them `size` more, the next `part` more."""
    sized = cut(sizes(docs).groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    rows = sized.count()
    ranges = 1
    while ranges * range_rows < rows:
        ranges *= 2
    # ranges of equal width of a uniform 60-bit key hold about equally many entries of each source
    width = ranges.bit_length() - 1
    words = F.col("size") * F.col("n")
    same = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))  # a null source joins too
    sized = sized.withColumn("range", F.shiftright("key", 60 - width).cast("int")).withColumn("words", words).withColumn("of", same)
    goal = targets(sized, weights, share, most).select(same.alias("of"), "source_size", "target")
    per_range = sized.groupBy("of", "range").agg(F.sum("words").alias("sum"))
    offsets = per_range.select("of", "range", _before("sum", ["of"], ["range"]).alias("offset")).join(goal, "of")
    placed = sized.withColumn("inside", _before("words", ["of", "range"], ["key", "doc_id", "size"]))
    placed = placed.join(offsets, ["of", "range"]).withColumn("start", F.col("offset") + F.col("inside"))
    budget = F.floor("target")
    total = F.greatest(F.col("source_size"), F.lit(1))
    more = F.least(F.greatest(budget % total - F.col("start"), F.lit(0)), F.col("words"))
    size = F.greatest(F.col("size"), F.lit(1))
    kept = ["doc_id", "source", "size", "key", "n", "source_size", "target", "start"]
    return placed.select(*kept, (F.floor(budget / total) * F.col("size")).alias("base"), F.floor(more / size).alias("full"), (more % size).alias("part"))


def _before(value: str, of: list[str], order: list[str]) -> Column:
    """The sum of `value` over the rows before, within `of`."""
    running = Window.partitionBy(*of).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(running), F.lit(0).cast("long"))


def _deal(df: DataFrame, n: str, nth: str) -> DataFrame:
    """Each row `n` times, numbered from 0 in `nth`. Rows dealt out many times are spread over the tasks first."""
    few, many = df.where(F.col(n) <= DEALT), df.where(F.col(n) > DEALT)
    block = F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / DEALT))
    many = many.withColumn("_block", F.explode(block)).withColumn("_spread", F.xxhash64("_block")).repartition("_spread").drop("_spread")
    every = few.where(F.col(n) > 0).withColumn("_block", F.lit(0).cast("long")).unionByName(many)
    first = F.col("_block") * DEALT
    return every.withColumn(nth, F.explode(F.sequence(first, F.least(first + DEALT, F.col(n)) - 1))).drop("_block")


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, source, key, size, source_size, target, start, taken): what the mix takes of each document."""
    dealt = _deal(cut(entries(docs, weights, share, most, range_rows), "mix-entries"), "n", "nth")
    nth, full = F.col("nth"), F.col("full")
    extra = F.when(nth < full, F.col("size")).when(nth == full, F.col("part")).otherwise(0)
    return dealt.select("doc_id", "source", "key", "size", "source_size", "target", (F.col("start") + nth * F.col("size")).alias("start"), (F.col("base") + extra).cast("long").alias("taken"))


def report(docs: DataFrame) -> DataFrame:
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def _of_cut_entries(rows: DataFrame) -> DataFrame:
    """(row, size, taken) of the entries that a cut falls in: `rows` are their documents (row, id, of, size, base,
    full, part). Equal rows are counted; the others follow one another by a digest of all columns."""
    key = ["id", "of", "size", "base", "full", "part"]
    same = rows.withColumn("digest", F.md5(F.to_json("row"))).groupBy(*key, "digest").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("count"))
    same = cut(same.withColumn("split", F.substring("digest", 1, _SPLIT)), "mix-cut")
    at = ["id", "of", "size"]
    sums = same.groupBy(*at, "split").agg(F.sum("count").alias("sum"))
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in (*at, "split")], _before("sum", at, ["split"]).alias("offset"))
    on = F.lit(True)
    for c in (*at, "split"):
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    before = F.col("offset") + F.col("inside")
    same = same.withColumn("inside", _before("count", [*at, "split"], ["digest"])).join(sums, on)
    whole = F.least(F.greatest(F.col("full") - before, F.lit(0)), F.col("count"))
    one = ((before <= F.col("full")) & (F.col("full") < before + F.col("count"))).cast("long")
    outcome = lambda words, times: F.struct(words.cast("long").alias("taken"), times.cast("long").alias("times"))
    base = F.col("base")
    outcomes = F.array(outcome(base + F.col("size"), whole), outcome(base + F.col("part"), one), outcome(base, F.col("count") - whole - one))
    same = same.select("row", "size", F.explode(outcomes).alias("o")).select("row", "size", "o.taken", "o.times")
    return _deal(same.where("taken > 0"), "times", "nth").select("row", "size", "taken")


def materialize(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mixed corpus: the rows of `docs`, once for each epoch that takes them, with `epoch` (from 1) and
    `words_taken` added last under those names, or with underscores before them where a column has the name.
    The document at a source's cut keeps the words before the cut; all other texts are whole."""
    text_size = F.coalesce(F.regexp_count("text", F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").cast("string").alias("of"), text_size.alias("size"))
    chosen = cut(entries(docs, weights, share, most), "mix-entries").withColumnsRenamed({"doc_id": "_id", "source": "_of", "size": "_size"})
    whole, none = F.col("full") == F.col("n"), (F.col("full") == 0) & (F.col("part") == 0)
    alike = whole | none | (F.col("n") == 1)
    each = F.col("base") + F.when(whole, F.col("_size")).otherwise(F.col("part"))
    chosen = chosen.withColumn("each", each.cast("long"))
    on = marked.id.eqNullSafe(F.col("_id")) & marked.of.eqNullSafe(F.col("_of")) & (marked["size"] == F.col("_size"))
    both = marked.join(chosen.where(alike & (F.col("each") > 0)).select("_id", "_of", "_size", "each"), on)
    both = both.select("row", "size", F.col("each").alias("taken"))
    at_cut = chosen.where(~alike)
    if not at_cut.isEmpty():
        rows = marked.join(at_cut.select("_id", "_of", "_size", "base", "full", "part"), on)
        both = both.unionByName(_of_cut_entries(rows.select("row", "id", "of", "size", "base", "full", "part")))
    both = both.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    words_taken = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    both = both.withColumn("words_taken", words_taken)
    first_words = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("words_taken").cast("int")), "")
    text = F.when(F.col("words_taken") < F.col("size"), first_words).otherwise(F.col("row.text"))
    names = docs.columns

    def fresh(name: str) -> str:
        while name in names:
            name = "_" + name
        return name

    return both.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names], F.col("epoch").alias(fresh("epoch")), F.col("words_taken").alias(fresh("words_taken")))
