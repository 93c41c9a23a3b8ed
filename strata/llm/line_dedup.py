"""Removal of later copies of repeated line runs, from a suffix array over line ids.

1. Every line with a word gets an id (128 bits of hash, so 10**12 lines stay apart).  Lines that
   stand once cannot be part of a repeated run and go at once.
2. Prefix doubling: the rank of the first ``2**k`` lines from a position, joined with the rank
   ``2**k`` lines on, gives a pair; the pairs, sorted, give the ranks for ``2**(k + 1)`` lines.  Pairs
   that stand once go.  The ranks of all levels are the suffix array, as far as suffixes share lines.
3. Suffixes with a common prefix of ``m`` lines are one interval of the suffix array.  Of interest
   are the shortest prefixes with ``min_words`` words from each position, and the shortest such
   stretches up to each position: every repeated run of at least ``min_words`` words is a union of
   them.  Two overlapping ranks name the ``m`` lines exactly.  In each interval all but the earliest
   position are later copies; what overlaps merges to maximal runs, which are deleted.

A line has a word at least, so no stretch is longer than ``min_words`` lines and the doubling ends
after ``log2(min_words)`` levels, whatever the texts.  Everything is a DataFrame operation; a line or
run that a third of all documents share only makes long equi-joins, which are split when skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.store import stored

#: Shortest repeated run that is deleted, in words.
MIN_WORDS = 50

_WORD = r"[^\x20\x09-\x0D]+"
_DOC = ["k1", "k2"]


def _keys(doc_id: Column, text: Column) -> list[Column]:
    """Rows of equal id and text are one document."""
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.lit(7), text, doc_id).alias("k2")]


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each line with a word: its number ``i`` among these, the lines [from, to) of the
    text that it stands for (blank lines go with the line before them), its words and its id."""
    rows = docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{text}`"].alias("text"))
    rows = rows.where("text IS NOT NULL").withColumn("lines", _split(F.col("text")))
    numbered = F.transform("lines", lambda x, p: F.when(x.rlike(_WORD), p))
    rows = rows.select("id", *_keys(F.col("id"), F.col("text")), "lines", F.array_compact(numbered).alias("full"))
    made = F.transform("full", lambda p, i: F.struct(
        i.cast("int").alias("i"), p.alias("from"),
        F.coalesce(F.get("full", i + 1), F.size("lines")).alias("to"),
        F.regexp_count(F.get("lines", p), F.lit(_WORD)).alias("words"),
        F.xxhash64(F.get("lines", p)).alias("a"), F.xxhash64(F.lit(7), F.get("lines", p)).alias("b")))
    return rows.select("id", *_DOC, F.inline(made))


def _ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` whose ``by`` stand twice or more, with ``r``, a rank in the order of ``by``."""
    places = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    places = stored(places.orderBy(*by).withColumn("r", F.monotonically_increasing_id()), f"{name}-names")
    return rows.join(places, by)


def _stretches(active: DataFrame, min_words: int) -> DataFrame:
    """(document, i, m): shortest stretches of neighbouring active lines with ``min_words`` words,
    from each line on and up to each line."""
    by_line = Window.partitionBy(*_DOC).orderBy("i")
    rows = active.withColumn("island", F.col("i") - F.row_number().over(by_line))
    in_island = Window.partitionBy(*_DOC, "island").orderBy("i")
    # a line's words beyond the threshold change no stretch
    rows = rows.withColumn("words", F.least("words", F.lit(min_words)).cast("long"))
    rows = rows.withColumn("till", F.sum("words").over(in_island)).withColumn("before", F.col("till") - F.col("words"))
    rows = rows.withColumn("ahead", F.collect_list("till").over(in_island.rowsBetween(0, min_words - 1)))
    rows = rows.withColumn("behind", F.collect_list("before").over(in_island.rowsBetween(1 - min_words, 0)))
    on = 1 + F.size(F.filter("ahead", lambda x: x < F.col("before") + min_words))
    back = 1 + F.size(F.filter("behind", lambda x: x > F.col("till") - min_words))
    both = F.array(F.struct(F.col("i"), F.when(on <= F.size("ahead"), on).alias("m")),
                   F.struct((F.col("i") - back + 1).alias("i"), F.when(back <= F.size("behind"), back).alias("m")))
    return rows.select("id", *_DOC, F.inline(both)).where("m IS NOT NULL").distinct()


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k1, k2, runs): maximal runs that are later copies, as [from, to) line numbers of the text.

    The order of copies is that of ``doc_id`` (null last), then of a hash of the text, then of lines.
    """
    lines = stored(_lines(docs, doc_id, text), "lines")
    active = _ranked(lines, ["a", "b"], "line").select("id", *_DOC, "i", "from", "to", "words", "r").dropDuplicates([*_DOC, "i"])
    active = stored(active, "repeated-lines")
    windows = stored(_stretches(active, min_words), "stretches")
    longest = windows.agg(F.max("m")).first()[0] or 0

    ranks = levels = active.select(*_DOC, "i", "r")
    levels = levels.withColumn("level", F.lit(0))
    size = 1
    while 2 * size <= longest:
        later = ranks.select(*_DOC, (F.col("i") - size).alias("i"), F.col("r").alias("r2"))
        pairs = ranks.withColumnRenamed("r", "r1").join(later, [*_DOC, "i"])
        ranks = stored(_ranked(pairs, ["r1", "r2"], "suffix").select(*_DOC, "i", "r"), "suffix-ranks")
        size *= 2
        levels = levels.unionByName(ranks.withColumn("level", F.lit(size.bit_length() - 1)))

    level = F.floor(F.log2("m")).cast("int")
    named = windows.withColumn("level", level).withColumn("j", F.expr("i + m - shiftleft(1, level)").cast("int"))
    named = named.join(levels.withColumnRenamed("r", "r1"), [*_DOC, "level", "i"])
    named = named.join(levels.select(*_DOC, "level", F.col("i").alias("j"), F.col("r").alias("r2")), [*_DOC, "level", "j"])
    place = F.struct(F.col("id").isNull().alias("null"), "id", *_DOC, "i")
    named = stored(named.select(*_DOC, "i", "m", "r1", "r2", place.alias("place")), "intervals")
    first = named.groupBy("m", "r1", "r2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = stored(first, "first-copies")  # a join of two tables can be split at a hot interval, one with an aggregate can't
    later = named.join(first, ["m", "r1", "r2"]).where("place > first")
    gone = later.select(*_DOC, F.explode(F.sequence("i", F.expr("i + m - 1"))).alias("i")).distinct()

    gone = gone.join(active.select(*_DOC, "i", "from", "to"), [*_DOC, "i"])
    gone = gone.withColumn("island", F.col("i") - F.row_number().over(Window.partitionBy(*_DOC).orderBy("i")))
    runs = gone.groupBy(*_DOC, "island").agg(F.min("from").alias("from"), F.max("to").alias("to"), F.count(F.lit(1)).alias("lines"))
    return runs.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"), F.sum("lines").alias("n_removed"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` less its later copies, and ``n_removed``, the
    lines with a word that went.

    A run counts from ``min_words`` words, over line ends but not over documents; the first copy
    stays.  Blank lines go with the line before them.  Null texts stay null; texts without a word stay
    as they are.  Rows of equal id and text are one document: all are treated alike, and they are no
    copies of one another.  A column named ``n_removed`` is replaced; other names don't clash.
    """
    runs = repeated_runs(docs, min_words, doc_id, text)
    k1, k2 = _keys(docs[f"`{doc_id}`"], docs[f"`{text}`"])
    names = [c for c in docs.columns if c.lower() != "n_removed"]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), k1, k2).join(runs, _DOC, "left")
    old = F.col("row").getField(text)
    rows = rows.withColumn("lines", F.when(F.col("runs").isNotNull(), _split(old)))
    # the runs ascend and don't meet: what stays lies before, between and after them
    past = lambda i: F.coalesce(F.get("runs", i - 1)["to"], F.lit(0))
    kept = F.flatten(F.transform("runs", lambda r, i: F.slice("lines", past(i) + 1, F.greatest(r["from"] - past(i), F.lit(0)))))
    kept = F.concat(kept, F.slice("lines", past(F.size("runs")) + 1, F.size("lines")))
    new = F.when(F.col("runs").isNull(), old).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[(new if c == text else F.col("row").getField(c)).alias(c) for c in names],
                       F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"))
