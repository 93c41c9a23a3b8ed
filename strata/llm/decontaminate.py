"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and non-ASCII characters, with A-Z lower-cased.  A window is ``span``
consecutive words of an item, or the whole of an item that has fewer.  A document's word is hit if it
lies in an occurrence of a window.

1. Winnowing keeps, of every ``w`` consecutive hashes of ``k`` words, the least one (the leftmost of
   equals).  With ``k + w - 1`` = the window's length, any occurrence of a window has a kept hash, and
   the same one as the item: no shared span of that length is missed.  Items shorter than ``span`` have
   a ``k`` and ``w`` of their own length, used only if there are such items.
2. The documents' kept hashes meet those of the items in an equi-join.
3. Each hit is extended: the windows that kept the hash, at most ``w`` around a place, are looked up
   word for word among the items' windows, again an equi-join, so that neither a hot hash nor a hot
   window makes pairs of places.  Windows that meet are the hits; their union counts the words.

Only hashes that meet leave the first step, and only documents with one are read again.  Texts are
worked on in pieces of bounded size that share ``span - 1`` words, however long one may be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import texts
from strata.llm.store import stored

SPAN = 10
#: Bytes of text that one piece holds; a longer text is cut at word ends.
PIECE_BYTES = 1 << 21

#: Bytes between words: all but ASCII letters, digits and the bytes of other characters.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def scheme(length: int) -> tuple[int, int]:
    """``k`` and ``w`` for windows of ``length`` words: ``k + w - 1 = length``."""
    k = (length + 1) // 2
    return k, length - k + 1


def pieces(buf: np.ndarray, shared: int, limit: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, int]]:
    """Consecutive pieces of one text and the number of each one's first word; a piece starts with the
    last ``shared`` words of the one before, and no word is cut, however long it is."""
    at, number, tail = 0, 0, np.zeros(0, np.int64)
    while at < len(buf):
        end = min(at + limit, len(buf))
        while end < len(buf) and not _BETWEEN[buf[end]]:
            step = np.flatnonzero(_BETWEEN[buf[end:end + limit]])
            end = end + int(step[0]) if len(step) else min(end + limit, len(buf))
        begin = int(tail[0]) if len(tail) else at
        part = buf[begin:end]
        starts, _, _ = texts.words(part, np.array([0, len(part)]), _BETWEEN)
        first = number - len(tail)
        yield part, first
        number = first + len(starts)
        tail = starts[max(0, len(starts) - shared):] + begin if shared else tail
        at = end


@dataclass
class Unit:
    """Words of several texts, or of a piece of one: ``at`` cuts them by text, ``rows`` and ``firsts`` are
    the texts' rows in the batch and the number of each one's first word."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray
    rows: np.ndarray
    firsts: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return texts.owner(self.at)

    def hashes(self) -> np.ndarray:
        return texts.span_hash(texts.byte_hash(texts.LOWER[self.buf]), self.starts, self.ends)

    def spaced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words in lower case, one space after each, and where they start and end there."""
        size = self.ends - self.starts
        last = np.cumsum(size + 1) - 1
        plain = np.full(int(last[-1]) + 1 if len(last) else 0, 0x20, np.uint8)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        plain[inner + np.repeat(last - size, size)] = texts.LOWER[self.buf[inner + np.repeat(self.starts, size)]]
        return plain, last - size, last


def units(batch: pa.RecordBatch, column: int, shared: int) -> Iterator[Unit]:
    buf, offs = texts.buffers(batch.column(column))
    if batch.num_rows > 1 or len(buf) <= PIECE_BYTES:
        rows = np.arange(batch.num_rows)
        yield Unit(buf, *texts.words(buf, offs, _BETWEEN), rows, np.zeros(len(rows), np.int64))
        return
    for part, first in pieces(buf, shared):
        yield Unit(part, *texts.words(part, np.array([0, len(part)]), _BETWEEN), np.array([0]), np.array([first]))


def winnowed(words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of ``length`` words within a text: its start, and the place and hash of the ``k``
    words that winnowing keeps in it.  ``words`` are the words' hashes."""
    k, w = scheme(length)
    head = np.arange(len(words))
    head = head[head + length <= np.repeat(at[1:], np.diff(at))]
    if not len(head):
        return head, head, np.zeros(0, np.uint64)
    start = np.arange(len(words) - k + 1)
    hashes = texts.span_hash(texts.prefix_hash(words), start, start + k)
    least, place = hashes[head], head.copy()
    for i in range(1, w):
        other = hashes[head + i]
        smaller = other < least
        least[smaller] = other[smaller]
        place[smaller] = head[smaller] + i
    return head, place, least


def _taken(plain: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices of ``plain`` as texts."""
    size = ends - starts
    offs = np.r_[0, np.cumsum(size)].astype(np.int64)
    body = plain[np.arange(offs[-1]) + np.repeat(starts - offs[:-1], size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(body))).cast(pa.string())


def _marks(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``docs`` (``_text`` last) with n_words and ``_prints``, the hashes kept for windows of ``lengths``."""
    shared, keep = max(lengths, default=1) - 1, docs.columns[:-1]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_words", T.LongType()), T.StructField("_prints", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.chunks(batch, "_text"):
                n_words, of, prints = np.zeros(part.num_rows, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for unit in units(part, len(keep), shared):
                    n_words[unit.rows] = unit.firsts + np.diff(unit.at)
                    words, owner = unit.hashes(), unit.rows[unit.owner]
                    for length in lengths:
                        _, place, least = winnowed(words, unit.at, length)
                        new = np.r_[True, place[1:] != place[:-1]][:len(place)]
                        of.append(owner[place[new]])
                        prints.append(least[new])
                rows, values = np.concatenate(of), np.concatenate(prints).view(np.int64)
                order = np.argsort(rows, kind="stable")
                offs = np.searchsorted(rows[order], np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offs), pa.array(values[order]))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n_words), lists], [*keep, "n_words", "_prints"])

    return docs.mapInArrow(texts.tidy(run), schema)


def _item_windows(items: DataFrame, span: int) -> DataFrame:
    """(item, length, window, print) of items (item, _text): each window and the hash that is kept in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.chunks(batch, "_text"):
                total = np.zeros(part.num_rows, np.int64)
                for unit in units(part, 1, span - 1):
                    total[unit.rows] = unit.firsts + np.diff(unit.at)
                for unit in units(part, 1, span - 1):
                    words, owner, (plain, at, till) = unit.hashes(), unit.rows[unit.owner], unit.spaced()
                    for length in sorted({span, *total[(total > 0) & (total < span)].tolist()}):
                        head, _, least = winnowed(words, unit.at, length)
                        own = np.minimum(total[owner[head]], span) == length
                        head, least = head[own], least[own]
                        for a in range(0, len(head), 1 << 14):
                            h = head[a:a + (1 << 14)]
                            yield pa.RecordBatch.from_arrays([
                                part.column(0).take(pa.array(owner[h])), pa.array(np.full(len(h), length, np.int32)),
                                _taken(plain, at[h], till[h + length - 1]), pa.array(least[a:a + (1 << 14)].view(np.int64))],
                                ["item", "length", "window", "print"])

    return items.mapInArrow(texts.tidy(run), "item string, length int, window string, print long")


def _extended(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(k1, k2, start, length, window): the windows around every place of a hash that ``met`` holds, of
    ``docs`` (k1, k2, met, _text)."""
    shared = max(lengths, default=1) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.chunks(batch, "_text"):
                # any of these hashes is an item's, in whichever text it stands
                met = np.unique(part.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                for unit in units(part, 3, shared):
                    words, owner, (plain, at, till) = unit.hashes(), unit.owner, unit.spaced()
                    for length in lengths:
                        head, _, least = winnowed(words, unit.at, length)
                        head = head[np.isin(least, met)]
                        for a in range(0, len(head), 1 << 14):
                            h = head[a:a + (1 << 14)]
                            rows, number = pa.array(unit.rows[owner[h]]), h - unit.at[owner[h]] + unit.firsts[owner[h]]
                            yield pa.RecordBatch.from_arrays([
                                part.column(0).take(rows), part.column(1).take(rows), pa.array(number),
                                pa.array(np.full(len(h), length, np.int32)), _taken(plain, at[h], till[h + length - 1])],
                                ["k1", "k2", "start", "length", "window"])

    return docs.mapInArrow(texts.tidy(run), "k1 long, k2 long, start long, length int, window string")


def hits(docs: DataFrame, items: DataFrame, span: int = SPAN, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``n_words``, ``hit_spans`` (array of (start, length) of the
    occurring windows, as numbers of words) and ``hit_items`` (ids as text, sorted, each once).

    A null or wordless text has no words and no hits, a null or wordless item no windows.  Items with
    equal ids count once; a null id is the text ``null``.  Repeated rows get equal results, and null or
    repeated document ids do no harm.  Texts and items of any length are read whole.  Without items
    nothing is hit; without documents there are no rows.  A kept column with the name of a new one (all
    in lower case) is replaced by it.
    """
    new = ("n_words", "hit_spans", "hit_items")
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    body, key = docs[f"`{text}`"].cast("string"), docs[f"`{doc_id}`"]
    keys = [F.xxhash64(key, body).alias("k1"), F.xxhash64(F.lit(7), body, key).alias("k2")]
    item = F.coalesce(items[f"`{item_id}`"].cast("string"), F.lit("null"))
    windows = stored(_item_windows(items.select(item.alias("item"), items[f"`{item_text}`"].cast("string").alias("_text")), span).distinct(), "windows")
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())  # ``span`` of them at most

    own = F.struct(F.lit(1).alias("_"), *[docs[f"`{c}`"] for c in names]).alias("row")
    marked = stored(_marks(docs.select(own, *keys, body.alias("_text")), lengths), "marks")
    prints = stored(windows.select("print").distinct(), "prints")
    met = marked.select("k1", "k2", F.explode("_prints").alias("print")).join(prints, "print", "left_semi")
    met = stored(met.groupBy("k1", "k2").agg(F.collect_set("print").alias("met")), "met")

    again = docs.select(*keys, body.alias("_text")).join(met, ["k1", "k2"]).select("k1", "k2", "met", "_text")
    known = stored(windows.select("window").distinct(), "known")
    found = stored(_extended(again, lengths).join(known, "window", "left_semi"), "found")

    spans = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("hit_spans"))
    ids = found.select("k1", "k2", "window").distinct().join(windows.select("item", "window"), "window")
    ids = ids.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("hit_items"))
    result = marked.select("row", "k1", "k2", "n_words").join(stored(spans.join(ids, ["k1", "k2"]), "hits"), ["k1", "k2"], "left")
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    return result.select(*[F.col("row").getField(c).alias(c) for c in names], "n_words",
                         none("hit_spans", "array<struct<start:bigint,length:int>>"), none("hit_items", "array<string>"))


def covered(spans: Column) -> Column:
    """Number of words in the union of sorted (start, length) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("till"))

    def add(acc, x):
        end = x["start"] + x["length"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(x["start"], acc["till"]))).cast("long").alias("n"),
                        F.greatest(acc["till"], end).cast("long").alias("till"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])
