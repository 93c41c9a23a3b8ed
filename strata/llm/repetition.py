"""Quality rules from repetition coverage.

Rolling hashes of the words' bytes, and over them of n-grams of several lengths, are kept as prefix
sums in numpy, so the hash of any n-gram costs one subtraction.  Equal hashes within a text are
found by sorting; what counts is the share of the text's word characters that lie inside n-grams or
lines which the text has already had, so that one repeated heading costs a clean text half as much.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm import texts

#: Largest share of word characters inside n-grams that came before, by n-gram length.
MAX_COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of lines, and of word characters in lines, that repeat an earlier line.
MAX_DUP_LINES, MAX_DUP_LINE_CHARS = 0.30, 0.20
#: Most symbols (# * $ % & | < >) for each word.
MAX_SYMBOLS = 0.10
#: The base rule: fewest words, and the largest share of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEATED_WORDS = 50, 0.50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

FIELDS = [T.StructField(n, T.LongType(), False) for n in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars")]
FIELDS += [T.StructField(f"dup_{n}gram_chars", T.LongType(), False) for n in MAX_COVERAGE]
FIELDS += [T.StructField(n, T.BooleanType(), False) for n in ("base_failed", "kept")]


def _covered(hits: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask of the words inside the windows of ``n`` words that start at ``hits``."""
    step = np.zeros(total + 1, np.int32)
    step[hits] += 1
    step[hits + n] -= 1
    return np.cumsum(step[:-1]) > 0


def _repeats(grams: np.ndarray, at: np.ndarray, doc: np.ndarray, salt: np.ndarray, n: int, among: np.ndarray) -> list[np.ndarray]:
    """Of the words ``among``: those that start an n-gram which their text holds twice or more, and
    those that start one which it held before."""
    among = among[among + n <= at[1:][doc[among]]]
    keys = texts.span_hash(grams, among, among + n) ^ salt[doc[among]]
    return [among[x] for x in texts.repeated(keys)]


def _lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every ``\\n``-split line."""
    breaks = np.flatnonzero(buf == 0x0A)
    starts = np.sort(np.concatenate([offs[:-1], breaks + 1]), kind="stable")
    # of equal starts the line of the earlier text comes first: an empty text, or a break at a text's end
    count = np.diff(np.searchsorted(breaks, offs)) + 1
    doc = np.repeat(np.arange(len(offs) - 1), count)
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.cumsum(count) - 1
    ends[last] = offs[1:]
    return starts, ends, doc


def profile(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The columns ``FIELDS`` of each text."""
    n_docs = len(offs) - 1
    starts, ends, at = texts.words(buf, offs)
    points = texts.code_points(buf)
    length = points[ends] - points[starts]
    n_words, word_chars = np.diff(at), texts.sums(length, at)
    symbols = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SYMBOL[buf], out=symbols[1:])
    n_symbols = symbols[offs[1:]] - symbols[offs[:-1]]
    doc = texts.owner(at)
    salt = texts.mixed(np.arange(1, n_docs + 1, dtype=np.uint64))
    prefix = texts.byte_hash(buf)

    l_start, l_end, l_doc = _lines(buf, offs)
    first, last = np.searchsorted(starts, l_start), np.searchsorted(starts, l_end)
    full = np.flatnonzero(last > first)
    again = full[texts.repeated(texts.span_hash(prefix, l_start[full], l_end[full]) ^ salt[l_doc[full]])[1]]
    chars = np.r_[0, np.cumsum(length)]
    per_doc = lambda where, weight=None: np.bincount(l_doc[where], weight, n_docs).astype(np.int64)
    n_lines, n_dup_lines = per_doc(full), per_doc(again)
    dup_line_chars = per_doc(again, chars[last[again]] - chars[first[again]])

    grams = texts.prefix_hash(texts.span_hash(prefix, starts, ends))
    twice, _ = _repeats(grams, at, doc, salt, 3, np.arange(len(starts)))
    n_repeat = texts.sums(_covered(twice, 3, len(starts)), at)
    coverage = {}
    for n in MAX_COVERAGE:  # among the repeated 5-grams, both copies, start all longer ones
        twice, hits = _repeats(grams, at, doc, salt, n, twice)
        coverage[n] = texts.sums(np.where(_covered(hits, n, len(starts)), length, 0), at)

    failed = (n_words < MIN_WORDS) | (100 * n_repeat > 100 * MAX_REPEATED_WORDS * n_words)
    bad = (n_symbols > MAX_SYMBOLS * n_words) | (n_dup_lines > MAX_DUP_LINES * n_lines)
    bad |= dup_line_chars > MAX_DUP_LINE_CHARS * word_chars
    for n, most in MAX_COVERAGE.items():
        bad |= coverage[n] > most * word_chars
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, n_lines, dup_line_chars,
            *coverage.values(), failed, ~failed & ~bad]


def repetition_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and the columns of ``FIELDS`` for every row.

    ``kept`` is false if the base rule or a threshold above fails.  Null and empty texts have no
    word and one empty line that does not count: all counts are zero, and they fail the base rule.
    A kept column with the name of a new one is replaced.  Each text is judged by itself, so
    repeated rows get equal results; whole texts count, whatever their length.
    """
    return texts.map_texts(docs, profile, FIELDS, text, docs.columns if keep is None else keep)
