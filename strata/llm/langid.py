"""Language identification of mixed-language text.

A word's script (from code-point ranges) narrows the languages that can claim it.  Hashed byte
n-grams of the word, and the word itself, give each remaining language a score; Viterbi over the
words with a penalty for every switch labels spans.  A document gets the language that holds most
characters of its lettered words.  How sure its labels are is judged span by span, whatever language
each has: only letters of scripts that were learned count for it.

A path without a switch is best, and no search is needed, if no other language gains more than half the
penalty over any run of words: ``k`` spans of other languages gain at most ``k / 2`` penalties and pay
``k - 1`` at least, which is as much from two spans on; a single one gains nothing over the best total.
All other documents of a batch go through Viterbi together, word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import texts

UND = "und"
#: Buckets of hashed n-grams; the model has this many rows and a column for each language.
BUCKETS = 1 << 16
#: About so many labelled documents of each language are learned from, drawn by a hash of the id.
TRAIN_DOCS = 4000
#: Most that one word can count against a language, and the cost of a switch, in nats.
CLIP, SWITCH = 5.0, 12.0
#: Share of a language's lettered words from which a script counts as its own.
SCRIPT_SHARE = 0.001

#: First code point of each range and its script (0: no letter).
_RANGES = [
    (0x0, 0), (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xB5, 1), (0xB6, 0), (0xBA, 1),
    (0xBB, 0), (0xC0, 1), (0xD7, 0), (0xD8, 1), (0xF7, 0), (0xF8, 1), (0x2B9, 0), (0x370, 2), (0x400, 3), (0x530, 4),
    (0x590, 5), (0x600, 6), (0x700, 7), (0x900, 8), (0x980, 9), (0xA00, 10), (0xE00, 11), (0xE80, 12), (0x10A0, 13),
    (0x1100, 14), (0x1200, 15), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C00, 15), (0x2E00, 0), (0x3005, 16),
    (0x3008, 0), (0x3041, 17), (0x3100, 16), (0x3130, 14), (0x3190, 0), (0x3400, 16), (0xA000, 15), (0xAC00, 14),
    (0xD800, 0), (0xF900, 16), (0xFB00, 15), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0), (0xFF21, 1), (0xFF3B, 0),
    (0xFF41, 1), (0xFF5B, 0), (0xFF66, 17), (0xFFA0, 14), (0xFFE0, 0), (0x10000, 15), (0x1F000, 0), (0x20000, 16),
    (0x31350, 0),
]
SCRIPTS = 18
_FROM = np.array([a for a, _ in _RANGES])
_SCRIPT = np.array([b for _, b in _RANGES])
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass
class Model:
    langs: list[str]
    #: log-probability of each bucket in each language, less the best language's.
    table: np.ndarray
    #: whether a language is a candidate for a script.
    writes: np.ndarray


def _scripts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The highest script number among the letters of each word."""
    size = ends - starts
    heads = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(heads - starts, size)
    wide = np.concatenate([buf, np.zeros(3, np.uint8)])
    b0, b1, b2, b3 = (wide[at + k].astype(np.int32) for k in range(4))
    two = (b0 & 0x1F) << 6 | (b1 & 0x3F)
    three = (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | (b2 & 0x3F)
    four = (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | (b3 & 0x3F)
    point = np.select([b0 < 0x80, b0 < 0xC0, b0 < 0xE0, b0 < 0xF0], [b0, 0, two, three], four)
    return np.maximum.reduceat(_SCRIPT[np.searchsorted(_FROM, point, "right") - 1], heads)


def _features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length: bucket and validity at every byte of the words, and the words' heads."""
    size = ends - starts + 2
    heads = np.cumsum(size) - size
    packed = np.zeros(int(size.sum()) + 4, np.uint64)
    inner = np.arange(int((size - 2).sum())) - np.repeat(np.cumsum(size - 2) - (size - 2), size - 2)
    packed[inner + np.repeat(heads + 1, size - 2)] = texts.LOWER[buf[inner + np.repeat(starts, size - 2)]]
    left = np.repeat(heads + size, size) - np.arange(int(size.sum()))
    code = packed[:-4].copy()
    for n in (2, 3, 4):
        code |= packed[n - 1:len(packed) - 5 + n] << np.uint64(8 * (n - 1))
        yield _bucket(code + np.uint64(n << 40)), left >= n, heads
    prefix = texts.byte_hash(texts.LOWER[buf])
    whole = np.zeros(len(code), np.int64)
    whole[heads] = _bucket(texts.span_hash(prefix, starts, ends))
    only = np.zeros(len(code), bool)
    only[heads] = True
    yield whole, only, heads


def _bucket(code: np.ndarray) -> np.ndarray:
    return (texts.mixed(code) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def _distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each distinct word, the distinct word of each word, and how often it stands."""
    _, first, which, count = np.unique(texts.span_hash(texts.byte_hash(buf), starts, ends), return_index=True,
                                       return_inverse=True, return_counts=True)
    return first, which, count


def _counts(text: str, lang: str):
    """Sums of this task: (lang, bucket, n); buckets from ``BUCKETS`` on count words by script."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in texts.chunks(batch, text):
                of = part.column(part.schema.get_field_index(lang)).to_numpy(zero_copy_only=False)
                for name in set(of):
                    buf, offs = texts.buffers(part.filter(pa.array(of == name)).column(part.schema.get_field_index(text)))
                    starts, ends, _ = texts.words(buf, offs)
                    if not len(starts):
                        continue
                    first, _, n = _distinct(buf, starts, ends)
                    starts, ends = starts[first], ends[first]
                    script = _scripts(buf, starts, ends)
                    starts, ends, n, script = (x[script > 0] for x in (starts, ends, n, script))
                    mine = total.setdefault(name, np.zeros(BUCKETS + SCRIPTS))
                    if not len(starts):
                        continue
                    mine += np.bincount(BUCKETS + script, n, len(mine))
                    for bucket, valid, heads in _features(buf, starts, ends):
                        weight = np.repeat(n, np.diff(np.r_[heads, len(bucket)]))
                        mine += np.bincount(bucket[valid], weight[valid], len(mine))
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at),
                                              pa.array(n[at].astype(np.int64))], ["lang", "bucket", "n"])

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from rows with a language and a text.

    Each language is thinned to about ``train_docs`` documents by a hash of ``doc_id``, so what is
    fitted, and the ``BUCKETS`` times languages counts that reach the driver, are bounded however
    large the corpus is.  Without labelled rows the model has no language.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
                           F.pmod(F.xxhash64(F.col(f"`{doc_id}`")), F.lit(1_000_000)).alias("draw")).where("lang IS NOT NULL AND text IS NOT NULL")
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), train_docs / F.count("*")).alias("share"))
    drawn = rows.join(F.broadcast(share), "lang").where("draw < share * 1000000").select("text", "lang")
    counted = drawn.mapInArrow(texts.tidy(_counts("text", "lang")), "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(found["lang"].unique().to_pylist())
    raw = np.zeros((BUCKETS + SCRIPTS, len(langs)))
    for k, name in enumerate(langs):
        own = found.filter(pc.equal(found["lang"], name))
        raw[own["bucket"].to_numpy(), k] = own["n"].to_numpy()
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((SCRIPTS, 0), bool))
    grams, script = raw[:BUCKETS] + 0.5, raw[BUCKETS:]
    log = np.log(grams / grams.sum(0))
    return Model(langs, (log - log.max(1, keepdims=True)).astype(np.float32),
                 script / np.maximum(1, script.sum(0)) >= SCRIPT_SHARE)


def _word_scores(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores (words, languages), 0 for the best, and whether each word has a letter, and one of a learned script."""
    first, which, _ = _distinct(buf, starts, ends)
    starts, ends = starts[first], ends[first]
    script = _scripts(buf, starts, ends)
    total, grams = np.zeros((len(starts), len(model.langs)), np.float32), np.zeros(len(starts), np.float32)
    for bucket, valid, heads in _features(buf, starts, ends):
        total += np.add.reduceat(np.where(valid[:, None], model.table[bucket], 0), heads, axis=0)
        grams += np.add.reduceat(valid.astype(np.float32), heads)
    total /= np.sqrt(np.maximum(grams, 1))[:, None]  # overlapping n-grams are not independent
    total = np.maximum(total - total.max(1, keepdims=True), -CLIP)
    may = model.writes[script]
    known = may.any(1) & (script > 0)
    total = np.where(may, total, -CLIP)
    total[~known] = 0
    return (total - total.max(1, keepdims=True))[which], (script > 0)[which], known[which]


def _one_language(score: np.ndarray, at: np.ndarray, doc: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Whether no run of a text's words gains another language more than half the penalty."""
    calm = np.ones(len(at) - 1, bool)
    own = score[np.arange(len(doc)), best[doc]].astype(np.float64)
    full = np.flatnonzero(np.diff(at))
    for m in range(score.shape[1]):
        gain = score[:, m] - own
        run = np.r_[0.0, np.cumsum(gain)]
        step = 2 * CLIP * (len(doc) + 1)  # each text lies below all earlier ones
        low = np.minimum.accumulate(run[:-1] - step * doc)
        most = np.maximum.reduceat(run[1:] - step * doc - low, at[:-1][full])
        calm[full] &= most <= SWITCH / 2
    return calm


def _viterbi(score: np.ndarray, at: np.ndarray, among: np.ndarray, label: np.ndarray) -> None:
    """Set ``label`` for the words of the texts ``among``, all at once from word to word."""
    among = among[np.argsort(at[among] - at[among + 1], kind="stable")]  # longest first
    first, size = at[among], at[among + 1] - at[among]
    value, back = score[first].astype(np.float64), []
    for t in range(1, int(size[0]) if len(size) else 0):
        k = int(np.searchsorted(-size, -t))  # texts with more than t words
        top = value[:k].argmax(1)
        from_top = value[np.arange(k), top][:, None] - SWITCH
        stay = value[:k] >= from_top
        back.append(np.where(stay, np.arange(value.shape[1]), top[:, None]).astype(np.int16))
        value[:k] = np.where(stay, value[:k], from_top) + score[first[:k] + t]
    now = value.argmax(1)
    for t in range(len(back), -1, -1):
        k = int(np.searchsorted(-size, -t))
        label[first[:k] + t] = now[:k]
        if t:
            now[:k] = back[t - 1][np.arange(k), now[:k]]


def label_texts(buf: np.ndarray, offs: np.ndarray, model: Model) -> list[pa.Array]:
    """Language, score, spans and sureness of each text."""
    n, names = len(offs) - 1, np.array([*model.langs, UND], dtype=object)
    starts, ends, at = texts.words(buf, offs)
    lettered = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_ASCII_LETTER[buf], out=lettered[1:])
    has = lettered[offs[1:]] > lettered[offs[:-1]]
    for i in np.flatnonzero(~has & (np.diff(offs) > 0)):
        has[i] = any(c.isalpha() for c in bytes(buf[offs[i]:offs[i + 1]]).decode())
    lang, score, sure = np.full(n, len(model.langs)), np.zeros(n), np.zeros(n)
    label = np.zeros(len(starts), np.int64)
    if model.langs and len(starts):
        words, letters, known = _word_scores(buf, starts, ends, model)
        total = np.zeros((n, len(model.langs)))
        full = np.flatnonzero(np.diff(at))
        total[full] = np.add.reduceat(words.astype(np.float64), at[:-1][full], axis=0)
        best, doc = total.argmax(1), texts.owner(at)
        label = best[doc]
        _viterbi(words, at, np.flatnonzero(~_one_language(words, at, doc, best)), label)
        points = texts.code_points(buf)
        size = (points[ends] - points[starts]) * letters
        held = np.bincount(doc * len(model.langs) + label, size, n * len(model.langs)).reshape(n, -1)
        lang = np.where(has, np.where(held.any(1), held.argmax(1), best), lang)
        share = held.max(1) / np.maximum(1, held.sum(1))
        ordered = np.sort(total, axis=1)
        gap = ordered[:, -1] - (ordered[:, -2] if len(model.langs) > 1 else -CLIP)
        score = np.where(has, share / (1 + np.exp(-np.minimum(gap, 50))), 0.0)
    new = np.ones(len(label), bool)
    new[1:] = label[1:] != label[:-1]
    new[at[:-1][np.diff(at) > 0]] = True
    heads = np.flatnonzero(new)
    place = np.searchsorted(heads, at)
    doc = texts.owner(place)
    tails = np.r_[heads[1:], len(label)]
    if model.langs and len(heads):
        total = np.add.reduceat(words.astype(np.float64), heads, axis=0)
        own = total[np.arange(len(heads)), label[heads]]
        total[np.arange(len(heads)), label[heads]] = -np.inf
        gap = own - (total.max(1) if len(model.langs) > 1 else -CLIP)
        held = np.add.reduceat(size * known, heads) / (1 + np.exp(-np.clip(gap, -50, 50)))
        sure = np.where(has, np.bincount(doc, held, n) / np.maximum(1, np.bincount(doc, np.add.reduceat(size, heads), n)), 0.0)
    spans = pa.StructArray.from_arrays(
        [pa.array(heads - at[doc], pa.int64()), pa.array(tails - at[doc], pa.int64()),
         pa.array(np.where(has[doc], names[label[heads]], UND), pa.string())],
        fields=[pa.field("start", pa.int64()), pa.field("end", pa.int64()), pa.field("lang", pa.string())]) if len(heads) else None
    kind = pa.list_(pa.struct([pa.field("start", pa.int64()), pa.field("end", pa.int64()), pa.field("lang", pa.string())]))
    lists = pa.array([[]] * n, kind) if spans is None else pa.ListArray.from_arrays(pa.array(place, pa.int32()), spans)
    return [pa.array(names[lang], pa.string()), pa.array(score), lists.cast(kind), pa.array(sure)]


FIELDS = [
    T.StructField("lang_pred", T.StringType(), False), T.StructField("lang_score", T.DoubleType(), False),
    T.StructField("lang_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))),
    T.StructField("lang_sure", T.DoubleType(), False),
]


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default), ``lang_pred``, ``lang_score`` (0 to 1), ``lang_spans``: word
    positions, end exclusive, with their language, and ``lang_sure`` (0 to 1).

    ``lang_score`` falls with the share of other languages than ``lang_pred``; ``lang_sure`` does not.  It
    is the share of the lettered words' characters that stand in words of a learned script, each span's
    weighed by how far its language leads there (one half if not at all).

    ``und`` and score 0 if the text is null, empty or has no letter, or if the model has no
    language.  Letters of a script that no language was learned in leave all languages level: the
    first one gets the text with a score of one half at most and ``lang_sure`` 0.  Each text is judged by itself, so repeated rows get
    equal results.  A kept column with the name of a new one is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats
    return texts.map_texts(docs, lambda buf, offs: label_texts(buf, offs, held.value), FIELDS, text,
                           docs.columns if keep is None else keep)
