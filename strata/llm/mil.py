"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words.  A passage is encoded by one dense layer over
shares of character classes, repetition figures and a histogram of hashed byte pairs.  Gated
attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``, weighs the encoded passages, and a logistic
layer scores the weighted sum.  All of it is learned from document labels alone, by Adam in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import texts
from strata.llm.store import stored

PASSAGE = 64
#: Learned from about so many labelled documents, drawn by a hash of the id.
TRAIN_DOCS = 6000
#: Passages of theirs that reach the driver, some 600 bytes each.
TRAIN_PASSAGES = 250_000
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 12, 25, 128, 4e-3, 1e-4, 7
PAIRS = 128

_CLASSES = np.zeros((10, 256), bool)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!", b"?.",
                             b",;:", b"#*$%&|<>", b"\n", b"\"'()[]{}-_/@", bytes(range(128, 192)))):
    _CLASSES[_k, list(_chars)] = True
N_FEATURES = len(_CLASSES) + 6 + PAIRS


def passages(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features (passages, N_FEATURES) and ``n + 1`` passage offsets; a text without words has one
    passage of zeros."""
    starts, ends, at = texts.words(buf, offs)
    n = np.diff(at)
    count = np.maximum(1, -(-n // PASSAGE))
    cuts = np.r_[0, np.cumsum(count)]
    doc = texts.owner(cuts)
    lo = at[:-1][doc] + (np.arange(cuts[-1]) - cuts[:-1][doc]) * PASSAGE
    hi = np.minimum(lo + PASSAGE, at[1:][doc])
    full = np.flatnonzero(hi > lo)
    out = np.zeros((cuts[-1], N_FEATURES), np.float32)
    if not len(full):
        return out, cuts
    words = (hi - lo)[full].astype(np.float32)
    a, b = starts[lo[full]], ends[hi[full] - 1]
    size = (b - a).astype(np.float32)
    for k, chars in enumerate(_CLASSES):
        total = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(chars[buf], out=total[1:])
        out[full, k] = (total[b] - total[a]) / (words if k > 1 else size)
    which = np.repeat(np.arange(len(full)), (hi - lo)[full])
    word = texts.span_hash(texts.byte_hash(texts.LOWER[buf]), starts, ends)
    again = texts.repeated(word ^ texts.mixed(which.astype(np.uint64) + np.uint64(1)))[1]
    twin = np.r_[False, (word[1:] == word[:-1]) & (which[1:] == which[:-1])]
    length = (ends - starts).astype(np.float64)
    k = len(_CLASSES)
    out[full, k] = np.bincount(which, again, len(full)) / words
    out[full, k + 1] = np.bincount(which, twin, len(full)) / words
    out[full, k + 2] = np.bincount(which, length, len(full)) / words / 10
    out[full, k + 3] = np.sqrt(np.bincount(which, length * length, len(full)) / words) / 10
    out[full, k + 4] = np.log1p(words)
    out[full, k + 5] = np.log1p(n[doc[full]])
    inside = np.arange(int((b - a).sum())) - np.repeat(np.cumsum(b - a) - b, b - a)
    pair = buf[inside].astype(np.uint32) * np.uint32(251) + np.append(buf, np.uint8(0))[inside + 1]
    pair = ((pair * np.uint32(2654435761)) >> np.uint32(25)).astype(np.int64)
    of = np.repeat(np.arange(len(full)), b - a)
    counts = np.bincount(of * PAIRS + pair, minlength=len(full) * PAIRS).reshape(-1, PAIRS)
    out[full, k + 6:] = np.sqrt(counts / size[:, None])
    return out, cuts


def _forward(p: dict, x: np.ndarray, cuts: np.ndarray) -> dict:
    h = np.tanh(x @ p["W"] + p["b"])
    v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (v * u) @ p["w"]
    doc, head = texts.owner(cuts), cuts[:-1]
    e = np.exp(e - np.maximum.reduceat(e, head)[doc])
    a = e / np.add.reduceat(e, head)[doc]
    z = np.add.reduceat(a[:, None] * h, head, axis=0)
    s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "s": s, "doc": doc, "head": head}


def _gradient(p: dict, x: np.ndarray, cuts: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(p, x, cuts)
    h, v, u, a, doc = f["h"], f["v"], f["u"], f["a"], f["doc"]
    ds = (f["s"] - y) / len(y)
    dz = ds[:, None] * p["c"]
    pull = (dz[doc] * h).sum(1)
    de = a * (pull - np.add.reduceat(a * pull, f["head"])[doc])
    dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
    dh = (a[:, None] * dz[doc] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de,
            "c": f["z"].T @ ds, "d": ds.sum(keepdims=True)}


def train(bags: list[np.ndarray], labels: np.ndarray) -> dict:
    """Parameters from bags of passage features and 0/1 labels; without both classes a constant score."""
    y = np.asarray(labels, np.float64)
    rng = np.random.default_rng(SEED)
    n = N_FEATURES
    p = {"W": rng.normal(0, n ** -0.5, (n, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)),
         "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    p |= {"mean": np.zeros(n), "scale": np.ones(n)}
    if len(set(y)) < 2:
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return p | {"c": np.zeros(HIDDEN), "d": np.log([share / (1 - share)])}
    x, cuts = np.concatenate(bags).astype(np.float64), np.r_[0, np.cumsum([len(b) for b in bags])]
    p |= {"mean": x.mean(0), "scale": 1 / (x.std(0) + 1e-3)}
    x = (x - p["mean"]) * p["scale"]
    names = ("W", "b", "V", "U", "w", "c", "d")
    one, two = ({k: np.zeros_like(p[k]) for k in names} for _ in range(2))
    steps, t = EPOCHS * -(-len(y) // BATCH), 0
    for _ in range(EPOCHS):
        for pick in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
            size = cuts[pick + 1] - cuts[pick]
            own = np.r_[0, np.cumsum(size)]
            rows = np.arange(own[-1]) - np.repeat(own[:-1] - cuts[pick], size)
            g = _gradient(p, x[rows], own, y[pick])
            t += 1
            rate = RATE * (1 - t / (steps + 1))
            for k in names:
                g[k] += DECAY * p[k]
                one[k] += 0.1 * (g[k] - one[k])
                two[k] += 0.001 * (g[k] ** 2 - two[k])
                p[k] = p[k] - rate * (one[k] / (1 - 0.9 ** t)) / (np.sqrt(two[k] / (1 - 0.999 ** t)) + 1e-8)
    return p


def score_texts(buf: np.ndarray, offs: np.ndarray, p: dict) -> list[np.ndarray]:
    """Score, passages and the largest attention weight of each text."""
    x, cuts = passages(buf, offs)
    f = _forward(p, (x - p["mean"]) * p["scale"], cuts)
    return [f["s"], np.diff(cuts), np.maximum.reduceat(f["a"], f["head"])]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in texts.chunks(batch, "text"):
            x, cuts = passages(*texts.buffers(part.column(2)))
            bags = [x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(cuts)), pa.array(bags, pa.binary())],
                                             ["draw", "label", "n", "bag"])


def _every(step: int):
    """Every ``step``-th passage of each bag, the first included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [np.frombuffer(x.as_buffer(), np.float32).reshape(-1, N_FEATURES)[::step].tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bags, pa.binary())], ["draw", "label", "bag"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES) -> dict:
    """Learn from ``docs`` joined with ``labels`` on ``doc_id``.

    About ``train_docs`` labelled documents are drawn by a hash of the id before the join; their
    passage features are all that reaches the driver, ``train_passages`` and one a document at most: if
    they have more, every second, third, ... passage of each is learned from.  Null labels don't count;
    of several labels of one id the mean decides, 1 from a half.
    """
    draw = F.xxhash64(F.col(f"`{doc_id}`"), F.lit(SEED))
    given = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
    few = drawn(draw, min(1.0, train_docs / max(1, given.count())))
    given = given.where(few).groupBy(F.col(f"`{doc_id}`").alias("id")).agg((F.avg(F.col(f"`{label}`")) >= 0.5).cast("long").alias("label"))
    rows = docs.where(few).select(F.col(f"`{doc_id}`").alias("id"), draw.alias("draw"), F.col(f"`{text}`").alias("text"))
    bags = rows.join(given, "id").select("draw", "label", "text").mapInArrow(texts.tidy(_bags), "draw long, label long, n long, bag binary")
    bags = stored(bags, "bags")
    step = -(-(bags.agg(F.sum("n")).first()[0] or 0) // train_passages) or 1
    found = bags.select("draw", "label", "bag").mapInArrow(_every(step), "draw long, label long, bag binary").toArrow()
    rows = sorted(zip(found["draw"].to_pylist(), found["bag"].to_pylist(), found["label"].to_pylist()))
    return train([np.frombuffer(bag, np.float32).reshape(-1, N_FEATURES) for _, bag, _ in rows], np.array([y for *_, y in rows]))


#: Steps of a draw: fine enough for one row in 10**15.
DRAW_STEPS = 1 << 53


def drawn(hash_: Column, share: float) -> Column:
    """Whether a row with this 64-bit hash is among about ``share`` of all."""
    return F.pmod(hash_, F.lit(DRAW_STEPS)) < F.lit(math.ceil(share * DRAW_STEPS))


FIELDS = [T.StructField("quality_score", T.DoubleType(), False), T.StructField("n_passages", T.LongType(), False),
          T.StructField("top_attention", T.DoubleType(), False)]


def score(docs: DataFrame, params: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``FIELDS``: the score (0 to 1, higher: label 1 likelier),
    the number of passages and the largest attention weight.

    Null and empty texts are one empty passage and get the model's score for it.  Each text is scored
    whole and by itself, so repeated rows get equal scores.  A kept column with the name of a new one
    is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(params)  # fixed size
    return texts.map_texts(docs, lambda buf, offs: score_texts(buf, offs, held.value), FIELDS, text,
                           docs.columns if keep is None else keep)
