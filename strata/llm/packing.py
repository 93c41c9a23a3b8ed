"""Packing documents into sequences by order-preserving dynamic programming.

Documents stay in ascending order of id, each as its tokens and one end token.  Sequences are cut out
of that stream at document ends, at sentence ends, or inside any sentence: there at every ``GRID``-th
token of the stream and where a sequence from an earlier document's end is full.  With ``f(j)`` the least cost of cutting everything before position ``j``::

    f(j) = penalty(j) + SEQUENCE + min over i of f(i) + padding(j - i)

``padding(n)`` is ``width - n``, and nothing for a power of two.  As ``f(i) + i`` does not depend on
``j``, the first case is a sliding-window minimum, kept in a monotone queue; the powers of two add a
few exact positions.  A document's end costs nothing, a sentence's end or a forced cut a penalty.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm import texts

WIDTH = 1024
#: Costs in padded tokens: a cut after a sentence, a cut inside one, and each sequence.
SENTENCE, FORCED, SEQUENCE = 4, 64, 2
#: Places inside sentences are so many tokens apart; sequences from one to another need no padding.
GRID = 64
#: Texts are tokenized and cut in runs of about so many bytes; a run ends with a document.
RUN_BYTES = 1 << 21
END_ID = 0

_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
#: Last bytes of the sentence stops of other scripts, which need no space after them.
_STOPS = np.array(sorted(int.from_bytes(c.encode()[-3:]) for c in "\u0589\u061f\u06d4\u0964\u0965\u0f0d\u104b\u1362\u1367\u1368\u17d4\u203c\u2047\u2048\u2049\u3002\uff01\uff0e\uff1f\uff61"))
_BREAK = np.zeros(256, bool)
_BREAK[list(b" \t\n\r\"')]")] = True


def cuts_of(places: np.ndarray, penalty: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The cheapest cuts among sorted ``places`` (first and last are always cut); neighbouring
    places are at most ``width`` apart."""
    m = len(places)
    exact = _exact(places, width)
    # costs are counted from a full sequence: f(i) + i - (j - width) beside f(i) for an exact power
    best, came = [0] * m, [0] * m
    queue, of, front = [int(places[0])], [0], 0  # f(i) + i, rising, and its i; the front is the least within reach
    steps = zip(range(1, m), (places[1:] - width).tolist(), np.searchsorted(places, places[1:] - width).tolist(), (penalty[1:] + SEQUENCE).tolist())
    for j, base, first, cost in steps:
        while of[front] < first:
            front += 1
        i = of[front]
        low = queue[front] - base
        if exact[j]:
            for k in exact[j]:
                if best[k] < low:
                    low, i = best[k], k
        best[j] = low = low + cost
        came[j] = i
        low += base + width
        while len(of) > front and queue[-1] >= low:
            queue.pop()
            of.pop()
        queue.append(low)
        of.append(j)
    out = [m - 1]
    while out[-1]:
        out.append(came[out[-1]])
    return places[out[::-1]]


def _exact(places: np.ndarray, width: int) -> list[list[int] | None]:
    """Of each place, the places that lie a power of two below ``width`` before it."""
    ends, starts, power = [], [], 1
    while power < width:
        back = np.searchsorted(places, places - power)
        there = np.flatnonzero(places[back] == places - power)
        ends.append(there)
        starts.append(back[there])
        power *= 2
    out: list[list[int] | None] = [None] * len(places)
    if not ends:
        return out
    end, start = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(end, kind="stable")
    end, start = end[order], start[order].tolist()
    some, at = np.unique(end, return_index=True)
    for j, a, b in zip(some.tolist(), at.tolist(), [*at[1:].tolist(), len(end)]):
        out[j] = start[a:b]
    return out


def _tokenizer(model: str, ranks: str):
    import tiktoken

    with open(model, encoding="utf-8") as f:
        added = {t["id"]: t["content"] for t in json.load(f)["added_tokens"]}
    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(1 + max(*merges.values(), *added), np.int64)
    for piece, i in merges.items():
        size[i] = len(piece)
    special = list(added.values())
    for i, content in added.items():
        size[i] = len(content.encode())
    full: list = []  # the model file takes far longer to load than all ranks: only if some text asks for it
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def encode(text: str) -> np.ndarray:
        """Ids of the model file; its ranks give the same ones sooner where no special token stands."""
        if any(t in text for t in special):
            if not full:
                from tokenizers import Tokenizer

                full.append(Tokenizer.from_file(model))
            return np.array(full[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(quick.encode_ordinary(text), np.uint32)

    return encode, size


def _other_stops(buf: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Which of the tokens that end at ``byte`` end with a stop of another script."""
    out = np.zeros(len(byte), bool)
    wide = np.flatnonzero(buf[byte - 1] >= 0x80) if len(buf) else np.zeros(0, np.int64)
    padded = np.r_[np.zeros(3, np.int64), buf]
    three, two, one = (padded[byte[wide] + 3 - k] for k in (3, 2, 1))
    out[wide] = np.isin(np.where(two >= 0xC0, 0, three) << 16 | two << 8 | one, _STOPS)
    return out


def _inside(places: np.ndarray, doc_end: np.ndarray, width: int) -> np.ndarray:
    """Places inside the sentences between ``places`` for forced cuts."""
    grid, full = np.arange(0, places[-1], GRID), doc_end + width
    whole = [np.arange(places[k] + width, places[k + 1], width) for k in np.flatnonzero(np.diff(places) > width)]
    return np.setdiff1d(np.concatenate([grid, full[full < places[-1]], *whole]), places)


def _run(rows: pa.RecordBatch, encode, size: np.ndarray, width: int, number: int, ids_too: bool) -> tuple[list[pa.Array], int]:
    """Pieces of one run of documents, and how many sequences they fill."""
    column = rows.column(1).fill_null("")
    buf, offs = texts.buffers(column)
    ids = [encode(t) for t in column.to_pylist()]
    n = np.array([len(x) for x in ids])
    plain = np.concatenate(ids) if len(ids) else np.zeros(0, np.uint32)
    doc_end = np.cumsum(n + 1)
    stream = np.full(int(doc_end[-1]), END_ID, np.uint32)
    doc = np.repeat(np.arange(len(n)), n)
    stream[np.arange(len(plain)) + doc] = plain
    # a sentence ends with its stop, before a space or the like, or with its line break
    byte = np.cumsum(size[plain])
    last, after = buf[np.minimum(byte, len(buf)) - 1], np.append(buf, np.uint8(0x20))[byte]
    ends = np.flatnonzero((_STOP[last] & _BREAK[after]) | (last == 0x0A) | _other_stops(buf, byte)) if len(plain) else np.zeros(0, np.int64)
    places = np.unique(np.concatenate([[0], ends + 1 + doc[ends], doc_end]))
    forced = _inside(places, doc_end, width)
    places = np.unique(np.concatenate([places, forced]))
    penalty = np.full(len(places), SENTENCE)
    penalty[np.searchsorted(places, forced)] = FORCED
    penalty[np.searchsorted(places, doc_end)] = 0
    cuts = cuts_of(places, penalty, width)
    bounds = np.unique(np.concatenate([cuts, doc_end]))
    start, stop = np.r_[0, bounds[:-1]][bounds > 0], bounds[bounds > 0]
    of = np.searchsorted(doc_end, start, "right")
    sequence = np.searchsorted(cuts, start, "right") - 1
    little = stream.astype("<u4")
    parts = [little[a:b] for a, b in zip(start.tolist(), stop.tolist())]
    made = [rows.column(0).take(pa.array(of)), pa.array(start - (doc_end - n - 1)[of]), pa.array(stop - start),
            pa.array(np.array([zlib.crc32(p) for p in parts], np.int64)), pa.array((n + 1)[of]),
            pa.array(number + sequence), pa.array(start - cuts[sequence])]
    if ids_too:
        offsets = np.r_[0, np.cumsum(stop - start)].astype(np.int32)
        made.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(stream[start[0]:].astype(np.int32))))
    return made, len(cuts) - 1


def pack(docs: DataFrame, model: str, ranks: str, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
         ids: bool = False) -> DataFrame:
    """Pieces of the documents in sequences of at most ``width`` tokens.

    ``model`` and ``ranks`` are paths, the same on every executor, of a byte-level tokenizer file and
    of its vocabulary as ranks.  Columns: ``doc_id``, ``start`` (the document's tokens before the
    piece), ``length``, ``ids_crc32``, ``doc_tokens`` (its end token included), ``sequence_id``,
    ``offset`` in the sequence, and ``ids`` if asked for.  Order within a sequence is that of the ids.

    Null texts are empty and give their end token alone.  Null ids come first; rows with equal ids
    are ordered by a hash of the text, and repeated rows are packed as often as they stand.  A long
    text is cut over as many sequences as it needs.  Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    parts = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if ids else [])]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, [kind.simpleString(), *["long"] * 6, "array<int>"]))
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = _tokenizer(model, ranks)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in batches:
            for part in texts.chunks(batch, "text", RUN_BYTES):
                made, n = _run(part, encode, size, width, number, ids)
                number += n
                made[0] = made[0].cast(arrow)
                for a in range(0, len(made[0]), 1 << 15):
                    yield pa.RecordBatch.from_arrays([c.slice(a, 1 << 15) for c in made], names)

    return parts.mapInArrow(run, schema)
