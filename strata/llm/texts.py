"""Vectorised work on the UTF-8 bytes of Arrow text columns.

Every function takes the bytes of several texts laid end to end (``buf``) and the ``n + 1``
offsets that cut them (``offs``); a null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text worked on at once; bounds the temporary arrays of a task (one text at least).
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offs = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text each."""
    _, offs = buffers(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def map_texts(docs: DataFrame, work: Callable, fields: list[T.StructField], text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and, beside them, what ``work(buf, offs)`` returns as arrays
    for ``fields``.  A kept column with the name of a new field (all in lower case) is replaced by it."""
    new = {f.name for f in fields}
    keep = [c for c in keep if c.lower() not in new]
    own = "_text"
    while own in keep:
        own = f"_{own}"
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    names = [f.name for f in schema]
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, own):
                buf, offs = buffers(part.column(part.schema.get_field_index(own)))
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(work(buf, offs), types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + made, names)

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].cast("string").alias(own)).mapInArrow(tidy(run), schema)


def tidy(run: Callable) -> Callable:
    """``run`` that leaves no tables of powers in a worker which goes on to other tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()

    return tidied


_POWERS: dict[int, list[np.ndarray]] = {}


def powers(n: int) -> list[np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2**64."""
    size = 1 << max(16, int(n).bit_length())
    size = max(size, *_POWERS, 0)
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = [np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (_BASE, _INVERSE)]
    return _POWERS[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Rolling-hash prefix sums: ``span_hash`` of any slice of ``values`` (uint64) costs O(1)."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def byte_hash(buf: np.ndarray) -> np.ndarray:
    return prefix_hash(_BYTE[buf])


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices; equal slices have equal hashes wherever they stand."""
    _, down = powers(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(buf: np.ndarray, offs: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and ``n + 1`` word offsets.  ``between`` says of each byte whether it
    stands between words: by default space, \\t, \\n, \\v, \\f and \\r."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    space = between[buf]
    cuts = offs[:-1][offs[:-1] < len(buf)]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    before[cuts] = True
    after = np.empty_like(space)
    after[-1], after[:-1] = True, space[1:]
    after[cuts[cuts > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def code_points(buf: np.ndarray) -> np.ndarray:
    """Prefix count of code points: one entry for each byte and one more."""
    out = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def owner(offs: np.ndarray) -> np.ndarray:
    """The text that each item between the offsets belongs to."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else values.dtype)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: whether another one equals it, and whether an earlier one does."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    any_, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return any_, earlier
