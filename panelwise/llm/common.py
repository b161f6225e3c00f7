"""Reading, Arrow batches and text arithmetic shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.session import tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text per Arrow batch; what a task holds follows this and its longest row.
BATCH_BYTES = 4 << 20

_U = np.uint64
_MIX_A, _MIX_B = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the corpus operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it new to ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def filled(array: pa.Array) -> pa.Array:
    """A string array without nulls: null is the empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return array.fill_null("") if array.null_count else array


def pieces(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut so that each part has about ``most`` bytes in ``column``, or one row."""
    sizes = np.diff(offsets_of(filled(batch.column(column)))) if batch.num_rows else np.zeros(0, int)
    part = (np.cumsum(sizes) - sizes) // most
    for start, stop in runs(part):
        yield batch.slice(start, stop - start)


def runs(keys: np.ndarray) -> Iterable[tuple[int, int]]:
    """Start and stop of each run of equal neighbours."""
    if not len(keys):
        return []
    edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return zip([0, *edge.tolist()], [*edge.tolist(), len(keys)])


def offsets_of(array: pa.Array) -> np.ndarray:
    """Byte offsets of the strings within their data, one more than there are strings."""
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    raw = np.frombuffer(array.buffers()[1], kind) if array.buffers()[1] is not None else np.zeros(1, kind)
    return raw[array.offset : array.offset + len(array) + 1].astype(np.int64)


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings in a row, and where each begins and ends in them."""
    at = offsets_of(array) if len(array) else np.zeros(1, np.int64)
    data = array.buffers()[2] if len(array) else None
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """Words of the strings of an array: what stands between white space 0x20 and 0x09-0x0D.

    ``start`` and ``stop`` are byte positions in ``data``; words of string i are
    those numbered first[i] to first[i + 1].
    """

    def __init__(self, array: pa.Array):
        self.data, self.at = bytes_of(array)
        inside = ~_SPACE[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edge = self.at[1:-1]
        edge = edge[(edge > 0) & (edge < len(inside))]
        opens[edge] = inside[edge]
        closes[edge - 1] = inside[edge - 1]
        self.start = np.flatnonzero(opens)
        self.stop = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.at)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Number of the string that each word belongs to."""
        return np.repeat(np.arange(len(self.at) - 1), self.per_text)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial in its bytes, mixed."""
        if not len(self):
            return np.zeros(0, _U)
        size = self.stop - self.start
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        spot = within + np.repeat(self.start, size)
        power = powers(0x9E3779B97F4A7C15 + 2 * seed, int(size.max()))
        terms = (self.data[spot].astype(_U) + _U(seed)) * power[within]
        return mixed(np.add.reduceat(terms, np.cumsum(size) - size) + size.astype(_U) * _U(2 * seed + 1))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), _U(base & (2**64 - 1)))
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each number spread over all 64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _MIX_A
        x = (x ^ (x >> _U(27))) * _MIX_B
        return x ^ (x >> _U(31))


def grams(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; fewer at the end of the array than words."""
    count = max(len(hashes) - size + 1, 0)
    out, factor = np.zeros(count, _U), powers(base, size)
    with np.errstate(over="ignore"):
        for k in range(size):
            out += hashes[k : k + count] * factor[k]
    return mixed(out)
