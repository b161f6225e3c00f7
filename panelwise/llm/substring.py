"""Removal of repeated passages: a count-min sketch first, exact grouping of what it leaves.

A window is a number of consecutive words of one document.  Its anchor is the
smallest hash among the shorter grams that start in it, so equal windows have equal
anchors.  The first pass counts anchors in a sketch per task; merged, it never
gives less than the true count, so a window whose anchor it counts once occurs
once.  The second pass groups the other windows exactly, by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Words, filled, fresh, grams, mixed, pieces

_U = np.uint64
_LAST = np.iinfo(np.int64).max
#: Words of the grams whose smallest hash is a window's anchor, as a share of the window.
ANCHOR_SHARE = 0.4
#: Fewest and most cells in each of the sketch's two rows, and bytes of text per cell.  A cell has two bits: seen, and
#: seen again; they make 64 to 128 MB.  Beyond the text they suffice for the sketch rules out less and the exact pass does more.
LEAST_CELLS, CELLS, CELL_BYTES = 1 << 27, 1 << 28, 12
#: Bytes of the sketch that travel as one row.
BLOCK = 1 << 18
_SALTS = (_U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` of each ``width`` neighbours, in steps that double the reach."""
    out, reach = x, 1
    while reach < width:
        step = min(reach, width - reach)
        out = pick(out[:-step], out[step:])
        reach += step
    return out


class Windows:
    """All windows of the words of some texts: where they start and their anchors."""

    def __init__(self, words: Words, size: int):
        self.words, self.size = words, size
        short = max(1, int(size * ANCHOR_SHARE))
        last = np.repeat(words.first[1:], words.per_text)
        self.valid = np.arange(len(words)) + size <= last
        if not self.valid.any():
            self.valid = np.zeros(0, bool)
            self.anchor = self.marks = np.zeros(0, _U)
            return
        gram = grams(words.hashes(), short, 0xD1342543DE82EF95)
        least = _sliding(gram, size - short + 1, np.minimum)
        self.valid = self.valid[: len(least)]
        self.anchor = least
        held = np.where(self.valid, least, _U(0))
        edge = np.zeros(size - short, _U)
        reach = _sliding(np.concatenate([edge, held, edge]), size - short + 1, np.maximum)
        self.marks = gram[reach[: len(gram)] == gram]

    def starts(self, chosen: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.valid & chosen)

    def digests(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the word sequence of each window that begins at ``starts``."""
        out = []
        for seed, base in ((11, 0x2545F4914F6CDD1D), (29, 0x9FB21C651E98DF25)):
            out.append(grams(self.words.hashes(seed), self.size, base)[starts])
        return out[0], out[1]


def _cells(marks: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mixed(marks ^ _SALTS[row]) % _U(cells)


def _count(sketch: np.ndarray, marks: np.ndarray, cells: int) -> None:
    """Add marks to a sketch of two rows of 2-bit cells that stop at 2."""
    for row in range(2):
        cell, times = np.unique(_cells(marks, row, cells), return_counts=True)
        spot, shift = (cell >> _U(2)).astype(np.int64), ((cell & _U(3)) * _U(2)).astype(np.uint8)
        had = (sketch[row, spot] >> shift) & 1
        bits = (np.uint8(1) << shift) | (((had | (times > 1)).astype(np.uint8) << 1) << shift)
        if len(spot):
            begin = np.concatenate([[0], np.flatnonzero(np.diff(spot)) + 1])
            sketch[row, spot[begin]] |= np.bitwise_or.reduceat(bits.astype(np.uint8), begin)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two sketches, or of parts of them."""
    return a | b | (((a & b) & 0x55) << 1)


def _again(sketch: np.ndarray, marks: np.ndarray, cells: int) -> np.ndarray:
    """Which marks the sketch counts more than once."""
    out = np.ones(len(marks), bool)
    for row in range(2):
        cell = _cells(marks, row, cells)
        spot, shift = (cell >> _U(2)).astype(np.int64), ((cell & _U(3)) * _U(2) + _U(1)).astype(np.uint8)
        out &= ((sketch[row, spot] >> shift) & 1).astype(bool)
    return out


def sketch_of(docs: DataFrame, size: int, text: str = "text", cells: int = CELLS) -> Broadcast:
    """The merged sketch of all windows' anchors, broadcast: ``cells`` / 2 bytes, whatever the corpus.

    Tasks send the blocks of their sketch that are not empty; blocks of one number
    are merged as they come in, in memory of the size of the sketch at most.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((2, cells // 4), np.uint8)
        for batch in batches:
            for part in pieces(batch, text):
                _count(sketch, Windows(Words(filled(part.column(text))), size).marks, cells)
        yield from _blocks(sketch.reshape(-1))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                block = np.frombuffer(data.as_buffer(), np.uint8)
                held[number] = _joined(held[number], block) if number in held else block.copy()
        for number, block in held.items():
            yield _block(number, block)

    schema = "block int, data binary"
    parts = docs.select(F.col(f"`{text}`").alias(text)).mapInArrow(build, schema)
    merged = parts.repartition("block").mapInArrow(merge, schema).toArrow()
    sketch = np.zeros(cells // 2, np.uint8)
    for number, data in zip(merged["block"].to_pylist(), merged["data"]):
        block = np.frombuffer(data.as_buffer(), np.uint8)
        sketch[number * BLOCK : number * BLOCK + len(block)] = block
    return docs.sparkSession.sparkContext.broadcast(sketch.reshape(2, -1))


def _blocks(flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(flat), BLOCK):
        if flat[start : start + BLOCK].any():
            yield _block(start // BLOCK, flat[start : start + BLOCK])


def _block(number: int, data: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["block", "data"])


_CANDIDATES = "hi long, lo long, doc long, tag long, pos int, done binary"


def repeated_windows(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """(doc, tag, starts): first words of the windows that also start earlier, 32-bit integers in parts.

    doc is the key (null: the largest number) and tag the text's hash.  Of equal
    windows of one batch all but the first are known at once; the others are dealt
    by digest, so a passage that every document has comes once per batch, and the
    first of each digest in order of (doc, pos) stays.
    """
    sketch = sketch_of(docs, size, text, cells)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(filled(part.column("text")))
                windows = Windows(words, size)
                starts = windows.starts(_again(counts, windows.anchor, cells))
                if not len(starts):
                    continue
                hi, lo = windows.digests(starts)
                owner = words.owner()[starts]
                doc, tag = part.column("doc").to_numpy()[owner], part.column("tag").to_numpy()[owner]
                pos = (starts - words.first[owner]).astype(np.int32)
                order = np.lexsort((tag, pos, doc, lo, hi))
                order = order[_first_of(hi[order], lo[order], doc[order], pos[order], tag[order])]
                h, l, d, p = hi[order], lo[order], doc[order], pos[order]
                new = np.ones(len(order), bool)
                new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
                lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                later = (d != d[lead]) | (p != p[lead])
                stay = np.sort(order[~later])
                yield _rows(*(x[stay] for x in (hi.view(np.int64), lo.view(np.int64), doc, tag, pos)))
                gone = order[later]
                gone = gone[np.lexsort((pos[gone], tag[gone], doc[gone]))]
                change = np.flatnonzero((np.diff(doc[gone]) != 0) | (np.diff(tag[gone]) != 0)) + 1
                for mine in np.split(gone, change) if len(gone) else ():
                    yield _done(int(doc[mine[0]]), int(tag[mine[0]]), pos[mine])

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            known = batch.column("done").is_valid().to_numpy(zero_copy_only=False)
            if known.any():
                ready = batch.filter(pa.array(known))
                yield _starts(ready.column("doc"), ready.column("tag"), ready.column("done"))
                batch = batch.filter(pa.array(~known))
            if not batch.num_rows:
                continue
            hi, lo, doc, tag, pos = (batch.column(c).to_numpy() for c in ("hi", "lo", "doc", "tag", "pos"))
            once = _first_of(hi, lo, doc, pos, tag)
            hi, lo, doc, tag, pos = (x[once] for x in (hi, lo, doc, tag, pos))
            new = np.ones(len(hi), bool)
            new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            carried = last is not None and last[:2] == (hi[0], lo[0])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(hi)), 0))
            first_doc, first_pos = doc[lead], pos[lead]
            if carried:
                stop = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(new)
                first_doc[:stop], first_pos[:stop] = last[2], last[3]
            last = (hi[-1], lo[-1], first_doc[-1], first_pos[-1])
            gone = np.flatnonzero((doc != first_doc) | (pos != first_pos))
            gone = gone[np.lexsort((pos[gone], tag[gone], doc[gone]))]
            d, t = doc[gone], tag[gone]
            if not len(gone):
                continue
            begin = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])]))
            cuts = np.concatenate([begin, [len(gone)]])
            raw = pos[gone].astype("<i4").tobytes()
            data = [raw[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:])]
            yield _starts(pa.array(d[begin]), pa.array(t[begin]), pa.array(data, pa.binary()))

    rows = docs.select(F.coalesce(f"`{key}`", F.lit(_LAST)).alias("doc"), _tag(text).alias("tag"), F.col(f"`{text}`").alias("text"))
    dealt = rows.mapInArrow(candidates, _CANDIDATES).repartition("hi").sortWithinPartitions("hi", "lo", "doc", "pos", "tag")
    return dealt.mapInArrow(firsts, "doc long, tag long, starts binary")


def _first_of(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def sketch_cells(docs: DataFrame, text: str = "text") -> int:
    """Cells for the sketch of these texts: a power of two, one for some bytes of text, within the bounds."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return min(max(1 << int(size // CELL_BYTES).bit_length(), LEAST_CELLS), CELLS)


def _tag(text: str):
    return F.xxhash64(F.coalesce(f"`{text}`", F.lit("")))


def _rows(hi, lo, doc, tag, pos) -> pa.RecordBatch:
    columns = [pa.array(x) for x in (hi, lo, doc, tag)] + [pa.array(pos, pa.int32()), pa.nulls(len(pos), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["hi", "lo", "doc", "tag", "pos", "done"])


def _done(doc: int, tag: int, pos: np.ndarray) -> pa.RecordBatch:
    spread = int(mixed(np.array([tag ^ doc], np.int64).view(_U)).view(np.int64)[0])
    values = [[spread], [spread], [doc], [tag], [int(pos[0])], [pos.astype("<i4").tobytes()]]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["hi", "lo", "doc", "tag", "pos", "done"])


def _starts(doc, tag, starts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc, tag, starts], names=["doc", "tag", "starts"])


def remove_repeats(docs: DataFrame, size: int = 20, key: str = "doc_id", text: str = "text", kept: str = "kept", cells: int | None = None) -> DataFrame:
    """The rows with n_words, n_removed and their kept words, joined by one space, in ``kept``.

    A word goes if a window covers it whose word sequence also starts earlier, in a
    document with a smaller key or before it in the same one, judged on the input.
    Null text has no words; a null key is larger than all others.  Rows with an
    equal key and text are one document: they have equal results and take nothing
    from each other.  Columns of the added names are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", kept)]
    doc, tag, starts = fresh(docs, "doc", "tag", "starts")
    found = repeated_windows(docs, size, key, text, cells or sketch_cells(docs, text))
    # Copies of a row have the same starts in every batch, so each copy carries one list of its own starts.
    found = found.groupBy(F.col("doc").alias(doc), F.col("tag").alias(tag)).agg(F.collect_set("starts").alias(starts))
    left = docs.withColumns({doc: F.coalesce(f"`{key}`", F.lit(_LAST)), tag: _tag(text)})
    joined = left.join(found, [doc, tag], "left").select(*[f"`{c}`" for c in dict.fromkeys([*names, text])], starts)
    schema = joined.select(*[f"`{c}`" for c in names]).schema.add("n_words", "long").add("n_removed", "long").add(kept, "string")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                cut_texts = _cut(part, text, starts, size)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *cut_texts], names=schema.names)

    return joined.mapInArrow(cut, schema)


def _cut(part: pa.RecordBatch, text: str, starts: str, size: int) -> list[pa.Array]:
    words = Words(filled(part.column(text)))
    change = np.zeros(len(words) + 1, np.int64)
    for i, lists in enumerate(part.column(starts)):
        for raw in lists.values or () if lists.is_valid else ():
            begin = words.first[i] + np.frombuffer(raw.as_buffer(), "<i4")
            np.add.at(change, begin, 1)
            np.add.at(change, begin + size, -1)
    gone = np.cumsum(change)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(gone)])
    removed = np.diff(before[words.first])
    keep = np.flatnonzero(~gone)
    length = words.stop[keep] - words.start[keep] + 1
    spot = np.repeat(words.start[keep] - np.cumsum(length) + length, length) + np.arange(length.sum())
    data = np.append(words.data, np.uint8(32))[np.minimum(spot, len(words.data))]
    data[np.cumsum(length) - 1] = 32
    ends = np.concatenate([[0], np.cumsum(length)])
    at = ends[np.searchsorted(keep, words.first)]
    raw = data.tobytes()
    texts = [raw[a : max(a, b - 1)].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return [pa.array(words.per_text, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]
