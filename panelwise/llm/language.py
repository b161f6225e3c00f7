"""Languages told by cross-parsing: how few phrases of a language's text a document can be cut into.

Each language has the suffix automaton of a bounded sample of its labelled text.  A
document is read through it from the left; a phrase is the longest stretch that occurs
somewhere in the sample, and the next begins where no longer match was found.  Phrases
times the bits that name a place in the sample, per byte of the document, estimate the
cross-entropy; the language with the least wins.

Case, digits, signs and the width of white space do not count.  Texts are read in blocks
of a fixed number of bytes, a phrase ending with its block, so that a task reads thousands
of blocks side by side in numpy and long texts are spread like short ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.llm.common import bytes_of, filled, fresh, pieces, whole

#: Bounds of the labelled sample: rows of a language, letters of a row, languages (those with most rows).
SAMPLE_ROWS, SAMPLE_CHARS, LANGUAGES = 240, 250, 32
#: Bytes of all samples together; with many languages each has fewer.
SAMPLE_BYTES = 400_000
BLOCK = 1_024
UNKNOWN = "und"

_LETTER, _NO_LETTERS = r"\p{L}", r"[^\p{L}\p{M}]+"


def plain(texts: pa.Array) -> pa.Array:
    """Lower-case letters, one space for all that stands between them, and one at both ends."""
    lower = pc.utf8_lower(pc.cast(texts, pa.large_string()))
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    lower = pc.binary_join_element_wise(space, lower, space, nothing)
    return pc.replace_substring_regex(lower, _NO_LETTERS, " ")


class Automaton:
    """Suffix automaton of a text as one table, and the phrases of other texts in it.

    A row of the table holds, for each byte of the text, where the next state's row
    begins; zero is no state.  The first row is a state that nothing follows, the
    second the start.
    """

    def __init__(self, text: bytes):
        follow, link, length, last = [{}], [-1], [0], 0
        for byte in text:
            new = len(follow)
            follow.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and byte not in follow[at]:
                follow[at][byte] = new
                at = link[at]
            if at >= 0:
                other = follow[at][byte]
                if length[at] + 1 == length[other]:
                    link[new] = other
                else:
                    copy = len(follow)
                    follow.append(dict(follow[other]))
                    link.append(link[other])
                    length.append(length[at] + 1)
                    while at >= 0 and follow[at].get(byte) == other:
                        follow[at][byte] = copy
                        at = link[at]
                    link[other] = link[new] = copy
            last = new
        known = sorted(set(text))
        self.code = np.zeros(256, np.int32)
        self.code[known] = np.arange(1, len(known) + 1)
        width = len(known) + 1
        table = np.zeros((len(follow) + 1, width), np.int32)
        sizes = [len(f) for f in follow]
        state = np.repeat(np.arange(len(follow)), sizes)
        bytes_ = np.fromiter((b for f in follow for b in f), np.int64, len(state))
        table[state + 1, self.code[bytes_]] = (np.fromiter((s for f in follow for s in f.values()), np.int64, len(state)) + 1) * width
        self.table, self.start = table.ravel(), table[1].copy()
        self.bits = math.log2(max(len(text), 2))

    def phrases(self, columns: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """Phrases of each block; row t of ``columns`` is byte t of the blocks, of which the first alive[t] are that long."""
        count = np.zeros(columns.shape[1], np.int64)
        state = np.zeros(columns.shape[1], np.int32)
        for row, n in zip(columns, alive):
            code = self.code[row[:n]]
            after = self.table[state[:n] + code]
            fails = after == 0
            count[:n] += fails
            state[:n] = np.where(fails, self.start[code], after)
        return count


class Languages:
    """Names and sample texts; workers make the automata from them once."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]):
        self.samples = samples

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.samples]


@lru_cache(maxsize=4)
def _automata(samples: tuple[tuple[str, bytes], ...]) -> tuple[Automaton, ...]:
    return tuple(Automaton(text) for _, text in samples)


def blocks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, alive, owner): bytes of all blocks side by side, the longest first, and the text of each."""
    data, at = bytes_of(texts)
    per_text = -(-np.diff(at) // BLOCK)
    owner = np.repeat(np.arange(len(texts)), per_text)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = at[owner] + within * BLOCK
    size = np.minimum(at[owner + 1] - begin, BLOCK)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    longest = int(size[0]) if len(size) else 0
    spots = np.minimum(begin[None, :] + np.arange(longest)[:, None], max(len(data) - 1, 0))
    alive = np.searchsorted(-size, -np.arange(longest), side="left")
    return data[spots] if longest else np.zeros((0, len(size)), np.uint8), alive, owner


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 2 when divided by 4; a null key does not."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
    """Samples of the languages named in ``lang``, from rows that have it and a letter in their text.

    Rows are drawn by a digest of their text among different texts, so repeated rows
    count once; of each, ``SAMPLE_CHARS`` letters at a place that the digest gives.  At
    most ``SAMPLE_ROWS`` rows of each of ``LANGUAGES`` languages reach the driver.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(_LETTER)).withColumn("digest", F.xxhash64("text"))
    count = rows.groupBy("lang").agg(F.approx_count_distinct("digest", 0.02).alias("texts"))
    many = count.orderBy(F.desc("texts"), "lang").limit(LANGUAGES).collect()
    if not many:
        return Languages(())
    share = F.lit(2.0)
    for row in many:
        share = F.when(F.col("lang") == row.lang, F.lit(4.0 * SAMPLE_ROWS / row.texts)).otherwise(share)
    names = [row.lang for row in many]
    drawn = rows.filter(F.col("lang").isin(names) & (F.pmod("digest", F.lit(1 << 30)) < share * (1 << 30)))
    place = F.pmod(F.xxhash64("digest"), F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(1)))
    drawn = drawn.select("lang", "digest", F.substring("text", place.cast("int") + 1, F.lit(SAMPLE_CHARS)).alias("part"))
    different = drawn.groupBy("lang", "digest").agg(F.min("part").alias("part"))
    first = Window.partitionBy("lang").orderBy("digest")
    sample = different.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= SAMPLE_ROWS)
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "nth").collect():
        texts.setdefault(row.lang, []).append(row.part)
    most = SAMPLE_BYTES // len(names)
    joined = {n: plain(pa.array([" ".join(texts[n])]))[0].as_py().encode()[:most] for n in names if n in texts}
    return Languages(tuple((n, x) for n, x in joined.items()))


def predict(docs: DataFrame, languages: Languages, text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with the language of their whole text and how clear it is, from 0 to 1.

    ``score`` is the share of phrases that the language saves against the next one.
    Texts that are null or have no letter, and all texts where no language was
    learned, are ``und`` with 0.  Of equal languages the one with more labelled
    texts wins.  Columns of the two names are replaced; every row gives one row.
    """
    kept = [c for c in docs.columns if c not in (name, score)]
    (has,) = fresh(docs, "has_letter")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(has, whole(F.col(f"`{text}`")).rlike(_LETTER))
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())])
    samples = languages.samples
    names = np.array([*languages.names, UNKNOWN], dtype=object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(samples)
        for batch in batches:
            for part in pieces(batch, text):
                best, clear = judge(automata, filled(part.column(text)))
                letters = part.column(has).to_numpy(zero_copy_only=False)
                best = np.where(letters, best, len(automata))
                columns = [pa.array(names[best], pa.string()), pa.array(np.where(letters, clear, 0.0), pa.float64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *columns], names=schema.names)

    return rows.mapInArrow(work, schema)


def judge(automata: tuple[Automaton, ...], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of each text's best language, and the share of normalised phrases it saves."""
    n = len(texts)
    if not automata or not n:
        return np.full(n, len(automata)), np.zeros(n)
    ready = plain(texts)
    columns, alive, owner = blocks_of(ready)
    size = np.maximum(np.diff(bytes_of(ready)[1]), 1)
    costs = np.stack([np.bincount(owner, a.phrases(columns, alive), n) * a.bits / size for a in automata])
    best = costs.argmin(axis=0)
    ranked = np.sort(costs, axis=0)
    second = ranked[1] if len(automata) > 1 else np.full(n, automata[0].bits)
    return best, np.clip(1 - ranked[0] / np.maximum(second, 1e-12), 0, 1)
