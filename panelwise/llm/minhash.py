"""MinHash fingerprints of texts, their likeness, and near-duplicates by signature bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Words, filled, grams, mixed, pieces
from panelwise.session import materialize

_U = np.uint64
_LAST = np.iinfo(np.int64).max
#: Words in a shingle, permutations in a fingerprint, least Jaccard similarity of near-duplicates.
SHINGLE, PERMUTATIONS, SIMILAR = 5, 128, 0.8
#: Permutations in a band: 32 bands of 4 miss a pair of similarity 0.8 with probability 5e-8.
BAND = 4
#: What a fingerprint holds where there are no shingles.
_NONE = np.uint32(0xFFFFFFFF)


def permutations(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of a universal family: the upper half of (a * x + b) mod 2^64, a odd."""
    draw = np.random.default_rng(seed)
    return draw.integers(1, 2**63, count, dtype=_U) * _U(2) + _U(1), draw.integers(0, 2**63, count, dtype=_U)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text, and where each text's begin.

    A text of fewer words, but not none, has one shingle, of all of them.
    """
    counts = words.per_text
    hashes = words.hashes()
    full = grams(hashes, size, 0xD1342543DE82EF95)
    inside = np.arange(len(full)) + size <= np.repeat(words.first[1:], counts)[: len(full)]
    short = np.flatnonzero((counts > 0) & (counts < size))
    rows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(rows)])
    out = np.zeros(at[-1], _U)
    own = np.ones(at[-1], bool)
    own[at[short]] = False
    out[own] = full[inside]
    for i in short:
        few = np.append(hashes[words.first[i] : words.first[i + 1]], _U(counts[i]))
        out[at[i]] = grams(few, len(few), 0xD1342543DE82EF95)[0]
    return out, at


def signatures(hashes: np.ndarray, at: np.ndarray, count: int = PERMUTATIONS) -> np.ndarray:
    """The smallest permuted hash of each text's shingles, for every permutation: texts x count."""
    out = np.full((len(at) - 1, count), _NONE, np.uint32)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        begin = at[some]
        with np.errstate(over="ignore"):
            for k, (a, b) in enumerate(zip(*permutations(count))):
                out[some, k] = np.minimum.reduceat(((hashes * a + b) >> _U(32)).astype(np.uint32), begin)
    return out


def fingerprints(texts: pa.Array, size: int = SHINGLE, count: int = PERMUTATIONS) -> np.ndarray:
    return signatures(*shingles(Words(texts), size), count)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places, the estimate of the Jaccard similarity."""
    return (a == b).mean(axis=1) if len(a) else np.zeros(0)


def hexes(signature: np.ndarray) -> list[str]:
    wide, raw = signature.shape[1] * 4, signature.astype(">u4").tobytes()
    return [raw[i : i + wide].hex() for i in range(0, len(raw), wide)]


def compare_with_edit(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, count: int = PERMUTATIONS) -> DataFrame:
    """Each text's fingerprint beside those of the next text and of an edited one.

    The edited text has its last half, rounded down, in code points replaced by as
    many of the first ones of the next text, or all it has; next goes by ascending
    key and text, a null key being the largest, and from the last row to the first.
    Null is the empty text.  Texts are dealt once, by ranges of the key whose lower
    ends are keys of the table; a row on such an end also goes to the range below,
    where it only serves as the next one.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = F.coalesce(F.col(f"`{key}`"), F.lit(_LAST))
    shares = F.array(*[F.lit(i / parts) for i in range(parts)]) if parts > 1 else F.array(F.lit(0.0))
    found = docs.select(order.alias("o")).agg(F.min("o").alias("low"), F.percentile_approx("o", shares, 100_000).alias("ends")).first()
    ends = np.unique([found.low, *(found.ends or [])]).astype(np.int64) if found.low is not None else np.zeros(1, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o = batch.column("o").to_numpy()
            part = np.searchsorted(ends, o, "right") - 1
            edge = np.flatnonzero(ends[part] == o)
            below = (part[edge] - 1) % len(ends)
            turn = np.concatenate([np.zeros(len(o), np.int32), np.where(part[edge] == 0, 2, 1)]).astype(np.int32)
            rows = batch.take(pa.array(np.concatenate([np.arange(len(o)), edge])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([part, below]).astype(np.int32)), pa.array(turn), *rows.columns],
                names=["part", "turn", *rows.schema.names],
            )

    rows = docs.select(order.alias("o"), F.col(f"`{key}`").alias("key"), F.coalesce(f"`{text}`", F.lit("")).alias("text"))
    dealt = rows.mapInArrow(deal, "part int, turn int, o long, key long, text string")
    sorted_rows = dealt.repartitionById(len(ends), F.col("part")).sortWithinPartitions("turn", "o", "text")
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            for part in pieces(batch, "text"):
                both = part if held is None else pa.concat_batches([held, part])
                if both.num_rows > 1:
                    yield from compared(both)
                held = both.slice(both.num_rows - 1)

    def compared(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = np.flatnonzero(rows.column("turn").to_numpy()[:-1] == 0)
        if not len(own):
            return
        texts = rows.column("text").to_pylist()
        sizes = np.array([len(texts[i]) for i in own])
        edited = pa.array([texts[i][: n - n // 2] + texts[i + 1][: n // 2] for i, n in zip(own, sizes)], pa.string())
        prints, new = fingerprints(rows.column("text"), size, count), fingerprints(edited, size, count)
        columns = [
            rows.column("key").take(pa.array(own)), pa.array(sizes, pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited.to_pylist()], pa.string()),
            pa.array(hexes(prints[own]), pa.string()), pa.array(hexes(new), pa.string()),
            pa.array(likeness(prints[own], new)), pa.array(likeness(prints[own], prints[own + 1])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_rows.mapInArrow(compare, schema)


def near_search(
    docs: DataFrame, is_query: str = "key % 20 = 0", key: str = "doc_id", text: str = "text", size: int = SHINGLE,
    count: int = PERMUTATIONS, band: int = BAND, similar: float = SIMILAR,
) -> DataFrame:
    """(query, match, jaccard): the different texts whose shingle sets are ``similar`` to a query's.

    Rows stand for texts: query is the smallest key of those that fulfil ``is_query``
    and have the text, match the smallest key of another text.  Signatures are cut
    into bands; texts that share a band are candidates, whose Jaccard similarity is
    then computed from all shingles.  Empty texts and null keys match nothing.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(f"`{text}`", F.lit("")).alias("text")).filter("key IS NOT NULL")
    digest = F.sha2("text", 256)
    known = rows.withColumn("digest", digest)
    asked = F.min(F.when(F.expr(is_query), F.col("key")))
    reps = known.groupBy("digest").agg(F.min("key").alias("key"), asked.alias("query"))
    texts = known.join(reps, ["digest", "key"]).dropDuplicates(["digest"]).select("key", "query", "text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                hashes, at = shingles(Words(filled(part.column("text"))), size)
                signature = signatures(hashes, at, count).astype(_U)
                bands = grams_of(signature, band)
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("query"), pa.array(bands.view(np.int64).tolist(), pa.list_(pa.int64())),
                     pa.array(sets, pa.list_(pa.int64()))],
                    names=["key", "query", "bands", "set"],
                )

    signed = texts.mapInArrow(sign, "key long, query long, bands array<long>, `set` array<long>").filter("size(`set`) > 0")
    signed = materialize(signed, "signatures")
    spots = signed.select("key", "query", F.explode("bands").alias("spot"))
    left = spots.filter("query IS NOT NULL").select(F.col("key").alias("a"), "query", "spot")
    pairs = left.join(spots.select(F.col("key").alias("match"), "spot"), "spot").filter("a <> match").select("a", "query", "match").distinct()
    sets = signed.select("key", F.col("set").alias("x"))
    both = pairs.join(sets.withColumnRenamed("key", "a"), "a").join(sets.select(F.col("key").alias("match"), F.col("x").alias("y")), "match")
    common = F.size(F.array_intersect("x", "y"))
    jaccard = common / (F.size("x") + F.size("y") - common)
    return both.select("query", "match", jaccard.alias("jaccard")).filter(F.col("jaccard") >= similar)


def members(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, representative): the smallest key with the same text; null keys are left out."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.sha2(F.coalesce(f"`{text}`", F.lit("")), 256).alias("digest")).filter("key IS NOT NULL")
    first = rows.groupBy("digest").agg(F.min("key").alias("representative"))
    return rows.join(first, "digest").select(F.col("key").alias(key), "representative")


def grams_of(signature: np.ndarray, band: int) -> np.ndarray:
    """One digest per band and text, different for different bands."""
    rows, wide = signature.shape[0], signature.shape[1] // band
    out = np.zeros((rows, wide), _U)
    with np.errstate(over="ignore"):
        for k in range(band):
            out = mixed(out + signature[:, k : wide * band : band] + _U(k))
        return mixed(out + np.arange(wide, dtype=_U) * _U(0x9E3779B97F4A7C15))
