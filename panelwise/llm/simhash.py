"""SimHash fingerprints and their groups, found in BK-trees.

Fingerprints that differ in at most r of 64 bits agree in one of r + 1 blocks of
bits.  Every different fingerprint goes to r + 1 shards, one per block and the bits
in it; fingerprints that are linked meet in one of them.  Each shard has a BK-tree:
children are keyed by their Hamming distance to the parent, and a search follows
only the edges within the radius of its own distance.  Shards that hold more than
``LARGE`` fingerprints are dealt again by blocks of their other bits, and again until
they are small, so that a crowd of similar texts is cut up instead of searched in one task.

Trees are made where their shard's fingerprints have been shuffled to and are
searched there.  Broadcasting the trees of all shards would send every fingerprint
through the driver, so no tree is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import ascii_lower, fresh, runs, whole
from panelwise.llm.components import components
from panelwise.session import materialize

_U = np.uint64
#: Words in a shingle, bits that linked fingerprints may differ in.
SHINGLE, RADIUS = 3, 2
#: Fingerprints beyond which a shard is dealt again by its other bits.
LARGE = 4096
#: Times that a crowded shard is dealt again; after these, fingerprints of a shard differ in ten bits at most.
DEPTH = 5
#: Shingles whose bits are counted at a time; the arrays over them have 64 numbers each.
DIGESTS_AT_ONCE = 1 << 16
_ASCII_SPACE = "\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words between white space, A-Z lower-cased."""
    plain = F.translate(ascii_lower(whole(text)), _ASCII_SPACE, " " * len(_ASCII_SPACE))
    return F.array_remove(F.split(plain, " "), "")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(key, tag, print): the fingerprint as a signed 64-bit number and a digest of the text.

    A bit is set if it is in more than half of the digests (XXH64, seed 42) of the
    runs of ``size`` words, repeats included; fewer words make one run.  Null and empty texts and texts of white space have 0.
    """
    words = docs.select(
        F.col(f"`{key}`").alias(key), F.xxhash64(whole(F.col(f"`{text}`"))).alias("tag"),
        words_of(F.col(f"`{text}`")).alias("words"),
    )
    last = F.greatest(F.size("words") - size, F.lit(0))
    run = lambda i: F.xxhash64(F.array_join(F.slice(F.col("words"), i + 1, size), " "))
    digests = F.when(F.size("words") > 0, F.transform(F.sequence(F.lit(0), last), run)).otherwise(F.array().cast("array<bigint>"))
    kind = docs.select(F.col(f"`{key}`").alias(key)).schema.add("tag", "long").add("print", "long")

    def majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("digests")
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            flat, prints = lists.flatten().to_numpy().view(_U), np.zeros(len(at) - 1, _U)
            for a, b in runs(at[:-1] // DIGESTS_AT_ONCE):
                prints[a:b] = majority_bits(flat[at[a] : at[b]], at[a : b + 1] - at[a])
            columns = [batch.column(key), batch.column("tag"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "tag", "print"])

    return words.select(key, "tag", digests.alias("digests")).mapInArrow(majority, kind)


def majority_bits(digests: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each group of digests the bits that more than half of them have."""
    out = np.zeros(len(at) - 1, _U)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        bits = np.unpackbits(digests.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts = np.add.reduceat(bits, at[some], axis=0, dtype=np.int32)
        set_bits = counts * 2 > np.diff(at)[some][:, None]
        out[some] = np.packbits(set_bits, axis=1).reshape(-1).view(">u8").astype(_U)
    return out


def blocks(radius: int, bits: list[int]) -> list[int]:
    """Masks of radius + 1 blocks, as even as can be, of the given bit positions."""
    cuts = [len(bits) * k // (radius + 1) for k in range(radius + 2)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Tree:
    """A BK-tree over different fingerprints, held in arrays and grown level by level.

    Node 0 is the root; a node's children have different distances to it.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        n = len(prints)
        self.child: dict[tuple[int, int], int] = {}
        waiting, parent = np.arange(1, n), np.zeros(max(n - 1, 0), np.int64)
        while len(waiting):
            gap = np.bitwise_count(prints[waiting] ^ prints[parent]).astype(np.int64)
            slot = parent * 65 + gap
            _, first, inverse = np.unique(slot, return_index=True, return_inverse=True)
            for i in first.tolist():
                self.child[int(parent[i]), int(gap[i])] = int(waiting[i])
            head = waiting[first]
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, parent = waiting[rest], head[inverse[rest]]
        edges = sorted((p, g, c) for (p, g), c in self.child.items())
        self.parent, self.gap, self.node = (np.array(x, np.int64) for x in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 3
        self.first = np.searchsorted(self.parent, np.arange(n + 1))

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) at most ``radius`` apart, the searches of all queries side by side."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(query):
            gap = np.bitwise_count(queries[query] ^ self.prints[node]).astype(np.int64)
            near = gap <= radius
            yield query[near], node[near]
            count = self.first[node + 1] - self.first[node]
            edge = np.repeat(self.first[node] - np.cumsum(count) + count, count) + np.arange(count.sum())
            follow = np.abs(self.gap[edge] - np.repeat(gap, count)) <= radius
            query, node = np.repeat(query, count)[follow], self.node[edge[follow]]


#: Places of all searches that go side by side in one tree, at most.
_TOGETHER = 1 << 20


def shard_links(prints: np.ndarray, names: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint of a shard that has a link in it, its name and the smallest name it reaches there."""
    order = np.argsort(names)
    prints, names = prints[order], names[order]
    if len(prints) == 2:
        if np.bitwise_count(prints[0] ^ prints[1]) > radius:
            return names[:0], names[:0]
        return names[1:], names[:1]
    tree = Tree(prints)
    root = np.arange(len(prints))
    step = max(1, _TOGETHER // len(prints))
    for start in range(0, len(prints), step):
        for query, node in tree.within(prints[start : start + step], radius):
            _join(root, query + start, node)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return names[moved], names[root[moved]]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a and b; afterwards ``root`` has the smallest member of each set."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def links(prints: DataFrame, radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """(a, b): links between the names of different fingerprints, enough of them to join each group.

    ``prints`` has name and print.  Per shard a fingerprint is linked to the smallest
    name it reaches there, so there is one link per fingerprint and shard at most.
    """
    level = prints.select("name", "print", F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("shard"))
    ready, states = None, [0]
    for depth in range(DEPTH):
        # Bits that the shards so far agree in, and for each such choice the masks of which near ones agree in one.
        masks = {u: blocks(radius, [b for b in range(64) if not u >> b & 1]) for u in states}
        entries = [(F.lit(_signed(u)).cast("long"), F.array(*[F.lit(_signed(m)).cast("long") for m in ms])) for u, ms in masks.items()]
        finer = F.create_map(*[x for entry in entries for x in entry])
        level = level.withColumn("mask", F.explode(finer[F.col("used")]))
        shard = F.xxhash64("shard", "mask", F.col("print").bitwiseAND(F.col("mask")))
        level = level.select("name", "print", F.col("used").bitwiseOR(F.col("mask")).alias("used"), shard.alias("shard"))
        states = sorted({u | m for u, ms in masks.items() for m in ms})
        sizes = level.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = materialize(sizes, "shards")
        last = depth + 1 == DEPTH or min(64 - u.bit_count() for u in states) <= 2 * radius or sizes.filter(F.col("n") > large).isEmpty()
        small = level.join(sizes if last else sizes.filter(F.col("n") <= large), "shard", "left_semi").select("shard", "name", "print")
        ready = small if ready is None else ready.union(small)
        if last:
            break
        level = level.join(sizes.filter(F.col("n") > large), "shard", "left_semi")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # batches of a shard that may go on
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            if not len(shard):
                continue
            cut = int(np.searchsorted(shard, shard[-1]))
            if held and (cut or held[-1].column("shard")[0].as_py() != int(shard[0])):
                yield from found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif cut:
                yield from found(pa.Table.from_batches([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
        if held:
            yield from found(pa.Table.from_batches(held))

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        shard, name = rows["shard"].to_numpy(), rows["name"].to_numpy()
        value = rows["print"].to_numpy().view(_U)
        edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, int)
        a, b = [], []
        for start, stop in zip(edge[:-1], edge[1:]):
            if stop - start > 1:
                own, least = shard_links(value[start:stop], name[start:stop], radius)
                a.append(own)
                b.append(least)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    dealt = ready.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(search, "a long, b long")


_NULL_KEY = (1 << 63) - 1


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """(key, tag, fingerprint, component_id) per row: groups joined by links of ``radius`` or fewer differing bits.

    fingerprint is 16 lowercase hex digits and component_id the smallest key that
    can be reached over any number of links, the row's own included.  Rows with
    equal fingerprints are one node of the search, so copies cost nothing.  A null
    key counts as the largest number.  Repeated rows each give a row.
    """
    prints = materialize(fingerprints(docs, key, text, size).withColumn("node", F.coalesce(key, F.lit(_NULL_KEY))), "prints")
    nodes = materialize(prints.groupBy("print").agg(F.min("node").alias("name")), "nodes")
    edges = links(nodes.select(F.col("print").alias("name"), "print"), radius, large)
    found = components(materialize(edges, "edges"))
    members = nodes.join(found, nodes["print"] == found["node"], "left").select(
        "print", "name", F.coalesce("component", "print").alias("component")
    )
    least = members.groupBy("component").agg(F.min("name").alias("component_id"))
    labels = members.join(least, "component").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return prints.join(labels, "print").select(key, "tag", digits.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One document of each group, the one with the smallest key, as it was; repeated rows of it stay."""
    kept = groups(docs, key, text, **settings).filter(F.coalesce(key, F.lit(_NULL_KEY)) == F.col("component_id"))
    k, t = fresh(docs, "k", "t")
    kept = kept.select(F.col(key).alias(k), F.col("tag").alias(t)).distinct()
    same = F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.xxhash64(whole(F.col(f"`{text}`"))) == F.col(t))
    return docs.join(kept, same, "left_semi")
