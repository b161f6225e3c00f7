"""Tokens of two tokenizers over the same bytes, aligned by pointer jumping, and links counted over a corpus.

Two tokens overlap if their byte ranges share a byte.  Every token points to its
farthest-right overlapping token; the token that nothing reaches beyond points to
itself.  Replacing each pointer by its pointer's pointer doubles the distance it
spans, so that after as many rounds as the logarithm of the longest chain every
token points to the last token of its component.  Components are the groups: the
byte ranges between neighbouring places where tokens of both kinds end.

Tasks work on blocks of documents.  A block numbers its distinct pairs of linked
ids, so that documents carry small numbers, and only one row per block and pair
takes part in the counting; the counts come back to the block in the same way.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from panelwise.llm.common import filled, offsets_of, pieces
from panelwise.session import materialize

#: Bytes of text that share one numbering of pairs, and pairs in one row of a block's list.
BLOCK_BYTES, LIST_PAIRS = 48 << 20, 50_000
#: Bytes of text aligned at a time.
PIECE_BYTES = 2 << 20


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write bytes as: visible ones stay, others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """A byte-level BPE (A, given a space and the text) and a piece BPE (B, which adds the space).

    With ``pattern``, the expression that A cuts texts by, A is encoded from its
    vocabulary by ranks, which gives the same ids and takes a third of the time.
    """

    def __init__(self, byte_path: str, piece_path: str, pattern: str | None = None):
        self.byte_level = Tokenizer.from_file(byte_path)
        self.byte_level.encode_special_tokens = True
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = _byte_letters()
        self.by_rank = None
        words = self.byte_level.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(words.values()) + 1)
        for word, number in words.items():
            known = all(c in letters for c in word)
            self.a_bytes[number] = bytes(letters[c] for c in word) if known else word.encode()
        self.b_bytes = [self._piece_bytes(i) for i in range(self.piece.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        if pattern is not None:
            ranks = {self.a_bytes[i]: i for i in self.byte_level.get_vocab(with_added_tokens=False).values()}
            self.by_rank = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _piece_bytes(self, number: int) -> bytes:
        piece = self.piece.id_to_piece(number)
        if self.piece.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A and B tokens of each text; none where either's bytes are not a space and the text."""
        spaced = [" " + x if x else "" for x in texts]
        if self.by_rank is not None:
            a = [self.by_rank.encode_ordinary(x) for x in spaced]
        else:
            a = [found.ids for found in self.byte_level.encode_batch(spaced, add_special_tokens=False)]
        b = self.piece.encode(texts, num_threads=1) if texts else []
        for k, text in enumerate(texts):
            whole = b" " + text.encode() if text else None
            if whole is None or b"".join([self.a_bytes[i] for i in a[k]]) != whole or b"".join([self.b_bytes[i] for i in b[k]]) != whole:
                a[k], b[k] = [], []
        return a, b


@lru_cache(maxsize=2)
def tokenizers_of(byte_path: str, piece_path: str, pattern: str | None = None) -> Tokenizers:
    """Both tokenizers, loaded once in each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(byte_path, piece_path, pattern)


def label_groups(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each A and each B token, from the byte positions where they end.

    Both cover the same bytes from 0 on without gaps.  Groups are numbered in order.
    """
    n_a = len(a_end)
    to_b = np.searchsorted(b_end, a_end)  # the B token that holds an A token's last byte
    to_a = np.searchsorted(a_end, b_end)
    last = a_end[to_a] == b_end if n_a else np.zeros(0, bool)
    itself = n_a + np.arange(len(b_end))
    pointer = np.concatenate([n_a + to_b, np.where(last, itself, to_a)])
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            break
        pointer = further
    number = np.cumsum(last) - 1
    group = number[pointer - n_a]
    return group[:n_a], group[n_a:]


class Aligned:
    """Groups of all texts of a piece; ids of all texts stand in a row."""

    def __init__(self, both: Tokenizers, texts: list[str]):
        a, b = both.encode(texts)
        self.n_a, self.n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        self.a = np.fromiter((i for x in a for i in x), np.int64, self.n_a.sum())
        self.b = np.fromiter((i for x in b for i in x), np.int64, self.n_b.sum())
        self.a_group, self.b_group = label_groups(np.cumsum(both.a_size[self.a]), np.cumsum(both.b_size[self.b]))
        count = int(self.b_group[-1]) + 1 if len(self.b_group) else 0
        self.a_per_group = np.bincount(self.a_group, minlength=count)
        self.b_per_group = np.bincount(self.b_group, minlength=count)
        self.group_text = np.zeros(count, np.int64)
        self.group_text[self.a_group] = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(self.group_text, minlength=len(texts)).astype(np.int64)
        links = self.a_per_group * self.b_per_group
        before = np.concatenate([[0], np.cumsum(links)])
        at = np.concatenate([[0], np.cumsum(self.n_groups)])
        self.n_links = before[at[1:]] - before[at[:-1]]

    def pairs(self, n_b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, code, times): how often each text links each pair, ``code`` being a * n_b_ids + b.

        Ids that a group repeats are counted before they are paired, so a group makes
        no more rows than it has different pairs.
        """
        width = np.int64(1 << 20)
        a_key, a_times = np.unique(self.a_group * width + self.a, return_counts=True)
        b_key, b_times = np.unique(self.b_group * width + self.b, return_counts=True)
        a_group, b_group = a_key // width, b_key // width
        many = np.bincount(b_group, minlength=len(self.group_text))
        first = np.cumsum(many) - many
        per_a = many[a_group] if len(a_group) else np.zeros(0, np.int64)
        left = np.repeat(np.arange(len(a_key)), per_a)
        within = np.arange(per_a.sum()) - np.repeat(np.cumsum(per_a) - per_a, per_a)
        right = first[a_group[left]] + within
        code = (a_key[left] % width) * n_b_ids + b_key[right] % width
        text, times = self.group_text[a_group[left]], a_times[left] * b_times[right]
        order = np.lexsort((code, text))
        text, code, times = text[order], code[order], times[order]
        new = np.ones(len(code), bool)
        new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
        starts = np.flatnonzero(new)
        return text[starts], code[starts], np.add.reduceat(times, starts) if len(starts) else times

    def notation(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all texts in a row, and where each text's begins, one more than texts."""
        n_a, n_b = len(self.a), len(self.b)
        before_a, before_b = np.cumsum(self.a_per_group), np.cumsum(self.b_per_group) - self.b_per_group
        ids, after = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        place_a = np.arange(n_a) + before_b[self.a_group]
        place_b = np.arange(n_b) + before_a[self.b_group]
        ids[place_a], ids[place_b] = self.a, self.b
        ends_a, ends_b = np.cumsum(self.a_per_group) - 1, np.cumsum(self.b_per_group) - 1
        after[place_a[ends_a]], after[place_b[ends_b]] = ord("|"), ord(";")
        per_text = self.n_a + self.n_b
        at = np.concatenate([[0], np.cumsum(per_text)])
        size = 1 + np.searchsorted(10 ** np.arange(1, 10), ids, side="right")
        width = int(size.max()) + 1 if len(size) else 1
        cells = np.zeros((n_a + n_b, width), np.uint8)
        for column in range(width - 1):
            power = 10 ** np.maximum(size - 1 - column, 0)
            cells[:, column] = ord("0") + ids // power % 10
        cells[np.arange(n_a + n_b), size] = after
        keep = np.arange(width) <= size[:, None]
        last = at[1:][per_text > 0] - 1
        keep[last, size[last]] = False
        lengths = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])
        return cells[keep].tobytes(), lengths[at]


def _lists(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def align(docs: DataFrame, byte_path: str, piece_path: str, pattern: str | None = None, text: str = "text") -> DataFrame:
    """The rows with the tokens of both tokenizers and the groups that hold them.

    ``a_ids`` and ``b_ids`` are the tokens, ``a_sizes`` and ``b_sizes`` how many of
    them each group has, in order; columns of these names are replaced.  Null and
    empty texts, and texts whose bytes a tokenizer does not give back, have four empty
    lists.  Every row gives one row, repeated rows included; no shuffle.
    """
    new = ("a_ids", "b_ids", "a_sizes", "b_sizes")
    kept = [c for c in docs.columns if c not in new]
    schema = docs.select(*[f"`{c}`" for c in kept]).schema
    for name in new:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(byte_path, piece_path, pattern)
        for batch in batches:
            for part in pieces(batch, text, PIECE_BYTES):
                found = Aligned(both, filled(part.column(text)).to_pylist())
                counts = (found.n_a, found.n_b, found.n_groups, found.n_groups)
                values = (found.a, found.b, found.a_per_group, found.b_per_group)
                lists = [_lists(v, np.concatenate([[0], np.cumsum(n)]), pa.int32()) for v, n in zip(values, counts)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *lists], names=[*kept, *new])

    return docs.mapInArrow(work, schema)


class _Numbering:
    """Numbers for the pairs of a block, in the order in which they come up."""

    def __init__(self):
        self.sorted, self.number = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.docs = np.zeros(0, np.int64)

    def take(self, codes: np.ndarray) -> np.ndarray:
        """Number of each code; counts each one more document."""
        distinct, place, times = np.unique(codes, return_inverse=True, return_counts=True)
        spot = np.searchsorted(self.sorted, distinct)
        known = np.zeros(len(distinct), bool)
        inside = spot < len(self.sorted)
        known[inside] = self.sorted[spot[inside]] == distinct[inside]
        numbers = np.empty(len(distinct), np.int64)
        numbers[known] = self.number[spot[known]]
        numbers[~known] = len(self.docs) + np.arange((~known).sum())
        self.docs = np.concatenate([self.docs, np.zeros((~known).sum(), np.int64)])
        self.docs[numbers] += times
        self.sorted = np.insert(self.sorted, spot[~known], distinct[~known])
        self.number = np.insert(self.number, spot[~known], numbers[~known])
        return numbers[place]

    def codes(self) -> np.ndarray:
        out = np.empty(len(self.docs), np.int64)
        out[self.number] = self.sorted
        return out


_FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCK = "block long, kind int, pairs array<int>, times array<long>, first int, codes array<long>, docs array<long>"


def _linked(rows: DataFrame, byte_path: str, piece_path: str, pattern: str | None, key: str, text: str) -> DataFrame:
    """One row per text (kind 0) with its pairs' numbers in the block, and the pairs of each block (kind 1)."""
    names = ["block", "kind", "pairs", "times", "first", "codes", "docs"]
    facts = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([T.StructField("key", rows.schema[key].dataType)])
    schema = T.StructType(schema.fields + T.StructType.fromDDL(_FACTS).fields + T.StructType.fromDDL(_BLOCK).fields)

    def listed(block: int, numbers: _Numbering) -> Iterator[pa.RecordBatch]:
        codes = numbers.codes()
        for start in range(0, len(codes), LIST_PAIRS):
            stop = min(start + LIST_PAIRS, len(codes))
            row = {"block": block, "kind": 1, "first": start, "codes": codes[start:stop], "docs": numbers.docs[start:stop]}
            kinds = {"first": pa.int32(), "kind": pa.int32(), "codes": pa.list_(pa.int64()), "docs": pa.list_(pa.int64())}
            columns = [
                pa.array([row[f.name]], kinds.get(f.name, pa.int64())) if f.name in row else pa.nulls(1, to_arrow_type(f.dataType))
                for f in schema
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(byte_path, piece_path, pattern)
        block, used, numbers = TaskContext.get().partitionId() << 32, 0, _Numbering()
        for batch in batches:
            for part in pieces(batch, text, PIECE_BYTES):
                column = filled(part.column(text))
                found = Aligned(both, column.to_pylist())
                owner, codes, times = found.pairs(len(both.b_bytes))
                at = np.searchsorted(owner, np.arange(part.num_rows + 1))
                raw, spots = found.notation()
                view = memoryview(raw)
                digests = [
                    hashlib.sha256(view[x:y]).hexdigest() if y > x else "" for x, y in zip(spots[:-1], spots[1:])
                ]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key),
                        *(pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)),
                        pa.array(digests, pa.string()), pa.array(np.full(n, block)), pa.array(np.zeros(n, np.int32)),
                        _lists(numbers.take(codes), at, pa.int32()), _lists(times, at, pa.int64()),
                        pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names=["key", *facts, *names],
                )
                used += int(offsets_of(column)[-1] - offsets_of(column)[0]) if n else 0
                if used >= BLOCK_BYTES:
                    yield from listed(block, numbers)
                    block, used, numbers = block + 1, 0, _Numbering()
        yield from listed(block, numbers)

    return rows.mapInArrow(work, schema)


def link_counts(
    docs: DataFrame, byte_path: str, piece_path: str, pattern: str | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    The count of a pair of ids is the number of rows that link it.  ``n_best`` are the
    links whose count is the highest that their A id has in the corpus, ``count_sum``
    is the sum of the counts of all links, ``groups_sha256`` digests
    ``a1,a2|b1;a3|b2,b3``.  Null and empty texts, and texts whose bytes a tokenizer
    does not give back, have zeros and an empty string.  Repeated rows and rows with
    a null key each count and each give a row; an empty table gives no rows.

    A text is encoded once.  A block's pairs travel once to be counted and once back;
    an A id has no more pairs than B has ids, so no group grows with the corpus.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    done = materialize(_linked(rows, byte_path, piece_path, pattern, "key", "text"), "linked")
    n_b_ids = len(tokenizers_of(byte_path, piece_path, pattern).b_bytes)
    lists = done.filter("kind = 1").select("block", "first", "docs", F.posexplode("codes").alias("at", "code"))
    asked = lists.select("block", (F.col("first") + F.col("at")).alias("first"), "code", F.get("docs", "at").alias("docs"))
    total = asked.groupBy("code").agg(F.sum("docs").alias("count"))
    total = materialize(total.withColumn("a", F.floor(F.col("code") / n_b_ids)), "pair-counts")
    top = total.groupBy("a").agg(F.max("count").alias("most"))
    marked = total.join(top, "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = asked.join(marked, "code").select("block", "first", "count", "best")
    facts = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    texts = done.filter("kind = 0").select("block", F.lit(1).alias("later"), "key", *facts, "pairs", "times")
    mixed = texts.unionByName(answers.withColumn("later", F.lit(0)), allowMissingColumns=True)
    placed = mixed.repartition("block").sortWithinPartitions("block", "later", "first")
    return placed.mapInArrow(_scored, _result_schema(docs, key)).withColumnRenamed("key", key)


def _result_schema(docs: DataFrame, key: str) -> T.StructType:
    field = T.StructField("key", docs.schema[key].dataType)
    rest = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return T.StructType([field, *T.StructType.fromDDL(rest).fields])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the counts of each text's links; a block's answers come before its texts."""
    block, counts, bests = None, [], []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        later = batch.column("later").to_numpy()
        turn = np.flatnonzero((blocks[1:] != blocks[:-1]) | (later[1:] != later[:-1])) + 1
        for start, stop in zip([0, *turn.tolist()], [*turn.tolist(), batch.num_rows]):
            if start == stop:
                continue
            part = batch.slice(start, stop - start)
            if block != blocks[start]:
                block, counts, bests = blocks[start], [], []
            if later[start] == 0:
                counts.append(part.column("count").to_numpy())
                bests.append(part.column("best").to_numpy(zero_copy_only=False))
                continue
            if len(counts) != 1:
                counts = [np.concatenate(counts) if counts else np.zeros(0, np.int64)]
                bests = [np.concatenate(bests) if bests else np.zeros(0, bool)]
            pairs = part.column("pairs")
            at = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
            number, times = pairs.flatten().to_numpy(), part.column("times").flatten().to_numpy()
            sums = np.concatenate([[0], np.cumsum(times * counts[0][number])])
            best = np.concatenate([[0], np.cumsum(times * bests[0][number])])
            columns = {c: part.column(c) for c in ("key", "n_a", "n_b", "n_groups", "n_links")}
            columns |= {"n_best": pa.array(best[at[1:]] - best[at[:-1]], pa.int64())}
            columns |= {"count_sum": pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"groups_sha256": part.column("groups_sha256")})

