"""Byte-level BPE by recursive queries over token positions, one database in memory per task.

A vocabulary file gives ranks; the merge table holds every pair of tokens whose
bytes joined are a token, with that token's rank.  Distinct words of a batch are
laid out as rows (word, position, token).  Each step of the recursive query joins
neighbouring tokens with the merge table, takes each word's smallest rank and
contracts its pairs of that rank from the left; words without a pair are done.

Contracting all pairs of the smallest rank in one step gives what contracting the
leftmost one at a time does, if the bytes of every token merge to that token: a
new token then never makes a pair of a smaller rank.  ``Vocabulary.improper``
lists tokens for which this does not hold; a test finds none in the file used.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelwise.llm.common import filled, pieces, runs

#: Distinct words that a Python worker keeps encoded; beyond it the rarer half goes, but no word of the piece in hand.
KEPT_WORDS = 400_000
#: Bytes of distinct words in one encoding query, tokens in one decoding query.
ENCODE_BYTES, DECODE_TOKENS = 1_000_000, 500_000
#: Longer words may hold long runs of one token, which the second form halves in a step.
SHORT_BYTES = 48

#: state(word, pos, tok, done); of a run of equal tokens the first two are contracted in a step.
_ENCODE = """
WITH RECURSIVE state(word, pos, tok, done) AS (
  SELECT word, pos, tok, false FROM start
  UNION ALL (
    WITH near AS (
      SELECT word, pos, tok, lead(tok) OVER line AS nxt, lag(tok) OVER line AS prev, lag(tok, 2) OVER line AS prev2
      FROM state WHERE NOT done WINDOW line AS (PARTITION BY word ORDER BY pos)
    ), pairs AS (
      SELECT n.*, m.rank, l.rank AS left_rank,
             n.tok <> n.nxt OR n.prev IS DISTINCT FROM n.tok AS free,
             n.prev <> n.tok OR n.prev2 IS DISTINCT FROM n.prev AS left_free
      FROM near n
      LEFT JOIN merges m ON m.pair = (n.tok::BIGINT << 32) + n.nxt
      LEFT JOIN merges l ON l.pair = (n.prev::BIGINT << 32) + n.tok
    ), least AS (SELECT word, min(rank) AS best FROM pairs GROUP BY word)
    SELECT p.word, p.pos, CASE WHEN p.rank = l.best AND p.free THEN l.best ELSE p.tok END, l.best IS NULL
    FROM pairs p JOIN least l USING (word)
    WHERE NOT coalesce(p.left_rank = l.best AND p.left_free, false)
  )
)
SELECT word, tok FROM state WHERE done ORDER BY word, pos
"""

#: The same, but of a run of equal tokens every second pair is contracted in a step.
_ENCODE_LONG = """
WITH RECURSIVE state(word, pos, tok, done) AS (
  SELECT word, pos, tok, false FROM start
  UNION ALL (
    WITH near AS (
      SELECT word, pos, tok, lead(tok) OVER line AS nxt, lag(tok) OVER line AS prev, row_number() OVER line AS n
      FROM state WHERE NOT done WINDOW line AS (PARTITION BY word ORDER BY pos)
    ), parity AS (
      SELECT *, (n - max(CASE WHEN prev IS DISTINCT FROM tok THEN n END) OVER (PARTITION BY word ORDER BY pos)) % 2 AS odd
      FROM near
    ), pairs AS (
      SELECT n.*, m.rank, l.rank AS left_rank, n.tok <> n.nxt OR n.odd = 0 AS free,
             n.prev <> n.tok OR n.odd = 1 AS left_free
      FROM parity n
      LEFT JOIN merges m ON m.pair = (n.tok::BIGINT << 32) + n.nxt
      LEFT JOIN merges l ON l.pair = (n.prev::BIGINT << 32) + n.tok
    ), least AS (SELECT word, min(rank) AS best FROM pairs GROUP BY word)
    SELECT p.word, p.pos, CASE WHEN p.rank = l.best AND p.free THEN l.best ELSE p.tok END, l.best IS NULL
    FROM pairs p JOIN least l USING (word)
    WHERE NOT coalesce(p.left_rank = l.best AND p.left_free, false)
  )
)
SELECT word, tok FROM state WHERE done ORDER BY word, pos
"""

#: Ordered aggregation: the rows reach the aggregate sorted, in a database of one thread.
_DECODE = """
SELECT doc, string_agg(hex, '') AS hex
FROM (SELECT t.doc, v.hex FROM tokens t JOIN vocabulary v USING (tok) ORDER BY t.doc, t.pos)
GROUP BY doc
"""


class Vocabulary:
    """Ranks of a vocabulary file, its merge table, and the words encoded so far."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.database = duckdb.connect(config={"threads": 1, "memory_limit": "256MB"})
        pairs, ranks = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32) + right)
                    ranks.append(rank)
        self._table("merges", {"pair": pa.array(pairs, pa.int64()), "rank": pa.array(ranks, pa.int32())})
        hexes = [token.hex() for token in self.ranks]
        self._table("vocabulary", {"tok": pa.array(self.ranks.values(), pa.int32()), "hex": pa.array(hexes)})
        self.byte_token = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self._forget()

    def _table(self, name: str, columns: dict) -> None:
        self.database.register("given", pa.table(columns))
        self.database.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.database.unregister("given")

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.tokens, self.begin, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.seen = np.zeros(0, np.int64)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Tokens of each word, by the recursive query."""
        sizes = np.array([len(w) for w in words], np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        for sql, chosen in ((_ENCODE, sizes <= SHORT_BYTES), (_ENCODE_LONG, sizes > SHORT_BYTES)):
            picked = np.flatnonzero(chosen & (sizes > 0))
            blocks = np.cumsum(sizes[picked]) // ENCODE_BYTES
            for start, stop in runs(blocks):
                block = picked[start:stop]
                size = sizes[block]
                data = np.frombuffer(b"".join(words[i] for i in block), np.uint8)
                pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
                columns = {"word": np.repeat(np.arange(len(block), dtype=np.int32), size), "pos": pos.astype(np.int32)}
                self.database.register("start", pa.table(columns | {"tok": self.byte_token[data]}))
                found = self.database.sql(sql).to_arrow_table()
                self.database.unregister("start")
                owner, tokens = found["word"].to_numpy(), found["tok"].to_numpy()
                cuts = np.searchsorted(owner, np.arange(1, len(block)))
                for i, ids in zip(block, np.split(tokens, cuts)):
                    out[i] = ids
        return out

    def _learn(self, words: list[str], needed: list[str]) -> None:
        """Encodes new words; if the rarer half of the old ones goes, those in ``needed`` stay."""
        if len(self.number) + len(words) > KEPT_WORDS:
            names = list(self.number)
            first = self.seen.copy()
            first[[self.number[w] for w in needed]] = np.iinfo(np.int64).max
            kept = np.sort(np.argsort(-first, kind="stable")[: max(KEPT_WORDS // 2, len(needed))])
            ids = [self.tokens[self.begin[i] : self.begin[i] + self.size[i]] for i in kept]
            held, counts = [names[i] for i in kept], self.seen[kept]
            self._forget()
            self._add(held, ids)
            self.seen[:] = counts // 2
        self._add(words, self.merge([w.encode() for w in words]))

    def _add(self, words: list[str], ids: list[np.ndarray]) -> None:
        if not words:
            return
        size = np.array([len(x) for x in ids], np.int64)
        self.begin = np.concatenate([self.begin, len(self.tokens) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.tokens = np.concatenate([self.tokens, *ids])
        self.seen = np.concatenate([self.seen, np.zeros(len(words), np.int64)])
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in a row, and where each text's begin, one place more than texts."""
        found = [self.pattern.findall(text) for text in texts]
        words = set(chain.from_iterable(found))
        new = words - self.number.keys()
        if new:
            self._learn(sorted(new), list(words - new))
        counts = np.array([len(x) for x in found], np.int64)
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(found)), np.int64, counts.sum())
        if len(number):
            self.seen += np.bincount(number, minlength=len(self.seen))
        size = self.size[number]
        spot = np.repeat(self.begin[number] - np.cumsum(size) + size, size) + np.arange(size.sum())
        words_at = np.concatenate([[0], np.cumsum(counts)])
        return self.tokens[spot], np.concatenate([[0], np.cumsum(size)])[words_at]

    def decode(self, tokens: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Bytes of each text's tokens; a token that is not in the vocabulary is an error."""
        out = [b""] * (len(at) - 1)
        if len(tokens) and (tokens.min() < 0 or tokens.max() >= len(self.ranks)):
            raise ValueError("a token is not in the vocabulary")
        for first, last in runs(at[1:] // DECODE_TOKENS):
            part = tokens[at[first] : at[last]]
            doc = np.repeat(np.arange(first, last), np.diff(at[first : last + 1]))
            columns = {"doc": doc, "pos": np.arange(len(part)), "tok": part}
            self.database.register("tokens", pa.table(columns))
            for number, digits in self.database.sql(_DECODE).fetchall():
                out[number] = bytes.fromhex(digits)
            self.database.unregister("tokens")
        return out

    def improper(self) -> list[bytes]:
        """Tokens whose bytes do not merge to themselves."""
        words = list(self.ranks)
        return [w for w, ids in zip(words, self.merge(words)) if list(ids) != [self.ranks[w]]]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary, loaded once in each Python worker."""
    return Vocabulary(path, pattern)


def _columns(df: DataFrame, *replaced: str) -> list[str]:
    return [c for c in df.columns if c not in replaced]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the tokens of their whole text in ``ids``; null is the empty text.

    A column named ``ids`` is replaced.  Every row gives one row; no shuffle.  Python
    workers hold the vocabulary, a bounded number of encoded words and one piece
    of a batch.
    """
    kept = _columns(docs, ids)
    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add(ids, T.ArrayType(T.IntegerType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            for part in pieces(batch, text):
                tokens, at = words.encode(filled(part.column(text)).to_pylist())
                column = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), column], names=[*kept, ids])

    return docs.mapInArrow(work, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """The rows with the bytes of their tokens in ``data``, which is binary; null has none."""
    kept = _columns(docs, data)
    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add(data, "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            lists = batch.column(ids)
            sizes = [0 if n is None else n for n in lists.value_lengths().to_pylist()]
            at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            column = pa.array(words.decode(lists.flatten().to_numpy(), at), pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), column], names=[*kept, data])

    return docs.mapInArrow(work, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): each text encoded, its tokens decoded, both digested.

    Digests are lowercase hex, of the tokens as little-endian unsigned 32-bit
    integers and of the decoded bytes.  As ``encode`` for nulls and repeated rows.
    """
    rows = docs.select(f"`{key}`", f"`{text}`")
    schema = docs.select(f"`{key}`").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            for part in pieces(batch, text):
                tokens, at = words.encode(filled(part.column(text)).to_pylist())
                raw = memoryview(tokens.astype("<u4")).cast("B")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(at[:-1], at[1:])], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in words.decode(tokens, at)], pa.string()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(work, schema)
