"""Quality classifier from weak labels: labellers, their error rates by EM, a hashed linear scorer.

Each labeller raises an alarm or is silent.  How often each does so for good and
for bad documents is estimated by expectation-maximisation over the counts of
alarm patterns, of which there are 2 to the number of labellers at most, whatever
the corpus.  The posteriors label a sample on which a linear scorer over hashed
features is fitted; the scorer alone judges every document.

Quality is form: odd characters, shouting, tables, repetition.  What a text says is
another question, so well-formed toxic prose is of good quality here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Words, filled, mixed, pieces

_U = np.uint64
#: Different documents the scorer is fitted on, about, drawn by a digest of key and text; and the most features that one
#: of them may have, which bounds what the driver holds.
SAMPLE, MOST_FEATURES = 6_000, 4_096
#: Bytes of text measured at a time; the arrays over them are some fifty times as large.
PIECE_BYTES = 1 << 20
#: Weights of the scorer.
FEATURES = 1 << 16
#: A labeller is taken to raise a false alarm for this share of the good documents at most.
MOST_FALSE = 0.002
ROUNDS, STEP, SHRINK = 400, 0.5, 1e-5

_UPPER, _LETTER, _ODD = (np.zeros(256, bool) for _ in range(3))
_UPPER[range(0x41, 0x5B)] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_ODD[[ord(c) for c in "#$%&*+<=>@[\\]^_`{|}~"]] = True

#: Labellers: name, statistic, bounds of the alarm, and words that a text needs for it.
LABELLERS = (
    ("odd characters", "odd", 0.02, np.inf, 1),
    ("shouting", "upper", 0.4, np.inf, 5),
    ("exclamations", "exclaim", 0.3, np.inf, 5),
    ("table rows", "bars", 0.15, np.inf, 5),
    ("repeated words", "repeats", 0.2, np.inf, 5),
    ("few different words", "distinct", 0.0, 0.3, 100),
)


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], Words, np.ndarray]:
    """Measures of each text, its words and their hashes."""
    words = Words(texts)
    hashes = words.hashes(3)
    data, at, count = words.data, words.at, np.maximum(words.per_text, 1)

    def total(mask: np.ndarray, edges: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(mask)])
        return run[edges[1:]] - run[edges[:-1]]

    owner = words.owner()
    again = np.zeros(len(words), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    single = (words.stop - words.start == 1) & (data[words.start] == ord("|")) if len(words) else again
    different = _different(owner, hashes)
    letters = np.maximum(total(_LETTER[data], at), 1)
    stats = {
        "odd": total(_ODD[data], at) / np.maximum(np.diff(at), 1),
        "upper": total(_UPPER[data], at) / letters,
        "exclaim": total(data == ord("!"), at) / count,
        "bars": total(single, words.first) / count,
        "repeats": total(again, words.first) / count,
        "distinct": np.bincount(different, minlength=len(at) - 1) / count,
        "words": words.per_text.astype(float),
    }
    return stats, words, hashes


def _different(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The owner of each different word of each text, once per word."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return o[new]


def alarms(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Bit i of each number: whether labeller i raises an alarm."""
    out = np.zeros(len(stats["words"]), np.int32)
    for i, (_, name, low, high, least) in enumerate(LABELLERS):
        value = stats[name]
        out |= ((value >= low) & (value <= high) & (stats["words"] >= least)).astype(np.int32) << i
    return out


@dataclass
class LabelModel:
    """Share of bad documents and, per labeller, alarms among bad and among good ones."""

    bad: float
    hit: np.ndarray
    false: np.ndarray

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """Probability that documents with these alarms are bad."""
        votes = (pattern[:, None] >> np.arange(len(self.hit))) & 1
        score = np.log(self.bad) - np.log1p(-self.bad)
        ratio = votes * np.log(self.hit / self.false) + (1 - votes) * np.log((1 - self.hit) / (1 - self.false))
        return 1 / (1 + np.exp(-np.clip(score + ratio.sum(axis=1), -500, 500)))


def fit_label_model(pattern: np.ndarray, count: np.ndarray, rounds: int = 200, most_false: float = MOST_FALSE) -> LabelModel:
    """EM over patterns and their counts, from the guess that an alarm is right more often than not.

    Bad documents are of many kinds, each with an alarm or two of its own; the bound
    on false alarms keeps a kind that one labeller alone sees from counting as good.
    """
    votes = (pattern[:, None] >> np.arange(len(LABELLERS))) & 1
    bad = np.where(pattern > 0, 0.95, 0.05)
    tiny = 1e-4
    for _ in range(rounds):
        in_bad, in_good = bad * count, (1 - bad) * count
        model = LabelModel(
            float(np.clip(in_bad.sum() / count.sum(), tiny, 1 - tiny)),
            np.clip(in_bad @ votes / max(in_bad.sum(), tiny), tiny, 1 - tiny),
            np.clip(in_good @ votes / max(in_good.sum(), tiny), tiny, most_false),
        )
        new = model.posterior(pattern)
        done = np.abs(new - bad).max() < 1e-9
        bad = new
        if done:
            break
    return model


def features(stats: dict[str, np.ndarray], words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, feature and value: a feature for the size of each measure, and the words' shares."""
    n = len(stats["words"])
    number, spot, value = [], [], []
    for i, (name, x) in enumerate(stats.items()):
        level = np.minimum(np.floor(np.log2(1 + (x if name == "words" else x * 64))), 15).astype(np.int64)
        number.append(np.arange(n))
        spot.append((mixed((level + 1000 * (i + 1)).astype(_U)) % _U(FEATURES)).astype(np.int64))
        value.append(np.ones(n))
    owner = words.owner()
    number.append(owner)
    spot.append((hashes % _U(FEATURES)).astype(np.int64))
    value.append(1 / words.per_text[owner])
    return np.concatenate(number), np.concatenate(spot), np.concatenate(value)


def _margin(weights: np.ndarray, number, spot, value, n: int) -> np.ndarray:
    return np.bincount(number, weights[spot] * value, n) + weights[-1]


def fit_scorer(number, spot, value, bad: np.ndarray) -> np.ndarray:
    """Weights, and the constant as the last, of a logistic regression on soft labels."""
    weights, speed = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    norm = np.sqrt(np.bincount(spot, value**2, FEATURES) / max(len(bad), 1)) + 1e-3
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-_margin(weights, number, spot, value, len(bad)))) - bad
        slope = np.bincount(spot, error[number] * value, FEATURES) / len(bad)
        speed = 0.9 * speed - STEP * np.append(slope / norm + SHRINK * weights[:-1], error.mean())
        weights = weights + speed
    return weights


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray


def _parts(batches: Iterator[pa.RecordBatch], text: str):
    for batch in batches:
        for part in pieces(batch, text, PIECE_BYTES):
            yield part, *statistics(filled(part.column(text)))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> QualityModel:
    """Label model from the alarms of all documents, scorer from about ``sample`` of them.

    The sample is drawn by a digest of key and text among different rows, so it is the
    same for any partitioning and a row that is there many times counts once; rows with
    more than ``MOST_FEATURES`` features are not in it.  The driver gets the features of the
    sample and one count per alarm pattern.  Without documents the scorer finds everything good.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << len(LABELLERS), np.int64)
        for _, stats, _, _ in _parts(batches, "text"):
            total += np.bincount(alarms(stats), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["pattern", "n"])

    counts = rows.mapInArrow(patterns, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    pattern, count = counts["pattern"].to_numpy(), counts["n"].to_numpy()
    if not len(pattern):
        flat = np.full(len(LABELLERS), 0.5)
        return QualityModel(LabelModel(0.5, flat, flat), np.append(np.zeros(FEATURES), -1.0))
    labels = fit_label_model(pattern, count)

    marked = rows.withColumn("digest", F.xxhash64("key", "text", F.lit("sample")))
    different = marked.agg(F.approx_count_distinct("digest", 0.02)).first()[0]
    share = min(1.0, sample / max(different, 1))
    digest = F.pmod("digest", F.lit(1 << 30))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, stats, words, hashes in _parts(batches, "text"):
            number, spot, value = features(stats, words, hashes)
            cell, inverse = np.unique(number * FEATURES + spot, return_inverse=True)
            summed = np.bincount(inverse, value, len(cell)).astype(np.float32)
            cuts = np.searchsorted(cell, np.arange(len(stats["words"]) + 1) * FEATURES).astype(np.int32)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(labels.posterior(alarms(stats))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array((cell % FEATURES).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(summed)),
                ],
                names=["bad", "spot", "value"],
            )
            yield batch.filter(pa.array(np.diff(cuts) <= MOST_FEATURES))

    few = marked.filter(digest < F.lit(int(share * (1 << 30)))).dropDuplicates(["digest"])
    drawn = few.select("key", "text").mapInArrow(learn, "bad double, spot array<int>, value array<float>")
    found = drawn.toArrow().sort_by("bad").combine_chunks()
    if not found.num_rows:
        return QualityModel(labels, np.append(np.zeros(FEATURES), -1.0))
    spot, value = found["spot"].combine_chunks(), found["value"].combine_chunks()
    number = np.repeat(np.arange(found.num_rows), spot.value_lengths().to_numpy())
    weights = fit_scorer(number, spot.flatten().to_numpy(), value.flatten().to_numpy().astype(float), found["bad"].to_numpy())
    return QualityModel(labels, weights)


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep_only: bool = False) -> DataFrame:
    """The rows with quality (0 to 1), keep, alarms and weak_label; with ``keep_only`` just the kept rows, as they were.

    A document is kept if its quality is a half or more.  Null and empty texts have no
    words and raise no alarm; every row is judged by itself, repeated rows alike.
    Columns of the added names are replaced.  No shuffle.
    """
    added = () if keep_only else ("quality", "keep", "alarms", "weak_label")
    names = [c for c in docs.columns if c not in added]
    schema = docs.select(*[f"`{c}`" for c in names]).schema
    if not keep_only:
        schema = schema.add("quality", "double").add("keep", "boolean").add("alarms", "integer").add("weak_label", "double")
    labels, weights = model.labels, model.weights

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, stats, words, hashes in _parts(batches, text):
            good = 1 / (1 + np.exp(np.clip(_margin(weights, *features(stats, words, hashes), part.num_rows), -500, 500)))
            columns = [part.column(c) for c in names]
            if keep_only:
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(good >= 0.5))
                continue
            pattern = alarms(stats)
            found = [pa.array(good), pa.array(good >= 0.5), pa.array(pattern), pa.array(1 - labels.posterior(pattern))]
            yield pa.RecordBatch.from_arrays([*columns, *found], names=schema.names)

    return docs.mapInArrow(judge, schema)
