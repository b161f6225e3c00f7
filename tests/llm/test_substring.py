from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from panelwise.llm import substring
from panelwise.llm.common import Words

LAST = (1 << 63) - 1


def brute(rows, size):
    """Result of each row; rows with equal key and text are one document."""
    seen, out = {}, {}
    for key, text in sorted({(LAST if k is None else k, x or "") for k, x in rows}):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        for i in range(len(words) - size + 1):
            seen.setdefault(tuple(words[i : i + size]), (key, i))
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if seen[tuple(words[i : i + size])] < (LAST if key is None else key, i):
                gone[i : i + size] = [True] * size
        out[key, text] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("cells", [1 << 10, 1 << 20])
def test_odd_rows(spark, many_partitions, odd, odd_rows, cells):
    want = brute(odd_rows, 20)
    got = substring.remove_repeats(odd.repartition(5), 20, cells=cells).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id, r.text]


def test_random_texts_of_few_words(spark, many_partitions, frame):
    draw = np.random.default_rng(3)
    rows = [(int(i), " ".join(draw.choice(list("abc"), draw.integers(0, 60)))) for i in range(60)]
    want = brute(rows, 4)
    for r in substring.remove_repeats(frame(rows).repartition(6), 4, cells=1 << 12).collect():
        assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id, r.text]


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, 20)
    text = dict(rows)
    got = entry.queries()["op6_substring_dedup"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        n, gone, kept = want[r.doc_id, text[r.doc_id]]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


def test_sketch_never_counts_less():
    draw = np.random.default_rng(1)
    marks = [draw.integers(0, 500, 800).astype(np.uint64) for _ in range(4)]
    sketches = []
    for part in marks:
        sketch = np.zeros((2, 64), np.uint8)
        substring._count(sketch, part[:400], 256)
        substring._count(sketch, part[400:], 256)
        sketches.append(sketch)
    total = substring._joined(substring._joined(sketches[0], sketches[1]), substring._joined(sketches[2], sketches[3]))
    often = [m for m, n in Counter(np.concatenate(marks).tolist()).items() if n > 1]
    assert substring._again(total, np.array(often, np.uint64), 256).all()


def test_words_of_neighbouring_texts_stay_apart():
    words = Words(pa.array(["ab", "", "cd  e\n", " ", "f"]))
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.stop)]
    assert found == ["ab", "cd", "e", "f"] and words.per_text.tolist() == [1, 0, 2, 0, 1]


def test_empty_table(empty):
    assert substring.remove_repeats(empty, 20, cells=1 << 10).count() == 0


def test_copies_of_a_row_carry_one_list_each(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(40))
    longest = []
    for copies in (50, 200):
        rows = [(1, text)] * copies + [(2, text)] * copies + [(3, "x " + text)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        found = substring.repeated_windows(docs, 20, cells=1 << 12).groupBy("doc", "tag").agg({"starts": "collect_set"})
        longest.append(max(len(b"".join(map(bytes, r[2]))) for r in found.collect()))
        got = substring.remove_repeats(docs, 20).groupBy("doc_id", "n_removed").count().collect()
        assert sorted((r.doc_id, r.n_removed, r["count"]) for r in got) == [(1, 0, copies), (2, 40, copies), (3, 40, 1)]
    assert longest[0] == longest[1]


def test_sketch_follows_the_size_of_the_texts(spark, monkeypatch):
    few = spark.range(10).selectExpr("'a b c' AS text")
    assert substring.sketch_cells(few) == substring.LEAST_CELLS
    monkeypatch.setattr(substring, "LEAST_CELLS", 1 << 10)
    many = spark.range(1000).selectExpr("repeat('word ', 20000) AS text")
    assert substring.sketch_cells(many) == 1 << 23 and substring.sketch_cells(few) == 1 << 10
    assert substring.sketch_cells(few.limit(0)) == substring.LEAST_CELLS
