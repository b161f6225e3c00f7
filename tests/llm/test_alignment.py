from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers
import pytest

from panelwise.llm import alignment

BYTE, PIECE = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return alignment.tokenizers_of(BYTE, PIECE)


def plain(both, text):
    """Groups of a text as (A ids, B ids), by walking over both token lists."""
    if not text:
        return []
    a = both.byte_level.encode(" " + text, add_special_tokens=False).ids
    b = both.piece.encode(text)
    whole = b" " + text.encode()
    if b"".join(both.a_bytes[i] for i in a) != whole or b"".join(both.b_bytes[i] for i in b) != whole:
        return []
    ends_a, ends_b = np.cumsum([len(both.a_bytes[i]) for i in a]), np.cumsum([len(both.b_bytes[i]) for i in b])
    cuts, out, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
    for cut in cuts:
        k, m = i, j
        while i < len(a) and ends_a[i] <= cut:
            i += 1
        while j < len(b) and ends_b[j] <= cut:
            j += 1
        out.append((a[k:i], b[m:j]))
    return out


def brute(both, rows):
    """What ``link_counts`` is to give, from all links of all texts."""
    groups = [plain(both, text) for _, text in rows]
    links = [[(x, y) for left, right in g for x in left for y in right] for g in groups]
    count = Counter(pair for each in links for pair in set(each))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (key, _), g, each in zip(rows, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            key, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(each), sum(count[p] == most[p[0]] for p in each),
            sum(count[p] for p in each), hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=str)


HARD = [
    "the cat sat on the mat", "a" * 999, "ab" * 501, "日本語のテキスト", "  two  spaces ", "<|endoftext|> <s> </s> <0x41>", "▁ piece space",
    "\x00 null", "é" * 333 + "ß", "\r\n\ttabs", "👩‍👩‍👧 ok", "12345 67 890", "-" * 501, "ＦＵＬＬ width ﬁ", "x", " ", "\n",
]


def test_labels_equal_common_ends():
    rng = random.Random(3)
    for _ in range(200):
        size = rng.randint(1, 60)
        ends = [sorted({*rng.sample(range(1, size + 1), rng.randint(1, size)), size}) for _ in range(2)]
        a, b = (np.array(x) for x in ends)
        common = np.array(sorted(set(ends[0]) & set(ends[1])))
        got = alignment.label_groups(a, b)
        assert got[0].tolist() == np.searchsorted(common, a).tolist()
        assert got[1].tolist() == np.searchsorted(common, b).tolist()


def test_long_chain_of_overlaps():
    a, b = np.arange(2, 200_001, 2), np.concatenate([np.arange(1, 200_000, 2), [200_000]])
    left, right = alignment.label_groups(a, b)
    assert set(left) == set(right) == {0}


@pytest.mark.parametrize("pattern", [None, tokenizers.PATTERN])
def test_hard_texts(spark, both, frame, pattern):
    rows = list(enumerate(HARD))
    got = sorted(map(tuple, alignment.link_counts(frame(rows), BYTE, PIECE, pattern).collect()), key=str)
    assert got == brute(both, rows)


def test_ranks_give_the_ids_of_the_file(spark, both):
    ranked = alignment.tokenizers_of(BYTE, PIECE, tokenizers.PATTERN)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text]
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz  ABC019.,é日\u0301\n' \x85"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    assert ranked.encode(texts) == both.encode(texts)


def test_odd_rows_and_blocks(both, odd, odd_rows, empty, monkeypatch, many_partitions):
    monkeypatch.setattr(alignment, "LIST_PAIRS", 7)
    rows = odd_rows + list(enumerate(HARD, 20)) + [(50, HARD[0])] * 5
    want = brute(both, rows)
    for block in (1, 1 << 20):
        monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
        wide = odd.unionByName(odd.sparkSession.createDataFrame(rows[len(odd_rows) :], "doc_id long, text string"), True)
        got = alignment.link_counts(wide.repartition(3), BYTE, PIECE)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert alignment.link_counts(empty, BYTE, PIECE).count() == 0


def test_align_gives_tokens_and_groups(both, frame, empty):
    rows = [*enumerate(HARD), (90, None), (91, ""), (92, HARD[0])]
    got = alignment.align(frame(rows).withColumnRenamed("words", "a_ids"), BYTE, PIECE)
    assert got.columns.count("a_ids") == 1
    for row in got.collect():
        at_a, at_b, groups = 0, 0, []
        for x, y in zip(row.a_sizes, row.b_sizes):
            groups.append((row.a_ids[at_a : at_a + x], row.b_ids[at_b : at_b + y]))
            at_a, at_b = at_a + x, at_b + y
        assert groups == plain(both, row.text)
        assert (at_a, at_b) == (len(row.a_ids), len(row.b_ids))
    assert alignment.align(empty, BYTE, PIECE).count() == 0


def test_query_equals_brute_force(spark, both):
    from panelwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_tokenizer_alignment"](spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == brute(both, rows)
