"""SimHash groups, MinHash fingerprints and search, decontamination, line dedup: against brute force."""

from __future__ import annotations

import hashlib
import time
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from panelwise.llm import decontam, line_dedup, minhash, simhash
from panelwise.llm.components import components

LAST = (1 << 63) - 1
LOWER = {c: c + 32 for c in range(65, 91)}


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- SimHash


def simprint(text):
    words = space_words((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def simgroups(rows, radius=2):
    keys = [LAST if k is None else k for k, _ in rows]
    prints = [simprint(x) for _, x in rows]
    label = list(keys)
    changed = True
    while changed:
        changed = False
        for i, p in enumerate(prints):
            low = min(label[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= radius)
            if low != label[i]:
                label[i], changed = low, True
    return sorted((str(k), f"{p:016x}", c) for (k, _), p, c in zip(rows, prints, label))


def test_simhash_odd_rows(odd, odd_rows, empty):
    got = simhash.groups(odd).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((str(a), b, c) for a, b, c in got) == simgroups(odd_rows)
    assert simhash.groups(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_keep_first_keeps_one_of_each_group(odd, odd_rows):
    kept = sorted(str(r.doc_id) for r in simhash.keep_first(odd).collect())
    firsts = {c for _, _, c in simgroups(odd_rows)}
    want = sorted(str(k) for k, _ in odd_rows if (LAST if k is None else k) in firsts)
    assert kept == want


@pytest.mark.parametrize("large", [4096, 8])
def test_links_of_crowds(spark, many_partitions, large):
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2**63, 12, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << draw.integers(0, 64, n).astype(np.uint64)) if n else np.uint64(0) for n in draw.integers(0, 5, 900)]
    prints = np.unique(base[draw.integers(0, 12, 900)] ^ np.array(flips, np.uint64)).view(np.int64)
    frame = spark.createDataFrame([(int(v), int(v)) for v in prints], "name long, print long")
    got = {r.node: r.component for r in components(simhash.links(frame, 2, large)).collect()}
    prints.sort()
    values, label = prints.view(np.uint64), np.arange(len(prints))
    while True:
        new = np.array([label[np.bitwise_count(values ^ v) <= 2].min() for v in values])
        if (new == label).all():
            break
        label = new
    assert [got.get(int(p), int(p)) for p in prints] == [int(prints[i]) for i in label]


def test_tree_search_equals_scan():
    draw = np.random.default_rng(2)
    prints = np.unique(draw.integers(0, 2**16, 500, dtype=np.uint64))
    tree = simhash.Tree(prints)
    found = {(int(q), int(n)) for a, b in tree.within(prints, 3) for q, n in zip(a, b)}
    gaps = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(gaps <= 3))}


def test_components_of_chains_and_hubs(spark, many_partitions):
    edges = [(i + 1, i) for i in range(100, 160)] + [(5, i) for i in range(10, 60)] + [(7, 7), (5, 10), (10, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(10, 60)]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- MinHash


def minsets(text, size=5):
    words = space_words(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("parts", ["7", "1"])
def test_minhash_against_edit(spark, many_partitions, odd, odd_rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    order = sorted(((LAST if k is None else k), x or "", k) for k, x in odd_rows)
    want = []
    for i, (_, text, key) in enumerate(order):
        follow = order[(i + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 2] + follow[: len(text) // 2]
        want.append((str(key), len(text), hashlib.sha256(edited.encode()).hexdigest()))
        sets = minsets(text), minsets(edited), minsets(follow)
        want[-1] += (jaccard(sets[0], sets[1]), jaccard(sets[0], sets[2]))
    got = [tuple(r) for r in minhash.compare_with_edit(odd.repartition(4)).collect()]
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(w[:3] for w in want)
    by_edit = {w[2]: w for w in want}
    for r in got:
        assert abs(r[5] - by_edit[r[2]][3]) < 0.25 and abs(r[6] - by_edit[r[2]][4]) < 0.25
    prints = {}
    for r, text in ((r, dict((str(k), x or "") for k, x in odd_rows)[str(r[0])]) for r in got):
        assert prints.setdefault(text, r[3]) == r[3]


def test_minhash_of_one_and_no_rows(frame, empty):
    (row,) = minhash.compare_with_edit(frame([(4, "ab cd")])).collect()
    assert row.n_chars == 5 and row.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()
    assert minhash.compare_with_edit(empty).count() == 0


def test_search_finds_near_texts(frame):
    draw = np.random.default_rng(4)
    base = [" ".join(f"v{x}" for x in draw.integers(0, 5000, 120)) for _ in range(30)]
    near = [b.rsplit(" ", 3)[0] + " new end here" for b in base]
    rows = [(20 * i, b) for i, b in enumerate(base)] + [(20 * i + 7, n) for i, n in enumerate(near)] + [(20 * i + 9, b) for i, b in enumerate(base)]
    got = {(r.query, r.match): r.jaccard for r in minhash.near_search(frame([*rows, (3, ""), (None, base[0])])).collect()}
    sets = {k: minsets(x) for k, x in rows}
    want = {(20 * i, 20 * i + 7): jaccard(sets[20 * i], sets[20 * i + 7]) for i in range(30)}
    assert got.keys() == {p for p, j in want.items() if j >= 0.8} and len(got) == 30
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)


def test_likeness_estimates_similarity():
    texts = pa.array([" ".join(f"t{j}" for j in range(i, i + 400)) for i in range(0, 400, 40)])
    prints = minhash.fingerprints(texts)
    sets = [minsets(x) for x in texts.to_pylist()]
    for i in range(1, len(sets)):
        assert abs(minhash.likeness(prints[:1], prints[i : i + 1])[0] - jaccard(sets[0], sets[i])) < 0.15


# --- decontamination


def leak_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def leaks(rows, items, window=10):
    wins = []
    for item, text in items:
        w = leak_words(text)
        n = min(window, len(w))
        wins += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)] if w else []
    out = []
    for key, text in rows:
        w, hit, ids = leak_words(text), set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    ids |= {str(item)} if item is not None else set()
        out.append((str(key), len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


ITEMS = [(1, "shared3 shared4 " + " ".join(f"shared{i}" for i in range(5, 18))), (2, "Short!"), (3, None), (4, "..."), (10, "x x x"),
         (11, "x x x"), (None, "null key shared0"), (12, "zeichen 日本語"), (13, "one two three shared0 shared1 shared2 shared3 shared4 shared5")]


@pytest.mark.parametrize("limit", [32 << 20, 1500])
def test_contamination(spark, odd, odd_rows, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
    rows = [(k, x if not x or len(x) < 5000 else "x " * 50 + "tail") for k, x in odd_rows]
    docs = odd.withColumn("text", __import__("pyspark.sql.functions", fromlist=["expr"]).expr("CASE WHEN doc_id = 8 THEN concat(repeat('x ', 50), 'tail') ELSE text END"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination(docs, items).collect()
    assert sorted(((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == leaks(rows, ITEMS)
    clean = sorted(str(r.doc_id) for r in decontam.drop_contaminated(docs, items).collect())
    assert clean == sorted(k for k, _, hit, _ in leaks(rows, ITEMS) if not hit)


def test_contamination_of_nothing(spark, odd, empty, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontam.contamination(odd, none).collect()} == {0}
    assert decontam.drop_contaminated(odd, none).count() == len(odd_rows)
    assert decontam.contamination(empty, none).count() == 0


# --- line dedup


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else (a[p + 1 :] == b[p:] if len(a) > len(b) else a[p:] == b[p + 1 :])


def kept_lines(rows, near=20):
    docs = sorted({(LAST if k is None else k, x or "") for k, x in rows})
    first = {}
    for key, text in docs:
        for i, line in enumerate(text.split("\n")):
            if line.strip(" "):
                first.setdefault(line, (key, i))
    gone = {a for a in first for b in first if min(len(a), len(b)) >= near and first[b] < first[a] and one_edit(a, b)}
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        place = LAST if key is None else key
        stay = [x for i, x in enumerate(lines) if not x.strip(" ") or (first[x] == (place, i) and x not in gone)]
        out.append((str(key), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def test_lines(spark, many_partitions, frame, odd, odd_rows, empty):
    draw = np.random.default_rng(6)
    base = ["the quick brown fox jumps over it", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語のテキストがここにあります。とても長い行です", "short line"]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(draw.integers(1, 6)):
            line = base[draw.integers(0, 4)]
            for _ in range(draw.integers(0, 3)):
                at, kind = draw.integers(0, len(line)), draw.integers(0, 3)
                line = line[:at] + ["", "z", line[at] + "y"][kind] + line[at + 1 :]
            lines.append(line)
        rows.append((i, "\n".join([*lines, "", "  "][: draw.integers(1, 8)])))
    for table, given in ((frame(rows), rows), (odd, odd_rows)):
        got = line_dedup.remove_repeated_lines(table.repartition(5)).select("doc_id", "n_lines", "n_removed", "kept").collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == kept_lines(given)
    assert line_dedup.remove_repeated_lines(empty).count() == 0


def test_a_line_of_many_characters(frame):
    long = "ab" * 20_000
    rows = [(1, long), (2, long[:9000] + "z" + long[9000:]), (3, long[:-2] + "cb"), (4, long[1:-1])]
    got = {r.doc_id: r.n_removed for r in line_dedup.remove_repeated_lines(frame(rows)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_near_lines_of_very_many_characters(spark):
    """Time follows the length: a line of 200,000 characters and near copies of it."""
    line = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(200_000))
    changed, longer = line[:90_000] + "#" + line[90_001:], line[:120_000] + "#" + line[120_000:]
    other = line[::-1]
    rows = [(1, line), (2, changed), (3, longer), (4, line[:-1]), (5, other), (6, "#" + line + "#")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r.n_removed for r in line_dedup.remove_repeated_lines(docs).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0}
    assert time.time() - start < 60


def test_bands_find_nine_in_ten_of_a_hot_group(spark, frame):
    """Near copies with different texts around one passage, beside others: recall against all pairs."""
    draw = np.random.default_rng(9)
    passage = [f"p{x}" for x in draw.integers(0, 9000, 150)]
    rows = []
    for i in range(120):
        words = list(passage)
        for spot in draw.integers(0, 150, 1):
            words[spot] = f"n{i}x{spot}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(f"o{x}" for x in draw.integers(0, 9000, 100))) for i in range(60)]
    rows += [(1000 + i, t) for i, t in rows[:40]]
    got = {(r.query, r.match): r.jaccard for r in minhash.near_search(frame(rows), "key % 20 = 0").collect()}
    sets = {i: minsets(t) for i, t in rows if i < 1000}
    want = {(q, m): jaccard(sets[q], sets[m]) for q in sets if q % 20 == 0 for m in sets if m != q}
    want = {p: j for p, j in want.items() if j >= 0.8}
    assert len(want) > 300 and set(got) <= set(want) and len(got) >= 0.9 * len(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)
    near = {r.doc_id: r.representative for r in minhash.members(frame(rows)).collect()}
    assert len(near) == len(rows) and near[1003] == 3 and near[203] == 203


def test_query_of_bands_recalls_all_pairs_of_the_table(spark):
    from panelwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        rows.setdefault(r.text or "", []).append(r.doc_id)
    sets = {min(ids): minsets(text) for text, ids in rows.items()}
    asked = {min(ids): min([i for i in ids if i % 20 == 0], default=None) for ids in rows.values()}
    want = set()
    for a, query in asked.items():
        if query is not None and sets[a]:
            want |= {(query, b) for b in sets if b != a and sets[b] and jaccard(sets[a], sets[b]) >= 0.8}
    got = {(r.query, r.match) for r in QUERIES["minhash_near_search"](spark, folder).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)


@pytest.mark.parametrize("large", [8, 60])
def test_crowds_are_dealt_until_they_are_small(spark, large):
    """Fingerprints that agree in all but 14 bits: shards stay small at every depth, and no link is lost."""
    draw = np.random.default_rng(12)
    values = sorted({int(x) for x in draw.integers(0, 1 << 14, 700)} | {int(x) << 50 | 5 for x in draw.integers(0, 1 << 14, 300)})
    prints = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)], "name long, print long")
    found = {(r.a, r.b) for r in simhash.links(prints, 2, large).collect()}

    def reach(edges):
        root = list(range(len(values)))

        def top(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in edges:
            a, b = sorted((top(a), top(b)))
            root[b] = a
        return [top(v) for v in range(len(values))]

    near = [(i, j) for i, a in enumerate(values) for j, b in enumerate(values[:i]) if (a ^ b).bit_count() <= 2]
    assert reach(found) == reach(near)
