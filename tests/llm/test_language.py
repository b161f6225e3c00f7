from __future__ import annotations

import random
import zlib

import pyarrow as pa
import pytest

from panelwise.llm import language
from panelwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def phrases(sample: bytes, text: bytes) -> int:
    """Longest stretches of ``text`` found in ``sample``, block by block."""
    count = 0
    for start in range(0, len(text), language.BLOCK):
        block, at = text[start : start + language.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at : at + size + 1] in sample:
                size += 1
            at, count = at + size, count + 1
    return count


def test_phrases_equal_substring_search(monkeypatch):
    rng = random.Random(2)
    for block in (7, 64, 1024):
        monkeypatch.setattr(language, "BLOCK", block)
        for _ in range(30):
            sample = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 90))).encode()
            texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 200))) for _ in range(6)]
            columns, alive, owner = language.blocks_of(pa.array(texts))
            found = language.Automaton(sample).phrases(columns, alive)
            got = [int(found[owner == k].sum()) for k in range(6)]
            assert got == [phrases(sample, t.encode()) for t in texts]


def test_longest_matches_are_whole():
    text = b"abcbcbcabcab"
    automaton = language.Automaton(text)
    for start in range(len(text)):
        for stop in range(start + 1, len(text) + 1):
            columns, alive, _ = language.blocks_of(pa.array([text[start:stop].decode()]))
            assert automaton.phrases(columns, alive).tolist() == [1]


def test_plain_drops_case_and_signs():
    got = language.plain(pa.array(["Don't  STOP--99ÉT", "", "123"])).to_pylist()
    assert got == [" don t stop ét ", " ", " "]


def test_held_out_accuracy_and_contract(spark):
    got = QUERIES["op13_language_id"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    lang = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        text = lang[r.doc_id][1]
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    tested = [r for r in rows if r.held_out and lang[r.doc_id][0] and r.lang_pred != "und"]
    right = sum(r.lang_pred == lang[r.doc_id][0] for r in tested)
    assert len(tested) > 2000 and right / len(tested) > 0.98, right / len(tested)


TEXTS = {"en": "the cat and the dog walk to the house of the king ", "de": "der hund und die katze gehen zum haus des königs über "}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, TEXTS[lang] + f"{'x' * (k % 3)}", lang) for k in range(60) for lang in TEXTS]
    rows += [(900, None, "en"), (901, "12 34", "de"), (902, "unlabelled words", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_odd_rows(labelled, odd, odd_rows, empty):
    model = language.fit(labelled)
    assert sorted(model.names) == ["de", "en"]
    wide = odd.withColumnRenamed("words", "score").withColumnRenamed("o", "has_letter")
    got = language.predict(wide, model)
    assert got.columns.count("score") == 1 and "has_letter" in got.columns
    rows = got.select("doc_id", "text", "lang_pred").collect()
    assert sorted((r.doc_id, r.text) for r in rows if r.doc_id and r.text) == sorted((i, x) for i, x in odd_rows if i and x)
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language.predict(empty, model).count() == 0
    nothing = language.fit(labelled.limit(0))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}


def test_long_and_short_texts(spark, labelled):
    model = language.fit(labelled)
    rows = [(1, TEXTS["en"] * 5000, ""), (2, TEXTS["de"] * 5000, ""), (3, "THE", ""), (4, "über", ""), (5, "日本語", "")]
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4)] == ["en", "de", "en", "de"]
    assert got[5].lang_pred in TEXTS


def test_sample_is_bounded_when_one_text_is_most_rows(spark, labelled, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ROWS", 5)
    same = spark.range(20_000).selectExpr("id as doc_id", "'the very same words again' as text", "'en' as lang")
    model = language.fit(labelled.unionByName(same))
    sample = dict(model.samples)["en"].decode()
    assert sample.count("very same words again") <= 1 and len(sample) <= 5 * (language.SAMPLE_CHARS + 1) + 2


def test_rows_of_the_held_out_part_teach_nothing(spark):
    kept = spark.createDataFrame([(k, "only known words here", "aa") for k in range(40)], "doc_id long, text string, lang string")
    secret = [(k, "wholly other things", "zz") for k in range(4000) if zlib.crc32(str(k).encode()) % 4 == 2]
    both = kept.unionByName(spark.createDataFrame(secret, "doc_id long, text string, lang string"))
    assert language.fit(both.filter(~language.held_out(both.doc_id))).names == ["aa"]
