"""Documents that contain windows of benchmark items, by a prefix-filtered join.

A document that contains a window contains all of its shingles, so for exact
containment one of them is a necessary prefix: the rarest in the corpus.  Only that
one is joined.  Where it stands in the window gives where the window would stand in
the document; what would stick out is dropped, the rest is compared word by word.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import LOWER, UPPER, fresh, whole
from panelwise.session import materialize

#: Words in a window and in the shingles that are joined.
WINDOW, SHINGLE = 10, 5
#: Bytes of windows that are broadcast at a time; a larger benchmark is joined in more passes.
BROADCAST_BYTES = 32 << 20

_APART = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words_of(text: Column) -> Column:
    """Runs of 0-9, a-z and what is not ASCII, A-Z lower-cased; null has none."""
    plain = F.translate(whole(text), UPPER + _APART, LOWER + " " * len(_APART))
    return F.array_remove(F.split(plain, " "), "")


def _shingle(words: Column, at: Column, size: int) -> Column:
    """Digest of ``size`` words from position ``at``, counted from 0."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def _shingles(words: Column, size: int) -> Column:
    count = F.size(words) - size + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: _shingle(words, i, size))).otherwise(
        F.array().cast("array<bigint>")
    )


def item_windows(items: DataFrame, window: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(wid, item, words) for each window of each item, once; an item of fewer words, but not none, is one."""
    words = items.select(F.col(f"`{item}`").cast("string").alias("item"), words_of(F.col(f"`{text}`")).alias("all"))
    size = F.least(F.lit(window), F.size("all"))
    starts = F.explode(F.sequence(F.lit(1), F.size("all") - size + 1))
    cut = words.filter("size(all) > 0").select("item", "all", size.alias("size"), starts.alias("start"))
    found = cut.select("item", F.expr("slice(all, start, size)").alias("words"))
    return found.select(F.sha2(F.array_join("words", " "), 256).alias("wid"), "item", "words").distinct()


def with_prefix(windows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(wid, words, place, prefix): windows with their rarest shingle and where it first stands in them.

    ``docs`` has the documents' words.  Shingles are counted over all of them; equal
    counts are told apart by digest.
    """
    spots = windows.select("wid", F.posexplode(_shingles(F.col("words"), size)).alias("place", "prefix"))
    known = spots.select("prefix").distinct()
    seen = docs.select(F.explode(_shingles(F.col("words"), size)).alias("prefix"))
    seen = seen.join(F.broadcast(known) if _bytes_bound(known) else known, "prefix", "left_semi")
    counts = seen.groupBy("prefix").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "prefix", "place")).alias("best")
    chosen = spots.join(counts, "prefix", "left").groupBy("wid").agg(best)
    return windows.join(chosen, "wid").select("wid", "words", F.col("best.place").alias("place"), F.col("best.prefix").alias("prefix"))


def _bytes_bound(known: DataFrame) -> bool:
    return known.count() * 64 <= BROADCAST_BYTES


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """(key, tag, n_words, n_hit, items) per document row.

    n_hit is the number of words inside occurrences of windows, items the sorted
    ids, as strings, of the items with such windows; no items: an empty array.  tag
    is a digest of the text: rows with equal key and text have equal results, each
    its own row.  Null texts have no words, an item without id counts for hits only.
    """
    names = {"doc": F.col(f"`{key}`"), "tag": F.xxhash64(whole(F.col(f"`{text}`"))), "words": words_of(F.col(f"`{text}`"))}
    rows = docs.select(*[c.alias(n) for n, c in names.items()])
    pairs = materialize(item_windows(items, window, item, item_text), "windows")
    windows = pairs.select("wid", "words").distinct()
    sizes = windows.agg(F.min(F.size("words")).alias("least"), F.max(F.size("words")).alias("most")).first()
    short = [] if sizes.most is None else [s for s in range(sizes.least, min(shingle, sizes.most + 1))]
    found = None
    for size in [shingle, *short]:
        own = windows.filter(F.size("words") >= shingle if size == shingle else F.size("words") == size)
        own = materialize(with_prefix(own, rows, size), "prefixes")
        amount = own.agg(F.sum(F.octet_length(F.array_join("words", " ")) + 200)).first()[0] or 0
        passes = max(1, math.ceil(amount / BROADCAST_BYTES))
        for k in range(passes):
            part = own.filter(F.pmod("prefix", F.lit(passes)) == k) if passes > 1 else own
            hits = _hits(rows, part, size, first=found is None)
            found = hits if found is None else found.unionByName(hits)
    by_doc = found.groupBy("doc", "tag").agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("wid").alias("wids"),
    )
    by_doc = materialize(by_doc, "hits")
    ids = (
        by_doc.filter("size(wids) > 0").select("doc", "tag", F.explode("wids").alias("wid"))
        .join(pairs.select("wid", "item"), "wid")
        .groupBy("doc", "tag").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["stop"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    d, i = by_doc.alias("d"), ids.alias("i")
    same = F.col("d.doc").eqNullSafe(F.col("i.doc")) & (F.col("d.tag") == F.col("i.tag"))
    out = d.join(i, same, "left").withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return out.select(
        F.col("d.doc").alias(key), F.col("d.tag").alias("tag"), F.col("n_words").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _hits(rows: DataFrame, windows: DataFrame, size: int, first: bool) -> DataFrame:
    """(doc, tag, n_words, span, wid) of the windows found; with ``first`` also a row with n_words per document."""
    digests = _shingles(F.col("words"), size)
    if first:
        digests = F.concat(F.array(F.lit(None).cast("bigint")), digests)
    spots = rows.select("doc", "tag", "words", F.posexplode(digests).alias("at", "prefix"))
    w = F.broadcast(windows.select("prefix", "place", "wid", F.col("words").alias("wanted")))
    joined = spots.join(w, "prefix", "left" if first else "inner")
    start = F.col("at") - F.col("place") - (1 if first else 0)
    length = F.size("wanted")
    fits = (start >= 0) & (start + length <= F.size("words"))
    equal = F.slice(F.col("words"), F.when(fits, start + 1).otherwise(1), length) == F.col("wanted")
    is_row = (F.col("at") == 0) if first else F.lit(False)
    hit = F.col("wid").isNotNull() & fits & equal
    return joined.filter(is_row | hit).select(
        "doc", "tag",
        F.when(is_row, F.size("words")).alias("n_words"),
        F.when(hit, F.struct(start.alias("start"), (start + length).alias("stop"))).alias("span"),
        F.when(hit, F.col("wid")).alias("wid"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents in which no window of an item occurs, as they were."""
    k, t = fresh(docs, "k", "t")
    found = contamination(docs, items, key, text, **settings).filter("n_hit > 0")
    found = found.select(F.col(key).alias(k), F.col("tag").alias(t)).distinct()
    same = F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.xxhash64(whole(F.col(f"`{text}`"))) == F.col(t))
    return docs.join(found, same, "left_anti")
