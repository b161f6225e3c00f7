"""Removal of lines that equal an earlier line, or nearly do, over all documents.

Near means one edit: a character put in, taken out or changed.  Lines are near if a
deletion of one equals the other (put in, taken out), or if both without the
character at one place are equal (changed).  So each line emits the digests of all
its deletions and of itself, and digests are joined by equality.  Lines that share
a digest this way are near without being compared pair by pair, so the earliest of
a digest decides for all; that one pair per line is then verified.

Before that, lines that can have no near line are left out: two lines one edit apart
agree in the first or the last half of the shorter one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwise.llm.common import fresh, whole
from panelwise.session import materialize

#: Shorter lines, in characters, are only compared for equality.
NEAR_CHARS = 20
#: Rows of a few numbers that are broadcast; larger tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_LAST = (1 << 63) - 1
_TERM = 1 << 31


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(o, tag, at, line, h1, h2): lines with more than spaces, where they stand and their digests."""
    source = docs.select(
        F.coalesce(f"`{key}`", F.lit(_LAST)).alias("o"), F.xxhash64(whole(F.col(f"`{text}`"))).alias("tag"),
        F.posexplode(F.split(whole(F.col(f"`{text}`")), "\n")).alias("at", "line"),
    )
    held = source.filter(F.trim("line") != "")
    return held.select("o", "tag", "at", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))


def _halves(line: Column, size: Column) -> list[Column]:
    """Digests of the halves of a line, taken as the longer and as the shorter of two lengths one apart."""
    out = []
    for length in (size, size - 1):
        half = F.floor(length / 2).cast("int")
        for side, part in ((0, F.left(line, half)), (1, F.right(line, half))):
            out.append(F.xxhash64(F.lit(side), length, part))
    return out


def _small(table: DataFrame) -> DataFrame:
    """The written table, to be broadcast if it has few rows of fixed width."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def near_lines(docs: DataFrame, firsts: DataFrame, key: str, text: str, near_chars: int) -> DataFrame:
    """(h1, h2) of the lines of which an earlier one is one edit away."""
    lines = _lines(docs, key, text)
    sized = lines.filter(F.char_length("line") >= near_chars).withColumn("size", F.char_length("line"))
    halves = sized.select("h1", F.explode(F.array(*_halves(F.col("line"), F.col("size")))).alias("half"))
    shared = halves.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low <> high").select("half")
    shared = _small(materialize(shared, "halves"))
    suspects = _small(materialize(halves.join(shared, "half", "left_semi").select("h1").distinct(), "suspects"))
    found = sized.join(suspects, "h1", "left_semi").join(firsts, ["h1", "h2", "o", "tag", "at"], "left_semi").dropDuplicates(["h1", "h2"])
    found = materialize(found.select("h1", "h2", "o", "tag", "at", "line", "size"), "lines")

    dealt = found.repartition("h1", "h2")
    chars = dealt.select("h1", "h2", "o", "tag", "at", "size", F.posexplode(F.split("line", "")).alias("j", "c"))
    chars = chars.filter("c <> ''")
    run = Window.partitionBy("h1", "h2").orderBy("j")
    every = Window.partitionBy("h1", "h2")
    for k in (1, 2):
        here = F.pmod(F.xxhash64(F.lit(k), "c", "j"), F.lit(_TERM))
        moved = F.pmod(F.xxhash64(F.lit(k), "c", F.col("j") - 1), F.lit(_TERM))
        chars = chars.withColumns({f"a{k}": here, f"b{k}": moved})
    sums = {}
    for k in (1, 2):
        sums[f"d{k}"] = F.sum(f"a{k}").over(run) - F.col(f"a{k}") + F.sum(f"b{k}").over(every) - F.sum(f"b{k}").over(run)
        sums[f"t{k}"] = F.sum(f"a{k}").over(every)
    chars = chars.withColumns(sums)
    who = ["h1", "h2", "o", "tag", "at"]
    deletion = F.xxhash64(F.col("size") - 1, "d1", "d2")
    itself = F.xxhash64("size", "t1", "t2")
    entries = F.array(F.struct(deletion.alias("v"), F.col("j").alias("place")))
    own = F.array(F.struct(itself.alias("v"), F.lit(-1).alias("place")))
    keys = chars.select(*who, F.inline(F.when(F.col("j") == 0, F.concat(entries, own)).otherwise(entries)))

    me = F.struct("o", "tag", "at", "h1", "h2", "place")
    same_place, same_digest = Window.partitionBy("v", "place"), Window.partitionBy("v")
    groups = keys.repartition("v").select(
        "h1", "h2", me.alias("me"),
        F.when(F.col("place") >= 0, F.min(me).over(same_place)).alias("changed"),
        F.when(F.col("place") >= 0, F.min(F.when(F.col("place") < 0, me)).over(same_digest))
        .otherwise(F.min(F.when(F.col("place") >= 0, me)).over(same_digest)).alias("longer"),
    )
    pairs = groups.select("h1", "h2", "me", F.explode(F.array("changed", "longer")).alias("other"))
    order = [F.struct(*[F.col(f"{side}.{c}") for c in ("o", "tag", "at", "h1", "h2")]) for side in ("other", "me")]
    pairs = pairs.filter(F.col("other").isNotNull() & (order[0] < order[1]))
    # Equal digests of one pair differ in the place of a run of equal characters only, so one of them is enough.
    places = F.min(F.struct(F.col("me.place").alias("mine"), F.col("other.place").alias("theirs"))).alias("place")
    pairs = pairs.groupBy("h1", "h2", F.col("other.h1").alias("e1"), F.col("other.h2").alias("e2")).agg(places)
    mine = found.select("h1", "h2", F.col("line").alias("mine"))
    theirs = found.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("theirs"))
    checked = pairs.join(mine, ["h1", "h2"]).join(theirs, ["e1", "e2"])
    one_edit = _without(F.col("mine"), F.col("place.mine")) == _without(F.col("theirs"), F.col("place.theirs"))
    return checked.filter(one_edit).select("h1", "h2").distinct()


def _without(line: Column, place: Column) -> Column:
    """The line without the character at a place, counted from 0; the whole line if the place is below 0."""
    rest = F.concat(F.left(line, place), F.substring(line, place + 2, F.char_length(line)))
    return F.when(place < 0, line).otherwise(rest)


def remove_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", near_chars: int = NEAR_CHARS, kept: str = "kept"
) -> DataFrame:
    """The rows with n_lines, n_removed and their kept lines, joined by newlines, in ``kept``.

    A line goes if the same line, or one that is one edit away, stands earlier: in a
    document with a smaller key, or before it in the same one.  Earlier is judged on
    the input, so lines that go count too.  Lines of fewer than ``near_chars``
    characters are compared for equality only; empty lines and lines of spaces always stay.  A
    document may be left with an empty text; null has one empty line.  A null key
    is larger than all others.  Rows with an equal key and text are one document and
    have equal results.  Columns of the added names are replaced.
    """
    names = [f"`{c}`" for c in docs.columns if c not in ("n_lines", "n_removed", kept)]
    lines = _lines(docs, key, text)
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("o", "tag", "at")).alias("p")).select("h1", "h2", "p.*")
    firsts = materialize(firsts, "first-lines")
    near = near_lines(docs, firsts, key, text, near_chars)
    stay = firsts.join(materialize(near, "near-lines"), ["h1", "h2"], "left_anti")
    o, tag, at, split = fresh(docs, "o", "tag", "at", "split")
    stay = stay.groupBy(F.col("o").alias(o), F.col("tag").alias(tag)).agg(F.collect_set("at").alias(at))
    rows = docs.withColumns({o: F.coalesce(f"`{key}`", F.lit(_LAST)), tag: F.xxhash64(whole(F.col(f"`{text}`")))})
    joined = rows.join(stay, [o, tag], "left").withColumn(split, F.split(whole(F.col(f"`{text}`")), "\n"))
    blank = F.transform(F.col(split), lambda line, i: F.when(F.trim(line) == "", i))
    held = F.concat(F.coalesce(at, F.array().cast("array<int>")), F.filter(blank, lambda i: i.isNotNull()))
    out = joined.withColumn(at, F.array_sort(held))
    return out.select(
        *names, F.size(split).cast("long").alias("n_lines"), (F.size(split) - F.size(at)).cast("long").alias("n_removed"),
        F.array_join(F.transform(at, lambda i: F.get(F.col(split), i)), "\n").alias(kept),
    )
