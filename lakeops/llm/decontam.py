"""Benchmark passages in documents, by SimHash of item-sized windows (operator 9).

Only DataFrame functions are used. For each item, windows of its size are laid so that they end with a
shingle of the item, and at the text's start if such a window would begin before it. The first of the
best windows is among them: one whose last shingle is not the item's loses nothing if it is moved a
word towards the start. Windows that hold fewer such shingles than ``least`` times the item's number
cannot reach that similarity and need no fingerprint.

Each different window and item gets a 64-bit SimHash of its shingles, weighted by their number.
Fingerprints are cut into BLOCKS blocks. Two that differ in at most RADIUS bits differ in at most one
bit of some block (RADIUS < 2 * BLOCKS), so an index of the items' blocks and of all values one bit off
holds one of the window's own blocks. At similarity 0.8 the bits that differ are about 10 +- 3 of 64:
so wide a radius tells items apart badly (of random pairs nearly all agree in some block), which is why
the index is asked for the item that the window's shingles name, not for all items of a size.
Candidates within the radius are verified by exact weighted Jaccard of the shingles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import BLANKS
from lakeops.session import written

WIDTH = 5
RADIUS = 21
BLOCKS = 11
BITS = 64
MOST_BROADCAST = 200_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), f"[{BLANKS}]+"), lambda w: w != "")


def _shingles(words: Column, width: int = WIDTH) -> Column:
    """The hash of each run of ``width`` words, in order; of all words if there are fewer."""
    return F.when(F.size(words) == 0, F.array().cast("array<long>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1))),
            lambda i: F.xxhash64(F.slice(words, i, width)),
        )
    )


def _with(value: Column, function) -> Column:
    """``function`` of a value that is computed once, however often the function uses it."""
    return F.get(F.transform(F.array(value), lambda x: function(x)), 0)


def simhash(shingles: Column) -> Column:
    """Bit b is set if more shingles have bit b set than not."""

    def vote(bit: Column) -> Column:
        return F.aggregate(
            shingles, F.lit(0).cast("long"), lambda n, h: n + F.getbit(h, bit).cast("long") * 2 - 1
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        F.lit(0).cast("long"),
        lambda value, bit: F.when(
            vote(bit) > 0, value.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        ).otherwise(value),
    )


CUTS = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]


def _block_value(fingerprint: Column, block: int) -> Column:
    low, high = CUTS[block], CUTS[block + 1]
    return F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def blocks(fingerprint: Column) -> Column:
    """(block, value) of each block of bits."""
    return F.array(
        *[F.struct(F.lit(i).alias("block"), _block_value(fingerprint, i).alias("value")) for i in range(BLOCKS)]
    )


def near_blocks(fingerprint: Column) -> Column:
    """(block, value) of each block of bits, and of each value that differs from it in one bit."""
    flips = [(i, flip) for i in range(BLOCKS) for flip in (0, *(1 << b for b in range(CUTS[i + 1] - CUTS[i])))]
    return F.array(
        *[
            F.struct(F.lit(i).alias("block"), _block_value(fingerprint, i).bitwiseXOR(F.lit(flip)).alias("value"))
            for i, flip in flips
        ]
    )


def _counted(shingles: Column) -> Column:
    """Each shingle with its number, as a map."""
    return F.map_from_entries(
        F.transform(
            F.array_distinct(shingles),
            lambda h: F.struct(h.alias("key"), F.size(F.filter(shingles, lambda x: x == h)).alias("value")),
        )
    )


def weighted_jaccard(one: Column, other: Column) -> Column:
    """Sum of the smaller numbers of each shingle over the sum of the larger ones."""
    total = F.size(one) + F.size(other)
    common = _with(
        _counted(other),
        lambda counts: F.aggregate(
            F.map_entries(_counted(one)),
            F.lit(0),
            lambda n, e: n + F.least(e["value"], F.coalesce(F.try_element_at(counts, e["key"]), F.lit(0))),
        ),
    )
    return _with(common, lambda c: c / (total - c))


def _items(benchmark: DataFrame) -> DataFrame:
    """Items that have words: key, id, number of words, shingles, fingerprint.

    ``count`` is the number of its shingles, ``enough`` how many of them a window must hold.
    """
    words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text")).alias("w"))
    found = words.filter((F.size("w") > 0) & F.col("item_id").isNotNull()).select(
        F.xxhash64("item_id", "w").alias("item"),
        "item_id",
        F.size("w").alias("size"),
        _with(F.col("w"), _shingles).alias("item_shingles"),
    )
    return written(
        found.dropDuplicates(["item"]).withColumn("item_print", simhash(F.col("item_shingles"))), "benchmark-items"
    )


def _hits(docs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """For each document and item the starts of the windows that end with enough shared shingles:
    ``doc_id``, ``row``, ``item``, ``size``, ``count``, ``starts``."""
    needed = items.select("item", "size", F.explode(F.array_distinct("item_shingles")).alias("shingle"))
    held = needed.count()
    keyed = docs.select("doc_id", "row", "text")

    def runs(width: int) -> DataFrame:
        shingles = _with(_words(F.col("text")), lambda words: _shingles(words, width))
        return keyed.select("doc_id", "row", F.posexplode(shingles).alias("at", "shingle"))

    # An item of fewer words is one shingle of its own width.
    short = [r["size"] for r in items.filter(F.col("size") < WIDTH).select("size").distinct().collect()]
    shingled = reduce(DataFrame.union, map(runs, [WIDTH, *short]))
    shared = shingled.join(F.broadcast(needed) if held <= MOST_BROADCAST else needed, "shingle")
    count = F.greatest(F.col("size") - (WIDTH - 1), F.lit(1))
    enough = F.greatest(F.ceil(count * F.lit(least) - F.lit(1e-9)).cast("int"), F.lit(1))
    ends = F.filter("ats", lambda at, i: F.get(F.col("ats"), i - F.col("enough") + 1) > at - F.col("count"))
    return (
        shared.groupBy("doc_id", "row", "item", "size")
        # Rows that repeat give the same places.
        .agg(F.sort_array(F.collect_set("at")).alias("ats"))
        .select("doc_id", "row", "item", "size", "ats", count.alias("count"), enough.alias("enough"))
        .select(
            "doc_id",
            "row",
            "item",
            "size",
            "count",
            F.transform(ends, lambda at: F.greatest(at - F.col("count") + 1, F.lit(0))).alias("starts"),
        )
        .filter(F.size("starts") > 0)
    )


def _window(words: Column, shingles: Column, start: Column, size: Column, count: Column) -> Column:
    """The shingles of the window of ``size`` words from ``start`` on, or of all words of a shorter text."""
    short = F.array(F.xxhash64(F.slice(words, start + 1, size)))
    return F.when(size < WIDTH, short).otherwise(F.slice(shingles, start + 1, count))


def _laid_out(function) -> Column:
    """``function`` of the words and shingles of a row as plain arrays.

    A stored array is copied whole by every slice of it; the result of a transformation is not.
    """
    return _with(
        F.transform("words", lambda w: w),
        lambda words: _with(F.transform("shingles", lambda h: h), lambda shingles: function(words, shingles)),
    )


def _windows(docs: DataFrame, items: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Windows of documents, and each different window of an item once.

    The first has ``doc_id``, ``row``, ``item``, ``window`` (a hash of the shingles) and the first
    ``start``; the second ``item``, ``window`` and ``shingles``. Within a row only starts and hashes are
    kept for all windows, so a text that repeats an item costs no more than its words, and the shingles
    of equal windows are laid out once, however many documents hold them.
    """
    hits = _hits(docs, items, least)
    found = hits.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(
        F.collect_list(F.struct("item", "size", "count", "starts")).alias("found")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row"))
    words = docs.join(found, same).dropDuplicates(["doc_id", "row"]).select("doc_id", "row", "found", _words(F.col("text")).alias("words"))
    texts = written(words.withColumn("shingles", _shingles(F.col("words"))), "benchmark-texts")

    def placed(words: Column, shingles: Column) -> Column:
        def at(f: Column, start: Column) -> Column:
            return F.struct(
                f["item"].alias("item"),
                F.xxhash64(_window(words, shingles, start, f["size"], f["count"])).alias("window"),
                start.alias("start"),
            )

        def starts(f: Column) -> Column:
            # A window that would pass the end of the text is moved back to it.
            last = F.greatest(F.size(words) - f["size"], F.lit(0))
            return F.transform(F.transform(f["starts"], lambda s: F.least(s, last)), lambda s: at(f, s))

        return F.flatten(F.transform("found", starts))

    laid = texts.select("doc_id", "row", _laid_out(placed).alias("laid"))
    occurring = written(
        laid.select("doc_id", "row", F.inline("laid"))
        .groupBy("doc_id", "row", "item", "window")
        .agg(F.min("start").alias("start")),
        "benchmark-hits",
    )
    one_each = occurring.groupBy("item", "window").agg(F.min_by(F.struct("doc_id", "row", "start"), "row").alias("r"))
    chosen = (
        one_each.join(items.select("item", "size"), "item")
        .groupBy(F.col("r.doc_id").alias("__id"), F.col("r.row").alias("__row"))
        .agg(F.collect_list(F.struct("item", "window", "r.start", "size")).alias("chosen"))
    )

    def cut(words: Column, shingles: Column) -> Column:
        def of(c: Column) -> Column:
            count = F.greatest(c["size"] - (WIDTH - 1), F.lit(1))
            window = _window(words, shingles, c["start"], c["size"], count)
            return F.struct(c["item"].alias("item"), c["window"].alias("window"), window.alias("shingles"))

        return F.transform("chosen", of)

    different = texts.join(chosen, same).select(_laid_out(cut).alias("cut")).select(F.inline("cut"))
    return occurring, different


def _found(docs: DataFrame, benchmark: DataFrame, least: float) -> DataFrame:
    """``doc_id``, ``row``, ``item_id``, ``position``, ``similarity``: the first of the best windows of each pair."""
    items = _items(benchmark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    occurring, different = _windows(keyed, items, least)
    windows = written(different.withColumn("print", simhash(F.col("shingles"))), "benchmark-windows")
    # The index: blocks of the items' fingerprints and of their neighbours. A window asks it for the
    # item that its shingles name.
    index = items.select("item", F.inline(near_blocks(F.col("item_print"))))
    near = (
        windows.select("item", "window", "print", F.inline(blocks(F.col("print"))))
        .join(index, ["item", "block", "value"])
        .select("item", "window")
        .distinct()
    )
    verified = (
        windows.join(near, ["item", "window"])
        .join(items.select("item", "item_id", "item_print", "item_shingles"), "item")
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .withColumn("similarity", weighted_jaccard(F.col("shingles"), F.col("item_shingles")))
        .filter(F.col("similarity") >= least)
        .select("item", "window", "item_id", "similarity")
    )
    return (
        occurring.join(verified, ["item", "window"])
        .groupBy("doc_id", "row", "item_id")
        .agg(
            F.max_by("start", F.struct("similarity", -F.col("start"))).cast("long").alias("position"),
            F.max("similarity").alias("similarity"),
        )
    )


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """``doc_id``, ``item_id``, ``position``, ``similarity`` of the items found in documents.

    ``position`` is the first word of the best window as long as the item, counted from 0. Words are
    lowered; shingles have five words, or all of a shorter text. Items and texts without words are
    found nowhere and hold nothing. Rows with equal id and text are one; rows without id are told
    apart by their text. Items without id are not looked for; items that share an id are looked for each,
    and the best window of any counts. Very long texts, also those that repeat an item all along, take
    time in proportion to their words. An empty table on either side gives no rows; other columns are
    not read.
    """
    return _found(docs, benchmark, least).drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns.

    Missing and empty texts hold no item and stay; rows that repeat stay or go together; rows without id
    are told apart by their text. Otherwise as ``leaks``.
    """
    dirty = written(
        _found(docs, benchmark, least).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct(),
        "benchmark-leaks",
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__row"))
    return docs.join(dirty, same, "left_anti")
