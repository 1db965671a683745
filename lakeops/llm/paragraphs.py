"""Removal of repeated passages and paragraphs: MinHash bands, exact verification, components (operator 3).

Two kinds of paragraphs are cut from the words of a text, in one pass whose result is stored.

* Natural ones: lines; if asked for, lines shorter than ``least_words`` are joined up to the next blank or
  longer line, so that a passage may be wrapped at any width.
* Content-defined ones, for passages inside other text: the place of the least hash among any ``REACH``
  neighbouring shingles is an anchor, and the ``UNIT`` words from there are a paragraph. Any run of
  UNIT + REACH - 1 = 50 words holds one as a whole, found by the run's own words alone, so a run that
  documents share gives them an equal paragraph, wherever it lies in them.

1. Equal paragraphs are one class from here on. Of content-defined ones, which overlap all along the
   text, equality is all that counts: any edit leaves the ones beside it.
2. Each class of natural paragraphs gets a MinHash signature over its word shingles, cut into bands;
   one of very few words also gets keys that it shares with those of which one word differs. Rows and bands are tuned: at Jaccard 0.8, 16 bands of 4 miss a pair with probability
   (1 - 0.8**4) ** 16, about 0.02 %.
3. Classes that collide in a band form candidate components, from one edge per band value and class.
   A component's classes meet in a task, several small ones together; one that is too large is dealt
   over blocks whose pairs meet. There, links are verified by exact Jaccard; very short texts may also
   differ by one word, where that leaves enough of the longer one.
4. Components of verified links are groups of copies. A paragraph is a removal unless it is the first
   of its group, by document and position. Removals that overlap are joined to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.llm.common import components, hashed_words, mixed, plain_words, run_hashes, shingle_hashes, shingles_of
from lakeops.llm.ngram_join import Groups, linked
from lakeops.session import written

BANDS, ROWS = 16, 4
SALTS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
TASK_CLASSES = 4_000
FEW_WORDS = 9
#: Words of a shared run that is found for certain, of a content-defined paragraph, and places an
#: anchor is chosen from.
RUN = 50
UNIT = 37
REACH = RUN - UNIT + 1


def signatures(shingles: list[np.ndarray]) -> np.ndarray:
    """The least value of each permutation for each set; a permutation is a multiplication and a shift."""
    starts = np.cumsum([0] + [len(s) for s in shingles])[:-1]
    together = np.concatenate(shingles)
    result = np.empty((len(shingles), BANDS * ROWS), np.uint32)
    with np.errstate(over="ignore"):
        for i, salt in enumerate(SALTS):
            values = (together * (salt | np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
            result[:, i] = np.minimum.reduceat(values, starts)
    return result


def band_values(signature: np.ndarray) -> np.ndarray:
    """A 64-bit value for each band of each set; equal ones collide."""
    with np.errstate(over="ignore"):
        values = np.repeat(mixed(np.arange(100, 100 + BANDS, dtype=np.uint64))[None, :], len(signature), 0)
        for row in range(ROWS):
            values = mixed(values) + signature[:, row::ROWS].astype(np.uint64)
        return mixed(values)


def edits_within(one: list[str], other: list[str], most: int) -> bool:
    """Whether two lists of words differ by at most ``most`` insertions, deletions and replacements."""
    if abs(len(one) - len(other)) > most:
        return False
    before = list(range(len(other) + 1))
    for i, word in enumerate(one, 1):
        row = [i]
        for j, against in enumerate(other, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (word != against)))
        before = row
    return before[-1] <= most


def edits_allow(one: list[str], other: list[str], percent: int) -> bool:
    """Whether the words that differ leave ``percent`` of the longer text."""
    return edits_within(one, other, max(len(one), len(other)) * (100 - percent) // 100)


def one_word_links(texts: list[list[str]], percent: int) -> list[tuple[int, int]]:
    """Links, enough to connect all, of texts that differ by one word replaced, added or left out, where
    that leaves ``percent`` of the longer one."""
    places: dict[tuple, int] = {}
    links = []
    for n, words in enumerate(texts):
        if len(words) * (100 - percent) < 100:
            continue
        for i in range(len(words)):
            # The same rest around the same place: texts with one word replaced.
            rest = (i, *words[:i], *words[i + 1 :])
            if places.setdefault(rest, n) != n:
                links.append((places[rest], n))
    whole: dict[tuple, list[int]] = {}
    for n, words in enumerate(texts):
        whole.setdefault(tuple(words), []).append(n)
    for n, words in enumerate(texts):
        if len(words) * (100 - percent) >= 100:
            for i in range(len(words)):
                links += [(other, n) for other in whole.get((*words[:i], *words[i + 1 :]), ())[:1]]
    return links


def short_keys(words: np.ndarray) -> list[int]:
    """Keys of a text of few word hashes; two of which one word differs have one in common."""
    keys = [xxhash.xxh64_intdigest(words.tobytes())]
    for i in range(len(words)):
        rest = np.delete(words, i).tobytes()
        keys += [xxhash.xxh64_intdigest(rest), xxhash.xxh64_intdigest(rest, seed=i + 1)]
    return [key - (1 << 64) if key >> 63 else key for key in keys]


def verified(texts: list[str], percent: int) -> list[tuple[int, int]]:
    """Verified links among the texts of a candidate component, enough to connect all that link.

    All texts are compared by the exact Jaccard of their shingles, through a prefix tree that compares no
    pair already connected; those of few words also word by word.
    """
    words = [plain_words(t) for t in texts]
    links = linked([np.unique(shingle_hashes(w)) for w in words], percent)
    few = [n for n, w in enumerate(words) if len(w) < FEW_WORDS]
    return links + [(few[a], few[b]) for a, b in one_word_links([words[n] for n in few], percent)]


def natural_paragraphs(lines: np.ndarray, least_words: int, joined: bool) -> list[tuple[int, int, int]]:
    """(line, first word, words) of the lines, or joined lines, of at least ``least_words`` words, from
    the line of each word. Lines that are joined follow each other, without a blank or long one between."""
    if not len(lines):
        return []
    firsts = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
    sizes = np.diff(np.concatenate((firsts, [len(lines)])))
    if joined:
        numbers, long = lines[firsts], sizes >= least_words
        # A run of lines ends before a long one, behind one, and where a blank line follows.
        begins = np.concatenate(([True], long[1:] | long[:-1] | (np.diff(numbers) > 1)))
        heads = np.flatnonzero(begins)
        sizes = np.add.reduceat(sizes, heads)
        firsts = firsts[heads]
    kept = sizes >= least_words
    return list(zip(lines[firsts[kept]].tolist(), firsts[kept].tolist(), sizes[kept].tolist()))


def units(hashes: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, and two independent hashes, of the content-defined paragraphs of a text's word hashes
    and their shingles."""
    n = len(hashes)
    if n < max(UNIT, REACH + 4):
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.int32)
    with np.errstate(over="ignore"):
        windows = np.lib.stride_tricks.sliding_window_view(shingles, REACH)
        starts = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
        starts = starts[starts + UNIT <= n]
        other = mixed(hashes + np.uint64(7))
        return (
            starts,
            run_hashes(hashes, starts, starts + UNIT).view(np.int64),
            (run_hashes(other, starts, starts + UNIT) >> np.uint64(33)).astype(np.int32),
        )


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


PARAGRAPH = "struct<position: bigint, start: bigint, n_words: bigint, digest: binary, node: bigint, bands: array<bigint>>"
CUT = f"doc_id long, row long, starts array<int>, classes array<long>, checks array<int>, paragraphs array<{PARAGRAPH}>"


def _cut(docs: DataFrame, least_words: int, joined: bool, with_units: bool) -> DataFrame:
    """The paragraphs of each document. Of equal ones in a batch only the first has its bands."""
    kind = pa.list_(
        pa.struct(
            [
                *((c, pa.int64()) for c in ("position", "start", "n_words")),
                ("digest", pa.binary()),
                ("node", pa.int64()),
                ("bands", pa.list_(pa.int64())),
            ]
        )
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                found, seen, content = [], {}, []
                for text in batch.column("text").to_pylist():
                    rows = []
                    hashes, lines = hashed_words(text)
                    shingles = shingles_of(hashes)
                    for position, start, count in natural_paragraphs(lines, least_words, joined):
                        words = hashes[start : start + count]
                        digest = xxhash.xxh3_128_digest(words.tobytes())
                        row = {"position": position, "start": start, "n_words": count, "digest": digest, "node": _node(digest)}
                        if digest not in seen:
                            row["bands"] = short_keys(words) if count < FEW_WORDS else []
                            # The shingles of the text that lie within the paragraph.
                            within = shingles[start : start + count - 4] if count >= 5 else shingles_of(words)
                            seen[digest] = (row, within)
                        rows.append(row)
                    found.append(rows)
                    if with_units:
                        content.append(units(hashes, shingles))
                if seen:
                    rows, shingles = zip(*seen.values())
                    for row, bands in zip(rows, band_values(signatures(list(shingles))).view(np.int64).tolist()):
                        row["bands"] += bands
                columns = [batch.column("doc_id"), batch.column("row")]
                for place, item in enumerate((pa.int32(), pa.int64(), pa.int32())):
                    lists = [c[place] for c in content] or [None] * batch.num_rows
                    columns.append(pa.array(lists, pa.list_(item)))
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, kind)],
                    names=["doc_id", "row", "starts", "classes", "checks", "paragraphs"],
                )

    return written(_keyed(docs).mapInArrow(cut, CUT), "paragraphs")


def _one_each(cut: DataFrame) -> DataFrame:
    """Rows with equal id and text once. Only their keys are shuffled, and the rows that do repeat."""
    repeated = written(
        cut.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row"))
        .agg(F.count("*").alias("__rows"))
        .filter("__rows > 1")
        .select("__id", "__row"),
        "paragraph-rows",
    )
    if repeated.isEmpty():
        return cut
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row"))
    again = cut.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "row"])
    return written(cut.join(repeated, same, "left_anti").unionByName(again), "paragraphs")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")


def _candidates(occurrences: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the classes that collide with another one in a band."""
    postings = occurrences.filter("bands IS NOT NULL").select("node", F.explode("bands").alias("band"))
    leaders = written(
        postings.groupBy("band")
        .agg(F.min("node").alias("leader"), F.max("node").alias("__last"))
        .filter(F.col("leader") != F.col("__last"))
        .select("band", "leader"),
        "paragraph-leaders",
    )
    edges = postings.join(leaders, "band").filter(F.col("node") != F.col("leader"))
    return components(edges.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "paragraph-candidates")


def _links(docs: DataFrame, occurrences: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between the digests of paragraph classes."""
    sized = written(
        candidates.join(candidates.groupBy("component").agg(F.count("node").alias("__size")), "component").select(
            "node", "component", F.ceil(F.col("__size") / TASK_CLASSES).alias("blocks")
        ),
        "paragraph-candidates",
    )
    tasks = sized.count() // TASK_CLASSES + 1
    block = F.pmod(F.xxhash64("node"), "blocks")
    placed = sized.select(
        "node",
        "component",
        F.when(F.col("blocks") == 1, F.array(F.pmod(F.xxhash64("component"), F.lit(tasks))))
        .otherwise(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                lambda other: F.xxhash64("component", F.least(other, block), F.greatest(other, block)),
            )
        )
        .alias("tasks"),
    )
    # Each class is read again from one document that holds it.
    one_each = (
        occurrences.join(placed.select("node"), "node", "left_semi")
        .groupBy("digest", "node")
        .agg(F.min_by(F.struct("doc_id", "row", "start", "n_words"), F.struct("row", "start")).alias("r"))
        .join(placed, "node")
    )
    wanted = one_each.groupBy(F.col("r.doc_id").alias("__id"), F.col("r.row").alias("__row")).agg(
        F.collect_list(F.struct("r.start", "r.n_words", "digest", "component", "tasks")).alias("wanted")
    )
    keyed = _keyed(docs)
    texts = keyed.join(wanted, keyed["doc_id"].eqNullSafe(F.col("__id")) & (keyed["row"] == F.col("__row")))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of the wanted paragraphs, once for each task."""
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch, rows = whole.slice(at, 1_000), []
                for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                    words = plain_words(text)
                    for w in wanted:
                        part = " ".join(words[w["start"] : w["start"] + w["n_words"]])
                        rows += [(task, w["component"], w["digest"], part) for task in w["tasks"]]
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                    names=["task", "component", "digest", "words"],
                )

    def checked(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, part in frame.groupby("component"):
            # Rows that repeat bring a class twice.
            part = part.drop_duplicates("digest")
            digests = list(part["digest"])
            links += [(digests[a], digests[b]) for a, b in verified(list(part["words"]), percent)]
        return pd.DataFrame(links, columns=["a", "b"])

    laid = texts.select("text", "wanted").mapInArrow(found, "task long, component long, digest binary, words string")
    return written(laid.groupBy("task").applyInPandas(checked, "a binary, b binary"), "paragraph-links")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "position", "start")


def _grouped(docs: DataFrame, cut: DataFrame, percent: int) -> DataFrame:
    """The natural paragraphs that have copies, with the first place of their group."""
    occurrences = cut.select("doc_id", "row", F.inline("paragraphs"))
    links = _links(docs, occurrences, _candidates(occurrences), percent)
    labels = components(links, "paragraph").select(F.col("node").alias("digest"), "component")
    classes = occurrences.groupBy("digest").agg(
        F.count("*").alias("__copies"),
        F.min(_place()).alias("__first"),
        F.min(F.xxhash64("doc_id", "row")).alias("__one"),
        F.max(F.xxhash64("doc_id", "row")).alias("__other"),
    )
    grouped = written(
        classes.join(labels, "digest", "left").withColumn("component", F.coalesce("component", "digest")),
        "paragraph-classes",
    )
    groups = (
        grouped.groupBy("component")
        .agg(
            F.sum("__copies").alias("n_copies"),
            F.min("__first").alias("__first"),
            (F.min("__one") != F.max("__other")).alias("across"),
        )
        .filter("n_copies > 1")
    )
    members = written(
        grouped.select("digest", "component").join(groups, "component").select("digest", "n_copies", "across", "__first"),
        "paragraph-members",
    )
    kept = occurrences.select("doc_id", "row", "position", "start", "n_words", "digest").join(members, "digest")
    own = F.struct("doc_id", "row", "start")
    first = F.struct("__first.doc_id", "__first.row", "__first.start")
    return kept.withColumn("removed", ~own.eqNullSafe(first))


def repeated_paragraphs(docs: DataFrame, least_words: int = 10, percent: int = 80) -> DataFrame:
    """Each line that has copies: ``doc_id``, ``position``, ``n_words``, ``group_doc``,
    ``group_position``, ``n_copies``, ``removed``.

    Lines of at least ``least_words`` words are compared without regard to blanks and to the case of A to
    Z. ``group_doc`` and ``group_position`` name the first line of the group, which is the one that is not
    removed. Repeats within one document, and of whole rows, count like others. Missing, empty and short
    texts give no rows; documents without id sort behind all others; very long texts are cut whole, in
    time in proportion to their words; other columns are not read.
    """
    cut = _cut(docs, least_words, joined=False, with_units=False)
    found = _grouped(docs, cut, percent)
    # Of rows that repeat one is the first, as the rows cannot be told apart: none of them is removed.
    return found.select(
        "doc_id",
        "position",
        "n_words",
        F.col("__first.doc_id").alias("group_doc"),
        F.col("__first.position").alias("group_position"),
        "n_copies",
        "removed",
    )


def _shared_units(cut: DataFrame) -> DataFrame:
    """The content-defined paragraphs that several documents hold, with the first place of each."""
    laid = cut.select(
        "doc_id", "row", F.inline(F.arrays_zip(F.col("starts").alias("start"), F.col("classes").alias("class"), F.col("checks").alias("check")))
    )
    doc = F.xxhash64("doc_id", "row")
    # Combined within tasks first, so a class that many documents hold does no harm.
    shared = written(
        laid.groupBy("class", "check")
        .agg(F.min(doc).alias("__one"), F.max(doc).alias("__other"))
        .filter(F.col("__one") != F.col("__other"))
        .select("class", "check"),
        "passage-classes",
    )
    held = written(laid.join(shared, ["class", "check"]), "passage-units")
    first = held.groupBy("class", "check").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")).alias("__first"),
        F.count("*").alias("n_copies"),
    )
    return held.join(first, ["class", "check"]).select(
        "doc_id",
        "row",
        F.col("start").cast("long").alias("start"),
        F.lit(UNIT).cast("long").alias("n_words"),
        F.col("__first.doc_id").alias("group_doc"),
        F.col("__first.row").alias("group_row"),
        F.col("__first.start").cast("long").alias("group_start"),
        "n_copies",
    )


def repeated_passages(docs: DataFrame, least_words: int = RUN, percent: int = 80) -> DataFrame:
    """Passages that several documents share: ``doc_id``, ``start``, ``n_words``, ``group_doc``,
    ``group_start``, ``n_copies``, ``removed``.

    ``start`` counts the words of the text from 0, over its line ends; words stand between blanks, their
    letters A to Z lowered. Any run of 50 words that two documents share is covered in both, in part at
    least (37 words), and so are natural paragraphs of ``least_words`` words or more that are near copies
    of one in another document. Overlapping finds of a document are one passage. ``group_doc`` and
    ``group_start`` name the first place of a passage's first find: that one is kept, the others are
    removed; what a document keeps and what it loses are passages of their own. A removed passage names
    a place before its own, by document and start, so of each passage the first place stays.
    ``n_copies`` is the largest number of places of a find.

    What only one document repeats is no passage. Rows with equal id and text are one document; documents
    without id are told apart by their text and come behind all others. Missing, empty and short texts
    give no rows; very long texts are cut whole, in time in proportion to their words. An empty table
    gives no rows; other columns are not read.
    """
    cut = _one_each(_cut(docs, least_words, joined=True, with_units=True))
    near = (
        _grouped(docs, cut, percent)
        .filter("across")
        .select(
            "doc_id",
            "row",
            "start",
            "n_words",
            F.col("__first.doc_id").alias("group_doc"),
            F.col("__first.row").alias("group_row"),
            F.col("__first.start").alias("group_start"),
            "n_copies",
        )
    )
    own, first = F.struct("doc_id", "row", "start"), F.struct("group_doc", "group_row", "group_start")
    found = near.unionByName(_shared_units(cut)).withColumn("removed", ~own.eqNullSafe(first))
    # Overlapping finds of a document, kept and removed ones apart.
    apart = ["doc_id", "row", "removed"]
    ahead = Window.partitionBy(*apart).orderBy("start", "n_words").rowsBetween(Window.unboundedPreceding, -1)
    ordered = Window.partitionBy(*apart).orderBy("start", "n_words")
    reached = F.max(F.col("start") + F.col("n_words")).over(ahead)
    begins = F.coalesce(F.col("start") >= reached, F.lit(True)).cast("long")
    islands = found.withColumn("__begins", begins).withColumn("__island", F.sum("__begins").over(ordered))
    place = F.struct("group_doc", "group_start")
    spans = (
        islands.groupBy(*apart, "__island")
        .agg(
            F.min("start").alias("__start"),
            (F.max(F.col("start") + F.col("n_words")) - F.min("start")).alias("__words"),
            F.min_by(place, F.struct("start", "n_words", F.col("group_doc").isNull(), "group_doc", "group_start")).alias("__place"),
            F.max("n_copies").alias("n_copies"),
        )
    )
    # What is the first of near copies may itself be a copy of a place before it.
    end = F.col("__start") + F.col("__words")
    upto = Window.partitionBy("doc_id", "row").orderBy("__start").rangeBetween(Window.unboundedPreceding, 0)
    covered = F.coalesce(F.max(F.when(F.col("removed"), end)).over(upto) >= end, F.lit(False))
    return (
        spans.withColumn("__covered", covered & ~F.col("removed"))
        .filter(~F.col("__covered"))
        .select(
            "doc_id",
            F.col("__start").alias("start"),
            F.col("__words").alias("n_words"),
            "__place.group_doc",
            "__place.group_start",
            "n_copies",
            "removed",
        )
    )
