"""Exact Jaccard self-join of word n-gram sets with prefix trees, and its components (operator 10).

1. Each text becomes its set of n-gram hashes, in ascending order: one global order. Sets are
   digested; equal sets are one class from here on.
2. Sets of sizes a and b with Jaccard of at least 0.8 differ in at most (a + b) / 9 members. Between
   the members they share, that many gaps are broken. So of the pairs of members that follow each
   other in both sets, one lies within the first 0.4 n + 3 members of each, and ``spare`` of them if
   ``spare`` members more are taken: n / 10 for sets of n members. Small sets use single members too.
3. These keys meet in packed, sorted runs, once for each class and without texts. A key of up to
   FEW classes counts for each pair of them, a more frequent one for each of its classes. Classes that
   cannot reach ``spare`` common keys are no candidates; the others are joined into candidate
   components, a superset of the true ones.
4. The sets of a candidate component meet in one task, several small components together. One that
   is too large for a task is dealt over blocks, and each pair of blocks meets in a task.
5. There, sets are put into a prefix tree in order of size. Each one is first looked up: the walk
   carries the overlap along shared paths, and leaves a subtree when the members that are left, of
   the set or of the longest set below, cannot make up the overlap that the shortest one needs.
   Sets that are already connected are not compared again, so a link is never lost but its component.
6. The components of the links are those of the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.common import components, mixed, shingle_set
from lakeops.session import scratch, written

LARGER = 10  # a partner of a set of up to 8 members, which may share no pair, has up to 10
TASK_DOCS = 1_500
FEW = 16
BUCKETS_BITS = 12  # keys are cut to these bits and 32 more, which costs some candidates only
GROUP_KEYS = 500_000
MOST_HELD = 4_000_000
FILTER_BITS = 25


def _digest(members: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(members.tobytes())


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def needed_overlap(one: int, other: int, percent: int) -> int:
    """The least overlap of two sets with 100 * overlap >= percent * union."""
    return -(-percent * (one + other) // (100 + percent))


class Node:
    """An edge of the tree with the members along it, and what lies below."""

    __slots__ = ("members", "children", "sets", "shortest", "longest")

    def __init__(self, members: np.ndarray, size: int):
        self.members = members
        self.children: dict[int, Node] = {}
        self.sets: list[int] = []
        self.shortest = self.longest = size


class PrefixTree:
    def __init__(self, percent: int):
        self.percent = percent
        self.root = Node(np.empty(0, np.int64), 0)
        self.root.shortest = 1 << 60

    def add(self, number: int, members: np.ndarray) -> None:
        node, at, size = self.root, 0, len(members)
        while True:
            node.shortest, node.longest = min(node.shortest, size), max(node.longest, size)
            if at == size:
                node.sets.append(number)
                return
            child = node.children.get(int(members[at]))
            if child is None:
                leaf = Node(members[at:], size)
                leaf.sets.append(number)
                node.children[int(members[at])] = leaf
                return
            width = min(len(child.members), size - at)
            differ = np.flatnonzero(child.members[:width] != members[at : at + width])
            common = int(differ[0]) if len(differ) else width
            if common < len(child.members):
                upper = Node(child.members[:common], child.shortest)
                upper.longest = child.longest
                child.members = child.members[common:]
                upper.children[int(child.members[0])] = child
                node.children[int(members[at])] = upper
                child = upper
            node, at = child, at + common

    def matches(self, members: np.ndarray, held: np.ndarray, skip) -> Iterator[int]:
        """Sets that reach the threshold with ``members``, whose marks are set in ``held``.

        ``skip`` tells which sets need no comparison.
        """
        size = len(members)
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            for child in node.children.values():
                if child.longest * 100 < self.percent * size:
                    continue
                if not child.children and all(map(skip, child.sets)):
                    continue
                together = overlap + int(np.count_nonzero(held[child.members]))
                deep = depth + len(child.members)
                for number in child.sets:
                    if together >= needed_overlap(size, deep, self.percent) and not skip(number):
                        yield number
                if child.children:
                    own_left = size - int(np.searchsorted(members, child.members[-1], "right"))
                    most = together + min(own_left, child.longest - deep)
                    if most >= needed_overlap(size, max(child.shortest, deep), self.percent):
                        stack.append((child, deep, together))


class Groups:
    """Sets of connected numbers."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def of(self, number: int) -> int:
        parent = self.parent
        while parent[number] != number:
            parent[number] = parent[parent[number]]
            number = parent[number]
        return number

    def join(self, one: int, other: int) -> None:
        self.parent[self.of(one)] = self.of(other)


def linked(sets: list[np.ndarray], percent: int, every: bool = False) -> list[tuple[int, int]]:
    """Links between the sets: enough of them to connect all that are connected, or every one."""
    if len(sets) < 2:
        return []
    vocabulary, local = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(local, np.cumsum([len(s) for s in sets])[:-1])
    held = np.zeros(len(vocabulary), bool)
    tree, groups, links = PrefixTree(percent), Groups(len(sets)), []
    for number in sorted(range(len(parts)), key=lambda n: len(parts[n])):
        members = parts[number]
        held[members] = True
        for other in tree.matches(members, held, lambda n: not every and groups.of(n) == groups.of(number)):
            groups.join(other, number)
            links.append((number, other))
        held[members] = False
        tree.add(number, members)
    return links


def spare(size: int, percent: int) -> int:
    """So many keys at least do two sets that link have in common, if neither is smaller than ``size``."""
    return max(1, size // 10) if percent >= 80 else 1


def search_keys(members: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which two sets that link have ``spare`` of the smaller one in common at least."""
    size = len(members)
    missing = prefix_length(size, percent) - 1
    # With x members missing in the other set and y of its own, x + y gaps are broken, and x members
    # may lie between: ``spare`` pairs end within 2 x + y + 1 + spare members, and 2 x + y exceeds twice
    # the most that can be missing by one at most.
    reach = 2 * missing + 2 + spare(size, percent)
    with np.errstate(over="ignore"):
        keys = mixed(members[: min(reach, size) - 1] * np.uint64(3)) + members[1:reach] if size > 1 else members[:0]
        if size <= LARGER:
            keys = np.concatenate((keys, mixed(members[: missing + 1] + np.uint64(1))))
        return mixed(keys)


def pack_keys(keys: list[np.ndarray], rows: list[int]) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, number of keys, packed keys and rows) of the leading bits of each row's keys."""
    numbers = np.repeat(np.array(rows, np.uint32), [len(k) for k in keys])
    values = np.concatenate(keys) >> np.uint64(32 - BUCKETS_BITS)
    order = np.argsort(values)
    values, numbers = values[order], numbers[order]
    buckets = (values >> np.uint64(32)).astype(np.int64)
    low = values.astype(np.uint32)
    firsts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    steps = np.diff(low, prepend=np.uint32(0))
    steps[firsts] = low[firsts]
    for first, end in zip(firsts.tolist(), [*firsts[1:].tolist(), len(values)]):
        # Bytes of one weight lie together: the upper ones of small steps and rows are mostly zero.
        both = np.stack((steps[first:end], numbers[first:end]))
        planes = np.ascontiguousarray(both.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1))
        yield int(buckets[first]), end - first, zlib.compress(planes.tobytes(), 1)


def unpack_keys(count: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The lower 32 bits of the keys of a bucket, and their rows."""
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(2, 4, count)
    steps, numbers = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32)[:, :, 0]
    return np.cumsum(steps, dtype=np.uint32), numbers


def _key_table(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A row for each document: its set's size and digest, and a number ``row`` if its keys are here.

    Each task leaves the keys of a set once. Rows without ``n`` hold them, packed by bucket: the keys of
    rows ``base`` + i.
    """
    names = ["doc_id", "text_hash", "n", "digest", "row", "bucket", "base", "count", "packed"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, given, held, seen = TaskContext.get().partitionId() << 32, 0, 0, set()
        keys, rows = [], []

        def packed() -> pa.RecordBatch:
            found = list(pack_keys(keys, rows)) if keys else []
            columns = [[b for b, _, _ in found], [base] * len(found), [c for _, c, _ in found], [p for _, _, p in found]]
            own = [pa.array(c, k) for c, k in zip(columns, kinds[5:])]
            return pa.RecordBatch.from_arrays([pa.nulls(len(found), k) for k in kinds[:5]] + own, names=names)

        for batch in batches:
            counts, digests, numbers = [], [], []
            for text in batch.column("text").to_pylist():
                members = shingle_set(text, size)
                digest, number = _digest(members), None
                if len(members) and digest not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(digest)
                    keys.append(search_keys(members, percent))
                    rows.append(given)
                    number, given, held = base + given, given + 1, held + len(keys[-1])
                counts.append(len(members))
                digests.append(digest)
                numbers.append(number)
                if held > MOST_HELD:
                    yield packed()
                    keys.clear()
                    rows.clear()
                    held = 0
            own = [batch.column("doc_id"), batch.column("text_hash")]
            own += [pa.array(c, k) for c, k in zip((counts, digests, numbers), kinds[2:])]
            yield pa.RecordBatch.from_arrays(own + [pa.nulls(len(counts), k) for k in kinds[5:]], names=names)
        yield packed()

    schema = "doc_id long, text_hash long, n long, digest binary, row long, bucket long, base long, count long, packed binary"
    return written(docs.mapInArrow(keyed, schema), "ngram-keys")


def _repeated_rows(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each task a bitmap of its rows whose class has its keys in an earlier row: a bit a document."""

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        places = frame["row"].to_numpy() & 0xFFFFFFFF
        bits = np.zeros(int(places.max()) + 1, bool)
        bits[places] = True
        return pd.DataFrame({"task": frame["task"][:1], "bits": [zlib.compress(np.packbits(bits).tobytes(), 1)]})

    rows = classes.filter("row IS NOT NULL").groupBy("digest").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    later = rows.filter(F.size("rows") > 1).select(F.explode(F.expr("slice(rows, 2, size(rows))")).alias("row"))
    tasks = later.withColumn("task", F.shiftright("row", 32)).groupBy("task")
    found = tasks.applyInPandas(packed, "task long, bits binary").collect()
    return {r["task"]: np.unpackbits(np.frombuffer(zlib.decompress(r["bits"]), np.uint8)).astype(bool) for r in found}


def common_keys(keys: np.ndarray, rows: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``a``, ``b``, ``often``, ``hits``: keys that pairs of rows share, a < b.

    A key of more than ``few`` rows gives each row a, the smallest row b and ``often`` instead.
    """
    order = np.lexsort((rows, keys))
    keys, rows = keys[order], rows[order]
    firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    holders = np.diff(np.append(firsts, len(keys)))
    names, places = np.unique(rows, return_inverse=True)
    places = places.astype(np.int64)
    long = np.repeat(holders, holders) > few
    ones, others = [], []
    for count in range(2, few + 1):
        runs = places[firsts[holders == count][:, None] + np.arange(count)]
        for i in range(count):
            for j in range(i + 1, count):
                ones.append(runs[:, i])
                others.append(runs[:, j])
    result = []
    stars = (places[long], np.repeat(places[firsts], holders)[long])
    for often, (one, other) in enumerate(((np.concatenate(ones), np.concatenate(others)), stars)):
        if not often:
            one, other = one[one != other], other[one != other]
        pairs, hits = np.unique(one * len(names) + other, return_counts=True)
        a, b = np.divmod(pairs, max(1, len(names)))
        result.append((names[a], names[b], np.full(len(pairs), bool(often)), hits))
    return tuple(np.concatenate(x) for x in zip(*result))


def _common_keys(table: DataFrame, repeated: dict[int, np.ndarray]) -> DataFrame:
    """``a``, ``b``, ``often``, ``hits`` of ``common_keys`` over all rows but the repeated ones."""
    spark = table.sparkSession
    left_out = spark.sparkContext.broadcast(repeated)
    packed = table.filter("n IS NULL").select("bucket", "base", "count", "packed")
    total = packed.agg(F.sum("count")).first()[0] or 0
    groups = min(1 << BUCKETS_BITS, max(256, total // GROUP_KEYS))

    def shared(frame: pd.DataFrame) -> pd.DataFrame:
        keys, rows = [], []
        for bucket, base, count, packed in zip(frame["bucket"], frame["base"], frame["count"], frame["packed"]):
            low, numbers = unpack_keys(count, packed)
            bits = left_out.value.get(base >> 32)
            if bits is not None:
                known = numbers[numbers < len(bits)]
                alone = np.ones(len(numbers), bool)
                alone[numbers < len(bits)] = ~bits[known]
                low, numbers = low[alone], numbers[alone]
            keys.append(low.astype(np.int64) + (bucket << 32))
            rows.append(numbers.astype(np.int64) + base)
        found = common_keys(np.concatenate(keys), np.concatenate(rows), FEW)
        return pd.DataFrame(dict(zip(("a", "b", "often", "hits"), found)))

    group = F.expr(f"shiftright(bucket * {groups}, {BUCKETS_BITS})")
    found = packed.groupBy(group).applyInPandas(shared, "a long, b long, often boolean, hits long")
    return written(found.groupBy("a", "b", "often").agg(F.sum("hits").alias("hits")), "ngram-common")


def _candidates(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``text_hash``, ``n``, ``digest``, ``row`` of each document; ``row`` and ``component`` of
    the classes that have enough keys in common with others."""
    with scratch(docs.sparkSession) as outer:
        table = _key_table(docs, size, percent)
        names = ["doc_id", "text_hash", "n", "digest", "row"]
        classes = written(table.filter("n IS NOT NULL").select(*names), "ngram-classes", outer)
        common = _common_keys(table, _repeated_rows(classes))
        sizes = classes.filter("row IS NOT NULL").select("row", "n")
        least = F.ceil(F.col("n") * percent / 100)
        enough = F.greatest(F.lit(1), F.floor(least / 10)) if percent >= 80 else F.lit(1)
        # Of its frequent keys a row may lose as many as leave one in common, if the other loses as many.
        weakest = Window.partitionBy("a").orderBy("hits", "b").rowsBetween(Window.unboundedPreceding, 0)
        stars = written(
            common.filter("often")
            .join(sizes.withColumnRenamed("row", "a"), "a")
            .withColumn("__all", F.sum("hits").over(Window.partitionBy("a")))
            .filter(F.col("__all") >= enough)
            .withColumn("__lost", F.sum("hits").over(weakest))
            .filter(F.col("__lost") > F.floor((enough - 1) / 2))
            .select("a", "b"),
            "ngram-frequent",
        )
        frequent = common.filter("often").groupBy("a").agg(F.sum("hits").alias("often"))
        known = sizes.join(frequent.withColumnRenamed("a", "row"), "row", "left").select(
            "row", "n", F.coalesce("often", F.lit(0)).alias("often")
        )
        pairs = (
            common.filter("NOT often")
            .select("a", "b", "hits")
            .join(known.toDF("a", "__n", "__often"), "a")
            .join(known.toDF("b", "__m", "__other"), "b")
            .withColumns({"__less": F.least("__n", "__m"), "__more": F.greatest("__n", "__m")})
            .filter(F.col("__less") * 100 >= F.col("__more") * percent)
        )
        needed = F.greatest(F.lit(1), F.floor(F.col("__less") / 10)) if percent >= 80 else F.lit(1)
        pairs = written(
            pairs.filter(F.col("hits") + F.least("__often", "__other") >= needed).select("a", "b"), "ngram-near"
        )
        # The smallest row of a frequent key may be none that can link: it joins others only.
        linking = stars.select("a").union(pairs.select("a")).union(pairs.select("b")).distinct()
        joined = components(stars.union(pairs), "ngram-candidates").withColumnRenamed("node", "row")
        candidates = written(joined.join(linking.withColumnRenamed("a", "row"), "row"), "ngram-candidates", outer)
    return classes, candidates


def _among(chosen: DataFrame):
    """A filter by ``text_hash`` that passes all texts of ``chosen`` and few others, of a fixed size."""
    wide = 1 << (FILTER_BITS - 8)

    def set_bits(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(wide, bool)
        bits[frame["place"].to_numpy() % wide] = True
        return pd.DataFrame({"range": frame["range"][:1], "bits": [zlib.compress(np.packbits(bits).tobytes(), 1)]})

    places = chosen.select(F.expr(f"pmod(text_hash, {1 << FILTER_BITS})").alias("place")).distinct()
    ranges = places.withColumn("range", F.expr(f"place div {wide}")).groupBy("range")
    result = np.zeros((1 << 8, wide // 8), np.uint8)
    for row in ranges.applyInPandas(set_bits, "range long, bits binary").collect():
        result[row["range"]] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    held = chosen.sparkSession.sparkContext.broadcast(result.ravel())

    @F.pandas_udf("boolean")
    def among(hashes: pd.Series) -> pd.Series:
        at = hashes.to_numpy() % (1 << FILTER_BITS)
        return pd.Series((held.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    return among


def _links(
    docs: DataFrame, classes: DataFrame, candidates: DataFrame, size: int, percent: int, every: bool = False
) -> DataFrame:
    """Links (a, b) between the digests of classes; some may come twice."""
    sizes = candidates.groupBy("component").agg(F.count("row").alias("__size")).filter("__size > 1")
    sized = written(
        candidates.join(sizes, "component").select(
            "row", "component", F.ceil(F.col("__size") / TASK_DOCS).alias("blocks")
        ),
        "ngram-candidates",
    )
    tasks = sized.count() // TASK_DOCS + 1
    block = F.pmod(F.xxhash64("row"), "blocks")
    # A component of one block shares a task with others; else a class goes to each pair with its block.
    placed = sized.select(
        "row",
        "component",
        F.explode(
            F.when(F.col("blocks") == 1, F.array(F.pmod(F.xxhash64("component"), F.lit(tasks)))).otherwise(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                    lambda other: F.xxhash64("component", F.least(other, block), F.greatest(other, block)),
                )
            )
        ).alias("task"),
    )
    chosen = written(
        classes.join(sized.select("row"), "row").select(
            "row", "digest", F.col("doc_id").alias("__id"), "text_hash"
        ),
        "ngram-chosen",
    )
    # Only the texts of candidates travel.
    some = docs.filter(_among(chosen)("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    texts = some.join(chosen.withColumnRenamed("text_hash", "__hash").join(placed, "row"), same).select(
        "task", "component", "digest", "text"
    )

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, part in frame.groupby("component"):
            part = part.drop_duplicates("digest")
            sets = [shingle_set(text, size) for text in part["text"]]
            digests = list(part["digest"])
            found += [(digests[one], digests[other]) for one, other in linked(sets, percent, every)]
        return pd.DataFrame(found, columns=["a", "b"])

    return written(texts.groupBy("task").applyInPandas(joined, "a binary, b binary"), "ngram-links")


def _labelled(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles`` and ``component_id`` of each row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "text_hash", F.xxhash64("text")
    )
    classes, candidates = _candidates(narrow, size, percent)
    links = _links(narrow, classes, candidates, size, percent)
    joined = components(links, "ngram").withColumnRenamed("node", "digest")
    smallest = classes.groupBy("digest").agg(F.min("doc_id").alias("__least")).join(joined, "digest")
    of_component = smallest.groupBy("component").agg(F.min("__least").alias("__least"))
    named = written(joined.join(of_component, "component").select("digest", "__least"), "ngram-named")
    alone = classes.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("__own"))
    labels = written(
        alone.join(named, "digest", "left").select(
            "digest", F.coalesce("__least", "__own").alias("component_id")
        ),
        "ngram-labels",
    )
    rows = classes.select("doc_id", "text_hash", "n", "digest")
    return rows.join(labels, "digest", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs``.

    Two texts link when 100 * intersection >= percent * union of their sets of ``size``-word n-grams;
    a shorter text is one n-gram. A missing text, or one without words, has no n-gram and links with
    nothing. ``component_id`` is the smallest id that is reached; rows without id take part and are
    named by the smallest id of the others, or by none. Repeated rows are equal texts. Only ``doc_id``
    and ``text`` are read; an empty table gives no rows.
    """
    return _labelled(docs, size, percent).drop("text_hash")


def jaccard_links(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The join itself: members ``doc_id``, ``n_shingles``, ``class``, ``n_links``; pairs ``a``, ``b``.

    A class holds the rows with one set of n-grams; ``class``, ``a`` and ``b`` are its digest. Every pair
    of different classes that link comes once, the smaller digest first, so no link between different
    texts is lost and copies are not expanded. ``n_links`` counts the links of a class. Rows without
    n-grams have a class that links with nothing. Odd rows are as for ``jaccard_components``, whose
    groups are the components of these pairs.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "text_hash", F.xxhash64("text")
    )
    classes, candidates = _candidates(narrow, size, percent)
    found = _links(narrow, classes, candidates, size, percent, every=True)
    pairs = written(
        found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ngram-pairs"
    )
    ends = pairs.select("a").union(pairs.select("b"))
    counts = ends.groupBy(F.col("a").alias("digest")).agg(F.count("*").alias("n_links"))
    members = classes.join(counts, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("digest").alias("class"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return members, pairs


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each stays.

    Rows without id stay only when no document with an id is in their component.
    """
    found = _labelled(docs, size, percent)
    dropped = written(
        found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .distinct(),
        "ngram-dropped",
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(dropped, same, "left_anti")
