"""Words, document keys and connected components, shared by the operators of this package.

Columns the operators add while they work begin with ``__``; every operator first selects the
columns it needs, so extra columns of its input cannot clash with its own names.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.session import written

# The blanks of the contracts, [\x20\x09-\x0D], and the letters they lower.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
_TABLE = str.maketrans(UPPER + BLANKS, LOWER + " " * len(BLANKS))
_MULTIPLIERS = tuple(
    np.uint64(m)
    for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
)
#: Bytes that the remembered values of one kind may take in a Python worker, which outlives its tasks.
MOST_REMEMBERED = 64 << 20
_SLOT = 104


class Memo(dict):
    """Values of words, computed once. When they take half of the bytes they are set aside, and taken
    back when they are asked for; what was set aside before is forgotten."""

    def __init__(self, value, most: int = MOST_REMEMBERED):
        super().__init__()
        self.value = value
        self.most = most
        self.held = 0
        self.aside: dict = {}

    def __missing__(self, word):
        found = self.aside.get(word)
        if found is None:
            found = self.value(word)
        self.held += sys.getsizeof(word) + sys.getsizeof(found) + _SLOT
        if self.held > self.most // 2:
            self.aside = dict(self)
            self.clear()
            self.held = 0
        self[word] = found
        return found


class Powers:
    """Powers of an odd number, and of its inverse, modulo 2**64."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.kept = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.kept[0]) < n:
            n = max(n, 2 * len(self.kept[0]))
            with np.errstate(over="ignore"):
                for which, base in enumerate(self.bases):
                    factors = np.full(n, base, np.uint64)
                    factors[0] = 1
                    self.kept[which] = np.multiply.accumulate(factors)
        return self.kept[0], self.kept[1]


_POWERS = Powers(0x9E3779B97F4A7C15)
_BYTES = bytes.maketrans((UPPER + BLANKS).encode(), (LOWER + " " * len(BLANKS)).encode())
#: Bytes of a text that are hashed at once; a longer word is hashed alone.
_AT_ONCE = 1 << 20


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of values, from prefix sums: the same for equal runs, wherever they lie."""
    up, down = _POWERS.upto(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])))
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, A to Z lowered, and the line that it is in; no word becomes a string."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw.translate(_BYTES), np.uint8)
    gap = np.ones(len(data) + 2, np.int8)
    gap[1:-1] = data == 32
    edges = np.flatnonzero(np.diff(gap))
    starts, ends = edges[::2], edges[1::2]
    parts, first = [], 0
    while first < len(starts):
        low = int(starts[first])
        after = max(first + 1, int(np.searchsorted(ends, low + _AT_ONCE, "right")))
        some = slice(first, after)
        values = data[low : ends[after - 1]].astype(np.uint64) + np.uint64(1)
        parts.append(run_hashes(values, starts[some] - low, ends[some] - low))
        first = after
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.searchsorted(breaks, starts)


def words_of(text: str | None) -> list[str]:
    """Words between blanks, A to Z lowered; none for a missing text."""
    return text.translate(_TABLE).split(" ") if text else []


def plain_words(text: str | None) -> list[str]:
    return [w for w in words_of(text) if w]


def word_hashes(words: list[str]) -> np.ndarray:
    """The same hashes from words that are already lowered."""
    return hashed_words(" ".join(words))[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(31))
        values = values * _MULTIPLIERS[0]
        values = values ^ (values >> np.uint64(29))
        values = values * _MULTIPLIERS[1]
        return values ^ (values >> np.uint64(32))


def shingles_of(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of the runs of ``size`` words in their order; of the whole run if there are fewer."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    width = min(size, len(hashes))
    with np.errstate(over="ignore"):
        total = hashes[: len(hashes) - width + 1] * _MULTIPLIERS[0]
        for i in range(1, width):
            total = mixed(total) + hashes[i : len(hashes) - width + 1 + i] * _MULTIPLIERS[i % 5]
        return mixed(total + np.uint64(width))


def shingle_hashes(words: list[str], size: int = 5) -> np.ndarray:
    return shingles_of(word_hashes(words), size)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    hashes = np.sort(shingles_of(hashed_words(text)[0], size))
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else hashes


def crc_remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; -1 for a missing id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % divisor, F.lit(-1)).cast("int")


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for the nodes of ``edges`` (a, b).

    Each round hooks every node to its smallest neighbour and contracts the edges to what the nodes
    were hooked to, so that edges vanish fast; the smallest node of a component is never hooked.
    Rounds are written to the shared folder, so lineage does not grow and a lost executor costs no
    earlier round. Neither edges nor nodes ever reach the driver.
    """

    def contracted(links: DataFrame, label: str) -> DataFrame:
        pair = links.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return written(pair.distinct(), f"{name}-{label}")

    links, found = contracted(edges, "edges"), None
    for _ in range(most_rounds):
        if found is not None and links.isEmpty():
            return found
        ends = links.union(links.select("b", "a"))
        parents = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("__least"))
        hooked = written(parents.select("node", F.least("node", "__least").alias("parent")), f"{name}-hooked")
        up = hooked.select(F.col("node").alias("parent"), F.col("parent").alias("__up"))
        hooked = written(hooked.join(up, "parent").select("node", F.col("__up").alias("parent")), f"{name}-hooked")
        if found is None:
            found = hooked.withColumnRenamed("parent", "component")
        else:
            step = hooked.withColumnRenamed("node", "component")
            found = found.join(step, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            )
        found = written(found, f"{name}-found")
        of_a = hooked.select(F.col("node").alias("a"), F.col("parent").alias("__a"))
        of_b = hooked.select(F.col("node").alias("b"), F.col("parent").alias("__b"))
        moved = links.join(of_a, "a").join(of_b, "b")
        links = contracted(moved.select(F.col("__a").alias("a"), F.col("__b").alias("b")), "edges")
    raise RuntimeError(f"the components did not settle within {most_rounds} rounds")
