"""Token counts of texts by a transducer compiled from a byte-pair tokenizer (operator 6).

The merges of the tokenizer are compiled, state by state as texts need them, into a deterministic
transducer over the letters of a piece. A state knows, for each place where a longer token could
still begin, the last token before that place and how many tokens less had been counted there; that
is finite, and all that later letters can depend on. Each transition carries the change of the
number of emitted tokens, and the end of a piece has an emission of its own, since the last letter
is a symbol of its own in such a tokenizer.

A chunk of text is a map of states: whatever state it starts in, the first blank ends the running
word, so the map is known from the letters before the first blank, the count of the words between,
and the letters after the last blank. Such maps compose associatively; long texts are cut into
chunks whose maps are combined pairwise, level by level.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import BLANKS, Memo
from lakeops.llm.tokens import (
    WORD_END,
    byte_letters,
    default_path,
    pieces_of,
    spelled,
)

CHUNK = 1 << 16
BLANK = re.compile(r"[\t-\r ]")
MOST_STATES = 150_000


class Transducer:
    """Emitted-token counts of one tokenizer file; states are compiled when first reached."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.special = [t["content"] for t in content["added_tokens"]]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        letters = set(byte_letters())
        self.tokens = {*model["vocab"], *letters, *(c + WORD_END for c in letters)}
        self.open = {""}
        for token in self.tokens:
            symbols = token.removesuffix(WORD_END)
            self.open.update(symbols[:k] for k in range(1, len(symbols)))
        self.agrees = Memo(self._agrees)
        self.pieces = Memo(self._piece)
        self._reset()

    def _reset(self) -> None:
        start = ("", ((0, None, 0),))
        self.states = [start]
        self.numbers = {start: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.ends: dict[tuple[int, str], int] = {}

    def _merged(self, text: str) -> list[str]:
        """What the merges make of a string of letters, the last of which may end a word."""
        body = text.removesuffix(WORD_END)
        symbols = list(body)
        if body != text:
            symbols[-1] += WORD_END
        while len(symbols) > 1:
            ranks = [self.ranks.get(pair, len(self.ranks)) for pair in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == len(self.ranks):
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _agrees(self, pair: tuple[str | None, str]) -> bool:
        """Whether a token may follow another one; None stands for the beginning of a piece."""
        before, token = pair
        return self._merged((before or "") + token) == ([token] if before is None else [before, token])

    def _token_to(self, state: tuple, ending: str) -> tuple[str, int, str]:
        """The token that ends with a letter, the change of the count, and the letters before it."""
        run, places = state
        for length, last, count in places:
            token = run[len(run) - length :] + ending
            if token in self.tokens and self.agrees[(last, token)]:
                return token, count + 1
        raise ValueError(f"no token of the vocabulary ends {run + ending!r}")

    def _move(self, number: int, letter: str) -> tuple[int, int]:
        run, places = self.states[number]
        token, change = self._token_to((run, places), letter)
        longer = run + letter
        kept = tuple(
            (length + 1, last, count - change)
            for length, last, count in places
            if longer[len(longer) - length - 1 :] in self.open
        ) + ((0, token, 0),)
        following = (longer[len(longer) - kept[0][0] :], kept)
        if following not in self.numbers:
            self.numbers[following] = len(self.states)
            self.states.append(following)
            self.moves.append({})
        step = self.moves[number][letter] = (self.numbers[following], change)
        return step

    def _piece(self, piece: str) -> int:
        letters = spelled(piece)
        state = total = 0
        for letter in letters[:-1]:
            state, change = self.moves[state].get(letter) or self._move(state, letter)
            total += change
        last = (state, letters[-1])
        end = self.ends.get(last)
        if end is None:
            end = self.ends[last] = self._token_to(self.states[state], letters[-1] + WORD_END)[1]
        return total + end

    def count(self, text: str) -> int:
        """Tokens of a text that begins and ends with whole words."""
        if "<|" in text:
            for special in self.special:
                if special in text:
                    parts = text.split(special)
                    return len(parts) - 1 + sum(map(self.count, parts))
        if len(self.states) > MOST_STATES:
            self._reset()
        return sum(map(self.pieces.__getitem__, pieces_of(text, self.path)))


class ChunkMap(NamedTuple):
    """A chunk as a map of states: head, words counted between, tail; ``tail`` None without a blank."""

    head: str
    count: int
    tail: str | None


def chunk_map(machine: Transducer, chunk: str) -> ChunkMap:
    blank = BLANK.search(chunk)
    if blank is None:
        return ChunkMap(chunk, 0, None)
    first, last = blank.start(), max(map(chunk.rfind, BLANKS))
    return ChunkMap(chunk[:first], machine.count(chunk[first:last]), chunk[last + 1 :])


def composed(machine: Transducer, first: ChunkMap, second: ChunkMap) -> ChunkMap:
    if first.tail is None:
        return ChunkMap(first.head + second.head, second.count, second.tail)
    if second.tail is None:
        return ChunkMap(first.head, first.count, first.tail + second.head)
    between = machine.count(first.tail + second.head)
    return ChunkMap(first.head, first.count + between + second.count, second.tail)


def count_tokens(machine: Transducer, text: str | None, chunk: int = CHUNK) -> int:
    """The number of tokens of a text; its chunk maps are combined pairwise, level by level."""
    text = text or ""
    maps = [chunk_map(machine, text[i : i + chunk]) for i in range(0, max(1, len(text)), chunk)]
    while len(maps) > 1:
        pairs = [composed(machine, *maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
        maps = pairs + maps[len(maps) // 2 * 2 :]
    head, count, tail = maps[0]
    return machine.count(head) + count + machine.count(tail or "")


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per Python worker, so that its states outlive a task."""
    return Transducer(path)


def token_counts(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``, one row per document.

    A missing or empty text has no bytes and no tokens. Repeated rows and missing ids are counted as
    they come, an empty table gives no rows, other columns are not read.
    """
    file = path or default_path()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(file)
        for batch in batches:
            counts = [count_tokens(machine, text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    known = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes")
    )
    return known.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
