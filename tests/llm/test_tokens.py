from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lakeops.llm import packing, token_files, tokens, transducer
from lakeops.llm.tokens import WordTokenizer, default_path
from lakeops.session import scratch_path

from .conftest import sentence

LIBRARY = Tokenizer.from_file(default_path())
WORDS, MACHINE = WordTokenizer(default_path()), transducer.Transducer(default_path())
SMALL = WordTokenizer(default_path(), most=2_000)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(st.sampled_from("thea'sdll Σσçé\n\t1!<|endoftext|>")), st.integers(1, 9))
def test_ids_and_counts_are_the_library_s(text, chunk):
    expected = library_ids(text)
    assert np.frombuffer(WORDS.ids(text), "<u4").tolist() == expected
    assert transducer.count_tokens(MACHINE, text) == len(expected)
    if "<|" not in text:
        assert transducer.count_tokens(MACHINE, text, chunk) == len(expected)


PARTS = [*"thea'sdlrv \n\x00!1é漢", "'re", "'ll", "!'s", "''t", "ſ", "Σ", "e\u0301", "\u2003", "𝒳", "x" * 15, "y" * 16, "éé" * 5]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS + ["<|endoftext|>"]), max_size=30).map("".join) | st.none(), max_size=8))
def test_ids_of_many_texts_are_the_library_s(texts):
    for encoder in (WORDS, SMALL, SMALL):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.ids_of(texts)]
        assert found == [library_ids(t) for t in texts]


def test_a_long_text_is_cut_at_blanks_only(monkeypatch):
    monkeypatch.setattr(tokens, "AT_ONCE", 7)
    text = "it's a long-winded text\u2003of wörds, undividedpieces and\tblanks " * 5 + "x" * 40
    for some in ([text], [text, "", None, "a", text.upper()]):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in WORDS.ids_of(some)] == [library_ids(t) for t in some]


def test_as_many_pieces_as_a_worker_meets_are_encoded_once():
    encoder, calls = WordTokenizer(default_path()), []

    class Counted:
        def tokenize(self, piece, model=encoder.model):
            calls.append(piece)
            return model.tokenize(piece)

    encoder.model = Counted()
    letters = "abcdefghijklmnopqrst"
    words = ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=5), 400_000)]
    for _ in range(2):
        for first in range(0, len(words), 10_000):
            encoder.ids(" ".join(words[first : first + 10_000]))
    assert len(calls) == len(words)


def test_special_strings_survive_chunks():
    text = "word <|endoftext|> x<|startoftext|>y " * 9
    assert all(transducer.count_tokens(MACHINE, text, c) == len(library_ids(text)) for c in range(1, 60))


def test_counts_of_whole_tables(spark, documents, odd_rows):
    rows = transducer.token_counts(documents(odd_rows)).collect()
    expected = sorted(
        (str(i), len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 2048) for i, t in odd_rows
    )
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in rows) == expected
    assert transducer.token_counts(documents([])).count() == 0


def test_token_files_round_trip(spark, documents, odd_rows):
    path = scratch_path(spark, "test")
    token_files.write_token_files(documents(odd_rows).repartition(5), path)
    rows = token_files.digests(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    place = 0
    texts = {}
    for i, text in odd_rows:
        ids = np.array([*library_ids(text), 2], "<u4")
        texts.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in rows:
        assert r.start == place and (r.n_tokens, r.ids_crc32) in texts[r.doc_id]
        place += r.n_tokens
    some = token_files.read_tokens(spark, path, 4, 6).collect()
    assert {r.doc_id: list(r.ids) for r in some} == {i: [*library_ids(t), 2] for i, t in odd_rows if i in (4, 5, 6)}
    assert "ids" not in token_files.read_lengths(spark, path).columns
    empty = scratch_path(spark, "test")
    token_files.write_token_files(documents([]), empty)
    assert token_files.digests(spark, empty).count() == 0


def check_packing(rows, source, window):
    """Each id in one piece, sequences gapless, and no padding but of odd tails."""
    sequences, parts = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        parts.setdefault(r.doc_id, []).append(r)
    for pieces in sequences.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place and length > 0
            place += length
        assert place == window or (place < window and place & (place - 1) == 0)
    wanted = {}
    for i, text in source:
        wanted.setdefault(i, []).append(np.array([*library_ids(text), 1], "<u4"))
    assert set(parts) == set(wanted)
    for i, texts in wanted.items():
        if len(texts) == 1:
            place = 0
            for r in sorted(parts[i], key=lambda r: r.start):
                assert r.start == place and r.doc_tokens == len(texts[0])
                assert r.ids_crc32 == zlib.crc32(texts[0][place : place + r.length].tobytes())
                place += r.length
            assert place == len(texts[0])
        else:
            assert sum(r.length for r in parts[i]) == sum(map(len, texts))


@pytest.mark.parametrize("shard_bytes", [1 << 20, 3_000])
def test_packing_is_whole(spark, documents, odd_rows, shard_bytes):
    rows = packing.pack(documents(odd_rows), window=256, shard_bytes=shard_bytes).collect()
    check_packing(rows, odd_rows, 256)
    assert packing.pack(documents([])).count() == 0


def test_neighbours_share_words():
    tokens = [np.array(ids, "<u4") for ids in ([1, 2, 3], [9, 8, 7], [2, 3, 4], [5, 6, 7], [9, 9, 5])]
    unused = np.array([False, True, True, True, True])
    assert packing.Index(tokens).neighbours(0, unused)[0] == 2
    unused[2] = False
    assert 2 not in packing.Index(tokens).neighbours(0, unused)


def test_scores_are_bm25_whatever_documents_are_left():
    random = np.random.default_rng(7)
    documents = [np.minimum(random.zipf(1.3, random.integers(1, 60)), 400).astype("<u4") for _ in range(90)]
    index, terms = packing.Index(documents), [dict(zip(*np.unique(d, return_counts=True))) for d in documents]
    held = {t: sum(t in d for d in terms) for t in range(1, 401)}
    mean = np.mean([len(d) for d in documents])

    def score(seed, doc):
        norm = packing.K1 * (1 - packing.B + packing.B * len(documents[doc]) / mean)
        found = [(terms[doc][t], held[t]) for t in terms[seed] if t in terms[doc]]
        return sum(n / (n + norm) * max(np.log((90 - h + 0.5) / (h + 0.5)), 0) for n, h in found)

    unused = np.ones(90, bool)
    assert len(index.dense) and len(index.docs)
    for gone in (0, 30, 70):
        unused[:gone] = False
        index.without(unused)
        assert set(index.docs) <= set(range(gone, 90)) and index.dense.shape[1] == 90 - gone
        for seed in (0, gone, 89):
            left = np.flatnonzero(unused)
            assert index.scores(seed, 90)[left] == pytest.approx([score(seed, d) for d in left], rel=1e-5, abs=1e-6)
            assert sorted(index.neighbours(seed, unused)) == left.tolist()


def test_distinct_terms_of_many_documents(monkeypatch):
    monkeypatch.setattr(packing, "AT_ONCE", 50)
    random = np.random.default_rng(8)
    documents = [random.integers(0, 30, random.integers(1, 80)).astype("<u2") for _ in range(40)]
    found = [
        (terms[a:b].tolist(), times[a:b].tolist())
        for terms, times, bounds in packing.distinct(documents)
        for a, b in zip(bounds[:-1], bounds[1:])
    ]
    assert found == [tuple(x.tolist() for x in np.unique(d, return_counts=True)) for d in documents]


def test_corpus_statistics_weigh_the_terms_of_a_shard():
    tokens = [np.array(ids, "<u4") for ids in ([1, 2], [1, 3], [2, 4], [5, 6])]
    unused = np.array([False, True, True, True])
    idf = packing.inverse_frequency(1_000, np.array([0, 400, 3, 2, 2, 2, 2]))
    assert packing.Index(tokens, idf, 2.0).neighbours(0, unused)[0] == 2
    idf = packing.inverse_frequency(1_000, np.array([0, 3, 400, 2, 2, 2, 2]))
    assert packing.Index(tokens, idf, 2.0).neighbours(0, unused)[0] == 1


def test_neighbours_meet_in_a_table_of_many_shards(spark, documents):
    topics = [[f"{a}{b}" for a in sentence(t, 12).split() for b in ("ing", "er", "ly")] for t in range(30)]
    chance = np.random.default_rng(4)
    rows = [(i, " ".join(chance.choice(topics[i % 30], 60))) for i in range(600)]
    found = packing.pack(documents(rows), window=512, shard_bytes=16_000).collect()
    check_packing(found, rows, 512)
    held = {}
    for r in found:
        held.setdefault(r.sequence_id, set()).add(r.doc_id)
    same = [len({i for i in ids if i % 30 == doc % 30}) - 1 for ids in held.values() for doc in ids if len(ids) > 1]
    others = [len(ids) - 1 for ids in held.values() for _ in ids if len(ids) > 1]
    assert len({s >> 32 for s in held}) >= 10 and sum(same) >= 0.6 * sum(others)
