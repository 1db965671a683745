from __future__ import annotations

import hashlib
import os
import pickle
import random

import numpy as np
import pytest

from lakeops import session
from lakeops.llm import common, lines, ngram_join, paragraphs

from .conftest import sentence


def lowered(text):
    return (text or "").translate(str.maketrans(common.UPPER, common.LOWER))


def split_words(text):
    for blank in common.BLANKS:
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def shingles(text, size=5):
    words = split_words(lowered(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_components(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    groups = ngram_join.Groups(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                groups.join(i, j)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            root = groups.of(n)
            least[root] = min(i, least.get(root, i))
    return [(i, len(sets[n]), least.get(groups.of(n))) for n, (i, _) in enumerate(rows)]


def varied(base: str, edits: int, seed: int) -> str:
    chance, words = random.Random(seed), base.split(" ")
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"w{chance.randrange(10**6)}"
    return " ".join(words)


def test_hashed_words_are_those_of_the_text(monkeypatch):
    texts = [sentence(1, 50), "A a\x0bB\tb  C\n\nc d", " ", "", None, "é É ö日 日ö", "x" * 3_000 + " y " + "x" * 3_000, "ab a b ab\x00 ab"]
    for most in (1 << 20, 16):
        monkeypatch.setattr(common, "_AT_ONCE", most)
        seen = {}
        for text in texts:
            hashes, lines = common.hashed_words(text)
            words = common.plain_words(text)
            assert len(hashes) == len(lines) == len(words)
            assert lines.tolist() == [n for n, line in enumerate((text or "").split("\n")) for _ in common.plain_words(line)]
            for word, found in zip(words, hashes.tolist()):
                assert seen.setdefault(word, found) == found
        assert len(set(seen.values())) == len(seen)


def test_memo_stays_within_its_bytes():
    asked = []
    memo = common.Memo(lambda w: asked.append(w) or w * 2, most=20_000)
    for n in range(5_000):
        assert memo[f"w{n % 700}"] == f"w{n % 700}" * 2 and memo["often"] == "oftenoften"
        assert len(memo) + len(memo.aside) < 200
    assert asked.count("often") < 5


def near_copies():
    rows = [(100 + i, varied(sentence(50 + i % 4, 60), i % 5, i)) for i in range(60)]
    passage = sentence(7, 30)
    rows += [(200 + i, sentence(300 + i, 12) + " " + passage) for i in range(20)]
    return rows


@pytest.mark.parametrize("task_docs", [1_500, 7])
def test_components_agree_with_all_pairs(spark, documents, odd_rows, monkeypatch, task_docs):
    monkeypatch.setattr(ngram_join, "TASK_DOCS", task_docs)
    rows = odd_rows + near_copies()
    found = ngram_join.jaccard_components(documents(rows)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute_components(rows)))


def test_one_of_each_group_stays(spark, documents, odd_rows):
    rows = odd_rows + near_copies()
    kept = ngram_join.one_of_each(documents(rows))
    assert kept.columns == ["doc_id", "text", "block", "key"]
    expected = sorted(
        str((i, t)) for (i, t), (_, _, component) in zip(rows, brute_components(rows)) if i == component
    )
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == expected
    assert ngram_join.jaccard_components(documents([])).count() == 0


def test_prefix_tree_finds_every_link_of_random_sets():
    chance = np.random.default_rng(3)
    base = [np.sort(chance.choice(400, chance.integers(5, 40), replace=False)) for _ in range(30)]
    sets = [np.sort(np.unique(np.concatenate((b[chance.random(len(b)) > 0.1], chance.choice(400, 2))))) for b in base for _ in range(6)]
    groups, expected = ngram_join.Groups(len(sets)), ngram_join.Groups(len(sets))
    for a, b in ngram_join.linked(sets, 80):
        groups.join(a, b)
    for i, a in enumerate(sets):
        for j in range(i):
            together = len(np.intersect1d(a, sets[j]))
            if 100 * together >= 80 * (len(a) + len(sets[j]) - together):
                expected.join(i, j)

    def named(g):
        first = {}
        return [first.setdefault(g.of(i), i) for i in range(len(sets))]

    assert named(groups) == named(expected)


def brute_lines(rows):
    key = lambda line: lowered(line.strip(common.BLANKS))
    docs = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                docs.setdefault(key(line), set()).add(i)
    order = lambda i: -1 if i is None else i
    last = {k: max(d, key=order) for k, d in docs.items() if len(d) >= 3}
    result = []
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if key(x) not in last or last[key(x)] == i]
        result.append((i, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return result


def test_lines_agree_with_brute_force(spark, documents, odd_rows):
    often = "This line is found in Many Documents"
    rows = odd_rows + [
        (20 + i, "\n".join(([sentence(i, 9)] * (i % 3) + [f" {often}\t", "short", ""]) * (i % 5) + [often.upper() if i % 2 else "ÉTÉ"]))
        for i in range(12)
    ]
    rows += [(40 + i, "\n".join(f"filler line number {n} of all" if n in (0, 70, 129, 199) else sentence(n * i + 9, 6) for n in range(200))) for i in range(3)]
    rows += [(50, f"{often}\n{often}"), (51, often), (51, often), (None, often), (None, f"x\n{often}")]
    found = lines.deduplicate_lines(documents(rows))
    got = [
        (r.doc_id, r["__n_lines"], r["__n_dropped"], hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in found.collect()
    ]
    assert sorted(map(str, got)) == sorted(map(str, brute_lines(rows)))
    assert found.columns == ["doc_id", "text", "block", "key", "__n_lines", "__n_dropped"]
    assert lines.deduplicate_lines(documents([])).count() == 0


@pytest.mark.parametrize("task_docs", [1_500, 7])
def test_links_are_all_pairs_of_different_sets(spark, documents, odd_rows, monkeypatch, task_docs):
    monkeypatch.setattr(ngram_join, "TASK_DOCS", task_docs)
    rows = odd_rows + near_copies()
    members, pairs = ngram_join.jaccard_links(documents(rows))
    sets = [frozenset(shingles(t)) for _, t in rows]
    classes = {s for s in sets if s}
    expected = {
        frozenset((a, b)) for a in classes for b in classes if a != b and 100 * len(a & b) >= 80 * len(a | b)
    }
    got = members.collect()
    assert len(got) == len(rows)
    by_doc = {i: s for (i, _), s in zip(rows, sets) if i is not None}
    of_class = {bytes(r["class"]): by_doc[r.doc_id] for r in got if r.doc_id is not None}
    found = [frozenset((of_class[bytes(p.a)], of_class[bytes(p.b)])) for p in pairs.collect()]
    named = {p for p in expected if all(any(s == c for c in of_class.values()) for s in p)}
    assert len(found) == len(set(found)) and set(found) == named
    for r in got:
        if r.doc_id is not None:
            assert r.n_links == sum(by_doc[r.doc_id] in p for p in expected)


def brute_paragraphs(rows):
    found = [
        (i, p, split_words(lowered(line)))
        for i, t in rows
        for p, line in enumerate((t or "").split("\n"))
        if len(split_words(lowered(line))) >= 10
    ]
    groups = ngram_join.Groups(len(found))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, _, w in found]
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                groups.join(i, j)
    members = {}
    for n in range(len(found)):
        members.setdefault(groups.of(n), []).append(n)
    result = []
    for own in members.values():
        if len(own) > 1:
            first = min(own, key=lambda n: (found[n][0] is None, found[n][0] or 0, found[n][1]))
            result += [(found[n][0], found[n][1], len(found[n][2]), *found[first][:2], len(own)) for n in own]
    return result


def test_paragraphs_agree_with_all_pairs(spark, documents, odd_rows):
    passages = [sentence(n, 55) for n in range(5)]
    rows = odd_rows + [
        (100 + i, "\n".join([sentence(900 + i, 20), varied(passages[i % 5], i % 3, i), passages[(i + 1) % 5]]))
        for i in range(25)
    ]
    found = paragraphs.repeated_paragraphs(documents(rows)).collect()
    got = sorted(str(tuple(r)[:6]) for r in found)
    assert got == sorted(map(str, brute_paragraphs(rows)))
    assert all(r.removed != ((r.doc_id, r.position) == (r.group_doc, r.group_position)) for r in found)
    assert paragraphs.repeated_paragraphs(documents([])).count() == 0


@pytest.mark.parametrize("least", [5, 10])
def test_short_paragraphs_are_compared_across_lengths(spark, documents, least):
    """Eight words inside nine have a Jaccard of exactly 0.8; of shorter ones one word may differ."""
    nine = sentence(71, 9)
    rows = [(1, nine), (2, " ".join(nine.split(" ")[:8])), (3, sentence(72, 12)), (4, varied(sentence(73, 6), 1, 1)), (5, sentence(73, 6))]
    groups = {}
    for r in paragraphs.repeated_paragraphs(documents(rows), least).collect():
        groups.setdefault(r.group_doc, set()).add(r.doc_id)
    assert groups == ({1: {1, 2}, 4: {4, 5}} if least == 5 else {})


def shared_runs(rows, length):
    """For each document the words that lie in a run of ``length`` words which another document holds."""
    grams, words = {}, {}
    for i, text in rows:
        words[i] = split_words(lowered(text))
        for at in range(len(words[i]) - length + 1):
            grams.setdefault(tuple(words[i][at : at + length]), set()).add(i)
    return {
        i: [at for at in range(len(w) - length + 1) if len(grams[tuple(w[at : at + length])]) > 1] for i, w in words.items()
    }


def embedded():
    """Passages in the middle of different long lines, wrapped at different widths, at the ends, nested."""
    chance, rows = random.Random(4), []
    passages = [sentence(2_000 + n, 50 + 7 * n) for n in range(8)]
    for i in range(48):
        words = passages[i % 8].split(" ")
        width = chance.choice([6, 11, 40, 500])
        wrapped = "\n".join(" ".join(words[at : at + width]) for at in range(0, len(words), width))
        before, after = sentence(3_000 + i, chance.choice([0, 30, 90])), sentence(4_000 + i, chance.choice([0, 25, 140]))
        rows.append((i, f"{before} {wrapped.upper() if i % 5 == 0 else wrapped} {after}"))
    rows += [(100 + i, sentence(5_000 + i, 120)) for i in range(30)]  # clean
    rows += [(200 + i, f"{sentence(6_000 + i, 60)}\n{sentence(99, 30)}\n{sentence(6_100 + i, 60)}") for i in range(6)]  # short share
    rows += [(300, " ".join([sentence(7_000, 60)] * 4))]  # repeats itself only
    return rows, passages


def test_passages_hold_every_shared_run(spark, documents):
    rows, _ = embedded()
    found = {}
    for r in paragraphs.repeated_passages(documents(rows)).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.start + r.n_words))
    sure, possible = shared_runs(rows, 50), shared_runs(rows, 37)
    assert set(found) == {i for i, starts in sure.items() if starts}
    for i, starts in sure.items():
        for at in starts:
            # A whole paragraph of 37 words within the run of 50.
            assert any(min(at + 50, end) - max(at, start) >= 37 for start, end in found[i])
    for i, spans in found.items():
        covered = {at + n for at in possible[i] for n in range(37)}
        assert all(set(range(*span)) <= covered for span in spans)


def test_passages_keep_one_place_of_each_group(spark, documents):
    rows, passages = embedded()
    kept, removed = {}, {}
    for r in paragraphs.repeated_passages(documents(rows)).collect():
        (removed if r.removed else kept).setdefault(r.doc_id, []).append((r.start, r.n_words, r.group_doc))
    # The first eight documents hold the first places.
    assert set(range(8)) <= set(kept) and set(removed) == set(range(8, 48))
    # A removal names a place before it that holds the passage.
    assert all(group < i and group % 8 == i % 8 for i, spans in removed.items() for _, _, group in spans)


def test_passages_find_near_copies_of_paragraphs(spark, documents, odd_rows):
    base = sentence(8_000, 150)
    rows = odd_rows + [(500 + i, f"{sentence(8_100 + i, 20)}\n\n{varied(base, i, i)}\n\n{sentence(8_200 + i, 20)}") for i in range(4)]
    rows += [(None, base), (None, base), (600, sentence(8_300, 70)), (601, sentence(8_300, 70)), (601, sentence(8_300, 70))]
    found = {}
    for r in paragraphs.repeated_passages(documents(rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert {500, 501, 502, 503, None, 600, 601} <= set(found)
    assert all(r.n_words >= 140 for i in (501, 502, 503) for r in found[i])
    assert [(r.removed, r.n_copies) for r in found[600] + found[601]] == [(False, 2), (True, 2)]
    assert paragraphs.repeated_passages(documents([])).count() == 0


def test_edit_distance_of_short_paragraphs():
    assert paragraphs.edits_allow("a b c d e".split(), "a b x d e".split(), 80)
    assert not paragraphs.edits_allow("a b c d e".split(), "a x y d e".split(), 80)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    found = common.components(spark.createDataFrame(chain, "a long, b long"), "test").collect()
    assert {r.node: r.component for r in found} == {n: 0 if n < 100 else 100 for e in chain for n in e}
    assert common.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_linked_sets_have_spare_keys_in_common():
    chance = np.random.default_rng(8)
    for size in [*range(1, 40), 120, 500]:
        for _ in range(60):
            one = chance.choice(2**62, size, replace=False).astype(np.uint64)
            left = one[: size - chance.integers(0, size // 5 + 1)]
            other = np.concatenate((left, chance.choice(2**62, chance.integers(0, size // 4 + 1)).astype(np.uint64)))
            if 100 * len(left) < 80 * len(np.union1d(one, other)):
                continue
            keys = [ngram_join.search_keys(np.sort(s), 80) for s in (one, other)]
            assert len(np.intersect1d(*keys)) >= ngram_join.spare(min(len(one), len(other)), 80)


def test_packed_keys_come_back_and_are_counted_by_pairs():
    chance = np.random.default_rng(9)
    pool = chance.integers(0, 2**64, 300, np.uint64)
    keys = [chance.choice(pool, chance.integers(1, 60), replace=False) for _ in range(40)]
    rows = list(range(5, 45))
    found = []
    for bucket, count, packed in ngram_join.pack_keys(keys, rows):
        low, numbers = ngram_join.unpack_keys(count, packed)
        found += [((bucket << 32) + int(k), int(r)) for k, r in zip(low, numbers)]
    cut = {r: {int(k) >> 20 for k in own} for r, own in zip(rows, keys)}
    assert sorted(found) == sorted((k, r) for r, own in cut.items() for k in own)
    few = 6
    holders = {}
    for k, r in sorted(found):
        holders.setdefault(k, []).append(r)
    expected = {}
    for own in holders.values():
        some = [(a, b, False) for a in own for b in own if a < b] if len(own) <= few else [(a, own[0], True) for a in own]
        for x in some:
            expected[x] = expected.get(x, 0) + 1
    a, b, often, hits = ngram_join.common_keys(*map(np.array, zip(*found)), few)
    assert dict(zip(zip(a.tolist(), b.tolist(), often.tolist()), hits.tolist())) == expected


@pytest.mark.parametrize("few", [16, 3])
def test_documents_that_only_share_passages_are_no_candidates(spark, documents, monkeypatch, few):
    """Each shares a passage with the next ones; only the copies go on, and no keys stay behind."""
    monkeypatch.setattr(ngram_join, "FEW", few)
    passages = [sentence(700 + i, 30) for i in range(24)]
    rows = [
        (i, " ".join([sentence(800 + i, 150), *(passages[(i + j) % 24] for j in range(3)), sentence(900 + i, 150)]))
        for i in range(24)
    ]
    rows += [(100 + i, varied(rows[i % 3][1], 1 + i % 4, i)) for i in range(12)]
    narrow = documents(rows).selectExpr("doc_id", "xxhash64(text) text_hash", "text")
    written, folders = session.written, []

    def noted(df, name, *more):
        found = written(df, name, *more)
        folders.append((name, found.inputFiles()[0].rpartition("/")[0].removeprefix("file:")))
        return found

    monkeypatch.setattr(ngram_join, "written", noted)
    classes, candidates = ngram_join._candidates(narrow, 5, 80)
    found = candidates.join(classes, "row").select("component", "doc_id").collect()
    groups = {}
    for r in found:
        groups.setdefault(r.component, set()).add(r.doc_id)
    copies = [{g, *(100 + i for i in range(12) if i % 3 == g)} for g in range(3)]
    assert all(any(c <= g for g in groups.values()) for c in copies)
    assert set().union(*groups.values()) == set().union(*copies)
    assert {name: os.path.exists(path) for name, path in folders if name in ("ngram-keys", "ngram-classes")} == {
        "ngram-keys": False,
        "ngram-classes": True,
    }


def test_little_passes_the_driver(spark, documents, monkeypatch):
    """What is sent to all executors has a fixed size of 4 MB, and a bit for each document."""
    sizes, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, value: sizes.append(len(pickle.dumps(value))) or broadcast(self, value)
    )
    assert ngram_join.one_of_each(documents(near_copies())).count() > 0
    assert sizes and sum(sizes) < 5_000_000
