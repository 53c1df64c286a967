"""Quality rules and the quality classifier."""

import random
import resource
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.corpus import frame, odd_rows, prose, words_of
from tidemark.llm import gam, quality_rules
from tidemark.llm.text import Words, parts, slices, window_hashes


def longest_at(words, i):
    best = 0
    for j in range(len(words)):
        n = 0
        while j != i and max(i, j) + n < len(words) and words[i + n] == words[j + n]:
            n += 1
        best = max(best, n)
    return best


def test_longest_repeats_equal_brute_force():
    rng = random.Random(3)
    for _ in range(120):
        letters = rng.choice(["ab", "abc", "a"])
        texts = [
            " ".join(rng.choice(letters) for _ in range(rng.randint(0, 40))).encode()
            for _ in range(rng.randint(1, 4))
        ]
        found = quality_rules.longest_repeats(Words(texts))
        assert list(found) == [
            longest_at(text.split(), i) for text in texts for i in range(len(text.split()))
        ]


def covered_words(words, size):
    """Words in windows of this size that occur twice."""
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    inside = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            inside.update(range(i, i + size))
    return len(inside)


def test_rules_equal_brute_force(spark):
    passage = prose(1, 70)
    rows = [
        (1, prose(2, 200)),
        (2, f"{passage}\n{prose(3, 150)}\n{passage}"),
        (3, "same line\nsame line\n \n \nsame line $1|2# " + prose(5, 60)),
        (4, "in in in in " * 40),
        (5, "short text"),
    ]
    found = {row.doc_id: row for row in quality_rules.quality_rules(frame(spark, rows)).collect()}
    for number, text in rows:
        row, words = found[number], words_of(text)
        lines = text.split("\n")
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(text.count(x) for x in "#*$%&|<>")
        assert row.n_dup_lines == sum(
            bool(line.split()) and line in lines[:i] for i, line in enumerate(lines)
        )
        assert row.n_repeat_words == covered_words(words, 3)
        assert row.covered_words == covered_words(words, quality_rules.MIN_WORDS)
        assert row.longest_repeat == max(longest_at(words, i) for i in range(len(words)))
        failed = len(words) < 50 or 100 * row.n_repeat_words > 50 * len(words)
        assert row.base_failed == failed
    assert [found[i].kept for i in range(1, 6)] == [True, False, True, False, False]


def test_words_and_their_hashes():
    texts = [b"  one two\tone ", b"", b"two" * 50 + b"\n" + b"two" * 50, b"on e twotwotw twotwotwo", b"\xc3\xa9"]
    words = Words(texts)
    own = [word for text in texts for word in text.split()]
    assert [words.word(i) for i in range(len(words))] == own
    assert words.counts.tolist() == [len(text.split()) for text in texts]
    by_hash = {}
    for word, digest in zip(own, words.hashes().tolist(), strict=True):
        assert by_hash.setdefault(digest, word) == word
    assert len(by_hash) == len(set(own))
    alone = [int(Words([word]).hashes()[0]) for word in own]
    assert alone == words.hashes().tolist()


def test_window_hashes_tell_windows_apart():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 200).astype(np.uint64)
    for size in (1, 2, 3, 5, 8, 13):
        found = window_hashes(words, size)
        by_hash = {}
        for i, digest in enumerate(found):
            by_hash.setdefault(int(digest), set()).add(tuple(words[i : i + size]))
        assert all(len(windows) == 1 for windows in by_hash.values())
        assert len(by_hash) == len({tuple(words[i : i + size]) for i in range(len(found))})


def labelled(n):
    rows = [(i, prose(i, 80) if i % 3 else "BUY!! NOW!! " * 30) for i in range(n)]
    return rows, [(i, int(i % 3 > 0), 0) for i in range(n)]


def test_classifier_on_held_out_rows(spark):
    rows, labels = labelled(240)
    docs = frame(spark, rows)
    given = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = gam.quality_scores(docs, gam.fit_scores(docs, given)).collect()
    assert len(found) == 240
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
        assert row.predicted == int(row.doc_id % 3 > 0)
    # Labels of held-out rows change nothing.
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    again = gam.fit_scores(docs, spark.createDataFrame(turned, given.schema))
    scores = {row.doc_id: row.score for row in gam.quality_scores(docs, again).collect()}
    assert scores == {row.doc_id: row.score for row in found}
    kept = gam.accepted(docs, again)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} == {i for i in range(240) if i % 3}


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(2)
    rows = rng.random((3000, 3)).astype(np.float32)
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = gam.fit(rows, labels)
    assert (1, 0) in model.pairs
    fresh = rng.random((500, 3)).astype(np.float32)
    right = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)
    assert ((model.score(fresh) > 0.5) == right).mean() > 0.9


def test_without_labels_all_scores_are_even(spark):
    docs = frame(spark, [(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = gam.quality_scores(docs, gam.fit_scores(docs, none)).collect()
    assert [row.score for row in found] == [0.5, 0.5]


def test_freed_memory_goes_back_after_the_last_slice():
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * resource.getpagesize()

    # Too small for mappings of their own; the last one stays and keeps the heap as it is
    held = [np.ones(10_000) for _ in range(2_000)]
    last = held.pop()
    held.clear()
    before = resident()
    assert list(slices([])) == []
    assert resident() < before - (100 << 20)
    assert last.sum() == 10_000


def test_features_of_a_slice_are_those_of_the_whole():
    texts = [text.encode() for _, text in odd_rows() if text is not None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.binary())})
    cut = [part.column("text").to_pylist() for part in parts(batch, 40)]
    assert sum(cut, []) == texts and len(cut) > 1
    assert all(len(part) == 1 or sum(map(len, part)) <= 40 for part in cut)
    assert np.array_equal(np.concatenate([gam.features(part) for part in cut]), gam.features(texts))
