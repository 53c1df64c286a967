"""The Merkle manifest against a plain tree in Python."""

import zlib
from hashlib import sha256

import pyarrow as pa
import pytest

from tidemark.llm import merkle_manifest as merkle

SCHEMA = (
    "doc_id bigint, source string, lang string, n_chars bigint, text string, "
    "tree string, pos int, n int, word string, leaf string, row int"
)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, "y", "z", 3) for row in rows], SCHEMA)


def hashed(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return hashed(*parts)


def tree(digests):
    """The root, and for each leaf its siblings as (digest, is right) or None."""
    paths = [[] for _ in digests]
    own = list(range(len(digests)))
    while len(digests) > 1:
        for i, place in enumerate(own):
            other = place ^ 1
            alone = other >= len(digests)
            paths[i].append(None if alone else (digests[other], other > place))
            own[i] = place // 2
        digests = [hashed(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
    return digests[0], paths


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    for own in groups.values():
        own.sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    built = {name: tree([leaf(row) for row in groups[name]]) for name in names}
    root, above = tree([built[name][0] for name in names])
    found = []
    for name, upper in zip(names, above, strict=True):
        for row, path in zip(groups[name], built[name][1], strict=True):
            known = str(row[0]) if row[0] is not None else ""
            n_chars = row[3]
            if n_chars is not None and zlib.crc32(known.encode()) % 7 == 0:
                n_chars += 1
            digest = leaf((row[0], row[1], row[2], n_chars, row[4]))
            for step in path + upper:
                if step is None:
                    digest = hashed(digest)
                else:
                    digest = hashed(digest, step[0]) if step[1] else hashed(step[0], digest)
            siblings = [step[0] for step in path + upper if step]
            found.append(
                (row[0], leaf(row), built[name][0], root, hashed(*siblings), digest, digest == root)
            )
    return sorted(found, key=str)


def manifest(spark, rows):
    found = merkle.merkle_manifest(frame(spark, rows), claims={"n_chars": merkle.tampered()})
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == columns
    return sorted((tuple(row) for row in found.collect()), key=str)


def row(number, lang="en", text="t", n_chars=4):
    return (number, "web", lang, n_chars, text)


ODD = [
    (None, None, None, None, None),
    (None, None, None, None, None),
    (None, "s", None, 0, ""),
    (None, "s", "en", 0, ""),
    (0, "", "", 0, "\U0001f600 ü"),
    (-1, "s", "en", 3, "a" * 300_000),
    (-(1 << 63), "s", "en", 3, "low"),
    ((1 << 63) - 1, "s", "en", None, "high"),
    (63, "s", "é", 3, None),
    (64, "s", "é", 3, "x"),
    (127, "s", "é", 3, "y"),
]


@pytest.mark.parametrize(
    "rows",
    [
        [row(5)],
        [row(5), row(6, "de")],
        [row(n) for n in range(9)],
        ODD,
        ODD * 3 + [row(7, text=str(n % 6)) for n in range(50)] + [row(8), row(70)],
        [row(n * 37 % 2500, ["en", "en", "fr", None][n % 4]) for n in range(2500)],
    ],
    ids=["one", "two trees", "nine", "odd", "repeated", "several blocks"],
)
def test_equals_a_plain_tree(spark, rows):
    assert manifest(spark, rows) == brute_force(rows)


def test_many_groups_and_copies(spark, monkeypatch):
    """Many roots, and copies of a row that several tasks write."""
    rows = [row(n, f"l{n % 37}") for n in range(40)] + [row(n, "big") for n in range(21)]
    monkeypatch.setattr(merkle, "COPIES_A_TASK", 3)
    found = manifest(spark, [*rows, *[row(3, "big")] * 10])
    assert found == brute_force([*rows, *[row(3, "big")] * 10])


def test_no_rows(spark):
    assert manifest(spark, []) == []


def test_a_proof_gives_the_root_and_a_changed_leaf_does_not():
    digests = [hashed(str(n)) for n in range(11)]
    levels = merkle._levels(digests, len(digests))
    for slot, digest in enumerate(digests):
        steps = merkle._steps(levels, slot)
        assert merkle.folded(digest, steps) == levels[-1][0]
        assert merkle.folded(hashed("other"), steps) != levels[-1][0]


def test_ranks_need_no_dense_ids(spark):
    """One id per word, over the whole range of 64 bits."""
    ids = [(-1) ** n * (n * 0x9E3779B97F4A7C15 % (1 << 63)) for n in range(300)]
    rows = [row(number) for number in ids]
    assert manifest(spark, rows) == brute_force(rows)


def test_every_root_is_folded_from_its_leaf_and_siblings():
    """A wrong sibling shows in rows that nobody tampered with, not only in claimed ones."""
    digests = [hashed(str(n)) for n in range(5)]
    block = {
        "tree": "", "block": 0, "n": 5, "digests": digests, "ids": list(range(5)),
        "claimed": [None, None, hashed("claim"), None, None], "subroot": "s",
    }
    top = merkle._levels(digests, 5)[-1][0]

    def roots(sibling):
        batch = pa.RecordBatch.from_pylist([{**block, "path": ["l" + sibling]}])
        return next(merkle._proofs([batch])).column("folded_root").to_pylist()

    right, wrong = roots(hashed("other")), roots(hashed("wrong"))
    assert right == [hashed(hashed("other") + top) if n != 2 else right[2] for n in range(5)]
    assert right[2] != right[0]
    assert all(now != then for now, then in zip(wrong, right, strict=True))
