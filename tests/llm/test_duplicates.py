"""Exact copies, near copies, repeated lines and repeated passages against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import VOCABULARY, frame, odd_rows, prose, words_of
from tidemark.llm import exact_dedup, exchange, jaccard_join, line_runs, substring_dedup
from tidemark.llm.components import components


def changed(text, seed, n):
    """The text with n words replaced."""
    rng, words = random.Random(seed), text.split()
    for place in rng.sample(range(len(words)), n):
        words[place] = rng.choice(VOCABULARY)
    return " ".join(words)


def joined(pairs, nodes):
    """Smallest node of each component."""
    label = {node: node for node in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 140)]
    pairs += [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    links = spark.createDataFrame([*pairs, (7, 7)], "a bigint, b bigint")
    found = {row.node: row.component for row in components(links).collect()}
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    assert found == joined(pairs, {*nodes, *[x for pair in pairs for x in pair]}) | found
    assert set(found) == nodes


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_exact_copies(spark, hot_rows):
    rows = [*odd_rows(), (20, "a  b"), (21, "a\tb"), (22, "a b "), (0, "a\n\nb"), *[(i, "x") for i in range(30, 41)]]
    found = exact_dedup.exact_dedup(frame(spark, rows), hot_rows=hot_rows).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    groups = {}
    for (number, _), text in zip(rows, norm, strict=True):
        groups.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(number)
    assert len(found) == len(rows)
    for row in found:
        own = groups[row.text_sha256]
        known = [number for number in own if number is not None]
        assert row.group_size == len(own)
        assert row.keep_id == (min(known) if known else None)
    for digest, own in groups.items():
        kept = [row.doc_id for row in found if row.text_sha256 == digest and row.kept]
        assert kept == [min(own, key=lambda x: (x is None, x or 0))]


def test_rows_kept_of_exact_copies(spark):
    docs = frame(spark, [(3, "a b"), (2, "a  b"), (2, "a  b"), (2, "c"), (None, "d"), (None, "d")])
    found = exact_dedup.deduplicated(docs).collect()
    assert sorted((str(row.doc_id), row.text) for row in found) == [("2", "a  b"), ("2", "c"), ("None", "d")]


def shingles(text):
    words = words_of(text, lower=True)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def similar(rows, percent=75):
    sets = {number: shingles(text) for number, text in rows}
    return [
        (a, b)
        for a in sets
        for b in sets
        if a < b
        and sets[a]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]


def near_rows():
    """Chains and groups of near copies, documents that share passages, short and equal texts."""
    rows, passage = [], prose(900, 60)
    for group in range(6):
        text = prose(group, 150)
        for copy in range(7):
            rows.append((100 * group + copy, text))
            text = changed(text, 31 * group + copy, 2)
    for i in range(12):
        rows.append((1000 + i, prose(2000 + i, 100) + " " + passage))
    for i in range(25):
        rows.append((1100 + i, changed(prose(77, 200), 500 + i, 5)))
    rows += [(2000, "one two"), (2001, "ONE two"), (2002, "one"), (2003, ""), (2004, None)]
    rows += [(2005, prose(77, 200)), (2006, prose(77, 200).upper())]
    return rows


@pytest.mark.parametrize("max_common, block", [(1 << 18, 128), (4, 3)])
def test_near_copies_equal_brute_force(spark, monkeypatch, max_common, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_rows()
    docs = frame(spark, rows)
    found = jaccard_join.jaccard_join(docs, max_common=max_common).collect()
    label = joined(similar(rows), [number for number, _ in rows])
    assert {row.doc_id: row.component_id for row in found} == label
    assert {row.doc_id: row.n_shingles for row in found} == {
        number: len(shingles(text)) for number, text in rows
    }


def test_near_copies_without_ids(spark):
    rows = [(5, prose(1, 50)), (None, prose(1, 50)), (None, prose(2, 50)), (None, prose(2, 50)), (6, None)]
    docs = frame(spark, rows)
    found = jaccard_join.jaccard_join(docs).collect()
    assert sorted(str(row.component_id) for row in found) == ["5", "5", "6", "None", "None"]
    kept = jaccard_join.deduplicated(docs).collect()
    assert sorted(str(row.doc_id) for row in kept) == ["5", "6", "None", "None", "None"]


def deleted_lines(rows, least):
    """Numbers of the lines of each document that lie in a later copy."""
    seen, gone = set(), {}
    for number, text in sorted(rows, key=lambda row: row[0]):
        lines = [(i, " ".join(words_of(line))) for i, line in enumerate((text or "").split("\n"))]
        lines = [(i, line) for i, line in lines if line]
        gone[number] = set()
        for at in range(len(lines) - least + 1):
            window = lines[at : at + least]
            run = tuple(line for _, line in window)
            if run in seen:
                gone[number].update(i for i, _ in window)
            seen.add(run)
    return gone


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_line_runs_equal_brute_force(spark, least):
    rng = random.Random(least)
    pool = [f"line  {i}" for i in range(7)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))) for i in range(25)]
    rows += [(50, None), (51, "\n".join(["same"] * 20))]
    gone = deleted_lines(rows, least)
    found = line_runs.line_runs(frame(spark, rows), min_lines=least).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for row in found:
        lines = (texts[row.doc_id] or "").split("\n")
        kept = [line for i, line in enumerate(lines) if i not in gone[row.doc_id]]
        assert row.n_lines == len(lines)
        assert row.n_deleted == len(gone[row.doc_id])
        assert row.text == "\n".join(kept)
        inside = {i for run in row.runs for i in range(run["first"], run["last"] + 1)}
        assert gone[row.doc_id] <= inside
        assert all(not lines[i].strip() for i in inside - gone[row.doc_id])


def removed(rows, size):
    """Words of each document that lie in a later copy of a run."""
    seen, gone = {}, {}
    for number, text in sorted(rows, key=lambda row: row[0]):
        words = words_of(text, lower=True)
        gone[number] = set()
        for at in range(len(words) - size + 1):
            run = tuple(words[at : at + size])
            if seen.setdefault(run, (number, at)) != (number, at):
                gone[number].update(range(at, at + size))
    return gone


@pytest.mark.parametrize("size", [3, 10, 50])
def test_passages_equal_brute_force(spark, size):
    rng = random.Random(size)
    passages = [prose(50 + i, size + 3 * i) for i in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(1000 + i, rng.randint(0, 2 * size)), rng.choice(passages)]
        parts += [" \n", prose(2000 + i, size), rng.choice(passages).upper(), "é ü  "]
        rows.append((i, "  " + "\t ".join(parts)))
    rows += [(100, "in " * (3 * size)), (101, "in " * (3 * size)), (102, rows[0][1]), (103, None)]
    gone, texts = removed(rows, size), dict(rows)
    found = substring_dedup.substring_dedup(frame(spark, rows), unit_words=size).collect()
    assert len(found) == len(rows)
    for row in found:
        text = texts[row.doc_id] or ""
        pieces = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
        head = re.match(r"[\x20\x09-\x0D]*", text)[0]
        kept = [piece for i, piece in enumerate(pieces) if i not in gone[row.doc_id]]
        assert row.n_words == len(pieces)
        assert row.n_removed == len(gone[row.doc_id])
        assert row.text == head + "".join(kept)
        rest = list(text)
        for span in reversed(row.spans):
            del rest[span["start"] : span["end"]]
        assert "".join(rest) == row.text


def test_passages_of_rows_with_one_id_or_none(spark):
    text = prose(1, 80)
    docs = frame(spark, [(1, text), (1, text), (2, text), (None, text), (None, text)])
    found = substring_dedup.substring_dedup(docs).collect()
    assert sorted((str(row.doc_id), row.text) for row in found) == [
        ("1", text), ("1", text), ("2", ""), ("None", text), ("None", text)
    ]


def family():
    """One family of near copies in several components: a common core, and ends of their own."""
    core = prose(1, 60)
    rows = []
    for k in range(6):
        end = prose(50 + k, 18)
        rows += [(100 * k + i, f"{core} {changed(end, i, i % 2)}") for i in range(8)]
    return rows


def members_of_groups(dealt):
    """The members in each pair of parts, 8 bytes an id, and the rows they travel in."""
    n = F.sum(F.octet_length("member") / 8)
    return dealt.groupBy("left", "right").agg(n.alias("n"), F.count(F.lit(1)).alias("n_rows"))


def test_pairs_of_many_buckets_are_one_row_each(spark):
    rows = [(1, [2, 3]), (1, [3, 4]), (2, [3]), (-5, [2]), (1, [2]), (-5, [2])]
    centres = spark.createDataFrame(rows, "digest bigint, docs array<bigint>").repartition(4)
    found = jaccard_join._distinct_pairs(centres, 7).collect()
    assert sorted((row.a, row.b) for row in found) == [(-5, 2), (1, 2), (1, 3), (1, 4), (2, 3)]


def test_packed_numbers_come_back_and_compress():
    rng = np.random.default_rng(8)
    n = 3_000
    columns = {
        "id": 10**9 + 37 * rng.permutation(n),
        "size": rng.integers(0, 500, n).astype(np.int32),
        "flag": rng.integers(0, 2, n) == 1,
        "digest": rng.integers(0, 1 << 63, n, np.uint64),
    }
    buckets = rng.integers(0, 7, n)
    batches = [
        exchange.pack(buckets[part], {name: x[part] for name, x in columns.items()})
        for part in (slice(0, 1_000), slice(1_000, 1_001), slice(1_001, n))
    ]
    table = pa.Table.from_batches(batches)
    kinds = {"id": "i8", "size": "i4", "flag": "?", "digest": "u8"}
    order = np.concatenate(
        [first + np.argsort(buckets[first:end], kind="stable") for first, end in ((0, 1_000), (1_000, 1_001), (1_001, n))]
    )
    for rows, places in ((table, order), (table.slice(3), order[np.sum(buckets[:1_000] < 3) :])):
        for name, found in exchange.unpack(rows, kinds).items():
            assert np.array_equal(found, columns[name][places])
    # What is constant in an id takes no room; with whole numbers side by side it was 3.2 bytes each
    packed = b"".join(table.column("id").to_pylist())
    assert len(zlib.compress(packed, 1)) < 2.8 * n


@pytest.mark.parametrize("members", [2, 4_096])
def test_a_family_in_small_parts_equals_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(jaccard_join, "PART_MEMBERS", members)
    rows, sizes = family(), []
    dealt = jaccard_join._dealt

    def noted(*args):
        found = dealt(*args)
        sizes.extend(row.n for row in members_of_groups(found).collect())
        return found

    monkeypatch.setattr(jaccard_join, "_dealt", noted)
    found = jaccard_join.jaccard_join(frame(spark, rows).repartition(3)).collect()
    label = joined(similar(rows), [number for number, _ in rows])
    assert {row.doc_id: row.component_id for row in found} == label
    assert sizes and max(sizes) <= 2 * members


def as_sets(spark, sets):
    """What `_dealt` asks for the sets of nodes, from a list of sets of numbers."""
    rows = [(i, len(own), np.array(sorted(own), np.uint64).tobytes()) for i, own in enumerate(sets)]
    table = spark.createDataFrame(rows, "node bigint, n bigint, own binary")
    return lambda nodes: table.join(nodes.distinct(), "node")


def test_one_list_of_many_components_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_MEMBERS", 10)
    n = 100
    entries = spark.createDataFrame(
        [(7, i, i // 20, 40, i % 5, 0) for i in range(n)],
        "list bigint, node bigint, component bigint, sizes int, positions int, low bigint",
    )
    # Components 0 and 1, and 2 and 3, are alike; component 4 is like none.
    sets = [set(range(1000 * (i // 40), 1000 * (i // 40) + 39)) | {9000 + i} for i in range(n)]
    dealt = jaccard_join._dealt(entries, as_sets(spark, sets), 75, 8)
    groups = members_of_groups(dealt).collect()
    assert max(row.n for row in groups) <= 20
    assert max(row.n_rows for row in groups) <= 2
    links = dealt.groupBy("left", "right").applyInArrow(
        jaccard_join._links_of_parts(75), "a bigint, b bigint"
    ).collect()
    assert len(links) <= n * n // 100  # some for each pair of parts, not all pairs of members
    for a, b in links:
        assert 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    label = joined(links + [(i, i // 20 * 20) for i in range(n)], range(n))
    assert label == {i: 80 if i >= 80 else i // 40 * 40 for i in range(n)}


def test_members_without_a_partner_are_left_out(spark):
    entries = spark.createDataFrame(
        [(7, i, i, 40, 0, 0) for i in range(6)],
        "list bigint, node bigint, component bigint, sizes int, positions int, low bigint",
    )
    sets = [{1000 * i + j for j in range(40)} for i in (1, 1, 2, 3, 4, 5)]
    sketches = spark.createDataFrame(
        [(i, 40, jaccard_join._sketch(np.array(sorted(own), np.uint64) * 7919)) for i, own in enumerate(sets)],
        "doc_id bigint, n bigint, sketch binary",
    )
    found = jaccard_join._open_members(entries, sketches, 75)
    assert sorted(row.node for row in found.collect())[:2] == [0, 1]


def parts_of(label, sets):
    """One part as the groups of `_joining` hold it."""
    part = object.__new__(jaccard_join._Members)
    part.ids, part.labels = np.arange(len(sets)), np.array(label)
    part.sizes = np.array([len(own) for own in sets])
    part.own = [np.array(sorted(own), np.uint64).tobytes() for own in sets]
    return part


@pytest.mark.parametrize("seed", range(20))
def test_links_inside_a_group_join_what_all_pairs_join(seed):
    rng = random.Random(seed)
    cores = [rng.sample(range(400), 40) for _ in range(4)]
    sets, label = [], []
    for i in range(60):
        core = cores[rng.randrange(4)]
        sets.append(set(core[: rng.randint(30, 40)]) | set(rng.sample(range(400), rng.randint(1, 8))))
        label.append(i if rng.random() < 0.6 else max(i - 1, 0))
    part = parts_of(label, sets)
    different = part.labels[:, None] != part.labels[None, :]
    open_pairs = np.triu(different, 1)
    found = list(jaccard_join._joining(part, part, open_pairs, 75))
    linked = [
        (a, b)
        for a, b in zip(*np.nonzero(open_pairs), strict=True)
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    assert set(found) <= set(linked)
    same = [(a, label.index(label[a])) for a in range(60)]
    assert joined([*found, *same], range(60)) == joined([*linked, *same], range(60))
    assert len(found) < len(set(label))


def test_a_large_family_gives_fewer_links_than_members():
    """3,000 members, each two of one core alike, half of them under the similarity with the others."""
    rng = random.Random(5)
    core, other = range(60), [*range(40), *range(100, 130)]
    sets = [
        {*(core if i % 2 else other), *(1000 + rng.randrange(10**6) for _ in range(3))}
        for i in range(3_000)
    ]
    part = parts_of(range(3_000), sets)
    open_pairs = np.triu(np.ones((3_000, 3_000), bool), 1)
    found = list(jaccard_join._joining(part, part, open_pairs, 75))
    assert len(found) == 2_998
    assert set(joined(found, range(3_000)).values()) == {0, 1}
