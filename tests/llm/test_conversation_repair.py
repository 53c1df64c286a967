"""Repairs against a search over all edits, and long conversations against short ones."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import conversation_repair as repair

LEGAL = re.compile("(s?(ua)+)?")
SCHEMA = (
    "conv_id bigint, turn bigint, role string, text string, copies int, state int, audit string, "
    "part int, segment string, cost int"
)
COLUMNS = [
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    "repaired_sha256",
]


def faults(turns):
    found, seen = [], set()
    for role, text in turns:
        bare = text.rstrip(" \t\n\v\f\r")
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def every_way(turns):
    """(cost, audit, repaired turns) of the best edits, by trying them all, letter by letter."""
    marks = faults(turns)
    best = {"": (0, "", ())}  # end of the roles so far -> best

    def merge(into, roles, way):
        if not any(LEGAL.fullmatch(roles + rest) for rest in ("", "a", "ua")):
            return
        key = {"a": "ua"}.get(roles[-1:], roles[-1:])
        if key not in into or way < into[key]:
            into[key] = way

    def with_inserts(ways):
        for _ in range(3):
            more = dict(ways)
            for roles, (cost, audit, rows) in ways.items():
                for role in ("user", "assistant"):
                    merge(more, roles + role[0], (cost + 5, audit + "I", (*rows, (role, ""))))
            ways = more
        return ways

    for (role, text), mark in zip(turns, marks, strict=True):
        after = {}
        for roles, (cost, audit, rows) in with_inserts(best).items():
            merge(after, roles, (cost + 2, audit + "D", rows))
            if mark in ("blank", "duplicate"):
                continue
            more = 5 if mark == "truncated" else 0
            if role:
                way = (cost + more, audit + "K", (*rows, (role, text)))
                merge(after, roles + role[0], way)
            for other in ("user", "assistant"):
                way = (cost + 1 + more, audit + "R", (*rows, (other, text)))
                merge(after, roles + other[0], way)
        best = after
    ends = [way for roles, way in with_inserts(best).items() if roles == "" or roles[-1] == "a"]
    return min(ends)


def summary(conversation, rows):
    """`rows`: (turn, role, text), nulls as they are."""
    rows = sorted(
        ((turn, role if role is not None else " ", text if text is not None else " ")
         for turn, role, text in rows),
        key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()),
    )
    turns = [row[1:] for row in rows]
    numbers = {row[0] for row in rows if row[0] is not None}
    marks = faults(turns)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:], strict=False)]
    cost, audit, left = every_way(turns)
    lines = "\n".join(f"{role}:{text}" for role, text in left)
    return (
        conversation,
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *[marks.count(name) for name in ("blank", "duplicate", "truncated")],
        sum(pair not in ("su", "ua", "au") for pair in pairs),
        cost,
        audit,
        sha256(lines.encode()).hexdigest(),
    )


TURNS = st.tuples(
    st.sampled_from(["system", "user", "assistant", "tool", "u", ""]),
    st.sampled_from(["A.", "b", "", " \t", "c! ", "d?　", "e"]),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(TURNS, max_size=9))
def test_search_equals_trying_all_edits(turns):
    found = repair.Turns(7)
    for number, turn in enumerate(turns):
        found.add(number, *turn)
    assert found.summary() == summary(7, [(n, *turn) for n, turn in enumerate(turns)])


def odd_conversations():
    rng = random.Random(3)
    rows = []
    for conversation in range(40):
        for turn in range(rng.randrange(9)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool"])
            text = rng.choice(["Yes.", "No", "", "Why?", " ", f"{turn}!", "é\U0001f600."])
            rows.append((conversation, turn + rng.randrange(2) * 3, role, text))
    rows += [(None, 1, "user", "A."), (None, None, None, None), (None, 2, "assistant", "B.")]
    rows += [(90, None, "user", "A."), (90, None, "assistant", "B.")]
    rows += [(91, 5, "user", "A."), (91, 5, "assistant", "C."), (91, 5, "assistant", "B.")] * 2
    rows += [(92, 2**40, "system", "x" * 200_000 + ".")]
    rows += [(93, n, ["user", "assistant"][n % 2], f"{n}.") for n in range(70)]
    rows += [(94, n // 3, ["user", "assistant", "x"][n % 3], f"{n % 11}{'.' * (n % 4)}")
             for n in range(120)]
    rows += [(94, 8, "user", "again.")] * 30
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "x", 3, "y", 4) for row in rows], SCHEMA)


def by_conversation(rows):
    found = {}
    for conversation, *row in rows:
        found.setdefault(conversation, []).append(tuple(row))
    return found


def as_rows(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(row) for row in frame.collect()), key=str)


@pytest.mark.parametrize("hot_turns", [16_384, 25, 3])
def test_conversations(spark, hot_turns):
    rows = odd_conversations()
    random.Random(1).shuffle(rows)
    expected = [summary(*pair) for pair in by_conversation(rows).items()]
    found = repair.conversation_repair(frame(spark, rows), hot_turns=hot_turns)
    assert as_rows(found) == sorted(expected, key=str)


def test_segments_of_any_length(monkeypatch):
    """The segments of long conversations, cut after every turn, and the choice of states."""
    monkeypatch.setattr(repair, "HOT_TURNS", 1)
    rng = random.Random(9)
    import pyarrow as pa

    for size in (1, 2, 3):
        monkeypatch.setattr(repair, "HOT_TURNS", size)
        for _ in range(60):
            rows = [
                (5, n // 2, rng.choice(["system", "user", "assistant", "x"]),
                 rng.choice(["A.", "b", "", "c!"]))
                for n in range(rng.randrange(1, 12))
            ]
            rows.sort()
            seen, columns = set(), {name: [] for name in
                                    ["conv_id", "turn", "role", "text", "copies", "first", "part"]}
            for row in rows:
                first = (row[2:]) not in seen
                seen.add(row[2:])
                for name, value in zip(columns, [*row, 1, first, 0], strict=True):
                    columns[name].append(value)
            batch = pa.RecordBatch.from_pydict(columns)
            segments = list(repair._segments(iter([batch])))
            assert len(segments) == -(-len(rows) // size)
            table = pa.Table.from_batches(segments)
            choices = repair._choices(table)
            met = table.append_column("entry", choices["entry"]).append_column(
                "leaves", choices["leaves"]
            )
            for name, source in [("gaps", "gaps"), ("all_counts", "counts"), ("cost", "cost")]:
                met = met.append_column(name, choices[source])
            met = met.drop_columns(["costs"])
            [found] = repair._digests(iter(met.combine_chunks().to_batches()))
            assert tuple(found.to_pylist()[0].values()) == summary(5, [row[1:] for row in rows])


def test_damage(spark):
    rows = odd_conversations()
    expected, originals = {}, set()
    for conversation, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conversation, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        own = expected.setdefault(conversation, [])
        originals.add(conversation)
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        row = (turn, "user" if kind == 4 else role, text)
        own += [row, row] if kind == 3 else [row]
    turns, copies = repair.damaged(frame(spark, rows))
    found = repair.conversation_repair(turns, copies=copies)
    assert as_rows(found) == sorted((summary(*pair) for pair in expected.items()), key=str)


def test_no_rows_and_only_dropped_rows(spark):
    assert repair.conversation_repair(frame(spark, [])).count() == 0
    from pyspark.sql import functions as F

    none = repair.conversation_repair(frame(spark, [(1, 1, "user", "A.")]), copies=F.lit(0))
    assert as_rows(none) == [(1, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
