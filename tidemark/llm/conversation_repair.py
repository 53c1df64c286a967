"""The cheapest edits that give each conversation a legal order of roles.

Every conversation is a lattice: nodes are (turns passed, state of the order of roles), edges are
the edits. Two heaps, one from the start and one from the legal ends, settle nodes until their
least costs together exceed the best path found, so all crossings of equal cost are finished; a
walk over nodes that lie on such paths then takes the least letter at each step, which gives the
least concatenated audit. From a node each letter leads to one node only, so the audit alone says
what the repaired turns are.

Spark deals conversations out by id and sorts their turns; tasks repair them as they pass by. A
conversation of more than `hot_turns` turns is cut into segments instead: its turns are dealt out
by range, every segment is searched from each state to each state, and only these costs, some
numbers per segment, meet in one place, where the states at the cuts are chosen.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import sha256
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.checksum_sql import crc32_sql
from tidemark.llm.text import few_rows_a_batch
from tidemark.session import cut

# Turns of a conversation that one task holds at most, and of a segment of a longer one.
HOT_TURNS = 16_384
# Long conversations that are broadcast at most (8 bytes each); beyond, Spark shuffles.
BROADCAST_IDS = 1_000_000
# Characters of a text by which turns with the same number and role are dealt out.
HEAD_CHARS = 32

SPACE = " \t\n\v\f\r"
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COSTS = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
LEGAL_PAIRS = ("su", "ua", "au")

# States: nothing yet; after the system's turn; after a user's; after an assistant's.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
# The state after a kept turn, by state and initial.
KEPT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
# The state after a turn that is inserted or gets a new role, and that role.
NEXT = [USER, USER, ASSISTANT, USER]
ROLES = {USER: "user", ASSISTANT: "assistant"}
# What is inserted at the end of a conversation, by state, and what that costs.
ENDS = ["", INSERT * 2, INSERT, ""]
END_COSTS = [len(letters) * COSTS[INSERT] for letters in ENDS]

SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
FAULTS = ["blank", "duplicate", "truncated"]


def fault_of(role: str, text: str, seen: set) -> str | None:
    """The first fault of a turn; `seen` holds the turns before it and gets this one."""
    bare = text.rstrip(SPACE)
    digest = sha256(f"{len(role)}:{role}{text}".encode(errors="surrogatepass")).digest()
    again = digest in seen
    seen.add(digest)
    if not bare:
        return "blank"
    if again:
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


class Lattice:
    """Searches over turns given as (initial of the role, fault)."""

    def __init__(self, turns: Sequence[tuple[str, str | None]]):
        self.turns = turns
        self.steps = [self._steps(*turn) for turn in turns]

    @staticmethod
    def _steps(initial: str, fault: str | None) -> list[list[tuple[str, int, int, int]]]:
        """For each state the edits of a turn: letter, turns passed, state after, cost."""
        found = []
        extra = TRUNCATED_COST if fault == "truncated" else 0
        for state in STATES:
            edits = [(DELETE, 1, state, COSTS[DELETE]), (INSERT, 0, NEXT[state], COSTS[INSERT])]
            if fault not in ("blank", "duplicate"):
                if initial in KEPT[state]:
                    edits.append((KEEP, 1, KEPT[state][initial], COSTS[KEEP] + extra))
                edits.append((REROLE, 1, NEXT[state], COSTS[REROLE] + extra))
            found.append(edits)
        return found

    def _after(self, node: int) -> Iterator[tuple[int, int, str]]:
        place, state = node >> 2, node & 3
        if place < len(self.turns):
            for letter, passed, after, cost in self.steps[place][state]:
                yield (place + passed) << 2 | after, cost, letter

    def _before(self, node: int) -> Iterator[tuple[int, int]]:
        place, state = node >> 2, node & 3
        for came in (place - 1, place):
            if 0 <= came < len(self.turns):
                for earlier in STATES:
                    for _, passed, after, cost in self.steps[came][earlier]:
                        if after == state and came + passed == place:
                            yield came << 2 | earlier, cost

    def search(self, start: int, ends: dict[int, int]) -> tuple[int, str, int] | None:
        """The cheapest way from a state to one of `ends` (state: what then follows costs).

        Gives the whole cost, the least audit, and the state it ends in; None without a way.
        """
        last = len(self.turns) << 2
        costs = ({start: 0}, {last | state: cost for state, cost in ends.items()})
        heaps = ([(0, start)], [(cost, node) for node, cost in costs[1].items()])
        heapq.heapify(heaps[1])
        done: tuple[set[int], set[int]] = (set(), set())
        best = None
        while heaps[0] and heaps[1]:
            if best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
                break
            side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
            cost, node = heapq.heappop(heaps[side])
            if node in done[side]:
                continue
            done[side].add(node)
            own, other = costs[side], costs[1 - side]
            if node in other and (best is None or cost + other[node] < best):
                best = cost + other[node]
            for edge in self._after(node) if side == 0 else self._before(node):
                there, total = edge[0], cost + edge[1]
                if there not in own or total < own[there]:
                    own[there] = total
                    heapq.heappush(heaps[side], (total, there))
                if there in other and (best is None or total + other[there] < best):
                    best = total + other[there]
        if best is None:
            return None
        return best, *self._least(start, best, costs, done, ends)

    def _least(self, start, best, costs, done, ends) -> tuple[str, int]:
        """The least audit over all crossings of the two searches that cost `best`."""
        fore, back = costs
        last = len(self.turns) << 2

        def ends_well(node: int, spent: int) -> bool:
            return node >= last and node & 3 in ends and spent + ends[node & 3] == best

        def crosses(node: int) -> bool:
            spent = fore[node]
            return ends_well(node, spent) or any(
                there in done[1] and spent + cost + back[there] == best
                for there, cost, _ in self._after(node)
            )

        # Nodes of the first search that lie on a best path
        todo = [node for node in done[0] if crosses(node)]
        useful = set(todo)
        while todo:
            node = todo.pop()
            for earlier, cost in self._before(node):
                if earlier in done[0] and earlier not in useful:
                    if fore[earlier] + cost == fore[node]:
                        useful.add(earlier)
                        todo.append(earlier)

        letters, node, spent = [], start, 0
        while not ends_well(node, spent):
            letter, node, spent = min(
                (letter, there, spent + cost)
                for there, cost, letter in self._after(node)
                if (there in useful and fore[there] == spent + cost)
                or (there in done[1] and spent + cost + back[there] == best)
            )
            letters.append(letter)
        return "".join(letters), node & 3


def repaired(
    turns: Sequence[tuple[str, str]], audit: str, state: int = START
) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that an audit leaves, from a state on."""
    place = 0
    for letter in audit:
        if letter == KEEP:
            role, text = turns[place]
            state = KEPT[state][role[:1]]
            yield role, text
        elif letter != DELETE:
            state = NEXT[state]
            yield ROLES[state], "" if letter == INSERT else turns[place][1]
        place += letter != INSERT


class Digest:
    """SHA-256 of `role:text` lines, one by one."""

    def __init__(self):
        self.hash, self.empty = sha256(), True

    def add(self, turns: Iterator[tuple[str, str]]) -> None:
        for role, text in turns:
            line = f"{role}:{text}" if self.empty else f"\n{role}:{text}"
            self.hash.update(line.encode(errors="surrogatepass"))
            self.empty = False


@dataclass
class Turns:
    """A conversation, or a segment of one, that grows by a turn at a time."""

    conversation: object
    turns: list = field(default_factory=list)
    cells: list = field(default_factory=list)
    numbers: list = field(default_factory=list)
    counts: dict = field(default_factory=lambda: dict.fromkeys([*FAULTS, "illegal"], 0))
    seen: set = field(default_factory=set)

    def add(self, number, role: str, text: str, first: bool = True) -> None:
        """Turns come by number; `first` is false if an earlier segment has the same turn."""
        fault = fault_of(role, text, self.seen)
        if not first and fault in (None, "truncated"):
            fault = "duplicate"
        if fault:
            self.counts[fault] += 1
        if self.cells and self.cells[-1][0] + role[:1] not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        if number is not None and (not self.numbers or self.numbers[-1] != number):
            self.numbers.append(number)
        self.turns.append((role, text))
        self.cells.append((role[:1], fault))

    @property
    def gaps(self) -> int:
        numbers = self.numbers
        return numbers[-1] - numbers[0] + 1 - len(numbers) if numbers else 0

    def summary(self) -> tuple:
        cost, audit, state = Lattice(self.cells).search(START, dict(enumerate(END_COSTS)))
        audit += ENDS[state]
        digest = Digest()
        digest.add(repaired(self.turns, audit))
        counts = [self.counts[name] for name in [*FAULTS, "illegal"]]
        return (self.conversation, self.gaps, *counts, cost, audit, digest.hash.hexdigest())


def conversation_repair(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
    hot_turns: int = HOT_TURNS,
) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Turns are taken by number, nulls first, and equal numbers by role and then text. `copies` says
    how often a row occurs (once by default); a conversation whose rows all occur 0 times is
    returned with zeros, an empty audit and the digest of nothing. A null role or text is one
    space; a role without an initial cannot be kept. Rows without a conversation id are one
    conversation. No other column is read. An empty table gives an empty result.
    """
    few_rows_a_batch(turns.sparkSession)
    rows = turns.select(
        F.col(id_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("bigint").alias("copies"),
    )
    counted = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"))
    # Fewer than one in `hot_turns` turns, and usually none
    long = cut(counted.where(F.col("n") > hot_turns).select("conv_id"))
    n_long = long.count()
    columns = f"conv_id bigint, {SUMMARY}"
    if not n_long:
        return _named(_by_conversation(rows).mapInArrow(_whole, columns), id_col)
    listed = F.broadcast(long) if n_long <= BROADCAST_IDS else long
    same = rows["conv_id"].eqNullSafe(listed["conv_id"])
    short = rows.join(listed, same, "left_anti")
    found = _by_conversation(short).mapInArrow(_whole, columns)
    return _named(found.unionByName(_long(rows.join(listed, same, "left_semi"))), id_col)


def _named(found: DataFrame, id_col: str) -> DataFrame:
    return found.withColumnRenamed("conv_id", id_col)


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in columns], strict=True)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_SUMMARY_ARROW = pa.schema(
    [
        *[(n, pa.int64()) for n in ["conv_id", "gaps", *FAULTS, "illegal", "cost"]],
        *[(n, pa.string()) for n in ["audit", "repaired_sha256"]],
    ]
)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs conversations that come one after the other."""
    current, done = None, []
    for conversation, number, role, text, copies in _rows(
        batches, "conv_id", "turn", "role", "text", "copies"
    ):
        if current is None or current.conversation != conversation:
            if current is not None:
                done.append(current.summary())
            current = Turns(conversation)
            if len(done) == 1_000:
                yield _table(done, _SUMMARY_ARROW)
                done = []
        for _ in range(copies):
            current.add(number, role, text)
    if current is not None:
        done.append(current.summary())
    yield _table(done, _SUMMARY_ARROW)


# Long conversations, in segments ------------------------------------------------------------

_PAIRS = [(a, b) for a in STATES for b in STATES]
_SEGMENT = (
    "conv_id bigint, part int, segment bigint, numbers array<bigint>, n_numbers bigint, "
    "initials array<string>, counts array<bigint>, costs array<bigint>, ranks array<bigint>, "
    "audits array<string>, roles array<string>, texts array<string>"
)
_SEGMENT_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("segment", pa.int64()),
        ("numbers", pa.list_(pa.int64())),
        ("n_numbers", pa.int64()),
        ("initials", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("costs", pa.list_(pa.int64())),
        ("ranks", pa.list_(pa.int64())),
        ("audits", pa.list_(pa.string())),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
    ]
)
_CHOICE = (
    "conv_id bigint, part int, segment bigint, entry int, leaves int, gaps bigint, "
    "counts array<bigint>, cost bigint"
)
_CHOICE_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("segment", pa.int64()),
        ("entry", pa.int32()),
        ("leaves", pa.int32()),
        ("gaps", pa.int64()),
        ("counts", pa.list_(pa.int64())),
        ("cost", pa.int64()),
    ]
)


def _long(rows: DataFrame) -> DataFrame:
    """The same summary for conversations of any length."""
    digest = F.sha2(F.col("text"), 256)
    rows = rows.where(F.col("copies") > 0).withColumn("digest", digest)
    # The first number that a turn occurs under; later ones are duplicates.
    number = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    firsts = (
        rows.groupBy("conv_id", "role", "digest")
        .agg(F.min(number).alias("number"))
        .select(
            F.col("conv_id").alias("_conv"),
            F.col("role").alias("_role"),
            F.col("digest").alias("_digest"),
            F.col("number.turn").alias("_turn"),
        )
    )
    same = (
        (F.col("digest") == F.col("_digest"))
        & (F.col("role") == F.col("_role"))
        & F.col("conv_id").eqNullSafe(F.col("_conv"))
        & F.col("turn").eqNullSafe(F.col("_turn"))
    )
    marked = rows.join(firsts, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        F.col("_digest").isNotNull().alias("first"),
        F.substring("text", 1, HEAD_CHARS).alias("head"),
    )
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        marked.repartitionByRange(n_parts, "conv_id", "turn", "role", "head")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumn("part", F.spark_partition_id())
    )
    segments = cut(ranged.mapInArrow(_segments, _SEGMENT))
    choices = cut(
        segments.drop("audits", "roles", "texts")
        .groupBy("conv_id")
        .applyInArrow(_choices, _CHOICE)
        .withColumnsRenamed({"conv_id": "_conv", "counts": "all_counts"})
    )
    met = segments.select("conv_id", "part", "segment", "audits", "roles", "texts").join(
        choices.withColumnsRenamed({"part": "_part", "segment": "_segment"}),
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & (F.col("part") == F.col("_part"))
        & (F.col("segment") == F.col("_segment")),
    )
    # A digest of all turns takes them one after the other: its state passes over the segments.
    in_order = met.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    return in_order.mapInArrow(_digests, f"conv_id bigint, {SUMMARY}")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts sorted turns into segments and searches each from every state to every state."""
    current, part, segment = None, None, 0
    columns = ["conv_id", "turn", "role", "text", "copies", "first", "part"]
    for conversation, number, role, text, copies, first, part in _rows(batches, *columns):
        for copy in range(copies):
            if current is not None and (
                current.conversation != conversation or len(current.turns) >= HOT_TURNS
            ):
                yield _segment(current, part, segment)
                segment += 1
                # Copies may go on in the next segment
                last = current.turns[-1] if current.conversation == conversation else None
                current = Turns(conversation)
                if last == (role, text):
                    first = False
            elif current is None:
                current = Turns(conversation)
            current.add(number, role, text, first)
    if current is not None:
        yield _segment(current, part, segment)


def _segment(found: Turns, part: int, number: int) -> pa.RecordBatch:
    lattice = Lattice(found.cells)
    ways = [lattice.search(start, {end: 0}) for start, end in _PAIRS]
    audits = [way[1] if way else None for way in ways]
    # The order of the audits from the same state
    ranks = [
        sorted(x for x in audits[start * 4 : start * 4 + 4] if x is not None).index(audit)
        if (audit := audits[start * 4 + end]) is not None
        else None
        for start, end in _PAIRS
    ]
    row = (
        found.conversation,
        part,
        number,
        found.numbers[:1] + found.numbers[-1:],
        len(found.numbers),
        [found.cells[0][0], found.cells[-1][0]],
        [found.counts[name] for name in [*FAULTS, "illegal"]],
        [way[0] if way else None for way in ways],
        ranks,
        audits,
        [role for role, _ in found.turns],
        [text for _, text in found.turns],
    )
    return _table([row], _SEGMENT_ARROW)


def _choices(table: pa.Table) -> pa.Table:
    """The states at the cuts of one conversation: a few numbers for each of its segments."""
    rows = sorted(table.to_pylist(), key=lambda row: (row["part"], row["segment"]))
    rest = list(END_COSTS)
    picks = []
    for row in reversed(rows):
        best = []
        for start in STATES:
            ways = [
                (row["costs"][i] + rest[end], row["ranks"][i], end)
                for end in STATES
                if row["costs"][i := start * 4 + end] is not None and rest[end] is not None
            ]
            best.append(min(ways) if ways else None)
        picks.append(best)
        rest = [way[0] if way else None for way in best]
    counts = [sum(row["counts"][n] for row in rows) for n in range(len(FAULTS) + 1)]
    for before, after in pairwise(rows):
        counts[-1] += before["initials"][1] + after["initials"][0] not in LEGAL_PAIRS
    numbered = [row for row in rows if row["n_numbers"]]
    distinct = sum(row["n_numbers"] for row in numbered) - sum(
        before["numbers"][-1] == after["numbers"][0] for before, after in pairwise(numbered)
    )
    gaps = numbered[-1]["numbers"][-1] - numbered[0]["numbers"][0] + 1 - distinct if numbered else 0
    found, state = [], START
    for row, best in zip(rows, reversed(picks), strict=True):
        leaves = best[state][2]
        place = (row["conv_id"], row["part"], row["segment"])
        found.append((*place, state, leaves, gaps, counts, rest[START]))
        state = leaves
    return pa.Table.from_batches([_table(found, _CHOICE_ARROW)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of conversations whose segments come in order."""
    columns = ["conv_id", "audits", "roles", "texts", "entry", "leaves", "gaps", "all_counts", "cost"]
    current = None

    def finished() -> pa.RecordBatch:
        conversation, fixed, state, audit, digest = current
        audit.append(ENDS[state])
        digest.add(repaired([], ENDS[state], state))
        gaps, counts, cost = fixed
        row = (conversation, gaps, *counts, cost, "".join(audit), digest.hash.hexdigest())
        return _table([row], _SUMMARY_ARROW)

    for conversation, audits, roles, texts, entry, leaves, *fixed in _rows(batches, *columns):
        if current is None or current[0] != conversation:
            if current is not None:
                yield finished()
            current = [conversation, fixed, START, [], Digest()]
        audit = audits[entry * 4 + leaves]
        current[2] = leaves
        current[3].append(audit)
        current[4].add(repaired(list(zip(roles, texts, strict=True)), audit, entry))
    if current is not None:
        yield finished()


# The damage of the query --------------------------------------------------------------------


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """Turns with faults by the CRC-32 of `conv_id:turn`, and how often each row occurs."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(n).cast("string"), F.lit(" ")) for n in ("conv_id", "turn")]
    )
    kind = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind.isin(0, 1), "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows, F.col("copies")


def sql() -> str:
    """The query in DuckDB: the cheapest way to each state, turn by turn; up to two insertions
    before a turn, as more come back to a state they left."""
    key = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
    inserts = [
        (state, n, to, "".join(f"\n{ROLES[s]}:" for s in path), n * COSTS[INSERT])
        for state in STATES
        for n, path in enumerate([[], [NEXT[state]], [NEXT[state], NEXT[NEXT[state]]]])
        for to in [path[-1] if path else state]
    ]
    inserted = ", ".join(
        f"({s}, '{INSERT * n}', {to}, {cost}, '{text}')" for s, n, to, text, cost in inserts
    )
    kept = ", ".join(f"({s}, '{i}', {to})" for s in STATES for i, to in KEPT[s].items())
    new_roles = ", ".join(f"({s}, {to}, '{ROLES[to]}')" for s, to in enumerate(NEXT))
    ends = ", ".join(
        f"({state}, '{letters}', {cost}, '{''.join(chr(10) + r + ':' for r in roles)}')"
        for state, (letters, cost) in enumerate(zip(ENDS, END_COSTS, strict=True))
        for roles in [{"": [], "I": ["assistant"], "II": ["user", "assistant"]}[letters]]
    )
    return rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql(key)} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                       ELSE text END AS text,
             unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1
                AS i, left(role, 1) AS l FROM d),
t AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again,
             regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?')
                AS is_cut,
             lag(l) OVER (PARTITION BY conv_id ORDER BY i) || l AS pair FROM o),
f AS (SELECT *, CASE WHEN is_blank THEN 'blank' WHEN is_again THEN 'duplicate'
                     WHEN is_cut THEN 'truncated' ELSE '' END AS fault FROM t),
inserts(s, letters, s2, cost, lines) AS (VALUES {inserted}),
kept(s, l, s2) AS (VALUES {kept}),
new_roles(s, s2, role) AS (VALUES {new_roles}),
edits AS (
  SELECT conv_id, i, s, s AS s2, 'D' AS letter, 2 AS cost, '' AS line
  FROM f, (SELECT unnest([0, 1, 2, 3]) AS s)
  UNION ALL
  SELECT conv_id, i, s, s2, 'K', CASE fault WHEN 'truncated' THEN 5 ELSE 0 END,
         chr(10) || role || ':' || text FROM f JOIN kept USING (l)
  WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, s, s2, 'R', CASE fault WHEN 'truncated' THEN 6 ELSE 1 END,
         chr(10) || n.role || ':' || text FROM f, new_roles n
  WHERE fault NOT IN ('blank', 'duplicate')),
ids AS (SELECT DISTINCT conv_id FROM conversations),
w AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} AS best FROM ids
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.s2,
         min({{'cost': w.best.cost + n.cost + e.cost,
               'audit': w.best.audit || n.letters || e.letter,
               'lines': w.best.lines || n.lines || e.line}})
  FROM w JOIN inserts n ON n.s = w.s
         JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i AND e.s = n.s2
  GROUP BY w.conv_id, w.i, e.s2),
sizes AS (SELECT conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)
                 AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
                 count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                 count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                 count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM f GROUP BY conv_id),
ends(s, letters, cost, lines) AS (VALUES {ends}),
b AS (SELECT w.conv_id, min({{'cost': w.best.cost + e.cost, 'audit': w.best.audit || e.letters,
                              'lines': w.best.lines || e.lines}}) AS best
      FROM w LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM w.conv_id JOIN ends e ON e.s = w.s
      WHERE w.i = coalesce(z.n, 0) GROUP BY w.conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(substr(best.lines, 2)) AS repaired_sha256
FROM b LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM b.conv_id"""
