"""A Merkle tree over a whole table, with the proof of every row.

Rows are the leaves of one tree per group, in the order of their ids; the roots of the groups are
the leaves of a tree above them. Nothing is sorted to find a leaf's place: the ids of each group
become a compressed bitmap (words of 64 ids, only those that hold any), merged from the partial
words of all tasks, with directories of row counts at four levels. A leaf's place is the count
before its word plus the set bits below its own. Places key the leaves into blocks of 1,024 slots,
each block is reduced by ten levels at once, and block roots are the slots of the next round. The
siblings then come down the same blocks, so only packed blocks travel a second time.

Ids that occur in several rows have a bit for all of them; only their words take a further way, in
which equal rows are counted and the others placed by the head of their digest.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.checksum_sql import crc32_sql
from tidemark.llm.text import few_rows_a_batch
from tidemark.operators.hot import running_totals
from tidemark.session import cut

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
WORD_BITS = 6
# Bits of a word number that one level of the directory takes.
LEVEL_BITS = 14
LEVELS = 3
# The word of rows without an id, before all others.
NO_ID = -(1 << 57) - 1
BLOCK_LEVELS = 10
BLOCK = 1 << BLOCK_LEVELS
# Characters of a digest by which rows of one id are dealt out.
HEAD_CHARS = 4
# Words with repeated ids that are broadcast at most (about 40 bytes each); beyond, Spark shuffles.
BROADCAST_WORDS = 200_000
# Places that one task writes for a row that occurs many times.
COPIES_A_TASK = 100_000

BLOCK_SCHEMA = (
    "tree string, block bigint, n bigint, root string, "
    "digests array<string>, ids array<bigint>, claimed array<string>"
)
PATH_SCHEMA = "tree string, pos bigint, subroot string, path array<string>"
PROOF_SCHEMA = (
    "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"
)


def part(value: Column) -> Column:
    """A value with its length in UTF-8, `-` for null; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[part(value) for value in values]), 256)


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    claims: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes `columns`. Per group, two consecutive nodes become one until one remains, the
    subroot; subroots in the order of their groups likewise give the root. `claims` replaces
    columns by what someone says they are: `folded_root` is the root that follows from the claimed
    row and the siblings of the tree, `verified` whether it is the root.

    Null values hash as `-`; rows without an id come first in their group, and the group without a
    name before the others. Rows that share an id are in the order of their leaves; equal rows get
    one place each. No other column is read. An empty table gives an empty result.
    """
    few_rows_a_batch(docs.sparkSession)
    rows = _leaves(docs, columns, id_col, group_col, claims or {})
    rounds = _rounds(_places(rows))
    subroots = rounds[-1].select("tree", F.col("root").alias("leaf"), F.lit(1).alias("one"))
    trees = cut(running_totals(subroots, [], "tree", {"upto": "one"}))
    n_trees = trees.count()
    above = _rounds(
        trees.select(
            F.lit("").alias("tree"),
            (F.col("upto") - 1).alias("pos"),
            F.lit(n_trees).cast("bigint").alias("n"),
            F.lit(None).cast("bigint").alias("doc_id"),
            "leaf",
            F.lit(None).cast("string").alias("claimed"),
        )
    )
    top = above[-1].select("tree", F.lit(0).cast("bigint").alias("pos"), "root").first()
    root = top["root"] if top else None
    none = F.array().cast("array<string>")
    start = above[-1].select(
        "tree", F.col("block").alias("pos"), F.col("root").alias("subroot"), none.alias("path")
    )
    of_trees = _down(above, start).select(F.col("pos").alias("_pos"), "path")
    paths = trees.join(of_trees, F.col("upto") - 1 == F.col("_pos")).select(
        "tree", F.lit(0).cast("bigint").alias("pos"), F.col("leaf").alias("subroot"), "path"
    )
    proofs = _met(rounds[0], _down(rounds[1:], paths)).mapInArrow(_proofs, PROOF_SCHEMA)
    return proofs.select(
        F.col("doc_id").alias(id_col),
        "leaf",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )


def _leaves(docs, columns, id_col, group_col, claims) -> DataFrame:
    """(tree, doc_id, leaf, claimed), the last only where it is another; texts are read once."""
    told = [claims.get(name, F.col(name)) for name in columns]
    differs = F.lit(False)
    for name, claim in claims.items():
        differs |= ~claim.eqNullSafe(F.col(name))
    group = F.col(group_col).cast("string")
    return cut(
        docs.select(
            F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),
            F.col(id_col).cast("bigint").alias("doc_id"),
            leaf([F.col(name) for name in columns]).alias("leaf"),
            F.when(differs, leaf(told)).alias("claimed"),
        ).select(
            "*",
            F.coalesce(F.shiftright("doc_id", WORD_BITS), F.lit(NO_ID)).alias("word"),
            F.coalesce(F.col("doc_id").bitwiseAND(63), F.lit(0)).cast("int").alias("bit"),
        )
    )


def _places(rows: DataFrame) -> DataFrame:
    """(tree, pos, n, doc_id, leaf, claimed): the place of each leaf among the n of its tree."""
    merged = rows.groupBy("tree", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("n_rows")
    )
    words = cut(_directory(cut(merged)))
    repeats = F.col("n_rows") > F.bit_count("bits")
    repeated = words.where(repeats).select("tree", "word", "n", "before")
    n_repeated = repeated.count()
    once = rows
    if n_repeated:
        listed = F.broadcast(repeated) if n_repeated <= BROADCAST_WORDS else repeated
        once = rows.join(listed, ["tree", "word"], "left_anti")
    # Set bits below the own one; a shift of -1 leaves no overflow at the last bit.
    rank = F.expr("before + bit_count(bits & ~shiftleft(-1L, bit))")
    columns = ["tree", "pos", "n", "doc_id", "leaf", "claimed"]
    found = (
        once.join(words.where(~repeats), ["tree", "word"]).withColumn("pos", rank).select(*columns)
    )
    if not n_repeated:
        return found
    return found.unionByName(_repeated(rows, repeated, listed).select(*columns))


def _directory(words: DataFrame) -> DataFrame:
    """The words with `before`, the tree's rows in all earlier words, and `n`, all of the tree's.

    Counts are added up in a hierarchy of word numbers, so that no window holds more than 65,537
    rows, however many words or gaps there are.
    """
    levels = [words.withColumnRenamed("word", "node")]
    for _ in range(LEVELS):
        above = F.shiftright("node", LEVEL_BITS).alias("node")
        levels.append(levels[-1].groupBy("tree", above).agg(F.sum("n_rows").alias("n_rows")))
    tree = Window.partitionBy("tree")
    found = levels[-1].select(
        "tree",
        "node",
        F.sum("n_rows").over(tree).alias("n"),
        _earlier("n_rows", tree.orderBy("node")).alias("before"),
    )
    for level in reversed(levels[:-1]):
        above = level.withColumn("above", F.shiftright("node", LEVEL_BITS))
        siblings = Window.partitionBy("tree", "above").orderBy("node")
        found = (
            above.withColumn("inner", _earlier("n_rows", siblings))
            .join(
                found.select("tree", F.col("node").alias("above"), "n", "before"), ["tree", "above"]
            )
            .withColumn("before", F.col("before") + F.col("inner"))
            .drop("above", "inner")
        )
    return found.withColumnRenamed("node", "word")


def _earlier(column: str, window) -> Column:
    """The sum over the earlier rows of an ordered window."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _repeated(rows: DataFrame, repeated: DataFrame, listed: DataFrame) -> DataFrame:
    """Places of the rows in words where some id has several rows.

    Equal rows are counted before they travel, as they differ in their place only. The order is
    that of (id, leaf); rows of one id are dealt out by the head of their leaf.
    """
    some = rows.join(listed, ["tree", "word"], "left_semi")
    one = ["tree", "word", "bit"]
    copies = cut(
        some.groupBy(*one, "doc_id", "leaf", "claimed")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("head", F.substring("leaf", 1, HEAD_CHARS))
    )
    heads = copies.groupBy(*one, "head").agg(F.sum("copies").alias("copies"))
    ids = heads.groupBy(*one).agg(F.sum("copies").alias("copies"))
    ids = ids.select(
        *one, _earlier("copies", Window.partitionBy("tree", "word").orderBy("bit")).alias("of_id")
    )
    heads = heads.select(
        *one, "head", _earlier("copies", Window.partitionBy(*one).orderBy("head")).alias("of_head")
    )
    inner = _earlier("copies", Window.partitionBy(*one, "head").orderBy("leaf"))
    placed = (
        copies.withColumn("inner", inner)
        .join(heads, [*one, "head"])
        .join(ids, one)
        .join(repeated, ["tree", "word"])
        .withColumn("first", F.expr("before + of_id + of_head + inner"))
    )
    steps = F.expr(f"explode(sequence(0L, copies - 1, {COPIES_A_TASK}L))")
    return (
        placed.withColumn("step", steps)
        .repartition("tree", "first", "step")
        .withColumn(
            "copy", F.expr(f"explode(sequence(step, least(step + {COPIES_A_TASK}, copies) - 1))")
        )
        .withColumn("pos", F.col("first") + F.col("copy"))
    )


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of slots with their roots, round by round, until each tree has one block."""
    rounds = []
    while True:
        dealt = nodes.withColumn("block", F.shiftright("pos", BLOCK_LEVELS))
        blocks = cut(dealt.groupBy("tree", "block").applyInArrow(_block, BLOCK_SCHEMA))
        rounds.append(blocks)
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= BLOCK:
            return rounds
        nodes = blocks.select(
            "tree",
            F.col("block").alias("pos"),
            F.ceil(F.col("n") / BLOCK).alias("n"),
            F.lit(None).cast("bigint").alias("doc_id"),
            F.col("root").alias("leaf"),
            F.lit(None).cast("string").alias("claimed"),
        )


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(digests: list[str], n: int) -> list[list[str]]:
    """The nodes of a block, level by level: up to its root, or by all levels of a full block."""
    found = [digests]
    for _ in range(BLOCK_LEVELS if n > BLOCK else (n - 1).bit_length()):
        last = found[-1]
        found.append([hashed("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return found


def _block(table: pa.Table) -> pa.Table:
    """One block: its nodes in their slots, and its root."""
    first = table.column("block")[0].as_py() << BLOCK_LEVELS
    slots = [0] * table.num_rows
    for row, pos in enumerate(table.column("pos").to_pylist()):
        slots[pos - first] = row
    ordered = table.take(pa.array(slots))
    digests = ordered.column("leaf").to_pylist()
    n = table.column("n")[0].as_py()
    return pa.table(
        {
            "tree": pa.array([table.column("tree")[0].as_py()], pa.string()),
            "block": pa.array([first >> BLOCK_LEVELS], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "root": [_levels(digests, n)[-1][0]],
            "digests": pa.array([digests], pa.list_(pa.string())),
            "ids": pa.array([ordered.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "claimed": pa.array([ordered.column("claimed").to_pylist()], pa.list_(pa.string())),
        }
    )


def _met(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Each block with the subroot of its tree and the path from its root upwards."""
    above = paths.withColumnRenamed("pos", "block")
    return blocks.join(above, ["tree", "block"])


def _down(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the lowest nodes of the rounds, given those of the highest roots."""
    for blocks in reversed(rounds):
        paths = _met(blocks, paths).mapInArrow(_spread, PATH_SCHEMA)
    return paths


def _steps(levels: list[list[str]], slot: int) -> list[str]:
    """The siblings of a slot from below: `r` or `l` and the digest, empty for a lone node."""
    found = []
    for nodes in levels[:-1]:
        other = slot ^ 1
        alone = other >= len(nodes)
        found.append("" if alone else ("r" if other > slot else "l") + nodes[other])
        slot >>= 1
    return found


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The blocks of a batch, one at a time as Python values."""
    for number in range(batch.num_rows):
        yield batch.slice(number, 1).to_pylist()[0]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            levels = _levels(row["digests"], row["n"])
            n, first = len(row["digests"]), row["block"] << BLOCK_LEVELS
            paths = [_steps(levels, slot) + row["path"] for slot in range(n)]
            yield pa.RecordBatch.from_pydict(
                {
                    "tree": pa.array([row["tree"]] * n, pa.string()),
                    "pos": pa.array(range(first, first + n), pa.int64()),
                    "subroot": pa.array([row["subroot"]] * n, pa.string()),
                    "path": pa.array(paths, pa.list_(pa.string())),
                }
            )


def folded(digest: str, steps: Sequence[str]) -> str:
    """The root that follows from a leaf and the siblings on its path."""
    for step in steps:
        side, sibling = step[:1], step[1:]
        digest = hashed(sibling + digest if side == "l" else digest + sibling)
    return digest


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every leaf's proof, and the root that follows from its claimed or else its own digest."""
    for batch in batches:
        for row in _rows(batch):
            levels = _levels(row["digests"], row["n"])
            above = "".join(step[1:] for step in row["path"])
            proofs, roots = [], []
            for slot, (own, claim) in enumerate(zip(row["digests"], row["claimed"], strict=True)):
                steps = _steps(levels, slot)
                proofs.append(hashed("".join(step[1:] for step in steps) + above))
                told = own if claim is None else claim
                roots.append(folded(told, steps + row["path"]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(row["ids"], pa.int64()),
                    "leaf": pa.array(row["digests"], pa.string()),
                    "subroot": pa.array([row["subroot"]] * len(proofs), pa.string()),
                    "proof_sha256": pa.array(proofs, pa.string()),
                    "folded_root": pa.array(roots, pa.string()),
                }
            )


def tampered(id_col: str = "doc_id", count_col: str = "n_chars") -> Column:
    """The count, one more where 7 divides the CRC-32 of the id in decimal (null: of no text)."""
    checksum = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.when(checksum % 7 == 0, F.col(count_col) + 1).otherwise(F.col(count_col))


def sql() -> str:
    """The query in DuckDB: all nodes of both kinds of trees by recursion, then each row's siblings."""

    def hash_of(count: str) -> str:
        values = ["doc_id", "source", "lang", count, "text"]
        parts = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values]
        return f"sha256({' || '.join(parts)})"

    def nodes(name: str, source: str) -> str:
        return f"""{name} AS (SELECT tree, 0 AS level, pos, leaf AS digest, n FROM {source}
  UNION ALL SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)),
                   (n + 1) // 2
            FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n)"""

    def steps(name: str, tree: str, pos: str, part: int) -> str:
        return f"""SELECT p.tree, p.pos, {part} AS part, m.level,
       coalesce(CASE WHEN s.pos > m.pos THEN 'r' ELSE 'l' END || s.digest, '') AS step
FROM places p JOIN {name} m ON m.tree = {tree} AND m.pos = {pos} >> m.level AND m.n > 1
LEFT JOIN {name} s ON s.tree = m.tree AND s.level = m.level AND s.pos = xor(m.pos, 1)"""

    crc = crc32_sql("coalesce(doc_id::VARCHAR, '')")
    return f"""
WITH RECURSIVE told AS (
  SELECT *, n_chars + CASE WHEN {crc} % 7 = 0 THEN 1 ELSE 0 END AS told FROM documents),
leaves AS (SELECT coalesce('=' || lang, '') AS tree, doc_id, {hash_of('n_chars')} AS leaf,
                  {hash_of('told')} AS claimed FROM told),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1
                     AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{nodes('nodes', 'placed')},
subroots AS (SELECT tree AS name, digest AS leaf, '' AS tree,
                    row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
             FROM nodes WHERE n = 1),
{nodes('tops', 'subroots')},
places AS (SELECT p.*, t.pos AS tree_pos, t.leaf AS subroot
           FROM placed p JOIN subroots t ON t.name = p.tree),
steps AS ({steps('nodes', 'p.tree', 'p.pos', 0)}
  UNION ALL {steps('tops', "''", 'p.tree_pos', 1)}),
paths AS (SELECT tree, pos, list(step ORDER BY part, level) AS steps,
                 string_agg(substr(step, 2), '' ORDER BY part, level) AS siblings
          FROM steps GROUP BY tree, pos),
folded AS (
  SELECT p.*, coalesce(a.siblings, '') AS siblings,
         list_reduce(list_prepend(p.claimed, coalesce(a.steps, [])), lambda x, s: CASE s[1]
           WHEN 'l' THEN sha256(substr(s, 2) || x) ELSE sha256(x || substr(s, 2)) END) AS folded_root
  FROM places p LEFT JOIN paths a ON a.tree = p.tree AND a.pos = p.pos)
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(siblings) AS proof_sha256, folded_root,
       folded_root = r.digest AS verified
FROM folded, (SELECT digest FROM tops WHERE n = 1) r"""
