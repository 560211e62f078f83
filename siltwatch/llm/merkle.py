"""Merkle manifest of a dataset in the layout of van Emde Boas.

Every source is a tree of three children a node over its rows; the sources are the
leaves of one more tree. A tree is cut into blocks, aligned subtrees of six levels, and
a block is one row that stores its nodes by recursive splitting at half height, so the
nodes of any path lie close together. Where a node is follows from its level and number
alone. Roots of blocks are the leaves of the next round, so a source of any size is a
few rounds of many small tasks. Siblings are read back from the stored blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import staged
from siltwatch.llm.numbering import numbered
from siltwatch.llm.sharding import CRC_TABLE, crc_sql

ARITY = 3
STEPS = 6
"""Levels of a block above its leaves."""
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
"""Columns of a leaf, in the order they are hashed."""


def tree_size(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where nodes ``index`` of a depth (root: 0) lie in a tree of ``levels`` levels.

    The upper half of the levels comes first as a tree of its own, then each tree below
    it in order, all of them laid out by the same rule.
    """
    at = np.zeros(len(index), dtype=np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        below, depth = levels - upper, depth - upper
        at += tree_size(upper) + (index // ARITY**depth) * tree_size(below)
        index, levels = index % ARITY**depth, below
    return at


def steps_of(count: int) -> int:
    """Levels from ``count`` leaves to one node."""
    steps = 0
    while ARITY**steps < count:
        steps += 1
    return steps


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def build(leaves: list[bytes], steps: int) -> np.ndarray:
    """The stored nodes (rows of 32 bytes) of a block; places without a node are zero."""
    levels = steps + 1
    nodes = np.zeros((tree_size(levels), 32), dtype=np.uint8)
    row = [leaf.hex() for leaf in leaves]
    for depth in range(steps, -1, -1):
        where = address(levels, depth, np.arange(len(row)))
        nodes[where] = np.frombuffer(bytes.fromhex("".join(row)), dtype=np.uint8).reshape(-1, 32)
        if depth:
            row = [digest("".join(row[i : i + ARITY])) for i in range(0, len(row), ARITY)]
    return nodes


def siblings(nodes: np.ndarray, steps: int, count: int) -> list[list[tuple[str, str]]]:
    """Per step, lowest first, for every node there: its siblings to the left and to the right, joined."""
    out = []
    for step in range(steps):
        here = -(-count // ARITY**step)
        stored = nodes[address(steps + 1, steps - step, np.arange(here))].tobytes().hex()
        row = [stored[i : i + 64] for i in range(0, len(stored), 64)]
        pairs = []
        for i in range(here):
            run = i - i % ARITY
            pairs.append(("".join(row[run:i]), "".join(row[i + 1 : run + ARITY])))
        out.append(pairs)
    return out


def _block(high: int):
    """Node table of one block of at most ``high`` steps as one row."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("i")
        count = rows.num_rows
        steps = high if rows.column("n")[0].as_py() > ARITY**high else steps_of(count)
        nodes = build(rows.column("digest").to_pylist(), steps)
        return pa.table(
            {
                "g": pa.array([key[0].as_py()], pa.int64()),
                "block": pa.array([key[1].as_py()], pa.int64()),
                "n": rows.column("n")[:1],
                "count": pa.array([count], pa.int64()),
                "steps": pa.array([steps], pa.int64()),
                "nodes": pa.array([nodes.tobytes()], pa.binary()),
                "root": pa.array([nodes[0].tobytes()], pa.binary()),
                "rows": pa.array([rows.column("row").to_pylist()], pa.list_(rows.schema.field("row").type)),
            }
        )

    return run


def _blocks(nodes: DataFrame, high: int, name: str) -> DataFrame:
    """One row per block of nodes (g, i, n, digest, row); n counts the nodes of g, ``row`` is carried along."""
    kind = nodes.schema["row"].dataType.simpleString()
    schema = f"g long, block long, n long, count long, steps long, nodes binary, root binary, rows array<{kind}>"
    keyed = nodes.withColumn("block", F.expr(f"i div {ARITY**high}"))
    return staged(keyed.groupBy("g", "block").applyInArrow(_block(high), schema), name)


def _forest(nodes: DataFrame, most: int, high: int, name: str) -> list[DataFrame]:
    """Blocks of all rounds; ``most`` is the size of the largest tree."""
    size = ARITY**high
    rounds = [_blocks(nodes, high, name)]
    while most > size:
        most = -(-most // size)
        up = rounds[-1].where(F.col("n") > size)
        n = F.expr(f"(n + {size - 1}) div {size}").alias("n")
        up = up.select("g", F.col("block").alias("i"), n, F.col("root").alias("digest"), F.lit(0).alias("row"))
        rounds.append(_blocks(up, high, f"{name}-{len(rounds)}"))
    return rounds


def _roots(rounds: list[DataFrame], high: int) -> DataFrame:
    """(g, root) of every tree."""
    tops = [r.where(F.col("n") <= ARITY**high).select("g", "root") for r in rounds]
    return reduce(DataFrame.unionByName, tops)


PATH = "g long, i long, lefts array<string>, rights array<string>, subroot string, root string"


def _paths(high: int):
    """Path of every node of a block: its siblings inside the block, then those above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        schema = pa.schema(
            [("g", pa.int64()), ("i", pa.int64()), ("lefts", texts), ("rights", texts), ("subroot", pa.string()), ("root", pa.string())]
        )
        for batch in batches:
            for block in batch.to_pylist():
                nodes = np.frombuffer(block["nodes"], dtype=np.uint8).reshape(-1, 32)
                levels = siblings(nodes, block["steps"], block["count"])
                rows = []
                for j in range(block["count"]):
                    own = [levels[s][j // ARITY**s] for s in range(block["steps"])]
                    place = {"g": block["g"], "i": block["block"] * ARITY**high + j, "subroot": block["subroot"], "root": block["root"]}
                    rows.append({**place, "lefts": [x for x, _ in own] + block["lefts"], "rights": [y for _, y in own] + block["rights"]})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _descend(rounds: list[DataFrame], high: int, tops: DataFrame) -> DataFrame:
    """Lowest blocks with the path above each; ``tops`` has the path above every tree."""
    above = None
    for r in range(len(rounds) - 1, -1, -1):
        single = rounds[r].where(F.col("n") <= ARITY**high).drop("root").join(tops, "g")
        joined = single
        if above is not None:
            inner = rounds[r].where(F.col("n") > ARITY**high).drop("root").join(above.withColumnRenamed("i", "block"), ["g", "block"])
            joined = single.unionByName(inner)
        if r == 0:
            return joined
        above = joined.drop("rows", "n").mapInArrow(_paths(high), PATH)
    raise ValueError("a forest has one round at least")


@dataclass
class Manifest:
    """Stored trees of a dataset: rounds of blocks of the sources, and of the tree of sources."""

    rounds: list[DataFrame]
    top: list[DataFrame]
    sources: DataFrame
    high: int = STEPS

    def blocks(self) -> DataFrame:
        """Blocks that hold the rows, each with the path above it, its subroot and the root."""
        none = F.array().cast("array<string>")
        root = _roots(self.top, self.high).select("g", F.lower(F.hex("root")).alias("root"))
        ends = root.select("g", none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"), "root")
        lowest = _descend(self.top, self.high, ends)
        paths = lowest.drop("rows", "n").mapInArrow(_paths(self.high), PATH)
        named = self.sources.select(F.col("no").alias("i"), F.lower(F.hex("digest")).alias("name"))
        above = paths.join(named, "i").select(F.col("i").alias("g"), "lefts", "rights", F.col("name").alias("subroot"), "root")
        return _descend(self.rounds, self.high, staged(above, "paths"))


def manifest(leaves: DataFrame, high: int = STEPS) -> Manifest:
    """Trees over ``leaves``: source, doc_id, leaf (32 bytes) and ``row`` (carried along).

    Rows of a source are in the order of doc_id (null first), then of their digest;
    repeated rows are leaves of their own. A null source is a source, before all others.
    """
    placed = numbered(leaves, ("source", "doc_id", "leaf"), "at")
    firsts = placed.groupBy("source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = staged(numbered(firsts, ("source",), "no"), "sources")
    size = sources.agg(F.max("n"), F.count(F.lit(1))).first()
    named = sources.select(F.col("source").alias("s"), "no", "first", "n")
    nodes = placed.join(named, F.col("source").eqNullSafe(F.col("s")))
    nodes = nodes.select(F.col("no").alias("g"), (F.col("at") - F.col("first")).alias("i"), "n", F.col("leaf").alias("digest"), "row")
    rounds = _forest(nodes, size[0] or 0, high, "blocks")
    named = sources.select(F.col("no").alias("g"), "no").join(_roots(rounds, high).withColumnRenamed("root", "digest"), "g")
    named = staged(named.select("no", "digest"), "subroots")
    top = named.select(F.lit(0).cast("long").alias("g"), F.col("no").alias("i"), F.lit(size[1]).cast("long").alias("n"), "digest", F.lit(0).alias("row"))
    return Manifest(rounds, _forest(top, size[1], high, "top"), named, high)


def field(name: str) -> Column:
    """A value with its length, or a dash for null."""
    text = F.col(name).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: str = "text") -> Column:
    """Hash of a row, as 32 bytes; ``text`` names the column that stands for the text."""
    parts = [field(text if c == "text" else c) for c in COLUMNS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


VERIFIED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())]
    )
    for batch in batches:
        for block in batch.to_pylist():
            steps, count, root = block["steps"], block["count"], block["root"]
            nodes = np.frombuffer(block["nodes"], dtype=np.uint8).reshape(-1, 32)
            levels = siblings(nodes, steps, count)
            above = list(zip(block["lefts"], block["rights"], strict=True))
            rest = "".join(x + y for x, y in above)
            leaves = nodes[address(steps + 1, steps, np.arange(count))]
            rows = []
            for j, row in enumerate(block["rows"]):
                leaf = leaves[j].tobytes().hex()
                path = [levels[s][j // ARITY**s] for s in range(steps)]
                now = leaf if row["other"] is None else row["other"].hex()
                for x, y in path + above:
                    now = digest(x + now + y)
                proof = digest("".join(x + y for x, y in path) + rest)
                rows.append((row["doc_id"], leaf, block["subroot"] or root, root, proof, now, now == root))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def tampered_proofs(docs: DataFrame, high: int = STEPS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows whose crc32(doc_id as text) is even are tampered with: their text loses its line
    feeds. Rows without a doc_id or text, and texts without line feeds, stay as they are
    and are verified. Empty texts have length 0, unlike null ones. Repeated rows each get
    a leaf and a proof. Columns beyond those of a leaf are ignored; an empty table gives
    no rows. One root covers all rows, so no row is left out.
    """
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    cut = docs.select(*COLUMNS, F.replace(F.col("text"), F.lit("\n"), F.lit("")).alias("_cut"))
    other = F.when(hit, leaf_digest("_cut"))
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), other.alias("other"))
    leaves = cut.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("leaf"), row.alias("row"))
    blocks = manifest(leaves, high).blocks()
    return blocks.select("steps", "count", "nodes", "rows", "lefts", "rights", "subroot", "root").mapInArrow(_verified, VERIFIED)


def _field_sql(name: str, value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c, text if c == "text" else c) for c in COLUMNS) + ")"


SQL = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT *, rank() OVER (ORDER BY source NULLS FIRST) AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM (
    SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
      CASE WHEN {crc_sql("encode(coalesce(doc_id::VARCHAR, ''))")} % 2 = 0 AND doc_id IS NOT NULL AND contains(text, chr(10))
        THEN {_leaf_sql("replace(text, chr(10), '')")} END AS other
    FROM documents, crc_table
  )
),
low AS (
  SELECT s, 0 AS step, i, leaf AS d, n FROM leaves
  UNION ALL
  SELECT s, step + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM low WHERE n > 1 GROUP BY s, step, i // 3, n
),
subroots AS (
  SELECT s, d, row_number() OVER (ORDER BY s) - 1 AS no, count(*) OVER () AS n, max(step) OVER () AS top FROM low WHERE n = 1
),
high AS (
  SELECT 0 AS step, no AS i, d, n FROM subroots
  UNION ALL
  SELECT step + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY step, i // 3, n
),
stairs AS (
  SELECT a.s, a.step, a.i, a.n, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x,
    coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
  FROM low a JOIN low b ON a.s = b.s AND a.step = b.step AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, a.step, a.i, a.n, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), ''),
    coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '')
  FROM high a JOIN high b ON a.step = b.step AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL
),
climb AS (
  SELECT l.doc_id, l.leaf, u.d AS subroot, u.no, l.s, l.i, 0 AS step, l.n, coalesce(l.other, l.leaf) AS now, '' AS proof, FALSE AS above
  FROM leaves l JOIN subroots u ON l.s = u.s
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.no, c.s, CASE WHEN c.n = 1 THEN c.no ELSE c.i // 3 END, CASE WHEN c.n = 1 THEN 0 ELSE c.step + 1 END,
    CASE WHEN c.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (c.n + 2) // 3 END,
    CASE WHEN c.n = 1 THEN c.now ELSE sha256(t.x || c.now || t.y) END, CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || t.x || t.y END, c.above OR c.n = 1
  FROM climb c LEFT JOIN stairs t ON t.s IS NOT DISTINCT FROM CASE WHEN c.above THEN NULL ELSE c.s END AND t.step = c.step AND t.i = c.i
  WHERE c.n > 1 OR NOT c.above
)
SELECT c.doc_id, c.leaf, c.subroot, h.d AS root, sha256(c.proof) AS proof_sha256, c.now AS folded_root, c.now = h.d AS verified
FROM climb c, high h WHERE c.above AND c.n = 1 AND h.n = 1
"""
