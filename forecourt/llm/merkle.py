"""Operator 11: a Merkle manifest of a table, its trees stored in van Emde Boas layout.

Each row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8 length, ``:`` and itself.
The leaves of a tree (one per language) are in order of id; every two consecutive nodes of a level
make a node of the next, a last one alone too, until one is left, the subroot.  Subroots in order of the
languages (null first) make the root in the same way.  A node is the SHA-256 of the hexadecimal digests below it.

*Layout.*  A tree is cut into aligned blocks of ``2**height`` leaves.  A block is stored as one array in which
the upper half of its levels comes first, then each subtree of the lower half, both halves cut in the same way
again (``address``).  Any path from leaf to root so lies in few stretches whatever the size of a memory line.
Addresses are arithmetic: building a block and reading the sibling at any depth store no links.  Block roots are the leaves
of the next level of blocks, until a tree has one block.

*At scale.*  Places in a tree come from one range sort and the row counts of its partitions; a language with most of
the rows is many blocks.  A task holds one block (4,096 digests) and the path above it.  The driver sees whether a level has more than one.

Cases: null ids come first in their tree, rows of one id in order of their leaves, repeated rows in any order (they are
equal); a null field is told from an empty one; a tree of one row has its leaf as subroot; an empty table has no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm.common import Staged, staged

#: Levels of a block below its root.
HEIGHT = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a depth (root: 0) stand in a stored tree of so many levels."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = depth - top
    subtree, within = index >> below, index & ((1 << below) - 1)
    return (1 << top) - 1 + subtree * ((1 << levels - top) - 1) + address(levels - top, below, within)


def _height(block: int, leaves: int, most: int) -> int:
    """Levels above the leaves of a block: ``most``, unless it is all of its tree."""
    return most if block else (leaves - 1).bit_length()


def _widths(leaves: int, height: int) -> list[int]:
    """Nodes at each depth of a block, root first."""
    return [-(-leaves // (1 << height - d)) for d in range(height + 1)]


def built(digests: list[bytes], height: int) -> np.ndarray:
    """The block over these leaves: an array of digests by address, zeros where there is no node."""
    nodes = np.zeros(((2 << height) - 1, 32), np.uint8)
    level = digests
    for depth in range(height, -1, -1):
        nodes[address(height + 1, depth, np.arange(len(level)))] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, 32)
        texts = [x.hex() for x in level]
        level = [hashlib.sha256("".join(texts[i:i + 2]).encode()).digest() for i in range(0, len(texts), 2)]
    return nodes


def siblings(nodes: np.ndarray, height: int, leaves: int) -> list[list[tuple[str, str]]]:
    """For each leaf of a block the sides and digests of its siblings, from below; ("", "") where there is none."""
    widths, at, paths = _widths(leaves, height), np.arange(leaves), [[] for _ in range(leaves)]
    for depth in range(height, 0, -1):
        other = (at >> height - depth) ^ 1
        known = other < widths[depth]
        found = nodes[address(height + 1, depth, np.where(known, other, 0))]
        for path, has, o, digest in zip(paths, known.tolist(), other.tolist(), found, strict=True):
            path.append((("left", "right")[o & 1], digest.tobytes().hex()) if has else ("", ""))
    return paths


def placed(rows: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """``out``: place 0, 1, ... of each row in its group by ``order`` (nulls first).

    One range sort by group and order; the sorted rows are written with their partition and number, and a
    partition's rows of a group come after those counted in the partitions before it.
    """
    cut = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    cut = staged(cut.withColumns({"__part": F.spark_partition_id(), "__seq": F.monotonically_increasing_id()}), "sorted")
    counts = cut.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__seq").alias("first"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *(F.col(g).alias(f"__g_{g}") for g in group), F.col("__part").alias("__p"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__shift"),
    )
    match = F.col("__part") == F.col("__p")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return cut.join(starts, match).withColumn(out, F.col("__seq") + F.col("__shift")).drop("__part", "__seq", "__p", "__shift", *(f"__g_{g}" for g in group))


def leaf(values: list[Column]) -> Column:
    """Hexadecimal digest of fields."""
    text = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]
    return F.sha2(F.concat(*text).cast("binary"), 256)


def _blocks(rows: DataFrame, height: int) -> DataFrame:
    """``(tree, block, height, leaves, nodes, root)`` of the nodes ``rows(tree, pos, digest)`` of one level.

    The key is a pair, so that the blocks of a tree are dealt to all tasks.
    """

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        at = table.column("at")[0].as_py()
        h = _height(at["block"], table.num_rows, height)
        nodes = built(table.column("digest").to_pylist(), h)
        return pa.table([
            pa.array([at["tree"]], pa.int64()), pa.array([at["block"]], pa.int64()), pa.array([h], pa.int32()),
            pa.array([table.num_rows], pa.int32()), pa.array([nodes.tobytes()], pa.binary()), pa.array([nodes[0].tobytes()], pa.binary()),
        ], ["tree", "block", "height", "leaves", "nodes", "root"])

    at = F.struct("tree", F.shiftright("pos", height).alias("block")).alias("at")
    return rows.select(at, "pos", "digest").groupBy("at").applyInArrow(build, "tree bigint, block bigint, height int, leaves int, nodes binary, root binary")


def _levels(rows: DataFrame, height: int) -> list[DataFrame]:
    """The stored blocks of each level, leaves first, until every tree has one block."""
    levels = [staged(_blocks(rows, height), "blocks")]
    while not levels[-1].filter("block > 0").isEmpty():
        levels.append(staged(_blocks(levels[-1].select("tree", F.col("block").alias("pos"), F.col("root").alias("digest")), height), "blocks"))
    return levels


_PATH = "array<struct<side:string,digest:string>>"
_PATH_TYPE = pa.list_(pa.struct([("side", pa.string()), ("digest", pa.string())]))


def _steps(path: list[tuple[str, str]]) -> list[dict]:
    return [{"side": s, "digest": d} for s, d in path]


def _under(blocks: DataFrame, up: DataFrame) -> DataFrame:
    """Blocks with what is known of their root: ``up(tree, pos, subroot, root, path)`` of the nodes above."""
    known = up.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_pos"), "subroot", "path", F.col("root").alias("end"))
    return blocks.drop("root").join(known, (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_pos"))).drop("up_tree", "up_pos")


def _paths(blocks: DataFrame, height: int) -> DataFrame:
    """``(tree, pos, subroot, root, path)`` for each leaf of blocks that know their way up: the whole way."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                paths = siblings(nodes, row["height"], row["leaves"])
                first, n = row["block"] << height, len(paths)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["tree"]] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()),
                    pa.array([row["subroot"]] * n, pa.string()), pa.array([row["end"]] * n, pa.string()),
                    pa.array([_steps(p) + (row["path"] or []) for p in paths], _PATH_TYPE),
                ], ["tree", "pos", "subroot", "root", "path"])

    return blocks.mapInArrow(of, f"tree bigint, pos bigint, subroot string, root string, path {_PATH}")


def _hex(digest: str) -> Column:
    return F.lower(F.hex(digest))


@dataclass(frozen=True)
class Manifest:
    """Stored tables: ``leaves(id, lang, leaf, other, tree, pos)``, ``trees(lang, tree)``, the blocks of the languages' trees
    and those over their subroots."""

    leaves: DataFrame
    trees: DataFrame
    levels: list[DataFrame]
    tops: list[DataFrame]
    height: int

    def root(self) -> str | None:
        found = self.tops[-1].select(F.lower(F.hex("root"))).first()
        return found and found[0]

    def proofs(self) -> DataFrame:
        """``(id, lang, leaf, other, subroot, root, path)`` of every row; ``path`` leads from its leaf to the root."""
        height = self.height
        # Over the subroots, then down the languages' trees to the blocks of leaves.
        known = self.tops[-1].withColumns({"subroot": F.lit(None).cast("string"), "path": F.lit(None).cast(_PATH), "end": _hex("root")}).drop("root")
        for level in reversed(self.tops[:-1]):
            known = _under(level, _paths(known, height))
        top = _paths(known, height).select(F.col("pos").alias("t_tree"), F.col("path"), F.col("root").alias("end"))
        ends = self.levels[-1].withColumn("subroot", _hex("root")).drop("root")
        blocks = ends.join(top, F.col("tree") == F.col("t_tree")).drop("t_tree")
        for level in reversed(self.levels[:-1]):
            blocks = _under(level, _paths(blocks, height))
        blocks = blocks.withColumnsRenamed({"tree": "b_tree", "block": "b_block"})
        members = self.leaves.groupBy("tree", F.shiftright("pos", height).alias("block")).agg(F.collect_list(F.struct("pos", "id", "lang", "other")).alias("rows"))
        whole = members.join(blocks, (F.col("tree") == F.col("b_tree")) & (F.col("block") == F.col("b_block")))
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(self.leaves.schema[c].dataType) for c in ("id", "lang")]

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                    h, n = row["height"], row["leaves"]
                    paths = siblings(nodes, h, n)
                    own = nodes[address(h + 1, h, np.arange(n))]
                    up = row["path"] or []
                    rows, first = row["rows"], row["block"] << height
                    at = [r["pos"] - first for r in rows]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r["id"] for r in rows], kinds[0]), pa.array([r["lang"] for r in rows], kinds[1]),
                        pa.array([own[k].tobytes().hex() for k in at], pa.string()), pa.array([r["other"] for r in rows], pa.string()),
                        pa.array([row["subroot"]] * len(rows), pa.string()), pa.array([row["end"]] * len(rows), pa.string()),
                        pa.array([_steps(paths[k]) + up for k in at], _PATH_TYPE),
                    ], ["id", "lang", "leaf", "other", "subroot", "root", "path"])

        id_kind, lang_kind = (self.leaves.schema[c].dataType.simpleString() for c in ("id", "lang"))
        return whole.mapInArrow(of, f"id {id_kind}, lang {lang_kind}, leaf string, other string, subroot string, root string, path {_PATH}")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", tree_col: str = "lang", other: Column | None = None, height: int = HEIGHT) -> Manifest:
    """Leaves, trees and blocks of a table.  ``other``: a second digest to carry along with each row, for checks."""
    digests = docs.select(
        F.col(id_col).alias("id"), F.col(tree_col).alias("lang"), F.unhex(leaf([F.col(f) for f in fields])).alias("leaf"),
        (F.lit(None) if other is None else other).cast("string").alias("other"), F.monotonically_increasing_id().alias("row"),
    )
    raw = Staged(digests, "leaves")
    trees = staged(placed(raw.df.select("lang").distinct(), [], ["lang"], "tree").select("lang", "tree"), "trees")
    of = trees.select(F.col("lang").alias("t_lang"), "tree")
    numbered = raw.df.join(of, F.col("lang").eqNullSafe(F.col("t_lang"))).drop("t_lang")
    leaves = staged(placed(numbered, ["tree"], ["id", "leaf", "row"], "pos").drop("row"), "leaves")
    raw.drop()
    levels = _levels(leaves.select("tree", "pos", F.col("leaf").alias("digest")), height)
    tops = _levels(levels[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("root").alias("digest")), height)
    return Manifest(leaves, trees, levels, tops, height)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    def step(node: Column, x: Column) -> Column:
        joined = F.when(x["side"] == "left", F.concat(x["digest"], node)).when(x["side"] == "right", F.concat(node, x["digest"])).otherwise(node)
        return F.sha2(joined.cast("binary"), 256)

    return F.aggregate(path, start, step)


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: x["digest"]), "").cast("binary"), 256)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(f) if f != "n_chars" else (F.col(f).cast("decimal(20,0)") + 1) for f in FIELDS]
    proofs = manifest(docs, other=F.when(hit & F.col("n_chars").isNotNull(), leaf(changed))).proofs()
    checked = proofs.withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("path")))
    return checked.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, CASE WHEN n_chars IS NOT NULL AND crc % 7 = 0 THEN sha256(a || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || b) END AS other,
         sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || b) AS leaf
  FROM (
    SELECT doc_id, lang, n_chars::HUGEINT AS n_chars,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
           coalesce(strlen(text) || ':' || text, '-') AS b,
           xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
             lambda s, c: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(s, c)), 4294967295), 4294967295) AS crc
    FROM documents)
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), up(tree, level, i, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM up WHERE n > 1 GROUP BY tree, i // 2
), subroots AS (
  SELECT tree, h, count(*) OVER () AS n FROM up WHERE n = 1
), top(level, i, h, n) AS (
  SELECT 0, tree, h, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY i // 2
), lower_steps AS (
  SELECT o.tree, o.level, o.i, coalesce(CASE WHEN s.i < o.i THEN 'L' ELSE 'R' END || s.h, '') AS step
  FROM up o LEFT JOIN up s ON s.tree = o.tree AND s.level = o.level AND s.i = xor(o.i, 1) WHERE o.n > 1
), upper_steps AS (
  SELECT o.level, o.i, coalesce(CASE WHEN s.i < o.i THEN 'L' ELSE 'R' END || s.h, '') AS step
  FROM top o LEFT JOIN top s ON s.level = o.level AND s.i = xor(o.i, 1) WHERE o.n > 1
), upper_paths AS (
  SELECT tree, list(step ORDER BY level) AS path FROM subroots JOIN upper_steps ON i = tree >> level GROUP BY tree
), lower_paths AS (
  SELECT l.tree, l.pos, list(step ORDER BY level) AS path FROM leaves l JOIN lower_steps s ON s.tree = l.tree AND s.i = l.pos >> s.level GROUP BY l.tree, l.pos
), whole AS (
  SELECT l.doc_id, l.leaf, l.other, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
         coalesce(p.path, []) || coalesce(u.path, []) AS path
  FROM leaves l JOIN subroots s USING (tree) LEFT JOIN lower_paths p USING (tree, pos) LEFT JOIN upper_paths u USING (tree)
), folds AS (
  SELECT *, list_reduce(path, lambda h, x: sha256(CASE x[1] WHEN 'L' THEN x[2:] || h WHEN 'R' THEN h || x[2:] ELSE h END), coalesce(other, leaf)) AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folds
"""
