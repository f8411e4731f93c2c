"""Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf; the leaves of a group (in the order of their keys) make a
tree of arity 16, and the groups' roots make the tree above them. A partition
of leaves works out which nodes its leaves lack together (the minimal union of
their proofs' coordinates), fetches those once, derives the interior nodes
that its leaves share, and expands the proof of each leaf locally.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.llm.common import LOWER, UPPER, ascii_lower, stored
from hitlens.llm.crc_sql import CRC_TABLE, crc_sql
from hitlens.llm.positions import with_positions

ARITY = 16
#: Levels that one task builds at a time; a block has ARITY ** LEVELS nodes at most.
LEVELS = 3
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the groups' roots. Group trees are named "-" (null) or ":" and the group, which sort like the groups.
TOP = ""
#: Level of the row that tells a block its place among the groups' roots, their number and the root.
NOTHING = -1


def combined(parts: Sequence[bytes]) -> bytes:
    """The node above ``parts``: digests are hashed as their hex text."""
    return sha256(b"".join(parts)).hexdigest().encode()


def widths(n: int) -> list[int]:
    """Nodes of every level of a tree over ``n`` leaves, down to the one that remains."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def missing(wanted: Sequence[int], n: int) -> list[tuple[int, int]]:
    """Coordinates (level, index) that the proofs of ``wanted`` need and can't derive from each other."""
    out, known = [], set(wanted)
    for level, width in enumerate(widths(n)[:-1]):
        runs = {i // ARITY for i in known}
        out += [(level, i) for r in sorted(runs) for i in range(r * ARITY, min((r + 1) * ARITY, width)) if i not in known]
        known = runs
    return out


def derived(leaves: dict[int, bytes], fetched: dict[tuple[int, int], bytes], n: int) -> dict[tuple[int, int], bytes]:
    """All nodes that the proofs of ``leaves`` touch: theirs, the fetched ones and what follows from both."""
    nodes = dict(fetched)
    nodes.update(((0, i), h) for i, h in leaves.items())
    known = set(leaves)
    sizes = widths(n)
    for level, width in enumerate(sizes[:-1]):
        known = {i // ARITY for i in known}
        for r in known:
            nodes[level + 1, r] = combined([nodes[level, i] for i in range(r * ARITY, min((r + 1) * ARITY, width))])
    return nodes


def paths(nodes: dict[tuple[int, int], bytes], n: int, above: tuple = ()) -> Callable[[int], tuple]:
    """Leaf index -> its proof: per level the siblings before and after its node, then those of ``above``."""
    sizes = widths(n)
    known: dict[tuple[int, int], tuple] = {}

    def path(i: int, level: int = 0) -> tuple:
        if level == len(sizes) - 1:
            return above
        if (level, i) not in known:
            start = i // ARITY * ARITY
            end = min(start + ARITY, sizes[level])
            step = (tuple(nodes[level, j] for j in range(start, i)), tuple(nodes[level, j] for j in range(i + 1, end)))
            known[level, i] = (step, *path(i // ARITY, level + 1))
        return known[level, i]

    return path


def folded(leaf: bytes, proof: tuple) -> bytes:
    """The root that ``leaf`` has under ``proof``."""
    for before, after in proof:
        leaf = combined([*before, leaf, *after])
    return leaf


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of a row: each field ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.unhex(F.sha2(F.concat(*map(part, fields)), 256))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, pos, n, key, leaf, claim; ``nodes``: tree, level, idx, width, digest, of all levels
    above the leaves and all levels of the top tree; ``trees``: tree, subroot, top_pos, top_n, root."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


_NODE = "tree string, level int, idx long, width long, digest binary"


def _levels_above(key: tuple, block: pa.Table) -> pa.Table:
    """Up to ``LEVELS`` levels over one block of a level's nodes."""
    rows = sorted(zip(block["idx"].to_pylist(), block["digest"].to_pylist(), strict=True))
    level, width = block["level"][0].as_py(), block["width"][0].as_py()
    now = [(i, h.hex().encode()) for i, h in rows]
    out = []
    for _ in range(LEVELS):
        if width == 1:
            break
        level, width = level + 1, -(-width // ARITY)
        runs: dict[int, list[bytes]] = {}
        for i, h in now:
            runs.setdefault(i // ARITY, []).append(h)
        now = [(r, combined(parts)) for r, parts in runs.items()]
        out += [(level, r, width, bytes.fromhex(h.decode())) for r, h in now]
    levels, idx, all_widths, digests = map(list, zip(*out, strict=True))
    return pa.table({"tree": pa.array([key[0].as_py()] * len(out), pa.string()), "level": pa.array(levels, pa.int32()),
                     "idx": pa.array(idx, pa.int64()), "width": pa.array(all_widths, pa.int64()), "digest": pa.array(digests, pa.binary())})


def _grown(base: DataFrame) -> list[DataFrame]:
    """The levels above ``base`` (one level of any number of trees), ``LEVELS`` of them per round."""
    out, level = [], 0
    while not (todo := base.where(f"level = {level} AND width > 1")).isEmpty():
        blocks = todo.groupBy("tree", F.expr(f"idx DIV {BLOCK}").alias("block"))
        base = stored(blocks.applyInArrow(_levels_above, _NODE), "merkle-nodes")
        out.append(base)
        level += LEVELS
    return out


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id", claim: Column | None = None) -> Manifest:
    """The trees over the hashes of ``fields`` of every row of ``docs``.

    Leaves ascend by key, equal keys by their hashes; a null key comes first,
    null groups are a group. Repeated rows are leaves each. A group of one row
    has it as its root, one group's root is the root of all; an empty table
    has no root. Texts of any length are hashed whole. Other columns, whatever
    their names, don't matter. ``claim`` is a hash to be checked in place of
    the row's own (null: its own).
    """
    tree = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), F.col(group).cast("string")))
    leaf, claimed = leaf_hash([F.col(f) for f in fields]), F.lit(None).cast("binary") if claim is None else claim
    named = stored(docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf.alias("leaf"), claimed.alias("claim")), "merkle-leaves")
    leaves = stored(with_positions(named, "tree", ["key", "leaf"], "merkle-ranged"), "merkle-placed")
    ground = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("n").alias("width"), F.col("leaf").alias("digest"))
    grown = _grown(ground)
    tops = _union([ground, *grown]).where("width = 1").select(F.lit(TOP).alias("of"), "tree", "digest")
    placed = stored(with_positions(stored(tops, "merkle-roots"), "of", ["tree"], "merkle-roots-ranged"), "merkle-subroots")
    summit = placed.select(F.col("of").alias("tree"), F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("n").alias("width"), "digest")
    peaks = _grown(summit)
    root = _union([summit, *peaks]).where("width = 1").select(F.col("tree").alias("of"), F.col("digest").alias("root"))
    trees = placed.select("of", "tree", F.col("digest").alias("subroot"), F.col("pos").alias("top_pos"), F.col("n").alias("top_n")).join(root, "of")
    return Manifest(leaves, _union([*grown, summit, *peaks]), trees.drop("of"))


def _lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of wanted leaves (tree, block, pos list, n, top place, root): the coordinates it lacks, and one row that lacks nothing."""
    for batch in batches:
        rows = []
        for tree, block, wanted, n, top_pos, top_n, root in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            rows.append((tree, block, TOP, NOTHING, top_pos, top_n, root))
            rows += [(tree, block, of, *at, None, None) for of, lacked in ((tree, missing(wanted, n)), (TOP, missing([top_pos], top_n))) for at in lacked]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = ["tree", "block", "of", "level", "idx", "top_n", "root"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def proofs(made: Manifest, wanted: DataFrame, keep_proof: bool = False) -> DataFrame:
    """Proofs of ``wanted``, any rows of ``made.leaves``, checked with their claims.

    Per row: key, leaf, subroot, root, proof_sha256 (of all siblings, from the
    leaf's level up, left to right), folded_root (of the claimed hash under
    the proof), verified and, if asked for, proof (the siblings). Hashes are
    lowercase hex. Blocks hold at most ``BLOCK`` leaves of one group.
    """
    block = F.expr(f"pos DIV {BLOCK}").alias("block")
    placed = wanted.select("tree", block, "pos", "n", "key", "leaf", F.coalesce("claim", "leaf").alias("claim"))
    # Blocks, not leaves, meet their group's root: a group may hold most of the leaves.
    asked = placed.groupBy("tree", "block").agg(F.collect_list("pos").alias("wanted"), F.first("n").alias("n"))
    asked = asked.join(made.trees, "tree").select("tree", "block", "wanted", "n", "top_pos", "top_n", "root")
    lacked = stored(asked.mapInArrow(_lacking, "tree string, block long, of string, level int, idx long, top_n long, root binary"), "merkle-coordinates")
    # Leaves' own siblings are read only where a partial choice of leaves lacks some.
    nodes = made.nodes.select(F.col("tree").alias("of"), "level", "idx", "digest")
    if not lacked.where(f"of <> '{TOP}' AND level = 0").isEmpty():
        nodes = nodes.union(made.leaves.select("tree", F.lit(0), "pos", "leaf"))
    fetched = lacked.join(nodes, ["of", "level", "idx"], "left").select("tree", "block", "of", "level", "idx", "top_n", "root", "digest")

    def expand(group: tuple, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        n, top_pos, top_n, root = ours["n"][0].as_py(), 0, 0, ""
        known: dict[str, dict[tuple[int, int], bytes]] = {"tree": {}, TOP: {}}
        for of, level, idx, many, summit, digest in zip(*[theirs[c].to_pylist() for c in ("of", "level", "idx", "top_n", "root", "digest")], strict=True):
            if level == NOTHING:
                top_pos, top_n, root = idx, many, summit.hex()
            else:
                known[TOP if of == TOP else "tree"][level, idx] = digest.hex().encode()
        leaves = {p: h.hex().encode() for p, h in zip(ours["pos"].to_pylist(), ours["leaf"].to_pylist(), strict=True)}
        nodes = derived(leaves, known["tree"], n)
        subroot = nodes[len(widths(n)) - 1, 0]
        top = derived({top_pos: subroot}, known[TOP], top_n)
        path = paths(nodes, n, paths(top, top_n)(top_pos))
        out = []
        for p, claimed in zip(ours["pos"].to_pylist(), ours["claim"].to_pylist(), strict=True):
            proof = path(p)
            siblings = [h for before, after in proof for h in (*before, *after)]
            found = folded(claimed.hex().encode(), proof).decode()
            out.append((leaves[p].decode(), subroot.decode(), root, sha256(b"".join(siblings)).hexdigest(), found, found == root,
                        [h.decode() for h in siblings] if keep_proof else None))
        names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]
        types = [pa.string()] * 5 + [pa.bool_(), pa.list_(pa.string())]
        columns = {name: pa.array(c, t) for name, c, t in zip(names, zip(*out, strict=True), types, strict=True)}
        return pa.table({"key": ours["key"], **columns})

    kind = made.leaves.schema["key"].dataType.simpleString()
    shape = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof array<string>"
    found = placed.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(expand, shape)
    return found if keep_proof else found.drop("proof")


def manifest_digest(docs: DataFrame) -> DataFrame:
    """Every document's proof, checked against a text whose capitals are lowered where 5 divides the key's CRC.

    Nulls, empty and very long texts are hashed as they are; a null key is never tampered with.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    made = manifest(docs, claim=F.when(tampered, leaf_hash(lowered)))
    return proofs(made, made.leaves).withColumnRenamed("key", "doc_id")


_SQL_HASH = "array_to_string([CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END FOR x IN {}], '')"
MERKLE_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '-' ELSE ':' || source END AS tree,
    [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS v,
    [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, translate(text, '{UPPER}', '{LOWER}')] AS low,
    coalesce({crc_sql("doc_id::VARCHAR")} % 5 = 0, false) AS tampered
  FROM documents, crc
),
h AS (
  SELECT rid, doc_id, tree, sha256({_SQL_HASH.format("v")}) AS leaf, CASE WHEN tampered THEN sha256({_SQL_HASH.format("low")}) END AS claim FROM d
),
g AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM h
),
nodes AS (
  SELECT tree, 0 AS level, pos AS idx, n AS width, leaf AS digest FROM g
  UNION ALL
  SELECT tree, level + 1, idx // {ARITY}, (width + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE width > 1 GROUP BY tree, level, width, idx // {ARITY}
),
tops AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE width = 1),
above AS (
  SELECT 0 AS level, pos AS idx, n AS width, digest FROM tops
  UNION ALL
  SELECT level + 1, idx // {ARITY}, (width + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM above WHERE width > 1 GROUP BY level, width, idx // {ARITY}
),
up AS (
  SELECT rid, tree, 0 AS level, pos AS idx, n AS width, coalesce(claim, leaf) AS cur, '' AS proof FROM g
  UNION ALL
  SELECT rid, up.tree, up.level + 1, up.idx // {ARITY}, (up.width + {ARITY - 1}) // {ARITY},
    sha256(string_agg(CASE WHEN o.idx = up.idx THEN cur ELSE o.digest END, '' ORDER BY o.idx)),
    proof || coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx <> up.idx), '')
  FROM up JOIN nodes o ON o.tree = up.tree AND o.level = up.level AND o.idx // {ARITY} = up.idx // {ARITY}
  WHERE up.width > 1 GROUP BY rid, up.tree, up.level, up.idx, up.width, cur, proof
),
over AS (
  SELECT rid, 0 AS level, tops.pos AS idx, tops.n AS width, cur, proof FROM up JOIN tops USING (tree) WHERE up.width = 1
  UNION ALL
  SELECT rid, over.level + 1, over.idx // {ARITY}, (over.width + {ARITY - 1}) // {ARITY},
    sha256(string_agg(CASE WHEN o.idx = over.idx THEN cur ELSE o.digest END, '' ORDER BY o.idx)),
    proof || coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx <> over.idx), '')
  FROM over JOIN above o ON o.level = over.level AND o.idx // {ARITY} = over.idx // {ARITY}
  WHERE over.width > 1 GROUP BY rid, over.level, over.idx, over.width, cur, proof
)
SELECT doc_id, leaf, tops.digest AS subroot, above.digest AS root, sha256(over.proof) AS proof_sha256, cur AS folded_root, cur = above.digest AS verified
FROM g JOIN tops USING (tree) JOIN over USING (rid) JOIN above ON above.width = 1
WHERE over.width = 1
"""
