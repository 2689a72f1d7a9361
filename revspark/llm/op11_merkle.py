"""Merkle manifest of a dataset by checkpoint and recompute.

A document's leaf is the SHA-256 of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value.  Per group (``lang``) the leaves ascend
by doc_id; while several nodes remain, every ``FAN`` consecutive ones (the last
run may be shorter, even one) become the SHA-256 of their digests in hex.  What
remains is the group's subroot; subroots in the order of the groups (null
first) give the root in the same way.

1. Leaves are numbered in their groups by ``ranks.numbered`` (range
   partitions, so no task holds a whole group) and written: narrow rows of two
   digests, group and position.  Texts are read once.
2. Checkpoints.  Nodes are written only every ``STEP`` levels: an aligned
   subtree of ``FAN ** STEP`` stored nodes is gathered in one row, its interior
   levels are computed in memory and only its top is kept.
3. Proofs go top down over the checkpoints.  The path of a stored node is its
   siblings inside its subtree, regenerated from the stored descendants, and
   then the path of the subtree's top, one row per subtree.  The interior nodes
   are discarded with the batch.  Leaves end their paths in the same task:
   siblings are digested (or returned by ``proofs``) and the root is folded
   again from the leaf under test, and nothing of size rows x levels is
   written.
4. The groups' own tree over the subroots is built and descended by the same
   code, with the groups numbered as one group.

A task's row is a subtree of at most ``FAN ** STEP`` digests, whatever the
size of a group; groupings are by (group, subtree), so a hot group is many keys.

Defined results: a null doc_id comes after all others; rows that share a
doc_id are ordered by leaf, and equal rows are leaves of their own.  A null
group is a group.  Empty texts have the field ``0:``.  One row in all makes its
leaf the root, with the digest of nothing as proof.  An empty table gives an
empty result.  Other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.sources.tables import table

from .common import stored
from .ranks import numbered

#: Children of a node, and levels between two stored ones.
FAN, STEP = 8, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Gathered subtrees (up to FAN ** STEP digests each) that a task unpacks at once.
SUBTREES = 256
#: A path from a node up: per level its place in the run and the run's other digests.
PATH = "array<struct<place:int,siblings:array<string>>>"
PATH_ARROW = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))


def leaf_of(*fields) -> F.Column:
    told = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
            for c in fields]
    return F.sha2(F.concat(*told), 256)


def digest(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def climb(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """``nodes`` and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(below[i:i + FAN]) for i in range(0, len(below), FAN)])
    return out


def path_in(levels: list[list[bytes]], i: int) -> list[tuple[int, list[bytes]]]:
    """Places and siblings of node ``i`` in its runs below the top."""
    out = []
    for nodes in levels[:-1]:
        at = i % FAN
        run = nodes[i - at: i - at + FAN]
        out.append((at, run[:at] + run[at + 1:]))
        i //= FAN
    return out


def fold(node: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    for place, siblings in path:
        node = digest([*siblings[:place], node, *siblings[place:]])
    return node


def plain(path: list[tuple[int, list[bytes]]]) -> list[dict]:
    return [{"place": place, "siblings": [x.decode() for x in siblings]} for place, siblings in path]


def unplain(path: list[dict] | None) -> list[tuple[int, list[bytes]]]:
    return [(x["place"], [s.encode() for s in x["siblings"]]) for x in path or []]


def heights(counts) -> F.Column:
    """Levels above so many leaves until one node remains."""
    levels = F.lit(0)
    for k in range(21):  # FAN ** 21 is above any long
        levels = F.when(counts > FAN ** k, F.lit(k + 1)).otherwise(levels)
    return levels


def gathered(nodes: DataFrame, *more: str) -> DataFrame:
    """A row per aligned subtree of a stored level: (tree, rest: levels above
    the nodes in all, top: position of the subtree's top, nodes in order with
    the columns ``more``)."""
    entry = F.struct("position", "hash", *more)
    return nodes.groupBy("tree", "rest", F.expr(f"position div {FAN ** STEP}").alias("top")).agg(
        F.sort_array(F.collect_list(entry)).alias("nodes"))


def over_subtrees(frame: DataFrame, rows_of: Callable[[dict, list], list[tuple]], schema: str, arrow: list) -> DataFrame:
    """Rows made from each gathered subtree; ``rows_of`` gets the row and the
    levels of its interior, which are computed here and dropped with it."""
    names = [n for n, _ in arrow]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SUBTREES):
                out = []
                for row in batch.slice(at, SUBTREES).to_pylist():
                    levels = climb([x["hash"].hex().encode() for x in row["nodes"]], min(STEP, row["rest"]))
                    out += rows_of(row, levels)
                columns = list(zip(*out)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, arrow)], names=names)

    return frame.mapInArrow(run, schema)


def next_level(nodes: DataFrame) -> DataFrame:
    """The tops of all subtrees of a stored level, ``STEP`` levels up."""
    def rows_of(row, levels):
        return [(row["tree"], max(0, row["rest"] - STEP), row["top"], bytes.fromhex(levels[-1][0].decode()))]

    return over_subtrees(gathered(nodes), rows_of, "tree string, rest int, position long, hash binary",
                         [("tree", pa.string()), ("rest", pa.int32()), ("position", pa.int64()), ("hash", pa.binary())])


def checkpoints(leaves: DataFrame) -> list[DataFrame]:
    """The stored levels of all trees whose leaves are (tree, rest, position,
    hash), lowest first.  A tree ends, with ``rest`` 0, in the level that is its
    root."""
    levels = [leaves]
    while not (open_ := levels[-1].filter("rest > 0")).isEmpty():
        levels.append(stored(next_level(open_), f"op11-level{len(levels)}"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash) of the root of every tree."""
    ended = [level.filter("rest = 0").select("tree", "hash") for level in levels]
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def beside_tops(level: DataFrame, above: DataFrame, ends: DataFrame, *more: str) -> DataFrame:
    """The subtrees of a stored level with the ``path`` of their tops: those of
    the stored level ``above`` (tree, position, path), or of the tree's end
    where the node is its root (``ends``: tree, path)."""
    last = level.filter("rest = 0").select(F.col("tree").alias("__tree"))
    roots_here = ends.join(last, F.col("tree").eqNullSafe(F.col("__tree")), "left_semi")
    paths = above.unionByName(roots_here.select("tree", F.lit(0).cast("long").alias("position"), "path"))
    paths = paths.select(F.col("tree").alias("__tree"), "position", "path")
    return gathered(level, *more).join(
        paths, F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("top") == F.col("position"))).drop("__tree", "position")


def paths(levels: list[DataFrame], ends: DataFrame, down_to: int) -> DataFrame:
    """(tree, position, path) of the nodes of stored level ``down_to``, from
    the highest one down."""
    def rows_of(row, inner):
        up = row["path"] or []
        return [(row["tree"], x["position"], plain(path_in(inner, i)) + up) for i, x in enumerate(row["nodes"])]

    above = ends.select("tree", F.lit(0).cast("long").alias("position"), "path").limit(0)
    for level in reversed(levels[down_to:]):
        above = stored(over_subtrees(
            beside_tops(level, above, ends), rows_of, f"tree string, position long, path {PATH}",
            [("tree", pa.string()), ("position", pa.int64()), ("path", PATH_ARROW)]), "op11-paths")
    return above


@dataclass
class Manifest:
    """Stored levels of the groups' trees (the lowest: leaves with doc_id and
    ``claimed``, the leaf under test if it is another), the groups' subroots,
    the root (None without rows) and the paths from the subroots to it."""
    levels: list[DataFrame]
    subroots: DataFrame
    root: str | None
    ends: DataFrame


def manifest(docs: DataFrame, group: str = "lang", fields=FIELDS, claimed: F.Column | None = None) -> Manifest:
    """Build the trees over ``docs``.  ``claimed``: an expression over
    ``docs`` for the hex digest under test; null where it is the leaf itself."""
    told = F.lit(None).cast("string") if claimed is None else claimed
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(group).cast("string").alias("tree"),
                       F.unhex(leaf_of(*map(F.col, fields))).alias("hash"), F.unhex(told).alias("claimed"))
    rows = stored(rows.withColumn("none", F.col("doc_id").isNull()), "op11-rows")  # texts are read once
    ranked = numbered(rows, "tree", ["none", "doc_id", "hash"], name="op11-leaves")
    sizes = stored(ranked.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "op11-groups")
    sizes = sizes.select(F.col("tree").alias("__tree"), heights(F.col("n")).alias("rest"))
    leaves = ranked.join(sizes, F.col("tree").eqNullSafe(F.col("__tree"))).select(
        "tree", "rest", "position", "hash", "doc_id", "claimed")
    levels = checkpoints(leaves)
    subroots = stored(roots(levels), "op11-subroots")
    listed = stored(numbered(subroots.select(F.lit("").alias("all"), F.col("tree").alias("of"), "hash"), "all", ["of"],
                             name="op11-order"), "op11-order")
    n = listed.count()
    high = checkpoints(listed.select(F.col("all").alias("tree"), heights(F.lit(n)).alias("rest"), "position", "hash"))
    found = roots(high).first()  # one tree: one row
    none = listed.sparkSession.createDataFrame([("", [])], f"tree string, path {PATH}")
    ends = paths(high, none, 0).join(listed.select("position", "of"), "position").select(F.col("of").alias("tree"), "path")
    return Manifest(levels, subroots, found["hash"].hex() if found else None, stored(ends, "op11-ends"))


def proofs(made: Manifest) -> DataFrame:
    """(doc_id, leaf, path) of every document."""
    def rows_of(row, inner):
        up = row["path"] or []
        return [(x["doc_id"], x["hash"].hex(), plain(path_in(inner, i)) + up) for i, x in enumerate(row["nodes"])]

    return over_subtrees(
        beside_tops(made.levels[0], paths(made.levels, made.ends, 1), made.ends, "doc_id"), rows_of,
        f"doc_id long, leaf string, path {PATH}", [("doc_id", pa.int64()), ("leaf", pa.string()), ("path", PATH_ARROW)])


def audit(made: Manifest) -> DataFrame:
    """Per document: leaf, subroot, root, the digest of its proof, the root
    folded from the leaf under test, and whether that is the root."""
    root = made.root

    def rows_of(row, inner):
        up = unplain(row["path"])
        subroot = fold(inner[-1][0], up[:max(0, row["rest"] - STEP)]).decode()
        higher, out = b"".join(s for _, siblings in up for s in siblings), []
        for i, x in enumerate(row["nodes"]):
            own = path_in(inner, i)
            proof = hashlib.sha256(b"".join([*[s for _, siblings in own for s in siblings], higher])).hexdigest()
            folded = fold(fold((x["claimed"] or x["hash"]).hex().encode(), own), up).decode()
            out.append((x["doc_id"], x["hash"].hex(), subroot, root, proof, folded, folded == root))
        return out

    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    return over_subtrees(
        beside_tops(made.levels[0], paths(made.levels, made.ends, 1), made.ends, "doc_id", "claimed"), rows_of,
        f"doc_id long, {', '.join(f'{n} string' for n in names)}, verified boolean",
        [("doc_id", pa.int64()), *[(n, pa.string()) for n in names], ("verified", pa.bool_())])


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    changed = leaf_of(*[F.translate("text", UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return audit(manifest(docs, claimed=F.when(tampered, changed)))
