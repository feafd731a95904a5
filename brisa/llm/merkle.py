"""Merkle manifest of a table: a hash tree per group, persistent versions by path copying, a proof for every row.

A leaf is the digest of a row's fields. Per group, leaves in ascending order of a key are numbered across the
cluster and cut into aligned blocks of 8 ** 3; whole levels of the tree lie within a block, so one row holds a block and one
call reduces it. Roots of blocks are the nodes of the next stage, numbered by their block, until a group has one
root; the groups' roots form one more tree of the same kind. Stages then run downwards: each block gets
what lies above it (the siblings of its root, level by level) and hands its members theirs.

A tampered leaf makes a version of its block's tree that shares every untouched node and copies the ancestors of the leaf alone;
the version goes on above the block along the path that the upper stages handed down.

Edge cases: a null field is ``-``, so null and empty differ; a null group is a group of its own and the first; rows with a null key are
first in their group and never tampered. Rows of equal keys are ordered by their leaves, and whole duplicates are leaves
side by side. Of columns with other names nothing is read. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.batches import configure_arrow, only
from brisa.llm.ranks import numbered
from brisa.session import scratch, write_out

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 8
# Levels of a block.
HEIGHT = 3
BLOCK = WIDTH**HEIGHT


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of fields: ``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def combine(nodes: Sequence[bytes]) -> bytes:
    """The node above a run of nodes; digests are hashed as hexadecimal text."""
    return hashlib.sha256("".join([n.hex() for n in nodes]).encode()).digest()


def levels_of(count: int) -> int:
    """How often runs are combined until one node remains."""
    height = 0
    while count > 1:
        count, height = -(-count // WIDTH), height + 1
    return height


class Tree:
    """The nodes of a block, level by level from its leaves to its root."""

    def __init__(self, leaves: list[bytes], height: int):
        self.levels = [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([combine(below[i : i + WIDTH]) for i in range(0, len(below), WIDTH)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, place: int) -> list[tuple[bytes, bytes]]:
        """The siblings before and after each node on the way from a leaf to below the root."""
        out = []
        for level in self.levels[:-1]:
            start = place - place % WIDTH
            out.append((b"".join(level[start:place]), b"".join(level[place + 1 : start + WIDTH])))
            place //= WIDTH
        return out


def copied(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root of the version with another leaf: new ancestors along the path, all other nodes shared."""
    for before, after in path:
        leaf = hashlib.sha256(f"{before.hex()}{leaf.hex()}{after.hex()}".encode()).digest()
    return leaf


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row per aligned block: its members' nodes in order, and what is carried along with each."""
    member = F.struct((F.col("i") % BLOCK).alias("place"), "node", *carried)
    gathered = nodes.groupBy("g", "n", F.floor(F.col("i") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    return gathered.select("g", "n", "block", *[F.col(f"members.{c}").alias(c) for c in ("node", *carried)])


def _roots(blocks: DataFrame) -> DataFrame:
    """``(g, n, i, node)``: the root of each block as a node of the next stage, of which the group has ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("n").to_pylist()
            roots = [Tree(nodes, min(HEIGHT, levels_of(n))).root for nodes, n in zip(batch.column("node").to_pylist(), counts)]
            above = pa.array([-(-n // BLOCK) for n in counts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("g"), above, batch.column("block"), pa.array(roots, pa.binary())], ["g", "n", "i", "node"])

    return blocks.select("g", "n", "block", "node").mapInArrow(run, "g string, n long, i long, node binary")


PATH = "array<struct<before: binary, after: binary>>"
_PATH = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))


def _handed_down(blocks: DataFrame) -> DataFrame:
    """``(g, block, path, subroot, root)`` for each member of blocks of an upper stage, whose members are blocks below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.to_pylist():
                tree = Tree(held["node"], min(HEIGHT, levels_of(held["n"])))
                first, above = held["block"] * BLOCK, [(p["before"], p["after"]) for p in held["path"]]
                paths = [[{"before": b, "after": a} for b, a in tree.path(place) + above] for place in range(len(held["node"]))]
                same = [pa.array([held[c]] * len(paths), kind) for c, kind in (("g", pa.string()), ("subroot", pa.binary()), ("root", pa.binary()))]
                places = pa.array(range(first, first + len(paths)), pa.int64())
                yield pa.RecordBatch.from_arrays([same[0], places, pa.array(paths, _PATH), *same[1:]], ["g", "block", "path", "subroot", "root"])

    return blocks.mapInArrow(run, f"g string, block long, path {PATH}, subroot binary, root binary")


def _stages(blocks: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all stages, and ``(g, stage, node)`` with the last root of each group."""
    stages, tops = [blocks], None
    while True:
        roots = write_out(_roots(stages[-1]), "roots")
        done = roots.where("n = 1").select("g", F.lit(len(stages) - 1).alias("stage"), "node")
        tops = done if tops is None else tops.union(done)
        more = roots.where("n > 1")
        if more.isEmpty():
            return stages, tops
        stages.append(write_out(_blocks(more), "blocks"))


def _paths(stages: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``(g, block, path, subroot, root)`` for each block of the lowest stage; ``tops`` has the last three for each group and its stage."""
    handed = None
    for stage in range(len(stages) - 1, -1, -1):
        here = tops.where(F.col("stage") == stage).select("g", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        if handed is not None:
            here = here.unionByName(handed)
        if stage:
            handed = _handed_down(stages[stage].join(here, ["g", "block"]))
    return here


def _proved(blocks: DataFrame, kind: str) -> DataFrame:
    """Each row with its proof, and the root that its tampered or else its own leaf leads to."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The keys of a block stay in Arrow, whatever their type.
            keys = batch.column("key")
            ends = keys.offsets.to_pylist()
            for row, held in enumerate(batch.drop_columns(["key"]).to_pylist()):
                tree = Tree(held["node"], min(HEIGHT, levels_of(held["n"])))
                above = [(p["before"], p["after"]) for p in held["path"]]
                proof_above = "".join([b.hex() + a.hex() for b, a in above])
                proofs, folded = [], []
                for place, (leaf, changed) in enumerate(zip(held["node"], held["changed"])):
                    path = tree.path(place)
                    proofs.append(hashlib.sha256(("".join([b.hex() + a.hex() for b, a in path]) + proof_above).encode()).hexdigest())
                    folded.append(copied(copied(changed or leaf, path), above).hex())
                root, count = held["root"].hex(), len(proofs)
                columns = [[n.hex() for n in held["node"]], [held["subroot"].hex()] * count, [root] * count, proofs, folded]
                arrays = [keys.values.slice(ends[row], count), *[pa.array(c, pa.string()) for c in columns], pa.array([f == root for f in folded], pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    strings = ", ".join(f"{n} string" for n in names[1:-1])
    return blocks.mapInArrow(run, f"doc_id {kind}, {strings}, verified boolean")


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id", tampered: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row; ``doc_id`` is the key.

    ``tampered`` names fields and what stands in them in the versions of rows where ``when`` holds.
    """
    spark = configure_arrow(rows.sparkSession)
    rows = only(rows, *dict.fromkeys([*fields, group, key]))
    other = digest([(tampered or {}).get(f, F.col(f)) for f in fields])
    # A group's name sorts as the group does, and null before all.
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
        F.col(key).alias("key"),
        digest([F.col(f) for f in fields]).alias("node"),
        (F.when(when, other) if when is not None else F.lit(None).cast("binary")).alias("changed"),
    )
    kind = rows.schema[key].dataType.simpleString()
    with scratch(spark):  # leaves and numbers go when the blocks are written
        blocks = write_out(_blocks(numbered(write_out(leaves, "leaves"), ["g"], ["key", "node"]), "key", "changed"), "blocks", kept=True)
    stages, subroots = _stages(blocks)
    subroots = write_out(subroots, "subroots")
    with scratch(spark):
        groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), "node", "stage")
        upper = write_out(_blocks(numbered(groups, ["g"], ["key", "node"]), "key", "stage"), "groups", kept=True)
    upper_stages, top = _stages(upper)
    above = _paths(upper_stages, top.select("g", "stage", F.array().cast(PATH).alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root")))
    tops = write_out(_group_paths(upper.join(above, ["g", "block"])), "tops")
    found = blocks.join(_paths(stages, tops), ["g", "block"]).select("n", "node", "key", "changed", "path", "subroot", "root")
    return _proved(found, kind)


def _group_paths(blocks: DataFrame) -> DataFrame:
    """``(g, stage, path, subroot, root)`` for each group, from the blocks of the tree of groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.to_pylist():
                tree = Tree(held["node"], min(HEIGHT, levels_of(held["n"])))
                above = [(p["before"], p["after"]) for p in held["path"]]
                out = [
                    {"g": g, "stage": stage, "path": [{"before": b, "after": a} for b, a in tree.path(place) + above], "subroot": node, "root": held["root"]}
                    for place, (g, stage, node) in enumerate(zip(held["key"], held["stage"], held["node"]))
                ]
                yield pa.RecordBatch.from_pylist(out, pa.schema([("g", pa.string()), ("stage", pa.int32()), ("path", _PATH), ("subroot", pa.binary()), ("root", pa.binary())]))

    return blocks.mapInArrow(run, f"g string, stage int, path {PATH}, subroot binary, root binary")
