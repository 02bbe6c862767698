"""Operator 12, Merkle dataset manifest: a postorder append log, written by aligned builders.

Every row is a leaf (a digest of its fields), every value of a column (``lang``) a tree over its leaves by
ascending key, and the trees' roots are the leaves of one tree on top.  ``H`` is the lower-case hex sha256 of
its concatenated inputs.  Two consecutive nodes of a level make one of the next; a last node without a
partner is hashed alone.

*Log.*  A tree's nodes stand in the order in which they are complete, which is postorder: a leaf is appended,
then every node whose last leaf it was, lowest level first.  The place of a node follows from the sizes of the
subtrees before it.  Before leaf L stand ``floor(L / 2**h)`` complete nodes of each level h, together
``2 L - popcount(L)``, so a node of level h whose last leaf is L is at ``2 L - popcount(L) + h``; ragged trees
are no exception.

*Builders.*  An aligned run of ``2**LEVELS`` nodes of a level needs nothing from outside to make the next
``LEVELS`` levels above it.  Runs are dealt to tasks by (tree, run) and streamed; a run's root goes into the
next round, which has 1/1024 of the nodes, until every tree has one.  So neither a tree with a third of all
rows nor the top of a tree is one task's work, and no task holds more than a run.

*Proofs.*  From the top round down, every run is joined with the log rows of its levels and with the proof
that leads from its root to the top; the siblings of a node are found in the log by their closed-form places.
A proof is text, one mark a level: ``<`` and the digest of a sibling on the left, ``>`` and one on the right,
``=`` for a node without one.  ``fold`` replays a proof on any leaf.

Nulls: a null field counts as ``-``, null keys and null trees come first.  Rows with equal keys are ordered by
their leaf digests; equal rows have equal leaves, and as many places as there are rows.  Empty and long texts
are hashed as they are.  A single row is its own subroot and root, with an empty proof.  An empty table gives an
empty result.  Columns that aren't fields are left out, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.sizes import small
from tessera.operators.common import dense_number
from tessera.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one builder makes: it holds 2**LEVELS nodes and the tree above them.
LEVELS = 10
#: Up to so many trees (a name and three numbers each) are broadcast.
MAX_TREES = 100_000
#: The tree over all subroots.
TOP = -1

_LOG = "tree long, n long, pos long, level int, idx long, digest string, root boolean"


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field as its length in UTF-8 bytes, ``:`` and its text, or ``-``."""
    text = [c.cast("string") for c in fields.values()]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text)), 256)


def node(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def fold(start: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    while at < len(proof):
        side, sibling = proof[at], proof[at + 1:at + 65]
        start = node(start) if side == "=" else node(sibling, start) if side == "<" else node(start, sibling)
        at += 1 if side == "=" else 65
    return start


def height(n: int) -> int:
    return max(int(n) - 1, 0).bit_length()


def place(level: np.ndarray, idx: np.ndarray, n: int) -> np.ndarray:
    """Places in the log of the nodes ``idx`` of ``level``, in a tree of n leaves."""
    last = np.minimum((idx + 1) << level, n) - 1
    return 2 * last - np.bitwise_count(last).astype(np.int64) + level


def _runs(batches):
    """The rows of each aligned run of batches that are sorted by (tree, run), as ((tree, run), table)."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column("tree").to_numpy(), b.column("run").to_numpy()])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if now is not None and now != tuple(key[:, lo]):
                yield now, pa.Table.from_batches(held).combine_chunks()
                held = []
            now = tuple(key[:, lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield now, pa.Table.from_batches(held).combine_chunks()


def _builder(base: int, span: int):
    """Appends the nodes of each run in the order in which they are complete; its entries themselves only in
    the first round (later ones were logged as roots of the runs below)."""
    def run(batches):
        for (tree, at), rows in _runs(batches):
            n, m = int(rows.column("n")[0].as_py()), len(rows)
            nodes, first = rows.column("digest").to_pylist(), int(at) << span
            levels, ids, digests = [], [], []
            top = min(base + span, height(n))
            for level in range(base, top + 1):
                if level > base:
                    nodes = [node(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
                    first >>= 1
                if level > base or base == 0:
                    levels.append(np.full(len(nodes), level))
                    ids.append(first + np.arange(len(nodes)))
                    digests += nodes
            level, idx = np.concatenate(levels), np.concatenate(ids)
            pos = place(level, idx, n)
            order = np.argsort(pos)
            root = level[order] == height(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(order), tree)), pa.array(np.full(len(order), n)), pa.array(pos[order]), pa.array(level[order].astype(np.int32)),
                 pa.array(idx[order]), pa.array(digests).take(pa.array(order)), pa.array(root)],
                names=["tree", "n", "pos", "level", "idx", "digest", "root"])
    return run


def build(entries: DataFrame, largest: int, span: int = LEVELS) -> list[DataFrame]:
    """The log of every tree, a written table for each round.  ``entries``: ``tree, n, idx, digest``, the
    numbered leaves of trees of n leaves; ``largest``: the largest n."""
    rounds: list[DataFrame] = []
    while not rounds or largest > 1 << span * len(rounds):
        base = span * len(rounds)
        if rounds:
            entries = rounds[-1].where(F.col("level") == base).where(F.col("n") > 1 << base)
        rows = entries.select("tree", "n", "idx", "digest", F.shiftright("idx", span).alias("run"))
        rows = rows.repartition("tree", "run").sortWithinPartitions("tree", "run", "idx")
        rounds.append(materialize(rows.mapInArrow(_builder(base, span), _LOG), f"merkle-log-{len(rounds)}"))
    return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """``tree, n, digest`` of every tree's root."""
    return reduce(DataFrame.unionByName, rounds).where("root").select("tree", "n", "digest")


def _paths(base: int, span: int):
    """Proofs of a run's subjects: the siblings inside the run by their places in the log, then the run's own."""
    def run(batches):
        for (tree, at), rows in _runs(batches):
            kind = rows.column("kind").to_numpy()
            nodes = rows.slice(1, int((kind == 1).sum()))  # one row of kind 0 comes first
            n, up = int(nodes.column("n")[0].as_py()), rows.column("digest")[0].as_py()
            pos, digest = nodes.column("pos").to_numpy(), nodes.column("digest").to_pylist()
            subjects = rows.slice(1 + len(nodes))
            idx = subjects.column("idx").to_numpy()
            parts: list[list[str]] = [[] for _ in range(len(idx))]
            for level in range(base, min(base + span, height(n))):
                here = idx >> (level - base)
                other = here ^ 1
                there = (other << level) < n
                rank = np.searchsorted(pos, np.where(there, place(level, other, n), 0))
                for p, has, r, left in zip(parts, there.tolist(), rank.tolist(), (here & 1).tolist()):
                    p.append(("<" if left else ">") + digest[r] if has else "=")
            proofs = ["".join(p) + up for p in parts]
            for lo in range(0, len(proofs), 1024):
                part = subjects.slice(lo, 1024)
                yield pa.RecordBatch.from_arrays([*(part.column(c).combine_chunks() for c in ("tree", "idx", "key", "digest", "altered")), pa.array(proofs[lo:lo + 1024], pa.string())],
                                                 names=["tree", "idx", "key", "leaf", "altered", "proof"])
    return run


def prove(rounds: list[DataFrame], heads: DataFrame, leaves: DataFrame, span: int = LEVELS) -> DataFrame:
    """``tree, idx, key, leaf, altered, proof`` of every leaf.  ``heads``: ``tree, n, up``, the proof from each
    tree's root onwards; ``leaves``: ``tree, n, idx, key, digest, altered``."""
    none = F.lit(None)
    found = None
    for k in reversed(range(len(rounds))):
        base = span * k
        log = reduce(DataFrame.unionByName, rounds[max(0, k - 1):k + 1]).where(F.col("level").between(base, base + span - 1)).where(F.col("n") > (1 << base if k else 0))
        ends = heads.where((F.col("n") > (1 << base if k else 0)) & (F.col("n") <= 1 << base + span)).select("tree", F.lit(0).cast("long").alias("run"), F.col("up").alias("digest"))
        if found is not None:
            ends = ends.unionByName(found.select("tree", F.col("idx").alias("run"), F.col("proof").alias("digest")))
        cols = {"tree": "long", "run": "long", "kind": "int", "n": "long", "pos": "long", "idx": "long", "key": "string", "digest": "string", "altered": "string"}

        def shaped(df: DataFrame, **given: Column) -> DataFrame:
            return df.select(*(given.get(c, none).cast(t).alias(c) for c, t in cols.items()))

        c = F.col
        top = shaped(ends, tree=c("tree"), run=c("run"), kind=F.lit(0), digest=c("digest"))
        nodes = shaped(log, tree=c("tree"), run=F.expr(f"shiftright(idx, {base + span} - level)"), kind=F.lit(1), n=c("n"), pos=c("pos"), digest=c("digest"))
        if k:
            own = shaped(log.where(c("level") == base), tree=c("tree"), run=F.shiftright("idx", span), kind=F.lit(2), idx=c("idx"), digest=c("digest"))
        else:
            own = shaped(leaves, tree=c("tree"), run=F.shiftright("idx", span), kind=F.lit(2), idx=c("idx"), key=c("key"), digest=c("digest"), altered=c("altered"))
        rows = top.unionByName(nodes).unionByName(own).repartition("tree", "run").sortWithinPartitions("tree", "run", "kind", "pos")
        found = rows.mapInArrow(_paths(base, span), "tree long, idx long, key string, leaf string, altered string, proof string")
        if k:
            found = materialize(found, f"merkle-proofs-{k}")
    return found


@dataclass
class Manifest:
    """``leaves``: ``tree, n, idx, key, digest, altered``; ``trees``: ``tree, name, n, subroot``; ``log``: the rounds of
    the trees' logs, ``top_log`` those of the tree over them."""

    leaves: DataFrame
    trees: DataFrame
    log: list[DataFrame]
    top_log: list[DataFrame]
    span: int = LEVELS

    def root(self) -> str | None:
        """The digest of the whole table (None if it is empty)."""
        row = roots(self.top_log).first()
        return row and row["digest"]

    def proofs(self) -> DataFrame:
        """``tree, idx, key, leaf, altered, proof`` of every row, up to the root."""
        some = F.lit(None).cast("string")
        count = self.trees.agg(F.count(F.lit(1))).scalar()
        ends = self.trees.sparkSession.range(1).select(F.lit(TOP).cast("long").alias("tree"), count.alias("n"), F.lit("").alias("up")).where("n > 0")
        tops = self.trees.select(F.lit(TOP).cast("long").alias("tree"), count.alias("n"), F.col("tree").alias("idx"), some.alias("key"), F.col("subroot").alias("digest"), some.alias("altered"))
        above = materialize(prove(self.top_log, ends, tops, self.span).select(F.col("idx").alias("tree"), F.col("proof").alias("up")), "merkle-top")
        return prove(self.log, self.trees.select("tree", "n").join(above, "tree"), self.leaves, self.span)


def manifest(docs: DataFrame, tree: str = "lang", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, altered: Column | None = None,
             span: int = LEVELS) -> Manifest:
    """The manifest of ``docs``.  ``altered``, an expression over its columns, is kept with each leaf: a digest
    that a later copy of the row claims (null: the same).  ``span``: levels of one builder."""
    own = F.lit(None).cast("string") if altered is None else altered
    rows = materialize(docs.select(F.col(tree).alias("name"), F.col(key).alias("key"), leaf({f: F.col(f) for f in fields}).alias("digest"), own.alias("altered")), "merkle-leaves")
    placed = dense_number(rows.withColumn("tie", F.monotonically_increasing_id()), ["name", "key", "digest", "tie"], (), "at")
    named = materialize(placed.groupBy("name").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n")), "merkle-names")
    named = materialize(dense_number(named, ["name"], (), "tree"), "merkle-trees")
    mine = small(named.select(F.col("name").alias("tree_name"), "start", "n", "tree"), MAX_TREES)
    leaves = materialize(placed.join(mine, F.col("name").eqNullSafe(F.col("tree_name"))).select(
        "tree", "n", (F.col("at") - F.col("start")).alias("idx"), F.col("key").cast("string").alias("key"), "digest", "altered"), "merkle-entries")
    largest, count = named.agg(F.max("n"), F.count(F.lit(1))).first()
    log = build(leaves.select("tree", "n", "idx", "digest"), largest or 0, span)
    trees = materialize(named.join(roots(log).select("tree", F.col("digest").alias("subroot")), "tree").select("tree", "name", "n", "subroot"), "merkle-roots")
    top = trees.select(F.lit(TOP).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("idx"), F.col("subroot").alias("digest"))
    return Manifest(leaves, trees, log, build(top, count, span), span)


def _fold_rows(batches):
    for b in batches:
        ends = [fold(s, p) for s, p in zip(b.column("altered").to_pylist(), b.column("proof").to_pylist())]
        yield b.drop_columns(["altered"]).append_column("folded_root", pa.array(ends, pa.string()))


def verify(found: Manifest) -> DataFrame:
    """``tree, idx, key, leaf, proof, subroot, root, folded_root, verified`` of every row: what its altered digest (else its
    own) and its original siblings lead to, and whether that is the root."""
    proofs = found.proofs().select("tree", "idx", "key", "leaf", F.coalesce("altered", "leaf").alias("altered"), "proof")
    folded = proofs.mapInArrow(_fold_rows, "tree long, idx long, key string, leaf string, proof string, folded_root string")
    root = F.lit(found.root()).cast("string")
    heads = small(found.trees.select("tree", "subroot"), MAX_TREES)
    return folded.join(heads, "tree").withColumn("root", root).withColumn("verified", F.col("folded_root") == root)


def tampered(docs: DataFrame, span: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row: where 7 divides the
    crc32 of the id, the row is checked with a character too many in ``n_chars``."""
    more = {f: F.col(f) for f in FIELDS} | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = verify(manifest(docs, altered=F.when(hit, leaf(more)), span=span))
    return out.select(F.col("key").cast("long").alias("doc_id"), "leaf", "subroot", "root",
                      F.sha2(F.regexp_replace("proof", "[<>=]", ""), 256).alias("proof_sha256"), "folded_root", "verified")
