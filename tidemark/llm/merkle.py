"""A Merkle manifest of a dataset as a persistent tree: versions that copy paths and share everything else.

The leaves of each source stand in order of doc_id; every 16 consecutive nodes make the node above, up to the source's subroot, and the
subroots make the root in the same way. Work goes by aligned blocks of 256 nodes, which hold two levels: a block comes together in one
place, and its topmost node goes on to the block above, so a table of n rows is gone through in log256(n) rounds, each 1/256 of the one
before. What a path has beside it above a block is made once for the block and handed down to its leaves.

A changed leaf starts a version of the tree. The version has copies of the ancestors of that leaf alone; any other node of it is the
node of the first tree at the same place. So a version is a list of one digest a level, first inside the leaf's block and then through
the blocks above, and versions stay where their leaf is: no block above ever holds the versions from below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

FANOUT = 16
BLOCK = FANOUT * FANOUT
STEP = "array<struct<left:string,right:string>>"


def _field(column: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(*columns: Column) -> Column:
    """The lower-case hexadecimal SHA-256 of the fields in a row."""
    return F.sha2(F.concat(*map(_field, columns)), 256)


def _hash(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _blocks(nodes: DataFrame, carry: list[str], label: str) -> DataFrame:
    """Aligned blocks of nodes (tree, position, total, digest and ``carry``): their ``members`` in order, and the digests of the two
    levels they make, ``lower`` of at most 256 and ``upper`` of at most 16. Written once."""
    members = F.sort_array(F.collect_list(F.struct("position", "digest", *carry)))
    block = F.floor(F.col("position") / BLOCK).cast("long").alias("block")
    grouped = nodes.groupBy("tree", "total", block).agg(members.alias("members"))
    lower = grouped.withColumn("lower", F.transform("members", lambda m: m["digest"]))
    runs = F.sequence(F.lit(1), F.size("lower"), F.lit(FANOUT))
    return common.pin(lower.withColumn("upper", F.transform(runs, lambda at: _hash(F.slice("lower", at, FANOUT)))), label)


def _tops(blocks: DataFrame) -> DataFrame:
    """The blocks' own nodes as the next round's nodes. A tree that has come down to one node stays as it is."""
    top = F.when(F.col("total") == 1, F.col("lower")[0]).when(F.col("total") <= FANOUT, F.col("upper")[0]).otherwise(_hash(F.col("upper")))
    return blocks.select("tree", F.col("block").alias("position"), F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), top.alias("digest"))


def _beside(level: Column, at: Column) -> Column:
    """The siblings of the node at place ``at`` (from 0) of a level: all digests of its run left and right of it, each in one string."""
    inside = at % FANOUT
    first = at - inside
    return F.struct(F.array_join(F.slice(level, first + 1, inside), "").alias("left"),
                    F.array_join(F.slice(level, at + 2, FANOUT - 1 - inside), "").alias("right"))


def _hand_down(blocks: DataFrame, paths: DataFrame | None, carry: list[str]) -> DataFrame:
    """Each member of the blocks with ``proof``, its siblings level by level: inside the block, then the block's own from ``paths``."""
    if paths is None:
        above = blocks.withColumn("above", F.array().cast(STEP))
    else:
        up = paths.select(F.col("tree").alias("up_tree"), F.col("position").alias("up_position"), F.col("proof").alias("above"))
        above = blocks.join(up, blocks["tree"].eqNullSafe(up["up_tree"]) & (blocks["block"] == up["up_position"]))

    def steps(member: Column, at: Column) -> Column:
        one, two = F.array(_beside(F.col("lower"), at)), F.array(_beside(F.col("upper"), F.floor(at / FANOUT).cast("int")))
        inside = F.when(F.col("total") == 1, F.array().cast(STEP)).when(F.col("total") <= FANOUT, one).otherwise(F.concat(one, two))
        fields = [member[c].alias(c) for c in ("position", "digest", *carry)]
        return F.struct(*fields, inside.alias("inside"))

    each = above.select("tree", "above", F.explode(F.transform("members", steps)).alias("m"))
    return each.select("tree", *(F.col(f"m.{c}").alias(c) for c in ("position", "digest", *carry)), F.concat("m.inside", "above").alias("proof"))


def _build(nodes: DataFrame, carry: list[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks from ``nodes`` up, and one node for each tree."""
    most = nodes.agg(F.max("total")).first()[0] or 1
    rounds = [_blocks(nodes, carry, label)]
    while (most := -(-most // BLOCK)) > 1:
        rounds.append(_blocks(_tops(rounds[-1]), [], label))
    return rounds, _tops(rounds[-1])


def _proofs(rounds: list[DataFrame], top: DataFrame | None, carry: list[str]) -> DataFrame:
    """The members of the lowest round with their proofs; ``top`` has what is beside and above each tree's root."""
    paths = top
    for blocks in reversed(rounds[1:]):
        paths = common.pin(_hand_down(blocks, paths, []), "merkle-paths")
    return _hand_down(rounds[0], paths, carry)


def fold(start: Column, proof: Column) -> Column:
    """The digests from ``start`` up to the root, ``start`` first, with the siblings of ``proof``."""
    return F.aggregate(proof, F.array(start), lambda done, step: F.concat(
        done, F.array(F.sha2(F.concat(step["left"], F.element_at(done, -1), step["right"]), 256))))


def manifest(docs: DataFrame, changed: Column | None = None, tampered: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, position, source_position, height, leaf, subroot, root, proof, version, tampered``.

    ``position`` counts the source's documents from 0, ``source_position`` the sources, ``height`` the levels up to the subroot; ``proof`` lists the siblings level by level up to the root, the digests on the
    left and on the right of the path each in one string. ``version`` is the path from the leaf to the root, leaf and root included:
    with ``tampered`` true, that of the version that the text ``changed`` starts, else recomputed from the leaf itself.

    Nulls of any column have their own mark in the leaf; null sources make a tree of their own, which comes first; null doc_ids come
    first in their source; equal doc_ids are ordered by leaf, and rows equal in all five columns stand for each other. An empty table
    gives no rows. Only the five columns are read (and what ``changed`` and ``tampered`` name), so others may have any name.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    start = F.when(tampered, leaf(*fields, F.col("text") if changed is None else changed))
    leaves = docs.select("doc_id", F.col("source").alias("tree"), leaf(*fields, F.col("text")).alias("digest"), start.alias("start"))
    carry = ["doc_id", "start"]
    rounds, subroots = _build(common.numbered(leaves, ["tree"], ["doc_id", "digest", "start"], "position", "total", "merkle-leaves"), carry, "merkle")

    # The subroots are the leaves of one more tree.
    subroots = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "digest")
    upper, root = _build(common.numbered(subroots, ["tree"], ["source"], "position", "total", "merkle-subroots"), ["source"], "merkle-upper")
    named = root.select(F.col("tree").alias("only"), F.col("digest").alias("root"))
    tops = _proofs(upper, None, ["source"]).join(named, F.col("tree") == F.col("only"))
    tops = common.pin(tops.select("source", F.col("position").alias("source_position"), F.col("digest").alias("subroot"), "root", "proof"), "merkle-tops")

    above = tops.select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("position"), "proof")
    members = _proofs(rounds, above, carry)
    named = tops.select(F.col("source").alias("of"), "source_position", "subroot", "root", F.size("proof").alias("above"))
    every = members.join(named, F.col("tree").eqNullSafe(F.col("of")))
    return every.select("doc_id", F.col("tree").alias("source"), "position", "source_position", (F.size("proof") - F.col("above")).alias("height"),
                        F.col("digest").alias("leaf"), "subroot", "root", "proof",
                        fold(F.coalesce("start", "digest"), F.col("proof")).alias("version"), F.col("start").isNotNull().alias("tampered"))


def copies(tree: DataFrame) -> DataFrame:
    """The nodes that versions hold themselves: ``source, version`` (position of the tampered leaf), ``upper, level, position, digest``.

    Any other node of a version is the first tree's node at the same place. Levels count from the leaf, 0, up to the subroot;
    ``upper`` marks nodes of the tree over the subroots, whose levels count from the subroot.
    """
    each = tree.where("tampered").select("source", F.col("position").alias("version"), "source_position", "height",
                                         F.posexplode("version").alias("step", "digest"))
    upper = F.col("step") > F.col("height")
    level = F.when(upper, F.col("step") - F.col("height")).otherwise(F.col("step"))
    start = F.when(upper, F.col("source_position")).otherwise(F.col("version"))
    each = each.withColumns({"upper": upper, "level": level, "start": start})
    return each.select("source", "version", "upper", "level", F.expr("shiftright(start, 4 * level)").alias("position"), "digest")


def tampering() -> tuple[Column, Column]:
    """The text with A-Z in lower case, and whether 5 divides the CRC-32 of the decimal doc_id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate("text", upper, upper.lower()), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def digest(docs: DataFrame) -> DataFrame:
    """Per document the tree's digests, a hash of its proof, and the root folded from its tampered or own leaf; as :func:`manifest`."""
    tree = manifest(docs, *tampering())
    beside = F.array_join(F.transform("proof", lambda step: F.concat(step["left"], step["right"])), "")
    folded = F.element_at("version", -1)
    return tree.select("doc_id", "leaf", "subroot", "root", F.sha2(beside, 256).alias("proof_sha256"),
                       folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
