"""N-gram Jaccard self-join by PartEnum signatures.

A text is the set of its word n-grams. Sets are banded by size; an instance of the scheme serves a band and the one below it. Of two
sets that link, at most k elements differ, k following from their sizes and the similarity. An instance partitions the n-gram
domain into somewhat more than k parts and enumerates its one-part subsets: what a set has in a part, if anything, is a signature.
A set with p signatures agrees with every linked partner on p - k of them, so it may leave p - k - 1 out: its allowance.
Sets that share a signature are candidates.

Equal sets are one class. No group is expanded into all pairs:

1. Stars: every class asks a few leaders of its groups; pairs that parity sketches do not refute join under one label. Large groups
   of near copies come down to a label or few.
2. Only pairs with different labels are left. A group of more than ``HOT`` labels is a common passage; each class leaves the largest of
   its passages, as many as its allowance covers, as it meets each partner elsewhere. Classes still in a passage are compared there
   in blocks, whose sketches, longer than the sets, refute nearly all pairs inside the task. Groups of few labels give label pairs. What is not refuted
   joins labels again.

Sketches never refute a link, so a label now holds whole components. Inside labels all pairs are verified on whole sets, block against
block; a task gives counts and a spanning forest of the links it found, which joins the true components.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import common, fingerprints

#: Leaders that a class asks in a round of stars, rounds, and labels from which a group counts as a common passage.
LEADERS, ROUNDS, HOT = 3, 3, 8
#: The joins' small sides stay in the executors: each one that becomes a broadcast when its shuffle is done is held by the driver until its garbage is collected.
IN_PLACE = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}

#: Bits of the sketches that blocks are compared by first. Sets of as many elements or more have longer ones, which decide.
SHORT = 512


class Scheme:
    """Bands, instances and parts for one similarity, given in percent."""

    def __init__(self, percent: int, size: int, spare: float):
        self.percent, self.size, self.spare = percent, size, spare
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(lows[-1] * 100 // percent + 1)
        self.lows = lows

    def band(self, n: int) -> int:
        from bisect import bisect_right

        return bisect_right(self.lows, n) - 1

    def most(self, a: int, b: int) -> int:
        """Elements that differ at most between linked sets of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def parts(self, instance: int) -> int:
        largest = self.lows[instance + 1] - 1
        k = self.most(largest, largest)
        return k + 1 + max(3, math.ceil(self.spare * k))

    def ngrams(self, data: bytes) -> np.ndarray:
        """The text's set, as sorted 64-bit fingerprints; with fewer words than ``size`` the whole sequence is one."""
        prints = fingerprints.words(data.lower())[2]
        if not len(prints):
            return prints
        size = min(self.size, len(prints))
        return np.unique(fingerprints.windows(fingerprints.prefix(prints), np.arange(len(prints) - size + 1), size))

    def _instances(self, grams: np.ndarray):
        """For both instances: its number, the part of each element, and each element's code there."""
        for instance in (self.band(len(grams)), self.band(len(grams)) + 1):
            code = fingerprints.mix(grams + np.uint64(instance * 0x9E3779B1 + 1))
            yield instance, (code >> np.uint64(32)) % np.uint64(self.parts(instance)), code

    def signatures(self, grams: np.ndarray) -> np.ndarray:
        """The signatures of both instances: a fingerprint for each part that the set has elements in."""
        out = []
        for instance, part, code in self._instances(grams):
            order = np.argsort(part.astype(np.uint16) if self.parts(instance) < 1 << 16 else part, kind="stable")
            part = part[order]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            inside = np.add.reduceat(code[order] * np.uint64(0x9E3779B97F4A7C15), first)
            out.append(fingerprints.mix(inside + fingerprints.mix(part[first] * np.uint64(4096) + np.uint64(instance))))
        return np.concatenate(out)

    def allowance(self, grams: np.ndarray) -> int:
        """Signatures that the set may leave out of an instance, the smaller of the two numbers; below 0 a partner may be missed."""
        n, spare = len(grams), []
        for instance, part, _ in self._instances(grams):
            largest_partner = min(self.lows[instance + 1] - 1, n * 100 // self.percent)
            spare.append(np.count_nonzero(np.bincount(part.astype(np.int64))) - self.most(n, largest_partner) - 1)
        return min(spare)

    def sketch(self, grams: np.ndarray, bits: int = 0) -> bytes:
        """Parities of the set over ``bits`` bits, a power of two, by default above the set's size; sketches of different length are folded to the shorter one."""
        bits = bits or 1 << max(6, int(len(grams)).bit_length())
        at = (fingerprints.mix(grams ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(bits)).astype(np.int64)
        return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool)).tobytes()

    def refuted_by_size(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(a, b) < self.percent * np.maximum(a, b)

    def linked(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)

    def refuted(self, n_a: int, sketch_a: bytes, n_b: int, sketch_b: bytes) -> bool:
        """Whether sizes or parities alone rule a link out; each bit that differs is an element that differs."""
        if 100 * min(n_a, n_b) < self.percent * max(n_a, n_b):
            return True
        a, b = np.frombuffer(sketch_a, np.uint8), np.frombuffer(sketch_b, np.uint8)
        while len(a) > len(b):
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        while len(b) > len(a):
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
        return int(np.bitwise_count(a ^ b).sum()) > self.most(n_a, n_b)


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of ``size`` bytes or more, each folded to ``size`` bytes, as rows of 64-bit numbers."""
    out, lengths = np.empty((len(sketches), size // 8), np.uint64), np.array([len(s) for s in sketches], np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        rows = np.frombuffer(b"".join(sketches[i] for i in at.tolist()), "<u8").reshape(len(at), length // size, size // 8)
        out[at] = np.bitwise_xor.reduce(rows, axis=1)
    return out


def unrefuted(scheme: Scheme, n: np.ndarray, sketches: list[bytes], short: np.ndarray, a: np.ndarray, b: np.ndarray, room: int = 16 << 20) -> np.ndarray:
    """Which pairs of items (a[i], b[i]) neither sizes nor sketches refute; a sketch has ``SHORT`` bits, or the power of two above n.

    ``short`` are the sketches folded to ``SHORT`` bits, by which all pairs are tried first; the sketches of the rest are
    compared at the length of the shorter one, about ``room`` bytes at a time.
    """
    limit = (n[a] + n[b]) * (100 - scheme.percent) // (100 + scheme.percent)
    kept = ~scheme.refuted_by_size(n[a], n[b])
    some = np.flatnonzero(kept)
    step = max(1, room // (SHORT // 8))
    for at in range(0, len(some), step):
        part = some[at:at + step]
        kept[part] = np.bitwise_count(short[a[part]] ^ short[b[part]]).sum(1, dtype=np.int64) <= limit[part]
    size = np.array([len(s) for s in sketches], np.int64)
    least = np.minimum(size[a], size[b])
    for length in np.unique(least[kept]).tolist():
        if length > SHORT // 8:
            some, step = np.flatnonzero(kept & (least == length)), max(1, room // length)
            for at in range(0, len(some), step):
                part = some[at:at + step]
                items, where = np.unique(np.concatenate([a[part], b[part]]), return_inverse=True)
                rows = folded([sketches[i] for i in items.tolist()], length)
                differ = np.bitwise_count(rows[where[:len(part)]] ^ rows[where[len(part):]]).sum(1, dtype=np.int64)
                kept[part] = differ <= limit[part]
    return kept


def class_of(grams: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.sha256(grams.tobytes()).digest()[:8], "big") >> 1 if len(grams) else None


def with_sets(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """row_id, doc_id, n, cls (a hash of the set; null without words), allowance and the two sketches, per row of ``docs``.

    ``sketch`` goes with single pairs; ``meeting``, of ``SHORT`` bits or more, is what blocks are compared by.
    """
    def run(batches):
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            sets = [scheme.ngrams(data.as_py()) for data in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array([len(g) for g in sets], pa.int64()),
                 pa.array([class_of(g) for g in sets], pa.int64()), pa.array([scheme.allowance(g) if len(g) else 0 for g in sets], pa.int64()),
                 pa.array([scheme.sketch(g) if len(g) else None for g in sets], pa.binary()),
                 pa.array([scheme.sketch(g, max(SHORT, 1 << len(g).bit_length())) if len(g) else None for g in sets], pa.binary())],
                names=["row_id", "doc_id", "n", "cls", "allowance", "sketch", "meeting"])

    rows = docs.select("row_id", F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes().alias("bytes"))
    return rows.mapInArrow(common.lean(run), "row_id string, doc_id long, n long, cls long, allowance long, sketch binary, meeting binary")


#: What is sent of a class: its hash and its size.
NAME = np.dtype([("cls", "<i8"), ("n", "<u4")])


def shortened(signatures: np.ndarray) -> bytes:
    """The upper 40 bits of each. Inside a bucket that tells signatures apart; two that are mistaken for one are one group too large."""
    return signatures[:, None].view(np.uint8)[:, 3:].tobytes()


def lengthened(data: bytes, bucket: int) -> np.ndarray:
    """Numbers for shortened signatures that differ between buckets."""
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, 3:] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel() + np.uint64(bucket % (1 << 24))


def groups(docs: DataFrame, scheme: Scheme, buckets: int, most: int = 4096) -> DataFrame:
    """(gid, members, times): classes that share a signature; ``times`` signatures gave the same group, and ``gid`` follows from its members.

    Tasks send signatures packed by fingerprint range, each class once; a group of more than ``most`` members comes in rows of that many.
    """
    def send(batches):
        done = set()
        for batch in (piece for whole in batches for piece in common.slices(whole, 1024)):
            signatures, owners, sizes = [], [], []
            for data in batch.column("bytes"):
                grams = scheme.ngrams(data.as_py())
                if not len(grams):
                    continue
                cls = class_of(grams)
                if cls not in done:
                    done.add(cls)
                    signatures.append(scheme.signatures(grams))
                    owners.append(np.full(len(signatures[-1]), len(sizes), np.int64))
                    sizes.append((cls, len(grams)))
            if not signatures:
                continue
            signature, number, names = np.concatenate(signatures), np.concatenate(owners), np.array(sizes, NAME)
            bucket = (signature % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            signature, number, bucket = signature[by], number[by], bucket[by]
            edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            for a, b in zip(edge[:-1], edge[1:]):
                own = np.unique(number[a:b])
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([int(bucket[a])], pa.int64()), "signatures": [shortened(signature[a:b])],
                    "numbers": [np.searchsorted(own, number[a:b]).astype("<u2").tobytes()], "names": [names[own].tobytes()]})

    def gather(table: pa.Table) -> pa.Table:
        signature = lengthened(b"".join(table.column("signatures").to_pylist()), table.column("bucket")[0].as_py())
        named = np.concatenate([np.frombuffer(names.as_py(), NAME)[np.frombuffer(numbers.as_py(), "<u2")]
                                for names, numbers in zip(table.column("names"), table.column("numbers"))])
        by = np.argsort(signature)
        same = signature[by][1:] == signature[by][:-1]
        by = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        signature, owner, n = signature[by], named["cls"][by], named["n"][by].astype(np.int64)
        by = np.lexsort((owner, n, signature))
        signature, owner, n = signature[by], owner[by], n[by]
        same = signature[1:] == signature[:-1]
        new = np.concatenate([np.ones(min(1, len(signature)), bool), ~same | (owner[1:] != owner[:-1])])
        signature, owner, n = signature[new], owner[new], n[new]
        # In order of size, a set that is too far from both neighbours links with none of its group.
        near = (signature[1:] == signature[:-1]) & (100 * n[:-1] >= scheme.percent * n[1:])
        kept = (np.concatenate([[False], near]) | np.concatenate([near, [False]]))[:len(signature)]
        signature, owner = signature[kept], owner[kept]
        first = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]])) if len(signature) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([first, [len(signature)]]).astype(np.int64))
        several = size > 1
        found = Counter(owner[at:at + count].tobytes() for at, count in zip(first[several].tolist(), size[several].tolist()))
        rows = [(int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "big") >> 1, np.frombuffer(own[i:i + 8 * most], "<i8"), times)
                for own, times in found.items() for i in range(0, len(own), 8 * most)]
        return pa.table({"gid": pa.array([r[0] for r in rows], pa.int64()), "members": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                         "times": pa.array([r[2] for r in rows], pa.int64())})

    rows = docs.select(common.text_bytes().alias("bytes"))
    sent = rows.mapInArrow(common.lean(send), "bucket long, signatures binary, numbers binary, names binary")
    def once(table: pa.Table) -> pa.Table:
        found = gather(table)
        common.release()  # a bucket is the most that a worker holds
        return found

    found = sent.groupBy("bucket").applyInArrow(once, "gid long, members array<long>, times long")
    return found.groupBy("gid", "members").agg(F.sum("times").alias("times"))


def star_pairs(labelled: DataFrame, mask: int) -> DataFrame:
    """(a, b): every class with up to ``LEADERS`` leaders of other labels. A group's leaders are its first and last class under ``mask``.

    ``labelled`` are (gid, cls, label). Classes are hashes, so an exclusive or gives each round an order of its own.
    """
    turned = labelled.select("gid", "cls", "label", F.col("cls").bitwiseXOR(F.lit(mask)).alias("turned"))
    heads = turned.groupBy("gid").agg(F.min("turned").alias("one"), F.max("turned").alias("two"))
    proposals = turned.join(heads, "gid")
    chosen = proposals.groupBy("cls", "label").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array("one", "two"))))), 1, 2 * LEADERS).alias("heads"))
    pairs = chosen.select("cls", F.explode("heads").alias("head")).select("cls", F.col("head").bitwiseXOR(F.lit(mask)).alias("other")).where("cls != other")
    return pairs.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those (a, b) whose labels differ."""
    left, right = labels.select(F.col("cls").alias("a"), F.col("label").alias("u")), labels.select(F.col("cls").alias("b"), F.col("label").alias("v"))
    return pairs.join(left, "a").join(right, "b").where("u != v").select("a", "b")


def across(labelled: DataFrame) -> DataFrame:
    """Those rows of ``labelled`` (gid, cls, label, times) whose group has several labels."""
    several = labelled.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("gid")
    return common.pin(labelled.join(several, "gid"), "labelled")


def plausible(pairs: DataFrame, sketches: DataFrame, scheme: Scheme) -> DataFrame:
    """Those (a, b) that sizes and sketches do not refute."""
    def run(batches):
        for batch in batches:
            keep = [not scheme.refuted(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("n_a", "sketch_a", "n_b", "sketch_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
    return common.pin(pairs.select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b").mapInArrow(common.lean(run), "a long, b long"), "plausible")


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (cls, label) after joining the labels of linked classes: the smallest label of a connected set.

    Labels hook to their smallest neighbour and then follow pointers until nothing changes; only labels with links take part.
    """
    a, b = labels.select(F.col("cls").alias("a"), F.col("label").alias("u")), labels.select(F.col("cls").alias("b"), F.col("label").alias("v"))
    met = links.join(a, "a").join(b, "b").where("u != v")
    both = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    edges = common.pin(met.select(both.alias("e")).select("e.*").distinct(), "edges")
    if edges.isEmpty():
        return labels
    nodes = common.pin(edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("root")), "roots")
    while True:
        root_u, root_v = nodes.select("u", F.col("root").alias("ru")), nodes.select(F.col("u").alias("v"), F.col("root").alias("rv"))
        # The smallest root among neighbours, one row a node however many there are, handed to one's own root and to oneself; then one jump along the pointers.
        near = edges.join(root_v, "v").groupBy("u").agg(F.min("rv").alias("rv")).join(root_u, "u")
        offers = near.select(F.explode(F.array("u", "ru")).alias("u"), F.col("rv").alias("root"), F.lit(None).cast("long").alias("was"))
        offers = offers.unionByName(nodes.select("u", "root", F.col("root").alias("was")))
        hooked = common.pin(offers.groupBy("u").agg(F.min("root").alias("root"), F.max("was").alias("was")), "roots")
        jump = hooked.select(F.col("u").alias("root"), F.col("root").alias("next"))
        after = common.pin(hooked.join(jump, "root", "left").select("u", F.coalesce("next", "root").alias("root"), "was"), "roots")
        unchanged = after.where("root != was").isEmpty()
        nodes = after.select("u", "root")
        common.settle(labels.sparkSession)
        if unchanged:
            break
    moved = labels.join(nodes.select(F.col("u").alias("label"), "root"), "label", "left")
    return common.pin(moved.select("cls", F.coalesce("root", "label").alias("label")), "labels")


def n_blocks(count: int, size: int):
    """Into how many blocks members go, so that one has about ``count`` of them and ``size`` bytes of sketches."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / count, F.sum(F.octet_length("meeting")) / size))


def label_pairs(marked: DataFrame, labels: DataFrame, told: DataFrame, scheme: Scheme, block: int = 64, block_bytes: int = 16 << 10) -> DataFrame:
    """(a, b) across labels that meet in a group of at most ``HOT`` labels, as far as sizes and sketches do not refute them.

    ``marked`` are (gid, label), distinct, with n_labels; ``told`` (cls, n, meeting). Labels meet as blocks of about ``block`` classes, fewer
    where sketches are long, so a large label is some rows and not as many pairs.
    """
    few = marked.where((F.col("n_labels") > 1) & (F.col("n_labels") <= HOT))
    met = few.select("gid", F.col("label").alias("u")).join(few.select("gid", F.col("label").alias("v")), "gid").where("u < v").select("u", "v").distinct()
    known = labels.join(told, "cls")
    sizes = known.groupBy("label").agg(n_blocks(block, block_bytes).alias("blocks"))
    own = known.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    packed = common.pin(own.groupBy("label", "own").agg(F.collect_list(F.struct("cls", "n", "meeting")).alias("pack")).drop("own"), "packed")
    rows = (met.join(packed.select(F.col("label").alias("u"), F.col("pack").alias("left")), "u")
            .join(packed.select(F.col("label").alias("v"), F.col("pack").alias("right")), "v").select("left", "right"))

    def flat(column):
        """Classes, sizes and sketches of all packs, and where each pack begins."""
        items, starts = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).astype(np.int64)
        return items.field("cls").to_numpy(), items.field("n").to_numpy(), items.field("meeting").to_pylist(), starts

    def run(batches):
        for batch in (piece for whole in batches for piece in common.slices(whole, 512)):
            (cls_a, n_a, sketch_a, first_a), (cls_b, n_b, sketch_b, first_b) = flat(batch.column("left")), flat(batch.column("right"))
            cls, n, sketches, first_b = np.concatenate([cls_a, cls_b]), np.concatenate([n_a, n_b]), sketch_a + sketch_b, first_b + len(cls_a)
            short = folded(sketches, SHORT // 8)
            for at in range(0, batch.num_rows, 64):
                rows = np.arange(at, min(at + 64, batch.num_rows))
                wide = first_b[rows + 1] - first_b[rows]
                many = (first_a[rows + 1] - first_a[rows]) * wide
                row = np.repeat(np.arange(len(rows)), many)
                inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                a, b = first_a[rows][row] + inside // wide[row], first_b[rows][row] + inside % wide[row]
                kept = unrefuted(scheme, n, sketches, short, a, b)
                yield pa.RecordBatch.from_pydict({"a": pa.array(cls[a[kept]], pa.int64()), "b": pa.array(cls[b[kept]], pa.int64())})

    return rows.mapInArrow(common.lean(run), "a long, b long")


def cells(members: DataFrame, key: str, number) -> DataFrame:
    """``members`` with i, j and ``side``: a key's members in ``number`` (an aggregate) blocks, met in cells i <= j; a member enters each cell of its block."""
    blocks = members.groupBy(key).agg(number.alias("blocks"))
    own = members.join(blocks, key).withColumn("own", F.pmod(F.xxhash64("cls", F.lit(key)), F.col("blocks")))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return spread.select(*members.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("side"))


def block_pairs(members: DataFrame, scheme: Scheme, block: int = 4096, block_bytes: int = 4 << 20) -> DataFrame:
    """(a, b) of different labels in one group that sizes and sketches do not refute. ``members``: gid, cls, label, n, meeting.

    A block has about ``block`` members, fewer where sketches are long.
    """
    def run(table: pa.Table) -> pa.Table:
        cls, label, n = (np.array(table.column(c).to_pylist(), np.int64) for c in ("cls", "label", "n"))
        side = np.array(table.column("side").to_pylist(), bool)
        sketches = table.column("meeting").to_pylist()
        short = folded(sketches, SHORT // 8)
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        left, right = (np.arange(len(cls)),) * 2 if same else (np.flatnonzero(~side), np.flatnonzero(side))
        a, b, waiting, number = [], [], [], 0

        def flush():
            if waiting:
                x, y = (np.concatenate(side) for side in zip(*waiting))
                kept = unrefuted(scheme, n, sketches, short, x, y)
                a.append(np.minimum(cls[x[kept]], cls[y[kept]]))
                b.append(np.maximum(cls[x[kept]], cls[y[kept]]))
                waiting.clear()

        for x in left.tolist():
            some = right[(label[right] != label[x]) & ~scheme.refuted_by_size(n[right], n[x])]
            if same:
                some = some[some > x]
            waiting.append((np.full(len(some), x), some))
            number += len(some)
            if number >= 1 << 17:
                flush()
                number = 0
        flush()
        return pa.table({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)})

    return cells(members, "gid", n_blocks(block, block_bytes)).groupBy("gid", "i", "j").applyInArrow(run, "a long, b long").distinct()


def verify(members: DataFrame, scheme: Scheme, block: int = 128) -> DataFrame:
    """(cls, others, to): per block and class the rows it links with there, and an edge of the block's spanning forest, or null.

    ``members``: label, cls, copies, grams, of labels with several classes. Every pair of a label is decided on whole sets in one cell.
    """
    def run(table: pa.Table) -> pa.Table:
        cls, copies = (np.array(table.column(c).to_pylist(), np.int64) for c in ("cls", "copies"))
        side = np.array(table.column("side").to_pylist(), bool)
        sets = [np.frombuffer(g.as_py(), "<u8") for g in table.column("grams")]
        size = np.array([len(g) for g in sets], np.int64)
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(number, kind="stable")
        number, owner = number[order], owner[order]
        shared, width = np.zeros((len(sets), len(sets)), np.float32), 8192
        for at in range(0, int(number[-1]) + 1, width):
            low, high = np.searchsorted(number, [at, at + width])
            has = np.zeros((len(sets), width), np.float32)
            has[owner[low:high], number[low:high] - at] = 1
            shared += has @ has.T
        shared = shared.astype(np.int64)
        linked = 100 * shared >= scheme.percent * (size[:, None] + size[None, :] - shared)
        linked &= ~np.eye(len(sets), dtype=bool) if same else side[:, None] != side[None, :]
        # Breadth first: each class points to the one it was reached from.
        came, seen = np.full(len(sets), -1, np.int64), np.zeros(len(sets), bool)
        for start in range(len(sets)):
            if not seen[start]:
                seen[start], front = True, [start]
                while front:
                    here = front.pop()
                    new = np.flatnonzero(linked[here] & ~seen)
                    seen[new], came[new] = True, here
                    front.extend(new.tolist())
        to = pa.array(np.where(came >= 0, cls[came], 0), pa.int64(), mask=came < 0)
        return pa.table({"cls": pa.array(cls), "others": pa.array(linked @ copies), "to": to})

    return cells(members, "label", F.ceil(F.count(F.lit(1)) / block)).groupBy("label", "i", "j").applyInArrow(run, "cls long, others long, to long")


def join(docs: DataFrame, size: int = 5, percent: int = 75, spare: float = 0.15) -> DataFrame:
    """row_id, doc_id, n_shingles, component_id, n_links, class_id and component, one row per row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space after lower-casing A-Z; a set holds the distinct runs of ``size`` words, with fewer words the
    whole sequence, without words nothing, and then it links with nothing. Two rows link when their sets' Jaccard similarity is at
    least ``percent`` hundredths; no link is lost. ``component_id`` is the smallest doc_id reachable by links, the row's own included
    (null only if no id reachable is known); ``n_links`` counts the other rows linked, copies included; rows of one ``class_id``
    have equal sets, rows of one ``component`` are reachable from each other, whatever their ids; both are null without words. Rows that repeat an id are rows of their own; null text is empty; an empty table gives an empty result;
    other columns are not read.
    """
    with common.settings(docs.sparkSession, IN_PLACE), common.scratch(docs.sparkSession) as kept:
        joined = _join(docs, Scheme(percent, size, spare))
        kept.append(joined)
    return joined


def _join(docs: DataFrame, scheme: Scheme) -> DataFrame:
    spark = docs.sparkSession
    docs = common.with_row_id(docs.select("doc_id", "text"), "row_id")
    rows = common.pin(with_sets(docs, scheme), "rows")
    classes = common.pin(rows.where("cls is not null").groupBy("cls").agg(
        F.min("row_id").alias("row_id"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("allowance").alias("allowance"), F.first("sketch").alias("sketch"), F.first("meeting").alias("meeting")), "classes")

    found = groups(docs, scheme, common.partitions(spark))
    memberships = common.pin(found.select("gid", F.explode("members").alias("cls"), "times"), "memberships")
    common.settle(spark)

    labels = classes.select("cls", F.col("cls").alias("label"))
    labelled = memberships.withColumn("label", F.col("cls"))
    for turn in range(ROUNDS):
        asked = star_pairs(labelled, (turn * 0x5DEECE66D1234567) & (2 ** 63 - 1))
        with common.scratch(spark) as kept:
            links = plausible(apart(asked, labels) if turn else asked, classes, scheme)
            if links.isEmpty():
                break
            labels = connect(labels, links)
            labelled = across(labelled.drop("label").join(labels, "cls"))
            kept += [labels, labelled]
        common.settle(spark)

    marked = labelled.select("gid", "label").distinct()
    marked = common.pin(marked.join(marked.groupBy("gid").agg(F.count(F.lit(1)).alias("n_labels")), "gid"), "marked")
    passages = marked.where(F.col("n_labels") > HOT).select("gid", "n_labels").distinct()
    told = classes.select("cls", "n", "meeting")
    # Every class leaves its largest passages, as many as its allowance. All go by one order, so what two linked classes leave of the
    # groups they share is the beginning of one list, shorter than the list.
    left = F.sum("times").over(Window.partitionBy("cls").orderBy(F.desc("n_labels"), "gid").rowsBetween(Window.unboundedPreceding, 0))
    crowded = labelled.join(passages, "gid").join(classes.select("cls", "allowance"), "cls").withColumn("left", left)
    compared = common.pin(crowded.where(F.col("left") > F.col("allowance")).select("gid", "cls", "label"), "crowded").join(told, "cls")
    # Classes whose allowance is below 0 may miss only each other; linked ones share an n-gram.
    uncovered = classes.where("allowance < 0").select("cls", "row_id")
    texts = docs.select("row_id", common.text_bytes().alias("bytes"))
    bare = whole_sets(texts, common.pin(uncovered, "uncovered"), scheme).select(F.explode("numbers").alias("gid"), "cls").join(labels, "cls").select("gid", "cls", "label").join(told, "cls")
    columns = ["gid", "cls", "label", "n", "meeting"]
    rest = label_pairs(marked, labels, told, scheme).unionByName(
        block_pairs(compared.select(columns).unionByName(bare.select(columns)), scheme)).distinct()
    labels = connect(labels, common.pin(rest, "rest"))
    common.settle(spark)

    several = labels.groupBy("label").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("label")
    members = common.pin(labels.join(several, "label").join(classes.select("cls", "row_id", "copies"), "cls"), "members")
    sets = whole_sets(texts, members.select("cls", "row_id"), scheme).drop("numbers")
    verified = common.pin(verify(members.join(common.pin(sets, "sets"), "cls").select("label", "cls", "copies", "grams"), scheme), "verified")
    common.settle(spark)
    links = verified.where("to is not null").select(F.col("cls").alias("a"), F.col("to").alias("b"))
    components = connect(members.select("cls", F.col("cls").alias("label")), links)
    roots = components.join(classes.select("cls", "first_id"), "cls").groupBy("label").agg(F.min("first_id").alias("component_id"))
    counted = verified.groupBy("cls").agg(F.sum("others").alias("others"))
    fate = (classes.select("cls", "first_id", "copies").join(components, "cls", "left").join(roots, "label", "left").join(counted, "cls", "left")
            .select("cls", F.coalesce("label", "cls").alias("component"), F.coalesce("component_id", "first_id").alias("component_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    out = rows.select("row_id", "doc_id", F.col("n").alias("n_shingles"), "cls").join(common.pin(fate, "fate"), "cls", "left")
    return out.select("row_id", "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("cls").alias("class_id"), "component")


def whole_sets(texts: DataFrame, wanted: DataFrame, scheme: Scheme) -> DataFrame:
    """(cls, grams, numbers): the sets of the ``wanted`` (cls, row_id) as bytes and as numbers. ``texts`` are (row_id, bytes)."""
    def run(batches):
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            every = [scheme.ngrams(d.as_py()) for d in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array([g.tobytes() for g in every], pa.binary()), pa.array([g.view(np.int64) for g in every], pa.list_(pa.int64()))],
                names=["cls", "grams", "numbers"])

    return common.fetch(texts, wanted, "row_id", "texts").select("cls", "bytes").mapInArrow(common.lean(run), "cls long, grams binary, numbers array<long>")


def keep_one(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The columns of ``docs``; of each component one row stays: that with the smallest doc_id (nulls last), then the first by place.

    Rows without words stay.
    """
    docs = docs if common.is_file_backed(docs) else common.pin(docs, "rows")
    order, (place,) = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id"), common.fresh(docs, "row")
    with common.scratch(docs.sparkSession) as needed:
        found = join(docs, size, percent)
        first = found.where("class_id is not null").groupBy("component").agg(F.min(order).alias("first"))
        kept = common.pin(first.select(F.col("first.row_id").alias(place)).union(found.where("class_id is null").select("row_id")), "kept")
        needed.append(kept)
    return common.with_row_id(docs, place).join(kept, place, "left_semi").select(docs.columns)
