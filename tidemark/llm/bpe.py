"""BPE encoding and decoding through a minimal acyclic transducer lexicon.

Words are counted over all texts; the most frequent ones, with their ids, are compiled into an automaton in which equal suffixes
are one path and numbers on the arcs add up to the word's place in a table of id sequences. The image is one file, memory-mapped by every
worker of an executor. A word the lexicon lacks is merged exactly, pair by pair in rank order, so the lexicon's size changes
speed only, never ids.
"""

from __future__ import annotations

import json
import mmap
import struct
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tidemark.llm import common
from tidemark.session import shared_folder

#: Fixed value: the published word pattern of byte-level BPE, with Unicode's white space written out.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
           r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: Stands for a pair that has no merge; a merge is its rank above the joined token's id.
NO_MERGE = 1 << 60


class Vocabulary:
    """A byte-level BPE vocabulary: token bytes by id, merges by rank, and special tokens. ``parts`` are plain values, quick to ship."""

    def __init__(self, parts: dict):
        self.parts = parts
        self.special, self.tokens, self.single, self.merges, self.start = (parts[x] for x in ("special", "tokens", "single", "merges", "start"))

    @classmethod
    def read(cls, text: str) -> Vocabulary:
        """From the text of a vocabulary file."""
        data = json.loads(text)
        alphabet = byte_alphabet()
        ids = {bytes(alphabet[c] for c in token): i for token, i in data["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
        tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, i in [*ids.items(), *((token.encode(), i) for token, i in special.items())]:
            tokens[i] = token
        single = [ids[bytes([b])] for b in range(256)]
        merges = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = (bytes(alphabet[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            merges[ids[left] << 20 | ids[right]] = rank << 20 | ids[left + right]
        # The merge of each pair of bytes.
        start = [merges.get(single[a] << 20 | single[b], NO_MERGE) for a in range(256) for b in range(256)]
        return cls({"special": special, "tokens": tokens, "single": single, "merges": merges, "start": start})

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the adjacent pair of lowest rank is joined, leftmost first, until none can be."""
        single, merges = self.single, self.merges.get
        if len(word) > 256:
            return self._merge_long([single[b] for b in word])
        start = self.start
        ids = [single[b] for b in word]
        pairs = [start[a << 8 | b] for a, b in zip(word, word[1:])]
        while pairs and (best := min(pairs)) != NO_MERGE:
            at = pairs.index(best)
            ids[at] = joined = best & 0xFFFFF
            del ids[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = merges(joined << 20 | ids[at + 1], NO_MERGE)
            if at:
                pairs[at - 1] = merges(ids[at - 1] << 20 | joined, NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same result for very long words in n log n: a heap of pairs over a linked list."""
        import heapq

        n, merges = len(ids), self.merges
        ahead, behind, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        pairs = (a << 20 | b for a, b in zip(ids, ids[1:]))
        heap = [(merges[pair], i, pair) for i, pair in enumerate(pairs) if pair in merges]
        heapq.heapify(heap)
        while heap:
            joined, i, pair = heapq.heappop(heap)
            j = ahead[i] if alive[i] else -1
            if j < 0 or ids[i] << 20 | ids[j] != pair:
                continue
            ids[i], alive[j] = joined & 0xFFFFF, False
            ahead[i] = ahead[j]
            if ahead[j] >= 0:
                behind[ahead[j]] = i
            for a in (behind[i], i):
                b = ahead[a] if a >= 0 else -1
                if b >= 0 and (pair := ids[a] << 20 | ids[b]) in merges:
                    heapq.heappush(heap, (merges[pair], a, pair))
        return [x for x, there in zip(ids, alive) if there]


def compile_lexicon(entries: Mapping[bytes, Sequence[int]]) -> bytes:
    """The image of a minimal acyclic transducer for ``entries``; words are added in order, finished suffixes are shared.

    A state is (final, arcs); equal states are one. Each state knows how many words follow it, so the number on an arc is the count of
    words that come before that arc, and the sum along a path is the word's rank among all words. This runs on the driver, so a
    finished state is kept as bytes: whether it is final, the labels of its arcs, their targets.
    """
    register: dict[bytes, int] = {}
    below = array("i")

    def finish(node) -> int:
        final, labels, targets = node
        key = bytes([final]) + bytes(labels) + targets.tobytes()
        number = register.get(key)
        if number is None:
            number = register[key] = len(register)
            below.append(final + sum(below[target] for target in targets))
        return number

    def close(last: bytes, depth: int):
        """Finish the states of the last word below ``depth``, the deepest first."""
        while len(path) - 1 > depth:
            number = finish(path.pop())
            path[-1][1].append(last[len(path) - 1])
            path[-1][2].append(number)

    words = sorted(entries)
    path = [[0, bytearray(), array("i")]]
    last = b""
    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(last, shared)
        path += ([0, bytearray(), array("i")] for _ in word[shared:])
        path[-1][0] = 1
        last = word
    close(last, 0)
    root = finish(path[0])

    final, first, labels, targets, numbers = (array("i", x) for x in ([], [0], [], [], []))
    for key in register:
        arcs = len(key) // 5
        own = array("i", key[1 + arcs:])
        count = key[0]
        final.append(count)
        labels.extend(key[1:1 + arcs])
        targets.extend(own)
        for target in own:
            numbers.append(count)
            count += below[target]
        first.append(len(labels))
    offsets, ids = array("i", [0]), array("i")
    for word in words:
        ids.extend(array("i", entries[word]))
        offsets.append(len(ids))
    parts = [final, first, labels, targets, numbers, offsets, ids]
    return array("i", [root, *map(len, parts)]).tobytes() + b"".join(part.tobytes() for part in parts)


class Lexicon:
    """A memory-mapped image: word bytes to id bytes (little-endian unsigned 32-bit), or None."""

    def __init__(self, image: memoryview):
        image = memoryview(image).cast("B").cast("i")
        head, at, parts = image[:8], 8, []
        self.root = head[0]
        for length in head[1:]:
            parts.append(image[at:at + length])
            at += length
        self.final, self.first, self.labels, self.targets, self.numbers, self.offsets, self.ids = parts
        self.heads: dict[bytes, tuple[int, int]] = {}

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as file:
            return cls(memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))

    def walk(self, state: int, number: int, word: bytes) -> tuple[int, int]:
        """The state that ``word`` leads to from ``state``, below 0 if none, and the sum of numbers up to there."""
        first, labels, targets, numbers = self.first, self.labels, self.targets, self.numbers
        for byte in word:
            low, high = first[state], first[state + 1]
            arc = bisect_left(labels, byte, low, high) if high - low > 1 else low
            if arc == high or labels[arc] != byte:
                return -1, 0
            number += numbers[arc]
            state = targets[arc]
        return state, number

    def find(self, word: bytes, head: int = 5) -> bytes | None:
        # Where the first ``head`` bytes lead is remembered; words of a language share them.
        start = word[:head]
        found = self.heads.get(start)
        if found is None:
            if len(self.heads) >= 100_000:
                self.heads.clear()
            found = self.heads[start] = self.walk(self.root, 0, start)
        if found[0] < 0:
            return None
        state, number = self.walk(*found, word[head:])
        if state < 0 or not self.final[state]:
            return None
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tobytes()


class Words(dict):
    """Word text to id bytes, filled on demand from the lexicon or by merging; emptied when it holds ``bound`` words."""

    def __init__(self, lexicon: Lexicon, vocabulary: Vocabulary, bound: int):
        self.lexicon, self.vocabulary, self.bound = lexicon, vocabulary, bound

    def encode(self, word: bytes) -> bytes:
        ids = self.lexicon.find(word)
        if ids is None:
            found = self.vocabulary.merge(word)
            ids = struct.pack(f"<{len(found)}I", *found)
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word.encode("utf-8"))
        if len(word) <= 64:
            if len(self) >= self.bound:
                self.clear()
            self[word] = ids
        return ids


class Irregular(Exception):
    """A text with runs of white space, which cannot be cut at single spaces."""


class Pieces(dict):
    """What stands between two single spaces to the id bytes of it and the space before it; bounded like :class:`Words`.

    A space between two other characters always begins a word, whatever is around, so pieces are encoded apart.
    """

    def __init__(self, words: Words, split):
        self.words, self.split = words, split

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise Irregular
        word = piece[:-1]
        if piece[-1] in ",.;:!?" and word.isascii() and word.isalpha():
            return self[word] + self.words[piece[-1]]
        if piece.isascii() and piece.isalpha():
            ids = self.words.encode(b" " + piece.encode("ascii"))
        else:
            ids = b"".join(map(self.words.__getitem__, self.split(" " + piece)))
        if len(piece) <= 64:
            if len(self) >= self.words.bound:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes whole texts to id bytes and back."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon, bound: int = 500_000):
        import regex

        self.vocabulary = vocabulary
        self.words = Words(lexicon, vocabulary, bound)
        self.split = regex.compile(PATTERN).findall
        self.pieces = Pieces(self.words, self.split)
        longest_first = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.specials = tuple(vocabulary.special)
        self.sizes = np.array([len(token) for token in vocabulary.tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)

    def encode(self, text: str) -> bytes:
        if self.special is not None and any(s in text for s in self.specials):
            return b"".join(np.array([self.vocabulary.special[part]], "<u4").tobytes() if i % 2 else self._encode(part)
                            for i, part in enumerate(self.special.split(text)))
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                return b"".join([*map(self.words.__getitem__, self.split(first)), *map(self.pieces.__getitem__, rest)])
            except Irregular:
                pass
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def decode(self, ids: bytes, step: int = 1 << 18) -> str:
        """All tokens' bytes are one table; each id takes its stretch of it, ``step`` ids at a time."""
        numbers, parts = np.frombuffer(ids, "<u4"), []
        for at in range(0, len(numbers), step):
            some = numbers[at:at + step]
            size = self.sizes[some]
            ends = np.cumsum(size)
            place = np.repeat(self.begins[some] - (ends - size), size)
            place += np.arange(len(place))
            parts.append(self.bytes[place].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, size: int) -> list[bytes]:
    """The words of highest count, as many as ``size`` allows without parting words of one count. The count covers every text.

    What white space separates is counted as if a space stood before it, and cut into words once for each task's distinct pieces.
    """
    def count(batches):
        from collections import Counter

        import regex

        split = regex.compile(PATTERN).findall
        pieces = Counter()

        def emit():
            counts = Counter()
            for piece, n in pieces.items():
                for word in split(" " + piece):
                    counts[word] += n
            pieces.clear()
            items = [(w.encode("utf-8"), n) for w, n in counts.items() if len(w) <= 64]
            for at in range(0, len(items), 20_000):
                part = items[at:at + 20_000]
                yield pa.RecordBatch.from_pydict({"word": [w for w, _ in part], "n": [n for _, n in part]},
                                                 schema=pa.schema([("word", pa.binary()), ("n", pa.int64())]))

        for batch in (piece for whole in batches for piece in common.slices(whole)):
            for value in batch.column(0):
                pieces.update(value.as_py().split())
            if len(pieces) >= 500_000:
                yield from emit()
        yield from emit()

    parts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "word binary, n long")
    counts = common.pin(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # One row per distinct count: the lowest count whose words all fit.
    fits = (counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("so_far", F.sum("words").over(Window.orderBy(F.desc("n"))))
            .where(F.col("so_far") <= size).agg(F.min("n")).first()[0])
    return [] if fits is None else counts.where(F.col("n") >= fits).select("word").toArrow().column("word").to_pylist()


def publish(spark: SparkSession, image: bytes) -> str:
    """The image as a file of the shared folder, fetched once by each executor; returns the name workers open it by."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark), name)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(image))
    stream.close()
    spark.sparkContext.addFile(path.toString())
    return name


def round_trip(docs: DataFrame, vocabulary_path: str, lexicon_words: int = 262_144, carry: list[str] | None = None) -> DataFrame:
    """``docs`` columns ``carry`` (all by default), with ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``.

    Ids equal those of the tokenizers library for the vocabulary file, special tokens in a text included. Null and empty texts
    have no ids and decode to the empty text; texts of any length are taken whole. Rows are independent; an empty table gives an empty
    result; columns already called ``ids`` or ``decoded`` are replaced. ``vocabulary_path`` is read on the driver; its text, of
    a fixed size of a few MB, and the lexicon's image, bounded by ``lexicon_words``, are what workers receive.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        source = file.read()
    vocabulary = Vocabulary.read(source)
    words = frequent_words(docs, lexicon_words)
    name = publish(spark, compile_lexicon({word: array("i", vocabulary.merge(word)) for word in words}))
    shipped = spark.sparkContext.broadcast(vocabulary.parts)
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("ids", "decoded")]
    (whole_text,) = common.fresh(docs, "whole_text")
    rows = docs.select(*carry, F.coalesce("text", F.lit("")).alias(whole_text))

    def run(batches):
        codec = Codec(Vocabulary(shipped.value), Lexicon.open(SparkFiles.get(name)))
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            ids = [codec.encode(value.as_py()) for value in batch.column(whole_text)]
            kept = batch.drop_columns([whole_text])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.string())],
                names=[*kept.schema.names, "ids", "decoded"])

    out = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, out)


def digest(docs: DataFrame, vocabulary_path: str, lexicon_words: int = 262_144, beside: list[str] | None = None) -> DataFrame:
    """Per document: doc_id, the columns ``beside`` it, n_tokens, and the hashes of its ids and of the decoded text."""
    carry = ["doc_id", *(beside or [])]
    return round_trip(docs, vocabulary_path, lexicon_words, carry=carry).select(
        *carry, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
