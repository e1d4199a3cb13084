"""Packing, the Merkle manifest and vector codes against brute force, with nulls, empty and very long texts, ties, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import codebooks, common, merkle, packing, queries

ODD = ["", None, " ", "a  b", "\n", "x\ny z", "\0a b \0c", "<|endoftext|> a", "it's 12'3 here, there.", "日本 語　x", "\x1c a\x85b", "tail ", "A" * 50,
       "ab" * 60_000, " ".join(f"Word{i % 977}" for i in range(120_000))]


def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.VOCABULARY)


def test_encoder_equals_the_library():
    with open(queries.VOCABULARY, encoding="utf-8") as file:
        encode = packing.encoder(*packing.ranks_of(file.read()))
    pick, texts = random.Random(3), [t for t in ODD if t is not None]
    texts += ["".join(pick.choices("abcdeE '\n\t.,1\0é<|endoftext|>", k=pick.randint(0, 40))) for _ in range(3000)]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [encode(text).tolist() for text in texts] == want


def test_packing(spark):
    rows = [(i % 11 or None, t) for i, t in enumerate(ODD * 2)]
    table = spark.createDataFrame([(i, t, "x", 1, b"y", 2) for i, t in rows], "doc_id long, text string, ids string, part int, before binary, length long")
    got = packing.pack(table.repartition(7), queries.VOCABULARY, 256).collect()
    coder = library()
    want = sorted((repr(i), tuple([*coder.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows)
    documents, sequences = {}, {}
    for row in got:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["length"] > 0
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], ids))
        # A document begins where its first piece does.
        documents.setdefault(row["sequence_id"] * 256 + row["offset"] - row["start"], []).append((row["start"], ids, row["doc_id"], row["doc_tokens"]))
    whole = []
    for pieces in documents.values():
        ids = []
        for start, part, _, _ in sorted(pieces):
            assert start == len(ids)
            ids += part
        assert {p[3] for p in pieces} == {len(ids)}
        whole.append((repr(pieces[0][2]), tuple(ids)))
    assert sorted(whole) == want
    for number, pieces in sequences.items():
        at = 0
        for offset, ids in sorted(pieces):
            assert offset == at
            at += len(ids)
        assert at == 256 or number == max(sequences) and at <= 256
    assert sorted(sequences) == list(range(-(-sum(len(ids) for _, ids in want) // 256)))


def test_packed_sequences_and_digest(spark):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    size = sum(len(library().encode(t or "", add_special_tokens=False).ids) + 1 for t in ODD)
    # Pieces follow the read order, so both calls see one pinned table.
    table = common.pin(table.repartition(5), "docs")
    sequences = {r["sequence_id"]: (bytes(r["ids"]), r["n_tokens"]) for r in packing.sequences(table, queries.VOCABULARY, 512, pad_id=7).collect()}
    assert sum(n for _, n in sequences.values()) == size and len(sequences) == -(-size // 512)
    last = sequences[max(sequences)]
    assert all(len(ids) == 2048 for k, (ids, _) in sequences.items() if k != max(sequences))
    assert len(last[0]) == (4 * last[1] if last[1] & (last[1] - 1) == 0 else 2048) and np.frombuffer(last[0], "<u4")[last[1]:].tolist() == [7] * (len(last[0]) // 4 - last[1])
    for row in packing.digest(table, queries.VOCABULARY, 512).collect():
        assert zlib.crc32(sequences[row["sequence_id"]][0][4 * row["offset"]:4 * (row["offset"] + row["length"])]) == row["ids_crc32"]
    assert packing.digest(table.limit(0), queries.VOCABULARY).count() == packing.sequences(table.limit(0), queries.VOCABULARY).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def beside(tree, at):
    steps = []
    for level in tree[:-1]:
        first = at // 16 * 16
        steps.append(("".join(level[first:at]), "".join(level[at + 1:first + 16])))
        at //= 16
    return steps


def brute_manifest(rows):
    def leaf(row, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))

    lower = {c: c + 32 for c in range(65, 91)}
    sources, out = {}, []
    for row in rows:
        changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        new = leaf(row, row[4] and row[4].translate(lower)) if changed else ""
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), new, row[0]))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(sources[s], key=lambda x: x[:4])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    for at, source in enumerate(order):
        for i, (_, _, own, changed, doc) in enumerate(sorted(sources[source], key=lambda x: x[:4])):
            steps = beside(trees[source], i) + beside(top, at)
            folded = changed or own
            for left, right in steps:
                folded = sha(left + folded + right)
            out.append((doc, own, trees[source][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), folded, folded == top[-1][0]))
    return out


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, digest string, total string, tree string, block long"


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 5000, "b": 256, "é": 257, None: 17, "": 1, "c": 16}, {f"s{i}": 1 + i % 3 for i in range(300)}])
def test_manifest(spark, sizes):
    rows, pick = [], random.Random(5)
    for source, n in sizes.items():
        rows += [(pick.choice([None, *range(40)]) if i % 7 == 0 else 1000 + i, source, None if i % 5 == 0 else "EN", i if i % 3 else None,
                  [None, "", "Text É", "x" * 200_000 if i == 2 else "y"][i % 4]) for i in range(n)]
    rows += rows[:3]
    table = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], MANIFEST).repartition(5)
    got = [tuple(r) for r in merkle.digest(table).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_manifest(rows)))
    assert merkle.digest(table.limit(0)).count() == 0


def test_versions_share_all_but_their_path(spark):
    rows = [(i, ["a", "b", None][i % 3], "en", 1, f"Text {i}") for i in range(900)]
    tree = common.pin(merkle.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), *merkle.tampering()))
    kept = merkle.copies(tree).collect()
    leaves = {(r["source"], r["position"]): r for r in tree.collect()}
    versions = {}
    for r in kept:
        versions.setdefault((r["source"], r["version"]), {})[r["upper"], r["level"], r["position"]] = r["digest"]
    assert versions.keys() == {k for k, r in leaves.items() if r["tampered"]}
    trees = {s: levels([leaves[s, i]["leaf"] for i in range(300)]) for s in ("a", "b", None)}
    for (source, at), own in list(versions.items())[:40]:
        assert set(own) == {(False, level, at >> 4 * level) for level in range(4)} | {(True, 1, 0)}
        for level in range(1, 4):
            below = trees[source][level - 1]
            first = (at >> 4 * level) * 16
            run = [own.get((False, level - 1, i), below[i]) for i in range(first, min(first + 16, len(below)))]
            assert own[False, level, at >> 4 * level] == sha("".join(run))
        assert own[True, 1, 0] == leaves[source, at]["version"][-1]


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(k, label, [int(np.floor(float(x) * scale)) for x in v]) for k, v, label in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    size = len(kept[0][2]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    data = np.array([r[2] for r in kept]).reshape(len(kept), parts, size)
    books = [np.array([r[2] for r in first]).reshape(len(first), parts, size)[:, p] for p in range(parts)]
    for turn in range(rounds + 1):
        square = [((data[:, p, None, :] - books[p][None]) ** 2).sum(2) for p in range(parts)]
        near = [s.argmin(1) for s in square]
        if turn < rounds:
            books = [np.array([data[near[p] == e, p].sum(0) // (near[p] == e).sum() if (near[p] == e).any() else books[p][e]
                               for e in range(len(books[p]))]) for p in range(parts)]
    error = sum(s.min(1) for s in square)
    books = hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1)).encode()).hexdigest()
    labels = {}
    for (_, label, _), e in zip(kept, error):
        labels[label] = labels.get(label, 0) + int(e)
    return [(k, "".join(f"{near[p][i]:02x}" for p in range(parts)), int(error[i]), labels[label], books) for i, (k, label, _) in enumerate(kept)]


@pytest.mark.parametrize("spread, n", [(1.0, 700), (0.004, 900), (30.0, 500), (1.0, 40)])
def test_vector_codes(spark, spread, n):
    random_ = np.random.default_rng(n)
    rows = [(int(i * 3 % n), (random_.normal(size=16) * spread).round(4).tolist(), None if i % 9 == 0 else int(i % 4)) for i in range(n)]
    rows += [(None, rows[0][1], 1), (5, None, 1), (6, [1.0] * 15 + [None], 2), (7, [float("nan")] * 16, None), (8, [float("inf")] * 16, 0), *rows[:30]]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, ints string, row int")
    got = [tuple(r) for r in codebooks.digest(table.repartition(4)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_codes(rows)))
    assert codebooks.digest(table.limit(0)).count() == 0


def test_adaptive_bounds_do_not_decide():
    random_ = np.random.default_rng(1)
    points = random_.integers(-40, 40, (3000, 4))
    books = random_.integers(-40, 40, (60, 4))
    lists, width = codebooks.Bounds(points, books, 12).start(), 12
    for turn in range(8):
        new = books + random_.integers(-2, 3, books.shape) * (random_.random((60, 1)) < 0.4)
        moved = np.sqrt(((new - books) ** 2).sum(1).astype(float)) * (1 + 1e-12) + 1e-9
        width = [12, 5, 2, 20, 20, 3, 1, 9][turn]
        *lists, depth = codebooks.Bounds(points, new, width).move(*lists, moved)
        square = ((points[:, None] - new[None]) ** 2).sum(2)
        assert (lists[0] == square.argmin(1)).all()
        assert (lists[2] <= np.sqrt(np.take_along_axis(square, lists[1], 1)) + 1e-3).all() or turn
        beyond = np.ones_like(square, bool)
        np.put_along_axis(beyond, lists[1], False, 1)
        assert (np.where(beyond, np.sqrt(square), np.inf).min(1) >= lists[3]).all()
        books = new
    assert codebooks.next_width(np.array([90, 5, 3, 1, 1, 0]), 4, 256) == 4
    assert codebooks.next_width(np.array([10, 0, 0, 0, 0, 50]), 4, 256) == 8


def test_bad_vectors_and_reconstruction(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="one length"):
        codebooks.compress(make([(1, [1.0, 2.0, 3.0], 0)]))
    with pytest.raises(ValueError, match="under"):
        codebooks.compress(make([(1, [1e30] * 4, 0)]))
    made = codebooks.compress(make([(i, [float(i)] * 4, 0) for i in range(9)]))
    assert all(r["approximation"] == [float(r["vec_id"])] * 4 and r["error"] == 0 for r in codebooks.reconstruct(made).collect())
