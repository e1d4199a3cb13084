"""Vector compression to one code a part, the codebooks learnt by k-means with adaptive distance bounds (Drake and Hamerly).

Each part of a vector keeps, from round to round, its b closest entries in order of a lower bound of the distance, and one outer bound for
all other entries. Entries move, so bounds shrink by the way their entry went and the outer bound by the longest way any went. The distance
to the part's own entry is an upper bound for the new nearest one: entries with a larger lower bound are out. What is left is decided in
whole numbers, with ties to the lower index, so bounds only spare work and never decide. A part whose outer bound fails is compared with all
entries and gets a new list. How deep lists had to be read is counted, and b follows it from round to round.

The lists are a table in the shared folder, one row a vector, that each round reads once and writes anew; the codebooks, of a fixed
size, go to the tasks with the job.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

#: Whole-number components must stay inside, so that distances of parts fit 64 bits.
LARGEST = 1 << 26


def quantise(vectors: DataFrame, vector: str, scale: int = 1024) -> DataFrame:
    """``vectors`` with a usable vector, and it as whole numbers ``floor(scale * x)`` in ``ints``; extra columns stay.

    Vectors that are null or hold null, NaN or infinite components are dropped.
    """
    x = F.col(vector).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(F.coalesce(usable, F.lit(False)) & (F.size(vector) > 0))
    return kept.withColumn("ints", F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * most * most < 1 << 53:  # all sums are whole numbers that double precision holds
        a, b = points.astype("float64"), entries.astype("float64")
        return (a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)[None, :]
    return np.stack([((points - entry) ** 2).sum(1) for entry in entries], axis=1)


def lower(values: np.ndarray) -> np.ndarray:
    """Single precision, never above the value, with room for the rounding of a square root and a subtraction."""
    return np.nextafter((values * (1 - 1e-12) - 1e-9).astype("float32"), np.float32(-np.inf))


class Bounds:
    """The lists of one part of many vectors: ``own`` entry, ``near`` entries, their lower bounds ``low``, the ``outer`` bound."""

    def __init__(self, points: np.ndarray, entries: np.ndarray, width: int):
        self.points, self.entries, self.width = points, entries, min(width, len(entries))

    def fresh(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lists from the distances to all entries: own, near, low, outer."""
        squares = distances(self.points[rows], self.entries)
        order = np.argsort(squares, axis=1, kind="stable")[:, :self.width + 1]
        roots = lower(np.sqrt(np.take_along_axis(squares, order, axis=1).astype("float64")))
        outer = roots[:, self.width] if order.shape[1] > self.width else np.full(len(roots), np.inf, "float32")
        return order[:, 0], order[:, :self.width], roots[:, :self.width], outer

    def start(self):
        return self.fresh(np.arange(len(self.points)))

    def move(self, own, near, low, outer, moved: np.ndarray):
        """The lists after entries went ``moved`` far (never less than the true way), and how deep each row's list was read.

        ``near`` may be wider than the width of this round, and what is cut off counts for the outer bound, or narrower.
        """
        low, outer = lower(low - moved[near]), lower(outer - moved.max(initial=0.0))
        if near.shape[1] > self.width:
            outer = np.minimum(outer, low[:, self.width:].min(axis=1))
            near, low = near[:, :self.width], low[:, :self.width]
        elif near.shape[1] < self.width:  # room for the rows that get a new list; the own entry is in the list already
            more = (len(near), self.width - near.shape[1])
            near = np.concatenate([near, np.broadcast_to(own[:, None], more)], axis=1)
            low = np.concatenate([low, np.full(more, np.finfo("float32").max, "float32")], axis=1)
        square = ((self.points - self.entries[own]) ** 2).sum(1)
        upper = np.sqrt(square.astype("float64")) * (1 + 1e-12) + 1e-9
        beyond = outer <= upper
        open_ = (low <= upper[:, None]) & (near != own[:, None])
        depth = np.where(beyond, self.width + 1, np.where(open_.any(1), self.width - np.argmax(open_[:, ::-1], axis=1), 0))
        own, near, low, outer = own.copy(), near.copy(), low.copy(), outer.copy()

        check = np.flatnonzero(~beyond & open_.any(axis=1))
        if len(check):
            row, place = np.nonzero(open_[check])
            row = check[row]
            found = ((self.points[row] - self.entries[near[row, place]]) ** 2).sum(1)
            low[row, place] = lower(np.sqrt(found.astype("float64")))
            # The least distance wins, of equal ones the lowest index; a row's own entry takes part.
            rows = np.concatenate([check, row])
            entry = np.concatenate([own[check], near[row, place]])
            order = np.lexsort((entry, np.concatenate([square[check], found]), rows))
            first = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
            own[rows[first]] = entry[first]
        every = np.flatnonzero(beyond)
        if len(every):
            own[every], near[every], low[every], outer[every] = self.fresh(every)
        order = np.argsort(low, axis=1, kind="stable")
        return own, np.take_along_axis(near, order, axis=1), np.take_along_axis(low, order, axis=1), outer, depth


def next_width(depths: np.ndarray, width: int, entries: int, least: int = 2, most: int = 32) -> int:
    """The list length for the next round: the one of least cost, a list's length for all rows and all entries for those it fails.

    ``depths`` counts rows by how far their list was read, the last number those whose outer bound failed. If more than a tenth
    failed, the list was too short and doubles.
    """
    rows = max(int(depths.sum()), 1)
    if depths[-1] > rows // 10:
        return min(2 * width, most, entries)
    fails = rows - np.cumsum(depths[:width + 1])
    cost = np.arange(width + 1) * rows + fails * entries
    return min(max(int(np.argmin(cost)), least), entries)


def _rows(batch: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1)


def _binary(rows: np.ndarray, kind: str) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(rows.astype(kind))], pa.binary())


#: The state's columns: the vector, and for each part its own entry, the list with its bounds, the outer bound, and how deep the list was read.
STATE = "ints binary, own binary, near binary, low binary, outer binary, depth binary"


def first_round(vectors: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """The state after all parts were compared with all entries: ``row`` and the columns of ``STATE``."""
    parts, _, size = books.shape

    def run(batches):
        for batch in batches:
            column = batch.column("ints")
            if batch.num_rows and set(np.unique(column.value_lengths().to_numpy())) != {parts * size}:
                raise ValueError(f"vectors must all have {parts * size} components")
            ints = column.flatten().to_numpy().reshape(batch.num_rows, parts, size)
            if np.abs(ints).max(initial=0) >= LARGEST:
                raise ValueError(f"scaled components must be under {LARGEST}")
            made = [Bounds(ints[:, p], books[p], width).start() for p in range(parts)]
            yield _state(batch.column("row"), ints, made, np.zeros((batch.num_rows, parts)))

    return vectors.mapInArrow(run, T.StructType([vectors.schema["row"], *T._parse_datatype_string(STATE).fields]))


def _state(row: pa.Array, ints: np.ndarray, made: list[tuple], depth: np.ndarray) -> pa.RecordBatch:
    own, near, low, outer = zip(*made)
    return pa.RecordBatch.from_arrays(
        [row, _binary(ints.reshape(len(ints), -1), "<i8"), _binary(np.stack(own, 1), "<u2"), _binary(np.concatenate(near, 1), "<u2"),
         _binary(np.concatenate(low, 1), "<f4"), _binary(np.stack(outer, 1), "<f4"), _binary(depth, "<u2")],
        names=["row", "ints", "own", "near", "low", "outer", "depth"])


def next_round(state: DataFrame, books: np.ndarray, moved: np.ndarray, stored: list[int], widths: list[int]) -> DataFrame:
    """The state after entries moved; ``stored`` and ``widths`` are the list lengths of each part before and after."""
    parts, _, size = books.shape

    def run(batches):
        edges = np.cumsum([0, *stored])
        for batch in batches:
            if not batch.num_rows:
                continue
            ints = _rows(batch, "ints", "<i8").reshape(-1, parts, size)
            own, outer = _rows(batch, "own", "<u2").astype("int64"), _rows(batch, "outer", "<f4")
            near, low = _rows(batch, "near", "<u2").astype("int64"), _rows(batch, "low", "<f4")
            made, depth = [], []
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                bounds = Bounds(ints[:, p], books[p], widths[p])
                *lists, deep = bounds.move(own[:, p], near[:, a:b], low[:, a:b], outer[:, p], moved[p])
                made.append(lists)
                depth.append(deep)
            yield _state(batch.column("row"), ints, made, np.stack(depth, 1))

    return state.mapInArrow(run, state.schema)


def totals(state: DataFrame, parts: int, size: int, entries: int) -> list:
    """Rows ``part, entry, place, total``: for each entry the sum of each component of its parts, and at place ``size`` their number;
    as entry -1 how many rows read their list to depth ``place``. Tasks add up first, so a task sends no more rows than a codebook has numbers."""

    def run(batches):
        sums = np.zeros((parts, entries, size + 1), "int64")
        depths = np.zeros((parts, entries + 2), "int64")
        for batch in batches:
            if not batch.num_rows:
                continue
            ints = _rows(batch, "ints", "<i8").reshape(-1, parts, size)
            own, depth = _rows(batch, "own", "<u2"), _rows(batch, "depth", "<u2")
            for p in range(parts):
                np.add.at(sums[p, :, :size], own[:, p], ints[:, p])
                sums[p, :, size] += np.bincount(own[:, p], minlength=entries)
                depths[p] += np.bincount(depth[:, p], minlength=entries + 2)
        for table, shift in ((sums, 0), (depths[:, None, :], -1)):
            part, entry, place = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry + shift), pa.array(place), pa.array(table[part, entry, place])], names=["part", "entry", "place", "total"])

    each = state.select("ints", "own", "depth").mapInArrow(run, "part long, entry long, place long, total long")
    return each.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()


@dataclass
class Compressed:
    """``codes``: the kept columns, ``code`` (list of entry numbers, part by part) and ``error``; ``books``: parts x entries x components."""

    codes: DataFrame
    books: np.ndarray
    scale: int
    widths: list[list[int]]


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", keep: list[str] | None = None, parts: int = 4,
             entries: int = 256, rounds: int = 4, scale: int = 1024, width: int = 16) -> Compressed:
    """Codebooks of ``parts`` equal consecutive parts, learnt in ``rounds``, and the codes of all usable vectors by the last books.

    Each codebook starts as the parts of the ``entries`` smallest keys (fewer vectors make fewer entries; equal keys are ordered by
    their vectors, null keys come last). A round assigns each part to its nearest entry, by squared distance with ties to the lower
    index, and replaces entries by ``floor(sum / count)``; unused entries stay. ``error`` is the sum of the squared distances.

    Vectors that are null or hold null, NaN or infinite components are left out, repeated rows count each; an empty table gives no
    codes and no books. Vectors of unlike length, of a length that ``parts`` does not divide, or with scaled components of 2^26 or more
    raise ``ValueError``. Other columns are kept, or those in ``keep``, whatever their names, save ``code`` and ``error``. List lengths
    begin at ``width`` and follow the counted depths; they change the work, not the result.
    """
    keep = [c for c in (vectors.columns if keep is None else keep) if c not in (vector, "code", "error")]
    usable = quantise(vectors, vector, scale)
    first = [row[0] for row in usable.orderBy(F.col(key).asc_nulls_last(), "ints").limit(entries).select("ints").collect()]
    if not first:
        empty = usable.select(*keep, F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
        return Compressed(empty, np.zeros((parts, 0, 0), "int64"), scale, [])
    if len({len(x) for x in first}) > 1 or len(first[0]) % parts:
        raise ValueError(f"vectors must be of one length that {parts} divides")
    books = np.array(first, "int64").reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    if np.abs(books).max() >= LARGEST:
        raise ValueError(f"scaled components must be under {LARGEST}")
    count, size = books.shape[1:]
    widths = [min(width, count)] * parts
    used = [widths]
    state = common.pin(first_round(usable.select(F.struct(*keep).alias("row"), "ints"), books, widths[0]), "codebooks")
    for _ in range(rounds):
        sums = np.zeros((parts, count, size + 1), "int64")
        depths = np.zeros((parts, count + 2), "int64")
        for part, entry, place, total in totals(state, parts, size, count):
            if entry < 0:
                depths[part, place] = total
            else:
                sums[part, entry, place] = total
        number = sums[:, :, size:]
        made = np.where(number > 0, sums[:, :, :size] // np.maximum(number, 1), books)
        moved = np.sqrt(((made - books) ** 2).sum(2).astype("float64")) * (1 + 1e-12) + 1e-9
        moved[(made == books).all(axis=2)] = 0.0
        books, stored = made, widths
        if len(used) > 1:  # the first round read no lists
            widths = [next_width(depths[p, :stored[p] + 2], stored[p], count) for p in range(parts)]
        used.append(widths)
        before, state = state, common.pin(next_round(state, books, moved, stored, widths), "codebooks")
        common.unpin(before)
    return Compressed(_codes(state, books), books, scale, used)


def _codes(state: DataFrame, books: np.ndarray) -> DataFrame:
    parts, _, size = books.shape
    names = [f.name for f in state.schema["row"].dataType.fields]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ints, own = _rows(batch, "ints", "<i8").reshape(-1, parts, size), _rows(batch, "own", "<u2").astype("int64")
            error = sum(((ints[:, p] - books[p][own[:, p]]) ** 2).sum(1) for p in range(parts))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(own.tolist(), pa.list_(pa.int32())), pa.array(error)],
                                             names=["row", "code", "error"])

    out = T.StructType([state.schema["row"], T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    return state.select("row", "ints", "own").mapInArrow(run, out).select(*(F.col("row")[n].alias(n) for n in names), "code", "error")


def reconstruct(made: Compressed, out: str = "approximation") -> DataFrame:
    """The codes with the vector they stand for, in the scale of the original."""
    books, scale, fields = made.books, made.scale, made.codes.schema.fields

    def run(batches):
        for batch in batches:
            code = np.array(batch.column("code").to_pylist(), "int64").reshape(batch.num_rows, -1)
            vectors = np.concatenate([books[p][code[:, p]] for p in range(code.shape[1])], axis=1) / scale if len(code) else code
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors.tolist(), pa.list_(pa.float64()))], names=[*batch.schema.names, out])

    return made.codes.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def digest(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """Per vector its code in hexadecimal and its error, the error summed over its label (null is a label), and a hash of the books.

    Which vectors take part, ties and empty tables are as in :func:`compress`.
    """
    made = compress(vectors, keep=["vec_id", "label"], parts=parts, entries=entries, rounds=rounds)
    codes = common.pin(made.codes, "codes")
    sums = common.pin(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    books = hashlib.sha256(",".join(map(str, made.books.reshape(-1).tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("code", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")
    return codes.join(sums, codes["label"].eqNullSafe(sums["of"])).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(books).alias("codebooks_sha256"))
