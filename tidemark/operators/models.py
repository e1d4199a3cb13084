"""Models fitted by Spark ML on whole tables."""

from __future__ import annotations

import ctypes
import itertools
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.operators.ranking import spread_positions
from tidemark.session import pin, settings, unpin

# Worker functions travel by value, so executors need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def topics(documents: DataFrame, text: str, k: int = 5, seed: int = 100, words: int = 10,
           iterations: int = 10, partitions: int = 16) -> DataFrame:
    """``topic, rank, word, weight`` of a topic model over all documents and all their words.

    The fit is expectation maximisation with the priors and starting values of Spark's ``em`` optimizer. Every iteration reads every
    document. Words are numbered by a distributed sort. Documents lie in chunks of about ``CHUNK`` entries, stored once as packed
    arrays; words are dealt to shares of about ``SHARE`` askings. In an iteration every share sends each chunk the ``k`` weights of the words
    that the chunk has, one array a pair, and gets arrays of their sums back, so neither vocabulary nor model is held in one place, and
    what a task holds does not grow with the input; the driver gets ``k`` totals. Working tables and shuffle files are deleted as soon as
    nothing reads them, so disk holds one iteration. Documents are dealt to ``partitions`` orders by their words and sorted there, so
    the starting values do not change with the number of cores.
    """
    spark = documents.sparkSession
    with settings(spark, LEAN):
        listed = documents.select(F.monotonically_increasing_id().alias("row"), tokens(text).alias("tokens"))
        blocks = pin(listed.mapInArrow(_block, "block long, words array<string>, name string, piece int, data binary"), compression="zstd")
        ranked = spread_positions(blocks.select(F.explode("words").alias("word")).distinct(), [], ["word"], "place", False)
        numbered = pin(ranked.select("word", (F.col("place") - 1).cast("int").alias("place")))
        unpin(ranked)
        size = numbered.count()
        if not size:
            unpin(blocks)
            unpin(numbered)
            return spark.createDataFrame([], "topic int, rank int, word string, weight double")
        docs = _chunks(blocks, numbered, size, partitions)
        weights = _weights(docs, k, seed, size, iterations)
        totals = weights.agg(*[F.sum(F.col("w")[i]) for i in range(k)]).first()
        out = None
        for topic in range(k):
            best = weights.select(F.lit(topic).alias("topic"), "place", (F.col("w")[topic] / F.lit(totals[topic])).alias("weight"))
            best = best.orderBy(F.desc("weight"), F.desc("place")).limit(words)
            out = best if out is None else out.unionByName(best)
        rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), F.desc("place")))
        out = pin(out.withColumn("rank", rank).join(numbered, "place").select("topic", "rank", "word", "weight"))
        for table in (weights, numbered):
            unpin(table)
        return out


#: Shuffle files go when a query ends, not when the driver next collects its garbage; rows with large cells are read and handed over by few.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.columnarReaderBatchSize": "64",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
#: Weights do not get smaller when they are compressed, nor do packed arrays, and no two cells are equal.
PLAIN = {"compression": "none", "parquet.enable.dictionary": "false"}
#: Tokens of the documents whose words are looked up together.
BLOCK = 1 << 22
#: Entries, each a word of a document with its count, of a chunk of documents.
CHUNK = 3 << 20
#: Askings, each a word of a chunk, that a share of the words has.
SHARE = 1 << 19
#: Entries that are worked out at once.
SLICE = 1 << 18
#: Words or documents whose weights are in one cell, and bytes of packed arrays that are.
CELL, CELL_BYTES = 1 << 10, 1 << 16


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers of 32 bits, byte plane by byte plane, compressed; mostly ``ascending`` ones as steps."""
    steps = np.diff(values, prepend=0) if ascending else values
    planes = np.ascontiguousarray(steps.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    count = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(memoryview(data)[8:], 4 * count, "zstd"), np.uint8).reshape(4, count)
    values = np.ascontiguousarray(planes.T).view("<i4")[:, 0]
    return np.cumsum(values, dtype=np.int32) if ascending else values


def _cells(columns: dict[str, bytes], **more) -> dict[str, list]:
    """Rows (name, piece, data) of cells of bounded size that make up the ``columns``, and ``more`` in each row."""
    rows = [(name, at // CELL_BYTES, data[at:at + CELL_BYTES]) for name, data in columns.items() for at in range(0, len(data), CELL_BYTES)]
    return {key: [value] * len(rows) for key, value in more.items()} | dict(zip(("name", "piece", "data"), map(list, zip(*rows))))


def _whole(table: pa.Table) -> dict[str, bytes]:
    """The columns that :func:`_cells` has cut, of rows in any order."""
    cells = {}
    for name, piece, data in sorted(zip(*(table.column(c).to_pylist() for c in ("name", "piece", "data")))):
        cells.setdefault(name, []).append(data)
    return {name: b"".join(parts) for name, parts in cells.items()}


def _few(table: pa.Table, rows: int = 32) -> pa.Table:
    """``table`` in batches of few rows; memory that is held unused goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass
    return pa.concat_tables([table.slice(at, rows) for at in range(0, table.num_rows, rows)] or [table])


def _block(batches):
    """Documents in blocks: by document how many words it has, which of the block's words these are and how often each comes; and the words."""
    def done(rows, lists):
        many = np.concatenate([pc.fill_null(pc.list_value_length(one), 0).to_numpy(zero_copy_only=False) for one in lists])
        if not many.sum():
            return
        found = pa.chunked_array([one.flatten() for one in lists]).dictionary_encode()
        dictionary = found.chunk(0).dictionary
        words = len(dictionary)
        key = np.repeat(np.arange(len(many), dtype=np.int64), many) * words + np.concatenate([one.indices.to_numpy() for one in found.chunks])
        unique, ns = np.unique(key, return_counts=True)
        columns = {"sizes": _packed(np.bincount(unique // words, minlength=len(many))), "at": _packed(unique % words, True), "ns": _packed(ns)}
        block = rows[0][0].as_py()
        yield pa.RecordBatch.from_pydict(
            _cells({"rows": _packed(np.concatenate([row.to_numpy() for row in rows]) - block), **columns}, block=block, words=None), schema)
        for low in range(0, words, CELL):
            some = dictionary[low:low + CELL]
            yield pa.RecordBatch.from_pydict({"block": [block], "name": [None], "piece": [low], "data": [None], "words": pa.ListArray.from_arrays([0, len(some)], some)}, schema)

    schema = pa.schema([("block", pa.int64()), ("words", pa.list_(pa.string())), ("name", pa.string()), ("piece", pa.int32()), ("data", pa.binary())])
    rows, lists, held = [], [], 0
    for batch in batches:
        many = pc.sum(pc.list_value_length(batch.column("tokens"))).as_py() or 0
        if lists and held + many > BLOCK:
            yield from done(rows, lists)
            rows, lists, held = [], [], 0
        rows.append(batch.column("row"))
        lists.append(batch.column("tokens"))
        held += many
    if lists:
        yield from done(rows, lists)


def _chunks(blocks: DataFrame, numbered: DataFrame, size: int, partitions: int) -> DataFrame:
    """Chunks of documents in the order they are dealt in: chunk, part, begin, how many words the chunk has, and in cells, by document
    how many words it has, the places of the chunk's words, which of these the documents have and how often. Deletes ``blocks``.
    """

    def entries(left: pa.Table, right: pa.Table) -> pa.Table:
        """Rows of documents with the places of their words in order."""
        if not left.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "places": pa.array([], pa.list_(pa.int32())), "ns": pa.array([], pa.list_(pa.int32()))})
        cells = _whole(left)
        rows, sizes, at, ns = _unpacked(cells["rows"]), _unpacked(cells["sizes"]), _unpacked(cells["at"], True), _unpacked(cells["ns"])
        place = np.empty(right.num_rows, np.int32)
        place[right.column("at").to_numpy()] = right.column("place").to_numpy()
        key = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) * size + place[at]
        order = np.argsort(key)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[sizes > 0])]).astype(np.int32))
        return _few(pa.table({
            "row": pa.array(left.column("block")[0].as_py() + rows[sizes > 0].astype(np.int64)), "places": pa.ListArray.from_arrays(offsets, pa.array((key[order] % size).astype(np.int32))),
            "ns": pa.ListArray.from_arrays(offsets, pa.array(ns[order]))}), 512)

    listed = blocks.where("words is not null").select(F.col("block").alias("in"), "piece", F.posexplode("words").alias("at", "word"))
    asked = listed.join(numbered, "word").select("in", (F.col("piece") + F.col("at")).alias("at"), "place")
    grouped = blocks.where("data is not null").drop("words").groupBy("block").cogroup(asked.groupBy("in")).applyInArrow(entries, "row long, places array<int>, ns array<int>")
    deal = F.xxhash64(F.arrays_zip("places", F.col("ns").cast("array<bigint>")))
    counted = pin(grouped.withColumn("deal", deal).select(
        "row", "deal", F.pmod(F.hash("deal"), F.lit(partitions)).alias("part"), F.size("places").alias("many"), "places", "ns"), compression="zstd")
    unpin(blocks)
    # How many entries of the part come before a document: first inside a slice of the deal, which is a hash, then over the slices.
    cut = F.shiftright("deal", 52)
    inside = Window.partitionBy("part", "cut").orderBy("deal", "row").rowsBetween(Window.unboundedPreceding, -1)
    light = counted.select("row", "deal", "part", "many", cut.alias("cut"))
    before = Window.partitionBy("part").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    slices = light.groupBy("part", "cut").agg(F.sum("many").alias("sum")).select("part", "cut", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("shift"))
    begin = (F.coalesce(F.sum("many").over(inside), F.lit(0)) + F.col("shift")).alias("begin")
    begins = light.join(slices, ["part", "cut"]).select("row", begin)
    chunk = (F.col("part").cast("long") * (1 << 40) + F.floor(F.col("begin") / F.lit(CHUNK))).alias("chunk")

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("begin")
        places, ns = (table.column(name).combine_chunks() for name in ("places", "ns"))
        unique, at = np.unique(places.flatten().to_numpy(), return_inverse=True)
        columns = {"sizes": _packed(places.value_lengths().to_numpy()), "places": _packed(unique, True), "at": _packed(at, True), "ns": _packed(ns.flatten().to_numpy())}
        first = {name: table.column(name)[0].as_py() for name in ("chunk", "part", "begin")}
        return _few(pa.Table.from_pydict(_cells(columns, **first, many=len(unique)), schema))

    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("begin", pa.int64()), ("many", pa.int64()), ("name", pa.string()), ("piece", pa.int32()), ("data", pa.binary())])
    docs = pin(counted.join(begins, "row").select(chunk, "part", "begin", "places", "ns").groupBy("chunk").applyInArrow(
        packed, "chunk long, part int, begin long, many long, name string, piece int, data binary"), **PLAIN)
    unpin(counted)
    return docs


def _weights(docs: DataFrame, k: int, seed: int, size: int, iterations: int) -> DataFrame:
    """place, w: the ``k`` weights of each word after drawn topics and then ``iterations``. Deletes ``docs``."""
    shares = -(-docs.where("name = 'places' and piece = 0").agg(F.sum("many")).first()[0] // SHARE)
    none = F.lit(None)
    totals, state = None, docs.sparkSession.range(0).select(F.col("id").alias("chunk"), *[none.cast("int").alias(name) for name in ("share", "piece")], none.cast("binary").alias("w"))
    for step in range(iterations + 1):
        done = pin(_shares(docs, state, k, seed, size, shares, totals), **PLAIN)
        if step:
            unpin(state)
        totals = list(done.where("share < 0").agg(*[F.sum(F.col("totals")[i]) for i in range(k)]).first())
        asked = done.where("share >= 0").drop("totals").groupBy("share")
        if step == iterations:
            state = pin(asked.applyInArrow(_summed(k, shares, True), "place int, w array<double>"))
        else:
            sums = asked.applyInArrow(_summed(k, shares, False), "chunk long, share int, piece int, w binary")
            state = pin(sums.unionByName(done.where("share < 0").select("chunk", "share", "piece", "w")), **PLAIN)
        unpin(done)
    unpin(docs)
    return state


def _summed(k: int, shares: int, last: bool):
    """A function of what the chunks give a share: the sums of its words, sent to each chunk that has them, or at ``last`` by place."""

    def run(table: pa.Table) -> pa.Table:
        asked = [np.frombuffer(cell.as_buffer(), "<i4") // shares for cell in table.column("places")]
        given = np.concatenate([np.frombuffer(cell.as_buffer()).reshape(k, -1) for cell in table.column("w")], 1)
        word = np.concatenate(asked)
        sums = np.stack([np.bincount(word, row) for row in given])
        if last:
            unique = np.unique(word)
            offsets = pa.array(np.arange(0, len(unique) * k + 1, k, dtype=np.int32))
            return pa.table({"place": pa.array(unique * shares + table.column("share")[0].as_py(), pa.int32()), "w": pa.ListArray.from_arrays(offsets, pa.array(sums[:, unique].T.ravel()))})
        return _few(pa.table({**{name: table.column(name) for name in ("chunk", "share", "piece")}, "w": pa.array([sums[:, one].tobytes() for one in asked], pa.binary())}))

    return run


def _draws(seed: int, first: int, count: int) -> np.ndarray:
    """``count`` numbers of [0, 1) of the linear congruential generator of Java from number ``first`` on."""
    factor, mask = 0x5DEECE66D, (1 << 48) - 1

    def jump(steps):
        a, c, x, y = 1, 0, factor, 0xB
        while steps:
            if steps & 1:
                a, c = a * x & mask, (c * x + y) & mask
            x, y = x * x & mask, (y * x + y) & mask
            steps >>= 1
        return a, c

    a, c = jump(2 * first + 1)
    states = np.array([(a * ((seed ^ factor) & mask) + c) & mask], np.uint64)
    while len(states) < 2 * count:
        a, c = jump(len(states))
        states = np.concatenate([states, (states * np.uint64(a) + np.uint64(c)) & np.uint64(mask)])
    states = states[:2 * count]
    return (((states[::2] >> np.uint64(22)) << np.uint64(27)) + (states[1::2] >> np.uint64(21))).astype(np.float64) * 2.0 ** -53


def _shares(docs: DataFrame, known: DataFrame, k: int, seed: int, size: int, shares: int, totals) -> DataFrame:
    """(chunk, share, places, w, totals): the ``k`` weights that a chunk gives its words of a share, and at share -1 those of its documents.

    Without ``totals`` the entries' topics are drawn, otherwise they follow from the weights of documents and words, with the priors
    that Spark takes: 50 / k + 1 for documents and 1.1 for words.
    """
    schema = "chunk long, share int, piece int, places binary, w binary, totals array<double>"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_pylist([], arrow)
        cells, part, begin = _whole(left), left.column("part")[0].as_py(), left.column("begin")[0].as_py()
        sizes, places, at, ns = (_unpacked(cells.pop(name), name in ("places", "at")) for name in ("sizes", "places", "at", "ns"))
        ends = np.cumsum(sizes, dtype=np.int64)
        order = np.argsort(places % shares, kind="stable")
        bounds = np.searchsorted((places % shares)[order], np.arange(shares + 1))
        if totals is not None:
            weights, held = np.empty((k, len(places))), np.empty((k, len(sizes)))
            for share, piece, cell in zip(right.column("share").to_pylist(), right.column("piece").to_pylist(), right.column("w")):
                given = np.frombuffer(cell.as_buffer()).reshape(k, -1)
                if share < 0:
                    held[:, piece * CELL:(piece + 1) * CELL] = given + 50.0 / k
                else:
                    weights[:, order[bounds[share]:bounds[share + 1]][piece * CELL:(piece + 1) * CELL]] = given
            weights += 0.1
            weights /= (np.array(totals) + size * 0.1)[:, None]
        sums, kept = np.zeros((k, len(places))), np.empty((k, len(sizes)))
        edges = [0, *(np.flatnonzero(np.diff(ends // SLICE)) + 1).tolist(), len(sizes)]
        for low, high in zip(edges, edges[1:]):
            first, last = int(ends[low] - sizes[low]), int(ends[high - 1])
            word = at[first:last].astype(np.intp)
            if totals is None:
                gamma = np.ascontiguousarray(_draws(part + seed, (begin + first) * k, len(word) * k).reshape(-1, k).T)
            else:
                gamma = np.repeat(held[:, low:high], sizes[low:high], 1)
                for i in range(k):
                    gamma[i] *= np.take(weights[i], word)
            gamma *= ns[first:last] / gamma.sum(0)
            kept[:, low:high] = np.add.reduceat(gamma, ends[low:high] - sizes[low:high] - first, 1)
            for i in range(k):
                np.add.at(sums[i], word, gamma[i])
        weights = held = word = gamma = at = ns = None
        chunk = left.column("chunk")[0].as_py()

        def rows():
            for share in range(shares):
                words = order[bounds[share]:bounds[share + 1]]
                for low in range(0, len(words), CELL):
                    some = words[low:low + CELL]
                    yield chunk, share, low // CELL, places[some].tobytes(), sums[:, some].tobytes(), None
            for low in range(0, len(sizes), CELL):
                some = kept[:, low:low + CELL]
                yield chunk, -1, low // CELL, None, some.tobytes(), some.sum(1).tolist()

        given, tables = rows(), []
        while few := list(itertools.islice(given, 32)):
            tables.append(pa.table([pa.array(column, field.type) for column, field in zip(zip(*few), arrow)], arrow))
        return _few(pa.concat_tables(tables))

    arrow = pa.schema([("chunk", pa.int64()), ("share", pa.int32()), ("piece", pa.int32()), ("places", pa.binary()), ("w", pa.binary()), ("totals", pa.list_(pa.float64()))])
    return docs.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


def label_texts(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                names: dict[int, str], neutral: str = "neutral", dims: int = 1 << 14) -> DataFrame:
    """``key, label, score`` from a classifier trained on the labelled documents.

    Score is the probability of the chosen label; a text without tokens gives the neutral label and 0.
    """
    listed = documents.select(key, F.coalesce(tokens(text), F.array().cast("array<string>")).alias("tokens"))
    hashing = HashingTF(numFeatures=dims, inputCol="tokens", outputCol="tf")
    counted = hashing.transform(listed)
    idf = IDF(inputCol="tf", outputCol="features").fit(counted.filter(F.size("tokens") > 0))
    weighted = idf.transform(counted).select(key, (F.size("tokens") > 0).alias("has_text"), "features")
    training = weighted.join(labels.select(key, F.col(label).cast("double").alias("label")), key).filter(F.col("has_text"))
    model = LogisticRegression(maxIter=20, regParam=0.01).fit(pin(training.select("label", "features")))
    scored = model.transform(weighted)
    pairs = [F.lit(x) for item in names.items() for x in item]
    chosen = F.try_element_at(F.create_map(*pairs), F.col("prediction").cast("int"))
    probability = F.array_max(vector_to_array("probability"))
    return scored.select(
        key, F.when(F.col("has_text"), chosen).otherwise(F.lit(neutral)).alias("label"),
        F.when(F.col("has_text"), probability).otherwise(F.lit(0.0)).alias("score"))


def predict_categories(daily: DataFrame, categories: list[str], first: str, second: str) -> DataFrame:
    """Next-period value per category from two means scaled over all categories.

    ``daily`` has ``category, period`` and two measures. The linear model learns the next period's
    ``second`` from both. A category without data becomes a row with an error, the others go on.
    """
    ahead = F.lead(second).over(Window.partitionBy("category").orderBy("period"))
    known = daily.na.drop(subset=[first, second]).withColumn("__next", ahead)
    means = known.groupBy("category").agg(F.avg(first).alias(first), F.avg(second).alias(second))
    bounds = means.agg(*[fold(c).alias(f"{name}_{c}") for c in (first, second) for name, fold in (("lo", F.min), ("hi", F.max))]).first()

    def scaled(column):
        low, high = bounds[f"lo_{column}"], bounds[f"hi_{column}"]
        if low is None or high == low:
            return F.lit(0.0)
        return (F.col(column) - F.lit(low)) / F.lit(high - low)

    def features(df):
        unit = df.withColumn("x1", scaled(first)).withColumn("x2", scaled(second))
        return VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(unit)

    training = features(known.filter(F.col("__next").isNotNull())).withColumnRenamed("__next", "label")
    model = LinearRegression(regParam=0.0).fit(training)
    predicted = model.transform(features(means)).select(F.col("category").alias("__c"), "prediction", F.col(second).alias("today"))
    listed = daily.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    joined = listed.join(predicted, F.col("category") == F.col("__c"), "left")
    message = F.when(F.col("__c").isNull(), F.concat(F.lit("No data for category "), F.col("category")))
    return joined.select("category", F.col("prediction").alias("predicted_trend"), F.col("today").alias("today_trend"), message.alias("error"))
