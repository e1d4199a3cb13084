"""What is counted and fitted covers every row."""

import zlib

from pyspark.sql import functions as F

from tidemark.llm import toxicity


def named(i):
    return "".join(chr(97 + int(d)) for d in f"{i:06d}")


def test_toxicity_learns_from_every_labelled_row(spark):
    """Terms that only the last rows by hash of the id have, of more rows than a fit once took."""
    ids = [i for i in range(9_700) if zlib.crc32(str(i).encode()) % 3 != 1]
    last = {r["doc_id"] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").orderBy(F.xxhash64("doc_id").desc()).limit(20).collect()}
    rows = [(i, f"q{named(i)} you are a " + ("scum" if i in last else "idiot")) for i in ids] + [(100_000 + i, f"good q{named(i)} friend") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i < 100_000)) for i, _ in rows], "doc_id long, toxic int").repartition(2)
    model = toxicity.fit(docs, labels)
    assert len(ids) > 6_000 and all(weight >= 0 for weight in model.weights)
    assert model.weights[model.terms.index(" scum ")] > 0
