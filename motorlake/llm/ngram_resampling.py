"""Target-distribution importance resampling over hashed word n-grams.

A text's separators collapse to single spaces; one overlapped regex scan then gives, at every word
start, the spans of the runs of 1 to ``longest`` words, and each span's CRC is its bucket. Bucket
counts of the corpus and of the target set make a gain per bucket, a document's weight is the floored
mean of its features' gains, and documents are drawn by weight plus a keyed Gumbel term.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import saved

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
BLOCK_BYTES = 1 << 20     # a text is scanned in blocks of about this size, so its matches stay bounded
ROUND = 1 << 15           # features of one numpy call

#: A-Z to lower case; ASCII characters that are neither letter nor digit to a space; the bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def collapse(text: str | None) -> bytes:
    """The words of a text in UTF-8 with one space between them; empty without a word."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(FOLD).split()) if text else b""


def spans_pattern(longest: int):
    """A pattern whose group 1 is the longest run at a word start and whose last group is the word:
    found with ``overlapped=True``, it matches once at every word."""
    import regex
    nested = rb"([^ ]+)"
    for _ in range(longest - 1):
        nested = b"(" + nested + rb"(?: [^ ]+)?)"
    return regex.compile(rb"(?<![^ ])" + nested + rb"(?![^ ])")


def feature_buckets(words: bytes, longest: int, buckets: int, pattern) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every run of 1 to ``longest`` words) of a collapsed text."""
    if not words:
        return 0, np.zeros(0, dtype=np.uint32)
    found, total, start, end = [], words.count(b" ") + 1, 0, len(words)
    done = 0
    while start < end:
        stop = words.find(b" ", start + BLOCK_BYTES)
        stop = end if stop < 0 else stop
        here = words.count(b" ", start, stop) + 1
        reach = stop
        for _ in range(longest - 1):                # the last words' runs go on into the next block
            reach = end if reach == end or (at := words.find(b" ", reach + 1)) < 0 else at
        runs = pattern.findall(words, start, reach, overlapped=True)[:here]
        for n in range(1, longest + 1):
            whole = runs[:max(0, min(here, total - done - n + 1))]      # the last n - 1 words start no run of n
            spans = [r[longest - n] for r in whole] if longest > 1 else whole
            found.append(np.fromiter(map(zlib.crc32, spans), dtype=np.uint32, count=len(spans)) % np.uint32(buckets))
        done += here
        start = stop + 1
    return total, np.concatenate(found)


def feature_table(rows: DataFrame, key: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_words, features): every text's buckets, repeats included, as little-endian 16 or 32 bit integers."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = spans_pattern(longest)
        for b in batches:
            n, out = [], []
            for text in b.column(1):
                words, found = feature_buckets(collapse(text.as_py()), longest, buckets, pattern)
                n.append(words)
                out.append(found.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                                             names=["key", "n_words", "features"])

    of = rows.select(F.col(f"`{key}`").alias("key"), F.col("text"))
    return of.mapInArrow(run, f"key {of.schema['key'].dataType.simpleString()}, n_words bigint, features binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: one vector a task, then a sum of at most ``buckets`` groups."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for f in b.column(0):
                total += np.bincount(np.frombuffer(f.as_py(), dtype=kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in features.select("features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the smoothed target share over the smoothed corpus share of each bucket."""
    n, big_s, big_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + n) / ((s + 1) * (big_t + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def weights(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight) of a feature table; a text without features weighs 0."""
    kind = "<u2" if len(gains) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, w = [], []
            for f in b.column(2):
                at = np.frombuffer(f.as_py(), dtype=kind)
                n.append(len(at))
                w.append(sum(int(gains[at[i:i + ROUND]].sum()) for i in range(0, len(at), ROUND)) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(w, pa.int64())],
                                             names=["key", "n_words", "n_features", "weight"])

    of = features.schema["key"].dataType.simpleString()
    return features.mapInArrow(run, f"key {of}, n_words bigint, n_features bigint, weight bigint")


def gumbel_milli(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of sha256 of ``seed:key`` (NULL key: empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def with_positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (a written table) with ``position``, 0, 1, … in ``order`` over the whole table.

    Range partitions are sorted and written, and a row's position is its place in its part plus the
    sizes of the parts before. Equal rows are told apart by their place in the written table, so a
    value that holds a third of the rows is spread too. One row a part goes through the driver.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("_place", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order, F.col("_place")).sortWithinPartitions(*order, F.col("_place")).drop("_place")
    at = F.monotonically_increasing_id()
    dealt = saved(dealt.withColumn("_at", at).withColumns({
        "_part": F.shiftright("_at", 33).cast("int"), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}), "ordered")
    sizes, before, offsets = dealt.groupBy("_part").count().collect(), 0, []
    for part, n in sorted((r["_part"], r["count"]) for r in sizes):
        offsets.append((part, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(offsets, "_part int, _before long"))      # one row a part
    return dealt.join(offsets, "_part").withColumn("position", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is NULL where it is not drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn, highest score first and
    ties to the smaller doc_id (NULL last). NULL and empty texts have no feature, weight 0 and a score
    all the same. Repeated rows each count and each may be drawn; an empty table gives no row, an empty
    target leaves every target count at 0. Columns besides doc_id and text are ignored.

    Texts are scanned once: their buckets (two bytes a feature) are written, then counted and
    weighed from there. Through the driver pass the ``buckets`` counts and one row a part.
    """
    features = saved(feature_table(docs, "doc_id", longest, buckets), "features")
    one = target.select(F.lit(0).alias("key"), "text")
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(feature_table(one, "key", longest, buckets), buckets))
    score = F.col("weight") + gumbel_milli(F.col("key"), seed)
    scored = saved(weights(features, gains).withColumns({"score": score, "_fit": F.col("n_words") >= least_words}), "scores")
    drawn = scored.filter("_fit").count() * percent // 100
    placed = with_positions(scored, [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("key")])
    return placed.select(F.col("key").alias("doc_id"), "n_features", "weight", "score",
                         F.when(F.col("position") < drawn, F.col("position") + 1).alias("rank"))
