"""Near-duplicate classes by ProbMinHash, banding and exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import NEAR, SHINGLE_WORDS, mix64, saved, shingle_hashes, word_batches

REGISTERS, BAND_WIDTH, BANDS = 256, 8, 32     # a pair at 0.8 shares a band with probability 0.997, one at 0.5 with 0.12
ROUNDING = 1e-9                               # a similarity this close below the threshold is equal to it
PLANES = 4                                    # bits kept of a register to estimate similarities
HUBS = 64                     # members of a bucket compared with all of it in one later round


def prob_minhash(elements: np.ndarray, weights: np.ndarray, text: np.ndarray, n_texts: int,
                 registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash of weighted sets: for each text the winning element of each register.

    Every element is a Poisson process of rate ``weight``: its arrivals are exponentially spaced
    and each arrival hits one uniform register; a register keeps the element that came first. The
    share of equal registers of two sets estimates their probability Jaccard. An element is
    dropped as soon as its next arrival comes later than the last of its text's registers, which
    no later arrival can improve. All texts advance together, one arrival an element a round.
    """
    first = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, dtype=np.uint64)
    state, at, element, weight, owner = elements.copy(), np.zeros(len(elements)), elements, weights, text
    with np.errstate(over="ignore"):
        while len(element):
            state = mix64(state + np.uint64(0x9E3779B97F4A7C15))
            at = at - np.log(((state >> np.uint64(24)).astype(np.float64) + 1.0) * 2.0 ** -40) / weight
            slot = owner * registers + (((state & np.uint64(0xFFFFFF)) * np.uint64(registers)) >> np.uint64(24)).astype(np.int64)
            np.minimum.at(first, slot, at)
            won = first[slot] == at
            winner[slot[won]] = element[won]
            last = first.reshape(n_texts, registers).max(axis=1)
            on = at < last[owner]
            state, at, element, weight, owner = state[on], at[on], element[on], weight[on], owner[on]
    return winner.reshape(n_texts, registers)


def counted_sets(words: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles, how often each occurs, owning text) of a batch of texts, by text and shingle."""
    hashes, offsets = shingle_hashes(words, k)
    parts = [np.unique(hashes[s:e], return_counts=True) for s, e in zip(offsets[:-1], offsets[1:])]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([u for u, _ in parts]), np.concatenate([c for _, c in parts]), np.repeat(np.arange(len(words)), [len(u) for u, _ in parts])


def weights(counts: np.ndarray) -> np.ndarray:
    """A shingle's weight in its text: 1, and the logarithm of how often it occurs."""
    return 1.0 + np.log(counts)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets: distinct elements ``a`` with weights ``x``, ``b`` with ``y``.

    It is the sum over common elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i). With the
    common elements in order of x / y, the first term is the greater one for those after i (and what only
    ``a`` has), the second one for those before i (and what only ``b`` has), so two running sums give all.
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(x[i] / y[j], kind="stable")
    xi, yj = x[i][order], y[j][order]
    from_here = x.sum() - np.cumsum(xi) + xi
    before = y.sum() - yj.sum() + np.cumsum(yj) - yj
    return float((1.0 / (from_here / xi + before / yj)).sum())


def band_members(registers: int, width: int, bands: int) -> np.ndarray:
    """The registers of each band: neighbours first, then, for more bands, registers a stride apart."""
    near = np.arange(registers // width * width).reshape(-1, width)
    return np.concatenate([near, near.ravel().reshape(width, -1).T])[:bands]


def sketches(docs: DataFrame, k: int = SHINGLE_WORDS, registers: int = REGISTERS, width: int = BAND_WIDTH, bands: int = BANDS) -> DataFrame:
    """(doc_id, digest, bits, bands): the digest names the text's word sequence (NULL without a
    word), bits has PLANES bits of each register's winner, plane by plane."""
    member = band_members(registers, width, bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = (np.arange(width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        salt = np.arange(len(member), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for b in batches:
            for ids, words in word_batches(b.column(0).to_pylist(), b.column(1).to_pylist()):
                element, count, owner = counted_sets(words, k)
                with np.errstate(over="ignore"):
                    sig = mix64(prob_minhash(element, weights(count), owner, len(words), registers))
                    key = mix64((sig[:, member] * odd).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                planes = [np.packbits((sig >> np.uint64(i) & np.uint64(1)).astype(np.uint8), axis=1).view(">i8") for i in range(PLANES)]
                bits = np.concatenate(planes, axis=1).astype(np.int64)
                digest = [hashlib.blake2b(w, digest_size=16).digest() if w else None for w in words]
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, b.schema.field(0).type), pa.array(digest, pa.binary()), lists(bits), lists(key)],
                    names=["doc_id", "digest", "bits", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, digest binary, bits array<bigint>, bands array<bigint>")


def shingle_sets(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(digest, shingles, counts) of the rows whose text still has the digest in column ``digest``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, words in word_batches(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = [(d, w) for d, w in zip(ids, words) if hashlib.blake2b(w, digest_size=16).digest() == d]
                element, count, owner = counted_sets([w for _, w in own], k)
                at = pa.array(np.searchsorted(owner, np.arange(len(own) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in own], pa.binary()), pa.ListArray.from_arrays(at, pa.array(element.view(np.int64))),
                     pa.ListArray.from_arrays(at, pa.array(count, pa.int32()))], names=["digest", "shingles", "counts"])

    return docs.select("digest", "text").mapInArrow(run, "digest binary, shingles array<bigint>, counts array<int>")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected (a, b): (node, label), label the least node.

    Alternates large-star and small-star steps until nothing changes; each step works on the
    edges only, is written to the shared folder and keeps no node's neighbours together.
    """
    def low(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = now.union(now.select("v", "u"))
        m = saved(low(both).select("u", F.least("m", "u").alias("m")), "least")
        large = saved(both.filter("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        m = saved(low(large), "least")
        joined = large.join(m, "u")
        now = saved(joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(joined.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        # done when all are stars: no centre hangs on another node, and no node on two centres
        if now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() and now.groupBy("u").count().filter("count > 1").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def similar_pairs(pairs: DataFrame, sets: DataFrame, near: float) -> DataFrame:
    """The (a, b) pairs of digests whose weighted shingles have an exact probability Jaccard of ``near`` or more."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("digest").alias(name), F.col("shingles").alias(f"s{name}"), F.col("counts").alias(f"c{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns[2:]]

            def at(row: int, column: int) -> np.ndarray:
                offsets, values = flat[column]
                return values[offsets[row]:offsets[row + 1]]

            linked = [probability_jaccard(at(i, 0), weights(at(i, 1)), at(i, 2), weights(at(i, 3))) >= near - ROUNDING for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "ca", "sb", "cb").mapInArrow(run, "a binary, b binary")


def may_be_near(a: Column, b: Column, near: float, registers: int) -> Column:
    """Whether the sketches with these bits can belong to texts at ``near`` or more.

    No more registers may differ in their bits than at ``near`` plus 3.3 standard deviations
    (a pair at ``near`` is passed over with probability 5e-4).
    """
    share = (1 - near) * (1 - 0.5 ** PLANES)
    most = int(registers * share + 3.3 * math.sqrt(registers * share * (1 - share)))
    longs, other = registers // 64, F.lit(0)
    for i in range(longs):
        differ = F.lit(0).cast("bigint")
        for j in range(i, PLANES * longs, longs):
            differ = differ.bitwiseOR(F.get(a, F.lit(j)).bitwiseXOR(F.get(b, F.lit(j))))
        other = other + F.bit_count(differ)
    return other <= most


def near_duplicate_classes(docs: DataFrame, near: float = NEAR, k: int = SHINGLE_WORDS, registers: int = REGISTERS,
                           width: int = BAND_WIDTH, bands: int = BANDS, hubs: int = HUBS) -> DataFrame:
    """(doc_id, class_id), one row a document; class_id is the least doc_id of its class.

    Words are ``\\w+`` runs in lower case. Texts with the same words are one node. Nodes that share
    a band are candidates where their sketches allow it (``may_be_near``); two are linked where the exact probability Jaccard of their k-word
    shingles, weighted by ``weights``, is ``near`` or more, and classes are the connected components of the links. A text of
    fewer than k words only equals the same words; a NULL, empty or wordless text is a class
    by itself. Rows that repeat a text, with the same or another id, share its class; a NULL
    id takes its class's least id, which is NULL if no member has one. Other columns are ignored.

    No bucket is expanded into pairs. First every member is compared with its bucket's
    centre, the member whose buckets are largest. Buckets that still hold several classes go on:
    in each round up to ``hubs`` further members outside the bucket's largest class (four times as
    many each round) are compared with the members of other classes, until all of them have
    been, so no link is lost whatever a bucket's size. Two members of several common buckets
    meet in the first of these only; sketches are joined to pairs, not carried by every member.
    """
    sketch = saved(sketches(docs, k, registers, width, bands), "sketches")
    nodes = saved(sketch.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "nodes")
    own = sketch.join(nodes, (sketch["digest"] == nodes["digest"]) & sketch["doc_id"].eqNullSafe(nodes["doc_id"]), "left_semi")
    marks = saved(own.select("digest", "bits", "bands").dropDuplicates(["digest"]), "marks")
    filed = saved(marks.select("digest", F.posexplode("bands").alias("at", "band")), "filed")

    buckets = saved(filed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    member = saved(filed.join(buckets, "band"), "members")
    if member.isEmpty():
        return sketch.select("doc_id", F.col("doc_id").alias("class_id"))
    score = saved(member.groupBy("digest").agg(F.sum("n").alias("score")), "scores")
    member = saved(member.join(score, "digest").select("band", "at", "digest", "score"), "members")
    centre = saved(member.groupBy("band").agg(F.max(F.struct("score", "digest")).alias("top")).select("band", F.col("top.digest").alias("centre")), "centres")

    wanted = score.select("digest").join(nodes, "digest").select(F.col("doc_id").alias("wanted_id"), "digest")
    sets = saved(shingle_sets(docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")))), "shingles")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def sketched(pairs: DataFrame) -> DataFrame:
        both = pairs.join(marks.select(F.col("digest").alias("a"), F.col("bits").alias("a_bits")), "a") \
            .join(marks.select(F.col("digest").alias("b"), F.col("bits").alias("b_bits")), "b")
        return both.filter(may_be_near(F.col("a_bits"), F.col("b_bits"), near, registers)).select("a", "b")

    met = ordered(member.join(centre, "band").filter("digest <> centre").select(F.col("digest").alias("a"), F.col("centre").alias("b")))
    tested = saved(sketched(met), "pairs")
    links = saved(similar_pairs(tested, sets, near), "links")
    labels = components(links)
    done = centre.select("band", F.col("centre").alias("digest"))
    while True:
        at = member.join(labels, member["digest"] == labels["node"], "left").select(
            "band", "at", "digest", "score", F.coalesce("label", "digest").alias("label"))
        sizes = at.groupBy("band", "label").agg(F.count("*").alias("n"))
        mixed = saved(sizes.groupBy("band").agg(F.count("*").alias("classes"), F.max(F.struct("n", "label")).alias("top"))
                      .filter("classes > 1").select("band", F.col("top.label").alias("largest")), "mixed")
        live = saved(at.join(mixed, "band").join(marks, "digest"), "live")
        rank = F.row_number().over(Window.partitionBy("band").orderBy(F.desc("score"), "digest"))
        first = saved(live.filter("label <> largest").join(done, ["band", "digest"], "left_anti")
                      .withColumn("rank", rank).filter(F.col("rank") <= hubs + 1), "hubs")
        hub = first.filter(F.col("rank") <= hubs).select("band", "digest", F.col("label").alias("hub_label"), F.col("bits").alias("hub_bits"), F.col("bands").alias("hub_bands"))
        met_before = F.exists(F.slice(F.zip_with("bands", "hub_bands", lambda x, y: x == y), 1, F.col("at")), lambda x: x)
        pairs = ordered(live.select("band", "at", F.col("digest").alias("a"), "label", "bits", "bands").join(hub.withColumnRenamed("digest", "b"), "band")
                        .filter(F.expr("label <> hub_label") & may_be_near(F.col("bits"), F.col("hub_bits"), near, registers) & ~met_before).select("a", "b"))
        pairs = saved(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = saved(similar_pairs(pairs, sets, near), "links")
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)
        if first.filter(F.col("rank") > hubs).isEmpty():
            break       # every member outside a bucket's largest class has been a hub: all of its mixed pairs are tested
        tested, done = tested.union(pairs), done.union(hub.select("band", "digest"))
        hubs *= 4       # few buckets go on; those that do get through in a few rounds

    named = saved(nodes.join(labels, nodes["digest"] == labels["node"], "left").select("digest", "doc_id", F.coalesce("label", "digest").alias("label")), "named")
    least = saved(named.groupBy("label").agg(F.min("doc_id").alias("class_id")), "class-ids")
    classes = saved(named.join(least, "label").select("digest", "class_id"), "classes")
    return sketch.join(classes, "digest", "left").select("doc_id", F.coalesce("class_id", F.when(F.col("digest").isNull(), F.col("doc_id"))).alias("class_id"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: the least doc_id of each class stays, all columns kept.

    Rows that repeat a kept id leave one row. Rows without an id take no part in the classes:
    they stay, one for each text.
    """
    named = docs.filter("doc_id IS NOT NULL")
    kept = saved(near_duplicate_classes(named, **options).filter("doc_id = class_id").select(F.col("doc_id").alias("kept_id")).distinct(), "kept-ids")
    one = named.join(kept, named["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return one.union(docs.filter("doc_id IS NULL").dropDuplicates(["text"]))
