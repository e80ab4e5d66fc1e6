"""Benchmark decontamination: short test items found inside long documents.

A MinHash search for containment, partitioned by size: items are grouped by their number of
shingles into classes (u/2, u], and for each class a document is seen as windows of 2u
shingles, u apart, so an item's passage lies whole in a window whose size suits it and
the Jaccard of window and item stays around a quarter or more, however long the
document. Windows that share a MinHash value with an item make (document, item) a
candidate; exact containment over the whole document decides. Items of few distinct shingles have
no classes: every shingle of a document is looked up among theirs, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import NEAR, SHINGLE_WORDS, shingle_hashes, word_batches, word_hasher

HASHES = 48                                    # a window at Jaccard 0.19 is missed with probability 4e-5
FEW = 8                                        # items of at most so many distinct shingles are looked up by all of them
BLOCK_ITEMS, BLOCK_CHARS = 4096, 4_000_000     # items searched for in one pass, the bound on what is broadcast


class ItemIndex:
    """MinHash signatures of a block of items by size class, with their exact shingle sets."""

    def __init__(self, items: list[tuple], k: int, n_hashes: int):
        rng = np.random.default_rng(20240229)
        self.k = k
        self.xor = rng.integers(1, 2 ** 63, n_hashes, dtype=np.uint64)
        self.odd = rng.integers(1, 2 ** 63, n_hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        words = [word_hasher().of(t) for _, t in items]
        long = [i for i, w in enumerate(words) if len(w) // 8 >= k]     # shorter items have no shingle
        self.ids = [items[i][0] for i in long]
        hashes, offsets = shingle_hashes([words[i] for i in long], k)
        self.sets = [np.unique(hashes[s:e]) for s, e in zip(offsets[:-1], offsets[1:])]
        size = np.array([len(x) for x in self.sets], dtype=np.int64)
        unit = 2 ** np.ceil(np.log2(np.maximum(np.diff(offsets), 1))).astype(np.int64)
        direct = (size <= FEW) | (2 * size <= unit)      # the latter repeat so much that they would be a small part of their window
        few = np.flatnonzero(direct)
        flat = np.concatenate([np.zeros(0, np.uint64), *(self.sets[i] for i in few)])
        order = np.argsort(flat)
        self.few, self.few_items = flat[order], np.repeat(few, size[few])[order]
        self.classes = []
        for u in np.unique(unit[~direct]):
            own = np.flatnonzero((unit == u) & ~direct)
            with np.errstate(over="ignore"):
                values = np.stack([np.array([((self.sets[i] ^ x) * o).min() for i in own]) for x, o in zip(self.xor, self.odd)])
            order = np.argsort(values, axis=1)
            self.classes.append((int(u), np.take_along_axis(values, order, 1), own[order]))

    def candidates(self, hashes: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) where a window and the item share a MinHash value, or the text any shingle of an item of few."""
        found: set[tuple[int, int]] = set()
        if len(self.few):
            lo = np.searchsorted(self.few, hashes)
            at = np.flatnonzero(self.few[np.minimum(lo, len(self.few) - 1)] == hashes)
            hi, owner = np.searchsorted(self.few, hashes[at], "right"), np.searchsorted(offsets, at, "right") - 1
            for t, s, e in zip(owner.tolist(), lo[at].tolist(), hi.tolist()):
                found.update((t, int(i)) for i in self.few_items[s:e])
        n = np.diff(offsets)
        for u, values, items in self.classes:
            blocks = -(-n // u)
            text = np.repeat(np.arange(len(n)), blocks)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            start = offsets[:-1][text] + nth * u
            if not len(start):
                continue
            pair = np.flatnonzero(text[1:] == text[:-1])         # a block and the next of the same text
            for j in range(len(values)):
                with np.errstate(over="ignore"):
                    low = np.minimum.reduceat((hashes ^ self.xor[j]) * self.odd[j], start)
                window = low.copy()
                window[pair] = np.minimum(low[pair], low[pair + 1])
                lo, hi = np.searchsorted(values[j], window, "left"), np.searchsorted(values[j], window, "right")
                for w in np.flatnonzero(hi > lo):
                    found.update((int(text[w]), int(i)) for i in items[j][lo[w]:hi[w]])
        return found

    def contained(self, hashes: np.ndarray, offsets: np.ndarray, near: float) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of the candidates that are contained."""
        out, at, have = [], -1, None
        for text, item in sorted(self.candidates(hashes, offsets)):
            if text != at:
                at, have = text, np.unique(hashes[offsets[text]:offsets[text + 1]])
            shared = int(np.isin(self.sets[item], have, assume_unique=True).sum())
            if shared >= near * len(self.sets[item]):
                out.append((text, item, shared))
        return out


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks of at most BLOCK_ITEMS items and BLOCK_CHARS characters (or one item)."""
    block, chars = [], 0
    for r in benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct().toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or chars + len(r.text) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((r.item_id, r.text))
        chars += len(r.text)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, near: float = NEAR, k: int = SHINGLE_WORDS, n_hashes: int = HASHES) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item): documents that hold ``near`` or more of an item's shingles.

    Shingles are k ``\\w+`` words in lower case, distinct ones count. Items of fewer than k words,
    and NULL or empty texts on either side, match nothing. Repeated items or documents give
    their rows again, once each; NULL ids are carried. Other columns are ignored. Items are
    searched in blocks of a fixed size, each in one pass over all documents, without a shuffle.
    """
    kinds = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_shared bigint, n_item bigint"

    def search(block: list[tuple]) -> DataFrame:
        index = ItemIndex(block, k, n_hashes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            item_kind = pa.array(index.ids).type if index.ids else pa.int64()
            for b in batches:
                for ids, words in word_batches(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    words = [w if len(w) // 8 >= k else b"" for w in words]
                    hits = index.contained(*shingle_hashes(words, k), near)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[t] for t, _, _ in hits], b.schema.field(0).type), pa.array([index.ids[i] for _, i, _ in hits], item_kind),
                         pa.array([s for _, _, s in hits], pa.int64()), pa.array([len(index.sets[i]) for _, i, _ in hits], pa.int64())],
                        names=["doc_id", "item_id", "n_shared", "n_item"])

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark):
        out = out.union(search(block))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, all columns kept.

    Rows without an id are judged together, as one id.
    """
    bad = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
