"""Token-id output compressed by Re-Pair grammars, one grammar a shard.

Container: a Parquet table written by Spark's own committer (so it works on any store
and survives lost tasks), one shard a row, in ascending doc_id order:
``part``, ``shard`` (order), ``n_docs``, ``n_tokens``, ``payload`` (the shard file's bytes).

Payload, little-endian:
  magic b"RPID", u32 version, u32 base (symbols below it are token ids), u32 n_rules,
  u32 n_symbols, u32 n_docs,
  n_rules x (u32 left, u32 right); rule i makes symbol base + i from earlier symbols,
  n_rules x u32 expansion length,
  n_docs + 1 x u32 symbol offsets of the documents, n_docs + 1 x u64 token offsets,
  n_symbols x u16 or u32 symbols (u16 where base + n_rules <= 65536), u32 crc32 of all before.
No rule crosses a document's end, so any document is decoded from its own symbols alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import encoder, run_dir, spans

MAGIC, VERSION = b"RPID", 1
SHARD_TOKENS = 1 << 20    # a shard closes with the document that reaches this many tokens
ROUND_RULES = 2048        # rules of one round, the most frequent pairs first
LEAST_COUNT = 8           # a pair that occurs less often makes no rule
HASH_BITS = 18            # of the hash that tells most rare pairs from frequent ones


def peaks(place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the ascending places to replace, by the priority of the pair that starts at each.

    A place gives way to a neighbour of higher priority. Neighbours of equal priority are a run
    of one symbol: every other place of it is taken, from the left.
    """
    beside = np.diff(place) == 1
    before, after = np.zeros_like(weight), np.zeros_like(weight)
    before[1:], after[:-1] = weight[:-1] * beside, weight[1:] * beside
    index = np.arange(len(place))
    run_start = np.maximum.accumulate(np.where(before == weight, 0, index))
    return np.flatnonzero((weight >= before) & (weight >= after) & ((index - run_start) % 2 == 0))


def hashed(pairs: np.ndarray) -> np.ndarray:
    """HASH_BITS bits of each pair, a 32-bit or 64-bit number (multiplicative hashing)."""
    kind, bits = pairs.dtype.type, 8 * pairs.dtype.itemsize
    return (pairs * kind(0x9E3779B97F4A7C15 >> 64 - bits | 1)) >> kind(bits - HASH_BITS)


def repair(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair in rounds: (rules, symbols, is_last).

    Each round counts adjacent pairs within documents, gives the most frequent ones a
    nonterminal each and replaces their occurrences; where two occurrences overlap, the more
    frequent pair wins, and a pair left with too few places waits for the next round. Goes on
    until no pair occurs LEAST_COUNT times. ``ends`` marks each document's last id.

    A pair only becomes rarer, unless it holds a new symbol. So a round counts the places beside
    the symbols of the round before, and of the places counted then those whose pair was frequent
    (or shares its hash with one that was).
    """
    symbols, last = ids.astype(np.intp), np.flatnonzero(ends)
    rules: list[np.ndarray] = []
    n_rules, place = 0, np.flatnonzero(~ends[:-1])
    while len(place):
        top = base + n_rules
        left, right = symbols.take(place), symbols.take(place + 1)
        # pairs of small symbols are sorted as 32-bit numbers, which is much faster
        half = np.uint32(16) if top <= 1 << 16 else np.uint64(32)
        pair = (left.astype(half.dtype) << half) | right.astype(half.dtype)
        found, counts = np.unique(pair, return_counts=True)
        often = np.flatnonzero(counts >= LEAST_COUNT)
        if not len(often):
            break
        often = often[np.lexsort((found[often], -counts[often]))]
        pairs = np.stack([found[often] >> half, found[often] & ((1 << int(half)) - 1)], 1).astype(np.int64)
        frequent = np.zeros(1 << HASH_BITS, dtype=bool)
        frequent[hashed(found[often])] = True
        still = np.flatnonzero(frequent.take(hashed(pair)))
        place, left, right = place.take(still), left.take(still), right.take(still)
        chosen = pairs[:ROUND_RULES]
        # a table over the chosen left and right symbols holds each pair's priority, 0 for none
        lefts, rights = np.unique(chosen[:, 0]), np.unique(chosen[:, 1])
        row, column = np.zeros(top, dtype=np.int32), np.zeros(top, dtype=np.int32)
        row[lefts], column[rights] = np.arange(1, len(lefts) + 1) * (len(rights) + 1), np.arange(1, len(rights) + 1)
        priority = np.zeros((len(lefts) + 1) * (len(rights) + 1), dtype=np.int16)
        priority[row[chosen[:, 0]] + column[chosen[:, 1]]] = np.arange(len(chosen), 0, -1)
        weight = priority.take(row.take(left) + column.take(right))
        hit = np.flatnonzero(weight != 0)
        at, weight = place.take(hit), weight.take(hit)
        taken = peaks(at, weight)
        take, rank = at[taken], len(chosen) - weight[taken].astype(np.int64)
        made = np.bincount(rank, minlength=len(chosen)) >= LEAST_COUNT // 2    # holds for the first pair: a round always shortens
        take, rank = take[made[rank]], rank[made[rank]]
        rules.append(chosen[made].astype(np.uint32))
        symbols[take] = top + (np.cumsum(made) - 1)[rank]
        n_rules += int(made.sum())
        keep, todo = np.ones(len(symbols), dtype=bool), np.zeros(len(symbols), dtype=bool)
        keep[take + 1] = False
        todo[place] = True
        symbols, todo = symbols[keep], todo[keep]
        last = last - np.searchsorted(take + 1, last, "right")      # the pair's end is its right symbol's
        fresh = take - np.arange(len(take))
        todo[fresh] = True
        todo[fresh[fresh > 0] - 1] = True
        todo[last] = False
        place = np.flatnonzero(todo)
    is_last = np.zeros(len(symbols), dtype=bool)
    is_last[last] = True
    return np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), symbols.astype(np.uint32), is_last


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    out = np.ones(len(rules), dtype=np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):     # a rule only uses earlier symbols
        out[i] = (out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1)
    return out


def pack_shard(documents: list[bytes], base: int) -> bytes:
    """Shard bytes of documents given as little-endian uint32 ids (none of them empty)."""
    n = np.array([len(d) // 4 for d in documents], dtype=np.int64)
    ids = np.frombuffer(b"".join(documents), dtype="<u4")
    ends = np.zeros(len(ids), dtype=bool)
    ends[np.cumsum(n) - 1] = True
    rules, symbols, last = repair(ids, ends, base)
    at = np.concatenate([[0], np.flatnonzero(last) + 1])
    body = b"".join([
        MAGIC, struct.pack("<5I", VERSION, base, len(rules), len(symbols), len(n)),
        rules.astype("<u4").tobytes(), expansion_lengths(rules, base).astype("<u4").tobytes(),
        at.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(n)]).astype("<u8").tobytes(),
        symbols.astype("<u2" if base + len(rules) <= 65536 else "<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


class Shard:
    """Random access to a shard: ``shard.ids(i)`` decodes document i only."""

    def __init__(self, payload: bytes):
        version, self.base, n_rules, n_symbols, self.n_docs = struct.unpack_from("<5I", payload, 4)
        if payload[:4] != MAGIC or version != VERSION or struct.unpack("<I", payload[-4:])[0] != zlib.crc32(payload[:-4]):
            raise ValueError("not a whole shard of this format")
        at = 24

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules)
        self.symbol_at, self.token_at = take("<u4", self.n_docs + 1), take("<u8", self.n_docs + 1)
        self.symbols = take("<u2" if self.base + n_rules <= 65536 else "<u4", n_symbols)
        # every rule's expansion, flat; rules of equal depth are filled together
        self._start = (np.cumsum(self.lengths, dtype=np.int64) - self.lengths) if n_rules else np.zeros(0, np.int64)
        self._flat = np.zeros(int(self.lengths.sum()), dtype=np.uint32)
        filled = np.zeros(n_rules, dtype=bool)
        left, right = self.rules[:, 0].astype(np.int64), self.rules[:, 1].astype(np.int64)
        while not filled.all():
            ready = ~filled
            for side in (left, right):
                inner = side >= self.base
                ready &= ~inner | np.where(inner, filled[np.where(inner, side - self.base, 0)], True)
            now = np.flatnonzero(ready)
            n_left = self._lengths_of(left[now])
            self._fill(now, left[now], self._start[now])
            self._fill(now, right[now], self._start[now] + n_left)
            filled[now] = True

    def _lengths_of(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), dtype=np.int64)
        inner = symbols >= self.base
        out[inner] = self.lengths[symbols[inner] - self.base]
        return out

    def _fill(self, rule: np.ndarray, symbols: np.ndarray, to: np.ndarray) -> None:
        if len(rule):
            n = self._lengths_of(symbols)
            self._flat[spans(to, n)] = self.expand(symbols)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        inner = symbols >= self.base
        n = self._lengths_of(symbols)
        out = np.empty(int(n.sum()), dtype=np.uint32)
        at = np.cumsum(n) - n
        out[at[~inner]] = symbols[~inner]
        if inner.any():
            rule = symbols[inner] - self.base
            out[spans(at[inner], n[inner])] = self._flat[spans(self._start[rule], n[inner])]
        return out

    def ids(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.symbol_at[i]:self.symbol_at[i + 1]])

    def all_ids(self) -> np.ndarray:
        return self.expand(self.symbols)


def write_ids(docs: DataFrame, vocabulary: str, path: str, end_id: int = 1, spaced: bool = False,
              shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every whole text, append ``end_id`` and write the shards at ``path`` in doc_id order.

    NULL doc_ids come first; rows that share a doc_id follow each other in the order of their
    text. NULL and empty texts have the end id only. Shards are cut by tokens, so a task holds
    one shard at a time.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part, shard = encoder(vocabulary, spaced), TaskContext.get().partitionId(), 0
        base = max(ids.base, end_id + 1)
        kept, names, size = [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(kept)], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([names], pa.list_(kind)), pa.array([pack_shard(kept, base)], pa.binary())],
                names=["part", "shard", "n_docs", "n_tokens", "doc_ids", "payload"])

        for b in batches:
            kind = b.schema.field(0).type
            for doc, raw in zip(b.column(0).to_pylist(), ids.of_texts(b.column(1))):
                raw += end
                kept.append(raw)
                names.append(doc)
                size += len(raw) // 4
                if size >= shard_tokens:
                    yield close()
                    kept, names, size, shard = [], [], 0, shard + 1
        if kept:
            yield close()

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    (docs.select("doc_id", "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, f"part int, shard int, n_docs bigint, n_tokens bigint, doc_ids array<{id_kind}>, payload binary")
     .write.parquet(path))


def read_ids(shards: DataFrame) -> DataFrame:
    """Decode written shards: (doc_id, start, n_tokens, ids_crc32), start counted over all shards."""
    by_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # one row a written part
    parts = by_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("shard_start")) \
        .join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("shard_start"))
    id_kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard(b.column(2)[i].as_py())
                raw, at = shard.all_ids().astype("<u4").tobytes(), shard.token_at.astype(np.int64)
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(i, 1).flatten(), pa.array(at[:-1] + b.column(0)[i].as_py()), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "shard", "doc_ids", "payload").join(starts, ["part", "shard"]) \
        .select("shard_start", "doc_ids", "payload") \
        .mapInArrow(run, f"doc_id {id_kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_and_read(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write all ids in the shard format into the shared folder and read the files back."""
    spark = docs.sparkSession
    path = run_dir(spark, "token-ids")
    write_ids(docs, vocabulary, path, end_id)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read_ids(spark.read.schema(f"part int, shard int, n_docs bigint, n_tokens bigint, doc_ids array<{kind}>, payload binary").parquet(path))
