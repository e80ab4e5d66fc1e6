"""Best-fit packing planned over a length histogram, not over documents.

The plan needs only how many pieces there are of each length. Each length's pieces then
take the planned slots by their rank within the length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import CACHE_ENTRIES, encoder, id_texts, saved


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first_rank, end_rank, first_sequence, per_sequence, offset).

    The piece of rank r, first_rank <= r < end_rank, goes to sequence
    first_sequence + (r - first_rank) // per_sequence, at
    offset + (r - first_rank) % per_sequence * length. Pieces go longest first, each into the
    open sequence with the least room that still fits. Sequences with equal room are kept as
    ranges, so time and plan size depend on the number of different lengths, not of pieces.
    """
    room: list[int] = []                              # the rooms that occur, ascending
    free: dict[int, list[tuple[int, int]]] = {}       # room -> ranges (first sequence, how many)
    plan, sequences = [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in free:
                free[left] = []
                insort(room, left)
            free[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, end = 0, histogram[length]
        while rank < end:
            at = bisect_left(room, length)
            if at < len(room):
                r = room[at]
                first, n = free[r].pop()
                if not free[r]:
                    del free[r], room[at]
            else:
                r, first = capacity, sequences
                n = -(-(end - rank) // (capacity // length))
                sequences += n
            per = r // length
            here = min(end - rank, n * per)
            used = -(-here // per)
            put(r, first + used, n - used)
            plan.append((length, rank, rank + here, first, per, capacity - r))
            whole, part = divmod(here, per)
            put(r - per * length, first, whole)
            put(r - part * length, first + whole, 1 if part else 0)
            rank += here
    return plan


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, cache: int = CACHE_ENTRIES) -> DataFrame:
    """Each document's ids with ``end_id`` after them, cut into pieces of at most ``capacity``.

    Only the first piece of a longer document may be shorter. ``part`` and ``nth`` are the task
    and the rank among the task's pieces of the same length; they are only meaningful once the
    table is written.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        ids = encoder(vocabulary, True, cache)
        for b in batches:
            rows = []
            for doc, text in id_texts(b):
                raw = ids.of(text) + end
                total, start, piece = len(raw) // 4, 0, 0
                stop = total % capacity or min(total, capacity)
                while start < total:
                    n = stop - start
                    rows.append((doc, piece, start, n, zlib.crc32(raw[4 * start:4 * stop]), part, seen[n]))
                    seen[n] += 1
                    piece, start, stop = piece + 1, stop, stop + capacity
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5]),
                     pa.array(cols[5], pa.int32()), pa.array(cols[6], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, cache: int = CACHE_ENTRIES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    NULL and empty texts are one piece, the end id alone. Repeated rows are packed as often as
    they occur; an empty table gives no row. Columns besides doc_id and text are ignored.
    ``cache``: entries of a worker's cache; fewer save memory where other stages ran before, and take some time.

    Only the histogram (at most ``capacity`` rows) and the plan (bounded by the number of
    lengths) pass through the driver. A rank is the rank within a written task plus that
    task's offset, so a length that holds most of the pieces stays spread over all tasks.
    """
    pieces = saved(token_pieces(docs, vocabulary, capacity, end_id, cache), "pieces")
    by_part = saved(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(plan_slots(histogram, capacity), dtype=np.int64).reshape(-1, 6)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # plan rows are in descending length and, within a length, ascending first_rank
        wide = int(plan[:, 2].max(initial=0)) + 1
        keys = (capacity - plan[:, 0]) * wide + plan[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(zero_copy_only=False), b.column("rank").to_numpy(zero_copy_only=False)
            row = plan[np.searchsorted(keys, (capacity - length) * wide + rank, side="right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(row[:, 3] + nth // row[:, 4]), pa.array(row[:, 5] + nth % row[:, 4] * length)],
                names=[*b.schema.names[:5], "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
