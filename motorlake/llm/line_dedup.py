"""Line dedup by pairwise alignment: hashes of shared runs of lines find overlapping documents,
patience diff and exact common runs align them, and common blocks go from the later document."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import free_name, mix64, saved

ANCHOR_WORDS = 5       # a shared line of so many words finds a partner alone, shorter ones in runs
BLOCK_WORDS = 10       # a common block of fewer words stays
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"   # scripts without blanks between words
WORD_POINTS = 2        # code points of these that count as a word


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, already ascending in the first place, that ascends in the second too."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        tails[k:k + 1] = [b]
        at[k:k + 1] = [i]
        back.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff of two hash sequences: aligned (index in a, index in b).

    Equal heads and tails align first; in between, lines that occur once on both sides are
    aligned along their longest increasing run, and the gaps between those are treated alike.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        where: dict[int, int] = {}
        for i in range(a0, a1):
            where[a[i]] = -1 if a[i] in where else i
        seen: dict[int, int] = {}
        for j in range(b0, b1):
            seen[b[j]] = -1 if b[j] in seen else j
        once = [(where[h], j) for h, j in seen.items() if j >= 0 and where.get(h, -1) >= 0]
        anchors = increasing(sorted(once))
        if not anchors:
            continue
        for (x0, y0), (x1, y1) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            todo.append((x0 + 1, x1, y0 + 1, y1))
        out += anchors
    return sorted(out)


def least_runs(lines: list[int], words: list[int], least_words: int) -> set[tuple[int, int]]:
    """(start, end) of the shortest runs of ``least_words`` words from each line on and up to each line.

    ``lines`` are ascending line numbers; a run does not go over a missing one. A line is in a common
    run of two documents that has ``least_words`` or more if and only if it is in one of these that both have.
    """
    out: set[tuple[int, int]] = set()
    opened = start = total = 0
    for e, w in enumerate(words):
        if e and lines[e] != lines[e - 1] + 1:
            opened, start, total = e, e, 0
        total += w
        while opened <= e and total >= least_words:
            out.add((opened, e + 1))
            total -= words[opened]
            opened += 1
        if opened > start:
            out.add((opened - 1, e + 1))
    return out


def repeated_lines(a: list[tuple[int, int, int]], b: list[tuple[int, int, int]], least_words: int) -> list[tuple[int, int]]:
    """Lines of the later document ``b`` in common blocks of ``least_words`` words or more.

    Lines are (line number, hash, words); a block is a run of equal lines that follow each other in both.
    Patience diff finds those that stand in one order; where lines are left, all runs that ``a`` has
    anywhere are looked up, so repeated and moved blocks are found too.
    """
    aligned = patience([x[1] for x in a], [x[1] for x in b])
    out: set[tuple[int, int]] = set()
    block: list[tuple[int, int]] = []
    words, before = 0, (-2, -2)
    for i, j in [*aligned, (-1, -1)]:
        here = (a[i][0], b[j][0]) if i >= 0 else (-9, -9)
        if (here[0] - before[0], here[1] - before[1]) != (1, 1):
            if words >= least_words:
                out.update(block)
            block, words = [], 0
        if i >= 0:
            block.append((b[j][0], b[j][1]))
            words += b[j][2]
        before = here
    if len(out) < len(b):
        have, own = ([x[1] for x in s] for s in (a, b))
        runs = {tuple(have[i:j]) for i, j in least_runs([x[0] for x in a], [x[2] for x in a], least_words)}
        for i, j in least_runs([x[0] for x in b], [x[2] for x in b], least_words):
            if tuple(own[i:j]) in runs:
                out.update(x[:2] for x in b[i:j])
    return sorted(out)


def _line_array(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(line, r"\s+", " ")))


def line_words(line: Column) -> Column:
    """Words between blanks; in scripts that set none, every ``WORD_POINTS`` code points are a word, the last one may have fewer."""
    def spaced(x: Column) -> Column:
        return F.size(F.split(F.trim(F.regexp_replace(x, r"\s+", " ")), " "))

    rest = F.trim(F.regexp_replace(F.regexp_replace(line, UNSPACED, " "), r"\s+", " "))
    points = F.length(line) - F.length(F.regexp_replace(line, UNSPACED, ""))
    both = F.ceil(points / WORD_POINTS).cast("int") + F.when(rest.rlike(r"\w"), spaced(rest)).otherwise(0)
    return F.when(F.octet_length(line) == F.length(line), spaced(line)).when(line.rlike(UNSPACED), both).otherwise(spaced(line))


def line_sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, line, hash, words), one row a document: arrays over its lines with a word, numbered among such lines.

    Where rows repeat a doc_id, other texts follow with numbers 2^32 apart, so no run goes from one to the next.
    """
    worded = F.filter(_line_array(F.col("text")), lambda x: x.rlike(r"\S"))
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", worded.alias("s")) \
        .select("doc_id", F.struct(F.transform("s", line_hash).alias("hash"), F.transform("s", line_words).alias("words")).alias("text")) \
        .groupBy("doc_id").agg(F.collect_set("text").alias("texts"))
    numbers = F.transform("texts", lambda t, v: F.transform(t["hash"], lambda _, i: v.cast("bigint") * 2 ** 32 + i))
    return texts.select("doc_id", F.flatten(numbers).alias("line"), F.flatten(F.col("texts.hash")).alias("hash"), F.flatten(F.col("texts.words")).alias("words"))


def run_table(sequences: DataFrame, anchor_words: int, block_words: int) -> DataFrame:
    """(doc_id, run, at, n, anchor): runs of lines as hashes, once each place.

    They are those of ``least_runs`` and the lines of ``anchor_words``. Runs that find partners are marked: these
    lines, and runs of lines of which none is a block by itself.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, at, end, anchor, first = [], [], [], [], 0
            for d, (lines, words) in enumerate(zip(b.column("line").to_pylist(), b.column("words").to_pylist())):
                found = least_runs(lines, words, block_words) | {(i, i + 1) for i, w in enumerate(words) if w >= anchor_words}
                anchor += [j == i + 1 or max(words[i:j]) < block_words for i, j in found]
                owner += [d] * len(found)
                at += [first + i for i, _ in found]
                end += [first + j for _, j in found]
                first += len(lines)
            hashes = b.column("hash").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            start, n, doc = np.array(at, np.int64), np.array(end, np.int64) - np.array(at, np.int64), np.array(owner, np.int64)
            run = np.zeros(len(start), np.uint64)
            with np.errstate(over="ignore"):
                for i in range(int(n.max()) if len(n) else 0):
                    more = n > i
                    run[more] = mix64(run[more] * np.uint64(0x9E3779B97F4A7C15) + hashes[start[more] + i])
            begin = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(b.column("line")).to_numpy(zero_copy_only=False))])[:-1].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc)), pa.array(run.view(np.int64)), pa.array((start - begin[doc]).astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array(anchor, pa.bool_())], names=["doc_id", "run", "at", "n", "anchor"])

    kind = sequences.schema["doc_id"].dataType.simpleString()
    return sequences.mapInArrow(cut, f"doc_id {kind}, run bigint, at int, n int, anchor boolean")


def deletions(docs: DataFrame, anchor_words: int = ANCHOR_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, gone): keys of the lines to delete from each document, see ``deduplicate_lines``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sequences = saved(line_sequences(docs), "lines")
    runs = saved(run_table(sequences, anchor_words, block_words), "runs")
    holders = saved(runs.groupBy("run").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("run", "first"), "shared-runs")
    shared = runs.join(holders, "run").groupBy("doc_id").agg(
        F.collect_set(F.struct("at", "n")).alias("spans"), F.collect_set(F.when(F.expr("anchor AND first < doc_id"), F.col("first"))).alias("partners"))

    def trim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, partners, spans, *lists in zip(b["doc_id"], b["partners"], b["spans"], b["line"], b["hash"], b["words"]):
                at = sorted({i for s in spans for i in range(s["at"], s["at"] + s["n"])})
                rows.append((doc, partners, *(x[at] for x in lists)))
            yield pd.DataFrame(rows, columns=["doc_id", "partners", "line", "hash", "words"])

    lists = "line array<bigint>, hash array<bigint>, words array<int>"
    kept = saved(sequences.join(saved(shared, "overlaps"), "doc_id").select("doc_id", "partners", "spans", "line", "hash", "words")
                 .mapInPandas(trim, f"doc_id {kind}, partners array<{kind}>, {lists}"), "line-sequences")
    later = kept.select("doc_id", F.explode("partners").alias("first"), F.struct("line", "hash", "words").alias("later"))
    earlier = kept.select(F.col("doc_id").alias("first"), F.struct("line", "hash", "words").alias("earlier"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, a, c in zip(b["doc_id"], b["earlier"], b["later"]):
                a, c = (list(zip(s["line"].tolist(), s["hash"].tolist(), s["words"].tolist())) for s in (a, c))
                rows += [(doc, line & 0xFFFFFFFF, h) for line, h in repeated_lines(a, c, block_words)]
            yield pd.DataFrame(rows, columns=["doc_id", "line", "hash"])

    found = later.join(earlier, "first").select("doc_id", "earlier", "later").mapInPandas(align, f"doc_id {kind}, line int, hash bigint")
    return saved(found.groupBy("doc_id").agg(F.collect_set(F.xxhash64("line", "hash")).alias("gone")), "deletions")


def deduplicate_lines(docs: DataFrame, anchor_words: int = ANCHOR_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the aligned common blocks cut from the later documents, plus ``n_lines`` (lines
    with a word) and ``n_removed``.

    Lines are ``\\n``-split and compared with their white space normalised. What is left of a
    document has no run of ``block_words`` or more words (see ``line_words``) that any document of a lower doc_id has too.
    Every line of ``anchor_words``, and every shortest run of ``block_words`` of lines that are no block
    alone, pairs each later holder with its first one (least doc_id), so a run that is everywhere costs
    one pair a document as a rare one does, and none is capped or skipped. A pair is aligned by patience
    diff over the lines in shared runs (no other can be in a block), and blocks that stand in another
    order or several times are then looked up; a block goes whole. A line next to a deleted block, itself
    less than a block, goes only if one of the document's partners has both together.
    The first holder keeps its text. Lines without a word go only where a text changes
    and stand at its start or end or next to a deleted line's gap: a changed text is its kept lines, joined.

    NULL and empty texts pass unchanged with no lines. Rows without doc_id pass unchanged and are
    no one's partner. Rows that repeat a doc_id count as one document: equal rows change alike, rows
    with other texts lose the lines found in them. All columns are kept; a clashing
    ``n_lines`` or ``n_removed`` is replaced.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    doc, gone, lines, left = (free_name(docs, c) for c in ("deleted_of", "deleted", "all_lines", "kept_lines"))
    deleted = deletions(docs, anchor_words, block_words).withColumnsRenamed({"doc_id": doc, "gone": gone})
    joined = docs.join(deleted, docs["doc_id"] == F.col(doc), "left")
    worded = F.filter(_line_array(F.col("text")), lambda x: x.rlike(r"\S"))
    kept = F.filter(worded, lambda x, i: ~F.array_contains(gone, F.xxhash64(i, line_hash(x))))
    out = joined.withColumn(lines, F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(worded)) \
        .withColumn(left, F.when(F.col(gone).isNull() | F.col("text").isNull(), F.col(lines)).otherwise(kept)) \
        .withColumn("n_lines", F.size(lines).cast("bigint")) \
        .withColumn("n_removed", (F.size(lines) - F.size(left)).cast("bigint")) \
        .withColumn("text", F.when(F.col("n_removed") > 0, F.array_join(left, "\n")).otherwise(F.col("text")))
    return out.select(*[F.col(f"`{c}`") for c in own], "n_lines", "n_removed")
