"""Token counts by heap-and-linked-list byte-pair merging; no ids are produced."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from motorlake.llm.common import CACHED_CHARS, PRE_TOKENS, STAGE_CACHE, byte_symbols

COUNT_CACHE = 1_000_000


class MergeCounter(dict):
    """Chunk between blanks (its blank included) -> number of tokens.

    Built from a tokenizers file of kind byte-level BPE. The ranks of the merges are keyed by
    the pair of symbol numbers; every merge result is a symbol number as well, so merging
    works on small integers. A count is (initial symbols) - (merges made).
    """

    def __init__(self, path: str):
        import regex
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self._merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self._bytes = [vocab[s] for s in byte_symbols()]
        self._pre = regex.compile(PRE_TOKENS).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self._special = special
        self._split = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def merged(self, piece: str) -> int:
        """Tokens of one pre-token: pop the lowest-rank adjacent pair until none is left."""
        symbols = [self._bytes[b] for b in piece.encode("utf-8")]
        n = len(symbols)
        if n < 2:
            return n
        rule = self._merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (r := rule((symbols[i], symbols[i + 1]))) is not None:
                heap.append((r[0], i, symbols[i], symbols[i + 1], r[1]))
        heapify(heap)
        merges = 0
        while heap:
            _, i, left, right, both = heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = both, -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rule((both, symbols[k]))) is not None:
                    heappush(heap, (r[0], i, both, symbols[k], r[1]))
            h = before[i]
            if h >= 0 and (r := rule((symbols[h], both))) is not None:
                heappush(heap, (r[0], h, symbols[h], both, r[1]))
        return n - merges

    def _plain(self, text: str) -> int:
        return sum(map(self.merged, self._pre(text)))

    def __missing__(self, chunk: str) -> int:
        if not chunk or chunk[0].isspace():
            raise ValueError
        n = self._plain(" " + chunk)
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= COUNT_CACHE:
                self.clear()
            self[chunk] = n
        return n

    def _between(self, text: str) -> int:
        """Tokens of a text without special strings, chunk by chunk. A blank followed by
        anything but white space always starts a pre-token; where a chunk is empty or starts
        with white space the text is taken whole."""
        if not text:
            return 0
        head, *rest = text.split(" ")
        try:
            return self._plain(head) + sum(map(self.__getitem__, rest))
        except ValueError:
            return self._plain(text)

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        if self._split is None or not any(s in text for s in self._special):
            return self._between(text)
        return len(self._split.findall(text)) + sum(map(self._between, self._split.split(text)))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    ``vocabulary``: path of a byte-level BPE file of the tokenizers library, readable on the
    executors. NULL and empty texts have 0 bytes and 0 tokens. Special strings inside a text
    count one token each, as the library's default takes them. Other columns are ignored, so
    clashing names do no harm; repeated rows and ids each give their own row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = STAGE_CACHE.get(("counts", vocabulary), lambda: MergeCounter(vocabulary)).of
        for b in batches:
            texts = b.column(1).to_pylist()
            tokens = [of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode("utf-8")) if t else 0 for t in texts], pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
