"""Shared helpers: tables, folds, intermediate tables and cached text chunking."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import json
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.session import run_dir

SHINGLE_WORDS = 5
NEAR = 0.8
HELD_OUT_FOLD = 2
FOLDS = 4
CACHE_ENTRIES = 400_000   # entries of a generation of a worker's chunk cache
BATCH_TEXTS = 1_000       # texts that are Python strings at once
BATCH_BYTES = 4 << 20     # bytes of texts whose words are told apart at once, one text at least
BLOCK_WORDS = 1 << 17     # places of words whose ids are put together at once
CACHED_CHARS = 64         # longer chunks are worked out each time, so memory stays bounded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for rows no model may learn from; a NULL id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(True))


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts the lineage,
    survives lost executors and fixes row placement for later jobs."""
    path = run_dir(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- words

class WordHashes(dict):
    """Chunk between blanks -> its ``\\w+`` words, lower case, as 64-bit hashes (bytes).

    ``of(text)`` equals hashing ``re.findall(r"\\w+", text.lower())`` word by word:
    no word spans white space.
    """

    def __init__(self):
        import re
        super().__init__()
        self._words = re.compile(r"\w+").findall

    def __missing__(self, chunk: str) -> bytes:
        out = b"".join(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                       for w in self._words(chunk.lower()))
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES // 2:
                self.clear()
            self[chunk] = out
        return out

    def of(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.split())) if text else b""


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(word_hashes: list[bytes], k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """All k-word shingles of a batch of texts as 64-bit hashes.

    Returns (hashes, offsets); text i owns ``hashes[offsets[i]:offsets[i+1]]`` in reading
    order, repeats included. A text of 1 to k-1 words has one shingle, the whole of it.
    """
    n = np.array([len(b) // 8 for b in word_hashes], dtype=np.int64)
    words = np.frombuffer(b"".join(word_hashes), dtype="<u8").astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(n)])
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(offsets[-1], dtype=np.uint64)
    # window starts: position within the text plus the text's first word
    long_ = np.repeat(n >= k, counts)
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(first[:-1], counts)
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
    with np.errstate(over="ignore"):
        acc = np.zeros(int(long_.sum()), dtype=np.uint64)
        start = at[long_]
        for i in range(k):
            acc = mix64(acc * odd[(i + 5) % 8] + words[start + i] * odd[i % 8])
        out[long_] = acc
        for i in np.flatnonzero((n > 0) & (n < k)):
            h = np.zeros(1, dtype=np.uint64)
            for w in words[first[i]:first[i + 1]]:
                h = mix64(h * odd[6] + w * odd[7])
            out[offsets[i]] = h[0]
    return out, offsets


# ---------------------------------------------------------------- token ids

#: Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Fixed value: the pattern of vocabularies that drop white space and case.
LOWER_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Letters that NFC leaves as they are, one lower-case letter each, and ASCII marks: by that pattern a
#: word of letters, then marks is two pre-tokens.
LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
LETTERS_MARKS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+[!-/:-@\[-`{-~]*$"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes get code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    kept = set(own)
    return [chr(b) if b in kept else chr(next(extra)) for b in range(256)]


def _pre_tokens(spec: dict) -> tuple[str, bool, bool]:
    """(pattern, lower case, known) of a tokenizers file: how it cuts a text into pre-tokens."""
    pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
    if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not norm:
        return PRE_TOKENS, False, True
    steps = pre.get("pretokenizers", [])
    if [p["type"] for p in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and steps[0]["invert"] and steps[0]["behavior"] == "Removed" \
            and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
        return steps[0]["pattern"]["Regex"], True, True
    return r"\S+", False, False


class _Unsafe(Exception):
    """The text must be encoded whole."""


class Recent(dict):
    """A bounded cache of two generations: when the younger is full it becomes the older and the
    former older one is dropped, so what is used often is never made anew. Subclasses make entries."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        super().__init__()
        self._entries, self._older = entries, {}

    def make(self, key: str):
        raise NotImplementedError

    def keeps(self, key: str) -> bool:
        return len(key) <= CACHED_CHARS

    def __missing__(self, key: str):
        out = self._older.get(key)
        if out is None:
            out = self.make(key)
        if self.keeps(key):
            if len(self) >= self._entries:
                self._older = dict(self)
                self.clear()
            self[key] = out
        return out


class _PieceIds(Recent):
    """Pre-token -> token ids as little-endian uint32 bytes."""

    def __init__(self, tokenizer, entries: int = CACHE_ENTRIES):
        super().__init__(entries // 2)
        self._merge, stand_ins = tokenizer.model.tokenize, byte_symbols()
        self._latin = {c: "".join(stand_ins[b] for b in chr(c).encode("utf-8")) for c in range(256)}

    def make(self, piece: str) -> bytes:
        """``piece`` holds Latin-1 characters only."""
        symbols = piece.replace(" ", self._latin[32]) if piece.isascii() and "\n" not in piece else piece.translate(self._latin)
        return array("I", [t.id for t in self._merge(symbols)]).tobytes()


class _Ids(Recent):
    """Chunk -> token ids as little-endian uint32 bytes.

    A chunk of Latin-1 letters, digits and marks is cut into pre-tokens here and only its new
    pre-tokens go to the library's merges; any other chunk is encoded by the library as a whole.
    """

    def __init__(self, tokenizer, lead: str, checked: bool, pieces: _PieceIds | None, pattern: str, lower: bool,
                 entries: int = CACHE_ENTRIES):
        import re

        import regex
        super().__init__(entries)
        self._encode, self._lead, self._checked = tokenizer.encode, lead, checked
        self._pieces, self._lower = pieces, lower
        self._plain, self._cut = re.compile(r"[!-~\u00a1-\u00ff\n]*").fullmatch, regex.compile(pattern).findall

    def keeps(self, chunk: str) -> bool:
        return len(chunk) <= CACHED_CHARS and "\n" not in chunk       # words around a line's end seldom meet again

    def make(self, chunk: str) -> bytes:
        if self._checked and (not chunk or chunk[0].isspace()):
            raise _Unsafe
        text, pieces = self._lead + chunk, self._pieces
        if pieces is not None and chunk:
            # the pattern's commonest case: a word, or a word and a mark; its ids are kept here only
            if chunk[-1] in ".,;:!?":
                word = chunk[:-1]
                if word.isalpha() and (word.isascii() or max(word) <= "\u00ff"):
                    return self[word] + pieces[chunk[-1]]
            elif chunk.isalpha() and (chunk.isascii() or max(chunk) <= "\u00ff"):
                return pieces.make(text.lower() if self._lower else text)
        if pieces is not None and self._plain(chunk):
            return b"".join(map(pieces.__getitem__, self._cut(text.lower() if self._lower else text)))
        return array("I", self._encode(text, add_special_tokens=False).ids).tobytes()


class TokenIds:
    """Whole-text token ids of a ``tokenizers`` file, with bounded caches of chunks and pre-tokens.

    A text is cut at blanks. For a byte-level vocabulary a blank followed by anything but
    white space always starts a new pre-token, so a chunk with its blank can be encoded on its
    own; if any chunk is empty or starts with white space, the whole text is encoded in one
    call instead. A vocabulary that drops white space (``spaced=False``) needs no such check.
    Texts that hold one of the file's special strings are always encoded whole. ``entries``: of a generation of the chunks' cache.
    """

    def __init__(self, path: str, spaced: bool, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self.base = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern, lower, known = _pre_tokens(spec)
        pieces = _PieceIds(self._tokenizer, entries) if known else None
        self._spaced, self._cuts_words = spaced, known and pattern == LOWER_PRE_TOKENS
        self._first = _Ids(self._tokenizer, "", False, pieces, pattern, lower, entries)
        self._rest = _Ids(self._tokenizer, " ", True, pieces, pattern, lower, entries) if spaced else self._first

    def whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def of(self, text: str | None) -> bytes:
        """Ids of ``text`` as little-endian uint32 bytes; NULL counts as empty."""
        if not text:
            return b""
        for s in self._special:
            if s in text:
                return self.whole(text)
        head, *rest = text.split(" ")
        try:
            return self._first[head] + b"".join(map(self._rest.__getitem__, rest))
        except _Unsafe:
            return self.whole(text)

    def of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, as ``of`` gives them.

        Where white space is dropped, Arrow cuts some texts at a time into words and tells these
        apart, so a word is looked up once for all its places there.
        """
        if self._spaced:
            for at in range(0, len(texts), BATCH_TEXTS):
                yield from map(self.of, texts.slice(at, BATCH_TEXTS).to_pylist())
            return
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, "right")))
            yield from self._of_slice(texts.slice(at, to - at))
            at = to

    def _of_slice(self, texts: pa.Array) -> list[bytes]:
        special = np.zeros(len(texts), dtype=bool)
        for s in self._special:
            special |= pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
        cut = pc.ascii_split_whitespace(texts)
        n_words = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False)
        words = cut.flatten().dictionary_encode()
        parts, lead, tail = self._parts(words.dictionary)
        ids = [self._first[p] for p in parts]
        n_ids = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        first, flat, word = np.cumsum(n_ids) - n_ids, np.frombuffer(b"".join(ids), dtype="<u4"), words.indices.to_numpy()
        both, out = np.stack([lead, tail], 1), []
        for i in range(0, len(word), BLOCK_WORDS):
            part = both[word[i:i + BLOCK_WORDS]].ravel()      # each place of a word is its two parts, one after the other
            out.append(flat[spans(first[part], n_ids[part])].tobytes())
        out = b"".join(out)
        at = 4 * np.concatenate([[0], np.cumsum((n_ids[lead] + n_ids[tail])[word])])[np.concatenate([[0], np.cumsum(n_words, dtype=np.int64)])]
        found = [out[start:end] for start, end in zip(at[:-1].tolist(), at[1:].tolist())]
        for i in np.flatnonzero(special).tolist():
            found[i] = self.whole(texts[i].as_py())
        return found

    def _parts(self, words: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(parts, lead, tail): ``words`` i has the ids of parts[lead[i]], then those of parts[tail[i]].

        A word of Latin letters and marks after them is cut there; any other is one part, followed by the empty one.
        """
        plain = pc.match_substring_regex(words, LETTERS_MARKS) if self._cuts_words else pa.array(np.zeros(len(words), dtype=bool))
        known, rest = words.filter(plain), words.filter(pc.invert(plain))
        letters = pc.utf8_lower(pc.ascii_rtrim(known, characters=MARKS)).dictionary_encode()
        marks = pc.utf8_ltrim(known, characters=LETTERS).dictionary_encode()
        parts = [""]
        for found in (letters.dictionary, marks.dictionary, rest):
            parts += found.to_numpy(zero_copy_only=False).tolist()       # strings much sooner than by to_pylist
        lead, tail = np.zeros((2, len(words)), dtype=np.int64)
        here = plain.to_numpy(zero_copy_only=False)
        lead[here], tail[here] = 1 + letters.indices.to_numpy(), 1 + len(letters.dictionary) + marks.indices.to_numpy()
        lead[~here] = np.arange(len(parts) - len(rest), len(parts))
        return parts, lead, tail


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start[i] .. start[i]+length[i]-1, one after another."""
    first = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - first, length)


def release_memory() -> None:
    """Give freed memory back to the system: a worker's next stage starts small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
        if trim:
            trim(0)


class _StageCache:
    """What a worker process keeps while it works for one Spark stage: workers are reused, so without an
    end at the stage's the caches of all stages of a pipeline would add up."""

    def __init__(self):
        self.stage, self.held = None, {}

    def get(self, key, make: Callable):
        context = TaskContext.get()
        stage = context.stageId() if context else None
        if stage != self.stage:
            self.stage, self.held = stage, {}
            release_memory()
        if key not in self.held:
            self.held[key] = make()
        return self.held[key]


STAGE_CACHE = _StageCache()


def encoder(path: str, spaced: bool, entries: int = CACHE_ENTRIES) -> TokenIds:
    """One encoder per worker process, stage and file."""
    return STAGE_CACHE.get((path, spaced, entries), lambda: TokenIds(path, spaced, entries))


def id_texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(id, text) of a batch's first two columns, a slice at a time: a batch's texts as Python strings can take four times its bytes."""
    for at in range(0, batch.num_rows, BATCH_TEXTS):
        ids, texts = (batch.column(i).slice(at, BATCH_TEXTS).to_pylist() for i in (0, 1))
        yield from zip(ids, texts)


def word_hasher() -> WordHashes:
    return STAGE_CACHE.get("words", WordHashes)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name (case does not tell columns apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_batches(ids: list, texts: list, most_words: int = 400_000, most_texts: int = 2_000):
    """Split a batch into runs of at most ``most_words`` words and ``most_texts`` texts (one text at
    least): yields (ids, word hashes of each text)."""
    hasher = word_hasher()
    kept, words, n = [], [], 0
    for i, text in zip(ids, texts):
        h = hasher.of(text)
        if kept and (n + len(h) // 8 > most_words or len(kept) >= most_texts):
            yield kept, words
            kept, words, n = [], [], 0
        kept.append(i)
        words.append(h)
        n += len(h) // 8
    if kept:
        yield kept, words
