"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed text."""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import STAGE_CACHE, held_out, saved

UNDETERMINED = "und"
TRAIN_DOCS = 6000          # at most so many training documents in all, an equal share of each language
MAX_GRAMS = 20_000         # character n-grams kept for a language, the most frequent
SWITCH = 12.0              # log-odds that a change of language inside a text costs
WORD_LIMIT = 6.0           # most log-odds that one word gives one language over another
PIECE_CHARS = 64           # a longer stretch without blanks is labelled in pieces of so many characters
CACHE_WORDS = 400_000
BATCH_CHARS = 1_000_000    # texts whose new words are scored together

#: First code points of script ranges (Unicode blocks, letters only are looked up).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB07, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, "other"), (0x20000, "han"),
]
_STARTS = [s for s, _ in SCRIPTS]
_LETTERS = regex.compile(r"\p{L}+")


def script_of(ch: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(ch)) - 1][1]


def script_runs(word: str) -> list[tuple[str, str]]:
    """Split a run of letters where the script changes: [(script, letters)]."""
    if word.isascii() or max(word) < "\u0370":
        return [("latin", word)]
    out: list[list[str]] = []
    for ch in word:
        s = script_of(ch)
        if out and out[-1][0] == s:
            out[-1][1] += ch
        else:
            out.append([s, ch])
    return [(s, w) for s, w in out]


def chunks_of(text: str) -> list[str]:
    """The text between white space, longer stretches cut into pieces of PIECE_CHARS: scripts
    without blanks are labelled piece by piece."""
    chunks = text.split()
    if max(map(len, chunks), default=0) > PIECE_CHARS:
        chunks = [c[i:i + PIECE_CHARS] for c in chunks for i in range(0, len(c), PIECE_CHARS)]
    return chunks


def grams(word: str) -> list[str]:
    """Character trigrams of a word between its two ends."""
    w = f"^{word}$"
    return [w[i:i + 3] for i in range(len(w) - 2)]


@dataclass
class LanguageModel:
    languages: list[str]
    scripts: dict[str, np.ndarray]     # script -> mask of the languages written in it
    index: dict[str, int]              # n-gram -> row of logp
    logp: np.ndarray                   # (n-grams + 1, languages); the last row for unseen ones


def train(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> LanguageModel:
    """Learn n-gram frequencies and scripts of each language.

    Only rows outside the held-out fold with a text and a language count, at most
    ``max_docs`` of them, the same share for each language, chosen by a hash of the text.
    The model's size is bounded by MAX_GRAMS and the number of languages.
    """
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], {}, {}, np.zeros((1, 0)))
    share = max(1, max_docs // len(languages))
    mark = usable.select("lang", F.xxhash64("text").alias("mark")).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    picked = mark.withColumn("rank", rank).filter(F.col("rank") <= share).select("lang", "mark")
    sample = saved(usable.select("lang", "text", F.xxhash64("text").alias("mark")).join(F.broadcast(picked), ["lang", "mark"], "left_semi").select("lang", "text"), "lang-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str], int] = {}
        words: dict[str, list[str]] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                for run in (r for c in chunks_of(text.lower()) for r in _LETTERS.findall(c)):
                    if run not in words:
                        parts = script_runs(run)
                        words[run] = [f"script {s}" for s, w in parts for _ in w] + [g for _, w in parts for g in grams(w)]
                        if len(words) > CACHE_WORDS:
                            words.clear()
                    for g in words.get(run, ()):
                        seen[lang, g] = seen.get((lang, g), 0) + 1
        yield pd.DataFrame([(lang, g, n) for (lang, g), n in seen.items()], columns=["lang", "gram", "n"])

    counted = saved(sample.mapInPandas(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counted.withColumn("rank", best).filter(F.col("rank") <= MAX_GRAMS).collect()

    scripts, index, at = {}, {}, {lang: i for i, lang in enumerate(languages)}
    letters = np.zeros(len(languages))
    for r in rows:
        if r["gram"].startswith("script "):
            scripts.setdefault(r["gram"][7:], np.zeros(len(languages)))[at[r["lang"]]] = r["n"]
            letters[at[r["lang"]]] += r["n"]
        else:
            index.setdefault(r["gram"], len(index))
    masks = {s: n > 0.02 * np.maximum(letters, 1) for s, n in scripts.items()}
    counts = np.zeros((len(index) + 1, len(languages)))
    for r in rows:
        if not r["gram"].startswith("script "):
            counts[index[r["gram"]], at[r["lang"]]] = r["n"]
    logp = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(counts)))
    return LanguageModel(languages, {s: m for s, m in masks.items() if m.any()}, index, logp)


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word where each change of label costs ``switch``.

    If no run of words gains more than ``switch`` by leaving the best single label, that label is
    the best path and nothing is walked.
    """
    if not scores.size:
        return np.zeros(len(scores), dtype=np.int64)
    best = int(scores.sum(axis=0).argmax())
    over = np.delete(scores, best, axis=1)
    if over.shape[1] == 0:
        return np.full(len(scores), best)
    gain = np.concatenate([[0.0], np.cumsum(over.max(axis=1) - scores[:, best])])
    if (gain - np.minimum.accumulate(gain)).max() <= switch:
        return np.full(len(scores), best)
    # plain lists: a step over a handful of languages is too small for numpy
    steps = scores.tolist()
    now, back = steps[0], []
    for row in steps[1:]:
        best_now = max(now)
        least = best_now - switch
        back.append((now.index(best_now), [v >= least for v in now]))
        now = [(v if v >= least else least) + x for v, x in zip(now, row)]
    at = now.index(max(now))
    path = [at]
    for top, stay in reversed(back):
        if not stay[at]:
            at = top
        path.append(at)
    return np.array(path[::-1], dtype=np.int64)


class _Words(dict):
    """Chunk -> row of ``table``: the chunk's log-odds for each language, its number of letters, and how many of
    them are of a script that some language is written in.

    New chunks are scored together. The cache is emptied when it is full, between texts.
    """

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.table = np.zeros((0, len(model.languages) + 2))
        self._scripts = {s: i for i, s in enumerate(model.scripts)}
        self._among = np.array([*model.scripts.values(), np.zeros(len(model.languages), dtype=bool)])

    def _add(self, chunks: list[str]) -> None:
        """Score new chunks: the sum over their words, each within WORD_LIMIT of its best language."""
        get, unseen, no_script = self.model.index.get, len(self.model.logp) - 1, len(self._scripts)
        rows, sizes, owner, script, letters = [], [], [], [], []
        for i, chunk in enumerate(chunks):
            for run in _LETTERS.findall(chunk.lower()):
                for name, part in script_runs(run):
                    w = f"^{part}$"
                    rows += [get(w[j:j + 3], unseen) for j in range(len(part))]
                    sizes.append(len(part))
                    owner.append(i)
                    script.append(self._scripts.get(name, no_script))
                    letters.append(len(part))
        out = np.zeros((len(chunks), self.table.shape[1]))
        if rows:
            scores = np.add.reduceat(self.model.logp[rows], np.cumsum(sizes) - sizes, axis=0)
            among = self._among[script]
            known = among.any(axis=1)                    # letters of no language's script say nothing
            scores = np.where(among, scores, -np.inf)
            scores[known] = np.maximum(scores[known] - scores[known].max(axis=1, keepdims=True), -WORD_LIMIT)
            scores[~known] = 0.0
            np.add.at(out[:, :-2], owner, scores)
            out[:, -2] = np.bincount(owner, weights=letters, minlength=len(chunks))
            out[:, -1] = np.bincount(owner, weights=np.where(known, letters, 0), minlength=len(chunks))
            out[:, :-2] -= out[:, :-2].max(axis=1, keepdims=True)
        for i, chunk in enumerate(chunks, len(self.table)):
            self[chunk] = i
        self.table = np.concatenate([self.table, out])

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text the rows of its chunks with a letter, in reading order."""
        if len(self) > CACHE_WORDS:
            self.clear()
            self.table = self.table[:0]
        cut = [chunks_of(t) for t in texts]
        new = set().union(*cut).difference(self.keys())
        if new:
            self._add(list(new))
        found = [self.table[np.fromiter(map(self.__getitem__, c), dtype=np.int64, count=len(c))] for c in cut]
        return [f[f[:, -2] > 0] for f in found]


def labelled(words: _Words, texts: list[str | None], switch: float = SWITCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(label, letters, letters of a known script) of each word with a letter, text by text; texts are scored
    BATCH_CHARS at a time."""
    kept: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        kept.append(text or "")
        size += len(kept[-1])
        if size >= BATCH_CHARS or i == len(texts) - 1:
            for rows in words.rows(kept):
                yield viterbi(rows[:, :-2], switch), rows[:, -2], rows[:, -1]
            kept, size = [], 0


def identify(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """``docs`` plus lang_pred, score and n_spans, found from every whole text.

    ``lang_pred`` is the language with most letters among the Viterbi spans, ``score`` its share of the
    letters (letters of scripts that no language is written in count for none, so a text of such letters
    alone scores 0), ``n_spans`` how many spans there are. NULL texts and texts without a letter (or a
    model that learned nothing) are ``und`` with score 0. Ties go to the language first in order.
    Only the text enters a prediction; each row gives one row; a clashing column of the three is replaced.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    own = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "n_spans")]
    at = [f.name for f in own].index("text")
    names = [f"c{i}" for i in range(len(own))]      # a name with a dot does not pass mapInArrow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = broadcast.value
        words = STAGE_CACHE.get(key, lambda: _Words(m))
        for b in batches:
            langs, scores, n_spans = [], [], []
            for label, letters, known in labelled(words, b.column(at).to_pylist(), switch):
                if not len(label) or not m.languages:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    n_spans.append(0)
                    continue
                share = np.bincount(label, weights=known, minlength=len(m.languages))
                top = int(share.argmax())
                langs.append(m.languages[top])
                scores.append(float(share[top] / letters.sum()))
                n_spans.append(1 + int((label[1:] != label[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(n_spans, pa.int32())],
                                             names=[*names, "lang_pred", "score", "n_spans"])

    schema = "".join(f"{n} {f.dataType.simpleString()}, " for n, f in zip(names, own)) + "lang_pred string, score double, n_spans int"
    rows = docs.select(*[F.col(f"`{f.name}`").alias(n) for n, f in zip(names, own)])
    return rows.mapInArrow(run, schema).toDF(*[f.name for f in own], "lang_pred", "score", "n_spans")


def label_spans(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """(doc_id, span, lang, first_word, n_words, n_letters): the labelled spans of each text with a letter."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = broadcast.value
        words = _Words(m)
        for b in batches:
            out = []
            for doc, (label, letters, _) in zip(b.column(0).to_pylist(), labelled(words, b.column(1).to_pylist(), switch)):
                cut = np.concatenate([[0], np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]]) if len(label) and m.languages else [0]
                out += [(doc, i, m.languages[label[s]], int(s), int(e - s), int(letters[s:e].sum())) for i, (s, e) in enumerate(zip(cut[:-1], cut[1:]))]
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()),
                                              *(pa.array(c, pa.int64()) for c in cols[3:])], names=["doc_id", "span", "lang", "first_word", "n_words", "n_letters"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, span int, lang string, first_word bigint, n_words bigint, n_letters bigint")
