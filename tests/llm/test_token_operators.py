"""Operators 2, 5 and 9 against brute force with the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from motorlake.llm import common, grammar_ids, packing, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \nb", "a\n b", "a\n \n b", "it's I'll 's x", "don 't",
       "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c", "<|startoftext|> x", "ß É é ́x", "x y  z  w",
       "日本語 テキスト", "😀😀 😀", "a\x1cb \x1dc", "x\x85 y \x85z", "12345 6 7890", "\t\tcode\r\n  end", "A" * 5000, "ab " * 4000]


def texts(seed=1, n=60):
    rng = random.Random(seed)
    alphabet = list("abcdeé'ß1 2 \n\n \t.!<|>") + [" the ", "  ", "'s", "<|endoftext|>", " ", "\x1c"]
    return ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "clash", "clash") for i, t in enumerate(texts())]
    rows += rows[5:9] + [(None, "no id here", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, n_tokens string").repartition(5)


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_counts_equal_the_library(docs):
    got = token_counts.count_tokens(docs, BYTES, 20).collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(library_ids(BYTES, r.text))) for r in docs.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)


def test_packing_pieces_and_gapless_offsets(docs):
    got = packing.pack_documents(docs, BYTES, 64, 2).collect()
    want = []
    for r in docs.collect():
        ids = library_ids(BYTES, r.text) + [2]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)] if len(ids) > 64 else [0, len(ids)]
        want += [(r.doc_id or -1, i, s, e - s, crc(ids[s:e])) for i, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((-1 if r.doc_id is None else r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        i = min(fits, key=lambda k: rooms[k]) if fits else None
        if i is None:
            rooms.append(capacity)
            i = len(rooms) - 1
        rooms[i] -= n
    return len(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_over_single_pieces(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 100), 7, 33, 51]) for _ in range(rng.randint(1, 400))]
    plan = packing.plan_slots({n: lengths.count(n) for n in set(lengths)}, 100)
    assert max(r[3] + -(-(r[2] - r[1]) // r[4]) for r in plan) == brute_best_fit(lengths, 100)
    assert sum(r[2] - r[1] for r in plan) == len(lengths)


def test_ids_round_trip_through_the_files(spark, docs):
    got = grammar_ids.encode_and_read(docs, WORDS, 1).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    start, want = 0, []
    for r in rows:
        ids = library_ids(WORDS, r.text) + [1]
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(got, key=lambda r: r.start) == want


def test_grammar_random_access():
    rng = np.random.default_rng(3)
    documents = [np.append(rng.choice([5, 6, 7, 8, 9], size=n, p=[.4, .3, .1, .1, .1]), 1).astype("<u4") for n in rng.integers(0, 900, 40)]
    documents.append(np.array([4] * 999 + [1], dtype="<u4"))
    payload = grammar_ids.pack_shard([d.tobytes() for d in documents], 10)
    shard = grammar_ids.Shard(payload)
    assert len(shard.rules) > 20 and len(shard.symbols) < sum(map(len, documents)) / 2
    for i in rng.permutation(len(documents)):
        assert (shard.ids(int(i)) == documents[i]).all()
    assert (shard.all_ids() == np.concatenate(documents)).all()
    for i, (a, b) in enumerate(shard.rules):
        assert max(a, b) < 10 + i
    with pytest.raises(ValueError):
        grammar_ids.Shard(payload[:-9] + bytes(9))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert token_counts.count_tokens(none, BYTES).count() == 0
    assert packing.pack_documents(none, BYTES).count() == 0
    assert grammar_ids.encode_and_read(none, WORDS).count() == 0


def test_hot_length_is_spread(spark):
    """A third of all pieces with one length: ranks stay distinct over many tasks."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same words here").otherwise(
        F.repeat(F.lit("word "), (F.col("id") % 40).cast("int"))).alias("text")).repartition(7)
    got = packing.pack_documents(docs, BYTES, 32, 2)
    assert got.count() == got.select("sequence_id", "offset").distinct().count()


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 500, rng.integers(2, 60)) for _ in range(30)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 30, 4000)] + [np.full(777, 9)]).astype(np.uint32)
    ends = rng.random(len(ids)) < 0.01
    ends[-1] = True
    rules, symbols, last = grammar_ids.repair(ids, ends, 500)
    pairs = Counter(zip(symbols[:-1][~last[:-1]].tolist(), symbols[1:][~last[:-1]].tolist()))
    assert max(pairs.values()) < grammar_ids.LEAST_COUNT
    whole = [[i] for i in range(500)]
    for a, b in rules.tolist():
        whole.append(whole[a] + whole[b])
    assert [i for s in symbols.tolist() for i in whole[s]] == ids.tolist()
    assert np.cumsum([len(whole[s]) for s in symbols.tolist()])[last].tolist() == (np.flatnonzero(ends) + 1).tolist()


def test_a_run_of_one_id_shrinks_to_its_logarithm():
    ends = np.zeros(100_000, dtype=bool)
    ends[-1] = True
    rules, symbols, _ = grammar_ids.repair(np.full(100_000, 7, dtype=np.uint32), ends, 100)
    assert len(rules) < 20 and len(symbols) < 20


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_ids_of_many_texts_equal_the_library(monkeypatch, kind):
    one = [chr(c) for c in [*range(1, 0x180), 0x1E9E, 0x212A, 0x2028, 0x3000, 0x1F600]]
    many = texts(2) + [f"x{c}y {c} {c}Ab Ab{c} Ab{c}{c}. 7{c}'s{c}" for c in one]
    many += ["H\u0331 h\u0331 I\u0307 T\u0308.", "<|ENDOFTEXT|> x", "it's ITS' 's's ''s Don'T", "ÄÖÜß### Ünter,.. ÿ! µ ªº", "e\u0301### E\u0301"]
    library = Tokenizer.from_file(WORDS)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in many]
    for most in (1, 300, 1 << 20):
        monkeypatch.setattr(common, "BATCH_BYTES", most)
        monkeypatch.setattr(common, "BLOCK_WORDS", most)
        got = common.TokenIds(WORDS, False).of_texts(pa.array(["before", *many, "after"], kind).slice(1, len(many)))
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == want
    spaced, plain = common.TokenIds(BYTES, True), Tokenizer.from_file(BYTES)
    assert [np.frombuffer(b, "<u4").tolist() for b in spaced.of_texts(pa.array(many, kind))] \
        == [plain.encode(t or "", add_special_tokens=False).ids for t in many]
    for none in ([], [None, None], ["", None, " "]):
        assert list(common.TokenIds(WORDS, False).of_texts(pa.array(none, kind))) == [b""] * len(none)


def test_a_word_is_looked_up_once_for_all_its_places():
    """Work in Python grows with the distinct words of some megabytes of text, not with all words."""
    ids, looked_up = common.TokenIds(WORDS, False), []

    class Watched(dict):
        def __missing__(self, word):
            looked_up.append(word)
            return ids_of[word]

    ids_of, ids._first = ids._first, Watched()
    text = "The house, the House and THE house### " * 50
    want = library_ids(WORDS, text)
    assert all(np.frombuffer(b, "<u4").tolist() == want for b in ids.of_texts(pa.array([text] * 500)))
    assert sorted(filter(None, looked_up)) == ["###", ",", "and", "house", "the"]


def rounds_over_all_places(ids, ends, base):
    """Re-Pair in the same rounds, by counting every place each time."""
    symbols, last, rules = ids.tolist(), ends.tolist(), []
    while True:
        top = base + len(rules)
        pair = [None if last[i] else (symbols[i], symbols[i + 1]) for i in range(len(symbols) - 1)]
        often = sorted(((-n, p) for p, n in Counter(p for p in pair if p).items() if n >= grammar_ids.LEAST_COUNT))
        if not often:
            return rules, symbols, last
        chosen = [p for _, p in often[:grammar_ids.ROUND_RULES]]
        rank = {p: i for i, p in enumerate(chosen)}
        place = np.array([i for i, p in enumerate(pair) if p in rank])
        taken = place[grammar_ids.peaks(place, np.array([len(chosen) - rank[pair[i]] for i in place]))].tolist()
        made = Counter(pair[i] for i in taken)
        kept = [p for p in chosen if made[p] >= grammar_ids.LEAST_COUNT // 2]
        number = {p: top + i for i, p in enumerate(kept)}
        rules += kept
        for i in reversed([i for i in taken if pair[i] in number]):
            symbols[i:i + 2], last[i:i + 2] = [number[pair[i]]], [last[i + 1]]


@pytest.mark.parametrize("base", [300, 70_000])
def test_rounds_equal_counting_every_place(monkeypatch, base):
    """The same grammar, with fewer places counted (when the two symbols of a place decided each alone, 10.7 times the ids)."""
    monkeypatch.setattr(grammar_ids, "ROUND_RULES", 40)
    rng, counted, unique = np.random.default_rng(5), [], np.unique

    def watched(x, **kind):
        counted.extend([len(x)] if kind else [])
        return unique(x, **kind)

    phrases = [rng.integers(0, 300, rng.integers(2, 40)) for _ in range(40)]
    some = [phrases[i] if i < 40 else rng.integers(0, 300, 9) for i in rng.integers(0, 120, 1500)]
    ids = np.concatenate([*some, np.full(200, 9)]).astype(np.uint32)
    ends = rng.random(len(ids)) < 0.02
    ends[-1] = True
    rules, symbols, last = rounds_over_all_places(ids, ends, base)
    monkeypatch.setattr(np, "unique", watched)
    got = grammar_ids.repair(ids, ends, base)
    assert [got[0].tolist(), got[1].tolist(), got[2].tolist()] == [[list(r) for r in rules], symbols, last]
    assert len(counted) == 28 and sum(counted) < 6 * len(ids)
