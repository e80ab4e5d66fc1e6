"""Line dedup against a brute force that compares every earlier document."""

import random

import pytest

from motorlake.llm import line_dedup


def lines_of(text):
    return [" ".join(x.split()) for x in text.split("\n") if x.strip()]


def brute_blocks(rows, block_words=10):
    """Line numbers of each document in any common run of block_words or more with any earlier document."""
    out = {}
    for i, text in rows:
        own, gone = lines_of(text), set()
        for j, other in rows:
            other = lines_of(other) if j < i else []
            for x in range(len(own)):
                for y in range(len(other)):
                    n = 0
                    while x + n < len(own) and y + n < len(other) and own[x + n] == other[y + n]:
                        n += 1
                    if sum(len(w.split()) for w in own[x:x + n]) >= block_words:
                        gone |= set(range(x, x + n))
        out[i] = gone
    return out


def check(spark, rows, block_words=10):
    """What is left has no block that an earlier document has, and only lines of such blocks are gone. Returns the lines gone.

    Each line ends with blanks, as many as its number, by which it is found again; they do not count in comparisons.
    """
    marked = [(i, "\n".join(x + " " * n for n, x in enumerate(text.split("\n")))) for i, text in rows]
    docs = spark.createDataFrame(marked, "doc_id long, text string").repartition(5)
    may, texts, out = brute_blocks(rows, block_words), dict(rows), {}
    for r in line_dedup.deduplicate_lines(docs).collect():
        kept = {len(x) - len(x.rstrip(" ")) for x in r.text.split("\n")} if r.text else set()
        own = texts[r.doc_id].split("\n") if texts[r.doc_id] else []
        out[r.doc_id] = set(range(len(own))) - kept
        assert out[r.doc_id] <= may[r.doc_id] and len(out[r.doc_id]) == r.n_removed
        left = "\n".join(x if n in kept else f"gone {r.doc_id} {n}" for n, x in enumerate(own))
        assert not brute_blocks([*((i, t) for i, t in rows if i < r.doc_id), (r.doc_id, left)], block_words)[r.doc_id], r.doc_id
    return out


def says(*names, words=6):
    return "\n".join(" ".join(f"{n}{i}" for i in range(words)) for n in names)


def test_block_whose_lines_have_other_first_holders(spark):
    rows = [(1, says("p", "x")), (2, says("y", "q")), (3, says("z", "p", "q")), (4, says("p", "q", "v"))]
    assert check(spark, rows)[4] == {0, 1}


@pytest.mark.parametrize("seed", range(3))
def test_all_earlier_documents_count(spark, seed):
    rng = random.Random(seed)
    pool = [says(f"l{n}_", words=rng.choice([1, 2, 4, 6, 9, 12])) for n in range(14)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < .8 else f"own{i} {n}" for n in range(rng.randint(0, 14)))) for i in range(60)]
    assert sum(map(len, check(spark, rows).values())) > 60


def test_repeated_and_moved_blocks(spark):
    p, q, r = (says(*[f"{x}{n}_" for n in range(3)]) for x in "pqr")
    assert check(spark, [(1, f"{q}\n{p}"), (2, f"{p}\n{p}\n{r}")])[2] == set(range(6))
    assert check(spark, [(1, f"{q}\n{p}"), (2, f"{p}\n{p}")])[2] == set(range(6))
    assert check(spark, [(1, f"{p}\n{q}\n{r}"), (2, f"{q}\n{r}\nown\n{p}")])[2] == {0, 1, 2, 3, 4, 5, 7, 8, 9}


def test_short_lines_and_unspaced_scripts(spark):
    verse = says(*[f"v{n}_" for n in range(15)], words=4)
    chinese, thai = "我们今天在这里讨论语言模型的训练数据质量问题", "ภาษาไทยไม่มีช่องว่างระหว่างคำในประโยคเดียว"
    rows = [(1, "one\n" + verse), (2, verse + "\ntwo"), (3, chinese + "\n" + thai + "\n三"), (4, "四\n" + thai + "\n" + chinese), (5, "三\n日本語")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.text, r.n_removed) for r in line_dedup.deduplicate_lines(docs).collect()} == {
        1: (rows[0][1], 0), 2: ("two", 15), 3: (rows[2][1], 0), 4: ("四", 2), 5: (rows[4][1], 0)}
    texts = spark.createDataFrame([("a b  c",), ("é ü",), (chinese,), ("日本語",), ("use 日本語 here",), ("日本。",)], "s string")
    assert [r[0] for r in texts.select(line_dedup.line_words(texts["s"])).collect()] == [3, 2, 11, 2, 4, 1]
