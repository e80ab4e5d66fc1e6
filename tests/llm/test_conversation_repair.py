"""Damage, faults and cheapest repair of conversations against a plain version that tries every edit."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from motorlake.llm import conversation_repair as C

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn int, role string, text string"


def plain(rows):
    """conv_id -> result, by the contract's words."""
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        role = "user" if k == 4 else role
        mine += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in mine if t is not None]
        faults, seen = [], set()
        for _, role, text in mine:
            body = text.rstrip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in mine]

        @lru_cache(None)
        def best(i, done, inserted):
            """(cost, audit, written rows) from row i on; ``done`` is the grammar's state."""
            nxt = "a" if done == "u" else "u"
            ways = [(0, "", ())] if i == len(mine) and done in ("", "a") else []
            if inserted < 2:
                c, a, w = best(i, nxt, inserted + 1)
                ways.append((c + 5, "I" + a, ((C.ROLE[nxt], ""), *w)))
            if i < len(mine):
                c, a, w = best(i + 1, done, 0)
                ways.append((c + 2, "D" + a, w))
                if faults[i] not in ("blank", "duplicate"):
                    more = 5 * (faults[i] == "truncated")
                    if initials[i] == nxt or (done == "" and initials[i] == "s"):
                        c, a, w = best(i + 1, initials[i], 0)
                        ways.append((c + more, "K" + a, (mine[i][1:], *w)))
                    c, a, w = best(i + 1, nxt, 0)
                    ways.append((c + 1 + more, "R" + a, ((C.ROLE[nxt], mine[i][2]), *w)))
            return min(ways, key=lambda w: w[:2], default=(10 ** 9, "", ()))

        cost, audit, written = best(0, "", 0)
        text = "\n".join(f"{r}:{t}" for r, t in written)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def repaired(df):
    return {r["conv_id"]: tuple(r[c] for c in C.RESULT) for r in C.repair_conversations(df).collect()}


def conversation(rng, conv, n):
    rows = []
    for i in range(n):
        role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
        text = rng.choice(["Yes.", "No!", "half a sen", " \n", None, "", "Why? \t", "What (is) this", f"Word {rng.random()}."])
        rows.append((conv, rng.choice([None, i, i, i, i // 2, i + 3]), role, text))
    return rows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [r for conv in range(400) for r in conversation(rng, conv, rng.randint(1, 9))]
    out += [(None, 1, "user", "Hello."), (None, 2, "assistant", "Hi"), (None, None, None, None)]
    out += [(1000, 5, "user", "same.")] * 40                      # repeated rows
    return out


def test_repair_equals_plain_version(spark, rows):
    assert repaired(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_pieces_do_not_change_results(spark, rows, size, monkeypatch):
    """Conversations of many pieces, the pieces of one spread over several parts."""
    rng = random.Random(size)
    mine = rows[:300] + conversation(rng, 5000, 60) + [(6000, i, rng.choice(["user", "assistant"]), f"Line {i}.") for i in range(80)]
    monkeypatch.setattr(C, "PIECE_ROWS", size)
    assert repaired(spark.createDataFrame(mine, SCHEMA).repartition(5)) == plain(mine)


def test_long_texts_split_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_CHARS", 100)
    mine = [(1, i, "user" if i % 2 == 0 else "assistant", "long " * 100 + str(i) + ".") for i in range(12)]
    assert repaired(spark.createDataFrame(mine, SCHEMA)) == plain(mine)


def test_lost_and_empty(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(lost, 1, "user", "Gone.")], SCHEMA))
    assert got == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repaired(spark.createDataFrame([], SCHEMA)) == {}


def test_more_columns_and_text_ids(spark, rows):
    mine = [(None if c is None else f"c{c}", t, r, x, "extra", 1) for c, t, r, x in rows[:60]]
    df = spark.createDataFrame(mine, "conv_id string, turn int, role string, text string, signature string, _d int")
    assert repaired(df) == plain([m[:4] for m in mine])
