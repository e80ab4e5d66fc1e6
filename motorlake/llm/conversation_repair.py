"""Cheapest structure repair of damaged conversations over a suffix-shared automaton of signatures.

A conversation is cut into pieces of at most ``PIECE_ROWS`` rows; a piece's signature has one letter a
row (role initial and fault). Signatures of all conversations are read from the end: sorted by their
reversed letters they share their suffixes, and every automaton node (one distinct suffix) gets its
cost-to-go and best audit suffix once for each grammar state. Pieces are then chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import saved

PIECE_ROWS = 1024
PIECE_CHARS = 1 << 22     # text of one piece; a longer single row is a piece of its own
OUT_ROWS = 2048

# Costs of the edits, white space, and the accepted order of roles s?(ua)+ or nothing.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
STATES = "0sua"                                # nothing yet, after system, after user, after assistant
KEPT = {"0": "su", "s": "u", "u": "a", "a": "u"}
WRITTEN = {"0": "u", "s": "u", "u": "a", "a": "u"}       # the one role that may be inserted or reroled to
ROLE = {"u": "user", "a": "assistant"}
GONE = "x"                                     # letter of a row that must be deleted; truncated rows have upper case
END = "$"                                      # ending of a conversation; other endings are the exit states


# ---------------------------------------------------------------- damage and rows

def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage with ``n``, how often each occurs: 0 for a dropped row, 2 for a repeated one. ``_c``, ``_cn`` and ``_t``, ``_tn`` are conv_id and turn without NULLs."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    k = F.crc32(F.concat(F.coalesce(conv, space), F.lit(":"), F.coalesce(turn, space)).cast("binary")) % 20
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    return rows.select(
        F.coalesce(conv, F.lit("")).alias("_c"), F.col("conv_id").isNull().alias("_cn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("_t"), F.col("turn").isNotNull().alias("_tn"),
        F.when(k == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(k == 1, F.lit("")).when(k == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(k == 0, F.lit(0)).when(k == 3, F.lit(2)).otherwise(F.lit(1)).alias("n"))


KEYS = ["_c", "_cn", "_tn", "_t", "_d"]


def faulty(rows: DataFrame) -> DataFrame:
    """Rows of ``damaged`` with their first fault: equal rows are one with their number ``n``; ``first`` is
    true for the earliest turn of a (role, text) of the conversation. Both aggregations combine
    before they shuffle and the join's keys are unique on both sides, so no key is hot."""
    text = F.col("text")
    d = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), text).cast("binary")))
    alive = rows.filter("n > 0").withColumn("_d", d)
    one = alive.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    # a NULL turn comes before any other
    first = alive.groupBy("_c", "_cn", "_d").agg(F.min("_tn").alias("_tn"), F.min(F.when(F.col("_tn"), F.col("_t"))).alias("_least"))
    first = first.select("_c", "_cn", "_tn", F.when(F.col("_tn"), F.col("_least")).otherwise(0).alias("_t"), "_d", F.lit(True).alias("first"))
    body = F.rtrim(text, F.lit(BLANKS))
    return one.join(first, KEYS, "left").withColumns({
        "first": F.coalesce("first", F.lit(False)), "blank": F.length(body) == 0,
        "cut": ~F.right(body, F.lit(1)).isin(".", "!", "?")})


# ---------------------------------------------------------------- pieces

PIECE_SCHEMA = ("_c string, _cn boolean, part int, seq bigint, signature string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                "first string, last string, low bigint, high bigint, turns bigint, roles array<string>, texts array<string>")
LEGAL = {"su", "ua", "au"}


class _Piece:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv: tuple):
        self.conv, self.letters, self.roles, self.texts, self.chars = conv, [], [], [], 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.first, self.last, self.low, self.high, self.turns = 0, None, None, None, None, 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.counts[fault] += 1
        if fault in ("blank", "duplicate"):
            self.letters.append(GONE)
            return
        letter = initial if initial and initial in "sua" else "o"
        self.letters.append(letter.upper() if fault else letter)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.letters) >= PIECE_ROWS or self.chars >= PIECE_CHARS

    def row(self, part: int, seq: int) -> dict:
        return {"_c": self.conv[0], "_cn": self.conv[1], "part": part, "seq": seq, "signature": "".join(self.letters), **self.counts,
                "illegal": self.illegal, "first": self.first, "last": self.last, "low": self.low, "high": self.high,
                "turns": self.turns, "roles": self.roles, "texts": self.texts}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(0, b.num_rows, OUT_ROWS):
            yield from b.slice(i, OUT_ROWS).to_pylist()


def _arrow(rows: Iterator[dict], schema: pa.Schema, most_chars: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += r.pop("_chars", 200)
        if len(held) >= OUT_ROWS or chars >= most_chars:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def pieces(rows: DataFrame) -> DataFrame:
    """Rows of ``faulty`` in the order of their conversations, cut into pieces.

    The range partitions follow (conversation, turn, role, text), so a conversation of any length is spread
    over parts; (part, seq) orders its pieces once the table is written. Equal rows go one
    after another: the first may be kept, the others are duplicates.
    """
    order = ["_c", "_cn", "_tn", "_t", "role", "_head", "_d"]
    dealt = rows.withColumn("_head", F.substring("text", 1, 64)).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def made() -> Iterator[dict]:
            piece, seq = None, 0
            for r in _records(batches):
                conv, turn = (r["_c"], r["_cn"]), r["_t"] if r["_tn"] else None
                own = "blank" if r["blank"] else "duplicate" if not r["first"] else "truncated" if r["cut"] else None
                for copy in range(r["n"]):
                    if piece is not None and (piece.conv != conv or piece.full()):
                        yield {**piece.row(part, seq), "_chars": 200 + piece.chars}
                        piece, seq = None, seq + 1
                    piece = piece or _Piece(conv)
                    piece.add(turn, r["role"], r["text"], own if copy == 0 or r["blank"] else "duplicate")
            if piece is not None:
                yield {**piece.row(part, seq), "_chars": 200 + piece.chars}

        yield from _arrow(made(), schema)

    schema = _schema(rows, PIECE_SCHEMA)
    return dealt.select("_c", "_cn", "_tn", "_t", "role", "text", "n", "first", "blank", "cut").mapInArrow(run, PIECE_SCHEMA)


def _schema(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


# ---------------------------------------------------------------- the automaton

Node = dict[str, tuple[int, str]]      # grammar state -> (cost to go, best audit suffix); a state without a way is missing


def _least(ways: list[tuple[int, str]]) -> tuple[int, str] | None:
    return min(ways, default=None)


def _inserted(node: Node) -> Node:
    """A node's ways with insertions before them: at most one more than the grammar has roles to
    write helps, since each costs more than nothing."""
    out = dict(node)
    for _ in range(3):
        for state in STATES:
            way = out.get(WRITTEN[state])
            if way is not None:
                out[state] = _least([(way[0] + INSERT, "I" + way[1]), *([out[state]] if state in out else [])])
    return out


def end_node(ending: str) -> Node:
    """Where a signature ends: the conversation's end accepts nothing and complete pairs; another ending is
    one exit state, without insertions (the next piece has them)."""
    return _inserted({"0": (0, ""), "a": (0, "")}) if ending == END else {ending: (0, "")}


def step(letter: str, after: Node) -> Node:
    """The node of ``letter`` + suffix from the suffix's node."""
    out: Node = {}
    more = TRUNCATED if letter.isupper() else 0
    for state in STATES:
        ways = []
        if (way := after.get(state)) is not None:
            ways.append((way[0] + DELETE, "D" + way[1]))
        if letter != GONE:
            role = letter.lower()
            if role in KEPT[state] and (way := after.get(role)) is not None:
                ways.append((way[0] + KEEP + more, "K" + way[1]))
            if (way := after.get(WRITTEN[state])) is not None:
                ways.append((way[0] + REROLE + more, "R" + way[1]))
        if ways:
            out[state] = _least(ways)
    return _inserted(out)


NODE_SCHEMA = "ending string, signature string, costs array<bigint>, audits array<string>"


def cost_to_go(signatures: DataFrame) -> DataFrame:
    """(ending, signature) -> cost and audit for each entry state of ``STATES`` (NULL where there is no way).

    Distinct signatures are range-partitioned and sorted by their reversed letters. Neighbours then share
    their longest common suffix, whose nodes lie on a stack of at most ``PIECE_ROWS`` nodes: each node is
    worked out once, and again only where a suffix continues in the next part.
    """
    reversed_ = signatures.select("ending", F.reverse("signature").alias("back")).distinct()
    dealt = reversed_.repartitionByRange("ending", "back").sortWithinPartitions("ending", "back")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            ending, before, stack = None, "", []
            for r in _records(batches):
                back = r["back"]
                if r["ending"] != ending:
                    ending, before, stack = r["ending"], "", [end_node(r["ending"])]
                shared = 0
                while shared < min(len(before), len(back)) and before[shared] == back[shared]:
                    shared += 1
                del stack[shared + 1:]
                for letter in back[shared:]:
                    stack.append(step(letter, stack[-1]))
                before, top = back, stack[-1]
                yield {"ending": ending, "signature": back[::-1], "costs": [top[s][0] if s in top else None for s in STATES],
                       "audits": [top[s][1] if s in top else None for s in STATES], "_chars": 200 + 5 * len(back)}

        yield from _arrow(made(), schema)

    schema = _schema(signatures, NODE_SCHEMA)
    return dealt.mapInArrow(run, NODE_SCHEMA)


# ---------------------------------------------------------------- whole conversations

def chained(plans: list[dict[str, dict[str, tuple[int, str]]]]) -> tuple[int, list[tuple[str, str]]]:
    """(cost, (entry state, audit) of each piece) from the pieces' ways: plans[i][entry][exit]. No way of a
    piece has an audit that begins another's of the same entry, so equal costs compare piece by piece."""
    after: dict[str, int] = {END: 0}
    back = []
    for plan in reversed(plans):
        now = {}
        for state, ways in plan.items():
            found = [(c + after[e], audit, e) for e, (c, audit) in ways.items() if e in after]
            if found:
                now[state] = min(found)
        back.append(now)
        after = {state: way[0] for state, way in now.items()}
    state, chosen = "0", []
    for now in reversed(back):
        _, audit, following = now[state]
        chosen.append((state, audit))
        state = following
    return after.get("0", 0), chosen


class _Repaired:
    """Hashes a conversation's repaired rows as they come."""

    def __init__(self):
        self.hash, self.any = hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any = True

    def piece(self, signature: str, audit: str, state: str, roles: list[str], texts: list[str]) -> None:
        at = kept = 0
        for edit in audit:
            if edit == "I":
                state = WRITTEN[state]
                self.write(ROLE[state], "")
                continue
            letter = signature[at]
            at += 1
            if letter == GONE:
                continue
            role, text = roles[kept], texts[kept]
            kept += 1
            if edit == "K":
                state = letter.lower()
                self.write(role, text)
            elif edit == "R":
                state = WRITTEN[state]
                self.write(ROLE[state], text)


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT_SCHEMA = ("_c string, _cn boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
                 "audit string, repaired_sha256 string")


class _Conversation:
    """One conversation's result, from that it exists (kind 0), its pieces' ways (1) and its pieces (2)."""

    def __init__(self, conv: tuple):
        self.conv, self.ways, self.chosen = conv, {}, None
        self.total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.low = self.high = self.last = None
        self.cost, self.text = 0, _Repaired()

    def add(self, r: dict) -> None:
        place = (r["part"], r["seq"])
        if r["kind"] == 1:
            mine = self.ways.setdefault(place, {})
            for state, cost, audit in zip(STATES, r["costs"], r["audits"]):
                if cost is not None:
                    mine.setdefault(state, {})[r["ending"]] = (cost, audit)
        elif r["kind"] == 2:
            if self.chosen is None:
                order = sorted(self.ways)
                self.cost, chosen = chained([self.ways[k] for k in order])
                self.chosen = dict(zip(order, chosen))
                self.ways = {}
            state, audit = self.chosen[place]
            self.text.piece(r["signature"], audit, state, r["roles"], r["texts"])
            for k in self.total:
                self.total[k] += r[k]
            if self.last is not None and self.last + r["first"] not in LEGAL:
                self.total["illegal"] += 1
            self.last = r["last"]
            if r["low"] is not None:
                self.total["turns"] -= r["low"] == self.high
                self.low, self.high = r["low"] if self.low is None else self.low, r["high"]

    def row(self) -> dict:
        audit = "".join(a for _, a in (self.chosen or {}).values())
        gaps = self.high - self.low + 1 - self.total["turns"] if self.low is not None else 0
        return {"_c": self.conv[0], "_cn": self.conv[1], "gaps": gaps, **{k: self.total[k] for k in ("blank", "duplicate", "truncated", "illegal")},
                "cost": self.cost, "audit": audit, "repaired_sha256": self.text.hash.hexdigest(), "_chars": 300 + len(audit)}


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id.

    The rows are damaged first (see ``damaged``). NULL role and text are one space, NULL conv_ids are one
    conversation, a NULL turn comes before all others; rows of one turn go by role, then text (by its first
    64 characters, then its digest). Equal rows are duplicates of the first. A conversation that loses
    all rows has zeros, an empty audit and the hash of the empty text; an empty table gives no row. Columns
    besides conv_id, turn, role and text are ignored.

    A conversation of any length is spread over many pieces until its result is put together: that
    task streams its pieces, holding their audits (as long as the result's own audit) and a running hash.
    """
    rows = damaged(conversations)
    cut = saved(pieces(faulty(rows)), "conversation-pieces")
    conv = ["_c", "_cn"]
    place = F.shiftleft(F.col("part").cast("long"), 33) + F.col("seq")
    narrow = cut.select(*conv, "part", "seq", "signature", place.alias("_place"))
    final = narrow.groupBy(*conv).agg(F.max("_place").alias("_final"))
    exits = F.when(F.col("_place") == F.col("_final"), F.array(F.lit(END))).otherwise(F.array(*map(F.lit, STATES)))
    asked = narrow.join(final, conv).select(*conv, "part", "seq", "signature", F.explode(exits).alias("ending"))
    asked = saved(asked, "conversation-endings")
    nodes = saved(cost_to_go(asked.select("ending", "signature")), "conversation-nodes")

    kinds = ["_c", "_cn", "kind", "part", "seq"]
    exist = rows.select(*conv).distinct().withColumn("kind", F.lit(0))
    ways = asked.join(nodes, ["ending", "signature"]).select(*conv, F.lit(1).alias("kind"), "part", "seq", "ending", "costs", "audits")
    parts = cut.withColumn("kind", F.lit(2))
    streams = exist.unionByName(ways, allowMissingColumns=True).unionByName(parts, allowMissingColumns=True)
    dealt = streams.repartition(*conv).sortWithinPartitions(*kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            now = None
            for r in _records(batches):
                if now is None or now.conv != (r["_c"], r["_cn"]):
                    if now is not None:
                        yield now.row()
                    now = _Conversation((r["_c"], r["_cn"]))
                now.add(r)
            if now is not None:
                yield now.row()

        yield from _arrow(made(), schema)

    schema = _schema(conversations, RESULT_SCHEMA)
    own = F.when(~F.col("_cn"), F.col("_c")).cast(conversations.schema["conv_id"].dataType).alias("conv_id")
    return dealt.mapInArrow(run, RESULT_SCHEMA).select(own, *RESULT)
