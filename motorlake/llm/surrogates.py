"""Personal data replaced by surrogates: keyed, of the same kind, gender, script and format.

A mention is found by rule, brought to a canonical form, and its surrogate is drawn from
HMAC(key, kind, canonical form, attempt). So one entity has one surrogate in the whole
corpus however it is written. A check over all distinct entities raises the attempt of those whose
surrogate is taken by another entity or is itself a real one, until none is.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import free_name, saved

#: Forms of address by gender (m, f, n unknown); a name follows.
TITLES = {
    "Mr": "m", "Mr.": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr.": "m", "господин": "m", "г-н": "m", "Κύριος": "m",
    "Mrs": "f", "Mrs.": "f", "Ms": "f", "Ms.": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra.": "f",
    "госпожа": "f", "г-жа": "f", "Κυρία": "f", "Dr": "n", "Dr.": "n", "Prof.": "n", "Professor": "n",
}
#: Phrases that a person's full name follows.
INTRODUCTIONS = ["my name is", "My name is", "Name:", "je m'appelle", "Je m'appelle", "ich heiße", "Ich heiße", "me llamo", "Me llamo", "меня зовут", "Меня зовут"]
#: Common given names whose gender is plain.
GIVEN = {
    "m": "James John Robert Michael William David Thomas Daniel Paul Mark Peter Hans Jürgen Klaus Stefan Pierre Jean Louis Antoine François Carlos Juan José Luis Miguel Иван Сергей Алексей Дмитрий".split(),
    "f": "Mary Anna Maria Linda Susan Sarah Emma Laura Julia Alice Petra Sabine Ursula Monika Claire Marie Sophie Camille Élise Carmen Lucía Elena Isabel Rosa Анна Ольга Елена Наталья Мария".split(),
}
#: Syllables and endings that surrogate names are made of, by script.
SYLLABLES = {
    "latin": "ba be bi bo da de do fa fe ga go ha he ja jo ka ke ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi wa we za ze".split(),
    "cyrillic": "ба бе би бо ва ве ви го да де до жа за зе ка ке ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се со та те ти то фа ха че ша".split(),
    "greek": "βα βε βι γα γε δα δε ζα θα θε κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε ρι σα σε τα τε τι φα χα".split(),
}
GIVEN_END = {"latin": {"m": ["n", "r", "s", "l"], "f": ["ria", "lia", "na", "sa"], "n": ["x", "t"]},
             "cyrillic": {"m": ["н", "р", "й"], "f": ["на", "рия", "ля"], "n": ["с", "т"]},
             "greek": {"m": ["ς", "ος"], "f": ["να", "ρα"], "n": ["ι", "ω"]}}
FAMILY_END = {"latin": {"m": ["man", "sen", "ter"], "f": ["man", "sen", "ter"], "n": ["man", "sen", "ter"]},
              "cyrillic": {"m": ["ров", "нин"], "f": ["рова", "нина"], "n": ["енко", "ич"]},
              "greek": {"m": ["δης", "κος"], "f": ["δου", "κου"], "n": ["ίδη", "άκη"]}}

#: Country calling codes of one and of two digits; all others have three.
CALLING_CODES = {1: ["1", "7"], 2: ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                                    "81 82 84 86 90 91 92 93 94 95 98").split()}
GROW = 4                  # draws of the mention's own size before a surrogate grows
_NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_]+(?:-[^\W\d_a-zа-яα-ω][^\W\d_]+)?"
_ALNUM = r"A-Za-z0-9"
_NUMBERS = re.compile(
    r"(?<![\w.])(?P<ip>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3})(?![\w]|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![\w.-])(?P<card>\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{13,19})(?![\w-])"
    r"|(?<![\w.])(?P<phone>\+\d{1,3}(?:[ .-]?\(?\d{2,5}\)?)(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w])"
    r"|(?<!\w)(?P<secret>(?=[0-9A-Fa-f]*\d)(?:[0-9a-f]{24,}|[0-9A-F]{24,}))(?!\w)"
    r"|(?<!\w)(?P<key>(?:AKIA|ghp_|sk-|xoxb-)[A-Za-z0-9-]{12,})(?!\w)")
_EMAIL = re.compile(rf"(?<![{_ALNUM}._%+-])[{_ALNUM}._%+-]{{1,64}}@[{_ALNUM}-]+(?:\.[{_ALNUM}-]+)*\.[A-Za-z]{{2,24}}(?![\w-])")
_TITLED = re.compile(r"(?<!\w)(?P<title>" + "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True)) + rf")[  ](?P<a>{_NAME})(?: (?P<b>{_NAME}))?(?!\w)")
_INTRODUCED = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, INTRODUCTIONS)) + rf") (?P<a>{_NAME})(?: (?P<b>{_NAME}))?(?!\w)")
_GENDER = {n.casefold(): g for g, names in GIVEN.items() for n in names}
_KNOWN = re.compile(r"(?<!\w)(?P<a>" + "|".join(sorted(map(re.escape, GIVEN["m"] + GIVEN["f"]), key=len, reverse=True)) + rf") (?P<b>{_NAME})(?!\w)")
_DIGIT = re.compile(r"\d")


def script_of(text: str) -> str:
    for ch in text:
        name = unicodedata.name(ch, "")
        for s in ("LATIN", "CYRILLIC", "GREEK"):
            if name.startswith(s):
                return s.lower()
    return "other"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def calling_code(digits: str) -> int:
    """How many digits the country code at the start has."""
    return next((n for n, codes in CALLING_CODES.items() if digits[:n] in codes), 3)


def same_script(ch: str) -> list[str]:
    """The letters of ``ch``'s kind in its block of 128 code points."""
    start, kind = ord(ch) & ~127, unicodedata.category(ch)
    return [c for c in map(chr, range(start, start + 128)) if unicodedata.category(c) == kind]


def canonical(kind: str, text: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return ("+" if text.startswith("+") else "") + re.sub(r"\D", "", text)
    if kind == "ip":
        return ".".join(str(int(x)) for x in text.split("."))
    return text if kind == "key" else unicodedata.normalize("NFC", text).casefold()


def family_kind(name: str) -> str:
    """Gender of a family name by its ending where its script marks it; the title plays no part, so
    a name has one surrogate whoever bears it."""
    script, end = script_of(name), name.casefold()
    gender = {"cyrillic": "f" if end.endswith(("а", "я")) else "m", "greek": "f" if end.endswith("ου") else "m"}.get(script, "n")
    return f"family:{gender}:{script}"


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the mentions in a text, not overlapping, in order.

    Kinds: email, ip, ssn, card, phone, secret, key, and given:<gender>:<script> and
    family:<gender>:<script> for the parts of a name. Once a name is known by its title, an
    introduction or a given name, its parts are found wherever they stand in the text.
    """
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", canonical("email", m[0])) for m in _EMAIL.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), m.lastgroup, canonical(m.lastgroup, m[0])) for m in _NUMBERS.finditer(text)]
    parts: dict[str, str] = {}
    for rule in (_TITLED, _INTRODUCED, _KNOWN):
        for m in rule.finditer(text):
            a, b = m["a"], m["b"]
            gender = TITLES.get(m.groupdict().get("title") or "", "n")
            if gender == "n":
                gender = _GENDER.get(a.casefold(), "n")
            if b or a.casefold() in _GENDER:
                parts.setdefault(a, f"given:{gender}:{script_of(a)}")
            for name in [b] if b else [] if a.casefold() in _GENDER else [a]:
                parts.setdefault(name, family_kind(name))
    if parts:
        kinds = {canonical("name", p): k for p, k in reversed(parts.items())}
        forms = {f for p in parts for f in (p, p.upper())}
        for m in re.finditer(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, forms), key=len, reverse=True)) + r")(?!\w)", text):
            c = canonical("name", m[0])
            found.append((m.start(), m.end(), kinds[c], c))
    found.sort(key=lambda x: (x[0], -x[1]))
    out, end = [], 0
    for f in found:
        if f[0] >= end:
            out.append(f)
            end = f[1]
    return out


class _Stream:
    """Numbers drawn from HMAC-SHA256 in counter mode."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        part, *rest = kind.split(":")          # a name's gender only chooses its ending
        self._key, self._seed = key, f"{':'.join([part, *rest[1:]])}\0{value}\0{attempt}\0".encode()
        self._block, self._n = b"", 0

    def below(self, n: int) -> int:
        if len(self._block) < 4:
            self._block += hmac.new(self._key, self._seed + self._n.to_bytes(4, "big"), hashlib.sha256).digest()
            self._n += 1
        x, self._block = int.from_bytes(self._block[:4], "big"), self._block[4:]
        return x % n

    def same_class(self, ch: str) -> str:
        if ch.isdigit():
            return str(self.below(10))
        if "a" <= ch <= "z":
            return chr(97 + self.below(26))
        if "A" <= ch <= "Z":
            return chr(65 + self.below(26))
        return ch


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The canonical surrogate of a canonical value.

    After every ``GROW`` attempts it is a character longer (addresses of hosts: from a wider range, at last of
    version 6), so the draws never run out however many values of one size a corpus has.
    """
    s, more = _Stream(key, kind, value, attempt), attempt // GROW
    if kind == "ip":
        a = value.split(".")
        if more >= 3:
            return "fd" + "".join("0123456789abcdef"[s.below(16)] for _ in range(2)) + "".join(":" + f"{s.below(65536):x}" for _ in range(7))
        keep = 2 if value.startswith("192.168.") else 1 if a[0] in ("10", "127") else 0
        if more and keep:
            a, keep = ["10", *a[1:]], 1 if more == 1 else 0
        return ".".join(x if i < keep else str(1 + s.below(223 if i == 0 else 254)) for i, x in enumerate(a))
    if kind == "phone":
        keep = 1 + calling_code(value[1:]) if value.startswith("+") else 0
        return value[:keep] + "".join(s.same_class(c) for c in value[keep:] + "0" * more)
    if kind == "ssn":
        return "".join(s.same_class(c) for c in value + "0" * more)
    if kind == "card":
        body = value[0] + "".join(s.same_class(c) for c in value[1:-1] + "0" * more)
        valid = next(str(d) for d in range(10) if luhn(body + str(d)))
        if luhn(value):
            return body + valid
        return body + str((int(valid) + 1 + s.below(9)) % 10)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        fixed = 2 if labels[-2] == "example" else 1        # reserved example domains stay, others keep their top level
        # labels of a domain depend on the domain only, so one organisation stays one
        d = _Stream(key, "domain", ".".join(labels[:-fixed]), 0)
        return "".join(map(s.same_class, local + "a" * more)) + "@" + ".".join(["".join(map(d.same_class, x)) for x in labels[:-fixed]] + labels[-fixed:])
    if kind == "secret":
        return "".join("0123456789abcdef"[s.below(16)] for _ in range(len(value) + more))
    if kind == "key":
        head = re.match(r"AKIA|ghp_|sk-|xoxb-", value)[0]
        return head + "".join(map(s.same_class, value[len(head):] + "A" * more))
    if kind.startswith(("given:", "family:")):
        part, gender, script = kind.split(":")
        if script in SYLLABLES:
            ends = (GIVEN_END if part == "given" else FAMILY_END)[script][gender]
            n = 2 + s.below(2) + more                      # longer names once the short ones are taken
            return "".join(SYLLABLES[script][s.below(len(SYLLABLES[script]))] for _ in range(n)) + ends[s.below(len(ends))]
        letters = [c for c in value if c.isalpha()]
        drawn = [(same := same_script(c))[s.below(len(same))] if c.isalpha() else c for c in value + letters[-1] * more]
        return "".join(drawn)
    return "".join(map(s.same_class, value + "a" * more))


def render(kind: str, mention: str, new: str) -> str:
    """Write a canonical surrogate the way the mention is written: separators, case, leading zeros."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if kind in ("ip", "key"):
        return new
    if len(mention) > 1 and mention.upper() == mention and mention.lower() != mention:
        return new.upper()
    if kind.startswith(("given:", "family:")) and mention[:1] != mention[:1].lower():
        return "-".join(x[:1].upper() + x[1:] for x in new.split("-"))
    if kind == "email" and mention[:1].isupper():
        return new[:1].upper() + new[1:]
    return new


def assign_attempts(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, surrogate) of distinct (kind, value): no surrogate is shared by two values of a
    kind, and none is a value of that kind itself.

    Each round draws for the values still open, drops draws that are real or already given, and lets
    the least value of those with equal draws have it; the others draw again. What moves is one
    short row an entity; equal draws meet by hash, never in one group of everything.
    """
    pool = F.when(F.instr("kind", ":") > 0, F.concat(F.split("kind", ":")[0], F.lit(":"), F.split("kind", ":")[2])).otherwise(F.col("kind"))
    real = saved(entities.select(pool.alias("pool"), F.col("value").alias("drawn")).distinct(), "real-values")
    left, given, attempt = entities, None, 0

    def draw(n: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                kinds, values = b.column(0).to_pylist(), b.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([canonical("name", surrogate(key, k, v, n)) if k != "key" else surrogate(key, k, v, n)
                                                                                              for k, v in zip(kinds, values)], pa.string())], names=["kind", "value", "pool", "drawn"])
        return run

    while True:
        drawn = saved(left.select("kind", "value", pool.alias("pool")).mapInArrow(draw(attempt), "kind string, value string, pool string, drawn string"), "drawn")
        taken = real if given is None else real.union(given.select("pool", "drawn"))
        free = drawn.join(taken, ["pool", "drawn"], "left_anti")
        who = F.concat_ws("\u0000", "value", "kind")
        winners = saved(free.groupBy("pool", "drawn").agg(F.min(who).alias("who")), "winners")
        won = saved(drawn.join(winners, ["pool", "drawn"]).filter(who == F.col("who")).select("kind", "value", "pool", "drawn", F.lit(attempt).alias("attempt")), "given")
        given = won if given is None else given.union(won)
        left = saved(drawn.join(won, ["kind", "value"], "left_anti").select("kind", "value"), "open")
        if left.isEmpty():
            return given.select("kind", "value", "attempt", F.col("drawn").alias("surrogate"))
        attempt += 1


def entity_genders(found: DataFrame) -> DataFrame:
    """(kind, value, mixed) of the distinct entities of ``found`` (kind, value): a name has one gender in the whole
    corpus, that of most texts that show one (n on a tie); ``mixed`` where some text alone would say another."""
    split = F.split("kind", ":")
    name = F.col("kind").rlike("^(given|family):")
    gender = F.when(name, split[1])
    plain = F.when(name, F.concat_ws(":", split[0], split[2])).otherwise(F.col("kind"))
    count = lambda g: F.count_if(F.coalesce(F.col("gender") == g, F.lit(False)))
    sums = found.select(plain.alias("plain"), "value", gender.alias("gender")).groupBy("plain", "value").agg(
        count("m").alias("m"), count("f").alias("f"), count("n").alias("n"))
    decided = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("n")
    parts = F.split("plain", ":")
    kind = F.when(F.size(parts) == 2, F.concat_ws(":", parts[0], decided, parts[1])).otherwise(F.col("plain"))
    mixed = (F.col("m") > 0).cast("int") + (F.col("f") > 0).cast("int") + (F.col("n") > 0).cast("int") > 1
    return sums.select(kind.alias("kind"), "value", mixed.alias("mixed"), "plain")


def plain_kind(kind: str) -> str:
    """A kind without its gender."""
    part, *rest = kind.split(":")
    return ":".join([part, *rest[1:]])


def replace_personal_data(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with every mention replaced, plus ``n_entities`` (mentions replaced).

    Replacement keeps kind, script, gender, letter case, separators, country code, card check digit
    (valid stays valid), reserved domains and private address ranges, as long as a format has surrogates left
    (see ``surrogate``). Equal entities get equal surrogates in all documents, whatever title they bear, different
    ones different surrogates, and no surrogate of a first draw or a later one equals a real value of its kind.
    Only entities that needed a second draw, or whose gender one text alone does not tell, are joined
    back to their documents; all others are redrawn from the key where they stand.

    NULL and empty texts pass unchanged with 0 entities; rows may repeat, ids may be NULL. All columns
    are kept; a clashing ``n_entities`` is replaced. An empty key is an error.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    kind_of_id = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, k, v) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, v in sorted({m[2:] for m in mentions(t)})]
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                             names=["doc_id", "kind", "value"])

    found = saved(docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind_of_id}, kind string, value string"), "mentions")
    entities = saved(entity_genders(found), "entities")
    drawn = assign_attempts(entities.select("kind", "value"), key).select("kind", "value", "attempt")
    told = saved(drawn.join(entities, ["kind", "value"]).filter("attempt > 0 OR mixed").select("plain", "value", "attempt", "kind"), "later-draws")
    split = F.split("kind", ":")
    plain = F.when(F.size(split) == 3, F.concat_ws(":", split[0], split[2])).otherwise(F.col("kind"))
    again, doc = free_name(docs, "entities_told"), free_name(docs, "told_of")
    back = saved(found.select("doc_id", plain.alias("plain"), "value").distinct().join(told, ["plain", "value"])
                 .groupBy("doc_id").agg(F.collect_set(F.struct("plain", "value", "attempt", "kind")).alias(again)), "again").withColumnRenamed("doc_id", doc)
    joined = docs.join(back, docs["doc_id"].eqNullSafe(F.col(doc)), "left")
    own = [c for c in docs.columns if c != "n_entities"]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = own.index("text")
        for b in batches:
            texts, counts = [], []
            for text, others in zip(b.column(at).to_pylist(), b.column(len(own)).to_pylist()):
                known = {(x["plain"], x["value"]): (x["kind"], x["attempt"]) for x in others or ()}
                out, end, hits = [], 0, mentions(text)
                for s, e, kind, value in hits:
                    kind, attempt = known.get((plain_kind(kind), value), (kind, 0))
                    out += [text[end:s], render(kind, text[s:e], surrogate(key, kind, value, attempt))]
                    end = e
                texts.append("".join([*out, text[end:]]) if hits else text)
                counts.append(len(hits))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(own))] + [pa.array(counts, pa.int64())],
                                             names=[*names, "n"])

    # columns go through Arrow under plain names: a name with a dot does not
    names = [f"c{i}" for i in range(len(own))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, own)) + ", n bigint"
    rows = joined.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, own)], F.col(again).alias("told"))
    return rows.mapInArrow(rewrite, schema).toDF(*own, "n_entities")
