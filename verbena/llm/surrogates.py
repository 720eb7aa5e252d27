"""Surrogates for personal data and secrets.

Detected entities get keyed replacements of the same type and format: a keyed
permutation of the values of the entity's own format (digits stay digits,
letters keep their case, hex stays hex, octets stay octets, card numbers stay
valid if they were), so equal values get equal surrogates in the whole corpus
and different values different ones.  Names after a title get generated names
of the same script, gender and case.  The distinct entities are then checked:
a surrogate that is itself an entity of the corpus, or that two entities share,
is drawn again until there is none.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .common import BROADCAST_ROWS, give_back, materialise, out_batch, texts

ROUNDS = 8  # draws until a surrogate may equal another entity's original (only in formats with too few values)

# Titles by gender
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Госпожа", "Κυρία"],
          "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]}
# Syllables and name endings by script
SYLLABLES = {
    "latin": ["al", "be", "cor", "da", "el", "fi", "ga", "ho", "ir", "ja", "ke", "lo", "mar", "ne", "or", "pe", "ra", "si",
              "to", "ul", "ve", "wi", "yo", "za"],
    "cyrillic": ["ал", "бе", "ва", "га", "до", "жи", "за", "ир", "ка", "ле", "ми", "но", "ор", "па", "ре", "со", "та", "фе"],
    "greek": ["αλ", "βε", "γα", "δι", "ευ", "ζω", "θε", "κα", "λε", "μι", "νι", "παρ", "ρο", "σω", "τα", "φι", "χα", "ωρ"]}
ENDINGS = {"latin": {"f": "a", "m": "n", "s": "ler"}, "cyrillic": {"f": "на", "m": "в", "s": "ко"},
           "greek": {"f": "α", "m": "ος", "s": "ίδης"}}

_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯΑ-Ω]\w*"
_NAME = "|".join(sorted((t for v in TITLES.values() for t in v), key=len, reverse=True))
PATTERN = re.compile("|".join([
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9-]))",
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d))",
    r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\w)\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
    r"|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-]))",
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))",
    r"(?P<card>(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-]))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<hex>(?<!\w)(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?!\w))",
    r"(?i:(?:token|secret|passwd|password|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3})[\"']?(?P<secret>[A-Za-z0-9+/_=-]{8,})",
    r"(?P<key>(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,})(?!\w))",
    rf"(?<!\w)(?P<title>{_NAME})\.?[ ](?P<name>{_CAP}(?:[ ]{_CAP})?)",
]))
_KINDS = ("email", "ip", "phone", "iban", "card", "ssn", "hex", "secret", "key")
_TITLE_WORDS = [t.encode() for v in TITLES.values() for t in v]
_MARK = np.zeros(256, dtype=bool)
_MARK[48:58] = _MARK[ord("@")] = _MARK[ord("=")] = _MARK[ord(":")] = True


def permuted(n: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of 0..size-1 (Feistel rounds, walked until inside)."""
    if size < 2:
        return n
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    person = hashlib.blake2b(tweak, key=key, digest_size=32).digest()
    while True:
        a, b = n >> half, n & mask
        for i in range(8):
            f = hashlib.blake2b(b.to_bytes(width, "big") + bytes([i]), key=person, digest_size=min(64, width)).digest()
            a, b = b, a ^ (int.from_bytes(f, "big") & mask)
        n = (a << half) | b
        if n < size:
            return n


def _alphabet(c: str) -> str:
    if "0" <= c <= "9":
        return "0123456789"
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else c


def keyed_text(value: str, key: bytes, tweak: str, alphabet: str | None = None) -> str:
    """Permute a value within its format; characters of no alphabet stay.  Long values go block by block, each
    block tied to the ones before it."""
    out = []
    for a in range(0, len(value), 64):
        part = value[a: a + 64]
        sets = [alphabet or _alphabet(c) for c in part]
        n, size = 0, 1
        for c, s in zip(part, sets, strict=True):
            n, size = n * len(s) + s.index(c), size * len(s)
        n = permuted(n, size, key, f"{tweak}|{a}|{value[:a]}|{len(value)}".encode())
        chars = []
        for s in reversed(sets):
            n, r = divmod(n, len(s))
            chars.append(s[r])
        out.append("".join(reversed(chars)))
    return "".join(out)


def luhn_digit(digits: str) -> str:
    total = sum(d if i % 2 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def _script(name: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", name) else "greek" if re.search("[Ͱ-Ͽ]", name) else "latin"


def _name(value: str, kind: str, key: bytes, attempt: int) -> str:
    script, gender = _script(value), kind[-1]
    syllables = SYLLABLES[script]
    n = int.from_bytes(hashlib.blake2b(f"{kind}|{value.casefold()}|{attempt}".encode(), key=key, digest_size=8).digest(), "big")
    made = ""
    for _ in range(3 + attempt // 2):
        n, r = divmod(n, len(syllables))
        made += syllables[r]
    made = (made + ENDINGS[script][gender]).capitalize()
    return made.upper() if len(value) > 1 and value.isupper() else made


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of an entity: a function of the key, its kind, its value and the draw."""
    tweak = f"{kind}|{attempt}"
    if kind.startswith("name"):
        return _name(value, kind, key, attempt)
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        host, tld = domain.rsplit(".", 1)
        return f"{keyed_text(local, key, f'{tweak}|{domain}')}@{keyed_text(host, key, 'domain|' + tld)}.{tld}"
    if kind == "ip":
        n = int.from_bytes(bytes(map(int, value.split("."))), "big")
        return ".".join(map(str, permuted(n, 1 << 32, key, tweak.encode()).to_bytes(4, "big")))
    if kind == "phone" and value.startswith("+"):
        cc = re.match(r"\+\d{1,3}(?=\D)|\+\d", value)[0]
        return cc + keyed_text(value[len(cc):], key, f"{tweak}|{cc}")
    if kind == "iban":
        return value[:2] + keyed_text(value[2:], key, f"{tweak}|{value[:2]}")
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        if luhn_digit(digits[:-1]) == digits[-1]:
            made = keyed_text(digits[:-1], key, f"{tweak}|luhn")
            made = iter(made + luhn_digit(made))
            return "".join(next(made) if c.isdigit() else c for c in value)
        return keyed_text(value, key, tweak)
    if re.fullmatch("[0-9a-f]{16,}", value):
        return keyed_text(value, key, tweak, "0123456789abcdef")
    if re.fullmatch("[0-9A-F]{16,}", value):
        return keyed_text(value, key, tweak, "0123456789ABCDEF")
    return keyed_text(value, key, tweak)


def entities(text: str):
    """``(start, end, kind)`` of every entity, left to right."""
    for m in PATTERN.finditer(text):
        if m["name"]:
            gender = "f" if m["title"] in TITLES["f"] else "m"
            start = m.start("name")
            parts = m["name"].split(" ")
            for i, p in enumerate(parts):
                yield start, start + len(p), f"name-{gender}" if i < len(parts) - 1 else "name-s"
                start += len(p) + 1
        else:
            kind = next(k for k in _KINDS if m[k] is not None)
            yield m.start(kind), m.end(kind), "secret" if kind in ("hex", "key") else kind


def _suspects(offsets: np.ndarray, data: memoryview) -> list[int]:
    """Rows that may hold an entity: a digit, an @ or = or : sign, or a title."""
    off = offsets.tolist()
    mark = np.append(0, np.cumsum(_MARK[np.frombuffer(data, np.uint8)[off[0]: off[-1]]], dtype=np.int64)) \
        if off[-1] > off[0] else np.zeros(1, np.int64)
    has = mark[offsets[1:] - off[0]] > mark[offsets[:-1] - off[0]]
    return [i for i, h in enumerate(has.tolist())
            if h or any(t in bytes(data[off[i]: off[i + 1]]) for t in _TITLE_WORDS)]


def find_entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind, value``: the distinct entities of all rows."""
    schema = StructType([StructField("kind", StringType()), StructField("value", StringType())])

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, 0)
            seen = set()
            for i in _suspects(offsets, data):
                text = bytes(data[offsets[i]: offsets[i + 1]]).decode()
                seen.update((kind, text[a:b]) for a, b, kind in entities(text))
            if seen:
                yield out_batch(schema, [pa.array(x, pa.string()) for x in zip(*seen, strict=True)])
        give_back()

    return docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, schema).distinct()


def _draw(table: DataFrame, key: bytes) -> DataFrame:
    schema = StructType([*table.schema.fields, StructField("made", StringType())])

    def run(batches):
        for batch in batches:
            made = [surrogate(k, v, key, n) for k, v, n in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield out_batch(schema, [*batch.columns, pa.array(made, pa.string())])
        give_back()

    return table.mapInArrow(run, schema)


def settle(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, attempt``: the draw of each distinct entity, after the collision checks."""
    found = materialise(found, "entities")
    group = F.regexp_replace("kind", "^name.*", "name")
    state = _draw(found.withColumn("attempt", F.lit(0)), key)
    for turn in range(4 * ROUNDS):
        state = materialise(state.withColumn("group", group), "draws")
        originals = found.select(group.alias("group"), F.lower("value").alias("low")).distinct()
        low = F.lower("made")
        shared = state.groupBy("group", low.alias("low")).agg(
            F.min(F.struct("attempt", "kind", F.lower("value"))).alias("owner"), F.count("*").alias("n"))
        mine = F.struct("attempt", "kind", F.lower("value"))
        clash = state.withColumn("low", low).join(shared.where("n > 1"), ["group", "low"]) \
            .where(F.col("owner") != mine).select("kind", "value")
        if turn < ROUNDS:
            clash = clash.unionAll(state.withColumn("low", low).join(originals, ["group", "low"]).select("kind", "value"))
        again = materialise(clash.distinct(), "clashes")
        state = state.drop("group")
        if again.isEmpty():
            break
        redraw = state.join(again, ["kind", "value"]).select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        state = state.join(again, ["kind", "value"], "left_anti").unionAll(_draw(redraw, key))
    return state.select("kind", "value", "attempt")


def replace_entities(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None,
                     broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with surrogates in ``text_col`` (all columns kept; ``count_col`` adds the number of entities).

    Null and empty texts stay as they are.  Equal entities get equal surrogates
    in all rows, different ones different surrogates (names compare without
    case), and no surrogate is an entity of the corpus, unless its format has
    too few values for that.  Entities that had to be drawn again are few and
    go to the tasks; if they are more than ``broadcast_rows`` they are joined
    to the rows that need them.
    """
    settled = materialise(settle(find_entities(docs, text_col), key).where("attempt > 0"), "redrawn")
    names, at = docs.columns, docs.columns.index(text_col)
    fields = list(docs.schema.fields)
    fields[at] = StructField(text_col, StringType(), True)
    schema = StructType([*fields, *([StructField(count_col, IntegerType())] if count_col else [])])
    if settled.count() <= broadcast_rows:
        few = {(r["kind"], r["value"]): r["attempt"] for r in settled.collect()}
        source = docs
    else:
        few, source = None, _with_draws(docs, settled, text_col)

    def run(batches):
        made: dict[tuple[str, str, int], str] = {}
        for batch in batches:
            offsets, data = texts(batch, at)
            changed, count = {}, np.zeros(batch.num_rows, dtype=np.int64)
            own = None if few is not None else batch.column(len(names))
            for i in _suspects(offsets, data):
                text = bytes(data[offsets[i]: offsets[i + 1]]).decode()
                draws = few if own is None else {(x["kind"], x["value"]): x["attempt"] for x in own[i].as_py() or ()}
                out, last = [], 0
                for a, b, kind in entities(text):
                    item = (kind, text[a:b], draws.get((kind, text[a:b]), 0))
                    if item not in made:
                        if len(made) > 200_000:
                            made.clear()
                        made[item] = surrogate(*item[:2], key, item[2])
                    out += text[last:a], made[item]
                    last = b
                    count[i] += 1
                if out:
                    changed[i] = "".join(out) + text[last:]
            cols = list(batch.columns[: len(names)])
            if changed:
                kept = cols[at].cast(pa.large_string()).to_pylist()
                for i, t in changed.items():
                    kept[i] = t
                cols[at] = pa.array(kept, pa.large_string())
            yield out_batch(schema, [*cols, *([pa.array(count)] if count_col else [])])
        made.clear()
        give_back()

    return source.mapInArrow(run, schema)


def _with_draws(docs: DataFrame, settled: DataFrame, text_col: str) -> DataFrame:
    """``docs`` and a list of the redrawn entities of each row's text, joined by the text's hash."""
    schema = StructType([StructField("__vl_h", StringType()), StructField("kind", StringType()),
                         StructField("value", StringType())])

    def run(batches):
        for batch in batches:
            rows = {(h, kind, t[a:b]) for h, t in zip(*[c.to_pylist() for c in batch.columns], strict=True)
                    for a, b, kind in entities(t)}
            if rows:
                yield out_batch(schema, [pa.array(x, pa.string()) for x in zip(*rows, strict=True)])
        give_back()

    h = F.sha2(docs[text_col].cast("string"), 256)
    has = docs.select(h.alias("__vl_h"), docs[text_col].cast("string").alias("t")).where("t is not null").mapInArrow(run, schema)
    lists = has.join(settled, ["kind", "value"]).groupBy("__vl_h").agg(
        F.collect_set(F.struct("kind", "value", "attempt")).alias("__vl_draws"))
    return docs.withColumn("__vl_h", h).join(lists, "__vl_h", "left").select(*docs.columns, "__vl_draws")
