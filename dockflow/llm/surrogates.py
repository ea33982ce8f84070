"""Personal data replaced by surrogates of the same type and look.

A surrogate depends on a key and the entity alone, so an entity gets the same
one wherever it occurs. Numbers, addresses and secrets are permuted within
their format: a keyed Feistel network walks over the strings with the same
kinds of characters in the same places, which maps different entities to
different surrogates without looking at the others, and none to itself. Kinds
are letters of one script and case, and decimal digits of one script. Names are drawn from given
names of the same gender and script and from spelt surnames. Within a document a
neutral title takes the gender known for its name, and a surname alone takes that
of the one full name it fits. Draws may collide,
so a Spark job over all distinct entities checks every surrogate, and the later
of two entities that share one draws again.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections import defaultdict
from functools import lru_cache
from math import gcd

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from dockflow.llm.common import cut, over_texts

KEY = b"surrogates"
#: Redrawn entities that may be sent to all tasks; beyond it surnames get longer.
MOST_REDRAWN = 10_000

_L = r"[^\W\d_]"
_NAME = rf"(?:{_L}[^\W\d_'’-]*(?:['’-]{_L}+)*)"
# Forms of address by gender.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Signora", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof"],
}
# Given names by script and gender.
GIVEN = {
    "LATIN": {
        "m": "Adam Ben Carl David Emil Felix Georg Hugo Ivan Jonas Karim Leo Marco Noel Oscar Pablo Robin Simon Tom Victor".split(),
        "f": "Ada Bella Clara Diana Emma Flora Greta Hanna Ines Julia Kira Lena Maria Nora Olga Paula Rosa Sofia Tina Vera".split(),
    },
    "CYRILLIC": {"m": "Антон Борис Виктор Глеб Иван Олег Павел Роман".split(), "f": "Анна Вера Дарья Елена Ирина Ольга Мария Софья".split()},
    "GREEK": {"m": "Άρης Γιάννης Δήμος Κώστας Νίκος Πέτρος".split(), "f": "Άννα Ελένη Ζωή Κατερίνα Μαρία Σοφία".split()},
}
_SOUNDS = {
    "LATIN": ("b c d f g h j k l m n p r s t v w z br dr gr kl st tr".split(), "a e i o u ai ei ou".split()),
    "CYRILLIC": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у я".split()),
    "GREEK": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε ι ο υ η ω".split()),
}
_GENDER = {t.lower(): g for g, ts in TITLES.items() for t in ts}
_TITLE = "|".join(sorted((re.escape(t) for ts in TITLES.values() for t in ts), key=len, reverse=True))

PATTERNS = [
    ("email", r"(?<![\w.+-])[\w.+-]*\w@(?:[\w-]+\.)+[^\W\d_]{2,}"),
    ("secret", r"\bAKIA[0-9A-Z]{16}\b"),
    ("assigned", r"""(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b["']?\s*[=:]\s*["']?)(?P<value>[\w/+.-]*[\w/+-]{6,})"""),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}[-.]\d{4}(?!\w)|(?<![\w.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)"),
    ("card", r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    ("name", rf"\b(?P<title>{_TITLE})\b(?P<gap>\.? )(?P<person>{_NAME}(?: {_NAME})?)"),
]
_ANY = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in PATTERNS))
# Without one of these there is no mention: keywords of assignments in any case,
# heads of names and secrets, and a digit or an @ for all other kinds.
_KEYWORDS = ["password", "passwd", "pwd", "token", "secret", "api"]
_HEADS = ["AKIA", *(t for ts in TITLES.values() for t in ts)]
_SIGN = re.compile(r"[\d@]")


def _hash(key: bytes, *parts: str) -> int:
    return int.from_bytes(hmac.new(key, "\0".join(parts).encode(), hashlib.sha256).digest()[:16], "big")


def permuted(key: bytes, purpose: str, x: int, size: int) -> int:
    """A keyed bijection of ``range(size)``: Feistel rounds on as many bits as
    are needed, walked until the result is in range."""
    return _walked(key, purpose, x, size, False)


def _walked(key: bytes, purpose: str, x: int, size: int, back: bool) -> int:
    """``permuted``, or its inverse."""
    if size < 2:
        return x
    half = (max((size - 1).bit_length(), 2) + 1) // 2
    mask = (1 << half) - 1

    def round_(i: int, b: int) -> int:
        digest = hashlib.blake2b(f"{purpose}\0{size}\0{i}\0{b}".encode(), key=key[:64], digest_size=-(-half // 8) or 1).digest()
        return int.from_bytes(digest, "big") & mask

    while True:
        a, b = x >> half, x & mask
        for i in reversed(range(8)) if back else range(8):
            a, b = (b ^ round_(i, a), a) if back else (b, a ^ round_(i, b))
        x = (a << half) | b
        if x < size:
            return x


def moved(key: bytes, purpose: str, x: int, size: int) -> int:
    """A keyed bijection of ``range(size)`` that leaves nothing in its place: one
    cycle through all of it, in the order of ``permuted``."""
    if size < 2:
        return x
    step = 1 + _hash(key, "step", purpose, str(size)) % (size - 1)
    while gcd(step, size) > 1:
        step = step % (size - 1) + 1
    return _walked(key, purpose, (permuted(key, purpose, x, size) + step) % size, size, True)


_DIGITS, _LOWER, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"


_FIXED = [_DIGITS, _LOWER, _LOWER.upper(), "àáâäçèéêëìíîïñòóôöùúûüß", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"]
_FIXED += [c for low in ("абвгдежзиклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω") for c in (low, low.upper())]


@lru_cache(1)
def _alphabets() -> dict[str, str]:
    """Every letter and number with those that may take its place: of its script,
    category (which tells the case) and block of 256. The few that are alone there,
    or change their length with their case, take each other's."""
    own = {c: alphabet for alphabet in _FIXED for c in alphabet}
    kinds, odd = defaultdict(list), defaultdict(list)
    for c in map(chr, range(0x110000)):
        if c.isalnum() and c not in own:
            category = unicodedata.category(c)
            if c.isdecimal():
                kinds["digits", ord(c) - unicodedata.decimal(c)].append(c)
            elif (category == "Ll" and c.upper().lower() != c) or (category == "Lu" and c.lower().upper() != c):
                odd[category].append(c)
            else:
                kinds[category, unicodedata.name(c, "").split(" ")[0], ord(c) >> 8].append(c)
    for kind, found in list(kinds.items()):
        if len(found) < 2:
            odd[kind[0] if kind[0] in odd else "other"] += kinds.pop(kind)
    for found in [*kinds.values(), *odd.values()]:
        own |= dict.fromkeys(found, "".join(found))
    return own


def _alphabet(c: str) -> str:
    """The characters that may take the place of c; c alone if it is a sign."""
    if c in _DIGITS:
        return _DIGITS
    if c in _LOWER:
        return _LOWER
    if c.isascii() and c.isupper():
        return _LOWER.upper()
    return _alphabets().get(c, c) if c.isalnum() else c


def same_format(key: bytes, kind: str, text: str, alphabets: list[str] | None = None) -> str:
    """Another text with the same kinds of characters in the same places."""
    alphabets = alphabets or [_alphabet(c) for c in text]
    x, size = 0, 1
    for c, own in zip(text, alphabets):
        x, size = x * len(own) + own.index(c), size * len(own)
    shape = "".join(own if len(own) == 1 else f"[{own[0]}{len(own)}]" for own in alphabets)
    x = moved(key, f"{kind}\0{shape}", x, size)
    out = []
    for own in reversed(alphabets):
        x, i = divmod(x, len(own))
        out.append(own[i])
    return "".join(reversed(out))


def _check_digit(digits: str) -> str:
    """The digit that makes ``digits`` pass the Luhn test."""
    total = sum(sum(divmod(int(d) * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _script(text: str) -> str:
    return next((unicodedata.name(c, "").split(" ")[0] for c in text if c.isalpha()), "LATIN")


def _plain_digits(text: str) -> str:
    """Decimal digits of all scripts as ASCII ones."""
    return "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def _lower(text: str) -> str:
    """Lower case, character for character."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in text).replace("ς", "σ")


def entity(kind: str, found: str, title: str = "") -> str:
    """What mentions of one entity have in common."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", _plain_digits(found))
    if kind == "email":
        return _lower(found)
    if kind == "iban":
        return _plain_digits(found.replace(" ", ""))
    if kind == "name":
        return f"{_GENDER.get(title.lower(), 'n')} {' '.join(found.split()).casefold()}"
    return found


def surrogate(key: bytes, kind: str, own: str, draw: int = 0, syllables: int = 4) -> str:
    """The surrogate of an entity, without the look of a mention."""
    if kind in ("phone", "ssn"):
        head = own[:1] if kind == "phone" and len(own) > 10 else ""
        return head + same_format(key, kind + head, own[len(head) :])
    if kind == "card":
        if _check_digit(own[:-1]) == own[-1]:
            first = same_format(key, "luhn", own[:-1])
            return first + _check_digit(first)
        # Numbers that fail the test go to others that fail it: walk on.
        out = own
        while True:
            out = same_format(key, kind, out)
            if _check_digit(out[:-1]) != out[-1]:
                return out
    if kind == "ip":
        x = moved(key, kind, sum(int(p) << 8 * i for i, p in enumerate(own.split("."))), 1 << 32)
        return ".".join(str(x >> 8 * i & 255) for i in range(4))
    if kind == "email":
        local, _, domain = own.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{same_format(key, 'local', local)}@{same_format(key, 'host', host)}.{top}"
    if kind == "iban":
        return own[:2] + same_format(key, kind, own[2:])
    if kind == "secret":
        letters = _DIGITS + _LOWER.upper()
        return own[:4] + same_format(key, kind, own[4:], [letters] * (len(own) - 4))
    if kind == "assigned":
        if set(own) <= set(_HEX):
            return same_format(key, "hex", own, [_HEX] * len(own))
        out = own
        while True:
            out = same_format(key, kind, out)
            if not set(out) <= set(_HEX):
                return out
    gender, _, person = own.partition(" ")
    words, script = person.split(" "), _script(person)
    if script not in GIVEN:
        return same_format(key, f"name\0{draw}", person).title()
    pools, sounds = GIVEN[script], _SOUNDS[script]
    x = _hash(key, "name", own, str(draw), str(syllables))
    given = (pools["m"] + pools["f"]) if gender == "n" else pools[gender]
    x, i = divmod(x, len(given))
    last = ""
    for _ in range(syllables):
        x, a = divmod(x, len(sounds[0]))
        x, b = divmod(x, len(sounds[1]))
        last += sounds[0][a] + sounds[1][b]
    last = last[:1].upper() + last[1:]
    made = f"{given[i]} {last}" if len(words) > 1 else last
    # A million draws on, so that it isn't met by redrawing.
    return surrogate(key, kind, own, draw + 1_000_000, syllables) if made.casefold() == person else made


def styled(kind: str, found: str, made: str) -> str:
    """A surrogate with the separators and case of the mention it replaces."""
    if kind in ("phone", "card", "ssn", "iban"):
        left, out = iter(made), []
        for c in found:
            new = next(left) if c.isalnum() else c
            # A digit takes the script of the one that it replaces.
            out.append(chr(ord(c) - unicodedata.decimal(c) + int(new)) if c.isdecimal() and new in _DIGITS else new)
        return "".join(out)
    if kind == "email":
        return "".join(m.upper() if c.isupper() and len(m.upper()) == 1 else m for c, m in zip(found, made))
    if kind == "name":
        made = made if len(found.split()) > 1 else made.split(" ")[-1]
        return made.upper() if found.isupper() else made.lower() if found.islower() else made
    return made


def _spans(text: str) -> list[tuple[int, int]]:
    """The parts of a text that can hold mentions.

    Only an assignment may run over a line's end, and it needs its keyword; every
    other kind needs a digit, an @, a title or the head of a secret in its line.
    """
    folded = text.casefold()
    if any(k in folded for k in _KEYWORDS) or any(c in text for c in "\u0130\u0131\u017f"):
        return [(0, len(text))]
    heads = [h for h in _HEADS if h in text]
    if not heads and not _SIGN.search(text):
        return []
    out, a = [], 0
    for line in text.split("\n"):
        if any(h in line for h in heads) or _SIGN.search(line):
            out.append((a, a + len(line)))
        a += len(line) + 1
    return out


def mentions(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, found, entity) of every mention in a text.

    Names are found after a title. Whoever is named so is then found again in the
    whole text, by full name or surname, without a title or with one that tells no
    gender; a surname that several share stands for the first of them.
    """
    out, named = [], []
    for m in (m for a, b in _spans(text) for m in _ANY.finditer(text, a, b)):
        kind = m.lastgroup if m.lastgroup in _KINDS else next(k for k in _KINDS if m.group(k) is not None)
        group = {"assigned": "value", "name": "person"}.get(kind, kind)
        found = m.group(group)
        if kind == "name" and not all(w[0].isupper() for w in found.split(" ")):
            first = found.split(" ")[0]
            if not first[0].isupper():
                continue
            found = first
        start = m.start(group)
        if kind == "name":
            found = _POSSESSIVE.sub("", found)
            named.append(len(out))
        out.append((start, start + len(found), kind, found, entity(kind, found, m.group("title") or "")))
    return _persons(text, out, named) if named else out


_POSSESSIVE = re.compile(r"['’][sS]$")


def _persons(text: str, out: list[tuple], named: list[int]) -> list[tuple]:
    """The mentions with those of ``named`` persons brought together and found again."""
    genders, full = defaultdict(dict), {}
    for i in named:
        gender, _, person = out[i][4].partition(" ")
        if gender != "n":
            genders[person][gender] = None

    def known(gender: str, person: str) -> str:
        return next(iter(genders[person])) if gender == "n" and len(genders.get(person, ())) == 1 else gender

    # Full names first; a surname alone then is that of the one full name it fits.
    by_surname = defaultdict(dict)
    for i in named:
        gender, _, person = out[i][4].partition(" ")
        if " " in person:
            own = f"{known(gender, person)} {person}"
            out[i] = (*out[i][:4], own)
            full.setdefault(person, own)
            by_surname[person.split(" ")[-1]][own] = None
    alone = {}
    for i in named:
        gender, _, person = out[i][4].partition(" ")
        if " " not in person:
            gender = known(gender, person)
            fits = [own for own in by_surname.get(person, ()) if "n" in (gender, own[0]) or own[0] == gender]
            own = fits[0] if len(fits) == 1 else f"{gender} {person}"
            out[i] = (*out[i][:4], own)
    for i in named:
        alone.setdefault(out[i][4].split(" ")[-1], out[i][4])
    wanted = [r"\s+".join(map(re.escape, p.split(" "))) for p in sorted([*full, *alone], key=len, reverse=True)]
    again, taken, j = [], sorted((m[0], m[1]) for m in out), 0
    for m in re.finditer(rf"(?<!\w)(?:{'|'.join(wanted)})(?!\w)", text, re.IGNORECASE):
        while j < len(taken) and taken[j][1] <= m.start():
            j += 1
        person = " ".join(m[0].split()).casefold()
        own = full.get(person) or alone.get(person)
        # A surname in lower case may be any word.
        if own and (j == len(taken) or m.end() <= taken[j][0]) and (" " in person or m[0][0].isupper()):
            again.append((*m.span(), "name", m[0], own))
    return sorted(out + again)


_KINDS = [k for k, _ in PATTERNS]


def replaced(text: str, key: bytes, redrawn: dict[str, int], syllables: int) -> tuple[str, int]:
    """(text with surrogates, number of mentions)."""
    parts, last, n = [], 0, 0
    for start, end, kind, found, own in mentions(text):
        made = styled(kind, found, surrogate(key, kind, own, redrawn.get(own, 0) if kind == "name" else 0, syllables))
        parts += [text[last:start], made]
        last, n = end, n + 1
    return ("".join(parts) + text[last:], n) if n else (text, 0)


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (kind, entity) of all texts."""

    def run(batch):
        found = sorted({(k, own) for t in batch.column(0).to_pylist() if t for _, _, k, _, own in mentions(t)})
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names=["kind", "entity"])

    return over_texts(docs, [F.col(text).alias("body")], run, "kind string, entity string").distinct()


def _drawn(found: DataFrame, key: bytes, syllables: int) -> DataFrame:
    def run(batch):
        kinds, own, draws = (c.to_pylist() for c in batch.columns)
        made = [surrogate(key, k, e, d, syllables) for k, e, d in zip(kinds, own, draws)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "entity", "draw", "made"])

    return over_texts(found, ["kind", "entity", "draw"], run, "kind string, entity string, draw int, made string")


def redraws(docs: DataFrame, key: bytes, text: str = "text", syllables: int = 4) -> tuple[dict[str, int], int]:
    """({name: draw}, syllables): the draws under which no two entities of a kind
    share a surrogate. Of entities that do, the first one keeps it."""
    found = cut(entities(docs, text))
    while True:
        drawn = cut(_drawn(found.withColumn("draw", F.lit(0)), key, syllables))
        for _ in range(20):
            first = drawn.groupBy("kind", "made").agg(F.count("*").alias("n"), F.min(F.struct("draw", "entity")).alias("first")).where("n > 1")
            late = drawn.join(first.select("kind", "made", "first"), ["kind", "made"]).where(F.col("entity") != F.col("first.entity"))
            late = cut(late.select("kind", "entity", (F.col("draw") + 1).alias("draw")))
            if late.isEmpty():
                break
            rest = drawn.join(late.select("kind", "entity"), ["kind", "entity"], "left_anti")
            drawn = cut(rest.unionByName(_drawn(late, key, syllables)))
        else:
            syllables += 1
            continue
        again = drawn.where("draw > 0").select("entity", "draw").limit(MOST_REDRAWN + 1).collect()
        if len(again) <= MOST_REDRAWN:
            return {r.entity: r.draw for r in again}, syllables
        syllables += 1


def _run(docs: DataFrame, key: bytes, text: str, chosen: list, name: str) -> DataFrame:
    """``chosen`` columns with the text, the last one, replaced, and the number of mentions."""
    redrawn, syllables = redraws(docs, key, text)
    selected = docs.select(*chosen, F.col(text).alias(name))
    schema = StructType([*selected.schema.fields, StructField("mentions", IntegerType())])

    def run(batches):
        for batch in batches:
            made = [(None, 0) if t is None else replaced(t, key, redrawn, syllables) for t in batch.columns[-1].to_pylist()]
            columns = [*batch.columns[:-1], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "mentions"])

    return selected.mapInArrow(run, schema)


def with_surrogates(docs: DataFrame, key: bytes = KEY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_mentions.

    A null text stays null and a text without mentions stays as it is, byte for
    byte. One row per row, repeated rows alike; no rows give no rows. Columns
    other than these two aren't read.
    """
    made = _run(docs, key, text, [F.col(doc_id).cast("long").alias("doc_id")], "text")
    return made.withColumnRenamed("mentions", "n_mentions")


def replace_in(docs: DataFrame, key: bytes = KEY, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The table itself, with surrogates in its texts; ``n_chars`` of a changed
    text is its new length."""
    columns = docs.columns
    inner = [F.struct(*[F.col(c) for c in columns if c != text]).alias("rest")]
    made = _run(docs, key, text, inner, "body")
    out = [F.col("body").alias(c) if c == text else F.col(f"rest.`{c}`") for c in columns]
    if n_chars in columns:
        i = columns.index(n_chars)
        kind = docs.schema[n_chars].dataType
        out[i] = F.when(F.col("mentions") > 0, F.char_length("body").cast(kind)).otherwise(out[i]).alias(n_chars)
    return made.select(*out)
