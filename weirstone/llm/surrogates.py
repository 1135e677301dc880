"""Personal data replaced by keyed, type-consistent surrogates.

Detected entities (e-mail, IPv4, IPv6, card, phone, social security and bank account
numbers, credentials, names after a title) are brought to a normal form.  The
surrogate of a normal form follows from a secret key by HMAC: the same entity
gets the same surrogate in every document and every run (coreference), laid
out as the mention is written: digits stay digits, letters stay letters of the
same script and case, separators stay, cards keep a valid check digit, octets
stay in range, account numbers get a valid check number, top-level domains stay,
and one domain stays one domain.  First names are built with an ending of the
gender that the title tells, and with one of neither gender after a title that
tells none, unless the text has the same name after one that does.

A name found after a title is looked for again in the whole text: every word
equal to it, in the same case and of two letters or more, is the same entity.

Distinctness is checked, not hoped for: over all distinct entities of the
corpus, a surrogate that two entities share, or that is itself an entity of the
corpus (names of all kinds are compared with each other), sends all but the smallest of them to a further attempt, until none is
left; from ``LONGER_FROM`` attempts on surrogates grow, so this ends for any
number of entities (IPv4 addresses are drawn again instead, from all 2^32).  Only entities beyond their first attempt have to travel to
the documents; all others are computed where the text is.

Defined results: a null text stays null, an empty one empty, a text without
entities is unchanged; rows that repeat get the same text; numbers that fail
their check digit or range are no entities, but an account number with a wrong
check number is one; overlapping finds go to the one
that starts first, then to the longest; an empty table gives no rows; other
columns travel with their row, whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.llm.common import ship, slices, stored

LONGER_FROM = 4

# Titles that tell a gender: fixed values.
MALE = ("Mr", "Mister", "Herr", "Señor", "Sr", "Monsieur", "Signor", "господин", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "госпожа", "Госпожа")
NEUTRAL = ("Dr", "Doctor", "Prof", "Professor", "доктор", "Доктор", "профессор", "Профессор")
# Kinds of names, of which no two entities share a surrogate.
NAMES = ("first_f", "first_m", "first_n", "last")

_EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]+@(?:[\w-]+\.)+[^\W\d_]{2,}")
_NUMBERS = (
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("ipv4", re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")),
    ("card", re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?|\d{1,3}[ .-])?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\w)")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)")),
)
_SECRETS = (
    re.compile(r"(?<!\w)((?:AKIA|ASIA)[0-9A-Z]{16})(?!\w)"),
    re.compile(
        r"(?i:password|passwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"']{6,}))"
    ),
)
_NAME = re.compile(
    r"(?<!\w)(?:(?P<male>" + "|".join(MALE) + r")|(?P<female>" + "|".join(FEMALE) + r")|(?:" + "|".join(NEUTRAL) + r"))\.?[ ]"
    r"(?!(?:" + "|".join(MALE + FEMALE + NEUTRAL) + r")\b)(?P<one>[^\W\d_]+)(?:[ ](?P<two>[^\W\d_]+))?"
)
_WORD = re.compile(r"(?<!\w)[^\W\d_]{2,}(?!\w)")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\w)")
_DIGIT = re.compile(r"[0-9]")
# Letters to draw from, by script, for letters beyond ASCII: a first and a last code point.
SCRIPTS = ((0x3B1, 0x3C1), (0x430, 0x44F), (0x5D0, 0x5EA), (0x627, 0x63A), (0x3041, 0x3096), (0x30A1, 0x30F6), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüý"
SYLLABLES = {
    "latin": ("bdfghklmnprstv", "aeiou", ("a", "ia"), ("n", "r"), ("i", "y")),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("а", "ия"), ("н", "р"), ("и", "о")),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


class Stream:
    """Whole numbers that follow from a key and a message."""

    def __init__(self, key: bytes, *message: str):
        self.key, self.message = key, "\0".join(message).encode("utf-8", "surrogatepass")
        self.block, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left += hmac.new(self.key, self.message + self.block.to_bytes(8, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n


def like(char: str, draw: Stream) -> str:
    """A character of the same kind, script and case."""
    if char in "0123456789":
        return str(draw.below(10))
    if "a" <= char <= "z":
        return chr(97 + draw.below(26))
    if "A" <= char <= "Z":
        return chr(65 + draw.below(26))
    if not char.isalpha():
        return char
    low = char.lower()
    point = ord(low[0])
    for first, last in SCRIPTS:
        if first <= point <= last:
            new = chr(first + draw.below(last - first + 1))
            break
    else:
        if not unicodedata.name(char, "").startswith("LATIN"):
            return char
        new = ACCENTED[draw.below(len(ACCENTED))]
    return new.upper() if char != low and len(new.upper()) == 1 else new


def check_number(account: str) -> str:
    """The two digits that make an account number (country, two digits, the rest) valid."""
    digits = "".join(str(int(c, 36)) for c in account[4:] + account[:2]) + "00"
    return f"{98 - int(digits) % 97:02d}"


def given_name(value: str, kind_of_name: str, draw: Stream) -> str:
    """A made-up first name with an ending of the gender, in the script of ``value``."""
    kind = "cyrillic" if "Ѐ" <= value[0] <= "ӿ" else "latin" if ord(value[0]) < 0x250 else None
    if kind is None:
        return "".join(like(c, draw) for c in value)
    hard, soft, ends_female, ends_male, ends_neutral = SYLLABLES[kind]
    body = "".join(hard[draw.below(len(hard))] + soft[draw.below(len(soft))] for _ in range(2 + (len(value) > 4)))
    if kind_of_name == "first_m":
        return body + ends_male[draw.below(2)]
    return body + hard[draw.below(len(hard))] + (ends_female if kind_of_name == "first_f" else ends_neutral)[draw.below(2)]


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate, in normal form, of an entity in normal form."""
    draw = Stream(key, kind, value, str(attempt))
    longer = "".join(str(draw.below(10)) for _ in range(max(0, attempt - LONGER_FROM + 1)))
    if kind == "email":
        local, _, domain = value.partition("@")
        name, _, top = domain.rpartition(".")
        shared = Stream(key, "domain", domain)
        return "".join(like(c, draw) for c in local) + longer + "@" + "".join(like(c, shared) for c in name) + "." + top
    if kind == "ipv4":
        return ".".join(str(draw.below(256)) for _ in range(4))
    if kind == "ipv6":
        if longer:
            return ":".join(f"{1 + draw.below(0xFFFF):x}" for _ in range(8))
        groups = value.split(":")
        return ":".join("".join("123456789abcdef"[draw.below(15)] for _ in g) for g in groups)
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[2:]) + longer
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "phone":
        # the leading digits, country code or area, keep the look of the place
        keep = max(0, len(value) - 9)
        return value[:keep] + "".join(str(draw.below(10)) for _ in value[keep:]) + longer
    if kind in ("first_f", "first_m", "first_n"):
        return given_name(value, kind, draw) + "".join("abcdefghij"[int(d)] for d in longer)
    if kind == "last":
        return "".join(like(c, draw) for c in value) + "".join("abcdefghij"[int(d)] for d in longer)
    if kind == "iban":
        made = value[:4] + "".join(like(c, draw) for c in value[4:]) + longer
        return made[:2] + check_number(made) + made[4:]
    start = 4 if kind == "secret" and value[:4] in ("AKIA", "ASIA") else 0
    return value[:start] + "".join(like(c, draw) for c in value[start:]) + longer


def normal(kind: str, mention: str) -> str:
    if kind in ("card", "phone", "ssn"):
        return "".join(c for c in mention if c.isdigit())
    if kind == "iban":
        return mention.replace(" ", "")
    if kind == "ipv6":
        return ipaddress.IPv6Address(mention).compressed
    return mention if kind in ("secret", "ipv4") else mention.lower()


def laid_out(kind: str, mention: str, value: str) -> str:
    """A surrogate in normal form, written as the mention is."""
    if kind in ("card", "phone", "ssn", "iban"):
        rest = iter(value)
        own = str.isdigit if kind != "iban" else str.isalnum
        return "".join(next(rest, "") if own(c) else c for c in mention) + "".join(rest)
    if kind in ("secret", "ipv4"):
        return value
    if kind == "ipv6":
        return value.upper() if any("A" <= c <= "F" for c in mention) else value
    if mention.isupper():
        return value.upper()
    return value[:1].upper() + value[1:] if mention[:1].isupper() else value


def _is_ipv6(mention: str) -> bool:
    """Whether it is an address that tells a host apart; words such as ``be::add`` hold no digit."""
    try:
        address = ipaddress.IPv6Address(mention)
    except ValueError:
        return False
    return not (address.is_unspecified or address.is_loopback) and bool(_DIGIT.search(mention))


def _names(text: str) -> list[tuple[int, int, str]]:
    """Names after titles, and every other mention of them."""
    titled: list[tuple[int, int, str]] = []
    for m in _NAME.finditer(text):
        one, two = m["one"], m["two"]
        if not one[0].isupper():
            continue
        if two and two[0].isupper():
            titled.append((*m.span("one"), "first_f" if m["female"] else "first_m" if m["male"] else "first_n"))
            titled.append((*m.span("two"), "last"))
        else:
            titled.append((*m.span("one"), "last"))
    if not titled:
        return titled
    gender: dict[str, str] = {}
    for start, end, kind in titled:
        if kind in ("first_f", "first_m"):
            gender.setdefault(text[start:end].lower(), kind)
    titled = [(a, b, gender.get(text[a:b].lower(), k) if k == "first_n" else k) for a, b, k in titled]
    kinds: dict[str, str] = {}
    for start, end, kind in titled:
        kinds.setdefault(text[start:end], kind)
    known = {start for start, _, _ in titled}
    again = ((*m.span(), kinds[m[0]]) for m in _WORD.finditer(text) if m[0] in kinds and m.start() not in known)
    return [*titled, *again]


def find(text: str) -> list[tuple[int, int, str]]:
    """Entities of a text in order: start, end, kind; they do not overlap."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += ((*m.span(), "email") for m in _EMAIL.finditer(text))
    if _DIGIT.search(text):
        for kind, pattern in _NUMBERS:
            for m in pattern.finditer(text):
                digits = normal(kind, m[0])
                if kind == "ipv4" and any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in m[0].split(".")):
                    continue
                if kind == "card" and not luhn(digits) or kind == "phone" and not 8 <= len(digits) <= 15:
                    continue
                found.append((*m.span(), kind))
        if "::" in text or text.count(":") > 6:
            found += ((*m.span(), "ipv6") for m in _IPV6.finditer(text) if _is_ipv6(m[0]))
    for pattern in _SECRETS:
        for m in pattern.finditer(text):
            found.append((*m.span(m.lastindex), "secret"))
    found += _names(text)
    found.sort(key=lambda x: (x[0], -x[1], x[2]))
    out: list[tuple[int, int, str]] = []
    for x in found:
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def replace(text: str, key: bytes, later: dict[tuple[str, str], int] | None = None) -> tuple[str, int]:
    """The text with surrogates, and how many; ``later`` holds the attempts of entities beyond their first."""
    out, at = [], 0
    spans = find(text)
    for start, end, kind in spans:
        mention = text[start:end]
        value = normal(kind, mention)
        attempt = later.get((kind, value), 0) if later else 0
        out += (text[at:start], laid_out(kind, mention, surrogate(kind, value, key, attempt)))
        at = end
    return ("".join(out) + text[at:] if spans else text), len(spans)


def _mentions(docs: DataFrame, text_col: str) -> DataFrame:
    """Distinct entities of each text: ``_key`` (hash of the text), ``_kind``, ``_value``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            rows = []
            for key, text in zip(part.column("_key").to_pylist(), part.column("_text").to_pylist(), strict=True):
                if text:
                    rows += {(key, kind, normal(kind, text[a:b])) for a, b, kind in find(text)}
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["_key", "_kind", "_value"])

    text = F.col(text_col).cast("string")
    return docs.select(F.md5(text.cast("binary")).alias("_key"), text.alias("_text")).mapInArrow(
        run, "_key string, _kind string, _value string"
    )


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (batch.column(n).to_pylist() for n in ("_kind", "_value", "_attempt"))
            made = [surrogate(k, v, key, a) for k, v, a in zip(kinds, values, attempts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "_surrogate"])

    return entities.select("_kind", "_value", "_attempt").mapInArrow(
        run, "_kind string, _value string, _attempt int, _surrogate string"
    )


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """Surrogates of distinct entities (``_kind``, ``_value``) with the attempt that made each unique."""
    space = F.when(F.col("_kind").isin(*NAMES), F.lit("name")).otherwise(F.col("_kind"))
    current = stored(_with_surrogates(entities.withColumn("_attempt", F.lit(0)), key), "surrogates")
    while True:
        made = current.withColumn("_space", space).withColumn("_who", F.struct("_kind", "_value"))
        shared = (
            made.groupBy("_space", "_surrogate")
            .agg(F.min("_who").alias("_first"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1")
        )
        second = made.join(shared, ["_space", "_surrogate"]).where("_who <> _first").select("_kind", "_value")
        real = entities.select(space.alias("_space"), F.col("_value").alias("_surrogate"))
        taken = made.join(real, ["_space", "_surrogate"], "left_semi").select("_kind", "_value")
        again = stored(second.union(taken).distinct().withColumn("_again", F.lit(1)), "again")
        if again.isEmpty():
            return current
        moved = current.join(again, ["_kind", "_value"], "left").select(
            "_kind", "_value", (F.col("_attempt") + F.coalesce("_again", F.lit(0))).cast("int").alias("_attempt")
        )
        current = stored(_with_surrogates(moved, key), "surrogates")


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``text`` with surrogates, ``n_entities``."""
    ship(docs.sparkSession)
    found = stored(_mentions(docs, text_col), "mentions")
    entities = stored(found.select("_kind", "_value").distinct(), "entities")
    later = assign(entities, key).where("_attempt > 0").select("_kind", "_value", "_attempt")
    by_text = (
        found.join(later, ["_kind", "_value"])
        .distinct()
        .groupBy("_key")
        .agg(F.collect_list(F.struct("_kind", "_value", "_attempt")).alias("_later"))
    )
    by_text = stored(by_text, "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            made = []
            for text, others in zip(part.column("_text").to_pylist(), part.column("_later").to_pylist(), strict=True):
                attempts = {(x["_kind"], x["_value"]): x["_attempt"] for x in others or ()}
                made.append((None, 0) if text is None else replace(text, key, attempts))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
                names=["row", "text", "n_entities"],
            )

    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.md5(text.cast("binary")).alias("_key"), text.alias("_text"))
    marked = rows.join(by_text, "_key", "left").select("row", "_text", "_later")
    kinds = T.StructType().add(rows.schema["row"]).add("text", T.StringType()).add("n_entities", T.LongType())
    return marked.mapInArrow(run, kinds)
