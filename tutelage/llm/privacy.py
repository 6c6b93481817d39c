"""Personal data replaced by keyed surrogates that keep type, script, gender and format.

Found are e-mail and internet addresses, card, telephone, account (IBAN) and social security numbers, long hexadecimal keys, and names after a title. A name's
whole and parts are replaced wherever else they stand in the same document, in capitals too; a single name after a title elsewhere only inside a sentence, as at
its start it may be an ordinary word. A
surrogate is a keyed permutation of the entity's canonical form within the forms of its kind: digits become
digits, letters become letters of the same script and case, separators stay. A given name of the list becomes another of
the same gender and script; the title stays. Names are replaced part by part, so that a part has one surrogate alone and in any whole name.

Because every kind is a permutation of its own forms, equal entities get equal surrogates in all documents
and different entities different ones, without a table of what was seen. The permutation walks on while
its result is not allowed (the entity itself, or a name that the list would treat otherwise), which keeps it one to one;
``collisions`` checks that over a whole corpus.

Defined cases: a null text stays null and an empty one empty; entities that overlap go to the kind listed first, then to the
earlier one; repeated rows get the same result; a column named as the result is replaced, all others pass; letters of scripts
without a listed alphabet become others of their kind from the same 128 code points.
"""

from __future__ import annotations

import hashlib
import logging
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import batched, free

#: The registered queries' key; a job brings a secret of its own.
SECRET = b"a key for tests"
ENTITIES = "array<struct<kind:string,start:int,end:int,canonical:string,surrogate:string>>"

# Given names by gender in two scripts, and titles by gender.
GIVEN = {
    ("f", "latin"): "Anna Maria Laura Julia Emma Clara Sofia Elena Alice Marie Sarah Mary Jane Helen Susan Linda Karen Nancy Lisa Emily".split(),
    ("m", "latin"): "John James Robert Michael David William Thomas Peter Paul Mark George Daniel Hans Karl Pierre Louis Carlos Juan Miguel Pedro".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Николай Михаил Андрей".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Señora Sra Madame Mme Госпожа".split(), "m": "Mr Herr Señor Sr Monsieur Господин".split(), "": "Dr Prof".split()}

_LISTED = [[n.lower() for n in names] for names in GIVEN.values()]

# Alphabets by script and case, as ranges of code points.
RANGES = [("0", "9"), ("a", "z"), ("A", "Z"), ("а", "я"), ("А", "Я"), ("α", "ω"), ("Α", "Ω"), ("ß", "ö"), ("À", "Ö"), ("ø", "ÿ"), ("Ø", "Þ"),
          ("ā", "ſ"), ("א", "ת"), ("ء", "غ"), ("ぁ", "ゖ"), ("ァ", "ヺ"), ("一", "鿿"), ("가", "힣")]
_ALPHABETS = ["".join(map(chr, range(ord(a), ord(b) + 1))) for a, b in RANGES]
_OF = {c: a for a in _ALPHABETS for c in a}


@cache
def alphabet(c: str) -> str:
    """The characters that may replace ``c``: of its listed alphabet, else the decimal digits or the letters of its kind around it; none for others."""
    if c in _OF:
        return _OF[c]
    if c.isdecimal():
        return "".join(chr(ord(c) - unicodedata.decimal(c) + k) for k in range(10))
    if not c.isalpha():
        return ""
    start, kind = ord(c) & ~127, unicodedata.category(c)
    near = "".join(x for x in map(chr, range(start, start + 128)) if x not in _OF and unicodedata.category(x) == kind)
    return near if len(near) > 1 else "".join(x for x in map(chr, range(start, start + 128)) if x not in _OF and x.isalpha())


_LOWER_HEX = {c: "0123456789abcdef" for c in "0123456789abcdef"}
_UPPER_HEX = {c: "0123456789" for c in "0123456789"} | {c: "ABCDEF" for c in "ABCDEF"}

_NAME = r"[^\W\d_a-zß-öø-ÿа-яё][^\W\d_]+"
_TITLE = re.compile(rf"(?<!\w)({'|'.join(t for ts in TITLES.values() for t in ts)})\.? ({_NAME}(?:[ -]{_NAME}){{0,2}})")
_EMAIL = re.compile(r"[^\W_][\w.+-]{0,63}@[^\W_](?:[\w-]{0,62}\.)+[^\W\d_]{2,24}")
_KEY = re.compile(r"(?<![0-9A-Za-z])(?=[a-fA-F]*[0-9])(?:[0-9a-f]{24,}|[0-9A-F]{24,})(?![0-9A-Za-z])")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)")
_CARD = re.compile(r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])")
_PHONE = re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])|(?<![\w.+-])\+\d{9,14}(?!\w)")
_DIGIT = re.compile(r"\d")
_WORD = re.compile(r"\w+")
_SSN = re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]){11,30}(?![0-9A-Za-z])")
_GROUP = "[0-9a-fA-F]{1,4}"
_IP6 = re.compile(rf"(?<![\w:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}(?::{_GROUP}){{0,5}})::(?:{_GROUP}(?::{_GROUP}){{0,5}}))(?![\w:])")
#: Three even groups are amounts or years more often than a telephone number, unless they begin as one.
_AMOUNTS = re.compile(r"[1-9]\d{3}([ .])\d{4}\1\d{4}")
#: What stands before the start of a sentence.
_START = re.compile(r"(?:^|[.!?:;\n\u3002\uff01\uff1f][\"'\u201d\u00bb)\]]*\s*|[\"'\u201c\u00ab(\[])$")
_HEX = {c: "0123456789abcdef" for c in "0123456789abcdef"}


class Surrogates:
    """The keyed permutations; one secret gives one family of surrogates."""

    def __init__(self, secret: bytes):
        self.secret = secret
        self.known: dict[str, str] = {}  # parts of names seen lately

    def _number(self, label: str, *parts: int) -> int:
        text = "/".join(map(str, parts)).encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.secret[:64], person=label.encode()[:16], digest_size=64).digest(), "big")

    def permute(self, value: int, size: int, label: str, allowed: Callable[[int], bool] = lambda v: True) -> int:
        """``value`` below ``size`` under a keyed permutation: eight rounds over two parts, walking on to an allowed result."""
        if size < 2:
            return value
        a = max(2, int(size ** 0.5) if size < 1 << 52 else 1 << ((size.bit_length() + 1) // 2))
        b = -(-size // a)
        start = value
        for _ in range(10_000):
            left, right = divmod(value, b)
            for k in range(4):
                left = (left + self._number(label, size, 2 * k, right)) % a
                right = (right + self._number(label, size, 2 * k + 1, left)) % b
            value = left * b + right
            if value < size and allowed(value) or value == start:
                return value
        return start

    def spell(self, text: str, label: str, alphabets: dict[str, str] | None = None, allowed: Callable[[str], bool] = lambda s: True) -> str:
        """Each character with an alphabet replaced by one of the same alphabet, all of them as one number."""
        of = [alphabet(c) if alphabets is None else alphabets.get(c, "") for c in text]
        places = [i for i, letters in enumerate(of) if letters]
        used = [of[i] for i in places]
        size, value = 1, 0
        for i, letters in zip(places, used, strict=True):
            at = ord(text[i]) - ord(letters[0]) if len(letters) > 500 else letters.index(text[i])  # the large ones are whole ranges
            size, value = size * len(letters), value * len(letters) + at

        def back(number: int) -> str:
            out = list(text)
            for i, letters in zip(reversed(places), reversed(used), strict=True):
                number, k = divmod(number, len(letters))
                out[i] = letters[k]
            return "".join(out)

        shape = "".join(letters[0] for letters in used)
        return back(self.permute(value, size, f"{label}{len(shape)}{hashlib.md5(shape.encode()).hexdigest()[:6]}", lambda v: v != value and allowed(back(v))))

    def email(self, found: str) -> str:
        """One surrogate in whatever case the address is written; the last label of the host stays."""
        name, host = lowered(found).rsplit(".", 1)[0].split("@")
        new = f"{self.spell(name, 'name')}@{self.spell(host, 'host')}"
        cased = "".join(n.upper() if o != o.lower() and len(n.upper()) == 1 else n for o, n in zip(found, new, strict=False))
        return cased + found[len(new):]

    def ip(self, found: str) -> str:
        parts = [int(x) for x in found.split(".")]
        value = int.from_bytes(bytes(parts), "big")
        ok = lambda v: v != value and all(1 <= x <= 254 for x in v.to_bytes(4, "big"))
        inside = all(1 <= x <= 254 for x in parts)
        new = self.permute(value, 1 << 32, "ip", ok if inside else lambda v: v != value and not ok(v))
        return ".".join(map(str, new.to_bytes(4, "big")))

    def card(self, digits: str) -> str:
        """The first digit stays, and so does whether the check digit is right and by how much it is wrong."""
        off = (int(digits[-1]) - luhn(digits[:-1])) % 10
        body = digits[0] + self.spell(digits[1:-1], "card")
        return body + str((luhn(body) + off) % 10)

    def phone(self, digits: str) -> str:
        """The last ten digits are replaced whatever the prefix before them, which stays."""
        return digits[:-10] + self.spell(digits[-10:], "phone")

    def part(self, found: str) -> str:
        """One word of a name: a listed given name becomes the next of its list under the key, any other word one that is in no list; the case stays."""
        if found not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[found] = self._part(found)
        return self.known[found]

    def _part(self, found: str) -> str:
        low = lowered(found)
        for names in _LISTED:
            if low in names:
                ring = sorted(names, key=lambda n: self._number("given", *n.encode()))
                new = ring[(ring.index(low) + 1) % len(ring)]
                return new.upper() if found.isupper() and len(found) > 1 else new.capitalize()
        new = self.spell(low, "name", allowed=lambda n: not any(n in names for names in _LISTED))
        return "".join(n.upper() if o != o.lower() and len(n.upper()) == 1 else n for o, n in zip(found, new, strict=True))

    def name(self, found: str) -> str:
        return "".join(x if x in " -" else self.part(x) for x in re.split(r"([ -])", found))

    def iban(self, compact: str) -> str:
        """Country and form stay, and so does by how much the check digits are wrong."""
        off = (int(compact[2:4]) - _iban_check(compact[:2], compact[4:])) % 97
        body = self.spell(compact[4:], "iban")
        return f"{compact[:2]}{(_iban_check(compact[:2], body) + off) % 97:02d}{body}"


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97


def lowered(text: str) -> str:
    """Lower case, but for the few letters that would become two."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _refill(found: str, digits: str) -> str:
    """``found`` with its digits replaced in turn."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in found)


def detect(text: str, surrogates: Surrogates) -> list[tuple[str, int, int, str, str]]:
    """``(kind, start, end, canonical, surrogate)`` by start, without overlaps: of two that overlap the kind found first stays."""
    starts: list[int] = []
    taken: list[tuple[str, int, int, str, str]] = []  # by start, like ``starts``

    def add(kind: str, start: int, end: int, canonical: str, surrogate: str) -> None:
        at = bisect_left(starts, start)
        if (at == 0 or taken[at - 1][2] <= start) and (at == len(starts) or end <= starts[at]):
            starts.insert(at, start)
            taken.insert(at, (kind, start, end, canonical, surrogate))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add("email", *m.span(), lowered(m[0]), surrogates.email(m[0]))
    if ":" in text:
        for m in _IP6.finditer(text):
            add("ip6", *m.span(), m[0].lower(), surrogates.spell(m[0].lower(), "ip6", _HEX))
    if _DIGIT.search(text):
        for m in _KEY.finditer(text):
            add("key", *m.span(), m[0], surrogates.spell(m[0], "key", _LOWER_HEX if m[0].islower() else _UPPER_HEX))
        for m in _IBAN.finditer(text):
            compact = m[0].replace(" ", "")
            if compact[2:4] == f"{_iban_check(compact[:2], compact[4:]):02d}":
                new = iter(surrogates.iban(compact))
                add("iban", *m.span(), compact, "".join(c if c == " " else next(new) for c in m[0]))
        for m in _SSN.finditer(text):
            add("ssn", *m.span(), m[0], surrogates.spell(m[0], "ssn", allowed=_SSN.fullmatch))
        for m in _IP.finditer(text):
            add("ip", *m.span(), ".".join(str(int(x)) for x in m[0].split(".")), surrogates.ip(m[0]))
        for m in _CARD.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            add("card", *m.span(), digits, _refill(m[0], surrogates.card(digits)))
        for m in _PHONE.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            if 7 <= len(digits) <= 15 and not _AMOUNTS.fullmatch(m[0]):
                add("phone", *m.span(), digits, _refill(m[0], surrogates.phone(digits)))
    named: dict[str, bool] = {}  # names and their parts in lower case: may they be replaced at the start of a sentence?
    for m in _TITLE.finditer(text):
        parts = re.split("[ -]", m[2])
        for n in {m[2], *parts}:
            named[lowered(n)] = named.get(lowered(n), False) or len(parts) > 1
        add("name", *m.span(2), lowered(m[2]), surrogates.name(m[2]))
    if named:  # later and earlier mentions without the title, longer names first, each word with a capital
        words, i = [m.span() for m in _WORD.finditer(text)], 0
        while i < len(words):
            start = words[i][0]
            for _, end in reversed(words[i:i + 3]):
                found = text[start:end]
                if (anywhere := named.get(lowered(found))) is not None:
                    capital = all(w[0] == w[0].upper() for w in re.split("[ -]", found))
                    if capital and (anywhere or not _START.search(text, max(0, start - 8), start)):
                        add("name", start, end, lowered(found), surrogates.name(found))
                    break
            i += 1
    return taken


def secret(spark: SparkSession) -> bytes:
    """The key of the surrogates: the setting ``spark.tutelage.privacy.secret``. Without it the key is one that all can read, which is said as a warning: fit for tests and synthetic tables alone."""
    named = spark.conf.get("spark.tutelage.privacy.secret", None)
    if named:
        return named.encode()
    logging.getLogger(__name__).warning("spark.tutelage.privacy.secret is not set: the surrogates' key is public, so anybody can undo them")
    return SECRET


def replace(docs: DataFrame, secret: bytes, text: str = "text", out: str = "entities") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``out``: what was found where, and what stands there now."""
    kept = [c for c in docs.columns if c not in (text, out)]
    read = free(kept, "_text")
    fields = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(out, T._parse_datatype_string(ENTITIES))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("canonical", pa.string()), ("surrogate", pa.string())]))

    keyed = Surrogates(secret)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, found = [], []
        for t in batch.column(read).to_pylist():
            if t is None:
                texts.append(None), found.append([])
                continue
            spans, pieces, at = detect(t, keyed), [], 0
            for _, start, end, _, new in spans:
                pieces += [t[at:start], new]
                at = end
            texts.append("".join([*pieces, t[at:]]) if spans else t)
            found.append([dict(zip(("kind", "start", "end", "canonical", "surrogate"), s, strict=True)) for s in spans])
        columns = {c: batch.column(c) for c in kept} | {text: pa.array(texts, pa.string()), out: pa.array(found, kind)}
        return pa.RecordBatch.from_arrays([columns[f] for f in schema.fieldNames()], names=schema.fieldNames())

    return batched(docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(read)), run, schema)


def collisions(replaced: DataFrame, out: str = "entities") -> DataFrame:
    """``(kind, surrogate, n)``: surrogates that stand for more than one entity; there are none unless something is wrong."""
    one = replaced.select(F.explode(out).alias("e")).select("e.kind", "e.canonical", F.when(F.col("e.kind").isin("card", "phone"), F.regexp_replace("e.surrogate", r"\D", "")).otherwise(F.lower("e.surrogate")).alias("surrogate"))
    return one.distinct().groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
