"""Surrogates for personal data: keyed, of the same type and format, one to one.

Detected entities are emails, international and national phone numbers, payment cards,
bank accounts with right check digits (IBAN), social security numbers, IP addresses of both
versions, access keys, tokens, passwords, names after a title and listed first names with a
surname. Names in lower case and surnames alone in a text are not found. Each is taken apart by the shape of
its type, and the free part is a number in a finite domain: the digits of a phone
number, the letters of a mailbox, the place of a first name in the list of its
gender and script. That number goes through a keyed permutation of the domain - a
Feistel network over HMAC-SHA256 that walks cycles, conjugated with a shift by one -
which has no fixed point. So the surrogate is always another value; the same entity
has the same surrogate in every text, whatever the executor (coreference); and two
entities of one shape have two surrogates (distinctness). Different shapes stay
different, because case, script, lengths, separators, area code lengths and check
digits keep their form: the last digit of a card and the check digits of an account are
computed anew, and numbers outside a type's domain are no entities of it. What is written
in two ways (a mailbox in two cases, an address of version 6, an account in groups) is one entity.
A mail host gets another of its shape; those of large providers and reserved ones stay.

Collisions are checked on top of that. In a text, two entities must not have one
surrogate; every text is verified, and a violation raises an error. Over the table,
check_distinct() gathers the distinct entities by Spark and raises an error if two of
them share a surrogate. `n_crossed` counts a text's surrogates that equal another
entity of that text, which is replaced itself.

Names keep gender and script (a female Latin first name becomes another such name);
names that are in no list get pronounceable ones of consonants and vowels of their script:
the rank of the name among all of its length or shorter is permuted and written in syllables,
so two names never share one. Names with inner capitals or letters beyond the two alphabets
are permuted letter by letter. Parts around a hyphen or an apostrophe are words of their own. A word has the same surrogate at any place
of a name, whatever the title. Further mentions of such a name in the text, without a
title, get the same surrogate. Letters of no fixed alphabet stay among those of their
case in the same 256 code points, digits of other scripts among the ten of their script.

Defined results: a table without rows gives no rows; a null text stays null, an empty one empty; a text without entities
is returned unchanged. Repeated rows give repeated results; further columns are
ignored. Texts are handled whole, one after the other.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import slices

# The session's setting for the secret of the query, and what it is without one.
SECRET = "spark.marlspike.surrogates.secret"
KEY = b"replace this key by a secret of your own"

# Common first names by gender and script, and titles by gender.
NAMES = {
    ("female", "latin"): "Alice Anna Barbara Camille Carmen Chloe Clara Elena Emma Eva Hannah Ines Isabel Julia Laura Lea Lucia Manon Maria Marie Nina Olivia Paula Rosa Sarah Sofia".split(),
    ("male", "latin"): "Adam Andrew Carlos Daniel David Felix Henri Hugo Jack James Javier John Jonas Juan Karl Leon Louis Lucas Luis Mark Martin Max Pablo Paul Peter Thomas".split(),
    ("female", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("male", "cyrillic"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
}
TITLES = {
    "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"],
    "male": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"],
    "any": ["Dr", "Prof", "Professor"],
}
# Words that are no surname where they follow a first name in capitals.
NO_SURNAME = set("a an and are as at but by can did do does for from had has he her his how if in is it its no not of on or said she so that the then they this to was we were what when where who will with you und der die das ist et le la les est y el los es и в на не".split())
# Mail hosts that name no person or firm.
HOSTS = "gmail.com googlemail.com yahoo.com hotmail.com outlook.com live.com icloud.com aol.com gmx.de gmx.net web.de mail.ru yandex.ru example.com example.net example.org".split()

_title = "|".join(t for names in TITLES.values() for t in names)
_word = r"[^\W\d_]+"
_joined = rf"{_word}(?:['’-](?!s(?!\w)){_word})*"
_first = "|".join(name for names in NAMES.values() for name in names)
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "token": r"(?<=token = \")[0-9a-f]{32,64}(?=\")",
    "password": r"(?<=password=)[A-Za-z0-9]{6,64}",
    "access_key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "ip6": r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "national": r"(?<![\w.(+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-]|\.[0-9])",
    "phone": r"(?<![\w+])\+\d{1,3} ?(?:\(\d{2,4}\) ?|\d{2,4}[ -])\d{2,4}(?:[ -]\d{2,4}){1,3}(?!\d)",
    "card": r"(?<![\w.-])(?:\d{4}[ -]?){3}\d{4}(?![\w-])",
    "name": rf"(?:(?<=\s)|^)(?:{_title})\.? {_joined}(?: {_joined})?",
    "full": rf"(?<![\w'’-])(?:{_first}) {_joined}",
}
# What a text with an entity of the kind holds somewhere: quick to look for.
SIGNS = {
    "email": "@",
    "token": 'token = "',
    "password": "password=",
    "access_key": "AKIA",
    "ip": r"\d\.\d",
    "ip6": r":[0-9A-Fa-f]{0,4}:",
    "iban": r"[A-Z][A-Z][0-9][0-9]",
    "ssn": r"[0-9]-[0-9][0-9]-[0-9]",
    "national": r"[0-9][ .-][0-9]{4}",
    "phone": r"\+\d",
    "card": r"\d{4}[ -]?\d{4}",
    "name": rf"(?:{_title})\.? ",
    "full": rf"(?:{_first}) ",
}
_SIGNS = {kind: re.compile(sign) for kind, sign in SIGNS.items()}
_WORD = re.compile(_word)
_TITLE_GENDER = {t: g for g, names in TITLES.items() for t in names}
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
ALPHABETS = [DIGITS, LOWER, UPPER, CYRILLIC, CYRILLIC.upper()]
_LISTED = {name: kind for kind, names in NAMES.items() for name in names}


@lru_cache(maxsize=4096)
def _block(start: int, category: str) -> str:
    """The characters of a category in 256 code points that are in no fixed alphabet."""
    every = map(chr, range(start, start + 256))
    return "".join(c for c in every if unicodedata.category(c) == category and not any(c in a for a in ALPHABETS))


def alphabet_of(c: str) -> str | None:
    """The characters that may stand for c; None if it stays."""
    fixed = next((a for a in ALPHABETS if c in a), None)
    if fixed or c.isascii():
        return fixed
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(map(chr, range(zero, zero + 10)))
    category = unicodedata.category(c)
    return _block(ord(c) & ~255, category) if category[0] in "LN" else None


class Permutation:
    """A keyed permutation of 0..size-1 without a fixed point, for size above 1."""

    ROUNDS = 8

    def __init__(self, key: bytes, label: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.key = hmac.new(key, f"{label}|{size}".encode(), hashlib.sha256).digest()

    def _mask(self, turn: int, value: int) -> int:
        width = (self.half + 7) // 8
        out, block = b"", 0
        while len(out) < width:
            data = turn.to_bytes(1, "big") + block.to_bytes(4, "big") + value.to_bytes(width, "big")
            out += hmac.digest(self.key, data, "sha256")
            block += 1
        return int.from_bytes(out[:width], "big") & ((1 << self.half) - 1)

    def _feistel(self, value: int, turns) -> int:
        left, right = value >> self.half, value & ((1 << self.half) - 1)
        for turn in turns:
            left, right = right, left ^ self._mask(turn, right)
        return left << self.half | right

    def forward(self, value: int) -> int:
        while True:
            value = self._feistel(value, range(self.ROUNDS))
            if value < self.size:
                return value

    def backward(self, value: int) -> int:
        low = (1 << self.half) - 1
        while True:
            # the network run backwards: with its halves exchanged
            value = (value & low) << self.half | value >> self.half
            value = self._feistel(value, range(self.ROUNDS - 1, -1, -1))
            value = (value & low) << self.half | value >> self.half
            if value < self.size:
                return value

    def __call__(self, value: int) -> int:
        return self.forward((self.backward(value) + 1) % self.size)


@lru_cache(maxsize=4096)
def permutation(key: bytes, label: str, size: int) -> Permutation:
    return Permutation(key, label, size)


def luhn(digits: str) -> str:
    """The check digit behind these digits."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (2 if place % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def spell(text: str, kind: str, key: bytes, free=None) -> str:
    """text with its free characters (by position; all that are in an alphabet if not
    given) replaced; each keeps its alphabet."""
    places, bases, value = [], [], 0
    for place, c in enumerate(text):
        alphabet = alphabet_of(c)
        if alphabet and (free is None or place in free):
            places.append((place, alphabet))
            bases.append(len(alphabet))
            value = value * len(alphabet) + alphabet.index(c)
    size = 1
    for base in bases:
        size *= base
    if size < 2:
        return text
    label = kind + "|" + "".join(a[0] for _, a in places)
    value = permutation(key, label, size)(value)
    out = list(text)
    for place, alphabet in reversed(places):
        value, rest = divmod(value, len(alphabet))
        out[place] = alphabet[rest]
    return "".join(out)


def name_surrogate(text: str, key: bytes) -> str:
    """Names with what joins them: a listed one keeps gender and script."""
    return _WORD.sub(lambda m: word_surrogate(m.group(), key), text)


# Letters of a script, and the consonants and vowels that its new names are made of.
SYLLABLES = {
    LOWER: ("bcdfghjklmnpqrstvwxyz", "aeiou"),
    CYRILLIC: ("бвгджзйклмнпрстфхцчш", "аеиоуыэюя"),
}


def syllables(word: str, key: bytes) -> str | None:
    """A pronounceable name for a word in one of the alphabets, capitalised or in capitals.

    It is longer than the word, so never the same; the words that get one of n syllables are
    numbered without gaps, and listed names are no results.
    """
    low = word.lower()
    letters = next((a for a in SYLLABLES if all(c in a for c in low)), None)
    if letters is None or word not in (low.capitalize(), low.upper()):
        return None
    consonants, vowels = SYLLABLES[letters]
    pairs, base = len(consonants) * len(vowels), len(letters)
    rank = 0
    for c in low:  # shorter words come first
        rank = rank * base + letters.index(c) + 1
    words = sum(base**n for n in range(1, len(low) + 1)) + 1
    count = 1
    while pairs**count - len(_LISTED) < words:
        count += 1

    def number(name: str) -> int | None:
        value = 0
        if len(name) != 2 * count:
            return None
        for c, v in zip(name[::2], name[1::2]):
            if c not in consonants or v not in vowels:
                return None
            value = value * pairs + consonants.index(c) * len(vowels) + vowels.index(v)
        return value

    taken = sorted(n for n in (number(x.lower()) for x in _LISTED) if n is not None)
    value = permutation(key, f"syllables|{letters[0]}|{count}", pairs**count - len(taken))(rank)
    for n in taken:
        value += value >= n
    out = []
    for _ in range(count):
        value, pair = divmod(value, pairs)
        out.append(consonants[pair // len(vowels)] + vowels[pair % len(vowels)])
    new = "".join(reversed(out))
    return new.upper() if len(word) > 1 and word.isupper() else new.capitalize()


def word_surrogate(word: str, key: bytes) -> str:
    """The replacement of one word of a name, wherever it stands."""
    if word in _LISTED:
        gender, script = _LISTED[word]
        names = NAMES[gender, script]
        return names[permutation(key, f"name|{gender}|{script}", len(names))(names.index(word))]
    new = syllables(word, key)
    if new:
        return new
    new = spell(word, "word", key)
    # a spelt name must not be a listed one: those are the listed names' surrogates
    while new in _LISTED:
        new = spell(new, "word", key)
    return new


def surrogate(kind: str, text: str, key: bytes = KEY) -> str:
    """The replacement of one entity."""
    if kind == "email":
        box, _, host = text.rpartition("@")
        return like(box, spell(box.lower(), "email", key)) + "@" + like(host, host_surrogate(host.lower(), key))
    if kind == "ip6":
        value = int(ipaddress.IPv6Address(text))
        low = permutation(key, "ip6", 2**112)(value & (2**112 - 1))
        return str(ipaddress.IPv6Address(value >> 112 << 112 | low))
    if kind == "iban":
        places = [i for i, c in enumerate(text) if c != " "]
        new = spell(text, "iban", key, set(places[4:]))
        plain = new.replace(" ", "")
        check = f"{98 - remainder97(plain[4:] + plain[:2] + '00'):02d}"
        return new[:2] + check + new[4:]
    if kind == "ssn":
        area, group, serial = map(int, text.split("-"))
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(permutation(key, "ssn", AREAS * 99 * 9999)(value), 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"
    if kind == "national":
        return spell(text, "phone", key)
    if kind == "ip":
        value = 0
        for part in text.split("."):
            value = value * 256 + int(part)
        value = permutation(key, "ip", 2**32)(value)
        return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))
    if kind == "card":
        places = [i for i, c in enumerate(text) if c.isdecimal()]
        new = list(spell(text, "card", key, set(places[1:-1])))
        # a number with a right check digit keeps a right one, any other stays as far off
        off = int(text[places[-1]]) - int(luhn("".join(text[i] for i in places[:-1])))
        last = (int(luhn("".join(new[i] for i in places[:-1]))) + off) % 10
        new[places[-1]] = alphabet_of(text[places[-1]])[last]
        return "".join(new)
    if kind == "phone":
        country = re.match(r"\+\d{1,3}", text).end()
        return text[:country] + spell(text[country:], "phone", key)
    if kind == "access_key":
        return text[:4] + spell_mixed(text[4:], UPPER + DIGITS, kind, key)
    if kind == "token":
        return spell_mixed(text, DIGITS + "abcdef", kind, key)
    if kind == "password":
        if all(c in DIGITS + "abcdef" for c in text):
            return spell_mixed(text, DIGITS + "abcdef", kind, key)
        new = spell(text, kind, key)
        while all(c in DIGITS + "abcdef" for c in new):  # those stand for each other
            new = spell(new, kind, key)
        return new
    if kind == "full":
        return name_surrogate(text, key)
    title, _, names = text.partition(" ")
    return title + " " + name_surrogate(names, key)


#: Area numbers of social security numbers: 1 to 899 without 666.
AREAS = 898


def remainder97(text: str) -> int:
    """Of the number in which A to Z stand for 10 to 35."""
    return int("".join(str(int(c, 36)) for c in text)) % 97


def like(old: str, new: str) -> str:
    """new with capitals where old, of the same length, has them."""
    return "".join(n.upper() if o.isupper() and len(n.upper()) == 1 else n for o, n in zip(old, new))


def host_surrogate(host: str, key: bytes) -> str:
    """Another mail host of the same shape and top level; providers' and reserved ones stay."""
    if _kept_host(host):
        return host
    name, _, top = host.rpartition(".")
    new = spell(name, "host", key)
    while _kept_host(f"{new}.{top}"):
        new = spell(new, "host", key)
    return f"{new}.{top}"


def _kept_host(host: str) -> bool:
    return any(host == x or host.endswith(f".{x}") for x in HOSTS)


def identity(kind: str, text: str) -> str:
    """What is the same for all ways to write an entity."""
    if kind == "email":
        return text.lower()
    if kind == "ip6":
        return str(int(ipaddress.IPv6Address(text)))
    if kind == "iban":
        return text.replace(" ", "")
    return text


def spell_mixed(text: str, alphabet: str, kind: str, key: bytes) -> str:
    """text as a number in one alphabet, replaced by another of the same length."""
    value = 0
    for c in text:
        value = value * len(alphabet) + alphabet.index(c)
    value = permutation(key, f"{kind}|{len(text)}", len(alphabet) ** len(text))(value)
    out = []
    for _ in text:
        value, rest = divmod(value, len(alphabet))
        out.append(alphabet[rest])
    return "".join(reversed(out))


#: A capitalised word in front of a title without a point.
_AFTER_NAME = re.compile(r"[A-Z][a-z]+ $")


def _is_account(text: str) -> bool:
    plain = text.replace(" ", "")
    right = 15 <= len(plain) <= 34 and "02" <= plain[2:4] <= "98"
    return right and remainder97(plain[4:] + plain[:4]) == 1


def _is_address(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return any(c.isdigit() for c in text)


@lru_cache(maxsize=None)
def _any_of(kinds: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"(?P<{kind}>{PATTERNS[kind]})" for kind in kinds))


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, from left to right, disjoint."""
    found = []
    signed = tuple(kind for kind, sign in _SIGNS.items() if sign.search(text))
    if not signed:
        return found
    kinds = tuple(kind for kind in PATTERNS if kind in signed)
    for m in _any_of(kinds).finditer(text):
        kind, value = m.lastgroup, m.group()
        if kind == "ip" and any(int(p) > 255 or str(int(p)) != p for p in value.split(".")):
            continue
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            if int(digits[0]) == 0:
                continue
        if kind == "ip6" and not _is_address(value):
            continue
        if kind == "iban":
            while value and not _is_account(value):  # words in capitals may follow
                value = value.rpartition(" ")[0]
            if value:
                found.append((m.start(), m.start() + len(value), kind))
            continue
        if kind == "ssn":
            area, group, serial = value.split("-")
            if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
                continue
        if kind == "full":
            first, second = value.split(" ")
            if not second[:1].isupper() or len(second) < 2 or second == first or second.lower() in NO_SURNAME:
                continue
        if kind == "name" and value.split(" ")[0] in TITLES["any"] and _AFTER_NAME.search(text[max(0, m.start() - 40) : m.start()]):
            continue  # a street
        if kind == "name":
            parts = value.split(" ")
            if not parts[1][:1].isupper():
                continue
            if len(parts) > 2 and not parts[2][:1].isupper():
                found.append((m.start(), m.start() + len(" ".join(parts[:2])), kind))
                continue
        found.append((m.start(), m.end(), kind))
    return found


#: Texts without a match have no entity: one for each of PATTERNS, in RE2's syntax.
TRIGGER = rf"@|\p{{Nd}}{{2}}|\p{{Nd}}\.\p{{Nd}}|:[0-9A-Fa-f]{{0,4}}:|AKIA|token = |password=|{_first}|" + "|".join(_TITLE_GENDER)


@lru_cache(maxsize=100_000)
def _cached(kind: str, value: str, key: bytes) -> str:
    return surrogate(kind, value, key)


def replace(text: str, key: bytes = KEY) -> tuple[str, list[tuple[int, int, str, str]], int]:
    """(new text, [(start, end, kind, surrogate)] of the given text, n_crossed)."""
    found = [(a, b, kind, _cached(kind, text[a:b], key)) for a, b, kind in entities(text)]
    names = {}
    for a, b, kind, new in found:
        if kind in ("name", "full"):
            skip = kind == "name"  # the title
            names.update(zip(_WORD.findall(text[a:b])[skip:], _WORD.findall(new)[skip:]))
    if names:
        taken = [(a, b) for a, b, *_ in found]
        for m in _WORD.finditer(text):
            if m.group() in names and not any(a < m.end() and m.start() < b for a, b in taken):
                found.append((m.start(), m.end(), "mention", names[m.group()]))
        found.sort()
    originals: dict[tuple[str, str], str] = {}
    for a, b, kind, new in found:
        own = text[a:b] if kind == "mention" else identity(kind, text[a:b])
        if originals.setdefault((kind, new), own) != own:
            raise ValueError(f"two entities of kind {kind} have one surrogate")
    held = {text[a:b] for a, b, *_ in found}
    crossed = sum(new in held for *_, new in found)
    out, at = [], 0
    for a, b, _, new in found:
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:], found, crossed


FOUND = "array<struct<start:int,end:int,kind:string,surrogate:string>>"


def _triggered(texts: pa.Array) -> list[bool]:
    return pc.fill_null(pc.match_substring_regex(texts, TRIGGER), False).to_pylist()


def pseudonymize(
    docs: DataFrame, key: str = "doc_id", text: str = "text", secret: bytes = KEY
) -> DataFrame:
    """(doc, text, entities, n_crossed): the texts with surrogates, and what was replaced,
    by place in the given text."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    item = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("surrogate", pa.string())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts, found, crossed = part.column("text").to_pylist(), [], []
                for place, hit in enumerate(_triggered(part.column("text"))):
                    spans, count = [], 0
                    if hit:
                        texts[place], spans, count = replace(texts[place], secret)
                    found.append([dict(zip(("start", "end", "kind", "surrogate"), x)) for x in spans])
                    crossed.append(count)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(texts, pa.string()), pa.array(found, pa.list_(item)), pa.array(crossed, pa.int32())],
                    ["doc", "text", "entities", "n_crossed"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, text string, entities {FOUND}, n_crossed int")


def entity_table(docs: DataFrame, text: str = "text", secret: bytes = KEY) -> DataFrame:
    """(kind, entity, surrogate, identity), the distinct entities of docs."""
    rows = docs.select(F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hits = part.column("text").filter(pa.array(_triggered(part.column("text")), pa.bool_()))
                once = {(kind, x[a:b]) for x in hits.to_pylist() for a, b, kind in entities(x)}
                out = [(kind, value, _cached(kind, value, secret), identity(kind, value)) for kind, value in sorted(once)]
                columns = [pa.array([x[i] for x in out], pa.string()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "entity", "surrogate", "identity"])

    return rows.mapInArrow(run, "kind string, entity string, surrogate string, identity string").distinct()


def check_distinct(docs: DataFrame, text: str = "text", secret: bytes = KEY) -> None:
    """Raise an error if two distinct entities of docs have one surrogate, or one is its own."""
    table = entity_table(docs, text, secret)
    new = F.when(F.col("kind") == "email", F.lower("surrogate"))
    new = new.when(F.col("kind") == "iban", F.replace("surrogate", F.lit(" "))).otherwise(F.col("surrogate"))
    shared = table.groupBy("kind", new.alias("new")).agg(
        F.count_distinct("identity").alias("entities"), F.max((F.col("entity") == F.col("surrogate")).cast("int")).alias("own")
    )
    bad = shared.filter("entities > 1 OR own = 1").limit(1).collect()
    if bad:
        raise ValueError(f"surrogate of kind {bad[0].kind} is not one to one")


def op3_surrogates(spark, sf_dir: str) -> DataFrame:
    secret = spark.conf.get(SECRET, "").encode() or KEY
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check_distinct(docs, secret=secret)
    return pseudonymize(docs, secret=secret).select(
        F.col("doc").alias("doc_id"),
        "text",
        F.size("entities").cast("long").alias("n_entities"),
        "n_crossed",
        "entities",
    )


QUERIES = {"op3_surrogates": (op3_surrogates, None)}
