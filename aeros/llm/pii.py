"""Replace personal data by keyed surrogates of the same type.

Found are e-mail addresses, telephone and card numbers (Luhn, issuer digit), IP addresses, IBANs (check digits), social
security numbers, secrets behind a label such as `token =`, and person names: after a title or a known given name, and
then wherever the document mentions one of these names alone, capitalised or in capitals.

A surrogate depends on the key, the type and the normal form of the entity alone, so every mention of an entity in any
document and any spelling gets the same one (coreference). It comes from a keyed cycle through all values of the
entity's format, so distinct entities get distinct surrogates and none keeps its own value. The format is what a value
keeps: length, places of letters, digits and marks, script, the addresses of one domain in one domain, a card's issuer
digits and Luhn sum, an IBAN's country and check digits, a valid social security number, the kind of an IP address,
vowels and consonants of a name. A given name that is listed stays in the list of its gender and script; another one,
told by the title before it, keeps its last letter, which carries the gender.

A collision check in Spark finds the surrogates that are themselves entities of the corpus. They move on along their
cycle, ROUNDS times at most, to a value that is no entity and that no other entity has been offered; where a format is so
full that none is met, the first surrogate stays, which no other entity has. Mail addresses are checked by domain.
Listed given names are too few to be checked.

Null text stays null; empty text stays empty. Repeated rows are each rewritten alike, with or without an id. Where
findings overlap, the more certain kind wins, then the earlier one. Texts are worked on whole, however long. Other columns
pass through unchanged, whatever their names; the column of kinds takes the place of one with its name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import prod

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .common import small, stored, tidy

#: Times that a surrogate moves on where it is an entity of the corpus.
ROUNDS = 8
#: Given names by gender and script, fixed values. A surrogate comes from the same list.
GIVEN = {
    ("f", "latin"): "Mary Maria Anna Laura Julia Sarah Emma Sophie Marie Claire Elena Carmen Lucia Isabel Ingrid Petra Monika Heike Sabine Nathalie Camille".split(),
    ("m", "latin"): "John James Robert Michael David Peter Thomas Paul Martin Daniel Carlos Miguel Javier Diego Hans Klaus Stefan Pierre Michel Antoine".split(),
    ("f", "cyrillic"): "Анна Мария Ольга Елена Наталья Ирина Светлана Татьяна".split(),
    ("m", "cyrillic"): "Иван Сергей Дмитрий Алексей Николай Андрей Михаил Павел".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Ιωάννα".split(),
    ("m", "greek"): "Γιώργος Δημήτρης Νίκος Γιάννης Κώστας Παύλος".split(),
}
#: Titles before a name, fixed values.
TITLES = "Mr Mrs Ms Miss Dr Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Господин Госпожа Κύριος Κυρία".split()
#: Letters that replace each other in names and in codes, fixed values; any other letter is replaced by those of its case
#: among the 128 code points around it.
NAME_LETTERS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåæèéêëìíîïòóôõöøùúûü", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "αεηιουω", "άέήίόύώ", "βγδζθκλμνξπρστφχψ")
CODE_LETTERS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")
HEX_LETTERS = ("0123456789", "abcdef", "ABCDEF")
_GIVEN = {n: gs for gs, names in GIVEN.items() for n in names}
_NAME_WORDS = frozenset([*_GIVEN, *TITLES])
_WORD = re.compile(r"\w+")
_CAP = r"[A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏА-ЯЁ][\w’'-]*[a-zß-öø-ÿα-ωά-ώа-яё]"
_INITIALS = r"(?:[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ]\. ?)*"
_TITLED = re.compile(rf"\b({'|'.join(TITLES)})\.? (?:({_CAP}) )?{_INITIALS}({_CAP})")
_NAMED = re.compile(rf"\b({'|'.join(_GIVEN)}) {_INITIALS}({_CAP})")
_LOCAL_MARKS = frozenset("_.%+-")
_DOMAIN = re.compile(r"[^\W_][\w-]*(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_PHONE = re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,3}|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w.-])[2-6]\d{3}(?:[ -]?\d){9,15}(?![\w-])")
#: Lengths of an issuer's cards by their first digits; a card of one of these goes before any other reading.
_ISSUED = [(re.compile("4"), (13, 16, 19)), (re.compile("3[47]"), (15,)), (re.compile("5[1-5]|2"), (16,))]
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)")
_IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![\w:])")
_IP6_SHORT = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:])")
_SSN_SPACED = re.compile(r"(?i)\b(?:ssn|social security)\D{0,20}(\d{3} \d{2} \d{4})(?![\w-])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?!\w)")
#: Keys that tell themselves by how they begin (fixed forms); what follows is replaced.
_KEYS = re.compile(r"(?<!\w)(?:A[KS]IA([0-9A-Z]{16})|gh[pousr]_([A-Za-z0-9]{36,255}))(?!\w)|\b[Bb]earer ([A-Za-z0-9_+/=.-]{16,})")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9_+/=.-]{8,})")
_NUMERIC = re.compile(r"\d[\d ().-]{5,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban_ok(value: str) -> bool:
    return 2 <= int(value[2:4]) <= 98 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _cards(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Luhn numbers of 13 to 19 digits. What follows a card (expiry, CVV) or goes before it may be in the same run of
    digits, so a run is tried up to the end of each group of digits, then from its next group on.
    """
    m = _CARD.search(text)
    while m:
        ends = [i for i in range(m.start() + 13, m.end() + 1) if text[i - 1].isdecimal() and not text[i : i + 1].isdecimal()]
        numbers = [(end, digits) for end in ends if len(digits := re.sub(r"\D", "", text[m.start() : end])) >= 13 and luhn(digits)]
        usual = next((lengths for first, lengths in _ISSUED if first.match(m[0])), ())
        end, digits = max(numbers, key=lambda n: (len(n[1]) in usual, n[0]), default=(m.start() + 1, ""))
        if digits:
            yield m.start(), end, "card", digits
        m = _CARD.search(text, end)


def _name(word: str) -> tuple[str, str]:
    """Kind and normal form of a given name."""
    listed = word if word in _GIVEN else word.capitalize()
    return "given", listed if listed in _GIVEN else word.casefold()


def _names(text: str) -> Iterator[tuple[int, int, int, str, str]]:
    """Names behind titles and listed given names, then bare mentions of the names that these show."""
    forms: dict[str, tuple[str, str]] = {}

    def known(start: int, word: str, entity: tuple[str, str], rank: int) -> tuple[int, int, int, str, str]:
        forms.setdefault(word.casefold(), entity)
        return rank, start, start + len(word), *entity

    for m in _NAMED.finditer(text):
        yield known(m.start(1), m[1], _name(m[1]), 8)
        yield known(m.start(2), m[2], ("surname", m[2].casefold()), 8)
    titled = list(_TITLED.finditer(text))
    for m in titled:
        if m[2]:
            yield known(m.start(2), m[2], _name(m[2]), 7)
            yield known(m.start(3), m[3], ("surname", m[3].casefold()), 7)
    for m in titled:  # one name alone is what the document shows it to be elsewhere, else a surname
        if not m[2]:
            yield known(m.start(3), m[3], forms.get(m[3].casefold(), ("surname", m[3].casefold())), 7)
    if not forms:
        return
    for m in _WORD.finditer(text):
        if m[0][0].isupper() and (entity := forms.get(m[0].casefold())):
            yield 9, *m.span(), *entity
    if marked := [f for f in forms if not f.isalnum()]:
        for m in re.finditer(rf"(?i)(?<!\w)(?:{'|'.join(map(re.escape, sorted(marked, key=len, reverse=True)))})(?!\w)", text):
            if m[0][0].isupper() and (entity := forms.get(m[0].casefold())):
                yield 9, *m.span(), *entity


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of each entity, in order and without overlap."""
    if not text:
        return []
    found: list[tuple[int, int, int, str, str]] = []
    before, at = -1, text.find("@")
    while at >= 0:
        if domain := _DOMAIN.match(text, at + 1):
            start = at
            while start > before + 1 and ((c := text[start - 1]).isalnum() or c in _LOCAL_MARKS):
                start -= 1
            if any(c.isalnum() or c == "_" for c in text[start:at]):
                found.append((0, start, domain.end(), "email", text[start : domain.end()].lower()))
        before, at = at, text.find("@", at + 1)
    if "IA" in text or "gh" in text or "earer " in text:
        found += [(1, *m.span(m.lastindex), "secret", m[m.lastindex]) for m in _KEYS.finditer(text)]
    low = text.lower() if "=" in text or ":" in text else ""
    if low and any(w in low for w in ("token", "secret", "passw", "key")):
        found += [(1, m.start(1), m.end(1), "secret", m[1]) for m in _SECRET.finditer(text) if any(map(str.isalnum, m[1]))]
    if _NUMERIC.search(text):
        found += [(3, *c) for c in _cards(text)]
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                found.append((4, *m.span(), "ip", ".".join(str(int(x)) for x in m[0].split("."))))
        found += [(5, *m.span(), "ssn", m[0]) for m in _SSN.finditer(text)]
        found += [(5, *m.span(1), "ssn", m[1].replace(" ", "-")) for m in _SSN_SPACED.finditer(text) if _ssn_ok(m[1].replace(" ", "-"))]
        found += [(6, *m.span(), "phone", re.sub(r"\D", "", m[0])) for m in _PHONE.finditer(text)]
    if ":" in text:
        found += [(4, *m.span(), "ip6", m[0].lower()) for m in _IP6.finditer(text)]
        if "::" in text:  # at least one group, digits among them, so that scopes of code are none
            found += [(4, *m.span(), "ip6", m[0].lower()) for m in _IP6_SHORT.finditer(text) if re.search(r"\d", m[0]) and 2 <= len(re.findall(r"[0-9A-Fa-f]+", m[0])) <= 7]
    for m in _IBAN.finditer(text):
        flat = m[0].replace(" ", "").upper()
        if 15 <= len(flat) <= 34 and _iban_ok(flat):
            found.append((2, *m.span(), "iban", flat))
    if not _NAME_WORDS.isdisjoint(_WORD.findall(text)):  # both patterns begin with such a whole word
        found += _names(text)
    found.sort()
    starts: list[int] = []
    out: dict[int, tuple[int, int, str, str]] = {}
    for _, start, end, kind, form in found:
        i = bisect_left(starts, start)
        if (i == len(starts) or end <= starts[i]) and (i == 0 or out[starts[i - 1]][1] <= start):
            starts.insert(i, start)
            out[start] = (start, end, kind, form)
    return [out[i] for i in starts]


def _shuffled(value: int, bits: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of the numbers of `bits` bits (a Feistel network of eight rounds), or its inverse."""
    low = bits // 2
    high = bits - low
    a, b = value >> high, value & ((1 << high) - 1)
    for i in reversed(range(8)) if back else range(8):
        wide = low if i % 2 == 0 else high  # of the half that changes

        def mixed(half: int, i: int = i, wide: int = wide) -> int:
            seed = b"%d,%d,%d:" % (i, half, len(tweak)) + tweak
            raw = hashlib.blake2b(seed, key=key[:64]).digest() if wide <= 512 else hashlib.shake_256(key + seed).digest(wide // 8 + 1)
            return int.from_bytes(raw, "big") & ((1 << wide) - 1)

        if back:
            a, b = b ^ mixed(a), a
        else:
            a, b = b, a ^ mixed(b)
    return a << high | b


def _place(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of 0 to size - 1: the network is walked until it comes back into the range."""
    bits = max(2, (size - 1).bit_length())
    while (value := _shuffled(value, bits, key, tweak, back)) >= size:
        pass
    return value


def _along(value: int, size: int, key: bytes, tweak: bytes, step: int, good: Callable[[int], bool] = lambda _: True) -> int:
    """The number `step` + 1 places on in the keyed cycle through those numbers below size that are good, as value is."""
    if size < 2:
        return value
    at = _place(value, size, key, tweak)
    while True:
        at = (at + 1) % size
        new = _place(at, size, key, tweak, back=True)
        if good(new):
            if not step:
                return new
            step -= 1


def _foreign(c: str) -> bool:
    """Signs among letters, such as the micro sign: their other case is no single letter near by. They stay as they are."""
    return any(len(x) != 1 or abs(ord(x) - ord(c)) > 512 for x in (c.upper(), c.lower())) or ((c.islower() or c.isupper()) and c.upper() == c.lower())


@lru_cache(maxsize=4096)
def _letters(c: str, alphabets: tuple[str, ...]) -> str:
    """What may stand in the place of c."""
    for own in alphabets:
        if c in own:
            return own
    if not c.isalpha() or _foreign(c):
        return c
    block = map(chr, range(ord(c) & ~127, (ord(c) & ~127) + 128))
    return "".join(x for x in block if x.isalpha() and not _foreign(x) and (x.islower(), x.isupper()) == (c.islower(), c.isupper()) and not any(x in a for a in alphabets))


def _coded(form: str, alphabets: tuple[str, ...], key: bytes, tweak: str, step: int, good: Callable[[str], bool] | None = None) -> str:
    """form with each letter and digit replaced by one that may stand there: the value step + 1 places on in its cycle.

    Long forms go by stretches of 64 characters; what goes before a stretch is part of its tweak.
    """
    out = []
    for start in range(0, max(1, len(form)), 64):
        part = form[start : start + 64]
        ways = [_letters(c, alphabets) for c in part]
        sizes = [len(w) for w in ways]

        def text(n: int, ways=ways, sizes=sizes) -> str:
            back = []
            for w, s in zip(reversed(ways), reversed(sizes)):
                n, i = divmod(n, s)
                back.append(w[i])
            return "".join(reversed(back))

        value = 0
        for c, w, s in zip(part, ways, sizes):
            value = value * s + w.index(c)
        own = hashlib.blake2b(f"{tweak}\0{form[:start]}".encode()).digest()
        new = _along(value, prod(sizes), key, own, step, (lambda n: good(text(n))) if good and len(form) <= 64 else lambda _: True)
        out.append(text(new))
    return "".join(out)


def _hexadecimal(form: str) -> bool:
    return 16 <= len(form) <= 64 and all(c in "0123456789abcdefABCDEF" for c in form)


def _network(form: str) -> int:
    """How many leading numbers of an address tell what kind it is of."""
    a, b = map(int, form.split(".")[:2])
    if a in (0, 10, 127) or a >= 224:
        return 1
    return 2 if (a, b) == (192, 168) or (a == 172 and 16 <= b < 32) else 0


def _ssn_ok(form: str) -> bool:
    area, group, serial = form.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _issuer(number: str) -> int:
    return next((i for i, (first, _) in enumerate(_ISSUED) if first.match(number)), -1)


@lru_cache(maxsize=20_000)
def surrogate(kind: str, form: str, key: bytes, attempt: int = 0) -> str:
    """The normal form that replaces a normal form (of e-mail addresses: by the attempt of their domain)."""
    if kind == "given" and form in _GIVEN:  # a keyed rotation of the name's own list
        names = sorted(GIVEN[_GIVEN[form]], key=lambda n: hashlib.blake2b(n.encode(), key=key[:64]).digest())
        return names[(names.index(form) + 1) % len(names)]
    if kind == "given":
        return _coded(form[:-1], NAME_LETTERS, key, f"given {form[-1]}", attempt, lambda y: (y + form[-1]).capitalize() not in _GIVEN) + form[-1]
    if kind == "surname":
        return _coded(form, NAME_LETTERS, key, kind, attempt)
    if kind == "domain":
        *labels, top = form.split(".")
        return f"{_coded('.'.join(labels), CODE_LETTERS, key, kind, attempt)}.{top}"
    if kind == "email":
        local, _, domain = form.partition("@")
        return f"{_coded(local, CODE_LETTERS, key, f'local {domain}', 0)}@{surrogate('domain', domain, key, attempt)}"
    if kind == "card":
        body, size = form[1:-1], 10 ** (len(form) - 2)
        closed = lambda n: next(b + str(d) for b in [f"{form[0]}{n:0{len(body)}d}"] for d in range(10) if luhn(b + str(d)))
        return closed(_along(int(body), size, key, f"card {form[0]}{len(form)}".encode(), attempt, lambda n: _issuer(closed(n)) == _issuer(form)))
    if kind == "ip":
        numbers = [int(x) for x in form.split(".")]
        fixed = _network(form)
        address = lambda n: ".".join(map(str, [*numbers[:fixed], *(n >> 8 * i & 255 for i in reversed(range(4 - fixed)))]))
        value = int.from_bytes(bytes(numbers[fixed:]), "big")
        return address(_along(value, 256 ** (4 - fixed), key, f"ip {numbers[:fixed]}".encode(), attempt, lambda n: _network(address(n)) == fixed))
    if kind == "ip6":
        return _coded(form, ("0123456789abcdef",), key, kind, attempt)
    if kind == "iban":
        body = _coded(form[4:], CODE_LETTERS, key, f"iban {form[:2]}", attempt)
        rest = int("".join(str(int(c, 36)) for c in body + form[:2] + "00")) % 97
        return f"{form[:2]}{98 - rest:02d}{body}"
    if kind == "phone":
        head = max(0, len(form) - 10)
        # the digits that open an area and an exchange stay 2 to 9
        opens = lambda y: [y[i] < "2" for i in (0, 3) if i < len(y)]
        return form[:head] + _coded(form[head:], CODE_LETTERS, key, f"phone {form[:head]}", attempt, lambda y: opens(y) == opens(form[head:]))
    if kind == "ssn":
        return _coded(form, CODE_LETTERS, key, kind, attempt, lambda y: _ssn_ok(y) == _ssn_ok(form))
    if _hexadecimal(form):
        return _coded(form, HEX_LETTERS, key, "hex", attempt)
    return _coded(form, CODE_LETTERS, key, kind, attempt, lambda y: not _hexadecimal(y))


def dress(kind: str, new: str, original: str) -> str:
    """The surrogate in the spelling of the mention: its separators, its case."""
    if kind in ("phone", "card", "iban", "ssn"):
        chars = iter(new.replace("-", "") if kind == "ssn" else new)
        return "".join((next(chars).lower() if c.islower() else next(chars)) if c.isalnum() else c for c in original)
    if kind in ("email", "ip6", "surname", "given"):
        if len(original) > 1 and original == original.upper() != original.lower():
            return new.upper()
        if kind == "given" and new in _GIVEN:
            return new
        if len(original) == len(new):
            return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new))
        return new.capitalize() if original[:1].isupper() else new
    return new


def _unit(kind: str, form: str) -> tuple[str, str]:
    """What the collision check looks at for an entity."""
    return ("domain", form.partition("@")[2]) if kind == "email" else (kind, form)


def rewrite(text: str | None, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str | None, list[str]]:
    """The text with surrogates, and the kinds replaced."""
    spans = find(text)
    if not spans:
        return text, []
    parts, at = [], 0
    for start, end, kind, form in spans:
        parts += [text[at:start], dress(kind, surrogate(kind, form, key, attempts.get(_unit(kind, form), 0)), text[start:end])]
        at = end
    return "".join([*parts, text[at:]]), [s[2] for s in spans]


def _forget() -> None:
    surrogate.cache_clear()


def mentions(df: DataFrame, text: str) -> DataFrame:
    """digest of the text, kind and form of each distinct unit of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                rows = [(k, *e) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for e in {_unit(*s[2:]) for s in find(t)}]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in list(zip(*rows)) or [()] * 3], names=["digest", "kind", "form"])

    return df.select(F.md5(text).alias("digest"), F.col(text).alias("text")).mapInArrow(tidy(run), "digest string, kind string, form string")


def collisions(units: DataFrame, secret: bytes) -> DataFrame | None:
    """(kind, form, attempt) of the units whose first surrogates are units themselves; None if there are none.

    A later attempt counts if its surrogate is no unit and no unit has been offered it before.
    """

    @F.udf("string", useArrow=True)
    def new(kind, form, attempt):
        return surrogate(kind, form, secret, attempt)

    listed = (F.col("kind") == "given") & F.col("form").isin([*_GIVEN])
    units = stored(units.filter(~listed).select("kind", "form").distinct(), "units")
    real = units.select("kind", F.col("form").alias("new"))
    offered = stored(units.withColumn("attempt", F.lit(0)).withColumn("new", new("kind", "form", "attempt")), "offered")
    again, taken, moved = stored(offered.join(real, ["kind", "new"], "left_semi").select("kind", "form"), "again"), real.union(offered.select("kind", "new")), None
    if not again.limit(1).count():
        return None
    for attempt in range(1, ROUNDS + 1):
        offer = stored(again.withColumn("attempt", F.lit(attempt)).withColumn("new", new("kind", "form", "attempt")), "offer")
        free = stored(offer.join(taken, ["kind", "new"], "left_anti").select("kind", "form", "attempt"), "free")
        moved = free if moved is None else moved.union(free)
        again = stored(again.join(free, ["kind", "form"], "left_anti"), "again")
        taken = taken.union(offer.select("kind", "new"))
        if not again.limit(1).count():
            break
    return stored(moved, "moved")


def surrogates(df: DataFrame, secret: bytes, text: str = "text", kinds: str | None = "pii_kinds") -> DataFrame:
    """df with the text rewritten and, if `kinds` names a column, the kinds replaced (in order of place)."""
    found = stored(mentions(df, text), "mentions")
    moved = collisions(found, secret)
    columns = [c for c in df.columns if c != kinds]
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.md5(text).alias("digest"))
    if moved is None:
        source = source.select("row", F.lit(None).cast("array<struct<kind:string,form:string,attempt:int>>").alias("tries"))
    else:
        tries = found.join(small(moved), ["kind", "form"]).groupBy("digest").agg(F.collect_set(F.struct("kind", "form", "attempt")).alias("tries"))
        source = source.join(small(stored(tries, "tries")), "digest", "left").select("row", "tries")
    at, row = columns.index(text), source.schema["row"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                fields = [pc.struct_field(b.column(0), [i]) for i in range(len(columns))]
                tries = [{(x["kind"], x["form"]): x["attempt"] for x in t or ()} for t in b.column(1).to_pylist()]
                new, names = zip(*[rewrite(t, secret, a) for t, a in zip(fields[at].to_pylist(), tries)])
                fields[at] = pa.array(new, fields[at].type)
                rows = pa.StructArray.from_arrays(fields, fields=list(b.schema.field(0).type))
                yield pa.RecordBatch.from_arrays([rows, pa.array(names, pa.list_(pa.string()))], names=["row", "kinds"])

    out = source.mapInArrow(tidy(run, _forget), StructType([StructField("row", row), StructField("kinds", ArrayType(StringType()))]))
    return out.select("row.*", F.col("kinds").alias(kinds)) if kinds else out.select("row.*")
