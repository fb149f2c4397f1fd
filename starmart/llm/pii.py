"""Personal data: format-preserving pseudonyms from a keyed Feistel network.

Found and validated: e-mail addresses, IBANs (mod 97; all letters of one case),
payment cards (13 to 19 digits, Luhn, with blanks or hyphens, or four groups of
four with dots), IPv4 addresses (octets up to 255) and IPv6 addresses (letters of one
case), US social security numbers (no reserved area, group or serial), dates
(that exist, 1900 to 2099; in numbers with hyphens, dots or slashes, year first
or last, with slashes month first where that is a date, else day first; or with
an English month) and phone numbers (a country code or an area code in brackets
or three groups or a leading zero and pairs, 10 to 15 digits). Where two finds
overlap the earlier kind of that list wins. Not covered: phone numbers written
as ten bare digits, which nothing tells from other numbers, dates with a year of
two digits, and month names of other languages.

Other tokens beside an IBAN or a card (BIC, expiry, CVV, another number) do not
hide it. An IBAN ends where its country's length says; failing that, at the
last end of a token at which it is valid. Of a run of digit groups the valid
cards are taken from the left, the longest first, and an unusual grouping gives
way to a usual one that overlaps it: the whole run, or up to five neighbouring
groups (six or more short numbers in a longer run are a table rather than a
card; an unusual grouping does not count inside what has an IBAN's country and
length). Where a card's pseudonym would make its run read differently it is
permuted again, so that ``reveal`` finds the same spans; such a value is not
linked to its others. A neighbour of another kind (a date within the run, say)
gets its pseudonym later and can still, rarely, make ``reveal`` read otherwise.

A value's symbols (digits, letters) are permuted by a Feistel network over
their mixed radix: two halves, each in turn shifted by a keyed BLAKE2 hash of
the other, modulo its size. This is a bijection per key and format, so equal
values get equal pseudonyms in all documents (they stay linked), different
values different ones, and the key's holder can undo it (``reveal``).
Separators, letter case, country codes, a card's first digit and an address's
top-level domain stay; check digits are computed anew; a result that is not
valid in its format (no such social security number, say) is permuted again
until it is, which keeps the bijection. Dates are permuted among the days of
1900 to 2099 and written in their own format (of one where only one field has
a leading zero, ``reveal`` gives the other without).

Null text stays null, empty text empty. Bytes that are not UTF-8 stay as they
are. Work goes document by document, whole; a kind is not searched for in a
document that holds too few digits (or no @, or too few dots or colons) for a
single value of it, so whether a value is found does not depend on others in
the document. Repeated rows each give a row; other columns are
ignored. The key is a parameter; whoever holds it can link and undo.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, lean, with_id

ROUNDS = 8
KINDS = ("email", "iban", "card", "ip", "ssn", "date", "phone")
_FIND = {
    "email": re.compile(rb"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    "iban": re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?= ?[A-Z0-9])"),  # its first four; _iban_ends tells where it ends
    "card": re.compile(rb"(?<!\d)(?<!\d\.)\d(?:[ -]?\d){12,}"),  # the whole run; _cards_in tells which parts
    "dotted": re.compile(rb"(?<![\d.])\d{4}(?:\.\d{4}){3}(?!\.?\d)"),
    "ip": re.compile(rb"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"),
    "ip6": re.compile(rb"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{3,39}(?![\w:])(?!\.\d)"),
    "ssn": re.compile(rb"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "date": re.compile(rb"(?<![\d/.-])(?:(\d{4})(?P<iso>[-/.])(\d{2})(?P=iso)(\d{2})|(\d{1,2})(?P<mark>[/.-])(\d{1,2})(?P=mark)(\d{4}))(?![\d/-])(?!\.\d)"),
    "named": re.compile(rb"(?<![\w/.-])(?:(?P<d1>\d{1,2}) (?P<m1>MONTH) (?P<y1>\d{4})|(?P<m2>MONTH) (?P<d2>\d{1,2}), (?P<y2>\d{4}))(?!\w)".replace(
        b"MONTH", b"Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?")),
    "phone": re.compile(rb"(?<![\w+])(?<!\d[ .-])(?:\+(\d{1,3})[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![ .-]?\d)|(?<![\w+])\+(\d{1,3})[ .-]?\d{9,12}(?!\d)|(?<![\w+])(?<!\d[ .-])(?:\+(?P<far>\d{2})[ .-]?\d|0[1-9])(?P<gap>[ .-])\d\d(?:(?P=gap)\d\d){3}(?![ .-]?\d)"),
}
MONTHS = "January February March April May June July August September October November December".split()
#: Length of an IBAN by country (SWIFT registry).
IBAN_LENGTH = {c.encode(): int(n) for n, cs in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
_USUAL = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 4, 1), (4, 4, 5), (6, 13), *((n,) for n in range(13, 20))}
FIRST_DAY, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
#: The fewest digits, and other bytes, that a text with a value of the kind has.
_LEAST = {"email": (0, b"@", 1), "iban": (2, b"", 0), "card": (13, b"", 0), "ip": (0, b"", 0), "ssn": (9, b"", 0), "date": (5, b"", 0), "phone": (10, b"", 0)}
_GROUP = re.compile(rb"\d+")
_NON_DIGITS = bytes(i for i in range(256) if not 48 <= i <= 57)


# ------------------------------------------------------------------ Feistel
class Feistel:
    """Keyed bijections of numbers in a mixed radix."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _shift(self, kind: str, radices: tuple, r: int, half: int) -> int:
        data = f"{kind}|{radices}|{r}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def run(self, symbols: list[int], radices: list[int], kind: str, back: bool = False) -> list[int]:
        radices = tuple(radices)
        if len(radices) == 1:  # one symbol: split into a walk over its own digits is no use; add a keyed constant
            d = self._shift(kind, radices, 0, 0)
            return [(symbols[0] + (-d if back else d)) % radices[0]]
        mid = len(radices) // 2
        sides = [_number(symbols[:mid], radices[:mid]), _number(symbols[mid:], radices[mid:])]
        sizes = [_product(radices[:mid]), _product(radices[mid:])]
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            d = self._shift(kind, radices, r, sides[1 - r % 2])
            sides[r % 2] = (sides[r % 2] + (-d if back else d)) % sizes[r % 2]
        return _symbols(sides[0], radices[:mid]) + _symbols(sides[1], radices[mid:])

    def walk(self, symbols, radices, kind, valid, back=False):
        """Permute until valid: a bijection of the valid values."""
        while True:
            symbols = self.run(symbols, radices, kind, back)
            if valid(symbols):
                return symbols


def _product(radices) -> int:
    p = 1
    for r in radices:
        p *= r
    return p


def _number(symbols, radices) -> int:
    n = 0
    for s, r in zip(symbols, radices):
        n = n * r + s
    return n


def _symbols(n: int, radices) -> list[int]:
    out = []
    for r in reversed(radices):
        n, s = divmod(n, r)
        out.append(s)
    return out[::-1]


# --------------------------------------------------------- one value each
def _luhn(digits: list[int]) -> int:
    """Sum of a number whose last digit is the check digit, modulo 10."""
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(reversed(digits))) % 10


def _digits(raw: bytes) -> list[int]:
    return [c - 48 for c in raw if 48 <= c <= 57]


def _put_digits(raw: bytes, digits: list[int]) -> bytes:
    it = iter(digits)
    return bytes(48 + next(it) if 48 <= c <= 57 else c for c in raw)


def _permute_text(f: Feistel, raw: bytes, kind: str, back: bool) -> bytes:
    """Digits among digits and letters among letters; all else, and case, stays."""
    radices, symbols = [], []
    for c in raw:
        if 48 <= c <= 57:
            radices.append(10)
            symbols.append(c - 48)
        elif 65 <= c <= 90 or 97 <= c <= 122:
            radices.append(26)
            symbols.append((c | 32) - 97)
    if not radices:
        return raw
    it = iter(f.run(symbols, radices, kind, back))
    return bytes(48 + next(it) if 48 <= c <= 57 else (65 if c < 97 else 97) + next(it) if 65 <= c <= 90 or 97 <= c <= 122 else c for c in raw)


def _email(f, m, back):
    local, _, domain = m[0].rpartition(b"@")
    host, dot, top = domain.rpartition(b".")
    new = _permute_text(f, host, "host", back)
    # a single symbol could only be shifted by a constant: its host decides which
    single = sum(chr(c).isalnum() for c in local) == 1
    kind = f"local {(new if back else host).decode().lower()}" if single else "local"
    return _permute_text(f, local, kind, back) + b"@" + new + dot + top


def _iban_check(country: bytes, body: bytes) -> int:
    return int("".join(str(int(chr(c), 36)) for c in body + country + b"00")) % 97


def _iban_ends(text: bytes, start: int) -> list[int]:
    """Ends of tokens that leave 15 to 34 symbols from ``start``, the longest first."""
    ends, n, i = [], 4, start + 4
    while n < 34:
        i += text[i : i + 1] == b" "
        c = text[i : i + 1]
        if not (c.isdigit() or c.isupper()):
            break
        n, i = n + 1, i + 1
        if n >= 15 and not text[i : i + 1].isalnum():
            ends.append(i)
    return ends[::-1]


def _iban_end(text: bytes, start: int, own: bool) -> int | None:
    """Where the IBAN from ``start`` ends: with ``own`` only its country's length counts."""
    for end in _iban_ends(text, start):
        plain = text[start:end].replace(b" ", b"")
        if (not own or len(plain) == IBAN_LENGTH.get(plain[:2])) and 98 - _iban_check(plain[:2], plain[4:]) == int(plain[2:4]):
            return end
    return None


def _ibans(text, f, back, free):
    starts = [m.start() for m in _FIND["iban"].finditer(text)]
    for own in (True, False):
        for start in starts:
            end = _iban_end(text, start, own)
            if end is None or not free(start, end):
                continue
            raw, after = text[start:end], text[end : end + 60]
            new = raw.replace(b" ", b"")
            while True:
                body = _permute_text(f, new[4:], "iban", back)
                new = new[:2] + b"%02d" % (98 - _iban_check(new[:2], body)) + body
                it = iter(new)
                spaced = bytes(c if c == 32 else next(it) for c in raw)
                if own or _iban_end(spaced + after, 0, True) is None and _iban_end(spaced + after, 0, False) == len(raw):
                    break
            yield start, end, spaced


_FOLDED = bytes(124 if 65 <= c <= 90 else c - 32 if 97 <= c <= 122 else c for c in range(256))


def _lower_ibans(text, f, back, free):
    """IBANs in small letters: read as capitals, while capitals are no part of one; their country's length counts."""
    folded = text.translate(_FOLDED)
    for m in _FIND["iban"].finditer(folded):
        end = _iban_end(folded, m.start(), True)
        if end is not None and text[m.start() : m.start() + 2].islower() and free(m.start(), end):
            plain = folded[m.start() : end].replace(b" ", b"")
            body = _permute_text(f, plain[4:], "iban", back)
            it = iter((plain[:2] + b"%02d" % (98 - _iban_check(plain[:2], body)) + body).lower())
            yield m.start(), end, bytes(c if c == 32 else next(it) for c in text[m.start() : end])


def _all_ibans(text, f, back, free):
    yield from _ibans(text, f, back, free)
    yield from _lower_ibans(text, f, back, free)


def _is_card(d) -> bool:
    return not _luhn(d) and len(set(d)) > 1


def _iban_shaped(text: bytes) -> list[tuple[int, int]]:
    """Spans with an IBAN's country and length, whatever their check digits."""
    starts = [m.start() for m in _FIND["iban"].finditer(text)]
    return [(a, z) for a in starts for z in _iban_ends(text, a) if len(text[a:z].replace(b" ", b"")) == IBAN_LENGTH.get(text[a : a + 2])]


def _card_from(run: bytes, groups: list, i: int, codes) -> tuple | None:
    """(unusual, start, end, index after it) of the best card that starts with group ``i``."""
    best, n, a = None, 0, groups[i][0]
    for j in range(i, len(groups)):
        z = groups[j][1]
        n += z - groups[j][0]
        if n > 19:
            break
        whole = j - i == len(groups) - 1
        if n < 13 or j - i > 4 and not whole or not _is_card(_digits(run[a:z])):
            continue
        usual = tuple(y - x for x, y in groups[i : j + 1]) in _USUAL and len({run[y] for _, y in groups[i:j]}) < 2
        if (usual or whole or not any(a < e and s < z for s, e in codes)) and not (best and usual < (not best[0])):
            best = (not usual, a, z, j + 1)
    return best


def _cards_in(run: bytes, groups: list, codes, i: int = 0, end: int | None = None) -> list[tuple]:
    """The cards of a run of digit groups, from group ``i`` to (before) byte ``end``."""
    out, end = [], len(run) if end is None else end
    while i < len(groups) and groups[i][0] < end:
        c, j = _card_from(run, groups, i, codes), i + 1
        while c and c[0] and j < c[3]:  # an unusual grouping gives way to a usual one that overlaps
            later = _card_from(run, groups, j, codes)
            c, j = None if later and not later[0] else c, j + 1
        if c:
            out.append(c)
        i = c[3] if c else i + 1
    return out


def _cards(text, f, back, free):
    shaped = None
    for m in _FIND["card"].finditer(text):
        shaped = _iban_shaped(text) if shaped is None else shaped
        for a, z in [m.span()] if free(*m.span()) else _open(m, free):
            run, codes = bytearray(text[a:z]), [(s - a, e - a) for s, e in shaped if s < z and a < e]
            groups = [g.span() for g in _GROUP.finditer(run)]
            cards = _cards_in(run, groups, codes)
            for k in reversed(range(len(cards))) if back else range(len(cards)):
                _, s, e, _ = cards[k]
                near = max(0, k - 3)  # what a card's digits can change starts at most 19 digits before it
                d = _digits(run[s:e])

                def fits(mid):
                    new = [d[0], *mid]
                    run[s:e] = _put_digits(run[s:e], [*new, (10 - _luhn([*new, 0])) % 10])
                    return _cards_in(run, groups, codes, cards[near - 1][3] if near else 0, e) == cards[near : k + 1]

                f.walk(d[1:-1], [10] * (len(d) - 2), "card", fits, back)
            for _, s, e, _ in cards:
                yield a + s, a + e, bytes(run[s:e])


def _open(m, free):
    """The parts of a run between earlier finds, by whole groups."""
    a = z = None
    for g in _GROUP.finditer(m.string, *m.span()):
        if free(*g.span()):
            a, z = g.start() if a is None else a, g.end()
        elif a is not None:
            yield a, z
            a = None
    if a is not None:
        yield a, z


def _ip(f, m, back):
    octets = [int(x) for x in m[0].split(b".")]
    if max(octets) > 255:
        return None
    return b".".join(b"%d" % x for x in f.run(octets, [256] * 4, "ip", back))


def _dotted(f, m, back):
    d = _digits(m[0])
    if not _is_card(d):
        return None
    check = lambda mid: [d[0], *mid, (10 - _luhn([d[0], *mid, 0])) % 10]
    return _put_digits(m[0], check(f.walk(d[1:-1], [10] * 14, "card", lambda mid: len(set(check(mid))) > 1, back)))


def _ip6(f, m, back):
    """Hexadecimal digits of each group among themselves; the groups stay as they are written."""
    raw = m[0]
    try:
        ipaddress.IPv6Address(raw.decode())
    except ValueError:
        return None
    low, up = any(97 <= c <= 102 for c in raw), any(65 <= c <= 70 for c in raw)
    symbols = [int(chr(c), 16) for c in raw if c != 58]
    if low and up or len(symbols) < 4:
        return None
    # with letters or without, as before: else the case could not be told afterwards
    it = iter(f.walk(symbols, [16] * len(symbols), "ip6", lambda s: any(x > 9 for x in s) == (low or up), back))
    new = bytes(c if c == 58 else b"0123456789abcdef"[next(it)] for c in raw)
    return new.upper() if up else new


def _is_ssn(d) -> bool:
    area = d[0] * 100 + d[1] * 10 + d[2]
    return area not in (0, 666) and area < 900 and any(d[3:5]) and any(d[5:])


def _ssn(f, m, back):
    d = _digits(m[0])
    return _put_digits(m[0], f.walk(d, [10] * 9, "ssn", _is_ssn, back)) if _is_ssn(d) else None


def _is_date(y, mo, d) -> bool:
    try:
        return 1900 <= y <= 2099 and bool(dt.date(y, mo, d))
    except ValueError:
        return False


def _date(f, m, back):
    if m[1]:
        y, mo, d, form = int(m[1]), int(m[3]), int(m[4]), "iso"
    else:
        a, b, y = int(m[5]), int(m[7]), int(m[8])
        form = "month" if m["mark"] == b"/" and _is_date(y, a, b) else "day"
        mo, d = (a, b) if form == "month" else (b, a)
    if not _is_date(y, mo, d):
        return None

    slashed = form == "day" and m["mark"] == b"/"
    bare = form != "iso" and 1 in (len(m[5]), len(m[7]))  # written without leading zeros

    def fits(new):
        if slashed and new.day <= 12:
            return False  # it would read as month-first
        return not bare or new.day < 10 or new.month < 10  # else it would read as written with zeros

    new = _permute_day(f, dt.date(y, mo, d), f"date {form} {bare}" if bare or slashed else "date", fits, back)
    if form == "iso":
        return new.isoformat().encode().replace(b"-", m["iso"])
    wide = b"%d" if bare else b"%02d"
    a, b = (new.month, new.day) if form == "month" else (new.day, new.month)
    return wide % a + m["mark"] + wide % b + m["mark"] + b"%04d" % new.year


def _permute_day(f, day: dt.date, kind: str, fits, back) -> dt.date:
    number = day.toordinal() - FIRST_DAY
    while True:
        s = f.run(list(divmod(number, 512)), [143, 512], kind, back)
        number = s[0] * 512 + s[1]
        if number < DAYS and fits(dt.date.fromordinal(FIRST_DAY + number)):
            return dt.date.fromordinal(FIRST_DAY + number)


def _named(f, m, back):
    """A date with an English month, whole or its first three letters."""
    first = m["m1"] is not None  # the day comes first
    name, d, y = (m["m1"], m["d1"], m["y1"]) if first else (m["m2"], m["d2"], m["y2"])
    mo = next(i for i, n in enumerate(MONTHS, 1) if n.startswith(name.decode()))
    if not _is_date(int(y), mo, int(d)):
        return None
    short, zero = len(name) == 3, d[:1] == b"0"
    # May is short and whole at once: it stays the form that it is read as, short
    fits = lambda new: (short or new.month != 5) and (not zero or new.day < 10)
    new = _permute_day(f, dt.date(int(y), mo, int(d)), f"date named {short} {zero}", fits, back)
    month = MONTHS[new.month - 1][: 3 if short else None].encode()
    day = (b"%02d" if zero else b"%d") % new.day
    return day + b" " + month + b" %04d" % new.year if first else month + b" " + day + b", %04d" % new.year


def _phone(f, m, back):
    raw, code = m[0], m[1] or m[2] or m["far"] or b""
    d = _digits(raw)
    n = len(d) - len(code)
    if not 10 <= len(d) <= 15 or n < 7:
        return None
    trunk = not code and raw[:1] == b"0"  # the leading zero of a number within a country stays
    if trunk:
        code, n = b"0", n - 1
    north = n == 10 and code in (b"", b"1")
    fine = (lambda s: s[0] > 1 and s[3] > 1) if north and d[-10] > 1 and d[-7] > 1 else (lambda s: not trunk or (s[0] > 0) == (d[1] > 0))
    return _put_digits(raw, [*d[: len(code)], *f.walk(d[len(code) :], [10] * n, f"phone{code.decode()}", fine, back)])


def _each(kind, make):
    """Finds of a kind that its pattern delimits."""
    def finds(text, f, back, free):
        for m in _FIND[kind].finditer(text):
            if free(*m.span()):
                new = make(f, m, back)
                if new is not None:
                    yield *m.span(), new
    return finds


def _chain(*finds):
    def every(text, f, back, free):
        for find in finds:
            yield from find(text, f, back, free)
    return every


_EACH = {k: _each(k, make) for k, make in {"email": _email, "dotted": _dotted, "ip": _ip, "ip6": _ip6, "ssn": _ssn, "date": _date, "named": _named, "phone": _phone}.items()}
_FINDS = {k: _EACH[k] for k in ("email", "ssn", "phone")} | {
    "iban": _all_ibans, "card": _chain(_cards, _EACH["dotted"]), "ip": _chain(_EACH["ip"], _EACH["ip6"]), "date": _chain(_EACH["date"], _EACH["named"])}


def pseudonyms(text: bytes, f: Feistel, back: bool = False) -> tuple[bytes, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each find in the given text, in bytes."""
    digits = len(text.translate(None, _NON_DIGITS))
    found: list[tuple[int, int, str, bytes]] = []
    taken = bytearray(len(text))
    for kind in KINDS:
        least, mark, times = _LEAST[kind]
        if digits < least or times and text.count(mark) < times:
            continue
        if kind == "ip" and (digits < 4 or text.count(b".") < 3) and text.count(b":") < 2:
            continue
        for a, z, new in _FINDS[kind](text, f, back, lambda a, z: 1 not in taken[a:z]):
            found.append((a, z, kind, new))
            taken[a:z] = b"\1" * (z - a)
    found.sort()
    out, at = [], 0
    for a, z, _, new in found:
        out += [text[at:a], new]
        at = z
    return b"".join([*out, text[at:]]), [x[:3] for x in found]


def _apply(docs: DataFrame, key: bytes, id_col: str, text_col: str, back: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = with_id(docs, id_col, ("text", "binary"), *((f"n_{k}", "int") for k in KINDS))
    arrow = to_arrow_schema(schema)

    def run(batches):
        f = Feistel(key)
        for b in batches:
            out = [(None, []) if t is None else pseudonyms(t, f, back) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(x[2] == k for x in o[1]) for o in out], pa.int32()) for k in KINDS]
            yield batch_of(arrow, [b.column(0), [o[0] for o in out], *counts])

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), schema).withColumn("text", F.col("text").cast("string"))


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text with pseudonyms, and how many of each kind."""
    return _apply(docs, key, id_col, text_col, False)


def reveal(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverse of ``pseudonymise`` with the same key."""
    return _apply(docs, key, id_col, text_col, True)
