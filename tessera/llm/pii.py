"""Operator 5, PII: format-preserving Feistel pseudonyms.

Personal values are found by their form and validated: payment cards by the Luhn sum, IBANs by their
check digits, IPv4 addresses by their octets, dates by the calendar, social security numbers by their
areas.  Where the longest match fails its check, its other ends are tried (an IBAN's by its country's
length, a card's by the usual groups of digits), then the other kinds, then what begins after its first
group of characters; what fails them all is left alone.  A found value is replaced by its image under a
keyed permutation of all values of its format (a Feistel network on mixed radices, walked until the
image is in the format), so equal values stay equal in every document and task, different values stay
different, and only the holder of the key can go back.  Separators, case and lengths stay, check
digits are computed anew.  Values are compared by what they say: a card with and without spaces maps
to the same digits, a date to the same day in every form (the image agrees with it in whether day and
month have one digit, and whether the day is above 12).  A line whose images would be read differently
than its values is permuted again as a whole until they aren't; only there do equal values part.  A
grouped card of 17 to 19 digits whose first 16 are a valid card as well is read as that card.

Kinds: e-mail addresses (the local part), IBANs, quoted or named hexadecimal secrets, IPv4 addresses,
dates (from 1900 to 2099), social security numbers, phone numbers, payment cards.  A permutation may
map a value of a very small format to itself.

Null texts stay null, empty texts empty.  Repeated rows are treated alike.  Extra columns don't matter.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The key of the registered query; real runs pass their own secret.
DEMO_KEY = b"pseudonyms-demo"
ROUNDS = 8

# Formats of personal data.
FORMATS = {
    "email": r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "secret": r"(?<![\w])[0-9a-fA-F]{32,128}(?!\w)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})(?!(?!T\d)\w|[./-]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\w)|(?<![\w+])\+\d{7,15}(?!\w)|(?<![\w.-])\d{3}(?:[.-]\d{3}[.-]| \d{3} )\d{4}(?![\w]|[.-]\d)",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)",
}
KINDS = list(FORMATS)
_ONE = {k: re.compile(v) for k, v in FORMATS.items()}
#: An address is looked for from the start of its run of characters only, else a long run is read once for each of them.
_FIND = re.compile("|".join(f"(?P<{k}>{v})" for k, v in FORMATS.items()).replace("(?P<email>", r"(?P<email>(?<![\w.%+-])", 1))
_RUN = re.compile(r"[\w.%+-]+")
_MAYBE = re.compile(r"\d|@|[0-9a-fA-F]{32}")

_EPOCH = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _EPOCH
_AREAS = [a for a in range(1, 900) if a != 666]
_LATIN = "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_CLASSES = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _LATIN]
_CLASS = {ch: (c, c.index(ch)) for c in _CLASSES for ch in c}
_HEX = {x: ("0123456789abcdef", i) for i, x in enumerate("0123456789abcdef")}
#: The usual groups of a card's digits, the likeliest first.
_CARDS = [re.compile(x + r"(?!\w|\.\d)") for x in (r"[2-6]\d{3}([ -]?)\d{4}\1\d{4}\1\d{4}", r"3\d{3}([ -])\d{6}\1\d{4,5}", r"[2-6]\d{12,18}", r"[2-6]\d{3}([ -])\d{4}\1\d{4}\1\d{4}\1\d{1,3}", r"[2-6]\d{3}([ -])\d{4}\1\d{4}\1\d")]
_GROUP = re.compile(r"[^\W_]+|.", re.S)
_IBAN_SIZES = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK FO FI GL NL SD FK 19:MK SI 20:AT BA EE KZ LT LU XK MN 21:CH HR LI LV 22:BG BH CR DE GB GE IE ME RS VA "
    "23:AE GI IL IQ TL OM SO 24:AD CZ ES MD PK RO SA SE SK TN VG DZ 25:PT ST LY 26:IS TR 27:BI DJ FR GR IT MC MR SM CM CF CG GA GQ TD KM MG "
    "28:AL AZ BY CY DO GT HU LB PL SV NI SN CI ML BJ BF NE TG HN MA 29:BR EG PS QA UA 30:JO KW MU YE 31:MT SC 32:LC 33:RU").replace(" ", ",").replace(",1", " 1").replace(",2", " 2").replace(",3", " 3").split()) for c in cs.split(",")}
_CODES = {str(x) for x in (20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98)}


def _date_form(i: int) -> tuple[int, bool]:
    d = datetime.date.fromordinal(_EPOCH + i)
    return (d.day > 9) + (d.day > 12), d.month > 9


_FORM_DAYS: dict[tuple[int, bool], list[int]] = {}
for _i in range(_DAYS):
    _FORM_DAYS.setdefault(_date_form(_i), []).append(_i)


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size): an alternating Feistel network on a x b >= size, walked
    along its cycle until it is in range.  ``back`` inverts it."""
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    width = (max(a, b).bit_length() + 7) // 8
    out = width + 8
    salt = hashlib.blake2b(f"{tweak}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def noise(i: int, x: int) -> int:
        data = bytes([i]) + x.to_bytes(width, "big")
        if out <= 64:
            return int.from_bytes(hashlib.blake2b(data, key=salt, digest_size=out).digest(), "big")
        return int.from_bytes(hashlib.shake_256(salt + data).digest(out), "big")

    while True:
        x, y = divmod(value, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                y = (y + sign * noise(i, x)) % b
            else:
                x = (x + sign * noise(i, y)) % a
        value = x * b + y
        if value < size:
            return value


def _spelled(chars: str, classes: dict, key: bytes, tweak: str, back: bool) -> str:
    """Characters permuted within their classes; others stay, and so do the classes' places."""
    value, size, shape = 0, 1, []
    for ch in chars:
        c = classes.get(ch)
        shape.append(c[0] if c else ch)
        if c:
            value, size = value * len(c[0]) + c[1], size * len(c[0])
    value = permute(value, size, key, tweak + "".join(s if len(s) == 1 else f"<{len(s)}{s[0]}>" for s in shape), back)
    out = []
    for s in reversed(shape):
        if len(s) > 1:
            value, i = divmod(value, len(s))
            s = s[i]
        out.append(s)
    return "".join(reversed(out))


def _digits(number: str, key: bytes, tweak: str, back: bool) -> str:
    return str(permute(int(number), 10 ** len(number), key, f"{tweak}{len(number)}", back)).zfill(len(number)) if number else ""


def _fill(template: str, digits: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if ch.isascii() and ch.isdigit() else ch for ch in template)


def luhn(payload: str) -> int:
    """The check digit of a payload."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(payload)))
    return -total % 10


def _iban_check(country: str, bban: str) -> str:
    return f"{98 - int(''.join(str(int(ch, 36)) for ch in bban + country + '00')) % 97:02d}"


def _email(s, key, back):
    local, domain = s.rsplit("@", 1)
    return _spelled(local, _CLASS, key, "email" + domain.lower(), back) + "@" + domain


def _iban(s, key, back):
    plain = s.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_check(plain[:2], plain[4:]) != plain[2:4]:
        return None
    bban = _spelled(plain[4:], _CLASS, key, "iban" + plain[:2], back)
    rest = iter(plain[:2] + _iban_check(plain[:2], bban) + bban)
    return "".join(ch if ch == " " else next(rest) for ch in s)


def _secret(s, key, back):
    upper = any(ch in "ABCDEF" for ch in s)
    if upper and any(ch in "abcdef" for ch in s) or not re.search("[a-fA-F]", s):
        return None
    out = _spelled(s.lower(), _HEX, key, "secret", back)
    while not re.search("[a-f]", out):  # digits alone wouldn't be read as a secret
        out = _spelled(out, _HEX, key, "secret", back)
    return out.upper() if upper else out


def _ip(s, key, back):
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    n = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def _date(s, key, back):
    iso = "-" in s
    first, second, third = re.split("[./-]", s)
    y, m, d = (first, second, third) if iso else (third, second, first)
    swap = not iso and int(m) > 12
    if swap:  # month first
        m, d = d, m
    try:
        day = datetime.date(int(y), int(m), int(d)).toordinal() - _EPOCH
    except ValueError:
        return None
    if not 0 <= day < _DAYS or not iso and s[len(first)] != s[-5]:
        return None
    form = _date_form(day)
    days = _FORM_DAYS[form]
    image = permute(bisect_left(days, day), len(days), key, f"date {form[0]} {int(form[1])}", back)
    to = datetime.date.fromordinal(_EPOCH + days[image])
    if iso:
        return f"{to.year:04d}-{to.month:02d}-{to.day:02d}"
    x, z = (to.month, to.day) if swap else (to.day, to.month)
    return f"{x:0{len(first)}d}{s[-5]}{z:0{len(second)}d}{s[-5]}{to.year:04d}"


def _ssn(s, key, back):
    area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
    if area not in _AREAS or not group or not serial:
        return None
    n = permute((_AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1, len(_AREAS) * 99 * 9999, key, "ssn", back)
    n, serial = divmod(n, 9999)
    area, group = divmod(n, 99)
    return f"{_AREAS[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(s, key, back):
    country = re.match(r"\+\d{1,3}(?=\D)", s)
    head = country.group() if country else s[:2 if s[1] in "17" else 3 if s[1:3] in _CODES else 4] if s[0] == "+" else ""
    digits = re.sub(r"\D", "", s[len(head):])
    if not 7 <= len(digits) + len(head) <= 16:
        return None
    return head + _fill(s[len(head):], _digits(digits, key, "phone" + head, back))


def _card(s, key, back):
    digits = re.sub(r"\D", "", s)
    if luhn(digits[:-1]) != int(digits[-1]):
        return None
    body = digits[0] + _digits(digits[1:-1], key, "card" + digits[0], back)
    return _fill(s, body + str(luhn(body)))


_REPLACE = {"email": _email, "iban": _iban, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def _ends(kind: str, text: str, start: int, end: int, whole: bool) -> list[int]:
    """The ends to try for a match, the likeliest first; ``whole``: also those without a usual layout."""
    if kind == "card":
        usual = [m.end() for m in (c.match(text, start) for c in _CARDS) if m]
        return usual + [end] * whole
    if kind == "iban":
        size = _IBAN_SIZES.get(text[start:start + 2], 0)
        m = re.compile(r"[A-Z0-9](?: ?[A-Z0-9]){%d}(?!\w)" % (size - 1)).match(text, start) if size else None
        return ([m.end()] if m else []) + [end]
    if kind == "phone":
        return [end] + [i for i in range(end - 1, start, -1) if text[start] == "+" and text[i] in " .-"]
    return [end]


def _spans(text: str, key: bytes) -> list[tuple[int, int, str]]:
    """Start, end and kind of the personal values of a text, in order."""
    out, at, tried, dead = [], 0, 0, 0
    while True:
        m, kinds = None, KINDS
        if at and at >= dead and (run := _RUN.match(text, at)):  # the rest of a run of which a value was taken
            m = _ONE["email"].match(text, at)
            dead = run.end() if m is None else dead
        if m is None:
            m = _FIND.search(text, at)
            if m is None:
                return out
            kinds = KINDS[KINDS.index(m.lastgroup):]
        start = m.start()
        for kind in kinds:
            found = _ONE[kind].match(text, start)
            good = found and next((e for e in _ends(kind, text, start, found.end(), start >= tried) if _REPLACE[kind](text[start:e], key, False) is not None), None)
            if good:
                out.append((start, good, kind))
                at = good
                break
            if found and kind == "card":
                tried = max(tried, found.end()) if start >= tried else tried
        else:
            at = _GROUP.match(text, start).end()


def _permuted(text: str, spans: list[tuple[int, int, str]], key: bytes, back: bool) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its values permuted, and their places in it."""
    out, places, at, size = [], [], 0, 0
    for start, end, kind in spans:
        new = _REPLACE[kind](text[start:end], key, back)
        out += [text[at:start], new]
        size += start - at + len(new)
        places.append((size - len(new), size, kind))
        at = end
    return "".join(out) + text[at:], places


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with its personal values permuted, and the number found of each kind.  ``back``
    restores the text that the same key gave."""
    found: dict[str, int] = {}
    if not _MAYBE.search(text):
        return text, found
    spans = _spans(text, key)
    if not spans:
        return text, found
    out, at, i = [], 0, 0
    while i < len(spans):  # line by line: no value and no check goes beyond one
        begin = text.rfind("\n", 0, spans[i][0]) + 1
        stop = text.find("\n", spans[i][0])
        stop = len(text) if stop < 0 else stop
        here = []
        while i < len(spans) and spans[i][0] < stop:
            here.append((spans[i][0] - begin, spans[i][1] - begin, spans[i][2]))
            found[spans[i][2]] = found.get(spans[i][2], 0) + 1
            i += 1
        line, places = _permuted(text[begin:stop], here, key, back)
        while _spans(line, key) != places:
            line, places = _permuted(line, places, key, back)
        out += [text[at:begin], line]
        at = stop
    return "".join(out) + text[at:], found


def _columns(key: bytes):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts, counts = [], {k: [] for k in KINDS}
                for t in part.column("text").to_pylist():
                    text, found = (None, {}) if t is None else pseudonymise(t, key)
                    texts.append(text)
                    for k in KINDS:
                        counts[k].append(found.get(k, 0))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), *(pa.array(counts[k], pa.int64()) for k in KINDS)],
                                                 names=["doc_id", "text", *(f"n_{k}" for k in KINDS)])
    return run


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id``, the whole ``text`` with pseudonyms, and ``n_<kind>`` of each kind; a map over the rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_columns(key), "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))
