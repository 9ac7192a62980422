"""Format-preserving pseudonyms for personal data by keyed Feistel permutations."""

from __future__ import annotations

import datetime
import hmac
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tasks import add_columns

ROUNDS = 8
# Forms of the data that is replaced, tried in this order at each place.
EMAIL = r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ADDRESS = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
DATE = (r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})"
        r"(?![\d]|[/.-]\d)")
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[\x20.-]?)?\(\d{2,4}\)[\x20.-]?\d{3,4}[\x20.-]?\d{3,4}(?!\d)"
         r"|(?<![\w+])\+\d{1,3}(?:[\x20.-]?\d{2,4}){2,4}(?!\d)"
         r"|(?<![\w.+-])(?:1[\x20.-])?[2-9]\d\d(?:-[2-9]\d\d-|\.[2-9]\d\d\.|\x20[2-9]\d\d\x20)\d{4}(?![\w-]|\.\d)")
NATIONAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-]|\.\d)"
FORMS = {kind: re.compile(form, re.ASCII) for kind, form in {
    "email": EMAIL, "iban": IBAN, "date": DATE, "address": ADDRESS, "phone": PHONE,
    "national": NATIONAL, "card": CARD}.items()}
FOUND = re.compile("|".join(f.pattern for f in FORMS.values()), re.ASCII)
SIGN = re.compile(r"[0-9@]")
FOUND_TYPE = "array<struct<kind:string,start:int,end:int>>"
#: So far a form may reach beyond the word that it begins in.
REACH = 64
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to the end of 2099


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of 0 .. size - 1: a balanced Feistel network, walked until it is in range."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            message = f"{tweak}:{size}:{i}:".encode() + right.to_bytes(width, "big")
            digest = hmac.digest(key, message, "sha256")
            if width > len(digest):
                digest = b"".join(hmac.digest(key, message + bytes([j]), "sha256")
                                  for j in range(-(-width // len(digest))))
            left, right = right, left ^ (int.from_bytes(digest[:width], "big") & mask)
        value = left << half | right
        if value < size:
            return value


def _permute_signs(text: str, key: bytes, tweak: str) -> str:
    """Digits stay digits, letters stay letters of their case; other signs stay."""
    value, size = 0, 1
    for c in text:
        base = 10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 1
        d = ord(c) - (48 if base == 10 else 97 if c.islower() else 65) if base > 1 else 0
        value, size = value * base + d, size * base
    value = permute(value, size, key, tweak)
    out = []
    for c in reversed(text):
        base = 10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 1
        if base == 1:
            out.append(c)
            continue
        value, d = divmod(value, base)
        out.append(chr(d + (48 if base == 10 else 97 if c.islower() else 65)))
    return "".join(reversed(out))


def _refill(form: str, digits: str) -> str:
    """`form` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in form)


def luhn_digit(payload: str) -> str:
    """The check digit that completes a card number."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    payload = _permute_signs(digits[:-1], key, "card")
    return _refill(text, payload + luhn_digit(payload))


def _address(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    # Octets keep their number of digits, so that the text keeps its length.
    low = [(0, 10, 100)[len(p) - 1] for p in parts]
    span = [(10, 90, 156)[len(p) - 1] for p in parts]
    value, size = 0, 1
    for p, a, n in zip(parts, low, span):
        value, size = value * n + int(p) - a, size * n
    value = permute(value, size, key, "address")
    out = []
    for a, n in zip(reversed(low), reversed(span)):
        value, d = divmod(value, n)
        out.append(str(d + a))
    return ".".join(reversed(out))


def _date(text: str, key: bytes) -> str | None:
    numbers = [int(x) for x in re.split(r"\D", text)]
    year_first = "-" in text
    y, m, d = numbers if year_first else numbers[::-1]
    if "/" in text and m > 12:  # month before day
        m, d = d, m
        swapped = True
    else:
        swapped = False
    try:
        day = datetime.date(y, m, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None
    sign = re.search(r"\D", text)[0]
    widths = [len(x) for x in re.split(r"\D", text)]
    while True:  # walk to a day that is written as wide as the old one, in the same order of parts
        day = permute(day, DAYS, key, "date")
        new = datetime.date.fromordinal(day + FIRST_DAY)
        if year_first:
            return new.isoformat()
        if swapped and new.day <= 12:
            continue
        parts = [new.month, new.day] if swapped else [new.day, new.month]
        out = [str(v).zfill(w) for v, w in zip(parts, widths)]
        if [len(x) for x in out] == widths[:2] and all(
                w == 2 or v < 10 for v, w in zip(parts, widths)):
            return sign.join([*out, f"{new.year:04d}"])


def _national(text: str, key: bytes) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    valid = lambda a, g, s: a not in (0, 666) and a < 900 and g and s
    if not valid(area, group, serial):
        return None
    value = int(text.replace("-", ""))
    while True:
        value = permute(value, 10 ** 9, key, "national")
        new = f"{value:09d}"
        if valid(int(new[:3]), int(new[3:5]), int(new[5:])):
            return f"{new[:3]}-{new[3:5]}-{new[5:]}"


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    account = _permute_signs(plain[4:], key, "iban")
    check = 98 - number(account + plain[:2] + "00") % 97
    rest = iter(f"{plain[:2]}{check:02d}{account}")
    return "".join(c if c == " " else next(rest) for c in text)


def _phone(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if text[0] not in "+(" and "(" not in text:  # a plain form: area and exchange begin with 2 to 9
        head, number = digits[:-10], digits[-10:]
        while True:
            number = _permute_signs(number, key, "phone")
            if number[0] > "1" and number[3] > "1":
                return _refill(text, head + number)
    if not 7 <= len(digits) <= 15:
        return None
    country = re.match(r"\+\d{1,3}(?=[\x20.(-])", text)
    kept = len(country[0]) - 1 if country else 0
    return _refill(text, digits[:kept] + _permute_signs(digits[kept:], key, "phone"))


def _email(text: str, key: bytes) -> str:
    local, domain = text.split("@")
    return f"{_permute_signs(local, key, 'email')}@{domain}"


REPLACE = {"email": _email, "iban": _iban, "date": _date, "address": _address, "phone": _phone,
           "national": _national, "card": _card}
#: Fewest digits of a card number, fewest signs of an account number.
SHORTEST = {"card": 13, "iban": 15}


def _replaced(kind: str, text: str, key: bytes) -> tuple[str | None, int]:
    """The pseudonym of a valid value that `text` begins with, and the value's length.

    Cards and accounts may have swallowed what follows them, so they are tried up to each separator,
    longest first; cards of their issuer's usual length before all, as one digit checks by chance.
    """
    ends = [len(text)]
    if kind in SHORTEST:
        size = lambda end: sum(c.isalnum() for c in text[:end])
        ends += [i for i in range(len(text) - 1, 0, -1) if text[i] in " -" and size(i) >= SHORTEST[kind]]
        if kind == "card":
            usual = 15 if text[:2] in ("34", "37") else 16
            ends.sort(key=lambda end: size(end) != usual)
    for end in ends:
        if (new := REPLACE[kind](text[:end], key)) is not None:
            return new, end
    return None, 0


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with all valid personal data permuted, and what was replaced where.

    Every form begins in a word that holds a digit or an @, so only those words are looked at.
    """
    out, found, done, seen = [], [], 0, 0
    for sign in SIGN.finditer(text):
        first = sign.start()
        if first < seen:
            continue
        while first > seen and not text[first - 1].isspace():
            first -= 1
        last = sign.end()
        while last < len(text) and not text[last].isspace():
            last += 1
        at = first
        while at < last and (match := FOUND.search(text, at, last + REACH)) and match.start() < last:
            new = None
            for kind, form in FORMS.items():  # what does not validate may still be another form
                own = form.match(text, match.start(), last + REACH)
                if not own:
                    continue
                new, length = _replaced(kind, own[0], key)
                if new is not None:
                    out += [text[done:own.start()], new]
                    done = at = own.start() + length
                    found.append((kind, own.start(), done))
                    break
            if new is None:
                at = match.start() + 1
        seen = max(at, last)
    return "".join(out) + text[done:], found


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text",
                          found_col: str | None = "personal_data") -> DataFrame:
    """All rows and columns, with personal data in the text replaced by pseudonyms.

    E-mail names, bank accounts, dates, network addresses, phone numbers, national numbers and card
    numbers are validated (check digits, ranges, calendar) and permuted within their format under
    `key`: a value has one pseudonym in every document, and the text keeps its length. What does not
    validate stays; so do phone numbers without country sign or brackets, but for those of three, three
    and four digits. `found_col` receives structs of kind, start and end (None: not returned; a column
    of that name is replaced). A null text stays null and has none found; repeated rows get equal
    results; an empty table gives no rows; other columns pass through as they are.
    """
    secret = key.encode()

    def run(texts: list[str | None]) -> list[list]:
        done = [pseudonymise(t, secret) if t else (t, []) for t in texts]
        return [[new for new, _ in done],
                [[{"kind": k, "start": a, "end": b} for k, a, b in found] for _, found in done]]

    done = add_columns(docs, text_col, {"text": "string", "found": FOUND_TYPE}, run, docs.columns)
    n = len(docs.columns)
    done = done.toDF(*[f"c{i}" for i in range(n + 2)])  # names may clash
    kept = [F.col(f"c{n}" if c == text_col else f"c{i}").alias(c)
            for i, c in enumerate(docs.columns) if c != found_col]
    return done.select(*kept, *([F.col(f"c{n + 1}").alias(found_col)] if found_col else []))
