"""PII: validated numbers and dates, permuted within their format by a keyed Feistel network.

A value is found by its shape, checked (Luhn digit, IBAN remainder, calendar, octet and area
ranges), reduced to a number below the size of its domain, permuted there, and printed back in the
shape it had. The permutation depends on kind and key only: equal values get equal pseudonyms in all
documents, whatever their punctuation, different values different ones, and the holder of the key
can undo them. Pseudonyms are valid again: card and IBAN digits check, dates exist.

Cards and IBANs are also looked for in parts of what has their shape, from the start of any digit group
to the end of any: an expiry date, a security code or a word beside a value does not hide it. Of
several parts that check, usual layouts (one group, 4-4-4-4, 4-6-5, 4-6-4; the country's length) go
first, then the earlier and the longer one. Where nothing checks, the other kinds are tried at the place
and the search goes on just behind its start; yet what is laid out like a card or IBAN throughout and
fails its check is not read as a telephone number, nor four numbers that are no address. A new value
can check together with its neighbours by chance, so texts are undone by their spans (`restored`).

Kinds: payment cards of 13 to 19 digits, telephone numbers, social security numbers, IBANs, IPv4
addresses, dates from 1900 to 2099 (year first, day first or month first, as far as the order can
be told: day first for ``.`` and month first for ``/``, or the other way if only that exists), e-mail names (letters and digits in their places,
capitals kept) and hexadecimal secrets of 32 digits and more (same case and length; mixed case stays mixed).

Defined cases: a missing text stays missing and has no values; an empty one likewise; every row is
treated by itself, so repeated rows and ids and further columns pass. Nothing is shuffled.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

KEY = "pseudonyms-1"
ROUNDS = 8
#: First and last day of the calendar that dates are permuted in.
DAYS = (dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal())


def _round(key: str, kind: str, number: int, value: int, size: int) -> int:
    digest = hashlib.blake2b(f"{kind}:{number}:{size}:{value}".encode(), key=key.encode()[:64], digest_size=32)
    return int.from_bytes(digest.digest(), "big")


def feistel(value: int, size: int, key: str, kind: str, back: bool = False) -> int:
    """A keyed permutation of range(size).

    The network works on a pair below the next square and is walked until the value is in range,
    which it reaches as a permutation returns to where it started.
    """
    if size < 2:
        return value
    side = math.isqrt(size - 1) + 1  # the least whose square holds the range
    while True:
        left, right = divmod(value, side)
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - _round(key, kind, number, left, size)) % side, left
            else:
                left, right = right, (left + _round(key, kind, number, right, size)) % side
        value = left * side + right
        if value < size:
            return value


def luhn_sum(digits: str) -> int:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total


def _refilled(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in turn."""
    rest = iter(digits)
    return re.sub("[0-9]", lambda _: next(rest), shape)


def _permute_digits(digits: str, key: str, kind: str, back: bool) -> str:
    return f"{feistel(int(digits), 10 ** len(digits), key, f'{kind}{len(digits)}', back):0{len(digits)}d}"


def card(found: str, key: str, back: bool) -> str | None:
    digits = re.sub("[^0-9]", "", found)
    if not 13 <= len(digits) <= 19 or luhn_sum(digits) % 10:
        return None
    body = _permute_digits(digits[:-1], key, "card", back)
    return _refilled(found, body + str(-luhn_sum(body + "0") % 10))


def phone(found: str, key: str, back: bool) -> str | None:
    """The subscriber's digits are permuted; country code, if marked by +, and shape stay."""
    country = re.match(r"\+[0-9]{1,3}(?=[ .(-])", found)
    head, rest = (country[0], found[country.end() :]) if country else ("", found)
    digits = re.sub("[^0-9]", "", rest)
    if not 7 <= len(digits) <= 12:
        return None
    return head + _refilled(rest, _permute_digits(digits, key, "phone", back))


def social(found: str, key: str, back: bool) -> str | None:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = map(int, found.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value = feistel(value, 898 * 99 * 9999, key, "social", back)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def iban(found: str, key: str, back: bool) -> str | None:
    """The account's digits are permuted, its letters stay, the check digits are made anew."""
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
        return None
    digits = re.sub("[^0-9]", "", plain[4:])
    body = _refilled(plain[4:], _permute_digits(digits, key, f"iban{plain[:2]}", back))
    check = 98 - _iban_rest(f"{plain[:2]}00{body}")
    fresh = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(fresh) for c in found)


def address(found: str, key: str, back: bool) -> str | None:
    parts = found.split(".")
    octets = [int(p) for p in parts]
    if max(octets) > 255 or any(str(o) != p for o, p in zip(octets, parts, strict=True)):
        return None
    value = feistel(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ipv4", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def date(found: str, key: str, back: bool) -> str | None:
    numbers, mark = re.split("[-./]", found), re.search("[-./]", found)[0]
    orders = ["ymd"] if len(numbers[0]) == 4 else ["mdy", "dmy"] if mark == "/" else ["dmy", "mdy"]
    for order in orders:
        part = dict(zip(order, map(int, numbers), strict=True))
        try:
            day = dt.date(part["y"], part["m"], part["d"]).toordinal()
        except ValueError:
            continue
        if not DAYS[0] <= day <= DAYS[1]:
            return None
        while True:  # until the pseudonym, too, is read in this order
            day = DAYS[0] + feistel(day - DAYS[0], DAYS[1] - DAYS[0] + 1, key, "date", back)
            fresh = dt.date.fromordinal(day)
            if order == orders[0] or fresh.day > 12:
                break
        # the shape keeps the order of its parts; days and months are printed with two digits
        values = {"y": f"{fresh.year:04d}", "m": f"{fresh.month:02d}", "d": f"{fresh.day:02d}"}
        return mark.join(values[c] for c in order)
    return None


_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def email(found: str, key: str, back: bool) -> str | None:
    """Letters become letters and digits digits; capitals stay where they are."""
    name, _, host = found.partition("@")
    plain = re.sub("[^a-z0-9]", "", name.lower())
    if not plain:
        return None
    alphabets = [_DIGITS if c in _DIGITS else _LETTERS for c in plain]
    shape = "".join("9" if a is _DIGITS else "a" for a in alphabets)
    fresh = iter(_spelled(feistel(_number(plain, alphabets), math.prod(map(len, alphabets)), key, f"email{shape}", back), alphabets))

    def put(old: re.Match) -> str:
        return next(fresh).upper() if old[0].isupper() else next(fresh)

    return re.sub("[A-Za-z0-9]", put, name) + "@" + host


def _number(text: str, alphabets: list[str]) -> int:
    """The number of a text among all of its alphabets, the last place counting ones."""
    value = 0
    for c, alphabet in zip(text, alphabets, strict=True):
        value = value * len(alphabet) + alphabet.index(c)
    return value


def _spelled(value: int, alphabets: list[str]) -> str:
    out = []
    for alphabet in reversed(alphabets):
        value, k = divmod(value, len(alphabet))
        out.append(alphabet[k])
    return "".join(reversed(out))


#: Digits of a secret that are permuted as one number; longer ones go block by block.
BLOCK = 64
_HEX, _MIXED = "0123456789abcdef", "0123456789abcdefABCDEF"


def secret(found: str, key: str, back: bool) -> str | None:
    """Of one case: the same value in both. Of mixed case: a value of mixed case again."""
    if found == found.lower() or found == found.upper():
        fresh = _permuted(found.lower(), _HEX, key, "hex", back)
        return fresh.upper() if found != found.lower() else fresh
    while True:
        found = _permuted(found, _MIXED, key, "mixed", back)
        if found != found.lower() and found != found.upper():
            return found


def _permuted(text: str, alphabet: str, key: str, kind: str, back: bool) -> str:
    out = []
    for place in range(0, len(text), BLOCK):
        part = text[place : place + BLOCK]
        named = f"{kind}{len(text)}" if len(text) <= BLOCK else f"{kind}{len(text)}.{place}"
        alphabets = [alphabet] * len(part)
        out.append(_spelled(feistel(_number(part, alphabets), len(alphabet) ** len(part), key, named, back), alphabets))
    return "".join(out)


#: Shapes in the order in which they are tried at a place; names are the kinds.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"[0-9A-Fa-f]{32,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?",
    "date": r"[12][0-9]{3}-[01][0-9]-[0-3][0-9]|[0-3]?[0-9]/[0-3]?[0-9]/[12][0-9]{3}|[0-3]?[0-9]\.[01]?[0-9]\.[12][0-9]{3}",
    "address": r"(?<!\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])",
    "social": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}|\+[0-9]{8,14}",
}
_APART = r"(?<![A-Za-z0-9])(?:{})(?![A-Za-z0-9])"
_EMAIL, *_OTHERS = (f"(?P<{kind}>{shape})" for kind, shape in PATTERNS.items())
SHAPES = re.compile(_EMAIL + "|" + _APART.format("|".join(_OTHERS)))
SINGLE = {kind: re.compile(_APART.format(shape)) for kind, shape in PATTERNS.items() if kind != "email"}
_RUN = re.compile(r"[0-9]+(?:[ -][0-9]+)*(?![A-Za-z0-9])")
CARD_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4)}
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    length: frozenset(countries.split())
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
        32: "LC", 33: "RU",
    }.items()
}
KINDS: dict[str, Callable[[str, str, bool], str | None]] = {
    "email": email, "secret": secret, "iban": iban, "date": date, "address": address,
    "social": social, "card": card, "phone": phone,
}


@lru_cache(maxsize=100_000)
def pseudonym(kind: str, found: str, key: str, back: bool = False) -> str | None:
    """The stand-in of one value, or None where the value does not check."""
    return KINDS[kind](found, key, back)


def _cards(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Parts of the digit groups ``start`` to ``end`` that check, none over another, in order."""
    groups = [m.span() for m in re.compile("[0-9]+").finditer(text, start, end)]
    found = []
    for first in range(len(groups)):
        digits, sizes = "", []
        for a, b in groups[first:]:
            digits += text[a:b]
            sizes.append(b - a)
            if len(digits) > 19:
                break
            if len(digits) >= 13 and luhn_sum(digits) % 10 == 0:
                usual = len(sizes) == 1 or tuple(sizes) in CARD_LAYOUTS
                found.append((not usual, groups[first][0], -b))
    taken: list[tuple[int, int]] = []
    for _, a, b in sorted(found):
        place = bisect.bisect(taken, (a, -b))
        if (not place or taken[place - 1][1] <= a) and (place == len(taken) or -b <= taken[place][0]):
            taken.insert(place, (a, -b))
    return taken


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where the IBAN from ``start`` ends: at ``end`` or at a space before it."""
    ends = []
    for stop in [end, *(m.start() for m in re.compile(" ").finditer(text, start, end))]:
        plain = text[start:stop].replace(" ", "")
        if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
            ends.append((plain[:2] not in IBAN_LENGTHS.get(len(plain), ()), -stop))
    return -min(ends)[1] if ends else None


def _values(text: str, key: str, back: bool) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, stand-in) of the values of a text, in order."""
    cards: list[tuple[int, int]] = []  # of the digit groups up to ``run``, last first
    at = run = no_phone = 0
    while True:
        match = SHAPES.search(text, at, cards[-1][0]) if cards else SHAPES.search(text, at)
        if match is None:
            if not cards:
                return
            a, at = cards.pop()
            yield "card", a, at, pseudonym("card", text[a:at], key, back)
            continue
        start, kind = match.span()[0], match.lastgroup
        for other in list(PATTERNS)[list(PATTERNS).index(kind) :]:
            if other != kind:
                limit = cards[-1][0] if cards else len(text)
                match = SINGLE[other].match(text, start, limit)
                if match is None:
                    continue
            end, fresh = match.end(), None
            if other == "card":
                if start < run:
                    continue
                whole = _RUN.match(text, start)
                run = whole.end()
                cards = _cards(text, start, run)[::-1]
                if cards:
                    break
                sizes = [len(g) for g in re.split("[ -]", whole[0])]
                if set(sizes[:-1]) == {4} and sizes[-1] <= 4:
                    no_phone = max(no_phone, run)
                continue
            if other == "iban":
                stop = _iban_end(text, start, end)
                if stop is None:
                    no_phone = max(no_phone, end)
                    continue
                end = stop
            if other == "phone" and start < no_phone:
                continue
            fresh = pseudonym(other, text[start:end], key, back)
            if fresh is not None:
                yield other, start, end, fresh
                at = end
                break
            if other == "address":
                at = end
                break
        else:
            at = start + 1


def _replaced(text: str, values: Iterable[tuple[str, int, int, str]]) -> tuple[str, list[tuple[str, int, int]]]:
    out, spans, at, size = [], [], 0, 0
    for kind, start, end, fresh in values:
        out += [text[at:start], fresh]
        size += start - at
        spans.append((kind, size, size + len(fresh)))
        size += len(fresh)
        at = end
    return "".join([*out, text[at:]]), spans


def pseudonymised(text: str, key: str = KEY, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its values replaced, and (kind, start, end) of each in the new text."""
    return _replaced(text, _values(text, key, back))


def restored(text: str, spans: Iterable[tuple[str, int, int]], key: str = KEY) -> str:
    """The text that `pseudonymised` made ``text`` and ``spans`` from."""
    return _replaced(text, ((k, a, b, pseudonym(k, text[a:b], key, True)) for k, a, b in spans))[0]


def with_pseudonyms(docs: DataFrame, text_col: str = "text", key: str = KEY, back: bool = False) -> DataFrame:
    """``docs`` with the text replaced and ``spans`` of (kind, start, end) added."""

    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, spans = [], []
            for text in batch:
                new, found = (None, []) if text is None else pseudonymised(text, key, back)
                texts.append(new)
                spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
            yield pd.DataFrame({"text": pd.Series(texts, dtype=object), "spans": pd.Series(spans, dtype=object)})

    udf = F.pandas_udf(replace, "text string, spans array<struct<kind: string, start: int, stop: int>>")
    columns = [F.col("_p.text").alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c != "spans"]
    return docs.withColumn("_p", udf(F.col(text_col))).select(*columns, F.col("_p.spans").alias("spans"))


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("spans").cast("long").alias("n_values"),
        F.array_join(F.array_sort(F.array_distinct("spans.kind")), ",").alias("kinds"),
        "text",
    )


QUERIES = {"op7_pii_pseudonyms": op7_pii_pseudonyms}
ORACLES: dict[str, str] = {}
