"""Format-preserving pseudonyms: keyed Feistel permutations of personal data in place.

A value is found by pattern, validated, read as one number of its format's domain, permuted within that domain
and written in the same format: a card number becomes another valid card number of the same length, a date
another date in the same notation. The permutation depends on the key, the kind and the format alone, so equal
values get equal pseudonyms in all documents, and the key's holder can turn them back.
"""

from __future__ import annotations

import calendar
import datetime as dt
import hashlib
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "iban", "card", "phone", "ip", "ssn", "date")
_ROUNDS = 10
_FIRST_DAY = dt.date(1900, 1, 1).toordinal()
_DAYS = dt.date(2100, 1, 1).toordinal() - _FIRST_DAY
#: Character classes that a permuted character stays in.
_CLASSES = (string.digits, string.ascii_lowercase, string.ascii_uppercase,
            "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßœ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞŸẞŒ")
_CLASS_OF = {c: group for group in _CLASSES for c in group}

_PATTERNS = {
    "email": re.compile(r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|"
                       r"[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])"),
    "phone": re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|"
                        r"(?<![0-9(])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}(?![0-9])"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "date": re.compile(r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})"
                       r"(?![0-9])(?![-/.][0-9])"),
}
#: Lengths of the countries' IBANs, and national digits of countries whose phone numbers all have the same.
_IBAN_SIZES = {c: n for n, names in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in names.split()}
_PHONE_SIZES = {c: n for n, codes in {
    8: "45 47 65 370 371 386 852", 9: "27 31 33 34 40 41 48 56 61 351 380 420 421", 10: "1 7 30 52 90 91"}.items()
    for c in codes.split()}
#: No pattern but that of e-mail addresses is longer; those keep their extent, as every character stays in its class.
_REACH = 80
#: Characters read behind a value (kinds can block each other in a chain) and before the first place of a window.
_AHEAD, _LOOK = 400, 4


class Feistel:
    """A keyed permutation of range(n) without fixed points for n > 1.

    An unbalanced Feistel network with modular addition permutes range(a * b), a * b >= n, and values beyond n are
    permuted again until they fall inside. It is used twice, around a keyed shift, so that no value stays itself.
    """

    def __init__(self, key: bytes, tweak: str, n: int):
        self.key, self.tweak, self.n = key, tweak.encode(), n
        self.a = isqrt(max(n - 1, 0)) + 1
        self.b = -(-n // self.a)
        self.shift = 1 + self._draw(b"shift", 0) % (n - 1) if n > 1 else 0

    def _draw(self, turn: bytes, value: int) -> int:
        digest = hashlib.blake2b(b"%s|%s|%d|%d" % (self.tweak, turn, self.n, value), key=self.key, digest_size=64)
        return int.from_bytes(digest.digest(), "big")

    def _inner(self, x: int, back: bool) -> int:
        sign = -1 if back else 1
        while True:
            left, right = divmod(x, self.b)
            for turn in range(_ROUNDS)[::sign]:
                if turn % 2:
                    left = (left + sign * self._draw(b"%d" % turn, right)) % self.a
                else:
                    right = (right + sign * self._draw(b"%d" % turn, left)) % self.b
            x = left * self.b + right
            if x < self.n:
                return x

    def permute(self, x: int, back: bool = False, allowed: Callable[[int], bool] = lambda x: True) -> int:
        """The pseudonym of x, or with ``back`` its source, walking on to an allowed value."""
        while self.n > 1:
            x = self._inner((self._inner(x, False) + (-self.shift if back else self.shift)) % self.n, True)
            if allowed(x):
                break
        return x


def _luhn_digit(body: str) -> str:
    total = 0
    for place, digit in enumerate(reversed(body)):
        value = int(digit) * (2 - place % 2)
        total += value - 9 * (value > 9)
    return str(-total % 10)


def _written(template: str, symbols: str, members: str) -> str:
    """``template`` with its characters among ``members`` replaced in order by ``symbols``."""
    rest = iter(symbols)
    return "".join(next(rest) if c in members else c for c in template)


def _mixed(key: bytes, kind: str, value: str, back: bool) -> str:
    """Permute the letters and digits of a value as one mixed-radix number; other characters stay."""
    radix = [_CLASS_OF.get(c) for c in value]
    number = size = 0
    size = 1
    for c, group in zip(value, radix, strict=True):
        if group:
            number, size = number * len(group) + group.index(c), size * len(group)
    shape = "".join(str(_CLASSES.index(g)) if g else c for c, g in zip(value, radix, strict=True))
    number = Feistel(key, f"{kind}|{shape}", size).permute(number, back)
    out = []
    for c, group in zip(reversed(value), reversed(radix), strict=True):
        if group:
            number, k = divmod(number, len(group))
            c = group[k]
        out.append(c)
    return "".join(reversed(out))


def _email(key: bytes, value: str, back: bool) -> str | None:
    local, _, domain = value.rpartition("@")
    return f"{_mixed(key, 'email', local, back)}@{domain}"


def _card(key: bytes, value: str, back: bool) -> str | None:
    digits = re.sub("[ -]", "", value)
    if _luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    plain = lambda x: len(set(f"{x:0{n}d}" + _luhn_digit(f"{x:0{n}d}"))) > 1
    body = f"{Feistel(key, f'card|{n}', 10 ** n).permute(int(digits[:-1]), back, plain):0{n}d}"
    return _written(value, body + _luhn_digit(body), string.digits)


def _iban_rest(country: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in f"{account}{country}00")) % 97


def _iban(key: bytes, value: str, back: bool) -> str | None:
    compact = value.replace(" ", "")
    country, check, account = compact[:2], compact[2:4], compact[4:]
    if not 15 <= len(compact) <= 34 or int(check) != 98 - _iban_rest(country, account):
        return None
    account = _mixed(key, f"iban|{country}", account, back)
    return _written(value, f"{country}{98 - _iban_rest(country, account):02d}{account}", string.digits + string.ascii_uppercase)


def _phone(key: bytes, value: str, back: bool) -> str | None:
    head = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]|", value)[0]
    rest = value[len(head):]
    digits = re.sub("[^0-9]", "", rest)
    if not 8 <= len(re.sub("[^0-9]", "", value)) <= 15:
        return None
    valid = (lambda x: True) if head else (lambda x: all(f"{x:010d}"[k] > "1" for k in (0, 3)))
    number = Feistel(key, f"phone|{head}|{len(digits)}", 10 ** len(digits)).permute(int(digits), back, valid)
    return head + _written(rest, f"{number:0{len(digits)}d}", string.digits)


def _ip(key: bytes, value: str, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    number = Feistel(key, "ip", 1 << 32).permute(int.from_bytes(bytes(map(int, parts)), "big"), back)
    return ".".join(map(str, number.to_bytes(4, "big")))


def _ssn(key: bytes, value: str, back: bool) -> str | None:
    def valid(x: int) -> bool:
        text = f"{x:09d}"
        return text[:3] not in ("000", "666") and text[0] != "9" and text[3:5] != "00" and text[5:] != "0000"

    number = int(value.replace("-", ""))
    if not valid(number):
        return None
    return _written(value, f"{Feistel(key, 'ssn', 10 ** 9).permute(number, back, valid):09d}", string.digits)


def _read_date(value: str) -> tuple[int, str] | None:
    """(day number, notation) of a valid date from 1900 to 2099."""
    first, second, third = re.split("[-/.]", value)
    if len(first) == 4:
        options = [(first, second, third, "ymd")]
    else:
        options = [(third, second, first, "dmy"), (third, first, second, "mdy")]
    for year, month, day, notation in options:
        y, m, d = int(year), int(month), int(day)
        if 1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]:
            return dt.date(y, m, d).toordinal() - _FIRST_DAY, notation
    return None


def _write_date(day: int, notation: str, mark: str, widths: tuple[int, int]) -> str:
    date = dt.date.fromordinal(_FIRST_DAY + day)
    a, b = {"ymd": (date.month, date.day), "dmy": (date.day, date.month), "mdy": (date.month, date.day)}[notation]
    pair = f"{a:0{widths[0]}d}{mark}{b:0{widths[1]}d}"
    return f"{date.year}{mark}{pair}" if notation == "ymd" else f"{pair}{mark}{date.year}"


def _date(key: bytes, value: str, back: bool) -> str | None:
    read = _read_date(value)
    if read is None:
        return None
    day, notation = read
    mark = re.search("[-/.]", value)[0]
    parts = value.split(mark)
    widths = tuple(len(p) for p in (parts[1:] if notation == "ymd" else parts[:2]))

    def same_format(x: int) -> bool:  # read back in the same notation, and no wider than it was
        text = _write_date(x, notation, mark, widths)
        return len(text) == len(value) and _read_date(text) == (x, notation) and [len(p) for p in text.split(mark)] == \
            [len(p) for p in parts]

    number = Feistel(key, f"date|{notation}|{mark}|{widths}", _DAYS).permute(day, back, same_format)
    return _write_date(number, notation, mark, widths)


_RULES = {"email": _email, "iban": _iban, "card": _card, "phone": _phone, "ip": _ip, "ssn": _ssn, "date": _date}


@lru_cache(maxsize=50_000)
def pseudonym(key: bytes, kind: str, value: str, back: bool = False) -> str | None:
    """The pseudonym of one value (its source with ``back``); null if it isn't valid for its kind."""
    return _RULES[kind](key, value, back)


def _iban_ends(m: re.Match) -> list[int]:
    """Where an IBAN at the start of a run may end: at the length of its country, else at any blank or the end."""
    value = m[0]
    sizes = {k: len(value[:k].replace(" ", "")) for k in (*(m.start() for m in re.finditer(" ", value)), len(value))}
    ends = [k for k, size in sizes.items() if 15 <= size <= 34]
    return sorted(ends, key=lambda k: (sizes[k] != _IBAN_SIZES.get(value[:2]), k))


def _phone_ends(m: re.Match) -> list[int]:
    """Where a phone number at the start of a run may end; groups and the country code alone decide.

    With a country of one length, there. Elsewhere before a blank and a date or once a run of six digits behind the
    area code (or of ten in all) is complete; then at the longest end, which rather takes a number too many.
    """
    value = m[0]
    ends = [k for k in range(len(value), 0, -1) if value[k - 1].isdigit() and not value[k: k + 1].isdigit()
            and _PATTERNS["phone"].fullmatch(value[:k])]
    count = lambda k: len(re.sub("[^0-9]", "", value[:k].replace("(0)", "")))
    code = re.match(r"\+([17](?=[0-9])|[0-9]{1,3}(?![0-9]))", value)
    size = _PHONE_SIZES.get(code[1]) if code else None
    exact = [k for k in ends if size and count(k) == len(code[1]) + size]
    runs = lambda k: re.findall("[0-9]+", value[:k])
    whole = [k for k in reversed(ends) if value[k: k + 1] == " " and count(k) >= 8 and (
        _PATTERNS["date"].match(m.string, m.start() + k + 1) or len(runs(k)[-1]) >= 6 and (len(runs(k)) > 2 or count(k) >= 10))]
    return [*exact[:1], *whole[:1], *ends]


_ENDS = {"iban": _iban_ends, "phone": _phone_ends}


def _find(text: str, key: bytes, back: bool, behind: int = 0) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the values from ``behind`` on. Earlier kinds win where values overlap."""
    taken: list[tuple[int, int, str, str]] = []
    for kind in KINDS:
        m = None if kind == "email" and "@" not in text else _PATTERNS[kind].search(text, behind)
        while m:
            start, after = m.start(), m.start() + 1
            for size in _ENDS[kind](m) if kind in _ENDS else [len(m[0])]:
                at = bisect_left(taken, (start,))  # taken spans don't overlap: only the two neighbours can touch
                free = (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= start + size)
                new = pseudonym(key, kind, m[0][:size], back) if free else None
                if new is not None:
                    after = start + size
                    taken.insert(at, (start, after, kind, new))
                    break
            m = _PATTERNS[kind].search(text, after)
    return taken


def _reads_alike(left: str, lead: int, spans: list[tuple[int, int, str]], value: str, kind: str, right: str, key: bytes,
                 back: bool) -> bool:
    """Whether ``value`` is read as one value of its kind between its neighbours, and ``spans`` in ``left`` as before.

    ``left`` begins ``lead`` characters before a place between two values. Only matches that touch the value can change with it, and those
    begin at most ``_REACH`` characters before it; of what follows, ``right`` holds more than can matter.
    """
    end = len(left) + len(value)
    found = _find(left + value + right, key, back, lead)
    return [x[:3] for x in found if x[0] < end] == [*spans, (len(left), end, kind)]


def rewrite_values(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]], int]:
    """(new text, (start, end, kind) of the values in the old one, how many were permuted more than once).

    A new value may be read otherwise beside its neighbours: another start of a card number is valid too. Values are therefore
    replaced from right to left, each permuted on until the text is read as before, with the new values on its right and the old
    ones on its left. Turning back goes from left to right, so that each value is walked back between the same neighbours.
    Only a bounded window around a value is read again, so the time is linear in the text.
    """
    found = _find(text, key, back) if re.search("[0-9@]", text) else []
    out: list[str] = []
    again = 0

    def walk(k: int, left: str, lead: int, spans: list[tuple[int, int, str]], right: str) -> str:
        nonlocal again
        _, _, kind, value = found[k]
        for turn in count():
            if _reads_alike(left, lead, spans, value, kind, right, key, not back):
                again += turn > 0
                return value
            value = pseudonym(key, kind, value, back)

    if not back:
        at, right = len(text), ""
        for k in range(len(found) - 1, -1, -1):
            start, end, _, _ = found[k]
            right = (text[end:min(at, end + _AHEAD)] + right)[:_AHEAD]
            low, first = max(0, start - _REACH), k
            while first and found[first - 1][1] > low:
                first -= 1
                low = min(low, found[first][0])
            lead = min(low, _LOOK)
            low -= lead
            value = walk(k, text[low:start], lead, [(a - low, b - low, kind) for a, b, kind, _ in found[first:k]], right)
            out += [text[end:at], value]
            at, right = start, (value + right)[:_AHEAD]
        out = [*out, text[:at]][::-1]
    else:
        at, left = 0, ""  # the end of the new text
        near: list[tuple[int, int, str]] = []  # values in it, counted from its end
        for k, (start, end, kind, _) in enumerate(found):
            gap = text[at:start]
            left += gap
            near = [(a - len(gap), b - len(gap), x) for a, b, x in near]
            low = -min(_REACH, len(left))
            for a, b, _ in reversed(near):
                if b <= low:
                    break
                low = min(low, a)
            near = [x for x in near if x[0] >= low]
            lead = min(len(left) + low, _LOOK)
            left = left[len(left) + low - lead:]
            value = walk(k, left, lead, [(len(left) + a, len(left) + b, x) for a, b, x in near], text[end:end + _AHEAD])
            out += [gap, value]
            at, left = end, left + value
            near = [*((a - len(value), b - len(value), x) for a, b, x in near), (-len(value), 0, kind)]
        out.append(text[at:])
    return "".join(out), [x[:3] for x in found], again


def rewrite(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int], list[tuple[int, int, str]]]:
    """(new text, number of values by kind, spans in the old text)."""
    new, spans, _ = rewrite_values(text, key, back)
    return new, dict(Counter(kind for _, _, kind in spans)), spans


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """(doc_id, text, n_values, kinds, n_again): the whole texts with personal data permuted (turned back with ``back``).

    ``docs`` has doc_id and text; other columns are ignored. ``kinds`` counts the values by kind, ``n_again`` those that were
    permuted more than once because their neighbours left several readings; all others have the pseudonym that equal values have
    everywhere. A null text stays null, an empty one empty, both with 0 values; repeated rows are handled one by one; a text of
    any length takes time in proportion to it; an empty table gives no rows. The key must come from the caller's secret store. Nothing is shuffled.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kinds, again = [], [], []
            for text in batch.column(1):
                new, spans, repeated = rewrite_values(text.as_py() or "", key, back)
                texts.append(new if text.is_valid else None)
                kinds.append(list(Counter(kind for _, _, kind in spans).items()))
                again.append(repeated)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([sum(n for _, n in x) for x in kinds], pa.int64()),
                 pa.array(kinds, pa.map_(pa.string(), pa.int64())), pa.array(again, pa.int64())],
                names=["doc_id", "text", "n_values", "kinds", "n_again"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, text string, n_values long, kinds map<string,long>, n_again long")
