"""Operator 10 - format-preserving Feistel pseudonyms.

Numbers and dates that pass their validation are permuted by a keyed Feistel
network inside the set of values of their own format (cycle walking keeps the
result inside), so a pseudonym is again valid, the same value gets the same
pseudonym in every document, and whoever holds the key can restore it.

Kinds: payment cards (Luhn; the first digit stays, the check digit follows),
bank accounts (IBAN, mod 97), North American phones, social security numbers,
IPv4 addresses, calendar dates of 1900 to 2099 in several notations, local
parts of e-mail addresses, cloud access keys and hexadecimal secrets behind a
name.  Where candidates overlap the earlier kind of this list wins.  Where a
number or word behind a card or bank account spoils its check, the shorter ends
are tried at group and word boundaries, then the later beginnings; restoring may miss a value behind such a
group, where the pseudonym and the group together pass a check by chance.
Digits that validate as nothing stay as they are.

Every row is read on its own: no shuffle, nothing collected.  Defined cases:
null text stays null with no values; an empty text is empty; repeated rows give
equal results; an empty table gives no rows; all other columns are kept.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructType

from quarry.llm.common import text_batches, tidy

#: For tests and samples; set a secret key in production (KEY_SETTING).
SAMPLE_KEY = b"quarry-sample-key"
KEY_SETTING = "spark.quarry.pii.key"
ROUNDS = 8
CACHE_VALUES = 200_000
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


class Feistel:
    """A keyed permutation of range(n) for each tweak."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.sha256(key).digest(), rounds

    def _mix(self, tweak: str, turn: int, half: int, size: int) -> int:
        width = (size.bit_length() + 7) // 8 + 8
        data = self.key + f"{tweak}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.shake_256(data).digest(width), "little") % size

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        turns = range(self.rounds)
        while True:  # a * b cells hold range(n): walk on until inside
            left, right = divmod(x, b)
            for t in reversed(turns) if back else turns:
                sign = -1 if back else 1
                if t % 2:
                    right = (right + sign * self._mix(tweak, t, left, b)) % b
                else:
                    left = (left + sign * self._mix(tweak, t, right, a)) % a
            x = left * b + right
            if x < n:
                return x


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """The digits in the places of the shape's digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


Permute = Callable[[int, int, str], int]


def _card(m: re.Match, p: Permute) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if len(set(digits)) < 2 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    n, x = len(digits) - 2, int(digits[1:-1])
    while True:  # stay among the cards that a longer number around them takes alike
        x = p(x, 10**n, f"card{n}")
        new = digits[0] + str(x).zfill(n)
        new += luhn_digit(new)
        if luhn_digit(new) == luhn_digit(digits) and len(set(new)) > 1:
            return _refill(m[0], new)


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return str(98 - int(number) % 97).zfill(2)


def _iban(m: re.Match, p: Permute) -> str | None:
    value = m[0].replace(" ", "")
    country, check, rest = value[:2], value[2:4], value[4:]
    if not 15 <= len(value) <= 34 or _iban_check(country, rest) != check:
        return None
    rest = _classes(rest, p, f"iban{country}")
    it = iter(country + _iban_check(country, rest) + rest)
    return "".join(c if c == " " else next(it) for c in m[0])


def _ends(kind: str, m: re.Match) -> list[int]:
    """Where a value that begins as the match does may end, the first to try
    first: cards and IBANs end at any group, since a number or word may follow,
    and an IBAN where its country's length is reached."""
    if kind not in ("card", "iban"):
        return [m.end()]
    ends = [m.end(), *(m.start() + i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] in " -")]
    length = IBAN_LENGTHS.get(m[0][:2]) if kind == "iban" else None
    if length is None:
        return ends
    return [*(e for e in ends if len(m[0][:e - m.start()].replace(" ", "")) == length), m.end()]


def _next(kind: str, m: re.Match) -> int:
    """Where to search on if the match holds no value that begins where it
    does: one may begin at the next group of a card's or IBAN's characters."""
    if kind not in ("card", "iban"):
        return m.end()
    return next((i + 1 for i in range(m.start() + 1, m.end()) if m.string[i] == " "), m.end())


def _phone(m: re.Match, p: Permute) -> str | None:
    """Assigned codes and those that begin with 0 or 1 are permuted each among
    themselves."""
    area, exchange, line = int(m["area"] or m["area2"]), int(m["exchange"]), int(m["line"])
    at = m.start("area" if m["area"] else "area2") - m.start()
    if area >= 200 and exchange >= 200:
        head, line = divmod(p(((area - 200) * 800 + exchange - 200) * 10_000 + line, 800 * 800 * 10_000, "phone"), 10_000)
        area, exchange = head // 800 + 200, head % 800 + 200
    else:
        head = area * 1000 + exchange if area < 200 else 200_000 + (area - 200) * 200 + exchange
        head, line = divmod(p(head * 10_000 + line, 360_000 * 10_000, "phone01"), 10_000)
        area, exchange = divmod(head, 1000) if head < 200_000 else ((head - 200_000) // 200 + 200, head % 200)
    return m[0][:at] + _refill(m[0][at:], f"{area:03d}{exchange:03d}{line:04d}")


def _ssn(m: re.Match, p: Permute) -> str | None:
    area, group, serial = int(m[1]), int(m[2]), int(m[3])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = area - 1 - (area > 666)
    x = p((areas * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    rest, serial = divmod(x, 9999)
    areas, group = divmod(rest, 99)
    area = areas + 1 + (areas >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(m: re.Match, p: Permute) -> str | None:
    parts = m[0].split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    x = p(int.from_bytes(map(int, parts)), 1 << 32, "ipv4")
    return ".".join(map(str, x.to_bytes(4)))


def _day(y: int, m: int, d: int) -> int | None:
    try:
        n = datetime.date(y, m, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return n if 0 <= n < DAYS else None


def _other_day(n: int | None, p: Permute) -> datetime.date | None:
    return None if n is None else datetime.date.fromordinal(FIRST_DAY + p(n, DAYS, "date"))


def _date_ymd(m: re.Match, p: Permute) -> str | None:
    d = _other_day(_day(int(m[1]), int(m[3]), int(m[4])), p)
    return d and f"{d.year}{m[2]}{d.month:02d}{m[2]}{d.day:02d}"


def _date_xxy(m: re.Match, p: Permute) -> str | None:
    """Day and month in either order: with slashes the month is first where it can be."""
    one, two, year, mark = int(m[1]), int(m[3]), int(m[4]), m[2]
    width = 1 if min(len(m[1]), len(m[3])) == 1 else 2
    for turn, month_first in enumerate((True, False) if mark == "/" else (False, True)):
        n = _day(year, *((one, two) if month_first else (two, one)))
        d = _other_day(n, p)
        while turn and d and d.day <= 12:  # stay among the dates that only this order reads
            d = _other_day(d.toordinal() - FIRST_DAY, p)
        if d:
            a, b = (d.month, d.day) if month_first else (d.day, d.month)
            return f"{a:0{width}d}{mark}{b:0{width}d}{mark}{d.year}"
    return None


def _named(d: datetime.date, like: str) -> str:
    name = MONTHS[d.month - 1]
    name = name[:3] if len(like.rstrip(".")) == 3 and like.lower() != "may" else name
    return name.capitalize() if like[0].isupper() else name


def _date_named(m: re.Match, p: Permute) -> str | None:
    name = (m["m1"] or m["m2"])
    month = next((i for i, x in enumerate(MONTHS, 1) if x.startswith(name.lower().rstrip("."))), 0)
    d = _other_day(_day(int(m["y1"] or m["y2"]), month, int(m["d1"] or m["d2"])), p)
    if d is None:
        return None
    return f"{d.day} {_named(d, name)} {d.year}" if m["d1"] else f"{_named(d, name)} {d.day}, {d.year}"


def _classes(text: str, p: Permute, tweak: str, keep: str = "") -> str:
    """Permute letters and digits inside their classes; the rest stays."""
    radix, first = [], []
    for c in text:
        base = next((b for b in ("0", "a", "A") if b <= c <= ("9" if b == "0" else "z" if b == "a" else "Z")), None)
        first.append(base if c not in keep else None)
        radix.append(0 if first[-1] is None else 10 if base == "0" else 26)
    x, n = 0, 1
    for c, b, r in zip(text, first, radix):
        if r:
            x, n = x * r + ord(c) - ord(b), n * r
    shape = "".join({0: c, 10: "9"}.get(r, b or "") for c, b, r in zip(text, first, radix))
    x = p(x, n, f"{tweak}:{shape}")
    out = []
    for c, b, r in zip(reversed(text), reversed(first), reversed(radix)):
        if r:
            x, d = divmod(x, r)
            c = chr(ord(b) + d)
        out.append(c)
    return "".join(reversed(out))


def _email(m: re.Match, p: Permute) -> str | None:
    return _classes(m[1], p, "email") + m[2]


def _access_key(m: re.Match, p: Permute) -> str | None:
    return m[1] + _classes(m[2], p, "accesskey")


def _secret(m: re.Match, p: Permute) -> str | None:
    value = m[2]
    n = len(value)
    new = f"{p(int(value, 16), 16**n, f'hex{n}'):0{n}x}"
    return m[1] + (new.upper() if value.upper() == value and value.lower() != value else new) + m[3]


#: The registry's lengths by country.
IBAN_LENGTHS = {c: n for n, names in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for c in names.split()}
_MONTH = r"(?:Jan(?:uary|\.)?|Feb(?:ruary|\.)?|Mar(?:ch|\.)?|Apr(?:il|\.)?|May|June?\.?|July?\.?|Aug(?:ust|\.)?|Sep(?:tember|\.)?|Oct(?:ober|\.)?|Nov(?:ember|\.)?|Dec(?:ember|\.)?)"
KINDS: list[tuple[str, re.Pattern, Callable[[re.Match, Permute], str | None]]] = [
    ("email", re.compile(r"(?<![\w.+%-])([A-Za-z0-9][A-Za-z0-9._%+-]*)(@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,})(?![\w-])"), _email),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)"), _iban),
    ("access_key", re.compile(r"(?<!\w)((?:AKIA|ASIA))([A-Z0-9]{16})(?!\w)"), _access_key),
    ("secret", re.compile(r"""((?i:\b(?:password|passwd|secret|token|api_?key))\s*[:=]\s*["']?)([0-9a-f]{12,}|[0-9A-F]{12,})(["']?(?!\w))"""), _secret),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"), _card),
    ("phone", re.compile(r"(?<![\w.-])(?P<country>\+?1[ .-]?)?(?:\((?P<area>\d{3})\) ?|(?P<area2>\d{3})[ .-])(?P<exchange>\d{3})[ .-]?(?P<line>\d{4})(?![\w-]|\.\d)"), _phone),
    ("ssn", re.compile(r"(?<![\w.-])(\d{3})-(\d{2})-(\d{4})(?![\w-]|\.\d)"), _ssn),
    ("ipv4", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), _ipv4),
    ("date", re.compile(r"(?<![\w.-])(\d{4})([-/.])(\d{2})\2(\d{2})(?![\w-]|\.\d)"), _date_ymd),
    ("date", re.compile(r"(?<![\w.-])(\d{1,2})([-/.])(\d{1,2})\2(\d{4})(?![\w-]|\.\d)"), _date_xxy),
    ("date", re.compile(rf"(?<!\w)(?:(?P<d1>\d{{1,2}}) (?P<m1>{_MONTH}) (?P<y1>\d{{4}})|(?P<m2>{_MONTH}) (?P<d2>\d{{1,2}}),? (?P<y2>\d{{4}}))(?!\w)"), _date_named),
]
KIND_NAMES = tuple(dict.fromkeys(k for k, _, _ in KINDS))
#: What any value has: access keys and hexadecimal secrets may be letters alone.
_LIKELY = re.compile(r"[0-9@]|AKIA|ASIA|(?i:passw(?:or)?d|secret|token|api_?key)")


class Pseudonyms:
    """Finds and replaces values in texts."""

    def __init__(self, key: bytes, back: bool = False):
        feistel = Feistel(key)
        self.permute = lru_cache(CACHE_VALUES)(lambda x, n, tweak: feistel.permute(x, n, tweak, back))

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms and the number of values by kind."""
        if not _LIKELY.search(text):
            return text, {}
        spans: list[tuple[int, int, str, str]] = []  # sorted, apart from one another
        begins: list[int] = []
        for kind, pattern, make in KINDS:
            at = 0
            while m := pattern.search(text, at):
                start, at = m.start(), _next(kind, m)
                k = bisect_right(begins, start) - 1
                if k >= 0 and spans[k][1] > start:  # an earlier kind's value: go on behind it
                    at = spans[k][1]
                    continue
                for end in _ends(kind, m):
                    if k + 1 < len(spans) and begins[k + 1] < end:
                        continue
                    part = m if end == m.end() else pattern.match(text, start, end)
                    new = part and make(part, self.permute)
                    if new is not None:
                        spans.insert(k + 1, (start, end, new, kind))
                        begins.insert(k + 1, start)
                        at = end
                        break
        if not spans:
            return text, {}
        out, at, count = [], 0, {}
        for a, e, new, kind in spans:
            out += [text[at:a], new]
            at = e
            count[kind] = count.get(kind, 0) + 1
        return "".join([*out, text[at:]]), count


def session_key(spark: SparkSession) -> bytes:
    """The secret key that the session names in KEY_SETTING, else the sample one."""
    return spark.conf.get(KEY_SETTING, SAMPLE_KEY.decode()).encode()


def pseudonymise(docs: DataFrame, key: bytes | None = None, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text and two columns more: ``n_values``
    and ``kinds`` (map of kind to number).  ``back`` restores the values;
    without ``key`` the session's is used."""
    key = key or session_key(docs.sparkSession)
    text_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("n_values", "kinds")]
    at = names.index(text)
    schema = StructType([docs.schema[c] for c in names]).add("n_values", "long").add("kinds", MapType(StringType(), IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_of = Pseudonyms(key, back)
        for b in batches:
            texts, counts = [], []
            for t in b.column(at).to_pylist():
                new, count = (None, {}) if t is None else names_of.replace(t)
                texts.append(new)
                counts.append(count)
            columns = list(b.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([sum(c.values()) for c in counts], pa.int64()), pa.array([list(c.items()) for c in counts], pa.map_(pa.string(), pa.int32()))],
                names=[*names, "n_values", "kinds"])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(tidy(run), schema)
