"""Format-preserving pseudonyms: numbers and dates permuted within their own format.

Every format is a numbering of its valid values: card numbers with a right check digit,
phone numbers, IPv4 addresses, social security numbers, account numbers with a right
checksum, calendar dates, mail addresses and keys. A value's number goes through a
keyed Feistel network, walked again until it falls into the format's range, which makes
a permutation of that range: equal values get equal pseudonyms in every document, and
different values different ones. Layout (separators, letter case, length of numbers)
stays as it is. Values that fail validation are left alone. A match that fails is tried at
the ends of its shorter groups and with the later formats, and the search goes on behind
what was accepted, or behind the first group.

Defined results: a null text stays null with no finding; an empty text stays empty;
repeated rows get the same result; other columns are not read (``pseudonymise``) or
passed through as they are (``pseudonymised``).
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vidpulse.llm.common import slices

ROUNDS = 8
#: Setting that holds the secret.
KEY_SETTING = "spark.vidpulse.pii.key"
#: For trials on made-up data only: it is public, so anyone can undo what it made.
TRIAL_KEY = "vidpulse-pseudonyms"


def feistel(value: int, bits: int, secret: bytes, tweak: bytes, undo: bool = False) -> int:
    """A keyed permutation of ``0 .. 2**bits - 1``; ``bits`` is even."""
    half = bits // 2
    mask, size = (1 << half) - 1, (half + 7) // 8
    left, right = value >> half, value & mask
    if undo:
        left, right = right, left
    for k in reversed(range(ROUNDS)) if undo else range(ROUNDS):
        block = tweak + bytes([k]) + right.to_bytes(size, "big")
        mixed = b"".join(
            hashlib.blake2b(block, key=secret, digest_size=64, salt=c.to_bytes(4, "big")).digest()
            for c in range(-(-size // 64))
        )
        left, right = right, left ^ (int.from_bytes(mixed[:size], "big") & mask)
    return (right << half) | left if undo else (left << half) | right


def permute(value: int, size: int, secret: bytes, tweak: bytes, undo: bool = False) -> int:
    """A keyed permutation of ``0 .. size - 1``, by walking the cycle back into the range."""
    bits = max(2, (size - 1).bit_length())
    bits += bits % 2
    while True:
        value = feistel(value, bits, secret, tweak, undo)
        if value < size:
            return value


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` a valid card number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 else (2 * d - 9 if d > 4 else 2 * d)
    return -total % 10


def refill(layout: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``layout``."""
    fresh = iter(digits)
    return "".join(next(fresh) if "0" <= c <= "9" else c for c in layout)


def only_digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


Permute = Callable[[int, int, str], int]


def ends(found: str, gaps: str, least: int, most: int) -> list[tuple[int, int]]:
    """``(end, characters without gaps)`` of the whole groups from the start on, longest first."""
    out, n = [], 0
    for k, c in enumerate(found, 1):
        n += c not in gaps
        if least <= n <= most and c not in gaps and (k == len(found) or found[k] in gaps):
            out.append((k, n))
    return out[::-1]


def card_ends(found: str) -> list[int]:
    return [k for k, _ in ends(found, " -", 13, 19)]


def card(found: str, move: Permute) -> str | None:
    """13 to 19 digits with a right check digit; the first digit, which names the issuer's kind, stays."""
    d = only_digits(found)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    body = d[1:-1]
    body = d[0] + str(move(int(body), 10 ** len(body), f"card{len(d)}{d[0]}")).zfill(len(body))
    return refill(found, body + str(luhn_digit(body)))


def phone(found: str, move: Permute) -> str | None:
    """The last ten digits; a country's code before them stays. Without one, the grouping is that of code 1."""
    d = only_digits(found)
    if not 10 <= len(d) <= 13:
        return None
    head, body = d[:-10], d[-10:]
    return refill(found, head + str(move(int(body), 10**10, f"phone{head or 1}")).zfill(10))


#: Digits after a country's code, 0 where there is no one length; of others the longest run counts.
NATIONAL = {"1": 10, "49": 0, "33": 9, "34": 9, "41": 9, "44": 10, "52": 10, "57": 10, "351": 9}
PHONE_GAPS = " .()/-"


def country(digits: str) -> str:
    return next((digits[:n] for n in (1, 2, 3) if digits[:n] in NATIONAL), "")


def foreign_ends(found: str) -> list[int]:
    """The length of the country first."""
    code = country(only_digits(found))
    own = len(code) + NATIONAL.get(code, 99) + ("(0)" in found)
    return [k for k, n in sorted(ends(found, PHONE_GAPS + "+", 8, 15), key=lambda x: x[1] != own)]


def foreign(found: str, move: Permute) -> str | None:
    """A number after a plus: all but a known country's code, else the last ten digits, or all but two of 8 and 9."""
    d = only_digits(found)
    if not 8 <= len(d) <= 15:
        return None
    cut = len(country(d)) or (len(d) - 10 if len(d) >= 10 else 2)
    head, body = d[:cut], d[cut:]
    return refill(found, head + str(move(int(body), 10 ** len(body), f"phone{head}")).zfill(len(body)))


def ssn(found: str, move: Permute) -> str | None:
    area, group, serial = (int(x) for x in found.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number = move(number, 898 * 99 * 9999, "ssn")
    rest, serial = divmod(number, 9999)
    area, group = divmod(rest, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


#: First value and number of values of an address part with one, two and three digits.
OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def ipv4(found: str, move: Permute) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    widths = [len(p) for p in parts]
    number, size = 0, 1
    for p, w in zip(parts, widths):
        first, count = OCTETS[w]
        number, size = number * count + int(p) - first, size * count
    number = move(number, size, "ip" + "".join(map(str, widths)))
    out = []
    for w in reversed(widths):
        first, count = OCTETS[w]
        number, part = divmod(number, count)
        out.append(str(part + first))
    return ".".join(reversed(out))


#: Alphabets of which a character is replaced by another of the same one.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
)
PLACE = {c: (a, k) for a in ALPHABETS for k, c in enumerate(a)}


def letters(found: str, move: Permute, kind: str) -> str:
    """Each digit and letter by one of its alphabet; all others stay."""
    number, size, layout = 0, 1, []
    for c in found:
        alphabet, k = PLACE.get(c, (c, 0))
        number, size = number * len(alphabet) + k, size * len(alphabet)
        layout.append(alphabet)
    if size == 1:
        return found
    shape = "".join(a[0] for a in layout)
    number = move(number, size, kind + shape)
    out = []
    for alphabet in reversed(layout):
        number, k = divmod(number, len(alphabet))
        out.append(alphabet[k])
    return "".join(reversed(out))


def lowered(found: str) -> str:
    """In lower case where the alphabets have both cases."""
    return "".join(c.lower() if c.lower() in PLACE else c for c in found)


def cased(fresh: str, layout: str) -> str:
    """``fresh`` with capitals where ``layout`` has them; letters without a capital stay."""
    pairs = zip(fresh, layout)
    return "".join(f.upper() if c != c.lower() and f.upper() in PLACE else f for f, c in pairs)


def email(found: str, move: Permute) -> str | None:
    """The name and the host without its last label, as one value in every case."""
    name, host = found.rsplit("@", 1)
    host, last = host.rsplit(".", 1)
    fresh = (cased(letters(lowered(x), move, kind), x) for x, kind in ((name, "mail"), (host, "host")))
    return "@".join(fresh) + f".{last}"


def iban(found: str, move: Permute) -> str | None:
    d = found.replace(" ", "")
    value = lambda x: int("".join(str(int(c, 36)) for c in x))
    if not 15 <= len(d) <= 34 or value(d[4:] + d[:4]) % 97 != 1:
        return None
    body = letters(d[4:], move, "iban" + d[:2])
    whole = f"{d[:2]}{98 - value(body + d[:2] + '00') % 97:02d}{body}"
    fresh = iter(whole)
    return "".join(c if c == " " else next(fresh) for c in found)


#: Length of an account number by country; of others every length is tried.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def iban_ends(found: str) -> list[int]:
    """The length of the country first."""
    own = IBAN_LENGTHS.get(found[:2])
    return [k for k, n in sorted(ends(found, " ", 15, 34), key=lambda x: x[1] != own)]


def small_iban_ends(found: str) -> list[int]:
    """In lower case only the length of a known country counts, since words may follow."""
    own = IBAN_LENGTHS.get(found[:2].upper())
    return [k for k, n in ends(found, " ", 15, 34) if n == own]


def small_iban(found: str, move: Permute) -> str | None:
    """As ``iban``, so both cases of a number are linked."""
    fresh = iban(found.upper(), move)
    return fresh and fresh.lower()


FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


def moved_day(y: int, m: int, d: int, move: Permute) -> datetime.date | None:
    try:
        day = datetime.date(y, m, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return datetime.date.fromordinal(FIRST_DAY + move(day, DAYS, "date")) if 0 <= day < DAYS else None


@lru_cache(maxsize=64)
def days_of(days: tuple[int, int], months: tuple[int, int]) -> list[int]:
    """The numbers of the dates whose day and month lie in these ranges."""
    dates = ((n, datetime.date.fromordinal(FIRST_DAY + n)) for n in range(DAYS))
    return [n for n, x in dates if days[0] <= x.day <= days[1] and months[0] <= x.month <= months[1]]


def moved_short(y: int, m: int, d: int, move: Permute, days: tuple[int, int] | None = None) -> datetime.date | None:
    """A date with a one-digit part, moved within those that take as many digits."""
    try:
        day = datetime.date(y, m, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None
    days, months = days or ((1, 9) if d < 10 else (10, 31)), (1, 9) if m < 10 else (10, 12)
    held = days_of(days, months)
    fresh = held[move(bisect_left(held, day), len(held), f"date{days}{months}")]
    return datetime.date.fromordinal(FIRST_DAY + fresh)


def iso_date(found: str, move: Permute) -> str | None:
    """Year first; with one-digit parts and dots it is rather a version."""
    mark = found[4]
    y, m, d = found.split(mark)
    short = len(found) < 10
    if short and mark == ".":
        return None
    day = (moved_short if short else moved_day)(int(y), int(m), int(d), move)
    return day and f"{day.year:04d}{mark}{day.month:0{len(m)}d}{mark}{day.day:0{len(d)}d}"


def local_date(found: str, move: Permute) -> str | None:
    """Day and month first; where only month and day make a date, these."""
    mark = found[-5]
    one, two, y = found.split(mark)
    a, b = int(one), int(two)
    if len(found) < 10:
        if day := moved_short(int(y), b, a, move):
            return f"{day.day:0{len(one)}d}{mark}{day.month:0{len(two)}d}{mark}{day.year:04d}"
        if b > 12 and (day := moved_short(int(y), a, b, move, (13, 31))):
            return f"{day.month:0{len(one)}d}{mark}{day.day:0{len(two)}d}{mark}{day.year:04d}"
        return None
    if day := moved_day(int(y), b, a, move):
        # A moved day over 12 keeps the reading of day first; others are read so anyway.
        return f"{day.day:02d}{mark}{day.month:02d}{mark}{day.year:04d}"
    if day := moved_day(int(y), a, b, move):
        return f"{day.month:02d}{mark}{day.day:02d}{mark}{day.year:04d}"
    return None


def hex_key(found: str, move: Permute) -> str | None:
    """A hexadecimal key as a number of the same length and case."""
    fresh = f"{move(int(found, 16), 16 ** len(found), f'hex{len(found)}'):0{len(found)}x}"
    return fresh.upper() if found.isupper() else fresh


def key(found: str, move: Permute) -> str | None:
    """Access keys and passwords, each character within its alphabet."""
    return letters(found, move, "key")


#: The name before a secret, up to its first character.
NAMED = re.compile(r"""\w+["']?\s?[:=]\s?["']?""")


def named_key(found: str, move: Permute) -> str | None:
    """The secret behind its name and a colon or an equals sign; what is no letter or digit stays."""
    start = NAMED.match(found).end()
    return found[:start] + letters(found[start:], move, "key")


def web_token(found: str, move: Permute) -> str | None:
    """Three parts between dots; the first two go on beginning as encoded objects do."""
    head, body, mark = found.split(".")
    return ".".join([*(x[:3] + letters(x[3:], move, "token") for x in (head, body)), letters(mark, move, "token")])


#: In this order: what an earlier one has taken, a later one does not see.
FORMATS: tuple[tuple[str, str, Callable[[str, Permute], str | None]], ...] = (
    ("email", r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,24}\b", email),
    ("key", r"\b(?:(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,128}|(?=[0-9A-F]*[A-F])(?=[0-9A-F]*[0-9])[0-9A-F]{32,128})\b", hex_key),
    ("key", r"(?<=\bAKIA)[0-9A-Z]{16}\b|(?<=\bghp_)[0-9A-Za-z]{36}\b|(?<=\bsk-)[0-9A-Za-z]{20,64}\b", key),
    ("key", r"(?:(?<=key=)|(?<=token=)|(?<=secret=)|(?<=password=)|(?<=passwd=)|(?<=pwd=))[0-9A-Za-z]{8,64}\b", key),
    ("key", r"""(?<![A-Za-z0-9])(?:[Aa]pi|API)?(?:[Pp]assw(?:or)?d|PASSW(?:OR)?D|[Pp]wd|PWD|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Kk]ey|KEY)["']?\s?[:=]\s?["']?(?=[^\s"'&,;<>]{0,63}[0-9])[^\s"'&,;<>]{7,63}[0-9A-Za-z]""", named_key),
    ("key", r"\beyJ[\w-]{8,4000}\.eyJ[\w-]{8,4000}\.[\w-]{8,4000}", web_token),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b", iban),
    ("iban", r"\b[a-z]{2}[0-9]{2}(?: ?[a-z0-9]){11,30}\b", small_iban),
    ("date", r"(?<![\w./-])[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?!(?!T[0-9])[\w/-]|\.[0-9])", iso_date),
    ("date", r"(?<![\w./-])[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4}(?!(?!T[0-9])[\w/-]|\.[0-9])", local_date),
    ("ip", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z_]|\.[0-9])", ipv4),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", ssn),
    ("card", r"(?<![\w.])(?<![^\W\d]-)[0-9](?:[ -]?[0-9]){12,18}(?!\w|-[^\W\d])", card),
    ("phone", r"(?<![\w.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])", phone),
    ("phone", r"(?<![\w.-])\+[0-9](?:[ .()/-]{0,3}[0-9]){7,14}(?!\w)", foreign),
)
PATTERN = re.compile("|".join(f"(?P<f{k}>{p.replace(chr(92) + '1', f'(?P=m{k})').replace('([-/.])', f'(?P<m{k}>[-/.])')})" for k, (_, p, _) in enumerate(FORMATS) if k))
EACH = [re.compile(p) for _, p, _ in FORMATS]
#: Formats whose match may run on into what follows: the ends to try, in this order.
ENDS = {card: card_ends, iban: iban_ends, small_iban: small_iban_ends, foreign: foreign_ends}
FIRST_GROUP = re.compile(r"\w+|\W")
EMAIL = re.compile(FORMATS[0][1])
HINT = re.compile(r"[0-9=]")
KINDS = tuple(dict.fromkeys(name for name, _, _ in FORMATS))


class Pseudonyms:
    def __init__(self, secret: str):
        self.secret = hmac.new(secret.encode(), b"pseudonyms", "sha256").digest()
        self.replace = lru_cache(maxsize=65536)(self._replace)

    def _move(self, value: int, size: int, tweak: str) -> int:
        return permute(value, size, self.secret, tweak.encode())

    def _replace(self, k: int, found: str) -> str | None:
        return FORMATS[k][2](found, self._move)

    def apply(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many values of each kind were replaced."""
        counts: dict[str, int] = {}

        def one(k: int, found: str) -> tuple[str, int] | None:
            """The pseudonym, and how much of what was found it stands for."""
            for end in ENDS.get(FORMATS[k][2], lambda x: [len(x)])(found):
                fresh = self.replace(k, found[:end])
                if fresh is not None:
                    counts[FORMATS[k][0]] = counts.get(FORMATS[k][0], 0) + 1
                    return fresh, end
            return None

        def numbers(part: str) -> str:
            if not HINT.search(part):
                return part
            out, done, at = [], 0, 0
            while m := PATTERN.search(part, at):
                k = int(next(n for n, v in m.groupdict().items() if v and n[0] == "f")[1:])
                start = m.start()
                hit = one(k, m[0])
                for j in range(k + 1, len(FORMATS) if hit is None else 0):
                    # What is no value of the first format may begin one of a later format.
                    if (later := EACH[j].match(part, start)) and (hit := one(j, later[0])):
                        break
                if hit:
                    out += [part[done:start], hit[0]]
                    done = at = start + hit[1]
                else:
                    at = FIRST_GROUP.match(part, start).end() if FORMATS[k][2] in ENDS else m.end()
            return "".join(out) + part[done:]

        if "@" not in text:
            return numbers(text), counts
        out, at = [], 0
        for m in EMAIL.finditer(text):
            hit = one(0, m[0])
            out += [numbers(text[at : m.start()]), hit[0] if hit else m[0]]
            at = m.end()
        return "".join(out) + numbers(text[at:]), counts


def secret_of(spark, trial: str | None = None) -> str:
    """The session's secret, else ``trial``, which the caller has to name; raises without either."""
    secret = spark.conf.get(KEY_SETTING, None) or trial
    if not secret:
        raise ValueError(f"set {KEY_SETTING}: pseudonyms without a secret can be undone by anyone")
    return secret


def pseudonymise(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``doc_id, text`` with pseudonyms, ``n_replaced`` and one count for each kind."""

    def run(batches):
        own = Pseudonyms(secret)
        for batch in batches:
            for part in slices(batch, text):
                done = [(None, {}) if x is None else own.apply(x) for x in part.column(text).to_pylist()]
                arrays = [part.column("doc_id"), pa.array([t for t, _ in done], pa.string())]
                arrays.append(pa.array([sum(c.values()) for _, c in done], pa.int32()))
                arrays += [pa.array([c.get(name, 0) for _, c in done], pa.int32()) for name in KINDS]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "n_replaced", *(f"n_{k}" for k in KINDS)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} int" for k in KINDS)
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, text string, n_replaced int, {counts}")


def pseudonymised(docs: DataFrame, secret: str, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns with the text replaced, and ``length`` counted anew if there is one."""

    def run(batches):
        own = Pseudonyms(secret)
        for batch in batches:
            for part in slices(batch, text):
                fresh = [None if x is None else own.apply(x)[0] for x in part.column(text).to_pylist()]
                fresh = pa.array(fresh, pa.string())
                part = part.set_column(part.schema.get_field_index(text), text, fresh)
                if length in part.schema.names:
                    at = part.schema.get_field_index(length)
                    counted = pc.utf8_length(fresh).cast(part.schema.field(at).type)
                    part = part.set_column(at, length, counted)
                yield part

    return docs.mapInArrow(run, docs.schema)
