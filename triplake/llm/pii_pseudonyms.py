"""Personal data under format-preserving Feistel pseudonyms, the same for equal values in all documents.

Found values are validated first (check digits, calendar, ranges); each is a number below the size of its format's set
(days of a calendar range, digits without the check digit, four octets, ...). A keyed Feistel network over two halves,
walked until its result is in the set again, permutes that set, so a pseudonym is valid, has its value's form, is
reversible with the key, and two equal values get the same one wherever they stand, however they are punctuated.

Values that stand side by side (a row of a table, a list) may look like one: all ways to read such a run are compared, and
only valid values count. Phone numbers have no check digit, so digits that blanks cut evenly (``4111 1111 1111 1112``)
are not taken for one where more such digits follow. What stands before an e-mail's @ has at most 64 characters, as the mail
standard has it. Whether a string is a value is decided first; only values that are replaced are permuted.

Defined results: null text stays null; texts without personal data stay as they are; repeated rows are treated each; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import heapq
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import store
from triplake.llm import textarrays as ta

# Key of the registered query; a deployment passes its own secret.
DEMO_KEY = b"demonstration key, not a secret"
ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "ip", "date", "phone")

PATTERN = re.compile(r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})
  | (?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w))
  | (?P<card>(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-]))
  | (?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))
  | (?P<date>(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\w/-]))
  | (?P<phone>(?<![\w.+-])(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)|\d{2,4})(?:[\x20.-]\d{2,4}){2,4}(?![\w-]))
""", re.VERBOSE | re.ASCII)
# Each kind by itself: as in PATTERN, and without what may not stand around it (a neighbour that is a value too may).
STRICT = {kind: re.compile(x.strip(), re.VERBOSE | re.ASCII) for kind, x in zip(KINDS, re.split(r"\n  \| ", PATTERN.pattern))}
FORMS = {kind: re.compile(re.sub(r"\(\?(?:<!|!)(?:\[[^]]*\]|\\w)(?:\|\\.\\d)?\)", "", x.pattern) if kind != "email" else x.pattern, re.VERBOSE | re.ASCII)
         for kind, x in STRICT.items()}
BEFORE = {kind: re.compile(x, re.ASCII) for kind, x in zip(KINDS, (r"[\w.+-]", r"\w", r"[\w.-]", r"[\w.-]", r"[\w.]", r"[\w./-]", r"[\w.+-]"))}
AFTER = {kind: re.compile(x, re.ASCII) for kind, x in zip(KINDS, (r"(?!)", r"\w", r"[\w-]", r"[\w-]", r"\w|\.\d", r"[\w/-]", r"[\w-]"))}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
# Characters that a value of the kind has at least.
LEAST = {"iban": 12, "card": 13, "ssn": 11, "ip": 7, "date": 8, "phone": 8}
# What a kind's first digits look like: how many there are, and what may follow them.
SHAPES = (("card", 1, 12, " -"), ("ssn", 3, 3, "-"), ("ip", 1, 3, "."), ("date", 4, 4, "-"),
          ("date", 1, 2, "/."), ("phone", 2, 4, " .-"))
DIGITS = re.compile(r"\d+", re.ASCII)
START = re.compile(r"(?<!\w)[A-Za-z0-9+(]", re.ASCII)
# What may precede a phone number's own digits; digits that follow over single marks (values side by side are read together).
LEAD = re.compile(r"(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)[\x20.-]?)?", re.ASCII)
JOINED = re.compile(r"(?:[\x20./-]?[+(]{0,2}\d++\)?)*", re.ASCII)
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_LOCAL = "abcdefghijklmnopqrstuvwxyz0123456789"
_MARKS = dict.fromkeys(map(ord, " ./()+-"))  # what may stand between a value's digits
_DOUBLED = {48 + d: 2 * d - 9 * (d > 4) for d in range(10)}  # by a digit's character code


class Permutation:
    """Keyed permutations of the integers below any size; one object a key."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.of = lru_cache(maxsize=1 << 16)(self._of)

    def _half(self, label: str, turn: int, value: int, size: int) -> int:
        digest = hashlib.blake2b(f"{label}|{size}|{turn}|{value}".encode(), key=self.key, digest_size=16).digest()
        return int.from_bytes(digest, "big")

    def _once(self, value: int, a: int, b: int, label: str, back: bool) -> int:
        x, y = divmod(value, b)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2 == 0:
                x = (x + sign * self._half(label, turn, y, a)) % a
            else:
                y = (y + sign * self._half(label, turn, x, b)) % b
        return x * b + y

    def _of(self, value: int, size: int, label: str, back: bool = False) -> int:
        """The value's image (or what it is the image of): a Feistel network on a grid of at least ``size`` cells, walked back into range."""
        if size < 2:
            return value
        a = int(size ** 0.5) + 1
        b = -(-size // a)
        out = self._once(value, a, b, label, back)
        while out >= size:
            out = self._once(out, a, b, label, back)
        return out


def luhn(digits: str) -> bool:
    own = digits.encode()
    return (sum(own[-1::-2]) - 48 * len(own[-1::-2]) + sum(map(_DOUBLED.__getitem__, own[-2::-2]))) % 10 == 0


def _iban_digits(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))


def _refit(pattern: str, digits: str) -> str:
    """``digits`` in the places where ``pattern`` has digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def _ssn_ok(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _day(s: str) -> tuple[int, bool] | None:
    """A date's ordinal, and whether its month comes first; None outside the calendar's range."""
    year_first = s[4:5] == "-"
    mark = "-" if year_first else "/" if "/" in s else "."
    x = [int(v) for v in s.split(mark)]
    month_first = mark == "/" and x[1] > 12
    y, m, d = x if year_first else (x[2], x[0], x[1]) if month_first else (x[2], x[1], x[0])
    try:
        day = dt.date(y, m, d).toordinal()
    except ValueError:
        return None
    return (day, month_first) if FIRST_DAY <= day <= LAST_DAY else None


def valid(kind: str, s: str) -> bool:
    """Whether a string of this kind's form is a value."""
    if kind == "email":
        return True
    if kind == "ip":
        return max(map(int, s.split("."))) <= 255
    if kind == "date":
        return _day(s) is not None
    if kind == "iban":
        flat = s.replace(" ", "")
        return 15 <= len(flat) <= 34 and _iban_digits(flat) % 97 == 1
    digits = s.translate(_MARKS)
    if kind == "card":
        return luhn(digits) and len(set(digits)) > 1
    return _ssn_ok(int(digits)) if kind == "ssn" else 9 <= len(digits) <= 15


def pseudonym(kind: str, s: str, p: Permutation, back: bool = False) -> str | None:
    """The value's pseudonym (with ``back`` the value of a pseudonym); None if the string is no valid value."""
    if not valid(kind, s):
        return None
    if kind == "email":
        local, _, domain = s.partition("@")
        own = [c for c in local.lower() if c in _LOCAL]
        n = 0
        for c in own:
            n = n * 36 + _LOCAL.index(c)
        n = p.of(n, 36 ** len(own), "email" + str(len(own)) + domain.lower(), back)
        out = []
        for _ in own:
            n, r = divmod(n, 36)
            out.append(_LOCAL[r])
        it = reversed(out)
        return "".join(next(it) if c.lower() in _LOCAL else c for c in local) + "@" + domain
    if kind == "ip":
        n = p.of(int.from_bytes(bytes(map(int, s.split("."))), "big"), 1 << 32, "ip", back)
        return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "date":
        year_first = s[4:5] == "-"
        mark = "-" if year_first else "/" if "/" in s else "."
        day, month_first = _day(s)
        new = dt.date.fromordinal(FIRST_DAY + p.of(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", back))
        if year_first:
            return new.isoformat()
        return (f"{new.month:02}/{new.day:02}" if month_first else f"{new.day:02}{mark}{new.month:02}") + f"{mark}{new.year}"
    digits = re.sub(r"\D", "", s)
    if kind == "card":
        body = str(p.of(int(digits[:-1]), 10 ** (len(digits) - 1), f"card{len(digits)}", back)).zfill(len(digits) - 1)
        return _refit(s, body + next(c for c in "0123456789" if luhn(body + c)))
    if kind == "ssn":
        n = p.of(int(digits), 10 ** 9, "ssn", back)
        while not _ssn_ok(n):
            n = p.of(n, 10 ** 9, "ssn", back)
        return _refit(s, str(n).zfill(9))
    if kind == "iban":
        flat = s.replace(" ", "")
        # letters stay, the account's digits are permuted, the two check digits follow
        own = "".join(c for c in flat[4:] if c.isdigit())
        new = iter(str(p.of(int(own or 0), 10 ** len(own), f"iban{flat[:2]}{len(own)}", back)).zfill(len(own)))
        body = "".join(next(new) if c.isdigit() else c for c in flat[4:])
        whole = flat[:2] + f"{98 - _iban_digits(flat[:2] + '00' + body) % 97:02}" + body
        it = iter(whole)
        return "".join(" " if c == " " else next(it) for c in s)
    lead = re.match(r"\+\d{1,3}(?=[\x20.(-])", s)  # the country code stays
    keep = len(re.sub(r"\D", "", lead.group())) if lead else 0
    own = digits[keep:]
    new = str(p.of(int(own), 10 ** len(own), f"phone{digits[:keep]}:{len(own)}", back)).zfill(len(own))
    return _refit(s, digits[:keep] + new)


def _forms(text: str, s: int) -> tuple[str, ...]:
    """The kinds whose form may start at ``s``, by its first characters."""
    mail = ("email",) if "@" in text[s:s + 65] else ()
    c = text[s]
    if c.isdigit():
        run = DIGITS.match(text, s).end()
        n, mark = run - s, text[run:run + 1]
        return mail + (("card",) if n > 12 else ()) + tuple(
            kind for kind, least, most, marks in SHAPES if least <= n <= most and mark and mark in marks)
    return ("phone",) if c in "+(" else mail + ("iban",) if "A" <= c <= "Z" else mail


def _read(text: str, s: int) -> tuple[list[tuple], int]:
    """Valid values that start at ``s``, as (start, end, kind, start stands free, end stands free), and how far any form reaches."""
    found, reach = [], s
    if s and text[s - 1] in _WORD:
        return found, reach
    for kind in _forms(text, s):
        form = FORMS[kind]
        m = form.match(text, s)
        if m is None:
            continue
        reach = max(reach, m.end())
        bounds = range(m.end(), m.end() - 1, -1) if kind == "email" else range(m.end(), s + LEAST[kind] - 1, -1)
        strict = STRICT[kind].match(text, s) if kind == "phone" else None
        for e in bounds:
            if text[e:e + 1] in _WORD or text[e - 1] not in _WORD or not _holds(form, kind, text, s, e):
                continue
            found.append((s, e, kind, BEFORE[kind].match(text[s - 1:s]) is None,
                          AFTER[kind].match(text, e) is None and (kind != "phone" or _apart(text, s, e, e) or strict is not None and strict.end() == e)))
    return found, reach


def _holds(form: re.Pattern, kind: str, text: str, s: int, e: int) -> bool:
    return form.fullmatch(text, s, e) is not None and valid(kind, text[s:e])


def _apart(text: str, s: int, e: int, edge: int) -> bool:
    """Whether a phone number's edge is no mark that also stands between its own digits with more digits behind."""
    mark, digit = (text[e:e + 1], text[e + 1:e + 2]) if edge == e else (text[max(s - 1, 0):s], text[max(s - 2, 0):max(s - 1, 0)])
    return not digit.isdigit() or mark not in re.sub(r"[\d()+]", "", text[s:e])


def _shape(value: str) -> tuple[int, ...]:
    return tuple(len(x) for x in re.findall(r"\d+", value))


def _values(text: str, a: int) -> tuple[list[tuple], int]:
    """The values of the run of adjacent forms that starts at ``a``, and the run's end.

    Of all ways to read the run the one with most characters in kinds of a strict form wins, then in cards and phone numbers
    of one punctuation, then in any; then several values go before one card and a card before a phone number. Where a value touches digits
    over a mark of its own (a phone number a blank, a date a hyphen), a value must stand there too.
    """
    run, at, by_end = a, a, {}
    free, waiting = ((0, 0, 0, 0), None), []
    while (m := START.search(text, at)) and (m.start() <= a or m.start() < run):
        s = m.start()
        at = s + 1
        found, reach = _read(text, s)
        if max(reach, m.end()) > run:
            run = JOINED.match(text, max(reach, m.end())).end()
        while waiting and waiting[0][0] <= s:
            _, _, chain = heapq.heappop(waiting)
            free = max(free, chain, key=lambda x: x[0])
        for value in found:
            _, e, kind, left, right = value
            left &= kind != "phone" or s == a or _apart(text, s, e, s)
            size = sum(c.isalnum() for c in text[s:e])
            loose = kind in ("card", "phone")
            even = loose and len(set(re.sub(r"\d", "", LEAD.sub("", text[s:e], count=1)))) < 2
            own = (0 if loose else size, size if even else 0, size, {"card": 4, "phone": 3}.get(kind, 6))
            before = [free] if left else []
            for chain in by_end.get(s - 1, ()):
                last = chain[1][0]
                if left and last[4] or _side_by_side(text, last, value):
                    before.append(chain)
            if not before:
                continue
            score, last = max(before, key=lambda x: x[0])
            chain = (tuple(x + y for x, y in zip(score, own)), (value, last))
            by_end.setdefault(e, []).append(chain)
            if right:
                heapq.heappush(waiting, (e, s, chain))
    free = max([free, *(x[2] for x in waiting)], key=lambda x: x[0])
    out, link = [], free[1]
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1], max(run, a + 1)


def _side_by_side(text: str, x: tuple, y: tuple) -> bool:
    """Whether y may follow x though one of them touches the other's digits; of two phone numbers the first must be whole or alike."""
    if x[2] != "phone" or y[2] != "phone":
        return True
    one, two = _shape(text[x[0]:x[1]]), _shape(text[y[0]:y[1]])
    return x[4] or one == two and len(set(one)) > 1


def pseudonymise(text: str, p: Permutation) -> tuple[str, Counter]:
    """The text with each valid value replaced, and how many of each kind were."""
    counts: Counter = Counter()
    out, done, at = [], 0, 0
    while m := PATTERN.search(text, at):
        if m.lastgroup == "email":
            values, at = [(*m.span(), "email")], m.end()
        else:
            values, at = _values(text, m.start())
        for s, e, kind, *_ in values:
            out += [text[done:s], pseudonym(kind, text[s:e], p)]
            done = e
            counts[kind] += 1
        at = max(at, done)
    return "".join([*out, text[done:]]), counts


def pii_pseudonyms(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_<kind>...) of every document, personal data replaced."""

    def scan(batches):
        p = Permutation(key)
        digit = np.zeros(256, bool)
        digit[0x30:0x3A] = True
        for batch in batches:
            column = batch.column("text")
            data, off = ta.flat(column)
            n = batch.num_rows
            texts = {}
            counts = {k: [0] * n for k in KINDS}

            def held(mask):
                sums = np.concatenate([[0], np.cumsum(mask)])
                return sums[off[1:]] - sums[off[:-1]]

            # every kind has an @ or at least four digits
            for k in np.flatnonzero((held(data == 0x40) > 0) | (held(digit[data]) >= 4)).tolist():
                text = data[off[k]:off[k + 1]].tobytes().decode("utf-8", "replace")
                new, found = pseudonymise(text, p)
                for kind, c in found.items():
                    counts[kind][k] = c
                if found:
                    texts[k] = new
            if texts:
                at = np.array(sorted(texts))
                mask = np.zeros(n, bool)
                mask[at] = True
                column = pa.compute.replace_with_mask(column, pa.array(mask), pa.array([texts[k] for k in at.tolist()], column.type))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column, *(pa.array(counts[k], pa.int64()) for k in KINDS)],
                                             names=["doc_id", "text", *(f"n_{k}" for k in KINDS)])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return store.map_arrow(rows, scan, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data under pseudonyms."""
    return pii_pseudonyms(spark.read.parquet(f"{sf_dir}/documents.parquet"), DEMO_KEY)


QUERIES = {"op8_pii_pseudonyms": op8_pii_pseudonyms}
ORACLE: dict[str, str] = {}
