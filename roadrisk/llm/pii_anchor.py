"""Personal data by anchor expansion.

One Aho-Corasick pass over the text with A-Z lower-cased finds anchors: at-signs, plus signs, digits, ``://``
and cues of identifiers (``CUES``: ``iban``, ``password``, ``api_key``, key prefixes, private key headers ...).
A deterministic parser per kind expands each anchor to the left and right and validates it:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` around an at-sign
* ``ip``     four dotted numbers of at most 255 from a digit
* ``card``   14 to 19 digits with single blanks or hyphens between, passing Luhn
* ``phone``  ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 10 to 15 digits from a plus sign
* ``url``    scheme letters to the left of ``://`` and the authority and path to the right
* ``iban``   two letters, two check digits and the rest, mod 97 = 1: of the country's length, single blanks between, at
  its first digit (with no letter or digit before); of any length from 15 to 34 after the cue, if the country is not known
* ``account`` 6 to 17 digits after an account cue
* ``secret`` the value after ``password=``, ``token: `` and the like, keys of known prefixes, private keys

Per kind, spans are leftmost and do not overlap: a parser starts at or after the end of the last
match of its kind, and a match that fails validation is dropped without another try. Offsets are
code points of the text, end exclusive. Null and empty texts have no spans; repeated rows each get a
row; extra columns are left out. A run of digits is read once per kind, so time is linear in the text.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("url", "iban", "account", "secret")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_RUN = re.compile(r"[0-9]+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[A-Za-z0-9\[][^\s\"'<>]*")
_IBAN_START = re.compile(r"[^A-Za-z0-9\n]{0,4}(?=[A-Z]{2}[0-9]{2})")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\x20(?i:no|number|nr)\b)?[.:#=\x20]{1,4}([0-9]{6,17})(?![0-9])")
_SECRET = re.compile(r"[\"']?\x20?[=:]\x20?[\"']?([A-Za-z0-9+/_.-]{8,})[\"']?")
_LOWER = {c: c + 32 for c in range(65, 91)}

# ---- fixed values: lengths of account numbers by country, shapes of keys with a known prefix ----
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23,
    "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
KEYS = {
    "akia": r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])", "asia": r"ASIA[A-Z0-9]{16}(?![A-Za-z0-9])", "aiza": r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])",
    "ghp_": r"ghp_[A-Za-z0-9]{36}(?![A-Za-z0-9])", "xox": r"xox[abprs]-[A-Za-z0-9-]{10,}", "sk_live_": r"sk_live_[A-Za-z0-9]{16,}",
    "-----begin": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,20}PRIVATE KEY-----)?",
}
_KEYS = {cue: re.compile(rule) for cue, rule in KEYS.items()}

#: Cue texts (of any case) and the parser that they start.
CUES = {
    "iban": "iban", "account": "account", "acct": "account", "password": "secret", "passwd": "secret", "pwd": "secret", "token": "secret", "secret": "secret",
    "api_key": "secret", "api-key": "secret", "apikey": "secret", "access_key": "secret", **{cue: "key" for cue in KEYS},
}


def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, "digit")
    a.add_word("@", "at")
    a.add_word("+", "plus")
    a.add_word("://", "scheme")
    for cue, parser in CUES.items():
        a.add_word(cue, cue if parser == "key" else parser)
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_at(text: str, start: int) -> int:
    """The end of a valid account number of a known country that starts at ``start``; 0 without one."""
    n = IBAN_LENGTHS.get(text[start : start + 2], 0)
    at = start
    while n and at < len(text):
        c = text[at]
        if c in _IBAN_CHARS:
            n -= 1
        elif c != " " or text[at - 1] == " ":
            return 0
        at += 1
    return at if at > start and not n and text[at : at + 1] not in _ALNUM and iban_ok(text[start:at]) else 0


_IBAN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_ALNUM = _IBAN_CHARS | frozenset("abcdefghijklmnopqrstuvwxyz")


def trimmed_url(url: str) -> str:
    """``url`` without the marks of the sentence around it: a closing bracket stays if it was opened inside."""
    while url and (url[-1] in ".,;:!?" or (url[-1] in ")]" and url.count(url[-1]) > url.count("([" [")]".index(url[-1])]))):
        url = url[:-1]
    return url


def iban_ok(value: str) -> bool:
    v = value.replace(" ", "")
    return v[2:4].isdigit() and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def find_spans(text: str, a: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every span, by start, then kind as listed."""
    out: list[tuple[int, str, int]] = []
    past = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
    ip_run = 0

    def take(kind: str, start: int, end: int, good: bool = True) -> None:
        past[kind] = end
        if good:
            out.append((start, kind, end))

    for end, what in a.iter(text.lower() if text.isascii() else text.translate(_LOWER)):
        if what == "digit":
            if end >= 2 and end - 2 >= past["iban"] and text[end - 2 : end] in IBAN_LENGTHS and (end == 2 or text[end - 3] not in _ALNUM) and (stop := iban_at(text, end - 2)):
                take("iban", end - 2, stop)
            if end >= past["card"] and (m := _CARD.match(text, end)):
                digits = re.sub(r"[\x20-]", "", m.group())
                take("card", end, m.end(), 14 <= len(digits) <= 19 and luhn(digits))
            if end >= past["ip"] and end >= ip_run:
                if m := _IP.match(text, end):
                    take("ip", end, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups()))
                else:  # then no start within this run of digits matches either
                    ip_run = _RUN.match(text, end).end()
        elif what == "at":
            start = end
            while start > past["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < end and (m := _DOMAIN.match(text, end + 1)):
                take("email", start, m.end())
        elif what == "plus":
            if end >= past["phone"] and (m := _PHONE.match(text, end)):
                take("phone", end, m.end(), 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15)
        elif what == "scheme":
            start = end - 2
            while start > past["url"] and text[start - 1] in _SCHEME:
                start -= 1
            while start < end - 2 and not text[start].isalpha():
                start += 1
            if start < end - 2 and (m := _URL_REST.match(text, end + 1)):
                stop = end + 1 + len(trimmed_url(m.group()))
                if stop > end + 1:
                    take("url", start, stop)
        elif what == "iban":  # of a country that is not known: the digits of the others find them
            start = m.end() if (m := _IBAN_START.match(text, end + 1)) else end
            if start >= past["iban"] and text[start : start + 2] not in IBAN_LENGTHS and (m := _IBAN.match(text, start)) and iban_ok(m.group()):
                take("iban", *m.span())
        elif what == "account":
            if end >= past["account"] and (m := _ACCOUNT.match(text, end + 1)):
                take("account", *m.span(1))
        elif what == "secret":
            if end >= past["secret"] and (m := _SECRET.match(text, end + 1)):
                take("secret", *m.span(1))
        elif end + 1 - len(what) >= past["secret"] and (m := _KEYS[what].match(text, end + 1 - len(what))):
            take("secret", *m.span())
    out.sort(key=lambda s: (s[0], _ORDER[s[1]]))
    return out


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
DDL = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, a digest of the base spans and all spans of every document."""

    def task(batches):
        a = anchors()
        for b in small_batches(batches):
            rows = [find_spans(t or "", a) for t in b.column(1).to_pylist()]
            counts = [[sum(s[1] == k for s in r) for r in rows] for k in KINDS]
            base = [hashlib.sha256(joined([s for s in r if s[1] in BASE]).encode()).hexdigest() for r in rows]
            yield batch(SCHEMA, [b.column(0), *counts, base, [joined(r) for r in rows]])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(task, DDL)


def redact(text: str, a: ahocorasick.Automaton) -> str:
    """``text`` with every span replaced by ``[KIND]``; overlapping spans become one, of the first kind."""
    spans = find_spans(text, a)
    if not spans:
        return text
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        else:
            at = max(at, end)
    return "".join(out) + text[at:]


def redacted(col: Column) -> Column:
    """The text column with personal data replaced; null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        a = _held()
        return texts.map(lambda t: redact(t, a) if t is not None else None)

    return run(col)


_AUTOMATON: list = []


def _held() -> ahocorasick.Automaton:
    """One automaton for each Python worker."""
    if not _AUTOMATON:
        _AUTOMATON.append(anchors())
    return _AUTOMATON[0]
