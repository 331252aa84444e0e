"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in a text: at-signs, plus signs, digits, URL schemes and words that announce an
account. Small parsers grow a span around each anchor and validate it. Spans are in code points, end exclusive.

Kinds, in the order they are listed: email, ip, card and phone (the base), then url (a scheme and what follows it up to
white space, quotes or brackets, closing punctuation left off), account (the token with a digit after a cue), iban (two
letters, two check digits and 11 to 30 letters or digits whose remainder by 97 is 1) and handle (@name that is part of
no address). Base spans are those of the patterns below, searched from the left without overlap within a kind; matches
that fail validation are dropped, and nothing within them is tried again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sitecorpus.llm.frames import per_batch

KINDS = ("email", "ip", "card", "phone", "url", "account", "iban", "handle")
# Schemes and the words before account names.
SCHEMES = ("http://", "https://", "ftp://")
CUES = (
    "account", "Account", "ACCOUNT", "acct", "Acct", "user", "User", "login", "Login", "passport", "Passport", "ssn", "SSN", "token", "Token", "TOKEN",
    "api_key", "API_KEY", "apikey", "secret", "Secret", "password", "Password", "IBAN", "iban",
)

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s\"'<>()\[\]{}|]+")
_ACCOUNT = re.compile(r"(?:\s?(?:number|no|id|key|name))?[\s.:=#\"']{1,4}([A-Za-z0-9][A-Za-z0-9_-]{3,})")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_HANDLE = re.compile(r"@[A-Za-z_][A-Za-z0-9_]{1,29}(?![A-Za-z0-9_@.-])")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "@+":
        a.add_word(c, (c, 1))
    for c in "0123456789":
        a.add_word(c, ("0", 1))
    for s in SCHEMES:
        a.add_word(s, ("url", len(s)))
    for c in CUES:
        a.add_word(c, ("cue", len(c)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Finder:
    """All spans of a text: {kind: [(start, end)]}."""

    def __init__(self):
        self.anchors = _automaton()

    def __call__(self, text: str) -> dict[str, list[tuple[int, int]]]:
        out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        after = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, valid or not
        last_digit = -2
        for end, (what, n) in self.anchors.iter(text):
            at = end - n + 1
            if what == "0":
                # Later digits of a run start nothing new, unless the match before them ended inside the run.
                if at != last_digit + 1 or at == after["ip"]:
                    self._ip(text, at, out, after)
                if at != last_digit + 1 or at == after["card"]:
                    self._card(text, at, out, after)
                last_digit = at
            elif what == "@":
                self._email(text, at, out, after)
            elif what == "+":
                self._phone(text, at, out, after)
            elif what == "url":
                if at >= after["url"]:
                    stop = _URL.match(text, at).end()
                    while text[stop - 1] in ".,;:!?":
                        stop -= 1
                    after["url"] = stop
                    if stop > end + 1:
                        out["url"].append((at, stop))
            elif at >= after["account"] and not (at and text[at - 1].isalnum()):
                m = _ACCOUNT.match(text, end + 1)
                if m and any(c.isdigit() for c in m[1]):
                    out["account"].append(m.span(1))
                    after["account"] = m.end()
        return out

    def _email(self, text, at, out, after):
        start = at
        while start > after["email"] and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out["email"].append((start, m.end()))
            after["email"] = m.end()
        elif at >= after["email"] and (m := _HANDLE.match(text, at)) and (at == 0 or not text[at - 1].isalnum()):
            out["handle"].append(m.span())

    def _ip(self, text, at, out, after):
        if at >= after["ip"] and (m := _IP.match(text, at)):
            after["ip"] = m.end()
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                out["ip"].append(m.span())

    def _card(self, text, at, out, after):
        if at >= after["card"] and (m := _CARD.match(text, at)):
            after["card"] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if at >= 2 and at >= after["iban"] and (m := _IBAN.match(text, at - 2)) and not (at > 2 and text[at - 3].isalnum()):
            after["iban"] = m.end()
            if _iban(m[0]):
                out["iban"].append(m.span())

    def _phone(self, text, at, out, after):
        if at >= after["phone"] and (m := _PHONE.match(text, at)):
            after["phone"] = m.end()
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without the text column, with spans: array<struct<kind, start, end>>, by kind as listed, then start.

    Null and empty texts have no spans; every row is searched by itself, whatever other columns it has.
    """
    names = docs.columns
    at = names.index(text_col)
    kept = [i for i in range(len(names)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = []
            for text in batch.column(at).to_pylist():
                found = finder(text) if text else {}
                spans.append([{"kind": k, "start": s, "end": e} for k, ss in found.items() for s, e in sorted(ss)])
            return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(spans, _SPANS)], [*(names[i] for i in kept), "spans"])

        yield from per_batch(one)(batches)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    return docs.mapInArrow(run, ", ".join([*fields, "spans array<struct<kind:string,start:bigint,end:bigint>>"]))
