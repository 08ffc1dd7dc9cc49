"""Personal data in texts: anchors found by one automaton, expanded and checked by small local parsers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of spans, in the order in which they are listed; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

# Schemes of network addresses, those that are followed by a person's own address, and cues of
# identifiers in the languages of the texts. Each also stands in upper case and with a capital.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "ldap://")
OWNERS = ("mailto:", "tel:", "sip:", "sips:", "xmpp:", "skype:", "callto:")
CUES = (
    "account", "acct", "iban", "ssn", "social security", "passport", "username", "user id", "userid", "login", "customer id", "member id", "patient id",
    "password", "passwd", "passphrase", "token", "secret", "api key", "api_key", "apikey", "api-key", "access key", "access_key", "private key",
    "konto", "kontonummer", "passwort", "benutzername", "kundennummer", "compte", "mot de passe", "identifiant", "cuenta", "contraseña", "usuario",
)
AT_WORDS = ("[at]", "(at)", "{at}")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]*")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){0,3}")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+")
#: A mailbox of letters of any script, read backwards from the at-sign, and its domain.
WIDE_BEFORE = re.compile(r"[^\s@<>()\[\]{},;:\"'\\/|=]*")
WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
SPELLED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?|\.)[A-Za-z0-9-]+)+", re.I)
#: An address after its scheme: up to white space, quotes or brackets; its user, host and the rest.
ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]+")
HOST = re.compile(r"(?:([^@/?#]*)@)?(\[[0-9A-Fa-f:.]+\]|[\w.-]+)(?::[0-9]{1,5})?(?=[/?#]|$)")
#: A part of an address that names a person: a query key with a value, or a folder for users.
OWN_PART = re.compile(r"[?&;#](?:user|user_?name|user_?id|uid|login|e?mail|account|acct|token|session|sid|key|password|pwd|phone|name)=[^&;#]|/(?:users?|u|profiles?|people|members?|accounts?|in)/[^/?#]|/[~@][^/?#]", re.I)
PHONE_BODY = re.compile(r"\+?[0-9](?:[ ().-]?[0-9]){5,14}(?![0-9])")
#: What may stand between a cue and its identifier: a word for "number", a verb, an assignment and a quote.
LINK = re.compile(r"(?:[ \t_-]?(?:number|no|nr|num|nummer|numero|número|id|key|code)\b\.?)?[ \t]*(?:(?:is|was|ist|est|es)\b)?[ \t]*[\"']?[ \t]*([:=#]|=>)?[ \t]*[\"'`]?", re.I)
IDENTIFIER = re.compile(r"[^\W_](?:[\w./+=~$!*&%@-]*[\w=+/])?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: Digits, with or without an assignment, that an identifier has at least, and its least length.
LEAST_LENGTH, LEAST_DIGITS, LEAST_DIGITS_UNASSIGNED = 6, 1, 5
TRAILING = ".,;:!?)]*&%'"


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """One automaton of all anchors: signs, digits, schemes, spelled at-signs and cues; each has its kind and length."""
    found = ahocorasick.Automaton()
    for kind, words in (("at", "@"), ("plus", "+"), ("digit", "0123456789"), ("scheme", SCHEMES), ("owner", OWNERS), ("spelled", AT_WORDS), ("cue", CUES)):
        for word in words:
            for form in {word, word.upper(), word.title(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the check digit holds: every second digit from the right is doubled."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Scan:
    """One text: each parser is called with an anchor's place, and keeps how far it has read.

    A parser that has read a stretch, whether or not it took it, isn't called inside it again, so time
    is linear in the text. ``spans`` holds (kind, start, end); code points, end exclusive.
    """

    def __init__(self, text: str):
        self.text, self.spans, self.added = text, [], []
        self.read = dict.fromkeys(("email", "wide", "ip", "card", "phone", "address", "account"), 0)
        self.at = self.spelled_at = 0  # after the last at-sign, and the last spelled one

    def digit(self, start: int, end: int) -> None:
        if start >= self.read["ip"]:
            m = QUAD.match(self.text, start)
            parts = m[0].split(".")
            values = [p.lstrip("0") or "0" for p in parts]
            if len(parts) == 4 and all(len(v) <= 3 and int(v) <= 255 for v in values):
                self.spans.append(("ip", start, m.end()))
            self.read["ip"] = m.end()
        if start >= self.read["card"]:
            m = CHAIN.match(self.text, start)
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                self.spans.append(("card", start, m.end()))
            self.read["card"] = m.end()

    def plus(self, start: int, end: int) -> None:
        m = DIALLED.match(self.text, start)
        if m:
            number = m[0].rstrip(" ().-")
            if 8 <= sum(map(str.isdigit, number)) <= 15:
                self.spans.append(("phone", start, start + len(number)))

    def before(self, allowed: re.Pattern, least: int, end: int) -> int:
        """Where the run of ``allowed`` characters that ends at ``end`` begins, not before ``least``."""
        return end - allowed.match(self.text[least:end][::-1]).end()

    def at_sign(self, start: int, end: int) -> None:
        least, self.at = self.at, end
        first = self.before(BEFORE_AT, max(least, self.read["email"]), start)
        m = DOMAIN.match(self.text, end) if first < start else None
        if m:
            self.spans.append(("email", first, m.end()))
            self.read["email"] = m.end()
        if m and not self.text[first - 1 : first].isalpha() and not self.text[m.end() : m.end() + 1].isalpha():
            return
        first = self.before(WIDE_BEFORE, max(least, self.read["wide"]), start)
        while first < start and not self.text[first].isalnum():
            first += 1
        wide = WIDE_DOMAIN.match(self.text, end)
        if wide and any(map(str.isalpha, self.text[first:start])):
            self.added.append(("address", first, wide.end()))
            self.read["wide"] = wide.end()

    def spelled(self, start: int, end: int) -> None:
        least, self.spelled_at = self.spelled_at, end
        stop = start - 1 if self.text[start - 1 : start] == " " else start
        first = self.before(BEFORE_AT, min(least, stop), stop)
        m = SPELLED_DOMAIN.match(self.text, end)
        if first < stop and m and start >= self.read["address"]:
            self.added.append(("address", first, m.end()))
            self.read["address"] = m.end()

    def scheme(self, start: int, end: int) -> None:
        if start < self.read["address"] or self.text[start - 1 : start].isalnum():
            return
        m = ADDRESS.match(self.text, end)
        if not m:
            return
        self.read["address"] = m.end()
        body = m[0].rstrip(TRAILING)
        host = HOST.match(body)
        if host and (host[1] or OWN_PART.search(body, host.end())) and any(map(str.isalnum, host[2])):
            self.added.append(("address", start, end + len(body)))

    def owner(self, start: int, end: int) -> None:
        if start < self.read["address"] or self.text[start - 1 : start].isalnum():
            return
        m = PHONE_BODY.match(self.text, end) or ADDRESS.match(self.text, end)
        if not m:
            return
        self.read["address"] = m.end()
        body = m[0].rstrip(TRAILING)
        if m.re is PHONE_BODY or "@" in body[1:-1] and "." in body.rpartition("@")[2]:
            self.added.append(("address", start, end + len(body)))

    def cue(self, start: int, end: int) -> None:
        text = self.text
        if start < self.read["account"] or text[start - 1 : start].isalnum() or text[end : end + 1].isalpha():
            return
        link = LINK.match(text, end)
        if link.end() == end:
            return
        m = IBAN.match(text, link.end())
        if m:  # groups of four may run on into the words behind
            whole = m[0]
            while whole and not iban(whole):
                whole = whole[: whole.rstrip().rfind(" ")] if " " in whole else ""
            if whole:
                self.added.append(("account", link.end(), link.end() + len(whole)))
                self.read["account"] = link.end() + len(whole)
                return
        m = IDENTIFIER.match(text, link.end())
        if not m:
            return
        self.read["account"] = m.end()
        n = sum(map(str.isdigit, m[0]))
        if len(m[0]) >= LEAST_LENGTH and n >= (LEAST_DIGITS if link[1] else LEAST_DIGITS_UNASSIGNED):
            self.added.append(("account", m.start(), m.end()))


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) of a text, each by kind as in KINDS, then by start."""
    scan = Scan(text)
    parsers = {"at": scan.at_sign, "plus": scan.plus, "digit": scan.digit, "scheme": scan.scheme, "owner": scan.owner, "spelled": scan.spelled, "cue": scan.cue}
    for last, (kind, n) in anchors().iter(text):
        parsers[kind](last + 1 - n, last + 1)
    order = lambda s: (KINDS.index(s[0]), s[1])
    base = sorted(scan.spans, key=order)
    return base, sorted([*base, *set(scan.added)], key=order)


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of spans, joined where they overlap, replaced by the kind of its first one."""
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def found(docs: DataFrame, text: str = "text", redact: bool = False) -> DataFrame:
    """``docs`` without ``text`` and with ``base`` and ``spans``: arrays of (kind, start, end), and if wanted ``redacted``.

    Places are code points, ends exclusive. ``base`` has emails, IP addresses, payment cards and phone
    numbers, leftmost and not overlapping within a kind; ``spans`` adds addresses (with a person's name, key or mailbox
    in them, spelled or of letters of any script) and the identifiers that follow cues. One pass without a shuffle, over
    whole texts, in time linear in a text; a null or empty text has no spans. Rows, repeats and other columns stay as
    they are, but for columns that have the new names, which are replaced.
    """
    new = ["base", "spans", *(["redacted"] if redact else [])]
    kept = [c for c in docs.columns if c not in (text, *new)]
    inner = [f"c{i}" for i in range(len(kept))]

    def rows(texts: pa.Array) -> Iterator[tuple]:
        for value in texts:
            value = value.as_py() or ""
            base, every = spans(value)
            yield base, every, redacted(value, every) if redact else None

    def cells(found: list) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in one] for one in found], ARROW_SPANS)

    def work(batches):
        for b in batches:
            base, every, texts = zip(*rows(b["text"])) if b.num_rows else ((), (), ())
            made = [cells(base), cells(every), *([pa.array(texts, pa.string())] if redact else [])]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), *made], names=[*inner, *new])

    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for n, c in zip(inner, kept)), T.StructField("base", SPANS), T.StructField("spans", SPANS), *([T.StructField("redacted", T.StringType())] if redact else [])])
    return docs.select(*(F.col(c).alias(n) for c, n in zip(kept, inner)), F.col(text).alias("text")).mapInArrow(work, schema).toDF(*kept, *new)
