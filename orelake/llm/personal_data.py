"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, plus signs,
digits, ``://`` and cue words.  At each anchor a small deterministic parser
expands to the boundaries of the span and validates it.

Kinds, in the order used for ties: email, ip, card, phone (the base kinds), then
url (a scheme and a host), iban (country, check digits and account number that
pass mod 97, after their cue), address (a street cue with its house number), secret
(what is assigned to a cue such as ``password`` or ``api_key``), account and identifier
(a number after a cue such as ``account no`` or ``passport``).  A secret holds a digit or
a sign besides its letters, an account number six digits, an identifier five.
A parser reads forward from its cue and only walks back where it has found a span, so
the work grows with the text, also where cues follow each other without a space.
Spans of one kind never overlap: a candidate that fails its check is consumed
and not tried again.  Positions are code points, ends exclusive.

Null and empty texts have no spans.  Rows are judged one by one, so ties,
repeated rows and empty tables need no care; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "address", "secret", "account", "identifier")

# Cue words; each is also looked for capitalised and in capitals.
_STREETS_AFTER = ("street", "avenue", "road", "lane", "boulevard")
_STREETS_BEFORE = ("rue", "calle", "avenida")
# These also end a longer word, which is then part of the span.
_STREETS_ENDING = ("straße", "strasse")

_SECRETS = (
    "password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "api-key", "api key", "apikey", "access_key", "access key",
    "private_key", "private key", "client_secret", "auth_key", "bearer", "passwort", "kennwort", "contraseña",
)
_ACCOUNTS = ("account", "acct", "routing", "sort code", "konto", "kontonummer", "compte", "cuenta")
_IDENTIFIERS = (
    "ssn", "social security", "passport", "reisepass", "pasaporte", "passeport", "driver license", "driver's license", "license", "tax id", "national id",
    "identity card", "ausweis", "steuernummer", "dni", "nif", "member id", "patient id", "employee id", "customer id",
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_RUN = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL_REST = re.compile(r"[A-Za-z0-9\[][^\s<>\"'`]*")
_IBAN = re.compile(r"[\x20:#.-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8})")
_NUMBER_AFTER = re.compile(r"[\x20.]{1,2}(?:[^\W\d_]+[\x20]){0,4}([0-9]{1,4}[a-zA-Z]?)\b")
_HOUSE = re.compile(r"\b[0-9]{1,5}[a-zA-Z]?\Z")
_SECRET = re.compile(r"[\"']?[\x20\t]{0,2}(?:[:=]{1,2}>?|is\b)?[\x20\t]{0,2}[\"']?([^\s\"'`<>,;]{6,})")
_NUMBERED = re.compile(
    r"s?[\x20]?(?:(?i:number|numero|número|nummer|num|nr|no|id|code|card)\b\.?)?[\x20]{0,2}(?:[:=#]|is\b)?[\x20]{0,2}[\"']?"
    r"([A-Z]{0,3}[0-9](?:[\x20-]?[0-9A-Z])*)\b"
)


def _street_number_before(text: str, floor: int, at: int) -> int:
    """Start of a house number followed by one to three words and the cue at ``at``, or -1."""
    found, end = -1, at
    for _ in range(3):
        if end <= floor or text[end - 1] != " ":
            break
        start = end - 1
        while start > floor and text[start - 1].isalpha():
            start -= 1
        if start == end - 1 or start <= floor or text[start - 1] != " ":
            break
        number = _HOUSE.search(text[max(start - 8, floor) : start - 1])
        if number:
            found = max(start - 8, floor) + number.start()
        end = start
    return found


def _numbered(text: str, after: int, least: int) -> tuple[int, int] | None:
    """The number that follows a cue; a word after it that looks like a part is given back."""
    match = _NUMBERED.match(text, after)
    if not match:
        return None
    value = match[1]
    while value and not (value[-1].isdigit() or value.rpartition(" ")[2].isalnum() and any(c.isdigit() for c in value.rpartition(" ")[2])):
        value = value.rpartition(" ")[0]
    if sum(c.isdigit() for c in value) < least:
        return None
    return match.start(1), match.start(1) + len(value)


def _passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _passes_mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def automaton():
    """Anchors as an Aho-Corasick machine; values are (kind of anchor, length)."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for c in "0123456789":
        machine.add_word(c, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme"), ("IBAN", "iban"), ("Iban", "iban"), ("iban", "iban")):
        machine.add_word(word, (kind, len(word)))
    groups = (
        (_STREETS_AFTER, "street_after"), (_STREETS_BEFORE, "street_before"), (_STREETS_ENDING, "street_ending"),
        (_SECRETS, "secret"), (_ACCOUNTS, "account"), (_IDENTIFIERS, "identifier"),
    )
    for cues, kind in groups:
        for cue in cues:
            for word in {cue, cue.capitalize(), cue.title(), cue.upper()}:
                machine.add_word(word, (kind, len(word)))
    machine.make_automaton()
    return machine


def spans(text: str, machine) -> list[tuple[int, int, str]]:
    """(start, end, kind) of everything found, by start, then kind as listed."""
    found: list[tuple[int, int, int]] = []
    # Where the next span of each kind may begin.
    free = [0] * len(KINDS)
    for last, (kind, length) in machine.iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= free[1]:
                match = _IP.match(text, at)
                if match:
                    free[1] = match.end()
                    if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                        found.append((at, match.end(), 1))
                else:
                    # From within the same digits the rest of the pattern fails alike.
                    free[1] = _RUN.match(text, at).end()
            if at >= free[2]:
                match = _CARD.match(text, at)
                if match:
                    free[2] = match.end()
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and _passes_luhn(digits):
                        found.append((at, match.end(), 2))
        elif kind == "at":
            start = at
            while start > free[0] and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1) if start < at else None
            if match:
                free[0] = match.end()
                found.append((start, match.end(), 0))
        elif kind == "plus":
            match = _PHONE.match(text, at) if at >= free[3] else None
            if match:
                free[3] = match.end()
                if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
                    found.append((at, match.end(), 3))
        elif kind == "scheme":
            start = at
            while start > free[4] and text[start - 1] in _SCHEME:
                start -= 1
            while start < at and not text[start].isalpha():
                start += 1
            match = _URL_REST.match(text, at + 3) if start < at else None
            if match:
                end = at + 3 + len(match[0].rstrip(".,;:!?)]}"))
                if end > at + 3:
                    free[4] = end
                    found.append((start, end, 4))
        elif kind == "iban":
            match = _IBAN.match(text, last + 1) if at >= free[5] else None
            while match:
                # A word after the number may have been taken in: give it back group by group.
                account = match[1]
                while account and not _passes_mod97(account.replace(" ", "")):
                    account = account.rpartition(" ")[0]
                if account:
                    free[5] = match.start(1) + len(account)
                    found.append((match.start(1), free[5], 5))
                break
        elif kind in ("secret", "account", "identifier"):
            place = KINDS.index(kind)
            # A cue within a longer word is none; names such as db_password are cues.
            if at < free[place] or at and text[at - 1].isalpha() or text[last + 1 : last + 2].isalpha() and text[last + 1] != "s":
                continue
            if kind == "secret":
                match = _SECRET.match(text, last + 1)
                # Without a sign of assignment only what is no word in any language.
                plain = match and text[last + 1 : match.start(1)].strip("\"' \t") == ""
                assigned = match and (not plain or len(match[1]) >= 16 and any(c.isdigit() for c in match[1]))
                value = match[1].rstrip(".:!?)]}") if assigned else ""
                span = (match.start(1), match.start(1) + len(value)) if len(value) >= 6 and not value.isalpha() else None
            else:
                span = _numbered(text, last + 1, 6 if kind == "account" else 5)
            if span:
                free[place] = span[1]
                found.append((*span, place))
        elif at >= free[6]:
            span = None
            if kind == "street_after":
                if not text[last + 1 : last + 2].isalpha():
                    start = _street_number_before(text, free[6], at)
                    span = (start, last + 1) if start >= 0 else None
            elif kind == "street_ending" or at == free[6] or not text[at - 1].isalpha():
                match = _NUMBER_AFTER.match(text, last + 1)
                if match:
                    start = at
                    while start > free[6] and text[start - 1].isalpha():
                        start -= 1
                    span = (start, match.end())
            if span:
                free[6] = span[1]
                found.append((*span, 6))
    found.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in found]


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: all spans of the whole text, by start, then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            out = [
                [{"start": a, "end": b, "kind": k} for a, b, k in spans(text, machine)] if text else []
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id bigint, found array<struct<start: int, end: int, kind: string>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, all spans as text, and how many of them are secrets and of any kind."""
    joined = lambda spans_: F.concat_ws(
        ",", F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        count("secret"), F.size("found").cast("long").alias("n_spans"),
    )
