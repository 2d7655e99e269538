"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each text once and reports anchors: at-signs, plus
signs, digits, scheme separators and words that announce an identifier. At every
anchor a small parser reads outwards, fixes both borders of the candidate and
validates it. No other part of the text is looked at again.

Kinds, in the order used for ties:

``email ip card phone``
    the base kinds. Per kind the leftmost match wins and matches don't overlap;
    a candidate that fails its validation is dropped as a whole.
``account``
    an identifier after a cue word ("iban", "account", "passport", "token", ...):
    at least one digit and five characters, digits in groups (at least five), or an IBAN with
    valid check digits.
``url``
    an address with a scheme that names a person or machine: it carries
    ``user@`` or its host is an IP address.

Spans count code points, the end is exclusive. A null text has no spans. Nothing is
shared between rows, so repeated rows, ties and extra columns don't matter; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import fresh, ship, stretches

KINDS = ("email", "ip", "card", "phone", "account", "url")
BASE_KINDS = KINDS[:4]
CHUNK = 1 << 20  # bytes of text that a task masks at once; bounds its memory

# Words that announce an identifier.
CUES = (
    "iban",
    "account",
    "acct",
    "konto",
    "kontonummer",
    "cuenta",
    "compte",
    "passport",
    "passeport",
    "pasaporte",
    "reisepass",
    "ssn",
    "tax id",
    "token",
    "api_key",
    "api key",
    "apikey",
    "secret",
    "password",
)

SPANS = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME = re.compile(r"[A-Za-z0-9+.-]{1,20}$")
_ADDRESS = re.compile(r"([^\s/?#\"'<>@]++@)?([A-Za-z0-9.-]++|\[[0-9A-Fa-f:.]{2,45}\])[^\s\"'<>]*")
_IBAN = re.compile(r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])")
_AFTER_CUE = re.compile(r"(?:[ _]?(?:number|no|nr|id|key)(?![A-Za-z0-9]))?\.?[ \t]*[:=#]?[ \t]*[\"']?(?=[A-Za-z0-9])", re.I)
_VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_/-]{3,}[A-Za-z0-9](?![A-Za-z0-9@])")
_GROUPED = re.compile(r"[0-9]++(?: [0-9]{2,}+)++(?![A-Za-z0-9@_/-])")


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        found.add_word(cue, ("cue", len(cue)))
    found.make_automaton()
    return found


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lowered(text: str) -> str:
    """``text`` with ASCII letters in lower case and all offsets as they were."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def valid_iban(text: str) -> bool:
    compact = text.replace(" ", "")
    moved = compact[4:] + compact[:4]
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain and start < at else None


def _ip(text: str, at: int) -> tuple[int, int, bool] | None:
    match = _IP.match(text, at)
    if not match:
        return None
    return at, match.end(), all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.groups())


def _card(text: str, at: int) -> tuple[int, int, bool] | None:
    match = _CARD.match(text, at)
    if not match:
        return None
    digits = match.group().replace(" ", "").replace("-", "")
    return at, match.end(), 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int) -> tuple[int, int, bool] | None:
    match = _PHONE.match(text, at)
    if not match:
        return None
    return at, match.end(), 10 <= sum(c in "0123456789" for c in match.group()) <= 15


def _account(text: str, start: int, end: int, floor: int) -> tuple[int, int] | None:
    if end < floor and text[end : end + 1].isdecimal():
        return None  # inside the last identifier
    if start and text[start - 1].isalnum() or text[end : end + 1].isalpha():
        return None
    match = _AFTER_CUE.match(text, end)
    if not match:
        return None
    iban = _IBAN.match(text, match.end())
    if iban and valid_iban(iban.group(1)):
        return iban.span(1)
    grouped = _GROUPED.match(text, match.end())
    if grouped and len(grouped.group().replace(" ", "")) >= 5:
        return grouped.span()
    value = _VALUE.match(text, match.end())
    return value.span() if value and any(c in "0123456789" for c in value.group()) else None


def _url(text: str, at: int) -> tuple[int, int] | None:
    scheme = _SCHEME.search(text, max(0, at - 20), at)
    address = _ADDRESS.match(text, at + 3)
    if not scheme or not address:
        return None
    named = address.group(1) or address.group(2)[:1] == "[" or _IP.fullmatch(address.group(2))
    return (scheme.start(), address.end()) if named else None


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text, by start and then by kind."""
    spans: list[tuple[str, int, int]] = []
    if not text:
        return spans
    upto = dict.fromkeys(KINDS, 0)
    last_digit = -2
    for at, (kind, size) in _automaton().iter(_lowered(text)):
        if kind == "digit":
            fresh_run, last_digit = at != last_digit + 1, at
            for name, parse in (("ip", _ip), ("card", _card)):
                # Inside a run nothing new begins, except right after a match.
                if at >= upto[name] and (fresh_run or at == upto[name]):
                    if got := parse(text, at):
                        upto[name] = got[1]
                        if got[2]:
                            spans.append((name, got[0], got[1]))
        elif kind == "at":
            if at >= upto["email"] and (got := _email(text, at, upto["email"])):
                upto["email"] = got[1]
                spans.append(("email", *got))
        elif kind == "plus":
            if at >= upto["phone"] and (got := _phone(text, at)):
                upto["phone"] = got[1]
                if got[2]:
                    spans.append(("phone", got[0], got[1]))
        else:
            start = at - size + 1
            name = "url" if kind == "scheme" else "account"
            got = _url(text, start) if kind == "scheme" else _account(text, start, at + 1, upto[name])
            if got and got[0] >= upto[name]:
                upto[name] = got[1]
                spans.append((name, *got))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[1], order[s[0]]))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each stretch of overlapping spans replaced by its first kind."""
    parts, upto, cut = [], 0, 0
    for kind, start, end in spans:
        if start >= cut:
            parts += [text[upto:start], f"<{kind.upper()}>"]
        cut = upto = max(cut, end)
    return "".join([*parts, text[upto:]])


def _digest(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _spans_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in texts:
        yield pa.array(
            [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t)] for t in batch.to_pylist()],
            kind,
        )


def _masked_text(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        for part in stretches(batch, CHUNK):
            yield pa.array(
                [None if t is None else masked(t, find_spans(t)) for t in part.to_pylist()],
                pa.string(),
            )


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``; a column of that name is replaced."""
    ship(docs.sparkSession)
    return docs.withColumn("pii_spans", F.arrow_udf(_spans_of, SPANS)(F.col(text)))


def mask(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with every span in ``text`` masked and ``length`` brought up to date.

    The columns stay as they are; a missing ``length`` column isn't added, and a null
    text stays null with its old length.
    """
    ship(docs.sparkSession)
    new = fresh("masked", docs)
    out = docs.withColumn(new, F.arrow_udf(_masked_text, "string")(F.col(text)))
    if length in docs.columns:
        now = F.when(F.col(new).isNull(), F.col(length)).otherwise(F.length(new))
        out = out.withColumn(length, now.cast(docs.schema[length].dataType))
    return out.withColumn(text, F.col(new)).select(*docs.columns)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in the order of the spans."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts per base kind, their digest, and all spans."""
    found = detect(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [
        F.expr(f"cast(size(filter(pii_spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
        for k in BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans")
    )
