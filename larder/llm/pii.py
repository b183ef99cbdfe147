"""Personal data by anchor expansion.

One Aho-Corasick pass over the text finds the anchors: at-signs, plus signs, digits, URL
schemes and identifier cues.  Each anchor starts a small deterministic parser that walks
outwards over the characters its kind allows, checks the boundaries and validates (octets,
Luhn, digit counts).  A digit run is one anchor, its digits are skipped together.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Span kinds in the order they are listed; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = DIGITS | _LETTERS | frozenset("._%+-")
LABEL = DIGITS | _LETTERS | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
_ID = DIGITS | _LETTERS | frozenset("-")
_URL_END = frozenset(" \t\n\r\x0b\x0c<>\"'`{}|\\^")

SCHEMES = ("http://", "https://", "ftp://")
#: Words before an identifier, in any case.
CUES = ("passport", "ssn", "iban", "account", "acct", "password", "konto", "cuenta", "compte")


_MADE: list = []


def _automaton():
    """The anchors' automaton, built once in each process."""
    if _MADE:
        return _MADE[0]
    import ahocorasick

    auto = ahocorasick.Automaton()
    for d in "0123456789":
        auto.add_word(d, ("digit", 1))
    auto.add_word("@", ("at", 1))
    auto.add_word("+", ("plus", 1))
    for s in SCHEMES:
        for form in (s, s.upper()):
            auto.add_word(form, ("scheme", len(form)))
    for c in CUES:
        for form in (c, c.capitalize(), c.upper()):
            auto.add_word(form, ("cue", len(form)))
    auto.make_automaton()
    _MADE.append(auto)
    return auto


def _run(text: str, at: int, allowed: frozenset, end: int) -> int:
    while at < end and text[at] in allowed:
        at += 1
    return at


def _email(text: str, at: int, floor: int, end: int) -> tuple[int, int] | None:
    """Local part leftwards (not before ``floor``), then two or more labels rightwards."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    stop = _run(text, at + 1, LABEL, end)
    if start == at or stop == at + 1:
        return None
    labels = 1
    while stop < end and text[stop] == "." and (after := _run(text, stop + 1, LABEL, end)) > stop + 1:
        stop, labels = after, labels + 1
    return (start, stop) if labels > 1 else None


def _octets(text: str, start: int, stop: int) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in text[start:stop].split("."))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _account(text: str, at: int, end: int) -> tuple[int, int] | None:
    """The run of six or more letters, digits and hyphens shortly after a cue."""
    stop = min(end, at + 4)
    while at < stop and text[at] in " :=#\"'":
        at += 1
    after = _run(text, at, _ID, end)
    return (at, after) if after - at >= 6 else None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed and then by start.

    Spans of one kind never overlap; a candidate that fails its check is dropped and the
    search goes on behind it.  Kinds are searched independently of each other.
    """
    found: dict[str, list] = {k: [] for k in KINDS}
    end = len(text)
    email_floor = digits_done = ip_done = card_done = url_done = account_done = 0
    for last, (what, size) in _automaton().iter(text):
        at = last - size + 1
        if what == "digit":
            if at < digits_done:
                continue
            digits_done = _run(text, at, DIGITS, end)
            if at >= ip_done:
                # four dotted numbers; the next search starts behind them
                stop, parts = digits_done, 1
                while parts < 4 and stop + 1 < end and text[stop] == "." and text[stop + 1] in DIGITS:
                    stop, parts = _run(text, stop + 1, DIGITS, end), parts + 1
                if parts == 4:
                    ip_done = stop
                    if _octets(text, at, stop):
                        found["ip"].append((at, stop))
            if at >= card_done:
                stop = digits_done
                while stop + 1 < end and text[stop] in " -" and text[stop + 1] in DIGITS:
                    stop = _run(text, stop + 1, DIGITS, end)
                card_done = stop
                if stop - at >= 13:
                    digits = "".join(c for c in text[at:stop] if c in DIGITS)
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        found["card"].append((at, stop))
        elif what == "at":
            if span := _email(text, at, email_floor, end):
                found["email"].append(span)
                email_floor = span[1]
        elif what == "plus":
            if at + 1 < end and text[at + 1] in DIGITS:
                stop = _run(text, at + 2, PHONE, end)
                while stop > at + 3 and text[stop - 1] not in DIGITS:
                    stop -= 1
                if stop > at + 3 and text[stop - 1] in DIGITS and 9 <= sum(c in DIGITS for c in text[at:stop]) <= 15:
                    found["phone"].append((at, stop))
        elif what == "scheme":
            if at >= url_done and (at == 0 or text[at - 1] not in _LETTERS):
                stop = last + 1
                while stop < end and text[stop] not in _URL_END:
                    stop += 1
                while stop > last + 1 and text[stop - 1] in ".,;:!?)":
                    stop -= 1
                if stop > last + 1:
                    found["url"].append((at, stop))
                    url_done = stop
        elif at >= account_done and (at == 0 or text[at - 1] not in _LETTERS):
            if span := _account(text, last + 1, end):
                account_done = span[1]
                if span[1] - span[0] <= 40 and sum(c in DIGITS for c in text[span[0]:span[1]]) >= 2:
                    found["account"].append(span)
    return [(k, s, e) for k in KINDS for s, e in sorted(found[k])]


def listing(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str) -> str:
    """Every span replaced by ``[KIND]``; overlapping spans become one mark, of the first kind listed."""
    out, at = [], 0
    merged: list[list] = []
    for s, e, k in sorted((s, e, KINDS.index(k)) for k, s, e in find_spans(text)):
        if merged and s < merged[-1][1]:
            merged[-1][1], merged[-1][2] = max(e, merged[-1][1]), min(k, merged[-1][2])
        else:
            merged.append([s, e, k])
    for s, e, k in merged:
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_url, n_account, base_sha256, spans): one row per input row.

    A null text is empty.  Repeated rows and null ids keep their own rows; there is no
    shuffle, so a hot source or a hot text costs what its rows cost.
    """
    def run(batches):
        import pyarrow as pa

        for b in batches:
            counts: dict[str, list] = {k: [] for k in KINDS}
            digests, lists = [], []
            for start in range(0, b.num_rows, 256):
                for text in b.column(1).slice(start, 256).to_pylist():
                    spans = find_spans(text or "")
                    for k in KINDS:
                        counts[k].append(sum(s[0] == k for s in spans) if spans else 0)
                    digests.append(hashlib.sha256(listing([s for s in spans if s[0] in BASE]).encode()).hexdigest())
                    lists.append(listing(spans))
            cols = [pa.array(counts[k], pa.int64()) for k in KINDS]
            yield pa.record_batch([b.column(0), *cols, pa.array(digests, pa.string()), pa.array(lists, pa.string())],
                                  names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redacted(text: Column | str) -> Column:
    """The text with its personal data replaced; null stays null."""
    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: redact(t) if t is not None else None)

    return run(text)
