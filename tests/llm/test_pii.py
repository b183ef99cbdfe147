import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import pii

#: The contract's patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def base(text):
    return [s for s in pii.find_spans(text) if s[0] in pii.BASE]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from([*"a.@+-_% ()01249\né٣", "a@b.c", "1.2.3.4", "255.256", "4111 1111 1111 1111", "+1 (555) 123-4567", "http://x", "ssn: "]), max_size=30))
def test_base_spans_equal_the_patterns(parts):
    text = "".join(parts)
    assert base(text) == brute(text)


def test_known():
    text = "Mail a.b+c@mail.example.com, from 10.0.0.255 or 10.0.0.256; card 4111-1111-1111-1111 call +1 (212) 555-0100. https://x.org/a?b=1). Password=ab12cd34 account 7"
    kinds = {k: text[s:e] for k, s, e in pii.find_spans(text)}
    assert kinds == {"email": "a.b+c@mail.example.com", "ip": "10.0.0.255", "card": "4111-1111-1111-1111", "phone": "+1 (212) 555-0100",
                     "url": "https://x.org/a?b=1", "account": "ab12cd34"}
    clean = pii.redact(text)
    assert clean.startswith("Mail [EMAIL], from [IP] or 10.0.0.256; card [CARD] call [PHONE]. [URL]). Password=[ACCOUNT]")
    assert pii.find_spans(clean) == []


def test_very_long_runs():
    text = "1" * 50_000 + "@" * 1000 + ".1" * 5000 + "+" * 500
    assert base(text) == brute(text)


def test_table(edge_docs, no_docs):
    rows = pii.personal_data(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.spans == "" and r.base_sha256 == empty and r.n_email == 0 for r in rows)
    assert pii.personal_data(no_docs).count() == 0
    same = edge_docs.select(pii.redacted("text").alias("text")).collect()
    assert sorted(str(r.text) for r in same) == sorted(str(r.text) for r in edge_docs.select("text").collect())
