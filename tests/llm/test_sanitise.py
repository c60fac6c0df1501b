import re
from hashlib import sha256
from math import log2

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import docs_frame
from hazardry.llm import sanitise as S

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(map(int, str(2 * int(d)))) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


TEXTS = [
    None, "", "é a.b@c.de, x@y, @z.com a@b@c.d.e. p@q.r-s..t %+@1.2", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 0000000255.1.1.1 ٣.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 0000000000000 79927398713", "+1 (262) 555-3752 +44.20.7946.0958 +1--- +12 +123456789012345678 +1 2)",
    "a@b.co 10.0.0.1 +49 30 1234567 5555555555554444", "@" * 500 + "a@b.cc" + "x" * 5000, "1" * 3000, ("1." * 1000) + "+" * 50, "tel:+1(555)555-5555x",
]


@pytest.mark.parametrize("text", TEXTS)
def test_patterns(text):
    assert S.base_spans(text or "") == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1209@.+-% ()é_\n", max_size=60))
def test_patterns_on_any_text(text):
    assert S.base_spans(text) == brute(text)


def brute_marks(texts):
    """spans of every text by counting over all distinct texts, with the terms that disclose an entity."""
    seen = {}
    for text in {t or "" for t in texts}:
        spans = brute(text)
        words = [(m.group().lower(), *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", text)]
        words = [w for w in words if not any(w[1] < b and a < w[2] for _, a, b in spans)]
        seen[text] = spans, {(k, text[a:b].lower()) for k, a, b in spans}, words
    total, out = len(seen), {}
    entities = {e for _, own, _ in seen.values() for e in own}
    holds = {e: [t for t, (_, own, _) in seen.items() if e in own] for e in entities}
    n = {}
    for _, _, words in seen.values():
        for w in {w[0] for w in words}:
            n[w] = n.get(w, 0) + 1
    for text, (spans, own, words) in seen.items():
        more = []
        for word, a, b in words:
            shares = [-1.0]
            for e in own:
                of = len(holds[e])
                both = sum(any(w[0] == word for w in seen[t][2]) for t in holds[e])
                if of < total:
                    shares.append(log2((both * total / n[word] + 1) / (of + 1)) / log2(total / of))
            if max(shares) >= 0.7:
                more.append((max(shares) >= 0.85, a, b))
        out[text] = told(spans), told([*spans, *(("gone" if g else "term", a, b) for g, a, b in sorted(more))])
    return out


def test_frame(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[6]), (90, "word " * 50_000 + "me@here.org")]
    got = S.personal_data(docs_frame(spark, rows)).collect()
    want = brute_marks([t for _, t in rows])
    assert sorted((str(r["doc_id"]), r["spans"]) for r in got) == sorted((str(d), want[t or ""][1]) for d, t in rows)
    base = {d: want[t or ""][0] for d, t in rows}
    for r in got:
        own = base[r["doc_id"]]
        assert r["base_sha256"] == sha256(own.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in S.KINDS] == [sum(s.startswith(k) for s in own.split(",")) for k in S.KINDS]
    assert S.personal_data(docs_frame(spark, [])).collect() == []


def corpus():
    """Addresses of one, two and many texts among common words; a surname twenty words from an address seen once."""
    rows = [(k, f"common words fill text number {k} everywhere") for k in range(300)]
    rows += [(5000 + k, "please contact Quixworth zub Blemmyes at q0@mail.org about common words") for k in range(4)]
    rows += [(6000, "Quixworth alone"), (6001, "other@mail.org " + "common words fill text " * 5 + "Farthingale")]
    rows += [(6100 + k, f"desk@mail.org and 10.0.0.{k // 2} helpdesk common words {'Zed' * (k % 2)} {k}") for k in range(40)]
    rows += [(6200, "lists a1@x.org a2@x.org a3@x.org İstanbul common"), (6201, "lists a1@x.org a2@x.org İSTANBUL words")]
    return rows


def marked_words(text, spans):
    parts = [s.split(":") for s in spans.split(",") if s]
    return {(k, text[int(a) : int(b)]) for k, a, b in parts}


def test_marks_against_brute_force(spark):
    rows = corpus()
    text = dict(rows)
    got = {r["doc_id"]: r["spans"] for r in S.personal_data(docs_frame(spark, rows)).collect()}
    want = brute_marks(text.values())
    assert got == {d: want[t][1] for d, t in rows}
    assert {("email", "q0@mail.org"), ("gone", "Blemmyes")} <= marked_words(text[5000], got[5000])
    assert ("gone", "Farthingale") in marked_words(text[6001], got[6001])
    assert ("gone", "helpdesk") in marked_words(text[6100], got[6100])
    assert got[6000] == "" and not any(got[k] for k in range(300))
    assert not {"common", "words", "fill"} & {w for d, t in rows for _, w in marked_words(t, got[d])}


def test_marks_do_not_depend_on_copies(spark):
    """A text a hundred times over discloses what it did once."""
    rows = corpus()
    once = {r["doc_id"]: r["spans"] for r in S.personal_data(docs_frame(spark, rows)).collect()}
    again = S.personal_data(docs_frame(spark, [*rows, *[(9000 + k, rows[302][1]) for k in range(100)]])).collect()
    assert {r["doc_id"]: r["spans"] for r in again if r["doc_id"] < 9000} == once
    assert {r["spans"] for r in again if r["doc_id"] >= 9000} == {once[5002]}


def test_redaction(spark):
    text = {r["doc_id"]: r["text"] for r in S.redact(docs_frame(spark, [*corpus(), (7, None), (7, None)])).collect()}
    assert "@" not in text[5000] and "Quixworth" not in text[5000] and "common words" in text[5000] and "[email]" in text[5000]
    assert text[6000] == "Quixworth alone" and text[7] is None
    assert S.redacted("ab cd ef", [("term", 3, 5), ("gone", 0, 2), ("term", 4, 8)]) == " [term] ef"
