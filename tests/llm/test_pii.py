import hashlib
import re

from pyspark.sql import functions as F

from barlab.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * (2 if n % 2 else 1) for n, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def expected(text):
    """(start, kind, end) by the plain patterns over the whole text."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


ODD = [
    "a@b.com%foo@bar.com x@y z@@w.de .@a.b", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3", "@ @a.b a@b.c.",
    "4716 5300 6973 7000 4757965300669737 4757-9653-0066-9737", "+1 (743) 555-3824 +12 +1+2 +1 (663) 555-6869 44",
    "9" * 5_000, "1." * 4_000, "é+1 743 555 3824ü é@é.com ü1.2.3.4", "a@b.com@c.org", "+1" * 3_000, "a@" * 3_000,
    "", None, "x" * 100_000 + "@a.bc", "1-2-3 4 5-6 7 8 9 0 1 2 3 4", "256.1.1.1.1 1.2.3.256",
]


def test_base_rules_equal_the_patterns(texts):
    for text in [*texts.values(), *ODD]:
        assert pii.base_spans(text or "")[0] == expected(text)


def rows_with_patterns():
    rows = [(i, f"text {i} please write to user{i}@mail.org today and more") for i in range(8)]
    rows += [(20, "and please write to user_at_mail_org_42 today or not"),
             (21, "nothing is here but a key abcdef123456 lying around")]
    return rows


def test_patterns_discover_unseen_identifiers(make_docs):
    found = {r.doc_id: r for r in pii.find(make_docs(rows_with_patterns())).collect()}
    unseen = rows_with_patterns()[8][1]
    start = unseen.index("user_at")
    assert [tuple(s) for s in found[20].found] == [(start, 0, start + len("user_at_mail_org_42"))]
    assert found[21].found == [] and found[20].n_email == 0 and found[0].n_email == 1


def test_odd_rows(make_docs):
    rows = [(n, t) for n, t in enumerate(ODD)] + [(None, "a@b.cd"), (0, "c@d.ef"), (0, ODD[0])]
    found = pii.find(make_docs(rows)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        pii.spelled(F.concat("spans", "found")).alias("spans"), "spans",
    ).collect()
    got = sorted(((r[0], *r[1:7]) for r in found), key=str)
    wanted = []
    for i, text in rows:
        spans = expected(text)
        said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        counts = [sum(k == n for _, k, _ in spans) for n in range(4)]
        wanted.append((i, *counts, hashlib.sha256(said.encode()).hexdigest(), said))
    assert [g[:6] for g in got] == [w[:6] for w in sorted(wanted, key=str)]
    assert all(set(w[6].split(",")) <= {*g[6].split(","), ""}
               for g, w in zip(got, sorted(wanted, key=str), strict=True))


def test_redaction(make_docs):
    rows = [(1, "é mail a@b.cd, now"), (2, None), (3, ""), (None, "1.2.3.4"), (4, "clean"), (1, "clean"),
            (5, "x+1 743 555 3824y")]
    docs = make_docs(rows)
    redacted = pii.redact(docs)
    assert redacted.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in redacted.collect()), key=str)
    assert texts == sorted([(1, "é mail [EMAIL], now"), (2, None), (3, ""), (None, "[IP]"), (4, "clean"),
                            (1, "clean"), (5, "x[PHONE]y")], key=str)
    assert pii.redact(docs, small=0).count() == len(rows)


def test_empty_table(make_docs):
    docs = make_docs([(1, "a@b.cd")]).limit(0)
    assert pii.find(docs).collect() == [] and pii.redact(docs).collect() == []


def test_identifiers_written_with_spaces_are_discovered(make_docs):
    rows = [(i, f"text {i} our phone: +1 743 555 38{i}4 today and more") for i in range(8)]
    spelled = ["030 1234 5678", "(555) 123 4567", "030 / 123 45 67", "030 - 1234 567", "(0)30 12 34 56",
               "12 34567890"]
    texts = [f"so our phone: {s} is here" for s in spelled]
    texts += [f"so our phone: {s}. 5 of them" for s in spelled]
    rows += [(20 + i, t) for i, t in enumerate(texts)] + [(50, "we saw 12 34 56 78 birds")]
    found = {r.doc_id: [tuple(s) for s in r.found] for r in pii.find(make_docs(rows)).collect()}
    for i, text in enumerate(texts):
        said = spelled[i % len(spelled)]
        start = text.index(said)
        assert found[20 + i] == [(start, 3, start + len(said))], text
    assert found[50] == []


def test_many_spans_in_one_text():
    """20,000 addresses and 20,000 keys: time in proportion, and nothing next to a span lost."""
    import time

    taken = []
    for n in (2_000, 20_000):
        text = " ".join(f"mail a{i}@b.org key AB{i:07d}" for i in range(n))
        began = time.process_time()
        base, runs = pii.base_spans(text)
        found = pii._candidates(text, base, runs)
        words = pii._Words(text)
        patterns = [pii._patterns(words, s, e) for s, e in found]
        taken.append(time.process_time() - began)
        assert len(base) == n and [text[s:e] for s, e in found] == [f"AB{i:07d}" for i in range(n)]
        assert patterns[1] == ["a0@b.org key _", "key _ mail"]
    assert taken[1] < 25 * taken[0] + 1


def test_context_words_are_whole():
    long = "w" * 500
    text = f"{long} its-number: AB-12345 {long}"
    words, start = pii._Words(text), text.index("AB-")
    digest = hashlib.sha256(long.encode()).hexdigest()
    assert pii._patterns(words, start, start + 8) == [f"{digest} its-number: _", f"its-number: _ {digest}"]
    glued = pii._Words("see(id=X12345) now")
    assert pii._patterns(glued, 7, 13) == ["see(id= _ )"]
