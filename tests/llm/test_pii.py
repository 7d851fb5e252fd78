import hashlib
import random
import re

from llm_cases import EDGE

from ledgerloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def check(rows, out):
    want = {}
    for i, t in rows:
        found = base(t)
        want[i] = (*(sum(f[0] == k for f in found) for k in PLAIN),
                   hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:6] for r in out} == want


def texts():
    r = random.Random(4)
    parts = ["a@b.c.@d.e", "x@y@z.com", "_d@e.f", "me.55@mail4.example.com", "no@dot", "@", "a@b.c-d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8",
             "300.1.1.1", "007.000.255.1", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "5555555555554444", "1 2 3", "12",
             "+1 (437) 555-0689", "+1 23", "+123456789012345678", "+ 1", "++44 20 7946 0958 ", "é+49.30.901820", "\n", "🙂", "word", "--", "  ",
             "0000000000000", "1" * 30, "ü@example.org", "a.b+c%d@ex-ample.co.uk.", "9" * 3000, "q" * 3000, "1.1.1." * 50]
    return [(i, r.choice(["", " ", ", "]).join(r.choice(parts) for _ in range(r.randint(1, 14)))) for i in range(300)]


def test_base_spans_against_plain_patterns(documents):
    rows = texts()
    out = pii.personal_data(documents(rows)).collect()
    check(rows, out)
    for r in out:
        said = [s for s in r.spans.split(",") if s]
        assert said == sorted(said, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1]), int(s.split(":")[2])))
        want = {f"{k}:{a}:{b}" for k, a, b in base(dict(rows)[r.doc_id])}
        assert want <= set(said)


def test_patterns_discover_unseen_identifiers(documents):
    r = random.Random(1)
    rows = [(i, f"lorem ipsum call me at +1 555 {r.randint(1000000, 9999999)} dolor") for i in range(20)]
    rows += [(100 + i, f"sit amet 🙂 call me at 555-{r.randint(1000, 9999)} please") for i in range(4)]
    rows += [(200 + i, f"room {r.randint(100, 999)}-{r.randint(1000, 9999)} is free") for i in range(20)]
    out = pii.personal_data(documents(rows)).collect()
    check(rows, out)
    spans = {r.doc_id: r.spans for r in out}
    for i, t in rows:
        if 100 <= i < 200:
            a = t.index("555-")
            assert spans[i] == f"phone:{a}:{a + 8}"
        elif i >= 200:
            assert spans[i] == ""


def test_context_goes_past_earlier_matches(documents):
    """Labels that hold a digit, and a digit token two words back, are context of seeds and candidates alike."""
    r = random.Random(2)
    rows = [(i, f"lorem phone2: +1 555 {r.randint(1000000, 9999999)} dolor") for i in range(20)]
    rows += [(100 + i, f"sit amet phone2: 555-{r.randint(1000, 9999)} please") for i in range(4)]
    rows += [(200 + i, f"see v4 4you 10.0.0.{i} and") for i in range(20)] + [(300, "see v4 4you 10.0.1 and")]
    rows += [(400 + i, f"item 4you {i}.0.1 and") for i in range(50)]        # the last word alone says nothing
    out = pii.personal_data(documents(rows)).collect()
    check(rows, out)
    spans = {r.doc_id: r.spans for r in out}
    for i, t in rows:
        if 100 <= i < 200:
            assert spans[i] == f"phone:{t.index('555-')}:{t.index('555-') + 8}"
        elif i >= 400:
            assert spans[i] == ""
    assert spans[300] == "ip:12:18"


def test_edge_rows(documents):
    rows = EDGE + [(9, "1." * 50_000), (10, "a@" * 50_000), (11, "7" * 100_000)]
    out = pii.personal_data(documents(rows, extra=True)).collect()
    assert len(out) == len(rows)
    check([x for x in rows], out)
    assert pii.personal_data(documents([])).count() == 0


def test_a_text_of_many_matches_takes_time_in_proportion(documents):
    """200,000 digit tokens in one document, some of them card numbers."""
    import time

    card = "4111111111111111"
    text = " x ".join(card if i % 1000 == 0 else "1" for i in range(200_000))
    start = time.time()
    r = pii.personal_data(documents([(1, text), (2, "plain")])).collect()
    assert {x.doc_id: x.n_card for x in r} == {1: 200, 2: 0}
    assert time.time() - start < 240


def test_a_long_label_is_whole_or_none(documents):
    """A label that begins before the context gives no pattern of a part of it."""
    long = "x" * 60
    rows = [(i, f"{long}account 1.2.3.{i}") for i in range(20)]
    rows += [(100 + i, f"yaccount 77-{i}.5.6.7.8") for i in range(5)]
    entities = pii._entities(documents(rows)).where("kind = 'ip'")
    assert {r.pattern for r in pii._edges(entities).collect()} == set() or all(
        "account" != r.pattern[-7:] or r.pattern == "yaccount" for r in pii._edges(entities).collect())


def test_discovery_goes_on_until_nothing_is_added(documents):
    """Seven patterns in a chain: each reaches the confidence by the instances that the one before it found."""
    rows = []

    def said(label, instance):
        rows.append((len(rows), f"word label{chr(97 + label)} {instance} end"))

    for label in range(7):
        for k in range(21 if label else 28):
            said(label, f"10.{label}.0.{k}")
        for k in range(7):             # of the shape of an address, not one of the base pattern
            said(label, f"{label}.{k}.5")
            if label < 6:
                said(label + 1, f"{label}.{k}.5")
    out = {r.doc_id: r.spans for r in pii.personal_data(documents(rows)).collect()}
    assert all("ip" in s for s in out.values())
