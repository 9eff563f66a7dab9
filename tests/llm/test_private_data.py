from __future__ import annotations

import hashlib
import random
import re

import pytest

from recordloom.llm import private_data

RULES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    found = []
    for rank, (kind, rule) in enumerate(RULES):
        for m in rule.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def digests(docs):
    return [tuple(r) for r in private_data.digest(private_data.personal_data(docs)).collect()]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = []
    for doc_id, text in rows:
        spans = plain_spans(text)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
        counts = [sum(x[2] == k for x in spans) for k in private_data.KINDS]
        expected.append((doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    found = digests(docs)
    assert sorted(map(str, expected)) == sorted(str(r[:6]) for r in found)
    return found


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
def test_base_spans_equal_the_patterns(frame, request):
    check(request.getfixturevalue(frame))


def test_awkward_texts(docs_of):
    rng = random.Random(5)
    alphabet = ["a", "Z", "_", "-", ".", "..", "@", "+", "1", "23", "255", "256", "4111111111111111", " ", "  ", "(", ")", "%",
                "", "", "é", "\U0001f600", "\n", "user@host.com", "10.0.0.1", "+1 (234) 555-0199"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    texts += [
        "a@b.c_d@e.f", "a@b.c@d.e.f", "@a.b x@y. z@w.q.", "1.2.3.4.5.6.7.8", "01.002.0003.4", "1" * 30_000,
        "4 " * 20_000, "a." * 20_000 + "@b" + ".c" * 20_000, "+1" + "-" * 20_000 + "2", "1 2-3 " * 9000,
    ]
    check(docs_of([(i, t, "a") for i, t in enumerate(texts)]))


def test_confident_contexts_find_unseen_identifiers(docs_of):
    rng = random.Random(2)
    rows = [(i, f"please call me under +1 ({200 + i}) 555-{1000 + i} soon", "a") for i in range(30)]
    rows += [(100 + i, f"please call me under 0{rng.randint(10**8, 10**9)} soon", "a") for i in range(3)]
    rows += [(200 + i, f"the model number {rng.randint(10**6, 10**7)} is sold", "a") for i in range(9)]
    rows += [(300, "please call me under 0555123456. It is late", "a"), (300, "please call me under 0555123456. It is late", "a")]
    found = {r[0]: r for r in check(docs_of(rows))}
    for i in range(3):
        start = len("please call me under ")
        assert found[100 + i][6].startswith(f"phone:{start}:") and found[100 + i][1:5] == (0, 0, 0, 0)
    assert found[300][6] == "phone:21:31"
    assert all(found[200 + i][6] == "" for i in range(9))
    assert all(found[i][6] == f"phone:21:{21 + 17}" for i in range(30))


def test_groups_and_email_like_forms_are_found_whole(docs_of):
    left = {"phone": "please call me under ", "card": "charged to my card ", "email": "write me an email at ", "ip": "the host with address "}
    seed = {"phone": "+1 ({}) 555-1000", "email": "u{}@host.com", "ip": "10.0.0.{}"}
    rows = [(1000 * k + i, left[x] + seed[x].format(200 + i) + " soon", "a") for k, x in enumerate(seed) for i in range(30)]
    cards = [n for n in range(4 * 10**15, 4 * 10**15 + 400) if luhn(str(n))][:30]
    rows += [(5000 + i, f"{left['card']}{n} soon", "a") for i, n in enumerate(cards)]
    unseen = [("phone", x) for x in ("030 123 4567", "(030) 123 4567", "030/123-4567", "030 (12) 3456", "0555123456")]
    unseen += [("card", x) for x in ("1234 5678 9012 3456", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32")]
    unseen += [("email", x) for x in ("john.smith@localhost", "john(at)example.org", "john [at] example.org")]
    unseen += [("ip", "2001:db8::ff00:42:8329"), ("ip", "00:1A:2B:3C:4D:5E")]
    rows += [(9000 + i, left[kind] + x + " soon", "a") for i, (kind, x) in enumerate(unseen)]
    rows += [(9900, "there were 040 765 4321 of a@b (12) 5 left", "a"), (9901, left["phone"] + "12 or", "a")]
    found = {r[0]: r[6] for r in check(docs_of(rows))}
    for i, (kind, x) in enumerate(unseen):
        start = len(left[kind])
        assert found[9000 + i] == f"{kind}:{start}:{start + len(x)}", x
    assert found[9900] == found[9901] == ""


def test_masked_texts(docs_of):
    docs = docs_of([(1, "Öl an a@b.de und 10.0.0.1!", "a"), (2, None, "a"), (None, "x 10.0.0.2", "a")])
    assert {r.doc_id: r.text for r in private_data.masked(docs).collect()} == {
        1: "Öl an [email] und [ip]!", 2: "", None: "x [ip]",
    }


def test_secrets_are_seeds_and_their_contexts_find_others(docs_of):
    rng = random.Random(8)
    digits = "0123456789abcdef"
    secret = ["".join(rng.choice(digits) for _ in range(40)) for _ in range(12)]
    rows = [(i, f'set the api token = "{x}" and go', "a") for i, x in enumerate(secret)]
    rows += [(50, 'set the api token = "zq81-77x" and go', "a"), (51, f"key:{secret[0].upper()}", "a")]
    rows += [(60, 'x = "aaaaaaaaaaaaaaaaaaaaaaaaa1" or y = "' + "word" * 8 + '"', "a"), (61, f"the commit {secret[1]} is old", "a")]
    found = {r[0]: (r[6], r[7]) for r in check(docs_of(rows))}
    start = len('set the api token = "')
    for i in range(12):
        assert found[i] == (f"secret:{start}:{start + 40}", 1)
    assert found[50] == (f"secret:{start}:{start + 8}", 1)
    assert found[51] == ("secret:4:44", 1) and found[60] == ("", 0)


def test_runs_with_few_digits_are_named_by_their_place(docs_of):
    rows = [(i, f"please call me under +1 ({200 + i}) 555-{1000 + i} soon", "a") for i in range(30)]
    rows += [(100, "please call me under x12y soon, or 112", "a"), (101, "we sold x12y and 112 of them", "a")]
    found = {r[0]: r[6] for r in check(docs_of(rows))}
    assert found[100] == "phone:21:25" and found[101] == ""


def test_the_graph_equals_one_made_by_hand(docs_of, sample):
    """Trust of patterns and scores of identifiers, round by round, over the spans of a corpus."""
    rng = random.Random(3)
    heads = ["call me under", "my card is", "write to", "order no", "see page"]
    kinds = {"call me under": lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", "write to": lambda: f"u{rng.randint(0, 99)}@host.com"}
    rows = []
    for i in range(150):
        head = rng.choice(heads)
        what = kinds[head]() if head in kinds and rng.random() < 0.8 else str(rng.randint(0, 10 ** rng.choice([2, 3, 6, 9])))
        rows.append((i, f"please {head} {what} soon", "a"))
    found = private_data._found(docs_of(rows).select("doc_id", "text").union(sample.select("doc_id", "text")), "doc_id", "text")
    spans = private_data._uncovered(private_data._placed(found)).cache()
    held = spans.collect()
    edges, inner = {}, {}
    for r in held:
        for p in r.patterns:
            edges.setdefault(p, {}).setdefault(r.m, []).append(r.inner)
    counted = {p: {m for m, flags in ms.items() if not all(flags)} for p, ms in edges.items()}
    seeds = {(r.m, r.kind) for r in held if r.kind != "candidate"}
    score = {s: 1.0 for s in seeds}
    for _ in range(private_data.ROUNDS):
        trust = {}
        for p, ms in counted.items():
            for kind in private_data.ALL_KINDS:
                total = sum(score.get((m, kind), 0.0) for m in ms)
                if ms and total / (len(ms) + private_data.DOUBT) >= private_data.CONFIDENT:
                    trust[p, kind] = total / (len(ms) + private_data.DOUBT)
        left = {}
        for (p, kind), t in trust.items():
            for m in edges[p]:
                left[m, kind] = left.get((m, kind), 1.0) * (1 - t)
        score = {s: 1.0 for s in seeds} | {k: 1 - v for k, v in left.items() if k not in seeds}
    known = {m for m, _ in seeds}
    want = {}
    for (m, kind), s in score.items():
        if m not in known and s >= private_data.CONFIDENT:
            rank = private_data.ALL_KINDS.index(kind)
            want[m] = max(want.get(m, (0, -9, "")), (round(s, 9), -rank, kind))
    named, patterns = private_data.discovered(spans)
    assert {r.m: r.kind for r in named.collect()} == {m: w[2] for m, w in want.items()} and want
    got = {(r.pattern, r.kind): r.trust for r in patterns.collect()}
    assert got.keys() == trust.keys() and all(abs(got[k] - trust[k]) < 1e-9 for k in got)
