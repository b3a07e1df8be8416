from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.conftest import SMALL
from tests.llm import edges
from tidelane.llm import personal_data as p
from tidelane.llm import queries

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(x) <= 255 for x in found.split("."))
    if kind == 2:
        doubled = [int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 8 <= len(digits) <= 15


def base(text):
    return [
        (kind, m.start(), m.end()) for kind, pattern in enumerate(PATTERNS) for m in re.finditer(pattern, text) if valid(kind, m[0])
    ]


def said(spans):
    names = ["email", "ip", "card", "phone", "context_email", "context_ip", "context_card", "context_phone"]
    return ",".join(f"{names[k]}:{a}:{b}" for k, a, b in sorted(spans))


def plain(texts):
    """Spans of each text, base and bootstrapped, with loops over sets."""
    seeds, unknown, places = {}, {}, []
    for text in set(texts):
        for m in p.mentions(text, base(text)):
            for pattern in m["patterns"]:
                (unknown if m["kind"] < 0 else seeds).setdefault(pattern, set()).add((m["kind"], m["instance"]))
            if m["kind"] < 0:
                places.append((text, m["instance"], m["start"], m["stop"]))
    accepted = {}
    for _ in range(3):
        votes = {}
        for pattern, instances in unknown.items():
            known = seeds.get(pattern, set())
            for kind in range(4):
                support = 1_000_000 * sum(k == kind for k, _ in known)
                support += sum(accepted[i][1] for _, i in instances if i in accepted and accepted[i][0] == kind)
                weight = support // (len(known) + len(instances))
                if known and support >= 3_000_000 and weight >= 500_000:
                    for _, i in instances:
                        votes.setdefault(i, {}).setdefault(kind, []).append(weight)
        accepted = {}
        for i, kinds in votes.items():
            best = min((-len(w), -(sum(w) // len(w)), kind) for kind, w in kinds.items() if len(w) >= 2) if any(
                len(w) >= 2 for w in kinds.values()
            ) else None
            if best:
                accepted[i] = best[2], -best[1]
    added = {}
    for text, i, a, b in places:
        if i in accepted:
            added.setdefault(text, set()).add((4 + accepted[i][0], a, b))
    return {t: (said(base(t)), said([*base(t), *added.get(t, ())])) for t in texts}


def test_base_spans_as_the_patterns_find_them():
    rng = random.Random(4)
    bits = ["a@b.c", "@", ".", "1.2.3.4", "255", "256", "+1 (", ") ", "-", " ", "4111111111111111", "x", "%", "0", "é", "555-01", "٣", "@-.", "1.2.3", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert p.base_spans(text) == base(text), repr(text)
    for text in ["1" * 30_000, "a" * 30_000, "1.2.3.4." * 3000, "a@" * 9000, "+" * 9000, "a@b." * 5000, "+1 ( " * 4000, "1 - " * 5000]:
        assert p.base_spans(text) == base(text[:2000]) or len(text) > 2000


def calls(rng):
    number = lambda: "+1 (%03d) 555-%04d" % (rng.randint(200, 999), rng.randint(0, 9999))
    bare = lambda: "555-%03d-%04d" % (rng.randint(200, 999), rng.randint(0, 9999))
    rows = [f"please call me at {number()} after lunch today" for _ in range(8)]
    rows += [f"please call me at {bare()} after lunch today" for _ in range(4)]
    rows += [f"the order number was {bare()} and nothing else {k}" for k in range(6)]  # no seed has this context
    rows += [f"write to us via user{k}@mail.example.com before noon ok" for k in range(5)]
    rows += ["write to us via root@localhost before noon ok"] * 3
    return rows


def test_bootstrapping_finds_identifiers_in_known_contexts_only(spark):
    texts = calls(random.Random(1))
    got = p.personal_data(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    rows = {r.doc_id: r for r in got.collect()}
    assert {k: (r.base_spans, r.spans) for k, r in rows.items()} == {k: plain(texts)[t] for k, t in enumerate(texts)}
    for k, text in enumerate(texts):
        found = [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in rows[k].spans.split(",") if s)]
        hidden = re.search("555-[0-9]{3}-[0-9]{4}|root@localhost", text)
        assert found == ([] if "order number" in text else [hidden[0] if hidden else re.search(r"\+1 \S+ \S+|user\S+", text)[0]])


def test_rounds_spread_to_new_contexts(spark):
    numbers = [f"555-01{k}-4444" for k in range(10, 16)]
    texts = [f"please call me at +1 (555) 010-{k:04d} after lunch" for k in range(9)]
    texts += [f"please call me at {x} after lunch" for x in numbers]
    texts += [f"my office line is {x} every day" for x in numbers]
    texts += ["my office line is 555-999-1234 every day"]  # only numbers accepted before share its context
    texts += ["my office line is +1 (555) 010-0001 every day"]
    got = p.personal_data(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in got.collect()}
    assert found == {k: plain(texts)[t][1] for k, t in enumerate(texts)}
    assert found[len(texts) - 2] == "context_phone:18:30"
    first = p.personal_data(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"), rounds=1)
    assert {r.doc_id: r.spans for r in first.collect()}[len(texts) - 2] == ""


@pytest.mark.parametrize("rows", [edges.documents, edges.empty])
def test_awkward_rows(spark, rows):
    docs = rows(spark)
    names = ["row", "key", "base", "added", "mentions", "salt", "instance", "n", "pattern", "n_email", "_", "__", "kind"]
    for name in names:
        docs = docs.withColumn(name, docs["n_chars"])
    out = p.personal_data(docs)
    assert set(out.columns) == (set(docs.columns) - {"text"}) | {"n_email", "n_ip", "n_card", "n_phone", "n_context", "base_spans", "spans"}
    given = sorted((str(r.doc_id), r.n_chars, *plain([r.text or ""])[r.text or ""]) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_chars, r.base_spans, r.spans) for r in out.collect()) == given
    kept = [n for n in names if n != "n_email"]
    assert all(r[n] == r.n_chars for r in out.collect() for n in kept)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = plain([t or "" for t in texts.values()])
    for r in queries.op12_personal_data(spark, SMALL).collect():
        first, every = want[texts[r.doc_id] or ""]
        assert r.base_sha256 == hashlib.sha256(first.encode()).hexdigest() and r.spans == every
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [first.count(f"{k}:") for k in ("email", "ip", "card", "phone")]
