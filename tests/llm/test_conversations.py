from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidelane.llm import conversation_repair as repair
from tidelane.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, blank int, present string, audit string, `_row` int"


def faults(rows):
    """(blank, duplicate, truncated) of each (role, text), the first that holds."""
    seen, out = set(), []
    for role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        marks = (not said, (role, text) in seen, said[-1:] not in (".", "!", "?"))
        seen.add((role, text))
        first = marks.index(True) if True in marks else None
        out.append(tuple(k == first for k in range(3)))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by trying edits in order of cost and then string."""
    marks = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        state = "" if not roles else roles[-1]
        if at == len(rows) and state in ("", "a"):
            return cost, audit, list(lines)
        if (at, state) in done:  # a later one is dearer or comes later
            continue
        done.add((at, state))

        def go(price, letter, step, role=None, text=""):
            if role is None:
                heapq.heappush(heap, (cost + price, audit + letter, at + step, roles, lines))
            elif role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and role:
                heapq.heappush(heap, (cost + price, audit + letter, at + step, roles + role[:1], (*lines, f"{role}:{text}")))

        for role in ("user", "assistant"):
            go(3, "I", 0, role)
        if at < len(rows):
            (role, text), (blank, copy, cut) = rows[at], marks[at]
            go(4, "D", 1)
            if not blank and not copy:
                go(3 * cut, "K", 1, role, text)
                for other in ("user", "assistant"):
                    go(3 + 3 * cut, "R", 1, other, text)
    raise AssertionError


def plain(rows):
    """The result columns of one conversation's (turn, role, text) in order."""
    said = [(r, t) for _, r, t in rows]
    marks, turns = faults(said), [t for t, _, _ in rows if t is not None]
    cost, audit, lines = cheapest(said)
    initials = [r[:1] for r, _ in said]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(m[k] for m in marks) for k in range(3)],
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def made(rng, n):
    roles = ["user", "assistant", "system", "tool", " ", "", "admin"]
    texts = ["a.", "b!", "c", "", " \n", "é? ", "a.\x0b", "x"]
    return [(rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("settings", [{}, {"most_nodes": 8}, {"modulus": 1}, {"modulus": 3, "most_nodes": 16}])
def test_cheapest_least_audit(settings):
    """Also with trees cut early, and with hashes that collide always or often."""
    rng = random.Random(5)
    for n in [*range(12), *[9] * 60, 40]:
        rows = made(rng, n)
        one = repair.Conversation(**settings)
        for k, ((role, text), marks) in enumerate(zip(rows, faults(rows))):
            one.add(k, role, text, *marks)
        assert one.result() == plain([(k, *row) for k, row in enumerate(rows)]), rows


def test_strings_compare_as_strings():
    rng = random.Random(6)
    for modulus in (1, 5, (1 << 61) - 1):
        tree, nodes, known = repair.Audits(modulus), [0], {0: ""}
        for _ in range(300):
            parent, letter = rng.choice(nodes), rng.choice("DK")
            nodes.append(tree.add(parent, letter))
            known[nodes[-1]] = known[parent] + letter
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert tree.less(a, b) == (known[a] < known[b]) and tree.string(a) == known[a]


def test_a_long_conversation_keeps_a_small_tree():
    one = repair.Conversation(most_nodes=1000)
    for k in range(20_000):
        one.add(k, ("user", "assistant")[k % 2], f"{k}.", False, False, k % 7 == 0)
        assert len(one.tree.up) <= 1100
    result = one.result()
    assert result[3] == 2858 and len(result[6]) >= 20_000


def turns(spark):
    rows = [
        (1, 0, "user", "hi."),
        (1, 0, "user", "hi."),  # repeated row
        (1, 4, "assistant", "yes"),
        (2, None, None, None),
        (2, None, "user", "x."),
        (2, 3, "assistant", "y."),
        (3, 1, "system", ""),
        (None, 1, "user", "no id."),
        (None, 2, "assistant", "none."),
        (4, 5, "assistant", "long " * 60_000),
        (5, -9_000_000_000_000_000_000, "user", "a."),
        (5, 9_000_000_000_000_000_000, "assistant", "b."),
    ]
    return spark.createDataFrame([(*r, 7, "no", "x", 1) for r in rows], SCHEMA)


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.conv_id, []).append((r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text))
    least = -(1 << 63)
    return {k: sorted(v, key=lambda r: (least if r[0] is None else r[0], r[1], r[2])) for k, v in out.items()}


def test_awkward_rows(spark):
    docs = turns(spark)
    audits = repair.audit_conversations(docs)
    got = {r[0]: tuple(r)[1:] for r in audits.collect()}
    want = {k: plain(v) for k, v in grouped(docs.collect()).items()}
    want[5] = ((1 << 63) - 1, *want[5][1:])  # more than a long holds
    assert got == want
    lines = {}
    for r in repair.repaired_turns(docs, audits).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in got.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


def test_empty_tables_and_absent_turns(spark):
    assert repair.audit_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = repair.audit_conversations(turns(spark), F.lit(False)).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 6 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", nothing) for r in rows)


def test_one_shuffle(spark, capsys):
    repair.audit_conversations(turns(spark)).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_damage_and_repair_of_the_table(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = {}
    for r in given.collect():
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: r.text.translate(str.maketrans("", "", ".!?"))}.get(kind, r.text)
        put = rows.setdefault(r.conv_id, [])
        put += [(r.turn, "user" if kind == 4 else r.role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, SMALL).collect()}
    assert got == {k: plain(sorted(v)) for k, v in rows.items()}
