from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import edges
from tidelane.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top=2000, longest=4, inside=80):
    """(lang, rank, phrase, a, l, r, n, score) by counting tuples."""
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, *words[i : i + size]] += 1
    frequent = {k: v for k, v in counts.items() if v >= least}
    dropped = set()
    for (lang, *words), f in frequent.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, *words[i : i + size])
                if 100 * f >= inside * counts[part]:
                    dropped.add(part)
    out = {}
    for (lang, *words), a in frequent.items():
        if len(words) > 1 and (lang, *words) not in dropped:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, size):
    rng = random.Random(seed)
    words = ["a", "B", "cc", "é", "漢", "d\u0085", " ", "x\x00y", "Zz", "longerword"]
    marks = [" "] * 12 + ["\t", ". ", ",", "\n", " \x0b", ";;", "  "]
    text = lambda: "".join(rng.choice(words[: rng.choice([3, 10])]) + rng.choice(marks) for _ in range(rng.randint(0, 40)))
    return [(rng.choice(["en", "fr", None, "und", "", "x y"]), text()) for _ in range(size)]


@pytest.mark.parametrize("least,top", [(2, 2000), (5, 3)])
def test_as_counted_plainly(spark, least, top):
    rows = corpus(least, 300) + [("en", "of the time of the time") for _ in range(50)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = c.collocations(docs, least=least, top=top, shard=1500, ranges=5)
    assert sorted(map(tuple, got.collect())) == plain(rows, least, top)


def test_other_lengths(spark):
    rows = corpus(9, 200)
    docs = spark.createDataFrame(rows, "lang string, text string")
    for longest in (2, 3, 5):
        got = c.collocations(docs, least=3, longest=longest)
        assert sorted(map(tuple, got.collect())) == plain(rows, 3, longest=longest)


def test_union_and_composition():
    rng = np.random.default_rng(3)
    total, parts = Counter(), []
    for _ in range(6):
        labels = sorted({"de", "en", *rng.choice(list("abcdefgh"), 5).tolist()})
        langs = [labels.index("de"), labels.index("en")]
        grams = Counter((int(rng.choice(langs)), *rng.integers(len(labels), size=3).tolist()) for _ in range(80))
        keys = sorted(grams)
        paths = [np.array(x) for x in zip(*keys)]
        made = c.Transducer(pa.array(labels), paths, np.array([grams[k] for k in keys]))
        again = c.Transducer.unpacked(made.packed())
        assert again.labels.take(pa.array(again.paths[3])).to_pylist() == [labels[k[3]] for k in keys]
        assert again.weights.tolist() == made.weights.tolist()
        parts.append(again)
        for k, v in grams.items():
            total[labels[k[0]], " ".join(labels[x] for x in k[1:])] += v
    whole = c.Transducer.union(parts)
    lang, phrase = whole.phrases()
    keys = list(zip(lang.to_pylist(), phrase.to_pylist()))
    assert dict(zip(keys, whole.weights.tolist())) == total
    assert [tuple([a, *b.split(" ")]) for a, b in keys] == sorted(tuple([a, *b.split(" ")]) for a, b in keys)
    asked = [*total, ("en", "a a zz"), ("xx", "a b c"), ("en", "h h h")]
    weights = whole.composed(pa.array([a for a, _ in asked]), pa.array([b for _, b in asked]))
    assert weights.tolist() == [total[k] for k in asked]


def test_blocks_end_after_pieces():
    text = ("word " * 50 + ". ") * 40 + "end" * 400
    data = np.frombuffer(("x y" + text + "tail. z").encode(), np.uint8)
    rows = np.array([0, 3, 3, 3 + len(text), len(data)])
    cuts = list(c._blocks(data, rows, 100))
    assert [a for a, _ in cuts[1:]] == [b for _, b in cuts[:-1]] and cuts[-1][1] == len(data)
    assert len(cuts) > 30
    for _, b in cuts[:-1]:
        assert b in rows or chr(data[b - 1]) in ".,;:!?"


@pytest.mark.parametrize("rows", [edges.documents, edges.empty])
def test_awkward_rows(spark, rows):
    docs = rows(spark)
    got = c.collocations(docs, least=2)
    assert sorted(map(tuple, got.collect())) == plain([(r.lang, r.text) for r in docs.collect()], 2)
