from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import edges
from tidelane.llm import ann, graph, ngram_join

LARGE = "/root/testdata/sf0.1"

def query():
    return F.col("vec_id") % 50 == 0


def brute(ids: np.ndarray, vectors: np.ndarray, k: int = 5) -> dict[int, list[int]]:
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = np.round(unit @ unit[i], 12)
        score[i] = -9
        out[int(ids[i])] = ids[np.lexsort((ids, -score))[:k]].tolist()
    return out


@pytest.mark.parametrize("folder", [SMALL, LARGE])
def test_recall(spark, folder):
    if not os.path.isdir(folder):
        pytest.skip("needs the test tables")
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    frame = table.select("vec_id", "embedding").toPandas()
    true = brute(frame.vec_id.to_numpy(), np.stack(frame.embedding).astype(float))
    found: dict[int, list] = {}
    for r in ann.nearest_neighbours(table, query()).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(true) and all(sorted(r["rank"] for r in x) == [1, 2, 3, 4, 5] for x in found.values())
    hits = sum(len(set(true[q]) & {r.vec_id for r in x}) for q, x in found.items())
    assert hits >= 0.95 * 5 * len(true)


def test_copies_ties_and_unfit_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 60)]  # many copies
    rows += [(100 + i, rng.standard_normal(3).tolist()) for i in range(20)]
    unfit = [(500, None), (550, [0.0, 0.0, 0.0]), (600, [1.0, None, 2.0]), (650, [1.0, float("nan"), 0.0]),
             (700, [float("inf"), 1.0, 1.0]), (750, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows + unfit, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = ann.nearest_neighbours(table, query(), ann.Settings(part=4, asked=2))
    by_query: dict[int, list] = {}
    for r in got.orderBy("query_id", "rank").collect():
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    assert by_query[0] == [1, 2, 3, 4, 5] and by_query[50] == [0, 1, 2, 3, 4]
    assert set(by_query) == {0, 50, 100}


def test_few_and_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, 1.0])], schema)
    rows = ann.nearest_neighbours(three, query()).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest_neighbours(three.limit(0), query()).count() == 0
    assert ann.nearest_neighbours(three.limit(1), query()).count() == 0


def clustered(n: int, width: int = 32) -> np.ndarray:
    """Clusters of about 20 vectors around centres far from one another."""
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((max(1, n // 20), width))
    return centres[rng.integers(len(centres), size=n)] + 0.12 * rng.standard_normal((n, width))


def coded(spark, vectors: np.ndarray, codes: ann.Codes):
    rows = zip(range(len(vectors)), [[i] for i in range(len(vectors))], vectors.tolist(), codes.packed(vectors).astype(np.int64).tolist())
    return spark.createDataFrame(list(rows), "entry long, ids array<long>, vector array<double>, code long")


@pytest.mark.parametrize("radius", [0, 5, 13, 20])
def test_probing_finds_exactly_the_codes_within_the_radius(spark, radius):
    vectors = clustered(1500)
    codes = ann.learn(vectors[:500], ann.Settings())
    entries = coded(spark, vectors, codes)
    queries = entries.filter("entry % 50 = 0").select(F.col("entry").alias("query_id"), "vector", "code")
    got = {(r.query_id, r.entry) for r in ann.candidates(entries, queries, radius, 1500, codes, ann.Settings()).collect()}
    packed = codes.packed(vectors)
    apart = np.bitwise_count(packed[::50, None] ^ packed[None, :])
    assert got == {(int(q) * 50, int(v)) for q, v in zip(*np.nonzero(apart <= radius))}


def test_clustered_vectors_are_pruned_and_the_rows_made_grow_with_the_queries(spark):
    shares, rows = [], []
    for n in (1_000, 30_000):
        vectors = clustered(n)
        table = spark.createDataFrame(list(zip(range(n), vectors.tolist())), "vec_id long, embedding array<double>")
        codes = ann.learn(vectors[:4000], ann.Settings())
        used = ann.probing_radii(codes.radius, n, codes.bits, ann.Settings())
        assert used
        entries = coded(spark, vectors, codes)
        queries = entries.filter("entry % 50 = 0").select(F.col("entry").alias("query_id"), "vector", "code")
        met = ann.candidates(entries, queries, used[-1], n, codes, ann.Settings()).count()
        shares.append(met / (n * (n // 50)))
        rows.append(met / (n // 50))
        true = brute(np.arange(n), vectors)
        found: dict[int, set] = {}
        for r in ann.nearest_neighbours(table, query()).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        hits = sum(len(set(true[q]) & found[q]) for q in true)
        assert hits >= 0.95 * 5 * len(true)
    assert max(shares) < 1 / 3 and rows[1] <= 1.5 * rows[0]


@pytest.mark.parametrize("radius", [0, 3, 7, 8, 9, 20, 63, 64])
def test_probing_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    reach = ann.substring_radii(radius, 64, 8)
    for _ in range(500):
        flips = np.zeros(64, bool)
        flips[rng.choice(64, min(radius, 64), replace=False)] = True
        assert any(flips[8 * j : 8 * j + 8].sum() <= r for j, r in enumerate(reach))


def near_copies(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    texts = []
    for _ in range(n):
        base = [word() for _ in range(rng.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 3, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def classes(texts: list[str]) -> dict[int, tuple[int, int]]:
    """Class and number of links of each text by its place."""
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [set() for _ in texts]
    for i in range(len(texts)):
        for j in range(i):
            same = texts[i] == texts[j]
            if same or (sets[i] | sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
                if not same:
                    links[i].add(texts[j])
                    links[j].add(texts[i])
    return {i: (find(i), len(links[i])) for i in range(len(texts))}


@pytest.mark.parametrize("settings", [ngram_join.Settings(), ngram_join.Settings(prefix_block=4, group_block=3)])
def test_join_as_all_pairs(spark, settings):
    texts = near_copies(40, 11)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(docs, settings).collect()}
    assert got == classes(texts)
    kept = [r.doc_id for r in ngram_join.near_copies_removed(docs, settings).collect()]
    assert sorted(kept) == sorted({c for c, _ in classes(texts).values()})


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(kind)
    pairs = {
        "path": [(i, i + 1) for i in range(300) if i % 100 != 99],
        "star": [(500, i) for i in range(200)] + [(501, 502)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(220)],
        "none": [],
    }[kind]
    rng.shuffle(pairs)
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root} and len(got) == len(root)


def test_target_recall_shortens_the_prefix():
    settings = ngram_join.Settings()
    depth = lambda agree, at=8: ngram_join.next_depth(agree, at, settings)
    assert depth({}) == 4  # nothing found: as for links of the least similarity
    assert depth({128: 1000}) == 8 and depth({125: 1000}) == 8  # copies are found by their leaves
    assert depth({128: 1000, 110: 10}) == 6  # each band of similarity counts, also beside many copies
    assert depth({103: 50}) == 4 and depth({90: 50}) == 4  # less than the least counts as that
    assert depth({103: 50}, 4) == 4  # enough
    found = ngram_join.found_share(np.array([0.8]), np.arange(1, 9), settings)
    assert (np.diff(found) < 0).all() and found[3] > settings.recall > found[4]


def test_shorter_prefixes_find_what_leaves_miss(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts = []
    for _ in range(150):  # pairs of a similarity little above the least
        base = [word() for _ in range(300)]
        other = list(base)
        for _ in range(6):
            other[rng.randrange(300)] = word()
        texts += [" ".join(base), " ".join(other)]
    docs = spark.createDataFrame(list(enumerate(texts)), "_rep long, text string")
    reps = ngram_join.signed(docs, ngram_join.Settings()).cache()
    close = {tuple(sorted(r)) for r in ngram_join.leaf_edges(ngram_join.leaves(reps, ngram_join.Settings()), reps, ngram_join.Settings()).select("a", "b").collect()}
    groups = ngram_join.close_groups(reps, ngram_join.Settings()).collect()
    members = {r.node: r.root for r in groups}
    want = classes(texts)
    linked = [i for i in range(0, len(texts), 2) if want[i][0] == want[i + 1][0]]
    assert len(linked) > 100
    assert sum((i, i + 1) not in close for i in linked) > 0  # the leaves alone are not enough
    assert all(members[i] == members[i + 1] for i in linked)


def all_links(texts: list[str], words: int = 5, similarity: float = 0.8) -> set[tuple[int, int]]:
    """Links between different texts: rare n-grams first, texts that share one of their first are compared."""
    sets = []
    for t in texts:
        w = t.split()
        sets.append(frozenset(hash(tuple(w[i : i + words])) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    count = Counter(g for s in sets for g in s)
    index, links = {}, set()
    for i in sorted(range(len(texts)), key=lambda i: len(sets[i])):
        own = sets[i]
        first = sorted(own, key=lambda g: (count[g], g))[: len(own) - int(np.ceil(similarity * len(own))) + 1]
        for j in {j for g in first for j in index.get(g, ())}:
            both = len(own & sets[j])
            if both >= similarity * (len(own) + len(sets[j]) - both) - 1e-9:
                links.add((min(i, j), max(i, j)))
        for g in first:
            index.setdefault(g, []).append(i)
    return links


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="needs the test tables")
def test_recall_against_all_pairs_of_a_large_table(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    rows = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(docs.select("doc_id", "text")).collect()}
    by_text = {}
    for r in docs.select("doc_id", "text").collect():
        by_text.setdefault(r.text, []).append(r.doc_id)
    texts = list(by_text)
    links = all_links(texts)
    assert len(links) > 40
    found = [(i, j) for i, j in links if rows[by_text[texts[i]][0]][0] == rows[by_text[texts[j]][0]][0]]
    assert len(found) >= 0.99 * len(links)
    degree = Counter(x for link in found for x in link)
    for i, text in enumerate(texts):
        for doc in by_text[text]:
            assert rows[doc][1] == degree[i]


def test_rows_shuffled_grow_with_the_texts(spark):
    """Also where a fifth of all texts are near copies of one another."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))

    def shuffled(n: int) -> int:
        base = [word() for _ in range(80)]
        texts = []
        for k in range(n):
            text = list(base) if k % 5 == 0 else [word() for _ in range(80)]
            if k % 5 == 0:
                text[rng.randrange(80)] = word()
            texts.append(" ".join(text))
        docs = spark.createDataFrame(list(enumerate(texts)), "_rep long, text string").repartition(8)
        settings = ngram_join.Settings()
        reps = ngram_join.signed(docs, settings).cache()
        entries = ngram_join.leaves(reps, settings)
        edges = ngram_join.leaf_edges(entries, reps, settings).cache()
        groups = graph.near_roots(edges)
        assert edges.count() < settings.trees * n
        depth = ngram_join.next_depth({r.agree: r["count"] for r in edges.groupBy("agree").count().collect()}, 8, settings)
        # one part holds nearly all copies, so their nodes need not be opened
        again = ngram_join.node_edges(entries, reps, groups, depth, settings)
        assert again.count() < 0.1 * n
        return entries.count() + edges.count() + again.count()

    small, large = shuffled(1000), shuffled(4000)
    assert large <= 1.1 * 4 * small


def test_join_on_awkward_rows(spark):
    docs = edges.documents(spark)
    joined = ngram_join.ngram_join(docs)
    assert joined.count() == docs.count() and joined.columns.count("n_links") == 1
    by_id = {r.doc_id: r for r in joined.filter("doc_id is not null").collect()}
    assert by_id[1].class_id == by_id[2].class_id == by_id[3].class_id == 1 and by_id[1].n_links == 1
    assert by_id[4].class_id == by_id[5].class_id == 4 and by_id[6].class_id == 6
    assert by_id[9].class_id == by_id[10].class_id == 9  # the same words
    kept = ngram_join.near_copies_removed(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 6, 7, 8, 9] and ids.count(None) == 1
    assert ngram_join.ngram_join(edges.empty(spark)).count() == 0
