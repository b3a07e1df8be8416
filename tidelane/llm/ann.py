"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: vectors are centred, projected on their principal directions, turned by a rotation learned so that signs lose
little, and cut to one bit per direction; direction and rotation come from a bounded sample. Index: a code is
split into substrings of about ``log2`` of the number of vectors bits, and every code is listed under each of them. Search: if two
codes differ in at most ``R`` bits, then in some substring they differ in at most ``R // m`` (one less in the later ones once the
rest is spent), so probing those values of each substring finds every code within ``R``. What is found is ranked
by the cosine of the original vectors, in double precision.

The radius is raised step by step. A query is done when all of its nearest found are nearer than any pair of the sample whose codes differ in more
than the radius; there are some million such pairs. The last radius is the distance within which the
sample's own true neighbours lie, by the quantile ``Settings.inside``; neighbours in
the whole table are nearer than those in a sample, so it errs to the safe side. A step whose probes
would meet more than ``Settings.share`` of the vectors, or be more than ``Settings.probes``, costs what it saves; one scan of all codes takes
the place of the last one then (isotropic vectors come to that). A query with too few found is scanned for within all bits.

Layout: the index holds codes of eight bytes. Query probes and codes meet by substring and value, pairs
found in several substrings are made one, and only then vectors are joined. In a scan, vectors are dealt in parts of bounded
size and queries in blocks, a task per part and block returning the few best per query. Copies of a vector are one entry
with its smallest ids, as many as can matter.

Vectors that are null, zero, of another length than most of the table, or hold null or non-finite components take no
part, nor do null ids. Ties go to the smaller id; rows that repeat an id count once. Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.functions.lineage import settle
from tidelane.llm.frames import small_batches


@dataclass(frozen=True)
class Settings:
    nearest: int = 5
    #: vectors that the codes are learned from
    sample: int = 4_000
    #: bits of a code at most, and of a substring at least and at most
    bits: int = 64
    narrow: int = 8
    wide: int = 24
    #: share of the sample's true neighbours that must lie within the last radius
    inside: float = 0.98
    #: most vectors that probing may meet, and most values that a query may probe, so that the rows made grow with the queries
    share: float = 1 / 3
    probes: int = 1024
    #: the radii as shares of the last one
    steps: tuple[float, ...] = (0.25, 0.5, 0.75, 1)
    rotations: int = 30
    #: vectors of a part and queries of a block of a scan
    part: int = 8_192
    asked: int = 16_384
    seed: int = 17


@dataclass(frozen=True)
class Codes:
    """Learned code: bit ``i`` of ``x`` is the sign of ``((x / |x|) - mean) @ turn[:, i]``. ``bounds[r]`` is the largest
    cosine of pairs of the sample whose codes differ in more than ``r`` bits."""

    mean: np.ndarray
    turn: np.ndarray
    radius: int
    bounds: tuple[float, ...] = ()

    @property
    def bits(self) -> int:
        return self.turn.shape[1]

    def of(self, unit: np.ndarray) -> np.ndarray:
        """Codes of unit vectors as bits, one row each."""
        return ((unit - self.mean) @ self.turn) > 0

    def packed(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of vectors as whole numbers, first bit highest."""
        return _packed(self.of(unit_rows(vectors)))


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers and not all are zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaled by the largest component first, so squares do not overflow."""
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of each query with the vector in the same row, in double precision and independent of
    the other rows."""
    q, v = np.asarray(queries, np.float64), np.asarray(vectors, np.float64)
    q = q / np.abs(q).max(axis=1, keepdims=True)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (q * v).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))


def learn(sample: np.ndarray, settings: Settings) -> Codes:
    """Iterative quantisation of the sample, and the radius that holds its true neighbours."""
    unit = unit_rows(sample)
    n, width = unit.shape
    bits = max(1, min(settings.bits, width))
    mean = unit.mean(axis=0)
    centred = unit - mean
    _, directions = np.linalg.eigh(centred.T @ centred)
    basis = directions[:, ::-1][:, :bits]
    projected = centred @ basis
    rng = np.random.default_rng(settings.seed)
    turn, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    for _ in range(settings.rotations):
        signs = np.where(projected @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        turn = (left @ right).T
    codes = Codes(mean, basis @ turn, bits, (2.0,) * (bits + 1))  # no cosine is that large
    near = min(settings.nearest, n - 1)
    if near < 1:
        return codes
    asked = np.arange(min(n, 1000))
    closeness = unit[asked] @ unit.T
    closeness[asked, asked] = -2
    best = np.argpartition(-closeness, near - 1, axis=1)[:, :near]
    signs = np.where(codes.of(unit), 1.0, -1.0)
    apart = (bits - signs[asked] @ signs.T) / 2
    radius = int(np.ceil(np.quantile(np.take_along_axis(apart, best, 1), settings.inside)))
    nearest_at = np.full(bits + 1, -1.0)
    np.maximum.at(nearest_at, apart.astype(int).ravel(), closeness.ravel())
    beyond = np.maximum.accumulate(nearest_at[::-1])[::-1]
    return Codes(mean, codes.turn, radius, (*beyond[1:].tolist(), -1.0))


def substring_radii(radius: int, bits: int, width: int) -> list[int]:
    """Most differing bits to probe per substring; -1 where none is needed. With ``m`` substrings and
    ``R = m * r + a``, one of the first ``a + 1`` differs in at most ``r`` bits or one of the others
    in at most ``r - 1``."""
    m = -(-bits // width)
    r, a = divmod(radius, m)
    return [r if j <= a else r - 1 for j in range(m)]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as whole numbers, first bit highest."""
    weights = np.left_shift(np.uint64(1), np.arange(bits.shape[1], dtype=np.uint64)[::-1])
    return (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


def substring_width(n: int, bits: int, settings: Settings) -> int:
    """About as many values as there are codes, so a value's list is short."""
    return min(bits, settings.wide, max(settings.narrow, int(np.ceil(np.log2(max(n, 2))))))


def masks(width: int, reach: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``reach`` set."""
    found = [0] if reach >= 0 else []
    for k in range(1, min(reach, width) + 1):
        found += [sum(1 << i for i in chosen) for chosen in combinations(range(width), k)]
    return np.array(found, np.uint64)


def substrings(bits: int, width: int) -> list[tuple[int, int]]:
    """(bits to the right, width) of each substring of a code."""
    return [(bits - min(s + width, bits), min(s + width, bits) - s) for s in range(0, bits, width)]


def probe_cost(radius: int, bits: int, width: int) -> tuple[float, int]:
    """Share of all values that probing meets, summed over the substrings, which is that of evenly spread vectors met, and the number
    of values probed."""
    parts = zip(substrings(bits, width), substring_radii(radius, bits, width), strict=True)
    values = [(sum(comb(w, k) for k in range(r + 1)), w) for (_, w), r in parts]
    return sum(v / (1 << w) for v, w in values), sum(v for v, _ in values)


def probing_radii(radius: int, n: int, bits: int, settings: Settings) -> list[int]:
    """The steps up to a radius at which probing is worth it among ``n`` codes."""
    width = substring_width(n, bits, settings)
    costs = {r: probe_cost(r, bits, width) for r in sorted({int(radius * step) for step in settings.steps})}
    return [r for r, (share, probes) in costs.items() if share <= settings.share and probes <= settings.probes]


def search_part(queries: pd.DataFrame, vectors: pd.DataFrame, codes: Codes, settings: Settings) -> pd.DataFrame:
    """The best found of one part for each of its queries: pairs whose codes are within the query's
    radius are ranked by cosine, and those that are, or tie with, the nearest ones are returned."""
    q, v = np.stack(queries["vector"]).astype(np.float64), np.stack(vectors["vector"]).astype(np.float64)
    uq, uv = unit_rows(q), unit_rows(v)
    cq, cv = _packed(codes.of(uq)), _packed(codes.of(uv))
    ids, radius = vectors["ids"].to_list(), queries["radius"].to_numpy()
    names, out = queries["query_id"].to_numpy(), []
    step = max(1, (1 << 21) // max(len(v), 1))
    for a in range(0, len(q), step):
        b = min(a + step, len(q))
        near = np.bitwise_count(cq[a:b, None] ^ cv[None, :]) <= radius[a:b, None]
        closeness = np.where(near, uq[a:b] @ uv.T, -np.inf)
        # the query's own vector may be among them, so one more than asked for
        k = min(settings.nearest + 1, len(v))
        floor = -np.partition(-closeness, k - 1, axis=1)[:, k - 1 : k]
        row, col = np.nonzero(near & (closeness >= floor - 1e-9))
        by_query: dict[int, list] = {}
        for i, c, x in zip((a + row).tolist(), col.tolist(), cosines(q[a + row], v[col]).tolist(), strict=True):
            by_query.setdefault(i, []).extend((-x, vec, x) for vec in ids[c] if vec != names[i])
        for i, best in by_query.items():
            out += [(names[i], vec, x) for _, vec, x in sorted(best)[: settings.nearest]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _top(found: DataFrame, settings: Settings) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.nearest)


def scanned(entries: DataFrame, queries: DataFrame, radius: int, sizes: tuple[int, int], codes: Codes, settings: Settings) -> DataFrame:
    """Top rows per query (``query_id``, ``vec_id``, ``score``, ``rank``) from one scan of all vectors in parts; ``sizes`` are the
    numbers of entries and queries."""
    parts, blocks = (max(1, -(-n // most)) for n, most in zip(sizes, (settings.part, settings.asked)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = queries.select("query_id", "vector", F.lit(radius).alias("radius"), dealt("query_id", blocks).alias("block"), every(parts).alias("part"))
    right = entries.select("ids", "vector", dealt("entry", parts).alias("part"), every(blocks).alias("block"))

    def joined(key: tuple, asked: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(vectors):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search_part(asked, vectors, codes, settings)

    found = (
        left.groupBy("part", "block")
        .cogroup(right.groupBy("part", "block"))
        .applyInPandas(joined, "query_id long, vec_id long, score double")
    )
    return _top(found, settings)


def candidates(entries: DataFrame, queries: DataFrame, radius: int, n: int, codes: Codes, settings: Settings) -> DataFrame:
    """Pairs ``query_id``-``entry``, each once, whose codes differ in at most ``radius`` bits, by probing the substrings."""
    width = substring_width(n, codes.bits, settings)
    cuts = substrings(codes.bits, width)
    reach = substring_radii(radius, codes.bits, width)
    value = lambda code, right, w: F.shiftrightunsigned(code, right).bitwiseAND(F.lit((1 << w) - 1))
    listed = F.array(
        *[F.struct(F.lit(j).alias("substring"), value(F.col("code"), right, w).alias("value")) for j, (right, w) in enumerate(cuts)]
    )
    index = entries.select("entry", "code", F.inline(listed))

    def probing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flips = [masks(w, r) for (_, w), r in zip(cuts, reach, strict=True)]
        for frame in frames:
            for query_id, code in zip(frame["query_id"].tolist(), frame["asked"].tolist()):
                whole = np.uint64(code & ((1 << 64) - 1))
                for j, (right, w) in enumerate(cuts):
                    own = (whole >> np.uint64(right)) & np.uint64((1 << w) - 1)
                    yield pd.DataFrame(
                        {"query_id": query_id, "asked": code, "substring": j, "value": (flips[j] ^ own).astype(np.int64)}
                    )

    probes = queries.select("query_id", F.col("code").alias("asked")).mapInPandas(probing, "query_id long, asked long, substring int, value long")
    met = probes.join(index, ["substring", "value"])
    within = F.bit_count(F.col("asked").bitwiseXOR(F.col("code"))) <= radius
    return met.filter(within).select("query_id", "entry").distinct()


def probed(entries: DataFrame, queries: DataFrame, radius: int, n: int, codes: Codes, settings: Settings) -> DataFrame:
    """Top rows per query as ``scanned`` gives them, by way of the index: vectors are joined for what was found only."""
    pairs = candidates(entries, queries, radius, n, codes, settings)
    both = pairs.join(queries.select("query_id", F.col("vector").alias("q")), "query_id").join(entries.select("entry", "ids", "vector"), "entry")

    def ranked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                score = cosines(np.stack(frame["q"]), np.stack(frame["vector"]))
                yield pd.DataFrame({"query_id": frame["query_id"], "ids": frame["ids"], "score": score})

    each = both.select("query_id", "q", "ids", "vector").mapInPandas(ranked, "query_id long, ids array<long>, score double")
    return _top(each.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id"), settings)


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, settings: Settings = Settings(), id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each query row the nearest other rows: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    small_batches(spark)
    plain = vectors.select(
        F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("_q")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    widths = plain.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    most_common = widths.orderBy(F.col("n").desc(), "width").first()
    if most_common is None:
        return spark.createDataFrame([], empty)
    fit = plain.filter(F.size("vector") == most_common.width)
    sample = fit.select("vector", F.xxhash64("vec_id", "vector").alias("_key")).orderBy("_key").limit(settings.sample).collect()  # bounded
    codes = learn(np.array([r["vector"] for r in sample], float), settings)

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(code=codes.packed(np.stack(frame["vector"])).astype(np.int64))

    # of equal vectors, only the ids that can be among the nearest, and one for the query itself
    most = settings.nearest + 1
    smallest = W.partitionBy("vector").orderBy("vec_id")
    ids = fit.select("vec_id", "vector").distinct().withColumn("_n", F.row_number().over(smallest))
    entries = ids.filter(F.col("_n") <= most).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = entries.select(F.monotonically_increasing_id().alias("entry"), "ids", "vector")
    entries = settle(entries.mapInPandas(coded, "entry long, ids array<long>, vector array<double>, code long"))
    asked = fit.filter("_q").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked = settle(asked.mapInPandas(coded, "query_id long, vector array<double>, code long"))
    n = entries.count()
    last = min(codes.radius, codes.bits)
    radii = probing_radii(last, n, codes.bits, settings)
    done, left = [], asked
    for radius in radii:
        top = settle(probed(entries, left, radius, n, codes, settings))
        near = top.filter((F.col("rank") == settings.nearest) & (F.col("score") >= codes.bounds[radius])).select("query_id")
        if radius == last:
            near = top.filter(F.col("rank") == settings.nearest).select("query_id")
        done.append(top.join(near, "query_id", "left_semi"))
        left = settle(left.join(near, "query_id", "left_anti"))
    if last not in radii:
        top = settle(scanned(entries, left, last, (n, left.count()), codes, settings))
        near = top.filter(F.col("rank") == settings.nearest).select("query_id")
        done.append(top.join(near, "query_id", "left_semi"))
        left = settle(left.join(near, "query_id", "left_anti"))
    done.append(scanned(entries, left, codes.bits, (n, left.count()), codes, settings))
    whole = reduce(DataFrame.unionByName, done)
    return whole.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
