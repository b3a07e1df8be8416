"""N-gram Jaccard join: a MinHash LSH forest proposes, exact sets of word n-grams decide.

Signatures: ``trees * depth`` minima of hashed n-grams, 16 bits each. A tree is a sorted trie of its ``depth`` values: texts under one
node share a prefix. The forest is read from the leaves up. Texts that share a leaf in some tree are compared by their
signatures with the least of them, and what is close is connected. The similarities found so tell which share of the links
prefixes of each length would find: a link of similarity ``s`` shares a prefix of ``d`` values in some of ``t`` trees with
probability ``1 - (1 - s^d)^t``, and stands for as many links as that probability at the present length asks for. The
prefix is shortened to the longest length that meets the target recall by this estimate, the nodes of that length
that hold several connected parts are compared, the estimate is made anew, and so on until it holds. Pairs that are close connect
texts to groups, and within a group all pairs of
texts are compared by their whole n-gram sets, by which also pairs without a common prefix are found.

Words are runs of other than the six ASCII white space characters; a text of fewer than ``n`` words has one n-gram, all
its words; a text without words has none and links to nothing. Equal texts are one text: they get one
class and are not compared. Null texts count as empty. Rows are kept as they come, repeated ids too; null ids get the class of
their text if another row has it, else null. Extra columns pass through, save those named like an output column.

Sizes: texts are shuffled once, and only those that may have partners are compared. Leaves cost one row per text and tree,
however many texts share them. A node of several parts is dealt in
blocks, as is a group, with one task per pair of blocks, and tasks return counts and the edges of a
spanning forest, so the rows made grow with the texts while all pairs are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions.lineage import settle
from tidelane.llm import hashed_text as H
from tidelane.llm.frames import mapped, packed, quoted, runs, unpacked
from tidelane.llm.graph import components, near_roots


#: Parts that the texts of a leaf are dealt in where they meet its least one.
LEAF_SALTS = 8


@dataclass(frozen=True)
class Settings:
    words: int = 5
    similarity: float = 0.8
    trees: int = 16
    depth: int = 8
    recall: float = 0.9995
    #: width of the bands of similarity in which the recall is estimated
    band: float = 0.05
    #: pairs whose signatures agree in less than the similarity minus this are not close
    slack: float = 0.16
    #: texts of a block of a shared prefix; texts and n-grams of a block of a group
    prefix_block: int = 1024
    group_block: int = 256
    group_grams: int = 1_000_000
    seed: int = 5


def found_share(similarity: np.ndarray, depth: int, settings: Settings) -> np.ndarray:
    """Probability that texts of a similarity share a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity**depth) ** settings.trees


def next_depth(agree: dict[int, int], depth: int, settings: Settings) -> int:
    """The longest prefix that finds the target share of the links, as the links found at ``depth`` tell: ``agree`` has their number by how
    many values of the signatures agree. The same depth if it finds enough. The target holds for each band of similarity that has
    links, so many true copies do not hide the loss of others. Links that look less similar than the
    least similarity count as that, so the estimate errs towards shorter prefixes; without any link it is for the least."""
    values = settings.trees * settings.depth
    counts = np.array(list(agree.values()) or [1], np.float64)
    similarity = np.clip(np.array(list(agree.keys()) or [0], np.float64) / values, settings.similarity, 1)
    weight = counts / found_share(similarity, depth, settings)
    band = ((similarity - settings.similarity) / settings.band).astype(int)
    for d in range(depth, 0, -1):
        found = weight * found_share(similarity, d, settings)
        if (np.bincount(band, found) >= settings.recall * np.bincount(band, weight)).all():
            return d
    return 1


def gram_hashes(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of each row, repeats included, and the rows' offsets."""
    words, rows = H.token_hashes(column)
    grams, gram_rows = H.grams(words, rows, tuple(range(1, n))) if n > 1 else (words, rows)
    lengths = np.diff(rows)
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if not len(short):
        return grams, gram_rows
    # one n-gram for a short text: its words in order
    whole = lengths[short].astype(np.uint64)
    for k in range(n - 1):
        has = lengths[short] > k
        whole[has] = H.mix(whole[has] * np.uint64(3) + words[rows[short[has]] + k])
    counts = np.diff(gram_rows)
    out = np.insert(grams, gram_rows[short], whole)
    counts[short] = 1
    return out, np.concatenate(([0], np.cumsum(counts)))


def signatures(grams: np.ndarray, rows: np.ndarray, settings: Settings) -> np.ndarray:
    """Rows by ``trees * depth`` values of 16 bits; zeros for rows without n-grams."""
    n = settings.trees * settings.depth
    out = np.zeros((len(rows) - 1, n), np.uint16)
    full = np.flatnonzero(np.diff(rows))
    if not len(full):
        return out
    starts, h = rows[:-1][full], (grams >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(settings.seed)
    factors = rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    for k in range(n):
        v = h * factors[k]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        out[full, k] = np.minimum.reduceat(v, starts).astype(np.uint16)
    return out


def digest(text: Column) -> Column:
    """Digest of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def row_key(id: Column, fp: Column) -> Column:
    """What a row is looked up by; unlike the digest alone, not shared by a large group of copies."""
    return F.xxhash64(id, fp)


def signed(docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """Add the text's digest ``_fp``, its signature ``_sig`` and number of n-grams ``_grams``; drop the text."""

    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(text)
            sigs, counts = [], []
            for first, last in H.batches(column, 1 << 20):
                grams, rows = gram_hashes(column.slice(first, last - first), settings.words)
                sigs += [s.tobytes() for s in signatures(grams, rows, settings)]
                counts.append(np.diff(rows))
            return [pa.array(sigs, pa.binary()), pa.array(np.concatenate(counts) if counts else [], pa.int64())]

        return compute

    new = [T.StructField("_sig", T.BinaryType()), T.StructField("_grams", T.LongType())]
    whole = docs.withColumn("_fp", digest(F.col(text)))
    return mapped(whole, new, start, drop=[text], text=text)


def forest(a: np.ndarray, b: np.ndarray, close: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the close pairs: ``close`` is a matrix over the ids ``a`` (rows)
    and ``b`` (columns)."""
    row, col = np.nonzero(close)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for x, y in zip(a[row].tolist(), b[col].tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            edges.append((x, y))
    return edges


def block_pairs(df: DataFrame, keys: list[str], blocks: str, id: str) -> DataFrame:
    """Deal each group in ``blocks`` blocks and copy its rows to all pairs of blocks they are in: adds
    ``_i <= _j`` and ``_own``, the row's block."""
    own = F.pmod(F.xxhash64(id), F.col(blocks)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")),
        lambda other: F.struct(F.least("_own", other).alias("_i"), F.greatest("_own", other).alias("_j")),
    )
    dealt = df.withColumn("_own", own).withColumn("_pair", F.explode(pairs))
    return dealt.select(*[c for c in dealt.columns if c != "_pair"], "_pair.*")


def _grouped(df: DataFrame, keys: list[str], id: str) -> DataFrame:
    # the sort brings the rows of a pair of blocks together, first those of the first block
    return df.repartition(*keys).sortWithinPartitions(*keys, "_own", id)


def leaves(reps: DataFrame, settings: Settings) -> DataFrame:
    """One row per text and tree: ``_rep``, ``_tree`` and ``_leaf``, the tree's values as sortable bytes."""
    width = 2 * settings.depth
    bytes_of = F.transform(
        F.sequence(F.lit(0), F.lit(settings.trees - 1)), lambda t: F.substring("_sig", t * width + 1, F.lit(width))
    )
    return reps.filter("_grams > 0").select("_rep", F.posexplode(bytes_of).alias("_tree", "_leaf"))


def leaf_edges(entries: DataFrame, reps: DataFrame, settings: Settings) -> DataFrame:
    """Edges ``a``-``b`` with ``agree``, the number of values in which the signatures agree, from texts to the least text of a leaf."""
    least = entries.groupBy("_tree", "_leaf").agg(F.min("_rep").alias("a"), F.count("*").alias("n")).filter("n > 1")
    salt = F.explode(F.sequence(F.lit(0), F.lit(LEAF_SALTS - 1)))
    dealt = entries.withColumn("_salt", F.pmod(F.xxhash64("_rep"), F.lit(LEAF_SALTS)).cast("int"))
    met = dealt.join(least.withColumn("_salt", salt), ["_tree", "_leaf", "_salt"]).filter("_rep > a")
    pairs = met.select("a", F.col("_rep").alias("b")).distinct()
    signed = lambda name: reps.select(F.col("_rep").alias(name), F.col("_sig").alias(f"_sig_{name}"))
    both = pairs.join(signed("b"), "b").join(signed("a"), "a")
    close = _closeness(settings)

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("_sig_a", "_sig_b")
            )
            agree = (x == y).sum(1)
            near = agree >= close
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(near)) for c in ("a", "b")] + [pa.array(agree[near].astype(np.int64))],
                names=["a", "b", "agree"],
            )

    return both.mapInArrow(compare, "a long, b long, agree long")


def _closeness(settings: Settings) -> int:
    return int(np.ceil((settings.similarity - settings.slack) * settings.trees * settings.depth))


def node_edges(entries: DataFrame, reps: DataFrame, known: DataFrame, depth: int, settings: Settings) -> DataFrame:
    """Edges as ``leaf_edges`` has them, between close texts of different parts that share a prefix of ``depth`` values in some
    tree. ``known`` has the part (``root``) of each ``node`` in one."""
    named = entries.join(known.withColumnRenamed("node", "_rep"), "_rep", "left").select(
        "_rep", "_tree", F.substring("_leaf", 1, 2 * depth).alias("_node"), F.coalesce("root", "_rep").alias("_part")
    )
    several = named.groupBy("_tree", "_node").agg(F.count("*").alias("_n"), F.min("_part").alias("_low"), F.max("_part").alias("_high"))
    blocks = several.filter("_low < _high").select("_tree", "_node", F.ceil(F.col("_n") / settings.prefix_block).alias("_blocks"))
    keys = ["_tree", "_node", "_i", "_j"]
    dealt = block_pairs(named.join(blocks, ["_tree", "_node"]), ["_tree", "_node"], "_blocks", "_rep")
    placed = dealt.select("_rep", "_own", "_part", *keys).join(reps.select("_rep", "_sig"), "_rep")
    least = _closeness(settings)

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(parts, keys):
            ids, own, part = (group.column(c).to_numpy() for c in ("_rep", "_own", "_part"))
            alone = own[0] == own[-1]
            if len(ids) < 2 or (part == part[0]).all() or (alone and group.column("_i")[0] != group.column("_j")[0]):
                continue
            sigs = np.frombuffer(b"".join(group.column("_sig").to_pylist()), np.uint16).reshape(len(ids), -1)
            split = len(ids) if alone else int(np.searchsorted(own, own[-1]))
            a, b = (slice(None), slice(None)) if alone else (slice(0, split), slice(split, None))
            agree = np.zeros((len(ids[a]), len(ids[b])), np.int16)
            for k in range(sigs.shape[1]):
                agree += sigs[a, k][:, None] == sigs[b, k][None, :]
            close = (agree >= least) & (part[a][:, None] != part[b][None, :])
            if alone:
                close = np.triu(close, 1)
            place_a, place_b = np.arange(len(ids))[a], np.arange(len(ids))[b]
            if edges := forest(place_a, place_b, close):
                x, y = np.array(edges).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[x]), pa.array(ids[y]), pa.array(agree[x, y - place_b[0]].astype(np.int64))], names=["a", "b", "agree"]
                )

    return _grouped(placed, keys, "_rep").mapInArrow(compare, "a long, b long, agree long")


def close_groups(reps: DataFrame, settings: Settings) -> DataFrame:
    """``node`` and ``root`` of the texts that close pairs of the forest connect."""
    entries, depth = leaves(reps, settings), settings.depth
    edges = settle(leaf_edges(entries, reps, settings))
    while True:
        agree = {row.agree: row.n for row in edges.groupBy("agree").agg(F.count("*").alias("n")).collect()}  # one row per number of values
        wanted = next_depth(agree, depth, settings)
        if wanted == depth:
            return components(edges)
        depth = wanted
        edges = edges.unionByName(settle(node_edges(entries, reps, near_roots(edges), depth, settings)))


def overlaps(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first ``split`` sets with the others, or, if ``split`` is their
    number, of all with all. N-grams in one set only are left out; the others are counted by products of
    0-1 matrices, some columns at a time."""
    lengths = [len(s) for s in sets]
    row = np.repeat(np.arange(len(sets)), lengths)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    a, b = (slice(0, split), slice(split, None)) if split < len(sets) else (slice(None), slice(None))
    out = np.zeros((len(range(*a.indices(len(sets)))), len(range(*b.indices(len(sets))))), np.float32)
    step = 4096
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        low, high = np.searchsorted(column, [first, first + step])
        dense = np.zeros((len(sets), step), np.float32)
        dense[row[low:high], column[low:high] - first] = 1
        out += dense[a] @ dense[b].T
    return out


def linked(texts: DataFrame, settings: Settings) -> DataFrame:
    """Compare all pairs of texts of each group exactly. ``texts`` has ``_rep``, ``_group``, ``_blocks`` and ``text``.
    Returns, in parts, ``_rep`` and its number of links, and edges ``_rep``-``other`` that connect what is
    linked (``other`` null in rows of counts)."""

    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            column, out = batch.column("text"), []
            for first, last in H.batches(column):
                grams, rows = gram_hashes(column.slice(first, last - first), settings.words)
                out += [np.unique(grams[rows[i] : rows[i + 1]]).tobytes() for i in range(last - first)]
            return [pa.array(out, pa.binary())]

        return compute

    sets = mapped(texts, [T.StructField("_set", T.BinaryType())], start, drop=["text"], text="text")
    keys = ["_group", "_i", "_j"]
    dealt = block_pairs(sets, ["_group"], "_blocks", "_rep").select("_rep", "_own", "_set", *keys)
    schema = pa.schema([("_rep", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(parts, keys):
            ids, own = group.column("_rep").to_numpy(), group.column("_own").to_numpy()
            alone = own[0] == own[-1]
            if len(ids) < 2 or (alone and group.column("_i")[0] != group.column("_j")[0]):
                continue
            members = [np.frombuffer(s, np.uint64) for s in group.column("_set").to_pylist()]
            split = len(ids) if alone else int(np.searchsorted(own, own[-1]))
            a, b = (slice(None), slice(None)) if alone else (slice(0, split), slice(split, None))
            both = overlaps(members, split)
            lengths = np.array([len(m) for m in members], np.float64)
            union = lengths[a][:, None] + lengths[b][None, :] - both
            close = both >= settings.similarity * union - 1e-6
            if alone:
                np.fill_diagonal(close, False)
            edges = forest(ids[a], ids[b], np.triu(close) if alone else close)
            if not edges:
                continue
            counts = [*zip(ids[a].tolist(), close.sum(1).tolist(), strict=True)]
            counts += [] if alone else [*zip(ids[b].tolist(), close.sum(0).tolist(), strict=True)]
            counts = [(x, n) for x, n in counts if n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _ in counts] + [x for x, _ in edges], pa.int64()),
                    pa.array([None] * len(counts) + [y for _, y in edges], pa.int64()),
                    pa.array([n for _, n in counts] + [0] * len(edges), pa.int64()),
                ],
                schema=schema,
            )

    return _grouped(dealt, keys, "_rep").mapInArrow(compare, "_rep long, other long, links long")


def _classified(docs: DataFrame, settings: Settings, id: str, text: str, kept: list[str]) -> DataFrame:
    """The kept columns with ``_fp``, ``copy_id``, ``class_id``, ``n_links`` and ``_class_number``, one number per class."""
    rows = settle(signed(docs.select(*kept, F.col(text).alias("_text")), settings, "_text"))
    # texts go by a number of their own, as ids may be null or repeat
    texts = settle(
        rows.groupBy("_fp")
        .agg(F.min(id).alias("copy_id"), F.first("_sig").alias("_sig"), F.first("_grams").alias("_grams"))
        .withColumn("_rep", F.monotonically_increasing_id())
    )
    groups = close_groups(texts, settings).select(F.col("node").alias("_rep"), F.col("root").alias("_group"))
    members = texts.select("_rep", "_grams", "_fp", "copy_id").join(groups, "_rep")
    sizes = members.groupBy("_group").agg(
        F.greatest(
            F.ceil(F.count("*") / settings.group_block), F.ceil(F.sum("_grams") / settings.group_grams)
        ).alias("_blocks")
    )
    # one row of each text is looked up by id and digest, which no large group of copies shares
    wanted = settle(
        members.join(sizes, "_group").select(
            row_key(F.col("copy_id"), F.col("_fp")).alias("_at"), F.col("_fp").alias("_same"), "_rep", "_group", "_blocks"
        )
    )
    whole = docs.select(F.col(id).alias("_id"), F.col(text).alias("text"), digest(F.col(text)).alias("_fp"))
    whole = whole.select("text", "_fp", row_key(F.col("_id"), F.col("_fp")).alias("_at"))
    chosen = whole.join(wanted, "_at").filter("_fp = _same").select("_rep", "_group", "_blocks", "text")
    found = settle(linked(chosen.dropDuplicates(["_rep"]), settings))
    edges = found.filter("other is not null").select(F.col("_rep").alias("a"), F.col("other").alias("b"))
    classes = components(edges).withColumnRenamed("node", "_rep")
    names = (
        classes.join(texts.select("_rep", "copy_id"), "_rep").groupBy("root").agg(F.min("copy_id").alias("_class"))
    )
    links = found.filter("other is null").groupBy("_rep").agg(F.sum("links").alias("_links"))
    known = (
        texts.select("_rep", "_fp", "copy_id")
        .join(classes.join(names, "root"), "_rep", "left")
        .join(links, "_rep", "left")
        .select(
            "_fp",
            "copy_id",
            F.coalesce("_class", "copy_id").alias("class_id"),
            F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("root", "_rep").alias("_class_number"),
        )
    )
    return rows.select(*kept, "_fp").join(known, "_fp")


def ngram_join(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns but the text, with ``copy_id`` (least id of the equal texts), ``class_id`` (least id of the
    texts connected by links) and ``n_links`` (other texts of similarity or more)."""
    new = ("copy_id", "class_id", "n_links")
    rows = packed(docs, (*new, text), id=F.col(quoted(id)), text=F.col(quoted(text)))
    found = _classified(rows, settings, "id", "text", ["row", "id"])
    return found.select(*unpacked(found, docs, (*new, text)), *new)


def near_copies_removed(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of its least id, columns as they came. Of several texts with that id, the one of the
    least digest stays; classes without any id keep one text."""
    named = _classified(docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).alias("text")), settings, "id", "text", ["id"])
    winners = (
        named.filter(F.col("id").eqNullSafe(F.col("class_id")))
        .groupBy("_class_number")
        .agg(F.min("_fp").alias("same"), F.first("class_id").alias("class_id"))
        .select("same", row_key(F.col("class_id"), F.col("same")).alias("at"))
    )
    fp = digest(F.col(quoted(text)))
    keyed = packed(docs, fp=fp, at=row_key(F.col(quoted(id)), fp))
    # rows equal in id and text meet in the join's partitions, so dropping all but one needs no other shuffle
    one = keyed.join(winners, "at").filter("fp = same").dropDuplicates(["at"])
    return one.select(*unpacked(one, docs))
