"""Phrase collocations: how much more often words stand together than their parts stand at all, per language.

Texts are lower-cased (A to Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words ``[^\\x20\\x09]+``; a phrase is words next to each
other in a piece. Candidates have 2 to ``longest`` words and a frequency ``a`` of ``least`` or more. A cut after k words gives
the frequencies ``l`` of the first part and ``r`` of the rest and the score ``floor(2000000 a / (l + r))``; the cut with
the lowest score counts, ties to the smallest k. Candidates inside a longer one that has ``inside`` hundredths of their frequency or more are
dropped. Of the rest the first ``top`` per language count, by score, frequency and phrase.

Method: weighted acyclic automata. A shard is some megabytes of text in a task. Its n-grams, sorted, build a count
transducer step by step: an arc is new where a word is the first to differ from the n-gram before, so prefixes are shared, and
the last arc carries the count. A shard's transducer is cut by prefix range (of the first three words at most) and
packed; a task that owns a range unites the transducers of all shards, weights of equal paths added. For the parts of candidates,
requests are dealt to the range of the part and composed with its transducer, which reads their weight.

Counts are exact, made of words, not of hashes. Longer n-grams are counted only where the shorter ones in them are frequent, which loses nothing: words
first, then pairs of frequent words, then three words of two frequent pairs, and so on. What was frequent goes to
the tasks as ``BITS`` bits of a hash table, 8 MB whatever the input; a wrong bit costs work, never a result.

Layout: a pass over the texts for each length, with one shuffle of packed transducers. There are as many ranges as input partitions,
so a range grows with neither. A frequent word or pair is one path per shard, its followers are in many ranges; requests for a
part are salted. Nothing is collected but the bits.

Awkward rows: a null text is empty, a null language ``und``; empty texts and tables give nothing. A text longer than a block
is cut after a piece. Extra columns are not read. Ties go by phrase in the order of its UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions.lineage import settle
from tidelane.llm.frames import small_batches
from tidelane.llm.hashed_text import mix, token_hashes, utf8

#: Bytes of text in a block (tokenised at once) and in a shard (one transducer per range and order).
BLOCK, SHARD = 1 << 20, 1 << 23
BITS, SLICE = 1 << 26, 1 << 17
PREFIX, SALTS, MERGED = 3, 8, 1 << 20
WORD, SPACE, BREAK = 0, 1, 2

_KIND = np.full(256, WORD, np.uint8)
_KIND[[0x20, 0x09]] = SPACE
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _blocks(data: np.ndarray, rows: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that end with a text or after the end of a piece."""
    first, end = 0, len(data)
    while first < end:
        last = min(first + size, end)
        if last < end:
            row_end = int(rows[np.searchsorted(rows, last)])
            while last < row_end:
                ahead = np.flatnonzero(_KIND[data[last : min(last + size, row_end)]] == BREAK)
                if len(ahead):
                    last += int(ahead[0]) + 1
                    break
                last = min(last + size, row_end)
        yield first, last
        first = last


def words_of(data: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lower-case words, number of the row of each, number that words of one piece share)."""
    kind = _KIND[data]
    is_word = kind == WORD
    start = is_word.copy()
    start[1:] &= ~is_word[:-1]
    heads = rows[:-1][rows[:-1] < len(data)]
    start[heads] = is_word[heads]
    starts = np.flatnonzero(start)
    inside = np.cumsum(is_word, dtype=np.int32)
    offsets = np.empty(len(starts) + 1, np.int32)
    offsets[:-1] = inside[starts] - 1
    offsets[-1] = inside[-1] if len(inside) else 0
    letters = np.ascontiguousarray(_LOWER[data[is_word]])
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    row = np.searchsorted(rows[1:], starts, "right")
    piece = np.cumsum(kind == BREAK, dtype=np.int32)[starts] + row
    return words, row, piece.astype(np.int64)


def language_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in langs], np.uint64)


def prefix_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hash of a language and of the words after it."""
    h = lang
    for w in words:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h


class Transducer:
    """Counts of n-grams of one order as a weighted acyclic automaton: level 0 has an arc per language, the levels after it
    arcs for the words, each under an arc of the level above; arcs of the last level carry weights.

    ``labels`` are sorted texts, ``paths`` the sorted n-grams as columns of label numbers, from which the arcs follow."""

    def __init__(self, labels: pa.Array, paths: list[np.ndarray], weights: np.ndarray):
        self.labels, self.paths, self.weights = labels, paths, weights

    def arcs(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per level the arcs' labels and, but for the last, the number of arcs below each. An arc is new where the
        path is the first of its prefix."""
        n = len(self.weights)
        new = np.zeros(n, bool)
        new[:1] = True
        labels, below, before = [], [], None
        for column in self.paths:
            new = new.copy()
            new[1:] |= column[1:] != column[:-1]
            at = np.flatnonzero(new)
            labels.append(column[at])
            if before is not None:
                below.append(np.diff(np.append(np.searchsorted(at, before), len(at))))
            before = at
        return labels, below

    def packed(self) -> bytes:
        labels, below = self.arcs()
        used = np.unique(np.concatenate(self.paths)) if len(self.weights) else np.zeros(0, np.int64)
        texts = self.labels.take(pa.array(used))
        data, ends = utf8(texts)
        arrays = [np.searchsorted(used, x) for x in labels] + below + [self.weights, np.diff(ends)]
        parts = [struct.pack("<II", len(self.paths), len(arrays))]
        for x in arrays:
            small = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
            parts += [struct.pack("<QB", len(x), small.itemsize), x.astype(small).tobytes()]
        raw = b"".join([*parts, data.tobytes()])
        return struct.pack("<Q", len(raw)) + pa.compress(raw, "zstd", asbytes=True)

    @classmethod
    def unpacked(cls, blob: bytes) -> Transducer:
        (size,) = struct.unpack_from("<Q", blob)
        raw = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True)
        levels, count = struct.unpack_from("<II", raw)
        at, arrays = 8, []
        for _ in range(count):
            n, width = struct.unpack_from("<QB", raw, at)
            arrays.append(np.frombuffer(raw, f"<u{width}", n, at + 9).astype(np.int32 if width < 4 else np.int64))
            at += 9 + n * width
        arcs, below, weights, lengths = arrays[:levels], arrays[levels : 2 * levels - 1], arrays[-2].astype(np.int64), arrays[-1]
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        texts = pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(raw[at:])])
        paths = [arcs[-1]]
        repeats = None
        for level in range(levels - 2, -1, -1):
            # paths below each arc: sum over the arcs below it
            if repeats is None:
                repeats = below[level]
            else:
                repeats = np.add.reduceat(repeats, np.cumsum(below[level]) - below[level]) if len(repeats) else repeats
            paths.insert(0, np.repeat(arcs[level], repeats))
        return cls(texts, paths, weights)

    @classmethod
    def union(cls, parts: list[Transducer]) -> Transducer:
        """One transducer of all paths; weights of equal paths are added."""
        if len(parts) == 1:
            return parts[0]
        coded = pa.concat_arrays([p.labels for p in parts]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        labels, codes, at = coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()].astype(np.int32), 0
        columns = [[] for _ in parts[0].paths]
        for p in parts:
            own = codes[at : at + len(p.labels)]
            at += len(p.labels)
            for column, path in zip(columns, p.paths):
                column.append(own[path])
        paths = [np.concatenate(column) for column in columns]
        state = paths[0].astype(np.int64)
        for column in paths[1:]:
            _, first, state = np.unique(state * len(labels) + column, return_index=True, return_inverse=True)
        weights = np.zeros(len(first), np.int64)
        np.add.at(weights, state, np.concatenate([p.weights for p in parts]))
        return cls(labels, [column[first] for column in paths], weights)

    def pruned(self, least: int) -> Transducer:
        keep = self.weights >= least
        return Transducer(self.labels, [column[keep] for column in self.paths], self.weights[keep])

    def phrases(self) -> tuple[pa.Array, pa.Array]:
        """(language, words joined by spaces) of the paths."""
        texts = [self.labels.take(pa.array(column)) for column in self.paths]
        joined = pc.binary_join_element_wise(*texts[1:], " ") if len(texts) > 2 else texts[1]
        return texts[0], joined

    def composed(self, langs: pa.Array, phrases: pa.Array) -> np.ndarray:
        """Weights of requested phrases: their words are read along the arcs; 0 where there is no path."""
        n, words = len(phrases), pc.split_pattern(phrases, " ")
        depth = len(self.paths) - 1
        columns = [langs, *[pc.list_element(words, k) for k in range(depth)]]
        state, ok = np.zeros(n, np.int64), np.ones(n, bool)
        own = np.zeros(len(self.weights), np.int64)
        for column, path in zip(columns, self.paths):
            label = pc.index_in(column, self.labels).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            ok &= label >= 0
            keys, own = np.unique(own * len(self.labels) + path, return_inverse=True)
            asked = state * len(self.labels) + label
            place = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
            ok &= (keys[place] == asked) if len(keys) else False
            state = np.where(ok, place, 0)
        return np.where(ok, self.weights[state], 0) if len(self.weights) else np.zeros(n, np.int64)


def _grams(words: np.ndarray, piece: np.ndarray, lang: np.ndarray, size: int, orders: range, allowed) -> Iterator[tuple]:
    """Per order, its number, the sorted distinct n-grams (columns of label numbers) and their counts. ``allowed(k, places)`` tells whether the
    k-gram at each place may be part of a longer one."""
    at, state = np.arange(len(words)), lang.astype(np.int64)
    paths = [np.arange(size, dtype=np.int32)]
    for k in range(1, orders[-1] + 1):
        at_end = at + k - 1
        fits = at_end < len(words)
        fits[fits] = piece[at_end[fits]] == piece[at[fits]]
        if allowed is not None:
            fits[fits] = allowed(k, at_end[fits])
        at, state = at[fits], state[fits]
        keys, state, counts = np.unique(state * size + words[at + k - 1], return_inverse=True, return_counts=True)
        paths = [column[keys // size] for column in paths] + [(keys % size).astype(np.int32)]
        if k in orders:
            yield k, paths, counts


class _Shard:
    """Words of a shard until its transducers are built."""

    def __init__(self):
        self.words, self.lang, self.piece, self.bytes, self.pieces = [], [], [], 0, 0

    def add(self, data: np.ndarray, rows: np.ndarray, langs: np.ndarray) -> None:
        words, row, piece = words_of(data, rows)
        self.words.append(words)
        self.lang.append(langs[row])
        self.piece.append(piece + self.pieces)
        self.bytes += len(data)
        self.pieces += (int(piece[-1]) if len(piece) else 0) + 1

    def transducers(self, langs: list[str], orders: range, ranges: int, bits: np.ndarray | None) -> Iterator[tuple[int, int, bytes]]:
        """(order, range, packed transducer)."""
        coded = pa.concat_arrays([*self.words, pa.array(langs, pa.string())]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        labels, codes = coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]
        words, lang_codes = codes[: len(codes) - len(langs)], codes[len(codes) - len(langs) :]
        piece, lang = np.concatenate(self.piece), np.concatenate(self.lang)
        if not len(words):
            return
        hashes = np.zeros(len(labels), np.uint64)
        used = np.unique(words)
        hashes[used] = token_hashes(labels.take(pa.array(used)))[0]
        tongue = language_hashes(langs)
        of_lang = np.zeros(len(labels), np.uint64)
        of_lang[lang_codes] = tongue
        allowed = None
        if bits is not None:
            known = orders[0] - 1  # frequent n-grams of this order are in the bits
            spread = [hashes[words[k : len(words) - known + 1 + k]] for k in range(known)]
            here = prefix_hashes(tongue[lang[: len(words) - known + 1]], spread) % np.uint64(BITS)
            good = np.zeros(len(words), bool)
            good[: len(here)] = bits[(here >> np.uint64(3)).astype(np.int64)] >> (here & np.uint64(7)).astype(np.uint8) & 1 > 0
            if known == 1:
                allowed = lambda k, ends: good[ends]
            else:
                allowed = lambda k, ends: good[ends - known + 1] if k >= known else np.ones(len(ends), bool)
        for k, paths, counts in _grams(words, piece, lang_codes[lang], len(labels), orders, allowed):
            ranged = prefix_hashes(of_lang[paths[0]], [hashes[c] for c in paths[1 : 1 + PREFIX]]) % np.uint64(ranges)
            order = np.argsort(ranged, kind="stable")
            edges = np.flatnonzero(np.diff(ranged[order], prepend=np.uint64(ranges))) if len(order) else []
            for a, b in zip(edges, [*edges[1:], len(order)]):
                own = order[a:b]
                yield k, int(ranged[own[0]]), Transducer(labels, [c[own] for c in paths], counts[own]).packed()


_PACKED = T.StructType([T.StructField("words", T.IntegerType()), T.StructField("range", T.LongType()), T.StructField("blob", T.BinaryType())])


def shard_transducers(docs: DataFrame, orders: range, ranges: int, bits=None, shard: int = SHARD) -> DataFrame:
    """Packed transducers (``words``, ``range``, ``blob``) of all shards of ``lang`` and ``text``."""
    small_batches(docs.sparkSession)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8) if bits is not None else None
        held, names = _Shard(), {}

        def flushed() -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            for row in held.transducers(list(names), orders, ranges, table) if held.words else ():
                out.append(row)
                size += len(row[2])
                if size > 1 << 22:
                    yield batch(out)
                    out, size = [], 0
            if out:
                yield batch(out)

        def batch(rows: list) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_PACKED.names)

        for part in parts:
            coded = part.column("lang").dictionary_encode()
            own = np.array([names.setdefault(x, len(names)) for x in coded.dictionary.to_pylist()], np.int64)
            langs = own[coded.indices.to_numpy(zero_copy_only=False)]
            data, rows = utf8(part.column("text"))
            for a, b in _blocks(data, rows):
                first, last = int(np.searchsorted(rows, a, "right")) - 1, int(np.searchsorted(rows, b, "left"))
                held.add(data[a:b], np.clip(rows[first : last + 1], a, b) - a, langs[first:last])
                if held.bytes >= shard:
                    yield from flushed()
                    held = _Shard()
        yield from flushed()

    return docs.mapInArrow(work, _PACKED)


_UNITED = T.StructType(
    [
        *_PACKED.fields,
        T.StructField("lang", T.StringType()),
        T.StructField("phrase", T.StringType()),
        T.StructField("f", T.LongType()),
        T.StructField("bit", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)


def united(packed: DataFrame, least: int) -> DataFrame:
    """Per order and range the union of the shards' transducers, in three kinds of rows: the transducer of what occurs ``least``
    times or more (``blob``), its paths (``lang``, ``phrase``, ``f`` and place in the bits), and, for words, the
    number of all words per language (``n``)."""

    def rows(words: int, ranged: int, whole: Transducer) -> Iterator[pa.RecordBatch]:
        if words == 1:
            total = np.zeros(len(whole.labels), np.int64)
            np.add.at(total, whole.paths[0], whole.weights)
            some = np.flatnonzero(total)
            yield batch(len(some), words, ranged, lang=whole.labels.take(pa.array(some)), n=pa.array(total[some]))
        kept = whole.pruned(least)
        if not len(kept.weights):
            return
        yield batch(1, words, ranged, blob=pa.array([kept.packed()], pa.binary()))
        used = np.unique(np.concatenate(kept.paths[1:]))
        hashes = np.zeros(len(kept.labels), np.uint64)
        hashes[used] = token_hashes(kept.labels.take(pa.array(used)))[0]
        tongues = np.unique(kept.paths[0])
        of_lang = np.zeros(len(kept.labels), np.uint64)
        of_lang[tongues] = language_hashes(kept.labels.take(pa.array(tongues)).to_pylist())
        bit = prefix_hashes(of_lang[kept.paths[0]], [hashes[c] for c in kept.paths[1:]]) % np.uint64(BITS)
        lang, phrase = kept.phrases()
        whole_rows = batch(len(bit), words, ranged, lang=lang, phrase=phrase, f=pa.array(kept.weights), bit=pa.array(bit.astype(np.int64)))
        for first in range(0, len(bit), 10_000):
            yield whole_rows.slice(first, 10_000)

    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def batch(size: int, words: int, ranged: int, **given) -> pa.RecordBatch:
        given |= {"words": pa.array(np.full(size, words, np.int32)), "range": pa.array(np.full(size, ranged, np.int64))}
        arrays = [given.get(name, None) for name in _UNITED.names]
        return pa.RecordBatch.from_arrays([pa.nulls(size, k) if a is None else a for a, k in zip(arrays, kinds)], names=_UNITED.names)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for part in parts:
            for words, ranged, blob in zip(*[c.to_pylist() for c in part.columns]):
                if key is not None and key != (words, ranged):
                    yield from rows(*key, Transducer.union(held))
                    held, size = [], 0
                key = words, ranged
                held.append(Transducer.unpacked(blob))
                size += len(held[-1].weights)
                if size > max(MERGED, 2 * len(held[0].weights)):
                    held = [Transducer.union(held)]
                    size = len(held[0].weights)
        if key is not None:
            yield from rows(*key, Transducer.union(held))

    return packed.repartition("words", "range").sortWithinPartitions("words", "range").mapInArrow(work, _UNITED)


def _bits(frequent: DataFrame):
    """A broadcast hash table of the ``bit`` column: ``BITS`` bits, put together in slices by Spark."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for places in part.column("places"):
                table = np.zeros(SLICE, np.uint8)
                table[places.values.to_numpy()] = 1
                out.append(np.packbits(table, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([part.column("slice"), pa.array(out, pa.binary())], names=["slice", "table"])

    sliced = (
        frequent.select("bit").distinct().groupBy(F.expr(f"bit div {SLICE}").alias("slice")).agg(F.collect_list(F.expr(f"cast(bit % {SLICE} as int)")).alias("places"))
    )
    table = bytearray(BITS // 8)
    step = SLICE // 8
    for row in sliced.mapInArrow(work, "slice long, table binary").collect():  # at most BITS / 8 bytes
        table[row.slice * step : (row.slice + 1) * step] = row.table
    return frequent.sparkSession.sparkContext.broadcast(bytes(table))


def _requests(candidates: DataFrame, ranges: int) -> DataFrame:
    """The two parts of every cut of each candidate, with the range in which each is counted."""
    schema = T.StructType(
        [
            T.StructField("words", T.IntegerType()),
            T.StructField("range", T.LongType()),
            T.StructField("part", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("phrase", T.StringType()),
            T.StructField("a", T.LongType()),
            T.StructField("k", T.IntegerType()),
            T.StructField("first", T.BooleanType()),
        ]
    )

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            asked = {}
            for lang, phrase, a in zip(*[batch.column(c).to_pylist() for c in ("lang", "phrase", "f")]):
                words = phrase.split(" ")
                for k in range(1, len(words)):
                    asked.setdefault(k, []).append((" ".join(words[:k]), lang, phrase, a, k, True))
                    asked.setdefault(len(words) - k, []).append((" ".join(words[k:]), lang, phrase, a, k, False))
            for size, rows in asked.items():
                columns = [pa.array(c) for c in zip(*rows)]
                coded = columns[1].dictionary_encode()
                lang = language_hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
                hashes = token_hashes(columns[0])[0].reshape(len(rows), size)
                ranged = prefix_hashes(lang, [hashes[:, j] for j in range(min(size, PREFIX))]) % np.uint64(ranges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), size, np.int32)), pa.array(ranged.astype(np.int64)), *columns[:4], columns[4].cast(pa.int32()), columns[5]],
                    names=schema.names,
                )

    return candidates.select("lang", "phrase", "f").mapInArrow(work, schema)


def _looked_up(requests: DataFrame, transducers: DataFrame) -> DataFrame:
    """Requests with the weight ``f`` that the transducer of their range gives their part."""
    asked = requests.withColumn("salt", F.pmod(F.xxhash64("lang", "phrase"), F.lit(SALTS)).cast("int")).withColumn("blob", F.lit(None).cast("binary"))
    copies = transducers.select("words", "range", "blob").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = asked.unionByName(copies, allowMissingColumns=True)
    keys = ["words", "range", "salt"]
    schema = T.StructType([*requests.select("lang", "phrase", "a", "k", "first").schema.fields, T.StructField("f", T.LongType())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in parts:
            blobs = np.flatnonzero(batch.column("blob").is_valid().to_numpy(zero_copy_only=False))
            for a, b in zip([0, *(blobs + 1)], [*blobs, batch.num_rows]):
                if a:
                    current = Transducer.unpacked(batch.column("blob")[int(a) - 1].as_py())
                if b > a:
                    rows = batch.slice(int(a), int(b - a))
                    weights = current.composed(rows.column("lang"), rows.column("part"))
                    yield pa.RecordBatch.from_arrays([*[rows.column(n) for n in schema.names[:-1]], pa.array(weights)], names=schema.names)

    return both.repartition(*keys).sortWithinPartitions(*keys, F.col("blob").isNull()).mapInArrow(work, schema)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 4,
    least: int = 30,
    inside: int = 80,
    top: int = 2000,
    ranges: int | None = None,
    shard: int = SHARD,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the language) and ``score`` of the best phrases."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    ranges = ranges or max(1, rows.rdd.getNumPartitions())
    bits, levels = None, []
    for size in range(1, longest + 1):
        packed = shard_transducers(rows, range(size, size + 1), ranges, bits, shard)
        levels.append(settle(united(packed, least)))
        if size < longest:
            bits = _bits(levels[-1].filter("bit is not null"))
    counted = levels[0]
    for level in levels[1:]:
        counted = counted.unionByName(level)
    candidates = counted.filter("phrase is not null and words > 1")
    looked = _looked_up(_requests(candidates, ranges), counted.filter("blob is not null"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = looked.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r")
    )
    scored = cuts.withColumn(
        "score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    )
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    words = F.split("phrase", " ", -1)
    within = candidates.filter("words > 2").select(
        "lang",
        "f",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("words") - 1),
                    lambda size: F.transform(
                        F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")
                    ),
                )
            )
        ).alias("phrase"),
    )
    longer = within.groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("over").isNull() | (wide("over") * 100 < wide("a") * inside)
    )
    order = W.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = counted.filter("n is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
