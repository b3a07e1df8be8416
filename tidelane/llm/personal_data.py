"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Base kinds, leftmost and non-overlapping per kind: ``email``, ``ip`` (four parts of at most 255), ``card`` (16 to 19 digits that
pass the Luhn test) and ``phone`` (a plus sign and 8 to 15 digits).

Method: what the base kinds find are the seeds. Strings that look alike but are no match, numbers of seven digits or more and
names with an at sign, are unknown mentions. Every mention induces lexical patterns: its slot (number or address) with
two words before, two words after, or a word on both sides. Patterns and instances (strings, whatever the place) form a
graph. In each round Spark scores a pattern per kind by the share of its instances that are known, seeds and accepted ones by their
confidence; patterns with enough support and precision extract their unknown instances, and an instance with two such
patterns is accepted with their mean weight as confidence. After the last round every mention of an
accepted instance is a span of kind ``context_<kind>``. Scores are whole numbers (parts in a million), so results do not depend on
the order of addition; instances are counted once per pattern, so copies of a text add no evidence.

Layout: one pass over the texts gives spans and mentions without the text. Seed edges are counted per pattern by partial sums and only
patterns that an unknown mention shares are kept; rounds work on unknown edges alone. Joins of the graph are salted, nothing is
broadcast by hint or collected, and equal texts are one in it.

Awkward rows: null and empty texts have no spans; repeated rows and ids are separate rows with equal results; words are cut at
``WINDOW`` characters from a mention, a rule of the patterns, not of the search. Very long texts cost time
in proportion. The text column is not handed on; other columns are, and those named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions.lineage import settle
from tidelane.llm.frames import small_batches
from tidelane.llm.hashed_text import batches

KINDS = ("email", "ip", "card", "phone")
# The base patterns. The address is found around its at sign, the others as they stand.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Unknown mentions: a number with its separators, a name with an at sign.
NUMBER = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])*")
NUMBER_DIGITS, HOST = 7, re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
#: Characters on each side of a mention in which its context is looked for.
WINDOW = 80
UNIT = 1_000_000
ROUNDS, LEAST_SUPPORT, LEAST_PRECISION, LEAST_PATTERNS, SALTS = 3, 3 * UNIT, UNIT // 2, 2, 16
_EDGES = ".,;:!?\"'()[]{}<>=*-"


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if k % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _addresses(text: str, ending: re.Pattern) -> Iterator[tuple[int, int]]:
    """Matches of a local part and ``ending``, leftmost and not overlapping: the local part is all of
    its characters before the at sign that no earlier match took."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        found = ending.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = at = found.end()
        else:
            free = at = at + 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    spans = [(0, a, b) for a, b in _addresses(text, DOMAIN)]
    cards, phones = [], []
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                spans.append((1, at, end))
            at = end + 1
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            cards.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            phones.append((3, m.start(), m.end()))
    return spans + cards + phones


def _words(context: str, cut_left: bool, cut_right: bool) -> list[str]:
    """Words of a piece of context, folded, without one that the window may have cut."""
    words = context.split()
    if words and cut_left and not context[0].isspace():
        words = words[1:]
    if words and cut_right and not context[-1].isspace():
        words = words[:-1]
    return [w for w in (word.lower().strip(_EDGES) for word in words) if w]


def patterns(text: str, start: int, stop: int, slot: str) -> list[str]:
    """The lexical patterns of a mention: words around a slot."""
    left = _words(text[max(0, start - WINDOW) : start], start > WINDOW, False)[-2:]
    right = _words(text[stop : stop + WINDOW], False, stop + WINDOW < len(text))[:2]
    found = []
    if len(left) == 2:
        found.append(f"{left[0]} {left[1]} <{slot}>")
    if len(right) == 2:
        found.append(f"<{slot}> {right[0]} {right[1]}")
    if left and right:
        found.append(f"{left[-1]} <{slot}> {right[0]}")
    return found


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """All mentions of a text, known (kind 0 to 3) and unknown (kind -1), with their patterns."""
    found = [(kind, a, b, "address" if kind == 0 else "number") for kind, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    other = [(a, b, "address") for a, b in _addresses(text, HOST)]
    other += [
        (m.start(), m.end(), "number") for m in NUMBER.finditer(text) if len(_digits(m[0])) >= NUMBER_DIGITS
    ]
    k = 0
    for a, b, slot in sorted(other):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue
        glued = text[a - 1 : a].isalnum() or text[b : b + 1].isalnum()
        if not glued:
            found.append((-1, a, b, slot))
    return [
        {
            "kind": kind,
            "start": a,
            "stop": b,
            "instance": text[a:b].lower() if slot == "address" else _digits(text[a:b]),
            "patterns": patterns(text, a, b, slot),
        }
        for kind, a, b, slot in found
    ]


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
)
MENTIONS = T.ArrayType(
    T.StructType(
        [
            *SPANS.elementType.fields,
            T.StructField("instance", T.StringType()),
            T.StructField("patterns", T.ArrayType(T.StringType())),
        ]
    )
)
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))
_MENTIONS = pa.list_(
    pa.struct(
        [("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]
    )
)


def _scanned(rows: DataFrame) -> DataFrame:
    """``row``, ``key``, ``base`` and ``mentions`` of rows with ``row``, ``text`` and ``key``."""
    small_batches(rows.sparkSession)
    kept = [rows.schema["row"], rows.schema["key"]]
    schema = T.StructType([*kept, T.StructField("base", SPANS), T.StructField("mentions", MENTIONS)])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for first, last in batches(whole.column("text")):
                batch = whole.slice(first, last - first)
                texts = batch.column("text")
                # no mention of any kind is without one of these
                worth = pc.match_substring_regex(texts, r"@|\+[0-9]|[0-9]([^0-9]{0,2}[0-9]){3}").fill_null(False)
                spans, told = [[]] * len(texts), [[]] * len(texts)
                for k in pc.indices_nonzero(worth).to_pylist():
                    text = texts[k].as_py()
                    base = base_spans(text)
                    spans[k] = [{"kind": kind, "start": a, "stop": b} for kind, a, b in base]
                    told[k] = mentions(text, base)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("key"), pa.array(spans, _SPANS), pa.array(told, _MENTIONS)], names=schema.names
                )

    return rows.mapInArrow(work, schema)


def _salted(many: DataFrame, one: DataFrame, key: str, by: Column, how: str = "inner") -> DataFrame:
    """Join of rows with those of ``one`` by ``key``; the rows of a key are dealt by ``by``, so none is a single group."""
    dealt = many.withColumn("salt", F.pmod(by, F.lit(SALTS)).cast("int"))
    copies = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [key, "salt"], how).drop("salt")


def _weights(edges: DataFrame, seeds: DataFrame, accepted: DataFrame | None) -> DataFrame:
    """``pattern``, ``kind`` and ``weight`` of the patterns that may extract."""
    known = [F.lit(0).cast("long")] * len(KINDS)
    if accepted is not None:
        edges = _salted(edges, accepted, "instance", F.xxhash64("pattern"), "left")
        known = [F.when(F.col("kind") == k, F.col("confidence")).otherwise(0) for k in range(len(KINDS))]
    counted = edges.groupBy("pattern").agg(
        F.count("*").alias("unknown"), *[F.sum(known[k]).alias(f"known{k}") for k in range(len(KINDS))]
    )
    both = counted.join(seeds, "pattern")
    n = F.col("unknown") + sum((F.col(f"seeds{k}") for k in range(1, len(KINDS))), F.col("seeds0"))
    scored = F.array(
        *[
            F.struct(
                F.lit(k).alias("kind"),
                (F.col(f"seeds{k}") * UNIT + F.col(f"known{k}")).alias("support"),
            )
            for k in range(len(KINDS))
        ]
    )
    each = both.select("pattern", n.alias("n"), F.inline(scored))
    weight = F.expr("support div n")
    return each.filter((F.col("support") >= LEAST_SUPPORT) & (weight >= LEAST_PRECISION)).select(
        "pattern", "kind", weight.alias("weight")
    )


def accepted_instances(mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``instance``, ``kind`` and ``confidence`` of the unknown instances that bootstrapping accepts. ``mentions`` has ``kind``
    (-1 if unknown), ``instance`` and ``patterns``."""
    edges = mentions.select("kind", "instance", F.explode("patterns").alias("pattern")).distinct()
    unknown = settle(edges.filter("kind < 0").drop("kind"))
    shared = unknown.select("pattern").distinct()
    seeds = settle(
        edges.filter("kind >= 0")
        .groupBy("pattern")
        .agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(f"seeds{k}") for k in range(len(KINDS))])
        .join(shared, "pattern")
    )
    accepted = None
    best = W.partitionBy("instance").orderBy(F.col("patterns").desc(), F.col("confidence").desc(), "kind")
    for _ in range(rounds):
        extracted = _salted(unknown, _weights(unknown, seeds, accepted), "pattern", F.xxhash64("instance"))
        votes = extracted.groupBy("instance", "kind").agg(
            F.count("*").alias("patterns"), F.expr("sum(weight) div count(*)").alias("confidence")
        )
        chosen = votes.filter(F.col("patterns") >= LEAST_PATTERNS).withColumn("place", F.row_number().over(best))
        accepted = settle(chosen.filter("place = 1").select("instance", "kind", "confidence"))
    return accepted


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"context_{k}") for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def personal_data(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Add ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_context`` (long), ``base_spans`` and ``spans`` (``kind:start:end`` by
    kind and start, comma-joined; code points, ends exclusive) to the columns other than ``text``."""
    out = {*(f"n_{k}" for k in (*KINDS, "context")), "base_spans", "spans", text.lower()}
    others = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c.lower() not in out]
    whole, pad = F.col(f"`{text}`"), "_" * (1 + max(map(len, docs.columns)))  # a struct needs a field, and no column has this name
    rows = docs.select(
        F.struct(*others, F.lit(0).alias(pad)).alias("row"), whole.alias("text"), F.unhex(F.sha2(whole, 256)).alias("key")
    )
    scanned = settle(_scanned(rows))
    is_unknown = F.exists("mentions", lambda m: m["kind"] < 0)
    told = scanned.select(F.inline("mentions"))
    accepted = accepted_instances(told.select("kind", "instance", "patterns"), rounds)
    texts = scanned.filter(is_unknown).groupBy("key").agg(F.first("mentions").alias("mentions"))
    places = texts.select("key", F.inline(F.filter("mentions", lambda m: m["kind"] < 0))).drop("kind", "patterns")
    added = (
        _salted(places, accepted, "instance", F.xxhash64("key"))
        .groupBy("key")
        .agg(F.collect_set(F.struct((F.col("kind") + len(KINDS)).alias("kind"), "start", "stop")).alias("added"))
    )
    plain = scanned.select("row", "base", F.lit(None).cast(SPANS).alias("added"), "key", "mentions")
    some = plain.filter(is_unknown).select("row", "base", "key")
    every = plain.filter(~is_unknown).select("row", "base", "added").unionByName(
        _salted(some, added, "key", F.floor(F.rand(0) * SALTS), "left").select("row", "base", "added")
    )
    all_spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", F.array_sort("added")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return every.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in out],
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_context"),
        _joined(F.col("base")).alias("base_spans"),
        _joined(all_spans).alias("spans"),
    )
