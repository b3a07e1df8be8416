"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks.

Each source's documents, in an order shuffled by a digest of their id, form a stream of words that is cut into blocks
of ``block`` words (the last may be shorter). The schedule has one slot per block taken. Cumulative slot
counts of the sources divide a line of points; the van der Corput sequence visits the points, slot ``k`` taking the
point whose bits are those of ``k`` reversed, so every stretch of the schedule holds each source in its proportion. A
slot's rank among its source's slots follows from the bits alone, without a window over the
source: it takes block ``rank mod blocks`` on lap ``rank div blocks``, and the last slot is cut where the
target is met. Documents get the words of the slots that took their blocks, the first of these slots and their
number: the order of the mix. ``mixed_documents`` writes its rows in that order, each copy at the first slot of its lap.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share all words; a target stops
at three times its source's size, the rest being shared anew by weight. Null texts have no words; documents
without words are never taken. Rows equal in id and size are interchangeable. An empty table gives an empty table.
Nothing gathers a source: offsets are running totals over ranges, slots are made in chunks, blocks are joined by
source and number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.functions.lineage import settle
from tidelane.functions.running import running_sums
from tidelane.llm.frames import packed, quoted, unpacked

WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Settings:
    #: words of a block
    block: int = 512
    weights: tuple[int, ...] = (5, 2, 1)
    #: most times that a source, and so a document, is taken
    repeats: int = 3
    seed: str = "mix-1"
    #: slots that one row makes
    chunk: int = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per source: ``number`` by code point, ``source_size``, ``start`` (words of the sources before it), ``weight``,
    ``target`` and ``quota`` (whole words of the target).

    The limit of shares per unit of weight that fills the total is found on the sources in order of the limit at
    which they are full: a source is full if the limit left by those before it reaches its own.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).cast("long").alias("_one"))
    numbered = running_sums(
        sources, {"_number": "_one", "_upto": "source_size"}, [F.col("source").asc_nulls_last()]
    )
    weight = F.get(F.array(*map(F.lit, settings.weights)), (F.col("_number") - 1) % len(settings.weights))
    weighed = numbered.select(
        "source",
        "source_size",
        (F.col("_number") - 1).alias("number"),
        (F.col("_upto") - F.col("source_size")).alias("start"),
        weight.cast("long").alias("weight"),
        (F.col("source_size") * settings.repeats).alias("_most"),
    )
    full_at = F.col("_most") / F.col("weight")
    filled = running_sums(weighed, {"_mosts": "_most", "_weights": "weight"}, [full_at.asc(), F.col("number").asc()])
    exact = lambda c: c.cast("decimal(19,0)")
    total = F.expr(f"_mosts_total DIV {settings.repeats}")
    left = total - (F.col("_mosts") - F.col("_most"))
    weight_left = F.col("_weights_total") - (F.col("_weights") - F.col("weight"))
    full = exact(F.col("_most")) * exact(weight_left) <= exact(F.col("weight")) * exact(left)
    marked = filled.select(*weighed.columns, full.alias("_full"), total.alias("_total"))
    words = F.max("_total") - F.sum(F.when(F.col("_full"), F.col("_most")).otherwise(0))
    rest = marked.agg(F.struct(words.alias("words"), F.sum(F.when(~F.col("_full"), F.col("weight"))).alias("weight")))
    left_over = rest.scalar()
    share = (F.col("weight") * left_over["words"]).cast("double") / left_over["weight"].cast("double")
    target = F.when(F.col("_full"), F.col("_most").cast("double")).otherwise(share)
    return (
        marked.withColumn("target", target)
        .select("source", "source_size", "number", "start", "weight", "target", F.floor("target").alias("quota"))
    )


def slot_ranges(targets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``low`` and ``high``, the source's points, and ``bits``, the length of all slot numbers."""
    blocks = F.ceil(F.col("source_size") / settings.block)
    counted = targets.withColumn("blocks", blocks.cast("long")).withColumn(
        "slots",
        F.when(
            F.col("source_size") > 0,
            F.expr("(quota DIV source_size) * blocks") + F.ceil(F.expr("quota % source_size") / settings.block),
        )
        .otherwise(0)
        .cast("long"),
    )
    ranged = running_sums(counted, {"high": "slots"}, [F.col("number").asc()])
    return ranged.withColumns(
        {"low": F.col("high") - F.col("slots"), "bits": F.length(F.bin(F.greatest(F.col("high_total"), F.lit(2)) - 1))}
    ).drop("high_total")


def _bits(number: Column, bits: Column, add) -> Column:
    """Sum of ``add(bit)`` over the bits of a number that are set."""
    return F.aggregate(
        F.sequence(F.lit(0), bits - 1),
        F.lit(0).cast("long"),
        lambda total, b: total
        + F.when(F.call_function("shiftright", number, b) % 2 == 1, add(b)).otherwise(F.lit(0).cast("long")),
    )


def schedule(ranges: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The slots: ``slot`` (order in the mix; numbers may have gaps), ``number``, ``block``, ``lap`` and
    ``until``, the place in the source's stream where the slot's share of the block ends.

    A slot's rank is the number of its source's points whose reversed bits are smaller. These agree with it in
    the bits below some bit that is set in the slot's own point and clear in theirs, and for each
    such bit they are the points of one residue class, which a range holds at even distances.
    """
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(high - low - 1) DIV {settings.chunk}"))
    cut = (
        ranges.filter("high > low")
        .select("number", "source_size", "quota", "blocks", "low", "high", "bits", F.explode(chunks).alias("_chunk"))
        .repartition("number", "_chunk")
    )
    first = F.col("low") + F.col("_chunk") * settings.chunk
    points = cut.withColumn(
        "point", F.explode(F.sequence(first, F.least(first + settings.chunk, F.col("high")) - 1))
    )
    power = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)

    def earlier(b: Column) -> Column:
        residue = F.col("point") % power(b)
        upto = lambda x: F.call_function("shiftright", x - 1 - residue, b + 1)
        return upto(F.col("high")) - upto(F.col("low"))

    ranked = points.select(
        "number",
        "source_size",
        "quota",
        "blocks",
        _bits(F.col("point"), F.col("bits"), lambda b: power(F.col("bits") - 1 - b)).alias("slot"),
        _bits(F.col("point"), F.col("bits"), earlier).alias("rank"),
    )
    block = F.col("rank") % F.col("blocks")
    lap_left = F.col("quota") - F.expr("rank DIV blocks") * F.col("source_size")
    return ranked.select(
        "slot",
        "number",
        block.alias("block"),
        F.expr("rank DIV blocks").alias("lap"),
        F.least((block + 1) * settings.block, F.col("source_size"), lap_left).alias("until"),
    )


def mix(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns but the text, with ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix
    takes of a document, ``first_slot`` and ``n_slots``, the first slot that takes some of them and the number of such slots, and
    ``lap_slots``, the first slot of each lap; null, 0 and empty if none does."""
    new = ("size", "source_size", "target", "taken", "first_slot", "n_slots", "lap_slots")
    key = F.md5(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(quoted(id)).cast("string"), F.lit(""))).cast("binary"))
    sized = settle(
        packed(
            docs,
            (*new, text),
            id=F.col(quoted(id)),
            source=F.col("source"),
            size=word_count(F.col(quoted(text))),
            _key=key,
            _one=F.lit(1).cast("long"),
        )
    )
    ranges = settle(slot_ranges(source_targets(sized, settings), settings))
    order = [F.col("source").asc_nulls_last(), F.col("_key").asc(), F.col("id").asc(), F.col("size").asc()]
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streamed = running_sums(sized, {"_upto": "size", "_row": "_one"}, order, slices).alias("d")
    placed = streamed.join(ranges.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*",
        "s.source_size",
        "s.target",
        F.col("s.number").alias("_source_number"),
        (F.col("d._upto") - F.col("d.size") - F.col("s.start")).alias("_from"),
    )
    wide = settings.block
    first, last = F.expr(f"_from DIV {wide}"), F.expr(f"(_from + size - 1) DIV {wide}")
    pieces = (
        placed.filter("size > 0")
        .select(
            "_row",
            F.col("_source_number").alias("number"),
            "_from",
            "size",
            F.explode(F.sequence(first, last)).alias("block"),
        )
        .select(
            "_row",
            "number",
            "block",
            F.greatest(F.col("_from"), F.col("block") * wide).alias("_a"),
            F.least(F.col("_from") + F.col("size"), (F.col("block") + 1) * wide).alias("_b"),
        )
    )
    # a block is taken once per lap, so few slots meet in one; both sides grow with the words, so none is broadcast
    slots = schedule(ranges, settings).hint("merge")
    overlap = F.least(F.col("_b"), F.col("until")) - F.col("_a")
    met = pieces.join(slots, ["number", "block"]).filter(overlap > 0)
    laps = met.groupBy("_row", "lap").agg(F.sum(overlap).alias("words"), F.min("slot").alias("slot"), F.count("*").alias("slots"))
    taken = laps.groupBy("_row").agg(
        F.sum("words").alias("taken"),
        F.min("slot").alias("first_slot"),
        F.sum("slots").alias("n_slots"),
        F.transform(F.array_sort(F.collect_list(F.struct("lap", "slot"))), lambda x: x["slot"]).alias("lap_slots"),
    )
    found = placed.join(taken.hint("merge"), "_row", "left")
    none = F.lit(0).cast("long")
    return found.select(
        *unpacked(found, docs, (*new, text)),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", none).alias("taken"),
        "first_slot",
        F.coalesce("n_slots", none).alias("n_slots"),
        F.coalesce("lap_slots", F.array().cast("array<bigint>")).alias("lap_slots"),
    )


def mixed_documents(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows as often as the mix takes them and in its order, columns as they came. Where the quota cuts a document, it stays if half
    of it or more is taken. Equal rows share one count. Rows are dealt by ranges of slots and sorted, so a stretch of the written
    files holds the sources in their proportions."""
    named, whole = F.col(quoted(id)), F.col(quoted(text))
    key = F.xxhash64(named, F.col("source"), whole)
    mixed = mix(docs.select(named.alias("id"), "source", whole.alias("text"), key.alias("at")), settings, "id", "text")
    taken = mixed.filter("taken > 0").withColumn("copies", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int"))
    slots = F.slice("lap_slots", F.lit(1), F.col("copies"))
    counts = taken.groupBy("at", "id").agg(F.flatten(F.collect_list(slots)).alias("slots"))
    keyed = packed(docs, at=key, id=named).alias("d")
    wanted = counts.filter(F.size("slots") > 0).hint("merge").alias("c")
    same = (F.col("d.at") == F.col("c.at")) & F.col("d.id").eqNullSafe(F.col("c.id"))
    one = keyed.join(wanted, same).select("d.row", "d.at", "d.id", "c.slots").dropDuplicates(["at", "id"])
    every = one.withColumn("slot", F.explode("slots")).repartitionByRange("slot").sortWithinPartitions("slot")
    return every.select(*unpacked(every, docs))
