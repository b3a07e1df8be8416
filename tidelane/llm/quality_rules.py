"""Quality rules with thresholds that adapt to each language and source.

Counts per text feed whole-number rates. A mergeable sketch per (lang, source) and rate counts the documents in
buckets whose width is at most a 32nd of the value, so sketches merge by adding counts: those of all sources
of a language, and of all documents, are sums of the small ones. Quartiles from the sketch give fences, ``Q3 + reach * spread`` and, for
word length, ``Q1 - reach * spread`` as well, with spread the distance of the quartiles or a floor. A group's fences are
drawn towards those of its language, and a language's towards those of all documents, as if ``weight`` documents more were
there: the mean of both, weighted by the group's documents and ``weight``. So small groups lean on larger ones and no number of documents is a
threshold. The fences are joined to the documents, and a document outside any of them, or failing the two base rules, is not kept.

All of it is built-in functions and joins. Words are runs of other than the six ASCII white space characters. Null
texts count as empty: no words, base rule failed. Null languages and sources form groups of
their own. Repeated ids are judged row by row. Only the counts are shuffled, never the texts, and a source with
a third of all rows costs its number of buckets after partial sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.functions.lineage import settle
from tidelane.llm.frames import packed, quoted, unpacked
from tidelane.llm.sql_arrays import let, upto

# White space, symbols and the base rules.
WHITE = "[\\x20\\x09-\\x0D]+"
NO_SYMBOL = "[^#*$%&|<>]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
LEAST_WORDS, MOST_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class Rate:
    """A rate per thousand: numerator and denominator in SQL, least spread, and whether low values fail too."""

    name: str
    numerator: str
    denominator: str
    floor: int
    both_sides: bool = False


# The four lines added to a text's own soften the share of repeated lines in texts of few lines.
RATES = (
    Rate("word_length", "word_chars", "n_words", 500, both_sides=True),
    Rate("symbols", "n_symbols", "n_words", 100),
    Rate("dup_lines", "n_dup_lines", "n_lines + 4", 100),
    Rate("repeats", "n_repeat_words", "n_words", 100),
)


@dataclass(frozen=True)
class Settings:
    reach: int = 3
    #: documents that the fences of the level above count for
    weight: int = 200
    rates: tuple[Rate, ...] = RATES


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Number of words in windows of three words that occur twice or more.

    Hashes of the windows tell whether any may occur twice; only then are the windows
    themselves sorted with their places, so equal ones are neighbours.
    """

    def windows(w: Column, join) -> Column:
        n = F.size(w)
        pairs = F.zip_with(F.slice(w, F.lit(1), n - 2), F.slice(w, F.lit(2), n - 2), join)
        return F.zip_with(pairs, F.slice(w, F.lit(3), n - 2), join)

    def covered(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        places = lambda x: [x["i"], x["i"] + 1, x["i"] + 2]
        twice = F.zip_with(
            F.slice(sorted_windows, F.lit(1), n - 1),
            F.slice(sorted_windows, F.lit(2), n - 1),
            lambda a, b: F.when(a["window"] == b["window"], F.array(*places(a), *places(b))),
        )
        return F.size(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))

    def exact(w: Column) -> Column:
        placed = F.zip_with(
            windows(w, lambda a, b: F.concat(a, F.lit(" "), b)),
            upto(F.size(w) - 2),
            lambda window, i: F.struct(window.alias("window"), i.alias("i")),
        )
        return let(F.sort_array(placed), covered)

    def counted(w: Column) -> Column:
        distinct = F.size(F.array_distinct(windows(w, lambda a, b: F.xxhash64(a, b))))
        return F.when(F.size(w) < 3, 0).when(distinct == F.size(w) - 2, 0).otherwise(exact(w))

    return let(words, counted).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` and ``n_repeat_words``, all long."""
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    in_words = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeats")))
    rows = packed(docs, COUNTS, text=whole).withColumns({"lines": counts, "words": in_words})
    return rows.select(
        *unpacked(rows, docs, COUNTS),
        F.col("words.n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", WHITE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NO_SYMBOL, "")).cast("long").alias("n_symbols"),
        F.col("lines.n").cast("long").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.distinct")).cast("long").alias("n_dup_lines"),
        F.col("words.repeats").alias("n_repeat_words"),
    )


def rate(r: Rate) -> Column:
    """Whole rate per thousand; null without words."""
    return F.expr(f"CASE WHEN n_words > 0 THEN (1000 * {r.numerator}) DIV ({r.denominator}) END")


def bucket(value: Column) -> Column:
    """Bucket of a whole number: exact below 64, then 32 buckets for each doubling."""
    over = F.length(F.bin(value)) - 6
    return F.when(value < 32, value).otherwise(over * 32 + F.call_function("shiftright", value, over)).cast("long")


def bucket_top(number: Column) -> Column:
    """Largest whole number of a bucket."""
    over = F.floor(number / 32).cast("int") - 1
    inside = number - over * 32 + 1
    return F.when(number < 64, number).otherwise(F.call_function("shiftleft", inside, over) - 1)


def sketches(measured: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per group, rate and bucket with the number of documents. ``level`` is 0 for (lang, source),
    1 for a language, 2 for all; the upper levels are sums of the first."""
    pairs = [F.struct(F.lit(r.name).alias("rate"), bucket(rate(r)).alias("bucket")) for r in settings.rates]
    small = (
        measured.filter("n_words > 0")
        .select("lang", "source", F.explode(F.array(*pairs)).alias("_pair"))
        .groupBy("lang", "source", "_pair.rate", "_pair.bucket")
        .agg(F.count("*").alias("n"))
    )
    none = F.lit(None).cast("string")
    group = lambda level, lang, source: F.struct(
        F.lit(level).alias("level"), lang.alias("lang"), source.alias("source")
    )
    lang, source = F.col("lang"), F.col("source")
    levels = F.array(group(0, lang, source), group(1, lang, none), group(2, none, none))
    return (
        small.select(F.explode(levels).alias("_group"), "rate", "bucket", "n")
        .groupBy("_group.level", "_group.lang", "_group.source", "rate", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def quartiles(sketch: DataFrame) -> DataFrame:
    """Lower and upper quartile per group and rate. A window holds one group's buckets, whose number
    is bounded by the buckets' layout, not by the documents."""
    group = W.partitionBy("level", "lang", "source", "rate")
    upto_here = F.sum("n").over(group.orderBy("bucket"))
    total = F.sum("n").over(group)
    return (
        sketch.withColumns({"_upto": upto_here, "_total": total})
        .groupBy("level", "lang", "source", "rate")
        .agg(
            F.max("_total").alias("documents"),
            F.min(F.when(F.col("_upto") * 4 >= F.col("_total"), F.col("bucket"))).alias("_q1"),
            F.min(F.when(F.col("_upto") * 4 >= F.col("_total") * 3, F.col("bucket"))).alias("_q3"),
        )
        .select(
            "level", "lang", "source", "rate", "documents",
            bucket_top(F.col("_q1")).alias("q1"), bucket_top(F.col("_q3")).alias("q3"),
        )
    )


def fences(sketch: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per (lang, source) with ``<rate>_low`` and ``<rate>_high``, from the group's own sketch, its
    language's and that of all documents."""
    per_rate = []
    for r in settings.rates:
        mine = F.col("rate") == r.name
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(r.floor).cast("long")) * settings.reach
        per_rate.append(F.max(F.when(mine, F.col("q3") + spread)).alias(f"{r.name}_high"))
        if r.both_sides:
            per_rate.append(F.max(F.when(mine, F.greatest(F.col("q1") - spread, F.lit(0)))).alias(f"{r.name}_low"))
    names = [f"{r.name}_{side}" for r in settings.rates for side in ("high", "low") if side == "high" or r.both_sides]
    wide = quartiles(sketch).groupBy("level", "lang", "source").agg(F.max("documents").alias("documents"), *per_rate)
    of = lambda level: wide.filter(F.col("level") == level)
    own, languages, whole = of(0).withColumn("last", F.lit(2)).alias("own"), of(1).alias("up"), of(2).alias("top")
    exact = lambda c: c.cast("decimal(18,0)")

    def drawn(side: str, name: str, above: Column) -> Column:
        n, weight = exact(F.col(f"{side}.documents")), F.lit(settings.weight)
        return F.call_function("div", n * exact(F.col(f"{side}.{name}")) + exact(above) * weight, n + weight)

    return (
        own.join(languages, F.col("own.lang").eqNullSafe(F.col("up.lang")), "left")
        .join(F.broadcast(whole), F.col("own.last") == F.col("top.level"), "left")  # one row
        .select("own.lang", "own.source", *[drawn("own", n, drawn("up", n, F.col(f"top.{n}"))).alias(n) for n in names])
    )


def judge(measured: DataFrame, bounds: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``base_failed`` and ``kept``. ``measured`` and ``bounds`` meet on language and source, nulls included."""
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words")
    )
    inside = F.lit(True)
    for r in settings.rates:
        inside = inside & (rate(r) <= F.col(f"{r.name}_high"))
        if r.both_sides:
            inside = inside & (rate(r) >= F.col(f"{r.name}_low"))
    limits = bounds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"])
    return (
        measured.join(limits, same, "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .select(*measured.columns, "base_failed", "kept")
    )


def quality_rules(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Counts and verdict per document: all columns but the text, the counts of ``measure``,
    ``base_failed`` and ``kept``. The counts are materialised once and read by sketch and join."""
    new = (*COUNTS, "base_failed", "kept")
    rows = packed(docs, (*new, text), lang=F.col("lang"), source=F.col("source"), text=F.col(quoted(text)))
    measured = settle(measure(rows).drop("text"))
    judged = judge(measured, fences(sketches(measured, settings), settings), settings)
    return judged.select(*unpacked(judged, docs, (*new, text)), *new)
