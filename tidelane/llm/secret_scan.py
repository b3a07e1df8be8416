"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Base kinds, leftmost and non-overlapping per kind: ``assign`` (a password, secret, token or key name, a colon or
equals sign and a value), ``access`` (access key ids), ``hex`` (long hexadecimal runs). Added kinds, per character
class: a candidate is a maximal run of the class; a window slides over it while the counts of its characters
are kept up to date, and the run gives one span, from the first to the end of the last window whose
entropy reaches the class's threshold. Candidates that match an allow-list pattern give none. Entropies are sums of
``c * log2(c)`` taken from a table of whole numbers, so they do not drift and do not depend on the order.

All of it is built-in array and text functions on one row: no shuffle, no Python. Null and empty
texts have no spans. Spans of different kinds may overlap. Extra columns pass through; those named
like an output column are replaced. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import packed, quoted, unpacked
from tidelane.llm.sql_arrays import let, matches, upto

# The base patterns and the least length of what they find.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    """["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = "AKIA[A-Z0-9]+", "[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
BASE_KINDS = ("assign", "access", "hex")

#: Whole-number unit of the entropy sums.
UNIT = 1 << 20


@dataclass(frozen=True)
class CharacterClass:
    """A kind of candidate: its characters, the window's length and the least entropy in bits."""

    kind: str
    alphabet: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        inside = self.alphabet.replace("-", "") + ("-" if "-" in self.alphabet else "")
        return f"[{inside}]{{{self.window},}}"

    @property
    def most(self) -> int:
        """Largest sum of c * log2(c), in units, of a window that reaches the threshold."""
        return math.floor((math.log2(self.window) - self.bits) * self.window * UNIT)

    @property
    def table(self) -> list[int]:
        """c * log2(c) in units for c = 0 to the window's length."""
        return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(self.window + 2)]


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    CharacterClass("entropy_hex", _DIGITS + "abcdefABCDEF", 20, 3.0),
    CharacterClass("entropy_base64", _DIGITS + _LOWER + _UPPER + "+/_=-", 24, 3.9),
)
#: Candidates that are no secrets: numbers, words in one case, placeholders and counting strings.
ALLOWED = ("^[0-9]+$", "^[A-Z]?[a-z_-]+$", "^[A-Z_-]+$", "EXAMPLE", "xxxx", "0123456789", "abcdefgh")


def base_spans(text: Column) -> Column:
    """Array of (start, order of the kind, end)."""

    def spans(order: int, pattern: str, least: int, size=F.length) -> Column:
        kept = F.filter(matches(text, pattern), lambda m: size(m["match"]) >= least)
        return F.when(F.rlike(text, F.lit(pattern)), F.transform(kept, lambda m: _span(m["start"], order, m["match"])))

    value = lambda m: F.length(F.regexp_extract(m, f"^{ASSIGN}$", 2))
    # runs are maximal, so a shorter one hides no longer one: the least length can be in the pattern
    found = [
        spans(0, ASSIGN, ASSIGN_LENGTH, value),
        spans(1, ACCESS.replace("+", f"{{{ACCESS_LENGTH - 4},}}"), ACCESS_LENGTH),
        spans(2, HEX.replace("+", f"{{{HEX_LENGTH},}}"), HEX_LENGTH),
    ]
    return F.concat(*[F.coalesce(x, _none()) for x in found])


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")


def _span(start: Column, kind: int, match: Column) -> Column:
    return F.struct(
        start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(match)).cast("long").alias("stop")
    )


def high_windows(run: Column, kind: CharacterClass) -> Column:
    """(first, last) place of the windows of a run that reach the threshold; null if none does.

    One pass over the characters: a character that enters raises its count, the one that leaves
    lowers its own, and the sum of c * log2(c) changes by the differences of the table.
    """
    table = F.array(*[F.lit(x).cast("long") for x in kind.table])
    # a count is at most the window's length and never below zero
    change = lambda count, by: F.get(table, count + by) - F.get(table, count)
    start = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    place = lambda char: F.position(char, F.lit(kind.alphabet)) - 1

    def step(places: Column):
        def move(state: Column, i: Column) -> Column:
            enter, leave = F.get(places, i), F.get(places, i - kind.window)

            def counted(without: Column, entered: Column) -> Column:
                lowered = F.when(leave.isNull(), state["sum"]).otherwise(
                    state["sum"] + change(F.get(state["counts"], leave), -1)
                )
                sums = lowered + change(entered, 1)
                at = i - (kind.window - 1)
                high = (at >= 0) & (sums <= kind.most)
                return F.struct(
                    F.transform(without, lambda c, k: c + F.when(k == enter, 1).otherwise(0)).alias("counts"),
                    sums.alias("sum"),
                    F.when(high & (state["first"] < 0), at).otherwise(state["first"]).alias("first"),
                    F.when(high, at).otherwise(state["last"]).alias("last"),
                )

            without = F.transform(state["counts"], lambda c, k: c - F.when(k == leave, 1).otherwise(0))
            return let(without, lambda w: let(F.get(w, enter), lambda entered: counted(w, entered)))

        return move

    def walked(places: Column) -> Column:
        return F.aggregate(upto(F.size(places)), start, step(places))

    found = let(F.transform(F.filter(F.split(run, ""), lambda c: c != ""), place), walked)
    return let(found, lambda s: F.when(s["first"] >= 0, F.struct(s["first"].alias("first"), s["last"].alias("last"))))


def entropy_spans(text: Column, kind: CharacterClass, order: int, allowed: tuple[str, ...]) -> Column:
    """Array of (start, order of the kind, end) of one character class."""
    real = lambda m: ~F.rlike(m["match"], F.lit("|".join(allowed))) if allowed else F.lit(True)
    windows = F.transform(
        F.filter(matches(text, kind.pattern), real),
        lambda m: let(
            high_windows(m["match"], kind),
            lambda w: F.struct(
                (m["start"] + w["first"]).cast("long").alias("start"),
                F.lit(order).alias("kind"),
                (m["start"] + w["last"] + kind.window).cast("long").alias("stop"),
            ),
        ),
    )
    found = F.filter(windows, lambda s: s["start"].isNotNull())
    return F.coalesce(F.when(F.rlike(text, F.lit(kind.pattern)), found), _none())


def _joined(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*map(F.lit, kinds))
    said = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"]))
    return F.array_join(said, ",")


COLUMNS = [*(f"n_{name}" for name in BASE_KINDS), "n_entropy", "base_spans", "spans"]


def _scanned(docs: DataFrame, text: str, classes: tuple[CharacterClass, ...], allowed: tuple[str, ...], without=()) -> DataFrame:
    """``row``, ``text``, and the sorted spans ``base`` and ``added``."""
    rows = packed(docs, without, text=F.coalesce(F.col(quoted(text)), F.lit("")))
    whole = F.col("text")
    return rows.withColumn("base", F.sort_array(base_spans(whole))).withColumn(
        "added",
        F.sort_array(F.concat(_none(), *[entropy_spans(whole, c, 3 + i, allowed) for i, c in enumerate(classes)])),
    )


def _every() -> Column:
    return F.when(F.size("added") == 0, F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """Add ``n_assign``, ``n_access``, ``n_hex``, ``n_entropy``, ``base_spans`` and ``spans``
    (``kind:start:end``, comma-joined, by start and then kind)."""
    kinds = [*BASE_KINDS, *(c.kind for c in classes)]
    found = _scanned(docs, text, classes, allowed, COLUMNS)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    made = [*(count(i) for i in range(len(BASE_KINDS))), F.size("added").cast("long"), _joined(F.col("base"), kinds), _joined(_every(), kinds)]
    return found.select(*unpacked(found, docs, COLUMNS), *[c.alias(name) for name, c in zip(COLUMNS, made)])


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with each stretch that sorted spans cover replaced by ``mask``."""
    start = F.struct(F.lit("").alias("said"), F.lit(0).cast("long").alias("at"))
    between = lambda a, n: F.substring(text, (a + 1).cast("int"), n.cast("int"))

    def step(state: Column, s: Column) -> Column:
        apart = F.concat(state["said"], between(state["at"], s["start"] - state["at"]), F.lit(mask))
        return F.struct(
            F.when(s["start"] < state["at"], state["said"]).otherwise(apart).alias("said"),
            F.greatest(state["at"], s["stop"]).alias("at"),
        )

    return F.aggregate(spans, start, step, lambda s: F.concat(s["said"], between(s["at"], F.length(text))))


def redacted(
    docs: DataFrame,
    text: str = "text",
    mask: str = "[secret]",
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """All documents, columns as they came, with the secrets of their texts replaced by ``mask``. A null text stays null."""
    found = _scanned(docs, text, classes, allowed)
    spans = _every()
    clean = F.when(F.size(spans) > 0, masked(F.col("text"), spans, mask)).otherwise(found["row"].getField(text))
    return found.select(*[clean.alias(c) if c == text else kept for c, kept in zip(docs.columns, unpacked(found, docs))])


def without_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no kind of secret is found, columns as they came."""
    scanned = scan_secrets(docs.select(F.struct("*").alias("_row"), F.col(text).alias("text")))
    return scanned.filter(F.col("spans") == "").select("_row.*")
