"""Token counts of a unigram tokenizer without building the tokens.

For each place of a text, Aho-Corasick lists the vocabulary's pieces that end there; the best score up to a place, and the
number of pieces on the best way, are carried along (Viterbi without back pointers). Tie rules are those of the unigram
tokenizers: ways are compared in order of where their last piece starts, the earliest first, and a later one
wins only with a strictly higher score; where no single character piece starts, the unknown piece of one character,
scored ten below the least piece, comes last among those of its start; with byte fallback it counts as its UTF-8 bytes.

Text: spaces become U+2581, one more is put in front, as in the vocabulary's own tokenizer. A text is cut where no
piece can cross: before a run of spaces, and around characters that occur in no longer piece. Scores are whole
numbers, so sums are exact and a cut changes no comparison; the counts of short parts are kept in a bounded table.

A part without a cut, however long, is counted in the memory of its text and the longest piece.

Null and empty texts have no tokens. Extra columns pass through; one named like the output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidelane.llm.frames import mapped

SPACE = "▁"
KEPT, KEPT_LENGTH = 300_000, 48
#: Parts beyond this length are counted as a stream, with the same result.
LONG = 4096
#: What the unknown piece scores below the least piece.
UNKNOWN = 10


class Unigram:
    """Pieces with whole-number scores; ``fallback`` says whether unknown characters count as bytes."""

    def __init__(self, pieces: Iterable[tuple[str, int]], fallback: bool = True):
        self.scores = dict(pieces)
        self.fallback = fallback
        self.unknown = min(self.scores.values()) - UNKNOWN
        self.longest = max(map(len, self.scores))
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        joined = set("".join(p for p in self.scores if len(p) > 1))
        # a space inside a piece, after another character, would let pieces cross the cuts
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("pieces with spaces inside are not supported")
        self.alone = re.compile("([^" + re.escape("".join(sorted(joined))) + "])")
        # line breaks are cut off at once where they may be, so words at line ends are known parts too
        line = "" if "\n" in joined else "\n"
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + ("|\n" if line else ""), re.S)
        self.known: dict[str, int] = {}

    def streamed(self, part: str) -> int:
        """``viterbi`` for a long part: matches come in order of their ends, so only as many scores are kept as the longest
        piece has characters, and the matches of one end."""
        width = self.longest + 1
        best, count = [0] * width, [0] * width
        matches = self.automaton.iter(part)
        ahead = next(matches, None)
        for end in range(1, len(part) + 1):
            ways = []
            while ahead is not None and ahead[0] == end - 1:
                length, score = ahead[1]
                ways.append((end - length, score))
                ahead = next(matches, None)
            ways.sort()
            top, pieces = None, 0
            for start, score in ways:
                if top is None or best[start % width] + score > top:
                    top, pieces = best[start % width] + score, count[start % width] + 1
            if not ways or ways[-1][0] != end - 1:
                cost = len(part[end - 1].encode()) if self.fallback else 1
                if top is None or best[(end - 1) % width] + self.unknown > top:
                    top, pieces = best[(end - 1) % width] + self.unknown, count[(end - 1) % width] + cost
            best[end % width], count[end % width] = top, pieces
        return count[len(part) % width]

    def viterbi(self, part: str) -> int:
        """Number of tokens of a part that no piece crosses the ends of."""
        n = len(part)
        if n > LONG:
            return self.streamed(part)
        ending: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for last, (length, score) in self.automaton.iter(part):
            ending[last + 1].append((last + 1 - length, score))
        best, count = [0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top, pieces = None, 0
            ways = sorted(ending[end])
            for start, score in ways:
                if top is None or best[start] + score > top:
                    top, pieces = best[start] + score, count[start] + 1
            if not ways or ways[-1][0] != end - 1:
                cost = len(part[end - 1].encode()) if self.fallback else 1
                if top is None or best[end - 1] + self.unknown > top:
                    top, pieces = best[end - 1] + self.unknown, count[end - 1] + cost
            best[end], count[end] = top, pieces
        return count[n]

    def _split(self, part: str) -> Iterable[str]:
        """The part between and at characters that stand alone, one piece of it at a time."""
        first = 0
        for m in self.alone.finditer(part):
            if m.start() > first:
                yield part[first : m.start()]
            yield m[0]
            first = m.end()
        if first < len(part):
            yield part[first:]

    def _part(self, part: str) -> int:
        known = self.known.get(part)
        if known is None:
            known = sum(self.viterbi(x) for x in self._split(part))
            if len(part) <= KEPT_LENGTH:
                if len(self.known) >= KEPT:
                    self.known.clear()
                self.known[part] = known
        return known

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, part = self.known, self._part
        total = 0
        for x in self.cut.findall(SPACE + text.replace(" ", SPACE)):
            n = known.get(x)
            total += part(x) if n is None else n
        return total


def load(path: str) -> Unigram:
    """The pieces of a SentencePiece model file, with its own scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)
    ids = range(model.get_piece_size())
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids if not special(i)]
    if any(score != int(score) for _, score in pieces):
        raise ValueError(f"{path} has scores that are no whole numbers")
    return Unigram(((p, int(s)) for p, s in pieces), any(model.is_byte(i) for i in ids))


_loaded: dict[str, Unigram] = {}


def counter(path: str) -> Unigram:
    """The counter of a file, made once per Python process."""
    if path not in _loaded:
        _loaded[path] = load(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, text: str = "text", to: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of a text column and drop the text."""

    def start():
        count = counter(path).count
        return lambda batch: [pa.array([count(x) for x in batch.column(text).to_pylist()], pa.int64())]

    return mapped(docs, [T.StructField(to, T.LongType())], start, drop=[text], text=text)
