from __future__ import annotations

import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from tests.llm import edges
from tidelane.llm import bpe, token_count

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("ab  \n\t'sS12é²ßЖ½Ⅷ.,!\x1c\x85\xa0 　漢字😀🏽|") + ["'ll", "   ", "\n\n", "the", "ing", " of"]


def texts(n: int, extra: list[str]) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choices(PARTS + extra, k=rng.randint(0, 30))) for _ in range(n)]


def test_ids_and_text_as_the_tokenizers_library():
    own, library = bpe.encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for text in [*texts(3000, ["<|endoftext|>", "<|endof"]), "a" * 5000, "ab" * 3000 + "<|endoftext|>"]:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = own.encode(text)
        assert packed == struct.pack(f"<{len(ids)}I", *ids), repr(text)
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_cut_sequences_decode_as_the_library_does():
    own, library = bpe.encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    ids = library.encode("漢字😀é", add_special_tokens=False).ids
    for a in range(len(ids)):
        part = ids[a : a + 2]
        assert own.decode(struct.pack(f"<{len(part)}I", *part)) == library.decode(part, skip_special_tokens=False)


def test_counts_as_a_unigram_tokenizer():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    library, own = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True)), token_count.counter(PIECES)
    for text in [*texts(3000, []), "internationalization " * 50, "▁▁ x"]:
        spaced = token_count.SPACE + text.replace(" ", token_count.SPACE)
        assert own.count(text) == (len(library.encode(spaced, add_special_tokens=False).ids) if text else 0), repr(text)


def test_ties_go_to_the_earliest_start():
    own = token_count.Unigram([("▁", 0), ("a", 0), ("b", 0), ("ab", 0)])
    assert own.count("ab") == 2  # a piece of both letters is as good as two pieces


@pytest.mark.parametrize("rows", [edges.documents, edges.empty])
def test_awkward_rows(spark, rows):
    docs = rows(spark)
    tokens = bpe.bpe_round_trip(docs, BYTE_BPE)
    assert tokens.columns.count("token_ids") == 1 and "lang" in tokens.columns
    given = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted((str(r.doc_id), r.decoded) for r in tokens.collect()) == given
    again = bpe.bpe_decode(bpe.bpe_encode(docs, BYTE_BPE), BYTE_BPE)
    assert sorted((str(r.doc_id), r.decoded) for r in again.collect()) == given
    counted = token_count.token_counts(docs, PIECES)
    assert sorted((str(r.doc_id), r.n_tokens) for r in counted.collect()) == sorted(
        (i, token_count.counter(PIECES).count(t)) for i, t in given
    )


def test_long_parts_are_counted_as_streams(monkeypatch):
    own = token_count.counter(PIECES)
    for text in [*texts(2000, ["internationalization", "the", "ing"]), "ab" * 900]:
        part = token_count.SPACE + text.replace(" ", "")
        assert own.streamed(part) == own.viterbi(part), repr(text)
    long = "".join(random.Random(1).choices("abcdefghijklmnop", k=30_000))
    streamed = own.viterbi(long)
    monkeypatch.setattr(token_count, "LONG", 10**9)
    assert streamed == own.viterbi(long)


def test_memory_of_a_long_text_without_spaces():
    import tracemalloc

    own, text = token_count.counter(PIECES), "abcdefghij" * 100_000
    tracemalloc.start()
    own.count(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * len(text)
