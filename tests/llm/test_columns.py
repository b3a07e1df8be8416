"""No column of the caller is lost, overwritten or in the way, whatever its name."""

from __future__ import annotations

import inspect
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import edges
from tidelane.functions import running
from tidelane.llm import (
    bpe, frames, graph, mixing, ngram_join, personal_data, quality_classifier, quality_rules, secret_scan, sharding, token_count, toxicity,
)

BASE = ["doc_id", "text", "lang", "source"]
OUT = {
    "op1": lambda d, labels: bpe.bpe_round_trip(d, public_tokenizers.path("byte_bpe_50k.json")),
    "op2": lambda d, labels: token_count.token_counts(d, public_tokenizers.path("piece_bpe_32k.model")),
    "op3": lambda d, labels: secret_scan.scan_secrets(d),
    "op5": lambda d, labels: ngram_join.ngram_join(d),
    "op6": lambda d, labels: quality_rules.quality_rules(d),
    "op7": lambda d, labels: quality_classifier.classify_quality(d, labels),
    "op8": lambda d, labels: sharding.feistel_shards(d),
    "op9": lambda d, labels: mixing.mix(d),
    "op10": lambda d, labels: toxicity.toxicity(d, labels),
    "op12": lambda d, labels: personal_data.personal_data(d),
    "near_copies_removed": lambda d, labels: ngram_join.near_copies_removed(d),
    "without_secrets": lambda d, labels: secret_scan.without_secrets(d),
    "mixed_documents": lambda d, labels: mixing.mixed_documents(d),
    "measure": lambda d, labels: quality_rules.measure(d),
}
MODULES = [
    bpe, frames, graph, mixing, ngram_join, personal_data, quality_classifier, quality_rules, secret_scan, sharding, token_count, toxicity,
    running, corpus_pipeline,
]


def helper_names() -> list[str]:
    """Every word in quotes in the modules that could be a column's name."""
    words = set()
    for module in MODULES:
        words |= set(re.findall(r"""["']([a-z_][a-z_0-9]{0,20})["']""", inspect.getsource(module)))
        words |= set(re.findall(r"""\b([a-z_]+)=F\.""", inspect.getsource(module)))
    return sorted(words - set(BASE))


def test_the_names_are_found():
    assert {"_fp", "_sig", "_key", "_one", "_row", "row", "base", "added", "at", "_slice", "_upto", "copies"} <= set(helper_names())


@pytest.mark.parametrize("name", list(OUT))
def test_columns_named_like_helpers_pass_through(spark, name):
    plain = edges.documents(spark).select(*BASE).withColumn("n_chars", F.length("text"))
    extra = [c for c in helper_names() if c != "n_chars"]
    mark = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.md5("text"), F.lit("-")))
    whole = "a.b" if name not in ("op1", "op2", "op7", "op10") else "a b"  # Spark's own mapInArrow takes no dots
    named = plain.select("*", *[F.concat(F.lit(f"{c}|"), mark).alias(c) for c in extra], mark.alias(whole))
    labels = edges.labels(spark)
    got, want = OUT[name](named, labels), OUT[name](plain, labels)
    made = [c for c in want.columns if c not in plain.columns]
    kept = [c for c in extra if c not in made] + [whole]
    assert set(got.columns) == set(want.columns) | set(kept)
    rows = got.collect()
    assert rows
    for r in rows:
        wrong = [c for c in kept if r[c] != (f"{c}|" if c != whole else "") + r[whole]]
        assert wrong == []
    results = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert results(got) == results(want)
