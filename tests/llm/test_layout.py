from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edges
from tidelane.llm import mixing, sharding


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 15, 16, 17, 100, 1000, 4097])
def test_permutation_is_one_and_has_an_inverse(n):
    one = sharding.Permutation(n)
    places = one.place(np.arange(n))
    assert sorted(places.tolist()) == list(range(n))
    assert one.place_of(places).tolist() == list(range(n))


def test_shards_are_even_and_slots_gapless(spark):
    docs = spark.range(1003).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 50).alias("text"))
    rows = sharding.feistel_shards(docs, 16).collect()
    counts = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(16)}
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(slots == list(range(len(slots))) for slots in counts.values())
    again = sharding.feistel_shards(docs.repartition(7), 16).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    other = sharding.feistel_shards(docs, 16, keys=(1, 2, 3, 4)).collect()
    assert sorted(map(tuple, rows)) != sorted(map(tuple, other))


@pytest.mark.parametrize("rows", [edges.documents, edges.empty])
def test_sharding_awkward_rows(spark, rows):
    docs = rows(spark)
    placed = sharding.feistel_shards(docs, 4)
    assert "lang" in placed.columns and placed.columns.count("size") == 1
    got = placed.collect()
    assert sorted(r.place for r in got) == list(range(docs.count()))
    assert all(r["size"] == 1 and r.text_crc32 == 0 for r in got if r.doc_id in (4, 5))


def test_schedule_keeps_proportions_and_uses_each_block_once_a_lap(spark):
    sizes = spark.createDataFrame([("a", 40_000), ("b", 9_000), ("c", 700), ("d", 0), (None, 5)], "source string, size long")
    targets = mixing.source_targets(sizes)
    by_source = {r.source: r for r in targets.collect()}
    assert abs(sum(r.target for r in by_source.values()) - 49_705) < 1e-6
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in by_source.values())
    assert by_source["c"].target == 2_100 and by_source[None].target == 15  # thrice their size
    assert abs(by_source["a"].target - (49_705 - 2_115) * 5 / 7) < 1e-6
    ranges = mixing.slot_ranges(targets)
    slots = mixing.schedule(ranges).collect()
    assert len({s.slot for s in slots}) == len(slots) == sum(r.slots for r in ranges.collect())
    for r in ranges.collect():
        own = [s for s in slots if s.number == r.number]
        per_block = {b: sum(1 for s in own if s.block == b) for b in range(r.blocks)}
        assert not own or max(per_block.values()) - min(per_block.values()) <= 1
    order = [s.number for s in sorted(slots, key=lambda s: s.slot)]
    share = order.count(0) / len(order)
    for k in range(10, len(order)):
        assert abs(order[:k].count(0) - k * share) < 6  # the star discrepancy is logarithmic


def test_documents_meet_the_targets(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 5)).alias("source"),
        F.expr("repeat('w ', cast(id * 7 % 900 as int))").alias("text"),
    )
    rows = mixing.mix(docs).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    kept = {r.doc_id: r["count"] for r in copies.groupBy("doc_id").count().collect()}
    assert all(kept.get(r.doc_id, 0) == int(r.taken / r["size"] + 0.5) for r in rows if r["size"])


def test_every_stretch_of_the_mix_holds_the_proportions(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 4)).alias("source"),
        F.expr("repeat('w ', cast(1 + id * 37 % 700 as int))").alias("text"),
    )
    slots = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert all((r.n_slots > 0) == (r.taken > 0) == (r.first_slot is not None) for r in slots.values())
    assert all(r.lap_slots == sorted(r.lap_slots) and min(r.lap_slots) == r.first_slot for r in slots.values() if r.taken)
    mixed = [(r.source, len(r.text.split())) for r in mixing.mixed_documents(docs).collect()]  # in the order written
    total = sum(n for _, n in mixed)
    for source in {s for s, _ in mixed}:
        share = sum(n for s, n in mixed if s == source) / total
        words = own = worst = 0
        for s, n in mixed:
            words, own = words + n, own + n * (s == source)
            worst = max(worst, abs(own - share * words))
        assert worst < 6 * 512
    far = sorted(mixed)  # what an order that knows nothing of the schedule would do
    own = sum(n for s, n in far[: len(far) // 3] if s == "s0")
    assert abs(own - sum(n for s, n in far if s == "s0") / 3) > 6 * 512


@pytest.mark.parametrize("rows", [edges.documents, edges.empty])
def test_mixing_awkward_rows(spark, rows):
    docs = rows(spark)
    mixed = mixing.mix(docs)
    assert mixed.count() == docs.count() and mixed.columns.count("size") == 1
    assert mixed.filter("taken > 3 * size or taken < 0").count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns
