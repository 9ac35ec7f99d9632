"""Splitters, shards and the mix of sources."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelmill.llm import mixing, sharding, splitters
from labelmill.session import stored

DOCS = "doc_id long, text string, source string, shard int, place string"


def documents(spark, n=600, hot=200):
    """Texts of all lengths; a third of the rows are copies of one text."""
    rows = [(i, "copy" * 30 if i < hot else "x" * (i * i % 977), f"s{i % 3}", 1, "p") for i in range(n)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def size_of(text):
    return len((text or "").encode()) + 16


# --- splitters ---------------------------------------------------------------------


@pytest.mark.parametrize("ranges", [4, 512])
def test_ranked_is_the_order_of_the_keys(spark, monkeypatch, ranges):
    monkeypatch.setattr(splitters, "FEWEST_RANGES", ranges)
    rows = [(k % 5 if k < 300 else k, k, 1 + k % 17) for k in range(700)]
    frame = spark.createDataFrame(rows, "a long, b long, w long")
    found = splitters.ranked(frame, ["a", "b"], "w")
    got = {(r.a, r.b): (r.place, r.before) for r in found.rows.collect()}
    before = 0
    for place, (a, b, w) in enumerate(sorted(rows)):
        assert got[(a, b)] == (place, before)
        before += w
    assert (found.count, found.weight) == (700, before)


def test_overfull_range_is_divided(spark, monkeypatch):
    """One first key holds nearly everything; it is cut by the second."""
    monkeypatch.setattr(splitters, "FEWEST_RANGES", 8)
    frame = spark.range(4000).select(
        F.when(F.col("id") < 3900, 1).otherwise(F.col("id")).cast("long").alias("a"),
        F.col("id").alias("b"),
        F.lit(1).cast("long").alias("w"),
    )
    rows = splitters.ranked(frame, ["a", "b"], "w").rows
    largest = rows.groupBy("range_no").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 4000 / 8


# --- shards ------------------------------------------------------------------------


def test_shards_hold_near_equal_bytes(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = sharding.shard_documents(docs, shards=8).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    held, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert r.size == size_of(texts[r.doc_id]) and r.law == "bytes" and r.grown_shard is None
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    share = sum(held.values()) / 8
    unit = max(share / sharding.WHOLE_GROUP, 993)
    assert len(held) == 8 and all(abs(b - share) <= 2 * unit for b in held.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_small_groups_of_copies_stay_together(spark):
    rows = [(i, f"text {i // 3} " + "y" * 50) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shards = defaultdict(set)
    for r in sharding.shard_documents(docs, shards=5).collect():
        shards[r.doc_id // 3].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_shard_edges(spark):
    assert sharding.shard_documents(documents(spark).limit(0)).count() == 0
    rows = [(None, None), (1, None), (1, None), (2, ""), (3, "é")]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted(r.size for r in got) == [16, 16, 16, 16, 18]
    assert {r.text_crc32 for r in got if r.doc_id in (1, 2)} == {0}
    alone = sharding.shard_documents(spark.createDataFrame([(5, "z")], "doc_id long, text string"))
    assert [(r.doc_id, r.slot) for r in alone.collect()] == [(5, 0)]


def test_with_shards_keeps_rows_and_replaces_columns(spark):
    rows = [(1, "a", "s", 9, "p"), (1, "a", "s", 9, "p"), (None, None, None, 9, None), (2, "b", "s", 9, "q")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sharding.with_shards(docs, shards=2)
    assert got.columns == ["doc_id", "text", "source", "place", "shard", "slot"]
    found = got.collect()
    assert sorted(str(r[:4]) for r in found) == sorted(str((*r[:3], r[4])) for r in rows)
    assert len({(r.shard, r.slot) for r in found}) == 4


# --- mix -------------------------------------------------------------------------


def one_cycle(weights):
    """The cycle, the shares of it, and the slots that one cycle gives each source."""
    cycle, shares = mixing.exact(weights)
    slots = [[] for _ in shares]
    for slot, source, _ in mixing.walk(cycle, shares, shares):
        slots[source].append(slot)
    return cycle, shares, slots


@pytest.mark.parametrize("weights", [[1, 1], [5, 3, 1, 1], [0.7, 0.1, 0.1, 0.05, 0.05], [1] * 200])
def test_walk_keeps_windows_and_shares(weights):
    cycle, shares, by_source = one_cycle(weights)
    assert sum(shares) == cycle
    assert sorted(s for slots in by_source for s in slots) == list(range(cycle))
    for share, slots in zip(shares, by_source):
        for k, slot in enumerate(slots):
            release, due = mixing.window(k, share, cycle)
            assert release <= slot < due
            assert abs((k + 1) - share * (slot + 1) / cycle) < 1
            assert abs(k - share * slot / cycle) < 1
    total = sum(weights)
    assert all(abs(s / cycle - w / total) <= 1 / cycle for s, w in zip(shares, weights))


def brute_mix(rows, weights, block_bytes, order):
    """Places by walking through all blocks one after the other."""
    by_source = defaultdict(list)
    for doc_id, text, source in sorted(rows, key=lambda r: order[r[0]]):
        by_source[source].append((doc_id, size_of(text)))
    names = sorted(by_source)
    cycle, shares, in_cycle = one_cycle([weights[n] for n in names])
    slots = {}
    for n, share, cycle_slots in zip(names, shares, in_cycle):
        first = 0
        for place, (doc_id, size) in enumerate(by_source[n]):
            block = first // block_bytes
            slot = block // share * cycle + cycle_slots[block % share]
            slots[doc_id] = (slot, place)
            first += size
    return {d: i for i, d in enumerate(sorted(slots, key=slots.get))}


def test_mixed_matches_brute_force(spark):
    docs = documents(spark)
    weights = {"s0": 3.0, "s1": 1.0, "s2": 1.0}
    got = mixing.mixed(docs, weights, block_bytes=700).collect()
    hashes = spark.range(600).select("id", F.xxhash64("id").alias("h")).collect()
    order = {r.id: (r.h, r.id) for r in hashes}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert {r.doc_id: r.place for r in got} == brute_mix(rows, weights, 700, order)
    assert all(r.release_slot <= r.slot < r.due_slot for r in got)


def test_mix_edges(spark):
    assert mixing.mixed(documents(spark).limit(0)).count() == 0
    rows = [(1, None, None), (1, None, None), (None, "x", ""), (2, "y", "a"), (3, "y" * 200_000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs, {"a": 0.0, None: 2.0}).collect()
    assert sorted(r.place for r in got) == list(range(5))
    assert {r.source for r in got} == {None, "", "a"}


@pytest.mark.parametrize("weight", [float("nan"), float("inf"), -1.0])
def test_weights_that_are_none(spark, weight):
    with pytest.raises(ValueError, match="weights"):
        mixing.mixed(documents(spark), {"s0": weight})


def test_smallest_and_zero_weights(spark):
    docs = documents(spark)
    got = mixing.mixed(docs, {"s0": 1.0, "s1": 1e-300, "s2": 0.0}, block_bytes=700).collect()
    by_place = [r.source for r in sorted(got, key=lambda r: r.place)]
    assert sorted(r.place for r in got) == list(range(600))
    last = {s: max(i for i, x in enumerate(by_place) if x == s) for s in ("s0", "s1", "s2")}
    assert by_place[-200:] == ["s2"] * 200 and last["s0"] < last["s1"]
    assert mixing.mixed(docs, {"s0": 0.0, "s1": 0.0, "s2": 0.0}).count() == 600


def test_in_mixed_order_writes_the_mix(spark, tmp_path):
    docs = documents(spark)
    path = str(tmp_path / "mix")
    mixing.in_mixed_order(docs).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.columns == docs.columns
    rows = back.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    places = {r.doc_id: r.place for r in mixing.mixed(docs).collect()}
    written = sorted(rows, key=lambda r: (r.file_name, r.row_index))
    assert [r.doc_id for r in written] == sorted(places, key=places.get)


def mixed_and_sharded(spark, docs):
    """The last two stages, the first written and read again as between all stages."""
    return corpus_pipeline.shard(spark, stored(corpus_pipeline.mix(spark, docs, ""), "stage-mixing"), "")


def test_slots_of_a_shard_follow_the_mix(spark):
    """Shards as before; in each the slots are in the order of the mix, from its beginning on."""
    docs = documents(spark, n=6000, hot=0).drop("shard")
    got = mixed_and_sharded(spark, docs).collect()
    plain = {r.doc_id: r.shard for r in sharding.shard_documents(docs).collect()}
    assert {r.doc_id: r.shard for r in got} == plain
    places = {r.doc_id: r.place for r in mixing.mixed(docs).collect()}
    shards = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        shards[r.shard].append(places[r.doc_id])
        assert r.slot == len(shards[r.shard]) - 1
    assert len(shards) == sharding.SHARDS and all(s == sorted(s) for s in shards.values())


def test_sharding_runs_no_python(spark):
    docs = stored(documents(spark), "plain")
    plan = sharding.with_shards(docs, keep_order=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


HELPERS = [
    "at", "row", "row_no", "file_no", "split_no", "_metadata", "mixed_id", "mixed_place", "place", "_id",
    "_crc", "_size", "_copy", "size", "slot", "block", "one", "Shard", "a b", "x.y",
]


def test_helper_names_as_columns(spark):
    """Input columns named like anything the operators make come back as they were."""
    docs = spark.createDataFrame([(i, f"t{i % 4}", "s") for i in range(40)], "doc_id long, text string, source string")
    given = docs.select("*", *[F.concat(F.lit("keep"), "doc_id").alias(h) for h in HELPERS])
    mixed = mixing.in_mixed_order(given)
    assert mixed.columns == given.columns
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, given.collect()))
    got = sharding.with_shards(given, keep_order=True)
    assert got.columns == [c for c in given.columns if c not in ("slot", "Shard")] + ["shard", "slot"]
    for r in got.collect():
        assert {r[h] for h in HELPERS if h not in ("slot", "Shard")} == {f"keep{r.doc_id}"}
    assert mixing.mixed(given).count() == sharding.shard_documents(given).count() == 40


def test_beginnings_of_shards_hold_the_target_shares(spark):
    """One source of ten times the rows of the other; weights are the roots of the sizes."""
    rows = [(i, f"{i:06d}" * 200, "large" if i % 11 else "small") for i in range(8800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    target = 10**0.5 / (1 + 10**0.5)
    first = defaultdict(list)
    for r in mixed_and_sharded(spark, docs).collect():
        if r.slot < 50:
            first[r.shard].append(r.source == "large")
    assert len(first) == sharding.SHARDS
    shares = [sum(s) / len(s) for s in first.values()]
    assert abs(sum(shares) / len(shares) - target) < 0.03
    assert all(abs(s - target) < 0.25 for s in shares)


@pytest.mark.parametrize("weights", [[1] * 20, [2**0.5, 3**0.5, 7.3, 1e-5], [0.7, 0.1, 0.1, 0.1]])
def test_shares_keep_to_the_weights_over_many_cycles(weights):
    """At every slot each source is within one block of the weight it was given."""
    cycle, shares = mixing.exact(weights)
    slots, total = 60_000, sum(weights)
    seen = [0] * len(weights)
    for slot, source, k in mixing.walk(cycle, shares, [slots] * len(weights)):
        if slot == slots:
            break
        assert seen[source] == k
        seen[source] += 1
        assert sum(seen) == slot + 1
        if slot % 97 == 0 or slot > slots - 50:
            assert all(abs(n - w / total * (slot + 1)) < 1 + 1e-6 for n, w in zip(seen, weights))


def test_mixed_keeps_equal_sources_equal(spark):
    """20 equal sources of 120 blocks each: after each round all have run once."""
    rows = [(i, "x" * 84, f"s{i % 20:02}") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mixed(docs, {f"s{i:02}": 1.0 for i in range(20)}, block_bytes=100).collect()
    rounds = defaultdict(set)
    for r in got:
        rounds[r.place // 20].add(r.source)
        assert r.share == 0.05 and r.release_slot <= r.slot < r.due_slot
    assert len(rounds) == 120 and all(len(s) == 20 for s in rounds.values())
