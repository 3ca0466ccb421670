"""Sharding, exact dedup and mixing against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorflow.llm import exact_dedup, mixing, sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, lane int, pattern string"


def docs(spark, rows, parts=3):
    """rows: (doc_id, text, source); the other columns clash with names the operators use inside."""
    return spark.createDataFrame([(i, t, None, s, None, "x", 7, "y") for i, t, s in rows], SCHEMA).repartition(parts)


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2 ** 64 - 1)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_scalar_form_and_only_fills_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2 ** 64, 3000, dtype=np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    old, new = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    moved = old != new
    assert (new[moved] == 16).all() and abs(moved.mean() - 1 / 17) < 0.03


def test_shards_have_gapless_slots(spark):
    rows = [(i, f"text {i % 50}", "a") for i in range(500)] + [(None, None, "a"), (None, "", None), (3, "text 3", "a")]
    got = sharding.assign(docs(spark, rows), shards=4, lanes=8).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {r.doc_id: r for r in got}
    assert by_id[7].size == len("text 7") + 1 and by_id[7].text_crc32 == zlib.crc32(b"text 7")
    assert {r.size for r in got if r.doc_id is None} == {1}
    assert sharding.assign(docs(spark, []), shards=4).count() == 0


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i))
    return {norm: (min(g)[2], len(g)) for norm, g in groups.items()}


def test_exact_dedup_with_a_hot_group_over_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, "a b\tc" if i % 3 == 0 else " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 6))), "s") for i in range(900)]
    rows += [(900, None, "s"), (901, "", "s"), (902, " \n ", None), (903, "abc" + " " * 40, "s"), (904, "x" * 200_000, "s"),
             (905, "é ü", "s"), (906, "é  ü", "s"), (None, "a b c", "s")]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = exact_dedup.dedup(docs(spark, rows)).collect()
        stay = exact_dedup.deduplicated(docs(spark, rows + [rows[905 - 1 + 0]] * 3))
        kept_rows = stay.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = brute_dedup(rows)
    text = {i: t for i, t, _ in rows}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _, _ in rows)
    for r in got:
        norm = re.sub(r"[\x20\x09-\x0d]", "", text[r.doc_id] or "")
        assert (r.keep_id, r.group_size) == want[norm]
        assert r.kept == (r.doc_id == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    assert stay.columns == SCHEMA.replace(",", "").split()[::2]
    assert sorted(r.doc_id for r in kept_rows) == sorted(k for k, _ in want.values())


def test_exact_dedup_keeps_one_of_repeated_rows_and_takes_an_empty_table(spark):
    got = exact_dedup.dedup(docs(spark, [(1, "a", "s")] * 5)).collect()
    assert [r.group_size for r in got] == [5] * 5 and sum(r.kept for r in got) == 1
    assert exact_dedup.deduplicated(docs(spark, [(1, "a", "s")] * 5)).count() == 1
    assert exact_dedup.dedup(docs(spark, [])).count() == 0


def brute_quotas(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full = {s: 0.0 for s in order}, set()
    pool = 1.5 * sum(sizes.values())
    while pool > 1e-9:
        free = [s for s in order if s not in full]
        if not free:
            break
        per = pool / sum(weight[s] for s in free)
        pool = 0.0
        for s in free:
            target[s] += per * weight[s]
            if target[s] >= 2 * sizes[s]:
                pool += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                full.add(s)
    return target


def test_quotas_stop_at_twice_the_size():
    for sizes in ({"a": 100, "b": 1000, "c": 10, None: 50}, {"a": 1}, {"b": 0, "a": 9}, {"x": 5, "y": 5, "z": 5, "w": 5000}):
        got, want = mixing.quotas(sizes), brute_quotas(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_min_cost_flow_repeats_only_when_it_must():
    flow = mixing.route({'["a"]': 10, '["a","b"]': 10, '["b"]': 0}, {"a": 10, "b": 10}, 2)
    assert sum(flow['["a"]', 1].values()) == 10 and sum(flow['["a","b"]', 1].values()) == 10
    assert not flow['["a"]', 2] and not flow['["a","b"]', 2]
    flow = mixing.route({'["a"]': 10, '["a","b"]': 10}, {"a": 15, "b": 15}, 2)
    assert sum(sum(f.values()) for f in flow.values()) == 30
    assert sum(f.get("b", 0) for f in flow.values()) == 15


def mix_rows():
    rnd = random.Random(5)
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60))), rnd.choice(["s1", "s1", "s1", "s2", "s3", "t"]))
            for i in range(1500)]
    return rows + [(1500, None, "s1"), (1501, "a b", None), (1502, "", None), (1503, "x y z", "")]


def test_mix_comes_near_its_targets(spark):
    rows = mix_rows()
    plan, targets = mixing.mix(docs(spark, rows), F.array("source"))
    got = {r.doc_id: r for r in plan.collect()}
    again, _ = mixing.mix(docs(spark, rows[::-1], 5), F.array("source"))
    assert {r.doc_id: r.taken for r in again.collect()} == {i: r.taken for i, r in got.items()}
    sizes = defaultdict(int)
    for i, t, s in rows:
        assert got[i].size == len((t or "").split()) and got[i].taken in (0, got[i].size, 2 * got[i].size)
        sizes[s] += got[i].size
    want = brute_quotas(dict(sizes))
    for t in targets.collect():
        taken = sum(got[i].taken for i, _, s in rows if s == t.source)
        assert t.source_size == sizes[t.source] and abs(t.target - want[t.source]) < 1e-6
        assert abs(taken - t.target) <= 31
    out = mixing.mixed(docs(spark, rows), F.array("source"))
    assert out.columns == SCHEMA.replace(",", "").split()[::2]
    times = defaultdict(int)
    for r in out.collect():
        times[r.doc_id] += 1
    assert all(times[i] == r.copies for i, r in got.items())


def test_mix_of_overlapping_sources_and_of_nothing(spark):
    rows = mix_rows()
    both = F.when(F.col("doc_id") % 2 == 0, F.array("source", F.lit("all"))).otherwise(F.array("source"))
    plan, targets = mixing.mix(docs(spark, rows), both, share=(1, 2))
    assert {t.source for t in targets.collect()} >= {"all", "s1", None}
    assert plan.where("taken > 0").count() > 0 and plan.count() == len(rows)
    plan, targets = mixing.mix(docs(spark, []), F.array("source"))
    assert plan.count() == 0 and targets.count() == 0
    assert mixing.mixed(docs(spark, []), F.array("source")).count() == 0


@pytest.mark.parametrize("table", ["sf0.001"])
def test_registered_queries_return_every_row(spark, table):
    d = f"/root/testdata/{table}"
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    for f in (sharding.op10_sharding, exact_dedup.op4_exact_dedup, mixing.op6_mixing):
        assert f(spark, d).count() == n


def test_mix_fills_up_behind_a_document_that_holds_a_third_of_its_source(spark):
    rnd = random.Random(8)
    for seed in range(3):
        rows = [(1000 * k + i, "w " * rnd.randint(1, 9), s) for k, s in enumerate("abc") for i in range(400)]
        rows += [(9000 + k, "w " * 1000, s) for k, s in enumerate("abc")]
        plan, targets = mixing.mix(docs(spark, rows), F.array("source"), seed=seed)
        taken = defaultdict(int)
        for r in plan.collect():
            taken[r.pattern] += r.taken
            assert r.copies in (0, 1, 2)
        for t in targets.collect():
            assert abs(taken[f'["{t.source}"]'] - t.target) <= 1
        kept = mixing.mixed(docs(spark, rows), F.array("source"), seed=seed).groupBy("source").agg(
            F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()
        assert {f'["{r.source}"]': r.n for r in kept} == {k: n for k, n in taken.items() if n}
