from collections import Counter, defaultdict

from pyspark.sql import functions as F

from moorage.llm import kd_shards, mixing


def test_shards_are_near_equal_and_gapless(documents):
    rows = kd_shards.shard(documents.withColumn("doc_id", F.col("doc_id")), 8).select("doc.doc_id", "size", "shard", "slot").collect()
    assert len(rows) == documents.count()
    sizes, slots = Counter(), defaultdict(list)
    for row in rows:
        sizes[row["shard"]] += row["size"]
        slots[row["shard"]].append(row["slot"])
    assert set(sizes) == set(range(8))
    largest = max(row["size"] for row in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 3 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_leaves_are_boxes(spark):
    """Each cut parts a node at one key of its widest dimension."""
    frame = spark.createDataFrame([(i, "x" * (i % 50), f"s{i % 5}", "en") for i in range(500)], "doc_id long, text string, source string, lang string")
    keyed = kd_shards._with_keys(*kd_shards._keyed(frame, key="doc_id", text="text", names=["source", "lang"]))
    levels, leaves = kd_shards.grow(keyed.select("size", "tie", "keys"), 6)
    assert len(leaves) == 6 and sorted(leaf.first for leaf in leaves) == list(range(6)) and len(levels) == 3
    assert levels[0][0][1] in (0, 2, 3)
    sizes = Counter()
    for row in kd_shards.shard(frame, 6).select("shard", "size").collect():
        sizes[row["shard"]] += row["size"]
    assert max(sizes.values()) / min(sizes.values()) < 1.05


def test_equal_texts_stay_together(spark):
    """Copies in other sources and far ids: small groups are whole, a group larger than a shard is cut, shards stay near equal."""
    rows = [(i, f"text {i} " * (1 + i % 7), f"s{i % 5}", "en") for i in range(2000)]
    rows += [(5000 + i, f"copied {i % 60} " * 3, f"s{i % 4}", ["en", "de"][i % 2]) for i in range(180)]
    rows += [(9000 + i, "the same everywhere", f"s{i % 3}", "en") for i in range(1500)] + [(12000, None, None, None), (12001, None, "s1", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    found = kd_shards.shard(frame, 8).select("doc.text", "size", "shard").collect()
    shards, sizes = defaultdict(set), Counter()
    for row in found:
        shards[row["text"]].add(row["shard"])
        sizes[row["shard"]] += row["size"]
    assert len(found) == len(rows) and max(sizes.values()) / min(sizes.values()) < 1.1
    assert [text for text, places in shards.items() if len(places) > 1] == ["the same everywhere"]


def test_shards_of_odd_rows(odd, nothing):
    rows = kd_shards.shard(odd, 3).select("doc.doc_id", "shard", "slot").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    assert {r["shard"] for r in rows} <= {0, 1, 2}
    assert kd_shards.shard(nothing, 3).count() == 0
    assert kd_shards.shard(odd, 1).where("shard = 0").count() == odd.count()


def reshared(sizes, weights, total, most):
    """Targets by sharing the excess again and again."""
    capped = {}
    while True:
        open_weight = sum(w for s, w in weights.items() if s not in capped)
        left = total - sum(capped.values())
        over = {s for s, w in weights.items() if s not in capped and left * w / open_weight > most * sizes[s] + 1e-9}
        if not over:
            return {s: capped[s] if s in capped else left * weights[s] / open_weight for s in sizes}
        capped |= {s: most * sizes[s] for s in over}


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 30, "d": 5, "e": 70, None: 12}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    order = sorted((s for s in sizes if s), key=str) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = reshared(sizes, weights, 1.5 * sum(sizes.values()), 2)
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert all(abs(found[s] - want[s]) < 1e-6 for s in sizes)


def test_mix_meets_targets(documents):
    rows = mixing.mix(documents).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    again = mixing.mix(documents.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in rows)


def test_mix_prefers_quality(spark):
    rows = [(i, ("%%% word ### " if i % 2 else "good plain word ") * 10, "a" if i < 400 else "b") for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    picked = [r for r in mixing.mix(frame, share=(1, 2), weights=(1,)).collect() if r["copies"]]
    assert sum(r["doc_id"] % 2 == 0 for r in picked) > 0.7 * len(picked)


def test_blend_repeats_whole_rows(odd, nothing, documents):
    assert mixing.blend(nothing).count() == 0
    mixed = mixing.blend(odd)
    assert mixed.columns == odd.columns and mixed.schema == odd.schema
    taken = Counter()
    for r in mixing.mix(odd).collect():
        taken[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == +taken
    assert mixing.blend(documents).count() == mixing.mix(documents).agg(F.sum("copies")).first()[0]
