import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from moorage.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(part, 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=3):
    """Smallest index reachable, over all pairs."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_matches_brute_force(documents):
    rows = sorted(documents.select("doc_id", "text").collect())
    fps = [plain_fingerprint(row["text"]) for row in rows]
    want = {rows[i]["doc_id"]: (fps[i], rows[r]["doc_id"]) for i, r in enumerate(plain_components(fps))}
    found = simhash.near_copies(documents).select("doc_id", simhash.hexadecimal().alias("f"), "component").collect()
    assert {r["doc_id"]: (int(r["f"], 16), r["component"]) for r in found} == want


def cluster(seed, n):
    """Chains, balls around centres, and loners."""
    draw = random.Random(seed)
    found = set()
    while len(found) < n:
        centre = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 40])):
            found.add(centre)
            for bit in draw.sample(range(64), draw.choice([1, 2, 3, 4])):
                centre ^= 1 << bit
                found.add(centre)
    return sorted(found)


def linked(spark, fps):
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    roots = {r["a"]: r["b"] for r in simhash.components(simhash.links(frame)).collect()}
    place = {f: i for i, f in enumerate(signed)}
    groups = {}
    for f in signed:
        groups.setdefault(roots.get(f, f), []).append(place[f])
    return {i: min(group) for group in groups.values() for i in group}


def test_links_and_components(spark):
    fps = cluster(1, 900)
    assert linked(spark, fps) == dict(enumerate(plain_components(fps)))


def test_hot_groups_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MOST", 8)
    draw = random.Random(3)
    centre = draw.getrandbits(64)
    ball = {centre ^ sum(1 << bit for bit in draw.sample(range(64), draw.choice([0, 1, 2, 3]))) for _ in range(300)}
    fps = sorted(ball | set(cluster(4, 100)))
    assert linked(spark, fps) == dict(enumerate(plain_components(fps)))


def test_masks_cover_every_pair():
    draw = random.Random(5)
    for level in range(1, len(simhash.PARTS) + 1):
        masks = simhash.masks(level)
        assert len(masks) == 4**level
        for _ in range(50):
            other = sum(1 << bit for bit in draw.sample(range(64), 3))
            assert any(not mask & other for mask in masks)
    assert max(64 - mask.bit_count() for mask in masks) <= 13


def test_group_filter_keeps_every_link():
    fps = np.array(cluster(6, 500), np.uint64)
    pivots = np.array([xxhash.xxh64_intdigest(str(i), 42) for i in range(simhash.PIVOTS)], np.uint64)
    first = simhash.link_group(fps, pivots, 3)
    assert first.tolist() == plain_components([int(f) for f in fps])


def test_odd_rows(odd, nothing):
    found = simhash.near_copies(odd).collect()
    assert len(found) == odd.count()
    blank = [r for r in found if r["fingerprint"] == 0]
    assert len(blank) == 5 and {r["component"] for r in blank} == {2}
    assert simhash.near_copies(nothing).count() == 0


def test_keeps_one_of_each_component(odd, nothing):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    components = {r["component"] for r in simhash.near_copies(odd).collect()}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(components)
    assert simhash.keep_one(nothing).count() == 0
    only_null = odd.withColumn("doc_id", F.lit(None).cast("long"))
    fps = {r["fingerprint"] for r in simhash.fingerprints(only_null).collect()}
    assert simhash.keep_one(only_null).count() == len(fps)
