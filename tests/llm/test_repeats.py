import hashlib
import random
import re
from collections import Counter

from moorage.llm import passages, repeats


def plain(texts, length):
    """(bytes, removed, spans, kept hash) per text, from counts of all windows."""
    raws = [(text or "").encode() for text in texts]
    counts = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    found = []
    for raw in raws:
        hit = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                hit[i : i + length] = [True] * length
        spans = sum(a and not b for a, b in zip(hit, [False, *hit]))
        kept = bytes(byte for byte, gone in zip(raw, hit) if not gone)
        found.append((len(raw), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return found


def made(seed, n):
    draw = random.Random(seed)
    shared = ["".join(draw.choice("abcdé ") for _ in range(draw.choice([15, 22, 30, 60, 90]))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randint(0, 6)):
            kind = draw.random()
            if kind < 0.45:
                parts.append(draw.choice(shared))
            elif kind < 0.55:
                parts.append("ab" * draw.randint(5, 30))
            else:
                parts.append("".join(draw.choice("abcdefghij ") for _ in range(draw.randint(1, 80))))
        texts.append("".join(parts))
    return texts + texts[:3] + [None, "", "z" * 100]


def check(spark, texts, length, gram):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove(frame, length=length, gram=gram).collect()}
    assert [found[i] for i in range(len(texts))] == plain(texts, length)


def test_matches_brute_force(spark):
    check(spark, made(1, 40), 24, 12)
    check(spark, made(2, 60), 20, 9)


def test_production_lengths(documents):
    rows = sorted(documents.select("doc_id", "text").collect())
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove(documents).collect()}
    assert [found[r["doc_id"]] for r in rows] == plain([r["text"] for r in rows], repeats.LENGTH)


def test_phrases_hold_every_start_once():
    import numpy as np

    for text in made(3, 30):
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts = [i for _, first, last in repeats.phrases(data, 24, 12) for i in range(first, last + 1)]
        assert starts == list(range(max(0, len(data) - 23)))


def test_odd_rows(odd, nothing):
    rows = odd.collect()
    found = repeats.remove(odd).collect()
    want = Counter((r["doc_id"], *p) for r, p in zip(rows, plain([r["text"] if len(r["text"] or "") < 9999 else None for r in rows], 400)))
    small = [r for r in found if r["n_bytes"] < 9999]
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in small) == Counter(
        {k: n for k, n in want.items() if k[0] not in (5, 6)}
    )
    assert all(r["n_removed"] == r["n_bytes"] for r in found if r["doc_id"] in (5, 6))
    assert repeats.remove(nothing).count() == 0


def plain_passages(rows, words):
    """Words under a run of ``words`` words that a row of another id or text has too."""
    split = [re.findall("[^\\x20\\x09-\\x0D]+", text or "") for _, text in rows]
    holders = {}
    for row, own in zip(rows, split):
        for i in range(len(own) - words + 1):
            holders.setdefault(tuple(own[i : i + words]), set()).add(tuple(row))
    found = []
    for own in split:
        hit = {i + k for i in range(len(own) - words + 1) if len(holders[tuple(own[i : i + words])]) > 1 for k in range(words)}
        found.append(len(hit))
    return found


def test_passages_of_small_texts(spark):
    draw = random.Random(8)
    shared = [[draw.choice("abcdefg") for _ in range(draw.choice([7, 9, 12, 30]))] for _ in range(5)]
    rows = []
    for number in range(50):
        own = []
        for _ in range(draw.randint(0, 5)):
            own += draw.choice(shared) if draw.random() < 0.5 else [draw.choice("hijklmnop") for _ in range(draw.randint(1, 30))]
        rows.append((number, " \n"[number % 2].join(own)))
    rows += [*rows[:4], (70, rows[5][1]), (71, "x y z " * 40), (72, None), (None, rows[6][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = Counter((r["doc_id"], r["n_passage_words"]) for r in repeats.remove(frame, length=40, gram=12, words=9).collect())
    assert found == Counter((row[0], n) for row, n in zip(rows, plain_passages(rows, 9)))


def test_passages_of_given_texts(documents):
    rows = documents.select("doc_id", "text").collect()
    found = {r["doc_id"]: r["n_passage_words"] for r in repeats.remove(documents).collect()}
    wanted = plain_passages(rows, passages.WORDS)
    assert [found[r["doc_id"]] for r in rows] == wanted and any(wanted)


def test_words_are_hashed_in_pieces():
    raw = b" one two\tthree\r\nfour  five " * 20
    whole = passages.word_hashes(raw)
    assert len(whole) == 100
    for size in (1, 3, 8, 50):
        assert (passages.word_hashes(raw, size) == whole).all()


def test_frequent_triggers_go_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MOST", 1)
    check(spark, made(4, 40), 24, 12)


def test_members_all_pass(spark):
    import numpy as np

    from moorage.llm.membership import Members

    keys = np.random.default_rng(4).integers(-(1 << 63), 1 << 63, 4000, dtype=np.int64).tolist()
    frame = spark.createDataFrame([(key, place) for place, key in enumerate(keys)] + [(None, -1)], "key long, place int")
    members = Members(frame.where("place < 2000"), "key")
    passed = {row["place"] for row in members.keep(frame, "key").collect()}
    assert passed >= set(range(2000)) and len(passed) < 2100
    batch = frame.toArrow().to_batches()[0]
    assert set(members.among(batch, 0, inside=False).column(1).to_pylist()) | passed >= set(batch.column(1).to_pylist())
    assert Members(frame.limit(0), "key").keep(frame, "key").count() == 0


def test_a_full_bitmap_holds_nothing_back(spark, documents, monkeypatch):
    from moorage.llm import membership

    monkeypatch.setattr(membership, "MOST", 16)
    frame = spark.range(40_000).withColumnRenamed("id", "key")
    assert membership.Members(frame, "key").keep(spark.range(-5, 3).withColumnRenamed("id", "key"), "key").count() == 8
    test_production_lengths(documents)
    monkeypatch.setattr(membership, "MOST", 1)
    test_production_lengths(documents)
