"""Alignment of two tokenizers against a plain walk over the tokens."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from moorage.llm import alignment
from moorage.llm.queries import QUERIES, TOKENIZERS

FILES = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
ODD = [
    None, "", " ", "\n", "<|endoftext|> hi <s></s><unk>", "a▁b", "x\x00y", "  a  b\n\n c ", "é日本🙂", "<0x41>", "tab\tand blank　wide",
    "don't we'll I'D", "a" * 3000, " " * 5000 + "a", "\n \t" * 2000, "1234567890" * 50, "ñ" * 700, "ﬁ ligature ½", "﻿mark", "\r\n",
]


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(*(open(name, "rb").read() for name in FILES))


def plain_alignment(texts):
    """Result rows by walking over bytes, with the plain tokenizer of A."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    signs = alignment.byte_signs()
    walked = []
    for text in texts:
        sides = [[], []]
        if text:
            whole, wanted = b" " + text.encode(), []
            for place, ids in enumerate((first.encode(" " + text, add_special_tokens=False).ids, second.encode(text))):
                at, spelt = 0, b""
                for number in ids:
                    if place == 0:
                        piece = bytes(signs[sign] for sign in first.id_to_token(number))
                    else:
                        piece = second.id_to_piece(number)
                        byte = len(piece) == 6 and piece.startswith("<0x")
                        piece = bytes.fromhex(piece[3:5]) if byte else piece.replace("▁", " ").encode()
                    at, spelt = at + len(piece), spelt + piece
                    sides[place].append((number, at))
                wanted.append(spelt == whole)
            if not all(wanted):
                sides = [[], []]
        walked.append(sides)
    links = []
    for first_side, second_side in walked:
        ends = {}
        for number, end in second_side:
            ends.setdefault(end, []).append(number)
        links.append([(a, b, end) for a, end in first_side for b in ends.get(end, [])])
    counts = Counter((a, b) for found in links for a, b, _ in found)
    best = {}
    for (_, b), number in counts.items():
        best[b] = max(best.get(b, 0), number)
    rows = []
    for (first_side, second_side), found in zip(walked, links):
        groups, left = [], [list(reversed(first_side)), list(reversed(second_side))]
        for end in sorted({end for _, _, end in found}):
            group = [[], []]
            for side, part in zip(left, group):
                while side and side[-1][1] <= end:
                    part.append(str(side.pop()[0]))
            groups.append("|".join(map(",".join, group)))
        rows.append((
            len(first_side), len(second_side), len(groups), len(found), sum(counts[a, b] == best[b] for a, b, _ in found),
            sum(counts[a, b] for a, b, _ in found), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        ))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [4_000_000, 500])
def test_against_a_plain_walk(spark, documents, most):
    texts = ODD + ODD[:6] + [row["text"] for row in documents.orderBy("doc_id").limit(60).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = alignment.align(docs, *FILES, most_pairs=most, segment=200 if most == 500 else 16_384)
    assert [tuple(row[name] for name in COLUMNS) for row in found.orderBy("doc_id").collect()] == plain_alignment(texts)


def test_odd_rows(spark, odd, nothing):
    found = alignment.align(odd, *FILES).collect()
    texts = [row["text"] for row in odd.collect()]
    wanted = Counter(zip([row["doc_id"] for row in odd.collect()], plain_alignment(texts)))
    assert Counter((row["doc_id"], tuple(row[name] for name in COLUMNS)) for row in found) == wanted
    empty = alignment.align(nothing, *FILES)
    assert empty.columns == ["doc_id", *COLUMNS] and empty.collect() == []
    assert alignment.align(odd.where("text IS NULL"), *FILES).select("n_links").distinct().collect()[0][0] == 0


def test_query(spark, documents):
    found = QUERIES["op11_alignment"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", *COLUMNS] and found.count() == documents.count()


def test_both_encoders_of_the_byte_level_side_agree(both, documents):
    for text in [t for t in ODD if t] + [row["text"] or "" for row in documents.limit(50).collect()]:
        fast = both.first_ids(text)
        both.plain or both.first_ids(" " * 5000)
        assert fast == both.plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("number", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash(number):
    keys = np.unique(np.random.default_rng(number).integers(0, 1 << 40, 2 * number))[:number]
    parts = {part: alignment.build(keys[alignment.segment_of(keys, 7) == part]) for part in range(7)}
    function = alignment.PerfectHash(7, parts)
    assert sorted(function.slots(keys).tolist()) == list(range(len(keys)))
    assert (function.keys[function.slots(keys)] == keys).all()
    strange = np.setdiff1d(np.arange(1000, dtype=np.int64), keys)
    assert (function.slots(strange) == -1).all()


def test_tally_hands_on_what_it_cannot_hold():
    tally, found = alignment.Tally(room=10), Counter()
    values = np.random.default_rng(1).integers(0, 40, 500)
    for start in range(0, 500, 7):
        for keys, counts in tally.add(values[start : start + 7]):
            found.update(dict(zip(keys.tolist(), counts.tolist())))
    for keys, counts in tally.empty():
        for key, count in zip(keys.tolist(), counts.tolist()):
            found[key] += count
    assert found == Counter(values.tolist())
