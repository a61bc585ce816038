"""Passages of many words that other documents share: the parse of the repeats operator, over words.

A text is its row of word hashes; triggers are runs of ``GRAM`` words with the smallest hash in each window of ``WORDS`` words,
and they cut the windows into phrases as bytes are cut there. A phrase whose trigger no other document has is settled at
once. A context that two documents hold is a passage as a whole; where a trigger has other contexts too, the windows of all are hashed
one by one, to 64 bits, and counted over the cluster. `repeats.remove` runs both parses, so that the texts meet the questions of both in one join.

Words are separated by blanks (bytes 9 to 13 and 32). Rows equal in id and text are one document here. Texts of fewer words have no passage.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.membership import Members
from moorage.session import materialise

WORDS, GRAM = 51, 6

_BLANKS = bytes(32 if 9 <= code <= 13 else code for code in range(256))


def word_hashes(raw: bytes, size: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of every word, about ``size`` bytes of the text at a time."""
    folded, start, found = raw.translate(_BLANKS), 0, [np.zeros(0, np.uint64)]
    while start < len(folded):
        stop = folded.find(b" ", start + size)
        stop = len(folded) if stop < 0 else stop
        words = folded[start:stop].split()
        found.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        start = stop
    return np.concatenate(found)


def parse(raw: bytes, words: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """(trigger, context, first window, windows) of every phrase."""
    from moorage.llm.repeats import phrases

    hashes = word_hashes(raw)
    for trigger, first, last in phrases(hashes, words, gram):
        context = struct.pack("<ii", trigger - first, last - first) + hashes[first : last + words].tobytes()
        yield (
            struct.unpack("<q", xxhash.xxh3_64_digest(hashes[trigger : trigger + gram].tobytes()))[0],
            struct.unpack("<q", xxhash.xxh3_64_digest(context))[0], first, last - first + 1,
        )


def windows(hashes: np.ndarray, first: int, size: int, words: int) -> list[int]:
    """A hash of the window that starts at ``first`` and of those of the ``size - 1`` words after."""
    raw = hashes[first : first + size - 1 + words].tobytes()
    return [struct.unpack("<q", xxhash.xxh3_64_digest(raw[8 * place : 8 * (place + words)]))[0] for place in range(size)]


def shared_phrases(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of all phrases (mark, check, trigger, context, first, size): those whose trigger another document has, their
    contexts, and the contexts whose windows must be known, with ``holders``: 1 if one document has it, else 2.

    Where all contexts of a trigger are held by several documents, or it has only one, no window is asked for.
    """
    rows = materialise(rows, "words")
    triggers = materialise(
        rows.groupBy("trigger").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).where("low <> high").select("trigger"),
        "word-triggers",
    )
    shared = materialise(Members(triggers, "trigger").keep(rows, "trigger").join(triggers, "trigger"), "words-shared")
    contexts = materialise(
        shared.groupBy("trigger", "context").agg(
            F.when(F.min("mark") == F.max("mark"), 1).otherwise(2).alias("holders"),
            F.min(F.struct("mark", "check", "first", "size")).alias("at"),
        ), "word-contexts",
    )
    open_ = contexts.groupBy("trigger").agg(F.count("*").alias("n"), F.min("holders").alias("least")).where("n > 1 AND least = 1")
    return shared, contexts, contexts.join(materialise(open_.select("trigger"), "word-open"), "trigger", "left_semi")


def covered(shared: DataFrame, contexts: DataFrame, held: DataFrame, words: int) -> DataFrame:
    """(mark, check, start, end): runs of words under windows that another document has.

    ``held`` has the windows (trigger, context, holders, mark, windows) of the contexts that were asked for.
    """
    apart = held.select("trigger", "context", "holders", "mark", F.posexplode("windows").alias("shift", "window"))
    classes = materialise(
        apart.groupBy("window").agg(F.max("holders").alias("holders"), F.min("mark").alias("low"), F.max("mark").alias("high"))
        .where("holders > 1 OR low <> high").select("window"), "word-classes",
    )
    ranges = (
        Members(classes, "window").keep(apart.where("holders = 1").select("trigger", "context", "shift", "window"), "window")
        .join(classes, "window").groupBy("trigger", "context").agg(F.min("shift").alias("least"), F.max("shift").alias("most"))
    )
    whole = contexts.where("holders > 1").select("trigger", "context", F.lit(0).alias("least"), (F.col("at.size") - 1).alias("most"))
    found = shared.join(materialise(whole.unionByName(ranges), "word-ranges"), ["trigger", "context"])
    return found.select(
        "mark", "check", (F.col("first") + F.col("least")).alias("start"), (F.col("first") + F.col("most") + words).alias("end")
    )
