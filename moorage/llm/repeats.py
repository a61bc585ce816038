"""Exact removal of long repeated byte strings by prefix-free parsing.

Rolling hashes pick triggers in a text: the place of the smallest hash of
``GRAM`` bytes within each window of ``LENGTH`` bytes, so every window has one
and equal windows have it at the same place. Triggers cut the window starts of
a text into phrases; a phrase's context is all the bytes its windows cover.

The parse of a text is its row of phrases, the dictionary holds the distinct
contexts. Phrases meet by their trigger bytes. Where a trigger has one
context, its windows are repeated if the context occurs twice; this settles
unique text and whole copies from the parse alone. Only where a trigger has
several contexts are those compared, each distinct one once, by how far they
agree to both sides of the trigger; the contexts of a very frequent trigger
are split up into their windows instead, so that they need not meet in one
task. Common extents and classes of equal windows take the place of a global
suffix order: the question is whether a window occurs twice, not where it
would be sorted, and a suffix array of the corpus doesn't split over a cluster.

Contexts and windows are told apart by 128-bit hashes.

Beside the removal, which is by bytes, every row gets the number of its words that lie in passages of ``passages.WORDS`` words
or more that another document holds too, however few bytes they have.

Defined results: a null text counts as an empty one; texts under ``LENGTH``
bytes lose nothing; rows with equal texts, repeated rows and null ids included,
repeat each other; matches never cross rows; an empty table gives an empty
result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from moorage.llm import passages
from moorage.llm.common import identity, pieces
from moorage.llm.membership import Members
from moorage.session import materialise

LENGTH, GRAM = 400, 64
BASE = 0x9E3779B97F4A7C15 | 1


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` bytes, from hashes of runs whose widths are powers of two."""
    power, size = BASE, 1
    doubled = data.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019)
    result, done = None, 0
    while True:
        if width & size:
            if result is None:
                result, done = doubled, size
            else:
                shift = np.uint64(pow(BASE, done, 1 << 64))
                n = len(data) - done - size + 1
                result = result[:n] + shift * doubled[done : done + n]
                done += size
        if 2 * size > width:
            break
        n = len(data) - 2 * size + 1
        doubled = doubled[:n] + np.uint64(power) * doubled[size : size + n]
        power = power * power % (1 << 64)
        size *= 2
    result = (result ^ (result >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return result ^ (result >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def phrases(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(trigger, first start, last start) of each phrase; every window start lies in exactly one."""
    n = len(data) - length + 1
    if n < 1:
        return []
    hashes = rolling_hashes(data, gram)
    width = length - gram + 1
    lowest = sliding_min(hashes, width)
    cuts = np.flatnonzero(lowest[1:] != lowest[:-1]) + 1
    found = []
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), n]):
        while start < end:
            trigger = start + int(np.argmin(hashes[start : start + width]))  # the first of equal ones
            last = min(end - 1, trigger)
            found.append((trigger, start, last))
            start = last + 1
    return found


def _halves(data: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", xxhash.xxh3_128_digest(data))


def parse(text: str | None, length: int, gram: int) -> list[dict]:
    """The phrases of a text: hash of the trigger bytes, both halves of the context's hash, first start, windows."""
    raw = (text or "").encode()
    found = []
    for trigger, first, last in phrases(np.frombuffer(raw, np.uint8), length, gram):
        high, low = _halves(struct.pack("<ii", trigger - first, last - first) + raw[first : last + length])
        found.append({
            "trigger": struct.unpack("<q", xxhash.xxh3_64_digest(raw[trigger : trigger + gram]))[0], "high": high, "low": low,
            "first": first, "left": trigger - first, "size": last - first + 1,
        })
    return found


def _map(frame: DataFrame, function, schema: str, keep=None) -> DataFrame:
    """Any number of output rows, as tuples, per input row; ``keep`` takes a batch to the part of it that counts.

    Few rows are Python objects at a time, and made rows go out as soon as there are enough.
    """
    target = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def run(batches):
        for batch in batches:
            made: list[tuple] = []
            for piece in pieces(keep(batch) if keep else batch):
                for values in zip(*(column.to_pylist() for column in piece.columns)):
                    made += function(*values)
                    if len(made) >= 50_000:
                        yield _batch(made, arrow)
                        made = []
            yield _batch(made, arrow)

    return frame.mapInArrow(run, target)


def _batch(rows: list[tuple], arrow) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind.type) for c, kind in zip(columns, arrow)], schema=arrow)


def dictionary_rows(docs: DataFrame, *, key: str, text: str, length: int, gram: int) -> DataFrame:
    """(mark, check, trigger, high, low, first, left, size): one row per phrase of every text."""
    ready = docs.select(identity(F.col(key), F.col(text)).alias("same"), F.col(text).alias("text")).select("same.*", "text")
    long_enough = ready.where(F.octet_length("text") >= length)

    def rows(mark, check, value):
        return [
            (mark, check, p["trigger"], p["high"], p["low"], p["first"], p["left"], p["size"]) for p in parse(value, length, gram)
        ]

    return _map(long_enough, rows, "mark long, check int, trigger long, high long, low long, first int, left int, size int")


#: Contexts of one trigger that a task compares with each other; more are split up window by window.
MOST = 64


def compare_contexts(contexts: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int] | None]:
    """Per context (bytes before the trigger, windows, bytes) the first and last window that another context has too.

    Windows of two contexts are equal if both agree on enough bytes to the
    left and to the right of the trigger, so the two common extents decide.
    """
    before = max(left for left, _, _ in contexts)
    after = max(len(raw) - left for left, _, raw in contexts)
    # Bytes lined up at the trigger; places outside a context equal nothing.
    lined = np.empty((len(contexts), before + after), np.int16)
    for row, (left, _, raw) in enumerate(contexts):
        lined[row] = -1 - row
        lined[row, before - left : before - left + len(raw)] = np.frombuffer(raw, np.uint8)
    found: list[tuple[int, int] | None] = []
    for row, (left, size, _) in enumerate(contexts):
        other = lined != lined[row]
        right = np.where((stop := other[:, before:]).any(axis=1), stop.argmax(axis=1), after)
        back = np.where((stop := other[:, :before][:, ::-1]).any(axis=1), stop.argmax(axis=1), before) if before else np.zeros_like(right)
        # A window that starts d bytes before the trigger needs d to the left and length - d to the right.
        low, high = np.maximum(length - right, left - size + 1), np.minimum(back, left)
        fits = low <= high
        fits[row] = False
        found.append((left - int(high[fits].max()), left - int(low[fits].min())) if fits.any() else None)
    return found


def _compare(length: int):
    """Maps (trigger, high, low, times, left, size, raw) rows, sorted by trigger, to (high, low, least, most)."""

    def group(rows: list[tuple]) -> list[tuple]:
        made = []
        if len(rows) > 1:
            for row, found in zip(rows, compare_contexts([(r[4], r[5], r[6]) for r in rows], length)):
                if row[3] == 1 and found:
                    made.append((row[1], row[2], *found))
        return made

    def run(batches):
        schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("least", pa.int32()), ("most", pa.int32())])
        held: list[tuple] = []
        for batch in batches:
            made: list[tuple] = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[0][0] != row[0]:
                    made += group(held)
                    held = []
                held.append(row)
            yield _batch(made, schema)
        yield _batch(group(held), schema)

    return run


def _by_window(contexts: DataFrame, length: int) -> DataFrame:
    """(high, low, least, most) for the contexts of frequent triggers, from classes of equal windows."""

    def windows(high, low, times, size, raw):
        return [(*_halves(raw[shift : shift + length]), high, low, shift, times) for shift in range(size)]

    single = materialise(
        _map(contexts.select("high", "low", "times", "size", "raw"), windows,
             "w_high long, w_low long, high long, low long, shift int, times long"),
        "windows",
    )
    classes = single.groupBy("w_high", "w_low").agg(F.sum("times").alias("n")).where("n > 1").select("w_high", "w_low")
    return single.where("times = 1").join(classes, ["w_high", "w_low"]).groupBy("high", "low").agg(
        F.min("shift").alias("least"), F.max("shift").alias("most")
    )


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(identity(F.col(key), F.col(text)).alias("same"), F.col(text).alias("text")).select("same.*", "text")


def repeated_starts(
    docs: DataFrame, *, key: str, text: str, length: int = LENGTH, gram: int = GRAM, words: int = passages.WORDS
) -> DataFrame:
    """(mark, check, unit, start, end): repeated runs of every row's text, phrase by phrase.

    Runs of bytes lie under repeated windows of bytes, runs of words under windows that another document has. Within
    a phrase the first and the last repeated window overlap, so what lies between them is covered too.
    """
    parsed = materialise(dictionary_rows(docs, key=key, text=text, length=length, gram=gram), "parse")
    # A table of its own, so that a frequent trigger's side of the join can be split.
    by_trigger = materialise(
        parsed.groupBy("trigger").agg(F.count("*").alias("n"), F.min("high").alias("least"), F.max("high").alias("most"))
        .where("n > 1").select("trigger", (F.col("least") != F.col("most")).alias("several")), "triggers",
    )
    shared = materialise(Members(by_trigger, "trigger").keep(parsed, "trigger").join(by_trigger, "trigger"), "parse-shared")

    # Each distinct context of a trigger that has several, and one text that holds it.
    contexts = materialise(
        shared.where("several").groupBy("trigger", "high", "low").agg(
            F.count("*").alias("times"), F.min(F.struct("mark", "check", "first", "left", "size")).alias("at")
        ), "contexts",
    )

    def word_rows(mark, check, value):
        return [(mark, check, *phrase) for phrase in passages.parse(value.encode(), words, passages.GRAM)]

    word_shared, word_contexts, word_open = passages.shared_phrases(
        _map(_texts(docs, key, text).where(F.octet_length("text") >= 2 * words - 1), word_rows,
             "mark long, check int, trigger long, context long, first int, size int")
    )
    questions = contexts.select(
        "at.mark", "at.check", F.lit("bytes").alias("unit"), "trigger", "high", "low", "times", "at.first", "at.left", "at.size"
    ).unionByName(word_open.select(
        "at.mark", "at.check", F.lit("words").alias("unit"), "trigger", F.col("context").alias("high"), F.col("at.mark").alias("low"),
        F.col("holders").cast("long").alias("times"), "at.first", F.lit(0).alias("left"), "at.size",
    ))
    asked = questions.groupBy("mark", "check").agg(
        F.collect_list(F.struct("unit", "trigger", "high", "low", "times", "first", "left", "size")).alias("asked")
    )
    long_enough = F.octet_length("text") >= min(length, 2 * words - 1)
    asked_of = Members(materialise(questions.select("mark").distinct(), "asked"), "mark")
    texts = asked_of.keep(_texts(docs, key, text).where(long_enough), "mark")
    holders = texts.join(asked, ["mark", "check"]).dropDuplicates(["mark", "check"])

    def cut(value, questions):
        raw, hashes = value.encode(), None
        for q in questions:
            context = found = None
            if q["unit"] == "bytes":
                context = raw[q["first"] : q["first"] + q["size"] - 1 + length]
            else:
                hashes = passages.word_hashes(raw) if hashes is None else hashes
                found = passages.windows(hashes, q["first"], q["size"], words)
            yield q["unit"], q["trigger"], q["high"], q["low"], q["times"], q["left"], q["size"], context, found

    schema = "unit string, trigger long, high long, low long, times long, left int, size int, raw binary, windows array<long>"
    answers = materialise(_map(holders.select("text", "asked"), cut, schema), "held")
    held = answers.where("unit = 'bytes'").drop("unit", "windows")
    frequent = held.groupBy("trigger").agg(F.count("*").alias("n")).where(F.col("n") > MOST).select("trigger")
    frequent = materialise(frequent, "frequent")
    ranges = held.join(frequent, "trigger", "left_anti").repartition("trigger").sortWithinPartitions("trigger").mapInArrow(
        _compare(length), "high long, low long, least int, most int"
    )
    ranges = ranges.unionByName(_by_window(held.join(frequent, "trigger", "left_semi"), length))
    # Whole phrases: all texts have one context, or this context occurs twice.
    several = shared.where("several").join(
        contexts.where("times > 1").select("high", "low", F.lit(0).alias("least"), (F.col("at.size") - 1).alias("most"))
        .unionByName(ranges), ["high", "low"],
    )
    same_everywhere = shared.where("not several").withColumns({"least": F.lit(0), "most": F.col("size") - 1})
    columns = [
        "mark", "check", F.lit("bytes").alias("unit"), (F.col("first") + F.col("least")).alias("start"),
        (F.col("first") + F.col("most") + length).alias("end"),
    ]
    word_answers = answers.where("unit = 'words'").select(
        "trigger", F.col("high").alias("context"), F.col("times").alias("holders"), F.col("low").alias("mark"), "windows"
    )
    of_words = passages.covered(word_shared, word_contexts, word_answers, words)
    return same_everywhere.select(*columns).unionByName(several.select(*columns)).unionByName(
        of_words.withColumn("unit", F.lit("words"))
    )


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint runs that cover the same bytes; runs that touch are one."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((start, end))
    return found


def remove(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, words: int = passages.WORDS
) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, ``spans`` (removed runs of bytes), kept_sha256, n_passage_words."""
    runs = repeated_starts(docs, key=key, text=text, length=length, gram=gram, words=words)
    per_text = materialise(
        runs.groupBy("mark", "check").agg(F.collect_set(F.struct("unit", "start", "end")).alias("runs")), "runs"
    )
    texts = docs.select(F.col(key).alias("key"), identity(F.col(key), F.col(text)).alias("same"), F.col(text).alias("text"))
    texts, members = texts.select("key", "same.*", "text"), Members(per_text, "mark")
    joined = members.keep(texts, "mark").join(per_text, ["mark", "check"], "left").select("key", "text", "runs")
    kind = docs.schema[key].dataType.simpleString()

    def row(k, value, found):
        raw = (value or "").encode()
        spans = merged([(r["start"], r["end"]) for r in found or [] if r["unit"] == "bytes"])
        shared = merged([(r["start"], r["end"]) for r in found or [] if r["unit"] == "words"])
        kept, place = hashlib.sha256(), 0
        for start, end in spans:
            kept.update(raw[place:start])
            place = end
        kept.update(raw[place:])
        return [(
            k, len(raw), sum(end - start for start, end in spans), len(spans),
            [{"start": start, "end": end} for start, end in spans], kept.hexdigest(), sum(end - start for start, end in shared),
        )]

    schema = (
        f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_sha256 string, "
        "n_passage_words long"
    )
    found = _map(joined, row, schema)
    if members.bits is None:
        return found
    others = lambda batch: members.among(batch, 2, inside=False)
    return found.unionByName(_map(texts.select("key", "text", "mark"), lambda k, value, _: row(k, value, None), schema, others))
