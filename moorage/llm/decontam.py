"""Benchmark decontamination with a hash set of benchmark word windows.

The windows of all benchmark items, normalised like the documents, form a set
of 64-bit hashes that every task gets. Tasks look up each window of each
document in it, and hits are checked word by word against the windows
themselves. A small set (``MOST_WINDOWS`` windows, ``MOST_CHARS`` characters)
travels in the plan with the windows' words. A larger one is broadcast as bare
hashes, up to ``MOST_HASHES`` of them; the windows of documents pass it where
they are made, and only those that hit are shuffled. Beyond that, windows meet
the hashes in a join, without any words. The result is the same each time.

Only DataFrame and SQL functions are used.

Defined results: null and empty texts have no words and no hits; an item of
fewer than ``width`` words is one window, one without words is none; items
with equal texts all count; items with a null id make hits but aren't listed;
repeated and null-id rows are judged each for itself; empty tables give no
rows or no hits; columns other than ids and texts are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import PLAIN_BREAK, ascii_lower, split_words
from moorage.session import materialise

#: Distinct benchmark windows that the plan carries to every task, and their characters together.
MOST_WINDOWS, MOST_CHARS = 50_000, 8_000_000
#: Distinct hashes of windows that are broadcast, of 8 bytes each (about 32 in the table that the tasks look them up in).
MOST_HASHES = 2_000_000


def normal_words(text: Column) -> Column:
    return split_words(ascii_lower(text), PLAIN_BREAK)


def windows(items: DataFrame, *, key: str = "item_id", text: str = "text", width: int = 13) -> DataFrame:
    """(item, length, gram, hash): every window of every item."""
    words = items.select(F.col(key).alias("item"), normal_words(F.col(text)).alias("words")).where("size(words) > 0")
    sized = words.withColumn("length", F.least(F.size("words"), F.lit(width)))
    placed = sized.select("item", "length", "words", F.explode(F.expr("sequence(1, size(words) - length + 1)")).alias("place"))
    cut = placed.select("item", "length", F.expr("slice(words, place, length)").alias("part"))
    return cut.select("item", "length", F.array_join("part", " ").alias("gram"), F.xxhash64("part").alias("hash")).distinct()


def _text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hits_by_set(grams: list) -> Column:
    """Array of (place, length) of verified hits, from column ``words``; places count from 1."""
    parts = []
    for length in sorted({row["length"] for row in grams}):
        rows = [row for row in grams if row["length"] == length]
        hashes = ",".join(str(row["hash"]) + "L" if row["hash"] != -(1 << 63) else "(-9223372036854775807L - 1L)" for row in rows)
        exact = ",".join(_text_literal(row["gram"]) for row in rows)
        places = f"if(size(words) >= {length}, sequence(1, size(words) - {length} + 1), cast(array() as array<int>))"
        probable = f"filter({places}, i -> xxhash64(slice(words, i, {length})) in ({hashes}))"
        verified = f"filter({probable}, i -> array_join(slice(words, i, {length}), ' ') in ({exact}))"
        parts.append(f"transform({verified}, i -> named_struct('place', i, 'length', {length}))")
    if not parts:
        return F.expr("cast(array() as array<struct<place:int,length:int>>)")
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


#: Words under any hit: hits in order of place, each adding what reaches beyond the end so far.
COVERED = (
    "aggregate(hits, named_struct('n', 0L, 'end', 1), (a, h) -> named_struct("
    "'n', a.n + greatest(0, h.place + h.length - greatest(h.place, a.end)), "
    "'end', greatest(a.end, h.place + h.length)), a -> a.n)"
)


def _bounded(items: DataFrame, key: str, text: str, width: int) -> tuple[DataFrame, list | None]:
    """The windows, and their distinct grams on the driver if they are few enough."""
    table = materialise(windows(items, key=key, text=text, width=width), "windows")
    distinct = table.select("length", "gram", "hash").distinct()
    number, chars = distinct.agg(F.count("*"), F.coalesce(F.sum(F.length("gram")), F.lit(0))).first()
    return table, distinct.collect() if number <= MOST_WINDOWS and chars <= MOST_CHARS else None


def _identity(key: Column, text: Column) -> Column:
    """What rows equal in id and text share."""
    return F.struct(key.alias("id"), F.xxhash64(text).alias("mark"))


def _candidates(docs: DataFrame, table: DataFrame, key: str, text: str) -> DataFrame:
    """Per document ``known``: ``maybe``, the (place, length, gram) of windows that a window's hash was found at.

    Words don't leave the task: a window is its place and hash until it hits, and gets the gram that the hash stands for then.
    """
    lengths = [row["length"] for row in table.select("length").distinct().orderBy("length").collect()]  # at most width
    places = F.concat(*[
        F.expr(
            f"if(size(words) >= {n}, transform(sequence(1, size(words) - {n} + 1),"
            f" i -> named_struct('place', i, 'length', {n}, 'hash', xxhash64(slice(words, i, {n})))),"
            " cast(array() as array<struct<place:int,length:int,hash:bigint>>))"
        )
        for n in lengths
    ])
    hashes = table.select("hash").distinct()
    if hashes.count() <= MOST_HASHES:
        hashes = F.broadcast(hashes)
    split = docs.select(_identity(F.col(key), F.col(text)).alias("known"), F.explode(F.array(normal_words(F.col(text)))).alias("words"))
    # The lists are made before they are unpacked, so that no row of a list carries a document's words.
    made = split.select("known", F.explode(F.array(places)).alias("places"))
    scanned = made.select("known", F.explode("places").alias("w")).select("known", "w.*").join(hashes, "hash", "left_semi")
    found = scanned.join(table.select("length", "hash", "gram").distinct(), ["length", "hash"])
    return found.groupBy("known").agg(F.collect_set(F.struct("place", "length", "gram")).alias("maybe"))


def with_hits(docs: DataFrame, table: DataFrame, grams: list | None, *, key: str, text: str) -> DataFrame:
    """``doc`` (the row as a struct), its ``words``, and ``hits``: verified (place, length), in order of place.

    Words and hits come out of one-element explodes: filters can't be moved
    below those, where they would split the text again for every window.
    """
    split = normal_words(F.col("doc")[text])
    ready = docs.select(F.struct("*").alias("doc")).select("doc", F.explode(F.array(split)).alias("words"))
    if grams is not None:
        return ready.select("doc", "words", F.explode(F.array(_hits_by_set(grams))).alias("hits"))
    maybe = _candidates(docs, table, key, text)
    verified = F.expr(
        "transform(filter(coalesce(maybe, array()), m -> array_join(slice(words, m.place, m.length), ' ') = m.gram),"
        " m -> named_struct('place', m.place, 'length', m.length))"
    )
    # Texts are split again beside the hits, so that words aren't shuffled either.
    beside = docs.select(F.struct("*").alias("doc")).join(
        maybe, _identity(F.col("doc")[key], F.col("doc")[text]).eqNullSafe(F.col("known")), "left"
    )
    again = beside.select("doc", "maybe", F.explode(F.array(split)).alias("words"))
    return again.select("doc", "words", F.explode(F.array(F.array_sort(verified))).alias("hits"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word, and a twentieth of all words, lie under hits."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def inspect(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", width: int = 13,
) -> DataFrame:
    """Per row: key, n_words, n_hit, ``items`` (sorted ids, as strings, of items with occurring windows), contaminated."""
    table, grams = _bounded(items, item_key, item_text, width)
    rows = with_hits(docs.select(key, text), table, grams, key=key, text=text).select(
        F.col("doc")[key].alias(key), F.xxhash64(F.col("doc")[text]).alias("mark"), F.size("words").cast("long").alias("n_words"),
        F.expr(COVERED).alias("n_hit"),
        F.expr("array_distinct(transform(hits, h -> array_join(slice(words, h.place, h.length), ' ')))").alias("grams"),
    )
    rows = materialise(rows, "hits")
    found = (
        rows.where("n_hit > 0").select(F.col(key).alias("_key"), F.col("mark").alias("_mark"), F.explode("grams").alias("gram"))
        .join(table.where("item is not null").select("item", "gram"), "gram")
        .groupBy("_key", "_mark").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    same = rows[key].eqNullSafe(found["_key"]) & (rows["mark"] == found["_mark"])
    return rows.join(found, same, "left").select(
        key, "n_words", "n_hit", F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def clean(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", width: int = 13, spans: bool = False,
) -> DataFrame:
    """Documents without the contaminated ones; with ``spans``, those instead without the words under hits.

    A cleaned text is its remaining normalised words, joined by blanks;
    texts that aren't contaminated stay as they are.
    """
    table, grams = _bounded(items, item_key, item_text, width)
    found = with_hits(docs, table, grams, key=key, text=text)
    bad = contaminated(F.expr(COVERED), F.size("words"))
    if not spans:
        return found.where(~bad).select("doc.*")
    left = F.expr(
        "array_join(transform(filter(transform(words, (w, i) -> struct(w as w, i + 1 as i)),"
        " x -> not exists(hits, h -> h.place <= x.i and x.i < h.place + h.length)), x -> x.w), ' ')"
    )
    return found.select(F.col("doc").withField(text, F.when(bad, left).otherwise(F.col("doc")[text])).alias("doc")).select("doc.*")
