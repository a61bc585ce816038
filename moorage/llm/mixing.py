"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key scaled by its quality weight:
``-ln(u) / weight`` with ``u`` from a hash of its id and text. Documents of a
source, in order of their keys, are a weighted sample without replacement of
any size. A source's target is met by whole epochs first; what is left is cut
from the sorted keys where the prefix sum of words comes nearest to it.

Keys are dealt into ``CELLS`` fixed ranges per source. Prefix sums run over
the ranges' totals first, and inside a range over its documents, so no task
sorts a whole source, however hot. Only DataFrame and SQL functions are used.

Defined results: a null text has no words; documents without words are taken
as often as their source has whole epochs; a null source is a source, last in
order; repeated rows draw equal keys and count each for itself; null ids draw
from the text alone; an empty table gives an empty mix, and so does one
without words; columns other than id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorage.llm.common import WORD_BREAK, identity, split_words
from moorage.session import materialise

#: Ranges of keys per source.
CELLS = 4096
#: Weights by place of the source in code point order, repeating.
WEIGHTS = (3, 1, 2)
SYMBOLS = "#*$%&|<>"


def quality(text: Column) -> Column:
    """Weight of a document between 0.05 and 1: it falls with the share of symbols among its characters."""
    whole = F.length(F.coalesce(text, F.lit("")))
    symbols = whole - F.length(F.translate(F.coalesce(text, F.lit("")), SYMBOLS, ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * symbols / F.greatest(whole, F.lit(1)))


def uniform(seed: Column) -> Column:
    """A number strictly between 0 and 1 from the first 13 hexadecimal digits of the md5 of a text."""
    digits = F.conv(F.substring(F.md5(seed.cast("binary")), 1, 13), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(1 << 52))


def word_counts(
    docs: DataFrame, *, key: str, text: str, source: str, weight: Column | None = None, same: Column | None = None
) -> DataFrame:
    """(key, source, same, size, draw, cell): words, exponential key and range of keys of every document."""
    seed = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    drawn = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), (F.lit(None).cast("int") if same is None else same).alias("same"),
        F.size(split_words(F.col(text), WORD_BREAK)).cast("long").alias("size"),
        (-F.log(uniform(seed)) / (quality(F.col(text)) if weight is None else weight)).alias("draw"),
    )
    # draw / (1 + draw) spreads the keys over 0 to 1 without knowing their range.
    cell = F.least(F.lit(CELLS - 1), F.floor(F.col("draw") / (1 + F.col("draw")) * CELLS)).cast("int")
    return drawn.withColumn("cell", cell)


def targets(sources: DataFrame, *, share: tuple[int, int] = (3, 2), most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): ``share`` of all words, by weight, none above ``most`` times its size.

    Sources fill up in order of size over weight; the first that stays below
    its limit fixes what a unit of weight gets for it and all after it. All
    sums are whole numbers, so the result doesn't depend on their order. The
    windows run over one row per source.
    """
    up, down = share
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sources.select(
        "source", "source_size",
        F.element_at(F.lit(list(weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")).cast("long").alias("weight"),
    )
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled = ranked.select(
        "*", F.sum("source_size").over(everything).alias("all_size"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    # Times ``down``, to stay whole: what is left for this source and those after it.
    left = F.lit(up) * F.col("all_size") - F.lit(down * most) * F.col("size_before")
    fits = left * F.col("weight") <= F.lit(down * most) * F.col("source_size") * F.col("weight_left")
    first = F.min(F.when(fits, F.struct((F.col("source_size") / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"), "source", left.alias("left"), "weight_left"))).over(everything)
    share_of = first["left"] * F.col("weight") / (F.lit(float(down)) * first["weight_left"])
    return filled.select(
        "source", "source_size", F.when(fits, share_of).otherwise(F.lit(float(most)) * F.col("source_size")).alias("target")
    )


def mix(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None,
    share: tuple[int, int] = (3, 2), most: int = 2, weights: tuple[int, ...] = WEIGHTS, same: Column | None = None,
) -> DataFrame:
    """Per row: key, source, size, source_size, target, ``copies`` and ``taken`` = copies times size; ``same`` if given."""
    rows = materialise(word_counts(docs, key=key, text=text, source=source, weight=weight, same=same), "mix")
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    sources = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), share=share, most=most, weights=weights)
    in_order = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    known = cells.withColumn("before", F.coalesce(F.sum("cell_size").over(in_order), F.lit(0)))
    known = known.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    known = known.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    known = known.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    known = known.select(F.struct("source", "cell").alias("place"), "before", "source_size", "target", "epochs", "rest")
    placed = rows.withColumn("at", F.struct("source", "cell"))
    joined = placed.join(known, F.col("at").eqNullSafe(F.col("place")))
    inside = Window.partitionBy("source", "cell").orderBy("draw", "key", "size", "same").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    picked = joined.withColumn("start", start)
    # A document is in if more than half of it lies before the cut.
    chosen = (F.col("size") > 0) & (F.col("start") + F.col("size") / 2 < F.col("rest"))
    copies = (F.col("epochs") + chosen.cast("long")).cast("long")
    return picked.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *(["same"] if same is not None else []),
    )


def blend(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents, all columns as they are; a document that is taken twice is there twice.

    Rows that are equal in all columns are the same document given more than
    once; their copies are added up.
    """
    same = identity(*(F.col(f"`{name}`") for name in docs.columns))
    chosen = mix(docs, key=key, text=text, source=source, same=same, **options)
    counted = chosen.groupBy("same").agg(F.sum("copies").alias("copies")).where("copies > 0")
    counted = counted.select("same.*", "copies")
    packed = docs.select(F.struct("*").alias("doc"), same.alias("same")).select("doc", "same.*")
    return (
        packed.dropDuplicates(["mark", "check"]).join(counted, ["mark", "check"])
        .select("doc", F.explode(F.expr("sequence(1L, copies)"))).select("doc.*")
    )
