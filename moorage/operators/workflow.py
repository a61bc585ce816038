"""Values that a run of steps hands from one step to the next.

State is an event table ``(run_id, name, seq, value)``: a step that sets a
variable writes its value, a step that clears one writes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.operators.joins import matched_join

def as_of(events: DataFrame, probes: DataFrame, block: int = 100_000) -> DataFrame:
    """The value of each probed ``(run_id, name)`` just before step ``seq``; NULL if cleared or never set.

    Events and probes are merged and scanned in order, never paired. A long
    run is cut into blocks of steps: each block is scanned on its own, and
    takes over what the blocks before it left behind; ``block`` is the number of
    steps in one. Of two settings at the same step the greater value counts.
    """
    merged = events.select("run_id", "name", "seq", F.struct("value").alias("setting"), F.lit(False).alias("probe")).unionByName(
        probes.select("run_id", "name", "seq", F.lit(True).alias("probe")), allowMissingColumns=True
    )
    merged = merged.withColumn("block", F.expr(f"seq div {int(block)}"))
    keys = ["run_id", "name", "block"]
    in_block = (
        Window.partitionBy(*keys).orderBy("seq", F.desc("probe"), F.col("setting").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = merged.withColumn("inside", F.last("setting", ignorenulls=True).over(in_block)).where("probe")
    left_behind = merged.groupBy(*keys).agg(
        F.max_by("setting", F.when(F.col("setting").isNotNull(), F.struct("seq", "setting"))).alias("setting")
    )
    earlier = Window.partitionBy("run_id", "name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = left_behind.select(*keys, F.last("setting", ignorenulls=True).over(earlier).alias("carried"))
    return scanned.join(carried, keys, "left").select(
        "run_id", "name", "seq", F.coalesce("inside", "carried")["value"].alias("value")
    )


def final_state(events: DataFrame) -> DataFrame:
    """Last value of each variable; a clear stays NULL. Of two settings at the same step the greater value counts."""
    return events.groupBy("run_id", "name").agg(F.max_by(F.struct("value"), F.struct("seq", "value"))["value"].alias("value"))


def usable(events: DataFrame) -> DataFrame:
    """A value is usable only if it was set after the variable's last clear or failure."""
    last = lambda wanted: F.max(F.when(wanted, F.col("seq")))
    return events.groupBy("run_id", "name").agg(
        last(F.col("value").isNotNull()).alias("last_set"), last(F.col("value").isNull()).alias("last_clear")
    ).withColumn("usable", F.coalesce(F.col("last_set") > F.coalesce("last_clear", F.lit(-1)), F.lit(False)))


def missing_names(values: dict[str, Column]) -> Column:
    """Names of the blank values on one line."""
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in values.items()])
    blank = F.filter(pairs, lambda pair: S.blank(pair["value"]))
    return F.array_join(F.transform(blank, lambda pair: pair["name"]), ", ")


def required_missing(steps: DataFrame, inputs: DataFrame, names: list[str]) -> DataFrame:
    """Per run of a step, the inputs that the step before it did not leave."""
    joined = matched_join(steps.select("run_id", "step"), inputs.select("run_id", *names), "run_id", "left")
    return joined.select("run_id", "step", missing_names({name: F.col(name) for name in names}).alias("missing"))


def accepted_logins(logins: DataFrame) -> DataFrame:
    """Logins whose token came with the user that was asked for."""
    same = S.filled(F.col("token")) & (F.col("user_email") == F.col("requested_email"))
    return logins.where(same)


def agrees(found: Column, wanted: Column) -> Column:
    """True when the two are equal or the found value is absent."""
    return S.blank(found) | F.coalesce(found == wanted, F.lit(False))


def order_match(ticketed: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Whether the ticketed order and its document name the order that the run retrieved."""
    wanted = retrieved.select("run_id", F.col("order_id").alias("wanted_id"), F.col("owner_code").alias("wanted_owner"))
    joined = matched_join(ticketed, wanted, "run_id")
    return joined.select(
        "run_id",
        agrees(F.col("order_id"), F.col("wanted_id")).alias("order_agrees"),
        agrees(F.col("owner_code"), F.col("wanted_owner")).alias("owner_agrees"),
        agrees(F.col("referenced_order_id"), F.col("order_id")).alias("reference_agrees"),
        agrees(F.col("referenced_owner_code"), F.col("owner_code")).alias("reference_owner_agrees"),
    )


def carrier_owns_all(offers: DataFrame, carrier: str) -> DataFrame:
    """Per run, whether every offer belongs to the carrier."""
    return offers.groupBy("run_id").agg(F.bool_and(F.col("owner_code").eqNullSafe(F.lit(carrier))).alias("all_owned"))
