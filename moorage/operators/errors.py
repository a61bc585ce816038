"""Which business errors block a step. The rules differ from step to step and are kept apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The exempt code, the blocking-free severity and the wording of a schedule change.
EXEMPT_CODE = "NFE-NDC-TTL-INCORRECT"
WARNING = "Warning"
SCHEDULE_CHANGE = r"^(?:None - )?(?:Departure|Arrival) Time changed for\b"


def schedule_change(text: Column) -> Column:
    return F.coalesce(text.rlike(SCHEDULE_CHANGE), F.lit(False))


def _is(value: Column, wanted: str) -> Column:
    return value.eqNullSafe(F.lit(wanted))


def strict(error: Column) -> Column:
    """Every error blocks."""
    return F.lit(True)


def non_warning(error: Column) -> Column:
    return ~_is(error["typeCode"], WARNING)


def code_exempt(error: Column) -> Column:
    """All but the exempt code block, whatever its severity."""
    return ~_is(error["code"], EXEMPT_CODE)


def change_confirm(error: Column) -> Column:
    """Only a warning passes, and only with the exempt code or as a schedule change."""
    harmless = _is(error["code"], EXEMPT_CODE) | schedule_change(error["descText"])
    return ~(_is(error["typeCode"], WARNING) & harmless)


def browser(error: Column) -> Column:
    """The browser checks read ``type``, and exempt order creation and retrieval only."""
    return ~(_is(error["type"], WARNING) & _is(error["code"], EXEMPT_CODE))


RULES: dict[str, Callable[[Column], Column]] = {
    "shopping": strict,
    "pricing": strict,
    "create": non_warning,
    "retrieve": code_exempt,
    "ticket": strict,
    "payment": strict,
    "retrieve_change": strict,
    "reshop": strict,
    "confirm": change_confirm,
    "ticket_change": strict,
}
BROWSER_RULES = {step: browser if step in ("create", "retrieve") else strict for step in RULES}


def blocking_count(errors: Column, step: str, rules: dict[str, Callable[[Column], Column]] = RULES) -> Column:
    """How many errors of a response block its step."""
    return F.coalesce(F.size(F.filter(errors, rules[step])), F.lit(0))


def dispatched(errors: Column, steps: list[str], rules: dict[str, Callable[[Column], Column]] = RULES) -> Column:
    """How many errors block, each row by the rule of its own ``step``; steps with one rule share a branch."""
    by_rule: dict[Callable[[Column], Column], list[str]] = {}
    for step in steps:
        by_rule.setdefault(rules[step], []).append(step)
    found = F.lit(0)
    for rule, names in by_rule.items():
        count = F.coalesce(F.size(F.filter(errors, rule)), F.lit(0))
        found = F.when(F.col("step").isin(names), count).otherwise(found)
    return found


def blocked(outcomes: DataFrame, steps: list[str], rules: dict[str, Callable[[Column], Column]] = RULES) -> DataFrame:
    """Blocking errors per response of several steps, from `logs.parse_outcomes`; an unreadable body is one of them."""
    unread = F.col("unreadable").isNotNull().cast("int")
    return outcomes.select("run_id", "step", (dispatched(F.col("business"), steps, rules) + unread).alias("blocking"))


def messages(errors: Column) -> Column:
    """Transport error messages on one line."""
    return F.array_join(F.transform(errors, lambda error: error["message"]), "; ")


def exploded(parsed: DataFrame) -> DataFrame:
    """One row per business error."""
    return parsed.select("run_id", "step", F.explode("result.error").alias("error")).select(
        "run_id", "step", F.col("error.code").alias("code"), F.col("error.typeCode").alias("kind"),
        F.col("error.descText").alias("text"),
    )


def classified(outcomes: DataFrame, steps: list[str]) -> DataFrame:
    """Pass or fail per response of `logs.parse_outcomes`: HTTP status, transport errors, data present, no blocking error.

    A body that can't be read has no data and one blocking error.
    """
    no_transport = F.coalesce(F.size("errors"), F.lit(0)) == 0
    return outcomes.select(
        "run_id", "step",
        (F.col("http_status") == 200).alias("http_ok"),
        no_transport.alias("transport_ok"),
        (F.col("has_data") & F.col("has_result")).alias("has_data"),
        (dispatched(F.col("business"), steps) + F.col("unreadable").isNotNull().cast("int")).alias("blocking_errors"),
    ).withColumn(
        "outcome",
        F.when(F.col("http_ok") & F.col("transport_ok") & F.col("has_data") & (F.col("blocking_errors") == 0), "pass")
        .otherwise("fail"),
    )
