"""Readers for captured API responses, test-run reports and pipeline-run logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.payload import first_of, first_value, once, with_computed

CORRUPT = "_corrupt_record"

API_LOG = "run_id string, seq int, step string, http_status int, body string, requested_at timestamp_ntz"

# Field names and nesting of the responses. A field that may be
# one value or a list is a variant.
_AMOUNT = "struct<totalAmount: struct<cdata: string, curCode: string>>"
_COMMON = (
    "payloadAttributes: struct<trxId: string>, "
    "augmentationPoint: struct<common: struct<nfOrderId: string, nfSubscriptionId: string>, "
    "provider: struct<nfShoppingResponseId: string>>, "
    "error: array<struct<code: string, typeCode: string, type: string, descText: string, statusText: string>>"
)
SERVICE = "struct<serviceId: string, paxRefId: variant>"
ITEM = "struct<orderItemId: string, service: variant>"
ORDER = f"struct<orderId: string, ownerCode: string, totalPrice: {_AMOUNT}, orderItem: variant>"
COUPON = "struct<couponNumber: int, couponStatusCode: string>"
TICKET = "struct<ticketNumber: string, ticketDocTypeCode: string, coupon: variant>"
TICKET_DOC = (
    "struct<ticket: variant, originalIssueInfo: struct<ticketNumber: string>, paxRefId: variant, "
    "referencedOrder: struct<orderId: string, ownerCode: string>>"
)
PAYMENT = (
    "struct<paymentProcessingSummary: struct<paymentId: string, paymentStatusCode: string, "
    "amount: struct<cdata: string, curCode: string>>>"
)
RESHOP_ITEM = "struct<offerItemId: string, nameChangeService: variant>"
RESHOP_SERVICE = "struct<paxRefId: variant>"
RESHOP_OFFER = f"struct<offerId: string, ownerCode: string, totalPrice: {_AMOUNT}, offerItem: variant>"
_OFFER_SERVICE = (
    "struct<serviceId: string, paxRefId: variant, offerServiceAssociation: "
    "struct<paxJourneyRef: struct<paxJourneyRefId: array<string>>>>"
)
_OFFER = (
    "struct<offerId: string, ownerCode: string, "
    "journeyOverview: struct<journeyPriceClass: array<struct<paxJourneyRefId: string>>>, "
    f"offerItem: array<struct<offerItemId: string, service: array<{_OFFER_SERVICE}>>>, totalPrice: {_AMOUNT}>"
)
_LISTS = (
    "struct<paxJourneyList: struct<paxJourney: array<struct<paxJourneyId: string, paxSegmentRefId: array<string>>>>, "
    "paxSegmentList: struct<paxSegment: array<struct<paxSegmentId: string, datedMarketingSegmentRefId: string>>>, "
    "datedMarketingSegmentList: struct<datedMarketingSegment: array<struct<datedMarketingSegmentId: string, "
    "dep: struct<iataLocationCode: string>, arrival: struct<iataLocationCode: string>>>>>"
)


@dataclass(frozen=True)
class Step:
    """Place of a step in the workflow, the field its result is in, and the result's shape."""

    seq: int
    container: str
    shape: str


#: What of a shopping result the journeys and their segments are in.
SHOPPING_LISTS = f"response: struct<dataLists: {_LISTS}>"
_SHOPPING = f"response: struct<offersGroup: struct<carrierOffers: array<struct<offer: array<{_OFFER}>>>>, dataLists: {_LISTS}>"
_RETRIEVE = "response: struct<order: variant>"
_CHANGE = "response: struct<order: variant, ticketDocInfo: variant>, paymentFunctions: variant"
STEPS = {
    "shopping": Step(1, "iataAirShopping", _SHOPPING),
    "pricing": Step(2, "iataOfferPrice", f"response: struct<pricedOffer: {_OFFER}>"),
    "create": Step(3, "iataOrderCreate", _RETRIEVE),
    "retrieve": Step(4, "iataOrderRetrieve", _RETRIEVE),
    "ticket": Step(5, "iataOrderChange", _CHANGE),
    "payment": Step(6, "customerPayment", "success: boolean"),
    "retrieve_change": Step(7, "iataOrderRetrieve", _RETRIEVE),
    "reshop": Step(8, "iataOrderReshop", "response: struct<reshopResults: struct<reshopOffers: struct<offer: variant>>>"),
    "confirm": Step(9, "iataOrderChange", _RETRIEVE),
    "ticket_change": Step(10, "iataOrderChange", _CHANGE),
}


def _unreadable(parsed: Column, text: Column) -> Column:
    """The text that gave no record, or a corrupt one; a field of another type than declared leaves it readable."""
    corrupt = parsed[CORRUPT]
    return F.when(parsed.isNull(), text).when(F.try_parse_json(corrupt).isNull(), corrupt)


def parse_step(log: DataFrame, step: str, part: str | None = None) -> DataFrame:
    """Rows of one step with the body parsed once: transport ``errors``, ``has_data``, the step's ``result``, ``unreadable``.

    ``unreadable`` is the text of a body that is no JSON, null for any other and for no body at all. ``part`` is the shape
    of what is needed of the result beside its common fields, if not all of the step's is.
    """
    kind = STEPS[step]
    shape = f"struct<{_COMMON}, {part or kind.shape}>"
    rows = log.where(F.col("step") == step).withColumnRenamed("body", "text")

    def read(declared: str) -> Column:
        schema = f"data struct<{kind.container}: {declared}>, errors array<struct<message: string>>, {CORRUPT} string"
        return F.from_json("text", schema, {"columnNameOfCorruptRecord": CORRUPT})

    def fields(body: Column, result: Column) -> Column:
        return F.struct(
            body["errors"].alias("errors"), body["data"].isNotNull().alias("has_data"), result.alias("result"),
            _unreadable(body, F.col("text")).alias("unreadable"),
        )

    if step == "shopping":
        # A list of results is read with declared types. Only a body that doesn't fit, such as one with its result alone, is read as a variant.
        # Both are tried inside one computed column, so that a result is copied into a row once.
        other = once(read("variant"), lambda body: fields(body, first_value(body["data"][kind.container], shape)))

        def listed_or_other(body: Column) -> Column:
            listed = fields(body, first_of(body["data"][kind.container]))
            return F.when(body.isNotNull() & body[CORRUPT].isNull(), listed).otherwise(other)

        parsed = with_computed(rows, "parsed", once(read(f"array<{shape}>"), listed_or_other))
    else:
        body = F.col("body")
        parsed = with_computed(rows, "body", read(shape)).withColumn("parsed", fields(body, body["data"][kind.container]))
    return parsed.select("run_id", "seq", "step", "http_status", "parsed.errors", "parsed.has_data", "parsed.result", "parsed.unreadable")


#: What any object, and nothing else, can be read as without copying what it holds.
_OBJECT = "struct<_: boolean>"
BUSINESS_ERRORS = "array<struct<code: string, typeCode: string, type: string, descText: string, statusText: string>>"


def parse_outcomes(log: DataFrame, steps: list[str]) -> DataFrame:
    """What the error rules need of several steps, from one read of the log and one parse of each body.

    Every row's ``step`` says where its result is. Columns as of `parse_step`, but ``business`` holds the result's
    errors and ``has_result`` says whether there is a result.
    """
    rows = with_computed(log.where(F.col("step").isin(steps)), "parsed", F.try_parse_json("body"))

    def field(path: str, kind: str) -> Column:
        return F.try_variant_get("parsed", path, kind)

    def by_step(path: str, kind: str) -> Column:
        places = {f"$.data.{STEPS[step].container}": [] for step in steps}
        for step in steps:
            places[f"$.data.{STEPS[step].container}"].append(step)
        found = F.lit(None).cast(kind)
        for place, names in places.items():
            # Shopping has its result in a list, or alone.
            value = field(f"{place}{path}", kind)
            if "shopping" in names:
                value = F.coalesce(field(f"{place}[0]{path}", kind), value)
            found = F.when(F.col("step").isin(names), value).otherwise(found)
        return found

    return rows.select(
        "run_id", "seq", "step", "http_status",
        field("$.errors", "array<struct<message: string>>").alias("errors"),
        field("$.data", _OBJECT).isNotNull().alias("has_data"),
        by_step("", _OBJECT).isNotNull().alias("has_result"),
        by_step(".error", BUSINESS_ERRORS).alias("business"),
        F.when(F.col("parsed").isNull(), F.col("body")).alias("unreadable"),
    )


def write_log(log: DataFrame, path: str, step: str | None = None) -> None:
    """Keep a log by step, so that a reader of some steps opens no others.

    A log of one ``step`` goes to its folder as it comes; a mixed one is sorted by step on the way.
    """
    if step is None:
        log.write.partitionBy("step").parquet(path, compression="zstd")
    else:
        log.where(F.col("step") == step).drop("step").write.parquet(f"{path}/step={step}", compression="zstd")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(API_LOG).parquet(path)


# Field names of the test-run report and of the pipeline-run log.
_RESULT = (
    "struct<name: string, path: string, status: string, test: struct<filename: string>, "
    "response: struct<status: int, duration: int>, "
    "testResults: array<struct<description: string, status: string, error: string>>>"
)
_SUMMARY = (
    "struct<totalRequests: int, passedRequests: int, failedRequests: int, totalTests: int, passedTests: int, "
    "failedTests: int>"
)
RUN_REPORT = f"iterationIndex int, results array<{_RESULT}>, summary {_SUMMARY}"
PIPELINE_RUN = (
    "pipeline string, runId string, status string, activities array<struct<name: string, status: string, "
    "error: struct<message: string>, output: struct<rowsCopied: bigint>, "
    "resultSets: array<struct<rowCount: int, rows: array<map<string, string>>>>>>"
)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _documents(text: DataFrame, element: str) -> DataFrame:
    """The entries of JSON documents (one or a list each) in ``value``, and ``unreadable``: the text of what is neither."""
    one = f"struct<{element}, {CORRUPT} string>"
    record = F.from_json("value", one, {"columnNameOfCorruptRecord": CORRUPT})
    # A list that is cut off gives no entries, a record that is cut off gives what came before and is marked.
    starts = lambda sign: F.ltrim("value").startswith(sign)
    parsed = with_computed(
        text, "parsed", F.when(starts("["), F.from_json("value", f"array<{one}>")).when(starts("{"), F.array(record))
    )
    entries = parsed.select("value", F.explode(F.coalesce("parsed", F.array(F.lit(None).cast(one)))).alias("entry"))
    return entries.select("entry.*", _unreadable(F.col("entry"), F.col("value")).alias("unreadable")).drop(CORRUPT)


def _read(spark: SparkSession, path: str, element: str, multi_line: bool) -> DataFrame:
    text = spark.read.text(path, wholetext=multi_line)
    return _documents(text if multi_line else text.where(F.trim("value") != ""), element)


def read_run_reports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Iterations of a test-run report; a path that is not there gives one row flagged missing.

    A line, or with ``multi_line`` a file, that is no JSON or holds something else than iterations gives
    one row with its text in ``unreadable``.
    """
    if not exists(spark, path):
        no_report = spark.createDataFrame([], f"{RUN_REPORT}, unreadable string")
        flag = spark.createDataFrame([(True,)], "missing boolean")
        return no_report.withColumn("missing", F.lit(True)).unionByName(flag, allowMissingColumns=True)
    return _read(spark, path, RUN_REPORT, multi_line).withColumn("missing", F.lit(False))


def read_pipeline_runs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Runs of a pipeline log, with ``unreadable`` as of `read_run_reports`."""
    return _read(spark, path, PIPELINE_RUN, multi_line)


def parse_text(rows: DataFrame, schema: str) -> DataFrame:
    """One JSON document per row of ``value`` to the columns of ``schema`` and ``unreadable``."""
    return _documents(rows.select("value"), schema)


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The readable rows, and the texts of the others as ``unreadable``."""
    return rows.where("unreadable IS NULL").drop("unreadable"), rows.where("unreadable IS NOT NULL").select("unreadable")


def quarantine_counts(rows: DataFrame) -> DataFrame:
    """One row: how many rows are readable, and how many are not."""
    return rows.agg(
        F.count_if(F.col("unreadable").isNull()).alias("readable"), F.count("unreadable").alias("unreadable")
    )


def readable(rows: DataFrame) -> DataFrame:
    """The rows, all of which must be readable: the first unreadable text that a task meets ends the job."""
    if "unreadable" not in rows.columns:
        return rows
    start = F.substring(F.col("unreadable"), 1, 200)
    refused = F.raise_error(F.concat(F.lit("Unreadable document: "), start)).cast("boolean")
    return rows.where(F.when(F.col("unreadable").isNotNull(), refused).otherwise(True)).drop("unreadable")
