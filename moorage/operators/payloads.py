"""Flat rows from captured responses.

Input is the output of ``parse_step``. Lists are unpacked inside the row, so
none of this shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.functions.payload import as_array, find_by_id, first_of, first_value, once, with_computed
from moorage.operators.joins import matched_join
from moorage.sources import logs


def _filled_text(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def amount(cdata: Column) -> Column:
    """An amount held as text; text that is no number becomes NULL."""
    return cdata.try_cast("decimal(18,2)")


# ------------------------------------------------------------------- offers


def all_offers() -> Column:
    """Offers of all carriers of a shopping response, in order."""
    carriers = F.col("result.response.offersGroup.carrierOffers")
    return F.flatten(F.transform(carriers, lambda carrier: carrier["offer"]))


def offers(parsed: DataFrame) -> DataFrame:
    """One row per offer with its place in the list."""
    return parsed.select("run_id", F.posexplode(all_offers()).alias("pos", "offer")).select(
        "run_id",
        "pos",
        F.col("offer.offerId").alias("offer_id"),
        F.col("offer.ownerCode").alias("owner_code"),
        amount(F.col("offer.totalPrice.totalAmount.cdata")).alias("amount"),
        F.col("offer.totalPrice.totalAmount.curCode").alias("currency"),
        "offer",
    )


def offer_services(parsed: DataFrame) -> DataFrame:
    """Offer, item, service and passenger on one row."""
    return (
        offers(parsed)
        .select("run_id", "offer_id", F.explode_outer("offer.offerItem").alias("item"))
        .select("run_id", "offer_id", F.col("item.offerItemId").alias("offer_item_id"),
                F.explode_outer("item.service").alias("service"))
        .select("run_id", "offer_id", "offer_item_id", F.col("service.serviceId").alias("service_id"),
                F.explode_outer(as_array(F.col("service.paxRefId"), "string")).alias("pax_ref_id"))
    )


def _lists(path: str) -> Column:
    return F.col(f"result.response.dataLists.{path}")


def _journeys() -> Column:
    return _lists("paxJourneyList.paxJourney")


def _segments() -> Column:
    return _lists("paxSegmentList.paxSegment")


def _dated() -> Column:
    return _lists("datedMarketingSegmentList.datedMarketingSegment")


def segments(parsed: DataFrame) -> DataFrame:
    """Journey, segment and dated segment; the ids are followed inside the document."""
    rows = parsed.select("run_id", _segments().alias("segments"), _dated().alias("dated"),
                         F.explode(_journeys()).alias("journey"))
    rows = rows.select("run_id", "segments", "dated", F.col("journey.paxJourneyId").alias("journey_id"),
                       F.posexplode("journey.paxSegmentRefId").alias("pos", "segment_id"))
    rows = with_computed(rows, "segment", find_by_id(F.col("segments"), "paxSegmentId", F.col("segment_id")))
    leg = find_by_id(F.col("dated"), "datedMarketingSegmentId", F.col("segment.datedMarketingSegmentRefId"))
    rows = with_computed(rows, "leg", leg)
    return rows.select(
        "run_id", "journey_id", "pos", "segment_id",
        F.col("leg.datedMarketingSegmentId").alias("dated_segment_id"),
        F.col("leg.dep.iataLocationCode").alias("origin"),
        F.col("leg.arrival.iataLocationCode").alias("destination"),
    )


def journey_ref(offer: Column) -> Column:
    """The journey named by the offer's price class, else by its first service."""
    price_class = first_of(offer["journeyOverview"]["journeyPriceClass"])["paxJourneyRefId"]
    service = first_of(first_of(offer["offerItem"])["service"])
    by_service = first_of(service["offerServiceAssociation"]["paxJourneyRef"]["paxJourneyRefId"])
    return F.coalesce(_filled_text(price_class), by_service)


def is_direct(offer: Column, origin: str, destination: str) -> Column:
    """Exactly one segment, flying the wanted route."""

    def on_route(leg: Column) -> Column:
        return (leg["dep"]["iataLocationCode"] == origin) & (leg["arrival"]["iataLocationCode"] == destination)

    def only_segment_on_route(refs: Column) -> Column:
        segment = find_by_id(_segments(), "paxSegmentId", first_of(refs))
        leg = find_by_id(_dated(), "datedMarketingSegmentId", segment["datedMarketingSegmentRefId"])
        return (F.size(refs) == 1) & once(leg, on_route)

    refs = find_by_id(_journeys(), "paxJourneyId", journey_ref(offer))["paxSegmentRefId"]
    return F.coalesce(once(refs, only_segment_on_route), F.lit(False))


def _first_carrier_offers() -> Column:
    return first_of(F.col("result.response.offersGroup.carrierOffers"))["offer"]


def direct_offers(parsed: DataFrame, origin: str, destination: str) -> DataFrame:
    direct = F.filter(all_offers(), lambda offer: is_direct(offer, origin, destination))
    return parsed.select("run_id", F.explode(direct).alias("offer")).select(
        "run_id", F.col("offer.offerId").alias("offer_id")
    )


def first_direct_else_first(origin: str, destination: str) -> Column:
    """The first offer on the wanted route, otherwise the first offer of all."""
    choice = _first_carrier_offers()
    return F.coalesce(
        first_of(F.filter(choice, lambda offer: is_direct(offer, origin, destination))), first_of(choice)
    )


def best_per_document(parsed: DataFrame, origin: str, destination: str) -> DataFrame:
    """The same choice over exploded rows: one smallest (not direct, place) per run, combined map-side."""
    flagged = parsed.select(
        "run_id",
        F.posexplode(
            F.transform(
                _first_carrier_offers(),
                lambda offer: F.struct(
                    offer["offerId"].alias("offer_id"), (~is_direct(offer, origin, destination)).alias("not_direct")
                ),
            )
        ).alias("pos", "offer"),
    )
    best = F.min_by("offer.offer_id", F.struct("offer.not_direct", "pos"))
    return flagged.groupBy("run_id").agg(best.alias("offer_id"))


def succeeded(parsed: DataFrame) -> DataFrame:
    """Responses with a result, without transport and without business errors."""
    none = lambda errors: F.coalesce(F.size(errors), F.lit(0)) == 0
    return parsed.where(F.col("result.response").isNotNull() & none(F.col("errors")) & none(F.col("result.error")))


PICK = ["trx_id", "subscription_id", "shopping_response_id", "offer_id", "owner_code", "offer_item_id", "pax_ref_id"]


def selected_offer(parsed: DataFrame, origin: str, destination: str) -> DataFrame:
    """The offer a run goes on with; runs without a complete pick have no row."""
    rows = with_computed(succeeded(parsed), "offer", first_direct_else_first(origin, destination))
    rows = rows.withColumn("item", first_of(F.col("offer.offerItem")))
    rows = rows.withColumn("service", first_of(F.col("item.service")))
    picked = rows.select(
        "run_id",
        F.col("result.payloadAttributes.trxId").alias("trx_id"),
        F.col("result.augmentationPoint.common.nfSubscriptionId").alias("subscription_id"),
        F.col("result.augmentationPoint.provider.nfShoppingResponseId").alias("shopping_response_id"),
        F.col("offer.offerId").alias("offer_id"),
        F.col("offer.ownerCode").alias("owner_code"),
        F.col("item.offerItemId").alias("offer_item_id"),
        first_value(F.col("service.paxRefId"), "string").alias("pax_ref_id"),
    )
    usable = S.filled(F.col("subscription_id")) & S.filled(F.col("shopping_response_id")) & F.col("pax_ref_id").isNotNull()
    return picked.where(usable)


def priced_offer(parsed: DataFrame, selected: DataFrame) -> DataFrame:
    """Ids of the priced offer. Without a provider block the shopping id of the run's earlier step stands."""
    offer = F.col("result.response.pricedOffer")
    item = first_of(offer["offerItem"])
    rows = parsed.where(F.col("result.response").isNotNull()).select(
        "run_id",
        F.col("result.payloadAttributes.trxId").alias("trx_id"),
        F.col("result.augmentationPoint.common.nfSubscriptionId").alias("subscription_id"),
        F.col("result.augmentationPoint.provider").isNotNull().alias("has_provider"),
        F.col("result.augmentationPoint.provider.nfShoppingResponseId").alias("own_response_id"),
        offer["offerId"].alias("offer_id"),
        offer["ownerCode"].alias("owner_code"),
        item["offerItemId"].alias("offer_item_id"),
        first_value(first_of(item["service"])["paxRefId"], "string").alias("pax_ref_id"),
    )
    earlier = selected.select("run_id", F.col("shopping_response_id").alias("earlier_response_id"))
    joined = matched_join(rows, earlier, "run_id", "left")
    response_id = F.when(F.col("has_provider"), F.col("own_response_id")).otherwise(F.col("earlier_response_id"))
    return joined.withColumn("shopping_response_id", response_id).drop(
        "has_provider", "own_response_id", "earlier_response_id"
    )


# ------------------------------------------------------------------- orders


def _with_order(parsed: DataFrame) -> DataFrame:
    """Adds the first order, its first item, that item's first service and its first passenger."""
    rows = with_computed(parsed, "order", first_value(F.col("result.response.order"), logs.ORDER))
    rows = with_computed(rows, "item", first_value(F.col("order.orderItem"), logs.ITEM))
    rows = with_computed(rows, "service", first_value(F.col("item.service"), logs.SERVICE))
    return with_computed(rows, "pax_ref_id", first_value(F.col("service.paxRefId"), "string"))


def created_order(parsed: DataFrame) -> DataFrame:
    rows = _with_order(parsed.where(F.col("result.response").isNotNull())).where("order IS NOT NULL")
    return rows.select(
        "run_id",
        F.col("result.payloadAttributes.trxId").alias("trx_id"),
        F.col("result.augmentationPoint.common.nfOrderId").alias("nf_order_id"),
        F.col("result.augmentationPoint.common.nfSubscriptionId").alias("subscription_id"),
        F.col("order.orderId").alias("order_id"),
        F.col("order.ownerCode").alias("owner_code"),
    )


def retrieved_order(parsed: DataFrame) -> DataFrame:
    rows = _with_order(parsed.where(F.col("result.response").isNotNull()))
    return rows.select(
        "run_id",
        F.col("result.payloadAttributes.trxId").alias("trx_id"),
        F.col("order.orderId").alias("order_id"),
        F.col("order.ownerCode").alias("owner_code"),
        F.col("item.orderItemId").alias("order_item_id"),
        F.col("service.serviceId").alias("service_id"),
        "pax_ref_id",
        F.col("order.totalPrice.totalAmount.cdata").alias("amount_text"),
        amount(F.col("order.totalPrice.totalAmount.cdata")).alias("amount"),
        F.col("order.totalPrice.totalAmount.curCode").alias("currency"),
    )


def order_before_change(parsed: DataFrame) -> DataFrame:
    return retrieved_order(parsed).select("run_id", "trx_id", "order_item_id", "service_id")


def _with_document(parsed: DataFrame) -> DataFrame:
    rows = with_computed(parsed, "document", first_value(F.col("result.response.ticketDocInfo"), logs.TICKET_DOC))
    rows = with_computed(rows, "ticket", first_value(F.col("document.ticket"), logs.TICKET))
    return with_computed(rows, "coupon", first_value(F.col("ticket.coupon"), logs.COUPON))


def ticket(parsed: DataFrame) -> DataFrame:
    """Ticket number, from the original issue where the ticket itself has none, and the first coupon."""
    return _with_document(parsed.where(F.col("result.response").isNotNull())).select(
        "run_id",
        F.col("result.payloadAttributes.trxId").alias("trx_id"),
        S.first_filled(F.col("ticket.ticketNumber"), F.col("document.originalIssueInfo.ticketNumber")).alias(
            "ticket_number"
        ),
        F.col("ticket.ticketDocTypeCode").alias("ticket_type"),
        F.col("coupon.couponNumber").alias("coupon_number"),
        F.col("coupon.couponStatusCode").alias("coupon_status"),
    )


def ticket_references(parsed: DataFrame) -> DataFrame:
    """Order ids and owners named by the ticketed order and by its document."""
    rows = _with_document(_with_order(parsed))
    return rows.select(
        "run_id",
        F.col("order.orderId").alias("order_id"),
        F.col("order.ownerCode").alias("owner_code"),
        F.col("document.referencedOrder.orderId").alias("referenced_order_id"),
        F.col("document.referencedOrder.ownerCode").alias("referenced_owner_code"),
    )


def payment(parsed: DataFrame) -> DataFrame:
    rows = with_computed(parsed, "payment", first_value(F.col("result.paymentFunctions"), logs.PAYMENT))
    summary = F.col("payment.paymentProcessingSummary")
    return rows.where("payment IS NOT NULL").select(
        "run_id",
        summary["paymentId"].alias("payment_id"),
        summary["paymentStatusCode"].alias("payment_status"),
        amount(summary["amount"]["cdata"]).alias("amount"),
        summary["amount"]["curCode"].alias("currency"),
    )


def reshop_offer(parsed: DataFrame, fallback_pax: str) -> DataFrame:
    """The first change offer. A missing item id is the offer id with ``-1``; a missing passenger the given one."""
    found = first_value(F.col("result.response.reshopResults.reshopOffers.offer"), logs.RESHOP_OFFER)
    rows = with_computed(parsed, "offer", found)
    rows = with_computed(rows, "item", first_value(F.col("offer.offerItem"), logs.RESHOP_ITEM))
    rows = with_computed(rows, "service", first_value(F.col("item.nameChangeService"), logs.RESHOP_SERVICE))
    priced = F.col("offer.totalPrice.totalAmount").isNotNull()
    offer_id = F.col("offer.offerId")
    return rows.where(F.col("offer").isNotNull() & priced).select(
        "run_id",
        F.col("result.payloadAttributes.trxId").alias("trx_id"),
        F.col("result.augmentationPoint.provider.nfShoppingResponseId").alias("shopping_response_id"),
        offer_id.alias("offer_id"),
        F.col("offer.ownerCode").alias("owner_code"),
        amount(F.col("offer.totalPrice.totalAmount.cdata")).alias("amount"),
        F.col("offer.totalPrice.totalAmount.curCode").alias("currency"),
        S.first_filled(F.col("item.offerItemId"), F.concat(_filled_text(offer_id), F.lit("-1"))).alias("offer_item_id"),
        S.first_filled(first_value(F.col("service.paxRefId"), "string"), F.lit(fallback_pax)).alias("pax_ref_id"),
    )


def changed_values(parsed: DataFrame) -> DataFrame:
    """One row per changed value; blank ones have none, so they overwrite nothing."""
    rows = _with_order(parsed)
    values = {
        "trx_id": F.col("result.payloadAttributes.trxId"),
        "nf_order_id": F.col("result.augmentationPoint.common.nfOrderId"),
        "subscription_id": F.col("result.augmentationPoint.common.nfSubscriptionId"),
        "order_id": F.col("order.orderId"),
        "owner_code": F.col("order.ownerCode"),
        "order_item_id": F.col("item.orderItemId"),
        "pax_ref_id": F.col("pax_ref_id"),
        "amount": F.col("order.totalPrice.totalAmount.cdata"),
        "currency": F.col("order.totalPrice.totalAmount.curCode"),
    }
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in values.items()])
    return rows.select("run_id", F.inline(pairs)).where(S.filled(F.col("value")))


def payment_rows(created: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Payment input from the created and the retrieved order of the same run."""
    left = retrieved.select("run_id", F.col("order_id").alias("booking_reference"), "amount", "currency", "order_item_id")
    right = created.select("run_id", F.col("nf_order_id").alias("external_id"))
    return matched_join(left, right, "run_id")
