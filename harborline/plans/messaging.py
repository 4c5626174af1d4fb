"""Messaging reports: latest sender, brand metrics, opt-outs, notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.documents import json_text, named_counts
from harborline.functions.text import after_first
from harborline.operators import merge as M
from harborline.operators.aggregates import count_or_status, recent_or_all
from harborline.operators.latest import latest_by_key, two_stage_dedup

CLICK_STATUS = "URL_CLICKED"  # fixed value
# newest first; the identifiers only break ties, so that reruns agree
SENDER_ORDER = ["ingested_at", "sent_at", "message_id", "report_id", "bot_id", "sender_id", "template_id"]
NOTIFICATION_ORDER = ["ingested_at", "status", "bot_id", "sender_id", "template_id"]


def latest_sender(report: DataFrame, recent: Column) -> DataFrame:
    """The newest message per contact among the recent ones (or all)."""
    return latest_by_key(recent_or_all(report, recent), ["contact_id"], SENDER_ORDER)


def brand_counts(report: DataFrame, senders: DataFrame) -> DataFrame:
    """Message stages per contact and brand; both bot and sender must match."""
    return (
        report.where(F.col("sent_at").isNotNull())
        .join(senders.select("bot_id", "sender_id", "brand_name"), ["bot_id", "sender_id"], "left")
        .where(F.col("brand_name").isNotNull())
        .groupBy("contact_id", "brand_name")
        .agg(
            F.count("sent_at").alias("sent"),
            F.count("delivered_at").alias("delivered"),
            F.count("read_at").alias("read"),
            F.count("replied_at").alias("replied"),
            count_or_status(F.col("clicked_at"), F.col("status"), CLICK_STATUS).alias("clicked"),
        )
    )


def brand_metrics(report: DataFrame, senders: DataFrame) -> DataFrame:
    """The stage counts of all brands of a contact as one JSON object."""
    counts = brand_counts(report, senders)
    stages = {s: F.col(s) for s in ("sent", "delivered", "read", "replied", "clicked")}
    fragment = named_counts(F.col("brand_name"), stages)
    return counts.groupBy("contact_id").agg(
        F.concat(
            F.lit("{"), F.array_join(F.array_sort(F.collect_list(fragment)), ", "), F.lit("}")
        ).alias("brand_metrics")
    )


def opted_out_brands(requests: DataFrame, senders: DataFrame) -> DataFrame:
    """Brands a contact unsubscribed from, as a JSON object."""
    brands = senders.select("bot_id", "brand_name").distinct()
    once = (
        requests.where(F.col("user_request").isNotNull())
        .join(brands, "bot_id", "left")
        .where(F.col("brand_name").isNotNull())
        .select("contact_id", "brand_name")
        .distinct()
    )
    quoted = json_text(F.col("brand_name"))
    return once.groupBy("contact_id").agg(
        F.concat(
            F.lit('{"optOut_brands": ['), F.array_join(F.array_sort(F.collect_list(quoted)), ", "), F.lit("]}")
        ).alias("opt_out_brands")
    )


def campaign_name(template: Column, fallback: Column) -> Column:
    return after_first(template, "_", fallback)


def contact_attributes(report: DataFrame, requests: DataFrame, senders: DataFrame, recent: Column) -> DataFrame:
    """One row per contact: last message, brand, metrics and opt-outs."""
    latest = latest_sender(report.where(F.col("contact_id").isNotNull()), recent)
    brands = senders.where(F.col("brand_name").isNotNull()).groupBy("bot_id").agg(F.min("brand_name").alias("brand_name"))
    return (
        latest.join(brands, "bot_id", "left")
        .join(brand_metrics(report.where(recent), senders), "contact_id", "left")
        .join(opted_out_brands(requests, senders), "contact_id", "left")
        .select(
            "contact_id", "bot_id", "sender_id", "template_id",
            campaign_name(F.col("template_id"), F.col("template_id")).alias("campaign_name"),
            "sent_at", "delivered_at", "read_at", "replied_at", "clicked_at", "phone",
            "brand_name", "brand_metrics", "opt_out_brands",
        )
    )


def merge_attributes(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Upsert of :func:`contact_attributes`: every column is overwritten."""
    rules = {c: M.overwrite for c in source.columns if c != "contact_id"}
    return M.merge_upsert(
        target, source, ["contact_id"], rules, created_at="created_at", updated_at="updated_at", now=now, check_unique=False
    )


NOTIFICATION_KEYS = ["contact_id", "report_id", "message_id"]


def notifications(report: DataFrame, senders: DataFrame, recent: Column) -> DataFrame:
    """One row per notification, newest ingestion first.

    A bot that sends for several brands is shown with the first of them. Brand and campaign follow from columns
    that the newest row is chosen by, so they are added to the rows that stay.
    """
    brands = senders.groupBy("bot_id").agg(F.min("brand_name").alias("brand_name"))
    newest = two_stage_dedup(recent_or_all(report, recent).where(F.col("contact_id").isNotNull()), NOTIFICATION_KEYS, NOTIFICATION_ORDER)
    return newest.join(brands, "bot_id", "left").withColumn("campaign_name", campaign_name(F.col("template_id"), F.col("name")))


def merge_notifications(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Upsert by the three-part key; the phone is only set on insert."""
    rules = {c: M.overwrite for c in source.columns if c not in (*NOTIFICATION_KEYS, "phone")}
    return M.merge_upsert(
        target, source, NOTIFICATION_KEYS, rules, created_at="created_at", updated_at="updated_at", now=now, check_unique=False
    )


def activity_view(notified: DataFrame, attributes: DataFrame) -> DataFrame:
    """Notifications next to the attributes of their contact."""
    return notified.select("contact_id", "report_id", F.col("phone").alias("phone_number")).join(
        attributes.select(
            "contact_id", F.col("bot_id").alias("wa_bot_id"), "sender_id", "campaign_name", "template_id",
            "sent_at", "delivered_at", "read_at", "replied_at", "brand_metrics", "opt_out_brands", "brand_name",
        ),
        "contact_id",
    )
