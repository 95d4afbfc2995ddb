"""Programs over the change feed of a key-value store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import change_feed_text, decode_change_feed, flatten_json, json_value, part_of
from ..operators.filters import contains, lacks, present
from ..operators.joins import Split, inner_join, split_for
from ..schemas import BANK_CUSTOMER, CUSTOMER_LOCATION, FITNESS_CUSTOMER, PAYMENT, RESERVATION


def naming(text: DataFrame, field: str) -> DataFrame:
    """Entities whose text may have the field: it holds the name, or an escaped character."""
    return text.where(F.col("entity").contains(field) | F.col("entity").contains("\\u"))


def truck_reservations(records: DataFrame) -> DataFrame:
    return present(decode_change_feed(records, RESERVATION), "reservationDate")


def customer_locations(records: DataFrame) -> DataFrame:
    """One row per feed message; messages about other things are rows of nulls."""
    return decode_change_feed(records, CUSTOMER_LOCATION)


def payments(records: DataFrame) -> DataFrame:
    return decode_change_feed(records, PAYMENT).select("reservationId", "amount")


def payment_topic(records: DataFrame) -> DataFrame:
    return json_value(payments(records), "reservationId")


def country_now_and_home(records: DataFrame, split_entities: bool = False, split: int | Split | None = None) -> DataFrame:
    """Locations of each account beside its home country and holder's birth year.

    Both sides come from one feed. By default customer messages also count as locations,
    so each customer meets its own home; ``split_entities`` keeps them out.
    """
    records, split, keep = split_for(records, split)
    # Only entities that name an account can have a partner; the others are not parsed again.
    text = naming(change_feed_text(records, keep), "accountNumber")
    customer_text, location_text = text, text
    if split_entities:
        customer_text = contains(text, "entity", "birthDay")
        location_text = lacks(text, "entity", "birthDay")
    customers = present(flatten_json(customer_text, BANK_CUSTOMER, "entity"), "birthDay").select(
        F.col("accountNumber").alias("customerAccountNumber"), F.col("location").alias("homeLocation"),
        part_of(F.col("birthDay"), "-", 0).alias("birthYear"))
    locations = flatten_json(location_text, CUSTOMER_LOCATION, "entity", keep).withColumnRenamed(
        "accountNumber", "locationAccountNumber").select("locationAccountNumber", "location", *keep)
    return inner_join(locations, customers, "locationAccountNumber", "customerAccountNumber",
                      split=split, split_by=keep)


def email_and_birth_year(records: DataFrame) -> DataFrame:
    text = naming(change_feed_text(records), "birthDay")
    customers = present(flatten_json(text, FITNESS_CUSTOMER, "entity"), "email", "birthDay")
    return customers.select("email", part_of(F.col("birthDay"), "-", 0).alias("birthYear"))
