"""Bank topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import as_text, flatten_json, json_value
from ..operators.filters import above
from ..operators.joins import Split, bounded_join, inner_join, split_for
from ..schemas import ATM_WITHDRAWAL, BANK_CUSTOMER, BANK_DEPOSIT, BANK_DEPOSIT_TEXT, BANK_WITHDRAWAL

# Fixed value: deposits must be above this amount.
LARGE_DEPOSIT = 200.00


def balance_updates(records: DataFrame) -> DataFrame:
    return as_text(records)


def atm_visits(records: DataFrame) -> DataFrame:
    return as_text(records)


def bank_deposits(records: DataFrame) -> DataFrame:
    return flatten_json(records, BANK_DEPOSIT_TEXT)


def large_deposits(deposit_records: DataFrame, customer_records: DataFrame,
                   minimum: float = LARGE_DEPOSIT, split: int | Split | None = None) -> DataFrame:
    """Deposits above ``minimum`` with the name of each customer of the account."""
    deposit_records, split, keep = split_for(deposit_records, split)
    deposits = above(flatten_json(deposit_records, BANK_DEPOSIT, keep=keep), "amount", minimum)
    customers = flatten_json(customer_records, BANK_CUSTOMER).select(
        "customerName", F.col("accountNumber").alias("customerNumber"))
    return inner_join(deposits, customers, "accountNumber", "customerNumber",
                      split=split, split_by=keep)


def withdrawal_locations(bank_records: DataFrame, atm_records: DataFrame, split: int | Split | None = None) -> DataFrame:
    """Bank withdrawals with the machine that served the same transaction."""
    bank_records, split, keep = split_for(bank_records, split)
    bank = flatten_json(bank_records, BANK_WITHDRAWAL, keep=keep)
    atm = flatten_json(atm_records, ATM_WITHDRAWAL).select(
        F.col("transactionId").alias("atmTransactionId"), "atmLocation", "transactionDate")
    return inner_join(bank, atm, "transactionId", "atmTransactionId", split=split, split_by=keep)


def withdrawal_location_topic(bank_records: DataFrame, atm_records: DataFrame, split: int | Split | None = None) -> DataFrame:
    return json_value(withdrawal_locations(bank_records, atm_records, split), "transactionId")


def bounded_deposits(deposit_records: DataFrame, customer_records: DataFrame, delay: str, within: str,
                     minimum: float = LARGE_DEPOSIT) -> DataFrame:
    """Large deposits with the customer records published ``within`` that time of them.

    Both sides count by their record time; ``delay`` is how late a record may come. The
    state of a stream is then bounded by time, not by its age.
    """
    deposits = above(flatten_json(deposit_records, BANK_DEPOSIT, keep=["timestamp"]), "amount", minimum) \
        .withColumnRenamed("timestamp", "depositTime")
    customers = flatten_json(customer_records, BANK_CUSTOMER, keep=["timestamp"]).select(
        "customerName", F.col("accountNumber").alias("customerNumber"), F.col("timestamp").alias("customerTime"))
    return bounded_join(deposits, customers, "accountNumber", "customerNumber", "depositTime", "customerTime", delay, within)
