"""Customer risk scores."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.decode import flatten_json, json_value
from ..operators.joins import Split, inner_join, split_for
from ..schemas import RISK_EVENT
from .change_feed import email_and_birth_year


def customer_risk(records: DataFrame) -> DataFrame:
    return flatten_json(records, RISK_EVENT).select("customer", "score")


def risk_by_birth_year(risk_records: DataFrame, feed_records: DataFrame, split: int | Split | None = None) -> DataFrame:
    """Every score of a customer with every feed record of the same e-mail."""
    risk_records, split, keep = split_for(risk_records, split)
    scores = flatten_json(risk_records, RISK_EVENT, keep=keep).select("customer", "score", *keep)
    return inner_join(scores, email_and_birth_year(feed_records), "customer", "email",
                      split=split, split_by=keep)


def risk_topic(risk_records: DataFrame, feed_records: DataFrame, split: int | Split | None = None) -> DataFrame:
    """The join as JSON keyed by customer; ``score`` is a JSON number."""
    return json_value(risk_by_birth_year(risk_records, feed_records, split), "customer")
