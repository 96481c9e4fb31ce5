"""Declared schemas and fixed domain values.

Everything in the FIXED VALUES block must equal the values the payment
domain uses (currency whitelist, event kinds, value domains of the event
generators); they are stated here once, in natural order.
"""
from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the payment domain exactly)
# ---------------------------------------------------------------------------
VALID_CURRENCIES = ("USD", "EUR", "GBP", "SGD", "JPY", "AUD", "CAD", "CHF")
GENERATED_CURRENCIES = ("USD", "EUR", "GBP", "SGD")
GATEWAYS = ("stripe", "adyen", "braintree", "paypal")
REGIONS = ("us-east", "us-west", "eu-west", "ap-south")
REFUND_REASON_CODES = ("customer_request", "fraud", "duplicate", "product_not_received")
DISPUTE_STATUSES = ("filed", "under_review", "resolved_merchant", "resolved_customer")
MERCHANT_CATEGORIES = ("retail", "food", "travel", "electronics", "services")
MERCHANT_COUNTRIES = ("US", "GB", "DE", "SG", "AU")
RISK_TIERS = ("low", "medium", "high")

PAYMENT = "payment_created"
REFUND = "refund_initiated"
CHARGEBACK = "chargeback_filed"
SETTLEMENT = "settlement_processed"
EVENT_KINDS = (PAYMENT, REFUND, CHARGEBACK, SETTLEMENT)

# Bronze table per event kind; anything else goes to the dead letter table.
BRONZE_TABLE = {
    PAYMENT: "raw_payments",
    REFUND: "raw_refunds",
    CHARGEBACK: "raw_chargebacks",
    SETTLEMENT: "raw_settlements",
}
DEAD_LETTER = "dead_letter"

# Silver quarantine reasons in evaluation order (first match wins).
QUARANTINE_REASONS = (
    "null_amount", "non_positive_amount", "null_currency", "invalid_currency",
    "invalid_timestamp", "null_merchant_id", "null_customer_id",
)

# Reconciliation statuses.
RECONCILED = "reconciled"
WITHIN_TOLERANCE = "reconciled_within_tolerance"
FLAGGED = "discrepancy_flagged"
AWAITING = "awaiting_settlement"
DEFAULT_TOLERANCE = "0.01"

# Rolling feature windows (days).
DEFAULT_WINDOWS = (7, 30, 90)
# ---------------------------------------------------------------------------

MONEY = DecimalType(18, 2)
# Totals over all rows or all days: 18 digits overflow at 1e12 payments.
TOTAL = DecimalType(28, 2)


def _s(name, dtype=StringType(), nullable=True):
    return StructField(name, dtype, nullable)


PAYMENT_SCHEMA = StructType([
    _s("event_type", nullable=False), _s("transaction_id", nullable=False),
    _s("merchant_id", nullable=False), _s("customer_id", nullable=False),
    _s("amount", DoubleType(), False), _s("currency", nullable=False),
    _s("gateway"), _s("region", nullable=False), _s("timestamp", nullable=False),
])

REFUND_SCHEMA = StructType([
    _s("event_type", nullable=False), _s("refund_id", nullable=False),
    _s("original_tx_id", nullable=False), _s("merchant_id", nullable=False),
    _s("refund_amount", DoubleType(), False), _s("reason_code"),
    _s("timestamp", nullable=False),
])

CHARGEBACK_SCHEMA = StructType([
    _s("event_type", nullable=False), _s("dispute_id", nullable=False),
    _s("original_tx_id", nullable=False), _s("merchant_id", nullable=False),
    _s("dispute_amount", DoubleType(), False), _s("status"),
    _s("timestamp", nullable=False),
])

SETTLEMENT_SCHEMA = StructType([
    _s("event_type", nullable=False), _s("batch_id", nullable=False),
    _s("merchant_id", nullable=False), _s("gross_amount", DoubleType(), False),
    _s("fees", DoubleType(), False), _s("net_amount", DoubleType(), False),
    _s("timestamp", nullable=False),
])

# Wire schema: every field of the four kinds, all nullable (tagged union).
UNION_SCHEMA = StructType([
    _s("event_type"), _s("transaction_id"), _s("merchant_id"), _s("customer_id"),
    _s("amount", DoubleType()), _s("currency"), _s("gateway"), _s("region"),
    _s("timestamp"), _s("refund_id"), _s("original_tx_id"),
    _s("refund_amount", DoubleType()), _s("reason_code"), _s("dispute_id"),
    _s("dispute_amount", DoubleType()), _s("status"), _s("batch_id"),
    _s("gross_amount", DoubleType()), _s("fees", DoubleType()),
    _s("net_amount", DoubleType()),
])

# Key and amount column of each kind, used by validation and routing.
KIND_KEY = {PAYMENT: "transaction_id", REFUND: "refund_id",
            CHARGEBACK: "dispute_id", SETTLEMENT: "batch_id"}
KIND_AMOUNT = {PAYMENT: "amount", REFUND: "refund_amount",
               CHARGEBACK: "dispute_amount", SETTLEMENT: "gross_amount"}

MERCHANT_SCHEMA = StructType([
    _s("merchant_id", nullable=False), _s("merchant_name"), _s("category"),
    _s("country"), _s("risk_tier"),
])

LEDGER_SCHEMA = StructType([
    _s("merchant_id"), _s("payment_date", DateType()),
    _s("payment_amount", MONEY), _s("settled_amount", MONEY),
    _s("discrepancy_amount", MONEY), _s("reconciliation_status"), _s("reconciled_at", TimestampType()),
])

# Silver payments: the wire columns kept, the exact amount, the parsed time
# and the partition day.
SILVER_PAYMENT_SCHEMA = StructType([
    _s("event_type"), _s("transaction_id"), _s("merchant_id"), _s("customer_id"),
    _s("amount", DoubleType()), _s("currency"), _s("gateway"), _s("region"), _s("timestamp"),
    _s("ingest_timestamp", TimestampType()), _s("amount_decimal", MONEY),
    _s("event_ts", TimestampNTZType()), _s("payment_date", DateType()),
])

# Bronze record: union columns, raw payload (kept for dead letters), decode
# error, parsed time, zero-padded partition strings, ingest time, routing and
# the ingest source and its (micro-)batch number (distinct from a settlement's
# ``batch_id``).
BRONZE_SCHEMA = StructType(list(UNION_SCHEMA.fields) + [
    _s("raw_value"), _s("decode_error"), _s("event_ts", TimestampNTZType()),
    _s("year"), _s("month"), _s("day"), _s("ingest_timestamp", TimestampType()),
    _s("reject_reason"), _s("target_table"), _s("ingest_source"), _s("ingest_batch", LongType()),
])
