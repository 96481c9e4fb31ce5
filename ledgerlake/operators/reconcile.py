"""Reconciliation: daily sides (A3, A4), ledger (A5), counts (A6, Q8),
report (A13), settlement lag (A11) and dispute registry (A12)."""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import money, parse_event_ts
from ..functions.skew import salted_join
from ..schemas import AWAITING, DEFAULT_TOLERANCE, FLAGGED, MONEY, RECONCILED, TOTAL, WITHIN_TOLERANCE


def _sum_money(c) -> F.Column:
    return F.sum(c).cast(MONEY)


def daily_payments(payments: DataFrame) -> DataFrame:
    """A3: silver payments -> (merchant_id, payment_date, payment_amount)."""
    return (payments.groupBy("merchant_id", F.to_date("event_ts").alias("payment_date"))
                    .agg(_sum_money("amount_decimal").alias("payment_amount")))


def daily_settlements(settlements: DataFrame) -> DataFrame:
    """A4: settlement events -> (merchant_id, settlement_date, settled_amount).

    Gross amounts are cast to DECIMAL(18,2) before summing, so the ledger
    compares exact money (never DECIMAL minus DOUBLE).
    """
    d = F.to_date(parse_event_ts("timestamp")) if "settlement_date" not in settlements.columns \
        else F.col("settlement_date")
    return (settlements.groupBy("merchant_id", d.alias("settlement_date"))
                       .agg(_sum_money(money("gross_amount")).alias("settled_amount")))


def ledger(pay_daily: DataFrame, settle_daily: DataFrame,
           tolerance: str | Decimal = DEFAULT_TOLERANCE) -> DataFrame:
    """A5 (+J1, P8, P9): one row per (merchant_id, payment_date).

    Both inputs are aggregates keyed by (merchant, day), so their size grows
    with merchants x days, not with events; the left join reuses their
    hash partitioning on the same keys.
    """
    tol = F.lit(Decimal(str(tolerance))).cast(MONEY)
    s = settle_daily.withColumnRenamed("merchant_id", "s_merchant_id")
    j = pay_daily.join(s, (pay_daily.merchant_id == s.s_merchant_id)
                       & (pay_daily.payment_date == s.settlement_date), "left")
    disc = F.abs(F.col("payment_amount") - F.coalesce(F.col("settled_amount"),
                                                      F.lit(0).cast(MONEY))).cast(MONEY)
    status = (F.when(F.col("settled_amount").isNull(), F.lit(AWAITING))
               .when(F.col("discrepancy_amount") == 0, F.lit(RECONCILED))
               .when(F.col("discrepancy_amount") <= tol, F.lit(WITHIN_TOLERANCE))
               .otherwise(F.lit(FLAGGED)))
    return (j.select("merchant_id", "payment_date", "payment_amount", "settled_amount",
                     disc.alias("discrepancy_amount"))
             .withColumn("reconciliation_status", status))


def reconcile(payments: DataFrame, settlements: DataFrame,
              tolerance: str | Decimal = DEFAULT_TOLERANCE) -> DataFrame:
    """A3 + A4 + A5 in one plan."""
    return ledger(daily_payments(payments), daily_settlements(settlements), tolerance)


def ledger_counts(led: DataFrame) -> DataFrame:
    """One pass of conditional counts (no re-scan per status)."""
    st = F.col("reconciliation_status")
    return led.agg(
        F.count(F.lit(1)).alias("ledger_rows"),
        F.count_if(st.isin(RECONCILED, WITHIN_TOLERANCE)).alias("reconciled"),
        F.count_if(st == RECONCILED).alias("reconciled_exact"),
        F.count_if(st == WITHIN_TOLERANCE).alias("reconciled_within_tolerance"),
        F.count_if(st == FLAGGED).alias("discrepancies"),
        F.count_if(st == AWAITING).alias("awaiting_settlement"))


def discrepancy_counts(led: DataFrame) -> DataFrame:
    """Q8: counts by discrepancy type (``amount_mismatch``, ``missing_settlement``)."""
    c = ledger_counts(led)
    return c.select(F.explode(F.array(
        F.struct(F.lit("amount_mismatch").alias("discrepancy_type"),
                 F.col("discrepancies").alias("discrepancy_count")),
        F.struct(F.lit("missing_settlement").alias("discrepancy_type"),
                 F.col("awaiting_settlement").alias("discrepancy_count")))).alias("r")).select("r.*")


def reconciliation_report(led: DataFrame) -> DataFrame:
    """Per day x status: merchants, amounts and discrepancy share."""
    pay = F.sum("payment_amount").cast(TOTAL)
    disc = F.sum("discrepancy_amount").cast(TOTAL)
    return (led.groupBy("payment_date", "reconciliation_status")
               .agg(F.count(F.lit(1)).alias("merchant_days"),
                    pay.alias("payment_total"),
                    F.sum("settled_amount").cast(TOTAL).alias("settled_total"),
                    disc.alias("discrepancy_total"))
               .withColumn("discrepancy_share",
                           F.coalesce(F.try_divide(F.col("discrepancy_total").cast("double"),
                                                   F.col("payment_total").cast("double")),
                                      F.lit(0.0))))


def settlement_lag(pay_daily: DataFrame, settle_daily: DataFrame) -> DataFrame:
    """Days from each payment day to the merchant's next settlement day (>=).

    The window runs per merchant over *days* (one row per active day per
    side), so its partition size is bounded by the calendar, not by the
    number of events.  Output per merchant: payment days, unsettled days,
    max/total/avg lag in days.
    """
    days = (pay_daily.select("merchant_id", F.col("payment_date").alias("d"),
                             F.lit(0).alias("kind"))
            .unionByName(settle_daily.select("merchant_id", F.col("settlement_date").alias("d"),
                                             F.lit(1).alias("kind")))
            .filter(F.col("d").isNotNull()))
    w = (Window.partitionBy("merchant_id").orderBy("d", "kind")
               .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nxt = F.min(F.when(F.col("kind") == 1, F.col("d"))).over(w)
    lag = (days.withColumn("next_settlement", nxt).filter(F.col("kind") == 0)
               .withColumn("lag_days", F.datediff("next_settlement", "d").cast("bigint")))
    return (lag.groupBy("merchant_id")
               .agg(F.count(F.lit(1)).alias("payment_days"),
                    F.count_if(F.col("next_settlement").isNull()).alias("unsettled_days"),
                    F.max("lag_days").alias("max_lag_days"),
                    F.sum("lag_days").alias("total_lag_days"),
                    F.avg("lag_days").alias("avg_lag_days")))


def parent_lookup(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str,
                  how: str = "left") -> DataFrame:
    """Children (refunds, chargebacks) joined to their parent payment;
    a parent that holds a large share of the children has them spread over
    salted tasks (``functions.skew.salted_join``)."""
    return salted_join(children, parents, child_key, parent_key, how)


def dispute_registry(chargebacks: DataFrame, payments: DataFrame) -> DataFrame:
    """A12 (+J7): each dispute joined to its original payment, latest event per dispute.

    ``registry_status``: ``orphan`` (no payment), ``amount_mismatch`` or
    ``matched``.  Latest-per-dispute is a ``max_by`` aggregate (partial,
    skew-proof) instead of a row_number over a possibly hot key.
    """
    cb = chargebacks.select("dispute_id", "original_tx_id", "merchant_id",
                            money("dispute_amount").alias("dispute_amount"),
                            parse_event_ts("timestamp").alias("filed_ts"))
    latest = (cb.groupBy("dispute_id")
                .agg(F.max_by(F.struct(*[c for c in cb.columns if c != "dispute_id"]),
                              F.struct("filed_ts", "original_tx_id", "merchant_id",
                                       "dispute_amount")).alias("_l"))
                .select("dispute_id", "_l.*"))
    pay = payments.select(F.col("transaction_id").alias("p_tx"),
                          money("amount").alias("payment_amount"),
                          F.col("merchant_id").alias("payment_merchant_id"))
    j = parent_lookup(latest, pay, "original_tx_id", "p_tx", "left")
    status = (F.when(F.col("p_tx").isNull(), F.lit("orphan"))
               .when(~F.coalesce(F.col("dispute_amount") == F.col("payment_amount"), F.lit(False)),
                     F.lit("amount_mismatch"))
               .otherwise(F.lit("matched")))
    return j.select("dispute_id", "original_tx_id", "merchant_id", "dispute_amount", "filed_ts",
                    "payment_amount", "payment_merchant_id",
                    F.col("p_tx").isNotNull().alias("payment_found"),
                    status.alias("registry_status"))
