"""Gold aggregates: daily merchant summary (A1 + J2), hourly volume (A2),
merchant analytics (A7-A9) and the daily summary with top currency (A14)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hour_of, safe_ratio
from ..schemas import MONEY, TOTAL


def _summary_aggs():
    return [F.count("transaction_id").alias("transaction_count"),
            F.sum("amount_decimal").cast(MONEY).alias("total_amount"),
            F.avg("amount_decimal").cast(MONEY).alias("avg_amount"),
            F.count_distinct("customer_id").alias("unique_customers")]


def daily_merchant_summary(payments: DataFrame, merchants: DataFrame | None = None,
                           report_date=None) -> DataFrame:
    """A1: per (merchant_id, report_date): count, total, avg, distinct customers.

    ``report_date`` (optional) filters before the aggregate; on a table
    partitioned by ``payment_date`` pass a filter on that column instead so
    it prunes directories.  The merchant dimension is joined after the
    aggregate (rows = merchants x days); Spark's own byte threshold and
    run-time statistics choose the join (J2).
    """
    d = F.to_date("event_ts")
    src = payments if report_date is None else payments.filter(d == F.lit(report_date).cast("date"))
    daily = src.groupBy("merchant_id", d.alias("report_date")).agg(*_summary_aggs())
    if merchants is None:
        return daily
    return daily.join(merchants, "merchant_id", "left")


def hourly_volume(payments: DataFrame, report_date=None) -> DataFrame:
    """A2: per (hour, currency, region): count and volume; ``hour`` stays NTZ."""
    src = payments if report_date is None else \
        payments.filter(F.to_date("event_ts") == F.lit(report_date).cast("date"))
    return (src.groupBy(hour_of("event_ts").alias("hour"), "currency", "region")
               .agg(F.count("transaction_id").alias("transaction_count"),
                    F.sum("amount_decimal").cast(MONEY).alias("total_volume")))


def merchant_payments(payments: DataFrame) -> DataFrame:
    """Lifetime count and GMV per merchant."""
    return payments.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount_decimal").cast(TOTAL).alias("total_gmv"))


def count_by_merchant(df: DataFrame, id_col: str, name: str) -> DataFrame:
    """Count of ``id_col`` per merchant."""
    return df.groupBy("merchant_id").agg(F.count(id_col).alias(name))


def merchant_analytics(payments: DataFrame, refunds: DataFrame, chargebacks: DataFrame,
                       computed_at=None) -> DataFrame:
    """A9 (+J3, P10): refund ratio and chargeback rate per merchant, NULL -> 0.

    All three sides are aggregates on ``merchant_id``; the two left joins
    reuse that hash partitioning, so no extra exchange is planned.
    """
    return merchant_ratios(merchant_payments(payments), refunds, chargebacks, computed_at)


def merchant_ratios(totals: DataFrame, refunds: DataFrame, chargebacks: DataFrame, computed_at=None) -> DataFrame:
    """A9 from the merchants' payment totals."""
    r = (totals
         .join(count_by_merchant(refunds, "refund_id", "refund_count"), "merchant_id", "left")
         .join(count_by_merchant(chargebacks, "dispute_id", "chargeback_count"), "merchant_id", "left")
         .fillna(0, subset=["refund_count", "chargeback_count"])
         .withColumn("refund_ratio", safe_ratio("refund_count", "total_transactions"))
         .withColumn("chargeback_rate", safe_ratio("chargeback_count", "total_transactions")))
    if computed_at is not None:
        r = r.withColumn("computed_at", computed_at)
    return r


def daily_summary_top_currency(payments: DataFrame, report_date=None) -> DataFrame:
    """A1 plus the most frequent currency per merchant-day.

    Ties go to the alphabetically smallest code.  Built from two partial
    aggregates (no per-merchant row lists): counts per (merchant, day,
    currency), then ``min_by(currency, (-count, currency))``.
    """
    d = F.to_date("event_ts")
    src = payments if report_date is None else payments.filter(d == F.lit(report_date).cast("date"))
    keyed = src.withColumn("report_date", d)
    base = keyed.groupBy("merchant_id", "report_date").agg(*_summary_aggs())
    top = (keyed.groupBy("merchant_id", "report_date", "currency").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("merchant_id", "report_date")
                .agg(F.min_by("currency", F.struct((-F.col("n")).alias("neg_n"),
                                                   F.col("currency"))).alias("top_currency")))
    return base.join(top, ["merchant_id", "report_date"], "left")
