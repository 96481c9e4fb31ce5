"""Synthetic payment events as one distributed job.

Each row of a driving frame becomes one payment; refunds, chargebacks and
settlements are further events derived from a hash-chosen share of those
payments, so every reference is to a real payment and nothing is looped
on the driver.  All randomness is ``xxhash64(seed, ordinal, salt)``, so
output is deterministic and recomputes identically after executor loss.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (CHARGEBACK, DISPUTE_STATUSES, GATEWAYS, GENERATED_CURRENCIES,
                       MERCHANT_CATEGORIES, MERCHANT_COUNTRIES, PAYMENT, REFUND,
                       REFUND_REASON_CODES, REGIONS, RISK_TIERS, SETTLEMENT, UNION_SCHEMA)

# Mix of the generated stream: payments 80 %, refunds 10 %, chargebacks 2 %,
# settlements 8 % -> per payment: 1/8 refund, 1/40 chargeback, 1/10 settlement.
REFUND_PER_PAYMENT = 0.125
CHARGEBACK_PER_PAYMENT = 0.025
SETTLEMENT_PER_PAYMENT = 0.10


def _u(ordinal: Column, seed: int, salt: int) -> Column:
    """Uniform [0, 1) from a hash (53 bits)."""
    h = F.xxhash64(F.lit(seed), ordinal, F.lit(salt))
    return F.shiftright(h, 11).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)


def _pick(values, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def _iso(ts: Column, suffix: str = "Z") -> Column:
    """ISO-8601 text of a UTC wall-clock timestamp; ``suffix`` ``+00:00Z``
    reproduces tz-aware ``isoformat() + "Z"`` producers."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(suffix))


def day_weights(days_back: int, seed: int, spread: float = 0.2) -> list[float]:
    """Cumulative share of events per day: each day's volume is a fixed
    factor in [1 - spread, 1 + spread] (from a hash of seed and day)."""
    import hashlib
    f = []
    for d in range(days_back):
        h = int.from_bytes(hashlib.sha256(f"{seed}:{d}".encode()).digest()[:8], "big") / 2 ** 64
        f.append(1 - spread + 2 * spread * h)
    tot, acc, cum = sum(f), 0.0, []
    for x in f:
        acc += x
        cum.append(acc / tot)
    return cum


def merchant_reference(spark: SparkSession, merchant_count: int = 500, seed: int = 7) -> DataFrame:
    """``merchant_count`` merchants with hash-picked category, country, tier."""
    i = F.col("id") + 1
    return spark.range(merchant_count).select(
        F.concat(F.lit("merch_"), i.cast("string")).alias("merchant_id"),
        F.concat(F.lit("Merchant "), i.cast("string")).alias("merchant_name"),
        _pick(MERCHANT_CATEGORIES, _u(i, seed, 1)).alias("category"),
        _pick(MERCHANT_COUNTRIES, _u(i, seed, 2)).alias("country"),
        _pick(RISK_TIERS, _u(i, seed, 3)).alias("risk_tier"))


def synthetic_events(driver: DataFrame, ordinal: str, anchor_date: str, days_back: int = 90,
                     seed: int = 42, merchants: int = 500, customers: int = 10000,
                     discrepancy_rate: float = 0.0, daily_spread: float = 0.2,
                     ts_suffix: str = "Z") -> DataFrame:
    """S9 (+S10, S11): the union-schema event stream derived from ``driver``.

    ``ordinal`` is a unique column of ``driver`` (e.g. ``id`` of
    ``spark.range`` or a table key).  Payments get one of the ``days_back``
    days ending at ``anchor_date`` -- each day's volume a fixed factor in
    1 +/- ``daily_spread`` -- and a random second of that day (S11); amounts
    1.00-50,000.00; refunds 10-100 % of their payment; chargebacks the full
    amount; settlements 5-20x a payment with 1.5-3 % fees.  With
    ``discrepancy_rate`` > 0 that share of settlements is cut by 3-15 %
    and its net recomputed (S10).
    """
    o = F.col(ordinal).cast("long")
    # day k (1 = the anchor day) by inverse CDF over per-day volume factors
    cum = F.array(*[F.lit(c) for c in day_weights(days_back, seed, daily_spread)[:-1]])
    u1 = _u(o, seed, 1)
    k = F.size(F.filter(cum, lambda c: c <= u1)) + 1
    day = F.date_sub(F.lit(anchor_date).cast("date"), (k - 1).cast("int"))
    ts = F.timestamp_add("SECOND", F.floor(_u(o, seed, 2) * 86400).cast("long"),
                         day.cast("timestamp_ntz"))
    amount = (F.lit(100) + F.floor(_u(o, seed, 3) * 4_999_901)).cast("double") / 100
    pay = driver.select(
        o.alias("_o"), ts.alias("_ts"), amount.alias("_amt"),
        F.concat(F.lit("txn_"), F.lpad(F.hex(F.xxhash64(F.lit(seed), o)), 16, "0")).alias("_tx"),
        F.concat(F.lit("merch_"), (F.floor(_u(o, seed, 4) * merchants) + 1).cast("string")).alias("_m"),
        F.concat(F.lit("cust_"), (F.floor(_u(o, seed, 5) * customers) + 1).cast("string")).alias("_c"))

    def base(kind: str) -> dict[str, Column]:
        cols = {f.name: F.lit(None).cast(f.dataType) for f in UNION_SCHEMA.fields}
        cols["event_type"] = F.lit(kind)
        cols["merchant_id"] = F.col("_m")
        cols["timestamp"] = _iso(F.col("_ts"), ts_suffix)
        return cols

    def emit(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
        return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in UNION_SCHEMA.fields])

    p = base(PAYMENT)
    p.update(transaction_id=F.col("_tx"), customer_id=F.col("_c"), amount=F.col("_amt"),
             currency=_pick(GENERATED_CURRENCIES, _u(F.col("_o"), seed, 6)),
             gateway=_pick(GATEWAYS, _u(F.col("_o"), seed, 7)),
             region=_pick(REGIONS, _u(F.col("_o"), seed, 8)))
    r = base(REFUND)
    r.update(refund_id=F.concat(F.lit("ref_"), F.col("_tx")), original_tx_id=F.col("_tx"),
             refund_amount=F.round(F.col("_amt") * (F.lit(0.1) + 0.9 * _u(F.col("_o"), seed, 9)), 2),
             reason_code=_pick(REFUND_REASON_CODES, _u(F.col("_o"), seed, 10)))
    c = base(CHARGEBACK)
    c.update(dispute_id=F.concat(F.lit("chbk_"), F.col("_tx")), original_tx_id=F.col("_tx"),
             dispute_amount=F.col("_amt"), status=_pick(DISPUTE_STATUSES, _u(F.col("_o"), seed, 11)))
    gross = F.round(F.col("_amt") * (F.lit(5.0) + 15.0 * _u(F.col("_o"), seed, 12)), 2)
    cut = F.when(_u(F.col("_o"), seed, 13) < discrepancy_rate,
                 F.lit(0.85) + 0.12 * _u(F.col("_o"), seed, 14)).otherwise(F.lit(1.0))
    gross_final = F.round(gross * cut, 2)
    fees = F.round(gross * (F.lit(0.015) + 0.015 * _u(F.col("_o"), seed, 15)), 2)
    s = base(SETTLEMENT)
    s.update(batch_id=F.concat(F.lit("batch_"), F.col("_tx")), gross_amount=gross_final, fees=fees,
             net_amount=F.round(gross_final - fees, 2))
    return (emit(pay, p)
            .unionByName(emit(pay.filter(_u(F.col("_o"), seed, 20) < REFUND_PER_PAYMENT), r))
            .unionByName(emit(pay.filter(_u(F.col("_o"), seed, 21) < CHARGEBACK_PER_PAYMENT), c))
            .unionByName(emit(pay.filter(_u(F.col("_o"), seed, 22) < SETTLEMENT_PER_PAYMENT), s)))
