"""Decimal money. Doubles round differently from engine to engine; these do not."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyhouse.schemas import MONEY, TOTAL

# Fixed value: the share of the month's total that the leader is paid.
INCENTIVE_RATE = Decimal("0.01")


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def incentive(total: Column, is_leader: Column) -> Column:
    """One percent for leaders, half cents rounded up; nothing for all others."""
    paid = F.round(total * F.lit(INCENTIVE_RATE), 2)
    return F.when(is_leader, paid).otherwise(F.lit(0)).cast(TOTAL)


def unit_price(total: Column, quantity: Column) -> Column:
    """Price per piece, half cents up, by whole-number arithmetic on cents."""
    cents = (total * F.lit(100)).cast("bigint")
    pieces = quantity.cast("bigint")
    raised = cents * 2 + pieces
    rounded = ((raised - raised % (pieces * 2)) / (pieces * 2)).cast("decimal(18,0)")
    return F.when(pieces > 0, rounded * F.lit(Decimal("0.01"))).cast(MONEY)


def as_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, for reports that leave the engine."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
