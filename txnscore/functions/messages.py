"""Expressions for the fields of a transaction message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def transaction_id(number: Column) -> Column:
    """``TXN-`` and the number padded to eight digits; longer numbers keep all digits."""
    return F.format_string("TXN-%08d", number.cast("long"))


def alert_id(transaction: Column) -> Column:
    """Derived from the transaction, so that a replayed batch sends the same id again."""
    return F.concat(F.lit("ALERT-"), transaction)


def epoch_seconds(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp")).cast("double") / F.lit(float(MICROS))


def iso_text(moment: Column) -> Column:
    """ISO 8601 without zone; the fraction is left out on whole seconds."""
    instant = moment.cast("timestamp")
    whole = F.unix_micros(instant) % F.lit(MICROS) == 0
    return F.when(whole, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
