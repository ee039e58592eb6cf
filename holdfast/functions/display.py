"""Numbers as text. ``format_number`` rounds half to even, as the reports expect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(share: Column, digits: int) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def signed_percent(share: Column, digits: int) -> Column:
    return F.concat(F.when(share >= 0, "+").otherwise(""), percent(share, digits))


def dollars(amount: Column, digits: int, grouped: bool = True) -> Column:
    text = F.format_number(amount, digits)
    return F.concat(F.lit("$"), text if grouped else F.replace(text, F.lit(","), F.lit("")))
