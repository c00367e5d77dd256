"""Payment transactions out of seven-column comma lines."""

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.text import parts, settled, whole_number
from tallyloom.model import NUMBER, PAYMENT_TYPES


def parse_transactions(lines: DataFrame, column: str = "line") -> DataFrame:
    """Typed columns plus ``error``: id, time (UTC), payee, beneficiary, type, amount, stamp.

    A payment type outside the domain is NULL, every other unreadable part is an error.
    """
    kept = lines.columns
    step = lines.select(*kept, parts(F.col(column), ",").alias("_p"))
    part = lambda i: F.get("_p", F.lit(i))
    # fixed value: the time format of a transaction line
    shape = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
    columns = {
        "transaction_id": whole_number(part(0), "bigint"),
        "event_time": F.when(part(1).rlike(shape), F.concat(part(1), F.lit("Z")).try_cast("timestamp")),
        "payee_id": whole_number(part(2), "bigint"),
        "beneficiary_id": whole_number(part(3), "bigint"),
        "payment_type": F.when(part(4).isin(*PAYMENT_TYPES), part(4)),
        "payment_amount": F.when(~part(5).rlike(r"\s"), part(5).try_cast(NUMBER)),
        "ingestion_ms": whole_number(part(6), "bigint"),
    }
    step = step.select(*kept, "_p", *[c.alias(name) for name, c in columns.items()])
    error = F.when(F.col("_p").isNull() | (F.size("_p") != 7), "part count")
    for name in columns:
        if name != "payment_type":
            error = error.when(F.col(name).isNull(), f"bad {name}")
    return settled(step, kept, **{name: F.col(name) for name in columns}, error=error)
