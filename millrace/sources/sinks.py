"""Fan-out and quarantine of batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def fan_out(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], object]]) -> dict[str, str | None]:
    """Compute once, write to every sink; a failing sink does not stop the others.

    Returns the error text per sink, None where it worked.
    """
    ready = stage(df, "fan-out")
    outcome: dict[str, str | None] = {}
    for name, write in sinks.items():
        try:
            write(ready)
            outcome[name] = None
        except Exception as e:  # noqa: BLE001 - any sink error is reported, not raised
            outcome[name] = f"{type(e).__name__}: {e}"
    return outcome


def quarantine(df: DataFrame, path: str, batch_id: int | str, errors: str = "errors", reason: Column | None = None) -> DataFrame:
    """Write rows with errors to ``path/batch_id=…`` and return the good rows.

    Writing a batch again replaces its folder, so a replay adds nothing.
    """
    bad = df.where(F.size(errors) > 0)
    if reason is not None:
        bad = bad.withColumn("reason", reason)
    bad.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return df.where(F.size(errors) == 0).drop(errors)
