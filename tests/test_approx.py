from millrace.plans import catalog
from tests.conftest import SF, plan, rows


def test_an_estimate_keeps_no_registers_per_user(spark):
    """Beside countDistinct, the registers of the estimate were part of a row for every pair of type and user."""
    df = catalog.QUERIES["a06_approx_checked"](spark, SF)
    per_user = [line for line in plan(df).splitlines() if "HashAggregate(keys=[event_type" in line and "user_id" in line.split("functions=")[0]]
    assert per_user and not any("approx_count_distinct" in line for line in per_user)
    exact = spark.read.parquet(f"{SF}/events.parquet").select("event_type", "user_id").distinct().groupBy("event_type").count()
    assert rows(df, "event_type", "users", "near") == [(*r, True) for r in rows(exact, "event_type", "count")]
