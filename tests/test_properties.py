"""Properties: any split into micro-batches gives the same answers."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickpulse.functions.decode import parse_clicks
from clickpulse.operators.totals import all_time_totals
from clickpulse.operators.windows import reaggregate_speed, window_counts
from clickpulse.sources.replay import click_records, read_events
from tests.conftest import SF_SMALL


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=st.integers(min_value=1, max_value=2000), window=st.sampled_from([10, 60, 3600]))
def test_any_micro_batch_split_gives_same_totals(spark, batch, window):
    clicks = parse_clicks(click_records(read_events(spark, SF_SMALL)), keep=("offset",))
    partials = window_counts(clicks.withColumn("batch_id", F.expr(f"offset div {batch}")), window,
                             extra_keys=("batch_id",))
    exact = window_counts(clicks, window)
    assert sorted(all_time_totals(partials).collect()) == sorted(all_time_totals(exact).collect())
    cols = ["window", "page", "trafficSource", "count"]
    assert sorted(reaggregate_speed(partials).select(cols).collect()) == sorted(exact.select(cols).collect())


def test_speed_counts_cover_every_timed_click(spark):
    clicks = parse_clicks(click_records(read_events(spark, SF_SMALL)))
    total = window_counts(clicks, 10).agg(F.sum("count")).first()[0]
    assert total == clicks.where(F.col("timestamp").isNotNull()).count()
