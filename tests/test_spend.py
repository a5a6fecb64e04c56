import pytest

from clickpulse.operators.spend import dedupe_spend, spend_by_account
from tests.helpers import ts

DDL = "account_id long, amount int, log_ts timestamp, offset long"


def tx(spark, rows):
    return spark.createDataFrame([(a, m, ts(t) if t else None, o) for a, m, t, o in rows], DDL)


def test_last_policy_keeps_latest_offset(spark):
    df = tx(spark, [(1, 10, "2000-01-01 01:00:00", 0), (1, 20, "2000-01-01 01:00:00", 5),
                    (1, 30, "2000-01-01 01:00:00", 3), (2, 7, "2000-01-01 01:00:00", 1)])
    got = sorted((r.account_id, r.amount) for r in dedupe_spend(df, "last").collect())
    assert got == [(1, 20), (2, 7)]
    schema = dedupe_spend(df, "last").dtypes
    assert schema == [("account_id", "bigint"), ("log_ts", "timestamp"), ("amount", "bigint")]


def test_error_policy_fails_on_conflict(spark):
    df = tx(spark, [(1, 10, "2000-01-01 01:00:00", 0), (1, 20, "2000-01-01 01:00:00", 1)])
    with pytest.raises(Exception, match="duplicate primary key"):
        dedupe_spend(df, "error").collect()
    ok = tx(spark, [(1, 10, "2000-01-01 01:00:00", 0), (1, 20, "2000-01-01 01:05:00", 1)])
    assert dedupe_spend(ok, "error").count() == 2


def test_null_fails(spark):
    df = tx(spark, [(None, 10, "2000-01-01 01:00:00", 0)])
    with pytest.raises(Exception, match="NOT NULL"):
        dedupe_spend(df, "last").collect()
    df = tx(spark, [(1, 10, None, 0)])
    with pytest.raises(Exception, match="NOT NULL"):
        dedupe_spend(df, "last").collect()


def test_keep_order(spark):
    df = tx(spark, [(1, 10, "2000-01-01 01:00:00", 0), (1, 20, "2000-01-01 01:00:00", 5)])
    r = dedupe_spend(df, "last", keep_order=True).collect()[0]
    assert (r.amount, r.offset) == (20, 5)


def test_spend_by_account_band(spark):
    rep = spark.createDataFrame([(1, ts("2000-01-01 01:00:00"), 50), (1, ts("2000-01-01 01:05:00"), 30),
                                 (2, ts("2000-01-01 01:00:00"), 79)], "account_id long, log_ts timestamp, amount long")
    got = sorted((r.metric, r.value, r.band) for r in spend_by_account(rep).collect())
    assert got == [("1", 80, "red"), ("2", 79, "green")]
    timed = spend_by_account(rep, with_time=True)
    assert timed.columns == ["time", "metric", "value", "band"]


def test_null_order_fails(spark):
    with pytest.raises(Exception, match="NULL in NOT NULL column offset"):
        dedupe_spend(tx(spark, [(1, 10, "2000-01-01 01:00:00", None)]), "last").collect()


def test_table_written_with_error_reads_with_last(spark, workdir, capsys):
    """The spend job's rows keep their offsets under both policies, so the
    dashboard's default policy reads either."""
    from clickpulse.cli import main
    from tests.helpers import records

    records(spark, ["1, 100, 2000-01-01 01:00:00", "1, 50, 2000-01-01 02:00:00"], keys=[1, 1]).write.parquet(f"{workdir}/tx")
    main(["spend", "--source-path", f"{workdir}/tx", "--available-now", "--checkpoint", f"{workdir}/ck",
          "--path", f"{workdir}/spend", "--policy", "error"])
    capsys.readouterr()
    main(["dashboard", "--path", f"{workdir}/spend"])
    line = next(ln for ln in capsys.readouterr().out.splitlines() if "red" in ln or "green" in ln)
    assert "150" in line and "red" in line


def test_last_over_jdbc_needs_a_merge(spark, workdir):
    from clickpulse.sources.kafka import read_record_files
    from clickpulse.streaming.spend import start_spend_report
    from tests.helpers import records

    records(spark, ["1, 100, 2000-01-01 01:00:00", "1, 50, 2000-01-01 01:00:00"], keys=[1, 1]).coalesce(1).write.parquet(
        f"{workdir}/tx")
    source = lambda: read_record_files(spark, f"{workdir}/tx")
    with pytest.raises(ValueError, match="merge"):
        start_spend_report(source(), f"{workdir}/ck", fmt="jdbc", policy="last")
    got = []
    q = start_spend_report(source(), f"{workdir}/ck", fmt="jdbc", policy="last", available_now=True,
                           merge=lambda rows, _: got.extend(r.amount for r in rows.collect()))
    q.awaitTermination()
    assert got == [50]
