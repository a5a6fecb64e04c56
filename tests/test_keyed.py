"""The merged spend table: same rows as resolving every batch, at less reading."""

import datetime as dt
import random

import pytest

from clickpulse.cli import main
from clickpulse.operators.spend import dedupe_spend
from clickpulse.plans.keyed import Manifest, merge_batches, read_merged
from clickpulse.sources.sinks import write_batch_folder
from clickpulse.streaming.spend import read_spend_table

START = dt.datetime(2024, 1, 1)


def _micros(minutes):
    return round((START + dt.timedelta(minutes=minutes)).timestamp() * 1e6)


DDL = "account_id long, log_ts timestamp, amount long, offset long"


def _batch(spark, path, number, rows, run="r"):
    df = spark.createDataFrame([(a, START + dt.timedelta(minutes=t), m, o) for a, t, m, o in rows], DDL)
    write_batch_folder(dedupe_spend(df, "last", order_col="offset", keep_order=True), path, number, run=run)


def _rows(df):
    return sorted((r.account_id, r.log_ts, r.amount) for r in df.collect())


@pytest.fixture
def table(spark, workdir):
    """Ten batches of rising times, which also write old keys again."""
    rng, path, best, offset = random.Random(1), f"{workdir}/spend", {}, 0
    for n in range(10):
        rows = []
        for _ in range(40):
            t = rng.randrange(n * 30, n * 30 + 60) if rng.random() < 0.9 else rng.randrange(0, 60)
            rows.append((rng.choice([1, 1, 1, 2, 3]), t, rng.randrange(1000), offset))
            best[rows[-1][:2]] = rows[-1][2]
            offset += 1
        _batch(spark, path, n, rows)
    return path, sorted((a, START + dt.timedelta(minutes=t), m) for (a, t), m in best.items())


def test_merged_reads_equal_the_plain_one(spark, table):
    path, expected = table
    assert _rows(read_spend_table(spark, path)) == expected
    assert merge_batches(spark, path, keep_batches=6, rows_per_file=25) == {"r": 3}
    assert _rows(read_spend_table(spark, path)) == expected
    first = {f.file for f in Manifest(spark, path).files}
    assert len(first) > 2
    assert merge_batches(spark, path, keep_batches=3, rows_per_file=25) == {"r": 6}
    assert _rows(read_spend_table(spark, path)) == expected
    assert merge_batches(spark, path, keep_batches=0, rows_per_file=25) == {"r": 9}
    assert _rows(read_spend_table(spark, path)) == expected
    manifest = Manifest(spark, path)
    assert sum(f.rows for f in manifest.files) == len(expected)
    assert merge_batches(spark, path, keep_batches=0) == {}
    assert _rows(read_spend_table(spark, path)) == expected  # replaced folders and files are gone


def test_a_merge_reads_only_the_files_that_new_batches_touch(spark, workdir):
    path = f"{workdir}/spend"
    for n in range(4):
        _batch(spark, path, n, [(1, n * 100 + t, t, n * 50 + t) for t in range(50)])
    merge_batches(spark, path, keep_batches=2)
    old = {f.file for f in Manifest(spark, path).files}
    merge_batches(spark, path, keep_batches=0)
    new = {f.file for f in Manifest(spark, path).files}
    assert old < new  # none of the older files was written again
    lo, hi = START + dt.timedelta(minutes=110), START + dt.timedelta(minutes=120)
    part = read_merged(spark, path, low=lo, high=hi)
    assert _rows(part) == [(1, START + dt.timedelta(minutes=t), t - 100) for t in range(110, 121)]
    touched = Manifest(spark, path).split(_micros(110), _micros(120))[0]
    assert 0 < len(touched) < len(new)
    files = {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1] for f in part.inputFiles()}
    assert files == {f.file for f in touched}


def test_unmerged_files_are_scanned_without_a_shuffle(spark, workdir):
    path = f"{workdir}/spend"
    _batch(spark, path, 0, [(1, t, t, t) for t in range(20)])
    _batch(spark, path, 1, [(1, 500 + t, t, 100 + t) for t in range(20)])
    merge_batches(spark, path, keep_batches=1)
    manifest = Manifest(spark, path)
    assert manifest.split(_micros(500), _micros(520))[0] == [] and len(_rows(read_merged(spark, path))) == 40


def test_error_policy_fails_on_a_key_across_merges(spark, workdir):
    path = f"{workdir}/spend"
    _batch(spark, path, 0, [(1, 1, 5, 0)])
    merge_batches(spark, path, policy="error", keep_batches=0)
    _batch(spark, path, 1, [(1, 1, 6, 1)])
    with pytest.raises(Exception, match="duplicate primary key"):
        read_spend_table(spark, path, policy="error").collect()
    with pytest.raises(Exception, match="duplicate primary key"):
        merge_batches(spark, path, policy="error", keep_batches=0)
    assert _rows(read_spend_table(spark, path)) == [(1, START + dt.timedelta(minutes=1), 6)]


def test_unfinished_batches_and_two_runs(spark, workdir):
    path = f"{workdir}/spend"
    _batch(spark, path, 0, [(1, 1, 5, 0)], run="a")
    _batch(spark, path, 0, [(1, 1, 9, 7), (2, 1, 1, 8)], run="b")
    _batch(spark, path, 1, [(2, 1, 2, 9)], run="b")
    import os
    os.remove(f"{path}/run=b/batch_id=1/_SUCCESS")  # still being written
    main(["merge", "--path", path, "--keep-batches", "0"])
    assert Manifest(spark, path).through == {"a": 0, "b": 0}
    assert _rows(read_spend_table(spark, path)) == [(1, START + dt.timedelta(minutes=1), 9), (2, START + dt.timedelta(minutes=1), 2)]


def test_empty_table(spark, workdir):
    assert merge_batches(spark, f"{workdir}/none") == {}
    assert read_merged(spark, f"{workdir}/none").count() == 0
