"""Keyed stream state: alerts equal the batch detector's, with late and repeated rows and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import fraud
from millrace.streaming import detectors, jobs

SCHEMA = "id string, customer long, ts timestamp"
BASE = 1_700_000_000


@pytest.fixture(scope="module")
def rocks(spark):
    with detectors.keyed_state(spark):
        yield spark


def write(spark, path, number, rows):
    frame = spark.createDataFrame([(i, c, float(s)) for i, c, s in rows], "id string, customer long, s double")
    frame.select("id", "customer", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(f"{path}/n={number:03d}")


def read(spark, path):
    return spark.readStream.schema(SCHEMA + ", n string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def run(spark, path, out, count=10, seconds=300):
    stream = detectors.rapid_succession_stream(read(spark, path), "customer", "ts", count, seconds, "60 seconds", "id")
    jobs.run_to_files(stream, f"{out}/rows", f"{out}/checkpoint")
    return sorted(tuple(r) for r in spark.read.parquet(f"{out}/rows").collect())


def test_tenth_event_alerts_once(rocks, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    burst = [(f"a{i}", 1, BASE + 30 * i) for i in range(12)]  # the reference case: ten, 30 s apart
    slow = [(f"b{i}", 2, BASE + 40 * i) for i in range(12)]
    write(rocks, src, 0, burst[:6] + slow[:6])
    write(rocks, src, 1, burst[6:] + slow[6:] + burst[8:10])  # two sent again
    write(rocks, src, 2, [("flush", 9, BASE + 5_000)])
    assert run(rocks, src, out) == [(1, BASE + 270, 10)]


def test_equals_batch_with_disorder_late_rows_and_restart(rocks, tmp_path):
    rng = random.Random(7)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows, clock = [], BASE
    for i in range(900):
        clock += rng.choice([0, 0, 1, 2, 9])
        customer = rng.choice([1, 1, 1, 2, 3, None])
        rows.append((f"t{i}", customer, clock + rng.random()))
    # Out of order, but never by more than the watermark waits for.
    sent = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 25))
    sent += [rng.choice(sent[-40:]) for _ in range(20)]
    parts = [sent[i:i + 150] for i in range(0, len(sent), 150)]
    for n, part in enumerate(parts[:3]):
        write(rocks, src, n, part)
    first = run(rocks, src, out, 5, 20)
    for n, part in enumerate(parts[3:], 3):
        write(rocks, src, n, part)
    write(rocks, src, 50, [("flush", 99, clock + 9_000)])
    write(rocks, src, 51, [("too late", 1, BASE + k / 10) for k in range(30)])
    both = run(rocks, src, out, 5, 20)
    batch = rocks.createDataFrame(rows, "id string, customer long, s double").select("customer", F.timestamp_seconds("s").alias("ts"))
    want = sorted(tuple(r) for r in fraud.rapid_alerts(batch, "customer", "ts", 5, 20).collect())
    assert both == want and 0 < len(first) < len(want)


def test_state_expires(rocks, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(rocks, src, 0, [(f"a{i}", i, BASE + i) for i in range(50)])
    write(rocks, src, 1, [("b", 900, BASE + 9_000)])
    write(rocks, src, 2, [("c", 901, BASE + 18_000)])
    run(rocks, src, out)
    state = rocks.read.format("statestore").option("operatorId", 0).option("stateVarName", "total").load(f"{out}/checkpoint")
    assert state.count() <= 2


def test_batch_alerts_are_crossings(spark):
    rows = [(1, BASE + s) for s in (0, 1, 2, 3, 4, 30, 31, 32, 33)] + [(None, BASE)] * 9 + [(2, None)] * 9
    frame = spark.createDataFrame(rows, "customer long, s long").select("customer", F.timestamp_seconds("s").alias("ts"))
    got = sorted(tuple(r) for r in fraud.rapid_alerts(frame, "customer", "ts", 3, 10).collect())
    assert got == [(1, BASE + 2, 3), (1, BASE + 32, 3)]
