import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.watermark import AckTracker, ack_counts, ack_watermark, lag_series, late, watermark


def run(sinks, *steps):
    t = AckTracker(sinks)
    return [getattr(t, name)(*args) for name, *args in steps]


def test_gapped():
    steps = [("observe", x) for x in (100, 250, 310, 480)] + [("confirm", x, "a") for x in (100, 310, 250, 480)]
    assert run(["a"], *steps)[4:] == [100, 100, 310, 480]


def test_out_of_order():
    steps = [("observe", x) for x in range(1, 6)] + [("confirm", x, "a") for x in (3, 2, 5, 1, 4)]
    assert run(["a"], *steps)[5:] == [0, 0, 0, 3, 5]


def test_two_sinks():
    steps = [("observe", x) for x in (100, 200, 300)] + [("confirm", 100, "a"), ("confirm", 100, "b"), ("confirm", 300, "a"), ("confirm", 300, "b"), ("confirm", 200, "a"), ("confirm", 200, "b")]
    assert run(["a", "b"], *steps)[3:] == [0, 100, 100, 100, 100, 300]


def test_multiplicity():
    steps = [("observe", 100), ("observe", 100)] + [("confirm", 100, s) for s in "abab"]
    assert run(["a", "b"], *steps)[2:] == [0, 0, 0, 100]


def test_filtered_between():
    assert run(["a"], ("observe", 100), ("observe", 150, True), ("observe", 200), ("confirm", 100, "a"), ("confirm", 200, "a"))[3:] == [150, 200]


def test_confirm_before_observe():
    assert run(["a"], ("confirm", 100, "a"), ("observe", 100)) == [0, 100]


def test_idle_jumps():
    t = AckTracker(["a"])
    t.observe(10)
    assert not t.idle(50)
    t.confirm(10, "a")
    assert not t.idle(50) and t.idle(50) and t.mark == 50
    t.observe(60)
    t.confirm(60, "a")
    assert not t.idle(90) and t.idle(90)


def test_hydrate_never_moves_back():
    t = AckTracker(["a"])
    assert t.hydrate(500) == 500 and t.hydrate(100) == 500 and t.confirm(400, "a") == 500 and t.observe(450) == 500 and t.dropped == 1


def test_a_filtered_event_does_not_pass_its_own_lsn_in_strict_groups():
    t = AckTracker(["a"], strict_groups=True)
    assert t.observe(100, True) == 0 and t.observe(100) == 0 and t.dropped == 0
    t.observe(200, True)
    assert t.mark == 0 and t.confirm(100, "a") == 100 and t.settle() == 200


@pytest.mark.parametrize("seed", range(3))
def test_closed_form_equals_the_tracker(spark, seed):
    rng = random.Random(seed)
    observed, confirms, tracker = [], [], AckTracker(["a", "b"])
    for lsn in sorted(rng.sample(range(1, 400), 80)):
        for own in sorted(rng.random() < 0.3 for _ in range(rng.choice([1, 1, 2]))):
            observed.append((lsn, own))
            tracker.observe(lsn, own)
    for lsn, own in observed:
        if not own:
            confirms += [(lsn, s) for s in "ab" if rng.random() < 0.97]
    rng.shuffle(confirms)
    for c in confirms:
        tracker.confirm(*c)
    rows = spark.createDataFrame(observed, "lsn long, self_acked boolean"), spark.createDataFrame(confirms, "lsn long, sink_id string")
    assert watermark(ack_counts(*rows, ["a", "b"])).first().watermark == tracker.mark
    assert ack_watermark(*rows, ["a", "b"]).first() == watermark(ack_counts(*rows, ["a", "b"])).first()


def test_groups_late_events_and_empty_logs(spark):
    o = spark.createDataFrame([("s", 1, False), ("s", 2, False), ("t", 5, True)], "source_id string, lsn long, self_acked boolean")
    c = spark.createDataFrame([("s", 1, "a")], "source_id string, lsn long, sink_id string")
    marks = watermark(ack_counts(o, c, ["a"], ["source_id"]), ["source_id"])
    assert {r.source_id: r.watermark for r in marks.collect()} == {"s": 1, "t": 5}
    assert sorted((r.source_id, r.lsn) for r in late(o, marks).collect()) == [("s", 1), ("t", 5)]
    assert watermark(ack_counts(o.limit(0).drop("source_id"), c.limit(0).drop("source_id"), ["a"])).count() <= 1


def test_growth_is_never_negative(spark):
    df = spark.createDataFrame([("p", 1, 10), ("p", 2, 15), ("p", 3, 3), ("p", 4, 4)], "p string, t int, total long")
    assert [r.delta for r in lag_series(df, ["p"], "t", "total").orderBy(F.col("t")).collect()] == [0, 5, 0, 1]
