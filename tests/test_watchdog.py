"""The watchdog stream against a plain walk through the events."""

import random
import time

from tracelens.streaming import watchdog as W

LIMIT = 300


def _walk(events):
    """Each item by itself: the first second from its start on at which its node's silence is over the limit."""
    now = max(t for *_, t in events)
    out = {}
    for item in {i for k, _, i, _ in events if k == "start"}:
        since, node = max((t, n) for k, n, i, t in events if k == "start" and i == item)
        ended = [t for k, _, i, t in events if k == "end" and i == item and t >= since]
        beats = sorted(t for k, n, _, t in events if k == "beat" and n == node)
        fails = []
        for last, following in zip([None, *beats], [*beats, None]):
            at = since if last is None else max(since, last + LIMIT + 0.000001)
            if at <= now and (following is None or at < following):
                fails.append(at)
        if fails and (not ended or max(ended) > min(fails)):
            out[item] = (node, round(min(fails) * 10**6))
    return out


def _frame(spark, events):
    return spark.createDataFrame([(k, n, i, None if t is None else int(t * 10**6)) for k, n, i, t in events], W.EVENTS)


def _run(spark, batches, root):
    for epoch, rows in enumerate(batches):
        W.watch(_frame(spark, rows), epoch, root, timeout_s=LIMIT)
        if epoch == 1:
            W.watch(_frame(spark, rows), epoch, root, timeout_s=LIMIT)  # a replay
    return {r["item"]: (r["node"], r["failed_at_us"]) for r in spark.read.schema(W.FAILED).parquet(f"{root}/out").collect()}


def test_every_node_falls_silent(spark, tmp_dir):
    """Nothing but the clock's ticks comes any more."""
    batches = [[("beat", 1, None, 0), ("beat", 2, None, 10), ("start", 1, "a", 5), ("start", 2, "b", 20)], [("tick", None, None, 200)], [("tick", None, None, 305)], [("tick", None, None, 1000)]]
    assert _run(spark, batches, tmp_dir) == {"a": (1, 300_000_001), "b": (2, 310_000_001)} == _walk(sum(batches, []))


def test_batches_make_no_difference(spark, tmp_dir):
    rng = random.Random(2)
    events = [("beat", rng.randint(1, 5), None, t) for t in rng.sample(range(4000), 60)]
    events += [("start", rng.randint(1, 6), f"i{k}", rng.randint(0, 4000)) for k in range(60)]
    events += [("end", None, f"i{k}", rng.randint(0, 4400)) for k in range(0, 60, 3)] + [("tick", None, None, 4500)]
    events.sort(key=lambda e: e[3])
    want = _walk(events)
    assert 5 < len(want) < 60
    odd = [("beat", None, None, 1), ("start", 1, None, 1), ("start", None, "x", 1), ("beat", 9, None, None)]
    assert _run(spark, [events + odd], f"{tmp_dir}/one") == want
    cuts = [0, 20, 21, 60, 110, len(events)]
    assert _run(spark, [events[a:b] for a, b in zip(cuts, cuts[1:])], f"{tmp_dir}/many") == want


def test_clock_of_a_running_stream(spark, tmp_dir):
    """A live query: one heartbeat, one item, then silence; the rate source's ticks alone bring up the ERR row."""
    now = time.time()
    _frame(spark, [("beat", 1, None, now), ("start", 1, "a", now)]).write.parquet(f"{tmp_dir}/in")
    events = spark.readStream.schema(W.EVENTS).parquet(f"{tmp_dir}/in")
    query = W.watchdog_stream(W.with_clock(events), f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=False, timeout_s=3)
    try:
        found = []
        for _ in range(90):
            time.sleep(1)
            try:
                found = spark.read.schema(W.FAILED).parquet(f"{tmp_dir}/out/out/run={query.id}").collect()
            except Exception:  # noqa: BLE001 - no epoch is written yet
                pass
            if found:
                break
    finally:
        query.stop()
    assert [(r["item"], r["status"], r["status_msg"]) for r in found] == [("a", "ERR", "vm watchdog timeout")]
