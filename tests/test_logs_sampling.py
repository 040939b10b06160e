import datetime as dt
import hashlib
import math

import numpy as np
import pytest

from tokenloom.operators import logs, sampling

NAN, INF = float("nan"), float("inf")
T0 = dt.datetime(2024, 1, 1)
ROWS = [("a", 0, NAN), ("a", 1, 3.0), ("a", 2, 3.0), ("a", 3, 2.0), ("a", 4, NAN), ("a", 5, 1.0),
        ("b", 10, 5.0), ("b", 20, 5.0), ("b", 30, INF), ("b", 40, 4.0)]


def log(spark, rows=ROWS):
    return spark.createDataFrame([(r, s, l, T0 + dt.timedelta(seconds=s * 1.5)) for r, s, l in rows],
                                 "run STRING, step BIGINT, loss DOUBLE, ts TIMESTAMP")


@pytest.mark.parametrize("init", [INF, 3.5])
def test_running_best_equals_loop(spark, init):
    got = {(r.run, r.step): (r.is_best, r.best_so_far) for r in logs.running_best(log(spark), init).collect()}
    for run in ("a", "b"):
        best = init
        for r, s, l in [x for x in ROWS if x[0] == run]:
            is_best = l < best
            if is_best:
                best = l
            assert got[(r, s)] == (is_best, best)


def test_running_avg_and_timing(spark):
    avg = {(r.run, r.step): r.running_avg for r in logs.running_avg_loss(log(spark, [x for x in ROWS if x[2] == x[2]])).collect()}
    fin = [x for x in ROWS if x[2] == x[2]]
    for run in ("a", "b"):
        xs = [x for x in fin if x[0] == run]
        for i, (r, s, l) in enumerate(xs):
            assert avg[(r, s)] == pytest.approx(sum(x[2] for x in xs[:i + 1]) / (i + 1))
    t = {(r.run, r.step): (r.elapsed_s, r.dt_s, r.pct_done) for r in logs.step_timing(log(spark)).collect()}
    assert t[("b", 10)] == (0.0, None, 25.0)
    assert t[("b", 30)] == (30.0, 15.0, 75.0)


def test_summaries(spark):
    s = {r.run: r for r in logs.best_summary(log(spark)).collect()}
    assert (s["a"].final_step, s["a"].final_loss, s["a"].best_loss) == (5, 1.0, 1.0)
    assert s["b"].total_seconds == 45.0
    e = {(r.run, r.eval_step): (r.mean_loss, r.n_batches) for r in logs.eval_loss(log(spark), 20).collect()}
    assert e[("b", 20)] == (INF, 2)
    assert sorted(r.step for r in logs.periodic_rows(log(spark), 2).collect()) == [0, 2, 4, 10, 20, 30, 40]


def test_checkpoint_pick(spark):
    c = spark.createDataFrame([("r1", "model_best.pt", 0, False), ("r1", "checkpoint.pt", 1, True),
                               ("r1", "model.pt", 2, True), ("r2", "model.pt", 2, False)],
                              "run STRING, file STRING, priority INT, usable BOOLEAN")
    got = {r.run: r.file for r in logs.checkpoint_pick(c).collect()}
    assert got == {"r1": "checkpoint.pt", "r2": None}


def brute_sample(cands, T, seed):
    out = {}
    for g in sorted({c[0] for c in cands}):
        items = sorted((i, s) for gg, i, s in cands if gg == g)
        z = np.array([s / T for _, s in items])
        p = np.exp(z - z.max())
        p = p / p.sum()
        u = int(hashlib.md5(f"{seed}:{g}".encode()).hexdigest()[:15], 16) / 2 ** 60
        cdf = np.cumsum(p)
        k = int(np.argmax(cdf > u)) if (cdf > u).any() else len(items) - 1
        out[g] = (items[k][0], p[k], len(items))
    return out


def test_softmax_sample_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    cands = [(g, int(i), float(rng.normal())) for g in range(30) for i in rng.choice(1000, 7, replace=False)]
    cands += [(100, 5, 1.0), (101, 1, 2.0), (101, 2, 2.0), (101, 3, 2.0), (102, 1, 1e6), (102, 2, 0.0)]
    df = spark.createDataFrame(cands, "grp BIGINT, item BIGINT, score DOUBLE")
    got = {r.grp: (r.item, r.prob, r.n_items) for r in sampling.softmax_sample(df, 0.8, 11).collect()}
    want = brute_sample(cands, 0.8, 11)
    assert got.keys() == want.keys()
    for g in want:
        assert got[g][0] == want[g][0] and got[g][2] == want[g][2]
        assert got[g][1] == pytest.approx(want[g][1])
    assert got[102][0] == 1 and math.isclose(got[102][1], 1.0)


def test_running_best_random_logs(spark):
    import random
    rnd = random.Random(3)
    vals = [NAN, INF, -INF, 1.0, 2.0, 2.0, 3.5, 0.5]
    rows = [(run, s, rnd.choice(vals)) for run in ("x", "y", "z") for s in rnd.sample(range(500), 40)]
    for init in (INF, 2.0):
        got = {(r.run, r.step): (r.is_best, r.best_so_far)
               for r in logs.running_best(log(spark, rows), init).collect()}
        for run in ("x", "y", "z"):
            best = init
            for _, s, l in sorted((x for x in rows if x[0] == run), key=lambda x: x[1]):
                is_best = l < best
                if is_best:
                    best = l
                assert got[(run, s)] == (is_best, best)


def test_rows_without_a_run_are_a_run(spark):
    import datetime
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(run, s, float(10 - s if s % 2 else 10 + s), t0 + datetime.timedelta(seconds=s)) for run in ("a", None) for s in range(6)]
    log = spark.createDataFrame(rows, "run STRING, step BIGINT, loss DOUBLE, ts TIMESTAMP")
    for op, col in ((logs.running_best, "is_best"), (logs.running_avg_loss, "running_avg"), (logs.step_timing, "elapsed_s")):
        got = {(r.run, r.step): r[col] for r in op(log).collect()}
        assert len(got) == len(rows)
        assert all(got["a", s] == got[None, s] for s in range(6))
    picks = spark.createDataFrame([(None, "f0", 0, False), (None, "f1", 1, True), ("a", "f0", 0, False)],
                                  "run STRING, file STRING, priority INT, usable BOOLEAN")
    assert {(r.run, r.file) for r in logs.checkpoint_pick(picks).collect()} == {(None, "f1"), ("a", None)}


def test_softmax_of_odd_scores(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(None, 1, 1.0), (None, 2, nan), (1, 1, inf), (1, 2, 5.0), (1, 3, inf), (2, 1, nan), (2, 2, None),
            (3, 1, -inf), (3, 2, 0.0), (4, 1, -inf), (4, 2, -inf)]
    c = spark.createDataFrame(rows, "grp BIGINT, item BIGINT, score DOUBLE")
    seen = {}
    for seed in range(4):
        for r in sampling.softmax_sample(c, 0.8, seed).collect():
            seen.setdefault(r.grp, set()).add((r.item, r.prob))
    assert seen[None] == {(1, 1.0)} and seen[3] == {(2, 1.0)}
    assert seen[1] <= {(1, 0.5), (3, 0.5)} and seen[2] <= {(1, 0.5), (2, 0.5)} and seen[4] <= {(1, 0.5), (2, 0.5)}


def test_eval_losses_by_split(spark):
    nan = float("nan")
    rows = [("a", 0, "train", 3.0), ("a", 0, "train", 1.0), ("a", 0, "val", 4.0), ("a", 200, "val", 4.0),
            ("a", 400, "train", 1.0), ("a", 600, "val", nan), ("a", 800, "val", 3.0), (None, 0, "val", 9.0)]
    log = spark.createDataFrame(rows, "run STRING, step BIGINT, split STRING, loss DOUBLE")
    got = {(r.run, r.step): (r.train_loss, str(r.val_loss), r.train_batches, r.val_batches, r.is_best)
           for r in logs.eval_losses(log).collect()}
    assert got == {("a", 0): (2.0, "4.0", 2, 1, True), ("a", 200): (None, "4.0", 0, 1, False),
                   ("a", 400): (1.0, "None", 1, 0, False), ("a", 600): (None, "nan", 0, 1, False),
                   ("a", 800): (None, "3.0", 0, 1, True), (None, 0): (None, "9.0", 0, 1, True)}


def test_step_timing_shows_the_time(spark):
    import datetime as dt
    log = spark.createDataFrame([("a", 1, 1.0, dt.datetime(2024, 2, 3, 4, 5, 6, 700000))],
                                "run STRING, step BIGINT, loss DOUBLE, ts TIMESTAMP_NTZ")
    assert logs.step_timing(log).first()["at"] == "2024-02-03 04:05:06"
