"""E4/E5 building blocks against brute force."""

import random

from tokenweave.operators import evaluate


def test_asof_cumulative_matches_brute_force(spark):
    rng = random.Random(3)
    E = 6
    counts = {}
    for key in ("a", "b", "c"):
        for eb in rng.sample(range(E + 1), rng.randint(0, 4)):
            counts[(key, eb)] = rng.randint(1, 9)
    cdf = spark.createDataFrame([(k, eb, c) for (k, eb), c in counts.items()] or [("z", 0, 0)],
                                "k string, eb bigint, c bigint")
    pts = spark.createDataFrame([(k, ei) for k in ("a", "b", "c", "d") for ei in range(E + 1)],
                                "k string, ei bigint")
    got = {(r.k, r.ei): r.v for r in evaluate.asof_cumulative(cdf, pts, ["k"], "v").collect()}
    for k in ("a", "b", "c", "d"):
        for ei in range(E + 1):
            want = sum(c for (kk, eb), c in counts.items() if kk == k and eb < ei)
            assert got[(k, ei)] == want, (k, ei)


def test_online_loss_first_step_is_uniform(spark):
    import math

    pc = spark.createDataFrame([(0, 1, 2, 3), (1, 1, 2, 1), (1, 2, 1, 1)],
                               "step bigint, x bigint, y bigint, cnt bigint")
    loss = {r.step: r.loss for r in evaluate.online_step_loss(pc, 10).collect()}
    # nothing seen before step 0: p = 0.5 * 1 / V for every pair
    assert abs(loss[0] - math.log(20)) < 1e-12
    # before step 1: c(1,2)=3, c(1)=3, c(y=2)=3, N=3
    p12 = 0.5 * 1.0 + 0.5 * 4 / 13
    p21 = 0.5 * 0.0 + 0.5 * 1 / 13
    assert abs(loss[1] - (-(math.log(p12) + math.log(p21)) / 2)) < 1e-12
