import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from covey.llm import mixing


def draws(rows, weights=None, budget=None, seed=mixing.SEED):
    """Copies by id, by inverting the distribution term by term."""
    sizes = Counter(r["source"] for r in rows)
    weigh = {s: 1.0 if weights is None else float(weights.get(s, 0)) for s in sizes}
    goal, out = budget if budget is not None else len(rows), Counter()
    for r in rows:
        mean = goal * weigh[r["source"]] / sum(weigh.values()) / sizes[r["source"]]
        parts = max(1, math.ceil(mean / mixing.PART))
        for part in range(1, parts + 1):
            text = f"{seed}|{'' if r['doc_id'] is None else r['doc_id']}|{part}"
            u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
            p = c = math.exp(-mean / parts)
            k = 0
            while c <= u and k <= mixing.TERMS:
                k += 1
                p *= mean / parts / k
                c += p
            out[r["doc_id"]] += k
    return Counter({k: n for k, n in out.items() if n})


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, copy string")


@pytest.mark.parametrize("weights,budget,limit", [(None, None, mixing.MAX_BROADCAST), ({"a": 3, "b": 1, None: 0.5}, 5000, 0), ({"b": 1}, 40, 10), ({"a": 1}, 40000, 10)])
def test_against_single_draws(spark, weights, budget, limit):
    rows = [(k, "a" if k % 3 else "b", "t", "x") for k in range(300)] + [(k, None, "n", "x") for k in range(300, 310)] + [(999, "c", "t", None)]
    df = frame(spark, rows)
    out = mixing.mix(df, weights, budget, max_broadcast=limit).collect()
    assert Counter(r["doc_id"] for r in out) == draws(df.collect(), weights, budget)
    copies = {}
    for r in out:
        copies.setdefault(r["doc_id"], []).append(r["copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())


def test_rates_are_met(spark):
    df = frame(spark, [(k, "big" if k < 9000 else "small", "t", None) for k in range(10_000)])
    found = Counter(r["source"] for r in mixing.mix(df, {"big": 1, "small": 1}, 20_000).collect())
    assert abs(found["big"] - 10_000) < 5 * np.sqrt(10_000) and abs(found["small"] - 10_000) < 5 * np.sqrt(10_000)


def test_odd_rows(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    df = frame(spark, [(None, None, "x" * 200_000, "y")] * 50)
    assert mixing.mix(df, budget=100).count() in (0, 50, 100, 150, 200, 250)
    assert mixing.mix(df, {"z": 1}).count() == 0
