import random
from collections import Counter, defaultdict

import pytest

from tracelake.llm import packing as P


def one_by_one(sizes, capacity):
    """Best-fit decreasing, a document at a time."""
    free = []
    for s in sorted((x for x in sizes if x), reverse=True):
        fits = [k for k, f in enumerate(free) if f >= s]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= s
        else:
            free.append(capacity - s)
    return sorted(free)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_best_fit_one_by_one(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 30, 100, 257])
    sizes = [r.randint(1, max(1, capacity // r.choice([1, 2, 5]))) for _ in range(r.randint(0, 400))]
    steps, n = P.best_fit(Counter(sizes), capacity)
    used = defaultdict(int)
    for size, count in Counter(sizes).items():
        own = sorted(x for x in steps if x[0] == size)
        for rank in range(count):
            _, begin, first, per = [x for x in own if x[1] <= rank][-1]
            used[first + (rank - begin) // per] += size
    assert set(used) == set(range(n))
    assert sorted(capacity - u for u in used.values()) == one_by_one(sizes, capacity)


@pytest.mark.parametrize("bucket", [200_000, 7])
def test_packed_tables(spark, monkeypatch, bucket):
    monkeypatch.setattr(P, "_BUCKET", bucket)
    r = random.Random(4)
    rows = [(k, " ".join(r.choice(["alpha", "beta", "zeta", "中文"]) for _ in range(r.randint(0, 60)))) for k in range(80)] + [(100, None), (101, ""), (102, "word " * 500), (103, "word " * 64), (None, "x")]
    df = spark.createDataFrame(rows + rows[:9], "doc_id long, text string").selectExpr("*", "1 as capacity", "2 as rank", "3 as container_id")
    sizes = {x.key: x.n_tokens for x in P.token_sizes(df).collect()}
    assert sizes[101] == 0 and 100 not in sizes
    out = P.packed(df, [64, 200]).collect()
    for capacity in (64, 200):
        pieces, used = defaultdict(list), Counter()
        for x in out:
            if x.capacity_tokens == capacity:
                pieces[x.doc_id].append((x.piece_no, x.start_token, x.n_tokens))
                used[x.container_id] += x.n_tokens
        assert max(used.values()) <= capacity
        assert set(pieces) == set(sizes)
        for k, n in sizes.items():
            got = sorted(pieces[k])
            assert [p for p, _, _ in got] == list(range(len(got)))
            assert sum(x for _, _, x in got) == n
            assert all(s == p * capacity for p, s, _ in got)
            assert len(got) == max(1, -(-n // capacity))
        rests = [n % capacity for n in sizes.values()]
        assert len(used) == len(one_by_one(rests, capacity)) + sum(n // capacity for n in sizes.values())


def test_no_rows_and_bad_capacity(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.packed(df, [64]).count() == 0
    assert P.packed(df, []).count() == 0
    with pytest.raises(ValueError):
        P.packed(df, [0])
