import random
from itertools import product

import brute
import numpy as np

from ledgerline.llm import mixing


def test_budget_is_fitted_as_well_as_brute_force():
    rnd = random.Random(4)
    for _ in range(200):
        sizes = np.array(rnd.sample(range(1, 30), 4))
        counts = np.array([rnd.randint(1, 3) for _ in sizes])
        budget = rnd.randint(0, int((sizes * counts).sum()))
        take = mixing.fit_budget(sizes, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        start = (counts * (budget / (sizes * counts).sum())).astype(int)  # the proportional share is taken first
        sums = (int((np.array(t) * sizes).sum()) for t in product(*[range(a, c + 1) for a, c in zip(start, counts, strict=True)]))
        assert abs(int((take * sizes).sum()) - budget) == min(abs(x - budget) for x in sums)


def test_documents_longer_than_the_reserve():
    fit = lambda sizes, counts, budget: int((mixing.fit_budget(np.array(sizes), np.array(counts), budget) * sizes).sum())
    assert fit([100_000], [1], 75_000) == 100_000 and fit([100_000], [1], 45_000) == 0
    assert fit([100_000], [3], 260_000) == 300_000
    assert fit([100_000, 70_000, 55_000], [1, 1, 1], 125_000) == 125_000
    rnd = random.Random(5)
    for _ in range(40):
        sizes = np.array(rnd.sample(range(mixing.RESERVE + 1, 15 * mixing.RESERVE), 4))
        counts = np.array([rnd.randint(1, 2) for _ in sizes])
        budget = rnd.randint(0, int((sizes * counts).sum()))
        start = (counts * (budget / (sizes * counts).sum())).astype(int)
        sums = (int((np.array(t) * sizes).sum()) for t in product(*[range(a, c + 1) for a, c in zip(start, counts, strict=True)]))
        assert abs(fit(sizes, counts, budget) - budget) == min(abs(x - budget) for x in sums)


def taken(docs, **options):
    r = mixing.mix(docs, carry=["doc_id", "source"], **options).select("doc_id", "source", "mix.*").collect()
    out = {}
    for x in r:
        s = out.setdefault(x["source"], {"size": 0, "target": x["target"], "taken": 0, "given": x["source_size"]})
        s["size"] += x["size"]
        s["taken"] += x["size"] * x["copies"]
        assert 0 <= x["copies"] <= 3
    return r, out


def test_targets_and_sums(make, documents):
    more = make([(1, None, "en", None), (2, "a b c", "en", None), (3, "", "en", "tiny"), (4, "only", "en", "tiny"), (4, "only", "en", "tiny")])
    docs = documents.unionByName(more)
    r, got = taken(docs)
    sizes = {}
    for x in docs.collect():
        sizes[x["source"]] = sizes.get(x["source"], 0) + len(brute.WORD.findall(x["text"] or ""))
    want = brute.targets(sizes)
    assert len(r) == docs.count() and {s: v["given"] for s, v in got.items()} == sizes
    for s, v in got.items():
        assert abs(v["target"] - want[s]) < 1e-6 * max(1, want[s])
        passes = v["target"] // v["size"] if v["size"] else 0
        sums = {0}
        for x in r:
            if x["source"] == s:
                sums |= {y + x["size"] for y in sums}
        best = min(abs(passes * v["size"] + y - v["target"]) for y in sums)
        assert abs(v["taken"] - v["target"]) <= max(best + 1, 0.01 * v["target"])  # the proportional share is fixed before the fit
    again, _ = taken(docs.repartition(7))
    assert sorted(r, key=str) == sorted(again, key=str)


def test_one_hot_length_splits_over_buckets(make):
    docs = make([(i, "a b c", "en", "s0") for i in range(3000)] + [(i, "d e", "en", "s1") for i in range(3000, 3100)])
    old = mixing.BUCKET_ROWS, mixing.BROADCAST_ROWS
    try:
        mixing.BUCKET_ROWS, mixing.BROADCAST_ROWS = 100, 0
        r, got = taken(docs, weights=(1, 1))
    finally:
        mixing.BUCKET_ROWS, mixing.BROADCAST_ROWS = old
    assert got["s1"]["taken"] == 600 and abs(got["s0"]["taken"] - got["s0"]["target"]) < 3
    assert sorted(r, key=str) == sorted(taken(docs, weights=(1, 1))[0], key=str)


def test_empty_extra_and_mixed(make):
    none = make([]).selectExpr("*", "1 AS size", "2 AS mix", "3 AS `__h`", "4 AS pick")
    assert mixing.mixed(none).count() == 0 and mixing.mixed(none).columns == none.columns
    some = make([(1, "a b"), (2, "c"), (2, "c")]).selectExpr("*", "1 AS size", "2 AS mix", "3 AS `__h`", "4 AS pick")
    assert sorted(r["doc_id"] for r in mixing.mixed(some).collect()) == [1, 2, 2]
