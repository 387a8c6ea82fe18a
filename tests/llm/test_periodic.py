import random
import zlib
from hashlib import sha256

import numpy as np
from brute import WORD

from ledgerline.llm import periodic as R


def brute(w):
    """All runs by comparing every word at every lag."""
    seen = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= 12:
                seen.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(v for i, v in enumerate(w) if i not in gone)


def triples(found):
    return [(r["start"], r["length"], r["period"]) for r in found]


def test_scan_equals_brute_force():
    rnd = random.Random(11)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            w = [str(rnd.randrange(rnd.choice([1, 2, 3, 20, 100]))) for _ in range(rnd.randint(0, 220))]
            for _ in range(rnd.randint(0, 3)):
                if len(w) > 4:
                    a, p = rnd.randrange(len(w)), 1 + rnd.randrange(len(w) // 2)
                    for i in range(a + p, rnd.randint(a, len(w))):
                        w[i] = w[i - p]
            texts.append(w)
        for w, (found, text) in zip(texts, R._scan(texts)):
            assert triples(found) == brute(w) and text == collapsed(w, brute(w))


def test_splitting_removes_no_run():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        x = rnd.integers(0, 40, 300)
        x[100:160] = np.resize(x[100:117], 60)
        left, at = R.split(x)
        assert set(range(100, 160)) <= set(at[left >= 0].tolist())
        assert all((left[i] < 0) == (left[i] != x[at[i]]) for i in range(len(left)))


def test_very_long_texts_are_not_quadratic():
    w = ["a"] * 120_000
    assert triples(R._scan([w])[0][0]) == [(0, 120_000, 1)]
    two = ["a"] * 40_000 + ["b"] + ["a"] * 40_000
    assert sorted(triples(R._scan([two])[0][0])) == [(0, 40_000, 1), (40_001, 40_000, 1)]
    block = [str(i) for i in range(50_000)]
    assert triples(R._scan([block + block + block[:7]])[0][0]) == [(0, 100_007, 50_000)]


def test_detect_edges(spark, make):
    names = ["carry", "t", "n_words", "runs", "collapsed", "periodic", "z"]
    rep = " ".join(["x y z"] * 4)
    docs = make([(1, None), (2, ""), (3, " \n\t"), (4, rep), (4, rep), (None, rep + " x"), (5, "p q " * 5 + "r"), (6, "v w " * 12)])
    docs = docs.selectExpr("*", *[f"'{c}' AS `{c}`" for c in names])
    out = R.detect(docs)
    assert out.columns == [*docs.columns, "_periodic"]
    rows = out.collect()
    assert all(r[c] == c for r in rows for c in names)
    got = sorted((r["doc_id"] or 0, r["_periodic"]["n_words"], triples(r["_periodic"]["runs"]), r["_periodic"]["collapsed"]) for r in rows)
    assert got == [(0, 13, [(0, 13, 3)], "x y z"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 12, [(0, 12, 3)], "x y z"),
                   (4, 12, [(0, 12, 3)], "x y z"), (5, 11, [], "p q p q p q p q p q r"), (6, 12, [(0, 12, 1)], "v w")]
    assert R.detect(docs.limit(0)).collect() == []


def test_query(spark, sf_dir, documents):
    from ledgerline.llm.queries import op13_periodic_runs
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    with_runs = 0
    for r in op13_periodic_runs(spark, sf_dir).collect():
        w = WORD.findall(text[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute(w) if n < 1500 else triples(R._scan([w])[0][0])
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want and r["n_runs"] == len(found)
        assert r["runs_sha256"] == sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == sha256((collapsed(w, found) if w else "").encode()).hexdigest()
        with_runs += bool(found)
    assert with_runs > 5
