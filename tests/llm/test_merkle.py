import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle as M

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(level):
    return [H(*level[i:i + 3]) for i in range(0, len(level), 3)]


def way(level, k):
    """(siblings to the left, to the right) of every level, and the top."""
    path = []
    while len(level) > 1:
        run = level[k - k % 3:k - k % 3 + 3]
        path.append(("".join(run[:k % 3]), "".join(run[k % 3 + 1:])))
        level, k = up(level), k // 3
    return path, level[0]


def brute(rows):
    """[(doc_id, leaf, pos, path, subroot, root)] of (doc_id, text, lang, source, n_chars) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf((r[0], r[3], r[2], r[4], r[1])), r[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: [x[2] for x in sorted(groups[s], key=lambda x: x[:3])] for s in order}
    tops = [way(leaves[s], 0)[1] for s in order]
    out = []
    for g, s in enumerate(order):
        over, root = way(tops, g)
        for k, x in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path, top = way(leaves[s], k)
            out.append((x[3], x[2], k, path + over, top, root))
    return out


def result(df):
    return [(r["doc_id"], r["proof"]["leaf"], r["proof"]["pos"], [(x["left"], x["right"]) for x in r["proof"]["path"]],
             r["proof"]["subroot"], r["proof"]["root"]) for r in df.collect()]


def key(x):
    return (x[4], x[2])


def rows(sizes):
    out, k = [], 0
    for s, n in sizes.items():
        for i in range(n):
            out.append((k * 7 % 1009, None if i % 5 == 0 else f"text ä {i}\nline" * (i % 3), "en" if i % 2 else None, s, i))
            k += 1
    return out


@pytest.mark.parametrize("deep", [1, 2, 7])
def test_equals_brute_force(spark, make, deep, monkeypatch):
    """Group sizes around the powers of three, over one and several window passes."""
    monkeypatch.setattr(M, "DEEP", deep)
    data = rows({None: 1, "": 2, "a": 3, "b": 4, "ä": 9, "z": 10, "B": 28, "hot": 83})
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = M.prove(docs, carry=["doc_id"])
    assert sorted(result(got), key=key) == sorted(brute(data), key=key)
    assert got.where(M.fold(F.col("proof.leaf"), F.col("proof.path")) != F.col("proof.root")).count() == 0


def test_nulls_ties_repeats_and_long_text(spark):
    data = [(None, "x", None, "s", None), (None, "y", None, "s", None), (5, "same", "en", "s", 4), (5, "same", "en", "s", 4), (5, "other", "en", "s", 5),
            (6, "w " * 500_000, "en", "s", None), (7, "", "", "", 0), (None, None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(result(M.prove(docs)), key=key) == sorted(brute(data), key=key)


def test_one_leaf_is_the_root(spark):
    docs = spark.createDataFrame([(1, "t", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    p = M.prove(docs).first()["proof"]
    assert p["leaf"] == p["subroot"] == p["root"] and p["path"] == []


def test_empty_and_clashing_columns(spark, make):
    names = ["proof", "carry", "g", "o", "h", "row", "at", "part", "s", "pos", "n", "block", "up", "path", "subroot", "rest", "first", "before", "p2", "near1"]
    docs = make([(1, "a"), (2, "b")]).selectExpr("*", *[f"'{c}' AS `{c}`" for c in names])
    out = M.prove(docs)
    assert out.columns == [*docs.columns, "_proof"]
    assert all(r[c] == c for r in out.collect() for c in names)
    assert M.prove(docs.limit(0)).collect() == []


def test_query_folds_tampered_texts(spark, sf_dir, documents):
    from ledgerline.llm.queries import op11_merkle_manifest
    want = {r[0]: r for r in brute([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in documents.collect()])}
    text = {r["doc_id"]: r for r in documents.collect()}
    n_bad = 0
    for r in op11_merkle_manifest(spark, sf_dir).collect():
        _, own, _, path, top, root = want[r["doc_id"]]
        d = text[r["doc_id"]]
        cut = d["text"].replace("\n", "") if zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0 else d["text"]
        h = leaf((d["doc_id"], d["source"], d["lang"], d["n_chars"], cut))
        for a, b in path:
            h = H(a, h, b)
        assert (r["leaf"], r["subroot"], r["root"], r["folded_root"]) == (own, top, root, h)
        assert r["proof_sha256"] == H(*[x for p in path for x in p]) and r["verified"] == (h == root) == (cut == d["text"])
        n_bad += not r["verified"]
    assert n_bad > 0
