import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import packing as K

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def histogram(lengths, limit):
    return np.bincount(lengths, minlength=limit + 1)


def best_fit(lengths, limit):
    """Sequences that plain best-fit decreasing takes."""
    free = []
    for v in sorted(lengths, reverse=True):
        fits = [r for r in free if r >= v]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - v)
        else:
            free.append(limit - v)
    return len(free)


def test_plan_uses_every_piece_once_and_packs_well():
    rng = np.random.default_rng(5)
    for limit, draw in ((16, lambda n: rng.integers(1, 17, n)), (64, lambda n: rng.integers(1, 65, n)), (64, lambda n: rng.integers(30, 50, n)),
                        (100, lambda n: rng.integers(1, 8, n)), (64, lambda n: np.full(n, 22)), (1, lambda n: np.ones(n, int))):
        for n in (0, 1, 7, 500):
            lengths = draw(n)
            plan = K.plan(histogram(lengths, limit), limit)
            used = [v for u, k in plan for v in u * k]
            assert sorted(used) == sorted(lengths.tolist()) and all(sum(u) <= limit for u, _ in plan)
            assert sum(k for _, k in plan) <= 1.03 * best_fit(lengths.tolist(), limit) + 1


def test_fit_is_a_least_squares_solution():
    """A histogram made of whole patterns is fitted without a rest, and all of it becomes full sequences."""
    rng = np.random.default_rng(2)
    rows = K.patterns(np.ones(41, int), 40)
    assert len(rows) == len(set(map(tuple, np.sort(rows, axis=1)))) and (rows.sum(axis=1) == 40).all()
    some = rows[rng.choice(len(rows), 12, replace=False)]
    have = np.zeros(41, int)
    for r, n in zip(some, rng.integers(50, 400, 12)):
        for v in r[r > 0]:
            have[v] += n
    x = K.fit(have, K.patterns(have, 40))
    made = np.zeros(41)
    for r, n in zip(K.patterns(have, 40), x):
        for v in r[r > 0]:
            made[v] += n
    assert (x >= 0).all() and np.abs(made - have).max() < 0.05 * have.max()
    tokens = int((have * np.arange(41)).sum())
    assert sum(k for _, k in K.plan(have, 40)) <= tokens / 40 * 1.01 + 1


def check_places(rows, limit):
    """Gapless from 0, no sequence above the limit; returns the number of sequences."""
    sequences = defaultdict(list)
    for length, p in rows:
        sequences[p["sequence_id"]].append((p["offset"], length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences)


@pytest.mark.parametrize("limit", [32, 3001])
def test_pack_places_gapless(spark, limit):
    """Any partitioning; above ``UNITS`` tokens lengths are planned in larger units, and offsets are exact all the same."""
    rng = np.random.default_rng(8)
    data = [(i, int(v)) for i, v in enumerate(rng.integers(1, limit + 1, 700))] + [(9000 + i, 11) for i in range(400)] + [(8000, limit)]
    odd = [(-1, None), (-2, 0), (-3, -4), (-4, limit + 1)]
    out = K.pack(spark.createDataFrame(data + odd, "id long, length long").repartition(7), limit=limit).collect()
    assert sorted(r["id"] for r in out) == sorted(i for i, _ in data + odd)
    assert all((r["packed"]["sequence_id"] is None) == (r["packed"]["offset"] is None) == (r["id"] < 0) for r in out)
    n = check_places([(r["length"], r["packed"]) for r in out if r["id"] >= 0], limit)
    assert n <= 1.03 * best_fit([v for _, v in data], limit) + 2


def test_encoder_equals_the_tokenizer():
    """Random texts over several alphabets, special strings, odd white space, long and repetitive texts."""
    rng = np.random.default_rng(1)
    exact, encode = Tokenizer.from_file(PATH), K.encoder(open(PATH, encoding="utf-8").read())
    alphabets = ["abcdefghij lmnop'st", "aab", "".join(map(chr, range(1, 256))), "äöüß 中文字 ​　\x85\x1c﻿\U0001f600é\n\t", "0123456789.,-$ "]
    texts = ["".join(rng.choice(list(a), int(n))) for a in alphabets for n in rng.integers(1, 80, 1500)]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "x" * 30000, " " * 30000, "ab\n" * 60000]
    for t in texts:
        assert encode(t) == exact.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_are_used_as_they_are():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    exact, encode = Tokenizer.from_file(path), K.encoder(open(path, encoding="utf-8").read())
    for t in ("Some Words here", " ", "ÄÖ <|endoftext|> x"):
        assert encode(t) == exact.encode(t, add_special_tokens=False).ids


def test_pieces_join_to_the_tokens(spark, make):
    texts = {1: "word " * 5000, 2: "", 3: None, 4: "a<|endoftext|>b", 5: "x", 6: "y" * 250_000, None: "null id", 7: "word " * 63}
    docs = make([(k, v) for k, v in texts.items()] + [(5, "x")])
    exact = Tokenizer.from_file(PATH)
    got = defaultdict(list)
    for r in K.token_pieces(docs, PATH, limit=64).collect():
        got[r["doc_id"]].append(r["tokens"])
    for k, t in texts.items():
        want = exact.encode(t or "", add_special_tokens=False).ids + [K.END]
        mine = sorted((p["piece"], p["start"], p["length"], bytes(p["ids"])) for p in got[k][:: 2 if k == 5 else 1])
        assert [p for p, *_ in mine] == list(range(-(-len(want) // 64)))
        assert all(n == 64 for _, _, n, _ in mine[1:]) and [s for _, s, _, _ in mine] == [sum(x[2] for x in mine[:i]) for i in range(len(mine))]
        assert np.frombuffer(b"".join(b for *_, b in mine), "<u4").tolist() == want
    assert len(got[5]) == 2


def test_query(spark, sf_dir, documents):
    from ledgerline.llm.queries import op12_pattern_packing
    exact, rows = Tokenizer.from_file(PATH), op12_pattern_packing(spark, sf_dir).collect()
    ids = {r["doc_id"]: exact.encode(r["text"] or "", add_special_tokens=False).ids + [K.END] for r in documents.collect()}
    mine = defaultdict(int)
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and r["length"] == len(part)
        mine[r["doc_id"]] += r["length"]
    assert mine == {k: len(v) for k, v in ids.items()}
    n = check_places([(r["length"], r) for r in rows], 1024)
    assert n <= -(-sum(map(len, ids.values())) // 1024) * 1.01 + 3


def test_empty_and_clashing_columns(spark, make):
    names = ["carry", "tokens", "packed", "size", "rank", "part", "before", "seq", "off", "n", "t"]
    docs = make([(1, "a"), (2, None)]).selectExpr("*", *[f"'{c}' AS `{c}`" for c in names])
    pieces = K.token_pieces(docs, PATH)
    assert pieces.columns == [*docs.columns, "_tokens"]
    out = K.pack(pieces.withColumn("length", F.col("_tokens.length")))
    assert out.columns[-1] == "_packed" and all(r[c] == c for r in out.collect() for c in names)
    assert K.pack(K.token_pieces(docs.limit(0), PATH).withColumn("length", F.lit(1))).collect() == []
