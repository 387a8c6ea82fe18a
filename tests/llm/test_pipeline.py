"""The whole pipeline against brute force, stage by stage."""

from collections import Counter

import brute
import corpus_pipeline as P

from ledgerline.llm import quality
from ledgerline.llm.common import stage_table


def test_stages_match_brute_force(spark, documents, make, sf_dir):
    odd = make([(50001, None), (50002, ""), (50003, documents.first()["text"]), (50003, documents.first()["text"]), (None, "x " * 9000)])
    docs = stage_table(documents.unionByName(odd), "input")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in P.STAGES:
        out = stage_table(stage(spark, docs, sf_dir), name)
        before, after = docs.collect(), out.collect()
        ids = Counter(r["doc_id"] for r in after)
        if name != "hash_ring_shards":
            assert out.columns == docs.columns and set(after) <= set(before)
        if name == "quality_rules":
            verdict = {(r["doc_id"], r["text"]): r["quality"]["kept"] for r in quality.label(docs).collect()}
            for r in before:
                s = brute.quality(r["text"])
                if s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]:
                    assert not verdict[r["doc_id"], r["text"]]
            assert ids == Counter(r["doc_id"] for r in before if verdict[r["doc_id"], r["text"]])
        if name == "simhash_near_dedup":
            comp = brute.components([(brute.fingerprint(r["text"]), r["doc_id"]) for r in before])
            assert ids == Counter(set(comp.values()))
        if name == "benchmark_decontamination":
            bad = {d for d, _ in brute.contained([(r["doc_id"], r["text"]) for r in before], bench)}
            assert bad and ids == Counter(r["doc_id"] for r in before if r["doc_id"] not in bad)
        if name == "mix_sources":
            size = {r["doc_id"]: len(brute.WORD.findall(r["text"])) for r in before}
            given, taken = Counter(), Counter()
            for r in before:
                given[r["source"]] += size[r["doc_id"]]
            for r in after:
                taken[r["source"]] += size[r["doc_id"]]
            want = brute.targets(given)
            shortest = {s: min(size[r["doc_id"]] for r in before if r["source"] == s) for s in given}
            assert max(ids.values()) <= 3
            assert all(abs(taken[s] - want[s]) <= max(2, shortest[s]) for s in given)
        if name == "hash_ring_shards":
            assert ids == Counter(r["doc_id"] for r in before)
            per = Counter(r["shard"] for r in after)
            assert max(per.values()) - min(per[s] for s in range(24)) <= 1
            assert len({(r["shard"], r["slot"]) for r in after}) == len(after)
        docs = out


def test_run(spark, sf_dir):
    assert P.run(spark, sf_dir).count() > 0 and P.ORACLE_SQL is None and len(P.STAGES) == 5
