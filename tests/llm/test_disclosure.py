import hashlib
import math
import random
from collections import Counter

import brute
from pyspark.sql import functions as F

from ledgerline.llm import disclosure as D

PIECES = list("a1.@-+% _é(") + ["12", "255.", "4111 1111 1111 1111", "4111111111111111", "+1 (017) 555-7713", "a@b.c", "😀", "1.2.3.4",
                                "x.y@z-w.com.", " ", "\n"]


def test_base_spans_match_brute_force(spark, documents):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + [None, ""]
    texts += [r["text"] for r in documents.select("text").collect()] + ["1 " * 3000, "a@" + "b." * 3000 + "c", "12 a " * 4000, "1.2.3.4 " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(df.select("i", D.written(D.base_spans(F.col("t")))).collect())
    assert [got[i] for i in range(len(texts))] == [brute.spans(t) for t in texts]


def test_very_long_texts(spark):
    for t in ("1" * 200000, "1 " * 100000, "a." * 100000, "a@" + "b." * 50000 + "c", "+1" + "(" * 100000, "a" * 200000):
        spark.createDataFrame([(t,)], "t string").select(D.written(D.base_spans(F.col("t")))).collect()


SENTENCES = ["yesterday {} wrote about {} to the board", "nobody but {} knows why {} left so early", "the file names {} and also {} among others",
             "as {} said, ask {} for the money", "in spring {} was seen with {} near the harbour"]


def fixture(make):
    """An address that always stands near 'Zanzibaros' and often near 'harbourmaster'; both words are seen near nothing else."""
    rows = [(i, s.format("Zanzibaros", "boss@firm.example.org") + f" number {w}") for i, (s, w) in enumerate(zip(SENTENCES, "abcde"))]
    rows += [(100 + i, f"plain words about nothing, the board and the money number {i}") for i in range(60)]
    return rows


def find(docs):
    d = D.find(docs, carry=["doc_id"]).withColumn("clean", D.sanitised(F.col("private")))
    return {r["doc_id"]: r for r in d.collect()}


def test_terms_that_give_an_entity_away(make):
    rows = fixture(make)
    got = find(make(rows))
    for i, text in rows:
        terms = [x["value"] for x in got[i]["private"]["terms"]]
        assert terms == (["Zanzibaros"] if i < 5 else [])
        if i < 5:
            assert got[i]["clean"] == text.replace("Zanzibaros", "").replace("boss@firm.example.org", "[EMAIL]")
        else:
            assert got[i]["clean"] == text


def test_a_weaker_term_is_generalised(make):
    """Half of the documents with the term don't have the entity."""
    rows = fixture(make) + [(200 + i, f"Zanzibaros again in text {i}") for i in range(5)]
    got = find(make(rows))
    assert got[0]["clean"].startswith("yesterday [NAME] wrote about [EMAIL]")
    assert got[200]["clean"] == "Zanzibaros again in text 0"


def test_copies_prove_nothing(make):
    rows = [(i, "only zumbelgard wrote from boss@firm.example.org today") for i in range(20)] + [(50 + i, f"other text {i}") for i in range(30)]
    assert all(not r["private"]["terms"] for r in find(make(rows)).values())


def test_far_terms_pooled_values_and_low_counts(make):
    """A name in the heading and an address in the footer; two different texts suffice, one text under two spellings doesn't."""
    filler = " plain words" * 60
    page = lambda name, i, value: f"{name} heads page p{i}x{filler} footer {value}"
    rows = [(1, page("Zanzibaros", 1, "boss@firm.example.org")), (2, page("Zanzibaros", 2, "boss@firm.example.org")),
            (3, page("Quirinalda", 3, "ann@a.example.org")), (4, page("Quirinalda", 4, "ann@b.example.net")),
            (5, page("Ultramontus", 5, "joe@joint.example.org")), (6, page("Ultramontus", 6, "sue@joint.example.org")),
            (7, page("Onceonly", 7, "once@one.example.org")), (8, page("ONCEONLY ", 7, "once@one.example.org"))]
    rows += [(100 + i, f"heads page footer number {i}{filler}") for i in range(300)]
    got = find(make(rows))
    terms = {i: [x["value"] for x in got[i]["private"]["terms"]] for i, _ in rows}
    assert [terms[i] for i in range(1, 9)] == [["Zanzibaros"]] * 2 + [["Quirinalda"]] * 2 + [["Ultramontus"]] * 2 + [[], []]
    assert not any(terms[i] for i, _ in rows[8:]) and got[1]["clean"].startswith("[NAME] heads")


def test_edges(make):
    docs = make([(1, None), (2, ""), (None, "x@y.zz"), (2, ""), (4, "call +1 (017) 555-7713 or 4111 1111 1111 1111")]).selectExpr("*", "1 AS t", "2 AS spans", "3 AS `__row`")
    got = find(docs)
    assert got[4]["clean"] == "call [PHONE] or [CARD]" and got[None]["clean"] == "[EMAIL]" and got[1]["clean"] == ""
    assert D.find(docs).count() == 5 and D.find(docs.limit(0)).count() == 0
    r = D.find(docs, carry=["doc_id"]).where("doc_id = 4").select(F.sha2(D.written(F.col("private.base")), 256)).first()[0]
    assert r == hashlib.sha256(brute.spans("call +1 (017) 555-7713 or 4111 1111 1111 1111").encode()).hexdigest()


def brute_shares(texts):
    """{(entity, term): share} by plain counting; a text near an earlier one (five-word shingles, 0.8) counts nowhere."""
    def shingled(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    def names(t):
        out = set()
        for m in brute.spans(t).split(","):
            kind, s, e = m.split(":") if m else ("", 0, 0)
            if kind == "email":
                v = t[int(s):int(e)].lower()
                out |= {f"email:{v}", "person:" + v.split("@")[0], "domain:" + v.split("@")[1]}
        return out

    def terms(t):
        return {w for w in (x.lower().strip(D.PUNCTUATION) for x in t.split()) if len(w) >= 3}

    kept = []
    for i, t in enumerate(texts):
        near = lambda u: len(shingled(t) & shingled(u)) / len(shingled(t) | shingled(u)) >= .8
        if not any(near(u) and names(t) & names(u) for u in texts[:i]):
            kept.append((names(t), terms(t)))
    n, n_e, n_t, n_te = len(kept), Counter(), Counter(), Counter()
    for es, ts in kept:
        n_e.update(es), n_t.update(ts), n_te.update((e, t) for e in es for t in ts)
    out = {}
    for (e, t), k in n_te.items():
        if k > 1 and 1 < n_e[e] < n and t.isalpha():
            share = math.log2(k * n / ((n_t[t] + .5) * n_e[e])) / math.log2(n / n_e[e]) * k / (k + 1)
            if share >= D.GENERALISE:
                out[e, t] = share
    return out


def test_shares_match_brute_force(spark):
    """Random texts about a few addresses, some of them edited copies of earlier ones."""
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("bcdfglmnrst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(400)]
    people = {f"{p}@{d}.example.org": rnd.sample(vocabulary, 3) for p, d in (("ann", "one"), ("bob", "two"), ("cy", "two"), ("dee", "three"))}
    texts = []
    for i in range(160):
        w = rnd.choices(vocabulary, k=60)
        if i % 3 == 0:
            a = rnd.choice(sorted(people))
            w[5], w[20], w[40] = a, rnd.choice(people[a]), rnd.choice(people[a])
        texts.append(" ".join(w))
        if i % 6 == 0:  # two edited copies: a new last word each
            texts += [" ".join([*w[:-1], x]) for x in ("copyfirst", "copysecond")]
    rows = [(i, t) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "row long, t string").withColumn("spans", D.base_spans(F.col("t")))
    got = {(r["entity"], r["term"]): r["share"] for r in D.revealing_terms(d).collect()}
    want = brute_shares(texts)
    assert want and got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_edited_copies_prove_nothing(make):
    """Copies with a word changed reveal no word of theirs; the same words in different texts do."""
    body = " ".join(f"w{i}x" for i in range(80))
    rows = [(i, f"zumbelgard wrote {body} from boss@firm.example.org edit{i}") for i in range(12)]
    rows += [(50 + i, f"other text number {i}") for i in range(40)]
    assert all(not r["private"]["terms"] for r in find(make(rows)).values())
    rows += [(90, "entirely different words of zumbelgard and boss@firm.example.org here")]
    got = find(make(rows))
    assert [x["value"] for x in got[3]["private"]["terms"]] == ["zumbelgard"] == [x["value"] for x in got[90]["private"]["terms"]]


def test_edited_copies_of_a_crowded_band(spark):
    """Texts that share most hashes of a band but little else stay apart; every near one is found."""
    rnd = random.Random(5)
    word = lambda: f"v{rnd.randrange(10 ** 6)}"
    common = " ".join(word() for _ in range(40))
    apart = [common + " " + " ".join(word() for _ in range(200)) for _ in range(60)]
    base = [word() for _ in range(300)]
    near = [" ".join([*base[:k], word(), *base[k + 1:]]) for k in range(0, 300, 10)]
    df = spark.createDataFrame(list(enumerate(apart + near)), "row long, t string").select("row", D._sketch(F.col("t")).alias("sketch"))
    got = {r["row"] for r in D.edited_copies(df).collect()}
    assert got == set(range(61, 90))


def test_large_tables_are_shuffled(make):
    rows, old = fixture(make), D.BROADCAST_BYTES
    want = {i: r["clean"] for i, r in find(make(rows)).items()}
    D.BROADCAST_BYTES = -1
    try:
        assert {i: r["clean"] for i, r in find(make(rows)).items()} == want
    finally:
        D.BROADCAST_BYTES = old
