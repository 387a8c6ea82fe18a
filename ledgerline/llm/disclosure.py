"""Personal data, and the terms that give it away.

Base spans: e-mail addresses, IP addresses, payment cards and phone numbers,
leftmost and non-overlapping within a kind, found in the whole text.

Information-theoretic sanitisation: every protected value has an information
content IC(e) = -log2 p(e). A term that shares documents with it tells
PMI(t; e) = log2 p(t, e) / (p(t) p(e)) bits about it, all probabilities being
shares of the corpus' documents; PMI / IC is the part of the entity's
information that the term gives away, 1 when the term appears nowhere else. In
documents that hold the entity, terms that give away ``GENERALISE`` of it or
more are generalised and those at ``REMOVE`` or more are removed. Besides the
value itself, all values of a person (local part of an address) and of a
domain are an entity each. Low counts are estimated low: half a text more has
the term, and the part is discounted by n/(n + 1) for n shared texts, so a
single text proves nothing and two may. Texts of equal words count once, and
so do edited copies among the texts that share an entity: a text is left out
of all counts if an earlier one has at least ``NEAR`` of their common five-word
shingles. Shingles are compared by the ``SKETCH`` least hashes (all of them, in
a text of so few), pairs are found by eight bands of two hashes each, and each
text meets the first one of its band, so a crowded band makes no pairs. Copies
that are not counted are judged and cleaned like any other.

Native: DataFrame functions only. Scale: base spans need no shuffle. Terms are
counted over the documents once, and only if two different texts share an
entity; documents with such entities are joined, on the row, with their terms
that are rare enough to reach ``GENERALISE``, a row of many entities in parts
of ``PART_ENTITIES``. Counts are partial aggregates. No row is dropped and no
group is collected, but the terms of one document. Texts are shuffled only
where they hold personal data and the other side is too large; a table is
broadcast only if its measured bytes are within ``BROADCAST_BYTES``.

Defined results: null text is empty; texts of any length are read whole; rows
that repeat are judged alike and count as one document; of equal or near texts
the first row counts; null ids are kept; an empty table gives an empty result;
extra columns of any name are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, fresh, let, shingles, stage_table, words

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Possessive forms and the run starts keep the patterns linear on any text; they match what the plain ones match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

GENERALISE, REMOVE = 0.5, 0.8
PUNCTUATION = ".,;:!?()[]{}<>\"'`…«»„“”‘’*_|/\\-"
#: Entities of one row that are joined together.
PART_ENTITIES = 64
#: Measured size up to which a table is broadcast; larger ones are shuffled. A row counts ``ROW_BYTES`` and its texts.
BROADCAST_BYTES, ROW_BYTES = 8 << 20, 60
#: Edited copies: words of a shingle, least similarity, hashes kept of a text, bands of two hashes.
SHINGLE_WORDS, NEAR, SKETCH, BANDS = 5, 0.8, 128, 8

#: Matches whose places are summed together.
CHUNK = 64
SPAN = "array<struct<kind:string,s:int,e:int,value:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _luhn(d: Column) -> Column:
    each = F.transform(F.split(F.reverse(d), ""), lambda c, i: let(
        c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(m)).between(16, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def located(text: Column, pattern: Column, kind: str, valid=lambda m: F.lit(True)) -> Column:
    """The ``valid`` matches of ``pattern`` with their places in code points (end exclusive).

    The text between matches and the matches themselves alternate, so places
    are running sums of their lengths. Sums run in chunks, which keeps a text
    of very many matches linear.
    """
    none = F.array().cast(SPAN)

    def walk(pairs: Column, at: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            s = a["at"] + x["gap"]
            e = s + F.length(x["m"])
            span = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), x["m"].alias("value"))
            return F.struct(e.alias("at"), F.when(valid(x["m"]), F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

        return F.aggregate(pairs, F.struct(at.alias("at"), none.alias("out")), step)["out"]

    def run(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["m"])))
        starts = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, n: F.struct(
            (a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(chunks, starts, walk))

    def cut(pairs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int")),
                           lambda i: F.slice(pairs, i * CHUNK + 1, F.lit(CHUNK)))

    def found(m: Column) -> Column:
        pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), m,
                           lambda g, x: F.struct(F.length(g).alias("gap"), x.alias("m")))
        return F.when(F.size(m) == 0, none).otherwise(let(pairs, lambda p: let(cut(p), run)))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), found)


def base_spans(text: Column) -> Column:
    """All base spans by kind as listed, then by start."""
    t = F.coalesce(text, F.lit(""))
    valid = lambda kind: lambda m: _valid(kind, m)
    return F.concat(*[located(t, F.lit(p), k, valid(k)) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True)])


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _term(word: Column) -> Column:
    return F.btrim(F.lower(word), F.lit(PUNCTUATION))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(words(text), _term), lambda w: F.length(w) >= 3))


def _entities(spans: Column) -> Column:
    """The names of the protected values: each value, and the person and the domain of an address."""
    def names(x: Column) -> Column:
        value = F.lower(x["value"])
        name = lambda kind, v: F.concat_ws(":", F.lit(kind) if isinstance(kind, str) else kind, v)
        return F.when(x["kind"] == "email", F.array(name("email", value), name("person", F.substring_index(value, "@", 1)),
                                                    name("domain", F.substring_index(value, "@", -1)))).otherwise(
            F.array(name(x["kind"], F.when(x["kind"].isin("card", "phone"), _digits(value)).otherwise(value))))

    return F.array_distinct(F.flatten(F.transform(spans, names)))


def _bounded(df: DataFrame, *texts: Column) -> DataFrame:
    """``df``, a written table, to be broadcast if it is small by its measured bytes, else shuffled."""
    size = df.agg(F.sum(sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(ROW_BYTES)).cast("long"))).first()[0]
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df.hint("merge")


def _sketch(text: Column) -> Column:
    """The ``SKETCH`` least hashes of the text's shingles, ascending."""
    h = let(words(F.lower(text)), lambda w: shingles(w, SHINGLE_WORDS, lambda x: F.xxhash64(x)))
    return F.slice(F.sort_array(F.array_distinct(h)), 1, SKETCH)


def _bands(sketch: Column) -> Column:
    """Each band is the least hashes of two of the ``2 * BANDS`` classes that hashes fall in."""
    least = F.transform(F.sequence(F.lit(0), F.lit(2 * BANDS - 1)), lambda b: F.array_min(F.filter(sketch, lambda x: F.pmod(x, F.lit(2 * BANDS)) == b)))
    return let(least, lambda m: F.array(*[F.xxhash64(F.lit(i), F.coalesce(m[2 * i], F.lit(0)), F.coalesce(m[2 * i + 1], F.lit(0))) for i in range(BANDS)]))


def _similarity(a: Column, b: Column) -> Column:
    """Share of common shingles among the least ``SKETCH`` of both texts; exact where both together have no more."""
    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH),
               lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))


def edited_copies(texts: DataFrame, near: float = NEAR) -> DataFrame:
    """(row): the rows of ``texts`` (row, sketch) that are near an earlier one."""
    keys = texts.select("row", F.explode(F.array_distinct(_bands(F.col("sketch")))).alias("band"))
    firsts = keys.groupBy("band").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    pairs = stage_table(keys.join(firsts, "band").where("row <> first").select("row", "first").distinct(), "near_pairs")
    known = texts.select(F.col("row").alias("first"), F.col("sketch").alias("earlier"))
    both = pairs.join(texts, "row").join(known, "first")
    return both.where(_similarity(F.col("sketch"), F.col("earlier")) >= near).select("row").distinct()


def revealing_terms(d: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame | None:
    """(entity, term, removed, share): terms that give away ``generalise`` of an entity or more; None if no two texts share an entity.

    ``d`` has ``row``, ``t`` and the base ``spans`` of all documents.
    """
    some = F.size("spans") > 0
    own = stage_table(d.select("row", F.md5(F.lower(F.array_join(words(F.col("t")), " "))).alias("text"), _entities(F.col("spans")).alias("names"),
                               F.when(some, _sketch(F.col("t"))).alias("sketch")), "texts")
    again = stage_table(own.groupBy("text").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("text", "first"), "repeated")
    copies = stage_table(own.join(_bounded(again, F.col("text")), "text").where("row <> first").select("row"), "copies")
    total = own.count()
    held = own.where(F.size("names") > 0).join(_bounded(copies), "row", "left_anti")
    name = held.select("row", F.explode("names").alias("entity"))
    common = stage_table(name.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") > 1).select("entity"), "common")
    sharing = name.join(_bounded(common, F.col("entity")), "entity").select("row").distinct()
    near = edited_copies(stage_table(held.select("row", "sketch").join(sharing, "row", "left_semi"), "sketches"))
    copies = stage_table(copies.unionByName(near), "copies")
    small = _bounded(copies)
    n = total - copies.count()
    mine = held.join(small, "row", "left_anti").select("row", F.ceil(F.size("names") / PART_ENTITIES).cast("int").alias("parts"), F.explode("names").alias("entity"))
    n_e = stage_table(mine.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where((F.col("n_e") > 1) & (F.col("n_e") < n)), "entities")
    most = n_e.agg(F.max("n_e")).first()[0]
    if not most:
        return None
    # an entity of n_e texts needs a term of no more than this many
    reach = lambda e: F.pow(F.lit(float(n)), 1 - generalise) * F.pow(e.cast("double"), F.lit(generalise))
    mine = stage_table(mine.join(_bounded(n_e, F.col("entity")), "entity"), "shared")
    rows = stage_table(mine.select("row", "parts").distinct(), "rows")
    # counted for all terms first: common words are in nearly every document, and a join before the count would make a row of each
    n_t = d.join(small, "row", "left_anti").select(F.explode(_terms(F.col("t"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n_t = stage_table(n_t.where((F.col("n_t") > 1) & (F.col("n_t") <= reach(F.lit(most))) & F.col("term").rlike(r"^\p{L}[\p{L}'’-]*$")), "terms")
    here = d.where(some).select("row", "t").join(_bounded(rows), "row").select("row", "parts", F.explode(_terms(F.col("t"))).alias("term"))
    here = here.join(_bounded(n_t, F.col("term")), "term").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    mine = mine.withColumn("part", F.pmod(F.xxhash64("entity"), F.col("parts").cast("long")).cast("int")).drop("parts")
    pairs = mine.join(here.drop("parts"), ["row", "part"]).where(F.col("n_t") + 0.5 <= reach(F.col("n_e")))
    p = pairs.groupBy("entity", "term", "n_e", "n_t").agg(F.count(F.lit(1)).alias("n_te")).where("n_te > 1")
    told = F.log2(F.col("n_te") * F.lit(float(n)) / ((F.col("n_t") + 0.5) * F.col("n_e")))
    whole = F.log2(F.lit(float(n)) / F.col("n_e"))
    p = p.withColumn("share", told / whole * F.col("n_te") / (F.col("n_te") + 1)).where(F.col("share") >= generalise)
    return stage_table(p.select("entity", "term", (F.col("share") >= remove).alias("removed"), "share"), "revealing")


def _quoted(terms: Column) -> Column:
    some = F.array_join(F.transform(terms, lambda x: F.concat(F.lit(r"\Q"), x, F.lit(r"\E"))), "|")
    return F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), some, F.lit(r")(?![\p{L}\p{N}])"))


def find(docs: DataFrame, carry: list[str] | None = None, text_col: str = "text", **thresholds) -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``private``: ``text``, ``base`` spans, ``terms`` spans and ``removed`` terms."""
    carry = docs.columns if carry is None else carry
    row, t, spans, out, mark = fresh(docs, "row", "t", "spans", "private", "mark")
    d = stage_table(docs.select(*[col(c) for c in carry], F.coalesce(col(text_col), F.lit("")).alias(t), base_spans(col(text_col)).alias(spans))
                    .withColumn(row, F.monotonically_increasing_id()), "spans")
    seen = d.select(col(row).alias("row"), col(t).alias("t"), col(spans).alias("spans"))
    told = revealing_terms(seen, **thresholds)
    none = F.array().cast(SPAN)
    name = "private" if "private" not in carry else out
    if told is None:
        return d.select(*[col(c) for c in carry], F.struct(col(t).alias("text"), col(spans).alias("base"), none.alias("terms"),
                                                          F.array().cast("array<string>").alias("removed")).alias(name))
    mine = seen.select("row", F.explode(_entities(F.col("spans"))).alias("entity"))
    hit = mine.join(_bounded(told, F.col("entity"), F.col("term")), "entity").groupBy("row").agg(
        F.collect_set("term").alias("hit"), F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("gone"))
    hit = stage_table(hit.select(F.struct("row", "hit", "gone").alias(mark)), "hit_rows")
    # terms are marked only where an entity is: the other texts need no join
    some, size = F.size(col(spans)) > 0, [F.array_join(col(mark)[x], " " * 16) for x in ("hit", "gone")]
    j = d.where(some).join(_bounded(hit, *size), col(row) == col(mark)["row"], "left").unionByName(
        d.where(~some).withColumn(mark, F.lit(None).cast(hit.schema[mark].dataType)))
    hits = col(mark)["hit"]
    free = lambda x: ~F.exists(col(spans), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    terms = F.when(hits.isNull(), none).otherwise(F.filter(located(col(t), _quoted(hits), TERM), free))
    return j.select(*[col(c) for c in carry], F.struct(col(t).alias("text"), col(spans).alias("base"), terms.alias("terms"),
                                                      F.coalesce(col(mark)["gone"], F.array().cast("array<string>")).alias("removed")).alias(name))


def sanitised(private: Column) -> Column:
    """The text with base spans and terms replaced: ``[EMAIL]`` and so on; generalised terms become
    ``[NAME]`` (capitalised) or ``[TERM]``, removed ones vanish. Of overlapping spans the first stays."""
    marks = F.transform(F.concat(private["base"], private["terms"]), lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"),
        F.when(x["kind"] != TERM, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        .when(F.array_contains(private["removed"], F.lower(x["value"])), F.lit(""))
        .otherwise(F.when(x["value"].rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[TERM]"))).alias("by")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.array_sort(marks), start, lambda a, x: F.when(x["s"] < a["at"], a).otherwise(F.struct(
        x["e"].alias("at"), F.concat(a["out"], F.substring(private["text"], a["at"] + 1, x["s"] - a["at"]), x["by"]).alias("out"))))
    return let(done, lambda a: F.concat(a["out"], F.substring(private["text"], a["at"] + 1, F.length(private["text"]))))
