"""Company-facts documents → the long fact frame (S4, S5, P1, F8, F12), by a declared schema or by VARIANT.

One JSON document per company::

    {"cik": 320193, "facts": {"us-gaap": {"Revenues": {"units": {"USD": [entry, ...]}}},
                              "dei": {...}}}

All namespaces, tags and units are exploded in one pass (no per-tag walk);
every entry field is read as STRING so one malformed value cannot void a
document, then typed with ``try_cast``. ``pos`` is the entry's position in
its array, the stable tie-break for "latest" ordering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.cells import py_float, py_float_parsed
from ledgerline.functions.scalars import pad_cik, scale_int, try_int

ENTRY_FIELDS = ["val", "scale", "start", "end", "form", "fy", "fp", "qtrs", "accn", "filed",
                "frame", "segment", "dimensional"]
ENTRY = T.StructType([T.StructField(f, T.StringType(), True) for f in ENTRY_FIELDS])
TAG_OBJ = T.StructType([
    T.StructField("label", T.StringType(), True),
    T.StructField("units", T.MapType(T.StringType(), T.ArrayType(ENTRY)), True),
])
COMPANY_FACTS_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType(), True),
    T.StructField("entityName", T.StringType(), True),
    T.StructField("facts", T.MapType(T.StringType(), T.MapType(T.StringType(), TAG_OBJ)), True),
])

# Texts of a "dimensional" flag that Python reads as false.
FALSY_TEXT = ["", "false", "False", "0", "0.0", "-0.0", "[]", "{}", "null", "None"]


def read_company_facts(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Landed company-facts files (one document per file, or JSON lines)."""
    return (spark.read.schema(COMPANY_FACTS_SCHEMA)
            .option("multiLine", multi_line).option("mode", "PERMISSIVE").json(paths))


def parse_company_facts(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Same as ``read_company_facts`` for documents held in a string column."""
    return docs.select(F.from_json(F.col(text_col), COMPANY_FACTS_SCHEMA).alias("d")).select("d.*")


def document_ciks(docs: DataFrame) -> DataFrame:
    """The companies that have a facts document, with or without any usable fact."""
    return docs.select(pad_cik(F.col("cik")).alias("cik")).where("cik IS NOT NULL").distinct()


def is_nondimensional(segment: Column, dimensional: Column) -> Column:
    """Keep unless ``segment`` is a non-empty object or ``dimensional`` is truthy."""
    seg = F.trim(segment)
    seg_obj = seg.startswith("{") & (F.regexp_replace(seg, r"\s", "") != "{}")
    dim_true = dimensional.isNotNull() & ~F.trim(dimensional).isin(FALSY_TEXT)
    return ~F.coalesce(seg_obj, F.lit(False)) & ~dim_true


def explode_entries(docs: DataFrame) -> DataFrame:
    """One row per (company, namespace, tag, unit, entry) with the raw text fields."""
    ns = docs.select(pad_cik(F.col("cik")).alias("cik"),
                     F.explode("facts").alias("namespace", "tags"))
    tags = ns.select("cik", "namespace", F.explode("tags").alias("tag", "obj"))
    units = tags.select("cik", "namespace", "tag", F.explode("obj.units").alias("unit", "entries"))
    return units.select("cik", "namespace", "tag", "unit",
                        F.posexplode("entries").alias("pos", "e")).select(
        "cik", "namespace", "tag", "unit", F.col("pos").cast("bigint").alias("pos"), "e.*")


def read_fact_texts(spark: SparkSession, paths: str | list[str], whole: bool = False) -> DataFrame:
    """Landed documents as text (column ``value``): one a line, or one a file with ``whole``."""
    return spark.read.option("wholetext", whole).text(paths)


def _members(df: DataFrame, variant: str, key: str, member: str) -> DataFrame:
    """A row for each field (or element) of a VARIANT column; values of another shape have none."""
    j = df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(variant).outer()))
    own = {"key": key} if key != "pos" else {"pos": "pos"}
    return j.select(*[c for c in df.columns if c != variant], *[F.col(a).alias(b) for a, b in own.items()], F.col("value").alias(member))


def variant_entries(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """S4, S5 without a declared document schema: the rows of ``explode_entries`` from documents held as text.

    The document is parsed to VARIANT and unfolded level by level, so that
    any namespace, tag, unit and entry field is found where it stands, and an
    odd part (units that are a text, an entry that is a number) drops out alone;
    with a declared schema it voids what surrounds it. Text that is no JSON, and
    documents without a cik or facts, have no rows. Only the namespaces, tags
    and units on the way and the entry's own fields leave the parse.
    """
    d = docs.select(F.try_parse_json(F.col(text_col)).alias("doc"))
    d = d.select(pad_cik(F.try_variant_get("doc", "$.cik", "string")).alias("cik"), F.try_variant_get("doc", "$.facts", "variant").alias("v"))
    d = _members(_members(d.where("cik IS NOT NULL"), "v", "namespace", "v"), "v", "tag", "v")
    d = d.where("namespace IS NOT NULL AND tag IS NOT NULL").withColumn("v", F.try_variant_get("v", "$.units", "variant"))
    d = _members(_members(d, "v", "unit", "v"), "v", "pos", "v").where("unit IS NOT NULL AND v IS NOT NULL")
    return d.select("cik", "namespace", "tag", "unit", F.col("pos").cast("bigint").alias("pos"),
                    *[F.try_variant_get("v", f"$.{f}", "string").alias(f) for f in ENTRY_FIELDS])


def normalise_entries(raw: DataFrame) -> DataFrame:
    """Text value × 10^scale (bad scale → 0); entries whose value does not parse drop out."""
    s = scale_int(F.col("scale"))
    return (raw.where(py_float_parsed(F.col("val")))
            .withColumn("scale_applied", s)
            .withColumn("val", py_float(F.col("val")) * F.pow(F.lit(10.0), s)))


def facts_frame(docs: DataFrame) -> DataFrame:
    """The long fact frame (``schemas.FACT_COLUMNS``) from parsed documents."""
    return entries_frame(explode_entries(docs))


def entries_frame(entries: DataFrame) -> DataFrame:
    """The long fact frame from raw entries (``explode_entries`` or ``variant_entries``)."""
    e = normalise_entries(entries.where(is_nondimensional(F.col("segment"), F.col("dimensional"))))
    return e.select(
        "cik", "namespace", "tag", "unit",
        F.col("end").try_cast("date").alias("end"),
        F.col("form"), try_int(F.col("fy")).alias("fy"), F.col("fp"),
        try_int(F.col("qtrs")).alias("qtrs"), F.col("val"), "scale_applied", "pos",
    )


def last_entries(entries: DataFrame, n: int = 4) -> DataFrame:
    """K9: the last ``n`` entries (by position) per (company, concept, unit).

    ``row_number() <= n`` is planned as a WindowGroupLimit, so each map task
    ships at most ``n`` rows per key however many entries a concept has.
    """
    from pyspark.sql import Window
    w = Window.partitionBy("cik", "tag", "unit").orderBy(F.col("pos").desc())
    return entries.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= n).drop("__rk")


def raw_facts(docs: DataFrame, last_n: int = 4) -> DataFrame:
    """K9 source: the last ``n`` entries per (company, concept, unit), us-gaap only,
    in the ``facts_raw`` shape (insert-ignore on its unique key is left to the caller)."""
    e = last_entries(explode_entries(docs).where(F.col("namespace") == "us-gaap"), last_n)
    return e.select("cik", F.col("tag").alias("concept"), "unit", "end", try_int("fy").alias("fy"), "fp",
                    "form", py_float(F.col("val")).alias("val"),
                    F.coalesce(F.col("dimensional"), F.lit("null")).alias("dims"))
