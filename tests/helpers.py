import json

from pyspark.sql import functions as F


def facts_doc(spark, doc: dict):
    from ledgerline.sources.facts import parse_company_facts
    return parse_company_facts(spark.createDataFrame([(json.dumps(doc),)], "value string"))


def entries(*rows):
    """rows: (end, val, form, fy, fp, qtrs) tuples → entry dicts."""
    out = []
    for r in rows:
        e = {"end": r[0], "val": r[1], "form": r[2], "fy": r[3], "fp": r[4]}
        if len(r) > 5 and r[5] is not None:
            e["qtrs"] = r[5]
        out.append(e)
    return out


def doc(cik, tags: dict, ns="us-gaap", unit="USD", extra_ns=None):
    facts = {ns: {t: {"units": {unit: es}} for t, es in tags.items()}}
    if extra_ns:
        facts.update(extra_ns)
    return {"cik": cik, "facts": facts}


def rows(df, *cols, order=None):
    d = df.select(*cols)
    if order:
        d = d.orderBy(*order)
    return [tuple(r) for r in d.collect()]


def one(df):
    r = df.collect()
    assert len(r) == 1, r
    return r[0]


__all__ = ["facts_doc", "entries", "doc", "rows", "one", "F"]
