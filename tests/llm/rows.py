"""Small tables for the text operators."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use inside.
CLASHES = {
    "fingerprint": "f", "component_id": 7, "score": 0.5, "findings": "x", "rate": 1, "copy": 2,
    "shuffle_key": 3, "part": 4, "sig": 5, "h": 6, "key": "k", "fp": 8, "held_out": True,
    "count": 9, "_lang": "z", "seq": "s", "quality": 1, "root": 1, "node": 2,
}


def docs(spark, rows, clashes=False):
    """`rows` of (doc_id, text) or (doc_id, text, lang, source) as a documents table."""
    full = [
        (r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "a")), None if r[1] is None else len(r[1]))
        for r in rows
    ]
    df = spark.createDataFrame(full, DOCS)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit(value) for name, value in CLASHES.items()})
    return df
