import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: A table's own columns may have any names, also those that operators use inside.
EXTRA = ["score", "fingerprint", "key", "k", "t", "fp", "size", "piece", "label", "node", "component_id", "wl_row", "digest", "gone",
         "n_replaced", "wl_replaced", "wl_new", "wl_stand_ins", "own", "row", "mix_source", "lang_", "n", "a", "b", "y", "held_out",
         "predicted", "kept", "rejected", "taken", "target", "place", "names", "count", "bucket", "start", "length"]


@pytest.fixture
def documents(spark):
    """A table of documents from (id, text) or (id, text, source), with columns of clashing names if asked for."""
    def build(rows, extra=False):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            from pyspark.sql import functions as F
            for name in EXTRA:
                df = df.withColumn(name, F.lit("x"))
        return df.repartition(3)
    return build
