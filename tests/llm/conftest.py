import random

import pytest

#: Columns whose names the operators use inside.
CLASH = ("size", "h", "g", "key", "root", "line", "row_hash", "cls", "n", "pos", "lines", "spans", "text_", "target", "rank", "removed_lines", "total_lines", "short", "wide", "early", "late", "part", "score", "kept")


@pytest.fixture
def docs(spark):
    """Makes a documents table with clashing extra columns from (doc_id, text) or (doc_id, text, source)."""
    from pyspark.sql import functions as F

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df

    return make


@pytest.fixture
def words():
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    return lambda n: [r.choice(vocabulary) for _ in range(n)]
