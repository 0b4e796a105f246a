import random

import pytest
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use for results or on the way
          "k string, h string, ix int, n long, size string, score string, spans string, target string, rep string, shard int, next_text string")


def prose(rng, n, words=("stone", "river", "of", "the", "light", "mountain", "evening", "quiet", "under", "walks", "seven", "green")):
    return " ".join(rng.choice(words) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank, one-letter and very long texts, ties, repeated rows."""
    rng = random.Random(7)
    base, passage = prose(rng, 120), "\n".join(prose(rng, 12) for _ in range(8))
    texts = [base, base, None, "", " \t\n ", "a", "é", "no. 12 #", passage, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30),
             base.replace("river", "RIVER"), " ".join(base.split()[:110] + ["new"] * 3), "x" * 5000, prose(rng, 60_000), "of of " * 400,
             "password = 'Zx81kdQpa77Lm'", passage + "\nend", "\n\n\n"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], None if i % 4 else 7) for i, t in enumerate(texts)]
    rows += [rows[0], rows[9], (None, base, None, None, None), (None, None, None, None, None), (3, "a second row of this id " + passage, "en", "s1", 1)]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    extra = tuple(None if k % 2 else ("x" if k not in (2, 3, 9) else 1) for k in range(11))
    return spark.createDataFrame([r + extra for r in edge_rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where(F.lit(False))


@pytest.fixture(scope="session")
def small(spark):
    """The smallest tables of the driver: (documents, rows of doc_id and text)."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
