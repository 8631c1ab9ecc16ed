import re
from collections import Counter

import pytest

WS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WS.findall(text or "")


PROSE = "the river runs past old stone houses while children carry small lanterns along narrow bridges toward evening markets where merchants trade woven cloth dried fruit copper bowls painted tiles and quiet stories told by sailors who crossed grey northern waters before winter storms closed every harbour again until spring returned with longer days softer winds green fields new songs bright sails".split()


def prose(k, n=120):
    """A text of n words, unlike those of other k."""
    return " ".join(PROSE[(i * (k % 7 + 3) + k * 5 + i // 9) % len(PROSE)] + (f"{k}" if i % 4 == 0 else "") for i in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeats, ties, exact and near copies, shared passages."""
    base, passage = prose(1, 200), prose(99, 90)
    rows = [(k, prose(k), "en", f"s{k % 3}") for k in range(12)]
    rows += [(20, base, "en", "s0"), (21, base.replace(" ", "\n"), "en", None), (22, base + "  ", None, "s1"), (23, base + " more", "en", "s1"), (24, base.replace("stone", "brick", 1), "en", "s2")]
    rows += [(30 + k, f"{prose(40 + k, 60)} {passage} {prose(60 + k, 60)}", "en", "s0") for k in range(4)]
    rows += [(50, None, None, None), (51, "", "en", "s0"), (52, " \n\t ", "en", "s0"), (53, "one", "en", "s0"), (54, "One two  three", "en", "s0"), (55, "one TWO three", "en", "s0"), (None, prose(7), "en", "s0"), (None, "lone text", None, None)]
    rows += [(60, prose(3), "en", "s0"), (60, prose(3), "en", "s0"), (61, "ab " * 700, "en", "s0"), (62, "ab " * 900, "en", "s0"), (63, "x" * 5000, "en", "s1"), (64, prose(77, 30000), "en", "s1"), (65, "é ü 日本 😀 naïve café's it's I'm <|endoftext|> 12 34.5!", "fr", "s2")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(1) for c in ("_h", "_doc", "_row", "kept", "start", "n", "ids", "word", "score", "pos", "hist")}).withColumn("a.b", F.lit("x")).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def plain():
    return [(r[0], r[1]) for r in odd_rows()]


def counted(rows):
    return Counter(tuple(r) for r in rows)
