"""The pipeline's stages in turn, over odd rows, an empty table, and the small table of documents."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm.conftest import prose, words
from tests.llm.test_operators import linked, packed
from wardline.llm import pii, rules
from wardline.llm.common import shared_dir, staged


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def longest_of_equal(docs):
    """Of equal texts the longest, then the smallest id (null first)."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[squeezed(t)].append((-len(t or ""), i is not None, i or 0, i, t))
    return Counter(x[3:] for x in (min(g, key=lambda x: x[:3]) for g in groups.values()))


def smallest_of_near(docs):
    """Of groups of near copies the smallest id; null ids come last, and rows of one null id are told apart by their text."""
    texts = sorted({t or "" for i, t in docs if i is None})
    own = lambda i, t: i if i is not None else (1 << 62) + texts.index(t or "")
    keyed = [(own(i, t), t) for i, t in docs]
    component = {i: c for (i, _), c in linked(keyed, 5, 80).items()}
    return Counter((i, t) for (i, t), (k, _) in zip(docs, keyed, strict=True) if component[k] == k)


def masked(docs, spans):
    """Texts with each span, or run of spans, replaced by its kind."""
    out = Counter()
    for i, t in docs:
        new, done = [], 0
        for a, b, k in sorted((int(a), int(b), pii.KINDS.index(k)) for k, a, b in (x.split(":") for x in spans[i, t].split(",") if x)):
            new += [t[done:a], f"[{pii.KINDS[k].upper()}]"] if a >= done else []
            done = max(done, b)
        out[i, None if t is None else "".join(new) + t[done:]] += 1
    return out


def held(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd", "small"])
def test_each_stage_against_brute_force(spark, odd, sf, which):
    docs = staged(odd if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet"), "input")
    columns = docs.columns
    for name, stage in C.STAGES[:-1]:
        new = staged(stage(spark, docs, sf), name)
        assert new.columns == columns, name
        before, after = held(docs), Counter(held(new))
        if name == "quality_rules":  # scores are held against brute force beside the operator
            scored = rules.score(docs, rules.fit_weights(docs, rules.trusted_ids(spark, sf)))
            good = Counter(r.doc_id for r in scored.where("kept").collect())
            assert Counter(i for i, _ in after.elements()) == good and not after - Counter(before)
            assert all(len(words(t)) >= 50 for _, t in after)
        elif name == "exact_dedup":
            assert after == longest_of_equal(before)
        elif name == "ngram_jaccard":
            assert after == smallest_of_near(before)
        else:
            spans = {(r.doc_id, r.text): r.spans for r in docs.select("doc_id", "text", pii.listed(pii.spans(F.col("text"), spark)["all"]).alias("spans")).collect()}
            assert after == masked(before, spans)
            assert pii.find(new).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
        docs = new
    assert docs.count() > 0
    packed(C.STAGES[-1][1](spark, docs, sf).collect(), held(docs))


def test_stages_drop_what_they_should(spark, sf):
    """One table with a copy, a near copy, junk, and personal data."""
    base = prose(1, 200)
    rows = [(1, base), (2, base + "  "), (3, base + " more"), (4, prose(5, 200) + " mail x.y@example.com"), (5, "a b c " * 40), (6, "short"), (None, prose(6, 200)), (None, prose(6, 200) + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").alias("n_chars"))
    assert not {5, 6} & {r.doc_id for r in C.quality_rules(spark, docs, sf).collect()}  # the ratio knows too few texts to tell the rest
    left = []
    for name, stage in C.STAGES[1:-1]:
        docs = staged(stage(spark, docs.where("doc_id IS NULL OR doc_id < 5"), sf), name)
        left.append(Counter(r.doc_id for r in docs.collect()))
    assert left[0] == Counter({2: 1, 3: 1, 4: 1, None: 2}) and left[1] == left[2] == Counter({2: 1, 4: 1, None: 1})
    assert docs.where("text LIKE '% mail [EMAIL]'").count() == 1


def test_empty_table(spark, none, sf):
    docs = none
    for name, stage in C.STAGES:
        docs = staged(stage(spark, docs, sf), name)
        assert docs.count() == 0


def test_run(spark, sf):
    pieces = C.run(spark, sf).toPandas()
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    kept = documents.join(rules.score(documents, rules.fit_weights(documents, rules.trusted_ids(spark, sf))).where("kept").select("doc_id"), "doc_id", "left_semi")
    assert set(pieces.doc_id) <= {r.doc_id for r in kept.collect()}
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_shared_folder_is_that_of_the_session(spark):
    own = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == own.rstrip("/") if own else shared_dir(spark).startswith("file:")


def test_nothing_outside_imports_the_subpackage():
    from pathlib import Path

    root = Path(C.__file__).parent
    for path in (root / "wardline").rglob("*.py"):
        if "llm" not in path.parts:
            assert "wardline.llm" not in path.read_text(), path
