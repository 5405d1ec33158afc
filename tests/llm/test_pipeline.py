"""corpus_pipeline on a small corpus: each stage against its operator's brute-force meaning, and the whole."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cinderlog.llm import catalog
from cinderlog.llm.common import materialize


def write(spark, folder):
    rng = random.Random(8)
    words = lambda n: [rng.choice("bcdfg") + rng.choice("aeiou") + rng.choice("lmnr") for _ in range(n)]
    docs, labels = [], []
    base = words(100)
    for i in range(240):
        if i % 4 == 0:
            text = " | ".join(w.upper() for w in words(40))
        elif i % 20 == 1:
            w = list(base)
            w[i % 100] = "changed"
            text = " ".join(w)
        else:
            text = " ".join(words(60)) + "\nA line that all good documents share\n" + " ".join(words(20))
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(i % 4 > 0), 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {d[0]: d[1] for d in docs}


def test_stages_and_run(spark, tmp_path):
    texts = write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialize(stage(spark, docs, str(tmp_path)), name)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in out["quality"].collect()} == {i for i in texts if i % 4}
    deduped = {r["doc_id"]: r["text"] for r in out["line_dedup"].collect()}
    near = [i for i in texts if i % 20 == 1]
    # from 101 on they are exact copies, whose one line stays in the first of them
    assert sum("A line that all good" in x for x in deduped.values()) == 1 and set(deduped) == {i for i in texts if i % 4} - {i for i in near if i > 100}
    kept = {r["doc_id"] for r in out["ngram_join"].collect()}
    assert kept == set(deduped) - set(near[1:])
    mixed = Counter(r["doc_id"] for r in out["mixing"].collect())
    assert set(mixed) <= kept and max(mixed.values()) <= 2
    pieces = out["packing"].toPandas()
    whole = pieces.groupby("doc_id").apply(lambda x: x.drop_duplicates("start").length.sum() == x.doc_tokens.iloc[0], include_groups=False)
    assert whole.all() and set(pieces.doc_id) == set(mixed) and all(len(x) % 4 == 0 for x in pieces.ids)
    again = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    key = lambda x: Counter(zip(x.doc_id, x.start, x.length, x.ids_crc32, strict=True))
    assert key(again) == key(pieces)
    assert np.all(pieces.offset == 0)


def test_one_of_exact_copies_is_mixed(spark, tmp_path):
    text = "The first long line of a copied text\nand its second long line"
    texts = {1: text, 2: text, 3: text.replace("\n", "\n\n\n"), 4: " \n ", 5: "A text that is like none of the others", 6: None}
    docs = spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
    assert {r["doc_id"] for r in docs.collect()} == {1, 4, 5, 6}  # one source, rate 1.5: each that is mixed comes once at least


def odd(spark, extra=()):
    """Nulls in every column, empty and blank texts, a long one, repeated ids and rows, copies without an id."""
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice("bcdfg") + rng.choice("aeiou") + rng.choice("lmnr") for _ in range(n))
    one, two = words(60), words(50)
    rows = [(1, one, "en", "s", 5), (2, one + " more", "en", "s", None), (None, one + " again", None, "s", 5), (2, two, "en", None, 1), (3, None, None, None, None), (4, "", "en", "t", 0), (5, " \n\t", "en", "t", 3)]
    rows += [(6, words(30_000), "en", "t", 0), (7, "the same short text", "en", "s", 0), (7, "the same short text", "en", "s", 0), (None, words(40), None, None, None), (8, words(30) + "\n" + two, "en", "s", 0), *extra]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), one, two


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, tmp_path, name):
    docs, one, two = odd(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    clash = ("row", "key", "size", "copies", "lost", "_drop", "_raw", "_mix_copy", "h", "of", "rate", "seed", "q_score", "n_lines", "x")
    docs = docs.withColumns({c: F.lit(c) for c in clash}).repartition(3)
    spark.createDataFrame([(i, q, 0) for i, q in ((1, 1), (4, 0), (2, None), (None, 1))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = stage(spark, docs, str(tmp_path))
    rows = got.collect()
    assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    if name == "packing":
        assert Counter((r["doc_id"], r["doc_tokens"]) for r in rows if r["start"] == 0)[None, 1] == 0 and len({r["sequence_id"] for r in rows}) == len(rows)
        return
    assert got.columns == docs.columns and all(r[c] == c for r in rows for c in clash)
    texts = [(r["doc_id"], r["text"]) for r in rows]
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    if name == "quality":
        assert Counter(texts) == Counter(given)  # too few labels to fit
    elif name == "line_dedup":
        assert (3, "") in texts and (4, "") in texts and (5, " \n\t") in texts and (2, two) in texts and texts.count((7, "the same short text")) == 2
        assert len(rows) == len(given) and next(x for i, x in texts if i == 8).endswith("\n" + two) is False
    elif name == "ngram_join":
        gone = Counter(given) - Counter(texts)
        assert set(gone) == {(2, one + " more"), (None, one + " again")}  # the other row of id 2 stays
    else:
        assert set(texts) <= set(given) and max(Counter(texts).values()) <= 4


@pytest.mark.parametrize("kinds", [(), (1,)])
def test_without_a_classifier_all_stay(spark, tmp_path, kinds):
    texts = {1: "One text of some words", 2: "Another that is quite unlike it", 3: None}
    spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i in texts for q in kinds], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == set(texts)


def test_catalog():
    names = list(catalog.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(catalog.oracle_sql()) <= set(names)
