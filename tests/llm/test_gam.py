"""The additive quality model: features against plain Python, lookups, interactions and held-out rows."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewright.llm import gam
from ratewright.llm.queries import importable, queries

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, label int, id string, score string"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    importable(spark)


def plain(text):
    """The features of one text, counted one by one."""
    data = (text or "").encode()
    kinds = collections.Counter()
    for b in data:
        c = chr(b)
        kinds[
            "high" if b >= 128 else "upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit"
            if "0" <= c <= "9" else "space" if c in " \t\n\v\f\r" else "stop" if c in ".?" else "mark"
            if c in ",;:'\"()-" else "symbol"
        ] += 1
    is_symbol = lambda b: b < 128 and not re.match(rb"[A-Za-z0-9 \t-\r.?,;:'\"()-]", bytes([b]))
    raw_lines = [re.findall(rb"[^\x20\x09-\x0D]+", line) for line in data.split(b"\n")]
    lines = [tuple(sorted(w.lower() for w in line)) for line in raw_lines if line]
    raw = [w for line in raw_lines for w in line]
    words = [w.lower() for w in raw]
    n, some = len(words), max(len(data), 1)
    each = max(n, 1)
    pairs = set(zip(words, words[1:]))
    count = collections.Counter(words)
    return [
        np.log1p(len(data)), np.log1p(n), sum(map(len, words)) / each,
        kinds["upper"] / max(kinds["upper"] + kinds["lower"], 1), kinds["digit"] / some, kinds["high"] / some,
        kinds["space"] / some, kinds["stop"] / some, kinds["mark"] / some, kinds["symbol"] / some,
        sum(is_symbol(w[-1]) for w in raw) / each, sum(65 <= w[0] <= 90 for w in raw) / each,
        sum(len(w) <= 3 for w in raw) / each, sum(len(w) >= 15 for w in raw) / each,
        sum(any(map(is_symbol, w)) for w in raw) / each, len(count) / each, len(pairs) / max(n - 1, 1),
        max(count.values(), default=0) / each, np.log1p(len(lines)), n / max(len(lines), 1),
        len(set(lines)) / max(len(lines), 1), kinds["stop"] / each,
    ]


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é .\n|#x", max_size=60)), min_size=1, max_size=8), st.sampled_from([None, 7]))
@settings(max_examples=150, deadline=None)
def test_features_are_those_counted_one_by_one(texts, limit):
    got = gam.features(pa.array(texts, pa.string()), limit)
    assert got == pytest.approx(np.array([plain(t) for t in texts]), abs=1e-12)


def test_long_texts_in_segments_have_the_same_features():
    rng = np.random.default_rng(3)
    long = "".join(w + s for w, s in zip(rng.choice(["Aa", "b|", "cc9", "é" * 40], 9000), rng.choice([" ", "\n", ". "], 9000)))
    column = pa.array(["x y", long, None, long[:5000]])
    assert gam.features(column, 500) == pytest.approx(gam.features(column, 1 << 22), abs=1e-12)


def test_a_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(600, len(gam.FEATURES)))
    labels = (values[:, 0] + rng.normal(size=600) > 0).astype(float)
    model = gam.fit(values, labels)
    binned = model.bins(values)
    for row in (0, 17, 599):
        total = model.intercept
        for i, edges in enumerate(model.edges):
            total += model.tables[i][sum(e <= values[row, i] for e in edges)]
        for (a, b), cells in zip(model.pairs, model.cells):
            total += cells[binned[a, row], binned[b, row]]
        assert model.logits(binned)[row] == pytest.approx(total)
    assert ((model.logits(binned) > 0) == labels).mean() > 0.7


def test_an_interaction_that_no_single_feature_shows_is_learned():
    rng = np.random.default_rng(2)
    values = rng.normal(size=(4000, 4))
    labels = ((values[:, 1] > 0) ^ (values[:, 3] > 0)).astype(float)
    model = gam.fit(values[:3000], labels[:3000])
    assert model.pairs[0] == (1, 3)
    right = (model.logits(model.bins(values[3000:])) > 0) == labels[3000:]
    assert right.mean() > 0.97


def test_held_out_rows_of_the_sample(spark):
    scored = queries()["op11_quality"](spark, SF_DIR)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.predicted for r in good) / len(good) > 0.97
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    everything = scored.select("doc_id", "held_out").collect()
    assert len(everything) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in everything)


def test_edge_cases(spark):
    rows = [(i, "Plain words stand here. And more of them." if i % 2 else "#### |||| $$$$ %%%%", 1, "x", "y") for i in range(60)]
    docs = spark.createDataFrame(rows + [(100, None, 1, "x", "y"), (101, "", 1, "x", "y"), (None, "a", 1, "x", "y")], DOCS)
    labels = spark.createDataFrame(
        [(i, i % 2, "z") for i in range(60)] * 2 + [(None, 1, "z"), (3, None, "z"), (999, 0, "z")],
        "doc_id bigint, quality int, text string",
    )
    got = gam.score(docs, gam.train(docs, labels))
    assert got.columns == ["doc_id", "text", "label", "id", "score"] and got.count() == 63
    scores = {r.doc_id: r.score for r in got.collect()}
    assert scores[1] > 0.8 > 0.2 > scores[2] and scores[100] == scores[101]
    one_class = gam.score(docs, gam.train(docs, labels.where("quality = 1")))
    assert {round(r.score, 6) for r in one_class.collect()} == {round(61 / 62, 6)}
    none = gam.score(docs.limit(0), gam.train(docs.limit(0), labels))
    assert none.collect() == []
    assert {r.score for r in gam.score(docs, gam.train(docs, labels.limit(0))).collect()} == {0.5}
    fold = {r.doc_id for r in gam.train_fold(labels).collect()}
    assert fold == {i for i in [*range(60), 999] if zlib.crc32(str(i).encode()) % 4 != 2}
    assert labels.where(F.col("doc_id").isNull()).count() == 1
