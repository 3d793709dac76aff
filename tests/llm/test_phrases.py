"""Phrase collocations against a plain count of all phrases."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewright.llm import doublearray, phrases
from ratewright.llm.queries import importable

DOCS = "doc_id bigint, text string, lang string, code bigint, n int, rank string"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    importable(spark)


def docs(spark, rows):
    """Documents with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, lang, 1, 2, "x") for i, (t, lang) in enumerate(rows)], DOCS)


def brute(rows, least, first=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def found(spark, rows, least, first=2000, **more):
    return sorted(tuple(r) for r in phrases.collocations(docs(spark, rows), least, first, **more).collect())


def texts(seed, n, vocabulary=("the", "a", "New", "york", "é", "ß日", "x"), ends=(" ", " ", " ", "  ", "\t", ". ", "\n", "!")):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        out.append(("".join(w + rng.choice(ends) for w in words), rng.choice(["en", "en", "de", None, ""])))
    return out


@pytest.mark.parametrize("row_codes, at_once", [(32_768, 400_000), (7, 5)])
def test_equal_to_a_count_of_all_phrases(spark, monkeypatch, row_codes, at_once):
    monkeypatch.setattr(phrases, "ROW_CODES", row_codes)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "SHARE", 3)
    monkeypatch.setattr(phrases, "KNOWN", 9)
    rows = texts(3, 120) + [("New York New York New York", "en")] * 9 + [(None, "en"), ("", None), (" .\n ", "xx")]
    got = found(spark, rows, 6, 25, at_once=at_once)
    assert got == brute(rows, 6, 25)
    assert {lang for lang, *_ in got} == {"en", "de", "und", ""}


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT_BYTES", 64)
    rng = random.Random(5)
    long = "".join(rng.choice(["aa", "b", "cc", "d" * 100]) + rng.choice([" ", " ", ". ", "\t"]) for _ in range(4000))
    rows = [(long, "en"), ("aa b cc", "en"), (long[::-1], "de"), ("z" * 500, "de"), ("..!" * 90 + "aa b", "en")]
    assert found(spark, rows, 40) == brute(rows, 40)


def test_tables_without_phrases(spark):
    assert found(spark, [], 2) == []
    assert found(spark, [(None, None), ("", "en")], 2) == []
    assert found(spark, [("one two three", "en")], 2) == []
    assert found(spark, [("one. one. one", "en")], 2) == []


def test_words_of_a_share_are_not_spelled_out_by_every_task(spark, monkeypatch):
    tables, original = {}, phrases.materialize
    monkeypatch.setattr(phrases, "materialize", lambda df, name: tables.setdefault(name, original(df, name)))
    monkeypatch.setattr(phrases, "SHARE", 2)
    vocabulary = [f"w{i}" for i in range(50)]
    rows = texts(11, 400, vocabulary) + [("rare rare rare", "xx")] * 20
    given = docs(spark, rows).repartition(8)
    _, words, totals = phrases.word_streams(given, 10)
    spelled = tables["streams"].where("code IS NOT NULL")
    assert spelled.count() <= 8  # no more than one language's single word is unknown, once a task
    expected = collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        expected.update((lang, w) for w in re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", text))
    assert {(r.lang, r.word): r.n for r in words.collect()} == {k: n for k, n in expected.items() if n >= 10}


def test_a_clash_of_codes_is_noticed_and_other_codes_are_taken(spark, monkeypatch):
    rows = [("red fox blue fox red fox", "en")] * 3
    seen, original = [], phrases._spell

    def spell(seed, shared):
        seen.append(seed)
        run = original(seed, shared)

        def clashing(batches):
            for batch in run(batches):
                at = batch.schema.get_field_index("clash")
                if seed == 0 and batch.column(at).null_count == 0:
                    batch = batch.set_column(at, "clash", pa.array([True] * batch.num_rows))
                yield batch

        return clashing

    monkeypatch.setattr(phrases, "_spell", spell)
    assert found(spark, rows, 2) == brute(rows, 2)
    assert seen == [0, 1]


@given(st.dictionaries(st.integers(0, (1 << 32) - 1), st.integers(1, (1 << 32) - 1), min_size=1, max_size=50))
@settings(max_examples=60, deadline=None)
def test_packed_counts_come_back(counts):
    ids = sorted(counts)
    got_ids, got = phrases.unpack(phrases.pack(np.array(ids, np.int64), np.array([counts[i] for i in ids])))
    assert got_ids.tolist() == ids and got.tolist() == [counts[i] for i in ids]


@given(st.lists(st.lists(st.integers(0, 5), max_size=30), max_size=6), st.sampled_from([2, 1000]))
@settings(max_examples=60, deadline=None)
def test_a_shard_adds_up_whatever_it_passes_on_early(lists, held):
    before, phrases.SHARD_HELD = phrases.SHARD_HELD, held
    try:
        shard, rows, spread = phrases._Shard(), [], 700_000
        for ids in lists:
            rows += list(shard.add(np.array(ids, np.uint32) * np.uint32(spread)))
        rows += list(shard.rows())
    finally:
        phrases.SHARD_HELD = before
    total = collections.Counter()
    for number, blob in rows:
        for i, n in zip(*phrases.unpack(blob)):
            total[(number << phrases.RANGE_BITS) + int(i)] += int(n)
    assert total == collections.Counter(i * spread for ids in lists for i in ids)


@given(st.lists(st.integers(0, 2), max_size=40))
@settings(max_examples=200, deadline=None)
def test_streams_lose_nothing_but_words_without_a_neighbour(stream):
    runs = lambda s: [r for r in "".join(map(str, s)).split("0") if len(r) > 1]
    got = phrases._without_lone(np.array(stream, np.uint64))
    assert runs(got.tolist()) == runs(stream)
    if stream:
        assert (got[0] == 0) == (stream[0] == 0) or stream[0] != 0


@given(st.sets(st.lists(st.integers(0, 255), min_size=1, max_size=6).map(tuple), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_the_double_array_accepts_its_keys_and_no_others(keys):
    ordered = sorted(keys)
    matrix = np.zeros((len(ordered), 6), dtype=np.int64)
    for row, key in zip(matrix, ordered):
        row[: len(key)] = key
    trie = doublearray.build(matrix, np.array([len(k) for k in ordered]))

    def lookup(key):
        state = np.array([trie.ROOT])
        for symbol in key:
            which, state = trie.advance(state, np.array([symbol]))
            if not len(which):
                return 0
        return int(trie.accept[state[0]])

    assert [lookup(k) for k in ordered] == list(range(1, len(ordered) + 1))
    for key in ordered[:40]:
        for other in (key[:-1], (*key, 7), (*key[:-1], (key[-1] + 1) % 256)):
            assert (lookup(other) > 0) == (other in keys)


def test_a_dense_trie():
    keys = np.array([(a, b) for a in range(256) for b in range(0, 256, 1 + a % 9)])
    trie = doublearray.build(keys, np.full(len(keys), 2))
    which, state = trie.advance(np.zeros(len(keys), np.int64), keys[:, 0])
    assert len(which) == len(keys)
    which, state = trie.advance(state, keys[:, 1])
    assert (trie.accept[state] == np.arange(1, len(keys) + 1)).all()
