"""The training-data operators on small tables, against brute force and on edge cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewright.llm import bitplanes, chat, decontaminate, exactdup, neardup, packing, sitestyle, toxicity, urlrank, warc
from ratewright.llm.common import materialize, scratch_path
from ratewright.llm.components import connected_components
from ratewright.llm.queries import RULES, importable, tokenizer
from ratewright.llm.tokens import PLAIN, SPACED, Encoder
from ratewright.llm.words import ALNUM, NON_SPACE, words_of

DOCS = "doc_id bigint, text string, n bigint, score string, items string, sequence_id int"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    importable(spark)


def docs(spark, rows):
    """Documents with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 7, "x", "y", 3) for i, t in rows], DOCS)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "alone here"), (4, "word"), (5, "Ünïcode ß  x"), (5, "Ünïcode ß  x")]


# ---- words --------------------------------------------------------------------


@given(st.lists(st.text(alphabet="aZ9é .\n\x00'日", max_size=12), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_patterns(texts):
    import re

    column = pa.array([None, *texts], pa.string())
    for kind, pattern in ((ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NON_SPACE, rb"[^\x20\x09-\x0D]+")):
        words = words_of(column, kind)
        for row, text in enumerate(["", *texts]):
            expected = re.findall(pattern, text.encode().lower())
            first, last = words.first[row], words.first[row + 1]
            assert [words.text(i) for i in range(first, last)] == expected


def test_equal_words_have_equal_hashes_wherever_they_stand():
    words = words_of(pa.array(["one two one", "xx one", "two"]), NON_SPACE)
    assert words.hashes[0] == words.hashes[2] == words.hashes[4]
    assert words.hashes[1] == words.hashes[5] != words.hashes[0]


# ---- 1 decontamination ------------------------------------------------------------


def brute_hits(text, items, n=10):
    import re

    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    words, hit, found = cut(text), set(), set()
    for item, body in items:
        own = cut(body)
        width = min(n, len(own))
        windows = {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if own else set()
        for i in range(len(words) - width + 1):
            if width and tuple(words[i : i + width]) in windows:
                hit |= set(range(i, i + width))
                found.add(item)
    return len(words), hit, found


@pytest.mark.parametrize("block", [250_000, 12])
def test_decontamination_finds_what_brute_force_finds(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, text(30)), (2, text(10)), (3, "Short item"), (4, None), (5, ""), (2, text(12))]
    rows = [*EDGES, (10, items[0][1]), (11, f"{text(20)} {items[0][1][:60]}; {text(5)}"), (12, "a SHORT, item!")]
    rows += [(20 + i, f"{text(8)} {' '.join(items[i % 3][1].split()[: 11])} {text(9)}") for i in range(8)]
    bench = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id bigint, text string, words string")
    marked = decontaminate.mark_contamination(docs(spark, rows), bench).collect()
    assert len(marked) == len(rows)
    expected = collections.Counter()
    for i, t in rows:
        n, hit, found = brute_hits(t, items)
        expected[(i, n, len(hit), tuple(sorted(found)))] += 1
    got = collections.Counter(
        (r.doc_id, r.n_words, sum(e - s for s, e in zip(r.hit_starts, r.hit_ends)), tuple(r["items"])) for r in marked
    )
    assert got == expected
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs(spark, rows), bench).collect()}
    assert cut[10] == "" and cut[12] == "a !" and cut[1] is None
    left = decontaminate.drop_contaminated(docs(spark, rows), bench)
    assert left.columns == docs(spark, []).columns
    assert 10 not in {r.doc_id for r in left.collect()}
    assert decontaminate.mark_contamination(docs(spark, rows), bench.limit(0)).where("size(items) > 0").count() == 0
    assert decontaminate.mark_contamination(docs(spark, []), bench).count() == 0


# ---- 2 packing ---------------------------------------------------------------------


@pytest.mark.parametrize("name,units", [("byte_bpe_50k.json", SPACED), ("word_bpe_49k.json", PLAIN)])
def test_cached_ids_are_those_of_the_library(name, units):
    from tokenizers import Tokenizer

    path = tokenizer(name)
    encoder, library = Encoder(path, units), Tokenizer.from_file(path)
    rng = random.Random(5)
    signs = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "'s", "don't", "1", "23", ".", ",", "...", "<|endoftext|>"]
    signs += ["́", "\x1c", "\x85", "　", " ", "日本", "word", " The", "_", "-", "<|", "ﬁ", "ǅ", "\x00"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_units_are_kept_within_bounds():
    from tokenizers import Tokenizer

    from ratewright.llm import tokens

    # what a worker holds beside the JVM: two generations, and the arrays over the text of one call
    assert 2 * tokens.CACHE_UNITS <= 1_000_000 and tokens.AT_ONCE <= 2 << 20
    path = tokenizer("byte_bpe_50k.json")
    encoder, library = Encoder(path, SPACED, cache_units=2), Tokenizer.from_file(path)
    for text in ["one two three", "two " + "x" * 50, "one two three four", "a <|ENDOFTEXT|> b", "<| a |>", "a\x1cb"]:
        ids = np.frombuffer(encoder.encode([text, text])[1], dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert len(encoder._young) <= 6 and all(len(u) <= tokens.CACHED_LENGTH for u in encoder._young)
    # only a text with a mark of a special token is searched for one
    assert encoder._marks and not any(mark.isalpha() for mark in encoder._marks)
    assert encoder._goes_whole("a <|endoftext|> b") and encoder._goes_whole("a\x1cb") and not encoder._goes_whole("<| a |>")


@pytest.mark.parametrize("name,units", [("byte_bpe_50k.json", SPACED), ("word_bpe_49k.json", PLAIN)])
def test_words_of_letters_go_to_the_model_alone(name, units, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer(name)
    encoder, library = Encoder(path, units), Tokenizer.from_file(path)
    letters = [c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº"]
    rng = random.Random(7)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(3000)]
    asked = []
    monkeypatch.setattr(encoder, "_ids_of_any", lambda units: asked.extend(units) or [b""] * len(units))
    text = " ".join(words)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert asked == []


def check_packed(packed, pieces):
    assert sorted((r.row, r.length) for r in packed) == sorted((r.row, r.length) for r in pieces)
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for group in bins.values():
        place = 0
        for offset, length in sorted(group):
            assert offset == place
            place += length
        assert place <= 1024
    return len(bins)


def test_packing_is_whole_gapless_and_tight(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 64)
    rng = random.Random(1)
    rows = [*EDGES, *[(100 + i, "the cat sat on a mat. " * rng.randint(1, 400)) for i in range(150)]]
    pieces = materialize(packing.token_pieces(docs(spark, rows), tokenizer("byte_bpe_50k.json"), with_ids=True), "p")
    whole = collections.defaultdict(dict)
    for r in pieces.collect():
        assert r.length * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        whole[r.doc_id][r.piece] = r
    for parts in whole.values():
        assert [parts[k].length for k in sorted(parts)][1:] == [1024] * (len(parts) - 1)
    packed = packing.pack(pieces.drop("ids")).collect()
    used = check_packed(packed, pieces.collect())
    assert used <= 1.04 * sum(r.length for r in packed) / 1024 + 1  # blocks of 64 pieces only
    assert packing.pack(pieces.drop("ids").limit(0)).count() == 0


def test_genetic_steps_keep_every_piece_and_do_not_get_worse():
    rng = random.Random(4)
    sizes = [rng.choice([340, 345, 520, 505, 260, 700, 410]) for _ in range(60)]
    one, two = packing.Grouping(sizes, 1024), packing.Grouping(sizes, 1024)
    one.add_best_fit(list(range(60)))
    two.add_best_fit(list(range(60)), rng)
    for child in (packing.crossover(one, two, rng), packing.mutate(one, rng)):
        assert sorted(i for g in child.bins for i in g) == list(range(60))
        assert max(map(child.fill, child.bins)) <= 1024
        assert child.fills == list(map(child.fill, child.bins))  # kept, not summed for each comparison
    worst = list(range(60))
    best = packing.evolve(sizes, 1024, [worst], 1, generations=30)
    assert max(best) + 1 <= len(one.bins)


# ---- 3 near duplicates ---------------------------------------------------------------


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_components(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("cell", [4 << 20, 2000])
def test_near_duplicates_are_the_components_of_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(neardup, "CELL_BYTES", cell)
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(500)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 80, 200]))]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    rows += [(1000, "two words"), (1001, "TWO  words"), (1002, None), (1003, " "), (1004, ""), (1005, "x")]
    expected = brute_components(rows, 3, 85)
    got = neardup.near_duplicates(docs(spark, [*rows, (None, "two words"), rows[0]]), 3, 85).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 260)} == {5}


# ---- 4 archives -------------------------------------------------------------------------


def test_archives_round_trip_and_merge_in_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "PER_FILE", 3)
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n" + "x" * 1200, "y" * 1000
    rows = [(1, "http://b.org/2?q=%41", big), (2, "http://b.org/1", big), (3, "http://a.org/\r\nX: 1", big)]
    rows += [(4, None, None), (5, "no scheme", ""), (6, "http://A.org", "short"), (7, "http://a.org", "short")]
    rows += [(8, "http://b.org/1", other), (9, "HTTP://b.org/1", other + "é"), (None, "http://b.org/1", other)]
    rows += [(8, "http://b.org/1", other)]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id bigint, url string, html string, digest string")
    path = scratch_path(spark, "archives")
    warc.write_archives(pages, path)
    merged = warc.merge_index(warc.read_archives(spark, path)).orderBy("range", "number").collect()
    assert len(merged) == len(rows)
    order = [(r.url_key, r.stamp, r.page_id is not None, r.page_id or 0) for r in merged]
    assert order == sorted(order)
    by_id = collections.defaultdict(list)
    for r in merged:
        by_id[r.page_id].append(r)
    kept = {hashlib.sha1(big.encode()).hexdigest(): 3, hashlib.sha1(other.encode()).hexdigest(): 8}
    for i, url, html in rows:
        data = (html or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        for r in by_id[i]:
            assert (r.payload_bytes, r.payload_digest, r.url) == (len(data), digest, url or "")
            revisit = digest in kept and kept[digest] != i
            assert r.record_type == ("revisit" if revisit else "response")
            assert r.refers_to == (kept[digest] if revisit else None)
    empty = scratch_path(spark, "archives")
    warc.write_archives(pages.limit(0), empty)
    assert warc.merge_index(warc.read_archives(spark, empty)).count() == 0


@given(st.lists(st.lists(st.integers(0, 20), max_size=8), max_size=9))
@settings(max_examples=200, deadline=None)
def test_loser_tree_merges_sorted_runs(runs):
    rows = [sorted((f"{v:02}", "t", v) for v in run) for run in runs]
    assert list(warc.LoserTree(rows)) == sorted(x for run in rows for x in run)


# ---- 5 main text ------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<div id="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; &#x74;ail</h1></header><p><b>One
 two<br>three<br><p>Four &lt;b&gt; 5 < 6<ul><li>x<li>y</ul><form><p>Send</form><aside>Also</aside>
<section class="comments"><p>First!</p></section><p>End</p></article><footer>&copy;</footer></body></html>"""


def test_main_text_of_one_page():
    assert sitestyle.main_text(PAGE) == "Head & tail\nOne two three\nFour <b> 5 < 6\nx\ny\nEnd"
    for broken in (None, "", "<", "<p", "plain < text", "<div title='a>b'>t</div>", "</p></div>x", "<script>never"):
        assert "<script" not in sitestyle.main_text(broken)
    assert sitestyle.main_text("plain < text") == "plain < text"
    assert sitestyle.main_text("<div title='a>b'>t</div>") == "t"


def test_style_tree_removes_what_a_host_repeats(spark):
    page = lambda i: f"<body><div class=top>Welcome to us</div><div class=text><p>Story {i} is new</p></div></body>"
    rows = [(i, f"http://h.org/{i}", page(i), "c") for i in range(8)]
    rows += [(50, "http://one.org/", page(1), "c"), (51, None, None, "c"), (52, "http://h.org/x", "", "c")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, removed string")
    got = {r.page_id: r for r in sitestyle.extract_main_text(pages).collect()}
    assert got[3].text == "Story 3 is new" and got[3].n_chars == 14
    assert got[50].text == "Welcome to us\nStory 1 is new"
    assert got[51].text == "" and got[52].text == "" and got[51].url is None and len(got) == len(rows)


# ---- 6 exact duplicates -------------------------------------------------------------------


def test_exact_duplicates(spark):
    rows = [*EDGES, (9, "same  text\n"), (8, "same text "), (7, "same text"), (6, "\u00a0"), (None, "word"), (8, "same\ttext ")]
    got = exactdup.exact_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    groups = collections.defaultdict(list)
    import re

    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.keep_id, r.group_size, r.kept))
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            assert (keep, len(ids), i == keep) in by[i]
    left = exactdup.drop_exact_duplicates(docs(spark, rows)).collect()
    assert len(left) == len(groups) and set(left[0].asDict()) == set(docs(spark, []).columns)
    assert exactdup.exact_duplicates(docs(spark, [])).count() == 0


# ---- 7 toxicity -----------------------------------------------------------------------------


def test_toxicity_separates_held_out_documents(spark):
    rng = random.Random(2)
    words = ["stone", "river", "cloud", "table", "green", "quiet", "paper", "north"]
    rows, truth = list(EDGES), {}
    for i in range(100, 700):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        truth[i] = int(rng.random() < 0.3)
        if truth[i]:
            text.insert(rng.randrange(len(text)), rng.choice(["vilefool", "scumbag"]))
        rows.append((i, " ".join(text)))
    labels = spark.createDataFrame([*[(i, t, 1) for i, t in truth.items()], (1, None, 1), (None, 1, 1), (9999, 1, 1)], "doc_id bigint, toxic int, score int")
    model = toxicity.train(docs(spark, rows), toxicity.train_fold(labels))
    scored = toxicity.score(docs(spark, rows), model)
    assert scored.columns == [c for c in docs(spark, []).columns if c != "score"] + ["score"]
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([(r.score >= 0.5) == bool(truth[r.doc_id]) for r in held]) > 0.97
    none = toxicity.train(docs(spark, rows), labels.limit(0))
    assert toxicity.score(docs(spark, rows), none).where("score >= 0.5").count() == 0
    assert toxicity.score(docs(spark, []), model).count() == 0


# ---- 8 chat -----------------------------------------------------------------------------------


@given(st.text(alphabet="\\<|>s/[INST]im_start\n é", max_size=30), st.text(alphabet="a\\\n<|", max_size=5))
@settings(max_examples=300, deadline=None)
def test_turns_read_back_and_hide_control_strings(text, role):
    template = chat.Template()
    whole = "".join(t for t, _ in template.segments(role, text))
    assert template.parse(whole) == (role, text)
    assert not any(c in template.escape(text) for c in template.controls)


def test_conversations(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "a\\b[INST]"), (1, 2, "user", None), (1, 3, "assistant", "c")]
    rows += [(2, 0, "assistant", "early"), (None, 5, None, None), (3, 1, "system", "s"), (3, 2, "user", "u"), (3, 2, "user", "u")]
    turns = spark.createDataFrame([(*r, True) for r in rows], "conv_id bigint, turn bigint, role string, text string, valid boolean")
    got = {r.conv_id: r for r in chat.conversation_digests(materialize(chat.format_conversations(turns), "f")).collect()}
    joined = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in rows[:4])
    assert got[1].turns_sha256 == hashlib.sha256(joined.encode()).hexdigest() and got[1].valid
    assert got[1].loss_sha256 == hashlib.sha256(b"a\\b[INST]c").hexdigest() and got[1].loss_chars == 10
    assert not got[2].valid and got[2].n_turns == 1 and got[None].n_turns == 1
    assert not got[3].valid and got[3].n_turns == 3 and got[3].loss_chars == 0
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0))).count() == 0


# ---- 9 url filter -------------------------------------------------------------------------------


def test_url_rules_and_propagation(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">x</a>' for h in hosts)
    rows = [(1, "http://A.example.net/en/x?y", ""), (2, "http://example.net/de", ""), (3, "x://notexample.net/en/", "")]
    rows += [(4, "https://b.org/fr/#t", ""), (5, None, None), (6, "nothing", ""), (7, "http://example.com/de/a", "")]
    rows += [(8, "http://bad.net/", ""), (9, "http://farm.info/1", link("bad.net")), (10, "http://farm.info/2", link("bad.net"))]
    rows += [(11, "http://mixed.info/", link("bad.net", "b.org", "c.info")), (12, "http://q.example.com?/de/", link("q.example.com"))]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, host string")
    got = {r.page_id: r for r in urlrank.judge_urls(pages, RULES).collect()}
    rule = {i: (got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in got}
    assert rule[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert rule[2] == ("example.net", "/de", "net/", "block")
    assert rule[3] == ("notexample.net", "/en/", "net/", "block")
    assert rule[4] == ("b.org", "/fr/", "org/fr/", "allow")
    assert rule[5] == rule[6] == ("", "", None, "allow")
    assert rule[7] == ("example.com", "/de/a", "example.com/de/", "block")
    assert rule[9][3] == rule[10][3] == "block"  # links only to a blocked host
    assert rule[11][3] == "allow" and rule[12] == ("q.example.com", "", None, "allow")
    assert urlrank.judge_urls(pages.limit(0), RULES).count() == 0


def test_trust_and_distrust_travel_along_long_chains(spark, monkeypatch):
    """Scores equal the closed form at the end of a chain and on a ring, however many links away the seed is."""
    monkeypatch.setattr(urlrank, "TOLERANCE", 0.05)  # fewer rounds on the ring
    seeds = spark.createDataFrame([("h0", 1.0)], "host string, mass double")
    chain = [(f"h{i}", f"h{i + 1}", 1) for i in range(9)] + [("h9", "r0", 1), ("r0", "r1", 2), ("r1", "r0", 1)]
    edges = spark.createDataFrame(chain, "src string, dst string, weight int")
    got = {r.host: r.score for r in urlrank._spread(seeds, edges, "src", "dst").collect()}
    step = urlrank.DAMPING
    assert all(abs(got[f"h{i}"] - step**i) < 1e-9 for i in range(10))
    assert abs(got["r0"] - step**10 / (1 - step**2)) < 0.05 and abs(got["r1"] - step**11 / (1 - step**2)) < 0.05


# ---- 10 token files -------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.booleans())
@settings(max_examples=100, deadline=None)
def test_planes_round_trip(values, bits):
    ids = np.array(values, dtype="<u4")
    assert bitplanes.join_planes(bitplanes.split_planes(ids, bits), len(ids)).tolist() == values


def test_footers_are_read_once(spark, tmp_path):
    path = str(tmp_path / "once")
    bitplanes.write_token_files(docs(spark, EDGES), path, tokenizer("word_bpe_49k.json"))
    plan = bitplanes.read_token_files(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("binaryFile") == 1


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_round_trip(spark, monkeypatch, bits):
    from tokenizers import Tokenizer

    rows = [*EDGES, *[(100 - i, f"Some words {i} " * (i * 3)) for i in range(40)]]
    path, name = scratch_path(spark, "ids"), tokenizer("word_bpe_49k.json")
    bitplanes.write_token_files(docs(spark, rows), path, name, bits=bits)
    got = bitplanes.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    library = Tokenizer.from_file(name)
    expected = collections.Counter(
        (i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows
    )
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == expected
    place, before = 0, None
    for r in got:
        assert r.start == place and r.n_tokens * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        assert before is None or r.doc_id >= before
        place, before = place + r.n_tokens, r.doc_id
    empty = scratch_path(spark, "ids")
    bitplanes.write_token_files(docs(spark, []), empty, name)
    assert bitplanes.read_token_files(spark, empty).count() == 0


def test_segments_and_chunks_are_cut(spark):
    ids = np.arange(200_000, dtype="<u4") % 50_000
    data = bitplanes.encode_segment(ids.tobytes(), [(1, 150_000), (None, 50_000)], (0, 0), False)
    footer = bitplanes.read_footer(memoryview(data))
    assert len(footer["chunks"]) == 4 and footer["documents"] == [[1, 150_000], [None, 50_000]]
    assert np.concatenate(list(bitplanes.read_chunks(memoryview(data), footer))).tolist() == ids.tolist()


def test_plans_of_the_native_operator_have_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "")], "page_id bigint, url string, html string")
    plan = urlrank.judge_urls(pages, RULES)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and F is not None
