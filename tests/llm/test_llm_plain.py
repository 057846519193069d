"""Parts of the training-data operators that need no Spark session."""

from __future__ import annotations

import base64
import itertools
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer
from hypothesis import given, settings
from hypothesis import strategies as st

from roaskit.llm import bpe, common, exact_dedup, html_extract, jaccard, langid, lm, packing, token_shards, topk

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.text_encoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text("athein ng1.\n", max_size=300))
def test_bpe_equals_merging_by_rank(encoder, reference, text):
    ids = encoder.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert encoder.bpe.decode(ids) == text.encode()


def test_bpe_on_long_runs(encoder, reference):
    rng = random.Random(1)
    for text in ("a" * 5000, " " * 3000, "".join(rng.choice("abcdethinglo") for _ in range(20_000))):
        assert encoder.encode(text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("literal", [False, True])
def test_word_ids_equal_the_tokenizer(monkeypatch, literal):
    """An untouched tokenizer, and one for which strings of special tokens are ordinary text."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    if literal:
        tokenizer.encode_special_tokens = True
    texts = ["The thing, isn't it?", "", None, "  ", "a\x01b \x01 c", "<|endoftext|> x<|startoftext|>y", "\xc9\u0301 \ufb01 \u65e5\u672c \U0001f642",
             "x y z 12a3", "\u0130stanbul \u01c5 \xf1and\xfa's don't \xd7 \xf7", "plain words only", "na\xefve caf\xe9 Stra\xdfe"]
    for most in (packing.CACHE_BYTES, 0):  # remembered, and forgotten before each slice
        monkeypatch.setattr(packing, "CACHE_BYTES", most)
        words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), literal)
        for _ in range(2):
            ids, offsets = words.encode(pa.array(texts, pa.string()))
            for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
                assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    assert (49407 in words.encode(pa.array(["<|endoftext|>"]))[0].tolist()) is not literal


def _best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            r, i = min(fits)
            rooms[i] = r - n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_runs_place_every_piece_once(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    bins: dict[int, list[tuple[int, int]]] = {}
    for n, first, end, each, bin0, base in packing.best_fit_runs(counts, 40):
        for rank in range(first, end):
            bins.setdefault(bin0 + (rank - first) // each, []).append((base + (rank - first) % each * n, n))
    assert sorted(n for b in bins.values() for _, n in b) == sorted(lengths)
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 40
    assert len(bins) == _best_fit_decreasing(lengths, 40)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1), st.lists(st.integers(0, 60)))
def test_counting_quotient_filters_merge_losslessly(one, two):
    def made(values):
        keys, counts = np.unique(np.array(values, np.uint64) * np.uint64(2**50 + 12345), return_counts=True)
        return exact_dedup.CountingQuotientFilter.build(keys, counts.astype(np.int64), 64 - exact_dedup.QUOTIENT_BITS)
    filters = [made(x) for x in (one, two) if x]
    merged = exact_dedup.CountingQuotientFilter.merge(filters)
    again = exact_dedup.CountingQuotientFilter.from_bytes(*merged.to_bytes(), merged.shift)
    keys, counts = np.unique(np.array(one + two, np.uint64) * np.uint64(2**50 + 12345), return_counts=True)
    assert again.fingerprints().tolist() == keys.tolist() and again.counts.tolist() == counts.tolist()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 9))
def test_feistel_permutation_is_a_permutation(size, key):
    order = token_shards.Permutation(size, key)
    slots = order.slot(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert order.index(slots).tolist() == list(range(size))


@pytest.mark.parametrize("scale", [1, 1 << 30])
def test_approximation_file_is_exact(scale):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-40, 40, (400, 12)).astype(float) * scale
    vectors[100:140] = vectors[7]
    ids = rng.permutation(400)
    keys = np.arange(400)
    got = topk.ApproximationFile(keys, ids, vectors).top(keys[:20], vectors[:20], 5)
    for q in range(20):
        exact = [(sum(int(a) * int(b) for a, b in zip(vectors[q], v)), int(i)) for k, (v, i) in enumerate(zip(vectors, ids)) if k != q]
        within = sorted((-max(-2**63, min(2**63 - 1, s)), i) for s, i in exact)  # beyond a long: its nearest end
        assert [(-s, i) for k, i, s in got if k == q] == within[:5]


@pytest.mark.parametrize("mapped", [True, False])
def test_bloom_levels_never_fall_below_the_counts(tmp_path, monkeypatch, mapped):
    monkeypatch.setattr(lm, "HELD_BYTES", 5000)
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(1, 2000, len(grams))
    parts, shared = lm.part_of(grams, 3), lm.SharedRanges(f"file://{tmp_path}/ranges")
    shared.mapped = mapped
    for p in (0, 2, 2):  # one range without a file, one written by two attempts
        shared.put(lm.GRAM, p, lm.build_segment(grams[parts == p] & np.uint64(0xFFFFFFFF), counts[parts == p]).tobytes())
    mine = parts != 1
    for _ in range(2):
        levels = shared.looked_up(lm.GRAM, 3, grams, lm.levels_in)
        assert (levels[mine] >= lm.levels_of(counts[mine])).all() and (levels[mine] == lm.levels_of(counts[mine])).mean() > 0.9
        assert not levels[~mine].any()
    other = np.sort(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    assert (shared.looked_up(lm.GRAM, 3, other, lm.levels_in) > 0).mean() < 0.05
    assert mapped or len(shared.held) < 3


def test_token_counts_of_ranges(tmp_path):
    shared, keys = lm.SharedRanges(f"file://{tmp_path}/ranges"), np.arange(1, 60, dtype=np.uint64) << np.uint64(58)
    parts = lm.part_of(keys, 4)
    for p in range(4):
        shared.put(lm.TOKEN, p, keys[parts == p].tobytes() + np.arange(1, 60)[parts == p].tobytes())
    asked = np.sort(np.concatenate([keys, keys + np.uint64(1), np.zeros(1, np.uint64)]))
    got = dict(zip(asked.tolist(), shared.looked_up(lm.TOKEN, 4, asked, lm.counts_in).tolist()))
    assert got == {k: 0 for k in asked.tolist()} | dict(zip(keys.tolist(), range(1, 60)))


def test_shares_after_a_token_sum_to_at_most_one():
    """Five successors of count 2 after a token of count 10, and random ones: a level stands for the least of its counts."""
    rng = np.random.default_rng(4)
    for counts in (np.full(5, 2), rng.integers(1, 50, 40), np.array([1, 3, 7, 15, 31])):
        assert lm.counts_of(lm.levels_of(counts)).sum() <= counts.sum()
    assert lm.counts_of(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2, 4]


def test_subsets_and_prefixes_miss_no_linked_pair():
    for percent, n in itertools.product((80, 85), range(1, 60)):
        for m in range(jaccard.least(n, percent), jaccard.largest_partner(n, percent) + 1):
            o = jaccard.need(n, m, percent)
            assert 100 * o >= percent * (n + m - o) and 100 * (o - 1) < percent * (n + m - o + 1)
            if o <= min(n, m):
                assert o in jaccard.subset_sizes(n, percent) and o in jaccard.subset_sizes(m, percent)
                small, large = min(n, m), max(n, m)
                assert jaccard.short_prefix_length(small, percent) >= small - o + 1
                assert jaccard.prefix_length(large, percent) >= large - o + 1


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(4)
    a = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
    for keep in (499, 400, 100, 3):
        b = np.unique(np.concatenate((a[:keep], rng.integers(0, 1 << 63, 40, dtype=np.uint64))))
        differ = len(np.setxor1d(a, b))
        assert jaccard.least_difference(jaccard.parity(a), jaccard.parity(b)) <= differ
        one, two = (np.array(jaccard.sign(x), np.int64).view(np.uint64) for x in (a, b))
        assert int(np.bitwise_count(one ^ two).sum()) <= differ


def test_minimum_cut_against_all_labellings():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 7)
        content, boilerplate = [rng.choice((0, rng.random() * 3)) for _ in range(n)], [rng.choice((0, rng.random() * 3)) for _ in range(n)]
        edges = [(i, j, rng.random()) for i in range(n) for j in range(i) if rng.random() < 0.5]
        cut = html_extract.Cut(content, boilerplate)
        for i, j, c in edges:
            cut.join(i, j, c)
        def cost(labels):
            return (sum(boilerplate[i] if keep else content[i] for i, keep in enumerate(labels))
                    + sum(c for i, j, c in edges if labels[i] != labels[j]))
        assert cost(cut.content_side()) == pytest.approx(min(map(cost, itertools.product((False, True), repeat=n))))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h2>Site name</h2></header>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class="cookie-notice">We use cookies on this site, as all do.</div>
<article><h1>A  heading &amp; more</h1><p>First <b>bold</b>
 paragraph, long enough to count as text.<p>To.</p><script>var t="</p>";</script><ul><li>One item of the list.</li></ul></article>
<aside>Elsewhere you may read other things.</aside><section id="comments"><p>Great article, I liked it a lot, thank you very much.</p></section>
<form><p>Sign up here to get our letters every week.</p></form><footer>&copy; 2020 Site. All rights reserved by it.</footer>{0}"""


@pytest.mark.parametrize("end", ["</body></html>", "", "<!-- open comment"])
def test_main_text_of_a_page(end):
    assert html_extract.main_text(PAGE.format(end)) == (
        "A heading & more\n\nFirst bold paragraph, long enough to count as text.\n\nTo.\n\nOne item of the list.")


SAID = "The first sentence is long enough to be kept,"
REST = "and the second sentence is long enough to be kept too."


@pytest.mark.parametrize("tag", ['<svg class="i"/>', "<math/>", "<svg><path d='x'/></svg>", "<button>", "<select>", "<object>", "<template>",
                                 "<svg>", "<button>Share</button>", "<svg><title>Icon</title></svg>", "<noscript>Turn on</noscript>"])
def test_nothing_after_an_odd_element_is_lost(tag):
    page = f"<article><p>{SAID} {tag} {REST}</p><p>{SAID}</p></article>"
    assert html_extract.main_text(page) == f"{SAID} {REST}\n\n{SAID}"


@pytest.mark.parametrize("tag", ["button-group", "title-bar", "script-box", "select-list"])
def test_custom_elements_are_elements(tag):
    assert html_extract.main_text(f"<article><p>{SAID}</p><{tag}><p>{REST}</p></{tag}><p>{SAID}</p></article>") == f"{SAID}\n\n{REST}\n\n{SAID}"


def test_text_of_math_and_object_is_kept():
    page = f"<article><p>{SAID} <math><mi>x</mi><mo>+</mo><mn>1</mn></math> <object data='f'>a chart</object> {REST}</p></article>"
    assert html_extract.main_text(page) == f"{SAID} x+1 a chart {REST}"


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<" * 2000, "<p " + "x='" * 3000, "</p></div>", "<script>only"])
def test_pages_without_text(html):
    assert html_extract.main_text(html) == ""


TOLD = "The council met on Tuesday evening and agreed to build a bridge over the river."


@pytest.mark.parametrize("page", [
    '<div class="has-sidebar"><article><p>{0}</p></article></div>', '<div class="right-side"><article><p>{0}</p></article></div>',
    "<form action=x><input><article><p>{0}</p></article></form>", '<nav><a href="/">Home</a></nav><p>{0}</p><nav><a href="/m">More</a></nav>',
    '<ul class="menu"><li><a href="/">Home</a><li><a href="/n">News</a></ul><p>{0}</p><div id="footer">Copyright 2020 by us.</div>',
    '<article><p>{0}</p></article><div class="comments"><article><p>A comment. {0}</p></article></div>',
    '<article class="comment"><p>A comment. {0}</p></article><main><p>{0}</p><form><p>Sign up here to get our letters every week.</p></form></main>'])
def test_the_nearest_section_decides(page):
    assert html_extract.main_text(page.format(TOLD)) == TOLD


def test_a_form_around_the_page_is_no_form():
    page = "<form action=x>" + f"<p>{TOLD}</p>" * 8 + "</form>"
    assert html_extract.main_text(page).split("\n\n") == [TOLD] * 8


def test_whole_pages_against_all_labellings():
    rng = random.Random(8)
    parts = ["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}<li><a href=/>{}</a></ul>", "<nav><a href=/>{}</a></nav>", "<article><p>{}</p><p>{}</p></article>",
             "<div class=sidebar>{}</div>", "<div><p>{}</p><div>{}</div></div>", "<header><p>{}</p></header>", "<form>{}</form>"]
    for _ in range(80):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))
        page = page.format(*(" ".join(f"w{k}" for k in range(rng.randint(1, 12))) + rng.choice(("", ".")) + f"#{i}" for i in range(page.count("{}"))))
        found = html_extract.blocks(page)
        costs, edges = [html_extract.score(b) for b in found], html_extract.smoothness(found)
        def cost(keep):
            return (sum(max(-c, 0) if k else max(c, 0) for c, k in zip(costs, keep))
                    + sum(w for (i, j), w in edges.items() if keep[i] != keep[j]))
        best = min(map(cost, itertools.product((False, True), repeat=len(found))))
        said = html_extract.main_text(page).split("\n\n")
        assert cost([b.text in said for b in found]) == pytest.approx(best)


def test_fitted_weights():
    assert (html_extract.fit_weights({}) == html_extract.PRIOR).all() and (html_extract.fit_weights({(3, True): 9}) == html_extract.PRIOR).all()
    linked, paragraph = (html_extract.shape(html_extract.blocks(p)[0]) for p in ("<li><a href=/>Home</a>", f"<p>{TOLD}"))
    weights = html_extract.fit_weights({(linked, False): 500, (paragraph, True): 80})
    x, mass = html_extract._features(), 50.0  # the slope of the loss vanishes
    share = 1 / (1 + np.exp(-(x @ weights)))
    slope = mass * share[linked] * x[linked] - mass * (1 - share[paragraph]) * x[paragraph]
    slope += np.array([1, 400, 1, 1, 1, 1, 1, 1]) * (weights - html_extract.PRIOR)
    assert np.abs(slope).max() < 1e-6
    scores = html_extract.shape_scores(weights)
    assert scores[paragraph] > 2 and scores[linked] < -2


@pytest.mark.parametrize("page", [
    "<article>" + f"<p>{TOLD}</p><ul><li><a href=/>a link</a></li></ul>" * 4000 + "</article>", f"<p>{TOLD}</p><ul><li><a href=/>a link</a></li></ul>" * 4000,
    "<div>" * 8000 + "</b></i></section>" * 8000 + TOLD, "<div><span>" * 8000 + TOLD + "<div>x</div>" * 8000])
def test_time_of_a_long_page(page):
    start = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - start < 3  # about 0.3 s; the square of the blocks would be 30 s


def test_split_words_is_ascii_white_space_only():
    texts = [" a\tb\x0b\x0cc\r\n", "x y \x1c z", "", None, "one"]
    index, offsets, words = common.split_words(pa.array(texts, pa.string()))
    got = [[words[i].as_py() for i in index[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [["a", "b", "c"], ["x y", "\x1c", "z"], [], [], ["one"]]


def test_backpropagation_through_time_gives_the_gradient():
    rng = np.random.default_rng(6)
    unit = langid.GatedUnit(rng.standard_normal((9, 5)), rng.standard_normal((9, 3)))
    symbols, weight = rng.integers(0, 5, (4, 2)), rng.standard_normal((4, 3, 2))
    def loss():
        states = np.empty((4, 3, 2))
        unit.run(symbols, states)
        return float((states * weight).sum())
    trace: list = []
    unit.run(symbols, np.empty((4, 3, 2)), trace)
    for values, grads in zip((unit.table, unit.weights), unit.back(symbols, trace, weight)):
        for at in [(0, 1), (4, 2), (8, 0)]:
            kept = values[at]
            values[at] = kept + 1e-3
            up = loss()
            values[at] = kept - 1e-3
            down = loss()
            values[at] = kept
            assert (up - down) / 2e-3 == pytest.approx(grads[at], abs=2e-2)


def test_crc_of_a_piece_is_of_little_endian_ids():
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    cut = packing._pieces(public_tokenizers.path("word_bpe_49k.json"), 4)
    batch = pa.RecordBatch.from_arrays([pa.array([7, None], pa.int64()), pa.array(["the and of the and", None], pa.string())], names=["a", "b"])
    rows = [r for b in cut(iter([batch])) for r in b.to_pylist()]
    ids = np.append(words.tokenizer.encode("the and of the and", add_special_tokens=False).ids, 0).astype("<u4")
    assert [(r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows] == [(7, 0, 0, 4), (7, 1, 4, 2), (None, 0, 0, 1)]
    assert [r["ids_crc32"] for r in rows[:2]] == [zlib.crc32(ids[:4].tobytes()), zlib.crc32(ids[4:].tobytes())]
