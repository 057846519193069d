"""Training-data operators on small tables with every awkward case, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from roaskit.llm import bpe, chat, common, exact_dedup, html_extract, jaccard, langid, lm, packing, token_shards, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone_id long, piece int, fingerprint string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def _documents():
    rng = random.Random(11)
    base = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(n)) for n in (6, 9, 14, 30, 60, 200)]
    texts = [None, "", "   ", "one", "one", "ONE", "12 34 !!", "a b c", "a b c d", "a b c d e", "a  b\tc\nd e"]
    for text in base:
        texts += [text, text]
        words = text.split()
        for _ in range(6):
            changed = list(words)
            changed[rng.randrange(len(words))] = "changed" + str(rng.randint(0, 99))
            texts.append(" ".join(changed))
        texts.append(" ".join(words[1:]))
    texts.append(" ".join(rng.choice(WORDS) for _ in range(30_000)))
    rows = [(i, t, ("en", "de", None)[i % 3], "s", len(t or ""), 1, 2, "x") for i, t in enumerate(texts)]
    return rows + [rows[11], rows[11], (None, texts[11], "en", None, None, None, None, None), (None, None, None, None, None, None, None, None)]


ROWS = _documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _tokens(text):
    return (text or "").encode().lower().split()


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(docs, path).collect()
    words = packing.WordIds(path)
    lengths = Counter(len(words.tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ROWS)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in rows) == sum(n * k for n, k in lengths.items())
    assert all(r.start == 2048 * r.piece for r in rows) and sum(r.piece == 0 for r in rows) == len(ROWS)
    assert packing.pack_documents(empty, path).count() == 0


def test_exact_dedup(docs, empty):
    groups = defaultdict(list)
    for r in ROWS:
        groups[r[1] or ""].append(r[0])
    got = exact_dedup.exact_copies(docs).collect()
    assert len(got) == len(ROWS)
    kept = Counter()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in got:
        ids = groups[by_sha[r.text_sha256]]
        largest = max((i for i in ids if i is not None), default=None)
        assert (r.group_size, r.keep_id) == (len(ids), largest)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == largest
    assert set(kept.values()) == {1}
    stays = exact_dedup.drop_exact_copies(docs)
    assert stays.columns == docs.columns and sorted(r.text or "" for r in stays.collect()) == sorted(groups)
    assert exact_dedup.exact_copies(empty).count() == 0


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (1, 80)])
def test_jaccard_classes(docs, words, percent):
    sets, ids = [], []
    for r in ROWS:
        w = _tokens(r[1])
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
        ids.append(r[0])
    parent = list(range(len(sets)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(sets)):
        least[find(i)].append(ids[i])
    expected = Counter((ids[i], len(sets[i]), min((x for x in least[find(i)] if x is not None), default=ids[i])) for i in range(len(sets)))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, words, percent).collect())
    assert got == expected


def test_jaccard_of_nothing(empty, spark):
    assert jaccard.near_duplicates(empty).count() == 0
    bare = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert sorted(jaccard.near_duplicates(bare).collect()) == [(1, 0, 1), (2, 0, 2)]


def _score(rows):
    c, g = Counter(), Counter()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for r in rows:
        if not out(r[0]):
            w = [*_tokens(r[1]), b" "]
            c.update(w)
            g.update(zip(w, w[1:]))
    n, v = sum(c.values()), len(c)
    quantised = lambda k: 0 if not k else 2 ** math.floor(math.log2(k))
    for r in rows:
        w = [*_tokens(r[1]), b" "]
        one = [math.log10((c[x] + 1) / (n + v + 1)) for x in w]
        score = one[0]
        for a, b, lone in zip(w, w[1:], one[1:]):
            score += math.log10(lm.WEIGHT * min(1, quantised(g[a, b]) / c[a]) + (1 - lm.WEIGHT) * 10 ** lone) if c[a] else lone
        yield r[0], out(r[0]), len(w), sum(c[x] > 0 for x in w), n, sum(one), score


@pytest.mark.parametrize("sliced", [False, True])
def test_lm_scores(docs, monkeypatch, sliced):
    if sliced:  # the filter and the token counts in many hash ranges
        monkeypatch.setattr(lm, "SEGMENT_BYTES", 3_000)
        monkeypatch.setattr(lm, "SEGMENTS_PER_RANGE", 3)
    got = sorted(map(tuple, lm.score_documents(docs).collect()), key=lambda r: (str(r[0]), r[2]))
    want = sorted(_score(ROWS), key=lambda r: (str(r[0]), r[2]))
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
        assert b[6] - 1e-9 <= a[6] <= b[6] + 0.15 * a[2]  # false positives only raise a score


def test_lm_of_nothing(empty, spark):
    assert lm.score_documents(empty).count() == 0
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = lm.score_documents(spark.createDataFrame([(out, "all held out")], "doc_id long, text string")).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.score) == (4, 0, 0, 0.0)


def test_language_id(docs, empty, spark):
    rng = random.Random(3)
    letters = {"xx": "abcdefgh", "yy": "stuvwxyz"}
    rows = [(i, "".join(rng.choice(letters[lang] + " ") for _ in range(rng.randint(20, 300))), lang)
            for i in range(400) for lang in [("xx", "yy")[i % 2]]]
    rows += [(500, None, "xx"), (501, "12 .. 5", "yy"), (None, "abab", "xx")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.predict_language(table, langid.fit(table)).collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    assert sum(got[i].lang_pred == ("xx", "yy")[i % 2] for i in held if i < 400) >= 0.98 * sum(i < 400 for i in held)
    assert got[500].lang_pred == got[501].lang_pred == "und" and not got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict_language(docs, None).where("lang_pred <> 'und'").count() == 0
    assert langid.fit(empty) is None


def test_byte_bpe(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder = bpe.text_encoder(path, public_tokenizers.PATTERN)
    want = Counter()
    for r in ROWS:
        ids = encoder.encode(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip(docs, path, public_tokenizers.PATTERN).collect())) == want
    ids = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    texts = Counter((r.doc_id, bytes(r.bytes)) for r in bpe.decode_documents(ids, path, public_tokenizers.PATTERN).collect())
    assert texts == Counter((r[0], (r[1] or "").encode()) for r in ROWS)
    assert bpe.round_trip(empty, path, public_tokenizers.PATTERN).count() == 0


def test_token_shards(docs, empty):
    shards = token_shards.write_shards(docs, stride=64, per_shard=8)
    rows = shards.read().collect()
    assert sorted(r.slot for r in rows) == list(range(shards.sequences))
    assert sorted(r.source_index for r in rows) == list(range(shards.sequences))
    assert sum(r.n_ends for r in rows) == len(ROWS)
    assert sum(r.n_tokens for r in rows) == sum(len((r[1] or "").encode()) + 1 for r in ROWS)
    assert token_shards.write_shards(empty).read().count() == 0


def test_token_shards_of_empty_texts(spark):
    texts = ["one"] + [None, ""] * 1510 + ["two"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = token_shards.write_shards(table, stride=64, per_shard=8).read().collect()
    total = sum(len((t or "").encode()) + 1 for t in texts)
    assert sum(r.n_ends for r in rows) == len(texts) and sum(r.n_tokens for r in rows) == total
    assert sorted(r.n_tokens for r in rows) == [total % 64] + [64] * (total // 64)


@pytest.mark.parametrize("vocabulary, size", [(49408, 2), (100_000, 4)])
def test_token_shards_of_a_tokenizer(spark, docs, vocabulary, size):
    from pathlib import Path
    path, end = public_tokenizers.path("word_bpe_49k.json"), vocabulary - 1
    words, rows = packing.WordIds(path, literal=True), docs.coalesce(1)
    texts = [r.text for r in rows.collect()]
    own = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    want = Counter(map(tuple, own))
    listed = spark.createDataFrame([(ids if t is not None else None,) for ids, t in zip(own, texts)], "ids array<int>").coalesce(1)
    for shards in (token_shards.write_shards(rows, stride=64, per_shard=8, tokenizer_path=path, end_id=end, vocabulary=vocabulary),
                   token_shards.write_shards(listed, stride=64, per_shard=8, ids_col="ids", end_id=end, vocabulary=vocabulary)):
        got = {}
        for r in shards.read().collect():
            data = Path(shards.base.removeprefix("file:"), f"shard-{r.shard:010d}.bin").read_bytes()[r.offset:r.offset + 64 * size]
            assert zlib.crc32(data) == r.ids_crc32
            got[r.source_index] = [int.from_bytes(data[k:k + size], "little") for k in range(0, size * r.n_tokens, size)]
        found, ids = Counter(), []
        for i in (i for k in range(shards.sequences) for i in got[k]):
            if i == end:
                found[tuple(ids)] += 1
                ids = []
            else:
                ids.append(i)
        assert found == want and not ids
    with pytest.raises(Exception, match="do not fit"):
        token_shards.write_shards(listed, ids_col="ids", end_id=9, vocabulary=10)


def test_token_shards_are_resumed_from_their_folder(spark, docs, empty, tmp_path):
    path = f"file://{tmp_path}/shards"
    whole = token_shards.write_shards(docs, key=5, stride=64, per_shard=8, path=path).read().collect()
    again = token_shards.Shards.open(spark, path)
    assert len(whole) == again.sequences > 50 and Counter(again.read().collect()) == Counter(whole)
    for a, b in ((0, 1), (8, 16), (13, 43), (again.sequences - 3, None), (40, 10_000), (9, 9), (10_000, None)):
        part = again.read(a, b)
        assert Counter(part.collect()) == Counter(r for r in whole if a <= r.slot < (b or 10_000))
    assert len(again.read(13, 31).inputFiles()) == 3
    with pytest.raises(FileExistsError):
        token_shards.write_shards(docs, path=path)
    none = token_shards.write_shards(empty, path=f"file://{tmp_path}/none")
    assert token_shards.Shards.open(spark, none.base).read().count() == 0


def test_exact_top_k(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(130)] + [(i, [0.5] * 6) for i in range(130, 160)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6),
             (250, [0.25, 0.5]), (251, [0.5, 0.5]), (50, [0.1] * 6)]
    got = topk.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = Counter()
    for at, (q, v) in enumerate(good):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for k, (i, w) in enumerate(good) if k != at and len(w) == len(v))[:5]
            want.update((q, n, i, -s) for n, (s, i) in enumerate(scores, 1))
    assert Counter(map(tuple, got)) == want
    assert topk.top_inner_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


ODD = ["</s>[INST] ok [/INST]", "<|end|>", "<\\|end|>", "<\\\\|text|>", "[\\INST]", "plain\ntext", "", None, "<|turn|>user<|text|>", "é" * 1500, "<<SYS>> <</SYS>>"]


def test_chat_formatting_reads_back(spark):
    rows = [(c, t, ("user", "assistant", None, "<|end|>")[(c + t) % 4], ODD[(3 * c + t) % len(ODD)]) for c in range(11) for t in range(5)]
    rows += [(3, 2, "user", "twin"), (3, 2, "user", "twin"), (None, None, "assistant", "lost")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(table)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((-1 if t is None else t, role is not None, role or "", text is not None, text or ""))
    for c, turns in groups.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for _, _, r, _, x in turns)
        loss = "".join(x for _, _, r, _, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(got[c])[1:5] == (len(turns), sha(whole), len(loss), sha(loss))
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_chat_events_fold(spark):
    events = [(1, 0, 0, "delta", "user", "Hi"), (1, 0, 1, "delta", None, " there"), (1, 1, 2, "delta", "assistant", "Wrong"),
              (1, 2, 3, "delta", "user", "Lost"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "Ri"),
              (1, 1, 6, "delta", None, "ght"), (1, 2, 7, "delta", "user", "Next"), (1, 0, 8, "edit", None, "Hello"), (1, 0, 9, "delta", None, "!")]
    table = spark.createDataFrame(events, "conv_id long, turn long, seq long, kind string, role string, text string").repartition(4)
    got = [(r.turn, r.role, r.text) for r in chat.messages(table).orderBy("turn").collect()]
    assert got == [(0, "user", "Hello!"), (1, "assistant", "Right"), (2, "user", "Next")]


def test_html_extraction(spark):
    rows = [(1, "u", "<article><p>A text that is long enough to be kept here.</article>", 5), (2, None, None, 5), (2, None, "", 5), (None, "v", "<nav>x</nav>", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted(map(tuple, html_extract.extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, "u", "A text that is long enough to be kept here.", 43), (2, None, "", 0), (2, None, "", 0), (None, "v", "", 0)], key=str)


def test_html_weights_are_fitted_on_the_pages(spark):
    page = "<nav><a href=/>Home</a><a href=/n>News</a></nav><article><h1>News today</h1><p>A text that is long enough to be kept here.</article>"
    rows = [(i, None if i % 3 else f"u{i}", None if i % 5 == 0 else page) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts = {}
    for _, _, html in rows:
        for b in html_extract.blocks(html or ""):
            key = html_extract.shape(b), html_extract.section(b) == html_extract.MAIN
            counts[key] = counts.get(key, 0) + 1
    assert np.allclose(html_extract.fit(pages), html_extract.fit_weights(counts))
    assert not np.allclose(html_extract.fit(pages, 5), html_extract.PRIOR)
    assert (html_extract.fit(pages.limit(0)) == html_extract.PRIOR).all()
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_batches_of_texts_are_bounded(spark):
    name, rows = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(3000, numPartitions=1).selectExpr("id", "repeat('x', 5000) as text")
    before = spark.conf.get(name)
    try:
        common.texts_in_slices(spark)
        sizes = [r.n for r in rows.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long").collect()]
        assert len(sizes) > 3 and max(sizes) < 1.1 * common.SLICE_BYTES
        spark.conf.set(name, 1 << 20)
        common.texts_in_slices(spark)
        assert spark.conf.get(name) in ("1048576", "1048576b")
    finally:
        spark.conf.set(name, before)


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    told = langid.predict_language(docs, langid.fit(docs)).collect()
    named = {r.doc_id for r in told if r.lang_pred != "und"}
    kept = {}
    for r in ROWS:  # exact copies: the largest id stays
        if r[0] in named and (r[1] or "").strip() and any(map(str.isalpha, r[1])):
            kept[r[1]] = max([x for x in (kept.get(r[1]), r[0]) if x is not None], default=None)
    ids = [i for i in kept.values() if i is not None]
    texts = {i: t for t, i in kept.items()}
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i in ids for w in [_tokens(texts[i])]}
    group = {i: i for i in ids}
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    stays = {i for i in ids if group[i] == i}
    assert {r.doc_id for r in out} - {None} == stays
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "best_fit_packing"]


def test_pipeline_decides_by_row(spark):
    rng = random.Random(4)
    long = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(6)]
    near = [t + " and one more" for t in long]
    rows = [(None, long[0]), (None, "12 ..."), (None, None), (7, long[1]), (7, ""), (7, "!"),  # und rows share ids with clean ones
            (None, near[0]),  # near copies without ids
            (7, near[1]),  # near copies that share the least id
            (20, long[2]), (21, near[2]), (21, long[3]),  # a dropped id on an unrelated text
            (30, long[4]), (None, near[4]), (40, "alone words here"), (None, long[5]), (None, "another lonely text")]
    docs = spark.createDataFrame([(i, t, ("en", "de")[k % 2]) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string")
    told = corpus_pipeline.language(spark, docs, "")
    clean = Counter((i, t) for i, t in rows if t and any(map(str.isalpha, t)))
    assert told.columns == docs.columns and Counter((r.doc_id, r.text) for r in told.collect()) == clean
    stays = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, told, "").collect()]
    for pair in ([(None, long[0]), (None, near[0])], [(7, long[1]), (7, near[1])]):
        assert sum(r in pair for r in stays) == 1
    assert Counter(r for r in stays if r[1] not in (long[0], near[0], long[1], near[1])) == Counter(
        [(20, long[2]), (21, long[3]), (30, long[4]), (40, "alone words here"), (None, long[5]), (None, "another lonely text")])
    twice = told.where("text = 'alone words here'")
    assert jaccard.drop_near_duplicates(twice.union(twice).union(twice)).collect() == twice.collect()


def test_language_stage_without_labels(spark):
    rows = [(1, "a clean text", None), (2, "12 ...", None), (None, "one more", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()} == {1, None}
    assert corpus_pipeline.language(spark, docs, "").count() == 2


def test_pipeline_stages_take_any_column_names(spark):
    odd = ["own_text", "gone_id", "gone_sha", "gone_twin", "gone_digest", "own_times", "__text", "__gone_id", "__id", "KEY", "n", "class", "digest"]
    rows = [(i, t, "en", *range(len(odd))) for i, t in enumerate(["some clean words here", "some clean words here", "12 ...", None, "others"])]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, lang string, " + ", ".join(f"`{c}` int" for c in odd))
    told = corpus_pipeline.language(spark, docs, "")
    assert told.columns == docs.columns and sorted(r.doc_id for r in told.collect()) == [0, 0, 1, 4]
    once = corpus_pipeline.exact_copies(spark, told, "")
    assert once.columns == docs.columns and sorted(r.doc_id for r in once.collect()) == [1, 4]
    near = corpus_pipeline.near_copies(spark, told, "")
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.collect()) == [0, 4]
    assert corpus_pipeline.pack(spark, near, "").count() == 2
