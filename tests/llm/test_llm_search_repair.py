"""Lexical search, MinHash near-duplicates and structure repair against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roaskit.llm import lexical, minhash, repair
from roaskit.llm.common import Scratch, sorted_runs
from roaskit.llm.jaccard import shingle_sets

rng = random.Random(11)
WORDS = ["alpha", "Beta", "gamma", "delta", "éta", "zeta9", "eta", "theta", "iota", "kappa", "ламбда", "x7"]
#: Columns that clash with names used inside the operators.
SCHEMA = "doc_id long, text string, n long, set_no long, class long, peaks string, score double, minima string, __id long"


def _texts():
    base = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n)) for n in (3, 6, 7, 20, 40, 80, 300)]
    out = [None, "", " \t\n", "one", "ONE one", "a b c d e", "a b c d", "!!! ??", "one two-three"]
    for text in base:
        words = text.split()
        out += [text, text.upper() if len(words) < 10 else text, "  " + text.replace(" ", "\n")]
        for _ in range(8):
            changed = list(words)
            changed[rng.randrange(len(words))] = "other" + str(rng.randint(0, 9))
            out.append(" ".join(changed))
        out.append(" ".join(words[1:]))
    out += [" ".join(rng.choice(WORDS) for _ in range(20_000))]
    # a family in which a chain of small changes leads far away
    words = [f"w{k}" for k in range(120)]
    for k in range(40):
        words[3 * k] = f"changed{k}"
        out.append(" ".join(words))
    return out


ROWS = [(i, t) + (1, 2, 3, "p", 0.5, "m", 9) for i, t in enumerate(_texts())]
ROWS += [(7, "one", *ROWS[0][2:]), (7, "one", *ROWS[0][2:]), (None, "ONE", *ROWS[0][2:]), (None, None, *[None] * 7), (None, "zz yy", *[None] * 7)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- MinHash -----------------------------------------------------------------------------------------------

def _components(links, nodes):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def _near(rows, words, percent):
    """(id, shingles, smallest id of the class, kept) of each row."""
    sets = [frozenset(s.tolist()) for s in shingle_sets(pa.array([r[1] for r in rows], pa.string()), words)]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    roots, least = _components(links, range(len(rows))), {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[roots[i]] = min(least.get(roots[i], r[0]), r[0])
    named = [(r[0], len(sets[i]), least.get(roots[i]) if sets[i] else r[0]) for i, r in enumerate(rows)]
    return Counter((*r, r[0] == r[2]) for r in named)


@pytest.mark.parametrize("words,percent,block", [(5, 85, 1024), (2, 80, 4)])
def test_near_duplicates_match_brute_force(docs, monkeypatch, words, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)  # large buckets meet in many pairs of blocks
    got = minhash.near_duplicates(docs, words=words, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == _near(ROWS, words, percent)


def test_near_duplicates_of_nothing(empty):
    assert minhash.near_duplicates(empty).collect() == []


def test_a_family_of_unlike_classes_meets_across_blocks(spark, monkeypatch):
    """Texts that share many buckets but mostly don't link, more than a block holds."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(60)] = f"v{i}{rng.randint(0, 99)}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert Counter(map(tuple, got.collect())) == _near(rows, 3, 85)


def test_signatures_estimate_similarity():
    sets = [np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)]
    mixed = [np.unique(s * np.uint64(0x9E3779B97F4A7C15)) for s in sets]
    one, two = minhash.signatures(mixed, *minhash.universal_hashes(minhash.MINIMA))
    assert abs((one == two).mean() - 0.8) < 0.08
    assert minhash.least_agreement(85) < 0.85 * minhash.MINIMA


def test_star_components(spark):
    """A long chain, a star around a large number, a clique, a loop, random links and repeated ones."""
    links = [(k, k + 1) for k in range(60)] + [(1999, k) for k in range(1000, 1050)] + [(7000, 7000), (5, 5)]
    links += list(itertools.combinations(range(3000, 3008), 2)) + [(rng.randint(4000, 4060), rng.randint(4000, 4060)) for _ in range(50)]
    links += [(b, a) for a, b in links[:80]]
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "one long, two long")
    got = {r["node"]: r["root"] for r in minhash.star_components(frame, Scratch(spark), "t").collect()}
    want = _components(links, {x for link in links for x in link})
    assert got == {x: r for x, r in want.items() if x != r}
    assert minhash.star_components(frame.limit(0), Scratch(spark), "t").collect() == []


def test_sorted_runs_cross_batches():
    rows = [(k, j) for k in range(5) for j in range(7)]
    table = pa.table({"k": [r[0] for r in rows], "j": [r[1] for r in rows]})
    for size in (1, 3, 35):
        runs = list(sorted_runs(iter(table.to_batches(max_chunksize=size)), 1))
        assert [r.column(1).to_pylist() for r in runs] == [list(range(7))] * 5


# --- lexical search ----------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _ranked(rows, items, k):
    counted = [(r[0], Counter(_terms(r[1]))) for r in rows]
    sizes = [sum(c.values()) for _, c in counted]
    docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for (doc, tf), n in zip(counted, sizes):
            m = 100 - 50 + (50 * n * docs) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in set(_terms(text)) if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(found)[:k], 1):
            out[item, rank, None if null else doc, -score] += 1
    return out


ITEMS = [(0, ROWS[40][1]), (1, "One, TWO-three!"), (2, None), (3, "..."), (4, "nowhere at-all"), (5, ROWS[-7][1]), (5, "alpha1 kappa2 éta3 x74"),
         (None, "one")]


@pytest.mark.parametrize("k,block_terms,sparsity", [(50, 100_000, 8), (3, 40, 1), (1, 5, 8)])
def test_search_matches_brute_force(docs, spark, monkeypatch, k, block_terms, sparsity):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(lexical, "SPARSITY", sparsity)
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, item_no int")
    got = lexical.search(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == _ranked(ROWS, ITEMS, k)


def test_search_in_nothing(docs, empty, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(empty, items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []


def test_many_equal_scores_rank_by_id(spark):
    rows = [(i, "same words here") for i in range(500, 0, -1)] + [(1000, "same words here and there")]
    got = lexical.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
                         spark.createDataFrame([(1, "words")], "item_id long, text string"), 50)
    assert Counter(map(tuple, got.collect())) == _ranked(rows, [(1, "words")], 50)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text()), max_size=6))
def test_terms_are_the_matches_of_the_pattern(texts):
    index, offsets, distinct = lexical.split_terms(pa.array(["skipped", *texts], pa.string()).slice(1))
    words = distinct.to_pylist()
    assert [[words[i] for i in index[a:b]] for a, b in zip(offsets[:-1], offsets[1:])] == [_terms(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 400), min_size=1, max_size=30), st.integers(50, 5000))
def test_bounds_are_never_below_the_score(terms, m):
    hashes, tfs = np.array(sorted(terms), np.uint64), np.array([terms[h] for h in sorted(terms)], np.uint32)
    block = lexical.Block(hashes, [0], [np.arange(len(hashes))], np.arange(1, len(hashes) + 1))
    top = lexical.bounds(lexical.sketch(hashes, tfs)[None, :], np.array([m]), block)[0, 0]
    exact = int((block.weights * lexical.impacts(tfs.astype(np.int64), np.array([m]))).sum())
    assert top >= exact


# --- structure repair --------------------------------------------------------------------------------------

def _cheapest(kinds):
    """Least (cost, audit) by a search over all edits, with at most two inserts between rows."""
    done = re.compile(r"(s?(ua)+)?\Z")
    best = 3 * len(kinds), "D" * len(kinds)

    def go(at, roles, cost, audit, free):
        nonlocal best
        if cost > best[0] or not re.match(r"(s?(ua)*u?)?\Z", roles):
            return
        if at == len(kinds) and done.match(roles):
            best = min(best, (cost, audit))
        if free:
            for role in "ua":
                go(at, roles + role, cost + 2, audit + "I", free - 1)
        if at < len(kinds):
            kind = kinds[at]
            extra = kind.isupper() or kind == "+"
            if kind != "x":
                if kind.lower() in "sua":
                    go(at + 1, roles + kind.lower(), cost + extra, audit + "K", 2)
                for role in "ua":
                    go(at + 1, roles + role, cost + 2 + extra, audit + "R", 2)
            go(at + 1, roles, cost + 3, audit + "D", 2)
    go(0, "", 0, "", 2)
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("suaSUAx-+", max_size=6))
def test_parse_finds_the_cheapest_edits(kinds):
    assert repair.best(repair.parse(kinds) if kinds else repair.joined_pieces([])) == _cheapest(kinds)


@settings(max_examples=50, deadline=None)
@given(st.text("suaSUAx-+", min_size=1, max_size=30), st.integers(1, 7))
def test_pieces_join_to_the_whole_chart(kinds, size):
    pieces = [repair.parse(kinds[k:k + size]) for k in range(0, len(kinds), size)]
    assert repair.joined_pieces(pieces) == repair.parse(kinds)


def _repaired(rows):
    """The contract, a conversation at a time, for conversations of a few rows."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        grouped[conv] += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    for conv, own in grouped.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, kinds, faults = set(), "", Counter()
        for _, role, text in own:
            said = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            known = role[:1] if role[:1] in ("s", "u", "a") else "-"
            kinds += "x" if fault in ("blank", "duplicate") else known if fault is None else "+" if known == "-" else known.upper()
        cost, audit = _cheapest(kinds) if len(kinds) <= 5 else repair.best(repair.joined_pieces([repair.parse(k) for k in kinds]))
        turns = [r[0] for r in own if r[0] is not None]
        lines, rest, before = [], iter(own), ""
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(rest)
            if edit != "D":
                role = role if edit == "K" else "assistant" if before == "u" else "user"
                lines.append(f"{role}:{text}")
                before = role[:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in lines))
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
               sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
               hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _conversations():
    rows = [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             rng.choice(["Yes.", "No!", "Why", "Because.\u0085", " \n", "", "Ha? \t", None, "So  ", "One.\nTwo"]))
            for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(100, None, "user", "Null turn."), (100, None, "assistant", "And."), (100, 9, "user", "Gap."), (101, None, "user", "Only."),
             (None, 0, "user", "No id."), (None, None, "assistant", "None."), (102, 3, "user", "Twice."), (102, 3, "user", "Twice."),
             (103, 1, "user", "x" * 100_000 + "."), (103, 2, "assistant", "y" * 100_000)]
    return rows + [(200, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)]


def test_repair_matches_brute_force(spark):
    rows = _conversations()
    frame = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "conv_id long, turn long, role string, text string, conv long, copies int, kind string")
    got = repair.repair_conversations(frame.repartition(3))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(_repaired(rows))


def test_repair_of_nothing(spark):
    assert repair.repair_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
