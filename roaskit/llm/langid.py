"""Language identification by a bidirectional gated recurrent network over bytes.

One GRU reads each window of bytes from the left, another from the right; their states give every byte
position a distribution over the languages, and a document's distribution is the mean over all its
positions.  The network is trained in numpy by backpropagation through time (Adam, cross-entropy at
every position) on windows of a bounded, documented sample of labelled rows; every whole text is then
labelled, window by window, in Arrow batches.

Learned from: rows whose ``crc32(id as text) mod 4`` is not 2, with text, language and id.
Defined cases: a null text or one without a letter is ``und`` with score 0; with no labelled rows all are
``und``; rows with a null id are never held out and never learned from; repeated rows are labelled each; an
empty table gives an empty result; ties go to the first language in order of name; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import fresh, importable_in_workers, spread, text_slices

UNKNOWN = "und"
#: Bytes per window and the symbol that stands for "no byte" after a text's end.
WINDOW, OUTSIDE = 48, 256
#: The training sample: documents per language, and windows from each.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 400, 6
HIDDEN, BATCH, STEPS, RATE = 8, 256, 240, 0.02
#: Windows that run through the network together.
LANES = 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


@dataclass
class GatedUnit:
    """A GRU whose input is one symbol; states stand in columns, one for each window."""

    table: np.ndarray  # (3 * hidden, symbols): reset, update, candidate
    weights: np.ndarray  # (3 * hidden, hidden)

    def run(self, symbols: np.ndarray, states: np.ndarray, trace: list | None = None) -> None:
        """Fill ``states`` (steps, hidden, windows) for ``symbols`` (steps, windows)."""
        n = self.weights.shape[1]
        h = np.zeros((n, symbols.shape[1]), np.float32)
        for t in range(len(symbols)):
            x, u = np.take(self.table, symbols[t], axis=1), self.weights @ h
            gates = _sigmoid(x[:2 * n] + u[:2 * n])
            r, z = gates[:n], gates[n:]
            c = np.tanh(x[2 * n:] + r * u[2 * n:])
            if trace is not None:
                trace.append((h, r, z, c, u[2 * n:]))
            h = states[t] = c + z * (h - c)

    def back(self, symbols: np.ndarray, trace: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and weights, by backpropagation through time."""
        n = self.weights.shape[1]
        d_table, d_weights = np.zeros_like(self.table), np.zeros_like(self.weights)
        d_h = np.zeros_like(d_states[0])
        one_hot = np.zeros((symbols.shape[1], self.table.shape[1]), np.float32)
        rows = np.arange(symbols.shape[1])
        for t in range(len(symbols) - 1, -1, -1):
            h, r, z, c, u = trace[t]
            d_h = d_h + d_states[t]
            d_c = d_h * (1 - z) * (1 - c * c)
            d_z = d_h * (h - c) * z * (1 - z)
            d_r = d_c * u * r * (1 - r)
            d_x = np.concatenate((d_r, d_z, d_c))
            d_u = np.concatenate((d_r, d_z, d_c * r))
            one_hot[rows, symbols[t]] = 1
            d_table += d_x @ one_hot
            one_hot[rows, symbols[t]] = 0
            d_weights += d_u @ h.T
            d_h = d_h * z + self.weights.T @ d_u
        return d_table, d_weights


@dataclass
class LanguageModel:
    languages: list[str]
    ahead: GatedUnit
    behind: GatedUnit
    out: np.ndarray  # (languages, 2 * hidden)
    bias: np.ndarray  # (languages, 1)

    def states(self, symbols: np.ndarray, traces: tuple[list, list] | None = None) -> np.ndarray:
        n = self.out.shape[1] // 2
        h = np.empty((len(symbols), 2 * n, symbols.shape[1]), np.float32)
        self.ahead.run(symbols, h[:, :n], traces and traces[0])
        self.behind.run(symbols[::-1], h[::-1, n:], traces and traces[1])
        return h

    def positions(self, symbols: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, windows) of each byte position."""
        p = np.exp(np.matmul(self.out, self.states(symbols)) + self.bias)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def documents(self, texts: pa.Array) -> np.ndarray:
        """Mean probabilities (documents, languages) over all byte positions; nan without any."""
        data = pc.cast(pc.fill_null(texts, ""), pa.large_binary())
        sizes = pc.binary_length(data).to_numpy().astype(np.int64)
        flat = np.frombuffer(b"".join(data.to_pylist()), np.uint8)
        per_doc = -(-sizes // WINDOW)
        starts = np.cumsum(sizes) - sizes
        begin = spread(np.zeros(len(sizes), np.int64), per_doc) * WINDOW + np.repeat(starts, per_doc)
        filled = np.minimum(np.repeat(starts + sizes, per_doc) - begin, WINDOW)
        sums = np.zeros((len(begin), len(self.languages)))
        steps = np.arange(WINDOW)[:, None]
        for at in range(0, len(begin), LANES):
            b, n = begin[at:at + LANES], filled[at:at + LANES]
            inside = steps < n
            symbols = np.where(inside, flat[np.minimum(b + steps, len(flat) - 1)], OUTSIDE)
            p = self.positions(symbols)
            if not inside.all():
                p *= inside[:, None, :]
            sums[at:at + LANES] = p.sum(axis=0).T
        docs = np.repeat(np.arange(len(sizes)), per_doc)
        pooled = np.stack([np.bincount(docs, sums[:, k], len(sizes)) for k in range(len(self.languages))], axis=1)
        with np.errstate(invalid="ignore"):
            return pooled / sizes[:, None]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> LanguageModel:
    """Fit on ``windows`` (rows, WINDOW) of symbols with a language number each, classes drawn evenly."""
    rng, n = np.random.default_rng(seed), HIDDEN
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    model = LanguageModel(
        languages, GatedUnit(draw(3 * n, 257, scale=0.3), draw(3 * n, n, scale=0.3)),
        GatedUnit(draw(3 * n, 257, scale=0.3), draw(3 * n, n, scale=0.3)),
        draw(len(languages), 2 * n, scale=0.3), np.zeros((len(languages), 1), np.float32))
    values = [model.ahead.table, model.ahead.weights, model.behind.table, model.behind.weights, model.out, model.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    by_class = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(own, -(-BATCH // len(by_class))) for own in by_class])
        symbols, target = windows[rows].T, labels[rows]
        traces: tuple[list, list] = ([], [])
        h = model.states(symbols, traces)
        p = np.exp(np.matmul(model.out, h) + model.bias)
        p /= p.sum(axis=1, keepdims=True)
        d = p
        d[:, target, np.arange(len(rows))] -= 1
        d *= (symbols != OUTSIDE)[:, None, :] / np.float32(symbols.size)
        d_h = np.matmul(model.out.T, d)
        grads = [*model.ahead.back(symbols, traces[0], d_h[:, :n]),
                 *model.behind.back(symbols[::-1], traces[1], d_h[::-1, n:]),
                 np.einsum("tlb,thb->lh", d, h), d.sum(axis=(0, 2))[:, None]]
        rate = RATE * (1 - 0.9 * step / STEPS)
        for v, g, a, b in zip(values, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return model


def held_out(id_column) -> F.Column:
    """Whether ``crc32(id as text) mod 4`` is 2; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded sample of windows: about SAMPLE_DOCUMENTS documents of each language, SAMPLE_WINDOWS from each."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return np.empty((0, WINDOW), np.int64), np.empty(0, np.int64), []
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, SAMPLE_DOCUMENTS / n)]), F.col("lang"))
    most = int(2 * SAMPLE_DOCUMENTS * len(counts))
    pick = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(11 + k)), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1)
    cuts = [F.substring("text", pick(k).cast("int") + 1, F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)]
    sample = (rows.where((draw < share) & (F.length("text") > 0)).select("doc_id", "lang", draw.alias("draw"), F.array(*cuts).alias("cuts"))
              .orderBy("draw", "doc_id").limit(most).collect())  # a bounded sample: at most `most` rows of short cuts
    sample = sorted(sample, key=lambda r: (r["lang"], r["doc_id"], r["cuts"]))
    languages = sorted({r["lang"] for r in sample})
    texts = [(c.encode()[:WINDOW], languages.index(r["lang"])) for r in sample for c in dict.fromkeys(r["cuts"])]
    windows = np.full((len(texts), WINDOW), OUTSIDE, np.int64)
    for row, (data, _) in zip(windows, texts):
        row[:len(data)] = np.frombuffer(data, np.uint8)
    return windows, np.array([k for _, k in texts], np.int64), languages


_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (m := _LETTER.search(text)) is not None and (m[0].isalpha() or any(map(str.isalpha, text)))


def _languages(model: LanguageModel | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    known = np.array([model is not None and has_letter(t) for t in texts.to_pylist()], bool)
    names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if known.any():
        p = model.documents(texts.filter(pa.array(known)))
        best = p.argmax(axis=1)
        names[known] = np.array(model.languages, object)[best]
        scores[known] = np.clip(p[np.arange(len(p)), best], 0.0, 1.0)
    return names, scores


def _predict(model: LanguageModel | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in text_slices(batch.column(2)):
                names, scores = _languages(model, texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(texts)), batch.column(1).slice(row, len(texts)),
                    pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])
    return predict


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    windows, labels, languages = training_windows(docs, id_col, text_col, lang_col)
    return train(windows, labels, languages) if languages else None


def predict_language(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    importable_in_workers(docs.sparkSession)
    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def _told(model: LanguageModel | None, at: int, columns: int):
    """The rows, cut to their first columns, in whose text (column ``at``) a language is told."""
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in text_slices(batch.column(at)):
                keep = (_languages(model, texts)[0] != UNKNOWN if model is not None
                        else np.array([has_letter(t) for t in texts.to_pylist()], bool))
                yield batch.slice(row, len(texts)).select(list(range(columns))).filter(pa.array(keep, pa.bool_()))
    return told


def keep_told(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose own text a language is told; without a model, those with a letter."""
    importable_in_workers(docs.sparkSession)
    n = len(docs.columns)
    if (text_col, "string") in docs.dtypes:  # a second copy of the texts would double what a task holds
        return docs.mapInArrow(_told(model, docs.columns.index(text_col), n), docs.schema)
    name, = fresh(docs.columns, "own_text")
    return docs.withColumn(name, F.col(text_col).cast("string")).mapInArrow(_told(model, n, n), docs.schema)
