"""Quality by a generalised additive model with pairwise interactions.

Each text is described by a few counts and shares (symbols, capitals, repeated
lines, word lengths ...). Features are cut into quantile bins; shallow trees
are boosted in cycles, one feature at a time with a small step, so each
feature ends as a lookup table over its bins; then the strongest feature pairs
get small two-way tables the same way. A score is a sum of table entries, so
scoring is a vectorised lookup and addition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U64, Block, blocks, is_class, is_space, mix64, span_hashes, unique_per_doc
from .labelled import fitting_rows, is_held_out

MAX_FIT_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
THRESHOLD = 0.7

FEATURES = ("log_words", "word_length", "symbols", "odd_word_ends", "capitals", "symbol_words", "digits",
            "distinct_words", "repeated_lines", "distinct_trigrams", "line_length", "short_lines", "shouts",
            "ended_lines", "commonest_word", "short_words", "non_ascii", "capital_words")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def text_features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES per text; all finite, zeros for an empty text."""
    b = Block(texts)
    cp, n = b.cp, b.n
    space, alpha, digit, upper = is_space(cp), is_class(cp, "alpha"), is_class(cp, "digit"), is_class(cp, "upper")
    plain = np.isin(cp, [ord(c) for c in ".,;:'\"!?()-"])
    symbol = ~(space | alpha | digit | plain)
    starts, ends = b.spans(~space)
    doc = b.doc_of(starts)
    words = np.bincount(doc, minlength=n)
    length = ends - starts
    symbols_to = np.concatenate([[0], np.cumsum(symbol)])
    all_symbol = symbols_to[ends] - symbols_to[starts] == length
    hashes = span_hashes(cp, starts, ends)
    owner, _, times = unique_per_doc(doc, hashes)
    distinct = np.bincount(owner, minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, owner, times)
    same = (doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, dtype=bool)
    tri = mix64(hashes[:-2] + mix64(hashes[1:-1] + mix64(hashes[2:])))[same] if len(doc) > 2 else np.zeros(0, U64)
    tri_doc = doc[2:][same] if len(doc) > 2 else np.zeros(0, np.int64)
    trigrams = np.bincount(tri_doc, minlength=n)
    distinct_tri = np.bincount(unique_per_doc(tri_doc, tri)[0], minlength=n)
    line_s, line_e = b.spans(cp != 0x0A)
    line_doc = b.doc_of(line_s)
    lines = np.bincount(line_doc, minlength=n)
    distinct_lines = np.bincount(unique_per_doc(line_doc, span_hashes(cp, line_s, line_e))[0], minlength=n)
    word_of_line = np.searchsorted(line_s, starts, side="right") - 1
    line_words = np.bincount(word_of_line[word_of_line >= 0], minlength=len(line_s))
    sums = lambda mask, of: np.bincount(of[mask], minlength=n)
    chars, letters = b.lengths, b.per_doc(alpha)
    out = np.column_stack([
        np.log1p(words), _share(np.bincount(doc, length, n), words), _share(b.per_doc(symbol), chars),
        _share(sums(symbol[ends - 1], doc), words), _share(b.per_doc(upper), letters),
        _share(sums(all_symbol, doc), words), _share(b.per_doc(digit), chars), _share(distinct, words),
        _share(lines - distinct_lines, lines), np.where(trigrams > 0, _share(distinct_tri, trigrams), 1.0) * (words > 0),
        np.log1p(_share(chars, lines)), _share(sums(line_words < 5, line_doc), lines),
        _share(b.per_doc((cp == 0x21) | (cp == 0x3F)), words),
        _share(sums(np.isin(cp[line_e - 1], [0x2E, 0x21, 0x3F]), line_doc), lines),
        _share(commonest, words), _share(sums(length <= 3, doc), words), _share(b.per_doc(cp > 0x7F), chars),
        _share(sums(upper[starts], doc), words)])
    return np.nan_to_num(out.astype(np.float64))


@dataclass
class AdditiveModel:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[np.searchsorted(self.pair_edges[i], x[:, i], side="right"),
                         np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return out

    def score(self, texts) -> np.ndarray:
        parts = [self.margins(text_features(part)) for _, part in blocks(texts)]
        margin = np.concatenate(parts) if parts else np.zeros(0)
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _value(g, h):
    return -g / (h + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Best place to split bins lo..hi-1 in two."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
    gains = _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht)
    k = int(np.argmax(gains))
    return float(gains[k]), lo + k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value per bin of a tree of depth two over one feature's bins."""
    out = np.zeros(len(g))
    gain, cut = _best_cut(g, h, 0, len(g))
    if gain <= 0:
        return out
    for lo, hi in ((0, cut), (cut, len(g))):
        gain, mid = _best_cut(g, h, lo, hi)
        for a, b in ((lo, mid), (mid, hi)) if gain > 0 else ((lo, hi),):
            out[a:b] = _value(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best pair of cuts of a two-way table and the value of its four parts."""
    G, H = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    gt, ht = G[-1, -1], H[-1, -1]
    parts = []
    for T in (G, H):
        a = T[:-1, :-1]
        b, c = T[:-1, -1:] - a, T[-1:, :-1] - a
        parts.append((a, b, c, T[-1, -1] - a - b - c))
    gains = sum(_gain(x, y) for x, y in zip(*parts, strict=True)) - _gain(gt, ht)
    out = np.zeros_like(g)
    if gains.size == 0 or gains.max() <= 0:
        return 0.0, out
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    v = [_value(x[i, j], y[i, j]) for x, y in zip(*parts, strict=True)]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(gains.max()), out


def fit_model(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS,
              n_pairs: int = PAIRS, rate: float = RATE) -> AdditiveModel:
    rate_of = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    model = AdditiveModel(float(np.log(rate_of / (1 - rate_of))))
    if len(y) == 0 or y.min() == y.max():
        return model
    d = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(d)]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(d)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    f = np.full(len(y), model.base)
    grads = lambda: ((p := 1 / (1 + np.exp(-f))) - y, p * (1 - p))
    for _ in range(rounds):
        for j in range(d):
            g, h = grads()
            step = rate * _shallow_tree(np.bincount(bins[j], g, len(model.tables[j])),
                                        np.bincount(bins[j], h, len(model.tables[j])))
            model.tables[j] += step
            f += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    width = [len(e) + 1 for e in model.pair_edges]

    def grid(i, j, v):
        return np.bincount(coarse[i] * width[j] + coarse[j], v, width[i] * width[j]).reshape(width[i], width[j])

    g, h = grads()
    ranked = sorted(((_quadrants(grid(i, j, g), grid(i, j, h))[0], i, j) for i, j in combinations(range(d), 2)),
                    reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((width[i], width[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = grads()
            step = rate * _quadrants(grid(i, j, g), grid(i, j, h))[1]
            model.pair_tables[k] += step
            f += step[coarse[i], coarse[j]]
    return model


def _feature_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at, part in blocks(frame["text"]):
            yield pd.DataFrame({"label": frame["label"].iloc[at:at + len(part)].to_numpy(),
                                "x": list(text_features(part))})


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        max_fit_rows: int = MAX_FIT_ROWS) -> AdditiveModel:
    """Features of the fitting rows are counted in Spark; the driver gets one
    short vector per row, at most about ``max_fit_rows``."""
    rows = fitting_rows(docs, labels, label, max_fit_rows) \
        .mapInPandas(_feature_rows, "label int, x array<double>").toPandas()
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    y = rows["label"].to_numpy(dtype=np.float64)
    order = np.lexsort((*x.T, y))  # the model does not depend on the order rows arrive in
    return fit_model(x[order], y[order])


def scorer(model: AdditiveModel) -> Column:
    @F.pandas_udf("double")
    def quality_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(texts), dtype="float64")

    return quality_score


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id, held_out, score,
    predicted``.

    Learns from ``labels`` (``doc_id, quality``) outside the held-out fold
    only; a null label is no label. A null or empty text has all features 0 and
    is scored like any other. Repeated rows are scored each; with no labels, or
    one class only, every score is the base rate. Other columns are not read.
    """
    score = scorer(fit(docs, labels))
    return docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                       score(F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose quality score reaches ``threshold``, all columns."""
    score = scorer(fit(docs, labels))
    rows = docs.select(F.struct("*").alias("row"), score(F.col("text")).alias("score"))
    return rows.where(F.col("score") >= threshold).select("row.*")
