"""Packing token sequences with non-negative least squares.

Documents are tokenized, cut into whole windows and a tail shorter than a
window. Shallow combinations of tail lengths that fill a window exactly are
enumerated; non-negative least squares finds how often to repeat each so that
together they use up the histogram of tail lengths; the counts are rounded and
handed out by each tail's rank among tails of its length. Tails left over are
packed greedily end to end, cut where a window is full.

The driver only sees the histogram (at most one number per length).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_key, running_sums, stored

WINDOW = 1024
END = 0
MAX_PATTERNS = 4000
SWEEPS = 30


@dataclass(frozen=True)
class Vocabulary:
    """Files of one byte-pair vocabulary: as read by ``tokenizers``, and the
    same merges as ranks for the faster ``tiktoken``. Empty paths mean the
    public 50k vocabulary installed beside the libraries."""

    json_path: str = ""
    ranks_path: str = ""
    specials: tuple[str, ...] = ("<|endoftext|>",)

    def encoder(self):
        import base64

        import public_tokenizers
        import tiktoken
        with open(self.ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        slow = []

        def encode(text: str) -> np.ndarray:
            # A text that spells a special token is left to tokenizers itself.
            if any(s in text for s in self.specials):
                if not slow:
                    from tokenizers import Tokenizer
                    slow.append(Tokenizer.from_file(self.json_path or public_tokenizers.path("byte_bpe_50k.json")))
                return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
            return np.array(fast.encode_ordinary(text), dtype="<u4")

        return encode


def _tokenized(vocabulary: Vocabulary, window: int):
    def tokenize(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = vocabulary.encoder()
        for frame in frames:
            rows = []
            for text in frame["text"]:
                ids = np.append(encode(text or ""), np.uint32(END)).astype("<u4")
                full = len(ids) // window
                tail = ids[full * window:]
                rows.append((len(ids), [zlib.crc32(ids[i * window:(i + 1) * window].tobytes()) for i in range(full)],
                             len(tail), tail.tobytes()))
            out = pd.DataFrame(rows, columns=["doc_tokens", "block_crcs", "tail_len", "tail"])
            yield pd.concat([frame[["doc_id", "key"]].reset_index(drop=True), out], axis=1)

    return tokenize


def window_patterns(lengths: list[int], window: int = WINDOW, limit: int = MAX_PATTERNS) -> list[tuple[int, ...]]:
    """Combinations of up to three of the lengths that leave no padding: they
    fill the window, or alone are a power of two. If there are more triples
    than ``limit``, evenly spaced ones; tails they miss are packed greedily."""
    have = set(lengths)
    found = [(a,) for a in sorted(have) if a & (a - 1) == 0]
    found += [(a, window - a) for a in sorted(have) if a <= window - a and window - a in have]
    ordered = sorted(have)
    triples = [(a, b, window - a - b) for i, a in enumerate(ordered) for b in ordered[i:]
               if b <= window - a - b and window - a - b in have]
    room = max(0, limit - len(found))
    if len(triples) > room:
        triples = [triples[int(i)] for i in np.linspace(0, len(triples) - 1, room)] if room else []
    return found + triples


def nnls_counts(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """x >= 0 minimising |A x - h|, column p of A counting each length in
    pattern p, by cyclic coordinate descent with the residual kept up to date."""
    left = {n: float(c) for n, c in histogram.items()}
    columns = [[(n, p.count(n)) for n in set(p)] for p in patterns]
    norms = [sum(m * m for _, m in col) for col in columns]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        moved = 0.0
        for i, col in enumerate(columns):
            step = max(-x[i], sum(m * left[n] for n, m in col) / norms[i])
            if step:
                x[i] += step
                for n, m in col:
                    left[n] -= m * step
                moved = max(moved, abs(step))
        if moved < 0.05:
            break
    return x


@dataclass
class Plan:
    """Where the tail of each (length, rank) goes; arrays of bounded size."""

    window: int
    length: np.ndarray  # of slot runs, sorted by (length, first rank)
    first: np.ndarray
    count: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    used: np.ndarray  # by length: ranks given to patterns
    rest_base: np.ndarray  # by length: where its left-over tails begin, end to end
    rest_edges: np.ndarray  # ends of the last, shorter sequences
    rest_full: int
    rest_sequence: int
    block_sequence: np.ndarray  # by length of the tail: first sequence of the documents' whole windows

    def tail_place(self, n: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the tail, length, sequence, offset) of each piece."""
        if n == 0:
            return []
        if rank < self.used[n]:
            i = int(np.searchsorted(self.length * (1 << 40) + self.first, n * (1 << 40) + rank, side="right")) - 1
            k = rank - int(self.first[i])
            times = int(self.times[i])
            return [(0, n, int(self.sequence[i]) + k // times, int(self.offset[i]) + (k % times) * n)]
        at = int(self.rest_base[n]) + (rank - int(self.used[n])) * n
        pieces, done = [], 0
        while done < n:
            pos = at + done
            if pos < self.rest_full * self.window:
                seq, begin = divmod(pos, self.window)
                room = self.window - begin
            else:
                over = pos - self.rest_full * self.window
                seq = int(np.searchsorted(self.rest_edges, over, side="right"))
                begin = over - (int(self.rest_edges[seq - 1]) if seq else 0)
                room = int(self.rest_edges[seq]) - over
                seq += self.rest_full
            take = min(n - done, room)
            pieces.append((done, take, self.rest_sequence + seq, begin))
            done += take
        return pieces


def make_plan(histogram: dict[int, int], blocks: dict[int, int], window: int = WINDOW) -> Plan:
    """``histogram``: tails by length; ``blocks``: whole windows of the
    documents with each tail length."""
    left = {n: c for n, c in histogram.items() if n > 0}
    patterns = window_patterns(sorted(left), window)
    x = nnls_counts(patterns, left)
    used = np.zeros(window, dtype=np.int64)
    runs, sequence = [], 0
    order = sorted(range(len(patterns)), key=lambda i: (-x[i], patterns[i]))
    for rounding in (True, False):  # the rounded counts first, then whatever still fits whole
        for i in order:
            p = patterns[i]
            fits = min(left[n] // p.count(n) for n in p)
            times = min(fits, int(x[i] + 0.5)) if rounding else fits
            if times <= 0:
                continue
            at = 0
            for n in sorted(set(p), reverse=True):
                m = p.count(n)
                runs.append((n, int(used[n]), times * m, m, sequence, at))
                used[n] += times * m
                left[n] -= times * m
                at += n * m
            sequence += times
    runs.sort()
    base, total = np.zeros(window, dtype=np.int64), 0
    for n in sorted(left, reverse=True):
        base[n] = total
        total += left[n] * n
    full, over = divmod(total, window)
    edges, at = [], 0
    for bit in range(over.bit_length() - 1, -1, -1):  # powers of two need no padding
        if over >> bit & 1:
            at += 1 << bit
            edges.append(at)
    rest_sequence = sequence
    sequence += full + len(edges)
    block_sequence = np.zeros(window, dtype=np.int64)
    for n in sorted(blocks):
        block_sequence[n] = sequence
        sequence += blocks[n]
    columns = [np.array(c, dtype=np.int64) for c in (zip(*runs, strict=True) if runs else [[]] * 6)]
    return Plan(window, *columns, used, base, np.array(edges, dtype=np.int64), full, rest_sequence, block_sequence)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _pieces(plan: Plan):
    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window = plan.window
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                head = len(r.block_crcs)
                first = int(plan.block_sequence[r.tail_len]) + r.blocks_before
                out += [(r.doc_id, i * window, window, int(c), r.doc_tokens, first + i, 0)
                        for i, c in enumerate(r.block_crcs)]
                for start, n, sequence, offset in plan.tail_place(r.tail_len, r.rank):
                    out.append((r.doc_id, head * window + start, n, zlib.crc32(r.tail[4 * start:4 * (start + n)]),
                                r.doc_tokens, sequence, offset))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"doc_id": "Int64"})

    return emit


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """Pieces of the tokenized ``docs`` (``doc_id, text``) placed in sequences
    of at most ``window`` tokens: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``.

    A document's tokens are its text's ids and then id 0; a null or empty text
    is that one token. Each token lies in exactly one piece; offsets in a
    sequence have no gaps; every sequence is full or a power of two long, so
    none is padded. Repeated rows are packed each. An empty table gives an
    empty result. Other columns are not read.
    """
    rows = docs.select("doc_id", "text", hash_key(F.lit("pack"), F.col("doc_id"), F.col("text")).alias("key"))
    tokens = stored(rows.mapInPandas(
        _tokenized(vocabulary, window),
        "doc_id long, key long, doc_tokens long, block_crcs array<long>, tail_len int, tail binary"), "op3-tokens")
    tokens = tokens.withColumn("one", F.lit(1)).withColumn("blocks", F.size("block_crcs"))
    totals = tokens.groupBy("tail_len").agg(F.sum("one").alias("tails"), F.sum("blocks").alias("blocks")).collect()
    plan = make_plan({r.tail_len: r.tails for r in totals}, {r.tail_len: r.blocks for r in totals}, window)
    placed = running_sums(tokens, tokens.select("tail_len", "key", "one", "blocks"), ["tail_len"], "key",
                          [F.col("doc_id"), F.col("doc_tokens")], {"rank": "one", "blocks_before": "blocks"})
    return placed.select("doc_id", "doc_tokens", "block_crcs", "tail_len", "tail", "rank", "blocks_before") \
        .mapInPandas(_pieces(plan), PIECES)
