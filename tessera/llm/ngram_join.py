"""Similarity join on word shingles by a size-aware heavy-light method.

A document is its set of distinct 5-word shingles; documents link when their
sets' Jaccard similarity reaches the threshold t. Two sets of sizes a and b
link only if they share at least c(a, b) = ceil(t (a + b) / (1 + t)) shingles.

* Small sets (up to a size chosen by cost) enumerate all their subsets of the
  sizes c(a, b) can take: a link between two small sets is a shared subset.
* Larger sets scan inverted lists. All sets list their shingles in one global
  order, frequent shingles last; a linked pair shares one of the first
  n - ceil(t n) + 1 shingles of each. Lists of ordinary shingles are joined
  with themselves and shared entries counted; the count bounds the overlap,
  so most pairs end there.
* Lists of frequent shingles are only reached by sets made of little else
  (groups of near copies). They are not paired up: each set is compared with
  the most typical set of each of its lists (the one richest in frequent
  shingles), and only those that did not link to it scan the sets that have
  this head in common, in blocks.

Candidates are checked on the full sets. Sets that are equal are one class
from the start. Shingles are 64-bit hashes: two different shingles of a
candidate pair share one with a chance of about n^2 / 2^64.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U64, Block, blocks, is_space, mix64, span_hashes
from .common import stored
from .graph import components

SHINGLE = 5
SIMILARITY = (80, 100)
FREQUENT = 8  # documents of a shingle, as summed from counts of 2 and more per batch
MAX_FREQUENT = 1_000_000  # frequent shingles put last; which ones only moves cost
MAX_SMALL = 12
LONG_LIST = 64  # an ordinary shingle's list of more sets counts as a frequent shingle's
CELL = 500  # sets per block of a list group
COUNT_BATCH = 8_000_000

PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                   0x85EBCA77C2B2AE63], dtype=np.uint64)  # odd multipliers, one per word place


def shingle_sets(texts: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lower-cased, words
    between white space; fewer words than ``width`` make one shingle, none an
    empty set."""
    b = Block(texts)
    cp = np.where((b.cp >= 65) & (b.cp <= 90), b.cp + 32, b.cp)
    starts, ends = b.spans(~is_space(cp))
    doc = b.doc_of(starts)
    words = span_hashes(cp, starts, ends)
    first = np.searchsorted(doc, np.arange(b.n))
    count = np.bincount(doc, minlength=b.n)
    hashes, owner = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    m = len(words) - width + 1
    if m > 0:
        acc = np.zeros(m, dtype=U64)
        for k in range(width):
            acc += words[k:k + m] * PLACES[k % len(PLACES)]
        whole = doc[:m] == doc[width - 1:width - 1 + m]
        hashes, owner = mix64(acc[whole]), doc[:m][whole]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        extra = np.array([int((words[first[i]:first[i] + count[i]] * PLACES[:count[i]]).sum(dtype=U64)) for i in short],
                         dtype=U64)
        hashes = np.concatenate([hashes, mix64(extra + count[short].astype(U64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        hashes, owner = hashes[new], owner[new]
    return np.split(hashes, np.searchsorted(owner, np.arange(1, b.n)))


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def least_overlap(a: int, b: int, t: tuple[int, int] = SIMILARITY) -> int:
    return _ceil(t[0] * (a + b), t[0] + t[1])


def prefix_length(n: int, t: tuple[int, int] = SIMILARITY) -> int:
    return n - _ceil(t[0] * n, t[1]) + 1


def subset_sizes(n: int, largest: int, t: tuple[int, int] = SIMILARITY) -> list[int]:
    """Overlaps that links between a set of size n and small sets need."""
    partners = range(_ceil(t[0] * n, t[1]), min(largest, t[1] * n // t[0]) + 1)
    return sorted({c for m in partners if (c := least_overlap(n, m, t)) <= min(n, m)})


def small_limit(sizes: dict[int, int], repeats: float, t: tuple[int, int] = SIMILARITY) -> int:
    """Largest size that enumerates subsets: where the rows it would emit cost
    less than list entries plus the ``repeats`` sets met per entry."""
    best, best_cost = 0, None
    for limit in range(0, MAX_SMALL + 1):
        cost = 0.0
        for n, docs in sizes.items():
            if n <= limit:
                cost += docs * sum(math.comb(n, c) for c in subset_sizes(n, limit, t))
            if n * t[1] > limit * t[0]:
                cost += docs * prefix_length(n, t) * (1 + repeats)
        if best_cost is None or cost < best_cost:
            best, best_cost = limit, cost
    return best


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == U64 else x


def _batch_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shingles that two or more documents of a batch hold, and sizes of small sets."""
    held, total, sizes = [], 0, {}

    def flush():
        tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, U64), np.zeros(0))
        many = counts > 1
        return pd.DataFrame({"kind": "token", "value": _signed(tokens[many]), "docs": counts[many].astype(np.int64)})

    for frame in frames:
        for _, part in blocks(frame["text"]):
            for s in shingle_sets(part):
                if 0 < len(s) <= 2 * MAX_SMALL:
                    sizes[len(s)] = sizes.get(len(s), 0) + 1
                held.append(s)
                total += len(s)
            if total > COUNT_BATCH:
                yield flush()
                held, total = [], 0
    yield flush()
    yield pd.DataFrame({"kind": "size", "value": list(sizes), "docs": list(sizes.values())}) \
        .astype({"kind": str, "value": np.int64, "docs": np.int64})


def _subset_key(shingles: tuple[int, ...]) -> int:
    """60-bit hash of a subset, its size in the lowest four bits."""
    digest = hashlib.blake2b(np.array(shingles, dtype=U64).tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) >> 4 << 4 | len(shingles)


SETS = ("doc_id long, n long, class binary, subsets array<long>, tokens array<long>, frequent array<long>, "
        "typical double")


def _set_rows(frequent: np.ndarray, counts: np.ndarray, limit: int, t: tuple[int, int]):
    """One row per document: its size, a fingerprint of the whole set, and its
    list entries. ``frequent`` is sorted, with its ``counts``."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = {n: subset_sizes(n, limit, t) for n in range(1, limit + 1)}
        for frame in frames:
            ids = frame["doc_id"]
            for at, part in blocks(frame["text"]):
                out = []
                for s in shingle_sets(part):
                    n = len(s)
                    row = [n, hashlib.blake2b(s.tobytes(), digest_size=16).digest(), [], [], [], 0.0]
                    if 0 < n <= limit:
                        whole = s.tolist()
                        row[2] = [_subset_key(c) for k in sizes[n] for c in combinations(whole, k)]
                    if n * t[1] > limit * t[0]:
                        rank = np.zeros(n, dtype=np.int64)
                        if len(frequent):
                            k = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                            rank = np.where(frequent[k] == s, counts[k], 0)
                        first = np.lexsort((s, rank))[:prefix_length(n, t)]
                        is_frequent = rank[first] > 0
                        row[3] = _signed(s[first][~is_frequent]).tolist()
                        row[4] = _signed(s[first][is_frequent]).tolist()
                        row[5] = float((rank > 0).mean())
                    out.append(row)
                table = pd.DataFrame(out, columns=["n", "class", "subsets", "tokens", "frequent", "typical"])
                table.insert(0, "doc_id", ids.iloc[at:at + len(part)].astype("Int64").to_numpy())
                yield table

    return rows


def _full_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at, part in blocks(frame["text"]):
            yield pd.DataFrame({"node": frame["node"].iloc[at:at + len(part)].to_numpy(),
                                "shingles": [s.tobytes() for s in shingle_sets(part)]})


def _linked(x: bytes, y: bytes, t: tuple[int, int]) -> bool:
    a, b = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
    if min(len(a), len(b)) * t[1] < max(len(a), len(b)) * t[0]:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[k] == a).sum())
    return t[1] * both >= t[0] * (len(a) + len(b) - both)


def _links(pairs: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b`` that link, by their full sets."""
    @F.pandas_udf("boolean")
    def links(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_linked(p, q, t) for p, q in zip(x, y, strict=True)], dtype=bool)

    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return with_b.where(links("sa", "sb")).select("a", "b")


def _needed(a: Column, b: Column, t: tuple[int, int]) -> Column:
    return F.ceil((a + b) * t[0] / (t[0] + t[1]))


def _prefix(n: Column, t: tuple[int, int]) -> Column:
    return n - F.ceil(n * t[0] / t[1]) + 1


def _scan_cells(t: tuple[int, int]):
    """Links between left-over sets and members of one block of their list
    group: the members' inverted lists are scanned shingle by shingle, counting.
    Members tied to the group's head are connected already, so a left-over set
    reports one of them; other left-over sets are all reported."""
    def scan(probes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(probes) and len(members):
            arrays = [np.frombuffer(x, dtype=U64) for x in members["shingles"]]
            size = np.array([len(x) for x in arrays])
            tokens = np.concatenate(arrays)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], np.repeat(np.arange(len(arrays)), size)[order]
            node, tied = members["node"].to_numpy(), members["tied"].to_numpy(dtype=bool)
            for p in probes.itertuples(index=False):
                s = np.frombuffer(p.shingles, dtype=U64)
                lo, hi = np.searchsorted(tokens, s, "left"), np.searchsorted(tokens, s, "right")
                lists = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum())
                both = np.bincount(owner[lists], minlength=len(arrays))
                hit = t[1] * both >= t[0] * (len(s) + size - both)
                found += [(p.node, int(x)) for x in node[hit & tied][:1]]
                found += [(p.node, int(x)) for x in node[hit & ~tied & (node > p.node)]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return scan


def _frequent_links(entries: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Links among sets that share lists of frequent shingles (``entries``:
    ``node, n, typical, token``), enough of them to connect all that link."""
    heads = entries.groupBy("token").agg(F.max(F.struct("typical", "n", "node")).alias("h")) \
        .select("token", F.col("h.node").alias("head"), F.col("h.n").alias("head_n"))
    members = stored(entries.join(heads, "token").select("head", "head_n", "node", "n").distinct(), "op8-members")
    star = members.where(
        (F.col("node") != F.col("head")) & (F.least("n", "head_n") * t[1] >= F.greatest("n", "head_n") * t[0])) \
        .select(F.col("head").alias("a"), F.col("node").alias("b"))
    linked = stored(_links(star, sets, t), "op8-star")
    placed = members.join(linked.select(F.col("a").alias("head"), F.col("b").alias("node"), F.lit(True).alias("tied")),
                          ["head", "node"], "left") \
        .select("head", "node", F.coalesce("tied", F.col("head") == F.col("node")).alias("tied"))
    placed = stored(placed, "op8-placed")
    sizes = placed.groupBy("head").agg(F.count(F.lit(1)).alias("k"), F.count_if(~F.col("tied")).alias("rest")) \
        .where("rest > 0").select("head", F.ceil(F.col("k") / CELL).cast("int").alias("cells"),
                                  F.ceil(F.col("rest") / CELL).cast("int").alias("rest_cells"))
    full = placed.join(sizes, "head").join(sets, "node")
    cell = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    probes = full.where(~F.col("tied")).withColumn("p", cell("rest_cells")) \
        .withColumn("m", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    others = full.withColumn("m", cell("cells")) \
        .withColumn("p", F.explode(F.sequence(F.lit(0), F.col("rest_cells") - 1)))
    keys = ["head", "p", "m"]
    grouped = [side.select(*[F.col(c).alias(c) for c in (*keys, "node", "tied", "shingles")]).groupBy(*keys)
               for side in (probes, others)]
    found = grouped[0].cogroup(grouped[1]).applyInPandas(_scan_cells(t), "a long, b long")
    return linked.unionByName(found)


def _long_lists_moved(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the shingles of long lists under ``frequent``.

    Counts per batch miss a shingle that each batch holds once. So the lists
    that would be joined with themselves are counted exactly, over all sets,
    and those of more than LONG_LIST sets take the way of frequent shingles:
    no list gives more than LONG_LIST squared pairs. Each set keeps its prefix;
    only the way its shingles are looked up changes."""
    lists = nodes.select("node", F.explode("tokens").alias("token"))
    long = stored(lists.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > LONG_LIST)
                  .select("token"), "op8-long-lists")
    if long.isEmpty():
        return nodes
    moved = lists.join(long, "token").groupBy(F.col("node").alias("mover")).agg(F.collect_list("token").alias("moved"))
    with_moved = nodes.join(moved, F.col("node") == F.col("mover"), "left") \
        .withColumn("moved", F.coalesce("moved", F.array().cast("array<bigint>")))
    return stored(with_moved.select(
        "node", "n", "subsets", F.array_except("tokens", "moved").alias("tokens"),
        F.concat("frequent", "moved").alias("frequent"),
        (F.col("typical") + F.size("moved") / F.col("n")).alias("typical")), "op8-nodes")


def similar_documents(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id, n_shingles,
    component_id``.

    ``similarity`` (x, y) links sets when y * intersection >= x * union.
    ``component_id`` is the smallest doc_id reachable by links. A null text
    counts as empty; a document without words has no shingles and stands alone.
    Rows with the same id are one document of the join (linked if any of their
    texts links); a null id links with nothing and its component is null. An
    empty table gives an empty result. Other columns are not read.
    """
    t = similarity
    texts = docs.select("doc_id", "text")
    stats = stored(texts.select("text").mapInPandas(_batch_counts, "kind string, value long, docs long")
                   .groupBy("kind", "value").agg(F.sum("docs").alias("docs")).where(f"kind = 'size' or docs > {FREQUENT // 4}"),
                   "op8-counts")
    top = stats.where((F.col("kind") == "token") & (F.col("docs") > FREQUENT)) \
        .orderBy(F.desc("docs"), "value").limit(MAX_FREQUENT).select("value", "docs").toPandas()
    tokens, counts = top["value"].to_numpy(np.int64).view(U64), top["docs"].to_numpy(np.int64)
    order = np.argsort(tokens)
    sizes = {r.value: r.docs for r in stats.where("kind = 'size'").collect()}  # one row per size up to 24
    limit = small_limit(sizes, repeats=1.0, t=t)
    sets = stored(texts.mapInPandas(_set_rows(tokens[order], counts[order], limit, t), SETS), "op8-sets")
    light = sets.select("doc_id", "n", "class")
    classes = stored(light.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("node")), "op8-classes")

    nodes = stored(sets.join(classes.where("node is not null").withColumnRenamed("class", "k"),
                             (F.col("class") == F.col("k")) & (F.col("doc_id") == F.col("node")))
                   .dropDuplicates(["node", "class"])
                   .select("node", "n", "subsets", "tokens", "frequent", "typical"), "op8-nodes")
    nodes = _long_lists_moved(nodes)
    n_frequent = F.size("frequent").cast("bigint").alias("nf")
    entries = nodes.where(F.size("tokens") > 0).select("node", "n", n_frequent, F.explode("tokens").alias("token"))
    left = entries.select("token", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "nf")])
    right = entries.select("token", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "nf")])
    met = left.join(right, "token").where(
        (F.col("node_a") < F.col("node_b"))
        & (F.least("n_a", "n_b") * t[1] >= F.greatest("n_a", "n_b") * t[0]))
    met = met.groupBy("node_a", "node_b").agg(
        F.count(F.lit(1)).alias("shared"), *[F.max(c).alias(c) for c in ("n_a", "n_b", "nf_a", "nf_b")])
    outside = F.greatest(*[F.col(f"n_{s}") - _prefix(F.col(f"n_{s}"), t) + F.col(f"nf_{s}") for s in "ab"])
    met = met.where(F.col("shared") + outside >= _needed(F.col("n_a"), F.col("n_b"), t)) \
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    # All holders of one subset of size c whose sizes need no more than c shared
    # shingles link, so linking each to the first holder of every such size
    # connects them all.
    small = nodes.where(F.size("subsets") > 0).select("node", "n", F.explode("subsets").alias("subset"))
    heads = small.groupBy("subset", F.col("n").alias("m")).agg(F.min("node").alias("head"))
    same = small.join(heads, "subset").where(
        (F.col("node") != F.col("head"))
        & (F.col("subset").bitwiseAND(15) * (t[0] + t[1]) >= (F.col("n") + F.col("m")) * t[0])) \
        .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
    pairs = stored(met.unionByName(same).distinct(), "op8-pairs")

    hot = stored(nodes.where(F.size("frequent") > 0)
                 .select("node", "n", "typical", F.explode("frequent").alias("token")), "op8-frequent")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))) \
        .unionByName(hot.select("node")).distinct()
    # The wanted ids grow with the corpus, so they are never broadcast.
    full = stored(texts.join(wanted.hint("merge"), texts["doc_id"] == wanted["node"]).select("node", "text").distinct()
                  .mapInPandas(_full_sets, "node long, shingles binary"), "op8-full")
    links = stored(_links(pairs, full, t), "op8-links")
    if not hot.isEmpty():
        links = links.unionByName(_frequent_links(hot, full, t))
    groups = components(links, "a", "b")
    names = classes.join(groups, "node", "left").select("class", F.coalesce("component", "node").alias("component"))
    named = light.join(names, "class", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("doc_id").isNotNull(),
                               F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")))
                        .alias("component_id"))
