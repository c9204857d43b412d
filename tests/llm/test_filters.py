"""Dedup, mixing, sharding and packing on small hand-made tables."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("tessera.llm")
from tessera.llm import exact_dedup, line_dedup, mixing, packing, sharding  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, key string"


def docs(spark, rows):
    """Rows (doc_id, text, source), with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows], DOCS)


ODD = [(1, None, "b"), (2, "", "a"), (3, " \t\n", None), (4, "one two  three", "a"), (4, "one two  three", "a"),
       (5, "onetwothree", "b"), (6, "x " * 3000, "b"), (None, "no id at all", None), (7, "one two  three ", "a")]


def test_exact_dedup_keeps_the_longest_then_the_smallest_id(spark):
    out = exact_dedup.exact_dedup(docs(spark, ODD)).collect()
    assert len(out) == len(ODD)
    by_id = {r.doc_id: r for r in out}
    assert by_id[5].keep_id == by_id[4].keep_id == by_id[7].keep_id == 7 and by_id[7].group_size == 4
    assert by_id[1].keep_id == 3 and by_id[1].group_size == 3  # the blank text is the longest empty one
    assert by_id[None].kept and by_id[None].group_size == 1
    assert sum(r.kept for r in out) == 4
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


def test_mix_takes_the_budget_to_the_word(spark):
    rows = [(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(300)] + ODD
    frame = docs(spark, rows)
    out = mixing.mix(frame).collect()
    assert len(out) == len(rows)
    total = defaultdict(int)
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"]
        total[r.source, r.target] += r.taken
    assert all(target - 1 < taken <= target for (_, target), taken in total.items())
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(frame.repartition(5)).collect()))
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert words == sum(r.taken for r in out)
    assert mixing.mix(docs(spark, [])).count() == 0


def test_targets_stop_at_three_epochs(spark):
    out = mixing.mix(docs(spark, [(1, "w", "a"), (2, "w " * 10, "b"), (3, "w " * 100, "c")])).collect()
    target = {r.source: r.target for r in out}
    assert target["a"] == 3 and target["b"] == 30 and target["c"] == pytest.approx(111 - 33)


def test_shards_are_gapless_and_only_the_new_one_gains(spark):
    rows = [(i, "é" * (i % 5), "a") for i in range(100, 600)] + ODD
    out = sharding.shard_documents(docs(spark, rows)).collect()
    slots = defaultdict(list)
    text = {i: (t or "") for i, t, _ in rows}
    for r in out:
        raw = text[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    moved = sum(r.grown_shard == 24 for r in out)
    assert 0 < moved < len(out) / 10
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_shards_equal_a_plain_rendezvous(spark):
    rows = [(i, "é" * (i % 5), "a") for i in range(300)] + ODD
    out = sharding.shard_documents(docs(spark, rows)).collect()

    def score(shard, doc_id):
        text = f"{shard}:{'' if doc_id is None else doc_id}"
        return -math.log((int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 1) / (1 << 52))

    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    for r in out:
        best = min(range(24), key=lambda s: (score(s, r.doc_id), s))
        assert r.shard == best and (r["size"], r.text_crc32) in texts[r.doc_id]
        assert r.grown_shard == min(range(25), key=lambda s: (score(s, r.doc_id), s))


def test_weighted_shards_follow_their_weights(spark):
    out = sharding.shard_documents(docs(spark, [(i, "t", "a") for i in range(4000)]), weights=(1.0, 3.0))
    share = out.where("shard = 1").count() / 4000
    assert 0.7 < share < 0.8


def test_repeated_chunks_stay_once(spark):
    run = "\n".join(f"shared line {i}" for i in range(40))
    rows = [(1, "start\n" + run, "a"), (2, run + "\nother end", "a"), (3, "only\nhere", "a"),
            (4, None, "a"), (5, "", "a"), (6, "single shared", "a"), (7, "single shared", "a"), (None, run, "b")]
    out = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows)).collect()}
    assert out[3].text == "only\nhere" and out[4].text is None and out[5].text == ""
    assert out[6].text == out[7].text == "single shared"
    # The null id comes first, so it keeps the run; the others lose it whole.
    assert out[None].text == run
    assert out[1].text == "start" and out[1].dedup.chars_before == len(rows[0][1])
    assert out[2].text == "other end" and out[2].dedup.removed_lines == 40 and out[2].dedup.removed_runs == 1
    assert out[1].n_chars == len(out[1].text)
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0


def test_chunks_join_back_to_the_text(spark):
    texts = ["a\n\nb\n", "\n\n\n", "x", "\n".join(map(str, range(500))), "same\n" * 300]
    frame = docs(spark, [(i, t, "a") for i, t in enumerate(texts)])
    from pyspark.sql import functions as F
    for below in ("4", "8", "g"):
        lines = F.split("text", "\n", -1)
        chunks = line_dedup.line_chunks(lines, below)
        back = frame.select("text", F.array_join(F.flatten(F.transform(
            chunks, lambda c: F.slice(lines, c["start"], c["n"]))), "\n").alias("back"))
        assert all(r.text == r.back for r in back.collect())


def brute_force_dedup(rows, min_words=line_dedup.MIN_DISTINCT_WORDS):
    """Line by line: the texts of ``rows`` (id, text) without repeated runs."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        repeated = [k for k in range(len(lines) - 1) if (lines[k], lines[k + 1]) in seen
                    or (lines[k], lines[k + 1]) in set(zip(lines[:k], lines[1:k + 1]))]
        seen |= set(zip(lines, lines[1:]))
        gone, k = set(), 0
        while k < len(repeated):
            end = k
            while end + 1 < len(repeated) and repeated[end + 1] == repeated[end] + 1:
                end += 1
            run = range(repeated[k], repeated[end] + 2)
            if len({w for x in run for w in lines[x].split(" ") if w}) >= min_words:
                gone |= set(run)
            k = end + 1
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("opens_below", ["1", "4", "g"])
def test_line_dedup_equals_brute_force(spark, opens_below):
    rng = np.random.default_rng(9)
    pool = [*[f"line {k} of the pool with words" for k in range(25)], "}", "", "    return x", "}", ""]
    passages = [[pool[int(k)] for k in rng.integers(0, 30, int(rng.integers(2, 12)))] for _ in range(12)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(int(rng.integers(1, 5))):
            lines += [f"own {i} {k}" for k in range(int(rng.integers(0, 3)))] + passages[int(rng.integers(0, 12))]
            lines += [pool[int(k)] for k in rng.integers(0, 30, int(rng.integers(0, 4)))]
        rows.append((i, "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "}\n}\n}\n}"), (1003, "}\n}\n}\n}"), (1004, "\n\n\n")]
    want = brute_force_dedup(rows)
    out = line_dedup.line_dedup(docs(spark, [(i, t, "a") for i, t in rows]), opens_below=opens_below).collect()
    assert {r.doc_id: r.text or "" for r in out} == want
    assert sum(r.dedup.removed_lines for r in out) > 300


def test_runs_with_little_in_them_stay(spark):
    rows = [(1, "def c():\n    y = 3\n    return x\n\n\ndef d():\n    return 2\n", "a"),
            (2, "def e():\n    z = 4\n    return x\n\n\ndef f():\n    return 5\n}\n}", "a"), (3, "g\n}\n}", "a")]
    out = line_dedup.line_dedup(docs(spark, rows)).collect()
    assert {(r.doc_id, r.text) for r in out} == {(i, t) for i, t, _ in rows}
    heavier = line_dedup.line_dedup(docs(spark, rows), min_words=1).collect()
    assert any(r.dedup.removed_lines for r in heavier)


def test_removed_lines_stand_at_an_earlier_place(spark):
    rng = np.random.default_rng(4)
    passages = [[f"p{k} {i} some more words" for i in range(n)] for k, n in enumerate((2, 3, 4, 6, 9) * 6)]
    rows = []
    for i in range(200):
        own = [f"own {i} {k}" for k in range(int(rng.integers(0, 6)))]
        at = int(rng.integers(0, len(own) + 1))
        rows.append((i, "\n".join(own[:at] + passages[int(rng.integers(0, 30))] + own[at:]), "a"))
    out = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows)).collect()}
    seen, gone, repeats = set(), 0, 0
    for i, text, _ in rows:
        before, after = text.split("\n"), out[i].text.split("\n") if out[i].text else []
        assert [x for x in before if x in after] == after  # an order-keeping part
        lost = set(before) - set(after)
        assert lost <= seen and len(lost) == out[i].dedup.removed_lines and out[i].dedup.n_lines == len(before)
        assert not any(x.startswith("own") for x in lost)
        gone, repeats = gone + len(lost), repeats + len([x for x in before if x in seen])
        seen |= set(after)
    assert gone == repeats


def test_passages_go_whole_whatever_stands_around(spark):
    rows = [(i, "\n".join([f"before {i}", *[f"passage {n} {k} with more words" for k in range(n)], f"after {i}"]), "a")
            for n in (2, 3, 4, 6, 9) for i in range(100 * n, 100 * n + 8)]
    out = line_dedup.line_dedup(docs(spark, rows)).collect()
    for r in out:
        if r.doc_id % 100:
            assert r.text == f"before {r.doc_id}\nafter {r.doc_id}"
        else:
            assert r.dedup.removed_lines == 0


def packed_ok(rows, out):
    """Every token once, crc and places as by the other library, no padding."""
    import public_tokenizers
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(tk.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4") for i, t, _ in rows}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in out:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    ends = {}
    for name, spans in (("doc", pieces), ("sequence", places)):
        for k, v in spans.items():
            at = 0
            for start, n in sorted(v):
                assert start == at
                at += n
            ends[name, k] = at
    assert set(pieces) == set(ids) and all(ends["doc", i] == len(x) for i, x in ids.items())
    assert all(n <= 1024 and n & (n - 1) == 0 or n == 1024 for (kind, _), n in ends.items() if kind == "sequence")


def test_packing_places_each_token_once(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["word"] * int(n)), "a") for i, n in enumerate(rng.integers(0, 3000, 150))]
    rows += [(1000, None, "a"), (1001, "a <|endoftext|> b", "a"), (1002, "x" * 20000, "a"),
             (1003, "日本語 \U0001F600 ǅ \x00\x0b", "a"), (None, "no id", "a")]
    packed_ok(rows, packing.pack(docs(spark, rows)).collect())
    assert packing.pack(docs(spark, [])).count() == 0


def test_pattern_counts_never_exceed_the_histogram():
    histogram = {100: 50, 924: 49, 512: 7, 300: 20, 424: 31}
    patterns = packing.window_patterns(sorted(histogram))
    assert (100, 924) in patterns and (512,) in patterns and (300, 300, 424) in patterns
    x = packing.nnls_counts(patterns, histogram)
    assert min(x) >= 0
    plan = packing.make_plan(histogram, {})
    assert all(plan.used[n] <= c for n, c in histogram.items())
    seen = set()
    for n, c in histogram.items():
        for rank in range(c):
            for _, length, sequence, offset in plan.tail_place(n, rank):
                span = {(sequence, offset + k) for k in range(length)}
                assert not span & seen
                seen |= span
    assert len(seen) == sum(n * c for n, c in histogram.items())
