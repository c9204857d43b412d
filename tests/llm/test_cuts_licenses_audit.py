"""Fill-in-the-middle, licence scan and filter audit against plain Python."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("tessera.llm")
from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import fill_middle, filter_audit, license_scan  # noqa: E402

DOCS = "doc_id long, text string, lang string, fim string, scan string, part string, mask int"


def docs(spark, rows):
    """Rows (doc_id, text, lang), with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, lang, "f", "s", "p", 1) for i, t, lang in rows], DOCS)


# ---- fill in the middle


def test_skip_list_finds_every_rank():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 17, 400):
        widths = [rng.randrange(0, 50) for _ in range(n)]
        lanes = fill_middle.SkipList(widths)
        assert [lanes.offset(r) for r in range(n + 1)] == [sum(widths[:r]) for r in range(n + 1)]


def test_skip_list_walks_few_links():
    n = 200_000
    lanes = fill_middle.SkipList(np.full(n, 3))
    assert len(lanes.lanes) > 5
    assert [sum(units) for units, _, _ in lanes.lanes] == [n] * len(lanes.lanes)
    assert [sum(width) for _, width, _ in lanes.lanes] == [3 * n] * len(lanes.lanes)
    assert lanes.offset(123_457) == 3 * 123_457


TEXTS = [(1, "a\nb\n\nc", "en"), (2, "", "en"), (3, None, None), (4, "no line feed", "en"), (5, "\n", "en"),
         (6, "\n\n\n", "de"), (7, "é\n𝄞𝄞\nß", "de"), (8, "has <S> inside\nline", "en"), (9, "ends <\nS>\n<\nP>\n", "en"),
         (10, "\n".join(f"line {i}" for i in range(3000)), "en"), (10, "x\r\ny\rz\n", "en"), (None, "q\nr\n", "en"),
         (11, "w " * 100_000, "fr"), (1, "a\nb\n\nc", "en")]


def expected_cut(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    if not text or any(s in text for s in fill_middle.SENTINELS):
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < 50:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def test_fill_in_middle_equals_plain_python(spark):
    rows = TEXTS + [(100 + i, f"one {i}\ntwo\nthree\n", "en") for i in range(60)]
    frame = docs(spark, rows)
    out = fill_middle.fill_in_middle(frame)
    assert out.columns == [*frame.columns, "fim_"]
    got = out.withColumn("back", fill_middle.restored(F.col("fim_.output"), F.col("fim_.form"))).collect()
    assert Counter((r.doc_id, r.text, *r.fim_, r.back) for r in got) \
        == Counter((i, t, *expected_cut(i, t), t or "") for i, t, _ in rows)
    assert {r.fim_.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs(spark, [])).count() == 0


def test_rates_leave_documents_plain(spark):
    rows = [(i, "one\ntwo\n", "en") for i in range(200)]
    forms = Counter(r.fim.form for r in fill_middle.fill_in_middle(
        docs(spark, rows).select("doc_id", "text"), rate=40, spm_rate=0).collect())
    assert forms["spm"] == 0 and 50 < forms["psm"] < 110 and forms["plain"] + forms["psm"] == 200


# ---- licence scan


def words(text):
    low = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected_scan(text, passages=license_scan.PASSAGES):
    w = words(text)
    phrases = sorted((i, label) for phrase, label in license_scan.PHRASES.items()
                     for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())
    found = []
    for p in passages:
        own = p.text.split()
        keys = license_scan.key_places(own, p.key_phrases)
        for start in range(-len(own), len(w)):
            same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(own)]
            if sum(same) * 5 >= 4 * len(own) and all(same[k] for k in keys):
                found.append((start, p.label, sum(same) / len(own)))
    return len(w), phrases, sorted(found)


def license_rows():
    rng = random.Random(11)
    filler = "we thank all authors of the software and any person for notice of damages".split()
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            own = rng.choice(license_scan.PASSAGES).text.split()
            for _ in range(rng.randrange(0, max(1, len(own) // 4))):  # up to a quarter of the words wrong
                own[rng.randrange(len(own))] = rng.choice(filler)
            if rng.random() < 0.2:
                del own[rng.randrange(len(own))]
            parts += rng.choices(filler, k=rng.randrange(0, 30)) + own
        text = " ".join(parts)
        rows.append((i, text.upper() if i % 3 == 0 else text.replace(" software ", " software, // * "), "en"))
    return rows


ODD = [(500, None, "en"), (501, "", None), (502, "MIT License", "en"), (502, "MIT License", "en"),
       (503, "mit\n#license mit-license ªmit license", "en"), (None, "The GENERAL (public) license!", "en"),
       (504, "mit license " * 4000, "en"), (505, "general public", "en"), (506, "mit lİcense Apache License", "de"),
       (507, "apache license general public license mit", "en"), (508, "software " * 20_000, "en")]


def test_license_scan_equals_brute_force(spark):
    rows = license_rows() + ODD
    got = license_scan.scan_licenses(docs(spark, rows)).collect()
    want = {}
    for i, text, _ in rows:
        want[i] = expected_scan(text) if len(text or "") < 50_000 else None
    assert len(got) == len(rows)
    for r in got:
        if want[r.doc_id] is None:
            continue
        assert (r.n_words, [tuple(p) for p in r.phrases]) == want[r.doc_id][:2], r.doc_id
        assert sorted((p.start, p.label, round(p.share, 9)) for p in r.passages) \
            == [(s, label, round(x, 9)) for s, label, x in want[r.doc_id][2]], r.doc_id
    assert sum(len(r.passages) for r in got) > 100
    long = next(r for r in got if r.doc_id == 504)
    assert (long.n_words, len(long.phrases)) == (8000, 4000)


def test_counts_only_order_the_look_ups(spark):
    rows = license_rows()
    alone = [license_scan.scan_licenses(docs(spark, [row])).collect()[0] for row in rows[:3]]
    together = {r.doc_id: r for r in license_scan.scan_licenses(docs(spark, rows)).collect()}
    assert [together[r.doc_id] for r in alone] == alone
    assert license_scan.scan_licenses(docs(spark, [])).count() == 0


def test_word_counts_are_over_all_documents(spark):
    frame = docs(spark, [(i, "software " * i, "en") for i in range(20)] + ODD)
    assert license_scan.word_counts(frame, ["software", "mit", "nowhere"]) == {"software": 20, "mit": 6}


# ---- filter audit


def expected_audit(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    failed = []
    for i, text, lang in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and least[t] < i}
        failed.append((lang or "", {f for f, yes in fails.items() if yes}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                shapley[x] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(x in f[1] for f in own) - len(gone), sum(f[1] == {x} for f in own),
                    sum(f[2] for f in gone), sum(f[3] for f in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def audit_rows():
    rng = random.Random(3)
    rows = []
    for i in range(150):
        n = rng.choice([5, 99, 100, 130])
        vocabulary = [f"w{k}" for k in range(rng.choice([20, 1000]))]
        text = " ".join(rng.choice(vocabulary) for _ in range(n))
        text = text.upper() if rng.random() < 0.3 else text
        text += rng.choice(["", "", " #", " 50 %"])
        rows.append((i, text, rng.choice(["en", "de", None, ""])))
    rows += [(1000 + k, rows[k % 7][1], rows[k][2]) for k in range(40)]
    rows += [(5, "copy", "en"), (5, "copy", "en"), (5, "copy", "de"), (4, "copy", "fr"), (None, "copy", "en"),
             (None, "copy", "en"), (None, "only here", "en"), (2000, None, "en"), (2001, "", "en"), (2002, None, None)]
    return rows


LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 150, 3)] + [(1003, 1, None), (1004, None, 1), (None, 1, 1),
                                                                    (6, 0, 0), (6, 1, 0), (1003, 1, None)]


def test_audit_equals_plain_python(spark):
    rows = audit_rows()
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, text string")
    got = filter_audit.audit(docs(spark, rows).repartition(5), labels).collect()
    want = expected_audit(rows, LABELS)
    assert {(r.part, r.filter_order, r.step): [r[c] for c in filter_audit.COUNTS] for r in got} == want
    assert len(got) == len(want) == 600 * len({lang or "" for _, _, lang in rows})


def test_audit_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs(spark, []), none).count() == 0
    rows = [(1, None, None), (2, "", None)]
    got = filter_audit.audit(docs(spark, rows), none).collect()
    assert {(r.part, r.filter_order, r.step): [r[c] for c in filter_audit.COUNTS] for r in got} \
        == expected_audit(rows, [])


def test_min_plus_steps():
    position = filter_audit.positions()
    steps = filter_audit.removal_steps(np.arange(32), position)
    for mask in range(32):
        for k, order in enumerate(filter_audit.ORDERS):
            first = [i for i, f in enumerate(order) if mask >> "ABCDE".index(f) & 1]
            assert steps[mask, k] == (first[0] if first else np.inf)


def test_one_text_in_a_third_of_all_rows_leaves_tasks_as_few_rows(spark):
    frame = docs(spark, [(i, "same text" if i % 3 == 0 else f"text {i}", "en") for i in range(900)]).repartition(4)
    counted = filter_audit.mask_counts(frame, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["mask"]: r["n"] for r in counted.where("n > 0").collect()} == {1: 601, 17: 299}
