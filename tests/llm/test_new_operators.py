"""Exact search, periodic runs and the filter audit against brute force and on odd rows."""

import hashlib
import math
import zlib
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

from lingofold.llm import filter_audit, periodic_runs, vector_topk

VECTORS = "vec_id long, embedding array<double>, score string, rank int, query_id long"


def brute_top_k(rows, k=10, every=100):
    usable = []
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(1024 * x) for x in v]
        if sum(x * x for x in whole) < 2**62:
            usable.append((i, whole))
    queries = {}
    for i, v in usable:
        if i is not None and i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        found = [
            (-sum(a * b for a, b in zip(v, w)), i is None, i) for i, w in usable if i != q and len(w) == len(v)
        ]
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(q, n + 1, i, -s) for n, (s, _, i) in enumerate(found[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)


def search(spark, rows, **options):
    vectors = frame(spark, rows)
    got = vector_topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=24)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]  # ties with the k-th best
    rows += [(7, rows[7][1]), (200, rows[3][1]), (None, rows[7][1]), (None, rows[7][1]), (None, rows[0][1])]
    want = brute_top_k(rows)
    assert search(spark, rows) == want
    assert search(spark, rows, group_bytes=2000) == want  # several passes


def test_top_k_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [0.5, -0.25]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, []), (100, []), (200, [3.0]), (300, None), (400, [nan, 0.0]), (7, [1e300, 1.0]), (8, [2e9 / 1024, 0.0]),
        (500, [1e18, 0.0]), (600, [1.9e9 / 1024, -1.5e9 / 1024]), (9, [1.7e9 / 1024, 1.1e9 / 1024]), (None, [1.0, 2.0]),
        (-100, [-1.0, 0.001]), (10, [1.0, 2.0, 3.0]),
    ]
    assert search(spark, rows) == brute_top_k(rows)
    assert search(spark, rows[6:7]) == [] and search(spark, []) == []


def test_top_k_drops_pairs_before_the_last_component():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 64))
    matrix = np.floor(1024 * np.repeat(centres, 100, axis=0) + 100 * rng.normal(size=(2000, 64)))
    ids = np.arange(2000)
    block = vector_topk.QueryBlock(ids[::100], np.ascontiguousarray(matrix[::100].T), np.full(20, -np.inf), 10)
    block.meet(ids, np.zeros(2000, dtype=bool), np.ascontiguousarray(matrix.T))
    assert block.pairs == 40_000 and block.finished < 0.2 * block.pairs
    q, score, found, _ = block.best
    full = (matrix[::100] @ matrix.T).astype(np.int64)
    for number in range(20):
        full[number, number * 100] = -(2**62)
        order = sorted(range(2000), key=lambda c: (-full[number, c], c))[:10]
        assert found[q == number].tolist() == order and score[q == number].tolist() == full[number, order].tolist()


def brute_runs(words):
    n, out = len(words), []
    for period in range(1, n // 4 + 1):
        start = 0
        while start + period < n:
            if words[start] != words[start + period]:
                start += 1
                continue
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            stretch = (start, end + period - start, period)
            if stretch[1] >= max(6, 4 * period) and not any(s == stretch[0] and k == stretch[1] for s, k, _ in out):
                out.append(stretch)
            start = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), *best, runs and best[1] * 1000 // best[2] or None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def digests(docs):
    return [tuple(r) for r in periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.planted(docs))).collect()]


def test_runs_equal_brute_force(make_docs, odd_rows):
    rng = np.random.default_rng(11)
    rows = list(odd_rows)
    for i in range(300):
        letters = rng.integers(1, 4)
        words = [f"w{x}" for x in rng.integers(0, letters, rng.integers(0, 60))]
        while rng.random() < 0.6:
            piece = [f"w{x}" for x in rng.integers(0, letters + 2, rng.integers(1, 9))]
            words += piece * int(rng.integers(3, 8)) + piece[: rng.integers(0, len(piece))]
        rows.append((100 + i, "  ".join(words), "a"))
    rows.append((1000, "a b a b a b a b  a\tb " * 300 + "c " * 5 + "d " * 6, "a"))
    got = digests(make_docs(rows))
    want = [brute_digest(i, t) for i, t, _ in rows]
    assert Counter(got) == Counter(want)
    assert sum(1 for w in want if w[1] > 1) > 100
    assert digests(make_docs([])) == []


def test_runs_of_a_very_long_text():
    unit = [f"u{i}".encode() for i in range(5000)]
    text = b" ".join([b"x"] * 40_000 + unit * 6 + [b"y"])
    (words, runs, kept), = periodic_runs._runs_of_texts([text])
    assert words == 70_001 and runs == [(0, 40_000, 1), (40_000, 30_000, 5000)]
    assert kept == b" ".join([b"x", *unit, b"y"])


@pytest.mark.parametrize("letters", [1, 2, 5, 400])
def test_extensions_equal_direct_comparison(letters):
    rng = np.random.default_rng(letters)
    codes = np.append(np.tile(rng.integers(0, letters, 37), 9), rng.integers(0, letters, 200))
    lce = periodic_runs.CoverExtension(codes)
    left, right = rng.integers(0, len(codes) + 1, (2, 3000))
    left, right = left[left != right], right[left != right]

    def direct(a, b):
        k = 0
        while max(a, b) + k < len(codes) and codes[a + k] == codes[b + k]:
            k += 1
        return k

    assert lce.extend(left, right).tolist() == [direct(a, b) for a, b in zip(left, right)]


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > least[text],
        }
        rows.append((part or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            whole = list(left)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in whole if f in r[1]]
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in whole),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row[1]
    return {(*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def audit_case(spark, docs, labels):
    frame = spark.createDataFrame(
        [(i, t, p, 1, 2, "x", "y") for i, t, p in docs],
        "doc_id long, text string, lang string, mask int, n long, part string, good string",
    )
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    return [tuple(r) for r in filter_audit.audit_filters(frame, marks).collect()]


def test_audit_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    docs = []
    for i in range(200):
        size = int(rng.choice([5, 99, 100, 130]))
        words = [f"w{x}" for x in rng.integers(0, rng.choice([40, 4000]), size)]
        if rng.random() < 0.3:
            words = [w.upper() + "AB" for w in words]
        if rng.random() < 0.2:
            words.append("50%")
        docs.append((i, " ".join(words), str(rng.choice(["en", "de"]))))
    docs += [(int(rng.integers(-20, 400)), docs[k][1], "fr") for k in rng.integers(0, 12, 90)]
    docs += [(900, None, None), (901, "", ""), (902, " \n", None), (None, docs[0][1], "en"), (None, None, "de")]
    docs += [docs[3], docs[3], (5000, "LONG words " * 30_000, "en"), (5001, "LONG words " * 30_000, "zz"), (-50, docs[3][1], "en")]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 300, 2)]
    labels += [(4, 1, None), (4, 0, 1), (8, None, None), (None, 1, 1), (7777, 1, 1), (3, 1, 0), (3, 1, 0)]
    got = audit_case(spark, docs, labels)
    assert len(got) == len(set(got)) == 600 * 5
    assert set(got) == brute_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    assert audit_case(spark, [], [(1, 1, 1)]) == []
    assert set(audit_case(spark, [(1, "a", "x")], [])) == brute_audit([(1, "a", "x")], [])
