"""Periodic runs against plain Python, the synchronising sets against their definition."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm.periodic import _doubled, _text_runs, find_runs, longest_run, periodic_runs, runs_digest, synchronising_set
from daybook.llm.queries import op13_periodic_runs, planted_order
from daybook.llm.words import mix64


def brute_runs(w):
    """Every run by the definition: all periods, smallest first, maximal stretches."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, p) for (s, e), p in found.items()), key=lambda x: (x[0], x[2]))


def brute_collapse(words, runs):
    gone = {i for s, e, p in runs for i in range(s + p, e)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


def random_words(draw):
    """Words with nested, touching and overlapping repeats of many periods."""
    words = []
    while len(words) < draw.choice((5, 40, 400)):
        kind = draw.random()
        if kind < 0.4:
            words += [draw.choice("abc") for _ in range(draw.randrange(1, 30))]
        elif kind < 0.8:
            unit = [draw.choice("abcdefgh") for _ in range(draw.choice((1, 2, 3, 5, 6, 7, 8, 11, 16, 21, 40)))]
            words += (unit * 12)[: int(len(unit) * draw.uniform(2, 9))]
        else:
            inner = [draw.choice("xy") for _ in range(draw.randrange(1, 4))] * draw.randrange(3, 9)
            words += (inner + [draw.choice("pq")]) * draw.randrange(2, 7)
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_match_brute_force(seed):
    words = random_words(random.Random(seed))
    h = mix64(np.array([ord(x) for x in words], dtype=np.uint64))
    assert find_runs(h) == brute_runs(words)


def test_long_periods_and_one_word():
    draw = random.Random(5)
    for p in (7, 9, 31, 32, 33, 127, 500, 1023):
        unit = [draw.randrange(10**9) for _ in range(p)]
        lead = [draw.randrange(10**9) for _ in range(draw.randrange(40))]
        words = lead + (unit * 5)[: 4 * p + draw.randrange(p)] + lead[::-1]
        assert find_runs(mix64(np.array(words, dtype=np.uint64))) == brute_runs(words)
    assert find_runs(np.full(100_000, 7, dtype=np.uint64)) == [(0, 100_000, 1)]
    nested = (["a"] * 50 + ["b"]) * 60  # runs of one word inside a run of 51
    assert len(brute_runs(nested)) == 61
    assert find_runs(mix64(np.array([ord(x) for x in nested], dtype=np.uint64))) == brute_runs(nested)


def test_synchronising_sets_are_consistent_and_dense():
    draw = random.Random(3)
    w = mix64(np.array([draw.randrange(3) for _ in range(3000)], dtype=np.uint64))
    for t in (2, 4, 8):
        h, width = w, 1
        while width < t:
            h, width = _doubled(h, width), 2 * width
        inside = set(synchronising_set(h, t).tolist())
        seen = {}
        for i in range(len(w) - 2 * t + 1):  # equal contexts agree
            assert seen.setdefault(w[i : i + 2 * t].tobytes(), i in inside) == (i in inside)
        for i in range(len(w) - 3 * t + 2):  # every t positions hold one
            assert any(j in inside for j in range(i, i + t))


def test_texts_of_a_slice_do_not_meet():
    texts = ["a b " * 2, "a b " * 2, "a b " * 3, None, "", "x", "a b " * 3 + "a", "\x1c é é é é é é\n"]
    got = list(_text_runs(pa.array(texts), list(range(8)), None))
    assert [len(g[1]) for g in got] == [0, 0, 0, 0, 0, 0, 0, 1]
    assert got[7] == (7, [{"start": 1, "length": 6, "period": 1}], "\x1c é".encode())
    assert list(_text_runs(pa.array(["a b " * 4]), [0], None)) == [(8, [{"start": 0, "length": 8, "period": 2}], b"a b")]


def test_operator_on_odd_rows(docs):
    long = "one two three four five six seven " * 40_000
    rows = [(1, None, "s"), (2, "", None), (3, "go go go go go go", "s"), (3, "go go go go go go", "s"), (None, "z z z z z", "s"), (4, long, "s")]
    out = periodic_runs(docs(rows))
    got = sorted(((r[0] or 0, r[1], [tuple(x) for x in r[2]], r[3]) for r in out.collect()), key=str)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 6, [(0, 6, 1)], "go"), (3, 6, [(0, 6, 1)], "go"),
        (0, 5, [], "z z z z z"), (4, 280_000, [(0, 280_000, 7)], "one two three four five six seven"),
    ], key=str)
    assert periodic_runs(docs([])).count() == 0
    best = out.where("doc_id = 4").select(longest_run(F.col("runs")).alias("b"), runs_digest(F.col("runs")).alias("d")).first()
    assert tuple(best["b"]) == (0, 280_000, 7)
    none = out.where("doc_id = 1").select(longest_run(F.col("runs")).alias("b"), runs_digest(F.col("runs")).alias("d")).first()
    assert none["b"] is None and none["d"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_query_matches_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == documents.count()
    for r in documents.collect():
        words = [x.decode() for x in (r["text"] or "").encode().split()]
        places = planted_order(r["doc_id"], len(words))
        words = words if places is None else [words[i] for i in places]
        runs = brute_runs(words) if len(words) < 2500 else None
        g = got[r["doc_id"]]
        if runs is None:
            continue
        import hashlib

        lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs)
        assert (g["n_runs"], g["runs_sha256"]) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert g["collapsed_sha256"] == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
        if runs:
            s, e, p = min(runs, key=lambda x: (x[0] - x[1], x[0], x[2]))
            assert (g["start"], g["length"], g["period"], g["exponent_milli"]) == (s, e - s, p, 1000 * (e - s) // p)
        else:
            assert g["start"] is None and g["exponent_milli"] is None
