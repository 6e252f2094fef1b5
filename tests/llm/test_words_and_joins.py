"""Word hashes, components and the n-gram Jaccard join against plain Python."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daybook.llm.components import connected_components
from daybook.llm.ngram_join import _planes, _records, jaccard_classes, one_of_each
from daybook.llm.words import column_shingles, text_slices, word_hashes


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j, same in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * same >= 75 * (len(s) + len(sets[j]) - same):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def random_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice("abAB \n\té\x0b\x1c") for _ in range(draw.randrange(60))) for _ in range(n)]


def test_shingles_match_python():
    texts = [None, "", " ", "a", "A b", "x\x0by\x1cz é É", "\n\na b c d e f", "abcdefghijklmnopqrstu v", *random_texts(300, 1)]
    column = pa.array(texts)
    got, want = list(column_shingles(column)), [shingle_set(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(0, 300, 7):
        for j in range(0, 300, 11):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])
    assert [len(g) for g in column_shingles(column.slice(5, 20))] == [len(w) for w in want[5:25]]


def test_word_spans_and_slices():
    long = "word " * 1_000_000
    parts = list(text_slices(pa.array(["a", long, None, "b c"])))
    assert [p[0] for p in parts] == sorted(p[0] for p in parts) and parts[0][0] == 0
    h, a, b, firsts = word_hashes(*parts[-1][1:])
    assert firsts[-1] - firsts[-2] == 2 and (b > a).all() and len(h) == firsts[-1]


def test_byte_planes_round_trip():
    rows = np.array([(1, -2), (2**40, 7)], dtype=[("a", "<i8"), ("b", "<i4")])
    assert (_records(_planes(rows), rows.dtype) == rows).all()


def test_components(spark):
    draw = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, 200 + i) for i in range(1, 60)]
    mixed = [(draw.randrange(300, 360), draw.randrange(300, 360)) for _ in range(40)]
    edges = chain + star + mixed + [(5, 5)]
    parent = {x: x for e in edges for x in e}
    for _ in range(len(parent)):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(df).collect()}
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in parent.items() if k not in loops}
    assert connected_components(df.limit(0)).count() == 0


def near_copies(seed=3):
    """Copies at all distances around the limit, large groups, common passages, and texts of few words."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    words = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    texts = []
    for _ in range(12):
        base = words(draw.randrange(3, 120))
        texts.append(base)
        for _ in range(draw.randrange(1, 25)):
            copy = list(base)
            for _ in range(draw.randrange(0, 1 + len(base) // 12)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(copy[draw.randrange(0, 4) :] + words(draw.randrange(0, 6)))
    passage = words(60)
    texts += [words(draw.randrange(0, 60)) + passage + words(draw.randrange(0, 60)) for _ in range(40)]
    texts += [words(k) for k in (1, 2, 3, 4, 5, 6)] * 2 + [["w1"], ["W1"], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(len(rows) + i, t) for i, t in enumerate((None, "", " \n", rows[0][1], rows[0][1].upper()))]


def test_classes_match_brute_force(docs):
    rows = near_copies()
    got = jaccard_classes(docs([(i, t, "s") for i, t in rows]))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_classes(rows)


def test_local_stars_lose_nothing(docs, monkeypatch):
    """With tiny limits every column is combined in the map task and every product cut into pieces."""
    import daybook.llm.ngram_join as join

    for name, value in (("LOCAL_ROWS", 3), ("PACK_POSTINGS", 500), ("BLOCK_POSTINGS", 300), ("PRODUCT_POSTINGS", 500), ("PRODUCT_CELLS", 50)):
        monkeypatch.setattr(join, name, value)
    rows = near_copies(8)
    got = jaccard_classes(docs([(i, t, "s") for i, t in rows]).repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {k: v[1] for k, v in brute_classes(rows).items()}


def test_classes_of_odd_rows(docs):
    text = "one two three four five six seven eight"
    rows = [(7, text, None), (7, text, None), (3, text, "a"), (None, text, "a"), (None, None, None), (9, None, None), (4, "other words stand here", "a")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_classes(docs(rows)).collect()), key=str)
    assert got == sorted([(7, 4, 3), (7, 4, 3), (3, 4, 3), (None, 4, None), (None, 0, None), (9, 0, 9), (4, 1, 4)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in one_of_each(docs(rows)).collect()), key=str)
    assert kept == sorted([(3, text), (None, text), (None, None), (9, None), (4, "other words stand here")], key=str)
    assert jaccard_classes(docs([]), "doc_id").count() == 0 and one_of_each(docs([])).count() == 0


def test_one_of_each_keeps_columns_and_single_copies(docs):
    text = "a b c d e f g h i j k l m n o p"
    frame = docs([(5, text, "s"), (5, text, "s"), (5, text + " q", "s"), (6, text, "t")])
    out = one_of_each(frame)
    assert out.columns == frame.columns and out.count() == 1 and out.select(F.max("doc_id")).first()[0] == 5


def test_overlaps_cut_into_parts_are_whole(spark, monkeypatch):
    """Few lookups at once: a pair that reaches its bound only over several parts is not lost."""
    import daybook.llm.ngram_join as join

    monkeypatch.setattr(join, "PRODUCT_CELLS", 7)
    rows = [(i, t) for i, t in near_copies(4) if shingle_set(t)]
    sets = {i: shingle_set(t) for i, t in rows}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    reps = join._rows(frame, "doc_id", "text", join.column_sketch(frame, "text")).withColumnRenamed("doc_id", "rep")
    held = reps.collect()  # here, since a worker would not see the changed limit
    p = join._postings([r["rep"] for r in held], [r["n"] for r in held], [bytes(r["prefix"]) for r in held], comps=[r["rep"] for r in held])
    pairs = {(int(r["a"]), int(r["b"])) for r in join._products(p, p, True)}
    linked = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(linked) > 100 and linked <= pairs


def test_a_frequent_column_is_dealt_out_and_copies_are_not_expanded(spark, monkeypatch):
    """Linked rows with one foreign row in their column cost a lookup each; a frequent column goes to many tiles."""
    import daybook.llm.ngram_join as join

    n = 3000
    p = np.zeros(n + 1, dtype=join._POSTING)
    p["col"], p["id"], p["n"], p["comp"] = 5, np.arange(n + 1), 20, 1
    for foreign in (0, 2):
        p["comp"][n] = foreign
        assert join._foreign(p, p[np.lexsort((p["comp"], p["col"]))], True)[2].sum() == n
    p["comp"] = p["id"]
    sent = list(join._tiles(p, 4))
    tiles = np.concatenate([tile for _, tile in sent])
    assert len(set(tiles.tolist())) == 10 and np.bincount(tiles).max() < 0.6 * n
    for name, value in (("HOT_ROWS", 5), ("TILE_CELLS", 300), ("PACK_POSTINGS", 400)):
        monkeypatch.setattr(join, name, value)
    rows = near_copies(8)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard_classes(frame).collect()} == {k: v[1] for k, v in brute_classes(rows).items()}
