"""Quality rules and source mixing against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from daybook.llm.mixing import mix, schedule, sized, targets, with_blocks
from daybook.llm.quality import keep_good, quality_rules
from daybook.llm.tables import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_counts_match_python(documents, docs):
    odd = [(1, None, "a"), (2, "", "a"), (3, " \n\x0b\n", None), (4, "é ü\nA\nA\r\nA\n\nA", "a"), (5, "x y z x y z x y", "b"), (6, "a\nb\n" * 9, "b"), (None, "a b c", None)]
    for rows, frame in ((documents.select("doc_id", "text").collect(), documents), ([(a, b) for a, b, _ in odd], docs(odd))):
        got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in quality_rules(frame).collect()}
        assert got == {i: base_counts(t) for i, t in rows}
        failed = {r["doc_id"]: r["base_failed"] for r in quality_rules(frame).collect()}
        assert failed == {i: c[0] < 50 or 100 * c[4] > 50 * c[0] for i, c in ((i, base_counts(t)) for i, t in rows)}


def letters(n):
    """Digits count as equal in normalised lines, so numbers are spelled with letters."""
    return "".join(chr(97 + int(c)) for c in str(n))


def common_rows():
    body = lambda i: " ".join(f"d{letters(i)}w{letters(k)}" for k in range(60))
    banner = "Read  THE rules 2024 " * 1
    rows = [(i, f"{body(i)}\n{banner if i % 2 else banner.lower().replace('2024', '1999')}", "hot") for i in range(30)]
    # Copies of one document: its lines are in many rows, but in one distinct document.
    rows += [(100 + i, body(1000) + "\n" + body(1001), "hot") for i in range(40)]
    rows += [(200, banner * 30 + "\n" + " ".join(f"z{letters(k)}" for k in range(55)), "hot"), (300, f"{body(7)}\n{banner}", "cold")]
    # Twenty common lines, four in each of many documents, and one document that mostly consists of them.
    line = lambda k: f"Common line {letters(k % 20)} here"
    rows += [(500 + i, "\n".join([body(500 + i), *(line(4 * i + j) for j in range(4))]), "hot") for i in range(150)]
    rows += [(400, "\n".join([line(k) for k in range(20)] + [body(9)]), "hot")]
    return rows


def test_lines_above_the_limit(docs):
    got = {r["doc_id"]: r for r in quality_rules(docs(common_rows())).collect()}
    assert all(got[i]["n_removed"] == 4 and got[i]["kept"] for i in range(30))
    assert all(got[100 + i]["n_removed"] == 0 and got[100 + i]["kept"] for i in range(40))
    assert got[300]["n_removed"] == 0  # another host
    assert got[400]["n_removed"] == 80 and got[400]["n_words"] == 140 and not got[400]["kept"] and not got[400]["base_failed"]


def test_documents_of_common_lines_count_one_by_one(docs):
    """Ninety documents that are mostly one block, and twenty orders of the block's lines alone: all are rejected."""
    block = [" ".join(f"b{letters(10 * k + j)}" for j in range(6)) for k in range(15)]
    rows = [(i, "\n".join([*block, " ".join(f"own{letters(i)}x{letters(j)}" for j in range(10))]), "h") for i in range(90)]
    rows += [(200 + i, "\n".join(block[i:] + block[:i]), "h") for i in range(15)]
    rows += [(400 + i, "\n".join(block[:12]).upper(), "few") for i in range(60)]  # copies are one document
    got = {r["doc_id"]: r for r in quality_rules(docs(rows)).collect()}
    assert all(got[i]["n_removed"] == 90 and not got[i]["kept"] and not got[i]["base_failed"] for i in [*range(90), *range(200, 215)])
    assert all(got[i]["n_removed"] == 0 and got[i]["kept"] for i in range(400, 460))


def test_keep_good_removes_lines_and_documents(docs):
    frame = docs([*common_rows(), (None, " ".join(f"n{letters(k)}" for k in range(70)), None), (None, None, None)]).withColumn("n_chars", F.length("text").cast("long"))
    kept = keep_good(frame)
    assert kept.columns == frame.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert 400 not in rows and rows[3]["text"] == " ".join(f"dd" f"w{letters(k)}" for k in range(60)) and rows[3]["n_chars"] == len(rows[3]["text"])
    assert rows[300]["text"].endswith("2024 ") and None in rows and kept.count() == 30 + 40 + 150 + 1 + 1
    assert keep_good(docs([])).count() == 0


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over


def source_rows(documents):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    return rows + [(10_000 + i, "one two three " * (i % 5), None) for i in range(40)] + [(20_000, None, "empty"), (20_001, "a b", "small"), (20_001, "a b", "small"), (None, "x y z", "Ünï")]


def test_mix_meets_its_targets(documents, docs):
    rows = source_rows(documents)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = brute_targets(dict(sizes))
    frame = docs(rows)
    got = mix(frame).collect()
    assert sorted(map(str, ((r["doc_id"], r["size"]) for r in got))) == sorted(map(str, ((i, size(t)) for i, t, _ in rows)))
    of = defaultdict(set)
    for i, _, s in rows:
        of[i].add(s)
    taken = defaultdict(int)
    for r in got:
        (s,) = of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s, n in sizes.items():
        assert abs(taken[s] - want[s]) <= max(2, 0.02 * n), (s, n, want[s], taken[s])
    again = mix(frame.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mix(docs([])).count() == 0


def test_schedule_is_even_everywhere(spark, documents):
    """Any stretch of the slots holds each source close to its share, and ranks count every source's slots."""
    sizes = stored(sized(documents, "doc_id", "text", "source", "mix"), "sizes")
    sources = stored(with_blocks(targets(sizes)), "targets")
    slots = sorted(schedule(spark, sources).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in slots] == list(range(len(slots)))
    need = {r["rank"]: r["target"] * r["blocks"] / r["source_size"] for r in sources.collect() if r["source_size"]}
    seen = Counter()
    for k, r in enumerate(slots, 1):
        assert r["turn"] == seen[r["rank"]] and r["block"] == r["turn"] % r["blocks"]
        seen[r["rank"]] += 1
        if k % 97 == 0:
            assert all(abs(seen[s] - k * n / sum(need.values())) < 6 for s, n in need.items())
