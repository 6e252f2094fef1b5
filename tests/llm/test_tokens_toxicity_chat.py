"""Token histogram, toxicity grammar and chat repair against plain Python."""

import itertools
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm.chat import ENDING, MERGE, INSERT, ROLES, START, _NEXT, format_chats, relabel_cost
from daybook.llm.token_counts import at_limits, encoding, length_histogram, quantiles, suffix_sums, token_lengths
from daybook.llm.toxicity import LEXICON, PATTERNS, Composed, Grammar, fit_weights, learn_words, negation, reported, targets, threats, toxicity


def test_histogram_answers_match_python(spark, documents, docs):
    odd = [(1, None, None), (2, "", "a"), (3, "a" * 3000 + " " * 500, "a"), (4, "<|endoftext|> Ünïcode 12345", "b"), (None, "x", None)]
    for frame, by, key in ((documents, None, lambda r: ""), (docs(odd), "source", lambda r: r["source"])):
        encode = encoding().encode_ordinary
        want = Counter((key(r), len(encode(r["text"] or ""))) for r in frame.collect())
        sums = suffix_sums(length_histogram(token_lengths(frame, by=by)))
        rows = sums.collect()
        assert {(r["key"], r["length"]): r["n_docs"] for r in rows} == want
        for r in rows:
            mine = {n: c for (k, n), c in want.items() if k == r["key"]}
            assert r["docs"] == sum(mine.values()) and r["total"] == sum(n * c for n, c in mine.items())
            assert r["truncated_total"] == sum(min(n, r["length"]) * c for n, c in mine.items())
            assert r["n_longer"] == sum(c for n, c in mine.items() if n > r["length"]) and r["rank"] == r["docs"] - r["n_longer"]
            assert r["lost"] == r["total"] - r["truncated_total"] and r["tokens_upto"] == sum(n * c for n, c in mine.items() if n <= r["length"])
        asked = [0, 1, 7, 500, 10**9]
        for r in at_limits(sums, spark.createDataFrame([(x,) for x in [*asked, None, -3, 7]], "limit long")).collect():
            mine = {n: c for (k, n), c in want.items() if k == r["key"]}
            assert r["truncated_total"] == sum(min(n, r["limit"]) * c for n, c in mine.items())
        for r in quantiles(sums, [0.1, 0.5, 1.0]).collect():
            mine = sorted(itertools.chain.from_iterable([n] * c for (k, n), c in want.items() if k == r["key"]))
            assert r["length"] == mine[max(0, -(-int(r["share"] * len(mine) * 10) // 10) - 1)]
    assert suffix_sums(length_histogram(token_lengths(docs([])))).count() == 0


def test_transducers_compose():
    machine = Composed(negation(), reported(), targets(), threats())
    marks = dict(machine.run(["target", "other", "negation", "other", "insult"]))
    assert marks["insult"] == {"negated", "target"}
    assert [m for s, m in machine.run(["report", "quote", "insult", "quote", "insult"]) if s == "insult"] == [{"reported"}, frozenset()]
    assert machine.run(["negation", "other", "other", "other", "insult"])[-1][1] == frozenset()
    assert [m for s, m in machine.run(["other", "threat"])] == [frozenset(), frozenset()] and "meant" in machine.run(["future", "threat"])[-1][1]


def test_grammar_reads_clauses():
    g = Grammar(LEXICON)
    found = lambda t: {p: n for p, n in zip(PATTERNS, g.patterns(t), strict=True) if n}
    assert found("You idiot! IDIOT") == {"insult+target": 1, "insult": 1}
    assert found("She is not an idiot.") == {"insult+negated": 1}
    assert found('He said "moron" twice') == {"insult+reported": 1}
    assert found("Idiotenhaft trashed clownish") == {} and found(None) == found("") == found("!!!") == {}
    assert found("I will kill you") == {"threat+target": 1} and found("We kill time") == {}
    assert found("moron%%% moron*** moron### moron&&& moron") == {"insult": 3}


def letters(n):
    return "".join(chr(97 + int(c)) for c in str(n))


def test_words_and_weights_are_learned(spark):
    clean, rude = [0] * len(PATTERNS), [1] + [0] * (len(PATTERNS) - 1)
    assert sorted(learn_words(spark.createDataFrame([(i, f"some words vexor{'abc'[i % 3]} w{letters(i)}", 1) for i in range(12)] + [(50 + i, f"some words vex u{letters(i)}", 0) for i in range(30)], "id long, text string, y int"))) == ["vexo*"]
    assert Grammar({"insult": "vexo*"}).patterns("A VEXORA, vex avexor vexo") == [2] + [0] * (len(PATTERNS) - 1)
    w = fit_weights([(clean, 0, 900), (clean, 1, 10), (rude, 1, 90), (rude, 0, 3)])
    assert w[-1] < -3 and w[-1] + w[0] > 1
    assert not fit_weights([]).any()


def test_held_out_accuracy(spark):
    tables = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    scored = toxicity(spark.read.parquet(f"{tables}/documents.parquet"), labels)
    rows = scored.where("held_out").join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic").collect()
    assert len(rows) > 500 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in rows)
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    precision, recall = hit / max(1, sum(r["predicted"] for r in rows)), hit / sum(r["toxic"] for r in rows)
    print("precision", precision, "recall", recall)
    assert precision > 0.9 and recall > 0.7 and sum(r["predicted"] == r["toxic"] for r in rows) > 0.95 * len(rows)


def test_toxicity_of_odd_rows(spark, docs):
    rows = [(1, None, "a"), (2, "", "a"), (None, "you moron", "a"), (4, "x " * 300_000 + "you moron", "a"), (4, "fine", "a")]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(50)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity(docs(rows + [(100 + i, f"you idiot{'s' * (i % 3 > 0)}" if i % 2 == 0 else "good", "a") for i in range(50)]), labels.withColumn("doc_id", F.col("doc_id") + 100))
    got = {(r["doc_id"], r["held_out"]): (r["score"], r["predicted"]) for r in out.collect()}
    assert out.count() == 55 and got[None, False][0] > got[1, zlib.crc32(b"1") % 5 == 0][0]
    assert toxicity(docs([]), labels).count() == 0
    assert {r["predicted"] for r in toxicity(docs(rows), labels.limit(0)).collect()} == {1}  # no labels: 0.5 for all


def brute_cost(roles):
    """Cheapest repair by search over all ways, turn by turn."""
    best = {START: 0}
    for role in roles:
        new = {}
        for state, cost in best.items():
            options = [(state, cost + MERGE + relabel_cost(role, state))] if state != START else []
            paths = [(state, 0)]
            for _ in range(4):
                options += [(r, cost + n * INSERT + relabel_cost(role, r)) for at, n in paths for r in _NEXT[at]]
                paths = [(r, n + 1) for at, n in paths for r in _NEXT[at]]
            for r, c in options:
                new[r] = min(new.get(r, 10**9), c)
        best = new
    return min(c + ENDING[s][0] for s, c in best.items())


def legal(rendered):
    roles = [x.split("\n", 1)[0] for x in rendered.split("<|im_start|>")[1:]]
    body = roles[1:] if roles[:1] == ["system"] else roles
    return body == ["user", "assistant"] * (len(body) // 2) and (roles != ["system"])


@pytest.mark.parametrize("run", [2048, 3, 1])
def test_repairs_are_cheapest_and_legal(spark, run):
    draw = random.Random(run)
    convs = {i: [draw.choice([*ROLES, "user", "assistant", "tool", None, " USER "]) for _ in range(draw.randrange(1, 9))] for i in range(120)}
    convs[500] = ["user", "assistant"] * 40
    rows = [(i, k, r, f"t{i}.{k}") for i, roles in convs.items() for k, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "'x' AS conv")
    got = {}
    for r in sorted(format_chats(df.unionByName(df.limit(50)), run=run).collect(), key=lambda r: (r["conv_id"], r["part"])):
        got.setdefault(r["conv_id"], []).append(r)
    assert set(got) == set(convs)
    for i, roles in convs.items():
        clean = [(r or "").strip().lower() or None for r in roles]
        text = "".join(r["rendered"] for r in got[i])
        assert {r["cost"] for r in got[i]} == {brute_cost(clean)}, roles
        assert legal(text) and text.count("<|im_start|>") == text.count("<|im_end|>") == sum(r["n_written"] for r in got[i])
        assert sum(r["n_turns"] for r in got[i]) == len(roles)
        at = [text.index(f"t{i}.{k}") for k in range(len(roles))]
        assert at == sorted(at)
    assert [r["part"] for r in got[500]] == list(range(-(-80 // run)))


def test_chats_of_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a"), (1, 0, "assistant", None), (2, -5, "user", "x"), (2, -5, "assistant", "y"), (3, 10**12, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {}
    for r in format_chats(df, run=4).orderBy("conv_id", "part").collect():
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["rendered"]
    assert set(out) == {None, 1, 2, 3} and all(legal(t) for t in out.values())
    assert format_chats(df.limit(0)).count() == 0
