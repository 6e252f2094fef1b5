"""Language ID: n-gram counts against plain Python, machines against their loss, held-out accuracy, odd rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daybook.llm import language_id as li
from daybook.llm.queries import op11_language_id


def brute_counts(text):
    raw = bytes(b if 0x61 <= b < 0x7B or b >= 0x80 else 0x20 for b in text.lower().encode())
    raw = b" " + raw + b" "
    out = Counter()
    for k in range(1, li.ORDERS + 1):
        for i in range(len(raw) - k + 1):
            g = raw[i : i + k]
            if b" " in g[1:-1] or not g.strip(b" "):
                continue
            code = int.from_bytes(g, "little")
            out[((code + k) * 2654435761 % 2**32) >> 20] += 1
    return out


def test_counts_match_python():
    draw = random.Random(2)
    texts = ["", "a", "Zürich 12 ÉCOLE", "  x  ", "été\nnoël", *("".join(draw.choice("ab cß9-é") for _ in range(draw.randrange(50))) for _ in range(60))]
    offsets = np.cumsum([0, *(len(t.lower().encode()) for t in texts)])
    data = np.frombuffer("".join(t.lower() for t in texts).encode(), dtype=np.uint8)
    got = li._counts(data, offsets)
    for i, t in enumerate(texts):
        want = brute_counts(t)
        assert {k: int(got[i, k]) for k in np.flatnonzero(got[i])} == dict(want), t


def test_chunks_of_a_long_text(monkeypatch):
    data = np.frombuffer(("lorem ipsum dolor sit amet " * 40).encode(), dtype=np.uint8)
    whole = li._counts(data, np.array([0, len(data)]))
    monkeypatch.setattr(li, "_CHUNK", 7)
    assert (li._counts(data, np.array([0, len(data)])) == whole).all()


def test_machine_minimises_its_loss():
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.normal(0.5, 1, (60, 8)), draw.normal(-0.5, 1, (60, 8))])
    sign = np.repeat([1.0, -1.0], 60)

    def loss(w):
        return 0.5 * (w @ w) + 0.5 * li.LOSS * (np.maximum(0, 1 - sign * (x @ w[:-1] + w[-1])) ** 2).sum()

    w = li.machine(x, sign)
    assert all(loss(w) <= loss(w + draw.normal(0, s, 9)) + 1e-9 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


def test_families_join_what_is_alike():
    draw = np.random.default_rng(4)
    base = draw.normal(size=(2, li.DIMS))
    langs = [base[0] + 0.3 * draw.normal(size=li.DIMS), base[1], base[0], base[1] + 0.3 * draw.normal(size=li.DIMS)]
    x = np.concatenate([m + 0.1 * draw.normal(size=(20, li.DIMS)) for m in langs])
    f = li.families_of(x, np.repeat(np.arange(4), 20), 4)
    assert f[0] == f[2] and f[1] == f[3] and f[0] != f[1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op11_language_id(spark, sf).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_other_columns_are_no_input(spark, documents):
    a = li.identify_languages(documents).where("held_out")
    changed = documents.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("xx")).otherwise(F.col("lang")))
    b = li.identify_languages(changed.withColumn("source", F.lit("s"))).where("held_out")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_odd_rows(docs):
    schema = "doc_id long, text string, source string, lang string"
    rows = [(i, "the cat and the dog and the hat", "s", "en") for i in range(30)]
    rows += [(i + 30, "der hund und die katze und der hut", "s", "de") for i in range(30)]
    rows += [(100, None, "s", "en"), (101, "", None, "de"), (102, "123 !?", "s", None), (103, "und der hut", "s", None), (103, "und der hut", "s", None), (None, "the hat", "s", "en")]
    rows += [(104, "the dog and " * 200_000, "s", None), (105, "Ω", None, None)]
    got = {}
    out = li.identify_languages(docs(rows, schema)).collect()
    for r in out:
        got.setdefault(r["doc_id"], []).append(r["lang_pred"])
    assert len(out) == len(rows)
    assert got[100] == got[101] == got[102] == ["und"] and got[103] == ["de", "de"] and got[None] == ["en"] and got[104] == ["en"]
    assert got[105][0] in ("de", "en")
    assert li.identify_languages(docs([], schema)).count() == 0
    unlabelled = li.identify_languages(docs([(1, "abc", "s", None)], schema)).first()
    assert unlabelled["lang_pred"] == "und" and unlabelled["score"] == 0
    one = li.identify_languages(docs([(i, "abc", "s", "en") for i in range(9)], schema)).collect()
    assert {r["lang_pred"] for r in one} == {"en"} and {r["score"] for r in one} == {1.0}
    three = li.identify_languages(docs(rows + [(200 + i, "le chat et le chien", "s", "fr") for i in range(30)], schema), families={"en": "g", "de": "g", "fr": "r"})
    assert {(r["doc_id"], r["lang_pred"]) for r in three.where("doc_id >= 200").collect()} == {(200 + i, "fr") for i in range(30)}
