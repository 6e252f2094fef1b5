"""Names of one person stay one person; replacements against a plain extraction; the draw loop ends."""

import re

import pytest
import regex
from pyspark.sql import functions as F

from daybook.llm import pii
from daybook.llm.pii import PATTERNS, replace_pii, surrogates


def test_all_mentions_of_a_person_agree(docs):
    rows = [
        (1, "Mr John Smith met Mr Smith. John Smith left. Dr Smith stayed; Smiths and John stay, so does Smithson.", "s"),
        (2, "Dr John Smith wrote to Mrs Jane Smith and Mrs Smith.", "s"),
        (3, "Smith alone is no name here.", "s"),
        (4, "Herr Иван Петров, Петров. Mme Zoé Étienne-x Zoé Étienne", None),
    ]
    out = {r["doc_id"]: (r["text"], r["n_entities"]) for r in replace_pii(docs(rows)).collect()}
    one = re.fullmatch(r"Mr (\w+) (\w+) met Mr (\w+)\. (\w+) (\w+) left\. Dr (\w+) stayed; Smiths and John stay, so does Smithson\.", out[1][0])
    assert one and out[1][1] == 4
    first, last = one[1], one[2]
    assert one[3] == one[5] == one[6] == last and one[4] == first and "Smith" != last and "John" != first and first in pii._FIRST["m", "Latin"].split()
    two = re.fullmatch(r"Dr (\w+) (\w+) wrote to Mrs (\w+) (\w+) and Mrs (\w+)\.", out[2][0])
    assert two[1] == first and two[2] == two[4] == two[5] == last and two[3] != first and two[3] in pii._FIRST["f", "Latin"].split()
    assert out[3] == (rows[2][1], 0)
    four = re.fullmatch(r"Herr (\w+) (\w+), (\w+)\. Mme (\w+) (\w+)-x (\w+) (\w+)", out[4][0])
    assert (four[4], four[5]) == (four[6], four[7]) and out[4][1] == 4


def test_people_of_one_surname_stay_distinct(docs):
    names = ["".join(c) for c in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3, "aeiou" * 16, "lmnrst" * 13)]
    names = sorted({n + x for n in names for x in ("a", "o")})
    out = replace_pii(docs([(i, f"Mr {n} Miller", "s") for i, n in enumerate(names)])).collect()
    people = {r["text"] for r in out}
    assert len(people) == len(names) > 60 and len({p.split()[2] for p in people}) == 1  # more than the list of first names has


def brute_mentions(text):
    java = {k: p.replace(r"\p{IsLatin}", r"\p{Latin}") for k, p in PATTERNS.items()}
    base = "|".join(f"(?:{p})" for p in java.values())
    first = [m.group(0) for m in regex.finditer(base, text)]
    names = [regex.sub(pii._TITLED, "", v) for v in first if regex.search(pii._TITLED, v)]
    if names:
        said = sorted({x for n in names for x in (n, n.split(" ")[-1])}, key=len, reverse=True)
        base += rf"|(?<!\p{{L}})(?:{'|'.join(said)})(?!\p{{L}})"
    return [m.span() for m in regex.finditer(base, text)]


def test_replacement_matches_plain_extraction(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["text"] for r in documents.collect()}
    became, held = {}, 0
    for r in replace_pii(documents).collect():
        text, new = truth[r["doc_id"]], r["text"]
        spans = brute_mentions(text)
        held += len(spans)
        assert r["n_entities"] == len(spans), r["doc_id"]
        # What stands between the mentions is as it was; each mention is the same replacement everywhere.
        pieces = [text[a:b] for a, b in zip([0] + [b for _, b in spans], [a for a, _ in spans] + [len(text)])]
        pattern = "(.+?)".join(map(re.escape, pieces))
        m = re.fullmatch(pattern, new, re.S)
        assert m, r["doc_id"]
        for (a, b), x in zip(spans, m.groups()):
            if text.count(text[a:b]) == 1 or len(spans) == 1:
                assert became.setdefault(text[a:b], x) == x and x != text[a:b]
    assert held > 50 and len(set(became.values())) == len(became)


def test_a_full_format_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "MOST_ATTEMPTS", 3)
    taken = spark.range(300).select(F.lit("ssn").alias("kind"), F.format_string("%09d", F.col("id")).alias("canon"))
    monkeypatch.setattr(pii, "draw", lambda kind, canon, attempt, key: F.pmod(F.xxhash64(canon, attempt), F.lit(200)).cast("string"))
    with pytest.raises(RuntimeError, match="no room"):
        surrogates(taken, "k").count()


def test_surnames_get_room_with_every_attempt(spark):
    df = spark.createDataFrame([("Smith", a) for a in range(6)], "canon string, attempt int")
    made = [r[0] for r in df.select(pii.draw(F.lit("surname"), F.col("canon"), F.col("attempt"), "k"), "attempt").orderBy("attempt").collect()]
    assert [len(x) for x in made] == [8, 10, 12, 14, 16, 18]
    mails = df.select(pii.draw(F.lit("email"), F.lit("ab@x.org"), F.col("attempt"), "k").alias("m"), "attempt").orderBy("attempt").collect()
    assert [len(r["m"].split("@")[0]) for r in mails] == [2, 3, 4, 5, 6, 7] and len({r["m"].split("@")[1] for r in mails}) == 1
