"""The whole pipeline on planted documents: what goes, what stays, and tables with odd rows and names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm.mixing import mix

ODD = ["_id", "_row", "_lines", "_host", "_digest", "_kept", "digest", "host", "id", "n", "c0", "c1", "Text id"]


def prose(draw, n):
    return " ".join("".join(draw.choice("abdefgiklmnoprstu") for _ in range(draw.randrange(3, 9))) for _ in range(n))


def tables(spark, scratch, rows, bench, extra=ODD):
    root = scratch("pipe")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def planted():
    draw = random.Random(8)
    text = {i: prose(draw, 120) for i in range(60)}
    item = prose(draw, 30)
    line = prose(draw, 9)
    words = text[1].split()
    text[2] = text[1]  # an exact copy
    text[3] = " ".join(words[:60] + ["changed"] + words[61:])  # a near one
    text[4] = prose(draw, 50) + " " + item + " " + prose(draw, 50)  # leaks the benchmark
    text[5] = "too short"
    text[6] = "again and again " * 60  # repeats itself
    text[7] = prose(draw, 80) + "\npassword = hunter2hunter2hunter2 and " + prose(draw, 20)
    for i in range(20, 45):
        text[i] += "\n" + line  # a line that most documents of the host share
    rows = [(i, t, "en", "s1" if i % 5 else "s2", len(t)) for i, t in text.items()]
    rows += [(100, None, "en", "s1", None), (101, "", None, None, 0), (None, text[8], "en", "s1", 5), (9, text[9], "en", "s1", len(text[9])), (102, text[10][::-1], "en", None, 7)]
    return rows, [(1, item), (2, None)], text, line


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "secret_scan", "mixing_sources"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_stage_keeps_the_columns_and_drops_what_it_should(spark, scratch):
    rows, bench, text, line = planted()
    root = tables(spark, scratch, rows, bench)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, root)
        docs.write.parquet(path := scratch(name))
        docs = spark.read.parquet(path)
        assert docs.columns == before.columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    quality, near, leaks, secrets = seen.values()
    assert {5, 6, 100, 101}.isdisjoint(quality) and {1, 2, 3, 4, 7, 9, 102, None} <= quality.keys()
    # The line is above the limit of the first host (20 documents), not of the second one (five).
    assert all((line in r["text"]) == (r["doc_id"] % 5 == 0) for r in quality.values() if r["doc_id"] in range(20, 45))
    assert quality[21]["n_chars"] == len(quality[21]["text"]) == len(text[21]) - len(line) - 1
    assert quality[1]["text"] == text[1]
    assert {2, 3}.isdisjoint(near) and near[1]["text"] == text[1] and len(near) == len(quality) - 2
    assert set(near) - set(leaks) == {4}
    assert "hunter2" not in secrets[7]["text"] and secrets[7]["n_chars"] == len(secrets[7]["text"]) and set(secrets) == set(leaks)
    assert all(secrets[i]["text"] == leaks[i]["text"] for i in secrets if i != 7)


def test_run_matches_its_stages(spark, scratch):
    rows, bench, text, _ = planted()
    root = tables(spark, scratch, rows, bench)
    out = [tuple(r) for r in corpus_pipeline.run(spark, root).collect()]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, root)
    kept = docs.collect()
    want = [tuple(r) for r in mix(spark.createDataFrame(kept, docs.schema)).collect()]
    assert sorted(map(str, out)) == sorted(map(str, want)) and len(out) == len(kept) > 40


@pytest.mark.parametrize("extra", [[], ["rows", "size", "taken", "_ID"]])
def test_empty_tables(spark, scratch, extra):
    root = tables(spark, scratch, [], [], extra)
    assert corpus_pipeline.run(spark, root).count() == 0
    none = tables(spark, scratch, [(1, None, None, None, None)] * 3, [(1, "x y z")], extra)
    assert corpus_pipeline.run(spark, none).count() == 0
