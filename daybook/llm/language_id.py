"""Language ID (11): the language family first, then support vector machines inside the family.

A text becomes a vector of hashed character n-grams (one to four bytes of the
lower-cased text; what is no letter counts as a blank, and a blank only stands
at the ends of an n-gram), damped by ``log1p`` and scaled to length one.
Languages are grouped into families by average linkage of their mean vectors,
or by a given table. Two levels of one-versus-one linear support vector
machines then decide: between families, and between the languages of the
winning family. The machines minimise the squared hinge loss by Newton steps on
a bounded sample of labelled texts; every text is scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import crc_fold
from daybook.llm.words import text_slices

#: Hash buckets of the n-grams, and the longest n-gram in bytes.
DIMS = 1 << 12
ORDERS = 4
#: Bounds of the training sample: rows of a language, rows in all, languages (the most frequent ones).
LANGUAGE_ROWS = 500
SAMPLE_ROWS = 4_000
MOST_LANGUAGES = 100
#: Weight of the losses against the squared weights.
LOSS = 4.0
UNKNOWN = "und"

_LETTER = np.full(256, 0x20, dtype=np.uint8)  # bytes that are no letters become blanks
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_CHUNK = 1 << 20


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """N-gram counts ``(texts, DIMS)``; each text stands between two blanks of its own."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets) + 2)
    letters = np.full(len(rows) + ORDERS, 0x20, dtype=np.uint8)
    letters[np.arange(len(data)) + 2 * np.repeat(np.arange(n), np.diff(offsets)) + 1] = _LETTER[data]
    blank = letters == 0x20
    out = np.zeros(n * DIMS, dtype=np.int64)
    for start in range(0, len(rows), _CHUNK):
        stop = min(len(rows), start + _CHUNK)
        code, inner = np.zeros(stop - start, dtype=np.uint32), np.ones(stop - start, dtype=bool)
        for k in range(1, ORDERS + 1):
            code |= letters[start + k - 1 : stop + k - 1].astype(np.uint32) << np.uint32(8 * (k - 1))
            if k > 2:
                inner &= ~blank[start + k - 2 : stop + k - 2]
            # Without blanks inside; two letters at least, or a letter and a blank.
            at = np.flatnonzero(inner & ~(blank[start:stop] & blank[start + k - 1 : stop + k - 1]) if k < 3 else inner)
            bucket = ((code[at] + np.uint32(k)) * np.uint32(2654435761)) >> np.uint32(20)
            out += np.bincount(rows[start + at] * DIMS + bucket, minlength=len(out))
    return out.reshape(n, DIMS)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Unit vectors ``(texts, DIMS)`` of a string column, some texts at a time, in row order."""
    for _, data, offsets in text_slices(pc.utf8_lower(column.cast(pa.large_string()))):
        x = np.log1p(_counts(data, offsets).astype(np.float32))
        yield x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), np.float32(1e-9))


def machine(x: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear support vector machine: Newton steps on the squared hinge loss.

    Each step solves for the rows inside the margin; it ends when they stay the same.
    """
    gram = x @ x.T + 1.0
    inside, beta = np.ones(len(x), dtype=bool), np.zeros(len(x))
    for _ in range(50):
        at = np.flatnonzero(inside)
        beta = np.zeros(len(x))
        beta[at] = np.linalg.solve(gram[np.ix_(at, at)] + np.eye(len(at)) / LOSS, sign[at])
        now = sign * (gram @ beta) < 1
        if (now == inside).all() or not now.any():
            break
        inside = now
    return np.append(beta @ x, beta.sum())


def families_of(x: np.ndarray, y: np.ndarray, n: int) -> list[int]:
    """Family of each language: average linkage of the centred mean vectors into about ``sqrt(n)`` groups."""
    means = np.stack([x[y == k].mean(axis=0) for k in range(n)])
    means = means - means.mean(axis=0)
    means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    like = means @ means.T
    groups = [[k] for k in range(n)]
    while len(groups) > max(1, round(n**0.5)):
        _, a, b = max((float(like[np.ix_(groups[a], groups[b])].mean()), -a, -b) for a, b in combinations(range(len(groups)), 2))
        groups[-a] += groups.pop(-b)
    return [next(g for g, members in enumerate(groups) if k in members) for k in range(n)]


class Model:
    """Languages, the family of each, and the machines of both levels as rows of one matrix."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray, families: dict[str, str] | None = None):
        self.languages = languages
        if families is None:
            self.family = families_of(x, y, len(languages)) if languages else []
        else:
            names = sorted({families.get(a, a) for a in languages})
            self.family = [names.index(families.get(a, a)) for a in languages]
        self.n_families = max(self.family, default=-1) + 1
        family = np.array(self.family, dtype=np.int64)[y] if len(y) else y
        self.family_pairs = list(combinations(range(self.n_families), 2))
        self.pairs = [(a, b) for a, b in combinations(range(len(languages)), 2) if self.family[a] == self.family[b]]
        tasks = [(family, p) for p in self.family_pairs] + [(y, p) for p in self.pairs]
        rows = []
        for target, (a, b) in tasks:
            at = (target == a) | (target == b)
            rows.append(machine(x[at].astype(np.float64), np.where(target[at] == a, 1.0, -1.0)))
        self.weights = np.array(rows, dtype=np.float32).reshape(len(rows), DIMS + 1)

    @staticmethod
    def _decide(margins: np.ndarray, pairs: list[tuple[int, int]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Winner by votes, then by summed margins, and its smallest margin against the others."""
        votes, total = np.zeros((len(margins), n)), np.zeros((len(margins), n))
        least = np.full((len(margins), n), np.inf)
        for k, (a, b) in enumerate(pairs):
            m = margins[:, k]
            for one, x in ((a, m), (b, -m)):
                votes[:, one] += x > 0
                total[:, one] += np.clip(x, -1, 1)
                least[:, one] = np.minimum(least[:, one], x)
        best = np.argmax(votes + total / (1e-3 + 4 * max(1, n)), axis=1)
        return best, least[np.arange(len(best)), best]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score from 0 to 1 (how clear its narrowest decision was)."""
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        cut = len(self.family_pairs)
        family, margin = self._decide(margins[:, :cut], self.family_pairs, self.n_families)
        out = np.zeros(len(x), dtype=np.int64)
        for f in range(self.n_families):
            at = np.flatnonzero(family == f)
            members = [k for k, g in enumerate(self.family) if g == f]
            own = [k for k, (a, _) in enumerate(self.pairs) if self.family[a] == f]
            pairs = [(members.index(self.pairs[k][0]), members.index(self.pairs[k][1])) for k in own]
            best, least = self._decide(margins[at][:, [cut + k for k in own]], pairs, len(members))
            out[at], margin[at] = np.array(members)[best], np.minimum(margin[at], least)
        return out, 1.0 / (1.0 + np.exp(-3.0 * np.clip(margin, -30, 30)))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held_out: int) -> DataFrame:
    """``(lang, text)`` of the bounded sample: per language the distinct texts of smallest digest.

    Digests are cut by a threshold from the language's count first, so that no window holds
    much more than the rows it returns.
    """
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL").where(crc_fold("id", folds) != held_out).select("lang", "text")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    n = min(LANGUAGE_ROWS, SAMPLE_ROWS // max(1, len(counts)))
    shares = docs.sparkSession.createDataFrame([(r[0], min(1.0, (1.5 * n + 50) / r[1])) for r in counts], "lang string, share double")
    digest = F.xxhash64("text")
    near = known.join(F.broadcast(shares), "lang").withColumn("digest", digest)
    near = near.where(F.pmod("digest", F.lit(1 << 31)) < F.col("share") * float(1 << 31)).dropDuplicates(["lang", "digest"])
    order = Window.partitionBy("lang").orderBy(F.pmod("digest", F.lit(1 << 31)), "digest")
    return near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= n).select("lang", "text")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2, families: dict[str, str] | None = None) -> Model:
    """The model of the labelled rows outside the held-out fold; feature vectors of at most ``SAMPLE_ROWS`` texts are collected."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(i, 200) for batch in batches for i in range(0, batch.num_rows, 200)):
            packed = [row.tobytes() for x in features(part.column(1)) for row in x.astype(np.float16)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["lang", "x"])

    sample = training_rows(docs, id_col, text_col, lang_col, folds, held_out).mapInArrow(rows, "lang string, x binary").collect()
    sample = sorted((r["lang"], bytes(r["x"])) for r in sample)
    languages = sorted({r[0] for r in sample})
    x = np.frombuffer(b"".join(r[1] for r in sample), dtype=np.float16).reshape(-1, DIMS).astype(np.float32)
    y = np.array([languages.index(r[0]) for r in sample], dtype=np.int64)
    return Model(languages, x, y, families)


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    folds: int = 4, held_out: int = 2, families: dict[str, str] | None = None,
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row of ``docs``.

    The model learns from rows with a text and a language whose ``crc32(id) mod folds`` is not ``held_out``; a null
    id is never held out and teaches nothing. ``families`` (language to family) replaces the learned families.
    A text that is null or has no letter is ``und`` with score 0, and so is every text where nothing could be
    learned; one learned language is predicted for all others, with score 1. Equal rows all come back.
    """
    model = fit(docs, id_col, text_col, lang_col, folds, held_out, families)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(i, 200) for batch in batches for i in range(0, batch.num_rows, 200)):
            texts = part.column(1)
            known = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            if model.languages:
                found = [model.predict(x) for x in features(texts)]
                best = np.concatenate([f[0] for f in found])
                names[known] = np.array(model.languages, dtype=object)[best[known]]
                scores[known] = np.concatenate([f[1] for f in found])[known]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = out.schema["id"].dataType.simpleString()
    out = out.mapInArrow(rows, f"id {id_type}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), F.coalesce(crc_fold("id", folds) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
