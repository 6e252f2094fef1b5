"""The style tree against brute-force entropies, and hosts of one to eight pages by one rule."""

import math
import random
from collections import Counter, defaultdict

import pytest

from daybook.llm.html_text import STRENGTH, extract_text, node_features, style_tree

SCHEMA = "page_id long, url string, html string"


def random_pages(seed, n):
    draw = random.Random(seed)

    def block(depth):
        if depth == 0 or draw.random() < 0.4:
            return f"<p class=c{draw.randrange(2)}x>{draw.choice(['same words', f'own {draw.randrange(9)}', 'x'])}</p>"
        return f"<div class={draw.choice('ab')}>{''.join(block(depth - 1) for _ in range(draw.randrange(1, 4)))}</div>"

    return [(i, f"http://h{i % 3}.example/{i}", f"<body>{''.join(block(3) for _ in range(3))}</body>") for i in range(n)]


def entropy(values):
    n = len(values)
    return 1.0 if n == 1 else -sum(c / n * math.log2(c / n) for c in Counter(values).values()) / math.log2(n)


def test_importance_matches_brute_force(spark):
    rows = random_pages(3, 40) + random_pages(3, 5)  # some pages twice
    held = defaultdict(dict)
    for _, url, page in rows:
        features = node_features(page)
        total = sum(len((t + " ").encode()) for t in __import__("re").findall(r"<p[^>]*>([^<]+)</p>", page))
        for path, style, content, size in features:
            held[url.split("/")[2], path][tuple(features)] = (style, content, size, total)
    got = {(r["host"], r["path"]): r for r in style_tree(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got.keys() == held.keys()
    for key, pages in held.items():
        styles, contents, sizes, totals = zip(*pages.values())
        m, share = len(pages), sum(sizes) / sum(totals)
        k = STRENGTH / (max(8, *sizes) * max(1 - share, 1e-3) ** 2)
        h = max(entropy(styles), entropy(contents))
        assert got[key]["pages"] == m and got[key]["share"] == pytest.approx(share)
        assert got[key]["importance"] == pytest.approx(h) and got[key]["judged"] == pytest.approx((h * m + k) / (m + k))


NOTICE = "This site uses small files to remember you; read on or change what you allow."
SHORT = "Made with care"


@pytest.mark.parametrize("n", range(1, 9))
def test_hosts_of_few_pages(spark, n):
    def page(i):
        words = " ".join(f"word{(i * 37 + j * j) % 101}" for j in range(60))
        return f"<body><div class=x>{NOTICE}</div><div class=body><p>{words}</p><p>closing {i}</p></div><div class=y>{SHORT}</div></body>"

    out = [r["text"] for r in extract_text(spark.createDataFrame([(i, f"http://s/{i}", page(i)) for i in range(n)], SCHEMA)).collect()]
    assert all("word" in t and "closing" in t for t in out)
    assert all((NOTICE in t) == (n < 2) for t in out)  # a long notice goes from the second page on
    assert all((SHORT in t) == (n < 5) for t in out)  # a short one needs a fifth


@pytest.mark.parametrize("n", [2, 4, 8])
def test_near_copies_keep_their_story(spark, n):
    story = "the same story on every page of the host, told at length " * 9
    rows = [(i, f"http://c/{i}", f"<body><div class=t><p>{story}</p></div><p>copy {i}</p></body>") for i in range(n)]
    assert all("the same story" in r["text"] for r in extract_text(spark.createDataFrame(rows, SCHEMA)).collect())


def test_generated_names_stay_rows(spark):
    """A host whose class names differ on every page: its tree grows with its pages, no row does."""
    rows = [(i, f"http://g/{i}", "".join(f"<div class=q{chr(97 + i % 26)}{chr(97 + j)}z{chr(97 + i // 26)}>own {i} {j}</div>" for j in range(20)) + f"<p>{NOTICE}</p>") for i in range(200)]
    out = extract_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 200 and all(r["text"].count("own") == 20 and NOTICE not in r["text"] for r in out)
