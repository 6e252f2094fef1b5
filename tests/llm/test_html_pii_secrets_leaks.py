"""HTML extraction, PII surrogates, secrets and decontamination on fixtures and against plain Python."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm.decontaminate import MASKS, best_stretch, contamination, drop_contaminated, needed_words
from daybook.llm.html_text import extract_text, main_text, node_features, style_tree
from daybook.llm.pii import ANY, replace_pii, surrogates
from daybook.llm.secrets import Crf, all_spans, chains, file_features, fit_crf, redact, redact_secrets, scan, scan_secrets, training_sequences

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="ad-free has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></ul></nav><!-- ad -->
<div class="cookie-notice">We use cookies</div><aside class=sidebar>Side</aside>
<article><header><h1>Head &lt;1&gt; &copy;</h1></header><p><b>One  <i>two</i>
three.<br><p>Caf&eacute;&nbsp;x<p>L1<ul><li>a<li>b</ul><div class="ad">Buy</div><table><tr><td>c1<td>c2</table>
<form><input value="x"><button>Go</button></form><section id="comments"><p>Nice!</p></section><footer>By me</footer>tail</article>
<footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text(PAGE) == "Head <1> ©\nOne two three.\nCafé x\nL1\na\nb\nc1\nc2\ntail"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("a < b & c &lt d", "a < b & c < d"), ("<p>a<p>b</p>c", "a\nb\nc"),
    ("<div>a<span class='advert'>no</span>b</div>", "ab"), ("<article>x<script>if (a<b) {}", "x"), ("<article><p title=\"a>b\">q</p>", "q"),
    ("<main>m</main><p>out", "m"), ("<ul><li><a href=x>l1</a><li><a href=y>l2</a></ul><p>t", "t"), ("<div hidden>h</div>v", "v"),
    ("<![CDATA[x < y]]>z", "x < yz"), ("<p>a</p><!-- b", "a"), ("<div>" * 3000 + "deep", "deep"), ("<article>&#65;&#x42;&bogus;</article>", "AB&bogus;"),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("depth", [290, 400, 30_000])
def test_deep_pages_keep_their_blocks(depth):
    nest = "<div>" * depth + "<p>in</p><aside>menu</aside><form>f</form><p>two</p>" + "</div>" * depth
    page = f"<body><div><article><div>{nest}</div><p>after</p></article>out</div></body>"
    assert main_text(page) == "in\ntwo\nafter"
    assert main_text("<ul><li>" * depth + "t" + "</ul>" * depth + "<p>z") == "t\nz"
    assert len(node_features(page)) >= depth and node_features(page) != node_features(page.replace("two", "2"))


def test_style_tree_removes_what_a_host_repeats(spark):
    def page(i, host):
        words = f"text {i} " + "x" * i
        return (i, f"http://{host}/p{i}", f"<body><div class=top>Welcome to the site</div><div class=body><p>{words}</p><p>more {i}</p></div><div class=end>See you {i % 2}</div></body>")

    rows = [page(i, "big.example") for i in range(40)] + [page(i, "small.example") for i in range(100, 103)]
    rows += [(200 + i, "http://copies.example/x", page(7, "")[2]) for i in range(30)] + [(None, None, None), (5, "nohost", "<p>q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS text", "1 AS path")
    got = {(r["page_id"], r["url"]): r for r in extract_text(df).collect()}
    assert got[3, "http://big.example/p3"]["text"] == "text 3 xxx\nmore 3"
    assert got[101, "http://small.example/p101"]["text"].startswith("Welcome to the site\ntext 101")
    assert got[200, "http://copies.example/x"]["text"].startswith("Welcome")  # thirty copies are one page
    assert got[None, None]["text"] == "" and got[None, None]["n_chars"] == 0 and got[5, "nohost"]["text"] == "q"
    tree = {r["importance"] for r in style_tree(df).where("host = 'big.example'").collect()}
    assert 0.0 in tree and max(tree) == pytest.approx(1.0)
    assert extract_text(df.limit(0)).count() == 0


def test_small_hosts_lose_what_all_their_pages_repeat(spark):
    notice = "This site is run by volunteers and pays for itself, please send us a letter."

    def page(i, host, top):
        return (i, f"http://{host}/p{i}", f"<body><div class=x>{top}</div><div class=body><p>{f'words of page {i} ' * 9}</p></div></body>")

    rows = [page(10 * n + i, f"h{n}.example", notice) for n in (1, 2, 3, 7) for i in range(n)]
    story = "<p>" + "the same story on two pages " * 9 + "</p>"
    rows += [(100 + i, "http://twice.example/", f"<body><div>{story}</div><p>at {i}</p></body>") for i in range(2)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert notice in got[10]  # a single page says nothing
    assert not [i for i in got if 20 <= i < 100 and notice in got[i]] and all(f"words of page {i}" in got[i] for i in got if i < 100)
    assert all("the same story" in got[i] for i in (100, 101))


TEXTS = [
    "Mail Bob.Jones@Mail7.example.com, bob.jones@mail7.example.com or élé.34@mail4.example.com.",
    "Call +1 (974) 555-3436 or +1 974 555 3436; card 4844 1681 1440 7329, 4844168114407329; ip 97.51.17.173.",
    "Mr. John Smith met Mrs Anna Miller and Mr Иван Петров; Dr. Kim. SSN 123-45-6789, 4.0. and 1.2.3.4.5",
    "DE89 3704 0044 0532 0130 00 and DE89370400440532013000!!", "no data here 12345 v2.0", "", None,
]


def test_surrogates_keep_kind_and_identity(docs):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)]
    out = {r["doc_id"]: r for r in replace_pii(docs(rows + rows[:1])).collect()}
    found = [m.group(0) for t in TEXTS if t for m in re.finditer(r"[\w.]+@[\w.]+\w|\+1[ \d()-]+\d|\d{4} ?\d{4} ?\d{4} ?\d{4}|97\.51\.17\.173|123-45-6789|John Smith|Anna Miller|Петров", t)]
    everything = " ".join(r["text"] or "" for r in out.values())
    assert len(found) > 9 and not [x for x in found if x in everything]
    mails = re.findall(r"\S+@[\w.]+\.example", out[0]["text"])
    assert len(mails) == 3 and mails[0] == mails[1] and mails[2] != mails[0] and [m.split("@")[1].count(".") for m in mails] == [2, 2, 2]
    a, b, cards, ip = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}); card (.*); ip ([\d.]+)\.", out[1]["text"]).groups()
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    one, two = cards.split(", ")
    digits = [int(x) for x in one.replace(" ", "")]
    assert one.replace(" ", "") == two and sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert len(ip.split(".")) == 4 and all(0 < int(x) < 255 for x in ip.split("."))
    assert re.fullmatch(r"Mr\. [A-Z][a-z]+ [A-Z][a-z]+ met Mrs [A-Z][a-z]+ [A-Z][a-z]+ and Mr [А-Я][а-я]+ [А-Я][а-я]+; Dr\. Kim?.*", out[2]["text"]) or "Dr. " in out[2]["text"]
    assert out[2]["text"].endswith("4.0. and 1.2.3.4.5") and "123-45-6789" not in out[2]["text"]
    banks = re.findall(r"DE[A-Z0-9 ]+\d", out[3]["text"])
    assert banks[0].replace(" ", "") == banks[1] and len(banks[0]) == len("DE89 3704 0044 0532 0130 00")
    assert (out[4]["text"], out[4]["n_entities"], out[5]["text"], out[6]["text"]) == (TEXTS[4], 0, "", None)
    assert replace_pii(docs(rows + rows[:1])).count() == len(rows) + 1 and replace_pii(docs([])).count() == 0


def test_surrogates_depend_on_the_key_alone(docs):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)]
    texts = lambda key, n: sorted(str(r["text"]) for r in replace_pii(docs(rows).repartition(n), key=key).collect())
    assert texts("a", 1) == texts("a", 5) != texts("b", 1)


def test_many_entities_stay_distinct(spark):
    """Two-digit canons collide at once; drawing goes on until all differ and none is an entity."""
    df = spark.range(300).select(F.lit("name").alias("kind"), F.concat(F.lit("m:"), F.element_at(F.array(*[F.lit(c) for c in "Ab Bo Cu Da".split()]), (F.col("id") % 4 + 1).cast("int")), F.lit(" X"), F.col("id").cast("string")).alias("canon"))
    rows = surrogates(df, "k").collect()
    assert len(rows) == 300 == len({r["replacement"] for r in rows}) and not {r["replacement"] for r in rows} & {r["canon"] for r in rows}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secret_rows(documents):
    draw = random.Random(2)
    hexes = "".join(draw.choice("0123456789abcdef") for _ in range(40))
    odd = [None, "", "é AKIA" + "Q7" * 9, f'TOKEN = "{hexes}" é{hexes}', f"Api_Key:{hexes[:11]} apikey='{hexes[:12]}'", "secret= x password:abcdefghijkl", "ſecret = abcdefghijklmnop",
           f"my key aB3dE5gH7jK9mN1pQ3sT5vW7 {hexes}{hexes}", "a" * 300_000, f"token{' ' * 5}: {'Z' * 12}"]
    return [(r["doc_id"], r["text"], "s") for r in documents.collect()] + [(10_000 + i, t, None) for i, t in enumerate(odd)] + [(None, odd[3], None)]


def test_base_spans_match_python(documents, docs):
    rows = secret_rows(documents)
    frame = docs(rows)
    got = scan_secrets(frame).collect()
    assert len(got) == len(rows)
    texts = {(i, base_spans(t or "")) for i, t, _ in rows}
    for r in got:
        base = ",".join(x for x in r["spans"].split(",") if x and not x.startswith("crf"))
        assert (r["doc_id"], base) in texts and r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [base.count(k) for k in ("assign", "access", "hex")]
    assert scan_secrets(docs([])).count() == 0


def test_redaction_takes_effect(documents, docs):
    frame = docs(secret_rows(documents)).withColumn("n_chars", F.length("text").cast("long"))
    out = redact_secrets(frame)
    assert out.columns == frame.columns and out.count() == frame.count()
    for r in out.collect():
        assert base_spans(r["text"] or "") == "" and r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    assert redact("abcdef", [(0, 0, 2), (1, 1, 3), (3, 2, 4), (5, 3, 6)]) == "<SECRET>e<SECRET>"


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(4)
    moves = draw.normal(size=(4, 3))
    moves[3, 2] = moves[0, 2] = -1e6
    model = Crf({str(i): draw.normal(size=3) for i in range(6)}, moves)
    features = [[str(i), str((i * 2) % 6)] for i in range(6)]
    e = model.emissions(features)
    score = lambda t: moves[3, t[0]] + sum(e[i, k] for i, k in enumerate(t)) + sum(moves[a, b] for a, b in itertools.pairwise(t))
    assert tuple(model.decode(features)) == max(itertools.product(range(3), repeat=6), key=score)


def test_the_field_generalises():
    """Held-out texts: values of other alphabets after other words are found, plain numbers and names are not."""
    draw = random.Random(11)
    make = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    train = [f"some words token = \"{make('0123456789abcdef', 40)}\" and more" for _ in range(60)]
    train += [f"words {make('0123456789', 8)} version_2.0.1 file_name.txt at http/path/{i}" for i in range(60)]
    model = fit_crf(training_sequences(train))

    def found(text):
        ((t, hexes, tokens),) = scan(pa.array([text]))
        return [t[a:b] for a, k, b in all_spans(model, t, hexes, tokens) if k == 3]

    value = [make(mixed, 32) for _ in range(20)]
    assert sum(found(f'the key = "{v}" here') == [v] for v in value) >= 18
    assert not any(found(f"in 2024-0{i % 9 + 1}-11 file_name_{i}.txt and call {i}5551234567") for i in range(20))


def test_secrets_of_letters_alone_are_found():
    draw = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    make = lambda n: "".join(draw.choice(letters) for _ in range(n))
    train = [f"some words secret: {make(20)} and more\nNote: the words say so" for _ in range(60)] + [f'he said: "nothing here" about key {i}' for i in range(60)]
    sequences = training_sequences([*train, "card 4844168114407329 secret: abcdefghijklmnop end"])
    assert any(None in f and 1 in t for f, t in sequences)
    model = fit_crf(sequences)

    def found(text):
        ((t, hexes, tokens),) = scan(pa.array([text]))
        return [t[a:b] for a, k, b in all_spans(model, t, hexes, tokens) if k == 3]

    assert found("é pwd: QwErTyUiOpAsDfGhJk\n") == ["QwErTyUiOpAsDfGhJk"]
    values = [make(24) for _ in range(20)]
    assert sum(found(f"the credential: {v} here") == [v] for v in values) >= 18
    assert not found('Note: the words "say" nothing, and the key idea is this')
    assert chains("a b: cd ef\ngh", [(5, 7), (11, 13)]) == [[None, (5, 7), None], [(11, 13)]]


def test_file_features_see_the_whole_text():
    prose = "plain words " * 1000
    for mark in ("a = b", "x | y", "f() {", "end;"):
        assert file_features(prose + mark, 3) == file_features(mark + prose, 3) != file_features(prose, 3)


def passages(seed=6):
    draw = random.Random(seed)
    vocabulary = [f"w{i}x" for i in range(400)]
    words = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [words(n) for n in (5, 9, 14, 20, 36, 59)]
    return words, items


def test_substituted_passages_are_found(docs, spark):
    words, items = passages()
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    rows, want = [], set()
    for i, item in enumerate(items):
        for k in range(6):
            copy = list(item)
            for at in range(7, len(copy), 9)[: k % 3]:
                copy[at] = "other"
            whole = len(item) < 8
            doc = copy if whole else words(30) + copy + words(30)
            rows.append((100 * i + k, " ".join(doc).upper() if k == 5 else ", ".join(doc), "s"))
            if not whole or k % 3 == 0 or copy == item:
                want.add((100 * i + k, i))
    rows += [(1000 + i, " ".join(words(200)), "s") for i in range(40)] + [(2000, " ".join(words(20) + items[4][:8] + words(20)), "s")]
    rows += [(3000, None, None), (3001, "", None), (None, " ".join(items[3]), None)]
    want.add((None, 3))
    frame = docs(rows)
    got = contamination(frame, bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    joined = contamination(frame, bench, benchmark_words=0)  # the way for a benchmark of any size
    assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect()))
    clean = drop_contaminated(frame, bench)
    assert clean.columns == frame.columns and {r["doc_id"] for r in clean.collect()} == {i for i, *_ in rows} - {i for i, _ in want}
    assert contamination(frame, bench.limit(0)).count() == 0 and contamination(docs([]), bench).count() == 0


def test_the_seed_filter_holds_every_seed(spark):
    from daybook.llm import decontaminate

    bits = decontaminate.FILTER_BITS
    firsts = [0, 1, 7, 32_767, 32_768, 32_769, 65_536, (1 << bits) - 1, 12_345_678]
    seeds = [x << (64 - bits) for x in firsts]
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in seeds], "seed long")
    held = np.unpackbits(decontaminate._seed_filter(df).value, bitorder="little")
    assert np.flatnonzero(held).tolist() == sorted(firsts) and len(held) == 1 << bits


def test_short_items_are_found_inside_longer_texts(docs, spark):
    bench = spark.createDataFrame([(1, "Who wrote the Iliad?"), (2, "one two three four five six seven"), (3, "yes")], "item_id long, text string")
    rows = [(1, "He asked: who wrote the ILIAD, and when?", "s"), (2, "who wrote the Iliad", "s"), (3, "who wrote an Iliad or so", "s"),
            (4, "zero one two three four five six seven eight yes yes", "s"), (5, "one two three four five six eight", "s")]
    want = {(1, 1, 4, 2, 6, True), (2, 1, 4, 0, 4, False), (4, 2, 7, 1, 8, True), (4, 3, 1, 9, 10, True)}
    for words in (2_000_000, 0):
        assert {tuple(r) for r in contamination(docs(rows), bench, benchmark_words=words).collect()} == want
    assert {r["doc_id"] for r in drop_contaminated(docs(rows), bench).collect()} == {1, 3, 4, 5}


def test_masks_survive_two_substitutions():
    for a, b in itertools.combinations(range(12), 2):
        assert any(m[a] == m[b] == "0" for m in MASKS) or b - a > 0  # some pairs need a shifted window
    spans = [{i for i, c in enumerate(m) if c == "1"} for m in MASKS]
    alone = [all(any(a not in s for s in spans) for a in range(12))]
    assert all(alone)


def test_best_stretch_matches_search():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randrange(1, 25)
        same = [draw.random() < 0.7 for _ in range(n)]
        x = np.arange(n)
        y = np.where(same, x, -1)
        got, i, j = best_stretch(x, y)
        value = lambda a, b: sum(1 if s else -2 for s in same[a:b])
        assert value(i, j) == max(value(a, b) for a in range(n) for b in range(a + 1, n + 1)) and got == sum(same[i:j])
    assert needed_words(36) == 13 and needed_words(10) == 7 and needed_words(1) == 1


def test_planted_secrets_are_found_in_other_documents(documents):
    """Secrets that no base pattern finds, behind hints the training never used, in texts it never saw."""
    from daybook.llm import secrets

    texts = [r["text"] for r in documents.orderBy("doc_id").collect()]
    model = fit_crf(training_sequences(texts[:100]))
    draw, leads = random.Random(11), secrets._LEADS
    try:
        secrets._LEADS = ("pin", "db login", "service auth", "my passphrase", "key material", "proxy pwd", "sess cookie")
        hidden = [secrets.planted(t or "", draw) for t in texts[100:] * 4]
    finally:
        secrets._LEADS = leads
    found = extra = 0
    for (text, hexes, tokens), (_, [(a, b)]) in zip(scan(pa.array([t for t, _ in hidden])), hidden, strict=True):
        own = [(x, y) for x, k, y in all_spans(model, text, hexes, tokens) if k == 3]
        whole = any(x <= a and b <= y for x, y in own)
        found += whole or any(k < 3 and x < b and a < y for x, k, y in all_spans(model, text, hexes, tokens))
        extra += sum(not (x < b and a < y) for x, y in own)
    assert found >= 0.9 * len(hidden) and extra <= 0.1 * found
