"""Secret scans (9): fixed patterns, and a linear-chain conditional random field.

The base patterns find assignments, access keys and hexadecimal runs. The CRF
tags tokens as begin, inside or outside of a secret from their shape, the words
beside them and features of the file, and is decoded by Viterbi; its spans are
added where no base span is. Tokens are runs of ``[A-Za-z0-9+/_.=-]``, and a
chain has those of a line. Part of a secret can be every token that follows a
hint word, an assignment mark or a quote, that changes case twice, or that has
16 characters, or eight and a digit or one of ``+/_=``. All others are fixed to
outside, in training and decoding alike; what stands between two free tokens
then counts as one outside token, which changes no path and no likelihood.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import bounded_sample, stored
from daybook.llm.words import text_slices

KINDS = ("assign", "access", "hex", "crf")
_ANY_CASE = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
ASSIGN = re.compile(rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Texts that the CRF is fitted on: so many that hold a long run with a digit, and half as many others,
#: each of at most so many characters (a bound of the sample; texts of any length are scanned whole).
TRAIN_TEXTS = 1000
TRAIN_CHARS = 20_000
EPOCHS = 8

_HEX = np.zeros(256, dtype=bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_VALUE = np.zeros(256, dtype=bool)
_VALUE[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_STRONG = np.zeros(256, dtype=bool)
_STRONG[[ord(c) for c in "0123456789+/_="]] = True
_QUOTE = np.zeros(256, dtype=bool)
_QUOTE[[ord(c) for c in "\"'`"]] = True
_ALNUM = _VALUE.copy()
_ALNUM[[ord(c) for c in "+/_.=-"]] = False
_HINTS = (
    "password", "passwd", "passphrase", "pass", "pwd", "secret", "token", "key", "apikey", "api_key", "auth", "authorization", "bearer", "credential", "credentials", "creds",
    "private", "login", "signature", "session", "cookie", "license",
)


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the maximal runs of at least ``least`` marked bytes inside one text."""
    n = len(mask)
    padded = np.zeros(n + 2, dtype=bool)
    padded[1:-1] = mask
    begins, ends = padded[1:] & ~padded[:-1], padded[:-1] & ~padded[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts], ends[cuts] = padded[1:][cuts], padded[:-1][cuts]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    long = stops - starts >= least
    return starts[long], stops[long]


_HINT_WORD = re.compile(rb"(?<![A-Za-z])(?:" + "|".join(sorted(_HINTS, key=len, reverse=True)).encode() + rb")(?![A-Za-z])")


def _free_tokens(data: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the value runs ``a .. b`` can be part of a secret."""
    def total(mask):
        return np.concatenate([[0], np.cumsum(mask)])

    if not len(a):
        return np.zeros(0, dtype=bool)
    size, at = b - a, np.arange(len(data))
    strong, alnum = total(_STRONG[data]), total(_ALNUM[data])
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    humps = total(np.append(lower[:-1] & upper[1:], False))
    text_start = offsets[np.searchsorted(offsets, a, side="right") - 1]
    # The last byte before a token that is neither blank nor quote, and the start of its line.
    before = np.maximum.accumulate(np.where((data != 32) & ~_QUOTE[data], at, -1))[np.maximum(a - 1, 0)]
    assigned = (before >= text_start) & (a > text_start) & ((data[before] == ord(":")) | (data[before] == ord("=")))
    quote = (a > text_start) & _QUOTE[data[np.maximum(a - 1, 0)]]
    quoted = quote & ~((a - 1 > text_start) & _ALNUM[data[np.maximum(a - 2, 0)]])
    line_start = np.maximum(np.maximum.accumulate(np.where(data == 10, at + 1, 0))[np.maximum(a - 1, 0)], text_start)
    low = np.where(upper, data + 32, data).astype(np.uint8).tobytes()
    ends = np.array([-100] + [m.end() for m in _HINT_WORD.finditer(low)], dtype=np.int64)
    last = ends[np.searchsorted(ends, a, side="right") - 1]
    hinted = (last >= line_start) & (a - last <= 40)
    long = (size >= 8) & (strong[b] > strong[a]) | (size >= 16) | (humps[np.maximum(b - 1, 0)] - humps[a] >= 2)
    return (alnum[b] > alnum[a]) & (long | assigned | quoted | hinted)


def scan(column: pa.Array) -> Iterator[tuple[str, list, list]]:
    """``(text, hex runs, free tokens)`` of every row; spans count code points."""
    texts = column.to_pylist()
    for first, data, offsets in text_slices(column):
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        found = []
        for kind, mask, least in ((0, _HEX, 16), (1, _VALUE, 1)):
            a, b = _runs(mask[data], offsets, least)
            if kind:
                held = _free_tokens(data, offsets, a, b)
                a, b = a[held], b[held]
            text_of = np.searchsorted(offsets, a, side="right") - 1
            base = points[offsets[text_of]]
            found.append((np.searchsorted(text_of, np.arange(len(offsets))), points[a] - base, points[b] - base))
        for i in range(len(offsets) - 1):
            spans = [list(zip(a[at[i] : at[i + 1]].tolist(), b[at[i] : at[i + 1]].tolist(), strict=True)) for at, a, b in found]
            yield texts[first + i] or "", *spans


def base_spans(text: str, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, sorted."""
    spans = [(a, 2, b) for a, b in hex_runs]
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return sorted(spans)


def _shape(token: str) -> str:
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^aA9]", "s", re.sub(r"[0-9]", "9", re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", token)))))


def file_features(text: str, n_tokens: int) -> list[str]:
    """Marks of code, tables and assignments anywhere in the text."""
    return [
        f"f:assigns={min(3, text.count(' = '))}",
        f"f:table={' | ' in text}",
        f"f:many={min(4, n_tokens.bit_length())}",
        f"f:code={'{' in text or ';' in text}",
    ]


def token_features(text: str, a: int, b: int, file: list[str]) -> list[str]:
    """Shape of the token, the words and marks beside it, and the file's features."""
    t = text[a:b]
    counts = [t.count(c) for c in set(t)]
    entropy = -sum(c / len(t) * math.log2(c / len(t)) for c in counts)
    shape = _shape(t)
    before, after = text[max(0, a - 40) : a], text[b : b + 40]
    words = re.findall(r"[^\W\d_]+(?:_[^\W\d_]+)*", before.lower())
    digits = sum(c.isdigit() for c in t)
    mark = before.rstrip(" ")[-1:]
    kind = ("a" if re.search("[a-z]", t) else "") + ("A" if re.search("[A-Z]", t) else "") + ("9" if digits else "") + ("s" if re.search(r"[+/_=.-]", t) else "")
    near = any(w in _HINTS for w in words[-3:])
    return [
        "bias", f"kind={kind}", f"len={min(12, len(t) // 4)}", f"ent={int(entropy * 2)}", f"dig={digits * 4 // len(t)}",
        f"shape={shape[:6]}", f"changes={min(8, len(shape) // 3)}", f"hex={not t.strip('0123456789abcdefABCDEF')}",
        f"kind,ent={kind},{int(entropy)}", f"dot={'.' in t}", f"mark={mark if mark in ':=' and mark else mark in chr(34) + chr(39) and 'q' or '-'}",
        f"quoted={before[-1:] in ('\"', chr(39)) and after[:1] in ('\"', chr(39))}", f"hint={near}", f"hint,ent={near},{int(entropy)}",
        f"at={'@' in (before[-1:], after[:1])}", f"next={after[:1] if after[:1] in '@%(' and after[:1] else '-'}", *file,
    ]


_WORD = re.compile(r"[A-Za-z0-9]")
_WORD_OR_END = re.compile(r"[A-Za-z0-9\n]")


def chains(text: str, tokens: list[tuple[int, int]]) -> list[list[tuple[int, int] | None]]:
    """Free tokens, trimmed, line by line; None stands for the outside tokens before, between and after them."""
    out: list[list[tuple[int, int] | None]] = []
    end = -1

    def close() -> None:
        if out and (m := _WORD_OR_END.search(text, end)) and m.group(0) != "\n":
            out[-1].append(None)

    for a, b in tokens:
        while b > a and text[b - 1] in ".-":
            b -= 1
        while a < b and text[a] in ".-=":
            a += 1
        if a == b:
            continue
        if not out or text.find("\n", end, a) >= 0:
            close()
            out.append([])
            end = text.rfind("\n", 0, a) + 1
        if _WORD.search(text, end, a):
            out[-1].append(None)
        out[-1].append((a, b))
        end = b
    close()
    return out


#: Score of the tags of outside tokens.
_OUTSIDE = np.array([0.0, -1e6, -1e6])


@dataclass
class Crf:
    """Weights of a three-tag chain: 0 outside, 1 begin, 2 inside (only after begin or inside)."""

    weights: dict[str, np.ndarray]
    moves: np.ndarray  # from tag (row 3: the start) to tag

    def emissions(self, features: list[list[str] | None]) -> np.ndarray:
        zero = np.zeros(3)
        return np.array([_OUTSIDE if fs is None else np.sum([self.weights.get(f, zero) for f in fs], axis=0) for fs in features])

    def decode(self, features: list[list[str] | None]) -> list[int]:
        """Viterbi; a token without features is outside."""
        e = self.emissions(features)
        best, back = self.moves[3] + e[0], []
        for x in e[1:]:
            all_ = best[:, None] + self.moves[:3]
            back.append(all_.argmax(axis=0))
            best = all_.max(axis=0) + x
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_crf(sequences: list[tuple[list[list[str] | None], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by gradient steps (Adagrad, weight decay) over the sequences, in a fixed order."""
    number: dict[str, int] = {}
    numbered = [([None if fs is None else np.array([number.setdefault(f, len(number)) for f in dict.fromkeys(fs)]) for fs in features], tags) for features, tags in sequences]
    weights, sums = np.zeros((len(number), 3)), np.full((len(number), 3), 1e-6)
    moves = np.zeros((4, 3))
    moves[3, 2] = moves[0, 2] = -1e6  # inside needs a begin
    move_sum = np.full((4, 3), 1e-6)
    free = moves > -1e5
    order = list(range(len(sequences)))
    shuffle = random.Random(9)
    for _ in range(epochs):
        shuffle.shuffle(order)
        for i in order:
            features, tags = numbered[i]
            e, n = np.array([_OUTSIDE if fs is None else weights[fs].sum(axis=0) for fs in features]), len(tags)
            forward, backward = [moves[3] + e[0]], [np.zeros(3)]
            for x in e[1:]:
                forward.append(_logsum(forward[-1][:, None] + moves[:3], 0) + x)
            for x in e[:0:-1]:
                backward.append(_logsum(moves[:3] + x + backward[-1], 1))
            backward.reverse()
            whole = _logsum(forward[-1], 0)
            step = np.zeros((4, 3))
            for k in range(n):
                push = -np.exp(forward[k] + backward[k] - whole)
                push[tags[k]] += 1
                if (fs := features[k]) is not None:
                    g = push - decay * weights[fs]
                    sums[fs] += g * g
                    weights[fs] += rate * g / np.sqrt(sums[fs])
                if k == 0:
                    step[3] += push
                else:
                    pair = np.exp(forward[k - 1][:, None] + moves[:3] + e[k] + backward[k] - whole)
                    step[:3] -= pair
                    step[tags[k - 1], tags[k]] += 1
            move_sum += step * step
            moves[free] += (rate * step / np.sqrt(move_sum))[free]
    return Crf({f: weights[i] for f, i in number.items()}, moves)


_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789ABCDEF")
#: What a planted secret follows, and what marks may stand between; none is a key word of the base patterns.
_LEADS = ("pwd", "passphrase", "login", "auth", "bearer", "credential", "private key", "access key", "db_pass", "signing key", "Authorization: Bearer", "session", "creds")
_MARKS = (" ", ": ", " = ", "=", " => ", " is ")


def random_secret(draw: random.Random) -> str:
    """A value as services issue them: one alphabet, a prefix and a value, or parts joined by dots."""
    def run(least: int, most: int, letters: str | None = None) -> str:
        letters = letters or draw.choice(_ALPHABETS)
        return "".join(draw.choice(letters) for _ in range(draw.randrange(least, most)))

    kind = draw.randrange(5)
    if kind == 0:
        return run(2, 5, _ALPHABETS[4]).lower() + draw.choice("_-") + run(16, 40, _ALPHABETS[1])
    if kind == 1:
        return ".".join(run(16, 40, _ALPHABETS[1]) for _ in range(3))
    if kind == 2:
        return run(10, 20, _ALPHABETS[1] + "_-+")
    return run(16, 56, draw.choice(_ALPHABETS[1:]))


def look_alike(draw: random.Random) -> str:
    """A token that is no secret: an identifier, a path, a number, a date, a plain word after a hint."""
    words = ["".join(draw.choice(("an", "ber", "cos", "du", "el", "for", "gi", "ho", "in", "ka", "lo", "mi", "nen", "or", "pe", "ra", "si", "tu")) for _ in range(draw.randrange(1, 4))) for _ in range(3)]
    number = str(draw.randrange(10, 10**draw.randrange(2, 10)))
    return draw.choice((
        words[0] + words[1].title() + words[2].title(), "_".join(words), "_".join(words).upper(), "/".join(words) + ".txt", "-".join((words[0].upper()[:3], "2024", number)),
        f"{draw.randrange(1990, 2030)}-{draw.randrange(10, 13)}-{draw.randrange(10, 29)}", f"{words[0]}.{words[1]}.com/{words[2]}/{number}", number, f"{number}.{draw.randrange(99)}",
        f"{draw.choice(_LEADS)}{draw.choice(_MARKS)}{words[0]}", f"{words[0]} = {draw.choice(chr(34) + chr(39))}{words[1]} {words[2]}{chr(34)}", "".join(words).title(), words[0] + number, f"v{draw.randrange(9)}.{number[:2]}",
    ))


def planted(text: str, draw: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """``text`` with a secret and two look-alikes put between its words, and the secret's span.

    The secret follows a hint, stands in quotes after a name and an assignment mark, between a user and a
    host, or alone.
    """
    value, quote = random_secret(draw), draw.choice(("", "", '"', "'"))
    name = f"{draw.choice(('cfg', 'db', 'svc', 'app', 'client'))}_{draw.choice(('id', 'value', 'param', 'conf', 'x'))}"
    lead, tail = draw.choice((
        (draw.choice(_LEADS) + draw.choice(_MARKS) + quote, quote), (draw.choice(_LEADS) + draw.choice(_MARKS) + quote, quote),
        (f'{name}{draw.choice((" = ", ": ", "="))}"', '"'), (f"{draw.choice(('https', 'amqp', 'ftp'))}://{name}:", "@host.example"), ("", ""),
    ))
    if not lead:
        value += "".join(draw.choice(_ALPHABETS[2]) for _ in range(max(0, 24 - len(value))))
    places = [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
    for _ in range(2):
        at = draw.choice(places)
        text = f"{text[:at]} {look_alike(draw)}{text[at:]}"
        places = [m.start() for m in re.finditer(r"\s", text)]
    at = draw.choice(places)
    start = at + 1 + len(lead)
    return f"{text[:at]} {lead}{value}{tail}{text[at:]}", [(start, start + len(value))]


def training_sequences(texts: list[str | None]) -> list[tuple[list[list[str] | None], list[int]]]:
    """Chains of the texts, tagged by the base patterns, and chains of the texts with planted secrets.

    An assignment is met once as it stands and once with its value redrawn from another alphabet
    and its key word replaced, and every text once with a secret in it that the base patterns do not
    find and with tokens that only look like one (:func:`planted`), so that the field learns shape and
    neighbours, not the patterns.
    Of an assignment the value is tagged. Digit runs alone that the hex pattern takes (card numbers
    among them) teach nothing and count as outside tokens.
    """
    draw = random.Random(7)
    out = []

    def add(text: str, hex_runs, tokens, more=()) -> None:
        spans = [(a, b) for a, kind, b in base_spans(text, hex_runs) if kind] + list(more)
        spans += [m.span(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
        file = file_features(text, len(tokens))
        for chain in chains(text, tokens):
            tags: list[int] = []
            chain = [None if t and text[t[0] : t[1]].isdigit() and any(x < t[1] and t[0] < y for x, y in spans) else t for t in chain]
            for k, t in enumerate(chain):
                own = [s for s in spans if t and s[0] < t[1] and t[0] < s[1]]
                goes_on = k > 0 and tags[-1] and any(x < chain[k - 1][1] for x, _ in own)
                tags.append((2 if goes_on else 1) if own else 0)
            out.append(([t and list(map(sys.intern, token_features(text, *t, file))) for t in chain], tags))

    def redrawn(text: str) -> str:
        def change(m: re.Match) -> str:
            letters = draw.choice(_ALPHABETS)
            value = "".join(draw.choice(letters) for _ in range(draw.randrange(16, 48)))
            return m.group(0)[: m.start(1) - m.start()] + draw.choice(("secret", "api_key", "password", "token")) + m.group(0)[m.end(1) - m.start() : m.start(2) - m.start()] + value
        return ASSIGN.sub(change, text)

    for text, hex_runs, tokens in scan(pa.array(texts, pa.large_string())):
        add(text, hex_runs, tokens)
    again = [redrawn(t) for t in texts if t and ASSIGN.search(t)]
    for text, hex_runs, tokens in scan(pa.array(again, pa.large_string())):
        add(text, hex_runs, tokens)
    hidden = [planted(t or "", draw) for t in texts]
    for (text, hex_runs, tokens), (_, spans) in zip(scan(pa.array([t for t, _ in hidden], pa.large_string())), hidden, strict=True):
        add(text, hex_runs, tokens, spans)
    return out


def all_spans(model: Crf, text: str, hex_runs, tokens) -> list[tuple[int, int, int]]:
    """Base spans, and those of the field that overlap none of them: ``(start, kind, end)``."""
    spans = base_spans(text, hex_runs)
    file = file_features(text, len(tokens))
    more = []
    for chain in chains(text, tokens):
        tags = model.decode([t and token_features(text, *t, file) for t in chain])
        for t, tag in zip(chain, tags, strict=True):
            if tag == 1:
                more.append([*t])
            elif tag == 2:
                more[-1][1] = t[1]
    spans += [(a, 3, b) for a, b in more if not any(x < b and a < y for x, _, y in spans)]
    return sorted(spans)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_texts: int = TRAIN_TEXTS) -> Crf:
    """The field, fitted on a bounded sample: the ``train_texts`` texts with the smallest digests (of id
    and text) among those with a run of 16 letters and digits that has a digit, and half as many others.
    Only texts of at most ``TRAIN_CHARS`` characters are taken, so the bytes collected are bounded too."""
    docs = docs.where(F.length(text_col) <= TRAIN_CHARS)
    likely = F.coalesce(F.col(text_col).rlike("[A-Za-z0-9]{0,40}[0-9][A-Za-z0-9]{15}"), F.lit(False))
    at = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.xxhash64(text_col).cast("string")))
    keys = stored(docs.select(at.alias("at"), likely.alias("likely")), "keys")
    taken = bounded_sample(keys.where("likely"), "at", train_texts).unionByName(bounded_sample(keys.where("NOT likely"), "at", train_texts // 2))
    taken = F.broadcast(stored(taken.select("at"), "taken"))  # at most 1.5 train_texts rows
    texts = docs.select(at.alias("at"), F.col(text_col).alias("text")).join(taken, "at").dropDuplicates(["at"])
    return fit_crf(training_sequences([r[1] for r in sorted(texts.collect(), key=lambda r: r[0])]))


def _span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Crf | None = None) -> DataFrame:
    """Per row: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``, ``redacted``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. ``redacted``: the
    text with every span as ``<SECRET>`` (null where there is none). A null text is empty; equal rows all come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, id_col, text_col))
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                out = []
                for text, hex_runs, tokens in scan(part.column(1)):
                    spans = all_spans(shared.value, text, hex_runs, tokens)
                    n = [sum(k == i for _, k, _ in spans) for i in range(3)]
                    base = _span_text([x for x in spans if x[1] < 3])
                    out.append((*n, hashlib.sha256(base.encode()).hexdigest(), _span_text(spans), redact(text, spans) if spans else None))
                types = [pa.int64()] * 3 + [pa.string()] * 3
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True))],
                    names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"],
                )

    schema = f"id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(rows, schema).withColumnRenamed("id", id_col)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "<SECRET>") -> str:
    """``text`` with every span replaced; overlapping and touching spans become one."""
    out, at = [], 0
    for a, _, b in spans:
        if not out or a > at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, secrets replaced in the text; ``chars_col`` (if there) follows."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col))
    names = docs.columns
    at, chars = names.index(text_col), names.index(chars_col) if chars_col in names else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                columns = list(part.columns)
                new = []
                for text, hex_runs, tokens in scan(columns[at]):
                    spans = all_spans(shared.value, text, hex_runs, tokens)
                    new.append(redact(text, spans) if spans else None)
                if chars is not None:
                    was = columns[chars].to_pylist()
                    columns[chars] = pa.array([w if r is None else len(r) for w, r in zip(was, new, strict=True)], columns[chars].type)
                columns[at] = pa.array([t if r is None else r for t, r in zip(columns[at].to_pylist(), new, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(rows, docs.schema)
