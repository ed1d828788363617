"""Secrets in texts: three fixed kinds by pattern, further ones by a character convolutional network.

The patterns' findings always stay.  Beyond them, every run of 16 or more characters of the secret
alphabet, and what is left of it beside the patterns' findings, is a candidate; a small convolutional network
in numpy reads the candidate and the characters around it and gives a calibrated probability.  A candidate
longer than the network's field is read by a field sliding over the whole of it.  What is at or above the
threshold is added as kind ``cnn``: the candidate, or the fields found in a longer one.

Labelled findings: the tables have no secret labels, so the network is trained on seeded, generated
findings of both classes (keys, tokens and digests of many formats in configuration, code, paths and prose,
against versions, dates, numbers, paths, identifiers, rules and long words), which are part of this module.
One part is held out to calibrate (Platt), another to set the threshold: of those whose recall is at least
``RECALL`` the one of the best precision, the lowest if several are; a secret that is no candidate counts as missed.

Defined results: null counts as empty; a text without findings has an empty span list and the digest of
the empty string; repeated rows are scanned one by one; an empty table gives an empty result; a null
doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import arrow_batches

KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"h{24,}")
CANDIDATE = re.compile(rb"s{16,}")
_HEX = bytes(104 if chr(c) in "0123456789abcdef" else 46 for c in range(256))
_RUN = bytes(115 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_.=-") else 32 for c in range(256))
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

LEAST = 16
#: Of which harmless long words are made.
SYLLABLES = (
    "the and ing ion er en ly ment th wh st nd ch sh ght tion ness able qu re an at or es is le la de une que ant eur eux ais oi ou eau "
    "der die das sch ung keit lich ein ver ge be auf aus los dos ado ita ción mente ero ar al ri ti no ma so ck ll ss tt nn rr"
).replace("ó", "o").split()
BEFORE, INSIDE, AFTER = 24, 56, 8
WIDTH = BEFORE + INSIDE + AFTER
EMBED, FILTERS, KERNEL, CLASSES = 6, 24, 5, 130
TRAIN, CALIBRATE, HELD, RECALL = 8000, 2000, 4000, 0.98


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' findings, in bytes."""
    out = []
    low = raw.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= 20]
    mask = raw.translate(_HEX)
    if b"h" * 24 in mask:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(mask)]
    return sorted(out)


def candidates(raw: bytes, taken: list[tuple[int, int]] = []) -> list[tuple[int, int]]:  # noqa: B006 - never changed
    """Runs of the alphabet without what is ``taken`` (sorted by start), marks at their ends stripped."""
    out, k = [], 0
    for m in CANDIDATE.finditer(raw.translate(_RUN)):
        s, e = m.span()
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        parts, j = [], k
        while j < len(taken) and taken[j][0] < e:
            parts.append((s, taken[j][0]))
            s, j = max(s, taken[j][1]), j + 1
        for s, e in (*parts, (s, e)):
            while s < e and raw[s] in b"._-/=+":
                s += 1
            while s < e and raw[e - 1] in b"._-/":
                e -= 1
            if e - s >= LEAST:
                out.append((s, e))
    return out


def fields(s: int, e: int) -> list[tuple[int, int]]:
    """The candidate, or fields that overlap by half and cover the whole of a longer one."""
    if e - s <= INSIDE:
        return [(s, e)]
    return [(i, i + INSIDE) for i in (*range(s, e - INSIDE, INSIDE // 2), e - INSIDE)]


def code(raw: bytes, s: int, e: int) -> np.ndarray:
    """Classes of the characters before, in and after a field; 0 pads, 129 is any other byte."""
    def classes(b: bytes) -> np.ndarray:
        return np.minimum(np.frombuffer(b, np.uint8).astype(np.int64), 128) + 1

    out = np.zeros(WIDTH, np.int64)
    left = classes(raw[max(0, s - BEFORE) : s])
    out[BEFORE - len(left) : BEFORE] = left
    out[BEFORE : BEFORE + e - s] = classes(raw[s:e])
    right = classes(raw[e : e + AFTER])
    out[BEFORE + INSIDE : BEFORE + INSIDE + len(right)] = right
    return out


class Network:
    """Embedding, one convolution with ReLU, largest and mean response inside and around, logistic output."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.emb = r.normal(0, 0.3, (CLASSES, EMBED))
        self.w = r.normal(0, 1 / math.sqrt(KERNEL * EMBED), (KERNEL * EMBED, FILTERS))
        self.b = np.zeros(FILTERS)
        self.v = r.normal(0, 0.1, 4 * FILTERS + 2)
        self.c = np.zeros(1)
        self.shift, self.slope, self.threshold = 0.0, 1.0, 0.5

    inner = slice(BEFORE - KERNEL // 2, BEFORE + INSIDE - KERNEL // 2)

    def forward(self, x: np.ndarray, keep: bool = False):
        n = len(x)
        e = self.emb[x]
        cols = np.lib.stride_tricks.sliding_window_view(e, KERNEL, axis=1).transpose(0, 1, 3, 2).reshape(n, -1, KERNEL * EMBED)
        a = np.maximum(cols @ self.w + self.b, 0)
        m = a[:, self.inner]
        real = (x[:, BEFORE : BEFORE + INSIDE] > 0)[:, :, None]
        size = np.maximum(real.sum(1), 1)
        mean = (m * real).sum(1) / size
        inside = x[:, BEFORE : BEFORE + INSIDE]
        digits = ((inside >= 49) & (inside <= 58)).sum(1) / size[:, 0]
        h = np.concatenate([m.max(1), mean, a[:, : BEFORE - 2].max(1), a[:, -AFTER + 2 :].max(1), size / INSIDE, digits[:, None]], axis=1)
        z = h @ self.v + self.c[0]
        return (z, cols, a, m, real, size, h) if keep else z

    def grads(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z, cols, a, m, real, size, h = self.forward(x, keep=True)
        d = (1 / (1 + np.exp(-z)) - y) / len(x)
        gv, gc = h.T @ d, np.asarray([d.sum()])
        gh = d[:, None] * self.v[None]
        ga = np.zeros_like(a)
        rows, f = np.arange(len(x))[:, None], np.arange(FILTERS)[None]
        ga[:, self.inner] += (gh[:, None, FILTERS : 2 * FILTERS] * real) / size[:, None]
        np.add.at(ga, (rows, self.inner.start + m.argmax(1), f), gh[:, :FILTERS])
        np.add.at(ga, (rows, a[:, : BEFORE - 2].argmax(1), f), gh[:, 2 * FILTERS : 3 * FILTERS])
        np.add.at(ga, (rows, a.shape[1] - AFTER + 2 + a[:, -AFTER + 2 :].argmax(1), f), gh[:, 3 * FILTERS : 4 * FILTERS])
        ga *= a > 0
        gw = np.einsum("nlk,nlf->kf", cols, ga, optimize=True)
        gcols = (ga @ self.w.T).reshape(len(x), -1, KERNEL, EMBED)
        ge = np.zeros((len(x), WIDTH, EMBED))
        for k in range(KERNEL):
            ge[:, k : k + gcols.shape[1]] += gcols[:, :, k]
        gemb = np.zeros_like(self.emb)
        np.add.at(gemb, x.ravel(), ge.reshape(-1, EMBED))
        gemb[0] = 0
        return [gemb, gw, ga.sum((0, 1)), gv, gc]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, size: int = 100, rate: float = 0.01) -> None:
        params = [self.emb, self.w, self.b, self.v, self.c]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        r, t = np.random.default_rng(9), 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), size):
                part, t = order[lo : lo + size], t + 1
                for p, g, a, b in zip(params, self.grads(x[part], y[part]), m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        z = self.forward(x)
        a, c = 1.0, 0.0
        for _ in range(50):  # Newton on Platt's two parameters
            p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
            g = np.asarray([((p - y) * z).sum() + 0.01 * (a - 1), (p - y).sum()])
            s = p * (1 - p)
            h = np.asarray([[(s * z * z).sum() + 0.01, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, c = a - step[0], c - step[1]
        self.slope, self.shift = a, c

    def set_threshold(self, found: list[tuple[bytes, int, int, bool]]) -> None:
        """Best precision among the thresholds that find a share of at least ``RECALL`` of the secrets; where the
        classes part, half way between the last harmless finding and the first secret above it."""
        p, y = self.best(found), np.asarray([f[3] for f in found])
        order = np.argsort(-p, kind="stable")
        p, y = p[order], y[order]
        hits = np.cumsum(y)
        last = np.append(p[:-1] > p[1:], True) & (p > 0)  # a threshold takes all findings of one probability
        fine = np.flatnonzero(last & (hits >= RECALL * y.sum()))
        if not len(fine):
            raise ValueError("the network finds too few secrets")
        at = max(fine, key=lambda k: (hits[k] / (k + 1), k))
        self.threshold = float(p[at] + (p[at + 1] if at + 1 < len(p) else 0.0)) / 2

    def best(self, found: list[tuple[bytes, int, int, bool]]) -> np.ndarray:
        """The highest probability of a field that overlaps each finding; 0 without one."""
        owners, rows = [], []
        for k, (raw, lo, hi, _) in enumerate(found):
            for s, e in (f for c in candidates(raw) for f in fields(*c)):
                if min(e, hi) - max(s, lo) >= LEAST // 2:
                    owners.append(k)
                    rows.append(code(raw, s, e))
        out = np.zeros(len(found))
        for lo in range(0, len(rows), 2000):
            np.maximum.at(out, owners[lo : lo + 2000], self.probability(np.asarray(rows[lo : lo + 2000])))
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.forward(x) + self.shift, -30, 30)))


def findings(n: int, seed: int) -> list[tuple[bytes, int, int, bool]]:
    """Seeded findings of both classes: text, start and end in it, whether it is a secret."""
    r = random.Random(seed)
    letters, digits = string.ascii_letters, string.digits
    alnum, b64, up = letters + digits, letters + digits + "+/", string.ascii_uppercase + digits

    def pick(alphabet: str, lo: int, hi: int) -> str:
        return "".join(r.choices(alphabet, k=r.randint(lo, hi)))

    def word(lo: int = 2, hi: int = 10) -> str:
        v, c = r.choice((("aeiou", "bcdfghklmnprstvwz"), ("aeiouéü", "bcdfghjklmnpqrstvwxyz")))
        return "".join(r.choice(c if i % 2 else v) for i in range(r.randint(lo, hi)))

    def spoken(lo: int, hi: int) -> str:
        n, out = r.randint(lo, hi), ""
        while len(out) < n:
            out += r.choice(SYLLABLES)
        return out[:n]

    def words(k: int) -> str:
        return " ".join(r.choice((word, spoken))(2, 10) for _ in range(k))

    def joined(mark: str, lo: int, hi: int, case: object = str) -> str:
        return mark.join(case(word(2, 9)) for _ in range(r.randint(lo, hi)))  # type: ignore[operator]

    secret = (
        lambda: pick(alnum, 20, 64), lambda: pick(b64, 24, 88) + r.choice(["", "=", "=="]), lambda: pick("0123456789ABCDEF", 24, 64),
        lambda: "ghp_" + pick(alnum, 36, 36), lambda: "sk_live_" + pick(alnum, 24, 32), lambda: "xoxb-" + pick(digits, 10, 12) + "-" + pick(alnum, 20, 28),
        lambda: "eyJ" + pick(alnum, 20, 40) + "." + pick(alnum + "_-", 20, 60) + "." + pick(alnum + "_-", 20, 43),
        lambda: "AIza" + pick(alnum + "_-", 35, 35), lambda: "glpat-" + pick(alnum + "_-", 20, 20), lambda: pick(up, 20, 40), lambda: "SG." + pick(alnum + "_-", 22, 22) + "." + pick(alnum + "_-", 43, 43),
        lambda: pick(letters, 20, 48), lambda: pick(b64, 100, 400),
    )
    around_secret = ('{w} key = "', "{w} Authorization: Bearer ", "export CREDENTIAL='", '"auth": "', "{w} private key ", "client {w}: ", "{w} credential ", "{w} {w} ", "--key ")
    # a secret at the end of, or inside, a longer run
    within = ("https://{w}.example/{w}/{w}/", "/{w}/{w}/{w}/{w}/{w}/{w}/{w}/", "callback/{w}/key=", "{w}.{w}.{w}-")
    harmless = (
        lambda: f"{r.randint(1, 30)}.{r.randint(0, 99)}.{r.randint(0, 999)}-{word(3, 6)}-{word(4, 9)}.{r.randint(1, 9)}",
        lambda: pick(digits, 16, 20), lambda: f"20{r.randint(10, 30)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T0{r.randint(0, 9)}.15.30.000",
        lambda: joined("/", 3, 6) + f"/{r.randint(1, 999)}", lambda: f"{word(3, 8)}.{word(3, 8)}{r.randint(1, 99)}.example.com",
        lambda: f"{word(4, 9)}_{word(4, 9)}_{word(3, 9)}{r.randint(0, 99)}", lambda: word(14, 20) + str(r.randint(0, 99)), lambda: f"{word(5, 9).upper()}-{word(5, 9).upper()}-{r.randint(100, 9999)}",
        lambda: ".".join(str(r.randint(0, 999)) for _ in range(r.randint(5, 7))), lambda: "=" * r.randint(8, 20) + str(r.randint(1, 9)) + "=" * 8, lambda: f"{word(4, 8)}-{word(4, 8)}-{word(4, 8)}-{r.randint(1, 2030)}.html",
        lambda: "abcdefghijklmnop"[: r.randint(14, 16)] + "123", lambda: pick("01", 16, 40),
        lambda: word(16, 34), lambda: word(16, 24).capitalize(), lambda: word(16, 24).upper(), lambda: joined("-", 3, 7), lambda: joined("/", 3, 24), lambda: joined(".", 3, 6), lambda: joined("_", 3, 8),
        lambda: joined("", 3, 6, str.capitalize), lambda: r.choice("=-_.+/") * r.randint(16, 120), lambda: r.choice(("=-", "-.", "+-", "ab", "la", "ha")) * r.randint(8, 60), lambda: joined("...", 2, 5), lambda: joined("--", 2, 4),
        lambda: word(1, 2)[0] * r.randint(16, 60), lambda: spoken(16, 40), lambda: spoken(16, 40), lambda: spoken(16, 30).upper(), lambda: spoken(16, 30).capitalize(), lambda: pick(string.ascii_lowercase, 16, 40),
        lambda: pick(string.ascii_uppercase, 16, 30), lambda: spoken(4, 9) + r.choice("-/.=_") + spoken(12, 20), lambda: spoken(6, 12).capitalize() + spoken(10, 20), lambda: spoken(16, 30) + str(r.randint(0, 9999)), lambda: spoken(2, 9).upper() + spoken(14, 24),
    )
    around_harmless = ("{w} {w} {w} ", "{w} version ", "https://{w}.example/", "{w}, {w} ", "file {w} ", "{w}: ", "{w} number ", "see {w} (", "")
    out = []

    def filled(t: str) -> str:
        while "{w}" in t:
            t = t.replace("{w}", word(), 1)
        return t

    while len(out) < n:
        y = r.random() < 0.5
        body = r.choice(secret if y else harmless)()
        before = words(r.randint(0, 4)) + " " + filled(r.choice(within if y and r.random() < 0.15 else around_secret if y else around_harmless))
        raw = (before + body + r.choice(['"', "'", " ", ",", ".", "\n", ")", ""]) + " " + words(3)).encode()
        at = len(before.encode())
        out.append((raw, at, at + len(body.encode()), y))
    return out


def labelled_fields(found: list[tuple[bytes, int, int, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """(character classes, label) of the fields of all candidates of the findings' texts; fields that hold a
    part of a secret too small to tell are left out."""
    xs, ys = [], []
    for raw, lo, hi, y in found:
        for s, e in (f for c in candidates(raw) for f in fields(*c)):
            both = min(e, hi) - max(s, lo)
            if not y or both <= 0 or both >= LEAST // 2:
                xs.append(code(raw, s, e))
                ys.append(y and both > 0)
    return np.asarray(xs), np.asarray(ys, float)


@cache
def network() -> Network:
    """The trained, calibrated network; the same on every call and machine."""
    found = findings(TRAIN + CALIBRATE + HELD, seed=17)
    net = Network()
    net.fit(*labelled_fields(found[:TRAIN]))
    net.calibrate(*labelled_fields(found[TRAIN : TRAIN + CALIBRATE]))
    net.set_threshold(found[TRAIN + CALIBRATE :])
    return net


def scan(raws: list[bytes], net: Network) -> list[list[tuple[int, int, int, float]]]:
    """Per text (start, kind, end, probability) in bytes; patterns' findings have probability 1."""
    out: list[list] = []
    where, rows = [], []

    def judge() -> None:
        hit: dict[tuple, list] = {}
        for (k, c, s, e), q in zip(where, net.probability(np.asarray(rows)) if rows else ()):
            if q >= net.threshold:
                hit.setdefault((k, c), []).append((s, e, float(q)))
        for (k, _), own in hit.items():
            s, e, q = own[0]
            for a, b, p in own[1:]:
                if a > e:
                    out[k].append((s, 3, e, q))
                    s, q = a, p
                e, q = b, max(p, q)
            out[k].append((s, 3, e, q))
        where.clear()
        rows.clear()

    for k, raw in enumerate(raws):
        base = base_spans(raw)
        out.append([(s, kind, e, 1.0) for s, kind, e in base])
        for c in candidates(raw, [(s, e) for s, _, e in base]):
            own = fields(*c)
            for lo in range(0, len(own), 2000):
                where += [(k, c, s, e) for s, e in own[lo : lo + 2000]]
                rows += [code(raw, s, e) for s, e in own[lo : lo + 2000]]
        if len(rows) >= 2000:
            judge()
    judge()
    return [sorted(o) for o in out]


def _points(raw: bytes, spans: list) -> list[tuple[int, int, int]]:
    """Byte spans as (start, kind, end) in code points."""
    if not spans:
        return []
    if raw.isascii():
        return [(s, k, e) for s, k, e, _ in spans]
    marks = sorted({x for s, _, e, _ in spans for x in (s, e)})
    at, last, n = {}, 0, 0
    for m in marks:
        n += len(raw[last:m].decode("utf-8"))
        at[m], last = n, m
    return [(at[s], k, at[e]) for s, k, e, _ in spans]


def secrets(df: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_cnn."""
    slim = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    net = network()
    schema = T.StructType([
        slim.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_cnn", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = b.column("text").to_pylist()
            cols: list[list] = [[] for _ in range(6)]
            for raw, found in zip(raws, scan(raws, net)):
                points = _points(raw, found)
                for k in range(3):
                    cols[k].append(sum(x[1] == k for x in points))
                base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in points if k < 3)
                cols[3].append(hashlib.sha256(base.encode()).hexdigest())
                cols[4].append(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in points))
                cols[5].append(sum(x[1] == 3 for x in points))
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]], schema.names)

    return arrow_batches(slim).mapInArrow(run, schema)


def redact(df: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The rows with every finding in ``text`` replaced by ``mask``; overlapping findings are one."""
    net, names, at = network(), [f"c{i}" for i in range(len(df.columns))], df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            given = b.column(at).to_pylist()
            raws = [(t or "").encode() for t in given]
            texts = []
            for t, raw, found in zip(given, raws, scan(raws, net)):
                out, last = [], 0
                for s, _, e, _ in found:
                    if s >= last:
                        out += [raw[last:s], mask.encode()]
                    last = max(last, e)
                texts.append(b"".join([*out, raw[last:]]).decode() if found else t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)], names)

    inner = arrow_batches(df).toDF(*names)
    return inner.mapInArrow(run, inner.schema).toDF(*df.columns)
