"""Personal data: plain patterns, then candidates judged by boosted trees.

The plain patterns' spans always stay.  Generators with high recall propose further,
overlapping spans; gradient-boosted trees judge each by its format and the words
around it; calibrated thresholds, one for each kind, select.  The trees learn from a
small labelled table made from templates (no row of the corpus).
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import vector_udf

KINDS = ("email", "ip", "card", "phone")

# --- plain patterns ---------------------------------------------------------------
# The contract's patterns; possessive repeats and a digit check before them keep the
# same matches but never try a run of digits twice.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: '@' is in no local part, so each one is tried once, with the run of
    local characters before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The plain patterns' spans by start, then kind."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


# --- candidates -------------------------------------------------------------------
_MORE = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}+ ?(?:\(at\)|\[at\]|\{at\}|@| at ) ?[A-Za-z0-9-]{1,63}+"
                         r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.| dot ) ?[A-Za-z0-9-]{1,63}+)+")),
    ("ip", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,2}(?![\w:.])")),
    ("card", re.compile(r"(?<![\w.])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{3,4}(?![\w.])")),
    ("phone", re.compile(r"(?<![\w./-])\(?0?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{2,4}[ ./-][0-9]{2,5}(?:[ ./-][0-9]{2,4})?(?![\w/-])")),
    ("ip", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:])")),
    ("phone", re.compile(r"(?<![\w.+/-])(?:00[1-9][0-9]{7,12}|1?[2-9][0-9]{9}|0[1-9][0-9]{7,10})(?![\w-])")),  # no separators
    ("phone", re.compile(r"(?<![\w./-])00[1-9][0-9]{0,2}(?:[ ./-][0-9]{1,8}){2,5}(?![\w/-])")),
    ("phone", re.compile(r"(?<![\w./-])\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{5,8}(?![\w/-])")),
    ("phone", re.compile(r"(?<![\w./-])1[ .-]\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w/-])")),
    ("phone", re.compile(r"(?<![\w./-])0[1-9](?:[ .-][0-9]{2}){4}(?![\w/-])")),
)
_MAIL_HINT = re.compile(r"@|[(\[{]at[)\]}]| dot ")
_CONTEXT = (  # fixed values: words that speak for a kind, and against all
    ("mail", "email", "write", "reach", "contact"), ("ip", "host", "server", "address", "ping", "ssh", "login"),
    ("card", "visa", "mastercard", "amex", "credit", "payment", "paid"), ("phone", "tel", "call", "fax", "mobile", "cell", "dial"),
    ("version", "order", "invoice", "isbn", "ref", "build", "page", "serial", "date", "time", "sku", "release", "section", "score"),
)


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans of high recall, overlapping ones too, of one kind as well; each span once."""
    out: dict = {}
    digits = _DIGIT.search(text) is not None
    for kind, pattern in _MORE:
        if _MAIL_HINT.search(text) if kind == "email" else digits or (kind == "ip" and "::" in text):
            out |= dict.fromkeys((kind, m.start(), m.end()) for m in pattern.finditer(text))
    return [*out]


_GOES_ON = re.compile(r"[ ./:-]?[0-9]").match  # more digits behind a span
_CLOCK = re.compile(r":[0-9]{2}(?![0-9])").match  # a time of day that began in the span
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:19|20)[0-9]{2}"
_DATED = re.compile(rf"(?:{_YEAR}([ ./-]){_MONTH}\1{_DAY}|{_DAY}([ ./-]){_MONTH}\2{_YEAR})(?![0-9])").match


def span_features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, and the words around it."""
    span = text[start:end]
    before = re.findall(r"[a-z]+", text[max(0, start - 40):start].lower())[-4:]
    digits = "".join(c for c in span if c.isdigit())
    groups = re.findall(r"[0-9]+", span)
    top = span.rsplit(".", 1)[-1].rsplit(" ", 1)[-1]
    return [
        *(float(kind == k) for k in KINDS), len(span), len(digits), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), float(bool(digits) and luhn(digits)), len(set(digits)),
        *(float(any(w in words for w in before)) for words in _CONTEXT),
        span.count("-"), span.count("."), span.count(" "), span.count(":"), span.count("/"), float("(" in span),
        float("@" in span), float(" at " in span), float("[" in span or "{" in span), len(top), float(top.isalpha()),
        float(groups[:1] != [] and len(groups[0]) == 4 and groups[0][:2] in ("19", "20")),
        float(any(c in "abcdefABCDEF" for c in span)), float(span[:1] == "0"),
        float(span[:2] == "00"), float("::" in span), float(_GOES_ON(text, end) is not None),
        float(_CLOCK(text, end) is not None), float(_DATED(span) is not None),
    ]


# --- boosted trees ----------------------------------------------------------------
@dataclass
class Trees:
    """Trees of depth up to three on numeric features, boosted for the logistic loss."""
    trees: list
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += np.array([self._leaf(tree, row) for row in x])
        return out

    @staticmethod
    def _leaf(node, row) -> float:
        while isinstance(node, tuple):
            feature, cut, low, high = node
            node = high if row[feature] > cut else low
        return node


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.25, ridge: float = 2.0) -> Trees:
    model = Trees([], float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    f = np.full(len(y), model.base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int):
        own = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
        best = (1e-6, None, None)
        for j in range(x.shape[1]) if level else ():
            order = rows[np.argsort(x[rows, j], kind="stable")]
            v, gs, hs = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
            ends = np.flatnonzero(v[1:] > v[:-1])
            if len(ends):
                gain = gs[ends] ** 2 / (hs[ends] + ridge) + (gs[-1] - gs[ends]) ** 2 / (hs[-1] - hs[ends] + ridge) - own
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, (v[ends[k]] + v[ends[k] + 1]) / 2)
        if best[1] is None:
            return rate * g[rows].sum() / (h[rows].sum() + ridge)
        high = x[rows, best[1]] > best[2]
        return best[1], float(best[2]), grow(rows[~high], g, h, level - 1), grow(rows[high], g, h, level - 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        tree = grow(np.arange(len(y)), y - p, p * (1 - p), depth)
        model.trees.append(tree)
        f += np.array([Trees._leaf(tree, row) for row in x])
    return model


# --- the labelled table -----------------------------------------------------------
def labelled_spans(n: int = 1600, seed: int = 11) -> list[tuple[str, str, int, int, int]]:
    """(text, kind, start, end, label) made from templates, the same in each run."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    w = lambda: "".join(r.choice("abcdeghilmnorstu") for _ in range(r.randint(3, 8)))
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))

    def card() -> str:
        digits = r.choice("345") + d(14)
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    def date(sep: str) -> str:
        return f"{r.choice(('19', '20'))}{d(2)}{sep}{r.randint(1, 12):02}{sep}{r.randint(1, 28):02}"

    def grouped(s: str, sep: str) -> str:
        return sep.join(s[i:i + 4] for i in range(0, len(s), 4))

    yes = {
        "email": (lambda: f"{w()}.{w()} (at) {w()} (dot) com", lambda: f"{w()}[at]{w()}[dot]org", lambda: f"{w()}{d(2)} at {w()} dot net"),
        "ip": (lambda: ":".join(hexa(4) for _ in range(8)), lambda: f"fe80::{hexa(4)}:{hexa(4)}:{hexa(4)}:{hexa(4)}", lambda: f"2001:db8:{hexa(4)}:{hexa(3)}::{hexa(2)}",
               lambda: f"fe80::{hexa(r.randint(1, 4))}", lambda: f"2001:{hexa(3)}::", lambda: f"2{hexa(3)}:{hexa(4)}::{hexa(4)}"),
        "card": (lambda: grouped(card(), "."), lambda: grouped(card(), "."), lambda: grouped(card(), ".")),
        "phone": (lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"0{d(2)} {d(4)} {d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}",
                  lambda: f"{r.choice('23456789')}{d(9)}", lambda: f"00{r.choice(('49', '33', '44'))} {d(2)} {d(7)}", lambda: f"00{r.choice(('49', '33', '44'))}{d(9)}",
                  lambda: f"0{r.choice('123456789')}{d(1)}{r.choice(' /')}{d(7)}", lambda: f"1-8{d(2)}-{d(3)}-{d(4)}",
                  lambda: f"0{r.choice('123456789')} {d(2)} {d(2)} {d(2)} {d(2)}"),
    }
    no = {
        "email": (lambda: f"{w()} at {w()} . {w()}", lambda: f"{w()} at {w()}.{w()}", lambda: f"{w()} @ {w()} . {w()}", lambda: f"{w()} at {w()} dot {w()} dot {w()}"),
        "ip": (lambda: f"{d(2)}:{d(2)}:{d(2)}", lambda: f"1{d(1)}:{d(2)}:{d(2)}:{d(2)}", lambda: ":".join(hexa(2) for _ in range(6)),
               lambda: "::", lambda: f"{r.choice('abcdef')}::{r.choice(('add', 'bad', 'fee', 'dec', 'a', 'b'))}"),
        "card": (lambda: d(16), lambda: grouped(d(15) + "0", "."), lambda: grouped(d(16), " "), lambda: grouped(d(16), "-")),
        "phone": (lambda: f"20{d(2)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"{r.randint(10, 28)}.{r.randint(10, 12)}.19{d(2)}", lambda: f"{d(2)}/{d(2)}/{d(4)}",
                  lambda: f"{d(2)}.{d(3)}.{d(2)}", lambda: f"{d(3)} {d(3)} {d(3)}", lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{d(3)} {d(4)} {d(3)} {d(2)}",
                  lambda: f"0{d(1)} {d(2)} {d(2)} {d(2)}|{' ' + d(2)}", lambda: f"{d(3)}-{d(3)}-{d(3)}|{d(1)}", lambda: f"1{d(9)}", lambda: f"000{d(7)}",
                  lambda: grouped(card(), "."), lambda: grouped(card(), "."),
                  lambda: f"{date('-')} {r.randint(10, 23)}|:{r.randint(10, 59)}:{r.randint(10, 59)}", lambda: f"{date('/')} {r.randint(10, 23)}|:{r.randint(10, 59)}",
                  lambda: f"{date('-')} {d(3)}", lambda: f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.20{d(2)} {r.randint(10, 23)}|:{r.randint(10, 59)}"),
    }
    out = []
    for i in range(n):
        kind, label = KINDS[i % 4], (i // 4) % 2
        value = r.choice((no, yes)[label][kind])()
        near = r.choice(_CONTEXT[KINDS.index(kind)]) if r.random() < (0.6 if label else 0.1) else \
            r.choice(_CONTEXT[4]) if not label and r.random() < 0.6 else w()
        before = f"{w()} {near} {r.choice(['', 'is ', 'to ', 'no '])}".rstrip() + r.choice([" ", ": "])
        value, _, rest = value.partition("|")  # a part of a number is no whole one
        out.append((f"{before}{value}{rest} {w()}", kind, len(before), len(before) + len(value), label))
    return out


@dataclass
class Model:
    trees: Trees
    slope: float
    shift: float
    thresholds: dict[str, float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.shift, -30, 30)))

    def spans(self, text: str) -> tuple[list, list]:
        """The plain spans, and all spans: plain ones first of all, then candidates from the
        likeliest on that reach their kind's threshold and overlap nothing taken before."""
        base = base_spans(text)
        more = candidates(text)
        taken = list(base)
        if more:
            chance = self.probability(np.array([span_features(text, *c) for c in more]))
            best = sorted((-p, s, KINDS.index(k), e) for p, (k, s, e) in zip(chance, more) if p >= self.thresholds[k])
            cover: list[tuple[int, int]] = []  # disjoint and sorted
            for _, s, e in base:
                if cover and s < cover[-1][1]:
                    cover[-1] = (cover[-1][0], max(e, cover[-1][1]))
                else:
                    cover.append((s, e))
            for _, s, k, e in best:
                at = bisect_left(cover, (s, e))
                if (not at or cover[at - 1][1] <= s) and (at == len(cover) or e <= cover[at][0]):
                    cover.insert(at, (s, e))
                    taken.append((KINDS[k], s, e))
            taken.sort(key=lambda t: (t[1], KINDS.index(t[0]), t[2]))
        return base, taken


def train(labelled: list[tuple[str, str, int, int, int]] | None = None, precision: float = 0.98) -> Model:
    """Trees on one half of the labelled table; the other half fits the calibration (a
    logistic curve of the margin) and gives each kind the lowest threshold, 0.5 at least,
    above which its precision there is ``precision``."""
    rows = labelled if labelled is not None else labelled_spans()
    x = np.array([span_features(t, k, s, e) for t, k, s, e, _ in rows])
    y = np.array([float(label) for *_, label in rows])
    half = np.arange(len(rows)) // 8 % 2 == 0
    trees = boost(x[half], y[half])
    m, t = trees.margin(x[~half]), y[~half]
    a, b = 1.0, 0.0
    for _ in range(25):  # Newton's method with a weak prior on (1, 0)
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        v = p * (1 - p)
        g = np.array([((t - p) * m).sum() - 0.5 * (a - 1), (t - p).sum() - 0.5 * b])
        hess = np.array([[(v * m * m).sum() + 0.5, (v * m).sum()], [(v * m).sum(), v.sum() + 0.5]])
        a, b = np.array([a, b]) + np.linalg.solve(hess, g)
    model = Model(trees, float(a), float(b), {})
    chance = model.probability(x[~half])
    kinds = np.array([k for _, k, *_ in rows])[~half]
    for kind in KINDS:
        p, own = chance[kinds == kind], t[kinds == kind]
        fits = [c for c in sorted({0.5, *p}) if c >= 0.5 and (p >= c).any() and own[p >= c].mean() >= precision]
        model.thresholds[kind] = float(fits[0]) if fits else 2.0
    return model


def _listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def found(text: Column, model: Model, spark) -> Column:
    """A struct of `SCHEMA`: the plain spans' counts by kind and digest, and all spans.
    Null and empty texts have none."""
    shared = spark.sparkContext.broadcast(model)

    @vector_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, every = shared.value.spans(text or "")
            kinds = [k for k, _, _ in base]
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(every)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return run(text)


def redacted(text: Column, model: Model, spark) -> Column:
    """The text with each span replaced by its kind in brackets; null stays null.  Of
    overlapping spans the first one's kind is named."""
    shared = spark.sparkContext.broadcast(model)

    def one(text: str | None) -> str | None:
        out, at = [], 0
        for kind, s, e in shared.value.spans(text)[1] if text else ():
            if s >= at:
                out += (text[at:s], f"[{kind}]")
            at = max(at, e)
        return "".join(out) + text[at:] if text else text

    @vector_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in texts], dtype=object)

    return run(text)


def op6(docs: DataFrame) -> DataFrame:
    """Rows are independent: repeated ones give equal rows, an empty table none."""
    return docs.select("doc_id", found(F.col("text"), train(), docs.sparkSession).alias("p")).select("doc_id", "p.*")
