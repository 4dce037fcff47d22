"""Toxicity behind leetspeak, spacing and repetition: a noisy-channel decoder.

1.  A character trigram model is counted over all documents (letters folded to 28
    codes, so the table is small whatever the corpus).
2.  Each disguised region of a text becomes a lattice: a digit or sign may stand for
    a letter, for nothing, or for itself; a separator inside a word may be noise; between
    single characters each separator is noise or a word's end; a letter three times or
    more in a row may be one or two.  Viterbi under the trigram
    model picks the reading.  A region is decoded with the two plain characters on
    either side, which separate it exactly from the rest under a trigram model, so that
    readings can be kept by (region, neighbours).
    The space beside a short fragment is a lattice of two paths, noise or a word's end;
    which is cheaper depends on the two letters on either side only, so one table of
    28**4 answers holds it for all texts.
    Designations (mp3, 2nd, sha256, h2o) and spaced single characters that make no word
    of four letters (a b c) stay as they are; so do disguised words of three characters
    and the space beside a fragment that a digit or hyphen touches (m0 ron, x-ray).
3.  Words and word beginnings of the text and of the restored text, chosen by their
    counts in labelled documents, are the inputs of a logistic regression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, held_out, labelled_sample, stored, vector_udf

# Which letters a sign is written for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "€": "e", "£": "l", "#": "h",
}
SEPARATORS = "-._~'*"
ACCENTS = {"a": "àáâãäåā", "c": "çć", "e": "èéêëē", "i": "ìíîïī", "n": "ñń", "o": "òóôõöøō", "s": "šß", "u": "ùúûüū", "y": "ýÿ", "z": "žź"}
# Costs of the channel.  A sign left out also saves a letter's cost under the model, about 3.
COST_LETTER, COST_NOTHING, COST_ITSELF, COST_DOUBLE = 0.5, 8.0, 6.0, 0.7
COST_PUNCTUATION, PUNCTUATION = 1.5, "!|+(#"  # two or more of these in a row
COST_SEPARATOR_NOTHING, COST_SEPARATOR_ITSELF = 0.5, 1.0
COST_SPACE_NOTHING, COST_SPACE_END = 0.0, 0.5  # between single characters
COST_SPLIT, FRAGMENT = 4.0, 4  # a space inside a word, beside a fragment of at most so many letters
LEAST_WORD = 4  # letters of a word put together, and of the longest word of a spaced-out run

N_CODES, OTHER = 28, 27
_CODES = np.full(0x250, 0, np.uint8)
for _c in range(0x250):
    if chr(_c).isalpha():
        _CODES[_c] = OTHER
for _i, _a in enumerate("abcdefghijklmnopqrstuvwxyz", 1):
    for _x in _a + ACCENTS.get(_a, ""):
        _CODES[ord(_x)] = _i


def code(char: str) -> int:
    return int(_CODES[ord(char)]) if ord(char) < 0x250 else OTHER if char.isalpha() else 0


def text_codes(text: str) -> np.ndarray:
    """The code of each character."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    codes = _CODES[np.minimum(points, 0x24F)]
    high = points >= 0x250
    if high.any():
        codes[high] = [code(chr(p)) for p in points[high]]
    return codes


def trigram_counts(texts: Iterable[str]) -> np.ndarray:
    """Counts of the three-code sequences of the texts; runs of non-letters are one gap."""
    total = np.zeros(N_CODES ** 3, np.int64)
    for text in texts:
        codes = text_codes("\n" + text.lower() + "\n")
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])].astype(np.int32)
        if len(codes) > 2:
            total += np.bincount((codes[:-2] * N_CODES + codes[1:-1]) * N_CODES + codes[2:], minlength=N_CODES ** 3)
    return total


def corpus_model(docs: DataFrame) -> np.ndarray:
    """The trigram counts of all documents: summed per batch, then by Spark; at most 28**3 rows."""
    @vector_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        total = trigram_counts(t for t in texts if t)
        return pd.Series([total.tolist(), *[[]] * (len(texts) - 1)])

    counts = (docs.select(F.posexplode(run("text")).alias("k", "n")).where("n > 0")
              .groupBy("k").agg(F.sum("n").alias("n")).collect())
    total = np.zeros(N_CODES ** 3, np.int64)
    for row in counts:
        total[row.k] = row.n
    return total


def costs(counts: np.ndarray, weight: float = 5.0) -> list[float]:
    """-log of the interpolated trigram probabilities, by flat index."""
    tri = counts.reshape(N_CODES, N_CODES, N_CODES).astype(float)
    one = tri.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = tri.sum(axis=0)
    two = (two + weight * one) / (two.sum(axis=1, keepdims=True) + weight)
    three = (tri + weight * two[None]) / (tri.sum(axis=2, keepdims=True) + weight)
    return (-np.log(three)).ravel().tolist()


_L = r"[^\W\d_]"
_SIGN = "[" + re.escape("".join(x for x in SIGNS if x not in SEPARATORS)) + "]"
_ANY = "[" + re.escape("".join({*SIGNS, *SEPARATORS})) + "]"
#: Signs and separators inside a word, signs before or after one, long runs of a letter.
REGION = re.compile(rf"(?<={_L}){_ANY}+(?={_L})|(?<!\w){_SIGN}+(?={_L})|(?<={_L}){_SIGN}+|({_L})\1\1+").finditer
#: Three or more single characters with one separator between each.
SPACED = re.compile(rf"(?<![^\s])(?:{_L}|{_SIGN})(?:(?:[ ._*-])(?:{_L}|{_SIGN})){{2,}}(?!\w)").sub
#: Digits that belong to a name or number: after one or two letters, two different ones
#: after a word, before one or two letters, between two single letters.
DESIGNATION = re.compile(rf"(?:{_L}{{1,2}}\d+|{_L}+(?!(\d)\1*(?!\d))\d\d+|\d+{_L}{{1,2}}|{_L}\d+{_L})(?![\w$@€£*])").match
WORD_END = re.compile(r"[.,;:!?]*(?!\S)").match
#: Single letters between separators, as in i.e. and a-b-c.
SINGLES = re.compile(rf"(?<!\S){_L}(?:[._*-]{_L})+(?!\w)").finditer
_HINT = re.compile(_SIGN + "|[-_~'*]|\\.\\w").search
_TRIPLES = [c * 3 for c in "abcdefghijklmnopqrstuvwxyz"]
#: Spaced-out runs by space and by other separators, each after a cheaper pattern that any such run meets.
_LONE = [(re.compile(r" \S \S(?!\w)").search, re.compile(r"(?:^|\s)\S[ ]\S[ ]\S(?!\w)").search),
         (re.compile(r"[._*-]\w[._*-]\w\b").search, re.compile(r"\b\w[._*-]\w[._*-]\w\b").search)]


def designates(text: str, at: int) -> bool:
    """Whether the digits at ``at`` belong to a designation."""
    while at and text[at - 1].isalpha():
        at -= 1
    return not (at and (text[at - 1].isalnum() or text[at - 1] == "_")) and DESIGNATION(text, at) is not None


class Decoder:
    def __init__(self, costs: list[float]):
        self.costs = costs
        self.readings = Memo(lambda key: self.read(*key), 120_000)
        c = np.array(costs).reshape(N_CODES, N_CODES, N_CODES)
        apart = c[:, :, 0, None, None] + c[:, 0, :, None] + c[0]
        #: By the two letters before a space and the two after it: the space is noise.
        self.noise = apart > c[:, :, :, None] + c + COST_SPLIT

    def read(self, left: str, region: str, right: str) -> str:
        """The cheapest reading of ``region`` between its plain neighbours."""
        cost = self.costs
        a, b = ([0, 0] + [code(c) for c in left])[-2:]
        states = {(a, b): (0.0, None)}

        def step(states, options):
            new: dict = {}
            for (a, b), (sum_, back) in states.items():
                for letters, price in options:
                    total, x, y = sum_ + price, a, b
                    for c in letters:
                        k = code(c)
                        if k or y:
                            total += cost[(x * N_CODES + y) * N_CODES + k]
                            x, y = y, k
                    if (x, y) not in new or total < new[x, y][0]:
                        new[x, y] = (total, (back, letters))
            return new

        for m in re.finditer(r"(.)\1*", region, re.DOTALL):
            c, times = m[1], len(m[0])
            if c.isalpha():
                runs = [(c, 0.0)] if times == 1 else [(c * 2, 0.0), (c, COST_DOUBLE)]
                states = step(states, runs)
                continue
            if c == " ":
                states = step(states, [("", COST_SPACE_NOTHING), (" ", COST_SPACE_END)])
                continue
            options = [(letter, COST_LETTER) for letter in SIGNS.get(c, "")]
            if times > 1:
                options += [(letter * 2, COST_LETTER + COST_DOUBLE) for letter in SIGNS.get(c, "")]
            if c in SEPARATORS:
                options += [("", COST_SEPARATOR_NOTHING), (c * times, COST_SEPARATOR_ITSELF)]
            else:
                options += [("", COST_NOTHING), (c * times, COST_PUNCTUATION if times > 1 and c in PUNCTUATION else COST_ITSELF)]
            states = step(states, options)
        for c in right + " " * (2 - len(right)):
            states = step(states, [(c, 0.0)])
        out, back = [], min(states.values(), key=lambda s: s[0])[1]
        for _ in range(2):
            back = back[0]  # the right neighbours
        while back:
            back, letters = back
            out.append(letters)
        return "".join(reversed(out))

    def _spaced(self, match: re.Match) -> str:
        """Between single characters each separator is noise or a word's end."""
        start, end = match.span()
        read = self.readings[match.string[max(0, start - 2):start], " ".join(match[0][::2]), match.string[end:end + 2]]
        return read if max(map(len, read.split()), default=0) >= LEAST_WORD else match[0]

    def rejoin(self, text: str) -> str:
        """The text without the spaces that are noise inside a word."""
        codes = text_codes(text)
        gaps = np.flatnonzero(codes == 0)
        before, after = np.diff(gaps, prepend=-1) - 1, np.diff(gaps, append=len(codes)) - 1
        least = np.minimum(before, after)
        near = np.flatnonzero((least > 0) & (least <= FRAGMENT) & (before + after >= LEAST_WORD))
        codes, at = np.concatenate([[0, 0], codes, [0, 0]]), gaps[near]  # each code moves by two places
        near = near[self.noise[codes[at], codes[at + 1], codes[at + 3], codes[at + 4]]]
        out, start = [], 0
        for i, a, b in zip(gaps[near].tolist(), before[near].tolist(), after[near].tolist()):
            if text[i] == " " and (i == a or text[i - a - 1].isspace()) and WORD_END(text, i + b + 1):
                out.append(text[start:i])
                start = i + 1
        return "".join((*out, text[start:])) if out else text

    def restore_regions(self, text: str) -> str:
        out, at, readings = [], 0, self.readings
        stay = {i for m in SINGLES(text) for i in range(*m.span())}
        found = (m for m in REGION(text) if m.start() not in stay and not (m[0].isdigit() and designates(text, m.start())))
        m = next(found, None)
        while m is not None:
            start, end = m.span()
            m = next(found, None)
            while m is not None and m.start() - end < 2:  # fewer than two plain characters between: one lattice
                end = m.end()
                m = next(found, None)
            out += (text[at:start], readings[text[max(0, start - 2):start], text[start:end], text[end:end + 2]])
            at = end
        out.append(text[at:])
        return "".join(out)

    def restore(self, text: str) -> str:
        """The lower-cased text with its disguised regions read."""
        text = text.lower()
        lone = any(first(text) and run(text) for first, run in _LONE)
        if lone:
            text = SPACED(self._spaced, text)
        text = self.rejoin(text)
        if not (lone or _HINT(text) or any(t in text for t in _TRIPLES)):
            return text
        read = self.restore_regions(text)
        return text if read == text else self.rejoin(read)  # once more: a fragment may have held a sign


_WORDS = re.compile(_L + "+").findall


def beginnings(word: str) -> list[str]:
    """A word's inputs: the whole word and its beginnings of 4 to 7 letters."""
    return [f"={word}", *(word[:k] for k in range(4, min(7, len(word)) + 1))]


def inputs(text: str, decoder: Decoder, keep: Memo) -> set:
    """What ``keep`` has for each distinct chunk of the text and of its restored form."""
    plain, restored = text.lower(), decoder.restore(text)
    chunks = set(plain.split())
    if restored != plain:
        chunks.update(restored.split())
    found: set = set()
    for c in chunks:
        if got := keep[c]:
            found.update(got)
    return found


def _chunk_inputs(chunk: str) -> tuple[str, ...]:
    return tuple(x for w in _WORDS(chunk) for x in beginnings(w))


class Model:
    """Decoder costs, chosen inputs and their weights."""

    def __init__(self, costs: list[float], names: list[str], weights: np.ndarray, base: float):
        self.costs, self.names, self.weights, self.base = costs, names, weights, base

    def start(self) -> None:
        self.decoder = Decoder(self.costs)
        number = {n: i for i, n in enumerate(self.names)}
        self.keep = Memo(lambda c: tuple(number[x] for x in _chunk_inputs(c) if x in number), 120_000)

    def hits(self, text: str | None) -> list[int]:
        return sorted(inputs(text, self.decoder, self.keep)) if text else []

    def score(self, hits: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.base + self.weights[hits].sum(), -30, 30))))


def logistic(hits: list[list[int]], y: np.ndarray, size: int, ridge: float = 0.5, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of inputs, by accelerated gradient steps.  Ten made-up
    rows without inputs, one of label 1, steady the base where there are few labels."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 9)))
    if not len(y):
        return np.zeros(size), base
    rows = np.repeat(np.arange(len(y)), [len(h) for h in hits])
    cols = np.fromiter((c for h in hits for c in h), np.int64, len(rows))
    scale = 1 / (0.25 * np.bincount(cols, minlength=size) * 4 + ridge)  # a step that suits each input's count
    w = np.zeros(size)
    speed, base_speed = np.zeros(size), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(base + np.bincount(rows, w[cols], len(y)), -30, 30)))
        g = np.bincount(cols, (p - y)[rows], size) + ridge * w
        speed = 0.8 * speed - scale * g
        base_speed = 0.8 * base_speed - ((p - y).sum() + 10 / (1 + np.exp(-base)) - 1) / (0.25 * len(y) + 2.5)
        w, base = w + speed, base + 0.2 * base_speed
    return w, base


def chosen_inputs(sample: DataFrame, shared_costs, n_inputs: int, n_candidates: int | None = None) -> list[str]:
    """The inputs that tell labelled documents apart best: in at least three documents of
    label 1 and at least four times as frequent there, by their log-likelihood ratio.
    ``n_candidates`` bounds how many are looked at, the most frequent in documents of
    label 1 first; None looks at all, as many as the sample's own texts hold."""
    def count(batches: Iterator[pd.DataFrame], only: frozenset | None, label: int) -> Iterator[pd.DataFrame]:
        decoder, keep, seen = Decoder(shared_costs.value), Memo(_chunk_inputs, 100_000), Counter()
        frame = lambda: pd.DataFrame({"x": pd.Series([*seen], dtype=object), "n": [*seen.values()]})
        for batch in batches:
            for text in batch["text"]:
                if text:
                    got = inputs(text, decoder, keep)
                    seen.update(got if only is None else got & only)
                if len(seen) > 150_000:  # bounded memory; Spark adds the parts up
                    yield frame()
                    seen.clear()
        if seen:
            yield frame()

    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    yes, no = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not yes or not no:
        return []
    positive = sample.where("label = 1").select("text").mapInPandas(lambda it: count(it, None, 1), "x string, n long")
    positive = positive.groupBy("x").agg(F.sum("n").alias("n")).where("n >= 3")
    if n_candidates is not None:
        positive = positive.orderBy(F.desc("n"), "x").limit(n_candidates)
    pos = {r.x: r.n for r in positive.collect()}  # short strings, bounded with the sample
    only = sample.sparkSession.sparkContext.broadcast(frozenset(pos))
    negative = (sample.where("label != 1").select("text")
                .mapInPandas(lambda it: count(it, only.value, 0), "x string, n long").groupBy("x").agg(F.sum("n").alias("n")))
    neg = {r.x: r.n for r in negative.collect()}

    def ratio(x: str) -> float:
        a, b = pos[x], neg.get(x, 0)
        part = lambda k, n, q: k * np.log(max(k, 1e-9) / (n * q)) + (n - k) * np.log(max(n - k, 1e-9) / (n * (1 - q)))
        q = (a + b) / (yes + no)
        return part(a, yes, q) + part(b, no, q) if 0 < q < 1 else 0.0

    good = [(ratio(x), x) for x, a in pos.items() if a / yes >= 4 * (neg.get(x, 0) + 0.5) / no]
    return [x for _, x in sorted(good, key=lambda t: (-t[0], t[1]))[:n_inputs]]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, n_inputs: int = 1500,
          n_candidates: int | None = None) -> Model:
    """The channel's language model from all documents; the classifier, on ``n_inputs``
    inputs chosen from ``n_candidates`` (None: all), from at most ``max_rows`` labelled
    documents that are not held out."""
    spark = docs.sparkSession
    table = costs(corpus_model(docs))
    sample = labelled_sample(labels, "toxic", max_rows)
    texts = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
                   .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")), "toxic-sample")
    names = chosen_inputs(texts, spark.sparkContext.broadcast(table), n_inputs, n_candidates)
    model = Model(table, names, np.zeros(len(names)), 0.0)
    hits = (texts.select("doc_id", "label", hit_column(F.col("text"), model, spark).alias("hits"))
            .orderBy("doc_id").limit(max_rows).collect())  # at most max_rows short lists
    y = np.array([float(r.label == 1) for r in hits])
    weights, base = logistic([r.hits for r in hits], y, len(names))
    return Model(table, names, weights, base)


def _started(shared) -> Model:
    model = shared.value
    if not hasattr(model, "decoder"):
        model.start()
    return model


def hit_column(text: Column, model: Model, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @vector_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        own = _started(shared)
        return pd.Series([own.hits(t) for t in texts])

    return run(text)


def score_column(text: Column, model: Model, spark) -> Column:
    """0 to 1, higher: likelier toxic.  Null and empty texts have the model's base score."""
    shared = spark.sparkContext.broadcast(model)

    @vector_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        own = _started(shared)
        return pd.Series([own.score(own.hits(t)) for t in texts], dtype=float)

    return run(text)


def restored_column(text: Column, model: Model, spark) -> Column:
    """The lower-cased text with disguises read; null stays null."""
    shared = spark.sparkContext.broadcast(model)

    @vector_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        own = _started(shared)
        return pd.Series([None if t is None else own.decoder.restore(t) for t in texts], dtype=object)

    return run(text)


def op1(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted.  Repeated rows and equal texts score alike, a
    score of exactly ``threshold`` is toxic, an empty table gives no rows; null and empty
    texts have the base score, and without labels of both kinds every text has it.  Texts
    of any length are read whole; other columns are not read."""
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_column(F.col("text"), model, docs.sparkSession).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more.

    Null and empty texts have the model's base score, about the share of label 1 in the
    sample, and go only if that reaches the threshold.  Rows that repeat a doc_id are
    judged each by its own text; columns of any names are kept; an empty table stays empty."""
    model = train(docs, labels)
    return docs.where(score_column(F.col("text"), model, docs.sparkSession) < threshold)
