"""Conversation repair, periodic runs and language identification against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from conftest import ODD, clashing
from pyspark.sql import functions as F

from tandem.llm import conversation, langid, periodic

SF = "/root/testdata/sf0.01"
EMPTY = hashlib.sha256(b"").hexdigest()


# --- periodic runs ----------------------------------------------------------------
def plain_runs(words, least, exponent):
    """Every period tried at every place, the longest stretch taken, smallest period kept."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least,exponent", [(24, 3), (6, 3), (4, 2), (10, 4)])
def test_runs_equal_all_periods_tried(least, exponent):
    r = random.Random(least)
    for _ in range(400):
        words = []
        while len(words) < r.randint(0, 90):
            unit = [r.choice("abcd") for _ in range(r.randint(1, 9))]
            words += unit * r.choice([1, 1, 2, 3, 5, 9]) + unit[:r.randint(0, len(unit))]
        assert periodic.runs_of(words, least, exponent) == plain_runs(words, least, exponent), words
        assert periodic.runs_of_all([[w.encode() for w in words]], least, exponent) == [plain_runs(words, least, exponent)]


def test_runs_of_one_word_and_of_many_copies():
    assert periodic.runs_of(["a"] * 5000) == [(0, 5000, 1)]
    phrase = [f"w{k}" for k in range(20)]
    far = list(itertools.chain.from_iterable([*phrase, f"x{k}", f"y{k}"] for k in range(500)))
    assert periodic.runs_of(far) == []  # 125,000 pairs of equal strings, none near enough


def plain_op12(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 24, 3)
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest())


def test_op12_equals_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in periodic.op12(docs).collect())
    assert got == sorted(plain_op12(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] > 0 for r in got) > 5


def test_op12_odd_rows(spark, odd, empty):
    got = sorted((tuple(r) for r in periodic.op12(clashing(odd)).collect()), key=str)
    assert got == sorted((plain_op12(i, t) for i, t, *_ in ODD), key=str)
    assert periodic.op12(empty).count() == 0
    shown = odd.select("doc_id", periodic.periodic(F.col("text")).alias("p")).where("doc_id = 10").first().p
    assert shown.collapsed == "word" and [tuple(x) for x in shown.runs] == [(0, 9000, 1)]


# --- conversation repair ----------------------------------------------------------
def plain_damage(rows):
    """(conv_id, turn, role, text) rows after the trial damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += [row] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """rows: (turn, role, text) in order -> the contract's columns, by all cheapest ways."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    # whole strings are compared, so every cheapest string of a state is carried along
    states = {("", 0, ""): ()}
    for row, fault in zip([*rows, None], [*faults, ""]):
        grown = dict(states)
        for _ in range(2):  # insertions before the row
            for (last, cost, edits), lines in list(grown.items()):
                role = {"": "u", "s": "u", "a": "u", "u": "a"}[last]
                grown.setdefault((role, cost + 2, edits + "I"), (*lines, {"u": "user:", "a": "assistant:"}[role]))
        if row is None:
            states = grown
            break
        new = {}
        for (last, cost, edits), lines in grown.items():
            new.setdefault((last, cost + 3, edits + "D"), lines)
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            to = follow.get((last, row[1][:1]))
            if to:
                new.setdefault((to, cost + more, edits + "K"), (*lines, f"{row[1]}:{row[2]}"))
            to, name = {"": ("u", "user"), "s": ("u", "user"), "a": ("u", "user"), "u": ("a", "assistant")}[last]
            new.setdefault((to, cost + 2 + more, edits + "R"), (*lines, f"{name}:{row[2]}"))
        least = min(c for _, c, _ in new)
        states = {k: v for k, v in new.items() if k[1] <= least + 4}  # any state reaches any other for 4
    cost, edits, lines = min((c, e, l) for (last, c, e), l in states.items() if last in ("", "a"))
    turns = [t for t, *_ in rows if t is not None]
    legal = {"su", "ua", "au"}
    initials = [r[1][:1] for r in rows]
    return ((max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in legal for a, b in zip(initials, initials[1:])), cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_op11(rows):
    out = []
    after = plain_damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in after if r[0] == conv),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        out.append((conv, *plain_repair(own)))
    return sorted(out, key=str)


def test_op11_equals_the_plain_version(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted((tuple(r) for r in conversation.op11(table).collect()), key=str)
    assert got == plain_op11([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert len(got) == table.select("conv_id").distinct().count()


def test_op11_odd_rows(spark):
    r = random.Random(11)
    texts = [None, "", " \n", "a.", "b", "c! ", "d?\t", "é…", "a.", "x" * 50_000 + "."]
    rows = [(r.choice([None, 1, 2, 3, 4, 5, 6, 7]), r.choice([None, 0, 1, 2, 3, 9]), r.choice([None, "", "user", "assistant", "system", "tool", "USER"]),
             r.choice(texts)) for _ in range(90)]
    rows += [(100 + k, None, None, None) for k in range(40)] + [(8, 0, "user", "hi.")] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = df.withColumns({c: F.lit("x") for c in ("copies", "symbol", "digest", "audit", "cost", "is_row", "last")})
    got = sorted((tuple(x) for x in conversation.op11(more).collect()), key=str)
    assert got == plain_op11(rows)
    assert any(x[-2] == "" and x[-1] == EMPTY and x[1:7] == (0,) * 6 for x in got)
    assert conversation.op11(df.limit(0)).count() == 0
    lines = conversation.repaired(conversation.damaged(df)).collect()
    for conv, *_, audit, digest in got:
        own = sorted((x for x in lines if x.conv_id == (None if conv is None else str(conv))), key=lambda x: x.step)
        assert "".join(x.edit for x in own) == audit
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own if x.edit != "D").encode()).hexdigest() == digest


def test_long_runs_are_passed_by_powers():
    symbol = 1 * 4
    assert conversation.plan([(symbol, 100_001)])[0] == 2 * 50_001 - (0)  # every second turn reroled, one put in
    one, many = conversation.plan([(symbol, 1)] * 37 + [(8, 1)] * 12), conversation.plan([(symbol, 37), (8, 12)])
    assert one == many


# --- language identification --------------------------------------------------------
def test_filters_hold_exactly_the_typical_ngrams(spark):
    """The table's bits against n-grams counted with a dict."""
    docs = spark.createDataFrame([("en", "The cat sat. the hat"), ("de", "Die Katze saß; the"), ("fr", "le chat, là"), (None, "x y"), ("fr", None), ("en", "")], "lang string, text string")
    share, near = 0.01, 0.5
    filters = langid.learn(docs, cells=1 << 16, share=share, near=near)
    assert sorted(filters.names) == ["de", "en", "fr"]
    counts = {}
    for lang, text in [tuple(r) for r in docs.collect()]:
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()) if lang else ():
            for order in langid.ORDERS:
                for a in range(len(word) + 2 - order + 1):
                    gram = f" {word} "[a:a + order]
                    counts.setdefault(lang, {}).setdefault(gram, 0)
                    counts[lang][gram] += 1
    shares = {k: {g: n / sum(v.values()) for g, n in v.items()} for k, v in counts.items()}
    assert filters.names[0] == max(counts, key=lambda k: sum(counts[k].values()))

    def hashed(gram):
        codes = np.array([ord(c) for c in gram], np.uint64)
        h = np.array([len(gram)], np.uint64)
        with np.errstate(over="ignore"):
            for c in codes:
                h = h * np.uint64(0x9E3779B97F4A7C15) + c
            h ^= h >> np.uint64(31)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(29)
        return h

    wrong = 0
    for gram in {g for v in counts.values() for g in v}:
        mask = int(filters.masks(hashed(gram))[0][0])
        top = max(v.get(gram, 0) for v in shares.values())
        for i, name in enumerate(filters.names):
            own = shares[name].get(gram, 0)
            wants = own >= share and own >= near * top
            assert not wants or mask >> i & 1  # a filter never misses
            wrong += bool(mask >> i & 1) != wants
    assert wrong == 0  # 2^16 cells: false positives are all but impossible


def test_more_than_64_languages(spark):
    names = [f"l{k:03}" for k in range(130)]
    alphabet = [chr(0x4E00 + k) for k in range(1300)]
    rows = [(n, " ".join("".join(alphabet[10 * k + (j + i) % 10] for i in range(4)) for j in range(10))) for k, n in enumerate(names)]
    filters = langid.learn(spark.createDataFrame(rows, "lang string, text string"), cells=1 << 14)
    assert len(filters.names) == 130 and filters.cells.shape[0] == 3
    assert filters.decide([t for _, t in rows])[0] == names


def test_op13_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.op13(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    right, all_ = got.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 250 and right / all_ > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_op13_cut_texts_count_the_same(spark, monkeypatch):
    text = ("Ein Wort, noch eins! " * 400) + "x" * 3000 + " ende"
    whole = [np.concatenate([h for h, _ in langid.ngrams([text.lower()], [0])])]
    monkeypatch.setattr(langid, "BLOCK", 1000)
    parts = [h for p, of in langid.pieces([text]) for h, _ in langid.ngrams(p, of)]
    assert np.array_equal(np.sort(whole[0]), np.sort(np.concatenate(parts)))


def test_op13_odd_rows(spark, odd, empty):
    rows = langid.op13(clashing(odd)).collect()
    assert len(rows) == len(ODD)
    texts = {(i, t) for i, t, *_ in ODD}
    assert {(r.doc_id, r.lang_pred) for r in rows if r.lang_pred == "und"} == {(i, "und") for i, t in texts if not t or not any(c.isalpha() for c in t)}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.op13(empty).count() == 0
    assert {r.lang_pred for r in langid.op13(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
