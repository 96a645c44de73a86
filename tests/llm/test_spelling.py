"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cestero.llm import spelling


def words_of(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += len(run) >= 7
    return {w: n for w, n in found.items() if n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(rows):
    n = words_of(rows)
    form, found = {}, {}
    for word in n:
        others = [w for w in n if near(word, w)]
        best = min(others, key=lambda w: (-n[w], w), default=None)
        form[word] = best if best and n[best] >= 10 * n[word] else None
        found[word] = len(others)
    want = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        want.append((word, form[word], root, n[word], found[word], n.get(form[word])))
    return sorted(want)


@pytest.fixture(scope="module")
def written(spark):
    """Words in chains of variants, each about ten times as frequent as the next."""
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzàéöß"

    def variant(word):
        at, kind = rnd.randrange(len(word)), rnd.randrange(3)
        middle = "" if kind == 0 else rnd.choice(letters)
        return word[:at] + middle + word[at + (kind < 2) :]

    counts = Counter()
    for _ in range(25):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randint(8, 14)))
        for times in (400, 38, 3):
            for _ in range(rnd.randint(1, 3)):
                counts[word] += times
                word = variant(word)
    counts["x" * 400] += 3
    counts["x" * 401] += 3
    counts["aaaaaaa"] += 30
    counts["aaaaaaaa"] += 2
    drawn = [w for w, n in counts.items() for _ in range(n)]
    rnd.shuffle(drawn)
    rows = []
    for k in range(0, len(drawn), 40):
        text = ""
        for word in drawn[k : k + 40]:
            text += rnd.choice([word, word.capitalize(), word.upper() if word.isascii() else word])
            text += rnd.choice([" ", ", ", "1", "_", "œ"])
        rows.append((rnd.choice([k, k, 7, None]), text))
    rows += [(1, None), (2, ""), (None, None), (3, "short words only")] + [rows[0]] * 5
    schema = "doc_id long, text string, word string, n string, key string, run string"
    frame = spark.createDataFrame([(*row, "own", "own", "own", "own") for row in rows], schema)
    return rows, frame.repartition(3)


def test_variants_against_all_pairs(written):
    rows, frame = written
    want = expected(rows)
    assert len(want) > 80 and sum(w[1] is not None for w in want) > 20
    assert any(w[1] and w[2] != w[1] for w in want), "a chain of two forms"
    got = spelling.variants(frame)
    assert got.columns == "word form root n n_near form_n".split()
    assert sorted(map(tuple, got.collect())) == want


def test_variants_when_the_table_of_marks_is_full(written, monkeypatch):
    rows, frame = written
    monkeypatch.setattr(spelling, "MARKS", 1 << 15)
    assert sorted(map(tuple, spelling.variants(frame).collect())) == expected(rows)


def test_odd_rows_and_nothing(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, spelling.variants(odd).collect())) == expected(rows)
    assert spelling.variants(nothing).count() == 0


def test_a_neighbourhood_is_that_of_the_reduced_word():
    words = ["abcdefg", "zzzzzzzz", "éàüabcdx"]
    table = spelling.symbols()
    alphabet = range(1, spelling.SYMBOLS + 1)

    def number(symbols):
        return sum(s * pow(spelling._BASE, k, 1 << 64) for k, s in enumerate(symbols)) % (1 << 64)

    parts = list(spelling.Reduced(words).neighbourhood())
    for k, word in enumerate(words):
        own = [int(table[ord(c)]) for c in word]
        want = {tuple(own)}
        for at in range(len(own) + 1):
            want |= {(*own[:at], s, *own[at:]) for s in alphabet}
            if at < len(own):
                want |= {(*own[:at], *own[at + 1 :])} | {(*own[:at], s, *own[at + 1 :]) for s in alphabet}
        got = {int(v) for index, key in parts for v in key[np.asarray(index) == k]}
        assert got == set(map(number, want))
