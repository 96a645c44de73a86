"""Spelling variants of words, found through words over a reduced alphabet.

Every letter stands for one of ``SYMBOLS`` symbols. Two words that differ by one
inserted, deleted or replaced letter have reduced words that differ by one edit
or none. So the full one-edit neighbourhood of each reduced word is generated,
which takes about twice the word's length times ``SYMBOLS`` strings instead of
the whole alphabet's, and joined with the reduced words that there are. Pairs of
words that meet are compared by their original letters, which decides alone.

A reduced word is a number, the sum of its symbols times powers of an odd base
modulo 2^64; the numbers of its neighbourhood come from running sums of that.
Different reduced words of equal number cost a comparison and change nothing. A
neighbourhood is symmetric, so each word sends on the neighbours whose number is
not below its own; one of two words does. What is not among the marks of all
reduced words, a table of ``MARKS`` bits, is left out before anything is
shuffled; with more words than marks that leaves out less, and the join decides.

Words are counted in every task before they shuffle. A null text has no words,
and a null id is the empty text in what decides about a letter. Repeated rows
count each time. A word of any length is compared as a whole. Without words the
result is empty. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.llm.text import staged

#: Code points of a word, occurrences, and how much more frequent a form has to be, at least.
LENGTH, OCCURRENCES, TIMES = 7, 2, 10
#: The letter of a run that is deleted goes where this divides the checksum.
SLIP = 31
SYMBOLS = 8
#: Bits in which reduced words are marked (16 MB).
MARKS = 1 << 27
#: Neighbours made at a time.
ROWS = 1 << 19

# Letters, the more frequent ones of European languages first.
FREQUENT = "etaoinshrdlucmwfgypbvkxjqz"

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BACK = _U(pow(_BASE, -1, 1 << 64))
#: Bits in a row of the table of marks (4 KB), as ``bitmap_construct_agg`` makes it.
_BUCKET = 1 << 15


def symbols() -> np.ndarray:
    """The symbol of each code point up to 255, from 1 on.

    Frequent letters are dealt out forth and back, so that symbols are about
    equally frequent; all others go by their code point.
    """
    table = np.arange(256) % SYMBOLS
    for k, letter in enumerate(FREQUENT):
        turn, at = divmod(k, SYMBOLS)
        table[ord(letter)] = SYMBOLS - 1 - at if turn % 2 else at
    return (table + 1).astype(np.uint64)


def occurrences(documents: DataFrame) -> DataFrame:
    """``word`` of every run of letters in ``documents``, some of them with a slip.

    Runs too short for a word are not even taken out; a greedy match of at least
    ``LENGTH`` letters is a run whole, since it begins where the run does.
    """
    letters = f"[A-Za-z\\u00C0-\\u00FF]{{{LENGTH},}}"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"({letters})"), F.lit(1)))
    found = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, upper.lower())).otherwise(F.col("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run"))
    return (
        found.select("id", lower.alias("run"))
        .select("run", h.alias("h"))
        .select(word.alias("word"))
        .where(F.char_length("word") >= LENGTH)
    )


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word, n`` of all words."""
    counted = occurrences(documents).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


class Reduced:
    """Reduced words of a batch, letters one after the other, with running sums by word."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.at = np.arange(self.size.sum()) - self.start[self.word]
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.symbol = symbols()[letters & 255]
        longest = int(self.size.max(initial=0))
        powers = np.empty(longest + 1, np.uint64)
        powers[:1] = 1
        np.cumprod(np.full(longest, _U(_BASE)), out=powers[1:])
        self.power = powers[self.at]
        self.end_power = powers[self.size]
        terms = self.symbol * self.power
        total = np.concatenate(([_U(0)], np.cumsum(terms)))
        first = total[self.start]
        self.key = total[self.start + self.size] - first
        self.before = total[:-1] - first[self.word]  # the sum of all letters before this one
        self.after = self.key[self.word] - self.before - terms

    def neighbourhood(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words and numbers of their neighbours, themselves included, one kind of edit at a time.

        A neighbour that several edits lead to comes several times.
        """
        every = np.arange(len(self.size))
        yield every, self.key
        yield self.word, self.before + self.after * _BACK  # deleted
        whole = self.key[self.word]
        follow = (whole - self.before) * _U(_BASE)
        for s in map(_U, range(1, SYMBOLS + 1)):
            yield self.word, whole + (s - self.symbol) * self.power  # replaced
            yield self.word, self.before + s * self.power + follow  # inserted before a letter
            yield every, self.key + s * self.end_power  # at the end


def each_once(word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, word))
    word, key = word[order], key[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (key[1:] != key[:-1])
    return word[new], key[new]


def in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows, and their words, with about ``ROWS`` neighbours at most; one word may have more."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        low = 0
        while low < len(words):
            high, neighbours = low, 0
            while high < len(words) and (high == low or neighbours < ROWS):
                neighbours += 2 * (SYMBOLS + 1) * (len(words[high]) + 1)
                high += 1
            yield batch.slice(low, high - low), words[low:high]
            low = high


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with the number ``key`` of their reduced words."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in in_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(Reduced(own).key.view(np.int64))],
                ["word", "n", "key"],
            )

    return words.mapInArrow(number, "word string, n long, key long")


def marked(numbered_words: DataFrame) -> np.ndarray:
    """The table of marks: a bit for each number modulo ``MARKS``, 16 MB whatever there is."""
    bit = F.pmod("key", F.lit(MARKS))
    rows = (
        numbered_words.groupBy(F.expr(f"cast(pmod(key, {MARKS}) div {_BUCKET} as int)").alias("row"))
        .agg(F.bitmap_construct_agg((bit % _BUCKET).cast("int")).alias("bits"))
        .collect()
    )
    table = np.zeros((MARKS // _BUCKET, _BUCKET // 8), np.uint8)
    for row in rows:
        table[row["row"]] = np.frombuffer(row["bits"], np.uint8)
    return table.ravel()


def neighbours(numbered_words: DataFrame) -> DataFrame:
    """``key, word, n, own``: each word by numbers of its neighbourhood that may be others' own."""
    marks = numbered_words.sparkSession.sparkContext.broadcast(marked(numbered_words))

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = marks.value
        for batch, own in in_batches(batches):
            numbers = batch.column("key").to_numpy()
            found = []
            for word, key in Reduced(own).neighbourhood():
                key = key.view(np.int64)
                bit = key & (MARKS - 1)
                there = (table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
                kept = (there == 1) & (key >= numbers[word])
                found.append((word[kept], key[kept]))
            word, key = each_once(*map(np.concatenate, zip(*found)))
            rows = pa.array(word)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    batch.column("word").take(rows),
                    batch.column("n").take(rows),
                    pa.array(numbers[word]),
                ],
                ["key", "word", "n", "own"],
            )

    return numbered_words.mapInArrow(generate, "key long, word string, n long, own long")


def one_edit(a: Column, b: Column) -> Column:
    """Whether two words differ by exactly one code point inserted, deleted or replaced."""
    return F.levenshtein(a, b, 1) == 1


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every word with each of its near words. ``words`` are staged."""
    known = staged(numbered(words))
    others = known.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    # Words of one number meet from both sides, all others from one.
    once = (F.col("own") != F.col("key")) | (F.col("word") < F.col("other"))
    pairs = (
        neighbours(known)
        .join(others, "key")
        .where(once & one_edit(F.col("word"), F.col("other")))
    )
    ways = F.array(
        F.struct(F.col("word"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.inline(ways))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of each word that has a form (``word, form``), by doubling steps.

    A form is at least ``TIMES`` as frequent as its word, so that no chain closes,
    and chains are as short as the logarithm of the greatest count.
    """
    step = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = step.join(ahead, "root", "left")
        further = moved.where("further IS NOT NULL")
        if further.isEmpty():
            return step
        step = staged(moved.select("word", F.coalesce("further", "root").alias("root")))


def variants(documents: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``documents``."""
    words = staged(vocabulary(documents))
    best = (
        near_words(words)
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
        )
    )
    enough = -F.col("best.less") >= TIMES * F.col("n")
    formed = staged(
        words.join(best, "word", "left").select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
