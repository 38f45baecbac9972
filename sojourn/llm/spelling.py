"""Spelling variants: words one insertion, deletion or replacement apart, by bit-sliced positions.

For every position and letter a bit set says which words hold that letter there. A query word is
read once from left to right; two sets follow it at the same time, word-parallel: the words without
an error so far, and those with one (a replaced letter keeps the positions, an inserted or deleted
one shifts them by one).

The vocabulary is dealt in bounded groups. If one edit parts two words, the edit lies in some
segment ``[lo, hi)`` of the shorter one, and both agree before and after it. So words meet in
groups of equal rest, first for two segments of half a word each; groups that are too big are
dealt again by halves of their segment. A pair counts where its first difference lies, so just once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, stage

#: Words are maximal runs of these.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words need so many letters and occurrences.
LETTERS, OCCURRENCES = 7, 2
#: A form occurs this many times as often as the word it is the form of.
RATIO = 10
#: One run in so many loses a letter, see ``word_counts``.
MISSPELT = 31
#: Groups with more words are dealt again.
CROWD = 4096
#: Words a task counts before it hands them on.
HELD = 200_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def word_counts(docs: DataFrame, letters: int = LETTERS) -> DataFrame:
    """(word, n): occurrences of every word of at least ``letters`` letters in ``docs`` (doc_id, text).

    With h the crc32 of ``<doc_id>:<run>`` in UTF-8, a run loses its letter h % length if 31
    divides h. A null doc_id is written as nothing. Tasks add up before the shuffle.
    """

    def run(batches):
        held: Counter[str] = Counter()

        def give():
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), type=pa.string()), pa.array(held.values(), type=pa.int64())],
                names=["word", "n"],
            )
            held.clear()
            return out

        for batch in slices(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = Counter(RUN.findall((text or "").translate(_LOWER)))
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in own.items():
                    if len(word) >= letters:
                        h = zlib.crc32(word.encode(), start)
                        if h % MISSPELT == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < letters:
                                continue
                        held[word] += n
            if len(held) > HELD:
                yield give()
        yield give()

    return arrow_map(docs.select("doc_id", "text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class BitSlices:
    """Words, or segments of words, by position and letter; bit i of a set stands for word i."""

    def __init__(self, words: list[str], length: int) -> None:
        """``words`` have ``length`` letters or one more."""
        self.length = length
        slots: list[dict[str, list[int]]] = [{} for _ in range(length + 2)]
        equal: list[int] = []
        longer: list[int] = []
        for i, word in enumerate(words):
            (equal if len(word) == length else longer).append(i)
            for slot, letter in zip(slots, word):
                slot.setdefault(letter, []).append(i)
        self.at = [{letter: bits(ids) for letter, ids in slot.items()} for slot in slots]
        self.equal, self.longer = bits(equal), bits(longer)

    def of_equal(self, word: str, last: bool) -> int:
        """Words one replacement or one inserted letter away from ``word`` of ``length`` letters.

        ``last`` says whether a difference behind the last letter counts here.
        """
        none = self.equal | self.longer
        swapped = gained = 0
        for p, letter in enumerate(word):
            here = self.at[p].get(letter, 0)
            gained = (gained | none) & self.at[p + 1].get(letter, 0)
            swapped = swapped & here | none & ~here
            none &= here
            if not (none or swapped or gained):
                return 0
        gained = gained | none if last else gained & ~none
        return swapped & self.equal | gained & self.longer

    def of_longer(self, word: str, last: bool) -> int:
        """Words one deleted letter away from ``word`` of ``length + 1`` letters."""
        none, lost, before = self.equal, 0, 0
        for p, letter in enumerate(word):
            lost = (lost & self.at[p - 1].get(letter, 0) if p else 0) | none
            before, none = none, none & self.at[p].get(letter, 0)
            if not (none or lost):
                return 0
        return lost if last else lost & ~before


def bits(ids: list[int]) -> int:
    """The set of ``ids`` as an integer; ``ids`` ascend."""
    if len(ids) < 8:
        return sum(1 << i for i in ids)
    raw = bytearray(ids[-1] // 8 + 1)
    for i in ids:
        raw[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(raw, "little")


def _near_in(group: list[tuple[str, int]], length: int, lo: int, hi: int) -> list[tuple]:
    """(word, number of near words, the most frequent one's n, itself) for the words of one group."""
    if len(group) < 2:
        return []
    group.sort(key=lambda r: (-r[1], r[0]))
    own = [word[lo : hi + len(word) - length] for word, _ in group]
    slices_, last = BitSlices(own, hi - lo), hi == length
    out = []
    for (word, _), part in zip(group, own):
        found = (slices_.of_equal if len(word) == length else slices_.of_longer)(part, last)
        if found:
            best = group[(found & -found).bit_length() - 1]
            out.append((word, found.bit_count(), best[1], best[0]))
    return out


_PLACE = ["length", "lo", "hi", "rest"]


def _placed(words: DataFrame) -> DataFrame:
    """``words`` (word, n, length, lo, hi) with the group's ``rest``: all but the segment."""
    extra = F.length("word") - F.col("length")
    rest = F.concat(
        F.expr("substring(word, 1, lo)"), F.lit("|"), F.expr("substring(word, hi + 1 + length(word) - length)")
    )
    return words.where(extra.isin(0, 1)).select("word", "n", "length", "lo", "hi", rest.alias("rest"))


def _halves(words: DataFrame, lo: str, hi: str) -> DataFrame:
    mid = F.expr(f"{lo} + ({hi} - {lo}) div 2").cast("int")
    parts = F.explode(F.array(F.struct(F.col(lo).alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col(hi).alias("hi"))))
    return _placed(words.withColumn("_p", parts).select("word", "n", "length", "_p.lo", "_p.hi"))


def dealt(vocabulary: DataFrame, letters: int = LETTERS, crowd: int = CROWD) -> list[DataFrame]:
    """Rows (word, n, length, lo, hi, rest) of groups with at most ``crowd`` words, or one free letter."""
    roles = F.explode(F.array(F.length("word"), F.length("word") - 1))
    words = vocabulary.select("word", "n", roles.alias("length")).where(F.col("length") >= letters)
    rows = _halves(words.withColumns({"_lo": F.lit(0), "_hi": F.col("length")}), "_lo", "_hi")
    out = []
    while True:
        rows = stage(rows, "variant-groups")
        crowds = stage(
            rows.where("hi - lo > 1").groupBy(_PLACE).agg(F.count("*").alias("_n")).where(F.col("_n") > crowd).drop("_n"),
            "variant-crowds",
        )
        if crowds.isEmpty():
            return [*out, rows]
        out.append(rows.join(crowds, _PLACE, "left_anti"))
        rows = _halves(rows.join(crowds, _PLACE, "left_semi").withColumnsRenamed({"lo": "_lo", "hi": "_hi"}), "_lo", "_hi")


def near_words(vocabulary: DataFrame, letters: int = LETTERS, crowd: int = CROWD) -> DataFrame:
    """(word, n_near, best, best_n) for the words of ``vocabulary`` (word, n) with near words.

    ``best`` is the near word with the largest n, the smallest in code-point order among equals.
    ``vocabulary`` holds each word once, with at least ``letters`` letters.
    """

    def run(batches):
        place, group = None, []
        for batch in batches:
            found = []
            columns = [batch[c].to_pylist() for c in (*_PLACE, "word", "n")]
            for *key, word, n in zip(*columns):
                if key != place:
                    if place:
                        found += _near_in(group, *place[:3])
                    place, group = key, []
                group.append((word, n))
            yield _found(found)
        if place:
            yield _found(_near_in(group, *place[:3]))

    out = None
    for rows in dealt(vocabulary, letters, crowd):
        runs = rows.repartition(*_PLACE).sortWithinPartitions(*_PLACE)
        part = arrow_map(runs, run, "word string, near long, best_n long, best string")
        out = part if out is None else out.union(part)
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (
        out.groupBy("word")
        .agg(F.sum("near").alias("n_near"), first.alias("_b"))
        .select("word", "n_near", "_b.best", (-F.col("_b.m")).alias("best_n"))
    )


def _found(rows: list[tuple]) -> pa.RecordBatch:
    types = {"word": pa.string(), "near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types.values())], names=list(types))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the steps of ``forms`` (word, form) end, for every word with a form.

    Each round doubles the steps taken. Each step multiplies n by ``RATIO`` at least, so there are
    no cycles, and rounds grow with the logarithm of the number of digits of the largest n.
    """
    ways = stage(forms.select("word", F.col("form").alias("root")), "variant-ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ways = stage(
            ways.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            ),
            "variant-ways",
        )
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def variants(
    docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, ratio: int = RATIO, crowd: int = CROWD
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text).

    A word's form is its most frequent near word, if that occurs ``ratio`` times as often, else null;
    root is where the forms of forms end, the word itself without a form. Null, empty and blank texts
    have no words; repeated rows count again; words of any length are whole; other columns are not
    read. No words give no rows.
    """
    words = stage(word_counts(docs, letters).where(F.col("n") >= occurrences), "variant-words")
    near = near_words(words, letters, crowd)
    takes = F.col("best_n") >= ratio * F.col("n")
    formed = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(takes, F.col("best")).alias("form"),
            F.when(takes, F.col("best_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
