"""Language of texts by a linear-chain conditional random field over their words."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, mix, slices

#: The field is fitted to at most so many documents of each language, and windows of so many words
#: from each; the languages themselves are found in all labelled documents.
SAMPLE, WINDOWS, WIDTH = 256, 3, 60
#: Hashed features, passes over the sequences, sequences in a step, its size and penalty.
BUCKETS, PASSES, BATCH, STEP, PENALTY = 1 << 17, 4, 64, 0.2, 1e-5
#: Occurrences from which a word may enter the lexicon, and its share in one language.
LEXICON_MIN, LEXICON_SHARE = 3, 0.9
#: Documents whose crc32 of the id leaves 1 by FOLDS are held out.
FOLDS, HELD = 3, 1
UNKNOWN = "und"
#: Words whose scores a task remembers, and documents it reads at a time.
_KNOWN, _ROWS = 200_000, 1024

_U = np.uint64
_PRIME = _U(0x100000001B3)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def held_out() -> Column:
    """Whether a document is kept from learning; a null id is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(True))


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, one word's after the other's, and how many each has.

    Affixes of up to three letters, n-grams of two and three with the word's edges, the word
    itself, and the language that its lexicon entry names.
    """
    joined = "".join(f"^{w}$" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    last = np.cumsum(sizes) - 1
    first, word = last - sizes + 1, np.arange(len(words))
    owner = np.repeat(word, sizes)
    two = codes[:-1] * _PRIME + codes[1:]
    grams = {1: codes, 2: two, 3: two[:-1] * _PRIME + codes[2:]}
    owners, hashes = [], []

    def add(who: np.ndarray, values: np.ndarray, tag: int) -> None:
        owners.append(who)
        hashes.append(mix(values ^ _U(tag << 56)))

    for n, values in grams.items():
        if n > 1:
            inside = owner[: len(values)] == owner[n - 1 :]
            add(owner[: len(values)][inside], values[inside], n)
        long = sizes - 2 >= n
        add(word[long], values[first[long] + 1], 10 + n)
        add(word[long], values[last[long] - n], 20 + n)
    crc = (zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)
    add(word, np.fromiter(crc, dtype=np.uint64, count=len(words)), 30)
    named = np.fromiter((lexicon.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    add(word[named >= 0], named[named >= 0].astype(np.uint64), 31)
    who = np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    buckets = (np.concatenate(hashes) & _U(BUCKETS - 1)).astype(np.int64)
    return buckets[order], np.bincount(who, minlength=len(words))


class Field:
    """Weights of features by label, transitions, and what both say about sequences of words."""

    def __init__(self, labels: list[str], lexicon: dict[str, int]) -> None:
        self.labels, self.lexicon = labels, lexicon
        n = len(labels)
        self.weights = np.zeros((BUCKETS, n), dtype=np.float32)
        self.transitions = np.zeros((n, n))
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, n), dtype=np.float32)

    def emissions(self, texts: list[list[str]]) -> list[np.ndarray]:
        """A row of scores for each word of each text; words met before are not taken apart again."""
        if len(self.known) > _KNOWN:
            self.known, self.scores = {}, self.scores[:0]
        new = list({w for words in texts for w in words if w not in self.known})
        if new:
            found, sizes = features(new, self.lexicon)
            added = np.add.reduceat(self.weights[found], np.cumsum(sizes) - sizes, axis=0)
            self.known |= {w: len(self.scores) + k for k, w in enumerate(new)}
            self.scores = np.concatenate([self.scores, added])
        get = self.known.__getitem__
        return [self.scores[np.fromiter(map(get, words), dtype=np.int64, count=len(words))] for words in texts]

    def posteriors(self, rows: list[np.ndarray], pairs: bool = False):
        """Each row's probabilities of the labels by forward-backward, all rows step by step together.

        Rows stand by falling length, so those still running are the first ones. With ``pairs``
        also the expected transitions.
        """
        order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
        lengths = np.array([len(rows[i]) for i in order])
        n, top = len(self.labels), int(lengths[0]) if len(rows) else 0
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate([rows[i] for i in order] or [np.empty((0, n))]).astype(np.float64)
        likely = np.exp(flat - flat.max(axis=1, keepdims=True, initial=0))
        step = np.exp(self.transitions)
        running = np.searchsorted(-lengths, -np.arange(top), side="left")  # rows longer than t
        ahead = np.empty_like(likely)
        now = np.full((len(rows), n), 1 / n)
        for t in range(top):
            k = running[t]
            now = likely[starts[:k] + t] * (now[:k] @ step if t else now[:k])
            now /= now.sum(axis=1, keepdims=True)
            ahead[starts[:k] + t] = now
        expected = np.zeros((n, n))
        both = np.empty_like(likely)
        back = np.ones((len(rows), n))
        for t in range(top - 1, -1, -1):
            k = running[t]
            at = starts[:k] + t
            if t + 1 < top:
                k2 = running[t + 1]
                weighed = likely[at[:k2] + 1] * back[:k2]
                if pairs and k2:
                    joint = ahead[at[:k2], :, None] * step * weighed[:, None, :]
                    expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                back[:k2] = weighed @ step.T
                back[:k2] /= back[:k2].sum(axis=1, keepdims=True)
            p = ahead[at] * back[:k]
            both[at] = p / p.sum(axis=1, keepdims=True)
        out: list = [None] * len(rows)
        for place, i in enumerate(order):
            out[i] = both[starts[place] : starts[place] + lengths[place]]
        return (out, expected) if pairs else out


def fit(samples: list[tuple[str, list[str]]], seed: int = 7) -> Field | None:
    """A field from (language, words) windows; None without any.

    Windows of several languages are cut and joined to sequences that switch language, so that the
    transitions are learned too. Gradient steps (Adagrad) on the sequences' log-likelihood.
    """
    samples = sorted((s for s in samples if s[1]), key=lambda s: (s[0], s[1]))
    if not samples:
        return None
    labels = sorted({s[0] for s in samples})
    counts: dict[str, np.ndarray] = {}
    for label, words in samples:
        for w in words:
            counts.setdefault(w, np.zeros(len(labels)))[labels.index(label)] += 1
    lexicon = {
        w: int(c.argmax()) for w, c in counts.items() if c.sum() >= LEXICON_MIN and c.max() >= LEXICON_SHARE * c.sum()
    }
    field = Field(labels, lexicon)
    rng = np.random.default_rng(seed)
    pieces = []
    for label, words in samples:
        cuts = np.sort(rng.integers(0, len(words) + 1, 2))
        pieces += [(labels.index(label), p) for p in np.split(np.array(words, dtype=object), cuts) if len(p)]
    flat, sizes = features(list(counts), lexicon)
    found = dict(zip(counts, np.split(flat, np.cumsum(sizes)[:-1])))
    past, past_t = np.full_like(field.weights, 1e-6), np.full_like(field.transitions, 1e-6)
    for _ in range(PASSES):
        order = rng.permutation(len(pieces))
        joined = [order[i : i + 3] for i in range(0, len(order), 3)]
        for at in range(0, len(joined), BATCH):
            batch = [[pieces[k] for k in ks] for ks in joined[at : at + BATCH]]
            truth = [np.concatenate([np.full(len(p), y) for y, p in ps]) for ps in batch]
            flat = [found[w] for ps in batch for _, p in ps for w in p]
            owner = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
            index = np.concatenate(flat)
            starts = np.cumsum([0, *map(len, flat)])[:-1]
            scores = np.add.reduceat(field.weights[index], starts, axis=0)
            rows = np.split(scores, np.cumsum([len(y) for y in truth])[:-1])
            said, expected = field.posteriors(rows, pairs=True)
            error = np.concatenate(said)
            error[np.arange(len(error)), np.concatenate(truth)] -= 1
            seen = np.zeros_like(field.transitions)
            for y in truth:
                np.add.at(seen, (y[:-1], y[1:]), 1)
            used, place = np.unique(index, return_inverse=True)
            grad = np.zeros((len(used), len(labels)), dtype=np.float32)
            np.add.at(grad, place, error[owner].astype(np.float32))
            grad = grad / len(batch) + PENALTY * field.weights[used]
            past[used] += grad * grad
            field.weights[used] -= STEP * grad / np.sqrt(past[used])
            grad_t = (expected - seen) / len(batch)
            past_t += grad_t * grad_t
            field.transitions -= STEP * grad_t / np.sqrt(past_t)
    return field


def learned(docs: DataFrame) -> Field | None:
    """The field of the documents (doc_id, text, lang) with a language that are not held out.

    For each language the documents with the least id hash in each of SAMPLE cells of a second
    hash are taken, so any language has its share; the sample's bound is languages * SAMPLE.
    """
    known = docs.where("lang IS NOT NULL").where(~held_out())
    cell = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLE))
    chosen = (
        known.groupBy("lang", cell.alias("cell"))
        .agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id")).alias("m"))
        .select(F.col("lang").alias("_lang"), F.col("m.doc_id").alias("_id"))
        .collect()
    )
    ids: dict[str, set[int]] = {}
    for row in chosen:
        ids.setdefault(row["_lang"], set()).add(row["_id"])

    def run(batches):
        for batch in slices(batches):
            out = []
            for doc_id, text, lang in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "lang"))):
                if doc_id in ids.get(lang, ()):
                    words = words_of(text)
                    for k in range(WINDOWS):
                        # Windows spread over the whole text.
                        start = max(0, len(words) - WIDTH) * k // max(1, WINDOWS - 1)
                        if k == 0 or len(words) > WIDTH * k:
                            out.append((lang, words[start : start + WIDTH]))
            if out:
                lang, words = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang), pa.array(words, type=pa.list_(pa.string()))], names=["lang", "words"]
                )

    windows = arrow_map(known.select("doc_id", "text", "lang"), run, "lang string, words array<string>").toArrow()
    return fit(list(zip(windows["lang"].to_pylist(), windows["words"].to_pylist())))


def labelled_words(field: Field, text: str | None) -> list[tuple[str, str]]:
    """(word, language) for the words of a text, languages mixed or not."""
    words = words_of(text)
    if not words:
        return []
    best = field.posteriors(field.emissions([words]))[0].argmax(axis=1)
    return [(w, field.labels[k]) for w, k in zip(words, best)]


def predicted(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_switches for each row of ``docs`` (doc_id, text).

    The prediction is the language that most of the text's words are expected to be in, the score
    their expected share. n_switches counts changes of the likeliest language between neighbouring
    words. Null text, or one without letters, or no field: ``und``, score 0. Rows are taken one by
    one, whatever their ids; a null id counts as held out; other columns are ignored.
    """

    def run(batches):
        own = Field(field.labels, field.lexicon) if field else None
        if own:
            own.weights, own.transitions = field.weights, field.transitions
        for batch in slices(batches, _ROWS):
            words = [words_of(t) if own else [] for t in batch["text"].to_pylist()]
            rows = [(UNKNOWN, 0.0, 0)] * len(words)
            some = [i for i, w in enumerate(words) if w]
            if some:
                said = own.posteriors(own.emissions([words[i] for i in some]))
                for i, p in zip(some, said):
                    mean = p.mean(axis=0)
                    best = int(mean.argmax())
                    switches = int(np.count_nonzero(np.diff(p.argmax(axis=1))))
                    rows[i] = (own.labels[best], min(1.0, float(mean[best])), switches)
            lang, score, switches = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(lang),
                    pa.array(score),
                    pa.array(switches, type=pa.int32()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "n_switches"],
            )

    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return arrow_map(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, n_switches int")
