"""Best-fit packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import json
import unicodedata
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, slices, stage

#: Tokens in a sequence; the id that ends a document.
CAPACITY, END = 2048, 0
#: Words whose ids a task remembers.
_KNOWN = 800_000
#: Words of letters that are encoded as one text.
_TOGETHER = 64
_SIGNS = b".,;:!?#$%&*()-"
#: Words as the default vocabulary's file gives them (fixed value).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_RANK_BITS = 40


def tokenizer_path() -> str:
    """The default vocabulary; executors read it from their own Python environment."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of texts as little-endian bytes; words met before are not encoded again.

    A vocabulary that composes and lower-cases its text and drops white space (``_by_words``) never
    joins tokens across it, so a text's ids are its words' ids. It does not tell A-Z from a-z
    either, nor join a letter and the signs that end its word. Others get whole texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_padding()
        self.model.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_words = _by_words(spec)
        #: Which tokens end a word; None if the vocabulary does not mark them.
        self.last = None
        if suffix := spec["model"].get("end_of_word_suffix"):
            self.last = np.zeros(self.model.get_vocab_size(), dtype=bool)
            self.last[[i for token, i in self.model.get_vocab().items() if token.endswith(suffix)]] = True
        #: Words as they stand, and what was encoded for them: words without their last signs.
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def of(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_words:
            found = self.model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [array("I", got.ids).tobytes() for got in found]
        split = []
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            # Only the marks of special tokens tell letters' cases apart.
            split.append((data if b"<|" in data else data.lower()).split())
        if len(self.known) + len(self.parts) > _KNOWN:
            self.known.clear()
            self.parts.clear()
        known, parts = self.known, self.parts
        new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known]
        cores = {w: w.rstrip(_SIGNS) for w in new if not w.isalpha()}
        cut = {w: core for w, core in cores.items() if len(core) < len(w) and _ends(core, w)}
        whole = [w for w in new if w not in cut]
        needed = dict.fromkeys(chain(whole, cut.values(), (w[len(c) :] for w, c in cut.items())))
        self._encode([x for x in needed if x not in parts])
        known.update(zip(whole, map(parts.__getitem__, whole)))
        known.update((w, parts[core] + parts[w[len(core) :]]) for w, core in cut.items())
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def _encode(self, parts: list[bytes]) -> None:
        """Words of letters alone go to the library many at a time: each ends with a token that says so."""
        if self.last is not None:
            words = [x for x in parts if x.isalpha() or not x.isascii() and _letters(x)]
            texts = [b" ".join(words[i : i + _TOGETHER]).decode() for i in range(0, len(words), _TOGETHER)]
            found = self.model.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(got.ids for got in found), dtype="<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(words):
                raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                self.parts.update(zip(words, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
                parts = [x for x in parts if x not in self.parts]
        for at in range(0, len(parts), 4096):
            chunk = parts[at : at + 4096]
            found = self.model.encode_batch_fast([x.decode() for x in chunk], add_special_tokens=False)
            for part, got in zip(chunk, found):
                self.parts[part] = array("I", got.ids).tobytes()


def _letters(part: bytes) -> bool:
    """Whether a part is letters alone, also when composed and in lower case."""
    if part.isascii():
        return part.isalpha()
    text = part.decode()
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


def _by_words(spec: dict) -> bool:
    """Whether a vocabulary file composes (NFC), lower-cases, and keeps signs by one pattern that drops white space."""
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (
        [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and cuts[0].get("pattern") == {"Regex": _WORDS}
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    )


def _ends(core: bytes, word: bytes) -> bool:
    """Whether a token is sure to end where the signs after a word's last letter begin.

    The vocabulary composes and lower-cases first, which can turn a letter into a letter and a
    mark; a mark is not parted from the signs behind it.
    """
    if not core or b"'" in word or b"<|" in word:
        return False
    if core[-1] < 128:
        return 97 <= core[-1] <= 122 or 65 <= core[-1] <= 90
    return unicodedata.category(unicodedata.normalize("NFC", core.decode()).lower()[-1])[0] == "L"


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process, so that words met by one are known to the next."""
    return _encoders[path] if path in _encoders else _encoders.setdefault(path, WordEncoder(path))


def tokenized(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, ids: bool = False
) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, and ids if asked for.

    A document is its text's ids and ``end``; null text counts as empty. One longer than
    ``capacity`` is cut into pieces of that length, the last may be shorter. ids are
    little-endian unsigned 32-bit numbers.
    """
    path = path or tokenizer_path()
    last = int(end).to_bytes(4, "little")
    schema = PIECES + (", ids binary" if ids else "")

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in slices(batches):
            rows = []
            for doc_id, data in zip(batch["doc_id"].to_pylist(), encoder.of(batch["text"].to_pylist())):
                data += last
                n = len(data) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = data[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows))[: 5 + ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)], names=names[: 5 + ids]
            )

    return arrow_map(docs.select("doc_id", "text"), run, schema)


class Tightest:
    """A segment tree over remaining capacities: the smallest one, from a given one on, with open bins."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, capacity: int, bins: int) -> None:
        at = capacity + self.size
        while at:
            self.open[at] += bins
            at //= 2

    def find(self, least: int) -> int | None:
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1 and (at % 2 or not self.open[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at + (not self.open[2 * at])
        return at - self.size


def best_fit(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing for ``counts`` of pieces by length.

    Returns (plan, number of bins). Documents of one length are alike, and so are bins with the
    same room, so runs of them are placed at once, each run by one search in the tree: the work is
    bounded by the number of lengths, not of documents. A row of the plan is (length, first rank,
    first bin, offset): pieces of the length from that rank on go to consecutive bins.
    """
    tree = Tightest(capacity)
    room: dict[int, list[tuple[int, int]]] = {}
    plan: list[tuple[int, int, int, int]] = []
    n_bins = 0

    def give(left: int, first: int, n: int) -> None:
        if n and left:
            room.setdefault(left, []).append((first, n))
            tree.add(left, n)

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            left = tree.find(length)
            if left is None:
                left = capacity
                first, bins = n_bins, -(-todo // (capacity // length))
                n_bins += bins
            else:
                first, bins = room[left].pop()
                tree.add(left, -bins)
            each = left // length
            used = min(bins, -(-todo // each))
            give(left, first + used, bins - used)
            # Each bin in turn takes as many as fit; all but the last one take ``each``.
            placed = min(todo, used * each)
            short = used * each - placed
            for layer in range(each):
                n = used if layer < each - short else used - 1
                if n:
                    plan.append((length, rank, first, capacity - left + layer * length))
                    rank += n
            give(left - each * length, first, used - (short > 0))
            give(left - (each - short) * length, first + used - 1, int(short > 0))
            todo -= placed
    return np.array(plan, dtype=np.int64).reshape(-1, 4), n_bins


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset appended.

    Only the number of pieces of each length goes to the driver, at most ``capacity`` rows, and
    the plan that comes back is bounded by the capacity too. Pieces of a length are ranked in cells
    of (length, hash), so a frequent length is ranked by many tasks. Equal rows are placed each on
    its own. Columns of the appended names are replaced. No rows give no rows.
    """
    spark = pieces.sparkSession
    cells = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = pieces.drop("sequence_id", "offset")
    salted = own.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells)))
    counted = stage(salted.groupBy("length", "_cell").agg(F.count("*").alias("_n")), "pack-cells")
    totals = counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    plan, _ = best_fit({r.length: r.n for r in totals}, capacity)
    keys = (plan[:, 0] << _RANK_BITS) | plan[:, 1]
    order = np.argsort(keys)
    keys, plan = keys[order], plan[order]

    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_in", F.row_number().over(inside))
        .join(offsets, ["length", "_cell"])
        .select(*own.columns, (F.col("_before") + F.col("_in") - 1).alias("_rank"))
    )

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch[c]) for c in ("length", "_rank"))
            row = plan[np.searchsorted(keys, (length << _RANK_BITS) | rank, side="right") - 1]
            out = [batch[c] for c in batch.schema.names if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])],
                names=[*names, "sequence_id", "offset"],
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return arrow_map(ranked, place, f"{ddl}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack; the pieces are written once, without their ids."""
    return packed(stage(tokenized(docs, path, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The training sequences themselves: sequence_id and ids, an array of at most ``capacity``."""
    placed = packed(stage(tokenized(docs, path, capacity, ids=True), "pieces"), capacity)
    joined = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))

    def run(batches):
        for batch in slices(batches):
            ids = [
                np.frombuffer(b"".join(x["ids"] for x in p), dtype="<u4").astype(np.int32)
                for p in batch["p"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["sequence_id"], pa.array(ids, type=pa.list_(pa.int32()))], names=["sequence_id", "ids"]
            )

    return arrow_map(joined, run, "sequence_id long, ids array<int>")
