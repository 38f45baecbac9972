"""Byte-level BPE in both directions, with a contiguous array of ranks for each word.

Texts are cut where white space begins; no word of the vocabulary's pattern reaches over such a
cut, so what is found for one piece holds wherever the piece stands, and each piece is merged
once. Merging holds, for a word, its parts and the ranks of neighbouring parts side by side: the
smallest rank is searched, its boundary deleted, the ranks beside it are looked up again. Words of
one length go through this together, as rows of one array: each live row loses one part a round.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_map, slices

#: White space as the vocabulary's pattern knows it.
SPACE = "\t-\r \x85\xa0  -     　"
#: Texts are cut into these pieces.
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: The words of byte-level vocabularies (fixed value, except that white space is spelled out).
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Longer words, in bytes, are merged with a heap; longer pieces are not remembered.
SHORT = 48
#: Pieces whose ids a worker process remembers.
KNOWN = 400_000
#: Rows of one array of words.
ROWS = 8192

_NO = np.int32(np.iinfo(np.int32).max)


def default_path() -> str:
    """The default vocabulary; executors read it from their own Python environment."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter a byte is written as: itself if printable in Latin-1, else the next from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    odd = iter(range(256, 512))
    return [chr(b if b in plain else next(odd)) for b in range(256)]


class Vocabulary:
    """Token bytes, merge ranks and marks of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or not cut.get("use_regex", True):
            raise ValueError(f"{path} is not a byte-level BPE vocabulary")
        if spec["normalizer"] or cut["add_prefix_space"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} needs steps that this encoder does not take")
        letters = byte_letters()
        code = {c: b for b, c in enumerate(letters)}
        ids = model["vocab"]
        self.marks = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * (1 + max([*ids.values(), *self.marks.values()]))
        for token, i in ids.items():
            self.token_bytes[i] = bytes(code[c] for c in token)
        for token, i in self.marks.items():
            self.token_bytes[i] = token.encode()
        self.of_byte = np.array([ids[c] for c in letters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of neighbours; those that never merge rank last."""
        keys = (left << 32) | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], _NO)


class Merger:
    """The ids of words, given as bytes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.rank_of = None

    def of(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, rows in by_length.items():
            if length > SHORT:
                for i in rows:
                    out[i] = self.long(words[i])
                continue
            for at in range(0, len(rows), ROWS):
                part = rows[at : at + ROWS]
                raw = np.frombuffer(b"".join([words[i] for i in part]), dtype=np.uint8)
                self._short(raw.reshape(len(part), length), part, out)
        return out

    def _short(self, raw: np.ndarray, rows: list[int], out: list[list[int]]) -> None:
        """Words of one length: ``parts`` and ``ranks`` lose one column a round, and rows that are done leave."""
        voc = self.vocabulary
        rows = np.array(rows)
        parts = voc.of_byte[raw]
        ranks = voc.rank(parts[:, :-1], parts[:, 1:])
        while True:
            width = ranks.shape[1]
            low = ranks.min(axis=1, initial=_NO)
            live = low < _NO
            if not live.all():
                for i, ids in zip(rows[~live].tolist(), parts[~live].tolist()):
                    out[i] = ids
                rows, parts, ranks, low = rows[live], parts[live], ranks[live], low[live]
            if not len(rows):
                return
            n = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            parts[n, at] = voc.merged[low]
            # The boundary after ``at`` goes, and with it the part and the rank that it began.
            keep = np.arange(width) + (np.arange(width) > at[:, None])
            parts = np.take_along_axis(parts, keep, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(keep[:, :-1] + (keep[:, :-1] == at[:, None]), width - 1), axis=1)
            if width > 1:
                inner = at > 0
                ranks[n[inner], at[inner] - 1] = voc.rank(parts[n[inner], at[inner] - 1], parts[n[inner], at[inner]])
                inner = at < width - 1
                ranks[n[inner], at[inner]] = voc.rank(parts[n[inner], at[inner]], parts[n[inner], at[inner] + 1])

    def long(self, word: bytes) -> list[int]:
        """One long word: parts as a linked list, pairs in a heap, so that time stays near linear."""
        voc = self.vocabulary
        if self.rank_of is None:
            self.rank_of = dict(zip(voc.keys.tolist(), voc.ranks.tolist()))
        rank_of, n = self.rank_of, len(word)
        parts = voc.of_byte[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < n:
                left, right = parts[at], parts[after[at]]
                rank = rank_of.get((left << 32) | right)
                if rank is not None:
                    heapq.heappush(heap, (rank, at, left, right))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            nxt = after[at]
            if parts[at] != left or nxt >= n or parts[nxt] != right:
                continue
            parts[at], parts[nxt] = int(voc.merged[rank]), -1
            after[at] = after[nxt]
            if after[nxt] < n:
                before[after[nxt]] = at
            offer(before[at])
            offer(at)
        return [p for p in parts if p >= 0]


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes; pieces met before are not merged again.

    ``marks`` says whether the strings of special tokens inside texts stand for those tokens.
    """

    def __init__(self, path: str, marks: bool = True) -> None:
        self.vocabulary = Vocabulary(path)
        self.merger = Merger(self.vocabulary)
        self.path = path
        self.marks = self.vocabulary.marks if marks else {}
        longest = sorted(self.marks, key=len, reverse=True)
        self.mark = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.words: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}

    def of(self, texts: list[str | None]) -> list[bytes]:
        split = [PIECE.findall(text) if text else [] for text in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
        known = self.known
        new = {p for pieces in split for p in pieces if p not in known}
        cut = {p: self._cut(p) for p in new}
        words = list({w for parts in cut.values() for w in parts if isinstance(w, bytes)})
        ids = dict(zip(words, (np.array(x, dtype="<i4").tobytes() for x in self.merger.of(words))))
        fresh = {
            p: b"".join([ids[w] if isinstance(w, bytes) else w.to_bytes(4, "little") for w in parts])
            for p, parts in cut.items()
        }
        known.update(fresh)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for p in fresh:
            if len(p) > SHORT:
                del known[p]
        return out

    def _cut(self, piece: str) -> list[bytes | int]:
        """The words of a piece as bytes, and special tokens as ids."""
        out: list[bytes | int] = []
        for part in self.mark.split(piece) if self.mark else [piece]:
            if part in self.marks:
                out.append(self.marks[part])
            elif part:
                out += [w.encode() for w in self._words(part)]
        return out

    def _words(self, part: str) -> list[str]:
        if part.isascii() or all(unicodedata.category(c) != "Cn" for c in part):
            return WORD.findall(part)
        # Signs that Python does not know yet: the library that made the file knows its own classes.
        from tokenizers import pre_tokenizers

        cuts = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(part)
        return [part[a:b] for a, b in dict.fromkeys(span for _, span in cuts)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, marks: bool = True) -> Encoder:
    """One encoder for all tasks of a worker process, so that pieces met by one are known to the next."""
    key = (path, marks)
    return _encoders[key] if key in _encoders else _encoders.setdefault(key, Encoder(path, marks))


def encoded(docs: DataFrame, path: str | None = None, marks: bool = True) -> DataFrame:
    """doc_id and ids, an array of int, for every row of ``docs`` (doc_id, text); other columns are not read.

    Null and empty texts have no ids. Repeated rows and null ids give a row each; very long texts
    and words are encoded whole, in near linear time. Special tokens inside a text become their id
    if ``marks``, else plain text. No rows give no rows.
    """
    path = path or default_path()

    def run(batches):
        own = encoder(path, marks)
        for batch in slices(batches):
            found = own.of(batch["text"].to_pylist())
            ends = np.cumsum([0] + [len(x) // 4 for x in found])
            ids = np.frombuffer(b"".join(found), dtype="<i4")
            lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(ids, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], names=["doc_id", "ids"])

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and where each token's begin."""
    if path not in _tables:
        tokens = encoder(path).vocabulary.token_bytes
        _tables[path] = (
            np.frombuffer(b"".join(tokens), dtype=np.uint8),
            np.cumsum([0] + [len(t) for t in tokens]),
        )
    return _tables[path]


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` (doc_id, ids) with the ids' ``text`` appended; special tokens are written out.

    Bytes that are no UTF-8 become U+FFFD. Null or empty ids give the empty text. Columns besides
    doc_id and ids are dropped. No rows give no rows. An id outside of the vocabulary fails.
    """
    path = path or default_path()

    def run(batches):
        data, starts = _table(path)
        for batch in slices(batches):
            lists = batch["ids"]
            counts = np.asarray(lists.value_lengths().fill_null(0))
            ids = np.asarray(lists.flatten())
            sizes = starts[ids + 1] - starts[ids]
            ends = np.append(0, np.cumsum(sizes))
            place = np.repeat(starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])
            joined = data[place].tobytes()
            cuts = ends[np.append(0, np.cumsum(counts))].tolist()
            texts = [joined[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], lists, pa.array(texts, type=pa.string())], names=["doc_id", "ids", "text"]
            )

    return arrow_map(rows.select("doc_id", "ids"), run, "doc_id long, ids array<int>, text string")
