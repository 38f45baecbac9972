"""Tokens of two vocabularies on the same text, aligned where both end, and counted by id pair.

Spans come from the tokenizers themselves: character offsets from the byte-level one, the byte spans
of its proto from sentencepiece (as lists, since the installed version has no immutable protos). They are coarse cuts: several tokens of one multibyte character
share its span, and byte-fallback tokens have an empty one or that of the whole character. Where a
span does not fit the token's own bytes, the end is found from those bytes.

Texts are cut where white space begins, but not before signs of it that follow others inside some
token. So no token reaches over a cut, a piece has the same tokens wherever it stands, and it is
aligned once.
"""

from __future__ import annotations

import gc
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytepair import SHORT, SPACE, byte_letters
from .common import arrow_map, slices, stage

#: Pieces of a generation that a worker process remembers; there are two.
KNOWN = 200_000
_ROW_BITS = 33
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")

COLUMNS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"


def default_paths() -> tuple[str, str]:
    """The default vocabularies; executors read them from their own Python environment."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_padding()
        self.model.no_truncation()
        code = {c: b for b, c in enumerate(byte_letters())}
        self.token_bytes = [b""] * (1 + max(self.model.get_vocab().values()))
        for token, i in self.model.get_vocab().items():
            if all(c in code for c in token):
                self.token_bytes[i] = bytes(code[c] for c in token)
        self.sizes = np.array([len(t) for t in self.token_bytes])
        self.inner = inner_spaces(self.token_bytes)

    def spans(self, texts: list[str]) -> Tokens:
        """Ids and byte spans as far as the library tells them."""
        found = self.model.encode_batch(texts, add_special_tokens=False)
        ids, own = [got.ids for got in found], flat([got.offsets for got in found])
        # From characters to bytes, by the places where characters begin.
        raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
        starts = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        first = np.cumsum([0, *map(len, texts)])[:-1]
        first = np.repeat(first, np.fromiter(map(len, ids), dtype=np.int64))[:, None]
        return Tokens(self.sizes, ids, starts[own + first] - starts[first])


class Pieces:
    """A sentencepiece vocabulary with byte fallback; its texts begin with the space it would add."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        # Pieces inside a text would get a space of their own otherwise.
        spec.normalizer_spec.add_dummy_prefix = False
        self.model = SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.token_bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = _BYTE.match(piece) if self.model.is_byte(i) else None
            self.token_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.sizes = np.array([len(t) for t in self.token_bytes])
        self.inner = inner_spaces(self.token_bytes)

    def spans(self, texts: list[str]) -> Tokens:
        # The proto's ids and byte spans without an object for each token.
        found = self.model.encode(texts, return_type="offset_mapping", return_bytes=True, num_threads=1)
        return Tokens(self.sizes, [x["ids"] for x in found], flat([x["offsets"] for x in found]))


def flat(spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """The spans of several pieces as rows of (begin, end)."""
    numbers = chain.from_iterable(chain.from_iterable(spans))
    return np.fromiter(numbers, dtype=np.int64, count=2 * sum(map(len, spans))).reshape(-1, 2)


class Tokens:
    """The tokens of several pieces in a row: ids, how many each piece has, and where they end in it."""

    def __init__(self, sizes: np.ndarray, ids: list[list[int]], spans: np.ndarray) -> None:
        self.ids = np.fromiter(chain.from_iterable(ids), dtype=np.int64)
        self.counts = np.fromiter(map(len, ids), dtype=np.int64)
        self.first = np.cumsum(np.append(0, self.counts))
        self.sizes = sizes[self.ids]
        begin, end = spans.T
        total = np.append(0, np.cumsum(self.sizes))
        by_bytes = total[1:] - np.repeat(total[self.first[:-1]], self.counts)
        #: A span that holds just the token's bytes is right; others are refined by the bytes.
        self.ends = np.where(end - begin == self.sizes, end, by_bytes)
        self.lengths = total[self.first[1:]] - total[self.first[:-1]]

    def of(self, keep: np.ndarray) -> Tokens:
        """The tokens of the pieces to keep."""
        out = object.__new__(Tokens)
        rows = np.repeat(keep, self.counts)
        out.ids, out.sizes, out.ends = self.ids[rows], self.sizes[rows], self.ends[rows]
        out.counts, out.lengths = self.counts[keep], self.lengths[keep]
        out.first = np.cumsum(np.append(0, out.counts))
        return out


def inner_spaces(tokens: list[bytes]) -> set[str]:
    """The white space that follows another sign inside some token."""
    found = (re.findall(f"[^{SPACE}]([{SPACE}])", t.decode("utf-8", "replace")) for t in tokens)
    return {sign for signs in found for sign in signs}


def pieces_of(inner: set[str]) -> re.Pattern:
    """What texts are cut into; a piece goes on behind white space of ``inner``."""
    on = f"(?:[{re.escape(''.join(sorted(inner)))}][{SPACE}]*[^{SPACE}]*)*" if inner else ""
    return re.compile(f"[{SPACE}]*[^{SPACE}]+{on}|[{SPACE}]+")


def same_bytes(texts: list[bytes], tokens: Tokens, table: list[bytes]) -> np.ndarray:
    """Whether the bytes of a piece's tokens, one after the other, are the piece."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    same = tokens.lengths == lengths
    # Pieces of other lengths differ; the rest are compared byte by byte, all at once.
    spelt = b"".join(map(table.__getitem__, tokens.ids[np.repeat(same, tokens.counts)].tolist()))
    read = b"".join(compress(texts, same.tolist()))
    if spelt != read:
        differs = np.cumsum(np.append(0, np.frombuffer(spelt, np.uint8) != np.frombuffer(read, np.uint8)))
        same[same] = np.diff(differs[np.cumsum(np.append(0, lengths[same]))]) == 0
    return same


def grouped(a: Tokens, b: Tokens, names: list[list[str]]) -> list[tuple[str, bytes, int, int]]:
    """(groups, links, A tokens, B tokens) of pieces that ``a`` and ``b`` spell alike.

    A group ends where tokens of both end. A pair is linked where both its tokens end: the last
    ones of a group, as no token that is part of a text is without bytes. ``names`` has every id
    in decimal behind nothing, a comma, a semicolon and a bar.
    """
    base = np.append(0, np.cumsum(a.lengths))
    ends = [t.ends + np.repeat(base[:-1], t.counts) for t in (a, b)]
    common = np.intersect1d(*ends, assume_unique=True)
    group_a, group_b = (np.searchsorted(common, e) for e in ends)
    starts_a, starts_b = (np.append(True, g[1:] != g[:-1])[: len(g)] for g in (group_a, group_b))
    last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (group_a, group_b))
    links = (a.ids[last_a] << 32) | b.ids[last_b]
    # Both sides' tokens in the order in which they are written.
    place_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a)
    place_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, side="right")
    behind = np.empty(len(place_a) + len(place_b), dtype=np.int64)
    behind[place_a] = np.where(starts_a, 2, 1)
    behind[place_a[a.first[:-1]]] = 0
    behind[place_b] = np.where(starts_b, 3, 1)
    ids = np.empty_like(behind)
    ids[place_a], ids[place_b] = a.ids, b.ids
    written = [names[k][i] for k, i in zip(behind.tolist(), ids.tolist())]
    at = (a.first + b.first).tolist()
    group_at = np.searchsorted(common, base, side="right").tolist()
    return [
        ("".join(written[at[i] : at[i + 1]]), links[group_at[i] : group_at[i + 1]].tobytes(), n_a, n_b)
        for i, (n_a, n_b) in enumerate(zip(a.counts.tolist(), b.counts.tolist()))
    ]


class Aligner:
    """Alignments of whole texts; pieces met before are not aligned again."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.piece = pieces_of(self.a.inner | self.b.inner)
        n_ids = max(len(self.a.token_bytes), len(self.b.token_bytes))
        self.names = [[f"{mark}{i}" for i in range(n_ids)] for mark in ("", ",", ";", "|")]
        self.known: dict[str, tuple[str, bytes, int, int] | None] = {}
        self.before: dict[str, tuple[str, bytes, int, int] | None] = {}

    def of(self, texts: list[str | None]) -> list[tuple[str, bytes, int, int] | None]:
        """(groups, links as 64-bit numbers, A tokens, B tokens) of each text; None without tokens."""
        split = [self.piece.findall(" " + t) if t else [] for t in texts]
        if len(self.known) > KNOWN:
            # The last generation stays at hand, so what is frequent is not aligned again.
            self.known, self.before = {}, self.known
        known = self.known
        new = [p for p in dict.fromkeys(chain.from_iterable(split)) if p not in known]
        again = {p: self.before[p] for p in new if p in self.before}
        known.update(again)
        new = [p for p in new if p not in again]
        self._align(new)
        out = [_joined(list(map(known.__getitem__, pieces))) for pieces in split]
        for piece in new:
            if len(piece) > SHORT:
                del known[piece]
        return out

    def _align(self, pieces: list[str]) -> None:
        if not pieces:
            return
        # Millions of small tuples without cycles; looking for cycles among them takes a fifth of the time.
        gc.disable()
        try:
            self._align_all(pieces)
        finally:
            gc.enable()

    def _align_all(self, pieces: list[str]) -> None:
        data = [piece.encode() for piece in pieces]
        a, b = self.a.spans(pieces), self.b.spans(pieces)
        good = same_bytes(data, a, self.a.token_bytes) & same_bytes(data, b, self.b.token_bytes)
        found = iter(grouped(a.of(good), b.of(good), self.names))
        for piece, ok in zip(pieces, good.tolist()):
            self.known[piece] = next(found) if ok else None


def _joined(parts: list) -> tuple[str, bytes, int, int] | None:
    if not parts or None in parts:
        return None
    groups, links, n_a, n_b = zip(*parts)
    return ";".join(groups), b"".join(links), sum(n_a), sum(n_b)


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path)
    return _aligners[key] if key in _aligners else _aligners.setdefault(key, Aligner(*key))


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """A row for each one of ``docs`` (doc_id, text) with its groups and its linked id pairs.

    Columns: row (a number of its own), doc_id, n_a, n_b, n_groups, n_links, groups
    (``a1,a2|b1;a3|b2``, ids in order), pairs (pair = A id * 2^32 + B id, n = how many of the
    text's links hold it). Null and empty texts, and those whose tokens' bytes are not space and
    text, have no tokens: zeros, empty groups, no pairs. Repeated rows and null ids give a row each;
    long texts are aligned whole; other columns are not read. No rows give no rows.
    """
    default_a, default_b = default_paths()
    paths = (a_path or default_a, b_path or default_b)

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = _aligner(*paths)
        row = TaskContext.get().partitionId() << _ROW_BITS
        for batch in slices(batches):
            found = aligner.of(batch["text"].to_pylist())
            parts = [np.unique(np.frombuffer(x[1], dtype=np.int64), return_counts=True) if x else None for x in found]
            empty = np.empty(0, dtype=np.int64)
            ends = np.cumsum([0] + [len(p[0]) if p else 0 for p in parts])
            pairs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([empty] + [p[k] for p in parts if p]), type=pa.int64()) for k in (0, 1)],
                names=["pair", "n"],
            )
            groups = [x[0] if x else "" for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(found)), type=pa.int64()),
                    batch["doc_id"],
                    pa.array([x[2] if x else 0 for x in found], type=pa.int64()),
                    pa.array([x[3] if x else 0 for x in found], type=pa.int64()),
                    pa.array([g.count(";") + 1 if g else 0 for g in groups], type=pa.int64()),
                    pa.array([len(x[1]) // 8 if x else 0 for x in found], type=pa.int64()),
                    pa.array(groups, type=pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pairs),
                ],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"],
            )
            row += len(found)

    return arrow_map(docs.select("doc_id", "text"), run, COLUMNS + ", pairs array<struct<pair: long, n: long>>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): links of all ``rows`` (pairs) by pair; best marks a B id's highest counts.

    Pairs are added up in every task first, so a pair that stands in every text is no hot key. One
    B id has at most as many pairs as the A vocabulary has ids.
    """
    counts = rows.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def scored(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` (row, pairs, ...) without pairs, but with n_best and count_sum over their links.

    ``counts`` as by ``pair_counts``. A row's pairs stand together, so tasks add them up before
    the shuffle. Rows without pairs have zeros.
    """
    linked = rows.select("row", F.inline("pairs")).join(counts, "pair")
    sums = linked.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return (
        rows.drop("pairs", "n_best", "count_sum")
        .join(sums, "row", "left")
        .withColumns({"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)})
    )


def alignments(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``aligned`` without row, groups and pairs, with groups_sha256 (empty without tokens), n_best and count_sum.

    The alignment is written once, with the hash in place of the groups; counting and scoring read it.
    """
    found = aligned(docs, a_path, b_path)
    hashed = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = stage(found.withColumn("groups_sha256", hashed).drop("groups"), "aligned")
    return scored(rows, stage(pair_counts(rows), "pair-counts")).drop("row")
