"""Near-duplicate documents by SuperMinHash signatures, banding, verification and components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    RangeHash,
    arrow_map,
    batch_of,
    carried,
    mix,
    shingles,
    shuffled,
    slices,
    spaced_words,
    stage,
    unpacked,
)
from .components import components

#: Words in a shingle, and the similarity from which documents are linked, in percent.
SHINGLE, PERCENT = 5, 85
#: Signature places: bands of rows. A pair at 0.85 shares no band with probability 5e-7.
BANDS, ROWS = 25, 5
#: Elements ranked at a time; bounds the permutation table.
_BLOCK = 8192

_U = np.uint64


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """SuperMinHash signatures (one row each) of sets of 64-bit hashes; infinite for empty sets.

    Every element draws a random permutation of the places, one step of it at a time; in step j
    it offers the rank j + r to its j-th place. Ranks of one element differ from place to place by
    their whole part, which is what correlates the places and lowers the variance. A later step
    offers only larger ranks, so a set stops drawing once each of its places holds less than the
    next step. Elements are ranked in blocks, whole sets of any size in as many as they need.
    """
    least = np.full((len(sets), places), np.inf)
    elements = np.concatenate([*sets, np.empty(0, np.uint64)])
    owners = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    for at in range(0, len(elements), _BLOCK):
        state, owner = elements[at : at + _BLOCK], owners[at : at + _BLOCK]
        order = np.tile(np.arange(places, dtype=np.int16), (len(state), 1))
        rows = np.arange(len(state))
        for j in range(places):
            open_ = least.max(axis=1)[owner] > j
            if (n := np.count_nonzero(open_)) < 0.8 * len(state):
                state, owner, order, rows = state[open_], owner[open_], order[open_], rows[:n]
            if not n:
                break
            state = mix(state)
            k = j + ((state & _U(0xFFFFFFFF)) * _U(places - j) >> _U(32)).astype(np.int64)
            place = order[rows, k]
            order[rows, k] = order[:, j]
            np.minimum.at(least.reshape(-1), owner * places + place, j + (mix(state) >> _U(11)) * 2.0**-53)
    return least


def bands(signature: np.ndarray, n: int, rows: int) -> np.ndarray:
    """One 64-bit key for each of ``n`` bands of ``rows`` places."""
    bits = signature[: n * rows].view(np.uint64).reshape(n, rows)
    key = np.zeros(n, dtype=np.uint64)
    for column in bits.T:
        key = mix(key ^ column)
    return key.view(np.int64)


_SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
     ("keys", pa.list_(pa.int64()))]
)
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _name(elements: np.ndarray) -> tuple[int, int]:
    """A 128-bit hash of a set, 0 if empty."""
    return int(elements.sum().view(np.int64)), int(mix(elements ^ _U(0x5DEECE66D)).sum().view(np.int64))


def sketch(docs: DataFrame, size: int = SHINGLE, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set (0 if empty) and the band keys (null if empty)."""

    def run(batches):
        hasher, known = RangeHash(), {}
        for batch in slices(batches, 64):
            found = [shingles(spaced_words(t), size, hasher) for t in batch["text"].to_pylist()]
            names = [_name(x) for x in found]
            # Exact copies met lately are not signed again.
            if len(known) > 4096:
                known.clear()
            new = {n: x for n, x in zip(names, found) if len(x) and n not in known}
            signed = super_minhash([*new.values()], n_bands * rows)
            known |= {n: bands(x, n_bands, rows) for n, x in zip(new, signed)}
            keys = [known[n] if len(x) else None for n, x in zip(names, found)]
            yield batch_of(_SKETCH, batch["doc_id"], [len(x) for x in found], *zip(*names), keys)

    return arrow_map(
        docs.select("doc_id", "text"),
        run,
        "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>",
    )


def links(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough, compared text by text."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        hasher, sets = RangeHash(), {}

        def of(text):
            if text not in sets:
                if len(sets) >= 64:
                    sets.clear()
                sets[text] = shingles(spaced_words(text), size, hasher)
            return sets[text]

        for batch in slices(batches, 32):
            hits = []
            for a, b, s, t in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                u, v = of(s), of(t)
                both = len(np.intersect1d(u, v, assume_unique=True))
                if both and 100 * both >= percent * (len(u) + len(v) - both):
                    hits.append((a, b))
            if hits:
                yield batch_of(_PAIRS, *zip(*hits))

    both = pairs.join(shuffled(left), "a").join(shuffled(right), "b").select("a", "b", "text_a", "text_b")
    return arrow_map(both, run, "a long, b long").distinct()


def rare_shingles(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, rare): how many shingles of a text are in no other one; ids of several texts are left out."""

    def run(batches):
        hasher = RangeHash()
        for batch in slices(batches, 64):
            found = [shingles(spaced_words(t), size, hasher).view(np.int64) for t in batch["text"].to_pylist()]
            owner = np.repeat(np.asarray(batch["doc_id"]), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(np.concatenate(found))], names=["doc_id", "shingle"]
            )

    each = arrow_map(texts, run, "doc_id long, shingle long")
    rare = each.groupBy("shingle").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id")).where("c = 1")
    single = texts.groupBy("doc_id").agg(F.count("*").alias("c")).where("c = 1").select("doc_id")
    return rare.groupBy("doc_id").agg(F.count("*").alias("rare")).join(single, "doc_id")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, n_bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns ignored): doc_id, n_shingles,
    component_id, kept.

    Documents of equal sets form a class, and its smallest doc_id, the head, stands for it from
    then on. Each head is compared with the smallest head it shares a band key with, which joins
    most groups at one comparison for each member. Then all pairs are compared that share a key
    and are not connected yet, so no link that could join two components is lost, while a group of
    n copies costs about n comparisons. Comparisons are made on full sets of whole texts.

    Null or wordless text: n_shingles 0, linked with nothing, kept. Null doc_id: component_id
    null, kept. Rows that repeat a doc_id are one document that has each of their texts: it is
    linked by any of them; equal rows get equal results. Empty input gives no rows.
    """
    known = stage(sketch(docs, size, n_bands, rows), "sketch")
    classes = stage(
        known.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("head"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")),
        "classes",
    )
    entries = classes.select("head", "n", F.posexplode("keys").alias("band", "key"))
    crowded = stage(
        entries.groupBy("band", "key")
        .agg(F.min("head").alias("least"), F.max("head").alias("most"))
        .where("least < most")
        .select("band", "key", "least"),
        "crowded",
    )
    buckets = stage(entries.join(shuffled(crowded), ["band", "key"]), "buckets")
    wanted = buckets.select(F.col("head").alias("doc_id")).distinct()
    texts = stage(docs.select("doc_id", "text").join(shuffled(wanted), "doc_id", "left_semi"), "texts")

    star = buckets.where("head > least").groupBy(F.col("head").alias("b")).agg(F.min("least").alias("a"))
    edges = stage(links(star, texts, size, percent), "links")
    edges = stage(edges.union(_rest(buckets, classes, edges, texts, size, percent)), "links")

    heads = stage(
        classes.select("set_a", "set_b", F.col("head").alias("id"))
        .join(shuffled(components(edges)), "id", "left")
        .select("set_a", "set_b", F.coalesce("component", "id").alias("component_id")),
        "heads",
    )
    alone = F.col("n_shingles") == 0
    return (
        known.drop("keys")
        .join(shuffled(heads), ["set_a", "set_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNull() | alone, F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _rest(
    buckets: DataFrame, classes: DataFrame, edges: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between members of a bucket that ``edges`` do not connect.

    What only one text has no other can share, so the rest of each text bounds its intersections
    and rules most pairs out. In each bucket the member with the least of its own is compared with
    the others; then every pair that is still apart and not ruled out is compared.
    """
    members, split = _apart(buckets.select("band", "key", "head", "n"), components(edges))
    members = stage(members.join(shuffled(split), ["band", "key"]).select("band", "key", "head", "n"), "split-members")
    asked = members.select(F.col("head").alias("doc_id")).distinct()
    alone = rare_shingles(texts.join(shuffled(asked), "doc_id", "left_semi"), size)
    members = stage(
        members.join(shuffled(alone), members["head"] == alone["doc_id"], "left")
        .withColumn("c", F.col("n") - F.coalesce("rare", F.lit(0)))
        .where(f"100 * c >= {percent} * n")
        .drop("doc_id", "rare"),
        "members-left",
    )
    possible = f"100 * least(c, c_b) >= {percent} * (n + n_b - least(c, c_b))"
    central = stage(
        members.groupBy("band", "key")
        .agg(F.max(F.struct((F.col("c") / F.col("n")).alias("share"), (-F.col("head")).alias("b"), "n", "c")).alias("m"))
        .select("band", "key", (-F.col("m.b")).alias("b"), F.col("m.n").alias("n_b"), F.col("m.c").alias("c_b")),
        "central",
    )
    near = members.join(shuffled(central), ["band", "key"]).where("head <> b").where(possible)
    first = stage(links(stage(_ordered(near), "pairs"), texts, size, percent), "links")

    members, split = _apart(members, components(edges.union(first)))
    keys = classes.select(F.col("head").alias("id"), "keys")
    members = members.join(shuffled(split), ["band", "key"])
    members = stage(
        members.join(shuffled(keys), members["head"] == keys["id"]).where(F.get("keys", "band") == F.col("key")).drop("id"),
        "members-apart",
    )
    # The largest part of a bucket meets all others; among the others each pair comes once, and it
    # comes in the first bucket that its two members share.
    other = members.where("component <> main").select(
        "band", "key", F.col("head").alias("b"), F.col("n").alias("n_b"), F.col("c").alias("c_b"),
        F.col("component").alias("of_b"), F.col("keys").alias("keys_b"),
    )
    pairs = (
        members.join(shuffled(other), ["band", "key"])
        .where("component <> of_b AND (component = main OR head < b)")
        .where(possible)
        .where("array_position(zip_with(keys, keys_b, (x, y) -> x = y), true) = band + 1")
    )
    return first.union(links(stage(_ordered(pairs), "pairs"), texts, size, percent))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("head", "b").alias("a"), F.greatest("head", "b").alias("b")).distinct()


def _apart(members: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` with their components, and the buckets of several with the largest part's, ``main``."""
    at = stage(
        members.join(shuffled(found), members["head"] == found["id"], "left")
        .withColumn("component", F.coalesce("component", "head"))
        .drop("id"),
        "members",
    )
    parts = at.groupBy("band", "key", "component").agg(F.count("*").alias("size"))
    split = (
        parts.groupBy("band", "key")
        .agg(F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("band", "key", F.col("most.component").alias("main"))
    )
    return at, stage(split, "split")


def one_per_group(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, equal rows once, columns as they are.

    Rows with null ids or without words stay. Columns may have any names and types. No rows give no rows.
    """
    gone = near_duplicates(docs, **settings).where("NOT kept").select("doc_id").distinct()
    left = carried(docs, "doc_id", "text").join(gone, "doc_id", "left_anti")
    # Maps cannot be compared; their rows are by what they are written as.
    key = F.sha2(F.to_json("_row"), 256) if "map<" in docs.schema.simpleString() else F.col("_row")
    once = left.withColumn("_key", key).dropDuplicates(["doc_id", "text", "_key"])
    return once.select(unpacked(docs.columns, "doc_id", "text"))
