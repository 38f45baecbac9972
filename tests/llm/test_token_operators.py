"""Alignment, spelling variants and byte pairs against brute force and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sojourn.llm import alignment, bytepair, queries, spelling
from sojourn.llm.common import table

from .conftest import SCHEMA, odd_rows

#: White space of all kinds, cut-off marks, signs of several bytes and ones that are not assigned.
HARD = [
    "",
    " ",
    "\n\n  \n",
    "a  b\n c",
    "x<|endoftext|> y \n<|endoftext|>",
    "<s>tok</s><unk><0x0A>",
    "it's they'LL 're",
    "日本語テキスト🎉👨‍👩‍👧 é",
    "　\x1c\x1d x\x85y\xa0\xa0z ",
    "a▁b ▁ c",
    "x;\r\ny;\r z \r;\r",
    "a" * 3000 + " " + "9" * 500 + " " * 300,
    "՘x ab࢏c",
    "\x00\x01 \x7f",
]


def random_texts(n, longest):
    rng = random.Random(5)
    signs = " \n\t\r ab'stréE19.,<|>endoftext日՘🎉　▁\x85"
    return ["".join(rng.choices(signs, k=rng.randint(0, longest))) for _ in range(n)]


def digest(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# --- byte pairs --------------------------------------------------------------------------


@pytest.mark.parametrize("marks", [True, False])
def test_encoder_gives_the_ids_of_the_library(marks):
    library = Tokenizer.from_file(bytepair.default_path())
    library.encode_special_tokens = not marks
    texts = HARD + random_texts(3000, 60)
    for text, got in zip(texts, bytepair.Encoder(bytepair.default_path(), marks).of(texts)):
        assert np.frombuffer(got, dtype="<i4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_words_of_every_sign_are_cut_as_the_library_does():
    library = Tokenizer.from_file(bytepair.default_path()).pre_tokenizer
    own = bytepair.encoder(bytepair.default_path())
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(signs), 997):
        text = "".join(f"a{c}b1{c}2 {c}\n" for c in signs[at : at + 97])
        want = list(dict.fromkeys(span for _, span in library.pre_tokenize_str(text)))
        assert own._words(text) == [text[a:b] for a, b in want]


def test_long_words_merge_as_short_ones(monkeypatch):
    merger = bytepair.Merger(bytepair.encoder(bytepair.default_path()).vocabulary)
    rng = random.Random(1)
    words = ["".join(rng.choices("abeinst", k=rng.randint(1, 48))).encode() for _ in range(2000)] + [b"a" * 40, b""]
    assert merger.of(words) == [merger.long(w) for w in words]


def test_a_long_word_takes_near_linear_time():
    merger = bytepair.Merger(bytepair.encoder(bytepair.default_path()).vocabulary)
    assert len(merger.long(b"ab" * 100_000)) == len(merger.long(b"ab" * 50_000)) * 2


def test_bytepair_query_is_what_the_library_gives(spark, given):
    library = Tokenizer.from_file(bytepair.default_path())
    got = {r.doc_id: r for r in queries.QUERIES["op13_bytepair"](spark, given).collect()}
    docs = table(spark, given, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(ids))
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_decoding_what_no_text_gives(spark):
    library = Tokenizer.from_file(bytepair.default_path())
    lists = [[159, 220, 64, 65], [50256, 10, 11], [], [108, 236]]
    rows = spark.createDataFrame([*enumerate(lists), (9, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bytepair.decoded(rows).collect()}
    assert got == {**{i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)}, 9: ""}


def test_bytepair_odd_rows(odd, none):
    rows = bytepair.encoded(odd)
    assert rows.columns == ["doc_id", "ids"]
    got = bytepair.decoded(rows).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1] or "") for r in odd_rows())
    assert bytepair.decoded(bytepair.encoded(none)).collect() == []


# --- spelling variants -------------------------------------------------------------------


def words_by_hand(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in spelling.RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_hand(words):
    return {w: sorted((v for v in words if one_apart(w, v)), key=lambda v: (-words[v], v)) for w in words}


def variants_by_hand(words):
    near = near_by_hand(words)
    form = {w: v[0] if v and words[v[0]] >= 10 * words[w] else None for w, v in near.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def test_variants_match_brute_force(spark, given):
    docs = [(r.doc_id, r.text) for r in table(spark, given, "documents").collect()]
    got = {tuple(r) for r in queries.QUERIES["op12_spelling"](spark, given).collect()}
    assert got == variants_by_hand(words_by_hand(docs))
    assert any(r[1] for r in got)


def crowded_words():
    """Dense words of few letters, with repeated letters and every length from 7 on; chains of forms."""
    rng = random.Random(2)
    words = {"".join(rng.choices("abé", k=rng.randint(7, 9))): rng.randint(2, 9) for _ in range(700)}
    words |= {"aaaaaaa": 3, "a" * 8: 40, "a" * 9: 500, "a" * 10: 500, "abababa": 2, "babababa": 20}
    return words | {"b" * 30: 7, "b" * 31: 70, "b" * 32: 700, "bbbbbbbc" * 4: 8}


@pytest.mark.parametrize("crowd", [10_000, 40, 1])
def test_crowds_are_dealt_again_without_loss(spark, crowd):
    words = crowded_words()
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best) for r in spelling.near_words(rows, crowd=crowd).collect()}
    assert got == {w: (len(v), v[0]) for w, v in near_by_hand(words).items() if v}


def test_groups_are_bounded(spark):
    rows = spark.createDataFrame(list(crowded_words().items()), "word string, n long")
    parts = spelling.dealt(rows, crowd=10)
    assert len(parts) > 1
    for part in parts:
        sizes = part.groupBy("length", "lo", "hi", "rest").count().where("count > 10 AND hi - lo > 1")
        assert sizes.isEmpty()


def test_roots_follow_forms_to_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4"), ("y", "w9")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w9" for i in range(9)}, "x": "w9", "y": "w9"}


def test_variants_odd_rows(spark, odd, none):
    got = {tuple(r) for r in spelling.variants(odd).collect()}
    assert got == variants_by_hand(words_by_hand([r[:2] for r in odd_rows()]))
    assert spelling.variants(none).collect() == []


# --- alignment ---------------------------------------------------------------------------


class Plain:
    """Groups and links of a whole text from the libraries' ids and the tokens' bytes alone."""

    def __init__(self):
        a_path, b_path = alignment.default_paths()
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        self.code = {c: b for b, c in enumerate(bytepair.byte_letters())}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def of(self, text):
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes = [bytes(self.code[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [self.b_bytes(i) for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        a_ends, b_ends = (np.cumsum([len(x) for x in t]).tolist() for t in (a_bytes, b_bytes))
        ends = sorted(set(a_ends) & set(b_ends))
        a_at, b_at = ({e: i + 1 for i, e in enumerate(own)} for own in (a_ends, b_ends))
        groups = [
            ",".join(map(str, a[a_at.get(lo, 0) : a_at[hi]])) + "|" + ",".join(map(str, b[b_at.get(lo, 0) : b_at[hi]]))
            for lo, hi in zip([0, *ends], ends)
        ]
        links = [(a[a_at[e] - 1], b[b_at[e] - 1]) for e in ends]
        return ";".join(groups), links, len(a), len(b)


def test_pieces_align_as_whole_texts_do():
    plain, aligner = Plain(), alignment.Aligner(*alignment.default_paths())
    texts = [None, *HARD, *random_texts(1500, 40)]
    with_tokens = 0
    for text, got in zip(texts, aligner.of(texts)):
        want = plain.of(text)
        if want is None:
            assert got is None, text
            continue
        with_tokens += 1
        links = sorted((x >> 32, x & 0xFFFFFFFF) for x in np.frombuffer(got[1], dtype=np.int64).tolist())
        assert (got[0], links, *got[2:]) == (want[0], sorted(want[1]), *want[2:]), text
    assert with_tokens > 300


def rows_by_hand(docs):
    plain = Plain()
    found = [plain.of(text) for _, text in docs]
    counts = Counter(link for x in found if x for link in x[1])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (doc_id, _), x in zip(docs, found):
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links, n_a, n_b = x
        n_best = sum(counts[k] == best[k[1]] for k in links)
        total = sum(counts[k] for k in links)
        sha = hashlib.sha256(groups.encode()).hexdigest()
        out.append((doc_id, n_a, n_b, groups.count(";") + 1, len(links), n_best, total, sha))
    return Counter(out)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query_matches_brute_force(spark, given):
    docs = [(r.doc_id, r.text) for r in table(spark, given, "documents").collect()]
    got = queries.QUERIES["op11_alignment"](spark, given)
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == rows_by_hand(docs)


def test_alignment_odd_rows(spark, odd, none):
    got = alignment.alignments(odd)
    assert sorted(got.columns) == sorted(COLUMNS)
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == rows_by_hand([r[:2] for r in odd_rows()])
    assert alignment.alignments(none).collect() == []
    assert alignment.aligned(none.select(*SCHEMA.names)).collect() == []


def test_spans_of_many_pieces_are_those_of_each():
    """Characters become bytes, and bytes are compared, for all pieces of a batch at once."""
    a = alignment.ByteLevel(alignment.default_paths()[0])
    texts = [t for t in [*HARD, *random_texts(60, 9)] if t]
    many = a.spans(texts)
    assert many.ends.tolist() == [e for t in texts for e in a.spans([t]).ends.tolist()]
    data = [t.encode() for t in texts]
    wrong = [d if i % 3 else bytes(len(d)) for i, d in enumerate(data)]
    assert alignment.same_bytes(data, many, a.token_bytes).all()
    assert alignment.same_bytes(wrong, many, a.token_bytes).tolist() == [w == d for w, d in zip(wrong, data)]
    assert alignment.flat([[(0, 1), (1, 3)], [], [(0, 2)]]).tolist() == [[0, 1], [1, 3], [0, 2]]
