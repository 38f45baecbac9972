"""Personal data by generated candidates and boosted trees, in DataFrame operations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, stage, unpacked

#: Kinds in order; the first four have base rules, the others come from the method alone.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn", "iban")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Generators: name, kind, pattern. The first four find what the base rules find: possessive loops
#: neither recurse nor retry, and a run of local-part characters is entered at its start or where
#: the match before ended, so a pass stays linear in the text.
GENERATORS = (
    ("email", "email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"),
    ("ip", "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("spelled_email", "email", rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}} ?[\[(]at[\])] ?{_HOST}{{1,63}}(?: ?[\[(]dot[\])] ?{_HOST}{{1,63}}){{1,4}}"),
    ("ip6", "ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("local_phone", "phone", r"(?<![0-9+A-Za-z.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
    ("secret", "secret", r"(?<![0-9A-Za-z_-])(?=[A-Za-z_-]*+[0-9])[0-9A-Za-z_-]{20,}+"),
    ("ssn", "ssn", r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
    ("iban", "iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
)
#: No generator finds anything in a text without one of these.
_ANY = r"[0-9@]|[\[(][aA][tT][\])]"
#: Words before a candidate that speak for each kind.
CUES = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|host|server|addr",
    "card": "card|visa|pay|credit",
    "phone": "tel|phone|call|fax|mobile|cell",
    "secret": "token|key|secret|passw|auth|bearer",
    "ssn": "ssn|social|security",
    "iban": "iban|account|bank",
}
#: Features of a candidate, small whole numbers all.
FEATURES = ("generator", "digits", "marks", "letters", "checksum", "left", "right", "cue", "size")
ROUNDS, RATE, LEAF_WEIGHT = 40, 0.3, 1.0
#: Precision on held-out candidates from which a score selects a span of the method's own.
PRECISION = 0.95

_LEFT = 24
_BLOCK = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums(values: Column) -> Column:
    return F.aggregate(
        values,
        F.array().cast("array<int>"),
        lambda done, x: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + x)),
    )


def running_sums(values: Column) -> Column:
    """Running sums of an array of lengths, in blocks so that long arrays are not copied whole."""
    blocks = F.transform(
        F.sequence(F.lit(0), ((F.size(values) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def joined(inner: Column) -> Column:
        totals = _sums(F.transform(inner, lambda x: F.element_at(x, -1)))
        return _let(
            totals,
            lambda t: F.flatten(
                F.transform(
                    inner,
                    lambda x, i: F.transform(x, lambda v: v + F.when(i > 0, F.get(t, i - 1)).otherwise(0)),
                )
            ),
        )

    return _let(F.transform(blocks, _sums), joined)


def found(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` in order: array of (start, end, match, left, right), code points.

    ``text`` must be free of U+0001 and U+0002, which mark the matches.
    """
    pieces = F.split(F.regexp_replace(text, pattern, "\u0001$0\u0002"), "\u0001", -1)

    def located(p: Column) -> Column:
        def one(ends: Column) -> Column:
            def span(piece: Column, i: Column) -> Column:
                match = F.substring_index(piece, "\u0002", 1)
                start = F.get(ends, i) - i
                return F.struct(
                    start.alias("start"),
                    (start + F.length(match)).alias("end"),
                    match.alias("match"),
                    F.right(F.substring_index(F.get(p, i), "\u0002", -1), F.lit(_LEFT)).alias("left"),
                    F.substr(piece, F.length(match) + 2, F.lit(1)).alias("right"),
                )

            return F.transform(F.slice(p, F.lit(2), F.size(p)), span)

        return _let(running_sums(F.transform(p, F.length)), one)

    return _let(pieces, located)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def weighed(d: Column, i: Column) -> Column:
        doubled = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).when(doubled > 9, doubled - 9).otherwise(doubled)

    each = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), weighed)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _side(char: Column) -> Column:
    """0: space or edge, 1: quote or sign, 2: letter or digit, 3: dot, hyphen or underscore between."""
    return (
        F.when((char == "") | char.rlike(r"^\s"), 0)
        .when(char.rlike(r"^[\p{L}\p{N}]"), 2)
        .when(char.rlike(r"^[._-]"), 3)
        .otherwise(1)
    )


def _candidate(generator: int):
    """The function that makes a match of a generator a candidate."""
    return lambda m: _described(generator, m)


def _described(generator: int, m: Column) -> Column:
    name, kind, _ = GENERATORS[generator]
    digits = F.regexp_replace(m["match"], "[^0-9]", "")
    n = F.length(digits)
    octets = F.forall(
        F.split(m["match"], r"\."), lambda x: F.length(F.ltrim(x, F.lit("0"))) <= 3
    ) & F.forall(
        F.split(m["match"], r"\."),
        lambda x: F.coalesce(F.right(F.concat(F.lit("00"), x), F.lit(3)).try_cast("int"), F.lit(999)) <= 255,
    )
    luhn = F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    clean = ~_side(F.right(m["left"], F.lit(1))).isin(2) & ~_side(m["right"]).isin(2)
    cue = F.lower(m["left"]).rlike(CUES[kind])
    checksum = {"ip": octets, "card": luhn}.get(name, F.lit(False))
    valid, base = {
        "email": (m["match"].rlike(r"\.[A-Za-z]{2,}$"), F.lit(True)),
        "ip": (octets & clean, octets),
        "card": (luhn & n.between(14, 19) & clean, luhn & n.between(14, 19)),
        "phone": (n.between(10, 15), n.between(10, 15)),
        "secret": (cue & (n >= 4), F.lit(False)),
        "ssn": (~m["match"].rlike("^(?:000|666|9)") & (clean | cue), F.lit(False)),
        "iban": ((n >= 8) & clean, F.lit(False)),
        "local_phone": (m["match"].rlike(r"^\(?[2-9]") & (cue | m["match"].rlike(r"^\(")), F.lit(False)),
    }.get(name, (clean, F.lit(False)))
    features = {
        "generator": F.lit(generator),
        "digits": F.least(n, F.lit(20)),
        "marks": F.least(F.length(F.regexp_replace(m["match"], "[A-Za-z0-9]", "")), F.lit(6)),
        "letters": F.least(F.length(F.regexp_replace(m["match"], "[^A-Za-z]", "")), F.lit(6)),
        "checksum": checksum.cast("int"),
        "left": _side(F.right(m["left"], F.lit(1))),
        "right": _side(m["right"]),
        "cue": cue.cast("int"),
        "size": F.least(((m["end"] - m["start"]) / 4).cast("int"), F.lit(12)),
    }
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        m["start"].alias("start"),
        m["end"].alias("end"),
        base.alias("base"),
        valid.cast("int").alias("valid"),
        *[features[f].cast("int").alias(f) for f in FEATURES],
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``candidates`` of all generators' spans; empty for null text.

    A candidate has its kind (place in KINDS), start, end, whether a base rule accepts it, whether
    its format is valid (the weak label the trees learn from), and FEATURES.
    """
    plain = F.translate(F.col("text"), "\u0001\u0002", "\u0003\u0003")

    def all_of(text: Column) -> Column:
        return F.concat(
            *[
                F.transform(found(text, pattern), _candidate(g))
                for g, (_, _, pattern) in enumerate(GENERATORS)
            ]
        )

    spans = _let(plain, all_of)
    return docs.withColumn("candidates", F.when(F.col("text").rlike(_ANY), spans))


# --- boosted trees -----------------------------------------------------------------------


def fit(rows: list[tuple], rounds: int = ROUNDS) -> list[tuple]:
    """Trees of depth two for rows (features..., count, positives); a tree is
    (feature, cut, (feature, cut, low, high) for the low side, the same for the high side).

    Logistic loss, Newton leaves. Rows are distinct feature vectors with counts, so their number
    is bounded by the feature grid whatever the size of the corpus.
    """
    width = len(FEATURES)
    margin = [0.0] * len(rows)
    trees = []

    def best(members: list[int], grad: list[float], hess: list[float]):
        g_all, h_all = sum(grad[i] for i in members), sum(hess[i] for i in members)
        top = (0.0, 0, 10**6)
        for f in range(width):
            bins: dict[int, list[float]] = {}
            for i in members:
                cell = bins.setdefault(rows[i][f], [0.0, 0.0])
                cell[0] += grad[i]
                cell[1] += hess[i]
            g = h = 0.0
            for value in sorted(bins)[:-1]:
                g, h = g + bins[value][0], h + bins[value][1]
                gain = (
                    g * g / (h + LEAF_WEIGHT)
                    + (g_all - g) ** 2 / (h_all - h + LEAF_WEIGHT)
                    - g_all * g_all / (h_all + LEAF_WEIGHT)
                )
                if gain > top[0] + 1e-12:
                    top = (gain, f, value)
        return top[1:]

    def leaf(members: list[int], grad: list[float], hess: list[float]) -> float:
        return RATE * sum(grad[i] for i in members) / (sum(hess[i] for i in members) + LEAF_WEIGHT)

    for _ in range(rounds if rows else 0):
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, m)))) for m in margin]
        grad = [r[width + 1] - r[width] * q for r, q in zip(rows, p)]
        hess = [r[width] * q * (1 - q) for r, q in zip(rows, p)]
        f, cut = best(list(range(len(rows))), grad, hess)
        sides = []
        for high in (False, True):
            members = [i for i, r in enumerate(rows) if (r[f] > cut) == high]
            f2, cut2 = best(members, grad, hess)
            values = []
            for high2 in (False, True):
                part = [i for i in members if (rows[i][f2] > cut2) == high2]
                values.append(round(leaf(part, grad, hess), 6))
                for i in part:
                    margin[i] += values[-1]
            sides.append((f2, cut2, *values))
        trees.append((f, cut, *sides))
    return trees


def margin_of(trees: list[tuple], row: tuple) -> float:
    total = 0.0
    for f, cut, low, high in trees:
        f2, cut2, a, b = high if row[f] > cut else low
        total += b if row[f2] > cut2 else a
    return total


def threshold(trees: list[tuple], rows: list[tuple], precision: float = PRECISION) -> dict[int, float]:
    """For each generator the least margin from which held-out candidates reach ``precision``.

    A generator without held-out candidates, or that never reaches it, selects nothing.
    """
    width = len(FEATURES)
    cuts: dict[int, float] = {}
    for g in range(len(GENERATORS)):
        own = sorted(((margin_of(trees, r), r) for r in rows if r[0] == g), reverse=True)
        n = positive = 0
        for k, (m, r) in enumerate(own):
            n, positive = n + r[width], positive + r[width + 1]
            if positive >= precision * n and (k + 1 == len(own) or own[k + 1][0] < m):
                cuts[g] = m
    return cuts


def _margin(c: Column, trees: list[tuple]) -> Column:
    def value(side) -> Column:
        f, cut, a, b = side
        return F.when(c[FEATURES[f]] > cut, F.lit(b)).otherwise(F.lit(a))

    parts = [
        F.when(c[FEATURES[f]] > cut, value(high)).otherwise(value(low)) for f, cut, low, high in trees
    ]
    return F.aggregate(F.array(F.lit(0.0), *parts), F.lit(0.0), lambda a, b: a + b)


def selected(found_in: DataFrame) -> DataFrame:
    """``found_in`` (doc_id, candidates, ...) with ``candidates`` replaced by ``spans``.

    Trees are fitted to the weak labels of four fifths of all documents' candidates and the
    thresholds to the last fifth; both go through counts of distinct feature vectors, which the
    driver gets (bounded by the feature grid, a few hundred rows in practice). Base spans stay as
    they are. A span of the method's own is taken if its margin reaches its generator's threshold
    and it overlaps no base span; of own spans that overlap, a sweep from the left keeps the
    better. spans: (start, kind, end, base), by start, then kind.
    """
    flat = found_in.select(
        (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("held"), F.explode("candidates").alias("c")
    )
    counts = (
        flat.groupBy("held", *[F.col(f"c.{f}") for f in FEATURES])
        .agg(F.count("*").alias("n"), F.sum("c.valid").alias("y"))
        .orderBy("held", *FEATURES)
        .collect()
    )
    trees = fit([tuple(r[1:]) for r in counts if not r.held])
    cuts = threshold(trees, [tuple(r[1:]) for r in counts if r.held])

    def own(c: Column) -> Column:
        cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair]) if cuts else None
        if cut is None:
            return F.lit(False)
        return ~c["base"] & F.coalesce(_margin(c, trees) >= F.try_element_at(cut, c["generator"]), F.lit(False))

    def clear(base: Column):
        return lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    def row(c: Column, score: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), score.alias("m"))

    def swept(spans: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,kind:int,m:double>>")

        def step(done: Column, c: Column) -> Column:
            last = F.try_element_at(done, F.lit(-1))
            return (
                F.when(last.isNull() | (last["end"] <= c["start"]), F.concat(done, F.array(c)))
                .when(c["m"] > last["m"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(c)))
                .otherwise(done)
            )

        return F.aggregate(F.array_sort(spans), empty, step)

    def out(c: Column, is_base: bool) -> Column:
        return F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), F.lit(is_base).alias("base")
        )

    def both(base: Column) -> Column:
        more = F.transform(
            F.filter(F.filter(F.col("candidates"), own), clear(base)), lambda c: row(c, _margin(c, trees))
        )
        return F.array_sort(
            F.concat(
                F.transform(base, lambda c: out(c, True)), F.transform(swept(more), lambda c: out(c, False))
            )
        )

    spans = _let(F.filter("candidates", lambda c: c["base"]), both)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean>>")
    return found_in.withColumn("spans", F.coalesce(spans, none)).drop("candidates")


def personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``spans`` appended; a column of that name is replaced.

    Null and empty text have no spans. Ids may be null or repeated: rows are judged one by one, the
    id only says to which part of the fit a row belongs. Empty input gives no rows.
    """
    rest = docs.drop("spans", "candidates")
    return selected(stage(candidates(rest), "candidates"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; spans that overlap become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    shape = "array<struct<start:int,end:int,kind:int>>"

    def step(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        new = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind")
        )
        return F.when(last.isNull() | (last["end"] <= s["start"]), F.concat(done, F.array(new))).otherwise(
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
        )

    def rebuilt(merged: Column) -> Column:
        before = F.transform(
            merged,
            lambda s, i: F.concat(
                F.substr(
                    text,
                    F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(0) + 1,
                    s["start"] - F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(0),
                ),
                F.get(names, s["kind"]),
            ),
        )
        return F.concat(F.array_join(before, ""), F.substr(text, F.element_at(merged, -1)["end"] + 1))

    merged = F.aggregate(spans, F.array().cast(shape), step)
    return F.when(F.size(spans) > 0, _let(merged, rebuilt)).otherwise(text)


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` redacted, and ``n_chars``, where it has one, counted anew."""
    read = ("doc_id", "text", "n_chars")
    changed = personal_data(carried(docs, *read)).withColumn("text", redacted(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        # A count that was missing stays missing.
        anew = (F.size("spans") > 0) & F.col("n_chars").isNotNull()
        changed = changed.withColumn(
            "n_chars", F.when(anew, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        )
    return changed.select(unpacked(docs.columns, *read))
