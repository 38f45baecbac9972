"""SQL for the queries that SQL can express, over the same tables."""

from . import mixing, quality, spelling
from .minhash import PERCENT

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

OP2 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached(id, head) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT b, head FROM reached JOIN links ON a = id),
heads AS (SELECT id, min(head) AS head FROM reached GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, head AS component_id, vec_id = head AS kept
FROM embeddings JOIN heads ON id = vec_id LEFT JOIN counts ON a = vec_id
"""

OP4 = f"""
WITH RECURSIVE worded AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
    lambda i: array_to_string(w[i : i + 4], ' '))) AS s
  FROM worded WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y
  ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
reached(id, head) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT b, head FROM reached JOIN links ON a = id),
heads AS (SELECT id, min(head) AS head FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, head AS component_id, d.doc_id = head AS kept
FROM documents d JOIN heads ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_SOFT = f"""
  (100 * n_symbols > {quality.MAX_SYMBOLS} * n_words)::INT
  + (100 * n_dup_lines > {quality.MAX_DUP_LINES} * n_lines)::INT
  + (100 * n_repeat_words > {quality.SOFT_REPEAT} * n_words)::INT
  + (100 * word_chars < {quality.WORD_CHARS[0]} * n_words OR 100 * word_chars > {quality.WORD_CHARS[1]} * n_words)::INT
"""
OP6 = rf"""
WITH worded AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
parts AS (SELECT *, {_WORDS.format(text="text")} AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM worded),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) FROM again) GROUP BY doc_id),
metrics AS (
  SELECT p.doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM parts p LEFT JOIN covered c ON c.doc_id = p.doc_id),
judged AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT} * n_words AS base_failed,
    {_SOFT} AS soft FROM metrics),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft > 0) AS failed FROM judged GROUP BY source),
moments AS (
  SELECT sum(failed) / sum(n) AS mean, greatest(avg((failed / n) * (failed / n)) - avg(failed / n) * avg(failed / n)
    - (sum(failed) / sum(n)) * (1 - sum(failed) / sum(n)) * avg(1 / n), 0) AS spread FROM hosts),
prior AS (SELECT mean, greatest(mean * (1 - mean) / nullif(spread, 0) - 1, 1) AS strength FROM moments),
rates AS (
  SELECT source, coalesce((failed + mean * strength) / (n + strength), mean) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND soft < CASE WHEN rate >= {quality.HOST_RATE} THEN 1 ELSE 2 END AS kept
FROM judged j JOIN rates r ON r.source IS NOT DISTINCT FROM j.source
"""


def _rates(rounds: int) -> str:
    """Rates after so many rounds; each caps the sources that exceed and shares what is left."""
    most = mixing.MOST
    out = ["r0 AS (SELECT total / sum(weight) AS rate FROM sources, mix GROUP BY total)"]
    for k in range(rounds):
        full = f"rate * weight >= {most} * source_size"
        out.append(
            f"r{k + 1} AS (SELECT coalesce((total - coalesce(sum({most} * source_size) FILTER ({full}), 0)) "
            f"/ sum(weight) FILTER (NOT ({full})), rate) AS rate FROM sources, mix, r{k} GROUP BY total, rate)"
        )
    return ",\n".join(out)


OP10 = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len({_WORDS.format(text="text")}), 0) AS size, md5(doc_id::VARCHAR) AS o FROM documents),
dealt AS (SELECT *, ('0x' || substr(o, 1, 4))::INT % {mixing.PIECES} AS piece FROM sized),
sources AS (
  SELECT source, sum(size) AS source_size,
    [{", ".join(f"{w}.0::DOUBLE" for w in mixing.WEIGHTS)}][
      1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {len(mixing.WEIGHTS)}] AS weight
  FROM dealt GROUP BY source),
mix AS (SELECT sum(source_size) * {mixing.SHARE} / 100 AS total FROM sources),
{_rates(8)},
targets AS (
  SELECT source, source_size, least(rate * weight, ({mixing.MOST} * source_size)::DOUBLE) AS target FROM sources, r8),
placed AS (
  SELECT d.*, source_size, target, sum(size) OVER (
    PARTITION BY d.source ORDER BY piece, o, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM dealt d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  ((coalesce(floor(target / nullif(source_size, 0)), 0)
    + (before < target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size)::INT) * size)::BIGINT AS taken
FROM placed
"""

OP12 = rf"""
WITH RECURSIVE crcs(i, v, k) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM crcs WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM crcs WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.LETTERS} GROUP BY ALL),
coded AS (
  SELECT *, list_prepend(4294967295, flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
      ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END))) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(b::BIGINT[], lambda h, c: xor(h // 256, t[1 + (xor(h, c) & 255)])), 4294967295) AS h
  FROM coded, crc),
read AS (
  SELECT CASE WHEN h % {spelling.MISSPELT} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM read WHERE length(word) >= {spelling.LETTERS}
  GROUP BY word HAVING sum(n) >= {spelling.OCCURRENCES}),
cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
gains AS (SELECT DISTINCT c.word, w.word AS near FROM cuts c JOIN words w ON c.rest = w.word),
near AS (
  SELECT x.word, y.word AS near FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION ALL FROM gains UNION ALL SELECT near, word FROM gains),
ranked AS (
  SELECT r.word, near, w.n AS near_n, count(*) OVER (PARTITION BY r.word) AS n_near,
    row_number() OVER (PARTITION BY r.word ORDER BY w.n DESC, near) AS k
  FROM near r JOIN words w ON w.word = near),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.RATIO} * n THEN near END AS form,
    CASE WHEN near_n >= {spelling.RATIO} * n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1),
steps(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT s.word, form FROM steps s JOIN formed f ON f.word = s.root WHERE form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps s ON s.word = f.word JOIN formed e ON e.word = s.root AND e.form IS NULL
"""

ORACLE = {"op2_vectors": OP2, "op4_minhash": OP4, "op6_quality": OP6, "op10_mixing": OP10, "op12_spelling": OP12}
