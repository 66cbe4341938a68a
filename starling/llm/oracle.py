"""DuckDB SQL for the queries that SQL expresses, over the registered views."""

from __future__ import annotations

from starling.llm import quality

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Targets in closed form: sources sorted by cap / weight; the capped ones are a
# prefix, the first prefix whose next source stays below its cap.
OP1 = f"""
WITH sized AS (
  SELECT doc_id, source, {_WORDS} AS size, md5(coalesce(text, '')) AS content,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17') AS h
  FROM documents
), total AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos
  FROM sized GROUP BY source
), weighted AS (
  SELECT source, n, 2 * n AS cap, CASE pos % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, pos FROM total
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap * 1.0 / w, pos) AS r FROM weighted
), prefixes AS (
  SELECT a.r, coalesce((SELECT sum(b.cap) FROM ranked b WHERE b.r < a.r), 0) AS capped,
         (SELECT sum(b.w) FROM ranked b WHERE b.r >= a.r) AS free,
         (SELECT 1.5 * sum(n) FROM weighted) AS budget, a.cap, a.w
  FROM ranked a
), level AS (
  SELECT min(r) AS r FROM prefixes
  WHERE (CAST(budget AS DOUBLE) - CAST(capped AS DOUBLE)) * w / CAST(free AS DOUBLE) <= cap
), target AS (
  SELECT k.source, k.n, CASE WHEN k.r < coalesce(l.r, 1000000000) THEN CAST(k.cap AS DOUBLE)
           ELSE (CAST(p.budget AS DOUBLE) - CAST(p.capped AS DOUBLE)) * k.w / CAST(p.free AS DOUBLE) END AS target
  FROM ranked k CROSS JOIN level l LEFT JOIN prefixes p ON p.r = l.r
), planned AS (
  SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS whole FROM target
), placed AS (
  SELECT s.*, p.n, p.target, p.whole, CAST(floor(p.target - p.whole * p.n) AS BIGINT) AS need,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size, s.content
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target,
       CAST(whole * size + greatest(0, least(size, need - earlier)) AS BIGINT) AS taken
FROM placed
"""

OP2 = f"""
WITH d AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT DISTINCT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

_CLASSES = {k: p.replace("'", "''") for k, p in quality.CLASSES.items()}
_VOCABULARY = "[" + ", ".join(f"'{w}'" for w in quality.VOCABULARY) + "]"
_L = quality.LIMITS


def _entropy(shares: str) -> str:
    return f"-list_sum(list_transform({shares}, lambda x: CASE WHEN x > 0 THEN x * log2(x) ELSE 0.0 END))"


def _distance(cells: str, reference: str) -> str:
    """Jensen-Shannon distance of two count lists; NULL when one is empty."""
    p = f"list_transform({cells}, lambda x: x / nullif(list_sum({cells}), 0))"
    q = f"list_transform({reference}, lambda x: x / nullif(list_sum({reference}), 0))"
    middle = f"list_transform(list_zip({p}, {q}), lambda x: (x[1] + x[2]) / 2)"
    return (f"CASE WHEN list_sum({cells}) > 0 AND list_sum({reference}) > 0 THEN "
            f"sqrt(greatest({_entropy(middle)} - ({_entropy(p)} + {_entropy(q)}) / 2, 0.0)) END")


# Rows are numbered so that repeated ids stay apart; histograms are lists of counts.
OP3 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT r, i, list_slice(w, i, i + 4) AS five FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM windows) CROSS JOIN range(5) AS x(k)
  WHERE c > 1 GROUP BY r
), common AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, lower(unnest(w)) AS word FROM d)
  WHERE word IN (SELECT unnest({_VOCABULARY})) GROUP BY r, word
), commons AS (
  SELECT r, map_from_entries(list((word, n))) AS counts, sum(n) AS total FROM common GROUP BY r
), measured AS (
  SELECT d.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '{_CLASSES["symbol"]}')) AS BIGINT) AS n_symbols,
         (SELECT count(*) - count(DISTINCT x) FROM (SELECT unnest(string_split(d.t, chr(10))) AS x)
          WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         [{", ".join(f"len(regexp_extract_all(t, '{p}'))" for p in _CLASSES.values())}] AS counted,
         strlen(t) - length(t) AS wide,
         list_append(list_transform({_VOCABULARY}, lambda x: CAST(coalesce(commons.counts[x], 0) AS BIGINT)),
                     CAST(len(w) - coalesce(commons.total, 0) AS BIGINT)) AS words
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN commons USING (r)
), cells AS (
  SELECT *, n_words < {_L.min_words} OR 100 * n_repeat_words > {_L.max_repeat_percent} * n_words AS base_failed,
         list_concat(counted, [least(wide, word_chars), greatest(word_chars - wide - list_sum(counted), 0)]) AS chars
  FROM measured
), prose AS (
  SELECT lang, chars, words FROM cells
  WHERE n_words >= {_L.min_words} AND n_symbols <= {_L.max_reference_symbols} * word_chars
), ref AS (
  SELECT lang, [{", ".join(f"sum(chars[{i + 1}])" for i in range(len(_CLASSES) + 2))}] AS ref_chars,
         [{", ".join(f"sum(words[{i + 1}])" for i in range(len(quality.VOCABULARY) + 1))}] AS ref_words
  FROM prose GROUP BY lang
), far AS (
  SELECT cells.*, {_distance("chars", "ref_chars")} AS dc, {_distance("words", "ref_words")} AS dw
  FROM cells LEFT JOIN ref ON cells.lang IS NOT DISTINCT FROM ref.lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         coalesce(word_chars >= {_L.min_chars_judged}
                  AND dc > {_L.max_char_distance} + {_L.char_noise} / sqrt(greatest(word_chars, 1)), false)
         OR coalesce(n_words >= {_L.min_words_judged} AND (
                       dc > {_L.max_char_distance} AND dw > {_L.max_word_distance}
                       OR dw > {_L.lone_word_distance} + {_L.word_noise} / sqrt(greatest(n_words, 1))), false)) AS kept
FROM far
"""


# Every contiguous phrase of one to four words of every piece, counted as text.
OP11 = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), started AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w
), f AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM started CROSS JOIN range(1, 5) AS x(k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 30
), cut AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1
), scored AS (
  SELECT cut.lang, cut.phrase, cut.f AS a, c, x.f AS l, y.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * cut.f // (x.f + y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(w, 1, c), ' ')
           JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(w, c + 1, cut.k), ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored
), inner_phrases AS (
  SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(f) AS longest
  FROM (SELECT DISTINCT lang, k, w, f FROM cut) CROSS JOIN range(2, 4) AS x(m) CROSS JOIN range(1, 4) AS y(i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), ranked AS (
  SELECT s.lang, s.phrase, a, l, r, score,
         row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE o = 1 AND (longest IS NULL OR CAST(100 AS HUGEINT) * longest < CAST(80 AS HUGEINT) * a)
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""

# Terms straight from the texts; every pair of sources over every kept term.
OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWERED} AS t FROM documents
), o AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x{{00}}-\x{{40}}\x{{5B}}-\x{{60}}\x{{7B}}-\x{{7F}}]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), v AS (
  SELECT lang, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v FROM (SELECT DISTINCT lang FROM d) g
), c AS (
  SELECT o.lang, o.source, o.term, count(*) AS c FROM o JOIN kept ON kept.lang = o.lang AND kept.term = o.term GROUP BY ALL
), n AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL
), p AS (
  SELECT n.lang, n.source, kept.term, coalesce(c.c, 0) AS c,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5) // (n.n + 5 * v.v) AS BIGINT) AS p
  FROM n JOIN kept ON kept.lang = n.lang JOIN v ON v.lang = n.lang
  LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = kept.term
), q AS (
  SELECT x.lang, x.term, CAST(1 + CAST(1000000000 AS HUGEINT) * (x.c + 5) // (y.n + 5 * v.v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM p GROUP BY ALL) x
  JOIN (SELECT lang, sum(n) AS n FROM n GROUP BY ALL) y ON y.lang = x.lang JOIN v ON v.lang = x.lang
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((
    SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM n a JOIN n b ON a.lang = b.lang AND a.source <> b.source
), term AS (
  SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p.p > q.q
), listed AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pair
  UNION ALL SELECT lang, source, 'term', item, value FROM term
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM listed
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {"op1_mix_sources": OP1, "op2_exact_dedup": OP2, "op3_quality_rules": OP3,
                          "op11_collocations": OP11, "op12_source_audit": OP12}
