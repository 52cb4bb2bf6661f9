"""SQL (DuckDB) for the queries that SQL can express.

The others have none: seeded shuffles and rounding (op3, op7), a tokenizer (op4), a trained machine (op5), decoding with
places (op6), XXH64 (op10) and eigenvectors (op13). Their tests compare them with brute force or the library.
"""

from __future__ import annotations

from collections.abc import Iterable

from foliospark.llm import licenses, repetition, url_rules
from foliospark.llm.common import LOWER, UPPER


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values: Iterable[str]) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def license_scan() -> str:
    templates = licenses.Templates.of(licenses.TEMPLATES, licenses.THRESHOLD)
    rows = ",\n".join(
        f"({n}, {quoted(label)}, {listed(sorted(word.decode() for word in words))}, {least}, {quoted(b' '.join(own).decode())})"
        for n, (label, words, least, own) in enumerate(
            zip(templates.labels, templates.words, templates.least, templates.lists)
        )
    )
    phrases = ", ".join(
        f"({quoted(label)}, {listed(phrase.split())})" for phrase, label in licenses.PHRASES.items()
    )
    stride = templates.stride
    return rf"""
WITH template(n, label, words, least, line) AS (VALUES {rows}),
phrase(label, words) AS (VALUES {phrases}),
text AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
place AS (
  SELECT id, pos - 1 AS pos, phrase.label
  FROM (SELECT id, words, unnest(range(1, len(words) + 1)) AS pos FROM text) t JOIN phrase
    ON t.words[pos : pos + len(phrase.words) - 1] = phrase.words),
block AS (
  SELECT id, words[b * {stride} + 1 : b * {stride} + {2 * stride}] AS seq, list_distinct(seq) AS words
  FROM (SELECT id, words, unnest(range(0, (len(words) + {stride - 1}) // {stride})) AS b FROM text)),
meets AS (
  SELECT id, label, len(list_intersect(block.words, template.words)) / len(template.words) AS share,
         seq, line, template.words AS sought, least, len(string_split(line, ' ')) AS size
  FROM block JOIN template ON len(list_intersect(block.words, template.words)) >= least),
met AS (
  SELECT id, label, share FROM meets
  WHERE (label <> 'cc-by' OR NOT list_contains(sought, 'attribution') OR len(list_filter(
           range(1, len(seq) + 1),
           lambda i: seq[i] = 'attribution' AND NOT list_contains({listed(licenses.VARIANTS)}, coalesce(seq[i + 1], '')))) > 0)
    AND CASE WHEN size <= 6 THEN
          contains(' ' || array_to_string(list_filter(seq, lambda w: NOT list_contains({listed(licenses.FILLERS)}, w)), ' ') || ' ',
                   ' ' || line || ' ')
        ELSE len(list_filter(range(1, len(seq) + 1),
                 lambda i: len(list_intersect(list_distinct(seq[i : i + 2 * size - 1]), sought)) >= least)) > 0 END),
placed AS (
  SELECT id, count(*) AS n, min(pos) AS first, max(pos) AS last,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY id),
shared AS (SELECT id, count(*) AS n, max(share) AS share FROM met GROUP BY id),
labelled AS (
  SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT id, label FROM place UNION SELECT id, label FROM met) GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(placed.n, 0)::BIGINT AS n_base,
       placed.first::BIGINT AS first_word, placed.last::BIGINT AS last_word,
       coalesce(placed.labels, '') AS base_labels, coalesce(labelled.labels, '') AS labels,
       CASE WHEN placed.n > 0 THEN 1.0::DOUBLE ELSE coalesce(shared.share, 0)::DOUBLE END AS score,
       coalesce(shared.n, 0)::BIGINT AS n_blocks
FROM text LEFT JOIN placed USING (id) LEFT JOIN shared USING (id) LEFT JOIN labelled USING (id)
"""


def quality_rules() -> str:
    limits = repetition.Limits()

    def repeated(words: int) -> str:
        return f"""
  SELECT id, pos FROM (
    SELECT id, pos, count(*) OVER (PARTITION BY id, run) AS n FROM (
      SELECT id, pos, array_to_string(words[pos : pos + {words - 1}], ' ') AS run
      FROM (SELECT id, words, unnest(range(1, len(words) - {words - 2})) AS pos FROM text)))
  WHERE n > 1"""

    def covered(words: int) -> str:
        return f"""
  SELECT id, count(DISTINCT word) AS n
  FROM (SELECT id, unnest(range(pos, pos + {words})) AS word FROM ({repeated(words)})) GROUP BY id"""

    return rf"""
WITH text AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
line AS (
  SELECT id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM text)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id),
windows AS ({covered(repetition.WINDOW)}),
repeats AS ({covered(limits.repeat_words)}),
long AS (SELECT DISTINCT id FROM ({repeated(limits.longest_words + 1)})),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(line.n, 0)::BIGINT AS n_dup_lines, coalesce(windows.n, 0)::BIGINT AS n_repeat_words,
         coalesce(repeats.n, 0)::BIGINT AS n_maximal_words, long.id IS NOT NULL AS long_repeat
  FROM text LEFT JOIN line USING (id) LEFT JOIN windows USING (id) LEFT JOIN repeats USING (id)
       LEFT JOIN long USING (id)),
failed AS (
  SELECT *, n_words < {limits.least_words} OR 100 * n_repeat_words > {limits.repeat_pct} * n_words AS base_failed
  FROM measured)
SELECT *, NOT base_failed AND 100 * n_maximal_words <= {limits.maximal_pct} * n_words AND NOT long_repeat AS kept
FROM failed
"""


def url_filter() -> str:
    patterns = ", ".join(
        f"({quoted(p.text)}, {quoted(p.regex)})" for p in map(url_rules.Pattern.of, url_rules.PATTERNS)
    )
    rules = ", ".join(
        f"({quoted(host)}, {quoted(path)}, {quoted(verdict)})" for host, path, verdict in url_rules.HOST_RULES
    )
    return rf"""
WITH pattern(name, regex) AS (VALUES {patterns}),
rule(name, start, verdict) AS (VALUES {rules}),
page AS (
  SELECT row_number() OVER () AS id, page_id, url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fit AS (
  SELECT id, arg_max(rule.name || start, length(rule.name || start)) AS rule,
         arg_max(verdict, length(rule.name || start)) AS verdict
  FROM page JOIN rule
    ON (host = rule.name OR ends_with(host, '.' || rule.name)) AND starts_with(path, start)
  GROUP BY id),
hit AS (
  SELECT id, min(name) AS pattern
  FROM page JOIN pattern ON regexp_matches(translate(url, '{UPPER}', '{LOWER}'), regex) GROUP BY id)
SELECT page_id, host, path, rule, pattern,
       coalesce(verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM page LEFT JOIN fit USING (id) LEFT JOIN hit USING (id)
"""


def exact_dedup() -> str:
    return r"""
WITH text AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER ranked AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER ranked = 1 AS kept, sha256(content) AS text_sha256
FROM text WINDOW ranked AS (PARTITION BY content ORDER BY chars DESC, doc_id NULLS LAST)
"""


def phrases() -> str:
    return rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
gram AS (
  SELECT lang, words, unnest([array_to_string(w[i:i + words - 1], ' ') FOR i IN range(1, len(w) - words + 2)]) AS phrase
  FROM piece, range(1, 5) size(words) WHERE len(w) >= words),
f AS (SELECT lang, words, phrase, count(*) AS a FROM gram GROUP BY lang, words, phrase HAVING count(*) >= 30),
cut AS (
  SELECT lang, words, phrase, a, k, string_split(phrase, ' ') AS w
  FROM (SELECT *, unnest(range(1, words)) AS k FROM f WHERE words > 1)),
scored AS (
  SELECT cut.lang, cut.words, cut.phrase, cut.a, k, one.a AS l, two.a AS r,
         ((2000000::HUGEINT * cut.a) // (one.a + two.a))::BIGINT AS score
  FROM cut JOIN f one ON one.lang = cut.lang AND one.phrase = array_to_string(w[:k], ' ')
           JOIN f two ON two.lang = cut.lang AND two.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_part AS (
  SELECT DISTINCT lang, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, words - size + 2)]) AS phrase, a AS longer
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(2, words)) AS size FROM f WHERE words > 2)),
kept AS (
  SELECT * FROM lowest WHERE NOT EXISTS (
    SELECT 1 FROM inner_part p WHERE p.lang = lowest.lang AND p.phrase = lowest.phrase
      AND 100::HUGEINT * p.longer >= 80::HUGEINT * lowest.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""


def decontamination() -> str:
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH item AS (SELECT item_id, {words} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS line
  FROM item WHERE len(w) > 0),
doc AS (SELECT row_number() OVER () AS id, doc_id, {words} AS w FROM documents),
place AS (
  SELECT id, size, unnest(range(1, len(w) - size + 2)) AS pos, w
  FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
met AS (
  SELECT id, p.size, pos, item_id
  FROM (SELECT id, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS line FROM place) p
  JOIN win ON win.size = p.size AND win.line = p.line),
hit AS (
  SELECT id, count(DISTINCT word) AS n_hit FROM (SELECT id, unnest(range(pos, pos + size)) AS word FROM met) GROUP BY id),
found AS (
  SELECT id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM met GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (id) LEFT JOIN found USING (id)
"""


ORACLE = {
    "op1_license_scan": license_scan(),
    "op2_quality_rules": quality_rules(),
    "op8_url_filter": url_filter(),
    "op9_exact_dedup": exact_dedup(),
    "op11_phrases": phrases(),
    "op12_decontamination": decontamination(),
}
