"""SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from turnstone.llm.quality import RULES, STOP_WORDS

_SPLIT = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _verdict() -> str:
    out = []
    for r in RULES:
        unit = r.per or "1"
        least = f"{unit} * {r.least}::DOUBLE"
        out += [f"{r.measure} >= {f'floor({least})' if r.whole else least}"] if r.least is not None else []
        out += [f"{r.measure} <= {unit} * {r.most}::DOUBLE"] if r.most is not None else []
    return " AND ".join(out)


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_SPLIT} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, ws[i:i+4] AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
r AS (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM r GROUP BY 1),
m AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_ellipsis_lines, len(list_filter(ls, lambda x: regexp_matches(x, '^\\s*[-*•]'))) AS n_bullet_lines,
  len(regexp_extract_all(t, '!')) AS n_exclaimed, length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS n_upper, length(t) - length(regexp_replace(t, '\\p{{L}}+', '', 'g')) AS n_letters,
  len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop_words
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {_verdict()} AS kept FROM m"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), f AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN strlen(h) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(h) >= 100 AND page_id <> first THEN first END AS refers_to FROM f"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {_SPLIT} AS ws FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+19], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k),
g AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM r WHERE n > 1) GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, p: NOT list_contains(gone, p)) END, ' ')) AS kept_sha256 FROM w LEFT JOIN g ON w.doc_id = g.doc_id"""

ORACLES = {"op3_quality_rules": QUALITY, "op8_warc": WARC, "op10_substring_dedup": SUBSTRINGS}
