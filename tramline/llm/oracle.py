"""DuckDB twins of the operators that SQL can express."""

from tramline.llm.url_rules import RULES

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)

OP6 = f"""
WITH cut AS (
  SELECT page_id, instr(coalesce(url, ''), '://') AS mark, coalesce(url, '') AS url FROM pages
), rest AS (
  SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM cut
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(r_host, r_path, r_verdict) AS (VALUES {_RULE_ROWS})
SELECT p.page_id, p.host, p.path,
       (SELECT arg_max(r_host || r_path, length(r_host || r_path)) FROM rules
        WHERE (p.host = r_host OR ends_with(p.host, '.' || r_host)) AND starts_with(p.path, r_path)) AS rule,
       coalesce((SELECT arg_max(r_verdict, length(r_host || r_path)) FROM rules
        WHERE (p.host = r_host OR ends_with(p.host, '.' || r_host)) AND starts_with(p.path, r_path)), 'allow') AS verdict
FROM parts p
"""

# The formatted length is that of the texts, one more for every lookalike of a mark, and
# the marks of the three roles (13, 13 and 7 characters; two with 15 for system).
OP4 = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text,
    '<\\*(?:s>|/s>|<SYS>>|</SYS>>)|\[\\*(?:INST\]|/INST\]|ROLE=|:\]|/ROLE\])'))
    + CASE role WHEN 'system' THEN length('<<SYS>><</SYS>>') WHEN 'user' THEN length('[INST][/INST]')
                ELSE length('<s></s>') END AS size
  FROM turns
), walked AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS all_text,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss_text,
         sum(size)::BIGINT AS formatted_chars,
         string_agg(left(role, 1), '' ORDER BY turn) AS path
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(loss_text) AS loss_chars,
       sha256(loss_text) AS loss_sha256, formatted_chars, regexp_full_match(path, 's?(ua)+') AS valid,
       CASE WHEN regexp_full_match(path, 's?(ua)+') THEN NULL
            ELSE length(regexp_extract(path, '^s?(ua)*u?'))::INTEGER END AS error_turn
FROM walked
"""

OP9 = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN windows v ON g.gram = v.gram AND g.n = v.n),
spots AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
          FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN spots USING (doc_id) LEFT JOIN found USING (doc_id)
"""
