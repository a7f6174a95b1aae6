"""SQL twins of the queries of this folder, where SQL can state them."""

from __future__ import annotations

OP7 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)
), windows AS (
  SELECT r, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, w, w2, w3) > 1 AS hit FROM windows
), covered AS (
  SELECT r, max(hit::int) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM again
), repeats AS (SELECT r, sum(c) AS n_repeat_words FROM covered GROUP BY r
), totals AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), counts AS (
  SELECT doc_id, host, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN totals USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words AS f_symbols, n_dup_lines > 0 AS f_lines FROM counts
), hosts AS (
  SELECT host, count(*) AS n, unnest(['base', 'symbols', 'lines']) AS rule,
    unnest([sum(base_failed::int), sum(f_symbols::int), sum(f_lines::int)]) AS k
  FROM judged GROUP BY host
), means AS (
  SELECT rule, sum(n) AS total, count(*) AS hosts, sum(k)::DOUBLE / sum(n) AS mean FROM hosts GROUP BY rule
), spreads AS (
  SELECT rule, any_value(total) AS total, any_value(hosts) AS hosts, any_value(mean) AS mean,
    sum(n * pow(k::DOUBLE / n - mean, 2)) / any_value(total) AS spread
  FROM hosts JOIN means USING (rule) GROUP BY rule
), moments AS (
  SELECT rule, least(greatest(mean, 1e-6), 1 - 1e-6) AS mean, spread, hosts, total FROM spreads
), priors AS (
  SELECT rule, mean, CASE WHEN between_hosts > 0
    THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1), 1e4) ELSE 1e4 END AS strength
  FROM (SELECT *, greatest(spread - mean * (1 - mean) * hosts / total, 0) AS between_hosts FROM moments)
), verdicts AS (
  SELECT host, bool_or((k + mean * strength) / (n + strength) > CASE rule WHEN 'lines' THEN 0.9 ELSE 0.5 END) AS rejected
  FROM hosts JOIN priors USING (rule) GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept, j.host, rejected AS host_rejected
FROM judged j JOIN verdicts v ON j.host IS NOT DISTINCT FROM v.host
"""


def mixing_sql(sweeps: int = 8, share: float = 0.8, seed: int = 7) -> str:
    """Raking with one query block per step."""
    powers = {"source": 0.7, "lang": 0.8, "topic": 0.5}
    blocks = [
        r"""docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
)""",
        """rows AS (
  SELECT doc_id, source, lang, len(words) AS tokens, CASE WHEN len(words) = 0 THEN 'none' ELSE
    't' || ((strpos('0123456789abcdef', substr(list_min(list_transform(words, lambda w: md5(w))), 32, 1)) - 1) % 4)
    END AS topic FROM docs
)""",
        """step0 AS (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS weight FROM rows GROUP BY ALL
)""",
    ]
    for d, power in powers.items():
        blocks.append(f"""goal_{d} AS (
  SELECT {d}, mass / sum(mass) OVER () * (SELECT sum(tokens) FROM step0) AS goal
  FROM (SELECT {d}, pow(sum(tokens), {power}) AS mass FROM step0 GROUP BY {d}) WHERE mass > 0
)""")
    number = 0
    for _ in range(sweeps):
        for d in powers:
            blocks.append(f"""step{number + 1} AS MATERIALIZED (
  SELECT s.source, s.lang, s.topic, s.tokens, CASE WHEN m > 0 AND goal IS NOT NULL THEN s.weight * (goal / m) ELSE s.weight END AS weight
  FROM (SELECT *, sum(weight) OVER (PARTITION BY {d}) AS m FROM step{number}) s LEFT JOIN goal_{d} USING ({d})
)""")
            number += 1
    return f"""WITH {", ".join(blocks)}
SELECT doc_id, source, lang, topic, r.tokens::BIGINT AS tokens, round(p, 6) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{seed}'), 1, 12))::BIGINT / 281474976710656.0 < p AS kept
FROM rows r JOIN (
  SELECT source, lang, topic, least({share} * CASE WHEN tokens > 0 THEN weight / tokens ELSE 1 END, 1) AS p FROM step{number}
) USING (source, lang, topic)"""


def crc32_sql(number: str) -> str:
    """Unsigned crc32 of a number's decimal digits, bit by bit; 0 for null."""
    return f"""coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split({number}::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295), 0)"""


def _climb(name: str, levels: int) -> list[str]:
    """Blocks that take nodes ``{name}0`` (tree, pos, h, n) and walks ``{name}walk0``
    (r, tree, pos, cur, proof) up to the roots of trees of at most 8 ** levels nodes."""
    blocks = []
    for k in range(levels):
        run = "PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        blocks.append(f"""{name}sib{k} AS MATERIALIZED (
  SELECT tree, pos, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g FROM {name}{k}
)""")
        blocks.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT tree, pos // 8 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h,
    (n + 7) // 8 AS n FROM {name}{k} GROUP BY tree, pos // 8, n
)""")
        blocks.append(f"""{name}walk{k + 1} AS MATERIALIZED (
  SELECT r, tree, w.pos // 8 AS pos, CASE WHEN n > 1 THEN sha256(l || cur || g) ELSE cur END AS cur, proof || l || g AS proof
  FROM {name}walk{k} w JOIN {name}sib{k} s USING (tree, pos)
)""")
    return blocks


def manifest_sql(levels: int = 8, lang_levels: int = 3) -> str:
    """Leaves, trees per language and the tree above them, a query block per level."""

    def leaf(text: str) -> str:
        values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    blocks = [
        f"""docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS leaf,
    CASE WHEN {crc32_sql("doc_id")} % 3 = 0 THEN {leaf(f"translate(text, '{upper}', '{lower}')")} END AS changed FROM documents
)""",
        """rows AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM docs
)""",
        "d0 AS (SELECT tree, pos, leaf AS h, n FROM rows)",
        "dwalk0 AS (SELECT r, tree, pos, coalesce(changed, leaf) AS cur, '' AS proof FROM rows)",
        *_climb("d", levels),
        f"""subroots AS MATERIALIZED (
  SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM d{levels}
)""",
        "l0 AS (SELECT '' AS tree, place AS pos, h, n FROM subroots)",
        f"lwalk0 AS (SELECT r, '' AS tree, place AS pos, cur, proof FROM dwalk{levels} w JOIN subroots s ON w.tree = s.name)",
        *_climb("l", lang_levels),
    ]
    return f"""WITH {", ".join(blocks)}
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.h AS verified
FROM rows JOIN subroots s ON rows.tree = s.name JOIN lwalk{lang_levels} USING (r) CROSS JOIN l{lang_levels} t"""


def trie_sql() -> str:
    return rf"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), marked AS (
  SELECT conv_id, turn, sha256(strlen(role) || ':' || role || text) AS mark,
    len(regexp_extract_all(text, '[^ 	-]+')) AS words FROM told
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS i FROM marked
), convs AS MATERIALIZED (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS base, {crc32_sql("conv_id")} % 4 AS h FROM placed GROUP BY conv_id
), parts AS (
  SELECT c, 0 AS part, i, mark, words FROM convs JOIN placed ON conv_id = base AND i <= h
  UNION ALL SELECT c, 1, i, mark, words FROM convs JOIN placed ON conv_id = c AND i > h
), rebuilt AS MATERIALIZED (
  SELECT c, mark, words, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM parts
), steps AS MATERIALIZED (
  SELECT c, d, words, sha256(string_agg(mark, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM rebuilt
  UNION ALL SELECT c, 0, 0, 'root' FROM convs
), linked AS MATERIALIZED (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS last FROM steps
), nodes AS MATERIALIZED (
  SELECT d, k, any_value(up) AS up, count(*) AS n_convs, min(c) AS conv_id, max(words) AS words,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '') AS ends FROM linked GROUP BY d, k
), kin AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(m, 0) AS n_children FROM nodes n
  LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.up
  LEFT JOIN (SELECT d - 1 AS d, up AS k, count(*) AS m FROM nodes WHERE d > 0 GROUP BY ALL) kids ON kids.d = n.d AND kids.k = n.k
), totals AS (
  SELECT s.d, s.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * kin.words)::BIGINT AS saved_tokens
  FROM kin JOIN steps s ON s.c = kin.conv_id AND s.d <= kin.d GROUP BY s.d, s.k
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM kin JOIN totals USING (d, k)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": mixing_sql(),
        "op7_host_rules": OP7,
        "op11_manifest": manifest_sql(),
        "op13_prefix_trie": trie_sql(),
    }
