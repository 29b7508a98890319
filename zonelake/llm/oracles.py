"""DuckDB SQL of the training-data queries that SQL can express, written from their definitions."""

from __future__ import annotations

from .quality import DELTA, RISK, RULES
from .urls import RULES as URL_RULES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URL_FILTERS = f"""
WITH rules(action, host, path) AS (VALUES {", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
urls AS (
    SELECT page_id, translate(raw, {_ASCII}) AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM cut
),
fits AS (
    SELECT u.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.action, length(r.host || r.path)) AS action
    FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    GROUP BY u.page_id
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM urls LEFT JOIN fits USING (page_id)
"""

LINE_DEDUP = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(l) - 1)) AS i, l FROM l),
k AS (SELECT doc_id, i, [l[i], l[i + 1], l[i + 2]] AS k FROM w),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
cut AS (SELECT doc_id, list(DISTINCT p) AS cut FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM late) GROUP BY doc_id)
SELECT doc_id,
    CASE WHEN cut IS NULL THEN text
        ELSE array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda p: NOT list_contains(cut, p)), lambda p: l[p]), chr(10)) END AS text,
    coalesce(len(l), 0) AS n_lines, coalesce(len(cut), 0) AS n_removed
FROM l LEFT JOIN cut USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM w),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM s),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM late),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) FILTER (g IS NULL) AS kept, count(g) AS n_removed
    FROM (SELECT e.doc_id, e.word, e.p, g.p AS g FROM each e LEFT JOIN gone g USING (doc_id, p)) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 9 * c >= 4 * (x.n + y.n)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT doc_id, min(other) AS class_id, (SELECT count(*) FROM links WHERE a = doc_id) AS n_links FROM reach GROUP BY doc_id
"""


def _quality() -> str:
    cells = " UNION ALL ".join(
        f"SELECT lang, '{rule}' AS rule, {c} AS cutoff, count(*) AS n, count(*) FILTER (100 * {num} > {c} * {den}) AS k FROM good GROUP BY lang"
        for rule, (num, den, cutoffs) in RULES.items()
        for c in cutoffs
    )
    share, fails = RISK / len(RULES), " OR ".join(
        f"coalesce(100 * {num} > (SELECT min(cutoff) FROM admitted a WHERE a.lang IS NOT DISTINCT FROM c.lang AND a.rule = '{rule}') * {den}, false)"
        for rule, (num, den, _) in RULES.items()
    )
    return f"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
t AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM t) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
counts AS (
    SELECT doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
        len(l) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals
    FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w) LEFT JOIN covered USING (doc_id)
),
good AS (SELECT c.* FROM counts c JOIN labels USING (doc_id) WHERE quality = 1),
cells AS ({cells}),
tests AS (
    SELECT lang, rule, cutoff, coalesce(k <= n * {share!r} AND (
        SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r}))) FROM range(0, k + 1) r(i)
    ) <= {DELTA!r} / ((SELECT count(DISTINCT coalesce(lang, '')) FROM good) * {len(RULES)}), false) AS ok FROM cells
),
admitted AS (
    SELECT lang, rule, cutoff FROM tests t WHERE ok
    AND NOT EXISTS (SELECT 1 FROM tests f WHERE f.lang IS NOT DISTINCT FROM t.lang AND f.rule = t.rule AND NOT f.ok AND f.cutoff >= t.cutoff)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {fails} AS rule_failed FROM counts c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR rule_failed) AS kept FROM judged
"""


#: unsigned crc32 (reflected polynomial 0xEDB88320) of a text of ASCII characters
CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(range(1, length({s}) + 1), lambda i: ord(substr({s}, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _part(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"


def _levels(name: str, base: str) -> str:
    """All levels of the trees of ``base`` (lang, idx, hash): (lang, level, idx, hash)."""
    return f"""{name}(lang, level, idx, hash, n) AS (
    SELECT lang, 0, idx, hash, count(*) OVER (PARTITION BY lang) FROM {base}
    UNION ALL
    SELECT lang, level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY lang, level, idx // 2, n
)"""


def _climb(name: str, levels: str, start: str) -> str:
    """Every row of ``start`` (doc_id, lang, idx, hash) folded with its siblings up its tree; the proof grows with them."""
    return f"""{name}(doc_id, lang, level, idx, hash, proof, n) AS (
    SELECT s.doc_id, s.lang, 0, s.idx, s.hash, s.proof, l.n FROM {start} s JOIN {levels} l ON l.lang IS NOT DISTINCT FROM s.lang AND l.level = 0 AND l.idx = s.idx
    UNION ALL
    SELECT c.doc_id, c.lang, c.level + 1, c.idx // 2, sha256(CASE WHEN c.idx % 2 = 1 THEN coalesce(l.hash, '') || c.hash ELSE c.hash || coalesce(l.hash, '') END),
        c.proof || coalesce(l.hash, ''), (c.n + 1) // 2
    FROM {name} c LEFT JOIN {levels} l ON l.lang IS NOT DISTINCT FROM c.lang AND l.level = c.level AND l.idx = xor(c.idx, 1) WHERE c.n > 1
)"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, sha256({" || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS hash,
        sha256({" || ".join(_part(c) for c in ("doc_id", "source", "lang", "changed", "text"))}) AS presented
    FROM (SELECT *, CASE WHEN {CRC32.format(s="doc_id::VARCHAR")} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed FROM documents)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx FROM leaves),
{_levels("lower", "placed")},
subroots AS (SELECT lang, hash, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS turn FROM lower WHERE n = 1),
tops AS (SELECT '' AS lang, turn AS idx, hash FROM subroots),
{_levels("upper", "tops")},
begin AS (SELECT doc_id, lang, idx, presented AS hash, '' AS proof FROM placed),
{_climb("climb", "lower", "begin")},
turned AS (SELECT c.doc_id, '' AS lang, s.turn AS idx, c.hash, c.proof, s.hash AS subroot FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1),
{_climb("rise", "upper", "turned")},
root AS (SELECT hash FROM upper WHERE n = 1)
SELECT doc_id, p.hash AS leaf, t.subroot, r.hash AS root, sha256(f.proof) AS proof_sha256, f.hash AS folded_root, f.hash = r.hash AS verified
FROM rise f JOIN placed p USING (doc_id) JOIN turned t USING (doc_id), root r WHERE f.n = 1
"""


PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT DISTINCT c, c - c % 20 AS head, {CRC32.format(s="c::VARCHAR")} % 4 AS h FROM turns),
rebuilt AS (
    SELECT c, 0 AS own, p, role, text FROM convs JOIN turns USING (c) WHERE p >= h
    UNION ALL SELECT v.c, -1, t.p, t.role, t.text FROM convs v JOIN turns t ON t.c = v.head WHERE t.p < v.h
),
paths AS (
    SELECT c, row_number() OVER w AS d, list(struct_pack(role := role, text := text)) OVER w AS path, text FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, p)
    UNION ALL SELECT c, 0, [], '' FROM convs
),
named AS (SELECT c, d, CASE WHEN d = 0 THEN '' ELSE sha256(path::VARCHAR) END AS name, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w FROM paths),
ends AS (
    SELECT name, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM named JOIN (SELECT c, max(d) AS d FROM named GROUP BY c) USING (c, d) GROUP BY name
),
nodes AS (SELECT name, min(c) AS c, any_value(d) AS d, count(*) AS n, any_value(w) AS w FROM named GROUP BY name),
up AS (SELECT v.name, v.c, v.d, v.n, v.w, u.name AS above FROM nodes v LEFT JOIN named u ON u.c = v.c AND u.d = v.d - 1),
kids AS (SELECT above AS name, count(*) AS k FROM up WHERE above IS NOT NULL GROUP BY above),
below AS (
    SELECT u.name, sum((v.n - 1) * v.w)::BIGINT AS saved, count(*) FILTER (WHERE k IS NULL) AS leaves
    FROM nodes v JOIN named u ON u.c = v.c AND u.d <= v.d LEFT JOIN kids k ON k.name = v.name GROUP BY u.name
)
SELECT v.c AS conv_id, v.d AS depth, u.c AS parent_conv_id, v.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves, saved AS saved_tokens,
    coalesce(e.ends, sha256('')) AS ends_sha256
FROM up v LEFT JOIN nodes u ON u.name = v.above LEFT JOIN kids q ON q.name = v.name JOIN below b ON b.name = v.name LEFT JOIN ends e ON e.name = v.name
"""


ORACLE_SQL = {
    "op2_url_filters": URL_FILTERS,
    "op3_ngram_join": NGRAM_JOIN,
    "op7_line_dedup": LINE_DEDUP,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op10_quality_rules": _quality(),
    "op11_merkle_manifest": MERKLE,
    "op13_prefix_trie": PREFIX_TRIE,
}
