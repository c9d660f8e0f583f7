"""DuckDB SQL for the rows of those operators' queries that SQL can state over whole tables."""

from __future__ import annotations

from itertools import permutations

_WORDS = r"regexp_extract_all(body, '[^\x20\x09-\x0D]+')"


def filter_audit_sql() -> str:
    """Every order is a row of five letters; a step removes what fails its filter and none before."""
    orders = ", ".join(f"('{''.join(x)}')" for x in permutations("ABCDE"))
    fails = "CASE filter " + " ".join(f"WHEN '{x}' THEN {x}" for x in "ABCDE") + " END"
    earlier = " OR ".join(f"({x} AND position('{x}' IN before) > 0)" for x in "ABCDE")
    others = " OR ".join(f"({x} AND filter <> '{x}')" for x in "ABCDE")
    return f"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
counted AS (
    SELECT doc_id, part, body, len({_WORDS}) AS words, len(list_distinct({_WORDS})) AS different,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS E
    FROM texts),
marks AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id),
judged AS (
    SELECT part, words < 200 AS A, 100 * different < 50 * words AS B,
           100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) AS C,
           regexp_matches(body, '[#$%&*|]') AS D, E, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM counted LEFT JOIN marks USING (doc_id)),
kinds AS (
    SELECT part, A, B, C, D, E, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM judged GROUP BY ALL),
steps AS (
    SELECT filter_order, step, filter_order[step] AS filter, filter_order[:step - 1] AS before
    FROM (VALUES {orders}) AS o(filter_order), range(1, 6) AS s(step)),
held AS (
    SELECT part, filter_order, step, filter, docs, good, toxic, {fails} AS failed, {earlier} AS gone, {others} AS elsewhere
    FROM kinds, steps),
counts AS (
    SELECT part, filter_order, step, filter,
           coalesce(sum(docs) FILTER (NOT gone AND NOT failed), 0) AS kept,
           coalesce(sum(docs) FILTER (NOT gone AND failed), 0) AS removed,
           coalesce(sum(docs) FILTER (gone AND failed), 0) AS redundant,
           coalesce(sum(docs) FILTER (failed AND NOT elsewhere), 0) AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND failed), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (NOT gone AND failed), 0) AS toxic_lost
    FROM held GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counts"""


def prefix_trie_sql() -> str:
    """Prefixes as lists of turns; a node's subtree holds every node that has it among its ancestors."""
    # CRC-32 of the ASCII bytes of a decimal number, bit by bit.
    rounds = "list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc32 = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT)), "
        f"lambda crc, byte: {rounds}), 4294967295)"
    )
    return f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {crc32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT c.conv_id, 0 AS seg, p, role, text FROM convs c JOIN turns t ON t.conv_id = c.base WHERE p <= h
    UNION ALL
    SELECT t.conv_id, 1, p, role, text FROM turns t JOIN convs c ON c.conv_id = t.conv_id WHERE p > h),
numbered AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY seg, p) AS depth FROM rebuilt),
members AS (
    SELECT conv_id, depth, length(text) AS chars,
           list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix
    FROM numbered
    UNION ALL SELECT conv_id, 0, 0, [] FROM convs),
nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM members GROUP BY prefix, depth),
named AS (SELECT m.conv_id AS member, n.depth, n.conv_id FROM members m JOIN nodes n USING (prefix)),
above AS (
    SELECT n.conv_id, n.depth, a.conv_id AS top_id, a.depth AS top, n.n_convs, n.chars
    FROM nodes n JOIN named a ON a.member = n.conv_id AND a.depth <= n.depth),
children AS (SELECT top_id AS conv_id, top AS depth, count(*) AS n_children FROM above WHERE top = depth - 1 GROUP BY 1, 2),
leaves AS (SELECT conv_id, depth FROM nodes ANTI JOIN children USING (conv_id, depth)),
subtrees AS (
    SELECT top_id AS conv_id, top AS depth, count(l.conv_id) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
    FROM above a LEFT JOIN leaves l ON l.conv_id = a.conv_id AND l.depth = a.depth GROUP BY 1, 2),
ends AS (
    SELECT n.conv_id, n.depth, sha256(string_agg(member::VARCHAR, ',' ORDER BY member)) AS ends_sha256
    FROM named n JOIN (SELECT conv_id AS member, max(depth) AS depth FROM members GROUP BY 1) USING (member, depth)
    GROUP BY 1, 2)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.top_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n
JOIN subtrees s ON s.conv_id = n.conv_id AND s.depth = n.depth
LEFT JOIN above p ON p.conv_id = n.conv_id AND p.depth = n.depth AND p.top = n.depth - 1
LEFT JOIN children c ON c.conv_id = n.conv_id AND c.depth = n.depth
LEFT JOIN ends e ON e.conv_id = n.conv_id AND e.depth = n.depth"""


def repeated_bytes_sql(length: int = 50) -> str:
    """Texts as hexadecimal digits, two a byte; every window of ``length`` bytes is compared whole.

    A block holds the ``length`` windows that start in its first half, so no window is cut from a long text.
    """
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS rid, lower(hex(encode(coalesce(text, '')))) AS digits FROM documents),
blocks AS (
    SELECT rid, doc_id, low, digits[2 * low + 1:2 * (low + 2 * {length} - 1)] AS block
    FROM texts, LATERAL (SELECT unnest(range(0, length(digits) // 2 - {length} + 1, {length})) AS low)),
windows AS (
    SELECT rid, doc_id, low + step AS spot, block[2 * step + 1:2 * (step + {length})] AS piece
    FROM blocks, LATERAL (SELECT unnest(range(least({length}, length(block) // 2 - {length} + 1))) AS step)),
repeats AS (SELECT rid, spot FROM (SELECT rid, doc_id, spot, min(doc_id) OVER (PARTITION BY piece) AS first FROM windows) WHERE first < doc_id),
marked AS (SELECT rid, spot, coalesce(spot - lag(spot) OVER (PARTITION BY rid ORDER BY spot) > {length}, true) AS opens FROM repeats),
grouped AS (SELECT rid, spot, sum(opens::INTEGER) OVER (PARTITION BY rid ORDER BY spot) AS span FROM marked),
spans AS (SELECT rid, min(spot) AS low, max(spot) + {length} AS high FROM grouped GROUP BY rid, span),
between_spans AS (
    SELECT rid, low, high, digits[2 * coalesce(lag(high) OVER (PARTITION BY rid ORDER BY low), 0) + 1:2 * low] AS before
    FROM spans JOIN texts USING (rid)),
cut AS (
    SELECT rid, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last, string_agg(before, '' ORDER BY low) AS kept
    FROM between_spans GROUP BY rid)
SELECT doc_id, length(digits) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || digits[2 * coalesce(last, 0) + 1:])) AS kept_sha256
FROM texts LEFT JOIN cut USING (rid)"""


def repeated_words_sql(window: int = 35) -> str:
    """A window's words joined by a space, which no word holds, are compared whole."""
    return f"""
WITH texts AS (
    SELECT doc_id, rid, {_WORDS} AS words
    FROM (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS body FROM documents)),
windows AS (
    SELECT rid, spot, array_to_string(words[spot + 1:spot + {window}], ' ') AS piece
    FROM texts, LATERAL (SELECT unnest(range(len(words) - {window} + 1)) AS spot)),
repeats AS (SELECT rid, spot FROM (SELECT rid, spot, count(*) OVER (PARTITION BY piece) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT rid, spot + step AS place FROM repeats, range({window}) AS s(step)),
places AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM texts),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS words FROM places ANTI JOIN gone USING (rid, place) GROUP BY rid)
SELECT doc_id, len(t.words)::BIGINT AS n_words, (len(t.words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k.words, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (rid)"""


def near_duplicates_sql(width: int = 5, least_percent: int = 80) -> str:
    """Distinct shingle sets, joined on every shingle they share; classes spread over the links."""
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS} AS words FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)),
sets AS (
    SELECT doc_id, list_sort(list_distinct(list_transform(
        range(CASE len(words) WHEN 0 THEN 0 ELSE greatest(1, len(words) - {width} + 1) END),
        lambda i: array_to_string(words[i + 1:i + {width}], ' ')))) AS shingles
    FROM texts),
kinds AS (
    SELECT min(doc_id) AS node, count(*) AS copies, shingles, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
held AS (SELECT node, n, unnest(shingles) AS shingle FROM kinds),
shared AS (
    SELECT a.node AS u, b.node AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
    FROM held a JOIN held b ON a.shingle = b.shingle AND a.node < b.node
        AND 100 * a.n >= {least_percent} * b.n AND 100 * b.n >= {least_percent} * a.n
    GROUP BY a.node, b.node),
pairs AS (SELECT u, v FROM shared WHERE 100 * common >= {least_percent} * (n + m - common)),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reached AS (
    SELECT node, node AS other FROM kinds
    UNION
    SELECT r.node, l.v FROM reached r JOIN links l ON l.u = r.other),
classes AS (SELECT node, min(other) AS class_id FROM reached GROUP BY node),
counted AS (SELECT u AS node, sum(copies) AS near FROM links JOIN kinds ON node = v GROUP BY u),
named AS (
    SELECT shingles, class_id, copies - 1 + coalesce(near, 0) AS n_links
    FROM kinds JOIN classes USING (node) LEFT JOIN counted USING (node))
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM sets LEFT JOIN named USING (shingles)"""
