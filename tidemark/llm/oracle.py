"""DuckDB SQL for the queries of this subpackage that SQL can express, written apart from the operators."""

from __future__ import annotations

from tidemark.llm import licenses

# fixed values: markers of the chat template
_MARKS = r"([<\[])(\\*)(/?s>|/?INST\]|NEXT\]|ROLE:|/ROLE\])"

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
    SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS behind,
        length(regexp_replace(text, '{_MARKS}', '\1\\\2\3', 'g')) AS escaped
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
    SELECT *,
        escaped
        + CASE WHEN before IS NOT DISTINCT FROM role THEN 6
            ELSE CASE role WHEN 'assistant' THEN 3 WHEN 'user' THEN 7 ELSE 8 + length(url_encode(role)) END END
        + CASE WHEN behind IS NOT DISTINCT FROM role THEN 0
            ELSE CASE role WHEN 'assistant' THEN 4 WHEN 'user' THEN 8 ELSE 8 END END AS chars
    FROM placed
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(url, 'about:blank') AS url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, payload_bytes, payload_digest, url,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE = r"[\x20\x09-\x0D]"


def license_sql(templates=licenses.TEMPLATES, threshold: float = 0.8) -> str:
    """Every block of every document against every template, word set by word set."""
    values = ", ".join(f"({i}, '{t.label}', '{t.named_by.lower()}', '{t.text.lower()}')" for i, t in enumerate(templates))
    phrases = " UNION ALL ".join(
        f"""SELECT key, i - 1 AS place, '{label}' AS label FROM (SELECT key, words, unnest(range(1, len(words) + 1)) AS i FROM texts)
        WHERE words[i:i + {n - 1}] = [{", ".join(f"'{w}'" for w in phrase.split())}]"""
        for phrase, label in licenses.PHRASES
        for n in [len(phrase.split())]
    )
    return rf"""
WITH templates AS (
    SELECT label, string_split(named_by, ' ') AS named_by, list_distinct(string_split(text, ' ')) AS words,
        len(string_split(text, ' ')) AS size
    FROM (VALUES {values}) AS t(id, label, named_by, text)
), texts AS (
    SELECT row_number() OVER () AS key, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low,
        regexp_extract_all(low, '{_WORD}') AS words
    FROM documents
), sentences AS (
    SELECT key, regexp_extract_all(unnest(regexp_split_to_array(
        regexp_replace(low, '([.!?]){_SPACE}+', '\1' || chr(10) || chr(10), 'g'), '\n{_SPACE}*\n')), '{_WORD}') AS words
    FROM texts
), blocks AS (
    SELECT key, CASE WHEN len(words) <= 2 * w THEN words ELSE words[s + 1:s + 2 * w] END AS words
    FROM (SELECT *, unnest(CASE WHEN len(words) <= 2 * w THEN [0] ELSE range(0, len(words) - w, w) END) AS s
        FROM sentences, (SELECT max(size) AS w FROM templates))
), met AS (
    SELECT key, label, len(list_intersect(blocks.words, templates.words)) / len(templates.words) AS containment
    FROM blocks JOIN templates ON len(list_intersect(blocks.words, templates.words)) >= {threshold} * len(templates.words) - 1e-9
        AND list_has_all(blocks.words, templates.named_by)
), named AS (
    SELECT key, list_distinct(list(label)) AS labels, max(containment) AS best FROM met GROUP BY key
), phrases AS ({phrases}), places AS (
    SELECT key, count(*) AS n, min(place) AS first, max(place) AS last, list_distinct(list(label)) AS labels FROM phrases GROUP BY key
)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, first::BIGINT AS first_word, last::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(places.labels), ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(places.labels, []), coalesce(named.labels, [])))), ',') AS labels,
    CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM texts LEFT JOIN places USING (key) LEFT JOIN named USING (key)
"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[])"
    step = f"list_reduce({bits}, lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    letters = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: {step}), 4294967295)"


PREFIXES = f"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations GROUP BY conv_id
), numbered AS (SELECT *, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM own),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM numbered c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), places AS (SELECT conv_id, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT turns[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ids
    FROM places GROUP BY ALL
), families AS (
    SELECT p.node, min(p.conv_id) AS conv_id, count(c.node) AS n_children
    FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.node[1:p.depth] = p.node GROUP BY p.node
), above AS (
    SELECT n.node, n.n_convs, n.depth, f.n_children, unnest(range(0, n.depth + 1)) AS d FROM nodes n JOIN families f USING (node)
), sums AS (
    SELECT node[1:d] AS node, count_if(n_children = 0)::BIGINT AS n_leaves,
        sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(node[depth].text) END)::BIGINT AS saved_tokens
    FROM above GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, f.n_children, s.n_leaves, s.saved_tokens, sha256(n.ids) AS ends_sha256
FROM nodes n JOIN families f USING (node) JOIN sums s USING (node) LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1] AND p.depth = n.depth - 1
"""

ORACLE: dict[str, str] = {
    "op4_chat_formatting": CHAT,
    "op5_warc": WARC,
    "op11_license_join": license_sql(),
    "op13_prefix_trie": PREFIXES,
}
