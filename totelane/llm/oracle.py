"""Queries of operators that plain SQL can express, for another engine. Written for reading:
every window of every text is compared."""

from __future__ import annotations

from totelane.llm.licenses import NOTICES, TEXTS, THRESHOLD

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"

_COPIES = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)"""

_LEAKS = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS words FROM documents),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS words FROM benchmark),
places AS (
    SELECT item_id, words, least(len(words), 10) AS size,
        unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS start
    FROM items WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[start : start + size - 1], ' ') AS run
    FROM places),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
    FROM docs, sizes WHERE len(words) >= size),
hits AS (
    SELECT s.doc_id, s.start, s.size, w.item_id
    FROM starts s JOIN windows w ON w.size = s.size
        AND w.run = array_to_string(s.words[s.start : s.start + s.size - 1], ' ')),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + size)) AS place FROM hits) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_REPEATS = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS start FROM docs),
windows AS (
    SELECT doc_id, start, array_to_string(words[start : start + 12], ' ') AS run FROM starts),
repeated AS (
    SELECT doc_id, start FROM windows
    QUALIFY min(doc_id) OVER (PARTITION BY run) < doc_id),
removed AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 13)) AS place FROM repeated),
spread AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM spread ANTI JOIN removed USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def _templates(kind: str, templates) -> str:
    return ", ".join(
        f"""('{kind}', '{label}', '{text.replace("'", "''")}')""" for label, text in templates
    )


_LICENSES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS spot, doc_id, coalesce(text, '') AS text,
        regexp_extract_all({_LOWER}, {_LETTERS}) AS words
    FROM documents),
templates AS (
    SELECT kind, label, list_distinct(regexp_extract_all(lower(text), {_LETTERS})) AS words,
        len(regexp_extract_all(lower(text), {_LETTERS})) AS length_all
    FROM (VALUES {_templates('notice', NOTICES)}, {_templates('text', TEXTS)}) t(kind, label, text)),
sized AS (
    SELECT row_number() OVER () AS template, *, len(words) AS size,
        CAST(ceil({THRESHOLD} * len(words) - 1e-9) AS BIGINT) AS needed,
        length_all + len(words) - CAST(ceil({THRESHOLD} * len(words) - 1e-9) AS BIGINT) AS reach
    FROM templates),
near AS (
    SELECT spot, docs.words AS own, s.*
    FROM docs JOIN sized s
        ON len(list_intersect(list_distinct(docs.words), s.words)) >= s.needed),
ends AS (
    SELECT *, unnest(range(1, len(own) + 1)) AS stop FROM near),
runs AS (
    SELECT spot, kind, template, label, size, needed, reach, stop, own[stop] AS last_one, words,
        own[greatest(1, stop - reach + 1) : stop] AS run
    FROM ends),
common AS (
    SELECT * EXCLUDE (run), list_reverse(run) AS back, list_intersect(words, run) AS held
    FROM runs WHERE len(list_intersect(words, list_distinct(run))) >= needed),
spans AS (
    SELECT *, stop + 1 - list_max(list_transform(held, lambda w: list_position(back, w))) AS start
    FROM common WHERE list_contains(words, last_one)),
parts AS (
    SELECT spot, 'notice' AS kind, unnest(regexp_split_to_array(
        regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), '[\n\r\x0b\x0c]+')) AS text
    FROM docs
    UNION ALL
    SELECT spot, 'notice', unnest(regexp_split_to_array(regexp_replace(
        regexp_replace(text, '\b([vV])\.', '\1', 'g'),
        '([.!?])(?:[\x00-\x09\x0b-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]*\n|[ \t\n\r\x0b\x0c]+)',
        '\1' || chr(30), 'g'), '\x1e|\n[ \t\r]*\n'))
    FROM docs
    UNION ALL
    SELECT spot, 'text', unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) FROM docs),
blocks AS (
    SELECT row_number() OVER () AS block, spot, kind,
        list_distinct(regexp_extract_all({_LOWER}, {_LETTERS})) AS own
    FROM parts),
matched AS (
    SELECT block, spot, label, size, list_intersect(words, own) AS held
    FROM blocks b JOIN sized s ON s.kind = b.kind AND len(list_intersect(words, own)) >= needed),
judged AS (
    SELECT spot, label, size, held, EXISTS (SELECT 1 FROM matched o WHERE o.block = m.block
        AND len(o.held) > len(m.held) AND len(list_intersect(o.held, m.held)) = len(m.held)) AS within
    FROM matched m
    UNION ALL
    SELECT spot, label, size, held, within FROM (SELECT s.*, EXISTS (SELECT 1 FROM common o WHERE o.spot = s.spot AND o.kind = s.kind
            AND o.stop BETWEEN s.stop AND s.start + o.reach - 1 AND len(o.held) > len(s.held)
            AND len(list_intersect(o.held, s.held)) = len(s.held)) AS within
        FROM spans s)),
alike AS (
    SELECT spot, list(DISTINCT label) FILTER (NOT within) AS labels, max(len(held) / size) AS share
    FROM judged GROUP BY spot),
phrases(phrase, label) AS (VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'),
    (['general', 'public', 'license'], 'gpl')),
starts AS (SELECT spot, words, unnest(range(1, len(words) + 1)) AS start FROM docs
    WHERE list_contains(words, 'license')),
places AS (
    SELECT spot, start - 1 AS place, label FROM starts, phrases
    WHERE words[start : start + len(phrase) - 1] = phrase),
base AS (
    SELECT spot, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        list(DISTINCT label) AS labels
    FROM places GROUP BY spot)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(
        coalesce(base.labels, []), coalesce(alike.labels, [])))), ','), '') AS labels,
    CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(share, 0) END AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (spot) LEFT JOIN alike USING (spot)"""


#: Unsigned CRC-32 of a text, bit by bit and byte by byte.
_CRC_TABLE = """(SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) FROM range(256) t(i))"""


def _crc32(text: str, table: str) -> str:
    octets = (
        f"list_transform(range(CAST(strlen({text}) AS BIGINT)), lambda i: "
        f"CAST(('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))"
    )
    step = f"lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({octets}, {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


_LOWER_OF = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SPELLING = rf"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS steps),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER_OF.format('text')}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents),
counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
keyed AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM counted),
hashed AS (SELECT run, n, {_crc32('key', 'steps')} AS h FROM keyed, crc),
spoilt AS (
    SELECT n, CASE WHEN h % 31 <> 0 THEN run ELSE left(run, h % length(run))
        || substr(run, h % length(run) + 2) END AS word
    FROM hashed),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 7
    GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM words),
patterns AS (
    SELECT word, left(word, place - 1) || '_' || substr(word, place + 1) AS pattern FROM places),
shortened AS (
    SELECT DISTINCT word, left(word, place - 1) || substr(word, place + 1) AS rest FROM places),
near AS (
    SELECT a.word, b.word AS other FROM patterns a JOIN patterns b USING (pattern)
    WHERE a.word <> b.word
    UNION
    SELECT s.word, w.word FROM shortened s JOIN words w ON w.word = s.rest
    UNION
    SELECT w.word, s.word FROM shortened s JOIN words w ON w.word = s.rest),
ranked AS (
    SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, o.n AS other_n,
        row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
    FROM near JOIN words o ON o.word = other),
formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
        CASE WHEN other_n >= 10 * w.n THEN other END AS form,
        CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
    SELECT word, word AS reached, 0 AS step FROM formed
    UNION ALL
    SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.reached
    WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(reached, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(map(_field, fields))})"


_MOST_LEVELS = 8
_LABEL = "coalesce('=' || lang, '-')"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels of the trees in ``leaves`` (tree, place, digest, size)."""
    steps = [f"{name}0 AS (SELECT 0 AS level, tree, place, digest, size FROM {leaves})"]
    for k in range(1, _MOST_LEVELS + 1):
        steps.append(f"""{name}{k} AS (
    SELECT {k} AS level, tree, place // 8 AS place,
        sha256(string_agg(digest, '' ORDER BY place)) AS digest, CAST(ceil(size / 8) AS BIGINT) AS size
    FROM {name}{k - 1} WHERE size > 1 GROUP BY tree, place // 8, size)""")
    every = " UNION ALL ".join(f"SELECT * FROM {name}{k}" for k in range(_MOST_LEVELS + 1))
    return ",\n".join([*steps, f"{name} AS ({every})"])


def _siblings(leaves: str, tree: str) -> str:
    """Per leaf and level the digests to the left and to the right, as lists by level."""
    return f"""SELECT l.tree, l.place, list(l_text ORDER BY level) AS lefts,
        list(r_text ORDER BY level) AS rights
    FROM {leaves} l LEFT JOIN (
        SELECT o.level, o.tree, o.place, 
            coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place < o.place), '') AS l_text,
            coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place > o.place), '') AS r_text
        FROM {tree} o JOIN {tree} s ON s.level = o.level AND s.tree = o.tree
            AND s.place // 8 = o.place // 8
        WHERE o.size > 1 GROUP BY ALL) p
        ON p.tree = l.tree AND p.place = l.place // CAST(pow(8, p.level) AS BIGINT)
    GROUP BY l.tree, l.place"""


_MANIFEST = f"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS steps),
keyed AS (SELECT *, CAST(doc_id AS VARCHAR) AS key FROM documents),
leaves AS MATERIALIZED (
    SELECT doc_id, {_LABEL} AS label, {_leaf('text')} AS leaf,
        CASE WHEN key IS NOT NULL AND {_crc32('key', 'steps')} % 3 = 0
            THEN {_leaf(_LOWER_OF.format('text').replace("coalesce(text, '')", 'text'))} END AS changed
    FROM keyed, crc),
ranked AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY label) - 1 AS tree, leaf AS digest,
        row_number() OVER (PARTITION BY label ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY label) AS size
    FROM leaves),
{_tree('nodes', 'ranked')},
subroots AS MATERIALIZED (SELECT tree, digest AS subroot FROM nodes WHERE size = 1),
groups AS MATERIALIZED (
    SELECT 0 AS tree, tree AS place, subroot AS digest, count(*) OVER () AS size FROM subroots),
{_tree('tops', 'groups')},
root AS (SELECT digest AS root FROM tops WHERE size = 1),
inner_paths AS ({_siblings('ranked', 'nodes')}),
outer_paths AS ({_siblings('groups', 'tops')}),
paths AS (
    SELECT r.*, subroot, root,
        list_filter(list_concat(i.lefts, o.lefts), lambda x: x IS NOT NULL) AS lefts,
        list_filter(list_concat(i.rights, o.rights), lambda x: x IS NOT NULL) AS rights
    FROM ranked r JOIN subroots USING (tree) JOIN inner_paths i USING (tree, place)
        JOIN outer_paths o ON o.place = r.tree, root),
checked AS (
    SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(list_transform(range(len(lefts)), lambda i: lefts[i + 1] || rights[i + 1]), ''))
            AS proof_sha256,
        list_reduce(range(1, len(lefts) + 1), lambda own, i: sha256(lefts[i] || own || rights[i]),
            coalesce(changed, leaf)) AS folded_root
    FROM paths)
SELECT *, folded_root = root AS verified FROM checked"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_NIBBLE = "(strpos('0123456789abcdef', substr(hash, CAST({0} AS BIGINT), 1)) - 1)"
_FIVE_BITS = (
    f"((16 * {_NIBBLE.format('5 * i // 4 + 1')} + {_NIBBLE.format('5 * i // 4 + 2')})"
    " >> (3 - 5 * i % 4)) & 31"
)

_ARCHIVES = f"""
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hash FROM pages),
ranked AS (
    SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS source
    FROM hashed WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32),
        lambda i: substr('{_BASE32}', CAST(({_FIVE_BITS}) + 1 AS BIGINT), 1)), '') AS payload_digest,
    CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN place > 1 THEN source END AS refers_to
FROM ranked"""

ORACLE: dict[str, str] = {
    "op3_exact_dedup": _COPIES,
    "op6_decontamination": _LEAKS,
    "op9_substring_dedup": _REPEATS,
    "op10_licenses": _LICENSES,
    "op11_spelling": _SPELLING,
    "op12_manifest": _MANIFEST,
    "op13_warc": _ARCHIVES,
}
