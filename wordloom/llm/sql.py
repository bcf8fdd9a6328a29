"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP7 = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest
    FROM payloads
), holders AS (
    SELECT payload_digest, max(page_id) AS holder FROM digests
    WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < holder THEN holder END AS refers_to
FROM digests LEFT JOIN holders USING (payload_digest)
"""

# Lists of words, lines and windows, with lists where the operator uses arrays.
OP6 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT row_id, doc_id, text, list_filter(
        string_split_regex(text, '[ \t\n\v\f\r]+'), lambda w: w <> '') AS words
    FROM texts
), tokens AS (
    SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split
), five AS (
    SELECT row_id, pos, word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w
        || ' ' || lead(word, 3) OVER w || ' ' || lead(word, 4) OVER w AS gram
    FROM tokens WINDOW w AS (PARTITION BY row_id ORDER BY pos)
), again AS (
    SELECT DISTINCT row_id FROM (SELECT row_id FROM five WHERE gram IS NOT NULL
        GROUP BY row_id, gram HAVING count(*) > 1)
), windows AS (
    SELECT row_id, 5 AS n, pos, gram FROM five JOIN again USING (row_id) WHERE gram IS NOT NULL
    UNION ALL
    SELECT a.row_id, sizes.n, a.pos, a.gram || '  ' || b.gram
    FROM five AS a JOIN again USING (row_id) CROSS JOIN (VALUES (6), (7), (8), (9), (10)) AS sizes(n)
        JOIN five AS b ON b.row_id = a.row_id AND b.pos = a.pos + sizes.n - 5
    WHERE b.gram IS NOT NULL
), counted AS (
    SELECT row_id, n, pos, count(*) OVER (PARTITION BY row_id, n, gram) AS times,
        row_number() OVER (PARTITION BY row_id, n, gram ORDER BY pos) AS turn
    FROM windows
), repeated AS (
    SELECT DISTINCT row_id, unnest(range(pos, pos + 5)) AS pos FROM counted
    WHERE n = 5 AND times > 1
), repeat_words AS (
    SELECT row_id, count(*) AS n_repeat_words FROM repeated GROUP BY row_id
), covered AS (
    SELECT DISTINCT row_id, n, unnest(range(pos, pos + n)) AS pos FROM counted WHERE turn > 1
), covered_chars AS (
    SELECT row_id, n, sum(length(word))::BIGINT AS chars
    FROM covered JOIN tokens USING (row_id, pos) GROUP BY row_id, n
), by_n AS (
    SELECT row_id, map_from_entries(list((n, chars))) AS chars FROM covered_chars GROUP BY row_id
), lines AS (
    SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM texts
), dup_lines AS (
    SELECT row_id, count(*) AS n_dup_lines, sum(length(inner_chars))::BIGINT AS dup_line_chars
    FROM (SELECT row_id, regexp_replace(line, '[ \t\n\v\f\r]+', '', 'g') AS inner_chars,
            row_number() OVER (PARTITION BY row_id, line) AS turn FROM lines)
    WHERE turn > 1 AND inner_chars <> '' GROUP BY row_id
), measured AS (
    SELECT doc_id, len(words) AS n_words,
        length(regexp_replace(text, '[ \t\n\v\f\r]+', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(dup_line_chars, 0) AS dup_line_chars,
        list_transform([5, 6, 7, 8, 9, 10], lambda n: coalesce(chars[n], 0)) AS dup_ngram_chars
    FROM split LEFT JOIN dup_lines USING (row_id) LEFT JOIN repeat_words USING (row_id)
        LEFT JOIN by_n USING (row_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT * EXCLUDE (dup_ngram_chars),
    dup_ngram_chars[1] AS dup_5gram_chars, dup_ngram_chars[2] AS dup_6gram_chars,
    dup_ngram_chars[3] AS dup_7gram_chars, dup_ngram_chars[4] AS dup_8gram_chars,
    dup_ngram_chars[5] AS dup_9gram_chars, dup_ngram_chars[6] AS dup_10gram_chars,
    NOT (base_failed OR 100 * dup_line_chars > 20 * word_chars
    OR 100 * dup_ngram_chars[1] > 15 * word_chars OR 100 * dup_ngram_chars[2] > 14 * word_chars
    OR 100 * dup_ngram_chars[3] > 13 * word_chars OR 100 * dup_ngram_chars[4] > 12 * word_chars
    OR 100 * dup_ngram_chars[5] > 11 * word_chars OR 100 * dup_ngram_chars[6] > 10 * word_chars
    ) AS kept
FROM judged
"""

# Every share of every kept term in every group, and all pairs of groups.
OP11 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang,
        coalesce(source, '') AS source, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), words AS (
    SELECT row_id, lang, source, unnest(words) AS term FROM texts
), kept AS (
    SELECT lang, term, count(*) AS all_n FROM words GROUP BY lang, term
    HAVING count(DISTINCT row_id) >= 30
), langs AS (
    SELECT lang, count(*) AS v, sum(all_n)::HUGEINT AS all_total FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL
), sources AS (
    SELECT lang, source, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN totals USING (lang, source)
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p,
        1 + (1000000000::HUGEINT * (all_n + 5)) // (all_total + 5 * v) AS q
    FROM sources AS s JOIN kept AS k USING (lang) JOIN langs USING (lang)
        LEFT JOIN counts AS c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term
    WHERE a.source <> b.source GROUP BY ALL
), rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM sources AS a JOIN sources AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM rows)
WHERE part = 'pair' OR rank <= 50
"""

# Costs and letters so far, by state, as one string that sorts by cost and then by letters:
# nine digits and the letters. A row is folded in by lists of four strings, one for what
# came last: nothing, a system row, a user, an assistant.
def _more(value: str, cost: int, letter: str) -> str:
    return (f"lpad((left({value}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') "
            f"|| substr({value}, 10) || '{letter}'")


def _least(*values: str) -> str:
    return f"least({', '.join(values)})"


def _inserted(acc: str) -> str:
    """The list when missing rows may be put in."""
    user = _least(f"{acc}[3]", *(_more(f"{acc}[{k}]", 5, "I") for k in (1, 2, 4)))
    return (f"list_transform([[{acc}[1], {acc}[2], {user}, {acc}[4]]], lambda v: "
            f"[v[1], v[2], v[3], {_least('v[4]', _more('v[3]', 5, 'I'))}])[1]")


def _folded(acc: str, row: str) -> str:
    """The list after a row, [initial, fault, null, null]."""
    def options(state: int) -> str:
        edges = {2: ((1,), "s"), 3: ((1, 2, 4), "u"), 4: ((3,), "a")}
        found = [_more(f"{acc}[{state}]", 2, "D")]
        if state in edges:
            reached, initial = edges[state]
            for extra, fault in ((0, ""), (5, "truncated")):
                kept = _least(*(_more(f"{acc}[{k}]", extra, "K") for k in reached))
                found.append(f"CASE WHEN {row}[2] = '{fault}' AND {row}[1] = '{initial}' THEN {kept} END")
                if state > 2:
                    changed = _least(*(_more(f"{acc}[{k}]", extra + 1, "R") for k in reached))
                    found.append(f"CASE WHEN {row}[2] = '{fault}' THEN {changed} END")
        return _least(*found)

    return f"[{', '.join(options(state) for state in (1, 2, 3, 4))}]"


_CRC = """xor(4294967295, list_reduce(
        list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte:
        list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: xor(c >> 1, 3988292384 * (c & 1)),
            xor(crc, byte)), 4294967295))"""

OP12 = rf"""
WITH plain AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), marked AS (
    SELECT *, {_CRC} % 20 AS damage FROM plain
), damaged AS (
    SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
        CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
        AS text, unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM marked
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
        sha256(octet_length(encode(role)) || ':' || role || text)) AS pos
    FROM damaged
), faults AS (
    SELECT *, left(role, 1) AS initial,
        CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 'truncated'
            ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS neighbours
    FROM placed
), measured AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal,
        list([initial, fault, NULL, NULL] ORDER BY pos) AS rows
    FROM faults GROUP BY conv_id
), folded AS (
    SELECT *, list_reduce(rows, lambda acc, row: list_transform([{_inserted("acc")}],
        lambda open: {_folded("open", "row")})[1], ['000000000', NULL, NULL, NULL]) AS states
    FROM measured
), solved AS (
    SELECT *, least(states[1], {_inserted("states")}[4]) AS best FROM folded
), letters AS (
    SELECT conv_id, unnest(string_split(substr(best, 10), '')) AS letter,
        generate_subscripts(string_split(substr(best, 10), ''), 1) AS k FROM solved
    WHERE length(best) > 9
), counted AS (
    SELECT *, count(*) FILTER (letter <> 'I') OVER w AS pos, count(*) FILTER (letter <> 'D') OVER w AS out
    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), edited AS (
    SELECT c.conv_id, c.k, c.letter, c.out, f.role, f.text,
        max((c.out = 1 AND c.letter = 'K' AND f.initial = 's')::INTEGER)
            OVER (PARTITION BY c.conv_id) AS begins_with_system
    FROM counted AS c LEFT JOIN faults AS f
        ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND c.pos = f.pos AND c.letter <> 'I'
), repaired AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role
        WHEN (out - begins_with_system) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS text
    FROM edited WHERE letter <> 'D' GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost,
    coalesce(substr(best, 10), '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
    LEFT JOIN solved AS s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
    LEFT JOIN repaired AS r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
"""

ORACLE: dict[str, str] = {
    "op6_repetition_coverage": OP6,
    "op7_warc_index": OP7,
    "op11_pattern_tree": OP11,
    "op12_checkpointed_repair": OP12,
}
