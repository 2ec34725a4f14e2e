"""DuckDB texts for the queries that SQL can express."""


def crc32_sql(text: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
        lambda state, byte: list_reduce(list_prepend(xor(state, byte), range(8)), lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))
    ))"""


ORACLES: dict[str, str] = {
    "op8_prefix_targets": r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized AS (
    SELECT *,
        12 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + 1
            + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11 AS piece_chars
    FROM given
), placed AS (
    SELECT *,
        row_number() OVER w AS place,
        sum(piece_chars) OVER (w ROWS UNBOUNDED PRECEDING) AS example_chars,
        count(*) OVER (PARTITION BY conv_id) AS turns
    FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), joined AS (
    SELECT conv_id,
        count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
        coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS learned,
        sum(example_chars) FILTER (WHERE role = 'assistant' OR place = turns) AS formatted
    FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
    CAST(formatted AS BIGINT) AS formatted_chars
FROM joined""",
    "op11_periodic_runs": rf"""
WITH given AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS said, {crc32_sql("doc_id::VARCHAR")} AS h
    FROM documents
), planned AS (
    SELECT *, len(said) AS n, CASE WHEN len(said) > 0 THEN (h // 10) % len(said) END AS a FROM given
), read AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN said[i + 1] ELSE said[1 + a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8))] END)
        ELSE said END AS words
    FROM planned
), placed AS (
    SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM read
), matches AS (
    SELECT b.doc_id, b.i, b.i - a.i AS lag FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND a.word = b.word AND a.i < b.i AND 4 * (b.i - a.i) <= b.n
), numbered AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM matches
), stretches AS (
    SELECT doc_id, lag, min(i) - lag AS start, count(*) + lag AS length FROM numbered GROUP BY doc_id, lag, island
), runs AS (
    SELECT doc_id, start, length, min(lag) AS period FROM stretches WHERE length >= greatest(6, 4 * lag) GROUP BY doc_id, start, length
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said FROM placed ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
), told AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said,
        first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS longest
    FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.start AS start, longest.length AS length, longest.period AS period,
    1000 * longest.length // longest.period AS exponent_milli,
    sha256(coalesce(told.said, '')) AS runs_sha256, sha256(coalesce(kept.said, '')) AS collapsed_sha256
FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_prefix_trie": rf"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), told AS (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY place) AS said, {crc32_sql("conv_id::VARCHAR")} % 6 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(l.said, [])[1:c.h], c.said[c.h + 1:]) AS said
    FROM told c LEFT JOIN told l ON l.conv_id = c.conv_id - c.conv_id % 100
), steps AS (
    SELECT conv_id, said, unnest(range(len(said) + 1)) AS depth FROM rebuilt
), nodes AS (
    SELECT said[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(said) = depth), '') AS ends,
        (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(any_value(said[depth].text)) END AS worth
    FROM steps GROUP BY 1, 2
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
), sums AS (
    SELECT n.prefix, sum(m.worth) AS saved_tokens, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves
    FROM linked n JOIN linked m ON m.depth >= n.depth AND m.prefix[1:n.depth] = n.prefix GROUP BY 1
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN sums USING (prefix)""",
}
