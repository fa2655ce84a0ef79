"""DuckDB SQL for the queries that SQL can express."""

#: Every control string and backslash of a text, and of another role's name, has a backslash before it.
CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *,
        CASE role WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('[OUT][/OUT]</s>')
            ELSE length('[ROLE][/ROLE][/END]') + length(role) END + length(text) AS plain_chars,
        len(regexp_extract_all(text, '\[/?(?:INST|OUT|ROLE|END)\]|</?s>|\\'))
            + CASE WHEN role IN ('user', 'assistant') THEN 0 ELSE len(regexp_extract_all(role, '\[/?(?:INST|OUT|ROLE|END)\]|</?s>|\\')) END AS n_controls
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(plain_chars + n_controls) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

#: Exact Jaccard similarities of all classes that share an n-gram, and connected groups by closure.
NGRAM_JACCARD = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), named AS (
    SELECT doc_id, words, CASE WHEN len(words) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY words) END AS class_id FROM split
), classes AS (
    SELECT class_id, count(*) AS size, any_value(words) AS words FROM named GROUP BY class_id
), grams AS MATERIALIZED (
    SELECT DISTINCT class_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS gram
    FROM classes
), counted AS (
    SELECT class_id, count(*) AS n FROM grams GROUP BY class_id
), common AS (
    SELECT a.class_id AS a, b.class_id AS b, count(*) AS n
    FROM grams AS a JOIN grams AS b ON a.gram = b.gram AND a.class_id < b.class_id GROUP BY ALL
), alike AS (
    SELECT a, b FROM common JOIN counted AS x ON x.class_id = a JOIN counted AS y ON y.class_id = b
    WHERE 10 * common.n >= 8 * (x.n + y.n - common.n)
), links AS MATERIALIZED (
    SELECT a, b FROM alike UNION ALL SELECT b, a FROM alike
), reached AS (
    SELECT class_id AS c, class_id AS r FROM classes
    UNION SELECT reached.c, links.b FROM reached JOIN links ON links.a = reached.r
), grouped AS (
    SELECT c, min(r) AS group_id FROM reached GROUP BY c
), linked AS (
    SELECT links.a AS c, sum(size) AS n FROM links JOIN classes ON classes.class_id = links.b GROUP BY links.a
)
SELECT named.doc_id, named.class_id, CAST(classes.size - 1 + coalesce(linked.n, 0) AS BIGINT) AS n_links, grouped.group_id
FROM named JOIN classes USING (class_id) JOIN grouped ON grouped.c = named.class_id LEFT JOIN linked ON linked.c = named.class_id
"""

#: crc32 byte by byte through its table; one-edit pairs by words with one code point left out; roots by closure.
SPELLING_VARIANTS = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i)
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS crc
    FROM counted, crc_table
), edited AS (
    SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.cut = w.word
    UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.cut = w.word
), best AS (
    SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS form, max(n) AS form_n FROM pairs JOIN words ON words.word = b GROUP BY a
), named AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
    FROM words LEFT JOIN best ON words.word = best.word
), chain AS (
    SELECT word, word AS r FROM named
    UNION ALL SELECT chain.word, form FROM chain JOIN named ON named.word = r WHERE form IS NOT NULL
)
SELECT named.*, r AS root FROM named JOIN chain ON chain.word = named.word JOIN named AS top ON top.word = r WHERE top.form IS NULL
"""

#: All pairs by brute force, components by closure; vectors that link with nothing are a component each.
NEAR_VECTORS = r"""
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT vec_id, vec_id AS r FROM embeddings
    UNION SELECT vec_id, b FROM reached JOIN links ON a = r
), smallest AS (SELECT vec_id, min(r) AS component_id FROM reached GROUP BY vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest ON smallest.vec_id = e.vec_id
"""

FILL_IN_MIDDLE = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS y,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), cut AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:least(x, y)], '') AS p, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS m,
        array_to_string(units[greatest(x, y) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""

SQL = {
    "op2_chat_format": CHAT_FORMAT,
    "op9_ngram_jaccard": NGRAM_JACCARD,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_near_vectors": NEAR_VECTORS,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
