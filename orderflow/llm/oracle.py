"""DuckDB SQL for the queries that SQL can express."""

OP2 = """
WITH turns AS (SELECT DISTINCT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, text AS raw_text
               FROM conversations),
ends AS (SELECT pair_id, max(turn) AS last, min(turn) AS first FROM turns WHERE role = 'assistant' GROUP BY pair_id),
opening AS (SELECT t.pair_id, min(t.text) AS text FROM turns t JOIN ends e USING (pair_id)
            WHERE t.role = 'assistant' AND t.turn = e.first GROUP BY t.pair_id),
other AS (SELECT DISTINCT t.pair_id, t.turn, t.role,
                 CASE WHEN t.role = 'assistant' AND t.turn = e.last THEN o.text ELSE t.text END AS text
          FROM turns t LEFT JOIN ends e USING (pair_id) LEFT JOIN opening o USING (pair_id)
          WHERE NOT coalesce(t.role = 'assistant' AND t.turn = e.last AND e.first = e.last, false)),
c AS (SELECT pair_id, turn, list(struct_pack(role := role, text := text) ORDER BY role, text) AS m
      FROM (SELECT DISTINCT pair_id, turn, role, text FROM turns) WHERE pair_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
r AS (SELECT pair_id, turn, list(struct_pack(role := role, text := text) ORDER BY role, text) AS m
      FROM other WHERE pair_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
both_ AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, c.m AS cm, r.m AS rm
          FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.turn = r.turn),
fork AS (SELECT pair_id, min(turn) AS fork FROM both_ WHERE cm IS DISTINCT FROM rm GROUP BY pair_id),
parts AS (
  SELECT b.pair_id, b.turn, 'prompt' AS part, cm AS m FROM both_ b LEFT JOIN fork f USING (pair_id) WHERE f.fork IS NULL OR b.turn < f.fork
  UNION ALL
  SELECT b.pair_id, b.turn, 'chosen', cm FROM both_ b JOIN fork f USING (pair_id) WHERE b.turn >= f.fork AND cm IS NOT NULL
  UNION ALL
  SELECT b.pair_id, b.turn, 'rejected', rm FROM both_ b JOIN fork f USING (pair_id) WHERE b.turn >= f.fork AND rm IS NOT NULL),
spread AS (SELECT pair_id, turn, part, unnest(m) AS x FROM parts)
SELECT pair_id, turn, part, x.role AS role,
       '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10) AS rendered,
       CAST(CASE WHEN part <> 'prompt' AND x.role = 'assistant' THEN 13 + length(x.role) ELSE 0 END AS INTEGER) AS loss_start,
       CAST(CASE WHEN part <> 'prompt' AND x.role = 'assistant' THEN 13 + length(x.role) + length(x.text) + 10 ELSE 0 END AS INTEGER) AS loss_end,
       CAST(coalesce(sum(12 + length(x.role) + 1 + length(x.text) + 11) OVER (PARTITION BY pair_id, part ORDER BY turn, x.role, x.text
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       CAST(coalesce(sum(24 + length(x.role) + length(x.text)) FILTER (part = 'prompt') OVER (PARTITION BY pair_id), 0) AS BIGINT) AS prompt_chars,
       CAST(coalesce(sum(24 + length(x.role) + length(x.text)) FILTER (part = 'chosen') OVER (PARTITION BY pair_id), 0) AS BIGINT) AS chosen_chars,
       CAST(coalesce(sum(24 + length(x.role) + length(x.text)) FILTER (part = 'rejected') OVER (PARTITION BY pair_id), 0) AS BIGINT) AS rejected_chars
FROM spread
"""

OP3 = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
d AS (SELECT h, string_agg(chars, '' ORDER BY g) AS digest FROM (
        SELECT h, g, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31), 1) FOR s IN [15, 10, 5, 0]], '') AS chars
        FROM (SELECT h, g, CAST('0x' || substr(h, 1 + 5 * g, 5) AS INTEGER) AS v FROM f, range(8) AS t(g)))
      GROUP BY h)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN p.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > f.first THEN f.first END AS refers_to
FROM p JOIN f USING (h) JOIN d USING (h)
"""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [t] ELSE [t[i : i + 4] FOR i IN range(1, len(t) - 3)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON reach.b = both_.a),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, root.component_id, w.doc_id = root.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN root USING (doc_id)
"""

OP11 = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM documents),
win AS (SELECT doc_id, i, t[i : i + 12] AS k FROM (SELECT doc_id, t, unnest(range(1, len(t) - 11)) AS i FROM w)),
first AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (k) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(t) AS x, generate_subscripts(t, 1) AS p FROM w),
kept AS (SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept
         FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(t) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP13 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, s),
m AS (SELECT doc_id, 10 + (90 * CAST(len(t) AS BIGINT) * n_docs) // n_terms AS m FROM d, s WHERE len(t) > 0),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op2_preference_formatting": OP2,
    "op3_warc_archives": OP3,
    "op4_minhash_near_dedup": OP4,
    "op11_substring_dedup": OP11,
    "op13_lexical_search": OP13,
}
