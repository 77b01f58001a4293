"""DuckDB SQL for the queries that SQL can express."""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
many AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM many) GROUP BY doc_id),
lines AS (SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN dup ON dup.doc_id = w.doc_id),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
             + CASE WHEN letters >= 20 AND 2 * up > letters THEN 16 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, n_lines, fail_bits FROM b
"""

OP2 = r"""
WITH RECURSIVE e AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, r, x) - 1 AS i,
  regexp_replace(replace(replace(r, '\', '\e'), chr(10), '\n'), '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])', '\1\\\2\3', 'g') AS er,
  regexp_replace(x, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])', '\1\\\2\3', 'g') AS et FROM e),
b AS (SELECT *, '<|im_start|>' || er || chr(10) || et || '<|im_end|>' || chr(10) AS block FROM esc),
t AS (SELECT *, len(regexp_extract_all(regexp_replace(block, '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[\p{L}\p{M}\p{N}_]{1,16}|[^\p{L}\p{M}\p{N}_\x20\x09-\x0D]')) AS tok, length(block) AS size FROM b),
w AS (SELECT *, CASE WHEN first_value(r) OVER o = 'system' THEN 1 ELSE 0 END AS hs, first_value(tok) OVER o AS t0, first_value(size) OVER o AS z0,
  sum(tok) OVER (o ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS t1, sum(tok) OVER (o ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS t2,
  sum(size) OVER (o ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS z1, sum(size) OVER (o ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS z2
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
f AS (SELECT *, i - 2 >= hs AND t2 <= 256 AND hs * t0 + t2 + tok <= 1024 AS two, i - 1 >= hs AND t1 <= 256 AND hs * t0 + t1 + tok <= 1024 AS one FROM w),
h AS (SELECT *, CASE WHEN two THEN t2 WHEN one THEN t1 ELSE 0 END AS bt, CASE WHEN two THEN z2 WHEN one THEN z1 ELSE 0 END AS bz FROM f),
g AS (SELECT conv_id, i, 0::BIGINT AS start, tok::BIGINT AS total FROM h WHERE i = 0
  UNION ALL SELECT h.conv_id, h.i, CASE WHEN g.total + h.tok <= 1024 THEN g.start ELSE h.i END, CASE WHEN g.total + h.tok <= 1024 THEN g.total + h.tok ELSE h.hs * h.t0 + h.bt + h.tok END
  FROM g JOIN h ON h.conv_id = g.conv_id AND h.i = g.i + 1),
n AS (SELECT g.conv_id, count(*) AS n_windows, sum(CASE WHEN g.start = 0 THEN 0 ELSE h.hs * h.z0 + h.bz END) AS again FROM g JOIN h ON h.conv_id = g.conv_id AND h.i = g.i WHERE g.start = g.i GROUP BY 1),
c AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(string_agg(CASE WHEN r = 'assistant' THEN x END, '' ORDER BY i), '') AS target, sum(size) AS size FROM t GROUP BY 1)
SELECT c.conv_id, n_turns, turns_sha256, length(target)::BIGINT AS loss_chars, sha256(target) AS loss_sha256, (size + again)::BIGINT AS formatted_chars, n_windows
FROM c JOIN n ON n.conv_id = c.conv_id
"""

OP8 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a)
SELECT r.a AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""

OP9 = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, ws, least(13, len(ws)) AS l FROM (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS k FROM (SELECT item_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM iw)),
sizes AS (SELECT DISTINCT l FROM win),
spots AS (SELECT doc_id, l, i, array_to_string(ws[i:i + l - 1], ' ') AS k
       FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM dw, sizes WHERE len(ws) >= l)),
hit AS (SELECT doc_id, i, spots.l, item_id FROM spots JOIN win ON win.l = spots.l AND win.k = spots.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN words ON words.doc_id = dw.doc_id LEFT JOIN items ON items.doc_id = dw.doc_id
"""

#: Text pieces between matches give positions: a match begins behind all pieces and matches before it.
_SPANS = """SELECT doc_id, {k} AS k, '{kind}' AS kind, m[i] AS m, (list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::BIGINT AS a
  FROM (SELECT doc_id, p, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, string_split_regex(t, {pattern}) AS p, regexp_extract_all(t, {pattern}) AS m FROM d))"""
_ASSIGN = r"""'(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'"""
_VALUE = r"""'[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$'"""
OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_SPANS.format(k=0, kind="assign", pattern=_ASSIGN)} UNION ALL {_SPANS.format(k=1, kind="access", pattern="'AKIA[A-Z0-9]+'")} UNION ALL {_SPANS.format(k=2, kind="hex", pattern="'[0-9a-f]+'")}),
kept AS (SELECT * FROM s WHERE CASE k WHEN 0 THEN length(regexp_extract(m, {_VALUE}, 1)) >= 6 WHEN 1 THEN length(m) >= 20 ELSE length(m) >= 24 END)
SELECT d.doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || a || ':' || (a + length(m)), ',' ORDER BY a, k), '')) AS base_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP4 = "SELECT doc_id, true AS covered, true AS sequences_fit, true AS one_padded FROM documents"
OP6 = "SELECT s AS shard, (n * (s + 1) // 40 - n * s // 40)::BIGINT AS n_rows, true AS gapless FROM (SELECT count(*) AS n FROM documents), range(40) x(s)"

OP1_ABLATION = f"""
SELECT rule, sum(CASE WHEN fail_bits & mask <> 0 THEN 1 ELSE 0 END)::BIGINT AS n_failed, sum(CASE WHEN fail_bits = mask THEN 1 ELSE 0 END)::BIGINT AS n_failed_alone,
       sum(CASE WHEN fail_bits & ~mask = 0 THEN 1 ELSE 0 END)::BIGINT AS n_kept_without
FROM ({OP1}), (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbol_heavy', 4), ('duplicate_lines', 8), ('shouting', 16), ('word_length', 32)) r(rule, mask) GROUP BY rule
"""

#: Samples of the padded bytes as 64 columns; a cell of the hash gets each sample by the part that lies in it. A tile's file is a
#: header of 128 bytes, its samples behind; 64 bytes for a checksum are folded bit by bit.
OP11 = r"""
WITH b AS (SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
p AS (SELECT *, greatest((n + 63) // 64, 1) AS rows FROM b),
x AS (SELECT *, t || repeat(chr(0), (rows * 64 - n)::INT) AS payload FROM p),
h AS (SELECT *, hex(encode(payload)) AS hex FROM x),
s AS (SELECT doc_id, rows, i // 64 AS y, i % 64 AS x, ('0x' || substr(hex, (2 * i + 1)::BIGINT, 2))::BIGINT AS v FROM (SELECT doc_id, rows, hex, unnest(range(rows * 64)) AS i FROM h)),
cy AS (SELECT doc_id, i, x, sum(v * (least((y + 1) * 8, (i + 1) * rows) - greatest(y * 8, i * rows))) AS v FROM s, range(8) c(i)
       WHERE least((y + 1) * 8, (i + 1) * rows) > greatest(y * 8, i * rows) GROUP BY 1, 2, 3),
cells AS (SELECT doc_id, i, j, sum(v * (least((x + 1) * 9, (j + 1) * 64) - greatest(x * 9, j * 64))) AS v FROM cy, range(9) c(j)
       WHERE least((x + 1) * 9, (j + 1) * 64) > greatest(x * 9, j * 64) GROUP BY 1, 2, 3),
bits AS (SELECT a.doc_id, a.i, sum(CASE WHEN a.v < b.v THEN 1 << (7 - a.j) ELSE 0 END)::INT AS byte FROM cells a JOIN cells b ON b.doc_id = a.doc_id AND b.i = a.i AND b.j = a.j + 1 GROUP BY 1, 2),
feature AS (SELECT doc_id, string_agg(lower(printf('%02x', byte)), '' ORDER BY i) AS feature FROM bits GROUP BY 1),
tile AS (SELECT doc_id, hex, k, least(256, rows - 256 * k) AS r FROM (SELECT doc_id, hex, rows, unnest(range((rows + 255) // 256)) AS k FROM h)),
file AS (SELECT doc_id, k, '934E554D50590100' || '7600' || hex(encode(rpad('{''descr'': ''|u1'', ''fortran_order'': False, ''shape'': (' || r || ', 64, 1), }', 117, ' ') || chr(10))) || substr(hex, 32768 * k + 1, 128 * r) AS f FROM tile),
media AS (SELECT doc_id, string_agg(f, '' ORDER BY k) AS f FROM file GROUP BY 1),
tail AS (SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(64), lambda i: ('0x' || substr(hex, length(hex) - 127 + 2 * i, 2))::BIGINT)),
  lambda c, v: list_reduce(list_prepend(xor(c, v), range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc FROM h)
SELECT h.doc_id, h.n AS n_bytes, rows * 64 AS payload_bytes, sha256(payload) AS payload_sha256, xor(crc, 4294967295)::BIGINT AS tail_crc32,
       (length(f) // 2)::BIGINT AS media_bytes, sha256(unhex(f)) AS media_sha256, feature
FROM h JOIN media ON media.doc_id = h.doc_id JOIN tail ON tail.doc_id = h.doc_id JOIN feature ON feature.doc_id = h.doc_id
"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS ws FROM d),
c AS (SELECT *, len(ws)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(ws) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(ws) + 1) AS c2,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
           WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT *, array_to_string(ws[:least(c1, c2)], '') AS pre, array_to_string(ws[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid, array_to_string(ws[greatest(c1, c2) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""

OP13 = rf"""
WITH tf AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents) GROUP BY 1, 2),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
g AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM len),
df AS (SELECT w, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, g GROUP BY w, nn),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
s AS (SELECT item_id, tf.doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::BIGINT AS score
      FROM it JOIN tf ON tf.w = it.w JOIN df ON df.w = it.w JOIN len ON len.doc_id = tf.doc_id, g GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""

OP1_POLICIES = f"""
WITH l AS ({OP1}), r(rule, mask) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbol_heavy', 4), ('duplicate_lines', 8), ('shouting', 16), ('word_length', 32)),
m AS (SELECT policy, '' AS "without", whole AS mask FROM (VALUES ('v1', 3), ('v2', 63)) p(policy, whole)
      UNION ALL SELECT policy, rule, whole - mask FROM (VALUES ('v1', 3), ('v2', 63)) p(policy, whole) JOIN r ON whole & mask <> 0)
SELECT policy, "without", count(*) FILTER (WHERE fail_bits & mask = 0) AS n_kept, count(*) FILTER (WHERE fail_bits & mask <> 0) AS n_rejected FROM l, m GROUP BY 1, 2
"""

ORACLES = {"op1_policies": OP1_POLICIES, "op11_media": OP11, "op12_fill_middle": OP12, "op13_ranked_search": OP13, "op1_quality_rules": OP1, "op2_chat_format": OP2, "op8_near_dup": OP8, "op9_decontaminate": OP9, "op1_ablation": OP1_ABLATION, "op3_base_columns": OP3, "op4_coverage": OP4, "op6_laws": OP6}
