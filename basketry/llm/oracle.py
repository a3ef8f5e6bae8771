"""DuckDB SQL for the operators that SQL can express, written from their
definitions over whole tables."""

_TOKEN = r"[^\x20\x09-\x0D]+"
_FIELD = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CASE = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def line_dedup_ctes(docs: str, pre: str = "l_") -> str:
    """CTEs; ``{pre}drop`` holds (doc_id, m): lines to drop."""
    return f"""
{pre}tok AS (
  SELECT doc_id, list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS raw
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {docs}) AS cut),
{pre}line AS (
  SELECT DISTINCT doc_id, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w
  FROM {pre}tok WHERE len(raw) >= 4),
{pre}one AS (
  SELECT w, array_to_string(w, ' ') AS m, concat_ws(' ', len(w), w[1], w[2], w[3]) AS leaf, count(*) AS docs
  FROM {pre}line GROUP BY w),
{pre}leaf AS (SELECT leaf, sum(docs) AS total FROM {pre}one GROUP BY leaf HAVING count(*) > 1 AND sum(docs) >= 5),
{pre}at AS (
  SELECT o.leaf, o.m, o.docs, unnest(range(4, len(o.w) + 1)) AS p, unnest(o.w[4:]) AS token
  FROM {pre}one AS o JOIN {pre}leaf USING (leaf)),
{pre}vote AS (
  SELECT a.leaf, a.p, a.token FROM {pre}at AS a JOIN {pre}leaf AS f USING (leaf)
  GROUP BY a.leaf, a.p, a.token, f.total HAVING 2 * sum(a.docs) > f.total),
{pre}member AS (
  SELECT a.m, a.leaf FROM {pre}at AS a LEFT JOIN {pre}vote AS v USING (leaf, p, token)
  GROUP BY a.m, a.leaf HAVING avg(CASE WHEN v.leaf IS NULL THEN 0 ELSE 1 END) >= 0.6),
{pre}use AS (
  SELECT DISTINCT l.doc_id, array_to_string(l.w, ' ') AS m, coalesce('leaf ' || b.leaf, 'line ' || array_to_string(l.w, ' ')) AS tpl
  FROM {pre}line AS l LEFT JOIN {pre}member AS b ON b.m = array_to_string(l.w, ' ')),
{pre}tpl AS (
  SELECT tpl, min(doc_id) AS first_doc FROM (SELECT DISTINCT doc_id, tpl FROM {pre}use) AS d
  GROUP BY tpl HAVING count(*) >= 5),
{pre}drop AS (
  SELECT u.doc_id, list(DISTINCT u.m) AS gone FROM {pre}use AS u JOIN {pre}tpl AS t USING (tpl)
  WHERE u.doc_id IS DISTINCT FROM t.first_doc GROUP BY u.doc_id)"""


LINE_KEY = ("array_to_string(list_transform(list_filter(string_split_regex({x}, '[\\x20\\x09-\\x0D]+'), lambda y: y <> ''), "
            "lambda y: CASE WHEN regexp_matches(y, '[0-9]') THEN '<*>' ELSE y END), ' ')")


def line_dedup_rows(docs: str, pre: str, columns: str) -> str:
    """SELECT of ``columns`` with ``text`` cleaned, after the CTEs."""
    key = LINE_KEY.format(x="x")
    kept = f"list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(g.gone, {key}))"
    return f"""SELECT {columns},
  CASE WHEN g.gone IS NULL THEN d.text ELSE array_to_string({kept}, chr(10)) END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
  CASE WHEN d.text IS NULL OR g.gone IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - len({kept}) END AS n_dropped
FROM {docs} AS d LEFT JOIN {pre}drop AS g ON g.doc_id IS NOT DISTINCT FROM d.doc_id"""


OP1 = f"""
WITH {line_dedup_ctes('documents')}
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(text) AS kept_sha256
FROM ({line_dedup_rows('documents', 'l_', 'd.doc_id')}) AS r"""


def mixing_rows(docs: str) -> str:
    return f"""
WITH measured AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '{_TOKEN}')), 0)::BIGINT AS size,
    greatest(0.05, coalesce(1.0::DOUBLE - (length(text) - length(regexp_replace(text, '[!-Z\\[-`{{-~]', '', 'g')))::DOUBLE
                            / nullif(length(text), 0), 0.0)) AS weight,
    (('0x' || substr(md5(concat_ws('|', 'mix-1', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 12))::BIGINT + 0.5::DOUBLE)
      / 281474976710656.0::DOUBLE AS u
  FROM {docs}),
keyed AS (SELECT *, exp(ln(u) / weight) AS k FROM measured),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
    3.0::DOUBLE * source_size AS cap FROM sources),
-- the level at which weight * level, capped, sums to all sizes: the caps below it are full
level AS (
  SELECT a.source, a.source_size, a.w, a.cap,
    (SELECT arg_min(lv, cap / w) FROM (
      SELECT c.cap, c.w,
        ((SELECT sum(source_size) FROM weighed) - coalesce((SELECT sum(f.cap) FROM weighed AS f WHERE f.cap / f.w < c.cap / c.w), 0))
        / (SELECT sum(g.w) FROM weighed AS g WHERE g.cap / g.w >= c.cap / c.w) AS lv
      FROM weighed AS c) AS t WHERE t.lv <= t.cap / t.w) AS lv
  FROM weighed AS a),
targets AS (SELECT source, source_size, CASE WHEN lv IS NULL THEN cap ELSE least(cap, lv * w) END AS target FROM level),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets),
run AS (
  SELECT s.*, b.source_size, b.target, b.epochs, round(b.target - b.epochs * b.source_size)::BIGINT AS need,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k DESC, s.doc_id NULLS LAST, s.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed AS s JOIN budget AS b ON b.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, need - before)))::BIGINT AS taken
FROM run"""


OP3 = mixing_rows("documents")


def decontam_ctes(docs: str, pre: str = "b_") -> str:
    words = "list_filter(string_split_regex(" + _CASE + f", '{_BETWEEN}'), lambda x: x <> '')"
    return f"""
{pre}item AS (SELECT item_id::VARCHAR AS item, {words.format("coalesce(text, '')")} AS w FROM benchmark),
{pre}win AS (
  SELECT DISTINCT item, w[i:i + least(len(w), 10) - 1] AS run
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM {pre}item WHERE len(w) > 0) AS x),
{pre}size AS (SELECT DISTINCT len(run) AS n FROM {pre}win),
{pre}doc AS (
  SELECT DISTINCT doc_id, text, {words.format("coalesce(text, '')")} AS w FROM {docs}),
{pre}run AS (
  SELECT doc_id, text, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM {pre}doc, {pre}size WHERE len(w) >= n),
{pre}hit AS (
  SELECT r.doc_id, r.text, r.p, r.n, v.item FROM {pre}run AS r JOIN {pre}win AS v ON v.run = r.w[r.p:r.p + r.n - 1]),
{pre}count AS (
  SELECT doc_id, text, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, text, unnest(range(p, p + n)) AS at FROM {pre}hit) AS a GROUP BY doc_id, text),
{pre}list AS (
  SELECT doc_id, text, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS items FROM {pre}hit GROUP BY doc_id, text)"""


OP4 = f"""
WITH {decontam_ctes('documents')}
SELECT d.doc_id, len({('list_filter(string_split_regex(' + _CASE + f", '{_BETWEEN}'), lambda x: x <> '')").format("coalesce(d.text, '')")})::BIGINT AS n_words,
  coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(len(l.items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(l.items, ','), '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM documents AS d
LEFT JOIN b_count AS c ON c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.text = d.text
LEFT JOIN b_list AS l ON l.doc_id IS NOT DISTINCT FROM d.doc_id AND l.text = d.text"""


OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


def _put(x: str, cost, letters: str) -> str:
    """A repair (nine digits of cost, then the edits) with more edits."""
    return f"(lpad((left({x}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({x}, 10) || '{letters}')"


# Conversations step by step: x0 to x3 are the cheapest repairs of the rows so far that
# end at the start, after s, after u, after a; p0 to p3 those with inserts behind them.
_STAY = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
_MAY = "fault NOT IN ('blank', 'duplicate')"
_TO_U = "least(p0, p1, p3)"
OP11 = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY b) AS t FROM range(256) AS r(b)),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hurt AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS h FROM given, crc_table),
row AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hurt, range(2) AS copies(c) WHERE h <> 0 AND (c = 0 OR h = 3)),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER w AS p, left(role, 1) AS r, coalesce(left(lag(role) OVER w, 1) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS wrong,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
  FROM row WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(10) || text))),
fault AS MATERIALIZED (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS p, '000000000' AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM fault
  UNION ALL
  SELECT conv_id, p, {_put('p0', 2, 'D')}, least({_put('p1', 2, 'D')}, CASE WHEN {_MAY} AND r = 's' THEN {_put('p0', _STAY, 'K')} END),
    least({_put('p2', 2, 'D')}, CASE WHEN {_MAY} THEN {_put(_TO_U, '1 + ' + _STAY, 'R')} END, CASE WHEN {_MAY} AND r = 'u' THEN {_put(_TO_U, _STAY, 'K')} END),
    least({_put('p3', 2, 'D')}, CASE WHEN {_MAY} THEN {_put('p2', '1 + ' + _STAY, 'R')} END, CASE WHEN {_MAY} AND r = 'a' THEN {_put('p2', _STAY, 'K')} END)
  FROM (SELECT conv_id, p, r, fault, x0 AS p0, x1 AS p1,
      least(x2, {_put('x0', 5, 'I')}, {_put('x1', 5, 'I')}, {_put('x3', 5, 'I')}) AS p2,
      least(x3, {_put('x2', 5, 'I')}, {_put('x0', 10, 'II')}, {_put('x1', 10, 'II')}) AS p3
    FROM (SELECT f.conv_id, f.p, f.r, f.fault, x0, x1, x2, x3 FROM walk AS w JOIN fault AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.p = w.p + 1) AS met) AS before_row),
best AS MATERIALIZED (
  SELECT conv_id, arg_max(least(x0, x3, {_put('x2', 5, 'I')}, {_put('x1', 10, 'II')}), p) AS x FROM walk GROUP BY conv_id),
edit AS (
  SELECT conv_id, unnest(string_split(substr(x, 10), '')) AS e, unnest(range(1, length(x) - 8)) AS i FROM best),
step AS (
  SELECT *, sum((e <> 'I')::INT) OVER w AS p, sum((e <> 'D')::INT) OVER w AS m FROM edit WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
line AS (
  SELECT s.conv_id, s.i, s.m, s.e, f.role, f.text, max((s.m = 1 AND s.e = 'K' AND f.r = 's')::INT) OVER (PARTITION BY s.conv_id) AS s_first
  FROM step AS s LEFT JOIN fault AS f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.p = s.p AND s.e <> 'I' WHERE s.e <> 'D'),
fixed AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (m - s_first) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS whole
  FROM line GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
  FROM fault GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(x, 9), '0')::BIGINT AS cost,
  coalesce(substr(x, 10), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN fixed AS f ON f.conv_id IS NOT DISTINCT FROM o.conv_id"""


def _centroid_rounds(rounds: int) -> str:
    """CTEs ``c0`` to ``c{rounds}`` (centroids) and ``a0`` to ``a{rounds}`` (assignments)."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, arg_min(k, d * 64 + k) AS k, min(d) AS d FROM (
    SELECT v.row, c.k, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::BIGINT AS d
    FROM v CROSS JOIN c{r} AS c) AS x GROUP BY row)""")
        if r < rounds:
            parts.append(f"""
s{r} AS MATERIALIZED (
  SELECT k, list(floor_sum ORDER BY i) AS e FROM (
    SELECT a.k, i, (sum(v.e[i]) - ((sum(v.e[i]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_sum
    FROM a{r} AS a JOIN v USING (row), range(1, 65) AS g(i) GROUP BY a.k, i) AS y GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(s.e, c.e) AS e FROM c{r} AS c LEFT JOIN s{r} AS s USING (k))""")
    return ",".join(parts)


OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS k, e FROM v WHERE vec_id IS NOT NULL
  QUALIFY k < 40),{_centroid_rounds(5)}
SELECT v.vec_id, a.k::INTEGER AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a5 AS a JOIN v USING (row) JOIN c5 AS c USING (k)"""


# Turns as given; their formatted length follows from the template: 17 characters
# of markers, a backslash for each backslash and each control string.
OP13 = r"""
WITH chat AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER w AS p, count(*) OVER (PARTITION BY conv_id) AS n,
    17 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '\\|</?s>|\[/?INST\]')) AS chars
  FROM chat WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
prefix AS (
  SELECT *, 3 + sum(chars) OVER (PARTITION BY conv_id ORDER BY p) AS upto FROM placed)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR p = n)::BIGINT AS formatted_chars
FROM prefix GROUP BY conv_id"""


ORACLE = {"op1_line_dedup": OP1, "op3_mixing": OP3, "op4_decontamination": OP4, "op10_top_k": OP10,
          "op11_repair": OP11, "op12_centroids": OP12, "op13_chat_format": OP13}
