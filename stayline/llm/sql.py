"""DuckDB SQL for the queries that SQL can express."""

from stayline.llm import licenses

OP7 = r"""
WITH lines AS (
  SELECT doc_id, i AS position, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, s.key IS NOT NULL AND l.doc_id <> s.keeper AS gone
  FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP10 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), counted AS (SELECT a AS doc_id, count(*) AS n_links FROM both_ways GROUP BY a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id, coalesce(any_value(n_links), 0) AS n_links
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN counted c ON c.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP4 = r"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, s.payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM sized s LEFT JOIN firsts f ON s.payload_digest = f.payload_digest
"""



def _edits(role: str, state: str, turn: str, keeps: str) -> str:
    """Least (cost, audit, body) of deleting, keeping or rewriting a row in a state; what follows is in b_<state>."""
    follow = lambda then, cost, letter, line: (
        f"{{'cost': b_{then}.cost + {cost}, 'audit': '{letter}' || b_{then}.audit, 'body': {line} || b_{then}.body}}"
    )
    named = {"u": "user", "a": "assistant"}[turn]
    must = "fault IN ('blank', 'duplicate')"
    cut = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    kept = " ".join(f"WHEN NOT {must} AND {role} = '{k}' THEN {follow(k, cut, 'K', _LINE)}" for k in keeps)
    rewritten = f"""chr(10) || '{named}:' || text"""
    return f"""list_min([{follow(state, 4, 'D', "''")}, CASE {kept} ELSE {follow(state, 4, 'D', "''")} END,
        CASE WHEN NOT {must} THEN {follow(turn, '3 + ' + cut, 'R', rewritten)} ELSE {follow(state, 4, 'D', "''")} END])"""


def _inserts(own: str, state: str) -> str:
    """Least of no insert, one and two ahead of a row."""
    once = {"e": "u", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}
    first, second = once[state], once[once[state]]
    add = lambda n, then, lines: (
        f"{{'cost': {own}_{then}.cost + {3 * n}, 'audit': '{'I' * n}' || {own}_{then}.audit, 'body': {lines} || {own}_{then}.body}}"
    )
    one = f"chr(10) || '{named[first]}:'"
    return f"list_min([{own}_{state}, {add(1, first, one)}, {add(2, second, one + f' || chr(10) || {chr(39)}{named[second]}:{chr(39)}')}])"


_LINE = "chr(10) || role || ':' || text"
_KEPT = {"e": "su", "s": "u", "u": "a", "a": "u"}
_TURN = {"e": "u", "s": "u", "u": "a", "a": "u"}

# States: e nothing kept yet, s, u, a the initial of the last role.
OP11 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), marked AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
              lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:
                xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT) % 20 AS part
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
         CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN part = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE part <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                               sha256(strlen(role)::VARCHAR || ':' || role || text)) AS i
  FROM damaged
), faults AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE 'none' END AS fault
  FROM placed
), counted AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), steps AS (
  SELECT conv_id, n AS i, {{'cost': 0::BIGINT, 'audit': '', 'body': ''}} AS b_e,
         {{'cost': 6::BIGINT, 'audit': 'II', 'body': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS b_s,
         {{'cost': 3::BIGINT, 'audit': 'I', 'body': chr(10) || 'assistant:'}} AS b_u,
         {{'cost': 0::BIGINT, 'audit': '', 'body': ''}} AS b_a
  FROM counted
  UNION ALL
  SELECT conv_id, i - 1, {', '.join(_inserts('o', s) + f' AS b_{s}' for s in 'esua')}
  FROM (
    SELECT s.conv_id, s.i, {', '.join(_edits('initial', s, _TURN[s], _KEPT[s]) + f' AS o_{s}' for s in 'esua')}
    FROM steps s JOIN faults f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i
  )
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b_e.cost, 0) AS cost,
       coalesce(b_e.audit, '') AS audit, sha256(coalesce(substr(b_e.body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM steps WHERE i = 0) s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM lists, range(1, 6) r(m) WHERE len(w) >= m
), f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a FROM f WHERE m > 1 AND f >= 100),
cuts AS (
  SELECT c.*, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS rest
  FROM candidates c, range(1, 5) r(k) WHERE k < m
), scored AS (
  SELECT c.lang, c.m, c.phrase, a, n, min({'score': ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT, 'k': k, 'l': x.f, 'r': y.f}) AS cut
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = first AND x.m = k
  JOIN f y ON y.lang = c.lang AND y.phrase = rest AND y.m = c.m - k JOIN totals t ON t.lang = c.lang
  GROUP BY ALL
), kept AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM candidates o WHERE o.lang = s.lang AND o.m > s.m AND 100 * o.a >= 100 * s.a
      AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank,
         phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score
  FROM kept
)
SELECT * FROM ranked WHERE rank <= 2000
"""



def _op13() -> str:
    """Words as lists, templates and base phrases as tables; each place is looked at by joins."""
    text = lambda v: "'" + v.replace("'", "''") + "'"
    many = lambda vs, show: "[" + ", ".join(map(show, vs)) + "]"
    templates = ",\n".join(
        f"({text(t['label'])}, {text(t['lead'])}, {t['at']}, {many(t['words'], text)}, {many(t['weights'], str)}, {many(t['must'], str)}, {t['total']})"
        for t in licenses.index(licenses.TEMPLATES)
    )
    base = ",\n".join(f"({many(licenses.words_of(p), text)}, {text(label)})" for p, label in licenses.BASE.items())
    return rf"""
WITH templates(label, lead, place, tw, weights, must, total) AS (VALUES {templates}),
base(bw, label) AS (VALUES {base}),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), based AS (
  SELECT doc_id, i, label FROM places JOIN base ON word = bw[1] WHERE w[i + 1:i + len(bw)] = bw
), agreeing AS (
  SELECT doc_id, label, must, total, list_transform(range(len(tw)), lambda p: i - place + p >= 0 AND coalesce(w[i - place + p + 1] = tw[p + 1], false)) AS ok,
         weights
  FROM places JOIN templates ON word = lead
), found AS (
  SELECT doc_id, label, list_sum(list_transform(range(len(ok)), lambda p: CASE WHEN ok[p + 1] THEN weights[p + 1] ELSE 0 END)) / total AS share
  FROM agreeing WHERE list_bool_and(list_transform(must, lambda p: ok[p + 1]))
), accepted AS (SELECT * FROM found WHERE share >= 0.6),
base_rows AS (
  SELECT doc_id, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM based GROUP BY doc_id
), label_rows AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM based UNION ALL SELECT doc_id, label FROM accepted) GROUP BY doc_id
), scores AS (SELECT doc_id, max(share) AS score FROM accepted GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word, coalesce(b.labels, '') AS base_labels,
       coalesce(l.labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN base_rows b USING (doc_id) LEFT JOIN label_rows l USING (doc_id) LEFT JOIN scores USING (doc_id)
"""


OP13 = _op13()

ORACLES = {"op4_zstd_warc": OP4, "op7_line_dedup": OP7, "op10_jaccard_join": OP10, "op11_conversation_repair": OP11, "op12_hat_trie_collocations": OP12,
    "op13_license_scan": OP13,
}
