"""DuckDB statements that must give the rows of the queries, where SQL can express them."""

from __future__ import annotations

from . import chat_format, licenses, lines, mixing, ngram_join, quality

WORD = r"'[^\x20\x09-\x0D]+'"
SQL: dict[str, str] = {}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    t = f"regexp_replace(lower({column}), {_text(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    for spelling, same in licenses.EQUIVALENT:
        t = f"replace({t}, {_text(spelling)}, {_text(same)})"
    return f"regexp_replace({t}, {_text(licenses.NOT_WORD)}, ' ', 'g')"


def _one_line(column: str) -> str:
    return f"nullif(trim(regexp_replace(replace({column}, chr(10), ' '), ' +', ' ', 'g')), '')"


_known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licenses.KNOWN)
SQL["op2_license_scan"] = f"""
WITH known AS (
    SELECT md5({_one_line('t')}) AS digest, min(license) AS license
    FROM (SELECT license, {_canonical('text')} AS t FROM (VALUES {_known}) AS v(license, text)) GROUP BY 1
), docs AS (
    SELECT doc_id, {_canonical('text')} AS t FROM documents
), named AS (
    SELECT doc_id, array_to_string(list_sort(list(DISTINCT license)), ' ') AS line_licenses, min(line) AS first_line
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS v, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS line FROM docs)
    JOIN known ON digest = md5(trim(v)) GROUP BY doc_id
)
SELECT docs.doc_id, md5({_one_line('docs.t')}) AS digest, known.license,
    coalesce(line_licenses, '') AS line_licenses, first_line
FROM docs LEFT JOIN known ON known.digest = md5({_one_line('docs.t')}) LEFT JOIN named USING (doc_id)
"""


def _repeated(words: int, name: str) -> str:
    """Words that lie in a window of so many words found more than once in the same text."""
    return f"""
{name}_at AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, md5(array_to_string(ws[i:i + {words - 1}], ' '))) AS c
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {words} + 2)) AS i FROM w)
    ) WHERE c > 1
), {name} AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM {name}_at, range({words}) AS r(j) GROUP BY doc_id
)"""


SQL["op5_quality_rules"] = f"""
WITH w AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, {WORD}), []) AS ws, coalesce(string_split(text, chr(10)), []) AS ls FROM documents
), {_repeated(quality.WINDOW, 'five')}, {_repeated(quality.REPEAT_WORDS, 'long')}, {_repeated(quality.LONGEST_REPEAT + 1, 'longest')},
f AS (
    SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(regexp_replace(array_to_string(ws, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(ls, lambda x: regexp_matches(x, {WORD}))) - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, {WORD})))) AS n_dup_lines,
        coalesce(five.n, 0) AS n_repeat_words, coalesce(long.n, 0) AS n_covered_words, longest.n IS NOT NULL AS too_long
    FROM w LEFT JOIN five USING (doc_id) LEFT JOIN long USING (doc_id) LEFT JOIN longest USING (doc_id)
), b AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, base_failed,
    NOT base_failed AND 100 * n_covered_words <= {quality.MOST_COVERED_PERCENT} * n_words AND NOT too_long AS kept
FROM b
"""

# Shortest runs of enough characters, from each line forwards and backwards, by all their lines.
SQL["op8_line_dedup"] = f"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS v, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents
), s AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS spot, sum(length(v)) OVER (PARTITION BY doc_id ORDER BY line) AS upto,
        count(*) OVER (PARTITION BY v) > 1 AS twice FROM l WHERE regexp_matches(v, {WORD})
), runs AS (
    SELECT DISTINCT a.doc_id, a.spot, b.spot AS last FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.twice AND b.twice AND a.spot <= b.spot
        AND b.upto - a.upto + length(a.v) >= {lines.MIN_CHARS}
        AND (b.upto - length(b.v) - a.upto + length(a.v) < {lines.MIN_CHARS} OR b.upto - a.upto < {lines.MIN_CHARS})
), told AS (
    SELECT r.doc_id, r.spot, r.last, string_agg(s.v, chr(10) ORDER BY s.spot) AS said
    FROM runs r JOIN s ON s.doc_id = r.doc_id AND s.spot BETWEEN r.spot AND r.last GROUP BY 1, 2, 3 HAVING bool_and(s.twice)
), copies AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY said ORDER BY doc_id, spot) AS nth FROM told) WHERE nth > 1
), cut AS (
    SELECT *, spot - row_number() OVER (PARTITION BY doc_id ORDER BY spot) AS run
    FROM s JOIN (SELECT DISTINCT doc_id, unnest(range(spot, last + 1)) AS spot FROM copies) USING (doc_id, spot)
), removed AS (
    SELECT doc_id, count(*) AS n_removed, count(DISTINCT run) AS n_runs FROM cut GROUP BY doc_id
), rest AS (
    SELECT doc_id, string_agg(v, chr(10) ORDER BY line) AS kept FROM l ANTI JOIN cut USING (doc_id, line) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_runs, 0) AS n_runs, CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(kept, '')) END AS kept_md5
FROM documents d LEFT JOIN removed USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

_L = 100
SQL["op6_suffix_dedup"] = f"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), s AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, {2 * _L}) AS w FROM (SELECT doc_id, h, unnest(range(0, n - {_L} + 1)) AS i FROM d WHERE n >= {_L})
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM s) WHERE nth > 1
), runs AS (
    SELECT doc_id, min(i) AS a, max(i) + {_L} AS b FROM (
        SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {_L} THEN 0 ELSE 1 END AS new FROM later
        )
    ) GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, b AS x, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS y FROM runs
    UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (coalesce(y, n) - x)), '' ORDER BY x) AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, d.n AS n_bytes, coalesce(g.removed, 0) AS n_removed, coalesce(g.spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY doc_id) g USING (doc_id)
LEFT JOIN kept USING (doc_id)
"""

SQL["op9_ngram_jaccard"] = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}), []) AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {ngram_join.PERCENT} * (x.n + y.n - c)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON a = other
)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


def _number(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 12) AS BIGINT)"


_B, _SEED = mixing.BLOCK_WORDS, mixing.SEED
_other = f"(({_number(str(_SEED), 'source_key', 'pass', 'r')} % whole - spot) % whole + whole) % whole"
_swap = f"{_number(str(_SEED + 1), 'source_key', 'pass', 'r', f'greatest(spot, {_other})')} % 2 = 1"
SQL["op1_mix_sources"] = f"""
WITH d AS (
    SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS source_key,
        coalesce(len(regexp_extract_all(text, {WORD})), 0) AS size FROM documents
), laid AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY {_number("coalesce(CAST(doc_id AS VARCHAR), '')")}, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM d
), s AS (
    SELECT source_key, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source_key
), weighted AS (
    SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM s
), levels AS (
    SELECT most / weight AS ratio, ((SELECT 1.5 * sum(source_size) FROM s) - coalesce(sum(most) OVER earlier, 0))
        / ((SELECT sum(weight) FROM weighted) - coalesce(sum(weight) OVER earlier, 0)) AS level
    FROM weighted WINDOW earlier AS (ORDER BY most / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
    SELECT *, least(most, weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio LIMIT 1)) AS target FROM weighted
), q AS (
    SELECT *, CAST(round(target) AS BIGINT) AS take, source_size // {_B} AS whole, CAST(ceil(source_size / {_B}) AS BIGINT) AS blocks FROM t WHERE source_size > 0
), slots AS (
    SELECT source_key, whole, blocks, take // source_size AS passes, take % source_size AS rest,
        unnest(range(CAST(take // source_size * blocks + ceil((take % source_size) / {_B}) AS BIGINT))) AS k FROM q
), placed AS (
    SELECT source_key, whole, k % blocks AS spot, k // blocks AS pass,
        CASE WHEN k // blocks < passes THEN {_B} ELSE least({_B}, rest - k % blocks * {_B}) END AS words FROM slots
), blocks AS (
    SELECT source_key, words, CASE WHEN spot < whole
        THEN list_reduce(list_prepend(spot, range(1, {mixing.ROUNDS + 1})), lambda spot, r: CASE WHEN {_swap} THEN {_other} ELSE spot END) ELSE whole END AS block FROM placed
), taken AS (
    SELECT l.source_key, l.first, sum(greatest(0, least(least(l.first + l.size, (block + 1) * {_B}) - greatest(l.first, block * {_B}),
        words - greatest(l.first - block * {_B}, 0)))) AS words
    FROM laid l JOIN blocks b ON l.source_key = b.source_key AND l.first < (block + 1) * {_B} AND l.first + l.size > block * {_B}
    WHERE l.size > 0 GROUP BY ALL
)
SELECT doc_id, l.source, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target, CAST(coalesce(words, 0) AS BIGINT) AS taken
FROM laid l JOIN t USING (source_key) LEFT JOIN taken ON taken.source_key = l.source_key AND taken.first = l.first AND l.size > 0
"""


def _escaped(column: str) -> str:
    out = f"replace({column}, {_text(chat_format.ESCAPE)}, {_text(chat_format.ESCAPE * 2)})"
    for control in chat_format.TEMPLATE.controls:
        out = f"replace({out}, {_text(control)}, {_text(control[0] + chat_format.ESCAPE + control[1:])})"
    return out


_marks = sum(map(len, (*chat_format.TEMPLATE.controls, chat_format.TEMPLATE.after)))
SQL["op11_chat_format"] = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({_marks} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

SQL["op12_fill_in_middle"] = """
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
    SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM texts
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS m,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
    SELECT *, substring(t, 1, p) AS prefix, substring(t, p + 1, m - p) AS middle, substring(t, m + 1, n - m) AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""
