"""DuckDB SQL for the numbered operators that SQL can express, written from what each contract says."""

from __future__ import annotations

import re

from ledgerspark.llm.chat_layouts import Template
from ledgerspark.llm.license_diagonals import BASE_PHRASES, TEMPLATES, K, Voting
from ledgerspark.llm.line_quality import BOILERPLATE, LineRules
from ledgerspark.llm.link_trust import RULES, Propagation
from ledgerspark.llm.pareto_mix import Mix

_BLANK = r"'[^\x20\x09-\x0D]+'"
_LETTER = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op1() -> str:
    p = Propagation()
    host = _LOWER.format(r"regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")
    fits = []
    for rule, verdict in RULES:
        domain, _, rest = rule.partition("/")
        fits.append(
            f"SELECT p, {_quoted(rule)} AS rule, {_quoted(verdict)} AS says FROM parsed "
            f"WHERE (host = {_quoted(domain)} OR suffix(host, {_quoted('.' + domain)})) AND prefix(path, {_quoted('/' + rest)})"
        )
    blank = r"[\x20\x09-\x0D]"
    pattern = (
        rf"\b[hH][rR][eE][fF]{blank}*={blank}*[\"'']?{blank}*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\"''\x20\x09-\x0D>]+)"
    )
    rounds = []
    for n in range(p.rounds):
        rounds.append(f"""
s{n + 1} AS (SELECT host, sum(t) AS trust, sum(d) AS distrust FROM (
    SELECT dst AS host, n * trust / out_n * {p.damping} AS t, 0.0::DOUBLE AS d FROM moves JOIN s{n} ON src = s{n}.host
    UNION ALL SELECT src, 0.0, n * distrust / in_n * {p.damping} FROM moves JOIN s{n} ON dst = s{n}.host
    UNION ALL SELECT host, t0, d0 FROM seeds) GROUP BY host)""")
    keep = 1.0 - p.damping
    return f"""
WITH parsed AS (
    SELECT row_number() OVER () AS p, page_id, html, {host} AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fits AS ({" UNION ALL ".join(fits)}),
ruled AS (SELECT p, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says FROM fits GROUP BY p),
seen AS (SELECT parsed.*, rule, says FROM parsed LEFT JOIN ruled USING (p)),
links AS (
    SELECT host AS src, {_LOWER.format("unnest(regexp_extract_all(coalesce(html, ''), '" + pattern + "', 1))")} AS dst FROM seen),
edges AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> '' AND src <> dst GROUP BY 1, 2),
moves AS (
    SELECT src, dst, n::DOUBLE AS n, sum(n) OVER (PARTITION BY src) AS out_n, sum(n) OVER (PARTITION BY dst) AS in_n FROM edges),
seeds AS (
    SELECT host, avg((says IS NOT DISTINCT FROM 'allow')::INT) * {keep} AS t0,
        avg((says IS NOT DISTINCT FROM 'block')::INT) * {keep} AS d0
    FROM seen WHERE host <> '' GROUP BY host HAVING count(says) > 0),
s0 AS (SELECT host, t0 AS trust, d0 AS distrust FROM seeds),{",".join(rounds)}
SELECT page_id, seen.host, path, rule,
    coalesce(says, CASE WHEN distrust > trust * {p.ratio} AND distrust > {p.least} THEN 'block' ELSE 'allow' END) AS verdict
FROM seen LEFT JOIN s{p.rounds} ON seen.host = s{p.rounds}.host"""


_OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, {_LETTER}) AS w FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id::VARCHAR AS item_id,
    regexp_extract_all({_LOWER.format("text")}, {_LETTER}) AS w FROM benchmark),
windows AS (
    SELECT i, item_id, least(len(w), 10) AS m, array_to_string(w[pos:pos + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT i, item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
grams AS (
    SELECT r, pos, m, array_to_string(w[pos:pos + m - 1], ' ') AS gram
    FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS pos FROM docs, lengths WHERE len(w) >= m)),
met AS (SELECT r, pos, grams.m, item_id FROM grams JOIN windows ON grams.m = windows.m AND grams.gram = windows.gram),
hit AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(pos, pos + m)) AS word FROM met) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM met) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)"""


def _op3() -> str:
    v = Voting()
    places = " UNION ALL ".join(
        "SELECT r, pos, " + _quoted(label) + " AS label FROM docs, unnest(range(1, len(w) + 1)) AS t(pos) WHERE "
        + " AND ".join(f"w[pos + {i}] = {_quoted(word)}" for i, word in enumerate(phrase.split()))
        for phrase, label in BASE_PHRASES.items()
    )
    rows = ", ".join(
        f"({_quoted(label)}, {len(parts)}, {i}, {_quoted(' '.join(parts[i : i + K]))})"
        for label, parts in ((label, text.split()) for label, text in TEMPLATES.items())
        for i in range(len(parts) - K + 1)
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, {_LETTER}) AS w FROM documents),
places AS ({places}),
base AS (
    SELECT r, count(DISTINCT pos) AS n_base, min(pos) - 1 AS first_word, max(pos) - 1 AS last_word, list(DISTINCT label) AS labels
    FROM places GROUP BY r),
templates(template, length, t, gram) AS (VALUES {rows}),
grams AS (SELECT r, pos - 1 AS p, array_to_string(w[pos:pos + {K - 1}], ' ') AS gram
    FROM docs, unnest(range(1, len(w) - {K} + 2)) AS t(pos) WHERE len(w) >= {K}),
votes AS (SELECT r, template, length, p - t AS diagonal, t FROM grams JOIN templates USING (gram)),
diagonals AS (SELECT DISTINCT r, template, diagonal FROM votes),
apart AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {v.merge} THEN 1 ELSE 0 END AS new
    FROM diagonals),
bands AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS band FROM apart),
covered AS (
    SELECT r, template, length, band, count(DISTINCT word) / length AS share
    FROM (SELECT r, template, length, band, unnest(range(t, t + {K})) AS word
        FROM votes JOIN bands USING (r, template, diagonal))
    GROUP BY r, template, length, band),
found AS (
    SELECT r, max(share) AS share, list(DISTINCT template) AS labels FROM covered WHERE share * 100 >= {v.percent} GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
    CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


_OP5 = """
WITH rows AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (1 + ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1) FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM rows"""

_OP6 = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, {_BLANK}) AS w FROM documents),
shingles AS (
    SELECT DISTINCT r, array_to_string(w[pos:pos + least(len(w), 5) - 1], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT r, r FROM docs UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x),
least_id AS (SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.y GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least_id USING (r) LEFT JOIN sizes USING (r)"""


def _op8() -> str:
    p = LineRules()
    phrases = " OR ".join(f"contains(low, {_quoted(x)})" for x in BOILERPLATE)
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), {_BLANK}) AS w FROM documents),
lines AS (
    SELECT r, line, {_LOWER.format("line")} AS low, regexp_extract_all(line, {_BLANK}) AS w, row_number() OVER () AS pos
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)),
worded AS (
    SELECT *, len(w) AS n, strlen(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars,
        length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols, length(regexp_replace(line, '[^!]', '', 'g')) AS shouts,
        len([x FOR x IN w IF x = '|']) AS bars,
        len([i FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]]) AS stutters
    FROM lines WHERE len(w) > 0),
judged AS (
    SELECT r, chars, (100 * symbols > {p.symbol_percent} * chars AND 100 * bars < {p.bar_percent} * n)
        OR 100 * shouts > {p.shout_percent} * n OR 100 * bars >= {p.bar_percent} * n
        OR (n >= {p.unbroken_words} AND NOT regexp_matches(line, '[.!?:;,"]'))
        OR 100 * stutters > {p.stutter_percent} * n OR {phrases} AS fails FROM worded),
lost AS (SELECT r, sum(chars) AS total, coalesce(sum(chars) FILTER (fails), 0) AS lost FROM judged GROUP BY r),
repeats AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY r),
grams AS (
    SELECT r, pos, array_to_string(w[pos:pos + 7], ' ') AS gram
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS pos FROM docs WHERE len(w) >= 8)),
again AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT word) AS n_repeat_words FROM (SELECT r, unnest(range(pos, pos + 8)) AS word FROM again) GROUP BY r),
figures AS (
    SELECT doc_id, r, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(total, 0) AS total
    FROM docs LEFT JOIN repeats USING (r) LEFT JOIN repeated USING (r) LEFT JOIN lost USING (r)),
decided AS (SELECT *, n_words < {p.min_words} OR 100 * n_repeat_words > {p.repeat_percent} * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * lost <= {p.lost_percent} * total AS kept FROM decided"""


def _op10() -> str:
    m = Mix()
    weights = ", ".join(map(str, m.weights))
    return f"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_BLANK}))::BIGINT AS size,
        (('0x' || substr(md5({_quoted(m.seed + ":")} || coalesce(doc_id::VARCHAR, 'null:' || text, 'null')), 1, 13))::UBIGINT::DOUBLE + 0.5)
            / {float(1 << 52)} AS u FROM documents),
sources AS (
    SELECT source, sum(size)::HUGEINT AS s, count(*) AS n, [{weights}][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(m.weights)} + 1)::INT] AS weight
    FROM docs GROUP BY source),
-- The share of a unit of weight is the largest that some set of stopping sources leaves for the others.
tried AS (
    SELECT a.source, a.s, a.weight, sum(b.s) FILTER (3 * b.s * a.weight < 3 * a.s * b.weight) AS below,
        sum(b.weight) FILTER (3 * b.s * a.weight < 3 * a.s * b.weight) AS below_weight
    FROM sources a, sources b GROUP BY ALL),
whole AS (SELECT sum(s) AS s, sum(weight) AS weight FROM sources),
fitting AS (
    SELECT whole.s - {m.most} * coalesce(below, 0) AS rest, whole.weight - coalesce(below_weight, 0) AS rest_weight
    FROM tried, whole
    WHERE {m.most} * tried.s * (whole.weight - coalesce(below_weight, 0)) >= (whole.s - {m.most} * coalesce(below, 0)) * tried.weight),
share AS (SELECT max(rest) AS rest, max(rest_weight) AS rest_weight FROM fitting),
targets AS (
    SELECT source, s::BIGINT AS source_size, n AS source_rows,
        CASE WHEN {m.most} * s * share.rest_weight < share.rest * weight THEN ({m.most} * s)::DOUBLE
            ELSE weight::DOUBLE * share.rest::DOUBLE / share.rest_weight::DOUBLE END AS target
    FROM sources, share),
due AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {m.most}) ELSE 0 END::BIGINT AS certain FROM targets),
-- Odds of a document against one of its source's mean size; what a source's documents have in common does not order them.
chances AS (
    SELECT docs.*, source_size, target, certain, u / (1.0::DOUBLE - u) / CASE WHEN source_size > 0 THEN
        least(greatest(size * source_rows::DOUBLE / source_size::DOUBLE, {1 / m.spread}::DOUBLE), {m.spread}::DOUBLE) ELSE 1 END AS chance
    FROM docs JOIN due ON docs.source IS NOT DISTINCT FROM due.source),
ranked AS (
    SELECT doc_id, size, source_size, target, certain, target - certain * source_size AS rest,
        coalesce(sum(size) OVER (PARTITION BY source ORDER BY chance, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM chances)
SELECT doc_id, size, source_size, target,
    (size * (certain + CASE WHEN before + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM ranked"""



def _op11() -> str:
    template = Template()
    controls = "|".join([r"\\", *[re.escape(c) for c in template.controls]])

    def escaped(text: str) -> str:
        return f"length({text}) + len(regexp_extract_all({text}, {_quoted(controls)}))"

    marks = len(template.begin + template.middle + template.end)
    order = "ORDER BY turn NULLS FIRST, role, text"
    learnt = " OR ".join(f"role = {_quoted(r)}" for r in template.learnt)
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
    coalesce(sum(length(text)) FILTER ({learnt}), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' {order}) FILTER ({learnt}), '')) AS loss_sha256,
    sum({marks} + {escaped("role")} + {escaped("text")})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""


ORACLES = {
    "op1_link_trust": _op1(),
    "op2_suffix_decontamination": _OP2,
    "op3_license_diagonals": _op3(),
    "op5_warc_zst": _OP5,
    "op6_fast_sketch_dedup": _OP6,
    "op8_line_quality": _op8(),
    "op10_pareto_mix": _op10(),
    "op11_schema_chats": _op11(),
}
