"""DuckDB SQL of the training-data queries that SQL can express.

Operators 3, 5 and 11 (tokenizer ids) and 7 (a fitted model) are beyond SQL;
they and 8 are tested against the libraries or brute force.
"""

from __future__ import annotations

from tradeflow.llm.license_scan import GRAM, LEAST_SHARE, NEAR, TEMPLATES
from tradeflow.llm.quality_rules import RULES, STOP_WORDS

# A regular expression class of white space, and words by it.
_SPACE = r"[ \t\n\x0b\f\r]"
_WORDS = r"[^ \t\n\x0b\f\r]+"


def _quality_sql() -> str:
    stop = ", ".join(f"'{form}'" for w in STOP_WORDS for form in sorted({w, w.capitalize()}))
    checks = []
    for rule in RULES:
        if rule.minimum is not None:
            checks.append(f"{rule.metric} >= {rule.minimum}")
        if rule.maximum is not None:
            checks.append(f"{rule.metric} <= {rule.maximum}")
    return f"""
    WITH d AS (
        SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents
    ), s AS (
        SELECT *, regexp_extract_all(text, '{_WORDS}') AS words,
            list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORDS}')) AS lines
        FROM d
    ), w AS (
        SELECT uid, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS gram
        FROM (SELECT uid, words, unnest(range(1, len(words) - 6)) AS i FROM s)
    ), twice AS (
        SELECT uid, i FROM (SELECT uid, i, count(*) OVER (PARTITION BY uid, gram) AS n FROM w) WHERE n > 1
    ), r AS (
        SELECT uid, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT uid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY uid
    ), m AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words, words, lines,
            length(text) - length(replace(text, '!', '')) AS bangs
        FROM s LEFT JOIN r USING (uid)
    ), q AS (
        SELECT *,
            n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            word_chars / greatest(n_words, 1) AS mean_word_chars,
            n_symbols / greatest(n_words, 1) AS symbol_ratio,
            len(list_filter(words, lambda x: x IN ({stop}))) / greatest(n_words, 1) AS stop_ratio,
            bangs / greatest(n_words, 1) AS exclamation_ratio,
            len(list_distinct(words)) / greatest(n_words, 1) AS distinct_ratio,
            n_dup_lines / greatest(len(lines), 1) AS dup_line_ratio,
            len(list_filter(lines, lambda x: rtrim(x, ' ') LIKE '%...')) / greatest(len(lines), 1) AS ellipsis_line_ratio
        FROM m
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND {' AND '.join(checks)} AS kept
    FROM q
    """


def _codes_sql(rounds: int = 4) -> str:
    """Assignment and update of every round spelled out over (row, part, place) rows; exact in wide integers."""
    assign = """
    a{r} AS MATERIALIZED (
        SELECT id, part, arg_min(entry, (away, entry)) AS entry, min(away) AS away
        FROM (SELECT x.id, x.part, e.entry, sum((x.v - e.v) * (x.v - e.v)) AS away
              FROM x JOIN e{r} e ON e.part = x.part AND e.place = x.place GROUP BY ALL)
        GROUP BY id, part
    )"""
    update = """
    e{s} AS MATERIALIZED (
        SELECT e.part, e.entry, e.place, coalesce(CAST(floor(m.total / m.n) AS BIGINT)
            - CASE WHEN CAST(floor(m.total / m.n) AS BIGINT) * m.n > m.total THEN 1 ELSE 0 END, e.v) AS v
        FROM e{r} e LEFT JOIN (
            SELECT a.part, a.entry, x.place, sum(x.v) AS total, count(*) AS n
            FROM a{r} a JOIN x ON x.id = a.id AND x.part = a.part GROUP BY ALL) m
        ON m.part = e.part AND m.entry = e.entry AND m.place = e.place
    )"""
    steps = []
    for r in range(rounds):
        steps += [assign.format(r=r), update.format(r=r, s=r + 1)]
    steps.append(assign.format(r=rounds))
    return f"""
    WITH kept AS (
        SELECT vec_id AS id, label, embedding FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    ), long AS (
        SELECT id, unnest(embedding) AS v, unnest(range(len(embedding))) AS i, len(embedding) // 4 AS width FROM kept
    ), x AS MATERIALIZED (
        SELECT id, i // width AS part, i % width AS place, CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT) AS v FROM long
    ), e0 AS MATERIALIZED (
        SELECT x.part, f.entry, x.place, x.v FROM x JOIN (
            SELECT id, row_number() OVER (ORDER BY id) - 1 AS entry FROM kept ORDER BY id LIMIT 256) f USING (id)
    ), {', '.join(steps)}, books AS (
        SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS digest FROM e{rounds}
    ), coded AS (
        SELECT id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(away) AS BIGINT) AS error
        FROM a{rounds} GROUP BY id
    )
    SELECT kept.id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT digest FROM books) AS codebooks_sha256
    FROM coded JOIN kept USING (id)
    """


def _license_sql() -> str:
    rows = []
    for t, template in enumerate(TEMPLATES):
        words = template.text.split()
        grams = [" ".join(words[i:i + GRAM]) for i in range(len(words) - GRAM + 1)]
        rows += [f"({t}, '{template.label}', {template.exact}, {i}, '{gram}', {len(grams)})" for i, gram in enumerate(grams)]
    return rf"""
    WITH t(template, label, exact, place, gram, grams) AS (VALUES {', '.join(rows)}
    ), d AS (
        SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), g AS (
        SELECT uid, i - 1 AS pos, list_aggregate(words[i:i + {GRAM - 1}], 'string_agg', ' ') AS gram
        FROM (SELECT uid, words, unnest(range(1, len(words) - {GRAM - 2})) AS i FROM d)
    ), v AS (
        SELECT uid, template, label, exact, grams, place, pos, pos - place AS diagonal FROM g JOIN t USING (gram)
    ), n AS (
        SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER w > {NEAR}, true) THEN 1 ELSE 0 END AS begins
        FROM (SELECT DISTINCT uid, template, exact, diagonal FROM v) WINDOW w AS (PARTITION BY uid, template ORDER BY diagonal)
    ), p AS (
        SELECT uid, template, diagonal, sum(begins) OVER (PARTITION BY uid, template ORDER BY diagonal) AS passage FROM n
    ), m AS (
        SELECT uid, template, passage, any_value(label) AS label, any_value(exact) AS exact,
            count(DISTINCT place) / any_value(grams) AS share, min(pos) AS first, max(pos) - min(pos) + 1 AS room, any_value(grams) AS grams
        FROM v JOIN p USING (uid, template, diagonal) GROUP BY ALL
    ), f AS (
        SELECT * FROM m WHERE CASE WHEN exact THEN share = 1 ELSE share >= {LEAST_SHARE} AND room <= 2 * grams END
    )
    SELECT any_value(doc_id) AS doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words, count(*) FILTER (WHERE exact) AS n_base,
        CAST(min(first) FILTER (WHERE exact) AS BIGINT) AS first_word, CAST(max(first) FILTER (WHERE exact) AS BIGINT) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact), '') AS base_labels,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, CAST(coalesce(max(share), 0) AS DOUBLE) AS score
    FROM d LEFT JOIN f USING (uid) GROUP BY uid
    """


SQL: dict[str, str] = {
    "op1_quality_rules": _quality_sql(),
    "op2_chat_format": r"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(32 + length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'))
            + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
    """,
    "op4_jaccard_join": rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '{_WORDS}') AS words
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS shingle
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
    ), n AS (
        SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), p AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), l AS (
        SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.n + b.n - shared)
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM w
        UNION
        SELECT reach.doc_id, l.y FROM reach JOIN l ON reach.other = l.x
    )
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY ALL
    """,
    "op6_url_filter": r"""
    WITH u AS (
        SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
        FROM pages
    ), rules(verdict, h, p) AS (
        VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
    ), fits AS (
        SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
        FROM u JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits USING (page_id)
    """,
    "op9_license_scan": _license_sql(),
    "op10_mixing": rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS size,
            md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
        FROM d GROUP BY source
    ), o AS (
        SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE) AS rest,
            CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS others,
            row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place
        FROM s WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), f AS (
        SELECT min(place) AS place FROM o WHERE 3 * source_size * others > weight * rest
    ), t AS (
        SELECT o.source, o.source_size,
            CASE WHEN f.place IS NULL OR o.place < f.place THEN CAST(3 * o.source_size AS DOUBLE) ELSE o.weight * free.rest / free.others END AS target
        FROM o CROSS JOIN f LEFT JOIN o free ON free.place = f.place
    ), r AS (
        SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
            coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
        CASE WHEN source_size = 0 THEN 0 ELSE CAST(budget // source_size * size
            + greatest(least(budget - budget // source_size * source_size - ahead, size), 0) AS BIGINT) END AS taken
    FROM r
    """,
    "op12_vector_codes": _codes_sql(),
    "op13_source_divergence": r"""
    WITH d AS (
        SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), t AS (
        SELECT uid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ), kept AS (
        SELECT lang, term, count(*) AS lang_count FROM t GROUP BY lang, term HAVING count(DISTINCT uid) >= 3
    ), ln AS (
        SELECT lang, count(*) AS v, sum(lang_count) AS n FROM kept GROUP BY lang
    ), c AS (
        SELECT lang, source, term, count(*) AS times FROM t JOIN kept USING (lang, term) GROUP BY ALL
    ), g AS (
        SELECT d.lang, d.source, coalesce(any_value(ln.v), 0) AS v, coalesce(any_value(ln.n), 0) AS lang_n
        FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN ln USING (lang) GROUP BY ALL
    ), gn AS (
        SELECT g.*, coalesce((SELECT sum(times) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) AS n FROM g
    ), p AS (
        SELECT gn.lang, gn.source, kept.term, coalesce(c.times, 0) AS times,
            1 + (1000000000::HUGEINT * (coalesce(c.times, 0) + 1)) // (gn.n + gn.v) AS p,
            1 + (1000000000::HUGEINT * (kept.lang_count + 1)) // (gn.lang_n + gn.v) AS q
        FROM gn JOIN kept USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), every AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pairs.value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE times > 0 AND p > q
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
}
