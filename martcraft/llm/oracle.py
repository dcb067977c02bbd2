"""DuckDB SQL of the operators that SQL can express, with the parameters of
their queries."""

from __future__ import annotations

import re

from martcraft.llm.chat import Template
from martcraft.llm.negatives import MiningRules
from martcraft.llm.quality import RATIOS, SKETCH_BITS, QualityRules
from martcraft.llm.topk import SearchRules

WORD = r"[^\x20\x09-\x0D]"


def quality_sql(rules: QualityRules = QualityRules()) -> str:
    ratio = {n: f"(CASE WHEN {d} = 0 THEN 0 ELSE {s} * {u} // {d} END)" for n, (u, d, s) in RATIOS.items()}
    base = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    drop = f"greatest(0, length(bin(v)) - {SKETCH_BITS})"
    entries = "\n    UNION ALL ".join(f"SELECT lang, source, '{n}' AS ratio, {r} AS v FROM counted WHERE NOT {base}" for n, r in ratio.items())
    levels = "\n    UNION ALL ".join(
        f"SELECT {i} AS level, {lang} AS lang, {source} AS source, ratio, bin, COUNT(*) AS n FROM binned GROUP BY ALL"
        for i, (lang, source) in enumerate((("lang", "source"), ("lang", "NULL"), ("NULL", "NULL"))))
    of = lambda k: f"CAST(CASE ratio {' '.join(f'WHEN {f[0]!r} THEN {f[k]}' for f in rules.fences)} END AS DOUBLE)"
    at = lambda k: f"MIN(bin) FILTER (WHERE c >= ceil(total * {of(k)}))"
    prior = f"{rules.prior}::DOUBLE"
    blend = lambda t, own, above: f"(({t}.n::DOUBLE * {own} + {prior} * {above}) / ({t}.n::DOUBLE + {prior}))"
    chosen = ",\n           ".join(blend("a", f'a."{n}"', blend("b", f'b."{n}"', f'c."{n}"')) + f" AS max_{n}" for n in RATIOS)
    per_level = ", ".join(f"MAX(top) FILTER (WHERE ratio = '{n}') AS \"{n}\"" for n in RATIOS)
    over = " OR ".join(f"coalesce({ratio[n]} > max_{n}, FALSE)" for n in RATIOS)
    return rf"""
WITH texts AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{WORD}+') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
    FROM documents
), windows AS (
    SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
    FROM texts, unnest(range(1, len(ws) - 1)) u(i)
), again AS (
    SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, w) AS times FROM windows
), covered AS (
    SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE times > 1) GROUP BY doc_id
), counted AS (
    SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
           CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM texts LEFT JOIN covered USING (doc_id)
), entries AS (
    {entries}
), binned AS (
    SELECT lang, source, ratio, (v >> {drop}) << {drop} AS bin FROM entries
), sketches AS (
    {levels}
), summed AS (
    SELECT *, SUM(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bin) AS c,
           SUM(n) OVER (PARTITION BY level, lang, source, ratio) AS total FROM sketches
), cuts AS (
    SELECT level, lang, source, ratio, MAX(total) AS n, {at(1)} AS mid, {at(2)} AS high FROM summed GROUP BY ALL
), tops AS (
    SELECT *, high + {of(3)} * (high - mid) + {of(4)} AS top FROM cuts
), limits AS (
    SELECT level, lang, source, MAX(n) AS n, {per_level} FROM tops GROUP BY level, lang, source
), fences AS (
    SELECT a.lang, a.source, {chosen}
    FROM (FROM limits WHERE level = 0) a
         LEFT JOIN (FROM limits WHERE level = 1) b ON a.lang IS NOT DISTINCT FROM b.lang
         LEFT JOIN (FROM limits WHERE level = 2) c ON TRUE
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {base} AS base_failed, NOT {base} AND NOT ({over}) AS kept,
       {', '.join(f'CAST({ratio[n]} AS BIGINT) AS ratio_{n}' for n in RATIOS)}, {', '.join(f'max_{n}' for n in RATIOS)}
FROM counted LEFT JOIN fences f ON counted.lang IS NOT DISTINCT FROM f.lang AND counted.source IS NOT DISTINCT FROM f.source"""


def top_k_sql(step: int, rules: SearchRules = SearchRules()) -> str:
    """Brute force; the test tables' vectors are all finite and of one length."""
    return f"""
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % {step} = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {rules.k}"""


def chat_sql(template: Template = Template()) -> str:
    """The digests from the rows themselves; the formatted length from the
    marks and one character an escape."""
    by_role = lambda value, other: f"CASE role {' '.join(f'WHEN {r.name!r} THEN {value(r)}' for r in template.roles)} ELSE {other} END"
    mark = "|".join(re.escape(m[0]) + r"\\*" + re.escape(m[1:]) for m in template.marks())
    grown = lambda c: f"length({c}) + len(regexp_extract_all({c}, '{mark}'))"
    marks = by_role(lambda r: len(r.open + r.close), f"{sum(map(len, template.other))} + {grown('role')}")
    learned = f"({by_role(lambda r: 'TRUE' if r.loss else 'FALSE', 'FALSE')})"
    legal = by_role(lambda r: f"before IN ({', '.join(map(repr, r.after))})", "FALSE")
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), seen AS (
    SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), '') AS before FROM turns
)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(SUM(length(text)) FILTER (WHERE {learned}), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE {learned}), '')) AS loss_sha256,
       CAST({len(template.begin)} + SUM({marks} + {grown('text')}) AS BIGINT) AS formatted_chars,
       bool_and({legal}) AS in_order
FROM seen GROUP BY conv_id"""


def negatives_sql(step: int, rules: MiningRules = MiningRules()) -> str:
    """Brute force; the test tables' vectors are all finite and of one length."""
    return f"""
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % {step} = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {rules.positives}
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
     AND 100 * n.score BETWEEN {rules.low} * p.score AND {rules.high} * p.score
QUALIFY rank <= {rules.negatives}"""
