"""The queries that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

from marquee.llm import licences, mixing

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mixing_sql(margins: list[mixing.Margin], rate: float, cycles: int, seed: str) -> str:
    """Raking unrolled: one table per margin and cycle."""
    topics = " ".join(f"WHEN regexp_matches(coalesce(text, ''), {_quoted(p)}) THEN {_quoted(n)}" for n, p in mixing.TOPICS)
    keys = [f"k{i}" for i in range(len(margins))]
    key_list = ", ".join(keys)
    coded = ", ".join(f"coalesce('=' || {m.column}, '') AS {k}" for m, k in zip(margins, keys))
    parts = [
        f"d AS MATERIALIZED (SELECT doc_id, source, lang, CASE {topics} ELSE '{mixing.PROSE}' END AS topic, CAST(len({WORDS}) AS BIGINT) AS n_tokens FROM documents)",
        f"e AS MATERIALIZED (SELECT *, {coded} FROM d)",
        f"cells AS MATERIALIZED (SELECT {key_list}, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM e GROUP BY ALL)",
        "whole AS MATERIALIZED (SELECT sum(tokens) AS tokens FROM cells)",
    ]
    for i, (m, k) in enumerate(zip(margins, keys)):
        named = {("" if v is None else f"={v}"): s for v, s in m.shares.items()}
        share = "CASE " + " ".join(f"WHEN {k} = {_quoted(v)} THEN CAST({s!r} AS DOUBLE)" for v, s in named.items()) + " END" if named else "CAST(NULL AS DOUBLE)"
        rest = max(0.0, 1.0 - sum(named.values()))
        parts += [
            f"t{i} AS MATERIALIZED (SELECT {k}, {share} AS share, pow(CAST(sum(tokens) AS DOUBLE), {m.temper!r}) AS part FROM cells GROUP BY {k} HAVING sum(tokens) > 0)",
            f"s{i} AS MATERIALIZED (SELECT coalesce(sum(share), 0) AS fixed, coalesce(sum(part) FILTER (share IS NULL), 0) AS open FROM t{i})",
            f"""g{i} AS MATERIALIZED (SELECT {k}, coalesce(share, CASE WHEN open > 0 THEN part * {rest!r} / open ELSE 0 END)
                * {rate!r} * whole.tokens / (fixed + CASE WHEN open > 0 THEN {rest!r} ELSE 0 END) AS goal FROM t{i}, s{i}, whole)""",
        ]
    parts.append(f"w0 AS MATERIALIZED (SELECT {key_list}, tokens, tokens * {rate!r} AS weight FROM cells)")
    n = 0
    for _ in range(cycles):
        for i, k in enumerate(keys):
            scaled = "w.weight * CASE WHEN f.total > 0 THEN f.goal / f.total ELSE 0 END"
            if i == len(keys) - 1:
                scaled = f"least({scaled}, w.tokens)"
            own = ", ".join(f"w.{c}" for c in keys)
            parts.append(
                f"w{n + 1} AS MATERIALIZED (SELECT {own}, w.tokens, coalesce({scaled}, 0) AS weight FROM w{n} w LEFT JOIN "
                f"(SELECT a.{k}, sum(a.weight) AS total, any_value(g.goal) AS goal FROM w{n} a JOIN g{i} g ON a.{k} = g.{k} GROUP BY a.{k}) f ON w.{k} = f.{k})"
            )
            n += 1
    joined = " AND ".join(f"e.{k} = w.{k}" for k in keys)
    chance = "CASE WHEN w.tokens > 0 THEN w.weight / w.tokens ELSE 0 END"
    drawn = f"CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"
    return f"""WITH {', '.join(parts)}
SELECT doc_id, source, lang, topic, n_tokens, round({chance}, 6) AS chance, ({drawn}) < {chance} AS sampled
FROM e JOIN w{n} w ON {joined}"""


def licences_sql() -> str:
    """Known sentences compared at the place of each piece; those inside a longer one go."""
    known = ", ".join(f"({_quoted(s)}, '{letter}')" for s, letter in licences.known_sentences().items())
    held = " OR ".join(f"contains(low, {_quoted(a.split()[-1])})" for a in licences.ANCHORS)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    matches = ", ".join(f"CASE WHEN regexp_matches(code, {_quoted(licences.pattern(rule))}) THEN {_quoted(name)} END" for name, rule in licences.RULES)
    marked = "low"
    for old, new in [
        (r"\r\n?", "\n"), (r"(^|\n)[^a-z0-9\n]+", r"\1"), (licences.SENTENCE_END, " Y "), (r"\n{2,}", " Y "), (r"\n", " Z "),
        (r"[^a-z0-9./+YZ-]+", " "), (r"[ ./+Z-]*Y[ ./+YZ-]*", "Y"), (r"[ ./+-]*Z[ ./+Z-]*", "Z"), (licences.EDGES, ""),
    ]:
        marked = f"regexp_replace({marked}, {_quoted(old)}, {_quoted(new)}, 'g')"
    return f"""WITH known(sentence, letter) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS low FROM documents),
m AS MATERIALIZED (SELECT row, {marked} AS marked FROM d WHERE {held}),
cut AS (SELECT row, string_split_regex(marked, '[YZ]') AS texts, regexp_extract_all(marked, '[YZ]') AS signs FROM m WHERE marked <> ''),
lone AS (SELECT row, unnest(texts) AS text, unnest(list_append(signs, '')) AS sign, generate_subscripts(texts, 1) AS place FROM cut),
piece AS MATERIALIZED (
  SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY row ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         lag(sign) OVER (PARTITION BY row ORDER BY place) AS before,
         string_agg(text || sign, '') OVER (PARTITION BY row ORDER BY place ROWS BETWEEN CURRENT ROW AND 40 FOLLOWING) AS ahead FROM lone),
hit AS (
  SELECT row, place, start, start + length(sentence) AS stop, letter FROM piece JOIN known
    ON split_part(text, ' ', 1) = split_part(sentence, ' ', 1)
   AND translate(substr(ahead, 1, length(sentence)), 'YZ', '| ') = sentence
   AND substr(ahead, length(sentence) + 1, 1) IN ('', 'Y', 'Z')
  QUALIFY row_number() OVER (PARTITION BY row, place ORDER BY length(sentence) DESC) = 1),
kept AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.row = h.row AND o.start < h.start AND h.start < o.stop)),
free AS (
  SELECT p.row, p.place, p.before FROM piece p
  WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.row = p.row AND k.start <= p.start AND p.start < k.stop)),
other AS (
  SELECT row, place, '.' AS letter FROM free f
  WHERE NOT (before = 'Z' AND EXISTS (SELECT 1 FROM free e WHERE e.row = f.row AND e.place = f.place - 1))),
coded AS (
  SELECT row, string_agg(letter, '' ORDER BY place) AS code
  FROM (SELECT row, place, letter FROM kept UNION ALL SELECT row, place, letter FROM other) GROUP BY row),
found AS (SELECT row, code, list_filter([{matches}], lambda x: x IS NOT NULL) AS names FROM coded),
named AS (
  SELECT row, replace(code, '.', '') AS code,
         nullif(array_to_string(list_filter(names, lambda x, k: list_position(names, x) = k), ','), '') AS names FROM found)
SELECT d.doc_id, coalesce(code, '') AS sentence_ids, nullif(split_part(coalesce(names, ''), ',', 1), '') AS licence, names AS licences
FROM d LEFT JOIN named ON d.row = named.row"""


def quality_sql() -> str:
    """All rules for all documents; windows counted as rows."""
    gaps = r"'[^\x20\x09-\x0D]'"
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM d WHERE len(w) > 2),
trio AS (SELECT doc_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM win),
twice AS (SELECT doc_id, p FROM trio QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {gaps})) AS ls FROM d),
m AS (
  SELECT d.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d JOIN lines ON d.doc_id = lines.doc_id LEFT JOIN covered ON d.doc_id = covered.doc_id),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         20 * n_symbols > length(t)
         OR 10 * length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) > 3 * length(regexp_replace(t, '[^\\p{{L}}]', '', 'g'))
         OR 12 * (length(t) - length(replace(t, '!', ''))) > length(t)
         OR 2 * (length(t) - length(translate(t, '0123456789', ''))) > length(t)
         OR length(t) > 40 * (1 + length(t) - word_chars)
         OR NOT regexp_matches(t, '\\p{{L}}') AS rejected
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM f"""


def fill_in_middle_sql(seed: int, fim_rate: int, spm_rate: int) -> str:
    """Units as a list; what they hold by their lengths."""
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    group = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
    h1, h2, h3, h4 = (group.format(8 * k + 1) for k in range(4))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '{unit}') AS units FROM d),
c AS (SELECT *, CAST(len(units) AS BIGINT) AS n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h3} % 100 >= {fim_rate} THEN 'plain'
        WHEN {h4} % 100 < {spm_rate} THEN 'spm' ELSE 'psm' END AS form,
    {h1} % (len(units) + 1) AS a, {h2} % (len(units) + 1) AS b FROM u),
p AS (SELECT doc_id, t, n, form,
    CAST(coalesce(list_sum(list_transform(units[1:least(a, b)], lambda x: length(x))), 0) AS BIGINT) AS before,
    CAST(coalesce(list_sum(list_transform(units[1:greatest(a, b)], lambda x: length(x))), 0) AS BIGINT) AS after FROM c),
s AS (SELECT *, substr(t, 1, before) AS prefix, substr(t, before + 1, after - before) AS middle, substr(t, after + 1) AS suffix FROM p)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN before END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN after - before END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
    sha256(prefix || middle || suffix) AS restored_sha256
FROM s"""
