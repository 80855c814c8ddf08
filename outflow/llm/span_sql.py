"""DuckDB SQL for the span operators (8 and 9)."""

from __future__ import annotations

from outflow.llm import pii, secrets


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _located(kind: str, rank: int, pattern: str) -> tuple[str, str]:
    """Columns of a kind's matches and of the text between them, and the spans they give."""
    columns = f"regexp_extract_all(t, {_quoted(pattern)}) AS h_{kind}, string_split_regex(t, {_quoted(pattern)}) AS g_{kind}"
    before = f"CAST(list_sum([length(x) for x in g_{kind}[1:i]]) + coalesce(list_sum([length(x) for x in h_{kind}[1:i - 1]]), 0) AS BIGINT)"
    spans = f"[struct_pack(s := {before}, r := {rank}, e := {before} + length(h_{kind}[i]), kind := '{kind}', v := h_{kind}[i]) for i in range(1, len(h_{kind}) + 1)]"
    return columns, spans


def _text(spans: str) -> str:
    return f"array_to_string([x.kind || ':' || x.s || ':' || x.e for x in {spans}], ',')"


def _count(kind: str, spans: str) -> str:
    return f"CAST(len([x for x in {spans} if x.kind = '{kind}']) AS BIGINT) AS n_{kind}"


def pii_sql() -> str:
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        "national": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    digits = "regexp_replace(x.v, '[^0-9]', '', 'g')"
    bare = "replace(x.v, ' ', '')"
    alone = "NOT regexp_matches(substr(t, x.s, 1), '{0}') AND NOT regexp_matches(substr(t, x.e + 1, 1), '{0}')"
    # The weighted digits of a card, last first; letters of an account number count from 10.
    luhn = f"list_sum([CASE WHEN i % 2 = 1 THEN CAST(reverse({digits})[i] AS INT) ELSE (CAST(reverse({digits})[i] AS INT) * 2) // 10 + (CAST(reverse({digits})[i] AS INT) * 2) % 10 END for i in range(1, length({digits}) + 1)]) % 10 = 0"
    turned = f"({bare}[5:] || {bare}[1:4])"
    number = f"array_to_string([CASE WHEN regexp_matches({turned}[i], '[0-9]') THEN {turned}[i] ELSE CAST(ascii({turned}[i]) - 55 AS VARCHAR) END for i in range(1, length({bare}) + 1)], '')"
    good = {
        "email": "true",
        "ip": "len([p for p in string_split(x.v, '.') if length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INT) > 255]) = 0",
        "card": f"length({digits}) BETWEEN 12 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"length({bare}) BETWEEN 15 AND 34 AND {alone.format('[A-Za-z0-9]')} AND list_reduce([CAST(d AS INT) for d in string_split({number}, '')], lambda a, d: (a * 10 + d) % 97) = 1",
        "national": f"{alone.format('[0-9-]')} AND NOT regexp_matches(x.v, '^(000|666|9)') AND NOT regexp_matches(x.v, '^...-00|0000$')",
    }
    kinds = list(patterns)
    located = {k: _located(k, i, patterns[k]) for i, k in enumerate(kinds)}
    near = "lower(substr(t, greatest(x.s - 40, 0) + 1, least(x.s, 40)))"
    score = " ".join(f"WHEN '{k}' THEN {pii.SCORES[k]} + CASE WHEN regexp_matches({near}, '(^|[^a-z])({pii.CONTEXT_WORDS[k]})') THEN {pii.BONUS} ELSE 0.0 END" for k in kinds)
    spans = ", ".join(f"[x for x in {located[k][1]} if {good[k]}] AS s_{k}" for k in kinds)
    base = "list_sort(s_email || s_ip || s_card || s_phone)"
    every = "list_sort(s_email || s_ip || s_card || s_phone || s_iban || s_national)"
    rated = f"[struct_pack(s := x.s, e := x.e, kind := x.kind, score := least(1.0, CASE x.kind {score} END)) for x in {every}]"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, t, {', '.join(located[k][0] for k in kinds)} FROM d),
s AS (SELECT doc_id, t, {spans} FROM m),
b AS (SELECT doc_id, {base} AS base, {rated} AS rated FROM s),
k AS (SELECT doc_id, base, [x for x in rated if x.kind IN ('email', 'ip', 'card', 'phone') OR x.score >= {pii.ACCEPT}] AS every FROM b)
SELECT doc_id, {', '.join(_count(k, 'base') for k in pii.BASE_KINDS)}, sha256({_text('base')}) AS base_sha256, {_text('every')} AS spans,
  CAST(len([x for x in every if x.score >= 0.9]) AS BIGINT) AS n_certain FROM k"""


def secrets_sql() -> str:
    assign = secrets.ASSIGN
    patterns = {
        "assign": assign,
        "access": "AKIA[A-Z0-9]{16,}",
        "hex": "[0-9a-f]{24,}",
        "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
        "key": secrets.KEY,
        "forge": "gh[opsru]_[A-Za-z0-9]{30,}",
    }
    value = f"CASE WHEN x.kind = 'assign' THEN regexp_extract(x.v, {_quoted(assign)}, 2) ELSE x.v END"
    good = {k: "true" for k in patterns} | {
        "assign": f"length(regexp_extract(x.v, {_quoted(assign)}, 2)) >= 6",
        "jwt": "NOT regexp_matches(substr(t, x.s, 1), '[A-Za-z0-9_-]')",
        "forge": "NOT regexp_matches(substr(t, x.s, 1), '[A-Za-z0-9_]')",
    }
    kinds = list(patterns)
    located = {k: _located(k, i, patterns[k]) for i, k in enumerate(kinds)}
    spans = ", ".join(f"[x for x in {located[k][1]} if {good[k]}] AS s_{k}" for k in kinds)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '?') AS owner, coalesce(source, '?') || '/' || coalesce(lang, '?') AS repository FROM documents),
m AS (SELECT doc_id, t, owner, repository, {', '.join(located[k][0] for k in kinds)} FROM d),
s AS (SELECT doc_id, t, owner, repository, {spans} FROM m),
b AS (SELECT doc_id, owner, repository, list_sort(s_assign || s_access || s_hex) AS base, list_sort(s_assign || s_access || s_hex || s_jwt || s_key || s_forge) AS every FROM s),
c AS (SELECT doc_id, owner, repository, unnest([{value} for x in every]) AS v, unnest(range(1, len(every) + 1)) AS place FROM b),
o AS (SELECT v, count(DISTINCT owner) AS n_owners, count(DISTINCT repository) AS n_repositories FROM c GROUP BY v),
j AS (SELECT doc_id, place, CASE WHEN n_owners >= {secrets.EXAMPLE_OWNERS} OR (n_owners = 2 AND n_repositories >= {secrets.EXAMPLE_REPOSITORIES}) THEN 'example'
  WHEN n_owners = 1 AND n_repositories > {secrets.LIVE_REPOSITORIES} THEN 'spread' WHEN n_owners = 1 AND len(list_distinct(string_split(c.v, ''))) >= {secrets.VARIED} THEN 'live' ELSE 'plain' END AS class FROM c JOIN o ON c.v = o.v),
k AS (SELECT doc_id, string_agg(class, ',' ORDER BY place) AS classes, count(*) FILTER (WHERE class = 'live') AS n_live, count(*) FILTER (WHERE class = 'example') AS n_example, count(*) FILTER (WHERE class = 'spread') AS n_spread FROM j GROUP BY doc_id)
SELECT b.doc_id, {', '.join(_count(k, 'base') for k in secrets.BASE_KINDS)}, sha256({_text('base')}) AS base_sha256, {_text('every')} AS spans, coalesce(classes, '') AS classes,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_spread, 0) AS n_spread
FROM b LEFT JOIN k ON b.doc_id = k.doc_id"""
