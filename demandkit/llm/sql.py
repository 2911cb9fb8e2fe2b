"""DuckDB forms of the operators that SQL can express, written independently of
the Spark plans: whole tables, recursive common table expressions."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _case(rules, what) -> str:
    order = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.verdict != "block"))
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{what(r)}'"
        for r in order) + " END"


def url_filter(rules, damping: float, steps: int, block_share: float) -> str:
    parts = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    link = (r"""'(?i)\bhref[ \t\r\n\f]*=[ \t\r\n\f]*["'']?[ \t\r\n\f]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''<> \t\r\n\f]+)'""")
    verdict = _case(rules, lambda r: r.verdict)
    return f"""
    WITH RECURSIVE p AS (
        SELECT page_id, translate(coalesce(regexp_extract(url, {parts}, 1), ''), {_AZ}) AS host,
               coalesce(regexp_extract(url, {parts}, 2), '') AS path, html FROM pages),
    r AS (SELECT page_id, host, path, {_case(rules, lambda r: r.host + r.path)} AS rule, {verdict} AS ruled FROM p),
    own AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE ruled = 'allow') AS allowed,
                   count(*) FILTER (WHERE ruled = 'block') AS blocked FROM r WHERE host <> '' GROUP BY host),
    links AS (SELECT src, translate(dst, {_AZ}) AS dst FROM (
                  SELECT host AS src, unnest(regexp_extract_all(html, {link}, 1)) AS dst FROM p WHERE host <> '')),
    site AS (SELECT c.host AS src, d.host AS dst FROM own c JOIN own d ON regexp_extract(c.host, '^[^.]*\\.(.*)$', 1) = d.host),
    edges AS (SELECT src, dst, count(*) AS weight FROM (
                  SELECT src, dst FROM links WHERE src <> dst UNION ALL SELECT src, dst FROM site UNION ALL SELECT dst, src FROM site)
              GROUP BY src, dst),
    arcs AS (SELECT 0 AS kind, src AS a, dst AS b, weight / sum(weight) OVER (PARTITION BY src) AS share FROM edges
             UNION ALL SELECT 1, dst, src, weight / sum(weight) OVER (PARTITION BY dst) FROM edges),
    others AS (SELECT host, 1 AS n, CASE WHEN {verdict} = 'allow' THEN 1 ELSE 0 END AS allowed,
                      CASE WHEN {verdict} = 'block' THEN 1 ELSE 0 END AS blocked
               FROM (SELECT DISTINCT dst AS host, '/' AS path FROM edges WHERE dst NOT IN (SELECT host FROM own))),
    hosts AS (SELECT * FROM own UNION ALL SELECT * FROM others),
    seeds AS (SELECT 0 AS kind, host, allowed / n AS seed FROM hosts UNION ALL SELECT 1, host, blocked / n FROM hosts),
    walk(step, kind, host, seeded, whole) AS (
        SELECT 0, kind, host, CAST({1 - damping} * seed AS DOUBLE), CAST({1 - damping} AS DOUBLE) FROM seeds
        UNION ALL
        SELECT step + 1, kind, host, sum(seeded), sum(whole) FROM (
            SELECT w.step, a.kind, a.b AS host, w.seeded * a.share * {damping} AS seeded, w.whole * a.share * {damping} AS whole
            FROM walk w JOIN arcs a ON a.kind = w.kind AND a.a = w.host
            UNION ALL
            SELECT w.step, s.kind, s.host, {1 - damping} * s.seed, {1 - damping} FROM walk w JOIN seeds s ON s.kind = w.kind AND s.host = w.host)
        WHERE step < {steps} GROUP BY step, kind, host),
    share AS (SELECT kind, host, round(seeded / whole, 9) AS share FROM walk WHERE step = {steps}),
    judged AS (SELECT host, max(share) FILTER (WHERE kind = 0) AS trust, max(share) FILTER (WHERE kind = 1) AS distrust FROM share GROUP BY host)
    SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN distrust >= {block_share} AND distrust > trust THEN 'block' END, 'allow') AS verdict
    FROM r LEFT JOIN judged j ON r.host = j.host"""


def _plus(value: str, cost: str, letter: str) -> str:
    """A cost of nine digits before an audit: more cost, one letter in front."""
    return f"(lpad(CAST(CAST(left({value}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({value}, 10))"


def conversation_repair() -> str:
    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384)))"""
    grammar = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    given = (2, 2, 3, 2)
    broken = "(CASE WHEN sign = upper(sign) THEN 3 ELSE 0 END)"
    before = []
    for q in range(4):
        keep = " ".join(f"WHEN lower(sign) = '{r}' THEN {_plus(f'v{to}', broken, 'K')}" for r, to in grammar[q].items())
        role = _plus(f"v{given[q]}", f"3 + {broken}", "R")
        before.append(f"CASE WHEN sign = 'x' THEN {_plus(f'v{q}', '4', 'D')} ELSE least({_plus(f'v{q}', '4', 'D')}, {role}, "
                      f"CASE {keep} ELSE {role} END) END AS b{q}")
    after = []
    for q in range(4):
        one, two = given[q], given[given[q]]
        after.append(f"least(b{q}, {_plus(f'b{one}', '3', 'I')}, {_plus(_plus(f'b{two}', '3', 'I'), '3', 'I')})")
    return f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    hit AS (SELECT *, xor({crc}, 4294967295) % 20 AS kind FROM keyed),
    rows AS (SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
             FROM hit, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS pos,
                      NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
                      right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS broken,
                      CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS initial FROM rows),
    faults AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS again FROM placed),
    signed AS (SELECT *, NOT blank AND NOT again AND broken AS cut, lag(initial) OVER (PARTITION BY conv ORDER BY pos) || initial AS pair,
                      CASE WHEN blank OR again THEN 'x' WHEN broken THEN upper(initial) ELSE initial END AS sign FROM faults),
    numbers AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
                       count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
                       count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM signed GROUP BY conv),
    togo(conv, pos, v0, v1, v2, v3) AS (
        SELECT conv, n + 1, '000000000', '000000006II', '000000003I', '000000000' FROM numbers
        UNION ALL
        SELECT conv, pos, {', '.join(after)} FROM (
            SELECT s.conv, s.pos, {', '.join(before)} FROM togo t JOIN signed s ON s.conv = t.conv AND s.pos = t.pos - 1)),
    audits AS (SELECT conv, CAST(left(v0, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM togo WHERE pos = 1),
    letters AS (SELECT conv, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS i
                FROM audits WHERE audit <> ''),
    counted AS (SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS row_pos, count(*) FILTER (WHERE letter <> 'D') OVER w AS out_pos
                FROM letters WINDOW w AS (PARTITION BY conv ORDER BY i)),
    met AS (SELECT c.*, s.role, s.text, s.initial FROM counted c LEFT JOIN signed s ON s.conv = c.conv AND s.pos = c.row_pos AND c.letter <> 'I'
            WHERE letter <> 'D'),
    opened AS (SELECT *, first_value(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY i) AS lead FROM met),
    texts AS (SELECT conv, sha256(string_agg(
                  CASE WHEN letter = 'K' THEN role WHEN (out_pos - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
                  || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS repaired_sha256 FROM opened GROUP BY conv)
    SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
           coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, conv FROM keyed) k LEFT JOIN numbers n ON n.conv = k.conv LEFT JOIN audits a ON a.conv = k.conv
    LEFT JOIN texts t ON t.conv = k.conv"""
