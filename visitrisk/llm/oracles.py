"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from visitrisk.llm import urlfilter

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def decontamination() -> str:
    words = f"regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""WITH docs AS (SELECT doc_id, COALESCE({words}, []) AS w FROM documents),
items AS (SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
known AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS content FROM
  (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
runs AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS content FROM
  (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM known) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM runs JOIN known USING (n, content)),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items,
sha256(COALESCE(named, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def line_dedup(min_words: int = 50) -> str:
    """For document ids without repetition."""
    return f"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS line FROM split),
spoken AS (SELECT *, array_to_string(w, ' ') AS plain, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k,
  sum(len(w)) OVER (PARTITION BY doc_id ORDER BY line_no) AS upto
  FROM (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM lines) WHERE len(w) > 0),
runs AS (SELECT a.doc_id, a.k AS first, b.k AS last FROM spoken a JOIN spoken b
  ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + {min_words - 1} AND b.upto - a.upto + len(a.w) >= {min_words}),
spans AS (SELECT doc_id, first, min(last) AS last FROM runs GROUP BY doc_id, first UNION SELECT doc_id, max(first), last FROM runs GROUP BY doc_id, last),
windows AS (SELECT s.doc_id, s.first, min(l.line_no) AS from_line, max(l.line_no) AS to_line, string_agg(l.plain, chr(10) ORDER BY l.k) AS content
  FROM spans s JOIN spoken l ON s.doc_id = l.doc_id AND l.k BETWEEN s.first AND s.last GROUP BY s.doc_id, s.first, s.last),
later AS (SELECT * FROM windows QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(from_line, to_line + 1)) AS line_no FROM later),
kept AS (SELECT l.doc_id, count(g.line_no) AS cut, COALESCE(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.line_no IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no GROUP BY l.doc_id),
sizes AS (SELECT s.doc_id, count(*) AS n_lines, count(g.line_no) AS n_removed, COALESCE(sum(len(s.w)) FILTER (g.line_no IS NOT NULL), 0) AS removed_words
  FROM spoken s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.line_no = g.line_no GROUP BY s.doc_id)
SELECT d.doc_id, CASE WHEN COALESCE(k.cut, 0) > 0 THEN k.text ELSE d.text END AS text, CAST(COALESCE(n_lines, 0) AS BIGINT) AS n_lines,
CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(removed_words, 0) AS BIGINT) AS removed_words
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN sizes z ON d.doc_id = z.doc_id"""


def url_filter(rules: list[urlfilter.Rule]) -> str:
    rest = lambda url: f"(CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END)"
    host = lambda r: f"translate(regexp_extract({r}, '^[^/?#]*', 0), {_UPPER}, {_LOWER})"
    path = lambda r: f"regexp_extract({r}, '^[^/?#]*([^?#]*)', 1)"
    port = lambda url: f"regexp_replace({url}, '(?i)^(http://[^/?#]*):80([/?#]|$)|^(https://[^/?#]*):443([/?#]|$)', '\\1\\2\\3\\4')"
    node = lambda r: f"CASE WHEN {r} <> '' THEN concat({host(r)}, COALESCE(NULLIF({path(r)}, ''), '/'), regexp_extract({r}, '^[^?#]*(\\?[^#]*)', 1)) END"
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"

    def decided(of_host: str, of_path: str, value: int) -> str:
        longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
        cases = " ".join(f"WHEN ({of_host} = '{h}' OR ends_with({of_host}, '.{h}')) AND starts_with({of_path}, '{p}') THEN '{(v, h + p)[value]}'" for v, h, p in longest)
        return f"CASE {cases} END"

    def named(tag: str, mark: str, value: str) -> str:
        return f"SELECT page_id, p AS r, replace(regexp_extract(tag, {quoted(value)}, 1), '&amp;', '&') AS target FROM (SELECT page_id, p, unnest(regexp_extract_all(html, {quoted(tag)})) AS tag FROM own) WHERE regexp_matches(tag, {quoted(mark)})"

    return f"""WITH RECURSIVE own AS (SELECT page_id, html, {rest("COALESCE(url, '')")} AS r, {rest(port("COALESCE(url, '')"))} AS p FROM pages),
judged AS (SELECT page_id, {host("r")} AS host, {path("r")} AS path, {node("p")} AS node FROM own),
named AS ({named(urlfilter.LINK_TAG, urlfilter.CANONICAL, urlfilter.HREF)} UNION ALL {named(urlfilter.META_TAG, urlfilter.REFRESH, urlfilter.TARGET)}),
absolute AS (SELECT r, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {rest(port("target"))} WHEN starts_with(target, '//') THEN substr(target, 3)
  WHEN starts_with(target, '/') THEN concat(regexp_extract(r, '^[^/?#]*', 0), target)
  WHEN starts_with(target, '?') OR starts_with(target, '#') THEN concat(regexp_extract(r, '^[^/?#]*', 0), {path("r")}, target)
  ELSE concat(regexp_replace(regexp_extract(r, '^[^/?#]*(/(?:[^?#]*/)?)?', 0), '/$', ''), '/', target) END AS t FROM named WHERE r <> '' AND target <> ''),
edges AS (SELECT {node("r")} AS a, {node("t")} AS b FROM absolute),
two_way AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
blocked AS (SELECT a AS node FROM two_way WHERE {decided(host("a"), path("a"), 0)} = 'block' UNION SELECT b FROM blocked JOIN two_way ON a = node)
SELECT page_id, host, path, {decided("host", "path", 1)} AS rule,
COALESCE({decided("host", "path", 0)}, CASE WHEN node IN (SELECT node FROM blocked WHERE node IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict FROM judged"""


def warc() -> str:
    """Base32 of five hexadecimal digits at a time: four characters of five bits."""
    bits = "CAST('0x' || substr(sha, 1 + 5 * (i // 4), 5) AS BIGINT)"
    base32 = f"list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (({bits} >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1) FOR i IN range(32)], 'string_agg', '')"
    return f"""WITH own AS (SELECT page_id, COALESCE(html, '') AS payload, sha1(COALESCE(html, '')) AS sha FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM own)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {base32} AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM firsts"""


def chat(added_id: int, added_text: str) -> str:
    escaped = lambda text: f"length(regexp_replace({text}, '([<\\[\\]\\\\])', '##', 'g'))"
    return f"""WITH turns AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
UNION ALL VALUES ({added_id}, 0, 'user', '{added_text}'), ({added_id}, 1, 'assistant', '{added_text}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(length('<s>[] </s>') + {escaped("role")} + {escaped("text")}) AS BIGINT) AS formatted_chars FROM turns GROUP BY conv_id"""


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda s, c: list_reduce(list_prepend(xor(s, c), [0, 0, 0, 0, 0, 0, 0, 0]), lambda t, z: CASE WHEN t % 2 = 1 THEN xor(t // 2, 3988292384) ELSE t // 2 END)))"""


def runs(min_length: int = 12) -> str:
    """Each equal pair of words in a text, the stretches of such pairs at one distance, and those of two periods.

    For document ids without repetition.
    """
    return f"""WITH split AS (SELECT doc_id, COALESCE(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w, {_CRC} AS h FROM documents),
planted AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS times FROM split),
spoken AS (SELECT doc_id, i, CASE WHEN i >= a THEN w[1 + a + (i - a) % (1 + (len(w) - a) // times)] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(len(w))) AS i FROM planted)),
equal AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM spoken x JOIN spoken y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i),
islands AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) GROUP BY doc_id, q, island),
found AS (SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest({min_length}, 2 * q) GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found),
collapsed AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM spoken ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS every,
  first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS top FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(COALESCE(n_runs, 0) AS BIGINT) AS n_runs, CAST(top.start AS BIGINT) AS start, CAST(top.length AS BIGINT) AS length,
CAST(top.period AS BIGINT) AS period, CAST(1000 * top.length // top.period AS BIGINT) AS exponent_milli,
sha256(COALESCE(every, '')) AS runs_sha256, sha256(COALESCE(kept, '')) AS collapsed_sha256
FROM split d LEFT JOIN listed USING (doc_id) LEFT JOIN collapsed USING (doc_id)"""


def suffix_dedup(threshold: int = 50) -> str:
    """Every window of every text as hexadecimal digits, and its first document. For document ids without NULL."""
    return f"""WITH docs AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS x FROM documents),
parts AS (SELECT doc_id, 500 * k AS zero, substr(x, 1000 * k + 1, 1000 + {2 * threshold - 2}) AS part
  FROM (SELECT *, unnest(range(len(x) // 1000 + 1)) AS k FROM docs)),
windows AS (SELECT doc_id, zero + i AS i, substr(part, 2 * i + 1, {2 * threshold}) AS content
  FROM (SELECT *, unnest(range(least(500, len(part) // 2 - {threshold - 1}))) AS i FROM parts WHERE len(part) >= {2 * threshold})),
firsts AS (SELECT content, min(doc_id) AS earliest FROM windows GROUP BY content HAVING min(doc_id) < max(doc_id)),
later AS (SELECT DISTINCT doc_id, i FROM windows JOIN firsts USING (content) WHERE doc_id > earliest),
edges AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {threshold} THEN 0 ELSE 1 END AS begins FROM later),
spans AS (SELECT doc_id, min(i) AS s, max(i) + {threshold} AS e
  FROM (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM edges) GROUP BY doc_id, span),
pieces AS (SELECT doc_id, s, e, substr(x, 2 * COALESCE(lag(e) OVER own, 0) + 1, 2 * (s - COALESCE(lag(e) OVER own, 0))) AS before
  FROM spans JOIN docs USING (doc_id) WINDOW own AS (PARTITION BY doc_id ORDER BY s)),
cut AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY s) AS before, max(e) AS rest FROM pieces GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans,
sha256(unhex(concat(COALESCE(before, ''), substr(x, 2 * COALESCE(rest, 0) + 1)))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)"""
