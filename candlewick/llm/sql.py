"""The queries in DuckDB SQL, where SQL can express them."""

from candlewick.llm.quality import LIMIT, RISK, RULES

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_UPPER}), {_ITEM_WORD})"


_CONTAMINATION = f"""
WITH item AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark
  WHERE item_id IS NOT NULL AND len({_words('text')}) > 0
),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
  FROM item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i)
),
doc AS (SELECT doc_id, {_words('text')} AS w FROM documents),
hit AS (
  SELECT doc_id, p.i AS pos, s.size, win.item
  FROM doc, (SELECT DISTINCT size FROM win) AS s, unnest(range(1, greatest(len(w) - s.size + 1, 0) + 1)) AS p(i), win
  WHERE win.size = s.size AND win.win = array_to_string(w[p.i : p.i + s.size - 1], ' ')
),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM hit, unnest(range(pos, pos + size)) AS u(place) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SIGNALS = {
    "symbols_per_100_words": "100 * n_symbols / nullif(n_words, 0)",
    "marks_per_100_words": "100 * n_marks / nullif(n_words, 0)",
    "upper_per_100_chars": "100 * n_upper / nullif(word_chars, 0)",
    "dup_lines_per_100": "100 * n_dup_lines / nullif(n_lines, 0)",
    "echoes_per_100_words": "100 * n_echoes / nullif(n_words, 0)",
}
_GRID = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, {step} AS step, {float(cutoff)} AS cutoff"
    for rule, cutoffs in RULES.items() for step, cutoff in enumerate(cutoffs)
)
_VALUE = "CASE rule " + " ".join(f"WHEN '{rule}' THEN {rule}" for rule in _SIGNALS) + " END"
_RATE = LIMIT / len(RULES)

_QUALITY = f"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
gram AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM doc, unnest(range(1, len(w) - 3)) AS t(i)
),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM gram),
       unnest(range(i, i + 5)) AS u(place) WHERE times > 1 GROUP BY doc_id
),
counted AS (
  SELECT doc_id, stratum, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(regexp_extract_all(text, '!')) AS n_marks,
         len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes
  FROM doc LEFT JOIN repeated USING (doc_id)
),
based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         {', '.join(f'coalesce({value}, 0) AS {rule}' for rule, value in _SIGNALS.items())}
  FROM counted
),
votes AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
labelled AS (SELECT based.*, quality FROM based JOIN votes USING (doc_id) WHERE NOT base_failed),
tested AS (
  SELECT stratum, rule, step, cutoff, sum(CAST(quality = 1 AS INT)) AS good,
         sum(CAST(quality = 1 AND {_VALUE} > cutoff AS INT)) AS k, sum(CAST(quality = 0 AND {_VALUE} > cutoff AS INT)) AS bad
  FROM labelled, ({_GRID}) GROUP BY ALL
),
proved AS (
  SELECT *, good > 0 AND list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda i:
           exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({_RATE}) + (good - i) * ln(1 - {_RATE}))))
           <= {RISK / len(RULES)} / (SELECT greatest(count(DISTINCT stratum), 1) FROM labelled) AS holds
  FROM tested
),
certified AS (
  SELECT *, bool_and(holds) OVER (PARTITION BY stratum, rule ORDER BY step) AS certain FROM proved
),
chosen AS (
  SELECT stratum, rule, cutoff FROM certified WHERE certain AND bad > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad DESC, step) = 1
),
rejected AS (
  SELECT DISTINCT doc_id FROM based JOIN chosen USING (stratum) WHERE {_VALUE} > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected.doc_id IS NULL AS kept
FROM based LEFT JOIN rejected USING (doc_id)
"""

_KINDS = {
    "assign": (
        r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 6
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "forge": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
}


def _found(order: int, kind: str) -> str:
    pattern, group, least = _KINDS[kind]
    return f"""
  SELECT doc_id, {order} AS ord, '{kind}' AS kind, stop - len(whole) AS start, stop AS stop
  FROM (
    SELECT doc_id, found[i] AS whole, vals[i] AS val,
           sum(len(gaps[i]) + len(found[i])) OVER (PARTITION BY doc_id ORDER BY i) AS stop
    FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found,
                 regexp_extract_all(text, '{pattern}', {group}) AS vals, string_split_regex(text, '{pattern}') AS gaps
          FROM text WHERE regexp_matches(text, '{pattern}')),
         unnest(range(1, len(found) + 1)) AS t(i)
  ) WHERE len(val) >= {least}"""


_SECRETS = f"""
WITH text AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
span AS ({" UNION ALL ".join(_found(order, kind) for order, kind in enumerate(_KINDS))}),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, ord) FILTER (ord < 3) AS base,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, ord) AS spans
  FROM span GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN told USING (doc_id)
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\s'), '#', '\h'), '<', '\l')"
_CHAT = f"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
),
turns AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS head FROM raw
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(len({_ESCAPED.format('text')}) + 8 + CASE WHEN head THEN
         len(replace(replace({_ESCAPED.format('role')}, ':', '\\c'), chr(10), '\\n')) + 6 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_LINES = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
line AS (
  SELECT r, doc_id, i, lines[i] AS line, trim(translate(lines[i], {_UPPER}), {_BLANKS}) AS key
  FROM doc, unnest(range(1, len(lines) + 1)) AS t(i)
),
common AS (SELECT key FROM line WHERE len(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.key IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN common ON line.key = common.key GROUP BY r, doc_id
"""


_REPEATS = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
places AS (SELECT doc_id, words, unnest(range(len(words))) AS place FROM words),
windows AS (
  SELECT doc_id, place, list_slice(words, place + 1, place + 20) AS w FROM places WHERE place + 20 <= len(words)
),
later AS (
  SELECT doc_id, place FROM windows
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, place) > 1
),
covered AS (SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM later),
told AS (
  SELECT p.doc_id, p.place, p.words[p.place + 1] AS word, c.place IS NOT NULL AS gone
  FROM places p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.place = c.place
),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS rest
  FROM told GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.rest, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def _offered(state: str, cost: str, edit: str, line: str = "", when: str = "true") -> str:
    """One edit after the best audit of a state, as (cost, audit, lines); NULL where it cannot be."""
    lines = f"list_append({state}.r, {line})" if line else f"{state}.r"
    return (
        f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {lines}}} END"
    )


def _with_inserts(source: str) -> str:
    """Turns put in wherever that is cheaper; first the ones for a user, then for an assistant."""
    after = ", ".join(["n2", *[_offered(name, "5", "I", "'user:'") for name in ("n0", "n1", "n3")]])
    return f"""
SELECT conv_id, i, n0 AS v0, n1 AS v1, m2 AS v2, list_min([n3, {_offered("m2", "5", "I", "'assistant:'")}]) AS v3
FROM (SELECT *, list_min([{after}]) AS m2 FROM ({source}))"""


def _repair_sql() -> str:
    kept = "t.role || ':' || t.text"
    extra = "CASE WHEN t.truncated THEN 5 ELSE 0 END"
    free, user, assistant = "NOT t.must_go", "'user:' || t.text", "'assistant:' || t.text"
    plus, one_more = f"({extra})", f"(1 + {extra})"

    def best(*offers: str) -> str:
        return f"list_min([{', '.join(offers)}])"

    to_user = [
        offer for name in ("v0", "v1", "v3") for offer in (
            _offered(f"s.{name}", plus, "K", kept, f"{free} AND t.initial = 'u'"),
            _offered(f"s.{name}", one_more, "R", user, free),
        )
    ]
    step = f"""
SELECT s.conv_id, s.i + 1 AS i, {_offered("s.v0", "2", "D")} AS n0,
       {best(_offered("s.v1", "2", "D"), _offered("s.v0", plus, "K", kept, f"{free} AND t.initial = 's'"))} AS n1,
       {best(_offered("s.v2", "2", "D"), *to_user)} AS n2,
       {best(_offered("s.v3", "2", "D"), _offered("s.v2", plus, "K", kept, f"{free} AND t.initial = 'a'"),
             _offered("s.v2", one_more, "R", assistant, free))} AS n3
FROM steps s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.place = s.i + 1"""
    state = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
    start = f"""
SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 'r': []}} AS {state}) AS n0,
       CAST(NULL AS {state}) AS n1, CAST(NULL AS {state}) AS n2, CAST(NULL AS {state}) AS n3
FROM (SELECT DISTINCT conv_id FROM conversations)"""
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
),
marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
           lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda c, b: xor(c // 256, crc.steps[xor(c, b) % 256 + 1])), 4294967295) % 20 AS fault
  FROM conversations, crc
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE fault <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
         left(role, 1) AS initial, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
),
seen AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before,
         bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate
  FROM placed
),
turns AS (
  SELECT *, bare = '' AS blank, bare = '' OR duplicate AS must_go,
         bare <> '' AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated
  FROM seen
),
steps AS (
  {_with_inserts(start)}
  UNION ALL
  {_with_inserts(step)}
),
ends AS (
  SELECT conv_id, list_min([v0, v3]) AS best FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def oracle() -> dict[str, str]:
    return {
        "op11_conversation_repair": _repair_sql(),
        "op12_substrings": _REPEATS,
        "op1_decontaminate": _CONTAMINATION,
        "op2_quality": _QUALITY,
        "op5_secrets": _SECRETS,
        "op8_chat": _CHAT,
        "op10_lines": _LINES,
    }
