"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tallybayes.llm import license
from tallybayes.llm.chat import Template
from tallybayes.llm.warc import ALPHABET


def _escaped(text: str, template: Template) -> str:
    heads: dict[str, list[str]] = {}
    for c in template.controls():
        heads.setdefault(c[0], []).append(c[1:].replace("]", r"\]"))
    for head, tails in heads.items():
        text = rf"regexp_replace({text}, '(\{head})(\\*({'|'.join(tails)}))', '\1\\\2', 'g')"
    return text


def chat_sql(template: Template = Template()) -> str:
    known = {r: len(b) + len(a) for r, (b, a, _) in template.roles.items()}
    other = sum(map(len, template.other))
    text = _escaped("text", template)
    wraps = " ".join(f"WHEN '{r}' THEN {n}" for r, n in known.items())
    trained = ", ".join(f"'{r}'" for r, (_, _, loss) in template.roles.items() if loss)
    return f"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER w - 1 AS place, lag(coalesce(role, '')) OVER w AS before
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)),
judged AS (
  SELECT *, CASE WHEN CASE
      WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'user' THEN role = 'assistant'
      WHEN before IN ('system', 'assistant') THEN role = 'user' ELSE false END IS TRUE THEN NULL ELSE place END AS bad
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  sum(CASE WHEN role IN ({trained}) THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role IN ({trained})), '')) AS loss_sha256,
  ({len(template.begin)} + sum(length({text}) + CASE role {wraps} ELSE {other} + length({_escaped("coalesce(role, '')", template)}) END))::BIGINT
    AS formatted_chars,
  coalesce(min(bad), CASE WHEN last(role ORDER BY place) IS DISTINCT FROM 'assistant' THEN count(*) END) IS NULL AS valid,
  coalesce(min(bad), CASE WHEN last(role ORDER BY place) IS DISTINCT FROM 'assistant' THEN count(*) END) AS bad_turn
FROM judged GROUP BY conv_id"""


def _base32(digest: str) -> str:
    parts = []
    for i in range(8):
        bits = f"('0x' || substr({digest}, {5 * i + 1}, 5))::INT"
        parts += [f"substr('{ALPHABET}', (({bits} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0)]
    return " || ".join(parts)


CHAT = chat_sql()
WARC = f"""
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (SELECT page_id, payload_bytes, {_base32("h")} AS payload_digest FROM rows),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM firsts"""


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    out = f"translate({text}, '{license.UPPER}', '{license.LOWER}')"
    for old, new in license.SPELLINGS.items():
        out = f"replace({out}, {_quote(old)}, {_quote(new)})"
    out = f"regexp_replace({out}, {_quote('(?m)' + license.COPYRIGHT)}, '', 'g')"
    return f"regexp_replace({out}, {_quote(license.OTHER)}, ' ', 'g')"


def license_sql() -> str:
    known = ", ".join(f"({_quote(k)}, {_quote(t)})" for k, ts in license.KNOWN.items() for t in ts)
    notices = ", ".join(f"({_quote(line)}, {_quote(k)})" for line, k in license.canonical_notices().items())
    digest = "sha256(trim(regexp_replace({}, '[ \\n]+', ' ', 'g')))"
    return f"""
WITH known AS (
  SELECT DISTINCT {digest.format(_canonical("t"))} AS digest, license_id FROM (VALUES {known}) AS v(license_id, t)),
notices AS (SELECT * FROM (VALUES {notices}) AS v(line, id)),
forms AS (SELECT doc_id, {_canonical("text")} AS form FROM documents),
lines AS (SELECT doc_id, trim(unnest(string_split(form, chr(10)))) AS line FROM forms),
named AS (
  SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT id, ',' ORDER BY id) AS notices
  FROM lines JOIN notices USING (line) GROUP BY doc_id)
SELECT f.doc_id, {digest.format("f.form")} AS digest, k.license_id,
  coalesce(n.n_notices, 0) AS n_notices, coalesce(n.notices, '') AS notices
FROM forms f LEFT JOIN known k ON k.digest = {digest.format("f.form")} LEFT JOIN named n USING (doc_id)"""


LICENSE = license_sql()

# Plain scoring of every document that holds any of an item's terms.
SEARCH = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
lengths AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM lengths),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
q AS (SELECT item_id, term, count(*) AS reps FROM (SELECT item_id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_all) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, totals WHERE term IN (SELECT term FROM q) GROUP BY term),
scores AS (SELECT item_id, r, doc_id, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_all) // l_all)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN lengths USING (r), totals GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
