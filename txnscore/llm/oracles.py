"""DuckDB statements that give the rows of the queries, where SQL can."""

from __future__ import annotations

import re

from txnscore.llm import codes, divergence, reputation
from txnscore.llm.licenses import GAP, PHRASES, TEMPLATES, THRESHOLD, template_words

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH normal AS (SELECT doc_id, {_LOWER} AS text FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
       sha256(text) AS text_sha256
FROM normal
"""

#: Sizes, weights, targets and the draw of each source; ends with the table ``mix``.
MIX_TABLES = r"""
seeded AS (
  SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || sha256(coalesce(text, '')) || ':' || coalesce(source, '') AS seed FROM {docs}),
sized AS (SELECT *, row_number() OVER (PARTITION BY seed) - 1 AS nth, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM seeded),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3] AS weight
  FROM sources),
ordered AS (
  SELECT *,
         coalesce(sum(source_size) OVER below, 0)::BIGINT AS capped,
         sum(weight) OVER above AS open_weight,
         sum(source_size) OVER ()::BIGINT AS total
  FROM weighed WHERE source_size > 0
  WINDOW below AS (ORDER BY source_size::DOUBLE / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         above AS (ORDER BY source_size::DOUBLE / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
levels AS (
  SELECT (3 * total - 4 * capped)::BIGINT AS num, (2 * open_weight)::BIGINT AS den FROM ordered
  WHERE 2 * source_size * 2 * open_weight > weight * (3 * total - 4 * capped)
  ORDER BY capped LIMIT 1),
reduced AS (SELECT num // gcd(num, den) AS num, den // gcd(num, den) AS den FROM levels),
targets AS (
  SELECT source, source_size,
         CASE WHEN (SELECT count(*) FROM reduced) = 0 THEN (2 * source_size)::DOUBLE
              ELSE least((2 * source_size)::DOUBLE, weight * (SELECT num FROM reduced)::DOUBLE / (SELECT den FROM reduced)::DOUBLE)
         END AS target
  FROM weighed),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
drawn AS (
  SELECT s.*, r.source_size, r.target, floor(r.rate)::BIGINT AS whole, r.rate - floor(r.rate) AS part,
         [('0x' || substr(sha256(seed || ':' || nth), 1 + 8 * k, 8))::BIGINT / 4294967296.0::DOUBLE
          FOR k IN range(8)] AS draws
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
tried AS (
  SELECT source, k, abs(sum(size * (whole + (draws[k + 1] < part)::INT)) - first(target)) AS off
  FROM drawn, range(8) t(k) GROUP BY source, k),
chosen AS (SELECT source, arg_min(k, (off, k)) AS draw FROM tried GROUP BY source),
mix AS (
  SELECT d.*, CASE WHEN size > 0 THEN (whole + (draws[draw + 1] < part)::INT)::INT ELSE 0 END AS copies
  FROM drawn d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source)
"""

MIXING = f"""
WITH {MIX_TABLES.replace("{docs}", "documents")}
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM mix
"""

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(
    f"({k}, {_quoted(label)}, [{', '.join(map(_quoted, template_words(text)))}], {len([w for w in re.split(GAP, text) if w])})"
    for k, (label, text) in enumerate(TEMPLATES)
)
_PHRASES = ", ".join(
    f"([{', '.join(map(_quoted, phrase.split()))}], {_quoted(label)})" for phrase, label in PHRASES.items()
)

LICENSE_SCAN = f"""
WITH docs AS (SELECT doc_id, {_LOWER} AS text FROM documents),
words AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{_GAP}'), lambda w: w <> '') AS ws FROM docs),
phrases(phrase, label) AS (VALUES {_PHRASES}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1 : i + len(phrase)] = phrase)) AS place
  FROM words CROSS JOIN phrases),
base AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS ls FROM places GROUP BY doc_id),
templates(k, label, ws, l) AS (VALUES {_TEMPLATES}),
blocks AS (
  SELECT doc_id, label, t.ws, unnest(list_transform(range(0, len(w.ws), t.l), lambda b: w.ws[b + 1 : b + 2 * t.l])) AS block
  FROM words w CROSS JOIN templates t),
hits AS (
  SELECT doc_id, label, len(list_intersect(block, ws))::DOUBLE / len(ws) AS part
  FROM blocks WHERE len(list_intersect(block, ws)) >= ceil({THRESHOLD} * len(ws) - 1e-9)),
found AS (SELECT doc_id, max(part) AS part, list(DISTINCT label) AS ls FROM hits GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base,
       lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.ls), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(f.ls, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0::DOUBLE) END AS score
FROM words LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

_RULES = sorted(reputation.RULES, key=lambda entry: -len(entry[1] + entry[2]))
_FITS = [
    (f"(host = {_quoted(at)} OR ends_with(host, {_quoted('.' + at)})) AND starts_with(path, {_quoted(beginning)})", at + beginning, decision)
    for decision, at, beginning in _RULES
]
_RULE = "CASE " + " ".join(f"WHEN {fits} THEN {_quoted(rule)}" for fits, rule, _ in _FITS) + " END"
_DECIDED = "CASE " + " ".join(f"WHEN {fits} THEN {_quoted(decision)}" for fits, _, decision in _FITS) + " END"
_BARE = "regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]$', '')"
_LAST = rf"((?:(?:{'|'.join(reputation.GENERIC)})[.][a-z][a-z]|[^.]*))$"
_TRUST = reputation.Settings()

URL_FILTER = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, {_RULE} AS rule, {_DECIDED} AS decided, {_BARE} AS bare FROM parsed),
hosts AS (
  SELECT host, bare, count(decided) AS n, count(*) FILTER (decided = 'block') AS bad,
         regexp_matches(bare, '^[0-9.]*$') OR starts_with(bare, '[') AS numeric
  FROM ruled GROUP BY host, bare),
named AS (
  SELECT host, n, bad,
         CASE WHEN numeric THEN bare ELSE regexp_extract(bare, '(?:[^.]*[.])?{_LAST}', 0) END AS domain,
         CASE WHEN numeric THEN '' ELSE regexp_extract(bare, '(?:^|[.]){_LAST}', 1) END AS suffix
  FROM hosts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
nodes AS (
  SELECT 'host' AS kind, n, bad FROM named UNION ALL
  SELECT 'domain', n, bad FROM domains UNION ALL
  SELECT 'suffix', n, bad FROM suffixes),
moments AS (
  SELECT kind, count(*) FILTER (n > 0) AS nodes, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad,
         sum(n::DOUBLE * n) AS squares, sum(CASE WHEN n > 0 THEN bad::DOUBLE * bad / n ELSE 0 END) AS between_
  FROM nodes GROUP BY kind),
shares AS (SELECT *, bad / nullif(n, 0) AS share FROM moments),
spreads AS (
  SELECT kind, CASE WHEN bad > 0 AND bad < n THEN (between_ - bad * share) / (share * (1 - share)) - (nodes - 1) END AS spread,
         n - squares / n - (nodes - 1) AS room FROM shares),
strengths AS (
  SELECT kind, CASE WHEN spread > 0 AND room > 0
                    THEN floor(least(greatest(room / spread - 1, {_TRUST.least}), {_TRUST.most}) + 0.5)
                    ELSE {_TRUST.most} END AS s FROM spreads),
root AS (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS m FROM suffixes),
suffix_means AS (
  SELECT suffix, (bad + s * m) / (n + s) AS m FROM suffixes, root, strengths WHERE kind = 'suffix'),
domain_means AS (
  SELECT domain, suffix, (bad + s * m) / (n + s) AS m FROM domains JOIN suffix_means USING (suffix), strengths WHERE kind = 'domain'),
beta AS (
  SELECT host, bad + s * m AS a, n - bad + s * (1 - m) AS b
  FROM named JOIN domain_means USING (domain, suffix), strengths WHERE kind = 'host'),
verdicts AS (
  SELECT host, CASE WHEN a / (a + b) - {_TRUST.deviations}::DOUBLE * sqrt(a * b / (a + b + 1)) / (a + b) > {_TRUST.tolerance}
                    THEN 'block' ELSE 'allow' END AS verdict FROM beta)
SELECT page_id, r.host, path, rule, coalesce(decided, verdict) AS verdict FROM ruled r JOIN verdicts v ON r.host = v.host
"""

def _vector_codes(settings: codes.Settings) -> str:
    parts, last = settings.parts, settings.rounds
    apart = "list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.c) + list_inner_product(b.c, b.c)"
    best = f"""SELECT id, part, any_value(v) AS v, arg_min(entry, (d, entry)) AS entry, min(d)::BIGINT AS error
      FROM (SELECT p.id, p.part, p.v, b.entry, {apart} AS d FROM parts p JOIN book{{k}} b USING (part)) GROUP BY id, part"""
    rounds = "".join(
        f"""
near{k} AS MATERIALIZED ({best.format(k=k)}),
mean{k} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i)::DOUBLE[] AS c
  FROM (SELECT part, entry, i, sum(v[i]::BIGINT)::BIGINT AS s, count(*)::BIGINT AS n
        FROM near{k}, range(1, len(v) + 1) t(i) GROUP BY part, entry, i) GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (part, entry)),"""
        for k in range(last)
    )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT id, part, list_slice(v, part * len(v) // {parts} + 1, (part + 1) * len(v) // {parts}) AS v
  FROM kept, range({parts}) t(part)),
book0 AS MATERIALIZED (
  SELECT part, entry, v AS c FROM parts
  JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS entry FROM kept ORDER BY id LIMIT {settings.entries}) USING (id)),{rounds}
final AS MATERIALIZED ({best.format(k=last)}),
coded AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error FROM final GROUP BY id),
digest AS (
  SELECT sha256(string_agg(x::BIGINT, ',' ORDER BY part, entry, i)) AS d
  FROM (SELECT part, entry, i, c[i] AS x FROM book{last}, range(1, len(c) + 1) t(i)))
SELECT id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT d FROM digest) AS codebooks_sha256
FROM coded JOIN kept USING (id)
"""


VECTOR_CODES = _vector_codes(codes.Settings())

_AUDIT = divergence.Settings()


def _share(count: str, total: str, terms: str) -> str:
    scaled = f"{divergence.BILLION}::HUGEINT * ({count} + {_AUDIT.smoothing})"
    return f"(1 + ({scaled}) // ({total} + {_AUDIT.smoothing}::HUGEINT * {terms}))::BIGINT"


SOURCE_DIVERGENCE = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS text FROM documents),
occurring AS (SELECT DISTINCT lang, source FROM docs),
found AS MATERIALIZED (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS MATERIALIZED (
  SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= {_AUDIT.documents}),
vocabulary AS (SELECT lang, count(*) AS terms FROM kept GROUP BY lang),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
sums AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
facts AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(terms, 0) AS terms
  FROM occurring LEFT JOIN sums USING (lang, source) LEFT JOIN vocabulary USING (lang)),
shares AS MATERIALIZED (
  SELECT f.lang, f.source, k.term, coalesce(n, 0) AS n, {_share("coalesce(n, 0)", "total", "terms")} AS p
  FROM facts f JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = f.lang AND c.source = f.source AND c.term = k.term),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM facts a JOIN facts b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
overall AS (
  SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM counts GROUP BY lang, term),
telling AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, p - {_share("o.n", "o.total", "v.terms")} AS value
  FROM shares s JOIN overall o USING (lang, term) JOIN vocabulary v USING (lang) WHERE s.n > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (FROM pairs UNION ALL FROM telling WHERE value > 0))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {_AUDIT.ranks}
"""

ORACLES: dict[str, str] = {
    "op2_exact_dedup": EXACT_DEDUP,
    "op4_mixing": MIXING,
    "op9_license_scan": LICENSE_SCAN,
    "op11_url_filter": URL_FILTER,
    "op12_vector_codes": VECTOR_CODES,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
