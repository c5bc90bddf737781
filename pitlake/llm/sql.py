"""DuckDB SQL of the training-data queries that SQL can express, by the plainest way there is.

Each states what the query of its name must return on the input tables, without the
operator's method: all pairs instead of hashing, windows over whole leaves instead of
buckets, sets of words instead of signatures.
"""

from __future__ import annotations

import string

from pitlake.llm.licenses import CONTAINMENT, WORDS
from pitlake.llm.notices import TEMPLATES

_REACH = """reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT r.a, s.b FROM reach r JOIN (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges) s ON r.b = s.a),
top AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY 1)"""


def _number(text: str, digits: int) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


# -- mixing ---------------------------------------------------------------------------------


def _level(depth: int, keys: tuple[str, ...]) -> str:
    """One level of the tree: the budget of each node out of its parent's."""
    own, names, before = keys[depth], ", ".join(keys[: depth + 1]), "g0" if not depth else f"g{depth}"
    group = f"PARTITION BY {', '.join(keys[:depth])}" if depth else ""
    order = f"ORDER BY cap / weight::DOUBLE, {own} NULLS FIRST"
    d = depth + 1
    same = " AND ".join(f"l.{k} IS NOT DISTINCT FROM n.{k}" for k in keys[: depth + 1])
    weight = f"{_number(f'''concat('{own}:', coalesce({own}, ''))''', 8)} % 4 + 1"
    return f"""n{d} AS (SELECT {names}, sum(capacity)::HUGEINT AS cap, min(given)::HUGEINT AS given, {weight} AS weight FROM {before} GROUP BY {names}),
a{d} AS (SELECT *, given - sum(cap) OVER ({group} {order} ROWS UNBOUNDED PRECEDING) + cap AS remaining, sum(weight) OVER ({group} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM n{d}),
b{d} AS (SELECT *, min((cap * weights <= remaining * weight)::INTEGER) OVER ({group} {order} ROWS UNBOUNDED PRECEDING) = 1 AS filled FROM a{d}),
c{d} AS (SELECT *, given - coalesce(sum(CASE WHEN filled THEN cap END) OVER ({group}), 0) AS rest, coalesce(sum(CASE WHEN NOT filled THEN weight END) OVER ({group}), 0) AS open_ FROM b{d}),
d{d} AS (SELECT *, CASE WHEN filled THEN cap ELSE rest * weight // nullif(open_, 0) END AS share FROM c{d}),
e{d} AS (SELECT *, given - sum(share) OVER ({group}) AS spare, row_number() OVER ({group} ORDER BY filled::INTEGER, (share >= cap)::INTEGER, {own} NULLS FIRST) AS nth FROM d{d}),
f{d} AS (SELECT {names}, share + (nth <= spare AND NOT filled AND share < cap)::INTEGER AS budget FROM e{d}),
g{d} AS (SELECT l.* REPLACE (n.budget AS given) FROM {before} l JOIN f{d} n ON {same})"""


_KEYS = ("domain", "lang", "source")
MIXING = f"""WITH base AS (SELECT doc_id, 'domain' || ({_number("coalesce(source, '')", 8)} % 4) AS domain, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D\\x20]+')) AS n_tokens, md5(coalesce(text, '')) AS digest FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * 4 AS capacity FROM base GROUP BY ALL),
g0 AS (SELECT *, (SELECT least(floor(sum(tokens) * 0.8::DOUBLE), sum(capacity))::HUGEINT FROM leaves) AS given FROM leaves),
{",".join(_level(d, _KEYS) for d in range(3))},
plan AS (SELECT domain, lang, source, coalesce(given // nullif(tokens, 0), 0)::BIGINT AS full_epochs, coalesce(given % nullif(tokens, 0), 0)::BIGINT AS rest FROM g3),
placed AS (SELECT b.*, full_epochs, rest, {_number("concat_ws('|', '11', full_epochs, doc_id, digest)", 15)} AS spot FROM base b JOIN plan p ON b.domain = p.domain AND b.lang IS NOT DISTINCT FROM p.lang AND b.source IS NOT DISTINCT FROM p.source),
taken AS (SELECT *, greatest(0, least(n_tokens, rest - coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY spot, doc_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS partial_tokens FROM placed)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, full_epochs, partial_tokens, (full_epochs * n_tokens + partial_tokens)::BIGINT AS taken FROM taken"""


# -- license scans --------------------------------------------------------------------------


def _words(text: str) -> str:
    """Lower-case words: letters and digits, and points before a digit."""
    dotted = f"regexp_replace(replace({text}, chr(1), ' '), '\\.([0-9])', chr(1) || '\\1', 'g')"
    plain = f"replace(regexp_replace({dotted}, '[^\\p{{L}}\\p{{N}}\\x01]+', ' ', 'g'), chr(1), '.')"
    return f"list_filter(string_split(lower({plain}), ' '), lambda w: w <> '')"


def _shingles(words: str, width: str) -> str:
    return f"CASE WHEN len({words}) = 0 THEN [] ELSE list_transform(range(1, greatest(len({words}) - {width} + 1, 1) + 1), lambda i: array_to_string({words}[i:i + {width} - 1], ' ')) END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENSES = f"""WITH notices AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES)}) v(template, notice)),
cut AS (SELECT template, {_words("notice")} AS ws FROM notices),
known AS (SELECT template, least(len(ws), {WORDS}) AS width, list_distinct({_shingles("ws", f"least(len(ws), {WORDS})")}) AS own FROM cut),
sized AS (SELECT *, CAST(pow(2, ceil(log2(len(own)))) AS BIGINT) AS half, CAST(ceil(len(own) * {CONTAINMENT}::DOUBLE - 1e-9::DOUBLE) AS BIGINT) AS need FROM known),
split AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
wide AS (SELECT doc_id, width, {_shingles("ws", "width")} AS sh FROM split, (SELECT DISTINCT width FROM sized)),
placed AS (SELECT doc_id, width, unnest(sh) AS h, unnest(range(0, len(sh))) AS pos FROM wide),
marks AS (SELECT doc_id, template, half, need, len(own) AS size, h, pos FROM placed JOIN (SELECT *, unnest(own) AS one FROM sized) t ON placed.width = t.width AND placed.h = t.one),
windows AS (SELECT doc_id, template, need, size, h, pos // half AS k FROM marks UNION ALL SELECT doc_id, template, need, size, h, pos // half - 1 FROM marks WHERE pos >= half),
held AS (SELECT doc_id, template, size, need, count(DISTINCT h) AS n FROM windows GROUP BY doc_id, template, size, need, k),
found AS (SELECT doc_id, template, max(n / size) AS part FROM held WHERE n >= need GROUP BY 1, 2),
listed AS (SELECT doc_id, count(*) AS n, string_agg(template, ',' ORDER BY template) AS names, max(part) AS best FROM found GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses, best FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id"""


# -- near-duplicates ------------------------------------------------------------------------

VECTORS = f"""WITH RECURSIVE usable AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
edges AS (SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x) WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
nodes AS (SELECT vec_id AS node FROM embeddings), {_REACH},
links AS (SELECT node, count(*) AS n FROM (SELECT a AS node FROM edges UNION ALL SELECT b FROM edges) GROUP BY 1)
SELECT top.node AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = top.node AS kept FROM top LEFT JOIN links ON top.node = links.node"""

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
TEXTS = f"""WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (SELECT doc_id, list_distinct({_shingles("ws", "5")}) AS sh FROM split),
sizes AS (SELECT doc_id, len(sh) AS n FROM sets), owned AS (SELECT doc_id, unnest(sh) AS h FROM sets),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM owned p JOIN owned q ON p.h = q.h AND p.doc_id < q.doc_id GROUP BY 1, 2),
edges AS (SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
nodes AS (SELECT doc_id AS node FROM documents), {_REACH}
SELECT doc_id, n::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept FROM sizes JOIN top ON doc_id = node"""


# -- personal data --------------------------------------------------------------------------

_DIGITS = "regexp_replace(f, '[^0-9]', '', 'g')"
_SIGNS = "list_reverse(list_transform(string_split(regexp_replace(f, '[^0-9]', '', 'g'), ''), lambda c: CAST(c AS INTEGER)))"
_LUHN = f"list_sum(list_transform(range(1, len({_SIGNS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {_SIGNS}[i] WHEN {_SIGNS}[i] > 4 THEN {_SIGNS}[i] * 2 - 9 ELSE {_SIGNS}[i] * 2 END)) % 10 = 0"
_PLAIN = "regexp_replace(f, '[^A-Z0-9]', '', 'g')"
_VALUES = f"list_transform(string_split(substr({_PLAIN}, 5) || substr({_PLAIN}, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"
_MOD97 = f"list_reduce(list_concat([0], {_VALUES}), lambda a, v: CASE WHEN v > 9 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) = 1"
#: kind, text that is searched, pattern, condition on a match ``f``, score, context
_KINDS = (
    ("email", "t", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 0.9, r"e-?mail|mail|contact|kontakt|correo|courriel"),
    ("ip", "t", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(f, '.'), lambda p: CAST(p AS DOUBLE) > 255)) = 0", 0.6, r"\bip\b|address|server|host|adresse"),
    ("card", "t", r"[0-9]([\x20-]?[0-9])+", f"len({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}", 0.8, r"card|visa|credit|karte|carte|tarjeta"),
    ("phone", "t", r"\+[0-9][\x20().0-9-]+[0-9]", f"len({_DIGITS}) BETWEEN 10 AND 15", 0.6, r"phone|tel|call|mobile|anruf|fax"),
    # Without underscores a word's bounds are those of ASCII letters and digits.
    ("iban", "translate(t, '_', '~')", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", f"len({_PLAIN}) BETWEEN 15 AND 34 AND {_MOD97}", 0.8, r"iban|account|konto|compte|cuenta"),
    # A number with neither digits nor hyphens around it is a whole run of those.
    ("ssn", "t", r"[0-9-]+", "regexp_full_match(f, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND f[1:3] NOT IN ('000', '666') AND f[1] <> '9' AND f[5:6] <> '00' AND f[8:11] <> '0000'", 0.4, r"ssn|social security"),
)


def _found(rank: int, kind: str, text: str, pattern: str, valid: str, score: float, context: str) -> str:
    cut = f"SELECT doc_id, t, regexp_extract_all({text}, '{pattern}') AS fs, string_split_regex({text}, '{pattern}') AS gs FROM texts"
    placed = f"SELECT doc_id, t, fs[i] AS f, CAST(list_sum(list_transform(gs[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(fs[1:i - 1], lambda g: len(g))), 0) AS BIGINT) AS s FROM (SELECT *, unnest(range(1, len(fs) + 1)) AS i FROM ({cut}))"
    near = "lower(substr(t, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)))"
    value = f"least(1.0::DOUBLE, {score}::DOUBLE + CASE WHEN regexp_matches({near}, '{context}') THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)"
    return f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, s, s + len(f) AS e, {value} AS score FROM ({placed}) WHERE {valid}"


_LISTED = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e)"
PII = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_found(rank, *kind) for rank, kind in enumerate(_KINDS))}),
kept AS (SELECT * FROM spans WHERE rank < 4 OR score >= 0.6::DOUBLE - 1e-9::DOUBLE),
told AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))}, {_LISTED} FILTER (WHERE rank < 4) AS base, {_LISTED} AS spans, count(*) FILTER (WHERE rank > 3) AS n_added, max(score) AS top_score FROM kept GROUP BY 1)
SELECT x.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("email", "ip", "card", "phone"))}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added, top_score FROM texts x LEFT JOIN told ON x.doc_id = told.doc_id"""

ORACLES = {
    "op1_mixing": MIXING,
    "op2_license_scans": LICENSES,
    "op7_embedding_near_dedup": VECTORS,
    "op8_minhash_near_dedup": TEXTS,
    "op9_pii": PII,
}
