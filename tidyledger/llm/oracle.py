"""The queries of this subpackage as DuckDB SQL, where SQL can express them; constants are stated here once more.

Nearest neighbours, the two classifiers and language ID have none: they are approximate or learned, and are tested against
brute force and held-out labels.
"""

from __future__ import annotations

import hashlib

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str) -> str:
    """(key, g): the distinct shingles of every text."""
    return f"""
SELECT {key}, unnest(list_distinct(CASE WHEN len(l) >= 5
    THEN list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' '))
    WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END)) AS g
FROM (SELECT {key}, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS l FROM {table})"""


MIXING = f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM sums),
ranked AS (  -- the sources that reach their limit are the first by limit per weight
  SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
    sum(2.0::DOUBLE * source_size) OVER by_ratio - 2.0::DOUBLE * source_size AS capped,
    sum(weight) OVER () - sum(weight) OVER by_ratio + weight AS free, 1.5::DOUBLE * sum(source_size) OVER () AS share
  FROM weighed WINDOW by_ratio AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
level AS (  -- of the first one that does not
  SELECT arg_min(round, ratio) AS per_weight FROM (SELECT (share - capped) / free AS round, ratio FROM ranked) WHERE round <= ratio),
plan AS (SELECT source, source_size, least(weight * per_weight, 2.0::DOUBLE * source_size) AS target FROM ranked, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::UBIGINT::DOUBLE / 4503599627370496 AS draw
  FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated"""

DECONTAMINATION = f"""
WITH d AS ({_shingles("documents", "doc_id")}), i AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM d JOIN i USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item"""

NGRAM_JOIN = f"""
WITH RECURSIVE s AS MATERIALIZED ({_shingles("documents", "doc_id")}),
n AS (SELECT doc_id, coalesce(c, 0) AS n_shingles FROM documents LEFT JOIN (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id) USING (doc_id)),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n_shingles + q.n_shingles - o)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, n_shingles::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM n LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)"""

CHAT_FORMATTING = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
written AS (
  SELECT *, length(text) + 2 * len(regexp_extract_all(text, '</?s>|\[/?INST\]|<</?(SYS|ROLE)>>'))
    + len(regexp_extract_all(text, '\x1b')) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 WHEN 'system' THEN 19 ELSE NULL END AS chars
  FROM turns),
told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS all_text,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(chars)::BIGINT AS formatted_chars
  FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM told"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL_SEARCH = f"""
WITH t AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term FROM documents) GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS size FROM t GROUP BY doc_id),
sums AS (SELECT count(*) AS docs, sum(size)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), sums),
asked AS (SELECT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * size * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN t USING (term) JOIN sizes USING (doc_id), sums GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, range(1, 6) AS sizes(k) WHERE len(w) >= k),
often AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM often WHERE k >= 2),
cuts AS (
  SELECT lang, phrase, c, f, array_to_string(w[:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest
  FROM split, range(1, 5) AS places(c) WHERE c < k),
scored AS (
  SELECT s.lang, s.phrase, s.c, s.f AS a, x.f AS l, y.f AS r, n, ((1000::HUGEINT * s.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts s JOIN often x ON x.lang = s.lang AND x.phrase = s.first JOIN often y ON y.lang = s.lang AND y.phrase = s.rest
  JOIN totals t ON t.lang = s.lang),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored) WHERE place = 1),
inside AS (
  SELECT DISTINCT s.lang, array_to_string(s.w[b:b + m - 1], ' ') AS phrase
  FROM split s, range(1, 5) AS begins(b), range(2, 5) AS sizes(m)
  JOIN often o ON o.lang = s.lang AND o.phrase = array_to_string(s.w[b:b + m - 1], ' ')
  WHERE m < s.k AND b + m - 1 <= s.k AND 100 * s.f >= 100 * o.f)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest ANTI JOIN inside USING (lang, phrase))
WHERE rank <= 2000"""


def _shard_table(shards: int = 64, slots: int = 6553) -> str:
    """The lookup table, filled from whole preference lists; taking turns is not a matter for SQL."""
    digest = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:13], 16)
    wishes = []
    for i in range(shards):
        name = f"shard-{i:05d}"
        first, step = digest(f"offset:{name}") % slots, digest(f"skip:{name}") % (slots - 1) + 1
        wishes.append(iter([(first + j * step) % slots for j in range(slots)]))
    taken: dict[int, int] = {}
    while len(taken) < slots:
        for i, wish in enumerate(wishes):
            if len(taken) < slots:
                taken[next(s for s in wish if s not in taken)] = i
    return ", ".join(str(taken[s]) for s in range(slots))


def sharding() -> str:
    slot = "('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::UBIGINT % 6553"
    return f"SELECT doc_id, ({slot})::BIGINT AS slot, ([{_shard_table()}])[({slot})::INT + 1]::INTEGER AS shard FROM documents"


def url_filter(depth: int = 4) -> str:
    """The template tree level by level, then merged siblings and smoothed shares of blocked labels."""
    steps = []
    for level in range(depth):
        parent = f"array_to_string(tree[1:{level}], '/')"
        steps.append(f"""
varied{level} AS (
  SELECT host, parent FROM (
    SELECT host, {parent} AS parent, tree[{level + 1}] AS child, sum(n) AS n FROM tree{level} WHERE len(tree) > {level} GROUP BY 1, 2, 3)
  GROUP BY host, parent HAVING count(*) > 16 OR (count(*) >= 4 AND 2 * count(*) FILTER (n = 1) > count(*))),
tree{level + 1} AS (
  SELECT t.* REPLACE (CASE WHEN v.host IS NOT NULL AND len(tree) > {level}
    THEN tree[1:{level}] || ['*'] || tree[{level + 2}:] ELSE tree END AS tree)
  FROM tree{level} t LEFT JOIN varied{level} v ON v.host = t.host AND v.parent = {parent.replace("tree", "t.tree")})""")
    rate = "((blocked + 1)::DOUBLE / (labelled + 2))"
    last = "((b + 1)::DOUBLE / (m + 2))"
    pooled = "((blocked + b + 1)::DOUBLE / (labelled + m + 2))"
    gap = f"({rate} - {last}) / sqrt({pooled} * (1 - {pooled}) * (1.0::DOUBLE / (labelled + 2) + 1.0::DOUBLE / (m + 2)))"
    fits = lambda host, path: f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    rules = (("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("org", "/", "allow"))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in rules)
    given = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in rules)
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
judged AS (
  SELECT *, CASE {rule} END AS rule, CASE {given} END AS given,
    list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> '') AS whole FROM split),
shaped AS (SELECT *, CASE WHEN len(whole) > {depth} THEN whole[1:{depth}] || ['**'] ELSE whole END AS segs FROM judged),
tree0 AS (
  SELECT host, segs, segs AS tree, count(*) AS n, count(given) AS labelled, count(*) FILTER (given = 'block') AS blocked
  FROM shaped GROUP BY host, segs),
{",".join(steps)},
named AS (
  SELECT *, array_to_string(tree, '/') AS template, array_to_string(tree[1:greatest(len(tree) - 1, 0)], '/') AS parent FROM tree{depth}),
leaves AS (SELECT host, parent, template, sum(labelled) AS labelled, sum(blocked) AS blocked FROM named GROUP BY ALL),
lagged AS (
  SELECT *, lag(blocked) OVER w AS b, lag(labelled) OVER w AS m FROM leaves
  WINDOW w AS (PARTITION BY host, parent ORDER BY {rate}, template)),
merged AS (
  SELECT *, sum(CASE WHEN {gap} > 1.96 THEN 1 ELSE 0 END) OVER (PARTITION BY host, parent ORDER BY {rate}, template
    ROWS UNBOUNDED PRECEDING) AS branch FROM lagged),
branches AS (SELECT host, parent, branch, sum(labelled) AS labelled, sum(blocked) AS blocked FROM merged GROUP BY ALL),
base AS (SELECT (coalesce(sum(blocked), 0) + 1)::DOUBLE / (coalesce(sum(labelled), 0) + 2) AS p FROM branches),
hosts AS (SELECT host, (sum(blocked) + 4.0::DOUBLE * any_value(p)) / (sum(labelled) + 4.0::DOUBLE) AS p FROM branches, base GROUP BY host),
parents AS (
  SELECT host, parent, (sum(blocked) + 4.0::DOUBLE * any_value(p)) / (sum(labelled) + 4.0::DOUBLE) AS p
  FROM branches JOIN hosts USING (host) GROUP BY host, parent),
purity AS (
  SELECT host, parent, branch, 1 - (blocked + 4.0::DOUBLE * p) / (labelled + 4.0::DOUBLE) AS purity FROM branches JOIN parents USING (host, parent))
SELECT page_id, s.host, path, rule, coalesce(given, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM shaped s JOIN named t ON t.host = s.host AND t.segs = s.segs
JOIN merged g ON g.host = t.host AND g.parent = t.parent AND g.template = t.template
JOIN purity p ON p.host = g.host AND p.parent = g.parent AND p.branch = g.branch"""


def statements() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter(),
        "op2_sharding": sharding(),
        "op3_mixing": MIXING,
        "op4_decontamination": DECONTAMINATION,
        "op5_ngram_join": NGRAM_JOIN,
        "op7_chat_formatting": CHAT_FORMATTING,
        "op11_lexical_search": LEXICAL_SEARCH,
        "op13_collocations": COLLOCATIONS,
    }
