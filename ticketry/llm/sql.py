"""SQL twins of the operators that SQL can state, for DuckDB."""

from __future__ import annotations

from ticketry.llm.mixing import REPEATS, SCHEDULES, SLICE_DIGITS, WEIGHTS, areas
from ticketry.llm.quality_rules import ENOUGH, LEADING, MEASURES, REACH
from ticketry.llm.sharding import GROWN, SLICES, TREE

#: Words of ``text``: runs of anything but ASCII white space.
WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

TOP_K = """
WITH usable AS (
  SELECT row_number() OVER () AS uid, vec_id,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.uid AS quid, q.vec_id AS query_id, c.uid, c.vec_id,
    list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.uid <> c.uid AND len(q.vec) = len(c.vec)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY quid ORDER BY score DESC, vec_id, uid) AS place FROM scored)
SELECT query_id, place::INT AS rank, vec_id, score FROM placed WHERE place <= 10"""

SUBSTRINGS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents),
starts AS (
  SELECT r, doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS w
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs WHERE len(words) >= 50)),
first AS (SELECT w, min(doc_id) AS f FROM starts GROUP BY w),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS i
  FROM starts JOIN first USING (w) WHERE f < doc_id),
lost AS (SELECT r, count(*) AS n, list(i) AS places FROM gone GROUP BY r),
kept AS (
  SELECT d.r, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs) d
  WHERE NOT EXISTS (FROM gone g WHERE g.r = d.r AND g.i = d.i) GROUP BY d.r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)"""


def _draw(node: str) -> str:
    digits = f"substr(md5(concat(key, '/{node}')), 1, 13)"
    value = f"list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 14), lambda i: instr('0123456789abcdef', {digits}[i]) - 1)), lambda a, b: a * 16 + b)"
    return f"-ln(({value} + 0.5) / {16**13}::DOUBLE)"


def _choose(tree, level: str) -> str:
    weights: dict[int, int] = {}
    for shard in tree:
        number = getattr(shard, level)
        weights[number] = weights.get(number, 0) + shard.weight
    if len(weights) == 1:
        return str(next(iter(weights)))
    offers = ", ".join(
        f"{{'d': {_draw(f'{level} {n}')} / {w}, 'n': {n}}}" for n, w in sorted(weights.items())
    )
    return f"(list_sort([{offers}])[1]).n"


def _place(tree, levels=("region", "rack", "shard")) -> str:
    level, rest = levels[0], levels[1:]
    if not rest:
        return _choose(tree, level)
    numbers = sorted({getattr(s, level) for s in tree})
    cases = " ".join(
        f"WHEN {n} THEN {_place([s for s in tree if getattr(s, level) == n], rest)}" for n in numbers
    )
    return f"CASE {_choose(tree, level)} {cases} END"


CRC_TABLE = """list_reduce(list_concat([i::UBIGINT], [1::UBIGINT, 1, 1, 1, 1, 1, 1, 1]),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)"""


def _crc(hexed: str) -> str:
    byte = (
        f"(16 * (instr('0123456789ABCDEF', {hexed}[2 * i + 1]) - 1)"
        f" + instr('0123456789ABCDEF', {hexed}[2 * i + 2]) - 1)::UBIGINT"
    )
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(range(0, (length({hexed}) // 2)::BIGINT), lambda i: {byte})),
      lambda a, b: xor(a >> 8, tab[(xor(a & 255, b) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT"""


SHARDS = f"""
WITH tab AS (SELECT list({CRC_TABLE} ORDER BY i) AS tab FROM range(256) t(i)),
docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS key FROM documents),
hexed AS (SELECT *, hex(encode(text)) AS h, hex(encode(key)) AS k FROM docs),
rows AS (
  SELECT doc_id, key, strlen(text)::BIGINT + 1 AS size, {_crc("h")} AS text_crc32,
    ({_crc("k")}) % {SLICES} AS slice, {_place(TREE)} AS shard, {_place(GROWN)} AS grown_shard
  FROM hexed, tab)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id NULLS FIRST, key, text_crc32, size) - 1 AS slot,
  grown_shard::INT AS grown_shard
FROM rows"""


def _fences() -> str:
    out = []
    for m in MEASURES:
        spread = f"greatest(q3 - q1, floor(q2 * {m.spread} / 1000))"
        at = lambda e: f"max(CASE WHEN measure = '{m.name}' THEN {e} END)"  # noqa: B023,E731
        out.append(f"greatest({at(f'q3 + (1::BIGINT << greatest(length(bin(q3)) - {LEADING}, 0)::INT) - 1 + {REACH} * {spread}')}, {m.at_most}) AS {m.name}_high")
        low = "NULL" if m.at_least is None else f"least({at(f'q1 - {REACH} * {spread}')}, {m.at_least})"
        out.append(f"{low} AS {m.name}_low")
    return ", ".join(out)


_PER_MILLE = ", ".join(
    f"CASE WHEN {m.bottom} > 0 THEN {m.top} * 1000 // {m.bottom} ELSE 0 END AS {m.name}" for m in MEASURES
)
_LONG = " UNION ALL ".join(
    f"SELECT lang, source, '{m.name}' AS measure, {m.name} AS v FROM measured WHERE NOT base_failed"
    for m in MEASURES
)
_LIMIT = "CASE WHEN o.level IS NOT NULL THEN o.{0} WHEN l.level IS NOT NULL THEN l.{0} ELSE e.{0} END"
_INSIDE = " AND ".join(
    f"{m.name} <= coalesce({_LIMIT.format(m.name + '_high')}, {m.name})"
    + (f" AND {m.name} >= coalesce({_LIMIT.format(m.name + '_low')}, {m.name})" if m.at_least is not None else "")
    for m in MEASURES
)

QUALITY = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM docs WHERE len(words) >= 3)),
again AS (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1),
repeated AS (
  SELECT r, count(DISTINCT w) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS w FROM grams JOIN again USING (r, g)) GROUP BY r),
base AS (
  SELECT docs.r, doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM docs LEFT JOIN repeated USING (r)),
measured AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_PER_MILLE} FROM base),
long AS ({_LONG}),
edges AS (SELECT *, greatest(length(bin(v)) - {LEADING}, 0) AS d FROM long),
sketch AS (
  SELECT level, CASE WHEN level >= 1 THEN lang END AS lang, CASE WHEN level = 2 THEN source END AS source,
    measure, (v >> d::INT) << d::INT AS edge, count(*) AS n
  FROM edges, (VALUES (0), (1), (2)) t(level) GROUP BY ALL),
counted AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY edge) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM sketch),
quartiles AS (
  SELECT level, lang, source, measure, min(edge) FILTER (upto * 4 >= total) AS q1,
    min(edge) FILTER (upto * 4 >= total * 2) AS q2, min(edge) FILTER (upto * 4 >= total * 3) AS q3
  FROM counted WHERE total >= {ENOUGH} OR level = 0 GROUP BY ALL),
fences AS (SELECT level, lang, source, {_fences()} FROM quartiles GROUP BY level, lang, source)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  NOT m.base_failed AND {_INSIDE} AS kept
FROM measured m
LEFT JOIN fences o ON o.level = 2 AND o.lang IS NOT DISTINCT FROM m.lang AND o.source IS NOT DISTINCT FROM m.source
LEFT JOIN fences l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM m.lang
LEFT JOIN fences e ON e.level = 0"""



def _inverted(demand: str, knots) -> str:
    cases = ""
    for before, after, start, weight, slope in areas(knots):
        x = f"greatest({demand} - {before!r}::DOUBLE, 0::DOUBLE)"
        root = f"sqrt(greatest({weight * weight!r}::DOUBLE + {2 * slope!r}::DOUBLE * {x}, 0::DOUBLE))"
        u = f"CASE WHEN {x} > 0 THEN 2::DOUBLE * {x} / ({weight!r}::DOUBLE + {root}) ELSE 0::DOUBLE END"
        cases += f" WHEN {demand} < {after!r}::DOUBLE THEN {start!r}::DOUBLE + {u}"
    return f"least(CASE{cases} ELSE 1::DOUBLE END, 1::DOUBLE)"


_SCHEDULED = " ".join(
    f"WHEN {k} THEN {_inverted('(start::DOUBLE / budget::DOUBLE)', s)}" for k, s in enumerate(SCHEDULES)
)

MIXED = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, source, len({WORDS})::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))) AS place FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS n FROM rows GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM sizes),
weighed AS (SELECT *, ({list(WEIGHTS)})[(rank % {len(WEIGHTS)} + 1)::BIGINT] AS w FROM ranked),
filled AS (
  SELECT *, n * {REPEATS} AS most,
    (sum(n) OVER () - coalesce(sum(n * {REPEATS}) OVER ahead, 0))::BIGINT AS rest,
    (sum(w) OVER () - coalesce(sum(w) OVER ahead, 0))::BIGINT AS heavy
  FROM weighed
  WINDOW ahead AS (ORDER BY n / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, rest::DOUBLE * w > most::DOUBLE * heavy AS stops FROM filled),
targets AS (
  SELECT source, n AS source_size, rank, CASE WHEN stops THEN most::DOUBLE ELSE
    first_value(CASE WHEN NOT stops THEN rest END IGNORE NULLS) OVER line::DOUBLE * w
    / first_value(CASE WHEN NOT stops THEN heavy END IGNORE NULLS) OVER line END AS target
  FROM stopped
  WINDOW line AS (ORDER BY n / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
lined AS (
  SELECT r, doc_id, size, source_size, target, rank, floor(target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY rank ORDER BY place[:{SLICE_DIGITS}], place, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "before"
  FROM rows JOIN targets ON rows.source IS NOT DISTINCT FROM targets.source),
copies AS (
  SELECT r, epoch * source_size + "before" AS start, rank, budget, size
  FROM lined, range({REPEATS}) t(epoch) WHERE size > 0 AND epoch * source_size + "before" < budget),
taken AS (
  SELECT r, sum(least(budget - start, size))::BIGINT AS taken,
    min(CASE rank % {len(SCHEDULES)} {_SCHEDULED} END) AS first_position
  FROM copies GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_position
FROM lined LEFT JOIN taken USING (r)"""

TRIE = f"""
WITH tab AS (SELECT list({CRC_TABLE} ORDER BY i) AS tab FROM range(256) t(i)),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
  WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, turn, md5(length(role) || ':' || role || text)[:24] AS id, length(text) AS points FROM turns),
own AS (
  SELECT conv_id, id, points, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id, points) AS i
  FROM ids),
convs AS (
  SELECT conv_id, ({_crc("hex(encode(conv_id::VARCHAR))")}) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), tab),
given AS (
  SELECT c.conv_id, o.id, o.points, o.i FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, o.id, o.points, o.i FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h),
steps AS (
  SELECT conv_id, points, row_number() OVER line AS depth,
    array_to_string(list(id) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS path
  FROM given WINDOW line AS (PARTITION BY conv_id ORDER BY i)),
whole AS (SELECT c.conv_id, coalesce(max_by(path, depth), '') AS path FROM convs c LEFT JOIN steps USING (conv_id) GROUP BY 1),
members AS (
  SELECT conv_id, points, depth, path FROM steps UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT path, any_value(depth)::BIGINT AS depth, min(conv_id)::BIGINT AS conv_id, count(*) AS n_convs,
    any_value(points)::BIGINT AS points FROM members GROUP BY path),
below AS (
  SELECT a.path, b.points * (b.n_convs - 1) AS saved,
    NOT EXISTS (FROM nodes x WHERE x.depth = b.depth + 1 AND x.path[:-25] = b.path) AS leaf
  FROM nodes a JOIN nodes b ON b.depth >= a.depth AND starts_with(b.path, a.path)),
sums AS (
  SELECT path, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY path),
ends AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM whole GROUP BY path)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs,
  (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[:-25] = n.path) AS n_children,
  n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.path = n.path[:-25]"""

SPELLING = f"""
WITH RECURSIVE tab AS (SELECT list({CRC_TABLE} ORDER BY i) AS tab FROM range(256) t(i)),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
hexed AS (SELECT *, hex(encode(concat(doc_id::VARCHAR, ':', run))) AS key FROM counted),
numbered AS (SELECT run, times, {_crc("key")} AS h FROM hexed, tab),
altered AS (
  SELECT times, CASE WHEN h % 97 = 0
    THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM numbered),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
gaps AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, (list({{'form': other, 'm': m}} ORDER BY m DESC, other))[1] AS top
  FROM pairs GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top.m >= 2 * n THEN top.form END AS form,
    CASE WHEN top.m >= 2 * n THEN top.m END AS form_n
  FROM words LEFT JOIN best USING (word)),
ways AS (
  SELECT word, word AS stop, 0 AS steps FROM forms
  UNION ALL SELECT w.word, f.form, steps + 1 FROM ways w JOIN forms f ON f.word = w.stop WHERE f.form IS NOT NULL),
roots AS (SELECT word, max_by(stop, steps) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

ORACLES: dict[str, str] = {
    "op1_topk_search": TOP_K,
    "op8_substring_dedup": SUBSTRINGS,
    "op9_weighted_tree_sharding": SHARDS,
    "op10_quality_rules": QUALITY,
    "op11_curriculum_mixing": MIXED,
    "op12_conversation_trie": TRIE,
    "op13_spelling_variants": SPELLING,
}
