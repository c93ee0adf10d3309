"""Operators whose results SQL can express, in SQL for DuckDB over the same tables."""

from __future__ import annotations

from tillflow.llm.conversations import COST, FAULTS, MOST_GAPS, NEXT, PAIRS, SPACE, SPOKEN, TRUNCATED
from tillflow.llm.embedding_dedup import THRESHOLD
from tillflow.llm.sharding import KEY, ROUNDS, ROW_BYTES, SHARDS, _round_keys

# CRC-32 of a list of bytes: the table follows from the polynomial, a fold walks the bytes.
_CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda a, k:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, b) ORDER BY b) AS t
  FROM range(256) AS bytes(b)
)"""


def _crc32(text: str) -> str:
    """SQL for the checksum of a text; `t` of crc_table must be in scope."""
    codes = (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'),"
        " lambda x: ('0x' || x)::BIGINT)"
    )
    fold = (
        f"list_reduce({codes}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)"
    )
    return f"xor({fold}, 4294967295)"


# Links by every pair of a label, components by spreading the least id along them.
EMBEDDING_DEDUP = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), components AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), degrees AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN degrees USING (vec_id)
"""


def _product(value: str, factor: int) -> str:
    """A product modulo 2 ** 64."""
    return f"((({value})::UHUGEINT * {factor}::UHUGEINT) & {(1 << 64) - 1}::UHUGEINT)"


def _network_sql() -> str:
    """CTEs r0 to r<ROUNDS> that pass (row, left_half, right_half) through the rounds."""
    low = (1 << 64) - 1
    rounds = []
    for k, key in enumerate(_round_keys(KEY).tolist()):
        rounds.append(f"""
  x{k} AS (SELECT *, (r + {key}::UHUGEINT) & {low}::UHUGEINT AS x FROM r{k}),
  y{k} AS (SELECT *, {_product("xor(x, x >> 30::UHUGEINT)", 0xBF58476D1CE4E5B9)} AS y FROM x{k}),
  z{k} AS (SELECT *, {_product("xor(y, y >> 27::UHUGEINT)", 0x94D049BB133111EB)} AS z FROM y{k}),
  r{k + 1} AS (SELECT place, r AS l, xor(l, xor(z, z >> 31::UHUGEINT) & mask) AS r, half, mask FROM z{k})""")
    return ",".join(rounds)


# The network permutes 0 to 4 ** half - 1; a walk along it ends at the first place below n.
SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE}, digests AS (
  SELECT doc_id, strlen(coalesce(text, '')) + {ROW_BYTES} AS size,
    {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_table
), rows_in_order AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row_number,
    count(*) OVER () AS n
  FROM digests
), sizes AS (
  SELECT n, greatest(1, (len(ltrim(bin(greatest(n - 1, 1)), '0')) + 1) // 2) AS half
  FROM (SELECT count(*) AS n FROM digests)
), r0 AS (
  SELECT place, place >> half AS l, place & mask AS r, half, mask
  FROM (
    SELECT unnest(range(1::BIGINT << (2 * half)))::UHUGEINT AS place, half::UHUGEINT AS half,
      ((1::BIGINT << half) - 1)::UHUGEINT AS mask
    FROM sizes
  )
), {_network_sql()},
network AS MATERIALIZED (
  SELECT place::BIGINT AS place, ((r << half) | l)::BIGINT AS next_place FROM r{ROUNDS}
), walk AS (
  SELECT row_number, next_place AS reached, n
  FROM rows_in_order JOIN network ON network.place = row_number
  UNION ALL
  SELECT row_number, next_place, n FROM walk JOIN network ON network.place = walk.reached
  WHERE walk.reached >= n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (reached % {SHARDS})::INTEGER AS shard,
  reached // {SHARDS} AS slot, NULL::INTEGER AS grown_shard
FROM rows_in_order JOIN (SELECT row_number, reached FROM walk WHERE reached < n) USING (row_number)
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


def _leaf(n_chars: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return f"sha256({' || '.join(_field(f) for f in fields)})"


def _levels(name: str, bottom: str) -> str:
    """A CTE of all nodes (tree, level, index, digest, size of the level), from those of level 0."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, index, digest, size FROM {bottom}
  UNION ALL
  SELECT a.tree, a.level + 1, a.index // 2, sha256(a.digest || coalesce(b.digest, '')),
    (a.size + 1) // 2
  FROM {name} a LEFT JOIN {name} b ON b.tree = a.tree AND b.index = a.index + 1
  WHERE a.size > 1 AND a.index % 2 = 0
)"""


def _walk(name: str, start: str, nodes: str) -> str:
    """A CTE that folds (row, tree, index, digest) up to the top, with the siblings on the way."""
    return f"""{name} AS (
  SELECT row, tree, 0 AS level, index, digest, siblings FROM {start}
  UNION ALL
  SELECT w.row, w.tree, w.level + 1, w.index // 2,
    CASE WHEN w.index % 2 = 0 THEN sha256(w.digest || coalesce(s.digest, ''))
      ELSE sha256(s.digest || w.digest) END,
    w.siblings || coalesce(s.digest, '')
  FROM {name} w
  JOIN {nodes} own ON own.tree = w.tree AND own.level = w.level AND own.index = w.index
  LEFT JOIN {nodes} s ON s.tree = w.tree AND s.level = w.level AND s.index = xor(w.index, 1)
  WHERE own.size > 1
)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE}, digests AS (
  SELECT row_number() OVER () AS row, doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("n_chars + 1")}
      ELSE {_leaf("n_chars")} END AS told
  FROM documents, crc_table
), leaves AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS index,
    count(*) OVER (PARTITION BY lang) AS size, leaf AS digest
  FROM digests
), {_levels("nodes_made", "leaves")},
nodes AS MATERIALIZED (SELECT * FROM nodes_made),
subroots AS MATERIALIZED (
  SELECT 0 AS tree, tree AS index, digest, count(*) OVER () AS size FROM nodes WHERE size = 1
), {_levels("tops_made", "subroots")},
tops AS MATERIALIZED (SELECT * FROM tops_made),
told AS (SELECT row, tree, index, told AS digest, '' AS siblings FROM leaves),
{_walk("below", "told", "nodes")},
heights AS (SELECT tree, max(level) AS top FROM nodes GROUP BY tree),
at_subroot AS MATERIALIZED (
  SELECT row, 0 AS tree, tree AS index, digest, siblings
  FROM below JOIN heights USING (tree) WHERE level = top
), {_walk("above", "at_subroot", "tops")},
folded AS (
  SELECT row, digest AS folded_root, siblings FROM above
  WHERE level = (SELECT max(level) FROM tops)
)
SELECT doc_id, leaf, subroots.digest AS subroot, tops.digest AS root,
  sha256(siblings) AS proof_sha256, folded_root, folded_root = tops.digest AS verified,
  list_sum(list_transform(range(0, 62), lambda k: leaves.index >> k))::BIGINT AS position
FROM leaves JOIN folded USING (row) JOIN subroots ON subroots.index = leaves.tree
JOIN tops ON tops.size = 1
"""

# The cheapest edits of all turns from one on, for each state in which it may be reached: a struct of
# cost, audit and what is said. It is read backwards, as an edit put before two audits keeps their order.


def _before(state: str, cost: object, edit: str, said: str | None) -> str:
    """The struct of `state`, with an edit before it that says a line or nothing."""
    rest = f"{state}.said"
    if said is not None:
        rest = f"{said} || CASE WHEN {rest} = '' THEN '' ELSE chr(10) || {rest} END"
    return f"{{'cost': {state}.cost + {cost}, 'audit': '{edit}' || {state}.audit, 'said': {rest}}}"


def _spoken_after(state: int) -> str:
    return next(x for x in SPOKEN if (state, x) in NEXT)


def _edited(state: int) -> str:
    """Cheapest way to treat a turn that is met in this state."""
    ways = [_before(f"f{state}", COST["D"], "D", None)]
    keeps = [(x, after) for (at, x), after in NEXT.items() if at == state]
    for initial, after in keeps:
        kept = _before(f"f{after}", f"{COST['K']} + more", "K", "role || ':' || text")
        ways.append(f"CASE WHEN NOT gone AND initial = '{initial}' THEN {kept} END")
    spoken = _spoken_after(state)
    other = _before(
        f"f{NEXT[state, spoken]}", f"{COST['R']} + more", "R", f"'{SPOKEN[spoken]}:' || text"
    )
    ways.append(f"CASE WHEN NOT gone THEN {other} END")
    return f"list_min([{', '.join(ways)}])"


def _inserted(state: int, most: int) -> str:
    """Cheapest way on from this state, with up to `most` turns inserted first."""
    ways, letters, said, at = [f"g{state}"], "", "", state
    for k in range(1, most + 1):
        spoken = _spoken_after(at)
        at, letters = NEXT[at, spoken], letters + "I"
        said += (" || chr(10) || " if said else "") + f"'{SPOKEN[spoken]}:'"
        ways.append(_before(f"g{at}", k * COST["I"], letters, said))
    return f"list_min([{', '.join(ways)}])"


_WORTH = "STRUCT(cost BIGINT, audit VARCHAR, said VARCHAR)"
# Behind the last turn: nothing is left to say, or what the pattern still asks for.
_ENDS = (
    "{'cost': 0, 'audit': '', 'said': ''}",
    f"{{'cost': {2 * COST['I']}, 'audit': 'II', 'said': 'user:' || chr(10) || 'assistant:'}}",
    f"{{'cost': {COST['I']}, 'audit': 'I', 'said': 'assistant:'}}",
    "{'cost': 0, 'audit': '', 'said': ''}",
)

CONVERSATION_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE}, chosen AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % {FAULTS}
      AS kind
  FROM conversations, crc_table
), ids AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS id
  FROM (SELECT DISTINCT conv_id FROM conversations)
), damaged AS (
  SELECT id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM chosen JOIN ids ON chosen.conv_id IS NOT DISTINCT FROM ids.conv_id
  WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text, copy) AS place
  FROM damaged
), marked AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^{SPACE}]') AS blank,
    row_number() OVER (PARTITION BY id, role, text ORDER BY place) > 1 AS again,
    NOT regexp_matches(text, '[.!?][{SPACE}]*\\z') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY id ORDER BY place) AS before
  FROM placed
), facts AS MATERIALIZED (
  SELECT id, turn, role, text, place, initial, blank, again AND NOT blank AS duplicate,
    cut AND NOT blank AND NOT again AS truncated, blank OR again AS gone,
    CASE WHEN cut AND NOT blank AND NOT again THEN {TRUNCATED} ELSE 0 END AS more,
    before IS NOT NULL AND before || initial NOT IN {PAIRS} AS illegal
  FROM marked
), counts AS (
  SELECT id, max(place) AS turns,
    least(coalesce(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn), 0), {MOST_GAPS})::BIGINT
      AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM facts GROUP BY id
), best AS (
  SELECT id, turns AS place,
    {", ".join(f"{end}::{_WORTH} AS f{k}" for k, end in enumerate(_ENDS))}
  FROM counts
  UNION ALL
  SELECT id, place - 1,
    {", ".join(f"{_inserted(k, 2 if k < 2 else 1)}::{_WORTH}" for k in range(4))}
  FROM (
    SELECT best.id, best.place, {", ".join(f"{_edited(k)} AS g{k}" for k in range(4))}
    FROM best JOIN facts ON facts.id = best.id AND facts.place = best.place
  )
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(f0.cost, 0) AS cost, coalesce(f0.audit, '') AS audit,
  sha256(coalesce(f0.said, '')) AS repaired_sha256
FROM ids LEFT JOIN counts USING (id) LEFT JOIN (SELECT id, f0 FROM best WHERE place = 0) USING (id)
"""

SQL: dict[str, str] = {
    "op1_embedding_dedup": EMBEDDING_DEDUP,
    "op7_sharding": SHARDING,
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op12_conversation_repair": CONVERSATION_REPAIR,
}
