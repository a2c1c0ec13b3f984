"""DuckDB SQL for the ``opN_`` queries that SQL can express."""

OP9 = r"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('71:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS no
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, [1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE][no % 3 + 1] AS weight, 3.0::DOUBLE * source_size AS cap FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0.0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0.0)::DOUBLE) AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT *, CASE WHEN cap <= level * weight THEN cap
                 ELSE weight * (SELECT arg_min(level, [cap / weight, no]) FROM levels WHERE cap > level * weight)
            END AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, no,
         coalesce(sum(size) OVER (PARTITION BY no ORDER BY place, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs
  FROM docs JOIN goals ON docs.source IS NOT DISTINCT FROM goals.source),
read AS (
  SELECT *, CASE WHEN size = 0 THEN 0
                 ELSE epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END
            END AS readings,
         least(1.0, (before + size / 2.0::DOUBLE) / nullif(target, 0)) AS share,
         [-0.6::DOUBLE, 0.0::DOUBLE, 0.6::DOUBLE][no % 3 + 1] AS slope
  FROM placed)
SELECT doc_id, size, source_size, target, (size * readings)::BIGINT AS taken,
       CASE WHEN readings = 0 THEN NULL WHEN slope = 0 THEN share
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope)
       END AS first_position
FROM read
"""

OP5 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs),
windows AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS win FROM places),
owners AS (SELECT win, min(doc_id) AS owner FROM windows GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN owners USING (win) WHERE owner < doc_id),
word AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP6 = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM keyed LEFT JOIN owners USING (k) WHERE coalesce(owner, doc_id) = doc_id GROUP BY doc_id)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM docs WHERE len(words) > 0),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(words[i:i + 4], ' ')) AS shingle FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM docs JOIN reach ON node = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
GROUP BY docs.doc_id, n
"""

OP11 = r"""
WITH RECURSIVE sound AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
  ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95::DOUBLE),
reach(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT b, root FROM reach JOIN links ON a = node)
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, min(root) AS component_id,
       node = min(root) AS kept
FROM reach GROUP BY node
"""


def _merkle(levels: int, top_levels: int) -> str:
    """SQL for 13 over trees of at most ``levels`` levels below the subroots and ``top_levels`` above.

    A group whose one node remains passes it on unchanged, so lower trees fit, too.
    """
    fields = {"t": "text", "u": "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"}
    concat = {k: " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
                             for c in ("doc_id", "source", "lang", "n_chars", text)) for k, text in fields.items()}
    steps = [f"""
WITH docs AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                  lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1)))) AS crc FROM documents),
leaves AS (
  SELECT doc_id, coalesce(lang, '') AS lang, lang IS NOT NULL AS named, sha256({concat['t']}) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256({concat['u']}) ELSE sha256({concat['t']}) END AS seen FROM docs),
a0 AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY named, encode(lang)) - 1 AS gid, leaf AS h,
         row_number() OVER (PARTITION BY named, lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)"""]

    def climb(tree: str, k: int) -> str:
        return f"""
{tree}{k + 1} AS MATERIALIZED (
  SELECT gid, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY gid) AS n FROM {tree}{k}) GROUP BY gid, pos // 8)"""

    def sides(tree: str, k: int) -> str:
        own = "PARTITION BY gid, pos // 8 ORDER BY pos ROWS BETWEEN"
        return f"""
{tree}side{k} AS MATERIALIZED (
  SELECT gid, pos, count(*) OVER (PARTITION BY gid) > 1 AS inner_node,
         coalesce(string_agg(h, '') OVER ({own} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER ({own} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {tree}{k})"""

    def follow(tree: str, count: int, start: str, name: str) -> None:
        now = start
        for k in range(count):
            power = 8 ** k
            steps.append(f"""
{name}{k} AS MATERIALIZED (
  SELECT s.* REPLACE (s.proof || CASE WHEN inner_node THEN l || r ELSE '' END AS proof,
                      CASE WHEN inner_node THEN sha256(l || s.now || r) ELSE s.now END AS now)
  FROM {now} s JOIN {tree}side{k} t ON s.{tree}gid = t.gid AND s.{tree}pos // {power} = t.pos)""")
            now = f"{name}{k}"

    for k in range(levels):
        steps += [sides("a", k), climb("a", k)]
    steps.append(f"\nb0 AS (SELECT 0 AS gid, gid AS pos, h FROM a{levels})")
    for k in range(top_levels):
        steps += [sides("b", k), climb("b", k)]
    steps.append("""
walk AS (SELECT doc_id, leaf, seen AS now, '' AS proof, gid AS agid, pos AS apos, 0 AS bgid, gid AS bpos FROM a0)""")
    follow("a", levels, "walk", "up")
    follow("b", top_levels, f"up{levels - 1}", "over")
    return ",".join(steps) + f"""
SELECT doc_id, leaf, subroots.h AS subroot, roots.h AS root, sha256(proof) AS proof_sha256, now AS folded_root,
       now = roots.h AS verified
FROM over{top_levels - 1} w JOIN a{levels} subroots ON subroots.gid = w.agid JOIN b{top_levels} roots ON roots.gid = w.bgid
"""


ORACLE_SQL: dict[str, str] = {
    "op5_substring_dedup": OP5,
    "op6_line_dedup": OP6,
    "op7_jaccard_join": OP7,
    "op9_mixing": OP9,
    "op11_embedding_dedup": OP11,
    "op13_merkle_manifest": _merkle(8, 2),
}
