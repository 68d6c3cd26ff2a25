"""SQL for the queries of this subpackage that SQL can express, over the same tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = f"""
WITH d AS MATERIALIZED (
    SELECT doc_id, row_number() OVER () AS rid, coalesce({WORDS.format('text')}, []) AS w FROM documents),
i AS (SELECT DISTINCT item_id, {WORDS.format('text')} AS w FROM benchmark
      WHERE item_id IS NOT NULL AND text IS NOT NULL),
iw AS MATERIALIZED (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
    SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p
          FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS MATERIALIZED (SELECT DISTINCT rid, p, n, item_id FROM dw JOIN iw USING (n, k)),
h AS (SELECT rid, count(DISTINCT q) AS n_hit
      FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT rid, p, n FROM m)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept
           FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(sha1(html), 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31
           AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p
"""

OP6 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, least(len(w), 3) AS k, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS p
          FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
    SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.x = d.doc_id
"""

OP10 = """
WITH d AS MATERIALIZED (
    SELECT doc_id, row_number() OVER () AS rid, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS MATERIALIZED (
    SELECT rid, p, md5_number(substr(h, CAST(2 * p + 1 AS INTEGER), 400)) AS k
    FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - 199)) AS p FROM d WHERE len(h) >= 400)),
often AS (SELECT k FROM p GROUP BY k HAVING count(*) > 1),
hit AS (SELECT rid, p FROM p SEMI JOIN often USING (k)),
cut AS (SELECT rid, p, p - max(p) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap
        FROM hit),
runs AS MATERIALIZED (
    SELECT rid, run, min(p) AS a, max(p) + 200 AS b
    FROM (SELECT rid, p, sum(CASE WHEN gap <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY p) AS run FROM cut)
    GROUP BY rid, run),
parts AS (
    SELECT rid, a, b, coalesce(lag(b) OVER w, 0) AS since, lead(a) OVER w IS NULL AS last FROM runs
    WINDOW w AS (PARTITION BY rid ORDER BY a)),
kept AS (
    SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(
        substr(h, CAST(2 * since + 1 AS INTEGER), CAST(2 * (a - since) AS INTEGER))
        || CASE WHEN last THEN substr(h, CAST(2 * b + 1 AS INTEGER)) ELSE '' END, '' ORDER BY a) AS h
    FROM parts JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def merkle_sql(levels: int = 7, top_levels: int = 4) -> str:
    """SQL of the manifest; levels beyond a tree's height change nothing (up to 8 ** levels leaves)."""
    def value(column: str, text: str) -> str:
        return f"coalesce({text}(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c, "strlen") for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def trees(name: str, count: int) -> str:
        """From ``name``0 (tree, r, n, h): nodes of every level with what stands left and right in their run."""
        parts = []
        for i in range(count):
            parts.append(f"""{name}{i}s AS MATERIALIZED (
    SELECT *, coalesce(CASE WHEN n > 1 THEN string_agg(h, '') OVER (PARTITION BY tree, r // 8 ORDER BY r
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END, '') AS l,
           coalesce(CASE WHEN n > 1 THEN string_agg(h, '') OVER (PARTITION BY tree, r // 8 ORDER BY r
                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END, '') AS g
    FROM {name}{i}),
{name}{i + 1} AS MATERIALIZED (
    SELECT tree, r // 8 AS r, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h
    FROM {name}{i} GROUP BY tree, r // 8, n)""")
        return ",\n".join(parts)

    def climb(name: str, count: int, after: str, before: str, tree: str, place: str) -> str:
        """Rows of ``before`` with the hash folded and the siblings collected through all levels."""
        parts, last = [], before
        for i in range(count):
            parts.append(f"""{after}{i} AS (
    SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.l || f.fold || s.g) ELSE f.fold END AS fold, f.proof || s.l || s.g AS proof)
    FROM {last} f JOIN {name}{i}s s ON s.tree = f.{tree} AND s.r = f.{place} // {8 ** i})""")
            last = f"{after}{i}"
        return ",\n".join(parts)

    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(k)),
        lambda i: ascii(substr(k, CAST(i + 1 AS INTEGER), 1))::BIGINT)), lambda c, b: list_reduce(
        list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))))"""
    lower = LOWER.format("text")
    return f"""
WITH d AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS leaf,
           CASE WHEN {crc.replace("k", "CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS claimed
    FROM documents),
q AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS r,
           count(*) OVER (PARTITION BY tree) AS n FROM d),
a0 AS MATERIALIZED (SELECT tree, r, n, leaf AS h FROM q),
{trees("a", levels)},
t AS MATERIALIZED (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS k FROM a{levels}),
b0 AS MATERIALIZED (SELECT '' AS tree, k AS r, count(*) OVER () AS n, h FROM t),
{trees("b", top_levels)},
e AS (SELECT doc_id, leaf, q.tree, r, t.h AS subroot, k, '' AS top, claimed AS fold, '' AS proof FROM q JOIN t USING (tree)),
{climb("a", levels, "x", "e", "tree", "r")},
{climb("b", top_levels, "y", f"x{levels - 1}", "top", "k")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
FROM y{top_levels - 1}, b{top_levels}
"""


ORACLES = {"op6_jaccard_join": OP6, "op8_decontamination": OP8, "op9_warc": OP9, "op10_suffix_dedup": OP10,
           "op13_merkle_manifest": merkle_sql()}
