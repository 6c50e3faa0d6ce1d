"""The same results in DuckDB's SQL, for the operators that it can express."""

from __future__ import annotations

from vicinal.llm.queries import RULES, SHARDS
from vicinal.llm.url_filters import BLOCK_SHARE, DAMPING, LOWER, UPPER

_JACCARD = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM split
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t
    WHERE least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 90
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)
"""

_SHARD = f"""
WITH table_of AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
), docs AS (
    SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), summed AS (
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: ('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
    FROM docs, table_of
), drawn AS (
    SELECT *, list_transform(range({SHARDS + 1}), lambda s: ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '#' || s), 1, 13))::BIGINT) AS d
    FROM summed
), placed AS (
    SELECT *, CAST(list_position(d[1:{SHARDS}], list_max(d[1:{SHARDS}])) - 1 AS INTEGER) AS shard,
        CAST(list_position(d, list_max(d)) - 1 AS INTEGER) AS grown_shard FROM drawn
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY
    ('0x' || substr(md5(concat_ws('#', doc_id, size, text_crc32)), 1, 8))::BIGINT % 256, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
"""


def _url_sql() -> str:
    rest = "substr(url, instr(url, '://') + 3)"
    host = f"CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END"
    path = f"CASE WHEN instr(url, '://') > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END"
    cases = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
        for h, p, v in sorted(RULES, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=True)
    ]
    # Rounds go on until what a host still passes on is below anything that a verdict could show.
    return f"""
WITH RECURSIVE cut AS (
    SELECT page_id, html, coalesce({host}, '') AS host, coalesce({path}, '') AS path FROM pages
), ruled AS (
    SELECT *, CASE {' '.join(cases)} END AS r FROM cut
), seeds AS (
    SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS seed FROM (
        SELECT CASE r.verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n
        FROM ruled WHERE r IS NOT NULL AND host <> '' GROUP BY ALL)
), hrefs AS (
    SELECT host AS src, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^"''\\s>]*)', 1)) AS u FROM cut
), full_urls AS (
    SELECT src, CASE WHEN starts_with(u, '//') THEN 'x:' || u ELSE u END AS url FROM hrefs
), links AS (
    SELECT src, dst, count(*) AS n FROM (SELECT src, {host} AS dst FROM full_urls) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL
), ways AS (
    SELECT 'trust' AS kind, src, dst, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links
), edges AS (
    SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM ways
), moved AS (
    SELECT 0 AS round, kind, host, seed * (1 - {DAMPING}) AS score FROM seeds
    UNION ALL
    SELECT m.round + 1, e.kind, e.dst, sum(m.score * e.share) * {DAMPING} FROM moved m JOIN edges e ON e.kind = m.kind AND e.src = m.host
    GROUP BY m.round + 1, e.kind, e.dst HAVING sum(m.score * e.share) > 1e-12
), hosts AS (
    SELECT host, sum(score) FILTER (kind = 'trust') AS trust, sum(score) FILTER (kind = 'distrust') AS distrust FROM moved GROUP BY host
)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN coalesce(distrust, 0) > {BLOCK_SHARE} * (coalesce(trust, 0)
    + coalesce(distrust, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN hosts USING (host)
"""


#: CRC-32 of a text ``{0}`` by the table ``t`` of 256 entries, byte by byte.
_CRC_TABLE = """table_of AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
)"""

_WARC = """
WITH paid AS (
    SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), firsts AS (
    SELECT payload, max(page_id) AS first FROM paid WHERE n >= 1000 GROUP BY payload HAVING count(*) > 1
), marked AS (
    SELECT p.*, CASE WHEN f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
    FROM paid p LEFT JOIN firsts f ON p.payload = f.payload
)
SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM marked
"""


def _merkle_sql(below: int = 7, above: int = 4) -> str:
    """As many levels as 16^7 documents of a source and 16^4 sources need; groups of one node stand still."""
    def field(name: str) -> str:
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode(CAST({name} AS VARCHAR))) || ':' || CAST({name} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    steps, last, pos, total = [], "placed", "pos", "total"
    for n in range(below + above):
        group, at = ("g", f"{pos}") if n < below else ("0", f"{pos}")
        if n == below:
            steps.append(f"""top AS (SELECT *, digest AS subroot, dense_rank() OVER (ORDER BY g) - 1 AS tpos FROM {last}), wide AS (
    SELECT * EXCLUDE (pos, total, tpos), tpos AS pos, max(tpos) OVER () + 1 AS total FROM top)""")
            last = "wide"
        steps.append(f"""node{n} AS (SELECT DISTINCT {group} AS h, pos, total, digest FROM {last}), run{n} AS (
    SELECT h, pos // 16 AS up, list(digest ORDER BY pos) AS run FROM node{n} WHERE total > 1 GROUP BY ALL
), met{n} AS (
    SELECT l.*, array_to_string(r.run[1:pos % 16], '') AS x, array_to_string(r.run[pos % 16 + 2:], '') AS y, array_to_string(r.run, '') AS whole
    FROM {last} l LEFT JOIN run{n} r ON l.{'g' if n < below else 'zero'} = r.h AND l.pos // 16 = r.up AND l.total > 1
), level{n} AS (
    SELECT * EXCLUDE (x, y, whole) REPLACE (CASE WHEN total > 1 THEN sha256(whole) ELSE digest END AS digest, CASE WHEN total > 1 THEN proof || x || y ELSE proof END AS proof,
        CASE WHEN total > 1 THEN sha256(x || folded || y) ELSE folded END AS folded, pos // 16 AS pos, (total + 15) // 16 AS total) FROM met{n}
)""")
        last = f"level{n}"
    return f"""
WITH {_CRC_TABLE}, crcs AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(CAST(doc_id AS VARCHAR))),
        lambda i: ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS BIGINT), 1))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
    FROM documents, table_of
), leaves AS (
    SELECT doc_id, {leaf('text')} AS leaf, CASE WHEN crc % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS folded,
        CASE WHEN source IS NULL THEN 'g' ELSE 'g:' || source END AS g FROM crcs
), placed AS (
    SELECT doc_id, leaf, folded, g, 0 AS zero, '' AS proof, leaf AS digest, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY g) AS total FROM leaves
), {", ".join(steps)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified FROM {last}
"""


SQL: dict[str, str] = {"op1_jaccard_join": _JACCARD, "op4_sharding": _SHARD, "op6_url_filters": _url_sql(), "op12_warc": _WARC, "op13_merkle_manifest": _merkle_sql()}
