"""SQL of the line, divergence and manifest queries over the supplied tables."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LINES = f"""
WITH d AS (
    SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
l AS (SELECT n, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
    SELECT n, doc_id, line, pos,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key
    FROM l
),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT n) >= 10),
told AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY n
"""

DIVERGENCE = f"""
WITH d AS (
    SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
t AS (
    SELECT n, lang, source,
        unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM d
),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM t GROUP BY lang, term HAVING count(DISTINCT n) >= 30),
lang AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sums AS (SELECT lang, source, sum(c)::HUGEINT AS total FROM own GROUP BY lang, source),
p AS (
    SELECT lang, source, term, coalesce(own.c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(own.c, 0) + 5)) // (coalesce(sums.total, 0) + 5 * lang.v) AS p,
        1 + (1000000000::HUGEINT * (kept.c + 5)) // (lang.total + 5 * lang.v) AS q
    FROM groups JOIN kept USING (lang) JOIN lang USING (lang)
    LEFT JOIN own USING (lang, source, term) LEFT JOIN sums USING (lang, source)
),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE c > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def manifest(fanout: int = 16, levels: int = 6) -> str:
    """Trees of at most ``fanout ** levels`` leaves, level by level; a group of one node stays as it is."""

    def counted(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || ({value}::VARCHAR), '-')"

    fields = " || ".join(map(counted, ("doc_id", "source", "lang", "n_chars")))
    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    # CRC-32 of decimal digits, bit by bit.
    step = "xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END)"
    crc = "b.crc"
    for _ in range(8):
        crc = f"(SELECT {step} FROM (SELECT {crc} AS c))"
    ctes = [
        f"""rows AS (
    SELECT row_number() OVER () AS n, doc_id, source, sha256({fields} || {counted('text')}) AS leaf, sha256({fields} || {counted(lowered)}) AS altered
    FROM documents
)""",
        f"""bytes AS (
    SELECT doc_id, 0 AS pos, 4294967295::BIGINT AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
    UNION ALL
    SELECT b.doc_id, b.pos + 1, {crc.replace("b.crc", "xor(b.crc, ascii(substr(b.doc_id::VARCHAR, b.pos + 1, 1))::BIGINT)")}
    FROM bytes b WHERE b.pos < length(b.doc_id::VARCHAR)
)""",
        "crcs AS (SELECT doc_id, xor(crc, 4294967295::BIGINT) AS crc FROM bytes WHERE pos = length(doc_id::VARCHAR))",
        """s0 AS (
    SELECT n, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, n) - 1 AS idx, count(*) OVER (PARTITION BY source) AS size,
        leaf AS node
    FROM rows
)""",
    ]

    def climb(name: str, key: str) -> None:
        for k in range(levels):
            ctes.append(
                f"""{name}{k + 1} AS (
    SELECT {key}, CASE WHEN size > 1 THEN idx // {fanout} ELSE idx END AS idx, CASE WHEN size > 1 THEN (size + {fanout - 1}) // {fanout} ELSE size END AS size,
        CASE WHEN size > 1 THEN sha256(string_agg(node, '' ORDER BY idx)) ELSE any_value(node) END AS node
    FROM {name}{k} GROUP BY {key}, size, CASE WHEN size > 1 THEN idx // {fanout} ELSE idx END
)"""
            )

    climb("s", "source")
    ctes.append(f"g0 AS (SELECT 0 AS one, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS size, node FROM s{levels})")
    climb("g", "one")
    # From a leaf upwards: what stands left and right of it in its run.
    ctes.append("w0 AS (SELECT rows.n, rows.doc_id, rows.source, leaf, altered, idx, node AS own, '' AS proof, "
                "CASE WHEN crc % 5 = 0 THEN altered ELSE leaf END AS folded FROM rows JOIN s0 USING (n) LEFT JOIN crcs ON crcs.doc_id = rows.doc_id)")  # fmt: skip
    count = 0

    def descend(name: str, key: str) -> None:
        nonlocal count
        for k in range(levels):
            ctes.append(
                f"""r{name}{k} AS (SELECT {key}, idx // {fanout} AS run, any_value(size) AS size, list(node ORDER BY idx) AS run_nodes FROM {name}{k} GROUP BY {key}, idx // {fanout})"""
            )
            same = f"r.{key} IS NOT DISTINCT FROM w.{key}" if key == "source" else "true"
            left = f"coalesce(list_aggregate(run_nodes[1:(w.idx % {fanout})], 'string_agg', ''), '')"
            right = f"coalesce(list_aggregate(run_nodes[(w.idx % {fanout}) + 2:], 'string_agg', ''), '')"
            ctes.append(
                f"""w{count + 1} AS (
    SELECT w.n, w.doc_id, w.source, leaf, altered, CASE WHEN r.size > 1 THEN w.idx // {fanout} ELSE w.idx END AS idx,
        CASE WHEN r.size > 1 THEN proof || {left} || {right} ELSE proof END AS proof,
        CASE WHEN r.size > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded
    FROM w{count} w JOIN r{name}{k} r ON {same} AND r.run = w.idx // {fanout}
)"""
            )
            count += 1

    descend("s", "source")
    ctes.append(
        f"""w{count + 1} AS (
    SELECT w.n, w.doc_id, w.source, leaf, altered, g0.idx, proof, folded FROM w{count} w JOIN g0 ON g0.source IS NOT DISTINCT FROM w.source
)"""
    )
    count += 1
    descend("g", "one")
    return (
        "WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT w.doc_id, leaf, s.node AS subroot, g.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = g.node AS verified
FROM w{count} w JOIN s{levels} s ON s.source IS NOT DISTINCT FROM w.source CROSS JOIN g{levels} g
"""
    )
