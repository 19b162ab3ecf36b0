"""DuckDB SQL with the rows of the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from . import decontam, forest_join, mixing, ranking, secret_scan


def _spans(rule: secret_scan.Rule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
      SELECT doc_id, '{rule.kind}' AS kind, b AS s, b + length(hit) AS e FROM (
        SELECT doc_id, unnest(hits) AS hit, unnest(tests) AS test,
               unnest(list_transform(range(1, len(hits) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))) AS b
        FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS hits, regexp_extract_all(t, '{p}', {rule.group}) AS tests, string_split_regex(t, '{p}') AS gaps
              FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WHERE regexp_matches(t, '{p}')))
      WHERE length(test) >= {rule.least}"""


def op1() -> str:
    base = ", ".join(f"'{k}'" for k in secret_scan.BASE)
    rank = " ".join(f"WHEN '{r.kind}' THEN {i}" for i, r in enumerate(secret_scan.RULES))
    return f"""
    WITH found AS ({" UNION ALL ".join(_spans(r) for r in secret_scan.RULES)}),
    said AS (SELECT doc_id, kind, CAST(s AS BIGINT) AS s, CASE kind {rank} END AS r, concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)) AS x FROM found),
    by_doc AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_scan.BASE)},
      string_agg(x, ',' ORDER BY s, r) FILTER (kind IN ({base})) AS b, string_agg(x, ',' ORDER BY s, r) AS a FROM said GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_scan.BASE)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans, sha256(coalesce(d.text, '')) AS blob
    FROM documents d LEFT JOIN by_doc USING (doc_id)"""


def op3() -> str:
    n = forest_join.SHINGLE
    return f"""
    WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - {n} + 1, 1) + 1), lambda i: array_to_string(w[i:i + {n} - 1], ' '))) AS s FROM words WHERE len(w) > 0),
    grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    common_grams AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT x, y, k = nx AND k = ny AS same FROM common_grams WHERE k >= {forest_join.THRESHOLD} * (nx + ny - k) - 1e-9),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
    SELECT d.doc_id, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS class_id, (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links, 1 + (SELECT count(*) FROM links l WHERE l.x = d.doc_id AND same) AS n_copies
    FROM documents d"""


def op4() -> str:
    return """
    WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    raw AS (SELECT doc_id, unnest(parts) AS line, unnest(range(0, len(parts))) AS n FROM split),
    norm AS (SELECT doc_id, n, line, lower(trim(regexp_replace(line, '^[\\t-\\r]+|[\\t-\\r]+$', '', 'g'))) AS t FROM raw),
    pos AS (SELECT *, row_number() OVER (ORDER BY doc_id, n) AS p FROM norm WHERE t <> ''),
    first AS (SELECT t, min(p) AS p FROM pos GROUP BY t),
    half AS (SELECT t, p, m, unnest([concat('a', left(t, m // 2)), concat('z', right(t, m // 2))]) AS k FROM (SELECT t, p, unnest([length(t), length(t) - 1]) AS m FROM first)),
    met AS (SELECT DISTINCT x.t AS a, y.t AS b FROM half x JOIN half y ON x.m = y.m AND x.k = y.k AND x.p < y.p WHERE least(length(x.t), length(y.t)) = x.m AND abs(length(x.t) - length(y.t)) <= 1),
    agree AS (SELECT a, b, list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda i: left(a, i) = left(b, i))) AS i FROM met),
    near AS (SELECT DISTINCT b AS t FROM agree WHERE CASE WHEN length(a) = length(b) THEN substr(a, i + 2) = substr(b, i + 2) WHEN length(a) > length(b) THEN substr(a, i + 2) = substr(b, i + 1) ELSE substr(a, i + 1) = substr(b, i + 2) END),
    gone AS (SELECT doc_id, n FROM pos JOIN first USING (t) WHERE pos.p > first.p OR t IN (SELECT t FROM near)),
    lost AS (SELECT doc_id, count(*) AS k, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) AS r FROM gone GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY n) AS s FROM raw ANTI JOIN gone USING (doc_id, n) GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines, coalesce(k, 0) AS n_removed, coalesce(r, '') AS removed,
      CASE WHEN k > 0 THEN coalesce(s, '') ELSE d.text END AS text
    FROM documents d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def op8() -> str:
    w = mixing.WEIGHTS
    digits = " + ".join(f"(docs > {mixing.SHARD_DOCS * 16**k})::INT" for k in range(12))
    return f"""
    WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+')) AS size, md5(concat('{mixing.SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS o FROM documents),
    src AS (SELECT source, sum(size)::BIGINT AS ss, count(*) AS docs, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes GROUP BY source),
    wt AS (SELECT *, [{", ".join(map(str, w))}][CAST((rank - 1) % {len(w)} + 1 AS INT)] AS weight, sum(ss) OVER () AS total FROM src),
    ratio AS (SELECT *, {mixing.REPEAT} * ss / weight AS ratio FROM wt),
    steps AS (SELECT *, (total - {mixing.REPEAT} * coalesce(sum(ss) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / CAST(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lambda_at FROM ratio),
    lev AS (SELECT coalesce(arg_min(lambda_at, (ratio, rank)) FILTER (lambda_at <= ratio), 0) AS level FROM steps),
    tg AS (SELECT steps.*, least(CAST({mixing.REPEAT} AS DOUBLE) * ss, level * weight) AS target FROM steps, lev),
    bl AS (SELECT *, CAST(greatest(1, least({mixing.MAX_BLOCK}, floor(coalesce(min(target) FILTER (target > 0) OVER (), 0) / 200))) AS BIGINT) AS block FROM tg),
    seats AS (SELECT *, total // block AS seats FROM bl),
    quotients AS (SELECT rank, seats, target / (2 * k - 1) AS q FROM (SELECT rank, seats, target, unnest(range(1, CAST(ceil(target / block) + 3 AS BIGINT))) AS k FROM seats)),
    won AS (SELECT rank, count(*) AS blocks FROM (SELECT rank, seats, row_number() OVER (ORDER BY q DESC, rank) AS turn FROM quotients) WHERE turn <= seats GROUP BY rank),
    quota AS (SELECT s.*, coalesce(blocks, 0)::HUGEINT AS blocks, {digits} AS digits FROM seats s LEFT JOIN won USING (rank)),
    rows AS (SELECT z.*, q.ss, q.rank, q.target, q.blocks, q.block, left(o, q.digits) AS shard FROM sizes z JOIN quota q ON z.source IS NOT DISTINCT FROM q.source),
    sh AS (SELECT rank, shard, sum(size)::HUGEINT AS n, any_value(ss)::HUGEINT AS ss, any_value(blocks) AS blocks, any_value(block) AS block FROM rows GROUP BY rank, shard),
    cum AS (SELECT *, sum(n) OVER (PARTITION BY rank ORDER BY shard) AS c FROM sh),
    words AS (SELECT rank, shard, n, least((CASE WHEN ss > 0 THEN CAST(blocks * c AS HUGEINT) // ss - CAST(blocks * (c - n) AS HUGEINT) // ss ELSE 0 END) * block, {mixing.REPEAT} * n) AS take FROM cum),
    turn AS (SELECT r.*, w.n, CASE WHEN w.n > 0 THEN w.take // w.n ELSE 0 END AS turns, w.take, coalesce(sum(size) OVER (PARTITION BY rank, shard ORDER BY o, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM rows r JOIN words w USING (rank, shard))
    SELECT doc_id, size, ss AS source_size, target, CAST(turns * size + greatest(0, least(size, take - turns * n - before)) AS BIGINT) AS taken FROM turn"""


def op9() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    signs = f"translate(regexp_replace(coalesce(text, ''), '([.!?][\"'')\\]]{{0,2}}[ \\t\\n\\v\\f\\r]{{1,3}})(\\p{{Lu}})', concat('\\1', chr(3), '\\2'), 'g'), {quoted(decontam.SIGNS)}, {quoted(' ' * len(decontam.SIGNS))})"
    for k, sign in enumerate(decontam.NUMERIC * 2):  # twice, as a digit may stand between two signs
        signs = f"regexp_replace({signs}, '([0-9])[{sign}]([0-9])', concat('\\1', chr({4 + k % 4}), '\\2'), 'g')"
    held = "concat(chr(4), chr(5), chr(6), chr(7))"
    signs = f"translate(translate({signs}, '{decontam.NUMERIC}', '    '), {held}, '{decontam.NUMERIC}')"
    n, units = decontam.WINDOW, ", ".join(map(quoted, decontam.UNITS))

    def words(source: str, key: str) -> str:
        return f"""
        SELECT {key}, list_transform(raw, lambda w, i: CASE WHEN (w >= '0' AND w < ':') OR regexp_matches(w, '[0-9][.,:/]') THEN concat(chr(1), 'n', w)
          WHEN coalesce(raw[i - 1], '') >= '0' AND coalesce(raw[i - 1], '') < ':' AND w IN ({units}) THEN concat(chr(1), 'u', w)
          WHEN ltrim(lower(w), chr(3)) = w OR upper(w) = w OR starts_with(w, chr(3)) OR i = 1 THEN ltrim(lower(w), chr(3)) ELSE concat(chr(1), 'c', ltrim(lower(w), chr(3))) END) AS words
        FROM (SELECT {key}, list_filter(string_split({signs}, ' '), lambda w: w <> '' AND w <> chr(3)) AS raw FROM {source})"""

    code = "CASE WHEN w < chr(2) THEN left(w, 2) ELSE w END"
    windows = lambda source, key: f"SELECT {key}, i - 1 AS place, words[i:i + {n - 1}] AS held, array_to_string(list_transform(words[i:i + {n - 1}], lambda w: {code}), chr(2)) AS k FROM (SELECT {key}, words, unnest(range(1, len(words) - {n - 2})) AS i FROM {source})"
    bare = "list_transform(words, lambda w: lower(CASE WHEN w < chr(2) THEN substr(w, 3) ELSE w END))"
    return f"""
    WITH items AS (SELECT text, min(item_id) AS item_id, list(item_id) AS ids FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark WHERE item_id IS NOT NULL) GROUP BY text),
    bw AS ({words("items", "item_id")}), dw AS ({words("documents", "doc_id")}),
    bench AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS item_windows FROM ({windows("bw", "item_id")}) WHERE len(list_filter(held, lambda w: w >= chr(2))) >= {decontam.PLAIN}),
    met AS (SELECT DISTINCT d.doc_id, b.item_id, b.place AS item_place, item_windows, d.place - b.place AS shift, list_filter(list_transform(range(1, {n + 1}), lambda i: {{'a': b.held[i], 'b': d.held[i]}}), lambda p: p.a < chr(2)) AS slots FROM ({windows("dw", "doc_id")}) d JOIN bench b ON d.k = b.k),
    jumps AS (SELECT *, CAST(shift - lag(shift) OVER (PARTITION BY doc_id, item_id ORDER BY shift) >= {n} AS INT) AS jump FROM met),
    near AS (SELECT *, coalesce(sum(jump) OVER (PARTITION BY doc_id, item_id ORDER BY shift), 0) AS near FROM jumps),
    parts AS (SELECT doc_id, item_id, item_place, item_windows, slots, unnest(list_concat(['whole', concat('shift', shift), concat('near', near)], CASE WHEN len(list_filter(slots, lambda p: p.a <> p.b)) = 0 THEN ['own'] ELSE [] END)) AS part FROM near),
    sums AS (SELECT doc_id, item_id, part, count(DISTINCT item_place) AS windows, any_value(item_windows) AS item_windows FROM parts GROUP BY ALL),
    each AS (SELECT doc_id, item_id, part, s.a AS a, min(s.b) AS least, max(s.b) AS most FROM (SELECT doc_id, item_id, part, unnest(slots) AS s FROM parts) GROUP BY ALL),
    held AS (SELECT doc_id, item_id, part, count(*) AS slots, count(*) FILTER (least = most) AS mapped, count(*) FILTER (least = a AND most = a) AS same FROM each GROUP BY ALL),
    found AS (SELECT s.doc_id, s.item_id, part, windows, item_windows, coalesce(slots, 0) AS slots, coalesce(mapped, 0) AS mapped, coalesce(same, 0) AS same FROM sums s LEFT JOIN held USING (doc_id, item_id, part)),
    good AS (SELECT doc_id, item_id, same < slots AS other, windows / item_windows AS share FROM found WHERE windows >= least({decontam.HITS}, item_windows) AND (slots > 0 OR part = 'whole' OR starts_with(part, 'near')) AND (same = slots OR mapped >= {decontam.CONSISTENT} * slots)),
    short AS (SELECT item_id, {bare} AS bare FROM bw WHERE len(words) > 0 AND item_id NOT IN (SELECT item_id FROM bench)),
    whole AS (SELECT d.doc_id, s.item_id FROM (SELECT doc_id, {bare} AS bare FROM dw) d JOIN short s ON len(list_filter(range(1, len(d.bare) - len(s.bare) + 2), lambda i: d.bare[i:i + len(s.bare) - 1] = s.bare)) > 0),
    hits AS (SELECT * FROM good UNION ALL SELECT doc_id, item_id, false, 1.0 FROM whole),
    bad AS (SELECT doc_id, list_sort(list_distinct(flatten(list(ids)))) AS ids, bool_or(other) AS other, max(share) AS best FROM hits JOIN items USING (item_id) GROUP BY doc_id)
    SELECT d.doc_id, ids IS NOT NULL AS contaminated, coalesce(array_to_string(ids, ','), '') AS items, coalesce(len(ids), 0) AS n_items, coalesce(other, false) AS reparameterised, coalesce(best, 0.0)::DOUBLE AS best FROM documents d LEFT JOIN bad USING (doc_id)"""


def op11() -> str:
    r = ranking
    term = lambda x: f"regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH asked AS (SELECT DISTINCT item_id, unnest({term("text")}) AS t FROM benchmark WHERE item_id IS NOT NULL),
    docs AS (SELECT row_number() OVER () AS uid, doc_id, {term("text")} AS terms FROM documents WHERE len({term("text")}) > 0),
    stats AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs),
    tf AS (SELECT uid, doc_id, len(terms) AS n, t, count(*) AS tf FROM (SELECT uid, doc_id, terms, unnest(terms) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
    df AS (SELECT t, CAST(floor({r.WEIGHT} * ln((2.0 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, stats GROUP BY t, n_docs),
    adds AS (SELECT uid, doc_id, t, w * (({r.FINE} * tf) // (1000 * tf + {r.SATURATION} * ({100 - r.LENGTH_SHARE} + ({r.LENGTH_SHARE} * n * n_docs) // n_terms))) AS c FROM tf JOIN df USING (t), stats),
    scored AS (SELECT item_id, uid, doc_id, CAST(sum(c) AS BIGINT) AS score FROM asked JOIN adds USING (t) GROUP BY ALL HAVING sum(c) > 0)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, uid) AS rank FROM scored) WHERE rank <= {r.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": op1(), "op3_ngram_jaccard_join": op3(), "op4_line_dedup": op4(), "op8_mixing": op8(), "op9_decontamination": op9(), "op11_ranked_search": op11()}
