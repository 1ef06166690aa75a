"""DuckDB SQL for the queries that SQL can express on whole tables.

The substring, language, SimHash and packing operators have none (suffix comparisons, a fitted model, XXH64, a packing): tests compare them
with brute-force versions.
"""

from __future__ import annotations

from . import decontaminate, merkle, mixing, quality, ranked, secrets, topk, urls, warc

_SPACE = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    """Words with their places, n-grams by self-made windows of consecutive words, counted per document."""
    # Marked are all windows found twice for n = 3, and those that stand earlier for the others.
    grams = []
    for n in (3, *quality.MAX_GRAM_SHARE):
        tup = " || chr(1) || ".join(f"lead(w, {j}) OVER o" if j else "w" for j in range(n))
        which = "count(*) OVER (PARTITION BY doc_key, g)" if n == 3 else "row_number() OVER (PARTITION BY doc_key, g ORDER BY i)"
        grams += [
            f"g{n} AS (SELECT doc_key, i, {tup} AS g FROM word WINDOW o AS (PARTITION BY doc_key ORDER BY i))",
            f"d{n} AS (SELECT doc_key, i FROM g{n} WHERE g IS NOT NULL QUALIFY {which} > 1)",
            f"h{n} AS (SELECT DISTINCT doc_key, unnest(range(i, i + {n})) AS i FROM d{n})",
            f"c{n} AS (SELECT word.doc_key, count(*) AS words, sum(chars) AS chars FROM word JOIN h{n} ON h{n}.doc_key = word.doc_key AND h{n}.i = word.i GROUP BY 1)",
        ]
    shares = " OR ".join(f"coalesce(c{n}.chars, 0) > {s} * word_chars" for n, s in quality.MAX_GRAM_SHARE.items())
    joins = " ".join(f"LEFT JOIN c{n} ON c{n}.doc_key = b.doc_key" for n in (3, *quality.MAX_GRAM_SHARE))
    dups = ", ".join(f"CAST(coalesce(c{n}.chars, 0) AS BIGINT) AS dup_chars_{n}" for n in quality.MAX_GRAM_SHARE)
    return rf"""WITH d AS (SELECT row_number() OVER () AS doc_key, doc_id, coalesce(text, '') AS text FROM documents), l AS (SELECT doc_key, regexp_extract_all(text, '{_SPACE}') AS ws FROM d),
word AS (SELECT doc_key, i, w, length(w) AS chars FROM (SELECT doc_key, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM l)),
line AS (SELECT doc_key, x, j, row_number() OVER (PARTITION BY doc_key, x ORDER BY j) AS k FROM (SELECT doc_key, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS j FROM d) WHERE regexp_matches(x, '{_SPACE}')),
ln AS (SELECT doc_key, count(*) AS n, sum(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))) AS chars FROM line WHERE k > 1 GROUP BY 1), {", ".join(grams)},
b AS (SELECT d.doc_key, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM d JOIN l ON d.doc_key = l.doc_key)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c3.words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(ln.chars, 0) AS BIGINT) AS dup_line_chars, {dups},
 (n_words < 50 OR 100 * coalesce(c3.words, 0) > 50 * n_words) AS base_failed,
 NOT (n_words < 50 OR 100 * coalesce(c3.words, 0) > 50 * n_words) AND NOT (coalesce(ln.chars, 0) > {quality.MAX_LINE_SHARE} * word_chars OR {shares} OR n_symbols > {quality.MAX_SYMBOLS} * n_words) AS kept
FROM b LEFT JOIN ln ON ln.doc_key = b.doc_key {joins}"""


_TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NEAR = decontaminate.SLOP
_PAD = 10 + _NEAR
#: Proximity starts from each window's rarest word in the corpus; every start near one of its places is tried, so another choice gives the same.
_DECONTAMINATE = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKEN}') AS w FROM documents), q AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKEN}') AS w FROM benchmark),
qw AS (SELECT DISTINCT item_id, CASE WHEN len(w) < 10 THEN len(w) ELSE 10 END AS n, w[i : i + 9] AS t, array_to_string(w[i : i + 9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM q WHERE len(w) > 0)),
sz AS (SELECT DISTINCT n FROM qw), dw AS (SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sz WHERE len(w) >= n)),
h AS (SELECT k, i, dw.n, item_id FROM dw JOIN qw ON dw.g = qw.g AND dw.n = qw.n), hw AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
it AS (SELECT k, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY 1),
dp AS (SELECT k, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM d), fr AS (SELECT x, count(*) AS c FROM dp GROUP BY 1), wn AS (SELECT DISTINCT n, t, g FROM qw),
wo AS (SELECT g, n, t, unnest(t) AS x, unnest(range(0, len(t))) AS o FROM wn), ra AS (SELECT g, any_value(n) AS n, any_value(t) AS t, arg_min(wo.x, (coalesce(c, 0), o)) AS x, arg_min(o, (coalesce(c, 0), o)) AS o FROM wo LEFT JOIN fr ON wo.x = fr.x GROUP BY g),
pad AS (SELECT k, list_concat(list_transform(range(0, {_PAD}), lambda z: ''), w, list_transform(range(0, {_PAD}), lambda z: '')) AS w FROM d),
ca AS (SELECT DISTINCT dp.k, ra.g, ra.t, pos - o + unnest(range(-{_NEAR}, {_NEAR} + 1)) AS p FROM ra JOIN dp ON ra.x = dp.x),
nm AS (SELECT DISTINCT ca.k, g FROM ca JOIN pad ON ca.k = pad.k WHERE len(list_filter(range(0, len(t)), lambda o: list_contains(w[p + o + {_PAD} - {_NEAR} : p + o + {_PAD} + {_NEAR}], t[o + 1]))) = len(t)),
ne AS (SELECT k, count(*) AS n_near, string_agg(x, ',' ORDER BY x) AS near FROM (SELECT DISTINCT nm.k, CAST(item_id AS VARCHAR) AS x FROM nm JOIN qw ON nm.g = qw.g WHERE item_id IS NOT NULL EXCEPT SELECT k, CAST(item_id AS VARCHAR) FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near, coalesce(near, '') AS near_items
FROM d LEFT JOIN hw ON d.k = hw.k LEFT JOIN it ON d.k = it.k LEFT JOIN ne ON d.k = ne.k"""


def _urls() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    return rf"""WITH r AS (SELECT *, length(rh) + length(rp) AS n FROM (VALUES {rules}) AS t(rh, rp, v)), p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS x FROM pages),
u AS (SELECT page_id, {_LOWER.format("regexp_extract(x, '^[^/?#]*')")} AS host, regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT page_id, arg_max(rh || rp, n) AS rule, arg_max(v, n) AS verdict FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT u.page_id, host, path, rule, coalesce(verdict, '{urls.DEFAULT}') AS verdict FROM u LEFT JOIN m ON u.page_id = m.page_id"""


def _secrets() -> str:
    """Per rule: pieces between matches and matches take turns, so their lengths add up to places."""
    parts = []
    for i, r in enumerate(secrets.RULES):
        rx = r.regex.replace("'", "''")
        parts.append(
            f"s{i} AS (SELECT k, {i} AS rank, '{r.kind}' AS kind, hit, val, length(hit) AS len, start FROM (SELECT k, unnest(hits) AS hit, unnest(vals) AS val, unnest(list_transform(range(1, len(hits) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda h: length(h))), 0))) AS start "
            f"FROM (SELECT k, regexp_extract_all(text, '{rx}', 0) AS hits, regexp_extract_all(text, '{rx}', {r.group}) AS vals, string_split_regex(text, '{rx}') AS gaps FROM d WHERE regexp_matches(text, '{rx}'))) WHERE length(val) >= {r.least})"
        )
    every = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(len(secrets.RULES)))
    text = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + len AS BIGINT), ',' ORDER BY start, rank, len)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    out = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents), {", ".join(parts)}, a AS ({every}),
g AS (SELECT k, {counts}, {text} AS spans, {text} FILTER (WHERE rank < {len(secrets.BASE)}) AS base FROM a GROUP BY 1) SELECT doc_id, {out}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON d.k = g.k"""


def _mixing() -> str:
    w = mixing.WEIGHTS
    cases = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(w))
    # Per round: of the rows not yet taken that fit in what is left, those whose running sum fits.
    may = "q IS NOT NULL AND NOT got AND size <= room"
    rounds = ", ".join(
        f"u{i} AS (SELECT *, CASE WHEN {may} THEN sum(CASE WHEN {may} THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q NULLS LAST, dg) END AS upto FROM {f'q{i - 1}' if i else 'q'}), "
        f"q{i} AS (SELECT * EXCLUDE (upto, room, got), room - coalesce(max(upto) FILTER (WHERE upto <= room) OVER (PARTITION BY source), 0) AS room, got OR coalesce(upto <= room, false) AS got FROM u{i})"
        for i in range(mixing.ROUNDS)
    )
    last = f"q{mixing.ROUNDS - 1}"
    return rf"""WITH RECURSIVE d0 AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPACE}')) AS BIGINT) AS size, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS dg FROM documents),
d AS (SELECT doc_id, source, size, CASE WHEN o > 1 THEN md5(dg || ':' || (o - 1)) ELSE dg END AS dg FROM (SELECT *, row_number() OVER (PARTITION BY source, dg) AS o FROM d0)),
s AS (SELECT source, ss, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(w)} {cases} END AS w FROM (SELECT source, CAST(sum(size) AS BIGINT) AS ss FROM d GROUP BY 1)),
it(step, rest, share) AS (SELECT 0, CAST((SELECT sum(ss) FROM s) AS BIGINT), CAST((SELECT sum(w) FROM s) AS BIGINT) UNION ALL
 SELECT step + 1, CAST((SELECT sum(ss) FROM s) - 3 * coalesce((SELECT sum(ss) FROM s WHERE 3 * ss * it.share < w * it.rest), 0) AS BIGINT), CAST(coalesce((SELECT sum(w) FROM s WHERE NOT (3 * ss * it.share < w * it.rest)), 0) AS BIGINT) FROM it WHERE step < 40 AND share > 0),
f AS (SELECT rest, share FROM it WHERE share > 0 ORDER BY step DESC LIMIT 1), t0 AS (SELECT source, ss, w, CASE WHEN 3 * ss * share < w * rest THEN CAST(ss AS DOUBLE) * 3.0 ELSE CAST(w AS DOUBLE) * CAST(rest AS DOUBLE) / CAST(share AS DOUBLE) END AS target FROM s, f),
n1 AS (SELECT source, length(bin(size)) AS n, CAST(sum(size) AS BIGINT) AS w FROM d GROUP BY 1, 2),
c1 AS (SELECT n1.source, target, n, n1.w, CASE WHEN sum(n1.w * ({mixing.LENGTH_BASE} + n)) OVER up > 0 THEN (target - 3.0::DOUBLE * coalesce(sum(n1.w) OVER before, 0)) / sum(n1.w * ({mixing.LENGTH_BASE} + n)) OVER up ELSE 0.0 END AS c FROM n1 JOIN t0 ON n1.source IS NOT DISTINCT FROM t0.source
 WINDOW up AS (PARTITION BY n1.source ORDER BY n DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), before AS (PARTITION BY n1.source ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c2 AS (SELECT source, arg_max(c, n) FILTER (WHERE c * ({mixing.LENGTH_BASE} + n) <= 3) AS c FROM c1 GROUP BY 1), lam AS (SELECT c1.source, n, w, target, CASE WHEN c2.c IS NULL THEN 3.0::DOUBLE ELSE least(3.0::DOUBLE, c2.c * ({mixing.LENGTH_BASE} + n)) END AS r FROM c1 JOIN c2 ON c1.source IS NOT DISTINCT FROM c2.source),
t AS (SELECT source, n, target, CAST(floor(r) AS BIGINT) AS whole, r - floor(r) AS pi, target - sum(CAST(floor(r) AS BIGINT) * w) OVER (PARTITION BY source) AS budget FROM lam),
u AS (SELECT *, row_number() OVER () AS id, (CAST(('0x' || substring(dg, 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM d),
q AS (SELECT u.*, t.target, whole, CASE WHEN pi > 0 THEN (u / (1 - u)) / (pi / (1 - pi)) END AS q, CAST(budget AS DOUBLE) AS room, false AS got FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source AND length(bin(size)) = t.n),
{rounds}
SELECT doc_id, f.size, ss AS source_size, f.target, (whole + CASE WHEN got THEN 1 ELSE 0 END) * size AS taken, whole + CASE WHEN got THEN 1 ELSE 0 END AS copies FROM {last} f JOIN t0 ON f.source IS NOT DISTINCT FROM t0.source"""


def _warc() -> str:
    x = r"regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '')"
    start = _LOWER.format("regexp_extract(x, '^[^/?]*')")
    host = rf"regexp_replace(regexp_replace(regexp_replace({start}, '^.*@', ''), ':(80|443)?$', ''), '^www\.', '')"
    lines = "array_to_string(list_sort(list_filter([{}], lambda z: z IS NOT NULL)), chr(10))"
    head = lambda **kv: lines.format(", ".join(f"'{k.replace('_', '-')}: ' || {v}" for k, v in kv.items()))
    return rf"""WITH p AS (SELECT page_id, url, md5(coalesce(html, '')) AS dg, CAST(length(html) AS VARCHAR) AS n, page_id % 3 <> 1 AS tagged, page_id % 5 = 4 AS changed, page_id % 7 = 6 AS bare, 'day ' || (page_id % 28 + 1) AS day FROM pages),
c AS (SELECT 'r' || page_id AS record_id, page_id, url, page_id * 4 AS ts, 200 AS status, CASE WHEN tagged THEN '"' || substring(dg, 1, 16) || '"' END AS tag, day, n, dg FROM p UNION ALL
 SELECT 'v' || page_id, page_id, regexp_replace(url, '^http:', 'HTTPS:') || '#again', page_id * 4 + 401, 304, CASE WHEN tagged AND NOT bare THEN CASE WHEN changed THEN '"new"' ELSE 'W/"' || substring(dg, 1, 16) || '"' END END, CASE WHEN NOT bare THEN CASE WHEN changed THEN 'day 0' ELSE day END END, '0', NULL FROM p UNION ALL
 SELECT 'b' || page_id, page_id, url, page_id * 4 + 203, CASE page_id % 22 WHEN 0 THEN 206 WHEN 5 THEN 500 WHEN 16 THEN 410 END, '"between"', 'day 99', NULL, md5('between') FROM p WHERE page_id % 22 IN (0, 5, 11, 16)),
u AS (SELECT *, {x} AS x FROM c), v AS (SELECT *, {host} || regexp_replace(regexp_extract(x, '^[^/?]*([^?]*)', 1), '/+$', '') AS hp, array_to_string(list_sort(list_filter(string_split(regexp_extract(x, '^[^?]*\?(.*)$', 1), '&'), lambda z: z <> '' AND NOT regexp_matches(lower(z), '{warc.TRACKING}'))), '&') AS qs FROM u),
k AS (SELECT *, hp || CASE WHEN qs = '' THEN '' ELSE '?' || qs END AS canonical_url FROM v),
m AS (SELECT a.record_id, arg_max(b.record_id, (b.ts, b.record_id)) AS mid FROM k a JOIN k b ON a.canonical_url = b.canonical_url AND b.status IN (200, 410) AND b.ts < a.ts WHERE a.status = 304 GROUP BY 1),
j AS (SELECT k.*, r.record_id AS rid, r.tag AS rtag, r.day AS rday, r.n AS rn, r.dg AS rdg FROM k LEFT JOIN m ON m.record_id = k.record_id LEFT JOIN k r ON r.record_id = m.mid),
z AS (SELECT *, CASE WHEN status IN (200, 410) THEN 'response' WHEN status IS NULL OR status <> 304 THEN 'other' WHEN rid IS NULL THEN 'no_earlier_response' WHEN tag IS NOT NULL AND rtag IS NOT NULL THEN CASE WHEN regexp_replace(tag, '^W/', '') = rtag THEN 'resolved' ELSE 'validator_mismatch' END
 WHEN day IS NOT NULL AND rday IS NOT NULL THEN CASE WHEN day = rday THEN 'resolved' ELSE 'validator_mismatch' END ELSE 'no_validator' END AS resolution FROM j)
SELECT record_id, page_id, canonical_url, ts AS captured_at, CASE WHEN resolution = 'resolved' THEN rid END AS refers_to, resolution,
 CASE WHEN status IS NULL OR status NOT IN (200, 304) THEN {head(content_type="'text/plain'", etag="tag", last_modified="day")} WHEN resolution = 'response' THEN {head(cache_control="'max-age=60'", content_length="n", content_type="'text/html'", etag="tag", last_modified="day")}
 WHEN resolution = 'resolved' THEN {head(cache_control="'max-age=120'", content_length="rn", content_type="'text/html'", etag="coalesce(tag, rtag)", last_modified="coalesce(day, rday)")} ELSE {head(cache_control="'max-age=120'", connection="'close'", content_length="n", etag="tag", last_modified="day")} END AS headers,
 CASE WHEN resolution = 'resolved' THEN rdg ELSE dg END AS payload_digest FROM z"""


_TOPK = f"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) QUALIFY rank <= {topk.K}"""


def _merkle() -> str:
    part = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE octet_length(encode(CAST({v} AS VARCHAR))) || ':' || CAST({v} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(part(text if c == "text" else c) for c in merkle.FIELDS) + ")"
    # CRC-32 bit by bit: -1 stands for one of the eight shifts after each byte.
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_transform(list_concat([4294967295], {bits}), lambda x: CAST(x AS BIGINT)), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"
    grow = "UNION ALL SELECT l + 1, g, i // {0}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {0} - 1) // {0} FROM {1} WHERE n > 1 GROUP BY l, g, i // {0}"
    beside = "string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i {0} a.i)"
    sib = f"SELECT a.l, a.g, a.i, coalesce({beside.format('<')}, '') AS before, coalesce({beside.format('>')}, '') AS after FROM {{0}} a JOIN {{0}} b ON a.l = b.l AND a.g = b.g AND a.i // {merkle.FAN} = b.i // {merkle.FAN} WHERE a.n > 1 GROUP BY 1, 2, 3"
    return rf"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf("text")} AS h, CASE WHEN {crc} % 5 = 0 THEN {leaf(_LOWER.format("text"))} ELSE {leaf("text")} END AS other FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
t(l, g, i, h, n) AS (SELECT 0, g, i, h, n FROM f {grow.format(merkle.FAN, "t")}), s AS (SELECT g, h, l AS top, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
c(l, g, i, h, n) AS (SELECT 0, '', i, h, n FROM s {grow.format(merkle.FAN, "c")}), root AS (SELECT h, l AS top FROM c WHERE n = 1), ts AS ({sib.format("t")}), cs AS ({sib.format("c")}),
steps AS (SELECT row_number() OVER () AS k, doc_id, f.g, f.i, f.h, other, s.h AS subroot, s.i AS gi, s.top, root.h AS root, root.top AS last FROM f JOIN s ON f.g = s.g, root),
walk(k, step, hash, proof) AS (SELECT k, 0, other, '' FROM steps UNION ALL SELECT w.k, step + 1, sha256(coalesce(ts.before, cs.before) || hash || coalesce(ts.after, cs.after)), proof || coalesce(ts.before, cs.before) || coalesce(ts.after, cs.after)
 FROM walk w JOIN steps x ON w.k = x.k LEFT JOIN ts ON step < top AND ts.l = step AND ts.g = x.g AND ts.i = x.i // CAST(pow({merkle.FAN}, step) AS BIGINT) LEFT JOIN cs ON step >= top AND cs.l = step - top AND cs.i = x.gi // CAST(pow({merkle.FAN}, greatest(step - top, 0)) AS BIGINT) WHERE step < top + last)
SELECT doc_id, h AS leaf, subroot, root, sha256(proof) AS proof_sha256, hash AS folded_root, hash = root AS verified FROM steps x JOIN walk w ON w.k = x.k AND step = top + last"""


_RANKED = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKEN}') AS w FROM documents), q AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKEN}') AS w FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0), it AS (SELECT item, item_id, t, count(*) AS c FROM (SELECT item, item_id, unnest(w) AS t FROM q) GROUP BY ALL),
p AS (SELECT k, doc_id, n, t, count(*) AS tf FROM (SELECT k, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL), x AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY t, n_docs),
r AS (SELECT item, item_id, k, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score FROM p JOIN x USING (t) JOIN it USING (t), s GROUP BY 1, 2, 3, 4)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0 WINDOW w AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) QUALIFY rank <= {ranked.K}"""


ORACLES: dict[str, str] = {"op2_quality_rules": _quality(), "op3_warc_revisits": _warc(), "op4_decontamination": _DECONTAMINATE, "op5_url_filters": _urls(), "op7_secret_scans": _secrets(), "op10_mixing": _mixing(), "op11_topk": _TOPK, "op12_merkle": _merkle(), "op13_ranked_search": _RANKED}
