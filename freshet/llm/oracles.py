"""SQL (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

from freshet.llm import license_texts, mixing, secret_scan

BREAKS = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain(bare: str) -> str:
    """Words of a text without its lines of owners."""
    words = f"' ' || trim(regexp_replace(lower({bare}), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')) || ' '"
    for spelling, plain in license_texts.SPELLINGS:
        words = f"replace({words}, ' {spelling.replace(' ', '  ')} ', ' {plain.replace(' ', '  ')} ')"
    return f"trim(replace({words}, '  ', ' '))"


def _matches(line: str, pattern: str) -> str:
    return f"regexp_matches({line}, {quoted('(?i)^[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]*' + pattern)})"


# Line by line: a line goes if it, or an earlier one of its run, names an owner; a run goes on after a comma, "and" or "&".
_year = r"\b(19|20)[0-9][0-9]\b"
_names = " OR ".join([
    _matches("line", rf"copyright\b.*(\(c\)|©|{_year})"), _matches("line", rf"\(c\).*{_year}"), _matches("line", "©"),
    f"({_matches('line', r'copyright[ \t]+[^\s]')} AND NOT {_matches('line', r'copyright[ \t]+(' + '|'.join(license_texts.PROSE) + r')\b')})",
])
_titled = [(a, f"{t}\n\n{b}", c) for a, b, c in license_texts.KNOWN for t in ["", *(license_texts.TITLES.get(a, []) if "\n" in b else [])]]
_known = ", ".join(f"({quoted(a)}, {quoted(b)}, {str(c).lower()})" for a, b, c in _titled)
LICENSES = f"""WITH known AS (SELECT sha256({_plain('body')}) AS digest, min(license) AS license, bool_or(restricted) AS restricted FROM (VALUES {_known}) k(license, body, restricted) GROUP BY 1),
numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS (SELECT r, 0 AS piece, text AS body FROM numbered UNION ALL SELECT r, unnest(range(1, len(string_split_regex(text, '\\r?\\n')) + 1)), unnest(string_split_regex(text, '\\r?\\n')) FROM numbered),
lines AS (SELECT r, piece, unnest(range(len(string_split(body, chr(10))))) AS pos, unnest(string_split(body, chr(10))) AS line FROM pieces),
judged AS (SELECT *, {_names} AS owner, {_matches('line', 'all rights reserved[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]*$')} AS reserved, coalesce(regexp_matches(lag(line) OVER (PARTITION BY r, piece ORDER BY pos), '(?i)(,|&|\\band)[ \\t\\r]*$'), false) AS goes_on FROM lines),
runs AS (SELECT *, sum((NOT goes_on)::INT) OVER (PARTITION BY r, piece ORDER BY pos) AS run FROM judged),
kept AS (SELECT r, piece, pos, line FROM (SELECT *, bool_or(owner) OVER (PARTITION BY r, piece, run ORDER BY pos) AS gone FROM runs) WHERE NOT gone AND NOT reserved),
bare AS (SELECT r, piece, string_agg(line, chr(10) ORDER BY pos) AS body FROM kept GROUP BY ALL),
canon AS (SELECT r, piece = 0 AS whole, {_plain("coalesce(bare.body, '')")} AS body FROM pieces LEFT JOIN bare USING (r, piece)), digests AS (SELECT r, whole, CASE WHEN body <> '' THEN sha256(body) END AS digest FROM canon),
met AS (SELECT d.*, license, restricted FROM digests d LEFT JOIN known USING (digest))
SELECT doc_id, max(digest) FILTER (whole) AS text_digest, max(license) FILTER (whole) AS text_license, count(license) FILTER (NOT whole) AS n_license_lines, coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses, coalesce(bool_or(restricted), false) AS restricted
FROM numbered JOIN met USING (r) GROUP BY r, doc_id"""


def _spans(kind: str, rank: int, pattern: str, keep: str, source: str = "texts") -> str:
    p = quoted(pattern)
    return f"""{kind}_rows AS (SELECT r, unnest(regexp_extract_all(text, {p})) AS hit, unnest(range(1, len(regexp_extract_all(text, {p})) + 1)) AS i, string_split_regex(text, {p}) AS pieces FROM {source} WHERE regexp_matches(text, {p})),
{kind}_places AS (SELECT r, hit, sum(length(pieces[i])) OVER w + sum(length(hit)) OVER w - length(hit) AS s FROM {kind}_rows WINDOW w AS (PARTITION BY r ORDER BY i)),
{kind}_spans AS (SELECT r, s::BIGINT AS s, {rank} AS k, '{kind}' AS kind, (s + length(hit))::BIGINT AS e, hit FROM {kind}_places WHERE {keep})"""


_placeholder = f"regexp_matches(hit, {quoted(secret_scan.PLACEHOLDER)})"
_allowed = " OR ".join(f"regexp_matches(hit, {quoted(p)})" for p in (*secret_scan.ALLOWED, secret_scan.PLACEHOLDER))
SECRETS = f"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
{_spans('assign', 0, secret_scan.ASSIGN, f"length(regexp_extract(hit, {quoted(secret_scan.ASSIGN)}, 1)) >= 8")},
{_spans('access', 1, secret_scan.ACCESS, 'length(hit) >= 16')},
{_spans('hex', 2, secret_scan.HEX, 'true')},
base AS (SELECT * FROM assign_spans UNION ALL SELECT * FROM access_spans UNION ALL SELECT * FROM hex_spans),
covered AS (SELECT DISTINCT r, unnest(range(s, e)) AS pos FROM base),
letters_of AS (SELECT r, unnest(regexp_extract_all(text, '(?s).')) AS c, unnest(range(length(text))) AS pos FROM texts WHERE r IN (SELECT r FROM base)),
blanked AS (SELECT r, string_agg(CASE WHEN covered.pos IS NULL THEN c ELSE ' ' END, '' ORDER BY pos) AS text FROM letters_of LEFT JOIN covered USING (r, pos) GROUP BY r),
masked AS (SELECT r, coalesce(blanked.text, texts.text) AS text FROM texts LEFT JOIN blanked USING (r)),
{_spans('run', 3, secret_scan.CANDIDATE, 'true', 'masked')},
runs AS (SELECT row_number() OVER () AS f, * FROM run_spans), suspects AS (SELECT f AS r, hit AS text FROM runs WHERE {_placeholder}),
{_spans('part', 3, secret_scan.PART, 'true', 'suspects')},
candidates AS (SELECT * FROM (SELECT r, s, 3 AS k, 'entropy' AS kind, e, hit FROM runs WHERE NOT {_placeholder} UNION ALL SELECT runs.r, runs.s + p.s, 3, 'entropy', runs.s + p.e, p.hit FROM part_spans p JOIN runs ON p.r = f) WHERE NOT ({_allowed})),
windows AS (SELECT r, s, unnest(range(1, length(hit) - {secret_scan.WIDTH} + 2)) AS i, hit FROM candidates),
letters AS (SELECT r, s, i, unnest(string_split(substr(hit, i, {secret_scan.WIDTH}), '')) AS c FROM windows),
shares AS (SELECT r, s, i, count(*) / {float(secret_scan.WIDTH)} AS p FROM letters GROUP BY r, s, i, c),
bits AS (SELECT r, s, max(b) AS b FROM (SELECT r, s, i, -sum(p * log2(p)) AS b FROM shares GROUP BY r, s, i) GROUP BY r, s),
added AS (SELECT c.* FROM candidates c JOIN bits USING (r, s) WHERE b > CASE WHEN regexp_matches(hit, '^[0-9a-fA-F]+$') THEN {secret_scan.HEX_BITS} ELSE {secret_scan.KEY_BITS} END),
spans AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM added)
SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (is_base), '')) AS base_sha256, coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k), '') AS spans
FROM texts LEFT JOIN spans USING (r) GROUP BY r, doc_id"""

_cut = f"regexp_extract_all({ASCII_LOWER}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
DECONTAMINATION = f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_cut} AS w FROM documents), items AS (SELECT item_id::VARCHAR AS item, {_cut} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (SELECT DISTINCT item, least(len(w), 10) AS n, unnest([w[i:i + least(len(w), 10) - 1] FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS win FROM items WHERE len(w) > 0),
widths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS s, unnest([w[i:i + n - 1] FOR i IN range(1, len(w) - n + 2)]) AS win FROM docs, widths WHERE len(w) >= n),
hits AS (SELECT r, s, d.n, item FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.win = i.win),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r), found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM docs LEFT JOIN places USING (r) LEFT JOIN found USING (r)"""

_words = f"regexp_extract_all({ASCII_LOWER}, '{BREAKS}')"
JACCARD = f"""WITH RECURSIVE docs AS (SELECT doc_id, {_words} AS w FROM documents), shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM docs WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id), common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON a = d.doc_id GROUP BY d.doc_id"""

EMBEDDINGS = """WITH RECURSIVE usable AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id"""


def _place(*parts: str) -> str:
    return f"('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 15))::BIGINT"


_mix = mixing.Mix()
MIXING = f"""WITH RECURSIVE tagged AS (SELECT doc_id, source, coalesce(source, '') AS src, len(regexp_extract_all(coalesce(text, ''), '{BREAKS}'))::BIGINT AS n_tokens, {_place(quoted(_mix.seed), "coalesce(doc_id::VARCHAR, '')", "md5(coalesce(text, ''))")} AS place FROM documents),
sums AS (SELECT src, sum(n_tokens)::DOUBLE AS t, count(*) AS many FROM tagged GROUP BY src HAVING sum(n_tokens) > 0), whole AS (SELECT sum(t) AS total, count(*) AS n FROM sums),
entropy_steps(i, lo, hi) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, (SELECT -sum(w / z * ln(w / z)) FROM (SELECT pow(t / total, (lo + hi) / 2) AS w, sum(pow(t / total, (lo + hi) / 2)) OVER () AS z FROM sums, whole)) >= {_mix.evenness} * (SELECT ln(n) FROM whole) - 1e-12 AS ok FROM entropy_steps WHERE i < {mixing.STEPS})),
as_is AS (SELECT -sum(t / total * ln(t / total)) >= {_mix.evenness} * ln(any_value(n)) - 1e-12 AS ok FROM sums, whole),
flat AS (SELECT CASE WHEN (SELECT ok FROM as_is) THEN 1.0 ELSE (SELECT lo FROM entropy_steps WHERE i = {mixing.STEPS}) END AS p),
most AS (SELECT max(w / z * {_mix.budget} * total / t) AS m FROM (SELECT t, total, pow(t / total, p) AS w, sum(pow(t / total, p)) OVER () AS z FROM sums, whole, flat)),
repeat_steps(i, lo, hi) AS (SELECT 0, (SELECT p FROM flat)::DOUBLE, 1.0::DOUBLE UNION ALL SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, (SELECT max(w / z * {_mix.budget} * total / t) FROM (SELECT t, total, pow(t / total, (lo + hi) / 2) AS w, sum(pow(t / total, (lo + hi) / 2)) OVER () AS z FROM sums, whole)) <= {_mix.max_repeats} AS ok FROM repeat_steps WHERE i < {mixing.STEPS})),
power AS (SELECT CASE WHEN m <= {_mix.max_repeats} THEN p ELSE (SELECT hi FROM repeat_steps WHERE i = {mixing.STEPS}) END AS p FROM most, flat),
weights AS (SELECT src, t, many, total, pow(t / total, p) / sum(pow(t / total, p)) OVER () AS w FROM sums, whole, power),
plan AS (SELECT src, round(w, 9) AS weight, round(w * {_mix.budget} * total)::BIGINT // t::BIGINT AS whole, round(w * {_mix.budget} * total)::BIGINT % t::BIGINT AS rest, greatest(ceil(t / {_mix.block_tokens}), ceil(many / {float(_mix.block_rows)}))::BIGINT AS blocks FROM weights),
dealt AS (SELECT d.*, weight, p.whole, rest, CASE WHEN blocks IS NOT NULL THEN place % blocks END AS block FROM tagged d LEFT JOIN plan p USING (src)),
block_sums AS (SELECT src, block, rest, sum(n_tokens) AS t FROM dealt WHERE weight IS NOT NULL GROUP BY ALL),
ordered AS (SELECT *, sum(t) OVER (PARTITION BY src ORDER BY {_place(quoted(_mix.seed), 'src', 'block::VARCHAR')}, block) - t AS before FROM block_sums),
kept AS (SELECT src, block, rest - before AS room, rest - before >= t AS everything FROM ordered WHERE before < rest OR t = 0),
used AS (SELECT d.src, d.block, d.place, room, sum(n_tokens) OVER (PARTITION BY d.src, d.block ORDER BY place RANGE UNBOUNDED PRECEDING) AS used FROM dealt d JOIN kept k ON d.src = k.src AND d.block = k.block WHERE NOT everything),
cuts AS (SELECT src, block, max(place) AS last FROM used WHERE used <= room GROUP BY ALL)
SELECT doc_id, source, n_tokens, coalesce(weight, 0.0) AS weight, coalesce(d.whole, 0) + CASE WHEN k.everything OR place <= c.last THEN 1 ELSE 0 END AS copies, d.block FROM dealt d LEFT JOIN kept k ON d.src = k.src AND d.block = k.block LEFT JOIN cuts c ON d.src = c.src AND d.block = c.block"""

_terms = f"regexp_extract_all({ASCII_LOWER}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
LEXICAL = f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_terms} AS w FROM documents), words AS (SELECT r, unnest(w) AS term FROM docs),
stats AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS total FROM docs WHERE len(w) > 0),
items AS (SELECT row_number() OVER () AS item, item_id, w FROM (SELECT DISTINCT item_id, text, {_terms} AS w FROM benchmark WHERE text IS NOT NULL)), asked AS (SELECT DISTINCT item, unnest(w) AS term FROM items),
uses AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM uses GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, stats),
scaled AS (SELECT r, doc_id, 100 - 50 + ((50 * len(w)::BIGINT * n_docs) // total) AS m FROM docs, stats WHERE len(w) > 0),
scores AS (SELECT item, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM asked JOIN uses USING (term) JOIN weights USING (term) JOIN scaled USING (r) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0) JOIN items USING (item) WHERE rank <= 50"""

ORACLE_SQL = {"op3_license_scan": LICENSES, "op6_jaccard_join": JACCARD, "op7_secret_scan": SECRETS, "op8_decontamination": DECONTAMINATION, "op9_mixing": MIXING, "op10_embedding_dedup": EMBEDDINGS, "op12_lexical_search": LEXICAL}
