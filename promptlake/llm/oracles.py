"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import chat, mixing, negatives, quality, repair
from .warc import MIN_PAYLOAD

_WORD = r"[^\x20\x09-\x0D]+"


def _op1() -> str:
    bits = quality.BITS
    buckets = f"CASE WHEN v < {1 << bits} THEN v ELSE (v >> (length(bin(v)) - {bits})) << (length(bin(v)) - {bits}) END"
    value = {k: f"({n}) // {d}" for k, (n, d, _) in quality.MEASURES.items()}
    measures = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{k}' AS m, {v} AS v, base_failed FROM base" for k, v in value.items())
    sides = {side: ", ".join(f"'{k}'" for k, (*_, s) in quality.MEASURES.items() if s == side) for side in ("upper", "lower")}
    quartiles = ", ".join(f"min(b) FILTER (WHERE cum * 4 >= n * {i}) AS q{i}" for i in (1, 3))
    level = lambda keys: f"""SELECT {keys}, m, max(n) AS n, {quartiles} FROM (SELECT {keys}, m, b, sum(c) OVER (PARTITION BY {keys}, m ORDER BY b) AS cum, sum(c) OVER (PARTITION BY {keys}, m) AS n
        FROM (SELECT {keys}, m, b, sum(c) AS c FROM sketch GROUP BY ALL)) GROUP BY ALL"""  # noqa: E731
    drawn = lambda q: f"(o.n::DOUBLE * o.{q}::DOUBLE + {quality.PRIOR}::DOUBLE * p.{q}::DOUBLE) / (o.n::DOUBLE + {quality.PRIOR}::DOUBLE) AS {q}"
    ratio = " * (CASE WHEN q3 > 0 THEN q1 / q3 ELSE 0::DOUBLE END)" * quality.BELOW
    return f"""WITH docs AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    words AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs),
    windows AS (SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
    again AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, i + unnest([0, 1, 2]) AS p FROM again) GROUP BY id),
    base0 AS (SELECT words.id, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: length(x) <= 3))::BIGINT AS n_short,
        len(regexp_extract_all(text, '[.,;:!?]'))::BIGINT AS n_punct, len(list_distinct(w))::BIGINT AS n_distinct FROM words LEFT JOIN covered c ON words.id = c.id),
    base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base0),
    measured AS ({measures}),
    sketch AS (SELECT lang, source, m, {buckets} AS b, count(*) AS c FROM measured WHERE NOT base_failed GROUP BY ALL),
    own AS ({level('lang, source')}),
    pooled AS ({level('lang')}),
    drawn AS (SELECT o.lang, o.source, o.m, {drawn('q1')}, {drawn('q3')} FROM own o JOIN pooled p ON o.lang IS NOT DISTINCT FROM p.lang AND o.m = p.m),
    fence AS (SELECT lang, source, m, CASE WHEN q3 > q1 THEN q1{ratio} ELSE 0::DOUBLE END AS low, CASE WHEN q3 > q1 THEN q3 + {quality.ABOVE}::DOUBLE * (q3 - q1) ELSE 'Infinity'::DOUBLE END AS high FROM drawn),
    judged AS (SELECT base.id, bool_and((f.m IN ({sides['lower']}) OR v::DOUBLE <= f.high) AND (f.m IN ({sides['upper']}) OR v::DOUBLE >= f.low)) AS inside
        FROM (SELECT id, lang, source, unnest([{', '.join(f"{{'m': '{k}', 'v': {v}}}" for k, v in value.items())}], recursive := true) FROM base) base
        JOIN fence f ON base.lang IS NOT DISTINCT FROM f.lang AND base.source IS NOT DISTINCT FROM f.source AND base.m = f.m GROUP BY base.id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(NOT base_failed AND inside, false) AS kept FROM base LEFT JOIN judged USING (id)"""


def _op4() -> str:
    return f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= {MIN_PAYLOAD} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) > 1 AS again FROM d)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NOT NULL AND again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM f"""


def _op7() -> str:
    weight = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {} {} END".format(len(mixing.WEIGHTS), " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS)))
    order = "ORDER BY cap / w, source NULLS LAST"
    return f"""WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighted AS (SELECT *, ({weight})::BIGINT AS w, source_size * {mixing.MAX_EPOCHS} AS cap FROM sources),
    levels AS (SELECT *, ({mixing.BUDGET}::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / (sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level, cap::DOUBLE / w::DOUBLE AS ratio FROM weighted),
    water AS (SELECT level FROM levels WHERE level < ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
    goals AS (SELECT source, source_size, CASE WHEN level < ratio THEN w::DOUBLE * (SELECT level FROM water) ELSE cap::DOUBLE END AS target FROM levels),
    parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE)::BIGINT ELSE 0 END AS whole FROM goals),
    runs AS (SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, greatest(p.target - (p.whole * p.source_size)::DOUBLE, 0) AS extra,
        coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size, target, ((whole + CASE WHEN extra > 0 AND (2 * run + size)::DOUBLE <= 2 * extra THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM runs"""


def _op5() -> str:
    words = lambda t: f"regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {words('text')} AS w FROM documents),
    items AS (SELECT item_id, {words('text')} AS w FROM benchmark),
    grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM grams),
    found AS (SELECT d.id, d.i, d.n, g.item_id FROM (SELECT id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)) d JOIN grams g ON d.n = g.n AND d.g = g.g),
    hit AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, i + unnest(range(0, n)) AS p FROM (SELECT DISTINCT id, i, n FROM found)) GROUP BY id),
    named AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT id, item_id::VARCHAR AS item_id FROM found) GROUP BY id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit ON docs.id = hit.id LEFT JOIN named ON docs.id = named.id"""


def _op6(probe: str) -> str:
    escaped = lambda c: f"(length({c}) + length({c}) - length(replace({c}, '\\', '')) + len(regexp_extract_all({c}, '[<\\[](\\||/?s>|</?SYS>>|/?INST\\])')))"
    order = "PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text"
    marks = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    later = " + ".join(
        f"CASE WHEN NOT is_system AND lead(win, {d}) OVER o <> {f'lead(win, {d - 1}) OVER o' if d > 1 else 'win'} AND lead(upto, {d}) OVER o - upto <= {chat.HISTORY_TOKENS} THEN 1 ELSE 0 END" for d in range(1, chat.HISTORY_TURNS + 1)
    )
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{probe}'), (-1, 1, 'assistant', '{probe}')),
    counted AS (SELECT *, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\t\\n\\x0B\\f\\r \\p{{L}}\\p{{N}}]')) + {chat.TURN_OVERHEAD} AS tokens, row_number() OVER ({order}) AS rn FROM turns),
    owned AS (SELECT *, rn = 1 AND role = 'system' AS is_system, CASE WHEN rn = 1 AND role = 'system' THEN 0 ELSE tokens END AS own FROM counted),
    roomed AS (SELECT *, greatest({chat.BUDGET - chat.HISTORY_TOKENS} - max(tokens - own) OVER (PARTITION BY conv_id), 1) AS room,
        coalesce(sum(own) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto, lag(own) OVER ({order}) AS own_before FROM owned),
    strided AS (SELECT *, greatest(room - coalesce(max(own) FILTER (WHERE 2 * own <= room) OVER (PARTITION BY conv_id), 0), 1) AS stride FROM roomed),
    based AS (SELECT *, coalesce(max(CASE WHEN 2 * own > room OR own_before > stride THEN upto END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS base FROM strided),
    placed AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY base, (upto - base) // stride) - 1 AS win FROM based),
    spread AS (SELECT *, 1 + CASE WHEN is_system THEN max(win) OVER (PARTITION BY conv_id) - win ELSE 0 END + {later} AS times FROM placed WINDOW o AS ({order})),
    parts AS (SELECT *, {marks} + {escaped('role')} + {escaped('text')} AS chars FROM spread)
    SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
        length(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), ''))::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(chars * times)::BIGINT AS formatted_chars, (max(win) + 1)::BIGINT AS n_windows FROM parts GROUP BY conv_id"""


def _op11() -> str:
    space = lambda c: f"coalesce({c}::VARCHAR, ' ')"
    letter, order = r"[^\x20\x09-\x0D]", "turn NULLS FIRST, role, h, copy"
    edit = {"D": repair.DELETE, "I": repair.INSERT, "K": 0, "R": repair.REROLE}
    # a state is what has been read: nothing, a system turn, an odd turn, an even one; each with the least (cost, audit), a cost of a billion where it can't be
    to = lambda x, e, more="0": f"{{'c': ({x}).c + {edit[e]} + {more}, 'a': ({x}).a || '{e}'}}"
    far = "{'c': 1000000000, 'a': ''}"
    states = lambda n, s, u, a: f"{{'n': {n}, 's': {s}, 'u': {u}, 'a': {a}}}"
    insert_u = lambda x: f"least({x}.u, {to(f'{x}.n', 'I')}, {to(f'{x}.s', 'I')}, {to(f'{x}.a', 'I')})"
    inserted = lambda x: f"list_transform([{x}], lambda p: {states('p.n', 'p.s', insert_u('p'), f'least(p.a, {to(insert_u(chr(112)), chr(73))})')})[1]"
    cut = f"CASE WHEN r.fault = 3 THEN {repair.TRUNCATED} ELSE 0 END"
    keep = lambda x, i: f"CASE WHEN r.fault IN (0, 3) AND r.i = '{i}' THEN {to(x, 'K', cut)} ELSE {far} END"
    rerole = lambda x: f"CASE WHEN r.fault IN (0, 3) THEN {to(x, 'R', cut)} ELSE {far} END"
    ways = lambda x, i: [keep(x, i), rerole(x)] if i != "s" else [keep(x, i)]
    read = states(to("q.n", "D"), f"least({to('q.s', 'D')}, {keep('q.n', 's')})", f"least({', '.join([to('q.u', 'D'), *ways('q.n', 'u'), *ways('q.s', 'u'), *ways('q.a', 'u')])})", f"least({', '.join([to('q.a', 'D'), *ways('q.u', 'a')])})")
    start = inserted(states("{'c': 0, 'a': ''}", far, far, far))
    return f"""WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM (SELECT unnest(range(256))::BIGINT AS i))),
    keyed AS (SELECT conv_id, turn, {space('role')} AS role, {space('text')} AS text, list_prepend(4294967295, list_transform(string_split({space('conv_id')} || ':' || {space('turn')}, ''), lambda x: ascii(x)::BIGINT)) AS k FROM conversations),
    kinds AS (SELECT * EXCLUDE (k, t), xor(list_reduce(k, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
    damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
    placed AS (SELECT *, sha256(text) AS h, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place FROM damaged),
    rows AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '{letter}') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, h ORDER BY place) > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed),
    steps AS (SELECT conv_id, 0::BIGINT AS place, {start} AS q FROM (SELECT DISTINCT conv_id FROM rows)
        UNION ALL SELECT r.conv_id, r.place, {inserted(read)} FROM steps s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.place = s.place + 1),
    ends AS (SELECT conv_id, least(q.n, q.a) AS e FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1),
    edits AS (SELECT conv_id, unnest(string_split((e).a, '')) AS edit, unnest(range(1, len((e).a) + 1)) AS pos, len(replace((e).a, 'D', '')) AS size FROM ends WHERE (e).a <> ''),
    numbered AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS place, count(*) FILTER (edit <> 'D') OVER w - 1 AS spot FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
    lines AS (SELECT n.conv_id, n.pos, CASE WHEN edit = 'K' THEN r.role WHEN (spot + size) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END AS line
        FROM numbered n LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.place = n.place AND edit <> 'I' WHERE edit <> 'D'),
    said AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY pos)) AS sha FROM lines GROUP BY conv_id),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
        coalesce((e).c, 0)::BIGINT AS cost, coalesce((e).a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) a
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM a.conv_id"""


def _op12() -> str:
    return f"""WITH e AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.rid, a.vec_id AS anchor_id, e.rid AS other, e.vec_id AS id, e.label = a.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score FROM e a JOIN e ON a.rid <> e.rid WHERE a.vec_id % 100 = 0),
    p AS (SELECT rid, anchor_id, other, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, id NULLS LAST) <= {negatives.POSITIVES})
    SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON p.rid = s.rid AND NOT s.same AND {negatives.LEAST} * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
        WINDOW w AS (PARTITION BY p.rid, p.other ORDER BY s.score DESC, s.id NULLS LAST) QUALIFY row_number() OVER w <= {negatives.NEGATIVES}"""


#: What conversation -1 says.
PROBE = "</s>[INST] ok [/INST]"

ORACLE_SQL = {"op1_quality_rules": _op1(), "op4_warc": _op4(), "op5_decontamination": _op5(), "op6_chat_format": _op6(PROBE), "op7_mixing": _op7(), "op11_conversation_repair": _op11(), "op12_hard_negatives": _op12()}
