"""The registered queries written independently as DuckDB SQL."""

from __future__ import annotations

from glyphmill.plans import registry as r

# RE2 has no lookahead: a marker character splits whitespace runs before their last space instead.
_PRETOKENS = r"""regexp_extract_all(
    regexp_replace(text, '(\s+)(\s\S)', '\1' || chr(57344) || '\2', 'g'),
    '''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x{E000}]+|\s+')"""

_COUNTS = f"""
counted AS (
    SELECT pretoken, count(*) AS cnt
    FROM (SELECT unnest({_PRETOKENS}) AS pretoken FROM documents) GROUP BY pretoken
),
words AS (
    SELECT pretoken, regexp_replace(hex(pretoken), '(..)', '<\\1>', 'g') AS sym, cnt FROM counted
)"""


def _pairs(source: str) -> str:
    return f"""
    SELECT p[1] AS l, p[2] AS r, CAST(sum(cnt) AS BIGINT) AS n FROM (
        SELECT cnt, unnest([[s[i], s[i + 1]] FOR i IN range(1, len(s))]) AS p
        FROM (SELECT cnt, string_split(trim(sym, '<>'), '><') AS s FROM {source})
    ) GROUP BY ALL"""


# Greedy training, one merge per step; the last step holds every word fully merged.
_TRAINED = f"""
WITH RECURSIVE {_COUNTS},
trained AS (
    SELECT 0 AS k, pretoken, sym, cnt, '' AS l, '' AS r, CAST(0 AS BIGINT) AS n FROM words
    UNION ALL
    SELECT t.k + 1, t.pretoken, replace(t.sym, '<' || b.l || '><' || b.r || '>', '<' || b.l || b.r || '>'),
        t.cnt, b.l, b.r, b.n
    FROM trained t, ({_pairs("trained")} ORDER BY n DESC, l DESC, r DESC LIMIT 1) b
    WHERE t.k < {r.N_MERGES}
),
merges AS (SELECT DISTINCT CAST(k - 1 AS INTEGER) AS rank, l, r, n FROM trained WHERE k > 0),
vocab AS (
    SELECT CAST(0 AS INTEGER) AS token_id, hex('{r.SPECIALS[0]}') AS token
    UNION ALL SELECT CAST(1 + range AS INTEGER), lpad(to_hex(range), 2, '0') FROM range(256)
    UNION ALL SELECT CAST(257 + rank AS INTEGER), l || r FROM merges
)"""

_ENCODED = f"""{_TRAINED},
word_ids AS (
    SELECT s.pretoken, list(v.token_id ORDER BY s.pos) AS ids
    FROM (
        SELECT pretoken, unnest(h) AS token, unnest(range(len(h))) AS pos
        FROM (SELECT pretoken, string_split(trim(sym, '<>'), '><') AS h FROM trained WHERE k = {r.N_MERGES})
    ) s JOIN vocab v ON v.token = s.token AND v.token_id > 0
    GROUP BY s.pretoken
),
encoded AS (
    SELECT o.doc_id, flatten(list(w.ids ORDER BY o.pos)) AS ids
    FROM (
        SELECT doc_id, unnest(t) AS pretoken, unnest(range(len(t))) AS pos
        FROM (SELECT doc_id, {_PRETOKENS} AS t FROM documents)
    ) o JOIN word_ids w USING (pretoken)
    GROUP BY o.doc_id
)"""

_STREAM = f"""{_ENCODED},
placed AS (
    SELECT list_append(ids, 0) AS ids,
        sum(len(ids) + 1) OVER (ORDER BY doc_id) - len(ids) - 1 AS first_pos
    FROM encoded
),
stream AS (
    SELECT unnest(ids) AS id, CAST(first_pos + unnest(range(len(ids))) AS BIGINT) AS pos FROM placed
)"""

_DIMS = """
dims AS (
    SELECT vec_id, label, unnest(range(64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings
)"""

_CENTROIDS = f"""{_DIMS},
centroids AS (SELECT label, i, avg(x) AS c FROM dims GROUP BY label, i)"""

_STARTS = f"""
    SELECT range AS sample_id,
        CAST('0x' || substr(md5('{r.SEED}-' || range), 1, 15) AS BIGINT) % (n - {r.CONTEXT}) AS start"""


def _fit_trace() -> str:
    """The fit unrolled: one set of tables per step."""
    s = r.FIT
    parts = [
        f"""WITH {_DIMS},
rows AS (SELECT vec_id, label FROM embeddings),
classes AS (SELECT range AS c FROM range((SELECT max(label) + 1 FROM embeddings))),
w0 AS (SELECT c, i, 0.0::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM classes, (SELECT range AS i FROM range(64)))"""
    ]
    trace = []
    for t in range(s.steps):
        if t < s.warmup:
            rate = f"({s.max_rate} * {t} / {s.warmup})::DOUBLE"
        elif t <= s.cycle:
            rate = (
                f"({s.min_rate} + 0.5 * (1 + cos(pi() * {t - s.warmup} / {s.cycle - s.warmup}))"
                f" * ({s.max_rate} - {s.min_rate}))::DOUBLE"
            )
        else:
            rate = f"{s.min_rate}::DOUBLE"
        b1, b2 = s.betas
        parts.append(
            f"""
z{t} AS MATERIALIZED (SELECT vec_id, label, c, sum(w * x) AS z FROM dims JOIN w{t} USING (i) GROUP BY ALL),
lse{t} AS MATERIALIZED (
    SELECT vec_id, max(z) + ln(sum(exp(z - top))) AS lse
    FROM (SELECT *, max(z) OVER (PARTITION BY vec_id) AS top FROM z{t}) GROUP BY vec_id
),
loss{t} AS MATERIALIZED (SELECT avg(lse - z) AS loss FROM z{t} JOIN lse{t} USING (vec_id) WHERE c = label),
g{t} AS MATERIALIZED (
    SELECT c, i, sum((exp(z - lse) - CASE WHEN c = z{t}.label THEN 1 ELSE 0 END) * x)
        / (SELECT count(*) FROM rows) AS g
    FROM z{t} JOIN lse{t} USING (vec_id) JOIN dims USING (vec_id) GROUP BY c, i
),
norm{t} AS MATERIALIZED (SELECT sqrt(sum(g * g)) AS norm FROM g{t}),
u{t} AS MATERIALIZED (
    SELECT c, i, w, m + (1 - {b1}) * (gc - m) AS m, v + (1 - {b2}) * (gc * gc - v) AS v
    FROM (SELECT c, i, w, m, v, g * least(1.0, {s.max_norm} / (norm + 1e-6)) AS gc
          FROM w{t} JOIN g{t} USING (c, i), norm{t})
),
w{t + 1} AS MATERIALIZED (
    SELECT c, i, w * (1 - {rate} * {s.weight_decay})
        - {rate} * (m / (1 - pow({b1}, {t + 1}))) / (sqrt(v / (1 - pow({b2}, {t + 1}))) + {s.eps}) AS w, m, v
    FROM u{t}
)"""
        )
        trace.append(
            f"SELECT {t}::INTEGER AS step, round({rate}, 6) + 0.0 AS rate, round(loss, 6) + 0.0 AS loss,"
            f" round(norm, 6) + 0.0 AS grad_norm FROM loss{t}, norm{t}"
        )
    return ",".join(parts) + "\n" + "\nUNION ALL ".join(trace)


_SPECIAL_RE = "|".join(
    t.replace("|", r"\|") for t in sorted(r.TURN_SPECIALS, key=lambda t: (-len(t), t))
)
_SPECIAL_LIST = ", ".join(f"'{t}'" for t in r.TURN_SPECIALS)

_SHOWN_VOCAB = "SELECT token_id, token FROM vocab"
_SHOWN_IDS = "SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, array_to_string(ids, ' ') AS ids FROM encoded"

ORACLES = {
    "apply_merge": f"""
        WITH {_COUNTS.replace("counted AS (", "counted AS MATERIALIZED (")},
        best AS MATERIALIZED ({_pairs("words")} ORDER BY n DESC, l DESC, r DESC LIMIT 1)
        SELECT replace(sym, (SELECT '<' || l || '><' || r || '>' FROM best), (SELECT '<' || l || r || '>' FROM best)) AS sym, cnt
        FROM words""",
    "array_softmax": f"""
        WITH {_DIMS}, tops AS (SELECT vec_id, max(x) AS top FROM dims GROUP BY vec_id)
        SELECT vec_id, CAST(i AS INTEGER) AS idx,
            round(exp(x - top) / sum(exp(x - top)) OVER (PARTITION BY vec_id), 6) + 0.0 AS p
        FROM dims JOIN tops USING (vec_id)""",
    "bpe_merges": f'{_TRAINED} SELECT rank, l AS "left", r AS "right", n FROM merges',
    "bpe_vocab": f"{_TRAINED} {_SHOWN_VOCAB}",
    "byte_display": f"""
        WITH {_COUNTS},
        shown AS (SELECT range AS b, range BETWEEN 33 AND 126 OR range BETWEEN 161 AND 172
                  OR range BETWEEN 174 AND 255 AS plain FROM range(256)),
        chars AS (
            SELECT list(CASE WHEN plain THEN chr(b::INTEGER) ELSE chr((256 + nth)::INTEGER) END ORDER BY b) AS c
            FROM (SELECT *, row_number() OVER (PARTITION BY plain ORDER BY b) - 1 AS nth FROM shown)
        )
        SELECT array_to_string([c[('0x' || h)::INTEGER + 1] FOR h IN string_split(trim(sym, '<>'), '><')], '') AS shown,
            cnt
        FROM words, chars""",
    "byte_histogram": """
        SELECT ('0x' || h)::INTEGER AS byte, count(*) AS cnt
        FROM (SELECT unnest(regexp_extract_all(hex(text), '..')) AS h FROM documents) GROUP BY h""",
    "checkpoint_resume": _fit_trace(),
    "clip_global_norm": """
        WITH grads AS (
            SELECT doc_id, lang, (2 * quality - 1) * ln(n_chars) AS g
            FROM documents LEFT JOIN labels USING (doc_id)
        ), norms AS (SELECT lang, sqrt(sum(g * g)) AS norm FROM grads GROUP BY lang)
        SELECT doc_id, lang, round(g * least(1.0, 1.0 / (norm + 1e-6)), 6) + 0.0 AS clipped
        FROM grads JOIN norms USING (lang)""",
    "clip_all_parameters": f"""
        WITH {_DIMS}, norms AS (SELECT sqrt(sum(x * x)) AS norm FROM dims)
        SELECT vec_id, CAST(i AS INTEGER) AS idx, round(x * least(1.0, 1.0 / (norm + 1e-6)), 6) + 0.0 AS clipped
        FROM dims, norms""",
    "context_windows": f"""{_STREAM},
        starts AS ({_STARTS}
            FROM (SELECT count(*) AS n FROM stream) AS total, range((SELECT count(*) // {r.TOKENS_PER_SAMPLE} FROM stream))
        ),
        picked AS (
            SELECT sample_id, start, j, id
            FROM (SELECT sample_id, start, unnest(range({r.CONTEXT + 1})) AS j FROM starts) s
            JOIN stream ON stream.pos = s.start + s.j
        )
        SELECT sample_id, start,
            string_agg(id::VARCHAR, ' ' ORDER BY j) FILTER (WHERE j < {r.CONTEXT}) AS x,
            string_agg(id::VARCHAR, ' ' ORDER BY j) FILTER (WHERE j > 0) AS y
        FROM picked GROUP BY sample_id, start""",
    "corpus_split": "SELECT md5(text) AS digest, count(*) AS n_docs FROM documents GROUP BY 1",
    "cross_entropy": f"""
        WITH {_DIMS}
        SELECT label, round(avg(loss), 4) + 0.0 AS loss, count(*) AS n_rows FROM (
            SELECT vec_id, label, ln(sum(exp(x))) - max(x) FILTER (WHERE i = label) AS loss
            FROM dims GROUP BY vec_id, label
        ) GROUP BY label""",
    "decode_roundtrip": f"""{_ENCODED}
        SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, text AS decoded FROM documents JOIN encoded USING (doc_id)""",
    "embedding_lookup": f"""{_ENCODED}, {_DIMS},
        uses AS (SELECT doc_id, id, count(*) AS n FROM (SELECT doc_id, unnest(ids) AS id FROM encoded) GROUP BY ALL)
        SELECT doc_id, CAST(i AS INTEGER) AS idx, round(sum(n * x) / sum(n), 4) + 0.0 AS mean
        FROM uses JOIN dims ON dims.vec_id = uses.id GROUP BY doc_id, i""",
    "encode_documents": f"{_ENCODED} {_SHOWN_IDS}",
    "encode_from_files": f"""{_TRAINED},
        marked AS (
            SELECT conv_id, turn, regexp_replace(
                '<|' || role || '|>' || text || chr(10) || chr(10) || '<|endoftext|><|endoftext|>',
                '({_SPECIAL_RE})', chr(57345) || '\\1' || chr(57345), 'g') AS m
            FROM conversations
        ), flat AS (
            SELECT conv_id, turn, unnest(range(len(p))) AS seg, unnest(p) AS text
            FROM (SELECT conv_id, turn, list_filter(string_split(m, chr(57345)), lambda x: x <> '') AS p FROM marked)
        ), pieces AS (
            SELECT conv_id, turn, seg, unnest(range(len(t))) AS pos, unnest(t) AS piece
            FROM (SELECT *, CASE WHEN text IN ({_SPECIAL_LIST}) THEN [text] ELSE {_PRETOKENS} END AS t FROM flat)
        ), folded AS (
            SELECT 0 AS k, piece, regexp_replace(hex(piece), '(..)', '<\\1>', 'g') AS sym
            FROM (SELECT DISTINCT piece FROM pieces WHERE piece NOT IN ({_SPECIAL_LIST}))
            UNION ALL
            SELECT k + 1, piece, replace(sym, '<' || l || '><' || r || '>', '<' || l || r || '>')
            FROM folded JOIN merges ON merges.rank = folded.k
        ), specials AS (
            SELECT s AS piece, CASE WHEN s = '{r.SPECIALS[0]}' THEN 0
                ELSE 257 + {r.N_MERGES} + row_number() OVER (PARTITION BY s = '{r.SPECIALS[0]}' ORDER BY n) - 1 END AS id
            FROM (SELECT unnest([{_SPECIAL_LIST}]) AS s, unnest(range({len(r.TURN_SPECIALS)})) AS n)
        ), piece_ids AS (
            SELECT s.piece, list(v.token_id ORDER BY s.pos) AS ids
            FROM (
                SELECT piece, unnest(h) AS token, unnest(range(len(h))) AS pos
                FROM (SELECT piece, string_split(trim(sym, '<>'), '><') AS h FROM folded WHERE k = {r.N_MERGES})
            ) s JOIN vocab v ON v.token = s.token AND v.token_id > 0
            GROUP BY s.piece
            UNION ALL SELECT piece, [CAST(id AS INTEGER)] FROM specials
        ), turns AS (
            SELECT conv_id, turn, flatten(list(ids ORDER BY seg, pos)) AS ids
            FROM pieces JOIN piece_ids USING (piece) GROUP BY conv_id, turn
        )
        SELECT conv_id, turn, CAST(len(ids) AS INTEGER) AS n_tokens, array_to_string(ids, ' ') AS ids FROM turns""",
    "fit_parameter_table": _fit_trace(),
    "fit_softmax_regression": _fit_trace(),
    "group_softmax": """
        WITH s AS (SELECT doc_id, lang, 4 * ln(n_chars) AS score FROM documents),
        t AS (SELECT *, max(score) OVER (PARTITION BY lang) AS top FROM s)
        SELECT doc_id, lang,
            round(exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY lang), 6) + 0.0 AS p FROM t""",
    "linear_map": """
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)
        SELECT a.vec_id, count(*) AS n_outputs, round(sum(list_dot_product(a.x, b.x)), 3) + 0.0 AS total,
            round(max(list_dot_product(a.x, b.x)), 4) + 0.0 AS largest
        FROM v a, v b GROUP BY a.vec_id""",
    "lr_schedule": """
        WITH n AS (SELECT (max(doc_id) + 1) // 20 AS tw, (max(doc_id) + 1) * 9 // 10 AS tc FROM documents)
        SELECT doc_id AS it, round(CASE
            WHEN doc_id < tw THEN 1.0::DOUBLE * doc_id / tw
            WHEN doc_id <= tc THEN 0.1::DOUBLE + 0.5 * (1 + cos(pi() * (doc_id - tw) / (tc - tw))) * 0.9::DOUBLE
            ELSE 0.1::DOUBLE END, 6) + 0.0 AS rate
        FROM documents, n""",
    "masked_vote": f"""
        WITH {_CENTROIDS},
        sides AS (SELECT label, c > 0 AS side FROM centroids WHERE i = 0),
        scores AS (
            SELECT q.label AS q, k.label AS k, vec_id, sum(x * c) / sqrt(64) AS score
            FROM dims k JOIN centroids q USING (i) GROUP BY ALL
        ),
        seen AS (
            SELECT s.* FROM scores s JOIN sides ON sides.label = s.q
            JOIN embeddings e ON e.vec_id = s.vec_id AND (e.embedding[1] > 0) = side
        ),
        w AS (SELECT *, exp(score - max(score) OVER (PARTITION BY q)) AS w FROM seen),
        ids AS (SELECT range AS idx FROM range((SELECT max(label) + 1 FROM embeddings)))
        SELECT q AS label, CAST(idx AS INTEGER) AS idx,
            round(sum(CASE WHEN k = idx THEN w ELSE 0 END) / sum(w), 4) + 0.0 AS weight
        FROM w, ids GROUP BY q, idx""",
    "merges_load": f'{_TRAINED} SELECT rank, l AS "left", r AS "right" FROM merges',
    "pair_counts": f"WITH {_COUNTS} {_pairs('words')}",
    "pretoken_counts": f"WITH {_COUNTS} SELECT pretoken, cnt FROM counted",
    "project_vectors": f"""
        WITH {_CENTROIDS}
        SELECT vec_id, centroids.label, round(sum(x * c), 4) + 0.0 AS value
        FROM dims JOIN centroids USING (i) GROUP BY vec_id, centroids.label""",
    "rms_normalise": f"""
        WITH {_DIMS},
        gains AS (SELECT i, avg(abs(x)) AS g FROM dims GROUP BY i),
        roots AS (SELECT vec_id, sqrt(avg(x * x) + 1e-5) AS root FROM dims GROUP BY vec_id)
        SELECT vec_id, CAST(i AS INTEGER) AS idx, round(x / root * g, 4) + 0.0 AS value
        FROM dims JOIN gains USING (i) JOIN roots USING (vec_id)""",
    "roundtrip_audit": f"""{_ENCODED}
        SELECT lang, count(text) AS n_docs, CAST(0 AS BIGINT) AS n_changed,
            CAST(sum(len(ids)) AS BIGINT) AS n_tokens, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes
        FROM documents JOIN encoded USING (doc_id) GROUP BY lang""",
    "silu_features": f"""
        WITH {_DIMS}
        SELECT vec_id, CAST(i AS INTEGER) AS idx, round(x / (1 + exp(-x)), 4) + 0.0 AS value FROM dims""",
    "soft_neighbour_vote": f"""
        WITH {_CENTROIDS},
        scores AS (
            SELECT q.label AS q, k.label AS k, vec_id, sum(x * c) / sqrt(64) AS score
            FROM dims k JOIN centroids q USING (i) WHERE k.label <> q.label GROUP BY ALL
        ),
        w AS (SELECT *, exp(score - max(score) OVER (PARTITION BY q)) AS w FROM scores),
        ids AS (SELECT range AS idx FROM range((SELECT max(label) + 1 FROM embeddings)))
        SELECT q AS label, CAST(idx AS INTEGER) AS idx,
            round(sum(CASE WHEN k = idx THEN w ELSE 0 END) / sum(w), 4) + 0.0 AS weight
        FROM w, ids GROUP BY q, idx""",
    "special_split": f"""
        WITH marked AS (
            SELECT conv_id, turn, regexp_replace(
                '<|' || role || '|>' || text || chr(10) || chr(10) || '<|endoftext|><|endoftext|>',
                '({_SPECIAL_RE})', chr(57344) || '\\1' || chr(57344), 'g') AS m
            FROM conversations
        ), parts AS (
            SELECT conv_id, turn, list_filter(string_split(m, chr(57344)), lambda p: p <> '') AS p FROM marked
        ), flat AS (SELECT conv_id, turn, unnest(range(len(p))) AS pos, unnest(p) AS segment FROM parts)
        SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, segment, segment IN ({_SPECIAL_LIST}) AS is_special
        FROM flat""",
    "special_split_many": r"""
        WITH marked AS (
            SELECT conv_id, turn, regexp_replace(
                '<|turn ' || turn || '|>' || text || '<|turn ' || turn || '|><|turn ' || (turn + 1) || '|><|turn x|>',
                '(<\|turn [0-9]+\|>)+', chr(57344) || '\0' || chr(57344), 'g') AS m
            FROM conversations
        ), parts AS (
            SELECT conv_id, turn, list_filter(string_split(m, chr(57344)), lambda p: p <> '') AS p FROM marked
        )
        SELECT conv_id, turn, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS segment FROM parts""",
    "start_uniformity": f"""
        WITH total AS (SELECT count(*) AS docs, CAST(sum(strlen(text)) AS BIGINT) AS n FROM documents),
        starts AS ({_STARTS} FROM total, range((SELECT 32 * docs FROM total))),
        sizes AS (SELECT n - {r.CONTEXT} AS choices, CAST(ceil((n - {r.CONTEXT}) / 64.0) AS BIGINT) AS width, docs * 32 AS k FROM total),
        bins AS (
            SELECT range AS bin, k, least(width, choices - range * width)::DOUBLE / choices AS share
            FROM sizes, range((SELECT CAST(ceil(choices::DOUBLE / width) AS BIGINT) FROM sizes))
        ),
        hits AS (SELECT start // width AS bin, count(*) AS cnt FROM starts, sizes GROUP BY 1)
        SELECT bin, coalesce(cnt, 0) AS cnt,
            round(k * share - 5 * sqrt(k * share * (1 - share)), 4) + 0.0 AS low,
            round(k * share + 5 * sqrt(k * share * (1 - share)), 4) + 0.0 AS high,
            coalesce(cnt, 0) BETWEEN k * share - 5 * sqrt(k * share * (1 - share))
                AND k * share + 5 * sqrt(k * share * (1 - share)) AS inside
        FROM bins LEFT JOIN hits USING (bin)""",
    "stream_encode": f"{_ENCODED} {_SHOWN_IDS}",
    "stream_encode_pieces": f"{_ENCODED} {_SHOWN_IDS}",
    "stream_pretoken_counts": f"WITH {_COUNTS} SELECT pretoken, cnt FROM counted",
    "table_diff": """
        SELECT coalesce(d.doc_id, l.doc_id)::VARCHAR AS key, CAST(0 AS INTEGER) AS idx,
            CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN l.doc_id IS NULL THEN 'extra' ELSE 'different' END AS kind,
            CASE WHEN d.doc_id IS NOT NULL THEN CASE WHEN n_chars > 200 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS actual,
            quality::DOUBLE AS expected
        FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id
        WHERE d.doc_id IS NULL OR l.doc_id IS NULL OR (n_chars > 200)::INTEGER <> quality""",
    "table_diff_exact": """
        WITH e AS (SELECT doc_id, n_chars::VARCHAR AS n_chars, source, hex(text) AS text FROM documents),
        a AS (
            SELECT doc_id, (n_chars + CASE WHEN doc_id % 3 = 0 THEN 9007199254740993 ELSE 0 END)::VARCHAR AS n_chars,
                CASE WHEN doc_id % 5 = 0 THEN 'src0' ELSE source END AS source, hex(lower(text)) AS text
            FROM documents WHERE doc_id % 7 <> 0
        ), both_sides AS (
            SELECT e.doc_id, unnest(['n_chars', 'source', 'text']) AS col, a.doc_id IS NULL AS missing,
                unnest([a.n_chars, a.source, md5(a.text)]) AS actual, unnest([e.n_chars, e.source, md5(e.text)]) AS expected
            FROM e LEFT JOIN a USING (doc_id)
        )
        SELECT col AS "column", doc_id::VARCHAR AS key, CAST(0 AS INTEGER) AS idx,
            CASE WHEN missing THEN 'missing' ELSE 'different' END AS kind, actual, expected
        FROM both_sides WHERE missing OR actual IS DISTINCT FROM expected""",
    "token_stream": f"""{_STREAM}
        SELECT pos // {r.BLOCK_SIZE} AS block_id, pos // {r.BLOCK_SIZE} * {r.BLOCK_SIZE} AS start_pos,
            CAST(count(*) AS INTEGER) AS n_tokens, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS tokens
        FROM stream GROUP BY pos // {r.BLOCK_SIZE}""",
    "token_vectors": f"""{_ENCODED},
        placed AS (SELECT doc_id, unnest(ids) AS token, unnest(range(len(ids))) AS pos FROM encoded)
        SELECT doc_id, token, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum,
            round(max(CAST(embedding[1] AS DOUBLE)), 4) + 0.0 AS "first", round(min(CAST(embedding[64] AS DOUBLE)), 4) + 0.0 AS "last"
        FROM placed JOIN embeddings ON vec_id = token GROUP BY doc_id, token""",
    "top_pairs": f"WITH {_COUNTS} {_pairs('words')} ORDER BY n DESC, l DESC, r DESC LIMIT 50",
    "vocab_load": f"{_TRAINED} {_SHOWN_VOCAB}",
    "vocab_specials": f"{_TRAINED} {_SHOWN_VOCAB} UNION ALL SELECT CAST(257 + {r.N_MERGES} AS INTEGER), hex('<|pad|>')",
}
ORACLES["table_diff_tree"] = ORACLES["table_diff_exact"]
ORACLES["corpus_ranges"] = ORACLES["corpus_split"]
ORACLES["flat_token_windows"] = ORACLES["context_windows"]
