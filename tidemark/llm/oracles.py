"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality import CUTOFFS, DELTA, RISK

_SHARDING = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), crc AS (
  SELECT rid, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(text)), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295)::BIGINT AS crc
  FROM docs, crc_table
), walk AS (
  SELECT rid, ('0x' || substr(h, 1, 8))::BIGINT::HUGEINT * 4294967296 + ('0x' || substr(h, 9, 8))::BIGINT AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM docs
  UNION ALL
  SELECT rid, k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT rid, j, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM walk WHERE j < 40)
), ends AS (
  SELECT rid, b AS shard, CASE WHEN j = 40 THEN 40 ELSE b END AS grown FROM walk WHERE j >= 40
)
SELECT doc_id, strlen(text) + 16 AS size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard, grown::INTEGER AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || crc::BIGINT || ':' || (strlen(text) + 16)), 17, 8))::BIGINT % 1024, doc_id NULLS LAST, crc, strlen(text)) - 1 AS slot
FROM docs JOIN ends USING (rid) JOIN crc USING (rid)
"""

_CUTS = ", ".join(f"('{rule}', {float(cut)!r}::DOUBLE)" for rule, cuts in CUTOFFS.items() for cut in cuts)

#: Each rule's share of the risk.
SHARE = RISK / len(CUTOFFS)

_QUALITY = rf"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), windows AS (
  SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, sum(least(8, coalesce(next - i, 8)))::BIGINT AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM repeated) GROUP BY rid
), counts AS (
  SELECT rid, doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g'))::BIGINT AS n_upper, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)
), measured AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0) AS symbol_ratio, coalesce(n_upper::DOUBLE / nullif(word_chars, 0), 0) AS upper_ratio,
    coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS mean_word_chars FROM counts
), held AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL AND {{CRC}} % 2 = 0 GROUP BY doc_id
), cuts(rule, cutoff) AS (VALUES {_CUTS}
), tested AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (WHERE quality = 1) AS n, count(*) FILTER (WHERE quality = 1 AND o) AS k, count(*) FILTER (WHERE quality = 0 AND o) AS bad, count(*) OVER () AS tests
  FROM (SELECT stratum, rule, cutoff, quality, CASE rule WHEN 'symbol_ratio' THEN symbol_ratio WHEN 'upper_ratio' THEN upper_ratio WHEN 'dup_line_ratio' THEN dup_line_ratio ELSE mean_word_chars END > cutoff AS o
    FROM measured JOIN held USING (doc_id), cuts WHERE NOT base_failed AND quality IN (0, 1)) GROUP BY stratum, rule, cutoff
), certified AS (
  SELECT stratum, rule, cutoff, bad - k AS gain FROM tested WHERE bad > k AND k < n * {SHARE}
    AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({SHARE}) + (n - i) * ln(1 - {SHARE})))) <= {DELTA} / tests
), chosen AS (
  SELECT stratum, rule, cutoff FROM (SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) AS r FROM certified) WHERE r = 1
), gates AS (
  SELECT stratum, {", ".join(f"max(cutoff) FILTER (WHERE rule = '{r}') AS c_{r}" for r in CUTOFFS)} FROM chosen GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({" OR ".join(f"coalesce({r} > c_{r}, FALSE)" for r in CUTOFFS)}) AS kept,
  symbol_ratio, upper_ratio, dup_line_ratio, mean_word_chars
FROM measured LEFT JOIN gates USING (stratum)
"""


def _crc32(text: str) -> str:
    """crc32 of a short ASCII text in SQL, bit by bit."""
    step = "lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    eat = f"list_reduce(list_prepend(xor(c, b), range(8)), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda p: ascii(substr({text}, p, 1))::BIGINT)), lambda c, b: {eat}), 4294967295)"


_SHINGLES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links, doc_id = class_id AS kept
FROM classes LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM edges GROUP BY a) USING (doc_id)
"""

_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), classes AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM classes LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM edges GROUP BY a) USING (vec_id)
"""

_AUDIT = r"""
WITH marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failed AS (
  SELECT d.*, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE)] AS f
  FROM docs d LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic FROM failed GROUP BY part, f
), letters(c) AS (VALUES (1), (2), (3), (4), (5)
), orders AS (
  SELECT [a.c, b.c, c.c, d.c, e.c] AS o FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), steps AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, c AS step, o[c] AS own, list_slice(o, 1, c - 1) AS before FROM orders, letters
), outcomes AS (
  SELECT part, filter_order, step, own, n, n_good, n_toxic, f[own] AS fails, coalesce(list_bool_or(list_transform(before, lambda x: f[x])), FALSE) AS gone, len(list_filter(f, lambda x: x)) = 1 AS alone FROM cells, steps
), counts AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fails AND alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS good_lost, coalesce(sum(n_toxic) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM outcomes GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM counts
"""

_WARC = """
WITH payloads AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), named AS (
  SELECT *, array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 5 * k + 1, 5))::BIGINT >> s) & 31) + 1)::BIGINT, 1)), '')), '') AS payload_digest,
    row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS r, first_value(page_id) OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS original
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN r > 1 THEN original END AS refers_to FROM named
"""

_SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (SELECT rid, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0
), whole AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes
), lengths AS (SELECT rid, doc_id, 25 + (75 * n * big_n) // big_l AS m FROM sizes, whole
), terms AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS term FROM docs) GROUP BY rid, term
), weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM terms, whole GROUP BY term, big_n
), asked AS (
  SELECT qid, item_id, term, count(*)::BIGINT AS qtf FROM (SELECT qid, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS qid, item_id, text FROM benchmark)) GROUP BY qid, item_id, term
), scores AS (
  SELECT qid, item_id, rid, doc_id, sum(qtf * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN terms USING (term) JOIN lengths USING (rid) GROUP BY qid, item_id, rid, doc_id
)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_jaccard_join": _SHINGLES,
    "op2_quality_rules": _QUALITY.replace("{CRC}", _crc32("doc_id::VARCHAR")),
    "op8_embedding_dedup": _VECTORS,
    "op10_sharding": _SHARDING,
    "op11_filter_audit": _AUDIT,
    "op12_warc": _WARC,
    "op13_lexical_search": _SEARCH,
}
