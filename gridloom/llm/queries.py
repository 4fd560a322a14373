"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import bytepairs, centroids, classify, fingerprints, infill, licences, minhash, mixing, packing, pivots, suffixes, warc

QUERIES = {
    f.__name__: f
    for f in (
        fingerprints.op1_iblt_fingerprints,
        pivots.op2_pivot_distance_top_k,
        classify.op3_factorisation_machine,
        licences.op4_licence_scan,
        packing.op5_packing_first_fit,
        suffixes.op6_suffix_array_dedup,
        classify.op7_compression_toxicity,
        minhash.op8_prob_min_hash,
        bytepairs.op9_byte_level_bpe,
        warc.op10_warc_boundary_chain,
        centroids.op11_lloyd_clusters,
        mixing.op12_pivotal_mix,
        infill.op13_fill_in_middle,
    )
}

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(hex, {at}, 5) AS INTEGER) >> {bits}) & 31), 1)"
_BASE32 = " || ".join(_DIGIT.format(at=1 + 5 * i, bits=b) for i in range(8) for b in (15, 10, 5, 0))

#: The others need tokenizers, fitted models, sketches or strings of bytes, which SQL lacks or takes too long for; tests hold them
#: against brute force.
SQL: dict[str, str] = {
    "op2_pivot_distance_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS q FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
 SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op10_warc_boundary_chain": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages), h AS (SELECT page_id, strlen(body) AS n, sha1(body) AS hex FROM p),
 d AS (SELECT page_id, n, {_BASE32} AS digest FROM h), m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM d)
 SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to FROM m""",
    "op13_fill_in_middle": """WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
 h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM t),
 f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
 p AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1, n - b) AS s FROM f)
 SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
}
