"""SQL for labels, splits, batches and word indexes."""

WORD = r"[\p{L}\p{N}_]{2,}"
CODE = "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE -1 END"
HASH = "('0x' || substr(md5(doc_id || ':100'), 1, 8))::BIGINT"
TOKENS = f"""t AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS t FROM documents),
  e AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS i FROM t),
  c AS (SELECT word, count(*) AS n FROM e GROUP BY 1 HAVING count(*) >= 2),
  v AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS index FROM c)"""
SPLIT = f"""s AS (SELECT doc_id, row_number() OVER (ORDER BY {HASH}, doc_id) - 1 AS index FROM documents),
  p AS (SELECT *, CASE WHEN index < floor((SELECT count(*) FROM documents) * 0.9) THEN 'train' ELSE 'val' END AS split
        FROM s)"""


def index_rows(value: str, padding: str, name: str) -> str:
    return f"""SELECT doc_id, array_to_string(list_resize(coalesce(list({value} ORDER BY i) FILTER (i IS NOT NULL), []),
      300, {padding}), ' ') AS {name}
      FROM documents LEFT JOIN (SELECT * FROM e WHERE i <= 300) e USING (doc_id) LEFT JOIN v USING (word) GROUP BY 1"""


ORACLES = {
    "ppmi_weights": f"""WITH {TOKENS}, often AS (SELECT word FROM c WHERE n >= 50),
        l AS (SELECT a.word, b.word AS context, count(*) AS n FROM e a JOIN e b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i + 1 AND a.i + 5
              WHERE a.word IN (FROM often) AND b.word IN (FROM often) GROUP BY 1, 2),
        m AS (SELECT word, context, sum(n)::BIGINT AS n FROM (FROM l UNION ALL SELECT context, word, n FROM l) GROUP BY 1, 2),
        s AS (SELECT word, sum(n) AS n_word FROM m GROUP BY 1), z AS (SELECT sum(n_word)::DOUBLE AS total FROM s),
        w AS (SELECT m.word, context, n, ln(n * total / (x.n_word::DOUBLE * y.n_word)) AS ppmi
              FROM m JOIN s x ON x.word = m.word JOIN s y ON y.word = context, z)
        SELECT word, context, n, round(ppmi, 6) AS ppmi FROM w WHERE ppmi > 0""",
    "label_encode": f"SELECT doc_id, {CODE}::INT AS code FROM documents",
    "label_decode": "SELECT doc_id, CASE WHEN lang IN ('de', 'en', 'fr') THEN lang ELSE 'unknow' END AS label FROM documents",
    "one_hot": """SELECT doc_id, (lang = 'de')::INT::VARCHAR || (lang = 'en')::INT::VARCHAR || (lang = 'fr')::INT::VARCHAR
        AS one_hot FROM documents""",
    "label_set": "SELECT lang AS label, count(*) AS n_docs FROM documents GROUP BY 1",
    "train_val_split": f"WITH {SPLIT} SELECT doc_id, index, split FROM p",
    "fraction_split": f"""SELECT doc_id, CASE WHEN {HASH} < 2576980377 THEN 'train' ELSE 'val' END AS split
        FROM documents""",
    "shuffle_order": f"SELECT doc_id, {HASH} AS shuffle FROM labels",
    "batch_ids": """SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index,
        (row_number() OVER (ORDER BY doc_id) - 1) // 128 AS batch_id FROM documents""",
    "cyclic_batches": f"""WITH n AS (SELECT count(*) AS n, ceil(2 * count(*) / 64.0)::BIGINT * 64 AS total FROM labels),
        r AS (SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM labels),
        b AS (SELECT doc_id, quality, unnest(range(i, total, n)) AS place FROM r, n)
        SELECT place // 64 AS batch_id, row_number() OVER (PARTITION BY place // 64 ORDER BY {HASH}, place % 64) - 1
          AS slot, doc_id, quality FROM b""",
    "vocabulary": f"WITH {TOKENS} SELECT * FROM v",
    "word_index_matrix": f"WITH {TOKENS} " + index_rows("coalesce(index, 0)::VARCHAR", "'0'", "idx"),
    "index_to_word": f"WITH {TOKENS}, z AS (SELECT word AS first FROM v WHERE index = 0) "
        + index_rows("CASE WHEN index IS NULL THEN (SELECT first FROM z) ELSE word END", "(SELECT first FROM z)", "words"),
    "matrix_roundtrip": f"WITH {TOKENS}, {SPLIT.replace('AS index', 'AS place').replace('index <', 'place <')}, x AS ("
        + index_rows("coalesce(index, 0)::VARCHAR", "'0'", "idx")
        + f"""), k AS (SELECT split, place // 128 AS batch_id, ({CODE})::VARCHAR || ':' || idx AS row
        FROM p JOIN x USING (doc_id) JOIN documents USING (doc_id))
        SELECT split, batch_id, count(*) AS n_rows, sum(('0x' || substr(md5(row), 1, 8))::BIGINT)::BIGINT AS content
        FROM k GROUP BY ROLLUP (split, batch_id)""",
    "token_batches": f"""WITH b AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 128 AS batch_id,
        array_to_string(regexp_extract_all(lower(text), '{WORD}'), ' ') AS value FROM documents)
        SELECT batch_id, count(*) AS n_docs, sum(length(value))::BIGINT AS n_chars,
          sum(('0x' || substr(md5(value), 1, 8))::BIGINT)::BIGINT AS content FROM b GROUP BY 1""",
    "vector_lookup": """SELECT event_id, user_id * 4 AS vec_id, embedding IS NOT NULL AS known,
        round(coalesce(embedding[1]::DOUBLE, 0), 6) AS v0, round(coalesce(embedding[64]::DOUBLE, 0), 6) AS v63,
        64::INT AS dimension FROM events LEFT JOIN embeddings ON vec_id = user_id * 4""",
}
