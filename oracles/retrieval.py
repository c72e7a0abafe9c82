"""SQL for the vector queries."""

BASE = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  p AS (SELECT label, min(vec_id) AS proto_id FROM e GROUP BY 1)"""
L2 = f"""WITH {BASE}, s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_distance(q.v, e.v) AS d
    FROM p JOIN e q ON q.vec_id = proto_id, e),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id)::INT AS rank FROM s)
    SELECT query_id, id, round(d, 6) AS distance, rank FROM r WHERE rank <= 2"""



def neighbours(score: str, order: str, name: str) -> str:
    return f"""WITH {BASE}, s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, {score} AS s
        FROM e q JOIN e ON e.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, id)::INT AS rank FROM s)
        SELECT query_id, id, round(s, 6) AS {name}, rank FROM r WHERE rank <= 10"""


ORACLES = {
    "vector_neighbours_l2": neighbours("list_distance(q.v, e.v)", "s", "distance"),
    "vector_neighbours_cosine": neighbours("list_cosine_similarity(q.v, e.v)", "s DESC", "cosine"),
    "vector_topk_l2": L2,
    "vector_topk_blocks": L2,
    "cosine_pair": f"""WITH {BASE} SELECT a.vec_id, proto_id, a.label, round(list_cosine_similarity(a.v, b.v), 6) AS cosine
        FROM e a JOIN p USING (label) JOIN e b ON b.vec_id = proto_id""",
    "nearest_words": f"""WITH {BASE}, s AS (SELECT q.vec_id AS query_id, e.vec_id AS id,
        list_cosine_similarity(q.v, e.v) AS c FROM p JOIN e q ON q.vec_id = proto_id, e WHERE e.vec_id <> q.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, id)::INT AS rank FROM s)
        SELECT query_id, id, round(c, 6) AS cosine, rank, 'FOUND' AS status FROM r WHERE rank <= 10
        UNION ALL SELECT -1, NULL, NULL, NULL, 'UNKNOWN'""",
    "analogy_vector": f"""WITH {BASE}, n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM e),
        i AS (SELECT label, vec_id, CASE WHEN k = 3 THEN -1.0 ELSE 1.0 END AS sign,
                list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM n WHERE k <= 3),
        x AS (SELECT label, generate_subscripts(u, 1) AS d, sign, unnest(u) AS y FROM i),
        m AS (SELECT label, d, sum(sign * y) / count(*) AS y FROM x GROUP BY 1, 2),
        q AS (SELECT label, list(y ORDER BY d) AS qv FROM m GROUP BY 1),
        s AS (SELECT q.label::BIGINT AS query_id, e.vec_id AS id, list_cosine_similarity(qv, e.v) AS c FROM q, e
              WHERE e.vec_id NOT IN (SELECT vec_id FROM i WHERE i.label = q.label)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, id)::INT AS rank FROM s)
        SELECT query_id, id, round(c, 6) AS cosine, rank FROM r WHERE rank <= 10""",
    "first_components": "SELECT vec_id, " + ", ".join(
        f"round(embedding[{i + 1}]::DOUBLE, 6) AS c{i}" for i in range(5)) + " FROM embeddings",
}
