"""SQL for the document queries."""

# English stop words.
STOP = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've",
    "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't",
    "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]
STOP_LIST = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP) + "]"
WORD = r"[\p{L}\p{N}_]{2,}"
CLEAN = rf"""array_to_string(list_filter(string_split(regexp_replace(regexp_replace(lower(text),
    '[/(){{}}\[\]|@,;]', ' ', 'g'), '[^0-9a-z #+_]', '', 'g'), ' '),
    lambda w: w <> '' AND NOT list_contains({STOP_LIST}, w)), ' ')"""
CJK = "translate(text, 'abcdefghij', '甲乙丙丁戊己庚辛壬癸')"


def words(text: str) -> str:
    return f"""list_filter(regexp_extract_all(lower({text}), '{WORD}'),
      lambda w: NOT list_contains({STOP_LIST}, w))"""


NGRAMS = """e AS (SELECT doc_id, unnest(t) AS a, generate_subscripts(t, 1) AS i FROM w),
  l AS (SELECT doc_id, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c FROM e
        WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
  g1 AS (SELECT doc_id, a AS term FROM l),
  g2 AS (SELECT doc_id, a || ' ' || b AS term FROM l WHERE b IS NOT NULL),
  g3 AS (SELECT doc_id, a || ' ' || b || ' ' || c AS term FROM l WHERE c IS NOT NULL)"""
TFIDF = f"""d AS (SELECT doc_id, {CLEAN} AS text FROM documents),
  w AS (SELECT doc_id, {words("text")} AS t FROM d), {NGRAMS},
  g AS (FROM g1 UNION ALL FROM g2 UNION ALL FROM g3),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
  n AS (SELECT count(*) AS n FROM documents),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  r AS (SELECT doc_id, term, tf * (ln((1 + n)::DOUBLE / (1 + df)) + 1) AS raw
        FROM tf JOIN df USING (term), n WHERE df >= n * 0.01),
  z AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM r GROUP BY 1),
  v AS (SELECT doc_id, term, raw / norm AS weight FROM r JOIN z USING (doc_id))"""


def bm25(documents: str, key: str) -> str:
    """CTEs ending in s(item_id, key, score)."""
    return f"""q AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM benchmark),
  qt AS (SELECT item_id, term, count(*) AS asked FROM q GROUP BY 1, 2),
  d AS (SELECT {key}, regexp_extract_all(lower(text), '{WORD}') AS t FROM {documents}),
  z AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM d),
  e AS (SELECT {key}, len(t) AS size, unnest(t) AS term FROM d),
  p AS (SELECT {key}, size, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3),
  f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
  s AS (SELECT item_id, {key}, round(sum(asked * ln(1 + (n - df + 0.5) / (df + 0.5))
          * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * size / mean))), 6) AS score
        FROM p JOIN f USING (term) JOIN qt USING (term), z GROUP BY 1, 2)"""


def best(key: str, k: int, source: str = "s") -> str:
    return f"""SELECT * FROM (SELECT item_id, {key}, score, row_number() OVER (PARTITION BY item_id
      ORDER BY score DESC, {key})::INT AS rank FROM {source}) WHERE rank <= {k}"""


CHUNKS = """x AS (SELECT doc_id, text, unnest(range(0, greatest(ceil((length(text) - 1000) / 800.0), 0)::INT + 1))::INT
    AS chunk_no FROM documents WHERE length(text) > 0),
  k AS (SELECT doc_id, chunk_no, chunk_no * 800 AS start, substring(text, chunk_no * 800 + 1, 1000) AS text FROM x)"""
PAGES = """ln AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
  li AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM ln),
  pg AS (SELECT doc_id, ((i - 1) // 5 + 1)::INT AS page, sum(length(line) + 1)::BIGINT AS size FROM li GROUP BY 1, 2),
  sp AS (SELECT doc_id, page, (sum(size) OVER w - size)::BIGINT AS page_start, (sum(size) OVER w)::BIGINT AS page_end
         FROM pg WINDOW w AS (PARTITION BY doc_id ORDER BY page))"""
RETRIEVED = f"""{CHUNKS}, ch AS (SELECT doc_id * 1000000 + chunk_no AS chunk_id, * FROM k), {bm25("ch", "chunk_id")},
  b AS ({best("chunk_id", 2)}), {PAGES},
  o AS (SELECT item_id, rank, chunk_id, doc_id, page::VARCHAR AS page, length(text)::INT AS n_chars
        FROM b JOIN ch USING (chunk_id) JOIN sp USING (doc_id) WHERE start >= page_start AND start < page_end)"""

WORDS = f"""rn AS (SELECT doc_id, unnest(regexp_extract_all({CJK}, '[一-鿿]+')) AS run,
      unnest(range(len(regexp_extract_all({CJK}, '[一-鿿]+')))) AS run_no FROM documents),
  dr AS MATERIALIZED (SELECT run, count(*) AS times FROM rn GROUP BY 1),
  pc AS (SELECT run, times, unnest(range(1, length(run) + 1)) AS i FROM dr),
  gr AS MATERIALIZED (SELECT substr(run, i, k) AS gram, sum(times)::BIGINT AS n FROM pc, range(1, 6) r(k)
         WHERE i + k - 1 <= length(run) GROUP BY 1),
  tt AS (SELECT sum(n)::DOUBLE AS total FROM gr WHERE length(gram) = 1),
  oft AS (SELECT gram, n FROM gr WHERE n >= 5 AND length(gram) BETWEEN 2 AND 4),
  coh AS (SELECT o.gram, min(o.n::DOUBLE * total / (h.n::DOUBLE * t.n)) AS cohesion FROM oft o, range(1, 4) c(i), tt
          JOIN gr h ON h.gram = substr(o.gram, 1, i) JOIN gr t ON t.gram = substr(o.gram, i + 1)
          WHERE i < length(o.gram) GROUP BY 1),
  rgt AS (SELECT substr(gram, 1, length(gram) - 1) AS gram, sum(n) AS inside, sum(n * ln(n)) AS logs FROM gr WHERE length(gram) > 1 GROUP BY 1),
  lft AS (SELECT substr(gram, 2) AS gram, sum(n) AS inside, sum(n * ln(n)) AS logs FROM gr WHERE length(gram) > 1 GROUP BY 1),
  ent AS (SELECT gram, n, round(ln(n) - (coalesce(r.logs, 0) + CASE WHEN n > coalesce(r.inside, 0)
            THEN (n - coalesce(r.inside, 0)) * ln(n - coalesce(r.inside, 0)) ELSE 0 END) / n, 9) AS e_right,
          round(ln(n) - (coalesce(l.logs, 0) + CASE WHEN n > coalesce(l.inside, 0)
            THEN (n - coalesce(l.inside, 0)) * ln(n - coalesce(l.inside, 0)) ELSE 0 END) / n, 9) AS e_left
          FROM oft LEFT JOIN rgt r USING (gram) LEFT JOIN lft l USING (gram)),
  dic AS MATERIALIZED (SELECT gram AS word, n, cohesion, least(e_left, e_right) AS entropy,
          round(ln(n / total) * 1000000)::BIGINT AS weight FROM ent JOIN coh USING (gram), tt
          WHERE cohesion >= 1.5 AND least(e_left, e_right) >= 0.3
          UNION ALL SELECT gram, n, NULL, NULL, round(ln(n / total) * 1000000)::BIGINT FROM gr, tt WHERE length(gram) = 1)"""

ORACLES = {
    "corpus_words": f"""WITH {WORDS} SELECT word, n, round(cohesion, 6) AS cohesion, round(entropy, 6) AS entropy, weight
        FROM dic WHERE cohesion IS NOT NULL""",
    # w holds the weight of the word of each place and length; each step adds the best way to reach the next place.
    "segmented_words": f"""WITH RECURSIVE {WORDS},
        pl AS (SELECT run, (i - 1) * 4 + k AS slot, CASE WHEN i + k - 1 <= length(run) THEN substr(run, i, k) END AS word
               FROM pc, range(1, 5) r(k)),
        w AS MATERIALIZED (SELECT run, list(weight ORDER BY slot) AS w FROM pl LEFT JOIN dic USING (word) GROUP BY 1),
        dp AS (SELECT run, w, 0 AS e, [0::BIGINT] AS scores, []::INT[] AS sizes FROM w
          UNION ALL SELECT run, w, e + 1, list_append(scores, best.s), list_append(sizes, best.k) FROM (
            SELECT *, list_max(list_filter(list_transform(range(1, least(4, e + 1) + 1), lambda k:
              {{'s': scores[e + 2 - k] + w[(e + 1 - k) * 4 + k], 'k': k::INT}}), lambda x: x.s IS NOT NULL)) AS best
            FROM dp WHERE e < length(run))),
        bt AS (SELECT run, sizes, length(run) AS e, []::VARCHAR[] AS words FROM dp WHERE e = length(run)
          UNION ALL SELECT run, sizes, e - sizes[e], list_prepend(substr(run, e - sizes[e] + 1, sizes[e]), words) FROM bt WHERE e > 0),
        fin AS MATERIALIZED (SELECT run, words FROM bt WHERE e = 0),
        al AS (SELECT doc_id, flatten(list(words ORDER BY run_no)) AS words FROM rn JOIN fin USING (run) GROUP BY 1)
        SELECT doc_id, coalesce(len(words), 0)::INT AS n_words, coalesce(array_to_string(words, ' '), '') AS words
        FROM documents LEFT JOIN al USING (doc_id)""",
    "clean_text": f"SELECT doc_id, {CLEAN} AS clean FROM documents",
    "clean_lines": r"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex(text, '\r?\n'),
        lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10)) AS content FROM documents""",
    "stopword_filter": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS words FROM documents",
    "pad_tokens": f"""SELECT doc_id, array_to_string(list_resize(regexp_extract_all(text, '{WORD}'), 190, '<PAD>'), ' ')
        AS padded FROM documents""",
    "keep_cjk": rf"""SELECT doc_id, trim(regexp_replace(regexp_replace({CJK}, '[^一-鿿]', ' ', 'g'), '\s{{2,}}', ' ',
        'g')) AS cjk FROM documents""",
    "labelled_line_cleaning": f"""SELECT doc_id, array_to_string(regexp_extract_all({CJK}, '[一-鿿]'), ' ') AS cjk
        FROM documents""",
    "page_line_numbers": f"""WITH {PAGES}, f AS (SELECT doc_id, page FROM li JOIN (SELECT *, ((i - 1) // 5 + 1)::INT AS page
          FROM li) USING (doc_id, i) GROUP BY 1, 2 HAVING sum(length(li.line) + 1) > 1)
        SELECT doc_id, page, ((i - 1) % 5)::INT AS line_no, length(line)::INT AS n_chars
        FROM (SELECT *, ((i - 1) // 5 + 1)::INT AS page FROM li) JOIN f USING (doc_id, page)""",
    "char_tokens": f"""WITH c AS (SELECT doc_id, regexp_extract_all({CJK}, '[一-鿿]') AS t FROM documents)
        SELECT doc_id, len(t)::INT AS n_tokens, array_to_string(t, ' ') AS tokens FROM c""",
    "top_ngrams": f"""WITH w AS (SELECT doc_id, {words('text')} AS t FROM documents), {NGRAMS}
        SELECT term AS ngram, count(*) AS n FROM g3 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "top_words": f"""WITH g AS (SELECT unnest({words('text')}) AS ngram FROM documents)
        SELECT ngram, count(*) AS n FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "tfidf_weights": f"WITH {TFIDF} SELECT doc_id, term, round(weight, 6) AS weight FROM v",
    "similar_documents": f"""WITH {TFIDF}, q AS (SELECT min(doc_id) AS query_id FROM documents GROUP BY source),
        s AS (SELECT q.query_id, b.doc_id, round(sum(a.weight * b.weight), 9) AS cosine
              FROM q JOIN v a ON a.doc_id = q.query_id JOIN v b USING (term) WHERE b.doc_id <> q.query_id GROUP BY 1, 2),
        k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, doc_id)::INT AS rank FROM s)
        SELECT query_id, doc_id, round(cosine, 6) AS cosine, rank FROM k WHERE rank <= 10""",
    "cosine_neighbours": f"""WITH {TFIDF}, s AS (
          SELECT a.doc_id AS query_id, b.doc_id, round(sum(a.weight * b.weight), 9) AS cosine
          FROM v a JOIN v b USING (term) WHERE a.doc_id % 50 = 0 AND b.doc_id <> a.doc_id GROUP BY 1, 2),
        k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, doc_id)::INT AS rank FROM s)
        SELECT query_id, doc_id, round(cosine, 6) AS cosine, rank FROM k WHERE rank <= 10""",
    "bm25_search": f"WITH {bm25('documents', 'doc_id')} {best('doc_id', 10)}",
    "bm25_search_join": f"WITH {bm25('documents', 'doc_id')} {best('doc_id', 10)}",
    "rerank_candidates": f"""WITH {bm25('documents', 'doc_id')}, c AS ({best('doc_id', 20)}),
        r AS (SELECT item_id, doc_id, list_distinct(regexp_extract_all(lower(benchmark.text), '{WORD}')) AS a, d.t AS t
              FROM c JOIN benchmark USING (item_id) JOIN d USING (doc_id)),
        o AS (SELECT item_id, doc_id, round(len(list_intersect(a, t)) / len(a)::DOUBLE, 6) AS score FROM r)
        {best('doc_id', 5, 'o')}""",
    "fixed_stride_chunks": f"WITH {CHUNKS} SELECT * FROM k",
    "recursive_chunk_flags": r"""SELECT doc_id, true AS in_place, true AS sized, true AS overlapping, true AS covered
        FROM documents WHERE regexp_matches(text, '\S')""",
    "document_pages": f"WITH {PAGES} SELECT * FROM sp",
    "chunk_page": f"""WITH {CHUNKS}, {PAGES} SELECT doc_id, chunk_no, start, page::VARCHAR AS page
        FROM k JOIN sp USING (doc_id) WHERE start >= page_start AND start < page_end""",
    "retrieved_chunks": f"WITH {RETRIEVED} SELECT * FROM o",
    "answer_pages": f"WITH {RETRIEVED} SELECT DISTINCT item_id, doc_id, page FROM o",
    "document_by_id": """SELECT doc_id, source, text FROM documents
        WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY source)""",
}
