"""Token alignment against a plain comparison of all token pairs."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm import token_alignment as ta
from tidemill.session import written

JSON, MODEL = map(public_tokenizers.path, ta.VOCABULARIES)
TEXTS = [
    (1, "The quick brown fox's 1234 jumps\n\nover  the lazy dog"), (2, "The quick brown fox"), (3, None), (4, ""),
    (5, "naïve café 甲乙丙 🙂 <s> <|endoftext|> </s> "), (6, "a ▁ b"), (7, "   "), (8, "x" * 3000 + " the the the"),
    (2, "The quick brown fox"), (None, "The quick"), (9, "\x00 nul"), (10, "é ﬁ ①  　 tab\t"), (11, "0"),
]


def plain(rows):
    tk = Tokenizer.from_file(JSON)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    chars = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in chars}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in chars)}
    held, found = Counter(), []
    for doc_id, text in rows:
        a = [(i, bytes(byte_of[c] for c in tk.id_to_token(i))) for i in tk.encode(" " + (text or ""), add_special_tokens=False).ids]
        names = [(i, sp.id_to_piece(i)) for i in sp.encode(text or "")]
        b = [(i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode())
             for i, p in names]
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(t for _, t in side) != whole for side in (a, b)):
            a = b = []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
        groups = [tuple(",".join(str(i) for i, _, e in side if low < e <= high) for side in spans)
                  for low, high in zip([0, *cuts], cuts, strict=False)]
        held.update(set(links))
        found.append((doc_id, len(a), len(b), len(cuts), links, ";".join("|".join(g) for g in groups)))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((d, na, nb, ng, len(ln), sum(held[x] == best[x[0]] for x in ln), sum(held[x] for x in ln),
                    hashlib.sha256(g.encode()).hexdigest() if ln else "") for d, na, nb, ng, ln, g in found), key=str)


@pytest.mark.parametrize(("part", "links"), [(1 << 20, 1 << 20), (3, 7)])
def test_against_all_pairs(spark, monkeypatch, part, links):
    monkeypatch.setattr(ta, "LINKS_AT_ONCE", links)
    monkeypatch.setattr(ta, "HELD_PAIRS", 5 * links)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("a", F.lit("x")).withColumn("row", F.lit(1)).withColumn("ends", F.lit(None).cast("int"))
    aligned = written(ta.align(docs, JSON, MODEL), "aligned")
    found = ta.summaries(aligned, (50256, 32000), part).collect()
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    expected = plain(TEXTS)
    assert sorted((tuple(r[c] for c in columns) for r in found), key=str) == expected
    assert {r[0] for r in expected if not r[1]} >= {3, 4, 6}


def test_query_against_all_pairs_on_a_whole_table(spark, small):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t[:400] if t else t) for i, t in texts]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    found = ta.summaries(written(ta.align(docs, JSON, MODEL), "aligned"), (50256, 32000)).collect()
    assert sorted((tuple(r[:3]) + tuple(r[3:]) for r in found), key=str) == plain(short)
    assert ta.op13_token_alignment(spark, small).count() == len(texts)


def test_links_keep_all_tokens(spark):
    docs = spark.createDataFrame(TEXTS[:1], "doc_id long, text string")
    row = ta.align(docs, JSON, MODEL).first()
    tk = Tokenizer.from_file(JSON)
    assert [i for i, e in zip(row.a, row.ends, strict=True) if e & 1] == tk.encode(" " + TEXTS[0][1]).ids
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [i for i, e in zip(row.b, row.ends, strict=True) if e & 2] == sp.encode(TEXTS[0][1])


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ta.summaries(written(ta.align(docs, JSON, MODEL), "aligned"), (50256, 32000)).collect() == []
