"""The pipeline's stages against brute force on its own inputs."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from test_corpus_operators import holds
from test_text_dedup import brute_rows, shingles

import corpus_pipeline
from echoloom.llm import bpe, cotraining


def test_stages_and_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, docs
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, small)
        if name != "prefix_bpe":
            assert kept.columns == columns
            kept = spark.createDataFrame(kept.collect(), docs.schema)
        tables.append(kept)
    rows = [[(r.doc_id, r.text) for r in t.collect()] for t in tables[:5]]
    known = cotraining.features(docs)
    model = cotraining.fit(known, spark.read.parquet(f"{small}/labels.parquet"))
    good = {r.doc_id for r in cotraining.score(known, model).where("kept").collect()}
    assert sorted(d for d, _ in rows[1]) == sorted(good)
    assert sorted(d for d, _ in rows[2]) == sorted(d for d, _, _, k in brute_rows(rows[1], 5) if k)
    first, before = {}, dict(rows[2])
    for doc, text in sorted(rows[2]):
        data = text.encode()
        for i in range(len(data) - 98):
            first.setdefault(data[i : i + 99], doc)
    for doc, text in rows[3]:
        data, gone = before[doc].encode(), set()
        for i in range(len(data) - 98):
            if first[data[i : i + 99]] < doc:
                gone.update(range(i, i + 99))
        left = bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore")
        assert len(text) - len(left) <= 8 and (gone or text == before[doc])
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert sorted(d for d, _ in rows[4]) == sorted(d for d, t in rows[3] if not any(holds(t, x) for x in items))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    expected = {d: hashlib.sha256(np.array(reference.encode_ordinary(t), "<u4").tobytes()).hexdigest() for d, t in rows[4]}
    assert {r.doc_id: r.ids_sha256 for r in tables[5].collect()} == expected
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, small).collect()} == expected
    assert shingles("a b", 5)


def test_odd_rows_pass_all_stages(spark, tmp_path):
    prose = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil an enormous pot of lentil soup near the old harbour wall"
    kind = "doc_id long, text string, lang string, source string, n_chars long, class string, kept int, rest string, x binary"

    def row(i, text):
        return (i, text, "en", "s", len(text or ""), "clash", 1, "clash", b"z")

    rows = [row(1, prose), row(1, prose), row(2, prose + " again"), row(3, None), row(4, ""), row(5, None), row(None, "an own text that stands without any id at all"), row(6, "x" * 300_000 + " " + "word " * 60_000)]
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for name, chosen in (("rows", rows), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(chosen, kind).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([(1, "nothing of this kind"), (2, None)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        docs = spark.read.parquet(str(folder / "documents.parquet"))
        for step, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(folder))
            assert docs.columns == [c.split()[0] for c in kind.split(", ")], step
        out = corpus_pipeline.run(spark, str(folder)).collect()
        expected = {None: rows[6][1], 1: prose, 3: "", 4: "", 5: "", 6: rows[7][1]} if chosen else {}
        assert {r.doc_id: r.n_tokens for r in out} == {d: len(reference.encode_ordinary(t)) for d, t in expected.items()} and len(out) == len(expected)
