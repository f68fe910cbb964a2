"""The pipeline against its operators' own decisions, stage by stage."""

import re

import corpus_pipeline
from fairreach.llm import language, simhash, toxicity
from fairreach.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_stages_keep_what_their_operators_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}

    scored = toxicity.score(docs, toxicity.train(docs, labels), "s").collect()
    kept = {r.doc_id for r in scored if r.s < 0.3}
    calm = docs.where(docs.doc_id.isin(list(kept)))
    model = language.train(language.split_learned(calm))
    order = sorted(kept)
    names, shares, logs = model.judge([rows[i].encode() for i in order])
    kept = {i for i, n, share, log in zip(order, names, shares, logs) if n != "und" and share >= 1 / 2 and log > language.NO_LANGUAGE}

    prints = dict(zip(sorted(kept), simhash.simhash([rows[i].encode() for i in sorted(kept)], 4).tolist()))
    root = {i: i for i in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(kept)
    for k, i in enumerate(order):
        for j in order[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    kept = {i for i in kept if find(i) == i}

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [word.findall(r.text.lower()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(x[i : i + 10]) for x in items if x for i in range(max(1, len(x) - 9))}
    assert {len(w) for w in windows} == {10}
    for i in list(kept):
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in rows[i]))
        if any(tuple(words[k : k + 10]) in windows for k in range(len(words) - 9)):
            kept.remove(i)

    out = QUERIES["pipeline"](spark, FOLDER)
    final = out.collect()
    assert out.columns == ["doc_id", "ids", "n_tokens", "exact"]
    assert sorted(r.doc_id for r in final) == sorted(kept)
    assert all(r.exact and r.n_tokens == len(r.ids) for r in final)


def test_stages_return_the_columns_of_documents(spark):
    rows = [(1, None, "en", "s", 0, 1), (2, "", None, "s", 0, 1), (2, "", None, "s", 0, 1), (None, "the cat", "en", None, 7, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, llm_toxic int")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, FOLDER).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == frame.count()
