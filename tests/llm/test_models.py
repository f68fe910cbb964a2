"""Language, toxicity and language-model operators against plain versions and held-out rows."""

import copy
import math
import zlib
from collections import Counter
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fairreach.llm import language, ngram_lm, toxicity
from fairreach.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
MESSY = [(1, None), (2, ""), (3, "  \n"), (4, "123 !!"), (4, "123 !!"), (None, "the the"), (5, "the cat " * 3000), (6, "日本語 текст the")]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t, "x", "y", "z", 1.0, 2) for i, t in MESSY]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, extra string, score double, llm_lang int")


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    model = language.Model({"a": {1: 5}, "b": {2: 5}, "c": {3: 5}})
    for trial in range(60):
        words = [chr(97 + k) * 3 for k in range(8)]
        scores = (rng.standard_normal((8, 3)) * rng.choice([3, 9, 30])).astype(np.float32)
        model.scores = lambda _, s=scores: s
        sizes = [int(rng.integers(0, 6)) for _ in range(5)]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = rng.integers(0, 8, starts[-1]).astype(np.int32)
        got = model.label(words, flat, starts)
        value = lambda path, codes: sum(scores[c, p] for c, p in zip(codes, path)) - language.SWITCH * sum(a != b for a, b in zip(path, path[1:]))
        for a, b in zip(starts[:-1], starts[1:]):
            best = max((value(p, flat[a:b]) for p in product(range(3), repeat=b - a)), default=0)
            assert value(got[a:b].tolist(), flat[a:b]) == pytest.approx(best, abs=1e-3), trial


def test_script_narrows_candidates(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "кот и собака и дом", "ru"), (3, None, "fr"), (4, "lost", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.languages == ["en", "ru"]
    assert model.spans("the dog собака дом") == [("en", 0, 7), ("ru", 8, 18)]
    assert model.predict([b"dog", "дом".encode(), b"12", None])[0] == ["en", "ru", "und", "und"]


def test_language_of_messy_rows(spark, messy):
    model = language.train(spark.createDataFrame([(9, "the cat sat", "en")], "doc_id long, text string, lang string"))
    rows = language.identify(messy, model, ("p", "q")).select("doc_id", "p", "q").collect()
    assert [(r.doc_id, r.p) for r in rows] == [(1, "und"), (2, "und"), (3, "und"), (4, "und"), (4, "und"), (None, "en"), (5, "en"), (6, "en")]
    assert all(0 <= r.q <= 1 for r in rows)
    kept = language.drop_unidentified(messy, model)
    assert kept.columns == messy.columns and kept.count() == 3
    empty = language.train(messy.limit(0))
    assert language.identify(messy, empty, ("p", "q")).where("p <> 'und' or q <> 0").isEmpty()
    assert language.identify(messy.limit(0), model, ("p", "q")).isEmpty()
    assert language.label_spans(messy, model).where("doc_id = 5").count() == 1


def test_language_stage_rejects_junk_and_foreign_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    junk = [" ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(n)) for n in (3, 10, 100, 2000)]
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια",
        "Все люди рождаются свободными и равными в своем достоинстве",
        "모든 인간은 태어날 때부터 자유로우며",
    ]
    long = docs.where("length(text) > 200").limit(1).first().text
    planted = spark.createDataFrame([(-1 - k, t) for k, t in enumerate([*junk, *foreign])] + [(-100, f"{long} {junk[0]}")], "doc_id long, text string")
    model = language.train(language.split_learned(docs))
    rows = docs.select("doc_id", "text")
    kept = [r.doc_id for r in language.drop_unidentified(rows.unionByName(planted), model).collect()]
    assert [i for i in kept if i < 0] == [-100]
    assert len(kept) == rows.count() + 1
    # four languages, none with half of the letters
    four = language.Model({x: {language._trigrams([x * 8])[0][3]: 100} for x in "abcd"})
    mixed = " ".join(x * 8 for x in "aaabbccd")
    assert four.predict([mixed.encode()])[0] == ["a"]
    assert language.drop_unidentified(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), four).isEmpty()


def test_only_letters_have_a_language(spark):
    docs = spark.createDataFrame([(1, "½ ² ① Ⅷ 12", "mine"), (2, "the ½ cat", "mine")], "doc_id long, text string, lang_pred string")
    model = language.train(spark.createDataFrame([(9, "the cat sat", "en")], "doc_id long, text string, lang string"))
    rows = language.identify(docs, model).collect()
    assert [(r["_lang_pred"], r.score, r.lang_pred) for r in rows] == [("und", 0.0, "mine"), ("en", 1.0, "mine")]
    assert toxicity.score(docs.withColumnRenamed("lang_pred", "score"), None).columns[-1] == "_score"
    assert model.spans("½ cat") == [("en", 2, 5)]


def test_language_held_out(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, FOLDER).where("held_out").join(truth, "doc_id").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)


def test_toxicity_held_out(spark):
    """Recall of held-out toxic texts, in all and in each language, and false alarms."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    langs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op5_toxicity"](spark, folder)
    rows = out.where("held_out").join(labels, "doc_id").join(langs, "doc_id").collect()
    found = lambda own: sum(r.predicted for r in own) / len(own)
    toxic = [r for r in rows if r.toxic]
    assert len(toxic) > 100 and found(toxic) >= 0.9
    for lang in {r.lang for r in toxic}:
        assert found([r for r in toxic if r.lang == lang]) >= 0.8, lang
    assert found([r for r in rows if not r.toxic]) < 0.02


def test_toxicity_windows_overlap_and_cover():
    for stride in (toxicity.STRIDE, toxicity.WINDOW, 1):
        for n in (0, 1, 31, 32, 33, 56, 57, 500):
            text, first, size = toxicity._windows(np.array([0, n]), stride)
            covered = set()
            for a, k in zip(first, size):
                covered |= set(range(a, a + k))
            assert covered == set(range(n))
            assert all(b - a == stride for a, b in zip(first, first[1:]))
    assert toxicity.STRIDE <= toxicity.WINDOW // 2


def test_toxicity_score_is_that_of_the_highest_window():
    """Against a plain loop over words and windows."""
    rng = np.random.default_rng(4)
    net = toxicity.Network([b"good", b"bad", b"odd"], rng)
    net.word[1:, 0], net.char[:] = (2, -1, 0.5), rng.standard_normal(len(net.char))
    texts = [b" ".join(rng.choice([b"good", b"bad", b"odd", b"new", b"x"], n)) for n in (0, 1, 5, 31, 32, 33, 48, 49, 120)]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(xs, d):
        h, out, n = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for x in xs if d == "f" else xs[::-1]:
            a, u = x @ net.w[f"in_{d}"] + net.w[f"bias_{d}"], h @ net.w[f"rec_{d}"]
            z, r = sigmoid(a[:n] + u[:n]), sigmoid(a[n : 2 * n] + u[n : 2 * n])
            h = z * h + (1 - z) * np.tanh(a[2 * n :] + r * u[2 * n :])
            out.append(h)
        return out if d == "f" else out[::-1]

    def window(words):
        xs = [net.inputs([w])[0].astype(float) for w in words]
        both = [np.concatenate(s) for s in zip(states(xs, "f"), states(xs, "b"))]
        if not both:
            return float(net.w["out_b"][0])
        weight = np.exp([np.tanh(s @ net.w["att"] + net.w["att_b"]) @ net.w["att_v"] for s in both])
        return float((weight / weight.sum()) @ both @ net.w["out"] + net.w["out_b"][0])

    for text, got in zip(texts, net.scores(texts)):
        words = text.split()
        begins = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        assert got == pytest.approx(sigmoid(max(window(words[a : a + toxicity.WINDOW]) for a in begins)), abs=1e-4)


def test_rare_words_of_a_language_are_evidence():
    """A language with a tenth of the texts, whose toxic words have forms of their own."""
    rng = np.random.default_rng(2)
    word = lambda letters: "".join(rng.choice(list(letters), rng.integers(3, 8)))
    texts, labels = [], []
    for k in range(600):
        letters, stem = ("abcdefg", "gabe") if k % 10 else ("rstuvw", "vuts")
        words, toxic = [word(letters) for _ in range(rng.integers(20, 60))], k % 3 == 0
        for _ in range(4 * toxic):
            words.insert(rng.integers(0, len(words)), stem + word(letters))
        texts.append(" ".join(words).encode())
        labels.append(int(toxic))
    net = toxicity.fit(texts[:400], labels[:400])
    scores = net.scores(texts[400:])
    for small in (True, False):
        own = [(s, y) for k, (s, y) in enumerate(zip(scores, labels[400:])) if (k % 10 == 0) == small]
        assert np.mean([s >= 0.3 for s, y in own if y]) > 0.85 and np.mean([s >= 0.3 for s, y in own if not y]) < 0.2


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = toxicity.Network([b"good", b"bad"], rng)
    net.word[1:, 0], net.char[:] = (2, -1), rng.standard_normal(len(net.char))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = [b"good", b"bad", b"odd"]
    at = rng.integers(0, 3, (toxicity.WINDOW, 4))
    mask = np.arange(toxicity.WINDOW)[:, None] < np.array([32, 5, 1, 0])
    at = np.where(mask, at, 3)
    label = np.array([1, 0, 1, 0.0])

    net.word, net.char = net.word.astype(np.float64), net.char.astype(np.float64)

    def loss():
        x = net.inputs(words)
        logit = net.forward({d: tuple(p[at] for p in net.project(x, d)) for d in "fb"}, mask)
        return np.mean(np.logaddexp(0, logit) - label * logit)

    got = net.gradients(words, at, mask, label)
    for name in ("att", "att_v", "out", "out_b", "rec_f", "rec_b", "in_f", "in_b", "bias_f"):
        flat = net.w[name].reshape(-1)
        used = np.flatnonzero(got[name].reshape(-1))
        for k in rng.choice(used, min(4, len(used)), replace=False):
            old, step = flat[k], 2e-3
            flat[k] = old + step
            high = loss()
            flat[k] = old - step
            low = loss()
            flat[k] = old
            assert got[name].reshape(-1)[k] == pytest.approx((high - low) / (2 * step), abs=2e-4), name
    assert not got["word"][0].any()
    for name in ("word", "char"):
        flat = getattr(net, name).reshape(-1)
        for k in np.flatnonzero(got[name].reshape(-1))[:6]:
            old, step = flat[k], 2e-3
            flat[k] = old + step
            high = loss()
            flat[k] = old - step
            low = loss()
            flat[k] = old
            assert got[name].reshape(-1)[k] == pytest.approx((high - low) / (2 * step), abs=2e-4), name


def test_toxicity_learns_from_ids_of_any_type(spark):
    docs = spark.createDataFrame([(f"d{k}", "bad day" if k % 2 else "good day") for k in range(20)], "doc_id string, text string")
    labels = docs.selectExpr("doc_id", "cast(text = 'bad day' as int) as toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels), "s").collect()
    assert all(0 <= r.s <= 1 for r in scored) and len(scored) == 20


def test_toxicity_messy(spark, messy):
    labels = spark.createDataFrame([(6, 1), (5, 0), (2, 2), (None, 1), (7, None)], "doc_id long, toxic int")
    network = toxicity.train(messy, labels)
    out = toxicity.score(messy, network, "s").collect()
    assert len(out) == len(MESSY) and all(0 <= r.s <= 1 for r in out)
    assert toxicity.train(messy.limit(0), labels) is None
    assert toxicity.score(messy, None, "s").where("s <> 0").isEmpty()
    assert toxicity.drop_toxic(messy, None).columns == messy.columns
    assert toxicity.score(messy.limit(0), network, "s").isEmpty()


def plain_base(rows):
    lists = {i: [*("".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).split()), ""] for i, t in rows}
    train = {i: w for i, w in lists.items() if zlib.crc32(str(i).encode()) % 10 != 0}
    count = Counter(w for ws in train.values() for w in ws)
    total = sum(count.values())
    base = {i: sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in ws) for i, ws in lists.items()}
    return {i: (zlib.crc32(str(i).encode()) % 10 == 0, len(ws), sum(count[w] > 0 for w in ws), total, base[i]) for i, ws in lists.items()}


@pytest.mark.parametrize("frequent", [1 << 19, 100, 0])
def test_lm_base_equals_plain_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_lm, "FREQUENT", frequent)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = plain_base(texts)
    rows = QUERIES["op10_lm_scoring"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_filter_keeps_quantised_counts():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 20_000).view(np.uint64) * np.uint64(2)
    n = rng.integers(1, 5_000, 20_000)
    want = ngram_lm.quantise(n)
    stored = ngram_lm.Filter(ngram_lm.blocks_for(int(want.sum())))
    stored.put(h, want)
    assert ngram_lm.quantise(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]
    got = stored.counts(h)
    assert (got >= want).all() and (got > want).mean() < 0.05
    assert (stored.counts(h + np.uint64(1)) > 0).mean() < 0.05


def test_packed_numbers():
    rng = np.random.default_rng(6)
    for values in (np.zeros(0, np.uint64), np.zeros(3, np.uint64), rng.integers(0, 1 << 63, 50).astype(np.uint64), np.array([2**64 - 1, 0, 255, 256], np.uint64)):
        assert ngram_lm.unpack(ngram_lm.pack(values), len(values)).tolist() == values.tolist()
    h, c = ngram_lm.summed(np.array([5, 2, 5, 9], np.uint64), np.array([1, 2, 3, 4]))
    assert (h.tolist(), c.tolist()) == ([2, 5, 9], [2, 4, 4])


@pytest.mark.parametrize("most_bits", [None, 1 << 18])
def test_lm_score_equals_plain_dictionaries(spark, monkeypatch, messy, most_bits):
    """Quantised counts in dictionaries, over whole documents."""
    monkeypatch.setattr(ngram_lm, "BITS_PER_ENTRY", 256)  # few false hits
    monkeypatch.setattr(ngram_lm, "RANGE_BYTES", 200_000)
    monkeypatch.setattr(ngram_lm, "CHUNK_BYTES", 300_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(messy.select("doc_id", "text"))
    tokens = [(r.doc_id, [*(w.encode() for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "").translate({k: 32 for k in (9, 10, 11, 12, 13)}).split(" ") if w), b""]) for r in docs.collect()]
    learnt = [w for i, w in tokens if i is not None and zlib.crc32(str(i).encode()) % 10]
    count, pairs = Counter(w for ws in learnt for w in ws), Counter(p for ws in learnt for p in zip([b"", *ws], ws))
    total, distinct = sum(count.values()), len(count)
    least = lambda c: 2 ** (c.bit_length() - 1) if c else 0
    most = lambda c: 2 ** c.bit_length() - 1

    def plain(ws):
        out = 0.0
        for v, w in zip([b"", *ws], ws):
            low, high = (count[w], count[w]) if w == b"" else (least(count[w]), most(count[w]))
            above = count[b""] if v == b"" else most(count[v])
            single = (low + 0.1) / (total + 0.1 * (distinct + 1))
            out += math.log10((min(least(pairs[v, w]), above) + ngram_lm.PRIOR * single) / (above + ngram_lm.PRIOR))
        return out

    model, words = ngram_lm.train(docs.where(ngram_lm.id_remainder("doc_id", 10) > 0), most_bits)
    assert (model.parts > 3) == (most_bits is not None)
    got = sorted((str(r.doc_id), round(r.score, 3)) for r in ngram_lm.score(docs, model, words).collect())
    want = sorted((str(i), round(plain(ws), 3)) for i, ws in tokens)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=2e-3)


def test_lm_workers_share_the_filter(spark):
    """A filter of 256 MB is mapped by the workers, not held by each; a second call sends no other file."""
    docs = spark.createDataFrame([(k, f"a b{k % 7} a c") for k in range(200)], "doc_id long, text string").repartition(4)
    model, words = ngram_lm.train(docs)
    want = {r.doc_id: r.score for r in ngram_lm.score(docs, model, words).collect()}
    plain = model.score([f"a b{k % 7} a c".encode() for k in range(200)])[1]
    assert want == pytest.approx(dict(enumerate(plain.tolist())))
    assert model.sent(spark) == model.sent(spark)

    large = copy.copy(model)
    large.filter, large.file = ngram_lm.Filter(1 << 15), None

    def rows(own, ids, texts, find):
        own.score(texts, find)
        kb = next(int(line.split()[1]) for line in Path("/proc/self/status").read_text().splitlines() if line.startswith("RssAnon"))
        return pa.RecordBatch.from_arrays([ids, pa.array([kb] * len(ids), pa.int64())], names=["doc_id", "kb"])

    held = ngram_lm._scored(docs, large, "doc_id bigint, kb bigint", rows).collect()
    assert len(held) == 200 and max(r.kb for r in held) < 220_000


def test_lm_probabilities_add_up(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "a b b"), (3, None)], "doc_id long, text string")
    model, _ = ngram_lm.train(docs)
    for before in ("a", "b", "c", ""):
        total = 0
        for after in ("a", "b", "c"):
            one = model.score([f"{before} {after}".strip().encode()])[1][0]
            rest = model.score([before.encode()])[1][0]
            # score of "before after <end>" less that of "before" up to its end, with the end taken off both
            end_after = model.score([after.encode()])[1][0] - _first(model, after)
            end_before = rest - _first(model, before) if before else 0
            total += 10 ** (one - end_after - (rest - end_before if before else 0))
        assert total < 1.0001


def _first(model, word):
    """log10 P(word | end), from P of the one-word text with the word's own end taken off by a two-fold repeat."""
    one = model.score([word.encode()])[1][0]
    two = model.score([f"{word} {word}".encode()])[1][0]
    three = model.score([f"{word} {word} {word}".encode()])[1][0]
    again = three - two
    return one - (two - again - _start(model, word, two, again))


def _start(model, word, two, again):
    """log10 P(word | end): what the first word adds to the chain word -> word -> end."""
    v, w = ngram_lm.word_hashes([b""]), ngram_lm.word_hashes([word.encode()])
    q = model.filter.counts(ngram_lm.pair_hashes(v, w))
    low = int(1 << max(0, q[0] - 1)) if q[0] else 0
    exact = model.known(w)[0]
    end = model.known(v)[0]
    single = (max(exact, 0) + 0.1) / (model.total + 0.1 * (model.distinct + 1))
    return math.log10((min(low, end) + ngram_lm.PRIOR * single) / (end + ngram_lm.PRIOR))


def test_lm_stores_pairs_seen_once(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a c a c e")], "doc_id long, text string")
    model, _ = ngram_lm.train(docs)
    count = Counter(p for t in ("a b c d", "a c a c e") for p in zip(["", *t.split()], [*t.split(), ""]))
    first, second = (ngram_lm.word_hashes([p[k].encode() for p in count]) for k in (0, 1))
    want = ngram_lm.quantise(np.array(list(count.values())))
    assert model.filter.counts(ngram_lm.pair_hashes(first, second)).tolist() == want.tolist() and 1 in want
    assert model.score([b"b c"])[1][0] > model.score([b"c b"])[1][0]


def test_lm_score_does_not_depend_on_frequent(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    train_on, found = docs.where(ngram_lm.id_remainder("doc_id", 10) != 0), []
    for frequent in (0, 100, 1 << 19):
        monkeypatch.setattr(ngram_lm, "FREQUENT", frequent)
        model, words = ngram_lm.train(train_on)
        assert model.ends == train_on.count()
        rows = ngram_lm.score(docs, model, words).collect()
        found.append(sorted((r.doc_id, round(r.score, 6)) for r in rows))
    assert found[0] == found[1] == found[2]


def test_lm_scores_alike_with_several_filters(spark, monkeypatch, messy):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(messy.select("doc_id", "text"))
    train_on, found = docs.where(ngram_lm.id_remainder("doc_id", 10) != 0), []
    monkeypatch.setattr(ngram_lm, "BITS_PER_ENTRY", 1024)  # no false hits to speak of, so equal counts give equal scores
    for parts in (1, 4):
        model, words = ngram_lm.train(train_on)
        assert model.parts == parts
        rows = ngram_lm.score(docs, model, words).collect()
        found.append(sorted(tuple(-1 if x is None else round(x, 6) for x in r) for r in rows))
        monkeypatch.setattr(ngram_lm, "MOST_BITS", -(-model.entries * 1024 // 4))
    assert found[0] == found[1]


def test_lm_messy(spark, messy):
    model, words = ngram_lm.train(messy.limit(0))
    rows = ngram_lm.score(messy, model, words).collect()
    assert len(rows) == len(MESSY) and all(r.n_known == 0 for r in rows)
    assert Counter(r.n_tokens for r in rows)[1] == 3
    model, words = ngram_lm.train(messy)
    assert ngram_lm.score(messy.limit(0), model, words).isEmpty()
    assert all(r.n_known == r.n_tokens for r in ngram_lm.score(messy, model, words).collect())
