"""Near-duplicates, decontamination, tokens, pieces, licenses, search and URLs against brute force."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from fairreach.llm import decontaminate, hamming_search, licenses, sentencepiece, simhash, tokens, urls
from fairreach.llm.graph import components
from fairreach.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
MESSY = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (4, "One two"), (None, "one TWO"), (5, "word " * 20_000), (6, "é▁\x00 \x1f\n x  y ")]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t, "x", 1, "y") for i, t in MESSY]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, llm_row int, ids string")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, FOLDER)
    assert set(got.columns) == set(columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select(columns).collect())) == sorted(map(key, result.fetchall()))


# --- components and near-duplicates


def plain_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(5001, 5100)]
    got = dict(map(tuple, components(spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")).collect()))
    want = plain_components([(a, b) for a, b in edges if a != b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [words[i : i + k] for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [None, "", "a", "A b", "a b c d", "a b c d e f\tG\nh", "é ü x y z a b", "w " * 70_000]
    got = simhash.simhash([t.encode() if t is not None else None for t in texts], 4).tolist()
    assert got == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("leaf, flat, room", [(1024, 2048, 8192), (16, 8, 8192), (16, 8, 12), (1024, 16, 50)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, leaf, flat, room):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "FLAT", flat)
    monkeypatch.setattr(simhash, "TASK_ROWS", (room, room))
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(300)]
    for v in values[:60]:
        for _ in range(4):
            for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])):
                v ^= 1 << b
            values.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    got = {r.fingerprint: r.component_id for r in simhash.classes(rows, 4).collect()}
    edges = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    want = plain_components(edges)
    first = {}
    for i, v in enumerate(signed):
        first[v] = min(first.get(v, i), want.get(i, i))
    assert got == first


def test_near_duplicates_of_documents(spark):
    rows = QUERIES["op2_simhash_near_dedup"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == {i: plain_fingerprint(t) for i, t in texts.items()}
    prints = [(r.doc_id, int(r.fingerprint, 16)) for r in rows]
    want = plain_components([(a, b) for a, x in prints for b, y in prints if a > b and (x ^ y).bit_count() <= 4])
    assert {r.doc_id: r.component_id for r in rows} == {i: want.get(i, i) for i, _ in prints}


def test_near_duplicates_messy(spark, messy):
    rows = simhash.near_duplicates(messy).collect()
    assert len(rows) == len(MESSY)
    assert {r.component_id for r in rows if r.fingerprint == 0} == {1}
    assert {r.component_id for r in rows if r.doc_id in (4, None)} == {4}
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    assert simhash.near_duplicates(messy.limit(0)).isEmpty() and simhash.keep_one(messy.limit(0)).isEmpty()


# --- decontamination


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "zz"]), max_size=40), max_size=6), st.lists(st.lists(st.sampled_from(["a", "b", "c"]), max_size=9), max_size=5))
def test_passages_equal_brute_force(docs, items):
    window = 3
    phrases = decontaminate.Phrases([(str(k), " ".join(x).encode()) for k, x in enumerate(items)], window)
    spans, found = phrases.find([[w.encode() for w in d] for d in docs])
    for d, s, f in zip(docs, spans, found):
        hit, named = set(), set()
        for k, item in enumerate(items):
            for at in range(max(1, len(item) - window + 1)) if item else ():
                w = item[at : at + window]
                for p in range(len(d) - len(w) + 1):
                    if d[p : p + len(w)] == w:
                        hit |= set(range(p, p + len(w)))
                        named.add(str(k))
        assert {p for a, b in s for p in range(a, b)} == hit and f == named
        assert all(x[1] < y[0] for x, y in zip(s, s[1:]))


def test_fm_index_finds_all():
    rng = np.random.default_rng(7)
    runs = [rng.integers(1, 4, n) for n in (1, 2, 50, 300, 17)]
    symbols = np.concatenate([np.append(r, 0) for r in runs])
    index = decontaminate.FMIndex(symbols, 3)
    for length in (1, 2, 5):
        phrases = np.array(list(np.ndindex(*[3] * length))) + 1
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [i for i in range(len(symbols) - length + 1) if (symbols[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_passages_messy_and_blocks(spark, messy, monkeypatch):
    bench = spark.createDataFrame([(1, "one two"), (2, None), (None, "one"), (3, "..."), (10, "one two")], "item_id long, text string")
    one = decontaminate.find_passages(messy, bench).select("doc_id", "n_words", "spans", "items").collect()
    assert [r["items"] for r in one if r.doc_id in (4, None)] == [["1", "10"]] * 3
    assert [r.n_words for r in one if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 8)
    assert decontaminate.find_passages(messy, bench).select("doc_id", "n_words", "spans", "items").collect() == one
    kept = decontaminate.drop_contaminated(messy, bench)
    assert kept.columns == messy.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6]
    assert decontaminate.find_passages(messy.limit(0), bench).isEmpty()
    assert decontaminate.find_passages(messy, bench.limit(0)).where("size(spans) > 0").isEmpty()


# --- tokens


def plain_sections(text, rule):
    import base64

    import tiktoken

    with open(tokens.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ids = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)
    back = {v: k for k, v in ranks.items()}
    lines_ = text.splitlines(keepends=True) if "\n" in text else [text]
    lines_ = re.findall(r"[^\n]*\n|[^\n]+", text)
    of_char = [k for k, line in enumerate(lines_) for _ in line]
    of_byte = [c for c, ch in enumerate(text) for _ in ch.encode()]
    counts, at = [0] * len(lines_), 0
    for i in ids:
        chars = sorted({of_byte[b] for b in range(at, at + len(back[i]))})
        sections = [of_char[c] for c in chars]
        pick = {"first": sections[0], "last": sections[-1], "most": max(sorted(set(sections)), key=sections.count)}[rule]
        counts[pick] += 1
        at += len(back[i])
    return counts


@pytest.mark.parametrize("rule", tokens.RULES)
def test_section_tokens(spark, rule):
    texts = ["plain words", "a\n\n\nb  \n c", "é ü\n日本語 \U0001f600\U0001f600\n", "<|endoftext|>\n\n\n\n\n x", "\n", "x\r\n\r\ny"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = tokens.section_tokens(docs, rule).orderBy("doc_id", "section").collect()
    for k, text in enumerate(texts):
        own = [r for r in rows if r.doc_id == k]
        assert [r.n_tokens for r in own] == plain_sections(text, rule), text
        assert "".join(text[r.char_begin : r.char_end] for r in own) == text


def test_section_tokens_messy(spark, messy):
    rows = tokens.section_tokens(messy).collect()
    assert [(r.section, r.n_tokens) for r in rows if r.doc_id in (1, 2)] == [(0, 0), (0, 0)]
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert tokens.section_tokens(messy.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        tokens.section_tokens(messy, "none")


# --- pieces


def piece_scores(model):
    found = {}

    def walk(nodes):
        for below, score, i in nodes.values():
            if score is not None:
                found[i] = score
            walk(below)

    walk(model.root)
    return found


def unigram_twin():
    """The same pieces with the operator's scores as a unigram model, whose library encoder is a Viterbi search over them."""
    import struct

    import sentencepiece as library

    raw, at, out, k, scores = Path(sentencepiece.MODEL).read_bytes(), 0, b"", 0, piece_scores(sentencepiece.load())

    def number(i):
        value = shift = 0
        while True:
            value |= (raw[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if raw[i - 1] < 128:
                return value, i

    for_field = lambda tag, part: bytes([tag]) + (bytes([len(part)]) if len(part) < 128 else bytes([len(part) & 127 | 128, len(part) >> 7])) + part
    while at < len(raw):
        tag, i = number(at)
        size, i = number(i)
        part = raw[i : i + size]
        if tag >> 3 == 2:  # trainer settings: model type 1 in place of 2 (field 3)
            part = part.replace(b"\x18\x02", b"\x18\x01", 1)
        elif tag >> 3 == 1:
            if k in scores:  # the piece (field 1), then its score (field 2)
                part = part[: 2 + part[1]] + b"\x15" + struct.pack("<f", scores[k])
            k += 1
        out += for_field(tag, part)
        at = i + size
    return library.SentencePieceProcessor(model_proto=out)


def test_pieces_equal_library():
    twin, model = unigram_twin(), sentencepiece.load()
    texts = ["Hello  world", "the cat sat on the mat.", "  lead and trail  ", "x\ny\n\n z", "naïve café 日本 \U0001f600", "aaaaaaaaaaaaaaaaaaa", "1234567890 +-*/ a_b", "\t tab"]
    ids, offsets = model.encode([t.encode() for t in texts])
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == twin.encode(text), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab é▁\n \x00\x1f\x1e日T\U0001f600"))), st.text()), max_size=6))
def test_pieces_round_trip(texts):
    model = sentencepiece.load()
    given_ = [t.encode("utf-8", "ignore") if t is not None else None for t in texts]
    ids, offsets = model.encode(given_)
    assert model.decode(ids, offsets) == [t or b"" for t in given_]


def test_pieces_best_score():
    model = sentencepiece.load()
    by_id = piece_scores(model)
    scores = {model.bytes[model.first[i] : model.first[i] + model.sizes[i]].tobytes().decode(): s for i, s in by_id.items()}

    def best(word):
        top = [0.0] + [-1e300] * len(word)
        for e in range(1, len(word) + 1):
            for b in range(e):
                s = scores.get(word[b:e], model.unknown if e - b == 1 else None)
                if s is not None:
                    top[e] = max(top[e], top[b] + s)
        return top[-1]

    words = sorted({w.encode() for w in [" hello", " help", " helping", "  x", " naïve", " ÿÿq", " internationalisation"]})
    for word, ids in model.segment(words).items():
        pieces = [k for k in ids]
        text = word.decode()
        got, at = 0.0, 0
        for i in pieces:
            piece = model.bytes[model.first[i] : model.first[i] + model.sizes[i]].tobytes()
            if i in model.byte_ids.values():
                continue
            got += scores[piece.decode()]
        unknown = sum(len(model.bytes) and c not in scores for c in text)
        assert got + unknown * model.unknown == pytest.approx(best(text))


def test_pieces_messy(spark, messy):
    out = sentencepiece.round_trip(messy)
    rows = out.collect()
    assert len(rows) == len(MESSY) and all(r.exact for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [0, 0]
    again = sentencepiece.decode(sentencepiece.encode(messy.select("doc_id", "text"), "made"), "made", "back").collect()
    assert all(r.back == (r.text or "") for r in again)
    assert sentencepiece.round_trip(messy.limit(0)).isEmpty()


# --- licenses


def test_licenses_equal_brute_force(spark):
    notice = dict(licenses.TEMPLATES)
    rng = random.Random(1)
    filler = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "the", "license"]) for _ in range(n))
    texts = [f"{filler(rng.randrange(40))}\n{notice[rng.choice(list(notice))]} {filler(rng.randrange(40))}" for _ in range(30)]
    changed = notice["MIT-text"].split()
    changed[20] = "CHANGED"
    texts += [" ".join(changed), filler(300), notice["MIT"].upper() + " " + filler(900) + notice["BSD-3-Clause"], "under the MIT License"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.find_licenses(docs).collect():
        got[r.doc_id, r.license] = max(r.containment, got.get((r.doc_id, r.license), 0))
    want = {}
    for k, text in enumerate(texts):
        words = licenses._words(text)
        for name, notice_text in licenses.TEMPLATES:
            own = licenses._words(notice_text)
            size = min(5, len(own))
            shingles = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
            wide = len(own) - size + 1 + 2 * -(-(len(own) - size + 1) // 5)
            all_ = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
            best = max((len(shingles & set(all_[i : i + wide])) / len(shingles) for i in range(max(1, len(all_) - wide + 1))), default=0)
            if best >= 0.8:
                want[k, name] = best
    assert got == pytest.approx(want)


def test_every_notice_of_a_text_is_a_row(spark):
    notice = dict(licenses.TEMPLATES)
    filler = " ".join(["alpha"] * 40)
    texts = [
        f"{notice['MIT-text']} {filler} {notice['MIT-text']} {notice['MIT-text']}",
        f"{notice['BSD-opening']}: 1. Redistributions of source code must retain the above copyright notice. 2. Redistributions {notice['BSD-2-Clause']}, including",
        f"{notice['BSD-opening']}: 1. x. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        f"the documentation and/or other materials provided with the distribution. 3. {notice['BSD-3-Clause']}. This software is provided by the copyright holders and contributors as is",
        f"x {notice['ISC']}. y",
    ]
    found = licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [
        (0, "MIT-text"), (0, "MIT-text"), (0, "MIT-text"), (1, "BSD-2-Clause"), (1, "BSD-opening"), (2, "BSD-3-Clause"), (2, "BSD-opening"), (3, "ISC"),
    ]
    begins = sorted(r.word_begin for r in found if r.doc_id == 0)
    size = len(licenses._words(notice["MIT-text"]))
    assert begins[1] >= size and begins[2] - begins[1] >= size - licenses.SHINGLE


def test_licenses_plan_is_native(spark, messy):
    plan = licenses.find_licenses(messy)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert licenses.find_licenses(messy).isEmpty() and licenses.find_licenses(messy.limit(0)).isEmpty()
    assert licenses.find_licenses(messy, ()).isEmpty()
    short = licenses.find_licenses(messy, (("short", "one, two"), ("none", "..."))).collect()
    assert sorted(str(r.doc_id) for r in short) == ["4", "4", "None"]


# --- search


def test_search_equals_brute_force(spark):
    rng = random.Random(9)
    codes = [(i, rng.getrandbits(64) if i % 3 else 5) for i in range(200)]
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in codes]
    rows = spark.createDataFrame([*signed, signed[3], (None, 4), (900, None)], "vec_id long, code long")
    got = hamming_search.top_k(rows, rows.where("vec_id % 20 = 0"), 7).collect()
    for q, c in codes[::20]:
        want = sorted(((c ^ d).bit_count(), i) for i, d in codes if i != q)[:7]
        assert [(r.distance, r.neighbor_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want
    assert hamming_search.top_k(rows.limit(0), rows, 3).isEmpty() and hamming_search.top_k(rows, rows.limit(0), 3).isEmpty()
    assert hamming_search.top_k(rows.where("vec_id < 3"), rows.where("vec_id = 0"), 9).count() == 2


def test_search_over_several_shards(spark, monkeypatch):
    """The first shard bounds the others; cells are on many tasks."""
    monkeypatch.setattr(hamming_search, "SHARD_ROWS", 100)
    monkeypatch.setattr(hamming_search, "LEAST_QUERIES", 8)
    rng = random.Random(3)
    near = [rng.getrandbits(64) for _ in range(20)]
    codes = [(i, rng.choice(near) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))) for i in range(700)]
    rows = spark.createDataFrame([(i, c - (1 << 64) if c >> 63 else c) for i, c in codes], "vec_id int, code long")
    cells = []
    search = hamming_search._search

    def counting(own, queries, shards, blocks, k):
        cells.append((len(shards), blocks))
        return search(own, queries, shards, blocks, k)

    monkeypatch.setattr(hamming_search, "_search", counting)
    got = hamming_search.top_k(rows, rows.where("vec_id % 10 = 0"), 5).collect()
    assert cells == [(1, 3), (6, 3)] and len(got) == 350
    for q, c in codes[::10]:
        want = sorted(((c ^ d).bit_count(), i) for i, d in codes if i != q)[:5]
        assert [(r.distance, r.neighbor_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want
    with pytest.raises(ValueError, match="whole numbers"):
        hamming_search.top_k(rows.withColumn("vec_id", rows.vec_id.cast("string")), rows, 3)


def test_a_vector_too_wide_for_a_code_raises(spark):
    with pytest.raises(Exception, match="the vector has 65"):
        hamming_search.sign_codes(spark.createDataFrame([(1, [0.5] * 65)], "vec_id long, embedding array<double>")).collect()


def test_codes(spark):
    rows = spark.createDataFrame([(1, [1.0, -1.0, 0.0, 2.0]), (2, None), (3, [0.5] * 64)], "vec_id long, embedding array<double>")
    assert [r.code for r in hamming_search.sign_codes(rows).orderBy("vec_id").collect()] == [9, 0, -1]


# --- urls


def test_url_rules_and_aliases(spark):
    link = '<link href="{}" rel="canonical">'
    pages = [
        (1, "http://A.Example.COM/en/x?q#f", ""),
        (2, "https://www.example.com/en/x", ""),
        (3, "http://plain.org/a", '<link rel="canonical" href="https://bad.net/es/1">'),
        (4, "http://other.org/b", '<meta http-equiv="refresh" content="0; url=http://plain.org/a">'),
        (5, "http://both.org/c", link.format("http://good.com/")),
        (6, "http://both.org/d", "<link rel=canonical href=/c><meta http-equiv=refresh content='1;URL=//x.net/fr/'>"),
        (7, None, None),
        (8, "no scheme", "<b>"),
        (9, "http://sub.net", ""),
        (10, "http://q.org/x?a=1", '<link rel="canonical" href="http://bad.net/es/2">'),
        (10, "http://q.org/x?a=1", ""),
        (11, "http://q.org/x", ""),
    ]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    rows = {(r.page_id, r.host, r.path, r.rule, r.verdict, r.by) for r in urls.judge(frame).collect()}
    assert rows == {
        (1, "a.example.com", "/en/x", "example.com/en/", "block", "rule"),
        (2, "www.example.com", "/en/x", "www.example.com/en/", "allow", "rule"),
        (3, "plain.org", "/a", None, "block", "alias"),
        (4, "other.org", "/b", None, "block", "alias"),
        (5, "both.org", "/c", None, "allow", "alias"),
        (6, "both.org", "/d", None, "allow", "alias"),
        (7, "", "", None, "allow", "default"),
        (8, "", "", None, "allow", "default"),
        (9, "sub.net", "", None, "allow", "default"),
        (10, "q.org", "/x", None, "block", "alias"),
        (11, "q.org", "/x", None, "allow", "default"),
    }
    second = [(1, "http://a.org/", '<link rel=canonical href=http://b.org/><link rel="canonical" href="http://bad.net/es/1">'), (2, "http://b.org/", None)]
    assert {r.verdict for r in urls.judge(spark.createDataFrame(second, "page_id long, url string, html string")).collect()} == {"block"}
    assert urls.judge(frame.limit(0)).isEmpty()
    more = spark.createDataFrame([("http://q.org/x", "http://bad.net/es/9")], "source string, target string")
    assert urls.judge(frame, edges=more).where("page_id = 11").first().verdict == "block"


def test_aliases_of_a_hub(spark):
    """A third of all pages name one address, which a chain of others leads to."""
    hub = [(i, f"http://p{i}.org/", '<link rel=canonical href="http://hub.org/">') for i in range(300)]
    chain = [(300 + i, f"http://c{i}.org/", f'<meta http-equiv=refresh content="0;url=http://c{i + 1}.org/">') for i in range(60)]
    chain.append((360, "http://c60.org/", '<link rel=canonical href="http://hub.org/"><link rel=canonical href="http://bad.net/es/x">'))
    alone = [(400 + i, f"http://x{i}.org/", None) for i in range(500)]
    rows = urls.judge(spark.createDataFrame(hub + chain + alone, "page_id long, url string, html string")).collect()
    assert {r.page_id for r in rows if r.verdict == "block"} == set(range(361)) and len(rows) == 861


def test_new_columns_do_not_touch_those_of_the_same_name(spark):
    """General functions on a table that has their column already."""
    docs = spark.createDataFrame([(1, "one two", "mine", 7)], "doc_id long, text string, FINGERPRINT string, spans int")
    marked = simhash.with_fingerprint(docs)
    assert marked.columns == [*docs.columns, "_fingerprint"] and marked.first().FINGERPRINT == "mine"
    ids = sentencepiece.encode(docs.withColumnRenamed("spans", "ids"))
    assert ids.columns[-1] == "_ids" and ids.first().ids == 7
    back = sentencepiece.decode(ids, "_ids", "text")
    assert back.columns[-1] == "_text" and back.first()["_text"] == "one two"
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    found = decontaminate.find_passages(docs, items).first()
    assert found.spans == 7 and [tuple(x) for x in found["_spans"]] == [(1, 2)]
