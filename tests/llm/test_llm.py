"""Operators against brute force, round trips and held-out accuracy on small tables with odd rows."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, "é ñ " * 3000), (7, "a b c d e f " * 30), (8, "a b c d e f " * 30), (None, "no id")]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(None if i is None else 10_000 + i, t, None) for i, t in ODD]
    return d.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string")).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}


def test_ngram_join(docs, texts):
    from orrery.llm.ngram_join import ngram_jaccard_components

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_components(docs, 4, 85, 100).collect()}
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {i: (len(sets[i]), find(i)) for i in ids}


def test_ngram_join_empty(spark):
    from orrery.llm.ngram_join import ngram_jaccard_components

    assert ngram_jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_substring(docs, texts):
    from orrery.llm.substring_dedup import remove_spans, repeated_spans

    for batches in (1, 3):
        kept = {r.doc_id: (r.n_words, r.kept_text) for r in remove_spans(docs, repeated_spans(docs, n=50, batches=batches)).collect()}
        words, first = {i: t.encode().split() for i, t in sorted(texts.items())}, {}
        for i, w in words.items():
            for k in range(len(w) - 49):
                first.setdefault(tuple(w[k : k + 50]), i)
        for i, w in words.items():
            cut = set()
            for k in range(len(w) - 49):
                if first[tuple(w[k : k + 50])] < i:
                    cut.update(range(k, k + 50))
            assert kept[i] == (len(w), b" ".join(x for k, x in enumerate(w) if k not in cut).decode())


def test_progressions():
    from orrery.llm.substring_dedup import progressions

    at = np.array([0, 2, 4, 6, 100, 102, 104, 3, 9, 1, 5])
    window = np.array([1] * 7 + [1] * 2 + [2] * 2)
    doc = np.array([1] * 7 + [2] * 2 + [2] * 2)
    back = [(window[b], doc[b], at[b] + k * s) for b, s, t in zip(*progressions(window, window, doc, at)) for k in range(t)]
    assert back == list(zip(window, doc, at))
    assert len(progressions(window, window, doc, at)[0]) == 5
    assert [len(x) for x in progressions(*(np.zeros(0, int),) * 4)] == [0, 0, 0]


def test_merged_spans():
    from orrery.llm.substring_dedup import merged_spans

    rng = np.random.default_rng(5)
    for _ in range(300):
        n, m = int(rng.choice([1, 3, 5])), int(rng.integers(0, 9))
        row, at, step, times = rng.integers(0, 3, m), rng.integers(0, 30, m), rng.integers(1, 9, m), rng.integers(1, 4, m)
        covered = sorted({(r, a + k * s + j) for r, a, s, t in zip(row.tolist(), at.tolist(), step.tolist(), times.tolist()) for k in range(t) for j in range(n)})
        want = []
        for r, w in covered:
            if want and want[-1][0] == r and want[-1][2] == w:
                want[-1][2] = w + 1
            else:
                want.append([r, w, w + 1])
        assert [list(x) for x in zip(*(x.tolist() for x in merged_spans(row, at, step, times, n)))] == want


def test_substring_periodic(spark):
    """Lines that one document repeats, near and far apart, and other documents share."""
    from orrery.llm.substring_dedup import remove_spans, repeated_spans

    far = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "x y " * 40), (2, "x y " * 300 + "z"), (3, "q " + "x y " * 30 + far), (4, (far + " x ") * 5), (5, "y x " * 25 + far), (6, (far + " other ") * 4 + "x y " * 60), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, first = {i: (t or "").encode().split() for i, t in rows}, {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for batches in (1, 2):
        kept = {r.doc_id: r.kept_text for r in remove_spans(docs, repeated_spans(docs, n=50, batches=batches)).collect()}
        for i, w in words.items():
            cut = {j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
            assert kept[i] == b" ".join(x for k, x in enumerate(w) if k not in cut).decode()


def test_chat_round_trip(spark):
    from orrery.llm.chat_format import format_conversations, read_back

    rows = [(1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "\\0\\1 ### </turn>\n</turn>"), (2, 0, "ro: le", None), (2, 1, None, "x"), (3, 0, "assistant", "")]
    f = format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.conv_id: r.valid for r in f.collect()} == {1: True, 2: False, 3: False}
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read_back(f).collect()}
    assert back == {1: [(r[2], r[3]) for r in rows[:2]], 2: [("ro: le", ""), ("", "x")], 3: [("assistant", "")]}


def test_quality(docs, texts):
    from orrery.llm.quality_rules import judge_quality

    for r in judge_quality(docs.where("doc_id is not null")).collect():
        w = texts[r.doc_id].encode().split()
        grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(8)}
        text = texts[r.doc_id]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.n_repeat_words) == (len(w), len(covered))
        assert r.word_chars == len(re.sub(r"[\x20\x09-\x0D]+", "", text)) and r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)


def test_quality_words(spark):
    """Labelled texts that only the word histogram can tell, and texts without a language, which have no reference of one."""
    from pyspark.sql import functions as F

    from orrery.llm.quality_rules import judge_quality

    sf = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    unnamed = d.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"))
    rows = judge_quality(d.unionByName(unnamed)).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    open_ = [r for r in rows if not r.base_failed and (r.char_distance or 0) <= 0.30 and r.word_distance is not None]
    bad = [r.kept for r in open_ if label.get(r.doc_id) == 0]
    good = [r.kept for r in open_ if label.get(r.doc_id) == 1]
    assert bad and sum(bad) <= 0.2 * len(bad)
    assert sum(good) >= 0.99 * len(good)
    mixed = [r.kept for r in open_ if label.get(r.doc_id - 10_000_000) == 1]
    assert mixed and sum(mixed) >= 0.99 * len(mixed)


def test_language(docs):
    from orrery.llm.language_id import fit_language_model, predict_language

    odd = docs.sparkSession.createDataFrame([(20_000, "\u00b2 \u00bd", None), (20_001, "\u2460\u2461 7", None)], "doc_id long, text string, lang string")
    docs = docs.unionByName(odd)
    out = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    model = fit_language_model(docs.where(f"not ({out})"))
    got = {r.doc_id: r for r in predict_language(docs, model).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.where(f"{out} and lang is not null").collect()]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for (i,) in docs.where(out).select("doc_id").collect())
    assert got[20_000].lang_pred == got[20_001].lang_pred == "und"
    assert got[10_001].lang_pred == got[10_002].lang_pred == "und" and got[10_001].score == 0


def test_packing(docs, texts):
    from orrery.llm.packing import pack_documents

    rows = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048 and {r.doc_id for r in rows} == set(texts)
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in rows)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    at = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()} == total
    least = -(-sum(total.values()) // 2048)
    assert len(fill) <= 1.02 * least + 2


def test_token_counts(spark, docs, texts, tmp_path):
    import sentencepiece

    from orrery.llm.token_counts import CountCache

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, cache = sentencepiece.SentencePieceProcessor(model_file=path), CountCache(spark, str(tmp_path / "cache"))
    for _ in range(2):  # the second call finds all counts
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in cache.count(docs, path).collect() if r.doc_id is not None}
        assert got == {i: (len(t.encode()), len(sp.encode(t))) for i, t in texts.items()}
    assert spark.read.parquet(str(tmp_path / "cache")).count() == len({*texts.values(), "no id"})


def test_token_files(docs, texts):
    from tokenizers import Tokenizer

    from orrery.llm.token_binary import read_token_files, token_files

    path = public_tokenizers.path("byte_bpe_50k.json")
    root, files = token_files(docs, path)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_token_files(files, root).collect()}
    t, start = Tokenizer.from_file(path), 0
    for i in sorted(texts):
        ids = np.array(t.encode(texts[i], add_special_tokens=False).ids + [0], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_decontamination(spark, docs):
    from orrery.llm.decontamination import benchmark_matches

    items = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(spark.createDataFrame([(-1, None), (-2, "")], "item_id long, text string"))
    planted = items.where("item_id >= 0").selectExpr("item_id + 20000 as doc_id", "concat(repeat('filler words here ', 20), replace(text, '.', ' really. '), ' and more') as text", "null as lang")
    got = {(r.doc_id, r.item_id) for r in benchmark_matches(docs.unionByName(planted), items).collect()}
    wanted = {(r.doc_id, r.doc_id - 20_000) for r in planted.collect()}
    assert len(wanted & got) >= 0.9 * len(wanted)
    assert not [p for p in got if 10_000 < p[0] < 20_000]


def test_decontamination_long_items(spark):
    """Verbatim and edited copies of items of 100 to 500 words, and texts of the same words that hold none."""
    from orrery.llm.decontamination import benchmark_matches

    rng = np.random.default_rng(5)
    vocabulary = np.array([f"w{k}" for k in range(8000)])
    share = 1 / (np.arange(8000) + 20.0)

    def prose(n):
        return rng.choice(vocabulary, n, p=share / share.sum())

    items = {n * 10 + k: prose(n) for n in (100, 140, 160, 200, 300, 400, 500) for k in range(4)}
    docs, wanted = [], set()
    for i, words in items.items():
        edited = np.where(rng.random(len(words)) < 0.1, prose(len(words)), words)[rng.random(len(words)) < 0.95]
        for d, inner in ((i, words), (10_000 + i, edited)):
            docs.append((d, " ".join([*prose(90 + i % 37), *inner, *prose(70)])))
            wanted.add((d, i))
    docs += [(20_000 + k, " ".join(prose(1000))) for k in range(200)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = benchmark_matches(d, spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == wanted


def test_warc(spark):
    from orrery.llm.warc import read_archives, write_archives

    rows = [(3, "u", "same"), (1, "u\r\n", "same"), (2, None, None), (5, "v", ""), (4, "w", "é\r\n\r\nContent-Length: 3\r\n" * 50)]
    got = {r.page_id: r for r in read_archives(*write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {1: ("response", None), 3: ("revisit", 1), 2: ("response", None), 5: ("revisit", 2), 4: ("response", None)}
    assert all(got[i].payload_bytes == len((h or "").encode()) for i, _, h in rows)
    assert all(got[i].payload_digest == base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, _, h in rows)


def test_warc_repeated_ids(spark):
    """Rows that share an id with other payloads are written each, a payload that no other page has among them."""
    from orrery.llm.warc import read_archives, write_archives

    rows = [(1, "u", "a"), (2, "u", "a"), (2, "u", "bb"), (3, "u", "ccc"), (4, "u", "ccc"), (4, "u", "a"), (4, "u", "a")]
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in read_archives(*write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect())
    assert got == [(1, 1, "response", None), (2, 1, "revisit", 1), (2, 2, "response", None), (3, 3, "response", None), (4, 1, "revisit", 1), (4, 1, "revisit", 1), (4, 3, "revisit", 3)]


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) <= spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stages(spark):
    """Near duplicates, cut passages and dropped leaks of the given documents against plain Python."""
    import corpus_pipeline

    from orrery.llm.decontamination import lcs_length

    d = spark.read.parquet(f"{SF}/documents.parquet").cache()
    rows = {r.doc_id: r for r in d.collect()}
    words = {i: (rows[i].text or "").encode().split() for i in sorted(rows)}

    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} - {()} for i, w in ((i, (rows[i].text or "").encode().lower().split()) for i in words)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: r for r in corpus_pipeline.near_duplicates(spark, d, SF).collect()}
    assert got == {i: rows[i] for i in rows if find(i) == i}

    first = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    wanted = {}
    for i, w in words.items():
        cut = {j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        text = b" ".join(x for k, x in enumerate(w) if k not in cut).decode()
        if not cut:
            wanted[i] = rows[i].asDict()
        elif len(cut) < len(w):
            wanted[i] = {**rows[i].asDict(), "text": text, "n_chars": len(text)}
    assert {r.doc_id: r.asDict() for r in corpus_pipeline.repeated_passages(spark, d, SF).collect()} == wanted

    def parts(text):
        return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text or "").split()

    code = {}
    items = [np.array([code.setdefault(w, len(code)) for w in parts(r.text)]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in corpus_pipeline.decontamination(spark, d, SF).collect()}
    for i, r in rows.items():
        text = parts(r.text)
        coded, whole = np.array([code.get(w, -1) for w in text]), " ".join(map(str, (code.get(w, -1) for w in text)))
        if any(len(w) and f" {' '.join(map(str, w))} " in f" {whole} " for w in items):
            assert i not in kept
        elif all(lcs_length(w, coded) < 0.6 * len(w) for w in items):
            assert i in kept


def test_words_that_polynomials_confuse(spark):
    """Thue-Morse words and their complements, alike under any polynomial hash, in shingles, windows and items."""
    from orrery.llm.decontamination import benchmark_matches
    from orrery.llm.ngram_join import ngram_jaccard_components
    from orrery.llm.substring_dedup import remove_spans, repeated_spans

    for rounds in (5, 8, 10, 11):
        one = "a"
        for _ in range(rounds):
            one += one.translate(str.maketrans("ab", "ba"))
        two = one.translate(str.maketrans("ab", "ba"))
        df = spark.createDataFrame([(1, f"x y z {one}"), (2, f"x y z {two}")], "doc_id long, text string")
        assert {r.doc_id: r.component_id for r in ngram_jaccard_components(df, 4, 85, 100).collect()} == {1: 1, 2: 2}
    head = " ".join(f"w{k}" for k in range(49))
    df = spark.createDataFrame([(1, f"{head} {one}"), (2, f"{head} {two}"), (3, f"{head} {one}  q")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_spans(df, repeated_spans(df)).collect()} == {1: 0, 2: 0, 3: 50}
    items = spark.createDataFrame([(1, f"{one} {one} {one}")], "item_id long, text string")
    assert [r.doc_id for r in benchmark_matches(spark.createDataFrame([(1, f"q {one} {one} {one}"), (2, f"q {two} {two} {two}")], "doc_id long, text string"), items).collect()] == [1]


def test_paraphrases(spark):
    """Of items whose copies were edited, those that keep 0.6 of the words in order and half of the answer are found."""
    from orrery.llm.decontamination import benchmark_matches, lcs_length

    rng = np.random.default_rng(9)
    docs = [r.text.split() for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text and 40 < len(r.text.split()) < 3000]
    pool = [w for d in docs for w in d]
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}

    def parts(text):
        return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text).split()

    rows, wanted = [], set()
    for k, (i, text) in enumerate(sorted(items.items()) * 4):
        kept = [pool[rng.integers(len(pool))] if rng.random() < 0.18 else w for w in text.split() if rng.random() > 0.08]
        host, own = docs[k % len(docs)], parts(text)
        rows.append((50_000 + k, " ".join([*host, *kept, *host[::-1]])))
        code = {w: n for n, w in enumerate(set(own))}
        a, b = np.array([code[w] for w in own]), np.array([code.get(w, -1) for w in parts(" ".join(kept))])
        answer = a[len(a) - max(1, -(-len(a) // 4)) :]
        if lcs_length(a, b) >= 0.6 * len(a) and lcs_length(answer, b) >= 0.5 * len(answer):
            wanted.add((50_000 + k, i))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in benchmark_matches(df, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert len(wanted) > 50 and len(wanted & got) >= 0.9 * len(wanted)


def test_latent_basis(spark):
    """The randomised SVD over partitions against the dense one."""
    from orrery.llm.decontamination import latent_basis, unit_entries

    rng = np.random.default_rng(2)
    weights = rng.random(60) + 0.1
    lists = [rng.integers(0, 60, rng.integers(1, 30)).tolist() for _ in range(300)]
    basis, sizes = latent_basis(spark.createDataFrame([(x,) for x in lists], "words array<long>").repartition(5), weights, 10, rounds=12)
    row, word, value = unit_entries(np.array([len(x) for x in lists]), np.concatenate(lists), weights)
    a = np.zeros((300, 60))
    a[row, word] = value
    assert np.allclose(np.linalg.norm(a, axis=1), 1)
    assert np.allclose(sizes, np.linalg.svd(a, compute_uv=False)[:10], rtol=0.02) and np.allclose(basis.T @ basis, np.eye(10), atol=1e-6)


def test_many_languages(spark):
    """Every language is learned and has a list of its own, however many there are."""
    from orrery.llm.language_id import fit_language_model, predict_language
    from orrery.llm.quality_rules import judge_quality

    def word(k, j):
        return "".join(chr(97 + (k * 7 + j * 3 + n * (k % 5 + 1)) % 26) for n in range(4))

    rows = [(k * 25 + d, " ".join(word(k, (d + j) % 9) for j in range(60)), f"l{k:02d}") for k in range(70) for d in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(fit_language_model(df).languages) == 70
    assert len({r.lang_pred for r in predict_language(df, fit_language_model(df)).collect()}) > 64
    assert all(r.word_distance is not None for r in judge_quality(df).collect())


def test_repeated_ids(spark):
    """Rows that repeat an id: counted once in groups, cut only where they are the chosen text, kept as many in the pipeline."""
    import corpus_pipeline
    from orrery.llm.ngram_join import ngram_jaccard_components
    from orrery.llm.substring_dedup import remove_spans, repeated_spans

    base, other = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(70))
    rows = [(1, base), (2, base), (2, base), (3, other), (3, base + " c"), (4, other)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t), k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars int, n_words int")
    assert sorted((r.doc_id, r.component_id) for r in ngram_jaccard_components(df).collect()) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    cut = sorted((r.doc_id, r.n_words, r.n_removed) for r in remove_spans(df, repeated_spans(df)).collect())
    assert cut == [(1, 60, 0), (2, 60, 60), (2, 60, 60), (3, 61, 60), (3, 70, 0), (4, 70, 0)]
    left = sorted((r.doc_id, r.n_words, r.text) for r in corpus_pipeline.repeated_passages(spark, df, SF).collect())
    assert left == [(1, 0, base), (3, 3, other), (3, 4, "c"), (4, 5, other)]


def test_empty_tables_and_clashing_columns(spark):
    """No rows give no rows; columns named as the operators' own are ignored."""
    from orrery.llm import queries as Q

    class Tables:
        def __init__(self, **frames):
            self.frames = frames

        def __call__(self, spark, sf_dir, name):
            return self.frames[name]

    real, clash = Q._table, "n long, token long, component_id long, window long, words string, spans string, rank long, content string, own string, first long, n_words long"
    extra = {c.split()[0]: c.split()[1] for c in clash.split(", ")}
    tables = {name: spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "pages", "benchmark", "conversations")}
    try:
        Q._table = Tables(**{k: v.limit(0) for k, v in tables.items()})
        for name, query in Q.QUERIES.items():
            assert query(spark, SF).count() == (1 if name.startswith("op3") else 0), name
        from pyspark.sql import functions as F

        small = {k: v.where(f"{v.columns[0]} < 40") for k, v in tables.items()}
        wide = {k: v.withColumns({c: F.lit("7").cast(t) for c, t in extra.items() if c not in v.columns}) for k, v in small.items()}
        for name in ("op1_ngram_jaccard_join", "op2_substring_dedup", "op4_quality_rules", "op6_packing", "op9_benchmark_decontamination", "op10_warc"):
            Q._table = Tables(**small)
            want = sorted(map(repr, Q.QUERIES[name](spark, SF).collect()))
            Q._table = Tables(**wide)
            assert sorted(map(repr, Q.QUERIES[name](spark, SF).collect())) == want, name
    finally:
        Q._table = real


def test_products_of_all_passages(spark, docs):
    """A^T A over every passage of every text, whole and cut into small sums, against the dense product."""
    from orrery.llm import decontamination as D

    rng = np.random.default_rng(4)
    weights = np.where(rng.random(50) < 0.1, 0.0, rng.random(50) + 0.1)
    lists = [rng.integers(0, 50, rng.integers(0, 30)).tolist() for _ in range(400)] + [[], [7], [3, 3, 3]]
    row, word, value = D.unit_entries(np.array([len(x) for x in lists]), np.concatenate([np.array(x, np.int64) for x in lists]), weights)
    a = np.zeros((len(lists), 50))
    a[row, word] = value
    df = spark.createDataFrame([(x,) for x in lists], "words array<long>").repartition(3)
    got = np.zeros((50, 50))
    for r in D.products(df, weights).collect():
        got.reshape(-1)[np.frombuffer(r["cell"], np.int64)] = np.frombuffer(r["value"], np.float64)
    assert np.allclose(got, a.T @ a)
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64()))], names=["words"])
    most, D.PAIRS = D.PAIRS, 64
    try:
        got = np.zeros((50, 50))
        for out in D._pairs(weights, D._of_lists)([batch]):
            np.add.at(got.reshape(-1), out.column(0).to_numpy(), out.column(1).to_numpy())
    finally:
        D.PAIRS = most
    assert np.allclose(got, np.triu(a.T @ a))


def test_every_document_fits_the_space(spark, monkeypatch):
    """The passages that make the space are those of all documents and items."""
    from orrery.llm import decontamination as D

    seen = []
    fitted = D.latent_basis
    monkeypatch.setattr(D, "latent_basis", lambda passages, *a, **b: seen.append(passages.count()) or fitted(passages, *a, **b))
    docs = spark.range(9000).selectExpr("id as doc_id", "concat('alpha beta gamma delta epsilon w', id % 50) as text")
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon w3 zeta eta"), (2, None)], "item_id long, text string")
    D.benchmark_matches(docs, items).count()
    assert seen == [9002]


def test_pipeline_fits_on_all_documents(spark, monkeypatch):
    """The pipeline's decontamination makes its space from every passage of its documents and the benchmark."""
    import corpus_pipeline

    from orrery.llm import decontamination as D

    seen = []
    fitted = D.latent_basis
    monkeypatch.setattr(D, "latent_basis", lambda passages, *a, **b: seen.append(passages.count()) or fitted(passages, *a, **b))
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('alpha beta gamma delta w', id % 50) as text")
    assert corpus_pipeline.decontamination(spark, docs, SF).count() == 6000
    assert seen == [6000 + spark.read.parquet(f"{SF}/benchmark.parquet").count()]
