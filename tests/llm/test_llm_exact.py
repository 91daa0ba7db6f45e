"""Operators against libraries and brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import time
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidegauge.llm import (
    components,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    neighbours,
    packing,
    quotation_threads,
    sentence_pieces,
    sharding,
    shingles,
    token_counts,
)

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ALPHABET = st.text(st.sampled_from("ab er▁ \nthe日🙂éﬁ.,1A\t"), max_size=60) | st.text(max_size=30)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_counts_at_every_prefix(text):
    table = token_counts.counter(PIECES).table(text)
    assert table.tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=5), st.lists(st.integers(0, 31_999) | st.integers(0, 258), max_size=12))
def test_codec_is_the_library(some, ids):
    codec = sentence_pieces.codec(PIECES)
    for text, found in zip(some, codec.encode(some)):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text)
        assert codec.decode(np.array(library.encode(text), int)) == library.decode(library.encode(text))
    assert codec.decode(np.array(ids, int)) == library.decode(ids)


@pytest.mark.parametrize("text", ["ab" * 3000, "a" * 4000, " " * 500 + "x", "x" + " " * 77, "thethe" * 900, "日本" * 700])
def test_unbroken_texts(text):
    ids = library.encode(text)
    assert np.frombuffer(sentence_pieces.codec(PIECES).encode([text])[0], "<u4").tolist() == ids
    assert token_counts.counter(PIECES).table(text)[-1] == len(ids)


def test_token_queries(spark, texts):
    for r in token_counts.query(spark, SF).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 4096, len(texts[r["doc_id"]].encode()))
    for r in sentence_pieces.query(spark, SF).collect():
        ids = np.array([1, *library.encode(texts[r["doc_id"]]), 2], "<u4")
        text = library.decode(ids.tolist())
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stored_prefixes_answer_questions(spark):
    df = spark.createDataFrame([(1, "some words to count, and more"), (2, "")], "doc_id long, text string")
    stored = token_counts.with_prefix_counts(df)
    asked = stored.select(
        "doc_id", token_counts.count_at(F.col("prefix_counts"), F.lit(10)).alias("ten"), token_counts.longest_within(F.col("prefix_counts"), 3).alias("fit")
    )
    got = {r["doc_id"]: (r["ten"], r["fit"]) for r in asked.collect()}
    text = "some words to count, and more"
    assert got[2] == (0, 0) and got[1][0] == len(library.encode(text[:10]))
    assert got[1][1] == max(i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= 3)
    encoded = sentence_pieces.decode(sentence_pieces.encode(df)).collect()
    assert {r["doc_id"]: r["text"] for r in encoded} == {1: text, 2: ""}


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: np.array([*tokenizer.encode(v, add_special_tokens=False).ids, 2], "<u4") for k, v in texts.items()}
    pieces = packing.query(spark, SF).orderBy("sequence_id", "offset").collect()
    place, by_doc = 0, collections.defaultdict(list)
    for p in pieces:
        assert p["sequence_id"] * 4096 + p["offset"] == place and p["offset"] + p["length"] <= 4096
        place += p["length"]
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own) and p["ids_crc32"] == zlib.crc32(own[p["start"] : p["start"] + p["length"]].tobytes())
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
    for doc, parts in by_doc.items():
        assert [s for s, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)][:-1]]).tolist()
    assert place == sum(map(len, ids.values()))


@pytest.mark.parametrize("text", ["a <|endoftext|>b", "don't 's  x y", "Σας ΣΑΣ", "é ́x", "Å K\n\nz", " a\x85b"])
def test_chunks_give_the_library_ids(text):
    own = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_asks_for_many_words_at_once(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, tokenizer, asked = packing.ChunkTokenizer(path), Tokenizer.from_file(path), []
    ask = own._ids
    monkeypatch.setattr(own, "_ids", lambda texts: asked.extend(texts) or ask(texts))
    letters = "abcdefghij"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters]
    texts = [" ".join(words), "\n".join(words).upper() + ".", "Ab's " + ", ".join(words), ""]
    got = own.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) < 50  # not one by one


def test_packing_takes_texts_in_slices(spark, monkeypatch):
    texts = ["one two"] * 5 + ["word " * 100, "", "x"] * 5
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(packing, "SLICE_BYTES", 200)
    pieces = list(packing.slices(batch))
    assert [t for p in pieces for t in p.column(1).to_pylist()] == texts
    assert len(pieces) > 3 and all(sum(map(len, p.column(1).to_pylist()[1:])) <= 200 for p in pieces)
    monkeypatch.undo()
    rows = spark.createDataFrame(list(enumerate(texts * 200)), "doc_id long, text string").coalesce(1)
    stored = packing.tokenized(rows).orderBy("doc_id").collect()
    assert [r["before"] for r in stored] == np.cumsum([0, *[r["doc_tokens"] for r in stored[:-1]]]).tolist()


WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_shingles(text):
    words = WORD.findall(text.translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    sets = {i: word_shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, shared = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for x in s:
            shared.update((j, i) for j in holders[x])
            holders[x].append(i)
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_shingle_hashes_are_sets():
    text = "A b\tC d e f  a B c d E"
    assert len(np.unique(shingles.shingle_hashes(text))) == len(word_shingles(text)) == 6
    assert len(shingles.shingle_hashes("x Y")) == 1 and len(shingles.shingle_hashes(" \n")) == 0
    assert (shingles.shingle_hashes("one TWO three four five") == shingles.shingle_hashes("ONE two\nthree  four five")).all()


def test_jaccard_groups(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.query(spark, SF).collect()}
    assert got == brute_groups(texts)


def near_copies(groups, size, seed):
    """Groups of near copies around the threshold, with a passage that all documents share."""
    rng, texts = random.Random(seed), {}
    passage = [f"p{k}" for k in range(30)]
    for g in range(groups):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([12, 60, 150]))] + passage
        for _ in range(size):
            own = list(words)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
    return texts


def test_long_lists_in_blocks(spark, monkeypatch):
    """Short lists of two and blocks of four, so that most links come from block pairs."""
    texts = near_copies(6, 25, 5)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    expected = brute_groups(texts)
    assert len({c for _, c in expected.values()}) > 6
    for short, block, hot in ((64, 512, 10_000), (2, 4, 10_000), (4, 16, 20)):
        monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
        monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", block)
        monkeypatch.setattr(jaccard_join, "HOT_LEAST", hot)
        got = jaccard_join.link_groups(df).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_longer_prefixes_ask_for_more_matches():
    assert jaccard_join.choose_length(100, np.full(70, 2)) == (0, 0)  # 30 shingles of its own: no partner
    cheap = jaccard_join.choose_length(100, np.full(100, 2))
    costly = jaccard_join.choose_length(100, np.array([500] * 30 + [501] * 70))
    assert costly[0] > 1 and costly[1] == 20 + costly[0] and cheap[1] == 20 + cheap[0]


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 40) if k % 10 != 9] + [(100, k) for k in range(200, 240)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {k: k // 10 * 10 for k in range(0, 40)} | {100: 100} | {k: 100 for k in range(200, 240)}


def test_fingerprints(spark, texts):
    ids = sorted(texts)
    for r in fingerprints.query(spark, SF).collect():
        text = texts[r["doc_id"]]
        after = texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.to_text(fingerprints.sketch(text))
        assert r["edited_fingerprint"] == fingerprints.to_text(fingerprints.sketch(edited))
        near = fingerprints.likeness(fingerprints.sketch(text), fingerprints.sketch(after))
        assert r["near_next"] == near and 0 <= r["near_edited"] <= 1


def test_sketches_merge_and_tell_containment(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(9999)}" for _ in range(6000)]
    whole, part, other = " ".join(words), " ".join(words[500:900]), " ".join(words[::-1])
    a, b = fingerprints.sketch(" ".join(words[:3000])), fingerprints.sketch(" ".join(words[2996:]))
    assert (fingerprints.merge(a, b) == fingerprints.sketch(whole)).all()
    assert fingerprints.containment(fingerprints.sketch(part), fingerprints.sketch(whole)) == 1.0
    assert fingerprints.containment(fingerprints.sketch(other), fingerprints.sketch(whole)) < 0.05
    half = fingerprints.sketch(" ".join(words[:3000]))
    assert abs(fingerprints.likeness(half, fingerprints.sketch(whole)) - 0.5) < 0.05
    df = spark.createDataFrame([(1, part, whole)], "k long, a string, b string")
    made = df.select("k", F.lit(fingerprints.to_text(fingerprints.sketch(part))).alias("a"), F.lit(fingerprints.to_text(fingerprints.sketch(whole))).alias("b"))
    assert fingerprints.compare(made, "a", "b").first()["containment"] == 1.0


def test_shards_match_the_mixture(spark, documents):
    got = sharding.shard(documents, bucket_rows=16).collect()
    sizes = collections.Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    sources = collections.Counter(r["source"] for r in got)
    for (shard, source), n in collections.Counter((r["shard"], r["source"]) for r in got).items():
        assert abs(n - sources[source] / 8) < 2
    again = sharding.shard(documents.repartition(7), bucket_rows=64).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["shard"], r["slot"]) for r in got}


def test_neighbours_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 24))
    points = centres[rng.integers(0, 40, 6000)] + 0.3 * rng.standard_normal((6000, 24))
    points[1000:1900] = points[1000]  # a group of copies
    df = spark.createDataFrame([(i, p.astype("f4").tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<float>")
    old = neighbours.CELL_ROWS
    neighbours.CELL_ROWS = 500
    try:
        got = neighbours.nearest(df, df.filter("vec_id % 50 = 0")).collect()
    finally:
        neighbours.CELL_ROWS = old
    points = points.astype("f4").astype("f8")
    norms = np.linalg.norm(points, axis=1)
    hits = total = 0
    for q in range(0, 6000, 50):
        score = points @ points[q] / (norms * norms[q])
        score[1000:1900] = score[1000]
        score[q] = -9
        best = sorted(range(6000), key=lambda i: (-score[i], i))[:5]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(abs(s - score[v]) < 1e-12 for _, v, s in own)
        if 1000 <= q < 1900:
            assert [v for _, v, _ in own] == [v for v in range(1000, 1006) if v != q][:5]
        hits, total = hits + len({v for _, v, _ in own} & set(best)), total + 5
    assert hits / total >= 0.95


@pytest.mark.parametrize("alphabet", ["e", "th e", "the", "ab", "0123456789", "=-", "été ", "aeiou▁"])
def test_long_unbroken_words_are_the_library(alphabet):
    rng = random.Random(alphabet)
    codec = sentence_pieces.codec(PIECES)
    for size in (sentence_pieces.ROUNDS_LENGTH - 3, sentence_pieces.ROUNDS_LENGTH + 2, 3000):
        for text in (alphabet * (size // len(alphabet)), "".join(rng.choices(alphabet, k=size))):
            assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode(text)


def test_a_million_unbroken_characters():
    codec = sentence_pieces.codec(PIECES)
    for alphabet in ("e", "th"):
        text = alphabet * (1_000_000 // len(alphabet))
        start = time.process_time()
        found = codec.encode([text])[0]
        assert time.process_time() - start < 30
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text)


def test_neighbours_recall_on_the_table(spark, monkeypatch):
    """Recall of the query's own table against all pairs, several cells; and how many vectors are verified."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").dropna().collect()
    ids, points = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], "f8")
    monkeypatch.setattr(neighbours, "CELL_ROWS", 1000)
    got = collections.defaultdict(set)
    for r in neighbours.query(spark, "/root/testdata/sf0.1").collect():
        got[r["query_id"]].add(r["vec_id"])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    hits = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[k]
        score[k] = -9
        best = ids[np.lexsort((ids, -score))[:5]]
        hits, total = hits + len(got[ids[k]] & set(best.tolist())), total + 5
    assert hits / total >= 0.9
    index = neighbours.CellIndex(points)
    quantile = neighbours.chi_square_quantile(neighbours.CONFIDENCE, neighbours.PROJECTED)
    asked = np.flatnonzero(ids % 50 == 0)
    for k in asked:
        index.search(points[k], index.points[k], 6, quantile, np.inf)
    share = index.verified / (len(asked) * len(points))
    print(f"recall {hits / total:.3f}, verified {share:.3f} of {len(points)}")
    assert share < 0.75


def test_cells_in_parts_and_chunks(spark, monkeypatch):
    """Parts of vectors and chunks of queries change no result."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.standard_normal(6).tolist()) for i in range(700)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "CONFIDENCE", 0.999999)
    want = sorted(map(tuple, neighbours.nearest(df, df.filter("vec_id % 7 = 0"), confidence=0.999999).collect()))
    monkeypatch.setattr(neighbours, "CELL_ROWS", 40)
    monkeypatch.setattr(neighbours, "MOST_CELLS", 3)
    monkeypatch.setattr(neighbours, "CELL_QUERIES", 9)
    assert sorted(map(tuple, neighbours.nearest(df, df.filter("vec_id % 7 = 0"), confidence=0.999999).collect())) == want


def test_chi_square_quantile():
    # tabled values
    assert neighbours.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert neighbours.chi_square_quantile(0.99, 8) == pytest.approx(20.090, abs=1e-3)


@pytest.mark.parametrize("batches, fan_out", [(1, 2), (3, 2), (7, 3)])
def test_lines_in_any_number_of_batches(spark, batches, fan_out):
    rng = random.Random(batches)
    pool = [f"a repeated line of some length {k}" for k in range(12)] + ["short", ""]
    texts = {i: "\n".join([rng.choice([" ", "", "\t"]) + rng.choice(pool).title() for _ in range(6)] + [f"own line number {i} here"]) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    holders = collections.defaultdict(set)
    for i, t in texts.items():
        for line in t.split("\n"):
            holders[line.strip().lower()].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    expected = {i: "\n".join(x for x in t.split("\n") if gone.get(x.strip().lower(), i) == i) for i, t in texts.items()}
    got = line_dedup.clean(df, batches=batches, fan_out=fan_out).select("row.doc_id", "kept").collect()
    assert {r["doc_id"]: r["kept"] for r in got} == expected


def test_runs_are_compacted(spark):
    store = line_dedup.RunStore(fan_out=2)
    for k in range(5):
        store.add(spark.createDataFrame([(k, k), (k, k + 1)], "hash_a long, hash_b long"))
    assert [len(level) for level in store.levels] == [1, 0, 1]
    assert sum(run.count() for run in store.runs()) == 10
    probe = spark.createDataFrame([(0, 0), (9, 9), (4, 5)], "hash_a long, hash_b long")
    assert [tuple(r) for r in store.unseen(probe).collect()] == [(9, 9)]


def test_languages_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = language_id.query(spark, sf).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98


def test_kernel_is_folded_into_weights():
    presence = language_id.Presence()
    samples = [("a", presence.slots(t)) for t in ("aabbaabb", "abba abba")] + [("b", presence.slots(t)) for t in ("xyzzyxyz", "zyx xyz")]
    model = language_id.fit(samples)
    names, scores = model.predict(["aabb abba", "xyz zyx", "", None, "12 !"])
    assert names == ["a", "b", "und", "und", "und"] and (scores[2:] == 0).all() and (scores[:2] > 0.5).all()
    assert language_id.fit([]).predict(["text"])[0] == ["und"]


def invented(number, rng):
    """As many languages, each with words of its own made of syllables that several share."""
    syllables = [c + v + e for c in "bdfgklmnprstvz" for v in "aeiou" for e in ("", "n", "r", "s")]
    return [["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(60)] for _ in range(number)]


@pytest.mark.parametrize("number", [1, 2, 4, 40])
def test_told_language_whatever_the_number_of_languages(spark, number):
    rng = random.Random(number)
    words = invented(number, rng)
    rows = [(k, " ".join(rng.choices(words[k % number], k=50)), f"l{k % number:02d}") for k in range(25 * number)]
    rows.append((-1, "12 + 12 = 24", None))
    rows.append((-3, "этот текст написан на совсем другом языке " * 3, None))
    rows.append((-4, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=400)), None))
    if number > 2:  # of two languages the better one stands out always
        rows.append((-2, " ".join(w for own in words for w in own), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"] for r in corpus_pipeline.told_language(spark, docs, "").collect()}
    assert got == set(range(25 * number))


def test_told_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in corpus_pipeline.told_language(spark, docs, "").collect()] == [(1, "some words", None)]


def test_outputs_are_those_of_the_explicit_kernel():
    """N-gram sets, kernel, Nystroem landmarks and ridge solution written out, beside the folded weights."""

    def grams(text):
        text = text.lower()
        return {(n, text[i : i + n]) for n in language_id.ORDERS for i in range(len(text) - n + 1)}

    def kernel(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5

    rng = random.Random(3)
    words = invented(3, rng)
    texts = [(f"l{k % 3}", " ".join(rng.choices(words[k % 3], k=12))) for k in range(24)]
    presence = language_id.Presence()
    # hardly a slot is shared
    assert sum(len(presence.slots(t)) for _, t in texts) > 0.995 * sum(len(grams(t)) for _, t in texts)
    model = language_id.fit([(lang, presence.slots(t)) for lang, t in texts], landmarks_per_lang=4, ridge=1e-2)
    hashed = lambda t: set(presence.slots(t).tolist())
    sets = [hashed(t) for _, t in texts]
    marks = [k for k in range(24) if k < 12]
    full = np.array([[kernel(a, sets[m]) for m in marks] for a in sets])
    target = np.array([[1.0 if lang == own else -1.0 for own in model.languages] for lang, _ in texts])
    dual = np.linalg.solve(full.T @ full + 1e-2 * 24 * full[marks] + 1e-9 * np.eye(12), full.T @ target)
    new = [" ".join(rng.choices(words[k % 3], k=9)) for k in range(90)]
    want = np.array([[kernel(hashed(t), sets[m]) for m in marks] for t in new]) @ dual
    got = model.outputs([presence.slots(t) for t in new])
    assert np.abs(got - want).max() < 1e-4 and (got.argmax(axis=1) == np.arange(90) % 3).mean() > 0.95


@pytest.mark.parametrize("number", [2, 4, 22, 100])
def test_score_of_ideal_outputs(number):
    weights = np.where(np.eye(number) > 0, 1.0, -1.0).astype("f4")[:1]
    slots = language_id.Presence().slots("ab")
    model = language_id.Model([f"l{k}" for k in range(number)], slots, weights)
    assert model.predict(["ab"])[1][0] > 0.99


def test_pipeline(spark, texts):
    pieces = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    cleaned = corpus_pipeline.STAGES[1][1](spark, kept, SF)
    left = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    groups = brute_groups({i: t or "" for i, t in left.items()})
    assert {p["doc_id"] for p in pieces} == {i for i, (n, c) in groups.items() if n == 0 or c == i}
    assert {r["doc_id"]: r["n_chars"] for r in cleaned.collect()} == {i: len(t) for i, t in left.items()}


QUOTES = [
    (0, "The harbour opens at six.\nBring the long ropes."),
    (1, "> The harbour opens at six.\nThen I am there at five."),
    (2, "Which ropes?\n> bring  the LONG ropes."),
    (3, ">> The harbour opens at six.\n> Then I am there at five.\nToo early."),
    (4, "> nobody ever wrote this\nAnything else?"),
    (5, "> Which ropes?\nThe blue ones."),
]


def test_threads(spark):
    df = spark.createDataFrame([(7, t, "user", text) for t, text in QUOTES], "conv_id long, turn int, role string, text string")
    got = {r["turn"]: r for r in quotation_threads.threads(df.repartition(3)).collect()}
    assert [got[t]["reply_to"] for t in range(6)] == [None, 0, 0, 1, None, 2]
    assert [got[t]["thread"] for t in range(6)] == [0, 0, 0, 0, 4, 0]
    assert [got[t]["position"] for t in range(6)] == [0, 1, 2, 3, 5, 4]
    assert got[3]["body"] == "Too early." and got[3]["quote_depth"] == 2 and got[5]["body"] == "The blue ones."
