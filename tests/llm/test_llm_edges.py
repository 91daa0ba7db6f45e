"""Every operator and stage on awkward tables: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegauge.llm import (
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    neighbours,
    packing,
    quotation_threads,
    sentence_pieces,
    sharding,
    token_counts,
)

LONG = " ".join(f"word{i % 701} x{i}" for i in range(20_000))
TEXTS = [None, "", "   \n\t", "one", "the same line that is long enough\nand another", LONG, LONG + " tail", "日本語 🙂 é", "12 34 !?"]
# names that operators use themselves
CLASHES = ["part", "n", "class", "hash", "key", "score", "lang_pred", "row", "rank", "kept", "gone", "lead", "ids", "own", "pos", "block"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def rows():
    out = []
    for i, text in enumerate([*TEXTS, *TEXTS[3:6]]):
        out.append((i, text, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None if text is None else len(text), *CLASHES))
    out += [out[4], out[4], (None, "no id at all here", "en", None, None, *[None] * len(CLASHES))]
    return out


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(rows(), COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


PER_ROW = {
    "token_counts": token_counts.count_tokens,
    "prefix_counts": token_counts.with_prefix_counts,
    "jaccard": jaccard_join.link_groups,
    "encode": sentence_pieces.encode,
    "round_trip": sentence_pieces.round_trip,
    "fingerprints": fingerprints.fingerprints,
    "edited": fingerprints.edited_likeness,
    "shards": sharding.shard,
    "lines": line_dedup.clean,
    "languages": lambda df: language_id.identify(df, language_id.learn(df)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(awkward, empty, name):
    assert PER_ROW[name](awkward).count() == len(rows())
    assert PER_ROW[name](empty).count() == 0


def test_packing_keeps_every_id(awkward, empty):
    assert packing.pack(empty).count() == 0
    tokens = packing.tokenized(awkward).agg(F.sum("doc_tokens")).first()[0]
    pieces = packing.pack(awkward).collect()
    assert sum(p["length"] for p in pieces) == tokens
    assert {p["doc_tokens"] for p in pieces if p["doc_id"] == 0} == {1}


def test_null_and_empty_texts(awkward):
    counts = {r["doc_id"]: r for r in token_counts.count_tokens(awkward).collect()}
    assert (counts[0]["n_tokens"], counts[0]["n_bytes"], counts[1]["n_tokens"]) == (0, 0, 0)
    trips = {r["doc_id"]: r for r in sentence_pieces.round_trip(awkward).collect()}
    assert trips[0]["n_tokens"] == 2 and trips[0]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    groups = {r["doc_id"]: r for r in jaccard_join.link_groups(awkward).collect()}
    assert [groups[i]["n_shingles"] for i in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert [groups[i]["component_id"] for i in (0, 1, 2)] == [0, 1, 2]
    assert groups[9]["component_id"] == 3 and groups[6]["component_id"] == 5  # a copy, and a near copy
    assert groups[None]["component_id"] is None
    shards = sharding.shard(awkward).collect()
    assert {r["size"] for r in shards if r["doc_id"] in (0, 1)} == {1}
    assert {r["text_crc32"] for r in shards if r["doc_id"] == 3} == {zlib.crc32(b"one")}


@pytest.mark.parametrize("number", range(4))
def test_stages(spark, awkward, empty, number):
    name, stage = corpus_pipeline.STAGES[number]
    got, nothing = stage(spark, awkward, ""), stage(spark, empty, "")
    assert nothing.count() == 0
    if number < 3:
        assert got.columns == nothing.columns == awkward.columns and got.dtypes == awkward.dtypes
        assert 0 < got.count() <= len(rows())
    else:
        assert got.agg(F.sum("length")).first()[0] > 0


def test_stage_decisions(spark, awkward):
    stages = dict(corpus_pipeline.STAGES)
    told = {r["doc_id"] for r in stages["language_id"](spark, awkward, "").collect()}
    assert not told & {0, 1, 2, 8} and {3, 4, 5} <= told
    once = sorted((r["doc_id"] for r in stages["jaccard_join"](spark, awkward, "").collect()), key=str)
    assert once == sorted([0, 1, 2, 3, 4, 5, 7, 8, None], key=str)


def test_threads_of_awkward_messages(spark):
    columns = "conv_id long, turn int, role string, text string, level string, thread string, position string, key string"
    data = [(1, 0, "u", "hello there", *"abcd"), (1, 1, "a", "> hello there\nyes", *"abcd"), (1, 1, "a", "> hello there\nyes", *"abcd")]
    data += [(None, 2, None, "> hello there", *"abcd"), (1, None, "u", None, *"abcd"), (2, 0, "u", "", *"abcd"), (1, 2, "u", "> > hello there\n> yes\nno", *"abcd")]
    got = quotation_threads.threads(spark.createDataFrame(data, columns)).collect()
    assert len(got) == len(data)
    by_turn = {(r["conv_id"], r["turn"]): r for r in got}
    assert by_turn[1, 1]["reply_to"] == 0 and by_turn[1, 1]["body"] == "yes"
    last = by_turn[1, 2]
    assert (last["reply_to"], last["thread"], last["quote_depth"], last["quoted_lines"], last["body"]) == (1, 0, 2, 2, "no")
    assert by_turn[None, 2]["reply_to"] is None
    assert quotation_threads.threads(spark.createDataFrame([], columns)).count() == 0


def test_neighbours_of_awkward_vectors(spark):
    nan = float("nan")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0])]
    data += [(7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 1.0]), (100, [float("inf"), 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = neighbours.nearest(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 2), (50, 2, 0), (50, 3, 1)]
    assert neighbours.nearest(df.limit(0), df).count() == 0
    assert neighbours.nearest(df, df.limit(0)).count() == 0


def test_one_id_with_two_texts(spark):
    """A clean text stays although a copy stands under the same id; links do not mix texts of one id."""
    a = " ".join(f"alpha{i}" for i in range(40))
    b = " ".join(f"beta{i}" for i in range(40))
    near_b = b + " more"
    rows = [(1, a), (2, a), (2, b), (3, near_b), (3, "quite another text of six words"), (3, near_b), (None, a)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, _gone string, first string")
    kept = sorted((tuple(r)[:2] for r in jaccard_join.one_per_group(df).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, "quite another text of six words"), (None, a)], key=str)
    groups = {(r["doc_id"], r["n_shingles"]): r for r in jaccard_join.link_groups(df).collect()}
    assert groups[2, 36]["component_id"] in (1, 2) and groups[3, 37]["component_id"] == 2 and groups[3, 2]["component_id"] == 3
    members = {(r["doc_id"], r["group"]) for r in jaccard_join.link_groups(df).filter("doc_id IS NOT NULL").collect()}
    assert len({g for _, g in members}) == 3


def test_counters_add_up_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ADD_AT_ONCE", 2)
    df = spark.createDataFrame([(i, f"common words in all of the texts and {i}") for i in range(40)], "doc_id long, text string").repartition(9)
    counts = jaccard_join.rough_counts(jaccard_join.survey(df).cache())
    assert counts.sum() == sum(len(jaccard_join.shingle_set(f"common words in all of the texts and {i}")) for i in range(40))
