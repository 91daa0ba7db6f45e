"""SimHash trees, prefix tries and spelling variants against brute force and on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.llm import base, prefix_trie, simhash_trees, spelling_variants

SF = "/root/testdata/sf0.01"


def bits_of(text: str | None) -> int:
    """The contract's fingerprint, shingle by shingle."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(points: list[int]) -> dict[int, int]:
    """Point to the smallest point reachable, all pairs compared."""
    arr = np.array(points, "u8")
    root = list(range(len(arr)))

    def up(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i] ^ arr[i + 1 :]) <= simhash_trees.MOST_BITS) + i + 1:
            a, b = up(i), up(int(j))
            root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(arr)):
        groups[up(i)].append(points[i])
    return {p: min(g) for g in groups.values() for p in g}


def test_fingerprint_of_texts():
    texts = ["", " \t\n", "One", "one Two", "a b c", "a b c d", "É À x y z", "w " * 70_000 + "end", "a\x1fb\x85c d\x0be f"]
    for text in texts:
        assert simhash_trees.fingerprint(text) == bits_of(text)


def near_points(number: int, seed: int) -> np.ndarray:
    """Random points, many of them within a few bits of others, and one dense ball."""
    rng = np.random.default_rng(seed)
    points = rng.integers(0, 1 << 63, number, "u8")
    flips = np.uint64(1) << rng.integers(0, 64, (number, 3)).astype("u8")
    near = points ^ flips[:, 0] ^ np.where(rng.random(number) < 0.5, flips[:, 1], 0).astype("u8")
    ball = points[:1] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]
    return np.unique(np.concatenate([points, near[: number // 2], ball[: number // 3]]))


@pytest.mark.parametrize("number,seed", [(40, 1), (900, 2), (3000, 3)])
def test_linked_pairs_are_all_pairs(number, seed):
    points = near_points(number, seed)
    homes, visitors = points[::2], points[1::2]
    close = lambda a, b: {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    want = set()
    for i, p in enumerate(homes):
        own = homes[i + 1 :][np.bitwise_count(homes[i + 1 :] ^ p) <= 2]
        guests = visitors[np.bitwise_count(visitors ^ p) <= 2]
        want |= close(np.full(len(own), p), own) | close(np.full(len(guests), p), guests)
    got = set().union(*(close(a, b) for a, b in simhash_trees.linked_pairs(homes, visitors)), set())
    assert got == want and len(want) > 5
    between = set().union(*(close(a, b) for a, b in simhash_trees.linked_pairs(homes, visitors, False)), set())
    assert between == {p for p in want if (p[0] in set(homes.tolist())) != (p[1] in set(homes.tolist()))}


@given(st.lists(st.integers(0, 255), min_size=1, max_size=60), st.integers(2, 6))
@settings(max_examples=60, deadline=None)
def test_deal_meets_every_pair(small, shards):
    points = np.unique(np.array(small, "u8"))
    tree = simhash_trees.fit_tree(points, shards)
    shard, at, visits = simhash_trees.deal(tree, points)
    assert sorted(at[~visits]) == list(range(len(points)))
    homes, everyone = defaultdict(set), defaultdict(set)
    for s, k, v in zip(shard, at, visits):
        everyone[s].add(k)
        if not v:
            homes[s].add(k)
    for i, j in itertools.combinations(range(len(points)), 2):
        if (points[i] ^ points[j]).bit_count() <= 2:
            assert any({i, j} <= everyone[s] and {i, j} & homes[s] for s in homes)


@pytest.mark.parametrize("homes_,guests", [(64, 128), (1 << 16, 1 << 18)])
def test_groups_of_points(spark, monkeypatch, homes_, guests):
    points = near_points(1500, 5)
    df = base.stage_table(spark.createDataFrame([(int(p),) for p in points.view("i8")], "point long"), "test-points")
    dealt = base.stage_table(simhash_trees.shards(df, 300), "test-shards")
    assert dealt.select("shard").distinct().count() > 2
    links = simhash_trees.group_links(simhash_trees.in_groups(dealt, homes_, guests)).collect()
    forest = simhash_trees.Forest(points)
    for r in links:
        a, b = np.uint64(r["a"] % 2**64), np.uint64(r["b"] % 2**64)
        assert np.bitwise_count(a ^ b) <= 2
        forest.add(np.array([a]), np.array([b]))
    want = components_of(points.tolist())
    got = forest._roots(np.arange(len(points)))
    assert [want[p] for p in forest.points.tolist()] == forest.points[got].tolist()


def test_simhash_query_against_brute_force(spark):
    rows = base.read(spark, SF, "documents").select("doc_id", "text").collect()
    point = {r["doc_id"]: bits_of(r["text"]) for r in rows}
    groups = components_of(sorted(set(point.values())))
    least = {}
    for doc, p in point.items():
        least[groups[p]] = min(doc, least.get(groups[p], doc))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_trees.query(spark, SF).collect()}
    assert got == {doc: (f"{p:016x}", least[groups[p]]) for doc, p in point.items()}
    assert len({c for _, c in got.values()}) < len(got)


CLASHES = ["point", "lead", "docs", "component", "word", "key", "n", "shard", "place", "part", "d", "ka"]


def awkward(spark, rows, columns):
    more = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *CLASHES) for r in rows], f"{columns}, {more}").repartition(3)


def test_simhash_of_awkward_rows(spark):
    rows = [(5, None), (6, ""), (7, "one two three four"), (7, "other words of this text"), (8, "One TWO three four")]
    rows += [(9, "other words of this text"), (9, "other words of this text"), (None, "one two three four")]
    got = sorted((tuple(r) for r in simhash_trees.near_groups(awkward(spark, rows, "doc_id int, text string")).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(5, 5), (6, 5), (7, 7), (7, 7), (8, 7), (9, 7), (9, 7), (None, None)], key=str)
    assert simhash_trees.near_groups(awkward(spark, rows, "doc_id int, text string").limit(0)).count() == 0


def trie_of(paths: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    """Nodes by definition: every prefix of every path with its members."""
    members = defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
    out = set()
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = sum(not any(len(o) == len(m) + 1 and o[: len(m)] == m for o in below) for m in below)
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(convs), len(node), parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_rows():
    """Shared beginnings, equal conversations, a prefix of others, and one of 60 turns."""
    rows = []
    for conv in range(40):
        shared = [("u", f"same {i}") for i in range(12)] if conv % 3 == 0 else [("u", f"start {conv % 4}")]
        own = [("a", f"own {conv if conv % 5 else 0} {i}") for i in range(conv % 4)]
        rows += [(conv, t, *x) for t, x in enumerate(shared + own)]
    rows += [(50, t, "u", f"same {t}") for t in range(60)]
    return rows


@pytest.mark.parametrize("container,block", [(1, 4), (7, 1 << 14), (40, 16), (8192, 1 << 14)])
def test_trie_for_every_size_of_container(spark, monkeypatch, container, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(prefix_trie, "FIRST_LEVELS", 2)
    rows = conversation_rows()
    paths = defaultdict(list)
    for conv, _, role, text in sorted(rows):
        paths[conv].append((role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    got = prefix_trie.trie(*prefix_trie.sequences(df), container_turns=container).select(*TRIE).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == trie_of(paths)


def test_rebuilt_trie_of_awkward_rows(spark):
    rows = [(100, 1, "u", "b"), (100, None, None, None), (100, 2, "a", "c"), (101, 0, "u", "x"), (101, 0, "u", "x"), (101, 0, "a", "z")]
    rows += [(150, 5, "u", "only"), (205, 0, "u", "no family head"), (None, 0, "u", "lost"), (207, 0, "u", "no family head"), (100, 2, "a", "")]
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    paths = {c: own.get(c - c % 100, [])[: heads[c]] + own[c][heads[c] :] for c in own}
    df = awkward(spark, rows, "conv_id int, turn int, role string, text string")
    assert {tuple(r) for r in prefix_trie.trie(*prefix_trie.rebuilt(df)).select(*TRIE).collect()} == trie_of(paths)
    assert prefix_trie.trie(*prefix_trie.rebuilt(df.limit(0))).count() == 0


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("list_pairs", [0, 3, 1024])
def test_near_pairs_are_all_pairs(spark, list_pairs):
    rng = np.random.default_rng(4)
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 11))) for _ in range(250)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa"}
    df = spark.createDataFrame([(w, 5 + len(w)) for w in sorted(words)], "word string, n long")
    got = [tuple(sorted((r["word"], r["near"]))) for r in spelling_variants.near_pairs(df, list_pairs).collect()]
    want = [p for p in itertools.combinations(sorted(words), 2) if one_edit(*p)]
    assert sorted(got) == want and len(want) > 40


def test_runs_lose_code_points_as_stated():
    texts = {i: " ".join(f"Wörd{chr(97 + j % 26)}{chr(97 + i % 26)}xyz{'q' * (j % 3)}" for j in range(200)) for i in range(40)}
    changed = 0
    for doc, text in texts.items():
        want: Counter = Counter()
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
                changed += 1
            want[run] += 1
        assert spelling_variants.runs_of(doc, text) == {w: n for w, n in want.items() if n}
    assert changed > 10


def test_variants_of_awkward_rows(spark):
    text = "forest " * 200 + "forrest " * 40 + "forresst " * 7 + "Forest\tÉCOLES écoles " * 5
    rows = [(11, text), (11, text), (2, None), (3, ""), (None, "forest"), (4, "x" * 300_000)]
    df = awkward(spark, rows, "doc_id int, text string")
    got = {r["word"]: tuple(r)[1:] for r in spelling_variants.variant_groups(df).collect()}
    assert got["forrest"][:2] == ("forest", "forest") and got["forresst"][:2] == ("forrest", "forest")
    assert got["forest"][0] is None and got["forest"][1] == "forest" and got["forest"][3] == 1
    assert got["écoles"] == (None, "écoles", 10, 1, None) and got["Écoles"][3] == 1
    assert spelling_variants.variant_groups(df.limit(0)).count() == 0
