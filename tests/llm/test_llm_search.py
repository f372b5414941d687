"""Top-k search, ranked lexical search and tokenizer alignment against brute force."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute_llm as brute
from oracle_check import compare, duck
from replenix.llm import align, nra, queries, ranked
from test_llm_queries import EDGE, ITEMS, _docs, _rows, edge  # noqa: F401  (a fixture)

SF = "/root/testdata/sf0.001"


# --- 11: search without random access ---------------------------------------------------

def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, key string, rank int")


def _found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def _f32(rows):
    return [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_topk_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [(i, (rng.normal(size=8) * [9, 1, 1, 1, 1, 1, 1, .01]).tolist()) for i in range(300)]
    rows += [(i, rows[i % 3][1]) for i in range(300, 340)]      # many equal vectors
    found = nra.top_k(_vectors(spark, [(*r, "k", 1) for r in rows]), "vec_id % 20 = 0", nra.Search(block=block, batch=5))
    assert _found(found) == sorted(brute.top_k(_f32(rows), lambda i: i % 20 == 0))


def test_topk_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (0, [1.0, -1.0]), (50, [0.5, 0.5]), (50, None), (None, [1.0, 1.0]), (1, [nan, 1.0]), (2, [inf, 0.0]),
            (3, [None, 1.0]), (100, []), (4, []), (150, [1.0, 2.0, 3.0]), (5, [0.0, 0.0]), (6, [-0.001, 0.001]), (200, [0.0, -0.0]),
            (250, [3e38, 3e38, 1.0]), (7, [-3e38, 1.0, 1.0]), (300, [1e10, 1e10, 0.0])]
    found = nra.top_k(_vectors(spark, [(*r, None, None) for r in rows]), "vec_id % 50 = 0")
    assert _found(found) == sorted(brute.top_k(_f32(rows), lambda i: i % 50 == 0))
    assert _found(nra.top_k(_vectors(spark, []), "vec_id % 50 = 0")) == []


def test_lists_stop_early():
    """A query whose best rows lead all lists reads few of the rest, and the bounds drop nothing."""
    rng = np.random.default_rng(0)
    values = np.floor(rng.normal(size=(2000, 6)) * 40)
    values[:8] += 900
    lists = nra.Lists(values, np.arange(2000), np.arange(2000))
    queries_ = np.concatenate([np.abs(values[8:20]), values[20:40]])
    found = lists.top(queries_, np.arange(8, 40), np.full(32, -np.inf), nra.Search())
    for q, key, (rows, scores) in zip(queries_, range(8, 40), found):
        want = sorted((-int(s), i) for i, s in enumerate(values @ q) if i != key)[:5]
        assert [(-int(s), int(i)) for i, s in zip(rows, scores)] == want
    stops = dict(lists._read(queries_.astype("f8"), np.arange(8, 40), np.full(32, -np.inf), nra.Search(), np.dtype("f8")))
    assert all(len(rows) < 2000 for rows in stops.values())


# --- 12: shared sums ----------------------------------------------------------------------

@settings(max_examples=80, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 12), st.integers(1, 3), min_size=1, max_size=8), min_size=1, max_size=12), st.integers(2, 9))
def test_shared_sums(items, mined):
    graph = ranked.shared_sums([Counter(i) for i in items], mined)
    values = np.arange(1, 14)[:, None] ** 3 * [1, 7]
    table = np.zeros((graph.rows, 2), dtype=np.int64)
    table[: len(graph.leaves)] = values[graph.leaves] * graph.times[:, None]
    assert graph.sums(table).tolist() == [[int(sum(values[t, d] * n for t, n in i.items())) for d in (0, 1)] for i in items]


def test_sums_are_made_once():
    base = Counter(range(40))
    graph = ranked.shared_sums([base + Counter([100 + k]) for k in range(50)], 32)
    plain = 50 * 40
    made = sum(len(one) for _, one, _ in graph.levels) + len(graph.children) - 50
    assert made < plain / 10


def _ranked_rows(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_ranked_edge_cases(spark, block_bytes):
    docs = [(d, t) for d, t, *_ in EDGE] + [(None, EDGE[6][3] + "p2 p3"), (30, EDGE[6][3]), (31, "É\x00é\x7fP2_p2 P2-p2")]
    items = [*ITEMS, (9, "The committee, the THE letter é"), (None, "one two one"), (9, "nowhere1 nowhere2")]
    docs_df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, score long, item_id string")
    items_df = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    found = ranked.ranked(docs_df, items_df, ranked.Ranking(block_bytes=block_bytes, cells=50))
    assert _ranked_rows(found) == Counter(brute.ranked(docs, items))


@pytest.mark.parametrize("docs,items", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, None), (2, "...")], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_ranked_without_terms(spark, docs, items):
    found = ranked.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found.count() == 0


@pytest.mark.parametrize("key", ["op11_topk_search", "op12_ranked_search"])
def test_queries_match_sql(spark, key):
    r = compare(spark, key, SF, duck(SF))
    assert r["status"] == "ok", r


# --- 13: alignment --------------------------------------------------------------------------

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATHS = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")]
ODD = st.lists(st.one_of(st.sampled_from([chr(i) for i in range(33)] + list("abé日😀▁  \x85\xa0.,'") + [" "] * 12
                                        + ["the ", " ing", "<|endoftext|>", "<s>", "<0x41>", "'s "])), max_size=30).map("".join)


@pytest.fixture(scope="module")
def tokenizers():
    return align.Tokenizers(*PATHS)


@settings(max_examples=80, deadline=None)
@given(texts=st.lists(ODD, min_size=1, max_size=6), lanes=st.sampled_from([3, 1000]))
def test_lanes_equal_whole_texts(tokenizers, texts, lanes):
    aligner = align.Aligner(tokenizers, align.Alignment(lanes=lanes, longest=6))
    for _ in range(2):    # learnt, then remembered
        figures, strings, links, at = aligner.align(texts)
        for k, text in enumerate(texts):
            ids = tokenizers.ids(text) if text else None
            if ids is None:
                assert figures[k].tolist() == [0, 0, 0, 0] and strings[k] == ""
                continue
            a, b = (np.array(i) for i in ids)
            one = [np.array([0, len(a)]), np.array([0, len(b)])]
            la, lb, ca, cb = align.lockstep(np.cumsum(tokenizers.a_sizes[a]), one[0], np.cumsum(tokenizers.b_sizes[b]), one[1])
            assert figures[k].tolist() == [len(a), len(b), len(ca), len(la)]
            assert sorted(links[at[k]:at[k + 1]].tolist()) == sorted((a[la] * 32_000 + b[lb]).tolist())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.randoms()), min_size=1, max_size=8))
def test_lockstep(lanes):
    """Random cuts of lanes of random lengths; empty lanes between them."""
    sides = [([], [0]), ([], [0])]
    begin = 0
    for size, rng in lanes:
        for ends, first in sides:
            inner = [x for x in range(1, size) if rng.random() < 0.4]
            ends += [begin + x for x in [*inner, size]]
            first += [len(ends), len(ends)]
        begin += size
    (a, a_first), (b, b_first) = ((np.array(x), np.array(y)) for x, y in sides)
    la, lb, ca, cb = align.lockstep(a, a_first, b, b_first)
    owner = [np.searchsorted(x, np.arange(1, begin + 1)) for x in (a, b)]
    assert list(zip(la.tolist(), lb.tolist())) == sorted(set(zip(owner[0].tolist(), owner[1].tolist())))
    assert list(zip(ca.tolist(), cb.tolist())) == [(i, int(np.searchsorted(b, e))) for i, e in enumerate(a.tolist()) if e in set(b.tolist())]


def _digests(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


@pytest.mark.parametrize("bounds", [align.Alignment(), align.Alignment(lanes=50, held_pairs=40, looked_up=30, longest=5),
                                    align.Alignment(looked_up=0)])
def test_alignment_edge_cases(spark, bounds):
    rows = [(d, t) for d, t, *_ in EDGE if d != 13] + [(None, "the end"), (None, None), (40, " "), (41, "a  b\n\n c "), (42, "x\0y \0 z"),
                                                      (43, "the end"), (44, "<s> </s> <unk> <0x41>")]
    docs = spark.createDataFrame([(d, t, "p", 3) for d, t in rows], "doc_id long, text string, pairs string, key int").repartition(3)
    assert _digests(align.alignments(docs, *PATHS, bounds)) == Counter(brute.alignments(rows))


def test_alignment_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in _docs(SF)]
    assert _digests(queries.queries()["op13_tokenizer_alignment"](spark, SF)) == Counter(brute.alignments(docs))


def test_aligned_tokens(spark):
    rows = [(1, "Hello, wörld 日本"), (2, None), (3, "▁"), (4, "a b"), (None, "tokenizers")]
    found = align.aligned(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).collect()
    digests = {r[0]: r for r in brute.alignments(rows)}
    for r in found:
        _, n_a, n_b, n_groups, n_links, *_ = digests[r.doc_id]
        assert (len(r.a_ids), len(r.b_ids), len(r.cuts), len(r.links)) == (n_a, n_b, n_groups, n_links)
        if n_groups:
            assert tuple(r.cuts[-1]) == (n_a, n_b)
