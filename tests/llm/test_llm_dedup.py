"""Exact, line, suffix-array and SimHash deduplication against plain versions."""

import sys

import awkward
import brute
import duckdb
import numpy as np
import oracle
import pytest
from awkward import outer
from pyspark.sql import functions as F

from sparkrank.llm import line_dedup, simhash, suffix_array, suffix_dedup
from sparkrank.llm.exact_dedup import exact_dedup
from sparkrank.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def plain(small):
    return duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()


def same(df, expected, key="doc_id"):
    found = [tuple(r) for r in df.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, small, name):
    found = sorted(tuple(r) for r in QUERIES[name](spark, small).select(*sorted(QUERIES[name](spark, small).columns)).collect())
    relation = oracle.connect(small).sql(SQL[name])
    assert sorted(relation.columns) == sorted(QUERIES[name](spark, small).columns)
    columns = ", ".join(sorted(relation.columns))
    assert found == sorted(oracle.connect(small).sql(f"SELECT {columns} FROM ({SQL[name]})").fetchall())


def exact_expected(rows):
    import re

    groups = {}
    normal = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    for i, t in normal:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in normal:
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(groups[t]), i is not None and i == keep, brute.sha(t)))
    return out


# The last two digests collide for most or all texts, so contents decide.
@pytest.mark.parametrize("digest", [lambda c: F.sha2(c, 256), lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(3)), lambda c: F.lit(1)])
def test_exact_dedup(spark, digest):
    found = exact_dedup(awkward.docs(spark), salts=3, digest=digest)
    same(found, exact_expected(awkward.texts()))


def test_exact_dedup_of_null_ids(spark):
    rows = [(None, None), (None, ""), (None, "a  b"), (3, "a b")]
    same(exact_dedup(awkward.docs(spark, rows)), exact_expected(rows))


def test_line_dedup(spark):
    rows = awkward.texts()
    want = brute.line_dedup(rows)
    found = line_dedup.line_dedup(awkward.docs(spark)).select("doc_id", "n_lines", "n_dropped", "text")
    same(found, [(i, *want[awkward.brute_id(i)]) for i, _ in rows])


@pytest.mark.parametrize("long", [False, True])
def test_line_dedup_of_a_line_in_most_documents(spark, monkeypatch, long):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 2)
    hot = "The line that nearly every document holds." * (40 if long else 1)
    rows = [(n, "\n".join([f"own line of number {n}", hot.upper() if n % 2 else hot, f"shared by a few {n % 90}"])) for n in range(300)]
    rows += [(None, hot), (5, hot), (400, None)]
    docs = spark.createDataFrame(rows[::-1], "doc_id bigint, text string").repartition(7)
    found = line_dedup.line_dedup(docs.filter("doc_id is null or doc_id <> 5")).collect()
    plain = brute.line_dedup([r for r in rows if r[0] != 5])
    assert len(found) == 301
    for r in found:
        assert (r["n_lines"], r["n_dropped"], r["text"]) == plain[brute.LAST if r["doc_id"] is None else r["doc_id"]]


def test_line_dedup_keeps_other_columns_and_ignores_filter_size(spark):
    docs = awkward.docs(spark)
    full = line_dedup.line_dedup(docs, report=None)
    assert full.columns == docs.columns and full.count() == docs.count()
    assert {r["bucket"] for r in full.collect()} == {"clash bucket"}
    tight = line_dedup.line_dedup(docs, report=None, filter_bytes=1)
    same(tight.select("doc_id", "text"), [tuple(r) for r in full.select("doc_id", "text").collect()])


def test_bloom_has_no_false_negative():
    hashes = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    bloom = line_dedup.Bloom(10 * len(hashes))
    bloom.add(hashes[:2500])
    assert bloom.has(hashes[:2500]).all()
    assert bloom.has(hashes[2500:]).mean() < 0.05


@pytest.mark.parametrize("few", [1024, 0])
def test_suffix_array(monkeypatch, few):
    monkeypatch.setattr(suffix_array, "FEW_SYMBOLS", few)
    r = np.random.default_rng(few + 1)
    for _ in range(300):
        text = r.integers(0, r.integers(1, 5), r.integers(0, 40))
        if r.random() < 0.4:
            text = np.tile(text[: r.integers(0, 6)], 6)
        plain = text.tolist()
        order = sorted(range(len(plain)), key=lambda i: plain[i:])
        assert suffix_array.suffix_array(text).tolist() == order
        shared = suffix_array.common_prefixes(text, np.array(order, np.int64), 4)
        for a, b in zip(order, order[1:]):
            n = 0
            while n < 4 and max(a, b) + n < len(plain) and plain[a + n] == plain[b + n]:
                n += 1
            assert shared[b] == n


# All anchors common, so that strings travel one by one; and filters too small to tell anything.
@pytest.mark.parametrize("options", [{}, {"common": 2}, {"filter_bytes": 1}])
def test_suffix_dedup(spark, options):
    rows = awkward.texts()
    want = brute.suffix_dedup(rows)
    found = suffix_dedup.suffix_dedup(awkward.docs(spark), **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(i, *want[awkward.brute_id(i)]) for i, _ in rows], key=repr)


def test_suffix_dedup_on_documents(spark, small, plain):
    want = brute.suffix_dedup(plain)
    same(QUERIES["op5_suffix_dedup"](spark, small), [(i, n, r, k, brute.sha(t)) for i, (n, r, k, t) in want.items()])


def test_repeated_strings_go_from_texts(spark):
    docs = awkward.docs(spark)
    found = suffix_dedup.drop_repeated_strings(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    want = brute.suffix_dedup(awkward.texts())
    for r in found.collect():
        assert r["text"] == want[awkward.brute_id(r["doc_id"])][3].decode("utf-8", "ignore")


def test_filter_of_shared_anchors_has_its_bytes(spark):
    """Very common anchors are few, and leave nearly all of the filters' bytes to the shared ones."""
    r = np.random.default_rng(8)
    text = lambda n: bytes(r.integers(32, 127, n).astype(np.uint8))
    both = text(40_000)
    rows = [(1, both + text(100)), (2, text(100) + both)]
    docs = spark.createDataFrame([(i, bytearray(t)) for i, t in rows], "id long, text binary")
    known = suffix_dedup.Anchors(*suffix_dedup._shared_anchors(docs, 50, 1, 6000, 16384).value[:2])
    hashes = lambda t: suffix_dedup.stretches(np.frombuffer(t, np.uint8), np.array([len(t)]))[3]
    assert known(hashes(both)).all()
    assert known(hashes(text(200_000))).mean() < 0.02


def test_names_of_a_recursion_are_sorted_in_whole_arrays():
    """Many different names: no step of Python for each of them."""
    text, steps = np.random.default_rng(9).integers(0, 5000, 20_000), []

    def step(frame, event, arg):
        steps.append(event)
        return step

    before = sys.gettrace()
    sys.settrace(step)
    try:
        order = suffix_array.suffix_array(text)
    finally:
        sys.settrace(before)
    plain = text.tolist()
    assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i : i + 50])
    assert len(steps) < 2000


def test_stretches_hold_each_string_once():
    r = np.random.default_rng(3)
    texts = [bytes(r.choice(list(b"ab "), r.integers(0, 150)).astype(np.uint8)) for _ in range(20)]
    joined, lengths = suffix_dedup._joined(texts)
    starts = np.cumsum(lengths) - lengths
    _, first, last, hashes = suffix_dedup.stretches(np.frombuffer(joined, np.uint8), lengths)
    held = [x for a, b in zip(first, last) for x in range(a, b + 1)]
    assert sorted(held) == [s + p for s, t in zip(starts, texts) for p in range(len(t) - 49)]
    anchors = {}
    for a, b, h in zip(first, last, hashes):
        for x in range(a, b + 1):
            anchors.setdefault(joined[x : x + 50], set()).add(int(h))
    assert all(len(h) == 1 for h in anchors.values())


def test_simhash(spark):
    rows = awkward.texts()
    want = brute.components(rows)
    found = simhash.near_duplicates(awkward.docs(spark), tile=4)
    same(found, [(i, f"{want[awkward.brute_id(i)][0]:016x}", outer(want[awkward.brute_id(i)][1])) for i, _ in rows])


def test_simhash_on_documents(spark, small, plain):
    want = brute.components(plain)
    same(QUERIES["op8_simhash"](spark, small), [(i, f"{p:016x}", c) for i, (p, c) in want.items()])


def test_near_cells_lose_no_pair():
    r = np.random.default_rng(5)
    steps = {tuple(s) for s in simhash.near_cells(2)}
    for _ in range(500):
        a = int(r.integers(0, 2**63))
        b = a
        for bit in r.integers(0, 64, 2):
            b ^= 1 << int(bit)
        cells = [[(x >> 16 * k & 0xFFFF).bit_count() for k in range(4)] for x in (a, b)]
        step = tuple(y - x for x, y in zip(*cells))
        assert step in steps or tuple(-x for x in step) in steps


def test_spanning_links_connect():
    r = np.random.default_rng(6)
    a = (r.integers(0, 8, 60)).astype(np.uint64)
    links = simhash.spanning_links(a, a, 1, True)
    assert len(links) < len(a)
    root = list(range(60))
    for i, j in links:
        root = [root[i] if x == root[j] else x for x in root]
        assert int(a[i] ^ a[j]).bit_count() <= 1
    assert len(set(root)) == 1


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7)]
    found = simhash.components(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(1, 61)} | {(101, 100), (102, 100)}


def test_first_of_near_duplicates_stays(spark):
    docs = awkward.docs(spark)
    want = brute.components(awkward.texts())
    found = simhash.drop_near_duplicates(docs)
    assert found.columns == docs.columns
    kept = [i for i, _ in awkward.texts() if want[awkward.brute_id(i)][1] == awkward.brute_id(i)]
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(kept)


@pytest.mark.parametrize("operator", [exact_dedup, line_dedup.line_dedup, suffix_dedup.suffix_dedup, simhash.near_duplicates, simhash.drop_near_duplicates])
def test_empty_tables(spark, operator):
    assert operator(awkward.docs(spark, [])).count() == 0


def test_portions_keep_anchors_whole(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORTED", 100)
    r = np.random.default_rng(9)
    anchor = r.integers(0, 12, 80)
    contents = [b"x" * int(n) for n in r.integers(50, 70, 80)]
    several = np.argsort(anchor, kind="stable")
    parts = list(suffix_dedup._portions(several, anchor, contents))
    assert np.concatenate(parts).tolist() == several.tolist() and len(parts) > 5
    homes = [set(anchor[p].tolist()) for p in parts]
    assert sum(map(len, homes)) == len(set(anchor.tolist()))
    assert list(suffix_dedup._portions(several[:0], anchor, contents)) == []


def test_spans_that_touch_are_merged():
    r = np.random.default_rng(10)
    ids, starts, sizes = r.integers(0, 6, 200), r.integers(0, 900, 200), r.integers(1, 30, 200)
    covered = {(i, x) for i, a, n in zip(ids, starts, sizes) for x in range(a, a + n)}
    out = list(zip(*suffix_dedup.merged(ids, starts, sizes)))
    assert sorted(out) == out and len(out) < 200
    assert {(i, x) for i, a, n in out for x in range(a, a + n)} == covered
    assert all(i != j or a + n < b for (i, a, n), (j, b, _) in zip(out, out[1:]))
    assert [len(x) for x in suffix_dedup.merged(ids[:0], starts[:0], sizes[:0])] == [0, 0, 0]
