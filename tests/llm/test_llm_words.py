"""Fingerprints, ranked search and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import awkward
import numpy as np
import pytest
from awkward import brute_id, outer
from pyspark.sql import functions as F

from sparkrank.llm import fingerprints, ranked, spelling
from sparkrank.llm.fingerprints import Fingerprint, PrefixHashes, common_extension, likeness
from sparkrank.llm.queries import QUERIES


@pytest.fixture
def short_blocks(monkeypatch):
    """Blocks of 64 code points, so that small texts have several."""
    monkeypatch.setattr(fingerprints, "BLOCK", 64)
    monkeypatch.setattr(fingerprints, "_TABLES", [])


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abé日") for _ in range(r.randrange(0, 400))) for _ in range(n)]


def test_spans_hash_alike_wherever_they_stand(short_blocks):
    for text in random_texts(60):
        hashes = PrefixHashes(text)
        for width in (3, 16):
            found = np.concatenate([*hashes.spans(width), np.empty(0, np.uint64)])
            assert len(found) == (max(1, len(text) - width + 1) if text else 0)
            for i in range(0, len(found), 7):
                end = min(len(text), i + width)
                assert int(found[i]) == hashes.span(i, end) == PrefixHashes(text[i:end]).whole()


def test_common_extension(short_blocks):
    r = random.Random(2)
    for text in random_texts(60, 3):
        other = text[r.randrange(0, len(text) + 1) :] + "x" + text
        i, j = r.randrange(0, len(text) + 1), r.randrange(0, len(other) + 1)
        n = 0
        while i + n < len(text) and j + n < len(other) and text[i + n] == other[j + n]:
            n += 1
        assert common_extension(PrefixHashes(text), i, PrefixHashes(other), j) == n


def exact_likeness(a, b, width):
    spans = [Counter(t[i : i + width] for i in range(max(1, len(t) - width + 1))) for t in (a, b)]
    return sum((spans[0] & spans[1]).values()) / sum((spans[0] | spans[1]).values())


def test_likeness_is_the_share_of_common_spans():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(300)]
    off = []
    for n in (8, 20, 300, 3000):
        for _ in range(20):
            text = " ".join(r.choice(words) for _ in range(n))
            other = text[: len(text) * r.randrange(1, 10) // 10] + " ".join(r.choice(words) for _ in range(n // 3))
            a, b = (Fingerprint.of(PrefixHashes(t)) for t in (text, other))
            if a.long is not None and b.long is not None:
                off.append(a.likeness(b) - exact_likeness(text, other, fingerprints.LONG))
            elif a.short is not None and b.short is not None:
                off.append(a.likeness(b) - exact_likeness(text, other, fingerprints.SHORT))
                assert len(a.short) == fingerprints.KEPT or abs(off[-1]) < 1e-9
            else:
                assert a.likeness(b) == 0
            assert likeness(str(a), str(b)) == a.likeness(b) == b.likeness(a)
    assert abs(np.mean(off)) < 0.02 and np.max(np.abs(off)) < 0.2


def test_repeats_count_and_portions_change_nothing(monkeypatch):
    once, many = "abcdefgh " * 20, "abcdefgh " * 400
    marks = [Fingerprint.of(PrefixHashes(t)) for t in (once, many)]
    assert marks[0].likeness(marks[1]) < 0.2
    monkeypatch.setattr(fingerprints, "PORTION", 100)
    assert [str(Fingerprint.of(PrefixHashes(t))) for t in (once, many)] == list(map(str, marks))


def edited_expected(rows):
    """Of each row (id, text), in order, what the operator gives."""
    rows = sorted(((brute_id(i), t or "") for i, t in rows), key=lambda r: r[0])
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        shared = 0
        while shared < min(len(text), len(edited)) and text[shared] == edited[shared]:
            shared += 1
        marks = [str(Fingerprint.of(PrefixHashes(t))) for t in (text, edited, following)]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = [likeness(marks[0], marks[1]), likeness(marks[0], marks[2])]
        out.append((outer(i), len(text), digest, marks[0], marks[1], *near, shared))
    return out


def same(df, expected):
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(expected, key=repr)


def test_edited_fingerprints(spark):
    same(fingerprints.edited_fingerprints(awkward.docs(spark)), edited_expected(awkward.texts()))
    assert fingerprints.edited_fingerprints(awkward.docs(spark, [])).count() == 0
    same(fingerprints.edited_fingerprints(awkward.docs(spark, [(5, "abc def")])), edited_expected([(5, "abc def")]))


def test_edited_fingerprints_where_one_id_has_most_rows(spark):
    rows = [(None, f"text {n % 7}") for n in range(300)] + [(n, f"own {n}") for n in range(40)]
    found = fingerprints.edited_fingerprints(awkward.docs(spark, rows)).collect()
    assert len(found) == len(rows)
    assert sorted(r["fingerprint"] for r in found) == sorted(str(Fingerprint.of(PrefixHashes(t))) for _, t in rows)
    # Within one id equal texts stand together, so at most one of each has another next.
    assert sum(r["near_next"] < 1 for r in found if r["doc_id"] is None) == 7


def test_edited_fingerprints_of_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_fingerprints"](spark, small)
    same(found, edited_expected(rows))
    judged = found.agg(F.avg("near_edited"), F.min("near_edited"), F.avg("near_next")).first()
    assert 0.55 < judged[0] < 0.66 and judged[1] > 0.3 and judged[2] < 0.05


def test_fingerprints(spark):
    want = [(i, len(t or ""), str(Fingerprint.of(PrefixHashes(t or "")))) for i, t in awkward.texts()]
    same(fingerprints.fingerprints(awkward.docs(spark)), want)


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking_expected(rows, queries, k=10):
    counts = [(brute_id(i), Counter(terms(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for q, text in queries:
        asked.setdefault(q, set()).update(terms(text))
    out = []
    for q, own in asked.items():
        scored = []
        for i, c in counts:
            n = sum(c.values())
            score = 0
            for t in own & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, i))
        out += [(q, rank, outer(i), -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return out


ASKED = [
    (1, "same text here"), (1, "Über maison"), (2, None), (3, ""), (4, "zzz unknown"), (None, "stone river the of and"),
    (6, "x1 X1 日本語のテキスト 12345"), (7, "This very line stands in many documents, as lines do."), (8, "é ab word"),
]


def asked_rows(spark, rows=ASKED):
    df = spark.createDataFrame(rows, "item_id bigint, text string")
    return df.withColumns({c: F.lit(c) for c in ("term", "query", "df", "shard", "score", "rank", "doc_id", "number")})


# One shard a task, several, and one for each document.
@pytest.mark.parametrize("shard_terms", [4_000_000, 3000, 1])
def test_ranked_search(spark, shard_terms):
    index = ranked.RankedIndex.build(awkward.docs(spark), shard_terms=shard_terms)
    for k in (1, 3, 10):
        same(index.search(asked_rows(spark), k), ranking_expected(awkward.texts(), ASKED, k))


def test_ranked_search_of_nothing(spark, tmp_path):
    empty = ranked.RankedIndex.build(awkward.docs(spark, []))
    assert empty.search(asked_rows(spark)).count() == 0
    blank = ranked.RankedIndex.build(awkward.docs(spark, [(1, None), (2, ""), (3, "?!")]))
    assert (blank.n_docs, blank.n_terms) == (0, 0) and blank.search(asked_rows(spark)).count() == 0
    index = ranked.RankedIndex.build(awkward.docs(spark))
    assert index.search(asked_rows(spark, [])).count() == 0
    same(index.save(str(tmp_path / "index")).search(asked_rows(spark), 5), ranking_expected(awkward.texts(), ASKED, 5))


def test_ranked_search_sends_queries_in_portions(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BROADCAST_BYTES", 500)
    index = ranked.RankedIndex.build(awkward.docs(spark))
    same(index.search(asked_rows(spark), 4), ranking_expected(awkward.texts(), ASKED, 4))


def shards_of(rows, per_shard):
    """Shards as a task sees them, without Spark."""
    counts = [(i, terms(t)) for i, t in rows]
    stats = sum(bool(c) for _, c in counts), sum(len(c) for _, c in counts)
    for at in range(0, len(rows), per_shard):
        some = [(i, [t.encode() for t in c]) for i, c in counts[at : at + per_shard] if c]
        vocabulary = ranked._Vocabulary()
        found = [np.array([vocabulary[t] for t in c], np.int32) for _, c in some]
        yield from ranked._shard_rows(at, [i for i, _ in some], [len(c) for _, c in some], found, vocabulary, stats)


@pytest.mark.parametrize("postings, window", [(128, 4096), (4, 16), (2, 3)])
def test_blocks_are_passed_over_and_nothing_is_lost(monkeypatch, postings, window):
    monkeypatch.setattr(ranked, "POSTINGS", postings)
    monkeypatch.setattr(ranked, "WINDOW", window)
    r = random.Random(5)
    words = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join(r.choices(words, [1 / (x + 1) for x in range(60)], k=r.randrange(1, 60)))) for n in range(600)]
    queries = [(q, " ".join(r.sample(words, r.randrange(1, 12)))) for q in range(30)]
    want = {q: [] for q, _ in queries}
    for q, rank, i, score in ranking_expected(rows, queries, 5):
        want[q].append((i, score))
    df = Counter(t for _, text in rows for t in set(terms(text)))
    read = total = 0
    for q, text in queries:
        weights = {t.encode(): ranked.weight(600, df[t]) for t in set(terms(text)) if df[t]}
        best = ranked.Best(5)
        for shard in ranked._shards(shards_of(rows, 100)):
            ranked.search_shard(shard, weights, best)
            read += shard.decompressed
            total += sum(len(shard.lists[t].ends) for t in weights if t in shard.lists)
        assert list(zip(best.ids.tolist(), best.scores.tolist())) == want[q]
    if postings < 128:
        assert read < 0.8 * total


def test_wide_postings_are_kept():
    docs, tf = np.array([0, 300, 70_000, 70_001, 2**30]), np.array([1, 70_000, 5, 300, 2])
    x = ranked._lists(np.zeros(5, np.int64), docs, tf, Norms())
    shard = ranked.Shard(docs, Norms())
    one = ranked.PostingList(int(x["top"][0]), x["ends"], x["tops"], x["widths"].tobytes(), x["data"].tobytes(), 5, shard)
    found, impact = one.block(0)
    assert found.tolist() == docs.tolist() and impact.tolist() == ranked.impacts(tf, np.full(5, 50)).tolist()


class Norms:
    """Norms of 50 for all documents, however many."""

    def __getitem__(self, docs):
        return np.full(len(docs), 50)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts_expected(rows, typo_every, min_chars=5, min_count=3):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            code = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if typo_every and code % typo_every == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_chars and n >= min_count}


def forms_expected(counts, ratio=2):
    """(word, form, root, n, near words, count of the form)"""
    out, form = {}, {}
    for a in counts:
        others = [b for b in counts if near(a, b)]
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best and counts[best] >= ratio * counts[a] else None
        out[a] = len(others)

    def root(w):
        return root(form[w]) if form[w] else w

    return [(w, form[w], root(w), counts[w], out[w], counts.get(form[w])) for w in counts]


@pytest.mark.parametrize("tile, typo_every", [(1024, None), (2, 3), (3, 97)])
def test_spelling_variants(spark, tile, typo_every):
    r = random.Random(6)
    base = ["turning", "keeping", "Épaules", "hhhhh", "hhhhhh", "aabbaab"]
    words = []
    for n in range(900):
        word = r.choice(base)
        if r.random() < 0.3:
            at = r.randrange(len(word))
            word = word[:at] + r.choice(["", "x", "é", word[at] * 2]) + word[at + 1 :]
        words.append(word if r.random() < 0.8 else word.upper())
    rows = awkward.texts() + [(100 + n, " ".join(words[n::9])) for n in range(9)] + [(200, ("b" * 400 + " ") * 3 + ("b" * 399 + "! ") * 9)]
    found = spelling.spelling_variants(awkward.docs(spark, rows), typo_every=typo_every, tile=tile)
    same(found, forms_expected(counts_expected(rows, typo_every)))


def test_spelling_variants_of_nothing(spark):
    assert spelling.spelling_variants(awkward.docs(spark, [])).count() == 0
    assert spelling.spelling_variants(awkward.docs(spark, [(1, None), (2, ""), (None, "12 34")])).count() == 0


def test_spelling_variants_of_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op13_spelling_variants"](spark, small), forms_expected(counts_expected(rows, 97)))


def test_long_chains_of_forms(spark):
    links = spark.createDataFrame([(f"w{n}", f"w{n + 1}") for n in range(37)] + [("a", "b")], "word string, form string")
    found = {r["word"]: r["root"] for r in spelling.roots(links).collect()}
    assert found == {**{f"w{n}": "w37" for n in range(37)}, "a": "b"}
