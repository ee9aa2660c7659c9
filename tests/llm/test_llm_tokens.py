"""Tokens and packing against the tokenizer library and exhaustive search."""

import random
from collections import Counter

import awkward
import brute
import duckdb
import public_tokenizers
import pytest

from sparkrank.llm import bpe, packing
from sparkrank.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = [
    " ", "  ", "\n", "\t", "a", "b", "th", "e", "'", "ll", "'s", "1", "23", "!", "é", "ß", "中文", "　", "\x85", "\x1c",
    "<|endoftext|>", "<|endof", "😀", "́", "\xa0", "=", "-",
]


def random_texts(n, seed):
    r = random.Random(seed)
    for k in range(n):
        text = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60)))
        if k % 10 == 0:  # long runs without a place to cut
            text = r.choice(["a", "ab", " ", "-", "é", "\n ", "1", "xyz", " ."]) * r.randint(2000, 6000) + text
        yield text


def test_encoder_is_the_library(spark):
    encoder = bpe.encoder(FILE)
    r = random.Random(1)
    for text in random_texts(300, 1):
        want = brute.ids(text)
        steps = [1 << 18, 700] + [r.randint(1, 40)] * (len(text) < 500)
        assert all(bpe.unpack(encoder.encode(text, step)) == want for step in steps)
        assert packing.token_ids(text, RANKS) == want
        if "<|endoftext|>" not in text:
            assert bpe.unpack(encoder._long(text)) == want


def test_buffers_are_bounded():
    encoder = bpe.Encoder(bpe.vocabulary(FILE))
    for piece in ["a" * 1000, " " * 1000, "\n" * 1000, "é1 -" * 250]:
        most = 0
        for _ in range(60):
            encoder._matches(piece, False)
            most = max(most, len(encoder.buffer) + len(encoder.stretch.held))
        assert most < 3 * bpe.LONG
        encoder._matches("", True)


def test_lookahead_follows_chains():
    # What follows "c" decides whether "bc" is joined, and that whether "ab" is.
    merges = [(b"c", b"d"), (b"b", b"c"), (b"a", b"b")]
    assert bpe.sufficient_lookahead(merges) >= 3
    assert bpe.sufficient_lookahead([]) == 1


def test_decoder_is_the_library():
    r, vocabulary = random.Random(2), bpe.vocabulary(FILE)
    for _ in range(300):
        ids = [r.randint(0, 50256) for _ in range(r.randint(0, 30))]
        machine = bpe.Decoder(vocabulary)
        text = "".join(machine.feed([i]) for i in ids) + machine.finish()
        assert text == brute.TOKENIZER.decode(ids, skip_special_tokens=False)


def expected_round_trip(rows):
    out = []
    for i, text in rows:
        ids = brute.ids(text or "")
        decoded = brute.TOKENIZER.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(decoded)))
    return sorted(out, key=repr)


def test_round_trip(spark):
    found = bpe.round_trip(awkward.docs(spark), FILE).collect()
    assert sorted(map(tuple, found), key=repr) == expected_round_trip(awkward.texts())
    assert bpe.round_trip(awkward.docs(spark, []), FILE).count() == 0


def test_round_trip_of_documents(spark, small):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    found = QUERIES["op2_bpe_round_trip"](spark, small).collect()
    assert sorted(map(tuple, found), key=repr) == expected_round_trip(rows)


def test_encode_and_decode_tables(spark):
    encoded = bpe.encode_texts(awkward.docs(spark), FILE)
    decoded = bpe.decode_ids(encoded, FILE)
    want = sorted(((i, t or "") for i, t in awkward.texts()), key=repr)
    assert sorted(map(tuple, decoded.collect()), key=repr) == want


def best(items, capacity):
    """Fewest sequences, by trying all."""
    items, least = sorted(items, reverse=True), [len(items)]

    def go(n, bins):
        if len(bins) >= least[0]:
            return
        if n == len(items):
            least[0] = len(bins)
            return
        seen = set()
        for b, used in enumerate(bins):
            if used + items[n] <= capacity and used not in seen:
                seen.add(used)
                bins[b] += items[n]
                go(n + 1, bins)
                bins[b] -= items[n]
        bins.append(items[n])
        go(n + 1, bins)
        bins.pop()

    go(0, [])
    return least[0]


def test_reduction_keeps_the_optimum_and_plans_hold_everything():
    r = random.Random(3)
    for _ in range(600):
        capacity = r.choice([10, 16, 25])
        items = [r.randint(1, capacity) for _ in range(r.randint(0, 9))]
        fixed, rest = packing.reduce_instance(Counter(items), capacity)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(t for _, t in fixed) + best(left, capacity) == best(items, capacity)
        packed = Counter()
        for pattern, times in packing.plan(Counter(items), capacity):
            assert sum(s * n for s, n in pattern) <= capacity
            for s, n in pattern:
                packed[s] += n * times
        assert packed == Counter(items)


def test_plan_is_close_to_the_bound():
    r = random.Random(4)
    histogram = Counter(min(1024, int(r.expovariate(1 / 500)) + 1) for _ in range(50_000))
    used = sum(t for _, t in packing.plan(histogram))
    assert used <= -(-sum(s * n for s, n in histogram.items()) // 1024) + 2


def check_packed(found, rows):
    assert sorted([tuple(r)[:5] for r in found], key=repr) == sorted(brute.pieces(rows), key=repr)
    used = brute.check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in found])
    # No two pieces over half a sequence go together.
    bound = max(sum(r["length"] for r in found) / 1024, sum(r["length"] > 512 for r in found))
    assert used <= bound * 1.01 + 2


def test_packing(spark, small):
    check_packed(packing.pack_documents(awkward.docs(spark), RANKS).collect(), awkward.texts())
    assert packing.pack_documents(awkward.docs(spark, []), RANKS).count() == 0
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    check_packed(QUERIES["op3_best_fit_packing"](spark, small).collect(), rows)


def test_long_runs_of_blanks_are_packed(spark):
    n = 2_000_000
    texts = ["x " + " " * n + "y", "x" + " " * n, "\n" * n + ".", " \t" * (n // 2) + "<|endoftext|>" + " " * n + "\u3000é"]
    for text in texts:
        assert packing.token_ids(text, RANKS) == brute.ids(text)
    rows = [(1, "a few words"), (2, texts[0])]
    check_packed(packing.pack_documents(awkward.docs(spark, rows), RANKS).collect(), rows)


def test_runs_of_blanks_about_the_cut(spark):
    for text in (a + b * n + c for a in ("", "x", "x ") for b in (" ", "\n", "\u3000") for c in ("", "y", "<|endoftext|>") for n in (packing.BLANK_RUN - 1, packing.BLANK_RUN, packing.BLANK_RUN + 1)):
        assert packing.token_ids(text, RANKS) == brute.ids(text)


def test_lengths_out_of_range_are_refused(spark):
    pieces = spark.createDataFrame([(1, 5), (2, 11)], "id bigint, length bigint")
    with pytest.raises(AssertionError):
        packing.pack_pieces(pieces, capacity=10)
