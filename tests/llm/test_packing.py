import array
import random
import zlib
from itertools import combinations

import pytest
from rows import docs

from logweir.llm.packing import (
    WordTokenizer,
    best_fit,
    bin_completion,
    fillings,
    least_bins,
    packed,
    tokenized,
)

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest_bins(lengths, capacity):
    """By trying all: each new bin takes the largest left and any set that fits."""
    best = len(lengths)

    def go(rest, used):
        nonlocal best
        if not rest:
            best = min(best, used)
        elif used + 1 < best or used + 1 == best and sum(rest) <= capacity:
            for r in range(len(rest) - 1, -1, -1):
                for chosen in combinations(range(1, len(rest)), r):
                    if rest[0] + sum(rest[i] for i in chosen) <= capacity:
                        left = [x for i, x in enumerate(rest) if i and i not in chosen]
                        go(left, used + 1)

    go(sorted(lengths, reverse=True), 0)
    return best


def test_bin_completion_is_optimal_on_small_sets():
    draw = random.Random(5)
    better = 0
    for _ in range(120):
        lengths = [draw.randint(8, 60) for _ in range(draw.randint(1, 8))]
        bins = bin_completion(lengths, 100, nodes=10_000)
        assert sorted(x for b in bins for x in b) == sorted(lengths)
        assert max(map(sum, bins)) <= 100
        assert len(bins) == fewest_bins(lengths, 100)
    for lengths in ([50, 40, 35, 25, 25, 25], [44, 36, 32, 32, 30, 26], [46, 45, 37, 35, 20, 17]):
        better += len(bin_completion(lengths, 100)) < len(best_fit(sorted(lengths)[::-1], 100))
    assert better  # the search finds what best fit does not


def test_bin_completion_fills_all_bins_of_a_large_group():
    draw = random.Random(11)
    for least, most, above in ((1250, 1450, 1.012), (800, 1700, 1.01), (600, 900, 1.01)):
        lengths = [draw.randint(least, most) for _ in range(8192)]
        bins = bin_completion(lengths, 4096)
        assert sorted(x for b in bins for x in b) == sorted(lengths)
        assert max(map(sum, bins)) <= 4096
        assert len(bins) <= above * sum(lengths) / 4096
        assert len(best_fit(sorted(lengths)[::-1], 4096)) > 1.04 * sum(lengths) / 4096
        if least == 1250:
            assert len(bins) == 2731  # no bin holds four pieces


def test_no_packing_is_below_the_lower_bound():
    draw = random.Random(12)
    for _ in range(60):
        lengths = [draw.randint(8, 60) for _ in range(draw.randint(1, 8))]
        assert -(-sum(lengths) // 100) <= least_bins(lengths, 100) <= fewest_bins(lengths, 100)
    assert least_bins([1300] * 8192, 4096) == 2731 and least_bins([51] * 7, 100) == 7


def test_fillings_are_undominated_and_fullest_first():
    found = fillings([30, 20, 20, 10], 50, 50, 1000)
    assert found[0] in ((30, 20),)
    assert all(sum(f) <= 50 for f in found)
    assert (20, 20) not in found  # 10 still fits
    assert fillings([30], 20, 0, 100) == []
    assert fillings([], 20, 20, 100) == [()]


def test_word_tokenizer_equals_the_tokenizer():
    whole = tokenizers.Tokenizer.from_file(PATH)
    draw = random.Random(3)
    alphabet = "aAbé,.'’s 1 9\n\t\x1c\xa0　<|endoftext|>İΣσςéœ漢🙂ﬁ½²_#!—"
    texts = ["", " ", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b c<|startoftext|>", "x.. y,.", "it's. We'LL,"]
    texts += ["".join(draw.choices(alphabet, k=draw.randint(1, 40))) for _ in range(3000)]
    encode = WordTokenizer(PATH)
    for text in texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert encode(text) == array.array("I", ids).tobytes(), repr(text)


def check(spark, df, rows, capacity=64, **options):
    found = packed(tokenized(df, capacity=capacity), capacity, **options).collect()
    whole = tokenizers.Tokenizer.from_file(PATH)
    expected = []
    for i, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            crc = zlib.crc32(array.array("I", part).tobytes())
            expected.append((i, k // capacity, k, len(part), crc))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    whole = best_fit(sorted((r.length for r in found), reverse=True), capacity)
    return len(sequences), len(whole)


def test_packing_round_trip(spark):
    draw = random.Random(9)
    rows = [(1, None), (2, ""), (3, " \n"), (None, "null id"), (4, "word " * 1000)]
    rows += [(i, " ".join(f"w{draw.randrange(99)}" for _ in range(draw.randint(0, 40)))) for i in range(5, 300)]
    rows += rows[10:14] * 3
    df = docs(spark, rows, clashes=True)
    used, best = check(spark, df, rows)
    assert used <= best  # one group: best fit over all pieces is the first incumbent
    used, best = check(spark, df, rows, group_size=64)
    assert used <= best * 1.05 + 1


def test_empty_table(spark):
    assert packed(tokenized(docs(spark, []))).collect() == []
