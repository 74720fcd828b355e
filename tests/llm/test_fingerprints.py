import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F
from rows import docs

from logweir.llm import fingerprints as fp
from logweir.llm.fingerprints import edited_fingerprints, likeness, signature

U64 = (1 << 64) - 1


def _long(value, seed):
    return xxhash.xxh64_intdigest((value & U64).to_bytes(8, "little"), seed)


def _int(value, seed):
    return xxhash.xxh64_intdigest((value & 0xFFFFFFFF).to_bytes(4, "little"), seed)


def by_definition(text):
    """{bin: tuple hash} of a text, step by step as the module says."""
    alone = r"฀-໿က-႟ក-៿⺀-퟿豈-﫿\U00020000-\U0003ffff"
    words = re.findall(rf"[{alone}]|[^ \t\n\x0b\f\r{alone}]+", text)
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    if len(words) >= fp.K:
        kmers = []
        for i in range(len(words) - fp.K + 1):
            h = hashes[i]
            for j in range(1, fp.K):
                h = _long(hashes[i + j], _long(h, 42))
            kmers.append(h)
    else:
        h = 42
        for x in hashes:
            h = _long(x, h)
        kmers = [h] if hashes else []
    bins, seen = {}, {}
    for place, kmer in enumerate(k & ((1 << 39) - 1) for k in kmers):
        number = seen[kmer] = seen.get(kmer, -1) + 1
        hashed = _int(number, _long(kmer, 42)) & ((1 << 63) - 1)
        hashed = hashed >> 24 << 24 | place
        bins.setdefault(hashed >> 57, []).append((hashed >> 24 & ((1 << 33) - 1), place))
    result = {}
    for number, entries in bins.items():
        chosen = sorted(sorted(entries)[: fp.TUPLE], key=lambda e: e[1])
        h = 42
        for rank, _ in chosen:
            h = _long(rank, h)
        result[number] = h & 0xFFFF
    return result


def some_texts():
    draw = random.Random(2)
    texts = ["", " \n ", "one", "one two", "a b c", "a b c d", "a a a a a a a a a a a a"]
    texts += ["漢字仮名交じり文 mixed ไทย words", "é ü ö x\ty\x0bz"]
    for size in (30, 200, 900, *[1500] * 40, 3000):
        texts.append(" ".join(f"w{draw.randrange(60 + size // 3)}" for _ in range(size)))
    return texts


def test_signature_against_brute_force(spark):
    rows = spark.createDataFrame(list(enumerate(some_texts())), "id int, text string")
    for row in rows.select("text", signature(F.col("text")).alias("s")).collect():
        expected = {b: t for b, t in by_definition(row.text).items()}
        assert {s >> 16: s & 0xFFFF for s in row.s} == expected, row.text[:40]
        assert list(row.s) == sorted(row.s)


def test_thin_bins_are_filled_from_all_kmers(spark, monkeypatch):
    """With few candidates per bin almost every text needs all of its k-mers."""
    monkeypatch.setattr(fp, "_SPARE", 2)
    test_signature_against_brute_force(spark)


def test_order_and_repeats_change_the_fingerprint(spark):
    draw = random.Random(4)
    half = [" ".join(f"w{draw.randrange(5000)}" for _ in range(400)) for _ in range(3)]
    texts = {
        "own": f"{half[0]} {half[1]}", "moved": f"{half[1]} {half[0]}",
        "shared": f"{half[0]} {half[2]}", "other": f"{half[2]} {half[2]}",
    }
    rows = spark.createDataFrame([tuple(texts.values())], list(texts))
    rows = rows.select(*[signature(F.col(c)).alias(c) for c in texts])
    near = {c: likeness(F.col("own"), F.col(c)).alias(c) for c in texts}
    (row,) = rows.select(*near.values()).collect()
    assert row.own == 1.0
    assert 0.3 < row.shared < 0.7
    assert row.shared < row.moved < 0.95  # the same words, in another order
    assert row.other < 0.2


def test_query_columns_and_next_document(spark):
    draw = random.Random(6)
    texts = [None, "", "x", "é" * 7, "abc def " * 30, "abc def " * 30]
    texts += [" ".join(f"w{draw.randrange(900)}" for _ in range(draw.randint(1, 90))) for _ in range(50)]
    rows = [(draw.randrange(10**9), t) for t in texts]
    rows += [(rows[4][0], "zz of the same id"), (None, "null id"), (None, "null id b")]
    found = edited_fingerprints(docs(spark, rows, clashes=True)).collect()
    whole = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()),
        reverse=True,
    )
    expected = []
    for at, (i, text) in enumerate(whole):
        after, half = whole[(at + 1) % len(whole)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        expected.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256) for r in found]
    assert sorted(got) == sorted(expected)
    prints = {}
    text_of = {(str(i), len(t)): t for i, t in whole}
    for r in found:
        assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
        prints.setdefault(text_of[str(r.doc_id), r.n_chars], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_one_row_and_no_row(spark):
    (row,) = edited_fingerprints(docs(spark, [(3, "a b c d e f")])).collect()
    assert row.near_next == 1.0
    assert edited_fingerprints(docs(spark, [])).collect() == []
