import random

import xxhash
from rows import docs

from logweir.llm.simhash import (
    fingerprint,
    links,
    position_sets,
    simhash_components,
    simhash_dedup,
)


def by_definition(text, words=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(fps, max_bits):
    """Smallest index reachable from each over links of few differing bits."""
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if low[j] < low[i] and (a ^ b).bit_count() <= max_bits:
                    low[i], changed = low[j], True
    return low


def some_texts(seed, count=60):
    draw = random.Random(seed)
    made = []
    for _ in range(count):
        if made and draw.random() < 0.6:
            words = draw.choice(made).split(" ")
            words[draw.randrange(len(words))] = f"w{draw.randrange(300)}"
            made.append(" ".join(words))
        else:
            made.append(" ".join(f"w{draw.randrange(300)}" for _ in range(draw.randint(1, 250))))
    return made


def test_position_sets_cover_every_guaranteed_match():
    from itertools import combinations

    for matches in range(1, 8):
        sets = position_sets(matches)
        for wanted in combinations(range(8), matches):
            assert any(set(s) <= set(wanted) for s in sets)
    assert len(position_sets(4)) <= 24


def test_fingerprint_is_the_defined_one():
    for text in ["", " \t\n", "A b", "É Ab\x0bcd\x0ce f g", "a b c d e f", "x " * 9]:
        assert fingerprint(text.encode(), 4) == by_definition(text)


def test_components_against_brute_force(spark):
    texts = [None, "", "  \n", "one", "ONE", "one two three", *some_texts(3)]
    texts += [texts[7]] * 5
    rows = list(enumerate(texts)) + [(9, texts[9])]
    found = simhash_components(docs(spark, rows, clashes=True)).collect()
    fps = [by_definition(t) for t in texts]
    low = reachable(fps, 4)
    assert len(found) == len(rows)
    for row in found:
        assert row.fingerprint == f"{fps[row.doc_id]:016x}"
        assert row.component_id == low[row.doc_id]


def test_null_ids_and_empty_table(spark):
    found = simhash_components(docs(spark, [(None, "a b"), (None, "a b"), (5, "a b"), (None, "q")]))
    assert sorted((r.component_id is None, r.component_id) for r in found.collect()) == [
        (False, 5), (False, 5), (False, 5), (True, None),
    ]
    assert simhash_components(docs(spark, [])).collect() == []
    assert simhash_dedup(docs(spark, [])).collect() == []


def test_long_lists_are_dealt_into_blocks_without_losing_links(spark):
    draw = random.Random(1)
    centre = draw.getrandbits(63)
    fps = {centre}
    while len(fps) < 120:
        x = draw.choice(sorted(fps))
        for _ in range(draw.randint(1, 6)):
            x ^= 1 << draw.randrange(63)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    for block in (4, 2048):
        edges = [(r.a, r.b) for r in links(df, 4, block).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in edges)
        parent = {x: x for x in fps}

        def top(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[max(top(a), top(b))] = min(top(a), top(b))
        assert [top(x) for x in fps] == [fps[i] for i in reachable(fps, 4)]


def test_dedup_keeps_one_row_of_each_component(spark):
    texts = some_texts(8, 30)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "s"), (3, texts[3], "de", "a"), (4, "another text", "en", "s")]
    rows += [(None, "nothing like it"), (None, "nothing like it"), (None, None)]
    df = docs(spark, rows, clashes=True)
    kept = simhash_dedup(df).collect()
    assert sorted(kept[0].asDict()) == sorted(df.columns)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    low = reachable([by_definition(rows[i][1]) for i in order], 4)
    expected = {rows[order[i]][0] for i in low}
    assert len(kept) == len(set(low))
    assert {r.doc_id for r in kept} == expected
