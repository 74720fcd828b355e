import hashlib
import random

import pytest
from rows import docs

from logweir.llm.substrings import covered, cut_spans, remove_repeats


def by_definition(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            passage = tuple(words[k : k + window])
            if i is not None:
                first[passage] = min(first.get(passage, i), i)
    result = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        result.append((str(i), len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(result)


def found(df, window):
    rows = remove_repeats(df, window=window).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows)


@pytest.mark.parametrize("window", [1, 3, 12])
def test_against_brute_force(spark, window):
    draw = random.Random(window)
    passages = [[f"p{k}-{i}" for i in range(draw.randint(8, 30))] for k in range(6)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a a a a a a a a a a a"), (None, "a a a")]
    for i in range(5, 45):
        words = [f"w{draw.randrange(40 if window < 12 else 4000)}" for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 2)):
            at, chosen = draw.randint(0, len(words)), draw.choice(passages)
            words[at:at] = chosen[draw.randint(0, 4) :]
        rows.append((i, draw.choice([" ", "\n", " \x0b "]).join(words)))
    rows += [(50, rows[20][1]), (51, rows[20][1]), (20, rows[20][1]), (20, rows[21][1])]
    rows += [(None, rows[22][1]), (60, "é ü " * 20), (61, "é ü " * 20)]
    assert found(docs(spark, rows, clashes=True), window) == by_definition(rows, window)


def test_empty_table(spark):
    assert found(docs(spark, []), 5) == []


def test_spans_cut_the_text(spark):
    import numpy as np

    assert covered(np.array([7, 0, 1, 20]), 5, 30) == [(0, 12), (20, 25)] or covered(
        np.array([7, 0, 1, 20]), 5, 30
    ) == [(0, 6), (7, 12), (20, 25)]
    shared = " ".join(f"s{i}" for i in range(8))
    rows = [(1, f"a b {shared} c"), (2, f"x\n{shared}  y z")]
    spans = {r.doc_id: r.spans for r in remove_repeats(docs(spark, rows), window=8).collect()}
    assert spans[1] == []
    cut = cut_spans(rows[1][1].encode(), [(s.start, s.end) for s in spans[2]])
    assert cut == b"x y z"
