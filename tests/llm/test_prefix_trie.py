import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logweir.llm.prefix_trie import conversation_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    """Every prefix of every rebuilt conversation as a key of its own."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            md5 = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), md5, role, text))
    turns = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(f"{'-' if c < 0 else ''}{abs(c) % 20}")
        whole = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, ids in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(ids) - 1) * words
    return sorted(
        (
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, ids in members.items()
    )


def _same(spark, rows):
    got = conversation_trie(spark.createDataFrame(rows, TURNS))
    assert sorted(map(tuple, got.collect())) == brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    import random

    draw = random.Random(seed)
    rows = []
    for conv in range(-30, 130):
        for turn in range(draw.choice([0, 1, 2, 3, 5, 8, 9, 21])):
            text = draw.choice(["a", "a b", " \t x\x0b", "", None])
            rows.append((conv, draw.choice([turn, turn, None]), draw.choice(["u", "u", None]), text))
    _same(spark, rows)


def test_depths_around_every_cut(spark):
    """Chains that leave one long conversation at every depth."""
    rows = []
    for conv in range(0, 45):
        for turn in range(45):
            rows.append((20 * conv, turn, "u", "same" if turn != conv else f"other {conv}"))
    rows += [(20 * 50, turn, "u", "same") for turn in range(33)]
    rows += [(20 * 51, turn, "u", "same") for turn in range(33)]
    _same(spark, rows)


def test_copies_of_one_conversation(spark):
    rows = [(20 * c, t, "u", f"t {t}") for c in range(9000) for t in range(2)]
    _same(spark, rows)


def test_special_values(spark):
    long = "word " * 200_000
    rows = [
        (1, None, None, None), (1, 0, "u", ""), (1, 0, "u", ""), (None, 1, "u", "lost"),
        (2, 0, "u", long), (20, 0, "u", long), (20, 1, "a:b", "c"), (40, 0, "a", ":bc"),
        # Their bases have no rows.
        (61, 0, "u", "x"), (62, 0, "u", "x"), (63, 0, "u", "x"), (64, 0, "u", "x"),
    ]
    _same(spark, rows)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie(empty).collect() == []
    table = spark.createDataFrame([(1, 0, "u", "x")], TURNS)
    plain = conversation_trie(table)
    clashing = table.withColumns(
        {c: F.lit("z") for c in ("name", "place", "item", "words", "block", "depth", "part", "row")}
    )
    assert conversation_trie(clashing).collect() == plain.collect()
    assert plain.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]


def test_only_unread_conversations(spark):
    assert conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], TURNS)).collect() == []
