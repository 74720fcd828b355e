"""The trie of conversation prefixes by van Emde Boas recursion.

Every conversation is a sequence of turns; every distinct prefix is a node. The recursion cuts the
sequences of a range of depths at half of it. The prefix up to the cut gets a name: a hash of the
name at the head of the range and of the content between. Names make equal prefixes equal rows, so
the upper trie (from the head to the cut) and the lower forests (one below each cut name) are the
same problem at half the depth, and all ranges of one size are handled side by side by Spark:

- contents: blocks of 2, 4, 8 ... times `LEAF` turns get a content hash from their two halves;
- down: from the largest range to the smallest, cut prefixes are named;
- within `LEAF` turns, the smallest tries are built directly;
- up: totals of a lower forest are grafted on the cut node that it hangs from, range by range,
  from the smallest to the largest;
- down again: a cut node's total is that of its own forest plus the totals at the forest's ends,
  which the larger ranges have given.

The rows of all rounds together are proportional to the turns, however long a conversation, and
the rounds are twice the binary logarithm of the longest one. A cut at depth d belongs to the
range whose size is the lowest bit of d, so a name does not depend on what other rows there are.

A conversation may hold a third of all turns, and a node a third of all conversations. Turns are
numbered over a range sort, which splits inside a conversation; aggregates over nodes combine
before their shuffle. `ends_sha256` is one running hash by its definition: members are joined to
texts of up to `CHUNK` ids in parallel, and one task streams these texts, a batch at a time.

Defined results: rows of a null conv_id take no part; null role and text are empty. Turns are
ordered by number, null first, those of equal number by the MD5 of role and text; repeated rows
are turns of their own. A negative conv_id c has the base c - c%20 with the sign of c in the
remainder, as SQL has it. Other columns are not read. An empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.numbering import numbered
from logweir.sources.staging import stage

#: Turns of the smallest range, which is built directly.
LEAF = 4
#: Ids are joined to texts by ranges of so many.
CHUNK = 4096
_NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)


def _name(*parts) -> Column:
    columns = (F.col(part) if isinstance(part, str) else part for part in parts)
    return F.unhex(F.md5(F.concat(*[column.cast("binary") for column in columns])))


def _root() -> Column:
    return F.lit(b"\0" * 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), item (hash of role and text), words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        _name(F.length(role).cast("string"), F.lit(":"), role, text).alias("item"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    # Equal rows are told apart for the sort, so that a range can end between them. Written, as a
    # range sort reads its input twice, and the texts need to be read once.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "item", "row"]
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "hashed")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row", "turn")
    rows = stage(rows, "turns").select(
        "*",
        F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("part"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    return numbered(rows, ["conv_id"], ["part", "file"]).withColumnRenamed("line_number", "place")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns after the first turns were exchanged.

    Conversation c begins with the first h turns of conversation c - c % `every`, in place of its
    own first h; h is the CRC-32 of c's decimal text modulo `most`.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = stage(
        convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")),
        "conversations",
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    lent = F.least("h", F.coalesce("n_base", F.lit(0))).alias("lent")
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "n", "h", lent)
    convs = convs.withColumn("length", F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("lent"))
    convs = stage(convs, "rebuilt")
    heads = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "place", "item", "words", "length"]
    # `most` - 1 turns at the most for `every` - 1 conversations at the most.
    borrowed = convs.where("lent > 0").join(heads, "base").where("place <= lent").select(*columns)
    own = turns.join(convs.select("conv_id", "h", "lent", "length"), "conv_id").where("place > h")
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("lent")).select(*columns)
    return convs.select("conv_id", "length"), own.unionByName(borrowed)


def _blocks(turns: DataFrame) -> DataFrame:
    """Turns in blocks of `LEAF`: conv_id, block, length, items and words in order."""
    packed = turns.groupBy(
        "conv_id", "length", F.floor((F.col("place") - 1) / LEAF).alias("block")
    ).agg(F.sort_array(F.collect_list(F.struct("place", "item", "words"))).alias("turns"))
    return packed.select(
        "conv_id", "block", "length",
        F.col("turns.item").alias("items"), F.col("turns.words").alias("words"),
    )


def _contents(blocks: DataFrame, levels: int) -> list[DataFrame]:
    """For each level, conv_id, block and content name of the full blocks of LEAF * 2**level."""
    named = blocks.where(F.size("items") == LEAF).select(
        "conv_id", "block", _name(F.array_join(F.transform("items", F.hex), "")).alias("name")
    )
    found = []
    for level in range(levels):
        found.append(stage(named, f"contents-{level}"))
        halves = found[-1].groupBy("conv_id", F.floor(F.col("block") / 2).alias("half")).agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by("name", "block").alias("a"), F.max_by("name", "block").alias("b"),
        )
        named = halves.where("n = 2").select(
            "conv_id", F.col("half").alias("block"), _name("a", "b").alias("name")
        )
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _cuts(convs: DataFrame, contents: list[DataFrame]) -> DataFrame:
    """conv_id, depth, name of the prefixes at the cuts, the root among them."""
    parts = [convs.select("conv_id", F.lit(0).cast("bigint").alias("depth"), _root().alias("name"))]
    for level in reversed(range(len(contents))):
        size = LEAF << level
        lower = contents[level].where("block % 2 = 0").select(
            "conv_id", (F.col("block") * size).alias("depth"), F.col("name").alias("content")
        )
        cut = _union(parts).join(lower, ["conv_id", "depth"]).select(
            "conv_id", (F.col("depth") + size).alias("depth"), _name("name", "content").alias("name")
        )
        parts.append(stage(cut, f"cuts-{level}"))
    return _union(parts)


def _named_blocks(blocks: DataFrame, cuts: DataFrame) -> DataFrame:
    """Blocks with the names of all their prefixes: that of the head, then one for each turn."""
    block = (F.col("depth") / LEAF).cast("bigint")
    heads = cuts.select("conv_id", block.alias("block"), F.col("name").alias("head"))
    ends = cuts.select("conv_id", (block - 1).alias("block"), F.col("name").alias("end"))
    joined = blocks.join(heads, ["conv_id", "block"]).join(ends, ["conv_id", "block"], "left")
    within = [
        F.when(
            F.size("items") > i,
            _name("head", F.array_join(F.transform(F.slice("items", 1, i + 1), F.hex), "")),
        )
        for i in range(LEAF - 1)
    ]
    names = F.filter(F.array(F.col("head"), *within, F.col("end")), lambda name: name.isNotNull())
    return joined.select("conv_id", "block", "length", "words", names.alias("names"))


def _nodes(convs: DataFrame, named: DataFrame) -> DataFrame:
    """One row per prefix, with `path`: its ancestors within the block, the head first."""
    turns = named.select(
        "conv_id", "block", "length", "names", F.posexplode("words").alias("i", "words")
    )
    turns = turns.select(
        "conv_id", "length", "words",
        (F.col("block") * LEAF + F.col("i") + 1).alias("depth"),
        F.get("names", F.col("i") + 1).alias("name"),
        F.slice("names", F.lit(1), F.col("i") + 1).alias("path"),
    )
    roots = convs.select(
        "conv_id", "length", F.lit(0).cast("bigint").alias("words"),
        F.lit(0).cast("bigint").alias("depth"), _root().alias("name"),
        F.array().cast("array<binary>").alias("path"),
    )
    # Words, depth and path hang on the name; as keys they let the aggregate be hashed.
    grouped = turns.unionByName(roots).groupBy("name", "depth", "path", "words").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("length").alias("longest"),
    )
    return grouped.select(
        "name", "depth", "path", "conv_id", "n_convs",
        (F.col("longest") == F.col("depth")).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _level(depth: str, levels: int) -> Column:
    """The level whose range size is the lowest bit of a depth; the root has the highest."""
    block = (F.col(depth) / LEAF).cast("bigint")
    low = block.bitwiseAND(-block)
    return F.when(block == 0, levels).otherwise(F.round(F.log2(low)).cast("int"))


def _below_cuts(nodes: DataFrame, cuts: DataFrame, levels: int) -> DataFrame:
    """name, leaves, saved: totals over all strict descendants of the nodes at cuts."""
    heads = nodes.where(F.col("depth") > 0).select(
        F.element_at("path", 1).alias("name"),
        (F.floor((F.col("depth") - 1) / LEAF) * LEAF).alias("depth"), "leaves", "saved",
    )
    parts = [
        stage(_sums(heads.withColumn("level", _level("depth", levels)), "name", "level"), "below")
    ]
    if levels == 0:
        return parts[0].drop("level")
    # From each node at a cut to its ancestors at the cuts before it, one for each range that ends
    # in it: found in the smallest member's own cuts.
    ends = nodes.where((F.col("depth") > 0) & (F.col("depth") % LEAF == 0)).select(
        F.col("name").alias("low"), "conv_id", F.col("depth").alias("low_depth"),
        F.explode(F.sequence(F.lit(0), _level("depth", levels))).alias("k"),
    )
    ends = ends.withColumn("depth", F.col("low_depth") - F.lit(LEAF) * F.pow(F.lit(2), "k").cast("bigint"))
    links = ends.join(cuts, ["conv_id", "depth"]).select(
        "low", "k", F.col("name").alias("high"), _level("depth", levels).alias("high_level"),
        (_level("low_depth", levels) == F.col("k")).alias("first"),
    )
    links = stage(links, "links")
    own: dict[int, DataFrame] = {}
    for k in range(levels):
        done = _sums(_union(parts).where(F.col("level") == k), "name")
        own[k] = stage(done, f"forest-{k}")
        graft = links.where((F.col("k") == k) & F.col("first")).withColumnRenamed("low", "name")
        grafted = _sums(own[k].join(graft, "name"), "high", "high_level").select(
            F.col("high").alias("name"), F.col("high_level").alias("level"), "leaves", "saved"
        )
        parts.append(stage(grafted, f"grafts-{k}"))
    totals = [stage(_sums(_union(parts).where(F.col("level") == levels), "name"), "root")]
    for k in reversed(range(levels)):
        beyond = links.where((F.col("k") == k) & ~F.col("first")).withColumnRenamed("low", "name")
        ends_ = _union(totals).join(beyond, "name").select(
            F.col("high").alias("name"), "leaves", "saved"
        )
        totals.append(stage(_sums(own[k].unionByName(ends_), "name"), f"totals-{k}"))
    return _union(totals)


def _digests(convs: DataFrame, named: DataFrame) -> DataFrame:
    """name, ends_sha256 of the nodes at which conversations end."""
    last = named.where((F.col("block") + 1) * LEAF >= F.col("length"))
    ends = last.select("conv_id", F.element_at("names", -1).alias("name")).unionByName(
        convs.where("length = 0").select("conv_id", _root().alias("name"))
    )
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))
    chunks = ends.groupBy("name", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.array_join(ids, ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            names, digests = [], []
            for next_name, ids in zip(batch.column("name").to_pylist(), batch.column("ids")):
                data = ids.as_py().encode()
                if next_name == name:
                    running.update(b"," + data)
                    continue
                if name is not None:
                    names.append(name)
                    digests.append(running.hexdigest())
                name, running = next_name, hashlib.sha256(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(digests, pa.string())],
                ["name", "ends_sha256"],
            )
        if name is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([running.hexdigest()])], ["name", "ends_sha256"]
            )

    # The rows of a node are its members over CHUNK at the fewest: the hash has no parallel form.
    return (
        chunks.repartition("name").sortWithinPartitions("name", "chunk")
        .select("name", "ids").mapInArrow(run, "name binary, ends_sha256 string")
    )


def trie_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie over `convs` (conv_id, length) and their `turns`
    (conv_id, place, item, words, length); both should come from something written."""
    spark = convs.sparkSession
    longest = convs.agg(F.max("length")).first()[0]
    if longest is None:
        return spark.createDataFrame([], _NODES)
    levels = 0
    while LEAF << levels <= longest:
        levels += 1
    blocks = stage(_blocks(turns), "blocks")
    cuts = _cuts(convs, _contents(blocks, levels))
    named = stage(_named_blocks(blocks, cuts), "named")
    nodes = stage(_nodes(convs, named), "nodes")
    below = _below_cuts(nodes, cuts, levels)
    # What each node gives to itself, to its ancestors within the block but the head, whose total
    # is known, and as a child to its parent.
    zero = F.lit(0).cast("bigint")
    gives = nodes.join(
        below.select("name", F.col("leaves").alias("more"), F.col("saved").alias("more_saved")),
        "name", "left",
    )
    leaves = F.col("leaves") + F.coalesce("more", zero)
    saved = F.col("saved") + F.coalesce("more_saved", zero)
    upward = F.transform(
        F.slice("path", 2, LEAF),
        lambda name: F.struct(name.alias("name"), leaves.alias("leaves"), saved.alias("saved"), zero.alias("n")),
    )
    own = F.struct("name", leaves.alias("leaves"), saved.alias("saved"), zero.alias("n"))
    parent = F.when(F.size("path") > 0, F.element_at("path", -1))
    child = F.struct(
        parent.alias("name"), zero.alias("leaves"), zero.alias("saved"), (zero + 1).alias("n")
    )
    given = gives.select(F.explode(F.concat(F.array(own, child), upward)).alias("g")).select("g.*")
    totals = given.where("name is not null").groupBy("name").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.sum("n").alias("n_children"),
    )
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.select("name", "depth", "conv_id", "n_convs", parent.alias("parent"))
        .join(totals, "name")
        .join(_digests(convs, named), "name", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    convs, turns = rebuilt(numbered_turns(conversations))
    return trie_nodes(convs, turns)


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT conv_id, list({'role': role, 'text': text}
    ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id
), sized AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT],
                list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
      [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))
    ), 4294967295) % 4 AS h
  FROM lists
), rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
  FROM sized s LEFT JOIN lists b ON b.conv_id = s.base
), prefixes AS (
  SELECT conv_id, len(turns) AS n, d, md5(turns[1:d]::VARCHAR) AS p,
         list_transform(range(0, d + 1), lambda a: md5(turns[1:a]::VARCHAR)) AS path,
         CASE WHEN d > 0 THEN
           len(regexp_extract_all(turns[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, d, any_value(path) AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(n) = d AS leaf, (count(*) - 1) * any_value(words) AS saved,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM prefixes GROUP BY p, d
), totals AS (
  SELECT a, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT unnest(path) AS a, leaf, saved FROM nodes) GROUP BY a
), children AS (
  SELECT path[d] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, t.n_leaves, t.saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN totals t ON t.a = n.p LEFT JOIN children c ON c.p = n.p
LEFT JOIN nodes up ON n.d > 0 AND up.p = n.path[n.d]
"""
