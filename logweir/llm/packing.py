"""Packing of token sequences by bin completion.

`tokenized` turns texts into pieces of at most `capacity` tokens; `packed` lays the pieces into as
few sequences as it can. Pieces are dealt by hash into groups of about `group_size`, each a unit of
work of bounded size. A group is solved by branch and bound: the incumbent is the best-fit
decreasing packing; a node takes the largest piece left and tries its undominated fillings, the
fullest first; a branch ends when its waste leaves no room for a better packing than the incumbent.
The first branch gives every bin its fullest filling, down to the last, as a second incumbent; from
there the search goes back up, and what a node's other filling leaves is packed best-fit as a new
incumbent. Most groups end at the root, where best fit meets the lower bound. `nodes`, and twice
the number of bins, limits the search of one group, not the packing, which is always complete. What groups leave in sequences that are not nearly full is dealt and packed once
more, so that groups cost next to no sequences.

Defined results: null and empty text is the end token alone. Repeated rows are packed each. Null
ids are kept. Only texts longer than `capacity` are cut. Columns other than id and text are not
read; an empty table gives an empty result.
"""

import array
import os
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import worker_state
from logweir.sources.staging import stage

#: Bytes of remembered words, about, in each of two generations.
CACHE_BYTES = 64 << 20
_ENTRY_BYTES, _LETTER_BYTES = 300, 6  # of a word in the cache: its objects, each of its letters
_SEPARATOR = "<|endoftext|>"
# Marks that the tokenizer cuts off a letter before them (an apostrophe may belong to the word).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, str]:
    """The usual printable stand-ins of byte-level BPE: bytes that print stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class WordTokenizer:
    """Ids, as little-endian 32-bit bytes, of texts by a tokenizer that drops white space.

    Words between spaces or line feeds are encoded apart and remembered, in a younger and an older
    generation: frequent words stay when the younger one is full. The tokenizer never joins across
    white space, so a text's ids are its words' ids in a row. It puts text in lower case and cuts
    between a letter and the marks after it; for Latin-1 that is done before looking up, and words
    of letters alone go straight to the tokenizer's model. Other new words go through the whole
    tokenizer together, with a special token between.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if self.size > CACHE_BYTES:
            self.known, self.older, self.size = {"": b""}, self.known, 0
        known = self.known
        if new := set(words).difference(known):
            self.size += sum(_ENTRY_BYTES + _LETTER_BYTES * len(word) for word in new)
            for word in [w for w in new if w in self.older]:
                known[word] = self.older[word]
                new.discard(word)
            self._learn(new)
        return b"".join(map(known.__getitem__, words))

    def _learn(self, words: set[str]) -> None:
        known, older = self.known, self.older
        parts, plain = [], []
        for word in words:
            core, tail = word, ""
            latin = word.isascii() or max(word) < "Ā"
            if latin and "<|" not in word:
                lower = word.lower()
                core = lower.rstrip(_MARKS)
                if core and core[-1].isalpha():
                    tail = lower[len(core) :]
                else:
                    core = lower
            parts.append((word, core, tail))
            for piece in (core, tail):
                if piece not in known:
                    if piece in older:
                        known[piece] = older[piece]
                    elif latin and piece.isalpha():
                        letters = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
                        ids = [token.id for token in self.model.tokenize(letters)]
                        known[piece] = array.array("I", ids).tobytes()
                    else:
                        known[piece] = b""
                        plain.append(piece)
        for at in range(0, len(plain), 2000):
            chunk = [piece for piece in plain[at : at + 2000] if "<|" not in piece]
            ids = self._ids(_SEPARATOR.join(chunk))
            cuts = np.flatnonzero(ids == self.separator)
            for piece, own in zip(chunk, np.split(ids, cuts)):
                known[piece] = own[own != self.separator].tobytes()
        for piece in plain:
            if "<|" in piece:
                known[piece] = self._ids(piece).tobytes()
        for word, core, tail in parts:
            known[word] = known[core] + known[tail] if tail else known[core]

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")


def tokenized(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece. Executors need the tokenizer file;
    without a path it is that of `public_tokenizers` on their machine."""
    source = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    end = array.array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        state = worker_state()
        encode = state.setdefault(("tokens", path), None) or WordTokenizer(path)
        state["tokens", path] = encode
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = encode(text.as_py()) + end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        # The worker may live on; what the next task needs most is in the younger generation.
        encode.older = {}

    return source.mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths, by best-fit decreasing; `lengths` are in descending order."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # of open bins, ascending
    for size in lengths:
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, chosen = room.pop(at)
            bins[chosen].append(size)
        else:
            left, chosen = capacity, len(bins)
            bins.append([size])
        if left > size:
            insort(room, (left - size, chosen))
    return bins


def least_bins(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins: by the sum, and by how many pieces of a size a bin can hold.

    For each k a piece of the share x counts as floor((k + 1) x) / k, or as x where (k + 1) x is
    whole; what fits a bin never counts more than 1.
    """
    sizes = np.array(lengths, np.int64)
    least = -(-int(sizes.sum()) // capacity)
    for k in range(1, 33):
        steps, rest = np.divmod((k + 1) * sizes, capacity)
        least = max(least, -(-int(np.where(rest, steps * capacity, k * sizes).sum()) // (k * capacity)))
    return least


def _sets(
    sizes: list[int], counts: Counter[int], room: int, waste: int
) -> Iterator[tuple[int, ...]]:
    """All sets of `sizes` (descending, each `counts` times) that fill `room` but for at most
    `waste`, the fullest first; of equal sums first those whose smallest piece is large.

    The sums that the first sizes reach are bits of an integer, so that no step leads nowhere.
    """
    mask = (1 << room + 1) - 1
    reach = [1]

    def reached(end: int) -> int:
        while len(reach) <= end:
            size, sums, step = sizes[len(reach) - 1], reach[-1], 1
            count = min(counts[size], room // size)
            while count > 0:
                step = min(step, count)
                sums |= sums << step * size & mask
                count -= step
                step *= 2
            reach.append(sums)
        return reach[end]

    def of(total: int, end: int) -> Iterator[tuple[int, ...]]:
        if total == 0:
            yield ()
            return
        for i in range(end):
            size, before = sizes[i], reached(i)
            for k in range(1, min(counts[size], total // size) + 1):
                if before >> total - k * size & 1:
                    for taken in of(total - k * size, i):
                        yield (*taken, *[size] * k)

    total = room
    while total >= room - waste:
        yield from of(total, len(sizes))
        less = reached(len(sizes)) & (1 << total) - 1
        if not less:
            return
        total = less.bit_length() - 1


def _dominated(
    taken: tuple[int, ...], sizes: list[int], counts: Counter[int], left: int
) -> bool:
    used = Counter(taken)
    rest = 0
    for size in sizes:
        if counts[size] > used[size]:
            rest |= 1 << size
    sums = 1
    for size in taken:
        sums |= sums << size
    # Every sum, 0 too, and 1 to `left` more.
    larger, width = sums << 1, 1
    while width < left:
        step = min(width, left - width)
        larger |= larger << step
        width += step
    return left > 0 and larger & rest != 0


def fillings(sizes: list[int], room: int, waste: int, steps: int) -> list[tuple[int, ...]]:
    """Undominated sets of `sizes` that fill `room` but for at most `waste`, of the first `steps`.

    A set is dominated if a piece left out could take the place of one piece of it or of several
    and still fit: the exchange leaves smaller pieces over. The fullest come first.
    """
    counts = Counter(size for size in sizes if size <= room)
    ordered = sorted(counts, reverse=True)
    looked_at = islice(_sets(ordered, counts, room, waste), steps)
    return [f for f in looked_at if not _dominated(f, ordered, counts, room - sum(f))]


def bin_completion(lengths: list[int], capacity: int, nodes: int = 100) -> list[list[int]]:
    """Bins of lengths, by branch and bound around the largest length left.

    The first branch goes down to the last bin. `nodes`, and twice the number of bins, is how many
    fillings may be looked at.
    """
    lengths = sorted(lengths, reverse=True)
    best = best_fit(lengths, capacity)
    total = sum(lengths)
    if len(best) * capacity - total < capacity:
        return best
    least = least_bins(lengths, capacity)
    tries = nodes + 2 * len(best)
    left = Counter(lengths)
    sizes = sorted(left, reverse=True)
    # Largest piece, its filling, and the other fillings where they have been asked for.
    path: list[tuple[int, tuple[int, ...], Iterator[tuple[int, ...]] | None]] = []
    packed_, wasted = 0, 0

    def choices(largest: int) -> Iterator[tuple[int, ...]]:
        return _sets(others(largest), left, capacity - largest, slack())

    def others(largest: int) -> list[int]:
        return [size for size in sizes if size <= capacity - largest and left[size]]

    def slack() -> int:
        """What more may be wasted in a packing better than the best."""
        return (len(best) - 1) * capacity - total - wasted

    while len(best) > least and tries > 0:
        # Down to the last bin, or to where no better packing is possible.
        while packed_ < len(lengths) and slack() >= 0 and tries > 0:
            largest = next(size for size in sizes if left[size])
            left[largest] -= 1
            filling = next(choices(largest), None)
            if filling is None:
                left[largest] += 1
                break
            left.subtract(filling)
            path.append((largest, filling, None))
            packed_ += 1 + len(filling)
            wasted += capacity - largest - sum(filling)
            tries -= 1
        if packed_ == len(lengths) and len(path) < len(best):
            best = [[size, *filling] for size, filling, _ in path]
        # Up to the last bin that has another filling.
        while path and len(best) > least and tries > 0:
            largest, filling, more = path.pop()
            left.update(filling)
            packed_ -= 1 + len(filling)
            wasted -= capacity - largest - sum(filling)
            if more is None:
                more = choices(largest)
                next(more, None)
            smaller = others(largest)
            for filling in more:
                tries -= 1
                spare = capacity - largest - sum(filling)
                if spare > slack() or tries <= 0:
                    filling = None
                    break
                if not _dominated(filling, smaller, left, spare):
                    break
            else:
                filling = None
            if filling is None:
                left[largest] += 1
                continue
            left.subtract(filling)
            path.append((largest, filling, more))
            packed_ += 1 + len(filling)
            wasted += spare
            rest = [size for size in sizes for _ in range(left[size])]
            whole = [[size, *taken] for size, taken, _ in path] + best_fit(rest, capacity)
            if len(whole) < len(best):
                best = whole
            break
        else:
            break
    return best


def _solve(group: pd.DataFrame, capacity: int, nodes: int) -> pd.DataFrame:
    """Gives each piece of one group its bin, its place there and how full the bin is."""
    order = group.sort_values(
        ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]
    ).reset_index(drop=True)
    waiting: dict[int, list[int]] = {}
    for i, size in enumerate(order["length"].tolist()):
        waiting.setdefault(size, []).append(i)
    for rows in waiting.values():
        rows.reverse()
    bin_of, offset, fill = (np.zeros(len(order), np.int64) for _ in range(3))
    for number, sizes in enumerate(bin_completion(order["length"].tolist(), capacity, nodes)):
        at, full = 0, sum(sizes)
        for size in sizes:
            row = waiting[size].pop()
            bin_of[row], offset[row], fill[row] = number, at, full
            at += size
    return order.assign(bin=bin_of, offset=offset, fill=fill)


_PACKED = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, grp bigint,"
    " bin bigint, offset bigint, fill bigint"
)


def _by_group(pieces: DataFrame, groups: int, capacity: int, nodes: int) -> DataFrame:
    """`pieces` is a written table: a row's place in its file deals repeated rows apart."""
    dealt = F.xxhash64("doc_id", "piece", "ids_crc32", F.col("_metadata.row_index"))
    return (
        pieces.withColumn("grp", F.pmod(dealt, F.lit(groups)))
        .groupBy("grp")
        .applyInPandas(lambda group: _solve(group, capacity, nodes), _PACKED)
    )


def packed(
    pieces: DataFrame, capacity: int = 4096, group_size: int = 8192, nodes: int = 100
) -> DataFrame:
    """`pieces` of `tokenized` with sequence_id and offset."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = stage(pieces, "pieces")
    groups = -(-pieces.count() // group_size) or 1
    first = _by_group(pieces, groups, capacity, nodes)
    sequence = (F.col("grp") * (1 << 32) + F.col("bin")).alias("sequence_id")
    if groups > 1:
        first = stage(first, "packed")
        loose = F.col("fill") < 0.97 * capacity
        again = stage(first.where(loose).select(*names), "loose")
        more = -(-again.count() // group_size) or 1
        second = _by_group(again, more, capacity, nodes).withColumn("grp", -1 - F.col("grp"))
        first = first.where(~loose).unionByName(second)
    return first.select(*names, sequence, "offset")
