"""Secret scan: patterns find candidates, a random forest removes false positives.

Candidates are values assigned to credential names, tokens of known forms, private key blocks,
passwords in URLs, and runs of 16 token characters or more with a digit in them. None has a
greatest length; every pattern is linear in the text. The forest judges each from its length, its transitions between character classes, how much of it dictionary words
cover, whether it stands in a path, and the words next to it. It is trained on the driver from
labelled findings: `labelled_findings` makes a fixed number of them by rule from a seed, a caller
may hand over others. The dictionary is the whole words of a public tokenizer's vocabulary.

A scan is one pass over whole texts without a shuffle: rows in, rows with their findings out.
Places are code points. Overlapping candidates count once, the first pattern's before the others'.

Defined results: null and empty texts have no findings and stay as they are. Rows are judged one
by one, so repeated rows, null ids and other columns change nothing; columns named `findings` are
replaced. A run of more than 512 times one and the same digit is data, not a candidate. An empty
table gives an empty result.
"""

import json
import math
import random
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import fresh, worker_state

_NAMES = (
    r"pass(?:word|wd|phrase)?|pwd|secret(?:[_-]?key)?|(?:auth|access|refresh)?[_-]?token"
    r"|(?:api|access|private|account)[_-]?key|credentials?"
)
PATTERNS = [
    (
        "private_key",
        re.compile(
            r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}+"
            r"-----END [A-Z ]{0,30}PRIVATE KEY-----"
        ),
    ),
    (
        "known_form",
        re.compile(
            r"(?<![A-Za-z0-9_-])(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}+"
            r"|xox[abprs]-[A-Za-z0-9-]{10,}+|[sr]k_live_[A-Za-z0-9]{16,}+"
            r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+"
            r"\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9_-])"
        ),
    ),
    (
        "assigned",
        re.compile(
            rf"(?i)(?<![a-z0-9])(?:{_NAMES})[\"']?\s{{0,3}}(?::=|=>|=|:)\s{{0,3}}[\"']?"
            r"(?P<value>[^\s\"'<>;,(){}]{6,})"
        ),
    ),
    ("url", re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]++:(?P<value>[^\s:/@]{3,}+)@")),
    (
        "run",
        re.compile(
            r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+"
        ),
    ),
]
#: Every pattern needs one of these: the forms of the first two stand in `_STARTS`.
_HINT = re.compile(r"[0-9:=]")
_STARTS = (
    "-----BEGIN", "AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "k_live_", "AIza",
    "eyJ",
)
_CREDENTIAL_WORDS = frozenset(
    "password passwd passphrase pwd secret token key apikey api_key access_key auth bearer"
    " credential credentials login authorization private".split()
)
_HARMLESS_WORDS = frozenset(
    "example sample placeholder commit hash sha sha1 sha256 md5 checksum digest uuid id number"
    " order invoice card version isbn phone file path image figure chapter revision build".split()
)
_TEST_PATH = re.compile(r"(?i)test|example|sample|fixture|mock|doc")
_HEX = re.compile(r"(?i)[0-9a-f]+")
_WORD = re.compile(r"[\w-]+")
KINDS = [name for name, _ in PATTERNS]
FINDINGS = "array<struct<start:int,length:int,kind:string,score:double>>"


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the candidates of a text, in order, without overlap."""
    if not _HINT.search(text) and not any(start in text for start in _STARTS):
        return []
    found: list[tuple[int, int, str]] = []
    for kind, pattern in PATTERNS:
        group = "value" if "value" in pattern.groupindex else 0
        # Both lists are in order, so one step along `found` does for all matches of a pattern.
        new, at = [], 0
        for match in pattern.finditer(text):
            start, end = match.span(group)
            while at < len(found) and found[at][1] <= start:
                at += 1
            if at == len(found) or end <= found[at][0]:
                new.append((start, end, kind))
        found = sorted(found + new)
    return found


def dictionary(path: str | None) -> frozenset[str]:
    """Whole words of four letters or more of a tokenizer's vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    state = worker_state()
    if ("words", path) not in state:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        words = (w.removesuffix("</w>") for w in vocabulary if w.endswith("</w>"))
        state["words", path] = frozenset(w for w in words if len(w) > 3 and w.isalpha())
    return state["words", path]


def _coverage(value: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, the longest taken first."""
    lower, at, covered = value.lower(), 0, 0
    while at < len(lower) - 3:
        for size in range(min(14, len(lower) - at), 3, -1):
            if lower[at : at + size] in words:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / len(value)


def _classes(value: str) -> list[int]:
    return [
        0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in value
    ]


def features(
    text: str, start: int, end: int, kind: str, path: str, words: frozenset[str]
) -> list[float]:
    """What the forest sees of one candidate."""
    value = text[start:end]
    n = len(value)
    classes = _classes(value)
    counts = [classes.count(c) / n for c in range(4)]
    letters = [count / n for count in Counter(value).values()]
    before = _WORD.findall(text[max(0, start - 60) : start].lower())[-3:]
    after = _WORD.findall(text[end : end + 40].lower())[:2]
    near = [part for word in (*before, *after) for part in {word, *word.split("_")}]
    around = text[max(0, start - 1) : start] + value + text[end : end + 1]
    return [
        math.log(n),
        sum(a != b for a, b in zip(classes, classes[1:])) / max(1, n - 1),
        sum(a == b for a, b in zip(value, value[1:])) / max(1, n - 1),
        _coverage(value, words),
        -sum(p * math.log2(p) for p in letters),
        len(letters) / n,
        *counts,
        float(_HEX.fullmatch(value) is not None),
        float(around.count("/") + value.count(".") + around.count("\\")),
        float(value.count("-")) / n,
        float(_TEST_PATH.search(path) is not None),
        float(sum(w in _CREDENTIAL_WORDS for w in near)),
        float(sum(w in _HARMLESS_WORDS for w in near)),
        float(text[max(0, start - 2) : start].rstrip("\"' ")[-1:] in ("=", ":")),
        float(KINDS.index(kind)),
    ]


def labelled_findings(count: int = 3000, seed: int = 10) -> list[tuple[str, int]]:
    """Texts that hold one finding each, and whether it is a secret, made by rule."""
    draw = random.Random(seed)
    lower = "abcdefghijklmnopqrstuvwxyz"
    upper, digits = lower.upper(), "0123456789"
    syllables = [a + b for a in "bdfghklmnprst" for b in "aeiou"]

    def some(alphabet: str, least: int, most: int) -> str:
        return "".join(draw.choices(alphabet, k=draw.randint(least, most)))

    def word() -> str:
        return "".join(draw.choices(syllables, k=draw.randint(1, 4)))

    def prose() -> str:
        return " ".join(word() for _ in range(draw.randint(2, 6)))

    def name() -> str:
        return draw.choice(["password", "passwd", "secret", "token", "api_key", "auth_token"])

    def joint() -> str:
        return draw.choice(["=", ": ", " = ", ' = "', "='"])

    def size() -> int:
        """Of a long value: small sizes as often as large ones."""
        return round(math.exp(draw.uniform(math.log(80), math.log(6000))))

    def long(alphabet: str) -> str:
        n = size()
        return some(alphabet, n, n)

    def words(joint: str, last: str) -> str:
        return joint.join(word() for _ in range(size() // 6)) + joint + last

    mixed = lower + upper + digits
    secrets = [
        lambda: draw.choice(["AKIA", "ASIA"]) + some(upper + digits, 16, 16),
        lambda: draw.choice(["ghp_", "gho_"]) + some(mixed, 36, 40),
        lambda: "xoxb-" + some(digits, 10, 12) + "-" + some(mixed, 20, 28),
        lambda: "sk_live_" + some(mixed, 20, 32),
        lambda: "AIza" + some(mixed + "_-", 35, 35),
        lambda: name() + joint() + some("0123456789abcdef", 16, 64),
        lambda: name() + joint() + some(mixed + "!#%&*+", 8, 40),
        lambda: name() + joint() + some(mixed + "+/", 20, 64),
        lambda: "authorization bearer " + some(mixed + "_-", 24, 60) + some(digits, 1, 1),
        lambda: f"https://{word()}:{some(mixed, 8, 24)}@{word()}.example.org",
        lambda: "-----BEGIN PRIVATE KEY-----\n" + some(mixed + "+/", 64, 400)
        + "\n-----END PRIVATE KEY-----",
        lambda: name() + joint() + long(draw.choice([mixed + "+/", mixed + "_-", mixed])),
        lambda: long(draw.choice([mixed + "+/", mixed + "_-", mixed])) + some(digits, 1, 1),
        lambda: f"https://{word()}:{long(mixed)}@{word()}.example.org",
        lambda: "-----BEGIN PRIVATE KEY-----\n" + long(mixed + "+/") + "\n-----END PRIVATE KEY-----",
    ]
    placeholders = [
        "changeme", "your_password", "example123", "xxxxxxxx", "********", "<none>", "${SECRET}",
        "os.environ", "required", "optional",
    ]
    others = [
        lambda: name() + joint() + draw.choice(placeholders),
        lambda: name() + ": " + word() + word() + word(),
        lambda: draw.choice(["commit", "sha1", "checksum", "revision"]) + " " + some("0123456789abcdef", 40, 40),
        lambda: draw.choice(["sha256", "digest", "hash"]) + ": " + some("0123456789abcdef", 64, 64),
        lambda: draw.choice(["id", "uuid", word()]) + " " + "-".join(some("0123456789abcdef", k, k) for k in (8, 4, 4, 4, 12)),
        lambda: some(digits, 16, 20),
        lambda: draw.choice(["card", "order", "invoice", word()]) + " " + some(digits, 16, 16),
        lambda: "/".join(word() for _ in range(4)) + "/" + word() + some(digits, 1, 4),
        lambda: "-".join(word() for _ in range(5)) + "-" + some(digits, 1, 4),
        lambda: "_".join(word() for _ in range(4)) + some(digits, 1, 3),
        lambda: word() + word() + word() + word() + word() + some(digits, 1, 2) + word(),
        lambda: "-" * draw.randint(8, 20) + some(digits, 1, 2) + "=" * draw.randint(8, 20),
        lambda: some("01", 20, 80),
        lambda: "A" * draw.randint(16, 40) + some(digits, 1, 2),
        lambda: f"http://{word()}:{draw.choice(['port', 'user', 'pass'])}@{word()}.example.org",
        lambda: "2024-" + some("01", 2, 2) + "-" + some("012", 2, 2) + "T" + some("012", 6, 6) + "-" + some(digits, 4, 4),
        lambda: long(draw.choice([digits, "01"])),
        lambda: words(draw.choice("/-_="), some(digits, 1, 4)),
        lambda: words("", some(digits, 1, 2)),
        lambda: some(draw.choice(["-", "=", "ACGT", "ab"]), 1, 1) * size() + some(digits, 1, 2),
        lambda: some("ACGT", 1, 1) + long("ACGT") + some(digits, 1, 2),
        lambda: some(mixed, 2, 12) * (size() // 6) + some(digits, 1, 2),
        lambda: f"{name()}{joint()}" + words("-", word()),
        lambda: some(digits, 1, 1) * size(),
    ]
    made = []
    for i in range(count):
        maker = draw.choice(secrets if i % 2 else others)
        made.append((f"{prose()} {maker()} {prose()}", i % 2))
    return made


def with_paths(findings: list[tuple[str, int]], seed: int = 11) -> list[tuple[str, str, int]]:
    """Made findings (text, path, label): false ones stand more often below a test path."""
    draw = random.Random(seed)
    plain, tests = ("src/main", "app/config", "web", "notes"), ("tests/unit", "examples", "mocks/a")
    return [
        (text, draw.choice(tests if draw.random() < (0.1 if label else 0.3) else plain), label)
        for text, label in findings
    ]


class Forest:
    """A random forest of binary trees on numpy columns, as plain arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 9) -> None:
        draw = np.random.default_rng(10)
        self.trees = []
        for _ in range(trees):
            rows = draw.integers(0, len(x), len(x))
            nodes: list[tuple[int, float, int, int, float]] = []
            self._grow(x[rows], y[rows], depth, draw, nodes)
            self.trees.append([np.array(column) for column in zip(*nodes)])

    def _grow(self, x, y, depth, draw, nodes) -> int:
        own = len(nodes)
        nodes.append((-1, 0.0, -1, -1, float(y.mean())))
        if depth == 0 or len(y) < 6 or y.min() == y.max():
            return own
        best = (0.0, -1, 0.0)
        total, n = y.sum(), len(y)
        whole = total * (n - total) / n
        for feature in draw.choice(x.shape[1], int(math.sqrt(x.shape[1])) + 1, replace=False):
            order = np.argsort(x[:, feature], kind="stable")
            values, hits = x[order, feature], np.cumsum(y[order])[:-1]
            left = np.arange(1, n)
            right, rest = n - left, total - hits
            impurity = hits * (left - hits) / left + rest * (right - rest) / right
            gain = np.where(values[1:] > values[:-1], whole - impurity, -1.0)
            at = int(gain.argmax())
            if gain[at] > best[0] + 1e-12:
                best = (float(gain[at]), int(feature), float((values[at] + values[at + 1]) / 2))
        if best[1] < 0:
            return own
        low = x[:, best[1]] <= best[2]
        left_node = self._grow(x[low], y[low], depth - 1, draw, nodes)
        right_node = self._grow(x[~low], y[~low], depth - 1, draw, nodes)
        nodes[own] = (best[1], best[2], left_node, right_node, nodes[own][4])
        return own

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of secrets, averaged over the trees."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, limit, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                low = x[rows, feature[at]] <= limit[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += value[at]
        return total / len(self.trees)


def train(
    findings: list[tuple] | None = None, words_path: str | None = None
) -> Forest:
    """A forest from labelled findings: (text, path, label) or (text, label), the label for all
    candidates of the text."""
    words = dictionary(words_path)
    x, y = [], []
    for text, *path, label in with_paths(labelled_findings()) if findings is None else findings:
        for start, end, kind in candidates(text):
            x.append(features(text, start, end, kind, path[0] if path else "", words))
            y.append(label)
    return Forest(np.array(x), np.array(y, float))


def _judge(forest: Forest | None, words_path: str | None) -> Callable[[pa.Array, pa.Array], list]:
    """A function for tasks: the findings of each text of a batch, from texts and paths."""
    trees = (forest or train(words_path=words_path)).trees

    def judged(texts: pa.Array, paths: pa.Array) -> list[list[dict]]:
        words = dictionary(words_path)
        judge = Forest.__new__(Forest)
        judge.trees = trees
        places, x = [], []
        for i, (text, path) in enumerate(zip(texts, paths)):
            text, path = text.as_py() or "", path.as_py() or ""
            for start, end, kind in candidates(text):
                places.append((i, start, end, kind))
                x.append(features(text, start, end, kind, path, words))
        held: list[list[dict]] = [[] for _ in range(len(texts))]
        scores = judge.predict(np.array(x)).tolist() if x else []
        for (i, start, end, kind), score in zip(places, scores):
            held[i].append({"start": start, "length": end - start, "kind": kind, "score": score})
        return held

    return judged


def _path(path_col: str | None) -> Column:
    return F.col(path_col).cast("string") if path_col else F.lit("")


def scanned(
    docs: DataFrame,
    forest: Forest | None = None,
    text_col: str = "text",
    path_col: str | None = "source",
    words_path: str | None = None,
    name: str = "findings",
) -> DataFrame:
    """`docs` with a column `name`: start, length, kind and score of every candidate."""
    judged = _judge(forest, words_path)

    @F.arrow_udf(FINDINGS)
    def run(texts: pa.Array, paths: pa.Array) -> pa.Array:
        kind_ = pa.struct(
            [("start", pa.int32()), ("length", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]
        )
        return pa.array(judged(texts, paths), pa.list_(kind_))

    return docs.withColumn(name, run(F.col(text_col).cast("string"), _path(path_col)))


def findings(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, start, length, kind, score and is_secret of every candidate."""
    own = fresh("findings", docs)
    return (
        scanned(docs, name=own)
        .select("doc_id", F.explode(own).alias("f"))
        .select("doc_id", "f.*", (F.col("f.score") >= threshold).alias("is_secret"))
    )


def redacted(docs: DataFrame, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark`, and n_chars after that.

    Scan and cut are one function: two would hold two Python workers per task, all with their
    words and batches, which stay in an executor's memory after the last task.
    """
    own = fresh("redacted", docs)
    judged = _judge(None, None)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, paths: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, judged(texts, paths)):
            found = [f for f in found if f["score"] >= threshold]
            if not found:
                out.append(None)
                continue
            text, parts, place = text.as_py(), [], 0
            for f in found:
                parts += [text[place : f["start"]], mark]
                place = f["start"] + f["length"]
            out.append("".join([*parts, text[place:]]))
        return pa.array(out, pa.string())

    # The cut is linear in a text with any number of secrets; texts without any stay in the JVM.
    text = F.col("text").cast("string")
    new = F.coalesce(F.col(own), text)
    chars = F.coalesce(F.char_length(own).cast("bigint"), F.col("n_chars"))
    found = docs.withColumn(own, cut(text, _path("source")))
    return found.withColumns({"text": new, "n_chars": chars}).select(*docs.columns)
