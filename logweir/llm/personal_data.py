"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds the anchors: at-signs, plus signs, digits,
schemes and identifier cues (account words in several languages). A local parser at each anchor
expands to both sides, or to the right of a cue, and validates what it finds. Every parser is
deterministic and reads a stretch of text once, so the work is linear in the text, however long.

Kinds and what is found for them. *Base* spans are the leftmost, non-overlapping matches of four
plain patterns; the others are added by the parsers and never touch a span that is there already.

| kind | base | added |
|---|---|---|
| email | local part, at-sign, domain of two or more labels | the address after `mailto:` or `sip:` whose domain has one label |
| ip | four parts of digits, each at most 255 | IPv6 in brackets behind a scheme |
| card | 13 to 19 digits with single blanks or hyphens that pass Luhn | a card of its own within a longer row of digits |
| phone | plus sign, 9 to 15 digits | number after `tel:` or a phone word; `(ddd) ddd-dddd` |
| account | | IBAN by its check digits; number after an account word; social security number |
| url | | `scheme://user@host` or `scheme://user:password@host` |

Defined results: a null text is empty and gives no span; rows are kept as they are, also with null
or repeated ids; other columns are not read. An empty table gives an empty result. Offsets count
code points, ends are exclusive. Executors need the `ahocorasick` module.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "account", "url")
BASE_KINDS = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_PARTS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_ROW = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"\+?[0-9(][0-9 ()./-]*[0-9]")
_NATIONAL = re.compile(r"\([2-9][0-9]{2}\) ?[2-9][0-9]{2}-[0-9]{4}(?![0-9-])")
_SOCIAL = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# 34 letters and digits are the longest that the standard knows.
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
_NUMBER = re.compile(r"[0-9](?:[ ./-]?[0-9])*")
_USERINFO = re.compile(r"[^\s/?#@<>\"']+@(?:\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9.-]+)(?::[0-9]+)?")
_BRACKETED = re.compile(r"\[([0-9A-Fa-f:.]+)\]")
_GAP = re.compile(r"[ \t]{0,3}(?:no|nr|number|nummer|is|ist)?[ \t]{0,3}[.:#=]?[ \t]{0,3}", re.IGNORECASE)

#: Words that announce an identifier, and the parser they call.
CUES = {
    "iban": "iban", "account": "number", "acct": "number", "konto": "number",
    "kontonummer": "number", "compte": "number", "cuenta": "number", "ssn": "social",
    "social security": "social", "phone": "phone", "tel": "phone", "telefon": "phone",
    "teléfono": "phone", "téléphone": "phone", "mobile": "phone", "fax": "phone",
}
SCHEMES = {"mailto:": "address", "sip:": "address", "sips:": "address", "tel:": "phone",
           "callto:": "phone", "://": "userinfo"}

Span = tuple[str, int, int, bool]


def automaton():
    """All anchors: their length and the parser that they call."""
    import ahocorasick

    anchors = {"@": "at", "+": "plus", "(": "bracket"} | {d: "digit" for d in "0123456789"}
    for words in (CUES, SCHEMES):
        for word, parser in words.items():
            for form in {word, word.upper(), word.capitalize(), word.title()}:
                # `tel` is a cue and the head of a scheme.
                anchors[form] = parser if words is CUES else f"{parser}:"
    found = ahocorasick.Automaton()
    for word, parser in anchors.items():
        found.add_word(word, (len(word), parser))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def small_part(part: str) -> bool:
    """Whether digits, of any number, make 255 at most."""
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def iban_length(packed: str) -> int:
    """Length of the longest head that is an IBAN by its check digits; 0 if there is none."""
    values = [str(int(c, 36)) for c in packed]
    head = "".join(values[:4])
    for n in range(min(len(packed), 34), 14, -1):
        if int("".join(values[4:n]) + head) % 97 == 1:
            return n
    return 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


class _Text:
    """The spans of one text; each parser is called with the place of its anchor."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.base: list[Span] = []
        self.more: list[Span] = []
        self.email_end = self.ip_end = self.row_end = self.url_end = 0

    # ---- Base kinds ----

    def at(self, p: int, after: int) -> None:
        start = p
        while start > self.email_end and self.text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(self.text, after) if start < p else None
        if domain:
            self.email_end = domain.end()
            self.base.append(("email", start, domain.end(), True))

    def digit(self, p: int, after: int) -> None:
        if p >= self.ip_end:
            chain = _PARTS.match(self.text, p)
            self.ip_end = chain.end()
            parts = list(re.finditer("[0-9]+", chain.group()))
            for i in range(0, len(parts) - 3, 4):
                if all(small_part(part.group()) for part in parts[i : i + 4]):
                    self.base.append(("ip", p + parts[i].start(), p + parts[i + 3].end(), True))
        if p >= self.row_end:
            row = _ROW.match(self.text, p)
            self.row_end = row.end()
            digits = _digits(row.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                self.base.append(("card", p, row.end(), True))
            elif len(digits) > 13:
                self._cards_within(p, row.group())
            social = _SOCIAL.match(self.text, p)
            if social and (p == 0 or self.text[p - 1] not in "-0123456789"):
                self._social(social)

    def plus(self, p: int, after: int) -> None:
        number = _PHONE.match(self.text, p)
        if number and 9 <= len(_digits(number.group())) <= 15:
            self.base.append(("phone", p, number.end(), True))

    # ---- Added by the method ----

    def _cards_within(self, p: int, row: str) -> None:
        """Groups between blanks that are a card each, whole or as four groups of four."""
        groups = [(p + g.start(), p + g.end()) for g in re.finditer("[0-9]+", row)]
        sizes = [end - start for start, end in groups]
        i = 0
        while i < len(groups):
            for n in (1, 4):
                whole = sizes[i] in range(13, 20) if n == 1 else sizes[i : i + 4] == [4] * 4
                if whole:
                    start, end = groups[i][0], groups[i + n - 1][1]
                    digits = _digits(self.text[start:end])
                    if luhn(digits) and digits[0] in "23456":
                        self.more.append(("card", start, end, False))
                        i += n - 1
                        break
            i += 1

    def bracket(self, p: int, after: int) -> None:
        number = _NATIONAL.match(self.text, p)
        if number:
            self.more.append(("phone", p, number.end(), False))

    def _social(self, found: re.Match) -> None:
        area, group, serial = found.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            self.more.append(("account", found.start(), found.end(), False))

    def _value(self, p: int, after: int) -> int | None:
        """Where the value of a cue begins; None unless the cue is a word of its own."""
        if p and (self.text[p - 1].isalnum() or self.text[p - 1] == "_"):
            return None
        if self.text[after : after + 1].isalpha() or self.text[after : after + 1] == "_":
            return None
        return _GAP.match(self.text, after).end()

    def iban(self, p: int, after: int) -> None:
        value = self._value(p, after)
        found = value is not None and _IBAN.match(self.text, value)
        if not found:
            return
        # The parser may have run into the words behind.
        places = [i for i, c in enumerate(found.group()) if c != " "]
        n = iban_length(found.group().replace(" ", ""))
        if n:
            end = found.start() + places[n - 1] + 1
            self.more.append(("account", found.start(), end, False))

    def number(self, p: int, after: int) -> None:
        value = self._value(p, after)
        found = value is not None and _NUMBER.match(self.text, value)
        if found and 6 <= len(_digits(found.group())) <= 20:
            self.more.append(("account", found.start(), found.end(), False))

    def social(self, p: int, after: int) -> None:
        value = self._value(p, after)
        found = value is not None and _NUMBER.match(self.text, value)
        if found and len(_digits(found.group())) == 9:
            self.more.append(("account", found.start(), found.end(), False))

    def phone(self, p: int, after: int) -> None:
        value = self._value(p, after)
        if value is not None:
            self._phone_at(value)

    def _phone_at(self, value: int) -> None:
        found = _LOCAL_PHONE.match(self.text, value)
        if found and 7 <= len(_digits(found.group())) <= 15:
            self.more.append(("phone", found.start(), found.end(), False))

    def scheme(self, parser: str, p: int, after: int) -> None:
        if parser == "phone":
            self._phone_at(after)
        elif parser == "address":
            found = _ADDRESS.match(self.text, after)
            if found:
                self.more.append(("email", found.start(), found.end(), False))
        elif after >= self.url_end:
            start = p
            while start > self.url_end and self.text[start - 1] in _LOCAL:
                start -= 1
            found = _USERINFO.match(self.text, after)
            if found and start < p:
                self.more.append(("url", start, found.end(), False))
            v6 = _BRACKETED.match(self.text, after)
            if v6 and v6.group(1).count(":") >= 2:
                self.more.append(("ip", v6.start(1), v6.end(1), False))
            self.url_end = found.end() if found else after


def find_spans(text: str, anchors) -> list[Span]:
    """(kind, start, end, base) of a text, by kind and start."""
    found = _Text(text)
    for last, (length, parser) in anchors.iter(text):
        p, after = last + 1 - length, last + 1
        if parser.endswith(":"):
            found.scheme(parser[:-1], p, after)
        else:
            getattr(found, parser)(p, after)
    order = {kind: i for i, kind in enumerate(KINDS)}
    # Where added spans meet, the one further to the left or else the longer one stays.
    merged: list[Span] = []
    for span in sorted(found.base + found.more, key=lambda s: (order[s[0]], s[1], not s[3], -s[2])):
        while (
            merged and merged[-1][0] == span[0] and merged[-1][2] > span[1]
            and span[3] and not merged[-1][3]
        ):
            merged.pop()
        if not merged or merged[-1][0] != span[0] or merged[-1][2] <= span[1]:
            merged.append(span)
    return merged


_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id` and `found`, an array of (kind, start, end, base)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "base"), span)) for span in spans]
                for spans in (
                    find_spans(text.as_py() or "", anchors) for text in batch.column("text")
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(_SPAN))], ["doc_id", "found"]
            )

    return rows.mapInArrow(
        run,
        f"doc_id {id_type}, "
        "found array<struct<kind:string,start:bigint,end:bigint,base:boolean>>",
    )


def span_text(spans) -> F.col:
    """`kind:start:end` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def span_digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def masked(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` rows of unique, non-null `doc_id` with every span of `found` replaced by its kind."""
    def mask(texts, spans):
        import pandas as pd

        out = []
        for text, found_ in zip(texts, spans):
            parts, place = [], 0
            ordered = sorted((s["start"], s["end"], s["kind"]) for s in found_) if found_ is not None else []
            for start, end, kind in ordered:
                if start >= place:
                    parts += [text[place:start], f"[{kind.upper()}]"]
                place = max(place, end)
            out.append(None if text is None else "".join(parts) + text[place:])
        return pd.Series(out)

    name = "__spans"
    while name in docs.columns:
        name += "_"
    joined = docs.join(found.select("doc_id", F.col("found").alias(name)), "doc_id", "left")
    masked_text = F.pandas_udf(mask, "string")(F.col(text_col), F.col(name))
    return joined.withColumn(text_col, masked_text).select(*docs.columns)


def digest_of(spans: list[Span]) -> str:
    """`base_sha256` of one text's spans."""
    text = ",".join(f"{kind}:{start}:{end}" for kind, start, end, base in spans if base)
    return hashlib.sha256(text.encode()).hexdigest()
