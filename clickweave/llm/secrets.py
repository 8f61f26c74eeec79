"""Secret scans by assignment-aware lexing.

Three patterns give the base spans (assignments to a sensitive word, access
keys, long hexadecimal runs).  The lexer adds ``literal`` spans: a text is cut
into names, strings, operators and ends; names and the values given to them
become pairs (``name = "v"``, ``name: v``, ``"name": "v"``, ``x["name"] = v``,
``name: type = v``, ``--name v``, ``set_name("v")``, ``put("name", "v")``,
``<name>v</name>``, values joined by + or written side by side).  A value that
is a name stands for everything the text assigns to that name, through any
number of steps.  Each literal reached from a name is scored: the weight of
the most sensitive word of the name, times the strength of the (joined)
literal by length, entropy and kinds of characters; from ``THRESHOLD`` on it
is a span, unless a base span covers it.  Texts are independent of each other,
so one pass over the rows without a shuffle does; lexing is linear in the
text, and texts without any sensitive stem skip it (they cannot score).

Defined results: one row per input row, repeated rows, null ids and ties
included; a null text counts as empty; empty texts have no spans (the hash of
the empty string, an empty list); spans are in code points of the whole text,
end exclusive, by start, then kind in the order of ``KINDS``; an unterminated
string is no string; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import batch, prepare, text_or_empty

KINDS = ("assign", "access", "hex", "literal")
LEAST = {"assign": 6, "access": 20, "hex": 24}
THRESHOLD = 0.5

#: Fixed patterns of the base scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")

#: Sensitive words of names, and pairs of neighbouring words, with their weights.
WORDS = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 1.0, "pass": 0.9, "secret": 1.0, "apikey": 1.0,
         "token": 0.9, "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "salt": 0.7,
         "cookie": 0.6, "signature": 0.6, "pin": 0.6, "private": 0.6}
PAIRS = {("api", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("access", "key"): 0.9, ("encryption", "key"): 0.9,
         ("signing", "key"): 0.9, ("auth", "key"): 0.9, ("client", "key"): 0.8, ("account", "key"): 0.8, ("master", "key"): 0.9}
#: Last words that make a name speak about a secret instead of holding one.
ABOUT = {"name", "names", "id", "path", "file", "url", "uri", "length", "len", "size", "count", "type", "field", "label", "hint", "ttl",
         "expiry", "expires", "timeout", "regex", "pattern", "prompt", "policy", "min", "max", "limit", "enabled", "required", "index"}
#: Literals that stand for a secret to be filled in.
PLACEHOLDER = re.compile(r"(?i)(.)\1*|<.*>|\$\{.*|\$\(.*|\{\{.*|%\w|your[-_ ].*|change[-_ ]?me|example.*|placeholder|redacted|undefined|"
                         r"none|null|true|false|password|secret|\*+", re.DOTALL)
STEM = re.compile("|".join(sorted({w[:4] for w in WORDS} | {"key"})), re.ASCII | re.IGNORECASE)

TOKEN = re.compile(r'''
  (?P<string>"""(?:[^"\\]|\\[\s\S]|"(?!""))*+"""|"(?:[^"\\\n]|\\.)*+"|(?<![\w'])\'(?:[^'\\\n]|\\.)*+\'|`[^`\n]*+`)
 |(?P<escape>\\.)
 |(?P<tag><[A-Za-z_][\w.:-]*+>[^<>\n]++</)
 |(?P<name>(?:--)?[A-Za-z_$][\w$]*+(?:[.-][A-Za-z_$][\w$]*+)*+)
 |(?P<other>[=!<>]=+|::+|[0-9][^\s"'`,;:=(){}\[\]]*+)
 |(?P<assign>:=|=>|=|:)
 |(?P<join>\+|\|\||\?\?)
 |(?P<end>[\n;,(){}\[\]])
 |(?P<rest>[^\s])''', re.VERBOSE | re.ASCII)
BARE = re.compile(r"""[^\s"'`,;:=(){}\[\]<>]+={0,2}""")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PREFIXES = {"r", "b", "f", "u", "rb", "br", "fr", "rf"}
_SCHEMES = {"bearer", "basic", "digest"}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns: leftmost matches of each, those that are too short dropped."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return found


def sensitivity(name: str) -> float:
    """Weight of the most sensitive word or pair of words; 0 where the name is about a secret."""
    words = [w.lower() for w in _WORD.findall(name)]
    if not words or words[-1] in ABOUT:
        return 0.0
    weights = [WORDS.get(w, 0.0) for w in words] + [PAIRS.get(p, 0.0) for p in zip(words, words[1:], strict=False)]
    return max(weights)


def strength(value: str, quoted: bool) -> float:
    """From 0 to 1, by length, entropy and kinds of characters."""
    if len(value) < 6 or PLACEHOLDER.fullmatch(value):
        return 0.0
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9\s]"))
    sure = min(1.0, bits / 3.5) * min(1.0, 0.55 + 0.15 * kinds)
    if re.search(r"\s", value):
        sure *= 0.6
    return sure if quoted or (kinds > 1 and re.search("[0-9]", value)) else sure * 0.4


class Lexer:
    """Name-literal pairs of one text: ``pairs`` has (name, literal spans, whether quoted, names the value stands for)."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [(m.lastgroup, m.start(), m.end()) for m in TOKEN.finditer(text)]
        self.pairs: list[tuple[str, list[tuple[int, int]], bool, list[str]]] = []
        for i, (kind, start, end) in enumerate(self.tokens):
            if kind == "tag":
                close = text.index(">", start)
                self.pairs.append((text[start + 1:close], [(close + 1, end - 2)], False, []))
            elif kind in ("name", "string"):
                at = self._value(i, kind, start, end)
                if at is not None:
                    name = text[start:end] if kind == "name" else text[slice(*self._inside(start, end))]
                    literals, quoted, names = self._operands(at)
                    if literals or names:
                        self.pairs.append((name, literals, quoted, names))

    def _is(self, i: int, kind: str, text: str | None = None) -> bool:
        if i >= len(self.tokens) or self.tokens[i][0] != kind:
            return False
        return text is None or self.text[self.tokens[i][1]:self.tokens[i][2]] == text

    def _inside(self, start: int, end: int) -> tuple[int, int]:
        quote = 3 if end - start >= 6 and self.text.startswith('"""', start) else 1
        return start + quote, end - quote

    def _value(self, i: int, kind: str, start: int, end: int) -> int | None:
        """The token at which the value given to name token i begins."""
        j = i + 1
        if kind == "string" and self._is(j, "end", "]"):
            j += 1
        if self._is(j, "assign"):
            if self._is(j, "assign", ":") and self._is(j + 1, "name") and self._is(j + 2, "assign", "="):
                return j + 3  # name: type = value
            return j + 1
        if kind == "name":
            if self._is(j, "end", "(") and self._is(j + 1, "string"):
                return j + 1  # set_name("value")
            if self.text.startswith("--", start) and j < len(self.tokens) and self.text[end:self.tokens[j][1]].strip(" ") == "" < self.text[end:self.tokens[j][1]]:
                return j  # --name value
        elif self._is(j, "end", ",") and self._is(j + 1, "string"):
            return j + 1  # put("name", "value")
        return None

    def _operands(self, i: int) -> tuple[list[tuple[int, int]], bool, list[str]]:
        literals: list[tuple[int, int]] = []
        names: list[str] = []
        quoted = False
        while i < len(self.tokens):
            kind, start, end = self.tokens[i]
            if kind == "name" and self._is(i + 1, "string") and self.tokens[i + 1][1] == end and self.text[start:end].lower() in _PREFIXES:
                i += 1
                continue
            if kind == "string":
                literals.append(self._inside(start, end))
                quoted = True
            elif kind in ("end", "assign", "tag") or (kind == "rest" and self.text[start] in "\"'`"):
                break
            else:
                bare = BARE.match(self.text, start)
                if kind == "name" and self.text[start:end].lower() in _SCHEMES and not self._is(i + 1, "end"):
                    i += 1
                    continue
                if kind == "name":
                    names.append(self.text[start:end])
                if bare and not quoted:
                    literals.append(bare.span())
                while i + 1 < len(self.tokens) and bare and self.tokens[i + 1][1] < bare.end():
                    i += 1
            if self._is(i + 1, "join"):
                i += 2
            elif kind == "string" and self._is(i + 1, "string"):
                i += 1
            else:
                break
        if quoted:  # names beside strings stand for constants, not for themselves
            literals = [s for s in literals if s[0] > 0 and self.text[s[0] - 1] in "\"'`"]
        return literals, quoted, names


def literal_spans(text: str) -> set[tuple[int, int]]:
    """Literals that flow into a sensitive name, with enough strength."""
    if not STEM.search(text):
        return set()
    pairs = Lexer(text).pairs
    given: dict[str, list[int]] = {}
    for k, (name, *_) in enumerate(pairs):
        given.setdefault(name.lstrip("-"), []).append(k)
    found: set[tuple[int, int]] = set()
    passed: set[int] = set()
    followed: set[str] = set()
    weighed = [(sensitivity(pair[0]), k) for k, pair in enumerate(pairs)]
    for weight, k in sorted(((w, k) for w, k in weighed if w > 0), reverse=True):
        open_pairs = [k]
        while open_pairs:  # a pair and a name are passed once, with the largest weight that reaches them
            k = open_pairs.pop()
            if k in passed:
                continue
            passed.add(k)
            _, literals, quoted, names = pairs[k]
            constants = [n for n in names if n in given]
            if literals and (quoted or not constants) and weight * strength("".join(text[a:b] for a, b in literals), quoted) >= THRESHOLD:
                found.update(s for s in literals if s[0] < s[1])
            for n in constants:
                if n not in followed:
                    followed.add(n)
                    open_pairs += given[n]
    return found


def scan_text(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans, in order."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=order)
    covers, reach = [], -1  # base spans that reach further than all before, for the test of cover
    for s in base:
        if s[1] > reach:
            covers.append(s)
            reach = s[1]
    added, at = [], 0
    for a, b in sorted(literal_spans(text)):
        while at < len(covers) and covers[at][1] < b:
            at += 1
        if not (at < len(covers) and covers[at][0] <= a and b <= covers[at][1]):
            added.append((a, b, "literal"))
    return base, sorted(base + added, key=order)


def written_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS[:3]], ("base_sha256", pa.string()), ("spans", pa.string())])
    for b in batches:
        out = []
        for name, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            base, spans = scan_text(text)
            counts = Counter(k for *_, k in base)
            out.append((name, *(counts[k] for k in KINDS[:3]), hashlib.sha256(written_spans(base).encode()).hexdigest(), written_spans(spans)))
        if out:
            yield batch(schema, [list(c) for c in zip(*out, strict=True)])


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` (all spans as ``kind:start:end``, comma-joined)."""
    prepare(documents.sparkSession)
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_scan, _OUT)
