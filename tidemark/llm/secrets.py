"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens.

The patterns find assignments, access keys and long hexadecimal strings. The field tags each token as
outside, begin or inside of a secret by its shape, length, characters and prefix, the tokens around it and
features of the whole file. It adds the spans that Viterbi decoding finds where no pattern matched.

There are no labelled secrets, so the field is trained here on lines of the corpus: at most ``sample_lines`` lines with a
pattern match, in half of them the keyword replaced by a name that no pattern knows, and at most twice as many lines of
any kind, one of a text. Into half of the latter a secret made up by a rule is written, with such a name or without one, and into
all of them things that look alike and are none (numbers, dates, names of files, hosts and variables). Lines and what is written into
them depend only on hashes, so a field of the same corpus is the same.

Decoding is exact and skips what cannot matter: a token whose best other label loses against "outside"
by more than any pair of transitions could win back is outside in every best path, so Viterbi runs only on the short
runs between such tokens. Scores are summed from a table by token, so common tokens are computed once.

Edge cases: NULL and empty texts have no span; matches of different kinds may overlap and all stay; added spans
never overlap them; repeated rows give repeated results; without any line to learn from only
the patterns apply; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LINE = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}|[0-9a-f]{32}|AKIA[A-Z0-9]{12}"
KINDS = ("assign", "access", "hex", "field")

_TOKEN = re.compile(r"[\w+/.-]+|[^\w\s]")
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
Span = tuple[int, int, int]  # start, kind, end


def pattern_spans(text: str, whole: bool = False) -> list[Span]:
    """Spans of the three patterns by start, then kind. An assignment's span is its value, or with ``whole`` all that matched."""
    spans: list[Span] = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        first = 0 if whole else 2
        spans += [(m.start(first), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- features -------------------------------------------------------------------------------------

SLOTS = 1 << 16
ROLES = ("own", "before", "before2", "behind")


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


Signature = tuple[str, int, str, bool, int]
_OUTLINE = str.maketrans(
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "a" * 26 + "A" * 26 + "9" * 10
)
_LENGTHS = [0, *(min(int(math.log2(n) * 2), 14) for n in range(1, 129))]


def outline(token: str) -> str:
    """The token with one letter for all small letters, one for all capitals and one for all digits of ASCII."""
    return token.translate(_OUTLINE)


def hexadecimal(token: str) -> bool:
    return not token.strip("0123456789abcdef") or not token.strip("0123456789ABCDEF")


def signature(outline: str, hexadecimal: bool) -> Signature:
    """Kinds of characters, length, shape, whether hexadecimal, changes between digits and others."""
    length = _LENGTHS[min(len(outline), 128)]
    if outline.isalpha():
        kind = "a" if outline.islower() else "A" if outline.isupper() else "Aa" if outline.istitle() else "aA"
        return kind if outline.isascii() else kind + "u", length, kind, hexadecimal, 0
    special = any(c in outline for c in "+/_.-")
    found = ("a" in outline, "A" in outline, "9" in outline, not outline.isascii(), special)
    kinds = "".join(k for k, there in zip("aA9us", found, strict=True) if there)
    shape = re.sub(r"(.)\1+", r"\1+", outline)[:8]
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(outline, outline[1:], strict=False))
    return kinds, length, shape, hexadecimal, min(turns, 6)


def _shape_features(found: Signature) -> list[str]:
    kinds, length, shape, hexadecimal, turns = found
    return [f"k{kinds}", f"l{length}", f"k{kinds}l{length}", f"s{shape}", f"h{hexadecimal}", f"t{turns}"]


def token_features(token: str) -> list[str]:
    """What is known of one token by itself."""
    return [*_shape_features(signature(outline(token), hexadecimal(token))), f"p{token[:4].lower()}", f"w{token.lower()}"]


def file_features(tokens: list[str]) -> list[str]:
    """What is known of the whole text."""
    n = len(tokens) or 1
    equals = min(int(1000 * (tokens.count("=") + tokens.count(":")) / n), 3)
    return [f"file=:{equals}", f"file#{min(int(math.log10(n)), 5)}"]


@dataclass
class Field:
    """Weights by feature slot and label, weights between labels, and the words and prefixes seen in training."""

    weights: np.ndarray
    between: np.ndarray
    seen: frozenset[str] = frozenset()

    def of_feature(self, name: str) -> np.ndarray:
        """Scores that a feature gives to its token and the neighbours: (roles, labels)."""
        return self.weights[[_slot(f"{role}|{name}") for role in ROLES]]

    def of_file(self, tokens: list[str]) -> np.ndarray:
        return self.weights[[_slot(f) for f in file_features(tokens)]].sum(axis=0)

    def slack(self) -> float:
        """The most that two transitions can win by leaving "outside"."""
        t = self.between
        return max(
            t[a, y] - t[a, OUTSIDE] + t[y, b] - t[OUTSIDE, b] for y in (BEGIN, INSIDE) for a in range(3) for b in range(3)
        )


def _numbered(lines: list[tuple[list[str], list[int], list[str]]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature slots padded with SLOTS, labels) of tagged lines."""
    out = []
    known: dict[tuple[str, str], list[int]] = {}

    def slots(role: str, token: str) -> list[int]:
        if (role, token) not in known:
            known[role, token] = [_slot(f"{role}|{f}") for f in token_features(token)]
        return known[role, token]

    for tokens, labels, about in lines:
        whole = [_slot(f) for f in about]
        rows = []
        for i, token in enumerate(tokens):
            row = slots("own", token) + whole
            for role, j in (("before", i - 1), ("before2", i - 2), ("behind", i + 1)):
                if 0 <= j < len(tokens):
                    row = row + slots(role, tokens[j])
            rows.append(row)
        width = max(map(len, rows))
        out.append((np.array([r + [SLOTS] * (width - len(r)) for r in rows]), np.array(labels)))
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _marginals(scores: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label at each place, and expected transition counts, by forward and backward sums."""
    n = len(scores)
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + _log_sum(ahead[i - 1][:, None] + between, 0)
    for i in range(n - 2, -1, -1):
        back[i] = _log_sum(between + (scores[i + 1] + back[i + 1])[None, :], 1)
    total = _log_sum(ahead[-1], 0)
    places = np.exp(ahead + back - total)
    pairs = np.exp(ahead[:-1, :, None] + between[None] + (scores[1:] + back[1:])[:, None, :] - total).sum(axis=0)
    return places, pairs


def train(lines: list[tuple[list[str], list[int], list[str]]], rounds: int = 3, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic gradient steps with a step size per weight."""
    weights, between = np.zeros((SLOTS + 1, 3)), np.zeros((3, 3))
    seen, seen_between = np.full((SLOTS + 1, 3), 1e-3), np.full((3, 3), 1e-3)
    numbered = _numbered(lines)
    order = np.random.default_rng(6)
    for _ in range(rounds):
        for k in order.permutation(len(numbered)):
            slots, labels = numbered[k]
            places, pairs = _marginals(weights[slots].sum(axis=1), between)
            places[np.arange(len(labels)), labels] -= 1
            np.subtract.at(pairs, (labels[:-1], labels[1:]), 1)
            touched, inverse = np.unique(slots, return_inverse=True)
            gradient = np.zeros((len(touched), 3))
            np.add.at(gradient, inverse.reshape(slots.shape), places[:, None, :])
            gradient += decay * weights[touched]
            seen[touched] += gradient**2
            weights[touched] -= rate * gradient / np.sqrt(seen[touched])
            weights[SLOTS] = 0
            seen_between += pairs**2
            between -= rate * (pairs + decay * between) / np.sqrt(seen_between)
    # a span that opens with "inside" is read as one that begins there, a little less likely
    between[OUTSIDE, INSIDE] = between[OUTSIDE, BEGIN] - 2
    seen = {f for tokens, _, _ in lines for t in set(tokens) for f in token_features(t)[-2:]}
    return Field(weights[:SLOTS].astype(np.float32), between, frozenset(seen))


def tagged(line: str, spans: list[Span] | None = None) -> tuple[list[str], list[int], list[str]]:
    """Tokens and labels of a line by ``spans``, or by its pattern spans."""
    spans = sorted(pattern_spans(line) if spans is None else spans)
    tokens, labels = [], []
    for m in _TOKEN.finditer(line):
        inside = next((s for s in spans if s[0] < m.end() and m.start() < s[2]), None)
        tokens.append(m.group())
        labels.append(OUTSIDE if inside is None else BEGIN if m.start() <= inside[0] else INSIDE)
    return tokens, labels, file_features(tokens)


#: Names before a secret in training that no pattern knows, and beginnings that services give to their keys.
NAMES = ("client_key", "pwd", "passphrase", "auth", "credential", "private_key", "access", "signing-key", "bearer", "pass", "login")
BEGINNINGS = ("ghp_", "sk_live_", "xoxb-", "glpat-", "npm_", "SG.")
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def made_secret(rng: np.random.Generator) -> str:
    """A secret of random characters with letters and digits, maybe with the beginning of a service."""
    alphabet = (_LOWER + _UPPER + _DIGITS, _LOWER + _UPPER + _DIGITS + "+/_-", _LOWER + _DIGITS, _UPPER + _DIGITS, "abcdef" + _DIGITS)
    letters = list(alphabet[rng.integers(len(alphabet))])
    while True:
        value = "".join(rng.choice(letters, int(rng.integers(16, 49))))
        if sum(c.isdigit() for c in value) > 1 and sum(c.isalpha() for c in value) > 1:
            return (rng.choice(BEGINNINGS) if rng.random() < 0.25 else "") + value


def _lookalike(rng: np.random.Generator) -> str:
    """Something with digits or signs that is no secret."""

    def word() -> str:
        return "".join(rng.choice(list(_LOWER), int(rng.integers(3, 9))))

    n = lambda low, high: int(rng.integers(low, high))
    return (
        str(n(10**9, 10**16)),
        f"{n(1990, 2040)}-{n(1, 13):02}-{n(1, 29):02}",
        f"{n(1, 255)}.{n(0, 255)}.{n(0, 255)}.{n(1, 255)}",
        f"{word()}.{n(1, 99)}@{word()}{n(1, 9)}.{word()}.com",
        f"https://{word()}.{word()}.org/{word()}/{word()}-{n(1, 999)}.html",
        f"/{word()}/{word()}/{word()}_{n(1, 99)}.txt",
        f"{word()}_{word()}_{word()}",
        f"{word().title()}{word().title()}{word().title()}",
        f"v{n(1, 20)}.{n(0, 20)}.{n(0, 20)}",
        f"{word()}{n(1, 2040)}",
        "".join(rng.choice(list(_LOWER), n(12, 40))),
        f"{word()} = {n(1, 10**6)}",
        f"{rng.choice(NAMES)}: {word()} {word()}",
        f"+{n(1, 99)} ({n(0, 999):03}) {n(100, 999)}-{n(1000, 9999)}",
    )[n(0, 14)]


def _hidden_keyword(line: str, rng: np.random.Generator) -> tuple[list[str], list[int], list[str]]:
    """The line tagged by its spans, each keyword replaced by a name that no pattern knows."""
    spans = pattern_spans(line)
    name = str(rng.choice(NAMES))
    for m in reversed(list(ASSIGN.finditer(line))):
        shift = len(name) - len(m.group(1))
        line = line[: m.start(1)] + name + line[m.end(1) :]
        spans = [(a + shift, k, b + shift) if a >= m.end(1) else (a, k, b) for a, k, b in spans]
    return tagged(line, spans)


def _written_into(line: str, rng: np.random.Generator, secret: bool) -> tuple[list[str], list[int], list[str]]:
    """The line tagged by its spans, with things written between its words: a secret or not, and things that look alike."""
    ends = [0, *(m.end() for m in re.finditer(r"\S+", line))]
    spans = pattern_spans(line)

    def put(before: str, value: str, hidden: bool) -> None:
        nonlocal line, spans
        at = int(rng.choice([e for e in ends if not any(a < e < b for a, _, b in spans)] or [0]))
        new = f" {before}{value} "
        spans = [(a + len(new), k, b + len(new)) if a >= at else (a, k, b) for a, k, b in spans]
        if hidden:
            spans.append((at + 1 + len(before), 3, at + 1 + len(before) + len(value)))
        line = line[:at] + new + line[at:]
        ends[:] = [e + len(new) if e > at else e for e in ends]

    for _ in range(2):
        put("", _lookalike(rng), False)
    if secret:
        sign = rng.choice(["=", " = ", ": ", ":", ' = "', "='", " "])
        put(f"{rng.choice(NAMES)}{sign}" if rng.random() < 0.6 else "", made_secret(rng), True)
    return tagged(line, spans)


def learn(docs: DataFrame, sample_lines: int = 400, longest: int = 1500) -> Field | None:
    """A field from lines of ``docs``; None if there is no line. Lines above ``longest`` characters are not sampled.

    A sample is the smallest hash of each of ``sample_lines`` (or twice as many) ranges of hashes, found by aggregation: so
    many rows reach the driver, whatever the number of tasks.
    """

    def short_lines(text: Column) -> Column:
        return F.filter(F.split(text, "\n"), lambda x: F.length(x).between(1, longest))

    def one_each(rows: DataFrame, n: int) -> DataFrame:
        """(h): the smallest hash of every range."""
        return rows.groupBy(F.pmod("h", F.lit(n)).alias("range")).agg(F.min("h").alias("h"))

    # a keyword is found faster than the whole pattern
    lower = F.lower("text")
    hopeful = F.contains("text", F.lit("AKIA")) | F.rlike("text", F.lit("[0-9a-f]{32}"))
    for word in _KEYWORDS:
        hopeful = hopeful | F.contains(lower, F.lit(word))
    lines = docs.where(hopeful).select(F.explode(short_lines(F.col("text"))).alias("line")).where(F.rlike("line", F.lit(_LINE)))
    hashed = lines.select("line", F.xxhash64("line").alias("h"))
    found = hashed.groupBy(F.pmod("h", F.lit(sample_lines)).alias("range")).agg(F.min(F.struct("h", "line"))["line"].alias("line"))
    matching = sorted(r["line"] for r in found.select("line").collect())
    # texts are chosen by their hashes, and only those are split into lines
    texts = docs.where("text is not null").select("text", F.xxhash64("text").alias("h"))
    chosen = [r["h"] for r in one_each(texts, 2 * sample_lines).collect()]
    first = F.array_min(F.transform(short_lines(F.col("text")), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("line"))))
    some = texts.where(F.col("h").isin(chosen)).select("h", first["line"].alias("line"))
    usual = sorted(r["line"] for r in some.where("line is not null").groupBy("h").agg(F.min("line").alias("line")).collect())

    rng = np.random.default_rng(11)
    examples = [_hidden_keyword(x, rng) if i % 2 else tagged(x) for i, x in enumerate(matching)]
    examples += [_written_into(x, rng, i % 2 == 1) for i, x in enumerate(usual)]
    examples = [x for x in examples if x[0]]
    return train(examples) if any(BEGIN in x[1] for x in examples) else None


# --- decoding -------------------------------------------------------------------------------------


def viterbi(scores: np.ndarray, between: np.ndarray, bounded: tuple[bool, bool]) -> list[int]:
    """The best labels of a run; ``bounded`` tells whether an outside token stands before and behind it."""
    best = scores[0] + (between[OUTSIDE] if bounded[0] else 0)
    came = []
    for row in scores[1:]:
        options = best[:, None] + between
        came.append(options.argmax(axis=0))
        best = options.max(axis=0) + row
    if bounded[1]:
        best = best + between[:, OUTSIDE]
    labels = [int(best.argmax())]
    for step in reversed(came):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


class _Numbers(dict):
    """Numbers by token, found for new tokens by a function."""

    def __init__(self, number_of: Callable[[str], int]):
        super().__init__()
        self.number_of = number_of

    def __missing__(self, token: str) -> int:
        number = self[token] = self.number_of(token)
        return number


class Decoder:
    """Spans of a text by a field. Token scores are kept, up to a bounded number of tokens."""

    def __init__(self, field: Field, least_chars: int = 8, most_tokens: int = 300_000):
        self.field, self.least_chars, self.most_tokens = field, least_chars, most_tokens
        self.slack = field.slack()
        self.prefixes = {name[1:] for name in field.seen if name[0] == "p"}
        self.words = {name[1:] for name in field.seen if name[0] == "w"}
        self._restart()

    def _restart(self) -> None:
        self.number = _Numbers(self._row)  # row of ``scores`` by token
        self.signatures: dict[str, tuple[Signature, Signature]] = {}  # by outline, if not hexadecimal and if so
        self.rows: dict[tuple[Signature, str, str], int] = {}
        self.scores = np.zeros((4096, len(ROLES), 3), np.float32)
        self.shapes: dict[Signature, np.ndarray] = {}
        self.parts: dict[str, np.ndarray] = {}

    def _row(self, token: str) -> int:
        """The row of a token's scores: those of its shape, prefix and word; the last two only if training has seen them.

        Tokens that agree in these share a row.
        """
        kind = token.translate(_OUTLINE)
        both = self.signatures.get(kind)
        if both is None:
            both = self.signatures[kind] = signature(kind, False), signature(kind, True)
        found, lower = both[hexadecimal(token)], token.lower()
        prefix = lower[:4]
        key = found, prefix if prefix in self.prefixes else "", lower if lower in self.words else ""
        row = self.rows.get(key)
        if row is None:
            scores = self.shapes.get(found)
            if scores is None:
                scores = self.shapes[found] = sum(map(self._part, _shape_features(found)))
            for name, value in zip("pw", key[1:], strict=True):
                if value:
                    scores = scores + self._part(name + value)
            row = self.rows[key] = len(self.rows)
            if row == len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[row] = scores
        return row

    def _part(self, name: str) -> np.ndarray:
        found = self.parts.get(name)
        if found is None:
            found = self.parts[name] = self.field.of_feature(name)
        return found

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.rows) > self.most_tokens:
            self._restart()
        elif len(self.number) > self.most_tokens:
            self.number.clear()
            self.signatures.clear()
        return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))

    def labels(self, tokens: list[str]) -> dict[int, int]:
        """Labels other than outside, by place."""
        table = self._numbers(tokens)
        own = self.scores[table, 0]
        own = own + self.field.of_file(tokens)
        own[1:] += self.scores[table[:-1], 1]
        own[2:] += self.scores[table[:-2], 2]
        own[:-1] += self.scores[table[1:], 3]
        gain = np.maximum(own[:, BEGIN], own[:, INSIDE]) - own[:, OUTSIDE]
        open_places = np.flatnonzero(gain + self.slack >= -1e-4)
        found: dict[int, int] = {}
        if not len(open_places):
            return found
        cuts = np.flatnonzero(np.diff(open_places) > 1) + 1
        for run in np.split(open_places, cuts):
            first, last = int(run[0]), int(run[-1])
            path = viterbi(own[first : last + 1], self.field.between, (first > 0, last + 1 < len(tokens)))
            found.update({first + k: y for k, y in enumerate(path) if y != OUTSIDE})
        return found

    def spans(self, text: str) -> list[tuple[int, int]]:
        tokens = _TOKEN.findall(text)
        if not tokens or not (labels := self.labels(tokens)):
            return []
        spans: list[list[int]] = []
        last = -2
        for i, m in enumerate(_TOKEN.finditer(text)):
            if i not in labels:
                continue
            if labels[i] == INSIDE and last == i - 1:
                spans[-1][1] = m.end()
            else:
                spans.append([m.start(), m.end()])
            last = i
        return [(a, b) for a, b in spans if b - a >= self.least_chars]


def all_spans(text: str, decoder: Decoder | None, whole: bool = False) -> list[Span]:
    base = pattern_spans(text, whole)
    added = decoder.spans(text) if decoder else []
    free = [(a, 3, b) for a, b in added if not any(s < b and a < e for s, _, e in base)]
    return sorted(base + free)


_SPANS = "array<struct<start: int, kind: int, end: int>>"


def scan(text: Column, field: Field | None, whole: bool = False) -> Column:
    """Column of all spans (start, kind, end) of a text column, kind being a place in ``KINDS``.

    With ``whole`` an assignment's span begins at its keyword.
    """

    @F.pandas_udf(_SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(field) if field else None
        for texts in batches:
            yield pd.Series(
                [[{"start": a, "kind": k, "end": b} for a, k, b in all_spans(t, decoder, whole)] if t else [] for t in texts],
                dtype=object,
            )

    return spans(text)


def redact(text: Column, field: Field | None, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; spans that overlap are replaced as one."""

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(field) if field else None
        for texts in batches:
            yield pd.Series([None if t is None else without(t, all_spans(t, decoder), mark) for t in texts], dtype=object)

    return cleaned(text)


def without(text: str, spans: list[Span], mark: str) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]]) if parts else text
