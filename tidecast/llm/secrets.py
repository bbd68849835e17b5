"""Secret scans: fixed patterns, and formats learned by grammar inference.

The base patterns mark assignments, access keys and long hexadecimal strings. Their values are the
labelled credentials: per kind, a prefix tree of character classes is built from a bounded sample
of distinct values, and statistically compatible states are merged (Hoeffding bound) into a
probabilistic automaton. Every other long candidate string is then scored by its mean
log-likelihood a character under each automaton, and is added as kind ``format`` if it is as
likely as the learned credentials themselves are.

Defined cases: null and empty texts have no span; offsets are code points, the end exclusive;
repeated rows are scanned each; without any labelled credential nothing is added; spans of kind
``format`` never overlap a base span.
"""

from __future__ import annotations

import hashlib
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm.common import bounded_batches, materialize

KINDS = ("assign", "access", "hex")
ADDED = "format"

# The base patterns. A hexadecimal or access run is as long as it can be, so asking
# for the least length at once finds the same spans as filtering all runs.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_KEYWORDS = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value), by start and kind."""
    found = []
    if _KEYWORDS.search(text):
        found += [
            (m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6
        ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, spans: list[tuple]) -> list[tuple[int, int, str]]:
    """(start, end, value) of long strings with digits and letters outside the base spans."""
    out = []
    for m in _CANDIDATE.finditer(text):
        if _DIGIT.search(m[0]) and _LETTER.search(m[0]):
            if all(m.end() <= s[0] or m.start() >= s[2] for s in spans):
                out.append((m.start(), m.end(), m[0]))
    return out


_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("kind", T.IntegerType()),
            T.StructField("value", T.StringType()),
        ]
    )
)


@F.pandas_udf(_SPANS)
def scan(texts: pd.Series) -> pd.Series:
    """Base spans (kind 0 to 2) and candidates (kind 3) of each text."""
    out = []
    for text in texts:
        spans = base_spans(text) if text else []
        rows = [{"start": s, "end": e, "kind": k, "value": v} for s, k, e, v in spans]
        if text:
            rows += [
                {"start": s, "end": e, "kind": 3, "value": v}
                for s, e, v in candidates(text, spans)
            ]
        out.append(rows)
    return pd.Series(out, dtype=object)


def symbols(value: str) -> str:
    """Character classes: digit, a-f, other small letter, capital; marks stand for themselves."""
    return "".join(
        "d" if "0" <= c <= "9" else "h" if "a" <= c <= "f" else "l" if "g" <= c <= "z" else
        "U" if "A" <= c <= "Z" else c
        for c in value
    )


_CLASS_SIZE = {"d": 10, "h": 6, "l": 20, "U": 26}


class Automaton:
    """A prefix tree whose compatible states have been merged."""

    def __init__(self, values: list[str], alpha: float = 0.05):
        self.n, self.end, self.next = [0], [0], [{}]
        self.alpha = alpha
        for v in values:
            self._insert(symbols(v))
        self._merge_states()
        scores = sorted(self.mean_log_likelihood(v) for v in values)
        self.least = scores[len(scores) // 20] if scores else math.inf

    def _insert(self, word: str) -> None:
        s = 0
        self.n[0] += 1
        for c in word:
            if c not in self.next[s]:
                self.next[s][c] = len(self.n)
                self.n.append(0)
                self.end.append(0)
                self.next.append({})
            s = self.next[s][c]
            self.n[s] += 1
        self.end[s] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (n1**-0.5 + n2**-0.5)
        return abs(f1 / n1 - f2 / n2) > bound

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(self.end[a], self.n[a], self.end[b], self.n[b]):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if self._differ(
                    self.n[x] if x is not None else 0,
                    self.n[a],
                    self.n[y] if y is not None else 0,
                    self.n[b],
                ):
                    return False
                if x is not None and y is not None:
                    todo.append((x, y))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree of ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.n[a] += self.n[b]
            self.end[a] += self.end[b]
            for c, y in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], y))
                else:
                    self.next[a][c] = y

    def _merge_states(self) -> None:
        kept, front = [0], [(0, c) for c in sorted(self.next[0])]
        known = {0}
        while front:
            parent, c = front.pop(0)
            q = self.next[parent][c]
            if q in known:
                continue
            for r in kept:
                if self._compatible(r, q):
                    self.next[parent][c] = r
                    self._fold(r, q)
                    front += [(r, x) for x in sorted(self.next[r]) if self.next[r][x] not in known]
                    break
            else:
                kept.append(q)
                known.add(q)
                front += [(q, x) for x in sorted(self.next[q])]

    def mean_log_likelihood(self, value: str) -> float:
        """Mean over the characters; unseen steps have a small probability and stay in place."""
        s, total = 0, 0.0
        for c in symbols(value):
            p = self.next[s].get(c)
            seen = self.n[p] if p is not None else 0
            total += math.log((min(seen, self.n[s]) + 0.01) / (self.n[s] + 0.05))
            total -= math.log(_CLASS_SIZE.get(c, 1))
            s = p if p is not None else s
        return total / max(len(value), 1)


def learn_formats(
    spans: DataFrame, sample: int = 500, longest: int = 128
) -> list[Automaton]:
    """One automaton per kind from at most ``sample`` distinct values of at most ``longest``
    characters each, those with the smallest hashes: a bound on the labelled examples only."""
    values = (
        spans.select(F.explode("found").alias("f"))
        .where((F.col("f.kind") < 3) & (F.length("f.value") <= longest))
        .select("f.kind", "f.value")
        .distinct()
    )
    learned = []
    for kind in range(len(KINDS)):
        rows = (
            values.where(F.col("kind") == kind)
            .orderBy(F.xxhash64("value"), "value")
            .limit(sample)
            .collect()
        )
        if rows:
            learned.append(Automaton(sorted(r["value"] for r in rows)))
    return learned


_RESULT = T.StructType(
    [
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def _reporter(learned: list[Automaton]):
    @F.pandas_udf(_RESULT)
    def report(found: pd.Series) -> pd.DataFrame:
        out = []
        for rows in found:
            base, added, n = [], [], [0, 0, 0]
            for r in rows:
                start, end, kind = int(r["start"]), int(r["end"]), int(r["kind"])
                if kind < 3:
                    n[kind] += 1
                    base.append((start, kind, f"{KINDS[kind]}:{start}:{end}"))
                elif any(a.mean_log_likelihood(r["value"]) >= a.least for a in learned):
                    added.append((start, kind, f"{ADDED}:{start}:{end}"))
            text = ",".join(x[2] for x in sorted(base))
            every = ",".join(x[2] for x in sorted(base + added))
            out.append((*n, hashlib.sha256(text.encode()).hexdigest(), every))
        return pd.DataFrame(out, columns=[f.name for f in _RESULT.fields])

    return report


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, found: base spans and candidates with their values, written once."""
    bounded_batches(docs.sparkSession)
    return materialize(docs.select("doc_id", scan(F.col("text")).alias("found")), "secrets")


def secret_report(docs: DataFrame, sample: int = 500) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(docs)
    report = _reporter(learn_formats(found, sample))
    return found.select("doc_id", report("found").alias("r")).select("doc_id", "r.*")
