"""Secret scans by grammar inference.

Fixed patterns give the base findings. Credentials among them, labelled by kind, train
one probabilistic automaton per kind: a prefix tree of character classes whose
states are merged where their futures are statistically compatible (Hoeffding's bound).
Every other token of a credential's characters, from the shortest that the base patterns
take, is then scored by the likelihood of its format, and those that an automaton explains
much better than ordinary words do are reported beside the base findings.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.tables import written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A cheap test that every text with an assignment passes.
_MAY_ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
#: What could be a credential: a run of the base patterns' characters, of their least length.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
END = "$"
#: Weight of the overall shares of the classes at every state, as a count of characters.
PRIOR = 2.0
#: Distinct tokens whose scores a task remembers.
MEMO = 300_000


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the credential) of the fixed patterns' findings."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            out.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # Runs are maximal, so the first 24 characters of one are enough to find it.
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def classes(token: str) -> str:
    """The token's characters by class: digit, hex letter, other letter, upper case, mark."""
    return token.translate(_CLASSES)


_CLASSES = str.maketrans({
    **{c: "0" for c in "0123456789"}, **{c: "a" for c in "abcdef"}, **{c: "g" for c in "ghijklmnopqrstuvwxyz"},
    **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "/" for c in "+/_.=-"}})


SYMBOLS = (*"0agA/", END)


class Automaton:
    """A probabilistic automaton over character classes, inferred by state merging."""

    def __init__(self, samples: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [defaultdict(int)]
        for sample in samples:
            at = 0
            for c in sample:
                self.seen[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.seen.append(defaultdict(int))
                at = self.next[at][c]
            self.seen[at][END] += 1
        self._merge(math.sqrt(0.5 * math.log(2 / alpha)))
        # Smoothed at every state by how often a class occurs at all, so that no format is ruled out by one character.
        total = {c: 1.0 + sum(s.get(c, 0) for s in self.seen) for c in SYMBOLS}
        whole = sum(total.values())
        self.log = [
            {c: math.log((s.get(c, 0) + PRIOR * total[c] / whole) / (sum(s.values()) + PRIOR)) for c in SYMBOLS} for s in self.seen]
        # After a character that a state does not know, the word goes on as if it began with it.
        self.step = [{c: n.get(c, self.next[0].get(c, 0)) for c in SYMBOLS} for n in self.next]

    def _alike(self, a: int, b: int, bound: float) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = sum(self.seen[a].values()), sum(self.seen[b].values())
            if not na or not nb:
                continue
            gap = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            for c in set(self.seen[a]) | set(self.seen[b]):
                if abs(self.seen[a].get(c, 0) / na - self.seen[b].get(c, 0) / nb) > gap:
                    return False
            stack += [(self.next[a][c], self.next[b][c]) for c in self.next[a] if c in self.next[b]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """State b, still the root of a tree, is added to state a."""
        for c, n in self.seen[b].items():
            self.seen[a][c] += n
        for c, target in self.next[b].items():
            if c in self.next[a]:
                self._fold(self.next[a][c], target)
            else:
                self.next[a][c] = target

    def _merge(self, bound: float) -> None:
        red, blue = [0], sorted(self.next[0].items())
        blue = [(0, c, t) for c, t in blue]
        while blue:
            parent, c, state = blue.pop(0)
            if self.next[parent].get(c) != state:
                continue
            for known in red:
                if self._alike(known, state, bound):
                    self.next[parent][c] = known
                    self._fold(known, state)
                    break
            else:
                red.append(state)
            heads = set(red)
            blue = [(r, c, t) for r in red for c, t in sorted(self.next[r].items()) if t not in heads]

    def likelihood(self, word: str) -> float:
        """Mean log-probability per character, its end included."""
        at, total = 0, 0.0
        for c in word:
            total += self.log[at][c]
            at = self.step[at][c]
        return (total + self.log[at][END]) / (len(word) + 1)


class Grammar:
    """An automaton per credential format, against one of ordinary tokens."""

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str], margin: float = 0.5, evidence: float = 14.0):
        self.formats = [Automaton([classes(t) for t in ts]) for _, ts in sorted(credentials.items()) if len(ts) >= 20]
        self.plain = Automaton([classes(t) for t in ordinary]) if len(ordinary) >= 20 else None
        self.margin, self.evidence = margin, evidence

    def score(self, token: str) -> float:
        """How much likelier, per character, a credential's format makes the token."""
        word = classes(token)
        best = max((f.likelihood(word) for f in self.formats), default=-math.inf)
        return best - (self.plain.likelihood(word) if self.plain else -1.8)

    def finds(self, token: str) -> bool:
        """Likelier by the margin per character, and by the evidence as a whole, which a short token has to make up for."""
        score = self.score(token)
        return score >= self.margin and score * (len(token) + 1) >= self.evidence


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, credential) of base findings and (plain, token) of other long tokens."""
    for batch in batches:
        kinds, tokens = [], []
        for text in batch.column(0):
            text = text.as_py() or ""
            spans = base_spans(text)
            for start, kind, end, at in spans:
                kinds.append(KINDS[kind])
                tokens.append(text[at:end][:256])
            for m in CANDIDATE.finditer(text):
                if not any(s <= m.start() < e for s, _, e, _ in spans):
                    kinds.append("plain")
                    tokens.append(m[0][:256])
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(tokens, pa.string())], names=["kind", "token"])


def fit_grammar(docs: DataFrame, text_col: str = "text", rows: int = 8000, most: int = 2000) -> Grammar:
    """Learns the formats from at most ``rows`` texts, with at most ``most`` tokens of a kind.

    The sample are the texts of the smallest hash that a fixed pattern matches, and as
    many others, so that it is the same however the table is split.
    """
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    marked = texts.where(F.col("text").rlike(_MAY_ASSIGN) | F.col("text").contains("AKIA"))
    place = F.xxhash64("text")
    ids = marked.select(place.alias("h")).orderBy("h").limit(rows // 2).distinct()
    others = texts.select(place.alias("h")).orderBy("h").limit(rows // 2).distinct()
    wanted = F.broadcast(ids.union(others).distinct())  # at most ``rows`` numbers
    sample = texts.withColumn("h", place).join(wanted, "h", "left_semi").select("text")
    # Written once, as each kind is read from it.
    found = written(sample.mapInArrow(_labelled, "kind string, token string").distinct(), "labelled-tokens")
    credentials: dict[str, list[str]] = defaultdict(list)
    for kind in (*KINDS, "plain"):
        own = found.where(F.col("kind") == kind).orderBy(F.xxhash64("token"), "token").limit(most)
        credentials[kind] = [r["token"] for r in own.collect()]
    ordinary = [t for t in credentials.pop("plain") if not (sum(c.isdigit() for c in t) >= 3 and len(set(t)) >= 8)]
    return Grammar(credentials, ordinary)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grammar: Grammar | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``.

    ``spans`` lists kind:start:end, in code points, of the base findings (assign, access,
    hex) and of what the grammar adds (format), by start and then kind. The hash is of
    the base findings' list alone. Added spans never overlap base ones.

    Null and empty texts have no findings: counts of 0, an empty list and its hash.
    Every row is scanned by itself, rows without an id and repeated ones too. Other
    columns are ignored; an empty table gives no rows, and where a table has too few
    credentials to learn from nothing is added.
    """
    learnt = grammar or fit_grammar(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            column = pc.fill_null(batch.column(1), "")
            # A linear scan tells the texts that have nothing that could be a finding.
            may = pc.match_substring_regex(column, CANDIDATE.pattern).to_pylist()
            out: list[list] = [[], [], [], [], []]
            for flag, text in zip(may, column):
                counts, base, spans = [0, 0, 0], "", ""
                if flag:
                    text = text.as_py()
                    found = base_spans(text)
                    for _, kind, _, _ in found:
                        counts[kind] += 1
                    base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in found)
                    more = []
                    for m in CANDIDATE.finditer(text):
                        token = m[0]
                        if token not in known:
                            if len(known) > MEMO:
                                known.clear()
                            known[token] = learnt.finds(token)
                        if known[token] and not any(s < m.end() and m.start() < e for s, _, e, _ in found):
                            more.append((m.start(), 3, m.end(), m.start()))
                    spans = base if not more else ",".join(
                        f"{(*KINDS, 'format')[k]}:{s}:{e}" for s, k, e, _ in sorted(found + more))
                for k in range(3):
                    out[k].append(counts[k])
                out[3].append(hashlib.sha256(base.encode()).hexdigest())
                out[4].append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(o, pa.int64()) for o in out[:3]], *[pa.array(o, pa.string()) for o in out[3:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
