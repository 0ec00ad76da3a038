"""Secret scan by patterns and inferred formats (operator 3).

1. Base patterns find assignments of passwords and the like, access keys and long hex strings.
2. Formats are learned from these: what they match are labelled credentials, all of them. Spark counts their
   distinct values by form (the classes of their characters), then the nodes of the prefix tree of the forms.
   Nodes that VISITS values and 1 / NODES of the values of their kind reach, at most NODES at each depth, come to
   the driver; an edge to a rarer node keeps its count and leads back to the root, where states too rare to be
   told apart are merged in any case. The tree becomes a probabilistic automaton by merging states with
   statistically compatible futures (Hoeffding bounds, red and blue states). An automaton of all other tokens of
   CANDIDATE_LENGTH characters or more is the background.
3. Every such token, without what base spans cover, is scored by each format: bits of likelihood over the
   background, its end included. Tokens over MARGIN bits per character, and no less likely in the format than
   all but a twentieth of its own examples, are added as kind `format`.

Results in special cases: null and empty texts have no spans (counts 0, hash of the empty string);
whole texts and whole values are searched, of any length, in linear time; without labelled credentials nothing
is added; repeated rows and rows without a `doc_id` are returned each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, map_rows, table

KINDS = ["assign", "access", "hex", "format"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so shorter ones need not be matched to be dropped
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE_LENGTH = 8
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % CANDIDATE_LENGTH)
# Confidence of the compatibility test, and visits below which a state tells nothing.
ALPHA = 0.05
VISITS = 20
NODES = 5_000
MARGIN = 0.5
# Bits per character are ranked in steps of this many to a bit.
STEPS = 100
# Values, edges and verdicts that a Python process holds before it hands them on or forgets them.
HELD = 200_000
ROOT, RARE = 0, -1
END = ""
# Classes of characters and how many characters each holds.
CLASSES = {"0123456789": "d", "abcdef": "x", "ghijklmnopqrstuvwxyz": "l", "ABCDEF": "X", "GHIJKLMNOPQRSTUVWXYZ": "L"}
CLASS_OF = {ord(c): name for group, name in CLASSES.items() for c in group}
CLASS_SIZE = {name: len(group) for group, name in CLASSES.items()}
SYMBOLS = len(CLASSES) + len("+/_.=-")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, credential) by start, then kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Long tokens, or what base spans leave of them: a walk over both, each in order."""
    covered, k = [], 0
    for start, _, end, _ in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    for m in CANDIDATE.finditer(text):
        at, stop = m.span()
        while k < len(covered) and covered[k][1] <= at:
            k += 1
        here = k
        while at < stop:
            free = min(stop, covered[here][0]) if here < len(covered) else stop
            if free - at >= CANDIDATE_LENGTH:
                yield at, free, text[at:free]
            at = covered[here][1] if here < len(covered) else stop
            here += 1


@dataclass
class Automaton:
    """States with counts of ends and of edges; built as a prefix tree, then merged."""

    ends: list[int] = field(default_factory=lambda: [0])
    edges: list[dict[str, list[int]]] = field(default_factory=lambda: [{}])  # symbol -> [state, count]
    floor: float = -math.inf  # bits per character that all but a twentieth of the examples reach

    def state(self) -> int:
        self.ends.append(0)
        self.edges.append({})
        return len(self.ends) - 1

    def visits(self, state: int) -> int:
        return self.ends[state] + sum(n for _, n in self.edges[state].values())

    def compatible(self, a: int, b: int) -> bool:
        """Whether the futures of two states, where both are visited enough, look alike."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            n, m = self.visits(a), self.visits(b)
            if n < VISITS or m < VISITS:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (n**-0.5 + m**-0.5)
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for symbol in self.edges[a].keys() | self.edges[b].keys():
                to_a, to_b = self.edges[a].get(symbol), self.edges[b].get(symbol)
                if abs((to_a[1] if to_a else 0) / n - (to_b[1] if to_b else 0) / m) > bound:
                    return False
                if to_a and to_b and RARE not in (to_a[0], to_b[0]):
                    waiting.append((to_a[0], to_b[0]))
        return True

    def fold(self, red: int, blue: int) -> list[int]:
        """Add the tree below `blue` to `red`; returns the states that have changed."""
        waiting, changed = [(red, blue)], []
        while waiting:
            red, blue = waiting.pop()
            changed.append(red)
            self.ends[red] += self.ends[blue]
            for symbol, (state, count) in self.edges[blue].items():
                edge = self.edges[red].setdefault(symbol, [RARE, 0])
                edge[1] += count
                if edge[0] == RARE:
                    edge[0] = state
                elif state != RARE:
                    waiting.append((edge[0], state))
        return changed

    def merge(self) -> None:
        """Merge each state reached from a kept one, the most visited first, into the first kept state it is
        compatible with, else keep it. Entries of the border are checked when they are taken: counts only grow."""
        kept, seen, border = [ROOT], {ROOT}, []

        def reach(state: int) -> None:
            for symbol, (below, count) in self.edges[state].items():
                if below != RARE and below not in seen:
                    heapq.heappush(border, (-count, state, symbol, below))

        reach(ROOT)
        while border:
            count, state, symbol, below = heapq.heappop(border)
            edge = self.edges[state][symbol]
            if below in seen or edge[0] != below or edge[1] != -count:
                continue  # merged meanwhile, or there is a newer entry
            into = next((red for red in kept if self.compatible(red, below)), None)
            if into is None:
                kept.append(below)
                seen.add(below)
                reach(below)
            else:
                edge[0] = into
                for changed in self.fold(into, below):
                    if changed in seen:
                        reach(changed)
        for state in kept:
            for edge in self.edges[state].values():
                edge[0] = max(edge[0], ROOT)

    def bits(self, form: str) -> float:
        """Log2 likelihood per character of a word of this form, its end counted as one more; unknown edges fall
        back to even chances."""
        total, at = 0.0, ROOT
        for symbol in form:
            edge, n = (self.edges[at].get(symbol), self.visits(at)) if at >= 0 else (None, 0)
            total += math.log2(((edge[1] if edge else 0) + 0.1) / (n + 0.1 * (SYMBOLS + 1)) / CLASS_SIZE.get(symbol, 1))
            at = edge[0] if edge else -1
        ends, n = (self.ends[at], self.visits(at)) if at >= 0 else (0, 0)
        return (total + math.log2((ends + 0.1) / (n + 0.1 * (SYMBOLS + 1)))) / (len(form) + 1)


def infer(edges: Iterable[tuple[int, str, int, int]]) -> Automaton:
    """From (node, symbol, node below, count) of the nodes kept, the root being ROOT; what is below no kept node,
    or an end (END, count), has no node."""
    automaton, states = Automaton(), {ROOT: ROOT}
    edges = sorted(edges)
    inner = {node for node, *_ in edges}
    for node in sorted(inner):
        if node not in states:
            states[node] = automaton.state()
    for node, symbol, below, count in edges:
        if symbol == END:
            automaton.ends[states[node]] += count
        else:
            automaton.edges[states[node]][symbol] = [states.get(below, RARE), count]
    automaton.merge()
    return automaton


def labelled(docs: DataFrame) -> DataFrame:
    """`kind`, `form`, `n`: how many distinct credentials of each base kind have a form; other tokens are kind 3."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen = set()
        for (text,) in rows:
            base = base_spans(text or "")
            found = {(kind, value) for _, kind, _, value in base}
            found.update((3, value) for _, _, value in candidates(text or "", base))
            for kind, value in found - seen:
                yield kind, xxhash.xxh3_128_digest(value), value.translate(CLASS_OF)
            if len(seen) > HELD:
                seen.clear()
            seen.update((kind, value) for kind, value in found if len(value) <= 64)

    # Values are told apart by 128 bits; they do not travel themselves.
    values = map_rows(docs, rows_of, "kind int, value binary, form string", ("text",)).distinct()
    return values.groupBy("kind", "form").agg(F.count(F.lit(1)).alias("n"))


def node_below(node: int, symbol: str) -> int:
    """Number of a node of the prefix tree: 63 bits of its whole prefix, never that of the root."""
    return xxhash.xxh3_64_intdigest(symbol, node) >> 1 or 1


def tree_edges(forms: DataFrame) -> DataFrame:
    """`kind`, `node`, `symbol`, `below`, `n`: values through each edge of the prefix trees; ends have the symbol END."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: Counter = Counter()
        for kind, form, n in rows:
            node = ROOT
            for symbol in form:
                below = node_below(node, symbol)
                held[kind, node, symbol, below] += n
                node = below
            held[kind, node, END, ROOT] += n
            if len(held) > HELD:
                yield from ((*edge, count) for edge, count in held.items())
                held.clear()
        yield from ((*edge, count) for edge, count in held.items())

    edges = map_rows(forms, rows_of, "kind int, node bigint, symbol string, below bigint, n bigint", ("kind", "form", "n"))
    return edges.groupBy("kind", "node", "symbol", "below").agg(F.sum("n").alias("n"))


def learn_formats(docs: DataFrame) -> tuple[list[Automaton], Automaton]:
    """Automata of the base kinds with VISITS examples or more, and that of all other tokens."""
    spark = docs.sparkSession
    forms = cut(labelled(docs), "forms")
    edges = cut(tree_edges(forms), "edges")
    totals = {row.kind: row.n for row in forms.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    least = spark.createDataFrame([(kind, max(VISITS, -(-n // NODES))) for kind, n in totals.items()], "kind int, least bigint")
    limited = edges.join(F.broadcast(least), "kind")
    frequent = limited.where((F.col("n") >= F.col("least")) & (F.col("symbol") != END)).select("kind", F.col("below").alias("node"))
    roots = least.select("kind", F.lit(ROOT).cast("bigint").alias("node"))
    # At most NODES at each depth, and an edge for each symbol of each of them.
    trees: dict[int, list[tuple]] = {kind: [] for kind in [*totals, 3]}
    for kind, *edge in edges.join(frequent.unionByName(roots), ["kind", "node"]).select("kind", "node", "symbol", "below", "n").collect():
        trees[kind].append(tuple(edge))
    formats = {kind: infer(trees[kind]) for kind, n in sorted(totals.items()) if kind < 3 and n >= VISITS}
    set_floors(forms, formats, totals)
    return list(formats.values()), infer(trees[3])


def set_floors(forms: DataFrame, formats: dict[int, Automaton], totals: dict[int, int]) -> None:
    """The bits per character that all but a twentieth of a kind's examples reach, to a step: Spark counts the steps."""
    shared = forms.sparkSession.sparkContext.broadcast(formats)

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        yield from ((kind, math.floor(shared.value[kind].bits(form) * STEPS), n) for kind, form, n in rows)

    of_formats = forms.where(F.col("kind").isin(list(formats)))
    ranked = map_rows(of_formats, rows_of, "kind int, step int, n bigint", ("kind", "form", "n")).groupBy("kind", "step").agg(F.sum("n").alias("n"))
    below = {kind: totals[kind] // 20 for kind in formats}
    for kind, step, n in sorted(tuple(row) for row in ranked.collect()):
        if below[kind] >= 0:
            formats[kind].floor = step / STEPS
            below[kind] -= n


class Verdicts(dict):
    """Whether tokens of a form look like a learned format, remembered."""

    def __init__(self, formats: list[Automaton], background: Automaton) -> None:
        self.formats, self.background = formats, background

    def __missing__(self, form: str) -> bool:
        other = self.background.bits(form)
        found = any((own := f.bits(form)) >= f.floor and own - other >= MARGIN for f in self.formats)
        if len(form) <= 64 and len(self) < HELD:
            self[form] = found
        return found


def find_secrets(docs: DataFrame) -> DataFrame:
    """`doc_id`, the counts of base kinds, `base_sha256`, and `spans` with those of learned formats."""
    formats, background = learn_formats(docs)
    learned = docs.sparkSession.sparkContext.broadcast((formats, background))

    def written(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        looks_secret = Verdicts(*learned.value)
        for doc_id, text in rows:
            text = text or ""
            base = base_spans(text)
            spans = [(start, kind, end) for start, kind, end, _ in base]
            added = [(start, 3, end) for start, end, token in candidates(text, base) if looks_secret[token.translate(CLASS_OF)]]
            counts = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
            yield doc_id, *counts, hashlib.sha256(written(spans).encode()).hexdigest(), written(spans + added)

    result = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_rows(docs, rows_of, result)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
