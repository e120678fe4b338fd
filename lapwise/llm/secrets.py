"""Secret scans: all rules as one minimal automaton, run once over the bytes of each text.

The rules' regular expressions become one nondeterministic automaton; subset construction makes it
deterministic over byte classes, partition refinement makes it minimal, and each state becomes an
array of 256 successors. Besides bytes the automaton reads one extra symbol per rule, "forget":
it drops what that rule has read so far and leaves the other rules where they are. The scan sends
it when a match of the rule ends, so matches of a rule never overlap while all rules still share
the one pass. The start of a match comes from the rule's own automaton of the reversed expression,
run back from the end, never past the end of the rule's match before.

A rule must be a run that closes by itself: once a match is long enough to be accepted, each
further byte either extends it or ends it, as in ``AKIA[A-Z0-9]+``. Then the longest match
from the leftmost start is the stretch of accepted positions. Long minimum lengths belong in
``least``, not in the expression: as counters they would multiply the states of all rules.

Null and empty texts have no spans. Equal texts have equal spans. Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those with fewer than ``least`` bytes after ``lead`` do not count.

    ``tail`` belongs to a match as well. It is read where a match ends, so it adds no states, which it would
    multiply; no match of the rule may begin in it.
    """

    kind: str
    pattern: str
    any_case: bool = False
    lead: str = ""
    least: int = 0
    tail: str = ""


# Forms of known credentials.
_LEAD = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _LEAD + r"[A-Za-z0-9+/_.=-]+", True, _LEAD, 6),
    Rule("access", r"AKIA[A-Z0-9]+", lead="AKIA", least=16),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[opsru]_[A-Za-z0-9]+", lead="gh[opsru]_", least=36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", lead="xox[abprs]-", least=10),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", tail=r"[A-Za-z0-9+/=\r\n]*(?:-----END [A-Z ]*-*)?"),
)
RULES = BASE_RULES + MORE_RULES


class _Nfa:
    """States with moves on sets of bytes and moves on nothing."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def build(self, items, at: int, any_case: bool, back: bool) -> int:
        """Adds parsed ``items`` after state ``at`` (last first if ``back``); the state they end in."""
        for op, arg in reversed(list(items)) if back else items:
            at = self._one(op, arg, at, any_case, back)
        return at

    def _one(self, op, arg, at: int, any_case: bool, back: bool) -> int:
        if op is sre.SUBPATTERN:
            return self.build(arg[3], at, any_case, back)
        end = self.state()
        if op is sre.BRANCH:
            for branch in arg[1]:
                self.free[self.build(branch, at, any_case, back)].append(end)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            for _ in range(low):
                at = self.build(inner, at, any_case, back)
            if high is sre.MAXREPEAT:
                loop = self.state()
                self.free[at].append(loop)
                self.free[self.build(inner, loop, any_case, back)].append(loop)
                self.free[loop].append(end)
            else:
                for _ in range(high - low):
                    self.free[at].append(end)
                    at = self.build(inner, at, any_case, back)
                self.free[at].append(end)
        else:
            self.moves[at].append((_bytes_of(op, arg, any_case), end))
        return end

    def closure(self, states) -> frozenset:
        found, stack = set(states), list(states)
        while stack:
            for s in self.free[stack.pop()]:
                if s not in found:
                    found.add(s)
                    stack.append(s)
        return frozenset(found)


def _bytes_of(op, arg, any_case: bool) -> frozenset:
    if op is sre.LITERAL:
        found = {arg}
    elif op is sre.IN:
        found, negate = set(), False
        for kind, value in arg:
            if kind is sre.NEGATE:
                negate = True
            else:
                found |= set(range(value[0], value[1] + 1)) if kind is sre.RANGE else {value}
        found = set(range(256)) - found if negate else found
    else:
        raise ValueError(f"not supported in a rule: {op}")
    if any_case:
        found |= {ord(x) for b in found if b < 128 for x in (chr(b).lower(), chr(b).upper())}
    return frozenset(found)


def _byte_classes(nfa: _Nfa) -> np.ndarray:
    """The class of each byte: bytes of a class lead everywhere to the same states."""
    sets = list({bytes_ for moves in nfa.moves for bytes_, _ in moves})
    signs = np.array([[b in s for s in sets] for b in range(256)])
    return np.unique(signs, axis=0, return_inverse=True)[1].reshape(-1)


def _subsets(nfa: _Nfa, starts: dict[int, int], finals: dict[int, int], owner: list[int], search: bool):
    """Subset construction. ``search``: a match may start at every byte, and rules can be forgotten.

    Returns successors by state and symbol (byte classes, then rules) and the mask of rules each
    state accepts. State 0 is the start.
    """
    classes = _byte_classes(nfa)
    some = {c: b for b, c in enumerate(classes)}
    begin = nfa.closure(starts.values())
    first = frozenset() if search else begin
    number, todo, table, accepts = {first: 0}, [first], [], []
    while todo:
        now = todo.pop()
        table.append((number[now], row := []))
        accepts.append((number[now], sum({1 << r for s, r in finals.items() if s in now})))
        nexts = []
        for c in range(len(some)):
            byte = some[c]
            moved = {to for s in (now | begin if search else now) for bytes_, to in nfa.moves[s] if byte in bytes_}
            nexts.append(nfa.closure(moved))
        if search:
            nexts += [frozenset(s for s in now if owner[s] != r) for r in starts]
        for n in nexts:
            if n not in number:
                number[n] = len(number)
                todo.append(n)
            row.append(number[n])
    table.sort()
    accepts.sort()
    return classes, np.array([r for _, r in table]), np.array([a for _, a in accepts])


def _minimal(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Merges states that no input tells apart. Also returns where the start went."""
    kind = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([kind, kind[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == kind.max():
            break
        kind = finer
    one = np.unique(kind, return_index=True)[1]
    return kind[table[one]], accepts[one], int(kind[0])


class Automaton:
    """Rules compiled to rows of 256 successor rows, with the accepted rules at 256."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        nfa, owner = _Nfa(), []
        starts, finals = {}, {}
        for r, rule in enumerate(rules):
            starts[r] = nfa.state()
            finals[nfa.build(sre_parser.parse(rule.pattern), starts[r], rule.any_case, False)] = r
            owner += [r] * (len(nfa.moves) - len(owner))
        classes, table, accepts = _subsets(nfa, starts, finals, owner, True)
        table, accepts, start = _minimal(table, accepts)
        rows = [[] for _ in range(len(table))]
        for row, successors, mask in zip(rows, table, accepts):
            row.extend(rows[successors[c]] for c in classes)
            row.append(int(mask))
            row.append([rows[s] for s in successors[classes.max() + 1:]])
        self.states, self.start = len(rows), rows[start]
        self.back = [self._reversed(rule) for rule in rules]
        self.leads = [re.compile(rule.lead.encode(), re.I if rule.any_case else 0) for rule in rules]
        self.tails = [re.compile(rule.tail.encode()) for rule in rules]

    @staticmethod
    def _reversed(rule: Rule) -> list:
        nfa = _Nfa()
        start = nfa.state()
        end = nfa.build(sre_parser.parse(rule.pattern), start, rule.any_case, True)
        classes, table, accepts = _subsets(nfa, {0: start}, {end: 0}, [], False)
        table, accepts, first = _minimal(table, accepts)
        rows = [[] for _ in range(len(table))]
        for at, (row, successors, mask) in enumerate(zip(rows, table, accepts)):
            dead = not mask and all(s == at for s in successors)
            row.extend(rows[successors[c]] for c in classes)
            row += [int(mask), dead]
        return rows[first]

    def _begin(self, r: int, data: bytes, end: int, least: int) -> int:
        row, found = self.back[r], -1
        for i in range(end - 1, least - 1, -1):
            row = row[data[i]]
            if row[256]:
                found = i
            elif row[257]:
                break
        return found

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of every match in ``data``, in bytes, by start and rule."""
        spans: list[tuple[int, int, int]] = []
        done = [0] * len(self.rules)
        row, live = self.start, 0

        def close(ended: int, end: int) -> None:
            for r, rule in enumerate(self.rules):
                if ended >> r & 1:
                    begin = self._begin(r, data, end, done[r])
                    done[r] = end
                    if begin >= 0 and (
                        not rule.least or end - begin - self.leads[r].match(data, begin, end).end() + begin >= rule.least
                    ):
                        spans.append((begin, r, self.tails[r].match(data, end).end()))

        for i, byte in enumerate(data):
            after = row[byte]
            if live or after[256]:
                ended = live & ~after[256]
                if ended:
                    close(ended, i)
                    for r in range(len(self.rules)):
                        if ended >> r & 1:
                            row = row[257][r]
                    after = row[byte]
                live = after[256]
            row = after
        if live:
            close(live, len(data))
        spans.sort()
        return spans


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """Compiled once in each Python process."""
    return Automaton(rules)


def in_characters(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte places as code points."""
    if not spans or data.isascii():
        return spans
    starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    at = np.concatenate([[0], starts])
    return [(int(at[a]), r, int(at[b])) for a, r, b in spans]


def find_secrets(text: Column | str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of secrets in a text column, as code points, by start and order of the rules."""

    @F.arrow_udf(SPANS)
    def spans_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = automaton(rules)
        kinds = [rule.kind for rule in rules]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = []
            for value in batch:
                data = value.as_buffer().to_pybytes() if value.is_valid else b""
                spans = in_characters(data, machine.scan(data))
                found.append([{"kind": kinds[r], "start": a, "end": b} for a, r, b in spans])
            yield pa.array(found, pa.list_(kind))

    return spans_of(text)


def redact(text: Column | str, spans: Column | str, mark: str = "[secret]") -> Column:
    """The text with ``mark`` in place of every span; overlapping spans count as one."""
    at = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit("").alias("out"))
    text = F.col(text) if isinstance(text, str) else text

    def step(done: Column, span: Column) -> Column:
        inside = span["start"] < done["end"]
        gap = text.substr((done["end"] + 1).cast("int"), F.greatest(span["start"] - done["end"], F.lit(0)).cast("int"))
        more = F.when(inside, F.lit("")).otherwise(F.concat(gap, F.lit(mark)))
        return F.struct(F.greatest(done["end"], span["end"]).alias("end"), F.concat(done["out"], more).alias("out"))

    def finish(done: Column) -> Column:
        return F.concat(done["out"], text.substr((done["end"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, at, step, finish))
