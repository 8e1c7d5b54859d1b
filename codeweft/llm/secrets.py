"""Secret scan with learnt formats.

Fixed patterns find labelled credentials. For each kind a probabilistic automaton is
inferred from them: the prefix tree of the values is folded, breadth first, merging
states whose outgoing symbols and ends don't differ by more than chance (Hoeffding
bounds, applied to all successors). Four more are inferred from other tokens of the
corpus: from those without a letter (numbers of cards, accounts and phones, dates), from
long ones, from short or dotted ones of letters alone, and from such ones with digits or
signs, as numbers and addresses are rare among words. Every token of the labelled
values' alphabet and least length is then scored by the likeliest credential format
against its background; what stands out is a span of kind ``grammar``. Dotted tokens
are scored as a whole and by part, and the better of the two counts.

Distinct tokens hold more credentials than running text does, so a background leaves
out tokens of letters and digits that a format finds as likely, per character, as labelled
values that it was not fit on; else unlabelled credentials would pass for usual.

Scores must exceed ``MARGIN``. Where tokens of a background that its automaton was not
fit on score high, the margin is raised to what 99 per cent of them reach plus ``MARGIN``,
but not so far that more than ``LOST`` of the labelled values kept apart fall below it.

Automata are fit on bounded samples: ``SAMPLE`` distinct values of each kind (twice as
many of each background), those with the smallest hash, and their first ``LONGEST``
characters; one in ``APART`` of them is kept apart. Margins come from no sample: they are
quantiles over all distinct values and tokens that nothing was fit on. Scoring takes
whole tokens, and all of them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeweft.llm.common import keep, table

KINDS = ("assign", "access", "hex", "grammar")
SAMPLE = 1500
LONGEST = 128
MARGIN = 12.0  # nats: odds of 160,000 to 1
APART = 5
LOST = 0.05
USUAL = 0.99
MASK = "[secret]"
_ASSIGN = re.compile(
    r"""(?a)(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST = 8  # characters of a labelled value
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
_PART = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_LETTER = re.compile(r"[A-Za-z]")
_DIGIT = re.compile(r"[0-9]")
_LONG, _SHORT, _MIXED, _NUMBER = 3, 4, 5, 6  # kinds of candidates, by background
_BACKGROUNDS = (_LONG, _SHORT, _MIXED, _NUMBER)
_OWN = -1  # labelled values of all kinds
_LONG_FROM = 16
_KNOWN = 1 << 16
_SYMBOLS = 67
_LITTLE = 0.05
_CONFIDENCE = math.sqrt(0.5 * math.log(2 / 0.01))
_TOO_FEW = 8

Span = tuple[int, int, int, str]  # start, place of the kind in KINDS, end, value


class Automaton:
    """A probabilistic automaton; state 0 is the start."""

    def __init__(self, values: list[str]):
        self.count, self.ends, self.next = [0], [0], [{}]
        for value in values:
            self._add(value[:LONGEST])
        self._merge()

    def _new(self) -> int:
        self.count.append(0)
        self.ends.append(0)
        self.next.append({})
        return len(self.count) - 1

    def _add(self, value: str) -> None:
        state = 0
        self.count[0] += 1
        for c in value:
            edge = self.next[state].get(c)
            if edge is None:
                edge = self.next[state][c] = [self._new(), 0]
            edge[1] += 1
            state = edge[0]
            self.count[state] += 1
        self.ends[state] += 1

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > _CONFIDENCE * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            n, m = self.count[a], self.count[b]
            if n < _TOO_FEW or m < _TOO_FEW:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if self._differ(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y:
                    open_.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for c, (child, times) in self.next[b].items():
                edge = self.next[a].get(c)
                if edge is None:
                    self.next[a][c] = [child, times]
                else:
                    edge[1] += times
                    open_.append((edge[0], child))

    def _merge(self) -> None:
        kept, waiting = [0], deque([(0, c) for c in sorted(self.next[0])])
        settled = {0}
        while waiting:
            parent, c = waiting.popleft()
            edge = self.next[parent][c]
            if edge[0] in settled:
                continue
            same = next((k for k in kept if self._compatible(k, edge[0])), None)
            if same is None:
                kept.append(edge[0])
                settled.add(edge[0])
                waiting.extend((edge[0], d) for d in sorted(self.next[edge[0]]))
                continue
            folded = edge[0]
            edge[0] = same
            self._fold(same, folded)
            for k in kept:  # folding may have given settled states new successors
                waiting.extend((k, d) for d in sorted(self.next[k]) if self.next[k][d][0] not in settled)

    def log_likelihood(self, value: str) -> float:
        state, out = 0, 0.0
        for c in value:
            total = self.count[state] + _LITTLE * _SYMBOLS
            edge = self.next[state].get(c)
            out += math.log(((edge[1] if edge else 0) + _LITTLE) / total)
            state = edge[0] if edge else 0
        return out + math.log((self.ends[state] + _LITTLE) / (self.count[state] + _LITTLE * _SYMBOLS))

    def states(self) -> int:
        seen, open_ = {0}, [0]
        while open_:
            for child, _ in self.next[open_.pop()].values():
                if child not in seen:
                    seen.add(child)
                    open_.append(child)
        return len(seen)


def kind_of(token: str) -> int:
    """The background that a token is held against."""
    if not _LETTER.search(token):
        return _NUMBER
    if "." not in token and len(token) >= _LONG_FROM:
        return _LONG
    return _SHORT if token.replace(".", "").isalpha() else _MIXED


def _gain(automaton: Automaton, value: str) -> float:
    """Nats by which the automaton beats equally likely symbols."""
    return automaton.log_likelihood(value) + (len(value) + 1) * math.log(_SYMBOLS)


def _least(automaton: Automaton, apart: list[str]) -> float | None:
    """A gain per character that nearly all values kept apart reach."""
    if len(apart) < _TOO_FEW:
        return None
    return 0.9 * sorted(_gain(automaton, v) / len(v) for v in apart)[int(LOST * len(apart))]


class Formats:
    """Automata of the credentials' kinds and of the backgrounds. ``apart`` holds labelled
    values by kind, ``usual_apart`` tokens of the backgrounds that nothing was fit on;
    where either is too small the margin stays, and the backgrounds are whole."""

    def __init__(
        self,
        labelled: dict[str, list[str]],
        ordinary: list[str],
        short: list[str] | None = None,
        mixed: list[str] | None = None,
        numbers: list[str] | None = None,
        apart: dict[str, list[str]] | None = None,
        usual_apart: dict[int, list[str]] | None = None,
    ):
        self.names = [kind for kind, values in sorted(labelled.items()) if values]
        self.kinds = [Automaton(labelled[kind]) for kind in self.names]
        self.least = [_least(k, (apart or {}).get(kind, [])) for kind, k in zip(self.names, self.kinds, strict=True)]
        self.known: dict[tuple[str, int], float] = {}
        self.beyond: dict[int, float] = {}  # what a margin is raised by
        self.fit_usual(ordinary, short, mixed, numbers)
        if self.kinds:
            own = sorted({v for some in (apart or {}).values() for v in some})
            self.beyond = self._raised(own, {k: self._usual_of(some) for k, some in (usual_apart or {}).items()})

    def fit_usual(
        self, ordinary: list[str], short: list[str] | None, mixed: list[str] | None, numbers: list[str] | None
    ) -> None:
        """Infer the backgrounds, without what the formats find alike."""
        self.background = Automaton(self._usual_of(ordinary))
        given = ((_SHORT, short), (_MIXED, self._usual_of(mixed or [])), (_NUMBER, numbers))
        self.others = {k: Automaton(values) for k, values in given if values}

    def _usual_of(self, tokens: list[str]) -> list[str]:
        """``tokens`` without those that look like credentials of a format."""

        def alike(token: str) -> bool:
            if not (_LETTER.search(token) and _DIGIT.search(token)):
                return False
            gains = ((_gain(k, token), least) for k, least in zip(self.kinds, self.least, strict=True) if least)
            return any(gain > MARGIN and gain >= least * len(token) for gain, least in gains)

        return [t for t in tokens if not alike(t[:LONGEST])]

    def _raised(self, apart: list[str], usual_apart: dict[int, list[str]]) -> dict[int, float]:
        if len(apart) < _TOO_FEW:
            return {}
        own = sorted(self._raw(v, kind_of(v)) for v in apart)
        scores = ((kind, sorted(self._raw(v, kind) for v in tokens)) for kind, tokens in usual_apart.items())
        reached = {kind: some[int(USUAL * len(some))] for kind, some in scores if len(some) >= _TOO_FEW}
        return self.raised_by(own[int(LOST * len(own))], reached)

    def raised_by(self, own: float, reached: dict[int, float]) -> dict[int, float]:
        """What margins are raised by: ``own`` is what all but ``LOST`` of the labelled values
        score, ``reached`` what ``USUAL`` of a background's tokens stay below."""
        most = max(0.0, own - MARGIN - 1e-9)
        return {kind: min(max(0.0, score), most) for kind, score in reached.items()}

    def measure(self, values: DataFrame, unfit: Callable[[int, str], bool], usual: tuple) -> None:
        """Set all margins from ``values(kinds, texts)``, of which ``unfit`` tells those that
        nothing was fit on; ``usual`` is what backgrounds are fit on anew, as what they
        leave out follows from the margins. Tasks score, the driver gets counts."""
        if not self.kinds:
            return
        places = {KINDS.index(name): k for k, name in enumerate(self.names)}

        def gains(kind: int, text: str) -> float | None:
            return _gain(self.kinds[places[kind]], text) / len(text) if kind in places and unfit(kind, text) else None

        labelled = keep(_scored(values.where(F.col("kinds") < _LONG), gains), "labelled")
        low = _quantiles(labelled, dict.fromkeys(places, LOST))
        self.least = [0.9 * low[KINDS.index(name)] if KINDS.index(name) in low else None for name in self.names]
        self.fit_usual(*usual)

        def raws(kind: int, text: str) -> float | None:
            if kind == _OWN:
                return self._raw(text, kind_of(text))
            return self._raw(text, kind) if unfit(kind, text) and self._usual_of([text]) else None

        own = labelled.select(F.lit(_OWN).cast("bigint").alias("kinds"), "texts").distinct()
        scored = keep(_scored(own.unionByName(values.where(F.col("kinds") >= _LONG)), raws).drop("texts"), "scores")
        at = _quantiles(scored, {_OWN: LOST, **dict.fromkeys(_BACKGROUNDS, USUAL)})
        self.beyond = self.raised_by(at.pop(_OWN), at) if _OWN in at else {}
        self.known.clear()

    def _raw(self, value: str, kind: int) -> float:
        usual = self.others.get(kind, self.background)
        return max(k.log_likelihood(value) for k in self.kinds) - usual.log_likelihood(value)

    def score(self, value: str, kind: int = _LONG) -> float:
        """Nats by which the likeliest credential format beats the background, less what
        the margin is raised by."""
        if not self.kinds:
            return -math.inf
        got = self.known.get((value, kind))
        if got is None:
            got = self._raw(value, kind) - self.beyond.get(kind, 0.0)
            if len(value) < _LONG_FROM:  # words, which come again
                if len(self.known) >= _KNOWN:
                    self.known.clear()
                self.known[value, kind] = got
        return got

    def standing_out(self, found: list[Span]) -> list[Span]:
        """Those of a text's candidates that stand out; of a dotted token the whole if
        no part of it scores better, else its parts."""
        scores = [self.score(s[3], s[1]) for s in found]
        good = [k for k, score in enumerate(scores) if score > MARGIN]
        wholes = []
        for k in good:
            start, _, end, value = found[k]
            if "." in value and scores[k] >= max(
                (scores[j] for j in good if j != k and start <= found[j][0] and found[j][2] <= end), default=-math.inf
            ):
                wholes.append(k)
        out = []
        for k in good:
            start, _, end, value = found[k]
            inside = any(found[w][0] <= start and end <= found[w][2] for w in wholes if w != k)
            if k in wholes or ("." not in value and not inside):
                out.append((start, _LONG, end, value))
        return out


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans by start, then kind; each kind on its own."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Tokens of credentials' characters that no base span touches: parts between dots,
    and dotted ones as a whole without dots at their ends."""
    out = []
    for run in _TOKEN.finditer(text):
        begin, value = run.start(), run[0]
        spans = [(begin + m.start(), begin + m.end()) for m in _PART.finditer(value)]
        whole = value.strip(".")
        if "." in whole and len(whole) >= LEAST:
            begin += len(value) - len(value.lstrip("."))
            spans.append((begin, begin + len(whole)))
        for start, end in spans:
            if not any(s < end and start < e for s, _, e, _ in base):
                token = text[start:end]
                out.append((start, kind_of(token), end, token))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in sorted(spans))


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("kinds", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.string())),
    ]
)
_FOUND_DDL = "doc_id bigint, starts array<bigint>, kinds array<bigint>, ends array<bigint>, texts array<string>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            base = base_spans(text or "")
            rows.append(base + candidates(text or "", base))
        yield table(
            _FOUND,
            doc_id=batch["doc_id"],
            **{name: [[s[k] for s in spans] for spans in rows] for k, name in enumerate(("starts", "kinds", "ends", "texts"))},
        )


_SCORED = pa.schema([("kinds", pa.int64()), ("texts", pa.string()), ("score", pa.float64())])


def _scored(values: DataFrame, score: Callable[[int, str], float | None]) -> DataFrame:
    """``values`` with their scores, without those that have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch["kinds"].to_pylist(), batch["texts"].to_pylist(), strict=True))
            rows = [(kind, text, got) for kind, text in pairs if (got := score(kind, text)) is not None]
            yield table(_SCORED, **{f.name: [r[k] for r in rows] for k, f in enumerate(_SCORED)})

    return values.select("kinds", "texts").mapInArrow(run, "kinds bigint, texts string, score double")


_STEPS = 100, 10_000_000  # of a nat


def _quantiles(scored: DataFrame, shares: dict[int, float]) -> dict[int, float]:
    """By kind, the score at place ``int(share * n)`` of all its n scores in order, where n is
    not too few. Scores are counted in steps, then the one step that holds the place in
    finer ones, so the driver gets no more counts than there are steps."""
    places: dict[int, int] = {}
    coarse, fine = (F.floor(F.col("score") * n) for n in _STEPS)
    rows = scored.groupBy("kinds", coarse.alias("step")).agg(F.count("*").alias("n")).collect()
    at: dict[int, int] = {}
    for kind, share in shares.items():
        steps = sorted((r["step"], r["n"]) for r in rows if r["kinds"] == kind)
        total = sum(n for _, n in steps)
        if total >= _TOO_FEW:
            places[kind] = int(share * total)
            for at[kind], n in steps:
                if places[kind] < n:
                    break
                places[kind] -= n
    out: dict[int, float] = {}
    for kind, step in at.items():
        inside = scored.where((F.col("kinds") == kind) & (coarse == step)).groupBy(fine.alias("step"))
        for r in sorted(inside.agg(F.count("*").alias("n"), F.min("score").alias("score")).collect(), key=lambda r: r["step"]):
            if places[kind] < r["n"]:
                out[kind] = r["score"]
                break
            places[kind] -= r["n"]
    return out


def learn(found: DataFrame) -> Formats:
    """Automata from samples of the values in ``found``, margins from all that were not drawn
    for them."""
    values = found.select(F.explode(F.arrays_zip("kinds", "texts")).alias("s"))
    values = values.select("s.kinds", F.substring("s.texts", 1, LONGEST).alias("texts")).distinct()
    values = keep(values, "values")

    def sample(kind: int, most: int) -> list[str]:
        rows = values.where(F.col("kinds") == kind).select("texts", F.xxhash64("texts").alias("turn"))
        return [r["texts"] for r in rows.orderBy("turn", "texts").limit(most).collect()]

    drawn = {KINDS[k]: sample(k, SAMPLE) for k in range(_LONG)}
    usual = {k: sample(k, 2 * SAMPLE) for k in _BACKGROUNDS}
    apart = {kind: some[::APART] for kind, some in drawn.items()}
    apart = {kind: some for kind, some in apart.items() if len(some) >= _TOO_FEW}
    left = {v for some in apart.values() for v in some}
    fit = {kind: sorted(set(some) - left) for kind, some in drawn.items()}
    rest = tuple(sorted(set(some) - set(some[::APART])) if len(some) >= APART * _TOO_FEW else sorted(some) for some in usual.values())
    learnt = {v for some in fit.values() for v in some}
    out = {KINDS.index(kind): learnt | set(drawn[kind]) - set(some) for kind, some in apart.items()}
    out |= {k: set(some) - set(some[::APART]) for k, some in usual.items()}
    formats = Formats(fit, [])
    formats.measure(values, lambda kind, text: kind in out and text not in out[kind], rest)
    return formats


_SPANS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("n_grammar", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def _judge(formats: Formats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _SPANS}
            for row in batch.to_pylist():
                spans = list(zip(row["starts"], row["kinds"], row["ends"], row["texts"], strict=True))
                base = [s for s in spans if s[1] < _LONG]
                kept = base + formats.standing_out([s for s in spans if s[1] >= _LONG])
                out["doc_id"].append(row["doc_id"])
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(s[1] == k for s in kept))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(kept))
            yield table(_SPANS, **out)

    return run


def _found(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return keep(texts.mapInArrow(_find, _FOUND_DDL), "spans")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256, spans`` for every
    row of ``docs``.

    Null and empty texts have no spans, and the digest of the empty string. Repeated
    rows are scanned each. Places count code points. Other columns are not read.
    Where nothing is labelled there are no formats, and only base spans.
    """
    found = _found(docs)
    ddl = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_grammar bigint, base_sha256 string, spans string"
    return found.mapInArrow(_judge(learn(found)), ddl)


def masked(text: str, formats: Formats) -> str:
    """The text with every span replaced by ``MASK``; spans that touch are one."""
    base = base_spans(text)
    spans = base + formats.standing_out(candidates(text, base))
    out, at = [], 0
    for start, _, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _mask(formats: Formats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [None if t is None else masked(t, formats) for t in batch["text"].to_pylist()]
            k = batch.schema.get_field_index("text")
            batch = batch.set_column(k, batch.schema.field(k), pa.array(clean, batch.schema.field(k).type))
            k = batch.schema.get_field_index("n_chars")
            if k >= 0:
                sizes = pa.array([None if t is None else len(t) for t in clean], batch.schema.field(k).type)
                batch = batch.set_column(k, batch.schema.field(k), sizes)
            yield batch

    return run


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text``, and ``n_chars`` to match; all rows
    and columns stay."""
    return docs.mapInArrow(_mask(learn(_found(docs))), docs.schema)
