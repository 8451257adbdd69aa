"""Operator 8: personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans, and secrets behind a name that says so. They miss other writings of the same thing: a number
once with and once without its plus sign or with a wrong digit, an address cut short or spelled out, a secret without its
name. So each document is also a graph: its mentions (base spans, secrets, other runs of digits, long words of letters and
digits, words with an at sign, addresses with a spelled one) are variables whose label is a kind or none; mentions next to each
other are tied as in a chain, and mentions that repeat or resemble each other, however far apart, are tied by skip edges.
Loopy sum-product messages carry labels along both. A mention whose belief in a kind is high enough becomes a span.

Mentions of one value hang on a hub variable for the value, and values that resemble each other on a hub for what they share,
so a number that stands in a document a thousand times has a thousand skip edges, not half a million.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import drawn

# The kinds in their order, and the patterns.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No address starts within a run of digits: where the run's start fails, so does the rest.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# A secret is a label of the field, but no kind of personal data: it is listed apart.
SECRET = len(KINDS)
NONE = SECRET + 1
_NAMED = re.compile(
    r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?[ \t]{0,8}[:=][ \t]{0,8}[\"']?([A-Za-z0-9+/_.-]{8,})"
)
TRAIN_ROWS = 20_000
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])+")
_AT_WORD = re.compile(r"[^\s@]*@[^\s@]*")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{12,}+")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: at |\s?\[at\]\s?|\s?\(at\)\s?)"
    r"[A-Za-z0-9-]++(?:(?: dot |\s?\[dot\]\s?|\s?\(dot\)\s?|\.)[A-Za-z0-9-]++)+"
)
_AT = re.compile(r" at |\s?\[at\]\s?|\s?\(at\)\s?")
_DOT = re.compile(r" dot |\s?\[dot\]\s?|\s?\(dot\)\s?")
# Numbers that differ in a country code or a leading zero still share their last digits.
_SHARED_DIGITS = 9
_LEAST_DIGITS = 7
# Values of these lengths resemble those from which they differ in one sign.
_ALIKE = range(6, 25)


def emails(text: str) -> list[tuple[int, int]]:
    """Address spans. Each at sign is looked at once with the run before it, so long runs cost no more than their length."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(sign for sign in text if "0" <= sign <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The spans of each kind that the patterns find; matches that fail their check are dropped."""
    found: list[list[tuple[int, int]]] = [emails(text) if "@" in text else [], [], [], []]
    if not _DIGIT.search(text):
        return found
    found[1] = [match.span() for match in _IP.finditer(text) if all(map(_small, match[0].split(".")))]
    for match in _CARD.finditer(text):
        if 13 <= len(digits := _digits(match[0])) <= 19 and luhn(digits):
            found[2].append(match.span())
    if "+" in text:
        found[3] = [match.span() for match in _PHONE.finditer(text) if 9 <= len(_digits(match[0])) <= 15]
    return found


def secrets(text: str) -> list[tuple[int, int]]:
    """Spans behind a name such as password or token that have a digit and eight signs at least."""
    if "=" not in text and ":" not in text:
        return []
    return [match.span(1) for match in _NAMED.finditer(text) if _DIGIT.search(match[1])]


@dataclass
class Mention:
    start: int
    end: int
    label: int | None
    value: str
    features: list[str]


def _mention(text: str, start: int, end: int, label: int | None) -> Mention:
    shown = text[start:end].lower()
    digits, look = _digits(shown), "digits"
    if "@" in shown:
        value, look = shown, "at"
    elif match := _AT.search(shown):
        value, look = f"{shown[: match.start()]}@{_DOT.sub('.', shown[match.end() :])}", "spelled"
    elif any("a" <= sign <= "z" for sign in shown):
        value, look = shown, "opaque"
    else:
        value = digits if label != 1 else shown
    signs = "".join(sorted({sign for sign in shown if not sign.isalnum()}))[:8]
    return Mention(start, end, label, value, [f"look {look}", f"digits {min(len(digits), 20)}", f"signs {signs}"])


def alike(value: str) -> list[str]:
    """What a value shares with those that resemble it: the part before the at sign, the last digits, all signs but one.

    Values that differ by one sign changed, added or left out, or by two neighbours swapped, share one of the last kind.
    """
    local = value.partition("@")[0]
    shared = [f"local {local}"] if local != value and local else []
    if value.isdigit():
        shared.append(f"tail {value[-_SHARED_DIGITS:]}")
    if len(local) in _ALIKE and (value.isdigit() or local != value):
        shared += sorted({f"but {local}", *(f"but {local[:place]}{local[place + 1 :]}" for place in range(len(local)))})
    return shared


def _within(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of ``spans`` in the order of their start those that overlap neither a taken one nor an earlier one."""
    made, end, place, reach = [], 0, 0, 0
    for start, stop in sorted(spans, key=lambda span: (span[0], -span[1])):
        while place < len(taken) and taken[place][0] < stop:
            reach = max(reach, taken[place][1])
            place += 1
        if start >= max(end, reach):
            made.append((start, stop))
            end = stop
    return made


def mentions(text: str, base: list[list[tuple[int, int]]]) -> list[Mention]:
    """Base spans and, none of which overlaps them, secrets and whatever looks a little like either."""
    found = [_mention(text, start, end, kind) for kind, spans in enumerate(base) for start, end in spans]
    found.sort(key=lambda mention: (mention.start, mention.end))
    found += [_mention(text, *span, SECRET) for span in _within(secrets(text), [(mention.start, mention.end) for mention in found])]
    found.sort(key=lambda mention: (mention.start, mention.end))
    others = [match.span() for match in _AT_WORD.finditer(text) if len(match[0]) > 1] if "@" in text else []
    if " at " in text or "[at]" in text or "(at)" in text:
        others += [match.span() for match in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        others += [match.span() for match in _NUMBER.finditer(text) if len(_digits(match[0])) >= _LEAST_DIGITS]
        others += [match.span() for match in _OPAQUE.finditer(text)]
    free = _within(others, [(mention.start, mention.end) for mention in found])
    found += [_mention(text, start, end, None) for start, end in free]
    return sorted(found, key=lambda mention: (mention.start, mention.end))


@dataclass
class Model:
    """Log potentials. ``likelihood`` has log P(feature | label), ``step`` log P(next label | label).

    ``agreed`` counts, for each way of being alike, the pairs of base spans alike that had one label and those that had two.
    """

    likelihood: dict[str, list[float]] = field(default_factory=dict)
    prior: list[float] = field(default_factory=lambda: [0.0] * (NONE + 1))
    step: list[list[float]] = field(default_factory=lambda: [[0.0] * (NONE + 1)] * (NONE + 1))
    agreed: dict[str, tuple[float, float]] = field(default_factory=dict)

    def skip(self, way: str, agree: float) -> float:
        """The potential of a skip edge whose ends agree: the log odds that they do, ``agree`` before any pair is seen."""
        same, other = self.agreed.get(way, (0.0, 0.0))
        return math.log((same + math.exp(agree)) / (other + 1))

    def own(self, mention: Mention) -> list[float]:
        """The potential of each label for a mention by itself; a base span has its label for certain."""
        if mention.label is not None:
            return [0.0 if label == mention.label else -math.inf for label in range(NONE + 1)]
        total = list(self.prior)
        for feature in mention.features:
            for label, value in enumerate(self.likelihood.get(feature, ())):
                total[label] += value
        return total


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - most).sum(axis=axis, keepdims=True)) + most


def beliefs(
    own: list[list[float]], edges: list[tuple[int, int, list[list[float]]]], close: float = 1e-6, free: int = 50, most: int = 200
) -> list[list[float]]:
    """Label probabilities of each variable by loopy sum-product. Edges have a table from the first to the second.

    Rounds go on until no message changes by ``close``. On a tree that is exact and takes no more rounds than the longest
    path has edges. From round ``free`` on, a graph with circles halves each change, which stills messages that swing;
    it gets ``most`` rounds beyond the number of variables, which no tree needs.
    """
    potential = np.array(own, float).reshape(len(own), -1)
    if edges:
        ways: dict[int, int] = {}
        tables = []
        for *_, table in edges:
            if id(table) not in ways:
                ways[id(table)] = len(tables)
                tables += [np.array(table, float), np.array(table, float).T]
        way = np.array([ways[id(table)] for *_, table in edges])
        first, second = np.array([edge[0] for edge in edges]), np.array([edge[1] for edge in edges])
        # Sides 2k and 2k + 1 are the two directions of edge k.
        start, stop = np.column_stack([first, second]).ravel(), np.column_stack([second, first]).ravel()
        table_of = np.column_stack([way, way + 1]).ravel()
        through, back = np.stack(tables), np.arange(len(start)) ^ 1
        circles = len(edges) >= len(set(start.tolist()))
        labels = potential.shape[1]
        sent = np.full((len(start), labels), -math.log(labels))
        known = potential
        for turn in range(len(own) + most):
            fresh = known[start] - sent[back]
            fresh = _log_sum(fresh[:, :, None] + through[table_of], 1)[:, 0, :]
            fresh -= _log_sum(fresh, 1)
            if circles and turn >= free:
                fresh = (fresh + sent) / 2
                fresh -= _log_sum(fresh, 1)
            change = np.abs(np.exp(fresh) - np.exp(sent)).max()
            sent = fresh
            known = potential.copy()
            np.add.at(known, stop, sent)
            if change < close:
                break
        potential = known
    return np.exp(potential - _log_sum(potential, 1)).tolist() if len(own) else []


def graph(
    text: str, found: list[Mention], model: Model, agree: float
) -> tuple[list[list[float]], list[tuple[int, int, list[list[float]]]]]:
    """Potentials and edges of a document's field: a variable for each mention in order, then the hubs.

    Base spans and secrets have their label for certain, so the message of a skip edge to one is known, and is added to the
    potential of each mention that equals or resembles it.
    """
    certain: dict[str, set[int]] = defaultdict(set)
    for value, label in {(mention.value, mention.label) for mention in found if mention.label is not None}:
        for key in [f"value {value}", *alike(value)]:
            certain[key].add(label)
    repeated = Counter(mention.value for mention in found if mention.label is None)
    shared = Counter(key for value in repeated for key in alike(value))
    strength = {way: model.skip(way, agree) for way in ("value", "local", "tail", "but")}
    same = {
        way: [[power if a == b else 0.0 for b in range(NONE + 1)] for a in range(NONE + 1)] for way, power in strength.items()
    }
    hubs: dict[str, int] = {}
    own, edges = [], []
    met: dict[str, list[float]] = {}
    for value, times in repeated.items():
        keys = [f"value {value}", *alike(value)]
        heard = [0.0] * (NONE + 1)
        for key in keys:
            for label in certain.get(key, ()):
                heard[label] = max(heard[label], strength[key.partition(" ")[0]])
        met[value] = heard
        ties = [key for key in keys[1:] if shared[key] > 1]
        if times > 1 or ties:
            hub = hubs[keys[0]] = len(found) + len(hubs)
            for key in ties:
                edges.append((hub, hubs.setdefault(key, len(found) + len(hubs)), same[key.partition(" ")[0]]))
    for place, mention in enumerate(found):
        potential = model.own(mention)
        if mention.label is None:
            potential = [value + more for value, more in zip(potential, met[mention.value])]
            if (hub := hubs.get(f"value {mention.value}")) is not None:
                edges.append((place, hub, same["value"]))
        own.append(potential)
        if place and not text[found[place - 1].end : mention.start].strip() and found[place - 1].end <= mention.start:
            edges.append((place - 1, place, model.step))
    return own + [[0.0] * (NONE + 1) for _ in hubs], edges


def added_spans(text: str, base: list[list[tuple[int, int]]], model: Model, agree: float, sure: float) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans that the patterns of secrets and the field add to the base ones of a document."""
    found = mentions(text, base)
    added = [(SECRET, mention.start, mention.end) for mention in found if mention.label == SECRET]
    if all(mention.label is not None for mention in found):
        return added
    for mention, belief in zip(found, beliefs(*graph(text, found, model, agree))):
        if mention.label is None:
            kind = max(range(NONE), key=belief.__getitem__)
            if belief[kind] >= sure:
                added.append((kind, mention.start, mention.end))
    return added


def trained(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Potentials of looks, neighbours and likeness, counted over about ``rows`` distinct texts whose base spans are the labels.

    The table that comes to the driver has one row per feature and label; there are some hundred at most.
    """
    chosen = drawn(docs.select("text").where("text is not null"), rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                before = None
                found = mentions(text, base_spans(text))
                known = Counter((mention.value, mention.label) for mention in found if mention.label is not None)
                alike_to: dict[str, list[int]] = defaultdict(list)
                for (value, label), times in sorted(known.items()):
                    alike_to[f"value {value}"] += [label] * min(times, 2)
                    for key in alike(value):
                        alike_to[key].append(label)
                for key, met in alike_to.items():
                    for label in met[1:]:
                        seen[f"agree {key.partition(' ')[0]}", int(label != met[0])] += 1
                for mention in found:
                    label = NONE if mention.label is None else mention.label
                    seen.update((feature, label) for feature in mention.features)
                    seen["label", label] += 1
                    if before is not None and before[1] <= mention.start and not text[before[1] : mention.start].strip():
                        seen[f"after {before[0]}", label] += 1
                    before = label, mention.end
        names, labels = [name for name, _ in seen], [label for _, label in seen]
        yield pa.RecordBatch.from_pydict({
            "name": pa.array(names, pa.string()), "label": pa.array(labels, pa.int32()),
            "n": pa.array(list(seen.values()), pa.int64()),
        })

    counted = chosen.mapInArrow(count, "name string, label int, n long").groupBy("name", "label").agg(F.sum("n"))
    table: dict[str, list[float]] = defaultdict(lambda: [0.0] * (NONE + 1))
    for name, label, n in counted.collect():
        table[name][label] = float(n)
    labels = table.pop("label", [0.0] * (NONE + 1))
    agreed = {way: tuple(table.pop(f"agree {way}", [0.0, 0.0])[:2]) for way in ("value", "local", "tail", "but")}
    steps = [table.pop(f"after {label}", [0.0] * (NONE + 1)) for label in range(NONE + 1)]
    # A fiftieth of each label's mentions may look like anything, however many there are.
    likelihood = {
        feature: [math.log(0.98 * n / max(total, 1) + 0.02) for n, total in zip(counts, labels)]
        for feature, counts in table.items()
    }
    return Model(
        likelihood,
        [math.log((n + 1) / (sum(labels) + NONE + 1)) for n in labels],
        [[math.log((n + 1) / (sum(row) + NONE + 1)) for n in row] for row in steps],
        agreed,
    )


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


def personal_data(
    docs: DataFrame, train_rows: int = TRAIN_ROWS, agree: float = 12.0, sure: float = 0.9, id_column: str = "doc_id"
) -> DataFrame:
    """One row for each row of ``docs``: id, counts of base spans by kind, base_spans, spans, n_secret, secrets.

    ``base_spans`` and ``spans`` list ``kind:start:end`` by kind and start, in code points with the end exclusive; the
    latter has the added ones too. ``secrets`` lists ``secret:start:end`` alike. ``agree`` is the log odds, before any is
    seen, that the ends of a skip edge have one label; ``sure`` is the probability that an added span needs. A null text
    counts as empty and has no spans. Ids may be null or repeat.

    Every document with a mention goes through the field, whether it has a base span or not. One pass after the training,
    no shuffle of texts. A graph is that of one document, and its edges are at most some twenty for each distinct value
    and two for each mention.
    """
    model = trained(docs, train_rows)
    # Plain values, whose classes the tasks know.
    likelihood, prior, step, agreed = model.likelihood, model.prior, model.step, model.agreed

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(likelihood, prior, step, agreed)
        for batch in batches:
            counts, plain, full, hidden, secret = [[] for _ in KINDS], [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                for column, spans in zip(counts, base):
                    column.append(len(spans))
                own = [(kind, *span) for kind, spans in enumerate(base) for span in spans]
                plain.append(listed(own))
                more = added_spans(text, base, known, agree, sure)
                extra = [span for span in more if span[0] != SECRET]
                full.append(listed(own + extra) if extra else plain[-1])
                hidden.append(len(more) - len(extra))
                secret.append(",".join(f"secret:{start}:{end}" for kind, start, end in sorted(more) if kind == SECRET))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(column, pa.int64()) for column in counts], pa.array(plain, pa.string()),
                 pa.array(full, pa.string()), pa.array(hidden, pa.int64()), pa.array(secret, pa.string())],
                names=["id", *[f"n_{kind}" for kind in KINDS], "base_spans", "spans", "n_secret", "secrets"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    rows = docs.select(F.col(id_column).alias("id"), "text")
    return rows.mapInArrow(find, f"id {kind}, {counts}, base_spans string, spans string, n_secret long, secrets string")
