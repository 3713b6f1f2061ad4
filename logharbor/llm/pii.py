"""Personal data: fixed patterns, and a semi-Markov conditional random field that finds what they miss."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logharbor.llm.frames import bounded_sample
from logharbor.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Longest entity, in units (see UNIT), that the segmentation considers.
ENTITY_UNITS = 24
#: Labelled regions the model is fitted on, at most.
TRAINING_REGIONS = 400
#: Labelled regions longer than this many characters teach nothing; of regions and their variants together, this
#: many per region of TRAINING_REGIONS are used.
TRAINING_CHARS, VARIANTS = 400, 3
#: Characters around something that may belong to an entity, and the gap over which two such places join.
MARGIN, GAP = 24, 32
EPOCHS, RATE, DECAY = 10, 0.3, 1e-3

# Fixed patterns of the base spans.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from any later digit, too.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

UNIT = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
#: What every entity holds: a digit, an at sign or a spelt-out one.
ANCHOR = re.compile(r"[0-9@]|[\[({]at[\])}]| at (?=[\w.-]+ dot )")
SPELT_AT = re.compile(r" at |[\[({]at[\])}]")
TAIL = re.compile(r"(?:\.| dot |[\[({]dot[\])}])[A-Za-z]{2,6}$")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[LOCAL]+@DOMAIN``, leftmost and without overlap, looked for from the at signs: each character
    is passed a fixed number of times, however long the runs are."""
    free, at = 0, text.find("@")
    while at >= 0:
        head = text[free:at]
        start = free + len(head.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and without overlap per kind; those that fail a test go."""
    found: list[Span] = []
    found += [("email", *span) for span in emails(text)]
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(part_fits(p) for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return in_order(found)


def part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that can hold entities, ending between words."""
    start = end = None
    for m in ANCHOR.finditer(text):
        if end is not None and m.start() - end > GAP + 2 * MARGIN:
            yield widened(text, start, end)
            start = None
        start = m.start() if start is None else start
        end = m.end()
    if start is not None:
        yield widened(text, start, end)


def widened(text: str, start: int, end: int) -> tuple[int, int]:
    low, high = max(0, start - MARGIN), min(len(text), end + MARGIN)
    low = next((i for i in range(low, max(0, low - MARGIN), -1) if text[i - 1 : i].isspace()), low)
    high = next((i for i in range(high, min(len(text), high + MARGIN)) if text[i : i + 1].isspace()), high)
    return low, high


class Segment(NamedTuple):
    first: int
    last: int  # the unit after the segment
    features: list[str]


def char_class(c: str) -> str:
    return "none" if not c else "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def unit_segments(region: str, units: list[tuple[int, int]]) -> Iterator[list[Segment]]:
    """For each unit in turn, the candidate entities that begin there, with the features of each as a whole."""
    anchored = np.zeros(len(region) + 1, np.int64)
    for m in ANCHOR.finditer(region):
        anchored[m.start() + 1] += 1
    anchored = np.cumsum(anchored)
    previous = ""
    for i, (a, _) in enumerate(units):
        c, found = region[a], []
        if c.isalnum() or c in "+(":
            for j in range(i + 1, min(len(units), i + ENTITY_UNITS) + 1):
                b = units[j - 1][1]
                if anchored[b] > anchored[a] and (region[b - 1].isalnum()):
                    found.append(Segment(i, j, span_features(region, a, b, previous)))
        if c.isalpha():
            previous = region[a : units[i][1]].lower()
        yield found


def segments(region: str) -> tuple[list[tuple[int, int]], list[Segment]]:
    """Units of a region, and all its candidate entities."""
    units = [m.span() for m in UNIT.finditer(region)]
    return units, [s for part in unit_segments(region, units) for s in part]


def span_features(region: str, a: int, b: int, previous: str) -> list[str]:
    s = region[a:b]
    groups = DIGIT_RUN.findall(s)
    digits = "".join(groups)
    letters = any(c.isalpha() for c in s)
    marks = "".join(sorted({c for c in s if not c.isalnum()}))[:8]
    at = "@" * s.count("@") if "@" in s else "spelt" if SPELT_AT.search(s) else ""
    tail = bool(TAIL.search(s))
    checked = 12 <= len(digits) <= 19 and not letters and luhn(digits)
    quad = len(groups) == 4 and not letters and all(part_fits(g) for g in groups) and not s.startswith("+")
    left, right = char_class(region[a - 1 : a]), char_class(region[b : b + 1])
    n = min(len(digits), 20)
    return [
        "any", f"digits={n},letters={letters}", f"groups={min(len(groups), 9)},marks={marks}", f"at={at},tail={tail}",
        f"at={at},tail={tail},spaces={s.count(' ')},marks={marks}", f"luhn={checked},letters={letters}",
        f"luhn={checked},marks={marks}", f"quad={quad},marks={marks}", f"plus={s[0] == '+'},digits={n}",
        f"opens={char_class(s[0])},digits={n}", f"left={left}", f"right={right}", f"left={left},right={right},letters={letters}",
        f"runs={'-'.join(str(min(len(g), 6)) for g in groups[:7])},letters={letters}", f"before={previous}",
        f"short={b - a < 6}",
    ]


DIGIT_RUN = re.compile("[0-9]+")


def outside(region: str, unit: tuple[int, int]) -> int:
    """Class of a unit outside entities: 0 plain, 1 digits, 2 at sign."""
    c = region[unit[0]]
    return 1 if c.isdigit() else 2 if c == "@" else 0


class Model(NamedTuple):
    weights: dict[str, np.ndarray]  # feature -> score per kind
    out: np.ndarray  # score of units outside

    def scores(self, found: list[Segment]) -> np.ndarray:
        zero = np.zeros(len(KINDS))
        return np.array([sum((self.weights.get(f, zero) for f in s.features), zero) for s in found]).reshape(-1, len(KINDS))

    def entities(self, region: str) -> list[Span]:
        """The best segmentation of a region, by dynamic programming over bounded segments.

        Only the segments of one unit are held at a time; of all others only the best score and the step to it.
        """
        units = [m.span() for m in UNIT.finditer(region)]
        best = [0.0] + [-np.inf] * len(units)
        back: list[tuple[int, int] | None] = [None] * (len(units) + 1)
        for i, found in enumerate(unit_segments(region, units)):
            if (plain := best[i] + self.out[outside(region, units[i])]) >= best[i + 1]:
                best[i + 1], back[i + 1] = plain, None
            for s, scores in zip(found, self.scores(found)):
                kind = int(scores.argmax())
                if (value := best[i] + scores[kind]) > best[s.last]:
                    best[s.last], back[s.last] = value, (i, kind)
        spans, j = [], len(units)
        while j:
            if (step := back[j]) is None:
                j -= 1
            else:
                spans.append((KINDS[step[1]], units[step[0]][0], units[j - 1][1]))
                j = step[0]
        return spans[::-1]


def fit(samples: list[tuple[str, list[Span]]], seed: int = 7) -> Model:
    """Maximum conditional likelihood over labelled regions, by forward and backward sums over segmentations."""
    prepared = []
    for region, gold in samples:
        units, found = segments(region)
        starts, ends = {a: i for i, (a, _) in enumerate(units)}, {b: i + 1 for i, (_, b) in enumerate(units)}
        wanted = {(starts.get(a), ends.get(b)): KINDS.index(kind) for kind, a, b in gold}
        at = {(s.first, s.last): k for k, s in enumerate(found)}
        if found and all(key in at for key in wanted):
            prepared.append((units, found, {at[key]: kind for key, kind in wanted.items()}, [outside(region, u) for u in units]))
    names = sorted({f for _, found, _, _ in prepared for s in found for f in s.features})
    place = {f: i for i, f in enumerate(names)}
    weights, out = np.zeros((len(names), len(KINDS))), np.zeros(3)
    speed, out_speed = np.full_like(weights, 1e-6), np.full(3, 1e-6)
    coded = []
    for units, found, wanted, classes in prepared:
        features = np.array([[place[f] for f in s.features] for s in found])
        first, last = np.array([s.first for s in found]), np.array([s.last for s in found])
        by_end, by_start = np.argsort(last, kind="stable"), np.argsort(first, kind="stable")
        cuts = np.searchsorted(last[by_end], np.arange(len(units) + 2)), np.searchsorted(first[by_start], np.arange(len(units) + 2))
        coded.append((len(units), features, first, last, by_end, by_start, cuts, wanted, np.array(classes)))
    shuffled = random.Random(seed)
    for _ in range(EPOCHS):
        shuffled.shuffle(coded)
        for n, features, first, last, by_end, by_start, (ends, starts), wanted, classes in coded:
            scores = weights[features].sum(axis=1)
            total = np.logaddexp.reduce(scores, axis=1)
            plain = out[classes]
            forward, backward = np.zeros(n + 1), np.zeros(n + 1)
            for j in range(1, n + 1):
                k = by_end[ends[j] : ends[j + 1]]
                forward[j] = np.logaddexp.reduce(np.append(forward[first[k]] + total[k], forward[j - 1] + plain[j - 1]))
            for i in range(n - 1, -1, -1):
                k = by_start[starts[i] : starts[i + 1]]
                backward[i] = np.logaddexp.reduce(np.append(backward[last[k]] + total[k], backward[i + 1] + plain[i]))
            chance = -np.exp(np.minimum(0, forward[first] + backward[last] - forward[n])[:, None] + scores)
            plain_chance = -np.exp(np.minimum(0, forward[:-1] + plain + backward[1:] - forward[n]))
            covered = np.zeros(n, bool)
            for k, kind in wanted.items():
                chance[k, kind] += 1
                covered[first[k] : last[k]] = True
            plain_chance[~covered] += 1
            grown = np.zeros_like(weights)
            np.add.at(grown, features, chance[:, None, :])
            touched = np.unique(features)
            step = grown[touched] - DECAY * weights[touched]
            speed[touched] += step * step
            weights[touched] += RATE * step / np.sqrt(speed[touched])
            step = np.bincount(classes, plain_chance, 3)
            step[0] = 0
            out_speed += step * step
            out += RATE * step / np.sqrt(out_speed)
    kept = np.abs(weights).max(axis=1) > 1e-3 if len(names) else []
    return Model({f: weights[i] for i, f in enumerate(names) if kept[i]}, out)


def variants(region: str, span: Span, rng: random.Random) -> Iterator[tuple[str, list[Span]]]:
    """A labelled region with its entity written in other usual ways."""
    kind, a, b = span
    s = region[a:b]
    other: list[str] = []
    if kind == "email" and s.count("@") == 1:
        name, host = s.split("@")
        other = [f"{name} at {host.replace('.', ' dot ')}", f"{name}[at]{host}", f"{name}(at){host}", f"{name} [at] {host}"]
    elif kind == "phone":
        d = "".join(DIGIT_RUN.findall(s))[-10:]
        if len(d) == 10:
            other = [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}",
                     f"+1 {d[:3]} {d[3:6]} {d[6:]}", f"+{rng.randint(20, 99)} {d[:2]} {d[2:]}", f"1-{d[:3]}-{d[3:6]}-{d[6:]}"]
    elif kind == "card":
        d = "".join(DIGIT_RUN.findall(s))
        four = [d[i : i + 4] for i in range(0, len(d), 4)]
        other = [" ".join(four), "-".join(four), ".".join(four)]
    elif kind == "ip":
        other = [s.replace(".", "[.]"), s.replace(".", " . ")]
    for text in other:
        yield region[:a] + text + region[b:], [(kind, a, a + len(text))]


def counterexamples(region: str, span: Span, rng: random.Random) -> Iterator[tuple[str, list[Span]]]:
    """The region with ordinary numbers in place of its entity."""
    _, a, b = span
    n = rng.randint
    number = "".join(str(n(0, 9)) for _ in range(16))
    while luhn(number):
        number = "".join(str(n(0, 9)) for _ in range(16))
    plain = [
        f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)}", f"{n(1, 28)}/{n(1, 12)}/{n(1990, 2030)}", f"{n(10, 23)}:{n(10, 59)}:{n(10, 59)}",
        f"{n(1, 9)}.{n(0, 20)}.{n(0, 20)}", f"{n(1, 99)}.{n(0, 9)}", f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", number,
        " ".join(number[i : i + 4] for i in range(0, 16, 4)), str(n(1, 10**9)), f"{n(256, 999)}.{n(0, 255)}.{n(256, 999)}.{n(0, 255)}",
        f"{n(1, 99)} of {n(100, 999)}", f"{n(1900, 2030)} to {n(1900, 2030)}", f"{n(1, 99)}%", f"@{n(1, 99)}",
        f"978-{n(0, 9)}-{n(100, 999)}-{n(10000, 99999)}-{n(0, 9)}", f"{n(10000, 99999)}-{n(1000, 9999)}", f"[{n(1, 99)}]", f"{n(1, 9)}e{n(10, 99)}",
        f"{n(1000, 9999)} {n(1, 12)} {n(1, 28)}",
    ]
    for text in rng.sample(plain, 3):
        yield region[:a] + text + region[b:], []


def labelled_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions that hold something like an entity, with the fixed patterns' spans as labels."""
    for batch in batches:
        texts: list[str] = []
        labels: list[list[str]] = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text) if text else []
            for low, high in regions(text) if text else ():
                if high - low <= TRAINING_CHARS:
                    texts.append(text[low:high])
                    labels.append([f"{k}:{a - low}:{b - low}" for k, a, b in spans if low <= a and b <= high])
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels, pa.list_(pa.string()))], names=["region", "labels"])


def train(docs: DataFrame, text_col: str = "text", regions_at_most: int = TRAINING_REGIONS, seed: int = 7) -> Model:
    """Fit the model on at most ``regions_at_most`` different regions, those that come first by hash.

    The bounds on labelled rows are ``regions_at_most``, ``TRAINING_CHARS`` and ``VARIANTS``; regions whose labels
    overlap are left out, as no segmentation holds both. Labels are the fixed patterns' spans. Each labelled region is also used with its entity in other usual
    notations and with ordinary numbers in its place, so that the model finds notations that the patterns
    miss and leaves numbers alone. Without any region the model finds nothing.
    """
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(labelled_regions, "region string, labels array<string>")
    rows = bounded_sample(materialize(found.distinct(), "regions"), ["region", "labels"], regions_at_most).collect()
    rng = random.Random(seed)
    samples: list[tuple[str, list[Span]]] = []
    for row in rows:
        parts = [x.split(":") for x in row["labels"]]
        gold = [(k, int(a), int(b)) for k, a, b in parts]
        apart = all(x[2] <= y[1] for x, y in zip(gold, gold[1:]))
        if not apart:
            continue
        samples.append((row["region"], gold))
        if len(gold) == 1:
            samples += list(variants(row["region"], gold[0], rng))
            samples += list(counterexamples(row["region"], gold[0], rng))
    rng.shuffle(samples)
    return fit(samples[: VARIANTS * regions_at_most], seed)


def all_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and those of the model that overlap none of them."""
    base = base_spans(text)
    starts = [a for _, a, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # where the base spans up to each one end
    extra: list[Span] = []
    for low, high in regions(text):
        for kind, a, b in model.entities(text[low:high]):
            a, b = a + low, b + low
            before = bisect_left(starts, b)
            if not before or reach[before - 1] <= a:
                extra.append((kind, a, b))
    return base, in_order(base + extra)


def find_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, and arrays ``base`` and ``spans`` of ``(kind, start, end)`` in code points.

    Null and empty texts have none. Texts are read whole. Rows that repeat or lack an id are handled like
    others; an empty table gives no rows; other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t, model) if t else ([], []) for t in batch.column(1).to_pylist()]
            as_rows = [[[dict(zip(("kind", "start", "end"), s)) for s in part] for part in pair] for pair in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in as_rows], span), pa.array([p[1] for p in as_rows], span)],
                names=["id", "base", "spans"])

    of = "array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(find, f"id {rows.schema['id'].dataType.simpleString()}, base {of}, spans {of}").withColumnRenamed("id", id_col)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones together, replaced by its kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The same rows and columns, personal data replaced by its kind; null texts stay null."""
    place = docs.columns.index(text_col)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [mask(t, all_spans(t, model)[1]) if t else t for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(change, docs.schema)


def written(spans: str) -> str:
    """SQL text of an array of spans as ``kind:start:end``, comma-joined."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def digest_of(spans: list[Span]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
