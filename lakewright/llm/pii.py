"""Personal data in texts: fixed rules, and a semi-Markov conditional random field that adds to them.

The rules find emails, IP addresses, card and phone numbers. The random field scores whole segments, up to
MAX_ATOMS atoms long, by features of the entire span (how many digits, does the checksum hold, what stands
around it), and dynamic programming over all segmentations chooses boundaries and kinds together. It is trained on
what the rules find, and on the same in spellings that the rules miss or with faults that make it something else.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.texts import add_columns, map_batches, strings_of

KINDS = ("email", "ip", "card", "phone")  # fixed values, in the order in which equal starts are listed
MAX_ATOMS = 16
TRAINING_ZONES = 1200  # zones that the field is fitted on, drawn by hash from those of all documents
ZONE_CHARS = 400  # longer zones are not drawn for training; all are searched
EPOCHS = 6
WEIGHTS = 4096
FEATURES = 8  # of every span

SPANS = "array<struct<start:int,end:int,kind:string,base:boolean>>"

# Fixed patterns. Where a pattern of the rules could start in several places of one run, the forms here
# find the same matches without trying them all.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_ACTIVE = re.compile(r"[0-9@]")
_CHUNK = re.compile(r"\S+")
_NEXT = re.compile(r"\s{1,3}(?:[-./()]\s{1,3})?(\S+)")  # a chunk after short white space, or after a lone separator in it
_ATOM = re.compile(r"[^\W_]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _quad(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            yield first, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def rule_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the rules find, by start and then by kind as listed."""
    if not _ACTIVE.search(text):
        return []
    found = [(start, end, "email") for start, end in _emails(text)]
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if _quad(m.group())]
    for match in _CARD.finditer(text):
        digits = _digits(match.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*match.span(), "card"))
    found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Where the field looks for entities: chunks with a digit or an @, together with such chunks that follow after
    at most three white-space characters, or after a lone separator with as many on either side.
    """
    done, found = 0, _ACTIVE.search(text)
    while found:
        first = found.start()
        while first > done and not text[first - 1].isspace():
            first -= 1
        last = _CHUNK.match(text, found.start()).end()
        while (chunk := _NEXT.match(text, last)) and _ACTIVE.search(chunk[1]):
            last = chunk.end()
        yield first, last
        done, found = last, _ACTIVE.search(text, last)


def _char_kind(char: str) -> str:
    return "9" if char.isdigit() else "a" if char.isalpha() else char or "-"


def _features(span: str, before: str, after: str) -> list[int]:
    """Places of a whole span's features among the weights; always equally many."""
    digits = _digits(span)
    separators = "".join(sorted({c for c in span if not c.isalnum()}))
    letters = any(c.isalpha() for c in span)
    count = len(digits)
    checked = not letters and 12 <= count <= 19 and luhn(digits)
    parts = span.split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    dialled = "+" if span[0] == "+" else "00" if span.startswith("00") else ""
    mail = span.count("@") if letters or "@" in span else -1
    edges = _char_kind(before) + _char_kind(after)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"\d{5,}", "9+", re.sub(r"(?<!\d)\d{1,4}(?!\d)", lambda m: "9" * len(m[0]), span)))
    length = "few" if count < 9 else "9-11" if count < 12 else "12-15" if count < 16 else "16-19" if count < 20 else "many"
    whole = (checked, length, letters, dialled, mail, quad and _quad(span), separators)
    domain = mail == 1 and bool(_DOMAIN.fullmatch(span.split("@")[1]))
    names = (
        "bias",
        f"whole {whole}",
        f"shape {shape[:40]}",
        f"edges {edges}",
        f"edges {edges} {dialled} {mail}",
        f"digits {min(count, 24)} {letters}",
        f"separators {separators} {dialled}",
        f"mail {mail} {domain} {separators}",
    )
    return [zlib.crc32(name.encode()) % WEIGHTS for name in names]


@dataclass
class Lattice:
    """All segments of a zone: their bounds in atoms, their bounds in the text, their features."""

    atoms: int
    bounds: list[tuple[int, int]]
    spans: list[tuple[int, int]]
    features: np.ndarray


def lattice(text: str, first: int, last: int) -> Lattice:
    places = [m.span() for m in _ATOM.finditer(text, first, last)]
    opens = [text[a].isalnum() or text[a] in "+(" for a, _ in places]
    closes = [text[a].isalnum() for a, _ in places]
    bounds, spans, features = [], [], []
    for i, (start, _) in enumerate(places):
        if not opens[i]:
            continue
        for j in range(i, min(i + MAX_ATOMS, len(places))):
            end = places[j][1]
            if end - start > 80:
                break
            if closes[j] and _ACTIVE.search(text, start, end):
                bounds.append((i, j + 1))
                spans.append((start, end))
                features.append(_features(text[start:end], text[start - 1 : start], text[end : end + 1]))
    return Lattice(len(places), bounds, spans, np.array(features, np.int64).reshape(-1, FEATURES))


def _ends(lat: Lattice) -> list[list[int]]:
    ending: list[list[int]] = [[] for _ in range(lat.atoms + 1)]
    for n, (_, j) in enumerate(lat.bounds):
        ending[j].append(n)
    return ending


def best_segments(lat: Lattice, weights: np.ndarray) -> list[tuple[int, int, str]]:
    """The segments of the likeliest segmentation. Atoms outside of entities score 0, and win ties."""
    if not lat.bounds:
        return []
    scores = weights[lat.features].sum(axis=1)
    kinds, tops = scores.argmax(axis=1).tolist(), scores.max(axis=1).tolist()
    best, back = [0.0] * (lat.atoms + 1), [-1] * (lat.atoms + 1)
    for j, ending in enumerate(_ends(lat)):
        if j:
            best[j] = best[j - 1]
        for n in ending:
            if (score := best[lat.bounds[n][0]] + tops[n]) > best[j]:
                best[j], back[j] = score, n
    found, j = [], lat.atoms
    while j:
        if back[j] < 0:
            j -= 1
        else:
            found.append((*lat.spans[back[j]], KINDS[kinds[back[j]]]))
            j = lat.bounds[back[j]][0]
    return found[::-1]


def _add_gradient(lat: Lattice, gold: set[tuple[int, int, str]], weights: np.ndarray, gradient: np.ndarray) -> None:
    """Observed less expected features of one zone, by the forward-backward recursions over segments."""
    scores = weights[lat.features].sum(axis=1)
    totals = np.logaddexp.reduce(scores, axis=1).tolist()
    forward, backward = [0.0] * (lat.atoms + 1), [0.0] * (lat.atoms + 1)
    starting: list[list[int]] = [[] for _ in range(lat.atoms + 1)]
    for n, (i, _) in enumerate(lat.bounds):
        starting[i].append(n)
    for j, ending in enumerate(_ends(lat)):
        if j:
            forward[j] = _log_sum([forward[j - 1], *(forward[lat.bounds[n][0]] + totals[n] for n in ending)])
    for i in range(lat.atoms - 1, -1, -1):
        backward[i] = _log_sum([backward[i + 1], *(totals[n] + backward[lat.bounds[n][1]] for n in starting[i])])
    around = [forward[i] + backward[j] - forward[-1] for i, j in lat.bounds]
    delta = -np.exp(np.minimum(scores + np.array(around)[:, None], 0))
    for n, span in enumerate(lat.spans):
        for k, kind in enumerate(KINDS):
            delta[n, k] += (*span, kind) in gold
    for column in lat.features.T:
        np.add.at(gradient, column, delta)


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _variants(text: str, gold: list[tuple[int, int, str]], rng: random.Random) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The zone as it is; each span once in a spelling that the rules miss, once with a fault that undoes it."""
    out = [(text, gold)]
    for start, end, kind in gold:
        span = text[start:end]
        if kind == "phone":
            other, faulty = "00" + span[1:], span[: max(4, len(span) // 2)]
        elif kind == "card":
            digits = _digits(span)
            other = rng.choice([".", "\t", "  ", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
            faulty = span[:-1] + str((int(span[-1]) + rng.randint(1, 9)) % 10)
        elif kind == "ip":
            other, faulty = span.replace(".", "[.]"), span.rpartition(".")[0] + f".{rng.randint(256, 999)}"
        else:
            other, faulty = span.replace("@", rng.choice(["[@]", "(@)"])), span.partition("@")[0] + "@"
        for changed, holds in ((other, True), (faulty, False)):
            if changed:
                shift = len(changed) - len(span)
                rest = [(a + shift * (a > start), b + shift * (a > start), k) for a, b, k in gold if (a, b) != (start, end) and (b <= start or a >= end)]
                out.append((text[:start] + changed + text[end:], rest + [(start, start + len(changed), kind)] * holds))
    return out


def train_model(docs: DataFrame, max_zones: int = TRAINING_ZONES, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, by feature and kind, from at most ``max_zones`` zones of ``docs`` (text).

    The zones are those with the smallest hashes among all documents', so the same table gives the same weights.
    Without any zone all weights are 0 and the field adds nothing.
    """

    def convert(batch):
        rows = []
        for text in strings_of(batch.column("text")):
            spans = rule_spans(text)
            for first, last in zones(text):
                if last - first <= ZONE_CHARS:
                    around = text[max(0, first - 1) : last + 1]
                    left = min(first, 1)
                    inside = [(a - first + left, b - first + left, k) for a, b, k in spans if first <= a and b <= last]
                    rows.append((zlib.crc32(around.encode()), around, left, last - first + left, [f"{a}:{b}:{k}" for a, b, k in inside]))
        keys, arounds, firsts, lasts, golds = zip(*rows, strict=True) if rows else ([], [], [], [], [])
        return {"key": keys, "around": arounds, "first": firsts, "last": lasts, "gold": golds}

    schema = "key bigint, around string, first int, last int, gold array<string>"
    drawn = map_batches(docs.select("text"), schema, convert).distinct().orderBy("key", "around", "first", "gold").limit(max_zones)
    rng = random.Random(0)
    cases = []
    for row in drawn.collect():
        gold = [(int(a), int(b), k) for a, b, k in (x.split(":") for x in row["gold"])]
        for text, spans in _variants(row["around"], gold, rng):
            last = row["last"] + len(text) - len(row["around"])
            if (lat := lattice(text, row["first"], last)).bounds:
                cases.append((lat, set(spans)))
    weights, squares = np.zeros((WEIGHTS, len(KINDS))), np.full((WEIGHTS, len(KINDS)), 1e-6)
    for _ in range(epochs):
        rng.shuffle(cases)
        for first in range(0, len(cases), 16):
            gradient = -1e-3 * weights
            for lat, gold in cases[first : first + 16]:
                _add_gradient(lat, gold, weights, gradient)
            squares += gradient**2
            weights += 0.3 * gradient / np.sqrt(squares)
    return weights


def spans_of(text: str, weights: np.ndarray) -> list[tuple[int, int, str, bool]]:
    """All spans: those of the rules, and those of the random field that touch none of them."""
    base = rule_spans(text)
    found = [(a, b, kind, True) for a, b, kind in base]
    for first, last in zones(text):
        near = [(a, b) for a, b, _ in base if a < last and b > first]
        for start, end, kind in best_segments(lattice(text, first, last), weights):
            if not any(a < end and b > start for a, b in near):
                found.append((start, end, kind, False))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def find_spans(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Add ``spans`` (start, end, kind, base) to ``docs``, in code points, end exclusive, by start and kind.

    A null or empty text has none. All other columns and rows stay as they are; one named ``spans`` gives way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # WEIGHTS x kinds numbers

    def convert(batch):
        rows = []
        for text in strings_of(batch.column("text")):
            spans = spans_of(text, shared.value)
            rows.append([{"start": a, "end": b, "kind": k, "base": base} for a, b, k, base in spans])
        return {"spans": rows}

    return add_columns(docs, f"spans {SPANS}", convert)


def redact(found: DataFrame) -> DataFrame:
    """Put ``[kind]`` in the place of every span; of spans that overlap, the first one's kind. A null text stays."""

    def convert(batch):
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            parts, done = [], 0
            for span in spans or []:
                if span["start"] >= done:
                    parts += [text[done : span["start"]], f"[{span['kind']}]"]
                done = max(done, span["end"])
            texts.append("".join([*parts, text[done:]]) if parts else text)
        return {"text": texts}

    names = [n for n in found.columns if n != "spans"]
    return add_columns(found, "text string", convert).select(*(f"`{n}`" for n in names))


def digest(found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *map(count, KINDS),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
