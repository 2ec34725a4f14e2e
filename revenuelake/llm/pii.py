"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Four kinds are found: email, ip, card, phone. The *base* spans follow fixed patterns and checks and always stay. Beside them
generators of high recall propose overlapping candidates: every window of number groups that could be a card or a phone
number (so also those that stand next to other numbers and make a base match too long), every four parts of a dotted
chain, IPv6 addresses, addresses with other letters, blanks or words in place of the signs. Gradient-boosted trees
score each candidate by its format and its context; per kind, a threshold calibrated on rows apart from the fit decides.
Of overlapping candidates the one of best score wins, and none overlaps a base span.

The trees learn from the corpus itself: in pieces of at most ``PIECE_CHARS`` characters of about ``SAMPLE_TEXTS`` texts,
personal data in many formats and look-alikes (versions, dates, order numbers, lists of years, digests) are planted between
words, so the truth of each candidate is known. Candidates of the texts themselves count as negative where a check fails,
as positive where they are base spans, and are left out otherwise. The fit is bounded by these two parameters; the scan covers
every whole text, where it lies, without a shuffle and in time linear in its length.

Defined results: a null text is an empty one, without spans; ids may be null or repeat, and every row keeps its own result; equal
texts have equal spans; without texts to learn from only base spans are found. Extra columns are ignored.
"""

from __future__ import annotations

import ipaddress
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenuelake.llm.common import sample_by_hash, tidy, whole_text
from revenuelake.session import ship_package

KINDS = ("email", "ip", "card", "phone")
SAMPLE_TEXTS = 3000  # bound of the texts that the fit sees
PIECE_CHARS = 1500  # and of the characters of each
CALIBRATION = 3  # one text in three is kept from the fit, to calibrate
PRECISION = 0.99  # wanted of the spans above a threshold
ROUNDS, DEPTH, RATE, BINS = 60, 3, 0.2, 32
SLICE_ROWS = 500
CONTEXT = 28  # characters before a candidate that count as its context

# The base patterns. A number starts where no digit stands before it, which changes no match
# and keeps the search linear.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE_RUN = re.compile(r"[ ().0-9-]+")  # what may follow the plus sign
_ASCII_DIGITS = "0123456789"

_DIGITS = re.compile(r"[0-9]+")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]+(?:\.[0-9]+){4,}")
_ROW = re.compile(r"[0-9]+(?:[ .\-/()]{1,3}[0-9]+)*")
_SIX = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_WIDE = re.compile(r"[\w.%+-]+")
_WIDE_DOMAIN = re.compile(r"[^\W_]+(?:-+[^\W_]+)*(?:\.[^\W_]+(?:-+[^\W_]+)*)+")
_AT_WORD = re.compile(r" ?[\[({] ?(?:at|AT|At|@) ?[\])}] ?| (?:at|AT) | @ ")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[({] ?(?:dot|DOT|Dot) ?[\])}] ?| (?:dot|DOT) )[A-Za-z0-9-]+)+")
_HINTS = (
    re.compile(r"mail|correo|courriel|contact|kontakt|write to|adress"),
    re.compile(r"\bip\b|host|server|addr|client|login|from"),
    re.compile(r"card|visa|carte|tarjeta|karte|credit|debit|amex|paid|pay"),
    re.compile(r"tel|phone|call|mobile|mobil|fax|handy|fon\b|móvil|ring"),
)
_OTHER = re.compile(r"version|\bv\.?$|order|isbn|token|\bid\b|\bno\b|nr\b|page|ref|invoice|section|chapter|date|year|since|#")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = max(done, at + 1)  # no later match begins before this sign
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """The base spans by start, then kind."""
    found = [(0, s, e) for s, e in base_emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37 and 12 <= len(number := only_digits(m.group())) <= 19 and luhn(number):
                found.append((2, m.start(), m.end()))
        for m in base_phones(text):
            if 9 <= len(only_digits(text[m[0] : m[1]])) <= 15:
                found.append((3, *m))
    return sorted(found, key=lambda s: (s[1], s[0]))


def base_phones(text: str) -> Iterator[tuple[int, int]]:
    """Places of the phone pattern, whatever their number of digits."""
    at = text.find("+")
    while at >= 0:
        end = at + 1
        if text[end : end + 1] in _ASCII_DIGITS and end < len(text):
            run = _PHONE_RUN.match(text, end)
            last = run.end()
            while text[last - 1] not in _ASCII_DIGITS:
                last -= 1
            if last - end >= 3:  # the first digit, at least one sign, the last digit
                yield at, last
                end = last
        at = text.find("+", end)


def candidates(text: str) -> set[Span]:
    """Overlapping candidates of all kinds."""
    found: set[Span] = set()
    at = text.find("@")
    while at >= 0:
        left = at
        while left and _WIDE.match(text[left - 1]):
            left -= 1
        domain = _WIDE_DOMAIN.match(text, at + 1)
        if left < at and domain:
            found.add((0, left, domain.end()))
        at = text.find("@", at + 1)
    if "at" in text or "AT" in text or "@" in text or "At" in text:
        for sign in _AT_WORD.finditer(text):
            host = _HOST.match(text, sign.end())
            left = sign.start()
            while left and _LOCAL.match(text, left - 1):
                left -= 1
            if host and left < sign.start():
                found.add((0, left, host.end()))
    if text.count(":") > 1:
        for m in _SIX.finditer(text):
            if any(c in "0123456789" for c in m.group()):
                try:
                    ipaddress.IPv6Address(m.group())
                    found.add((1, m.start(), m.end()))
                except ValueError:
                    pass
    if not _DIGITS.search(text):
        return found
    for m in _DOTTED.finditer(text):
        parts = list(_DIGITS.finditer(text, m.start(), m.end()))
        for i in range(len(parts) - 3):
            if all(len(p.group()) <= 3 and int(p.group()) <= 255 for p in parts[i : i + 4]):
                found.add((1, parts[i].start(), parts[i + 3].end()))
    for row in _ROW.finditer(text):
        groups = [(g.start(), g.end()) for g in _DIGITS.finditer(text, row.start(), row.end())]
        for i, (start, _) in enumerate(groups):
            digits, between, j = "", True, i
            while j < len(groups) and len(digits) + groups[j][1] - groups[j][0] <= 19:
                if j > i:
                    between = between and groups[j][0] - groups[j - 1][1] == 1 and text[groups[j][0] - 1] in " -./"
                digits += text[groups[j][0] : groups[j][1]]
                end = groups[j][1]
                if len(digits) >= 12 and between and luhn(digits):
                    found.add((2, start, end))
                if 7 <= len(digits) <= 15 and j - i <= 5:
                    first = start
                    if first and text[first - 1] == "(":
                        first -= 1
                    if first and text[first - 1] == "+":
                        found.add((3, first - 1, end))
                    elif j > i:
                        found.add((3, first, end))
                j += 1
    return found


FEATURES = 31
_TOP = frozenset("com org net edu gov info io co de fr es it nl ch at eu uk us".split())  # common last labels


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    inside = text[start:end]
    groups = _DIGITS.findall(inside)
    sizes = [len(g) for g in groups]
    digits = "".join(groups)
    signs = re.sub(r"[0-9A-Za-z]", "", inside)
    left, right = text[start - 1 : start] or " ", text[end : end + 1] or " "
    before = text[max(0, start - CONTEXT) : start]
    after = text[end : end + 4]
    near = before.lower()
    own = _HINTS[kind].search(near) is not None
    strange = any(h.search(near) for i, h in enumerate(_HINTS) if i != kind)

    def side(c: str) -> float:
        return 0.0 if c.isspace() else 3.0 if c.isdigit() else 2.0 if c.isalpha() else 1.0

    tail = re.split(r"[.@ \[\](){}]+", inside)[-1]
    years = sum(len(g) == 4 and g[:2] in ("19", "20") for g in groups)
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        float(len(inside)), float(len(digits)), float(len(groups)),
        float(min(sizes, default=0)), float(max(sizes, default=0)), float(sizes[0] if sizes else 0), float(sizes[-1] if sizes else 0),
        float(len(set(signs))), float(signs.count("-")), float(signs.count(" ")), float(signs.count(".")), float(signs.count("/")),
        float("(" in inside and inside.find("(") < inside.find(")")), float(inside.count("(") != inside.count(")")), float(inside[:1] == "+"),
        side(left), side(right), float(re.search(r"[0-9][ .\-/()]{1,3}$", before) is not None), float(re.match(r"[ .\-/()]{1,3}[0-9]", after) is not None),
        float(own), float(strange), float(_OTHER.search(near) is not None),
        float(len(tail)) if tail.isalpha() else 0.0, float(years), float(int(digits[:1] or 0)), float("@" in inside or ":" in inside),
        float(tail.lower() in _TOP),
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees of depth ``DEPTH``: the inner nodes' features and bounds, and the leaves, level by level."""

    at: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for at, bound, leaf in zip(self.at, self.bound, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, at[node]] > bound[node])
            total += leaf[node - len(at)]
        return total


def boost(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, l2: float = 1.0) -> Trees:
    """Gradient boosting on the logistic loss: each tree splits where the second-order gain is largest."""
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = np.log(share / (1 - share))
    margin, inner, trees = np.full(len(y), start), 2**DEPTH - 1, []
    flat = binned + BINS * np.arange(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        at, bound, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(y), dtype=np.int64)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            if len(here) > 1:
                where = flat[here].ravel()
                g = np.bincount(where, np.repeat(slope[here], width), BINS * width).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(where, np.repeat(bend[here], width), BINS * width).reshape(width, BINS).cumsum(axis=1)
                gain = g**2 / (h + l2) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + l2) - g[:, -1:] ** 2 / (h[:, -1:] + l2)
                f, cut = np.unravel_index(gain[:, :-1].argmax(), (width, BINS - 1))
                if gain[f, cut] > 1e-6 and cut < len(edges[f]):
                    at[k], bound[k] = f, edges[f][cut]
            node[here] = 2 * k + 1 + (x[here, at[k]] > bound[k])
        last = node - inner
        leaf = RATE * np.bincount(last, slope, inner + 1) / (np.bincount(last, bend, inner + 1) + l2)
        margin += leaf[last]
        trees.append((at, bound, leaf))
    return Trees(*[np.array(part) for part in zip(*trees)], float(start))


def threshold(margin: np.ndarray, truth: np.ndarray, precision: float = PRECISION) -> float:
    """The least margin from which the calibrated probability (isotonic) reaches ``precision``; infinite if none does."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # least margin, rows, true rows; probabilities ascend
    for m, t in zip(margin[order], truth[order]):
        if blocks and blocks[-1][0] == m:
            blocks[-1][1:] = [blocks[-1][1] + 1, blocks[-1][2] + t]
        else:
            blocks.append([m, 1.0, float(t)])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            low = blocks.pop(-2)
            blocks[-1] = [low[0], low[1] + blocks[-1][1], low[2] + blocks[-1][2]]
    return next((m for m, n, t in blocks if t / n >= precision), float("inf"))


@dataclass(frozen=True)
class PersonalDataModel:
    trees: Trees | None
    thresholds: tuple[float, ...]  # one for each kind


# What is planted for the fit; 0 stands for a digit, A for a letter of a name.
def _name(rng: random.Random, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))


def _number(rng: random.Random, shape: str) -> str:
    return "".join(rng.choice("0123456789") if c == "0" else c for c in shape)


def _with_luhn(rng: random.Random, shape: str) -> str:
    while not luhn(only_digits(made := _number(rng, shape))):
        pass
    return made


CARD_SHAPES = ("0" * 16, "0" * 16, "0000 0000 0000 0000", "0000-0000-0000-0000", "0000.0000.0000.0000", "0000 000000 00000", "0" * 15, "0" * 13, "0" * 19)
PLUS_SHAPES = ("+0 (000) 000-0000", "+00 000 0000000", "+00 (0)00 0000-0000", "+000 00 000 000", "+0-000-000-0000", "+00.000.000.0000", "+00000000000")
HOME_SHAPES = ("(000) 000-0000", "000-000-0000", "000.000.0000", "0000 0000000", "000/0000000", "00 00 00 00 00")
CARD_LEADS = ("card ", "Visa: ", "credit card no ", "Karte ", "carte ", "tarjeta ")
PHONE_LEADS = ("tel. ", "Phone: ", "call ", "mobile ", "Tel ", "fax ", "Telefon: ", "móvil ")
LOOKALIKES = (
    "v0.00.0", "version 0.0.00.0.0", "2000-00-00", "00/00/2000 00:00", "00.00.2000", "00:00:00", "0,000.00", "ISBN 978-0-00-000000-0", "order 0000 0000 0000",
    "No. 00000000", "ref 0000-0000", "1900 1900 2000 2000", "1900-1900, 2000-2000", "section 0.0.0.0.0.0", "00 000 000 000 000", "000 00000 00", "page 000 of 000",
    "0000000000000000", "0000000000000000", "0000000000000000000000", "000 000 000", "0000 0000", "+ 0 0 0", "id 000000000000", "000000 000000 000000",
    "invoice 000-0000000", "0.000.000", "0000000", "at 00 dot 00", "@ 00.00", "AAAA@00", "see AAAA at AAAA", "AAAA at AAAA dot AAAA dot", "AAAA at AAAA.AAAA", "AAAA @ AAAA.AAAA", "10:00 at AAAA.", "#0000000", "std::AAAA", "AA:00:BB:00:00:00",
)


def planted(rng: random.Random) -> list[tuple[int, str]]:
    """Parts of what is planted at one place, each with its kind (-1: not personal data)."""
    parts_before: list[tuple[int, str]] = []
    parts_after: list[tuple[int, str]] = []
    kind = rng.choice((0, 0, 1, 2, 2, 3, 3, 3, -1, -1, -1, -1, -1))
    lead = tail = ""
    if kind == 0:
        local, host, top = _name(rng), _name(rng), rng.choice(("com", "org", "de", "fr", "es", "net", "info"))
        if rng.random() < 0.3:
            local += "." + _name(rng)
        if rng.random() < 0.3:
            local += _number(rng, "00")
        form = rng.randrange(7)
        if form == 5:
            local, host = _name(rng, "abcdeéèñüößaeiou") + "é", _name(rng, "abcdeéèñüößaeiou")
        said = (
            f"{local}@{host}.{top}", f"{local} [at] {host} [dot] {top}", f"{local} (at) {host}.{top}", f"{local} at {host} dot {top}",
            f"{local} @ {host}.{top}", f"{local}@{host}.{top}", f"{local}[at]{host}.{top}",
        )[form]
        lead = rng.choice(("", "", "mail ", "contact: ", "E-Mail: "))
    elif kind == 1:
        said = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        if rng.random() < 0.4:
            said = str(ipaddress.IPv6Address(rng.getrandbits(128) if rng.random() < 0.5 else (0x2001 << 112) + rng.getrandbits(32)))
        lead, tail = rng.choice(("", "", "from ", "host ", "IP ")), rng.choice(("", "", ":80", "/24"))
    elif kind == 2:
        said = _with_luhn(rng, rng.choice(CARD_SHAPES))
        lead = rng.choice(("", "", *CARD_LEADS, _number(rng, "000 "), _number(rng, "00.00.00.000 ")))
        tail = rng.choice(("", "", "", _number(rng, " 00"), _number(rng, " 000.00.0.0"), ", 12/27"))
        if rng.random() < 0.2:  # next to a phone number or to another card
            parts_before = [(3, _number(rng, "+0 (000) 000-0000")), (-1, " ")] if rng.random() < 0.5 else [(2, _with_luhn(rng, rng.choice(CARD_SHAPES[:4]))), (-1, " ")]
            lead = ""
    elif kind == 3:
        abroad = rng.random() < 0.6
        said = _number(rng, rng.choice(PLUS_SHAPES if abroad else HOME_SHAPES))
        lead = rng.choice(("", "", *PHONE_LEADS, _number(rng, "0000 "))) if abroad else rng.choice(PHONE_LEADS)
        tail = rng.choice(("", "", "", _number(rng, " 00.0.00.000"), " (home)", _number(rng, " 0000"))) if abroad else ""
        if abroad and not tail and rng.random() < 0.3:
            parts_after = [(-1, " "), (2, _with_luhn(rng, "0" * 16))]
    else:
        said = re.sub("A", lambda _: rng.choice("abcdef"), _number(rng, rng.choice(LOOKALIKES).replace("19", "\x01").replace("20", "\x02")))
        said = said.replace("\x01", "19").replace("\x02", "20")
        if rng.random() < 0.2:
            said = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    return [*parts_before, (-1, lead), (kind, said), (-1, tail), *parts_after]


def planted_piece(text: str) -> tuple[str, set[Span], list[tuple[int, int]]]:
    """A piece of a text with planted strings: the piece, the true spans and the places of all that is planted."""
    rng = random.Random(zlib.crc32(text.encode()))
    begin = rng.randrange(max(len(text) - PIECE_CHARS, 0) + 1)
    words = text[begin : begin + PIECE_CHARS].split(" ")
    step = max(len(words) // 8, 1)
    out, truth, places, at = [], set(), [], 0
    for i, word in enumerate(words):
        if i % step == step // 2:
            parts, begin = planted(rng), at
            for kind, said in parts:
                if kind >= 0:
                    truth.add((kind, at, at + len(said)))
                at += len(said)
            places.append((begin, at))
            out.append("".join(said for _, said in parts))
            at += 1
        out.append(word)
        at += len(word) + 1
    return " ".join(out), truth, places


def labelled(text: str) -> tuple[list[list[float]], list[int], list[int], list[int]]:
    """Features, kind, truth and whether it is a base span, of the candidates of a planted piece whose truth is known."""
    piece, truth, places = planted_piece(text)
    trusted = {s for s in base_spans(piece)}
    rows, kinds, true, base = [], [], [], []
    for span in sorted(candidates(piece) | truth):
        _, start, end = span
        if span in trusted:
            answer = True  # it stays, whatever its score
        elif any(a < end and start < b for a, b in places):
            answer = span in truth
        elif span[0] in (1, 2) or any(a < end and start < b for _, a, b in trusted):
            continue  # passes the checks: it may be personal data that the base patterns miss
        else:
            answer = False
        rows.append(features(piece, span))
        kinds.append(span[0])
        true.append(int(answer))
        base.append(int(span in trusted))
    return rows, kinds, true, base


def train(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> PersonalDataModel:
    """Fit and calibrate on planted pieces of about ``sample_texts`` texts; a few short rows for each reach the driver."""
    ship_package(docs.sparkSession)
    texts = docs.select("doc_id", whole_text().alias("text")).where(F.length("text") > 0)
    drawn = sample_by_hash(texts, "doc_id", sample_texts).select("text")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                x, kinds, true, base = labelled(text)
                if x:
                    yield pd.DataFrame({"part": zlib.crc32(text.encode()) % CALIBRATION, "kind": kinds, "truth": true, "base": base, "x": x})

    found = drawn.mapInPandas(tidy(rows), "part int, kind int, truth int, base int, x array<double>").toArrow().combine_chunks()
    nothing = PersonalDataModel(None, (float("inf"),) * len(KINDS))
    if not found.num_rows:
        return nothing
    x = found.column("x").chunk(0).values.to_numpy().reshape(-1, FEATURES)
    part, kind, truth, base = (found.column(c).to_numpy() for c in ("part", "kind", "truth", "base"))
    order = np.lexsort((*x.T, base, truth, kind, part))  # the fit does not depend on the order of arrival
    x, part, kind, truth, base = x[order], part[order], kind[order], truth[order], base[order]
    fit = part > 0
    if not fit.any() or truth[fit].min() == truth[fit].max() or fit.all():
        return nothing
    trees = boost(x[fit], truth[fit].astype(float))
    # Base spans stay anyway, so the thresholds are calibrated on what they decide: all other candidates.
    kept = [(part == 0) & (base == 0) & (kind == k) for k in range(len(KINDS))]
    return PersonalDataModel(trees, tuple(threshold(trees.margin(x[k]), truth[k]) for k in kept))


def select(base: Sequence[Span], scored: Sequence[tuple[float, Span]]) -> list[tuple[Span, float]]:
    """Candidates from the best score down that overlap neither a base span nor a chosen one; ties: the longer, then the first."""
    taken = [(s, e) for _, s, e in base]
    chosen = []
    for score, span in sorted(scored, key=lambda c: (-c[0], c[1][1] - c[1][2], c[1][1], c[1][0])):
        if all(e <= span[1] or span[2] <= s for s, e in taken):
            taken.append((span[1], span[2]))
            chosen.append((span, score))
    return chosen


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))


def scan(model: PersonalDataModel, with_text: bool):
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = part.column("text").to_pylist()
                base = [base_spans(t) for t in texts]
                proposed: list[list[tuple[float, Span]]] = [[] for _ in texts]
                if model.trees is not None:
                    for place, text in enumerate(texts):
                        known = set(base[place])
                        spans = [s for s in candidates(text) if s not in known]
                        if spans:
                            margin = model.trees.margin(np.array([features(text, s) for s in spans]))
                            proposed[place] = [(float(m), s) for m, s in zip(margin, spans) if m >= model.thresholds[s[0]]]
                out = []
                for spans, extra in zip(base, proposed):
                    mixed = [(s, True, None) for s in spans] + [(s, False, score) for s, score in select(spans, extra)]
                    out.append(sorted(mixed, key=lambda m: (m[0][1], m[0][0], m[0][2])))
                told = [[{"kind": KINDS[k], "start": s, "end": e, "base": b, "score": p} for (k, s, e), b, p in row] for row in out]
                columns = [part.column("doc_id"), pa.array(told, _SPANS)]
                if with_text:
                    columns.append(pa.array([redacted(t, [m[0] for m in row]) for t, row in zip(texts, out)], pa.string()))
                yield pa.record_batch(columns, names=["doc_id", "spans", "redacted"][: len(columns)])

    return scanned


def redacted(text: str, spans: Sequence[Span]) -> str:
    """The text with each span (overlapping ones together) replaced by the kinds found there."""
    out, done, i = [], 0, 0
    spans = sorted(spans, key=lambda s: (s[1], s[0]))
    while i < len(spans):
        _, start, end = spans[i]
        kinds = []
        while i < len(spans) and spans[i][1] < max(end, start + 1):
            end = max(end, spans[i][2])
            kinds.append(KINDS[spans[i][0]])
            i += 1
        out += [text[done:start], "[", "/".join(dict.fromkeys(kinds)).upper(), "]"]
        done = end
    return "".join([*out, text[done:]])


def find_personal_data(docs: DataFrame, model: PersonalDataModel, with_text: bool = True) -> DataFrame:
    """doc_id, all spans (kind, start, end in characters, base or found, score) and, if wanted, the redacted text."""
    ship_package(docs.sparkSession)
    kinds = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(tidy(scan(model, with_text)), kinds + (", redacted string" if with_text else ""))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from the operator's spans."""
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
