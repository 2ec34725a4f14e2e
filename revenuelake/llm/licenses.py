"""Licence scan: an Aho-Corasick automaton finds notices and tags, a shunting-yard parser reads expressions.

Words are maximal runs of 0-9, a-z and characters beyond ASCII after A-Z are lower-cased. Notices are phrases of
consecutive words, found in one pass over the words of the whole text. Identifier tags are found in the text
itself; the licence expression after a tag, up to the end of its line, is evaluated.

The score is how much the licences found ask of a user, from 0 (nothing found) to 1 (all rights reserved). In an
expression AND takes the stricter side, OR the freer one, WITH an exception takes a part off its licence.

Defined results: a null text is an empty one; no notice gives no words, null places, empty labels, score 0; an
expression whose line ends where an operator or an open bracket still waits adds the label ``expression-error`` to those of its
longest valid part, as does a tag after which no expression stands; references to licences of the document's own are
labelled ``licenseref``; repeated rows and ids each give their own row. Extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from revenuelake.llm.common import tidy, whole_text
from revenuelake.session import ship_package

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Names and openings of public licences.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "server side public license": "sspl",
    "gnu free documentation license": "gfdl",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "boost software license": "bsl",
    "zlib license": "zlib",
    "artistic license": "artistic",
    "sil open font license": "ofl",
    "open database license": "odbl",
    "microsoft public license": "ms-pl",
    "academic free license": "afl",
    "open software license": "osl",
    "cc0": "cc0",
    "creative commons zero": "cc0",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons": "creative-commons",
    "public domain": "public-domain",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "unlicense": "unlicense",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
# How much a family of licences asks of a user.
STRICTNESS = {
    "public-domain": 0.05, "unlicense": 0.05, "cc0": 0.05, "0bsd": 0.05, "wtfpl": 0.05, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "zlib": 0.1,
    "x11": 0.1, "bsl": 0.1, "ncsa": 0.1, "postgresql": 0.1, "curl": 0.1, "apache": 0.15, "afl": 0.15, "python": 0.15, "psf": 0.15,
    "php": 0.15, "openssl": 0.2, "cc-by": 0.2, "creative-commons": 0.3, "artistic": 0.3, "ofl": 0.3, "ms-pl": 0.3, "mpl": 0.4, "epl": 0.4,
    "cddl": 0.4, "cpl": 0.4, "ipl": 0.4, "licenseref": 0.5, "cc-by-sa": 0.5, "lgpl": 0.5, "odbl": 0.5, "cecill": 0.6, "eupl": 0.6,
    "cc-by-nd": 0.6, "gfdl": 0.6, "gpl": 0.7, "osl": 0.7, "agpl": 0.8, "busl": 0.9, "sspl": 0.9, "cc-by-nc": 0.9, "cc-by-nc-sa": 0.9,
    "cc-by-nc-nd": 0.95, "reserved": 1.0,
}
# What may follow a family's name in an identifier: versions and variants.
SUFFIX = re.compile(r"(?:-(?:v?\d+(?:\.\d+)*|only|or-later|clause|patent|clear|attribution|no-invariants|invariants|cmu|b|c|rfn|no-rfn|igo|perl))*\+?")
EXCEPTIONS = re.compile(r"(?:[a-z0-9.+-]+-)?exception(?:-[a-z0-9.]+)*|linux-syscall-note")
LICENSE_REFERENCE = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")
NOT_IDENTIFIERS = {"reserved", "public-domain", "creative-commons"}  # labels of notices only
UNKNOWN = 0.5
EXCEPTION = 0.7  # an exception leaves this share of what a licence asks
_OTHER = bytes(i for i in range(128) if not chr(i).isalnum())
_WORDS = bytes.maketrans(_OTHER + bytes(range(65, 91)), b" " * len(_OTHER) + bytes(range(97, 123)))
_TOKEN = re.compile(r"[()]|(?:documentref-[a-z0-9.\-]+:)?[a-z0-9][a-z0-9.+\-]*")
_BLANK = re.compile(r"\s*")


def family(identifier: str) -> str:
    """The family of a licence identifier: the longest known name that it starts with, else itself."""
    own = identifier.split(":")[-1]
    known = [name for name in STRICTNESS if own == name or own.startswith((f"{name}-", f"{name}+"))]
    return max(known, key=len, default=identifier)


def is_identifier(token: str) -> bool:
    """Whether a token is a known licence in one of its forms, or a licence reference."""
    if LICENSE_REFERENCE.fullmatch(token):
        return True
    name = family(token)
    return name in STRICTNESS and name not in NOT_IDENTIFIERS and name != "licenseref" and SUFFIX.fullmatch(token, len(name)) is not None


class ExpressionError(ValueError):
    pass


def evaluate(expression: str) -> tuple[float, set[str]]:
    """Strictness and licence families of an expression with AND, OR, WITH and brackets.

    Shunting-yard: operators wait on a stack until one that binds less arrives; WITH binds most, then AND, then OR.
    """
    binds = {"or": 1, "and": 2, "with": 3}
    values: list[tuple[float, set[str]]] = []
    waiting: list[str] = []

    def apply() -> None:
        operator = waiting.pop()
        if operator == "(" or len(values) < 2:
            raise ExpressionError(expression)
        right, left = values.pop(), values.pop()
        if operator == "with":
            values.append((left[0] * EXCEPTION, left[1]))
        else:
            values.append(((min if operator == "or" else max)(left[0], right[0]), left[1] | right[1]))

    after_value = False
    for token in _TOKEN.findall(expression.lower()):
        if token in binds:
            if not after_value:
                raise ExpressionError(expression)
            while waiting and waiting[-1] != "(" and binds[waiting[-1]] >= binds[token]:
                apply()
            waiting.append(token)
            after_value = False
        elif token == ")":
            if not after_value:
                raise ExpressionError(expression)
            while waiting and waiting[-1] != "(":
                apply()
            if not waiting:
                raise ExpressionError(expression)
            waiting.pop()
        elif after_value:
            raise ExpressionError(expression)
        elif token == "(":
            waiting.append(token)
        else:
            name = family(token)
            values.append((STRICTNESS.get(name, UNKNOWN), {name}))
            after_value = True
    while waiting:
        apply()
    if len(values) != 1:
        raise ExpressionError(expression)
    return values[0]


def longest_expression(line: str) -> tuple[str, bool]:
    """The longest valid expression that a line starts with ("" if none), and whether the line breaks one off.

    A line is read as far as its tokens can belong to one expression. One is broken off if the line is read to its end and
    an operator or an open bracket still waits there.
    """
    line = line.lower()
    at = valid = depth = 0
    wants, exception = True, False  # a licence or bracket is due; an exception is due
    while match := _TOKEN.match(line, _BLANK.match(line, at).end()):
        token = match.group()
        if exception:
            fits, exception = EXCEPTIONS.fullmatch(token.rstrip(".")), False
            wants = False
        elif wants:
            fits = token == "(" or is_identifier(token) or (token.endswith(".") and is_identifier(token.rstrip(".")))
            depth += token == "("
            wants = token == "("
        else:
            fits = token in ("and", "or") or (token == "with" and line[at - 1] != ")") or (token == ")" and depth > 0)
            depth -= token == ")"
            wants, exception = token in ("and", "or"), token == "with"
        if not fits:
            return line[:valid], valid == 0
        at = match.end()
        if not (wants or exception or depth):
            valid = at - (token.endswith(".") and not wants)
        if token.endswith("."):  # a full stop ends the sentence
            return line[:valid], wants or exception or depth > 0
    rest = line[at:].strip()
    return line[:valid], valid == 0 or (not rest and (wants or exception or depth > 0))


@cache
def _automaton(of_words: bool) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    if of_words:
        for phrase, label in (BASE | NOTICES).items():
            found.add_word(f" {phrase} ", (phrase, label))
    else:
        for tag in TAGS:
            found.add_word(tag, tag)
    found.make_automaton()
    return found


def scan_text(text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, n_notices, n_expressions of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.translate(_WORDS).split(b" ")
    words = [w for w in words if w]
    joined = b" " + b" ".join(words) + b" "
    base, labels, base_places, notices, strict = set(), set(), [], 0, 0.0
    for end, (phrase, label) in _automaton(True).iter(joined.decode("latin-1")):
        notices += 1
        labels.add(label)
        strict = max(strict, STRICTNESS[label])
        if phrase in BASE:
            base.add(label)
            base_places.append(joined.count(b" ", 0, end - len(phrase) - 1))
    expressions = 0
    plain = raw.lower().decode("latin-1")
    for end, _ in _automaton(False).iter(plain):
        expression = re.split(r"[\r\n]|\*/|-->", plain[end + 1 :].split("\n", 1)[0], maxsplit=1)[0]
        if not _TOKEN.search(expression):
            continue
        expressions += 1
        valid, broken = longest_expression(expression)
        value, names = evaluate(valid) if valid else (UNKNOWN, set())
        if broken:
            names = names | {"expression-error"}
        labels |= names
        strict = max(strict, value)
    return (
        len(words), len(base_places), min(base_places, default=None), max(base_places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), strict, notices, expressions,
    )


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_notices", "n_expressions"]
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_notices long, n_expressions long"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each document with the notices, tags and licences of its whole text."""
    ship_package(docs.sparkSession)

    def scanned(batches):
        for batch in batches:
            out = pd.DataFrame([scan_text(t) for t in batch["text"]], columns=COLUMNS)
            out["first_word"], out["last_word"] = out["first_word"].astype("Int64"), out["last_word"].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(tidy(scanned), SCHEMA)
