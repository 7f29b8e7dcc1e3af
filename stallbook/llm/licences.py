"""Licence scan: Aho-Corasick over the words of a text finds notice phrases and
identifier tags; the expressions behind the tags go through a shunting-yard
parser and are evaluated with their and/or/with operators."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from stallbook.llm.common import annotate, raw_texts, word_list

# The base phrases, and what a place where they stand is labelled.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mit license": "mit",
    "bsd license": "bsd",
    "2 clause bsd license": "bsd-2-clause",
    "3 clause bsd license": "bsd-3-clause",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
}

TAG_PHRASE = "spdx license identifier"
TAG = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9.+:-]+)")

# How far an identifier's terms reach, by its beginning.
# 0 permissive, 1 weak copyleft, 2 strong copyleft; other identifiers are 3.
REACH = {
    "mit": 0, "apache": 0, "bsd": 0, "isc": 0, "zlib": 0, "cc0": 0, "cc-by-4": 0,
    "unlicense": 0, "mpl": 1, "lgpl": 1, "epl": 1, "cddl": 1, "gpl": 2, "agpl": 2,
    "cc-by-sa": 2,
}

STRENGTH = {"or": 1, "and": 2, "with": 3}


def reach(identifier: str) -> int:
    found = [k for k in REACH if identifier.startswith(k)]
    return REACH[max(found, key=len)] if found else 3


def expression_end(text: str) -> int:
    """Where the longest expression ends that ``text`` begins with; 0 if none does.

    Behind a tag other words may follow on the same line. A word that cannot go
    on ends the expression, as a full stop does; an operator is taken only with
    all that it needs, and, unless the line ends there, before names that look
    like identifiers (known ones, or with a digit or hyphen inside)."""
    at = end = depth = 0
    operand_next, sure = True, True
    rest = text.rstrip(" \t*/-#>;\"'.")
    while m := TOKEN.match(text, at):
        word = m.group(1).lower()
        stop = word not in "()" and word.endswith(".")
        word = word.rstrip(".")
        if word == "(" or word in STRENGTH:
            if operand_next != (word == "("):
                break
            depth += word == "("
            operand_next = True
        elif word == ")":
            if operand_next or not depth:
                break
            depth -= 1
        elif operand_next and word:
            sure = sure and (not end or reach(word) < 3 or bool(re.search("[0-9-]", word)))
            operand_next = False
        else:
            break
        at = m.end()
        if not operand_next and not depth and (sure or at - stop >= len(rest)):
            end = at - stop
        if stop:
            break
    return end


def to_postfix(text: str) -> list[str] | None:
    """Shunting-yard: ``or`` binds weakest, ``with`` strongest, equal operators
    from the left. None if the text is not a whole expression. Works with one
    stack, so depth and length of the expression are not limited."""
    out: list[str] = []
    stack: list[str] = []
    at, operand_next = 0, True
    text = text.rstrip(" \t*/-#>;\"'")
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            return None
        at, word = m.end(), m.group(1).lower()
        if word == "(":
            if not operand_next:
                return None
            stack.append(word)
        elif word == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif word in STRENGTH:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and STRENGTH[stack[-1]] >= STRENGTH[word]:
                out.append(stack.pop())
            stack.append(word)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(word)
            operand_next = False
    if operand_next:
        return None
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return out


def evaluate(postfix: list[str]) -> tuple[set[str], int]:
    """Identifiers of an expression, and how far its terms reach: a choice has
    the mildest, a conjunction the widest; an exception makes strong copyleft
    weak. Exceptions are no identifiers."""
    values: list[tuple[int, str | None]] = []
    names: set[str] = set()
    for i, word in enumerate(postfix):
        if word not in STRENGTH:
            values.append((reach(word), word))
            if not (i + 1 < len(postfix) and postfix[i + 1] == "with"):
                names.add(word)
            continue
        (b, _), (a, _) = values.pop(), values.pop()
        if word == "with":
            values.append((1 if a == 2 else a, None))
        else:
            values.append((min(a, b) if word == "or" else max(a, b), None))
    return names, values[0][0]


def automaton() -> ahocorasick.Automaton:
    """Phrases stand between blanks: only whole words match."""
    found = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *NOTICE_PHRASES, TAG_PHRASE}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


SCHEMA = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("expressions", pa.list_(pa.string())),
        ("reach", pa.int32()),
        ("score", pa.float64()),
    ]
)


def scan_one(raw: bytes | None, find: ahocorasick.Automaton) -> tuple:
    words = word_list(raw)
    joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    places, tagged, at, before = 0, False, 0, 0
    for end, phrase in find.iter(joined):
        if phrase == TAG_PHRASE:
            tagged = True
            continue
        places += 1
        if phrase in BASE_PHRASES:
            first = end + 1 - len(phrase) - 2
            # blanks from the place before on: each is counted about once
            step = joined.count(" ", min(at, first), max(at, first))
            at, before = first, before + (step if first >= at else -step)
            starts.append(before)
            base.add(BASE_PHRASES[phrase])
        if phrase in NOTICE_PHRASES:
            labels.add(NOTICE_PHRASES[phrase])
    texts, widest = [], None
    for m in TAG.finditer(raw) if tagged else ():
        behind = m.group(1).decode("utf-8", "replace")
        postfix = to_postfix(behind[: expression_end(behind)])
        if postfix:
            names, far = evaluate(postfix)
            labels |= names
            widest = far if widest is None else max(widest, far)
            texts.append(" ".join(postfix))
    labels |= base
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), texts, widest,
        1.0 if texts else 1.0 - 0.5**places,
    )


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its licence findings.

    ``n_words``; ``n_base``: places of the base phrases, ``first_word`` and
    ``last_word``: their smallest and largest start (null without any);
    ``base_labels`` and ``labels``: distinct, sorted, comma-joined;
    ``expressions``: the valid expressions behind identifier tags, in postfix
    form; ``reach``: the widest of them (0 permissive to 3 unknown terms, null
    without any); ``score``: 1 with a valid expression, else 1 - 1/2^places.

    Null or empty text: no words, empty labels, score 0. Text of any length is
    read whole. Repeated rows are scanned one by one. An empty table gives an
    empty table. Input columns with one of these names are replaced.
    """

    found: list[ahocorasick.Automaton] = []

    def run(column: pa.Array) -> list:
        if not found:
            found.append(automaton())
        rows = [scan_one(t, found[0]) for t in raw_texts(column)]
        return [list(x) for x in zip(*rows)] if rows else [[] for _ in SCHEMA]

    return annotate(df, [text], run, SCHEMA)
