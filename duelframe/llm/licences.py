"""Licence notices in texts: phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

One automaton over a text's words finds all phrases and the identifier tag in a single pass. What follows
a tag is read as a licence expression: shunting-yard puts identifiers, AND, OR, WITH and brackets in
postfix order, which is evaluated to the alternatives between which a reader may choose.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from duelframe.llm.common import texts_of

#: Phrases of the base and their labels. Fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notices. Each one's label, and how open it is: 1 permissive, 0.5 with conditions, 0 closed.
NOTICES = {
    "bsd license": ("bsd", 1.0),
    "isc license": ("isc", 1.0),
    "boost software license": ("bsl", 1.0),
    "mozilla public license": ("mpl", 0.5),
    "eclipse public license": ("epl", 0.5),
    "lesser general public license": ("lgpl", 0.5),
    "affero general public license": ("agpl", 0.5),
    "creative commons": ("cc", 0.5),
    "cc by": ("cc", 0.5),
    "cc by sa": ("cc", 0.5),
    "cc by nd": ("cc-nd", 0.5),
    "cc by nc": ("cc-nc", 0.0),
    "cc by nc sa": ("cc-nc", 0.0),
    "cc by nc nd": ("cc-nc", 0.0),
    "cc0": ("cc0", 1.0),
    "public domain": ("public-domain", 1.0),
    "the unlicense": ("unlicense", 1.0),
    "all rights reserved": ("reserved", 0.0),
}
OPENNESS = {"mit": 1.0, "apache": 1.0, "gpl": 0.5} | dict(NOTICES.values())
#: Families by which identifiers of expressions are judged: what they are, or begin with before a mark or number, and their label.
FAMILIES = [("mit", "mit"), ("apache", "apache"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("bsd", "bsd"), ("isc", "isc"), ("mpl", "mpl"), ("epl", "epl"),
            ("cc0", "cc0"), ("cc-by-nc", "cc-nc"), ("cc-by-nd", "cc-nd"), ("cc-by", "cc"), ("unlicense", "unlicense"), ("bsl", "bsl")]
TAG = "spdx license identifier"
_TAGGED = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
#: What may stand after an expression on its line.
_REST = re.compile(r"[\s\"'#;*>]*\Z")
#: An identifier that is in no family has a number, a mark or a capital; plain words are prose.
_FORMED = re.compile(r"(?=.*[A-Z0-9+-])[A-Za-z0-9][A-Za-z0-9.+-]*\Z")
_FAMILY = {start: re.compile(rf"{re.escape(start)}(?:\Z|[-.+]|v?[0-9])") for start, _ in FAMILIES}
#: Bytes of words keep their place, A-Z lower-cased; all else becomes a blank.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_RANK = {"or": 1, "and": 2, "with": 3}


def parsed(expression: str) -> tuple[list[str], bool]:
    """Tokens of a licence expression in postfix order, and whether it makes up its line.

    It ends before the first thing that is none. Brackets that don't match are passed over, so that a torn
    line still gives its identifiers.
    """
    out: list[str] = []
    held: list[str] = []
    operand = False  # whether the last token was one
    line = expression.split("*/")[0].split("-->")[0]
    end = 0
    for match in _TOKEN.finditer(line):
        token = match[0]
        word = token.lower()
        if line[end : match.start()].strip():
            break
        if word in _RANK:
            if not operand:
                break
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[word]:
                out.append(held.pop())
            held.append(word)
            operand = False
        elif token == "(":
            if operand:
                break
            held.append("(")
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if held:
                held.pop()
        else:
            if operand:
                break
            out.append(token.rstrip(".:"))
            operand = True
        end = match.end()
    out.extend(x for x in reversed(held) if x != "(")
    return out, _nothing_follows(line, end, operand)


def _nothing_follows(line: str, end: int, operand: bool) -> bool:
    """Whether nothing but marks follows on the line."""
    return bool(_REST.match(line, end)) and (operand or line[:end].rstrip().endswith(")"))


def postfix(expression: str) -> list[str]:
    """Tokens of a licence expression in postfix order."""
    return parsed(expression)[0]


def identifiers(expression: str) -> list[str]:
    """The licences that an expression names, lower-cased, without exceptions.

    Those of known families count wherever they stand. Others count if they have the form of an identifier and the
    expression makes up its line, so that prose after a tag names none.
    """
    tokens, whole = parsed(expression)
    stack: list[list[str]] = []
    for token in tokens:
        if token not in _RANK:
            known = family(token.lower()) is not None
            stack.append([token.lower()] if known or (whole and _FORMED.match(token)) else [])
        elif len(stack) > 1:
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "with" else left + right)
    return list(dict.fromkeys(x for part in stack for x in part))


def alternatives(expression: str) -> list[frozenset[str]]:
    """The sets of licences that satisfy an expression, smallest first. Unfinished operators take what there is.

    AND multiplies alternatives, so there may be very many; a scan doesn't list them.
    """
    stack: list[list[frozenset[str]]] = []
    for token in postfix(expression):
        if token in _RANK:
            right = stack.pop() if stack else []
            left = stack.pop() if stack else []
            if not left or not right:
                stack.append(left or right)
            elif token == "or":
                stack.append(list(dict.fromkeys(left + right)))
            elif token == "with":
                stack.append([x | {"with:" + e for s in right for e in s} for x in left])
            else:
                stack.append(list(dict.fromkeys(a | b for a in left for b in right)))
        else:
            stack.append([frozenset([token.lower()])])
    return sorted(stack[-1], key=lambda s: (len(s), sorted(s))) if stack else []


def openness(expression: str) -> tuple[float, float] | None:
    """Between which bounds an expression's most open alternative lies, and that by its strictest licence: OR takes the larger, AND the smaller.

    Exact for any number of alternatives; the bounds differ where it hangs on an identifier that is not
    known. An exception changes nothing; null without any licence.
    """
    stack: list[tuple[float, float]] = []
    for token in postfix(expression):
        if token not in _RANK:
            known = OPENNESS.get(family(token.lower()))
            stack.append((0.0, 1.0) if known is None else (known, known))
        elif len(stack) > 1:
            right, left = stack.pop(), stack.pop()
            pick = {"or": max, "and": min, "with": lambda x, _: x}[token]
            stack.append((pick(left[0], right[0]), pick(left[1], right[1])))
    return stack[-1] if stack else None


def family(identifier: str) -> str | None:
    """Label of the family of an identifier; null for an exception or one that is not known."""
    return next((label for start, label in FAMILIES if _FAMILY[start].match(identifier)), None)


@functools.lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan_text(text: str) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, score_most, spans, expressions)."""
    words = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    line = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
    base: set[str] = set()
    labels: set[str] = set()
    spans, expressions, n_base, first, last, tagged = [], [], 0, None, None, False
    seen = at = 0  # blanks counted so far, and up to where
    for end, phrase in _automaton().iter(line):
        begin = end - len(phrase) - 1
        if phrase == TAG:
            tagged = True
            continue
        if begin >= at:
            seen, at = seen + line.count(" ", at, begin), begin
            start = seen
        else:
            start = seen - line.count(" ", begin, at)
        spans.append((phrase, start))
        if phrase in BASE:
            base.add(BASE[phrase])
            n_base += 1
            first, last = start if first is None else min(first, start), start if last is None else max(last, start)
        else:
            labels.add(NOTICES[phrase][0])
    open_to = [(OPENNESS[x], OPENNESS[x]) for x in base | labels]
    if tagged:
        for match in _TAGGED.finditer(text):
            named = identifiers(match[1])
            if named:
                expressions.append(match[1].strip())
                labels |= {family(x) or x for x in named}
                open_to.append(openness(match[1]))
    low, high = (min(x) for x in zip(*open_to, strict=True)) if open_to else (0.0, 0.0)
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), low, high, spans, expressions


def scan(documents: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels, score, score_most, all spans and tagged expressions.

    `score` says how freely the text may be used at least, by the strictest notice in it: 1 permissive, 0.5 with
    conditions, 0 closed or no notice at all. `score_most` is more where it hangs on an identifier that is not known,
    which is its own label in lower case; else the same. An expression counts with its most open alternative, and
    that with its strictest licence. `spans` lists each phrase with the index of its first word. Null texts
    are empty, without words and labels; repeated rows are scanned one by one; other columns are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [scan_text(x) for x in texts_of(frame["text"])]
            out = pd.DataFrame(rows, columns=names)
            out["spans"] = [[{"phrase": p, "word": w} for p, w in x] for x in out["spans"]]
            out[["first_word", "last_word"]] = out[["first_word", "last_word"]].astype("Int64")
            yield pd.concat([frame[["doc_id"]].reset_index(drop=True), out], axis=1)

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "score_most", "spans", "expressions"]
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, score_most double, spans array<struct<phrase string, word long>>, expressions array<string>"
    return documents.select("doc_id", "text").mapInPandas(run, schema)
