"""Licence scan: Aho-Corasick finds notice phrases and identifier tags, a shunting-yard parser evaluates expressions."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_or_empty, tidy, utf8

#: The phrases of the base and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Phrases of the method's own, their labels and how openly each lets a text be used.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons zero": "public-domain",
    "cc0": "public-domain",
    "public domain": "public-domain",
    "this is free and unencumbered software released into the public domain": "public-domain",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "isc license": "isc",
    "gnu gpl": "gpl",
    "gpl v2": "gpl",
    "gpl v3": "gpl",
    "gpl version 2": "gpl",
    "gpl version 3": "gpl",
    "gplv2": "gpl",
    "gplv3": "gpl",
    "gnu lgpl": "lgpl",
    "lgpl v2 1": "lgpl",
    "lgpl v3": "lgpl",
    "lgplv2 1": "lgpl",
    "lgplv3": "lgpl",
    "gnu agpl": "agpl",
    "agpl v3": "agpl",
    "agplv3": "agpl",
    "boost software license": "bsl",
    "zlib license": "zlib",
    "university of illinois ncsa": "ncsa",
    "postgresql license": "postgresql",
    "python software foundation license": "psf",
    "universal permissive license": "upl",
    "academic free license": "afl",
    "artistic license": "artistic",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "microsoft public license": "ms-pl",
    "sil open font license": "ofl",
    "open database license": "odbl",
    "server side public license": "sspl",
    "business source license": "busl",
    "elastic license": "elastic",
    "proprietary and confidential": "proprietary",
    "spdx license identifier": "spdx",
}
OPENNESS = {"mit": 1.0, "apache": 1.0, "bsd": 1.0, "public-domain": 1.0, "cc-by": 0.9, "mpl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.3, "cc-by-nc": 0.2, "reserved": 0.0, "proprietary": 0.0}
OPENNESS |= {"isc": 1.0, "bsl": 1.0, "zlib": 1.0, "ncsa": 1.0, "postgresql": 1.0, "psf": 1.0, "upl": 1.0, "afl": 1.0, "artistic": 0.8, "ms-pl": 0.8, "ofl": 0.8, "epl": 0.6, "cddl": 0.6, "eupl": 0.5, "odbl": 0.5, "sspl": 0.2, "busl": 0.1, "elastic": 0.1}
#: Licence identifiers, or what one starts with before a hyphen, and the labels that they stand for, the longest first.
IDENTIFIERS = {"mit": "mit", "apache": "apache", "bsd": "bsd", "0bsd": "bsd", "mpl": "mpl", "lgpl": "lgpl", "agpl": "agpl", "gpl": "gpl", "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa", "cc-by-nd": "cc-by-nd", "cc-by": "cc-by", "cc0": "public-domain", "unlicense": "public-domain"}
IDENTIFIERS |= {"isc": "isc", "bsl": "bsl", "zlib": "zlib", "ncsa": "ncsa", "postgresql": "postgresql", "python": "psf", "psf": "psf", "upl": "upl", "afl": "afl", "artistic": "artistic", "ms-pl": "ms-pl", "ofl": "ofl", "epl": "epl", "cddl": "cddl", "eupl": "eupl", "odbl": "odbl", "sspl": "sspl", "busl": "busl", "elastic": "elastic"}
#: Exceptions that let more be done with a text than its licence alone, by what they start with, and how much more.
EXCEPTIONS, LOOSER = ("classpath", "gcc", "llvm", "linux-syscall", "bison", "autoconf", "font", "openssl", "openjdk-assembly", "bootloader", "libtool", "freertos", "qt-gpl", "qt-lgpl", "swift", "wxwindows", "ecos", "u-boot", "universal-foss", "ocaml-lgpl-linking", "lgpl-3.0-linking", "gstreamer"), 0.2
TAG = "spdx license identifier"

#: Bytes that end a word become spaces, A-Z become a-z.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
EXPRESSION = re.compile(rb"(?i)spdx-license-identifier:[ \t]*([A-Za-z0-9.+:() \t-]*)")


def identifier_label(word: str) -> str | None:
    """The label of a licence identifier in lower case: a whole name, or one that goes on after a hyphen."""
    parts = word.rstrip("+").split("-")
    return next((IDENTIFIERS[x] for n in range(len(parts), 0, -1) if (x := "-".join(parts[:n])) in IDENTIFIERS), None)


def expression_labels(text: str) -> tuple[list[str], float] | None:
    """Labels that a licence expression names, and its openness: or takes the most open side, and the least open.

    A known exception makes its licence more open, others leave it as it is. Operators in order of strength: with, and, or. None if it can't be
    parsed; reading stops at the first word that can't continue the expression.
    """
    strength = {"or": 1, "and": 2, "with": 3}
    values: list[float] = []
    waiting: list[str] = []
    labels: list[str] = []

    def reduce() -> bool:
        op = waiting.pop()
        if op == "(" or len(values) < 2:
            return False
        b, a = values.pop(), values.pop()
        values.append({"or": max, "and": min, "with": lambda x, more: min(1.0, x + more)}[op](a, b))
        return True

    wanted = True
    for word in re.findall(r"[()]|[^()\s]+", text.lower()):
        if wanted and word == "(":
            waiting.append(word)
        elif wanted and word not in strength and word != ")":
            name = identifier_label(word)
            exception = bool(waiting) and waiting[-1] == "with"
            if name and not exception:
                labels.append(name)
            values.append(OPENNESS.get(name, 0.5) if not exception else LOOSER * word.startswith(EXCEPTIONS))
            wanted = False
        elif not wanted and word in strength:
            while waiting and waiting[-1] != "(" and strength[waiting[-1]] >= strength[word]:
                if not reduce():
                    return None
            waiting.append(word)
            wanted = True
        elif not wanted and word == ")":
            while waiting and waiting[-1] != "(":
                if not reduce():
                    return None
            if not waiting:
                return None
            waiting.pop()
        else:
            break
    while waiting:
        if not reduce():
            return None
    return (labels, values[0]) if len(values) == 1 else None


def _automaton():
    import ahocorasick

    auto = ahocorasick.Automaton()
    for phrase in {*BASE, *PHRASES}:
        auto.add_word(f" {phrase} ", phrase)
    auto.make_automaton()
    return auto


def _scan(batches):
    auto = _automaton()
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
    for batch in batches:
        for part in slices(batch, "text"):
            data, at = utf8(part.column("text"))
            raw = data.tobytes()
            folded = raw.translate(FOLD)
            rows = []
            for i in range(part.num_rows):
                words = folded[at[i] : at[i + 1]].split()
                joined = " " + b" ".join(words).decode("latin-1") + " "  # one character for each byte, as places need
                base, own, found = [], set(), []
                met = list(auto.iter(joined))
                # spaces before a phrase are words before it
                spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32) if met else None
                places = np.searchsorted(spaces, [end - len(phrase) - 1 for end, phrase in met]).tolist() if met else []
                longest: dict[int, str] = {}  # of phrases that start at a word
                for start, (_, phrase) in zip(places, met, strict=True):
                    found.append((start, phrase))
                    if phrase in BASE:
                        base.append((start, BASE[phrase]))
                    longest[start] = max(longest.get(start, ""), phrase, key=len)
                own.update(PHRASES.get(p) or BASE[p] for p in longest.values())
                scores = [OPENNESS[x] for x in own if x in OPENNESS]
                if TAG in (p for _, p in found):
                    for m in EXPRESSION.finditer(raw[at[i] : at[i + 1]]):
                        if value := expression_labels(m[1].decode("latin-1")):
                            own.update(value[0])
                            scores.append(value[1])
                labels = sorted({x for _, x in base})
                rows.append((len(words), len(base), min((s for s, _ in base), default=None), max((s for s, _ in base), default=None), ",".join(labels), ",".join(sorted({*labels, *own})), min(scores) if scores else 0.5, [f"{s}:{p}" for s, p in sorted(found)]))
            columns = [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"])


def license_notices(docs: DataFrame) -> DataFrame:
    """Licence notices of every document: one row each, also for those without any.

    Columns: doc_id, n_words, n_base (places of the base phrases), first_word and last_word (their smallest and
    largest start; else null), base_labels and labels (with those of the other phrases and of identifier tags), score
    (how openly the text may be used, by the strictest notice, an expression counting as a whole; 0.5 without any),
    notices (word:phrase). Of the method's phrases that start at one word the longest gives a label; the base's all count.
    Null and empty texts have no words; texts are whole, however long. Repeated rows give a row each; other columns,
    whatever their names, are ignored. An empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(tidy(_scan), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices array<string>")
